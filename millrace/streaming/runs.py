"""Starting streams that work off what is there and stop."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryProgress


_LOOK_EVERY = 0.5  # seconds; Spark keeps the reports of the last hundred batches


def file_stream(
    spark: SparkSession, folder: str, schema: T.StructType, kind: str = "parquet", files_per_batch: int | None = None
) -> DataFrame:
    """A growing folder as a stream; ``files_per_batch`` sets the cadence."""
    reader = spark.readStream.format(kind).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder)


def run_to_end(writer: DataStreamWriter) -> StreamingQuery:
    """Work off everything available, then stop; raise if the stream failed."""
    return run_reported(writer)[0]


def run_reported(writer: DataStreamWriter) -> tuple[StreamingQuery, list[StreamingQueryProgress]]:
    """``run_to_end``, and the reports of all its batches, taken while it runs."""
    query = writer.trigger(availableNow=True).start()
    reports: dict[int, StreamingQueryProgress] = {}
    ended = False
    while not ended:
        ended = query.awaitTermination(_LOOK_EVERY)
        reports |= {progress.batchId: progress for progress in query.recentProgress}
    return query, list(reports.values())


def keep_running(writer: DataStreamWriter, every: str) -> StreamingQuery:
    """Look for new data at an interval, such as ``5 seconds``, until stopped."""
    return writer.trigger(processingTime=every).start()


def to_files(df: DataFrame, folder: str, checkpoint: str, partition_by: str | None = None) -> DataStreamWriter:
    """Append to a folder; its log makes every batch count exactly once."""
    writer = (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("path", folder)
        .option("checkpointLocation", checkpoint)
    )
    return writer.partitionBy(partition_by) if partition_by else writer


def to_batches(df: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str) -> DataStreamWriter:
    """Hand each batch to a function, which must bear being called twice."""
    return df.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)


def dropped_late(reports: Sequence[StreamingQueryProgress]) -> int:
    """Rows a finished stream left out because they came after the watermark."""
    return sum(operator.numRowsDroppedByWatermark for progress in reports for operator in progress.stateOperators)


def observed(reports: Sequence[StreamingQueryProgress], name: str) -> dict[str, int]:
    """Totals of an observation over the batches of a finished stream."""
    totals: dict[str, int] = {}
    for progress in reports:
        row = progress.observedMetrics.get(name)
        for metric, value in (row.asDict() if row else {}).items():
            totals[metric] = totals.get(metric, 0) + (value or 0)
    return totals
