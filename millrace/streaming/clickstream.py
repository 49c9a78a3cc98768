"""Clickstream jobs: ingest, silver, incremental gold, the live feed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.functions import event_time, instant, iso_text
from millrace.operators.demand import (
    EVENT_KEY,
    demand_from_silver,
    demand_table,
    funnel_counts,
    product_labels,
)
from millrace.operators.joins import lookup_join
from millrace.operators.quality import clickstream_rules, keep_valid, violation_counts
from millrace.sources.tables import overwrite
from millrace.streaming.runs import dropped_late, file_stream, observed, run_reported, run_to_end, to_batches, to_files

EXPECTATIONS = "expectations"


def event_to_json(events: DataFrame) -> DataFrame:
    """One JSON text per event, zone-less times as ISO-8601 in UTC."""
    columns = [
        iso_text(F.col(f.name)).alias(f.name) if f.dataType == T.TimestampNTZType() else F.col(f.name)
        for f in events.schema
    ]
    return events.select(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("value"))


def event_from_json(texts: DataFrame, schema: T.StructType) -> DataFrame:
    return texts.select(F.from_json("value", schema).alias("_event")).select("_event.*")


def ingest_json_events(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    target: str,
    checkpoint: str,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Append JSON events to a folder of files.

    An event must have the schema's fields, all and no others, of its types;
    null is a value.  Those that do not, or do not parse, are kept, with their
    text, in the partition ``rejected=true``; nothing is lost or stops the feed.
    """
    with_text = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_batch or 1000).text(source)
    parsed = F.from_json("value", with_text, {"columnNameOfCorruptRecord": "_corrupt_record"})
    fields = F.array(*[F.lit(name) for name in sorted(schema.fieldNames())])
    exact = F.coalesce(F.array_sort(F.json_object_keys("value")) == fields, F.lit(False))
    events = lines.filter(F.length(F.trim("value")) > 0).select("value", parsed.alias("_event"), exact.alias("_exact"))
    rejected = ~F.col("_exact") | F.col("_event._corrupt_record").isNotNull()
    marked = events.select(
        *[F.when(~rejected, F.col(f"_event.{name}")).alias(name) for name in schema.fieldNames()],
        F.when(rejected, F.col("value")).alias("_corrupt_record"),
        rejected.alias("rejected"),
    )
    return run_to_end(to_files(marked, target, checkpoint, partition_by="rejected"))


def _ingested(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    extra = [T.StructField("_corrupt_record", T.StringType()), T.StructField("rejected", T.BooleanType())]
    return spark.read.schema(T.StructType([*schema.fields, *extra])).parquet(target)


def accepted_events(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    """What the ingest job accepted."""
    return _ingested(spark, target, schema).filter(~F.col("rejected")).select(*schema.fieldNames())


def rejected_events(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    """The text of what it could not take."""
    rejected = _ingested(spark, target, schema).filter(F.col("rejected"))
    return rejected.select(F.col("_corrupt_record").alias("value"))


def adapt_live_events(live: DataFrame, identity: Column | None = None) -> DataFrame:
    """Live events in the shape of the seeded ones.

    The time arrives as text and there is no session.  Without an ``identity``
    two shoppers who do the same at the same microsecond count once.
    """
    session = F.lit(None).cast("string") if identity is None else identity.cast("string")
    return live.select(
        session.alias("session_id"), "event_type", "product_id", event_time(F.col("event_ts")).alias("event_ts")
    )


def dedup_events(events: DataFrame, key: Sequence[str], horizon: str | None = None) -> DataFrame:
    """Each event once.

    Exact without a ``horizon``, and every key ever seen stays in the state.
    With one, keys older than it are forgotten and events that come later than
    it are left out; the stream's progress counts them as dropped by watermark.
    """
    if horizon is None:
        return events.dropDuplicates(list(key))
    timed = events.withColumn("_time", instant(F.col("event_ts")))
    return timed.withWatermark("_time", horizon).dropDuplicatesWithinWatermark(list(key)).drop("_time")


def silver_stream(
    bronze: DataFrame,
    products: DataFrame,
    horizon: str | None = None,
    spread: int | None = None,
) -> DataFrame:
    """Valid events, each once, with product name and category.

    Rejections are counted per delivery, before duplicates are known.  Spark
    sends the products to the events when their size in bytes is under its
    broadcast threshold.  Products larger than that are shuffled; adaptive
    execution does not split hot ones in this stream, ``spread`` does.
    """
    labels = product_labels(products)
    rules = clickstream_rules()
    watched = bronze.select(*EVENT_KEY).observe(
        EXPECTATIONS, F.count(F.lit(1)).alias("deliveries"), *violation_counts(rules)
    )
    clean = dedup_events(keep_valid(watched, rules), EVENT_KEY, horizon)
    enriched = lookup_join(clean, labels, "product_id", spread=spread)
    return enriched.select(*EVENT_KEY, "product_name", "category")


def run_silver(
    bronze: DataFrame, products: DataFrame, target: str, checkpoint: str, horizon: str | None = None
) -> dict[str, int]:
    """Bring the silver files up to date; returns deliveries and rejections.

    The products are read as they are when the run starts.  ``late`` counts
    the events beyond the horizon.  ``streaming.silver`` keeps those, and reads
    the products anew for every batch.
    """
    _, reports = run_reported(to_files(silver_stream(bronze, products, horizon), target, checkpoint))
    return {**observed(reports, EXPECTATIONS), "late": dropped_late(reports)}


def run_funnel(
    spark: SparkSession, silver: str, schema: T.StructType, target: str, checkpoint: str, files_per_batch: int | None = None
) -> None:
    """Count new silver events per product, one small file set per batch.

    Counts add up, so a batch stores only its own; a repeated batch replaces
    its former files.
    """

    def store(batch: DataFrame, number: int) -> None:
        counted = batch.groupBy("product_id").agg(
            F.max("product_name").alias("product_name"), F.max("category").alias("category"), *funnel_counts()
        )
        counted.write.mode("overwrite").parquet(f"{target}/batch={number}")

    new_events = file_stream(spark, silver, schema, files_per_batch=files_per_batch)
    run_to_end(to_batches(new_events, store, checkpoint))


def funnel_so_far(spark: SparkSession, target: str) -> DataFrame:
    """The counts of all batches together."""
    return (
        spark.read.parquet(target)
        .groupBy("product_id")
        .agg(
            F.max("product_name").alias("product_name"),
            F.max("category").alias("category"),
            *[F.sum(c).alias(c) for c in ("views", "clicks", "add_to_carts")],
        )
    )


def refresh_gold(
    spark: SparkSession, silver: str, order_items: DataFrame, inventory: DataFrame, table: str
) -> None:
    """Recompute the demand table from all silver files and replace it."""
    overwrite(demand_from_silver(spark.read.parquet(silver), order_items, inventory), table)


def refresh_gold_incremental(
    spark: SparkSession, funnel: str, order_items: DataFrame, inventory: DataFrame
) -> DataFrame:
    """The demand table from stored counts, without reading silver again."""
    return demand_table(funnel_so_far(spark, funnel), order_items, inventory)
