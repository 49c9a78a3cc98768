"""Silver by batches: late events kept, exact deduplication, fresh products, durable counts.

Every batch of the stream first writes down what it decides by: the watermark
that the batches before it leave, and the version of the products it sees.
A repeated batch finds that row and decides the same.  Then it replaces its own
folders: the new events, by day, the late ones, and at last a row of counts for
each rule.  A batch counts once its counts are there.

Deduplication is exact and needs no state in memory: the events kept so far
are the state.  They lie by day, and a batch is compared with the days it holds
only.  With ``lateness`` no event is accepted from before the watermark, so
days before that are never read again.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.functions import moment
from millrace.operators.demand import EVENT_KEY, product_labels
from millrace.operators.joins import lookup_join
from millrace.operators.quality import clickstream_rules, keep_valid, violation_counts
from millrace.sources.versions import Versions
from millrace.streaming.runs import keep_running, run_to_end, to_batches

_DECISION = "batch bigint, watermark timestamp_ntz, newest timestamp_ntz, products bigint"
_COUNTS = "batch bigint, rule string, rows bigint"
_EVENT = "session_id string, event_type string, product_id int, event_ts timestamp_ntz"
_SILVER = _EVENT + ", product_name string, category string, batch bigint, day date"
# Rules beside the expectations; what is delivered and valid is one of the last three.
DELIVERED, KEPT, LATE, DUPLICATE = "delivered", "kept", "late", "duplicate"


class SilverBatches:
    """A folder of silver events, filled batch by batch.

    ``products`` are versions of the products; each batch takes the newest.
    ``lateness`` is how far behind the newest event an event may come, such as
    ``10 days``; without, none is late.
    """

    def __init__(self, spark: SparkSession, folder: str, products: Versions, lateness: str | None = None):
        self.spark, self.folder, self.products, self.lateness = spark, folder, products, lateness

    def _stored(self, name: str, schema: str) -> DataFrame:
        reader = self.spark.read.schema(schema)
        try:
            return reader.parquet(f"{self.folder}/{name}")
        except AnalysisException:
            return self.spark.createDataFrame([], schema)

    def _decision(self, valid: DataFrame, batch: int):
        """The row that a batch decides by: its own from an earlier try, or a new one."""
        held = self._stored("decisions", _DECISION)
        mine = held.filter(F.col("batch") == batch).first()
        if mine is not None:
            return mine
        before = held.filter(F.col("batch") < batch).agg(F.max("newest")).first()[0]
        newest = valid.agg(F.max("event_ts")).first()[0]
        newest = max((t for t in (before, newest) if t is not None), default=None)
        watermark = None
        if self.lateness and before is not None:
            watermark = self.spark.range(1).select(moment(before) - F.expr(f"interval {self.lateness}")).first()[0]
        version = self.products.newest()
        if version is None:
            raise ValueError(f"no products in {self.products.folder}")
        row = self.spark.createDataFrame([(batch, watermark, newest, version)], _DECISION)
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/decisions/of={batch}")
        return row.first()

    def _kept(self) -> DataFrame:
        """Everything written so far, with ``batch`` and ``day``."""
        return self._stored("silver", _SILVER)

    def handle(self, batch: DataFrame, number: int) -> None:
        """One batch of the stream; may be called again with the same rows."""
        rules = clickstream_rules()
        events = batch.select(*EVENT_KEY).persist()
        try:
            valid = keep_valid(events, rules)
            decision = self._decision(valid, number)
            late = F.lit(False) if decision.watermark is None else F.col("event_ts") < moment(decision.watermark)
            valid.filter(late).write.mode("overwrite").parquet(f"{self.folder}/late/batch={number}")
            timely = valid.filter(~late).dropDuplicates(list(EVENT_KEY)).withColumn("day", F.to_date("event_ts"))
            fresh = self._unseen(timely, number)
            labels = product_labels(self.products.read(decision.products))
            named = lookup_join(fresh, labels, "product_id")
            silver = named.select(*EVENT_KEY, "product_name", "category", "day")
            target = f"{self.folder}/silver/batch={number}"
            silver.write.mode("overwrite").partitionBy("day").parquet(target)
            kept = self._kept().filter(F.col("batch") == number).count()
            self._count(events, late, rules, kept, number)
        finally:
            events.unpersist()

    def _unseen(self, timely: DataFrame, number: int) -> DataFrame:
        """Events that no earlier batch kept; only the days at hand are read."""
        days = [r.day for r in timely.select("day").distinct().collect()]  # of one batch
        before = self._kept().filter((F.col("batch") < number) & F.col("day").isin(days))
        return timely.join(before.select(*EVENT_KEY, "day"), [*EVENT_KEY, "day"], "left_anti") if days else timely

    def _count(self, events: DataFrame, late, rules, kept: int, number: int) -> None:
        valid = F.lit(True)
        for rule in rules.values():
            valid = valid & F.coalesce(rule, F.lit(False))
        found = events.agg(
            F.count(F.lit(1)).alias(DELIVERED),
            F.count(F.when(valid, 1)).alias("valid"),
            F.count(F.when(valid & late, 1)).alias(LATE),
            *violation_counts(rules),
        ).first()
        totals = {name: found[name] for name in (DELIVERED, LATE, *rules)}
        totals |= {KEPT: kept, DUPLICATE: found["valid"] - found[LATE] - kept}
        rows = self.spark.createDataFrame([(number, rule, n) for rule, n in totals.items()], _COUNTS)
        rows.coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/counts/of={number}")

    def run(self, bronze: DataFrame, checkpoint: str, every: str | None = None) -> StreamingQuery:
        """Work off what is there, or go on looking at an interval."""
        writer = to_batches(bronze, self.handle, checkpoint)
        return keep_running(writer, every) if every else run_to_end(writer)

    def counts(self) -> DataFrame:
        """``batch, rule, rows`` of every batch, however often it was tried."""
        return self._stored("counts", _COUNTS).select("batch", "rule", "rows")

    def totals(self) -> DataFrame:
        return self.counts().groupBy("rule").agg(F.sum("rows").alias("rows"))

    def _whole(self, name: str, schema: str) -> DataFrame:
        done = self.counts().agg(F.max("batch")).first()[0]
        return self._stored(name, schema).filter(F.col("batch") <= F.lit(-1 if done is None else done))

    def silver(self) -> DataFrame:
        """The events kept, of batches that are complete."""
        return self._whole("silver", _SILVER).select(*EVENT_KEY, "product_name", "category")

    def late(self) -> DataFrame:
        """The events behind the watermark, as they were delivered."""
        return self._whole("late", _EVENT + ", batch bigint").select(*EVENT_KEY)
