"""Query and operation logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import epoch_seconds, from_micros, query_pattern

# Trailing windows in minutes, on a five-minute grid.
WINDOW_MINUTES = (5, 15, 60)
GRID_MINUTES = 5


def query_statistics(log: DataFrame) -> DataFrame:
    """Calls, total and mean time per role and query pattern.

    ``log`` has ``role``, ``query`` and ``duration_ms`` (an exact decimal).
    """
    return (
        log.groupBy("role", query_pattern(F.col("query")).alias("pattern"))
        .agg(F.count(F.lit(1)).alias("calls"), F.sum("duration_ms").alias("total_ms"))
        .withColumn("mean_ms", F.round(F.col("total_ms").cast("double") / F.col("calls"), 3))
    )


def slowest_patterns(log: DataFrame, n: int = 20) -> DataFrame:
    return (
        query_statistics(log)
        .orderBy(F.desc("mean_ms"), F.asc("role"), F.asc("pattern"))
        .limit(n)
    )


def _grid_end(index: Column) -> Column:
    return from_micros(index * (GRID_MINUTES * 60 * 1_000_000))


def working_set(events: DataFrame, key: str, ts: str = "ts", approximate: bool = False) -> DataFrame:
    """Distinct keys touched in the 5, 15 and 60 minutes up to each grid time.

    Events are first reduced to one row per grid cell and key.  A key counts
    from the cell's end until the window has passed or the key's next cell
    takes over, so every row adds one and takes one away, and a running sum
    over the grid gives the counts.  Rows are never repeated per window, and
    however busy a key is, it has one row per cell.
    """
    cell = F.floor(epoch_seconds(F.col(ts)) / (GRID_MINUTES * 60)).cast("bigint")
    cells = events.select(cell.alias("_cell"), F.col(key).alias("_key"))
    if approximate:
        return _approximate_working_set(cells)
    cells = cells.filter(F.col("_key").isNotNull()).distinct()
    following = F.lead("_cell").over(Window.partitionBy("_key").orderBy("_cell"))
    steps = []
    for minutes in WINDOW_MINUTES:
        last = F.col("_cell") + minutes // GRID_MINUTES
        gone = F.least(last, F.coalesce(F.col("_next"), last)) + 1
        steps += [_step(minutes, F.col("_cell") + 1, 1), _step(minutes, gone, -1)]
    changes = (
        cells.withColumn("_next", following)
        .select(F.explode(F.array(*steps)).alias("_step"))
        .groupBy("_step.minutes", "_step.at")
        .agg(F.sum("_step.change").alias("change"))
    )
    # From here on there is at most one row per window length and grid time.
    along = Window.partitionBy("minutes").orderBy("at")
    held = changes.select(
        "minutes",
        "at",
        F.sum("change").over(along).alias("distinct_keys"),
        F.lead("at").over(along).alias("until"),
    )
    each = F.explode(F.sequence("at", F.col("until") - 1)).alias("at")
    filled = held.filter(F.col("distinct_keys") > 0).select("minutes", each, "distinct_keys")
    return filled.select("minutes", _grid_end(F.col("at")).alias("window_end"), "distinct_keys")


def _step(minutes: int, at: Column, change: int) -> Column:
    return F.struct(F.lit(minutes).alias("minutes"), at.alias("at"), F.lit(change).alias("change"))


def _approximate_working_set(cells: DataFrame) -> DataFrame:
    """The same from one sketch per cell, merged for the windows it lies in."""
    sketches = cells.groupBy("_cell").agg(F.hll_sketch_agg("_key").alias("_sketch"))
    ends = [
        F.struct(F.lit(minutes).alias("minutes"), F.lit(step).alias("step"))
        for minutes in WINDOW_MINUTES
        for step in range(1, minutes // GRID_MINUTES + 1)
    ]
    placed = sketches.select("_cell", "_sketch", F.explode(F.array(*ends)).alias("_end"))
    merged = placed.groupBy("_end.minutes", (F.col("_cell") + F.col("_end.step")).alias("at")).agg(
        F.hll_sketch_estimate(F.hll_union_agg("_sketch")).alias("distinct_keys")
    )
    return merged.select("minutes", _grid_end(F.col("at")).alias("window_end"), "distinct_keys")


def operation_stats(log: DataFrame) -> DataFrame:
    """Calls, errors and durations per operation and status."""
    return log.groupBy("operation", "status").agg(
        F.count(F.lit(1)).alias("operations"),
        F.count(F.when(F.col("status") == "Error", 1)).alias("errors"),
        F.sum("duration_ms").alias("total_ms"),
        F.max("duration_ms").alias("longest_ms"),
    )
