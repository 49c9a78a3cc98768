"""Ranks, running totals and pages over a total order, without one-task windows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.joins import names
from millrace.session import pin

_BEFORE = (Window.unboundedPreceding, -1)
_UP_TO = (Window.unboundedPreceding, Window.currentRow)
# Fixed value: up to this many rows per key Spark applies a limit before the
# shuffle (the default of spark.sql.optimizer.windowGroupLimitThreshold).
_EARLY_LIMIT = 1000
# monotonically_increasing_id() keeps the place in the partition in these bits.
_PLACE_BITS = 33


def _takes_work(df: DataFrame) -> bool:
    """Whether more than scans, projections and filters makes the rows."""
    open_ = [df._jdf.queryExecution().optimizedPlan()]
    while open_:
        node = open_.pop()
        if node.nodeName() in ("Aggregate", "Join", "Window", "Sort", "Generate"):
            return True
        children = node.children()
        open_ += [children.apply(i) for i in range(children.size())]
    return False


def _in_ranges(df: DataFrame, order: Sequence[Column], parts: int | None) -> DataFrame:
    """Cut the order into ranges of similar size and fix each row's range.

    The whole order decides the range, so a hot leading value spreads over many
    ranges.  Bounds are sampled; the result is pinned so that they are the same
    wherever it is used.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Sampling reads the input once more; what takes work to make is stored first.
    if _takes_work(df):
        df = pin(df)
    ranged = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    # Partition number and place in the sorted partition, in one number.
    return pin(
        ranged.withColumn("_spot", F.monotonically_increasing_id())
        .withColumn("_range", F.shiftright("_spot", _PLACE_BITS))
        .withColumn("_spot", F.col("_spot").bitwiseAND((1 << _PLACE_BITS) - 1))
    )


def number_rows(
    df: DataFrame,
    order: Sequence[Column],
    name: str = "row_number",
    start: int = 1,
    parts: int | None = None,
) -> DataFrame:
    """Number all rows densely, as bigint; ``order`` must be total.

    Each row's place in its sorted range is shifted by the sizes of the ranges
    before, so the rows are shuffled once and only one row per range meets in a
    single task.  Runs the jobs that cut and store the ranges.
    """
    ranged = _in_ranges(df, order, parts)
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_size"))
    before = F.sum("_size").over(Window.orderBy("_range").rowsBetween(*_BEFORE))
    shifts = sizes.select("_range", F.coalesce(before, F.lit(0)).alias("_shift"))
    number = (F.col("_shift") + F.col("_spot") + start).cast("bigint")
    return ranged.join(shifts, "_range").select(*df.columns, number.alias(name))


def continue_ids(df: DataFrame, order: Sequence[Column], held: DataFrame, key: str = "id") -> DataFrame:
    """Give new rows the ids after the highest one held, in the given order."""
    last = held.agg(F.coalesce(F.max(key), F.lit(0)).cast("bigint")).scalar()
    numbered = number_rows(df, order, "_new")
    return numbered.select((F.col("_new") + last).alias(key), *df.columns)


def plain_running_totals(
    df: DataFrame, by: str | Sequence[str], order: Sequence[Column], totals: Mapping[str, Column]
) -> DataFrame:
    """The same by one window: the meaning of ``running_totals``, for checks."""
    whole = Window.partitionBy(*names(by)).orderBy(*order).rowsBetween(*_UP_TO)
    return df.select("*", *[F.sum(v).over(whole).alias(n) for n, v in totals.items()])


def running_totals(
    df: DataFrame,
    by: str | Sequence[str],
    order: Sequence[Column],
    totals: Mapping[str, Column],
    parts: int | None = None,
) -> DataFrame:
    """Per group, the sums over all rows up to and including each row.

    ``order`` must be total inside a group; null is a group.  A group may be larger than a
    task: it is cut along the order, summed per piece, and each piece gets the
    sums of the pieces before it.  Nulls add nothing; a sum is null as long as
    it has met nulls only.
    """
    groups = names(by)
    valued = df.select("*", *[v.alias(f"_v_{n}") for n, v in totals.items()])
    ranged = _in_ranges(valued, [*[F.col(g) for g in groups], *order], parts)
    pieces = ranged.groupBy(*groups, "_range").agg(
        *[F.sum(f"_v_{n}").alias(f"_s_{n}") for n in totals]
    )
    earlier = Window.partitionBy(*groups).orderBy("_range").rowsBetween(*_BEFORE)
    carried = pieces.select(
        *[F.col(g).alias(f"_g_{g}") for g in groups],
        F.col("_range").alias("_r"),
        *[F.sum(f"_s_{n}").over(earlier).alias(f"_c_{n}") for n in totals],
    )
    piece = Window.partitionBy(*groups, "_range").orderBy(*order).rowsBetween(*_UP_TO)
    summed = ranged.select(
        *df.columns,
        "_range", *[F.sum(f"_v_{n}").over(piece).alias(f"_p_{n}") for n in totals]
    )
    same = F.col("_range") == F.col("_r")
    for g in groups:
        same &= F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    return summed.join(carried, same).select(
        *df.columns,
        *[
            F.coalesce(F.col(f"_p_{n}") + F.col(f"_c_{n}"), F.col(f"_p_{n}"), F.col(f"_c_{n}"))
            .cast(summed.schema[f"_p_{n}"].dataType)
            .alias(n)
            for n in totals
        ],
    )


def page(
    df: DataFrame, order: Sequence[Column], limit: int, offset: int = 0, near_rows: int = 1_000
) -> DataFrame:
    """Rows ``offset + 1`` to ``offset + limit`` of a total order.

    A near page is a top-k: each task keeps ``offset + limit`` rows.  A far one
    numbers the rows instead, so that nothing of that size meets in one task.
    """
    if offset + limit <= near_rows:
        return df.orderBy(*order).offset(offset).limit(limit)
    numbered = number_rows(df, order, "_row")
    inside = F.col("_row").between(offset + 1, offset + limit)
    return numbered.filter(inside).orderBy("_row").drop("_row")


def latest_per_key(
    df: DataFrame,
    key: str | Sequence[str],
    order: Sequence[Column],
    n: int,
    name: str = "position",
    parts: int | None = None,
) -> DataFrame:
    """The first ``n`` rows of each key in the given order; a null key is a key.

    For a small ``n`` Spark trims every map task to ``n`` rows per key before
    the shuffle.  It does not for a larger one; the order by key is then cut
    into ranges, and the counts of each key per range tell where its first
    ``n`` rows end.  No task holds more of a key than a range.
    """
    keys = names(key)
    if n <= _EARLY_LIMIT:
        position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        return df.withColumn(name, position).filter(F.col(name) <= n)
    ranged = _in_ranges(df, [*[F.col(k) for k in keys], *order], parts)
    # A key's rows lie side by side in a range: one row for each of its ranges.
    sizes = ranged.groupBy(*keys, "_range").agg(F.count(F.lit(1)).alias("_size"), F.min("_spot").alias("_first"))
    before = F.sum("_size").over(Window.partitionBy(*keys).orderBy("_range").rowsBetween(*_BEFORE))
    cuts = sizes.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        F.col("_range").alias("_r"),
        "_first",
        F.coalesce(before, F.lit(0)).alias("_before"),
    ).filter(F.col("_before") < n)
    same = F.col("_range") == F.col("_r")
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    position = (F.col("_before") + F.col("_spot") - F.col("_first") + 1).cast("int")
    return ranged.join(cuts, same).select(*df.columns, position.alias(name)).filter(F.col(name) <= n)
