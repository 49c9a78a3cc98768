"""Joins and filters that keep their result whole and their tasks even.

No join here hints a broadcast.  Spark broadcasts a side when its measured
size is under ``spark.sql.autoBroadcastJoinThreshold``; otherwise the join is
shuffled and adaptive execution splits the partitions of hot keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def names(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: str,
    how: str = "left",
    spread: int | None = None,
) -> DataFrame:
    """Add the columns of ``lookup`` (one row per key) to every fact.

    ``spread`` is for plans that adaptive execution does not touch, such as a
    stateful stream: facts of one key go to ``spread`` tasks and the lookup is
    repeated that often.  The copy number comes from the fact's own values, so
    a retried task sends every row where it went before.
    """
    if not spread or spread < 2:
        return facts.join(lookup, on, how)
    rest = [F.col(c) for c in facts.columns if c != on]
    copy = F.pmod(F.xxhash64(*rest), F.lit(spread)).cast("int")
    copies = F.explode(F.sequence(F.lit(0), F.lit(spread - 1)))
    return (
        facts.withColumn("_copy", copy)
        .join(lookup.withColumn("_copy", copies), [on, "_copy"], how)
        .drop("_copy")
    )


class Child(NamedTuple):
    """A child table, its key to the parent, its totals and their defaults."""

    rows: DataFrame
    key: str
    totals: Sequence[Column]
    defaults: Mapping[str, Any] = {}


def preaggregate_join(parent: DataFrame, key: str, children: Sequence[Child]) -> DataFrame:
    """Join several child tables to a parent without multiplying rows.

    Each child is reduced to one row per key first, which is partial on the map
    side, so a hot key costs one row per map task.
    """
    result = parent
    for child in children:
        totals = child.rows.groupBy(F.col(child.key).alias(key)).agg(*child.totals)
        result = result.join(totals, key, "left")
        if child.defaults:
            result = result.fillna(dict(child.defaults))
    return result


def one_per_key(rows: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """One row per key: the smallest, comparing the columns in their order."""
    keys = names(key)
    rest = [c for c in rows.columns if c not in keys]
    if not rest:
        return rows.dropDuplicates(keys)
    picked = rows.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row"))
    return picked.select(*keys, "_row.*").select(*rows.columns)


def insert_ignore(target: DataFrame, rows: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Add the rows whose key the target does not hold yet; safe to repeat."""
    keys = names(key)
    fresh = one_per_key(rows, keys).join(target.select(*keys), keys, "left_anti")
    return target.unionByName(fresh, allowMissingColumns=True).select(*target.columns)


def cascade_delete(children: DataFrame, surviving_parents: DataFrame, foreign_key: str, key: str) -> DataFrame:
    """Children whose parent is still there."""
    parents = surviving_parents.select(F.col(key).alias(foreign_key))
    return children.join(parents, foreign_key, "left_semi")


def where_all(df: DataFrame, conditions: Sequence[Column | None]) -> DataFrame:
    """Filter by every condition that is given."""
    given = [c for c in conditions if c is not None]
    return df.filter(reduce(lambda a, b: a & b, given)) if given else df


def select_available(
    df: DataFrame, required: Sequence[str], optional: Mapping[str, Column]
) -> DataFrame:
    """The required columns, and each optional one or its stand-in."""
    present = set(df.columns)
    extras = [
        F.col(name) if name in present else stand_in.alias(name)
        for name, stand_in in optional.items()
    ]
    return df.select(*required, *extras)
