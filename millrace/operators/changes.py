"""Change logs: apply, compare, rebuild as of a time, restore."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import moment
from millrace.operators.joins import insert_ignore, names
from millrace.session import filed

INSERT, UPDATE, DELETE = "insert", "update", "delete"
# A table whose changed share per cycle is above this is cheaper to reload.
RELOAD_CHURN = 0.10


def _newest(seq: str, op: str) -> Column:
    """Order of the changes of one key; at one ``seq`` a delete comes last."""
    rank = F.when(F.col(op) == DELETE, 2).when(F.col(op) == UPDATE, 1).otherwise(0)
    return F.struct(F.col(seq), rank)


def latest_change(changes: DataFrame, key: str | Sequence[str], seq: str, op: str = "op") -> DataFrame:
    """The newest change of each key.

    An aggregate, not a window: map tasks already keep one change per key, so
    a key that is changed all the time does not fill a task.
    """
    keys = names(key)
    rest = [c for c in changes.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), _newest(seq, op)).alias("_row")
    return changes.groupBy(*keys).agg(newest).select(*keys, "_row.*").select(*changes.columns)


def apply_changes(
    base: DataFrame, changes: DataFrame, key: str | Sequence[str], seq: str, op: str = "op"
) -> DataFrame:
    """``base`` after the changes; applying them again changes nothing.

    The change log is the small side as a rule, so both joins can be
    broadcast and the base is then not shuffled at all.  Columns the changes
    do not carry become null, as in a log that lags behind a new column.
    """
    keys = names(key)
    last = latest_change(changes, keys, seq, op)
    written = last.filter(F.col(op) != DELETE)
    kept = base.join(last.select(*keys), keys, "left_anti")
    columns = [c for c in base.columns if c in written.columns]
    return kept.unionByName(written.select(*columns), allowMissingColumns=True)


def as_of(
    changes: DataFrame, key: str | Sequence[str], seq: str, time: str, when: datetime, op: str = "op"
) -> DataFrame:
    """The table the log described at a moment."""
    until = changes.filter(F.col(time) <= moment(when))
    return latest_change(until, key, seq, op).filter(F.col(op) != DELETE).drop(op, seq, time)


def mirror(
    snapshot: DataFrame, changes: DataFrame, key: str | Sequence[str], seq: str, op: str = "op"
) -> DataFrame:
    """A lake copy of a serving table: its first snapshot, then its changes."""
    return apply_changes(snapshot, changes, key, seq, op)


def change_set(old: DataFrame, new: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """What turns ``old`` into ``new``: one row per differing key.

    ``op``, the key, the new values under their own names and the old ones
    under ``before_``.  Values are compared exactly and nulls are equal.
    """
    keys = names(key)
    rest = [c for c in new.columns if c not in keys]
    was = old.select(*keys, F.struct(*rest).alias("_old"))
    now = new.select(*keys, F.struct(*rest).alias("_new"))
    op = (
        F.when(F.col("_old").isNull(), INSERT)
        .when(F.col("_new").isNull(), DELETE)
        .when(~F.col("_old").eqNullSafe(F.col("_new")), UPDATE)
    )
    return (
        was.join(now, keys, "full_outer")
        .withColumn("op", op)
        .filter(F.col("op").isNotNull())
        .select(
            "op",
            *keys,
            *[F.col(f"_new.{c}").alias(c) for c in rest],
            *[F.col(f"_old.{c}").alias(f"before_{c}") for c in rest],
        )
    )


def row_hash(df: DataFrame, columns: Sequence[str], seed: int = 0) -> Column:
    """A 64-bit hash of some columns in which nulls count by their place."""
    kinds = {f.name: f.dataType for f in df.schema}
    nested = (T.ArrayType, T.MapType, T.StructType)
    whole = {"ignoreNullFields": "false"}
    parts = [F.to_json(F.struct(c), whole) if isinstance(kinds[c], nested) else F.col(c) for c in columns]
    nulls = [F.when(F.col(c).isNull(), "1").otherwise("0") for c in columns]
    return F.xxhash64(F.lit(seed), *parts, *([F.concat(*nulls)] if nulls else []))


def row_digests(df: DataFrame, key: str | Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Each key with 128 bits of its row and a hash that deals keys to ranges."""
    keys = names(key)
    return df.select(
        *keys,
        F.xxhash64(*keys).alias("_deal"),
        row_hash(df, [*keys, *columns], 1).alias("_d0"),
        row_hash(df, [*keys, *columns], 2).alias("_d1"),
    )


def uneven_ranges(was: DataFrame, now: DataFrame, ranges: int) -> DataFrame:
    """``_range`` of the key ranges in which two sets of digests differ.

    A range is its number of rows and the sum of their digests (bit by bit, so
    it cannot overflow): one row per range and map task is shuffled.
    """

    def summed(digests: DataFrame, name: str) -> DataFrame:
        figures = [F.count(F.lit(1)), F.bit_xor("_d0"), F.bit_xor("_d1")]
        by = F.pmod("_deal", F.lit(ranges)).alias("_range")
        return digests.groupBy(by).agg(F.struct(*figures).alias(name))

    both = summed(was, "_was").join(summed(now, "_now"), "_range", "full_outer")
    return both.filter(~F.col("_was").eqNullSafe(F.col("_now"))).select("_range")


def differing_keys(
    old: DataFrame, new: DataFrame, key: str | Sequence[str], rows_per_range: int = 16
) -> DataFrame:
    """``op`` and the key of every row that two states do not share.

    Digests of both are stored once.  Ranges of keys whose sums agree are left
    out; of the others keys and digests are joined.  No other column moves.
    """
    keys = names(key)
    rest = [c for c in new.columns if c not in keys]
    was, now = (filed(row_digests(df, keys, rest)) for df in (old, new))
    rows, ranges = max(was.count(), now.count()), 1
    while ranges * rows_per_range < rows:
        ranges *= 2
    uneven = filed(uneven_ranges(was, now, ranges))

    def inside(digests: DataFrame, name: str) -> DataFrame:
        ranged = digests.withColumn("_range", F.pmod("_deal", F.lit(ranges)))
        return ranged.join(uneven, "_range", "left_semi").select(*keys, F.struct("_d0", "_d1").alias(name))

    both = inside(was, "_was").join(inside(now, "_now"), keys, "full_outer")
    op = F.when(F.col("_was").isNull(), INSERT).when(F.col("_now").isNull(), DELETE).otherwise(UPDATE)
    return both.filter(~F.col("_was").eqNullSafe(F.col("_now"))).select(op.alias("op"), *keys)


def change_set_by_digest(
    old: DataFrame, new: DataFrame, key: str | Sequence[str], rows_per_range: int = 16
) -> DataFrame:
    """The same as ``change_set``, for large stored states of which little changed.

    Whole rows are read a second time, for the differing keys only: where
    these are few, Spark sends them to the rows, which then stay where they
    are.  What has other digests is compared exactly before it counts.  Keys
    must not be null.  States stored alike by key are better compared by
    ``change_set``, which then shuffles nothing.
    """
    keys = names(key)
    rest = [c for c in new.columns if c not in keys]
    differ = filed(differing_keys(old, new, keys, rows_per_range))

    def rows_of(state: DataFrame, other: str, name: str) -> DataFrame:
        wanted = differ.filter(F.col("op") != other).select(*keys)
        return state.join(wanted, keys).select(*keys, F.struct(*rest).alias(name))

    found = differ.join(rows_of(old, INSERT, "_old"), keys, "left").join(rows_of(new, DELETE, "_new"), keys, "left")
    same = (F.col("op") == UPDATE) & F.col("_old").eqNullSafe(F.col("_new"))
    return found.filter(~same).select(
        "op",
        *keys,
        *[F.col(f"_new.{c}").alias(c) for c in rest],
        *[F.col(f"_old.{c}").alias(f"before_{c}") for c in rest],
    )


def apply_change_set(old: DataFrame, changes: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """``old`` after one change set, which holds each key at most once."""
    keys = names(key)
    kept = old.join(changes.select(*keys), keys, "left_anti")
    return kept.unionByName(changes.filter(F.col("op") != DELETE).select(*old.columns))


def choose_sync_mode(
    old: DataFrame, new: DataFrame, key: str | Sequence[str], need_seconds: bool = False
) -> DataFrame:
    """One row: how much changed and which way to sync is cheapest.

    Only keys and row hashes are shuffled.
    """
    keys = names(key)
    rest = [c for c in new.columns if c not in keys]
    was = old.select(*keys, row_hash(old, rest).alias("_old"))
    now = new.select(*keys, row_hash(new, rest).alias("_new"))
    differs = ~F.col("_old").eqNullSafe(F.col("_new"))
    counted = was.join(now, keys, "full_outer").agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count(F.when(differs, 1)).alias("changed_rows"),
    )
    share = F.col("changed_rows") / F.nullif(F.col("total_rows"), F.lit(0).cast("bigint"))
    mode = (
        F.when(F.lit(need_seconds), "continuous")
        .when(F.col("churn") > RELOAD_CHURN, "snapshot")
        .otherwise("triggered")
    )
    return counted.withColumn("churn", F.coalesce(share, F.lit(0.0))).withColumn("mode", mode)


def merge_versions(
    state: DataFrame, changes: DataFrame, key: str | Sequence[str], seq: str, op: str = "op"
) -> DataFrame:
    """Fold changes into a state that remembers each key's last change.

    State rows carry ``seq`` and ``op`` and deleted keys stay as markers, so
    batches may come late, out of order or twice.  Newer state wins.
    """
    keys = names(key)
    rest = [c for c in state.columns if c not in keys]
    rank, row = _newest(seq, op), F.struct(*rest)
    held = state.select(*keys, rank.alias("_held"), row.alias("_held_row"))
    last = latest_change(changes, keys, seq, op).select(*keys, rank.alias("_new"), row.alias("_new_row"))
    newer = F.col("_held").isNull() | (F.col("_new") > F.col("_held"))
    winner = F.when(F.col("_new").isNotNull() & newer, F.col("_new_row")).otherwise(F.col("_held_row"))
    both = held.join(last, keys, "full_outer").select(*keys, winner.alias("_row"))
    return both.select(*keys, "_row.*").select(*state.columns)


def restore_rows(live: DataFrame, recovered: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Bring back recovered rows the live table lacks; live rows stay.

    Columns added after the recovery point become null, dropped ones go.
    """
    shared = [c for c in live.columns if c in recovered.columns]
    return insert_ignore(live, recovered.select(*shared), key)


def check_before_image(changes: DataFrame, table: str, before: Sequence[str], op: str = "op") -> DataFrame:
    """Per table, whether every update and delete carries its full old row."""
    needed = F.col(op).isin(UPDATE, DELETE)
    partial = F.lit(False)
    for column in before:
        partial = partial | F.col(column).isNull()
    counted = changes.groupBy(table).agg(
        F.count(F.lit(1)).alias("changes"),
        F.count(F.when(needed & partial, 1)).alias("without_before_image"),
    )
    verdict = F.when(F.col("without_before_image") == 0, "mirrored").otherwise("skipped")
    return counted.withColumn("outcome", verdict)


def with_before_image(changes: DataFrame, table: str, before: Sequence[str], op: str = "op") -> DataFrame:
    """The changes of the tables that may be mirrored."""
    report = check_before_image(changes, table, before, op)
    return changes.join(report.filter(F.col("outcome") == "mirrored").select(table), table, "left_semi")


def mirror_tables(
    log: DataFrame, table: str, key: str | Sequence[str], seq: str, before: Sequence[str], op: str = "op"
) -> tuple[DataFrame, DataFrame]:
    """One mixed change log brought to the live rows of all its tables.

    Returns the rows, with their table's name, and a report with one row per
    table.  A table of which an update or delete lacks part of its old row is
    skipped as a whole and says so in the report.  The log is read once: the
    newest change of each key and the number of changes without their old row
    come out of one aggregate, which is partial on the map side, so a hot
    table or key does not fill a task.  Columns of ``before`` do not come along.
    """
    keys = [table, *names(key)]
    rest = [c for c in log.columns if c not in keys and c not in before]
    partial = F.lit(False)
    for column in before:
        partial = partial | F.col(column).isNull()
    lacking = F.col(op).isin(UPDATE, DELETE) & partial
    newest = log.groupBy(*keys).agg(
        F.max_by(F.struct(*rest), _newest(seq, op)).alias("_row"),
        F.count(F.lit(1)).alias("_changes"),
        F.count(F.when(lacking, 1)).alias("_lacking"),
    )
    newest = filed(newest)
    report = newest.groupBy(table).agg(
        F.sum("_changes").alias("changes"),
        F.sum("_lacking").alias("without_before_image"),
        F.count(F.when(F.col(f"_row.{op}") != DELETE, 1)).alias("live_rows"),
    )
    verdict = F.when(F.col("without_before_image") == 0, "mirrored").otherwise("skipped")
    report = filed(report.withColumn("outcome", verdict))  # a row for each table
    whole = report.filter(F.col("outcome") == "mirrored").select(table)
    live = newest.filter(F.col(f"_row.{op}") != DELETE).join(whole, table, "left_semi")
    kept = [c for c in rest if c not in (seq, op)]
    return live.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in kept]), report
