"""Keyed copies of tables: whole reloads, change sets and streamed changes.

A copy is a folder with numbered full versions, the change batches that came
after the newest one, and a log of the versions that are complete.  A version
counts only once its log row is there, so a job that dies half-way leaves the
previous version in force.  Files of a version are never changed.

Versions are stored in Spark's own buckets by key.  Reading the copy or folding
its changes into a new version shuffles the changes to the buckets and leaves
the state where it is.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import strip_nul
from millrace.operators.changes import (
    DELETE,
    INSERT,
    apply_change_set,
    change_set,
    change_set_by_digest,
    latest_change,
    merge_versions,
)
from millrace.operators.joins import names
from millrace.session import remove_folder

_LOG = "version int, folder string, batch bigint, floor bigint, buckets int"
_NESTED = (T.ArrayType, T.MapType, T.StructType)
# Type names a relational store has no counterpart for.
REFUSED_TYPES = {"geography", "geometry", "variant", "object"}


def to_serving_schema(df: DataFrame) -> DataFrame:
    """Rows as a relational store takes them: nested values as JSON text."""
    refused = [
        f"{f.name} ({f.dataType.simpleString()})"
        for f in df.schema
        if f.dataType.typeName().split("(")[0] in REFUSED_TYPES
    ]
    if refused:
        raise TypeError("no serving type for " + ", ".join(refused))
    return df.select(
        *[
            (F.to_json(f.name) if isinstance(f.dataType, _NESTED) else F.col(f.name)).alias(f.name)
            for f in df.schema
        ]
    )


def _without_nul(value: Column, kind: T.DataType) -> Column:
    """0x00 removed from every text inside a value."""
    if isinstance(kind, T.StringType):
        return strip_nul(value)
    if not isinstance(kind, _NESTED) or not _holds_text(kind):
        return value
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: _without_nul(x, kind.elementType))
    if isinstance(kind, T.MapType):
        # Keys may become equal; the last entry then stays, as in JSON.
        entries = F.transform(
            F.map_entries(value),
            lambda e: F.struct(_without_nul(e["key"], kind.keyType).alias("key"), _without_nul(e["value"], kind.valueType).alias("value")),
        )
        later = F.filter(
            entries, lambda e, i: ~F.exists(F.slice(entries, i + 2, F.size(entries)), lambda other: other["key"] == e["key"])
        )
        return F.map_from_entries(later)
    fields = [_without_nul(value[f.name], f.dataType).alias(f.name) for f in kind.fields]
    return F.when(value.isNotNull(), F.struct(*fields))


def _holds_text(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _holds_text(kind.elementType)
    if isinstance(kind, T.MapType):
        return _holds_text(kind.keyType) or _holds_text(kind.valueType)
    if isinstance(kind, T.StructType):
        return any(_holds_text(f.dataType) for f in kind.fields)
    return isinstance(kind, T.StringType)


def clean_null_bytes(df: DataFrame) -> DataFrame:
    """Remove 0x00 from every text, also inside arrays, maps and structs."""
    return df.select(*[_without_nul(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema])


class ServingCopy:
    """A keyed copy of a table in a shared folder.

    ``ignore`` names columns of the change log that are not the table's, such
    as the time of a change; any other new column reaches the copy.
    ``buckets`` is how many pieces a version is stored in, by default as many
    as Spark shuffles to; later versions keep the number of the first.
    """

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        key: str | Sequence[str],
        seq: str = "seq",
        op: str = "op",
        ignore: Sequence[str] = (),
        buckets: int | None = None,
    ):
        self.spark, self.folder, self.key = spark, folder, names(key)
        self.seq, self.op, self.ignore = seq, op, set(ignore)
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def _current(self):
        try:
            log = self.spark.read.schema(_LOG).parquet(f"{self.folder}/log")
        except AnalysisException:
            return None
        newest = log.agg(F.max_by(F.struct(*log.columns), "version").alias("last"))
        return newest.first().last

    def _table(self, version: int) -> str:
        """A name for a version in the session's catalog, which knows buckets."""
        return f"copy_{hashlib.sha256(self.folder.encode()).hexdigest()[:24]}_{version}"

    def _publish(self, df: DataFrame, batch: int, floor: int | None, dealt: bool = False) -> None:
        """A new version; ``dealt`` rows lie in the buckets' tasks already."""
        last = self._current()
        version = last.version + 1 if last else 0
        buckets = last.buckets if last and last.buckets else self.buckets
        # A name of its own, so that files of an unfinished version do not matter.
        folder = f"{self.folder}/version={version}-{uuid.uuid4().hex[:8]}"
        rows = df if dealt and last and last.buckets else df.repartition(buckets, *self.key)
        self.spark.sql(f"DROP TABLE IF EXISTS {self._table(version)}")
        writer = rows.write.format("parquet").option("path", folder)
        writer.bucketBy(buckets, *self.key).sortBy(*self.key).saveAsTable(self._table(version))
        row = self.spark.createDataFrame([(version, folder, batch, floor, buckets)], _LOG)
        row.coalesce(1).write.mode("append").parquet(f"{self.folder}/log")

    def _state(self) -> DataFrame | None:
        last = self._current()
        if last is None:
            return None
        if not last.buckets:
            return self.spark.read.parquet(last.folder)
        name = self._table(last.version)
        if not self.spark.catalog.tableExists(name):  # another session stored it
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.spark.read.parquet(last.folder).schema)
            keys = ", ".join(f"`{c}`" for c in self.key)
            self.spark.sql(
                f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) "
                f"INTO {last.buckets} BUCKETS LOCATION '{last.folder}'"
            )
        return self.spark.table(name)

    def _changes(self) -> DataFrame | None:
        """All change batches, with every column that any of them has."""
        try:
            read = self.spark.read.option("mergeSchema", "true").parquet(f"{self.folder}/changes")
        except AnalysisException:
            return None
        return read.withColumn("batch", F.col("batch").cast("bigint"))

    def _last(self, column: str) -> int:
        """The highest number among the batches kept and the newest version."""
        current, changes, state = self._current(), self._changes(), self._state()
        found = [changes.agg(F.max(column)).first()[0] if changes is not None else None]
        if column == "batch":
            found.append(current.batch if current else None)
        elif state is not None:
            found.append(state.agg(F.max(column)).first()[0])
        return max((int(x) for x in found if x is not None), default=-1)

    def load(self, rows: DataFrame, seq: int | None = None) -> None:
        """Replace the whole copy (snapshot sync); earlier changes are done with.

        ``seq`` is the last change that the rows already show; without, it is
        the last one the copy was given.  Changes up to it lose from now on,
        also when they are delivered again, and for keys the rows lack.
        """
        if seq is None:
            held = self._current()
            seq = max(self._last(self.seq), -1 if held is None or held.floor is None else held.floor)
        first = rows.withColumn(self.seq, F.lit(seq).cast("bigint")).withColumn(self.op, F.lit(INSERT))
        self._publish(first, self._last("batch"), seq)

    def versions(self, upto_batch: int | None = None) -> DataFrame | None:
        """The newest state of every key, deleted ones included."""
        state = self._state()
        if state is None:
            return None
        changes = self._changes()
        if changes is None:
            return state
        current = self._current()
        later = changes.filter(F.col("batch") > current.batch)
        if upto_batch is not None:
            later = later.filter(F.col("batch") <= upto_batch)
        later = later.drop("batch")
        if current.floor is not None:
            later = later.filter(F.col(self.seq) > current.floor)
        # A column that came with a change is null in rows from before, and the
        # other way round.
        held = {f.name: f.dataType for f in state.schema}
        kinds = held | {f.name: f.dataType for f in later.schema if f.name not in held}

        def filled(df: DataFrame) -> DataFrame:
            has = set(df.columns)
            return df.select(*[(F.col(c) if c in has else F.lit(None)).cast(k).alias(c) for c, k in kinds.items()])

        if current.buckets:  # the changes go to where the state's keys are
            later = later.repartition(current.buckets, *self.key)
        return merge_versions(filled(state), filled(later), self.key, self.seq, self.op)

    def read(self) -> DataFrame:
        """The rows of the copy as of the last published or streamed change."""
        rows = self.versions()
        if rows is None:
            raise ValueError(f"nothing was loaded into {self.folder}")
        return rows.filter(F.col(self.op) != DELETE).drop(self.seq, self.op)

    def append_changes(self, changes: DataFrame, batch: int) -> None:
        """Add one batch of changes; a repeated batch replaces itself.

        Costs as much as the batch, however large the copy is.  Columns that
        the copy does not have yet are kept; none of its own may be missing.
        """
        held = {f.name: f.dataType for f in self._state().schema}
        gone = [c for c in held if c not in changes.columns]
        if gone:
            raise ValueError(f"the changes lack columns of the copy: {', '.join(gone)}")
        taken = [c for c in changes.columns if c in held or c not in self.ignore]
        typed = [F.col(c).cast(held[c]).alias(c) if c in held else F.col(c) for c in taken]
        last = latest_change(changes.select(*typed), self.key, self.seq, self.op)
        last.write.mode("overwrite").parquet(f"{self.folder}/changes/batch={batch}")

    def bring_to(self, rows: DataFrame) -> None:
        """Send only what differs from ``rows`` (triggered sync).

        For copies that no stream feeds: ``seq`` goes on from the last one.
        New columns are null in the old rows; a missing one is an error.
        """
        current = self._current()
        batch = max(self._last("batch"), current.batch) + 1
        seq = max(self._last(self.seq), -1 if current.floor is None else current.floor) + 1
        held = self.read()
        gone = [c for c in held.columns if c not in rows.columns]
        if gone:
            raise ValueError(f"the rows lack columns of the copy: {', '.join(gone)}")
        for field in rows.schema:
            if field.name not in held.columns:
                held = held.withColumn(field.name, F.lit(None).cast(field.dataType))
        changes = change_set_by_digest(held.select(*rows.columns), rows, self.key)
        changes = changes.select(*rows.columns, F.col("op").alias(self.op))
        self.append_changes(changes.withColumn(self.seq, F.lit(seq).cast("bigint")), batch)

    def compact(self, upto_batch: int, forget_before: int | None = None) -> None:
        """Fold the change batches up to one into a new full version.

        A job of its own, beside the stream that brings the changes.  With
        ``forget_before`` the marks of keys deleted before that ``seq`` go;
        changes older than it count as delivered from then on.
        """
        rows, floor = self.versions(upto_batch), self._current().floor
        if forget_before is not None:
            rows = rows.filter((F.col(self.op) != DELETE) | (F.col(self.seq) >= forget_before))
            floor = max(forget_before - 1, -1 if floor is None else floor)
        self._publish(rows, upto_batch, floor, dealt=True)

    def fold(self, forget_before: int | None = None) -> bool:
        """``compact`` all batches but the newest, which a stream may still repeat."""
        current, newest = self._current(), self._last("batch")
        if newest - 1 <= current.batch:
            return False
        self.compact(newest - 1, forget_before)
        return True

    def expire(self, keep: int = 2) -> None:
        """Delete all but the newest ``keep`` versions and the batches that the
        oldest of those holds.  Readers of an older version must have ended."""
        if keep < 1:
            raise ValueError("the newest version must stay")
        log = self.spark.read.schema(_LOG).parquet(f"{self.folder}/log").orderBy("version").collect()
        kept = log[-keep:]
        for old in log[:-keep]:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._table(old.version)}")
            remove_folder(self.spark, old.folder)
        changes = self._changes()
        if changes is not None:
            folded = changes.filter(F.col("batch") <= kept[0].batch).select("batch").distinct()
            for row in folded.toLocalIterator():  # a short list of folders
                remove_folder(self.spark, f"{self.folder}/changes/batch={row.batch}")


def sync_snapshot(rows: DataFrame, copy: ServingCopy, seq: int | None = None) -> None:
    """Reload the whole copy; ``seq`` as in ``ServingCopy.load``."""
    copy.load(to_serving_schema(clean_null_bytes(rows)), seq)


def sync_triggered(rows: DataFrame, copy: ServingCopy) -> None:
    """Bring the copy up to date with the changed rows only."""
    copy.bring_to(to_serving_schema(clean_null_bytes(rows)))


def sync_incremental(old: DataFrame, new: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """The copy ``old`` brought to ``new`` through the change set only."""
    return apply_change_set(old, change_set(old, new, key), key)


def save_snapshot(tables: Mapping[str, DataFrame], name: str, folder: str) -> None:
    """Keep a named copy of a set of tables, listed once all are written."""
    spark = next(iter(tables.values())).sparkSession
    # A folder of its own for each save, so an older listing stays whole.
    target = f"{folder}/{name}/{uuid.uuid4().hex}"
    for table, df in tables.items():
        df.write.parquet(f"{target}/{table}")
    rows = [(name, table, f"{target}/{table}") for table in tables]
    listed = spark.createDataFrame(rows, "snapshot string, table_name string, folder string")
    listed.coalesce(1).write.mode("overwrite").parquet(f"{folder}/_listing/snapshot={name}")


def load_snapshot(spark: SparkSession, name: str, folder: str) -> dict[str, DataFrame]:
    listed = spark.read.parquet(f"{folder}/_listing/snapshot={name}").select("table_name", "folder")
    return {row.table_name: spark.read.parquet(row.folder) for row in listed.toLocalIterator()}
