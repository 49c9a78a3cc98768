"""A table's history: its change log by day and dated full states.

A moment is rebuilt from the newest state before it and the days of the log
since then; older days are not read.  States and pieces of the log become
visible through one listing row written last.  A piece that brings changes from
before a state (late ones) takes that state out of use until it is saved again.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import moment
from millrace.operators.changes import DELETE, latest_change, merge_versions
from millrace.operators.joins import names

_LISTING = "number bigint, kind string, at timestamp_ntz, folder string"
_STATE, _PIECE = "state", "piece"


class History:
    """Changes with a commit time, kept in a shared folder.

    ``grain`` is the span of a log partition, as ``date_trunc`` names it.
    """

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        key: str | Sequence[str],
        seq: str = "seq",
        time: str = "commit_ts",
        op: str = "op",
        grain: str = "day",
    ):
        self.spark, self.folder, self.key = spark, folder, names(key)
        self.seq, self.time, self.op, self.grain = seq, time, op, grain

    def _listed(self) -> list:
        """One row per state and piece: a short list of folders."""
        try:
            read = self.spark.read.schema(_LISTING).parquet(f"{self.folder}/listing")
        except AnalysisException:
            return []
        return read.orderBy("number").collect()

    def _list(self, kind: str, at: datetime | None, folder: str) -> None:
        listed = self._listed()
        number = listed[-1].number + 1 if listed else 0
        row = self.spark.createDataFrame([(number, kind, at, folder)], _LISTING)
        row.coalesce(1).write.mode("append").parquet(f"{self.folder}/listing")

    def append(self, changes: DataFrame) -> None:
        """Add a piece of the log, cut by the day of the changes."""
        folder = f"{self.folder}/log/{uuid.uuid4().hex}"
        span = F.to_date(F.date_trunc(self.grain, self.time))
        # In ranges, so that a span has few files and a full one several tasks.
        ranged = changes.withColumn("span", span).repartitionByRange("span", *self.key)
        ranged.write.partitionBy("span").parquet(folder)
        earliest = self.spark.read.schema(changes.schema).parquet(folder).agg(F.min(self.time)).first()[0]
        if earliest is not None:
            self._list(_PIECE, earliest, folder)

    def _log(self, after: datetime | None, until: datetime) -> DataFrame | None:
        pieces = [r.folder for r in self._listed() if r.kind == _PIECE and r.at <= until]
        parts = None
        for folder in pieces:
            part = self.spark.read.parquet(folder)
            parts = part if parts is None else parts.unionByName(part, allowMissingColumns=True)
        if parts is None:
            return None
        end = F.to_date(F.date_trunc(self.grain, moment(until)))
        inside = (F.col("span") <= end) & (F.col(self.time) <= moment(until))
        if after is not None:
            start = F.to_date(F.date_trunc(self.grain, moment(after)))
            inside &= (F.col("span") >= start) & (F.col(self.time) > moment(after))
        return parts.filter(inside).drop("span")

    def _nearest(self, when: datetime):
        """The newest state up to a moment that no later piece has outdated."""
        listed = self._listed()
        usable = [
            s
            for s in listed
            if s.kind == _STATE
            and s.at <= when
            and not any(p.kind == _PIECE and p.number > s.number and p.at <= s.at for p in listed)
        ]
        return max(usable, key=lambda s: (s.at, s.number), default=None)

    def versions_at(self, when: datetime) -> DataFrame | None:
        """The newest change of every key up to a moment, deletions included."""
        state = self._nearest(when)
        log = self._log(state.at if state else None, when)
        if state is None:
            return None if log is None else latest_change(log, self.key, self.seq, self.op)
        held = self.spark.read.parquet(state.folder)
        if log is None:
            return held
        kinds = {f.name: f.dataType for f in held.schema} | {f.name: f.dataType for f in log.schema}

        def filled(df: DataFrame) -> DataFrame:
            has = set(df.columns)
            return df.select(*[(F.col(c) if c in has else F.lit(None).cast(k)).alias(c) for c, k in kinds.items()])

        return merge_versions(filled(held), filled(log), self.key, self.seq, self.op)

    def save_state(self, when: datetime) -> None:
        """Keep the full state at a moment, for later questions.

        Changes that happen at that very moment and come later outdate it.
        """
        found = self.versions_at(when)
        if found is None:
            raise ValueError(f"no change up to {when} in {self.folder}")
        folder = f"{self.folder}/states/{uuid.uuid4().hex}"
        found.write.parquet(folder)
        self._list(_STATE, when, folder)

    def as_of(self, when: datetime) -> DataFrame:
        """The table at a moment."""
        found = self.versions_at(when)
        if found is None:
            raise ValueError(f"no change up to {when} in {self.folder}")
        return found.filter(F.col(self.op) != DELETE).drop(self.op, self.seq, self.time)


def moments(first: datetime, last: datetime, every: timedelta) -> list[datetime]:
    """Evenly spaced moments at which states are worth keeping."""
    out = [first]
    while out[-1] + every <= last:
        out.append(out[-1] + every)
    return out
