"""Numbered full versions of a table, for readers that must name the one they saw."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LOG = "version bigint, folder string"


class Versions:
    """Versions in a shared folder; one counts once its log row is there."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def newest(self) -> int | None:
        try:
            log = self.spark.read.schema(_LOG).parquet(f"{self.folder}/log")
        except AnalysisException:
            return None
        return log.agg(F.max("version")).first()[0]

    def publish(self, df: DataFrame) -> int:
        last = self.newest()
        version = 0 if last is None else last + 1
        folder = f"{self.folder}/{uuid.uuid4().hex}"
        df.write.parquet(folder)
        row = self.spark.createDataFrame([(version, folder)], _LOG)
        row.coalesce(1).write.mode("append").parquet(f"{self.folder}/log")
        return version

    def read(self, version: int) -> DataFrame:
        log = self.spark.read.schema(_LOG).parquet(f"{self.folder}/log")
        found = log.filter(F.col("version") == version).agg(F.max("folder")).first()[0]
        if found is None:
            raise ValueError(f"no version {version} in {self.folder}")
        return self.spark.read.parquet(found)
