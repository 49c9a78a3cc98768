"""Tables of a relational store, read live or written in bulk through JDBC."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Connections one table uses unless told otherwise.
DEFAULT_CONNECTIONS = 16


def foreign_catalog(spark: SparkSession, name: str, url: str, driver: str, **options: str) -> None:
    """Register a store as a catalog; its tables are then ``name.schema.table``.

    Spark pushes projections, filters, limits and aggregates to the store.
    """
    prefix = f"spark.sql.catalog.{name}"
    settings = {
        "url": url,
        "driver": driver,
        "pushDownAggregate": "true",
        "pushDownLimit": "true",
        **options,
    }
    spark.conf.set(prefix, "org.apache.spark.sql.execution.datasources.v2.jdbc.JDBCTableCatalog")
    for option, value in settings.items():
        spark.conf.set(f"{prefix}.{option}", value)


def federated_table(spark: SparkSession, catalog: str, table: str) -> DataFrame:
    """A live, read-only table of a registered store."""
    return spark.table(f"{catalog}.{table}")


def partition_options(key: str, lowest: int, highest: int, parts: int) -> dict[str, str]:
    """Reader options that split a table by ranges of a numeric key."""
    return {
        "partitionColumn": key,
        "lowerBound": str(lowest),
        "upperBound": str(highest + 1),
        "numPartitions": str(max(1, parts)),
    }


def read_remote(
    spark: SparkSession,
    url: str,
    table: str,
    key: str,
    parts: int = DEFAULT_CONNECTIONS,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Read a table in parallel ranges of its key; no row passes the driver.

    Only the key's bounds are asked for first, which the store answers from
    its index.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**(options or {}))
    bounds = reader.load().agg(F.min(key).alias("low"), F.max(key).alias("high")).first()
    if bounds.low is None:
        return reader.load()
    return reader.options(**partition_options(key, int(bounds.low), int(bounds.high), parts)).load()


def write_remote(
    df: DataFrame, url: str, table: str, connections: int = DEFAULT_CONNECTIONS, options: Mapping[str, str] | None = None
) -> None:
    """Replace the rows of a remote table, keeping its definition."""
    settings = {
        "url": url,
        "dbtable": table,
        "truncate": "true",
        "numPartitions": str(connections),
        **(options or {}),
    }
    df.write.format("jdbc").options(**settings).mode("overwrite").save()
