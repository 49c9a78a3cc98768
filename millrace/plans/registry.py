"""Named queries with the SQL that their results are checked against."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from millrace.plans.shop import Shop, with_views


class Query(NamedTuple):
    build: Callable[[Shop], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a function of the shop under its name."""

    def register(build: Callable[[Shop], DataFrame]):
        QUERIES[name or build.__name__] = Query(build, with_views(sql) if sql else None)
        return build

    return register


def plain_types(df: DataFrame) -> DataFrame:
    """Numbers as both engines print them: bigint and double."""
    small = (T.IntegerType, T.ShortType, T.ByteType)
    columns = []
    for name, kind in ((f"`{f.name}`", f.dataType) for f in df.schema):
        plain = "double" if isinstance(kind, T.DecimalType) else "bigint" if isinstance(kind, small) else None
        columns.append(f"cast({name} as {plain}) as {name}" if plain else name)
    return df.selectExpr(*columns)


def load() -> dict[str, Query]:
    """All queries; importing their modules registers them."""
    from millrace.plans import changes, clickstream, finance, logs, quality, storefront, streams  # noqa: F401

    return QUERIES


def runnable(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return plain_types(load()[name].build(Shop(spark, folder)))

    return run
