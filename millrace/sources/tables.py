"""Catalog tables: declare, fill, replace, find."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import remove_folder

# Names a synced copy may have, best first, and the word any
# other name must contain.
PROMOTION_TABLES = (("promotions_synced_prod", "promotions"), "promotions")
DEMAND_TABLES = (
    ("product_demand_synced_prod", "product_demand_synced", "product_demand"),
    "product_demand",
)


def create_table(spark: SparkSession, name: str, schema: T.StructType, comment: str = "") -> None:
    """Declare an empty table unless it exists."""
    if not spark.catalog.tableExists(name):
        spark.createDataFrame([], schema).write.format("parquet").saveAsTable(name)
        if comment:
            comment_on(spark, name, comment)


def recreate(spark: SparkSession, name: str, schema: T.StructType, comment: str = "") -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    create_table(spark, name, schema, comment)


def comment_on(spark: SparkSession, name: str, text: str) -> None:
    quoted = text.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"COMMENT ON TABLE {name} IS '{quoted}'")


def rows_to_df(
    spark: SparkSession, rows: Iterable[Sequence[Any]], schema: T.StructType | Sequence[str]
) -> DataFrame:
    """Literal rows, with declared types or with names only."""
    return spark.createDataFrame(list(rows), schema)


def _described(spark: SparkSession, name: str) -> dict[str, str]:
    return {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}


def _list_of(text: str) -> list[str]:
    return [c.strip().strip("`") for c in text.strip("[]").split(",") if c.strip()]


def overwrite(df: DataFrame, name: str) -> None:
    """Replace a table's rows; ``df`` may read that very table.

    The rows are written to a new folder, in the table's buckets if it has
    any, and one catalog call points the table there: a stop at any time leaves
    the old or the new rows.  Comment and buckets stay.  New columns are
    declared before that and are null in the old rows.  A table that loses
    columns or gets other types is written beside the old one and renamed,
    which takes two calls.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        df.write.format("parquet").saveAsTable(name)
        return
    held = {f.name: f.dataType for f in spark.table(name).schema}
    given = {f.name: f.dataType for f in df.schema}
    if any(given.get(c) != kind for c, kind in held.items()):
        staging = f"{name}__staging"
        spark.sql(f"DROP TABLE IF EXISTS {staging}")
        df.write.format("parquet").saveAsTable(staging)
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"ALTER TABLE {staging} RENAME TO {name}")
        return
    facts = _described(spark, name)
    folder = f"{facts['Location'].rstrip('/')}-{uuid.uuid4().hex[:8]}"
    new = [c for c in given if c not in held]
    writer = df.select(*held, *new).write.format("parquet")
    if facts.get("Num Buckets", "-1") not in ("-1", "0"):
        first, *others = _list_of(facts["Bucket Columns"])
        writer = writer.bucketBy(int(facts["Num Buckets"]), first, *others)
        if ordered := _list_of(facts.get("Sort Columns", "")):
            writer = writer.sortBy(*ordered)
        # Buckets need a table; dropping that leaves its files.
        staging = f"{name}__staging"
        spark.sql(f"DROP TABLE IF EXISTS {staging}")
        writer.option("path", folder).saveAsTable(staging)
        spark.sql(f"DROP TABLE {staging}")
    else:
        writer.save(folder)
    if new:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(f'`{c}` {given[c].simpleString()}' for c in new)})")
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
    spark.catalog.refreshTable(name)
    remove_folder(spark, facts["Location"])


def store_keyed(df: DataFrame, name: str, key: str | Sequence[str], buckets: int) -> None:
    """Store a table bucketed and sorted by its key.

    Two tables stored alike are compared, merged or joined on the key without
    a shuffle of either.
    """
    first, *others = [key] if isinstance(key, str) else list(key)
    bucketed = df.repartition(buckets, first, *others).write.format("parquet").mode("overwrite")
    bucketed.bucketBy(buckets, first, *others).sortBy(first, *others).saveAsTable(name)


def append(df: DataFrame, name: str) -> None:
    df.select(*df.sparkSession.table(name).columns).write.mode("append").saveAsTable(name)


def table_or_else(
    spark: SparkSession, name: str, fallback: Callable[[SparkSession], DataFrame]
) -> DataFrame:
    """The table, or the fallback's rows stored under its name."""
    if not spark.catalog.tableExists(name):
        fallback(spark).write.format("parquet").saveAsTable(name)
    return spark.table(name)


def resolve_table(columns: DataFrame, preferred: Sequence[str], token: str) -> DataFrame:
    """The first preferred name that exists, else the first that has the token.

    ``columns`` has one row per ``table_name`` and ``column_name``.  Returns one
    row, whose ``table_name`` is null when nothing fits.
    """
    rank = F.lit(None).cast("int")
    for place, name in reversed(list(enumerate(preferred))):
        rank = F.when(F.col("table_name") == name, place).otherwise(rank)
    other = F.when(F.contains(F.lower("table_name"), F.lit(token)), len(preferred))
    named = columns.select("table_name", F.coalesce(rank, other).alias("_rank"))
    fitting = named.filter(F.col("_rank").isNotNull())
    return fitting.agg(
        F.min_by("table_name", F.struct("_rank", "table_name")).alias("table_name")
    )


def feature_flags(columns: DataFrame) -> DataFrame:
    """One row of flags: which shop features the tables at hand allow."""
    table, column = F.col("table_name"), F.col("column_name")

    def any_row(test):
        return F.coalesce(F.bool_or(test), F.lit(False))

    def has_table(name):
        return any_row(table == name)

    def has_column(owner, name):
        return any_row((table == owner) & (column == name))

    def has_word(word):
        return any_row(F.contains(F.lower(table), F.lit(word)))

    return columns.agg(
        has_table("reviews").alias("reviews_active"),
        (has_table("loyalty_members") & has_column("customers", "loyalty_points")).alias("loyalty_active"),
        has_table("exchange_rates").alias("exchange_rates_active"),
        has_column("orders", "priority").alias("order_priority_active"),
        has_column("customers", "email_verified").alias("email_verified_active"),
        has_table("orders").alias("orders_available"),
        has_table("order_items").alias("order_items_available"),
        has_word(PROMOTION_TABLES[1]).alias("promotions_active"),
        has_word(DEMAND_TABLES[1]).alias("demand_active"),
    )
