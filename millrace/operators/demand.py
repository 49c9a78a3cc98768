"""From raw clickstream to a per-product demand table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import display_name, percent, restock_needed
from millrace.operators.joins import Child, lookup_join, preaggregate_join
from millrace.operators.ordering import number_rows
from millrace.operators.quality import clickstream_rules, keep_valid

EVENT_KEY = ["session_id", "event_type", "product_id", "event_ts"]


def clean_events(bronze: DataFrame) -> DataFrame:
    """Usable events, each once, from an at-least-once feed.

    The rules read only the key columns, so bad rows can go before the
    duplicates do and are never shuffled.
    """
    return keep_valid(bronze.select(*EVENT_KEY), clickstream_rules()).dropDuplicates(EVENT_KEY)


def product_labels(products: DataFrame) -> DataFrame:
    return products.select(
        F.col("id").alias("product_id"), F.col("name").alias("product_name"), "category"
    )


def silver_events(bronze: DataFrame, products: DataFrame) -> DataFrame:
    """Clean events with product name and category; unknown products stay."""
    return lookup_join(clean_events(bronze), product_labels(products), "product_id").select(
        *EVENT_KEY, "product_name", "category"
    )


def funnel_counts() -> list[Column]:
    columns = {"views": "view", "clicks": "click", "add_to_carts": "add_to_cart"}
    return [
        F.count(F.when(F.col("event_type") == kind, 1)).alias(name) for name, kind in columns.items()
    ]


def demand_table(counts: DataFrame, order_items: DataFrame, inventory: DataFrame) -> DataFrame:
    """Rates, sales and stock for the funnel counts of each product."""
    sold = Child(
        order_items,
        "product_id",
        [
            F.sum(F.col("quantity").cast("bigint")).alias("units_sold"),
            F.sum("line_total").alias("revenue"),
        ],
        {"units_sold": 0, "revenue": 0},
    )
    stock = Child(
        inventory,
        "product_id",
        [
            F.sum(F.col("quantity").cast("bigint")).alias("in_stock"),
            F.min("reorder_level").alias("reorder_level"),
        ],
        {"in_stock": 0},
    )
    joined = preaggregate_join(counts, "product_id", [sold, stock])
    carts = F.col("add_to_carts")
    return joined.select(
        "product_id",
        "product_name",
        "category",
        "views",
        "clicks",
        "add_to_carts",
        percent(carts, F.col("views")).alias("cart_rate"),
        "units_sold",
        "revenue",
        # Sales of all time over carts seen: this may exceed 100.
        percent(F.col("units_sold"), carts).alias("conversion_rate"),
        "in_stock",
        "reorder_level",
        restock_needed(F.col("in_stock"), F.col("reorder_level"), carts).alias("restock_needed"),
    )


def _keyed_like(table: DataFrame, key: str, events: DataFrame) -> DataFrame:
    """Events whose product id has the type of another table's key.

    Grouped by such a key, the counts already lie where the joins need them.
    """
    return events.withColumn("product_id", F.col("product_id").cast(table.schema[key].dataType))


def demand_from_silver(silver: DataFrame, order_items: DataFrame, inventory: DataFrame) -> DataFrame:
    """Demand from a stored silver table; of several names the last one wins."""
    counts = _keyed_like(order_items, "product_id", silver).groupBy("product_id").agg(
        F.max("product_name").alias("product_name"),
        F.max("category").alias("category"),
        *funnel_counts(),
    )
    return demand_table(counts, order_items, inventory)


def demand_from_bronze(
    bronze: DataFrame, products: DataFrame, order_items: DataFrame, inventory: DataFrame
) -> DataFrame:
    """Demand straight from raw events.

    Events are counted per product before names are looked up, so the lookup
    joins one row per product instead of one per event.
    """
    counts = _keyed_like(products, "id", clean_events(bronze)).groupBy("product_id").agg(*funnel_counts())
    named = counts.join(product_labels(products), "product_id", "left")
    return demand_table(named, order_items, inventory)


def by_demand() -> list[Column]:
    return [F.desc_nulls_last("views"), F.desc_nulls_last("add_to_carts"), F.asc("product_id")]


def top_demand(demand: DataFrame, n: int = 20) -> DataFrame:
    """The most viewed products."""
    return (
        demand.orderBy(F.desc_nulls_last("views"), F.asc("product_id"))
        .limit(n)
        .select(
            "product_id", "product_name", "category", "views", "clicks", "add_to_carts", "cart_rate",
            "units_sold", "conversion_rate", "in_stock", "restock_needed",
        )
    )


def ranked_demand(demand: DataFrame, parts: int | None = None) -> DataFrame:
    """All products with their display rank and name, most viewed first."""
    numbered = number_rows(demand, by_demand(), "rank", parts=parts)
    zero = F.lit(0)
    return numbered.select(
        "rank",
        "product_id",
        display_name(F.col("product_name"), F.col("product_id")).alias("product"),
        "category",
        *[F.coalesce(F.col(c), zero).alias(c) for c in ("views", "clicks", "add_to_carts")],
        "cart_rate",
        "units_sold",
        "in_stock",
        "restock_needed",
    )


def demand_totals(demand: DataFrame) -> DataFrame:
    return demand.agg(
        F.coalesce(F.sum("views"), F.lit(0)).alias("total_views"),
        F.coalesce(F.sum("add_to_carts"), F.lit(0)).alias("total_add_to_cart"),
        F.count(F.when(F.col("restock_needed"), 1)).alias("restock_count"),
    )


def event_type_counts(events: DataFrame) -> DataFrame:
    return events.groupBy("event_type").agg(F.count(F.lit(1)).alias("events"))


def latest_events(events: DataFrame, n: int = 20, time: str = "event_ts") -> DataFrame:
    """The newest events; the remaining columns settle equal times."""
    ties = [F.asc(c) for c in events.columns if c != time]
    return events.orderBy(F.desc_nulls_last(time), *ties).limit(n)
