"""Currencies and campaign attribution."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import in_usd
from millrace.operators.evolve import require_not_null
from millrace.operators.joins import lookup_join
from millrace.operators.ordering import number_rows


def orders_usd(orders: DataFrame, customers: DataFrame, products: DataFrame, rates: DataFrame) -> DataFrame:
    """Orders with customer, product and total in US dollars."""
    people = customers.select(F.col("id").alias("customer_id"), F.col("name").alias("customer"))
    goods = products.select(F.col("id").alias("product_id"), F.col("name").alias("product"))
    money = rates.select(F.col("currency_code").alias("currency"), "rate_to_usd")
    joined = lookup_join(orders, money, "currency", "inner")
    joined = lookup_join(joined, goods, "product_id", "inner")
    joined = lookup_join(joined, people, "customer_id", "inner")
    return joined.select(
        "id",
        "customer",
        "product",
        "quantity",
        "total",
        "currency",
        "rate_to_usd",
        in_usd(F.col("total"), F.col("rate_to_usd")).alias("total_usd"),
    )


def rate_usage(rates: DataFrame, orders: DataFrame) -> DataFrame:
    """The rate list, with the number of orders in each currency."""
    used = orders.groupBy(F.col("currency").alias("currency_code")).agg(
        F.count(F.lit(1)).alias("orders")
    )
    return (
        rates.select("currency_code", "currency_name", "rate_to_usd")
        .join(used, "currency_code", "left")
        .fillna({"orders": 0})
        .orderBy("currency_code")
    )


def migrate_currency(orders: DataFrame, rates: DataFrame) -> DataFrame:
    """Replace the currency code by the id of its rate; every code must exist."""
    ids = rates.select(F.col("currency_code").alias("currency"), F.col("id").alias("currency_id"))
    return require_not_null(lookup_join(orders, ids, "currency"), "currency_id").drop("currency")


def attribution(orders: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Orders and revenue per campaign, dealing customers out in turn.

    Orders are summed per share first, so a campaign's share, however large,
    reaches the join as one row.  Highest revenue first.
    """
    indexed = number_rows(campaigns, [F.asc("campaign"), F.asc("utm_source")], "share", 0)
    how_many = campaigns.agg(F.count(F.lit(1))).scalar()
    shares = (
        orders.withColumn("share", F.col("customer_id") % how_many)
        .groupBy("share")
        .agg(
            F.count("id").alias("attributed_orders"),
            F.round(F.sum("total"), 2).alias("attributed_revenue"),
        )
    )
    ranked = [F.desc("attributed_revenue"), F.asc("campaign"), F.asc("utm_source")]
    return (
        indexed.join(shares, "share")
        .select("campaign", "utm_source", "attributed_orders", "attributed_revenue")
        .orderBy(*ranked)
    )
