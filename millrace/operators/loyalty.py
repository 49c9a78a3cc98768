"""Loyalty points, membership and priorities."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import loyalty_points, loyalty_tier, moment, order_priority
from millrace.operators.evolve import update_where
from millrace.operators.joins import insert_ignore, one_per_key


def backfill_points(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Customers with the points of all their orders, 0 without any."""
    earned = orders.groupBy(F.col("customer_id").alias("id")).agg(
        F.sum(loyalty_points(F.col("total"))).alias("loyalty_points")
    )
    return (
        customers.drop("loyalty_points").join(earned, "id", "left").fillna({"loyalty_points": 0})
    )


def enroll_members(
    customers: DataFrame, now: datetime, members: DataFrame | None = None
) -> DataFrame:
    """Enrol every customer with points who is not a member yet.

    Members are known by their email, so a replay enrols nobody twice.
    """
    fresh = customers.filter(F.col("loyalty_points") > 0).select(
        "email",
        loyalty_tier(F.col("loyalty_points")).alias("tier"),
        moment(now).alias("enrolled_at"),
        F.col("loyalty_points").alias("total_earned"),
    )
    return one_per_key(fresh, "email") if members is None else insert_ignore(members, fresh, "email")


def leaderboard(customers: DataFrame, n: int = 10) -> DataFrame:
    """The members with the most points."""
    return (
        customers.filter(F.col("loyalty_points") > 0)
        .orderBy(F.desc("loyalty_points"), F.asc("id"))
        .limit(n)
        .select("id", "name", loyalty_tier(F.col("loyalty_points")).alias("tier"), "loyalty_points")
    )


def with_priority(orders: DataFrame) -> DataFrame:
    return orders.withColumn("priority", order_priority(F.col("total")))


def priority_distribution(orders: DataFrame) -> DataFrame:
    mean = F.round(F.sum("total").cast("double") / F.count(F.lit(1)), 2)
    return (
        with_priority(orders)
        .groupBy("priority")
        .agg(F.count(F.lit(1)).alias("orders"), mean.alias("avg_total"))
    )


def verify_every_third(customers: DataFrame) -> DataFrame:
    """Mark every third customer's email as verified, all others as not."""
    unverified = customers.withColumn("email_verified", F.lit(False))
    return update_where(unverified, F.col("id") % 3 == 0, {"email_verified": F.lit(True)})


def verified_counts(customers: DataFrame) -> DataFrame:
    return customers.groupBy("email_verified").agg(F.count(F.lit(1)).alias("customers"))
