"""Promotions, carts and checkout."""

from __future__ import annotations

from datetime import datetime
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import effective_price, loyalty_points, moment, sale_price
from millrace.operators.joins import lookup_join
from millrace.operators.ordering import continue_ids, running_totals
from millrace.session import pin


def with_sale_price(promotions: DataFrame, products: DataFrame) -> DataFrame:
    """Promotions with the price their discount gives; null for no product."""
    prices = products.select(F.col("id").alias("product_id"), F.col("price").alias("_price"))
    priced = promotions.join(prices, "product_id", "left")
    return priced.withColumn("sale_price", sale_price(F.col("_price"), F.col("discount_pct"))).drop("_price")


def active_promotions(promotions: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Promotions switched on; with ``as_of`` also inside their dates."""
    live = promotions.filter(F.col("is_active"))
    if as_of is None:
        return live
    started = F.coalesce(F.col("start_date") <= moment(as_of), F.lit(True))
    running = F.coalesce(F.col("end_date") >= moment(as_of), F.lit(True))
    return live.filter(started & running)


def best_promotion(promotions: DataFrame) -> DataFrame:
    """One active promotion per product: the highest discount, then the lowest id."""
    best = F.max_by(
        F.struct("badge_text", "discount_pct", "sale_price"),
        F.struct(F.col("discount_pct"), -F.col("id")),
    )
    return (
        active_promotions(promotions)
        .groupBy("product_id")
        .agg(best.alias("_promo"))
        .select("product_id", "_promo.*")
    )


def overlay_promotions(products: DataFrame, promotions: DataFrame | None, key: str = "id") -> DataFrame:
    """Products with their promotion's badge, discount and price, or nulls."""
    if promotions is None:
        none = F.lit(None)
        return products.select(
            "*",
            none.cast("string").alias("badge_text"),
            none.cast("decimal(5,2)").alias("discount_pct"),
            none.cast("decimal(10,2)").alias("sale_price"),
        )
    promo = best_promotion(promotions).withColumnRenamed("product_id", key)
    return products.join(promo, key, "left")


def stock_levels(inventory: DataFrame) -> DataFrame:
    """Stock per product over all warehouses."""
    return inventory.groupBy("product_id").agg(F.sum(F.col("quantity").cast("bigint")).alias("stock"))


def price_list(products: DataFrame, inventory: DataFrame, promotions: DataFrame | None = None) -> DataFrame:
    """One row per product: list price, stock and promotion."""
    listed = products.select(F.col("id").alias("product_id"), "name", "price", "category")
    listed = listed.join(stock_levels(inventory), "product_id", "left").fillna({"stock": 0})
    return overlay_promotions(listed, promotions, "product_id")


def priced_lines(carts: DataFrame, prices: DataFrame) -> DataFrame:
    """Cart lines at the price shown in the cart; unknown products drop out.

    ``carts`` has one row per ``customer_id`` and ``product_id`` with a
    ``quantity``.
    """
    unit = effective_price(F.col("sale_price"), F.col("price"))
    return (
        lookup_join(carts, prices, "product_id", "inner")
        .withColumn("unit_price", unit)
        .select(
            "customer_id",
            "product_id",
            "name",
            "category",
            "price",
            "sale_price",
            "badge_text",
            "discount_pct",
            "unit_price",
            F.col("quantity").alias("cart_quantity"),
            F.round(F.col("unit_price") * F.col("quantity"), 2).alias("line_total"),
            "stock",
            (F.col("stock") >= F.col("quantity")).alias("in_stock"),
            (loyalty_points(F.col("unit_price")) * F.col("quantity")).alias("points_earned"),
        )
    )


def cart_totals(
    carts: DataFrame,
    prices: DataFrame,
    customers: DataFrame | None = None,
    members: DataFrame | None = None,
) -> DataFrame:
    """Subtotal, points and item count of each cart, with the loyalty tier.

    The item count covers every line, also those of unknown products.
    """
    unit = effective_price(F.col("sale_price"), F.col("price"))
    lines = lookup_join(carts, prices, "product_id").withColumn("unit_price", unit)
    cost = F.round(F.col("unit_price") * F.col("quantity"), 2)
    points = loyalty_points(F.col("unit_price")) * F.col("quantity")
    totals = (
        lines.groupBy("customer_id")
        .agg(
            F.sum("quantity").alias("item_count"),
            F.sum(cost).alias("subtotal"),
            F.sum(points).alias("points_earned"),
        )
        .fillna({"subtotal": 0, "points_earned": 0})
    )
    if customers is None or members is None:
        return totals
    tiers = customers.select(F.col("id").alias("customer_id"), "email").join(
        members.select("email", F.col("tier").alias("loyalty_tier")), "email"
    )
    return totals.join(tiers.drop("email"), "customer_id", "left")


def reserve_stock(inventory: DataFrame, demand: DataFrame) -> DataFrame:
    """Take each product's demand from its stock, but only where it suffices.

    ``demand`` may hold many rows per product.  ``unmet`` is the part that was
    not taken.
    """
    wanted = demand.groupBy("product_id").agg(F.sum("quantity").cast("bigint").alias("_wanted"))
    asked = F.coalesce(F.col("_wanted"), F.lit(0).cast("bigint"))
    enough = F.col("quantity") >= asked
    columns = [c for c in inventory.columns if c != "quantity"]
    return inventory.join(wanted, "product_id", "left").select(
        *columns,
        F.when(enough, F.col("quantity") - asked).otherwise(F.col("quantity")).cast("bigint").alias("quantity"),
        F.when(enough, F.lit(0)).otherwise(asked).cast("bigint").alias("unmet"),
    )


def award_points(customers: DataFrame, points: DataFrame) -> DataFrame:
    """Add earned points, any number of rows per customer, to the balances."""
    earned = points.groupBy(F.col("customer_id").alias("id")).agg(F.sum("points").alias("_earned"))
    balance = F.col("loyalty_points") + F.coalesce(F.col("_earned"), F.lit(0).cast("bigint"))
    return (
        customers.join(earned, "id", "left")
        .withColumn("loyalty_points", balance)
        .select(*customers.columns)
    )


class Checkout(NamedTuple):
    """What a batch of checkouts leaves behind."""

    orders: DataFrame
    rejected: DataFrame
    inventory: DataFrame
    points: DataFrame


class PlacedOrders(NamedTuple):
    orders: DataFrame
    order_items: DataFrame


def place_orders(checkout: Checkout, held_orders: DataFrame) -> PlacedOrders:
    """The new orders with ids that go on from the held ones, and their lines.

    A cart becomes one order, with one line, per product.
    """
    order = [F.asc(c) for c in ("order_date", "customer_id", "product_id")]
    orders = continue_ids(checkout.orders, order, held_orders)
    lines = orders.select(
        F.col("id").alias("order_id"),
        "product_id",
        "quantity",
        "unit_price",
        F.col("total").alias("line_total"),
    )
    return PlacedOrders(orders.drop("unit_price"), lines)


def _short(lines: DataFrame) -> DataFrame:
    """The carts with a line that does not fit behind all earlier demand.

    One running total per product, over the carts in the order of their times:
    the number of shuffles is fixed, however many carts share a product.
    """
    order = [F.asc("placed_at"), F.asc("customer_id")]
    asked = running_totals(lines, "product_id", order, {"_asked": F.col("quantity")})
    fits = F.bool_and(F.col("_asked") <= F.col("stock"))
    return asked.groupBy("customer_id").agg(fits.alias("fits")).filter(~F.col("fits")).select("customer_id")


def checkout_batch(
    carts: DataFrame,
    products: DataFrame,
    inventory: DataFrame,
    promotions: DataFrame | None = None,
) -> Checkout:
    """Check out many carts, oldest cart first; stock is never oversold.

    ``carts`` has one row per ``customer_id`` and ``product_id`` with
    ``quantity`` and ``added_at``; a cart's time is that of its last addition.
    A cart is rejected as a whole when a product is unknown, or short once all
    earlier carts are counted, whether those go through or not; only carts
    that ask for more than there is at all do not count.  Orders are charged at list price, or at the cart's promotion price
    when ``promotions`` is given.  Products whose stock covers all demand need
    no order among carts; only lines of the others are ranked.
    """
    prices = price_list(products, inventory, promotions)
    unit = effective_price(F.col("sale_price"), F.col("price"))
    placed = carts.groupBy("customer_id").agg(F.max("added_at").alias("placed_at"))
    lines = pin(
        lookup_join(carts.select("customer_id", "product_id", "quantity"), prices, "product_id")
        .join(placed, "customer_id")
        .select(
            "customer_id",
            "placed_at",
            "product_id",
            F.col("quantity").cast("bigint").alias("quantity"),
            unit.alias("unit_price"),
            F.coalesce(F.col("stock"), F.lit(-1).cast("bigint")).alias("stock"),
        )
    )
    hopeless = lines.filter(F.col("quantity") > F.col("stock")).select("customer_id").distinct()
    possible = lines.join(hopeless, "customer_id", "left_anti")
    demand = possible.groupBy("product_id").agg(
        F.sum("quantity").alias("_demand"), F.max("stock").alias("_stock")
    )
    scarce = demand.filter(F.col("_demand") > F.col("_stock")).select("product_id")
    disputed = pin(
        possible.join(scarce, "product_id", "left_semi").select(
            "customer_id", "placed_at", "product_id", "quantity", "stock"
        )
    )
    refused = _short(disputed).unionByName(hopeless)
    accepted = lines.join(refused, "customer_id", "left_anti")
    orders = accepted.select(
        "customer_id",
        "product_id",
        "quantity",
        "unit_price",
        F.round(F.col("unit_price") * F.col("quantity"), 2).alias("total"),
        F.lit("USD").alias("currency"),
        F.lit("pending").alias("status"),
        F.col("placed_at").alias("order_date"),
    )
    rejected = (
        lines.join(refused, "customer_id", "left_semi")
        .groupBy("customer_id")
        .agg(F.count(F.lit(1)).alias("lines"), F.sum("quantity").alias("items"))
    )
    earned = loyalty_points(F.col("unit_price")) * F.col("quantity")
    points = orders.groupBy("customer_id").agg(F.sum(earned).alias("points"))
    return Checkout(orders, rejected, reserve_stock(inventory, orders), points)


