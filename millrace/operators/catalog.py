"""Storefront and order questions, answered for all keys at once.

A short list, such as a page or a top eight, is settled first and pinned: the
expensive ranking then runs once, and the child tables are read for the listed
products only.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import contains_text, loyalty_points
from millrace.operators.joins import lookup_join, select_available, where_all
from millrace.operators.ordering import latest_per_key, page
from millrace.operators.pricing import active_promotions, overlay_promotions, stock_levels
from millrace.session import pin


def _average() -> Column:
    return F.round(F.avg("rating"), 1).alias("avg_rating")


def product_rating(reviews: DataFrame) -> DataFrame:
    """Average rating and number of reviews per reviewed product."""
    return reviews.groupBy("product_id").agg(_average(), F.count(F.lit(1)).alias("review_count"))


def _of(child: DataFrame | None, chosen: DataFrame) -> DataFrame | None:
    """The rows of a child table that belong to a few chosen products."""
    if child is None:
        return None
    return child.join(chosen.select(F.col("id").alias("product_id")), "product_id", "left_semi")


def _with_rating(products: DataFrame, reviews: DataFrame | None) -> DataFrame:
    """Rating and number of reviews; zero for unreviewed, or without reviews."""
    if reviews is None:
        none = {"avg_rating": F.lit(0.0), "review_count": F.lit(0).cast("bigint")}
        return products.withColumns(none)
    ratings = product_rating(reviews).withColumnRenamed("product_id", "id")
    return products.join(ratings, "id", "left").fillna({"avg_rating": 0.0, "review_count": 0})


def _with_points(products: DataFrame) -> DataFrame:
    return products.withColumn("loyalty_points_earned", loyalty_points(F.col("price")))


def _with_stock(products: DataFrame, inventory: DataFrame) -> DataFrame:
    stock = stock_levels(inventory).withColumnRenamed("product_id", "id")
    return products.join(stock, "id", "left").fillna({"stock": 0})


def catalog_filter(products: DataFrame, category: str = "", search: str = "") -> DataFrame:
    return where_all(
        products,
        [
            F.col("category") == category if category else None,
            contains_text(F.col("name"), search) if search else None,
        ],
    )


def catalog_page(
    products: DataFrame,
    inventory: DataFrame,
    reviews: DataFrame | None = None,
    promotions: DataFrame | None = None,
    category: str = "",
    search: str = "",
    limit: int = 50,
    offset: int = 0,
) -> DataFrame:
    """One page of the catalog with stock, rating, points and promotion.

    The page is cut from the products first; the child tables are then read
    only for the products on it.  ``total`` counts all matching products.
    Reviews and promotions may not exist yet.  Runs the jobs that cut the page
    and count the matches.
    """
    matching = catalog_filter(products, category, search).select("id", "name", "price", "category")
    shown = pin(page(matching, [F.asc("id")], limit, offset))
    cards = _with_rating(_with_stock(shown, _of(inventory, shown)), _of(reviews, shown))
    cards = _with_points(overlay_promotions(cards, _of(promotions, shown)))
    return cards.withColumn("total", matching.agg(F.count(F.lit(1))).scalar()).orderBy("id")


def categories(products: DataFrame) -> DataFrame:
    return products.select("category").distinct().orderBy("category")


def store_totals(products: DataFrame, approximate: bool = False) -> DataFrame:
    different = F.approx_count_distinct if approximate else F.count_distinct
    return products.agg(
        F.count(F.lit(1)).alias("total_products"), different("category").alias("total_categories")
    )


def product_detail(
    products: DataFrame,
    inventory: DataFrame,
    reviews: DataFrame | None = None,
    promotions: DataFrame | None = None,
) -> DataFrame:
    """Every product with its stock per warehouse, rating and promotion."""
    place = inventory.select(F.col("product_id").alias("id"), "quantity", "warehouse", "reorder_level")
    detail = (
        products.select("id", "name", "price", "category")
        .join(place, "id", "left")
        .withColumnRenamed("quantity", "stock")
        .fillna({"stock": 0})
    )
    return overlay_promotions(_with_points(_with_rating(detail, reviews)), promotions)


def latest_reviews(reviews: DataFrame, customers: DataFrame, n: int = 20) -> DataFrame:
    """The newest reviews of every product, with the reviewer's name."""
    newest = latest_per_key(reviews, "product_id", [F.desc_nulls_last("review_date"), F.asc("id")], n)
    people = customers.select(F.col("id").alias("customer_id"), F.col("name").alias("reviewer"))
    shown = [c for c in ("rating", "comment", "review_date") if c in reviews.columns]
    named = lookup_join(newest, people, "customer_id", "inner")
    return named.select("product_id", "position", "id", *shown, "reviewer")


def top_rated(
    products: DataFrame,
    inventory: DataFrame,
    reviews: DataFrame,
    promotions: DataFrame | None = None,
    least_reviews: int = 2,
    n: int = 8,
) -> DataFrame:
    """Best average among products with enough reviews, best first; runs the job that picks them."""
    ratings = product_rating(reviews).filter(F.col("review_count") >= least_reviews)
    rated = products.select("id", "name", "price", "category").join(
        ratings.withColumnRenamed("product_id", "id"), "id"
    )
    order = [F.desc("avg_rating"), F.desc("review_count"), F.asc("id")]
    best = pin(rated.orderBy(*order).limit(n))
    cards = _with_stock(best, _of(inventory, best))
    return _with_points(overlay_promotions(cards, _of(promotions, best))).orderBy(*order)


def best_sellers(
    products: DataFrame,
    inventory: DataFrame,
    order_items: DataFrame,
    reviews: DataFrame | None = None,
    promotions: DataFrame | None = None,
    n: int = 8,
) -> DataFrame:
    """Most units sold, in that order; sales and reviews are summed apart, then
    joined.  Runs the job that picks the products."""
    sold = order_items.groupBy(F.col("product_id").alias("id")).agg(
        F.sum(F.col("quantity").cast("bigint")).alias("units_sold")
    )
    selling = products.select("id", "name", "price", "category").join(sold, "id")
    order = [F.desc("units_sold"), F.asc("id")]
    best = pin(selling.orderBy(*order).limit(n))
    cards = _with_rating(_with_stock(best, _of(inventory, best)), _of(reviews, best))
    return _with_points(overlay_promotions(cards.drop("review_count"), _of(promotions, best))).orderBy(*order)


def promo_deals(products: DataFrame, inventory: DataFrame, promotions: DataFrame, n: int = 8) -> DataFrame:
    """The deepest active discounts, in that order; runs the job that picks them."""
    deals = active_promotions(promotions).select(
        F.col("id").alias("promotion_id"),
        F.col("product_id").alias("id"),
        "badge_text",
        "discount_pct",
        "sale_price",
    )
    offered = products.select("id", "name", "price", "category").join(deals, "id")
    order = [F.desc("discount_pct"), F.asc("promotion_id")]
    best = pin(offered.orderBy(*order).limit(n))
    return _with_points(_with_stock(best, _of(inventory, best))).orderBy(*order)


def order_history(orders: DataFrame, products: DataFrame, customer_id: int | None = None) -> DataFrame:
    """Orders with the product's name; one customer's newest first."""
    labels = products.select(F.col("id").alias("product_id"), F.col("name").alias("product"))
    wanted = orders if customer_id is None else orders.filter(F.col("customer_id") == customer_id)
    columns = ["id", "customer_id", "product", "quantity", "total", "currency", "order_date", "status"]
    if "priority" in orders.columns:
        columns.append("priority")
    history = lookup_join(wanted, labels, "product_id", "inner").select(*columns)
    if customer_id is None:
        return history
    return history.orderBy(F.desc("order_date"), F.asc("id"))


def order_headers(orders: DataFrame, customers: DataFrame) -> DataFrame:
    people = customers.select(F.col("id").alias("customer_id"), F.col("name").alias("customer"))
    columns = ["id", "customer_id", "customer", "order_date", "status", "total", "currency"]
    if "priority" in orders.columns:
        columns.append("priority")
    return lookup_join(orders, people, "customer_id", "inner").select(*columns)


def order_lines(order_items: DataFrame, products: DataFrame) -> DataFrame:
    labels = products.select(F.col("id").alias("product_id"), F.col("name").alias("product"))
    return lookup_join(order_items, labels, "product_id", "inner")


def account_profile(customers: DataFrame, members: DataFrame | None = None) -> DataFrame:
    """Profiles with whichever optional fields exist."""
    optional: Mapping[str, Column] = {
        "loyalty_points": F.lit(None).cast("bigint"),
        "email_verified": F.lit(None).cast("boolean"),
    }
    profile = select_available(customers, ["id", "name", "email"], optional)
    if members is None:
        return profile
    loyalty = members.select(
        "email",
        F.col("tier").alias("loyalty_tier"),
        F.col("total_earned").alias("loyalty_total_earned"),
    )
    return profile.join(loyalty, "email", "left")


def order_status_distribution(orders: DataFrame) -> DataFrame:
    # A quotient of decimals: exact to its last digit, then rounded half up.
    mean = F.round(F.sum("total") / F.count("total"), 2)
    return orders.groupBy("status").agg(
        F.count(F.lit(1)).alias("orders"), mean.alias("avg_total")
    )


def total_revenue(orders: DataFrame) -> DataFrame:
    return orders.agg(
        F.coalesce(F.sum("total"), F.lit(0)).alias("revenue"),
        F.count(F.lit(1)).alias("orders"),
        F.max("id").alias("last_id"),
    )


def first_orders(live_orders: DataFrame, n: int = 10) -> DataFrame:
    """Smoke read of a live table: four columns, the lowest ids."""
    return live_orders.select("id", "customer_id", "status", "total").orderBy("id").limit(n)
