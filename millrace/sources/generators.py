"""Made-up shop data of any size, equal for equal seeds."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import moment

# The shop's categories and how often shoppers view each.
CATEGORY_WEIGHTS = {"Electronics": 4, "Clothing": 3, "Books": 1, "Home": 2, "Sports": 2}
WAREHOUSES = ("US-East", "US-West", "EU-Central")
REORDER_LEVELS = (5, 10, 15, 20)
# How many of a hundred reviews give 1, 2, 3, 4 and 5 stars.
RATING_WEIGHTS = (5, 8, 15, 35, 37)
# Share of views that are clicked, and of clicks put in a cart.
CLICK_SHARE, CART_SHARE = 0.45, 0.35


def _draw(seed: int, what: str, *ids: Column) -> Column:
    """A number in [0, 1) that depends on nothing but its arguments."""
    mixed = F.xxhash64(F.lit(seed), F.lit(what), *ids)
    return F.pmod(mixed, F.lit(1 << 53)) / F.lit(float(1 << 53))


def _between(draw: Column, low: int, high: int) -> Column:
    return (F.lit(low) + F.floor(draw * (high - low + 1))).cast("int")


def _choice(draw: Column, values: tuple) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), _between(draw, 1, len(values)))


def _weighted(draw: Column, weights: tuple[int, ...]) -> Column:
    """1 for the first weight, 2 for the second, and so on."""
    point, reached, picked = draw * sum(weights), 0, F.lit(len(weights))
    marks = []
    for place, weight in enumerate(weights, start=1):
        reached += weight
        marks.append((reached, place))
    for mark, place in reversed(marks[:-1]):
        picked = F.when(point < mark, place).otherwise(picked)
    return picked


def generate_clickstream(
    spark: SparkSession,
    sessions: int = 500,
    seed: int = 42,
    products: int = 50,
    end: datetime = datetime(2026, 1, 1),
) -> DataFrame:
    """Sessions of 2 to 8 views, some clicked, some of those put in a cart.

    Each session is built from its number alone, inside one row: its views are
    an array, the running time a fold over it.  Nothing is shuffled.
    """
    session = F.col("id")
    per_category = products // len(CATEGORY_WEIGHTS)

    def visit(n: Column) -> Column:
        category = _weighted(_draw(seed, "category", session, n), tuple(CATEGORY_WEIGHTS.values()))
        item = _between(_draw(seed, "item", session, n), 1, per_category)
        clicked = _draw(seed, "click", session, n) < CLICK_SHARE
        carted = clicked & (_draw(seed, "cart", session, n) < CART_SHARE)
        return F.struct(
            ((category - 1) * per_category + item).cast("int").alias("product_id"),
            _between(_draw(seed, "to view", session, n), 5, 90).alias("to_view"),
            F.when(clicked, _between(_draw(seed, "to click", session, n), 3, 40)).alias("to_click"),
            F.when(carted, _between(_draw(seed, "to cart", session, n), 2, 30)).alias("to_cart"),
        )

    def event(kind: str, product: Column, second: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("event_type"), product.alias("product_id"), second.alias("second")
        )

    def add(state: Column, v: Column) -> Column:
        viewed = state["clock"] + v["to_view"]
        clicked = viewed + F.coalesce(v["to_click"], F.lit(0))
        carted = clicked + F.coalesce(v["to_cart"], F.lit(0))
        happened = F.concat(
            F.array(event("view", v["product_id"], viewed)),
            F.filter(F.array(event("click", v["product_id"], clicked)), lambda _: v["to_click"].isNotNull()),
            F.filter(F.array(event("add_to_cart", v["product_id"], carted)), lambda _: v["to_cart"].isNotNull()),
        )
        return F.struct(carted.alias("clock"), F.concat(state["events"], happened).alias("events"))

    views = F.sequence(F.lit(1), _between(_draw(seed, "views", session), 2, 8))
    nothing = F.struct(
        F.lit(0).alias("clock"),
        F.array().cast("array<struct<event_type:string,product_id:int,second:int>>").alias("events"),
    )
    happened = F.aggregate(F.transform(views, visit), nothing, add, lambda state: state["events"])
    minutes_before = _between(_draw(seed, "start", session), 0, 24 * 60)
    start = moment(end) - F.make_dt_interval(mins=minutes_before)
    return (
        spark.range(sessions)
        .select(
            F.concat(F.lit("sess-"), F.lpad(session.cast("string"), 4, "0")).alias("session_id"),
            start.alias("_start"),
            F.explode(happened).alias("_event"),
        )
        .select(
            "session_id",
            "_event.event_type",
            "_event.product_id",
            (F.col("_start") + F.make_dt_interval(secs=F.col("_event.second"))).alias("event_ts"),
        )
    )


def generate_store(
    spark: SparkSession, customers: int = 100, products: int = 50, seed: int = 42, reviews: int = 80
) -> dict[str, DataFrame]:
    """Customers, products, inventory, orders' items and reviews of a shop."""
    number = (F.col("id") + 1).cast("int")
    names = tuple(CATEGORY_WEIGHTS)
    per_category = max(1, products // len(names))
    place = F.least(F.floor(F.col("id") / per_category), F.lit(len(names) - 1)).cast("int")
    category = F.element_at(F.array(*[F.lit(n) for n in names]), place + 1)

    def money(draw: Column, low: float, high: float) -> Column:
        return F.round(F.lit(low) + draw * (high - low), 2).cast("decimal(10,2)")

    people = spark.range(customers).select(
        number.alias("id"),
        F.concat(F.lit("Customer "), number.cast("string")).alias("name"),
        F.concat(F.lit("user"), number.cast("string"), F.lit("@example.com")).alias("email"),
    )
    goods = spark.range(products).select(
        number.alias("id"),
        F.concat(category, F.lit(" item "), number.cast("string")).alias("name"),
        money(_draw(seed, "price", number), 5.99, 299.99).alias("price"),
        category.alias("category"),
    )
    stock = spark.range(products).select(
        number.alias("product_id"),
        _between(_draw(seed, "quantity", number), 0, 200).alias("quantity"),
        F.element_at(F.array(*[F.lit(w) for w in WAREHOUSES]), number % len(WAREHOUSES) + 1).alias("warehouse"),
        _choice(_draw(seed, "reorder", number), REORDER_LEVELS).alias("reorder_level"),
    )
    pairs = spark.range(reviews).select(
        _between(_draw(seed, "reviewed", F.col("id")), 1, products).alias("product_id"),
        _between(_draw(seed, "reviewer", F.col("id")), 1, customers).alias("customer_id"),
    )
    rated = (
        pairs.distinct()
        .withColumn("rating", _weighted(_draw(seed, "rating", F.col("product_id"), F.col("customer_id")), RATING_WEIGHTS))
        .withColumn(
            "review_date",
            moment(datetime(2024, 1, 1))
            + F.make_dt_interval(
                days=_between(_draw(seed, "day", F.col("product_id"), F.col("customer_id")), 0, 27)
            ),
        )
    )
    line = F.explode(F.sequence(F.lit(1), _between(_draw(seed, "lines", number), 1, 4))).alias("line_no")
    lines = spark.range(customers).select(number.alias("order_id"), line)
    spot = (F.col("order_id"), F.col("line_no"))
    items = lines.select(
        *spot,
        _between(_draw(seed, "bought", *spot), 1, products).alias("product_id"),
        _between(_draw(seed, "pieces", *spot), 1, 3).alias("quantity"),
        money(_draw(seed, "unit", *spot), 9.99, 199.99).alias("unit_price"),
    ).withColumn("line_total", (F.col("unit_price") * F.col("quantity")).cast("decimal(10,2)"))
    return {"customers": people, "products": goods, "inventory": stock, "reviews": rated, "order_items": items}
