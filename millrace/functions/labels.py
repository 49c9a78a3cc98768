"""Labels that follow from thresholds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lowest points of a tier, highest tier first.
TIER_FLOORS = ((3000, "Platinum"), (1500, "Gold"), (500, "Silver"))
# An order above the amount gets the priority, highest first.
PRIORITY_LIMITS = ((500, "high"), (200, "medium"))
# How much of the old row a change log carries.
BEFORE_IMAGE_CODES = {
    "d": "default (primary key)",
    "n": "nothing",
    "f": "full",
    "i": "index",
}


def _first_match(tests: list[tuple[Column, str]], otherwise: Column) -> Column:
    for test, label in reversed(tests):
        otherwise = F.when(test, F.lit(label)).otherwise(otherwise)
    return otherwise


def loyalty_tier(points: Column) -> Column:
    return _first_match([(points >= floor, tier) for floor, tier in TIER_FLOORS], F.lit("Bronze"))


def order_priority(total: Column) -> Column:
    return _first_match([(total > limit, name) for limit, name in PRIORITY_LIMITS], F.lit("normal"))


def restock_needed(in_stock: Column, reorder_level: Column, add_to_carts: Column) -> Column:
    """Shoppers want it and the stock is at or below the reorder level.

    A product with no inventory row counts as stock 0, level 0, so it is
    flagged as soon as it is put into a cart.
    """
    low = F.coalesce(in_stock, F.lit(0)) <= F.coalesce(reorder_level, F.lit(0))
    return low & (add_to_carts > 0)


def display_name(name: Column, product_id: Column) -> Column:
    fallback = F.concat(F.lit("Product #"), product_id.cast("string"))
    return F.coalesce(F.nullif(name, F.lit("")), fallback)


def before_image_label(code: Column) -> Column:
    return _first_match(
        [(code == key, label) for key, label in BEFORE_IMAGE_CODES.items()],
        F.lit(None).cast("string"),
    )
