"""Prices, points and percentages in exact decimals."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(10,2)"


def _kept_share(pct: Column) -> Column:
    return F.lit(Decimal("1")) - pct * F.lit(Decimal("0.01"))


def sale_price(price: Column, discount_pct: Column) -> Column:
    """Price after a percentage discount, to the cent."""
    return F.round(price * _kept_share(discount_pct), 2).cast(MONEY)


def repriced(current: Column, old_pct: Column, new_pct: Column) -> Column:
    """Undo one discount on an already rounded sale price and apply another.

    Starting from the rounded price can differ by a cent from a fresh
    computation; that is how a re-priced deal is defined.
    """
    return F.round(current / _kept_share(old_pct) * _kept_share(new_pct), 2).cast(MONEY)


def effective_price(sale: Column, price: Column) -> Column:
    """The sale price when there is one and it is not zero, else the list price."""
    return F.coalesce(F.nullif(sale, F.lit(Decimal("0.00")).cast(MONEY)), price)


def loyalty_points(amount: Column) -> Column:
    """One point per whole currency unit."""
    return F.floor(amount).cast("bigint")


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """``part`` as a percentage of ``whole``; null when ``whole`` is zero."""
    hundred = F.lit(Decimal("100.0"))
    return F.round(hundred * part / F.nullif(whole, F.lit(0).cast("bigint")), digits)


def in_usd(total: Column, rate: Column) -> Column:
    return F.round(total * rate, 2)
