"""Offers and interest."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Coupon percentages and the cap on one offer.
COUPON_PERCENT = {"summer10": 10}
OTHER_PERCENT = 5
MAX_OFFER = 50


def offer_price(amount: str | Column, percent: Column | float, cap: float = MAX_OFFER) -> Column:
    """Amount less a percentage discount of at most ``cap``."""
    value = F.col(amount) if isinstance(amount, str) else amount
    rate = percent if isinstance(percent, Column) else F.lit(percent)
    return value - F.least(value * rate / 100, F.lit(float(cap)))


def coupon_percent(column: str) -> Column:
    chosen = None
    for coupon, percent in COUPON_PERCENT.items():
        hit = F.col(column) == coupon
        chosen = F.when(hit, percent) if chosen is None else chosen.when(hit, percent)
    return chosen.otherwise(F.lit(OTHER_PERCENT))


def simple_interest(amount: str, periods: int, percent: float) -> Column:
    return F.col(amount) * (1 + periods * percent / 100)


def compound_interest(amount: str, periods: int, percent: float = 10) -> Column:
    """Closed form of adding the interest once per period."""
    return F.col(amount) * F.pow(F.lit(1 + percent / 100), F.lit(periods))
