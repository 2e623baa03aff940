"""Prices, discounts, stock states and currencies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfspark.functions.vocabulary import PRICE_MAX, PRICE_MIN

IN_STOCK, OUT_OF_STOCK, UNAVAILABLE, DELISTED, UNKNOWN = "IN_STOCK", "OUT_OF_STOCK", "UNAVAILABLE", "DELISTED", "UNKNOWN"


def sane(price: Column) -> Column:
    return price.between(PRICE_MIN, PRICE_MAX)


def coerce_price(c: Column) -> Column:
    """A number, truncated to whole units, in the sane range; else null."""
    whole = c.try_cast("double").cast("long")
    return F.when(sane(whole), whole)


def delta(base: Column, competitor: Column) -> Column:
    return competitor - base


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole, rounded to two places; in double, as decimals would round elsewhere."""
    return F.round(part * F.lit(100.0) / whole, 2)


def was_if_higher(current: Column, real: Column) -> Column:
    return F.when(real > current, real)


def was_of_offer(current: Column, old: Column, regular: Column) -> Column:
    """The old price, else a regular one above the current; none where it equals the current."""
    was = F.coalesce(old, F.when(regular > current, regular))
    return F.when(was != current, was)


def was_if_discounted(current: Column, flag: Column, real: Column) -> Column:
    return F.when(F.coalesce(flag, F.lit(False)) & (real != 0) & (real != current), real.cast("long"))


def stock_of_count(count: Column, purchase_type: Column) -> Column:
    """From an inventory count and a purchase type; a count that is no number is unknown."""
    return (
        F.when(count.isNull(), UNKNOWN).when(count == 0, OUT_OF_STOCK).when(purchase_type == "PREORDER", UNAVAILABLE).otherwise(IN_STOCK)
    )


def stock_of_flag(flag: Column) -> Column:
    return F.when(F.coalesce(flag, F.lit(False)), IN_STOCK).otherwise(OUT_OF_STOCK)


def availability_of_url(href: Column) -> Column:
    """The raw schema.org state as the page path keeps it."""
    out = F.lit("Unknown")
    for state in ("PreOrder", "Discontinued", "OutOfStock", "InStock"):
        out = F.when(href.contains(state), state).otherwise(out)
    return out


def currency(c: Column) -> Column:
    return F.upper(F.coalesce(c, F.lit("KZT")))
