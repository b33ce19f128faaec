"""Price and traffic columns for ad impressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def labelled(value: Column, steps: Sequence[tuple[float, object]], rest: object, closed: bool = True) -> Column:
    """Label of the first step whose upper bound holds ``value`` (<= when closed, else <)."""
    picked = None
    for bound, label in steps:
        hit = value <= F.lit(bound) if closed else value < F.lit(bound)
        picked = F.when(hit, F.lit(label)) if picked is None else picked.when(hit, F.lit(label))
    return picked.otherwise(F.lit(rest))


def price_category(price: Column) -> Column:
    """High above 100, Medium above 50, Low above 10, else Tiny (null prices too)."""
    return (
        F.when(price.isNull() | (price <= 10), "Tiny")
        .when(price <= 50, "Low")
        .when(price <= 100, "Medium")
        .otherwise("High")
    )


def bid_category(price: Column) -> Column:
    """unknown for null, zero, low below 2, medium below 5, else high."""
    named = labelled(price, [(2.0, "low"), (5.0, "medium")], "high", closed=False)
    return F.when(price.isNull(), "unknown").when(price == 0, "zero").otherwise(named)


def normalized_price(price: Column, scale: float = 10.0) -> Column:
    return F.nvl(price, F.lit(0.0)) / F.lit(scale)


def discounted_price(price: Column, premium: Column) -> Column:
    """Tiered discount (15 % above 5, 10 % above 2, 5 % above 1) plus 5 points for premium publishers."""
    paid = F.nvl(price, F.lit(0.0))
    tier = labelled(paid, [(1.0, 0.0), (2.0, 0.05), (5.0, 0.10)], 0.15)
    bonus = premium.cast("int") * F.lit(0.05)
    return paid * (F.lit(1) - (tier + F.nvl(bonus, F.lit(0.0))))


def device_type(user_agent: Column) -> Column:
    """unknown, ios, android or other."""
    apple = user_agent.contains("iPhone") | user_agent.contains("iPad")
    return (
        F.when(apple, "ios")
        .when(user_agent.contains("Android"), "android")
        .when(user_agent.isNotNull(), "other")
        .otherwise("unknown")
    )


def is_internal_ip(address: Column, prefixes: Sequence[str] = ("192.168.", "10.")) -> Column:
    flags = [address.startswith(prefix) for prefix in prefixes]
    combined = flags[0]
    for flag in flags[1:]:
        combined = combined | flag
    return combined


def json_double(document: Column, path: str) -> Column:
    """A number inside a JSON text; null where it is missing or not a number."""
    return F.get_json_object(document, path).try_cast("double")
