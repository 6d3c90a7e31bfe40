"""Exact money arithmetic: decimals in, half-up rounded decimals out.

Decimal division in Spark rounds its quotient to a limited scale first, and a
second rounding on top can be off by one unit.  These helpers use integer
division of exact sums instead; they run on aggregates, not on fact rows.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import MONEY

_WIDE = "decimal(30,6)"


def money(col: Column) -> Column:
    """Round half up to cents."""
    return F.round(col, 2).cast(MONEY)


def ratio(numerator: Column, denominator: Column, places: int = 2) -> Column:
    """``numerator / denominator`` rounded half away from zero; null for a zero denominator.

    The denominator must not be negative.
    """
    num = numerator.cast(_WIDE)
    den = F.nullif(denominator.cast(_WIDE), F.lit(Decimal(0)).cast(_WIDE))
    doubled = F.abs(num) * F.lit(Decimal(2 * 10**places)) + den
    units = F.call_function("div", doubled, den * F.lit(Decimal(2)))
    signed = F.when(num < 0, -units).otherwise(units).cast("decimal(19,0)")
    return (signed * F.lit(Decimal(1).scaleb(-places))).cast(f"decimal(20,{places})")


def percent(part: Column, whole: Column) -> Column:
    """``part`` as a percentage of ``whole``, two decimals."""
    return ratio(part * F.lit(Decimal(100)), whole, 2)


def mean(total: Column, count: Column, places: int = 2) -> Column:
    return ratio(total, count, places)
