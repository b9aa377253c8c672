"""Exact two-decimal arithmetic as Spark column expressions.

Decimal division keeps a limited scale, so ``round(a / b, 2)`` can round twice. These
helpers work on whole cents and integral division instead: one rounding, half away from
zero, and on BIGINT operands no decimal objects in the generated code.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketbars.schemas import PERCENT, PRICE, VOLUME_AVG

_WIDE = T.DecimalType(38, 0)


def cents(price: Column) -> Column:
    """A DECIMAL(10,2) amount as BIGINT cents."""
    return (price * 100).cast("bigint")


def _integral_div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def rounded_quotient(num: Column, den: Column) -> Column:
    """``num / den`` as BIGINT, rounded half away from zero; NULL for a zero ``den``."""
    size = F.nullif(F.abs(den), F.lit(0))
    whole = _integral_div(F.abs(num) * 2 + size, size * 2)
    return F.when((num < 0) != (den < 0), -whole).otherwise(whole)


def from_cents(amount: Column, kind: T.DecimalType = PRICE) -> Column:
    """BIGINT cents as a decimal; NULL when it does not fit ``kind``."""
    return (amount.cast("decimal(19,0)") * F.lit(Decimal("0.01"))).try_cast(kind)


def pct_change(current: Column, previous: Column) -> Column:
    """Percentage change between two prices, two decimals; NULL on a zero or NULL base."""
    now, before = cents(current), cents(previous)
    return from_cents(rounded_quotient((now - before) * 10_000, before), PERCENT)


def mean_price(sum_cents: Column, count: Column) -> Column:
    return from_cents(rounded_quotient(sum_cents, count))


def mean_volume(total: Column, count: Column) -> Column:
    """Mean of BIGINT volumes. Whole part and rest are divided apart: both fit BIGINT."""
    whole = _integral_div(total, count.cast(_WIDE)).cast("decimal(19,0)")
    rest = (total % count.cast(_WIDE)).cast("bigint")
    cents_ = rounded_quotient(rest * 100, count.cast("bigint")).cast("decimal(19,0)")
    return (whole + cents_ * F.lit(Decimal("0.01"))).cast(VOLUME_AVG)


def weighted_price(traded_cents: Column, volume: Column) -> Column:
    """Sum of price x volume (in cents) over summed volume; NULL when nothing traded."""
    return from_cents(rounded_quotient(traded_cents.cast(_WIDE), volume.cast(_WIDE)))
