"""Numeric expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def try_double(c: Column) -> Column:
    return c.try_cast("double")


def finite(c: Column) -> Column:
    return ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))


def ratio(top: Column, bottom: Column) -> Column:
    """top / bottom, null where the denominator is zero."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def ratio0(top: Column, bottom: Column) -> Column:
    """top / bottom with the zero-division-is-0 convention of class metrics."""
    return F.coalesce(ratio(top, bottom), F.lit(0.0))


def within(c: Column, low: float, high: float) -> Column:
    return c.between(low, high)


def count_where(cond: Column) -> Column:
    return F.count_if(cond)


def add(cols) -> Column:
    return reduce(lambda a, b: a + b, cols)


def order_bin(c: Column, bits: int = 10) -> Column:
    """Integer bin that never decreases as the value grows.

    Binary exponent plus the leading ``bits`` of the mantissa, so one bin spans a
    relative width of 2**-bits. Used to cut a sort into independent pieces.
    """
    x = c.cast("double")
    a = F.abs(x)
    scale = 1 << bits
    e = F.floor(F.log2(a))
    m = F.floor((a / F.pow(F.lit(2.0), e) - 1) * scale)
    size = (e + 1100) * scale + m + 1
    top = F.lit(1 << 40)
    return (
        F.when(x.isNull(), F.lit(None).cast("bigint"))
        .when(F.isnan(x), top + 1)
        .when(x == 0, F.lit(0).cast("bigint"))
        .when(a == float("inf"), F.when(x > 0, top).otherwise(-top))
        .otherwise(F.when(x > 0, size).otherwise(-size)).cast("bigint")
    )
