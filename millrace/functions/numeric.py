"""Exact arithmetic: ratios and percentages in decimals, never in doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def exact_ratio(part: Column, whole: Column, digits: int, scale: int = 1) -> Column:
    """round(scale * part / whole, digits), half away from zero, NULL where whole is 0 or NULL.

    Both sides are cast to decimal before dividing: a double quotient can fall
    on the wrong side of a tie (571 of 2000 is 28.55 %, which must give 28.6).
    """
    num = part.cast("decimal(20,0)") * F.lit(scale).cast("decimal(5,0)")
    den = F.nullif(whole.cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    return F.round((num / den).cast("decimal(38,16)"), digits)


def flag_rate(flag: Column) -> tuple[Column, Column]:
    """(trues, known): sums whose quotient is the mean of a nullable flag over its non-NULL rows."""
    return F.sum(flag.cast("int")).cast("bigint"), F.count(flag)


def wrap_uint32(value: Column) -> Column:
    """Read an unsigned 32-bit number as signed; other values that do not fit an int raise."""
    v = value.cast("bigint")
    return F.when(v >= F.lit(1 << 31), v - F.lit(1 << 32)).otherwise(v).cast("int")

