"""Exact money and ratio arithmetic.

Money stays decimal end to end: fixture doubles are cast to DECIMAL(10,2)
before any sum, so totals do not depend on row order. Divisions that the
reference rounds are rewritten as integer or decimal-times-literal
arithmetic, which both Spark and the DuckDB oracle evaluate exactly.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def dec(c: Column, precision: int = 10, scale: int = 2) -> Column:
    """Cast with MySQL's DECIMAL assignment rounding (half up)."""
    return c.cast(T.DecimalType(precision, scale))


def lit_dec(value: str) -> Column:
    """A decimal literal (never a float) for exact comparisons and products."""
    return F.lit(Decimal(value))


def at_most_int(c: Column) -> Column:
    """A BIGINT as INT, stopping at the largest INT."""
    return F.least(c.cast("long"), F.lit(2**31 - 1).cast("long")).cast("int")


def money_sum(c: Column, precision: int = 18) -> Column:
    return dec(F.sum(c), precision, 2)


def mean(sum_col: Column, count_col: Column) -> Column:
    """Average as double(sum) / count; NULL on an empty group."""
    return sum_col.cast("double") / F.when(count_col != 0, count_col.cast("double"))


def round_ratio(num: Column, den: Column, scale: int = 2) -> Column:
    """round(num / den, scale) half up, exact for non-negative integers.

    NULL when den is 0 (MySQL's NULLIF guard).
    """
    factor = 10**scale
    n = num.cast("long")
    d = F.when(den != 0, den.cast("long"))
    a = n * (2 * factor) + d
    b = d * 2
    # exact integer quotient: (a - a mod b) / b is a whole number below 2^53
    units = ((a - F.pmod(a, b)) / b).cast("long")
    step = F.lit(Decimal(1).scaleb(-scale)).cast(T.DecimalType(scale + 1, scale))
    return dec(dec(units, 20, 0) * step, 18, scale)


def floor_tenth(c: Column) -> Column:
    """floor(amount / 10) as INT, computed as floor(amount * 0.1)."""
    return F.floor(c * lit_dec("0.1")).cast("int")
