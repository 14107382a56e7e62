"""Numeric expressions: rounding, guarded division, default values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fixed_point(c: Column, digits: int) -> Column:
    """Text with ``digits`` decimals, as ``f"{x:.<digits>f}"`` gives it.

    ``format_number`` with a pattern rounds half-even on the exact binary value,
    which is the rule of C and Python too.
    """
    pattern = "0." + "0" * digits if digits else "0"
    return F.call_function("format_number", c.cast("double"), F.lit(pattern))


def round_binary(c: Column, digits: int) -> Column:
    """Python's ``round(x, n)``: half-even on the exact binary value."""
    return fixed_point(c, digits).cast("double")


def round_n(c: Column, digits: int) -> Column:
    """SQL's ``ROUND(x::numeric, n)``: half away from zero on the decimal value."""
    return F.round(c.cast("decimal(20,10)"), digits).cast("double")


def null_safe_div(a: Column, b: Column) -> Column:
    """``a / NULLIF(b, 0)``."""
    return F.try_divide(a, b)


def falsy_to_zero(c: Column) -> Column:
    """NULL and any zero become zero."""
    return F.when(c.isNull() | (c == 0), F.lit(0)).otherwise(c)


def fill_zero(df: DataFrame, columns: list[str]) -> DataFrame:
    """NULL features become 0."""
    return df.na.fill(0, subset=columns)


def abs_z(c: Column) -> Column:
    """Absolute z-score."""
    return F.abs(c)
