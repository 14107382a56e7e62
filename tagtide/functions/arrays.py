"""Helpers for computed arrays and maps."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once.

    An expression used inside a lambda is computed again for every element.
    Binding it to a lambda variable first avoids that.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def unnest(
    df: DataFrame, keep: Sequence[Column | str], values: Column | str, *names: str, pos: str | None = None
) -> DataFrame:
    """``keep`` and one row per element of an array or map; none for an empty one.

    As ``explode``, but for arrays that are costly to compute: for a plain ``explode``
    Spark adds a test for empty arrays near the scan, and computes them there once more.
    """
    at = pos or "_pos"
    rows = df.select(*keep, F.posexplode_outer(values).alias(at, *names)).filter(F.col(at).isNotNull())
    return rows if pos else rows.drop(at)
