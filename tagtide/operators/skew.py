"""Joins that stay even when one key holds a large part of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_ROWS = 200_000
MAX_HOT_KEYS = 10_000
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 * 1024 * 1024


def hot_keys(
    counts: DataFrame, keys: Sequence[str], size: str, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """``keys, blocks`` for the keys with more than one block of rows.

    ``counts`` has one row per key with its number of rows in ``size``. A block
    holds ``block_rows`` rows, or more where that would cut out more than
    MAX_HOT_KEYS keys: at most ``total / block`` keys can exceed a block, so the
    result has a proven bound and may be broadcast.
    """
    total = counts.agg(F.sum(size)).scalar()
    block = F.greatest(F.lit(block_rows), F.ceil(total / F.lit(MAX_HOT_KEYS)))
    return counts.filter(F.col(size) > block).select(
        *keys, F.ceil(F.col(size) / block).cast("int").alias("blocks")
    )


def count_by(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys, rows``; combined before the shuffle."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))


def spread(few: DataFrame, many: DataFrame, hot: DataFrame, on: Sequence[str], split_by: Sequence[str]):
    """Both sides with a ``block`` column to join on beside the key.

    Rows of ``many`` with a hot key are dealt to its blocks by ``split_by``; rows of
    ``few`` are repeated once per block. Each row of ``many`` stays in one block, so
    an inner join on key and block gives exactly the rows of the plain join.
    """
    keys = list(on)
    small = F.broadcast(hot)
    blocks = F.coalesce(F.col("blocks"), F.lit(1))
    many = many.join(small, keys, "left").withColumn(
        "block", F.pmod(F.xxhash64(*split_by), blocks).cast("int")
    )
    few = few.join(small, keys, "left").withColumn(
        "block", F.explode(F.sequence(F.lit(0), blocks - 1))
    )
    return few.drop("blocks"), many.drop("blocks")


def spread_join(
    few: DataFrame,
    many: DataFrame,
    on: Sequence[str],
    split_by: Sequence[str],
    condition: Column | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Inner join of ``few`` and ``many`` that cuts the hot keys of ``many``.

    ``condition`` may compare other columns of the two sides; it is tested inside
    the join, so pairs that fail it are never written anywhere.
    """
    hot = hot_keys(count_by(many, on), on, "rows", block_rows)
    left, right = spread(few, many, hot, on, split_by)
    keys = [*on, "block"]
    if condition is None:
        return left.join(right, keys).drop("block")
    other = right.withColumnsRenamed({k: f"_{k}" for k in keys})
    match = condition
    for k in keys:
        match = match & (F.col(k) == F.col(f"_{k}"))
    return left.join(other, match).drop("block", *[f"_{k}" for k in keys])


def is_small(df: DataFrame, text: str, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """True if ``df`` was counted to fit a broadcast; ``text`` is its long column."""
    n, length = df.agg(F.count(F.lit(1)), F.sum(F.octet_length(text))).first()
    return n <= rows and (length or 0) <= size


def lookup(
    many: DataFrame, table: DataFrame, on: str, split_by: Sequence[str], small: bool, how: str = "inner"
) -> DataFrame:
    """Join many rows with a lookup table that has one row per key.

    A table counted to be small is broadcast; beyond that the rows are shuffled, with
    hot keys in blocks. ``how="left"`` keeps rows without a match: every row sits in
    exactly one block, so that is exact too.
    """
    if small:
        return many.join(F.broadcast(table), on, how)
    hot = hot_keys(count_by(many, [on]), [on], "rows")
    few, blocked = spread(table, many, hot, [on], split_by)
    return blocked.join(few, [on, "block"], how).drop("block")
