"""Checks on stored rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tagtide import schemas


def broken_rules(df: DataFrame) -> Column:
    """Names of the rules a row breaks, as one text; empty if it breaks none."""
    rules = [
        F.when(F.col(c).isNull(), F.lit(f"{c} is null")) for c in schemas.REQUIRED if c in df.columns
    ]
    rules += [
        F.when(F.length(c) > size, F.lit(f"{c} longer than {size}"))
        for c, size in schemas.MAX_LENGTHS.items()
        if c in df.columns
    ]
    return F.concat_ws("; ", *rules)


def validate_posts(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that meet every rule, and the others with the ``reason``."""
    checked = df.withColumn("reason", broken_rules(df))
    valid = checked.filter(F.col("reason") == "").drop("reason")
    return valid, checked.filter(F.col("reason") != "")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).filter("count > 1")


def conform_schema(df: DataFrame, target: StructType) -> DataFrame:
    """``df`` in the layout of ``target``: old names replaced, missing columns NULL.

    Columns ``target`` does not name are kept behind the others.
    """
    if "user_name" not in df.columns and "user" in df.columns:
        df = df.withColumnRenamed("user", "user_name")
    known = [
        F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
        for f in target.fields
    ]
    extra = [F.col(c) for c in df.columns if c not in target.fieldNames()]
    return df.select(*known, *extra)


def profile_posts(df: DataFrame) -> DataFrame:
    """Type, longest text and number of NULLs of every column, in one pass."""
    measures, rows = [], []
    for i, (name, kind) in enumerate(df.dtypes):
        longest = F.max(F.length(name)) if kind == "string" else F.lit(None).cast("int")
        measures += [longest.alias(f"len_{i}"), F.count_if(F.col(name).isNull()).alias(f"nulls_{i}")]
        rows.append(
            F.struct(
                F.lit(name).alias("column_name"),
                F.lit(kind).alias("data_type"),
                F.col(f"len_{i}").alias("max_length"),
                F.col(f"nulls_{i}").alias("null_count"),
            )
        )
    return df.agg(*measures).select(F.inline(F.array(*rows)))
