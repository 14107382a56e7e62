"""Statistics that are kept up to date day by day.

A statistics table has a state that merges: per key and day the number of rows, the sum and the
squared deviations of the sentiment, the first and last time, and the distinct values of the
columns that are counted distinctly. A refresh computes the days whose number of rows differs
from what the state holds, takes days out that are gone, and merges all days. Days are folders
``dt=<day>`` written with plain dynamic partition overwrite.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tagtide.session import delete_folder, folders

UNKNOWN_DAY = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Rollup:
    """A statistics table: its key, what its counts are called, and the least count of a row."""

    key: str
    count: str
    distinct: Mapping[str, str]
    spread: bool = False
    min_count: int = 1
    time: str = "processing_time"


HASHTAGS = Rollup("hashtag", "total_posts", {"user_name": "unique_users", "dominant_aspect": "unique_aspects"})
ASPECTS = Rollup("aspect", "mention_count", {"hashtag": "hashtag_count", "user_name": "user_count"}, True, 3)


def with_day(rows: DataFrame, time: str) -> DataFrame:
    """``rows`` with the day ``dt``, which stored tables have as a folder."""
    return rows if "dt" in rows.columns else rows.withColumn("dt", F.to_date(time))


def of_days(rows: DataFrame, days: Iterable[date | None], time: str) -> DataFrame:
    """The rows of some days. The days reach the scan as folders, or as bounds of the time."""
    days = list(days)
    known = sorted(d for d in days if d is not None)
    inside = F.col("dt").isin(known) if known else F.lit(False)
    if len(known) < len(days):
        return rows.filter(inside | F.col("dt").isNull())
    bounds = (F.col(time) >= F.lit(known[0])) & (F.col(time) < F.lit(known[-1] + timedelta(days=1)))
    return rows.filter(inside & bounds)


def day_sums(rows: DataFrame, table: Rollup) -> DataFrame:
    """The mergeable sums of each day and key."""
    return rows.groupBy("dt", F.col(table.key).alias("key")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count("sentiment").alias("rated"),
        F.sum("sentiment").alias("total"),
        (F.var_pop("sentiment") * F.count("sentiment")).alias("deviation"),
        F.min(table.time).alias("first_seen"),
        F.max(table.time).alias("last_seen"),
    )


def day_values(rows: DataFrame, table: Rollup) -> DataFrame:
    """The distinct values of each day and key, as ``dt, key, name, value``."""
    listed = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in table.distinct])
    each = rows.select("dt", F.col(table.key).alias("key"), F.explode(listed).alias("v")).select("dt", "key", "v.*")
    return each.filter("value IS NOT NULL").distinct()


def merged(sums: DataFrame, values: DataFrame, table: Rollup) -> DataFrame:
    """The statistics of all days together.

    Squared deviations from the days' own means are carried over to the common mean.
    """
    every_day = Window.partitionBy("key")
    mean = F.sum("total").over(every_day) / F.sum("rated").over(every_day)
    off = F.col("total") / F.col("rated") - F.col("mean")
    parts = sums.withColumn("mean", mean).withColumn("deviation", F.col("deviation") + F.col("rated") * off * off)
    rated = F.sum("rated")
    spread = F.when(rated > 1, F.sqrt(F.sum("deviation") / (rated - 1))).alias("sentiment_stddev")
    found = parts.groupBy("key").agg(
        F.sum("n").alias(table.count),
        (F.sum("total") / rated).alias("avg_sentiment"),
        *([spread] if table.spread else []),
        F.max("last_seen").alias("last_seen"),
        F.min("first_seen").alias("first_seen"),
    )

    def of(name: str) -> Column:
        return F.count(F.when(F.col("name") == name, 1))

    distinct = values.select("key", "name", "value").distinct().groupBy("key").agg(
        *[of(c).alias(alias) for c, alias in table.distinct.items()]
    )
    counts = [F.coalesce(alias, F.lit(0)).alias(alias) for alias in table.distinct.values()]
    other = distinct.withColumnRenamed("key", "_key")
    joined = found.join(other, F.col("key").eqNullSafe(F.col("_key")), "left").filter(F.col(table.count) >= table.min_count)
    kept = [c for c in found.columns if c != "key"]
    return joined.select(F.col("key").alias(table.key), *kept, *counts)


def _state(spark: SparkSession, path: str, schema: str) -> DataFrame:
    if not folders(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def refresh(rows: DataFrame, path: str, table: Rollup, days: Iterable[date] = ()) -> tuple[DataFrame, list[date | None]]:
    """Bring the state at ``path`` in line with ``rows``. Returns the statistics and the days that were computed.

    A day is computed if its number of rows differs from the state's, or if it is named in ``days``, as
    a day must be whose rows changed and not their number. Counting the days reads no column
    of a table stored by day. A refresh that ends early leaves its days uncounted, so the next
    one computes them.
    """
    spark, rows = rows.sparkSession, with_day(rows, table.time)
    kind = dict(rows.select(table.key, table.time).dtypes)
    sums_schema = (
        f"key {kind[table.key]}, n long, rated long, total double, deviation double,"
        f" first_seen {kind[table.time]}, last_seen {kind[table.time]}, dt date"
    )
    values_schema = f"key {kind[table.key]}, name string, value string, dt date"
    sums, values = f"{path}/sums", f"{path}/values"
    # One row per day comes to the driver.
    have = {r.dt: r.n for r in _state(spark, sums, sums_schema).groupBy("dt").agg(F.sum("n").alias("n")).collect()}
    now = {r.dt: r.n for r in rows.groupBy("dt").agg(F.count(F.lit(1)).alias("n")).collect()}
    stale = {d for d in have.keys() | now.keys() if have.get(d) != now.get(d)} | (set(days) & now.keys())
    for day in stale:
        for part in (sums, values):
            delete_folder(spark, f"{part}/dt={UNKNOWN_DAY if day is None else day}")
    new = sorted(stale & now.keys(), key=str)
    if new:
        fresh = of_days(rows, new, table.time)
        # The sums are counted by the next refresh, so they come last.
        for found, part in ((day_values(fresh, table), values), (day_sums(fresh, table), sums)):
            writer = found.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer.partitionBy("dt").parquet(part)
    return merged(_state(spark, sums, sums_schema), _state(spark, values, values_schema), table), new
