"""Retention and refresh of stored tables."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tagtide.functions.times import AsOf, cutoff
from tagtide.operators.increments import ASPECTS, HASHTAGS, refresh
from tagtide.schemas import POSTS
from tagtide.session import cut_lineage, delete_folder, folders
from tagtide.sources.tables import read_table, replace_snapshot

# The tables with a retention time, and the column it looks at.
TIME_COLUMNS = {
    "posts": "processing_time",
    "aspect_sentiments": "processing_time",
    "anomaly_detection": "detected_at",
}


def cleanup(
    tables: dict[str, DataFrame], as_of: AsOf, days_to_keep: int
) -> tuple[dict[str, DataFrame], DataFrame]:
    """The tables without rows older than ``days_to_keep``, and the number removed.

    Older means strictly before ``as_of`` less the days. Rows without a time stay.
    """
    edge = cutoff(as_of, f"{days_to_keep} days")
    kept, removed = {}, []
    for name, df in tables.items():
        old = F.coalesce(F.col(TIME_COLUMNS[name]) < edge, F.lit(False))
        kept[name] = df.filter(~old)
        removed.append(
            df.filter(old)
            .agg(F.count(F.lit(1)).alias("rows_deleted"))
            .select(F.lit(name).alias("table_name"), "rows_deleted")
        )
    return kept, reduce(DataFrame.unionByName, removed)


def delete_old_days(
    spark: SparkSession, path: str, as_of: AsOf, days_to_keep: int, schema: StructType = POSTS, column: str = "processing_time"
) -> int:
    """Delete what is older than ``days_to_keep`` from a table that was written batch by batch. Returns the number of rows.

    Days that end before the edge go as folders; they are counted without reading a column. Of
    the day that holds the edge, batches without a younger row go as folders and the others are
    overwritten, from a copy, by their younger rows. So whatever is deleted is old, and a run
    that ends early can be repeated. Rows without a time stay.
    """
    edge = spark.range(1).select(cutoff(as_of, f"{days_to_keep} days").alias("edge")).first().edge
    days = [name.removeprefix("dt=") for name in folders(spark, path) if name.startswith("dt=")]
    gone = sorted(d for d in days if d < str(edge.date()) and d[:1].isdigit())
    if not gone and str(edge.date()) not in days:
        return 0
    rows = read_table(spark, path, schema)
    deleted = rows.filter(F.col("dt") < F.lit(edge.date())).count()
    for day in gone:
        delete_folder(spark, f"{path}/dt={day}")
    day = rows.filter(F.col("dt") == F.lit(edge.date()))
    old = F.col(column) < F.lit(edge)
    counted = day.groupBy("batch_id").agg(F.count_if(old).alias("old"), F.count(F.lit(1)).alias("n"))
    batches = [r for r in counted.filter("old > 0").collect()]
    mixed = [r.batch_id for r in batches if r.old < r.n]
    if mixed:
        kept = cut_lineage(day.filter(F.col("batch_id").isin(mixed) & ~F.coalesce(old, F.lit(False))))
        writer = kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("dt", "batch_id").parquet(path)
        delete_folder(spark, kept.scratch_path)
    for r in batches:
        if r.old == r.n:
            delete_folder(spark, f"{path}/dt={edge.date()}/batch_id={r.batch_id}")
    return deleted + sum(r.old for r in batches)


def delete_old(spark: SparkSession, stored: dict[str, tuple[str, StructType]], as_of: AsOf, days_to_keep: int) -> DataFrame:
    """``delete_old_days`` over stored tables, as ``table_name, rows_deleted``.

    ``stored`` names the path and layout of each table of TIME_COLUMNS.
    """
    counts = [
        (name, delete_old_days(spark, path, as_of, days_to_keep, schema, TIME_COLUMNS[name]))
        for name, (path, schema) in stored.items()
    ]
    return spark.createDataFrame(counts, "table_name string, rows_deleted long")


def refresh_views(posts: DataFrame, aspects: DataFrame, out: str, days: Iterable[date] = ()) -> None:
    """Bring both statistics tables up to date and store them as snapshots.

    Only days that changed are computed, from what ``out`` holds of the others; ``days`` names
    those whose rows changed but not their number.
    """
    for rows, table, name in ((posts, HASHTAGS, "hashtag_stats"), (aspects, ASPECTS, "aspect_stats")):
        found, _ = refresh(rows, f"{out}/state/{name}", table, days)
        replace_snapshot(found, f"{out}/{name}")
