"""Stored tables: scans, appends, snapshots, upserts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tagtide import schemas
from tagtide.functions.arrays import unnest
from tagtide.functions.numbers import falsy_to_zero
from tagtide.functions.times import AsOf, moment, parse_iso, since
from tagtide.session import folders, is_file

# Which features each kind of consumer stores; the others are NULL.
POST_VARIANTS = {
    "simple": (),
    "basic": ("sentiment", "content_length", "hashtag_count"),
    "aspects": ("sentiment", "sentiment_category", "dominant_aspect", "content_length", "hashtag_count"),
    "struct": (
        "sentiment",
        "content_length",
        "hashtag_count",
        "sentiment_summary",
        "top_aspect",
        "top_aspect_sentiment",
    ),
}

# The columns that every posts table has.
POST_COLUMNS = ("user_name", "content", "hashtag", "processing_time", "timestamp")


def posts_since(posts: DataFrame, as_of: AsOf, interval: str) -> DataFrame:
    """The recent part of a posts table."""
    return since(posts, as_of, interval)


def posts_columns(rows: DataFrame, variant: str = "basic") -> DataFrame:
    """Exploded, enriched rows in the layout of the posts table."""
    if variant == "struct":
        rows = rows.withColumnRenamed("overall_sentiment", "sentiment")
        for name in ("sentiment", "content_length", "hashtag_count", "top_aspect_sentiment"):
            rows = rows.withColumn(name, falsy_to_zero(F.col(name)))
    features = POST_VARIANTS[variant]
    always = ("user_name", "content", "hashtag", "processing_time", "timestamp")
    columns = []
    for field in schemas.POSTS.fields:
        if field.name == "timestamp" and dict(rows.dtypes)["timestamp"] == "string":
            value = parse_iso(F.col("timestamp"))
        elif field.name in always or field.name in features:
            value = F.col(field.name).cast(field.dataType)
        else:
            value = F.lit(None).cast(field.dataType)
        columns.append(value.alias(field.name))
    return rows.select(*columns)


def aspect_rows(rows: DataFrame) -> DataFrame:
    """One row per exploded post and entry of its ``aspect_sentiments`` map."""
    time = F.col("timestamp")
    if dict(rows.dtypes)["timestamp"] == "string":
        time = parse_iso(time)
    keep = [
        "user_name",
        "hashtag",
        F.col("processing_time").cast("timestamp_ntz").alias("processing_time"),
        time.alias("timestamp"),
    ]
    found = unnest(rows, keep, "aspect_sentiments", "aspect", "sentiment")
    found = found.withColumn("sentiment", F.col("sentiment").cast("double"))
    return found.select(*schemas.ASPECT_SENTIMENTS.fieldNames())


def write_batch(rows: DataFrame, batch_id: int, path: str, day: str = "processing_time") -> None:
    """Append one micro-batch, split by day.

    The batch owns the folders ``dt=<day>/batch_id=<id>``, so a batch that is run again
    after a failure replaces its own rows and never doubles them, and a reader of few days lists
    the folders of these days only.
    """
    (
        rows.withColumns({"dt": F.to_date(day), "batch_id": F.lit(batch_id).cast("long")})
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("dt", "batch_id")
        .parquet(path)
    )


def write_posts(rows: DataFrame, batch_id: int, path: str, variant: str = "basic") -> None:
    """Append one micro-batch of posts."""
    write_batch(posts_columns(rows, variant), batch_id, path)


def write_aspects(rows: DataFrame, batch_id: int, path: str) -> None:
    """Append the aspects of one micro-batch."""
    write_batch(aspect_rows(rows), batch_id, path)


def read_table(spark: SparkSession, path: str, schema: StructType = schemas.POSTS) -> DataFrame:
    """A table written batch by batch, also one without rows yet; ``dt`` and ``batch_id`` prune files."""
    whole = StructType([*schema.fields]).add("dt", "date").add("batch_id", "long")
    return spark.read.schema(whole).parquet(path)


def jdbc_columns(rows: DataFrame, variant: str = "basic") -> DataFrame:
    """Exploded, enriched rows in the columns that the variant's own table has."""
    features = POST_VARIANTS[variant]
    names = [n for n in schemas.POSTS.fieldNames() if n in POST_COLUMNS or n in features]
    return posts_columns(rows, variant).select(*names)


def write_jdbc(rows: DataFrame, url: str, table: str, properties: dict[str, str] | None = None) -> None:
    """Append to a database table. Arrays have no column there and are dropped."""
    flat = rows.drop(*[f.name for f in rows.schema.fields if f.dataType.typeName() == "array"])
    flat.write.format("jdbc").mode("append").options(url=url, dbtable=table, **(properties or {})).save()


def last_by_key(updates: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the one with the largest ``order``, nulls first. Combined before the shuffle."""
    others = [c for c in updates.columns if c not in keys]
    place = F.struct(*[x for c in order for x in (F.col(c).isNotNull(), F.col(c))])
    last = updates.groupBy(*keys).agg(F.max_by(F.struct(*others), place).alias("_last"))
    return last.select(*keys, "_last.*").select(*updates.columns)


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str], now: AsOf) -> DataFrame:
    """``target`` with the rows of ``updates`` replaced or added by key.

    Changed and new rows get ``updated_at = now``; the other rows keep theirs. ``updates`` has
    one row per key.
    """
    stamped = updates.withColumn("updated_at", moment(now))
    kept = target.join(updates.select(*keys), list(keys), "left_anti")
    return kept.unionByName(stamped)


def runs(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the complete runs below ``path``: Spark marks a write that has ended."""
    numbers = [int(name.removeprefix("run=")) for name in folders(spark, path) if name.startswith("run=")]
    return sorted(n for n in numbers if is_file(spark, f"{path}/run={n}/_SUCCESS"))


def replace_snapshot(rows: DataFrame, path: str) -> int:
    """Write ``rows`` as the next run of a snapshot table. Returns the number of the run.

    Readers see the run before until this one is complete, and a job may read the snapshot it
    replaces. What an unfinished run left is overwritten. Older runs stay.
    """
    number = max(runs(rows.sparkSession, path), default=0) + 1
    rows.write.mode("overwrite").parquet(f"{path}/run={number}")
    return number


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete run of a snapshot table."""
    number = max(runs(spark, path), default=None)
    if number is None:
        raise FileNotFoundError(f"no complete run of {path}")
    return spark.read.parquet(f"{path}/run={number}")


def upsert_snapshot(
    updates: DataFrame, path: str, keys: Sequence[str], now: AsOf, order: str | Sequence[str] | None = None
) -> int:
    """Upsert into the snapshot table at ``path``.

    Where ``updates`` repeats a key, the row with the largest ``order`` counts; without an order
    a repeated key is an error.
    """
    spark = updates.sparkSession
    if order:
        updates = last_by_key(updates, keys, [order] if isinstance(order, str) else order)
    elif not updates.groupBy(*keys).count().filter("count > 1").isEmpty():
        raise ValueError(f"updates of {path} repeat a key of {list(keys)}; name the column that orders them")
    if not runs(spark, path):
        return replace_snapshot(updates.withColumn("updated_at", moment(now)), path)
    return replace_snapshot(upsert(read_snapshot(spark, path), updates, keys, now), path)


def append_run(rows: DataFrame, run_ts: AsOf, column: str = "predicted_at") -> DataFrame:
    """``rows`` stamped with the one time all results of a run share."""
    return rows.withColumn(column, moment(run_ts))


def write_run(rows: DataFrame, path: str, run_ts: AsOf) -> None:
    """Append the stamped results of one run; a run that is repeated replaces its own."""
    run = "".join(c if c.isalnum() else "-" for c in str(run_ts))
    rows.write.mode("overwrite").parquet(f"{path}/run={run}")
