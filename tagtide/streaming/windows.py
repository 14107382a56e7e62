"""Dashboard panels as continuous queries over event time.

Times must be TIMESTAMP: a watermark cannot be put on a time without zone. Rows later
than the watermark are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tagtide.functions.sentiment import sentiment_category3
from tagtide.functions.times import cutoff, moment
from tagtide.session import folders

WATERMARK = "10 minutes"


def event_time(posts: DataFrame, column: str = "processing_time") -> DataFrame:
    """``posts`` with the column as TIMESTAMP."""
    return posts.withColumn(column, F.col(column).cast("timestamp"))


def _window_start(df: DataFrame, name: str = "time") -> DataFrame:
    start = F.col("window.start").cast("timestamp_ntz").alias(name)
    return df.select(start, *[c for c in df.columns if c != "window"])


def stream_posts_per_minute(posts: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """``time, posts_count, avg_sentiment`` per minute."""
    counted = (
        posts.withWatermark("processing_time", watermark)
        .groupBy(F.window("processing_time", "1 minute").alias("window"))
        .agg(F.count(F.lit(1)).alias("posts_count"), F.avg("sentiment").alias("avg_sentiment"))
    )
    return _window_start(counted)


def stream_hourly_sentiment(posts: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """``time, sentiment_category, count`` per hour."""
    counted = (
        posts.withWatermark("processing_time", watermark)
        .groupBy(
            F.window("processing_time", "1 hour").alias("window"),
            sentiment_category3(F.col("sentiment")).alias("sentiment_category"),
        )
        .agg(F.count(F.lit(1)).alias("count"))
    )
    return _window_start(counted)


def stream_hashtag_minutes(posts: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """``minute_end, hashtag, n``. In output mode ``append`` each minute comes out once, when complete."""
    counted = (
        posts.withWatermark("processing_time", watermark)
        .groupBy(F.window("processing_time", "1 minute").alias("window"), "hashtag")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return counted.select(F.col("window.end").cast("timestamp_ntz").alias("minute_end"), "hashtag", "n")


def hashtag_hours(minutes: DataFrame, after: Column, upto: Column) -> DataFrame:
    """``window_end, hashtag, count``: the last hour, at each minute in ``(after, upto]``.

    A minute adds its posts to the running count of its tag and takes them away an hour later. A
    tag has two changes per minute at most, and only the windows between changes are filled in.
    """
    change = minutes.select("hashtag", F.col("minute_end").alias("at"), "n")
    gone = minutes.select("hashtag", (F.col("minute_end") + F.expr("INTERVAL 60 MINUTES")).alias("at"), -F.col("n"))
    changes = change.union(gone).groupBy("hashtag", "at").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("hashtag").orderBy("at")
    steps = changes.select(
        "hashtag",
        F.greatest("at", after + F.expr("INTERVAL 1 MINUTE")).alias("first"),
        F.least(F.lead("at").over(order) - F.expr("INTERVAL 1 MINUTE"), upto).alias("last"),
        F.sum("n").over(order).alias("count"),
    )
    held = steps.filter("count > 0 AND first <= last")
    ends = F.explode(F.sequence("first", "last", F.expr("INTERVAL 1 MINUTE")))
    return held.select(ends.alias("window_end"), "hashtag", "count")


def rank_hashtags(counts: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` most frequent tags of each window, with ``rank``.

    Spark keeps the ``k`` best of each task before the shuffle.
    """
    order = Window.partitionBy("window_end").orderBy(F.desc("count"), "hashtag")
    return counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def rank_minutes(batch: DataFrame, batch_id: int, path: str, k: int, spark: SparkSession) -> None:
    """Write the complete minutes of one batch, and rank the windows that end with them.

    Tables are read back in ``spark``, where plans adapt to their sizes; a batch has a session of
    its own.
    """
    batch.write.mode("overwrite").parquet(f"{path}/minutes/batch_id={batch_id}")
    reader = spark.read.schema("minute_end timestamp_ntz, hashtag string, n bigint")
    new = reader.parquet(f"{path}/minutes/batch_id={batch_id}")
    hour = reader.parquet(f"{path}/hour/batch_id={batch_id - 1}") if batch_id > 0 else new.limit(0)
    before = hour.agg(F.max("minute_end")).first()[0]
    start, upto = new.agg(F.min("minute_end"), F.max("minute_end")).first()
    minutes = hour.unionByName(new)
    left = minutes.filter(F.col("minute_end") > cutoff(upto, "1 hour")) if upto else hour
    left.write.mode("overwrite").parquet(f"{path}/hour/batch_id={batch_id}")
    if upto:
        after = moment(before) if before else cutoff(start, "1 minute")
        top = rank_hashtags(hashtag_hours(minutes, after, moment(upto)), k)
        top.write.mode("overwrite").parquet(f"{path}/top/batch_id={batch_id}")


def start_top_hashtags(
    posts: DataFrame,
    path: str,
    checkpoint: str,
    watermark: str = WATERMARK,
    k: int = 10,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Write ``window_end, hashtag, count, rank`` for every complete minute to ``path/top``.

    The state holds counts of open minutes only. Each batch writes the minutes it has
    completed to ``path/minutes``, adds those of the hour before, which the previous
    batch left in ``path/hour``, and ranks the windows that end with its own minutes. A
    batch that runs again reads the same folders and replaces its own.
    """
    spark = posts.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        rank_minutes(batch, batch_id, path, k, spark)

    writer = stream_hashtag_minutes(posts, watermark).writeStream.outputMode("append")
    writer = writer.option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.foreachBatch(write).start()


def finish_top_hashtags(spark: SparkSession, path: str, checkpoint: str, k: int = 10) -> None:
    """Rank the minutes that a stream that has ended still holds open, as one more batch.

    For a bounded input: no later post will move the watermark past them. They are read from the
    state in the checkpoint. A stream that goes on later replaces this batch by its own.
    """
    state = spark.read.format("statestore").load(checkpoint)
    value = state.schema["value"].dataType.names[0]
    held = state.select(
        F.col("key.window.end").cast("timestamp_ntz").alias("minute_end"), "key.hashtag", F.col(f"value.{value}").cast("bigint").alias("n")
    )
    last = max(int(name.removeprefix("batch_id=")) for name in folders(spark, f"{path}/minutes"))
    rank_minutes(held, last + 1, path, k, spark)


def start_windows(
    windows: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Write the windows each batch has changed; ``read_windows`` gives the present state."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    writer = windows.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.foreachBatch(write).start()


def read_windows(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The newest values of every window written by ``start_windows``."""
    rows = spark.read.parquet(path)
    values = [c for c in rows.columns if c not in (*keys, "batch_id")]
    newest = F.max_by(F.struct(*values), F.col("batch_id")).alias("v")
    return rows.groupBy(*keys).agg(newest).select(*keys, "v.*")
