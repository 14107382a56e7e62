"""Ordered reports. Ties are broken by the key, so every report is deterministic.

``orderBy`` with ``limit`` keeps the k best rows of each task and merges those.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagtide.functions.numbers import round_n
from tagtide.functions.text import snippet
from tagtide.functions.times import AsOf, since
from tagtide.operators.metrics import aspect_counts, hashtag_counter, user_activity


def top_hashtags(posts: DataFrame, as_of: AsOf, limit: int = 10, window: str = "1 hour") -> DataFrame:
    return hashtag_counter(since(posts, as_of, window)).orderBy(F.desc("count"), "hashtag").limit(limit)


def top_users(posts: DataFrame, as_of: AsOf, limit: int = 20, window: str = "1 hour") -> DataFrame:
    return user_activity(posts, as_of, window).orderBy(F.desc("post_count"), "user_name").limit(limit)


def top_central_hashtags(centrality: DataFrame, limit: int = 20) -> DataFrame:
    best = centrality.orderBy(F.desc("pagerank"), "hashtag").limit(limit)
    return best.select(
        "hashtag",
        round_n(F.col("degree_centrality"), 4).alias("degree"),
        round_n(F.col("betweenness_centrality"), 4).alias("betweenness"),
        round_n(F.col("pagerank"), 4).alias("pagerank"),
    )


def velocity_top(velocity: DataFrame, limit: int = 50) -> DataFrame:
    return velocity.orderBy(F.desc_nulls_first("velocity"), "hashtag").limit(limit)


def dash_top10(posts: DataFrame, arrival: str = "post_id", limit: int = 10) -> DataFrame:
    """All-time counts; the tag seen first wins a tie."""
    counted = posts.groupBy("hashtag").agg(F.count(F.lit(1)).alias("Count"), F.min(arrival).alias("first"))
    best = counted.orderBy(F.desc("Count"), "first", "hashtag").limit(limit)
    return best.select(F.col("hashtag").alias("Hashtag"), "Count")


def latest_run(df: DataFrame, ts_col: str = "predicted_at") -> DataFrame:
    """The rows of the newest run. The newest time reaches the scan as a filter."""
    newest = df.agg(F.max(ts_col)).scalar()
    return df.filter(F.col(ts_col) == newest)


def trending_top(predictions: DataFrame, limit: int = 15) -> DataFrame:
    best = latest_run(predictions).select("hashtag", "prediction_score")
    return best.orderBy(F.desc_nulls_first("prediction_score"), "hashtag").limit(limit)


def recent_anomalies(anomalies: DataFrame, as_of: AsOf, limit: int = 20, window: str = "1 hour") -> DataFrame:
    newest = since(anomalies, as_of, window, "detected_at")
    best = newest.orderBy(F.desc("detected_at"), "user_name").limit(limit)
    return best.select(
        F.col("detected_at").alias("time"),
        "user_name",
        round_n(F.col("anomaly_score"), 2).alias("score"),
        "reason",
    )


def velocity_alerts(
    predictions: DataFrame, as_of: AsOf, min_score: float = 0.7, window: str = "15 minutes"
) -> DataFrame:
    return (
        since(predictions, as_of, window, "predicted_at")
        .filter(F.col("prediction_score") > min_score)
        .select("hashtag", "current_velocity", "prediction_score")
        .orderBy(F.desc("prediction_score"), "hashtag")
    )


def posts_sample(posts: DataFrame, order: list[str], n: int = 5) -> DataFrame:
    """A few rows with the start of the content."""
    return posts.orderBy(*order).limit(n).select(
        "user_name", "hashtag", snippet(F.col("content"), 50).alias("content_preview")
    )


def top_aspects(aspects: DataFrame, limit: int = 10) -> DataFrame:
    return aspect_counts(aspects).orderBy(F.desc("count"), "aspect").limit(limit)
