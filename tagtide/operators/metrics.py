"""Counts and averages over posts, aspects and result tables.

A row of ``posts`` is one tag of one post, so every "post count" counts those rows.
Counts and averages are combined before the shuffle, and exact distinct counts are
first reduced by (group, value); a hot tag or user is therefore never sent to one
task row by row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagtide.functions.numbers import null_safe_div
from tagtide.functions.sentiment import sentiment_category3
from tagtide.functions.times import AsOf, bucket, since


def _n(alias: str) -> Column:
    return F.count(F.lit(1)).alias(alias)


def _avg(column: str, alias: str) -> Column:
    return F.avg(column).alias(alias)


def _distinct(column: str, alias: str) -> Column:
    return F.countDistinct(column).alias(alias)


def posts_per_minute(posts: DataFrame, as_of: AsOf, window: str = "1 hour") -> DataFrame:
    recent = since(posts, as_of, window)
    return recent.groupBy(bucket(F.col("processing_time"), "minute").alias("time")).agg(_n("posts_count")).orderBy("time")


def sentiment_distribution(posts: DataFrame, as_of: AsOf, window: str = "1 hour") -> DataFrame:
    """One row, also when no post is recent."""
    return since(posts, as_of, window).agg(
        _avg("sentiment", "avg_sentiment"),
        F.stddev_samp("sentiment").alias("sentiment_stddev"),
        F.min("sentiment").alias("min_sentiment"),
        F.max("sentiment").alias("max_sentiment"),
    )


def sentiment_over_time(posts: DataFrame, as_of: AsOf, window: str = "1 hour") -> DataFrame:
    recent = since(posts, as_of, window)
    minute = bucket(F.col("processing_time"), "minute").alias("time")
    return recent.groupBy(minute).agg(_avg("sentiment", "avg_sentiment")).orderBy("time")


def user_activity(posts: DataFrame, as_of: AsOf, window: str = "1 hour") -> DataFrame:
    return since(posts, as_of, window).groupBy("user_name").agg(
        _n("post_count"), _avg("sentiment", "avg_sentiment"), _distinct("hashtag", "unique_hashtags")
    )


def hashtag_counter(posts: DataFrame) -> DataFrame:
    return posts.groupBy("hashtag").agg(_n("count"))


def community_distribution(communities: DataFrame) -> DataFrame:
    sizes = communities.groupBy("community_id").agg(_n("hashtag_count"))
    return sizes.orderBy(F.desc("hashtag_count"), "community_id")


def cluster_summary(clusters: DataFrame) -> DataFrame:
    """The averages are over users, not weighted by their posts."""
    return (
        clusters.groupBy("cluster_id")
        .agg(_n("user_count"), _avg("avg_sentiment", "cluster_sentiment"), _avg("post_count", "avg_posts"))
        .orderBy("cluster_id")
    )


def hourly_sentiment_volume(posts: DataFrame, as_of: AsOf, window: str = "24 hours") -> DataFrame:
    """Posts per hour and label. The label is computed here, not read from the table."""
    recent = since(posts, as_of, window)
    return (
        recent.groupBy(
            bucket(F.col("processing_time"), "hour").alias("time"),
            sentiment_category3(F.col("sentiment")).alias("sentiment_category"),
        )
        .agg(_n("count"))
        .orderBy("time", "sentiment_category")
    )


def recent_posts_summary(posts: DataFrame, as_of: AsOf, window: str = "24 hours") -> DataFrame:
    return (
        since(posts, as_of, window)
        .groupBy(bucket(F.col("processing_time"), "hour").alias("hour"))
        .agg(
            _n("post_count"),
            _avg("sentiment", "avg_sentiment"),
            _distinct("user_name", "unique_users"),
            _distinct("hashtag", "unique_hashtags"),
        )
        .orderBy(F.desc("hour"))
    )


def hashtag_stats_base(posts: DataFrame) -> DataFrame:
    return posts.groupBy("hashtag").agg(
        _n("total_posts"),
        _avg("sentiment", "avg_sentiment"),
        _distinct("user_name", "unique_users"),
        F.max("processing_time").alias("last_seen"),
    )


def hashtag_stats_nonnull(posts: DataFrame) -> DataFrame:
    return hashtag_stats_base(posts.filter(F.col("user_name").isNotNull()))


def hashtag_stats(posts: DataFrame) -> DataFrame:
    return posts.groupBy("hashtag").agg(
        _n("total_posts"),
        _avg("sentiment", "avg_sentiment"),
        _distinct("user_name", "unique_users"),
        F.max("processing_time").alias("last_seen"),
        _distinct("dominant_aspect", "unique_aspects"),
        F.min("processing_time").alias("first_seen"),
    )


def aspect_stats(aspects: DataFrame, min_count: int = 3) -> DataFrame:
    return (
        aspects.groupBy("aspect")
        .agg(
            _n("mention_count"),
            _avg("sentiment", "avg_sentiment"),
            F.stddev_samp("sentiment").alias("sentiment_stddev"),
            _distinct("hashtag", "hashtag_count"),
            _distinct("user_name", "user_count"),
            F.max("processing_time").alias("last_seen"),
            F.min("processing_time").alias("first_seen"),
        )
        .filter(F.col("mention_count") >= min_count)
    )


def hashtag_aspect_sentiment(aspects: DataFrame, min_count: int = 2) -> DataFrame:
    return (
        aspects.groupBy("hashtag", "aspect")
        .agg(
            _n("co_occurrence"),
            _avg("sentiment", "avg_aspect_sentiment"),
            F.stddev_samp("sentiment").alias("sentiment_stddev"),
            F.max("processing_time").alias("last_seen"),
        )
        .filter(F.col("co_occurrence") >= min_count)
    )


def trending_aspects(aspects: DataFrame, as_of: AsOf, min_count: int = 5, window: str = "1 hour") -> DataFrame:
    return (
        since(aspects, as_of, window)
        .groupBy("aspect")
        .agg(_n("recent_mentions"), _avg("sentiment", "avg_sentiment"), _distinct("hashtag", "hashtag_spread"))
        .filter(F.col("recent_mentions") >= min_count)
        .orderBy(F.desc("recent_mentions"), "aspect")
    )


def aspect_counts(aspects: DataFrame) -> DataFrame:
    return aspects.groupBy("aspect").agg(_n("count"))


def user_features(posts: DataFrame, as_of: AsOf, min_posts: int = 5, window: str = "7 days") -> DataFrame:
    return (
        since(posts, as_of, window)
        .groupBy("user_name")
        .agg(
            _avg("sentiment", "avg_sentiment"),
            _avg("content_length", "avg_content_length"),
            _n("post_count"),
            _distinct("hashtag", "unique_hashtags"),
        )
        .filter(F.col("post_count") >= min_posts)
    )


def hourly_counts(
    posts: DataFrame, as_of: AsOf, window: str = "24 hours", unit: str = "hour"
) -> DataFrame:
    """Posts per tag and bucket. Buckets without posts are absent, not zero."""
    recent = since(posts, as_of, window)
    return recent.groupBy("hashtag", bucket(F.col("processing_time"), unit).alias("hour")).agg(_n("count"))


def hashtag_velocity(hourly: DataFrame, min_buckets: int = 3) -> DataFrame:
    """Spread of the bucket counts per bucket. Whole numbers divide to a whole number."""
    grouped = hourly.groupBy("hashtag").agg(
        _avg("count", "avg_count"),
        F.stddev_samp("count").alias("stddev_count"),
        F.max("count").alias("hi"),
        F.min("count").alias("lo"),
        _n("n"),
    )
    return grouped.filter(F.col("n") >= min_buckets).select(
        "hashtag", "avg_count", "stddev_count", F.expr("(hi - lo) div n").alias("velocity")
    )


def user_recent_stats(posts: DataFrame, as_of: AsOf, window: str = "1 hour") -> DataFrame:
    return since(posts, as_of, window).groupBy("user_name").agg(
        _n("recent_posts"), _avg("sentiment", "avg_sentiment"), _distinct("hashtag", "unique_tags")
    )


def user_hourly_history(posts: DataFrame, as_of: AsOf, window: str = "7 days") -> DataFrame:
    """Posts per active hour of each user. The current hour counts; idle hours do not."""
    per_hour = (
        since(posts, as_of, window)
        .groupBy("user_name", bucket(F.col("processing_time"), "hour").alias("hour"))
        .agg(_n("posts"))
    )
    return per_hour.groupBy("user_name").agg(
        _avg("posts", "avg_posts_per_hour"), F.stddev_samp("posts").alias("stddev_posts")
    )


def recent_vs_history(
    posts: DataFrame, as_of: AsOf, recent: str = "1 hour", history: str = "7 days"
) -> DataFrame:
    """The last hour of each user against the hours of the last week, as z-score."""
    now = user_recent_stats(posts, as_of, recent).select("user_name", "recent_posts")
    past = user_hourly_history(posts, as_of, history).filter(F.col("stddev_posts") > 0)
    z = null_safe_div(F.col("recent_posts") - F.col("avg_posts_per_hour"), F.col("stddev_posts"))
    return now.join(past, "user_name").withColumn("z_score", z)


def user_hashtag_network(posts: DataFrame) -> DataFrame:
    return posts.groupBy("user_name", "hashtag").agg(
        _n("co_occurrence_count"), F.max("processing_time").alias("last_seen")
    )


def user_null_audit(posts: DataFrame) -> DataFrame:
    user = F.col("user_name")
    return posts.agg(
        F.count_if(user.isNull()).alias("null_users"),
        F.count_if(user.isNotNull()).alias("with_users"),
        _n("total"),
    )


def score_bounds(scores: DataFrame, column: str = "prediction_score") -> DataFrame:
    return scores.agg(F.min(column).alias("min_score"), F.max(column).alias("max_score"))
