"""The stored views of the dashboard, as temporary views of a session."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tagtide.functions.times import AsOf
from tagtide.operators import metrics


def register_views(posts: DataFrame, aspects: DataFrame, as_of: AsOf = None) -> list[str]:
    """Make the tables and the live views known to ``spark.sql``. Returns the names."""
    views = {
        "posts": posts,
        "aspect_sentiments": aspects,
        "hashtag_stats": metrics.hashtag_stats(posts),
        "aspect_stats": metrics.aspect_stats(aspects),
        "hashtag_aspect_sentiment": metrics.hashtag_aspect_sentiment(aspects),
        "recent_posts_summary": metrics.recent_posts_summary(posts, as_of),
        "trending_aspects": metrics.trending_aspects(aspects, as_of),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)
