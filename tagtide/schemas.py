"""Fixed record layouts: messages, stored tables, resource tables."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


_TAGS = ArrayType(StringType())
_TIME = TimestampNTZType()

RAW_STATUS = _struct(
    tags=ArrayType(_struct(name=StringType())),
    account=_struct(username=StringType()),
    content=StringType(),
    created_at=StringType(),
)

RAW_MESSAGE = _struct(
    user_name=StringType(), content=StringType(), hashtags=_TAGS, timestamp=StringType()
)

# Older producers name the first field differently.
RAW_MESSAGE_LEGACY = _struct(
    user=StringType(), content=StringType(), hashtags=_TAGS, timestamp=StringType()
)

POSTS = _struct(
    user_name=StringType(),
    content=StringType(),
    hashtag=StringType(),
    sentiment=DoubleType(),
    sentiment_category=StringType(),
    dominant_aspect=StringType(),
    content_length=DoubleType(),
    hashtag_count=IntegerType(),
    processing_time=_TIME,
    timestamp=_TIME,
    sentiment_summary=StringType(),
    top_aspect=StringType(),
    top_aspect_sentiment=DoubleType(),
)

ASPECT_SENTIMENTS = _struct(
    user_name=StringType(),
    hashtag=StringType(),
    aspect=StringType(),
    sentiment=DoubleType(),
    processing_time=_TIME,
    timestamp=_TIME,
)

SENTIMENT_STRUCT = _struct(
    overall_sentiment=FloatType(),
    overall_subjectivity=FloatType(),
    sentiment_summary=StringType(),
    top_aspect=StringType(),
    top_aspect_sentiment=FloatType(),
)

HASHTAG_CENTRALITY = _struct(
    hashtag=StringType(),
    degree_centrality=DoubleType(),
    betweenness_centrality=DoubleType(),
    pagerank=DoubleType(),
    updated_at=_TIME,
)

HASHTAG_COMMUNITIES = _struct(hashtag=StringType(), community_id=IntegerType(), updated_at=_TIME)

USER_HASHTAG_NETWORK = _struct(
    user_name=StringType(), hashtag=StringType(), co_occurrence_count=LongType(), last_seen=_TIME
)

USER_CLUSTERS = _struct(
    user_name=StringType(),
    cluster_id=IntegerType(),
    avg_sentiment=DoubleType(),
    avg_content_length=DoubleType(),
    post_count=LongType(),
    unique_hashtags=LongType(),
    updated_at=_TIME,
)

TRENDING_PREDICTIONS = _struct(
    hashtag=StringType(), prediction_score=DoubleType(), current_velocity=DoubleType(), predicted_at=_TIME
)

ANOMALIES = _struct(
    user_name=StringType(),
    hashtag=StringType(),
    anomaly_score=DoubleType(),
    reason=StringType(),
    detected_at=_TIME,
)

EDGES = _struct(src=StringType(), dst=StringType(), weight=LongType())

LEXICON = _struct(
    word=StringType(), polarity=DoubleType(), subjectivity=DoubleType(), intensity=DoubleType()
)

GAZETTEER = _struct(surface=StringType(), type=StringType())

# The longest value each text column may hold, and the required columns.
MAX_LENGTHS = {
    "user_name": 255,
    "hashtag": 255,
    "aspect": 255,
    "dominant_aspect": 255,
    "top_aspect": 255,
    "sentiment_category": 50,
}
REQUIRED = ("user_name", "hashtag", "aspect", "processing_time", "timestamp")

# Primary keys of the result tables.
KEYS = {
    "hashtag_centrality": ("hashtag",),
    "hashtag_communities": ("hashtag", "community_id"),
    "user_hashtag_network": ("user_name", "hashtag"),
    "user_clusters": ("user_name",),
    "trending_predictions": ("hashtag", "predicted_at"),
}
