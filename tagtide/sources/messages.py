"""Message sources: the raw topic, API statuses, the processed topic."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tagtide import schemas
from tagtide.functions.arrays import unnest
from tagtide.operators.quality import conform_schema

# Fields a processed message must carry to be shown.
PROCESSED_FIELDS = ("user", "content", "hashtag", "timestamp")


def kafka_options(bootstrap: str, topic: str, **options: str) -> dict[str, str]:
    """Read a topic from its newest offsets on, and go on if data was lost."""
    return {
        "kafka.bootstrap.servers": bootstrap,
        "subscribe": topic,
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
        **options,
    }


def read_raw(spark: SparkSession, fmt: str = "kafka", path: str | None = None, **options: str) -> DataFrame:
    """The raw topic as a stream with a ``value`` column.

    For Kafka pass ``kafka_options``; any other streaming format takes a path.
    """
    reader = spark.readStream.format(fmt).options(**options)
    return reader.load(path) if path else reader.load()


def parse_messages(raw: DataFrame, schema: StructType = schemas.RAW_MESSAGE) -> DataFrame:
    """JSON values to columns. A malformed value gives a row of NULLs."""
    parsed = F.from_json(F.col("value").cast("string"), schema)
    return raw.select(parsed.alias("data")).select("data.*")


def parse_legacy_messages(raw: DataFrame) -> DataFrame:
    """Messages of older producers, brought to the present layout."""
    return conform_schema(parse_messages(raw, schemas.RAW_MESSAGE_LEGACY), schemas.RAW_MESSAGE)


def normalize_status(statuses: DataFrame) -> DataFrame:
    """API statuses to messages; statuses without tags are dropped."""
    return statuses.select(
        F.col("account.username").alias("user_name"),
        "content",
        F.transform("tags", lambda t: t["name"]).alias("hashtags"),
        F.col("created_at").alias("timestamp"),
    ).filter(F.size("hashtags") > 0)


def explode_hashtags(posts: DataFrame) -> DataFrame:
    """One row per tag of a post. Posts with an empty or NULL array vanish."""
    return unnest(posts, ["*"], "hashtags", "hashtag")


def to_kafka_value(rows: DataFrame) -> DataFrame:
    """Every row as one JSON ``value``; NULL fields are left out."""
    return rows.select(F.to_json(F.struct("*")).alias("value"))


def valid_messages(raw: DataFrame, required: Sequence[str] = PROCESSED_FIELDS) -> DataFrame:
    """Processed messages that carry every required field, other columns kept."""
    fields = StructType([StructField(name, StringType()) for name in required])
    parsed = raw.withColumn("data", F.from_json(F.col("value").cast("string"), fields))
    for name in required:
        parsed = parsed.filter(F.col(f"data.{name}").isNotNull())
    others = [F.col(c) for c in raw.columns if c != "value"]
    return parsed.select(*others, "data.*")


def latest_posts(messages: DataFrame, order: Sequence[str], limit: int = 20) -> DataFrame:
    """The newest messages. ``order`` names the arrival columns, newest first."""
    return messages.orderBy(*[F.col(c).desc() for c in order]).limit(limit)
