"""Posts, aspects, messages and resources derived from the given test tables.

``events`` become posts with two tags each, ``documents`` and ``pages`` become posts
with text. All of it is a projection of the whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagtide import schemas
from tagtide.functions.arrays import let

AS_OF = "2024-01-31 00:00:00"
DOCUMENT_TIME = "2024-01-30 00:00:00"


def spread_rows(df: DataFrame, key: str) -> DataFrame:
    """``df`` over all cores, if it comes in fewer splits than there are cores.

    For texts in a few test files, where the work per row is heavy.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.isStreaming or df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, key)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def table_stream(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A table as a stream of its files, be it one file or a folder of them.

    The pattern matches the table alone: a stream over the plain path of a file fails, as Spark takes it for a folder.
    """
    return spark.readStream.schema(table(spark, sf, name).schema).parquet(f"{sf}/{name}.parque[t]")


def _post_columns(events: DataFrame) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    return events.select(
        F.col("event_id").alias("post_id"),
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("user_name"),
        F.array("event_type", F.concat(F.lit("k"), k.cast("string"))).alias("hashtags"),
        F.greatest(F.lit(-1.0), F.least(F.lit(1.0), (F.col("value") - 50) / 60)).alias("sentiment"),
        ((F.col("event_id") * 37) % 500).cast("double").alias("content_length"),
        F.lit(2).alias("hashtag_count"),
        F.concat(F.lit("a"), F.floor(k / 10).cast("string")).alias("dominant_aspect"),
        F.concat(F.lit("a"), k.cast("string")).alias("aspect"),
        "event_type",
        F.col("ts").alias("processing_time"),
        F.col("ts").alias("timestamp"),
    )


def posts(spark: SparkSession, sf: str) -> DataFrame:
    """One row per event and tag."""
    rows = _post_columns(table(spark, sf, "events"))
    return rows.drop("aspect", "event_type").withColumn("hashtag", F.explode("hashtags")).drop("hashtags")


def posts_stream(spark: SparkSession, sf: str) -> DataFrame:
    """``posts`` as a stream, with event time as TIMESTAMP."""
    rows = _post_columns(table_stream(spark, sf, "events")).drop("aspect", "event_type")
    return rows.withColumn("hashtag", F.explode("hashtags")).drop("hashtags").withColumn(
        "processing_time", F.col("processing_time").cast("timestamp")
    )


def aspects(spark: SparkSession, sf: str) -> DataFrame:
    """One aspect per event."""
    return _post_columns(table(spark, sf, "events")).select(
        "user_name", F.col("event_type").alias("hashtag"), "aspect", "sentiment", "processing_time", "timestamp"
    )


def text_posts(spark: SparkSession, sf: str) -> DataFrame:
    """One post per document, tagged with its language and source."""
    return spread_rows(table(spark, sf, "documents"), "doc_id").select(
        F.col("doc_id").alias("post_id"),
        F.concat(F.lit("user_"), (F.col("doc_id") % 50).cast("string")).alias("user_name"),
        F.col("text").alias("content"),
        F.array("lang", "source").alias("hashtags"),
    )


def page_posts(spark: SparkSession, sf: str) -> DataFrame:
    """One post per page, with tags in its content."""
    return spread_rows(table(spark, sf, "pages"), "page_id").select(F.col("page_id").alias("post_id"), F.col("html").alias("content"))


def _iso(number: Column) -> Column:
    """Seconds after the start of the document day, as ISO text with an offset."""
    at = F.timestamp_add("SECOND", number % 86400, F.lit(DOCUMENT_TIME).cast("timestamp_ntz"))
    return F.concat(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00"))


def statuses(spark: SparkSession, sf: str) -> DataFrame:
    """API statuses, one per document; every fifth has no tags."""
    return _statuses_of(table(spark, sf, "documents"))


def _statuses_of(documents: DataFrame) -> DataFrame:
    named = F.array(F.struct(F.col("lang").alias("name")), F.struct(F.col("source").alias("name")))
    none = F.array().cast("array<struct<name:string>>")
    return documents.select(
        F.when(F.col("doc_id") % 5 == 0, none).otherwise(named).alias("tags"),
        F.struct(F.concat(F.lit("user_"), (F.col("doc_id") % 50).cast("string")).alias("username")).alias("account"),
        F.col("text").alias("content"),
        _iso(F.col("doc_id")).alias("created_at"),
    )


def _values_of(documents: DataFrame) -> DataFrame:
    """Raw JSON messages. Every seventh is cut off, so that it cannot be parsed."""
    statuses = _statuses_of(documents.select("doc_id", "lang", "source", "text"))
    message = F.to_json(
        F.struct(
            F.col("account.username").alias("user_name"),
            "content",
            F.transform("tags", lambda t: t["name"]).alias("hashtags"),
            F.col("created_at").alias("timestamp"),
        )
    )
    broken = F.length("content") % 7 == 0
    return statuses.select(F.when(broken, F.concat(F.lit("{"), message)).otherwise(message).alias("value"))


def raw_values(spark: SparkSession, sf: str) -> DataFrame:
    return _values_of(spread_rows(table(spark, sf, "documents"), "doc_id"))


def raw_values_stream(spark: SparkSession, sf: str) -> DataFrame:
    return _values_of(table_stream(spark, sf, "documents"))


def lexicon(spark: SparkSession, sf: str) -> DataFrame:
    """A lexicon over the words of ``benchmark``, rated by their length."""
    found = F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0)))
    words = table(spark, sf, "benchmark").select(found.alias("word")).distinct()
    n = F.length("word")
    return words.select(
        "word",
        ((n % 5 - 2) / 2).alias("polarity"),
        (n % 3 / 2).alias("subjectivity"),
        F.when(n == 2, 1.5).otherwise(1.0).alias("intensity"),
    ).select(*schemas.LEXICON.fieldNames())


def gazetteer(spark: SparkSession, sf: str) -> DataFrame:
    """Capitalised words of ``benchmark`` and the pairs they begin, typed by length."""
    pair, single = r"\p{Lu}\p{L}{3,} \p{L}+", r"\p{Lu}\p{L}{5,}"
    found = F.concat(
        F.regexp_extract_all("text", F.lit(pair), F.lit(0)), F.regexp_extract_all("text", F.lit(single), F.lit(0))
    )
    surfaces = table(spark, sf, "benchmark").select(F.explode(F.transform(found, lambda s: F.lower(s))).alias("surface"))
    surfaces = surfaces.distinct()
    kinds = F.array(*[F.lit(t) for t in ("PERSON", "ORG", "GPE", "PRODUCT", "EVENT")])
    return surfaces.select("surface", let(kinds, lambda t: F.get(t, F.length("surface") % 5)).alias("type"))


def user_clusters(spark: SparkSession, sf: str) -> DataFrame:
    """All users with their features; the cluster follows from the post count."""
    from tagtide.operators.metrics import user_features

    features = user_features(posts(spark, sf), AS_OF, 1, "31 days")
    return features.withColumn("cluster_id", (F.col("post_count") % 5).cast("int"))


def hashtag_communities(spark: SparkSession, sf: str) -> DataFrame:
    """All tags; the community follows from the length of the tag."""
    return posts(spark, sf).select("hashtag").distinct().withColumn("community_id", F.length("hashtag"))
