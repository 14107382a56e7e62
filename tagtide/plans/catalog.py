"""One query per operator, over the whole test tables.

Names are those of the operators. Doubles are rounded to six places, because the order
of a sum decides its last digits.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tagtide import schemas
from tagtide.functions import numbers, sentiment, text, times
from tagtide.operators import graph, learning, metrics, quality, texts, topk, upkeep
from tagtide.functions.arrays import unnest
from tagtide.operators.betweenness import betweenness, betweenness_within
from tagtide.operators.communities import communities, modularity
from tagtide.operators.skew import is_small, lookup
from tagtide.session import configure, cut_lineage, scratch_path
from tagtide.sources import fixtures, messages, tables
from tagtide.sources.fixtures import AS_OF
from tagtide.streaming import ingest as ingesting
from tagtide.streaming import windows

Query = Callable[[SparkSession, str], DataFrame]

MONTH = "31 days"
NOW = {"availableNow": True}
QUERIES: dict[str, Query] = {}


def _six(name: str) -> Column:
    return F.round(F.col(name).cast("decimal(30,12)"), 6).cast("double").alias(name)


def rounded(df: DataFrame) -> DataFrame:
    """Doubles and floats to six decimal places, in decimal so that ties go one way."""
    return df.select(*[_six(c) if t in ("double", "float") else F.col(c) for c, t in df.dtypes])


def query(fn: Query, name: str | None = None) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return rounded(fn(configure(spark), sf))

    QUERIES[name or fn.__name__] = run
    return fn


def columns_of(fn: Query, keys: list[str], names: dict[str, list[str]]) -> None:
    """Register parts of a query with several columns, one name per operator."""
    for name, columns in names.items():
        query(lambda spark, sf, columns=columns: fn(spark, sf).select(*keys, *columns), name)


def on_posts(name: str, op: Callable[..., DataFrame], *args, **kwargs) -> None:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return rounded(op(fixtures.posts(configure(spark), sf), *args, **kwargs))

    QUERIES[name] = run


def on_aspects(name: str, op: Callable[..., DataFrame], *args, **kwargs) -> None:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return rounded(op(fixtures.aspects(configure(spark), sf), *args, **kwargs))

    QUERIES[name] = run


# Panels and views over posts, with their own window and over the whole month

on_posts("posts_per_minute", metrics.posts_per_minute, AS_OF)
on_posts("posts_per_minute_month", metrics.posts_per_minute, AS_OF, MONTH)
on_posts("sentiment_distribution", metrics.sentiment_distribution, AS_OF)
on_posts("sentiment_distribution_month", metrics.sentiment_distribution, AS_OF, MONTH)
on_posts("sentiment_over_time", metrics.sentiment_over_time, AS_OF)
on_posts("sentiment_over_time_month", metrics.sentiment_over_time, AS_OF, MONTH)
on_posts("top_users", topk.top_users, AS_OF)
on_posts("top_users_month", topk.top_users, AS_OF, window=MONTH)
on_posts("top_hashtags", topk.top_hashtags, AS_OF)
on_posts("top_hashtags_month", topk.top_hashtags, AS_OF, window=MONTH)
on_posts("hourly_sentiment_volume", metrics.hourly_sentiment_volume, AS_OF)
on_posts("hourly_sentiment_volume_month", metrics.hourly_sentiment_volume, AS_OF, MONTH)
on_posts("recent_posts_summary", metrics.recent_posts_summary, AS_OF)
on_posts("recent_posts_summary_month", metrics.recent_posts_summary, AS_OF, MONTH)
on_posts("hashtag_stats", metrics.hashtag_stats)
on_posts("hashtag_stats_base", metrics.hashtag_stats_base)
on_posts("user_features", metrics.user_features, AS_OF)
on_posts("hourly_counts", metrics.hourly_counts, AS_OF)
on_posts("user_recent_stats", metrics.user_recent_stats, AS_OF)
on_posts("user_hourly_history", metrics.user_hourly_history, AS_OF)
on_posts("user_hashtag_network", metrics.user_hashtag_network)
on_posts("hashtag_counter", metrics.hashtag_counter)
on_posts("recent_vs_history", metrics.recent_vs_history, AS_OF)
on_posts("recent_filter", times.since, AS_OF, "24 hours")
on_posts("posts_scan", tables.posts_since, AS_OF, "7 days")
on_posts("dash_top10", topk.dash_top10)
on_posts("detect_anomalies", learning.detect_anomalies, AS_OF)
on_posts("predict_trending", learning.predict_trending, AS_OF)
on_posts("predict_trending_daily", learning.predict_trending, AS_OF, "day", "7 days")
on_posts("cluster_users", learning.cluster_users, AS_OF)
on_posts("cooccurrence_edges", graph.cooccurrence_edges, AS_OF)
on_posts("cooccurrence_edges_month", graph.cooccurrence_edges, AS_OF, 31 * 24)

on_aspects("aspect_stats", metrics.aspect_stats)
on_aspects("hashtag_aspect_sentiment", metrics.hashtag_aspect_sentiment)
on_aspects("trending_aspects", metrics.trending_aspects, AS_OF, window="24 hours")
on_aspects("trending_aspects_hour", metrics.trending_aspects, AS_OF, min_count=1)
on_aspects("aspect_counts", metrics.aspect_counts)
on_aspects("top_aspects", topk.top_aspects)


def _some_null_users(spark: SparkSession, sf: str) -> DataFrame:
    user = F.when(F.col("post_id") % 10 != 0, F.col("user_name"))
    return fixtures.posts(spark, sf).withColumn("user_name", user)


@query
def hashtag_stats_nonnull(spark, sf):
    return metrics.hashtag_stats_nonnull(_some_null_users(spark, sf))


@query
def user_null_audit(spark, sf):
    return metrics.user_null_audit(_some_null_users(spark, sf))


@query
def community_distribution(spark, sf):
    return metrics.community_distribution(fixtures.hashtag_communities(spark, sf))


@query
def cluster_summary(spark, sf):
    return metrics.cluster_summary(fixtures.user_clusters(spark, sf))


@query
def hashtag_velocity(spark, sf):
    return metrics.hashtag_velocity(metrics.hourly_counts(fixtures.posts(spark, sf), AS_OF, "7 days", "day"))


@query
def hashtag_velocity_hourly(spark, sf):
    return metrics.hashtag_velocity(metrics.hourly_counts(fixtures.posts(spark, sf), AS_OF))


@query
def velocity_top50(spark, sf):
    return topk.velocity_top(hashtag_velocity(spark, sf))


# Result tables. Two runs a day apart, so that the newest must be picked.


def _predictions(spark: SparkSession, sf: str) -> DataFrame:
    posts = fixtures.posts(spark, sf)
    before = learning.predict_trending(posts, "2024-01-30 00:00:00", "day", "7 days")
    return before.unionByName(learning.predict_trending(posts, AS_OF, "day", "7 days"))


@query
def score_bounds(spark, sf):
    return metrics.score_bounds(_predictions(spark, sf))


@query
def latest_run(spark, sf):
    return topk.latest_run(_predictions(spark, sf))


@query
def trending_top15(spark, sf):
    return topk.trending_top(_predictions(spark, sf))


@query
def velocity_alerts(spark, sf):
    return topk.velocity_alerts(_predictions(spark, sf), AS_OF, window="1 hours")


@query
def velocity_alerts_quarter(spark, sf):
    """With the panel's own quarter of an hour."""
    return topk.velocity_alerts(_predictions(spark, sf), AS_OF, window="15 minutes")


@query
def raw_source(spark, sf):
    """A folder of JSON lines, read as the raw stream and parsed, malformed values and all."""
    path, out, checkpoint = scratch_path(spark, "raw"), scratch_path(spark, "messages"), scratch_path(spark, "state")
    fixtures.raw_values(spark, sf).select("value").write.text(path)
    rows = messages.parse_messages(messages.read_raw(spark, "text", path))
    stream = rows.writeStream.option("checkpointLocation", checkpoint).trigger(**NOW).format("parquet")
    stream.start(out).awaitTermination()
    return spark.read.schema(rows.schema).parquet(out).withColumn("hashtags", F.array_join("hashtags", ","))


@query
def recent_anomalies(spark, sf):
    found = learning.detect_anomalies(fixtures.posts(spark, sf), AS_OF, threshold=1.0)
    return topk.recent_anomalies(found, "2024-01-31 00:30:00")


@query
def append_run(spark, sf):
    path = scratch_path(spark, "runs")
    for day in ("2024-01-30 00:00:00", AS_OF):
        tables.write_run(learning.predict_trending(fixtures.posts(spark, sf), day, "day", "7 days"), path, day)
    return spark.read.parquet(path).drop("run")


# Joins and scalar functions over texts


@query
def clean_html(spark, sf):
    return fixtures.page_posts(spark, sf).select("post_id", text.clean_html(F.col("content")).alias("clean"))


@query
def content_length(spark, sf):
    return fixtures.page_posts(spark, sf).select("post_id", text.content_length(F.col("content")).alias("content_length"))


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    posts = fixtures.text_posts(spark, sf).unionByName(
        fixtures.page_posts(spark, sf).withColumn("post_id", -1 - F.col("post_id")), allowMissingColumns=True
    )
    posts = posts.withColumn("clean", text.clean_html(F.col("content")))
    return posts.withColumn("score", sentiment.score_simple(F.col("clean")))


@query
def score_simple(spark, sf):
    return _scored(spark, sf).select("post_id", "score")


@query
def sentiment_labels(spark, sf):
    """Labels of the five- and three-way rules and the tone, for 32-bit scores."""
    score = F.col("sentiment").cast("float")
    return fixtures.posts(spark, sf).select(
        "post_id",
        "hashtag",
        sentiment.sentiment_category5(score).alias("category5"),
        sentiment.sentiment_category3(score).alias("category3"),
        sentiment.tone(score).alias("tone"),
    )


@query
def simple_aspect(spark, sf):
    return _scored(spark, sf).select("post_id", text.simple_aspect(F.col("clean")).alias("aspect"))


@query
def inline_hashtags(spark, sf):
    tagged = F.concat(F.regexp_replace("content", "(?m)^", "#"), F.lit(" #Café_1"))
    return fixtures.text_posts(spark, sf).select(
        "post_id", F.array_join(text.inline_hashtags(tagged), " ").alias("tags")
    )


@query
def split_sentences(spark, sf):
    return _scored(spark, sf).select(
        "post_id",
        F.size(text.split_sentences(F.col("clean"), "period")).alias("parts"),
        F.size(text.split_sentences(F.col("clean"))).alias("sentences"),
    )


@query
def scalar_functions(spark, sf):
    """Length band, snippet, buckets, rounding, guarded division, defaults."""
    posts = fixtures.posts(spark, sf)
    s, n = F.col("sentiment"), F.col("content_length")
    return posts.select(
        "post_id",
        "hashtag",
        text.hashtag_count(F.array("hashtag", "user_name")).alias("tags"),
        text.length_band(F.col("hashtag"), 3, 5).alias("in_band"),
        text.snippet(F.col("hashtag"), 2).alias("start"),
        text.norm_aspect(F.concat(F.lit("  "), F.upper("hashtag"))).alias("aspect"),
        times.bucket(F.col("processing_time"), "minute").alias("minute"),
        times.bucket(F.col("processing_time"), "hour").alias("hour"),
        numbers.round_n(s, 4).alias("rounded"),
        numbers.round_binary(s, 3).alias("rounded_binary"),
        numbers.fixed_point(s, 2).alias("fixed"),
        numbers.null_safe_div(s, n).alias("ratio"),
        numbers.falsy_to_zero(F.when(n > 100, s)).alias("filled"),
        numbers.abs_z(s).alias("magnitude"),
        sentiment.reason_text(F.col("post_id"), s).alias("reason"),
        sentiment.summary_pronounced(s, F.when(n > 50, F.col("hashtag")), s).alias("summary"),
    )


columns_of(
    sentiment_labels,
    ["post_id", "hashtag"],
    {"sentiment_category5": ["category5"], "sentiment_category3": ["category3"], "tone": ["tone"]},
)
columns_of(
    scalar_functions,
    ["post_id", "hashtag"],
    {
        "hashtag_count": ["tags"],
        "length_band": ["in_band"],
        "snippet": ["start"],
        "norm_aspect": ["aspect"],
        "date_trunc": ["minute", "hour"],
        "round_n": ["rounded", "rounded_binary", "fixed"],
        "null_safe_div": ["ratio"],
        "falsy_to_zero": ["filled"],
        "abs_z": ["magnitude"],
        "reason_text": ["reason"],
        "summary_pronounced": ["summary"],
    },
)


@query
def iso_timestamp(spark, sf):
    stated = F.when(F.size("tags") > 0, F.col("created_at")).otherwise(F.lit("not a time"))
    return fixtures.statuses(spark, sf).select(
        F.col("account.username").alias("user_name"), times.parse_iso(stated).alias("said")
    )


@query
def fill_zero(spark, sf):
    sparse = fixtures.user_clusters(spark, sf).withColumn(
        "avg_sentiment", F.when(F.col("cluster_id") > 1, F.col("avg_sentiment"))
    )
    return numbers.fill_zero(sparse, ["avg_sentiment"])


@query
def lexicon_lookup(spark, sf):
    """Matches of the lexicon words in the texts, per word."""
    words = unnest(fixtures.text_posts(spark, sf), ["post_id"], text.tokens(text.clean_html(F.col("content"))), "word", pos="pos")
    lexicon = texts.known_words(fixtures.lexicon(spark, sf))
    found = lookup(words, lexicon, "word", ["post_id", "pos"], is_small(lexicon, "word"))
    return found.groupBy("word", "polarity").agg(F.count(F.lit(1)).alias("n"))


@query
def sentence_scores(spark, sf):
    return texts.sentence_scores(fixtures.text_posts(spark, sf))


@query
def lexicon_sentiment(spark, sf):
    return texts.lexicon_sentiment(fixtures.text_posts(spark, sf), fixtures.lexicon(spark, sf))


@query
def lexicon_sentence_scores(spark, sf):
    scores = texts.sentence_scores(fixtures.text_posts(spark, sf), lexicon=fixtures.lexicon(spark, sf))
    return scores.select("post_id", "pos", "score")


@query
def phrase_candidates(spark, sf):
    return texts.phrase_candidates(fixtures.text_posts(spark, sf))


@query
def dominant_phrase(spark, sf):
    return texts.dominant_phrase(texts.phrase_candidates(fixtures.text_posts(spark, sf)))


@query
def aspect_sentiments(spark, sf):
    return texts.aspect_sentiments(fixtures.text_posts(spark, sf))


@query
def aspect_sentences(spark, sf):
    posts = fixtures.text_posts(spark, sf)
    aspects = texts.entity_rows(posts, fixtures.gazetteer(spark, sf)).select("post_id", F.col("surface").alias("aspect"))
    found = texts.aspect_sentences(aspects.distinct(), texts.sentence_scores(posts))
    return found.select("post_id", "aspect", "pos", "score")


@query
def aspect_mean(spark, sf):
    posts = fixtures.text_posts(spark, sf)
    aspects = texts.entity_rows(posts, fixtures.gazetteer(spark, sf)).select("post_id", F.col("surface").alias("aspect"))
    sentences = texts.sentence_scores(posts, lexicon=fixtures.lexicon(spark, sf))
    return texts.aspect_mean(texts.aspect_sentences(aspects.distinct(), sentences))


def _tags(posts: DataFrame) -> DataFrame:
    """The two longest-known function words of each language serve as tags."""
    return posts.select("post_id", F.explode(F.array(F.lit("The"), F.lit("ch"), F.col("hashtags")[0])).alias("hashtag"))


@query
def hashtag_sentences(spark, sf):
    posts = fixtures.text_posts(spark, sf)
    lexicon = fixtures.lexicon(spark, sf)
    overall = texts.lexicon_sentiment(posts, lexicon).select("post_id", F.col("polarity").alias("overall"))
    return texts.hashtag_sentences(_tags(posts), texts.sentence_scores(posts, lexicon=lexicon), overall)


def _rated_aspects(spark: SparkSession, sf: str) -> DataFrame:
    """Sentences as aspects: position, a name, the lexicon score, the start as context."""
    scores = texts.sentence_scores(fixtures.text_posts(spark, sf), lexicon=fixtures.lexicon(spark, sf))
    return scores.select(
        "post_id", "pos", F.concat(F.lit("s"), F.col("pos").cast("string")).alias("aspect"),
        _six("score").alias("sentiment"), text.snippet(F.col("sentence"), 100).alias("context"),
    )


@query
def top_aspects_by_intensity(spark, sf):
    return texts.top_aspects_by_intensity(_rated_aspects(spark, sf).drop("context"))


@query
def most_pronounced_aspect(spark, sf):
    return texts.most_pronounced_aspect(_rated_aspects(spark, sf))


@query
def related_aspects(spark, sf):
    found = texts.related_aspects(_rated_aspects(spark, sf), _tags(fixtures.text_posts(spark, sf)))
    return found.withColumn("related_aspects", F.array_join("related_aspects", " "))


@query
def first_aspect(spark, sf):
    return fixtures.text_posts(spark, sf).select(
        "post_id", text.first_aspect(text.clean_html(F.col("content"))).alias("aspect")
    )


@query
def entity_aspects(spark, sf):
    return texts.entity_aspects(fixtures.text_posts(spark, sf), fixtures.gazetteer(spark, sf))


@query
def post_sentiment_struct(spark, sf):
    return texts.post_sentiment(_scored(spark, sf).select("post_id", "content"))


columns_of(post_sentiment_struct, ["post_id"], {"summary_text": ["sentiment_summary"]})


@query
def post_sentiment_lexicon(spark, sf):
    found = texts.post_sentiment(
        fixtures.text_posts(spark, sf), "lexicon",
        lexicon=fixtures.lexicon(spark, sf), gazetteer=fixtures.gazetteer(spark, sf),
    )
    return found.drop("user_name", "content", "hashtags")


def _rich(spark: SparkSession, sf: str) -> DataFrame:
    return texts.rich_analysis(fixtures.text_posts(spark, sf), fixtures.gazetteer(spark, sf))


def _listed(aspects: str) -> Column:
    """All fields of all aspects, in order, a line each."""
    score = lambda a: a["sentiment"].cast("decimal(10,3)").cast("string")
    lines = F.transform(aspects, lambda a: F.concat_ws("|", a["aspect"], a["aspect_type"], score(a), a["context"]))
    return F.array_join(lines, "\n")


def _rich_columns(found: DataFrame) -> DataFrame:
    top = F.get(F.col("dominant_aspects"), F.lit(0))
    return found.select(
        "post_id",
        "overall_sentiment",
        "overall_subjectivity",
        "sentiment_summary",
        F.size("aspect_sentiments").alias("n_aspects"),
        top["aspect"].alias("top_aspect"),
        top["aspect_type"].alias("top_type"),
        top["context"].alias("top_context"),
        _listed("aspect_sentiments").alias("aspects"),
        _listed("dominant_aspects").alias("dominant"),
    )


@query
def rich_aspect_analysis(spark, sf):
    return _rich_columns(_rich(spark, sf))


@query
def rich_aspect_analysis_lexicon(spark, sf):
    posts = fixtures.text_posts(spark, sf)
    found = texts.rich_analysis(posts, fixtures.gazetteer(spark, sf), lexicon=fixtures.lexicon(spark, sf))
    return _rich_columns(found)


@query
def rich_hashtag_context(spark, sf):
    entries = unnest(_rich(spark, sf), ["post_id"], "hashtag_context", "hashtag", "c")
    return entries.select(
        "post_id", "hashtag", F.col("c.sentiment").alias("sentiment"),
        F.array_join("c.related_aspects", "|").alias("related_aspects"),
    )


# Messages


@query
def normalize_status(spark, sf):
    return messages.normalize_status(fixtures.statuses(spark, sf)).withColumn("hashtags", F.array_join("hashtags", ","))


@query
def parse_messages(spark, sf):
    parsed = messages.parse_messages(fixtures.raw_values(spark, sf))
    return parsed.withColumn("hashtags", F.array_join("hashtags", ","))


@query
def explode_hashtags(spark, sf):
    return messages.explode_hashtags(messages.parse_messages(fixtures.raw_values(spark, sf))).drop("hashtags")


@query
def enrich_basic(spark, sf):
    return texts.enrich_basic(messages.parse_messages(fixtures.raw_values(spark, sf)), now=AS_OF).drop("hashtags")


def _aspect_columns(rows: DataFrame) -> DataFrame:
    entry = lambda e: F.concat_ws("=", e["key"], e["value"].cast("decimal(10,6)").cast("string"))
    listed = F.array_sort(F.transform(F.map_entries("aspect_sentiments"), entry))
    return rows.select(
        "content", "sentiment", "sentiment_category", F.array_join(listed, "\n").alias("aspects"),
        "dominant_aspect", "content_length", "hashtag_count", "processing_time",
    )


@query
def enrich_aspects(spark, sf):
    return _aspect_columns(texts.enrich_aspects(messages.parse_messages(fixtures.raw_values(spark, sf)), now=AS_OF))


@query
def enrich_aspects_lexicon(spark, sf):
    """All messages, malformed ones too, with sentences and aspects scored by a lexicon."""
    rows = messages.parse_messages(fixtures.raw_values(spark, sf))
    return _aspect_columns(texts.enrich_aspects(rows, now=AS_OF, lexicon=fixtures.lexicon(spark, sf)))


@query
def map_entries(spark, sf):
    """Rows of the aspects table from enriched, exploded messages."""
    return tables.aspect_rows(ingesting.ingest(fixtures.raw_values(spark, sf), "aspects", now=AS_OF))


@query
def enrich_struct(spark, sf):
    return texts.enrich_struct(messages.parse_messages(fixtures.raw_values(spark, sf)), now=AS_OF).drop("hashtags")


@query
def enrich_basic_lexicon(spark, sf):
    """All messages, malformed ones too, scored by a lexicon."""
    rows = messages.parse_messages(fixtures.raw_values(spark, sf))
    return texts.enrich_basic(rows, now=AS_OF, lexicon=fixtures.lexicon(spark, sf)).drop("hashtags")


@query
def enrich_struct_lexicon(spark, sf):
    """Scored by a lexicon whose words and a gazetteer whose surfaces come in capitals, some of them twice."""
    rows = messages.parse_messages(fixtures.raw_values(spark, sf))
    words, places = fixtures.lexicon(spark, sf), fixtures.gazetteer(spark, sf)
    words = words.withColumn("word", F.upper("word")).unionByName(words.filter("length(word) > 3"))
    places = places.withColumn("surface", F.initcap(F.translate("surface", " ", "-"))).unionByName(places)
    return texts.enrich_struct(rows, now=AS_OF, lexicon=words, gazetteer=places).drop("hashtags")


@query
def ingest_stream_lexicon(spark, sf):
    """The stream of messages, each batch scored by a lexicon."""
    out, checkpoint = scratch_path(spark, "posts"), scratch_path(spark, "state")
    words = fixtures.lexicon(spark, sf)
    ingesting.start_ingest(
        fixtures.raw_values_stream(spark, sf), [ingesting.posts_sink(out)], checkpoint, NOW,
        prepare=lambda batch: ingesting.ingest(batch, "basic", now=AS_OF, lexicon=words),
    ).awaitTermination()
    return tables.read_table(spark, out).select("user_name", "content", "hashtag", "sentiment", "content_length", "hashtag_count")


@query
def to_processed_json(spark, sf):
    rows = ingesting.ingest(fixtures.raw_values(spark, sf), "plain").drop("hashtags")
    return messages.to_kafka_value(rows)


@query
def processed_tail(spark, sf):
    """The newest valid messages; arrival is the document number."""
    values = fixtures.table(spark, sf, "documents").select(
        "doc_id",
        F.to_json(
            F.struct(
                F.when(F.col("doc_id") % 3 > 0, F.col("source")).alias("user"), F.col("text").alias("content"),
                F.col("lang").alias("hashtag"), F.lit("2024-01-30T00:00:00").alias("timestamp"),
            )
        ).alias("value"),
    )
    return messages.latest_posts(messages.valid_messages(values), ["doc_id"])


@query
def posts_sample(spark, sf):
    rows = ingesting.ingest(fixtures.raw_values(spark, sf), "plain")
    return topk.posts_sample(rows, ["user_name", "hashtag", "content"])


# Tables


@query
def write_posts(spark, sf):
    path = scratch_path(spark, "posts")
    rows = ingesting.ingest(fixtures.raw_values(spark, sf), "struct", now=AS_OF)
    for _ in range(2):
        tables.write_posts(rows, 0, path, "struct")
    return tables.read_table(spark, path).select(*schemas.POSTS.fieldNames())


@query
def write_aspects(spark, sf):
    path = scratch_path(spark, "aspects")
    tables.write_aspects(ingesting.ingest(fixtures.raw_values(spark, sf), "aspects", now=AS_OF), 0, path)
    return tables.read_table(spark, path, schemas.ASPECT_SENTIMENTS).drop("dt", "batch_id")


@query
def upsert_snapshot(spark, sf):
    """Users of the month, then those of the last week with new values."""
    path = scratch_path(spark, "clusters")
    month = fixtures.user_clusters(spark, sf)
    week = metrics.user_features(fixtures.posts(spark, sf), AS_OF, 5, "2 days").withColumn("cluster_id", F.lit(9))
    tables.upsert_snapshot(month, path, schemas.KEYS["user_clusters"], "2024-01-30 00:00:00")
    tables.upsert_snapshot(week, path, schemas.KEYS["user_clusters"], AS_OF)
    return tables.read_snapshot(spark, path)


@query
def replace_snapshot_empty(spark, sf):
    """A table that a replacement leaves without rows, with the columns of another."""
    path = scratch_path(spark, "communities")
    rows = fixtures.hashtag_communities(spark, sf)
    tables.replace_snapshot(rows, path)
    tables.replace_snapshot(rows.filter("community_id < 0"), path)
    return tables.read_snapshot(spark, path)


@query
def upsert_repeated_keys(spark, sf):
    """Every row of every event updates its user, in two batches that overlap by a day: the last one counts."""
    path, order = scratch_path(spark, "last"), ["post_id", "hashtag"]
    posts = fixtures.posts(spark, sf)
    events = lambda when: posts.filter(when).select("user_name", "post_id", "sentiment", "hashtag")
    tables.upsert_snapshot(events("processing_time < '2024-01-21'"), path, ["user_name"], "2024-01-30 00:00:00", order)
    tables.upsert_snapshot(events("processing_time >= '2024-01-20'"), path, ["user_name"], AS_OF, order)
    return tables.read_snapshot(spark, path)


@query
def delete_old_days(spark, sf):
    """A stored posts table after retention: written in two batches, cut at noon of a day."""
    path = scratch_path(spark, "kept")
    posts = fixtures.posts(spark, sf)
    for batch in range(2):
        tables.write_batch(posts.filter(F.col("post_id") % 2 == batch).select("post_id", "hashtag", "processing_time"), batch, path)
    schema = posts.select("post_id", "hashtag", "processing_time").schema
    upkeep.delete_old_days(spark, path, "2024-01-30 12:00:00", 7, schema)
    return tables.read_table(spark, path, schema).drop("dt", "batch_id")


@query
def replace_snapshot(spark, sf):
    path = scratch_path(spark, "communities")
    rows = fixtures.hashtag_communities(spark, sf)
    tables.replace_snapshot(rows.withColumn("community_id", F.lit(0)), path)
    tables.replace_snapshot(rows, path)
    return tables.read_snapshot(spark, path)


def _old_tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    posts = fixtures.posts(spark, sf)
    unknown = F.when(F.col("post_id") % 10 != 0, F.col("processing_time"))
    found = learning.detect_anomalies(posts, "2024-01-29 00:00:00", threshold=1.0)
    return {
        "posts": posts.withColumn("processing_time", unknown),
        "aspect_sentiments": fixtures.aspects(spark, sf),
        "anomaly_detection": found.unionByName(learning.detect_anomalies(posts, AS_OF, threshold=1.0)),
    }


@query
def cleanup_old_data(spark, sf):
    return upkeep.cleanup(_old_tables(spark, sf), AS_OF, 1)[1]


@query
def cleanup_kept(spark, sf):
    kept = upkeep.cleanup(_old_tables(spark, sf), AS_OF, 1)[0]["posts"]
    return kept.select("post_id", "hashtag", "processing_time")


@query
def delete_old(spark, sf):
    """Rows that retention deletes from the stored posts, aspects and anomalies, whole days and the day at the edge."""
    path = scratch_path(spark, "stored")
    found = _old_tables(spark, sf)
    for name, rows in found.items():
        tables.write_batch(rows, 0, f"{path}/{name}", upkeep.TIME_COLUMNS[name])
    stored = {name: (f"{path}/{name}", rows.schema) for name, rows in found.items()}
    return upkeep.delete_old(spark, stored, "2024-01-31 06:00:00", 1)


def _refreshed(spark: SparkSession, sf: str, *days: str) -> DataFrame:
    """Both statistics tables after refreshes, each over the days that a condition holds for."""
    path = scratch_path(spark, "views")
    for when in days:
        upkeep.refresh_views(fixtures.posts(spark, sf).filter(when), fixtures.aspects(spark, sf).filter(when), path)
    tags = tables.read_snapshot(spark, f"{path}/hashtag_stats").withColumnRenamed("hashtag", "name")
    found = tables.read_snapshot(spark, f"{path}/aspect_stats").withColumnRenamed("aspect", "name")
    return tags.unionByName(found, allowMissingColumns=True)


@query
def refresh_views(spark, sf):
    """A first refresh before noon of a day, and one with the rest of that day and all days after."""
    return _refreshed(spark, sf, "processing_time < '2024-01-20 12:00:00'", "true")


@query
def refresh_views_deleted(spark, sf):
    """All days, then again when retention has taken days out and cut one."""
    return _refreshed(spark, sf, "true", "processing_time >= '2024-01-23 12:00:00'")


def _unchecked(spark: SparkSession, sf: str) -> DataFrame:
    long = F.when(F.col("post_id") % 100 == 1, F.repeat("hashtag", 100)).otherwise(F.col("hashtag"))
    return _some_null_users(spark, sf).withColumn("hashtag", long)


@query
def validate_posts(spark, sf):
    _, bad = quality.validate_posts(_unchecked(spark, sf))
    return bad.select("post_id", "reason", F.length("hashtag").alias("tag_length"))


@query
def validate_posts_kept(spark, sf):
    good, _ = quality.validate_posts(_unchecked(spark, sf))
    return good.select("post_id", "user_name", "hashtag")


@query
def unique_keys(spark, sf):
    return quality.duplicate_keys(fixtures.posts(spark, sf), ["user_name", "hashtag"])


@query
def conform_schema(spark, sf):
    old = fixtures.posts(spark, sf).select(
        F.col("user_name").alias("user"), "hashtag", "sentiment", "processing_time", "timestamp"
    )
    return quality.conform_schema(old, schemas.POSTS)


@query
def profile_posts(spark, sf):
    return quality.profile_posts(_some_null_users(spark, sf).drop("post_id"))


# Graph


def _edges(spark: SparkSession, sf: str) -> DataFrame:
    """The written edge table of the last day, which the graph jobs read."""
    return cut_lineage(graph.cooccurrence_edges(fixtures.posts(spark, sf), AS_OF))


@query
def degree_centrality(spark, sf):
    return graph.degree_centrality(_edges(spark, sf))


query(lambda spark, sf: betweenness(_edges(spark, sf)), "betweenness")


@query
def betweenness_checked(spark, sf):
    """Per tag: whether the estimate is within its bound of the exact result, and the bound within what was asked for."""
    edges = _edges(spark, sf)
    found = betweenness_within(edges, 0.2).withColumnRenamed("betweenness_centrality", "estimate")
    off = F.abs(F.col("estimate") - F.col("betweenness_centrality"))
    both = betweenness(edges).join(found, "hashtag")
    return both.select("hashtag", (off <= F.col("error_bound") + 1e-9).alias("within"), (F.col("error_bound") <= 0.2).alias("bounded"))


@query
def pagerank(spark, sf):
    return graph.pagerank(_edges(spark, sf))


@query
def centrality_table(spark, sf):
    return graph.centrality(_edges(spark, sf))


@query
def top_central_hashtags(spark, sf):
    return topk.top_central_hashtags(graph.centrality(_edges(spark, sf)))


query(lambda spark, sf: communities(_edges(spark, sf)), "communities")


@query
def communities_checked(spark, sf):
    """Per tag: how often it has a community, and whether ids count up by smallest member; the gain over one community."""
    edges = _edges(spark, sf)
    found = cut_lineage(communities(edges))
    first = found.groupBy("community_id").agg(F.min("hashtag").alias("first_member"))
    ranked = first.withColumn("place", F.row_number().over(Window.orderBy("first_member")) - 1)
    gain = modularity(edges, found) >= 0
    rows = found.groupBy("hashtag").agg(F.count(F.lit(1)).alias("times"), F.max("community_id").alias("community_id"))
    rows = rows.join(ranked, "community_id")
    return rows.select("hashtag", "times", (F.col("place") == F.col("community_id")).alias("in_order"), F.lit(gain).alias("gains"))


@query
def cluster_users_checked(spark, sf):
    """Per user: how often it has a cluster, whether ids are in range, and whether no other cluster's mean is nearer."""
    posts = fixtures.posts(spark, sf)
    found = cut_lineage(learning.cluster_users(posts, AS_OF))
    names = list(learning.FEATURES)
    scaled = learning.scale_features(numbers.fill_zero(found.select("user_name", *names), names))
    rows = cut_lineage(scaled.select("user_name", *names).join(found.select("user_name", "cluster_id"), "user_name"))
    means = rows.groupBy("cluster_id").agg(*[F.avg(c).alias(c) for c in names])
    # Five rows at most: the means become constants.
    distance = {m["cluster_id"]: sum(((F.col(c) - m[c]) ** 2 for c in names), F.lit(0.0)) for m in means.collect()}
    least = F.array_min(F.array(*distance.values())) if distance else F.lit(0.0)
    own = F.coalesce(*[F.when(F.col("cluster_id") == i, d) for i, d in distance.items()], F.lit(0.0))
    nearest = own <= least + 1e-6
    return rows.withColumn("nearest", nearest).groupBy("user_name").agg(
        F.count(F.lit(1)).alias("times"),
        F.bool_and(F.col("cluster_id").between(0, 4)).alias("in_range"),
        F.bool_and("nearest").alias("nearest"),
    )


@query
def scale_features(spark, sf):
    features = metrics.user_features(fixtures.posts(spark, sf), AS_OF)
    return learning.scale_features(numbers.fill_zero(features, list(learning.FEATURES)))


# Streams, run to the end of the input


@query
def ingest_stream(spark, sf):
    out, checkpoint = scratch_path(spark, "posts"), scratch_path(spark, "state")
    rows = ingesting.ingest(fixtures.raw_values_stream(spark, sf), "basic", now=AS_OF)
    ingesting.start_ingest(rows, [ingesting.posts_sink(out)], checkpoint, NOW).awaitTermination()
    stored = tables.read_table(spark, out)
    return stored.select("user_name", "content", "hashtag", "sentiment", "content_length", "hashtag_count",
                         "processing_time", "timestamp")


@query
def dual_sink(spark, sf):
    """Posts, aspects and processed messages of one query: all rows of each sink."""
    base, checkpoint = scratch_path(spark, "sinks"), scratch_path(spark, "state")
    sinks = [
        ingesting.posts_sink(f"{base}/posts", "aspects"),
        ingesting.aspects_sink(f"{base}/aspects"),
        ingesting.processed_sink(f"{base}/processed"),
    ]
    ingesting.start_ingest(
        fixtures.raw_values_stream(spark, sf), sinks, checkpoint, NOW,
        prepare=lambda batch: ingesting.ingest(batch, "aspects", now=AS_OF, explode=False),
        unfold=messages.explode_hashtags, tasks=spark.sparkContext.defaultParallelism,
    ).awaitTermination()
    kept = ["user_name", "hashtag"]
    posts = tables.read_table(spark, f"{base}/posts").select(F.lit("posts").alias("sink"), *kept, "content", "sentiment")
    found = tables.read_table(spark, f"{base}/aspects", schemas.ASPECT_SENTIMENTS).select(
        F.lit("aspects").alias("sink"), *kept, F.col("aspect").alias("content"), "sentiment"
    )
    sent = spark.read.text(f"{base}/processed").select(
        F.lit("processed").alias("sink"),
        *[F.get_json_object("value", f"$.{c}").alias(c) for c in (*kept, "content")],
        F.get_json_object("value", "$.sentiment").cast("double").alias("sentiment"),
    )
    return posts.unionByName(found).unionByName(sent)


@query
def stream_posts_per_minute(spark, sf):
    out, checkpoint = scratch_path(spark, "minutes"), scratch_path(spark, "state")
    live = windows.stream_posts_per_minute(fixtures.posts_stream(spark, sf))
    windows.start_windows(live, out, checkpoint, NOW).awaitTermination()
    return windows.read_windows(spark, out, ["time"])


@query
def stream_hourly_sentiment(spark, sf):
    out, checkpoint = scratch_path(spark, "hours"), scratch_path(spark, "state")
    live = windows.stream_hourly_sentiment(fixtures.posts_stream(spark, sf))
    windows.start_windows(live, out, checkpoint, NOW).awaitTermination()
    return windows.read_windows(spark, out, ["time", "sentiment_category"])


@query
def stream_top_hashtags(spark, sf):
    out, checkpoint = scratch_path(spark, "top"), scratch_path(spark, "state")
    windows.start_top_hashtags(fixtures.posts_stream(spark, sf), out, checkpoint, trigger=NOW).awaitTermination()
    windows.finish_top_hashtags(spark, out, checkpoint)
    return spark.read.parquet(f"{out}/top").drop("batch_id")
