"""SQL for DuckDB that states the result of each query independently."""

from __future__ import annotations

from tagtide.functions.sentiment import NEGATIVE_WORDS, POSITIVE_WORDS
from tagtide.functions.text import STOPWORDS
from tagtide.operators.texts import NEGATORS
from tagtide.sources.fixtures import AS_OF

NOW = f"TIMESTAMP '{AS_OF}'"
MONTH = "31 days"


def quoted(words) -> str:
    return ", ".join(f"'{w}'" for w in words)


# Test tables as posts, aspects, texts and resources

POSTS = """
events_k AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
posts AS (
  SELECT event_id AS post_id, 'user_' || user_id AS user_name,
         greatest(-1.0::DOUBLE, least(1.0::DOUBLE, (value - 50) / 60)) AS sentiment,
         ((event_id * 37) % 500)::DOUBLE AS content_length, 2::INTEGER AS hashtag_count,
         'a' || (k // 10) AS dominant_aspect, ts AS processing_time, ts AS timestamp,
         unnest([event_type, 'k' || k]) AS hashtag
  FROM events_k)
"""
ASPECTS = """
aspects AS (
  SELECT 'user_' || user_id AS user_name, event_type AS hashtag,
         'a' || CAST(json_extract_string(props, '$.k') AS INTEGER) AS aspect,
         greatest(-1.0::DOUBLE, least(1.0::DOUBLE, (value - 50) / 60)) AS sentiment,
         ts AS processing_time, ts AS timestamp
  FROM events)
"""
NULL_USERS = POSTS + """,
audited AS (SELECT * EXCLUDE (user_name), CASE WHEN post_id % 10 <> 0 THEN user_name END AS user_name FROM posts)
"""

SPACE = r"\s\x0B\x1C-\x1F\x85\p{Z}"
WORD = r"\p{L}\p{N}_"
CLEAN = "regexp_replace(coalesce({0}, ''), '<[^>]+>', '', 'g')"


def score(text: str) -> str:
    p = " + ".join(f"contains(lower({text}), '{w}')::INT" for w in POSITIVE_WORDS)
    n = " + ".join(f"contains(lower({text}), '{w}')::INT" for w in NEGATIVE_WORDS)
    return f"coalesce((({p}) - ({n}))::DOUBLE / nullif(({p}) + ({n}), 0), 0.0)::DOUBLE"


def words(text: str) -> str:
    return f"list_filter(string_split_regex({text}, '[{SPACE}]+'), lambda w: w <> '')"


def aspect(clean: str) -> str:
    """First capitalised word. Roman numeral signs count as capitals too."""
    bare = f"list_transform({words(clean)}, lambda w: regexp_replace(w, '[^{WORD}]', '', 'g'))"
    kept = (
        f"list_filter({bare}, lambda w: length(w) > 3 AND regexp_matches(w, '^[\\p{{Lu}}\\x{{2160}}-\\x{{216F}}]')"
        " AND w NOT IN ('The', 'This', 'That'))"
    )
    return f"CASE WHEN length({clean}) >= 5 THEN lower(({kept})[1]) END"


def phrases(clean: str, lo: int = 3) -> str:
    marked = f"regexp_replace(lower({clean}), '[^{WORD}''{SPACE}-]+', ' | ', 'g')"
    cut = (
        f"list_transform({words(marked)}, lambda w: CASE WHEN w IN ({quoted(STOPWORDS)})"
        " OR regexp_matches(w, '^[''-]+$') THEN '|' ELSE w END)"
    )
    runs = f"list_transform(string_split(array_to_string({cut}, ' '), '|'), lambda p: trim(p))"
    return f"list_filter({runs}, lambda p: length(p) >= {lo})"


def tokens(text: str) -> str:
    return f"regexp_extract_all(lower({text}), '[{WORD}'']+')"


def sentences(clean: str) -> str:
    parts = f"regexp_replace({clean}, '([.!?])[ \\t\\n\\v\\f\\r]+', '\\1' || chr(1), 'g')"
    return f"list_filter(string_split({parts}, chr(1)), lambda s: length(s) > 0)"


def inline_tags(clean: str) -> str:
    return f"regexp_extract_all(lower({clean}), '#([{WORD}]+)', 1)"


def tone(s: str) -> str:
    return f"CASE WHEN {s} > 0.3 THEN 'Positive' WHEN {s} < -0.3 THEN 'Negative' ELSE 'Neutral' END"


def label3(s: str) -> str:
    return f"CASE WHEN {s} > 0.1::DOUBLE THEN 'positive' WHEN {s} < -0.1::DOUBLE THEN 'negative' ELSE 'neutral' END"


def label5(s: str) -> str:
    return (
        f"CASE WHEN {s} > 0.5::DOUBLE THEN 'very_positive' WHEN {s} > 0.1::DOUBLE THEN 'positive'"
        f" WHEN {s} < -0.5::DOUBLE THEN 'very_negative' WHEN {s} < -0.1::DOUBLE THEN 'negative' ELSE 'neutral' END"
    )


def f32(x: str) -> str:
    """As stored in 32 bits, rounded like every double: half away from zero, in decimal."""
    return f"round(CAST(CAST(CAST({x} AS FLOAT) AS DOUBLE) AS DECIMAL(30, 12)), 6)::DOUBLE"


def each(expr: str, *names: str) -> str:
    """Elements of a list with their position from 0."""
    value, pos = names
    return f"unnest({expr}) AS {value}, generate_subscripts({expr}, 1) - 1 AS {pos}"


DOCS = f"""
docs AS MATERIALIZED (
  SELECT doc_id AS post_id, text AS content, lang, source, 'user_' || (doc_id % 50) AS user_name,
         {CLEAN.format('text')} AS clean
  FROM documents)
"""
ALL_TEXTS = f"""
scored AS MATERIALIZED (
  SELECT post_id, content, clean, {score('clean')} AS score FROM (
    SELECT doc_id AS post_id, text AS content, {CLEAN.format('text')} AS clean FROM documents
    UNION ALL SELECT -1 - page_id, html, {CLEAN.format('html')} FROM pages))
"""
SENTENCES = DOCS + f""",
split AS MATERIALIZED (SELECT post_id, {sentences('clean')} AS parts FROM docs),
sents AS MATERIALIZED (SELECT post_id, {each('parts', 'sentence', 'pos')} FROM split),
rated AS MATERIALIZED (SELECT post_id, pos::INTEGER AS pos, sentence, {score('sentence')} AS score FROM sents)
"""
LEXICON = r"""
lexicon AS MATERIALIZED (
  SELECT word, (length(word) % 5 - 2) / 2.0::DOUBLE AS polarity, (length(word) % 3) / 2.0::DOUBLE AS subjectivity,
         CASE WHEN length(word) = 2 THEN 1.5::DOUBLE ELSE 1.0::DOUBLE END AS intensity
  FROM (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '\p{L}+')) AS word FROM benchmark))
"""
GAZETTEER = r"""
surfaces AS (
  SELECT DISTINCT lower(s) AS surface FROM (
    SELECT unnest(regexp_extract_all(text, '\p{Lu}\p{L}{3,} \p{L}+')) AS s FROM benchmark
    UNION ALL SELECT unnest(regexp_extract_all(text, '\p{Lu}\p{L}{5,}')) FROM benchmark)),
gazetteer AS MATERIALIZED (
  SELECT surface, (['PERSON', 'ORG', 'GPE', 'PRODUCT', 'EVENT'])[length(surface) % 5 + 1] AS type FROM surfaces)
"""


def lexicon_scores(name: str, source: str, keys: str, text: str) -> str:
    """A CTE with the mean polarity and subjectivity of the known words of each text."""
    return f"""
{name}_list AS MATERIALIZED (SELECT {keys}, {tokens(text)} AS w FROM {source}),
{name}_words AS (SELECT {keys}, unnest(w) AS word, generate_subscripts(w, 1) AS spot FROM {name}_list),
{name}_pairs AS (
  SELECT *, lag(word) OVER (PARTITION BY {keys} ORDER BY spot) AS before FROM {name}_words),
{name}_hits AS (
  SELECT {', '.join('p.' + k.strip() for k in keys.split(','))}, l.subjectivity,
         greatest(-1.0::DOUBLE, least(1.0::DOUBLE, l.polarity
           * CASE WHEN p.before IN ({quoted(NEGATORS)}) THEN -0.5::DOUBLE ELSE 1.0::DOUBLE END
           * coalesce(m.intensity, 1.0::DOUBLE))) AS polarity
  FROM {name}_pairs p JOIN lexicon l ON p.word = l.word AND (l.polarity <> 0 OR l.subjectivity <> 0)
  LEFT JOIN lexicon m ON p.before = m.word AND m.intensity <> 1),
{name} AS MATERIALIZED (
  SELECT {', '.join('s.' + k.strip() for k in keys.split(','))},
         coalesce(h.polarity, 0.0::DOUBLE) AS polarity, coalesce(h.subjectivity, 0.0::DOUBLE) AS subjectivity
  FROM {source} s LEFT JOIN (
    SELECT {keys}, avg(polarity) AS polarity, avg(subjectivity) AS subjectivity FROM {name}_hits GROUP BY ALL) h
  USING ({keys}))
"""


SENTENCE_LEXICON = SENTENCES + "," + LEXICON + "," + lexicon_scores("by_sentence", "sents", "post_id, pos", "sentence")


def entities(types: tuple[str, ...]) -> str:
    return DOCS + "," + GAZETTEER + f""",
doc_tokens AS MATERIALIZED (SELECT post_id, {tokens('clean')} AS w FROM docs),
doc_words AS (SELECT post_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM doc_tokens),
doc_next AS (SELECT *, lead(word) OVER (PARTITION BY post_id ORDER BY pos) AS next FROM doc_words),
ngrams AS (
  SELECT post_id, pos, 1 AS n, word AS surface FROM doc_next
  UNION ALL SELECT post_id, pos, 2, word || ' ' || next FROM doc_next WHERE next IS NOT NULL),
entities AS MATERIALIZED (
  SELECT post_id, pos, arg_max(surface, n) AS surface, arg_max(type, n) AS type
  FROM ngrams JOIN gazetteer USING (surface) WHERE type IN ({quoted(types)}) GROUP BY post_id, pos)
"""


FOUR = ("PERSON", "ORG", "GPE", "PRODUCT")
FIVE = (*FOUR, "EVENT")

MESSAGES = f"""
stamped AS (SELECT *, TIMESTAMP '2024-01-30 00:00:00' + to_seconds(doc_id % 86400) AS said FROM documents),
statuses AS (
  SELECT doc_id, 'user_' || (doc_id % 50) AS user_name, text AS content,
         CASE WHEN doc_id % 5 = 0 THEN [] ELSE [lang, source] END AS hashtags,
         strftime(said, '%Y-%m-%dT%H:%M:%S') || '+02:00' AS timestamp, said FROM stamped),
messages AS MATERIALIZED (
  SELECT * EXCLUDE (content), content, {CLEAN.format('content')} AS clean
  FROM statuses WHERE length(content) % 7 <> 0)
"""


def recent(interval: str, column: str = "processing_time") -> str:
    return f"{column} > {NOW} - INTERVAL '{interval}'"


def with_posts(body: str) -> str:
    return f"WITH {POSTS} {body}"


def with_aspects(body: str) -> str:
    return f"WITH {ASPECTS} {body}"


def r(x: str, name: str) -> str:
    return f"round(CAST({x} AS DECIMAL(30, 12)), 6)::DOUBLE AS {name}"


ORACLES: dict[str, str] = {}

# Panels, each with its own window and over the month

for suffix, span in (("", "1 hour"), ("_month", MONTH)):
    ORACLES[f"posts_per_minute{suffix}"] = with_posts(
        f"SELECT date_trunc('minute', processing_time) AS time, count(*) AS posts_count FROM posts WHERE {recent(span)} GROUP BY 1"
    )
    ORACLES[f"sentiment_distribution{suffix}"] = with_posts(
        f"SELECT {r('avg(sentiment)', 'avg_sentiment')}, {r('stddev(sentiment)', 'sentiment_stddev')},"
        f" {r('min(sentiment)', 'min_sentiment')}, {r('max(sentiment)', 'max_sentiment')} FROM posts WHERE {recent(span)}"
    )
    ORACLES[f"sentiment_over_time{suffix}"] = with_posts(
        f"SELECT date_trunc('minute', processing_time) AS time, {r('avg(sentiment)', 'avg_sentiment')} FROM posts WHERE {recent(span)} GROUP BY 1"
    )
    ORACLES[f"top_users{suffix}"] = with_posts(
        f"SELECT user_name, count(*) AS post_count, {r('avg(sentiment)', 'avg_sentiment')}, count(DISTINCT hashtag) AS unique_hashtags"
        f" FROM posts WHERE {recent(span)} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20"
    )
    ORACLES[f"top_hashtags{suffix}"] = with_posts(
        f"SELECT hashtag, count(*) AS count FROM posts WHERE {recent(span)} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"
    )
for suffix, span in (("", "24 hours"), ("_month", MONTH)):
    ORACLES[f"hourly_sentiment_volume{suffix}"] = with_posts(
        f"SELECT date_trunc('hour', processing_time) AS time, {label3('sentiment')} AS sentiment_category, count(*) AS count"
        f" FROM posts WHERE {recent(span)} GROUP BY 1, 2"
    )
    ORACLES[f"recent_posts_summary{suffix}"] = with_posts(
        f"SELECT date_trunc('hour', processing_time) AS hour, count(*) AS post_count, {r('avg(sentiment)', 'avg_sentiment')},"
        f" count(DISTINCT user_name) AS unique_users, count(DISTINCT hashtag) AS unique_hashtags FROM posts WHERE {recent(span)} GROUP BY 1"
    )

BASE_STATS = f"hashtag, count(*) AS total_posts, {r('avg(sentiment)', 'avg_sentiment')}, count(DISTINCT user_name) AS unique_users, max(processing_time) AS last_seen"
ORACLES["hashtag_stats"] = with_posts(
    f"SELECT {BASE_STATS}, count(DISTINCT dominant_aspect) AS unique_aspects, min(processing_time) AS first_seen FROM posts GROUP BY hashtag"
)
ORACLES["hashtag_stats_base"] = with_posts(f"SELECT {BASE_STATS} FROM posts GROUP BY hashtag")
ORACLES["hashtag_stats_nonnull"] = f"WITH {NULL_USERS} SELECT {BASE_STATS} FROM audited WHERE user_name IS NOT NULL GROUP BY hashtag"
ORACLES["user_null_audit"] = (
    f"WITH {NULL_USERS} SELECT count(*) FILTER (user_name IS NULL) AS null_users, count(user_name) AS with_users, count(*) AS total FROM audited"
)


def features(span: str, least: int) -> str:
    return (
        "SELECT user_name, avg(sentiment) AS avg_sentiment, avg(content_length) AS avg_content_length, count(*) AS post_count,"
        f" count(DISTINCT hashtag) AS unique_hashtags FROM posts WHERE {recent(span)} GROUP BY 1 HAVING count(*) >= {least}"
    )


ROUNDED_FEATURES = f"user_name, {r('avg_sentiment', 'avg_sentiment')}, {r('avg_content_length', 'avg_content_length')}, post_count, unique_hashtags"
ORACLES["user_features"] = with_posts(f"SELECT {ROUNDED_FEATURES} FROM ({features('7 days', 5)})")
ORACLES["scale_features"] = with_posts(
    f", f AS ({features('7 days', 5)}) SELECT user_name, "
    + ", ".join(
        r(f"(f.{c} - avg(f.{c}) OVER ()) / coalesce(nullif(stddev_pop(f.{c}) OVER (), 0), 1)", c)
        for c in ("avg_sentiment", "avg_content_length", "post_count", "unique_hashtags")
    )
    + " FROM f"
)
CLUSTERS = f"clusters AS (SELECT *, (post_count % 5)::INTEGER AS cluster_id FROM ({features(MONTH, 1)}))"
ORACLES["cluster_summary"] = with_posts(
    f", {CLUSTERS} SELECT cluster_id, count(*) AS user_count, {r('avg(avg_sentiment)', 'cluster_sentiment')}, {r('avg(post_count)', 'avg_posts')}"
    " FROM clusters GROUP BY 1"
)
ORACLES["fill_zero"] = with_posts(
    f", {CLUSTERS} SELECT user_name, round(CAST(CASE WHEN cluster_id > 1 THEN avg_sentiment ELSE 0 END AS DECIMAL(30, 12)), 6)::DOUBLE AS avg_sentiment,"
    f" {r('avg_content_length', 'avg_content_length')}, post_count, unique_hashtags, cluster_id FROM clusters"
)
ORACLES["upsert_snapshot"] = with_posts(
    f", {CLUSTERS}, week AS ({features('2 days', 5)})"
    f" SELECT {ROUNDED_FEATURES}, 9 AS cluster_id, {NOW} AS updated_at FROM week"
    f" UNION ALL SELECT {ROUNDED_FEATURES}, cluster_id, TIMESTAMP '2024-01-30 00:00:00' FROM clusters"
    " WHERE user_name NOT IN (SELECT user_name FROM week)"
)
COMMUNITIES = "communities AS (SELECT DISTINCT hashtag, length(hashtag)::INTEGER AS community_id FROM posts)"
ORACLES["community_distribution"] = with_posts(
    f", {COMMUNITIES} SELECT community_id, count(*) AS hashtag_count FROM communities GROUP BY 1"
)
ORACLES["replace_snapshot_empty"] = with_posts(f", {COMMUNITIES} SELECT * FROM communities WHERE false")
ORACLES["upsert_repeated_keys"] = with_posts(
    f""", e AS (SELECT *, processing_time >= TIMESTAMP '2024-01-20 00:00:00' AS late FROM posts)
SELECT user_name, post_id, round(CAST(sentiment AS DECIMAL(30, 12)), 6)::DOUBLE AS sentiment, hashtag,
       CASE WHEN late THEN {NOW} ELSE TIMESTAMP '2024-01-30 00:00:00' END AS updated_at
FROM e QUALIFY row_number() OVER (PARTITION BY user_name ORDER BY late DESC, post_id DESC, hashtag DESC) = 1"""
)
ORACLES["delete_old_days"] = with_posts(
    " SELECT post_id, hashtag, processing_time FROM posts WHERE processing_time >= TIMESTAMP '2024-01-23 12:00:00'"
)
ORACLES["replace_snapshot"] = with_posts(f", {COMMUNITIES} SELECT * FROM communities")

HOURLY = "hourly AS (SELECT hashtag, date_trunc('{unit}', processing_time) AS hour, count(*) AS count FROM posts WHERE {when} GROUP BY 1, 2)"
ORACLES["hourly_counts"] = with_posts("," + HOURLY.format(unit="hour", when=recent("24 hours")) + " SELECT * FROM hourly")
VELOCITY = (
    "velocity AS (SELECT hashtag, avg(count) AS avg_count, stddev(count) AS stddev_count,"
    " (max(count) - min(count)) // count(*) AS velocity FROM hourly GROUP BY 1 HAVING count(*) >= 3)"
)
ROUNDED_VELOCITY = f"SELECT hashtag, {r('avg_count', 'avg_count')}, {r('stddev_count', 'stddev_count')}, velocity FROM velocity"
DAILY = HOURLY.format(unit="day", when=recent("7 days"))
ORACLES["hashtag_velocity"] = with_posts(f", {DAILY}, {VELOCITY} {ROUNDED_VELOCITY}")
ORACLES["hashtag_velocity_hourly"] = with_posts(
    f", {HOURLY.format(unit='hour', when=recent('24 hours'))}, {VELOCITY} {ROUNDED_VELOCITY}"
)
ORACLES["velocity_top50"] = with_posts(f", {DAILY}, {VELOCITY} {ROUNDED_VELOCITY} ORDER BY velocity.velocity DESC, hashtag LIMIT 50")


def trend(name: str, unit: str, now: str, span: str) -> str:
    """CTEs that end in ``name`` with the scores of one run."""
    when = f"processing_time > TIMESTAMP '{now}' - INTERVAL '{span}'"
    hourly = HOURLY.format(unit=unit, when=when).replace("hourly AS", f"{name}_h AS", 1)
    velocity = VELOCITY.replace("velocity AS (", f"{name}_v AS (", 1).replace("FROM hourly", f"FROM {name}_h")
    return f"""{hourly}, {velocity},
{name}_top AS (SELECT *, velocity * avg_count AS raw FROM {name}_v ORDER BY velocity DESC, hashtag LIMIT 50),
{name} AS (
  SELECT hashtag, (raw - min(raw) OVER ()) / nullif(max(raw) OVER () - min(raw) OVER (), 0) AS prediction_score,
         velocity::DOUBLE AS current_velocity, TIMESTAMP '{now}' AS predicted_at FROM {name}_top)"""


ROUNDED_TREND = f"hashtag, {r('prediction_score', 'prediction_score')}, {r('current_velocity', 'current_velocity')}, predicted_at"
PREDICTIONS = (
    trend("run1", "day", "2024-01-30 00:00:00", "7 days")
    + ","
    + trend("run2", "day", AS_OF, "7 days")
    + ", predictions AS (SELECT * FROM run1 UNION ALL SELECT * FROM run2)"
)
ORACLES["predict_trending"] = with_posts(f", {trend('run', 'hour', AS_OF, '24 hours')} SELECT {ROUNDED_TREND} FROM run")
ORACLES["predict_trending_daily"] = with_posts(f", {trend('run', 'day', AS_OF, '7 days')} SELECT {ROUNDED_TREND} FROM run")
ORACLES["score_bounds"] = with_posts(
    f", {PREDICTIONS} SELECT {r('min(prediction_score)', 'min_score')}, {r('max(prediction_score)', 'max_score')} FROM predictions"
)
LATEST = "WHERE predicted_at = (SELECT max(predicted_at) FROM predictions)"
ORACLES["latest_run"] = with_posts(f", {PREDICTIONS} SELECT {ROUNDED_TREND} FROM predictions {LATEST}")
ORACLES["append_run"] = with_posts(f", {PREDICTIONS} SELECT {ROUNDED_TREND} FROM predictions")
ORACLES["trending_top15"] = with_posts(
    f", {PREDICTIONS} SELECT hashtag, {r('prediction_score', 'prediction_score')} FROM predictions {LATEST}"
    " ORDER BY predictions.prediction_score DESC NULLS FIRST, hashtag LIMIT 15"
)
ORACLES["velocity_alerts"] = with_posts(
    f", {PREDICTIONS} SELECT hashtag, {r('current_velocity', 'current_velocity')}, {r('prediction_score', 'prediction_score')}"
    f" FROM predictions WHERE {recent('1 hour', 'predicted_at')} AND predictions.prediction_score > 0.7"
)


ORACLES["velocity_alerts_quarter"] = ORACLES["velocity_alerts"].replace(recent("1 hour", "predicted_at"), recent("15 minutes", "predicted_at"))


def rates(name: str, now: str) -> str:
    return f"""{name}_now AS (SELECT user_name, count(*) AS recent_posts FROM posts
  WHERE processing_time > TIMESTAMP '{now}' - INTERVAL '1 hour' GROUP BY 1),
{name}_hours AS (SELECT user_name, date_trunc('hour', processing_time) AS hour, count(*) AS n FROM posts
  WHERE processing_time > TIMESTAMP '{now}' - INTERVAL '7 days' GROUP BY 1, 2),
{name}_past AS (SELECT user_name, avg(n) AS avg_posts_per_hour, stddev(n) AS stddev_posts FROM {name}_hours GROUP BY 1),
{name} AS (SELECT user_name, recent_posts, avg_posts_per_hour, stddev_posts,
  (recent_posts - avg_posts_per_hour) / nullif(stddev_posts, 0) AS z_score
  FROM {name}_now JOIN {name}_past USING (user_name) WHERE stddev_posts > 0)"""


def anomalies(name: str, now: str, threshold: float) -> str:
    return rates(f"{name}_z", now) + f""",
{name} AS (SELECT user_name, NULL::VARCHAR AS hashtag, abs(z_score) AS anomaly_score,
  'Unusual posting rate: ' || recent_posts || ' posts (avg: ' || printf('%.1f', avg_posts_per_hour) || ')' AS reason,
  TIMESTAMP '{now}' AS detected_at FROM {name}_z WHERE abs(z_score) > {threshold})"""


ORACLES["user_recent_stats"] = with_posts(
    f"SELECT user_name, count(*) AS recent_posts, {r('avg(sentiment)', 'avg_sentiment')}, count(DISTINCT hashtag) AS unique_tags"
    f" FROM posts WHERE {recent('1 hour')} GROUP BY 1"
)
ORACLES["user_hourly_history"] = with_posts(
    f", {rates('z', AS_OF)} SELECT user_name, {r('avg_posts_per_hour', 'avg_posts_per_hour')}, {r('stddev_posts', 'stddev_posts')} FROM z_past"
)
ORACLES["recent_vs_history"] = with_posts(
    f", {rates('z', AS_OF)} SELECT user_name, recent_posts, {r('avg_posts_per_hour', 'avg_posts_per_hour')},"
    f" {r('stddev_posts', 'stddev_posts')}, {r('z_score', 'z_score')} FROM z"
)
ORACLES["detect_anomalies"] = with_posts(
    f", {anomalies('found', AS_OF, 3.0)} SELECT user_name, hashtag, {r('anomaly_score', 'anomaly_score')}, reason, detected_at FROM found"
)
ORACLES["recent_anomalies"] = with_posts(
    f", {anomalies('found', AS_OF, 1.0)} SELECT detected_at AS time, user_name,"
    " round(CAST(round(CAST(anomaly_score AS DECIMAL(20, 10)), 2)::DOUBLE AS DECIMAL(30, 12)), 6)::DOUBLE AS score, reason"
    " FROM found WHERE detected_at > TIMESTAMP '2024-01-31 00:30:00' - INTERVAL '1 hour' ORDER BY time DESC, user_name LIMIT 20"
)
ORACLES["user_hashtag_network"] = with_posts(
    "SELECT user_name, hashtag, count(*) AS co_occurrence_count, max(processing_time) AS last_seen FROM posts GROUP BY 1, 2"
)
ORACLES["unique_keys"] = with_posts("SELECT user_name, hashtag, count(*) AS count FROM posts GROUP BY 1, 2 HAVING count(*) > 1")
ORACLES["hashtag_counter"] = with_posts("SELECT hashtag, count(*) AS count FROM posts GROUP BY 1")
ORACLES["dash_top10"] = with_posts(
    'SELECT hashtag AS "Hashtag", count(*) AS "Count" FROM posts GROUP BY 1 ORDER BY 2 DESC, min(post_id), 1 LIMIT 10'
)
SCAN = f"SELECT * REPLACE (round(CAST(sentiment AS DECIMAL(30, 12)), 6)::DOUBLE AS sentiment) FROM posts WHERE "
ORACLES["recent_filter"] = with_posts(SCAN + recent("24 hours"))
ORACLES["posts_scan"] = with_posts(SCAN + recent("7 days"))

# Aspects

ORACLES["aspect_stats"] = with_aspects(
    f"SELECT aspect, count(*) AS mention_count, {r('avg(sentiment)', 'avg_sentiment')}, {r('stddev(sentiment)', 'sentiment_stddev')},"
    " count(DISTINCT hashtag) AS hashtag_count, count(DISTINCT user_name) AS user_count, max(processing_time) AS last_seen,"
    " min(processing_time) AS first_seen FROM aspects GROUP BY 1 HAVING count(*) >= 3"
)
ORACLES["hashtag_aspect_sentiment"] = with_aspects(
    f"SELECT hashtag, aspect, count(*) AS co_occurrence, {r('avg(sentiment)', 'avg_aspect_sentiment')},"
    f" {r('stddev(sentiment)', 'sentiment_stddev')}, max(processing_time) AS last_seen FROM aspects GROUP BY 1, 2 HAVING count(*) >= 2"
)
for name, span, least in (("trending_aspects", "24 hours", 5), ("trending_aspects_hour", "1 hour", 1)):
    ORACLES[name] = with_aspects(
        f"SELECT aspect, count(*) AS recent_mentions, {r('avg(sentiment)', 'avg_sentiment')}, count(DISTINCT hashtag) AS hashtag_spread"
        f" FROM aspects WHERE {recent(span)} GROUP BY 1 HAVING count(*) >= {least}"
    )
ORACLES["aspect_counts"] = with_aspects("SELECT aspect, count(*) AS count FROM aspects GROUP BY 1")
ORACLES["top_aspects"] = with_aspects("SELECT aspect, count(*) AS count FROM aspects GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")

# Scalars

ORACLES["clean_html"] = f"SELECT page_id AS post_id, {CLEAN.format('html')} AS clean FROM pages"
ORACLES["content_length"] = f"SELECT page_id AS post_id, length({CLEAN.format('html')})::DOUBLE AS content_length FROM pages"
ORACLES["score_simple"] = f"WITH {ALL_TEXTS} SELECT post_id, round(CAST(score AS DECIMAL(30, 12)), 6)::DOUBLE AS score FROM scored"
ORACLES["simple_aspect"] = f"WITH {ALL_TEXTS} SELECT post_id, {aspect('clean')} AS aspect FROM scored"
ORACLES["first_aspect"] = f"WITH {DOCS} SELECT post_id, {aspect('clean')} AS aspect FROM docs"
ORACLES["sentiment_labels"] = with_posts(
    f", s AS (SELECT post_id, hashtag, sentiment::FLOAT::DOUBLE AS s FROM posts)"
    f" SELECT post_id, hashtag, {label5('s')} AS category5, {label3('s')} AS category3, {tone('s')} AS tone FROM s"
)
ORACLES["inline_hashtags"] = (
    "SELECT doc_id AS post_id, array_to_string("
    + inline_tags("regexp_replace(text, '(?m)^', '#', 'g') || ' #Café_1'")
    + ", ' ') AS tags FROM documents"
)
ORACLES["split_sentences"] = (
    f"WITH {ALL_TEXTS} SELECT post_id, len(string_split(clean, '.'))::INTEGER AS parts, len({sentences('clean')})::INTEGER AS sentences FROM scored"
)
ORACLES["scalar_functions"] = with_posts(
    f"""SELECT post_id, hashtag, 2::INTEGER AS tags, length(hashtag) BETWEEN 3 AND 5 AS in_band, substring(hashtag, 1, 2) AS start,
  lower(trim('  ' || upper(hashtag))) AS aspect, date_trunc('minute', processing_time) AS minute,
  date_trunc('hour', processing_time) AS hour,
  round(CAST(round(CAST(sentiment AS DECIMAL(20, 10)), 4)::DOUBLE AS DECIMAL(30, 12)), 6)::DOUBLE AS rounded,
  round(CAST(printf('%.3f', sentiment)::DOUBLE AS DECIMAL(30, 12)), 6)::DOUBLE AS rounded_binary, printf('%.2f', sentiment) AS fixed,
  round(CAST(sentiment / nullif(content_length, 0) AS DECIMAL(30, 12)), 6)::DOUBLE AS ratio,
  round(CAST(CASE WHEN content_length > 100 AND sentiment <> 0 THEN sentiment ELSE 0 END AS DECIMAL(30, 12)), 6)::DOUBLE AS filled,
  round(CAST(abs(sentiment) AS DECIMAL(30, 12)), 6)::DOUBLE AS magnitude,
  'Unusual posting rate: ' || post_id || ' posts (avg: ' || printf('%.1f', sentiment) || ')' AS reason,
  {tone('sentiment')} || CASE WHEN content_length > 50
    THEN ' tone; Most pronounced towards ''' || hashtag || ''' (' || printf('%.2f', sentiment) || ')' ELSE ' tone overall' END AS summary
FROM posts"""
)
ORACLES["iso_timestamp"] = f"WITH {MESSAGES} SELECT user_name, CASE WHEN len(hashtags) > 0 THEN said END AS said FROM statuses"

# Text jobs

ORACLES["lexicon_lookup"] = (
    f"WITH {DOCS}, {LEXICON}, w AS (SELECT unnest({tokens('clean')}) AS word FROM docs)"
    f" SELECT word, {r('polarity', 'polarity')}, count(*) AS n FROM w JOIN lexicon USING (word) GROUP BY word, lexicon.polarity"
)
ORACLES["sentence_scores"] = f"WITH {SENTENCES} SELECT post_id, pos, sentence, round(CAST(score AS DECIMAL(30, 12)), 6)::DOUBLE AS score FROM rated"
ORACLES["lexicon_sentiment"] = (
    f"WITH {DOCS}, {LEXICON}, {lexicon_scores('by_doc', 'docs', 'post_id', 'clean')}"
    f" SELECT post_id, {r('polarity', 'polarity')}, {r('subjectivity', 'subjectivity')} FROM by_doc"
)
ORACLES["lexicon_sentence_scores"] = (
    f"WITH {SENTENCE_LEXICON} SELECT post_id, pos::INTEGER AS pos, {r('polarity', 'score')} FROM by_sentence"
)
PHRASES = DOCS + f""",
phrase_lists AS MATERIALIZED (SELECT post_id, {phrases('clean')} AS p FROM docs),
phrases AS MATERIALIZED (SELECT post_id, {each('p', 'phrase', 'pos')} FROM phrase_lists)
"""
ORACLES["phrase_candidates"] = f"WITH {PHRASES} SELECT post_id, pos::INTEGER AS pos, phrase FROM phrases"
ORACLES["dominant_phrase"] = (
    f"WITH {PHRASES} SELECT post_id, phrase AS dominant_aspect FROM"
    " (SELECT post_id, phrase, count(*) AS n, min(pos) AS pos FROM phrases GROUP BY ALL)"
    " QUALIFY row_number() OVER (PARTITION BY post_id ORDER BY n DESC, pos) = 1"
)
ASPECTS_OF = f""",
cand_lists AS MATERIALIZED (SELECT post_id, {phrases('clean')} AS p, {inline_tags('clean')} AS t FROM src),
cand AS (SELECT DISTINCT post_id, unnest(p) AS aspect FROM cand_lists),
low AS MATERIALIZED (SELECT post_id, lower(sentence) AS low, score FROM src_rated),
found AS (
  SELECT post_id, aspect, avg(score) AS sentiment FROM cand JOIN low USING (post_id)
  WHERE length(aspect) BETWEEN 3 AND 50 AND contains(low, aspect) GROUP BY 1, 2),
tag AS (SELECT DISTINCT post_id, unnest(t) AS aspect FROM cand_lists),
tagged AS (
  SELECT post_id, aspect, avg(score) AS sentiment FROM tag JOIN low USING (post_id)
  WHERE contains(low, '#' || aspect) AND (post_id, aspect) NOT IN (SELECT (post_id, aspect) FROM found) GROUP BY 1, 2),
aspect_means AS MATERIALIZED (SELECT * FROM found UNION ALL SELECT * FROM tagged)
"""
DOC_ASPECTS = SENTENCES + ", src AS (SELECT post_id, clean FROM docs), src_rated AS (SELECT * FROM rated)" + ASPECTS_OF
ORACLES["aspect_sentiments"] = f"WITH {DOC_ASPECTS} SELECT post_id, aspect, {f32('sentiment')} AS sentiment FROM aspect_means"

ENTITY_PAIRS = """,
pairs AS (
  SELECT a.post_id, a.aspect, s.pos::INTEGER AS pos, s.sentence
  FROM (SELECT DISTINCT post_id, surface AS aspect FROM entities) a JOIN sents s USING (post_id)
  WHERE contains(lower(s.sentence), a.aspect))
"""
DOC_PARTS = SENTENCES[len(DOCS):]
ORACLES["aspect_sentences"] = (
    f"WITH {entities(FOUR)} {DOC_PARTS} {ENTITY_PAIRS}"
    f" SELECT post_id, aspect, pos, round(CAST({score('sentence')} AS DECIMAL(30, 12)), 6)::DOUBLE AS score FROM pairs"
)
BY_SENTENCE = lexicon_scores("by_sentence", "sents", "post_id, pos", "sentence")
ORACLES["aspect_mean"] = (
    f"WITH {entities(FOUR)} {DOC_PARTS} {ENTITY_PAIRS}, {LEXICON}, {BY_SENTENCE}"
    " SELECT post_id, aspect, round(CAST(avg(polarity) AS DECIMAL(30, 12)), 6)::DOUBLE AS sentiment FROM pairs JOIN by_sentence USING (post_id, pos) GROUP BY 1, 2"
)
TAGS = "tags AS (SELECT DISTINCT post_id, unnest(['The', 'ch', lang]) AS hashtag FROM docs)"
ORACLES["hashtag_sentences"] = (
    f"WITH {SENTENCE_LEXICON}, {lexicon_scores('by_doc', 'docs', 'post_id', 'clean')}, {TAGS},"
    " held AS (SELECT t.post_id, t.hashtag, avg(b.polarity) AS m FROM tags t JOIN sents s USING (post_id)"
    " JOIN by_sentence b USING (post_id, pos) WHERE contains(lower(s.sentence), lower(t.hashtag)) GROUP BY 1, 2)"
    " SELECT t.post_id, t.hashtag, round(CAST(coalesce(h.m, d.polarity) AS DECIMAL(30, 12)), 6)::DOUBLE AS sentiment"
    " FROM tags t JOIN by_doc d USING (post_id) LEFT JOIN held h USING (post_id, hashtag)"
)
RATED = (
    SENTENCE_LEXICON
    + ", listed AS MATERIALIZED (SELECT post_id, pos::INTEGER AS pos, 's' || pos AS aspect, round(CAST(polarity AS DECIMAL(30, 12)), 6)::DOUBLE AS sentiment,"
    " substring(sentence, 1, 100) AS context FROM sents JOIN by_sentence USING (post_id, pos))"
)
ORACLES["top_aspects_by_intensity"] = (
    f"WITH {RATED} SELECT post_id, pos, aspect, sentiment, (row_number() OVER (PARTITION BY post_id ORDER BY abs(sentiment) DESC, pos))::INTEGER AS rank"
    " FROM listed QUALIFY rank <= 3"
)
ORACLES["most_pronounced_aspect"] = (
    f"WITH {RATED} SELECT post_id, aspect, sentiment FROM listed"
    " QUALIFY row_number() OVER (PARTITION BY post_id ORDER BY abs(sentiment) DESC, pos) = 1"
)
ORACLES["related_aspects"] = (
    f"WITH {RATED}, {TAGS}, held AS (SELECT t.post_id, t.hashtag, l.pos, l.aspect FROM tags t JOIN listed l USING (post_id)"
    " WHERE contains(lower(l.context), lower(t.hashtag))"
    " QUALIFY row_number() OVER (PARTITION BY t.post_id, t.hashtag ORDER BY l.pos) <= 3)"
    " SELECT t.post_id, t.hashtag, coalesce(string_agg(h.aspect, ' ' ORDER BY h.pos), '') AS related_aspects"
    " FROM tags t LEFT JOIN held h USING (post_id, hashtag) GROUP BY 1, 2"
)
FIRST_ENTITY = f""",
first_entity AS (SELECT post_id, arg_min(surface, pos) AS surface, arg_min(type, pos) AS type FROM entities GROUP BY 1),
first_phrase AS MATERIALIZED (SELECT post_id, ({phrases('clean', 4)})[1] AS phrase FROM docs),
focus AS MATERIALIZED (
  SELECT post_id, coalesce(e.surface, p.phrase) AS aspect,
         CASE WHEN e.surface IS NOT NULL THEN e.type WHEN p.phrase IS NOT NULL THEN 'TOPIC' END AS type
  FROM first_phrase p LEFT JOIN first_entity e USING (post_id))
"""
ORACLES["entity_aspects"] = f"WITH {entities(FOUR)} {FIRST_ENTITY} SELECT post_id, aspect, type FROM focus"
ORACLES["post_sentiment_struct"] = f"""WITH {ALL_TEXTS},
a AS (SELECT *, {aspect('clean')} AS aspect, coalesce(content, '') = '' AS none, length(clean) < 5 AS short FROM scored)
SELECT post_id, content, CASE WHEN none OR short THEN 0.0 ELSE {f32('score')} END AS overall_sentiment,
  CASE WHEN none OR short THEN 0.0 ELSE 0.5 END::DOUBLE AS overall_subjectivity,
  CASE WHEN none THEN 'No content' WHEN short THEN 'Content too short'
    WHEN aspect IS NULL THEN ({tone('score')}) || ' tone overall'
    ELSE ({tone('score')}) || ' tone; focused on ''' || aspect || ''' (' || printf('%.2f', score) || ')' END AS sentiment_summary,
  CASE WHEN NOT none AND NOT short THEN aspect END AS top_aspect,
  CASE WHEN none OR short THEN 0.0 ELSE {f32('score')} END AS top_aspect_sentiment
FROM a"""
ORACLES["post_sentiment_lexicon"] = f"""WITH {entities(FOUR)} {FIRST_ENTITY}, {LEXICON},
pieces AS MATERIALIZED (SELECT post_id, string_split(clean, '.') AS parts FROM docs),
sents AS MATERIALIZED (SELECT post_id, {each('parts', 'sentence', 'pos')} FROM pieces),
{BY_SENTENCE}, {lexicon_scores('by_doc', 'docs', 'post_id', 'clean')},
near AS (SELECT f.post_id, avg(b.polarity) AS m FROM focus f JOIN sents s USING (post_id) JOIN by_sentence b USING (post_id, pos)
  WHERE contains(lower(s.sentence), f.aspect) GROUP BY 1)
SELECT d.post_id, CASE WHEN length(d.clean) < 5 THEN 0 ELSE {f32('b.polarity')} END AS overall_sentiment,
  CASE WHEN length(d.clean) < 5 THEN 0 ELSE {f32('b.subjectivity')} END AS overall_subjectivity,
  CASE WHEN coalesce(d.content, '') = '' THEN 'No content' WHEN length(d.clean) < 5 THEN 'Content too short'
    WHEN f.aspect IS NULL THEN ({tone('b.polarity')}) || ' tone overall'
    ELSE ({tone('b.polarity')}) || ' tone; focused on ''' || f.aspect || ''' (' || printf('%.2f', coalesce(n.m, b.polarity)) || ')'
  END AS sentiment_summary,
  CASE WHEN length(d.clean) >= 5 THEN f.aspect END AS top_aspect,
  CASE WHEN length(d.clean) < 5 THEN 0 ELSE {f32('coalesce(n.m, b.polarity)')} END AS top_aspect_sentiment
FROM docs d JOIN by_doc b USING (post_id) JOIN focus f USING (post_id) LEFT JOIN near n USING (post_id)"""

RICH = f"""{entities(FIVE)} {DOC_PARTS},
topic_lists AS MATERIALIZED (SELECT post_id, {phrases('clean', 4)} AS p FROM docs),
topics AS (SELECT post_id, {each('p', 'aspect', 'spot')} FROM topic_lists),
candidates AS MATERIALIZED (
  SELECT post_id, 0 AS kind, pos AS spot, surface AS aspect, type FROM entities
  UNION ALL SELECT post_id, 1, spot, aspect, 'TOPIC' FROM topics),
low AS MATERIALIZED (SELECT *, lower(sentence) AS low FROM rated),
means AS MATERIALIZED (
  SELECT c.post_id, c.aspect, printf('%.3f', avg(l.score))::DOUBLE AS sentiment,
         substring(arg_min(l.sentence, l.pos), 1, 100) AS context
  FROM (SELECT DISTINCT post_id, aspect FROM candidates) c JOIN low l USING (post_id) WHERE contains(l.low, c.aspect) GROUP BY 1, 2),
named AS MATERIALIZED (SELECT * FROM candidates JOIN means USING (post_id, aspect)),
whole AS MATERIALIZED (SELECT post_id, lang, source, {score('clean')} AS overall FROM docs)
"""
ORACLES["rich_aspect_analysis"] = f"""WITH {RICH},
placed AS (SELECT *, concat_ws('|', aspect, type, CAST(CAST(sentiment AS DECIMAL(10, 3)) AS VARCHAR), context) AS line,
  row_number() OVER (PARTITION BY post_id ORDER BY abs(sentiment) DESC, kind, spot) AS place FROM named),
lines AS (SELECT post_id, string_agg(line, chr(10) ORDER BY kind, spot) AS aspects,
  string_agg(line, chr(10) ORDER BY place) FILTER (WHERE place <= 3) AS dominant FROM placed GROUP BY 1),
top AS (SELECT *, count(*) OVER (PARTITION BY post_id) AS n FROM named
  QUALIFY row_number() OVER (PARTITION BY post_id ORDER BY abs(sentiment) DESC, kind, spot) = 1)
SELECT post_id, round(CAST(printf('%.3f', overall)::DOUBLE AS DECIMAL(30, 12)), 6)::DOUBLE AS overall_sentiment, 0.5::DOUBLE AS overall_subjectivity,
  ({tone('overall')}) || CASE WHEN t.aspect IS NULL THEN ' tone overall'
    ELSE ' tone; Most pronounced towards ''' || t.aspect || ''' (' || printf('%.2f', t.sentiment) || ')' END AS sentiment_summary,
  coalesce(t.n, 0)::INTEGER AS n_aspects, t.aspect AS top_aspect, t.type AS top_type, t.context AS top_context,
  coalesce(l.aspects, '') AS aspects, coalesce(l.dominant, '') AS dominant
FROM whole LEFT JOIN top t USING (post_id) LEFT JOIN lines l USING (post_id)"""
ORACLES["rich_hashtag_context"] = f"""WITH {RICH},
tags AS (SELECT DISTINCT post_id, unnest([lang, source]) AS hashtag, overall FROM whole),
held AS (SELECT t.post_id, t.hashtag, avg(l.score) AS m FROM tags t JOIN low l USING (post_id) WHERE contains(l.low, lower(t.hashtag)) GROUP BY 1, 2),
near AS (SELECT t.post_id, t.hashtag, n.aspect, n.kind, n.spot FROM tags t JOIN named n USING (post_id)
  WHERE contains(lower(n.context), lower(t.hashtag))
  QUALIFY row_number() OVER (PARTITION BY t.post_id, t.hashtag ORDER BY n.kind, n.spot) <= 3)
SELECT t.post_id, t.hashtag, round(CAST(printf('%.3f', coalesce(any_value(h.m), any_value(t.overall)))::DOUBLE AS DECIMAL(30, 12)), 6)::DOUBLE AS sentiment,
  coalesce(string_agg(n.aspect, '|' ORDER BY n.kind, n.spot), '') AS related_aspects
FROM tags t LEFT JOIN held h USING (post_id, hashtag) LEFT JOIN near n USING (post_id, hashtag) GROUP BY 1, 2"""

# Messages and tables

MESSAGE = "user_name, content, array_to_string(hashtags, ',') AS hashtags, timestamp"
EXPLODED = "exploded AS (SELECT *, unnest(hashtags) AS hashtag FROM messages)"
BASIC = (
    f"{f32(score('clean'))} AS sentiment, length(clean)::DOUBLE AS content_length, len(hashtags)::INTEGER AS hashtag_count, {NOW} AS processing_time"
)
ORACLES["normalize_status"] = f"WITH {MESSAGES} SELECT {MESSAGE} FROM statuses WHERE len(hashtags) > 0"
ORACLES["parse_messages"] = (
    f"WITH {MESSAGES} SELECT {MESSAGE} FROM messages"
    " UNION ALL SELECT NULL, NULL, NULL, NULL FROM documents WHERE length(text) % 7 = 0"
)
ORACLES["explode_hashtags"] = f"WITH {MESSAGES}, {EXPLODED} SELECT user_name, content, hashtag, timestamp FROM exploded"
ORACLES["to_processed_json"] = f"WITH {MESSAGES}, {EXPLODED} SELECT '{{' || " + " || ',' || ".join(
    f"'\"{c}\":' || to_json({c})::VARCHAR" for c in ("user_name", "content", "timestamp", "hashtag")
) + " || '}' AS value FROM exploded"
# A malformed value is a row of NULLs, which is enriched as an empty text.
MALFORMED = "documents WHERE length(text) % 7 = 0"
ORACLES["enrich_basic"] = (
    f"WITH {MESSAGES} SELECT user_name, content, timestamp, {BASIC} FROM messages"
    f" UNION ALL SELECT NULL, NULL, NULL, 0, 0, NULL, {NOW} FROM {MALFORMED}"
)
ORACLES["ingest_stream"] = (
    f"WITH {MESSAGES}, {EXPLODED} SELECT user_name, content, hashtag, said AS timestamp, {BASIC} FROM exploded"
)
STRUCT = f"""CASE WHEN none OR short THEN 0.0 ELSE {f32('score')} END"""
STRUCT_SOURCE = f"""{MESSAGES},
a AS (SELECT *, {score('clean')} AS score, {aspect('clean')} AS aspect, content = '' AS none, length(clean) < 5 AS short FROM messages)"""
STRUCT_SUMMARY = f"""CASE WHEN none THEN 'No content' WHEN short THEN 'Content too short'
    WHEN aspect IS NULL THEN ({tone('score')}) || ' tone overall'
    ELSE ({tone('score')}) || ' tone; focused on ''' || aspect || ''' (' || printf('%.2f', score) || ')' END"""
ORACLES["enrich_struct"] = f"""WITH {STRUCT_SOURCE}
SELECT user_name, content, timestamp, {STRUCT} AS overall_sentiment,
  CASE WHEN none OR short THEN 0.0 ELSE 0.5 END::DOUBLE AS overall_subjectivity, {STRUCT_SUMMARY} AS sentiment_summary,
  CASE WHEN NOT none AND NOT short THEN aspect END AS top_aspect, {STRUCT} AS top_aspect_sentiment,
  length(clean)::DOUBLE AS content_length, len(hashtags)::INTEGER AS hashtag_count, {NOW} AS processing_time
FROM a
UNION ALL SELECT NULL, NULL, NULL, 0, 0, 'No content', NULL, 0, 0, NULL, {NOW} FROM {MALFORMED}"""
ORACLES["write_posts"] = f"""WITH {STRUCT_SOURCE}
SELECT user_name, content, unnest(hashtags) AS hashtag, {STRUCT} AS sentiment, NULL::VARCHAR AS sentiment_category,
  NULL::VARCHAR AS dominant_aspect, length(clean)::DOUBLE AS content_length, len(hashtags)::INTEGER AS hashtag_count,
  {NOW} AS processing_time, said AS timestamp, {STRUCT_SUMMARY} AS sentiment_summary,
  CASE WHEN NOT none AND NOT short THEN aspect END AS top_aspect, {STRUCT} AS top_aspect_sentiment
FROM a"""
MESSAGE_ASPECTS = f"""{MESSAGES},
src AS (SELECT doc_id AS post_id, clean FROM messages),
src_split AS MATERIALIZED (SELECT doc_id AS post_id, {sentences('clean')} AS parts FROM messages),
src_sents AS (SELECT post_id, unnest(parts) AS sentence FROM src_split),
src_rated AS MATERIALIZED (SELECT post_id, sentence, {score('sentence')} AS score FROM src_sents)
{ASPECTS_OF}"""
ORACLES["map_entries"] = f"""WITH {MESSAGE_ASPECTS}, {EXPLODED}
SELECT e.user_name, e.hashtag, m.aspect, {f32('m.sentiment')} AS sentiment, {NOW} AS processing_time, e.said AS timestamp
FROM exploded e JOIN aspect_means m ON m.post_id = e.doc_id"""
ORACLES["write_aspects"] = ORACLES["map_entries"]
ORACLES["enrich_aspects"] = f"""WITH {MESSAGE_ASPECTS},
listed AS (SELECT post_id, string_agg(line, chr(10) ORDER BY line) AS aspects FROM (
  SELECT post_id, aspect || '=' || CAST(CAST(CAST(sentiment AS FLOAT) AS DECIMAL(10, 6)) AS VARCHAR) AS line FROM aspect_means) GROUP BY 1),
all_phrases AS (SELECT post_id, {each('p', 'phrase', 'pos')} FROM cand_lists),
best AS (SELECT post_id, phrase FROM (SELECT post_id, phrase, count(*) AS n, min(pos) AS pos FROM all_phrases GROUP BY 1, 2)
  QUALIFY row_number() OVER (PARTITION BY post_id ORDER BY n DESC, pos) = 1),
f AS (SELECT *, {score('clean')} AS s FROM messages)
SELECT f.content, {f32('f.s')} AS sentiment, {label5('f.s::FLOAT::DOUBLE')} AS sentiment_category,
  coalesce(c.aspects, '') AS aspects, b.phrase AS dominant_aspect, length(f.clean)::DOUBLE AS content_length,
  len(f.hashtags)::INTEGER AS hashtag_count, {NOW} AS processing_time
FROM f LEFT JOIN listed c ON c.post_id = f.doc_id LEFT JOIN best b ON b.post_id = f.doc_id
UNION ALL SELECT NULL, 0, 'neutral', '', NULL, 0, NULL, {NOW} FROM {MALFORMED}"""
ORACLES["dual_sink"] = f"""WITH {MESSAGE_ASPECTS}, {EXPLODED}
SELECT s.sink, user_name, hashtag, content, {f32(score('clean'))} AS sentiment FROM exploded, (SELECT unnest(['posts', 'processed']) AS sink) s
UNION ALL SELECT 'aspects', e.user_name, e.hashtag, m.aspect, {f32('m.sentiment')} FROM exploded e JOIN aspect_means m ON m.post_id = e.doc_id"""
ORACLES["processed_tail"] = (
    "SELECT doc_id, source AS user, text AS content, lang AS hashtag, '2024-01-30T00:00:00' AS timestamp"
    " FROM documents WHERE doc_id % 3 > 0 ORDER BY doc_id DESC LIMIT 20"
)
ORACLES["posts_sample"] = (
    f"WITH {MESSAGES}, {EXPLODED} SELECT user_name, hashtag, substring(content, 1, 50) AS content_preview"
    " FROM exploded ORDER BY user_name, hashtag, content LIMIT 5"
)
OLD = f"{NOW} - INTERVAL '1 day'"
ORACLES["cleanup_old_data"] = (
    f"WITH {POSTS}, {ASPECTS}, {anomalies('a1', '2024-01-29 00:00:00', 1.0)}, {anomalies('a2', AS_OF, 1.0)}"
    f" SELECT 'posts' AS table_name, count(*) AS rows_deleted FROM posts WHERE post_id % 10 <> 0 AND processing_time < {OLD}"
    f" UNION ALL SELECT 'aspect_sentiments', count(*) FROM aspects WHERE processing_time < {OLD}"
    f" UNION ALL SELECT 'anomaly_detection', count(*) FROM (SELECT * FROM a1 UNION ALL SELECT * FROM a2) WHERE detected_at < {OLD}"
)
ORACLES["cleanup_kept"] = with_posts(
    ", p AS (SELECT post_id, hashtag, CASE WHEN post_id % 10 <> 0 THEN processing_time END AS processing_time FROM posts)"
    f" SELECT * FROM p WHERE processing_time IS NULL OR processing_time >= {OLD}"
)
ORACLES["refresh_views"] = (
    f"WITH {POSTS}, {ASPECTS}, t AS (SELECT {BASE_STATS}, count(DISTINCT dominant_aspect) AS unique_aspects,"
    " min(processing_time) AS first_seen FROM posts GROUP BY hashtag),"
    f" a AS (SELECT aspect AS name, count(*) AS mention_count, {r('avg(sentiment)', 'avg_sentiment')}, {r('stddev(sentiment)', 'sentiment_stddev')},"
    " count(DISTINCT hashtag) AS hashtag_count, count(DISTINCT user_name) AS user_count, max(processing_time) AS last_seen,"
    " min(processing_time) AS first_seen FROM aspects GROUP BY 1 HAVING count(*) >= 3)"
    " SELECT * RENAME (hashtag AS name) FROM t UNION ALL BY NAME SELECT * FROM a"
)
ORACLES["refresh_views_deleted"] = (
    ORACLES["refresh_views"]
    .replace("FROM posts GROUP BY", "FROM posts WHERE processing_time >= TIMESTAMP '2024-01-23 12:00:00' GROUP BY")
    .replace("FROM aspects GROUP BY", "FROM aspects WHERE processing_time >= TIMESTAMP '2024-01-23 12:00:00' GROUP BY")
)
ORACLES["delete_old"] = ORACLES["cleanup_old_data"].replace(OLD, "TIMESTAMP '2024-01-30 06:00:00'")
UNCHECKED = NULL_USERS + """,
unchecked AS (SELECT * EXCLUDE (hashtag), CASE WHEN post_id % 100 = 1 THEN repeat(hashtag, 100) ELSE hashtag END AS hashtag FROM audited)
"""
ORACLES["validate_posts"] = (
    f"WITH {UNCHECKED} SELECT post_id, concat_ws('; ', CASE WHEN user_name IS NULL THEN 'user_name is null' END,"
    " CASE WHEN length(hashtag) > 255 THEN 'hashtag longer than 255' END) AS reason, length(hashtag)::INTEGER AS tag_length"
    " FROM unchecked WHERE user_name IS NULL OR length(hashtag) > 255"
)
ORACLES["validate_posts_kept"] = (
    f"WITH {UNCHECKED} SELECT post_id, user_name, hashtag FROM unchecked WHERE user_name IS NOT NULL AND length(hashtag) <= 255"
)
ORACLES["conform_schema"] = with_posts(
    "SELECT user_name, NULL::VARCHAR AS content, hashtag, round(CAST(sentiment AS DECIMAL(30, 12)), 6)::DOUBLE AS sentiment, NULL::VARCHAR AS sentiment_category,"
    " NULL::VARCHAR AS dominant_aspect, NULL::DOUBLE AS content_length, NULL::INTEGER AS hashtag_count, processing_time, timestamp,"
    " NULL::VARCHAR AS sentiment_summary, NULL::VARCHAR AS top_aspect, NULL::DOUBLE AS top_aspect_sentiment FROM posts"
)
PROFILE = (
    ("user_name", "string"), ("sentiment", "double"), ("content_length", "double"), ("hashtag_count", "int"),
    ("dominant_aspect", "string"), ("processing_time", "timestamp_ntz"), ("timestamp", "timestamp_ntz"), ("hashtag", "string"),
)
ORACLES["profile_posts"] = f"WITH {NULL_USERS} " + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{t}' AS data_type,"
    f" {f'max(length({c}))::INTEGER' if t == 'string' else 'NULL::INTEGER'} AS max_length,"
    f" count(*) FILTER ({c} IS NULL) AS null_count FROM audited"
    for c, t in PROFILE
)

# Graph: the naive pairs of rows, and textbook formulas on the small result


def edges(span: str) -> str:
    return POSTS + f""",
marked AS MATERIALIZED (SELECT user_name, hashtag, row_number() OVER () AS rn FROM posts WHERE {recent(span)}),
edges AS MATERIALIZED (
  SELECT least(a.hashtag, b.hashtag) AS src, greatest(a.hashtag, b.hashtag) AS dst, count(*) AS weight
  FROM marked a JOIN marked b ON a.user_name = b.user_name AND a.rn < b.rn GROUP BY 1, 2),
adj AS MATERIALIZED (
  SELECT src AS u, dst AS v, weight AS w FROM edges UNION ALL SELECT dst, src, weight FROM edges WHERE src <> dst),
nodes AS MATERIALIZED (SELECT DISTINCT u AS node, (SELECT count(DISTINCT u) FROM adj) AS n FROM adj)
"""


DAY_EDGES = edges("24 hours")
ORACLES["cooccurrence_edges"] = f"WITH {DAY_EDGES} SELECT src, dst, weight FROM edges"
TAG_PAIRS = f"counts AS (SELECT user_name, hashtag AS tag, count(*) AS c FROM posts WHERE {recent(f'{31 * 24} hours')} GROUP BY 1, 2)"
ORACLES["cooccurrence_edges_month"] = with_posts(
    f", {TAG_PAIRS} SELECT a.tag AS src, b.tag AS dst, sum(CASE WHEN a.tag = b.tag THEN a.c * (a.c - 1) // 2 ELSE a.c * b.c END)::BIGINT AS weight"
    " FROM counts a JOIN counts b ON a.user_name = b.user_name AND a.tag <= b.tag GROUP BY 1, 2 HAVING weight > 0"
)
DEGREE = """degree AS (
  SELECT node AS hashtag, (CASE WHEN n <= 1 THEN 1 ELSE
    (count(*) + count(*) FILTER (u = v)) / (n - 1) END)::DOUBLE AS degree_centrality FROM adj JOIN nodes ON u = node GROUP BY node, n)"""
PAGERANK = """strength AS MATERIALIZED (SELECT u, sum(w)::DOUBLE AS s FROM adj GROUP BY 1),
steps AS MATERIALIZED (SELECT a.u, a.v, a.w / s.s AS p, n FROM adj a JOIN strength s USING (u) JOIN nodes ON node = a.u),
walk AS (
  SELECT 0 AS it, node, 1.0::DOUBLE / n AS rank FROM nodes
  UNION ALL
  SELECT any_value(walk.it) + 1, steps.v, 0.85::DOUBLE * sum(walk.rank * steps.p) + 0.15::DOUBLE / any_value(steps.n)
  FROM walk JOIN steps ON steps.u = walk.node WHERE walk.it < 100 GROUP BY steps.v),
change AS (SELECT b.it, sum(abs(b.rank - a.rank)) AS d, count(*) AS n FROM walk a JOIN walk b ON a.node = b.node AND b.it = a.it + 1 GROUP BY 1),
pagerank AS (SELECT node AS hashtag, rank AS pagerank FROM walk WHERE it = (SELECT min(it) FROM change WHERE d < n * 1e-6))"""
BETWEENNESS = """ways AS MATERIALIZED (SELECT u, v, w FROM adj WHERE u <> v),
dist(s, t, d) USING KEY (s, t) AS (
  SELECT node, node, 0::BIGINT FROM nodes
  UNION
  SELECT c.s, c.t, c.d FROM (SELECT dist.s, ways.v AS t, min(dist.d + ways.w)::BIGINT AS d FROM dist JOIN ways ON ways.u = dist.t GROUP BY 1, 2) c
  LEFT JOIN recurring.dist AS known ON known.s = c.s AND known.t = c.t WHERE known.d IS NULL OR c.d < known.d),
short AS MATERIALIZED (
  SELECT a.s, w.u, w.v FROM dist a JOIN ways w ON w.u = a.t JOIN dist b ON b.s = a.s AND b.t = w.v WHERE a.d + w.w = b.d),
path(round, s, t, n) AS (
  SELECT 0, node, node, 1.0::DOUBLE FROM nodes
  UNION ALL
  SELECT any_value(path.round) + 1, short.s, short.v, sum(path.n) FROM path JOIN short ON short.s = path.s AND short.u = path.t GROUP BY short.s, short.v),
sigma AS MATERIALIZED (
  SELECT p.s, p.t, p.n, dist.d FROM (SELECT s, t, sum(n) AS n FROM path GROUP BY 1, 2) p JOIN dist ON dist.s = p.s AND dist.t = p.t),
through AS (
  SELECT a.t AS node, sum(a.n * b.n / c.n) AS share FROM sigma a JOIN sigma b ON b.s = a.t JOIN sigma c ON c.s = a.s AND c.t = b.t
  WHERE a.s <> a.t AND b.t <> a.t AND a.s <> b.t AND a.d + b.d = c.d GROUP BY 1),
betweenness AS (
  SELECT node AS hashtag, CASE WHEN n <= 2 THEN 0 ELSE coalesce(share, 0) / ((n - 1) * (n - 2)) END::DOUBLE AS betweenness_centrality
  FROM nodes LEFT JOIN through USING (node))"""
ORACLES["degree_centrality"] = (
    f"WITH {DAY_EDGES}, {DEGREE} SELECT hashtag, {r('degree_centrality', 'degree_centrality')} FROM degree"
)
ORACLES["pagerank"] = f"WITH RECURSIVE {DAY_EDGES}, {PAGERANK} SELECT hashtag, {r('pagerank', 'pagerank')} FROM pagerank"
ORACLES["betweenness"] = (
    f"WITH RECURSIVE {DAY_EDGES}, {BETWEENNESS} SELECT hashtag, {r('betweenness_centrality', 'betweenness_centrality')} FROM betweenness"
)
CENTRALITY = f"WITH RECURSIVE {DAY_EDGES}, {DEGREE}, {PAGERANK}, {BETWEENNESS}"
JOINED = "degree JOIN betweenness USING (hashtag) JOIN pagerank USING (hashtag)"
ORACLES["centrality_table"] = (
    f"{CENTRALITY} SELECT hashtag, {r('degree_centrality', 'degree_centrality')},"
    f" {r('betweenness_centrality', 'betweenness_centrality')}, {r('pagerank', 'pagerank')} FROM {JOINED}"
)


def numeric4(x: str) -> str:
    return f"round(CAST({x} AS DECIMAL(20, 10)), 4)::DOUBLE"


ORACLES["top_central_hashtags"] = (
    f"{CENTRALITY} SELECT hashtag, {numeric4('degree_centrality')} AS degree, {numeric4('betweenness_centrality')} AS betweenness,"
    f" {numeric4('pagerank.pagerank')} AS pagerank FROM {JOINED} ORDER BY pagerank.pagerank DESC, hashtag LIMIT 20"
)

# Streams give what the batch gives

ORACLES["stream_posts_per_minute"] = with_posts(
    f"SELECT date_trunc('minute', processing_time) AS time, count(*) AS posts_count, {r('avg(sentiment)', 'avg_sentiment')} FROM posts GROUP BY 1"
)
ORACLES["stream_hourly_sentiment"] = with_posts(
    f"SELECT date_trunc('hour', processing_time) AS time, {label3('sentiment')} AS sentiment_category, count(*) AS count FROM posts GROUP BY 1, 2"
)
ORACLES["stream_top_hashtags"] = with_posts(
    """, minutes AS (SELECT date_trunc('minute', processing_time) AS minute, hashtag, count(*) AS n FROM posts GROUP BY 1, 2),
placed AS (SELECT unnest(generate_series(minute + INTERVAL 1 MINUTE, minute + INTERVAL 60 MINUTE, INTERVAL 1 MINUTE)) AS window_end, hashtag, n FROM minutes),
counted AS (SELECT window_end, hashtag, sum(n)::BIGINT AS count FROM placed GROUP BY 1, 2)
SELECT window_end, hashtag, count, (row_number() OVER (PARTITION BY window_end ORDER BY count DESC, hashtag))::INTEGER AS rank
FROM counted WHERE window_end <= (SELECT max(minute + INTERVAL 1 MINUTE) FROM minutes) QUALIFY rank <= 10"""
)

# Single columns of the queries with several


def part(whole: str, keys: str, **columns: str) -> None:
    for name, listed in columns.items():
        ORACLES[name] = f"SELECT {keys}, {listed} FROM ({ORACLES[whole]})"


part("sentiment_labels", "post_id, hashtag", sentiment_category5="category5", sentiment_category3="category3", tone="tone")
part(
    "scalar_functions",
    "post_id, hashtag",
    hashtag_count="tags",
    length_band="in_band",
    snippet="start",
    norm_aspect="aspect",
    date_trunc="minute, hour",
    round_n="rounded, rounded_binary, fixed",
    null_safe_div="ratio",
    falsy_to_zero="filled",
    abs_z="magnitude",
    reason_text="reason",
    summary_pronounced="summary",
)
part("post_sentiment_struct", "post_id", summary_text="sentiment_summary")

ORACLES["raw_source"] = ORACLES["parse_messages"]
ORACLES["communities_checked"] = (
    f"WITH {DAY_EDGES}, {DEGREE} SELECT hashtag, 1::BIGINT AS times, true AS in_order, true AS gains FROM degree"
)
ORACLES["betweenness_checked"] = f"WITH {DAY_EDGES}, {DEGREE} SELECT hashtag, true AS within, true AS bounded FROM degree"
ORACLES["cluster_users_checked"] = with_posts(
    f"SELECT user_name, 1::BIGINT AS times, true AS in_range, true AS nearest FROM ({features('7 days', 5)})"
)

MESSAGE_WORDS = lexicon_scores("by_text", "contents", "doc_id", "clean")
CONTENTS = "contents AS MATERIALIZED (SELECT doc_id, clean FROM messages)"
ORACLES["enrich_basic_lexicon"] = f"""WITH {MESSAGES}, {CONTENTS}, {LEXICON}, {MESSAGE_WORDS}
SELECT user_name, content, timestamp, {f32('polarity')} AS sentiment, length(clean)::DOUBLE AS content_length,
  len(hashtags)::INTEGER AS hashtag_count, {NOW} AS processing_time FROM messages JOIN by_text USING (doc_id)
UNION ALL SELECT NULL, NULL, NULL, 0, 0, NULL, {NOW} FROM documents WHERE length(text) % 7 = 0"""
ORACLES["ingest_stream_lexicon"] = f"""WITH {MESSAGES}, {CONTENTS}, {LEXICON}, {MESSAGE_WORDS}, {EXPLODED}
SELECT user_name, content, hashtag, {f32('polarity')} AS sentiment, length(clean)::DOUBLE AS content_length,
  len(hashtags)::INTEGER AS hashtag_count FROM exploded JOIN by_text USING (doc_id)"""
ORACLES["enrich_struct_lexicon"] = f"""WITH whole AS ({ORACLES['post_sentiment_lexicon']}), {MESSAGES}
SELECT user_name, content, timestamp, w.overall_sentiment, w.overall_subjectivity, w.sentiment_summary, w.top_aspect,
  w.top_aspect_sentiment, length(clean)::DOUBLE AS content_length, len(hashtags)::INTEGER AS hashtag_count, {NOW} AS processing_time
FROM messages m JOIN whole w ON w.post_id = m.doc_id
UNION ALL SELECT NULL, NULL, NULL, 0, 0, 'No content', NULL, 0, 0, NULL, {NOW} FROM {MALFORMED}"""
# The aspects of messages with the sentences and the whole text scored by the lexicon.
MESSAGE_SENTENCES = lexicon_scores("by_line", "src_sents", "post_id, pos", "sentence")
ORACLES["enrich_aspects_lexicon"] = (
    ORACLES["enrich_aspects"]
    .replace("src_sents AS (SELECT post_id, unnest(parts) AS sentence FROM src_split)",
             f"src_sents AS MATERIALIZED (SELECT post_id, {each('parts', 'sentence', 'pos')} FROM src_split), {LEXICON}, {MESSAGE_SENTENCES},"
             f" {CONTENTS}, {MESSAGE_WORDS}")
    .replace(f"src_rated AS MATERIALIZED (SELECT post_id, sentence, {score('sentence')} AS score FROM src_sents)",
             "src_rated AS MATERIALIZED (SELECT post_id, sentence, polarity AS score FROM src_sents JOIN by_line USING (post_id, pos))")
    .replace(f"f AS (SELECT *, {score('clean')} AS s FROM messages)", "f AS (SELECT m.*, t.polarity AS s FROM messages m JOIN by_text t USING (doc_id))")
)

BY_DOC = lexicon_scores("by_doc", "docs", "post_id", "clean")
ORACLES["rich_aspect_analysis_lexicon"] = (
    ORACLES["rich_aspect_analysis"]
    .replace("low AS MATERIALIZED (SELECT *, lower(sentence) AS low FROM rated)",
             f"{LEXICON.strip()}, {BY_SENTENCE.strip()}, {BY_DOC.strip()},\nlow AS MATERIALIZED (SELECT s.post_id, s.pos, s.sentence,"
             " b.polarity AS score, lower(s.sentence) AS low FROM sents s JOIN by_sentence b USING (post_id, pos))")
    .replace(f"{score('clean')} AS overall FROM docs", "polarity AS overall, subjectivity FROM docs JOIN by_doc USING (post_id)")
    .replace("0.5::DOUBLE AS overall_subjectivity", "round(CAST(printf('%.3f', subjectivity)::DOUBLE AS DECIMAL(30, 12)), 6)::DOUBLE AS overall_subjectivity")
)
