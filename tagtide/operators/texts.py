"""Sentences, lexicon scores, phrases, entities and aspects of posts.

``posts`` has ``post_id`` and ``content``. Everything that depends on one text only is
an expression on its row and needs no shuffle. Only the lookups in a lexicon or a
gazetteer, which may be large tables, are joins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagtide.functions.arrays import let, unnest
from tagtide.functions.numbers import round_binary
from tagtide.functions.sentiment import (
    mean_score,
    positions,
    score_simple,
    scored_sentences,
    sentiment_category5,
    summary_pronounced,
    summary_text,
)
from tagtide.functions.text import (
    MIN_CONTENT_LENGTH,
    STOPWORDS,
    clean_html,
    content_length,
    dominant,
    hashtag_count,
    inline_hashtags,
    length_band,
    norm_aspect,
    phrases,
    simple_aspect,
    snippet,
    split_sentences,
    tokens,
)
from tagtide.functions.times import AsOf, moment
from tagtide.operators.lexicons import word_sums, word_tables
from tagtide.operators.matching import with_hits
from tagtide.operators.skew import is_small, lookup, spread_join
from tagtide.operators.trie import longest_runs
from tagtide.session import cut_lineage

# The rule of the lexicon scorer, and the kinds of entities that count.
NEGATORS = ("no", "not", "never", "none", "nor", "neither", "cannot")
NEGATION = -0.5
ENTITY_TYPES = ("PERSON", "ORG", "GPE", "PRODUCT")
EVENT_TYPES = (*ENTITY_TYPES, "EVENT")
TOPIC = "TOPIC"


# Sentences and scores


def sentence_rows(posts: DataFrame, variant: str = "punctuation") -> DataFrame:
    """``post_id, pos, sentence`` of the cleaned contents."""
    clean = posts.select("post_id", clean_html(F.col("content")).alias("clean"))
    return unnest(clean, ["post_id"], split_sentences(F.col("clean"), variant), "sentence", pos="pos")


def sentence_scores(
    posts: DataFrame, scorer=score_simple, lexicon: DataFrame | None = None, variant: str = "punctuation"
) -> DataFrame:
    """``post_id, pos, sentence, score``, scored by an expression or by a lexicon."""
    rows = sentence_rows(posts, variant)
    if lexicon is None:
        return rows.withColumn("score", scorer(F.col("sentence")))
    scores = lexicon_scores(rows, ["post_id", "pos"], "sentence", lexicon)
    return rows.join(scores.select("post_id", "pos", F.col("polarity").alias("score")), ["post_id", "pos"])


def known_words(lexicon: DataFrame) -> DataFrame:
    """The lexicon by words as they come out of a text, each once: a word that is listed twice has the mean.

    Case and surrounding signs do not matter. A word that a text splits in two is never found.
    """
    word = F.array_join(tokens(F.col("word")), " ")
    return lexicon.groupBy(word.alias("word")).agg(
        *[F.avg(c).alias(c) for c in ("polarity", "subjectivity", "intensity")]
    )


def known_surfaces(gazetteer: DataFrame, types: Sequence[str]) -> DataFrame:
    """``surface, type`` of these types, as their words come out of a text, each surface once."""
    surface = F.array_join(tokens(F.col("surface")), " ")
    known = gazetteer.filter(F.col("type").isin(*types)).groupBy(surface.alias("surface"))
    return known.agg(F.min("type").alias("type")).filter("surface <> ''")


def lexicon_scores(rows: DataFrame, keys: Sequence[str], text: str, lexicon: DataFrame) -> DataFrame:
    """``keys, polarity, subjectivity``: means over the words found in the lexicon.

    A negator directly before a word turns its polarity by -0.5; an intensifier there
    scales it. Texts without a known word get 0.0. A lexicon counted to be small enough for a broadcast
    is looked up text by text, so that only sums are shuffled; with a larger one each word is a row.
    """
    if is_small(lexicon, "word"):
        tables = word_tables(known_words(lexicon), NEGATORS, NEGATION)
        summed = rows.select(*keys, word_sums(tokens(F.col(text)), tables, rows).alias("_s"))
        mean = lambda total, n: F.coalesce(F.try_divide(F.sum(f"_s.{total}"), F.sum(f"_s.{n}")), F.lit(0.0))
        return summed.groupBy(*keys).agg(
            mean("polarity", "rated").alias("polarity"), mean("subjectivity", "judged").alias("subjectivity")
        )

    def pairs(w: Column) -> Column:
        return F.transform(
            w,
            lambda word, i: F.struct(
                i.alias("at"), word.alias("word"), F.coalesce(F.get(w, i - 1), F.lit("")).alias("before")
            ),
        )

    lexicon = known_words(lexicon)
    rated = lexicon.filter("polarity <> 0 OR subjectivity <> 0").select("word", "polarity", "subjectivity")
    scaling = lexicon.filter("intensity <> 1").select(F.col("word").alias("before"), "intensity")
    spoken = unnest(rows, keys, let(tokens(F.col(text)), pairs), "t").select(*keys, "t.*")
    where = [*keys, "at"]
    found = lookup(spoken, rated, "word", where, False)
    found = lookup(found, scaling, "before", where, False, "left")
    turned = (
        F.col("polarity")
        * F.when(F.col("before").isin(*NEGATORS), F.lit(NEGATION)).otherwise(F.lit(1.0))
        * F.coalesce("intensity", F.lit(1.0))
    )
    scored = found.select(
        *keys, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), turned)).alias("polarity"), "subjectivity"
    )
    # Texts without a match come in as rows of NULLs: no join back to the texts.
    none = F.lit(None).cast("double")
    every = rows.select(*keys, none.alias("polarity"), none.alias("subjectivity"))
    return scored.unionByName(every).groupBy(*keys).agg(
        F.coalesce(F.avg("polarity"), F.lit(0.0)).alias("polarity"),
        F.coalesce(F.avg("subjectivity"), F.lit(0.0)).alias("subjectivity"),
    )


def lexicon_sentiment(posts: DataFrame, lexicon: DataFrame) -> DataFrame:
    """``post_id, polarity, subjectivity`` of the cleaned contents."""
    clean = posts.select("post_id", clean_html(F.col("content")).alias("clean"))
    return lexicon_scores(clean, ["post_id"], "clean", lexicon)


def scored_posts(
    posts: DataFrame, scorer=score_simple, lexicon: DataFrame | None = None, variant: str = "punctuation"
) -> DataFrame:
    """``posts`` with ``clean, overall, subjectivity`` and the array ``sentences``."""
    posts = posts.withColumn("clean", clean_html(F.col("content")))
    if lexicon is None:
        return posts.withColumns(
            {
                "overall": scorer(F.col("clean")),
                "subjectivity": F.lit(0.5),
                "sentences": scored_sentences(split_sentences(F.col("clean"), variant), scorer),
            }
        )
    # Scored once: the sentences are written, then grouped beside the score of the whole text.
    rows = cut_lineage(sentence_scores(posts, lexicon=lexicon, variant=variant))
    per_post = rows.groupBy("post_id").agg(
        F.array_sort(
            F.collect_list(F.struct("pos", F.col("sentence").alias("text"), F.lower("sentence").alias("low"), "score"))
        ).alias("sentences")
    )
    per_post = per_post.withColumn("sentences", F.transform("sentences", lambda s: s.dropFields("pos")))
    overall = lexicon_sentiment(posts, lexicon).withColumnRenamed("polarity", "overall")
    nothing = F.array().cast(dict(per_post.dtypes)["sentences"])
    joined = posts.join(overall, "post_id").join(per_post, "post_id", "left")
    return joined.withColumn("sentences", F.coalesce("sentences", nothing))


# Phrases


def phrase_candidates(posts: DataFrame, stopwords: Sequence[str] = STOPWORDS) -> DataFrame:
    """``post_id, pos, phrase`` in text order."""
    clean = posts.select("post_id", clean_html(F.col("content")).alias("clean"))
    return unnest(clean, ["post_id"], phrases(F.col("clean"), stopwords), "phrase", pos="pos")


def dominant_phrase(candidates: DataFrame) -> DataFrame:
    """The most frequent phrase of each post; the first one wins a tie."""
    counted = candidates.groupBy("post_id", "phrase").agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("pos"))
    return counted.groupBy("post_id").agg(
        F.max_by("phrase", F.struct(F.col("n"), -F.col("pos"))).alias("dominant_aspect")
    )


# Aspects and sentences


def aspect_sentences(aspects: DataFrame, sentences: DataFrame) -> DataFrame:
    """Pairs of an aspect and a sentence of the same post that contains it.

    The sentences are written once, as they are counted, placed in blocks and joined.
    """
    sentences = cut_lineage(sentences)
    return spread_join(
        aspects, sentences, ["post_id"], ["pos"], F.contains(F.lower("sentence"), F.col("aspect"))
    )


def aspect_mean(matches: DataFrame) -> DataFrame:
    """``post_id, aspect, sentiment``: mean score of the sentences of an aspect."""
    return matches.groupBy("post_id", "aspect").agg(F.avg("score").alias("sentiment"))


def aspect_sentiments(posts: DataFrame, scorer=score_simple, stopwords: Sequence[str] = STOPWORDS) -> DataFrame:
    """``post_id, aspect, sentiment`` for phrases and tags found in each text."""
    rated = with_aspect_map(scored_posts(posts, scorer), stopwords)
    return unnest(rated, ["post_id"], "aspect_sentiments", "aspect", "sentiment")


def with_aspect_map(scored: DataFrame, stopwords: Sequence[str] = STOPWORDS) -> DataFrame:
    """Adds ``aspect_sentiments``, a ``map<string, float>`` of mean sentence scores.

    Phrases first; a tag written in the text is added under its own name unless a
    phrase has it, scored on the sentences that hold ``#tag``. Each row is complete in
    itself, so there is no shuffle and streams work too.
    """
    named = F.filter(phrases(F.col("clean"), stopwords), lambda p: length_band(p))
    listed = scored.withColumns(
        {"_phrases": F.array_distinct(named), "_tags": F.array_distinct(inline_hashtags(F.col("clean")))}
    )
    listed = listed.withColumn(
        "_needles", F.concat("_phrases", F.transform("_tags", lambda t: F.concat(F.lit("#"), t)))
    )
    matched = with_hits(listed, "_needles", "_hits")

    def entries(names: str, offset: Column, sent: Column, hits: Column) -> Column:
        rated = F.transform(
            names,
            lambda a, i: F.struct(
                a.alias("aspect"), mean_score(sent, F.get(hits, offset + i)).cast("float").alias("sentiment")
            ),
        )
        return F.filter(rated, lambda e: e["sentiment"].isNotNull())

    def combine(x: Column) -> Column:
        found = entries("_phrases", F.lit(0), x["s"], x["h"])
        tagged = entries("_tags", F.size("_phrases"), x["s"], x["h"])
        return let(
            F.struct(found.alias("f"), F.transform(found, lambda e: e["aspect"]).alias("names")),
            lambda y: F.concat(y["f"], F.filter(tagged, lambda e: ~F.array_contains(y["names"], e["aspect"]))),
        )

    both = F.struct(F.col("sentences").alias("s"), F.col("_hits").alias("h"))
    return matched.withColumn("aspect_sentiments", F.map_from_entries(let(both, combine))).drop(
        "_phrases", "_tags", "_needles", "_hits"
    )


def aspect_sentiments_of(
    posts: DataFrame, candidates: DataFrame, scorer=score_simple, lexicon: DataFrame | None = None
) -> DataFrame:
    """As ``aspect_sentiments``, for given phrases ``post_id, phrase`` and any scorer."""
    sentences = sentence_scores(posts, scorer, lexicon)
    named = (
        candidates.select("post_id", norm_aspect(F.col("phrase")).alias("aspect"))
        .filter(length_band(F.col("aspect")))
        .distinct()
    )
    found = aspect_mean(aspect_sentences(named, sentences))
    clean = posts.select("post_id", clean_html(F.col("content")).alias("clean"))
    tags = unnest(clean, ["post_id"], F.array_distinct(inline_hashtags(F.col("clean"))), "hashtag")
    tagged = hashtag_sentences(tags, sentences, literal=True)
    tagged = tagged.select("post_id", F.col("hashtag").alias("aspect"), "sentiment")
    new = tagged.join(found.select("post_id", "aspect"), ["post_id", "aspect"], "left_anti")
    return found.unionByName(new)


def as_map(aspects: DataFrame) -> DataFrame:
    """``post_id, aspect_sentiments`` with one ``map<string, float>`` per post."""
    entry = F.struct("aspect", F.col("sentiment").cast("float").alias("sentiment"))
    return aspects.groupBy("post_id").agg(
        F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("aspect_sentiments")
    )


def hashtag_sentences(
    tags: DataFrame, sentences: DataFrame, overall: DataFrame | None = None, literal: bool = False
) -> DataFrame:
    """``post_id, hashtag, sentiment``: mean score of the sentences that hold a tag.

    ``literal`` looks for ``#tag`` instead of the bare word. With ``overall``
    (``post_id, overall``) a tag without a sentence gets the score of its post;
    without it such a tag is left out.
    """
    needle = F.lower("hashtag")
    if literal:
        needle = F.concat(F.lit("#"), needle)
    sentences = cut_lineage(sentences)
    pairs = cut_lineage(tags.select("post_id", "hashtag").distinct())
    held = spread_join(pairs, sentences, ["post_id"], ["pos"], F.contains(F.lower("sentence"), needle))
    means = held.groupBy("post_id", "hashtag").agg(F.avg("score").alias("sentiment"))
    if overall is None:
        return means
    return (
        pairs.join(means, ["post_id", "hashtag"], "left")
        .join(overall.select("post_id", "overall"), "post_id")
        .select("post_id", "hashtag", F.coalesce("sentiment", "overall").alias("sentiment"))
    )


def top_aspects_by_intensity(aspects: DataFrame, k: int = 3) -> DataFrame:
    """The ``k`` aspects of each post with the strongest sentiment, with ``rank``."""
    order = Window.partitionBy("post_id").orderBy(F.desc(F.abs("sentiment")), "pos")
    return aspects.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def most_pronounced_aspect(aspects: DataFrame) -> DataFrame:
    """The aspect of each post with the strongest sentiment; the first wins a tie."""
    strongest = F.max_by(F.struct("aspect", "sentiment"), F.struct(F.abs("sentiment"), -F.col("pos")))
    return aspects.groupBy("post_id").agg(strongest.alias("top")).select("post_id", "top.aspect", "top.sentiment")


def related_aspects(aspects: DataFrame, tags: DataFrame, k: int = 3) -> DataFrame:
    """``post_id, hashtag, related_aspects``: the first aspects whose context holds the tag."""
    aspects = cut_lineage(aspects)
    pairs = cut_lineage(tags.select("post_id", "hashtag").distinct())
    held = spread_join(pairs, aspects, ["post_id"], ["pos"], F.contains(F.lower("context"), F.lower("hashtag")))
    order = Window.partitionBy("post_id", "hashtag").orderBy("pos")
    first = held.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    lists = first.groupBy("post_id", "hashtag").agg(
        F.array_sort(F.collect_list(F.struct("pos", "aspect"))).alias("listed")
    )
    none = F.array().cast("array<string>")
    return pairs.join(lists, ["post_id", "hashtag"], "left").select(
        "post_id", "hashtag", F.coalesce(F.col("listed.aspect"), none).alias("related_aspects")
    )


# Entities


def entity_rows(posts: DataFrame, gazetteer: DataFrame, types: Sequence[str] = ENTITY_TYPES) -> DataFrame:
    """``post_id, pos, surface, type``: at each word the longest known surface.

    Surfaces are compared word by word, whatever their case, hyphens and signs. Nothing runs
    while the plan is built.
    """
    clean = posts.select("post_id", clean_html(F.col("content")).alias("clean"))
    return longest_runs(clean, ["post_id"], tokens(F.col("clean")), known_surfaces(gazetteer, types))


def entity_aspects(
    posts: DataFrame,
    gazetteer: DataFrame,
    types: Sequence[str] = ENTITY_TYPES,
    stopwords: Sequence[str] = STOPWORDS,
) -> DataFrame:
    """``post_id, aspect, type``: the first entity, else the first phrase, else NULL."""
    entities = entity_rows(posts, gazetteer, types).select(
        "post_id", F.lit(0).alias("kind"), "pos", F.struct(F.col("surface").alias("aspect"), "type").alias("found")
    )
    first = F.get(phrases(clean_html(F.col("content")), stopwords, lo=4), F.lit(0))
    fallback = posts.select("post_id", F.lit(1).alias("kind"), F.lit(0).alias("pos"), first.alias("aspect")).select(
        "post_id", "kind", "pos",
        F.when(
            F.col("aspect").isNotNull(), F.struct("aspect", F.lit(TOPIC).alias("type"))
        ).alias("found"),
    )
    return (
        entities.unionByName(fallback)
        .groupBy("post_id")
        .agg(F.min_by("found", F.struct("kind", "pos")).alias("found"))
        .select("post_id", "found.aspect", "found.type")
    )


# Whole analyses of a post


def post_sentiment(
    posts: DataFrame,
    mode: str = "simple",
    scorer=score_simple,
    lexicon: DataFrame | None = None,
    gazetteer: DataFrame | None = None,
) -> DataFrame:
    """Adds overall sentiment, subjectivity, top aspect with its sentiment, and summary.

    ``simple`` uses expressions only: the word-list score for everything and the first
    capitalised word as aspect. ``lexicon`` scores by a lexicon, takes the aspect from a
    gazetteer if there is one, and scores it on the sentences that contain it.
    """
    if mode == "simple":
        rated = posts.withColumn("clean", clean_html(F.col("content")))
        rated = rated.withColumns(
            {"overall": scorer(F.col("clean")), "subjectivity": F.lit(0.5), "aspect": simple_aspect(F.col("clean"))}
        ).withColumn("aspect_score", F.col("overall"))
    elif mode == "lexicon":
        rated = scored_posts(posts, lexicon=lexicon, variant="period")
        if gazetteer is None:
            rated = rated.withColumn("aspect", simple_aspect(F.col("clean")))
        else:
            rated = rated.join(entity_aspects(posts, gazetteer).drop("type"), "post_id")
        rated = rated.withColumn(
            "aspect_score",
            F.coalesce(
                let(F.col("sentences"), lambda s: mean_score(s, positions(s, F.col("aspect")))), F.col("overall")
            ),
        )
    else:
        raise ValueError(f"unknown mode {mode!r}")

    usable = F.length("clean") >= MIN_CONTENT_LENGTH
    usable = usable & (F.coalesce("content", F.lit("")) != "")

    def guarded(c: Column) -> Column:
        return F.when(usable, c).otherwise(F.lit(0.0)).cast("float")

    summary = summary_text(
        F.col("content"), F.col("clean"), F.col("overall"), F.col("aspect"), F.col("aspect_score")
    )
    return rated.withColumns(
        {
            "overall_sentiment": guarded(F.col("overall")),
            "overall_subjectivity": guarded(F.col("subjectivity")),
            "sentiment_summary": summary,
            "top_aspect": F.when(usable, F.col("aspect")),
            "top_aspect_sentiment": guarded(F.col("aspect_score")),
        }
    ).drop("clean", "overall", "subjectivity", "aspect", "aspect_score", "sentences")


def rich_analysis(
    posts: DataFrame,
    gazetteer: DataFrame | None = None,
    scorer=score_simple,
    lexicon: DataFrame | None = None,
    stopwords: Sequence[str] = STOPWORDS,
) -> DataFrame:
    """All aspects of a post with type, sentiment and context; tags; summary; top three.

    Entities come before phrases and duplicates stay. ``posts`` also has ``hashtags``.
    """
    scored = scored_posts(posts, scorer, lexicon)
    topics = F.transform(
        phrases(F.col("clean"), stopwords, lo=4), lambda p: F.struct(p.alias("aspect"), F.lit(TOPIC).alias("kind"))
    )
    if gazetteer is None:
        named = scored.withColumn("candidates", topics)
    else:
        listed = (
            entity_rows(posts, gazetteer, EVENT_TYPES)
            .groupBy("post_id")
            .agg(F.array_sort(F.collect_list(F.struct("pos", "surface", "type"))).alias("entities"))
        )
        entities = F.transform(
            F.coalesce("entities", F.array().cast(dict(listed.dtypes)["entities"])),
            lambda e: F.struct(e["surface"].alias("aspect"), e["type"].alias("kind")),
        )
        named = scored.join(listed, "post_id", "left").withColumn("candidates", F.concat(entities, topics))

    tags = F.array_distinct(F.array_compact(F.coalesce("hashtags", F.array().cast("array<string>"))))
    listed = named.withColumn("tags", tags).withColumn(
        "needles",
        F.concat(F.transform("candidates", lambda c: c["aspect"]), F.transform("tags", lambda t: F.lower(t))),
    )
    matched = with_hits(listed, "needles")

    def rate(x: Column) -> Column:
        rated = F.transform(
            "candidates",
            lambda c, i: F.struct(
                c["aspect"].alias("aspect"),
                c["kind"].alias("aspect_type"),
                round_binary(mean_score(x["s"], F.get(x["h"], i)), 3).alias("sentiment"),
                snippet(F.get(x["s"], F.get(F.get(x["h"], i), F.lit(0)))["text"], 100).alias("context"),
            ),
        )
        return F.filter(rated, lambda a: a["sentiment"].isNotNull())

    def tag_entry(tag: Column, i: Column, x: Column) -> Column:
        near = F.filter(x["a"], lambda a: F.contains(F.lower(a["context"]), F.lower(tag)))
        own = mean_score(x["s"], F.get(x["h"], x["n"] + i))
        return F.struct(
            tag.alias("hashtag"),
            F.struct(
                round_binary(F.coalesce(own, x["o"]), 3).alias("sentiment"),
                F.slice(F.transform(near, lambda a: a["aspect"]), 1, 3).alias("related_aspects"),
            ).alias("context"),
        )

    parts = F.struct(F.col("sentences").alias("s"), F.col("hits").alias("h"))
    rated = matched.withColumn("aspect_sentiments", let(parts, rate))
    # Bound once: a column that only the lambda reads would be computed for every tag.
    parts = F.struct(
        F.col("sentences").alias("s"), F.col("hits").alias("h"), F.col("aspect_sentiments").alias("a"),
        F.col("overall").alias("o"), F.size("candidates").alias("n"),
    )
    contexts = let(parts, lambda x: F.transform("tags", lambda t, i: tag_entry(t, i, x)))
    rated = rated.withColumn("hashtag_context", F.map_from_entries(contexts))
    by_strength = F.array_sort(
        F.transform(
            F.col("aspect_sentiments"),
            lambda a, i: F.struct((-F.abs(a["sentiment"])).alias("w"), i.alias("i"), a.alias("a")),
        )
    )
    rated = rated.withColumn("dominant_aspects", F.transform(F.slice(by_strength, 1, 3), lambda x: x["a"]))
    top = F.get(F.col("dominant_aspects"), F.lit(0))
    return rated.select(
        "post_id",
        round_binary(F.col("overall"), 3).alias("overall_sentiment"),
        round_binary(F.col("subjectivity"), 3).alias("overall_subjectivity"),
        "aspect_sentiments",
        "hashtag_context",
        summary_pronounced(F.col("overall"), top["aspect"], top["sentiment"]).alias("sentiment_summary"),
        "dominant_aspects",
    )


def rich_struct(posts: DataFrame, analysis: DataFrame) -> DataFrame:
    """The five stored fields of ``rich_analysis``, with the guard for empty contents."""
    empty = F.coalesce("content", F.lit("")) == ""
    top = F.get(F.col("dominant_aspects"), F.lit(0))

    def guarded(c: Column) -> Column:
        return F.when(empty, F.lit(0.0)).otherwise(c).cast("float")

    return posts.select("post_id", "content").join(analysis, "post_id").select(
        "post_id",
        guarded(F.col("overall_sentiment")).alias("overall_sentiment"),
        guarded(F.col("overall_subjectivity")).alias("overall_subjectivity"),
        F.when(empty, F.lit("No content")).otherwise(F.col("sentiment_summary")).alias("sentiment_summary"),
        F.when(~empty, top["aspect"]).alias("top_aspect"),
        guarded(F.coalesce(top["sentiment"], F.lit(0.0))).alias("top_aspect_sentiment"),
    )


# Enrichment of messages. Without tables to look words up in it is expressions only, and runs on streams as it is


def by_content(df: DataFrame, job) -> DataFrame:
    """``df`` with the columns that ``job`` adds to the distinct contents (``post_id, content``).

    For analyses that look words up in tables: messages have no key, so each distinct content is
    written once with a number as its key, and only the number goes along with its words and
    sentences. Messages find their content's number by its digest. A missing content counts as
    an empty one. One row per content comes back, so a content that very many messages share
    splits on the other side.
    """
    content = F.coalesce(F.col("content"), F.lit(""))
    keyed = df.withColumn("_key", F.sha2(content, 256))
    distinct = keyed.select("_key", content.alias("content")).distinct()
    contents = cut_lineage(distinct.withColumn("post_id", F.monotonically_increasing_id()))
    found = job(contents.select("post_id", "content"))
    new = [c for c in found.columns if c not in ("post_id", "content")]
    by_key = contents.select("_key", "post_id").join(found.select("post_id", *new), "post_id").drop("post_id")
    return keyed.join(by_key, "_key").drop("_key")


def _arrival(now: AsOf) -> Column:
    return F.current_timestamp() if now is None else moment(now)


def enrich_basic(
    df: DataFrame, scorer=score_simple, now: AsOf = None, lexicon: DataFrame | None = None
) -> DataFrame:
    """Adds sentiment, content length, tag count and processing time. Scored by a lexicon if there is one."""
    if lexicon is None:
        df = df.withColumn("sentiment", scorer(clean_html(F.col("content"))).cast("float"))
    else:
        polarity = F.col("polarity").cast("float").alias("sentiment")
        df = by_content(df, lambda posts: lexicon_sentiment(posts, lexicon).select("post_id", polarity))
    return df.withColumns(
        {
            "content_length": content_length(F.col("content")),
            "hashtag_count": hashtag_count(F.col("hashtags")),
            "processing_time": _arrival(now),
        }
    )


def enrich_aspects(
    df: DataFrame,
    scorer=score_simple,
    now: AsOf = None,
    stopwords: Sequence[str] = STOPWORDS,
    lexicon: DataFrame | None = None,
) -> DataFrame:
    """As ``enrich_basic``, with label, aspect map and dominant aspect."""

    def rate(posts: DataFrame) -> DataFrame:
        rated = with_aspect_map(scored_posts(posts, scorer, lexicon), stopwords)
        return (
            rated.withColumn("sentiment", F.col("overall").cast("float"))
            .withColumns(
                {
                    "sentiment_category": sentiment_category5(F.col("sentiment")),
                    "dominant_aspect": dominant(phrases(F.col("clean"), stopwords)),
                    "content_length": F.length("clean").cast("float"),
                }
            )
            .drop("clean", "overall", "subjectivity", "sentences")
        )

    rated = rate(df) if lexicon is None else by_content(df, rate)
    return rated.withColumns({"hashtag_count": hashtag_count(F.col("hashtags")), "processing_time": _arrival(now)})


def enrich_struct(
    df: DataFrame,
    scorer=score_simple,
    now: AsOf = None,
    lexicon: DataFrame | None = None,
    gazetteer: DataFrame | None = None,
) -> DataFrame:
    """Adds the five fields of ``post_sentiment``, content length, tag count and time.

    With a lexicon (and a gazetteer for the aspects) as in its mode ``lexicon``.
    """
    if lexicon is None:
        rated = post_sentiment(df, scorer=scorer)
    else:
        rated = by_content(df, lambda posts: post_sentiment(posts, "lexicon", scorer, lexicon, gazetteer))
    return rated.withColumns(
        {
            "content_length": content_length(F.col("content")),
            "hashtag_count": hashtag_count(F.col("hashtags")),
            "processing_time": _arrival(now),
        }
    )
