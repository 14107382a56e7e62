"""Small known cases of the text and sentiment functions."""

import random

import pytest
from pyspark.sql import functions as F

from tagtide.functions import numbers, sentiment, text, times
from tagtide.operators import texts

POST = """
<p>We all love the new zPad 15! Its display is stunning.
However, Lumen's repair policy is getting silly.
Ada Stone should rethink it. #Lumen #zPad15 #GadgetTalk</p>
"""
MIXED = "<p>I LOVE this great phone, but the battery is bad</p>"


def posts(spark, *contents):
    rows = [(i, c, ["Lumen", "GadgetTalk"]) for i, c in enumerate(contents)]
    return spark.createDataFrame(rows, "post_id int, content string, hashtags array<string>")


def one(df):
    (row,) = df.collect()
    return row


def value(spark, column):
    return spark.range(1).select(column).first()[0]


def test_example_post(spark):
    row = one(texts.post_sentiment(posts(spark, POST)))
    assert row.overall_sentiment == 1.0
    assert row.overall_subjectivity == 0.5
    assert row.top_aspect == "however"
    assert row.sentiment_summary == "Positive tone; focused on 'however' (1.00)"
    tags = value(spark, text.inline_hashtags(text.clean_html(F.lit(POST))))
    assert tags == ["lumen", "zpad15", "gadgettalk"]


def test_mixed_post(spark):
    row = one(texts.enrich_aspects(posts(spark, MIXED), now="2024-01-01 00:00:00"))
    assert row.content_length == 47.0
    assert row.sentiment == pytest.approx(1 / 3, abs=1e-7)
    assert row.sentiment_category == "positive"
    assert row.hashtag_count == 2
    assert value(spark, sentiment.tone(F.lit(1 / 3))) == "Positive"
    assert value(spark, text.simple_aspect(F.lit("I LOVE this great phone"))) == "love"


def test_substring_counts(spark):
    row = one(texts.post_sentiment(posts(spark, "a badge of honour")))
    assert (row.overall_sentiment, row.top_aspect) == (-1.0, None)
    assert row.sentiment_summary == "Negative tone overall"
    assert value(spark, sentiment.sentiment_category5(F.lit(-1.0))) == "very_negative"


def test_guards(spark):
    rows = texts.post_sentiment(posts(spark, None, "", "<b>ok</b>")).orderBy("post_id").collect()
    for row, summary in zip(rows, ["No content", "No content", "Content too short"]):
        assert row.sentiment_summary == summary
        assert (row.overall_sentiment, row.overall_subjectivity, row.top_aspect, row.top_aspect_sentiment) == (0, 0, None, 0)
    lengths = texts.enrich_basic(posts(spark, None, "", "<b>ok</b>")).orderBy("post_id").collect()
    assert [r.content_length for r in lengths] == [0.0, 0.0, 2.0]
    assert [r.sentiment for r in lengths] == [0.0, 0.0, 0.0]


def test_labels_compare_as_double(spark):
    scores = spark.createDataFrame([(0.1,), (-0.1,), (0.5,), (-0.5,), (None,)], "s float")
    labels = [r[0] for r in scores.select(sentiment.sentiment_category5(F.col("s"))).collect()]
    assert labels == ["positive", "negative", "positive", "negative", "neutral"]
    assert value(spark, sentiment.sentiment_category3(F.lit(None).cast("double"))) == "neutral"


def test_unicode_tag(spark):
    assert value(spark, text.inline_hashtags(F.lit("#café"))) == ["café"]


def test_fixed_point_is_pythons(spark):
    rng = random.Random(1)
    xs = [rng.uniform(-3, 3) for _ in range(500)] + [k / 40 for k in range(-200, 200)] + [0.125, -0.001, 1e9 + 0.5]
    df = spark.createDataFrame([(float(x),) for x in xs], "x double")
    got = df.select("x", numbers.fixed_point(F.col("x"), 2), numbers.fixed_point(F.col("x"), 1), numbers.round_binary(F.col("x"), 3)).collect()
    for x, two, one_digit, three in got:
        assert (two, one_digit, three) == (f"{x:.2f}", f"{x:.1f}", round(x, 3))


def test_numeric_rounding_is_half_up(spark):
    assert value(spark, numbers.round_n(F.lit(1.005), 2)) == 1.01
    assert value(spark, numbers.round_n(F.lit(-0.00005), 4)) == -0.0001


def test_iso_offset_is_ignored(spark):
    assert str(value(spark, times.parse_iso(F.lit("2024-01-30T10:00:00+05:00")))) == "2024-01-30 10:00:00"
    assert value(spark, times.parse_iso(F.lit("soon"))) is None


def test_phrases_and_dominant(spark):
    parts = value(spark, text.phrases(F.lit("The battery life is bad, the Battery life and the screen.")))
    assert parts == ["battery life", "bad", "battery life", "screen"]
    assert value(spark, text.dominant(text.phrases(F.lit("the screen of the phone and the phone")))) == "phone"
    assert value(spark, text.dominant(F.array(F.lit("b"), F.lit("a"), F.lit("a"), F.lit("b")))) == "b"
    assert value(spark, text.dominant(F.array().cast("array<string>"))) is None


def test_aspect_map(spark):
    content = "Great battery life. The battery life is bad! #Screen is awful. A battery life"
    row = one(texts.enrich_aspects(posts(spark, content)))
    assert row.aspect_sentiments["battery life"] == pytest.approx((1 - 1 + 0) / 3)
    assert row.dominant_aspect == "battery life"
    assert row.aspect_sentiments["screen"] == -1.0
    assert row.aspect_sentiments["great battery life"] == 1.0


def test_joined_aspects_equal_row_wise_ones(spark, sf):
    from tagtide.sources import fixtures

    some = fixtures.text_posts(spark, sf)
    row_wise = texts.aspect_sentiments(some).select("post_id", "aspect", F.col("sentiment").cast("double"))
    joined = texts.aspect_sentiments_of(some, texts.phrase_candidates(some)).select(
        "post_id", "aspect", F.col("sentiment").cast("float").cast("double")
    )
    assert row_wise.exceptAll(joined).isEmpty()
    assert joined.exceptAll(row_wise).isEmpty()


def test_as_map(spark):
    rows = spark.createDataFrame([(1, "b", 0.5), (1, "a", -1.0), (2, "a", 0.0)], "post_id int, aspect string, sentiment double")
    assert {r.post_id: r.aspect_sentiments for r in texts.as_map(rows).collect()} == {1: {"a": -1.0, "b": 0.5}, 2: {"a": 0.0}}


def test_lexicon_rule(spark):
    lexicon = spark.createDataFrame(
        [("good", 0.6, 0.5, 1.0), ("very", 0.0, 0.0, 1.5), ("bad", -0.8, 0.9, 1.0)],
        "word string, polarity double, subjectivity double, intensity double",
    )
    some = posts(spark, "not good", "very good", "good. Bad", "nothing here", None)
    got = {r.post_id: (round(r.polarity, 6), round(r.subjectivity, 6)) for r in texts.lexicon_sentiment(some, lexicon).collect()}
    assert got == {0: (-0.3, 0.5), 1: (0.9, 0.5), 2: (-0.1, 0.7), 3: (0.0, 0.0), 4: (0.0, 0.0)}


def test_rich_analysis(spark):
    gazetteer = spark.createDataFrame([("ada stone", "PERSON"), ("zpad 15", "PRODUCT"), ("lumen", "ORG")], "surface string, type string")
    some = posts(spark, POST)
    analysis = texts.rich_analysis(some, gazetteer)
    row = one(analysis)
    # "Lumen's" is a word of its own; "lumen" is first met in the tag at the end.
    kinds = [(a.aspect, a.aspect_type) for a in row.aspect_sentiments if a.aspect_type != "TOPIC"]
    assert kinds == [("zpad 15", "PRODUCT"), ("ada stone", "PERSON"), ("lumen", "ORG")]
    assert row.aspect_sentiments[0].sentiment == 1.0
    assert row.aspect_sentiments[0].context.strip().startswith("We all love")
    assert row.dominant_aspects[0].aspect == "zpad 15" and len(row.dominant_aspects) == 3
    assert row.sentiment_summary == "Positive tone; Most pronounced towards 'zpad 15' (1.00)"
    assert set(row.hashtag_context) == {"Lumen", "GadgetTalk"}
    assert "lumen" in row.hashtag_context["Lumen"].related_aspects
    stored = one(texts.rich_struct(some, analysis))
    assert (stored.top_aspect, stored.top_aspect_sentiment, stored.overall_sentiment) == ("zpad 15", 1.0, 1.0)
    assert one(texts.rich_struct(posts(spark, ""), texts.rich_analysis(posts(spark, "")))).sentiment_summary == "No content"


def test_first_entity_wins_over_phrase(spark):
    gazetteer = spark.createDataFrame([("new york", "GPE"), ("new york city", "GPE"), ("expo", "EVENT")], "surface string, type string")
    some = posts(spark, "The expo opens in New York City today", "a quiet morning walk", "of the")
    got = {r.post_id: (r.aspect, r.type) for r in texts.entity_aspects(some, gazetteer).collect()}
    assert got == {0: ("new york city", "GPE"), 1: ("quiet morning walk", "TOPIC"), 2: (None, None)}


@pytest.mark.parametrize("run", [1, 3, 8])
def test_positions_of_needles(spark, monkeypatch, run):
    from tagtide.operators import matching

    monkeypatch.setattr(matching, "RUN", run)
    rng = random.Random(4)
    needles = ["ab", "b a", "#a", "abab", "zz", "ab", ""]
    texts_ = [["".join(rng.choice("ab #") for _ in range(30)) for _ in range(n)] for n in (0, 1, 2, 7, 8, 9, 40, 130)]
    rows = [(i, [(t,) for t in ts], needles) for i, ts in enumerate(texts_)]
    frame = spark.createDataFrame(rows, "id int, sentences array<struct<low: string>>, needles array<string>")
    got = {r.id: r.hits for r in matching.with_hits(frame, "needles").collect()}
    assert got == {i: [[k for k, t in enumerate(ts) if n in t] for n in needles] for i, ts in enumerate(texts_)}


def test_needles_of_a_long_text(spark):
    """Half of 120,000 words begin a phrase: comparing each phrase with the whole text takes minutes."""
    import time

    from tagtide.operators import matching

    sentences = [f"a{i:x} b{i % 7:x} c{i:x}. the".encode() for i in range(30_000)]
    needles = [f"a{i:x} b{i % 7:x} c{i:x}".encode() for i in range(30_000)] + [f"b{i % 7:x} c{i:x}".encode() for i in range(30_000)]
    begin = time.monotonic()
    found = matching._looked_up(sentences, needles)
    assert time.monotonic() - begin < 60
    assert all(i in found[i] and i in found[30_000 + i] for i in range(30_000))
    assert found[7] == [i for i, s in enumerate(sentences) if b"a7 b0 c7" in s]


def test_small_lexicon_is_looked_up_without_a_row_per_word(spark, monkeypatch):
    lexicon = spark.createDataFrame(
        [("Good", 0.6, 0.5, 1.0), ("very", 0.0, 0.0, 1.5), ("odd", None, 0.5, 1.0), ("cold", -0.4, None, None), ("not", 0.2, 0.1, 2.0),
         ("!", 0.3, 0.3, 3.0), (None, 0.9, 0.9, 0.9), ("good", 0.2, 0.1, 1.0), ("none", float("nan"), 0.5, 1.0)],
        "word string, polarity double, subjectivity double, intensity double",
    )
    some = posts(spark, "not good", "Very good. cold", "odd very cold", "cold", "none not not good", "nothing here", "", None)
    some = some.unionByName(some.limit(2)).unionByName(some.limit(3).withColumn("post_id", F.lit(None).cast("int")))
    small = texts.lexicon_sentiment(some, lexicon)
    assert "Generate" not in small._jdf.queryExecution().executedPlan().toString()

    def listed(df):
        return sorted(((r.post_id or -1, round(r.polarity, 9), round(r.subjectivity, 9)) for r in df.collect()), key=str)

    got = listed(small)
    monkeypatch.setattr(texts, "is_small", lambda *a: False)
    assert got == listed(texts.lexicon_sentiment(some, lexicon))
