"""The trie of surfaces against a plain search, and the keys of messages without one."""

import random
import time

import pytest
from pyspark.sql import functions as F

from tagtide.functions.text import tokens
from tagtide.operators import texts
from tagtide.operators.trie import longest_runs, nodes

NOW = "2024-01-01 00:00:00"


def plain(words, surfaces):
    out = []
    for pos in range(len(words)):
        found = [n for n in range(1, len(words) - pos + 1) if " ".join(words[pos : pos + n]) in surfaces]
        if found:
            surface = " ".join(words[pos : pos + found[-1]])
            out.append((pos + 1, surface, surfaces[surface]))
    return out


@pytest.mark.parametrize("levels,threshold", [(1, "10m"), (2, "10m"), (4, "10m"), (3, "-1")])
def test_longest_surfaces(spark, levels, threshold):
    rnd = random.Random(levels)
    run = lambda lo, hi: " ".join(rnd.choice("abc") for _ in range(rnd.randint(lo, hi)))
    surfaces = {run(1, 9): rnd.choice(["ORG", "GPE"]) for _ in range(60)}
    surfaces["a b c a b c a b c a b c"] = "LONG"
    contents = [run(0, 60) for _ in range(40)] + ["a b c " * 30, "", "x y z"]
    known = spark.createDataFrame(list(surfaces.items()), "surface string, type string")
    frame = spark.createDataFrame(list(enumerate(contents)), "post_id int, content string")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        got = longest_runs(frame, ["post_id"], F.filter(F.split("content", " "), lambda w: w != ""), known, levels).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    expected = [(i, *e) for i, c in enumerate(contents) for e in plain(c.split(), surfaces)]
    assert sorted(tuple(r) for r in got) == sorted(expected) and len(expected) > 300


def test_an_empty_trie(spark):
    none = spark.createDataFrame([], "surface string, type string")
    frame = spark.createDataFrame([(1, "a b")], "post_id int, content string")
    assert longest_runs(frame, ["post_id"], F.split("content", " "), none).collect() == []


def test_nodes(spark):
    rows = [("a", "X"), ("a b c", "Y"), ("a b d e", "Z")]
    got = {r.node: (r.type, r.goes_on, len(r.longer)) for r in nodes(spark.createDataFrame(rows, "surface string, type string"), 3).collect()}
    assert got == {"a": ("X", True, 0), "a b": (None, True, 0), "a b c": ("Y", False, 0), "a b d": (None, False, 1)}


def test_nothing_runs_while_the_plan_is_built(spark):
    places = spark.createDataFrame([("new york", "GPE")], "surface string, type string")
    some = spark.createDataFrame([(1, "In New York")], "post_id int, content string")
    spark.sparkContext.setJobGroup("building", "")
    try:
        rows = texts.entity_rows(some, places)
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("building")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert [tuple(r) for r in rows.collect()] == [(1, 2, "new york", "GPE")]


def test_rows_follow_matches(spark):
    """Joins of later levels see only the words that the first level let through."""
    places = spark.createDataFrame([("new york city", "GPE")], "surface string, type string")
    some = spark.range(2_000).selectExpr("id AS post_id", "'some words that begin nothing' AS content")
    found = longest_runs(some, ["post_id"], tokens(F.col("content")), places)
    assert found.collect() == []
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("BroadcastHashJoin") >= 4 and "SortMergeJoin" not in plan


@pytest.fixture(scope="module")
def tables(spark):
    lexicon = spark.createDataFrame([("good", 0.5, 0.5, 1.0), ("bad", -0.5, 0.5, 1.0)], "word string, polarity double, subjectivity double, intensity double")
    return lexicon, spark.createDataFrame([("new york", "GPE")], "surface string, type string")


def test_messages_keep_every_row(spark, tables):
    lexicon, places = tables
    rows = [("u1", "good New York. bad", ["a"]), ("u2", "good New York. bad", ["b"]), ("u3", None, None), ("u4", "", []), ("u3", None, None)]
    frame = spark.createDataFrame(rows, "user_name string, content string, hashtags array<string>")
    for job in (
        lambda: texts.enrich_basic(frame, now=NOW, lexicon=lexicon),
        lambda: texts.enrich_aspects(frame, now=NOW, lexicon=lexicon),
        lambda: texts.enrich_struct(frame, now=NOW, lexicon=lexicon, gazetteer=places),
    ):
        got = job()
        assert got.columns[:3] == frame.columns and "_key" not in got.columns and "post_id" not in got.columns
        assert sorted(r.user_name for r in got.collect()) == ["u1", "u2", "u3", "u3", "u4"]
    top = {r.user_name: r.top_aspect for r in got.collect()}
    assert top["u1"] == top["u2"] == "new york" and top["u3"] is None


def test_a_message_of_64000_words(spark, tables):
    lexicon, places = tables
    rnd = random.Random(1)
    words = ["good", "bad", "New", "York", "day", "walk", "street.", "river", "the", "of"]
    long = " ".join(rnd.choice(words) for _ in range(64_000))
    frame = spark.createDataFrame([("u", long, ["a"]), ("v", "good day", ["b"])], "user_name string, content string, hashtags array<string>")
    start = time.perf_counter()
    rows = {r.user_name: r for r in texts.enrich_struct(frame, now=NOW, lexicon=lexicon, gazetteer=places).collect()}
    assert rows["u"].top_aspect == "new york" and rows["v"].overall_sentiment == 0.5
    # With the text as key of its words this ran out of memory.
    assert time.perf_counter() - start < 120
