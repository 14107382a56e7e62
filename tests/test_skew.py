"""Joins with a key that holds most of the rows."""

import pytest
from pyspark.sql import functions as F

from tagtide.operators.skew import count_by, hot_keys, is_small, lookup, spread_join


@pytest.fixture(scope="module")
def many(spark):
    hot = F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 7).cast("string")))
    return spark.range(900).select(hot.alias("k"), F.col("id").alias("n"))


@pytest.fixture(scope="module")
def few(spark):
    return spark.createDataFrame([("hot", 1), ("k0", 2), ("k1", 3), ("none", 4)], "k string, v int")


def same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_hot_keys(many):
    hot = {r.k: r.blocks for r in hot_keys(count_by(many, ["k"]), ["k"], "rows", 100).collect()}
    assert hot == {"hot": 6}


def test_spread_join_is_the_join(many, few):
    assert same(spread_join(few, many, ["k"], ["n"], block_rows=50), few.join(many, "k"))


def test_spread_join_with_condition(many, few):
    got = spread_join(few, many, ["k"], ["n"], F.col("n") % 5 == F.col("v"), block_rows=50)
    assert same(got, few.join(many, "k").filter("n % 5 = v"))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_lookup_beyond_broadcast(many, few, how, monkeypatch):
    from tagtide.operators import skew

    monkeypatch.setattr(skew.hot_keys, "__defaults__", (50,))
    assert same(lookup(many, few, "k", ["n"], False, how), many.join(few, "k", how))
    assert same(lookup(many, few, "k", ["n"], True, how), many.join(few, "k", how))


def test_size_check(few):
    assert is_small(few, "k")
    assert not is_small(few, "k", rows=3)
    assert not is_small(few, "k", size=5)


def test_lexicon_beyond_broadcast(spark, sf, monkeypatch):
    from tagtide.operators import texts
    from tagtide.sources import fixtures

    posts, lexicon = fixtures.text_posts(spark, sf), fixtures.lexicon(spark, sf)
    small = texts.lexicon_sentiment(posts, lexicon).select("post_id", F.round("polarity", 9).alias("p"))
    monkeypatch.setattr(texts, "is_small", lambda *a: False)
    large = texts.lexicon_sentiment(posts, lexicon).select("post_id", F.round("polarity", 9).alias("p"))
    assert same(small, large)
