"""Sentiment scores, their labels, and the sentences that report them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from tagtide.functions.arrays import let
from tagtide.functions.numbers import fixed_point
from tagtide.functions.text import MIN_CONTENT_LENGTH

# The word lists of the simple scorer.
POSITIVE_WORDS = ("love", "great", "awesome", "excellent", "amazing", "wonderful", "fantastic")
NEGATIVE_WORDS = ("hate", "terrible", "awful", "bad", "horrible", "worst", "sucks")

# Thresholds of the labels.
STRONG, MILD, TONE = 0.5, 0.1, 0.3

# The texts of results.
NO_CONTENT, TOO_SHORT, NO_FOCUS = "No content", "Content too short", " tone overall"
FOCUS, PRONOUNCED = " tone; focused on '", " tone; Most pronounced towards '"
RATE, AVERAGE = "Unusual posting rate: ", " posts (avg: "


def score_simple(
    text: Column,
    pos: Sequence[str] = POSITIVE_WORDS,
    neg: Sequence[str] = NEGATIVE_WORDS,
) -> Column:
    """``(p - n) / (p + n)`` over the listed words found in the text, else 0.

    A word counts once and anywhere inside another word: "badge" holds "bad".
    """
    p, n = word_hits(F.lower(F.coalesce(text, F.lit(""))), pos, neg)
    return balance(p, n)


def word_hits(low: Column, pos: Sequence[str] = POSITIVE_WORDS, neg: Sequence[str] = NEGATIVE_WORDS) -> tuple[Column, Column]:
    """How many of the listed words a text in lower case contains."""

    def hits(words: Sequence[str]) -> Column:
        return reduce(add, [F.contains(low, F.lit(w)).cast("int") for w in words])

    return hits(pos), hits(neg)


def balance(p: Column, n: Column) -> Column:
    """``(p - n) / (p + n)``, 0 if both are 0."""
    return F.coalesce(F.try_divide(p - n, p + n), F.lit(0.0))


def sentiment_category5(score: Column) -> Column:
    """Five labels. Compared as double: a 32-bit 0.1 is above 0.1."""
    s = score.cast("double")
    return (
        F.when(s > STRONG, "very_positive")
        .when(s > MILD, "positive")
        .when(s < -STRONG, "very_negative")
        .when(s < -MILD, "negative")
        .otherwise("neutral")
    )


def sentiment_category3(score: Column) -> Column:
    """Three labels; NULL is neutral."""
    s = score.cast("double")
    return F.when(s > MILD, "positive").when(s < -MILD, "negative").otherwise("neutral")


def tone(score: Column) -> Column:
    """Positive, Negative or Neutral."""
    s = score.cast("double")
    return F.when(s > TONE, "Positive").when(s < -TONE, "Negative").otherwise("Neutral")


def _summary(score: Column, lead: str, aspect: Column, aspect_score: Column) -> Column:
    detail = F.concat(
        F.lit(lead), aspect, F.lit("' ("), fixed_point(aspect_score, 2), F.lit(")")
    )
    return F.concat(tone(score), F.coalesce(detail, F.lit(NO_FOCUS)))


def summary_pronounced(score: Column, aspect: Column, aspect_score: Column) -> Column:
    """The tone, and the aspect with the strongest sentiment."""
    return _summary(score, PRONOUNCED, aspect, aspect_score)


def summary_text(
    content: Column, clean: Column, score: Column, aspect: Column, aspect_score: Column
) -> Column:
    """The tone and the aspect in focus, or why there is none."""
    return (
        F.when(F.coalesce(content, F.lit("")) == "", NO_CONTENT)
        .when(F.length(clean) < MIN_CONTENT_LENGTH, TOO_SHORT)
        .otherwise(_summary(score, FOCUS, aspect, aspect_score))
    )


def reason_text(recent: Column, average: Column) -> Column:
    """Why a posting rate was flagged."""
    return F.concat(
        F.lit(RATE),
        recent.cast("string"),
        F.lit(AVERAGE),
        fixed_point(average, 1),
        F.lit(")"),
    )


def scored_sentences(sentences: Column, scorer=score_simple) -> Column:
    """``array<struct<text, low, score>>`` for an array of sentences."""

    def rate(low: Column) -> Column:
        if scorer is not score_simple:
            return scorer(low)
        # Inside a lambda Spark does not share equal parts of an expression.
        p, n = word_hits(low)
        return let(F.struct(p.alias("p"), n.alias("n")), lambda x: balance(x["p"], x["n"]))

    return F.transform(
        sentences,
        lambda s: let(
            F.struct(s.alias("text"), F.lower(s).alias("low")),
            lambda x: F.struct(x["text"].alias("text"), x["low"].alias("low"), rate(x["low"]).alias("score")),
        ),
    )


def mean_score(sentences: Column, hits: Column) -> Column:
    """Mean score of the sentences with the given positions; NULL if there is none."""
    zero = F.struct(F.lit(0.0).alias("total"), F.lit(0).alias("n"))
    return F.aggregate(
        hits,
        zero,
        lambda acc, i: F.struct(
            (acc["total"] + F.get(sentences, i)["score"]).alias("total"), (acc["n"] + 1).alias("n")
        ),
        lambda acc: F.try_divide(acc["total"], acc["n"]),
    )


def positions(sentences: Column, needle: Column) -> Column:
    """Positions of the scored sentences that contain ``needle``."""
    found = F.transform(sentences, lambda s, i: F.when(F.contains(s["low"], needle), i))
    return F.filter(found, lambda i: i.isNotNull())
