"""Quality classifier by positive-unlabelled learning.

Trusted documents are the positives, a sample of all web text is unlabelled, and the share of
good documents in it is estimated. The unbiased risk of positive-unlabelled data is
``prior * R_p(+) + R_u(-) - prior * R_p(-)``; its second half estimates the risk on bad
documents and cannot be negative, so it is held at zero and pushed back up where a flexible
model drives it below (Kiryo et al. 2017). Only text goes into a score: shapes of words,
shares of kinds of characters, repetition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagtide.llm.common import PIECE_BYTES, WordHasher, mix64, pieces, table, trimmed, utf8

#: The model is fitted on at most so many documents; scores are made for all.
MAX_POSITIVE, MAX_UNLABELLED, THRESHOLD = 5_000, 10_000, 0.7


class Features:
    """Fixed-length description of each text of a batch."""

    def __init__(self) -> None:
        self.hasher = WordHasher(lower=True)
        kind = np.full(256, 8, np.uint8)
        kind[65:91], kind[97:123], kind[128:], kind[48:58] = 0, 1, 2, 3
        kind[[9, 11, 12, 13, 32]], kind[10] = 4, 5
        kind[[ord(c) for c in ".,;:'\"-()"]], kind[[ord("!"), ord("?")]] = 6, 7
        self.kind = kind

    def of(self, texts: pa.Array) -> np.ndarray:
        data, at = utf8(texts)
        n = len(at) - 1
        size = np.diff(at).astype(float)
        owner = np.repeat(np.arange(n), np.diff(at))
        kinds = np.bincount(owner * 9 + self.kind[data], minlength=9 * n).reshape(n, 9)
        share = kinds / np.maximum(size, 1)[:, None]
        hashes, start, end, counts = self.hasher.words(data, at)
        words = np.maximum(counts, 1).astype(float)
        doc = np.repeat(np.arange(n), counts)
        length = (end - start).astype(float)
        mean = np.bincount(doc, length, n) / words
        spread = np.sqrt(np.maximum(np.bincount(doc, length**2, n) / words - mean**2, 0))
        longest = np.bincount(doc, length > 20, n) / words
        marks = np.cumsum(np.r_[0, self.kind[data] >= 7])
        marked = np.bincount(doc, marks[end] > marks[start], n) / words
        caps = np.cumsum(np.r_[0, self.kind[data] == 0])
        shouted = np.bincount(doc, caps[end] - caps[start] > 1, n) / words
        stops = np.bincount(doc, self.kind[data[end - 1]] == 6, n) / words
        same = np.r_[False, (hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1])][: len(hashes)]
        stutter = np.bincount(doc, same, n) / words
        distinct, top = self._variety(hashes, doc, n)
        pairs = mix64(hashes[1:] * np.uint64(3) + hashes[:-1])[doc[1:] == doc[:-1]] if len(hashes) else hashes
        pair_doc = doc[1:][doc[1:] == doc[:-1]] if len(hashes) else doc
        pair_distinct, _ = self._variety(pairs, pair_doc, n)
        log_words = np.log1p(counts)
        return np.column_stack(
            [
                share,
                log_words,
                np.log1p(mean),
                np.log1p(spread),
                longest,
                marked,
                shouted,
                stops,
                stutter,
                distinct / words,
                np.log1p(distinct) / np.maximum(log_words, 0.5),
                top / words,
                pair_distinct / np.maximum(words - 1, 1),
                counts == 0,
                np.log1p(kinds[:, 6] + kinds[:, 7]) - log_words,
            ]
        )

    @staticmethod
    def _variety(values: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Distinct values of each text, and how often its most frequent one occurs."""
        if not len(values):
            return np.zeros(n), np.zeros(n)
        _, index, times = np.unique(mix64(values + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True, return_counts=True)
        owner = doc[index]
        order = np.argsort(owner, kind="stable")
        owner, times = owner[order], times[order]
        first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        top = np.zeros(n)
        top[owner[first]] = np.maximum.reduceat(times, first)
        return np.bincount(owner, minlength=n).astype(float), top


def described(texts: Iterator[pa.Array]) -> Iterator[np.ndarray]:
    """Features of every batch of texts, worked out in pieces of bounded size."""
    features = Features()
    for batch in texts:
        _, at = utf8(batch)
        rows, start = [np.zeros((0, 23))], 0
        while start < len(batch):
            end = max(start + 1, int(np.searchsorted(at, at[start] + PIECE_BYTES, "right")) - 1)
            rows.append(features.of(batch.slice(start, end - start)))
            start = end
        yield np.vstack(rows)


class Model:
    """A network with one hidden layer on standardised features."""

    def __init__(self, mean, scale, weights) -> None:
        self.mean, self.scale, self.weights = mean, scale, weights

    def _hidden(self, x: np.ndarray) -> np.ndarray:
        w1, b1, _, _, _ = self.weights
        return np.tanh(x @ w1 + b1)

    def margin(self, x: np.ndarray) -> np.ndarray:
        _, _, w2, b2, w0 = self.weights
        return self._hidden(x) @ w2 + x @ w0 + b2[0]

    def standard(self, rows: np.ndarray) -> np.ndarray:
        return np.clip((rows - self.mean) / self.scale, -6, 6)

    def score(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(self.standard(rows)), -40, 40)))

    def gradient(self, x: np.ndarray, slope: np.ndarray) -> list[np.ndarray]:
        """Gradient of sum(slope * margin)."""
        _, _, w2, _, _ = self.weights
        hidden = self._hidden(x)
        back = slope[:, None] * w2 * (1 - hidden**2)
        return [x.T @ back, back.sum(0), hidden.T @ slope, np.array([slope.sum()]), x.T @ slope]


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, hidden: int = 16, steps: int = 400, seed: int = 7) -> Model:
    """Minimise the non-negative unbiased risk with the logistic loss (Adam, small weight decay)."""
    both = np.vstack([positive, unlabelled])
    scale = both.std(0)
    rng, d = np.random.default_rng(seed), both.shape[1]
    weights = [rng.normal(0, 0.3 / np.sqrt(d), (d, hidden)), np.zeros(hidden), rng.normal(0, 0.3, hidden), np.zeros(1), np.zeros(d)]
    model = Model(both.mean(0), np.where(scale > 1e-9, scale, 1.0), weights)
    p, u = model.standard(positive), model.standard(unlabelled)
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for step in range(1, steps + 1):
        sp, su = 1 / (1 + np.exp(-model.margin(p))), 1 / (1 + np.exp(-model.margin(u)))
        # d/dz log(1 + e^-z) = s - 1 for the positive class, d/dz log(1 + e^z) = s for the negative one.
        lose_u, lose_p = -np.log1p(-np.minimum(su, 1 - 1e-12)).mean(), -np.log1p(-np.minimum(sp, 1 - 1e-12)).mean()
        good = model.gradient(p, prior * (sp - 1) / len(p))
        bad = [a - b for a, b in zip(model.gradient(u, su / len(u)), model.gradient(p, prior * sp / len(p)))]
        below = lose_u - prior * lose_p < 0
        grads = [-b if below else a + b for a, b in zip(good, bad)]
        for i, g in enumerate(grads):
            g = g + 1e-4 * weights[i]
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.999 * second[i] + 0.001 * g**2
            rate = 0.02 * min(1.0, 2 * (1 - step / (steps + 1)))
            weights[i] -= rate * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    return model


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives among the unlabelled: the least ratio of how often both score high.

    A first model tells positives from unlabelled rows. For any cut, unlabelled rows above it
    are at least ``prior`` times as frequent as positives above it, with equality where no
    negative scores that high, so the smallest ratio over the cuts is the estimate. The model
    is fitted on every other row and asked about the rest.
    """
    model = fit(positive[::2], unlabelled[::2], 0.5, hidden=4, steps=150)
    p, u = np.sort(model.score(positive[1::2])), np.sort(model.score(unlabelled[1::2]))
    cuts = np.quantile(p, np.linspace(0.02, 0.6, 30))
    above_p = 1 - np.searchsorted(p, cuts, "left") / len(p)
    above_u = 1 - np.searchsorted(u, cuts, "left") / len(u)
    return float(np.clip(np.min(above_u / np.maximum(above_p, 1e-9)), 0.05, 0.99))


def held_out(doc_id: Column, folds: int = 4, fold: int = 2) -> Column:
    """True for the rows whose labels are never learned from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == fold


def train(docs: DataFrame, labels: DataFrame) -> Model | None:
    """The model from bounded samples of trusted and of unlabelled documents; None without positives.

    Samples are taken by the MD5 of the id, at most MAX_POSITIVE and MAX_UNLABELLED. A document is
    trusted if all its labels are 1. The class prior is the share of such documents among the
    labelled rows; where none is labelled bad, it is estimated from the two samples.
    """
    learn = labels.filter(~held_out(F.col("doc_id")) & F.col("quality").isNotNull())
    marked = learn.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    good, known = marked.agg(F.sum("quality"), F.count(F.lit(1))).first()
    if not good:
        return None
    by_hash = F.md5(F.concat(F.lit("pu:"), F.col("doc_id").cast("string")))
    trusted = marked.filter("quality = 1").orderBy(by_hash, "doc_id").limit(MAX_POSITIVE)
    web = docs.filter(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    web = web.orderBy(by_hash, "doc_id").limit(MAX_UNLABELLED)
    ids = trusted.select("doc_id", F.lit(1).alias("role")).union(web.select("doc_id", F.lit(0).alias("role")))
    # The two samples are bounded, so their ids may be broadcast. A repeated id counts once.
    texts = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
    rows = texts.groupBy("doc_id", "role").agg(F.min("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in pieces(batches, "text"):
            values = features.of(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("role"), pa.array(values.tolist(), pa.list_(pa.float64()))],
                ["doc_id", "role", "features"],
            )

    found = rows.mapInArrow(trimmed(run), "doc_id long, role int, features array<double>").toArrow()
    order = np.lexsort([found["doc_id"].to_numpy(), found["role"].to_numpy()])
    x = np.array(found["features"].to_pylist(), dtype=float).reshape(-1, 23)[order]
    role = found["role"].to_numpy()[order]
    positive, unlabelled = x[role == 1], x[role == 0]
    if not len(positive) or not len(unlabelled):
        return None
    prior = good / known if good < known else estimate_prior(positive, unlabelled)
    return fit(positive, unlabelled, min(max(prior, 0.05), 0.99))


def score_column(model: Model | None, text: Column) -> Column:
    """Score from 0 to 1 of a text column; null is the empty text. Without a model every score is 0.5."""
    if model is None:
        return F.lit(0.5)

    @F.arrow_udf("double")
    def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for rows in described(texts):
            yield pa.array(model.score(rows))

    return score(text)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``."""
    model = train(docs.select("doc_id", "text"), labels.select("doc_id", "quality"))
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score_column(model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, with their columns; all of them if nothing can be learned."""
    model = train(docs.select("doc_id", "text"), labels.select("doc_id", "quality"))
    if model is None:
        return docs
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), docs["text"].alias("text"))
    return rows.filter(score_column(model, F.col("text")) >= THRESHOLD).select("row.*")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
