import random
import zlib

import numpy as np
import pyarrow as pa
from helpers import SCHEMA, documents, sentence, texts

from tagtide.llm.quality import Features, accepted, classify, estimate_prior, fit


def junk(seed: int) -> str:
    rnd = random.Random(seed)
    return " ".join(rnd.choice(("BUY", "NOW!!!", "$$$", "WIN!!")) for _ in range(40 + seed % 30))


def corpus(n: int = 400):
    rows = [(i, junk(i) if i % 5 == 0 else sentence(i, 40 + i % 60)) for i in range(n)]
    labels = [(i, 0 if i % 5 == 0 else 1, 0) for i in range(0, n, 2)]
    return rows, labels


def test_risk_separates_two_clouds():
    rng = np.random.default_rng(0)
    good, bad = rng.normal(1.5, 1, (1500, 3)), rng.normal(-1.5, 1, (500, 3))
    unlabelled = np.vstack([good[500:], bad])
    prior = estimate_prior(good[:500], unlabelled)
    assert abs(prior - 2 / 3) < 0.12
    model = fit(good[:500], unlabelled, prior)
    assert (model.score(good) > 0.5).mean() > 0.95 and (model.score(bad) < 0.5).mean() > 0.9


def test_features_of_a_text_do_not_depend_on_its_neighbours():
    values = [t for _, t in texts()]
    features = Features()
    together = features.of(pa.array(values, pa.string()))
    alone = np.vstack([features.of(pa.array([v], pa.string())) for v in values])
    assert np.allclose(together, alone) and np.isfinite(together).all()


def test_held_out_accuracy(spark):
    rows, labels = corpus()
    marks = spark.createDataFrame([*labels, (None, 1, 0), (7, None, None), (3, 1, None), (3, 1, 0)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in classify(documents(spark, rows), marks).collect()}
    assert len(got) == len(rows)
    held = [r for r in got.values() if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got.values())
    assert np.mean([r.predicted == (r.doc_id % 5 != 0) for r in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got.values())


def test_awkward_rows_and_columns(spark):
    rows, labels = corpus(200)
    rows += [(1000 + (i or 0), t) for i, t in texts()] + [(None, None), (None, "Some text.")]
    docs = documents(spark, rows)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert classify(docs, marks).count() == len(rows)
    kept = accepted(docs, marks)
    assert kept.columns == docs.columns
    ids = {r["doc_id"] for r in kept.collect()}
    assert sum(i % 5 != 0 for i in ids if i is not None and i < 200) > 150


def test_nothing_to_learn_from(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = documents(spark, [(1, "a b"), (2, None)])
    assert {(r.score, r.predicted) for r in classify(docs, none).collect()} == {(0.5, 0)}
    assert accepted(docs, none).count() == 2
    assert classify(spark.createDataFrame([], SCHEMA), none).collect() == []
