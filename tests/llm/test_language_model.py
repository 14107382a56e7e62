import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from helpers import SCHEMA, documents, texts, words
from pyspark.sql import functions as F

from tagtide.llm import language_model
from tagtide.llm.language_model import (
    MU,
    POWER,
    RARE_MU,
    SEGMENT_BITS,
    PairFilter,
    Tokens,
    filter_segments,
    held_out,
    level_of,
    level_value,
    packed,
    score,
    train,
    unpacked,
)

BEGIN, END = "<begin>", None


def test_filter_returns_the_level_of_every_pair():
    keys = np.arange(5_000, dtype=np.uint64) * np.uint64(77)
    counts = np.random.default_rng(0).integers(1, 3_000, len(keys))
    batch = pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts)], ["key", "c"])
    bits = 8 * SEGMENT_BITS
    data = np.zeros(bits // 8, np.uint8)
    for out in filter_segments(bits, 1.0)(iter([batch])):
        for segment, part in zip(out["segment"].to_pylist(), out["data"].to_pylist()):
            data[segment * SEGMENT_BITS // 8 :][: SEGMENT_BITS // 8] |= np.frombuffer(part, np.uint8)
    found = PairFilter(data, 1.0)
    expected = level_value(level_of(counts, 1.0), 1.0)
    got = found.count(keys)
    assert (got >= expected).all() and (got == expected).mean() > 0.98
    assert (found.count(np.arange(10**6, 10**6 + 5000, dtype=np.uint64) * np.uint64(31)) > 0).mean() < 0.05
    assert (expected <= 2 * counts).all() and (expected >= counts / 2).all()


def test_counts_and_base_score(spark):
    rows = texts()
    tokens = [(i, [*words(t, lower=True), None]) for i, t in rows]
    test = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    count = Counter(w for i, ws in tokens if not test(i) for w in ws)
    total, distinct = sum(count.values()), len(count)
    # A share that leaves most words to the shuffle, and one that leaves none.
    for share in (0.01, 1e-6):
        got = score(documents(spark), ~held_out(F.col("doc_id")), share).collect()
        base = lambda ws: sum(math.log10((count[w] + 1) / (total + distinct + 1)) for w in ws)
        want = Counter((i, test(i), len(ws), sum(count[w] > 0 for w in ws), total, round(base(ws), 6)) for i, ws in tokens)
        have = Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got)
        assert have == want
        learned = [r for r in got if not r.held_out]
        gain = sum(r.score - r.base_score for r in learned)
        assert gain > 0


def quantised(count, least):
    if least > 1 and count >= least:
        return float(level_value(level_of(np.array([count]), least), least)[0])
    return float(level_value(level_of(np.array([count]), 1.0), 1.0)[0]) if count else 0.0


@pytest.mark.parametrize("share,part_rows,pack_rows", [(0.01, 200, 300), (0.001, 2_000_000, 1_000_000), (1e-6, 500, 100)])
def test_score_equals_a_plain_model(spark, monkeypatch, share, part_rows, pack_rows):
    """Word by word, whichever pairs are broadcast and however the others are cut."""
    monkeypatch.setattr(language_model, "PART_ROWS", part_rows)
    monkeypatch.setattr(language_model, "PACK_ROWS", pack_rows)
    monkeypatch.setattr(language_model, "ENTRY_BITS", 64)  # false positives are told apart below
    rows = texts()
    test = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    tokens = [(i, [*words(t, lower=True), END]) for i, t in rows]
    learned = [ws for i, ws in tokens if not test(i)]
    count, pairs = Counter(w for ws in learned for w in ws), Counter(p for ws in learned for p in zip([BEGIN, *ws], ws))
    total, distinct = sum(count.values()), len(count)
    least = max(1.0, share * total)
    frequent = {w for w, c in count.items() if c >= least} | {END, BEGIN}
    count[BEGIN] = len(learned)

    def logarithm(v, w):
        weight = MU * max(count[v], 1) ** POWER if v in frequent else RARE_MU
        hot = v in frequent and w in frequent and pairs[v, w] >= least
        q = quantised(pairs[v, w], least if hot else 1.0)
        return math.log10((q + weight * (count[w] + 1) / (total + distinct + 1)) / (count[v] + weight))

    got = {(r.doc_id, r.n_tokens, round(r.base_score, 6)): r.score for r in score(documents(spark), ~held_out(F.col("doc_id")), share).collect()}
    for i, ws in tokens:
        base = sum(math.log10((count[w] + 1) / (total + distinct + 1)) for w in ws)
        expected = sum(logarithm(v, w) for v, w in zip([BEGIN, *ws], ws))
        assert got[i, len(ws), round(base, 6)] == pytest.approx(expected, abs=1e-6)


def test_probabilities_after_a_word_sum_to_one(spark):
    rows = [(i, t) for i, t in texts() if i is not None and i >= 100]
    model = train(documents(spark, rows), 1e-9)
    tokens = Tokens()
    token, before, _ = tokens.of(pa.array([t for _, t in rows]))
    vocabulary = np.unique(token)
    known = model.known
    for context in np.unique(before)[:20]:
        _, number, _, _, after = model.terms(vocabulary, np.full(len(vocabulary), context))
        counts = model.frequent(known.index(vocabulary), number)
        c = known.counts[number[0]] if number[0] < len(known.counts) else known.texts
        # Only the middles of the levels are off the counts.
        off = (counts.sum() - c) / (c + known.weight[number[0]])
        unseen = 10 ** known.factor[number[0]] / known.scale
        assert abs((10**after).sum() + unseen - 1 - off) < 1e-9


def test_more_text_helps(spark):
    """Held-out gain per token over the word probabilities does not fall with ten times the training text."""
    rnd = random.Random(3)
    lexicon = [f"w{i}" for i in range(3000)]

    def text():
        at, out = rnd.randrange(3000), []
        for _ in range(60):
            out.append(lexicon[at])
            at = (at * 7 + rnd.choice([1, 2, 3, 4])) % 3000
        return " ".join(out)

    test = [(i, text()) for i in range(100)]
    gains = []
    for n in (400, 4000):
        docs = documents(spark, test + [(1000 + i, text()) for i in range(n)])
        got = score(docs, F.col("doc_id") >= 1000, 1e-3).filter("held_out").agg(F.sum("score") - F.sum("base_score"), F.sum("n_tokens")).first()
        gains.append(got[0] / got[1])
    assert gains[1] > gains[0] > 0.2


def test_packed_rows():
    rng = np.random.default_rng(2)
    n = 500
    kind, doc = np.sort(rng.integers(0, 4, n)), rng.integers(0, 40, n)
    order = np.lexsort((doc, kind))
    kind, doc = kind[order], doc[order]
    owner, other = rng.integers(0, 2**63, n).astype(np.uint64), rng.integers(0, 2**31, n).astype(np.uint64)
    times, keys, learn = rng.integers(1, 100_000, n), rng.integers(0, 2**63, 40).astype(np.uint64), rng.random(40) < 0.5
    got_keys, got_learn, kinds = unpacked(packed([kind, owner, other, doc, times], keys, learn))
    for k, (o, x, d, t) in enumerate(kinds):
        own = kind == k
        assert (o == owner[own]).all() and (t == times[own]).all() and (got_keys[d] == keys[doc[own]]).all() and (got_learn[d] == learn[doc[own]]).all()
        assert k == 0 or (x == other[own]).all()


def test_empty_table(spark):
    assert score(spark.createDataFrame([], SCHEMA), F.lit(True)).collect() == []
    alone = score(documents(spark, [(1, "no training rows")]), F.lit(False)).collect()[0]
    assert (alone.n_tokens, alone.n_known, alone.train_tokens, alone.base_score) == (4, 0, 0, 0.0)


def test_texts_get_one_row_from_all_parts_of_a_task(spark):
    """However many parts a corpus has, a text that is in all of them has one row a task, and the same sums."""
    rng = random.Random(8)
    rows = [(i, " ".join(f"w{rng.randrange(3_000)}" for _ in range(150)), False) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, held_out boolean")
    shared = spark.sparkContext.broadcast(train(docs, share=0.01).plain())
    batches = docs.toArrow().to_batches()
    expected = None
    for parts in (1, 64):
        made = pa.Table.from_batches(language_model.pair_rows(shared, parts)(iter(batches))).sort_by("part")
        assert len(set(made["part"].to_pylist())) == parts
        sums = pa.Table.from_batches(language_model.task_sums(shared)(iter(made.to_batches(max_chunksize=3)))).sort_by("row_key")
        assert sums.num_rows == len(rows)
        found = np.stack([sums[c].to_numpy() for c in ("known", "base", "model")])
        assert expected is None or np.allclose(found, expected)
        expected = found
