import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import SCHEMA, documents, sentence, texts, words

from tagtide.llm import substring_dedup
from tagtide.llm.substring_dedup import FMIndex, WaveletMatrix, cut_repeats, least_owner


def test_rank():
    rng = np.random.default_rng(1)
    for symbols in (1, 2, 3, 9, 64, 300):
        values = rng.integers(0, symbols, 500)
        matrix = WaveletMatrix(values, symbols)
        asked, place = rng.integers(0, symbols, 200), rng.integers(0, 501, 200)
        expected = [int((values[:p] == s).sum()) for s, p in zip(asked, place)]
        assert matrix.rank(asked, place).tolist() == expected


def test_backward_search_counts_occurrences():
    rng = np.random.default_rng(2)
    text = np.r_[rng.integers(1, 4, 300), 0, rng.integers(1, 4, 200), 0]
    index = FMIndex(text, 4, 13)
    for length in range(1, 14):
        for start in range(0, 280, 17):
            pattern = text[start : start + length]
            low, high = index.start(pattern[-1:])
            for symbol in pattern[-2::-1]:
                low, high = index.step(np.array([symbol]), low, high)
            found = sum(np.array_equal(text[i : i + length], pattern) for i in range(len(text) - length + 1))
            assert int(high[0] - low[0]) == found


@pytest.mark.parametrize("seed", range(3))
def test_least_owner(seed):
    rnd = random.Random(seed)
    segments = [[rnd.randrange(1, 3 + seed * 20) for _ in range(rnd.randint(13, 30))] for _ in range(60)]
    segments += [segments[0][2:] + [9], segments[1][:15]]
    owner = np.array([rnd.randrange(100) for _ in segments])
    least, expected = {}, []
    for s, o in zip(segments, owner):
        for i in range(len(s) - 12):
            key = tuple(s[i : i + 13])
            least[key] = min(least.get(key, o), o)
    for s in segments:
        expected += [least[tuple(s[i : i + 13])] for i in range(len(s) - 12)]
    hashes = np.array([w for s in segments for w in s], np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    assert least_owner(hashes, np.array([len(s) for s in segments]), owner, 13).tolist() == expected


def plain(rows):
    least = {}
    for i, t in rows:
        ws = words(t) if i is not None else []
        for k in range(len(ws) - 12):
            key = tuple(ws[k : k + 13])
            least[key] = min(least.get(key, i), i)
    out = Counter()
    for i, t in rows:
        ws, gone = words(t), set()
        for k in range(len(ws) - 12) if i is not None else ():
            if least[tuple(ws[k : k + 13])] < i:
                gone.update(range(k, k + 13))
        kept = " ".join(w for k, w in enumerate(ws) if k not in gone)
        out[(i, len(ws), len(gone), hashlib.sha256(kept.encode()).hexdigest())] += 1
    return out


@pytest.mark.parametrize("hot", [4_000, 1])
def test_documents(spark, monkeypatch, hot):
    monkeypatch.setattr(substring_dedup, "HOT_SEGMENTS", hot)
    rows = texts()
    got = cut_repeats(documents(spark)).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == plain(rows)
    kept = defaultdict(set)
    for r in got:
        kept[r.doc_id].add(hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256)
    assert all(v == {True} for v in kept.values())


def test_spacing_in_crowded_anchors(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "HOT_SEGMENTS", 1)
    rows = []
    for k in range(20):  # the smallest id holds the first windows only
        ws = sentence(500 + k, 50).split()
        rows += [(k, " ".join(ws[: 16 + k])), (100 + k, " ".join(ws)), (200 + k, "  ".join(ws)), (300 + k, " \n".join(ws))]
    got = cut_repeats(documents(spark, rows)).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == plain(rows)


def test_empty_table(spark):
    assert cut_repeats(spark.createDataFrame([], SCHEMA)).collect() == []
