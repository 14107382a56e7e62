import random

import numpy as np
import pyarrow as pa
import pytest
from helpers import SCHEMA, documents, roots, sentence, texts, words

from tagtide.llm.components import components, forest
from tagtide.llm import hyperminhash
from tagtide.llm.hyperminhash import EMPTY, FINE, Shingler, chance, near_dedup, near_enough, near_groups, plausible, registers


def shingles(text):
    ws = words(text, lower=True)
    return {tuple(ws[i : i + 5]) for i in range(max(1, len(ws) - 4))} if ws else set()


def plain(rows):
    sets = [(i, shingles(t)) for i, t in rows if i is not None and shingles(t)]
    links = [
        (a, b) for k, (a, x) in enumerate(sets) for b, y in sets[:k] if a != b and 100 * len(x & y) >= 75 * len(x | y)
    ]
    found = roots({i for i, _ in sets}, links)
    return sorted(((i, len(shingles(t)), found.get(i, i), found.get(i, i) == i) for i, t in rows), key=str)


def test_shingles_of_a_batch():
    values = [t for _, t in texts()]
    value, doc, _, _ = Shingler().sets(pa.array(values, pa.string()))
    assert np.bincount(doc, minlength=len(values)).tolist() == [len(shingles(t)) for t in values]


def test_registers_estimate_similarity():
    rng = np.random.default_rng(0)
    for share in (0.2, 0.5, 0.75, 0.95):
        n, common = 2_000, int(2 * 2_000 * share / (1 + share))
        a = rng.integers(0, 2**63, n).astype(np.uint64)
        b = np.r_[a[:common], rng.integers(0, 2**63, n - common).astype(np.uint64)]
        rows = registers(np.r_[a, b], np.repeat([0, 1], n), 2)
        size = np.array([n])
        c = chance(size, size)
        estimate = ((rows[:1] == rows[1:]).mean(1) - c) / (1 - c)
        assert abs(estimate[0] - share) < 0.17
        assert plausible(rows[:1], rows[1:], size, size, 0.75)[0] or share < 0.75


def test_collisions_of_disjoint_sets_are_rare():
    rng = np.random.default_rng(1)
    n = 400
    value = rng.integers(0, 2**63, (n, 500)).astype(np.uint64)
    rows = registers(value.ravel(), np.repeat(np.arange(n), 500), n)
    measured = (rows[: n // 2] == rows[n // 2 :]).mean()
    expected = chance(np.array([500]), np.array([500]))[0]
    assert measured < 3 * expected + 1e-4 < 0.01


@pytest.mark.parametrize("block", [1_000, 3])
def test_near_groups(spark, monkeypatch, block):
    monkeypatch.setattr(hyperminhash, "BLOCK_MEMBERS", block)
    rows = texts()
    rnd = random.Random(8)
    for k in range(60):  # chains of texts that change a little from one to the next
        ws = rows[60 + k][1].split() if k % 10 == 0 else ws  # noqa: F821
        ws = [*ws]
        ws[rnd.randrange(len(ws))] = f"new{k}"
        rows.append((400 + k, " ".join(ws)))
    got = near_groups(documents(spark, rows)).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain(rows)


@pytest.mark.parametrize("block", [1_000, 3])
def test_pairs_of_small_sets(spark, monkeypatch, block):
    monkeypatch.setattr(hyperminhash, "BLOCK_MEMBERS", block)
    rnd, rows = random.Random(12), []
    for k in range(600):  # from 4 to 40 shingles, with words added as far as the similarity stays at 75 percent
        n = 4 + k % 37
        ws = [f"w{rnd.randrange(10**9)}" for _ in range(n + 4)]
        more = [f"w{rnd.randrange(10**9)}" for _ in range(n // 3)]
        rows += [(2 * k, " ".join(ws)), (2 * k + 1, " ".join(ws + more))]
    hot = [f"h{i}" for i in range(12)]  # a common start, in buckets with many components
    rows += [(5_000 + k, " ".join([*hot, *(f"t{k // 4}x{i}" for i in range(2 + k // 4 % 9)), *["z"] * (k % 3)])) for k in range(80)]
    got = near_groups(documents(spark, rows)).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain(rows)


def test_near_groups_by_bands(spark, monkeypatch):
    monkeypatch.setattr(hyperminhash, "SMALL", 0)
    got = near_groups(documents(spark)).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain(texts())


def test_one_of_each_group_stays(spark):
    docs = documents(spark)
    kept = near_dedup(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted((i for i, _, _, k in plain(texts()) if k), key=str)


def test_empty_table(spark):
    assert near_groups(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("shape", ["path", "star", "random"])
def test_components(spark, shape):
    rnd = random.Random(9)
    nodes = rnd.sample(range(10_000), 200)
    links = {
        "path": list(zip(nodes, nodes[1:])),
        "star": [(nodes[0], n) for n in nodes[1:]] + [(-1, -2), (5, 5)],
        "random": [(rnd.choice(nodes), rnd.choice(nodes)) for _ in range(150)],
    }[shape]
    frame = spark.createDataFrame([*links, (None, 3)], "x long, y long").repartition(6)
    expected = {n: r for n, r in roots({x for e in links for x in e}, links).items() if n != r}
    assert dict(map(tuple, components(frame).collect())) == expected
    a, b = np.array(links).T
    assert dict(zip(*map(np.ndarray.tolist, forest(a, b)))) == expected


@pytest.mark.parametrize("n", [5, 40, 150, 600, 5_000])
def test_closer_look_keeps_links_and_drops_most_others(n):
    rng = np.random.default_rng(n)

    def bytes_of(sets):
        doc = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        rows = registers(np.concatenate(sets), doc, len(sets), FINE, fill=False)
        return np.where(rows == EMPTY, 0, 1 + rows.astype(np.uint32) * np.uint32(2654435761) % np.uint32(1 << 31) % np.uint32(255)).astype(np.uint8)

    def kept(common):
        a = [rng.integers(0, 2**63, n).astype(np.uint64) for _ in range(300)]
        b = [np.r_[x[:common], rng.integers(0, 2**63, n - common).astype(np.uint64)] for x in a]
        x, y = bytes_of(a), bytes_of(b)
        return np.mean([near_enough(x[i], y[i : i + 1], np.array([2 * n]), 0.75)[0] for i in range(300)])

    assert kept(-(-6 * n // 7)) == 1.0  # 6/7 of each in common: similarity 0.75
    if n >= 150:
        assert kept(int(0.75 * n)) < 0.05  # similarity 0.6


def test_different_texts_under_one_id(spark):
    one, other = sentence(50, 60), sentence(51, 60)
    rows = [(1, one), (2, one + " word"), (2, other), (3, other + " more"), (4, one), (4, None), (None, one)]
    docs = documents(spark, rows)
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in near_groups(docs).collect())
    assert got == [(0, 56, 0), (1, 56, 1), (2, 56, 2), (2, 57, 1), (3, 57, 2), (4, 0, 4), (4, 56, 1)]
    kept = near_dedup(docs)
    assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == sorted([(1, one), (1, one)][:1] + [(2, other), (4, ""), (0, one)])
    assert kept.columns == docs.columns


def test_two_texts_of_one_id_in_one_group(spark):
    one = sentence(52, 60)
    docs = documents(spark, [(1, one), (1, one + " word"), (2, one + " end")])
    kept = [near_dedup(docs).collect() for _ in range(2)]
    assert [len(k) for k in kept] == [1, 1] and kept[0][0].doc_id == 1 and kept[0][0].text == kept[1][0].text
