import numpy as np
import pytest
from helpers import roots

from tagtide.llm import epsilon_grid
from tagtide.llm.epsilon_grid import near_duplicates

SCHEMA = "vec_id long, embedding array<float>, label int, rep long, links long, component_id string, h string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, None, 0, 0, "?", "?") for i, v in rows], SCHEMA)


def plain(rows, cosine=0.9):
    size = max((len(v) for _, v in rows if v), default=1)
    unit, ids = [], []
    for k, (i, v) in enumerate(rows):
        x = np.array([np.nan] if not v or None in v else v, np.float32).astype(float)
        if i is not None and np.isfinite(x).all() and x.any():
            x = np.r_[x, np.zeros(size - len(x))]
            unit.append(x / np.linalg.norm(x))
            ids.append(k)
    hit = np.array(unit) @ np.array(unit).T >= cosine
    links = {k: int(hit[a].sum()) - 1 for a, k in enumerate(ids)}
    # Rows are the nodes: an id may be repeated.
    found = roots(ids, [(ids[a], ids[b]) for a, b in zip(*np.nonzero(hit)) if a != b])
    least = {}
    for k in ids:
        least[found[k]] = min(least.get(found[k], rows[k][0]), rows[k][0])
    out = []
    for k, (i, _) in enumerate(rows):
        root = least[found[k]] if k in links else i
        out.append((i, links.get(k, 0), root, root == i))
    return sorted(out, key=str)


def vectors(n, size=12, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(n // 6 + 1, size))
    rows = [(i, (centres[i % len(centres)] + rng.normal(scale=0.12, size=size)).astype(np.float32).tolist()) for i in range(n)]
    rows += [(5_000 + i, rows[3][1]) for i in range(40)]
    rows += [(6_000 + i, (np.array(rows[4][1]) + rng.normal(scale=0.01, size=size)).tolist()) for i in range(40)]
    return rows


AWKWARD = [
    (9_000, None),
    (9_001, []),
    (9_002, [0.0] * 12),
    (9_003, [float("nan")] + [1.0] * 11),
    (9_004, [float("inf")] + [1.0] * 11),
    (9_005, [None] + [1.0] * 11),
    (9_006, [1.0, 2.0]),
    (9_007, [2.0, 4.0]),
    (None, [1.0] * 12),
    (None, None),
]


@pytest.mark.parametrize("block, leaf", [(4096, 512), (16, 4)])
def test_links_and_components(spark, monkeypatch, block, leaf):
    monkeypatch.setattr(epsilon_grid, "BLOCK", block)
    monkeypatch.setattr(epsilon_grid, "LEAF", leaf)
    rows = vectors(300) + AWKWARD
    got = near_duplicates(table(spark, rows)).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain(rows)


def test_empty_table(spark):
    assert near_duplicates(table(spark, [])).collect() == []
    assert [tuple(r) for r in near_duplicates(table(spark, [(1, None)])).collect()] == [(1, 0, 1, True)]


def test_different_vectors_under_one_id(spark):
    rows = [(5, [1.0, 0.0, 0.0]), (5, [0.0, 1.0, 0.0]), (6, [1.0, 0.05, 0.0]), (4, [0.0, 1.0, 0.01]), (4, [0.0, 0.0, 1.0])]
    got = sorted((tuple(r) for r in near_duplicates(table(spark, rows)).collect()), key=str)
    assert got == plain(rows)
    assert got == [(4, 0, 4, True), (4, 1, 4, True), (5, 1, 4, False), (5, 1, 5, True), (6, 1, 5, False)]
