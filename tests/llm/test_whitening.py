import numpy as np
import pytest

from tagtide.llm.whitening import count_below, leading_values, principal, tridiagonal, whiten

SCHEMA = "vec_id long, embedding array<float>, x string, v string, n long, `a.b` string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, "?", "?", 0, "?") for i, v in rows], SCHEMA)


def plain(rows, k=4):
    kept = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if v is not None and None not in v and np.isfinite(v).all()]
    size = max(len(v) for _, v in kept)
    x = [(i, [int(np.floor(256 * c)) for c in v] + [0] * (size - len(v))) for i, v in kept]
    fit = sorted({tuple(v) for _, v in x})
    n, s = len(fit), [sum(c) for c in zip(*fit)]
    y = np.array(fit, float) - np.array(s) / n
    cov = y.T @ y / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    out = {}
    for i, v in x:
        deviation = sum((n * c - t) ** 2 for c, t in zip(v, s))
        white = (np.array(v) - np.array(s) / n) @ vectors / np.sqrt(values)
        out.setdefault(i, []).append((deviation, white))
    return n, out, values / np.trace(cov)


def rows_of(n=300, size=12, seed=0):
    rng = np.random.default_rng(seed)
    data = (rng.normal(size=(n, size)) * np.linspace(2, 0.2, size)).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(data)]
    rows += [(1000 + i, rows[3][1]) for i in range(200)]
    return rows + [
        (5, rows[6][1]),
        (None, rows[7][1]),
        (2000, None),
        (2001, [1.0, None] + [0.0] * (size - 2)),
        (2002, [float("nan")] * size),
        (2003, [float("inf")] + [0.0] * (size - 1)),
        (2004, []),
        (2005, [-0.0] * size),
        (2006, [0.5] * (size - 3)),
    ]


def check(rows, got, k=4):
    n, expected, explained = plain(rows, k)
    by_id = {}
    for r in got:
        assert r.n == n and abs(r.explained / explained[r.component - 1] - 1) < 1e-9 and r.identity_error < 1e-9
        by_id.setdefault(r.vec_id, {}).setdefault(r.component, []).append((r.deviation, r.whitened))
    assert set(by_id) == set(expected)
    signs = {}
    for i, parts in by_id.items():
        assert sorted(parts) == list(range(1, len(explained) + 1))
        for c, found in parts.items():
            want = sorted((d, w[c - 1]) for d, w in expected[i])
            assert sorted(d for d, _ in found) == [d for d, _ in want]
            if len(found) == 1 and abs(want[0][1]) > 1e-6:
                signs.setdefault(c, set()).add(round(found[0][1] / want[0][1], 6))
    assert all(s in ({1.0}, {-1.0}) for s in signs.values()) and len(signs) == len(explained)


def test_against_a_plain_version(spark):
    rows = rows_of()
    got = whiten(table(spark, rows))
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check(rows, got.collect())


def test_few_dimensions_and_few_vectors(spark):
    rows = [(1, [1.0, 2.0]), (2, [2.0, 0.5]), (3, [0.25, 0.25]), (3, [0.25, 0.25])]
    check(rows, whiten(table(spark, rows)).collect(), 2)
    # Two distinct vectors span one component; one spans none.
    assert {r.component for r in whiten(table(spark, rows[:2])).collect()} == {1}
    assert whiten(table(spark, rows[2:])).collect() == []
    assert whiten(table(spark, [])).collect() == []
    assert whiten(table(spark, [(1, None), (2, [])])).collect() == []


def test_deviation_beyond_a_long(spark):
    rows = [(1, [1e15, 0.0]), (2, [0.0, 1.0]), (3, [3.0, 5.0])]
    got = whiten(table(spark, rows)).collect()
    assert all(r.deviation is None for r in got) and got


def random_symmetric(rng, n, values):
    q, _ = np.linalg.qr(rng.normal(size=(n, n)))
    return (q * values) @ q.T


@pytest.mark.parametrize("n", [1, 2, 3, 5, 20, 64])
def test_eigenvalues_and_vectors(n):
    rng = np.random.default_rng(n)
    spectra = [
        rng.uniform(0, 1, n),
        np.ones(n),
        np.r_[np.ones(max(1, n // 2)), np.zeros(n - max(1, n // 2))],
        1 + rng.uniform(0, 1e-12, n),
        np.geomspace(1, 1e-9, n),
        np.r_[1e8, rng.uniform(0, 1, n - 1)],
    ]
    for spectrum in spectra:
        for a in (random_symmetric(rng, n, spectrum), np.diag(spectrum)):
            a = (a + a.T) / 2
            k = min(4, n)
            values, vectors = principal(a, k)
            true = np.sort(np.linalg.eigvalsh(a))[::-1][:k]
            true = true[: len(values)]
            scale = np.abs(a).max()
            assert np.abs(values - true).max() <= 1e-13 * n * scale
            assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-12
            assert np.abs(a @ vectors - vectors * values).max() <= 1e-12 * n * scale


def test_sturm_counts():
    rng = np.random.default_rng(3)
    a = random_symmetric(rng, 15, rng.uniform(-1, 1, 15))
    diagonal, side, _ = tridiagonal(a)
    true = np.linalg.eigvalsh(a)
    for x in np.linspace(-1.2, 1.2, 50):
        assert count_below(diagonal, side, x) == (true < x).sum()
    assert np.allclose(leading_values(diagonal, side, 15), true[::-1], atol=1e-14)
