"""Embedding whitening by principal components.

Entries become whole 256ths, so sums and deviations are exact. The covariance of the distinct
vectors is summed by Spark, centred first; only a matrix of the dimension's size reaches the
driver. Householder reflections make it tridiagonal, Sturm counts bisect its leading eigenvalues,
and inverse iteration finds their eigenvectors, made orthogonal again within a cluster of close
eigenvalues. The components are broadcast and every row is projected where it lies.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagtide.llm.common import stored, table

#: Entries are counted in parts of one, components of a row, rows of a step.
SCALE, COMPONENTS, ROWS = 256, 4, 4096
#: Eigenvalues this close, by the matrix's norm, form a cluster; those below are rounding.
CLOSE, NOTHING = 1e-3, 1e-13
LONG = 2**63


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, side diagonal, and the reflections that turn the symmetric matrix into them."""
    a, n, mirrors = matrix.astype(float).copy(), len(matrix), []
    for k in range(n - 2):
        x = a[k + 1 :, k]
        v = x.copy()
        size = np.abs(x).max()
        if size == 0 or not np.abs(x[1:]).max() > 0:
            mirrors.append(np.zeros(n))
            continue
        v = v / size
        v[0] += math.copysign(np.linalg.norm(v), v[0])
        v /= np.linalg.norm(v)
        full = np.zeros(n)
        full[k + 1 :] = v
        # H A H with H = I - 2 v v': a symmetric update of rank two.
        p = a @ full
        q = p - (full @ p) * full
        a -= 2 * (np.outer(full, q) + np.outer(q, full))
        mirrors.append(full)
    return np.diag(a).copy(), np.diag(a, 1).copy(), mirrors


def count_below(diagonal: np.ndarray, side: np.ndarray, x: float) -> int:
    """Number of eigenvalues below ``x``: the negative terms of the Sturm sequence of quotients."""
    least = np.finfo(float).tiny / np.finfo(float).eps
    count, q = 0, 1.0
    for i, d in enumerate(diagonal.tolist()):
        q = d - x - (side[i - 1] ** 2 / q if i else 0.0)
        if abs(q) < least:
            q = -least
        count += q < 0
    return count


def leading_values(diagonal: np.ndarray, side: np.ndarray, k: int) -> list[float]:
    """The ``k`` largest eigenvalues, falling, each bisected until no double lies between its bounds."""
    n = len(diagonal)
    reach = np.zeros(n)
    reach[:-1] += np.abs(side)
    reach[1:] += np.abs(side)
    norm = max(np.abs(diagonal).max(), reach.max())
    found, top = [], float((diagonal + reach).max()) + 2 * np.finfo(float).eps * norm
    for i in range(k):
        low, high = float((diagonal - reach).min()) - 2 * np.finfo(float).eps * norm, found[-1] if found else top
        if count_below(diagonal, side, high) < n - i:
            high = math.nextafter(high, math.inf)
        while True:
            middle = (low + high) / 2
            if not low < middle < high or high - low <= np.finfo(float).eps * norm * 0.25:
                break
            if count_below(diagonal, side, middle) >= n - i:
                high = middle
            else:
                low = middle
        found.append((low + high) / 2)
    return found


def _solver(diagonal: np.ndarray, side: np.ndarray, shift: float, least: float):
    """Solves (T - shift) y = b by elimination with row exchanges; a zero pivot becomes ``least``."""
    n = len(diagonal)
    upper = np.zeros((n, 3))
    steps = []
    row = [diagonal[0] - shift, side[0] if n > 1 else 0.0, 0.0]
    for i in range(n - 1):
        below = [side[i], diagonal[i + 1] - shift, side[i + 1] if i + 2 < n else 0.0]
        swap = abs(below[0]) > abs(row[0])
        if swap:
            row, below = below, row
        pivot = row[0] if abs(row[0]) > least else math.copysign(least, row[0] or 1.0)
        factor = below[0] / pivot
        upper[i] = [pivot, row[1], row[2]]
        steps.append((swap, factor))
        row = [below[1] - factor * row[1], below[2] - factor * row[2], 0.0]
    upper[n - 1] = [row[0] if abs(row[0]) > least else math.copysign(least, row[0] or 1.0), 0, 0]

    def solve(b: np.ndarray) -> np.ndarray:
        y = b.copy()
        for i, (swap, factor) in enumerate(steps):
            if swap:
                y[i], y[i + 1] = y[i + 1], y[i]
            y[i + 1] -= factor * y[i]
        for i in range(n - 1, -1, -1):
            rest = sum(upper[i, j] * y[i + j] for j in (1, 2) if i + j < n)
            y[i] = (y[i] - rest) / upper[i, 0]
            if abs(y[i]) > 1e200:
                y /= abs(y[i])
        return y

    return solve


def leading_vectors(diagonal: np.ndarray, side: np.ndarray, values: list[float]) -> np.ndarray:
    """Unit eigenvectors of the tridiagonal matrix, one column per value, by inverse iteration."""
    n, eps = len(diagonal), np.finfo(float).eps
    norm = max(float(np.abs(diagonal).max() + 2 * (np.abs(side).max() if n > 1 else 0)), np.finfo(float).tiny)
    columns, cluster, shift = [], [], math.inf
    for i, value in enumerate(values):
        if i and values[i - 1] - value <= CLOSE * norm:
            # Equal shifts would lead to equal vectors.
            shift = min(value, shift - 10 * eps * norm)
        else:
            cluster, shift = [], value
        solve = _solver(diagonal, side, shift, eps * norm)
        x = np.random.default_rng(i).uniform(0.5, 1.5, n)
        for _ in range(8):
            before = x
            # Twice is enough to be orthogonal to the last bit.
            for _ in range(2):
                for other in cluster:
                    x = x - (other @ x) * other
            x = solve(x / np.linalg.norm(x))
            for _ in range(2):
                for other in cluster:
                    x = x - (other @ x) * other
            x = x / np.linalg.norm(x)
            if abs(abs(before @ x) / np.linalg.norm(before) - 1) < 4 * eps:
                break
        columns.append(x)
        cluster.append(x)
    return np.array(columns).reshape(len(values), n).T


def principal(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of a symmetric matrix that are not nothing, and unit vectors as columns.

    The largest entry of a vector is positive, so that runs agree.
    """
    n = len(matrix)
    scale = float(np.abs(matrix).max()) if n else 0.0
    if not scale > 0:
        return np.zeros(0), np.zeros((n, 0))
    diagonal, side, mirrors = tridiagonal(matrix / scale)
    values = leading_values(diagonal, side, min(k, n))
    values = [v for v in values if v > NOTHING * n]
    vectors = leading_vectors(diagonal, side, values)
    for v in reversed(mirrors):
        vectors = vectors - 2 * np.outer(v, v @ vectors)
    vectors = vectors / np.linalg.norm(vectors, axis=0)
    at = np.abs(vectors).argmax(0)
    return np.array(values) * scale, vectors * np.sign(vectors[at, np.arange(len(values))])


def whole(vector: Column, size: int | None = None) -> Column:
    """Entries as whole 256ths; zeros fill up a vector that is shorter than ``size``."""
    entries = F.transform(vector, lambda c: F.floor(c.cast("double") * F.lit(float(SCALE))).cast("long"))
    if size is None:
        return entries
    return F.concat(entries, F.array_repeat(F.lit(0).cast("long"), F.lit(size) - F.size(vector)))


def finite(vector: Column) -> Column:
    """True for a vector that holds no null and no non-finite entry."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True))


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, size)


def _sums(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Rows, and exact sums in two halves of 32 bits, per dimension."""
    n, high, low = 0, np.zeros(size, np.int64), np.zeros(size, np.int64)
    for batch in batches:
        x = _matrix(batch.column(0), size)
        n += len(x)
        high += (x >> 32).sum(0)
        low += (x & 0xFFFFFFFF).sum(0)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.arange(size)), pa.array(np.full(size, n)), pa.array(high), pa.array(low)], ["i", "n", "high", "low"]
    )


def _products(make):
    """Sums of the outer products of ``make(rows)``, row by row of the matrix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                y = make(batch.column(0).slice(start, ROWS))
                total = y.T @ y if total is None else total + y.T @ y
        if total is not None:
            k = len(total)
            i, j = np.divmod(np.arange(k * k), k)
            yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total.reshape(-1))], ["i", "j", "value"])

    return run


def _summed(fitted: DataFrame, make, k: int) -> np.ndarray:
    """A matrix of ``k`` by ``k`` that every task has a share of, added up by Spark."""
    parts = fitted.select("x").mapInArrow(_products(make), "i long, j long, value double")
    rows = parts.groupBy("i", "j").agg(F.sum("value").alias("value")).toArrow()
    out = np.zeros((k, k))
    out[rows["i"].to_numpy(), rows["j"].to_numpy()] = rows["value"].to_numpy()
    return out


def whiten(
    vectors: DataFrame, components: int = COMPONENTS, id_column: str = "vec_id", column: str = "embedding"
) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of each row and component.

    Rows whose vector is null or holds a null or non-finite entry are left out. A repeated vector
    counts once in the fit and has rows of its own; so has a repeated or missing id. Vectors that
    are shorter than the longest are filled up with zeros, the empty one too. Components with no
    variance beyond rounding are left out: a single distinct vector, or an empty table, gives no
    rows. ``deviation`` is null where it does not fit in a long. Entries of 2^63 / 256 and beyond
    count as the largest long, as a cast does.

    The driver holds matrices of the dimension's size only. Equal vectors meet by partial
    aggregation, so a vector with a third of all rows is one row per task before the shuffle.
    """
    rows = vectors.select(F.col(f"`{id_column}`").cast("long").alias("vec_id"), F.col(f"`{column}`").alias("v"))
    rows = rows.filter(finite(F.col("v")))
    size = rows.agg(F.max(F.size("v"))).first()[0] or 0
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if not size:
        return rows.sparkSession.createDataFrame([], schema)
    rows = rows.select("vec_id", whole(F.col("v"), size).alias("x"))
    fitted = stored(rows.select("x").distinct())
    kind = "i long, n long, high long, low long"
    sums = fitted.mapInArrow(lambda batches: _sums(batches, size), kind)
    total = {r.i: r for r in sums.groupBy("i").agg(*[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("n", "high", "low")]).collect()}
    n = int(total[0].n)
    s = [(int(total[i].high) << 32) + int(total[i].low) for i in range(size)]
    mean = np.array([t / n for t in s])
    covariance = _summed(fitted, lambda x: _matrix(x, size) - mean, size) / n
    values, axes = principal(covariance, components)
    if not len(values):
        return rows.sparkSession.createDataFrame([], schema)
    trace, k = float(np.trace(covariance)), len(values)
    projection = axes / np.sqrt(values)
    white = _summed(fitted, lambda x: (_matrix(x, size) - mean) @ projection, k) / n
    error = float(np.abs(white - np.eye(k)).max())
    shared = rows.sparkSession.sparkContext.broadcast((mean, projection, s))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mean, projection, s = shared.value
        for batch in batches:
            x = _matrix(batch.column("x"), size)
            far = n * max(abs(int(x.min())), abs(int(x.max()))) + max(map(abs, s)) if len(x) else 0
            # Python's integers where a long might overflow on the way.
            if far * far * size < LONG:
                exact = ((x * n - np.array(s)) ** 2).sum(1).tolist()
            else:
                exact = [sum((n * e - t) ** 2 for e, t in zip(row, s)) for row in x.tolist()]
            deviation = pa.array([d if d < LONG else None for d in exact], pa.int64())
            white = (x - mean) @ projection
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([batch.column("vec_id")] * k),
                    pa.array(np.repeat(np.arange(1, k + 1), len(x)), pa.int32()),
                    pa.concat_arrays([deviation] * k),
                    pa.array(white.T.reshape(-1)),
                    pa.array(np.repeat(values / trace, len(x))),
                ],
                ["vec_id", "component", "deviation", "whitened", "explained"],
            )

    made = rows.mapInArrow(run, "vec_id long, component int, deviation long, whitened double, explained double")
    return made.select(
        "vec_id", "component", F.lit(n).cast("long").alias("n"), "deviation", "whitened", "explained", F.lit(error).alias("identity_error")
    )


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
