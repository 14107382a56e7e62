"""Embedding near-dedup by the epsilon grid order join.

Unit vectors are turned so that their leading coordinates vary most, and sorted by their cells
in a grid whose cells are as wide as the largest distance of a link. Consecutive vectors form
blocks with a bounding box. Pairs of sequence intervals are followed downwards, from the whole
sequence to single blocks, and dropped where their boxes are provably further apart than a
link (Boehm et al. 2001). Inside a task the same recursion goes on down to small sub-blocks,
which are multiplied in double precision.

A pair of blocks reports link counts and a spanning forest, never its pairs, so a large group
of near copies costs rows in proportion to its members.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagtide.llm.common import parts_for, stored, table
from tagtide.llm.components import components, forest

#: Cosine of a link, vectors of a block and of the smallest sub-block, leading cells in the sort key,
#: branching of the interval tree, vectors that the directions are taken from.
COSINE, BLOCK, LEAF, CELLS, FAN_BITS, SAMPLE = 0.9, 4096, 512, 16, 4, 4096


def usable(vector: Column) -> Column:
    """True for a vector without null or non-finite components that is not zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(vector, lambda x: x != 0)


def directions(vectors: DataFrame, size: int) -> np.ndarray:
    """An orthonormal basis with the directions of largest spread first, from a bounded sample.

    Any orthonormal basis gives the same links, so the sample only decides how much is skipped.
    """
    rows = vectors.orderBy(F.xxhash64("rep"), "rep").limit(SAMPLE).select("vector").toArrow()
    x = _matrix(rows["vector"].combine_chunks(), size)
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    _, basis = np.linalg.eigh(np.cov(x.T, bias=True).reshape(size, size))
    return basis[:, ::-1].copy()


def _matrix(column, size: int) -> np.ndarray:
    """Rows of ``size`` numbers in double precision; shorter vectors are filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    out, flat = np.zeros((len(column), size)), column.flatten().to_numpy(zero_copy_only=False)
    lengths = np.diff(column.offsets.to_numpy())
    at = np.r_[0, np.cumsum(lengths)]
    if (lengths == size).all():
        return flat.astype(float).reshape(-1, size)
    for i, n in enumerate(lengths):
        out[i, :n] = flat[at[i] : at[i] + n]
    return out


def placed(basis: np.ndarray, width: float):
    """``rep, copies, vector`` to the same with the sort key: the cells of the leading coordinates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("vector"), len(basis))
            unit = x / np.linalg.norm(x, axis=1, keepdims=True)
            lead = unit @ basis[:, :CELLS]
            cells = (np.floor(lead / width) + 128).clip(0, 255).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([c.tobytes() for c in cells], pa.binary()),
                    pa.array(lead[:, 0]),
                    batch.column("rep"),
                    batch.column("copies"),
                    pa.array([u.tobytes() for u in unit], pa.binary()),
                ],
                ["cells", "lead", "rep", "copies", "unit"],
            )

    return run


def blocks_of(basis: np.ndarray):
    """Sorted rows of a partition to blocks: number, bounding box, ids, copies and unit vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, held, number = [], 0, 0
        for batch in batches:
            waiting, held = [*waiting, batch], held + batch.num_rows
            while held >= BLOCK:
                whole = pa.Table.from_batches(waiting)
                yield block(whole.slice(0, BLOCK), number)
                number += 1
                waiting, held = whole.slice(BLOCK).to_batches(), held - BLOCK
        if held:
            yield block(pa.Table.from_batches(waiting), number)

    def block(rows: pa.Table, number: int) -> pa.RecordBatch:
        unit = np.frombuffer(b"".join(rows["unit"].to_pylist())).reshape(-1, len(basis))
        turned = unit @ basis
        return pa.RecordBatch.from_arrays(
            [
                pa.array([number], pa.int64()),
                pa.array([(turned.min(0) - 1e-9).tolist()], pa.list_(pa.float64())),
                pa.array([(turned.max(0) + 1e-9).tolist()], pa.list_(pa.float64())),
                pa.array([rows["rep"].to_numpy().tobytes()], pa.binary()),
                pa.array([rows["copies"].to_numpy().tobytes()], pa.binary()),
                pa.array([unit.tobytes()], pa.binary()),
            ],
            ["number", "low", "high", "reps", "copies", "units"],
        )

    return run


def near_boxes(a: str, b: str, reach: float) -> Column:
    """True if the boxes ``a_low, a_high`` and ``b_low, b_high`` are within ``reach`` of each other."""
    gap = (
        f"zip_with(zip_with({a}_low, {b}_high, (p, q) -> greatest(p - q, 0D)),"
        f" zip_with({b}_low, {a}_high, (p, q) -> greatest(p - q, 0D)), (p, q) -> p * p + q * q)"
    )
    return F.expr(f"aggregate({gap}, 0D, (s, x) -> s + x) <= {reach**2 + 1e-9}D")


def near_pairs(boxes: DataFrame, reach: float) -> DataFrame:
    """``a, b`` with a <= b: the pairs of blocks that may hold a link.

    ``boxes`` has ``seq, low, high``. Intervals of 16 numbers form the next level, up to one
    interval that holds all. Pairs go down level by level; children meet by their parents.
    """
    spark, levels = boxes.sparkSession, [boxes]
    top = boxes.agg(F.max("seq")).first()[0] or 0
    while top >> (FAN_BITS * (len(levels) - 1)):
        size = F.expr("size(low)")
        up = levels[-1].withColumn("seq", F.shiftright("seq", FAN_BITS))
        n = up.select(size).first()[0]
        sides = [F.array(*[f(F.col(c)[i]) for i in range(n)]).alias(c) for c, f in (("low", F.min), ("high", F.max))]
        levels.append(stored(up.groupBy("seq").agg(*sides)))
    pairs = spark.createDataFrame([(0, 0)], "a long, b long")
    for level in reversed(levels[:-1]):
        child = level.withColumn("up", F.shiftright("seq", FAN_BITS))
        left = child.select(F.col("up").alias("a"), F.col("seq").alias("x"), F.col("low").alias("x_low"), F.col("high").alias("x_high"))
        right = child.select(F.col("up").alias("b"), F.col("seq").alias("y"), F.col("low").alias("y_low"), F.col("high").alias("y_high"))
        met = pairs.join(left, "a").join(right, "b").filter((F.col("x") <= F.col("y")) & near_boxes("x", "y", reach))
        pairs = stored(met.select(F.col("x").alias("a"), F.col("y").alias("b")))
    return pairs


def join_blocks(basis: np.ndarray, cosine: float):
    """Per pair of blocks: ``rep, links, root`` of every vector that has a link in it."""
    reach = 2 - 2 * cosine + 1e-9

    def halves(a: int, b: int) -> list[tuple[int, int]]:
        half = (a + b) // 2
        return [(a, b)] if b - a <= LEAF else [(a, half), (half, b)]

    def apart(x: np.ndarray, y: np.ndarray) -> bool:
        gap = np.maximum(x.min(0) - y.max(0), y.min(0) - x.max(0))
        return float((np.maximum(gap, 0) ** 2).sum()) > reach

    def pair(xr, xc, x, yr, yc, y, same: bool):
        xt, yt = x @ basis, y @ basis
        xn, yn = np.zeros(len(x), np.int64), np.zeros(len(y), np.int64)
        tree = [np.zeros(0, np.int64), np.zeros(0, np.int64)]
        todo = [(0, len(x), 0, len(y))]
        while todo:
            a, b, c, d = todo.pop()
            if (same and c >= b) or apart(xt[a:b], yt[c:d]):
                continue
            if b - a > LEAF or d - c > LEAF:
                todo += [(*p, *q) for p in halves(a, b) for q in halves(c, d)]
                continue
            hit = x[a:b] @ y[c:d].T >= cosine
            if same:
                hit &= np.arange(a, b)[:, None] > np.arange(c, d)
            if hit.any():
                i, j = np.nonzero(hit)
                xn[a:b] += hit @ yc[c:d]
                yn[c:d] += xc[a:b] @ hit
                tree = list(forest(np.r_[tree[0], xr[a + i]], np.r_[tree[1], yr[c + j]]))
        return xn, yn, tree

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                x, y = (np.frombuffer(row[f"{s}_units"]).reshape(-1, len(basis)) for s in "xy")
                xr, yr = (np.frombuffer(row[f"{s}_reps"], np.int64) for s in "xy")
                xc, yc = (np.frombuffer(row[f"{s}_copies"], np.int64) for s in "xy")
                same = row["a"] == row["b"]
                xn, yn, (node, root) = pair(xr, xc, x, yr, yc, y, same)
                ids, links = np.concatenate([xr, yr]), np.concatenate([xn, yn])
                ids, links = ids[links > 0], links[links > 0]
                # Link counts and tree edges in one table: edges count no link.
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([ids, node])),
                        pa.array(np.concatenate([links, np.zeros(len(node), np.int64)])),
                        pa.array(np.concatenate([ids, root])),
                    ],
                    ["rep", "links", "root"],
                )

    return run


def near_duplicates(
    vectors: DataFrame, cosine: float = COSINE, id_column: str = "vec_id", column: str = "embedding"
) -> DataFrame:
    """``vec_id, n_links, component_id, kept``, one row per row of ``vectors``.

    Vectors link where their cosine is at least ``cosine``. Null, empty, zero and non-finite
    vectors and rows without id link with nothing. Vectors shorter than the longest are filled
    up with zeros. Equal vectors are compared once, as a class with a number of copies; a
    repeated id counts as another vector, with links and a component of its own.
    """
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(column).alias("vector"))
    fine = rows.filter(usable(F.col("vector")) & F.col("vec_id").isNotNull())
    classes = fine.groupBy(F.xxhash64("vector").alias("h"), "vector").agg(
        F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies")
    )
    # A number names a class: two classes may have the same smallest id.
    classes = stored(classes.withColumn("rep", F.monotonically_increasing_id()))
    n, size = classes.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    if not n:
        alone = F.col("vec_id").alias("component_id")
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), alone, F.lit(True).alias("kept"))
    basis, reach = directions(classes, size), math.sqrt(2 - 2 * cosine)
    keyed = stored(
        classes.select("rep", "copies", "vector").mapInArrow(
            placed(basis, reach), "cells binary, lead double, rep long, copies long, unit binary"
        )
    )
    parts = parts_for(n, BLOCK)
    order = ["cells", "lead", "rep"]
    cut = keyed.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    blocks = cut.select("rep", "copies", "unit").mapInArrow(
        blocks_of(basis),
        "number long, low array<double>, high array<double>, reps binary, copies binary, units binary",
    )
    blocks = stored(blocks.withColumn("part", F.spark_partition_id().cast("long")))
    # Numbers leave room for the longest partition, so their order is the order of the grid.
    most = blocks.agg(F.max("number")).first()[0] + 1
    blocks = blocks.withColumn("seq", F.col("part") * F.lit(most) + F.col("number"))
    pairs = near_pairs(stored(blocks.select("seq", "low", "high")), reach)

    def side(name: str, key: str) -> DataFrame:
        return blocks.select(F.col("seq").alias(key), *[F.col(c).alias(f"{name}_{c}") for c in ("reps", "copies", "units")])

    met = pairs.join(side("x", "a"), "a").join(side("y", "b"), "b")
    found = stored(met.mapInArrow(join_blocks(basis, cosine), "rep long, links long, root long"))
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    roots = components(found.filter("rep <> root").select("rep", "root"))
    known = (
        classes.join(links, "rep", "left")
        .join(roots, F.col("rep") == F.col("node"), "left")
        .select(
            "h",
            "vector",
            "least",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("root", "rep").alias("root"),
        )
    )
    smallest = known.groupBy("root").agg(F.min("least").alias("component_id"))
    known = known.drop("least").join(smallest, "root").drop("root")
    keyed_rows = rows.withColumn("h", F.when(F.col("vec_id").isNotNull(), F.xxhash64("vector")))
    found = keyed_rows.join(known, ["h", "vector"], "left")
    own = F.coalesce("component_id", "vec_id")
    return found.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        own.alias("component_id"),
        own.eqNullSafe(F.col("vec_id")).alias("kept"),
    )


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


OP8_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
l AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.vec_id <> y.vec_id
      WHERE list_cosine_similarity(x.e, y.e) >= 0.9),
r AS (SELECT vec_id AS node, vec_id AS seen FROM v UNION SELECT r.node, l.b FROM r JOIN l ON l.a = r.seen),
c AS (SELECT node, min(seen) AS component_id FROM r GROUP BY node),
n AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
SELECT v.vec_id, coalesce(n.n_links, 0) AS n_links, c.component_id, v.vec_id = c.component_id AS kept
FROM v JOIN c ON c.node = v.vec_id LEFT JOIN n ON n.a = v.vec_id
"""
