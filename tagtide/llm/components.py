"""Connected components of a graph given as links between 64-bit ids."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagtide.llm.common import stored, trimmed


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node that is not the smallest of its component, with that smallest node."""
    nodes, index = np.unique(np.concatenate([a, b]), return_inverse=True)
    label, x, y = np.arange(len(nodes)), index[: len(a)], index[len(a) :]
    while True:
        low, high = np.minimum(label[x], label[y]), np.maximum(label[x], label[y])
        apart = low != high
        if not apart.any():
            break
        x, y = x[apart], y[apart]
        np.minimum.at(label, high[apart], low[apart])
        while True:
            further = label[label]
            if np.array_equal(further, label):
                break
            label = further
    child = label != np.arange(len(nodes))
    return nodes[child], nodes[label[child]]


def _local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of a partition as stars: as many as it has nodes at most."""
    a = b = np.zeros(0, np.int64)
    for batch in batches:
        a = np.concatenate([a, batch.column(0).to_numpy()])
        b = np.concatenate([b, batch.column(1).to_numpy()])
        a, b = forest(a, b)
    if len(a):
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def _settled(stars: DataFrame) -> bool:
    """True if every node hangs on one root and no root hangs on another."""
    ends = stars.select(F.col("a").alias("node"), F.lit(1).alias("child")).union(stars.select("b", F.lit(0)))
    state = ends.groupBy("node").agg(F.sum("child").alias("up"), F.min("child").alias("leaf"))
    return state.filter("up > 1 or (up = 1 and leaf = 0)").limit(1).count() == 0


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for the nodes of ``links`` (two id columns) that are not the smallest of theirs.

    Every partition first reduces its links to stars; then alternate rounds hang the larger
    neighbours of each node, and the node with its smaller ones, on the smallest neighbour
    (Kiveris et al. 2014). The number of rounds grows with the logarithm of the nodes. A hub's
    smallest neighbour is found by partial aggregation and joined back as one row, so hubs
    split. Rounds are written to the shared folder, one after the other.
    """
    a, b = links.columns
    pairs = links.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).filter("a <> b")
    stars = stored(pairs.dropna().mapInArrow(trimmed(_local), "a long, b long"))
    while not _settled(stars):
        both = stars.union(stars.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", "m"))
        stars = stored(small.filter("a <> b").distinct(), replaces=stars)
    return stars.select(F.col("a").alias("node"), F.col("b").alias("root"))
