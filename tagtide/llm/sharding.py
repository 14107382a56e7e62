"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Every row has a place on the ring. A shard owns the arcs that end at its virtual nodes and
takes the rows on them until it is full; what it cannot take continues clockwise to the next
virtual node whose shard has room. The rooms add up to the number of rows, so counts are at
most one apart, and only the excess of full shards moves.

Rows of an arc are alike to the ring except for their order, so the walk needs no more than
the number of rows on each arc. It ends in a short list: rows ``first`` to ``last`` of this arc
go to that shard. Ranks come from counts of narrow buckets, so no task holds an arc.
"""

from __future__ import annotations

import bisect
from collections import deque

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tagtide.llm.common import mix64, parts_for, stored, table

#: The ring has this many places and 4,096 cells to look nodes up by; shards have VIRTUAL_NODES each.
RING, CELL_BITS, VIRTUAL_NODES, BUCKET_ROWS = 1 << 60, 48, 128, 50_000


def ring(shards: int, virtual_nodes: int = VIRTUAL_NODES) -> list[tuple[int, int]]:
    """``(place, shard)`` of every virtual node, clockwise. Nodes depend on the shard's number only."""
    place = mix64(np.arange(shards * virtual_nodes, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(4)
    return sorted((int(p), i // virtual_nodes) for i, p in enumerate(place))


def cells_of(nodes: list[tuple[int, int]]) -> list[tuple[int, int, list[int]]]:
    """For each cell of the ring: the number of nodes before it and the nodes in it."""
    places = [p for p, _ in nodes]
    edges = [bisect.bisect_left(places, c << CELL_BITS) for c in range((RING >> CELL_BITS) + 1)]
    return [(c, edges[c], places[edges[c] : edges[c + 1]]) for c in range(RING >> CELL_BITS)]


def bounded_walk(nodes: list[tuple[int, int]], load: list[int], shards: int) -> list[tuple[int, int, int, int]]:
    """``(arc, first, last, shard)``: where rows ``first <= rank < last`` of each arc go.

    ``load`` counts the rows of the arc that ends at each node. Each shard has room for its
    equal part; rows that do not divide go to the shards with the largest own load. Shards
    first take rows of their own arcs in order; the excess then walks on clockwise.
    """
    total, own = sum(load), [0] * shards
    for (_, shard), n in zip(nodes, load):
        own[shard] += n
    room = [total // shards] * shards
    for shard in sorted(range(shards), key=lambda s: (-own[s], s))[: total % shards]:
        room[shard] += 1
    placed, excess = [], [0] * len(nodes)
    for arc, (_, shard) in enumerate(nodes):
        taken = min(load[arc], room[shard])
        room[shard] -= taken
        excess[arc] = load[arc] - taken
        if taken:
            placed.append((arc, 0, taken, shard))
    walking: deque[tuple[int, int, int]] = deque()
    for step in range(2 * len(nodes)):
        arc, shard = step % len(nodes), nodes[step % len(nodes)][1]
        while walking and room[shard]:
            origin, first, last = walking.popleft()
            taken = min(last - first, room[shard])
            room[shard] -= taken
            placed.append((origin, first, first + taken, shard))
            if first + taken < last:
                walking.appendleft((origin, first + taken, last))
        if step < len(nodes) and excess[arc]:
            walking.append((arc, load[arc] - excess[arc], load[arc]))
    return placed


def shard_rows(
    docs: DataFrame, shards: int, id_column: str = "doc_id", text: str = "text", virtual_nodes: int = VIRTUAL_NODES
) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard``, one row per row of ``docs``.

    Law ``rows``: counts of shards differ by one at most. The place of a row follows from its
    id, size and checksum, so repeated ids with different texts spread too, and a null id or
    text needs no special case (size 8 and checksum 0 for null). Slots count the rows of a
    shard from 0 without gaps. ``grown_shard`` is null: it belongs to another law.
    """
    text_bytes = F.encode(F.coalesce(F.col(text), F.lit("")), "utf-8")
    rows = stored(
        docs.select(
            F.col(id_column).alias("doc_id"),
            (F.octet_length(F.coalesce(F.col(text), F.lit(""))).cast("long") + 8).alias("size"),
            F.crc32(text_bytes).alias("text_crc32"),
        ).withColumn("place", F.shiftrightunsigned(F.xxhash64("doc_id", "size", "text_crc32"), 4))
    )
    spark = docs.sparkSession
    # Buckets are equal parts of the ring; a bucket that holds a node is cut at the node.
    nodes = ring(shards, virtual_nodes)
    narrow = 61 - parts_for(rows.count(), BUCKET_ROWS).bit_length()
    cells = F.broadcast(spark.createDataFrame(cells_of(nodes), "cell long, base int, nodes array<long>"))
    rows = (
        rows.withColumn("cell", F.shiftright("place", CELL_BITS))
        .join(cells, "cell")
        .withColumn("arc", F.expr(f"(base + size(filter(nodes, p -> p < place))) % {len(nodes)}"))
        .withColumn("bucket", F.shiftright("place", narrow))
        .drop("cell", "base", "nodes")
    )
    sizes = rows.groupBy("arc", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("arc").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = stored(sizes.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))))
    load = [0] * len(nodes)
    for arc, n in starts.groupBy("arc").agg(F.sum("n")).collect():  # one row per virtual node at most
        load[arc] = n
    placed, slots = [], [0] * shards
    for arc, first, last, shard in sorted(bounded_walk(nodes, load, shards), key=lambda x: (x[3], x[0], x[1])):
        placed.append((arc, first, last, shard, slots[shard]))
        slots[shard] += last - first
    pieces = spark.createDataFrame(placed, "arc int, first long, last long, shard int, slot0 long")
    rank = Window.partitionBy("arc", "bucket").orderBy("place", "doc_id", "size", "text_crc32")
    ranked = rows.withColumn("rank", F.row_number().over(rank) - 1).join(starts, ["arc", "bucket"])
    ranked = ranked.withColumn("rank", F.col("rank") + F.col("before"))
    # At most one piece per arc and one more per shard: the list has a fixed bound.
    here = (ranked["arc"] == pieces["arc"]) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("last"))
    return ranked.join(F.broadcast(pieces), here).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        (F.col("slot0") + F.col("rank") - F.col("first")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_rows(table(spark, sf_dir, "documents"), 24)
