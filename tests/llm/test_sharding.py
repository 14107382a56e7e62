import random
import zlib
from collections import Counter

import pytest
from helpers import SCHEMA, documents, texts

from tagtide.llm.sharding import bounded_walk, ring, shard_rows


@pytest.mark.parametrize("seed", range(4))
def test_walk_fills_shards_evenly_and_moves_only_the_excess(seed):
    rnd, shards = random.Random(seed), 5
    nodes = ring(shards, 16)
    load = [rnd.randrange(40) for _ in nodes]
    placed = bounded_walk(nodes, load, shards)
    assert sum(b - a for _, a, b, _ in placed) == sum(load)
    for arc, n in enumerate(load):
        spans = sorted((a, b) for x, a, b, _ in placed if x == arc)
        assert [0, *[b for _, b in spans]] == [*[a for a, _ in spans], n]
    counts = Counter()
    for _, a, b, s in placed:
        counts[s] += b - a
    assert max(counts.values()) - min(counts[s] for s in range(shards)) <= 1
    own = Counter()
    for (_, s), n in zip(nodes, load):
        own[s] += n
    moved = sum(b - a for arc, a, b, s in placed if nodes[arc][1] != s)
    assert moved == sum(max(0, own[s] - counts[s]) for s in range(shards))


def test_nodes_of_a_shard_do_not_depend_on_the_others():
    few, many = set(ring(5, 16)), set(ring(6, 16))
    assert few < many and all(s == 5 for _, s in many - few)


def test_rows_and_slots(spark):
    rows = texts()
    got = shard_rows(documents(spark), 7, virtual_nodes=8).collect()
    expected = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == expected
    by_shard = {s: sorted(r.slot for r in got if r.shard == s) for s in range(7)}
    assert all(slots == list(range(len(slots))) for slots in by_shard.values())
    sizes = [len(s) for s in by_shard.values()]
    assert max(sizes) - min(sizes) <= 1 and {r.law for r in got} == {"rows"}
    again = shard_rows(documents(spark).repartition(5), 7, virtual_nodes=8).collect()
    key = lambda r: (r.doc_id or -1, r.shard, r.slot)
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_empty_table(spark):
    assert shard_rows(spark.createDataFrame([], SCHEMA), 24).collect() == []
