"""Graph jobs against direct computation on small graphs."""

import heapq
import itertools
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tagtide.operators import graph
from tagtide.operators import betweenness as paths
from tagtide.operators.betweenness import betweenness, betweenness_within
from tagtide.operators.communities import communities, modularity
from tagtide.operators.graph import dense_index

AS_OF = "2024-01-31 00:00:00"


def edge_table(spark, rows):
    return spark.createDataFrame(rows, "src string, dst string, weight bigint")


def post_table(spark, rows):
    df = spark.createDataFrame(rows, "user_name string, hashtag string")
    return df.withColumn("processing_time", F.lit("2024-01-30 12:00:00").cast("timestamp_ntz"))


def naive_edges(rows):
    by_user, weights = defaultdict(list), Counter()
    for user, tag in rows:
        by_user[user].append(tag)
    for tags in by_user.values():
        for a, b in itertools.combinations(tags, 2):
            weights[tuple(sorted((a, b)))] += 1
    return {(*pair, w) for pair, w in weights.items()}


def brandes(edges):
    """Betweenness by Dijkstra from every node."""
    near = defaultdict(dict)
    for a, b, w in edges:
        if a != b:
            near[a][b] = near[b][a] = w
    nodes = sorted({x for a, b, _ in edges for x in (a, b)})
    total = dict.fromkeys(nodes, 0.0)
    for s in nodes:
        dist, done, paths, before = {s: 0}, [], Counter({s: 1}), defaultdict(list)
        heap, seen = [(0, s)], set()
        while heap:
            d, u = heapq.heappop(heap)
            if u in seen:
                continue
            seen.add(u)
            done.append(u)
            for v, w in near[u].items():
                if d + w < dist.get(v, float("inf")):
                    dist[v] = d + w
                    heapq.heappush(heap, (d + w, v))
        paths = Counter({s: 1})
        for u in done:
            for v, w in near[u].items():
                if dist[u] + w == dist[v]:
                    paths[v] += paths[u]
                    before[v].append(u)
        share = Counter()
        for v in reversed(done):
            for u in before[v]:
                share[u] += paths[u] / paths[v] * (1 + share[v])
            if v != s:
                total[v] += share[v]
    n = len(nodes)
    return {v: x / ((n - 1) * (n - 2)) for v, x in total.items()}


def random_graph(seed, n=12, p=0.35, heaviest=4):
    rng = random.Random(seed)
    names = [f"t{i:02d}" for i in range(n)]
    return [(a, b, rng.randint(1, heaviest)) for a, b in itertools.combinations(names, 2) if rng.random() < p]


def test_known_users(spark):
    rows = [("u1", "a"), ("u1", "b"), ("u1", "a"), ("u2", "a"), ("u2", "b"), ("u3", "c")]
    edges = graph.cooccurrence_edges(post_table(spark, rows), AS_OF)
    assert {tuple(r) for r in edges.collect()} == {("a", "b", 3), ("a", "a", 1)}
    assert {r.hashtag: r.degree_centrality for r in graph.degree_centrality(edges).collect()} == {"a": 3.0, "b": 1.0}
    ranks = {r.hashtag: r.pagerank for r in graph.pagerank(edges).collect()}
    assert ranks["a"] == pytest.approx(0.56489, abs=1e-5) and ranks["b"] == pytest.approx(0.43511, abs=1e-5)
    assert {r.betweenness_centrality for r in betweenness(edges).collect()} == {0.0}


@pytest.mark.parametrize("block", [2000, 2])
def test_edges_equal_the_loop(spark, block):
    """Also with users cut in many blocks, and with users without a name."""
    rng = random.Random(7)
    users = ["hot"] * 6 + ["u1", "u2", "u3", None]
    rows = [(rng.choice(users), f"t{rng.randint(0, 9)}") for _ in range(150)]
    got = graph.cooccurrence_edges(post_table(spark, rows), AS_OF, tags_per_block=block)
    assert {tuple(r) for r in got.collect()} == naive_edges(rows)


@pytest.mark.parametrize("c, expected", [(5, {"a": 0.0, "b": 1.0, "c": 0.0}), (2, {"a": 0.0, "b": 0.5, "c": 0.0})])
def test_betweenness_of_a_triangle(spark, c, expected):
    found = betweenness(edge_table(spark, [("a", "b", 1), ("b", "c", 1), ("a", "c", c)]))
    assert {r.hashtag: r.betweenness_centrality for r in found.collect()} == expected


def test_betweenness_equals_dijkstra(spark, monkeypatch):
    """In three groups of sources, and with every node cut in blocks."""
    monkeypatch.setattr(graph, "EDGES_PER_BLOCK", 3)
    monkeypatch.setattr(graph.Links.__init__, "__defaults__", (3,))
    rows = random_graph(3)
    nodes = {x for a, b, _ in rows for x in (a, b)}
    found = betweenness(edge_table(spark, rows), state_rows=len(nodes) ** 2 // 3 + 1)
    got = {r.hashtag: r.betweenness_centrality for r in found.collect()}
    assert got == pytest.approx(brandes(rows))


def test_pivots_of_all_nodes_are_exact(spark):
    rows = [("a", "b", 1), ("b", "c", 1), ("c", "d", 1)]
    pivots = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "hashtag string")
    got = betweenness(edge_table(spark, rows), pivots)
    assert {r.hashtag: round(r.betweenness_centrality, 6) for r in got.collect()} == pytest.approx(
        {k: round(v, 6) for k, v in brandes(rows).items()}
    )


def test_hub_edges_are_split(spark, monkeypatch):
    """Every (source, node) cut in blocks of two edges."""
    from tagtide.operators import skew

    monkeypatch.setattr(graph.Links.__init__, "__defaults__", (2,))
    monkeypatch.setattr(paths, "spread_join", lambda *a: skew.spread_join(*a, block_rows=2))
    rows = random_graph(4, n=7)
    got = {r.hashtag: r.betweenness_centrality for r in betweenness(edge_table(spark, rows)).collect()}
    assert got == pytest.approx(brandes(rows))


def test_estimate_within_its_bound(spark, monkeypatch):
    monkeypatch.setattr(paths, "FIRST_DRAWS", 40)
    rows = [("c", f"h{i}", 1) for i in range(10)] + [(f"h{i}", f"l{i}{j}", 1 + j % 2) for i in range(10) for j in range(12)]
    expected = brandes(rows)
    got = betweenness_within(edge_table(spark, rows), error=0.8, doubt=0.1).collect()
    assert {r.hashtag for r in got} == set(expected)
    assert all(abs(r.betweenness_centrality - expected[r.hashtag]) <= r.error_bound <= 0.8 for r in got)
    assert {r.draws for r in got} in ({40}, {80})


def test_estimate_that_would_need_every_source_is_exact(spark, monkeypatch):
    monkeypatch.setattr(paths, "FIRST_DRAWS", 4)
    rows = random_graph(6)
    got = betweenness_within(edge_table(spark, rows), error=0.01).collect()
    assert {r.hashtag: r.betweenness_centrality for r in got} == pytest.approx(brandes(rows))
    assert {r.error_bound for r in got} == {0.0}
    assert betweenness_within(edge_table(spark, [])).collect() == []


def test_bound_holds_for_random_means(spark):
    rng = random.Random(5)
    misses = 0
    for _ in range(60):
        values = [rng.random() ** 4 for _ in range(500)]
        draws = [rng.choice(values) for _ in range(80)]
        mean, square = sum(draws) / 80, sum(x * x for x in draws) / 80
        (bound,) = spark.range(1).select(paths.error_bound(F.lit(mean), F.lit(square), 80, 0.1)).first()
        misses += abs(mean - sum(values) / 500) > bound
    assert misses <= 6


def test_pagerank_with_hubs(spark, monkeypatch):
    rows = random_graph(5) + [("t00", "t00", 2)]
    plain = {r.hashtag: r.pagerank for r in graph.pagerank(edge_table(spark, rows)).collect()}
    monkeypatch.setattr(graph.Links.__init__, "__defaults__", (2,))
    cut = {r.hashtag: r.pagerank for r in graph.pagerank(edge_table(spark, rows)).collect()}
    assert cut == pytest.approx(plain)
    assert sum(plain.values()) == pytest.approx(1.0)


def test_pagerank_fails_without_convergence(spark):
    with pytest.raises(RuntimeError):
        graph.pagerank(edge_table(spark, random_graph(5)), tol=0.0, max_iter=3)


def test_two_cliques(spark, monkeypatch):
    monkeypatch.setattr(graph.Links.__init__, "__defaults__", (4,))
    rows = [(a, b, 1) for q in ("abcd", "wxyz") for a, b in itertools.combinations(q, 2)] + [("d", "w", 1)]
    found = {r.hashtag: r.community_id for r in communities(edge_table(spark, rows)).collect()}
    assert found == {**dict.fromkeys("abcd", 0), **dict.fromkeys("wxyz", 1)}


def test_communities_beat_single_nodes(spark):
    rows = random_graph(11, n=20, p=0.2) + [("t01", "t01", 3)]
    edges = edge_table(spark, rows)
    found = communities(edges)
    nodes = sorted({x for a, b, _ in rows for x in (a, b)})
    assert sorted(r.hashtag for r in found.collect()) == nodes
    alone = spark.createDataFrame([(x, i) for i, x in enumerate(nodes)], "hashtag string, community_id int")
    assert modularity(edges, found) > modularity(edges, alone)


def test_empty_graph(spark):
    none = edge_table(spark, [])
    for job in (graph.degree_centrality, graph.pagerank, betweenness, communities, graph.centrality):
        assert job(none).count() == 0


def test_dense_index(spark):
    df = spark.createDataFrame([(f"n{i:03d}",) for i in range(300)], "name string").repartition(7)
    got = {r.name: r.i for r in dense_index(df, "name", "i").collect()}
    assert got == {f"n{i:03d}": i for i in range(300)}
