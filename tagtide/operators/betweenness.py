"""Betweenness centrality as rounds of joins over (source, node) rows, exact or to a stated error.

The weight of an edge is its length. For each source: shortest distances by repeated
relaxation, the edges that lie on shortest paths, the number of paths to each node,
and from those the share of paths through each node (Brandes 2001). Sources are
handled in groups, so that the state of one group stays below a set size; the
sum over all groups is exact.

The estimate draws sources at random until every node's error is bounded. A source's part in a
node's betweenness lies between 0 and 1, so its mean over all sources is within

    sqrt(2 V ln(4 / d) / m) + 7 ln(4 / d) / (3 (m - 1))

of the mean over m draws with probability 1 - d, V their variance (Maurer and Pontil 2009). The
draws double from round to round, and d is shared out over all nodes and rounds.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagtide.operators.graph import Links, adjacency, dense_index, node_degrees
from tagtide.operators.skew import spread_join
from tagtide.session import cut_lineage

STATE_ROWS = 2_000_000_000
# Draws of the first round of an estimate.
FIRST_DRAWS = 64


def _join(links: Links, few: DataFrame, many: DataFrame, node: str, far: str) -> DataFrame:
    """``many`` (edges per source) joined to one row per source and node; the edges of a hub are cut in blocks."""
    if links.hot is None:
        return many.join(few, ["s", node])
    return spread_join(few, many, ["s", node], [far])


def _distances(links: Links, sources: DataFrame) -> DataFrame:
    """``s, u, d``: length of the shortest path from each source to each node."""
    state = sources.select("s", F.col("s").alias("u"), F.lit(0).cast("bigint").alias("d"), F.lit(True).alias("changed"))
    while True:
        steps = links.follow(state.filter("changed").select("s", "u", "d")).select(
            "s", F.col("v").alias("u"), (F.col("d") + F.col("w")).alias("d"), F.lit(None).cast("bigint").alias("old")
        )
        known = state.select("s", "u", "d", F.col("d").alias("old"))
        state = cut_lineage(
            known.unionByName(steps)
            .groupBy("s", "u")
            .agg(F.min("d").alias("d"), F.min("old").alias("old"))
            .select("s", "u", "d", (F.col("old").isNull() | (F.col("d") < F.col("old"))).alias("changed")),
            replaces=state,
        )
        if state.filter("changed").isEmpty():
            return state.select("s", "u", "d")


def _shortest_edges(links: Links, dist: DataFrame) -> DataFrame:
    """``s, u, v``: the edges that lie on a shortest path from ``s``."""
    ends = dist.select("s", F.col("u").alias("v"), F.col("d").alias("dv"))
    steps = _join(links, ends, links.follow(dist), "v", "u")
    return cut_lineage(steps.filter(F.col("d") + F.col("w") == F.col("dv")).select("s", "u", "v"))


def _sum_of_rounds(rounds: list[DataFrame], keys: list[str], value: str) -> DataFrame:
    return reduce(DataFrame.unionByName, rounds).groupBy(*keys).agg(F.sum(value).alias(value))


def _path_counts(links: Links, dag: DataFrame, sources: DataFrame) -> DataFrame:
    """``s, u, paths``: number of shortest paths; rounds follow the path length in edges."""
    front = sources.select("s", F.col("s").alias("u"), F.lit(1.0).alias("paths"))
    rounds = []
    while not front.isEmpty():
        rounds.append(front)
        front = cut_lineage(
            _join(links, front, dag, "u", "v").groupBy("s", F.col("v").alias("u")).agg(F.sum("paths").alias("paths"))
        )
    return cut_lineage(_sum_of_rounds(rounds, ["s", "u"], "paths"))


def _dependencies(links: Links, dag: DataFrame, paths: DataFrame, keys: list[str]) -> DataFrame | None:
    """``keys, share``: the parts of nodes in the shortest paths of these sources, per node ``u`` or per ``s, u``."""
    ends = paths.select("s", F.col("u").alias("v"), F.col("paths").alias("paths_v"))
    both = _join(links, ends, _join(links, paths, dag.filter("u <> s"), "u", "v"), "v", "u")
    ratios = cut_lineage(both.select("s", "u", "v", (F.col("paths") / F.col("paths_v")).alias("ratio")))
    front = ratios.groupBy("s", "u").agg(F.sum("ratio").alias("share"))
    rounds = []
    while True:
        front = cut_lineage(front)
        if front.isEmpty():
            break
        rounds.append(front.groupBy(*keys).agg(F.sum("share").alias("share")))
        back = front.select("s", F.col("u").alias("v"), "share")
        front = _join(links, back, ratios, "v", "u").groupBy("s", "u").agg(
            F.sum(F.col("ratio") * F.col("share")).alias("share")
        )
    return _sum_of_rounds(rounds, keys, "share") if rounds else None


def _grouped(links: Links, pivots: DataFrame, rows: int, state_rows: int, keys: list[str]) -> list[DataFrame]:
    """``keys, share`` of the sources ``s``, group by group; ``rows`` (source, node) rows in all."""
    groups, totals = max(1, math.ceil(rows / state_rows)), []
    for group in range(groups):
        chosen = pivots.filter(F.pmod(F.xxhash64("s"), F.lit(groups)) == group)
        dag = _shortest_edges(links, _distances(links, chosen))
        found = _dependencies(links, dag, _path_counts(links, dag, chosen), keys)
        if found is not None:
            totals.append(cut_lineage(found))
    return totals


def error_bound(mean: Column, square: Column, draws: int, doubt: float) -> Column:
    """How far the mean of ``draws`` values from 0 to 1 may be off, but for a probability of ``doubt``."""
    log = math.log(4 / doubt)
    variance = F.greatest(F.lit(0.0), (square - mean * mean) * (draws / (draws - 1)))
    return F.sqrt(2 * variance * log / draws) + 7 * log / (3 * (draws - 1))


def betweenness_within(
    edges: DataFrame, error: float = 0.05, doubt: float = 0.1, seed: int = 1, state_rows: int = STATE_ROWS
) -> DataFrame:
    """``hashtag, betweenness_centrality, error_bound, draws``: an estimate that stops by itself.

    With probability 1 - ``doubt`` no node is off by more than its ``error_bound``, and none of
    these exceeds ``error``. The number of draws depends on ``error`` and on how much sources differ,
    on the number of nodes only by its logarithm. Once there would be as many draws as nodes, the
    exact result is cheaper and is returned, with a bound of 0.
    """
    nodes = cut_lineage(node_degrees(edges).select("hashtag"))
    n = nodes.count()

    def exact() -> DataFrame:
        found = betweenness(edges, state_rows=state_rows)
        return found.withColumns({"error_bound": F.lit(0.0), "draws": F.lit(n)})

    draws, done, rounds, parts = FIRST_DRAWS, 0, 0, []
    if n <= 2 or draws >= n:
        return exact()
    links = Links(adjacency(edges.filter("src <> dst")))
    numbered = cut_lineage(dense_index(nodes, "hashtag", "i"))
    while draws < n:
        rounds += 1
        # A source that is drawn twice counts twice and is followed once a round.
        pick = F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(n)).cast("int").alias("i")
        drawn = edges.sparkSession.range(done, draws).select(pick).groupBy("i").agg(F.count(F.lit(1)).alias("times"))
        sources = cut_lineage(drawn.join(numbered, "i").select(F.col("hashtag").alias("s"), "times"))
        shares = _grouped(links, sources.select("s"), (draws - done) * n, state_rows, ["s", "u"])
        value = F.col("share") / (n - 2)
        for found in shares:
            moments = found.join(F.broadcast(sources), "s").groupBy("u").agg(
                F.sum(F.col("times") * value).alias("x"), F.sum(F.col("times") * value * value).alias("xx")
            )
            parts.append(cut_lineage(moments))
        none = nodes.select(F.col("hashtag").alias("u"), F.lit(0.0).alias("x"), F.lit(0.0).alias("xx"))
        sums = reduce(DataFrame.unionByName, [none, *parts]).groupBy("u").agg(F.sum("x").alias("x"), F.sum("xx").alias("xx"))
        mean, square = F.col("x") / draws, F.col("xx") / draws
        # Of all rounds the first takes half of the doubt, the next a quarter, and so on.
        bound = error_bound(mean, square, draws, doubt / 2**rounds / n)
        scale = n / (n - 1)
        estimate = cut_lineage(
            sums.select(
                F.col("u").alias("hashtag"),
                (mean * scale).alias("betweenness_centrality"),
                (bound * scale).alias("error_bound"),
                F.lit(draws).alias("draws"),
            )
        )
        if estimate.agg(F.max("error_bound")).first()[0] <= error:
            return estimate
        done, draws = draws, 2 * draws
    return exact()


def betweenness(
    edges: DataFrame, sources: DataFrame | None = None, state_rows: int = STATE_ROWS
) -> DataFrame:
    """Share of shortest paths through each node, over ordered pairs of other nodes.

    ``sources`` (a column ``hashtag``) asks for an estimate from those pivots only,
    scaled to all nodes (Brandes and Pich 2007). The default is exact. ``state_rows``
    bounds the (source, node) rows one group of sources may hold. The exact result takes a row
    per pair of nodes in all, and as many groups one after the other: a graph of a million
    tags calls for ``betweenness_within``.
    """
    nodes = cut_lineage(node_degrees(edges).select("hashtag"))
    n = nodes.count()
    zero = nodes.select(F.col("hashtag"), F.lit(0.0).alias("betweenness_centrality"))
    if n <= 2:
        return zero
    links = Links(adjacency(edges.filter("src <> dst")))
    pivots = nodes if sources is None else cut_lineage(nodes.join(sources.select("hashtag").distinct(), "hashtag"))
    n_pivots = n if sources is None else pivots.count()
    if n_pivots == 0:
        return zero

    totals = _grouped(links, pivots.select(F.col("hashtag").alias("s")), n_pivots * n, state_rows, ["u"])
    if not totals:
        return zero
    scale = (n / n_pivots) / ((n - 1) * (n - 2))
    summed = _sum_of_rounds(totals, ["u"], "share").withColumnRenamed("u", "hashtag")
    return nodes.join(summed, "hashtag", "left").select(
        "hashtag", F.coalesce(F.col("share") * scale, F.lit(0.0)).alias("betweenness_centrality")
    )
