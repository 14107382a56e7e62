"""Louvain communities as rounds of joins (Blondel et al. 2008).

In one round every node compares its own community with those of its neighbours and
half of the nodes, chosen by a hash of node and round, may move to the best one; the
other half stays, which keeps neighbours from swapping places for ever. When no move
is left, communities become the nodes of a smaller graph and the rounds start again.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagtide.operators.graph import Links, adjacency, dense_index
from tagtide.operators.skew import hot_keys, spread, spread_join
from tagtide.session import cut_lineage

EPS = 1e-12
# Rounds without a gain of ``threshold`` that end a level: each node has had its turn twice.
PATIENCE = 4


def _level_links(adj: DataFrame) -> Links:
    """The links between different nodes, with the strength ``kv`` of the far end.

    Each node also has a link without weight to itself. It carries the node's own
    community along and the weight ``loop`` of its self-loop.
    """
    loop = F.col("u") == F.col("v")
    strength = adj.groupBy("u").agg(
        F.sum(F.when(loop, 2 * F.col("w")).otherwise(F.col("w"))).alias("kv"),
        F.sum(F.when(loop, F.col("w")).otherwise(F.lit(0.0))).alias("loop"),
    )
    own = strength.select("u", F.col("u").alias("v"), F.lit(None).cast("double").alias("w"), "kv", "loop")
    ends = strength.select(F.col("u").alias("v"), "kv")
    between = spread_join(ends, adj.filter(~loop), ["v"], ["u"]).select(
        "u", "v", "w", "kv", F.lit(0.0).alias("loop")
    )
    return Links(between.unionByName(own))


def _assess(links: Links, comm: DataFrame, m2: float, resolution: float) -> DataFrame:
    """Per node: its community, the best other community, both gains, its inner weight.

    The gain of community C is the weight of the links into C, less
    ``resolution * strength * (strength of C without the node) / m2``.
    """
    totals = comm.groupBy("c").agg(F.sum("k").alias("tot"), F.count(F.lit(1)).alias("rows"))
    if links.hot is None:
        placed = comm.join(totals, "c").select("u", "c", "tot")
    else:
        # Nodes of one large community are dealt to blocks before they look up its total.
        few, many = spread(totals.drop("rows"), comm, hot_keys(totals, ["c"], "rows"), ["c"], ["u"])
        placed = many.join(few, ["c", "block"]).select("u", "c", "tot")
    here = F.col("w").isNull()
    near = (
        links.follow(placed)
        .groupBy(F.col("v").alias("u"), "c", F.col("kv").alias("k"))
        .agg(
            F.coalesce(F.sum("w"), F.lit(0.0)).alias("kin"),
            F.max("tot").alias("tot"),
            F.max(here).alias("own"),
            F.sum("loop").alias("loop"),
        )
    )
    rest = F.col("tot") - F.when(F.col("own"), F.col("k")).otherwise(F.lit(0.0))
    gain = F.col("kin") - resolution * F.col("k") * rest / m2
    mine, other = F.col("own"), ~F.col("own")
    # Equal gains go to the smallest name: the least of (-gain, name).
    return (
        near.withColumn("gain", gain)
        .groupBy("u", "k")
        .agg(
            F.max(F.when(mine, F.col("c"))).alias("c"),
            F.max(F.when(mine, F.col("gain"))).alias("own_gain"),
            F.max(F.when(mine, F.col("kin") + 2 * F.col("loop"))).alias("inner"),
            F.min(F.when(other, F.struct((-F.col("gain")).alias("loss"), F.col("c").alias("c")))).alias("best"),
        )
        .select("u", "k", "c", "own_gain", "inner", F.col("best.c").alias("best"), (-F.col("best.loss")).alias("best_gain"))
    )


def _measure(assessed: DataFrame, wants: Column, m2: float, resolution: float) -> tuple[float, int]:
    """Modularity of the communities, and how many nodes want to move."""
    per = assessed.groupBy("c").agg(
        F.sum("inner").alias("inner"), F.sum("k").alias("tot"), F.count_if(wants).alias("wanting")
    )
    part = F.col("inner") / m2 - resolution * F.pow(F.col("tot") / m2, F.lit(2))
    return per.agg(F.sum(part), F.sum("wanting")).first()


def modularity(edges: DataFrame, communities: DataFrame, resolution: float = 1.0) -> float:
    """Modularity of a partition ``hashtag, community_id``."""
    adj = adjacency(edges).withColumn("w", F.when(F.col("u") == F.col("v"), 2 * F.col("w")).otherwise(F.col("w")))
    a = communities.select(F.col("hashtag").alias("u"), F.col("community_id").alias("cu"))
    b = communities.select(F.col("hashtag").alias("v"), F.col("community_id").alias("cv"))
    per = adj.join(a, "u").join(b, "v").groupBy("cu").agg(
        F.sum(F.when(F.col("cu") == F.col("cv"), F.col("w")).otherwise(F.lit(0))).alias("inner"), F.sum("w").alias("tot")
    )
    m2 = adj.agg(F.sum("w")).scalar()
    return per.agg(F.sum(F.col("inner") / m2 - resolution * F.pow(F.col("tot") / m2, F.lit(2)))).first()[0]


def _one_level(
    adj: DataFrame, m2: float, resolution: float, threshold: float, patience: int
) -> tuple[DataFrame, bool]:
    """``u, c`` after the moves of one level, and whether any node moved.

    Modularity is at most one, and ``patience`` rounds have to gain ``threshold``, so a level ends
    by itself; no number of rounds cuts it off.
    """
    links = _level_links(adj)
    comm = cut_lineage(links.table.filter("w IS NULL").select("u", F.col("u").alias("c"), F.col("kv").alias("k")))
    wants = F.col("best").isNotNull() & (F.col("best_gain") > F.col("own_gain") + EPS)
    start, history = comm, []
    best_comm, best_q = comm, None
    for round_no in count():
        assessed = cut_lineage(_assess(links, comm, m2, resolution))
        q, wanting = _measure(assessed, wants, m2, resolution)
        if best_q is None or q > best_q + threshold:
            best_comm, best_q = comm, q
        stuck = len(history) >= patience and best_q <= max(history[: len(history) - patience + 1]) + threshold
        history.append(q)
        if wanting == 0 or stuck:
            break
        # A bit of the node's hash decides; the other half has its turn one round later.
        bit = F.shiftright(F.xxhash64("u"), round_no // 2 % 60).bitwiseAND(F.lit(1))
        turn = bit == round_no % 2
        comm = assessed.select("u", F.when(wants & turn, F.col("best")).otherwise(F.col("c")).alias("c"), "k")
    return best_comm.select("u", "c"), best_comm is not start


def _contract(adj: DataFrame, comm: DataFrame) -> DataFrame:
    """The graph of the communities; links inside one become its self-loop."""
    ends = comm.select(F.col("u").alias("v"), F.col("c").alias("cv"))
    # Hubs are cut in blocks, once by each end.
    joined = spread_join(ends, spread_join(comm, adj, ["u"], ["v"]), ["v"], ["u"])
    # A link inside a community is seen from both ends, a self-loop once.
    weight = F.when((F.col("c") == F.col("cv")) & (F.col("u") != F.col("v")), F.col("w") / 2).otherwise(F.col("w"))
    return joined.groupBy(F.col("c").alias("u"), F.col("cv").alias("v")).agg(F.sum(weight).alias("w"))


def communities(
    edges: DataFrame, resolution: float = 1.0, threshold: float = 1e-7, patience: int = PATIENCE
) -> DataFrame:
    """``hashtag, community_id``. Ids count up by the smallest member, so they are stable.

    A level ends when no node wants to move, or when ``patience`` rounds together gain less than
    ``threshold`` in modularity although some still do; it keeps the best round.
    """
    adj = cut_lineage(adjacency(edges).withColumn("w", F.col("w").cast("double")))
    m2 = adj.agg(F.sum(F.when(F.col("u") == F.col("v"), 2 * F.col("w")).otherwise(F.col("w")))).first()[0]
    if not m2:
        return edges.select(F.col("src").alias("hashtag"), F.lit(None).cast("int").alias("community_id")).limit(0)
    member = cut_lineage(adj.select(F.col("u").alias("hashtag"), F.col("u").alias("c")).distinct())
    while True:
        comm, moved = _one_level(adj, m2, resolution, threshold, patience)
        if not moved:
            break
        step = comm.select(F.col("u").alias("c"), F.col("c").alias("to"))
        member = cut_lineage(spread_join(step, member, ["c"], ["hashtag"]).select("hashtag", F.col("to").alias("c")))
        adj = cut_lineage(_contract(adj, comm))
    names = member.groupBy("c").agg(F.min("hashtag").alias("first_member"))
    ids = dense_index(names, "first_member", "community_id").select("c", "community_id")
    return spread_join(ids, member, ["c"], ["hashtag"]).select("hashtag", "community_id")
