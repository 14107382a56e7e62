"""The hashtag co-occurrence graph: edges, degree, PageRank.

Edges are undirected with ``src <= dst``; ``src = dst`` is a self-loop. A tag is a
node only if it has an edge. An empty edge table gives an empty result everywhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagtide.functions.times import AsOf, since
from tagtide.operators.skew import count_by, hot_keys
from tagtide.session import cut_lineage, pin

TAGS_PER_BLOCK = 2_000
EDGES_PER_BLOCK = 100_000
EDGES_PER_PARTITION = 2_000_000
ROUNDS_PER_CHECK = 5


def cooccurrence_edges(
    posts: DataFrame, as_of: AsOf, time_window_hours: int = 24, tags_per_block: int = TAGS_PER_BLOCK
) -> DataFrame:
    """Edges between the tags a user posted in the window, weighted by pairs of rows.

    With ``c`` rows of a user for a tag, two tags meet ``c1 * c2`` times and a tag
    meets itself ``c * (c - 1) / 2`` times. So rows are counted per (user, tag)
    first, and only distinct tags of a user are paired: each pair is an edge of the
    result. The tags of a user with many are cut in blocks, and every pair of blocks
    is joined by itself, so no task holds all tags of one user.
    """
    recent = since(posts, as_of, f"{time_window_hours} hours").filter(F.col("hashtag").isNotNull())
    counts = recent.groupBy(F.col("user_name").alias("user"), F.col("hashtag").alias("tag")).agg(
        F.count(F.lit(1)).alias("c")
    )

    hot = hot_keys(count_by(counts, ["user"]), ["user"], "rows", tags_per_block)
    hot = hot.withColumnRenamed("user", "hot_user")
    n = F.coalesce(F.col("blocks"), F.lit(1))
    placed = counts.join(F.broadcast(hot), F.col("user").eqNullSafe(F.col("hot_user")), "left").select(
        "user", "tag", "c", n.alias("n"), F.pmod(F.xxhash64("tag"), n).cast("int").alias("b")
    )
    # Block b is the first of the pairs (b, b..n-1) and the second of the pairs (0..b, b).
    first = placed.select(
        F.col("user").alias("u1"), F.col("tag").alias("t1"), F.col("c").alias("c1"),
        F.col("b").alias("i1"), F.explode(F.sequence("b", F.col("n") - 1)).alias("j1"),
    )
    second = placed.select(
        F.col("user").alias("u2"), F.col("tag").alias("t2"), F.col("c").alias("c2"),
        F.explode(F.sequence(F.lit(0), F.col("b"))).alias("i2"), F.col("b").alias("j2"),
    )
    meet = (
        F.col("u1").eqNullSafe(F.col("u2"))
        & (F.col("i1") == F.col("i2"))
        & (F.col("j1") == F.col("j2"))
        & ((F.col("i1") < F.col("j1")) | (F.col("t1") < F.col("t2")))
    )
    between = first.join(second, meet).select(
        F.least("t1", "t2").alias("src"), F.greatest("t1", "t2").alias("dst"),
        (F.col("c1") * F.col("c2")).alias("weight"),
    )
    loops = counts.filter("c > 1").select(
        F.col("tag").alias("src"), F.col("tag").alias("dst"), F.expr("c * (c - 1) div 2").alias("weight")
    )
    return between.unionByName(loops).groupBy("src", "dst").agg(F.sum("weight").alias("weight"))


def node_degrees(edges: DataFrame) -> DataFrame:
    """``hashtag, degree``; a self-loop adds two."""
    return edges.select(F.explode(F.array("src", "dst")).alias("hashtag")).groupBy("hashtag").agg(
        F.count(F.lit(1)).alias("degree")
    )


def degree_centrality(edges: DataFrame) -> DataFrame:
    """Degree over ``n - 1``; 1 if there is only one node."""
    degrees = node_degrees(edges)
    n = degrees.agg(F.count(F.lit(1))).scalar()
    share = F.when(n <= 1, F.lit(1.0)).otherwise(F.try_divide(F.col("degree"), n - 1))
    return degrees.select("hashtag", share.cast("double").alias("degree_centrality"))


def adjacency(edges: DataFrame) -> DataFrame:
    """``u, v, w`` in both directions; a self-loop appears once."""
    there = edges.select(F.col("src").alias("u"), F.col("dst").alias("v"), F.col("weight").alias("w"))
    back = edges.filter("src <> dst").select(
        F.col("dst").alias("u"), F.col("src").alias("v"), F.col("weight").alias("w")
    )
    return there.unionByName(back)


def dense_index(df: DataFrame, column: str, name: str) -> DataFrame:
    """Number the rows 0, 1, 2, … in the order of a unique column.

    Rows are range-partitioned and numbered inside each partition; the sizes of the
    partitions give the offsets. No task sees more than its own range.
    """
    placed = cut_lineage(
        df.repartitionByRange(F.col(column)).withColumn("_part", F.spark_partition_id())
    )
    inside = Window.partitionBy("_part").orderBy(column)
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition of the job: bounded by spark.sql.shuffle.partitions.
    before = sizes.withColumn(
        "_before", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ).select("_part", "_before")
    numbered = placed.withColumn("_row", F.row_number().over(inside))
    return numbered.join(F.broadcast(before), "_part").select(
        *df.columns, (F.col("_before") + F.col("_row") - 1).cast("int").alias(name)
    )


class Links:
    """An adjacency that iterative jobs join their state to again and again.

    A small one is a written table of known size, so Catalyst may broadcast it. A
    large one is cut in blocks for hub nodes and kept partitioned by (u, block): only
    the state is shuffled, and the neighbours of a hub are spread over many tasks.
    """

    def __init__(self, adj: DataFrame, edges_per_block: int = EDGES_PER_BLOCK):
        table = cut_lineage(adj)
        rows = table.count()
        # Without more rows than one block there can be no hub.
        self.hot = None
        if rows > edges_per_block:
            self.hot = cut_lineage(hot_keys(count_by(table, ["u"]), ["u"], "rows", edges_per_block))
            blocks = F.coalesce(F.col("blocks"), F.lit(1))
            table = table.join(F.broadcast(self.hot), "u", "left").withColumn(
                "block", F.pmod(F.xxhash64("v"), blocks).cast("int")
            )
            default = int(adj.sparkSession.conf.get("spark.sql.shuffle.partitions"))
            parts = max(default, rows // EDGES_PER_PARTITION)
            table = pin(table.drop("blocks").repartition(parts, "u", "block"))
        self.table = table

    def follow(self, state: DataFrame) -> DataFrame:
        """``state`` (with a column ``u``) joined to the neighbours ``v, w`` of its nodes."""
        if self.hot is None:
            return state.join(self.table, "u")
        blocks = F.coalesce(F.col("blocks"), F.lit(1))
        copies = state.join(F.broadcast(self.hot), "u", "left").withColumn(
            "block", F.explode(F.sequence(F.lit(0), blocks - 1))
        )
        return copies.drop("blocks").join(self.table, ["u", "block"]).drop("block")


def pagerank(
    edges: DataFrame, alpha: float = 0.85, tol: float = 1e-6, max_iter: int = 100
) -> DataFrame:
    """Weighted PageRank by power iteration from ``1/n``.

    Stops when the ranks change by less than ``n * tol`` in total, and fails if they
    still do after ``max_iter`` rounds. Every node has an edge, so none dangles.
    """
    # A link without weight from each node to itself carries its own history along,
    # so that a round is one join and one aggregation.
    adj = adjacency(edges)
    own = adj.groupBy("u").agg(F.sum("w").alias("out")).select(
        "u", F.col("u").alias("v"), F.lit(None).cast("bigint").alias("w")
    )
    links = Links(adj.unionByName(own))
    state = cut_lineage(links.table.groupBy(F.col("u").alias("hashtag")).agg(F.sum("w").alias("out")))
    n = state.count()
    if n == 0:
        return state.select("hashtag", F.lit(None).cast("double").alias("pagerank"))
    # ``r0, r1, …`` hold the rank before and after each round since the last check.
    state, done = state.withColumn("r0", F.lit(1.0 / n)), 0
    stored = state
    while done < max_iter:
        rounds = min(ROUNDS_PER_CHECK, max_iter - done)
        for i in range(rounds):
            state = _pagerank_round(links, state, i, alpha, n)
        stored = state = cut_lineage(state, replaces=stored)
        done += rounds
        changes = state.agg(
            *[F.sum(F.abs(F.col(f"r{i + 1}") - F.col(f"r{i}"))).alias(f"change_{i}") for i in range(rounds)]
        ).first()
        for i, change in enumerate(changes):
            if change < n * tol:
                return state.select("hashtag", F.col(f"r{i + 1}").alias("pagerank"))
        state = state.select("hashtag", "out", F.col(f"r{rounds}").alias("r0"))
    raise RuntimeError(f"PageRank did not converge in {max_iter} rounds")


def _pagerank_round(links: Links, state: DataFrame, i: int, alpha: float, n: int) -> DataFrame:
    """Add the rank after round ``i``. Nodes pass on their own history beside the shares they send.

    Every aggregate is a number of fixed width, so the messages are hashed and not sorted.
    """
    here = F.col("w").isNull()
    sent = links.follow(state.withColumnRenamed("hashtag", "u"))
    summed = sent.groupBy(F.col("v").alias("hashtag")).agg(
        F.sum(F.col(f"r{i}") * F.col("w") / F.col("out")).alias("share"),
        F.max(F.when(here, F.col("out"))).alias("out"),
        *[F.max(F.when(here, F.col(f"r{k}"))).alias(f"r{k}") for k in range(i + 1)],
    )
    new = F.lit(alpha) * F.col("share") + (1 - alpha) / n
    return summed.withColumn(f"r{i + 1}", new).drop("share")


def centrality(edges: DataFrame, sources: DataFrame | None = None) -> DataFrame:
    """Degree, betweenness and PageRank of every node.

    ``sources`` as in ``betweenness``: exact by default, which takes a row per pair of nodes;
    an estimate from the given pivots.
    """
    from tagtide.operators.betweenness import betweenness

    edges = cut_lineage(edges)
    degree = degree_centrality(edges)
    return degree.join(betweenness(edges, sources), "hashtag").join(pagerank(edges), "hashtag")
