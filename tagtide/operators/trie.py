"""Known runs of words in texts, by a trie that is a table.

A node of the trie is a run of words that some surface begins with. A word of a text goes down
the trie by one join per level, and only as long as the words before it matched, so the rows
follow the matches, not the words times the longest surface. Beyond LEVELS words the few
surfaces of a node are compared whole, so a surface may have any length.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagtide.functions.arrays import unnest

#: Words of a surface that are followed level by level.
LEVELS = 4


def nodes(surfaces: DataFrame, levels: int = LEVELS) -> DataFrame:
    """``node, type, goes_on, longer``: the trie of ``surface, type`` (words joined by single spaces).

    ``type`` is set where a surface ends, ``goes_on`` where a longer one passes through within
    the levels; ``longer`` has the surfaces that go on beyond them, the longest first.
    """
    words = surfaces.select("surface", "type", F.split("surface", " ").alias("w"))
    size = F.size("w")
    depth = F.explode(F.sequence(F.lit(1), F.least(size, F.lit(levels)))).alias("depth")
    each = words.select("surface", "type", "w", depth)
    beyond = F.when((F.col("depth") == levels) & (size > levels), F.struct((-size).alias("size"), "surface", "w", "type"))
    return each.groupBy(F.array_join(F.expr("slice(w, 1, depth)"), " ").alias("node")).agg(
        F.min(F.when(size == F.col("depth"), F.col("type"))).alias("type"),
        F.max((size > F.col("depth")) & (F.col("depth") < levels)).alias("goes_on"),
        F.array_sort(F.collect_list(beyond)).alias("longer"),
    )


def longest_runs(
    texts: DataFrame, keys: Sequence[str], words: Column, surfaces: DataFrame, levels: int = LEVELS
) -> DataFrame:
    """``keys, pos, surface, type``: at each word of ``words``, counted from 1, the longest surface that begins there.

    Every level is a left join with the trie. Where the trie's files are small Spark broadcasts
    it, once for all levels; beyond that it shuffles, and words that nothing begins with are gone
    after the first level. A row that has left the trie gets a key of its own, so that it is not
    shuffled with the others.
    """
    trie = nodes(surfaces, levels)
    # Read where the plan runs: a word carries as many words as the longest surface has.
    longest = F.coalesce(surfaces.agg(F.max(F.size(F.split("surface", " ")))).scalar(), F.lit(1))
    rows = texts.select(*keys, words.alias("_words"), longest.alias("_longest"))
    parts = F.transform(
        "_words",
        lambda w, i: F.struct((i + 1).alias("pos"), w.alias("first"), F.slice("_words", i + 1, F.col("_longest")).alias("run")),
    )
    found = unnest(rows, keys, parts, "_t").select(*keys, "_t.*")
    for level in range(1, levels + 1):
        step = trie.select(
            F.col("node").alias("_node"), F.col("type").alias("_type"), F.col("goes_on").alias("_on"), F.col("longer").alias("_longer")
        )
        if level == 1:
            found = found.join(step, F.col("first") == F.col("_node"))
            found = found.withColumns({"surface": F.when(F.col("_type").isNotNull(), F.col("_node")), "type": F.col("_type")})
        else:
            alone = F.concat_ws("\x01", F.lit(""), *[F.col(k).cast("string") for k in keys], F.col("pos").cast("string"))
            run = F.array_join(F.slice("run", 1, level), " ")
            found = found.withColumn("_try", F.when(F.col("on") & (F.size("run") >= level), run).otherwise(alone))
            found = found.join(step, F.col("_try") == F.col("_node"), "left").drop("_try")
            ends = F.col("_type").isNotNull()
            found = found.withColumns(
                {
                    "surface": F.when(ends, F.col("_node")).otherwise(F.col("surface")),
                    "type": F.when(ends, F.col("_type")).otherwise(F.col("type")),
                }
            )
        found = found.withColumn("on", F.coalesce("_on", F.lit(False)))
        if level < levels:
            found = found.drop("_node", "_type", "_on", "_longer")
    whole = F.get(F.filter("_longer", lambda s: F.slice(F.col("run"), 1, -s["size"]) == s["w"]), F.lit(0))
    found = found.withColumn("_whole", whole)
    return found.select(
        *keys,
        "pos",
        F.coalesce("_whole.surface", "surface").alias("surface"),
        F.coalesce("_whole.type", "type").alias("type"),
    ).filter("surface IS NOT NULL")
