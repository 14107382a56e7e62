"""Mixing sources to target weights by weighted sampling without replacement.

Every document draws an exponential key, -ln(u) / weight, so the documents with the smallest
keys of a source are a sample weighted by quality (Efraimidis and Spirakis). A source first
gives whole epochs; what is left of its target is filled with documents in the order of their
keys. The order of a source is cut in blocks of keys: block sums say in which block the target
is reached, and only that block is sorted. Expressions and SQL functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tagtide.llm.common import beside, stored, table, word_count

WEIGHTS, SHARE, EPOCHS, BLOCK_ROWS, SEED = (5.0, 2.0, 1.0), 1.5, 2.0, 2_000, "mix"


def text_weight(length: Column, words: Column) -> Column:
    """Quality weight from the mean room of a word: 1 at six characters, falling to 1/4 away from it."""
    off = (length / F.greatest(words, F.lit(1)) - 6) / 4
    return F.greatest(F.lit(0.25), 1 / (1 + off * off))


def exponential_key(row_id: Column, weight: Column, seed: str = SEED) -> Column:
    """-ln(u) / weight with u in (0, 1) from the MD5 of seed and id, so reruns agree."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(row_id.cast("string"), F.lit("null"))))
    u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)
    return -F.ln(u) / weight


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, epochs: float = EPOCHS):
    """Adds ``target`` to ``source, source_size`` (one row per source).

    Sources in code point order, null last, weigh ``weights`` in turn and share ``share`` of all
    sizes. A target stops at ``epochs`` times its source; the excess goes to the others by
    weight. With the sources in the order of cap / weight, the common level is the largest of
    (total - caps before) / (weights from here on), because each stopped source raises it.
    """
    by_source = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_source) - 1) % len(weights) + 1
    t = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), turn))
    t = t.withColumn("cap", epochs * F.col("source_size"))
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    t = t.withColumn("total", share * F.sum("source_size").over(everything))
    t = t.withColumn("level", (F.col("total") - before) / rest)
    t = t.withColumn("level", F.max("level").over(everything))
    return t.withColumn("target", F.least("cap", F.col("level") * F.col("weight")))


def mix_plan(rows: DataFrame, **options) -> DataFrame:
    """Per source: target, whole epochs, the block where the rest ends and the last key taken in it.

    ``rows`` needs ``source, size, weight, key``. One row per source goes through windows
    without partition; their number does not grow with the documents.
    """
    keyed = rows.select("source", "size", "weight", "key")
    sizes = keyed.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"), F.avg("weight").alias("mean_weight")
    )
    goals = targets(sizes, **options).select(
        F.col("source").alias("to"),
        "source_size",
        "target",
        "mean_weight",
        F.ceil(F.col("n") / BLOCK_ROWS).alias("blocks"),
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).alias("epochs"),
    )
    goals = stored(goals.withColumn("left", F.col("target") - F.col("epochs") * F.col("source_size")))
    near = beside(goals)
    placed = keyed.join(near, keyed["source"].eqNullSafe(near["to"])).withColumn("block", block_of("key"))
    sums = placed.groupBy("to", "block").agg(F.sum("size").alias("size"))
    running = Window.partitionBy("to").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    sums = sums.withColumn("after", F.sum("size").over(running))
    # The block where the target is reached: the first whose end lies beyond it.
    beyond = F.when(F.col("after") > F.col("left"), F.struct("block", F.col("after") - F.col("size")))
    reached = sums.join(goals.select(F.col("to").alias("_to"), "left"), F.col("to").eqNullSafe(F.col("_to")))
    reached = stored(reached.groupBy("to").agg(F.min(beyond).alias("at")).select("to", "at.block", F.col("at.col2").alias("before")))
    small = beside(reached.withColumnsRenamed({"to": "_to", "block": "_block", "before": "_before"}))
    edge = placed.join(small, placed["to"].eqNullSafe(small["_to"]) & (placed["block"] == small["_block"]))
    order = Window.partitionBy("to").orderBy("key").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    edge = edge.withColumn("end", F.col("_before") + F.sum("size").over(order))
    last = edge.filter(F.col("end") - F.col("size") / 2 < F.col("left")).groupBy("to").agg(F.max("key").alias("last_key"))
    whole = goals.join(reached.withColumnRenamed("to", "_a"), F.col("to").eqNullSafe(F.col("_a")), "left")
    whole = whole.join(last.withColumnRenamed("to", "_b"), F.col("to").eqNullSafe(F.col("_b")), "left")
    return stored(whole.select("to", "source_size", "target", "mean_weight", "blocks", "epochs", "block", "last_key"))


def block_of(key: str) -> Column:
    """Block of a key among ``blocks``: the keys of a source of mean weight are spread evenly by it."""
    even = 1 - F.exp(-F.col(key) * F.col("mean_weight"))
    return F.least(F.col("blocks") - 1, F.floor(F.col("blocks") * even))


def mixed(rows: DataFrame, **options) -> DataFrame:
    """``rows`` with ``source_size, target, copies``: how often the mix takes each row.

    ``rows`` needs ``source, size, weight, key``. A row is taken in each whole epoch, and once
    more if its key is among the first that fill the rest of the target: the row that crosses
    it counts if half of it fits. Rows of one source with the same key (a repeated id) go
    together. A source without words has target 0 and is not taken.
    """
    plan = beside(mix_plan(rows, **options))
    found = rows.join(plan, rows["source"].eqNullSafe(plan["to"]))
    block = block_of("key")
    inside = (block < F.coalesce("block", F.col("blocks"))) | (
        (block == F.col("block")) & (F.col("key") <= F.coalesce("last_key", F.lit(-1.0)))
    )
    extra = F.when(F.col("target") > F.col("epochs") * F.col("source_size"), inside.cast("int")).otherwise(0)
    copies = (F.col("epochs") + extra).cast("int")
    return found.select(*[rows[c] for c in rows.columns], plan["source_size"], plan["target"], copies.alias("copies"))


def sized(docs: DataFrame, extra: list[Column] = ()) -> DataFrame:
    """``source, size, weight, key`` of documents, beside the columns given."""
    size, length = word_count(docs["text"]), F.length(F.coalesce(docs["text"], F.lit("")))
    rows = docs.select(*extra, docs["doc_id"], docs["source"], size.alias("size"), length.alias("length"))
    rows = rows.withColumn("weight", text_weight(F.col("length"), F.col("size")))
    return rows.withColumn("key", exponential_key(F.col("doc_id"), F.col("weight")))


def mix_documents(docs: DataFrame) -> DataFrame:
    """The rows the mix takes, each as often as it is taken, with the columns of ``docs``."""
    rows = sized(docs, [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")])
    taken = mixed(rows).filter("copies > 0")
    return taken.select(F.explode(F.array_repeat("row", F.col("copies"))).alias("row")).select("row.*")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = stored(sized(docs).drop("length"))
    return mixed(rows).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


OP5_SQL = r"""
WITH d AS (SELECT doc_id, source, length(coalesce(text, '')) AS len,
                  len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
k AS (SELECT doc_id, source, size,
             -ln((CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT) + 0.5::DOUBLE)
                 / 4503599627370496.0::DOUBLE)
             / greatest(0.25::DOUBLE, 1 / (1 + pow((len::DOUBLE / greatest(size, 1) - 6) / 4, 2))) AS key FROM d),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM k GROUP BY source),
w AS (SELECT *, [5.0::DOUBLE, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight,
             2.0::DOUBLE * source_size AS cap FROM s),
l AS (SELECT *, (1.5::DOUBLE * (SELECT sum(source_size)::DOUBLE FROM s)
                 - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev FROM w),
t AS (SELECT source, source_size, least(cap, (SELECT max(lev) FROM l) * weight) AS target FROM l),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs FROM t),
r AS (SELECT k.doc_id, k.size, e.source_size, e.target, e.epochs, e.target - e.epochs * e.source_size AS rest,
             sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key) AS upto
      FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (epochs + CASE WHEN upto - size / 2.0::DOUBLE < rest THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM r
"""
