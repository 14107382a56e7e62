"""Chat formatting with cumulative-snapshot collapse.

A chat that is logged after every turn leaves many conversations that are prefixes of the
last one. Every turn is hashed with its position; the running XOR of these hashes names each
prefix of a conversation. A conversation whose whole hash is a proper prefix of another one
is dropped by an anti-join; of equal conversations the smallest id stays. What is left is
rendered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tagtide.llm.common import stored, table

BEGIN, END = "<|im_start|>", "<|im_end|>"


def turn_sha() -> Column:
    """Digest of the role and text of a turn; it also orders turns of the same number."""
    part = F.concat_ws(
        "\x01",
        F.coalesce(F.length("role"), F.lit(-1)).cast("string"),
        F.coalesce("role", F.lit("")),
        F.coalesce(F.length("text"), F.lit(-1)).cast("string"),
        F.coalesce("text", F.lit("")),
    )
    return F.sha2(part, 256)


def prefixes(turns: DataFrame) -> DataFrame:
    """``conv_id, n, h1, h2, n_turns``: for every prefix of n turns its 120-bit hash.

    Turns are taken in the order of turn (null last); null role or text is hashed unlike the
    empty one. Turns that repeat a number all count, in the order of their digests.
    """
    # Only digests are shuffled, not texts.
    digests = turns.select("conv_id", "turn", turn_sha().alias("turn_sha"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_last(), "turn_sha")
    rows = digests.withColumn("n", F.row_number().over(order))
    rows = rows.withColumn("sha", F.sha2(F.concat_ws(":", F.col("n").cast("string"), "turn_sha"), 256))
    for i in (1, 2):
        word = F.conv(F.substring("sha", 1 + 15 * (i - 1), 15), 16, 10).cast("long")
        rows = rows.withColumn(f"h{i}", word)
    upto = Window.partitionBy("conv_id").orderBy("n").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy("conv_id")
    return rows.select(
        "conv_id",
        "n",
        F.bit_xor("h1").over(upto).alias("h1"),
        F.bit_xor("h2").over(upto).alias("h2"),
        F.count(F.lit(1)).over(whole).alias("n_turns"),
    )


def maximal(conversations: DataFrame) -> DataFrame:
    """``conv_id, n_turns, n_equal``: conversations that are no proper prefix of another one.

    Of equal conversations the smallest id stands for all ``n_equal``. A null id is one
    conversation like any other, and larger than the rest.
    """
    turns = conversations.select("conv_id", "turn", "role", "text")
    marks = stored(prefixes(turns))
    whole = marks.filter("n = n_turns").groupBy("n", "h1", "h2").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_equal")
    )
    longer = marks.filter("n < n_turns").select("n", "h1", "h2").distinct()
    return whole.join(longer, ["n", "h1", "h2"], "left_anti").select(
        "conv_id", F.col("n").cast("long").alias("n_turns"), "n_equal"
    )


def render(conversations: DataFrame, kept: DataFrame) -> DataFrame:
    """``conv_id, n_turns, n_equal, rendered``: the kept conversations as one text each.

    Null role is ``user``, null text is empty. Turns are in the order that ``prefixes`` takes
    them in. A rendered conversation is one value, so it has to fit in a task.
    """
    line = F.concat(
        F.lit(BEGIN),
        F.coalesce("role", F.lit("user")),
        F.lit("\n"),
        F.coalesce("text", F.lit("")),
        F.lit(END + "\n"),
    )
    turns = conversations.select(
        F.col("conv_id").alias("_id"),
        F.struct(F.col("turn").isNull().alias("last"), "turn", turn_sha().alias("sha"), line.alias("line")).alias("part"),
    )
    found = turns.join(kept, turns["_id"].eqNullSafe(kept["conv_id"])).select(
        "conv_id", "n_turns", "n_equal", "part"
    )
    grouped = found.groupBy("conv_id", "n_turns", "n_equal").agg(F.sort_array(F.collect_list("part")).alias("parts"))
    return grouped.select(
        "conv_id", "n_turns", "n_equal", F.array_join(F.col("parts.line"), "").alias("rendered")
    )


def format_chats(conversations: DataFrame) -> DataFrame:
    """Maximal conversations, rendered. An empty table gives no rows."""
    return render(conversations, stored(maximal(conversations)))


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chats(table(spark, sf_dir, "conversations"))


OP10_SQL = r"""
WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, sha256(
                      coalesce(length(role), -1) || chr(1) || coalesce(role, '') || chr(1) ||
                      coalesce(length(text), -1) || chr(1) || coalesce(text, ''))) AS n,
                  coalesce(role, '-') || chr(1) || coalesce(text, '-') AS part,
                  '<|im_start|>' || coalesce(role, 'user') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10) AS line
           FROM conversations),
p AS (SELECT conv_id, n, string_agg(part, chr(2) ORDER BY n) OVER (PARTITION BY conv_id ORDER BY n) AS prefix,
             count(*) OVER (PARTITION BY conv_id) AS total FROM t),
w AS (SELECT prefix, n, min(conv_id) AS conv_id, count(*) AS n_equal FROM p WHERE n = total GROUP BY prefix, n),
k AS (SELECT * FROM w WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.n < p.total AND p.n = w.n AND p.prefix = w.prefix))
SELECT k.conv_id, CAST(k.n AS BIGINT) AS n_turns, k.n_equal, string_agg(t.line, '' ORDER BY t.n) AS rendered
FROM k JOIN t ON t.conv_id = k.conv_id GROUP BY k.conv_id, k.n, k.n_equal
"""
