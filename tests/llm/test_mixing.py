from collections import Counter, defaultdict

from helpers import SCHEMA, documents, texts, words
from pyspark.sql import functions as F

from tagtide.llm import mixing


def shares(sizes: dict) -> dict:
    """Targets by handing the excess on until nobody is above the stop."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, target, free = 1.5 * sum(sizes.values()), {}, set(order)
    while free:
        level = (total - sum(target.values())) / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 2 * sizes[s]}
        if not over:
            return target | {s: level * weight[s] for s in free}
        target |= {s: 2.0 * sizes[s] for s in over}
        free -= over
    return target


def test_targets_and_taken_words(spark):
    docs = documents(spark)
    rows = mixing.sized(docs, [docs["source"].alias("from")])
    got = mixing.mixed(rows).collect()
    sizes = defaultdict(int)
    for r in got:
        sizes[r["from"]] += r["size"]
    assert Counter(r["size"] for r in got) == Counter(len(words(t)) for _, t in texts())
    want, taken, largest = shares(sizes), Counter(), defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r["from"]] and abs(r.target - want[r["from"]]) < 1e-6 and 0 <= r.copies <= 2
        taken[r["from"]] += r["size"] * r.copies
        largest[r["from"]] = max(largest[r["from"]], r["size"])
    for s, target in want.items():
        assert abs(taken[s] - target) <= largest[s] / 2 + 1


def test_smallest_keys_fill_the_rest(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_ROWS", 4)
    got = mixing.mixed(mixing.sized(documents(spark))).collect()
    by_source = defaultdict(list)
    for r in got:
        by_source[r.source].append(r)
    for rows in by_source.values():
        rows.sort(key=lambda r: r.key)
        copies = [r.copies for r in rows]
        assert copies == sorted(copies, reverse=True) and max(copies) - min(copies) <= 1


def test_heavier_documents_come_first_more_often(spark):
    rows = spark.range(4_000).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.lit(10).cast("long").alias("size"))
    rows = rows.withColumn("weight", F.when(F.col("doc_id") % 2 == 0, 1.0).otherwise(0.25))
    rows = rows.withColumn("key", mixing.exponential_key(F.col("doc_id"), F.col("weight")))
    got = mixing.mixed(rows, share=0.5).filter("copies = 1").groupBy("weight").count().collect()
    count = {r.weight: r["count"] for r in got}
    assert sum(count.values()) == 2_000 and count[1.0] > 1.8 * count[0.25]


def test_mixed_documents_keep_their_columns(spark):
    docs = documents(spark)
    mix = mixing.mix_documents(docs)
    assert mix.columns == docs.columns
    assert sorted(map(str, mix.collect())) == sorted(map(str, mixing.mix_documents(docs.repartition(3)).collect()))


def test_empty_and_wordless_tables(spark):
    assert mixing.mix_documents(spark.createDataFrame([], SCHEMA)).collect() == []
    got = mixing.mixed(mixing.sized(documents(spark, [(1, None), (2, " ")]))).collect()
    assert [(r["size"], r.target, r.copies) for r in got] == [(0, 0.0, 0)] * 2


def test_main_path_runs_no_python(spark, capsys):
    mixing.mixed(mixing.sized(documents(spark))).explain()
    assert "Python" not in capsys.readouterr().out
