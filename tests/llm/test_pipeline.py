"""Every stage of the pipeline against a plain version of it, each on its own input."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import pytest
import tiktoken
from helpers import documents, sentence, texts, words
from test_exact_dedup import BLANK
from test_hyperminhash import plain as plain_groups
from test_mixing import shares
from test_quality import junk

import corpus_pipeline
from tagtide.llm.bpe import load_ranks, vocabulary
from tagtide.llm.quality import classify

NAMES = ["quality classifier", "exact dedup", "near dedup", "source mix", "byte-level BPE"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("sf")
    rows = [(10_000 + i, junk(i) if i % 5 == 0 else sentence(i, 40 + i % 60)) for i in range(250)]
    rnd = random.Random(1)
    rows += [(20_000 + i, " ".join([*rows[rnd.randrange(1, 250)][1].split()[:-1], "end"])) for i in range(40)]
    rows += [(30_000 + i, rows[1 + i % 4][1] + " " * (i % 3)) for i in range(40)]
    docs = documents(spark, rows + [(i, t) for i, t in texts() if i is not None])
    docs.select("doc_id", "text", "lang", "source", "n_chars").repartition(4).write.parquet(f"{path}/documents.parquet")
    labels = [(10_000 + i, 0 if i % 5 == 0 else 1, 0) for i in range(0, 250, 2)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


def as_rows(df):
    return [(r.doc_id, r.text, r.source) for r in df.select("doc_id", "text", "source").collect()]


def good(spark, folder, rows, df):
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    kept = {r.doc_id for r in classify(df, labels).filter("predicted = 1").collect()}
    return [r for r in rows if r[0] in kept]


def longest_of_each(rows):
    best = {}
    for r in rows:
        key = (r[1] or "").translate(BLANK)
        best[key] = min(best.get(key, r), r, key=lambda x: (-len(x[1] or ""), x[0]))
    return list(best.values())


def one_of_each_group(rows):
    kept = {i for i, _, _, k in plain_groups([(i, t) for i, t, _ in rows]) if k}
    return [r for r in rows if r[0] in kept]


def taken(rows):
    by_source, out = defaultdict(list), []
    for r in rows:
        n, length = len(words(r[1])), len(r[1] or "")
        weight = max(0.25, 1 / (1 + ((length / max(n, 1) - 6) / 4) ** 2))
        u = (int(hashlib.md5(f"mix:{r[0]}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
        by_source[r[2]].append((-math.log(u) / weight, n, r))
    sizes = {s: sum(n for _, n, _ in v) for s, v in by_source.items()}
    for s, target in shares(sizes).items():
        whole = int(target // sizes[s]) if sizes[s] else 0
        left, upto = target - whole * sizes[s], 0
        for _, n, r in sorted(by_source[s], key=lambda x: x[0]):
            upto += n
            out += [r] * (whole + (upto - n / 2 < left))
    return out


def test_stages(spark, folder):
    assert [n for n, _ in corpus_pipeline.STAGES] == NAMES
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    for (name, stage), plain in zip(corpus_pipeline.STAGES, (None, longest_of_each, one_of_each_group, taken, None)):
        before = as_rows(docs)
        after = stage(spark, docs, folder)
        if name == NAMES[-1]:
            break
        assert after.columns == columns
        expected = good(spark, folder, before, docs) if plain is None else plain(before)
        got = as_rows(after)
        assert Counter(got) == Counter(expected) and 0 < len(got)
        docs = spark.createDataFrame(after.collect(), docs.schema).repartition(3)
    path, pattern = vocabulary()
    reference = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=load_ranks(path), special_tokens={})
    ids = Counter((i, tuple(reference.encode_ordinary(t or "")), hashlib.sha256((t or "").encode()).hexdigest()) for i, t, _ in before)
    rows = after.collect()
    assert Counter((r.doc_id, tuple(r.token_ids), r.decoded_sha256) for r in rows) == ids
    assert all(r.n_tokens == len(r.token_ids) for r in rows)


def test_run_keeps_good_documents_and_drops_the_rest(spark, folder):
    rows = corpus_pipeline.run(spark, folder).collect()
    ids = Counter(r.doc_id for r in rows)
    assert max(ids.values()) <= 2
    assert sum(i % 5 != 0 for i in ids if 10_000 <= i < 10_250) > 100
    assert not any(i % 5 == 0 for i in ids if 10_000 <= i < 10_250)


def test_empty_documents(spark, folder, tmp_path):
    spark.read.parquet(f"{folder}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder}/labels.parquet").limit(0).write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
