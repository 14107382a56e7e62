import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import SCHEMA, documents, texts

from tagtide.llm.exact_dedup import QuotientFilter, exact_dedup, exact_groups

BLANK = str.maketrans("", "", " \t\n\x0b\x0c\r")


@pytest.mark.parametrize("bits", [0, 3, 8])
def test_filters_merge_without_loss(bits):
    rng = np.random.default_rng(bits)
    parts = [rng.integers(0, 50, 200).astype(np.uint64) * np.uint64(0x0F0F0F0F0F0F0F0F) for _ in range(4)]
    merged = QuotientFilter.merged([QuotientFilter.of(p, bits) for p in parts])
    expected = Counter(np.concatenate(parts).tolist())
    assert dict(zip(merged.fingerprints().tolist(), merged.counts.tolist())) == dict(expected)
    assert sum(len(r) for _, r, _ in merged.ranges()) == len(expected)


def test_groups_match_plain_version(spark):
    rows = texts()
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(BLANK)].append((-len(t or ""), i is None, i if i is not None else 0))
    expected = Counter()
    for i, t in rows:
        plain = (t or "").translate(BLANK)
        longest = [g for g in groups[plain] if g[0] == min(groups[plain])[0]]
        known = [g[2] for g in longest if not g[1]]
        keep = min(known) if known else None
        expected[(i, keep, len(groups[plain]), i == keep, hashlib.sha256(plain.encode()).hexdigest())] += 1
    assert Counter(map(tuple, exact_groups(documents(spark)).collect())) == expected


def test_kept_rows_have_the_columns_of_documents(spark):
    docs = documents(spark)
    kept = exact_dedup(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(26) == 1 and 12 in ids and 10 not in ids and 19 not in ids
    assert len(ids) == len({(t or "").translate(BLANK) for _, t in texts()})


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert exact_groups(empty).collect() == [] and exact_dedup(empty).collect() == []
