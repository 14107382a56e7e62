import bisect
import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
import tokenizers
from helpers import SCHEMA, documents, texts

from tagtide.llm import alignment, segments
from tagtide.llm.alignment import Aligner, Csr, align, scored, vocabularies


@pytest.fixture(scope="module")
def pair():
    a_path, b_path = vocabularies()
    a = tokenizers.Tokenizer.from_file(a_path)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=b_path)


def byte_of():
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in kept]
    return {chr(b): b for b in kept} | {chr(256 + i): b for i, b in enumerate(rest)}


BYTE = byte_of()


def plain(pair, text):
    """Ids, groups, and positions of overlapping and ending pairs of a whole text."""
    a, b = pair
    if not text:
        return [], [], [], [], [], []
    a_ids, b_ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    a_bytes = [bytes(BYTE[c] for c in a.id_to_token(i)) for i in a_ids]
    b_bytes = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in b_ids]
    if b"".join(a_bytes) != (" " + text).encode() or b"".join(b_bytes) != (" " + text).encode():
        return [], [], [], [], [], []
    a_end, b_end = np.cumsum([len(x) for x in a_bytes]).tolist(), np.cumsum([len(x) for x in b_bytes]).tolist()
    edges = sorted(set(a_end) & set(b_end))
    group = lambda ends: [bisect.bisect_left(edges, x) for x in ends]
    overlaps, ending, j = [], [], 0
    for i, e in enumerate(a_end):
        while j and b_end[j - 1] > e - len(a_bytes[i]):
            j -= 1
        while j < len(b_end) and b_end[j] - len(b_bytes[j]) < e:
            n = min(e, b_end[j]) - max(e - len(a_bytes[i]), b_end[j] - len(b_bytes[j]))
            if n > 0:
                overlaps.append((i, j, n))
            if e == b_end[j]:
                ending.append((a_ids[i], b_ids[j]))
            j += 1
    return a_ids, b_ids, group(a_end), group(b_end), overlaps, ending


def test_plain_characters_one_by_one(pair):
    aligner = Aligner(*alignment._files(*vocabularies()))
    plain_ones = [chr(c) for c in range(9, 0x180) if alignment.EASY(chr(c))]
    texts_ = [" " + f(c) for c in plain_ones for f in (str, lambda c: f"a{c}b", lambda c: f"1{c}{c}2", lambda c: f"'{c}s'", lambda c: f"x {c} {c}\n")]
    assert aligner.parts(texts_) == [pair[0].encode(t, add_special_tokens=False).ids for t in texts_]


def odd_texts():
    rnd = random.Random(8)
    some = ["a", "the", " ", "  ", "\n", "\t", " ", "　", " ", " ", "\x1c", "\x85", "'s", "1", "12", "é", "é", "東京", "\U0001f600", "!", "?!", "<s>", "<|endoftext|>", "<0x41>", "ﬁ", "\x00"]
    rows = ["".join(rnd.choice(some) for _ in range(rnd.randint(1, 25))) for _ in range(250)]
    return rows + ["a▁b c", "▁", " ▁ x", " ", "\n", "a" * 3000, "東" * 500, "<unk> </s>", "the cat" * 200]


def test_products_of_any_matrices(monkeypatch):
    rng = np.random.default_rng(1)
    for step in (1, 7, 1 << 20):
        monkeypatch.setattr(alignment, "STEP", step)
        for _ in range(20):
            n, m, k = rng.integers(1, 9, 3)
            x, y = rng.integers(0, 3, (n, m)), rng.integers(0, 3, (m, k))

            def csr(d):
                i, j = np.nonzero(d)
                return Csr(np.concatenate([[0], np.cumsum(np.bincount(i, minlength=len(d)))]), j, d[i, j], d.shape[1])

            got, out = csr(x).times(csr(y)), np.zeros((n, k), int)
            out[got.rows(), got.col] = got.value
            assert (out == x @ y).all()
            assert (csr(x).times_vector(y[:, 0]) == x @ y[:, 0]).all()
            t = csr(x).transposed()
            out = np.zeros((m, n), int)
            out[t.rows(), t.col] = t.value
            assert (out == x.T).all()


@pytest.mark.parametrize("kept", [1, 4 << 20])
def test_as_the_libraries_encode_whole_texts(spark, pair, monkeypatch, kept):
    monkeypatch.setattr(segments, "KEPT_BYTES", kept)
    rows = [(i, t) for i, t in enumerate(odd_texts())] + [(900, None), (901, ""), (None, "no id"), (1, "twice")] + texts()
    docs = documents(spark, rows)
    got = align(docs, *vocabularies())
    assert got.columns == [*docs.columns, "a_ids", "b_ids", "a_groups", "b_groups", "over_a", "over_b", "over_bytes"]
    for r in got.collect():
        a, b, ga, gb, over, _ = plain(pair, r.text)
        assert (r.a_ids, r.b_ids, r.a_groups, r.b_groups) == (a, b, ga, gb), r.text
        assert list(zip(r.over_a, r.over_b, r.over_bytes)) == over


def digest(a, b, ga, gb):
    if not a:
        return ""
    groups = [([], []) for _ in range(ga[-1] + 1)]
    for x, g in zip(a, ga):
        groups[g][0].append(str(x))
    for x, g in zip(b, gb):
        groups[g][1].append(str(x))
    return hashlib.sha256(";".join("|".join(map(",".join, g)) for g in groups).encode()).hexdigest()


def test_counts_over_the_whole_corpus(spark, pair):
    rows = [r for r in texts() if len(r[1] or "") < 5000] + [(700 + i, t) for i, t in enumerate(odd_texts()[::5])]
    known = {t: plain(pair, t) for _, t in rows}
    counts = Counter(p for _, t in rows for p in known[t][5])
    best = Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    expected = []
    for i, t in rows:
        a, b, ga, gb, _, ending = known[t]
        in_a, in_b = Counter(ga), Counter(gb)
        shared = sum(in_a[g] * in_b[g] for g in in_a)
        expected.append((i or -1, len(a), len(b), len(set(ga)), len(ending), shared, sum(counts[p] == best[p[1]] for p in ending), sum(counts[p] for p in ending), digest(a, b, ga, gb)))
    got = scored(documents(spark, rows), *vocabularies())
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_shared", "groups_sha256", "n_best", "count_sum"]
    names = ("n_a", "n_b", "n_groups", "n_links", "n_shared", "n_best", "count_sum", "groups_sha256")
    assert sorted((r.doc_id or -1, *(r[n] for n in names)) for r in got.collect()) == sorted(expected)


def test_empty_table_and_only_empty_texts(spark):
    assert scored(spark.createDataFrame([], SCHEMA), *vocabularies()).collect() == []
    rows = scored(documents(spark, [(1, None), (2, ""), (2, "")]), *vocabularies()).collect()
    assert all(r.n_a == r.n_links == r.n_best == r.count_sum == 0 and r.groups_sha256 == "" for r in rows) and len(rows) == 3


def test_linked_pairs_are_bounded_by_the_vocabularies():
    aligner = Aligner(*alignment._files(*vocabularies()))
    assert sum(map(len, aligner.a_bytes)) + sum(map(len, aligner.b_bytes)) < 600_000
