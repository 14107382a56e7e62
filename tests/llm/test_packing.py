import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import tokenizers
from helpers import SCHEMA, documents, texts

from tagtide.llm import packing, segments
from tagtide.llm.packing import Sums, pack, places, plan, sequences, vocabulary

COLUMNS = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


@pytest.fixture(scope="module")
def tokenizer():
    t = tokenizers.Tokenizer.from_file(vocabulary())
    t.encode_special_tokens = True
    return t


def plain(tokenizer, rows, size):
    out = []
    for i, t in rows:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
        for k in range(0, len(ids), size):
            part = np.array(ids[k : k + size], "<u4")
            out.append((i if i is not None else -1, k // size, k, len(part), zlib.crc32(part.tobytes())))
    return sorted(out)


def test_plain_characters_one_by_one(tokenizer):
    """The short way through the model against the whole tokenizer, for every plain character."""
    words = packing.WordIds(tokenizer.to_str().encode())
    plain_ones = [chr(c) for c in range(33, 0x180) if packing.EASY(chr(c))]
    assert len(plain_ones) == 94 + 23 + 31 + 56 + 23 + 53
    texts_ = [f(c) for c in plain_ones for f in (str, lambda c: f"a{c}b", lambda c: f"1{c}{c}2", lambda c: f"'{c}S'", lambda c: f"'s{c}")]
    assert words.parts([t.lower() for t in texts_]) == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts_]


def check(rows, size):
    """Every sequence is filled gaplessly from 0 and fits; returns the number of sequences."""
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= size
    assert sorted(by) == list(range(len(by)))
    return len(by)


def odd_texts():
    rnd = random.Random(9)
    some = ["a", "The", " ", "  ", "\n", "\t", " ", "　", " ", "\x1c", "\x85", "'s", "'LL", "'", "1", "12", "é", "É", "é", "́", "東京", "\U0001f600", "!", "?!'s", "<|endoftext|>", "ﬁ", "\x00", "İ", "ß", "x'd"]
    return ["".join(rnd.choice(some) for _ in range(rnd.randint(1, 25))) for _ in range(250)]


@pytest.mark.parametrize("size,kept", [(4096, 16 << 20), (50, 1)])
def test_pieces_as_the_library_encodes(spark, tokenizer, monkeypatch, size, kept):
    monkeypatch.setattr(segments, "KEPT_BYTES", kept)
    rows = texts() + [(3000 + i, t) for i, t in enumerate(odd_texts())]
    packed = pack(documents(spark, rows), vocabulary(), size=size)
    assert packed.columns == [*COLUMNS, "token_ids"]
    got = packed.collect()
    expected = plain(tokenizer, rows, size)
    assert sorted((-1 if r.doc_id is None else r.doc_id, *r[1:5]) for r in got) == expected
    assert all(zlib.crc32(np.array(r.token_ids, "<u4").tobytes()) == r.ids_crc32 for r in got)
    n, least = check(got, size), -(-sum(r[3] for r in expected) // size)
    assert least <= n <= least * 1.02 + 1


def test_sequences_hold_their_pieces(spark):
    packed = pack(documents(spark), vocabulary(), size=200)
    pieces = defaultdict(list)
    for r in packed.collect():
        pieces[r.sequence_id].append((r.offset, r.doc_id, r.token_ids))
    for r in sequences(packed).collect():
        parts = sorted(pieces.pop(r.sequence_id), key=lambda p: p[0])
        assert r.token_ids == [x for p in parts for x in p[2]] and r.doc_ids == [p[1] for p in parts]
    assert not pieces


def test_a_third_of_all_rows_alike_and_an_empty_table(spark):
    rows = [(i, "one two three") for i in range(700)] + [(1000 + i, "word " * (i % 90)) for i in range(1400)]
    docs = documents(spark, rows).repartition(16)
    got = pack(docs, vocabulary(), size=64, with_ids=False).collect()
    assert len(got) >= 2100 and "token_ids" not in got[0]
    n, total = check(got, 64), sum(r.length for r in got)
    assert n <= -(-total // 64) * 1.02 + 1
    assert pack(spark.createDataFrame([], SCHEMA), vocabulary()).collect() == []


def best_fit(lengths, size):
    """Plain best-fit decreasing."""
    free = []
    for x in sorted(lengths, reverse=True):
        fits = [i for i, f in enumerate(free) if f >= x]
        if fits:
            i = min(fits, key=lambda i: free[i])
            free[i] -= x
        else:
            free.append(size - x)
    return len(free)


def test_plans_use_every_piece_once_and_are_no_worse_than_best_fit():
    rnd = random.Random(2)
    for case in range(150):
        size = rnd.choice([7, 30, 100])
        low, high = sorted((rnd.randint(1, size), rnd.randint(1, size)))
        lengths = [rnd.randint(low, high) for _ in range(rnd.randint(1, 120))]
        counts = np.bincount(lengths, minlength=size + 1)
        entries = plan(counts)
        used = Counter()
        for times, made in entries:
            assert sum(made) <= size and times > 0
            for x in made:
                used[x] += times
        assert used == Counter(lengths)
        n = sum(times for times, _ in entries)
        assert -(-sum(lengths) // size) <= n <= best_fit(lengths, size) + 1 + n // 20
        assert len(entries) <= 3.5 * size
        key, first, sequence, offset, copies = places(entries, size)
        seats, taken = set(), Counter()
        for x in lengths:
            rank = taken[x]
            taken[x] += 1
            at = np.searchsorted(key, x << 48 | rank, "right") - 1
            inside = rank - first[at]
            seat = (int(sequence[at] + inside // copies[at]), int(offset[at] + inside % copies[at] * x))
            assert seat not in seats
            seats.add(seat)
    assert plan(np.zeros(10, int)) == [] and len(places([], 9)[0]) == 0


def test_exact_complements():
    counts = np.zeros(101, np.int64)
    counts[[10, 20, 30, 45]] = [1, 2, 1, 1]
    at_hand = Sums(counts)
    assert at_hand.one(30) == (30,) and at_hand.one(31) is None
    assert at_hand.two(40, 40) == (30, 10) and at_hand.two(60, 60) is None and at_hand.two(20, 20) is None
    sums = at_hand.pair_sums(100)
    assert np.flatnonzero(sums).tolist() == [20, 30, 40, 50, 55, 60, 65, 75, 90]
    assert at_hand.three(50, sums) == (20, 20, 10) and at_hand.three(95, sums) == (45, 30, 20)
    assert at_hand.three(11, sums) is None
