import hashlib
import random

import pytest
import tiktoken
from helpers import SCHEMA, documents, texts

from tagtide.llm.bpe import Coder, decode, encode, encode_with_digests, load_ranks, round_trip, vocabulary


@pytest.fixture(scope="module")
def pair():
    path, pattern = vocabulary()
    ranks = load_ranks(path)
    reference = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return Coder(ranks, pattern), reference


def test_long_parts_are_joined_from_halves(pair):
    coder, reference = pair
    rnd = random.Random(3)
    for alphabet in ("a", "ab", "aeinrst", "abcdefghijklmnopqrstuvwxyz", "é東ß", "!?-", "0123456789", "=-_"):
        for n in (1, 63, 64, 65, 130, 1000, 4097):
            text = "".join(rnd.choice(alphabet) for _ in range(n))
            assert coder.encode(text) == reference.encode_ordinary(text)


def test_join_of_any_two_texts(pair):
    coder, _ = pair
    rnd = random.Random(4)
    for _ in range(300):
        data = "".join(rnd.choice("thering ones") for _ in range(rnd.randint(2, 60))).encode()
        cut = rnd.randrange(len(data))
        assert coder.join(coder.merge(data[:cut]), coder.merge(data[cut:])) == coder.merge(data)


def test_pieces_of_a_long_text_cut_where_parts_end(pair, monkeypatch):
    coder, reference = pair
    monkeypatch.setattr("tagtide.llm.bpe.PIECE_BYTES", 7)
    rnd = random.Random(5)
    for _ in range(200):
        text = "".join(rnd.choice(["a", "b'", " ", "  ", "\n", "1", "é", "'s", "!"]) for _ in range(60))
        assert coder.encode(text) == reference.encode_ordinary(text)


def test_documents_as_the_library_would(spark, pair):
    _, reference = pair
    path, pattern = vocabulary()
    docs = documents(spark)
    expected = {}
    for i, t in texts():
        ids = reference.encode_ordinary(t or "")
        sha = lambda b: hashlib.sha256(b).hexdigest()
        expected[(i, t)] = (ids, sha(",".join(map(str, ids)).encode()), sha((t or "").encode()))
    got = encode(docs, path, pattern)
    assert got.columns == [*docs.columns, "token_ids"]
    for r in decode(got, path, pattern).collect():
        assert r.token_ids == expected[(r.doc_id, r.text)][0] and bytes(r.decoded) == (r.text or "").encode()
    digests = sorted((r.doc_id or -1, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in round_trip(docs, path, pattern).collect())
    assert digests == sorted((i or -1, len(expected[(i, t)][0]), *expected[(i, t)][1:]) for i, t in texts())
    for r in encode_with_digests(docs, path, pattern).collect():
        ids, ids_sha, text_sha = expected[(r.doc_id, r.text)]
        assert (r.n_tokens, r.token_ids, r.ids_sha256, r.decoded_sha256) == (len(ids), ids, ids_sha, text_sha)


def test_empty_table(spark):
    assert round_trip(spark.createDataFrame([], SCHEMA), *vocabulary()).collect() == []
