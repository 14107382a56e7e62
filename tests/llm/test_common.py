"""What the operators share."""

import numpy as np
import pyarrow as pa

from tagtide.llm import common
from tagtide.llm.common import KeyFilter, WordHasher, key_filter, utf8


def thue_morse(n, zero, one):
    return [one if bin(i).count("1") % 2 else zero for i in range(n)]


def hashes(texts):
    return WordHasher(lower=False).words(*utf8(pa.array(texts)))[0]


def test_repeated_patterns_have_hashes_of_their_own():
    for n in (1024, 2048, 4096):
        one, two = "".join(thue_morse(n, "a", "b")), "".join(thue_morse(n, "b", "a"))
        a, b = hashes([one, two])
        assert a != b
    rng = np.random.default_rng(0)
    words = list({"".join(rng.choice(list("ab"), rng.integers(1, 40))) for _ in range(20_000)})
    assert len(set(hashes(words))) == len(words)


def test_words_do_not_depend_on_their_place():
    word = "naïve" + "x" * 3000
    got = hashes([word, " \t" + word, "other " + word + " end", word + "\n"])
    assert got[0] == got[1] == got[3] == got[5] and len(set(got)) == 3


def test_documents_of_words_in_such_patterns_are_no_copies(spark):
    from tagtide.llm.hyperminhash import near_groups

    one, two = " ".join(thue_morse(2048, "a", "b")), " ".join(thue_morse(2048, "b", "a"))
    docs = spark.createDataFrame([(1, one), (2, one + " c"), (3, two + " d d d")], "doc_id long, text string")
    assert {r.doc_id for r in near_groups(docs).collect()} == {1, 2, 3}
    from tagtide.llm.hyperminhash import sketches

    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array([1, 2]), pa.array([one, two])], ["doc_id", "key", "text"])
    (out,) = sketches(10)(iter([batch]))
    assert len(set(zip(out["k1"].to_pylist(), out["k2"].to_pylist()))) == 2


def test_filter_holds_every_key(spark, monkeypatch):
    keys = np.random.default_rng(1).integers(-(2**62), 2**62, 50_000)
    frame = spark.createDataFrame([(int(k),) for k in keys], "k long").repartition(7)
    found = KeyFilter(key_filter(frame).value)
    assert len(found.may_hold(keys.view(np.uint64))) == len(keys)
    other = np.arange(200_000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    assert len(found.may_hold(other)) < 100
    common.give_back()
    none = spark.createDataFrame([], "k long")
    assert len(KeyFilter(key_filter(none).value).may_hold(other)) == 0
