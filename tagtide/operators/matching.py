"""Which sentences of a post contain which words."""

from __future__ import annotations

import sys
from bisect import bisect_left, bisect_right
from collections.abc import Sequence
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagtide.session import small_batches

# Sent to the workers by value: the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Texts of up to RUN times RUN_BYTES bytes are looked through for each needle, longer ones by an index of their words.
RUN, RUN_BYTES = 8, 1024


def _looked_through(sentences: Sequence[bytes], needles: Sequence[bytes]) -> list[list[int]]:
    text = b"\x01".join(sentences)
    starts = [0, *accumulate(len(s) + 1 for s in sentences)]

    def hits(needle: bytes) -> list[int]:
        if not needle:
            return [*range(len(sentences))]
        found, at = [], text.find(needle)
        while at >= 0:
            k = bisect_right(starts, at)
            # A needle may hold the sign between two sentences.
            if at + len(needle) < starts[k]:
                found.append(k - 1)
                at = starts[k] - 1
            at = text.find(needle, at + 1)
        return found

    return [hits(needle) for needle in needles]


def _looked_up(sentences: Sequence[bytes], needles: Sequence[bytes]) -> list[list[int]]:
    """The same by the places of all words (what single spaces part).

    A needle of several words is only compared where a word of its own stands: the rarest of its inner
    ones, which the sentence must hold whole, or one that begins with its second if it has but two. A
    needle of one word is looked for in the distinct words.
    """
    places: dict[bytes, list[tuple[int, int]]] = {}
    for k, sentence in enumerate(sentences):
        at = 0
        for word in sentence.split(b" "):
            places.setdefault(word, []).append((k, at))
            at += len(word) + 1
    words = sorted(places)
    # A needle of one word has no space, so it cannot run from one word into the next.
    joined = b" ".join(words)
    starts = [0, *accumulate(len(w) + 1 for w in words)]

    def holding(part: bytes) -> list[bytes]:
        found, at = [], joined.find(part)
        while at >= 0:
            i = bisect_right(starts, at) - 1
            found.append(words[i])
            at = joined.find(part, starts[i + 1])
        return found

    def beginning(part: bytes) -> list[bytes]:
        first = last = bisect_left(words, part)
        while last < len(words) and words[last].startswith(part):
            last += 1
        return words[first:last]

    def hits(needle: bytes) -> list[int]:
        if not needle:
            return [*range(len(sentences))]
        parts = needle.split(b" ")
        if len(parts) == 1:
            return sorted({k for word in holding(needle) for k, _ in places[word]})
        if len(parts) == 2:
            before, candidates = len(parts[0]) + 1, [p for word in beginning(parts[1]) for p in places[word]]
        else:
            inner = min(range(1, len(parts) - 1), key=lambda i: len(places.get(parts[i], ())))
            before, candidates = sum(len(w) + 1 for w in parts[:inner]), places.get(parts[inner], ())
        return sorted({k for k, at in candidates if at >= before and sentences[k].startswith(needle, at - before)})

    return [hits(needle) for needle in needles]


def _lists(column: pa.Array) -> list[list[bytes]]:
    """The elements of each list of bytes; a missing list is empty."""
    at, values = column.offsets.tolist(), column.values
    _, ends, data = values.buffers()
    if not len(values) or data is None:
        return [[b""] * (b - a) for a, b in zip(at, at[1:])]
    cuts = np.frombuffer(ends, np.int64 if pa.types.is_large_binary(values.type) else np.int32)
    cuts = cuts[values.offset : values.offset + len(values) + 1].tolist()
    data = data.to_pybytes()
    return [[data[x:y] for x, y in zip(cuts[a:b], cuts[a + 1 : b + 1])] for a, b in zip(at, at[1:])]


def _hits(sentences: pa.Array, needles: pa.Array) -> pa.Array:
    """For each needle the positions of the sentences that hold it, all as bytes."""
    outer, inner, flat = [0], [0], []
    for text, wanted in zip(_lists(sentences), _lists(needles)):
        short = sum(map(len, text)) <= RUN * RUN_BYTES
        for found in (_looked_through if short else _looked_up)(text, wanted):
            flat += found
            inner.append(len(flat))
        outer.append(len(inner) - 1)
    lists = pa.ListArray.from_arrays(pa.array(inner, pa.int32()), pa.array(flat, pa.int32()))
    return pa.ListArray.from_arrays(pa.array(outer, pa.int32()), lists)


def with_hits(posts: DataFrame, needles: str, name: str = "hits") -> DataFrame:
    """Adds, for each element of the array column ``needles``, the positions of the sentences that contain it.

    ``posts`` comes from ``scored_posts``; the needles are in lower case. Short texts are looked
    through, longer ones get an index of their words, so that a needle costs as much as the words it
    may begin with are frequent, not as much as the text is long. Every text is handled by itself, in
    Arrow batches, so streams can use it too.
    """
    small_batches(posts.sparkSession)
    as_bytes = lambda column: F.transform(column, lambda x: x.cast("binary"))
    low = as_bytes(F.transform("sentences", lambda s: s["low"]))
    found = F.arrow_udf(_hits, "array<array<int>>")(low, as_bytes(F.col(needles)))
    return posts.withColumn(name, found)
