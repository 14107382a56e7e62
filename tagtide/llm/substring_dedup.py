"""Substring dedup with one compressed FM-index per shard.

A window of WINDOW consecutive words is removed where the same words also start in a document of
smaller id. The corpus is not searched as a whole: each window has an anchor, the run of ANCHOR
words in it with the smallest hash, and windows of equal words have equal anchors. Neighbouring
windows mostly share one, so they travel together as a segment. Only anchors that occur in two
documents can matter. Their segments go to a shard by anchor, equal segments as one, with the
smallest id they come from.

A shard builds an FM-index over its segments: the Burrows-Wheeler transform in a wavelet matrix
of packed bits. Its segments are then streamed through it: backward search extends each window
word by word, all windows at once, which gives its matching statistics. Where a match reaches the
whole window, the smallest id in its interval is reported.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagtide.llm.common import KeyFilter, WordHasher, beside, key_filter, mix64, multipliers, parts_for, pieces, signed, stored, table, trimmed, utf8

#: Words of a window and of an anchor, segments of a shard, distinct segments of an anchor from
#: which on its windows go to shards one by one.
WINDOW, ANCHOR, SHARD_SEGMENTS, HOT_SEGMENTS = 13, 5, 8_000, 4_000


class WaveletMatrix:
    """Rank over a sequence of small numbers: one packed bit vector per binary digit, highest first."""

    def __init__(self, values: np.ndarray, symbols: int) -> None:
        self.levels = max(1, int(symbols - 1).bit_length())
        self.rows, values = [], values.astype(np.int64)
        for level in reversed(range(self.levels)):
            bit = ((values >> level) & 1).astype(np.uint8)
            padded = np.zeros((len(bit) // 64 + 1) * 64, np.uint8)
            padded[: len(bit)] = bit
            words = np.packbits(padded, bitorder="little").view(np.uint64)
            ones = np.r_[0, np.cumsum(np.bitwise_count(words))].astype(np.int64)
            self.rows.append((level, words, ones, len(bit) - int(bit.sum())))
            values = np.concatenate([values[bit == 0], values[bit == 1]])
        self.base = np.zeros(symbols, np.int64)
        self.base = self.rank(np.arange(symbols), np.zeros(symbols, np.int64))

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place."""
        asked = symbol
        for level, words, ones, zeros in self.rows:
            word = place >> 6
            below = (np.uint64(1) << (place & 63).astype(np.uint64)) - np.uint64(1)
            before = ones[word] + np.bitwise_count(words[word] & below)
            place = np.where((symbol >> level) & 1 == 1, zeros + before, place - before)
        return place - self.base[asked]


class FMIndex:
    """Backward search over texts of numbers from 1 on, each ended by 0, for patterns of bounded length.

    Suffixes are sorted by their first ``depth`` numbers only: the interval of a pattern that is
    no longer than this does not depend on how ties behind it are ordered.
    """

    def __init__(self, text: np.ndarray, symbols: int, depth: int) -> None:
        n, reach = len(text), 1
        order = np.argsort(text, kind="stable")
        rank = self._ranks(order, text[order])
        while reach < depth:
            # Behind the end every suffix is smallest.
            behind = np.zeros(n, np.int64)
            behind[: n - reach] = rank[reach:] + 1
            key = rank * np.int64(n + 2) + behind
            order = np.argsort(key, kind="stable")
            rank, reach = self._ranks(order, key[order]), 2 * reach
        self.order = order
        self.matrix = WaveletMatrix(text[order - 1], symbols)
        self.first = np.r_[0, np.cumsum(np.bincount(text, minlength=symbols))]

    @staticmethod
    def _ranks(order: np.ndarray, keys: np.ndarray) -> np.ndarray:
        rank = np.empty(len(order), np.int64)
        rank[order] = np.cumsum(np.r_[False, keys[1:] != keys[:-1]])
        return rank

    def step(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of the patterns with one symbol more in front."""
        k = len(symbol)
        both = self.first[np.r_[symbol, symbol]] + self.matrix.rank(np.r_[symbol, symbol], np.r_[low, high])
        return both[:k], both[k:]

    def start(self, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.first[symbol], self.first[symbol + 1]


def least_owner(words: np.ndarray, counts: np.ndarray, owner: np.ndarray, window: int) -> np.ndarray:
    """For each window of each segment: the smallest owner of a segment with the same window.

    ``words`` holds the word hashes of all segments, ``counts`` their lengths. A window whose
    interval has shrunk to one place occurs nowhere else and leaves the search early.
    """
    _, symbol = np.unique(words, return_inverse=True)
    n = len(counts)
    text = np.zeros(len(words) + n, np.int64)
    ends = np.cumsum(counts + 1) - 1
    inner = np.ones(len(text), bool)
    inner[ends] = False
    text[inner] = symbol + 1
    index = FMIndex(text, int(symbol.max()) + 2, window)
    segment = np.repeat(np.arange(n), counts + 1)
    owners = owner[segment]
    by_rank = owners[index.order]
    begin = np.flatnonzero(inner & (ends[segment] - np.arange(len(text)) >= window))
    result = owners[begin]
    alive = np.arange(len(begin))
    low, high = index.start(text[begin + window - 1])
    for back in range(2, window + 1):
        many = high - low > 1
        alive, low, high = alive[many], low[many], high[many]
        if not len(alive):
            return result
        low, high = index.step(text[begin[alive] + window - back], low, high)
    # Intervals of patterns of one length are equal or disjoint.
    first, which = np.unique(low, return_inverse=True)
    last = np.zeros(len(first), np.int64)
    last[which] = high
    bounds = np.ravel(np.column_stack([first, last]))
    closed = np.r_[by_rank, np.iinfo(np.int64).max]
    result[alive] = np.minimum.reduceat(closed, bounds)[::2][which]
    return result


class Anchors:
    """Words, anchors and segments of a batch of texts."""

    def __init__(self, window: int, anchor: int) -> None:
        self.window, self.anchor, self.hasher = window, anchor, WordHasher(lower=False)

    def of(self, texts: pa.Array) -> None:
        self.data, at = utf8(texts)
        self.words, self.starts, self.ends, self.counts = self.hasher.words(self.data, at)
        n = len(self.words)
        self.doc = np.repeat(np.arange(len(self.counts)), self.counts)
        stop = np.repeat(np.cumsum(self.counts), self.counts)
        whole = stop - np.arange(n) >= self.window  # a window starts here
        value = self._fold(self.words, self.anchor)
        best, place = value.copy(), np.arange(n)
        for k in range(1, self.window - self.anchor + 1):
            if k >= n:
                break
            less = value[k:] < best[: n - k]
            best[: n - k][less] = value[k:][less]
            place[: n - k][less] = np.arange(k, n)[less]
        window = np.flatnonzero(whole)
        # A segment is a run of windows of one document with one anchor.
        new = np.r_[True, (place[window[1:]] != place[window[:-1]]) | (window[1:] != window[:-1] + 1)][: len(window)]
        self.first = window[new]
        self.windows = np.diff(np.r_[np.flatnonzero(new), len(window)])
        self.value = value[place[self.first]]
        self.owner = self.doc[self.first]
        self.begin = np.cumsum(self.counts) - self.counts

    @staticmethod
    def _fold(words: np.ndarray, size: int) -> np.ndarray:
        out, power, n = np.zeros(len(words), np.uint64), 1, len(words)
        for k in range(min(size, n)):
            out[: n - k] += words[k:] * np.uint64(power)
            power = power * 0xD1342543DE82EF95 % (1 << 64)
        return mix64(out)

    def segment_keys(self) -> np.ndarray:
        """A hash of the words of each segment."""
        size = self.windows + self.window - 1
        total, mixed = size.astype(np.uint64), mix64(self.words)
        # A segment's windows share an anchor, so its words are a bounded number.
        for k, factor in enumerate(multipliers(int(size.max(initial=0)))):
            inside = np.flatnonzero(size > k)
            total[inside] += mixed[self.first[inside] + k] * factor
        return mix64(total)


def anchor_rows(window: int, anchor: int):
    """``doc_id, text`` to ``value, low, high``: anchors with the smallest and largest id seen in a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = Anchors(window, anchor)
        for batch in pieces(batches, "text"):
            a.of(batch.column("text"))
            ids = batch.column("doc_id").to_numpy()[a.owner]
            order = np.lexsort((ids, a.value))
            value, ids = a.value[order], ids[order]
            first = np.flatnonzero(np.r_[True, value[1:] != value[:-1]][: len(value)])
            last = np.r_[first[1:], len(value)][: len(first)] - 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(value[first])), pa.array(ids[first]), pa.array(ids[last])], ["value", "low", "high"]
            )

    return run


def segment_rows(window: int, anchor: int, shared, with_words: bool):
    """``doc_id, text`` to the segments at shared anchors: their words, or where they stand."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, known = Anchors(window, anchor), KeyFilter(shared.value)
        for batch in pieces(batches, "text"):
            a.of(batch.column("text"))
            used = known.may_hold(a.value)
            ids = batch.column("doc_id").to_numpy()[a.owner[used]]
            keys = [pa.array(signed(a.value[used])), pa.array(signed(a.segment_keys()[used])), pa.array(ids)]
            if with_words:
                first, last = a.starts[a.first[used]], a.ends[a.first[used] + a.windows[used] + window - 2]
                size = last - first
                at = np.r_[0, np.cumsum(size)]
                take = np.arange(at[-1]) + np.repeat(first - at[:-1], size)
                raw = a.data[take].copy()
                space = a.hasher.space[raw]
                raw[space] = 32
                # One blank between words, so that segments of equal words are equal.
                keep = ~(space & np.r_[False, space[:-1]][: len(space)])
                raw, at = raw[keep], np.r_[0, np.cumsum(keep)][at]
                words = pa.Array.from_buffers(pa.string(), len(used), [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(raw)])
                yield pa.RecordBatch.from_arrays([*keys, words], ["value", "k", "doc_id", "words"])
            else:
                place = (a.first - a.begin[a.owner])[used].astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*keys, pa.array(place), pa.array(a.windows[used].astype(np.int16))], ["value", "k", "doc_id", "place", "windows"]
                )

    return run


def search_shard(window: int):
    """All segments of a shard to the smallest owner of each of their windows."""

    def run(rows: pa.Table) -> pa.Table:
        hasher = WordHasher(lower=False)
        words, _, _, counts = hasher.words(*utf8(rows["words"].combine_chunks()))
        least = least_owner(words, counts, rows["low"].to_numpy(), window)
        at = np.r_[0, np.cumsum(counts - window + 1)]
        lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(least))
        return pa.table({"value": rows["value"], "k": rows["k"], "part": rows["part"], "least": lists})

    return run


def shared_anchors(texts: DataFrame, window: int, anchor: int) -> DataFrame:
    """``value`` of the anchors that occur in two documents."""
    seen = texts.mapInArrow(trimmed(anchor_rows(window, anchor)), "value long, low long, high long")
    return seen.groupBy("value").agg(F.min("low").alias("low"), F.max("high").alias("high")).filter("low < high").select("value")


def repeated_windows(texts: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """``doc_id, place, windows``: runs of windows, by first word, that start in a document of smaller id too.

    ``texts`` has ``doc_id, text`` without nulls.
    """
    # The filter has a fixed size; what it lets pass beyond the shared anchors costs time only.
    shared = key_filter(shared_anchors(texts, window, anchor))
    rows = texts.mapInArrow(trimmed(segment_rows(window, anchor, shared, True)), "value long, k long, doc_id long, words string")
    segments = rows.groupBy("value", "k", "words").agg(F.min("doc_id").alias("low"))
    segments = stored(segments)
    # Few anchors can have very many segments: at most total / HOT_SEGMENTS.
    crowded = segments.groupBy("value").agg(F.count(F.lit(1)).alias("n")).filter(f"n > {HOT_SEGMENTS}")
    crowded = beside(stored(crowded.select("value")))
    shards = parts_for(segments.count(), SHARD_SEGMENTS)
    plain = segments.join(crowded, "value", "left_anti")
    plain = plain.select("value", "k", F.lit(-1).alias("part"), "words", "low", F.pmod(F.xxhash64("value"), F.lit(shards)).alias("shard"))
    # The windows of an anchor with very many segments go to shards by their own words.
    hot = segments.join(crowded, "value", "left_semi")
    hot = hot.withColumn("w", F.split("words", " +"))
    hot = hot.select("value", "k", "low", "w", F.posexplode(F.expr(f"sequence(0, size(w) - {window})")).alias("part", "i"))
    hot = hot.withColumn("words", F.expr(f"array_join(slice(w, i + 1, {window}), ' ')"))
    # Equal windows go as one, with the smallest owner, and come back to each of their segments.
    one = hot.groupBy("words").agg(F.min("low").alias("low"))
    one = one.select(
        F.xxhash64("words").alias("value"), F.xxhash64("words", F.lit(1)).alias("k"), F.lit(0).alias("part"), "words", "low",
        F.pmod(F.xxhash64("words"), F.lit(shards)).alias("shard"),
    )
    schema = "value long, k long, part int, least array<long>"
    known = plain.groupBy("shard").applyInArrow(search_shard(window), schema).drop("part")
    known_one = one.groupBy("shard").applyInArrow(search_shard(window), schema).drop("part")
    named = hot.select("value", "k", "part", F.xxhash64("words").alias("hv"), F.xxhash64("words", F.lit(1)).alias("hk"))
    back = named.join(known_one.withColumnsRenamed({"value": "hv", "k": "hk"}), ["hv", "hk"])
    back = back.groupBy("value", "k").agg(F.sort_array(F.collect_list(F.struct("part", F.col("least")[0].alias("x")))).alias("x"))
    known = stored(known.unionByName(back.select("value", "k", F.col("x.x").alias("least"))))
    spots = texts.mapInArrow(trimmed(segment_rows(window, anchor, shared, False)), "value long, k long, doc_id long, place int, windows short")
    # One row per segment on the right: a passage that very many documents share is split by the skew join.
    met = spots.join(known, ["value", "k"]).filter(F.exists("least", lambda x: x < F.col("doc_id")))
    hit = F.filter(F.sequence(F.lit(0), F.col("windows").cast("int") - 1), lambda i: F.element_at("least", i + 1) < F.col("doc_id"))
    return met.select("doc_id", F.col("place"), F.transform(hit, lambda i: i + F.col("place")).alias("starts"))


def cut_rows(window: int):
    """``doc_id, text, starts`` to counts and the kept text: words in no removed window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, removed, kept = [], [], []
            for text, starts in zip(batch.column("text").to_pylist(), batch.column("starts").to_pylist()):
                words = (text or "").encode().split()
                gone = np.zeros(len(words) + 1, np.int64)
                if starts:
                    at = np.unique(np.array(starts))
                    gone[at] += 1
                    np.subtract.at(gone, np.minimum(at + window, len(words)), 1)
                    left = np.flatnonzero(np.cumsum(gone)[:-1] == 0)
                    kept_words = [words[i] for i in left]
                else:
                    kept_words = words
                total.append(len(words))
                removed.append(len(words) - len(kept_words))
                kept.append(b" ".join(kept_words))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array([k.decode() for k in kept], pa.string()),
                 pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())],
                ["doc_id", "n_words", "n_removed", "kept_text", "kept_sha256"],
            )

    return run


CUT_SCHEMA = "doc_id long, n_words long, n_removed long, kept_text string, kept_sha256 string"


def cut_repeats(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_text, kept_sha256``, one row per row of ``docs``.

    Null is the empty text. Rows without id repeat nobody and are repeated by nobody. Rows that
    repeat an id are one document to the search, and each is cut by what was found for the id.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    texts = source.filter("doc_id is not null and text is not null")
    found = repeated_windows(texts, window, anchor)
    found = stored(found.groupBy(F.col("doc_id").alias("id")).agg(F.flatten(F.collect_set("starts")).alias("starts")))
    touched = beside(stored(found.select("id")))
    # Texts without a repeat need not meet the list of repeats: they stay where they are.
    rest = source.join(touched, source["doc_id"] == touched["id"], "left_anti").withColumn("starts", F.lit(None).cast("array<int>"))
    cut = source.join(touched, source["doc_id"] == touched["id"], "left_semi")
    cut = cut.join(found, cut["doc_id"] == found["id"]).select("doc_id", "text", "starts")
    return rest.unionByName(cut).mapInArrow(trimmed(cut_rows(window)), CUT_SCHEMA)


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut_repeats(table(spark, sf_dir, "documents")).drop("kept_text")


OP6_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, i, array_to_string(w[i:i+12], ' ') AS s
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY s) AS low FROM s) WHERE low < doc_id),
g AS (SELECT DISTINCT doc_id, i + k AS p FROM r, range(0, 13) AS t(k)),
p AS (SELECT d.doc_id, i AS p, w[i] AS word FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d) d),
k AS (SELECT p.doc_id, count(g.p) AS n_removed, string_agg(word, ' ' ORDER BY p.p) FILTER (WHERE g.p IS NULL) AS kept
      FROM p LEFT JOIN g ON g.doc_id = p.doc_id AND g.p = p.p GROUP BY p.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k ON k.doc_id = d.doc_id
"""
