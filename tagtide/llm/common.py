"""What the operators share: written tables, Arrow batches in bounded pieces, word hashes."""

from __future__ import annotations

import ctypes
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagtide.session import cut_lineage

WORD = "[^\\x20\\x09-\\x0D]+"
SPACES = " \t\n\x0b\x0c\r"

#: Rows (of some 40 bytes) that may be broadcast.
BROADCAST_ROWS = 500_000
#: Rows and bytes of one Arrow batch, and bytes that a numpy step takes at once.
BATCH_ROWS, BATCH_BYTES, PIECE_BYTES = 2_000, 4 << 20, 1 << 20


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of the session are bounded in rows and bytes from here on."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables."""
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, replaces: DataFrame | None = None) -> DataFrame:
    """``df`` written to the shared folder and read again, so that nothing is computed twice.

    ``replaces`` is a table made here that nothing reads any more; it is deleted.
    """
    return cut_lineage(df, replaces)


def beside(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """A written table of narrow rows as the small side of a join: broadcast only if it was counted to be small."""
    return F.broadcast(df) if df.count() <= limit else df


def parts_for(rows: int, each: int) -> int:
    """Number of parts, a power of two, with about ``each`` rows or fewer."""
    return 1 << max(0, math.ceil(math.log2(max(1, rows) / each)))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, end to end, and where each begins (one more offset than texts). Null is empty."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def pieces(batches: Iterator[pa.RecordBatch], text: str, size: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut to about ``size`` bytes of text each; a longer text is a piece of its own."""
    for batch in batches:
        _, at = utf8(batch.column(text))
        start = 0
        while start < batch.num_rows:
            end = max(start + 1, int(np.searchsorted(at, at[start] + size, "right")) - 1)
            yield batch.slice(start, end - start)
            start = end


def mix64(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def multipliers(n: int) -> np.ndarray:
    """Odd 64-bit numbers without a pattern, for the first n places."""
    return mix64(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


class WordHasher:
    """64-bit hashes of the words of many texts, without a Python object per word.

    A word is a run of bytes other than space and the controls 9 to 13. Its hash adds up its
    bytes, each multiplied by a number of its own for the place in the word, so it does not
    depend on where the word stands. Places have unrelated multipliers: powers of one base
    would give some different words of repeated patterns the same sum.
    """

    def __init__(self, lower: bool) -> None:
        seeds = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        if lower:
            seeds[65:91] = seeds[97:123]
        self.seeds = seeds
        self.space = np.zeros(256, bool)
        self.space[[9, 10, 11, 12, 13, 32]] = True
        self.factors = multipliers(1 << 10)

    def weighed(self, values: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The values, each times the multiplier of its place."""
        most = int(place.max(initial=0))
        if most >= len(self.factors):
            self.factors = multipliers(2 * most)
        return values * self.factors[place]

    def _cuts(self, data: np.ndarray) -> Iterator[tuple[int, int]]:
        """Ranges of about PIECE_BYTES that end at a space, or later where a word is longer."""
        start, n = 0, len(data)
        while start < n:
            end = min(start + PIECE_BYTES, n)
            while end < n and not self.space[data[end - 1]]:
                found = np.flatnonzero(self.space[data[max(start, end - 4096) : end]])
                if len(found):
                    end = max(start, end - 4096) + int(found[-1]) + 1
                else:
                    end = min(end + PIECE_BYTES, n)
                    after = np.flatnonzero(self.space[data[end - PIECE_BYTES if end - PIECE_BYTES > start else start : end]])
                    if len(after):
                        end = max(start, end - PIECE_BYTES) + int(after[0]) + 1
            yield start, end
            start = end

    def words(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Hash, first byte and end of each word, and the number of words of each text."""
        hashes, starts, ends = [], [], []
        begins = offsets[:-1]
        for a, b in self._cuts(data):
            part = data[a:b]
            word = ~self.space[part]
            before = np.empty(b - a, bool)
            before[0], before[1:] = False, word[:-1]
            lo, hi = np.searchsorted(begins, [a, b])
            own = begins[lo:hi] - a
            before[own] = False
            first = np.flatnonzero(word & ~before)
            after = np.empty(b - a, bool)
            after[-1], after[:-1] = False, word[1:]
            after[own[own > 0] - 1] = False
            last = np.flatnonzero(word & ~after) + 1
            place = np.zeros(b - a, np.int64)
            place[first] = first
            place = np.where(word, np.arange(b - a) - np.maximum.accumulate(place), 0)
            total = np.zeros(b - a + 1, np.uint64)
            np.cumsum(self.weighed(self.seeds[part], place), out=total[1:])
            value = total[last] - total[first]
            hashes.append(mix64(value + (last - first).astype(np.uint64)))
            starts.append(first + a)
            ends.append(last + a)
        if not hashes:
            none = np.zeros(0, np.int64)
            return np.zeros(0, np.uint64), none, none, np.zeros(len(begins), np.int64)
        start = np.concatenate(starts)
        counts = np.diff(np.searchsorted(start, offsets))
        return np.concatenate(hashes), start, np.concatenate(ends), counts


def give_back() -> None:
    """Return what the tasks before have freed to the system: a worker lives through many stages."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # another C library


def trimmed(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The function of a ``mapInArrow``, giving back what it has freed once its task ends."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return task


def word_count(text):
    """Number of words of a text column; null counts none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def signed(x: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit values as Spark's longs, bit by bit."""
    return np.ascontiguousarray(x).view(np.int64)


#: Bits of a filter of keys, whatever the number of keys, and of one part of it.
FILTER_BITS, FILTER_PART = 1 << 27, 1 << 19


class KeyFilter:
    """A Bloom filter of fixed size: it holds every key put in, and may let others pass."""

    def __init__(self, data: np.ndarray) -> None:
        self.data = data

    @staticmethod
    def places(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        mixed, bits = mix64(keys ^ np.uint64(0xA0761D6478BD642F)), np.uint64(FILTER_BITS)
        return (mixed % bits).astype(np.int64), ((mixed >> np.uint64(32)) * np.uint64(5) % bits).astype(np.int64)

    def may_hold(self, keys: np.ndarray) -> np.ndarray:
        """Positions of the keys that the filter lets pass."""
        one, two = self.places(keys)
        left = np.flatnonzero((self.data[one >> 3] >> (one & 7).astype(np.uint8)) & 1)
        at = two[left]
        return left[((self.data[at >> 3] >> (at & 7).astype(np.uint8)) & 1) == 1]


def _filter_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    # Pages that no key touches take no memory.
    data, size = np.zeros(FILTER_BITS // 8, np.uint8), FILTER_PART // 8
    for batch in batches:
        for at in KeyFilter.places(batch.column(0).to_numpy().view(np.uint64)):
            at = np.unique(at)
            byte = at >> 3
            new = np.flatnonzero(np.concatenate([[True], byte[1:] != byte[:-1]])) if len(at) else byte
            if len(at):
                data[byte[new]] |= np.bitwise_or.reduceat((1 << (at & 7)).astype(np.uint8), new)
    for p in np.flatnonzero(data.reshape(-1, size).any(1)).tolist():
        bits = data[p * size : (p + 1) * size].tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([p], pa.int32()), pa.array([bits])], ["part", "bits"])


def _merge_part(rows: pa.Table) -> pa.Table:
    data = np.bitwise_or.reduce([np.frombuffer(x, np.uint8) for x in rows["bits"].to_pylist()])
    return pa.table({"part": rows["part"].slice(0, 1), "bits": pa.array([data.tobytes()], pa.binary())})


def key_filter(keys: DataFrame) -> Broadcast:
    """The bits of a KeyFilter of the only column of ``keys``, put together by Spark, then broadcast."""
    parts = keys.mapInArrow(trimmed(_filter_parts), "part int, bits binary")
    found = parts.groupBy("part").applyInArrow(_merge_part, "part int, bits binary").toArrow()
    data = np.zeros(FILTER_BITS // 8, np.uint8)
    for part, bits in zip(found["part"].to_pylist(), found["bits"].to_pylist()):
        data[part * FILTER_PART // 8 :][: FILTER_PART // 8] = np.frombuffer(bits, np.uint8)
    return keys.sparkSession.sparkContext.broadcast(data)
