"""MinHash near-dedup with HyperMinHash registers.

Every shingle falls in one of REGISTERS buckets. A bucket keeps the smallest hash it has seen in
compressed form: the number of leading zeros and MANTISSA bits after the first one, 16 bits
in all (Yu and Weber 2017). Empty registers take the next filled one clockwise, marked with the
distance. Documents whose registers agree in a whole band are candidates; their Jaccard
similarity is estimated from the registers, corrected for chance collisions, and what is not
clearly below the threshold is decided on the full sets of shingles.

A small set leaves most registers to copies of few, and one shingle can spoil all bands. Sets of
up to SMALL shingles are therefore compared by their shingles: two similar sets share one of
the few rarest of each (prefix filter), in any order of rarity that is the same for all.

Documents of equal words are one class. In a bucket of a band everything is compared with its
smallest id first, which settles large groups with one comparison a member. Only members that
end in another component than that one are then compared with the rest of their bucket.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tagtide.llm.common import KeyFilter, WordHasher, beside, key_filter, mix64, pieces, signed, stored, table, trimmed, utf8
from tagtide.llm.components import components, forest

#: Registers, mantissa bits and rows of a band. If registers were independent, two documents of similarity 0.75
#: would meet in none of the 32 bands with probability (1 - 0.75^4)^32 = 5e-6; copied registers are not.
REGISTERS, MANTISSA, BAND = 128, 10, 4
#: Pairs with a set of at most so many shingles are found by their shingles and never missed.
SMALL = 200
SHINGLE, PERCENT, SIGMAS = 5, 75, 5.0
#: Registers of a closer look, and members of a bucket that meet in one task.
FINE, BLOCK_MEMBERS = 512, 1_000
EMPTY = 65535


class Shingler:
    """Hashes of the shingles of many texts: lower-cased words, or the whole text where it is shorter."""

    def __init__(self, size: int = SHINGLE) -> None:
        self.size, self.hasher = size, WordHasher(lower=True)

    def of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Shingle hashes, the text each is from, and the word hashes with their counts."""
        data, at = utf8(texts)
        words, _, _, counts = self.hasher.words(data, at)
        ends = np.cumsum(counts)
        doc = np.repeat(np.arange(len(counts)), counts)
        room = np.repeat(ends, counts) - np.arange(len(words))  # words from here to the end of the text
        value, power = np.zeros(len(words), np.uint64), 1
        for k in range(self.size):
            reach = room > k
            moved = np.zeros(len(words), np.uint64)
            moved[: len(words) - k] = words[k:]
            value += np.where(reach, moved * np.uint64(power), np.uint64(0))
            power = power * 0xD1342543DE82EF95 % (1 << 64)
        first = np.repeat(ends - counts, counts) == np.arange(len(words))
        used = (room >= self.size) | first
        length = np.minimum(room, self.size).astype(np.uint64)
        return mix64(value[used] + length[used]), doc[used], words, counts

    def sets(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """As ``of``, each shingle once per text."""
        value, doc, words, counts = self.of(texts)
        _, index = np.unique(mix64(value + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)
        return value[index], doc[index], words, counts


def registers(value: np.ndarray, doc: np.ndarray, n: int, size: int = REGISTERS, fill: bool = True) -> np.ndarray:
    """The n x size compressed minima of the shingles of n texts; empty ones are filled, or EMPTY."""
    spread = mix64(value ^ np.uint64(0x5851F42D4C957F2D))
    bits = 64 - (size - 1).bit_length()
    least = np.full(n * size, np.uint64((1 << 64) - 1))
    np.minimum.at(least, doc * size + (spread >> np.uint64(bits)).astype(np.int64), spread & np.uint64((1 << bits) - 1))
    filled = least != np.uint64((1 << 64) - 1)
    part, exponent = np.frexp(np.where(filled, least, np.uint64(0)).astype(float))
    mantissa = np.clip((part * 2 - 1) * (1 << MANTISSA), 0, (1 << MANTISSA) - 1).astype(np.int64)
    packed = ((bits - exponent) << MANTISSA) + mantissa
    packed, filled = packed.reshape(n, size), filled.reshape(n, size)
    if not fill:
        return np.where(filled, packed, EMPTY).astype(np.uint16)
    # Next filled register clockwise: the smallest filled position at or after each, over two turns.
    place = np.where(np.tile(filled, 2), np.arange(2 * size), 4 * size)
    following = np.minimum.accumulate(place[:, ::-1], axis=1)[:, ::-1][:, :size]
    has = following < 4 * size
    taken = np.take_along_axis(packed, np.where(has, following % size, 0), axis=1)
    away = following - np.arange(size)
    marked = np.where(away > 0, (taken * 40503 + away * 30011) % EMPTY, taken)
    return np.where(has, marked, EMPTY).astype(np.uint16)


def chance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Probability that the registers of two disjoint sets of these sizes agree."""
    x, y = np.maximum(a, 1) / REGISTERS, np.maximum(b, 1) / REGISTERS
    level = 0.5 ** np.arange(0, 50)
    both = (x + y)[:, None]
    at_level = np.exp(-both * level / 2) - np.exp(-both * level)
    return (x * y / (x + y)) * (at_level * level / 2).sum(1) / (1 << MANTISSA)


def plausible(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, threshold: float) -> np.ndarray:
    """True unless the corrected estimate is SIGMAS deviations below the threshold."""
    c = chance(na, nb)
    estimate = ((a == b).mean(1) - c) / (1 - c)
    drawn = np.minimum(np.minimum(na, nb), REGISTERS)
    return estimate >= threshold - SIGMAS * np.sqrt(threshold * (1 - threshold) / drawn)


SKETCH_SCHEMA = "doc_id long, key long, n long, k1 long, k2 long, registers binary, shingles binary"


def sketches(limit: int):
    """``doc_id, key, text`` to the set size, a 128-bit hash of the words in order, the registers, and the set of up to ``limit`` shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in pieces(batches, "text"):
            n = batch.num_rows
            value, doc, words, counts = shingler.sets(batch.column("text"))
            ends = np.cumsum(counts)
            place = np.arange(len(words)) - np.repeat(ends - counts, counts)
            keys = []
            for seed in (0x632BE59BD9B4E019, 0xA0761D6478BD642F):
                total = np.zeros(len(words) + 1, np.uint64)
                np.cumsum(shingler.hasher.weighed(mix64(words ^ np.uint64(seed)), place), out=total[1:])
                keys.append(mix64(total[ends] - total[ends - counts] + counts.astype(np.uint64)))
            rows = registers(value, doc, n)
            size = np.bincount(doc, minlength=n)
            small = size[doc] <= limit
            order = np.argsort(doc[small], kind="stable")
            at = np.r_[0, np.cumsum(np.where(size <= limit, size, 0))] * 8
            sets = [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(value[small][order])]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("key"),
                    pa.array(size.astype(np.int64)),
                    pa.array(signed(keys[0])),
                    pa.array(signed(keys[1])),
                    pa.array([r.tobytes() for r in rows], pa.binary()),
                    pa.Array.from_buffers(pa.binary(), n, sets),
                ],
                ["doc_id", "key", "n", "k1", "k2", "registers", "shingles"],
            )

    return run


def keys_of_bands(rows: np.ndarray) -> np.ndarray:
    """The key of every band of each row of registers; the registers of a band stand far apart."""
    bands = REGISTERS // BAND
    rows = rows.astype(np.uint64).reshape(-1, BAND, bands)
    packed = sum(rows[:, i] << np.uint64(16 * i) for i in range(BAND))
    return mix64(packed ^ mix64(np.arange(1, bands + 1, dtype=np.uint64)))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, REGISTERS)


def band_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``rep, registers`` to one row per band."""
    for batch in batches:
        if batch.num_rows:
            keys = keys_of_bands(_matrix(batch.column("registers")))
            reps = np.repeat(batch.column("rep").to_numpy(), keys.shape[1])
            yield pa.RecordBatch.from_arrays([pa.array(signed(keys.ravel())), pa.array(reps)], ["band", "rep"])


def plausible_pairs(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = _matrix(batch.column("ra")), _matrix(batch.column("rb"))
                good = plausible(a, b, batch.column("na").to_numpy(), batch.column("nb").to_numpy(), threshold)
                yield batch.select(["a", "b"]).filter(pa.array(good))

    return run


def similar(x: np.ndarray, of_x: np.ndarray, y: np.ndarray, of_y: np.ndarray, n: int, percent: int) -> np.ndarray:
    """Which of n pairs of sets share enough; ``of_x`` and ``of_y`` number the pair that each shingle is from."""
    mark = lambda value, doc: mix64(value + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, index, _ = np.intersect1d(mark(x, of_x), mark(y, of_y), assume_unique=True, return_indices=True)
    common = np.bincount(of_x[index], minlength=n)
    union = np.bincount(of_x, minlength=n) + np.bincount(of_y, minlength=n) - common
    return (100 * common >= percent * union) & (union > 0)


def confirmed(percent: int):
    """``a, b, ta, tb`` to the pairs whose full sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in pieces(pieces(batches, "ta"), "tb"):
            (x, of_x), (y, of_y) = (shingler.sets(batch.column(side))[:2] for side in ("ta", "tb"))
            yield batch.select(["a", "b"]).filter(pa.array(similar(x, of_x, y, of_y, batch.num_rows, percent)))

    return run


def shingle_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``rep, text`` to its shingles, each once."""
    shingler = Shingler()
    for batch in pieces(batches, "text"):
        yield pa.RecordBatch.from_arrays([pa.array(signed(shingler.sets(batch.column("text"))[0]))], ["shingle"])


def closer_looks(shared):
    """``rep, text`` to the number of its shingles that another of the documents may have, and FINE registers of a byte."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, known = Shingler(), KeyFilter(shared.value)
        for batch in pieces(batches, "text"):
            n = batch.num_rows
            value, doc, _, _ = shingler.sets(batch.column("text"))
            count = np.bincount(doc[known.may_hold(value)], minlength=n)
            fine = registers(value, doc, n, FINE, fill=False)
            fine = np.where(fine == EMPTY, 0, 1 + fine.astype(np.uint32) * np.uint32(2654435761) % np.uint32(1 << 31) % np.uint32(255)).astype(np.uint8)
            columns = [batch.column("rep"), pa.array(count.astype(np.int64)), pa.array([r.tobytes() for r in fine], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["rep", "common", "fine"])

    return run


def near_enough(one: np.ndarray, many: np.ndarray, sizes: np.ndarray, threshold: float) -> np.ndarray:
    """True unless the estimate from byte registers, 0 for empty, is SIGMAS deviations below the threshold.

    ``sizes`` adds up both sets. Registers that either side fills are a sample of the union without
    replacement, nearly the whole of it for a small set, and the deviation shrinks with what
    is left out.
    """
    filled = ((many > 0) | (one > 0)).sum(1)
    estimate = (((many == one) & (one > 0)).sum(1) / np.maximum(filled, 1) - 1 / 255) * 255 / 254
    left_out = np.clip(1 - filled * (1 + threshold) / sizes, 0.02, 1)
    return estimate >= threshold - SIGMAS * np.sqrt(threshold * (1 - threshold) / np.maximum(filled, 1) * left_out)


def pairs_of_blocks(percent: int):
    """Two blocks of one bucket, members outside its main component and others, to the pairs that may be links.

    A pair that meets in several buckets is reported in the first one only.
    """
    threshold = percent / 100

    def run(rows: pa.Table) -> pa.Table:
        side = rows["odd"].to_numpy()
        x, y = (rows.filter(pa.array(side == odd)) for odd in (True, False))
        found: list[tuple[np.ndarray, np.ndarray]] = []
        if x.num_rows and y.num_rows:
            band = rows["band"][0].as_py()
            column = lambda t, name: t[name].to_numpy()
            matrix = lambda t, name, kind: np.frombuffer(b"".join(t[name].to_pylist()), kind).reshape(t.num_rows, -1)
            xk, yk = (signed(keys_of_bands(matrix(t, "registers", np.uint16))) for t in (x, y))
            xf, yf = (matrix(t, "fine", np.uint8) for t in (x, y))
            here = int(np.flatnonzero(xk[0] == band)[0])
            rep, root, n, common = (column(y, c) for c in ("rep", "root", "n", "common"))
            main = column(y, "main")
            for i, (r, o, m, c, p) in enumerate(zip(*(column(x, k) for k in ("rep", "root", "n", "common", "pivot")))):
                most = np.minimum(common, c)
                # Pairs with the pivot were tested before; of two odd members the smaller one asks.
                apart = (root != o) & ((root == main) | (r < rep)) & (rep != p) & (r != p)
                able = np.flatnonzero(apart & (100 * most >= percent * (n + m - most)))
                able = able[(xk[i, :here] != yk[able, :here]).all(1)]
                able = able[near_enough(xf[i], yf[able], m + n[able], threshold)]
                found.append((np.full(len(able), r), rep[able]))
        a, b = (np.concatenate([f[k] for f in found] or [np.zeros(0, np.int64)]) for k in (0, 1))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def sets_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The shingles of a column of sets, and the row each is from."""
    sets = column.to_pylist()
    return np.frombuffer(b"".join(sets), np.uint64), np.repeat(np.arange(len(sets)), [len(x) // 8 for x in sets])


def set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``shingles`` to one row per shingle."""
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array(signed(sets_of(batch.column("shingles"))[0]))], ["band"])


def leading_rows(percent: int, shared):
    """``rep, k1, shingles`` to the shingles that may be shared, of sets with enough of them, and how many of these lead.

    Of n shingles the n - ceil(n x percent) + 1 rarest lead. What occurs once is rarest and meets nothing.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = KeyFilter(shared.value)
        for batch in batches:
            rows = batch.num_rows
            value, doc = sets_of(batch.column("shingles"))
            held = known.may_hold(value)
            n = np.bincount(doc, minlength=rows)
            alone = n - np.bincount(doc[held], minlength=rows)
            left = n + (-percent * n // 100) + 1 - alone
            held = held[left[doc[held]] > 0]
            own = pa.array(doc[held])
            columns = [batch.column("rep").take(own), batch.column("k1").take(own), pa.array(left[doc[held]]), pa.array(signed(value[held]))]
            yield pa.RecordBatch.from_arrays(columns, ["rep", "k1", "left", "band"])

    return run


def similar_pairs(percent: int):
    """``a, b, sa, sb`` to the pairs whose sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = similar(*sets_of(batch.column("sa")), *sets_of(batch.column("sb")), batch.num_rows, percent)
            yield batch.select(["a", "b"]).filter(pa.array(good))

    return run


def links_of_blocks(percent: int):
    """Two blocks of one bucket of small sets, members outside its main component and others, to a forest of their links."""

    def run(rows: pa.Table) -> pa.Table:
        side = rows["odd"].to_numpy()
        x, y = (rows.filter(pa.array(side == odd)) for odd in (True, False))
        (xv, xd), (yv, yd) = sets_of(x["shingles"]), sets_of(y["shingles"])
        order = np.argsort(yv, kind="stable")
        yv, yd, n = yv[order], yd[order], np.bincount(yd, minlength=y.num_rows)
        rep, root, main = (y[c].to_numpy() for c in ("rep", "root", "main"))
        begin = np.searchsorted(xd, np.arange(x.num_rows + 1))
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i, (r, o) in enumerate(zip(x["rep"].to_numpy(), x["root"].to_numpy())):
            own = xv[begin[i] : begin[i + 1]]
            low, size = np.searchsorted(yv, own), np.searchsorted(yv, own, "right")
            size -= low
            at = np.arange(size.sum()) + np.repeat(low - np.cumsum(size) + size, size)
            common = np.bincount(yd[at], minlength=len(rep))
            # Of two odd members the smaller one asks.
            apart = (root != o) & ((root == main) | (r < rep))
            found = rep[apart & (100 * common >= percent * (n + len(own) - common))]
            a.append(np.full(len(found), r))
            b.append(found)
        a, b = forest(np.concatenate(a), np.concatenate(b))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def small_members(small: DataFrame, percent: int) -> DataFrame:
    """``band, rep, k1, pivot, pivot_k1``: the buckets of small sets by the shingles that lead them.

    ``small`` has ``rep, k1, n, shingles``.
    """
    often = small.select("shingles").mapInArrow(trimmed(set_rows), "band long").groupBy("band").agg(F.count(F.lit(1)).alias("often"))
    often = stored(often.filter("often > 1"))
    shared = key_filter(often.select("band"))
    rows = small.select("rep", "k1", "shingles").mapInArrow(trimmed(leading_rows(percent, shared)), "rep long, k1 long, left long, band long")
    # What the filter lets pass and occurs once keeps its place between the rarest and the others.
    rarity = Window.partitionBy("rep", "k1").orderBy(F.coalesce("often", F.lit(1)), "band")
    rows = rows.join(often, "band", "left").withColumn("place", F.row_number().over(rarity)).filter("place <= left and often > 1")
    rows = stored(rows.select("band", "rep", "k1"))
    first = F.min(F.struct("rep", "k1"))
    pivots = rows.groupBy("band").agg(first.alias("first"), F.count(F.lit(1)).alias("members")).filter("members > 1")
    pivots = pivots.select("band", F.col("first.rep").alias("pivot"), F.col("first.k1").alias("pivot_k1"), "members")
    return stored(rows.join(pivots, "band"))


def small_links(members: DataFrame, small: DataFrame, percent: int) -> DataFrame:
    """The links ``a, b`` of members of buckets with the pivots."""
    pairs = members.filter("rep <> pivot").select("rep", "k1", "pivot", "pivot_k1").distinct()
    one = small.select("rep", "k1", F.col("n").alias("na"), F.col("shingles").alias("sa"))
    two = small.select(F.col("rep").alias("pivot"), F.col("k1").alias("pivot_k1"), F.col("n").alias("nb"), F.col("shingles").alias("sb"))
    both = pairs.join(one, ["rep", "k1"]).join(two, ["pivot", "pivot_k1"])
    both = both.filter(f"100 * least(na, nb) >= {percent} * greatest(na, nb)")
    return stored(both.select(F.col("rep").alias("a"), F.col("pivot").alias("b"), "sa", "sb").mapInArrow(trimmed(similar_pairs(percent)), "a long, b long"))


def texts_of(reps: DataFrame, texts: DataFrame) -> DataFrame:
    """``rep, text`` of the documents in ``reps`` (one column), once each."""
    own = texts.join(beside(reps), texts["rep"] == reps["rep"], "left_semi")
    return stored(own.groupBy("rep").agg(F.first("text").alias("text")))


def linked(pairs: DataFrame, reps: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` that are links: first by their registers, then by their texts."""
    side = lambda x: reps.select(F.col("rep").alias(x), F.col("n").alias(f"n{x}"), F.col("registers").alias(f"r{x}"))
    known = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "na", "nb", "ra", "rb")
    likely = stored(known.mapInArrow(trimmed(plausible_pairs(percent / 100)), "a long, b long"))
    needed = stored(likely.select(F.col("a").alias("rep")).union(likely.select("b")).distinct())
    own = texts_of(needed, texts)
    both = likely.join(own.select(F.col("rep").alias("a"), F.col("text").alias("ta")), "a")
    both = both.join(own.select(F.col("rep").alias("b"), F.col("text").alias("tb")), "b")
    return stored(both.select("a", "b", "ta", "tb").mapInArrow(trimmed(confirmed(percent)), "a long, b long"))


def near_groups(docs: DataFrame, percent: int = PERCENT, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``, one row per row of ``docs``.

    Documents link when they share ``percent`` of the union of their shingles; components are
    joined by links. Null and empty texts have no shingles and link with nothing, and so do rows
    without id. Different texts under one id are different documents.
    """
    return grouped(docs, percent, id_column, text).drop("key", "first_key")


def row_key(id_column: str = "doc_id", text: str = "text") -> Column:
    """Names a document by its id and text: an id alone may be repeated."""
    return F.xxhash64(F.col(f"`{id_column}`").cast("long"), F.col(f"`{text}`"))


def grouped(docs: DataFrame, percent: int, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """As ``near_groups``, with the ``key`` of each row and that of the first row of its group."""
    source = docs.select(
        F.col(f"`{id_column}`").cast("long").alias("doc_id"), row_key(id_column, text).alias("key"), F.col(f"`{text}`").alias("text")
    )
    # A set that is similar to one of SMALL shingles has at most so many.
    limit = SMALL * 100 // percent
    sketch = stored(source.mapInArrow(trimmed(sketches(limit)), SKETCH_SCHEMA))
    full = sketch.filter("n > 0 and doc_id is not null")
    classes = stored(
        full.groupBy("k1", "k2").agg(F.min(F.struct("doc_id", "key", "n", "registers", "shingles")).alias("first")).select(
            "k1", "k2", F.col("first.doc_id").alias("least"), F.col("first.key").alias("rep"), "first.n", "first.registers", "first.shingles"
        )
    )
    reps = classes.filter(f"n > {SMALL}").select("rep", "n", "registers")
    small = classes.filter(f"n <= {limit}").select("rep", "k1", "n", "shingles")
    texts = source.select(F.col("key").alias("rep"), "text")
    bands = reps.select("rep", "registers").mapInArrow(trimmed(band_keys), "band long, rep long")
    pivots = bands.groupBy("band").agg(F.min("rep").alias("pivot"), F.count(F.lit(1)).alias("members")).filter("members > 1")
    members = stored(bands.join(pivots, "band"))
    first = members.filter("rep <> pivot").select(F.col("rep").alias("a"), F.col("pivot").alias("b")).distinct()
    small_buckets = small_members(small, percent)
    links = linked(first, reps, texts, percent).union(small_links(small_buckets, small, percent))
    settled = components(links)
    open_pairs = unsettled(members.filter("members > 2"), settled, reps, texts, percent)
    more = linked(open_pairs, reps, texts, percent)
    open_sets = in_blocks(contested(small_buckets.filter("members > 2"), settled, ["rep", "k1"]), small, ["rep", "k1"])
    small_more = open_sets.groupBy("band", "i", "j").applyInArrow(links_of_blocks(percent), "a long, b long")
    roots = components(links.union(more).union(small_more))
    known = classes.select("k1", "k2", "least", "rep").join(roots, F.col("rep") == F.col("node"), "left")
    known = known.select("k1", "k2", "least", "rep", F.coalesce("root", "rep").alias("root"))
    smallest = known.groupBy("root").agg(F.min(F.struct("least", "rep")).alias("first"))
    known = known.join(smallest, "root").select("k1", "k2", F.col("first.least").alias("component"), F.col("first.rep").alias("first_key"))
    found = sketch.withColumn("usable", F.expr("n > 0 and doc_id is not null")).join(known, ["k1", "k2"], "left")
    own = F.when(F.col("usable"), F.col("component")).otherwise(F.col("doc_id"))
    return found.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        own.alias("component_id"),
        own.eqNullSafe(F.col("doc_id")).alias("kept"),
        "key",
        F.when(F.col("usable"), F.col("first_key")).otherwise(F.col("key")).alias("first_key"),
    )


def contested(members: DataFrame, roots: DataFrame, own: list[str]) -> DataFrame:
    """The members of buckets in several components, with their root, the largest component and numbers of blocks."""
    joined = members.join(roots, F.col("rep") == F.col("node"), "left")
    joined = stored(joined.select("band", *own, "pivot", F.coalesce("root", "rep").alias("root")))
    sizes = joined.groupBy("band", "root").agg(F.count(F.lit(1)).alias("n"))
    main = sizes.groupBy("band").agg(
        F.max(F.struct("n", "root"))["root"].alias("main"),
        F.count(F.lit(1)).alias("roots"),
        F.ceil(F.sum("n") / BLOCK_MEMBERS).cast("int").alias("blocks"),
        F.ceil((F.sum("n") - F.max("n")) / BLOCK_MEMBERS).cast("int").alias("odd_blocks"),
    )
    return stored(joined.join(main.filter("roots > 1").drop("roots"), "band"))


def in_blocks(contested: DataFrame, looks: DataFrame, own: list[str]) -> DataFrame:
    """Members outside the largest component of their bucket (``odd``) beside the rest of it, in pairs of blocks."""
    place = lambda blocks: F.pmod(F.xxhash64("rep"), F.col(blocks)).cast("int")
    every = lambda blocks: F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))
    keys = ["band", *own, "root", "pivot", "main"]
    odd = contested.filter("root <> main").select(F.lit(True).alias("odd"), *keys, place("odd_blocks").alias("i"), every("blocks").alias("j"))
    rest = contested.select(F.lit(False).alias("odd"), *keys, every("odd_blocks").alias("i"), place("blocks").alias("j"))
    return odd.unionByName(rest).join(looks, own)


def unsettled(members: DataFrame, roots: DataFrame, reps: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` in a bucket that are in different components and may be links yet.

    Members outside the largest component of their bucket meet the rest of it, in blocks, so that
    a bucket of any size is dealt to many tasks. No link can share more shingles than the
    smaller number of those that a side has in common with any other document here, and what an
    edit made new occurs nowhere else; then FINE registers estimate the similarity. Only
    pairs that pass both become rows.
    """
    open_members = contested(members, roots, ["rep"])
    own = texts_of(stored(open_members.select("rep").distinct()), texts)
    twice = own.mapInArrow(trimmed(shingle_rows), "shingle long").groupBy("shingle").agg(F.count(F.lit(1)).alias("n"))
    looks = own.mapInArrow(trimmed(closer_looks(key_filter(twice.filter("n > 1").select("shingle")))), "rep long, common long, fine binary")
    looks = stored(looks.join(reps, "rep").filter(f"100 * common >= {percent} * n"))
    placed = in_blocks(open_members, looks, ["rep"])
    return placed.groupBy("band", "i", "j").applyInArrow(pairs_of_blocks(percent), "a long, b long")


def near_dedup(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that are the first of their group, with the columns of ``docs``.

    The first has the smallest id; of different texts under that id one stays, the same in every
    run. Rows that repeat an id and its text stay or go together.
    """
    groups = grouped(docs, percent)
    lost = beside(stored(groups.filter("key <> first_key").select(F.col("key").alias("_lost")).distinct()))
    return docs.join(lost, row_key() == lost["_lost"], "left_anti")


def op9_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents"))


OP9_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i+4], ' ') AS s
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM s x JOIN s y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 75 * (x.n + y.n - shared)),
r AS (SELECT doc_id AS node, doc_id AS seen FROM w UNION SELECT r.node, l.b FROM r JOIN l ON l.a = r.seen),
g AS (SELECT node, min(seen) AS component_id FROM r GROUP BY node)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, w.doc_id = component_id AS kept
FROM w JOIN g ON g.node = w.doc_id LEFT JOIN n ON n.doc_id = w.doc_id
"""
