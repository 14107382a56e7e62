"""Language-model scoring with log-frequency Bloom filters.

Counts of word pairs are quantised on a logarithmic scale; a pair on level q is put into the
filter q times, once with each level up to q. A worker reads a count back by asking for level
1, 2, 3 and so on until the filter says no (Talbot and Osborne 2007).

Every pair of the training texts is counted and kept. Pairs that make up at least SHARE of the
training tokens are in a filter that is broadcast with the words of that share: its size has a
proven bound, as there are at most 1 / SHARE such words, as many pairs, and twice as many filter
entries, each higher level holding at most half of the one below. All other pairs, whatever their
number, are in a filter that is cut in parts by a hash. What a text has of them is combined and
sent to the part, packed, and what comes back is a sum per text. Frequent pairs and words never
go that way, so no key is hot, and a task holds PART_ROWS rows whatever the corpus.

The probability of a word after another one draws on the quantised pair count and, with a weight
that grows with the context, on the add-one word probability (a Dirichlet prior):

    P(w | v) = (q(v, w) + m(v) P(w)) / (c(v) + m(v)),  P(w) = (c(w) + 1) / (N + V + 1)

m(v) is MU c(v)^POWER for a frequent context and RARE_MU for any other. So the logarithm of a text is
the sum of its word probabilities, of a factor per context, and of a gain per known pair.
A rare word's count is the number of its rows in its part, which knows all three.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagtide.llm.common import WordHasher, give_back, mix64, parts_for, pieces, signed, stored, table, utf8

#: Least share of a frequent word or pair in the training tokens, and the weights of the word probabilities.
SHARE, MU, POWER, RARE_MU = 1e-5, 4.0, 0.8, 24.0
#: Hashes and bits per filter entry, bits of a segment of the broadcast filter, counts a task holds at once.
HASHES, ENTRY_BITS, SEGMENT_BITS, HELD = 10, 24, 1 << 19, 1_500_000
#: Rows of a part of the other pairs, and rows and texts that a task packs at once (numbered in 16 bits).
PART_ROWS, PACK_ROWS, PACK_TEXTS = 2_000_000, 1_000_000, 60_000
#: The tasks that the parts are dealt to: some, and one more for every TASK_PARTS parts.
SUM_TASKS, TASK_PARTS = 16, 32
END, BEGIN = np.uint64(0xE7037ED1A0B428DB), np.uint64(0x8EBC6AF09C88C6E3)


def held_out(doc_id: Column, folds: int = 7, fold: int = 2) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == fold


class Tokens:
    """Word hashes of each text with an end token, and the token before each."""

    def __init__(self) -> None:
        self.hasher = WordHasher(lower=True)

    def of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        words, _, _, counts = self.hasher.words(*utf8(texts))
        n = len(counts)
        last = np.cumsum(counts + 1) - 1
        token = np.empty(len(words) + n, np.uint64)
        inner = np.ones(len(token), bool)
        inner[last] = False
        token[inner], token[last] = words, END
        before = np.empty_like(token)
        before[1:] = token[:-1]
        before[np.r_[0, last[:-1] + 1][:n]] = BEGIN
        return token, before, np.repeat(np.arange(n), counts + 1)


class Vocabulary:
    """The frequent words and the end: hashes in order, and counts. Contexts have one number more, for the beginning."""

    def __init__(self, hashes, counts, texts: int, total: int, distinct: int) -> None:
        self.hashes, self.counts = hashes, counts
        self.texts, self.total, self.distinct = texts, total, distinct
        self.scale = float(total + distinct + 1)
        after = np.concatenate([counts, [texts]]).astype(float)
        self.weight = MU * np.maximum(after, 1) ** POWER
        self.factor = np.log10(self.weight / (after + self.weight))

    def plain(self) -> tuple:
        """What the constructor takes, for a broadcast: workers make their own object from it."""
        return self.hashes, self.counts, self.texts, self.total, self.distinct

    def index(self, token: np.ndarray) -> np.ndarray:
        """Number of each token, -1 for a rare one."""
        if not len(self.hashes):
            return np.full(len(token), -1)
        at = np.minimum(np.searchsorted(self.hashes, token), len(self.hashes) - 1)
        return np.where(self.hashes[at] == token, at, -1)

    def contexts(self, before: np.ndarray) -> np.ndarray:
        return np.where(before == BEGIN, len(self.hashes), self.index(before))

    def share(self, index: np.ndarray) -> np.ndarray:
        """Word probability of frequent words, and of unseen ones (-1)."""
        if not len(self.counts):
            return np.full(len(index), 1 / self.scale)
        return np.where(index >= 0, self.counts[index] + 1, 1) / self.scale


def level_of(count: np.ndarray, least: float) -> np.ndarray:
    """Level of a count: 1 from ``least`` on, one more for each doubling."""
    return 1 + np.floor(np.log2(np.maximum(count, least) / least) + 1e-9).astype(np.int64)


def level_value(level: np.ndarray, least: float) -> np.ndarray:
    """The middle of the whole numbers on a level."""
    low, high = np.ceil(least * 2.0 ** (level - 1) - 1e-9), np.ceil(least * 2.0**level - 1e-9)
    return (low + np.maximum(high - 1, low)) / 2


def hash_pair(keys: np.ndarray, level: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
    """First position and step of the positions of (key, level)."""
    level = np.asarray(level).astype(np.uint64)
    first = mix64(keys * np.uint64(0x9FB21C651E98DF25) + level * np.uint64(0xC2B2AE3D27D4EB4F))
    return first, mix64(first ^ np.uint64(0xD6E8FEB86659FD93)) | np.uint64(1)


class PairFilter:
    """The log-frequency Bloom filter."""

    def __init__(self, data: np.ndarray, least: float) -> None:
        self.data, self.bits, self.least = data, np.uint64(8 * len(data)), least

    def present(self, keys: np.ndarray, level: int) -> np.ndarray:
        """Which keys are in the filter with this level."""
        first, step = hash_pair(keys, level)
        left = np.arange(len(keys))
        for i in range(HASHES):
            at = ((first[left] + np.uint64(i) * step[left]) % self.bits).astype(np.int64)
            left = left[(self.data[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1]
        return left

    def count(self, keys: np.ndarray) -> np.ndarray:
        """Quantised counts: levels are asked for until the first one that is not there."""
        level, alive, ask = np.zeros(len(keys), np.int64), np.arange(len(keys)), 1
        while len(alive):
            alive = alive[self.present(keys[alive], ask)]
            level[alive] = ask
            ask += 1
        return np.where(level > 0, level_value(np.maximum(level, 1), self.least), 0.0)


def counted(values_of) -> object:
    """Per partition: the values of each batch with their counts, added up in bounded memory."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = values_of()
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            value, where = np.unique(np.concatenate([v for v, _ in held]), return_inverse=True)
            return value, np.bincount(where, np.concatenate([c for _, c in held]), len(value)).astype(np.int64)

        def rows(value: np.ndarray, count: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(signed(value)), pa.array(count)], ["key", "c"])

        for batch in pieces(batches, "text"):
            held.append(np.unique(state(batch.column("text")), return_counts=True))
            size += len(held[-1][0])
            if size > HELD:
                held = [merged()]
                size = len(held[0][0])
                if size > HELD // 2:
                    yield rows(*held[0])
                    held, size = [], 0
        if held:
            yield rows(*merged())

    return run


def filter_segments(bits: int, least: float):
    """Per partition of ``key, c``: the segments of the filter that its entries touch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole: dict[int, np.ndarray] = {}
        for batch in batches:
            keys = batch.column("key").to_numpy().view(np.uint64)
            level = level_of(batch.column("c").to_numpy(), least)
            keys, ask = np.repeat(keys, level), np.concatenate([np.zeros(0, np.int64), *[np.arange(1, q + 1) for q in level]])
            first, step = hash_pair(keys, ask)
            for i in range(HASHES):
                at = ((first + np.uint64(i) * step) % np.uint64(bits)).astype(np.int64)
                for segment in np.unique(at // SEGMENT_BITS):
                    inside = at[at // SEGMENT_BITS == segment] % SEGMENT_BITS
                    data = whole.setdefault(int(segment), np.zeros(SEGMENT_BITS // 8, np.uint8))
                    np.bitwise_or.at(data, inside >> 3, (1 << (inside & 7)).astype(np.uint8))
        if whole:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(whole), pa.int32()), pa.array([d.tobytes() for d in whole.values()], pa.binary())],
                ["segment", "data"],
            )

    return run


def merge_segment(rows: pa.Table) -> pa.Table:
    """The union of all versions of one segment."""
    parts = [np.frombuffer(x, np.uint8) for x in rows["data"].to_pylist()]
    return pa.table({"segment": rows["segment"].slice(0, 1), "data": pa.array([np.bitwise_or.reduce(parts).tobytes()], pa.binary())})


class Model:
    """What is broadcast: the frequent words and the filter of frequent pairs."""

    def __init__(self, known: Vocabulary, pairs: PairFilter) -> None:
        self.known, self.pairs = known, pairs

    def plain(self) -> tuple:
        return self.known.plain(), self.pairs.data, self.pairs.least

    @classmethod
    def made(cls, known: tuple, data: np.ndarray, least: float) -> Model:
        return cls(Vocabulary(*known), PairFilter(data, least))

    def frequent(self, index: np.ndarray, context: np.ndarray) -> np.ndarray:
        """Quantised counts of the pairs that are frequent, 0 for the others."""
        count = np.zeros(len(index))
        both = np.flatnonzero((index >= 0) & (context >= 0))
        keys, where = np.unique(pair_keys(context[both], index[both]), return_inverse=True)
        count[both] = self.pairs.count(keys)[where]
        return count

    def terms(self, token: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Per token: its number and its context's or -1, the count of its pair if frequent, log10 of its word
        probability, and of its model probability as far as it is known here: rare words and other pairs as unseen."""
        known = self.known
        index, context = known.index(token), known.contexts(before)
        count, share = self.frequent(index, context), known.share(index)
        seen = np.flatnonzero(count)
        model = np.log10(share) + np.where(context >= 0, known.factor[context], 0.0)
        model[seen] += np.log10(1 + count[seen] / (known.weight[context[seen]] * share[seen]))
        return index, context, count, np.log10(share), model


def pair_keys(context: np.ndarray, index: np.ndarray) -> np.ndarray:
    return (context.astype(np.uint64) << np.uint64(32)) | index.astype(np.uint64)


def row_keys(doc_id: pa.Array, token: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """A hash of the id and the tokens with their places: it names a row, equal rows have one name."""
    n = len(doc_id)
    ids = doc_id.fill_null(-(1 << 62)).to_numpy().astype(np.int64).view(np.uint64)
    place = np.arange(len(token)) - np.searchsorted(doc, np.arange(n))[doc]
    total = np.concatenate([[np.uint64(0)], np.cumsum(mix64(token + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))])
    edge = np.searchsorted(doc, np.arange(n + 1))
    return mix64(mix64(total[edge[1:]] - total[edge[:-1]]) + mix64(ids))


DOC_SCHEMA = "doc_id long, row_key long, held_out boolean, n_tokens long, n_known long, base double, model double"


def score_rows(shared):
    """``doc_id, held_out, text`` to the counts and sums of each text by what is broadcast."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, model = Tokens(), Model.made(*shared.value)
        for batch in pieces(batches, "text"):
            n = batch.num_rows
            token, before, doc = tokens.of(batch.column("text"))
            index, _, _, base, score = model.terms(token, before)
            has_count = index >= 0
            if len(model.known.counts):
                has_count &= model.known.counts[index] > 0
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(signed(row_keys(batch.column("doc_id"), token, doc))),
                    batch.column("held_out"),
                    pa.array(np.bincount(doc, minlength=n).astype(np.int64)),
                    pa.array(np.bincount(doc, has_count, n).astype(np.int64)),
                    pa.array(np.bincount(doc, base, n)),
                    pa.array(np.bincount(doc, score, n)),
                ],
                ["doc_id", "row_key", "held_out", "n_tokens", "n_known", "base", "model"],
            )

    return run


#: Other pairs by which of their words are frequent, and what a row has beside the text's number and the times:
#: both (the pair), the context (the word's hash, the context's number), the word (the context's hash, the
#: word's number), none (both hashes). Rows of a rare word, and of a rare context, go to the part of its hash.
KINDS = ((np.uint64, None), (np.uint64, np.uint32), (np.uint64, np.uint32), (np.uint64, np.uint64))
BOTH, CONTEXT, WORD, NONE = range(4)


def packed(rows: list[np.ndarray], keys: np.ndarray, learn: np.ndarray) -> bytes:
    """Rows of one part (kind, owner, other, text, times; ordered by kind and text) and the texts they are from."""
    kind, owner, other, doc, times = rows
    own, doc = np.unique(doc, return_inverse=True)
    cut = np.searchsorted(kind, np.arange(5))
    parts = [np.array([len(own), *np.diff(cut)], np.int32), keys[own], learn[own].astype(np.uint8)]
    for k, (left, right) in enumerate(KINDS):
        at = slice(cut[k], cut[k + 1])
        parts += [owner[at].astype(left)] + ([other[at].astype(right)] if right else [])
        parts += [doc[at].astype(np.uint16), times[at].astype(np.uint32)]
    return b"".join(p.tobytes() for p in parts)


def unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray, list[tuple]]:
    """Keys and learning marks of the texts, and per kind owner, other, text and times."""
    sizes, at = np.frombuffer(data, np.int32, 5), 20

    def take(kind, n: int) -> np.ndarray:
        nonlocal at
        found = np.frombuffer(data, kind, n, at)
        at += found.nbytes
        return found

    keys, learn = take(np.uint64, sizes[0]), take(np.uint8, sizes[0]) > 0
    kinds = []
    for n, (left, right) in zip(sizes[1:], KINDS):
        owner = take(left, n)
        other = take(right, n).astype(np.uint64) if right else np.zeros(n, np.uint64)
        kinds.append((owner, other, take(np.uint16, n).astype(np.int64), take(np.uint32, n).astype(np.int64)))
    return keys, learn, kinds


def pair_rows(shared, n_parts: int):
    """``doc_id, held_out, text`` to the other pairs of the texts, each once per text, packed by part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        tokens, model = Tokens(), Model.made(*shared.value)
        waiting, texts, held = [], [], 0

        def flush() -> pa.RecordBatch:
            part, kind, owner, other, doc, times = (np.concatenate([w[i] for w in waiting]) for i in range(6))
            keys, learn = (np.concatenate([t[i] for t in texts]) for i in range(2))
            # Texts are numbered in 16 bits, kinds in two.
            order = np.argsort(part << 18 | kind << 16 | doc)
            part, *rows = (x[order] for x in (part, kind, owner, other, doc, times))
            found, first = np.unique(part, return_index=True)
            ends = np.append(first[1:], len(part))
            data = [packed([x[a:b] for x in rows], keys, learn) for a, b in zip(first, ends)]
            return pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(data, pa.binary())], ["part", "data"])

        for batch in pieces(batches, "text"):
            token, before, doc = tokens.of(batch.column("text"))
            index, context, count, _, _ = model.terms(token, before)
            first = sum(len(t[0]) for t in texts)
            texts.append((row_keys(batch.column("doc_id"), token, doc), ~batch.column("held_out").to_numpy(zero_copy_only=False).astype(bool)))
            left = np.flatnonzero(count == 0)
            index, context, token, before, doc = (x[left] for x in (index, context, token, before, doc))
            kind = np.where(index >= 0, np.where(context >= 0, BOTH, WORD), np.where(context >= 0, CONTEXT, NONE))
            owner = np.select([kind == BOTH, kind == WORD], [pair_keys(context, index), before], token)
            other = np.select([kind == CONTEXT, kind == WORD, kind == NONE], [context.astype(np.uint64), index.astype(np.uint64), before], np.uint64(0))
            mark = mix64(owner + mix64(other * np.uint64(4) + kind.astype(np.uint64))) + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            _, at, times = np.unique(mix64(mark), return_index=True, return_counts=True)
            part = (mix64(owner[at]) % np.uint64(n_parts)).astype(np.int64)
            waiting.append((part, kind[at], owner[at], other[at], doc[at] + first, times))
            held += len(at)
            if held > PACK_ROWS or first + batch.num_rows > PACK_TEXTS - 2_000:
                yield flush()
                waiting, texts, held = [], [], 0
        if held:
            yield flush()
        give_back()

    return run


def task_sums(shared):
    """Rows ``part, data``, ordered by part, to what each text gets from the parts of the task: known words, word and
    model logarithms.

    Parts are worked off one after another and their sums are added up per text in bounded memory, so that a text has
    a row per task and not one per part, of which there are the more the larger the corpus is.
    """
    names = ["row_key", "known", "base", "model"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_part = part_sums(shared)
        held: list[tuple[np.ndarray, ...]] = []
        size, part, data = 0, None, []

        def merged() -> tuple[np.ndarray, ...]:
            keys, where = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
            return keys, *(np.bincount(where, np.concatenate([h[i] for h in held]), len(keys)) for i in (1, 2, 3))

        def rows(sums: tuple[np.ndarray, ...]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(signed(sums[0])), *map(pa.array, sums[1:])], names)

        def work_off() -> Iterator[pa.RecordBatch]:
            nonlocal held, size
            held.append(of_part(data))
            size += len(held[-1][0])
            if size > HELD:
                held = [merged()]
                size = len(held[0][0])
                if size > HELD // 2:
                    yield rows(held[0])
                    held, size = [], 0

        for batch in batches:
            for own, blob in zip(batch.column("part").to_pylist(), batch.column("data").to_pylist()):
                if data and own != part:
                    yield from work_off()
                    data = []
                part = own
                data.append(blob)
        if data:
            yield from work_off()
        if held:
            yield rows(merged())
        give_back()

    return run


def part_sums(shared):
    """All rows of a part to what each text gets from them: its key, known words, word and model logarithms."""
    known = Model.made(*shared.value).known

    def run(data: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        blobs = [unpacked(x) for x in data]
        first = np.cumsum([0, *[len(b[0]) for b in blobs]])
        keys, learn = np.concatenate([b[0] for b in blobs]), np.concatenate([b[1] for b in blobs])
        kinds = []
        for k in range(4):
            shifted = [(o, x, d + f, t) for f, (o, x, d, t) in zip(first, (b[2][k] for b in blobs))]
            kinds.append(tuple(np.concatenate([c[i] for c in shifted]) for i in range(4)))
        n = len(keys)
        seen, base, model = np.zeros(n), np.zeros(n), np.zeros(n)
        # Counts of the rare words of this part: all their occurrences are here.
        words = np.concatenate([kinds[CONTEXT][0], kinds[NONE][0]])
        times = np.concatenate([np.where(learn[kinds[k][2]], kinds[k][3], 0) for k in (CONTEXT, NONE)])
        hashes, where = np.unique(words, return_inverse=True)
        counts = np.bincount(where, times, len(hashes))

        def count_of(owner: np.ndarray) -> np.ndarray:
            if not len(hashes):
                return np.zeros(len(owner))
            at = np.minimum(np.searchsorted(hashes, owner), len(hashes) - 1)
            return np.where(hashes[at] == owner, counts[at], 0.0)

        mark = [mix64(owner + mix64(other * np.uint64(4) + np.uint64(k))) for k, (owner, other, _, _) in enumerate(kinds)]
        pairs, pair = np.unique(np.concatenate(mark), return_inverse=True)
        doc, often = (np.concatenate([kinds[k][i] for k in range(4)]) for i in (2, 3))
        trained = np.bincount(pair, np.where(learn[doc], often, 0), len(pairs)).astype(np.int64)
        quantised = filled(pairs[trained > 0], trained[trained > 0]).count(pairs)[pair]
        at = 0
        for k, (owner, other, doc, times) in enumerate(kinds):
            q, at = quantised[at : at + len(owner)], at + len(owner)
            if k in (CONTEXT, NONE):
                c = count_of(owner)
                seen += np.bincount(doc, times * (c > 0), n)
                base += np.bincount(doc, times * np.log10(c + 1), n)
                # A rare word is a context as often as it occurs: the end alone is none, and it counts as frequent.
                model += np.bincount(doc, times * np.log10(RARE_MU / (c + RARE_MU)), n)
                share = (c + 1) / known.scale
                weight = known.weight[other.astype(np.int64)] if k == CONTEXT else RARE_MU
            elif k == BOTH:
                share = known.share((owner & np.uint64(0xFFFFFFFF)).astype(np.int64))
                weight = known.weight[(owner >> np.uint64(32)).astype(np.int64)]
            else:
                share, weight = known.share(other.astype(np.int64)), RARE_MU
            model += np.bincount(doc, times * np.log10(1 + q / (weight * share)), n)
        give_back()
        return keys, seen, base, base + model

    return run


def filled(keys: np.ndarray, counts: np.ndarray) -> PairFilter:
    """The filter of these pairs, with counts from 1 on."""
    level = level_of(counts, 1.0)
    size = 8 * max(1, -(-int(level.sum()) * ENTRY_BITS // 8))
    # A byte per bit while it is filled: the filter of a part is of the size of its rows.
    bits = np.zeros(size, bool)
    for q in range(1, int(level.max(initial=0)) + 1):
        start, step = hash_pair(keys[level >= q], q)
        for i in range(HASHES):
            bits[((start + np.uint64(i) * step) % np.uint64(size)).astype(np.int64)] = True
    return PairFilter(np.packbits(bits, bitorder="little"), 1.0)


def train(learn: DataFrame, share: float = SHARE) -> Model:
    """The frequent words and pairs of the texts of ``learn``."""
    texts = learn.select("text")

    def words():
        tokens = Tokens()
        return lambda column: tokens.of(column)[0]

    words_run = counted(words)
    vocab = stored(texts.mapInArrow(words_run, "key long, c long").groupBy("key").agg(F.sum("c").alias("c")))
    total, distinct = (x or 0 for x in vocab.agg(F.sum("c"), F.count(F.lit(1))).first())
    least = max(1.0, share * total)
    # At most 1 / share words can make up that share each, so what comes to the driver is bounded.
    end = int(signed(np.array([END]))[0])
    top = vocab.filter((F.col("c") >= least) | (F.col("key") == end)).toArrow()
    hashes, counts = top["key"].to_numpy().view(np.uint64), top["c"].to_numpy()
    if END not in hashes:
        hashes, counts = np.append(hashes, END), np.append(counts, 0)
    order = np.argsort(hashes)
    n_texts = int(counts[hashes == END].sum())
    known = Vocabulary(hashes[order], counts[order], n_texts, total, distinct)
    spark = learn.sparkSession
    words_known = spark.sparkContext.broadcast(known.plain())

    def pairs():
        tokens, found = Tokens(), Vocabulary(*words_known.value)

        def keys(column: pa.Array) -> np.ndarray:
            token, before, _ = tokens.of(column)
            index, context = found.index(token), found.contexts(before)
            both = (index >= 0) & (context >= 0)
            return pair_keys(context[both], index[both])

        return keys

    pairs_run = counted(pairs)
    often = texts.mapInArrow(pairs_run, "key long, c long").groupBy("key").agg(F.sum("c").alias("c"))
    often = stored(often.filter(F.col("c") >= least))
    level = 1 + F.floor(F.log2(F.col("c") / least) + 1e-9)
    entries = often.agg(F.sum(level)).first()[0] or 1
    bits = SEGMENT_BITS * max(1, -(-int(entries) * ENTRY_BITS // SEGMENT_BITS))
    segments = often.mapInArrow(filter_segments(bits, least), "segment int, data binary")
    found = segments.groupBy("segment").applyInArrow(merge_segment, "segment int, data binary").toArrow()
    data = np.zeros(bits // 8, np.uint8)
    for segment, part in zip(found["segment"].to_pylist(), found["data"].to_pylist()):
        data[segment * SEGMENT_BITS // 8 :][: SEGMENT_BITS // 8] = np.frombuffer(part, np.uint8)
    return Model(known, PairFilter(data, least))


def score(docs: DataFrame, learn: Column, share: float = SHARE) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row of ``docs``.

    The model learns from the rows where ``learn`` holds; the others are held out. A null text is
    empty: it has one token, its end. Words are told apart by 64-bit hashes. Without training
    rows every token is unknown. Rows with the same id and text get the same scores.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), (~learn).alias("held_out"))
    model = train(source.filter(~F.col("held_out")), share)
    shared = docs.sparkSession.sparkContext.broadcast(model.plain())
    total, scale = model.known.total, model.known.scale
    texts = source.select("doc_id", "held_out", "text")
    rows = stored(texts.mapInArrow(score_rows(shared), DOC_SCHEMA))
    tokens = rows.agg(F.sum("n_tokens")).first()[0] or 0
    n_parts = parts_for(tokens, PART_ROWS)
    blobs = texts.mapInArrow(pair_rows(shared, n_parts), "part int, data binary")
    # Many parts a task: what a text gets from them leaves the task as one row.
    dealt = blobs.repartition(SUM_TASKS + n_parts // TASK_PARTS, "part").sortWithinPartitions("part")
    sums = dealt.mapInArrow(task_sums(shared), "row_key long, known double, base double, model double")
    sums = sums.groupBy("row_key").agg(*[F.sum(c).alias(f"more_{c}") for c in ("known", "base", "model")])
    # Rows of one name were all counted: each gets its share.
    copies = rows.groupBy("row_key").agg(F.count(F.lit(1)).alias("copies"))
    more = sums.join(copies, "row_key")
    share_of = lambda c: F.coalesce(F.col(f"more_{c}") / F.col("copies"), F.lit(0.0))
    return rows.join(more, "row_key", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.round(share_of("known")).cast("long")).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + share_of("base")).alias("base_score"),
        (F.col("model") + share_of("model")).alias("score"),
        F.lit(scale).alias("base_scale"),
    )


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"), ~held_out(F.col("doc_id")))
