"""Packing of token sequences by exact complements, then best fit.

Documents are encoded and cut into pieces of at most one sequence. How pieces are combined depends
on their lengths only, and there are no more lengths than tokens in a sequence: Spark counts the
pieces of each length, and a plan is made on these counts. A plan's entry is a combination of
lengths and how often it is used. Starting from the longest, a gap is closed exactly by one, two or
three lengths whose sum is the gap, found through an index of the sums at hand; if there is none,
the longest length that fits goes in and the smaller gap is tried. A combination is used as often
as its lengths last, so the plan's size is bounded by the number of lengths, not by the corpus.

Pieces then take their places by their rank among those of their length. Ranks are counted within
the tasks that encoded them and shifted by the counts of the tasks before, so a length that a
third of all pieces have is never in one task.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tagtide.llm.common import BATCH_BYTES, SPACES, beside, pieces, stored, table, utf8
from tagtide.llm.segments import LATIN, Parts, Ragged, Segments, plain, split_rows

#: Tokens of a sequence, and the id that ends a document.
SEQUENCE, END = 4096, 1
EASY = re.compile(f"[!-~{LATIN}]*").fullmatch
#: The parts of lower-case words, fixed by the tokenizer.
PARTS = f"\0|'s|'t|'re|'ve|'m|'ll|'d|[a-z{LATIN}]+|[0-9]|[^\\sa-z0-9{LATIN}\0]+"


class WordIds(Segments):
    """Ids of white-space words by a tokenizer that drops white space and lower-cases, as the default one does."""

    kept_bytes = 48 << 20

    def __init__(self, file: bytes) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tokenizers

        self.tokenizer = tokenizers.Tokenizer.from_str(file.decode())
        self.tokenizer.encode_special_tokens = True
        self.parts = Parts(self.tokenizer, PARTS)
        super().__init__()

    def reset(self) -> None:
        super().reset()
        self.ids = Ragged(np.uint32)

    def add(self, new: list[bytes]) -> None:
        rows = split_rows(
            [plain(s).strip(SPACES) for s in new],
            EASY,
            lambda texts: self.parts([t.lower() for t in texts]),
            lambda texts: [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)],
        )
        lengths = np.array([len(r) for r in rows], np.int64)
        self.ids.append(np.array([x for r in rows for x in r], np.uint32), lengths)


def _encoded(path: str, spark: SparkSession, size: int, end: int):
    """Rows ``doc_id, text`` to pieces with their ids, the task, and the rank among its pieces of that length."""
    with open(path, "rb") as file:
        held = spark.sparkContext.broadcast({"file": file.read()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        value = held.value
        words = value.setdefault("words", None) or WordIds(value["file"])
        value["words"] = words
        task, seen = TaskContext.get().partitionId(), np.zeros(size + 1, np.int64)
        for batch in pieces(batches, "text", BATCH_BYTES):
            numbers, at = words.numbers(*utf8(batch.column("text")))
            flat, lengths = words.ids.gather(numbers)
            ends = np.concatenate([[0], np.cumsum(lengths)])[at]
            row, start, made = [], [], []
            for i, (a, b) in enumerate(zip(ends.tolist(), ends[1:].tolist())):
                ids = np.append(flat[a:b], np.uint32(end)).astype("<u4")
                for k in range(0, len(ids), size):
                    row.append(i)
                    start.append(k)
                    made.append(ids[k : k + size])
            length = np.array([len(p) for p in made], np.int64)
            # Rank among equal lengths: of this task so far, and within this batch.
            order = np.argsort(length, kind="stable")
            first = np.searchsorted(length[order], length[order])
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order)) - first + seen[length[order]]
            seen += np.bincount(length, minlength=size + 1)
            start = np.array(start, np.int64)
            offsets = pa.array(np.concatenate([[0], np.cumsum(length)]).astype(np.int32))
            every = np.concatenate(made) if made else np.zeros(0, np.uint32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(row, pa.int64())),
                    pa.array(start // size, pa.int32()),
                    pa.array(start),
                    pa.array(length),
                    pa.array([zlib.crc32(p.tobytes()) for p in made], pa.int64()),
                    pa.array(np.full(len(made), task)),
                    pa.array(rank),
                    pa.ListArray.from_arrays(offsets, pa.array(every.astype(np.int32))),
                ],
                ["doc_id", "piece", "start", "length", "ids_crc32", "task", "rank", "token_ids"],
            )

    return run


class Sums:
    """The lengths at hand, and which of them add up to a gap."""

    def __init__(self, counts: np.ndarray) -> None:
        self.left, self.size = counts.copy(), len(counts) - 1

    def one(self, gap: int) -> tuple[int, ...] | None:
        return (gap,) if self.left[gap] else None

    def two(self, gap: int, most: int) -> tuple[int, ...] | None:
        """The pair with the longest member, of at most ``most``."""
        first = np.arange(min(most, gap - 1), (gap - 1) // 2, -1)
        if not len(first):
            return None
        fits = (self.left[first] > 0) & (self.left[gap - first] > 0)
        if gap % 2 == 0 and first[-1] == gap // 2:
            fits[-1] = self.left[gap // 2] > 1
        at = int(fits.argmax())
        return (int(first[at]), int(gap - first[at])) if fits[at] else None

    def pair_sums(self, upto: int) -> np.ndarray:
        """True for every sum up to ``upto`` of two lengths at hand, by shifting the bits of all lengths at once."""
        bits = sum(1 << int(x) for x in np.flatnonzero(self.left[: upto + 1] > 0))
        found = 0
        for x in np.flatnonzero(self.left[: upto + 1] > 0).tolist():
            found |= bits << x
        data = np.frombuffer((found & ((1 << (upto + 1)) - 1)).to_bytes(upto // 8 + 1, "little"), np.uint8)
        return np.unpackbits(data, bitorder="little")[: upto + 1].astype(bool)

    def three(self, gap: int, sums: np.ndarray) -> tuple[int, ...] | None:
        """The triple with the longest member. ``sums`` may hold pairs that are no longer at hand."""
        first = np.arange(gap - 2, (gap - 1) // 3, -1)
        for x in first[(self.left[first] > 0) & sums[gap - first]].tolist():
            self.left[x] -= 1
            rest = self.two(gap - x, x)
            self.left[x] += 1
            if rest:
                return (x, *rest)
        return None

    def longest(self, gap: int) -> int:
        """The longest length at hand that fits in ``gap``; 0 if there is none."""
        at = np.flatnonzero(self.left[: gap + 1] > 0)
        return int(at[-1]) if len(at) else 0


def plan(counts: np.ndarray) -> list[tuple[int, list[int]]]:
    """Combinations of lengths, longest first, and how often each is used; ``counts[l]`` pieces have length l.

    Every piece is used once, and every combination fits in ``len(counts) - 1`` tokens.
    """
    at_hand, entries = Sums(counts), []
    sums, used = at_hand.pair_sums(at_hand.size), 0
    while True:
        first = at_hand.longest(at_hand.size)
        if not first:
            return entries
        # The index of pair sums is a superset of what is at hand: it is renewed now and then.
        used += 1
        if used % 64 == 0:
            sums = at_hand.pair_sums(at_hand.size)
        made, gap = [first], at_hand.size - first
        at_hand.left[first] -= 1
        while gap:
            found = at_hand.one(gap) or at_hand.two(gap, gap) or at_hand.three(gap, sums)
            if not found:
                best = at_hand.longest(gap)
                found = (best,) if best else ()
            for x in found:
                at_hand.left[x] -= 1
            made += found
            gap -= sum(found)
            if not found:
                break
        lengths, each = np.unique(made, return_counts=True)
        more = int((at_hand.left[lengths] // each).min())
        at_hand.left[lengths] -= more * each
        entries.append((1 + more, sorted(made, reverse=True)))


def places(entries: list[tuple[int, list[int]]], size: int) -> tuple[np.ndarray, ...]:
    """The plan as ranges of ranks: key (length and first rank), sequence, offset, and copies in a sequence.

    An entry has at most sqrt(2 * size) different lengths. It leaves some length l with fewer pieces
    than it has of it, at most size / l, and the next to do so at most half of these: fewer than
    3.5 * size entries. Sequences of 4096 tokens so have some 1.3 million ranges at most, whatever
    the corpus; measured are two or three per length.
    """
    taken, sequence, rows = np.zeros(size + 1, np.int64), 0, []
    for times, made in entries:
        offset = 0
        lengths, each = np.unique(made, return_counts=True)
        for length, copies in zip(lengths[::-1].tolist(), each[::-1].tolist()):
            rows.append((length, int(taken[length]), sequence, offset, copies))
            taken[length] += times * copies
            offset += length * copies
        sequence += times
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 5)
    return (table[:, 0] << 48 | table[:, 1], table[:, 1], table[:, 2], table[:, 3], table[:, 4])


def pack(
    docs: DataFrame,
    path: str,
    size: int = SEQUENCE,
    end: int = END,
    text: str = "text",
    id_column: str = "doc_id",
    with_ids: bool = True,
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` and ``token_ids`` of each piece.

    A document is the ids of its text and then ``end``. Null and empty texts are the end alone, so
    every row has a piece; rows without id and repeated rows are documents of their own. Strings of
    special tokens in a text are ordinary text. Only documents longer than ``size`` are cut. The
    vocabulary must be one of lower-cased words that drops white space (``WordIds``). Sequences count up from 0
    without a gap, and a sequence's offsets too. An empty table has no pieces.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, task long, rank long, token_ids array<int>"
    cut = rows.mapInArrow(_encoded(path, spark, size, end), schema)
    cut = stored(cut if with_ids else cut.drop("token_ids"))
    per_task = cut.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    per_task = stored(per_task.select("length", "task", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")))
    counts = np.zeros(size + 1, np.int64)
    for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect():
        counts[r.length] = r.n
    shared = spark.sparkContext.broadcast(places(plan(counts), size))
    ranked = cut.join(beside(per_task.drop("n")), ["length", "task"])

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first, sequence, offset, copies = shared.value
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            at = np.searchsorted(key, length << 48 | rank, "right") - 1
            inside = rank - first[at]
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in batch.schema.names if c != "rank"],
                    pa.array(sequence[at] + inside // copies[at]),
                    pa.array(offset[at] + inside % copies[at] * length),
                ],
                [*[c for c in batch.schema.names if c != "rank"], "sequence_id", "offset"],
            )

    names = ["doc_id", "piece", "start", "length", "ids_crc32", *(["token_ids"] if with_ids else [])]
    kinds = {f.name: f.dataType.simpleString() for f in cut.schema.fields}
    out = ", ".join([*[f"{c} {kinds[c]}" for c in names], "sequence_id long, offset long"])
    found = ranked.select(*names, (F.col("before") + F.col("rank")).alias("rank")).mapInArrow(placed, out)
    return found.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", *names[5:])


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, token_ids, doc_ids``: the pieces of each sequence in their order, at most its size together."""
    each = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "token_ids")))
    rows = packed.groupBy("sequence_id").agg(each.alias("p"))
    return rows.select("sequence_id", F.flatten("p.token_ids").alias("token_ids"), F.col("p.doc_id").alias("doc_ids"))


def vocabulary() -> str:
    """Path of the vocabulary that the registered query uses."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), vocabulary(), with_ids=False)
