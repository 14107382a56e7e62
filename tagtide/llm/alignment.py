"""Alignment of two tokenizers by products of token-byte incidence matrices.

A text's tokens and bytes form a matrix with a one where a token holds a byte. With A and B the
matrices of two tokenizers over the same bytes, A times B transposed counts the bytes that two
tokens share: its entries are the overlap links. Offsets where both have a token's end cut the
tokens into groups; with G and H the token-group matrices, G times H transposed holds the
shared-group links. Matrices are compressed rows built here, and products go row by row
(Gustavson 1978): an entry of a row of the left side picks a row of the right one, and what has
been picked is added up by column.

Both tokenizers end a token before a space that follows a character, so no link crosses such a
space. Texts are cut there, and the matrices are set up once per distinct segment of a worker,
for all new segments at once.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagtide.llm.common import pieces, stored, table, utf8
from tagtide.llm.segments import LATIN, SPELLED, Parts, Ragged, Segments, at_spaces, plain, split_rows, totals

#: Entries that a step of a product picks at once.
STEP = 1 << 20
#: Plain text, and the parts that byte-level BPE cuts it into (fixed by the tokenizer).
EASY = re.compile(f"[ -~\t-\r{LATIN}]*").fullmatch
PARTS = f"\0|'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z{LATIN}]+| ?[0-9]+| ?[^\\sA-Za-z0-9{LATIN}\0]+|\\s+(?![^\\s\0])|\\s+"


class Csr:
    """A sparse matrix in compressed rows: row i has its columns and values at ``ptr[i] : ptr[i + 1]``."""

    def __init__(self, ptr: np.ndarray, col: np.ndarray, value: np.ndarray, columns: int) -> None:
        self.ptr, self.col, self.value, self.columns = ptr, col, value, columns

    @staticmethod
    def spans(ends: np.ndarray) -> Csr:
        """Row i has ones from where row i - 1 ends up to ``ends[i]``: tokens over their bytes."""
        n = int(ends[-1]) if len(ends) else 0
        return Csr(np.concatenate([[0], ends]), np.arange(n), np.ones(n, np.int64), n)

    @staticmethod
    def one_each(col: np.ndarray, columns: int) -> Csr:
        """Row i has a single one, at ``col[i]``: tokens in their groups."""
        return Csr(np.arange(len(col) + 1), col, np.ones(len(col), np.int64), columns)

    def rows(self) -> np.ndarray:
        """The row of each entry."""
        return np.repeat(np.arange(len(self.ptr) - 1), np.diff(self.ptr))

    def transposed(self) -> Csr:
        order = np.argsort(self.col, kind="stable")
        ptr = np.concatenate([[0], np.cumsum(np.bincount(self.col, minlength=self.columns))])
        return Csr(ptr, self.rows()[order], self.value[order], len(self.ptr) - 1)

    def times(self, other: Csr) -> Csr:
        """The product. Rows are taken in runs of about STEP picked entries."""
        picked = np.diff(other.ptr)[self.col]
        upto = np.concatenate([[0], np.cumsum(picked)])[self.ptr]
        counts, cols, values, row, n = [], [], [], 0, len(self.ptr) - 1
        while row < n:
            end = max(row + 1, int(np.searchsorted(upto, upto[row] + STEP, "right")) - 1)
            a, b = self.ptr[row], self.ptr[end]
            size = picked[a:b]
            start = other.ptr[self.col[a:b]]
            place = np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())
            of = np.repeat(np.repeat(np.arange(end - row), np.diff(self.ptr[row : end + 1])), size)
            key = of * other.columns + other.col[place]
            value = np.repeat(self.value[a:b], size) * other.value[place]
            if (key[1:] < key[:-1]).any():
                order = np.argsort(key, kind="stable")
                key, value = key[order], value[order]
            new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
            values.append(np.add.reduceat(value, new) if len(new) else value)
            cols.append(key[new] % max(1, other.columns))
            counts.append(np.bincount(key[new] // max(1, other.columns), minlength=end - row))
            row = end
        none = [np.zeros(0, np.int64)]
        ptr = np.concatenate([[0], np.cumsum(np.concatenate(counts or none))])
        return Csr(ptr, np.concatenate(cols or none), np.concatenate(values or none), other.columns)

    def times_vector(self, x: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(self.value * x[self.col])])[self.ptr])


def byte_level_bytes(pieces_of: list[str]) -> list[bytes]:
    """Bytes of byte-level tokens: printable Latin-1 stands for itself, the other bytes for U+0100 and on."""
    byte = {chr(SPELLED.get(b, b)): b for b in range(256)}
    return [bytes([byte[c] for c in p]) if all(c in byte for c in p) else p.encode() for p in pieces_of]


class Aligner(Segments):
    """Tokens, groups and links of segments by two tokenizers: byte-level BPE (A) and pieces (B)."""

    cut = staticmethod(at_spaces)

    def __init__(self, a_file: bytes, b_file: bytes) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tokenizers

        self.a = tokenizers.Tokenizer.from_str(a_file.decode())
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_file)
        self.parts = Parts(self.a, PARTS)
        n = self.a.get_vocab_size()
        self.a_bytes = byte_level_bytes([self.a.id_to_token(i) or "" for i in range(n)])
        names = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        # A piece with U+2581 behind another character could join two segments: then texts stay whole.
        if any("▁" in name.lstrip("▁") for name in names):
            self.cut = lambda data, offsets: offsets[:-1][offsets[1:] > offsets[:-1]]
        self.b_bytes = [
            bytes([int(name[3:5], 16)]) if self.b.is_byte(i) else name.replace("▁", " ").encode()
            for i, name in enumerate(names)
        ]
        self.a_size, self.b_size = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        self.a_names = [f"{i}{sign}" for i in range(n) for sign in ",|"]
        self.b_names = [f"{i}{sign}" for i in range(len(names)) for sign in ",;"]
        super().__init__()

    def reset(self) -> None:
        super().reset()
        self.a_ids, self.b_ids, self.pairs = Ragged(np.int32), Ragged(np.int32), Ragged(np.int32)
        self.a_groups, self.b_groups = Ragged(np.int32), Ragged(np.int32)
        self.over_a, self.over_b, self.over_n = Ragged(np.int32), Ragged(np.int32), Ragged(np.int32)
        self.n_groups, self.n_shared, self.bad = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
        self.texts: list[str] = []

    def add(self, new: list[bytes]) -> None:
        texts = [plain(s) for s in new]
        a_rows = split_rows(
            texts, EASY, self.parts, lambda texts: [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        )
        # Every segment begins with the space that B adds by itself, but to nothing.
        b_rows = [row or [self.b.piece_to_id("▁")] for row in self.b.encode([t[1:] for t in texts], num_threads=1)]
        bad = np.zeros(len(new), bool)
        for i, (s, a, b) in enumerate(zip(new, a_rows, b_rows)):
            if b"".join([self.a_bytes[x] for x in a]) != s or b"".join([self.b_bytes[x] for x in b]) != s:
                bad[i], a_rows[i], b_rows[i] = True, [], []
        a_count, b_count = (np.array([len(r) for r in rows], np.int64) for rows in (a_rows, b_rows))
        a, b = (np.array([x for r in rows for x in r], np.int64) for rows in (a_rows, b_rows))
        a_end, b_end = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        overlap = Csr.spans(a_end).times(Csr.spans(b_end).transposed())
        left, right = overlap.rows(), overlap.col
        ending = a_end[left] == b_end[right]
        edges = np.intersect1d(a_end, b_end, assume_unique=True)
        a_group, b_group = np.searchsorted(edges, a_end), np.searchsorted(edges, b_end)
        in_a, in_b = Csr.one_each(a_group, len(edges)), Csr.one_each(b_group, len(edges))
        # Row sums of the group product, without its entries: a group of n and m tokens has n times m.
        shared = in_a.times_vector(in_b.transposed().times_vector(np.ones(len(b), np.int64)))
        of_a, of_b = np.repeat(np.arange(len(new)), a_count), np.repeat(np.arange(len(new)), b_count)
        first_a, first_b = np.cumsum(a_count) - a_count, np.cumsum(b_count) - b_count
        last = np.searchsorted(a_group, np.arange(len(edges)), "right") - 1
        groups = np.bincount(of_a[last], minlength=len(new))
        first_group = np.cumsum(groups) - groups
        count = lambda rows: np.bincount(rows, minlength=len(new))
        self.a_ids.append(a, a_count)
        self.b_ids.append(b, b_count)
        self.a_groups.append(a_group - first_group[of_a], a_count)
        self.b_groups.append(b_group - first_group[of_b], b_count)
        self.pairs.append(a[left[ending]] * len(self.b_bytes) + b[right[ending]], count(of_a[left[ending]]))
        self.over_a.append(left - first_a[of_a[left]], count(of_a[left]))
        self.over_b.append(right - first_b[of_b[right]], count(of_a[left]))
        self.over_n.append(overlap.value, count(of_a[left]))
        self.n_groups = np.concatenate([self.n_groups, groups])
        self.n_shared = np.concatenate([self.n_shared, np.bincount(of_a, shared, len(new)).astype(np.int64)])
        self.bad = np.concatenate([self.bad, bad])
        # The ids in the order of the digest, each with the sign behind it.
        a_last, b_last = np.zeros(len(a), bool), np.zeros(len(b), bool)
        a_last[np.searchsorted(a_group, np.arange(len(edges)), "right") - 1] = True
        b_last[np.searchsorted(b_group, np.arange(len(edges)), "right") - 1] = True
        signed = np.empty(len(a) + len(b), object)
        signed[np.arange(len(a)) + np.searchsorted(b_group, a_group)] = [*map(self.a_names.__getitem__, (2 * a + a_last).tolist())]
        signed[np.arange(len(b)) + np.searchsorted(a_group, b_group, "right")] = [*map(self.b_names.__getitem__, (2 * b + b_last).tolist())]
        signed, ends = signed.tolist(), np.cumsum(a_count + b_count).tolist()
        self.texts += ["".join(signed[i:j])[:-1] for i, j in zip([0, *ends], ends)]


def _files(*paths: str) -> list[bytes]:
    """Vocabularies, read by the driver: their size does not depend on the corpus."""
    files = []
    for path in paths:
        with open(path, "rb") as file:
            files.append(file.read())
    return files


def _rows(docs: DataFrame, a_path: str, b_path: str, text: str, work, schema: str) -> DataFrame:
    """The rows as a struct, with columns that ``work`` makes of the segments of a piece of the texts."""
    spark, own = docs.sparkSession, F.col(f"`{text}`")
    held = spark.sparkContext.broadcast({"files": _files(a_path, b_path)})
    fields = [f.split(" ", 1) for f in schema.split(", ")]
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(row.alias("row"), F.when(own != "", F.concat(F.lit(" "), own)).alias("in"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        value = held.value
        aligner = value.setdefault("aligner", None) or Aligner(*value["files"])
        value["aligner"] = aligner
        for batch in pieces(batches, "in"):
            numbers, at = aligner.numbers(*utf8(batch.column(1)))
            # A text with a bad segment has no tokens at all.
            bad = totals(aligner.bad[numbers], at) > 0
            if bad.any():
                numbers = numbers[~np.repeat(bad, np.diff(at))]
                at = np.concatenate([[0], np.cumsum(np.where(bad, 0, np.diff(at)))])
            yield pa.RecordBatch.from_arrays([batch.column(0), *work(aligner, numbers, at)], ["row", *[n for n, _ in fields]])

    inner = "struct<" + ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in rows.schema["row"].dataType.fields) + ">"
    return rows.mapInArrow(run, f"row {inner}, {schema}")


def _lists(flat: np.ndarray, lengths: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int32)))


def align(docs: DataFrame, a_path: str, b_path: str, text: str = "text") -> DataFrame:
    """``docs`` with ids, groups and overlaps of the tokens of ``text`` by the tokenizers A and B.

    ``a_ids``, ``b_ids``: ids of space and text, in order. ``a_groups``, ``b_groups``: the group of
    each token, counted from 0. Tokens of one group are linked by it; a group's last tokens end
    together. ``over_a``, ``over_b``, ``over_bytes``: positions of two tokens that share bytes, and
    how many. Null and empty texts, and texts whose tokens do not join to space and text again, have
    empty lists. Rows stay as they are, repeated ones too; columns of the same name are replaced.
    """
    names = ["a_ids", "b_ids", "a_groups", "b_groups", "over_a", "over_b", "over_bytes"]

    def work(s: Aligner, numbers: np.ndarray, at: np.ndarray) -> list[pa.Array]:
        def column(kept: Ragged, base: np.ndarray | None = None) -> pa.Array:
            flat, lengths = kept.gather(numbers)
            if base is not None:
                # Counted within a segment; go on from the segments before it in the text.
                before = np.cumsum(base) - base
                start = before[np.minimum(at[:-1], max(0, len(before) - 1))] if len(before) else np.zeros(len(at) - 1, np.int64)
                flat = flat + np.repeat(before - np.repeat(start, np.diff(at)), lengths)
            return _lists(flat, totals(lengths, at))

        a, b, g = s.a_ids.lengths(numbers), s.b_ids.lengths(numbers), s.n_groups[numbers]
        return [
            column(s.a_ids),
            column(s.b_ids),
            column(s.a_groups, g),
            column(s.b_groups, g),
            column(s.over_a, a),
            column(s.over_b, b),
            column(s.over_n),
        ]

    kept = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in names])
    made = _rows(kept, a_path, b_path, text, work, ", ".join(f"{n} array<int>" for n in names))
    return made.select("row.*", *names)


def _documents(s: Aligner, numbers: np.ndarray, at: np.ndarray) -> list[pa.Array]:
    """Counts and digest of each text, its id pairs that end together, and how often each does."""
    n = len(at) - 1
    texts, bounds = s.texts, at.tolist()
    each = numbers.tolist()
    digests = [
        hashlib.sha256(";".join([texts[i] for i in each[a:b]]).encode()).hexdigest() if b > a else ""
        for a, b in zip(bounds, bounds[1:])
    ]
    pairs, lengths = s.pairs.gather(numbers)
    of = np.repeat(np.repeat(np.arange(n), np.diff(at)), lengths)
    keys, times = np.unique(of << 32 | pairs.astype(np.int64), return_counts=True)
    found = np.bincount(keys >> 32, minlength=n)
    groups = totals(s.n_groups[numbers], at)
    return [
        pa.array(totals(s.a_ids.lengths(numbers), at)),
        pa.array(totals(s.b_ids.lengths(numbers), at)),
        pa.array(groups),
        pa.array(totals(lengths, at)),
        pa.array(totals(s.n_shared[numbers], at)),
        pa.array(digests, pa.string()),
        _lists(keys & 0xFFFFFFFF, found),
        _lists(times, found),
    ]


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``pair, n``: how many links of all texts hold each id pair linked."""
    each = aligned.select(F.explode(F.arrays_zip("pairs", "times")).alias("p"))
    return each.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum(F.col("p.times").cast("long")).alias("n"))


def scored(docs: DataFrame, a_path: str, b_path: str, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_shared, n_best, count_sum, groups_sha256`` of each row.

    Links are tokens that end together; ``n_shared`` counts the shared-group links. Of two tokens
    that end together the shorter one's bytes end the longer one's, so there are at most as many id
    pairs as the tokens of both vocabularies have bytes (some 600,000), whatever the corpus: their
    counts may be broadcast. A row without id is a row of its own, as is a repeated one. Null, empty
    and changed texts have zeros and an empty digest.
    """
    schema = "n_a long, n_b long, n_groups long, n_links long, n_shared long, groups_sha256 string, pairs array<int>, times array<int>"
    own = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("_text"))
    texts = _rows(own, a_path, b_path, "_text", _documents, schema)
    texts = stored(texts.select("row.doc_id", *[f.split(" ")[0] for f in schema.split(", ")]))
    counts = pair_counts(texts)
    pieces_of_b = len(Aligner(*_files(a_path, b_path)).b_bytes)
    found = counts.toArrow().sort_by("pair")
    pair, n = found["pair"].to_numpy().astype(np.int64), found["n"].to_numpy()
    best = np.zeros(pieces_of_b, np.int64)
    np.maximum.at(best, pair % pieces_of_b, n)
    shared = docs.sparkSession.sparkContext.broadcast((pair, n, n == best[pair % pieces_of_b]))
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_shared", "groups_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, is_best = shared.value
        for batch in batches:
            codes, times = batch.column("pairs"), batch.column("times").flatten().to_numpy()
            offsets = codes.offsets.to_numpy().astype(np.int64)
            at = np.searchsorted(pair, codes.flatten().to_numpy())
            links = times.astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in names],
                    pa.array(totals(links * is_best[at] if len(at) else links, offsets - offsets[0])),
                    pa.array(totals(links * n[at] if len(at) else links, offsets - offsets[0])),
                ],
                [*names, "n_best", "count_sum"],
            )

    return texts.select(*names, "pairs", "times").mapInArrow(
        run,
        "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_shared long, groups_sha256 string, n_best long, count_sum long",
    )


def vocabularies() -> tuple[str, str]:
    """Paths of the two vocabularies that the registered query uses."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(table(spark, sf_dir, "documents"), *vocabularies())
