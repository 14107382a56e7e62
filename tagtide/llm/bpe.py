"""Byte-level BPE by tree reduction.

Token sequences form a monoid: the encoding of a text is joined from the encodings of its
halves. Where two encodings meet, a window around the seam is encoded again and grows until
the tokens beside it are settled. A seam is settled when the two tokens on it, encoded
together, come out as the same two tokens: merges are done in one order everywhere, so the
first merge across a seam would also happen between these two tokens alone. If no seam can be
crossed, nothing outside the window changes.

The pattern cuts a text into parts that are encoded by themselves, so the joins between parts
are plain concatenations. Texts are also cut between a letter and a space before the pattern
runs, where it always ends a part, so the pattern sees bounded pieces of a long text.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagtide.llm.common import PIECE_BYTES, give_back, pieces, table

#: Bytes of a leaf, parts in each of the two halves of a worker's cache, and bytes of the parts worth keeping.
LEAF_BYTES, CACHE_PARTS, CACHE_BYTES = 64, 60_000, 32


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a tiktoken file: base64 and a number on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class Coder:
    """Encodes and decodes with one vocabulary of ranks."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        import regex

        self.ranks, self.never = ranks, len(ranks) + max(ranks.values(), default=0)
        self.single = [bytes([x]) for x in range(256)]
        self.double = [ranks.get(bytes([x, y]), self.never) for x in range(256) for y in range(256)]
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.names = {rank: str(rank) for rank in self.bytes_of}
        self.parts = regex.compile(pattern).findall
        # Parts met lately, and those before them: what is met again moves on, the rest is forgotten.
        self.known: dict[str, tuple[str, bytes]] = {}
        self.older: dict[str, tuple[str, bytes]] = {}
        self.settled: dict[tuple[int, int], bool] = {}

    def merge(self, data: bytes) -> list[int]:
        """Plain BPE: the adjacent pair of the lowest rank is merged, the leftmost first."""
        rank_of, never, single, double = self.ranks.get, self.never, self.single, self.double
        tokens = [single[x] for x in data]
        pairs = [double[x << 8 | y] for x, y in zip(data, data[1:])]
        while pairs:
            best = min(pairs)
            if best == never:
                break
            i = pairs.index(best)
            token = tokens[i] + tokens[i + 1]
            tokens[i] = token
            del tokens[i + 1], pairs[i]
            if i < len(pairs):
                pairs[i] = rank_of(token + tokens[i + 1], never)
            if i:
                pairs[i - 1] = rank_of(tokens[i - 1] + token, never)
        return [self.ranks[t] for t in tokens]

    def is_settled(self, left: int, right: int) -> bool:
        """True if no merge can cross the seam between these two tokens."""
        seam = (left, right)
        if seam not in self.settled:
            if len(self.settled) > CACHE_PARTS // 4:
                self.settled.clear()
            self.settled[seam] = self.merge(self.bytes_of[left] + self.bytes_of[right]) == [left, right]
        return self.settled[seam]

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of two neighbouring texts from their encodings."""
        if not left or not right or self.is_settled(left[-1], right[0]):
            return left + right
        a, b = 1, 1
        while True:
            window = self.tree(self.decode(left[-a:] + right[:b]), halve=False)
            fits_left = a >= len(left) or self.is_settled(left[-a - 1], window[0])
            fits_right = b >= len(right) or self.is_settled(window[-1], right[b])
            if fits_left and fits_right:
                return left[: len(left) - a] + window + right[b:]
            a = a if fits_left else min(2 * a, len(left))
            b = b if fits_right else min(2 * b, len(right))

    def tree(self, data: bytes, halve: bool = True) -> list[int]:
        if len(data) <= LEAF_BYTES or not halve:
            return self.merge(data)
        half = len(data) // 2
        return self.join(self.tree(data[:half]), self.tree(data[half:]))

    def part(self, part: str) -> list[int]:
        """Ids of one match of the pattern; a part that is a token is that token."""
        data = part.encode("utf-8", "surrogatepass")
        rank = self.ranks.get(data)
        return [rank] if rank is not None else self.tree(data)

    def cuts(self, text: str) -> Iterator[str]:
        """Pieces of the text that end between a non-space and a space, where a part ends too."""
        start, n = 0, len(text)
        while n - start > PIECE_BYTES:
            at = text.find(" ", start + PIECE_BYTES)
            while at > 0 and text[at - 1].isspace():
                at = text.find(" ", at + 1)
            if at < 0:
                break
            yield text[start:at]
            start = at
        yield text[start:]

    def entries(self, text: str) -> Iterator[tuple[str, bytes]]:
        """Ids joined by commas, and what they decode to, of each piece of the text."""
        for piece in self.cuts(text):
            known, look_up = self.known, self._look_up
            parts = [known.get(part) or look_up(part) for part in self.parts(piece)]
            if parts:
                names, decoded = zip(*parts)
                yield ",".join(names), b"".join(decoded)
            if len(known) > CACHE_PARTS:
                self.older, self.known = known, {}

    def encode(self, text: str) -> list[int]:
        return [int(i) for names, _ in self.entries(text) for i in names.split(",")]

    def decode(self, ids: list[int]) -> bytes:
        """Bytes of the tokens, one after the other."""
        return b"".join([self.bytes_of[i] for i in ids])

    def _look_up(self, part: str) -> tuple[str, bytes]:
        entry = self.older.get(part)
        if entry is None:
            ids = self.part(part)
            entry = (",".join([self.names[i] for i in ids]), self.decode(ids))
        if len(part) <= CACHE_BYTES:
            self.known[part] = entry
        return entry

    def digests(self, text: str) -> tuple[int, str, str]:
        """Number of tokens, digest of the ids joined by commas, and digest of the decoded bytes."""
        digest, decoded, n = hashlib.sha256(), hashlib.sha256(), 0
        for names, data in self.entries(text):
            digest.update((("," if n else "") + names).encode())
            decoded.update(data)
            n += names.count(",") + 1
        return n, digest.hexdigest(), decoded.hexdigest()


def _coder(spark: SparkSession, path: str, pattern: str):
    """A vocabulary is read by the driver and broadcast: its size is fixed, whatever the corpus.

    A worker keeps its coder beside it, so that the parts it knows serve its next task too.
    """
    return spark.sparkContext.broadcast({"vocabulary": (load_ranks(path), pattern)})


def _mapped(docs: DataFrame, column: str, path: str, pattern: str, work, fields: list[tuple[str, pa.DataType]], schema: str):
    """``docs`` with columns computed from ``column`` row by row; columns of the same name are replaced."""
    shared = _coder(docs.sparkSession, path, pattern)
    names = [n for n, _ in fields]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in names]).alias("row"), docs[column].alias("in"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        coder = held.setdefault("coder", None) or Coder(*held["vocabulary"])
        held["coder"] = coder
        give_back()
        # The Python objects of a piece are gone before the next one's are made.
        for batch in pieces(batches, "in") if column != "token_ids" else batches:
            made = [work(coder, value) for value in batch.column(1).to_pylist()]
            columns = [pa.array([m[i] for m in made], kind) for i, (_, kind) in enumerate(fields)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["row", *names])
            del made, columns
        give_back()

    inner = ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in rows.schema["row"].dataType.fields)
    return rows.mapInArrow(run, f"row struct<{inner}>, {schema}").select("row.*", *names)


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """``docs`` with ``token_ids``; null is the empty text and has no tokens."""
    work = lambda coder, value: (coder.encode(value or ""),)
    return _mapped(docs, text, path, pattern, work, [("token_ids", pa.list_(pa.int32()))], "token_ids array<int>")


def decode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``docs`` with ``decoded``, the bytes of ``token_ids``; null ids give no bytes."""
    work = lambda coder, value: (coder.decode(value or []),)
    return _mapped(docs, "token_ids", path, pattern, work, [("decoded", pa.binary())], "decoded binary")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: each text encoded, and its ids decoded again."""
    work = lambda coder, value: coder.digests(value or "")
    fields = [("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    schema = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    texts = docs.select("doc_id", docs["text"].alias("_text"))
    return _mapped(texts, "_text", path, pattern, work, fields, schema).select("doc_id", *[n for n, _ in fields])


def encode_with_digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``docs`` with ``n_tokens``, ``token_ids`` and the digests of the ids and of the bytes they decode to."""

    def work(coder: Coder, value: str | None) -> tuple:
        ids = array("i")
        digest, decoded = hashlib.sha256(), hashlib.sha256()
        for names, data in coder.entries(value or ""):
            digest.update((("," if ids else "") + names).encode())
            decoded.update(data)
            ids.extend(map(int, names.split(",")))
        return len(ids), np.frombuffer(ids, np.int32), digest.hexdigest(), decoded.hexdigest()

    fields = [("n_tokens", pa.int64()), ("token_ids", pa.list_(pa.int32())), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    return _mapped(docs, "text", path, pattern, work, fields, "n_tokens long, token_ids array<int>, ids_sha256 string, decoded_sha256 string")


def vocabulary() -> tuple[str, str]:
    """Path and pattern of the vocabulary that the registered queries use."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"), *vocabulary())
