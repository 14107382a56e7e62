"""Exact dedup: counting quotient filters find repeated fingerprints, bytes decide.

Every partition puts the fingerprints of its texts into a counting quotient filter and
hands it on in ranges of the quotient. The filters of a range merge without loss, as
sorted sequences of remainders whose counts add up. Only texts whose fingerprint counts
more than one are looked at again; they are grouped by their bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagtide.llm.common import SPACES, beside, parts_for, signed, stored, table

#: Fingerprints of one range of the merged filter, and repeated ones that may be broadcast (8 bytes each).
RANGE_ROWS, BROADCAST_KEYS = 250_000, 1_000_000


class QuotientFilter:
    """A counting quotient filter over 64-bit fingerprints, in its sorted form.

    The leading ``bits`` of a fingerprint are its quotient, the rest its remainder. The
    remainders of quotient q are ``remainders[ends[q - 1] : ends[q]]``, ascending, each once
    with its count, so a filter is the sorted multiset of what was put in: nothing is lost.
    """

    def __init__(self, values: np.ndarray, counts: np.ndarray, bits: int) -> None:
        low = np.uint64(64 - bits)
        self.bits = bits
        self.remainders = values & np.uint64((1 << (64 - bits)) - 1)
        quotients = (values >> low).astype(np.int64) if bits else np.zeros(len(values), np.int64)
        self.ends = np.cumsum(np.bincount(quotients, minlength=1 << bits))
        self.counts = counts

    @classmethod
    def of(cls, fingerprints: np.ndarray, bits: int) -> QuotientFilter:
        values, counts = np.unique(fingerprints, return_counts=True)
        return cls(values, counts.astype(np.int64), bits)

    @classmethod
    def merged(cls, filters: list[QuotientFilter]) -> QuotientFilter:
        """One filter with the counts of all: equal remainders of a quotient add up."""
        values = np.concatenate([f.fingerprints() for f in filters])
        counts = np.concatenate([f.counts for f in filters])
        order = np.argsort(values, kind="stable")
        values, counts = values[order], counts[order]
        first = np.flatnonzero(np.r_[True, values[1:] != values[:-1]][: len(values)])
        total = np.add.reduceat(counts, first) if len(first) else counts
        return cls(values[first], total, filters[0].bits)

    def fingerprints(self) -> np.ndarray:
        quotients = np.repeat(np.arange(1 << self.bits, dtype=np.uint64), np.diff(self.ends, prepend=0))
        return (quotients << np.uint64(64 - self.bits)) | self.remainders if self.bits else self.remainders

    def ranges(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Quotient, remainders and counts of every quotient in use."""
        for q in np.flatnonzero(np.diff(self.ends, prepend=0)):
            a, b = self.ends[q - 1] if q else 0, self.ends[q]
            yield int(q), self.remainders[a:b], self.counts[a:b]


RANGE_SCHEMA = "quotient int, remainders binary, counts binary"


def filters_of(bits: int):
    """Per partition: the quotient filter of its fingerprints, a row for each quotient."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = None
        for batch in batches:
            values = batch.column(0).drop_null().to_numpy(zero_copy_only=False).view(np.uint64)
            if len(values):
                new = QuotientFilter.of(values, bits)
                whole = QuotientFilter.merged([whole, new]) if whole else new
        if whole:
            rows = list(whole.ranges())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([q for q, _, _ in rows], pa.int32()),
                    pa.array([r.tobytes() for _, r, _ in rows], pa.binary()),
                    pa.array([c.tobytes() for _, _, c in rows], pa.binary()),
                ],
                ["quotient", "remainders", "counts"],
            )

    return run


def merge_range(bits: int):
    """All rows of one quotient: their merged filter's fingerprints that count more than one."""

    def run(rows: pa.Table) -> pa.Table:
        low = np.uint64(64 - bits)
        q = np.uint64(rows.column("quotient")[0].as_py())
        base = q << low if bits else np.uint64(0)
        filters = [
            QuotientFilter(base | np.frombuffer(r, np.uint64), np.frombuffer(c, np.int64), bits)
            for r, c in zip(rows.column("remainders").to_pylist(), rows.column("counts").to_pylist())
        ]
        whole = QuotientFilter.merged(filters)
        many = whole.counts > 1
        return pa.table(
            {"fp": signed(whole.fingerprints()[many]), "copies": whole.counts[many]},
            schema=pa.schema([("fp", pa.int64()), ("copies", pa.int64())]),
        )

    return run


def repeated(fingerprints: DataFrame, rows: int) -> DataFrame:
    """``fp, copies`` of the values of the only column that occur more than once."""
    bits = parts_for(rows, RANGE_ROWS).bit_length() - 1
    built = fingerprints.mapInArrow(filters_of(bits), RANGE_SCHEMA)
    return built.groupBy("quotient").applyInArrow(merge_range(bits), "fp long, copies long")


def normalised(text: Column) -> Column:
    """The text without any of the six white-space characters; null is empty."""
    return F.translate(F.coalesce(text, F.lit("")), SPACES, "")


def exact_groups(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256``: one row per row of ``docs``.

    Texts are equal when they agree byte by byte after white space is deleted; null is the
    empty text. Of equal texts the longest original in code points stays, then the smallest
    id. A null id is larger than any other. Rows that repeat an id and a text share their
    fate: each counts, and each is kept if that id is.
    """
    source = docs.select(F.col(id_column).alias("doc_id"), F.col(text).alias("text")).select(
        "doc_id", F.length(F.coalesce("text", F.lit(""))).alias("n"), normalised(F.col("text")).alias("plain")
    )
    digests = stored(
        source.select(
            "doc_id",
            F.unhex(F.sha2("plain", 256)).alias("sha"),
            F.xxhash64("plain").alias("fp"),
        )
    )
    twice = stored(repeated(digests.select("fp"), digests.count()))
    keys = twice.select("fp")
    if twice.count() <= BROADCAST_KEYS:
        keys = F.broadcast(keys)
    suspects = source.withColumn("fp", F.xxhash64("plain")).join(keys, "fp", "left_semi")
    # Bytes decide: rows meet by fingerprint and by the whole text. Copies are combined before the shuffle.
    by_length = suspects.groupBy("fp", "plain", "n").agg(
        F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("first_id")
    )
    groups = (
        by_length.select(F.unhex(F.sha2("plain", 256)).alias("sha"), "n", "copies", "first_id")
        .groupBy("sha")
        .agg(F.sum("copies").alias("copies"), F.max_by("first_id", "n").alias("keep_id"))
        .filter("copies > 1")
    )
    # One row per text on the right: a hot text on the left is split by the skew join.
    found = digests.select("doc_id", "sha").join(groups, "sha", "left")
    single = F.col("copies").isNull()
    return found.select(
        "doc_id",
        F.when(single, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("copies", F.lit(1)).cast("long").alias("group_size"),
        (single | F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def exact_dedup(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with the columns of ``docs``; a row that repeats id and text stays once."""
    groups = exact_groups(docs, id_column, text).select(
        F.col("doc_id").alias("id"), F.unhex("text_sha256").alias("sha"), "kept"
    )
    groups = stored(groups.groupBy("id", "sha", "kept").agg(F.count(F.lit(1)).alias("n")))
    lost = beside(stored(groups.filter(~F.col("kept")).select("id", "sha")))
    twice = beside(stored(groups.filter(F.col("kept") & (F.col("n") > 1)).select("id", "sha")))
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        docs[id_column].alias("id"),
        F.unhex(F.sha2(normalised(docs[text]), 256)).alias("sha"),
    )

    def same(other: DataFrame) -> Column:
        return rows["id"].eqNullSafe(other["id"]) & (rows["sha"] == other["sha"])

    rest = rows.join(lost, same(lost), "left_anti")
    again = rows.join(twice, same(twice), "left_semi").groupBy("id", "sha").agg(F.first("row").alias("row"))
    return rest.join(twice, same(twice), "left_anti").select("row.*").unionByName(again.select("row.*"))


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


OP1_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text,
                  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS plain FROM documents),
r AS (SELECT doc_id, plain,
             first_value(doc_id) OVER (PARTITION BY plain ORDER BY length(text) DESC, doc_id) AS keep_id,
             count(*) OVER (PARTITION BY plain) AS group_size FROM t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(plain) AS text_sha256 FROM r
"""
