"""Sums over the words of texts that a small lexicon knows."""

from __future__ import annotations

import sys
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagtide.session import small_batches

# Sent to the workers by value: the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SUMS = "struct<polarity: double, rated: bigint, subjectivity: double, judged: bigint>"


def word_tables(lexicon: DataFrame, negators: Sequence[str], negation: float) -> Broadcast:
    """The words of a lexicon, which has each once, and of the negators, with their values in the same order.

    A word is ``rated`` if it has a polarity or a subjectivity, as a word before another it ``turns``
    and ``scales`` the polarity of that. The lexicon was counted to be small enough for a broadcast.
    """
    known = lexicon.filter("word IS NOT NULL").toArrow()
    listed = known["word"].to_pylist()
    new = sorted({*negators} - {*listed})
    words = pa.array([*listed, *new], pa.string())

    def column(name: str) -> tuple[np.ndarray, np.ndarray]:
        values = pa.array([*known[name].to_pylist(), *[None] * len(new)], pa.float64())
        return values.is_valid().to_numpy(zero_copy_only=False), values.fill_null(np.nan).to_numpy(zero_copy_only=False)

    (has_p, p), (has_s, s), (has_i, i) = column("polarity"), column("subjectivity"), column("intensity")
    # One more place, the last, for words that are not known.
    tables = {
        "words": words,
        "rated": np.append((has_p & (p != 0)) | (has_s & (s != 0)), False),
        "polarity": np.append(p, 0.0),
        "judged": np.append(has_s, False),
        "subjectivity": np.append(np.where(has_s, s, 0.0), 0.0),
        "turns": np.append(np.where(pc.is_in(words, pa.array([*negators], words.type)).to_numpy(zero_copy_only=False), negation, 1.0), 1.0),
        "scales": np.append(np.where(has_i, i, 1.0), 1.0),
    }
    return lexicon.sparkSession.sparkContext.broadcast(tables)


def _sums(tables: Broadcast) -> Callable[[pa.Array], pa.Array]:
    def sums(texts: pa.Array) -> pa.Array:
        t = tables.value
        words = t["words"]
        at = texts.offsets.to_numpy()
        spoken = texts.values.slice(at[0], at[-1] - at[0])
        at = at - at[0]

        def places(column: pa.Array) -> np.ndarray:
            found = pc.index_in(column, value_set=words.cast(column.type))
            return found.fill_null(len(words)).to_numpy(zero_copy_only=False)

        place = places(spoken)
        before = np.empty_like(place)
        before[1:] = place[:-1]
        first = at[:-1][np.diff(at) > 0]
        before[first] = places(pa.array([""], spoken.type))[0]
        text = np.repeat(np.arange(len(texts)), np.diff(at))
        hit = np.flatnonzero(t["rated"][place])
        place, before, text = place[hit], before[hit], text[hit]
        # As least and greatest of Spark do, fmin and fmax leave out what is missing.
        turned = t["polarity"][place] * t["turns"][before] * t["scales"][before]
        turned = np.fmax(-1.0, np.fmin(1.0, turned))
        n = len(texts)
        return pa.StructArray.from_arrays(
            [
                pa.array(np.bincount(text, turned, n), pa.float64()),
                pa.array(np.bincount(text, minlength=n), pa.int64()),
                pa.array(np.bincount(text, t["subjectivity"][place], n), pa.float64()),
                pa.array(np.bincount(text, t["judged"][place], n).astype(np.int64), pa.int64()),
            ],
            names=["polarity", "rated", "subjectivity", "judged"],
        )

    return sums


def word_sums(words: Column, tables: Broadcast, rows: DataFrame) -> Column:
    """For an array of words the sum of their polarities and how many are rated, and the same for subjectivity."""
    small_batches(rows.sparkSession)
    return F.arrow_udf(_sums(tables), SUMS)(words)
