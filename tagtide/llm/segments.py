"""Texts cut into segments that tokenizers treat by themselves, each distinct segment encoded once.

A segment's number indexes what is kept of it. What is kept has a bound in bytes and starts anew
beyond it, so a worker's memory does not grow with the corpus.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa

#: Bytes of the segments that a worker keeps between pieces of text (an entry's overhead counts as 64).
KEPT_BYTES = 16 << 20
#: Letters beyond ASCII that are one character in every normal form, with one lower-case letter each.
LATIN = "À-ÖØ-öø-įĲ-ňŊ-ž"
#: The characters that byte-level vocabularies write the bytes as that have no printable Latin-1 character.
SPELLED = {b: 256 + i for i, b in enumerate([*range(33), *range(127, 161), 173])}


def begins(offsets: np.ndarray) -> np.ndarray:
    """First bytes of the texts that have any."""
    return offsets[:-1][offsets[1:] > offsets[:-1]]


def at_words(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Segments begin with a text or with a byte after a blank (space and the controls 9 to 13)."""
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    first = np.zeros(len(data), bool)
    first[1:] = ~blank[1:] & blank[:-1]
    first[begins(offsets)] = True
    return np.flatnonzero(first)


def at_spaces(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Segments begin with a text or with a space after a character that is no white space, control or U+2581."""
    first = np.zeros(len(data), bool)
    at = np.flatnonzero(data == 32)
    at = at[at > 0]
    one = data[at - 1]
    two, three = data[np.maximum(at - 2, 0)], data[np.maximum(at - 3, 0)]
    wide = (two == 0xC2) & ((one == 0x85) | (one == 0xA0))
    wide |= (three == 0xE1) & (two == 0x9A) & (one == 0x80)
    wide |= (three == 0xE2) & (two == 0x80) & ((one <= 0x8A) | (one == 0xA8) | (one == 0xA9) | (one == 0xAF))
    wide |= (three == 0xE2) & (((two == 0x81) & (one == 0x9F)) | ((two == 0x96) & (one == 0x81)))
    wide |= (three == 0xE3) & (two == 0x80) & (one == 0x80)
    first[at[(one > 32) & (one != 127) & ~wide]] = True
    first[begins(offsets)] = True
    return np.flatnonzero(first)


class Ragged:
    """Rows of different lengths in one array."""

    def __init__(self, kind) -> None:
        self.flat, self.ends = np.zeros(0, kind), np.zeros(1, np.int64)

    def append(self, flat: np.ndarray, lengths: np.ndarray) -> None:
        self.flat = np.concatenate([self.flat, flat.astype(self.flat.dtype)])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(lengths)])

    def lengths(self, rows: np.ndarray) -> np.ndarray:
        return self.ends[rows + 1] - self.ends[rows]

    def gather(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows end to end, and the length of each."""
        lengths = self.lengths(rows)
        total = np.cumsum(lengths)
        shift = np.repeat(self.ends[rows] - (total - lengths), lengths)
        return self.flat[shift + np.arange(len(shift))], lengths


class Segments:
    """Numbers of segments. A subclass keeps what it needs of each new one in ``add``."""

    cut = staticmethod(at_words)
    kept_bytes: int | None = None

    def __init__(self) -> None:
        self.reset()

    def reset(self) -> None:
        self.known: dict[bytes, int] = {}
        self.held = 0

    def add(self, new: list[bytes]) -> None:
        raise NotImplementedError

    def numbers(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of each segment of some texts, and where each text begins among them (one more than texts)."""
        if self.held > (self.kept_bytes or KEPT_BYTES):
            self.reset()
        if not len(data):
            return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
        starts = self.cut(data, offsets)
        ends = np.append(starts, len(data)).astype(np.int64)
        whole = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(data)])
        coded = whole.dictionary_encode()
        values = coded.dictionary.to_pylist()
        of = np.array([*map(self.known.get, values, [-1] * len(values))], np.int64)
        missing = np.flatnonzero(of < 0)
        if len(missing):
            first, new = len(self.known), [values[i] for i in missing.tolist()]
            of[missing] = np.arange(first, first + len(new))
            self.known.update(zip(new, range(first, first + len(new))))
            self.held += sum(map(len, new)) + 64 * len(new)
            self.add(new)
        return of[coded.indices.to_numpy()], np.searchsorted(starts, offsets)


class Parts:
    """Ids of plain texts, part by part, by the model of a byte-level tokenizer without its other steps.

    ``pattern`` cuts parts as the tokenizer does where all characters are ASCII or LATIN, and takes
    a NUL as a part of its own.
    """

    def __init__(self, tokenizer, pattern: str) -> None:
        self.model, self.find = tokenizer.model, re.compile(pattern, re.ASCII).findall
        self.known: dict[str, list[int]] = {}

    def __call__(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text. Texts hold printable ASCII, its white space and LATIN only."""
        known, row = self.known, []
        rows = [row]
        if sum(map(len, known)) + 64 * len(known) > KEPT_BYTES:
            known.clear()
        for part in self.find("\0".join(texts)) if texts else ():
            if part == "\0":
                row = []
                rows.append(row)
                continue
            ids = known.get(part)
            if ids is None:
                ids = known[part] = [t.id for t in self.model.tokenize(part.encode().decode("latin-1").translate(SPELLED))]
            row += ids
        return rows[: len(texts)]


def split_rows(texts: list[str], is_easy: Callable[[str], object], easy, other) -> list[list[int]]:
    """Ids of all texts: plain ones by ``easy``, the rest by ``other``."""
    wide = [i for i, t in enumerate(texts) if not is_easy(t)]
    if not wide:
        return easy(texts)
    known = dict(zip(wide, other([texts[i] for i in wide])))
    rest = iter(easy([t for i, t in enumerate(texts) if i not in known]))
    return [known[i] if i in known else next(rest) for i in range(len(texts))]


def plain(segment: bytes) -> str:
    """A segment as text; bytes that are no UTF-8 become U+FFFD."""
    return segment.decode("utf-8", "replace")


def totals(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of the values of each text; ``at`` says where each begins."""
    return np.diff(np.concatenate([[0], np.cumsum(values)])[at])
