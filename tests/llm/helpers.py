"""Small tables with the awkward cases, and the plain versions that operators are held against."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: Columns beside the usual ones, named like those the operators use inside.
CLASHING = ("row", "id", "sha", "n", "key", "size", "copies", "rep", "words", "value", "starts", "component", "token", "a.b")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHING)


def words(text: str | None, lower: bool = False) -> list[str]:
    return WORD.findall((text or "").translate(LOWER) if lower else text or "")


def sentence(seed: int, n: int) -> str:
    rnd = random.Random(seed)
    return " ".join("".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 7))) for _ in range(n))


def texts() -> list[tuple[int | None, str | None]]:
    """Ids and texts: nulls, empty, blank and very long ones, exact, near and partial copies, a large group."""
    base = sentence(1, 60)
    near = base.split()
    near[-1] = "changed"
    rows: list[tuple[int | None, str | None]] = [
        (10, base),
        (11, base.replace(" ", "\t", 3)),
        (12, base + " \n"),
        (13, " ".join(near)),
        (14, base.upper()),
        (15, None),
        (16, ""),
        (17, " \t\r\n"),
        (18, "one two"),
        (19, "one two"),
        (20, "ONE two"),
        (21, "naïve café – 東京 \U0001f600 it's 123"),
        (22, sentence(2, 20) + " " + " ".join(base.split()[5:40]) + " " + sentence(3, 20)),
        (23, "x" * 5000 + "  " + "ab" * 3000),
        (24, sentence(4, 30_000)),
        (25, "\x00\x1c\x85  odd\x0bspaces\x0c"),
        (None, base),
        (None, sentence(5, 40)),
        (26, sentence(6, 50)),
        (26, sentence(6, 50)),
    ]
    rows += [(100 + i, sentence(7, 45) + f" tail{i % 7}") for i in range(60)]
    rows += [(200 + i, sentence(1000 + i, 5 + i % 40)) for i in range(60)]
    return rows


def documents(spark, rows=None):
    """The texts as documents with clashing extra columns; sources repeat, one is null, one holds most rows."""
    rows = texts() if rows is None else rows
    source = lambda i: "a" if i % 3 else (None, "b", "ä", "c")[i // 3 % 4]
    data = [(i, t, "en", source(k), None, *("?" for _ in CLASHING)) for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(data, SCHEMA)


def roots(nodes, links) -> dict:
    """Smallest node that each node reaches."""
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}
