"""Text expressions over post contents.

Patterns spell out ``[\\p{L}\\p{N}_]`` for word characters and the full Unicode
white space, because the short classes of Java cover ASCII only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tagtide.functions.arrays import let

# Patterns and bounds that decide the results.
TAG_PATTERN = r"<[^>]+>"
WORD_CHARS = r"\p{L}\p{N}_"
SPACE_CHARS = r"\s\x0B\x1C-\x1F\x85\p{Z}"
INLINE_HASHTAG = rf"#([{WORD_CHARS}]+)"
NOT_AN_ASPECT = ("The", "This", "That")
MIN_ASPECT_LENGTH, MAX_ASPECT_LENGTH = 3, 50
MIN_CONTENT_LENGTH = 5

# Function words that end a phrase. A parameter of every phrase operator.
STOPWORDS = (
    "a", "about", "after", "all", "an", "and", "any", "are", "as", "at", "be", "been", "but",
    "by", "can", "did", "do", "for", "from", "had", "has", "have", "he", "her", "his", "how",
    "i", "if", "in", "into", "is", "it", "its", "me", "my", "no", "not", "of", "on", "or",
    "our", "she", "so", "that", "the", "their", "them", "then", "there", "they", "this", "to",
    "was", "we", "were", "what", "when", "which", "who", "will", "with", "you", "your",
)


def clean_html(c: Column) -> Column:
    """Text without tags. Entities stay as they are; NULL gives an empty text."""
    return F.regexp_replace(F.coalesce(c, F.lit("")), TAG_PATTERN, "")


def content_length(c: Column) -> Column:
    """Characters of the cleaned text, as a 32-bit float."""
    return F.length(clean_html(c)).cast("float")


def hashtag_count(tags: Column) -> Column:
    """Number of tags; NULL for a NULL array."""
    return F.size(tags)


def words(c: Column) -> Column:
    """Parts between runs of white space."""
    return F.filter(F.split(c, f"[{SPACE_CHARS}]+"), lambda w: w != "")


def simple_aspect(text: Column) -> Column:
    """First capitalised word of more than three letters, in lower case, or NULL."""
    bare = F.transform(words(text), lambda w: F.regexp_replace(w, f"[^{WORD_CHARS}]", ""))
    named = F.filter(
        bare,
        lambda w: (F.length(w) > 3) & w.rlike(r"^\p{IsUppercase}") & ~w.isin(*NOT_AN_ASPECT),
    )
    first = F.lower(F.get(named, F.lit(0)))
    return F.when(F.length(text) >= MIN_CONTENT_LENGTH, first)


first_aspect = simple_aspect


def inline_hashtags(text: Column) -> Column:
    """Tags written inside the text, in lower case, duplicates kept."""
    return F.regexp_extract_all(F.lower(text), F.lit(INLINE_HASHTAG), F.lit(1))


def split_sentences(text: Column, variant: str = "punctuation") -> Column:
    """Sentences of a text.

    ``period`` cuts at every full stop and keeps empty parts. ``punctuation`` cuts at
    white space that follows a full stop, exclamation or question mark.
    """
    if variant == "period":
        return F.split(text, r"\.")
    if variant == "punctuation":
        return F.filter(F.split(text, r"(?<=[.!?])\s+"), lambda s: F.length(s) > 0)
    raise ValueError(f"unknown sentence variant {variant!r}")


def length_band(c: Column, lo: int = MIN_ASPECT_LENGTH, hi: int = MAX_ASPECT_LENGTH) -> Column:
    """True for texts of ``lo`` to ``hi`` characters."""
    return F.length(c).between(lo, hi)


def snippet(c: Column, n: int) -> Column:
    """The first ``n`` characters."""
    return F.substring(c, 1, n)


def norm_aspect(c: Column) -> Column:
    """Trimmed and in lower case."""
    return F.lower(F.trim(c))


def tokens(text: Column) -> Column:
    """Words of a text in lower case, in order."""
    # Letters a to z are named first, as most are, and no match is tried twice: both only save time.
    return F.regexp_extract_all(F.lower(text), F.lit(rf"[a-z{WORD_CHARS}']++"), F.lit(0))


def phrases(text: Column, stopwords: Sequence[str] = STOPWORDS, lo: int = MIN_ASPECT_LENGTH) -> Column:
    """Candidate phrases: longest runs of words without a stop word or punctuation.

    The stand-in for noun phrases (RAKE, Rose et al. 2010). In text order,
    duplicates kept, at least ``lo`` characters.
    """
    marked = F.regexp_replace(F.lower(text), rf"[^a-z {WORD_CHARS}'{SPACE_CHARS}-]++", " | ")
    stop = list(stopwords)
    cut = F.transform(
        words(marked),
        # Only a word before "." begins with a sign: few are compared with the pattern.
        lambda w: F.when(w.isin(*stop) | ((w < ".") & w.rlike("^['-]+$")), F.lit("|")).otherwise(w),
    )
    runs = F.transform(F.split(F.array_join(cut, " "), r"\|"), lambda p: F.trim(p))
    return F.filter(runs, lambda p: F.length(p) >= lo)


def dominant(parts: Column) -> Column:
    """The most frequent element of an array; the first one seen wins a tie.

    Equal elements are brought together by sorting, so long arrays stay cheap.
    """
    def best(pairs: Column) -> Column:
        def is_start(i: Column) -> Column:
            return (i == 0) | (F.get(pairs, i)["p"] != F.get(pairs, i - 1)["p"])

        def pick(starts: Column) -> Column:
            runs = F.transform(
                starts,
                lambda at, j: F.struct(
                    (F.coalesce(F.get(starts, j + 1), F.size(pairs)) - at).alias("n"),
                    (-F.get(pairs, at)["i"]).alias("early"),
                    F.get(pairs, at)["p"].alias("p"),
                ),
            )
            return F.array_max(runs)["p"]

        return let(F.filter(F.sequence(F.lit(0), F.size(pairs) - 1), is_start), pick)

    ordered = F.array_sort(F.transform(parts, lambda p, i: F.struct(p.alias("p"), i.alias("i"))))
    return let(ordered, lambda pairs: F.when(F.size(pairs) > 0, best(pairs)))
