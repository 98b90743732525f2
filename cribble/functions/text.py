"""Text functions as column expressions; all stay in the JVM.

White space follows Unicode (as Python's ``str.isspace``): the JVM class
``(?U)\\s`` and the four separators U+001C to U+001F.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

WS = r"[\s\x1c-\x1f]"


def strip(c: Column) -> Column:
    """Removes white space at both ends; null stays null."""
    return F.regexp_replace(c, rf"(?U)\A{WS}+|{WS}+\z", "")


def normalize_whitespace(c: Column) -> Column:
    """One kind of line end, single blanks, at most one empty line, stripped."""
    steps = [(r"\r\n?", "\n"), (r"[ \t]+", " "), (r"\n{3,}", "\n\n")]
    return strip(reduce(lambda x, s: F.regexp_replace(x, *map(F.lit, s)), steps, c))


def content_hash(title: Column, content: Column) -> Column:
    """SHA-256 (hex) of the lower-cased, normalised title, newline and content. Nulls count as empty."""
    both = F.concat(F.coalesce(title, F.lit("")), F.lit("\n"), F.coalesce(content, F.lit("")))
    return F.sha2(F.lower(normalize_whitespace(both)), 256)


# The patterns that a title loses, in this order.
TITLE_STEPS = [
    (r"\[[^\]]{0,12}\]", ""),
    (r"(?dU)\s*[-|·]\s*[^-|·]{1,20}$", ""),
    (r"(?U)(모바일|재게시|전재|송고)\s*[:\-]?\s*", ""),
    (r"([!?.…,~])\1+", "$1"),
    (rf"(?U){WS}+", " "),
]


def normalize_title(c: Column) -> Column:
    """Title without bracket tags, outlet suffix, repost marks and repeated punctuation."""
    return strip(reduce(lambda x, s: F.regexp_replace(x, *map(F.lit, s)), TITLE_STEPS, c))


def words(c: Column) -> Column:
    """Distinct maximal runs of non-white-space in order of appearance; null gives an empty array."""
    parts = F.split(F.coalesce(c, F.lit("")), rf"(?U){WS}+")
    return F.array_distinct(F.filter(parts, lambda x: x != ""))


def fingerprint(c: Column) -> Column:
    """The sorted distinct words joined by one blank."""
    return F.array_join(F.array_sort(words(c)), " ")


def jaccard(a: Column, b: Column) -> Column:
    """Jaccard similarity of two arrays of distinct items; 0 where one is empty."""
    both = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - both
    return F.when((F.size(a) > 0) & (F.size(b) > 0), both / union).otherwise(F.lit(0.0))


def bigrams(c: Column) -> Column:
    """Character bigrams without white space; a single character stands for itself."""
    s = F.regexp_replace(F.coalesce(c, F.lit("")), rf"(?U){WS}+", "")
    n = F.length(s)
    many = F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.substring(s, i, F.lit(2)))
    return F.when(n >= 2, many).when(n == 1, F.array(s)).otherwise(F.array().cast("array<string>"))


def title_cosine(a: Column, b: Column) -> Column:
    """Cosine of the bigram counts of two normalised titles; 0 where one is empty."""

    def dot(x: Column, y: Column) -> Column:
        hits = F.transform(x, lambda g: F.size(F.filter(y, lambda h: h == g)))
        return F.aggregate(hits, F.lit(0).cast("long"), lambda s, v: s + v)

    x, y = bigrams(a), bigrams(b)
    norm = F.sqrt(dot(x, x).cast("double")) * F.sqrt(dot(y, y).cast("double"))
    return F.when((F.size(x) > 0) & (F.size(y) > 0), dot(x, y) / norm).otherwise(F.lit(0.0))


def script_ratio(title: Column, content: Column, chars: str = "가-힣") -> Column:
    """Share of characters of the class among all of the stripped title and content; null for an empty text."""
    t = strip(F.concat_ws(" ", F.coalesce(title, F.lit("")), F.coalesce(content, F.lit(""))))
    return F.when(F.length(t) > 0, F.regexp_count(t, F.lit(f"[{chars}]")) / F.length(t))


def site(c: Column) -> Column:
    """Host in lower case without port, trailing dots and one leading ``www.``."""
    c = F.regexp_replace(F.lower(c), r":[0-9]*\z", "")
    return F.regexp_replace(F.regexp_replace(c, r"\.+\z", ""), r"\Awww\.", "")
