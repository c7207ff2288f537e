"""String helpers with Python ``str`` semantics (FN-6, FN-7, FN-16)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 29 code points Python's str.strip() removes (str.isspace):
# U+0009-U+000D, U+001C-U+001F, U+0020, U+0085, U+00A0, U+1680,
# U+2000-U+200A, U+2028, U+2029, U+202F, U+205F, U+3000.
# Spark's one-argument trim() removes only the space character.
PY_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip_ws(c: Column) -> Column:
    """``str.strip()`` on a string column (null stays null); a plain trim, no regex."""
    return F.trim(c, F.lit(PY_WHITESPACE))


def strip_object_ws(c: Column) -> Column:
    """``strip_ws`` for texts that are mostly JSON objects: one from brace to brace has nothing to strip and is not walked through."""
    return F.when(c.startswith("{") & c.endswith("}"), c).otherwise(strip_ws(c))


def is_blank(c: Column) -> Column:
    """True when the text is null, empty or only white space (a trim from the left ends at the first other character)."""
    return F.coalesce(F.ltrim(c, F.lit(PY_WHITESPACE)) == F.lit(""), F.lit(True))


def starts_with_any(c: Column, prefixes: list[str]) -> Column:
    cond = F.lit(False)
    for p in prefixes:
        cond = cond | c.startswith(p)
    return F.coalesce(cond, F.lit(False))


def word_ngrams(words: Column, n: int) -> Column:
    """Array of space-joined word n-grams of an array<string> column."""
    size = F.size(words)
    idx = F.sequence(F.lit(1), F.greatest(size - F.lit(n - 1), F.lit(1)))
    grams = F.transform(idx, lambda i: F.array_join(F.slice(words, i, n), " "))
    return F.when(size >= n, grams).otherwise(F.array().cast("array<string>"))
