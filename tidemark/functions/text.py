"""Text column expressions: cleanup, word limits, n-grams, array matching.

Everything here is a Column built from Spark built-ins, so it runs inside the
JVM; there is no Python UDF in the package.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ASCII control characters and blanks: the word separator used everywhere.
BLANKS = r"[\x00-\x20\x7f]+"
MARKUP = r"<[^>]*>"
NOT_ALNUM = r"[^\p{L}\p{N}]+"
INTEGER = r"^[+-]?[0-9]+$"


def _words(text: Column) -> Column:
    """Words of ``text``; an empty text has no words."""
    flat = F.trim(F.regexp_replace(text, BLANKS, " "))
    return F.when(flat == "", F.array().cast("array<string>")).otherwise(F.split(flat, " "))


def _head(words: Column, n: int | None) -> Column:
    return F.array_join(words if n is None else F.slice(words, 1, n), " ")


def clean_string(text: Column, max_words: int | None) -> Column:
    """Drop markup and control characters, collapse blanks, keep ``max_words`` words (None: all)."""
    return _head(_words(F.regexp_replace(text, MARKUP, " ")), max_words)


def first_n_words(text: Column, n: int | None) -> Column:
    """First ``n`` blank-separated words (None: all)."""
    return _head(_words(text), n)


def first_n_words_filtered(text: Column, n: int | None) -> Column:
    """First ``n`` words made of letters and digits, one-character words left out (None: all)."""
    words = F.split(F.trim(F.regexp_replace(text, NOT_ALNUM, " ")), " ")
    return _head(F.filter(words, lambda w: F.length(w) > 1), n)


def unique_ngrams(text: Column, n: int = 3) -> Column:
    """Distinct word n-grams of length 1 to ``n``, case kept."""

    def grams(words: Column, size: int) -> Column:
        if size == 1:
            return words

        def gram(word: Column, i: Column) -> Column:
            # past the end of the list the next word is NULL, and so is the n-gram
            return F.concat(word, *[p for k in range(1, size) for p in (F.lit(" "), F.get(words, i + k))])

        return F.array_compact(F.transform(words, gram))

    # the word list is a lambda variable, so it is split once and not once per n-gram
    bound = F.transform(
        F.array(_words(text)),
        lambda words: F.array_distinct(F.concat(*[grams(words, size) for size in range(1, n + 1)])),
    )
    return F.get(bound, F.lit(0))


def arrays_intersect(a: Column, b: Column) -> Column:
    """Distinct elements found in both arrays."""
    return F.array_intersect(a, b)


def arrays_intersect_case_insensitive(a: Column, b: Column) -> Column:
    """Distinct lower-cased elements found in both arrays ignoring case."""
    return F.array_intersect(F.transform(a, F.lower), F.transform(b, F.lower))


def is_integer(text: Column) -> Column:
    """True when the text is a whole number."""
    return text.rlike(INTEGER)
