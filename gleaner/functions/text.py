"""Text column functions for matching and filtering.

Python's Unicode ``\\w``/``\\s``/``\\b`` are spelled out as explicit classes
so that Java's regex engine (and RE2 in the SQL oracles) agree with them.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.fixed_values import DESCRIPTION_BONUS, DESCRIPTION_WORD_BONUS
from gleaner.functions.editscript import distance
from gleaner.functions.html import JAVA_WS, WS_CLASS, collapse_ws

_WS_INNER = WS_CLASS[1:-1]
_JAVA_WS_INNER = JAVA_WS[1:-1]
# Python's [^\w\s] for str patterns (Java form, and the RE2 form for SQL).
NON_WORD_RE = "(?U)[^\\p{L}\\p{N}_" + _JAVA_WS_INNER + "]"
SQL_NON_WORD_RE = "[^\\p{L}\\p{N}_" + _WS_INNER + "]"
# Python's \b[A-Za-z]{3,}: a word start (no word char before) then 3+ ASCII letters.
TITLE_WORD_RE = "(?:^|[^\\p{L}\\p{N}_])([A-Za-z]{3,})"
ACRONYM_RE = "^[A-Z]{2,10}$"
# Catalog title: the first sentence of the first line.
TITLE_RE = "^[^\\n.!?]*[.!?]?"


def py_strip(s: Column) -> Column:
    """Python str.strip(): cut whitespace at both ends."""
    return F.regexp_replace(s, "(?U)^" + JAVA_WS + "+|" + JAVA_WS + "+$", "")


def py_split(s: Column) -> Column:
    """Python str.split(): whitespace-separated words, no empty strings."""
    return F.filter(F.split(s, "(?U)" + JAVA_WS + "+"), lambda w: w != "")


def normalize(text: Column) -> Column:
    """M1: lower; non-word non-space chars to ' '; strip; collapse spaces."""
    return collapse_ws(F.regexp_replace(F.lower(text), NON_WORD_RE, " "))


def extract_acronym(text: Column) -> Column:
    """M2: the text itself if upper-cased it is 2-10 letters A-Z; else the
    initials of its purely alphabetic words longer than 2 (when the text has
    more than one word) if there are 2-10 of them; else null."""
    up = F.upper(text)
    words = py_split(text)
    initials = F.array_join(
        F.transform(
            F.filter(words, lambda w: w.rlike("^\\p{L}+$") & (F.length(w) > 2)),
            lambda w: F.upper(F.substring(w, 1, 1)),
        ),
        "",
    )
    return (
        F.when(up.rlike(ACRONYM_RE), up)
        .when((F.size(words) > 1) & F.length(initials).between(2, 10), initials)
    )


def title_initials(title: Column) -> Column:
    """Initials of the title's words of 3+ ASCII letters (M3)."""
    words = F.regexp_extract_all(title, F.lit(TITLE_WORD_RE), 1)
    return F.array_join(F.transform(words, lambda w: F.upper(F.substring(w, 1, 1))), ""), F.size(words)


def is_acronym_match(query: Column, title: Column) -> Column:
    """M3: the stripped upper-cased query is a prefix of the title's initials
    (titles with fewer than two such words never match)."""
    initials, n = title_initials(title)
    q = F.upper(py_strip(query))
    return F.when(n < 2, F.lit(False)).otherwise(initials.startswith(q))


def description_bonus_milli(query_norm: Column, desc_norm: Column) -> Column:
    """M7 in milli-points: 100 when the normalized query occurs in the
    normalized description, else 50 when one of its words longer than 3 does."""
    desc_norm = F.coalesce(desc_norm, F.lit(""))  # a missing description is an empty one
    words = F.filter(F.split(query_norm, " "), lambda w: F.length(w) > 3)
    any_word = F.exists(words, lambda w: desc_norm.contains(w))
    return (F.when(desc_norm.contains(query_norm), DESCRIPTION_BONUS)
            .when(any_word, DESCRIPTION_WORD_BONUS).otherwise(0))


#: Distances up to which texts are compared in a band of the table before its whole square is filled.
BANDS = (16, 128)
#: Texts up to this many characters are compared in one go.
SHORT_TEXT = 128
#: Longer texts are compared a whole row of the table at a time: the square of a title of 50,000 characters takes the JVM 20 seconds.
LONG_TEXT = 512


@F.pandas_udf(T.IntegerType())
def _long_distance(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None else distance(x, y) for x, y in zip(a, b)], dtype="Int32")


def edit_distance(a: Column, b: Column) -> Column:
    """The Levenshtein distance: long texts that differ in few places cost their length times the differences."""
    longest = F.greatest(F.length(a), F.length(b))
    by_row = (longest > LONG_TEXT) & (a != b)
    # -1: the distance exceeds the band
    near = [F.nullif(F.levenshtein(a, b, k), F.lit(-1)) for k in BANDS]
    return (F.when(a == b, F.lit(0))  # no DP needed
            .when(longest <= SHORT_TEXT, F.levenshtein(a, b))
            .when(longest <= LONG_TEXT, F.coalesce(*near, F.levenshtein(a, b)))
            .otherwise(_long_distance(F.when(by_row, a), F.when(by_row, b))))


@F.pandas_udf(T.IntegerType())
def _long_distance_within(a: pd.Series, b: pd.Series, most: pd.Series) -> pd.Series:
    return pd.Series([None if x is None else distance(x, y, int(k)) for x, y, k in zip(a, b, most)], dtype="Int32")


def edit_distance_within(a: Column, b: Column, most: Column) -> Column:
    """The Levenshtein distance where it is at most ``most``, else null: only a band of the table is filled, or the first of its rows."""
    by_row = (F.greatest(F.length(a), F.length(b)) > LONG_TEXT) & (a != b)
    return (F.when(a == b, F.lit(0))
            .when(by_row, _long_distance_within(F.when(by_row, a), F.when(by_row, b), most))
            .otherwise(F.nullif(F.call_function("levenshtein", a, b, most), F.lit(-1))))


def levenshtein_sim(a: Column, b: Column) -> Column:
    """1 - edit distance / longer length (1.0 for two empty strings)."""
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, F.lit(1.0)).otherwise(F.lit(1.0) - edit_distance(a, b) / longest)


def keyword_hits(text: Column, keywords: list[str]) -> Column:
    """How many keywords occur (as substrings) in the lower-cased text.
    Unrolled, so lower(text) is one common subexpression."""
    if not keywords:
        return F.lit(0)
    low = F.lower(text)
    hits = [F.when(low.contains(F.lit(k)), 1).otherwise(0) for k in keywords]
    total = hits[0]
    for h in hits[1:]:
        total = total + h
    return total


def word_count(text: Column) -> Column:
    """len(text.split()): runs of non-whitespace, counted without an array."""
    return F.regexp_count(text, F.lit("(?U)[^" + _JAVA_WS_INNER + "]+"))


def catalog_title(text: Column) -> Column:
    return F.regexp_extract(text, TITLE_RE, 0)
