"""Fuzzy string similarity (M4-M6), Arrow-batched.

ratio      round-half-even(100 * 2*LCS / (|a|+|b|)); equal strings 100, an
           empty side 0 (the indel-distance ratio).
partial    the best ratio of the shorter string against the windows of the
           longer one that line up with a matching block of the two, that is
           an equal run of their edit script (``editscript``) or its end; a window
           at the end is cut short where the longer string ends.
token_set  on ASCII-folded (U+0080..U+00FF dropped), non-word -> space,
           lower-cased strings: token sets, then the best ratio among the
           sorted intersection and intersection + each side's remainder.

LCS uses the bit-parallel recurrence of Hyyroe (2004) on Python ints.  These
run only on candidate pairs that survived blocking and the top-10 cut; a pair
that comes up again (under another strategy of its query) is scored once per worker.
"""

from __future__ import annotations

import re
from functools import lru_cache

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.functions.editscript import char_masks, matching_blocks

#: Pairs whose scores a worker remembers.
REMEMBERED = 1 << 14


def _lcs(masks: dict[str, int], n: int, b: str) -> int:
    """Longest common subsequence of ``b`` and the string of ``n`` characters whose places ``masks`` has."""
    full = (1 << n) - 1
    v = full
    for ch in b:
        u = v & masks.get(ch, 0)
        v = ((v + u) | (v - u)) & full
    return n - v.bit_count()


def lcs_len(a: str, b: str) -> int:
    return _lcs(char_masks(a), len(a), b)


def _raw_ratio(a: str, b: str) -> float:
    return 2.0 * lcs_len(a, b) / (len(a) + len(b))


def ratio(a: str, b: str) -> int:
    if a == b:
        return 100
    if not a or not b:
        return 0
    return round(100 * _raw_ratio(a, b))


def partial_ratio(a: str, b: str) -> int:
    if a == b:
        return 100
    if not a or not b:
        return 0
    short, long_ = (a, b) if len(a) <= len(b) else (b, a)
    masks, n, best = char_masks(short), len(short), 0.0
    starts = {max(at_long - at_short, 0) for at_short, at_long, _ in matching_blocks(short, long_)}
    # A window moved by k characters has at most k more in common: the start that may be the best one is
    # next, until no other can change the rounded result.
    most = {start: min(n, len(long_) - start) for start in sorted(starts) if start < len(long_)}
    while most:
        may = {start: 2.0 * m / (n + min(n, len(long_) - start)) for start, m in most.items()}
        start = max(may, key=may.get)
        if round(100 * may[start]) <= round(100 * best):
            break
        window = long_[start:start + n]
        common = _lcs(masks, n, window)
        best = max(best, 2.0 * common / (n + len(window)))
        most = {at: min(m, common + abs(at - start)) for at, m in most.items() if at != start}
    return round(100 * best)


_LATIN1 = {c: None for c in range(128, 256)}
_NON_WORD = re.compile(r"(?ui)\W")


def _process(s: str) -> str:
    return _NON_WORD.sub(" ", s.translate(_LATIN1)).lower().strip()


def token_set_ratio(a: str, b: str) -> int:
    p1, p2 = _process(a), _process(b)
    if not p1 or not p2:
        return 0
    t1, t2 = set(p1.split()), set(p2.split())
    sect = " ".join(sorted(t1 & t2))
    c12 = (sect + " " + " ".join(sorted(t1 - t2))).strip()
    c21 = (sect + " " + " ".join(sorted(t2 - t1))).strip()
    sect = sect.strip()
    return max(ratio(sect, c12), ratio(sect, c21), ratio(c12, c21))


SCORES_TYPE = T.StructType([
    T.StructField("ratio", T.IntegerType()),
    T.StructField("partial", T.IntegerType()),
    T.StructField("token_set", T.IntegerType()),
])


@lru_cache(maxsize=REMEMBERED)
def scores(a: str, b: str) -> tuple[int, int, int]:
    return ratio(a, b), partial_ratio(a, b), token_set_ratio(a, b)


@F.pandas_udf(SCORES_TYPE)
def fuzzy_scores(a: pd.Series, b: pd.Series) -> pd.DataFrame:
    """M4-M6 for each (a, b) pair, 0-100 each."""
    rows = [scores(x, y) for x, y in zip(a.fillna(""), b.fillna(""))]
    return pd.DataFrame(rows, columns=["ratio", "partial", "token_set"])
