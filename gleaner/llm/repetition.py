"""Periodic runs of words, caught as squares while a text is read, and their removal.

A run is a stretch of words with smallest period q (words q apart are the same) that
no neighbouring word extends, of at least ``LEAST_WORDS`` words and ``LEAST_PERIODS``
periods.

Catchers: every completed, aligned block of L = 1, 2, 4, ... words is a catcher of
squares whose half is 2L to 4L - 1 words long (1 to 3 for L = 1), as the first half
of each such square holds an aligned block of L words.  A catcher lives while the
words 2L to 4L behind its block are read: each of them completes a suffix of L words,
which is compared, by its hash, with the two live catchers of that level.  Where
one fits, the two places are one half q apart; catches of the same q in a row of
neighbouring blocks are one square that goes on, and only the first of them is
followed.  It is extended over the words themselves in both directions, so that
all its squares merge into one run; later catches inside a run at a multiple of its
period belong to it.  The comparisons of all words of a text are made at once, level by
level: two per word and level.

Everything happens inside the row.  Texts are handled in slices of a few megabytes
and by size, with a word of its own after each, so that no stretch leaves its text;
a text beyond that is a slice alone, and memory is proportional to its words.

Defined cases: a null, empty or white text has no words, no runs and an empty
collapsed text.  Rows that share a doc_id, and those without one, are read each on
its own.  Extra columns are not read.  Words are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WHITE, byte_values, chunks, hash_spans, mix64, utf8, word_spans
from .features import words

LEAST_WORDS, LEAST_PERIODS = 24, 3
_U64 = np.uint64
_LEFT, _RIGHT = _U64(0x9E3779B97F4A7C15), _U64(0xC2B2AE3D27D4EB4F)
SPANS = "doc_id long, spans array<struct<start:long,length:long,period:long>>, collapsed string"


def _catches(suffix: np.ndarray, size: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, halves): first block of every row of ``least`` or more neighbouring blocks that fit q words later.

    ``suffix`` has the hash of the ``size`` words from each place on.
    """
    rows = len(suffix) // size
    by_block = suffix[:rows * size].reshape(rows, size)
    places, halves = [], []
    for back in (1, 2, 3) if size == 1 else (2, 3):  # the live catchers, in blocks before the suffix's own
        if rows <= back:
            continue
        fits = by_block[back:] == by_block[:-back, :1]
        if len(fits) < least or not fits.any():
            continue
        going = fits[:len(fits) - least + 1].copy()
        for k in range(1, least):
            going &= fits[k:len(fits) - least + 1 + k]
        going[1:] &= ~fits[:len(going) - 1]
        block, column = np.nonzero(going)
        places.append(block * size)
        halves.append(back * size + column)
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(places), np.concatenate(halves)


def _agreeing(one: np.ndarray, other: np.ndarray) -> int:
    """Length of the common beginning; looks at twice as many words each time."""
    at, step, most = 0, 64, min(len(one), len(other))
    while at < most:
        differ = one[at:min(at + step, most)] != other[at:min(at + step, most)]
        if differ.any():
            return at + int(differ.argmax())
        at, step = at + step, 2 * step
    return most


def find_runs(seq: np.ndarray, longest: int, least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS) -> list[tuple[int, int, int]]:
    """All runs (start, end, period) in a sequence of word values, none longer than ``longest``; at least two periods."""
    found: list[tuple[int, int, int]] = []
    suffix, size = seq, 1
    while 2 * size * least_periods <= longest or size == 1:
        low, high = (1, 3) if size == 1 else (2 * size, 4 * size - 1)
        # words that agree with those q later are at least so many; all but one block of them is aligned inside
        agree = min(max((least_periods - 1) * q, least_words - q) for q in (low, min(high, max(low, least_words // least_periods))))
        place, half = _catches(suffix, size, max(1, agree // size - (size > 1)))
        if len(place):
            order = np.lexsort((half, place))
            place, half = place[order], half[order]
            alive = np.ones(len(place), dtype=bool)

            def covered(start: int, end: int, period: int) -> None:
                a, b = np.searchsorted(place, (start, end))  # noqa: B023
                alive[a:b] &= ~((half[a:b] % period == 0) & (place[a:b] + half[a:b] + size <= end))  # noqa: B023

            for run in found:
                covered(*run)
            # shorter halves first: a stretch is known by its smallest period before its multiples come up
            for k in np.argsort(half, kind="stable"):
                if not alive[k]:
                    continue
                i, q = int(place[k]), int(half[k])
                start = i - _agreeing(seq[:i][::-1], seq[:i + q][::-1])
                end = i + q + _agreeing(seq[i:], seq[i + q:])
                if end - i < q + size:
                    continue  # equal hashes of different words
                covered(start, end, q)
                if end - start >= max(least_words, least_periods * q):
                    found.append((start, end, q))
        if 2 * size > len(suffix):
            break
        suffix = mix64(suffix[:-size] * _LEFT + suffix[size:] * _RIGHT + _U64(size))
        size *= 2
    return found


def runs_of_texts(values: np.ndarray, first: np.ndarray, least_words: int = LEAST_WORDS,
                  least_periods: int = LEAST_PERIODS) -> list[list[tuple[int, int, int]]]:
    """Per text its runs (start, length, period) by start, then period; text t has the words first[t]:first[t + 1]."""
    counts = np.diff(first)
    out: list[list[tuple[int, int, int]]] = [[] for _ in counts]
    classes = np.frexp(counts.astype(np.float64))[1]
    for c in np.unique(classes[counts >= least_words]):
        texts = np.flatnonzero((classes == c) & (counts >= least_words))
        begin = np.concatenate([[0], np.cumsum(counts[texts] + 1)])
        ends = mix64(np.arange(len(texts), dtype=_U64) + _U64(1 << 60))  # a word of its own after each text
        seq = np.concatenate([x for k, t in enumerate(texts) for x in (values[first[t]:first[t + 1]], ends[k:k + 1])])
        for start, end, period in find_runs(seq, int(counts[texts].max()), least_words, least_periods):
            k = int(np.searchsorted(begin, start, "right")) - 1
            out[texts[k]].append((start - int(begin[k]), end - start, period))
    for runs in out:
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


def collapse(text: bytes, runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by one space, without those that a run holds after its first period."""
    parts = text.split()
    if runs:
        gone = np.zeros(len(parts) + 1, dtype=np.int64)
        for start, length, period in runs:
            gone[start + period] += 1
            gone[start + length] -= 1
        parts = [w for w, n in zip(parts, np.cumsum(gone)) if not n]
    return b" ".join(parts)


def repetitions(documents: DataFrame, least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS) -> DataFrame:
    """One row per input row: doc_id, ``spans`` (the runs by start, then period) and the ``collapsed`` text."""
    values = byte_values(fold_case=False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
        for batch in chunks(batches, "text"):
            offsets, data = utf8(batch.column("text"))
            starts, ends, first = word_spans(offsets, data, WHITE)
            runs = runs_of_texts(hash_spans(data, starts, ends, values), first, least_words, least_periods)
            body = data.tobytes()
            texts = [collapse(body[a:b], r) for a, b, r in zip(offsets[:-1], offsets[1:], runs)]
            flat = np.array([r for one in runs for r in one], dtype=np.int64).reshape(-1, 3)
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum([len(r) for r in runs])]), pa.int32()),
                pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], fields=list(span)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists, pa.array(texts, pa.binary()).cast(pa.string())],
                                             names=["doc_id", "spans", "collapsed"])

    return documents.select("doc_id", "text").mapInArrow(run, SPANS)


def with_planted_runs(documents: DataFrame) -> DataFrame:
    """(doc_id, text), where every tenth text, by the CRC-32 of its doc_id, repeats itself from some word on."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rows = documents.select("doc_id", "text", F.floor(crc / 10).alias("g"), F.when(crc % 10 == 0, words(F.col("text"))).alias("w"))
    n = F.size("w")
    rows = rows.withColumn("a", F.when(n > 0, F.col("g") % n))
    rows = rows.withColumn("p", F.lit(1) + F.floor((n - F.col("a")) / (F.lit(3) + F.col("g") % 8)))
    again = F.transform("w", lambda x, i: F.when(i < F.col("a"), x).otherwise(
        F.get(F.col("w"), (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int"))))
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """One row per row of ``repetitions``: n_runs, the run of most periods (start, length, period, exponent_milli), and digests."""
    more = lambda x, best: x["length"] * best["period"] > best["length"] * x["period"]
    best = F.aggregate("spans", F.get("spans", F.lit(0)), lambda have, x: F.when(more(x, have), x).otherwise(have))
    listed = F.transform("spans", lambda x: F.concat(F.concat_ws(",", x["start"], x["length"], x["period"]), F.lit("\n")))
    sha = lambda text: F.sha2(text.cast("binary"), 256)
    return (found.withColumn("best", best).select(
        "doc_id", F.size("spans").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        sha(F.array_join(listed, "")).alias("runs_sha256"), sha(F.col("collapsed")).alias("collapsed_sha256")))
