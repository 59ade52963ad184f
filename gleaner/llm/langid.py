"""Language identification by word-first backoff.

A known word is scored by its log frequency in each language.  An unseen word
falls back to character n-grams: at each of its positions the longest n-gram
that the model knows is scored, from ``LONGEST`` characters down to one, and the
word takes the mean over its positions.  A text's language is the one with the
largest sum over its words; the score is its share of the posterior.

Words are runs of letters, lower-cased; n-grams include the word's edges.

Fitting reads about ``SAMPLE_ROWS`` labelled rows (a bound on the labelled
sample, chosen by a hash of doc_id; every row is taken while there are fewer).  The
bound is shared out by language, and a language with fewer rows than its share
gives all of them, so that none is lost.  Fitting keeps the ``MODEL_ENTRIES`` most frequent words and n-grams of each language,
with their counts in every language, so the model that is sent to the tasks has a fixed largest size.  Prediction reads
every whole text.

Nulls: a null text, or one without a letter, is ``und`` with score 0, as is
every text when there is nothing to learn from.  Rows with a null lang, text or
doc_id are not learned from.  Languages tie towards the alphabetically first.
Repeated rows are predicted alike; extra columns are not read.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import HashIndex, chunks, hash_spans, mix64, seeds, stored

LONGEST = 5
SAMPLE_ROWS = 20_000
#: Rows a language has in the sample, however many languages there are (all of its rows if it has fewer).
LEAST_ROWS = 30
SAMPLE_PARTS = 1 << 40
MODEL_ENTRIES = 40_000
SPACE = 32
SMOOTHING = 0.5

_TABLES: dict[str, np.ndarray] = {}


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Per code point: its lower case if it is a letter, else a space; and a random 64-bit value."""
    if "letter" not in _TABLES:
        letter = np.full(sys.maxunicode + 1, SPACE, dtype=np.uint32)
        for c in range(sys.maxunicode + 1):
            if unicodedata.category(chr(c))[0] == "L":
                low = chr(c).lower()
                letter[c] = ord(low) if len(low) == 1 else c
        _TABLES["letter"], _TABLES["value"] = letter, seeds(sys.maxunicode + 1, 991)
    return _TABLES["letter"], _TABLES["value"]


def letters(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one array of lower-cased letters, everything else a space; and where each text begins (n + 1).

    A space stands before the first text and after each one.
    """
    letter, _ = _tables()
    body = (" " + " ".join(texts) + " ").encode("utf-32-le", "replace")
    begin = np.cumsum([1, *(len(t) + 1 for t in texts)])
    return letter[np.frombuffer(body, dtype=np.uint32)], begin


def word_bounds(chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words."""
    edge = np.diff((chars != SPACE).astype(np.int8))
    return np.flatnonzero(edge == 1) + 1, np.flatnonzero(edge == -1) + 1


def gram_positions(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions from the space before each word to its last letter; the word of each; and where n-grams must end."""
    sizes = ends - starts + 1
    owner = np.repeat(np.arange(len(starts)), sizes)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return starts[owner] - 1 + within, owner, ends[owner] + 1


def gram_hashes(chars: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n characters from each position (which must not pass the end)."""
    _, value = _tables()
    factor = seeds(LONGEST, 5)
    total = np.full(len(at), n, dtype=np.uint64)
    for k in range(n):
        total += value[chars[at + k]] * factor[k]
    return mix64(total)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


class Model:
    """Per language the log frequencies of words and n-grams, found by hash."""

    def __init__(self, rows: list[tuple[str, bool, int, int]], totals: dict[tuple[str, bool], int]):
        """rows: (lang, is_word, hash, count); totals: (lang, is_word) -> count over everything learned."""
        self.langs = sorted({lang for lang, _ in totals})
        column = {lang: k for k, lang in enumerate(self.langs)}
        self.index, self.logs = {}, {}
        for is_word in (True, False):
            own = [r for r in rows if r[1] == is_word]
            keys = np.array(sorted({r[2] for r in own}), dtype=np.int64).view(np.uint64)
            place = {int(h): i for i, h in enumerate(keys.view(np.int64))}
            counts = np.zeros((len(keys), len(self.langs)))
            for lang, _, h, n in own:
                counts[place[h], column[lang]] = n
            total = np.array([totals.get((lang, is_word), 0) for lang in self.langs], dtype=float)
            self.index[is_word] = HashIndex(keys)
            self.logs[is_word] = np.log((counts + SMOOTHING) / (total + SMOOTHING * max(1, len(keys)))).astype(np.float32)

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        if not self.langs or not texts:
            return ["und"] * len(texts), np.zeros(len(texts))
        chars, begin = letters(texts)
        starts, ends = word_bounds(chars)
        doc = np.searchsorted(begin, starts, "right") - 1
        known = self.index[True].find(hash_spans(chars, starts, ends, _tables()[1]))
        scores = np.zeros((len(starts), len(self.langs)), dtype=np.float32)
        scores[known >= 0] = self.logs[True][known[known >= 0]]
        unseen = np.flatnonzero(known < 0)
        at, owner, stop = gram_positions(starts[unseen], ends[unseen])
        sums, used = np.zeros((len(unseen), len(self.langs))), np.zeros(len(unseen))
        for n in range(LONGEST, 0, -1):
            fits = np.flatnonzero(at + n <= stop)
            found = self.index[False].find(gram_hashes(chars, at[fits], n))
            hit = fits[found >= 0]
            rows = self.logs[False][found[found >= 0]]
            used += np.bincount(owner[hit], minlength=len(unseen))
            for k in range(len(self.langs)):
                sums[:, k] += np.bincount(owner[hit], weights=rows[:, k], minlength=len(unseen))
            left = np.ones(len(at), dtype=bool)
            left[hit] = False
            at, owner, stop = at[left], owner[left], stop[left]
        scores[unseen] = sums / np.maximum(used, 1)[:, None]
        total = np.stack([np.bincount(doc, weights=scores[:, k], minlength=len(texts)) for k in range(len(self.langs))], axis=1)
        best = total.argmax(axis=1)
        posterior = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
        some = np.bincount(doc, minlength=len(texts)) > 0
        return [self.langs[b] if s else "und" for b, s in zip(best, some)], np.where(some, posterior, 0.0)


def rows_per_language(sizes: list[int], most: int) -> int:
    """The largest number of rows for each language with which all together take about ``most``; LEAST_ROWS at least."""
    left, each = most, 0
    for k, n in enumerate(sorted(sizes)):
        each = left // (len(sizes) - k)
        if n > each:
            break
        left -= n
    return max(each, LEAST_ROWS)


def fit(documents: DataFrame, sample_rows: int = SAMPLE_ROWS, entries: int = MODEL_ENTRIES) -> Model:
    """Learn from the rows that are not held out and have a language."""
    train = documents.filter(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("doc_id").isNotNull()
                             & F.col("text").isNotNull())
    sizes = dict(train.groupBy("lang").count().collect())
    if sum(sizes.values()) > sample_rows:
        most = rows_per_language(list(sizes.values()), sample_rows)
        parts = [(lang, int(SAMPLE_PARTS * min(1.0, most / n))) for lang, n in sizes.items()]
        sampled = F.broadcast(documents.sparkSession.createDataFrame(parts, "lang string, part long"))
        train = train.select("lang", "doc_id", "text").join(sampled, "lang").filter(F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLE_PARTS)) < F.col("part"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            langs = np.array(batch.column("lang").to_pylist(), dtype=object)
            texts = np.array(batch.column("text").to_pylist(), dtype=object)
            for lang in sorted(set(langs)):
                chars, _ = letters(texts[langs == lang].tolist())
                starts, ends = word_bounds(chars)
                at, _, stop = gram_positions(starts, ends)
                grams = [gram_hashes(chars, at[at + n <= stop], n) for n in range(1, LONGEST + 1)]
                for is_word, hashes in ((True, hash_spans(chars, starts, ends, _tables()[1])), (False, np.concatenate(grams))):
                    keys, counts = np.unique(hashes, return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(keys), pa.string()), pa.array([is_word] * len(keys)), pa.array(keys.view(np.int64)),
                         pa.array(counts.astype(np.int64))], names=["lang", "is_word", "hash", "n"])

    counted = stored(train.select("lang", "text").mapInArrow(count, "lang string, is_word boolean, hash long, n long")
                     .groupBy("lang", "is_word", "hash").agg(F.sum("n").alias("n")), "language-counts")
    frequent = Window.partitionBy("lang", "is_word").orderBy(F.desc("n"), "hash")
    # an entry that one language keeps counts in every language, however rare it is there
    keys = counted.withColumn("rank", F.row_number().over(frequent)).filter(F.col("rank") <= entries).select("is_word", "hash").distinct()
    totals = counted.groupBy("lang", "is_word").agg(F.sum("n").alias("total"))
    top = (counted.join(keys, ["is_word", "hash"], "left_semi").join(F.broadcast(totals), ["lang", "is_word"])  # two rows per language
           .select("lang", "is_word", "hash", "n", "total").toArrow())
    lists = [top.column(k).to_pylist() for k in ("lang", "is_word", "hash", "n", "total")]
    return Model(list(zip(*lists[:4])), {(lang, w): n for lang, w, n in zip(lists[0], lists[1], lists[4])})


def predict(documents: DataFrame, model: Model) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score.  Row-local; the model goes out as a broadcast of bounded size."""
    sent = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            lang, score = sent.value.predict([t or "" for t in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(lang, pa.string()), pa.array(score)],
                                             names=["doc_id", "held_out", "lang_pred", "score"])

    return (documents.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
            .mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double"))
