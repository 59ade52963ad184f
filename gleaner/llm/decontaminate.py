"""Benchmark decontamination by SimHash windows and weighted shingles.

Every benchmark item has a 64-bit SimHash of its weighted word shingles.  A
document is cut into windows of exactly the items' sizes (in words), at every
position; each window's SimHash is looked up in a multi-index of eight 8-bit
blocks, each holding the items within ``BLOCK_RADIUS`` bits.  By the pigeonhole
principle this finds every item within ``RADIUS`` bits of the window.  Candidates
are confirmed on the exact weighted shingle similarity.

A shingle weighs 1 / (number of items that have it), 1 if no item has it;
similarity is the sum of the smaller over the sum of the larger weighted counts.
A window in which the shingles of items of its own size weigh less than the asked
share of all its shingles cannot reach the similarity with any of them; such
windows are passed over before hashing, which leaves next to nothing of clean
text.

The benchmark is handled in passes of bounded size (``PASS_BYTES`` of item text), so what
is sent to the tasks is bounded whatever its size.  The items that have a shingle are
counted over the whole benchmark, so results do not depend on the passes.

Items shorter than a shingle have their whole sequence as the one shingle, and so has
each window of their size: such an item is found where a run of as many words is
equal to it, by a hash lookup of every run of that size.

Defined cases: null or empty texts and items match nothing.  A document shorter
than an item is one window.  Of equally similar windows the first counts.  Repeated
rows are judged alike; repeated items (same id and text) count once; a null
item_id is reported as null.  Extra columns are not read, and pass through
``drop_contaminated``.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import HashIndex, byte_values, chunks, hash_spans, mix64, stored, utf8, word_spans
from .licenses import SEPARATOR
from .near_dedup import shingle_hashes

SHINGLE, PER_CENT = 5, 80
BLOCKS, BLOCK_RADIUS = 8, 2
#: Guaranteed: a distance of 24 or more is needed for all 8 blocks to differ by 3 bits.
RADIUS = BLOCKS * (BLOCK_RADIUS + 1) - 1
PASS_BYTES = 32 << 20


def _words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes in order, and the index of each text's first one (n + 1)."""
    offsets, data = utf8(column)
    starts, ends, first = word_spans(offsets, data, SEPARATOR)
    return hash_spans(data, starts, ends, byte_values(fold_case=True)), first


def signs(hashes: np.ndarray) -> np.ndarray:
    """(n, 64) of +1 and -1: the bits that each shingle votes for."""
    bits = np.unpackbits(mix64(hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5)).view(np.uint8).reshape(-1, 8), axis=1)
    return bits.astype(np.float64) * 2 - 1


def fingerprint(votes: np.ndarray) -> np.ndarray:
    """64-bit SimHash of each row of votes."""
    return np.packbits(votes > 1e-9, axis=1).view(np.uint64).ravel()


class Benchmark:
    """The items of one pass: shingle weights, fingerprints and the multi-index."""

    def __init__(self, items: list[tuple], held_by: tuple[np.ndarray, np.ndarray] | None = None):
        """held_by: shingles, and how many items of the whole benchmark have each (default: the items are all there are)."""
        items = sorted(set(items), key=lambda x: (x[0] is None, x[0] or 0, x[1]))
        hashed, first = _words(pa.array([t for _, t in items], pa.string()))
        hashes, begin = shingle_hashes(hashed, first, SHINGLE)
        words = np.diff(first)
        keep = [k for k in range(len(items)) if words[k] >= SHINGLE]
        small = [k for k in range(len(items)) if 0 < words[k] < SHINGLE]
        self.ids = [items[k][0] for k in keep + small]  # those shorter than a shingle last
        runs: dict[int, dict[int, list[int]]] = {}
        for k, item in enumerate(small, len(keep)):
            run = int(shingle_hashes(hashed[first[item]:first[item + 1]], np.array([0, words[item]]), int(words[item]))[0][0])
            runs.setdefault(int(words[item]), {}).setdefault(run, []).append(k)
        self.short = {n: (HashIndex(np.array(list(by), dtype=np.uint64)), list(by.values())) for n, by in sorted(runs.items())}
        self.size = np.array([words[k] for k in keep], dtype=np.int64)
        sets = [hashes[begin[k]:begin[k + 1]] for k in keep]
        keys, held = np.unique(np.concatenate([np.unique(s) for s in sets]) if sets else np.zeros(0, np.uint64), return_counts=True)
        if held_by is not None:
            at = HashIndex(keys).find(held_by[0])
            held[at[at >= 0]] = held_by[1][at >= 0]
        self.index, self.weight = HashIndex(keys), 1.0 / np.maximum(held, 1)
        self.sizes = np.unique(self.size)
        self.bit = {int(n): 1 << (k % 64) for k, n in enumerate(self.sizes)}
        self.mask = np.zeros(len(keys) + 1, dtype=np.uint64)  # sizes (modulo 64) of the items that have a shingle; last: none
        for k, own in zip(self.size, sets):
            self.mask[self.index.find(own)] |= np.uint64(self.bit[int(k)])
        self.counts = [Counter(s.tolist()) for s in sets]
        self.prints = np.concatenate([fingerprint((signs(s) * self.weights(s)[0][:, None]).sum(axis=0, keepdims=True)) for s in sets]) \
            if sets else np.zeros(0, np.uint64)
        near = [sum(1 << b for b in c) for r in range(BLOCK_RADIUS + 1) for c in combinations(range(8), r)]
        self.blocks: list[dict[int, list[int]]] = [{} for _ in range(BLOCKS)]
        for k, own in enumerate(self.prints.view(np.uint8).reshape(-1, BLOCKS)):
            for b in range(BLOCKS):
                for flip in near:
                    self.blocks[b].setdefault(int(own[b]) ^ flip, []).append(k)

    def weights(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Weight of each shingle, and the sizes of the items that have it (0: none has)."""
        at = self.index.find(hashes)
        return np.where(at >= 0, self.weight[at] if len(self.weight) else 1.0, 1.0), self.mask[at]

    def near(self, prints: np.ndarray) -> Iterator[tuple[int, int]]:
        """(window, item) within RADIUS bits."""
        for w, own in enumerate(prints.view(np.uint8).reshape(-1, BLOCKS)):
            seen = set()
            for b in range(BLOCKS):
                seen.update(self.blocks[b].get(int(own[b]), ()))
            if seen:
                items = np.array(sorted(seen))
                far = np.bitwise_count(self.prints[items] ^ prints[w])
                for k in items[far <= RADIUS]:
                    yield w, int(k)

    def similarity(self, window: np.ndarray, item: int) -> float:
        own, other = Counter(window.tolist()), self.counts[item]
        keys = np.array(list(own.keys() | other.keys()), dtype=np.uint64)
        weight, _ = self.weights(keys)
        a = np.array([own.get(int(x), 0) for x in keys])
        b = np.array([other.get(int(x), 0) for x in keys])
        return float((weight * np.minimum(a, b)).sum() / (weight * np.maximum(a, b)).sum())

    def search(self, hashes: np.ndarray, weight: np.ndarray, mask: np.ndarray, words: int, per_cent: int) -> list[tuple]:
        """(item, first word, words, similarity) of the best window per item of one document."""
        total = np.concatenate([[0.0], np.cumsum(weight)])
        best: dict[int, tuple] = {}
        for size in sorted({min(int(s), words) for s in self.sizes}):
            span = min(len(hashes), max(1, size - SHINGLE + 1))
            fits = np.bitwise_or.reduce([np.uint64(b) for n, b in self.bit.items() if min(n, words) == size])
            known = (mask & fits) != 0
            if not known.any():
                continue
            share = np.concatenate([[0.0], np.cumsum(weight * known)])
            lo = np.arange(len(hashes) - span + 1)
            lo = lo[100 * (share[lo + span] - share[lo]) >= per_cent * (total[lo + span] - total[lo]) - 1e-6]
            if not len(lo):
                continue
            for at in np.split(lo, np.flatnonzero(np.diff(lo // 8192)) + 1):  # near each other: bounded memory
                a, z = int(at[0]), int(at[-1]) + span
                votes = np.zeros((z - a + 1, 64))
                np.cumsum(signs(hashes[a:z]) * weight[a:z, None], axis=0, out=votes[1:])
                for w, k in self.near(fingerprint(votes[at + span - a] - votes[at - a])):
                    if min(int(self.size[k]), words) != size:
                        continue
                    p = int(at[w])
                    s = self.similarity(hashes[p:p + span], k)
                    if 100 * s >= per_cent - 1e-9 and (k not in best or s > best[k][2]):
                        best[k] = (p, size, s)
        return [(k, *v) for k, v in sorted(best.items())]

    def short_runs(self, words: np.ndarray, first: np.ndarray) -> dict[int, list[tuple]]:
        """Per text, (item, first word, words, 1.0) of the first run equal to each item shorter than a shingle."""
        out: dict[int, list[tuple]] = {}
        for n, (index, held) in self.short.items():
            hashes, begin = shingle_hashes(words, first, n)
            known = index.find(hashes)
            at = np.flatnonzero(known >= 0)
            doc = np.searchsorted(begin, at, "right") - 1
            _, once = np.unique(doc * len(held) + known[at], return_index=True)
            for i in once:
                d = int(doc[i])
                out.setdefault(d, []).extend((k, int(at[i] - begin[d]), n, 1.0) for k in held[known[at[i]]])
        return out


def passes(benchmark: DataFrame) -> Iterator[Benchmark]:
    """The benchmark in parts of about PASS_BYTES of text."""
    slim = benchmark.select("item_id", "text").filter(F.coalesce(F.length("text"), F.lit(0)) > 0)
    size = slim.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = max(1, -(-int(size) // PASS_BYTES))
    own = slim.withColumn("pass", F.pmod(F.xxhash64("item_id", "text"), F.lit(n)).cast("int"))
    shared = _shared_shingles(own) if n > 1 else None
    for k in range(n):
        part = own.filter(F.col("pass") == k).drop("pass").collect()
        if part:
            held_by = None
            if shared is not None:
                found = shared.filter(F.col("pass") == k).select("hash", "n").toArrow()
                held_by = found.column("hash").to_numpy().view(np.uint64), found.column("n").to_numpy()
            yield Benchmark([tuple(r) for r in part], held_by)


def _shared_shingles(items: DataFrame) -> DataFrame:
    """pass, hash, n: the shingles of each pass that more than one item of the whole benchmark has, and how many have it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            hashes, begin = shingle_hashes(*_words(batch.column("text")), SHINGLE)
            for k, (a, z) in enumerate(zip(begin[:-1], begin[1:])):
                own = np.unique(hashes[a:z]).view(np.int64)
                if len(own):
                    yield pa.RecordBatch.from_arrays([pa.repeat(batch.column("pass")[k], len(own)), pa.array(own)], names=["pass", "hash"])

    counts = stored(items.distinct().select("pass", "text").mapInArrow(run, "pass int, hash long")
                    .groupBy("pass", "hash").agg(F.count("*").alias("n")), "benchmark-shingles")
    whole = counts.groupBy("hash").agg(F.sum("n").alias("n")).filter("n > 1")
    return stored(counts.select("pass", "hash").join(whole, "hash"), "benchmark-shared")


def _hits(batch: pa.RecordBatch, items: Benchmark, per_cent: int) -> Iterator[tuple[int, list[tuple]]]:
    """(row, matches) of the rows that have any."""
    hashed, first = _words(batch.column("text"))
    hashes, begin = shingle_hashes(hashed, first, SHINGLE)
    words, short = np.diff(first), items.short_runs(hashed, first)
    weight, mask = items.weights(hashes)
    for d in sorted({*(np.searchsorted(begin, np.flatnonzero(mask), "right") - 1).tolist(), *short}):
        a, z = begin[d], begin[d + 1]
        found = items.search(hashes[a:z], weight[a:z], mask[a:z], int(words[d]), per_cent) + short.get(d, [])
        if found:
            yield d, found


def matches(documents: DataFrame, benchmark: DataFrame, per_cent: int = PER_CENT) -> DataFrame:
    """One row per document and item found in it: doc_id, item_id, first_word, n_words, similarity (best window).

    Row-local over the documents; no shuffle.
    """
    kind = dict(benchmark.dtypes)["item_id"]
    schema = f"doc_id long, item_id {kind}, first_word long, n_words long, similarity double"
    out = documents.sparkSession.createDataFrame([], schema)
    for items in passes(benchmark):
        sent = documents.sparkSession.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in chunks(batches, "text"):
                ids = batch.column("doc_id").to_pylist()
                rows = [(ids[d], sent.value.ids[k], p, n, s) for d, found in _hits(batch, sent.value, per_cent) for k, p, n, s in found]
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), None, pa.int64(), pa.int64(), pa.float64()))],
                        names=["doc_id", "item_id", "first_word", "n_words", "similarity"])

        out = out.unionByName(documents.select("doc_id", "text").mapInArrow(run, schema))
    return out


def drop_contaminated(documents: DataFrame, benchmark: DataFrame, per_cent: int = PER_CENT) -> DataFrame:
    """The documents in which no item was found, all columns as they were."""
    for items in passes(benchmark):
        sent = documents.sparkSession.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in chunks(batches, "text"):
                keep = np.ones(batch.num_rows, dtype=bool)
                keep[[d for d, _ in _hits(batch, sent.value, per_cent)]] = False
                yield batch.filter(pa.array(keep))

        documents = documents.mapInArrow(run, documents.schema)
    return documents
