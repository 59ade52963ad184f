"""Shared helpers: tables, intermediate storage, and vectorised word hashing.

The hashing helpers work on the raw UTF-8 bytes of an Arrow string column: word
boundaries come from a 256-entry byte class table and every word gets a 64-bit
hash from one running sum, so no Python string is made per word.  Byte classes
are exact whenever the class treats all non-ASCII characters alike, because
every byte of a non-ASCII character is 0x80 or more.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources.tables import read_table

#: Text bytes handled at once inside a task; longer single texts form a chunk alone.
CHUNK_BYTES = 2 << 20
#: Bytes hashed with one running sum.
SEGMENT_BYTES = 1 << 20
#: Links that a task holds at once while it reduces them.
MOST_LINKS = 1 << 20
_U64 = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table by name."""
    return read_table(spark, sf_dir, name)


_RECORDS: list[list[str]] = []


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, noted by every ``recorded`` block around it."""
    path = scratch_path(spark, name)
    for record in _RECORDS:
        record.append(path)
    return path


@contextmanager
def recorded() -> Iterator[list[str]]:
    """Notes the scratch paths made inside, for ``discard`` once nothing reads them any more."""
    record: list[str] = []
    _RECORDS.append(record)
    try:
        yield record
    finally:
        _RECORDS.remove(record)


def discard(spark: SparkSession, paths: list[str]) -> None:
    """Remove scratch folders, wherever the shared folder lies."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    for path in paths:
        at = hadoop(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it from there.

    Lineage is cut at durable files, so losing an executor costs a re-read, and
    later readers prune columns.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def tasks_for(df: DataFrame) -> int:
    """Partitions for a shuffle that feeds CPU-heavy work."""
    spark = df.sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


# ---------------------------------------------------------------- byte classes

def byte_class(ranges: list[tuple[int, int]]) -> np.ndarray:
    """Boolean table over bytes, true inside the given inclusive ranges."""
    out = np.zeros(256, dtype=bool)
    for lo, hi in ranges:
        out[lo:hi + 1] = True
    return out


#: Space and the ASCII control white space: what separates words ``[^\x20\x09-\x0D]+``.
WHITE = byte_class([(0x20, 0x20), (0x09, 0x0D)])


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finalizer (xor-shift and multiply rounds)."""
    x = x ^ (x >> _U64(30))
    x = x * _U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U64(27))
    x = x * _U64(0x94D049BB133111EB)
    return x ^ (x >> _U64(31))


def seeds(n: int, salt: int) -> np.ndarray:
    """``n`` fixed pseudo-random odd 64-bit values."""
    return mix64(np.arange(1, n + 1, dtype=_U64) * _U64(0x9E3779B97F4A7C15) + _U64(salt)) | _U64(1)


def byte_values(fold_case: bool) -> np.ndarray:
    """A random 64-bit value per byte; with ``fold_case`` A-Z share those of a-z."""
    out = seeds(256, 77)
    if fold_case:
        out[ord("A"):ord("Z") + 1] = out[ord("a"):ord("z") + 1]
    return out


_BASE = 0xD6E8FEB86659FD93
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _POWERS.get("up")
    if have is None or len(have) < n:
        n = max(n, SEGMENT_BYTES + 1)
        inverse = pow(_BASE, -1, 1 << 64)
        up, down = np.full(n, _BASE, dtype=_U64), np.full(n, inverse, dtype=_U64)
        up[0] = down[0] = 1
        _POWERS["up"], _POWERS["down"] = np.cumprod(up), np.cumprod(down)
    return _POWERS["up"], _POWERS["down"]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (n + 1, from 0) and bytes of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros(1, dtype=np.int64), np.zeros(0, dtype=np.uint8)
    off = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    body = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return off - off[0], body[off[0]:off[-1]]


def word_spans(offsets: np.ndarray, data: np.ndarray, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and per document the index of its first word (n + 1)."""
    inside = ~separator[data]
    if len(inside) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    first = np.zeros(len(inside) + 1, dtype=bool)
    first[offsets] = True
    before, after = first[:-1].copy(), first[1:].copy()
    before[0] = after[-1] = True
    before[1:] |= ~inside[:-1]
    after[:-1] |= ~inside[1:]
    starts = np.flatnonzero(inside & before)
    ends = np.flatnonzero(inside & after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray) -> np.ndarray:
    """64-bit hash of every byte span; equal spans hash alike wherever they stand."""
    out = np.empty(len(starts), dtype=_U64)
    i = 0
    while i < len(starts):
        lo = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, lo + SEGMENT_BYTES, "right")))
        hi = ends[j - 1]
        up, down = _powers(int(hi - lo) + 1)
        total = np.zeros(hi - lo + 1, dtype=_U64)
        np.cumsum(values[data[lo:hi]] * up[:hi - lo], out=total[1:])
        s = starts[i:j] - lo
        out[i:j] = (total[ends[i:j] - lo] - total[s]) * down[s]
        i = j
    return mix64(out)


def hash_bytes(text: bytes, values: np.ndarray) -> int:
    """The hash that ``hash_spans`` gives one span."""
    data = np.frombuffer(text, dtype=np.uint8)
    return int(hash_spans(data, np.zeros(1, np.int64), np.array([len(data)]), values)[0])


def chunks(batches: Iterator[pa.RecordBatch], column: str, size: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most ``size`` text bytes, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        offsets, _ = utf8(batch.column(column))
        i = 0
        while i < batch.num_rows:
            j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1)
            yield batch.slice(i, j - i)
            i = j


# ---------------------------------------------------------------- links -> components

def smallest_reachable(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, labels): for every node of the links (a, b) the smallest one reachable."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[:len(a)], ends[len(a):]
    label = np.arange(len(nodes))
    while (label[x] != label[y]).any():
        low = np.minimum(label[x], label[y])
        np.minimum.at(label, label[x], low)
        np.minimum.at(label, label[y], low)
        while (label[label] != label).any():
            label = label[label]
    return nodes, nodes[label]


def forest(links: DataFrame, node: str, hub: str) -> DataFrame:
    """Links (a, b) with the same components as ``links``, about one for each ``node``.

    Links are dealt by ``node``, which should be the end that has few of them; each task
    replaces the links of a slice by one from every end to the smallest one reachable.
    So a large family whose members hang on many hubs keeps one link per member,
    and a few for the hubs in each slice.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def reduced() -> pa.RecordBatch:
            nodes, labels = smallest_reachable(*(np.concatenate(x) for x in zip(*waiting)))
            own = nodes != labels
            return pa.RecordBatch.from_arrays([pa.array(nodes[own]), pa.array(labels[own])], names=["a", "b"])

        waiting: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            waiting.append((batch.column(node).to_numpy(), batch.column(hub).to_numpy()))
            if sum(len(x) for x, _ in waiting) >= MOST_LINKS:
                yield reduced()
                waiting = []
        if waiting:
            yield reduced()

    return links.repartition(tasks_for(links), node).mapInArrow(run, "a long, b long").distinct()


def components(links: DataFrame, name: str, most_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node reachable over the undirected ``links`` (a, b).

    Alternates the two star steps (every node links its larger, then its
    smaller neighbours to its smallest one) until the edges stop changing: a
    logarithmic number of rounds.  Each round is a partially aggregated minimum
    and a join on slim rows, written to the shared folder; hot nodes are split
    by the skew join.  Nodes without links do not appear.
    """
    edges = stored(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                   .filter("a > b").distinct(), f"{name}-links")
    state = None
    for _ in range(most_rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = (both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .filter("a > b").distinct())
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        edges = stored(large.join(small, "a").select(
            F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
            .select("e.*").filter("a > b").distinct(), f"{name}-round")
        row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.count_distinct("a")).first()
        if tuple(row[:2]) == state and row[0] == row[2]:
            break
        state = tuple(row[:2])
    else:
        raise RuntimeError(f"components did not settle within {most_rounds} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()


class HashIndex:
    """Open-addressing table from distinct 64-bit hashes to 0..n-1, looked up for whole arrays at once."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.asarray(keys, dtype=_U64)
        size = 16
        while size < 3 * len(self.keys):
            size *= 2
        self.mask = _U64(size - 1)
        self.slots = np.full(size, -1, dtype=np.int32)
        rest, step = np.arange(len(self.keys), dtype=np.int32), 0
        while len(rest):
            at = ((self.keys[rest] + _U64(step)) & self.mask).astype(np.int64)
            free = self.slots[at] < 0
            self.slots[at[free]] = rest[free]  # of several for one slot the last write stays
            rest = rest[self.slots[at] != rest]
            step += 1
        self.steps = step

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Index of each hash, -1 where it is not a key."""
        out = np.full(len(hashes), -1, dtype=np.int32)
        if not len(self.keys):
            return out
        rest = np.arange(len(hashes))
        for step in range(self.steps):
            got = self.slots[((hashes[rest] + _U64(step)) & self.mask).astype(np.int64)]
            hit = (got >= 0) & (self.keys[got] == hashes[rest])
            out[rest[hit]] = got[hit]
            rest = rest[(got >= 0) & ~hit]
            if not len(rest):
                break
        return out
