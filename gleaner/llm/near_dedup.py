"""Near-duplicate groups by HyperMinHash, banding and exact verification.

A document's set holds its distinct word shingles (hashed to 64 bits, words
lower-cased A-Z).  Its sketch is one HyperMinHash register per bucket: the
bucket is the top byte of a shingle hash, and the register keeps, of the
smallest remaining value in the bucket, the count of leading zeros (6 bits) and
the ``MANTISSA`` bits after the first one.  Registers of empty buckets borrow
from other buckets in a fixed order, so that banding also works for short texts.

1. *Classes*: texts with equal sets form a class; one of them stands for it.
2. *Banding*: groups of registers (``banding``); classes that agree in a
   band share a bucket.  The chance to miss a pair at the similarity asked for is
   under one in a hundred thousand: (1 - 0.85^7)^36, or (1 - 0.8^6)^42.
3. *Hubs*: each bucket elects the member that shares most buckets, and every
   member is paired with its hub, not with every other member.  Pairs are
   pruned by the collision-corrected estimate of the registers and confirmed
   on the full sets.  A member may hang on a hub in each of its buckets; one link to
   the smallest id that its task can reach over them takes their place.
4. *Rest*: buckets whose members still lie in different components are compared
   by registers, in bounded blocks; members that may still link across
   components form clusters, which are compared on the full sets, in blocks
   again, looking only for links between components not yet joined.  So no link
   that the bands offer is lost, and no pair is written out that is not one of a
   spanning forest.
5. Components over all links; the smallest doc_id names each.

Defined cases: a text that is null, empty or without words has an empty set and
no links.  A null doc_id gives no links either (component null, kept).  Rows that
share a doc_id are one document with the links of all its rows.  Fewer words
than a shingle: the whole sequence is the one shingle.  Extra columns are not
read; results do not depend on row order.  Set sizes and intersections are those
of 64-bit hashes (a collision within a document: about 1e-14).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WHITE, byte_values, chunks, components, forest, hash_spans, mix64, seeds, stored, tasks_for, utf8, word_spans

BUCKETS, MANTISSA = 256, 10
#: Standard deviations by which an estimate may fall short before a pair is dropped unread.
SLACK = 5.0
#: Document ids that are broadcast at the most (16 bytes each); beyond, texts are joined by a shuffle.
MOST_BROADCAST = 2_000_000
#: Members of a bucket that one task compares with as many others.
BLOCK = 256
_EMPTY = np.uint16(0xFFFF)
_REST_BITS = 56


def banding(per_cent: int) -> tuple[int, int]:
    """(bands, registers in each) for a similarity; longer bands where it is high offer fewer unlike pairs."""
    rows = 7 if per_cent >= 85 else 6 if per_cent >= 80 else 5 if per_cent >= 75 else 4
    return BUCKETS // rows, rows


def shingle_hashes(words: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every k-word shingle and per document the index of its first one; short documents give one."""
    n = len(words)
    factor = seeds(k, 31)
    total = np.zeros(n, dtype=np.uint64)
    for i in range(min(k, n)):  # windows that cross into the next document are not taken below
        total[:n - i] += words[i:] * factor[i]
    counts = np.diff(first)
    take = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    begin = np.concatenate([[0], np.cumsum(take)])
    owner = np.repeat(np.arange(len(counts)), take)
    at = first[:-1][owner] + np.arange(len(owner)) - begin[owner]
    out = total[at]
    for d in np.flatnonzero((counts > 0) & (counts < k)):
        own = words[first[d]:first[d + 1]]
        out[begin[d]] = (own * factor[:len(own)]).sum(dtype=np.uint64) + np.uint64(len(own))
    return mix64(out), begin


def sets_of(column: pa.Array, k: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    offsets, data = utf8(column)
    starts, ends, first = word_spans(offsets, data, WHITE)
    hashes, begin = shingle_hashes(hash_spans(data, starts, ends, byte_values(fold_case=True)), first, k)
    return [np.unique(hashes[a:b]) for a, b in zip(begin[:-1], begin[1:])]


def registers_of(sets: list[np.ndarray]) -> np.ndarray:
    """(documents, BUCKETS) HyperMinHash registers, 0xFFFF where a bucket is empty."""
    out = np.full((len(sets), BUCKETS), _EMPTY, dtype=np.uint16)
    sizes = np.array([len(s) for s in sets])
    if not sizes.sum():
        return out
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    bucket = (values >> np.uint64(_REST_BITS)).astype(np.int64)
    lead = np.ones(len(values), dtype=bool)  # sorted: the first of a bucket is its smallest
    lead[1:] = (bucket[1:] != bucket[:-1]) | (owner[1:] != owner[:-1])
    rest = values[lead] & np.uint64((1 << _REST_BITS) - 1)
    bits = np.frexp((rest >> np.uint64(4)).astype(np.float64))[1].astype(np.int64) + 4
    zeros = np.where(rest < 16, _REST_BITS - 4, _REST_BITS - bits)
    tail = (rest << (zeros + 1).astype(np.uint64)) & np.uint64((1 << _REST_BITS) - 1)
    out[owner[lead], bucket[lead]] = (zeros << MANTISSA).astype(np.uint16) | (tail >> np.uint64(_REST_BITS - MANTISSA)).astype(np.uint16)
    return out


_BORROW = np.stack([np.argsort(seeds(BUCKETS, 1000 + t)) for t in range(48)])


def densified(registers: np.ndarray) -> np.ndarray:
    """Empty registers take those of other buckets, in an order fixed for each bucket."""
    out, empty = registers.copy(), registers == _EMPTY
    todo = empty & ~empty.all(axis=1)[:, None]
    for order in _BORROW:
        if not todo.any():
            return out
        fill = todo & ~empty[:, order]
        out = np.where(fill, registers[:, order], out)
        todo &= ~fill
    for shift in range(1, BUCKETS):
        if not todo.any():
            break
        order = (np.arange(BUCKETS) + shift) % BUCKETS
        fill = todo & ~empty[:, order]
        out = np.where(fill, registers[:, order], out)
        todo &= ~fill
    return out


def estimate(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Collision-corrected similarity of register rows, and the number of registers it rests on.

    Two different minima share a register with probability about
    ``0.7213 * 2^-MANTISSA * ab / (a + b)^2``: the share of the joint density of
    two exponential minima that falls into one cell of relative width
    ``2^-MANTISSA``.
    """
    used = ((a != _EMPTY) | (b != _EMPTY)).sum(axis=-1)
    same = ((a == b) & (a != _EMPTY)).sum(axis=-1)
    chance = 0.7213 * 2.0 ** -MANTISSA * size_a * size_b / np.maximum(1.0, size_a + size_b) ** 2
    return np.clip((same / np.maximum(used, 1) - chance) / (1 - chance), 0.0, 1.0), used


def may_link(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray, per_cent: int) -> np.ndarray:
    """False only where sizes or registers rule the similarity out."""
    s = per_cent / 100
    near, used = estimate(a, b, size_a, size_b)
    fits = 100 * np.minimum(size_a, size_b) >= per_cent * np.maximum(size_a, size_b)
    return fits & (near + SLACK * np.sqrt(s * (1 - s) / np.maximum(used, 1)) >= s)


def linked(a: np.ndarray, b: np.ndarray, per_cent: int) -> bool:
    """Exact: 100 * |a and b| >= per_cent * |a or b|, for sorted distinct arrays."""
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common > 0 and 100 * common >= per_cent * (len(a) + len(b) - common)


_SKETCH = "doc_id long, n_shingles long, set_key binary, registers binary, bands array<long>"


def sketches(documents: DataFrame, k: int, per_cent: int) -> DataFrame:
    """(doc_id, n_shingles, set_key, registers, bands) of every row."""
    n_bands, height = banding(per_cent)
    factors = seeds(n_bands * height, 4242).reshape(n_bands, height)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            sets = sets_of(batch.column("text"), k)
            plain = registers_of(sets)
            dense = densified(plain)[:, :n_bands * height].reshape(-1, n_bands, height).astype(np.uint64)
            bands = mix64((mix64(dense + np.uint64(1)) * factors[None]).sum(axis=2, dtype=np.uint64)
                          + np.arange(n_bands, dtype=np.uint64)[None]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                 pa.array([r.tobytes() for r in plain], pa.binary()), pa.array(list(bands), pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "set_key", "registers", "bands"])

    return documents.select("doc_id", "text").mapInArrow(run, _SKETCH).withColumn("row", F.monotonically_increasing_id())


def _few(ids: DataFrame) -> DataFrame:
    """Stored ``ids``, marked for broadcast if they are few."""
    return F.broadcast(ids) if ids.count() <= MOST_BROADCAST else ids


def _set_rows(documents: DataFrame, nodes: DataFrame, k: int) -> DataFrame:
    """(node, members) with the full sets of the documents in the stored ``nodes``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array([s.tobytes() for s in sets_of(batch.column("text"), k)], pa.binary())],
                names=["node", "members"])

    return (documents.select(F.col("doc_id").alias("node"), "text").join(_few(nodes), "node", "left_semi")
            .mapInArrow(run, "node long, members binary"))


def _array(values: pd.Series, kind: str) -> list[np.ndarray]:
    return [np.frombuffer(v, dtype=kind) for v in values]


def _rough(pairs: DataFrame, rows: DataFrame, per_cent: int) -> DataFrame:
    """The pairs (a, b) that sizes and registers allow."""
    @F.pandas_udf("boolean")
    def fits(ra: pd.Series, rb: pd.Series, na: pd.Series, nb: pd.Series) -> pd.Series:
        if not len(ra):
            return pd.Series([], dtype=bool)
        return pd.Series(may_link(np.stack(_array(ra, "u2")), np.stack(_array(rb, "u2")), na.to_numpy(), nb.to_numpy(), per_cent))

    side = lambda x: rows.select(F.col("node").alias(x), F.col("n_shingles").alias(f"n{x}"), F.col("registers").alias(f"r{x}"))
    return (pairs.join(side("b"), "b").join(side("a"), "a")
            .filter((100 * F.least("na", "nb") >= per_cent * F.greatest("na", "nb")) & fits("ra", "rb", "na", "nb")).select("a", "b"))


def _exact(pairs: DataFrame, sets: DataFrame, per_cent: int) -> DataFrame:
    """The pairs that are linked."""
    @F.pandas_udf("boolean")
    def holds(sa: pd.Series, sb: pd.Series) -> pd.Series:
        return pd.Series([linked(x, y, per_cent) for x, y in zip(_array(sa, "u8"), _array(sb, "u8"))], dtype=bool)

    side = lambda x: sets.select(F.col("node").alias(x), F.col("members").alias(f"s{x}"))
    return pairs.join(side("b"), "b").join(side("a"), "a").filter(holds("sa", "sb")).select("a", "b")


def _blocks(rows: DataFrame, group: str) -> DataFrame:
    """Deal each group into blocks of about BLOCK of its ``size`` members; a row goes to every pair of blocks that has its own."""
    parts = F.greatest(F.lit(1), F.ceil(F.col("size") / F.lit(BLOCK))).cast("int")
    own = F.pmod(F.xxhash64("node"), parts).cast("int")
    return (rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
            .withColumn("lo", F.least("own", "other")).withColumn("hi", F.greatest("own", "other")).drop("other").repartition(tasks_for(rows), group, "lo", "hi"))


def _cross_links(frame: pd.DataFrame, per_cent: int) -> pd.DataFrame:
    """Links between the two blocks of one group, enough to join all components that have any link."""
    out: list[tuple[int, int]] = []
    lo, hi = int(frame["lo"].iloc[0]), int(frame["hi"].iloc[0])
    frame = frame.sort_values("node").reset_index(drop=True)
    root: dict[int, int] = {}

    def find(c: int) -> int:
        while root.get(c, c) != c:
            c = root[c]
        return c

    registers = np.stack(_array(frame["registers"], "u2"))
    sizes, nodes, comp = frame["n_shingles"].to_numpy(), frame["node"].to_numpy(), frame["component"].to_numpy()
    sets = _array(frame["members"], "u8")
    mine = frame["own"].to_numpy()
    for i in range(len(frame)):
        rest = np.arange(i + 1, len(frame))
        if lo != hi:
            rest = rest[mine[rest] != mine[i]]
        rest = rest[comp[rest] != comp[i]]
        if not len(rest):
            continue
        ok = may_link(registers[rest], registers[i][None], sizes[rest], sizes[i], per_cent)
        for j in rest[ok]:
            a, b = find(int(comp[i])), find(int(comp[j]))
            if a != b and linked(sets[i], sets[j], per_cent):
                root[max(a, b)] = min(a, b)
                out.append((int(nodes[i]), int(nodes[j])))
    return pd.DataFrame(out, columns=["a", "b"]).astype("int64")


def groups(documents: DataFrame, shingle: int = 3, per_cent: int = 85) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept."""
    sketch = stored(sketches(documents, shingle, per_cent), "neardup-sketch")
    real = sketch.filter((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    classes = real.groupBy("set_key").agg(F.min(F.struct("doc_id", "row")).alias("head")).select("set_key", F.col("head.doc_id").alias("node"), "head.row")
    members = stored(real.select("doc_id", "set_key").join(classes, "set_key").select("doc_id", "node").distinct(), "neardup-members")
    heads = stored(real.join(classes.select("row"), "row", "left_semi")
                   .select(F.col("doc_id").alias("node"), "n_shingles", "registers", "bands"), "neardup-heads")

    bands = heads.select("node", F.explode("bands").alias("band"))
    shared = bands.groupBy("band").agg(F.count("*").alias("size")).filter("size > 1")
    inside = stored(bands.join(shared, "band"), "neardup-buckets")
    weight = inside.groupBy("node").agg(F.sum("size").alias("weight"))
    hubs = (inside.join(weight, "node").groupBy("band")
            .agg(F.max_by("node", F.struct("weight", -F.col("node"))).alias("hub")))
    pairs = (inside.join(hubs, "band").filter("node <> hub")
             .select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct())
    near = stored(_rough(pairs, heads, per_cent), "neardup-near")
    ends = stored(near.select(F.col("a").alias("node")).unionByName(near.select(F.col("b").alias("node"))).distinct(), "neardup-ends")
    sets = stored(_set_rows(documents, ends, shingle), "neardup-sets")
    links = stored(forest(_exact(near, sets, per_cent), "a", "b"), "neardup-links")
    joined = components(links, "neardup-first")

    state = inside.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = (state.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high"))
             .filter("low <> high").select("band"))
    open_ = state.join(mixed, "band", "left_semi").join(heads.drop("bands"), "node")
    rough = stored(forest(_blocks(open_, "band").groupBy("band", "lo", "hi").applyInPandas(
        lambda frame: _rough_links(frame, per_cent), "a long, b long"), "b", "a"), "neardup-rough")
    clusters = components(rough, "neardup-clusters").withColumnRenamed("component", "cluster")
    sized = clusters.join(clusters.groupBy("cluster").agg(F.count("*").alias("size")), "cluster")
    fresh = stored(clusters.select("node").join(sets.select("node"), "node", "left_anti").distinct(), "neardup-fresh")
    all_sets = sets.unionByName(_set_rows(documents, fresh, shingle))
    rest = (sized.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
            .join(heads.drop("bands"), "node").join(all_sets, "node"))
    more = stored(_blocks(rest, "cluster").groupBy("cluster", "lo", "hi").applyInPandas(
        lambda frame: _cross_links(frame, per_cent), "a long, b long").distinct(), "neardup-more")

    everything = (links.unionByName(more)
                  .unionByName(members.filter("doc_id <> node").select(F.col("doc_id").alias("a"), F.col("node").alias("b"))))
    final = components(everything, "neardup-last").withColumnRenamed("node", "doc_id")
    return (sketch.select("doc_id", "n_shingles").join(final, "doc_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"),
                    F.coalesce(F.coalesce("component", "doc_id") == F.col("doc_id"), F.lit(True)).alias("kept")))


def _rough_links(frame: pd.DataFrame, per_cent: int) -> pd.DataFrame:
    """A spanning forest of the pairs, from different components, that sizes and registers allow."""
    registers = np.stack(_array(frame["registers"], "u2"))
    sizes, comp, mine = frame["n_shingles"].to_numpy(), frame["component"].to_numpy(), frame["own"].to_numpy()
    nodes, across = frame["node"].to_numpy(), frame["lo"].iloc[0] != frame["hi"].iloc[0]
    root = np.arange(len(frame))
    out = []
    for i in range(len(frame)):
        open_ = (comp != comp[i]) & (root != root[i])
        open_[:i] = False
        if across:
            open_ &= mine != mine[i]
        rest = np.flatnonzero(open_)
        if not len(rest):
            continue
        for j in rest[may_link(registers[rest], registers[i][None], sizes[rest], sizes[i], per_cent)]:
            if root[j] != root[i]:
                out.append((int(nodes[i]), int(nodes[j])))
                root[root == root[j]] = root[i]
    return pd.DataFrame(out, columns=["a", "b"]).astype("int64")


def keep_one(documents: DataFrame, shingle: int = 5, per_cent: int = 80) -> DataFrame:
    """The documents without the near copies: of each group the smallest doc_id stays, and of rows that share it one."""
    verdict = groups(documents, shingle, per_cent).select("doc_id", "kept")
    gone = stored(verdict.filter("doc_id is not null and not kept").select("doc_id").distinct(), "neardup-gone")
    left = documents.join(_few(gone), "doc_id", "left_anti")
    again = stored(verdict.filter("doc_id is not null and kept").groupBy("doc_id").count().filter("count > 1").select("doc_id"), "neardup-again")
    if not again.take(1):
        return left
    return left.join(_few(again), "doc_id", "left_anti").unionByName(left.join(_few(again), "doc_id", "left_semi").dropDuplicates(["doc_id"]))
