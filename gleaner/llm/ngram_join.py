"""Exact Jaccard self-join of word n-gram sets, in size-banded tiles with bitmap signatures.

A document's set holds its distinct word n-grams (hashed to 64 bits, words
lower-cased A-Z).  Two documents link when 100 * |a and b| >= per_cent * |a or b|.
No link is missed: every filter here is a bound.

1. *Order*: n-grams that many documents of a slice hold are counted; the
   ``MOST_FREQUENT`` most frequent ones come last in the order of all n-grams, the
   others stand by hash.  Any order is exact; this one keeps common passages out of step 3.
2. *Classes*: equal sets form a class, and one of them stands for it.  Each has its size,
   its first n - ceil(s n) + 1 n-grams in that order (two sets that link share one of
   theirs), and a bitmap: each n-gram flips the bit that its hash names, in a number
   of bits that follows the size.
3. *Tiles*: sets that share one of those n-grams and lie in one size band, or in the band
   below (a link needs sizes within s of each other, the width of a band).  Of the
   tiles with the same members one is kept.
4. *Stars*: each tile pairs its members with one of them.  Bits in which two bitmaps
   differ stem from n-grams that only one of the sets has, so
   |a and b| <= (|a| + |b| - differing bits) / 2; pairs whose bound falls short go, and
   the others are decided by the intersection of the full sorted sets.
5. *Rest*: in tiles whose members still lie in different components, those outside the
   tile's largest component are compared with all others, by bitmaps, in blocks of
   ``BLOCK`` x ``BLOCK``.  What may link across components forms clusters, whose full sets
   are compared in such blocks, only for links between components not yet joined.
6. Components over all links; the smallest doc_id names each.

So the work on a large family of near copies grows with its members times those
that its star did not reach.  Links inside a component are not listed.

Defined cases: a text that is null, empty or without words has an empty set and no
links.  A null doc_id gives no links either (component null).  Rows that share a
doc_id are one document with the links of all its rows.  Fewer words than an n-gram:
the whole sequence is the one n-gram.  Extra columns are not read; results do not
depend on row order.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import HashIndex, chunks, components, forest, stored, tasks_for
from .near_dedup import MOST_BROADCAST, linked, sets_of

#: N-grams whose frequency counts in the order; a choice of plan, results do not depend on it.
MOST_FREQUENT = 1 << 16
#: Documents of a slice that must hold an n-gram before it is counted.
LEAST_IN_SLICE = 3
#: Members of a tile or cluster that one task compares with as many others.
BLOCK = 256
#: Sets up to this size have a bitmap of 512 bits; it doubles with the size.
SMALL_SET, SMALL_BITS = 1024, 512


# ---------------------------------------------------------------- sets, order, signatures

def frequent(documents: DataFrame, k: int) -> np.ndarray:
    """The most frequent n-grams, rarest first; bounded by ``MOST_FREQUENT``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            values, counts = np.unique(np.concatenate(sets_of(batch.column("text"), k) or [np.zeros(0, np.uint64)]), return_counts=True)
            often = counts >= LEAST_IN_SLICE
            yield pa.RecordBatch.from_arrays([pa.array(values[often].view(np.int64)), pa.array(counts[often])], names=["gram", "n"])

    rows = (documents.select("text").mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
            .orderBy(F.col("n").desc(), "gram").limit(MOST_FREQUENT).collect())
    return np.array([r.gram for r in reversed(rows)], dtype=np.int64).view(np.uint64)


def prefix_length(n: int, per_cent: int) -> int:
    """How many first n-grams of a set any partner's first ones must meet."""
    return n - -(-per_cent * n // 100) + 1 if n else 0


def bitmap(values: np.ndarray) -> bytes:
    """Parity bitmap: bit h mod width flips for every n-gram hash h."""
    width = SMALL_BITS * 2 ** max(0, math.ceil(math.log2(max(1, len(values)) / SMALL_SET)))
    flips = np.bincount((values & np.uint64(width - 1)).astype(np.int64), minlength=width)
    return np.packbits((flips & 1).astype(np.uint8)).tobytes()


def same_width(bitmaps: list[bytes]) -> np.ndarray:
    """Bitmaps as rows of 64-bit words; wide ones are folded to the narrowest, which keeps the parities."""
    least = min(map(len, bitmaps))
    rows = [np.frombuffer(b, dtype=np.uint64) for b in bitmaps]
    return np.stack([np.bitwise_xor.reduce(r.reshape(-1, least // 8), axis=0) for r in rows])


def may_link(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray, per_cent: int) -> np.ndarray:
    """False only where sizes or bit counts rule a link out."""
    differ = np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int64)
    most = np.minimum((size_a + size_b - differ) // 2, np.minimum(size_a, size_b))
    return 100 * most >= per_cent * (size_a + size_b - most)


_SKETCH = "doc_id long, n_shingles long, set_key binary, bits binary, prefix array<long>"


def sketches(documents: DataFrame, k: int, per_cent: int) -> DataFrame:
    """(doc_id, n_shingles, set_key, bits, prefix, row) of every row."""
    hot = frequent(documents, k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = HashIndex(hot)

        def prefix(s: np.ndarray) -> np.ndarray:
            rank = index.find(s)
            some = prefix_length(len(s), per_cent)
            rare = s[rank < 0][:some]
            if len(rare) < some:
                rest = rank >= 0
                rare = np.concatenate([rare, s[rest][np.argsort(rank[rest])][:some - len(rare)]])
            return rare.view(np.int64)

        for batch in chunks(batches, "text"):
            sets = sets_of(batch.column("text"), k)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                 pa.array([bitmap(s) for s in sets], pa.binary()), pa.array([prefix(s) for s in sets], pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "set_key", "bits", "prefix"])

    return documents.select("doc_id", "text").mapInArrow(run, _SKETCH).withColumn("row", F.monotonically_increasing_id())


def set_rows(documents: DataFrame, nodes: DataFrame, k: int) -> DataFrame:
    """(node, members) with the full sorted sets of the documents in the stored ``nodes``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array([s.tobytes() for s in sets_of(batch.column("text"), k)], pa.binary())], names=["node", "members"])

    few = F.broadcast(nodes) if nodes.count() <= MOST_BROADCAST else nodes
    return documents.select(F.col("doc_id").alias("node"), "text").join(few, "node", "left_semi").mapInArrow(run, "node long, members binary")


# ---------------------------------------------------------------- tiles

def tiles(heads: DataFrame, per_cent: int, name: str) -> DataFrame:
    """(tile, size, node, resident): the stored cells of all tiles that can hold a link."""
    grams = heads.select("node", "n_shingles", F.explode("prefix").alias("gram"))
    shared = grams.groupBy("gram").agg(F.count("*").alias("many")).filter("many > 1").select("gram")
    # a set is a resident of its own band's tile, and a guest among the larger sets of the next; the small shift
    # keeps sizes that are a whole number of bands apart from being rounded to different sides of a border
    band = F.floor(F.log("n_shingles") / F.lit(-math.log(per_cent / 100)) + F.lit(1e-9)).cast("int")
    banded = grams.join(shared, "gram").select(
        "gram", "node", F.explode(F.array(F.struct(band.alias("band"), F.lit(True).alias("resident")),
                                          F.struct((band + 1).alias("band"), F.lit(False).alias("resident")))).alias("to")).select("gram", "node", "to.*")
    banded = stored(banded, f"{name}-banded")
    members = [F.bit_xor(F.xxhash64("node", "resident", F.lit(s))).alias(f"x{s}") for s in (1, 2)]
    found = (banded.groupBy("gram", "band").agg(F.count("*").alias("size"), F.count_if("resident").alias("own"), *members)
             .filter("own > 0 and size > 1")
             .groupBy("size", "own", "x1", "x2").agg(F.min(F.struct("gram", "band")).alias("first")).select("size", "first.*"))
    return stored(banded.join(found, ["gram", "band"]).select(
        F.xxhash64("gram", "band").alias("tile"), "size", "node", "resident"), f"{name}-cells")


def stars(cells: DataFrame) -> DataFrame:
    """(node, hub): every member of a tile with the resident that has most cells."""
    weight = cells.groupBy("node").agg(F.sum("size").alias("weight"))
    hubs = (cells.filter("resident").join(weight, "node").groupBy("tile")
            .agg(F.max_by("node", F.struct("weight", -F.col("node"))).alias("hub")))
    return cells.join(hubs, "tile").filter("node <> hub").select("node", "hub").distinct()


def _arrays(values: pd.Series) -> list[np.ndarray]:
    return [np.frombuffer(v, dtype=np.uint64) for v in values]


def bounded(pairs: DataFrame, heads: DataFrame, per_cent: int) -> DataFrame:
    """The pairs (node, hub) that sizes and bit counts allow."""
    @F.pandas_udf("boolean")
    def fits(a: pd.Series, b: pd.Series, na: pd.Series, nb: pd.Series) -> pd.Series:
        out = np.zeros(len(a), dtype=bool)
        width = np.minimum(a.str.len(), b.str.len()).to_numpy()
        for w in np.unique(width):
            at = np.flatnonzero(width == w)
            fold = lambda x: np.stack([np.bitwise_xor.reduce(np.frombuffer(v, np.uint64).reshape(-1, w // 8), axis=0) for v in x.iloc[at]])  # noqa: B023, E731
            out[at] = may_link(fold(a), fold(b), na.to_numpy()[at], nb.to_numpy()[at], per_cent)
        return pd.Series(out)

    side = lambda x: heads.select(F.col("node").alias(x), F.col("n_shingles").alias(f"n_{x}"), F.col("bits").alias(f"b_{x}"))
    sized = pairs.join(side("node"), "node").join(side("hub"), "hub").filter(
        100 * F.least("n_node", "n_hub") >= per_cent * F.greatest("n_node", "n_hub"))
    return sized.filter(fits("b_node", "b_hub", "n_node", "n_hub")).select("node", "hub").distinct()


def decided(pairs: DataFrame, sets: DataFrame, per_cent: int) -> DataFrame:
    """The pairs (node, hub) that are linked, by their full sorted sets."""
    @F.pandas_udf("boolean")
    def holds(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([linked(x, y, per_cent) for x, y in zip(_arrays(a), _arrays(b))], dtype=bool)

    side = lambda x: sets.select(F.col("node").alias(x), F.col("members").alias(f"s_{x}"))
    return pairs.join(side("node"), "node").join(side("hub"), "hub").filter(holds("s_node", "s_hub")).select("node", "hub").distinct()


# ---------------------------------------------------------------- rest, in blocks

def blocks(rows: DataFrame, group: str) -> DataFrame:
    """Deal the rows of each ``group`` with more than one component into blocks, a copy for each pair of blocks to compare.

    ``rows`` has ``node`` and ``component``.  Members outside the group's largest
    component are open: every pair of blocks has an open one, so members of the
    largest one are never compared with each other.
    """
    sizes = rows.groupBy(group, "component").agg(F.count("*").alias("n"))
    kinds = (sizes.groupBy(group).agg(F.max(F.struct("n", "component")).alias("top"), F.sum("n").alias("all"), F.count("*").alias("kinds"))
             .filter("kinds > 1").select(group, F.col("top.component").alias("largest"), F.col("top.n").alias("closed"),
                                         (F.col("all") - F.col("top.n")).alias("open")))
    parts = lambda c: F.ceil(F.col(c) / F.lit(BLOCK)).cast("int")
    is_open = F.col("component") != F.col("largest")
    dealt = rows.join(kinds, group).withColumns({"o": parts("open"), "c": parts("closed")})
    spot = lambda n: F.pmod(F.xxhash64("node"), n).cast("int")
    own = F.when(is_open, spot(F.col("o"))).otherwise(F.col("o") + spot(F.col("c")))
    other = F.explode(F.sequence(F.lit(0), F.col("o") - 1 + F.when(is_open, F.col("c")).otherwise(F.lit(0))))
    return (dealt.withColumn("own", own).withColumn("other", other)
            .withColumns({"lo": F.least("own", "other"), "hi": F.greatest("own", "other")})
            .drop("other", "o", "c", "open", "closed", "largest"))


def by_group(rows: DataFrame, keys: list[str], compare: Callable[[dict], list[tuple[int, int]]]) -> DataFrame:
    """(a, b) from ``compare`` on the columns of each group; groups must be bounded."""
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []

        def results(table: pa.Table) -> pa.RecordBatch:
            key = np.stack([table.column(x).to_numpy() for x in keys])
            edge = np.concatenate([[0], np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1, [table.num_rows]])
            out = []
            for a, b in zip(edge[:-1], edge[1:]):
                if b - a > 1:
                    part = table.slice(a, b - a)
                    out += compare({x: part.column(x).to_numpy() for x in names})
            ends = np.array(out, dtype=np.int64).reshape(-1, 2)
            return pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            last = [batch.column(x)[batch.num_rows - 1].as_py() for x in keys]
            same = np.all([batch.column(x).to_numpy() == v for x, v in zip(keys, last)], axis=0)
            whole = 0 if same.all() else int(np.flatnonzero(~same)[-1]) + 1  # sorted: the last group may go on
            if whole:
                yield results(pa.Table.from_batches([*waiting, batch.slice(0, whole)]))
                waiting = [batch.slice(whole)]
            else:
                if waiting and [waiting[-1].column(x)[waiting[-1].num_rows - 1].as_py() for x in keys] != last:
                    yield results(pa.Table.from_batches(waiting))
                    waiting = []
                waiting.append(batch)
        if waiting:
            yield results(pa.Table.from_batches(waiting))

    return (rows.repartition(tasks_for(rows), *keys).sortWithinPartitions(*keys)
            .mapInArrow(run, "a long, b long").distinct())


def across(per_cent: int, exact: bool) -> Callable[[dict], list[tuple[int, int]]]:
    """Compare the two blocks of a group: pairs of nodes in different components.

    A pair is left out where the pairs put out before join its ends: exact ones join whole
    components, the others, which may be no links, only the nodes that they name.
    """
    def compare(rows: dict) -> list[tuple[int, int]]:
        node, size, own, root = rows["node"], rows["n_shingles"], rows["own"], rows["component"].copy()
        bits = same_width(list(rows["bits"]))
        sets = _arrays(pd.Series(rows["members"])) if exact else None
        two = rows["lo"][0] != rows["hi"][0]
        met = root if exact else np.arange(len(node))
        out = []
        left = np.flatnonzero(own == rows["lo"][0]) if two else np.arange(len(node))
        for i in left:  # block ``lo`` is an open one
            rest = (root != root[i]) & (met != met[i])
            if two:
                rest &= own != own[i]
            else:
                rest[:i] = False
            at = np.flatnonzero(rest)
            for j in at[may_link(bits[at], bits[i], size[at], size[i], per_cent)]:
                if met[j] != met[i] and (not exact or linked(sets[i], sets[j], per_cent)):
                    out.append((int(node[i]), int(node[j])))
                    met[met == met[j]] = met[i]
        return out
    return compare


def _in_components(rows: DataFrame, joined: DataFrame) -> DataFrame:
    return rows.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))


def join(documents: DataFrame, shingle: int = 4, per_cent: int = 85) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id."""
    sketch = stored(sketches(documents, shingle, per_cent), "ngram-sketch")
    real = sketch.filter((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    classes = real.groupBy("set_key").agg(F.min(F.struct("doc_id", "row")).alias("head")).select("set_key", F.col("head.doc_id").alias("node"), "head.row")
    members = stored(real.select("doc_id", "set_key").join(classes, "set_key").filter("doc_id <> node").select("doc_id", "node").distinct(), "ngram-members")
    heads = stored(real.join(classes.select("row"), "row", "left_semi")
                   .select(F.col("doc_id").alias("node"), "n_shingles", "bits", "prefix"), "ngram-heads")
    signed = heads.drop("prefix")

    cells = tiles(heads, per_cent, "ngram")
    near = stored(bounded(stars(cells), signed, per_cent), "ngram-near")
    ends = stored(near.select("node").unionByName(near.select(F.col("hub").alias("node"))).distinct(), "ngram-ends")
    sets = stored(set_rows(documents, ends, shingle), "ngram-sets")
    links = stored(forest(decided(near, sets, per_cent), "node", "hub"), "ngram-links")
    joined = components(links, "ngram-first")

    open_ = blocks(_in_components(cells.filter("size > 2").select("tile", "node").distinct(), joined), "tile").join(signed, "node")
    rough = stored(by_group(open_, ["tile", "lo", "hi"], across(per_cent, exact=False)), "ngram-rough")
    clusters = components(rough, "ngram-clusters").withColumnRenamed("component", "cluster")
    fresh = stored(clusters.select("node").join(ends, "node", "left_anti").distinct(), "ngram-fresh")
    full = sets.join(clusters.select("node"), "node", "left_semi").unionByName(set_rows(documents, fresh, shingle))
    rest = blocks(_in_components(clusters, joined), "cluster").join(signed, "node").join(full, "node")
    more = stored(by_group(rest, ["cluster", "lo", "hi"], across(per_cent, exact=True)), "ngram-more")

    everything = links.unionByName(more).unionByName(members.select(F.col("doc_id").alias("a"), F.col("node").alias("b")))
    final = components(everything, "ngram-last").withColumnRenamed("node", "doc_id")
    return (sketch.select("doc_id", "n_shingles").join(final, "doc_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")))
