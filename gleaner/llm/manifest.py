"""Merkle manifest of a dataset: one digest over all rows, and a proof per row.

H is the lower-case hex SHA-256 of its inputs one after the other; digests go in
as hex text.  A row's leaf is H of its fields (``FIELDS``), each as its UTF-8 byte
count, ``:`` and its value, or ``-`` for null.  Per source the leaves stand by
doc_id, and every ``ARITY`` consecutive nodes become their H until one is left, the
subroot; the subroots, by source, become the root in the same way.

1. *Places*: leaves (digests only; the text is read once) are range-sorted by
   source and doc_id, and a count per source and range turns the place inside a
   range into the place inside the source, so a source of any size is spread
   over all tasks.
2. *Up*: per level one window over runs of ``ARITY`` nodes.  Lag and lead columns
   at the fixed offsets 1 to ``ARITY`` - 1, masked by the node's slot and its run's
   length, are its left and right siblings; the first child of a run hashes the
   parent.  A level has a sixteenth of the rows of the one below.
3. *Down*: a node's path is its own siblings and then its parent's path, joined
   per run on the partitioning that the window already has.  Only parents' paths
   are moved: a sixteenth of the rows.

Defined cases: a null source comes first and is a tree of its own; rows with a null
doc_id come first in their source, and rows that share a doc_id stand by leaf, so
equal rows may change places without any digest changing.  A null doc_id is never
tampered with.  A run of one node is hashed again, without siblings.  An empty
table gives no rows and has no root.  Extra columns are not read.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, tasks_for

ARITY = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def field(value: Column) -> Column:
    """One field of a leaf: ``-`` for null, else byte count, ``:`` and value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaf_of(text: Column) -> Column:
    return digest(*(field(F.col(c)) for c in FIELDS[:-1]), field(text))


def tampered_with(doc_id: Column) -> Column:
    """Which rows the registered query tampers with; their text then loses its A-Z."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def leaves(documents: DataFrame) -> DataFrame:
    """(tree, doc_id, row, digest, changed): a slim row per document; ``changed`` is the tampered leaf or null."""
    lower = F.translate(F.col("text"), string.ascii_uppercase, string.ascii_lowercase)
    tree = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))  # null before everything else
    return documents.select(*FIELDS).select(
        tree.alias("tree"), "doc_id", F.monotonically_increasing_id().alias("row"), leaf_of(F.col("text")).alias("digest"),
        F.when(tampered_with(F.col("doc_id")), leaf_of(lower)).alias("changed"))


def placed(nodes: DataFrame, order: list[str], name: str) -> DataFrame:
    """The stored ``nodes`` with ``pos``, their place (from 0) in their tree, and ``n``, its number of nodes."""
    ranged = stored(nodes.repartitionByRange(tasks_for(nodes), "tree", *order).sortWithinPartitions("tree", *order)
                    .withColumn("at", F.monotonically_increasing_id()), name)
    part = F.shiftright("at", 33)  # the range; the low bits count inside it
    runs = ranged.groupBy("tree", part.alias("part")).agg(F.count("*").alias("size"), F.min("at").alias("first"))
    tree = Window.partitionBy("tree")  # a row per range that holds some of the tree
    before = runs.select("tree", "part", "first", (F.sum("size").over(tree.orderBy("part")) - F.col("size")).alias("before"),
                         F.sum("size").over(tree).alias("n"))
    return (ranged.withColumn("part", part).join(before, ["tree", "part"])
            .withColumn("pos", F.col("at") - F.col("first") + F.col("before")).drop("part", "first", "before", "at"))


def siblings(nodes: DataFrame) -> DataFrame:
    """Nodes of trees that go on, with ``run``, ``slot`` and the digests ``left`` and ``right`` of them in their run."""
    nodes = (nodes.filter("n > 1").withColumn("run", F.expr(f"pos div {ARITY}")).withColumn("slot", F.col("pos") % ARITY)
             .withColumn("length", F.least(F.lit(ARITY), F.col("n") - F.col("run") * ARITY)))
    run = Window.partitionBy("tree", "run").orderBy("pos")
    before = [F.when(F.col("slot") >= k, F.lag("digest", k).over(run)) for k in range(ARITY - 1, 0, -1)]
    after = [F.when(F.col("slot") + k < F.col("length"), F.lead("digest", k).over(run)) for k in range(1, ARITY)]
    return nodes.withColumns({"left": F.concat_ws("", *before), "right": F.concat_ws("", *after)})


def climb(nodes: DataFrame, name: str) -> list[DataFrame]:
    """All levels (tree, pos, n, digest), from ``nodes`` up; a tree ends at the level where its n is 1."""
    levels, most = [nodes], nodes.agg(F.max("n")).first()[0] or 1
    while most > 1:
        first = siblings(levels[-1]).filter("slot = 0")
        levels.append(stored(first.select("tree", F.col("run").alias("pos"), F.ceil(F.col("n") / ARITY).alias("n"),
                                          digest(F.col("digest"), F.col("right")).alias("digest")), f"{name}-{len(levels)}"))
        most = -(-most // ARITY)
    return levels


def roots(levels: list[DataFrame]) -> DataFrame:
    """(tree, digest) of what remains of each tree."""
    tops = [x.filter("n = 1").select("tree", "digest") for x in levels]
    out = tops[0]
    for x in tops[1:]:
        out = out.unionByName(x)
    return out


def descend(levels: list[DataFrame], above: DataFrame) -> DataFrame:
    """The lowest level with ``path``, the (left, right) of every level up to the root, and the columns of ``above``.

    ``above`` (tree, path, ...) says how each tree's own root goes on.
    """
    carried = [c for c in above.columns if c not in ("tree", "path")]
    paths = None
    for nodes in reversed(levels):
        own = [c for c in nodes.columns if c != "tree"]
        here = nodes.filter("n = 1").join(above, "tree").select("tree", *own, "path", *carried)
        if paths is not None:
            up = paths.select("tree", F.col("pos").alias("run"), F.col("path").alias("rest"), *carried)
            here = here.unionByName(siblings(nodes).join(up, ["tree", "run"]).select(
                "tree", *own, F.concat(F.array(F.struct("left", "right")), "rest").alias("path"), *carried))
        paths = here
    return paths


def manifest(documents: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, path, changed) per row: ``path`` leads from the leaf to the root."""
    flat = stored(leaves(documents), "manifest-leaves")
    inner = climb(stored(placed(flat, ["doc_id", "digest", "row"], "manifest-ranged"), "manifest-placed"), "manifest-level")
    subroots = stored(roots(inner), "manifest-subroots")
    names = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest")
    outer = climb(stored(placed(names, ["name"], "manifest-sources"), "manifest-sources-placed"), "manifest-source-level")
    end = roots(outer).select("tree", F.array().cast("array<struct<left:string,right:string>>").alias("path"), F.col("digest").alias("root"))
    above = stored(descend(outer, end).select(F.col("name").alias("tree"), "path", F.col("digest").alias("subroot"), "root"), "manifest-above")
    return descend(inner, above).select("doc_id", F.col("digest").alias("leaf"), "subroot", "root", "path", "changed")


def proofs(documents: DataFrame) -> DataFrame:
    """One row per input row: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    ``folded_root`` starts from the tampered leaf where there is one, and from the
    row's own leaf else, and folds the siblings of the untampered manifest.
    """
    folded = F.aggregate("path", F.coalesce("changed", "leaf"), lambda have, x: digest(x["left"], have, x["right"]))
    proof = digest(F.array_join(F.transform("path", lambda x: F.concat(x["left"], x["right"])), ""))
    return (manifest(documents)
            .select("doc_id", "leaf", "subroot", "root", proof.alias("proof_sha256"), folded.alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))
