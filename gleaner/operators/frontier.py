"""Link-graph traversal: bounded-depth frontier (G1, J3, A10) and
pagination chains (G2).

These are iterative joins driven from the driver: ``max_depth`` levels for the
frontier, about log2(chain length) rounds of pointer jumping for the chain, and for the
original's crawl order as many rounds as pages hang on one another's order.  Each level is
written to the shared checkpoint folder (``spark.checkpoint.dir``) so lineage
stays short and a lost executor re-reads one level, not the walk.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.session import materialize


def bfs_frontier(spark: SparkSession, seeds: DataFrame, edges: DataFrame, max_depth: int = 1) -> DataFrame:
    """G1: every URL reachable from the seeds within ``max_depth`` links, at
    its shortest depth (breadth-first; the visited set is global across
    seeds, as the original crawler's is).

    seeds: (url); edges: (src, dst).  Returns (url, depth).  Per level the
    frontier joins the edge list on src, new targets are de-duplicated
    (partial aggregation before the shuffle) and anti-joined with the
    levels so far (J3).  Only the new level is written, into the shared
    folder; the visited set is the union of the levels.
    """
    edges = edges.select("src", "dst")
    levels = [materialize(seeds.select("url").distinct().withColumn("depth", F.lit(0)))]
    for depth in range(1, max_depth + 1):
        visited = reduce(DataFrame.unionByName, levels)
        reached = edges.join(levels[-1], edges.src == levels[-1].url).select(F.col("dst").alias("url")).distinct()
        new = materialize(reached.join(visited, "url", "left_anti").withColumn("depth", F.lit(depth)))
        if not new.take(1):
            break
        levels.append(new)
    return reduce(DataFrame.unionByName, levels)


def ordered_crawl(spark: SparkSession, seeds: DataFrame, edges: DataFrame, max_depth: int = 1, most_rounds: int = 200) -> DataFrame:
    """G1 in the original's order: depth first, seed after seed, links as they stand on the page.

    seeds: (url, place); edges: (src, dst, place), places being whole numbers that order
    the seeds and each page's links.  Returns (url, depth, label): ``label`` holds the seed's
    place and the places of the links that lead to the page when it is first visited; pages
    by label are in visiting order.  One visited set covers all seeds, and a page first
    met at ``max_depth`` is never expanded, even if a shorter way turns up later.

    The crawl tries links in the order of their labels, so a page's label is the smallest of
    its seed places and of (label of q, link place) over the pages q that link to it and
    were themselves met above ``max_depth``.  Labels grow along links, so this has
    exactly one solution, and every round of recomputing all labels from the last ones
    settles at least the smallest unsettled one; a round is one join and one minimum per page.
    """
    links = materialize(edges.groupBy("src", "dst").agg(F.min(F.col("place").cast("long")).alias("place")).filter("src <> dst"))
    first = seeds.groupBy("url").agg(F.array(F.min(F.col("place").cast("long"))).alias("label"))
    labels, state = materialize(first), None
    for _ in range(most_rounds):
        row = labels.agg(F.count("*"), F.bit_xor(F.xxhash64("url", "label")), F.sum(F.xxhash64("label", "url").cast("decimal(38,0)"))).first()
        if tuple(row) == state:
            return labels.select("url", (F.size("label") - 1).alias("depth"), "label")
        state = tuple(row)
        met = (labels.filter(F.size("label") <= max_depth).join(links, F.col("url") == F.col("src"))
               .select(F.col("dst").alias("url"), F.concat("label", F.array("place")).alias("label")))
        labels = materialize(first.unionByName(met).groupBy("url").agg(F.min("label").alias("label")))
    raise RuntimeError(f"the crawl order did not settle within {most_rounds} rounds")


def list_rank(spark: SparkSession, nodes: DataFrame, start_url: str, max_rounds: int = 64) -> DataFrame:
    """Walk next-links from ``start_url`` without a per-page loop.

    nodes: (url, next_url) with next_url null at the end; next pages that were
    not captured end the chain.  Forward pointer jumping: after round k the
    first 2**k pages are known, and every page knows the page 2**k steps ahead;
    the next round jumps from all known pages at once.  So a chain of n pages
    takes about log2(n) rounds, from any start, whatever else links to its
    pages; a cycle ends at the first page that comes again (its first
    number stays).  Should a page name several next ones, the smallest counts.
    """
    jump = (nodes.groupBy("url").agg(F.min("next_url").alias("ahead")).filter(F.col("ahead").isNotNull())
            .join(nodes.select(F.col("url").alias("ahead")).distinct(), "ahead", "left_semi").select("url", "ahead"))
    jump = materialize(jump)
    known = materialize(nodes.filter(F.col("url") == start_url).select("url").distinct()
                        .withColumn("page_no", F.lit(1).cast("long")))
    size = known.count()
    # Every round doubles the pages known, so 64 rounds cover chains of
    # up to 2**64 pages: the bound never cuts a real chain short.
    for k in range(max_rounds):
        further = known.join(jump, "url").select(F.col("ahead").alias("url"), (F.col("page_no") + F.lit(2 ** k)).alias("page_no"))
        known = materialize(known.unionByName(further).groupBy("url").agg(F.min("page_no").alias("page_no")))
        before, size = size, known.count()
        if size == before:
            break
        jump = materialize(jump.alias("a").join(jump.alias("b"), F.col("a.ahead") == F.col("b.url"))
                           .select("a.url", F.col("b.ahead").alias("ahead")))
    return known.select(F.col("page_no").cast("int").alias("page_no"), "url")
