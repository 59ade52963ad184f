"""Plans for link-graph traversal and listings."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleaner.functions import urls as U
from gleaner.operators import frontier as FR
from gleaner.operators.listings import listing
from gleaner.plans import sqlbits as Q
from gleaner.plans.pages_plans import resolved_links
from gleaner.plans.registry import plan
from gleaner.sources import captures, fixtures

MAX_DEPTH = 2
SHOP = fixtures.SHOP_BASE

_EDGES = f"""
SELECT '{SHOP}/order/' || l_orderkey AS src, '{SHOP}/part/' || l_partkey AS dst FROM lineitem
UNION ALL
SELECT '{SHOP}/part/' || l_partkey, '{SHOP}/order/' || l_orderkey FROM lineitem
"""


@plan("crawl_frontier", oracle=f"""
WITH RECURSIVE e AS ({_EDGES}),
seeds AS (SELECT '{SHOP}/order/' || o_orderkey AS url FROM orders
          WHERE o_orderdate = (SELECT min(o_orderdate) FROM orders)),
walk(url, depth) AS (
  SELECT url, 0 FROM seeds
  UNION
  SELECT e.dst, w.depth + 1 FROM walk w JOIN e ON e.src = w.url WHERE w.depth < {MAX_DEPTH})
SELECT url, min(depth)::INTEGER AS depth,
       CAST(min(depth) AS VARCHAR) || '_' || md5(url) || '.html' AS file_name
FROM walk GROUP BY url""")
def crawl_frontier(spark, sf_dir, max_depth=MAX_DEPTH):
    """G1/K1: pages reachable from the seed orders within max_depth links."""
    v = FR.bfs_frontier(spark, fixtures.crawl_seeds(spark, sf_dir), fixtures.link_graph(spark, sf_dir),
                        max_depth)
    return v.select("url", F.col("depth").cast("int").alias("depth"),
                    U.capture_file_name(F.col("depth"), F.col("url")).alias("file_name"))


def _round(k: int) -> str:
    return f"""
l{k} AS MATERIALIZED (SELECT url, min(label) AS label FROM (
  SELECT * FROM l0 UNION ALL
  SELECT e.dst, list_append(l.label, e.place) FROM l{k - 1} l JOIN e ON e.src = l.url WHERE len(l.label) <= {MAX_DEPTH}) GROUP BY url)"""


#: Rounds that the statement below unrolls; its last two must agree, else it fails.
_ROUNDS = 12


@plan("crawl_in_order", oracle=f"""
WITH e AS MATERIALIZED (
  SELECT src, dst, min(place) AS place FROM (
    SELECT '{SHOP}/order/' || l_orderkey AS src, '{SHOP}/part/' || l_partkey AS dst, l_linenumber::BIGINT AS place FROM lineitem
    UNION ALL SELECT '{SHOP}/part/' || l_partkey, '{SHOP}/order/' || l_orderkey, l_orderkey * 8 + l_linenumber FROM lineitem) GROUP BY ALL),
l0 AS MATERIALIZED (SELECT '{SHOP}/order/' || o_orderkey AS url, [o_orderkey] AS label FROM orders
       WHERE o_orderdate = (SELECT min(o_orderdate) FROM orders)),
{",".join(_round(k) for k in range(1, _ROUNDS + 1))}
SELECT url, (len(label) - 1)::INTEGER AS depth, label FROM l{_ROUNDS}
WHERE CASE WHEN EXISTS (SELECT * FROM l{_ROUNDS} EXCEPT SELECT * FROM l{_ROUNDS - 1}) THEN error('not settled') ELSE true END""")
def crawl_in_order(spark, sf_dir, max_depth=MAX_DEPTH):
    """G1 as the original walks: depth first from ordered seeds, one visited set, the way to each page."""
    return FR.ordered_crawl(spark, fixtures.ordered_seeds(spark, sf_dir), fixtures.ordered_links(spark, sf_dir), max_depth)


@plan("crawl_new_links", oracle=f"""
SELECT DISTINCT l.link_url FROM (
  SELECT page_id, pos, href, {Q.resolve_href('href', 'url')} AS link_url FROM (
    SELECT page_id, url, unnest(hrefs) AS href, unnest(range(len(hrefs))) AS pos
    FROM (SELECT page_id, url, {Q.link_hrefs('html')} AS hrefs FROM pages))) l
WHERE NOT EXISTS (SELECT 1 FROM pages p WHERE p.url = l.link_url)""")
def crawl_new_links(spark, sf_dir):
    """Link targets of the captured pages that were not captured."""
    links = resolved_links(spark, sf_dir).select("link_url").distinct()
    seen = captures.pages(spark, sf_dir).select(F.col("url").alias("link_url"))
    return links.join(seen, "link_url", "left_anti")


@plan("listing_links", oracle=f"""
SELECT page_no, pos, href, md5(href) AS url_md5,
       'page' || page_no || '_proj' || pos || '_' || md5(href) || '.html' AS file_name
FROM (SELECT (floor(p_partkey / {fixtures.LISTING_PAGE_SIZE}) + 1)::INTEGER AS page_no,
             (row_number() OVER (PARTITION BY floor(p_partkey / {fixtures.LISTING_PAGE_SIZE})
                                 ORDER BY p_partkey) - 1)::INTEGER AS pos,
             '{U.LISTING_BASE_URL}/gepris/projekt/' || p_partkey || CASE WHEN p_partkey % 3 = 0 THEN '?a=1&b=2' ELSE '' END AS href
      FROM part)""")
def listing_links(spark, sf_dir):
    """Project links of each listing page, made absolute."""
    lp = fixtures.listing_pages(spark, sf_dir)
    e = lp.select("page_no", F.posexplode(listing("html")["hrefs"]).alias("pos", "href"))
    href = U.prefix_base(F.col("href"))
    return e.select("page_no", "pos", href.alias("href"), U.url_md5(href).alias("url_md5"),
                    U.listing_file_name(F.col("page_no"), F.col("pos"), href).alias("file_name"))


@plan("pagination_chain", oracle=f"""
WITH RECURSIVE pg AS (SELECT DISTINCT (floor(p_partkey / {fixtures.LISTING_PAGE_SIZE}) + 1)::INTEGER AS page_no
                      FROM part),
walk(page_no) AS (
  SELECT 1 FROM pg WHERE page_no = 1
  UNION ALL
  SELECT w.page_no + 1 FROM walk w JOIN pg ON pg.page_no = w.page_no + 1)
SELECT page_no, '{U.LISTING_BASE_URL}{fixtures.LISTING_PATH}' || page_no AS url FROM walk""")
def pagination_chain(spark, sf_dir):
    """Follow 'next' links from the first listing page."""
    lp = fixtures.listing_pages(spark, sf_dir)
    nodes = lp.select("url", U.prefix_base(listing("html")["next"]).alias("next_url"))
    start = U.LISTING_BASE_URL + fixtures.LISTING_PATH + "1"
    return FR.list_rank(spark, nodes, start)
