"""Plans over search result pages built from ``orders``.

Oracles derive each page's expected records from the order rows (variant =
page mod 4, link by priority, text/description by status).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from gleaner import fixed_values as FV
from gleaner.functions import html as H
from gleaner.functions import urls as U
from gleaner.operators import results as RR
from gleaner.plans import sqlbits as Q
from gleaner.plans.registry import plan
from gleaner.sources import fixtures

_CORDIS = FV.PROJECT_BASE_URL[: -len("/project/id/")]  # the site root
_O = """
SELECT o_orderkey, o_orderstatus, o_orderpriority, CAST(o_orderkey AS VARCHAR) AS k,
       floor(o_orderkey / 10)::BIGINT AS page_id, (floor(o_orderkey / 10)::BIGINT % 4) AS variant,
       (row_number() OVER (PARTITION BY floor(o_orderkey / 10) ORDER BY o_orderkey) - 1)::INTEGER AS i,
       CASE WHEN o_orderstatus = 'P' THEN NULL
            WHEN o_orderpriority = '1-URGENT' THEN '/en'
            WHEN o_orderpriority = '2-HIGH' THEN '/reporting'
            WHEN o_orderpriority = '3-MEDIUM' THEN '/factsheet'
            WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '/results' ELSE '' END AS suffix
FROM orders
"""
_XML_QUERY = "CASE WHEN page_id % 4 = 1 THEN '?lang=en&format=xml' ELSE '?format=xml' END"
_XML_TEXT = "CASE WHEN page_id % 4 = 1 THEN 'file' ELSE 'XML' END"
_PDF_TEXT = "'Download order ' || k || ' (' || o_orderpriority || ') and the rest of page ' || page_id"
# Every anchor of every page, in page order: the items' links, then the two
# links of the download section.
_ANCHORS = f"""
SELECT page_id, (row_number() OVER (PARTITION BY page_id ORDER BY ord) - 1)::INTEGER AS pos, href, text FROM (
  SELECT page_id, i AS ord,
         CASE WHEN suffix IS NULL THEN '{_CORDIS}/search/related?order=' || k
              ELSE '{_CORDIS}/project/id/' || k || suffix END AS href,
         CASE WHEN o_orderstatus = 'O' THEN '' ELSE 'Order ' || k END AS text
  FROM ({_O})
  UNION ALL SELECT page_id, 100, '{_CORDIS}/project/id/' || page_id || {_XML_QUERY}, {_XML_TEXT} FROM ({_O}) WHERE i = 0
  UNION ALL SELECT page_id, 101, '{_CORDIS}/project/id/' || page_id || '?format=pdf', {_PDF_TEXT} FROM ({_O}) WHERE i = 0)
"""


def _pages(spark, sf_dir):
    return fixtures.search_pages(spark, sf_dir)


@plan("selector_cascade", oracle=f"""
SELECT page_id,
       CASE any_value(variant) WHEN 0 THEN '.result' WHEN 1 THEN '[data-testid=''result-item'']'
                               WHEN 2 THEN 'article' END AS selector,
       CASE WHEN any_value(variant) = 3 THEN 0 ELSE count(*) END::BIGINT AS n_elements
FROM ({_O}) GROUP BY page_id""")
def selector_cascade(spark, sf_dir):
    """Which result selector wins on each page, and how many elements."""
    p = _pages(spark, sf_dir).select("page_id", RR.page_results("html").alias("r"))
    return p.select("page_id", "r.selector", F.size("r.elements").cast("bigint").alias("n_elements"))


@plan("search_result_rows", oracle=f"""
SELECT page_id, CASE variant WHEN 0 THEN '.result' WHEN 1 THEN '[data-testid=''result-item'']'
                             ELSE 'article' END AS selector,
       i AS pos, k AS id,
       '{_CORDIS}/project/id/' || k || CASE WHEN suffix = '/results' THEN '/results' ELSE '' END AS url,
       CASE WHEN o_orderstatus = 'O' THEN '' ELSE 'Order ' || k END AS title,
       CASE o_orderstatus WHEN 'F' THEN 'Total ' || k WHEN 'O' THEN 'Summary ' || k ELSE '' END AS description,
       greatest(round((10 - i)::DOUBLE / 10.0::DOUBLE, 1), 0.1) AS relevance_score
FROM ({_O})
WHERE variant < 3 AND suffix IS NOT NULL AND suffix NOT IN ('/reporting', '/factsheet')""")
def search_result_rows(spark, sf_dir):
    """Result records of the main branch."""
    return RR.parse_results(_pages(spark, sf_dir))


@plan("search_fallback_rows", oracle=f"""
SELECT page_id, (row_number() OVER (PARTITION BY page_id ORDER BY pos) - 1)::INTEGER AS pos,
       regexp_extract(href, '/project/id/(\\d+)', 1) AS id, href AS url,
       CASE WHEN text = '' THEN '{FV.FALLBACK_TITLE}' ELSE text END AS title,
       {FV.FALLBACK_RELEVANCE}::DOUBLE AS relevance_score
FROM (SELECT * FROM ({_ANCHORS}) WHERE page_id % 4 = 3 AND contains(href, '/project/id/')
      QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY pos) <= 10)
WHERE regexp_matches(href, '/project/id/\\d+')""")
def search_fallback_rows(spark, sf_dir):
    """The fallback branch on pages without result containers."""
    return RR.fallback_results(_pages(spark, sf_dir))


def _anchor_hrefs(spark, sf_dir):
    p = _pages(spark, sf_dir)
    e = p.select("page_id", "url", F.posexplode(H.link_hrefs(F.col("html"))).alias("pos", "href"))
    return e.select("page_id", "pos", U.resolve_href(F.col("href"), F.col("url")).alias("href"))


@plan("url_project_id", oracle=f"""
SELECT page_id, pos, href, nullif(regexp_extract(href, '/project/id/(\\d+)', 1), '') AS id FROM ({_ANCHORS})""")
def url_project_id(spark, sf_dir):
    """H8: the project id of every link (null when none)."""
    a = _anchor_hrefs(spark, sf_dir)
    return a.select("page_id", "pos", "href", U.project_id(F.col("href")).alias("id"))


@plan("url_subpage_filter", oracle=f"""
SELECT page_id, pos, href FROM ({_ANCHORS})
WHERE NOT (contains(href, '/reporting') OR contains(href, '/factsheet'))""")
def url_subpage_filter(spark, sf_dir):
    """Links that are not report or factsheet sub-pages."""
    a = _anchor_hrefs(spark, sf_dir)
    return a.filter(~U.is_subpage(F.col("href")))


@plan("url_normalize", oracle=f"""
SELECT page_id, pos, regexp_replace(href, '/project/id/(\\d+)/[a-z]{{2}}$', '/project/id/\\1') AS url
FROM ({_ANCHORS})""")
def url_normalize(spark, sf_dir):
    """Language segment after the id removed."""
    a = _anchor_hrefs(spark, sf_dir)
    return a.select("page_id", "pos", U.normalize_project_url(F.col("href")).alias("url"))


@plan("url_build_search", oracle=f"""
SELECT query_no, '{U.SEARCH_URL_PREFIX}' || {Q.quote_plus('query')} || '{U.SEARCH_URL_SUFFIX}' AS search_url,
       '{U.PROJECT_BASE_URL}' || source_id || '{U.XML_URL_SUFFIX}' AS xml_url
FROM ({Q.QUERIES})""")
def url_build_search(spark, sf_dir):
    """The search request of each query and the record URL of its source."""
    q = fixtures.project_queries(spark, sf_dir)
    return q.select("query_no", U.search_url(F.col("query")).alias("search_url"),
                    U.project_xml_url(F.col("source_id")).alias("xml_url"))


@plan("download_links", oracle=f"""
WITH first_orders AS (SELECT * FROM ({_O}) WHERE i = 0)
SELECT page_id, 'xml_link' AS kind, 0 AS pos, 'a' AS tag, {_XML_TEXT} AS text,
       '{_CORDIS}/project/id/' || page_id || {_XML_QUERY} AS href FROM first_orders
UNION ALL SELECT page_id, 'download_element', 0, 'h2', 'Download', NULL FROM first_orders
UNION ALL SELECT page_id, 'download_element', 1, 'a', CASE WHEN length({_PDF_TEXT}) > {FV.DOWNLOAD_TEXT_CUT}
         THEN substring({_PDF_TEXT}, 1, {FV.DOWNLOAD_TEXT_CUT}) || '...' ELSE {_PDF_TEXT} END, NULL FROM first_orders
UNION ALL
SELECT page_id, 'section_link', (pos - max(pos) OVER (PARTITION BY page_id) + 1)::INTEGER, 'a', text, href
FROM ({_ANCHORS}) WHERE contains(href, 'format=')""")
def download_links(spark, sf_dir):
    """XML links, 'download' elements (first 5, text cut at 50), and
    the links under the Download heading."""
    return RR.download_probes(_pages(spark, sf_dir))
