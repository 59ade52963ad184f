"""Plans over captured pages: scan, text, links, URL keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.functions import html as H
from gleaner.functions import urls as U
from gleaner.plans import sqlbits as Q
from gleaner.plans.registry import plan
from gleaner.sources import captures


def page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H1 + K3 over every captured page; the flagship query."""
    p = captures.pages(spark, sf_dir)
    text = H.html_to_text(F.col("html"))
    return p.select(
        "page_id", "url_md5",
        U.text_file_name(F.col("file_name")).alias("text_file"),
        text.alias("text"),
    ).withColumn(
        "n_words",
        F.when(F.col("text") == "", 0).otherwise(F.size(F.split("text", " "))).cast("bigint"),
    )


plan("html_strip_text", oracle=f"""
SELECT page_id, md5(url) AS url_md5, '0_' || md5(url) || '.md' AS text_file, text,
       {Q.n_words('text')} AS n_words
FROM (SELECT page_id, url, {Q.html_text('html')} AS text FROM pages)
""")(page_text)


@plan("scan_pages", oracle="""
SELECT page_id, url, md5(url) AS url_md5, '0_' || md5(url) || '.html' AS file_name,
       strlen(html)::BIGINT AS file_size
FROM pages
""")
def scan_pages(spark, sf_dir):
    p = captures.pages(spark, sf_dir)
    return p.select("page_id", "url", "url_md5", "file_name",
                    F.octet_length("html").cast("bigint").alias("file_size"))


def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H2: (page_id, pos, href) for each truthy <a href>, DOM order."""
    p = captures.pages(spark, sf_dir)
    return p.select("page_id", "url", F.posexplode(H.link_hrefs(F.col("html"))).alias("pos", "href"))


_LINKS_SQL = f"""
SELECT page_id, url, unnest(range(len(hrefs)))::INTEGER AS pos, unnest(hrefs) AS href
FROM (SELECT page_id, url, {Q.link_hrefs('html')} AS hrefs FROM pages)
"""


@plan("page_links", oracle=f"SELECT page_id, pos, href FROM ({_LINKS_SQL})")
def page_links_plan(spark, sf_dir):
    return page_links(spark, sf_dir).select("page_id", "pos", "href")


def resolved_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H3(b): links made absolute against the page URL."""
    return page_links(spark, sf_dir).select(
        "page_id", "pos", "href", U.resolve_href(F.col("href"), F.col("url")).alias("link_url"))


_RESOLVED_SQL = f"""
SELECT page_id, pos, href, {Q.resolve_href('href', 'url')} AS link_url FROM ({_LINKS_SQL})
"""

plan("resolve_links", oracle=_RESOLVED_SQL)(resolved_links)


@plan("url_md5_key", oracle="SELECT page_id, url, md5(url) AS url_md5 FROM pages")
def url_md5_key(spark, sf_dir):
    p = captures.pages(spark, sf_dir)
    return p.select("page_id", "url", "url_md5")


@plan("page_file_name", oracle=f"""
SELECT page_id, pos, link_url, {Q.capture_file_name('1', 'link_url')} AS file_name
FROM ({_RESOLVED_SQL})
""")
def page_file_name(spark, sf_dir):
    """H5: the depth-1 capture names the links of each page would get."""
    links = resolved_links(spark, sf_dir)
    return links.select("page_id", "pos", "link_url",
                        U.capture_file_name(F.lit(1), F.col("link_url")).alias("file_name"))


@plan("distinct_links", oracle=f"SELECT DISTINCT link_url FROM ({_RESOLVED_SQL})")
def distinct_links(spark, sf_dir):
    """A10: the set of link targets (partial aggregation before the shuffle)."""
    return resolved_links(spark, sf_dir).select("link_url").distinct()


@plan("url_query_params", oracle=f"""
SELECT page_id, unnest(range(len(ps)))::INTEGER AS pos,
       regexp_extract(unnest(ps), '^([^=]*)', 1) AS key,
       regexp_extract(unnest(ps), '^[^=]*=?(.*)$', 1) AS value
FROM (SELECT page_id,
             list_filter(string_split(regexp_extract(url, '\\?([^#]*)', 1), '&'),
                         lambda x: x <> '') AS ps
      FROM pages)
""")
def url_query_params(spark, sf_dir):
    """One row per query-string parameter of each page URL."""
    p = captures.pages(spark, sf_dir)
    kv = p.select("page_id", F.posexplode(U.query_params(F.col("url"))).alias("pos", "kv"))
    return kv.select("page_id", "pos", F.col("kv.key").alias("key"), F.col("kv.value").alias("value"))


@plan("capture_status_filter", oracle="""
SELECT p.page_id, p.url, 200 AS status,
       NOT contains(lower(CASE WHEN e.event_type = 'view' THEN 'application/xml'
                               ELSE 'text/html; charset=utf-8' END), 'xml') AS content_type_warning
FROM pages p LEFT JOIN events e ON e.event_id = p.page_id
WHERE coalesce(e.event_type, '') NOT IN ('error', 'signup')
""")
def capture_status_filter(spark, sf_dir):
    """Keep OK responses; flag bodies not served as XML."""
    c = captures.page_captures(spark, sf_dir)
    return c.filter(F.col("status") == 200).select(
        "page_id", "url", "status",
        (~F.lower("content_type").contains("xml")).alias("content_type_warning"))
