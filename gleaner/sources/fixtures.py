"""Derived inputs: catalogs, query lists, HTML and XML built from the tables.

The original tool reads captures of remote sites.  These builders derive
equivalent captures from the driver tables with column expressions only, so
every plan's work grows with the tables and an oracle can recompute the
expected answer from the same source columns.  Each builder is a narrow map
(no shuffle) unless its docstring says otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.fixed_values import LISTING_BASE_URL, SEARCH_URL_PREFIX
from gleaner.functions import text as TX
from gleaner.sources.tables import read_table, spread


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Project catalog from ``documents``: id, title (first sentence of the
    first line), description (the rest of the text), language."""
    d = spread(read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    raw_title = TX.catalog_title(F.col("text"))
    return d.select(
        F.col("doc_id").cast("string").alias("project_id"),
        "doc_id",
        TX.py_strip(raw_title).alias("title"),
        F.substring(F.col("text"), F.length(raw_title) + 1, F.lit(2**31 - 1)).alias("description"),
        "lang",
    )


def project_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One free-text query per catalog entry, in four classes by language:
    en = the exact title, fr = its acronym (the title when it has none),
    de = the title without its last word, es = the title lower-cased."""
    c = catalog(spark, sf_dir)
    t = F.col("title")
    dropped = F.regexp_replace(t, "\\s*\\S+\\s*$", "")
    q = (F.when(F.col("lang") == "fr", F.coalesce(TX.extract_acronym(t), t))
         .when(F.col("lang") == "de", F.when(dropped == "", t).otherwise(dropped))
         .when(F.col("lang") == "es", F.lower(t))
         .otherwise(t))
    return c.select(F.col("doc_id").alias("query_no"), q.alias("query"),
                    F.col("project_id").alias("source_id"))


def misspelt_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every catalog title with its longer words misspelt: a word of five or more letters a-z loses its third one."""
    c = catalog(spark, sf_dir)
    return c.select(F.col("doc_id").alias("query_no"), F.regexp_replace("title", "([A-Za-z]{2})[a-z]([a-z]{2,})", "$1$2").alias("query"))


def _dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation x region: fixed-size dimension tables (25 x 5 rows at every
    scale), so broadcasting them is bounded by construction."""
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey).select(
        "n_nationkey", "n_name", "r_name")


def _div_pair(label: str, value: Column) -> Column:
    return F.concat(F.lit(f'<div><span class="name">{label}</span><span class="value">'),
                    value, F.lit("</span></div>"))


def record_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Project record pages built from ``supplier`` joined to its nation and
    region.  Optional parts depend on the row: a title only for
    non-negative balances; a second applicant above 5000; a second
    institution for even nation keys; a project-number override below 1000.
    Every page repeats the 'Fach' label (last wins), carries a label with
    two colons, a label without value, a box of nested children, and (every
fifth page) a description of some 18,000 characters."""
    s = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    d = _dims(spark, sf_dir)
    j = s.join(F.broadcast(d), s.s_nationkey == d.n_nationkey, "left")
    name, nation, region = F.col("s_name"), F.coalesce("n_name", F.lit("")), F.coalesce("r_name", F.lit(""))
    key = F.col("s_suppkey").cast("string")
    opt = lambda cond, html: F.when(cond, html).otherwise(F.lit(""))
    html = F.concat(
        F.lit("<!DOCTYPE html><html><head><title>GEPRIS</title></head><body>"),
        F.lit('<div class="details">'),
        opt(F.col("s_acctbal") >= 0,
            F.concat(F.lit('<h1 class="facelift">'), name, F.lit("<br>"), nation, F.lit("</h1>"))),
        F.lit('<div class="firstUnderAntragsbeteiligte"><span class="name">Antragsteller:</span>'
              '<span class="value">'), name, F.lit("</span></div>"),
        opt(F.col("s_acctbal") > 5000, _div_pair("Antragstellerin:", F.concat(F.lit("Dr. "), nation))),
        _div_pair("Beteiligte Institution:", F.concat(F.lit("Uni <b>"), nation, F.lit("</b>"))),
        opt(F.pmod(F.col("s_nationkey"), F.lit(2)) == 0,
            _div_pair("Antragstellende Institution:", F.concat(region, F.lit(" &amp; Co")))),
        F.lit('<div class="projektnummer"><span class="name">Projektnummer:</span><span class="value">'),
        key, F.lit("</span></div>"),
        F.lit('<div><span class="name">Kontostand:</span></div>'),
        F.lit("<DIV class='box'><div><div><span>leer</span></div><!-- </div></div> --></div></DIV>"),
        F.lit("</div>"),
        F.lit("<div id='projekttext'><div>Lieferant <i>"), key, F.lit("</i></div> aus "), nation,
        F.when(F.pmod(F.col("s_suppkey"), F.lit(5)) == 0, F.repeat(F.lit(" und mehr"), 2000)).otherwise(F.lit("")), F.lit("</div>"),
        F.lit('<div id="projektbeschreibung">'),
        _div_pair("Fach:", region),
        _div_pair("Fach:", nation),
        _div_pair("Land::", F.concat(F.lit(" "), nation, F.lit(" "))),
        opt(F.col("s_acctbal") < 1000, _div_pair("Projektnummer:", F.concat(F.lit("X-"), key))),
        F.lit("</div></body></html>"),
    )
    return j.select(F.col("s_suppkey").alias("doc_id"), html.alias("html"))


# Addresses of the order/part link graph.
SHOP_BASE = "https://shop.example"


def link_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(src, dst) links between order and part pages from ``lineitem``: an
    order page links to its parts and a part page to its orders."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    order_url = F.concat(F.lit(SHOP_BASE + "/order/"), F.col("l_orderkey").cast("string"))
    part_url = F.concat(F.lit(SHOP_BASE + "/part/"), F.col("l_partkey").cast("string"))
    return (li.select(order_url.alias("src"), part_url.alias("dst"))
            .unionByName(li.select(part_url.alias("src"), order_url.alias("dst"))))


def crawl_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The seed list -- the pages of the orders placed on the first
    order date.  The date is a one-row aggregate, joined by broadcast."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    first = o.agg(F.min("o_orderdate").alias("o_orderdate"))
    seeds = o.join(F.broadcast(first), "o_orderdate")
    return seeds.select(F.concat(F.lit(SHOP_BASE + "/order/"), F.col("o_orderkey").cast("string")).alias("url"))


def ordered_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(src, dst, place): the link graph with the links' places: an order's by line, a part's by order and line."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    order_url = F.concat(F.lit(SHOP_BASE + "/order/"), F.col("l_orderkey").cast("string"))
    part_url = F.concat(F.lit(SHOP_BASE + "/part/"), F.col("l_partkey").cast("string"))
    line = F.col("l_linenumber").cast("long")
    return (li.select(order_url.alias("src"), part_url.alias("dst"), line.alias("place"))
            .unionByName(li.select(part_url.alias("src"), order_url.alias("dst"), (F.col("l_orderkey") * 8 + line).alias("place"))))


def ordered_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(url, place): the seed list by order key."""
    url = F.col("url")
    return crawl_seeds(spark, sf_dir).select("url", F.regexp_extract(url, "([0-9]+)$", 1).cast("long").alias("place"))


LISTING_PAGE_SIZE = 10
LISTING_PATH = "/gepris/OCTOPUS?task=doKatalog&context=projekt&page="


def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalog listing pages from ``part``: page n lists parts
    [10(n-1), 10n) by key (a bounded group of 10), alternating entry
    classes; large parts link absolutely, the rest relatively.  Every page
    but the last links to the next one.  (page_no, url, html)."""
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    page_no = (F.floor(F.col("p_partkey") / LISTING_PAGE_SIZE) + 1).cast("int")
    href = F.concat(F.when(F.col("p_size") > 40, F.lit(LISTING_BASE_URL)).otherwise(F.lit("")),
                    F.lit("/gepris/projekt/"), F.col("p_partkey").cast("string"))
    cls = F.when(F.pmod(F.col("p_partkey"), F.lit(2)) == 0, F.lit("eintrag")).otherwise(F.lit("eintrag_alternate"))
    entry = F.concat(F.lit('<div class="'), cls, F.lit('"><span>Projekt</span><h2><b><a title="" href="'), href,
                     F.when(F.pmod(F.col("p_partkey"), F.lit(3)) == 0, F.lit("?a=1&amp;b=2")).otherwise(F.lit("")), F.lit('">'),
                     F.col("p_name"), F.lit("</a></b></h2><p>Size "), F.col("p_size").cast("string"),
                     F.lit("</p></div>"))
    entries = (p.select(page_no.alias("page_no"), F.col("p_partkey"), entry.alias("entry"))
               .groupBy("page_no")
               .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", "entry"))),
                                             lambda s: s["entry"]), "").alias("body")))
    nxt = entries.select((F.col("page_no") - 1).alias("page_no"), F.lit(True).alias("has_next"))
    pages = entries.join(nxt, "page_no", "left")
    url = F.concat(F.lit(LISTING_BASE_URL + LISTING_PATH), F.col("page_no").cast("string"))
    next_link = F.when(F.col("has_next"), F.concat(
        F.when(F.pmod(F.col("page_no"), F.lit(2)) == 0, F.lit('<div class="listennaviright"><span><a class="nextactive" href="'))
        .otherwise(F.lit('<div class="navi listennaviright"><a href="')), F.lit(LISTING_PATH.replace("&", "&amp;")),
        (F.col("page_no") + 1).cast("string"),
        F.when(F.pmod(F.col("page_no"), F.lit(2)) == 0, F.lit('">weiter</a></span></div>'))
        .otherwise(F.lit('" title="x" class="button nextactive">weiter</a></div>')))).otherwise(F.lit(""))
    html = F.concat(F.lit('<html><body><div class="results">'), F.col("body"), F.lit("</div>"),
                    next_link, F.lit("</body></html>"))
    return pages.select("page_no", url.alias("url"), html.alias("html"))


RESULTS_PER_PAGE = 10


def _result_href(k: Column) -> Column:
    """Result link variants by order priority; status P links to no project."""
    pr = F.col("o_orderpriority")
    base = F.concat(F.lit("/project/id/"), k)
    return (F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("/search/related?order="), k))
            .when(pr == "1-URGENT", F.concat(base, F.lit("/en")))
            .when(pr == "2-HIGH", F.concat(base, F.lit("/reporting")))
            .when(pr == "3-MEDIUM", F.concat(base, F.lit("/factsheet")))
            .when(pr == "4-NOT SPECIFIED", F.concat(base, F.lit("/results")))
            .otherwise(base))


def search_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search result pages from ``orders``: page p lists orders [10p, 10p+10)
    (a bounded group).  The markup variant is p mod 4: <li class="result">,
    <section data-testid="result-item">, <article>, or bare links (no result
    containers: the fallback path).  Link text is empty for status O;
    descriptions: class "description" (F), "summary" (O), none (P).  Each
    page ends with a Download section that names its first order; on every fourth
    page its markup is upper case, single-quoted, nested and holds a commented link.
    (page_id, url, html)."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    page = F.floor(F.col("o_orderkey") / RESULTS_PER_PAGE).cast("bigint")
    variant = F.pmod(page, F.lit(4))
    k = F.col("o_orderkey").cast("string")
    text = F.when(F.col("o_orderstatus") == "O", F.lit("")).otherwise(F.concat(F.lit("Order <b>"), k, F.lit("</b>")))
    anchor = F.concat(F.lit('<a href="'), _result_href(k), F.lit('">'), text, F.lit("</a>"))
    st = F.col("o_orderstatus")
    desc = (F.when(st == "F", F.concat(F.lit('<p class="description">Total '), k, F.lit("</p>")))
            .when(st == "O", F.concat(F.lit('<p class="summary">Summary '), k, F.lit("</p>")))
            .otherwise(F.lit("")))
    item = (F.when(variant == 0, F.concat(F.lit('<li class="result"><ul><li>no link</li></ul><h3>'), anchor, F.lit("</h3>"), desc,
                                          F.lit("</li>")))
            .when(variant == 1, F.concat(F.lit("<SECTION data-testid='result-item'><section>x</section><!-- <a href='/project/id/0'> --><div class=title>"),
                                         anchor, F.lit("</div>"), desc, F.lit("</section>")))
            .when(variant == 2, F.concat(F.lit("<article><h2>"), anchor, F.lit("</h2>"), desc,
                                         F.lit("</article>")))
            .otherwise(F.concat(F.lit("<p>"), anchor, F.lit("</p>"))))
    items = (o.select(page.alias("page_id"), "o_orderkey", "o_orderpriority", item.alias("item"))
             .groupBy("page_id")
             .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", "item"))),
                                           lambda s: s["item"]), "").alias("body"),
                  F.min(F.struct("o_orderkey", "o_orderpriority")).alias("first")))
    pid = F.col("page_id").cast("string")
    pdf = F.concat(F.lit("Download order "), F.col("first.o_orderkey").cast("string"), F.lit(" <i>("), F.col("first.o_orderpriority"),
                   F.lit(")</i> and the rest of page "), pid)
    plain = F.concat(F.lit('<h2>Download</h2><a href="/project/id/'), pid, F.lit('?format=xml">XML</a> <a href="/project/id/'), pid,
                     F.lit('?format=pdf">'), pdf, F.lit("</a>"))
    other = F.concat(F.lit("<H2 id='d'>Download</H2><!-- <a href='/hidden.xml'>XML</a> --><div><div>as</div><A HREF='/project/id/"), pid,
                     F.lit("?lang=en&amp;format=xml'>file</A></div><a class=x href=/project/id/"), pid, F.lit("?format=pdf>"), pdf, F.lit("</a>"))
    download = F.concat(F.lit('<div class="download">'), F.when(F.pmod("page_id", F.lit(4)) == 1, other).otherwise(plain), F.lit("</div>"))
    url = F.concat(F.lit(SEARCH_URL_PREFIX + "orders+"), pid, F.lit("&p=1&num=10"))
    html = F.concat(F.lit('<html><body><div id="search"><ul class="results-list">'), F.col("body"),
                    F.lit("</ul></div>"), download, F.lit("</body></html>"))
    return items.select("page_id", url.alias("url"), html.alias("html"))
