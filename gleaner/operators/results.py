"""Search result pages -> result records.

Each page is parsed once into a tree, in one Arrow UDF that returns the winning
selector of the cascade, its elements' link, title and description (H12), and
the bare project links for the pages where no selector finds anything (H13).
Everything after that is column expressions.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.fixed_values import (
    DOWNLOAD_ELEMENTS_SHOWN,
    DOWNLOAD_TEXT_CUT,
    FALLBACK_RELEVANCE,
    FALLBACK_TITLE,
    PAGE_SIZE,
    RESULT_SELECTOR_NAMES,
)
from gleaner.functions import dom
from gleaner.functions import urls as U

# The result-container selectors (names fixed in gleaner.fixed_values), in
# cascade order, each with its test of an element.
RESULT_SELECTORS = list(zip(RESULT_SELECTOR_NAMES, [
    dom.has_class("result"),
    lambda e: e.attrs.get("data-testid") == "result-item",
    dom.has_class("search-result"),
    lambda e: e.tag == "div" and "result" in e.attrs.get("class", ""),
    lambda e: e.tag == "article",
    dom.has_class("project-item"),
]))


def _anchor(e: dom.Element) -> bool:
    return e.tag == "a"


def _project_anchor(e: dom.Element) -> bool:
    return e.tag == "a" and "/project/id/" in e.attrs.get("href", "")


# Where a result's link is looked for, in this order.
LINK_TESTS = [
    _project_anchor,
    lambda e: _anchor(e) and e.inside(dom.has_class("title")),
    lambda e: _anchor(e) and e.inside(dom.has_class("result-title")),
    lambda e: _anchor(e) and e.inside(lambda up: up.tag == "h3"),
    lambda e: _anchor(e) and e.inside(lambda up: up.tag == "h2"),
]
_DESCRIPTION = dom.has_class("description", "summary", "teaser")
MAX_RESULTS = PAGE_SIZE


def _result(element: dom.Element) -> dict[str, str | None]:
    link = next((a for test in LINK_TESTS if (a := element.first(test)) is not None), None)
    described = element.first(_DESCRIPTION)
    return {"href": None if link is None else link.attrs.get("href", ""), "title": "" if link is None else link.shown(),
            "description": "" if described is None else described.shown()}


_ELEMENT = T.StructType().add("href", T.StringType()).add("title", T.StringType()).add("description", T.StringType())
_LINK = T.StructType().add("href", T.StringType()).add("text", T.StringType())


@F.pandas_udf(T.StructType().add("selector", T.StringType()).add("elements", T.ArrayType(_ELEMENT)).add("links", T.ArrayType(_LINK)))
def page_results(html: pd.Series) -> pd.DataFrame:
    """The winning selector (null: none), what its elements hold, and the page's bare project links."""
    rows = []
    for text in html:
        page = dom.parse(text)
        name, found = next(((n, f) for n, test in RESULT_SELECTORS if (f := page.every(test))), (None, []))
        links = [] if found else page.every(_project_anchor)
        rows.append((name, [_result(e) for e in found], [{"href": a.attrs["href"], "text": a.shown()} for a in links]))
    return pd.DataFrame(rows, columns=["selector", "elements", "links"])


def parse_results(pages: DataFrame, max_results: int = MAX_RESULTS) -> DataFrame:
    """H12 + A6/A7 + H8-H10: one row per kept result among the first ``max_results`` of the main branch."""
    p = pages.select("page_id", "url", page_results("html").alias("r"))
    e = p.select("page_id", "url", F.col("r.selector").alias("selector"),
                 F.posexplode(F.slice("r.elements", 1, max_results)).alias("pos", "e"))
    href = U.resolve_href(F.col("e.href"), F.col("url"))
    r = e.select("page_id", "selector", "pos", href.alias("href"), U.project_id(href).alias("id"),
                 F.col("e.title").alias("title"), F.col("e.description").alias("description"))
    kept = r.filter(F.col("id").isNotNull() & ~U.is_subpage(F.col("href")))
    return kept.select(
        "page_id", "selector", "pos", "id", U.normalize_project_url(F.col("href")).alias("url"), "title",
        "description",
        F.greatest(F.round((F.lit(10) - F.col("pos")) / F.lit(10.0), 1), F.lit(0.1)).alias("relevance_score"))


def fallback_results(pages: DataFrame, max_results: int = MAX_RESULTS) -> DataFrame:
    """Pages where no selector found a result: of the first
    ``max_results`` project links those with a numeric id, title or 'Unknown
    Title', relevance 0.5, URL not normalized and sub-pages not dropped."""
    p = pages.select("page_id", "url", page_results("html")["links"].alias("links"))
    e = p.select("page_id", "url", F.posexplode(F.slice("links", 1, max_results)).alias("at", "a"))
    href = U.resolve_href(F.col("a.href"), F.col("url"))
    r = e.select("page_id", "at", href.alias("url"), U.project_id(href).alias("id"),
                 F.when(F.col("a.text") == "", F.lit(FALLBACK_TITLE)).otherwise(F.col("a.text")).alias("title"))
    w = F.row_number().over(Window.partitionBy("page_id").orderBy("at"))
    return (r.filter(F.col("id").isNotNull())
            .select("page_id", (w - 1).alias("pos"), "id", "url", "title", F.lit(FALLBACK_RELEVANCE).alias("relevance_score")))


def _own_text(e: dom.Element) -> str:
    """The first text directly inside the element, as XPath's text() gives it to contains()."""
    return next((p for p in e.parts if isinstance(p, str)), "")


def _links(found: list[dom.Element]) -> list[dict[str, str | None]]:
    return [{"tag": "a", "href": a.attrs.get("href"), "text": a.shown()} for a in found]


_PROBE = T.ArrayType(T.StructType().add("tag", T.StringType()).add("href", T.StringType()).add("text", T.StringType()))
_PROBES = ("xml_link", "download_element", "section_link")


@F.pandas_udf(T.StructType([T.StructField(kind, _PROBE) for kind in _PROBES]))
def page_downloads(html: pd.Series) -> pd.DataFrame:
    """What each download probe finds on a page, in document order."""
    rows = []
    for text in html:
        page = dom.parse(text)
        xml = page.every(lambda e: e.tag == "a" and ("XML" in _own_text(e) or "xml" in e.attrs.get("href", "")))
        named = page.every(lambda e: "Download" in _own_text(e) or "download" in _own_text(e))[:DOWNLOAD_ELEMENTS_SHOWN]
        heading = page.first(lambda e: e.tag == "h2" and "Download" in _own_text(e))
        rows.append((_links(xml), [{"tag": e.tag, "href": None, "text": e.shown()} for e in named],
                     _links(heading.parent.every(_anchor)) if heading is not None else []))
    return pd.DataFrame(rows, columns=_PROBES)


def download_probes(pages: DataFrame) -> DataFrame:
    """(page_id, kind, pos, tag, text, href) for links to XML by their text or
    address, the first five elements that speak of a download (text cut to 50 +
    '...'), and the links beside the first 'Download' heading."""
    found = pages.select("page_id", "url", page_downloads("html").alias("d"))
    kinds = F.array(*(F.struct(F.lit(k).alias("kind"), F.col("d")[k].alias("hits")) for k in _PROBES))
    hits = (found.select("page_id", "url", F.inline(kinds)).select("page_id", "url", "kind", F.posexplode("hits").alias("pos", "h")))
    text = F.col("h.text")
    cut = F.when((F.col("kind") == "download_element") & (F.length(text) > DOWNLOAD_TEXT_CUT),
                 F.concat(F.substring(text, 1, DOWNLOAD_TEXT_CUT), F.lit("..."))).otherwise(text)
    return hits.select("page_id", "kind", "pos", "h.tag", cut.alias("text"), U.resolve_href(F.col("h.href"), F.col("url")).alias("href"))
