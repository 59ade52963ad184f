"""URL column functions.

All built-in expressions; URL parts come from regexes rather than
``parse_url`` so that a malformed URL yields '' instead of an error.
"""

from __future__ import annotations

from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.fixed_values import (  # noqa: F401 (re-exported)
    LISTING_BASE_URL,
    PROJECT_BASE_URL,
    SEARCH_URL_PREFIX,
    SEARCH_URL_SUFFIX,
    SUBPAGE_MARKERS,
    XML_URL_SUFFIX,
)

SCHEME_RE = "^([A-Za-z][A-Za-z0-9+.-]*):"
AUTHORITY_RE = "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)"
PROJECT_ID_RE = "/project/id/(\\d+)"
LANG_SUFFIX_RE = "/project/id/(\\d+)/[a-z]{2}$"


def url_md5(url: Column) -> Column:
    """H4: hex md5 of the UTF-8 bytes of the URL."""
    return F.md5(url)


def capture_file_name(depth: Column, url: Column) -> Column:
    """H5: '{depth}_{md5}.html'."""
    return F.concat_ws("_", depth.cast("string"), F.concat(url_md5(url), F.lit(".html")))


def listing_file_name(page_no: Column, pos: Column, url: Column) -> Column:
    """H5: 'page{n}_proj{i}_{md5}.html', i zero-based."""
    return F.concat(F.lit("page"), page_no.cast("string"), F.lit("_proj"), pos.cast("string"),
                    F.lit("_"), url_md5(url), F.lit(".html"))


def text_file_name(file_name: Column) -> Column:
    """K3: the capture's base name with '.md'."""
    return F.regexp_replace(file_name, "\\.html$", ".md")


def prefix_base(href: Column, base: str = LISTING_BASE_URL) -> Column:
    """H3(a): prefix the site base unless the href already starts with 'http'."""
    return F.when(href.startswith("http"), href).otherwise(F.concat(F.lit(base), href))


@F.pandas_udf(T.StringType())
def _joined(href: pd.Series, page_url: pd.Series) -> pd.Series:
    def one(h: str | None, u: str | None) -> str | None:
        if h is None or u is None:
            return None
        try:
            return urljoin(u, h)
        except ValueError:  # not a URL
            return h
    return pd.Series([one(h, u) for h, u in zip(href, page_url)], dtype=object)


def resolve_href(href: Column, page_url: Column) -> Column:
    """H3(b): absolute form of an href as a browser's href property gives it.

    Scheme-qualified hrefs (http:, mailto:, javascript:) stay as they are;
    '//h/p' takes the page scheme; '/p' the page scheme and authority; '#f'
    and '?q' replace the page's fragment / query; other relative paths
    resolve against the page directory.  White space around the href is cut.  Dot
    segments, and pages without a path, are rare; those rows are resolved
    by the standard library (RFC 3986), all others in the JVM.
    """
    href = F.trim(href)
    scheme = F.regexp_extract(page_url, SCHEME_RE, 1)
    authority = F.regexp_extract(page_url, AUTHORITY_RE, 1)
    no_frag = F.regexp_replace(page_url, "#.*$", "")
    no_query = F.regexp_replace(no_frag, "\\?.*$", "")
    directory = F.regexp_replace(no_query, "/[^/]*$", "/")
    rare = ~href.rlike(SCHEME_RE) & (href != "") & (
        F.concat(F.lit("/"), href).rlike("/\\.{1,2}(?:[/?#]|$)") | ~page_url.rlike("^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/"))
    return F.coalesce(_joined(F.when(rare, href), F.when(rare, page_url)), (
        F.when(href.rlike(SCHEME_RE), href)
        .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
        .when(href.startswith("/"), F.concat(scheme, F.lit("://"), authority, href))
        .when(href.startswith("#"), F.concat(no_frag, href))
        .when(href.startswith("?"), F.concat(no_query, href))
        .otherwise(F.concat(directory, href))
    ))


def query_string(url: Column) -> Column:
    """The part after '?' up to '#', '' when none."""
    return F.regexp_extract(url, "\\?([^#]*)", 1)


def query_params(url: Column) -> Column:
    """array<struct<key,value>> of the query string, order and duplicates kept."""
    pairs = F.filter(F.split(query_string(url), "&"), lambda p: p != "")
    return F.transform(
        pairs,
        lambda p: F.struct(
            F.regexp_extract(p, "^([^=]*)", 1).alias("key"),
            F.regexp_extract(p, "^[^=]*=?(.*)$", 1).alias("value"),
        ),
    )


def project_id(href: Column) -> Column:
    """H8: first '/project/id/<digits>' id; null when there is none."""
    return F.nullif(F.regexp_extract(href, PROJECT_ID_RE, 1), F.lit(""))


def is_subpage(href: Column) -> Column:
    """H9: report and factsheet pages are not project main pages."""
    hit = href.contains(SUBPAGE_MARKERS[0])
    for marker in SUBPAGE_MARKERS[1:]:
        hit = hit | href.contains(marker)
    return hit


def normalize_project_url(href: Column) -> Column:
    """Drop a two-letter language segment right after the id."""
    return F.regexp_replace(href, LANG_SUFFIX_RE, "/project/id/$1")


def quote_plus(s: Column) -> Column:
    """Python's urllib.parse.quote_plus: space -> '+', keep [A-Za-z0-9_.~-]."""
    enc = F.url_encode(s)  # java URLEncoder: keeps '*', encodes '~'
    return F.replace(F.replace(enc, F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def search_url(query: Column) -> Column:
    """The search request for a free-text query."""
    return F.concat(F.lit(SEARCH_URL_PREFIX), quote_plus(query), F.lit(SEARCH_URL_SUFFIX))


def project_xml_url(pid: Column) -> Column:
    """The XML record address of a project id."""
    return F.concat(F.lit(PROJECT_BASE_URL), pid, F.lit(XML_URL_SUFFIX))
