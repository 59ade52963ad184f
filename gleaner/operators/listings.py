"""Catalog listing pages -> project links and the next page (H6, H7)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.functions import dom

_ENTRY = dom.has_class("eintrag", "eintrag_alternate", tag="div")
_NAVIGATION = dom.has_class("listennaviright", tag="div")


def _entry_link(e: dom.Element) -> bool:
    return e.tag == "a" and bool(e.attrs.get("href")) and e.inside(lambda up: up.tag == "h2" and up.inside(_ENTRY))


def _next_link(e: dom.Element) -> bool:
    return e.tag == "a" and "nextactive" in e.classes and e.inside(_NAVIGATION)


@F.pandas_udf(T.StructType().add("hrefs", T.ArrayType(T.StringType())).add("next", T.StringType()))
def listing(html: pd.Series) -> pd.DataFrame:
    """The entries' link targets in page order, and that of the next page (null: there is none)."""
    rows = []
    for text in html:
        page = dom.parse(text)
        following = page.first(_next_link)
        rows.append(([a.attrs["href"] for a in page.every(_entry_link)], following.attrs.get("href") or None if following else None))
    return pd.DataFrame(rows, columns=["hrefs", "next"])
