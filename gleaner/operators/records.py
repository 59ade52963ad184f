"""Label/value records from project pages -> one wide table.

Per page: the label/value pairs of the child <div>s of ``div.details`` and
of ``div#projektbeschreibung`` plus two singleton fields, resolved last-wins,
synonym fields combined.  All of it is row-local (no shuffle); the page is parsed
once per row, into a tree, so nesting, quoting and length do not matter.  The only
cross-row step is key discovery for the wide schema: a distinct over keys
(partially aggregated per task), whose size is checked before it reaches
the driver.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.fixed_values import (
    APPLICANT_FIELD,
    APPLICANT_SOURCES,
    INSTITUTION_FIELD,
    INSTITUTION_SOURCES,
    TEXT_FIELD,
    TITLE_FIELD,
)
from gleaner.functions import dom
from gleaner.session import materialize

_DETAILS, _TITLE = dom.has_class("details", tag="div"), dom.has_class("facelift", tag="h1")
_NAME, _VALUE = dom.has_class("name", tag="span"), dom.has_class("value", tag="span")


def _labelled(children: list[dom.Element]) -> list[dict[str, str]]:
    found = ((child.first(_NAME), child.first(_VALUE)) for child in children)
    return [{"key": name.text("").replace(":", ""), "value": value.text(" ")} for name, value in found if name and value]


def pairs_of(html: str | None) -> list[dict[str, str]] | None:
    """The pairs of one page in write order; null for a null page."""
    if html is None:
        return None
    page = dom.parse(html)
    title = page.first(lambda e: _TITLE(e) and e.inside(_DETAILS))
    text = page.first(lambda e: e.tag == "div" and e.attrs.get("id") == "projekttext")
    details = page.every(lambda e: e.tag == "div" and e.parent is not None and _DETAILS(e.parent))
    described = page.every(lambda e: e.tag == "div" and e.parent is not None and e.parent.tag == "div"
                           and e.parent.attrs.get("id") == "projektbeschreibung")
    return ([{"key": TITLE_FIELD, "value": title.text("")}] if title else []) + _labelled(details) \
        + ([{"key": TEXT_FIELD, "value": text.text(" ")}] if text else []) + _labelled(described)


@F.pandas_udf(T.ArrayType(T.StructType().add("key", T.StringType()).add("value", T.StringType())))
def record_pairs(html: pd.Series) -> pd.Series:
    """R1+R2: array<struct<key,value>> in write order: title, details pairs,
    description text, description-block pairs."""
    return html.map(pairs_of)


def last_wins(pairs: Column) -> Column:
    """Drop every pair whose key is written again later."""
    return F.filter(pairs, lambda p, i: ~F.exists(
        F.slice(pairs, i + 2, F.greatest(F.size(pairs) - i - 1, F.lit(1))),
        lambda later: later["key"] == p["key"]) | (i == F.size(pairs) - 1))


def _combined(fields: Column, sources: list[str]) -> Column:
    vals = F.array(*[fields[k] for k in sources])
    nonempty = F.filter(vals, lambda v: v.isNotNull() & (v != ""))
    return F.array_join(F.array_sort(F.array_distinct(nonempty)), " ; ")


def combine_fields(fields: Column) -> Column:
    """Merge applicant and institution synonyms into one field each."""
    dropped = set(APPLICANT_SOURCES) | set(INSTITUTION_SOURCES)
    rest = F.map_filter(fields, lambda k, v: ~k.isin(*dropped))
    extra = F.create_map(F.lit(APPLICANT_FIELD), _combined(fields, APPLICANT_SOURCES),
                         F.lit(INSTITUTION_FIELD), _combined(fields, INSTITUTION_SOURCES))
    return F.map_concat(rest, extra)


def parse_records(pages: DataFrame, id_col: str = "doc_id", html_col: str = "html") -> DataFrame:
    """(id, fields map<string,string>) with R1-R4 applied."""
    pairs = pages.select(id_col, record_pairs(html_col).alias("pairs"))
    fields = pairs.select(id_col, F.map_from_entries(last_wins(F.col("pairs"))).alias("m"))
    return fields.select(id_col, combine_fields(F.col("m")).alias("fields"))


def key_universe(records: DataFrame) -> DataFrame:
    """Each key with the number of records holding it."""
    return (records.select(F.explode(F.map_keys("fields")).alias("key"))
            .groupBy("key").agg(F.count(F.lit(1)).alias("n_records")))


def long_form(records: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, key, value): the same table without a column per key, for key sets of any size."""
    return records.select(id_col, F.explode("fields").alias("key", "value"))


def discover_keys(records: DataFrame, max_keys: int = 10_000) -> list[str]:
    """The sorted key set, needed as the wide table's schema.

    A table cannot have columns without bound: beyond ``max_keys`` (Spark's
    own pivot limit) this refuses, and ``long_form`` is the answer.
    """
    keys = key_universe(records).select("key").orderBy("key").limit(max_keys + 1).collect()
    if len(keys) > max_keys:
        raise ValueError(f"more than {max_keys} distinct record keys: use long_form")
    return [r.key for r in keys]


def widen(records: DataFrame, id_col: str = "doc_id", keys: list[str] | None = None) -> DataFrame:
    """One column per key (sorted), '' where a record lacks it.  A map
    lookup per key: no pivot, no shuffle.  When the keys must be discovered
    first, the parsed records are materialized once and read twice."""
    if keys is None:
        records = materialize(records)
        keys = discover_keys(records)
    return records.select(id_col, *[F.coalesce(F.col("fields")[k], F.lit("")).alias(k) for k in keys])


def write_wide_csv(wide: DataFrame, path: str) -> None:
    """K4: header row, ',' delimiter, minimal quoting, UTF-8 (no BOM: Spark
    writes none; a directory of part files)."""
    (wide.write.mode("overwrite").option("header", True)
     .option("quote", '"').option("escape", '"').option("encoding", "UTF-8").csv(path))
