"""XML facts (X1-X5, X8): one parse per document, rules in Spark.

Spark's ``xpath*`` re-parses the document per call, reads it without
namespaces, and throws on malformed input (there is no non-throwing form),
while ``from_xml`` accepts trailing content after the root.  So each
document is parsed exactly once, Arrow-batched, by ElementTree -- the parser
whose semantics the validation rules are written against -- and reduced to
plain facts.  Every verdict is then a Spark expression over those facts.
"""

from __future__ import annotations

import xml.etree.ElementTree as ET

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.fixed_values import ESSENTIAL_FIELDS, METADATA_FIELDS  # noqa: E402

_FLAT_TYPE = T.StructType([
    T.StructField("wellformed", T.BooleanType()),
    T.StructField("root", T.StringType()),          # local name
    T.StructField("namespace", T.StringType()),     # null when none
    T.StructField("has_id", T.BooleanType()),       # some element named id
    T.StructField("id_text", T.StringType()),       # first id's .text, stripped; null if no text
    *[T.StructField("f_" + f, T.StringType()) for f in METADATA_FIELDS],
])

_WANTED = set(METADATA_FIELDS)


def _local(tag: str) -> tuple[str | None, str]:
    if tag.startswith("{"):
        ns, _, name = tag[1:].partition("}")
        return ns, name
    return None, tag


def document_facts(doc: str | None) -> dict | None:
    """Plain-Python facts of one document (also used by the tests)."""
    if doc is None:
        return None
    try:
        root = ET.fromstring(doc)
    except ET.ParseError:
        return {"wellformed": False, "root": None, "namespace": None, "has_id": False,
                "id_text": None, "fields": None}
    ns, name = _local(root.tag)
    has_id, id_text = False, None
    found: dict[str, str] = {}
    for el in root.iter():
        if not isinstance(el.tag, str):
            continue
        local = _local(el.tag)[1]
        if local == "id" and not has_id:
            has_id = True
            id_text = el.text.strip() if el.text is not None else None
        if local in _WANTED and local not in found and el.text and el.text.strip():
            found[local] = el.text.strip()
    return {"wellformed": True, "root": name, "namespace": ns, "has_id": has_id,
            "id_text": id_text, "fields": {f: found.get(f) for f in METADATA_FIELDS}}


_FLAT_NAMES = [f.name for f in _FLAT_TYPE.fields]


@F.pandas_udf(_FLAT_TYPE)
def _xml_facts_flat(docs: pd.Series) -> pd.DataFrame:
    cols: dict[str, list] = {n: [] for n in _FLAT_NAMES}
    for d in docs:
        f = document_facts(d)
        if f is None:
            for n in _FLAT_NAMES:
                cols[n].append(None)
            continue
        for n in ("wellformed", "root", "namespace", "has_id", "id_text"):
            cols[n].append(f[n])
        fields = f["fields"] or {}
        for m in METADATA_FIELDS:
            cols["f_" + m].append(fields.get(m))
    return pd.DataFrame(cols, columns=_FLAT_NAMES)


def xml_facts_flat(doc: Column) -> Column:
    """The flat facts of one parse (project it into a column of its own)."""
    return _xml_facts_flat(doc)


def facts_struct(flat: Column) -> Column:
    """struct<wellformed, root, namespace, has_id, id_text, fields struct<...>>
    over a projected flat-facts column; the struct is built in the JVM."""
    return F.struct(
        flat["wellformed"].alias("wellformed"), flat["root"].alias("root"),
        flat["namespace"].alias("namespace"), flat["has_id"].alias("has_id"),
        flat["id_text"].alias("id_text"),
        F.struct(*[flat["f_" + m].alias(m) for m in METADATA_FIELDS]).alias("fields"))
