"""Plans over project record pages built from supplier rows.

Oracles are round trips: DuckDB derives the expected fields straight from
``supplier``/``nation``/``region``; Spark must recover them from the HTML.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from gleaner.operators import records as R
from gleaner.plans.registry import plan
from gleaner.sources import fixtures

_BASE = """
SELECT s.s_suppkey AS doc_id, s.s_name, s.s_acctbal, s.s_nationkey,
       coalesce(d.n_name, '') AS nation, coalesce(d.r_name, '') AS region,
       CAST(s.s_suppkey AS VARCHAR) AS k
FROM supplier s LEFT JOIN (SELECT n_nationkey, n_name, r_name FROM nation
                           JOIN region ON r_regionkey = n_regionkey) d
  ON d.n_nationkey = s.s_nationkey
"""

# Every label/value pair in write order (ord), before last-wins.
PAIRS = f"""
WITH b AS ({_BASE})
SELECT doc_id, ord, key, value FROM (
  SELECT doc_id, 0 AS ord, 'Projekt' AS key, s_name || nation AS value FROM b WHERE s_acctbal >= 0
  UNION ALL SELECT doc_id, 1, 'Antragsteller', s_name FROM b
  UNION ALL SELECT doc_id, 2, 'Antragstellerin', trim('Dr. ' || nation) FROM b WHERE s_acctbal > 5000
  UNION ALL SELECT doc_id, 3, 'Beteiligte Institution', trim('Uni ' || nation) FROM b
  UNION ALL SELECT doc_id, 4, 'Antragstellende Institution', trim(region || ' & Co') FROM b
            WHERE s_nationkey % 2 = 0
  UNION ALL SELECT doc_id, 5, 'Projektnummer', k FROM b
  UNION ALL SELECT doc_id, 6, 'Projektbeschreibung', 'Lieferant ' || k || ' ' || trim('aus ' || nation || CASE WHEN doc_id % 5 = 0 THEN repeat(' und mehr', 2000) ELSE '' END) FROM b
  UNION ALL SELECT doc_id, 7, 'Fach', region FROM b
  UNION ALL SELECT doc_id, 8, 'Fach', nation FROM b
  UNION ALL SELECT doc_id, 9, 'Land', nation FROM b
  UNION ALL SELECT doc_id, 10, 'Projektnummer', 'X-' || k FROM b WHERE s_acctbal < 1000)
"""

LAST = f"SELECT doc_id, key, arg_max(value, ord) AS value FROM ({PAIRS}) GROUP BY doc_id, key"


def _combo(sources):
    keys = ", ".join("'" + s + "'" for s in sources)
    return (f"coalesce(array_to_string(list_sort(list_distinct(list(value) FILTER "
            f"(WHERE key IN ({keys}) AND value <> ''))), ' ; '), '')")


COMBINED = f"""
SELECT doc_id, key, value FROM ({LAST})
WHERE key NOT IN ({", ".join("'" + s + "'" for s in R.APPLICANT_SOURCES + R.INSTITUTION_SOURCES)})
UNION ALL
SELECT doc_id, '{R.APPLICANT_FIELD}', {_combo(R.APPLICANT_SOURCES)} FROM ({LAST}) GROUP BY doc_id
UNION ALL
SELECT doc_id, '{R.INSTITUTION_FIELD}', {_combo(R.INSTITUTION_SOURCES)} FROM ({LAST}) GROUP BY doc_id
"""


def _records(spark, sf_dir):
    return R.parse_records(fixtures.record_pages(spark, sf_dir))


@plan("record_pairs", oracle=f"""
SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY ord) - 1)::INTEGER AS pos, key, value
FROM ({PAIRS})
""")
def record_pairs(spark, sf_dir):
    """Every (label, value) pair of each record page, in write order."""
    p = fixtures.record_pages(spark, sf_dir)
    e = p.select("doc_id", F.posexplode(R.record_pairs(F.col("html"))).alias("pos", "kv"))
    return e.select("doc_id", "pos", F.col("kv.key").alias("key"), F.col("kv.value").alias("value"))


@plan("record_title", oracle=f"""
SELECT b.doc_id, t.value AS projekt, d.value AS projektbeschreibung
FROM ({_BASE}) b
LEFT JOIN ({PAIRS}) t ON t.doc_id = b.doc_id AND t.key = 'Projekt'
LEFT JOIN ({PAIRS}) d ON d.doc_id = b.doc_id AND d.key = 'Projektbeschreibung'
""")
def record_title(spark, sf_dir):
    """R2: the two singleton fields (null when the element is missing)."""
    r = _records(spark, sf_dir)
    return r.select("doc_id", F.col("fields")[R.TITLE_FIELD].alias("projekt"),
                    F.col("fields")[R.TEXT_FIELD].alias("projektbeschreibung"))


@plan("record_last_wins", oracle=LAST)
def record_last_wins(spark, sf_dir):
    """One value per (record, label), the last one written."""
    p = fixtures.record_pages(spark, sf_dir)
    p = p.select("doc_id", R.record_pairs(F.col("html")).alias("pairs"))
    m = p.select("doc_id", F.map_from_entries(R.last_wins(F.col("pairs"))).alias("m"))
    return m.select("doc_id", F.explode("m").alias("key", "value"))


@plan("field_combine", oracle=f"""
SELECT doc_id,
       max(value) FILTER (WHERE key = '{R.APPLICANT_FIELD}') AS applicant,
       max(value) FILTER (WHERE key = '{R.INSTITUTION_FIELD}') AS institution
FROM ({COMBINED}) GROUP BY doc_id
""")
def field_combine(spark, sf_dir):
    """Applicant and institution synonyms merged (sorted, ' ; ')."""
    r = _records(spark, sf_dir)
    return r.select("doc_id", F.col("fields")[R.APPLICANT_FIELD].alias("applicant"),
                    F.col("fields")[R.INSTITUTION_FIELD].alias("institution"))


@plan("key_universe", oracle=f"""
SELECT key, count(*)::BIGINT AS n_records FROM ({COMBINED}) GROUP BY key
""")
def key_universe(spark, sf_dir):
    """The union of record keys, with how many records hold each."""
    return R.key_universe(_records(spark, sf_dir))


def _widen_sql(keys):
    cols = ", ".join(
        f"coalesce(max(value) FILTER (WHERE key = '{k}'), '') AS \"{k}\"" for k in keys)
    return f"SELECT doc_id, {cols} FROM ({COMBINED}) GROUP BY doc_id"


# The key set of the synthesized pages is fixed by the builder.
_RECORD_KEYS = sorted(["Projekt", "Projektnummer", "Projektbeschreibung", "Fach", "Land",
                       R.APPLICANT_FIELD, R.INSTITUTION_FIELD])


@plan("record_widen", oracle=_widen_sql(_RECORD_KEYS))
def record_widen(spark, sf_dir):
    """The wide table; columns discovered from the data."""
    return R.widen(_records(spark, sf_dir))
