"""Plans over project XML captures built from ``orders``.

Oracles derive every expected verdict and field from the order columns that
decided the document's variant (see ``gleaner.sources.project_xml``).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from gleaner import fixed_values as FV
from gleaner.functions.xml import METADATA_FIELDS
from gleaner.operators import xmlrecords as X
from gleaner.plans.registry import plan
from gleaner.session import scratch_path
from gleaner.sources.captures import CORRUPT, xml_records
from gleaner.sources.project_xml import CORDIS_NS, OTHER_NS, RECORDS_PER_FILE, XML_CAPTURES_SQL, record_files, xml_captures
from gleaner.sources.sinks import write_record_files

_D = "((o_custkey % 10 + 10) % 10)"
_K = "CAST(o_orderkey AS VARCHAR)"
_FACTS = f"""
SELECT project_id, file_size, status, content_type, xml, o_orderpriority, o_orderstatus, o_orderdate,
       {_D} <> 0 AS wellformed,
       {_D} NOT IN (0, 1) AS root_ok,
       CASE WHEN {_D} = 0 THEN NULL
            WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN '{CORDIS_NS}'
            WHEN o_orderpriority = '3-MEDIUM' THEN '{OTHER_NS}' END AS namespace,
       {_D} NOT IN (0, 4) AS has_id,
       CASE WHEN {_D} = 0 OR {_D} = 3 OR {_D} = 4 THEN NULL
            WHEN {_D} = 2 THEN CAST(o_orderkey + 1 AS VARCHAR) ELSE {_K} END AS id_text,
       CASE WHEN {_D} IN (0, 4) THEN NULL WHEN {_D} = 2 THEN CAST(o_orderkey + 1 AS VARCHAR)
            WHEN {_D} = 3 THEN '9' || {_K} ELSE {_K} END AS f_id,
       CASE WHEN {_D} = 0 THEN NULL ELSE 'P' || {_K} END AS f_acronym,
       CASE WHEN {_D} = 0 THEN NULL
            WHEN o_orderpriority = '4-NOT SPECIFIED' THEN
              CASE WHEN {_D} = 4 THEN NULL ELSE 'Customer ' || CAST(o_custkey AS VARCHAR) END
            ELSE 'Order ' || {_K} || ' for customer ' || CAST(o_custkey AS VARCHAR) END AS f_title,
       CASE WHEN {_D} = 0 THEN NULL WHEN {_D} = 5 THEN 'short'
            ELSE trim(repeat('Research on order ' || {_K} || '. ', 40)) END AS f_objective,
       CASE WHEN {_D} = 0 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS f_startDate,
       CASE WHEN {_D} = 0 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS f_endDate,
       CASE WHEN {_D} = 0 OR o_orderstatus = 'P' THEN NULL
            ELSE CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS VARCHAR) END AS f_totalCost,
       CASE WHEN {_D} = 0 THEN NULL
            ELSE CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS VARCHAR) END AS f_ecMaxContribution,
       CASE WHEN {_D} = 0 THEN NULL ELSE o_orderpriority || ', status ' || o_orderstatus END AS f_keywords
FROM ({XML_CAPTURES_SQL})
"""

_ERROR = """CASE WHEN NOT wellformed THEN 'malformed' WHEN NOT root_ok THEN 'root'
     WHEN has_id AND id_text IS NULL THEN 'id_empty'
     WHEN has_id AND id_text <> project_id THEN 'id_mismatch'
     WHEN file_size < 1000 THEN 'too_small' END"""
_ID_OK = "(root_ok AND NOT (has_id AND (id_text IS NULL OR id_text <> project_id)))"
_WARNINGS = f"""list_filter([
  CASE WHEN root_ok AND namespace IS NOT NULL AND namespace <> '{CORDIS_NS}' THEN 'namespace' END,
  CASE WHEN root_ok AND NOT has_id THEN 'no_id' END,
  CASE WHEN {_ID_OK} AND f_title IS NULL THEN 'missing:title' END,
  CASE WHEN {_ID_OK} AND f_startDate IS NULL THEN 'missing:startDate' END,
  CASE WHEN {_ID_OK} AND f_totalCost IS NULL THEN 'missing:totalCost' END,
  CASE WHEN {_ID_OK} AND file_size > {X.MAX_BYTES} THEN 'too_large' END], lambda w: w IS NOT NULL)"""


def _facts(spark, sf_dir):
    return X.with_facts(xml_captures(spark, sf_dir))


@plan("xml_wellformed", oracle=f"SELECT project_id, wellformed FROM ({_FACTS})")
def xml_wellformed(spark, sf_dir):
    """Does the document parse."""
    return _facts(spark, sf_dir).select("project_id", F.col("facts.wellformed").alias("wellformed"))


@plan("xml_root_ok", oracle=f"SELECT project_id, root_ok FROM ({_FACTS})")
def xml_root_ok(spark, sf_dir):
    """Is the root element (local name) 'project'; false when unparsable."""
    f = _facts(spark, sf_dir)
    return f.select("project_id", F.coalesce(F.col("facts.root") == "project", F.lit(False)).alias("root_ok"))


@plan("xml_namespace_warn", oracle=f"""
SELECT project_id, namespace,
       coalesce(root_ok AND namespace IS NOT NULL AND namespace <> '{CORDIS_NS}', false) AS namespace_warning
FROM ({_FACTS})""")
def xml_namespace_warn(spark, sf_dir):
    """The root namespace and whether it is an unexpected one."""
    f = _facts(spark, sf_dir)
    ns = F.col("facts.namespace")
    warn = (F.col("facts.root") == "project") & ns.isNotNull() & (ns != X.CORDIS_NS)
    return f.select("project_id", ns.alias("namespace"), F.coalesce(warn, F.lit(False)).alias("namespace_warning"))


@plan("xml_id_match", oracle=f"""
SELECT project_id, CASE WHEN NOT root_ok THEN NULL WHEN NOT has_id THEN 'absent'
                        WHEN id_text IS NULL THEN 'empty'
                        WHEN id_text = project_id THEN 'match' ELSE 'mismatch' END AS id_status
FROM ({_FACTS})""")
def xml_id_match(spark, sf_dir):
    """The first id element against the expected project id."""
    f = _facts(spark, sf_dir)
    fa = F.col("facts")
    status = (F.when(~fa["wellformed"] | (fa["root"] != "project"), F.lit(None).cast("string"))
              .when(~fa["has_id"], F.lit("absent"))
              .when(fa["id_text"].isNull(), F.lit("empty"))
              .when(fa["id_text"] == F.col("project_id"), F.lit("match"))
              .otherwise(F.lit("mismatch")))
    return f.select("project_id", status.alias("id_status"))


@plan("xml_missing_fields", oracle=f"""
SELECT project_id, list_filter([CASE WHEN f_title IS NULL THEN 'title' END,
                                CASE WHEN f_startDate IS NULL THEN 'startDate' END,
                                CASE WHEN f_totalCost IS NULL THEN 'totalCost' END],
                               lambda x: x IS NOT NULL) AS missing
FROM ({_FACTS}) WHERE wellformed""")
def xml_missing_fields(spark, sf_dir):
    """Essential fields with no non-blank element, per parsable document."""
    f = _facts(spark, sf_dir).filter(F.col("facts.wellformed"))
    names = F.array(*[F.when(F.col("facts.fields")[n].isNull(), F.lit(n)) for n in X.ESSENTIAL_FIELDS])
    return f.select("project_id", F.filter(names, lambda x: x.isNotNull()).alias("missing"))


@plan("xml_size_verdict", oracle=f"""
SELECT project_id, file_size,
       CASE WHEN file_size < {X.MIN_BYTES} THEN 'too_small'
            WHEN file_size > {X.MAX_BYTES} THEN 'too_large' ELSE 'ok' END AS size_status
FROM ({XML_CAPTURES_SQL})""")
def xml_size_verdict(spark, sf_dir):
    """Byte size and its bound check."""
    c = xml_captures(spark, sf_dir)
    s = (F.when(F.col("file_size") < X.MIN_BYTES, F.lit("too_small"))
         .when(F.col("file_size") > X.MAX_BYTES, F.lit("too_large")).otherwise(F.lit("ok")))
    return c.select("project_id", "file_size", s.alias("size_status"))


@plan("xml_validate", oracle=f"""
SELECT project_id, error IS NULL AS valid, error, warnings
FROM (SELECT project_id, {_ERROR} AS error, {_WARNINGS} AS warnings FROM ({_FACTS}))""")
def xml_validate(spark, sf_dir):
    """The validation verdict with its first error and the warnings."""
    return X.validate(xml_captures(spark, sf_dir)).select("project_id", "valid", "error", "warnings")


_META_SQL = ", ".join(f"f_{f} AS \"{f}\"" for f in METADATA_FIELDS)


@plan("xml_metadata", oracle=f"""
SELECT project_id, {_META_SQL}, '{FV.XML_FILE_PREFIX}' || project_id || '{FV.XML_FILE_SUFFIX}' AS file_path, file_size,
       strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS download_date FROM ({_FACTS})""")
def xml_metadata(spark, sf_dir):
    """The nine metadata fields, and the file's path, size and date."""
    f = _facts(spark, sf_dir)
    return f.select("project_id", *X.metadata_columns(F.col("facts")), "file_size", *X.file_columns(F.col("project_id"), F.col("fetched_at")))


@plan("batch_valid_ids", oracle=f"""
SELECT CAST(o.o_orderkey AS VARCHAR) AS project_id,
       '{FV.XML_FILE_PREFIX}' || CAST(o.o_orderkey AS VARCHAR) || '{FV.XML_FILE_SUFFIX}' AS file_name
FROM orders o JOIN (SELECT project_id, status, {_ERROR} AS error FROM ({_FACTS})) v
  ON v.project_id = CAST(o.o_orderkey AS VARCHAR)
WHERE v.status < 400 AND v.error IS NULL""")
def batch_valid_ids(spark, sf_dir):
    """Requested ids (every order) whose record downloaded and validated."""
    from gleaner.sources.tables import read_table
    req = read_table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("project_id"))
    return X.batch_valid(req, xml_captures(spark, sf_dir))


@plan("capture_contains_project", oracle=f"""
SELECT project_id, status = 200 AND contains(lower(xml), 'xml') AND contains(lower(xml), 'project')
                   AND contains(lower(xml), project_id) AS exists_ok,
       NOT contains(lower(content_type), 'xml') AS content_type_warning
FROM ({XML_CAPTURES_SQL})""")
def capture_contains_project(spark, sf_dir):
    """Does the capture look like the project's record."""
    c = xml_captures(spark, sf_dir)
    return c.select("project_id",
                    X.content_probe(F.col("status"), F.col("xml"), F.col("project_id")).alias("exists_ok"),
                    (~F.lower("content_type").contains("xml")).alias("content_type_warning"))


_SCAN_SCHEMA = "id string, title string, startDate string, totalCost string"


@plan("xml_scan_rows", oracle="""
SELECT CAST(o_orderkey AS VARCHAR) AS project_id,
       'Order ' || o_orderkey || ' & <' || o_orderpriority || '>' AS title,
       strftime(o_orderdate, '%Y-%m-%d') AS startDate,
       CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS VARCHAR) AS totalCost
FROM orders""")
def xml_scan_rows(spark, sf_dir):
    """Records written with Spark's XML writer (``to_xml``, rowTag
    project) and read back with ``from_xml`` and a typed schema -- the
    native path for well-formed, top-level-only records."""
    from gleaner.sources.tables import read_table, spread
    o = spread(read_table(spark, sf_dir, "orders"))
    rec = F.struct(
        F.col("o_orderkey").cast("string").alias("id"),
        F.concat(F.lit("Order "), F.col("o_orderkey").cast("string"), F.lit(" & <"),
                 F.col("o_orderpriority"), F.lit(">")).alias("title"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("startDate"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").cast("string").alias("totalCost"))
    docs = o.select(F.to_xml(rec, {"rowTag": "project"}).alias("xml"))
    parsed = docs.select(F.from_xml("xml", _SCAN_SCHEMA, {"rowTag": "project"}).alias("p"))
    return parsed.select(F.col("p.id").alias("project_id"), "p.title", "p.startDate", "p.totalCost")


@plan("xml_source_records", oracle="""
WITH o AS (
  SELECT *, o_orderkey // 200 AS file_no,
         min(CASE WHEN o_custkey % 400 = 0 THEN o_orderkey END) OVER (PARTITION BY o_orderkey // 200) AS first_bad FROM orders)
SELECT file_no, CAST(o_orderkey AS VARCHAR) AS project_id, 'Order & ' || o_orderpriority AS title, strftime(o_orderdate, '%Y-%m-%d') AS start_date,
       CAST(round(o_totalprice * 100) AS BIGINT) AS total_cost, false AS malformed
FROM o WHERE first_bad IS NULL OR o_orderkey < first_bad
UNION ALL SELECT DISTINCT file_no, NULL, NULL, NULL, NULL, true FROM o WHERE first_bad IS NOT NULL""")
def xml_source_records(spark, sf_dir):
    """Record files, many records in each, read with Spark's XML source; malformed ones are reported."""
    path = scratch_path(spark, "record-files")
    write_record_files(record_files(spark, sf_dir), path)
    r = xml_records(spark, path, "project", "_id string, title string, startDate string, totalCost bigint")
    named = r.withColumn("own", F.regexp_extract(F.col(CORRUPT), 'no="([0-9]+)"', 1).cast("bigint"))
    return named.select(F.coalesce("own", F.floor(F.col("_id").cast("bigint") / RECORDS_PER_FILE)).alias("file_no"), F.col("_id").alias("project_id"),
                        "title", F.col("startDate").alias("start_date"), F.col("totalCost").alias("total_cost"), F.col(CORRUPT).isNotNull().alias("malformed"))
