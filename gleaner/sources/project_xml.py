"""Project XML captures built from ``orders`` (one document per order).

The document layout is written once as a list of parts and rendered both as
a Spark column and as DuckDB SQL, so the oracle sees byte-identical
documents and can derive every expected verdict from the source columns.

Variants (all rows kept; the variant is a property of the row):
  priority 1-URGENT  default namespace http://cordis.europa.eu
  priority 2-HIGH    prefixed namespace (c:project, c:id, ...)
  priority 3-MEDIUM  another namespace (warning only)
  priority 4-NOT SPECIFIED  blank outer title (a nested title fills in)
  status P           no totalCost (warning only)
  custkey mod 10 = 0 no closing root tag (malformed)
                 1   root element 'record'
                 2   id differs from the order key
                 3   empty id element
                 4   no id anywhere, no nested organization
                 5   short objective (under 1000 bytes)
                 7   no XML declaration
                 9   capture status 404
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.sources.tables import read_table, spread

from gleaner.fixed_values import PROJECT_NAMESPACE as CORDIS_NS  # noqa: E402

OTHER_NS = "http://example.org/other"  # an unexpected namespace for the warning case

# Derived fields, in both dialects.
_FIELDS = {
    "k": (lambda: F.col("o_orderkey").cast("string"), "CAST(o_orderkey AS VARCHAR)"),
    "k1": (lambda: (F.col("o_orderkey") + 1).cast("string"), "CAST(o_orderkey + 1 AS VARCHAR)"),
    "c": (lambda: F.col("o_custkey").cast("string"), "CAST(o_custkey AS VARCHAR)"),
    "d": (lambda: F.date_format("o_orderdate", "yyyy-MM-dd"), "strftime(o_orderdate, '%Y-%m-%d')"),
    "cents": (lambda: F.round(F.col("o_totalprice") * 100).cast("bigint").cast("string"),
              "CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS VARCHAR)"),
    "prio": (lambda: F.col("o_orderpriority"), "o_orderpriority"),
    "st": (lambda: F.col("o_orderstatus"), "o_orderstatus"),
}

# Row conditions, in both dialects.
_CONDS = {
    "high": (lambda: F.col("o_orderpriority") == "2-HIGH", "o_orderpriority = '2-HIGH'"),
    "urgent": (lambda: F.col("o_orderpriority") == "1-URGENT", "o_orderpriority = '1-URGENT'"),
    "medium": (lambda: F.col("o_orderpriority") == "3-MEDIUM", "o_orderpriority = '3-MEDIUM'"),
    "blank_title": (lambda: F.col("o_orderpriority") == "4-NOT SPECIFIED",
                    "o_orderpriority = '4-NOT SPECIFIED'"),
    "no_cost": (lambda: F.col("o_orderstatus") == "P", "o_orderstatus = 'P'"),
}
for _n in (0, 1, 2, 3, 4, 5, 7, 9):
    _CONDS[f"d{_n}"] = (lambda n=_n: F.pmod(F.col("o_custkey"), F.lit(10)) == n,
                        f"(o_custkey % 10 + 10) % 10 = {_n}")


def _p(tag: str):
    """An element name: prefixed 'c:' in the prefixed variant."""
    return [("if", "high", [("lit", "c:" + tag)], [("lit", tag)])]


def _elem(tag: str, body):
    return [("lit", "<"), *_p(tag), ("lit", ">"), *body, ("lit", "</"), *_p(tag), ("lit", ">")]


_ROOT_NAME = [("if", "d1", _p("record"), _p("project"))]
_ROOT_OPEN = [
    ("lit", "<"), *_ROOT_NAME,
    ("if", "high", [("lit", f' xmlns:c="{CORDIS_NS}"')],
     [("if", "urgent", [("lit", f' xmlns="{CORDIS_NS}"')],
       [("if", "medium", [("lit", f' xmlns="{OTHER_NS}"')], [])])]),
    ("lit", ">\n"),
]
_OBJECTIVE_SENTENCE = [("lit", "Research on order "), ("col", "k"), ("lit", ". ")]
LAYOUT = [
    ("if", "d7", [], [("lit", '<?xml version="1.0" encoding="UTF-8"?>\n')]),
    *_ROOT_OPEN,
    ("if", "d4", [], [("if", "d3", [("lit", "<"), *_p("id"), ("lit", "/>")],
                       _elem("id", [("if", "d2", [("col", "k1")], [("col", "k")])]))]),
    *_elem("acronym", [("lit", "P"), ("col", "k")]),
    *_elem("title", [("if", "blank_title", [("lit", " ")],
                      [("lit", "Order "), ("col", "k"), ("lit", " for customer "), ("col", "c")])]),
    *_elem("objective", [("if", "d5", [("lit", "short")], [("repeat", 40, _OBJECTIVE_SENTENCE)])]),
    ("lit", "\n"),
    *_elem("startDate", [("col", "d")]),
    *_elem("endDate", [("col", "d")]),
    ("if", "no_cost", [], _elem("totalCost", [("col", "cents")])),
    *_elem("ecMaxContribution", [("col", "cents")]),
    *_elem("keywords", [("col", "prio"), ("lit", ", status "), ("col", "st")]),
    ("if", "d4", [], _elem("relations", _elem("organization", [
        *_elem("id", [("lit", "9"), ("col", "k")]),
        *_elem("title", [("lit", "Customer "), ("col", "c")]),
    ]))),
    ("lit", "\n"),
    ("if", "d0", [], [("lit", "</"), *_ROOT_NAME, ("lit", ">\n")]),
]


def _spark(parts) -> Column:
    out = []
    for part in parts:
        kind = part[0]
        if kind == "lit":
            out.append(F.lit(part[1]))
        elif kind == "col":
            out.append(_FIELDS[part[1]][0]())
        elif kind == "repeat":
            out.append(F.repeat(_spark(part[2]), part[1]))
        else:
            out.append(F.when(_CONDS[part[1]][0](), _spark(part[2])).otherwise(_spark(part[3])))
    return F.concat(*out) if out else F.lit("")


def _sql_lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _sql(parts) -> str:
    out = []
    for part in parts:
        kind = part[0]
        if kind == "lit":
            out.append(_sql_lit(part[1]))
        elif kind == "col":
            out.append(_FIELDS[part[1]][1])
        elif kind == "repeat":
            out.append(f"repeat({_sql(part[2])}, {part[1]})")
        else:
            out.append(f"(CASE WHEN {_CONDS[part[1]][1]} THEN {_sql(part[2])} ELSE {_sql(part[3])} END)")
    return "(" + " || ".join(out) + ")" if out else "''"


def _keyed(orders: DataFrame) -> DataFrame:
    return orders.withColumn("project_id", F.col("o_orderkey").cast("string"))


def capture_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(project_id, columns of its order): what ``with_xml`` makes a capture of."""
    return _keyed(read_table(spark, sf_dir, "orders"))


def with_xml(rows: DataFrame) -> DataFrame:
    """(project_id, xml, file_size, status, content_type, fetched_at) of capture rows."""
    return rows.select(
        "project_id",
        _spark(LAYOUT).alias("xml"),
        F.when(_CONDS["d9"][0](), 404).otherwise(200).alias("status"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit("text/html"))
        .otherwise(F.lit("application/xml")).alias("content_type"),
        F.col("o_orderdate").alias("fetched_at"),
    ).withColumn("file_size", F.octet_length("xml").cast("bigint"))


def xml_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(project_id, xml, file_size, status, content_type, fetched_at) per order, fetched when it was placed."""
    return with_xml(_keyed(spread(read_table(spark, sf_dir, "orders"))))


XML_CAPTURES_SQL = f"""
SELECT project_id, xml, status, content_type, strlen(xml)::BIGINT AS file_size, o_custkey,
       o_orderpriority, o_orderstatus, o_orderkey, o_totalprice, o_orderdate
FROM (SELECT CAST(o_orderkey AS VARCHAR) AS project_id, {_sql(LAYOUT)} AS xml,
             CASE WHEN {_CONDS['d9'][1]} THEN 404 ELSE 200 END AS status,
             CASE WHEN o_orderpriority = '5-LOW' THEN 'text/html' ELSE 'application/xml' END
               AS content_type,
             o_custkey, o_orderpriority, o_orderstatus, o_orderkey, o_totalprice, o_orderdate
      FROM orders)
"""


#: Orders in one record file.
RECORDS_PER_FILE = 200


def record_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(xml): files of up to 200 orders as records, by key; those of every 400th customer have a wrong end tag."""
    o = read_table(spark, sf_dir, "orders")
    end = F.when(F.pmod("o_custkey", F.lit(400)) == 0, F.lit("</titel>")).otherwise(F.lit("</title>"))
    record = F.concat(F.lit('<project id="'), F.col("o_orderkey").cast("string"), F.lit('"><title>Order &amp; '), F.col("o_orderpriority"), end,
                      F.lit("<startDate>"), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("</startDate><totalCost>"),
                      F.round(F.col("o_totalprice") * 100).cast("bigint").cast("string"), F.lit("</totalCost></project>"))
    files = (o.groupBy(F.floor(F.col("o_orderkey") / RECORDS_PER_FILE).cast("bigint").alias("file_no"))
             .agg(F.array_sort(F.collect_list(F.struct("o_orderkey", record.alias("record")))).alias("r")))
    return files.select(F.concat(F.lit('<?xml version="1.0"?><projects no="'), F.col("file_no").cast("string"), F.lit('">'),
                                 F.array_join(F.col("r.record"), ""), F.lit("</projects>")).alias("xml"))
