"""XML record validation, metadata and batch selection.

``with_facts`` parses each document once (see ``gleaner.functions.xml``);
everything after it is Spark expressions over the facts, row-local.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions.xml import ESSENTIAL_FIELDS, METADATA_FIELDS, facts_struct, xml_facts_flat
from gleaner.sources.project_xml import CORDIS_NS

from gleaner.fixed_values import MAX_BYTES, MIN_BYTES, XML_FILE_PREFIX, XML_FILE_SUFFIX  # noqa: E402


def with_facts(df: DataFrame, xml_col: str = "xml") -> DataFrame:
    """Adds ``facts``; the parse is its own projection, so it runs once per row."""
    flat = df.withColumn("_flat", xml_facts_flat(F.col(xml_col)))
    return flat.withColumn("facts", facts_struct(F.col("_flat"))).drop("_flat")


def first_error(facts: Column, size: Column, expected_id: Column) -> Column:
    """The first failing check (the checks run in this order), or null."""
    return (F.when(~facts["wellformed"], F.lit("malformed"))
            .when(facts["root"] != "project", F.lit("root"))
            .when(facts["has_id"] & facts["id_text"].isNull(), F.lit("id_empty"))
            .when(facts["has_id"] & (facts["id_text"] != expected_id), F.lit("id_mismatch"))
            .when(size < MIN_BYTES, F.lit("too_small")))


def warnings(facts: Column, size: Column, expected_id: Column) -> Column:
    """X3/X4/X5/X6 warnings, only for checks reached before a failure."""
    root_ok = facts["wellformed"] & (facts["root"] == "project")
    id_ok = root_ok & ~(facts["has_id"] & (facts["id_text"].isNull()
                                           | (facts["id_text"] != expected_id)))
    ns = facts["namespace"]
    ws = [F.when(root_ok & ns.isNotNull() & (ns != CORDIS_NS), F.lit("namespace")),
          F.when(root_ok & ~facts["has_id"], F.lit("no_id"))]
    ws += [F.when(id_ok & facts["fields"][f].isNull(), F.lit("missing:" + f)) for f in ESSENTIAL_FIELDS]
    ws.append(F.when(id_ok & (size > MAX_BYTES), F.lit("too_large")))
    return F.filter(F.array(*ws), lambda w: w.isNotNull())


def validate(captures: DataFrame, id_col: str = "project_id") -> DataFrame:
    """(valid, error, warnings) per captured document."""
    df = with_facts(captures)
    err = first_error(F.col("facts"), F.col("file_size"), F.col(id_col))
    return df.select(
        "*",
        err.isNull().alias("valid"),
        err.alias("error"),
        warnings(F.col("facts"), F.col("file_size"), F.col(id_col)).alias("warnings"),
    )


def metadata_columns(facts: Column) -> list[Column]:
    """First non-blank text of each field, document order, any depth."""
    return [facts["fields"][f].alias(f) for f in METADATA_FIELDS]


def xml_file_name(pid: Column) -> Column:
    """K5: the stored name of a project's record."""
    return F.concat(F.lit(XML_FILE_PREFIX), pid, F.lit(XML_FILE_SUFFIX))


def file_columns(pid: Column, fetched_at: Column) -> list[Column]:
    """Where the record is stored and when it was fetched (ISO 8601), beside its ``file_size``."""
    return [xml_file_name(pid).alias("file_path"), F.date_format(fetched_at, "yyyy-MM-dd'T'HH:mm:ss").alias("download_date")]


def content_probe(status: Column, body: Column, pid: Column) -> Column:
    """An OK response whose lower-cased body mentions xml, project and the id."""
    low = F.lower(body)
    return (status == 200) & low.contains("xml") & low.contains("project") & low.contains(pid)


def batch_valid(requested: DataFrame, captures: DataFrame, id_col: str = "project_id") -> DataFrame:
    """The requested ids whose capture downloaded (status < 400) and
    validated.  Equi-join on the id; the request list is a query table, so
    no broadcast is assumed (AQE picks one at run time when it is small)."""
    wanted = captures.filter(F.col("status") < 400).join(requested.select(id_col).distinct(), id_col, "left_semi")
    ok = validate(wanted, id_col).filter("valid")
    return requested.join(ok.select(id_col), id_col).select(
        id_col, xml_file_name(F.col(id_col)).alias("file_name"))
