"""Capture and text stores (K1, K2, K3, K5).

Stores are parquet tables keyed by the names the original tool gave its
files (file names become a column), partitioned by depth / listing page so a
reader prunes partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.fixed_values import XML_FILE_PREFIX, XML_FILE_SUFFIX
from gleaner.functions.urls import text_file_name


def write_page_store(pages: DataFrame, path: str) -> None:
    """K1: (depth, file_name, url, html), partitioned by depth."""
    (pages.select("depth", "file_name", "url", "html").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("depth").parquet(path))


def write_listing_store(captures: DataFrame, path: str) -> None:
    """K2: (page_no, pos, file_name, href, html), partitioned by listing page."""
    (captures.select("page_no", "pos", "file_name", "href", "html").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("page_no").parquet(path))


def write_text_store(texts: DataFrame, path: str) -> None:
    """K3: (text_file, text): the capture's base name with '.md'."""
    texts.select(text_file_name(F.col("file_name")).alias("text_file"), "text").write.mode(
        "overwrite").parquet(path)


def write_xml_store(captures: DataFrame, path: str) -> None:
    """K5: (project_id, file_name, xml) with the record's stored name."""
    captures.select("project_id", F.concat(F.lit(XML_FILE_PREFIX), "project_id", F.lit(XML_FILE_SUFFIX))
                    .alias("file_name"), "xml").write.mode("overwrite").parquet(path)


def write_record_files(files: DataFrame, path: str) -> None:
    """One XML file per row of ``files`` (xml: a whole file)."""
    files.select("xml").write.mode("overwrite").option("maxRecordsPerFile", 1).text(path)
