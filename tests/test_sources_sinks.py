"""Folder readers (S1, S2) and stores (K1, K3, K5) round trips."""

import os

from pyspark.sql import functions as F

from gleaner.functions.html import html_to_text
from gleaner.sources import captures, sinks
from gleaner.sources.project_xml import xml_captures


def test_html_folder_reads_whole_files(spark, sf_small, tmpdir_path):
    pages = captures.pages(spark, sf_small).limit(5).collect()
    folder = os.path.join(tmpdir_path, "html")
    os.makedirs(folder)
    for r in pages:
        with open(os.path.join(folder, r.file_name), "w", encoding="utf-8") as f:
            f.write(r.html)
    with open(os.path.join(folder, "notes.txt"), "w") as f:
        f.write("not a page")
    df = captures.html_folder(spark, folder)
    got = {r.file_name: r for r in df.collect()}
    assert set(got) == {r.file_name for r in pages}
    for r in pages:
        assert got[r.file_name].html == r.html
        assert got[r.file_name].file_size == len(r.html.encode("utf-8"))


def test_xml_folder_and_store(spark, sf_small, tmpdir_path):
    caps = xml_captures(spark, sf_small)
    store = os.path.join(tmpdir_path, "xmlstore")
    sinks.write_xml_store(caps, store)
    back = spark.read.parquet(store)
    assert back.count() == caps.count()
    rows = back.limit(3).collect()
    folder = os.path.join(tmpdir_path, "xml")
    os.makedirs(folder)
    for r in rows:
        with open(os.path.join(folder, r.file_name), "w", encoding="utf-8") as f:
            f.write(r.xml)
    got = {r.file_name: r.xml for r in captures.xml_folder(spark, folder).collect()}
    assert got == {r.file_name: r.xml for r in rows}


def test_page_and_text_stores(spark, sf_small, tmpdir_path):
    p = captures.pages(spark, sf_small)
    sinks.write_page_store(p, os.path.join(tmpdir_path, "pages"))
    back = spark.read.parquet(os.path.join(tmpdir_path, "pages"))
    assert back.filter("depth = 0").count() == p.count()
    t = p.select("file_name", html_to_text(F.col("html")).alias("text"))
    sinks.write_text_store(t, os.path.join(tmpdir_path, "text"))
    names = [r.text_file for r in spark.read.parquet(os.path.join(tmpdir_path, "text")).collect()]
    assert names and all(n.endswith(".md") and n.startswith("0_") for n in names)


def test_listing_store_partitions_by_page(spark, sf_small, tmpdir_path):
    from gleaner.plans.crawl_plans import listing_links
    from gleaner.sources import fixtures

    links = listing_links(spark, sf_small)
    pages = fixtures.listing_pages(spark, sf_small).select("page_no", "html")
    sinks.write_listing_store(links.join(pages, "page_no"), os.path.join(tmpdir_path, "listing"))
    back = spark.read.parquet(os.path.join(tmpdir_path, "listing"))
    assert back.count() == links.count()
    one = back.filter("page_no = 1").orderBy("pos").first()
    assert one.pos == 0 and one.file_name.startswith("page1_proj0_") and one.file_name.endswith(".html")
