"""The crawl in the original's order against a replay; graph versions that appear whole."""

import random

import pytest
from pyspark.sql import functions as F

from gleaner.operators import frontier as FR
from gleaner.operators import graph as G


def replay(seeds, links, most):
    """Pages in visiting order with their depth."""
    seen, order = set(), []

    def visit(url, depth):
        if depth > most or url in seen:
            return
        seen.add(url)
        order.append((url, depth))
        if depth < most:
            for link in links.get(url, []):
                visit(link, depth + 1)

    for s in seeds:
        visit(s, 0)
    return order


@pytest.mark.parametrize("most", [0, 1, 2, 3])
def test_crawl_order_equals_a_replay(spark, most):
    for seed in range(3):
        rng = random.Random(10 * most + seed)
        names = [f"u{i}" for i in range(rng.choice([8, 25, 60]))]
        links = {u: [rng.choice([*names, "outside"]) for _ in range(rng.randrange(5))] for u in names}
        starts = [rng.choice(names) for _ in range(rng.randrange(1, 6))]
        edges = [(u, v, k) for u, vs in links.items() for k, v in enumerate(vs)]
        got = FR.ordered_crawl(spark, spark.createDataFrame(list(zip(starts, range(len(starts)))), "url string, place int"),
                               spark.createDataFrame(edges, "src string, dst string, place int"), most).collect()
        assert [(r.url, r.depth) for r in sorted(got, key=lambda r: r.label)] == replay(starts, links, most)


def test_page_first_met_at_the_limit_is_not_expanded(spark):
    """a -> b -> c (the limit), then a -> c: c stays where it was met, and its link d is never visited."""
    edges = spark.createDataFrame([("a", "b", 0), ("b", "c", 0), ("a", "c", 1), ("c", "d", 0)], "src string, dst string, place int")
    got = FR.ordered_crawl(spark, spark.createDataFrame([("a", 0)], "url string, place int"), edges, 2).collect()
    assert {r.url: (r.depth, r.label) for r in got} == {"a": (0, [0]), "b": (1, [0, 0]), "c": (2, [0, 0, 0])}


def collected(spark, rows):
    meta = "struct<title:string,acronym:string,startDate:string,keywords:string>"
    frame = spark.createDataFrame([(n, f"q{n}", p, 0.5, True, True, f"x{p}.xml", 10, (f"T{p}", "A", "2024-01-01", "k1, k2")) for n, p in rows],
                                  f"query_no long, search_query string, project_id string, match_score double, found boolean, downloaded boolean, "
                                  f"xml_file_path string, xml_file_size long, metadata {meta}")
    return frame.withColumn("project_url", F.concat(F.lit("http://h/"), "project_id"))


def test_versions_appear_whole(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "graph")
    captures = spark.createDataFrame([("1", "<x/>"), ("2", "<y/>")], "project_id string, xml string")
    assert G.current(spark, root) is None
    G.publish(collected(spark, [(1, "1")]), F.lit("v1"), root, captures)
    first = G.current(spark, root)
    size = spark.read.parquet(f"{first}/nodes").count()
    write = G.write_sources

    def fail(*args):
        raise OSError("lost")

    monkeypatch.setattr(G, "write_sources", fail)  # nodes, edges and manifest of v2 are written by then
    with pytest.raises(OSError):
        G.publish(collected(spark, [(1, "1"), (2, "2")]), F.lit("v2"), root, captures)
    assert G.current(spark, root) == first and spark.read.parquet(f"{first}/nodes").count() == size
    monkeypatch.setattr(G, "write_sources", write)
    monkeypatch.setattr(G, "edges", lambda c, v: c.select(v.alias("version"), F.lit("query:1").alias("src"), F.lit("project:gone").alias("dst"),
                                                          F.lit("MATCHED").alias("type"), F.lit(1.0).alias("score")))
    with pytest.raises(ValueError, match="dangling"):
        G.publish(collected(spark, [(1, "1"), (2, "2")]), F.lit("v2"), root, captures)
    assert G.current(spark, root) == first
    monkeypatch.undo()
    G.publish(collected(spark, [(1, "1"), (2, "2")]), F.lit("v2"), root, captures)
    second = G.current(spark, root)
    assert second != first and spark.read.parquet(f"{second}/nodes").count() > size
    assert spark.read.parquet(f"{second}/sources").count() == 2
