"""Frontier, list ranking, streaming = batch, sinks, entry smoke."""

import os
from collections import deque

from pyspark.sql import functions as F

from gleaner.operators import collect as CO
from gleaner.operators import frontier as FR
from gleaner.operators import graph as G
from gleaner.sources import fixtures
from gleaner.sources.project_xml import xml_captures
from gleaner.streaming import ingest, stats


def test_bfs_depth_is_shortest(spark, sf_small):
    edges = fixtures.link_graph(spark, sf_small)
    seeds = fixtures.crawl_seeds(spark, sf_small)
    got = {r.url: r.depth for r in FR.bfs_frontier(spark, seeds, edges, 2).collect()}
    adj = {}
    for r in edges.collect():
        adj.setdefault(r.src, []).append(r.dst)
    dist = {r.url: 0 for r in seeds.collect()}
    dq = deque(dist)
    while dq:
        u = dq.popleft()
        if dist[u] == 2:
            continue
        for v in adj.get(u, []):
            if v not in dist:
                dist[v] = dist[u] + 1
                dq.append(v)
    assert got == dist


def test_list_rank_chain_and_cycle(spark):
    nodes = spark.createDataFrame(
        [("a", "b"), ("b", "c"), ("c", "d"), ("d", None), ("x", "y"), ("y", "x"), ("e", "f"), ("f", None)],
        "url string, next_url string")
    got = sorted((r.page_no, r.url) for r in FR.list_rank(spark, nodes, "a").collect())
    assert got == [(1, "a"), (2, "b"), (3, "c"), (4, "d")]


def test_list_rank_from_any_start(spark):
    def chain(rows, start):
        nodes = spark.createDataFrame(rows, "url string, next_url string")
        return [r.url for r in FR.list_rank(spark, nodes, start).orderBy("page_no").collect()]

    assert chain([("p", "s"), ("s", "n"), ("n", None)], "s") == ["s", "n"]          # not the head of its chain
    assert chain([("a", "x"), ("s", "x"), ("x", None)], "s") == ["s", "x"]          # two pages claim x
    assert chain([("s", "t"), ("t", "u"), ("u", "s")], "s") == ["s", "t", "u"]      # a cycle ends at its first repeat
    assert chain([("s", "gone")], "s") == ["s"]                                     # next page not captured
    assert chain([("a", None)], "s") == []


def test_streams_keep_late_and_unordered_files(spark, sf_small, tmpdir_path):
    from gleaner.streaming import ingest

    events, pages = spark.read.parquet(f"{sf_small}/events.parquet"), spark.read.parquet(f"{sf_small}/pages.parquet")
    day = events.selectExpr("percentile_approx(hash(ts), array(0.5)) AS q").first().q[0]
    late = os.path.join(tmpdir_path, "late")
    for name, df, key in (("events", events, F.hash("ts") > day), ("pages", pages, F.col("page_id") > 20)):
        os.makedirs(os.path.join(late, name))
        for i, part in enumerate((df.filter(key), df.filter(~key), df.filter(key))):  # the third repeats the first
            if name == "pages" or i < 2:
                part.coalesce(1).write.parquet(os.path.join(late, name, str(i)))
    read = lambda name, schema: (spark.readStream.schema(schema).option("recursiveFileLookup", True)
                                 .option("maxFilesPerTrigger", 1).parquet(os.path.join(late, name)))
    out = {}
    for name, frame in (("t1", ingest.ingest(read("pages", pages.schema), events.limit(10))), ("t2", stats.window_counts(read("events", events.schema)))):
        q = (frame.writeStream.format("memory").queryName(name).outputMode("append" if name == "t1" else "complete")
             .option("checkpointLocation", os.path.join(tmpdir_path, name)).trigger(availableNow=True).start())
        q.awaitTermination()
        out[name] = spark.table(name).collect()
    assert len(out["t1"]) == pages.select("url").distinct().count()   # late, repeated, or without a log entry
    assert sum(r.captures for r in out["t2"]) == events.count()


def test_stream_equals_batch(spark, sf_small):
    streamed = stats.run_stats(spark, sf_small)
    batch = stats.window_counts(spark.read.parquet(f"{sf_small}/events.parquet"))
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, batch.collect()))


def test_streams_read_tables_of_many_files(spark, sf_small, tmpdir_path):
    for name in ("pages", "events"):
        spark.read.parquet(f"{sf_small}/{name}.parquet").repartition(3).write.parquet(f"{tmpdir_path}/{name}.parquet")
    got, want = (ingest.run_ingest(spark, d).drop("ts") for d in (tmpdir_path, sf_small))
    assert want.count() > 0 and sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    got, want = (stats.run_stats(spark, d) for d in (tmpdir_path, sf_small))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_manifest_and_graph_sinks(spark, sf_small, tmpdir_path):
    c = CO.collect(fixtures.project_queries(spark, sf_small), fixtures.catalog(spark, sf_small),
                   xml_captures(spark, sf_small), "native")
    out = os.path.join(tmpdir_path, "batch")
    CO.write_manifest(c, out, "cordis_batch_test", "2024-01-01T00:00:00", "/data/xml")
    header = spark.read.json(f"{out}/header").first()
    stats_row = CO.statistics(c).first()
    assert header.statistics.projects_requested == stats_row.projects_requested
    assert spark.read.json(f"{out}/projects").count() == stats_row.projects_downloaded
    v = F.lit("v-test")
    n, e = G.nodes(c, v), G.edges(c, v)
    G.write_graph(n, e, os.path.join(tmpdir_path, "graph"))
    back = spark.read.parquet(os.path.join(tmpdir_path, "graph", "nodes"))
    assert back.filter("version = 'v-test'").count() == n.count()
    report = {r.check: r.n for r in G.integrity(n, e).collect()}
    assert report["duplicate_node_keys"] == 0
    assert report["dangling_src"] == 0 and report["dangling_dst"] == 0


def test_records_that_no_query_matched_are_not_opened(spark, sf_small, monkeypatch):
    from gleaner.operators import xmlrecords as X
    from gleaner.plans.collect_plans import collected

    plain, seen = X.validate, []
    monkeypatch.setattr(X, "validate", lambda captures: seen.append(captures) or plain(captures))
    got = collected(spark, sf_small)
    plan = seen[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "AS xml" in plan[:plan.index("LeftSemi")] and "AS xml" not in plan[plan.index("LeftSemi"):]
    whole = CO.collect(fixtures.project_queries(spark, sf_small), fixtures.catalog(spark, sf_small), xml_captures(spark, sf_small), "native")
    assert sorted(map(str, got.collect())) == sorted(map(str, whole.collect()))
    assert got.filter("downloaded").count() > 0


def test_batch_and_build_contracts(spark, sf_small, tmpdir_path):
    from datetime import datetime

    import pytest

    from gleaner.session import materialize

    captures = xml_captures(spark, sf_small)
    c = materialize(CO.collect(fixtures.project_queries(spark, sf_small), fixtures.catalog(spark, sf_small), captures, "native"))
    when = datetime(2024, 3, 5, 6, 7, 8)
    paths, manifest = CO.save_batch(c, tmpdir_path, when, seconds=9)
    assert manifest == f"{tmpdir_path}/cordis_batch_20240305_060708_metadata"
    stats_row = spark.read.json(f"{manifest}/header").first().statistics
    assert len(stats_row) == 8 and stats_row.total_execution_time_seconds == 9 and stats_row.projects_downloaded == paths.count()
    assert CO.save_batch(c.limit(0), tmpdir_path, when)[1] == ""
    version = G.version_name(F.lit(when))
    n, e = G.build(c, version, f"{tmpdir_path}/g", captures)
    assert {r.version for r in n.select("version").distinct().collect()} == {"v2024-03-05-060708-cordis-auto"}
    assert n.count() == G.nodes(c, version).count() and e.count() == G.edges(c, version).count()
    done = c.filter("downloaded")
    assert spark.read.json(f"{tmpdir_path}/g/manifest").count() == done.count()
    assert spark.read.parquet(f"{tmpdir_path}/g/sources").count() == done.select("project_id").distinct().count()
    with pytest.raises(ValueError):
        G.build(c.limit(0), version, f"{tmpdir_path}/none")


def test_entry_smoke(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["page_id", "url_md5", "text_file", "text", "n_words"]
