"""The search index: saved, extended, read without a shuffle; and what hot keys send on."""

import os
import random
import re
import tempfile

import pytest
from pyspark.sql import functions as F

from gleaner.operators import editjoin, search as S
from test_search_skew import CATALOG, QUERIES, expected_pages


@pytest.fixture(scope="module")
def tables(spark):
    q = spark.createDataFrame([q[:2] for q in QUERIES], "query_no long, query string")
    c = spark.createDataFrame([(p, t, "") for p, t, _ in CATALOG], "project_id string, title string, description string")
    return q, c


def pages(found):
    return {(r.query_no, r.strategy_no, r.pos): r.project_id for r in found.collect()}


def test_saved_and_extended_index_finds_the_same(spark, tables):
    q, c = tables
    folder = tempfile.mkdtemp(prefix="gleaner-index-")
    first = S.save_index(S.build_index(c.filter("cast(project_id as int) < 200")), "idx_a", 4, folder)
    assert pages(S.search(q, None, index=first)) == pages(S.search(q, c.filter("cast(project_id as int) < 200")))
    grown = S.extend_index(spark, "idx_a", c.filter("cast(project_id as int) >= 200"), 4, folder)
    assert pages(S.search(q, None, index=grown)) == expected_pages()
    assert pages(S.search(q, None, index=S.open_index(spark, "idx_a"))) == expected_pages()


def test_saved_index_is_not_shuffled(spark, tables):
    q, c = tables
    index = S.save_index(S.build_index(c), "idx_b", 4, tempfile.mkdtemp(prefix="gleaner-index-"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = S.search(q, None, index=index)._jdf.queryExecution().executedPlan().toString().split("\n")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    depth = lambda x: len(re.match(r"[\s:+\-]*", x)[0])
    scans = [k for k, x in enumerate(lines) if "FileScan" in x and "idx_b_" in x]
    assert len(scans) >= 7
    for k in scans:
        at, level = k, depth(lines[k])
        while "Join" not in lines[at]:
            assert "Exchange" not in lines[at], "\n".join(lines[at:k + 1])
            at = max(j for j in range(at) if depth(lines[j]) < level)
            level = depth(lines[at])


def test_hot_keys_send_on_a_page_per_text(spark):
    """400 entries of one acronym, 400 of one title and 400 with one common word pair."""
    rows = [(f"{i:04d}", f"Green Lake Study number {i}") for i in range(400)]
    rows += [(f"{i:04d}", "One shared title for all") for i in range(400, 800)] + [(f"{i:04d}", f"deep sea {i} probe w{i}") for i in range(800, 1200)]
    c = spark.createDataFrame([(p, t, "") for p, t in rows], "project_id string, title string, description string")
    index = S.build_index(c)
    assert index.acronyms.groupBy("acr", "word").count().agg(F.max("count")).first()[0] == 10
    assert index.ranked.groupBy("gram").count().agg(F.max("count")).first()[0] == 10
    assert index.titles.filter(F.size("best") > 1).select(F.size("best")).collect() == [(10,)]
    asked = ["GLSN", "glsn", "One shared title for all", "deep sea", '"deep sea"'] * 50
    q = spark.createDataFrame(list(enumerate(asked)), "query_no long, query string")
    got = S.search(q, None, index=index)
    assert got.groupBy("query_no", "strategy_no").count().agg(F.max("count")).first()[0] == 10
    by_text = {}
    for r in got.collect():
        by_text.setdefault((asked[r.query_no], r.strategy_no), set()).add((r.pos, r.project_id))
    assert {p for _, p in by_text["One shared title for all", 0]} == {f"{i:04d}" for i in range(400, 410)}
    assert {p for _, p in by_text["deep sea", 1]} == {f"{i:04d}" for i in range(800, 810)}


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


@pytest.mark.parametrize("per_cent", [50, 80, 85, 100])
def test_edit_join_finds_all_pairs(spark, per_cent):
    rng = random.Random(per_cent)
    words = ["".join(rnd for rnd in rng.choices("abcdeé", k=rng.randrange(1, 9))) for _ in range(30)]
    texts = [" ".join(rng.choices(words, k=rng.randrange(1, 7))) for _ in range(60)] + ["", "a", "ab", "a" * 40, "a" * 45]
    edited = []
    for t in texts:
        t = list(t)
        for _ in range(rng.randrange(5)):
            at = rng.randrange(len(t) + 1)
            t[at:at + rng.randrange(2)] = rng.choice(["", "x", "a"])
        edited.append("".join(t))
    frame = lambda ts: spark.createDataFrame([(t,) for t in ts] + [(None,)], "text string")
    got = {(r.left, r.right): r.distance for r in editjoin.edit_join(frame(texts + texts), frame(edited), per_cent).collect()}
    want = {(a, b): d for a in texts for b in edited if a and b
            for d in [levenshtein(a, b)] if 100 * (max(len(a), len(b)) - d) >= per_cent * max(len(a), len(b))}
    assert got == want and want


def test_rows_of_words_and_word_pairs_do_not_carry_their_text(spark, monkeypatch):
    title = " ".join(f"word{i}" for i in range(2000))
    q = spark.createDataFrame([(1, title), (2, title + " more")], "query_no long, query string")
    c = spark.createDataFrame([("1", title, None), ("2", "word1 word2", None)], "project_id string, title string, description string")
    sizes = []

    def kept(f):
        def g(texts, index):
            sizes.append(texts.selectExpr("max(length(cast(key as string)))").first()[0])
            return f(texts, index)
        return g

    for name in ("_set_pages", "_phrase_pages"):
        monkeypatch.setattr(S, name, kept(getattr(S, name)))
    got = {(r.query_no, r.strategy_no): (r.project_id, r.overlap) for r in S.search(q, c).collect()}
    assert got == {(1, 0): ("1", 2000), (1, 1): ("1", 2000), (2, 0): ("1", 2000)}
    assert len(sizes) == 2 and max(sizes) < 25  # each text is cut into 2,000 rows


def test_a_search_writes_no_descriptions(spark):
    rng = random.Random(6)
    noise = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=1_000_000))
    c = spark.createDataFrame([(str(i), f"deep sea probe {i}", noise()) for i in range(6)], "project_id string, title string, description string")
    q = spark.createDataFrame([(1, "deep sea probe 3")], "query_no long, query string")
    root = spark.conf.get("spark.checkpoint.dir").replace("file://", "")
    size = lambda: sum(os.path.getsize(f"{d}/{x}") for d, _, names in os.walk(root) for x in names)
    before = size()
    found = S.search(q, c).filter("strategy_no = 0 and pos = 0").first()
    assert (found.project_id, len(found.description)) == ("3", 1_000_000)
    assert size() - before < 2_000_000  # the descriptions have six; small tables have many files


def test_phrases_are_compared_where_the_titles_lie(spark):
    rng = random.Random(9)
    titles = [" ".join(rng.choices("abc", k=rng.randrange(3, 12))) for _ in range(150)] + ["a b c a b c a b c", "a b", "c a"]
    asked = sorted({" ".join(rng.choices("abc", k=n)) for n in (3, 4, 5, 6) for _ in range(12)} | {"a b c", "b c a b", "a b c d", "c c c c c c c c c"})
    c = spark.createDataFrame([(f"{i:03d}", t, "") for i, t in enumerate(titles)], "project_id string, title string, description string")
    q = spark.createDataFrame([(i, f'"{t}"') for i, t in enumerate(asked)], "query_no long, query string")
    got = {}
    for r in S.search(q, c).filter("strategy_no = 0").collect():
        got.setdefault(r.query_no, []).append((r.pos, r.project_id))
    for i, p in enumerate(asked):
        k = len(set(p.split()))
        held = sorted((-k / len(set(t.split())), len(t), f"{n:03d}") for n, t in enumerate(titles) if f" {p} " in f" {t} ")[:10]
        assert [x for _, x in sorted(got.get(i, []))] == [n for *_, n in held]
    index = S.build_index(c)
    phrases = spark.createDataFrame([(1, ["a", "b", "c", "a"], 3)], "key long, seq array<string>, n int")
    lines = S._phrase_pages(phrases, index)._jdf.queryExecution().optimizedPlan().toString().split("\n")
    # neither the titles nor the phrases go on to another join
    assert any("Join" in x and "md5" in x and "cid" in x for x in lines)
