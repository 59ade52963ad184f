"""Edit distance in bands, and joins by it, against Spark's own over the whole square."""

import random

from pyspark.sql import functions as F

from gleaner.functions.editscript import distance
from gleaner.functions.text import BANDS, LONG_TEXT, SHORT_TEXT, edit_distance, edit_distance_within
from gleaner.operators import editjoin
from gleaner.operators.editjoin import edit_join


def text(rng, n):
    return "".join(rng.choice("abcdeé ") for _ in range(n))


def changed(rng, a, k):
    b = list(a)
    for _ in range(k):
        at = rng.randrange(len(b) + 1)
        b[at:at + rng.randrange(2)] = rng.choice(["", "z"])
    return "".join(b)


def test_bands_give_the_whole_distance(spark):
    rng = random.Random(3)
    rows = [(a, changed(rng, a, k)) for n in (0, 5, SHORT_TEXT, SHORT_TEXT + 1, 1500)
            for a in [text(rng, n)] for k in (0, 1, BANDS[0], BANDS[0] * 3, BANDS[1] * 3)] + [(text(rng, 1500), text(rng, 1400)), (None, "a")]
    df = spark.createDataFrame(rows, "a string, b string")
    got = df.select("a", "b", edit_distance(F.col("a"), F.col("b")).alias("d"), F.levenshtein("a", "b").alias("whole")).collect()
    assert all(r.d == r.whole for r in got) and len({r.d for r in got}) > 5


def test_texts_of_the_join_do_not_pass_through_the_driver(spark):
    rng = random.Random(4)
    names = [text(rng, 200) for _ in range(4)]
    frame = spark.createDataFrame([(x,) for x in names], "text string")
    out = edit_join(frame, frame)
    assert {(r.left, r.right) for r in out.collect() if r.distance == 0} == {(x, x) for x in names}
    # a size estimate cannot turn the two joins that carry texts into broadcasts
    assert out._jdf.queryExecution().optimizedPlan().toString().count("strategy=merge") == 2


def test_long_texts_are_compared_by_rows(spark):
    rng = random.Random(5)
    rows = [(a, changed(rng, a, k)) for n in (LONG_TEXT - 3, LONG_TEXT, LONG_TEXT + 1, 3000)
            for a in [text(rng, n)] for k in (0, 2, 40, 2000)] + [(text(rng, LONG_TEXT + 1), b) for b in (None, "", "é")]
    rows += [(b, a) for a, b in rows]
    df = spark.createDataFrame(rows, "a string, b string")
    got = df.select(edit_distance(F.col("a"), F.col("b")).alias("d"), F.levenshtein("a", "b").alias("whole")).collect()
    assert [r.d for r in got] == [r.whole for r in got]
    # the square of these has 1.6 billion cells
    a = text(rng, 40_000)
    assert 0 < distance(a, changed(rng, a, 500)) <= 500 < distance(a, text(rng, 40_000))


def test_a_limit_only_ends_the_comparison_early(spark):
    rng = random.Random(6)
    rows = [(a, b, distance(a, b)) for n in (0, 1, 40, 200, 700, 2000) for a in [text(rng, n)]
            for b in [changed(rng, a, k) for k in (0, 1, 9, 60, 300)] + [text(rng, n), text(rng, n + 50), ""]]
    for a, b, d in rows:
        for limit in (0, d - 1, d, d + 1, len(a)):
            assert distance(a, b, limit) == (d if d <= limit else None)
    limits = [(a, b, k, d) for a, b, d in rows for k in (0, max(d - 1, 0), d, d + 5)]
    df = spark.createDataFrame(limits, "a string, b string, most int, whole int")
    for r in df.withColumn("d", edit_distance_within(F.col("a"), F.col("b"), F.col("most"))).collect():
        assert r.d == (r.whole if r.whole <= r.most else None)
    # the whole square of these takes seconds
    far = distance(text(rng, 30_000), text(rng, 30_000), 100)
    assert far is None


def test_pieces_of_texts_are_not_broadcast_nor_carry_their_text(spark):
    rng = random.Random(7)
    frame = spark.createDataFrame([(k, text(rng, 3000)) for k in range(3)], "id long, text string")
    met = editjoin._met(editjoin.segments(frame, 85), editjoin.substrings(frame, 85), 85, longer=False)
    plan = met._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    for rows in (editjoin.segments, editjoin.substrings):
        assert dict(rows(frame, 85).dtypes)["piece"] == "bigint"


def test_pieces_cover_a_text_across_blocks(spark):
    rng = random.Random(8)
    rows = [(n, text(rng, n)) for n in (1, 2, 7, 255, 256, 257, 262, 600)]
    frame = spark.createDataFrame(rows, "id long, text string")
    whole = {(n, a) for n, a in rows}
    sub, seg = ([tuple(r) for r in f(frame, 85).collect()] for f in (editjoin.substrings, editjoin.segments))
    own = spark.createDataFrame([(n, at, size, a[at:at + size]) for n, a in whole for size in range(1, 12) for at in range(n - size + 1)], "n int, at int, size int, s string")
    known = {(r.n, r.at, r.h): r.size for r in own.select("n", "at", "size", F.xxhash64("s").alias("h")).collect()}
    sizes = {}
    for id_, n, piece, at in sub:
        sizes.setdefault((n, known[n, at, piece]), []).append(at)
    assert all(sorted(ats) == list(range(n - size + 1)) for (n, size), ats in sizes.items())
    for n, _ in rows:  # the segments are the text, cut once
        cuts = sorted((at, known[n, at, piece]) for _, m, piece, at in seg if m == n)
        assert cuts[0][0] == 0 and all(at + size == after for (at, size), (after, _) in zip(cuts, [*cuts[1:], (n, 0)]))
