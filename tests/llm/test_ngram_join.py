"""The n-gram join against all pairs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleaner.llm import common, ngram_join
from test_copies import brute_groups, family, make_rows, shingles


def got_groups(frame, k, per_cent):
    return ngram_join.join(frame, k, per_cent).collect()


@pytest.mark.parametrize("k,per_cent", [(4, 85), (1, 60)])
def test_groups_match_brute_force(spark, k, per_cent):
    rows = make_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for name in ("node", "gram", "band", "tile", "size", "component", "cluster", "row", "own", "bits"):
        docs = docs.withColumn(name, F.lit("clash"))
    want = brute_groups(rows, k, per_cent)
    got = got_groups(docs.repartition(5), k, per_cent)
    assert len(got) == len(rows)
    sizes = {}
    for d, t in rows:
        sizes.setdefault(d, set()).add(len(shingles(t, k)))
    for r in got:
        assert r.n_shingles in sizes[r.doc_id]
        assert r.component_id == (None if r.doc_id is None else want[r.doc_id])


def test_links_at_the_limit_and_chains(spark, monkeypatch):
    """Exact sizes of 85 of 100, chains of links, and blocks much smaller than the groups."""
    monkeypatch.setattr(ngram_join, "BLOCK", 7)
    rng = random.Random(8)
    base = [f"b{i}" for i in range(103)]  # 100 shingles of 4 words
    other = [f"d{i}" for i in range(103)]
    texts = [" ".join(base), " ".join(base[:88]), " ".join(base[15:])]  # 85 of them
    texts += [" ".join(other), " ".join(other[:87])]  # 84 of them
    step = [f"c{i}" for i in range(600)]
    texts += [" ".join(step[i:i + 200]) for i in range(0, 400, 14)]  # each links to the next only
    for n in (30, 60, 120):
        text = " ".join(f"x{rng.randrange(10 ** 6)}" for _ in range(n))
        texts += family(rng, text, 60, n // 20)
    passage = " ".join(f"p{i}" for i in range(60))
    texts += [passage + " " + " ".join(f"y{rng.randrange(10 ** 6)}" for _ in range(rng.choice([3, 6, 10, 30]))) for _ in range(120)]
    texts += ["a b c d e f g h i j", "A B C D E F G H I J", "a b c", "A  b\tc", "a b"]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    want = brute_groups(rows, 4, 85)
    got = {r.doc_id: r.component_id for r in got_groups(spark.createDataFrame(rows, "doc_id long, text string"), 4, 85)}
    assert got == want and want[1] == want[2] == 0 and want[4] != want[3]


def test_empty_table(spark):
    got = ngram_join.join(spark.createDataFrame([], "doc_id long, text string"))
    assert got.columns == ["doc_id", "n_shingles", "component_id"] and got.count() == 0


def test_bit_counts_bound_the_overlap():
    rng = np.random.default_rng(5)
    for _ in range(200):
        n, m, both = rng.integers(1, 4000, 3)
        values = np.unique(rng.integers(0, 1 << 63, n + m + both, dtype=np.uint64))
        both = min(both, len(values))
        a, b = np.sort(np.concatenate([values[:both], values[both::2]])), np.sort(np.concatenate([values[:both], values[both + 1::2]]))
        if not len(a) or not len(b):
            continue
        rows = ngram_join.same_width([ngram_join.bitmap(a), ngram_join.bitmap(b)])
        jaccard = both / len(values)
        for per_cent in (50, 85, 100):
            if 100 * both >= per_cent * len(values):
                assert ngram_join.may_link(rows[0], rows[1], np.int64(len(a)), np.int64(len(b)), per_cent)
        assert jaccard <= 1


def test_reduced_links_keep_components(spark):
    rng = random.Random(2)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(250)]
    links = [(a, b) for a, b in links if a != b] + [(1000 + i, 2000 + h) for i in range(50) for h in range(10)]
    nodes, labels = common.smallest_reachable(*np.array(links).T)
    root = dict(zip(nodes.tolist(), labels.tolist()))
    assert all(root[a] == root[b] for a, b in links) and all(root[r] == r <= n for n, r in root.items())
    frame = spark.createDataFrame(links, "node long, hub long").repartition(3)
    small = common.forest(frame, "node", "hub")
    assert small.count() < len(links)
    got = {r.node: r.component for r in common.components(small, "test-forest").collect()}
    assert got == root


def test_bounds_that_are_no_links_hide_no_pair(monkeypatch):
    """Two components: a rough pair of them is no link, another pair is; both must reach the exact comparison."""
    allowed = {(1, 11), (2, 12), (3, 12)}

    def fits(a, b, size_a, size_b, per_cent):
        other = np.atleast_1d(a[..., 0]).tolist()
        return np.array([tuple(sorted((x, int(b[0])))) in allowed for x in other], dtype=bool)

    monkeypatch.setattr(ngram_join, "may_link", fits)
    node = np.array([1, 2, 3, 11, 12])
    for own, lo, hi in (([0] * 5, 0, 0), ([0, 0, 0, 1, 1], 0, 1)):
        rows = {"node": node, "n_shingles": np.full(5, 9), "own": np.array(own), "component": np.array([1, 1, 3, 11, 11]),
                "lo": np.full(5, lo), "hi": np.full(5, hi), "bits": np.array([np.uint64([n]).tobytes() for n in node], dtype=object)}
        assert set(ngram_join.across(85, exact=False)(rows)) == allowed
