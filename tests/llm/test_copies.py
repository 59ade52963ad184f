"""Near-duplicates, benchmark items and the pipeline against brute force."""

import random
import re
from itertools import combinations

import numpy as np
from pyspark.sql import functions as F

from gleaner.llm import decontaminate, near_dedup


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def brute_groups(rows, k, per_cent):
    """doc_id -> (sizes of its rows' sets, smallest doc_id reachable)."""
    root = {d: d for d, _ in rows if d is not None}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    sets = [(d, shingles(t, k)) for d, t in rows if d is not None]
    for (a, x), (b, y) in combinations(sets, 2):
        if x and 100 * len(x & y) >= per_cent * len(x | y):
            lo, hi = sorted((find(a), find(b)))
            root[hi] = lo
    return {d: find(d) for d in root}


def family(rng, base, n, most):
    """Copies of a text with up to ``most`` words replaced."""
    out = []
    for _ in range(n):
        w = base.split()
        for _ in range(rng.randint(0, most)):
            w[rng.randrange(len(w))] = f"edit{rng.randrange(10 ** 6)}"
        out.append(" ".join(w))
    return out


def make_rows():
    rng = random.Random(4)
    text = lambda n: " ".join(f"w{rng.randrange(400)}" for _ in range(n))
    shared = text(60)
    texts = [None, "", "  ", "one", "One", "two words", "a b c", "A  b\nc", "a b c d e f g", "a b c d e f g h", text(30_000)]
    texts += family(rng, text(150), 120, 12) + family(rng, text(40), 30, 3) + family(rng, text(12), 20, 1)
    texts += [text(20) + " " + shared + " " + text(rng.randrange(10, 60)) for _ in range(60)]
    texts += [text(rng.randrange(3, 80)) for _ in range(60)]
    texts += [texts[15]] * 40  # a hot group of exact copies
    rng.shuffle(texts)
    rows = list(enumerate(texts)) + [(3, texts[3]), (7, texts[20]), (None, texts[15]), (None, None)]
    return rows


def test_groups_match_brute_force(spark):
    rows = make_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for name in ("node", "size", "band", "component", "kept", "row"):
        docs = docs.withColumn(name, F.lit("clash"))
    want = brute_groups(rows, 3, 85)
    got = near_dedup.groups(docs.repartition(5), 3, 85).collect()
    assert len(got) == len(rows)
    sizes = {}
    for d, t in rows:
        sizes.setdefault(d, set()).add(len(shingles(t, 3)))
    for r in got:
        assert r.n_shingles in sizes[r.doc_id]
        assert r.component_id == (None if r.doc_id is None else want[r.doc_id])
        assert r.kept == (r.doc_id is None or r.component_id == r.doc_id)
    left = near_dedup.keep_one(docs, 3, 85)
    kept = [r.doc_id for r in left.collect()]
    assert sorted(d for d in kept if d is not None) == sorted(set(want.values())) and kept.count(None) == 2
    assert near_dedup.groups(docs.limit(0)).count() == 0


def test_other_limits_match_brute_force(spark):
    rows = make_rows()[:200]
    want = brute_groups(rows, 5, 80)
    got = near_dedup.groups(spark.createDataFrame(rows, "doc_id long, text string"), 5, 80)
    assert {r.doc_id: r.component_id for r in got.collect() if r.doc_id is not None} == want


def test_register_estimates_are_close():
    rng = np.random.default_rng(0)
    for share in (0.3, 0.6, 0.9):
        both = rng.integers(0, 1 << 63, int(4000 * share)).astype(np.uint64)
        a, b = (np.unique(np.concatenate([both, rng.integers(0, 1 << 63, 2000 - len(both) // 2).astype(np.uint64)]) * np.uint64(2)) for _ in "ab")
        regs = near_dedup.registers_of([a, b])
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        near, used = near_dedup.estimate(regs[0], regs[1], np.array(len(a)), np.array(len(b)))
        assert used == near_dedup.BUCKETS and abs(near - true) < 0.15
        assert near_dedup.may_link(regs[0], regs[1], np.array(len(a)), np.array(len(b)), 85) or true < 0.85
    assert (near_dedup.densified(near_dedup.registers_of([np.array([5], dtype=np.uint64)])) != 0xFFFF).all()


# ---------------------------------------------------------------- benchmark

def similarity(items, window, item):
    """Weighted similarity of two word lists, straight from the definition."""
    grams = lambda w: [tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))]
    held = [set(grams(x)) for x in items]
    weight = lambda g: 1 / max(1, sum(g in h for h in held))
    a, b = grams(window), grams(item)
    both = {*a, *b}
    return sum(weight(g) * min(a.count(g), b.count(g)) for g in both) / sum(weight(g) * max(a.count(g), b.count(g)) for g in both)


def test_items_found_as_by_brute_force(spark):
    rng = random.Random(9)
    text = lambda n: " ".join(f"v{rng.randrange(3000)}" for _ in range(n))
    items = [(i, text(n)) for i, n in enumerate((15, 22, 40, 40, 3))]
    items.append((5, items[2][1].rsplit(" ", 4)[0] + " " + text(4)))
    edited = items[3][1].split()
    edited[1] = "other"
    bodies = [text(100), text(30) + " " + items[0][1].upper() + ". " + text(10), text(5) + " " + " ".join(edited) + " " + text(9),
              items[1][1], " ".join(items[2][1].split()[:20]) + " " + text(50), items[4][1], None, "", text(4) + " " + items[2][1] + " x " + items[2][1],
              " ".join(items[1][1].split()[1:])]
    docs = spark.createDataFrame(list(enumerate(bodies)) + [(3, bodies[3])], "doc_id long, text string").withColumn("item_id", F.lit("clash"))
    bench = spark.createDataFrame([*items, (0, items[0][1]), (None, None), (8, "")], "item_id long, text string").withColumn("doc_id", F.lit(1))
    words = {i: re.findall("[a-z0-9]+", t) for i, t in items}
    want = set()
    for d, body in enumerate(bodies):
        w = re.findall("[a-z0-9]+", (body or "").lower())
        for i, item in words.items():
            n = min(len(item), len(w))
            if w and max(similarity(list(words.values()), w[k:k + n], item) for k in range(len(w) - n + 1)) >= 0.8:
                want.add((d, i))
    got = decontaminate.matches(docs, bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want and len(got) == len(want) + 1
    assert all(0.8 <= r.similarity <= 1 + 1e-9 for r in got)
    clean = decontaminate.drop_contaminated(docs, bench)
    assert clean.columns == docs.columns
    assert sorted(r.doc_id for r in clean.collect()) == sorted(set(range(len(bodies))) - {d for d, _ in want})
    assert decontaminate.matches(docs.limit(0), bench).count() == 0 and decontaminate.matches(docs, bench.limit(0)).count() == 0


def test_short_items_found_inside_longer_texts(spark):
    rng = random.Random(5)
    items = [(1, "Zeta"), (2, "ask me, now"), (3, "one two three four"), (4, "now"), (5, "v1 v2"), (6, "ASK ME NOW"), (None, "zeta")]
    bodies = [" ".join(f"v{rng.randrange(6)}" for _ in range(60)) + " ask me now. " + "now zeta", "ask me now", "v0 zeta v1 v2", "zeta", "one two three",
              "x one two three four", "one two three four", None, "", "me ask now v2 v1", "v1 v2 v1 v2 v1 v2", "now " * 9000]
    words = lambda t: re.findall("[a-z0-9]+", (t or "").lower())
    want = set()
    for d, body in enumerate(bodies):
        w = words(body)
        for i, item in items:
            n = len(words(item))
            at = [k for k in range(len(w) - n + 1) if w[k:k + n] == words(item)]
            want |= {(d, i, at[0], n, 1.0)} if at else set()
    docs = spark.createDataFrame(list(enumerate(bodies)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.matches(docs, bench).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert {r.doc_id for r in decontaminate.drop_contaminated(docs, bench).collect()} == set(range(len(bodies))) - {r[0] for r in want}


def test_passes_do_not_change_results(spark, monkeypatch):
    rng = random.Random(21)
    text = lambda n: [f"u{rng.randrange(3000)}" for _ in range(n)]
    common = text(14)
    items = [(i, " ".join(text(16) + common)) for i in range(40)]
    bodies = []
    for _, t in items:
        w = t.split()
        w[rng.choice((3, 5, 20, 27))] = "edit"
        bodies.append(" ".join(text(8) + w + text(8)))
    docs = spark.createDataFrame(list(enumerate(bodies)), "doc_id long, text string")
    bench = spark.createDataFrame(items + items[:3], "item_id long, text string")
    rows = lambda: sorted((r.doc_id, r.item_id, r.first_word, r.n_words, round(r.similarity, 9)) for r in decontaminate.matches(docs, bench).collect())
    whole = rows()
    words = [t.split() for _, t in items]
    assert whole and all(abs(s - similarity(words, bodies[d].split()[p:p + n], words[i])) < 1e-8 for d, i, p, n, s in whole)
    monkeypatch.setattr(decontaminate, "PASS_BYTES", 1500)
    assert len(list(decontaminate.passes(bench))) > 3
    assert rows() == whole


def test_multi_index_finds_all_within_radius():
    rng = np.random.default_rng(7)
    words = [" ".join(f"t{x}" for x in rng.integers(0, 500, 20)) for _ in range(50)]
    bench = decontaminate.Benchmark(list(enumerate(words)))
    prints = bench.prints[rng.integers(0, 50, 200)].copy()
    for k in range(200):
        for bit in rng.choice(64, rng.integers(0, 30), replace=False):
            prints[k] ^= np.uint64(1) << np.uint64(bit)
    got = set(bench.near(prints))
    far = np.bitwise_count(prints[:, None] ^ bench.prints[None])
    assert got == {(int(a), int(b)) for a, b in zip(*np.nonzero(far <= decontaminate.RADIUS))}


# ---------------------------------------------------------------- pipeline

def test_pipeline_stages(spark, sf_small):
    import corpus_pipeline
    from gleaner.llm import mixing, quality
    from gleaner.llm.common import stored, table

    docs, kept = table(spark, sf_small, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stored(stage(spark, docs, sf_small), "stage")
        if name != "token ids":
            assert docs.columns == before.columns
        kept.append({r.doc_id for r in docs.select("doc_id").collect()})
    all_ids = {r.doc_id for r in table(spark, sf_small, "documents").select("doc_id").collect()}
    assert all(b <= a for a, b in zip([all_ids, *kept], kept)) and kept[4] == kept[3]
    texts = {r.doc_id: r.text for r in table(spark, sf_small, "documents").collect()}
    groups = brute_groups([(d, texts[d]) for d in sorted(kept[0])], 5, 80)
    assert kept[1] == set(groups.values())
    bench = [re.findall("[a-z0-9\x80-\U0010ffff]+", r.text.lower()) for r in table(spark, sf_small, "benchmark").collect()]
    for d in kept[2]:
        w = re.findall("[a-z0-9\x80-\U0010ffff]+", texts[d].lower())
        assert not any(w[k:k + len(i)] == i for i in bench for k in range(len(w) - len(i) + 1))
    assert quality.LEAST_SCORE < 0 and mixing.WEIGHTS["good"] > 0.9


def test_entry_lists_these_queries():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert {"pipeline"} <= names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14))
    assert set(entry.oracle_sql()) <= names


def test_pipeline_takes_awkward_rows(spark, sf_small, tmp_path):
    """Null ids, null and long texts, repeated rows and columns whose names the stages use inside."""
    import corpus_pipeline
    from gleaner.llm.common import stored, table

    given = table(spark, sf_small, "documents")
    prose = [r.text for r in given.filter("length(text) between 800 and 3000").orderBy("doc_id").limit(40).collect()]
    rows = [(10_000 + i, t) for i, t in enumerate(prose)] + [(None, prose[0]), (None, prose[0]), (10_001, prose[1]), (10_001, prose[1]), (10_002, prose[3])]
    rows += [(20_000, None), (20_001, ""), (20_002, " \n"), (20_003, "word " * 60_000), (20_004, " ".join(prose) * 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for name in ("row", "kept", "w", "g", "node", "key", "copies", "rate", "cell", "h3"):
        docs = docs.withColumn(name, F.lit("clash"))
    docs = docs.repartition(4)
    empty = docs.limit(0)
    ids = []
    for name, stage in corpus_pipeline.STAGES:
        out = stored(stage(spark, docs, sf_small), "awkward")
        none = stored(stage(spark, empty, sf_small), "awkward-none")
        assert none.count() == 0 and none.columns == out.columns
        if name != "token ids":
            assert out.columns == docs.columns and out.filter("copies <> 'clash'").count() == 0
        docs, empty = out, none
        ids.append(sorted((r.doc_id for r in docs.select("doc_id").collect()), key=str))
    assert not {20_000, 20_001, 20_002, 20_003} & set(ids[0])
    assert ids[1].count(None) == 2 and ids[1].count(10_001) <= 1  # rows without an id have no links
    assert len(ids[4]) == len(ids[3])
