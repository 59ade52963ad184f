"""Periodic runs against a comparison of every word with every later one."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleaner.llm import repetition as R
from gleaner.llm.common import mix64

WORD = r"[^\x20\x09-\x0D]+"


def brute_runs(w, least=24, periods=3):
    """Stretches that no neighbour extends, per period; of one stretch the smallest period."""
    out = {}
    for q in range(1, len(w) // periods + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, periods * q):
                out.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((a, b - a, q) for (a, b), q in out.items())


def random_words(rng):
    n, k = rng.choice([0, 5, 24, 25, 40, 100, 300, 500]), rng.choice([1, 2, 3, 50, 1000])
    w = [rng.randrange(k) for _ in range(n)]
    for _ in range(rng.randrange(4) if n else 0):
        a = rng.randrange(n)
        p = 1 + rng.randrange(max(1, (n - a) // 3))
        for i in range(a, a + rng.randrange(n - a + 1)):
            w[i] = w[a + (i - a) % p]
    return w


@pytest.mark.parametrize("least,periods", [(24, 3), (2, 2), (6, 2), (24, 4)])
def test_runs_match_brute_force(least, periods):
    rng = random.Random(least + periods)
    for _ in range(25):
        texts = [random_words(rng) for _ in range(12)]
        flat = mix64(np.array([x for w in texts for x in w], dtype=np.uint64) + np.uint64(7))
        first = np.concatenate([[0], np.cumsum([len(w) for w in texts])])
        assert R.runs_of_texts(flat, first, least, periods) == [brute_runs(w, least, periods) for w in texts]


def test_words_with_many_squares():
    a, b = [0], [0, 1]
    while len(b) < 1500:
        a, b = b, b + a
    swaps = [bin(i).count("1") % 2 for i in range(2048)]  # without any cube
    for w in (b, swaps, [0] * 1000, [0, 0, 1] * 300):
        got = R.runs_of_texts(mix64(np.array(w, dtype=np.uint64)), np.array([0, len(w)]), 4, 2)
        assert got == [brute_runs(w, 4, 2)]
    assert not R.find_runs(mix64(np.array(swaps, dtype=np.uint64)), 2048)


def test_long_texts_stay_cheap():
    for k in (1, 2, 10 ** 5):
        values = mix64(np.random.default_rng(0).integers(0, k, 400_000).astype(np.uint64))
        assert len(R.find_runs(values, len(values))) < 100
    period = np.tile(np.random.default_rng(1).integers(0, 10 ** 6, 70_001), 4)
    assert R.find_runs(mix64(period.astype(np.uint64)), len(period)) == [(0, len(period), 70_001)]


def expected(doc_id, text):
    w = re.findall(WORD, text or "")
    n = len(w)
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    runs = brute_runs(w)
    gone = {i for s, l, q in runs for i in range(s + q, s + l)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None,) * 3)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), *best, best[1] and 1000 * best[1] // best[2], sha("".join(f"{s},{l},{q}\n" for s, l, q in runs)),
            sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_digests_match_brute_force(spark, sf_small):
    rng = random.Random(3)
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect() if len(r.text) < 20_000]
    docs += [(10_000 + i, " ".join(f"w{x}" for x in random_words(rng))) for i in range(150)]
    docs += [(20_001, None), (20_002, ""), (20_003, " \n\t"), (None, "a b " * 30), (None, None), (20_004, "word " * 3000),
             (20_005, "é\x0bè\x1cü " * 50), (10_000, docs[0][1]), (10_000, docs[0][1])]
    planted = [i for i in range(30_000, 31_000) if zlib.crc32(str(i).encode()) % 10 == 0][:40]
    docs += [(i, " ".join(f"v{rng.randrange(60)}" for _ in range(rng.choice([1, 2, 30, 200])))) for i in planted]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    for name in ("w", "g", "a", "p", "spans", "best", "collapsed", "start"):
        frame = frame.withColumn(name, F.lit("clash"))
    got = [tuple(r) for r in R.digests(R.repetitions(R.with_planted_runs(frame.repartition(4)))).collect()]
    assert sorted(got, key=repr) == sorted((expected(*d) for d in docs), key=repr)
    assert sum(r[1] > 0 for r in got) > 50
    none = R.digests(R.repetitions(R.with_planted_runs(frame.limit(0))))
    assert none.count() == 0 and none.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
