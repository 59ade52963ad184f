"""The keyword automaton against one search per keyword."""

import random
import time

from pyspark.sql import functions as F

from gleaner.functions import keywords as K
from gleaner.functions import text as TX


def brute(text, keywords):
    return 0 if text is None else sum(k in text.lower() for k in keywords)


def test_hits_equal_one_search_per_keyword(spark):
    rng = random.Random(4)
    piece = lambda n: "".join(rng.choices("abcé ß日", k=n))
    texts = [None, "", "a", "É", "x" * 5000 + "abc"] + [piece(rng.randrange(200)) for _ in range(200)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n long, t string").repartition(3)
    for keywords in ([], [""], ["a"], ["a", "ab", "abc", "bc", "c", "a", "", "é", "日a", "zzz"], [piece(rng.randrange(1, 6)) for _ in range(300)]):
        got = {r.n: (r.k, r.one) for r in df.select("n", K.keyword_hits(F.col("t"), keywords).alias("k"), TX.keyword_hits(F.col("t"), keywords[:40]).alias("one")).collect()}
        for i, t in enumerate(texts):
            assert got[i] == (brute(t, keywords), brute(t, keywords[:40]))


def test_ten_thousand_keywords_in_one_pass(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text")
    rng = random.Random(5)
    texts = {r.doc_id: r.text for r in docs.collect()}
    words = sorted({w for t in texts.values() for w in (t or "").lower().split()})
    keywords = (words + ["".join(rng.choices("etaoinsr", k=5)) for _ in range(10_000)])[:10_000]
    started = time.time()
    got = {r.doc_id: r.k for r in docs.select("doc_id", K.keyword_hits(F.col("text"), keywords).alias("k")).collect()}
    assert time.time() - started < 60
    assert got == {d: brute(t, keywords) for d, t in texts.items()}
