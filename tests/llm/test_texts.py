"""Scans of whole texts (licences, personal data, languages, quality, mixing) against brute force."""

import re
from collections import Counter
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleaner.llm import langid, licenses, mixing, pii, quality
from gleaner.llm.common import HashIndex, byte_values, hash_bytes, hash_spans, utf8, word_spans, WHITE

AWKWARD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "x"), (5, "Released under the MIT License. " * 3), (5, "Released under the MIT License. " * 3),
    (6, "wörd Wörd " * 40_000), (None, "null id, apache license version 2"), (7, "a" * 300_000),
]


@pytest.fixture(scope="module")
def awkward(spark):
    """Nulls, empty and long texts, a repeated row, and columns whose names operators also use inside."""
    docs = spark.createDataFrame(AWKWARD, "doc_id long, text string")
    for name in ("w", "h", "row", "node", "key", "kept", "rate", "lang", "labels", "n_words"):
        docs = docs.withColumn(name, F.lit("clash"))
    return docs


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")


def test_word_hashes_follow_words():
    import pyarrow as pa

    texts = ["a bb  a", None, "", "x\x0by é", "A bb"]
    offsets, data = utf8(pa.array(texts).slice(0))
    starts, ends, first = word_spans(offsets, data, WHITE)
    hashes = hash_spans(data, starts, ends, byte_values(fold_case=True))
    words = [w for t in texts for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")]
    assert np.diff(first).tolist() == [3, 0, 0, 3, 2]
    assert [hash_bytes(w.encode(), byte_values(True)) for w in words] == hashes.tolist()
    assert hashes[0] == hashes[2] == hashes[6] and len(set(hashes.tolist())) == 5 - 0
    index = HashIndex(np.unique(hashes))
    assert (np.unique(hashes)[index.find(hashes)] == hashes).all() and index.find(np.array([1], dtype=np.uint64))[0] == -1


# ---------------------------------------------------------------- licences

def phrase_places(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places = [(k, label) for phrase, label in licenses.PHRASES.items() for n in [len(phrase.split())]
              for k in range(len(words) - n + 1) if words[k:k + n] == phrase.split()]
    return len(words), sorted(places)


def test_licence_places_match_brute_force(spark, awkward, sf_small):
    docs = awkward.select("doc_id", "text").unionByName(spark.read.parquet(f"{sf_small}/documents.parquet").select((F.col("doc_id") + 10_000).alias("doc_id"), "text"))
    texts = [t for _, t in AWKWARD] + ["CC-BY-NC cc by nc! cc by", "under the\nMIT license under the mit license", "apache License, Version 2."]
    docs = docs.unionByName(spark.createDataFrame([(100_000 + i, t) for i, t in enumerate(texts)], "doc_id long, text string"))
    got, text_of = licenses.scan(docs).drop("spans").collect(), dict(docs.collect())
    for r in got:
        n, places = phrase_places(text_of[r.doc_id])
        at = [k for k, _ in places]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (n, len(at), min(at, default=None), max(at, default=None))
        assert r.base_labels == ",".join(sorted({x for _, x in places}))
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) | {""} and 0 <= r.score <= 1
    assert len(got) == docs.count() and licenses.scan(empty(spark)).count() == 0


def test_licence_templates_with_gaps(spark):
    text = ("x This program is free software: you can redistribute it and/or modify, indeed, it under the terms of the "
            "GNU General Public License y")
    r = licenses.scan(spark.createDataFrame([(1, text), (2, "you can see it under the sun")], "doc_id long, text string")).collect()
    assert r[0].labels == "gpl-3" and 0.8 <= r[0].score <= 1 and (r[0].spans[0].first, r[0].spans[0].label) == (1, "gpl-3")
    assert r[1].labels == "" and r[1].score == 0


def test_automaton_statistics_are_longest_known_runs():
    rng = np.random.default_rng(3)
    automaton, known = licenses.SuffixAutomaton(), []
    for name in range(6):
        known.append(rng.integers(0, 4, 9).tolist())
        automaton.add(known[-1], name)
    automaton.close()
    runs = {tuple(s[i:j]) for s in known for i in range(9) for j in range(i + 1, 10)}
    text = rng.integers(0, 5, 200).tolist()
    for i, (size, state) in enumerate(automaton.statistics(text)):
        want = max((n for n in range(1, 10) if n <= i + 1 and tuple(text[i + 1 - n:i + 1]) in runs), default=0)
        assert size == want
        ends = {(k, e) for k, s in enumerate(known) for e in range(want, 10) if want and s[e - want:e] == text[i + 1 - want:i + 1]}
        assert not want or automaton.ends[state] >= ends


# ---------------------------------------------------------------- personal data

def test_pseudonyms_keep_format_and_links(spark):
    text = ("mail Ann.Lee42@mail.example.com or +1 (555) 010-9999, card 4111 1111 1111 1111, again 4111-1111-1111-1111, "
            "ip 10.0.0.255, born 1984-02-29 or 29.02.1984, ssn 123-45-6789.")
    rows = [(1, text), (2, "ann 4111111111111111"), (3, "4111111111111112 999.1.1.1 1984-02-30 000-12-3456 v4.0."), (4, None), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("start", F.lit(1))
    found = pii.find(docs, "key").collect()
    by = Counter((r.doc_id, r.kind) for r in found)
    assert by == {(1, "email"): 1, (1, "phone"): 1, (1, "card"): 2, (1, "ipv4"): 1, (1, "date"): 2, (1, "ssn"): 1, (2, "card"): 1}
    assert {re.sub("[ -]", "", r.pseudonym) for r in found if r.kind == "card"}.__len__() == 1
    for r in found:
        old = dict(rows)[r.doc_id][r.start:r.end]
        if r.kind != "ipv4":
            assert re.sub("[0-9]", "0", re.sub("[a-z]", "a", re.sub("[A-Z]", "A", old.split("@")[0]))) == \
                re.sub("[0-9]", "0", re.sub("[a-z]", "a", re.sub("[A-Z]", "A", r.pseudonym.split("@")[0])))
        if r.kind == "card":
            d = re.sub("[ -]", "", r.pseudonym)
            assert pii.luhn_digit(d[:-1]) == d[-1] and d != "4111111111111111"
        if r.kind == "date":
            y, m, d = (map(int, r.pseudonym.split("-")) if "-" in r.pseudonym else reversed(list(map(int, r.pseudonym.split(".")))))
            assert date(y, m, d)
    new = {r.doc_id: r.text for r in pii.pseudonymise(docs, "key").collect()}
    assert new[3] == rows[2][1] and new[4] is None and new[5] == "" and "4111" not in new[1]
    assert pii.find(docs, "other").collect() != found and pii.find(empty(spark), "key").count() == 0
    assert {r.pseudonym for r in pii.find(spark.createDataFrame([(1, new[1])], "doc_id long, text string"), "key").collect() if r.kind == "card"}


def test_feistel_is_a_permutation_with_inverse():
    for size in (2, 10, 97, 1000):
        image = [pii.feistel(v, size, b"k", "t") for v in range(size)]
        assert sorted(image) == list(range(size))
        assert all(pii.feistel(w, size, b"k", "t", inverse=True) == v for v, w in enumerate(image))


# ---------------------------------------------------------------- languages

def test_language_of_held_out_rows(spark, awkward):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(docs)
    got = langid.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out")
    right = got.filter("lang = lang_pred").count()
    assert right >= 0.98 * got.count() > 0
    odd = {(r.doc_id, r.lang_pred) for r in langid.predict(awkward, model).collect()}
    assert {(1, "und"), (2, "und"), (3, "und")} <= odd and langid.predict(awkward, model).count() == len(AWKWARD)
    none = langid.predict(awkward, langid.fit(empty(spark))).collect()
    assert {(r.lang_pred, r.score) for r in none} == {("und", 0.0)}


def test_rare_languages_stay_predictable(spark):
    rows = [(i, f"the common words of row x{i % 7}", "aa") for i in range(6000)] + [(10_000 + i, "zeldzame taal hier", "bb") for i in range(12)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), sample_rows=100)
    assert model.langs == ["aa", "bb"] and model.predict(["zeldzame taal", "common words"])[0] == ["bb", "aa"]
    assert langid.rows_per_language([5, 1000, 2000], 105) == 50 and langid.rows_per_language([10] * 50, 100) == langid.LEAST_ROWS


# ---------------------------------------------------------------- quality

def measured(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(w[k:k + 8]) for k in range(len(w) - 7))
    marked = {k + i for k in range(len(w) - 7) if windows[tuple(w[k:k + 8])] > 1 for i in range(8)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(marked))


def test_base_measures_match_brute_force(spark, awkward, sf_small):
    extra = ["a b c d e f g h a b c d e f g h", "x " * 40, "l1\nl1\n \nl1\r\nl2", "é 😀 #%& <|>", "q w e r t y u i q w e r t y u i o p"]
    docs = (awkward.select("doc_id", "text").unionByName(spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text"))
            .unionByName(spark.createDataFrame([(10 ** 6 + i, t) for i, t in enumerate(extra)], "doc_id long, text string")))
    labels = spark.read.parquet(f"{sf_small}/labels.parquet")
    got = quality.judge(docs.select("doc_id", F.struct("*").alias("row"), "text"), quality.fit(docs, labels), "row").collect()
    assert len(got) == docs.count()
    for r in got:
        want = measured(r.row.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (r.base_failed and r.kept)


def test_quality_rejects_junk_and_keeps_clean(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    weights = quality.fit(docs, labels)
    got = quality.judge(docs, weights).join(labels, "doc_id").filter("not base_failed")
    assert got.filter("quality = 0 and kept").count() == 0
    assert got.filter("quality = 1 and not kept").count() == 0
    assert quality.judge(empty(spark), quality.fit(empty(spark), labels)).count() == 0
    assert not quality.fit(docs, labels.limit(0)).any()


# ---------------------------------------------------------------- mixing

def test_rates_reach_the_targets(spark):
    rng = np.random.default_rng(5)
    p = rng.dirichlet([0.3, 0.2, 0.2], 300)
    rows = [(i, int(n), *map(float, q)) for i, (n, q) in enumerate(zip(rng.integers(0, 900, 300), p))]
    members = spark.createDataFrame(rows, "doc_id long, n_tokens long, p_good double, p_low double, p_toxic double").cache()
    steps, reached, target = mixing.fit_rates(members, {"good": 0.8, "low": 0.15, "toxic": 0.05})
    assert np.allclose(reached, target, rtol=1e-3)
    got = np.array([r.r for r in members.orderBy("doc_id").select(mixing.rate(steps).alias("r")).collect()])
    assert (got >= 0).all() and (got == 0).any()
    n = np.array([r[1] for r in rows], dtype=float)
    assert np.allclose((got * n) @ p, target, rtol=1e-3)


def test_mixing_on_labelled_table_and_awkward_rows(spark, awkward):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = mixing.rates(docs.select("doc_id", "text"), labels)
    assert got.count() == docs.count() and got.filter("rate < 0 or abs(p_good + p_low + p_toxic - 1) > 1e-6").count() == 0
    odd = mixing.rates(awkward, labels)
    assert odd.count() == len(AWKWARD) and odd.filter("n_tokens = 0").count() == 3
    assert mixing.rates(empty(spark), labels).count() == 0
    same = mixing.resample(awkward, labels.limit(0))
    assert same.columns == awkward.columns and same.count() == len(AWKWARD)


def test_every_selected_feature_is_kept(spark):
    # 18,000 words that only bad rows have: more than 16,384, the number of hash slots there once were
    bad = [(i, " ".join(f"bad{k}" for k in range(18_000))) for i in range(60)]
    good = [(i, f"fine day number x{i}") for i in range(10_000, 10_600)]
    docs = spark.createDataFrame(bad + good, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 0, 0) for i, _ in bad] + [(i, 1, 0) for i, _ in good], "doc_id long, quality int, toxic int")
    model = mixing.fit(docs, labels)
    words = spark.createDataFrame([(f"bad{k}",) for k in range(18_000)], "w string").select(F.xxhash64("w").alias("h")).toPandas()["h"]
    assert np.isin(words, model.keys).all()
    rows = model.table().to_pylist()
    assert sorted(e["h"] for slot in rows for e in slot) == sorted(model.keys) and all(e["h"] % len(rows) == k for k, slot in enumerate(rows) for e in slot)
    # levels against a plain sum
    odds = dict(zip(model.keys.tolist(), zip(*(model.odds[d] for d in mixing.DOMAINS))))
    f = [[], [int(words[0])], [int(x) for x in words[:3]], [1, int(words[5]), 2]]
    got = [r.cell for r in model.cells(spark.createDataFrame([(k, x) for k, x in enumerate(f)], "k int, f array<long>")).orderBy("k").collect()]
    sums = [[sum(odds.get(h, (0, 0, 0))[d] for h in x) for d in range(3)] for x in f]
    assert got == [sum(4 ** (2 - d) * sum(s[d] >= x for x in mixing.LEVELS) for d in range(3)) for s in sums]


def test_unseen_levels_fall_back_to_coarser_ones(spark):
    # labelled rows: plain, low and toxic ones; none is low and toxic at once
    kinds = {"plain": (1, 0, "calm"), "low": (0, 0, "spamword cheapword junkword"), "toxic": (1, 1, "vileword cruelword grimword")}
    rows, labels = [], []
    for i in range(1300):
        kind = "plain" if i < 900 else "low" if i < 1200 else "toxic"
        rows.append((i, f"{kinds[kind][2]} row n{i}"))
        labels.append((i, *kinds[kind][:2]))
    rows += [(5000, "vileword cruelword grimword and spamword too n0"), (5001, "calm row new")]
    model = mixing.fit(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    docs = spark.createDataFrame(rows[-2:], "doc_id long, text string")
    cells = {r.doc_id: r.cell for r in model.cells(docs.select("doc_id", mixing.features(mixing.words(F.col("text"))).alias("f"))).collect()}
    assert cells[5000] not in model.shares and cells[5001] in model.shares
    got = {r.doc_id: r for r in mixing.memberships(docs, model).collect()}
    assert got[5000].p_toxic + got[5000].p_low > 0.9 and got[5000].p_toxic > 5 * model.other[2]
    assert got[5001].p_good > 0.9
    # toxic evidence of a level above all labelled ones
    top = {c: n for c, n in model.coarser.items() if mixing._digits(c)[0] == 0 and mixing._digits(c)[1] == 0}
    assert [round(sum(p), 9) for p in model.coarser.values()] == [1.0] * 64 and top[3][2] > 0.5
    none = mixing._coarser({0: np.array([90.0, 9.0, 1.0])}, np.array([90.0, 9.0, 1.0]))
    assert none[3][2] > none[2][2] > none[1][2] > 0.01 and none[3][2] > 0.8


def test_resampled_totals_meet_the_targets(spark):
    rng = np.random.default_rng(6)
    rows, labels = [], []
    for i in range(6000):
        bad = i % 3 == 0
        rows.append((i, f"{'spamword cheapword' if bad else 'calm'} " + " ".join(f"w{x}" for x in rng.integers(0, 50, 8))))
        labels.append((i, 0 if bad else 1, 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    weights = {"good": 0.7, "low": 0.362, "toxic": 0.0}  # the low rows' rate comes to about 0.93
    members = mixing.memberships(docs, mixing.fit(docs, labels)).cache()
    _, reached, target = mixing.fit_rates(members, weights)
    assert np.allclose(reached, target, rtol=1e-3)
    left = mixing.resample(docs, labels, weights).select("doc_id").join(members, "doc_id")
    got = left.agg(*(F.sum(F.col("n_tokens") * F.col(f"p_{d}")) for d in mixing.DOMAINS)).first()
    assert abs(got[0] / target[0] - 1) < 0.02 and abs(got[1] / target[1] - 1) < 0.03


# ---------------------------------------------------------------- against brute force

def test_log_ratios_match_brute_force(spark, awkward, sf_small):
    """The n-gram ratio, recomputed word by word with the hash function's own library."""
    import struct

    import xxhash

    def hashed(*parts):
        seed = 42
        for p in parts:
            seed = xxhash.xxh64_intdigest(struct.pack("<i", p) if isinstance(p, int) else p.encode(), seed=seed)
        return seed % quality.BUCKETS

    def grams(words):
        out, before = [], None
        for w in words:
            joint = hashed(3) if before is None else hashed(4) if before == w else hashed(before[-1:], w[:1], 2)
            out += [hashed(w), hashed(w[-2:], 1), joint]
            before = w
        return out

    given = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_small}/labels.parquet").unionByName(
        spark.createDataFrame([(1, 1, 0), (1, 1, 0), (6, 1, None), (None, 1, 0), (999_999, 0, 1)], "doc_id long, quality int, toxic int"))
    docs = given.select((F.col("doc_id") + 100).alias("doc_id"), "text").unionByName(awkward.select("doc_id", "text").filter("doc_id is null or doc_id <> 7"))
    labels = labels.withColumn("doc_id", F.when(F.col("doc_id") < 10, F.col("doc_id")).otherwise(F.col("doc_id") + 100))
    rows = [(r.doc_id, re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in docs.collect()]
    said = {}
    for r in labels.collect():
        said.setdefault(r.doc_id, []).append(r.quality == 1 and not r.toxic)
    raw, target = Counter(), Counter()
    for d, words in rows:
        g = grams(words)
        raw.update(g)
        if d is not None and all(said.get(d, [False])):
            target.update(g)
    n, t, b = sum(raw.values()), sum(target.values()), quality.BUCKETS
    weight = lambda x: np.log((target[x] + 1) / (t + b)) - np.log((raw[x] + 1) / (n + b))
    want = sorted(((d is not None, d or 0, len(w)), sum(map(weight, grams(w))) / (3 * len(w) + quality.SHRINK)) for d, w in rows)
    got = sorted(((r.doc_id is not None, r.doc_id or 0, r.n_words), r.llr, r.kept, r.base_failed) for r in quality.judge(docs, quality.fit(docs, labels)).collect())
    assert t and [x[0] for x in got] == [x[0] for x in want]
    for (_, llr, kept, failed), (_, expected) in zip(got, want):
        assert abs(llr - expected) < 1e-4
        assert kept == (not failed and llr >= quality.LEAST_SCORE)
    kept = [tuple(r) for r in quality.kept_rows(docs, quality.fit(docs, labels)).collect()]
    assert len(kept) == sum(x[2] for x in got)


def test_entries_count_in_every_language(spark):
    """A word that only one language keeps still has its count in the others."""
    rows = [(i, "alpha alpha beta", "aa") for i in range(40)] + [(100 + i, "gamma gamma gamma delta delta", "bb") for i in range(40)]
    rows += [(1000 + i, "alpha", "bb") for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").filter(~langid.held_out(F.col("doc_id")))
    model = langid.fit(docs, entries=1)
    words = Counter((r.lang, w) for r in docs.collect() for w in r.text.split())
    at = model.index[True].find(hash_spans(*langid_word("alpha"), langid._tables()[1]))
    total = {lang: sum(n for (x, _), n in words.items() if x == lang) for lang in ("aa", "bb")}
    for k, lang in enumerate(model.langs):
        want = np.log((words[lang, "alpha"] + langid.SMOOTHING) / (total[lang] + langid.SMOOTHING * 2))
        assert abs(model.logs[True][at[0], k] - want) < 1e-5


def langid_word(word):
    chars, _ = langid.letters([word])
    starts, ends = langid.word_bounds(chars)
    return chars, starts, ends


def test_pseudonyms_are_undone_by_the_inverse(monkeypatch, spark):
    """Long texts of random values: the inverse permutation gives every text back, and equal values stay equal."""
    rng = np.random.default_rng(8)
    digits = lambda n: "".join(map(str, rng.integers(0, 10, n)))

    def value():
        body = str(rng.integers(1, 10)) + digits(14)
        day = date.fromordinal(int(rng.integers(date(1900, 1, 1).toordinal(), date(2100, 1, 1).toordinal())))
        return [body + pii.luhn_digit(body), f"+{rng.integers(1, 999)} {digits(3)}-{digits(3)}-{digits(4)}", day.isoformat(), f"{day:%d.%m.%Y}", f"{day:%m/%d/%Y}",
                ".".join(str(x) for x in rng.integers(0, 256, 4)), f"{rng.integers(1, 666):03d}-{rng.integers(1, 100):02d}-{rng.integers(1, 10000):04d}",
                f"user{digits(3)}@host.example.org", "12.13", "0000-00-00", "999-99-9999"][rng.integers(0, 11)]

    def replaced(text):
        out, last = [], 0
        for start, end, _, new in pii.finds(text, b"k" * 32):
            out += [text[last:start], new]
            last = end
        return "".join([*out, text[last:]])

    texts = [" and ".join(value() for _ in range(n)) for n in (1, 5, 50, 2000)]
    new = [replaced(t) for t in texts]
    assert all(a != b for a, b in zip(texts[1:], new[1:]))
    forward = pii.feistel
    monkeypatch.setattr(pii, "feistel", lambda v, s, k, t: forward(v, s, k, t, inverse=True))
    assert [replaced(t) for t in new] == texts
    docs = spark.createDataFrame([(1, texts[3]), (1, texts[3]), (None, texts[2]), (3, None), (4, "")], "doc_id long, text string").withColumn("start", F.lit("clash"))
    got = Counter((r.doc_id, r.start, r.end, r.kind, r.pseudonym) for r in pii.find(docs, "key").collect())
    assert {n for (d, *_), n in got.items() if d == 1} == {2} and sum(d is None for d, *_ in got) == len(pii.finds(texts[2], b"k" * 32))
