"""Archives, token shards and URL rules: exact round trips."""

import base64
import gzip
import hashlib
import os
import re
import struct
import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gleaner.llm import token_store, url_rules, warc
from gleaner.llm.common import stored

PATH = str(public_tokenizers.path("word_bpe_49k.json"))
PAGES = [(1, "http://a/x y", "<p>é</p>"), (2, None, None), (3, "http://b/", ""), (4, "http://c", "<p>é</p>"), (4, "http://c", "<p>é</p>"),
         (5, "x", "HTTP/1.1 200\r\n\r\nbody\r\n\r\n"), (6, "y", "z" * 3_000_000), (None, "http://n", "<p>é</p>"), (7, "", "line\n" * 3)]


def test_arc_to_warc_round_trip(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("arc", F.lit(1)).withColumn("offset", F.lit("x"))
    got = warc.round_trip(pages).collect()
    assert len(got) == len(PAGES)
    first = {}
    for page, _, html in sorted(PAGES, key=lambda p: (p[0] is None, p[0] or 0)):
        first.setdefault(html or "", page)
    texts = {p: h or "" for p, _, h in PAGES}
    for r in got:
        body = texts[r.page_id].encode()
        assert (r.payload_bytes, r.payload_digest) == (len(body), base64.b32encode(hashlib.sha1(body).digest()).decode())
        assert (r.record_type == "revisit") == (r.refers_to is not None)
        if r.record_type == "revisit":
            assert r.refers_to == first[texts[r.page_id]]
    assert sorted((r.page_id or 0) for r in got if r.record_type == "response") == sorted(v or 0 for v in first.values())
    urls = {r.page_id: r.url for r in got}
    assert urls[1] == "http://a/x%20y" and urls[2] is None
    assert warc.round_trip(pages.limit(0)).count() == 0
    long_only = {r.page_id: r.record_type for r in warc.round_trip(pages, least_bytes=1000).collect()}
    assert set(long_only.values()) == {"response"}


def test_arc_versions_and_declared_lengths(tmpdir_path):
    for version in (1, 2):
        path = os.path.join(tmpdir_path, f"{version}.arc.gz")
        records = [warc.arc_record(version, "f", 0, 9, "http://h/", b"pay\r\n\r\nload\n\n"), warc.arc_record(version, "f", 0, None, None, b"")]
        with open(path, "wb") as f:
            f.write(gzip.compress(warc.arc_version_block("f", version)))
            for parts in records:
                f.write(gzip.compress(b"".join(parts) + b"\nnoise after the declared length"))
        with warc.opened(path) as f:
            got = [(h["URL"], len(h), warc.split_http(b)[1]) for _, h, b in warc.arc_records(f)]
        assert got == [("http://h/", len(warc.FIELDS[version]), b"pay\r\n\r\nload\n\n"), ("-", len(warc.FIELDS[version]), b"")]


# ---------------------------------------------------------------- tokens

DOCS = [(5, "Hello wörld, it's 42!"), (3, None), (1, ""), (5, "another five"), (None, "no id"), (9, "w " * 50_000), (7, "x" * 200_000),
        (8, "tab\x1cseparated <|endoftext|> ﬁ e\u0301 \u2028 Σς"), (5, "another five")]


def test_token_round_trip(spark):
    from tokenizers import Tokenizer

    docs = spark.createDataFrame(DOCS, "doc_id long, text string").withColumn("key", F.lit(1)).withColumn("shard", F.lit("x"))
    got = sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in token_store.round_trip(docs, PATH).collect()), key=lambda r: r[1])
    tokenizer, at, want = Tokenizer.from_file(PATH), 0, []
    for doc, text in sorted(DOCS, key=lambda d: (d[0] is not None, d[0] or 0, d[1] or "")):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        want.append((doc, at, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        at += len(ids)
    assert got == want
    assert token_store.round_trip(docs.limit(0), PATH).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(codec="utf-8"), max_size=40), min_size=1, max_size=4))
def test_word_cache_equals_library(texts):
    encoder = token_store.Encoder.of(PATH)
    assert encoder.by_word
    want = [np.array(e.ids, dtype="<u2").tobytes() for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert encoder.encode(texts) == want


def test_perfect_hash_is_minimal_and_turns_strangers_away():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 1000, 20_000):
        keys = rng.choice(1 << 40, n, replace=False).astype(np.int64)
        function = token_store.PerfectHash.build(keys)
        again, used = token_store.PerfectHash.load(function.dump() + b"more")
        assert used == len(function.dump())
        assert sorted(again.find(keys).tolist()) == list(range(n))
        assert (again.find(rng.integers(1 << 41, 1 << 42, 1000)) >= 0).sum() == 0


def test_lookup_leaves_out_unknown_keys(spark):
    from gleaner.session import scratch_path

    folder = scratch_path(spark, "tok")
    rows, buckets = token_store.store(spark.createDataFrame(DOCS, "doc_id long, text string"), folder, PATH)
    keys = spark.createDataFrame([(5,), (6,), (1,)], "key long")
    assert sorted((r.key, r.copies) for r in token_store.lookup(keys, folder, buckets).collect()) == [(1, 1), (5, 3)]


# ---------------------------------------------------------------- URLs

def as_regex(glob):
    out = re.escape(glob).replace(r"\*\*", "\0").replace(r"\*", "[^/]*").replace("\0", ".*").replace(r"\?", "[^/]")
    return re.compile(out, re.S)


def test_automaton_equals_regex():
    rng = np.random.default_rng(2)
    globs = ["".join(rng.choice(["a", "b", "/", "*", "**", "?"], rng.integers(0, 9))) for _ in range(60)]
    globs = [re.sub(r"\*{3,}", "**", g) for g in globs]
    texts = ["".join(rng.choice(["a", "b", "/"], rng.integers(0, 12))) for _ in range(300)] + ["", "é/é", "a" * 5000]
    import pyarrow as pa

    from gleaner.llm.common import utf8

    got = url_rules.compile_globs(globs).run(*utf8(pa.array(texts)))
    for k, g in enumerate(globs):
        want = [as_regex(g).fullmatch(t) is not None for t in texts]
        if "?" in g:  # one byte, so not for the non-ASCII text
            want, have = want[:-2], got[:-2, k].tolist()
        else:
            have = got[:, k].tolist()
        assert have == want, g


def test_judged_urls(spark):
    cases = [
        ("http://a.NET/x", "a.net", "/x", "net/", "block"), ("http://x.example.net/en/1?q", "x.example.net", "/en/1", "example.net/en/", "allow"),
        ("http://example.com/de/", "example.com", "/de/", "example.com/de/", "block"), ("http://notexample.com/de/", "notexample.com", "/de/", None, "allow"),
        ("http://q.org/fr/", "q.org", "/fr/", "org/fr/", "allow"), ("http://a.net", "a.net", "", None, "allow"), ("http://b.com/x.net/", "b.com", "/x.net/", None, "allow"),
        ("http://b.com/login", "b.com", "/login", None, "block"), ("nothing", "", "", None, "allow"), (None, "", "", None, "allow"), ("", "", "", None, "allow"),
        ("a://b.com/" + "p" * 20_000, "b.com", "/" + "p" * 20_000, None, "allow"), ("HTTP://A.org#x://y", "a.org", "", None, "allow"),
    ]
    pages = spark.createDataFrame([(i, c[0], "x") for i, c in enumerate(cases)], "page_id long, url string, host string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_rules.judge(pages).collect()}
    assert [got[i] for i in range(len(cases))] == [c[1:] for c in cases]
    assert url_rules.judge(pages.limit(0)).count() == 0


def test_stored_tables_survive_rereading(spark):
    df = stored(spark.range(5).withColumn("x", F.array(F.lit(1))), "t")
    assert df.count() == 5 and df.schema["x"].dataType.simpleString() == "array<int>"
