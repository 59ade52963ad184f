"""The Merkle manifest against a plain recomputation, awkward rows included."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from gleaner.llm import manifest

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def fold(nodes):
    """(top, for every node the list of (left, right) up to the top)"""
    paths, own = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for d, at in enumerate(own):
            run = at // 16 * 16
            paths[d].append(("".join(nodes[run:at]), "".join(nodes[at + 1:run + 16])))
        nodes = [H(*nodes[k:k + 16]) for k in range(0, len(nodes), 16)]
        own = [at // 16 for at in own]
    return nodes[0], paths


def lowered(text):
    return None if text is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute(rows):
    trees = defaultdict(list)
    for doc_id, source, lang, n_chars, text in rows:
        leaf = lambda t: H(*map(field, (doc_id, source, lang, n_chars, t)))  # noqa: B023, E731
        bad = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0
        trees[(source is not None, (source or "").encode())].append(
            ((doc_id is not None, doc_id or 0, leaf(text)), doc_id, leaf(text), leaf(lowered(text)) if bad else leaf(text)))
    names = sorted(trees)
    inner = [fold([x[2] for x in sorted(trees[s])]) for s in names]
    root, above = fold([top for top, _ in inner])
    out = []
    for s, (top, paths), up in zip(names, inner, above):
        for (_, doc_id, leaf, h), path in zip(sorted(trees[s]), paths):
            path = path + up
            for left, right in path:
                h = H(left, h, right)
            out.append((doc_id, leaf, top, root, H(*(x + y for x, y in path)), h, h == root))
    return out


def rows_of(n):
    rng = random.Random(n)
    rows = [(i, rng.choice(["a", "a", "a", "b", "é", "", None, f"s{i % 40}"]), rng.choice(["en", None]), rng.choice([3, None, -1]),
             rng.choice([None, "", "Some Text", "ÄÖ Upper", f"text {i}"])) for i in range(n)]
    rows += [(None, "a", "en", 1, "Null Id"), (None, "a", "en", 1, "Null Id"), (None, None, None, None, None), (5, "a", "en", 1, "A"), (5, "a", "en", 1, "B")]
    rows += [rows[0]] * 3 + [(10 ** 12, "long", "en", 1, "Word " * 200_000)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("rows", [rows_of(1200), [(1, "x", "en", 1, "Alone")], [(i, "x", "en", 1, "T") for i in range(17)]], ids=["many", "one", "17"])
def test_proofs_match_brute_force(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    for name in ("tree", "row", "digest", "pos", "n", "run", "slot", "path", "root", "part"):
        docs = docs.withColumn(name, F.lit("clash"))
    got = [tuple(r) for r in manifest.proofs(docs.repartition(7)).collect()]
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(got, key=key) == sorted(brute(rows), key=key)


def test_empty_table_has_no_rows(spark):
    got = manifest.proofs(spark.createDataFrame([], SCHEMA))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"] and got.count() == 0
