"""Fuzzy kernels against dynamic-programming brute force, and invariants."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import brute
from gleaner.functions import editscript as ES
from gleaner.functions import fuzzy as FZ

ALPH = st.text(alphabet="abcé ßxyz", max_size=30)


@settings(max_examples=300, deadline=None)
@given(ALPH, ALPH)
def test_lcs_and_ratio(a, b):
    assert FZ.lcs_len(a, b) == brute.lcs_len(a, b)
    assert FZ.ratio(a, b) == brute.ratio(a, b)


@settings(max_examples=200, deadline=None)
@given(ALPH, ALPH)
def test_partial_ratio_bounds(a, b):
    got = FZ.partial_ratio(a, b)
    assert got == FZ.partial_ratio(a, b) and 0 <= got <= 100
    if a and b:
        s, l = (a, b) if len(a) <= len(b) else (b, a)
        # no window of at most the shorter length does better
        best = max(2 * brute.lcs_len(s, l[i:i + len(s)]) / (len(s) + len(l[i:i + len(s)])) for i in range(len(l)))
        assert got <= round(100 * best) or got == 100 and best > 0.995
        if l.startswith(s) or l.endswith(s):
            assert got == 100


def test_partial_ratio_worked_cases():
    assert FZ.partial_ratio("abcd", "xxabc") == 86   # window "abc", cut at the end: 2 * 3 / 7
    assert FZ.partial_ratio("abcd", "xxabcxx") == 75  # window "abcx": 2 * 3 / 8
    assert FZ.partial_ratio("abc", "xyz") == 0
    assert FZ.partial_ratio("", "abc") == 0


def test_partial_ratio_of_long_texts_rests_on_their_edit_script():
    """Both ends of a text are blocks; a piece from the middle counts only where the script keeps it together."""
    rnd = random.Random(11)
    words = ["".join(rnd.choice("etaoinshrdlu") for _ in range(rnd.randint(2, 8))) for _ in range(300)]
    for size in (200, 400, 2_000, 20_000):
        text = " ".join(rnd.choice(words) for _ in range(size))[:size]
        for piece in (text[:30], text[-30:]):
            assert FZ.partial_ratio(piece, text) == FZ.partial_ratio(text, piece) == 100
        at = rnd.randrange(size - 30)
        piece = text[at:at + 30]
        windows = {max(j - i, 0) for i, j, _ in ES.matching_blocks(piece, text)}
        best = max(FZ.ratio(piece, text[w:w + 30]) for w in windows)
        assert FZ.partial_ratio(piece, text) == best


def test_token_set_examples():
    assert FZ.token_set_ratio("fuzzy wuzzy was a bear", "wuzzy fuzzy was a bear") == 100
    assert FZ.token_set_ratio("", "x") == 0
    assert FZ.token_set_ratio("café au lait", "caf au lait") == 100  # U+00E9 dropped


def test_udf_matches_python(spark):
    rnd = random.Random(7)
    pairs = [("".join(rnd.choice("ab c") for _ in range(rnd.randint(0, 12))),
              "".join(rnd.choice("ab c") for _ in range(rnd.randint(0, 12)))) for _ in range(200)]
    df = spark.createDataFrame(pairs, "a string, b string")
    rows = df.select("a", "b", FZ.fuzzy_scores(F.col("a"), F.col("b")).alias("s")).collect()
    for r in rows:
        assert (r.s.ratio, r.s.partial, r.s.token_set) == (
            FZ.ratio(r.a, r.b), FZ.partial_ratio(r.a, r.b), FZ.token_set_ratio(r.a, r.b))


def test_partial_ratio_compares_few_windows_of_long_texts(monkeypatch):
    rng, calls, lcs = random.Random(9), [], FZ._lcs

    def counted(*args):
        calls.append(1)
        return lcs(*args)

    monkeypatch.setattr(FZ, "_lcs", counted)
    for letters in ("ab", "abcdefgh é"):
        short, long_ = ("".join(rng.choice(letters) for _ in range(n)) for n in (1500, 1900))
        starts = {max(j - i, 0) for i, j, _ in FZ.matching_blocks(short, long_)} - {len(long_)}
        whole = max(2 * lcs(FZ.char_masks(short), 1500, w) / (1500 + len(w)) for w in (long_[s:s + 1500] for s in starts))
        calls.clear()
        assert FZ.partial_ratio(short, long_) == FZ.partial_ratio(long_, short) == round(100 * whole)
        assert len(calls) / 2 < len(starts) / 2
