"""Matching blocks against a traceback over the full distance matrix."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st

from gleaner.functions import editscript as ES
from gleaner.functions import fuzzy as FZ

TEXT = st.text(alphabet="abcé ßxyz", max_size=40)


def matrix(a, b):
    d = [[i + j if not i * j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
    return d


def brute_blocks(a, b):
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    x, y = a[head:len(a) - tail], b[head:len(b) - tail]
    d, i, j, same = matrix(x, y), len(x), len(y), []
    while i and j:
        if d[i][j] == d[i - 1][j] + 1:
            i -= 1
        elif d[i][j - 1] == d[i - 1][j - 1] - 1:
            j -= 1
        else:
            i, j = i - 1, j - 1
            if x[i] == y[j]:
                same.append((i + head, j + head))
    same = [(k, k) for k in range(head)] + same[::-1] + [(len(a) - k, len(b) - k) for k in range(tail, 0, -1)]
    out = []
    for i, j in same:
        if out and (out[-1][0] + out[-1][2], out[-1][1] + out[-1][2]) == (i, j):
            out[-1] = (*out[-1][:2], out[-1][2] + 1)
        else:
            out.append((i, j, 1))
    return [*out, (len(a), len(b), 0)], d[len(x)][len(y)]


@settings(max_examples=400, deadline=None)
@given(TEXT, TEXT)
def test_blocks_equal_the_full_matrix(a, b):
    assert ES.matching_blocks(a, b) == brute_blocks(a, b)[0]


def test_blocks_of_longer_texts_in_short_steps(monkeypatch):
    rng = random.Random(5)
    for step in (1, 7, 64):
        monkeypatch.setattr(ES, "STEP", step)
        for _ in range(15):
            a = "".join(rng.choice("ab cd") for _ in range(rng.randrange(1, 130)))
            b = "".join(c for c in a if rng.random() < 0.8) + "".join(rng.choice("abx") for _ in range(rng.randrange(40)))
            assert ES.matching_blocks(a, b) == brute_blocks(a, b)[0]


def test_script_has_least_cost():
    """What the blocks leave out costs exactly the distance."""
    rng = random.Random(6)
    for _ in range(200):
        a, b = ("".join(rng.choice("abc") for _ in range(rng.randrange(30))) for _ in range(2))
        cost, i, j = 0, 0, 0
        for x, y, n in ES.matching_blocks(a, b):
            cost += max(x - i, y - j)
            i, j = x + n, y + n
        assert cost == brute_blocks(a, b)[1]


def test_long_texts_and_memory():
    rng = random.Random(9)
    a = "".join(rng.choice("etaoin shrdlu") for _ in range(20_000))
    b = list(a)
    for _ in range(300):
        b[rng.randrange(len(b))] = "Q"
    b = "".join(b) + "tail"
    blocks = ES.matching_blocks(a, b)
    assert blocks[-1] == (20_000, 20_004, 0) and sum(n for *_, n in blocks) >= 19_690
    assert all(a[i:i + n] == b[j:j + n] for i, j, n in blocks)


def brute_partial(a, b):
    short, long_ = (a, b) if len(a) <= len(b) else (b, a)
    best = 0.0
    for i, j, _ in brute_blocks(short, long_)[0]:
        w = long_[max(j - i, 0):][:len(short)]
        best = max(best, FZ._raw_ratio(short, w) if w else 0)
    return 100 if best > 0.995 else round(100 * best)


@settings(max_examples=300, deadline=None)
@given(TEXT.filter(bool), TEXT.filter(bool))
def test_partial_ratio_rests_on_the_blocks(a, b):
    assert FZ.partial_ratio(a, b) == (100 if a == b else brute_partial(a, b))
