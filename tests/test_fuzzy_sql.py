"""The SQL statement of the fuzzy scores against the kernels, on short random texts."""

import random

import duckdb

from gleaner.functions import fuzzy as FZ
from gleaner.plans import fuzzy_sql


def test_sql_and_kernels_agree():
    rng = random.Random(3)
    text = lambda: " ".join("".join(rng.choices("abcé", k=rng.randrange(1, 6))) for _ in range(rng.randrange(7)))
    rows = [(text(), text()) for _ in range(200)]
    rows += [(x, x + " zz") for x, _ in rows[:20]] + [(x, "q " + x + " zz") for x, _ in rows[:20]] + [("", "abc"), ("abc", ""), ("", "")]
    con = duckdb.connect()
    con.execute("CREATE TABLE given (qn VARCHAR, tn VARCHAR)")
    con.executemany("INSERT INTO given VALUES (?, ?)", rows)
    got = {(a, b): scores for a, b, *scores in con.execute(fuzzy_sql.scores("SELECT * FROM given")).fetchall()}
    assert got == {(a, b): [FZ.ratio(a, b), FZ.partial_ratio(a, b), FZ.token_set_ratio(a, b)] for a, b in rows}
