"""The blocked search is exact even when a third of the catalog shares words.

The brute force below states the search semantics directly over all pairs
(fine for a few hundred rows) and must equal the prefix-filtered join.
"""

from gleaner.operators import search as S


# (id, title, its acronym): a third of all entries share the same common words
CATALOG = [(str(i), *[("the common project of the common data", "TCPTCD"),
                      (f"the common study number {i} on topic {i % 7}", "TCSNT"),
                      (f"Rare Title {i} alpha{i} beta{i % 11}", "RT")][i % 3]) for i in range(300)]
# (number, query, its acronym), worked out by hand
QUERIES = [(0, "the common project of the common data", "TCPTCD"), (1, "the common", "TC"), (2, "common study number 4", "CSN"),
           (3, "RTAB", "RTAB"), (4, "Rare Title 5 alpha5", "RT"), (5, "the", "THE"), (6, "", None), (7, "beta3 beta3 gamma", None),
           (8, "101", None), (9, " 299 ", None), (10, "999999", None), (11, "tcsnt", "TCSNT")]


def expected_pages():
    """Every query strategy against every entry, best ten by word overlap, title length and id."""
    pages = {}
    for number, query, acronym in QUERIES:
        texts = list(dict.fromkeys(t for t in (query, f'"{query}"', acronym) if t))
        for strategy, text in enumerate(texts):
            quoted = text.startswith('"')
            asked = text.strip('"').lower().split()
            hits = []
            for key, title, title_acronym in CATALOG:
                own = title.lower().split()
                both, either = len({*asked} & {*own}), len({*asked} | {*own})
                if quoted:
                    fits = any(own[k:k + len(asked)] == asked for k in range(len(own))) if asked else False
                else:
                    fits = (both > 0 and 2 * both >= either) or text.strip().upper() == title_acronym or text.strip() == key
                if fits:
                    hits.append((-both / either if either else 0.0, len(title), key))
            pages.update({(number, strategy, place): key for place, (*_, key) in enumerate(sorted(hits)[:10])})
    return pages


def test_hot_words_third_of_catalog(spark):
    qdf = spark.createDataFrame([q[:2] for q in QUERIES], "query_no long, query string")
    cdf = spark.createDataFrame([(p, t, "") for p, t, _ in CATALOG], "project_id string, title string, description string")
    got = {(r.query_no, r.strategy_no, r.pos): r.project_id for r in S.search(qdf, cdf).collect()}
    assert got == expected_pages()
    assert len(got) > 0
