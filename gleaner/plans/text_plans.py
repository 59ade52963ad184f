"""Plans over documents: relevance filter and the matching scalars."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleaner.functions import keywords as K
from gleaner.functions import text as TX
from gleaner.plans import sqlbits as Q
from gleaner.plans.registry import plan
from gleaner.sources import fixtures
from gleaner.sources.tables import read_table, spread

# Fixed parameters of the relevance filter (the documented knobs:
# keyword list, minimum keyword hits, minimum words).
RELEVANCE_KEYWORDS = ["research", "project", "data", "tion", "ung", "ment", "the"]
RELEVANCE_THRESHOLD = 2
RELEVANCE_MIN_WORDS = 50

_KW = "[" + ", ".join(Q.lit(k) for k in RELEVANCE_KEYWORDS) + "]"


@plan("relevance_filter", oracle=f"""
SELECT doc_id, lang, n_keywords, n_words FROM (
  SELECT doc_id, lang,
         len(list_filter({_KW}, lambda k: contains(lower(text), k)))::BIGINT AS n_keywords,
         len({Q.py_split('text')})::BIGINT AS n_words
  FROM documents)
WHERE n_keywords >= {RELEVANCE_THRESHOLD} AND n_words >= {RELEVANCE_MIN_WORDS}
""")
def relevance_filter(spark, sf_dir, keywords=RELEVANCE_KEYWORDS,
                     threshold=RELEVANCE_THRESHOLD, min_words=RELEVANCE_MIN_WORDS):
    """Documents with >= threshold keyword hits and >= min_words words."""
    d = spread(read_table(spark, sf_dir, "documents").select("doc_id", "lang", "text"))
    scored = d.select(
        "doc_id", "lang",
        TX.keyword_hits(F.col("text"), keywords).cast("bigint").alias("n_keywords"),
        TX.word_count(F.col("text")).cast("bigint").alias("n_words"),
    )
    # The observed count of scored documents doubles as a fence: Catalyst
    # does not push the filter below it, so the two measures are computed
    # once, after the scan is spread over the cores.
    scored = scored.observe("relevance_scored", F.count(F.lit(1)).alias("documents"))
    return scored.filter((F.col("n_keywords") >= threshold) & (F.col("n_words") >= min_words))


#: Keywords of the long-list filter: the most frequent longer words of the catalog's titles.
LONG_LIST = 10_000
_LONG_LIST = f"""
SELECT list(word ORDER BY n DESC, word) AS words FROM (
  SELECT word, count(*) AS n FROM (
    SELECT unnest(list_distinct(string_split({Q.normalize('title')}, ' '))) AS word FROM ({Q.CATALOG}))
  WHERE length(word) > 4 GROUP BY word ORDER BY n DESC, word LIMIT {LONG_LIST})"""


@plan("keyword_hits", oracle=f"""
SELECT doc_id, len(list_filter(words, lambda k: contains(low, k)))::BIGINT AS n_keywords
FROM (SELECT doc_id, lower(text) AS low FROM documents), ({_LONG_LIST})""")
def keyword_hits(spark, sf_dir, most=LONG_LIST):
    """H15 with a long keyword list: how many of the titles' words each document holds."""
    word = F.explode(F.array_distinct(F.split(TX.normalize(F.col("title")), " "))).alias("word")
    top = (fixtures.catalog(spark, sf_dir).select(word).filter(F.length("word") > 4).groupBy("word").agg(F.count("*").alias("n"))
           .orderBy(F.col("n").desc(), "word").limit(most))
    listed = [r.word for r in top.collect()]  # the keyword list: a parameter of at most ``most`` words
    d = spread(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return d.select("doc_id", K.keyword_hits(F.col("text"), listed).alias("n_keywords"))


@plan("normalize_text", oracle=f"""
SELECT doc_id, title, {Q.normalize('title')} AS title_norm FROM ({Q.CATALOG})
""")
def normalize_text(spark, sf_dir):
    """M1 over every catalog title."""
    c = fixtures.catalog(spark, sf_dir)
    return c.select("doc_id", "title", TX.normalize(F.col("title")).alias("title_norm"))


@plan("extract_acronym", oracle=f"""
SELECT doc_id, {Q.extract_acronym('title')} AS acronym FROM ({Q.CATALOG})
""")
def extract_acronym(spark, sf_dir):
    """M2 over every catalog title."""
    c = fixtures.catalog(spark, sf_dir)
    return c.select("doc_id", TX.extract_acronym(F.col("title")).alias("acronym"))


@plan("project_queries", oracle=Q.QUERIES)
def project_queries(spark, sf_dir):
    """The derived query list (exact title / acronym / shortened / lower-case)."""
    return fixtures.project_queries(spark, sf_dir)


_PAIRS = f"""
SELECT q.query_no, q.query, c.title, c.description
FROM ({Q.QUERIES}) q JOIN ({Q.CATALOG}) c ON c.project_id = q.source_id
"""


def _query_source_pairs(spark, sf_dir):
    q = fixtures.project_queries(spark, sf_dir)
    c = fixtures.catalog(spark, sf_dir)
    return q.join(c, q.source_id == c.project_id).select(
        "query_no", "query", "title", "description")


@plan("acronym_match", oracle=f"""
SELECT query_no, query, {Q.is_acronym_match('query', 'title')} AS is_match FROM ({_PAIRS})
""")
def acronym_match(spark, sf_dir):
    """M3: is each query a prefix of its source title's initials."""
    p = _query_source_pairs(spark, sf_dir)
    return p.select("query_no", "query",
                    TX.is_acronym_match(F.col("query"), F.col("title")).alias("is_match"))


@plan("description_bonus", oracle=f"""
SELECT query_no, {Q.description_bonus(Q.normalize('query'), Q.normalize('description'))} AS bonus_milli
FROM ({_PAIRS})
""")
def description_bonus(spark, sf_dir):
    """M7 (milli-points) of each query against its source's description."""
    p = _query_source_pairs(spark, sf_dir)
    return p.select("query_no", TX.description_bonus_milli(
        TX.normalize(F.col("query")), TX.normalize(F.col("description"))).alias("bonus_milli"))


_NORM_PAIRS = f"SELECT query_no, {Q.normalize('query')} AS qn, {Q.normalize('title')} AS tn FROM ({_PAIRS})"


@plan("levenshtein_sim", oracle=f"""
SELECT query_no, round({Q.char_levenshtein_sim('qn', 'tn')}, 6) AS sim
FROM ({_NORM_PAIRS}) p, {Q.char_map(_NORM_PAIRS, 'qn', 'tn')} m
""")
def levenshtein_sim(spark, sf_dir):
    """Native edit-distance similarity of normalized query and title."""
    p = _query_source_pairs(spark, sf_dir)
    return p.select("query_no", F.round(TX.levenshtein_sim(
        TX.normalize(F.col("query")), TX.normalize(F.col("title"))), 6).alias("sim"))
