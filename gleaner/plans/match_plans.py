"""Plans for catalog search and project resolution.

Queries are derived from ``documents`` (``fixtures.project_queries``) and
searched against the catalog built from the same table.  Most plans use the
``native`` scorer (in the JVM but for long texts); those of the fuzzy scorer (M4-M6) have oracles by dynamic
programming (``fuzzy_sql``).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from gleaner import fixed_values as FV
from gleaner.functions import text as TX
from gleaner.functions.fuzzy import fuzzy_scores
from gleaner.operators import resolve as RS
from gleaner.operators import search as S
from gleaner.plans import fuzzy_sql
from gleaner.plans import match_sql as MS
from gleaner.plans import sqlbits as Q
from gleaner.plans.registry import plan
from gleaner.sources import fixtures


def _inputs(spark, sf_dir):
    return fixtures.project_queries(spark, sf_dir), fixtures.catalog(spark, sf_dir)


def _ranked(spark, sf_dir, scorer="native"):
    q, c = _inputs(spark, sf_dir)
    return RS.ranked_candidates(q, c, scorer)


@plan("search_strategies", oracle=MS.STRATEGIES)
def search_strategies(spark, sf_dir):
    """The ordered, de-duplicated search strings of each query."""
    q, _ = _inputs(spark, sf_dir)
    return S.strategies(q).select("query_no", "strategy_no", "strategy")


@plan("match_candidates", oracle=f"""
SELECT query_no, strategy_no, pos, project_id, overlap FROM ({MS.SEARCH})""")
def match_candidates(spark, sf_dir):
    """Blocked candidates of every strategy (page of 10, ranked)."""
    q, c = _inputs(spark, sf_dir)
    return S.search(q, c).select("query_no", "strategy_no", "pos", "project_id", "overlap")


@plan("positional_relevance", oracle=f"""
SELECT query_no, strategy_no, pos, relevance_score FROM ({MS.SEARCH})""")
def positional_relevance(spark, sf_dir):
    """Relevance from the result position."""
    q, c = _inputs(spark, sf_dir)
    return S.search(q, c).select("query_no", "strategy_no", "pos", "relevance_score")


@plan("topk_per_query", oracle=f"""
SELECT query_no, strategy_no, count(*)::BIGINT AS n_results FROM ({MS.SEARCH}) GROUP BY ALL""")
def topk_per_query(spark, sf_dir):
    """Results kept per search (at most the page size)."""
    q, c = _inputs(spark, sf_dir)
    return S.search(q, c).groupBy("query_no", "strategy_no").agg(F.count(F.lit(1)).alias("n_results"))


@plan("misspelt_candidates", oracle=MS.MISSPELT)
def misspelt_candidates(spark, sf_dir):
    """J1 with the similarity predicate of M10: titles that a misspelt name is close to, shared words or not."""
    q = fixtures.misspelt_queries(spark, sf_dir)
    return S.misspelt(q, fixtures.catalog(spark, sf_dir)).select("query_no", "pos", "project_id", "distance")


@plan("match_score_native", oracle=f"""
SELECT query_no, strategy_no, project_id, milli, milli / 1000.0::DOUBLE AS match_score FROM ({MS.SCORED})""")
def match_score_native(spark, sf_dir):
    """M9 with the JVM edit-similarity in place of the fuzzy kernels."""
    q, c = _inputs(spark, sf_dir)
    return RS.scored_search(q, c, "native").select(
        "query_no", "strategy_no", "project_id", "milli", "match_score")


@plan("strategy_early_stop", oracle=f"""
SELECT query_no, any_value(stop_strategy_no) AS stop_strategy_no, count(*)::BIGINT AS n_kept
FROM ({MS.KEPT}) GROUP BY query_no""")
def strategy_early_stop(spark, sf_dir):
    """A3: the strategy that stopped the search, and results kept."""
    q, c = _inputs(spark, sf_dir)
    k = RS.early_stop(RS.scored_search(q, c, "native"))
    return k.groupBy("query_no").agg(F.first("stop_strategy_no").alias("stop_strategy_no"),
                                     F.count(F.lit(1)).alias("n_kept"))


@plan("dedupe_best", oracle=f"""
SELECT query_no, project_id, milli, strategy_no AS best_strategy_no FROM ({MS.BEST})""")
def dedupe_best(spark, sf_dir):
    """A1: best result per (query, project)."""
    q, c = _inputs(spark, sf_dir)
    b = RS.dedupe_best(RS.early_stop(RS.scored_search(q, c, "native")))
    return b.select("query_no", "project_id", "milli", F.col("strategy_no").alias("best_strategy_no"))


@plan("rank_candidates", oracle=f"SELECT query_no, rank, project_id, milli FROM ({MS.RANKED})")
def rank_candidates(spark, sf_dir):
    """A2: candidates ranked by score, ties in first-seen order."""
    return _ranked(spark, sf_dir).select("query_no", "rank", "project_id", "milli")


@plan("match_verdict", oracle=f"""
SELECT query_no, project_id, n_candidates::BIGINT AS n_candidates, verdict FROM ({MS.RANKED}) WHERE rank = 1""")
def match_verdict(spark, sf_dir):
    """A4: the best candidate and the confidence verdict."""
    r = _ranked(spark, sf_dir).filter(F.col("rank") == 1)
    return r.select("query_no", "project_id", "n_candidates", "verdict")


@plan("disambiguation_topk", oracle=f"""
SELECT query_no, rank, project_id, substring(title, 1, {FV.TITLE_CUT}) AS title,
       substring(description, 1, {FV.DESCRIPTION_CUT}) AS description, milli / 1000.0::DOUBLE AS match_score
FROM ({MS.RANKED}) WHERE verdict = 'ambiguous' AND rank <= {FV.DISAMBIGUATION_TOP}""")
def disambiguation_topk(spark, sf_dir):
    """A5: the top-5 list shown for ambiguous queries."""
    return RS.disambiguation(_ranked(spark, sf_dir))


@plan("unmatched_queries", oracle=f"""
SELECT query_no, query FROM ({Q.QUERIES}) q
WHERE NOT EXISTS (SELECT 1 FROM ({MS.SEARCH}) s WHERE s.query_no = q.query_no)""")
def unmatched_queries(spark, sf_dir):
    """Queries that found no candidate at all."""
    q, c = _inputs(spark, sf_dir)
    return RS.unmatched(q, RS.ranked_candidates(q, c, "native")).select("query_no", "query")


@plan("resolve_projects", oracle=f"""
SELECT query_no, query, project_id, title, milli / 1000.0::DOUBLE AS match_score, strategy AS search_strategy, verdict,
       n_candidates::BIGINT AS n_candidates FROM ({MS.RANKED_FUZZY}) WHERE rank = 1""")
def resolve_projects(spark, sf_dir):
    """Best project per query with the fuzzy scorer."""
    q, c = _inputs(spark, sf_dir)
    return RS.resolve(q, c, "fuzzy")


@plan("match_score", oracle=f"""
SELECT query_no, strategy_no, project_id, milli, milli / 1000.0::DOUBLE AS match_score FROM ({MS.SCORED_FUZZY})""")
def match_score(spark, sf_dir):
    """M9 with the fuzzy kernels, every search result."""
    q, c = _inputs(spark, sf_dir)
    return RS.scored_search(q, c, "fuzzy").select(
        "query_no", "strategy_no", "project_id", "milli", "match_score")


_PAIRS = f"""
SELECT q.query_no, {Q.normalize('q.query')} AS qn, {Q.normalize('c.title')} AS tn
FROM ({Q.QUERIES}) q JOIN ({Q.CATALOG}) c ON c.project_id = q.source_id"""


def _pair_oracle(column: str, name: str) -> str:
    return f"""
WITH pairs AS MATERIALIZED ({_PAIRS}), f AS MATERIALIZED ({fuzzy_sql.scores("SELECT qn, tn FROM pairs")})
SELECT query_no, f.{column} AS {name} FROM pairs p JOIN f ON f.qn = p.qn AND f.tn = p.tn"""


def _pair_scores(spark, sf_dir):
    q, c = _inputs(spark, sf_dir)
    p = q.join(c, q.source_id == c.project_id).select(
        "query_no", TX.normalize(F.col("query")).alias("qn"), TX.normalize(F.col("title")).alias("tn"))
    return p.withColumn("s", fuzzy_scores(F.col("qn"), F.col("tn")))


@plan("fuzzy_ratio", oracle=_pair_oracle("ratio", "ratio"))
def fuzzy_ratio(spark, sf_dir):
    """M4 of each query against its source title."""
    return _pair_scores(spark, sf_dir).select("query_no", F.col("s.ratio").alias("ratio"))


@plan("fuzzy_partial_ratio", oracle=_pair_oracle("partial", "partial_ratio"))
def fuzzy_partial_ratio(spark, sf_dir):
    """M5 of each query against its source title."""
    return _pair_scores(spark, sf_dir).select("query_no", F.col("s.partial").alias("partial_ratio"))


@plan("fuzzy_token_set", oracle=_pair_oracle("token_set", "token_set_ratio"))
def fuzzy_token_set(spark, sf_dir):
    """M6 of each query against its source title."""
    return _pair_scores(spark, sf_dir).select("query_no", F.col("s.token_set").alias("token_set_ratio"))
