"""DuckDB statement of the catalog search and resolution, by brute force.

The candidate set is computed from the definition -- overlap over *all*
tokens, no prefix filtering -- so an oracle match also checks that the
prefix-filtered Spark join loses no candidate.
"""

from __future__ import annotations

from gleaner import fixed_values as FV
from gleaner.functions import text as TX
from gleaner.plans import fuzzy_sql
from gleaner.plans import sqlbits as Q


def _acr_token(expr: str) -> str:
    up = Q.upper_py(Q.py_strip(expr))
    return f"(CASE WHEN regexp_matches({up}, {Q.lit(TX.ACRONYM_RE)}) THEN chr(1) || {up} END)"


_PHRASE = "(length(strategy) >= 2 AND starts_with(strategy, '\"') AND ends_with(strategy, '\"'))"

def _words(norm: str) -> str:
    return f"list_distinct(list_filter(string_split({norm}, ' '), lambda w: w <> ''))"


SEARCH = f"""
WITH q AS ({Q.QUERIES}),
c AS ({Q.CATALOG}),
cat AS (
  SELECT project_id, title, description, tn, {_words('tn')} AS words, {_acr_token('a')} AS acr
  FROM (SELECT project_id, title, description, {Q.normalize('title')} AS tn,
               {Q.extract_acronym('title')} AS a FROM c)),
s0 AS (SELECT query_no, query, [query, '"' || query || '"', {Q.extract_acronym('query')}] AS arr FROM q),
s1 AS (SELECT query_no, query,
              list_filter(arr, lambda x, i: x IS NOT NULL AND x <> '' AND NOT list_contains(arr[1:i-1], x))
                AS arr FROM s0),
strat AS (SELECT query_no, query, unnest(range(len(arr)))::INTEGER AS strategy_no,
                 unnest(arr) AS strategy FROM s1),
terms0 AS (
  SELECT query_no, query, strategy_no, strategy, {_PHRASE} AS is_phrase,
         {Q.normalize(f"CASE WHEN {_PHRASE} THEN substring(strategy, 2, length(strategy) - 2) ELSE strategy END")}
           AS pn
  FROM strat),
terms AS (SELECT *, {_words('pn')} AS words,
                 CASE WHEN NOT is_phrase THEN {_acr_token('strategy')} END AS acr,
                 CASE WHEN NOT is_phrase AND regexp_matches({Q.py_strip('strategy')}, '^[0-9]+$')
                      THEN {Q.py_strip('strategy')} END AS id_query FROM terms0),
qt AS (SELECT query_no, strategy_no, unnest(words) AS token FROM terms WHERE NOT is_phrase),
ct AS (SELECT project_id, unnest(words) AS token FROM cat),
ov AS (SELECT query_no, strategy_no, project_id, count(*) AS o
       FROM qt JOIN ct USING (token) GROUP BY query_no, strategy_no, project_id),
jac AS (SELECT ov.query_no, ov.strategy_no, ov.project_id FROM ov
        JOIN terms t ON t.query_no = ov.query_no AND t.strategy_no = ov.strategy_no
        JOIN cat c ON c.project_id = ov.project_id
        WHERE 3 * ov.o >= len(t.words) + len(c.words) AND len(t.words) > 0),
acr_m AS (SELECT t.query_no, t.strategy_no, c.project_id FROM terms t JOIN cat c ON c.acr = t.acr
          WHERE NOT t.is_phrase),
phr AS (SELECT t.query_no, t.strategy_no, c.project_id FROM terms t JOIN ct ON ct.token = t.words[1]
        JOIN cat c ON c.project_id = ct.project_id
        WHERE t.is_phrase AND len(t.words) > 0 AND contains(' ' || c.tn || ' ', ' ' || t.pn || ' ')),
id_m AS (SELECT t.query_no, t.strategy_no, c.project_id FROM terms t JOIN cat c ON c.project_id = t.id_query),
pairs AS (SELECT * FROM jac UNION SELECT * FROM acr_m UNION SELECT * FROM id_m UNION SELECT * FROM phr),
cand AS (
  SELECT t.query_no, t.query, t.strategy_no, t.strategy, c.project_id, c.title, c.description,
         c.tn AS title_norm, len(list_intersect(t.words, c.words))::INTEGER AS overlap,
         len(t.words) AS nt, len(c.words) AS ne
  FROM pairs p JOIN terms t ON t.query_no = p.query_no AND t.strategy_no = p.strategy_no
               JOIN cat c ON c.project_id = p.project_id),
ranked AS (
  SELECT *, (row_number() OVER (PARTITION BY query_no, strategy_no
                                ORDER BY CASE WHEN nt + ne - overlap > 0 THEN overlap / (nt + ne - overlap)
                                              ELSE 0.0 END DESC, length(title), project_id) - 1)::INTEGER AS pos
  FROM cand)
SELECT * EXCLUDE (nt, ne), greatest(round((10 - pos)::DOUBLE / 10.0::DOUBLE, 1), 0.1) AS relevance_score
FROM ranked WHERE pos < 10
"""

STRATEGIES = f"""
WITH q AS ({Q.QUERIES}),
s0 AS (SELECT query_no, query, [query, '"' || query || '"', {Q.extract_acronym('query')}] AS arr FROM q),
s1 AS (SELECT query_no, list_filter(arr, lambda x, i: x IS NOT NULL AND x <> ''
                                    AND NOT list_contains(arr[1:i-1], x)) AS arr FROM s0)
SELECT query_no, unnest(range(len(arr)))::INTEGER AS strategy_no, unnest(arr) AS strategy FROM s1
"""

_NORM = f"""
SELECT *, {Q.normalize('query')} AS qn, {Q.normalize('description')} AS dn FROM ({SEARCH})
"""

_M = "greatest(length(qn), length(title_norm))"
_W = FV.RATIO_WEIGHT + FV.PARTIAL_WEIGHT + FV.TOKEN_SET_WEIGHT
SCORED = f"""
WITH norm AS MATERIALIZED ({_NORM})
SELECT s.*, least({_W} * (CASE WHEN {_M} = 0 THEN 100
                            ELSE (200 * ({_M} - {Q.char_levenshtein('qn', 'title_norm')}) + {_M}) // (2 * {_M}) END)
                  + {Q.description_bonus('qn', 'dn')}
                  + CASE WHEN {Q.is_acronym_match('query', 'title')} THEN {FV.ACRONYM_BONUS} ELSE 0 END
                  + CASE WHEN qn = title_norm THEN {FV.EXACT_BONUS} ELSE 0 END, 1000)::INTEGER AS milli
FROM norm s, {Q.char_map('SELECT * FROM norm', 'qn', 'title_norm')} m
"""

SCORED_FUZZY = f"""
WITH norm AS MATERIALIZED ({_NORM}), fuzzy AS MATERIALIZED ({fuzzy_sql.scores("SELECT qn, title_norm AS tn FROM norm")})
SELECT s.*, least({FV.RATIO_WEIGHT} * f.ratio + {FV.PARTIAL_WEIGHT} * f.partial + {FV.TOKEN_SET_WEIGHT} * f.token_set
                  + {Q.description_bonus('s.qn', 'dn')}
                  + CASE WHEN {Q.is_acronym_match('query', 'title')} THEN {FV.ACRONYM_BONUS} ELSE 0 END
                  + CASE WHEN s.qn = title_norm THEN {FV.EXACT_BONUS} ELSE 0 END, 1000)::INTEGER AS milli
FROM norm s JOIN fuzzy f ON f.qn = s.qn AND f.tn = s.title_norm
"""


def _kept(scored: str) -> str:
    return f"""
SELECT * FROM (
  SELECT *, min(CASE WHEN milli > {FV.HIGH_CONFIDENCE_MILLI} THEN strategy_no END) OVER (PARTITION BY query_no)
    AS stop_strategy_no
  FROM ({scored}))
WHERE stop_strategy_no IS NULL OR strategy_no <= stop_strategy_no
"""


def _best(kept: str) -> str:
    return f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, min(strategy_no * 100 + pos) OVER (PARTITION BY query_no, project_id) AS first_seen,
         row_number() OVER (PARTITION BY query_no, project_id ORDER BY milli DESC, strategy_no, pos) AS rn
  FROM ({kept}))
WHERE rn = 1
"""


def _ranked(best: str) -> str:
    return f"""
SELECT *, CASE WHEN n_candidates = 1 OR top_milli > {FV.HIGH_CONFIDENCE_MILLI} THEN 'high_confidence'
               ELSE 'ambiguous' END AS verdict
FROM (
  SELECT *, row_number() OVER (PARTITION BY query_no ORDER BY milli DESC, first_seen)::INTEGER AS rank,
         count(*) OVER (PARTITION BY query_no) AS n_candidates,
         max(milli) OVER (PARTITION BY query_no) AS top_milli
  FROM ({best}))
"""


KEPT = _kept(SCORED)
BEST = _best(KEPT)
RANKED = _ranked(BEST)
RANKED_FUZZY = _ranked(_best(_kept(SCORED_FUZZY)))

#: Every misspelt name against every title, by their distance alone.
_NAMES = f"""
SELECT doc_id AS query_no, {Q.normalize("regexp_replace(title, '([A-Za-z]{2})[a-z]([a-z]{2,})', '" + chr(92) + "1" + chr(92) + "2', 'g')")} AS qn,
       project_id, title, {Q.normalize("title")} AS tn FROM ({Q.CATALOG})
"""
MISSPELT = f"""
WITH names AS MATERIALIZED ({_NAMES}),
m AS ({Q.char_map("SELECT * FROM names", "qn", "tn")}),
q AS (SELECT DISTINCT qn, length(qn) AS a, {Q.mapped("qn")} AS x FROM names, m WHERE qn <> ''),
t AS (SELECT DISTINCT tn, length(tn) AS b, {Q.mapped("tn")} AS y FROM names, m WHERE tn <> ''),
near AS MATERIALIZED (
  SELECT qn, tn, levenshtein(x, y) AS distance FROM q, t
  WHERE abs(a - b) <= greatest(a, b) * 15 // 100 AND levenshtein(x, y) <= greatest(a, b) * 15 // 100)
SELECT query_no, pos, project_id, distance::INTEGER AS distance FROM (
  SELECT n.query_no, c.project_id, near.distance,
         (row_number() OVER (PARTITION BY n.query_no ORDER BY near.distance, length(c.title), c.project_id) - 1)::INTEGER AS pos
  FROM names n JOIN near ON near.qn = n.qn JOIN names c ON c.tn = near.tn)
WHERE pos < 10
"""
