"""DuckDB SQL for the training-data queries that SQL can state."""

from __future__ import annotations

from .url_rules import GLOB_RULES, LOWER, SITE_RULES, UPPER


def _like(glob: str) -> str:
    """A condition on ``host || path`` for the globs in use: ``**`` any run, ``*`` any run without a slash."""
    special = "".join("\\" + c if c in ".^$+()[]{}|\\" else c for c in glob)
    return "regexp_full_match(u, '" + special.replace("**", "\0").replace("*", "[^/]*").replace("\0", ".*").replace("?", "[^/]") + "', 's')"


def _site(rule: str) -> str:
    host, _, path = rule.partition("/")
    return f"((host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '/{path}'))"


def _first(cases: list[tuple[str, str]], other: str) -> str:
    return "CASE " + " ".join(f"WHEN {c} THEN {v}" for c, v in cases) + f" ELSE {other} END"


_SITES = sorted(SITE_RULES, key=lambda r: -len(r[1]))
_GLOBS = sorted(GLOB_RULES, key=lambda r: -len(r[1]))

OP9 = f"""
WITH rest AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
         regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest
), both_ AS (SELECT *, host || path AS u FROM parts)
SELECT page_id, host, path, {_first([(_site(r), f"'{r}'") for _, r in _SITES], "NULL")} AS rule,
  {_first([(_site(r), f"'{v}'") for v, r in _SITES] + [(_like(g), f"'{v}'") for v, g in _GLOBS], "'allow'")} AS verdict
FROM both_
"""

#: Base32 of a 40-digit hex SHA-1: each 5 hex digits are 20 bits, that is 4 characters.
_BASE32 = """list_aggregate([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
  ((CAST('0x' || substr(h, 1 + 5 * (k // 4), 5) AS BIGINT) >> (15 - 5 * (k % 4))) & 31)::INT + 1, 1) for k in range(32)], 'string_agg', '')"""

OP1 = f"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages
), f AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first_page FROM p)
SELECT page_id, payload_bytes, {_BASE32} AS payload_digest,
  CASE WHEN page_id = first_page THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_page THEN first_page END AS refers_to
FROM f
"""

#: CRC-32 of a number's decimal digits (reflected polynomial EDB88320, bit by bit).
_CRC32 = """xor(list_reduce([ord(substr(d, i, 1))::BIGINT for i in range(1, length(d) + 1)],
  lambda have, byte: list_reduce(range(8), lambda c, k: xor(c >> 1, 3988292384 * (c & 1)), xor(have, byte)), 4294967295), 4294967295)"""


def _field(value: str) -> str:
    return f"coalesce(octet_length(encode({value}::VARCHAR)) || ':' || {value}::VARCHAR, '-')"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(map(_field, ('doc_id', 'source', 'lang', 'n_chars', text)))})"


#: Both kinds of tree climb alike; a run is every 16 nodes in a row, and one node that is left over is hashed again.
_CLIMB = """SELECT tree, level + 1, pos // 16, (n + 15) // 16, sha256(string_agg(h, '' ORDER BY pos))
  FROM {0} WHERE n > 1 GROUP BY tree, level, n, pos // 16"""
_BESIDE = """SELECT a.tree, a.level, a.pos, a.n, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l,
    coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r
  FROM {0} a JOIN {0} b ON a.tree = b.tree AND a.level = b.level AND a.pos // 16 = b.pos // 16 WHERE a.n > 1 GROUP BY ALL"""

OP11 = f"""
WITH RECURSIVE docs AS (
  SELECT *, doc_id::VARCHAR AS d, coalesce('=' || source, '') AS tree, {_leaf("text")} AS leaf FROM documents
), flat AS (
  SELECT doc_id, tree, leaf, CASE WHEN {_CRC32} % 5 = 0 THEN {_leaf(f"translate(text, '{UPPER}', '{LOWER}')")} END AS changed,
    row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM docs
), up AS (
  SELECT tree, 0 AS level, pos, n, leaf AS h FROM flat UNION ALL {_CLIMB.format("up")}
), subroots AS (
  SELECT tree AS name, h, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM up WHERE n = 1
), over_ AS (
  SELECT '' AS tree, 0 AS level, pos, n, h FROM subroots UNION ALL {_CLIMB.format("over_")}
), beside AS ({_BESIDE.format("up")}), above AS ({_BESIDE.format("over_")}
), fold AS (
  SELECT doc_id, tree, 0 AS level, pos, n, coalesce(changed, leaf) AS h, '' AS proof, leaf FROM flat
  UNION ALL
  SELECT f.doc_id, f.tree, f.level + 1, f.pos // 16, (f.n + 15) // 16, sha256(b.l || f.h || b.r), f.proof || b.l || b.r, f.leaf
  FROM fold f JOIN beside b ON b.tree = f.tree AND b.level = f.level AND b.pos = f.pos WHERE f.n > 1
), rest AS (
  SELECT f.doc_id, f.leaf, s.h AS subroot, 0 AS level, s.pos, s.n, f.h, f.proof FROM fold f JOIN subroots s ON s.name = f.tree WHERE f.n = 1
  UNION ALL
  SELECT f.doc_id, f.leaf, f.subroot, f.level + 1, f.pos // 16, (f.n + 15) // 16, sha256(b.l || f.h || b.r), f.proof || b.l || b.r
  FROM rest f JOIN above b ON b.level = f.level AND b.pos = f.pos WHERE f.n > 1
)
SELECT doc_id, leaf, subroot, t.h AS root, sha256(proof) AS proof_sha256, rest.h AS folded_root, rest.h = t.h AS verified
FROM rest, (SELECT h FROM over_ WHERE n = 1) t WHERE rest.n = 1
"""

ORACLES = {"op1_arc_to_warc": OP1, "op9_url_rules": OP9, "op11_merkle_manifest": OP11}
