"""DuckDB SQL fragments for the oracle queries.

They restate the Spark column functions in DuckDB SQL.  Markup patterns are
spelled here on their own, for RE2; the other regex constants are shared (RE2 and
java.util.regex agree on each of them).
"""

from __future__ import annotations

from gleaner import fixed_values as FV
from gleaner.functions import html as H
from gleaner.functions import urls as U


def lit(s: str) -> str:
    """A SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def rr(expr: str, pattern: str, repl: str = " ") -> str:
    return f"regexp_replace({expr}, {lit(pattern)}, {lit(repl)}, 'g')"


def _block(name: str) -> str:
    return f"<{name}\\b[^>]*>.*?</{name}\\s*>"


_INERT = ["<!--.*?-->", *map(_block, ("script", "style", "template"))]
_IN_TAG = "(?:[^>\"']|\"[^\"]*\"|'[^']*')*>"
_HREF = "\\shref\\s*=\\s*"


def drop_markup(expr: str) -> str:
    return rr(expr, "(?is)" + "|".join([*_INERT, _block("rt"), _block("rp"), "<[!?][^>]*>", "</?[a-z]" + _IN_TAG]))


def inert_free(expr: str) -> str:
    return rr(expr, "(?is)" + "|".join(_INERT))


def decode_entities(expr: str) -> str:
    # '&amp;' (and the legacy form without ';') are parked on a private-use
    # character, the other references decoded, then '&' restored: one pass.
    e = f"replace(replace({expr}, '&amp;', chr(57344)), '&amp', chr(57344))"
    for ent, ch in H.COMMON_ENTITIES:
        if ent == "&amp;":
            continue
        e = f"replace({e}, {lit(ent)}, {lit(ch)})"
    return f"replace({e}, chr(57344), '&')"


def collapse_ws(expr: str) -> str:
    return f"trim({rr(expr, H.WS_CLASS + '+')})"


def html_text(expr: str) -> str:
    return collapse_ws(decode_entities(drop_markup(expr)))


def n_words(expr: str) -> str:
    return f"(CASE WHEN {expr} = '' THEN 0 ELSE len(string_split({expr}, ' ')) END)::BIGINT"


def href_of_tag(tag: str) -> str:
    quoted = [f"nullif(regexp_extract({tag}, {lit(f'(?i){_HREF}{q}([^{q}]*){q}')}, 1), '')" for q in "\"'"]
    bare = f"regexp_extract({tag}, {lit('(?i)' + _HREF)} || '([^' || chr(34) || chr(39) || '[:space:]>]+)', 1)"
    return f"replace(coalesce({', '.join([*quoted, bare])}), '&amp;', '&')"


def link_hrefs(html: str) -> str:
    tags = f"regexp_extract_all({inert_free(html)}, {lit("(?i)<a" + chr(92) + "b" + _IN_TAG)}, 0)"
    return (f"list_filter(list_transform({tags}, lambda t: {href_of_tag('t')}), "
            f"lambda h: h <> '')")


def resolve_href(href: str, url: str) -> str:
    scheme = f"regexp_extract({url}, {lit(U.SCHEME_RE)}, 1)"
    authority = f"regexp_extract({url}, {lit(U.AUTHORITY_RE)}, 1)"
    no_frag = rr(url, "#.*$", "")
    no_query = rr(no_frag, "\\?.*$", "")
    directory = rr(no_query, "/[^/]*$", "/")
    return (f"CASE WHEN regexp_matches({href}, {lit(U.SCHEME_RE)}) THEN {href} "
            f"WHEN starts_with({href}, '//') THEN {scheme} || ':' || {href} "
            f"WHEN starts_with({href}, '/') THEN {scheme} || '://' || {authority} || {href} "
            f"WHEN starts_with({href}, '#') THEN {no_frag} || {href} "
            f"WHEN starts_with({href}, '?') THEN {no_query} || {href} "
            f"ELSE {directory} || {href} END")


def capture_file_name(depth: str, url: str) -> str:
    return f"CAST({depth} AS VARCHAR) || '_' || md5({url}) || '.html'"


def quote_plus(expr: str) -> str:
    return f"replace(url_encode({expr}), '%20', '+')"


# ---- text / matching -------------------------------------------------------

from gleaner.functions import text as TX  # noqa: E402


def py_strip(expr: str) -> str:
    return rr(expr, "^" + H.WS_CLASS + "+|" + H.WS_CLASS + "+$", "")


def py_split(expr: str) -> str:
    return f"list_filter(regexp_split_to_array({expr}, {lit(H.WS_CLASS + '+')}), lambda w: w <> '')"


def upper_py(expr: str) -> str:
    # DuckDB maps 'ß' to the capital sharp s; Python and Java give 'SS'.
    return f"replace(upper({expr}), 'ẞ', 'SS')"


def normalize(expr: str) -> str:
    return collapse_ws(rr(f"lower({expr})", TX.SQL_NON_WORD_RE, " "))


def extract_acronym(x: str) -> str:
    initials = (f"array_to_string(list_transform(list_filter({py_split(x)}, "
                f"lambda w: regexp_matches(w, '^\\p{{L}}+$') AND length(w) > 2), "
                f"lambda w: {upper_py('substring(w, 1, 1)')}), '')")
    return (f"(CASE WHEN regexp_matches({upper_py(x)}, {lit(TX.ACRONYM_RE)}) THEN {upper_py(x)} "
            f"WHEN len({py_split(x)}) > 1 AND length({initials}) BETWEEN 2 AND 10 THEN {initials} END)")


def is_acronym_match(q: str, title: str) -> str:
    words = f"regexp_extract_all({title}, {lit(TX.TITLE_WORD_RE)}, 1)"
    initials = f"array_to_string(list_transform({words}, lambda w: upper(substring(w, 1, 1))), '')"
    return (f"(CASE WHEN len({words}) < 2 THEN false "
            f"ELSE starts_with({initials}, {upper_py(py_strip(q))}) END)")


def description_bonus(qn: str, dn: str) -> str:
    return (f"(CASE WHEN contains({dn}, {qn}) THEN {FV.DESCRIPTION_BONUS} "
            f"WHEN len(list_filter(list_filter(string_split({qn}, ' '), lambda w: length(w) > 3), "
            f"lambda w: contains({dn}, w))) > 0 THEN {FV.DESCRIPTION_WORD_BONUS} ELSE 0 END)")


def levenshtein_sim(a: str, b: str) -> str:
    m = f"greatest(length({a}), length({b}))"
    return f"(CASE WHEN {m} = 0 THEN 1.0 ELSE 1.0 - levenshtein({a}, {b}) / {m} END)"


CATALOG = f"""
SELECT CAST(doc_id AS VARCHAR) AS project_id, doc_id, {py_strip('raw')} AS title,
       substring(text, length(raw) + 1) AS description, lang
FROM (SELECT doc_id, text, lang, regexp_extract(text, {lit(TX.TITLE_RE)}, 0) AS raw FROM documents)
"""

_DROPPED = "regexp_replace(title, '\\s*\\S+\\s*$', '')"
QUERIES = f"""
SELECT doc_id AS query_no,
       CASE WHEN lang = 'fr' THEN coalesce({extract_acronym('title')}, title)
            WHEN lang = 'de' THEN CASE WHEN {_DROPPED} = '' THEN title ELSE {_DROPPED} END
            WHEN lang = 'es' THEN lower(title)
            ELSE title END AS query,
       project_id AS source_id
FROM ({CATALOG})
"""


def char_map(base: str, *cols: str) -> str:
    """A one-row relation ``m(mp, n_chars)`` mapping every character found in
    ``cols`` of ``base`` to a distinct ASCII code, so DuckDB's byte-wise
    levenshtein counts characters (as Spark's does).  Errors out beyond 127."""
    cat = " || ".join(f"coalesce({c}, '')" for c in cols)
    return (f"(SELECT map(list(ch ORDER BY ch), list(k ORDER BY ch)) AS mp, count(*) AS n_chars "
            f"FROM (SELECT ch, row_number() OVER (ORDER BY ch) AS k FROM "
            f"(SELECT DISTINCT unnest(string_split({cat}, '')) AS ch FROM ({base}))))")


def mapped(expr: str) -> str:
    return (f"array_to_string(list_transform(string_split({expr}, ''), "
            f"lambda x: chr(map_extract_value(mp, x)::INTEGER)), '')")


def char_levenshtein(a: str, b: str) -> str:
    return (f"(CASE WHEN n_chars > 127 THEN error('too many distinct characters') "
            f"ELSE levenshtein({mapped(a)}, {mapped(b)}) END)")


def char_levenshtein_sim(a: str, b: str) -> str:
    m = f"greatest(length({a}), length({b}))"
    return f"(CASE WHEN {m} = 0 THEN 1.0 ELSE 1.0 - {char_levenshtein(a, b)} / {m} END)"
