"""HTML column functions: page text (H1) and link extraction (H2).

Everything is a chain of JVM regex expressions so it stays inside whole-stage
codegen.  The only Python is the rare-entity decoder: it sees the few rows
that hold a character reference outside the common set, and null for every
other row, so the Arrow transfer is near-empty.
"""

from __future__ import annotations

import html as _html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.functions import dom

# The whitespace set Python's str.split()/str.strip() use
# (Unicode White_Space plus the four ASCII separators \x1c-\x1f).  Java
# spells it (?U)[\s\x1c-\x1f] -- with UNICODE_CHARACTER_CLASS, \s is
# White_Space -- which runs far faster than the explicit list; the explicit
# list is for RE2 (the SQL oracles).
JAVA_WS = "[\\s\\x1c-\\x1f]"
WS_CLASS = (
    "[\\t\\n\\x0b\\x0c\\r\\x1c-\\x1f \\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}"
    "\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"
)

# Markup that contributes no text: comments, raw-text blocks whose body is
# not page text, declarations/processing instructions, and tags (quoted
# attribute values may hold '>').
COMMENT_RE = "(?s)<!--.*?-->"
SCRIPT_RE = "(?is)<script\\b[^>]*>.*?</script\\s*>"
STYLE_RE = "(?is)<style\\b[^>]*>.*?</style\\s*>"
TEMPLATE_RE = "(?is)<template\\b[^>]*>.*?</template\\s*>"
RUBY_RE = "(?is)<(?:rt|rp)\\b[^>]*>.*?</(?:rt|rp)\\s*>"
DECL_RE = "(?s)<[!?][^>]*>"
# A quote opens a value only right after its '='; elsewhere it is part of a name.
_ATTRIBUTE = "(?<=[\\s/'\"])[^\\s/>][^\\s/=>]*+(?:\\s*+=\\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\\s>\"'][^\\s>]*+|(?=[\\s>])))?+[\\s/]*+"
_ATTRIBUTES = "[\\s/]*+(?:" + _ATTRIBUTE + ")*+>"
TAG_RE = "</?[A-Za-z][^\\s/>]*+" + _ATTRIBUTES

# Entities decoded natively, in this order; '&amp;' goes last so
# that '&amp;lt;' decodes once, to '&lt;'.
COMMON_ENTITIES = [
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&apos;", "'"),
    ("&nbsp;", "\u00a0"),
    ("&copy;", "\u00a9"),
    ("&middot;", "\u00b7"),
    ("&amp;", "&"),
]
_COMMON_ENTITY_RE = "&(?:lt|gt|quot|#39|apos|nbsp|copy|middot|amp);"
# A character reference that is not one of the common ones (one scan).
_RARE_REF_RE = "&(?!(?:lt|gt|quot|#39|apos|nbsp|copy|middot|amp);)[#A-Za-z]"


def _one_pass(*patterns: str) -> str:
    """Ordered alternation of the patterns (their leading inline flags folded
    into one (?is)): at each '<' the first construct that matches wins, as a
    tokenizer reads them, in a single scan of the text."""
    bodies = [p.split(")", 1)[1] if p.startswith("(?") else p for p in patterns]
    return "(?is)" + "|".join(f"(?:{b})" for b in bodies)


MARKUP_RE = _one_pass(COMMENT_RE, SCRIPT_RE, STYLE_RE, TEMPLATE_RE, RUBY_RE, DECL_RE, TAG_RE)
INERT_RE = _one_pass(COMMENT_RE, SCRIPT_RE, STYLE_RE, TEMPLATE_RE)


def drop_markup(html: Column) -> Column:
    """Replace every non-text construct by one space (the text separator)."""
    return F.regexp_replace(html, MARKUP_RE, " ")


@F.pandas_udf(T.StringType())
def _unescape_rare(s: pd.Series) -> pd.Series:
    return s.map(lambda v: None if v is None else _html.unescape(v))


def decode_entities(text: Column) -> Column:
    """HTML character references decoded once, as Python's html.unescape does.

    Rows whose only references are the common named ones never leave the JVM.
    """
    fast = text
    for ent, ch in COMMON_ENTITIES:
        fast = F.replace(fast, F.lit(ent), F.lit(ch))
    rare = text.rlike(_RARE_REF_RE)
    return F.coalesce(_unescape_rare(F.when(rare, text)), fast)


def collapse_ws(text: Column) -> Column:
    """Python's ' '.join(s.split()): runs of whitespace to one space, ends cut."""
    return F.trim(F.regexp_replace(text, "(?U)" + JAVA_WS + "+", " "))


def html_to_text(html: Column) -> Column:
    """H1: all text nodes joined by one space, whitespace collapsed.

    Title text is kept; comments, doctype, and script/style/template bodies
    are not.
    """
    return collapse_ws(decode_entities(drop_markup(html)))


# Link extraction works on markup with comments and raw-text blocks removed,
# so commented-out or scripted anchors are not links.
A_TAG_RE = "(?i)<a(?=[\\s/>])" + _ATTRIBUTES
_HREF_DQ = "(?i)\\shref\\s*=\\s*\"([^\"]*)\""
_HREF_SQ = "(?i)\\shref\\s*=\\s*'([^']*)'"
_HREF_BARE = "(?i)\\shref\\s*=\\s*([^\\s\"'>]+)"


def _without_inert_blocks(html: Column) -> Column:
    return F.regexp_replace(html, INERT_RE, " ")


def href_of_tag(tag: Column) -> Column:
    """The href attribute value of one start tag ('' when absent)."""
    v = F.coalesce(
        F.nullif(F.regexp_extract(tag, _HREF_DQ, 1), F.lit("")),
        F.nullif(F.regexp_extract(tag, _HREF_SQ, 1), F.lit("")),
        F.regexp_extract(tag, _HREF_BARE, 1),
    )
    return F.replace(v, F.lit("&amp;"), F.lit("&"))


def anchor_tags(html: Column) -> Column:
    """array<string>: every <a ...> start tag, in document order."""
    return F.regexp_extract_all(_without_inert_blocks(html), F.lit(A_TAG_RE), 0)


# An href with a character reference other than &amp;: read by the tokenizer.
_RARE_HREF_RE = "(?i)href\\s*=\\s*[\"']?[^\"'>]*&(?!amp;)[#A-Za-z]"


@F.pandas_udf(T.ArrayType(T.StringType()))
def _hrefs_by_tree(html: pd.Series) -> pd.Series:
    return html.map(lambda v: None if v is None else [
        a.attrs["href"] for a in dom.parse(v).every(lambda e: e.tag == "a" and bool(e.attrs.get("href")))])


def link_hrefs(html: Column) -> Column:
    """H2: array of truthy href values of <a> tags, DOM order, duplicates kept.

    Pages whose hrefs hold no reference but ``&amp;`` never leave the JVM.
    """
    hrefs = F.filter(F.transform(anchor_tags(html), href_of_tag), lambda h: h != "")
    return F.coalesce(_hrefs_by_tree(F.when(html.rlike(_RARE_HREF_RE), html)), hrefs)
