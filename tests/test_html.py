"""H1/H2 against a stdlib-parser rendering, plus hand-written edge cases."""

import random

from pyspark.sql import functions as F

import brute
from gleaner.functions.html import html_to_text, link_hrefs

EDGE_PAGES = [
    "<p>a<!-- hidden -->b</p>",
    '<script>var t="</p>";</script><p>after</p>',
    "<style>p{margin:0}</style><title>T</title><p>x</p>",
    "<p>open <b>bold <p>next",
    "<p>&amp;amp; &nbsp;x&nbsp;y &copy; &#169; &#x41; &amp</p>",
    '<a title="a>b" href="/x">link</a> tail',
    "<!DOCTYPE html><html><body>  many \n\t spaces  </body></html>",
    "plain text without tags",
    "",
    "<template><p>no</p></template><p>yes</p>",
    "<ruby>漢<rp>(</rp><rt>kan</rt><rp>)</rp></ruby> end",
    "a < b and c > d",
    "<script> a <!-- b </script> c --> d",
    "<!-- a <script> b --> c </script> d",
]


def test_page_text_matches_stdlib_parser(spark, sf_small):
    rows = (spark.read.parquet(f"{sf_small}/pages.parquet")
            .select("html", html_to_text(F.col("html")).alias("t")).collect())
    assert rows
    for r in rows:
        assert r.t == brute.html_text(r.html)


def test_edge_pages(spark):
    df = spark.createDataFrame([(h,) for h in EDGE_PAGES], "html string")
    got = [r.t for r in df.select(html_to_text(F.col("html")).alias("t")).collect()]
    assert got == [brute.html_text(h) for h in EDGE_PAGES]


def test_links_in_dom_order_without_commented_or_scripted(spark):
    html = ('<a href="/a">A</a><!-- <a href="/hidden">h</a> --><script>x="<a href=\'/s\'>"</script>'
            "<a href='/b'>B</a><a href=\"\">empty</a><a>none</a><A HREF=\"/c?x=1&amp;y=2\">C</A>"
            '<a href="/a">again</a><a href="mailto:x@y">m</a>')
    df = spark.createDataFrame([(html,)], "html string")
    assert df.select(link_hrefs(F.col("html")).alias("l")).first().l == [
        "/a", "/b", "/c?x=1&y=2", "/a", "mailto:x@y"]


def hostile_pages(n):
    quoted = " ".join(f'a{i}="v>{i}"' if i % 2 else f"b{i}='w>{i}'" for i in range(n))
    return [f"<div {quoted}>shown</div>", f"<a {quoted} href='/x?a=1&amp;b=2'>link</a>", f"<p>{'<b>' * n}deep", "<!--" + "-" * n + "--> end",
            f"<p {'x' * n}>long name</p>", "<p title=" + '"' + ">" * n + '"' + ">many brackets</p>"]


def test_any_number_of_attributes(spark):
    """Tags of 20,000 attributes, on any thread's stack."""
    pages = hostile_pages(20_000)
    df = spark.createDataFrame([(h,) for h in pages], "html string")
    got = df.select(html_to_text(F.col("html")).alias("t"), link_hrefs(F.col("html")).alias("l")).collect()
    assert [r.t for r in got] == [brute.html_text(h) for h in pages]
    assert [r.l for r in got] == [["/x?a=1&b=2"] if "href" in h else [] for h in pages]


def test_unbalanced_quotes_match_the_tokenizer(spark):
    pages = ["<p class='x\">one</p><p class=\"y'\">two</p>", "<p a=\"1\" b='2' c=\"3>4\">x</p>", "<p it's>a</p><p it's>b</p>",
             "a <b class=\"'\">bold</b> c", "<i a='\"' b=\"'\">x</i>y", "<p a=''b=\"\">z</p>",
             "<p a=\"x>rest", "<p a = 'x>y'>rest</p>", "<p a= >t</p>", "<p =\"a>b\">t</p>", "<p a=x'y>t</p>", "<p/ a>t", "<p \"a>b\">t"]
    rng = random.Random(3)
    parts = [" ", "a", "/", "b", " a='b>'", ' c="d>"', " x'y", " =z", " q="]
    pages += [f"<p{''.join(rng.choice(parts) for _ in range(rng.randrange(10)))}>t</p>" for _ in range(500)]
    df = spark.createDataFrame([(h,) for h in pages], "html string")
    got = [r.t for r in df.select(html_to_text(F.col("html")).alias("t")).collect()]
    tight = lambda t: "".join(t.split())  # noqa: E731 -- the tokenizer cuts an unclosed tag into pieces of text
    assert [tight(t) for t in got] == [tight(brute.html_text(h)) for h in pages]
