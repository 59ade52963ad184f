"""Result pages and listings with nesting, encoded references and odd markup."""

from pyspark.sql import functions as F

from gleaner.functions import html as H
from gleaner.operators import results as RR
from gleaner.operators.listings import listing


def test_nested_result_and_description(spark):
    html = ('<div class="result"><div>x</div><a title="t" href="/project/id/12/en?a=1&#38;b=2">Title <i>two</i></a>'
            "<div class='summary'><div>in</div> out</div></div>")
    df = spark.createDataFrame([(1, "http://h/s", html)], "page_id long, url string, html string")
    r = RR.parse_results(df).first()
    assert (r.selector, r.id, r.title, r.description, r.url) == (".result", "12", "Title two", "in out", "http://h/project/id/12/en?a=1&b=2")


def test_cut_comes_before_the_id_test(spark):
    html = "".join(f"<a href='/project/id/none{i}'>x</a>" for i in range(10)) + "<a href='/project/id/77'>y</a>"
    df = spark.createDataFrame([(1, "http://h/s", html)], "page_id long, url string, html string")
    assert RR.fallback_results(df).collect() == []
    assert [(r.pos, r.id) for r in RR.fallback_results(df, max_results=11).collect()] == [(0, "77")]


def test_listing_links_and_next(spark):
    html = ("<div class='eintrag'><p>first</p><h2><span><a href='/p/1?a=1&amp;b=2'>x</a></span></h2></div><a href='/no'>n</a>"
            "<div class='eintrag_alternate last'><h2 id=k><a rel=x href=/p/2>y</a></h2></div>"
            "<div class='listennaviright'><a href='/l?p=1&amp;q=2' class='b nextactive'>next</a></div>")
    df = spark.createDataFrame([(html,), (None,), ("",)], "html string")
    got = [tuple(r.l) for r in df.select(listing("html").alias("l")).collect()]
    assert got == [(["/p/1?a=1&b=2", "/p/2"], "/l?p=1&q=2"), ([], None), ([], None)]


def test_hrefs_with_any_reference(spark):
    df = spark.createDataFrame([("<a href='?a=1&#38;b=2'>x</a><a href=\"/c&eacute;\">y</a><!-- <a href='z'> -->",), ("<a href='u&amp;v'>",)], "h string")
    assert [r[0] for r in df.select(H.link_hrefs(F.col("h"))).collect()] == [["?a=1&b=2", "/cé"], ["u&v"]]


def test_download_probes_read_the_tree(spark):
    """Quoting, letter case, comments, references, nesting; only an element's own first text counts."""
    html = ("<div><!-- <a href='/c.xml'>XML</a> --><A HREF='/q?a=1&amp;format=xml'>get <b>it</b></A><a>XML only</a><a href=/n>no <i>XML</i></a>"
            "<section><h2 class=x>Download area</h2><div><p>x</p><div>y</div><a href='one'>One</a></div><a href=two>download " + "z" * 60 + "</a></section>"
            "<p>late <b>Download</b> " + "<i>download</i>" * 5 + "</p><script>download()</script></div>")
    df = spark.createDataFrame([(1, "http://h/s/p", html), (2, "http://h/", None), (3, "http://h/", "")], "page_id long, url string, html string")
    got = [tuple(r) for r in RR.download_probes(df).orderBy("kind", "pos").collect()]
    assert got == [
        (1, "download_element", 0, "h2", "Download area", None), (1, "download_element", 1, "a", "download " + "z" * 41 + "...", None),
        *[(1, "download_element", 2 + k, t, x, None) for k, (t, x) in enumerate([("b", "Download"), ("i", "download"), ("i", "download")])],
        (1, "section_link", 0, "a", "One", "http://h/s/one"), (1, "section_link", 1, "a", "download " + "z" * 60, "http://h/s/two"),
        (1, "xml_link", 0, "a", "get it", "http://h/q?a=1&format=xml"), (1, "xml_link", 1, "a", "XML only", None)]
