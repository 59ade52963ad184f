"""Record pages (R1-R6) and XML validation (X1-X8) on hand-written shapes."""

import os

from pyspark.sql import functions as F

from gleaner.functions.xml import document_facts
from gleaner.operators import records as R
from gleaner.operators import xmlrecords as X

RECORD_HTML = """
<div class="details"><h1 class="facelift">Title<br>Part 2</h1>
  <div><span class="name">Antragstellerin:</span><span class="value">Dr. B</span></div>
  <div><span class="name">Antragsteller:</span><span class="value">Dr. A</span></div>
  <div><span class="name">Beteiligte Institution:</span><span class="value">Uni <b>X</b></span></div>
  <div><span class="name">Leer:</span></div>
  <div><span class="name">Zwei::Punkte:</span><span class="value"> v &amp; w </span></div>
</div>
<div id="projekttext">Text <i>more</i></div>
<div id="projektbeschreibung"><div><span class="name">Fach:</span><span class="value">V</span></div>
<div><span class="name">Fach:</span><span class="value">W</span></div></div>
"""


def test_record_fields(spark):
    df = spark.createDataFrame([(1, RECORD_HTML), (2, "<p>no record</p>")], "doc_id long, html string")
    rows = {r.doc_id: r.fields for r in R.parse_records(df).collect()}
    assert rows[1] == {
        "Projekt": "TitlePart 2", "ZweiPunkte": "v & w", "Projektbeschreibung": "Text more", "Fach": "W",
        "Antragsteller/in": "Dr. A ; Dr. B", "Institution(en)": "Uni X"}
    assert rows[2] == {"Antragsteller/in": "", "Institution(en)": ""}
    wide = R.widen(R.parse_records(df))
    assert wide.columns == ["doc_id", "Antragsteller/in", "Fach", "Institution(en)", "Projekt",
                            "Projektbeschreibung", "ZweiPunkte"]
    assert wide.filter("doc_id = 2").first()["Fach"] == ""


def test_records_on_awkward_pages(spark):
    long = "Wort " * 200_000  # 1 MB of text
    pages = [
        (1, "<DIV CLASS='details x'><div><div><div><span class=name>A:</span></div><SPAN class='value'>1</span></div></div>"
            "<!-- <div><span class='name'>No</span><span class='value'>No</span></div> --></DIV>"
            "<div class=details><h1 class='big facelift'>T &lt;b&gt; \ue001</h1><div><span class=name>B</span><span class=value>2</span></div></div>"),
        (2, f"<div id='projekttext'><div>{long}</div></div>"),
        (3, None), (4, ""), (5, "<div class=details><div><span class=name>open"),
    ]
    df = spark.createDataFrame(pages, "doc_id long, html string")
    got = {r.doc_id: r.p for r in df.select("doc_id", R.record_pairs("html").alias("p")).collect()}
    assert [tuple(p) for p in got[1]] == [("Projekt", "T <b> \ue001"), ("A", "1"), ("B", "2")]
    assert got[2][0].value == long.strip()
    assert (got[3], got[4], got[5]) == (None, [], [])


def test_wide_csv_sink(spark, tmpdir_path):
    df = spark.createDataFrame([(1, RECORD_HTML)], "doc_id long, html string")
    out = os.path.join(tmpdir_path, "wide")
    R.write_wide_csv(R.widen(R.parse_records(df)), out)
    back = spark.read.option("header", True).csv(out)
    assert back.first()["Antragsteller/in"] == "Dr. A ; Dr. B"


PAD = "<objective>" + "x" * 1000 + "</objective>"


def doc(body, root="project", ns=' xmlns="http://cordis.europa.eu"'):
    return f"<{root}{ns}>{body}{PAD}</{root}>"


XML_CASES = {
    "ok": (doc("<id>7</id><title>T</title><startDate>d</startDate><totalCost>1</totalCost>"), True, None, []),
    "malformed": ("<project><id>7</id>", False, "malformed", []),
    "trailing": (doc("<id>7</id>") + "<x/>", False, "malformed", []),
    "root": (doc("<id>7</id>", root="record"), False, "root", []),
    "prefixed": ('<c:project xmlns:c="http://cordis.europa.eu"><c:id>7</c:id><c:title>T</c:title>'
                 "<c:startDate>d</c:startDate><c:totalCost>1</c:totalCost>" + PAD + "</c:project>", True, None, []),
    "other_ns": (doc("<id>7</id><title>T</title><startDate>d</startDate><totalCost>1</totalCost>",
                     ns=' xmlns="http://other"'), True, None, ["namespace"]),
    "mismatch": (doc("<id>8</id>"), False, "id_mismatch", []),
    "empty_id": (doc("<id/>"), False, "id_empty", []),
    "blank_id": (doc("<id> </id>"), False, "id_mismatch", []),
    "no_id": (doc("<title>T</title><startDate>d</startDate><totalCost>1</totalCost>"), True, None, ["no_id"]),
    "nested_first": (doc("<rel><id>7</id></rel><id>9</id><title>T</title><startDate>d</startDate>"
                         "<totalCost>1</totalCost>"), True, None, []),
    "missing": (doc("<id>7</id><title> </title><x><title>nested</title></x>"), True, None,
                ["missing:startDate", "missing:totalCost"]),
    "small": ("<project><id>7</id><title>T</title><startDate>d</startDate><totalCost>1</totalCost></project>",
              False, "too_small", []),
}


def test_xml_verdicts(spark):
    rows = [(k, "7", v[0]) for k, v in XML_CASES.items()]
    df = spark.createDataFrame(rows, "name string, project_id string, xml string").withColumn(
        "file_size", F.octet_length("xml").cast("bigint"))
    got = {r.name: r for r in X.validate(df).collect()}
    for name, (_, valid, error, warnings) in XML_CASES.items():
        assert got[name].valid == valid, name
        assert got[name].error == error, name
        assert got[name].warnings == warnings, name


def test_xml_metadata_first_nonblank_any_depth():
    f = document_facts(doc("<id>7</id><title> </title><x><title>nested</title></x><title>later</title>"))
    assert f["fields"]["title"] == "nested"
    assert f["fields"]["id"] == "7"
    assert document_facts("<project>")["wellformed"] is False


def test_size_bounds(spark):
    base = "<project><id>7</id><x>"
    for size, small in ((999, True), (1000, False)):
        body = base + "y" * (size - len(base) - len("</x></project>")) + "</x></project>"
        assert len(body.encode()) == size
        df = spark.createDataFrame([("7", body)], "project_id string, xml string").withColumn(
            "file_size", F.octet_length("xml").cast("bigint"))
        assert (X.validate(df).first().error == "too_small") == small


def test_metadata_round_trip_property(spark):
    import random
    import xml.etree.ElementTree as ET

    from gleaner.functions.xml import METADATA_FIELDS

    rnd = random.Random(11)
    alphabet = "ab <>&\"' \t\nçé€"
    rows, expected = [], {}
    for i in range(150):
        root = ET.Element("project")
        fields = {}
        for f in METADATA_FIELDS:
            if rnd.random() < 0.2:
                continue  # field absent
            text = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 12)))
            ET.SubElement(root, f).text = text
            if text.strip():
                fields[f] = text.strip()
        ET.SubElement(root, "pad").text = "x" * 1000
        rows.append((str(i), ET.tostring(root, encoding="unicode")))
        expected[str(i)] = {f: fields.get(f) for f in METADATA_FIELDS}
    df = spark.createDataFrame(rows, "project_id string, xml string")
    got = {r.project_id: r.facts.fields.asDict() for r in X.with_facts(df).collect()}
    assert got == expected
