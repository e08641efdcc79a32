"""Paragraphs over pages, tables of gaps, title grammars, entities and orders of a language."""

import datetime

import pytest
from pyspark.sql import functions as F

from quillstack.operators import facets, ordering, page_flow, tables, title_rules
from quillstack.sources import containers, entities
from test_more import TITLES

LINE = "doc string, page int, height int, column int, block int, para int, line int, text string, box struct<l:int,t:int,r:int,b:int>"


def flowing(spark, pages):
    """pages: lists of (block, para, top, text); a page is 1,000 high, a line 10."""
    rows = [("d", p, 1000, 0, block, para, k, text, (0, top, 500, top + 10)) for p, lines in enumerate(pages, 1) for k, (block, para, top, text) in enumerate(lines)]
    return spark.createDataFrame(rows, LINE)


def test_runs_of_capitals_and_marks(spark):
    lines = [
        (0, 0, 0, "plain start"), (0, 0, 12, "Some Of"), (0, 0, 24, "A Head In"), (0, 0, 36, "Three Lines"), (0, 0, 48, "plain again"),
        (0, 0, 60, "a) an item"), (0, 0, 72, "12 34"), (0, 0, 84, "ends here."), (0, 0, 110, "stands off"), (0, 0, 122, "Capital but near"), (0, 0, 150, "Capital and far"),
    ]
    got = page_flow.layout_paragraphs(flowing(spark, [lines])).orderBy("line").collect()
    assert [r["paragraph"] for r in got] == [1, 2, 2, 2, 2, 3, 4, 4, 5, 5, 6]


def test_a_paragraph_goes_over_a_page_with_a_footnote(spark):
    pages = [
        [(0, 0, 0, "First sentence."), (1, 0, 100, "Open text that goes"), (1, 0, 112, "on and on be-"), (2, 0, 900, "1 a note")],
        [(0, 0, 0, "yond the page."), (0, 1, 12, "Next."), (1, 0, 50, "left open")],
        [(0, 0, 0, "HEAD IN CAPITALS"), (1, 0, 880, "x"), (1, 0, 950, "2 note.")],
    ]
    lines = flowing(spark, pages)
    texts = {r["paragraph"]: (r["first_page"], r["last_page"], r["text"]) for r in page_flow.paragraph_texts(lines).collect()}
    assert texts[2] == (1, 2, "Open text that goes on and on beyond the page.") and texts[4] == (2, 2, "left open") and texts[5][2] == "HEAD IN CAPITALS"
    html = page_flow.document_html(lines).first()["html"]
    assert html.split("\n") == [
        "<p>First sentence.</p>", '<span class="footnote">1 a note</span>', '<span class="pageend" data-pagenum="1"></span>',
        "<p>Open text that goes on and on beyond the page.</p>", "<p>Next.</p>", "<p>left open</p>", '<span class="pageend" data-pagenum="2"></span>',
        "<p>HEAD IN CAPITALS</p>", "<p>x</p>", '<span class="footnote">2 note.</span>', '<span class="pageend" data-pagenum="3"></span>',
    ]
    assert page_flow.document_html(lines.limit(0)).count() == 0


TABLE = [
    "No   Name       Amount",
    "1    Ann        10",
    "2    Bob Ray    200",
    "3    Carol      3,000",
    "",
    "Carried over    5",
    "4    <Dora>  x  7",
    "5    Ed",
    "6    Fay",
]


def test_tables_of_gap_ends(spark):
    lines = spark.createDataFrame([("d", 1, k, t) for k, t in enumerate(TABLE)] + [("d", 2, k, f"plain line {k}") for k in range(3)], "doc string, page int, line int, text string")
    found = tables.pieces(lines)
    assert [tuple(r)[3:] for r in found.where("page = 1 AND line = 2").orderBy("start").collect()] == [(0, 1, "2"), (5, 12, "Bob Ray"), (16, 19, "200")]
    html = {r["page"]: r["html"] for r in tables.page_html(lines).collect()}
    assert html[2] == "<p>plain line 0</p><p>plain line 1</p><p>plain line 2</p>"
    rows = html[1].removeprefix("<table><tr>").removesuffix("</tr></table>").split("</tr><tr>")
    assert rows[0] == "<td>No</td><td>Name</td><td>Amount</td>" and rows[2] == "<td>2</td><td>Bob Ray</td><td>200</td>"
    assert rows[4] == '<td colspan="2">Carried over</td><td>5</td>' and rows[5] == "<td>4</td><td>&lt;Dora&gt;</td><td>x 7</td>" and rows[7] == "<td>6</td><td>Fay</td><td></td>"


def spanned(spark, text, bounds):
    """The cells (col, span, text) of a line over given columns."""
    found = tables.pieces(spark.createDataFrame([("d", 1, 0, text)], "doc string, page int, line int, text string"))
    columns = spark.createDataFrame([("d", 1, bounds)], "doc string, page int, columns array<struct<start:int,end:int>>")
    return [tuple(r)[3:] for r in tables.cells(found, columns).orderBy("col").collect()]


@pytest.mark.parametrize(
    "text, want",
    [
        ("ab    cd    ef", [(1, 1, "ab"), (2, 1, "cd"), (3, 1, "ef")]),
        ("one that is long", [(1, 3, "one that is long")]),
        ("      reaches on", [(1, 1, ""), (2, 2, "reaches on")]),
        ("a  b        x", [(1, 1, "a b"), (2, 1, ""), (3, 1, "x")]),
        ("a    bc", [(1, 1, "a"), (2, 1, "bc"), (3, 1, "")]),
        ("long one  y  z", [(1, 2, "long one y"), (3, 1, "z")]),
        ("            far beyond", [(1, 1, ""), (2, 1, ""), (3, 1, "far beyond")]),
    ],
)
def test_cells_by_overlap(spark, text, want):
    assert spanned(spark, text, [(0, 4), (6, 10), (12, 16)]) == want


def test_marker_choice(spark):
    # an end beside a more frequent one is the same column; gaps that reach into the column before are none
    lines = ["aaaa  bb"] * 3 + ["aaaaa  bb"] * 4 + ["aaaa   bb   c"] * 3
    rows = spark.createDataFrame([("d", 1, k, t) for k, t in enumerate(lines)], "doc string, page int, line int, text string")
    ends = {r["at"]: (r["n"], r["length"]) for r in tables.gap_ends(tables.pieces(rows)).collect()}
    assert ends == {6: (3, 2), 7: (7, 3), 12: (3, 3)}  # of the lengths 2 (four times) and 3 (three times) the rarer
    assert [tuple(c) for c in tables.columns(tables.pieces(rows)).first()["columns"]] == [(0, 4), (7, 9), (12, 13)]


def test_golden_titles_by_rules(spark):
    rows = spark.createDataFrame([("arunachal", t, None) for t, *_ in TITLES], "source string, title string, day date")
    got = {r["title"]: r["said"] for r in title_rules.read_titles(rows, title_rules.rule_table(spark)).collect()}
    for title, year, part, num in TITLES:
        assert (got[title].get("year"), got[title].get("part"), got[title].get("num")) == (year, part, num), title


def test_title_rules_turns_parts_and_corrections(spark, monkeypatch):
    rules = spark.createDataFrame(
        [("s", 1, 2, "No ([0-9]+)", {"num": "$1"}), ("s", 1, 1, "No ([0-9]+) of ([0-9]+)", {"num": "$1", "year": "$2"}), ("s", 2, 1, "Part (\\w+)", {"part": "$1"}), ("s", 3, 1, "(\\w*) Part", {"part": "no", "kind": "$1"})],
        "source string, part int, turn int, pattern string, fields map<string,string>",
    )
    fixes = spark.createDataFrame(
        [("s", "wrong", None, {"num": "1"}), ("s", "wrong", "2024-01-02", {"year": "2024", "month": "Feb", "day_of_month": "30"}), ("s", "right", "2024-01-02", {"year": "2024", "month": "March", "day_of_month": "5"})],
        "source string, title string, day string, fields map<string,string>",
    )
    day = datetime.date(2024, 1, 2)
    rows = [("s", "x No 5 of 2020 Part II y", None), ("s", "No 7", None), ("s", "none", None), ("t", "No 7", None), ("s", None, None), ("s", "wrong", None), ("s", "wrong", day), ("s", "right", day), (None, "No 7", None)]
    for bound in (title_rules.BROADCAST_RULES, 0):
        monkeypatch.setattr(title_rules, "BROADCAST_RULES", bound)
        read = title_rules.read_titles(spark.createDataFrame(rows, "source string, title string, day date"), rules, fixes)
        got = {(r["source"], r["title"], r["day"]): (r["said"], r["date"]) for r in read.collect()}
        assert got["s", "x No 5 of 2020 Part II y", None] == ({"num": "5", "year": "2020", "part": "II", "kind": "2020"}, None)
        assert got["s", "No 7", None] == ({"num": "7"}, None) and got["s", "none", None] == got["t", "No 7", None] == got["s", None, None] == got[None, "No 7", None] == ({}, None)
        assert got["s", "wrong", None] == ({"num": "1"}, None) and got["s", "wrong", day][1] is None and got["s", "wrong", day][0]["month"] == "Feb"
        assert got["s", "right", day][1] == datetime.date(2024, 3, 5)


def test_declared_entities(spark):
    text = """<!ENTITY a "x &b; &#38; &#x41;"> <!ENTITY b 'b"&unknown;'> <!ENTITY a "second">
    <!-- <!ENTITY hidden "h"> --> <!ENTITY % par "p"> <!ENTITY ext SYSTEM "file.xml"> <!ENTITY loop "&pool;"> <!ENTITY pool "&loop;">
    <!ENTITY empty ""> <!ENTITY lt "&#38;#60;"> <!ENTITY markup "<i>&amp;</i>"> <!ENTITY odd "&#0;&#xD800;">"""
    table = entities.declared(spark.createDataFrame([(text,)], "value string"))
    assert {r["name"] for r in table.collect()} == {"a", "b", "loop", "pool", "empty", "lt", "markup", "odd"}
    known = entities.resolved(table)
    assert known == {"a": 'x b"&unknown; & A', "b": 'b"&unknown;', "empty": "", "lt": "&#60;", "markup": "<i>&amp;</i>", "odd": "&#0;&#xD800;"}
    assert entities.with_entities("&a;|&lt;|&zz;|&markup;|&#65;", known) == 'x b"&amp;unknown; &amp; A|&lt;|&zz;|&lt;i>&amp;amp;&lt;/i>|&#65;'
    files = spark.createDataFrame([(1, "<code><name>&empty;&markup; &eacute;</name></code>"), (2, "<code>&zz;</code>")], "k int, xml string")
    assert [(r["reg"], r["title"]) for r in containers.node_table(files, "k", "xml", known).collect()] == [(1, "<i>&amp;</i> é")]
    deep = spark.createDataFrame([(f"e{k}", f"&e{k + 1};&e{k + 1};&e{k + 1};&e{k + 1};") for k in range(15)] + [("e15", "lol")], "name string, value string")
    assert len(entities.resolved(deep)) < 16  # texts that grow without measure are left out


def test_orders_of_a_language(spark):
    names = ["Zebra", "apple", "Éclair", "eclair", "ecole", "Ähre", "ahre", "AHRE"]
    rows = spark.createDataFrame([(n, n) for n in names], "name string, title string")
    shown = lambda c: [r["title"] for r in ordering.by_title(rows, c).collect()]
    assert shown(None) == sorted(names) and shown("UNICODE") == ["ahre", "AHRE", "Ähre", "apple", "eclair", "Éclair", "ecole", "Zebra"]
    assert shown("UNICODE_CI")[:2] == ["AHRE", "ahre"]
    hits = spark.createDataFrame([(n,) for n in names], "source string")
    assert [r["name"] for r in facets.source_facets(hits, rows, limit=3, collation="UNICODE").collect()] == ["ahre", "AHRE", "Ähre"]
    counted = rows.withColumn("gazette_count", F.lit(1))
    assert ordering.largest_sources(counted, 3, "UNICODE").collect()[2]["name"] == "Ähre"
