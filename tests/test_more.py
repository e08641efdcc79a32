import datetime
import io
import zipfile

import pytest
from pyspark.sql import functions as F

from quillstack.functions import titles
from quillstack.operators import flow, layout, regulation
from quillstack.schemas import OCR_WORD
from quillstack.sources import containers

#: Titles and what they say.
TITLES = [
    ("Normal Gazette 2020", "2020", "complete", None), ("Complete Normal Gazette of 2023", "2023", "complete", None),
    ("Normal Gazette-2023", "2023", "complete", None), ("Normal Gazette No.1 to 24 of 2024", "2024", "1-24", None),
    ("Normal Gazette No 19 of 2024", "2024", None, "19"), ("Normal Gazette No 21of 2024", "2024", None, "21"),
    ("Normal Gazette No. 22 of 2024", "2024", None, "22"), ("Normal Gazette No.5 of 2024", "2024", None, "5"), ("NG 4 of 2024", "2024", None, "4"),
    ("NG No.5, Part-I, 2023", "2023", "I", "5"), ("1. NG. part-1, 2024", "2024", "1", "1"), ("NG. No. 6. Part-I,  2023", "2023", "I", "6"),
    ("Normal Gazette No 4 part-4", None, "4", "4"), ("NG No.2, 2024", "2024", None, "2"),
]


def test_titles(spark):
    rows = spark.createDataFrame(TITLES, "t string, year string, part string, num string")
    for r in rows.withColumn("x", titles.parts_of_title(F.col("t"))).collect():
        assert tuple(r["x"]) == (r["year"], r["part"], r["num"]), r["t"]
    one = spark.createDataFrame(
        [("VOL. LX No.9 FRIDAY, 10th MAY, 2024 / 20th VIASAKHA, 1946 (SAKA)", "Official Gazette : Series - II No. 12", "12-03-21-IX.pdf", "Issue Number: 7, Part: I-B, Gazette Page: 12")],
        "v string, s string, f string, c string",
    ).select(titles.volume_of_title(F.col("v")), titles.series_of_title(F.col("s")), titles.date_of_file_name(F.col("f")), titles.captions(F.col("c"))).first()
    assert tuple(one[0]) == (datetime.date(2024, 5, 10), "LX", "9") and tuple(one[1]) == ("Ordinary", "II", "12")
    assert tuple(one[2]) == (datetime.date(2021, 3, 12), "IX") and one[3] == {"Issue Number": "7", "Part": "I-B", "Gazette Page": "12"}


def test_paragraphs(spark):
    box = lambda t, l=0: (l, t, 500, t + 10)
    lines = [
        ("d", 1, 0, "The first line of a para-", box(0)), ("d", 1, 1, "graph ends here.", box(12)), ("d", 1, 2, "Next one goes", box(40)),
        ("d", 2, 0, "on over the page.", box(0)), ("d", 2, 1, "(a) an item", box(12)), ("d", 2, 2, "more of it", box(24)),
    ]
    got = flow.paragraph_texts(spark.createDataFrame(lines, "doc string, page int, line int, text string, box struct<l:int,t:int,r:int,b:int>")).orderBy("para").collect()
    assert [(r["first_page"], r["text"]) for r in got] == [(1, "The first line of a paragraph ends here."), (1, "Next one goes on over the page."), (2, "(a) an item more of it")]


def test_tables(spark):
    rows = []
    for k, cells in enumerate([("No", "Name", "Sum"), ("1", "Ann", "10"), ("2", "Bob", "20")]):
        for c, text in enumerate(cells):
            rows.append(("d", 1, 0, 0, 10 * k + c, text, (c * 150, k * 20, c * 150 + 40, k * 20 + 10), 1.0, []))
    words = layout.stitched(spark.createDataFrame(rows, OCR_WORD))
    bounds = flow.table_columns(words)
    assert bounds.first()["bounds"] == [150, 300]
    html = flow.table_html(flow.table_cells(words, bounds)).first()["html"]
    assert html == "<table><tr><td>No</td><td>Name</td><td>Sum</td></tr><tr><td>1</td><td>Ann</td><td>10</td></tr><tr><td>2</td><td>Bob</td><td>20</td></tr></table>"


def test_containers(spark):
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        z.writestr("a/b.txt", "hello")
    rows = spark.createDataFrame([(1, data.getvalue()), (2, b"no archive"), (3, None)], "id int, content binary")
    got = {r["id"]: r["m"] for r in rows.select("id", containers.members("content").alias("m")).collect()}
    assert [(m["name"], bytes(m["content"])) for m in got[1]] == [("a/b.txt", b"hello")] and got[2] == [] and got[3] == []
    pdf = spark.createDataFrame([(b"<< /A << /URI (http://x.y/z) >> /URI(http://x.y/z) >>",)], "c binary")
    assert pdf.select(containers.pdf_links(F.col("c")).alias("l")).first()["l"] == ["http://x.y/z"]


def test_xml_to_document(spark):
    xml = '<code><division type="chapter"><number>1</number><name>One</name><division type="section" version="2"><number>1.1</number><para>Text &amp; more</para></division></division></code>'
    nodes = containers.node_table(spark.createDataFrame([("r", xml), ("bad", "<a>")], "reg string, xml string"), "reg", "xml")
    assert [(r["node"], r["parent"], r["tag"], r["num"]) for r in nodes.orderBy("node").collect()] == [(1, None, "code", None), (2, 1, "division", "1"), (3, 2, "division", "1.1"), (4, 3, "para", None)]
    made = regulation.identified(regulation.dispatched(nodes, regulation.rule_table(spark)).where("becomes IS NOT NULL"))
    xml = containers.akn_document(made).first()["xml"]
    assert xml == '<body><chap eId="chap_1"><num>1</num><heading>One</heading><sec eId="chap_1__sec_1"><num>1.1</num><p eId="sec_1__p_1">Text &amp; more</p></sec></chap></body>'


@pytest.mark.parametrize("text", [None, "", "   "])
def test_empty_titles(spark, text):
    row = spark.createDataFrame([(text,)], "t string").select(titles.parts_of_title(F.col("t")).alias("x")).first()["x"]
    assert row["part"] is None and row["num"] is None


def test_translation_keeps_the_markup(spark):
    from quillstack.functions import html

    page = "<!DOCTYPE html><html lang='hi'><head><title>T</title></head><body><p class=x>One &amp; <b>two</b></p> , <i>a b</i><!-- c --></body></html>"
    rows = spark.createDataFrame([(1, page), (2, None)], "id int, page string")
    texts = {r["id"]: r["t"] for r in rows.select("id", html.translatable("page").alias("t")).collect()}
    assert texts == {1: ["One ", "two", "a b"], 2: []}
    out = rows.select("id", html.translated("page", F.array(F.lit("Eins "), F.lit("zwei"), F.lit("x < y")), F.lit("de")).alias("p")).collect()[0]["p"]
    assert out == page.replace("'hi'", '"de"').replace("One ", "Eins ").replace("two", "zwei").replace("a b<", "x &lt; y<")


def test_columns_and_cache(spark):
    from quillstack.operators import sets

    rows = [("d", 1, 0, 0, k, str(k), (x, 0, x + 10, 10), 1.0, []) for k, x in enumerate((0, 20, 60, 80))]
    words = layout.stitched(spark.createDataFrame(rows, OCR_WORD)).withColumn("width", F.lit(100))
    two = layout.two_columns(words)
    assert [r["two"] for r in two.collect()] == [False]  # one gap of 30 is not 2.5 times the mean of 10, 30 and 10
    split = layout.split_columns(words, spark.createDataFrame([("d", 1, 0, True)], "doc string, page int, block int, two boolean"))
    assert [r["column"] for r in split.orderBy("word").collect()] == [0, 0, 1, 1]
    asked, store = spark.createDataFrame([("a",), ("b",), ("b",)], "url string"), spark.createDataFrame([("a", 1), ("c", 2)], "url string, v int")
    found, missing = sets.cached(asked, store, "url")
    assert [r["v"] for r in found.collect()] == [1] and [r["url"] for r in missing.collect()] == ["b"]
