import datetime

import pytest
from pyspark.sql import functions as F

from quillstack.functions import dates, html, text
from quillstack.operators import extract, filters, ordering


def value(spark, column, **inputs):
    schema = ", ".join(f"{k} {v[1]}" for k, v in inputs.items()) or "x int"
    data = [tuple(v[0] for v in inputs.values())] if inputs else [(1,)]
    return spark.createDataFrame(data, schema).select(column.alias("v")).first()["v"]


DAY = datetime.date(2014, 10, 3)


@pytest.mark.parametrize(
    "function, given, want",
    [
        (dates.month_day_year, "October 3, 2014", DAY), (dates.month_day_year, "10/3/2014", DAY), (dates.month_day_year, "3rd October 2014", DAY),
        (dates.ordinal_date, "12th April 2024", datetime.date(2024, 4, 12)), (dates.ordinal_date, "12 April 2024", None),
        (dates.ordinal_date, "31st February 2024", None), (dates.named_date, "12 Apr 2024", datetime.date(2024, 4, 12)),
        (dates.day_month_year, "05-04-2018", datetime.date(2018, 4, 5)), (dates.day_month_year, "none", None),
        (dates.month_of_year, "April 24", datetime.date(2024, 4, 1)), (dates.month_number, "FRBRUARY", 2), (dates.month_number, "sep", 9),
        (dates.month_number, "", None), (dates.relurl_date, "a/2024-04-18/2", datetime.date(2024, 4, 18)), (dates.relurl_date, "a/2024-13-18/2", None),
        (dates.year_in_text, "Vol 2 of 1923", 1923), (dates.year_in_text, "in 2031", None), (dates.guarded_year, "1599", None),
        (dates.guarded_year, " 1885 ", 1885), (dates.unpadded, "4 5 2001", "2001-4-5"), (dates.any_date, None, None),
    ],
)
def test_dates(spark, function, given, want):
    assert value(spark, function(F.col("t")), t=(given, "string")) == want


def test_all_dates_and_defaults(spark):
    got = value(spark, dates.all_dates(F.col("t")), t=("Dated 01.02.2019 and 3/4/2020, not 45.1.2020", "string"))
    assert got == [datetime.date(2019, 2, 1), datetime.date(2020, 4, 3)]
    today = datetime.date(2024, 3, 20)
    assert dates.default_window(None, None, today) == (datetime.date(2024, 3, 5), today)
    assert dates.default_window(today, None, today) == (today, today) and dates.default_window(None, DAY, today) == (DAY, DAY)


@pytest.mark.parametrize(
    "given, want",
    [(0, "0"), (999, "999"), (1000, "1,000"), (100000, "1,00,000"), (466219, "4,66,219"), (12345678, "1,23,45,678"), (-100000, "-1,00,000"), (None, "")],
)
def test_indian_grouping(spark, given, want):
    assert value(spark, text.indian_grouping(F.col("n")), n=(given, "long")) == want


@pytest.mark.parametrize(
    "given, want",
    [
        ("central_extraordinary/2024-04-18/253767", "central_extraordinary/2024-04-18/253767"), ("/andhra/2018-05-04/2758/", "andhra/2018-05-04/2758"),
        ("a/../b", None), ("a/./b", None), ("one", None), ("", None), (None, None), ("a/b c", None), ("a/b;c", None), ("a/b|c", None), ("a/$(b)", None), ("a/" + "b" * 511, None),
    ],
)
def test_relurls(spark, given, want):
    assert value(spark, filters.valid_relurl(F.col("u")), u=(given, "string")) == want


def test_identifiers(spark):
    fields = {k: F.lit(v) for k, v in dict(gznum="12", gztype="Ex", series="I", bookid="WB00123").items()}

    def of(rule, relurl, prefix=None):
        return value(spark, text.identifier(F.lit(relurl), F.lit(rule), F.lit(prefix).cast("string"), F.lit(datetime.date(2024, 4, 18)), fields))

    assert of("basic", "central_extraordinary/2024-04-18/253767", "in.gazette.central.e.") == "in.gazette.central.e.2024-04-18.253767"
    assert of("basic", "x/a b,c/(1)") == "in.gazette.x.abc.1"
    assert of("dated", "x/y/77") == "in.gazette.x.2024-04-18.77" and of("dated_number", "x/y") == "in.gazette.x.2024-04-18.12.Ex"
    assert of("number_series", "goa/1") == "in.gazette.goa.12.I" and of("book", "wbsl/1", "wbsl.") == "wbsl.WB00123"
    assert len(of("cut", "x/" + "y" * 100, "")) == 69


def test_titles_and_texts(spark):
    assert value(spark, text.published_title(F.lit("Weekly"), F.lit(DAY), F.lit(None).cast("string"), F.lit("Part II"), F.lit("7"))) == "Weekly, 03 October 2014, Part II, Number 7"
    assert value(spark, text.kind_of_title(F.lit("Index to the Supplement"))) == "Index"
    assert value(spark, text.split_keywords(F.lit("landWater actA"))) == "land, Water act, A"
    assert [value(spark, text.padded_page(F.lit(p), F.lit(n))) for p, n in ((3, 120), (12345, 20), (7, 99999))] == ["003", "12345", "0007"]
    assert value(spark, text.index_head(F.lit("é" * 10 + " " + "é" * 10), 31)) == "é" * 10 + " " + "é" * 5
    assert value(spark, text.index_head(F.lit("e" * 20 + " " + "é" * 10), 31)) == "e" * 20
    assert value(spark, text.index_head(F.lit("ééé"), 3)) == "é"
    assert value(spark, text.highlighted(F.lit("a<b \x02hit\x03 & c"))) == "a&lt;b <mark>hit</mark> &amp; c"
    assert value(spark, text.fixed_url(F.lit("http://a.b/x y/é%20?q=1 2"))) == "http://a.b/x%20y/%C3%A9%20?q=1+2"
    assert value(spark, text.file_name_of_url(F.lit("http://a.b/x/y.pdf?id=3&k=v"))) == "x_y.pdf_3_v"
    assert value(spark, text.language_names(F.array(F.lit("hin"), F.lit("xyz")))) == ["Hindi", "XYZ"]
    assert value(spark, text.language_code(F.lit("bengali"))) == "ben" and value(spark, text.language_code(F.lit("Klingon"))) == "kli"
    assert value(spark, text.extension_of_content(F.lit(b"%PDF-1.4"))) == "pdf" and value(spark, text.extension_of_content(F.lit(b" <HTML>"))) == "html"
    assert value(spark, text.decoded(F.lit("data:application/pdf;base64,aGk="))) == b"hi"
    assert value(spark, text.decoded_text(F.lit("é".encode("latin-1")))) == "é"
    assert [value(spark, text.sentence_end(F.lit(t))) for t in ("It ends.", "Dr.", "of No.", "", "no end")] == [True, False, False, False, False]
    assert [value(spark, text.heading_tag(F.lit(t))) for t in ("CHAPTER I", "SHORT TITLE", "1. Scope", "this is a long enough line of text")] == ["h2", "h3", "h4", "p"]
    assert value(spark, text.listed(F.array(F.struct(F.lit("1").alias("n"), F.lit("Home").alias("d")), F.struct(F.lit("2").alias("n"), F.lit("").alias("d"))), {"n": "No", "d": "Dept"})) == "No: 1 | Dept: Home<br/>No: 2"


def test_html(spark):
    page = "<html><head><title>T</title><style>p{}</style></head><body onload='x()'><p class='s' onclick='y'>One&nbsp; two<br>three<script>bad()</script></p><blink>b<a href='javascript:z'>l</a></blink><img src=x><div>tail"
    assert value(spark, html.plain_text(F.col("p")), p=(page, "string")) == "One two\nthree\nb\nl\ntail"
    assert value(spark, html.safe_fragment(F.col("p")), p=(page, "string")) == '<p class="s">One  two<br/>three</p>b<a>l</a><div>tail</div>'
    assert value(spark, html.plain_text(F.col("p")), p=(None, "string")) is None
    table = "<table><tr><td><table><tr><th>No</th><th>Subject</th></tr><tr><td>7<td> Land <a href='x.pdf'>pdf</a></tr></table></td></tr></table>"
    got = value(spark, html.table_rows(F.col("p")), p=(table, "string"))
    assert [(r["tbl"], r["leaf"], r["header"], r["cells"], r["hrefs"]) for r in got if r["leaf"]] == [(1, True, True, ["No", "Subject"], []), (1, True, False, ["7", "Land pdf"], ["x.pdf"])]
    form = "<form><input name=a value=1><input type=checkbox name=c><select name=s><option value=x>X<option value=y selected>Y</select></form>"
    assert value(spark, html.form_fields(F.col("p")), p=(form, "string")) == {"a": "1", "s": "y"}
    ranges = F.array(*[F.struct(F.lit(a).alias("start"), F.lit(b).alias("end"), F.lit(t).alias("tag")) for a, b, t in ((0, 7, "p"), (2, 5, "b"), (5, 7, "i"))])
    assert value(spark, html.marked_up(F.lit("a&b<cde!"), ranges)) == "<p>a&amp;<b>b&lt;c</b><i>de</i></p>!"


def test_extract(spark):
    order = extract.header_order(F.array(F.lit("Gazette No."), F.lit("Dept"), F.lit("Subject")), {"gznum": "no\\.?$", "subject": "subject"})
    assert value(spark, extract.assigned(order, F.array(F.lit(" 7 "), F.lit("x"), F.lit("Land")))) == {"gznum": "7", "subject": "Land"}
    tables = spark.createDataFrame([("p", 0, 3, True), ("p", 1, 9, False), ("p", 2, 3, True)], "g string, idx int, n_rows int, leaf boolean")
    assert extract.largest_table(tables, "g").first()["idx"] == 0
    links = spark.createDataFrame([("p", 0, "1", "a", 1), ("p", 1, "2", "b", 1), ("p", 2, "2", "c", 1)], "g string, idx int, text string, href string, now int")
    assert [r["href"] for r in extract.next_page(links, "g", "now").collect()] == ["b"]
    assert value(spark, F.size(extract.zipped_links(F.array(F.lit(1), F.lit(2)), F.array(F.lit("a"))))) == 1


def test_pages_and_filters(spark):
    assert ordering.effective_order(None, True) == "relevance" and ordering.effective_order("relevance", False) == "newest" and ordering.effective_order("oldest", True) == "oldest"
    assert ordering.elided_range(10, 20) == [1, None, 8, 9, 10, 11, 12, None, 20] and ordering.elided_range(1, 1) == [1] and ordering.elided_range(4, 9) == [1, 2, 3, 4, 5, 6, None, 9]
    rows = spark.createDataFrame([(1, "a", " "), (2, "b", "x"), (3, None, "y")], "id int, k string, v string")
    good, bad = filters.complete(rows, ["k", "v"])
    assert [r["id"] for r in good.collect()] == [2] and {r["id"]: r["missing"] for r in bad.collect()} == {1: ["v"], 3: ["k"]}
    fixed = filters.override(rows, spark.createDataFrame([("b", "new")], "k string, v string"), "k", ["v"])
    assert sorted((r["id"], r["v"]) for r in fixed.collect()) == [(1, " "), (2, "new"), (3, "y")]
    assert [r["id"] for r in filters.deny(rows, "k", ["a"], "^b").collect()] == [3]
    meta = F.create_map(F.lit("gz_part"), F.lit("II"), F.lit("title"), F.lit("t"), F.lit("empty"), F.lit(""))
    assert [tuple(r) for r in value(spark, filters.residual(meta, ["title"]))] == [("Gz Part", "II")]
    assert value(spark, ordering.natural_key(F.lit("a10b2"))) > value(spark, ordering.natural_key(F.lit("a9b11")))
