import datetime
import random

import pytest
from pyspark.sql import functions as F

from quillstack.operators import analysis, ingest, layout, ordering, regulation, search, sets, windows
from quillstack.plans.search_plan import Archive, Criteria
from quillstack.schemas import OCR_WORD
from quillstack.sources import assets, scripts, sinks
from quillstack.streaming import feeds

GAZETTES = [
    (1, "central", datetime.date(2024, 4, 18), 2024, "Canals of the lower delta", "Lock gate and canal works near Aldur"),
    (2, "central", datetime.date(2023, 1, 5), 2023, "Joint forest survey in hills", "circular, northern range forest"),
    (3, "andhra", datetime.date(2022, 6, 10), 2022, "Harbour dredging", "harbour board"),
    (4, "andhra", None, None, "Undated", "nothing here"),
]


def archive(spark):
    rows = spark.createDataFrame(GAZETTES, "id long, source string, date date, year int, title string, body string")
    sources = spark.createDataFrame([("central", "Central"), ("andhra", "Andhra"), ("goa", "Goa")], "name string, title string")
    return Archive(rows, search.postings(rows, "id", {"title": "A", "body": "D"}), sources)


def test_search(spark):
    a = archive(spark)
    ids = lambda **c: [r["id"] for r in a.page(Criteria(**c)).rows.collect()]
    assert ids() == [1, 2, 3, 4] and ids(order="oldest") == [3, 2, 1, 4]
    assert sorted(ids(q="canal OR harbour")) == [1, 3] and ids(q='"joint forest survey"') == [2] and ids(q='"survey forest joint"') == []
    assert ids(q="forest -hills") == [] and sorted(ids(q="-canal")) == [2, 3, 4] and ids(q="the of") == []
    assert ids(sources=("andhra",)) == [3, 4] and ids(first=datetime.date(2023, 1, 1)) == [1, 2] and ids(year=2022) == [3]
    facets = [(r["name"], r["total"], r["selected"]) for r in a.source_facets(Criteria(sources=("andhra",), last=datetime.date(2024, 12, 31))).collect()]
    assert facets == [("central", 2, False), ("andhra", 1, True)]
    assert [(r["year"], r["total"]) for r in a.year_facets(Criteria()).collect()] == [(2024, 1), (2023, 1), (2022, 1)]
    page = a.page(Criteria(), number=99, size=3)
    assert (page.number, page.pages, page.total) == (2, 2, 4) and [r["id"] for r in page.rows.collect()] == [4]


def test_pages_from_either_end(spark):
    rows = spark.createDataFrame([(k, datetime.date(2024, 1, 1 + k % 9) if k % 5 else None) for k in range(47)], "id int, date date")
    for order in ("newest", "oldest"):
        keys = ordering.order_keys(order)
        every = [r["id"] for r in ordering.ordered(rows, keys).collect()]
        pages = [ordering.paginate(rows, keys, n, 10) for n in range(1, 6)]
        assert [r["id"] for p in pages for r in p.rows.collect()] == every
    assert [r["id"] for r in ordering.ordered(rows, ordering.source_page_keys()).limit(2).collect()] == [45, 40]
    assert ordering.paginate(rows.limit(0), keys, 3).rows.count() == 0


def test_natural_keys_of_long_numbers(spark):
    names = ["a9", "a10", "a007", "a12345678901234567890", "a12345678901234567891", "b", "a0"]
    got = spark.createDataFrame([(n,) for n in names], "n string").orderBy(ordering.natural_key(F.col("n")), "n").collect()
    assert [r["n"] for r in got] == ["a0", "a007", "a9", "a10", "a12345678901234567890", "a12345678901234567891", "b"]


def test_hierarchies_of_any_depth(spark):
    chain = [(f"n{k}", f"n{k + 1}") for k in range(13)] + [("x", "n11"), ("x", "leaf"), ("y", "n11")]
    edges = spark.createDataFrame(chain, "parent string, child string")
    assert sorted(r["name"] for r in sets.expand(edges, ["n0", "x", "y", "alone"]).collect()) == ["alone", "leaf", "n13", "n13", "n13"]
    with pytest.raises(ValueError):
        sets.expand(edges.unionByName(spark.createDataFrame([("n13", "n2")], "parent string, child string")), ["n0"])


def test_stored_postings(spark, tmp_path):
    a = archive(spark)
    search.store(a.postings, str(tmp_path / "index"), buckets=8)
    for q in ("canal OR harbour", '"joint forest survey"', "forest -hills", "the"):
        posted = search.stored(spark, str(tmp_path / "index"), q, buckets=8)
        want = {r["doc"] for r in search.match(a.postings, a.gazettes, "id", q).collect()}
        assert {r["doc"] for r in search.match(posted, a.gazettes, "id", q).collect()} == want
        scanned = search.scanned(a.gazettes, "id", {"title": "A", "body": "D"}, q)
        assert {r["doc"] for r in search.match(scanned, a.gazettes, "id", q).collect()} == want


def cover_density(entries, wanted):
    """The rank of (lexeme, place, weight), place by place."""
    last, total, start = {}, 0.0, -1
    for lexeme, at, weight in sorted(entries, key=lambda e: e[1]):
        last[lexeme] = (at, weight)
        if wanted <= last.keys() and (first := min(last[w][0] for w in wanted)) > start:
            total += len(wanted) / sum(1 / last[w][1] for w in wanted) / (1 + at - first + 1 - len(wanted))
            start = first
    return total


def test_rank_matches_brute_force(spark):
    rnd = random.Random(4)
    texts = [(k, " ".join(rnd.choice("alpha beta gamma delta epsilon".split()) for _ in range(rnd.randrange(40))), " ".join(rnd.choice("alpha beta zeta".split()) for _ in range(3))) for k in range(60)]
    rows = spark.createDataFrame(texts, "id long, body string, title string")
    posted = search.postings(rows, "id", {"title": "A", "body": "D"}, "words")
    got = {r["doc"]: r["rank"] for r in search.ranked(posted, rows.select(F.col("id").alias("doc")), 'alpha beta OR "gamma delta" -zeta', "words").collect()}
    for k, body, title in texts:
        entries = [(w, i, 1.0) for i, w in enumerate(title.split())] + [(w, 1000 + i, 0.1) for i, w in enumerate(body.split())]
        far = [(w, i if weight == 1.0 else i + 10**9, weight) for w, i, weight in entries]
        want = max(cover_density([e for e in far if e[0] in c], c) for c in ({"alpha", "beta"}, {"gamma", "delta"}))
        assert got[k] == pytest.approx(want, abs=1e-6)


#: Words and their published Porter2 stems.
STEMS = """consign consign|consigned consign|consigning consign|consignment consign|consist consist|consisted consist|consistency consist|consistent consist
consistently consist|consisting consist|consists consist|consolation consol|consolations consol|consolatory consolatori|console consol|consoled consol
consoles consol|consolidate consolid|consolidated consolid|consolidating consolid|consoling consol|consolingly consol|consols consol|consonant conson
consort consort|consorted consort|consorting consort|conspicuous conspicu|conspicuously conspicu|conspiracy conspiraci|conspirator conspir|conspirators conspir
conspire conspir|conspired conspir|conspiring conspir|constable constabl|constables constabl|constance constanc|constancy constanc|constant constant
knack knack|knackeries knackeri|knacks knack|knag knag|knave knave|knaves knave|knavish knavish|kneaded knead|kneading knead|knee knee|kneel kneel
kneeled kneel|kneeling kneel|kneels kneel|knees knee|knell knell|knelt knelt|knew knew|knick knick|knif knif|knife knife|knight knight|knightly knight
knights knight|knit knit|knits knit|knitted knit|knitting knit|knives knive|knob knob|knobs knob|knock knock|knocked knock|knocker knocker|knockers knocker
knocking knock|knopp knopp|knot knot|knots knot|skies sky|dying die|news news|innings inning|generously generous|generate generat|communism communism
relational relat|notifications notif|acquisitions acquisit|hopping hop|hoping hope|happy happi|by by|say say|enjoy enjoy|agreed agre|feed feed|luxuriating luxuri
ties tie|cries cri|gas gas|gaps gap|kiwis kiwi|this this|national nation|rationally ration|adjustment adjust|replacement replac|adoption adopt|rolls roll|controlling control
hopefulness hope|callousness callous|decisiveness decis|sensibility sensibl|analogies analog|formative format|electrical electr|goodness good|youth youth|boyish boyish
proceeding proceed|bed bed|shed shed|bored bore|cease ceas|rate rate|fluently fluentli|ভূমি ভূমি|भूमि भूमि|2024 2024"""


def test_published_stems(spark):
    pairs = [p.split(" ") for line in STEMS.split("\n") for p in line.split("|")]
    rows = analysis.with_stems(spark.createDataFrame(pairs, "word string, want string"), "word", "got").collect()
    assert len(rows) > 130 and [tuple(r) for r in rows if r["want"] != r["got"]] == []
    names = spark.createDataFrame([("the",), ("",), ("gazettes",), (None,)], "w string")
    shown = lambda config: [r["x"] for r in analysis.with_lexemes(names, "w", "x", config).collect()]
    assert shown("simple") == ["the", None, "gazettes", None] and shown("words") == [None, None, "gazettes", None] and shown("english") == [None, None, "gazett", None]
    with pytest.raises(ValueError):
        analysis.with_lexemes(names, "w", "x", "latin")


def test_word_forms_places_and_ids(spark, monkeypatch):
    rows = spark.createDataFrame([(1, "Notifications of the Land"), (2, "He notified the lands"), (3, "notification land"), (4, "")], "id long, body string")
    for bound in (search.BROADCAST_WORDS, 0):
        monkeypatch.setattr(search, "BROADCAST_WORDS", bound)
        posted = search.postings(rows, "id", {"body": "D"})
        found = lambda q, config="english": sorted(r["doc"] for r in search.match(posted, rows, "id", q, config).collect())
        assert found("notification land") == [1, 3] and found("notifying") == [2] and found("lands -notify") == [1, 3]
        assert found('"notification of the lands"') == [1] and found('"notifications land"') == [3] and found('"the land"') == [1, 2, 3]
        ids = posted.select("lexeme", "word_id").distinct().collect()
        assert len({r["word_id"] for r in ids}) == len({r["lexeme"] for r in ids}) == len(ids) == 3
        assert sorted(map(tuple, posted.where("lexeme = 'land'").select("doc", "positions").collect())) == [(1, [4]), (2, [4]), (3, [2])]
    plain = search.postings(rows, "id", {"body": "D"}, "simple")
    assert sorted(r["doc"] for r in search.match(plain, rows, "id", '"the land"', "simple").collect()) == [1]


def test_rank_and_snippets(spark):
    rows = spark.createDataFrame([(1, "alpha beta"), (2, "alpha x y z beta"), (3, "alpha only")], "id long, body string")
    posted = search.postings(rows, "id", {"body": "D"})
    rank = {r["doc"]: r["rank"] for r in search.ranked(posted, search.match(posted, rows, "id", "alpha beta"), "alpha beta").collect()}
    assert rank.keys() == {1, 2} and rank[1] > rank[2] > 0
    assert cover_density([("a", 1, 1.0), ("b", 2, 1.0), ("a", 9, 1.0)], {"a", "b"}) == 1.0 + 1 / 7
    shown = search.snippets(rows, "id", "body", "beta").collect()
    assert {r["id"]: r["snippet"] for r in shown}[2] == "alpha x y z \x02beta\x03"
    text = " ".join(["start", *["w"] * 60, "Canals,", *["v"] * 60, "canal", "canalside", "end"])
    found = search.snippets(spark.createDataFrame([(1, text), (2, None)], "id long, body string"), "id", "body", "canal").collect()
    shown = {r["id"]: r["snippet"] for r in found}
    assert shown[1].count("\x02") == 2 and "\x02Canals,\x03" in shown[1] and "\x02canal\x03 canalside" in shown[1] and " … " in shown[1] and shown[2] == ""
    assert [r["id"] for r in search.unindexed(rows, posted.where("doc <> 3"), "id").collect()] == [3]


def test_ingest_statuses(spark):
    schema = "seq long, relurl string, identifier string, metadata string, malformed boolean, text string, html_sha256 string, metadata_sha256 string"
    rows = [
        (1, "a/../b", "i1", "{}", False, "t", "h", "m"), (2, "zz/1", "i2", "{}", False, "t", "h", "m"), (3, "a/3", "i3", None, False, "t", "h", "m"),
        (4, "a/4", "i4", "{}", True, "t", "h", "m"), (5, "a/5", "i5", "{}", False, " ", "h", "m"), (6, "a/6", None, "{}", False, "t", "h", "m"),
        (7, "a/7", "i7", "{}", False, "t", "h", "m"), (8, "a/8", "i8", "{}", False, "t", "h2", "m"), (9, "a/9", "i7", "{}", False, "t", "h", "m"),
        (10, "a/10", "i10", "{}", False, "t", "h", "m"), (11, "a/11", "i10", "{}", False, "t", "h", "m"),
    ]
    stored = spark.createDataFrame([("a/7", "i7", "h", "m"), ("a/8", "i8", "h", "m")], "relurl string, identifier string, html_sha256 string, metadata_sha256 string")
    batch, catalog = spark.createDataFrame(rows, schema), spark.createDataFrame([("a",)], "name string")
    got = {r["seq"]: r["status"] for r in ingest.classify(batch, stored, catalog).collect()}
    assert got == {1: "error", 2: "skipped", 3: "skipped", 4: "error", 5: "skipped", 6: "skipped", 7: "unchanged", 8: "updated", 9: "error", 10: "created", 11: "error"}
    forced = {r["seq"]: r["status"] for r in ingest.classify(batch, stored, catalog, force=True).collect()}
    assert forced[7] == "updated"
    after = ingest.merged(stored, ingest.classify(batch, stored, catalog)).collect()
    assert {(r["relurl"], r["html_sha256"]) for r in after} == {("a/7", "h"), ("a/8", "h2"), ("a/10", "h")}


def words(spark):
    rows = []
    for k, (t, box) in enumerate([("Hello", (0, 0, 50, 10)), ("world", (60, 1, 110, 11)), ("next", (0, 30, 40, 40)), ("a<b", (80, 31, 110, 41))]):
        rows.append(("d", 1, 0, 0, k, t, box, 0.9, ["en"] if k else ["en", "fr"]))
    return spark.createDataFrame(rows, OCR_WORD)


def test_layout(spark):
    lines = layout.stitched(words(spark))
    assert [r["line"] for r in lines.orderBy("word").collect()] == [0, 0, 1, 1]
    assert [r["line"] for r in layout.overlapping_lines(words(spark)).orderBy("word").collect()] == [0, 0, 1, 1]
    assert layout.page_text(lines).first()["text"].split("\n")[0] == "Hello world"
    assert "next   a<b" in layout.page_text(lines).first()["text"]
    assert [tuple(r["box"]) for r in layout.line_boxes(lines).orderBy("line").collect()] == [(0, 0, 110, 11), (0, 30, 110, 41)]
    fit = layout.baselines(lines).orderBy("line").first()
    assert abs(fit["slope"] - 1 / 60) < 1e-9 and fit["offset"] == 9
    assert "bbox 0 0 50 10; x_wconf 90' lang='en'>Hello" in layout.hocr(lines).first()["hocr"] and "a&lt;b" in layout.hocr(lines).first()["hocr"]
    assert '<HIDDENTEXT><PAGECOLUMN><REGION><PARAGRAPH><LINE><WORD coords="0,10,50,0,10">Hello' in layout.djvu(lines).first()["xml"]
    assert '<line baseline="10" l="0"' in layout.abbyy(lines).first()["xml"]
    assert '<charParams l="51" t="0" r="59" b="11"> </charParams>' in layout.abbyy(lines).first()["xml"]
    assert {r["lang"]: r["weight"] for r in layout.language_weights(words(spark)).collect()} == {"en": 4, "fr": 1}
    assert layout.sparse_pages(words(spark)).first()["pre"]
    blocks = spark.createDataFrame(
        [("d", 1, 0, (300, 10, 600, 100), 600, 1000), ("d", 1, 1, (0, 10, 280, 100), 600, 1000), ("d", 1, 2, (0, 900, 600, 950), 600, 1000)],
        "doc string, page int, block int, box struct<l:int,t:int,r:int,b:int>, width int, height int",
    )
    assert {r["block"]: r["place"] for r in layout.ordered_blocks(blocks).collect()} == {1: 1, 0: 2, 2: 3}
    assert {r["block"]: r["footnote"] for r in layout.footnotes(blocks).collect()} == {0: False, 1: False, 2: True}
    flat = words(spark).where("word < 1")
    assert layout.baselines(layout.stitched(flat)).first()["offset"] == 10


def test_phrases(spark):
    said = [(0, k, w, k * 0.4, k * 0.4 + 0.3) for k, w in enumerate("one two three four five six seven eight nine ten".split())]
    said += [(0, 10, "late", 60.0, 60.5), (1, 0, " ", 61.0, 61.1), (1, 1, "new", 61.2, 61.4)]
    got = windows.phrases(spark.createDataFrame(said, "result int, idx int, word string, start_s double, end_s double")).orderBy("number").collect()
    assert [(r["number"], r["text"]) for r in got] == [(0, "one two three four five six seven eight"), (1, "nine ten"), (2, "late"), (3, "new")]
    assert spark.range(1).select(windows.srt_time(F.lit(3725.5)).alias("t")).first()["t"] == "01:02:05,500"


def test_regulations(spark):
    nodes = [
        ("r", 1, None, "division", "Chapter", "1", "One", None, None), ("r", 2, 1, "division", "Rule", "1.1", "First", None, None),
        ("r", 3, 1, "division", "Rule", "1.2", "Second", None, None), ("r", 4, 3, "division", "Section", "1.2.1", "Rescinded", None, None),
        ("r", 5, 2, "para", None, None, None, None, "text"), ("r", 6, 1, "currency", None, None, None, None, "Current as of October 3, 2014"),
        ("r", 7, 2, "filelink", None, None, None, None, "fig.JPG"), ("r", 8, 2, "pre", None, None, None, None, "a\nb"),
    ]
    rows = spark.createDataFrame(nodes, "reg string, node int, parent int, tag string, kind string, num string, title string, version int, text string")
    out = regulation.rules_as_groups(regulation.dispatched(rows, regulation.rule_table(spark)))
    assert {r["node"]: r["becomes"] for r in out.collect()} == {1: "chap", 2: "sec", 3: "group", 4: "sec", 5: "p", 6: None, 7: None, 8: None}
    assert 4 not in {r["node"] for r in regulation.live_sections(out).collect()}
    eid = {r["node"]: r["eid"] for r in regulation.identified(out.where("becomes IS NOT NULL")).collect()}
    assert eid[1] == "chap_1" and eid[2] == "chap_1__sec_1" and eid[5] == "sec_1__p_1"
    assert regulation.publish_date(rows).first()["date"] == datetime.date(2014, 10, 3)
    assert regulation.file_links(rows).first()["element"] == "img" and regulation.lines_of_pre(rows).count() == 2
    refs = spark.createDataFrame(
        [("T", "1  2", "u1", "e1", 1, 0), ("t", "1 2", "u2", "e2", 3, 1), ("t", "9", "u3", None, None, 2)], "title string, num string, uri string, eid string, version int, seq int"
    )
    cited = spark.createDataFrame([("u2", "T", "1 2"), ("x", "t", "1 2"), ("x", "t", "9"), ("x", "t", "7")], "own_uri string, title string, num string")
    found = regulation.resolved(cited, regulation.reference_index(refs))
    assert sorted((r["own_uri"], r["num"], r["href"]) for r in found.collect() if r["href"]) == [("u2", "1 2", "#e2"), ("x", "1 2", "u2#e2"), ("x", "9", "u3")]
    assert tuple(regulation.resolution_counts(found).first()) == (3, 1)
    parts = spark.createDataFrame([("k", 2, 0, "1", "b"), ("k", 1, 1, "1", "a"), ("k", 1, 2, None, "n")], "key string, subnum int, seq int, num string, v string")
    assert sorted(r["v"] for r in regulation.merged_regulations(parts).collect()) == ["a", "n"]


META = "<document><date><day>18</day><month>4</month><year>2024</year></date><gazetteid>CG-1</gazetteid><ministry>Ministry of Canals</ministry><subject>A &amp; b</subject></document>"


def test_metadata_xml(spark):
    rows = spark.createDataFrame([(1, META), (2, "<document><date>"), (3, "just text"), (4, None), (5, "<document>text</document>")], "id int, xml string")
    got = {r["id"]: r for r in assets.parsed_metadata(rows, "xml").collect()}
    assert got[1]["date"] == datetime.date(2024, 4, 18) and got[1]["meta"]["subject"] == "A & b" and not got[1]["malformed"]
    assert [got[k]["malformed"] for k in (2, 3, 4, 5)] == [True, True, False, True]
    single = F.create_map(F.lit("subject"), F.lit("A & b"), F.lit("bad"), F.lit(None).cast("string"))
    lists = F.create_map(F.lit("links"), F.array(F.lit("x"), F.lit("y")))
    xml = spark.range(1).select(sinks.metadata_xml(single, lists, F.lit(datetime.date(2024, 4, 18))).alias("x")).first()["x"]
    assert xml == "<document><date><day>18</day><month>4</month><year>2024</year></date><links>x</links><links>y</links><subject>A &amp; b</subject></document>"


def test_assets_and_sinks(spark, tmp_path):
    for name, data in (("central/2024-04-18/1.pdf", "x" * 9), ("andhra/2023-01-01/2.pdf", "y"), ("andhra/none/3.html", "z")):
        path = tmp_path / "raw" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(data)
    files = assets.listing(spark, str(tmp_path / "raw"))
    assert sorted((r["relurl"], r["ext"], r["size"]) for r in files.collect()) == [("andhra/2023-01-01/2", "pdf", 1), ("andhra/none/3", "html", 1), ("central/2024-04-18/1", "pdf", 9)]
    assert assets.sources_of(files, ["andhra"]).count() == 2 and assets.dated_assets(files, "2024-01-01").count() == 1 and assets.dated_assets(files).count() == 3
    assert assets.changed_between(files, files.where("ext = 'pdf'")).count() == 2
    stored = spark.createDataFrame([("central/2024-04-18/1",)], "relurl string")
    raw, meta = sinks.document_saves(files.select("relurl"), files.select("relurl"), stored)
    assert raw.count() == 2 and meta.count() == 2
    path = sinks.snapshot(files.select("relurl", "size"), str(tmp_path / "table"), 3)
    assert spark.read.parquet(path).count() == 3
    items = spark.createDataFrame([("a",), ("b",)], "item string")
    assert {r["item"]: r["action"] for r in sinks.remote_action(items, items.where("item = 'a'")).collect()} == {"a": "modify", "b": "upload"}
    (tmp_path / "s.srt").write_text("1\n00:00:01,000 --> 00:00:02,500\nHello\nyou\n\n2\n00:00:03,000 --> 00:00:04,000\nBye\n")
    cues = assets.subtitles(spark, str(tmp_path / "s.srt")).orderBy("number").collect()
    assert [(r["number"], r["start_s"], r["end_s"], r["text"]) for r in cues] == [(1, 1.0, 2.5, "Hello\nyou"), (2, 3.0, 4.0, "Bye")]
    sbv = spark.createDataFrame([("d", k, x) for k, x in enumerate(["0:00:01.000,0:00:02.000", "Hi", "there", "", "0:00:03.000,0:00:04.000", "Bye", ""])], "doc string, idx int, line string")
    assert [r["text"] for r in assets.sbv_cues(sbv).orderBy("cue").collect()] == ["Hi\nthere", "Bye"]
    reply = spark.range(1).select(scripts.script_reply(F.lit("cb([{num:'1', at:new Date(5)}])".replace("'", '"')), "array<struct<num:string,at:long>>").alias("x")).first()["x"]
    assert [tuple(r) for r in reply] == [("1", 5)]


def test_streams(spark, tmp_path):
    source, target = tmp_path / "in", tmp_path / "out"
    schema = "relurl string, v int, ts timestamp"
    for k, rows in enumerate([[("a/1", 1), ("a/2", 1)], [("a/1", 2), ("a/3", 1)], [("a/1", 2)]]):
        data = [(r, v, datetime.datetime(2024, 1, 1, 4 + k)) for r, v in rows]
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(str(source))
    stream = feeds.parquet_feed(spark, str(source), schema)
    query = stream.writeStream.foreachBatch(feeds.upsert_batches(str(target), "relurl", "v")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted((r["relurl"], r["v"]) for r in feeds.current(spark, str(target)).collect()) == [("a/1", 2), ("a/2", 1), ("a/3", 1)]
    # a batch without a key of a bucket leaves its folder alone, and old versions of a bucket go
    merge = feeds.upsert_batches(str(target), "relurl", "v", keep=1)
    merge(spark.createDataFrame([("a/1", 9, None)], schema), 50)
    assert sorted((r["relurl"], r["v"]) for r in feeds.current(spark, str(target)).collect()) == [("a/1", 9), ("a/2", 1), ("a/3", 1)]
    assert all(len(f) == 1 for f in feeds._folders(spark, str(target)).values())
    merge(spark.createDataFrame([("a/1", 9, None)], schema), 50)
    assert feeds.current(spark, str(target)).count() == 3
    assert sorted(r["relurl"] for r in feeds.current(spark, str(target), before=50).collect()) == ["a/2", "a/3"]
    days = feeds.by_upload_day(feeds.parquet_feed(spark, str(source), schema), "ts")
    query = days.writeStream.outputMode("complete").format("memory").queryName("days").trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted((r["start"].day, r["start"].hour, r["n"]) for r in spark.table("days").collect()) == [(1, 5, 3), (31, 5, 2)]
    stored = spark.createDataFrame([("a/1", False, False)], "relurl string, has_pdf boolean, has_alternate boolean")
    late = spark.createDataFrame([("a/1", "raw")], "relurl string, kind string")
    assert tuple(feeds.with_flags(stored, late).first()) == ("a/1", True, False)


def test_plain_postings_without_vocabulary(spark, monkeypatch):
    rows = spark.createDataFrame([(1, "b a b the", "A"), (2, None, ""), (3, "é b", "a x a")], "id long, title string, body string")
    monkeypatch.setattr(search, "vocabulary", lambda *a: pytest.fail("plain words need no vocabulary"))
    for config, the in (("simple", [("the", 1, "A", [4])]), ("words", [])):
        got = sorted((r["lexeme"], r["doc"], r["weight"], r["positions"]) for r in search.postings(rows, "id", {"title": "A", "body": "D"}, config).collect())
        n = 1_000_000_000
        # a is a stop word
        a = [("a", 1, "A", [2]), ("a", 1, "D", [n + 1]), ("a", 3, "D", [n + 1, n + 3])] if the else []
        assert got == sorted([*a, ("b", 1, "A", [1, 3]), ("b", 3, "A", [2]), ("x", 3, "D", [n + 2]), ("é", 3, "A", [1]), *the])
    assert [r["id"] for r in search.unindexed(rows, search.occurrences(rows, "id", {"body": "D"}), "id").select("id").orderBy("id").collect()] == [1, 2]


def test_stems_only_of_words_that_may_have_them(spark):
    words_ = [*analysis.EXCEPTIONS, "rationalization", "possibilities", "relational", "ties", "flies", "hoping", "hopped", "agreed", "analogies", "'tis", "yes", "sensibly", "activities", "gently"]
    table = search._lexemes_of(spark, words_, "english")
    assert [(w, x) for w, x in table.items() if x and not w.lstrip("'").startswith(search._stretch(x))] == []
