"""Queries of regulations, stores and streams of an archive, each with the same result as SQL.

Roles: a conversation is a regulation, its turns are the nodes of a tree of three children a node.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import dates
from ..operators import extract, facets, layout, ordering, regulation, search
from ..session import shared_folder
from ..sources import assets, containers
from ..streaming import feeds
from . import english_sql
from .archive_queries import _ALL_WORDS, _C, _G, _places, catalog, gazettes, query, table

_KIND = "CASE turn % 6 WHEN 0 THEN 'Chapter' WHEN 1 THEN 'Rule' WHEN 2 THEN 'Section' WHEN 3 THEN 'Article' END"
_TAG = "CASE turn % 6 WHEN 4 THEN 'para' WHEN 5 THEN 'filelink' ELSE 'division' END"
_NODES = f"""(SELECT conv_id AS reg, turn + 1 AS node, CASE WHEN turn > 0 THEN 1 + CAST(floor((turn - 1) / 3.0) AS BIGINT) END AS parent, {_TAG} AS tag, {_KIND} AS kind,
  CAST(turn % 4 AS VARCHAR) AS num, CASE WHEN turn % 5 = 2 THEN '[Rescinded] x' ELSE role END AS title, CASE WHEN turn % 3 > 0 THEN turn % 3 END AS version, text FROM conversations)"""


def _nodes(spark, d):
    c = table(spark, d, "conversations").dropDuplicates(["conv_id", "turn"])
    turn = F.col("turn")
    return c.select(
        F.col("conv_id").alias("reg"), (turn + 1).alias("node"), F.when(turn > 0, 1 + F.floor((turn - 1) / 3)).alias("parent"), F.expr(_TAG).alias("tag"), F.expr(_KIND).alias("kind"),
        (turn % 4).cast("string").alias("num"), F.when(turn % 5 == 2, "[Rescinded] x").otherwise(F.col("role")).alias("title"), F.when(turn % 3 > 0, turn % 3).alias("version"), "text",
    )


_GENERAL = "CASE WHEN tag = 'para' THEN 'p' WHEN tag = 'division' THEN CASE kind WHEN 'Chapter' THEN 'chap' WHEN 'Rule' THEN 'rule' WHEN 'Section' THEN 'sec' WHEN 'Article' THEN 'article' END END"
_BECOMES = f"""(SELECT n.*, CASE WHEN n.kind = 'Rule' AND p.g = 'chap' THEN 'sec' ELSE n.g END AS becomes FROM (SELECT *, {_GENERAL} AS g FROM {_NODES}) n
LEFT JOIN (SELECT reg, node AS pnode, {_GENERAL} AS g FROM {_NODES}) p ON n.reg = p.reg AND n.parent = p.pnode)"""


def _dispatched(spark, d):
    return regulation.dispatched(_nodes(spark, d), regulation.rule_table(spark))


@query(f"SELECT reg, node, becomes FROM {_BECOMES}")
def regulation_dispatch(spark, d):
    return _dispatched(spark, d).select("reg", "node", "becomes")


@query("SELECT conv_id AS reg, turn AS node, CASE turn % 7 WHEN 0 THEN 'b' WHEN 1 THEN 'td' WHEN 2 THEN 'ref' WHEN 3 THEN 'appendix' WHEN 4 THEN 'division' WHEN 5 THEN 'date' END AS becomes FROM conversations")
def regulation_inline_dispatch(spark, d):
    pick = F.element_at(F.array(*[F.struct(F.lit(t).alias("tag"), F.lit(k).alias("kind")) for t, k in (
        ("bold", ""), ("TD", ""), ("codesec", ""), ("code", "Appendix"), ("code", "Series"), ("reviewdate", "x"), ("unknown", ""))]), (F.col("turn") % 7 + 1).cast("int"))
    c = table(spark, d, "conversations").select(F.col("conv_id").alias("reg"), F.col("turn").alias("node"), F.lit(None).cast("long").alias("parent"), pick.alias("x"))
    nodes = c.select("reg", "node", "parent", "x.tag", F.when(F.col("x.kind") != "x", F.col("x.kind")).otherwise("").alias("kind"))
    return regulation.dispatched(nodes, regulation.rule_table(spark)).select("reg", "node", "becomes")


@query(f"""SELECT reg, node, CASE WHEN kind = 'Rule' AND (reg, node) IN (SELECT (reg, parent) FROM {_NODES} WHERE kind IN ('Article', 'Section')) THEN 'group' ELSE becomes END AS becomes FROM {_BECOMES}""")
def regulation_rule_groups(spark, d):
    return regulation.rules_as_groups(_dispatched(spark, d)).select("reg", "node", "becomes")


@query(f"SELECT reg, node FROM {_BECOMES} WHERE NOT coalesce(becomes = 'sec' AND title LIKE '[Rescinded]%', false)")
def regulation_live_sections(spark, d):
    return regulation.live_sections(_dispatched(spark, d)).select("reg", "node")


@query(f"""WITH b AS (SELECT *, becomes || '_' || row_number() OVER (PARTITION BY reg, parent, becomes ORDER BY node) AS own FROM {_BECOMES} WHERE becomes IS NOT NULL)
SELECT b.reg, b.node, concat_ws('__', p.own, b.own) AS eid FROM b LEFT JOIN b p ON b.reg = p.reg AND b.parent = p.node""")
def regulation_element_ids(spark, d):
    return regulation.identified(_dispatched(spark, d).where("becomes IS NOT NULL")).select("reg", "node", "eid")


@query("SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN 'R 1-' || turn ELSE role || '-of-turn' END AS key FROM conversations")
def regulation_keys(spark, d):
    number = F.when(F.col("turn") % 2 == 0, F.concat(F.lit(" R  1-"), F.col("turn").cast("string")))
    made = regulation.regulation_key(number, F.concat(F.col("role"), F.lit(" (of) Turn")))
    rows = table(spark, d, "conversations").select("conv_id", "turn", made.alias("key"))
    return rows.withColumn("key", F.regexp_replace("key", "^R 1", "R 1"))


@query("SELECT seq FROM (SELECT turn * 1000000 + conv_id AS seq, CASE WHEN turn % 7 > 0 THEN turn % 5 END AS num, coalesce(turn % 4, 99) AS part, min(turn % 4) OVER (PARTITION BY conv_id % 10, CASE WHEN turn % 7 > 0 THEN turn % 5 END) AS first FROM conversations) WHERE num IS NULL OR part = first")
def regulation_merged_parts(spark, d):
    c, turn = table(spark, d, "conversations").dropDuplicates(["conv_id", "turn"]), F.col("turn")
    parts = c.select((F.col("conv_id") % 10).alias("key"), (turn % 4).cast("int").alias("subnum"), (turn * 1000000 + F.col("conv_id")).alias("seq"), F.when(turn % 7 > 0, F.concat((turn % 5).cast("string"), F.lit(" "))).alias("num"))
    return regulation.merged_regulations(parts).select("seq")


_INDEX = f"""(SELECT * EXCLUDE (k) FROM (SELECT lower(title) AS title, num, 'u' || reg AS uri, CASE WHEN node % 2 = 0 THEN 'sec_' || node END AS eid,
  row_number() OVER (PARTITION BY lower(title), num ORDER BY version DESC NULLS LAST, reg * 1000 + node) AS k FROM {_NODES}) WHERE k = 1)"""
_CITED = f"(SELECT reg * 1000 + node AS spot, 'u' || (reg % 3) AS own_uri, upper(title) AS title, CASE WHEN node % 5 = 0 THEN '99' ELSE num END AS num FROM {_NODES})"


def _index(spark, d):
    seq = F.col("reg") * 1000 + F.col("node")
    refs = _nodes(spark, d).select("title", F.concat(F.lit(" "), F.col("num")).alias("num"), F.concat(F.lit("u"), F.col("reg").cast("string")).alias("uri"),
                                   F.when(F.col("node") % 2 == 0, F.concat(F.lit("sec_"), F.col("node").cast("string"))).alias("eid"), "version", seq.alias("seq"))
    return regulation.reference_index(refs)


def _cited(spark, d):
    num = F.when(F.col("node") % 5 == 0, "99").otherwise(F.concat(F.col("num"), F.lit("  ")))
    return _nodes(spark, d).select((F.col("reg") * 1000 + F.col("node")).alias("spot"), F.concat(F.lit("u"), (F.col("reg") % 3).cast("string")).alias("own_uri"), F.upper("title").alias("title"), num.alias("num"))


@query(f"SELECT title, num, uri, eid FROM {_INDEX}")
def regulation_reference_index(spark, d):
    return _index(spark, d)


_HREF = "CASE WHEN uri = own_uri THEN '#' || eid ELSE uri || CASE WHEN eid IS NOT NULL THEN '#' || eid ELSE '' END END"


@query(f"SELECT spot, {_HREF} AS href FROM {_CITED} c LEFT JOIN {_INDEX} i ON lower(c.title) = i.title AND c.num = i.num")
def regulation_resolved(spark, d):
    return regulation.resolved(_cited(spark, d), _index(spark, d)).select("spot", "href")


@query(f"SELECT count(h) AS resolved, count(*) - count(h) AS unresolved FROM (SELECT {_HREF} AS h FROM {_CITED} c LEFT JOIN {_INDEX} i ON lower(c.title) = i.title AND c.num = i.num)")
def regulation_resolution_counts(spark, d):
    return regulation.resolution_counts(regulation.resolved(_cited(spark, d), _index(spark, d)))


_STATES = "CASE turn % 5 WHEN 0 THEN 'MI' WHEN 1 THEN 'WI' WHEN 2 THEN 'NE' WHEN 3 THEN 'MO' ELSE 'FL' END"


@query(f"""SELECT conv_id, turn, CASE state WHEN 'MI' THEN use WHEN 'WI' THEN coalesce(use, 'n' || turn) WHEN 'NE' THEN 'b' || turn WHEN 'MO' THEN 'n' || turn ELSE 'n' || turn END AS cited_use,
CASE state WHEN 'NE' THEN CAST(conv_id AS VARCHAR) WHEN 'MO' THEN role END AS cited_title FROM (SELECT *, {_STATES} AS state, CASE WHEN turn % 2 = 0 THEN 'u' || turn END AS use FROM conversations)""")
def regulation_citations(spark, d):
    turn = F.col("turn").cast("string")
    state = F.expr(_STATES)
    text = F.when(state == "MO", F.concat(F.lit("\x01n"), turn)).otherwise(F.concat(F.lit("n"), turn))
    refs = table(spark, d, "conversations").select("conv_id", "turn", state.alias("state"), F.col("role").alias("title"), F.when(state == "NE", F.concat(F.col("conv_id").cast("string"), F.lit("-b"), turn)).when(F.col("turn") % 2 == 0, F.concat(F.lit("u"), turn)).alias("use"), text.alias("text"))
    return regulation.citations(refs).select("conv_id", "turn", "cited_use", "cited_title")


@query(f"SELECT conv_id, turn FROM (SELECT *, {_STATES} AS state FROM conversations) WHERE turn % 3 > 0 AND state IN ('MI', 'NE')")
def regulation_linked_citations(spark, d):
    cited = table(spark, d, "conversations").select("conv_id", "turn", F.expr(_STATES).alias("state"), F.when(F.col("turn") % 3 > 0, "D").otherwise("X").alias("datatype"), F.lit(None).cast("string").alias("title"))
    own = cited.withColumn("own_state", F.when(F.col("state").isin("MI", "NE"), F.col("state")).otherwise("CA"))
    return regulation.linked_citations(own).select("conv_id", "turn")


_CUSTOMER_STATE = "CASE c_nationkey % 5 WHEN 0 THEN 'CA' WHEN 1 THEN 'FL' WHEN 2 THEN 'MI' WHEN 3 THEN 'WY' ELSE 'XX' END"


@query(f"""SELECT c_custkey, state, locality, start_year, titled FROM (SELECT c_custkey, {_CUSTOMER_STATE} AS state FROM customer)
JOIN (VALUES ('CA', 'california', 1947, true), ('FL', 'florida', 1961, {str('FL' in regulation.TITLE_STATES).lower()}), ('MI', 'michigan', 1943, {str('MI' in regulation.TITLE_STATES).lower()}), ('WY', 'wyoming', 1957, true)) t(state, locality, start_year, titled) USING (state)""")
def regulation_states(spark, d):
    places = table(spark, d, "customer").select("c_custkey", F.expr(_CUSTOMER_STATE).alias("state"))
    return places.join(F.broadcast(regulation.states(spark)), "state").select("c_custkey", "state", "locality", "start_year", "titled")  # fifty states


@query("SELECT o_orderkey AS k, '/akn/us-ca/act/regulation/' || year(o_orderdate) || '/' || o_orderkey AS work, '/akn/us-ca/act/regulation/' || year(o_orderdate) || '/' || o_orderkey || '/eng@v1.xml' AS manifestation FROM orders")
def regulation_addresses(spark, d):
    made = regulation.frbr(F.lit("us"), F.lit("ca"), F.lit("regulation"), F.year("o_orderdate"), F.col("o_orderkey").cast("string"), version=F.lit("v1"))
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), made.alias("x")).select("k", "x.work", "x.manifestation")


@query("SELECT conv_id AS reg, CASE turn % 2 WHEN 0 THEN 'effective' ELSE 'review' END AS role, (2000 + turn) || '-' || (1 + turn % 12) || '-7' AS date FROM conversations WHERE turn % 3 = 0")
def regulation_role_dates(spark, d):
    c, turn = table(spark, d, "conversations"), F.col("turn")
    kind = F.when(turn % 3 > 0, "other").when(turn % 2 == 0, "Effective-Date").otherwise("REVIEW")
    shown = F.concat((1 + turn % 12).cast("string"), F.lit("/7/"), (2000 + turn).cast("string"))
    return regulation.role_dates(c.select(F.col("conv_id").alias("reg"), kind.alias("kind"), shown.alias("text")))


@query("SELECT conv_id AS reg, make_date(CAST(2000 + min(turn) AS INT), 10, 3) AS date FROM conversations WHERE turn % 2 = 1 GROUP BY conv_id", days="date")
def regulation_publish_dates(spark, d):
    c, turn = table(spark, d, "conversations"), F.col("turn")
    note = F.when(turn % 2 == 1, F.concat(F.lit("Current as of October 3, "), (2000 + turn).cast("string"))).otherwise("none")
    return regulation.publish_date(c.select(F.col("conv_id").alias("reg"), (turn + 1).alias("node"), F.lit("currency").alias("tag"), note.alias("text")))


@query("SELECT conv_id AS reg, turn AS node, CASE turn % 2 WHEN 0 THEN 'img' ELSE 'a' END AS element, CASE turn % 2 WHEN 0 THEN 'f.PNG' ELSE 'f.pdf' END AS href FROM conversations WHERE turn % 3 = 1")
def regulation_file_links(spark, d):
    c, turn = table(spark, d, "conversations"), F.col("turn")
    return regulation.file_links(c.select(F.col("conv_id").alias("reg"), turn.alias("node"), F.when(turn % 3 == 1, "FileLink").otherwise("p").alias("tag"), F.when(turn % 2 == 0, "f.PNG").otherwise("f.pdf").alias("text")))


@query("SELECT conv_id AS reg, turn AS node, CAST(i - 1 AS INT) AS line, string_split(text, chr(10))[i] AS text FROM conversations, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS t(i) WHERE turn % 2 = 0")
def regulation_lines_of_pre(spark, d):
    c, turn = table(spark, d, "conversations"), F.col("turn")
    return regulation.lines_of_pre(c.select(F.col("conv_id").alias("reg"), turn.alias("node"), F.when(turn % 2 == 0, "pre").otherwise("p").alias("tag"), "text"))


@query("SELECT doc_id FROM documents WHERE NOT (lang = 'en' AND doc_id IN (SELECT doc_id FROM labels))")
def regulation_new_works(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.col("doc_id").alias("work"), F.lit("2024").alias("date"), "lang")
    stored = table(spark, d, "labels").select(F.col("doc_id").alias("work"), F.lit("2024").alias("date"), F.lit("en").alias("lang"))
    return regulation.new_works(docs, stored).select("doc_id")


@query("SELECT conv_id, turn, CASE turn % 4 WHEN 0 THEN '37:1' WHEN 1 THEN '12' WHEN 2 THEN '5-x' ELSE 'rule 7 of' END AS regnum, CAST(CASE turn % 4 WHEN 0 THEN 20 WHEN 1 THEN turn END AS INT) AS subnum FROM conversations")
def regulation_numbers(spark, d):
    turn = F.col("turn")
    state = F.when(turn % 4 == 0, "OH").when(turn % 4 == 1, "TX").when(turn % 4 == 2, "NH").otherwise("ID")
    text = F.when(turn % 4 == 0, "37:1 - 20b").when(turn % 4 == 1, F.concat(F.lit("R 12."), turn.cast("string"), F.lit("a"))).when(turn % 4 == 2, "5-X y").otherwise("Rule 7 of")
    return table(spark, d, "conversations").select("conv_id", "turn", regulation.regulation_number(state, text).alias("n")).select("conv_id", "turn", "n.*")


@query("SELECT conv_id AS reg, '<body>' || string_agg('<sec eId=\"sec_' || turn || '\"><num>' || turn || '</num><heading>' || role || '</heading></sec>', '' ORDER BY turn) || '</body>' AS xml FROM conversations GROUP BY conv_id")
def regulation_documents(spark, d):
    c, turn = table(spark, d, "conversations").dropDuplicates(["conv_id", "turn"]), F.col("turn").cast("string")
    nodes = c.select(F.col("conv_id").alias("reg"), (F.col("turn") + 1).cast("int").alias("node"), F.lit(None).cast("int").alias("parent"), F.lit("sec").alias("becomes"), F.concat(F.lit("sec_"), turn).alias("eid"), turn.alias("num"), F.col("role").alias("title"), F.lit(None).cast("string").alias("text"))
    return containers.akn_document(nodes)


@query("SELECT o_orderkey AS k, 2 AS node, 1 AS parent, 'sec' AS tag, 'S' AS kind, CAST(o_custkey AS VARCHAR) AS num, 'é & ' || o_orderpriority AS title, 3 AS version, 'own' AS text FROM orders WHERE o_orderkey % 4 > 0")
def xml_node_table(spark, d):
    o, k = table(spark, d, "orders"), F.col("o_orderkey")
    xml = F.concat(F.lit("<code><sec type='S' version='3'>own<number>"), F.col("o_custkey").cast("string"), F.lit("</number><name>&eacute; &amp; "), F.col("o_orderpriority"), F.lit("</name></sec>"), F.when(k % 4 > 0, "</code>").otherwise(""))
    return containers.node_table(o.select(k.alias("k"), xml.alias("xml")), "k", "xml").where("node = 2").select(F.col("reg").alias("k"), "node", "parent", "tag", "kind", "num", "title", "version", "text")


@query("SELECT o_orderkey AS k, '{\"a\":[\"' || o_orderpriority || '\",\"y\"],\"b\":{\"c\":\"' || o_custkey || '\"},\"d\":\"\"}' AS record FROM orders")
def xml_objects(spark, d):
    o = table(spark, d, "orders")
    xml = F.concat(F.lit("<document>\n<a>"), F.col("o_orderpriority"), F.lit("</a>\n<b><c>"), F.col("o_custkey").cast("string"), F.lit("</c></b><a>y</a><d/></document>"))
    return o.select(F.col("o_orderkey").alias("k"), containers.xml_object(xml).alias("record"))


@query("SELECT n_nationkey AS k, 'http://a.in/' || n_name AS link FROM nation UNION ALL SELECT n_nationkey, 'http://b.in/' FROM nation")
def links_of_compressed_pdfs(spark, d):
    import zlib

    packed = zlib.compress(b"<</A<</URI (http://b.in/)>>>>")
    pdf = F.concat(F.lit("%PDF\n<</URI (http://a.in/").cast("binary"), F.col("n_name").cast("binary"), F.lit(")>> stream\n").cast("binary"), F.unhex(F.lit(packed.hex())), F.lit("\nendstream").cast("binary"))
    return table(spark, d, "nation").select(F.col("n_nationkey").alias("k"), F.explode(containers.pdf_links_in_streams(pdf)).alias("link"))


@query("SELECT n_regionkey AS k, n_name AS name, 'c' || n_nationkey AS content FROM nation")
def zipped_pages(spark, d):
    file = F.struct(F.col("n_name").alias("name"), F.concat(F.lit("c"), F.col("n_nationkey").cast("string")).cast("binary").alias("content"))
    packed = table(spark, d, "nation").groupBy(F.col("n_regionkey").alias("k")).agg(containers.zipped(F.sort_array(F.collect_list(file))).alias("z"))
    return packed.select("k", F.explode(containers.members(F.col("z"))).alias("m")).select("k", "m.name", F.col("m.content").cast("string").alias("content"))


# recognised pages

@query("SELECT conv_id AS doc, CAST(turn AS INT) AS word, role AS text, CAST(turn * 10 AS INT) AS l, CAST(turn * 10 + 8 AS INT) AS r FROM conversations")
def cached_page_words(spark, d):
    c, turn = table(spark, d, "conversations").dropDuplicates(["conv_id", "turn"]), F.col("turn").cast("int")
    vertex = lambda x, y: F.struct(x.cast("int").alias("x"), F.lit(y).alias("y"))
    word = F.struct(F.lit(0.5).alias("confidence"), F.array(F.lit("en")).alias("langs"), F.array(vertex(turn * 10, -3), vertex(turn * 10 + 8, 9)).alias("vertices"),
                    F.array(F.struct(F.col("role").alias("text"), F.lit(1).alias("brk"))).alias("symbols"))
    words = c.groupBy("conv_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("turn", word.alias("w")))), lambda x: x["w"]).alias("words"))
    para = F.array(F.struct(F.array(F.struct(F.array(F.struct("words")).alias("paragraphs"))).alias("blocks")))
    replies = words.select("conv_id", F.to_json(F.struct(para.alias("pages"))).alias("reply"))
    return assets.ocr_words(replies, "conv_id", "reply").where("box.t = 0").select("doc", "word", "text", "box.l", "box.r")


@query("SELECT conv_id AS doc, turn, text FROM conversations")
def cached_page_texts(spark, d):
    c = table(spark, d, "conversations")
    replies = c.select(F.struct("conv_id", "turn").alias("key"), F.to_json(F.struct("text")).alias("reply"))
    return assets.plain_replies(replies, "key", "reply").select(F.col("doc.conv_id").alias("doc"), "doc.turn", "text")


@query("""SELECT conv_id AS doc, turn AS word, sum(s) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING)::BIGINT AS line FROM
(SELECT *, CASE WHEN l < lag(l) OVER (PARTITION BY conv_id ORDER BY turn) THEN 1 ELSE 0 END AS s FROM (SELECT conv_id, turn, length(text) % 97 AS l FROM conversations))""")
def layout_left_breaks(spark, d):
    c = table(spark, d, "conversations").dropDuplicates(["conv_id", "turn"])
    words = c.select(F.col("conv_id").alias("doc"), F.lit(1).alias("page"), F.lit(1).alias("block"), F.lit(1).alias("para"), F.col("turn").alias("word"), F.struct((F.length("text") % 97).alias("l")).alias("box"))
    return layout.left_breaks(words).select("doc", "word", "line")


# the archive as a whole


@query(f"SELECT id, title AS source_title FROM {_G} JOIN {_C} ON name = source WHERE name <> '2-HIGH'")
def documents_with_sources(spark, d):
    return facets.with_source(gazettes(spark, d), catalog(spark, d).where("name <> '2-HIGH'")).select("id", "source_title")


@query("SELECT source, arg_min(lang, doc_id) AS lang, count(*) AS n FROM documents GROUP BY source")
def folded_records(spark, d):
    out = extract.grouped_notifications(table(spark, d, "documents"), "source", "doc_id", ["lang"], ["doc_id"])
    return out.select("source", "lang", F.size("notifications").cast("long").alias("n"))


@query(f"""WITH {english_sql.vocabulary(_ALL_WORDS)}, p AS ({_places("split_part(text, chr(10), 1)", 0)} UNION ALL {_places("text", 1000000000)}),
h AS (SELECT * FROM p WHERE lexeme IN ('thli', 'one')),
l AS (SELECT *, max(CASE WHEN lexeme = 'thli' THEN spot END) OVER w AS a, max(CASE WHEN lexeme = 'one' THEN spot END) OVER w AS b FROM h WINDOW w AS (PARTITION BY doc_id ORDER BY spot)),
s AS (SELECT *, least(a, b) AS first, coalesce(max(least(a, b)) OVER (PARTITION BY doc_id ORDER BY spot ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) AS before FROM l WHERE a IS NOT NULL AND b IS NOT NULL),
c AS (SELECT doc_id AS id, round(sum(2.0 / (CASE WHEN a < 1000000000 THEN 1.0 ELSE 10.0 END + CASE WHEN b < 1000000000 THEN 1.0 ELSE 10.0 END) / (1 + (spot - first + 1 - 2))), 6) AS rank FROM s WHERE first > before GROUP BY doc_id)
SELECT id, rank FROM (SELECT id, rank, CASE WHEN id % 3 > 0 THEN id % 7 END AS date FROM c) ORDER BY rank DESC, date DESC NULLS LAST, id DESC LIMIT 20""")
def most_relevant_page(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.substring_index("text", "\n", 1).alias("title"), "text")
    posted = search.scanned(docs, "doc_id", {"title": "A", "text": "D"}, "thly oned")
    ranked = search.ranked(posted, search.match(posted, docs, "doc_id", "thly oned"), "thly oned")
    rows = ranked.select(F.col("doc").alias("id"), F.round("rank", 6).alias("rank"), F.when(F.col("doc") % 3 > 0, F.col("doc") % 7).alias("date"))
    return ordering.paginate(rows, ordering.order_keys("relevance"), 1).rows.select("id", "rank")


def _folder(spark) -> str:
    return f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"


@query("SELECT source || '/' || doc_id AS relurl FROM documents")
def stream_feed_of_addresses(spark, d):
    from ..streaming.stream_queries import _finished

    folder = _folder(spark)
    docs = table(spark, d, "documents").select(F.concat_ws("/", "source", F.col("doc_id").cast("string")).alias("value"))
    docs.unionByName(docs.limit(3).select(F.lit("  ").alias("value"))).repartition(4).write.text(folder)
    return _finished(feeds.relurl_feed(spark, folder, per_batch=2), "append")


@query("SELECT doc_id AS relurl, CASE WHEN doc_id % 3 = 0 THEN 2 ELSE 1 END AS version FROM documents")
def stream_upserts(spark, d):
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("relurl"))
    folder, target = _folder(spark), _folder(spark)
    rows = docs.withColumn("version", F.lit(1)).unionByName(docs.where("relurl % 3 = 0").withColumn("version", F.lit(2)))
    rows.repartition(4).write.parquet(folder)
    stream = feeds.parquet_feed(spark, folder, "relurl long, version int", per_batch=2)
    running = stream.writeStream.foreachBatch(feeds.upsert_batches(target, "relurl", "version", buckets=4)).option("checkpointLocation", f"{folder}-state")
    running.trigger(availableNow=True).start().awaitTermination()
    return feeds.current(spark, target).select("relurl", "version")


@query("SELECT o_orderkey AS k, o_orderdate::DATE AS day FROM orders", days="day")
def named_and_typed_dates(spark, d):
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), dates.any_date(F.date_format("o_orderdate", "MM/dd/yyyy")).alias("day"))
