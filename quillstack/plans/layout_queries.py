"""Queries of page layout, each with the same result as SQL.

Roles: line items are the words of pages, an order being a document. Their boxes are made from their
numbers, so that lines wrap, overlap and leave gaps; the same expressions make them for both sides.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import text
from ..operators import facets, flow, layout, page_flow, windows
from ..session import dealt
from .archive_queries import query, table

#: Words of pages: two pages a document, blocks by line number. Line numbers repeat, so a word's number holds more of its line.
_NUMBERS = {
    "doc": "l_orderkey", "page": "CAST(1 + l_linenumber % 2 AS INT)", "block": "CAST(1 + floor((l_linenumber - 1) / 4.0) AS INT)", "para": "1",
    "word": "CAST(l_linenumber AS BIGINT) * 1000000000000 + l_partkey * 1000000 + l_suppkey * 100 + CAST(l_quantity AS BIGINT)", "text": "concat(l_returnflag, CAST(l_partkey AS STRING))",
    "l": "CAST((l_partkey * 13) % 500 AS INT)", "r": "CAST((l_partkey * 13) % 500 + 40 + l_suppkey % 30 AS INT)",
    "t": "CAST((l_linenumber - 1) * 12 + l_partkey % 9 AS INT)", "b": "CAST((l_linenumber - 1) * 12 + l_partkey % 9 + 20 AS INT)",
    "conf": "CAST(l_quantity / 64.0 AS DOUBLE)", "lang": "CASE WHEN l_suppkey % 3 = 0 THEN 'en' WHEN l_suppkey % 3 = 1 THEN 'hi' END",
}
_W = "(SELECT " + ", ".join(f"{e.replace(' AS STRING', ' AS VARCHAR')} AS {n}" for n, e in _NUMBERS.items()) + " FROM lineitem)"


def _words(spark, d):
    rows = table(spark, d, "lineitem").select(*[F.expr(e).alias(n) for n, e in _NUMBERS.items()])
    langs = F.when(F.col("lang").isNotNull(), F.array("lang")).otherwise(F.array().cast("array<string>"))
    box = F.struct(*[F.col(c) for c in "ltrb"])
    return rows.select("doc", "page", "block", "para", "word", "text", box.alias("box"), F.col("conf").alias("confidence"), langs.alias("langs"))


_ORDER = "PARTITION BY doc, page ORDER BY block, para, word"
_LINES = f"""(SELECT *, sum(s) OVER ({_ORDER} ROWS UNBOUNDED PRECEDING)::BIGINT - 1 AS line FROM
(SELECT *, CASE WHEN t0 IS NULL OR b > t AND (round((t - t0) / (b - t)) >= 1 OR l - r0 <= -50) THEN 1 ELSE 0 END AS s FROM
(SELECT *, lag(t) OVER ({_ORDER}) AS t0, lag(r) OVER ({_ORDER}) AS r0 FROM {_W})))"""


def _lines(spark, d):
    return layout.stitched(_words(spark, d))


@query(f"SELECT doc, page, word, line FROM {_LINES}")
def layout_stitched_lines(spark, d):
    return _lines(spark, d).select("doc", "page", "word", "line")


@query(f"""WITH x AS (SELECT *, lag(t) OVER w AS t0, lag(b) OVER w AS b0 FROM {_W} WINDOW w AS (PARTITION BY doc, page ORDER BY t, block, para, word)),
s AS (SELECT *, CASE WHEN t0 IS NULL OR 2 * (least(b0, b) - greatest(t0, t)) < least(b0 - t0, b - t) THEN 1 ELSE 0 END AS s FROM x)
SELECT doc, page, word, sum(s) OVER (PARTITION BY doc, page ORDER BY t, block, para, word ROWS UNBOUNDED PRECEDING)::BIGINT - 1 AS line FROM s""")
def layout_overlapping_lines(spark, d):
    return layout.overlapping_lines(_words(spark, d)).select("doc", "page", "word", "line")


@query(f"SELECT doc, page, line, greatest(0, min(l)) AS l, greatest(0, min(t)) AS t, max(r) AS r, max(b) AS b FROM {_LINES} GROUP BY ALL")
def layout_line_boxes(spark, d):
    return layout.line_boxes(_lines(spark, d)).select("doc", "page", "line", "box.*")


_CHARS = f"""(SELECT doc, page, width / nullif(chars + n - 1, 0) AS cw FROM
(SELECT *, row_number() OVER (PARTITION BY doc, page ORDER BY width DESC, line DESC) AS k FROM
(SELECT doc, page, line, max(r) - min(l) AS width, sum(length(text)) AS chars, count(*) AS n FROM {_LINES} GROUP BY doc, page, line)) WHERE k = 1)"""


@query(f"SELECT doc, page, round(cw, 9) AS char_width FROM {_CHARS}")
def layout_char_width(spark, d):
    return layout.char_width(_lines(spark, d)).select("doc", "page", F.round("char_width", 9).alias("char_width"))


_PADDED = f"""(SELECT doc, page, line, string_agg(repeat(' ', pad) || text, '' ORDER BY l, word) AS text, min(t) AS t, max(b) AS b FROM
(SELECT *, CASE WHEN before IS NULL THEN greatest(k, 0) ELSE greatest(k, 1) END AS pad FROM
(SELECT *, coalesce(round((l - coalesce(before, leftmost)) / cw), 0)::INT AS k FROM
(SELECT x.*, cw, lag(r) OVER (PARTITION BY x.doc, x.page, line ORDER BY l, word) AS before, min(l) OVER (PARTITION BY x.doc, x.page) AS leftmost
 FROM {_LINES} x JOIN {_CHARS} USING (doc, page)))) GROUP BY doc, page, line)"""


@query(f"SELECT doc, page, line, text FROM {_PADDED}")
def layout_padded_lines(spark, d):
    return layout.padded_lines(_lines(spark, d)).select("doc", "page", "line", "text")


@query(f"""SELECT doc, page, string_agg(repeat(chr(10), least(greatest(coalesce(gap, 0), 0), 3)) || text, chr(10) ORDER BY line) AS text FROM
(SELECT *, round((t - lag(b) OVER (PARTITION BY doc, page ORDER BY line)) / avg(b - t) OVER (PARTITION BY doc, page))::INT AS gap FROM {_PADDED}) GROUP BY doc, page""")
def layout_page_text(spark, d):
    return layout.page_text(_lines(spark, d))


@query(f"""SELECT doc, page, line, round(CASE WHEN count(*) > 1 AND max(x) > min(x) THEN regr_slope(y, x) ELSE 0 END, 6) AS slope, CAST(trunc(round(CASE WHEN count(*) > 1 AND max(x) > min(x) THEN regr_intercept(y, x) ELSE avg(y) END, 6)) AS INT) AS "offset" FROM
(SELECT doc, page, line, (l + r) / 2 AS x, (b - min(t) OVER (PARTITION BY doc, page, line))::DOUBLE AS y FROM {_LINES}) GROUP BY doc, page, line""")
def layout_baselines(spark, d):
    return layout.baselines(_lines(spark, d)).select("doc", "page", "line", F.round("slope", 6).alias("slope"), "offset")


@query(f"""SELECT doc, page, line, bottom FROM (SELECT *, row_number() OVER (PARTITION BY doc, page, line ORDER BY n DESC, block, para, word) AS k FROM
(SELECT doc, page, line, b AS bottom, count(*) AS n, min(block) AS block, min(para) AS para, min(word) AS word FROM {_LINES} GROUP BY doc, page, line, b)) WHERE k = 1""")
def layout_common_baseline(spark, d):
    return layout.common_baseline(_lines(spark, d))


_BLOCKS = f"(SELECT doc, page, block, min(l) AS l, min(t) AS t, max(r) AS r, max(b) AS b, 540 AS width, 90 AS height FROM {_W} GROUP BY doc, page, block)"


def _blocks(spark, d):
    box = F.struct(F.min("box.l").alias("l"), F.min("box.t").alias("t"), F.max("box.r").alias("r"), F.max("box.b").alias("b"))
    return _words(spark, d).groupBy("doc", "page", "block").agg(box.alias("box")).withColumns({"width": F.lit(540), "height": F.lit(90)})


_SIDED = f"(SELECT *, CASE WHEN 100.0 * l / width < 45 AND 100.0 * r / width > 55 THEN 'center' WHEN 100.0 * r / width <= 55 THEN 'left' ELSE 'right' END AS side FROM {_BLOCKS})"


@query(f"SELECT doc, page, block, side FROM {_SIDED}")
def layout_block_sides(spark, d):
    return _blocks(spark, d).select("doc", "page", "block", layout.block_side(F.col("box"), F.col("width")).alias("side"))


@query(f"""SELECT doc, page, block, row_number() OVER (PARTITION BY doc, page ORDER BY run, CASE side WHEN 'center' THEN 0 WHEN 'left' THEN 1 ELSE 2 END, t, block) AS place
FROM (SELECT *, sum(CASE WHEN side = 'center' THEN 1 ELSE 0 END) OVER (PARTITION BY doc, page ORDER BY t, block ROWS UNBOUNDED PRECEDING) AS run FROM {_SIDED})""")
def layout_block_order(spark, d):
    return layout.ordered_blocks(_blocks(spark, d)).select("doc", "page", "block", F.col("place").cast("long").alias("place"))


_GAPS = f"""(SELECT *, avg(gap) OVER (PARTITION BY doc, page, block, line) AS mean FROM
(SELECT *, lag(r) OVER w AS rl, l - lag(r) OVER w AS gap FROM {_LINES} WINDOW w AS (PARTITION BY doc, page, block, line ORDER BY l, word)) WHERE gap IS NOT NULL)"""
_TWO = f"""(SELECT doc, page, block, bool_and(wide) AS two FROM (SELECT doc, page, block, line, bool_or(gap > 2.5 * mean AND rl <= 270 AND l >= 270) AS wide
FROM {_GAPS} GROUP BY doc, page, block, line) GROUP BY doc, page, block)"""


@query(f"SELECT * FROM {_TWO}")
def layout_two_columns(spark, d):
    return layout.two_columns(_lines(spark, d).withColumn("width", F.lit(540)))


@query(f"SELECT doc, page, word, CASE WHEN n > 1 AND (l + r) / 2 >= 270 THEN 1 ELSE 0 END AS \"column\" FROM (SELECT *, count(*) OVER (PARTITION BY doc, page, block) AS n FROM {_W})")
def layout_split_columns(spark, d):
    words = _words(spark, d)
    wide = words.groupBy("doc", "page", "block").agg((F.count(F.lit(1)) > 1).alias("two"))
    return layout.split_columns(words.withColumn("width", F.lit(540)), wide).select("doc", "page", "word", "column")


@query(f"""SELECT doc, page, block, coalesce(lead(block) OVER w IS NULL AND 40 * t - lag(40 * b) OVER w > 55 AND 40 * t >= 0.85 * 2400, false) AS footnote
FROM {_BLOCKS} WINDOW w AS (PARTITION BY doc, page ORDER BY t, block)""")
def layout_footnotes(spark, d):
    scaled = F.struct(*[(F.col(f"box.{k}") * 40).alias(k) for k in "ltrb"])
    return layout.footnotes(_blocks(spark, d).withColumn("box", scaled).withColumn("height", F.lit(2400))).select("doc", "page", "block", "footnote")


@query("SELECT source AS doc, 1 AS page, count(*) < 600 AND count(*) / greatest(count(DISTINCT (lang, n_chars // 1000)), 1) < 20 AS pre FROM documents GROUP BY source")
def layout_sparse_pages(spark, d):
    words = table(spark, d, "documents").select(F.col("source").alias("doc"), F.lit(1).alias("page"), F.col("lang").alias("block"), F.floor(F.col("n_chars") / 1000).alias("para"))
    return layout.sparse_pages(words)


@query(f"SELECT doc, lang, count(*) AS weight FROM {_W} WHERE lang IS NOT NULL GROUP BY doc, lang")
def layout_language_weights(spark, d):
    return layout.language_weights(_words(spark, d))


@query(f"SELECT s.doc, CASE lang WHEN 'en' THEN 'eng' ELSE 'hin' END AS code, round(share, 9) AS share FROM (SELECT doc, lang, count(*) / sum(count(*)) OVER (PARTITION BY doc) AS share FROM {_W} WHERE lang IS NOT NULL GROUP BY doc, lang) s")
def layout_iso_languages(spark, d):
    codes = spark.range(1).select(F.inline(F.array(*[F.struct(F.lit(a).alias("short"), F.lit(b).alias("code")) for a, b in (("en", "eng"), ("hi", "hin"), ("xx", "xxx"))])))
    shares = facets.language_share(layout.language_weights(_words(spark, d)))
    return flow.iso_languages(shares, codes).select("doc", "code", F.round("share", 9).alias("share"))


_ESC = "replace(replace(replace(replace(replace({0}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#x27;')"
_ID = "'{0}_' || lpad(CAST(page AS VARCHAR), 6, '0') || '_' || lpad(CAST({1} AS VARCHAR), 6, '0')"
_BOX = "'bbox ' || l || ' ' || t || ' ' || r || ' ' || b"


@query(f"""WITH w AS (SELECT *, row_number() OVER (PARTITION BY doc, page ORDER BY block, para, line, l, word) AS n FROM {_LINES}),
x AS (SELECT *, (l + r) / 2 AS mx, (b - min(t) OVER (PARTITION BY doc, page, block, para, line))::DOUBLE AS my FROM w),
ls AS (SELECT doc, page, block, para, line, min(l) AS l, min(t) AS t, max(r) AS r, max(b) AS b,
  CASE WHEN count(*) > 1 AND max(mx) > min(mx) THEN regr_slope(my, mx) ELSE 0 END AS slope, CAST(trunc(round(CASE WHEN count(*) > 1 AND max(mx) > min(mx) THEN regr_intercept(my, mx) ELSE avg(my) END, 6)) AS INT) AS shift,
  string_agg('<span class=''ocrx_word'' id=''' || {_ID.format("word", "n")} || ''' title=''' || {_BOX} || '; x_wconf ' || CAST(floor(round(conf * 100, 6)) AS BIGINT)
    || CASE WHEN lang IS NULL THEN '' ELSE ''' lang=''' || lang END || '''>' || {_ESC.format("text")} || '</span>', ' ' ORDER BY n) AS x FROM x GROUP BY doc, page, block, para, line),
li AS (SELECT *, row_number() OVER (PARTITION BY doc, page ORDER BY block, para, line) AS i FROM ls),
ps AS (SELECT doc, page, block, para, min(l) AS l, min(t) AS t, max(r) AS r, max(b) AS b, string_agg('<span class=''ocr_line'' id=''' || {_ID.format("line", "i")} || ''' title=''' || {_BOX}
  || '; baseline ' || format('{{:.6f}}', slope) || ' ' || shift || '''>' || x || '</span>', chr(10) ORDER BY line) AS x FROM li GROUP BY doc, page, block, para),
pi AS (SELECT *, row_number() OVER (PARTITION BY doc, page ORDER BY block, para) AS i FROM ps),
bs AS (SELECT doc, page, block, min(l) AS l, min(t) AS t, max(r) AS r, max(b) AS b, string_agg('<p class=''ocr_par'' id=''' || {_ID.format("par", "i")} || ''' title=''' || {_BOX} || '''>' || x || '</p>', chr(10) ORDER BY para) AS x
  FROM pi GROUP BY doc, page, block),
bi AS (SELECT *, row_number() OVER (PARTITION BY doc, page ORDER BY block) AS i FROM bs)
SELECT doc, page, regexp_replace('<div class=''ocr_page'' id=''page_' || lpad(CAST(page AS VARCHAR), 6, '0') || ''' title=''bbox 0 0 ' || max(r) || ' ' || max(b) || '; ppageno ' || page || '''>' || chr(10)
  || string_agg('<div class=''ocr_carea'' id=''' || {_ID.format("block", "i")} || ''' title=''' || {_BOX} || '''>' || x || '</div>', chr(10) ORDER BY block) || chr(10) || '</div>', 'baseline [-0-9.]+', 'baseline', 'g') AS hocr
FROM bi GROUP BY doc, page""")
def layout_hocr(spark, d):
    # the last digit of a slope hangs on the order of its sums
    return layout.hocr(_lines(spark, d)).withColumn("hocr", F.regexp_replace("hocr", "baseline [-0-9.]+", "baseline"))


@query(f"""WITH ls AS (SELECT doc, page, block, para, line, max(r) AS r, max(b) AS b, string_agg('<WORD coords="' || l || ',' || b || ',' || r || ',' || t || ',' || b || '">' || {_ESC.format("text")} || '</WORD>', '' ORDER BY l, word) AS x FROM {_LINES} GROUP BY ALL),
ps AS (SELECT doc, page, block, para, max(r) AS r, max(b) AS b, string_agg('<LINE>' || x || '</LINE>', '' ORDER BY line) AS x FROM ls GROUP BY ALL),
bs AS (SELECT doc, page, block, max(r) AS r, max(b) AS b, string_agg('<PARAGRAPH>' || x || '</PARAGRAPH>', '' ORDER BY para) AS x FROM ps GROUP BY ALL)
SELECT doc, page, '<OBJECT type="image/x.djvu" height="' || max(b) || '" width="' || max(r) || '"><PARAM name="DPI" value="300"/><HIDDENTEXT>'
  || string_agg('<PAGECOLUMN><REGION>' || x || '</REGION></PAGECOLUMN>', '' ORDER BY block) || '</HIDDENTEXT></OBJECT>' AS xml FROM bs GROUP BY doc, page""")
def layout_djvu(spark, d):
    return layout.djvu(_lines(spark, d))


_EDGES = "' l=\"' || {0} || '\" t=\"' || {1} || '\" r=\"' || {2} || '\" b=\"' || {3} || '\"'"


@query(f"""WITH w AS (SELECT *, lag(r) OVER g + 1 AS gl, lag(t) OVER g AS gt FROM {_LINES} WINDOW g AS (PARTITION BY doc, page, block, para, line ORDER BY l, word)),
n AS (SELECT doc, page, block, para, line, b AS bottom, count(*) AS n, min(word) AS first FROM w GROUP BY ALL),
c AS (SELECT *, row_number() OVER (PARTITION BY doc, page, block, para, line ORDER BY n DESC, first) AS k FROM n),
ls AS (SELECT doc, page, block, para, line, min(l) AS l, min(t) AS t, max(r) AS r, max(b) AS b, string_agg(
  CASE WHEN gl < l - 1 THEN '<charParams' || {_EDGES.format("gl", "gt", "(l - 1)", "b")} || '> </charParams>' ELSE '' END || '<charParams' || {_EDGES.format("l", "t", "r", "b")} || '>' || {_ESC.format("text")} || '</charParams>', '' ORDER BY l, word) AS x FROM w GROUP BY ALL),
ps AS (SELECT doc, page, block, para, min(l) AS l, min(t) AS t, max(r) AS r, max(b) AS b, string_agg('<line baseline="' || bottom || '"' || {_EDGES.format("l", "t", "r", "b")} || '><formatting>' || x || '</formatting></line>', '' ORDER BY line) AS x
  FROM ls JOIN (FROM c WHERE k = 1) USING (doc, page, block, para, line) GROUP BY doc, page, block, para),
bs AS (SELECT doc, page, block, min(l) AS l, min(t) AS t, max(r) AS r, max(b) AS b, string_agg('<par>' || x || '</par>', '' ORDER BY para) AS x FROM ps GROUP BY doc, page, block)
SELECT doc, page, '<page width="' || max(r) || '" height="' || max(b) || '" resolution="300" originalCoords="1">' || string_agg('<block blockType="Text" blockName=""' || {_EDGES.format("l", "t", "r", "b")}
  || '><region><rect' || {_EDGES.format("l", "t", "r", "b")} || '/></region><text>' || x || '</text></block>', '' ORDER BY block) || '</page>' AS xml FROM bs GROUP BY doc, page""")
def layout_abbyy(spark, d):
    return layout.abbyy(_lines(spark, d))


@query("SELECT o_orderkey, concat_ws('; ', 'bbox ' || o_custkey, CASE WHEN o_orderkey % 3 > 0 THEN 'x_wconf ' || o_orderpriority END) AS title FROM orders")
def layout_title_attribute(spark, d):
    pair = lambda k, v: F.struct(F.lit(k).alias("k"), v.alias("v"))
    pairs = F.array(pair("bbox", F.col("o_custkey").cast("string")), pair("x_wconf", F.when(F.col("o_orderkey") % 3 > 0, F.col("o_orderpriority"))))
    return table(spark, d, "orders").select("o_orderkey", layout.title_attribute(pairs).alias("title"))


@query("SELECT conv_id, turn, concat(role, ' ', CASE WHEN turn % 2 = 0 THEN turn || chr(10) ELSE CAST(turn AS VARCHAR) END) AS word FROM conversations")
def layout_word_text(spark, d):
    symbol = lambda t, brk: F.struct(t.alias("text"), brk.alias("brk"))
    symbols = F.array(symbol(F.col("role"), F.when(F.col("turn") % 2 == 0, 3).otherwise(1)), symbol(F.col("turn").cast("string"), F.when(F.col("turn") % 2 == 0, 5).otherwise(0)))
    return table(spark, d, "conversations").select("conv_id", "turn", layout.word_text(symbols).alias("word"))


def _cells(spark, d):
    """Words of tables: suppliers are documents, orders lines, and the columns lie 120 apart."""
    rows = table(spark, d, "lineitem").select(
        F.col("l_suppkey").alias("doc"), F.lit(1).alias("page"), (F.col("l_orderkey") % 7).alias("block"), F.col("l_orderkey").alias("line"), F.col("l_linenumber").alias("word"),
        F.col("l_returnflag").alias("text"), (120 * (F.col("l_linenumber") - 1) + F.col("l_partkey") % 4).cast("int").alias("l"), (120 * (F.col("l_linenumber") - 1) + 30).cast("int").alias("r"),
    )
    return rows.withColumn("box", F.struct("l", F.lit(0).alias("t"), "r", F.lit(10).alias("b"))).dropDuplicates(["doc", "block", "line", "word"])


_T = """(SELECT DISTINCT ON (doc, block, line, word) * FROM (SELECT l_suppkey AS doc, 1 AS page, l_orderkey % 7 AS block, l_orderkey AS line, l_linenumber AS word, l_returnflag AS text,
 CAST(120 * (l_linenumber - 1) + l_partkey % 4 AS INT) AS l, CAST(120 * (l_linenumber - 1) + 30 AS INT) AS r FROM lineitem))"""
_BOUNDS = f"""(SELECT doc, page, block, list_sort(list(edge)) AS bounds FROM
(SELECT doc, page, block, edge, count(DISTINCT line) AS n FROM (SELECT *, CAST(round(l / 10.0) * 10 AS INT) AS edge, l - lag(r) OVER (PARTITION BY doc, page, block, line ORDER BY l, word) AS gap FROM {_T}) WHERE gap >= 40 GROUP BY ALL)
JOIN (SELECT doc, page, block, count(DISTINCT line) AS lines FROM {_T} GROUP BY ALL) USING (doc, page, block) WHERE n >= 0.05 * lines AND lines > 1 GROUP BY doc, page, block)"""


@query(f"SELECT doc, page, block, array_to_string(bounds, ',') AS bounds FROM {_BOUNDS}")
def layout_table_columns(spark, d):
    return flow.table_columns(_cells(spark, d), share=0.05).select("doc", "page", "block", F.array_join(F.transform("bounds", lambda x: x.cast("string")), ",").alias("bounds"))


_CELLS = f"""(SELECT doc, page, block, line, col, greatest(max(last) - col, 0) + 1 AS span, string_agg(text, ' ' ORDER BY l, word) AS text FROM
(SELECT *, len(list_filter(bounds, lambda e: e <= l + 5)) AS col, len(list_filter(bounds, lambda e: e <= r - 10 + 5)) AS last FROM {_T} JOIN {_BOUNDS} USING (doc, page, block)) GROUP BY doc, page, block, line, col)"""


@query(f"""SELECT doc, page, block, '<table>' || string_agg('<tr>' || x || '</tr>', '' ORDER BY line) || '</table>' AS html FROM
(SELECT doc, page, block, line, string_agg('<td' || CASE WHEN span > 1 THEN ' colspan="' || span || '"' ELSE '' END || '>' || text || '</td>', '' ORDER BY col) AS x FROM {_CELLS} GROUP BY doc, page, block, line) GROUP BY doc, page, block""")
def layout_table_html(spark, d):
    words = _cells(spark, d)
    return flow.table_html(flow.table_cells(words, flow.table_columns(words, share=0.05)))


_PARA_IN = "(SELECT conv_id AS doc, CAST(turn // 4 AS INT) AS page, turn AS line, text, CAST((turn % 4) * 30 + turn % 3 * 9 AS INT) AS t, CAST((turn % 4) * 30 + turn % 3 * 9 + 12 AS INT) AS b, CAST(length(role) * 6 AS INT) AS l FROM conversations)"


def _turns(spark, d):
    rows = table(spark, d, "conversations").dropDuplicates(["conv_id", "turn"]).select(
        F.col("conv_id").alias("doc"), F.floor(F.col("turn") / 4).cast("int").alias("page"), F.col("turn").alias("line"), "text", "role",
    )
    top = ((F.col("line") % 4) * 30 + F.col("line") % 3 * 9).cast("int")
    box = F.struct((F.length("role") * 6).cast("int").alias("l"), top.alias("t"), F.lit(500).alias("r"), (top + 12).cast("int").alias("b"))
    return rows.withColumn("box", box)


_END = r"coalesce(regexp_matches(rtrim({0}), '[.?!:;][\"'')\]]*$') AND NOT regexp_matches(rtrim({0}), '(?i)(?:^|[\s(])(?:no|nos|dr|mr|mrs|shri|smt|sec|art|vs|viz|[a-z])\.$'), false)"
_PARAS = rf"""(SELECT *, sum(s) OVER (PARTITION BY doc ORDER BY page, line ROWS UNBOUNDED PRECEDING)::BIGINT AS para FROM
(SELECT *, CASE WHEN before IS NULL OR regexp_matches(text, '^\s*(?:\(?[0-9]{{1,3}}[.)]|\(?[a-z]{{1,4}}\)|[•●▪-])\s')
   OR {_END.format("before")} AND (len(list_filter(regexp_split_to_array(trim(text), '\s+'), lambda x: regexp_matches(x, '^[a-z]'))) = 0 OR page = page0 AND ((t - t0) / h > 1.3 * 1.2 OR l - leftmost > h)) THEN 1 ELSE 0 END AS s FROM
(SELECT *, lag(text) OVER w AS before, lag(page) OVER w AS page0, lag(t) OVER w AS t0, greatest(avg(b - t) OVER (PARTITION BY doc, page), 1.0) AS h, min(l) OVER (PARTITION BY doc, page) AS leftmost
 FROM {_PARA_IN} WINDOW w AS (PARTITION BY doc ORDER BY page, line))))"""


@query(f"SELECT doc, line, para FROM {_PARAS}")
def layout_paragraphs(spark, d):
    return flow.paragraphs(_turns(spark, d)).select("doc", "line", "para")


@query(rf"""SELECT doc, para, min(page) AS first_page, regexp_replace(string_agg(trim(text), ' ' ORDER BY page, line), '(\p{{Ll}})- (\p{{Ll}})', '\1\2', 'g') AS text FROM {_PARAS} GROUP BY doc, para""")
def layout_paragraph_texts(spark, d):
    return flow.paragraph_texts(_turns(spark, d))


@query(f"SELECT doc, string_agg('<p>' || {_ESC.format('text')} || '</p>', chr(10) ORDER BY line) AS html FROM {_PARA_IN} GROUP BY doc")
def layout_paragraph_html(spark, d):
    return flow.paragraph_html(_turns(spark, d).withColumn("para", F.col("line")), F.lit("p"))


@query(r"""SELECT conv_id, turn, CASE WHEN regexp_matches(h, '^\s*(?:CHAPTER|PART|SCHEDULE|APPENDIX)\b') THEN 'h2' WHEN len(regexp_split_to_array(trim(h), '\s+')) >= 6 THEN 'p'
WHEN NOT regexp_matches(h, '\p{Ll}') AND regexp_matches(h, '\p{Lu}') THEN 'h3' WHEN regexp_matches(h, '^\s*(?:[0-9]+|[A-Z]|[ivxIVX]+)[.)]') THEN 'h4' ELSE 'p' END AS tag
FROM (SELECT conv_id, turn, CASE turn % 4 WHEN 0 THEN 'CHAPTER ' || turn WHEN 1 THEN turn || '. ' || role WHEN 2 THEN upper(role) ELSE text END AS h FROM conversations)""")
def layout_heading_tags(spark, d):
    c, turn = table(spark, d, "conversations"), F.col("turn")
    head = F.when(turn % 4 == 0, F.concat(F.lit("CHAPTER "), turn.cast("string"))).when(turn % 4 == 1, F.concat(turn.cast("string"), F.lit(". "), F.col("role")))
    return c.select("conv_id", "turn", text.heading_tag(head.when(turn % 4 == 2, F.upper("role")).otherwise(F.col("text"))).alias("tag"))


@query(r"SELECT conv_id, turn, len(list_filter(regexp_split_to_array(text, '\s+'), lambda w: regexp_matches(w, '^[a-z]'))) = 0 AS capital FROM conversations")
def layout_capital_starts(spark, d):
    return table(spark, d, "conversations").select("conv_id", "turn", text.all_capital_starts(F.split("text", "\\s+")).alias("capital"))


@query(rf"SELECT conv_id, turn, {_END.format('text')} AS ends FROM conversations")
def layout_sentence_ends(spark, d):
    return table(spark, d, "conversations").select("conv_id", "turn", text.sentence_end(F.col("text")).alias("ends"))


@query("""WITH w AS (SELECT conv_id AS doc, turn // 40 AS result, turn % 40 AS idx, role AS word, turn * 0.5 AS start_s FROM conversations WHERE turn % 5 <> 3),
n AS (SELECT *, row_number() OVER (PARTITION BY doc, result ORDER BY idx) - 1 AS k FROM w),
g AS (SELECT *, k // 3 AS phrase FROM n),
p AS (SELECT doc, result, phrase, string_agg(word, ' ' ORDER BY idx) AS text, min(start_s) AS start_s FROM g GROUP BY doc, result, phrase)
SELECT doc, text, start_s, row_number() OVER (PARTITION BY doc ORDER BY result, phrase) - 1 AS number FROM p""")
def subtitle_phrases(spark, d):
    c = table(spark, d, "conversations").dropDuplicates(["conv_id", "turn"])
    words = c.select(
        F.col("conv_id").alias("doc"), F.floor(F.col("turn") / 40).cast("int").alias("result"), (F.col("turn") % 40).cast("int").alias("idx"),
        F.when(F.col("turn") % 5 == 3, " ").otherwise(F.col("role")).alias("word"), (F.col("turn") * 0.5).alias("start_s"), (F.col("turn") * 0.5 + 0.4).alias("end_s"),
    )
    # no phrase of three words is ten seconds long, so only the bound of words cuts here; the other is tested on made words
    return windows.phrases(words, 3, 10.0, "doc").select("doc", "text", "start_s", F.col("number").cast("long").alias("number"))


@query("SELECT l_orderkey, l_linenumber, printf('%02d:%02d:%02d,%03d', ms // 3600000, ms // 60000 % 60, ms // 1000 % 60, ms % 1000) AS t FROM (SELECT l_orderkey, l_linenumber, CAST(round(l_extendedprice * 1000) AS BIGINT) AS ms FROM lineitem)")
def subtitle_times(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", windows.srt_time(F.col("l_extendedprice")).alias("t"))


#: Lines of pages of two columns: the items of a supplier, twelve a page, some of them far down.
_FLOW = {
    "doc": "l_suppkey", "page": "CAST(1 + floor(k / 12) AS INT)", "height": "200", "column": "CAST(floor(k % 12 / 6) AS INT)", "block": "CAST(floor(k % 12 / 3) AS INT)", "para": "CAST(floor(k % 12 / 2) AS INT)",
    "line": "CAST(k % 12 AS INT)", "t": "CAST(k % 12 * 15 + l_partkey % 3 * 4 + CASE WHEN k % 12 = 11 AND l_partkey % 2 = 0 THEN 14 ELSE 0 END AS INT)",
    "text": """CASE l_partkey % 9 WHEN 0 THEN 'The end of it.' WHEN 1 THEN 'SOME CAPITALS' WHEN 2 THEN concat('a) item ', l_linenumber) WHEN 3 THEN '12 34' WHEN 4 THEN 'Next Capital Start'
      WHEN 5 THEN 'cut wor-' WHEN 6 THEN 'and more of it' WHEN 7 THEN 'Begins with one' ELSE 'goes on & on' END""",
}
_FLOW_ORDER = "l_orderkey, l_linenumber, l_partkey, l_extendedprice"
_FLOW_IN = "(SELECT " + ", ".join(f"{e} AS \"{n}\"" for n, e in _FLOW.items()) + f" FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY {_FLOW_ORDER}) - 1 AS k FROM lineitem))"


def _flowing(spark, d):
    turn = Window.partitionBy("l_suppkey").orderBy(*_FLOW_ORDER.split(", "))
    rows = dealt(table(spark, d, "lineitem"), "l_suppkey").withColumn("k", F.row_number().over(turn) - 1).select(*[F.expr(e).alias(n) for n, e in _FLOW.items()])
    return rows.withColumn("box", F.struct(F.lit(0).alias("l"), F.col("t").alias("t"), F.lit(300).alias("r"), (F.col("t") + 10).alias("b"))).drop("t")


_PARAGRAPHS = rf"""
a AS (SELECT *, lag(page) OVER w AS p0, lag(block) OVER w AS b0, lag(para) OVER w AS o0, lag(text) OVER w AS x0 FROM {_FLOW_IN} WINDOW w AS (PARTITION BY doc ORDER BY page, line)),
g AS (SELECT *, sum(CASE WHEN coalesce(p0 = page AND b0 = block AND (o0 = para OR NOT {_END.format("x0")}), false) THEN 0 ELSE 1 END) OVER (PARTITION BY doc ORDER BY page, line) AS grp FROM a),
n AS (SELECT *, lead(line) OVER w IS NULL AND coalesce(CASE WHEN lag(t) OVER w IS NULL THEN t > 0.87 * height ELSE t > 0.85 * height AND t - lag(t) OVER w > 13.5 END, false) AS footnote FROM g WINDOW w AS (PARTITION BY doc, grp ORDER BY page, line)),
x AS (SELECT *, len(list_filter(regexp_split_to_array(trim(text), '\s+'), lambda w: regexp_matches(w, '^[a-z]'))) = 0 AS caps, regexp_matches(trim(text), '^(?:[\p{{L}}\p{{N}}_]\)\s+|[0-9\sA-Z]+$)') AS marked, {_END.format("text")} AS ended FROM n WHERE NOT footnote),
s AS (SELECT *, lag(line) OVER w IS NULL OR (lag(ended) OVER w AND t - lag(t) OVER w > 13) OR (caps AND NOT lag(caps) OVER w) OR marked OR (regexp_matches(text, '^[A-Z]') AND t - lag(t) OVER w > 13) AS starts,
  grp = max(grp) OVER (PARTITION BY doc, page, "column") AND lead(line) OVER w IS NULL AS final FROM x WINDOW w AS (PARTITION BY doc, grp ORDER BY page, line)),
p AS (SELECT *, sum(CASE WHEN starts THEN 1 ELSE 0 END) OVER (PARTITION BY doc ORDER BY page, line) AS p FROM s),
q AS (SELECT doc, p, bool_and(caps) AS caps, arg_min(marked, page * 100 + line) AS marked, arg_max(final AND NOT ended, page * 100 + line) AS open FROM p GROUP BY doc, p),
r AS (SELECT doc, p, sum(CASE WHEN before AND NOT caps AND NOT marked THEN 0 ELSE 1 END) OVER (PARTITION BY doc ORDER BY p)::BIGINT AS paragraph FROM (SELECT *, coalesce(lag(open) OVER (PARTITION BY doc ORDER BY p), false) AS before FROM q)),
z AS (SELECT p.*, paragraph FROM p JOIN r USING (doc, p))"""
_JOINED = r"regexp_replace(string_agg(trim(text), ' ' ORDER BY page, line), '(\p{Ll})- (\p{Ll})', '\1\2', 'g')"


@query(f"WITH {_PARAGRAPHS} SELECT doc, page, line, paragraph FROM z UNION ALL SELECT doc, page, line, NULL FROM n WHERE footnote")
def layout_paragraphs_over_pages(spark, d):
    return page_flow.layout_paragraphs(_flowing(spark, d)).select("doc", "page", "line", "paragraph")


@query(f"WITH {_PARAGRAPHS} SELECT doc, paragraph, min(page) AS first_page, max(page) AS last_page, {_JOINED} AS text FROM z GROUP BY doc, paragraph")
def layout_texts_over_pages(spark, d):
    return page_flow.paragraph_texts(_flowing(spark, d))


@query(f"""WITH {_PARAGRAPHS}, h AS (SELECT doc, max(page) AS page, 0 AS kind, paragraph AS k, '<p>' || {_ESC.format(_JOINED)} || '</p>' AS h FROM z GROUP BY doc, paragraph
UNION ALL SELECT doc, page, 1, line, '<span class="footnote">' || {_ESC.format('trim(text)')} || '</span>' FROM n WHERE footnote
UNION ALL SELECT doc, page, 2, 0, '<span class="pageend" data-pagenum="' || page || '"></span>' FROM n GROUP BY doc, page)
SELECT doc, string_agg(h, chr(10) ORDER BY page, kind, k) AS html FROM h GROUP BY doc""")
def layout_html_over_pages(spark, d):
    return page_flow.document_html(_flowing(spark, d))
