"""Queries of tables in preformatted pages, each with the same result as SQL.

Roles: the items of a supplier with one line number are the lines of a page; their values are set in columns,
some of them missing, blank, indented or reaching across.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import tables
from ..session import dealt
from .archive_queries import query, table

_TEXT = """CASE l_partkey % 11 WHEN 0 THEN concat('Total of all ', l_orderkey, ' items in the list') WHEN 3 THEN '   ' WHEN 5 THEN concat('   ', l_returnflag)
  ELSE concat(rpad(concat(l_returnflag, '-', CAST(l_quantity AS INT)), 8, ' '), '  ', CASE l_partkey % 11 WHEN 2 THEN rpad('', 9, ' ') WHEN 4 THEN rpad(concat('part number ', l_partkey), 18, ' ') ELSE rpad(concat('p', l_partkey), 9, ' ') END,
    CASE WHEN l_partkey % 11 <> 4 THEN concat(lpad(CAST(l_suppkey AS STRING), 4, ' '), '  ') ELSE '' END, l_linestatus, ' & ', l_returnflag) END"""
_ORDER = "l_orderkey, l_partkey, l_extendedprice"
_LINES = f"(SELECT l_suppkey AS doc, l_linenumber AS page, row_number() OVER (PARTITION BY l_suppkey, l_linenumber ORDER BY {_ORDER}) AS line, {_TEXT.replace(' AS STRING', ' AS VARCHAR')} AS text FROM lineitem)"


def _lines(spark, d):
    turn = Window.partitionBy("l_suppkey", "l_linenumber").orderBy(*_ORDER.split(", "))
    items = dealt(table(spark, d, "lineitem"), "l_suppkey", "l_linenumber")
    return items.select(F.col("l_suppkey").alias("doc"), F.col("l_linenumber").alias("page"), F.row_number().over(turn).alias("line"), F.expr(_TEXT).alias("text"))


_PIECES = f"""
l AS (SELECT *, string_split_regex(text, '\\s{{2,}}') AS ps, regexp_extract_all(text, '\\s{{2,}}') AS gs FROM {_LINES}),
e AS (SELECT doc, page, line, i, ps[i] AS text, length(ps[i]) AS n, coalesce(length(gs[i]), 0) AS g FROM l, unnest(range(1, len(ps) + 1)) AS t(i)),
o AS (SELECT *, sum(n + g) OVER (PARTITION BY doc, page, line ORDER BY i)::BIGINT - n - g AS b FROM e),
p AS (SELECT doc, page, line, b, b + n AS x, text, lag(b + n, 1, 0) OVER (PARTITION BY doc, page, line ORDER BY b) AS before FROM o WHERE trim(text) <> '')"""
_COLUMNS = f"""{_PIECES},
h AS (SELECT doc, page, at_, sum(k)::BIGINT AS n, arg_min(len_, k * 1000 - len_) AS len_ FROM (SELECT doc, page, b AS at_, b - before AS len_, count(*) AS k FROM p WHERE b - before >= 2 GROUP BY ALL) GROUP BY ALL),
c AS (SELECT h.*, h.at_ - h.len_ AS pos FROM h LEFT JOIN h m ON m.doc = h.doc AND m.page = h.page AND m.at_ = h.at_ + 1 WHERE h.at_ > h.len_ AND h.n >= {tables.LEAST} AND coalesce(m.n <= h.n, true)),
m AS (SELECT doc, page, 0::BIGINT AS b, 0::BIGINT AS at_ FROM p GROUP BY ALL
  UNION ALL SELECT doc, page, pos, at_ FROM (SELECT c.doc, c.page, c.pos, c.at_, row_number() OVER (PARTITION BY c.doc, c.page ORDER BY c.at_) AS k FROM m JOIN c ON c.doc = m.doc AND c.page = m.page AND c.at_ > m.at_ AND c.pos >= m.at_) WHERE k = 1),
w AS (SELECT doc, page, max(x) AS width FROM p GROUP BY ALL),
s AS (SELECT doc, page, at_ AS b, lead(b) OVER (PARTITION BY doc, page ORDER BY at_) AS x FROM m),
q AS (SELECT doc, page, row_number() OVER (PARTITION BY doc, page ORDER BY s.b) AS col, s.b, coalesce(s.x, width) AS x, count(*) OVER (PARTITION BY doc, page) AS n FROM s JOIN w USING (doc, page) WHERE s.x IS NOT NULL OR s.b < width)"""
_CELLS = f"""{_COLUMNS},
z AS (SELECT p.doc, p.page, line, p.b, p.x, any_value(text) AS text, any_value(q.n) AS n, count(*) FILTER (q.b - 1 <= p.b) AS begun, count(*) FILTER (q.b <= p.x - 1) AS reach FROM p JOIN q ON q.doc = p.doc AND q.page = p.page AND q.n > 1 GROUP BY p.doc, p.page, line, p.b, p.x),
f AS (SELECT z.*, CASE WHEN begun = 0 THEN 1 WHEN z.b >= h.x AND a.b IS NOT NULL AND z.b - h.x >= a.b - z.x THEN begun + 1 ELSE begun END AS first FROM z
  LEFT JOIN q h ON h.doc = z.doc AND h.page = z.page AND h.col = begun LEFT JOIN q a ON a.doc = z.doc AND a.page = z.page AND a.col = begun + 1),
r AS (SELECT *, greatest(first, reach) AS last, max(greatest(first, reach)) OVER (PARTITION BY doc, page, line ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached FROM f),
g AS (SELECT *, count(*) FILTER (reached IS NULL OR first > reached) OVER (PARTITION BY doc, page, line ORDER BY b) AS cell FROM r),
j AS (SELECT doc, page, line, n, min(first) AS col, max(last) - min(first) + 1 AS span, string_agg(text, ' ' ORDER BY b) AS text FROM g GROUP BY doc, page, line, n, cell),
y AS (SELECT doc, page, line, col::INT AS col, span::INT AS span, text FROM j UNION ALL
  SELECT doc, page, line, k::INT, 1, '' FROM (SELECT doc, page, line, unnest(range(1, any_value(n) + 1)) AS k FROM j GROUP BY doc, page, line) v
  WHERE NOT EXISTS (SELECT 1 FROM j WHERE j.doc = v.doc AND j.page = v.page AND j.line = v.line AND k BETWEEN col AND col + span - 1))"""


@query(f"WITH RECURSIVE {_COLUMNS} SELECT doc, page, string_agg(b || '-' || x, ',' ORDER BY b) AS columns FROM q WHERE n > 1 GROUP BY ALL")
def layout_columns_of_gaps(spark, d):
    found = tables.columns(tables.pieces(_lines(spark, d)))
    return found.select("doc", "page", F.array_join(F.transform("columns", lambda c: F.concat(c["start"].cast("string"), F.lit("-"), c["end"].cast("string"))), ",").alias("columns"))


@query(f"WITH RECURSIVE {_CELLS} SELECT doc, page, line, col, span, text FROM y")
def layout_cells_of_gaps(spark, d):
    found = tables.pieces(_lines(spark, d))
    return tables.cells(found, tables.columns(found)).select("doc", "page", "line", "col", "span", "text")


_SAFE = "replace(text, '&', '&amp;')"


@query(f"""WITH RECURSIVE {_CELLS},
t AS (SELECT doc, page, line, '<tr>' || string_agg('<td' || CASE WHEN span > 1 THEN ' colspan="' || span || '"' ELSE '' END || '>' || {_SAFE} || '</td>', '' ORDER BY col) || '</tr>' AS h FROM y GROUP BY ALL)
SELECT doc, page, '<table>' || string_agg(h, '' ORDER BY line) || '</table>' AS html FROM t GROUP BY ALL
UNION ALL SELECT doc, page, string_agg('<p>' || {_SAFE} || '</p>', '' ORDER BY line) FROM l WHERE (doc, page) NOT IN (SELECT (doc, page) FROM q WHERE n > 1) GROUP BY ALL""")
def layout_preformatted_html(spark, d):
    return tables.page_html(_lines(spark, d)).select("doc", "page", "html")
