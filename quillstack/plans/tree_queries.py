"""Queries that rewrite regulation trees, each with the same result as a recursive SQL query.

Roles: the order lines of a supplier are the nodes of a regulation, three children a node, six levels below
the root; what a line's numbers pick from the list of its level is its tag and kind.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import trees
from ..session import dealt
from .archive_queries import query, table

#: tag:kind, by the level of a node.
_LEVELS = (
    ("code:Chapter", "code:Part", "code:Division", "code:Article", "code:Undesignated", "code:Appendix", "code:Rule"),
    ("code:Chapter", "code:Section", "code:Rule", "code:Undesignated", "code:Subchapter", "code:Article", "code:Part", "code:Division", "content:", "code:Subpart"),
    ("code:Section", "code:Rule", "code:Undesignated", "content:", "code:Article", "code:Appendix", "code:Subarticle", "subsect:", "version:", "code:Exhibit", "CODE:Chapter"),
    ("content:", "subsect:", "code:Section", "codetext:", "notes:", "code:Unprefixed", "currency:", "code:Table", "code:Rule"),
    ("codetext:", "subsect:", "content:", "para:", "notes:", "notes-history:", "bold:", "designator:", "itemizedlist:", "notes-citeas:", "code:Subdivision"),
    ("para:", "subsect:", "Bold:", "designator:", "listitem:", "note:", "codecitation:", "TABLE:", "strike:"),
)
_LAST = (4, 13, 40, 121, 364)
_PICK = "(l_partkey + l_linenumber * 3)"
_LISTS = "CASE " + " ".join(f"WHEN node <= {_LAST[k]} THEN pick{k}" for k in range(5)) + " ELSE pick5 END"
_LINES = f"""(SELECT *, {", ".join(f"[{', '.join(repr(x) for x in xs)}][{_PICK} % {len(xs)} + 1] AS pick{k}" for k, xs in enumerate(_LEVELS))}
  FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice) AS node FROM lineitem))"""
_TREE = f"""(SELECT l_suppkey AS reg, node, CASE WHEN node > 1 THEN 1 + (node - 2) // 3 END AS parent, split_part({_LISTS}, ':', 1) AS tag, split_part({_LISTS}, ':', 2) AS kind,
  (l_partkey % 9)::VARCHAR AS num, CASE WHEN l_quantity % 10 = 0 THEN '[Rescinded] x' ELSE 'Of ' || l_linenumber END AS title, l_returnflag AS text FROM {_LINES})"""


def _nodes(spark, d):
    turn = Window.partitionBy("l_suppkey").orderBy("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    columns = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag")
    lines = dealt(table(spark, d, "lineitem").select(*columns), "l_suppkey").withColumn("node", F.row_number().over(turn).cast("long"))
    picks = [F.element_at(F.array(*map(F.lit, xs)), (F.expr(f"{_PICK} % {len(xs)}") + 1).cast("int")) for xs in _LEVELS]
    pick = picks[-1]
    for last, own in zip(reversed(_LAST), reversed(picks[:-1])):
        pick = F.when(F.col("node") <= last, own).otherwise(pick)
    title = F.when(F.col("l_quantity") % 10 == 0, "[Rescinded] x").otherwise(F.concat(F.lit("Of "), F.col("l_linenumber").cast("string")))
    return lines.withColumn("pick", F.split(pick, ":")).select(
        F.col("l_suppkey").alias("reg"), "node", F.when(F.col("node") > 1, 1 + F.floor((F.col("node") - 2) / 3)).alias("parent"), F.col("pick")[0].alias("tag"),
        F.col("pick")[1].alias("kind"), (F.col("l_partkey") % 9).cast("string").alias("num"), title.alias("title"), F.col("l_returnflag").alias("text"),
    )


def _value(x) -> str:
    return "NULL" if x is None else f"'{x}'"


_RULES = "(VALUES " + ", ".join(f"({', '.join(map(_value, r))})" for r in trees.rules()) + ") r(context, r_tag, r_kind, becomes, action, place, first, second, prefix, counts)"
_S = trees.SLOTS
_STATE = "reg, node, parent, tag, kind, num, title, text, becomes, action, first, second, prefix, counts, at_, into_, up, outer_, anchor, suffix, outer_anchor, outer_suffix"
_PASSES = f"""
n AS (SELECT *, CASE WHEN lower(tag) <> 'code' THEN '' WHEN kind = 'Rule' AND (reg, node) IN (SELECT (reg, parent) FROM {_TREE} WHERE lower(tag) = 'code' AND kind IN ('Article', 'Section')) THEN 'ruleofsections' ELSE lower(kind) END AS rule_kind FROM {_TREE}),
t AS (
SELECT reg, node, parent, tag, kind, num, title, text, 'regulation' AS becomes, 'make' AS action, 'body' AS first, 'body' AS second, NULL::VARCHAR AS prefix, NULL::VARCHAR AS counts, NULL::BIGINT AS at_,
  node * {_S} AS into_, node * {_S} AS up, node * {_S} AS outer_, node AS anchor, '' AS suffix, node AS outer_anchor, '' AS outer_suffix FROM n WHERE parent IS NULL
UNION ALL
SELECT reg, node, parent, tag, kind, num, title, text, becomes, action, first, second, prefix, counts, at_,
  CASE action WHEN 'wrap' THEN node * {_S} + 1 WHEN 'make' THEN node * {_S} WHEN 'inline' THEN node * {_S} ELSE at_ END,
  CASE action WHEN 'wrap' THEN node * {_S} WHEN 'make' THEN at_ ELSE p_up END,
  CASE WHEN action IN ('wrap', 'make') THEN at_ ELSE p_outer END,
  CASE WHEN counts = 'all' THEN node ELSE from_anchor END,
  CASE counts WHEN 'all' THEN '' WHEN 'own' THEN from_suffix || prefix || (CASE WHEN prefix = '_content_' THEN 1 ELSE 0 END + nth) ELSE from_suffix END,
  CASE WHEN action IN ('wrap', 'make') THEN p_anchor ELSE p_outer_anchor END,
  CASE WHEN action IN ('wrap', 'make') THEN p_suffix ELSE p_outer_suffix END
FROM (
  SELECT *, CASE place WHEN 'up' THEN p_up WHEN 'outer' THEN p_outer WHEN 'into' THEN p_into
      WHEN 'para' THEN coalesce(last_value(CASE WHEN action = 'split' THEN node * {_S} + 2 WHEN becomes = 'p' THEN node * {_S} END IGNORE NULLS) OVER w, p_into)
      WHEN 'content' THEN coalesce(last_value(CASE WHEN action = 'split' THEN node * {_S} + 1 END IGNORE NULLS) OVER w, p_into) END AS at_,
    CASE WHEN place = 'outer' AND becomes = 'subsection' THEN p_outer_anchor ELSE p_anchor END AS from_anchor,
    CASE WHEN place = 'outer' AND becomes = 'subsection' THEN p_outer_suffix ELSE p_suffix END AS from_suffix,
    row_number() OVER (PARTITION BY reg, parent, prefix ORDER BY node) AS nth
  FROM (
    SELECT n.*, CASE WHEN hit THEN r.becomes END AS becomes, CASE WHEN hit THEN r.action WHEN r.action IS NULL THEN 'ignored' ELSE 'drop' END AS action, CASE WHEN hit THEN first END AS first, CASE WHEN hit THEN second END AS second,
      CASE WHEN hit THEN prefix END AS prefix, CASE WHEN hit THEN counts END AS counts, CASE WHEN hit THEN place END AS place, p_into, p_up, p_outer, p_anchor, p_suffix, p_outer_anchor, p_outer_suffix
    FROM (SELECT n.*, t.becomes AS context, into_ AS p_into, up AS p_up, outer_ AS p_outer, anchor AS p_anchor, suffix AS p_suffix, outer_anchor AS p_outer_anchor, outer_suffix AS p_outer_suffix
          FROM t JOIN n ON n.reg = t.reg AND n.parent = t.node WHERE t.action NOT IN ('drop', 'ignored')) n
    LEFT JOIN (SELECT *, action <> 'drop' AS keeps FROM {_RULES}) r ON r.context = n.context AND r_tag = lower(tag) AND r_kind = rule_kind,
    LATERAL (SELECT coalesce(keeps AND NOT (r.becomes = 'section' AND title LIKE '[Rescind%'), false) AS hit)
  ) WINDOW w AS (PARTITION BY reg, parent ORDER BY node ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
))"""
_KEPT = "(SELECT * FROM t WHERE action NOT IN ('drop', 'ignored'))"
_WITH_IDS = f"""
b AS (SELECT reg, node AS anchor, prefix || '_' || row_number() OVER (PARTITION BY reg, prefix ORDER BY node) AS begins FROM {{kept}} WHERE counts = 'all'),
i AS (SELECT k.*, CASE WHEN counts IS NOT NULL THEN coalesce(begins, '') || suffix END AS eid FROM {{kept}} k LEFT JOIN b USING (reg, anchor))"""
_HEADING = "CASE WHEN becomes = 'group' AND kind NOT IN ('Undesignated', 'Unprefixed') THEN kind || ' - ' || title ELSE title END"
_ELEMENTS = f"""SELECT reg, e.el, e.parent, e.element, e.eid, e.num, e.heading, e.text FROM (SELECT reg, unnest(CASE action
  WHEN 'wrap' THEN [{{{{el: node * {_S}, parent: at_, element: first, eid: eid, num: num, heading: {_HEADING}, text: NULL}}}}, {{{{el: node * {_S} + 1, parent: node * {_S}, element: second, eid: NULL, num: NULL, heading: NULL, text: text}}}}]
  WHEN 'split' THEN [{{{{el: node * {_S}, parent: at_, element: 'num', eid: NULL, num: NULL, heading: NULL, text: text}}}}, {{{{el: node * {_S} + 1, parent: at_, element: 'content', eid: NULL, num: NULL, heading: NULL, text: NULL}}}},
    {{{{el: node * {_S} + 2, parent: node * {_S} + 1, element: 'p', eid: NULL, num: NULL, heading: NULL, text: NULL}}}}]
  WHEN 'pass' THEN [{{{{el: node * {_S}, parent: at_, element: '#text', eid: NULL, num: NULL, heading: NULL, text: text}}}}]
  ELSE [{{{{el: node * {_S}, parent: at_, element: first, eid: eid, num: num, heading: {_HEADING}, text: text}}}}] END) AS e FROM i)""".replace("{{", "{").replace("}}", "}")


def _rewritten(spark, d):
    return trees.rewritten(_nodes(spark, d), trees.rule_table(spark))


@query(f"WITH RECURSIVE {_PASSES} SELECT reg, node, becomes, action, at_ AS \"at\", into_ AS \"into\" FROM {_KEPT}")
def regulation_trees(spark, d):
    return _rewritten(spark, d).where("action NOT IN ('drop', 'ignored')").select("reg", "node", "becomes", "action", "at", "into")


@query(f"WITH RECURSIVE {_PASSES} SELECT tag, kind, count(*) AS n FROM t WHERE action = 'ignored' GROUP BY tag, kind")
def regulation_tree_ignored(spark, d):
    return trees.ignored(_rewritten(spark, d))


@query(f"WITH RECURSIVE {_PASSES}, {_WITH_IDS.format(kept=_KEPT)} {_ELEMENTS}")
def regulation_tree_elements(spark, d):
    return trees.elements(trees.with_ids(_rewritten(spark, d)))


_WHOLE = f"""
q AS (SELECT DISTINCT reg, reg % 7 AS key, row_number() OVER (PARTITION BY reg % 7 ORDER BY CASE WHEN reg % 5 > 0 THEN reg % 5 END NULLS LAST, reg) AS part FROM (SELECT DISTINCT reg FROM t)),
o AS (SELECT key, part, first_value(root) OVER (PARTITION BY key ORDER BY part) AS top, root, coalesce(sum(most) OVER (PARTITION BY key ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS shift
  FROM (SELECT key, part, max(node) AS most, min(CASE WHEN parent IS NULL THEN node * {_S} END) AS root FROM {_KEPT} JOIN q USING (reg) GROUP BY key, part)),
m AS (SELECT t.* REPLACE (key AS reg, node + shift AS node, anchor + shift AS anchor, CASE WHEN at_ = root AND part > 1 THEN top ELSE at_ + shift * {_S} END AS at_), part
  FROM {_KEPT} t JOIN q USING (reg) JOIN o USING (key, part) WHERE part = 1 OR parent IS NOT NULL),
g AS (SELECT reg, node FROM (SELECT *, min(part) OVER (PARTITION BY reg, num) AS earliest FROM m WHERE becomes = 'section' AND num IS NOT NULL) WHERE part > earliest
  UNION SELECT m.reg, m.node FROM g JOIN m ON m.reg = g.reg AND m.at_ // {_S} = g.node),
w AS (SELECT * FROM m ANTI JOIN g USING (reg, node))"""


@query(f"WITH RECURSIVE {_PASSES}, {_WHOLE}, {_WITH_IDS.format(kept='w')} {_ELEMENTS}")
def regulation_tree_assembly(spark, d):
    tree = _rewritten(spark, d)
    reg = F.col("reg")
    parts = tree.select("reg").distinct().select("reg", (reg % 7).alias("key"), F.when(reg % 5 > 0, reg % 5).alias("subnum"))
    return trees.elements(trees.with_ids(trees.assembled(tree, parts)))


_MARK = "CASE WHEN element = '#text' THEN coalesce(text, '') ELSE '<' || element || coalesce(' eId=\"' || eid || '\"', '') || '>' || coalesce('<num>' || num || '</num>', '') || coalesce('<heading>' || heading || '</heading>', '') || coalesce(text, '') END"


@query(f"""WITH RECURSIVE {_PASSES}, {_WITH_IDS.format(kept=_KEPT)}, e AS ({_ELEMENTS}),
h AS (SELECT *, [el] AS path FROM e WHERE parent IS NULL UNION ALL SELECT e.*, list_append(path, e.el) FROM h JOIN e ON e.reg = h.reg AND e.parent = h.el),
k AS (SELECT reg, path, {_MARK} AS mark FROM h UNION ALL SELECT reg, list_append(path, {2**63 - 1}), '</' || element || '>' FROM h WHERE element <> '#text')
SELECT reg, string_agg(mark, '' ORDER BY path) AS xml FROM k GROUP BY reg""")
def regulation_tree_documents(spark, d):
    return trees.documents(trees.elements(trees.with_ids(_rewritten(spark, d))))
