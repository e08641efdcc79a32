"""Queries of title grammars, declared entities and orders of a language, each with the same result as SQL.

Roles: an order is a document of one of nine sources, whose title is made of its numbers; nations are declared as entities.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import ordering, title_rules
from ..sources import containers, entities
from .archive_queries import query, table

_SOURCE = "CASE o_orderkey % 9 " + " ".join(f"WHEN {k} THEN '{s}'" for k, s in enumerate("lakshadweep dadranagarhaveli arunachal jammuandkashmir nagaland meghalaya stgeorge keralalibrary".split())) + " ELSE 'assam' END"
_TITLE = """CASE o_orderkey % 9
  WHEN 0 THEN CASE o_custkey % 4 WHEN 0 THEN 'LVIII No.73' WHEN 1 THEN 'Vol LVIII No.72' ELSE concat('VOL. LX No.', o_custkey % 50, ' FRIDAY, ', 1 + o_custkey % 31, 'th MAY, 2024 / 20th VIASAKHA, 1946 (SAKA)') END
  WHEN 1 THEN CASE o_custkey % 3 WHEN 0 THEN concat('Official Gazette : Series - II No. ', o_custkey % 90) WHEN 1 THEN concat('OFFICIAL GAZETTE: Extra Ordinary No. ', o_custkey % 90) ELSE 'Notice' END
  WHEN 2 THEN CASE o_custkey % 5 WHEN 0 THEN concat('Normal Gazette ', 2000 + o_custkey % 25) WHEN 1 THEN concat('Normal Gazette No.', o_custkey % 9, ' to 24 of 2024') WHEN 2 THEN concat(1 + o_custkey % 9, '. NG. part-IV, 2024')
    WHEN 3 THEN concat('NG No.', 1 + o_custkey % 9, ', 2024') ELSE 'NG' END
  WHEN 3 THEN concat('The Gazette No. ', o_custkey % 52, ' dated ', 1 + o_custkey % 28, 'th Jan., 2017')
  WHEN 4 THEN CASE o_custkey % 2 WHEN 0 THEN concat('Gazette ', 1 + o_custkey % 28, 'th October, 2023') ELSE concat('October ', 1 + o_custkey % 28, ', 2023') END
  WHEN 5 THEN concat('0', 1 + o_custkey % 9, '-03-21-IX.pdf')
  WHEN 6 THEN concat('Issue Number: ', o_custkey % 90, ', Part: I-B, Gazette Page: ', o_custkey % 300)
  WHEN 7 THEN concat('Issue Number: ', o_custkey % 90, ' Part: II-A Gazette Page: 12b, Volume: XV Number: ', o_custkey % 300)
  ELSE CASE o_custkey % 2 WHEN 0 THEN 'No. 31 Dated 31-06-19' ELSE 'No. 445 E-544089-52 01-10-24' END END"""
_DAY = "CASE WHEN o_custkey % 8 > 1 THEN DATE '2023-07-04' END"


def _values(rows, columns: str) -> str:
    one = lambda x: "NULL" if x is None else str(x) if isinstance(x, int) else f"'{x}'"
    return "(VALUES " + ", ".join(f"({', '.join(map(one, r))})" for r in rows) + f") t({columns})"


_RULES = _values([r[:4] for r in title_rules.GRAMMARS], "source, part, turn, pattern")
_FIELDS = _values([(*r[:3], k, v.replace("$", "\\")) for r in title_rules.GRAMMARS for k, v in r[4].items()], "source, part, turn, field, template")
_CORRECTIONS = _values([(*c[:3], k, v) for c in title_rules.CORRECTIONS for k, v in c[3].items()], "source, title, day, field, val")
_ASKED = [f for f in title_rules.FIELDS if f not in ("year", "month", "day_of_month")]
_MONTHS = "['jan', 'feb', 'mar', 'apr', 'may', 'jun', 'jul', 'aug', 'sep', 'oct', 'nov', 'dec']"


@query(f"""WITH o AS (SELECT o_orderkey AS k, {_SOURCE} AS source, {_TITLE} AS title, {_DAY} AS day FROM orders),
m AS (SELECT k, source, part, turn, pattern, regexp_extract(title, pattern, 0) AS found, row_number() OVER (PARTITION BY k, part ORDER BY turn) AS n FROM o JOIN {_RULES} USING (source) WHERE regexp_matches(title, pattern)),
c AS (SELECT k, field, val, rank() OVER (PARTITION BY k ORDER BY c.day IS NULL) AS n FROM o JOIN {_CORRECTIONS.replace(") t(", ") c(")} ON o.source = c.source AND o.title = c.title AND (c.day IS NULL OR c.day = strftime(o.day, '%Y-%m-%d'))),
f AS (SELECT k, part, field, nullif(trim(regexp_replace(found, pattern, template)), '') AS val FROM m JOIN {_FIELDS} USING (source, part, turn) WHERE n = 1 AND k NOT IN (SELECT k FROM c) UNION ALL SELECT k, 1, field, val FROM c WHERE n = 1),
w AS (SELECT k, {", ".join(f"arg_min(val, part) FILTER (field = '{x}' AND val IS NOT NULL) AS {x}" for x in title_rules.FIELDS)} FROM f GROUP BY k)
SELECT o.k, {", ".join(_ASKED)}, try_cast(year || '-' || coalesce(nullif(list_position({_MONTHS}, lower(month[1:3])), 0)::VARCHAR, month) || '-' || day_of_month AS DATE) AS date FROM o LEFT JOIN w USING (k)""", days="date")
def titles_by_rules(spark, d):
    rows = table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.expr(_SOURCE).alias("source"), F.expr(_TITLE).alias("title"), F.expr(_DAY).alias("day"))
    read = title_rules.read_titles(rows, title_rules.rule_table(spark), title_rules.correction_table(spark))
    return read.select("k", *[F.try_element_at("said", F.lit(f)).alias(f) for f in _ASKED], "date")


def _declared(spark, d):
    """Files that declare the nations, each naming the one before it; every fifth begins anew."""
    before = F.when(F.col("n_nationkey") % 5 > 0, F.concat(F.lit(" of &n"), (F.col("n_nationkey") - 1).cast("string"), F.lit(";"))).otherwise(" &#xE9;&unknown;")
    one = F.concat(F.lit("<!-- <!ENTITY no 'x'> -->\n<!ENTITY n"), F.col("n_nationkey").cast("string"), F.lit(' "'), "n_name", before, F.lit('">\n<!ENTITY % p "x"> <!ENTITY again "&again;">'))
    return entities.declared(table(spark, d, "nation").select(one.alias("value")))


_RESOLVED = """r AS (SELECT n_nationkey AS n, n_name || ' é&unknown;' AS t FROM nation WHERE n_nationkey % 5 = 0
UNION ALL SELECT n_nationkey, n_name || ' of ' || t FROM r JOIN nation ON n_nationkey = n + 1 AND n_nationkey % 5 > 0)"""


@query(f"WITH RECURSIVE {_RESOLVED} SELECT 'n' || n AS name, t AS text FROM r")
def xml_entities(spark, d):
    # names that stand for themselves have no text
    found = entities.resolved(_declared(spark, d))
    return spark.createDataFrame(sorted(found.items()), "name string, text string")


@query(f"WITH RECURSIVE {_RESOLVED} SELECT o_orderkey AS k, replace(t, '&unknown;', '') || ' & ® <x> ' || o_orderpriority AS title FROM orders JOIN r ON n = o_custkey % 25 WHERE n % 5 > 0 OR true")
def xml_with_declared_entities(spark, d):
    known = entities.resolved(_declared(spark, d).unionByName(spark.createDataFrame([("unknown", "")], "name string, value string")))
    o = table(spark, d, "orders")
    xml = F.concat(F.lit("<code><name>&n"), (F.col("o_custkey") % 25).cast("string"), F.lit("; &amp; &reg; &lt;x&gt; "), "o_orderpriority", F.lit("</name></code>"))
    return containers.node_table(o.select(F.col("o_orderkey").alias("k"), xml.alias("xml")), "k", "xml", known).select(F.col("reg").alias("k"), "title")


_ACCENTED = "CASE n_nationkey % 5 WHEN 0 THEN concat('É', lower(n_name)) WHEN 1 THEN concat('e', lower(n_name)) WHEN 2 THEN concat('E', n_name) WHEN 3 THEN concat('ö-', n_name) ELSE concat('o', lower(n_name)) END"


@query(f"SELECT name, row_number() OVER (ORDER BY title COLLATE en, name) AS place, row_number() OVER (ORDER BY icu_sort_key(lower(title), 'root'), name) AS place_ci FROM (SELECT n_name AS name, {_ACCENTED} AS title FROM nation)")
def titles_in_language_order(spark, d):
    rows = table(spark, d, "nation").select(F.col("n_name").alias("name"), F.expr(_ACCENTED).alias("title"))
    place = lambda c: F.row_number().over(Window.orderBy(ordering.in_language("title", c), "name")).cast("long")
    return rows.select("name", place("UNICODE").alias("place"), place("UNICODE_CI").alias("place_ci"))  # 25 rows
