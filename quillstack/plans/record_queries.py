"""Queries on records: fields, names, links and texts, each with the same result as SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, text
from ..operators import extract, facets, filters, sets, windows
from .archive_queries import query, table


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 2 = 0")
def suffix_is_the_date(spark, d):
    o = table(spark, d, "orders")
    day = F.when(F.col("o_orderkey") % 2 == 0, F.to_date("o_orderdate")).otherwise(F.date_sub(F.to_date("o_orderdate"), 1))
    rows = o.withColumn("gazetteid", F.concat(F.lit("CG-"), F.date_format("o_orderdate", "dd/MM/yyyy")))
    return rows.where(filters.ends_with_date(F.col("gazetteid"), day)).select("o_orderkey")


def _record(spark, d):
    e = table(spark, d, "events")
    k = F.try_variant_get(F.parse_json("props"), "$.k", "string")
    return e.select("event_id", F.when(F.length(k) > 1, k).alias("subject"), F.when(F.col("value") > 20, F.col("event_type")).alias("gznum"))


_RECORD = "(SELECT event_id, CASE WHEN length(json_extract_string(props, '$.k')) > 1 THEN json_extract_string(props, '$.k') END AS subject, CASE WHEN value > 20 THEN event_type END AS gznum FROM events)"


@query(f"SELECT * FROM {_RECORD} WHERE subject IS NOT NULL AND gznum IS NOT NULL")
def required_fields(spark, d):
    return filters.complete(_record(spark, d), ["subject", "gznum"])[0]


@query(f"SELECT event_id, array_to_string([CASE WHEN subject IS NULL THEN 'subject' END, CASE WHEN gznum IS NULL THEN 'gznum' END], ',') AS missing FROM {_RECORD} WHERE subject IS NULL OR gznum IS NULL")
def rejected_records(spark, d):
    return filters.complete(_record(spark, d), ["subject", "gznum"])[1].select("event_id", F.array_join("missing", ",").alias("missing"))


@query("SELECT p_partkey, p_type FROM part WHERE NOT (p_brand IN ('Brand#11', 'Brand#12') OR regexp_matches(p_type, '^[A-M]'))")
def denied_values(spark, d):
    rows = table(spark, d, "part")
    return filters.deny(filters.deny(rows, "p_brand", ["Brand#11", "Brand#12"]), "p_type", pattern="^[A-M]").select("p_partkey", "p_type")


@query("SELECT doc_id, CASE WHEN toxic = 1 THEN 'flagged' ELSE source END AS source FROM documents LEFT JOIN labels USING (doc_id)")
def overridden_values(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "source")
    fixed = table(spark, d, "labels").where("toxic = 1").select("doc_id", F.lit("flagged").alias("source"))
    return filters.override(docs, fixed, "doc_id", ["source"])


@query("SELECT page_id, CASE WHEN regexp_matches(u, '^[A-Za-z0-9._-]+(/[A-Za-z0-9._-]+)+$') AND length(u) <= 512 THEN u END AS relurl FROM (SELECT page_id, trim(regexp_replace(url, '^[a-z]+://', ''), '/') AS u FROM pages)")
def valid_relative_urls(spark, d):
    return table(spark, d, "pages").select("page_id", filters.valid_relurl(F.regexp_replace("url", "^[a-z]+://", "")).alias("relurl"))


@query("SELECT page_id, length(html) > 5000 AS large, regexp_matches(url, '(?i)[.]html$') AS safe FROM pages")
def large_and_safe_files(spark, d):
    ext = F.regexp_extract("url", "\\.([A-Za-z0-9]+)$", 1)
    return table(spark, d, "pages").select("page_id", filters.large_enough(F.length("html"), 5000).alias("large"), filters.safe_extension(ext, ["HTML", "pdf"]).alias("safe"))


@query("SELECT l_orderkey, l_linenumber, 'Return Flag=' || l_returnflag || ';Ship Date=' || strftime(l_shipdate, '%Y') AS rest FROM lineitem")
def residual_metadata(spark, d):
    meta = F.create_map(
        F.lit("ship_date"), F.date_format("l_shipdate", "yyyy"), F.lit("return_flag"), F.col("l_returnflag"), F.lit("title"), F.col("l_linestatus"), F.lit("none"), F.lit("")
    )
    rest = F.transform(filters.residual(meta, ["title"]), lambda x: F.concat_ws("=", x["label"], x["value"]))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.array_join(rest, ";").alias("rest"))


@query("SELECT doc_id FROM documents WHERE source IN (SELECT DISTINCT source FROM documents JOIN labels USING (doc_id) WHERE quality = 0)")
def known_source_rows(spark, d):
    docs = table(spark, d, "documents")
    known = docs.join(table(spark, d, "labels").where("quality = 0"), "doc_id").select(F.col("source").alias("name"))
    return filters.known_sources(docs, known).select("doc_id")


@query("SELECT n_name, n_regionkey = 1 OR n_regionkey IS NULL OR n_regionkey > 2 AS enabled FROM nation WHERE n_regionkey = 1 OR n_regionkey > 2")
def enabled_source_rows(spark, d):
    flag = F.when(F.col("n_regionkey") == 1, F.lit(None).cast("boolean")).otherwise(F.col("n_regionkey") > 2)
    out = filters.enabled_sources(table(spark, d, "nation").withColumn("enabled", flag))
    return out.select("n_name", F.coalesce("enabled", F.lit(True)).alias("enabled"))


@query("SELECT c_custkey, c_name AS name, c_mktsegment AS segment FROM customer")
def header_driven_columns(spark, d):
    # pages differ in the order, number and wording of their columns
    name, segment, kind = F.col("c_name"), F.concat(F.lit(" "), F.col("c_mktsegment")), F.col("c_custkey") % 3
    row = lambda *cells: F.array(*[F.struct(F.lit(h).alias("h"), (F.lit(c) if isinstance(c, str) else c).alias("c")) for h, c in cells])
    page = F.when(kind == 0, row(("Sr. No.", "1"), ("Name of Firm", name), ("Market Segment", segment), ("Other", "x")))
    page = page.when(kind == 1, row((" SEGMENT ", segment), ("Firm name", name))).otherwise(row(("No", "2"), ("Segment", segment), ("Of", "y"), ("Name", name), ("End", "z")))
    order = extract.header_order(F.transform(page, lambda x: x["h"]), {"name": "name", "segment": "segment"})
    cells = F.transform(page, lambda x: x["c"])
    return table(spark, d, "customer").select("c_custkey", extract.assigned(order, cells).alias("m")).select("c_custkey", F.col("m")["name"].alias("name"), F.col("m")["segment"].alias("segment"))


@query("SELECT conv_id, arg_min(turn, -n * 1000 + turn) AS turn FROM (SELECT conv_id, turn, length(text) // 100 AS n FROM conversations) GROUP BY conv_id")
def largest_leaf_table(spark, d):
    c = table(spark, d, "conversations")
    rows = c.select("conv_id", F.col("turn").alias("idx"), F.floor(F.length("text") / 100).alias("n_rows"), F.lit(True).alias("leaf"))
    return extract.largest_table(rows, "conv_id").select("conv_id", F.col("idx").alias("turn"))


@query("SELECT conv_id, 'p' || (min(turn) + 1) AS href FROM conversations GROUP BY conv_id HAVING count(*) > 1")
def next_page_link(spark, d):
    c = table(spark, d, "conversations")
    first = c.groupBy("conv_id").agg(F.min("turn").alias("now"))
    links = c.join(first, "conv_id").select("conv_id", F.col("turn").alias("idx"), F.col("turn").cast("string").alias("text"), F.concat(F.lit("p"), F.col("turn").cast("string")).alias("href"), "now")
    return extract.next_page(links, "conv_id", "now")


@query("SELECT source AS name, count(*) AS a, count(*) FILTER (doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)) AS b FROM documents GROUP BY source")
def merged_count_lists(spark, d):
    docs = table(spark, d, "documents")
    toxic = docs.join(table(spark, d, "labels").where("toxic = 1"), "doc_id")
    count = lambda x: x.groupBy(F.col("source").alias("name")).agg(F.count(F.lit(1)).alias("n"))
    return facets.merged_counts(count(docs), count(toxic))


@query("SELECT doc_id AS id, lang AS a, NULL AS b FROM documents UNION ALL SELECT page_id, NULL, url FROM pages")
def union_of_pages(spark, d):
    one = table(spark, d, "documents").select(F.col("doc_id").alias("id"), F.col("lang").alias("a"))
    return sets.union_pages(one, table(spark, d, "pages").select(F.col("page_id").alias("id"), F.col("url").alias("b")))


@query("SELECT strftime(o_orderdate, '%Y-%m-%d') AS date, string_agg(o_orderkey, ',' ORDER BY o_orderkey) AS hrefs FROM orders GROUP BY 1")
def links_grouped_by_date(spark, d):
    o = table(spark, d, "orders").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), F.col("o_orderkey").alias("idx"), F.col("o_orderkey").cast("string").alias("href"))
    return extract.links_by_date(o).select("date", F.array_join("hrefs", ",").alias("hrefs"))


@query("""WITH r AS (SELECT conv_id, turn, CASE WHEN turn % 4 = 0 THEN turn END AS part, CASE WHEN turn % 4 = 1 THEN role END AS dept FROM conversations),
p AS (SELECT *, count(part) OVER (PARTITION BY conv_id ORDER BY turn) AS n FROM r)
SELECT conv_id, turn, last_value(part IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn) AS part_now,
last_value(dept IGNORE NULLS) OVER (PARTITION BY conv_id, n ORDER BY turn) AS dept_now FROM p""")
def carried_sections(spark, d):
    c = table(spark, d, "conversations").select(
        "conv_id", "turn", F.when(F.col("turn") % 4 == 0, F.col("turn")).alias("part"), F.when(F.col("turn") % 4 == 1, F.col("role")).alias("dept")
    )
    return windows.section_rows(c, ["conv_id"], ["turn"], "part", "dept").select("conv_id", "turn", "part_now", "dept_now")


@query("SELECT p_partkey, regexp_replace(replace(lower(trim(p_name)), '/', '_'), '\\s+', '-', 'g') AS slug, split_part(p_type, ' ', 1) AS kind, nullif(split_part(p_type, ' ', 2), '') AS sub FROM part")
def slugs_and_parts(spark, d):
    parts = text.split_parts(F.replace("p_type", F.lit(" "), F.lit("/")), ["kind", "sub"])
    return table(spark, d, "part").select("p_partkey", text.slug(F.col("p_name")).alias("slug"), parts.alias("x")).select("p_partkey", "slug", "x.kind", "x.sub")


@query("""SELECT o_orderkey, o_orderpriority || ', ' || strftime(o_orderdate, '%d %B %Y') || CASE WHEN o_orderkey % 3 = 0 THEN ', Part ' || o_custkey ELSE '' END || ', Number ' || o_orderkey AS title,
lpad(CAST(o_orderkey % 50 AS VARCHAR), 3, '0') AS page FROM orders""")
def published_titles(spark, d):
    key = F.col("o_orderkey")
    part = F.when(key % 3 == 0, F.col("o_custkey").cast("string"))
    title = text.published_title(F.col("o_orderpriority"), F.col("o_orderdate"), F.lit(None).cast("string"), part, key.cast("string"))
    return table(spark, d, "orders").select("o_orderkey", title.alias("title"), text.padded_page(key % 50, F.lit(120)).alias("page"))


@query("SELECT doc_id, CASE lang WHEN 'fr' THEN 'French' WHEN 'it' THEN 'Italian' ELSE upper(lang) END AS name FROM documents")
def language_labels(spark, d):
    codes = F.when(F.col("lang") == "fr", "fre").otherwise(F.col("lang"))
    return table(spark, d, "documents").select("doc_id", F.array_join(text.language_names(F.array(codes)), ",").alias("name"))


@query("SELECT event_id, strftime(ts::TIMESTAMP, '%Y-%m-%d') AS day, strftime(ts::TIMESTAMP, '%d-%b-%Y') AS dashed FROM events")
def epoch_dates(spark, d):
    e = table(spark, d, "events")
    return e.select("event_id", F.date_format(dates.from_millis(F.unix_millis(F.col("ts").cast("timestamp"))), "yyyy-MM-dd").alias("day"), dates.dashed(F.col("ts")).alias("dashed"))


@query("SELECT doc_id, count(*) AS lines FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) WHERE regexp_matches(line, '[.?!:;][\"'')\\]]*$') GROUP BY doc_id")
def sentence_lines(spark, d):
    lines = table(spark, d, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    ends = F.rtrim("line").rlike("[.?!:;][\"')\\]]*$")
    return lines.where(ends).groupBy("doc_id").agg(F.count(F.lit(1)).alias("lines"))
