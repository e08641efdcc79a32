"""Regulations as node tables: dispatch by rules, numbering, merging, references, dates.

A regulation is rows (reg, node, parent, tag, kind, num, title, version, text), node numbers in
document order. What a source's tag becomes is a table of rules, so a new source is new rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dates
from ..functions.text import squeeze, without_controls
from .windows import newest_versions, section_ids

#: What nodes of a kind become; an empty parent stands for any.
RULES = (
    ("", "division", "title", "title"), ("", "division", "subtitle", "subtitle"), ("", "division", "chapter", "chap"),
    ("", "division", "subchapter", "subchap"), ("", "division", "part", "part"), ("", "division", "subpart", "subpart"),
    ("", "division", "article", "article"), ("", "division", "section", "sec"), ("", "division", "subsection", "subsec"),
    ("chap", "division", "rule", "sec"), ("", "division", "rule", "rule"), ("", "para", "", "p"), ("", "subsect", "", "subsec"),
    ("", "list", "", "list"), ("", "item", "", "item"), ("", "table", "", "table"), ("", "codecitation", "", "ref"),
    ("", "code", "section", "sec"), ("", "code", "rule", "sec"), ("", "code", "rule2", "sec"), ("", "code", "division", "division"), ("", "code", "agency", "division"),
    ("", "code", "subagency", "division"), ("", "code", "series", "division"), ("", "code", "regulationno", "division"), ("", "code", "subtitle", "division"),
    ("", "code", "title", "division"), ("", "code", "sec2", "division"), ("", "code", "chapter", "chap"), ("", "code", "subchapter", "chap"), ("", "code", "part", "part"),
    ("", "code", "subpart", "part"), ("", "code", "regulation", "part"), ("", "code", "undesignated", "group"), ("", "code", "unprefixed", "group"), ("", "code", "group", "group"),
    ("", "code", "subgroup", "group"), ("", "code", "article", "article"), ("", "code", "subarticle", "article"), ("", "code", "appendix", "appendix"),
    ("", "number", "", "num"), ("", "name", "", "heading"), ("", "content", "", "content"), ("", "bold", "", "b"), ("", "italic", "", "i"), ("", "underscore", "", "u"),
    ("", "superscript", "", "sup"), ("", "subscript", "", "sub"), ("", "strike", "", "del"), ("", "del", "", "del"), ("", "add", "", "remark"), ("", "linebreak", "", "br"),
    ("", "ulink", "", "a"), ("", "regcitation", "", "a"), ("", "actcitation", "", "span"), ("", "codesec", "", "ref"), ("", "footnoteref", "", "ref"), ("", "primaryidcodenumber", "", "ref"),
    ("", "note", "", "note"), ("", "notes-footnotes", "", "note"), ("", "notes-maint", "", "p"), ("", "reviewdates", "", "p"), ("", "effectivedate", "", "date"),
    ("", "expirationdate", "", "date"), ("", "reviewdate", "", "date"), ("", "operationaldate", "", "date"), ("", "itemizedlist", "", "list"), ("", "listitem", "", "item"),
    ("", "li", "", "item"), ("", "thead", "", "thead"), ("", "tbody", "", "tbody"), ("", "tr", "", "tr"), ("", "th", "", "th"), ("", "td", "", "td"),
)
IMAGES = ("jpg", "jpeg", "png", "gif", "bmp", "tif", "tiff")


def rule_table(spark, rules=RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "parent_as string, tag string, kind string, becomes string")


def dispatched(nodes: DataFrame, rules: DataFrame) -> DataFrame:
    """nodes with becomes: by (parent, tag, kind), the rule for the parent before that for any; null if none fits."""
    general = rules.where("parent_as = ''").select(F.col("tag").alias("g_tag"), F.col("kind").alias("g_kind"), F.col("becomes").alias("g"))
    kind = F.lower(F.coalesce("kind", F.lit("")))
    rows = nodes.join(general, (F.lower("tag") == F.col("g_tag")) & (kind == F.col("g_kind")), "left").drop("g_tag", "g_kind")
    parents = rows.select(F.col("reg").alias("p_reg"), F.col("node").alias("p_node"), F.col("g").alias("p_as"))
    rows = rows.join(parents, (F.col("reg") == F.col("p_reg")) & (F.col("parent") == F.col("p_node")), "left").drop("p_reg", "p_node")
    special = rules.where("parent_as <> ''").select("parent_as", F.col("tag").alias("s_tag"), F.col("kind").alias("s_kind"), F.col("becomes").alias("s"))
    joined = rows.join(special, (F.col("p_as") == F.col("parent_as")) & (F.lower("tag") == F.col("s_tag")) & (kind == F.col("s_kind")), "left")
    return joined.select(*nodes.columns, F.coalesce("s", "g").alias("becomes"))


def rules_as_groups(nodes: DataFrame) -> DataFrame:
    """Dispatched nodes, rules under a chapter being groups where they hold articles or sections."""
    holders = nodes.where(F.lower("kind").isin("article", "section")).select("reg", F.col("parent").alias("node")).distinct().withColumn("__h", F.lit(True))
    joined = nodes.join(holders, ["reg", "node"], "left")
    becomes = F.when((F.lower("kind") == "rule") & F.col("__h"), "group").otherwise(F.col("becomes"))
    return joined.withColumn("becomes", becomes).select(*nodes.columns)


def live_sections(nodes: DataFrame) -> DataFrame:
    """Nodes but sections whose name begins with rescind, in brackets or not."""
    return nodes.where(~F.coalesce((F.col("becomes") == "sec") & F.lower(F.trim("title")).rlike("^\\[?rescind"), F.lit(False)))


def identified(nodes: DataFrame) -> DataFrame:
    """Dispatched nodes with eid, counted by what they become, in document order."""
    return section_ids(nodes.withColumn("tag", F.col("becomes")))


def regulation_key(number: Column, title: Column) -> Column:
    """The number, or the title as a slug."""
    clean = squeeze(number)
    return F.when(clean != "", clean).otherwise(F.regexp_replace(F.lower(squeeze(title)), "[^a-z0-9]+", "-"))


def normal_number(num: Column) -> Column:
    return squeeze(num)


def merged_regulations(parts: DataFrame) -> DataFrame:
    """parts (key, subnum, seq, num, ...) without sections that an earlier part of the regulation has.

    Parts come in the order of their sub-number, those without one last. Equal numbers within one
    part stay, and so do sections without a number.
    """
    num = normal_number(F.col("num"))
    part = F.coalesce("subnum", F.lit(2**31 - 1))
    first = F.min(part).over(Window.partitionBy("key", num))
    return parts.withColumn("__first", first).where((part == F.col("__first")) | F.col("num").isNull()).drop("__first")


#: States by what their citations go by: the use attribute, that or else the text, or a text to be cleaned of controls.
CITED_BY_USE = ("MI", "GA", "ID", "LA", "ME", "MS", "NE", "RI", "WY")
CITED_BY_USE_OR_TEXT = ("WI", "SC", "CO", "DE")
CITED_WITHOUT_CONTROLS = ("MO",)
#: The states whose codes have titles, which their references carry.
TITLE_STATES = (
    "AK", "AL", "AR", "AZ", "CA", "CO", "CT", "DE", "GA", "HI", "IA", "ID", "IL", "IN", "KS", "KY", "LA", "MA", "MD", "ME", "MN", "MO", "MS", "MT", "NC", "ND", "NE",
    "NH", "NJ", "NM", "NV", "NY", "OH", "OK", "OR", "PA", "RI", "SC", "SD", "TN", "TX", "UT", "VA", "VT", "WA", "WI", "WV", "WY",
)


def citations(refs: DataFrame) -> DataFrame:
    """refs (state, title, use, text, ...) with cited_use and cited_title, what the reference of a citation is looked up by.

    A number of NE holds its title before a hyphen; WI's references go without theirs.
    """
    empty = lambda c: F.when(c != "", c)
    state, use, text = F.col("state"), F.col("use"), F.col("text")
    number = (
        F.when(state.isin(*CITED_BY_USE), use).when(state.isin(*CITED_BY_USE_OR_TEXT), F.coalesce(empty(use), text))
        .when(state.isin(*CITED_WITHOUT_CONTROLS), without_controls(text)).otherwise(text)
    )
    split = (state == "NE") & number.rlike("[0-9]+-.")
    title = F.when(split, F.regexp_extract(number, "([0-9]+)-(.+)", 1)).when(state.isin(*TITLE_STATES) & (state != "WI"), empty(F.col("title")))
    return refs.withColumn("cited_use", empty(F.when(split, F.regexp_extract(number, "([0-9]+)-(.+)", 2)).otherwise(number))).withColumn("cited_title", title)


def linked_citations(cited: DataFrame) -> DataFrame:
    """Citations (datatype, state, own_state, title) that become references: those of the own state's code, in CA, PA and NY only with a title."""
    titled = ~F.col("state").isin("CA", "PA", "NY") | F.col("title").isNotNull()
    return cited.where((F.col("datatype") == "D") & titled & (F.col("state") == F.col("own_state")))


#: The states by code, with the name of the locality and the year their regulations begin.
STATES = (
    ("AL", "alabama", 1981),
    ("AK", "alaska", 1959),
    ("AZ", "arizona", 1952),
    ("AR", "arkansas", 1967),
    ("CA", "california", 1947),
    ("CO", "colorado", 1959),
    ("CT", "connecticut", 1945),
    ("DE", "delaware", 1960),
    ("FL", "florida", 1961),
    ("GA", "georgia", 1964),
    ("HI", "hawaii", 1961),
    ("ID", "idaho", 1965),
    ("IL", "illinois", 1975),
    ("IN", "indiana", 1986),
    ("IA", "iowa", 1975),
    ("KS", "kansas", 1984),
    ("KY", "kentucky", 1984),
    ("LA", "louisiana", 1966),
    ("ME", "maine", 1961),
    ("MD", "maryland", 1957),
    ("MA", "massachusetts", 1954),
    ("MI", "michigan", 1943),
    ("MN", "minnesota", 1946),
    ("MS", "mississippi", 1976),
    ("MO", "missouri", 1945),
    ("MT", "montana", 1971),
    ("NE", "nebraska", 1945),
    ("NV", "nevada", 1965),
    ("NH", "newhampshire", 1973),
    ("NJ", "newjersey", 1968),
    ("NM", "newmexico", 1969),
    ("NY", "newyork", 1975),
    ("NC", "northcarolina", 1973),
    ("ND", "northdakota", 1941),
    ("OH", "ohio", 1943),
    ("OK", "oklahoma", 1963),
    ("OR", "oregon", 1957),
    ("PA", "pennsylvania", 1945),
    ("RI", "rhodeisland", 1956),
    ("SC", "southcarolina", 1977),
    ("SD", "southdakota", 1966),
    ("TN", "tennessee", 1974),
    ("TX", "texas", 1975),
    ("UT", "utah", 1973),
    ("VT", "vermont", 1967),
    ("VA", "virginia", 1975),
    ("WA", "washington", 1959),
    ("WV", "westvirginia", 1964),
    ("WI", "wisconsin", 1943),
    ("WY", "wyoming", 1957),
)


def states(spark) -> DataFrame:
    """(state, locality, start_year, titled): the states and whether their references carry a title."""
    rows = spark.createDataFrame(list(STATES), "state string, locality string, start_year int")
    return rows.withColumn("titled", F.col("state").isin(*TITLE_STATES))


def reference_index(refs: DataFrame) -> DataFrame:
    """(title, num, uri, eid): numbers and titles normalised, the newest version of each."""
    clean = refs.withColumn("num", normal_number(F.col("num"))).withColumn("title", F.lower(F.coalesce(squeeze(F.col("title")), F.lit(""))))
    return newest_versions(clean).select("title", "num", "uri", "eid")


def resolved(refs: DataFrame, index: DataFrame) -> DataFrame:
    """refs (own_uri, title, num, ...) with href: #eid within the same document, uri#eid elsewhere, null if unknown."""
    names = index.select(F.col("title").alias("i_title"), F.col("num").alias("i_num"), "uri", "eid")
    on = (F.lower(F.coalesce(squeeze(F.col("title")), F.lit(""))) == F.col("i_title")) & (normal_number(F.col("num")) == F.col("i_num"))
    local = F.concat(F.lit("#"), F.col("eid"))
    href = F.when(F.col("uri") == F.col("own_uri"), local).otherwise(F.concat(F.col("uri"), F.when(F.col("eid").isNotNull(), local).otherwise("")))
    return refs.join(names, on, "left").select(*refs.columns, href.alias("href"))


def resolution_counts(found: DataFrame) -> DataFrame:
    return found.agg(F.count_if(F.col("href").isNotNull()).alias("resolved"), F.count_if(F.col("href").isNull()).alias("unresolved"))


def frbr(country: Column, locality: Column, kind: Column, year: Column, number: Column, lang: str = "eng", version: Column | None = None) -> Column:
    """A struct of work, expression and manifestation addresses."""
    place = F.concat_ws("-", country, locality)
    work = F.concat(F.lit("/akn/"), place, F.lit("/act/"), kind, F.lit("/"), year.cast("string"), F.lit("/"), number)
    at = F.lit("") if version is None else F.concat(F.lit("@"), F.coalesce(version, F.lit("")))
    expression = F.concat(work, F.lit(f"/{lang}"), at)
    return F.struct(work.alias("work"), expression.alias("expression"), F.concat(expression, F.lit(".xml")).alias("manifestation"))


def role_dates(nodes: DataFrame) -> DataFrame:
    """(reg, role, date): dates as they stand of nodes whose kind names a role."""
    roles = ("effective", "review", "expiration", "operational")
    role = F.regexp_extract(F.lower(F.coalesce("kind", F.lit(""))), f"({'|'.join(roles)})", 1)
    return nodes.select("reg", role.alias("role"), dates.unpadded(F.col("text")).alias("date")).where("role <> '' AND date IS NOT NULL")


def publish_date(nodes: DataFrame) -> DataFrame:
    """(reg, date): the first date that a currency note of the regulation holds."""
    noted = nodes.where(F.lower("tag") == "currency").select("reg", "node", dates.any_date(F.col("text")).alias("date")).where("date IS NOT NULL")
    return noted.groupBy("reg").agg(F.min_by("date", "node").alias("date"))


def file_links(nodes: DataFrame) -> DataFrame:
    """(reg, node, element, href) of file links: img for pictures, a for the rest."""
    ext = F.lower(F.regexp_extract("text", "\\.([A-Za-z0-9]+)$", 1))
    links = nodes.where(F.lower("tag") == "filelink")
    return links.select("reg", "node", F.when(ext.isin(*IMAGES), "img").otherwise("a").alias("element"), F.col("text").alias("href"))


def lines_of_pre(nodes: DataFrame) -> DataFrame:
    """(reg, node, line, text): preformatted text as one paragraph a line."""
    pre = nodes.where(F.lower("tag") == "pre")
    return pre.select("reg", "node", F.posexplode(F.split("text", "\n")).alias("line", "text"))


def number_tokens(text: Column) -> Column:
    """Section numbers such as 12-3.4(a) in a heading, in order."""
    return F.regexp_extract_all(text, F.lit("([0-9]+[A-Za-z]?(?:[.:-][0-9A-Za-z]+)*(?:\\([0-9A-Za-z]+\\))*)"), 1)


#: What a number of a regulation is made of, in the states where it is not just letters, digits and underscores.
NUMBER_MARKS = {"OH": "[\\w:]+", "NH": "[\\w-]+", "WI": "[\\w-]+", "ND": "[\\w.]+"}


def regulation_number(state: Column, text: Column) -> Column:
    """A struct of regnum and subnum: the first number of a heading and the digits that the next one begins with.

    An R before the first number is passed over; ID's numbers are the whole text, MA's have no second one.
    """
    found = F.when(state == "ID", F.array(text))
    for code, pattern in NUMBER_MARKS.items():
        found = found.when(state == code, F.regexp_extract_all(text, F.lit(f"(?U)({pattern})"), 1))
    found = found.otherwise(F.regexp_extract_all(text, F.lit("(?U)(\\w+)"), 1))
    first = F.when(F.get(found, 0) == "R", 1).otherwise(0)
    second = F.when((state != "MA") | (first == 1), F.get(found, first + 1))
    digits = F.regexp_extract(second, "^[0-9]+", 0)
    return F.struct(F.lower(F.get(found, first)).alias("regnum"), F.when(digits != "", digits).try_cast("int").alias("subnum"))


def new_works(candidates: DataFrame, stored: DataFrame) -> DataFrame:
    """Candidates (work, date, lang, ...) that the store does not have in that version and language."""
    return candidates.join(stored.select("work", "date", "lang").distinct(), ["work", "date", "lang"], "left_anti")
