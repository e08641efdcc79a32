"""Grammars of titles as rows: patterns of a source, what their groups say, and corrections of single titles.

A rule is (source, part, turn, pattern, fields). The parts of a source are looked at on their own; in each
the first pattern by turn that is found in a title gives its fields their values, templates with $1 for the
first group. A correction (source, title, day, fields) comes before them where title, and the day if it
has one, are the same. Fields named year, month (a name or a number) and day_of_month make the date.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates
from ..session import checkpoint

#: Rules and corrections are broadcast up to so many rows of about 300 bytes, and joined by a shuffle beyond.
BROADCAST_RULES = 10_000

_DAY = "([0-9]+)\\s*(?:st|nd|rd|th)?\\s*"
#: The grammars of sources.
GRAMMARS = (
    ("lakshadweep", 1, 1, "(?i)vo[li][.,]\\s*(\\w+)\\.?\\s*no\\.\\s*([0-9]+(?:\\(\\w+\\))?)\\s*[,.]?\\s*[^0-9,]+,?\\s*" + _DAY + "(\\w+)[,.]?\\s*([0-9]+)",
     {"volume": "$1", "num": "$2", "day_of_month": "$3", "month": "$4", "year": "$5"}),
    ("dadranagarhaveli", 1, 1, "(?i)official\\s+gazette\\s*[:–—-]?\\s*series\\s*[–—-]*\\s*(.+)\\s+no\\s*\\.?\\s*([0-9]+)",
     {"series": "$1", "num": "$2", "kind": "Ordinary"}),
    ("dadranagarhaveli", 1, 2, "(?i)official\\s+gazette\\s*[:-]?\\s*extra\\s*ordinary\\s+(?:no)?\\s*[.:]?\\s*([0-9]+)",
     {"num": "$1", "kind": "Extraordinary"}),
    ("arunachal", 1, 1, "(?i)^(?:Complete)?\\s*Normal\\s+Gazette\\s*-?\\s*(?:of)?\\s*([0-9]{4})",
     {"part": "complete", "year": "$1"}),
    ("arunachal", 1, 2, "(?i)^Normal\\s+Gazette\\s*-?\\s*No\\s*\\.\\s*([0-9]+)\\s*to\\s*([0-9]+)\\s*of\\s*([0-9]{4})",
     {"part": "$1-$2", "year": "$3"}),
    ("arunachal", 1, 3, "(?i)^([0-9]+)\\s*\\.?\\s*(?:NG|(?:Normal|Noram|Norma)\\s+Gazette)\\s*\\.?-?\\s*(?:No)?\\s*[.-]?\\s*[0-9]*\\s*[,.]?\\s*(?:part\\s*-?\\s*([0-9ivxlcdm]+))?\\s*,?\\s*(?:of)?\\s*([0-9]{4})?",
     {"num": "$1", "part": "$2", "year": "$3"}),
    ("arunachal", 1, 4, "(?i)^(?:NG|(?:Normal|Noram|Norma)\\s+Gazette)\\s*\\.?-?\\s*(?:No)?\\s*[.-]?\\s*([0-9]+)?\\s*[,.]?\\s*(?:part\\s*-?\\s*([0-9ivxlcdm]+))?\\s*,?\\s*(?:of)?\\s*([0-9]{4})?",
     {"num": "$1", "part": "$2", "year": "$3"}),
    ("jammuandkashmir", 1, 1, "Gazette\\s+No\\.?\\s*([0-9]+)\\s+dated\\s+" + _DAY + "(\\w+)[ .,]*([0-9]+)",
     {"num": "$1", "day_of_month": "$2", "month": "$3", "year": "$4"}),
    ("nagaland", 1, 1, "([0-9]+)\\s*(?:th|st|nd)?\\s*(?:th|st|nd)?\\s*([a-zA-Z]+)\\s*,?\\s*([0-9]+)",
     {"day_of_month": "$1", "month": "$2", "year": "$3"}),
    ("nagaland", 1, 2, "([a-zA-Z]+)\\s*([0-9]+)\\s*(?:th|st)?\\s*,?\\s*([0-9]+)",
     {"month": "$1", "day_of_month": "$2", "year": "$3"}),
    ("meghalaya", 1, 1, "(?i)^([0-9]{2})-([0-9]{2})-([0-9]{2})-(\\w+)\\.pdf$",
     {"day_of_month": "$1", "month": "$2", "year": "20$3", "part": "$4"}),
    ("stgeorge", 1, 1, "Issue\\s+Number:\\s*([0-9]+)",
     {"issue": "$1"}),
    ("stgeorge", 2, 1, "Part:\\s*([^,]+),",
     {"part": "$1"}),
    ("stgeorge", 3, 1, "Gazette\\s+Page:\\s*([0-9]+)",
     {"page": "$1"}),
    ("keralalibrary", 1, 1, "Issue\\s+Number:\\s*([0-9]+)",
     {"issue": "$1"}),
    ("keralalibrary", 2, 1, "Part:\\s*(.+?),?\\s*Gazette\\s+Page:\\s*(\\w+),",
     {"part": "$1", "page": "$2"}),
    ("keralalibrary", 3, 1, "Volume:?\\s*(\\w*)\\s*Number:\\s*([0-9]+)",
     {"volume": "$1", "num": "$2"}),
)
#: Corrections of single titles.
CORRECTIONS = (
    ("lakshadweep", "LVIII No.73", "2023-07-04", {"volume": "LVIII", "num": "73", "day_of_month": "10", "month": "2", "year": "2023"}),
    ("lakshadweep", "Vol LVIII No.72", "2023-07-04", {"volume": "LVIII", "num": "72", "day_of_month": "7", "month": "2", "year": "2023"}),
    ("assam", "No. 31 Dated 31-06-19", None, {"day_of_month": "31", "month": "7", "year": "2019"}),
    ("assam", "No. 126 ELE.144-2015-712 01-04-17", None, {"day_of_month": "1", "month": "4", "year": "2017"}),
    ("assam", "No. 445 E-544089-52 01-10-24", None, {"day_of_month": "1", "month": "10", "year": "2024"}),
    ("assam", "No. 538 RLA 92-2021-77 Dated 77-11-21", None, {"day_of_month": "17", "month": "11", "year": "2021"}),
)
FIELDS = ("volume", "num", "series", "kind", "part", "issue", "page", "year", "month", "day_of_month")


def rule_table(spark, rows=GRAMMARS) -> DataFrame:
    return spark.createDataFrame(list(rows), "source string, part int, turn int, pattern string, fields map<string,string>")


def correction_table(spark, rows=CORRECTIONS) -> DataFrame:
    return spark.createDataFrame(list(rows), "source string, title string, day string, fields map<string,string>")


def _near(table: DataFrame) -> DataFrame:
    table = checkpoint(table)
    return F.broadcast(table) if table.count() <= BROADCAST_RULES else table


def _some(fields: Column) -> Column:
    """The fields that have a value."""
    return F.map_filter(F.transform_values(fields, lambda k, v: F.trim(v)), lambda k, v: v != "")


def read_titles(titles: DataFrame, rules: DataFrame, corrections: DataFrame | None = None) -> DataFrame:
    """titles (source, title, day, ...) with said, a map of fields, and date.

    A source's rules come as one array in one join, so a row is neither multiplied nor shuffled. said is empty
    where no rule fits; a title that is corrected gives what the correction says alone.
    """
    listed = rules.groupBy(F.col("source").alias("__source")).agg(
        F.sort_array(F.collect_list(F.struct("part", "turn", "pattern", F.map_entries("fields").alias("fields")))).alias("__rules")
    )
    rows = titles.join(_near(listed), F.col("source") == F.col("__source"), "left")
    fits = F.filter("__rules", lambda r: F.rlike("title", r["pattern"]))
    first = F.filter(fits, lambda r, i: (i == 0) | (r["part"] != F.get(fits, i - 1)["part"]))
    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))

    def filled(r):  # templates are filled on what the pattern has found alone, so that text around it is no part of a value
        found = F.call_function("regexp_extract", F.col("title"), r["pattern"], F.lit(0))
        return _some(F.transform_values(F.map_from_entries(r["fields"]), lambda k, v: F.regexp_replace(found, r["pattern"], v)))

    whole = F.aggregate(first, none, lambda acc, r: F.map_concat(acc, F.map_filter(filled(r), lambda k, v: ~F.map_contains_key(acc, k))))
    rows = rows.withColumn("said", F.when(F.col("__rules").isNotNull(), whole))
    if corrections is not None:
        known = corrections.select(F.col("source").alias("__s"), F.col("title").alias("__t"), F.col("day").alias("__d"), _some(F.col("fields")).alias("__said"))
        # of a correction with the day and one without, the former
        same = (F.col("source") == F.col("__s")) & (F.col("title") == F.col("__t"))
        packed = known.groupBy("__s", "__t").agg(F.array_sort(F.collect_list(F.struct(F.col("__d").isNull().alias("any"), F.col("__d").alias("d"), F.array_sort(F.map_entries("__said")).alias("m")))).alias("__c"))
        rows = rows.join(_near(packed), same, "left")
        fitting = F.get(F.filter("__c", lambda c: c["any"] | (c["d"] == F.date_format("day", "yyyy-MM-dd"))), F.lit(0))
        rows = rows.withColumn("said", F.when(fitting.isNotNull(), F.map_from_entries(fitting["m"])).otherwise(F.col("said")))
    rows = rows.withColumn("said", F.coalesce("said", none))
    month = F.try_element_at("said", F.lit("month"))
    number = F.when(month.rlike("^[0-9]+$"), month).otherwise(dates.month_number(F.left(month, F.lit(3))).cast("string"))
    date = dates.date_of(F.try_element_at("said", F.lit("year")), number, F.try_element_at("said", F.lit("day_of_month")))
    return rows.withColumn("date", date).select(*titles.columns, "said", "date")
