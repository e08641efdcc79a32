"""Dates in titles, addresses and metadata, as expressions over columns; unreadable ones are null."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Month names, and the misspellings that sources are known to use.
MONTHS = "january february march april may june july august september october november december".split()
MISSPELT = {"frbruary": 2, "februay": 2}


def month_number(name: Column) -> Column:
    """1 to 12 for a full or three-letter English name in any case; null for anything else."""
    key = F.lower(F.trim(name))
    table = {**{m: i for i, m in enumerate(MONTHS, 1)}, **{m[:3]: i for i, m in enumerate(MONTHS, 1)}, "sept": 9, **MISSPELT}
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), key)


def month_index(name: Column, names: list[str]) -> Column:
    """The place of a name in a list from 0, or -1."""
    return (F.array_position(F.array(*[F.lit(n) for n in names]), name) - 1).cast("int")


def date_of(year: Column, month: Column, day: Column) -> Column:
    """A date from text or number parts, null if there is no such day."""
    text = F.format_string("%04d-%02d-%02d", year.try_cast("int"), month.try_cast("int"), day.try_cast("int"))
    return F.when(year.isNotNull() & month.isNotNull() & day.isNotNull(), F.try_to_date(text, "yyyy-MM-dd"))


def _group(text: Column, pattern: str, n: int) -> Column:
    found = F.regexp_extract(text, pattern, n)
    return F.when(found != "", found)


def day_month_year(text: Column) -> Column:
    """Three runs of digits as day, month, year: 05-04-2018, 5/4/2018, 5.4.2018."""
    p = "([0-9]+)[^0-9]+([0-9]+)[^0-9]+([0-9]+)"
    return date_of(_group(text, p, 3), _group(text, p, 2), _group(text, p, 1))


def month_day_year(text: Column) -> Column:
    """US order: 10/3/2014, and October 3, 2014 or 3rd October 2014."""
    numeric = "^\\s*([0-9]{1,2})[/-]([0-9]{1,2})[/-]([0-9]{4})"
    named = "([A-Za-z]{3,9})\\.?\\s+([0-9]{1,2})(?:st|nd|rd|th)?,?\\s+([0-9]{4})"
    return F.coalesce(
        date_of(_group(text, numeric, 3), _group(text, numeric, 1), _group(text, numeric, 2)),
        date_of(_group(text, named, 3), month_number(F.regexp_extract(text, named, 1)), _group(text, named, 2)),
        ordinal_date(text),
        named_date(text),
    )


def named_date(text: Column) -> Column:
    """12 Apr 2024, 12-Apr-2024."""
    p = "([0-9]{1,2})[\\s-]+([A-Za-z]{3,9})[\\s.,-]+([0-9]{4})"
    return date_of(_group(text, p, 3), month_number(F.regexp_extract(text, p, 2)), _group(text, p, 1))


def ordinal_date(text: Column) -> Column:
    """12th April 2024; the ordinal ending is required."""
    p = "([0-9]{1,2})(?:st|nd|rd|th)\\s+([A-Za-z]{3,9})[\\s,]+([0-9]{4})"
    return date_of(_group(text, p, 3), month_number(F.regexp_extract(text, p, 2)), _group(text, p, 1))


def month_of_year(text: Column) -> Column:
    """April 2024 as its first day; a year of two digits is in this century."""
    p = "([A-Za-z]{3,9})[\\s,]+([0-9]{4}|[0-9]{2})\\b"
    year = _group(text, p, 2).try_cast("int")
    full = F.when(year < 100, year + 2000).otherwise(year)
    month = month_number(F.regexp_extract(text, p, 1))
    return F.when(month.isNotNull() & full.isNotNull(), F.make_date(full, month, F.lit(1)))


def any_date(text: Column) -> Column:
    return F.coalesce(month_day_year(text), ordinal_date(text), named_date(text), month_of_year(text))


def all_dates(text: Column) -> Column:
    """Every dd.mm.yyyy-like date of a title, in order."""
    found = F.regexp_extract_all(text, F.lit("([0-9]{1,2}[./-][0-9]{1,2}[./-][0-9]{4})"), 1)
    return F.filter(F.transform(found, day_month_year), lambda d: d.isNotNull())


def relurl_date(relurl: Column) -> Column:
    """The first yyyy-mm-dd anywhere in a relative url."""
    return F.try_to_date(_group(relurl, "([0-9]{4}-[0-9]{2}-[0-9]{2})", 1), "yyyy-MM-dd")


def year_in_text(text: Column) -> Column:
    """A year of the 1800s or 1900s, else one from 2000 to 2029."""
    return F.coalesce(_group(text, "(1[89][0-9]{2})", 1), _group(text, "(20[0-2][0-9])", 1)).try_cast("int")


def guarded_year(text: Column) -> Column:
    """A year made of digits only from 1600 to 2200."""
    clean = F.trim(text.cast("string"))
    year = F.when(clean.rlike("^[0-9]{1,9}$"), clean.try_cast("int"))
    return F.when(year.between(1600, 2200), year)


def first_year(*candidates: Column) -> Column:
    """The first candidate text that holds a year."""
    return F.coalesce(*[year_in_text(c) for c in candidates])


def unpadded(text: Column) -> Column:
    """m d y as y-m-d, as it stands."""
    p = "([0-9]+)[^0-9]+([0-9]+)[^0-9]+([0-9]+)"
    return F.when(text.rlike(p), F.concat_ws("-", *[F.regexp_extract(text, p, n) for n in (3, 1, 2)]))


def from_millis(ms: Column) -> Column:
    """Milliseconds since 1970 as a date of the session's time zone."""
    return F.to_date(F.timestamp_millis(ms.cast("long")))


def dashed(date: Column) -> Column:
    """18-Apr-2024."""
    return F.date_format(date, "dd-MMM-yyyy")


def joined(date: Column, sep: str = "-", reverse: bool = False) -> Column:
    """dd-mm-yyyy, or yyyy-mm-dd if reversed."""
    return F.date_format(date, f"yyyy'{sep}'MM'{sep}'dd" if reverse else f"dd'{sep}'MM'{sep}'yyyy")


def display(date: Column, year: Column) -> Column:
    """18 April 2024, or the year alone, or an empty text."""
    return F.coalesce(F.date_format(date, "d MMMM yyyy"), year.cast("string"), F.lit(""))


def first_format(text: Column, *formats: str) -> Column:
    """The date by the first format that fits."""
    return F.coalesce(*[F.try_to_date(text, f) for f in formats])


def days(spark: SparkSession, first: str, last: str) -> DataFrame:
    """(day) for each day of the range."""
    return spark.range(1).select(F.explode(F.sequence(F.to_date(F.lit(first)), F.to_date(F.lit(last)))).alias("day"))


def year_chunks(spark: SparkSession, first: str, last: str) -> DataFrame:
    """(first, last) for each calendar year that the range touches, cut to the range."""
    a, b = F.to_date(F.lit(first)), F.to_date(F.lit(last))
    years = spark.range(1).select(F.explode(F.sequence(F.year(a), F.year(b))).alias("y"))
    one, end = F.lit(1), F.lit(31)
    return years.select(
        F.greatest(a, F.make_date("y", one, one)).alias("first"), F.least(b, F.make_date(F.col("y"), F.lit(12), end)).alias("last")
    )


def default_window(first, last, today, look_back: int = 15):
    """(first, last) of a crawl: look back some days without dates, up to today from a first, one day for a last."""
    from datetime import timedelta

    if first is None and last is None:
        return today - timedelta(days=look_back), today
    if last is None:
        return first, today
    return (last if first is None else first), last
