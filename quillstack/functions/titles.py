"""What titles of gazettes say: year, part, number, volume, series and kind, field by field.

Sources word their titles in many ways, so each field is looked for on its own by what stands
before it, instead of one pattern a source.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import dates


def _found(text: Column, *patterns: str) -> Column:
    """The first group of the first pattern that is found."""
    out = [F.when(F.regexp_extract(text, p, 1) != "", F.regexp_extract(text, p, 1)) for p in patterns]
    return F.coalesce(*out)


def parts_of_title(text: Column) -> Column:
    """A struct of year, part and num.

    A range of numbers is a part; a title with neither part nor number is the complete volume.
    """
    year = _found(text, "(?:^|[^0-9])((?:18|19|20)[0-9]{2})(?:[^0-9]|$)")
    span = F.regexp_replace(F.regexp_extract(text, "(?i)no\\.?\\s*([0-9]+\\s*to\\s*[0-9]+)", 1), "(?i)\\s*to\\s*", "-")
    part = F.coalesce(F.when(span != "", span), _found(text, "(?i)\\bpart\\s*[-:]?\\s*([0-9A-Za-z]+)"))
    num = F.when(
        span == "",
        _found(text, "(?i)\\bno\\.?\\s*([0-9]+)", "(?i)\\bng\\.?\\s+([0-9]{1,3})(?:[^0-9]|$)", "^\\s*([0-9]{1,3})\\.\\s"),
    )
    whole = F.when(part.isNull() & num.isNull() & year.isNotNull(), F.lit("complete"))
    return F.struct(year.alias("year"), F.coalesce(part, whole).alias("part"), num.alias("num"))


def volume_of_title(text: Column) -> Column:
    """A struct of date, volume and num of titles such as VOL. LX No.9 FRIDAY, 10th MAY, 2024 / ..."""
    head = F.substring_index(text, "/", 1)
    day = dates.date_of(
        _found(head, "([0-9]{4})\\D*$"), dates.month_number(F.left(_found(head, "(?i)[0-9]\\s*(?:st|nd|rd|th)?\\s+([A-Za-z]{3,9})\\W+[0-9]{4}"), F.lit(3))),
        _found(head, "(?i)([0-9]{1,2})\\s*(?:st|nd|rd|th)?\\s+[A-Za-z]{3,9}\\W+[0-9]{4}"),
    )
    return F.struct(day.alias("date"), _found(head, "(?i)\\bv[oi][l.,]+\\s*(\\w+)").alias("volume"), _found(head, "(?i)\\bno\\.?\\s*([0-9]+(?:\\([0-9A-Za-z]+\\))?)").alias("num"))


def series_of_title(text: Column) -> Column:
    """A struct of kind, series and num: Extraordinary by its word, else Ordinary with the series named."""
    extra = text.rlike("(?i)extra\\s*ordinary")
    series = F.trim(F.regexp_extract(text, "(?i)series\\s*[-–—]*\\s*(.+?)\\s+no\\b", 1))
    num = _found(text, "(?i)\\bno\\s*[.:]?\\s*([0-9]+)", "(?i)ordinary\\s*[.:]?\\s*([0-9]+)")
    kind = F.when(extra, "Extraordinary").when(series != "", "Ordinary")
    return F.struct(kind.alias("kind"), F.when(~extra & (series != ""), series).alias("series"), F.when(kind.isNotNull(), num).alias("num"))


def date_of_file_name(name: Column) -> Column:
    """dd-mm-yy-part file names as a struct of date and part."""
    p = "^([0-9]{2})-([0-9]{2})-([0-9]{2})-(\\w+)\\."
    g = lambda n: F.regexp_extract(name, p, n)
    day = F.when(name.rlike(p), dates.date_of(F.concat(F.lit("20"), g(3)), g(2), g(1)))
    return F.struct(day.alias("date"), F.when(name.rlike(p), g(4)).alias("part"))


def captions(text: Column) -> Column:
    """A map of the labelled fields of a caption: Issue Number: 7, Part: I-B, Gazette Page: 12."""
    pairs = F.regexp_extract_all(text, F.lit("([A-Z][A-Za-z ]*:\\s*[^,:]+)(?:,|$)"), 1)
    return F.map_from_entries(F.transform(pairs, lambda p: F.struct(F.trim(F.substring_index(p, ":", 1)), F.trim(F.substring_index(p, ":", -1)))))
