"""Filters over documents: sources, dates, years, names, sizes and required fields."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RELURL = "^[A-Za-z0-9._-]+(?:/[A-Za-z0-9._-]+)+$"
RELURL_LIMIT = 512


def by_sources(df: DataFrame, names: Iterable[str], column: str = "source") -> DataFrame:
    """Rows of these sources; all rows if no source is named."""
    names = list(names)
    return df.where(F.col(column).isin(names)) if names else df


def date_between(column: Column, first=None, last=None) -> Column:
    """Inclusive range; a null date is in no range, a missing bound is open."""
    condition = F.lit(True)
    if first is not None:
        condition = condition & (column >= F.lit(first))
    if last is not None:
        condition = condition & (column <= F.lit(last))
    return F.coalesce(condition, F.lit(False))


def dated_or_unbounded(column: Column, first=None, last=None) -> Column:
    """Rows in the range; undated rows only if there is no range."""
    return F.lit(True) if first is None and last is None else date_between(column, first, last)


def in_year(df: DataFrame, year: int, column: str = "year") -> DataFrame:
    """Rows of one year; rows without a year are in none."""
    return df.where(F.col(column) == year)


def year_or_unknown(column: Column, first: int, last: int) -> Column:
    """Years in the range, and unknown years."""
    return column.isNull() | column.between(first, last)


def ordered_range(first, last):
    """The two bounds of a range in order; open bounds stay."""
    return (last, first) if first is not None and last is not None and first > last else (first, last)


def ends_with_date(column: Column, date: Column) -> Column:
    """Identifiers that end with dd/mm/yyyy of the date."""
    return F.endswith(column, F.date_format(date, "dd/MM/yyyy"))


def complete(df: DataFrame, required: Iterable[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with all required fields, the others with the names of what is missing)."""
    required = list(required)
    missing = F.filter(
        F.array(*[F.when(F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == ""), F.lit(c)) for c in required]),
        lambda x: x.isNotNull(),
    )
    marked = df.withColumn("missing", missing)
    return marked.where(F.size("missing") == 0).drop("missing"), marked.where(F.size("missing") > 0)


def deny(df: DataFrame, column: str, values: Iterable[str] = (), pattern: str | None = None) -> DataFrame:
    """Rows whose value is not listed and does not match; null values stay."""
    bad = F.col(column).isin(list(values)) if values else F.lit(False)
    if pattern:
        bad = bad | F.col(column).rlike(pattern)
    return df.where(~F.coalesce(bad, F.lit(False)))


def override(df: DataFrame, corrections: DataFrame, key: str, columns: Iterable[str]) -> DataFrame:
    """Columns replaced by those of corrections where a row of it has the same key.

    Corrections have one row a key; they are joined as Spark sees fit, so the list may grow.
    """
    columns = list(columns)
    fixed = corrections.select(F.col(key).alias("__key"), *[F.col(c).alias(f"__{c}") for c in columns])
    joined = df.join(fixed, F.col(key) == F.col("__key"), "left")
    return joined.select(*[F.coalesce(f"__{c}", c).alias(c) if c in columns else F.col(c) for c in df.columns])


def valid_relurl(column: Column) -> Column:
    """The cleaned relative url (outer slashes stripped), or null if it is not allowed."""
    clean = F.btrim(column, F.lit("/"))
    parts = F.split(clean, "/")
    fine = (
        clean.rlike(RELURL)
        & (F.length(clean) <= RELURL_LIMIT)
        & ~F.exists(parts, lambda p: p.isin(".", ".."))
    )
    return F.when(fine, clean)


def safe_extension(column: Column, allowed: Iterable[str]) -> Column:
    return F.coalesce(F.lower(column).isin([a.lower() for a in allowed]), F.lit(False))


def large_enough(size: Column, least: int) -> Column:
    """At least this many bytes more than none; a limit of 0 or less admits all."""
    return F.lit(True) if least <= 0 else F.coalesce(size > least, F.lit(False))


def promoted(column: Column, limit: int) -> Column:
    """A trimmed value, or '' if it is missing or longer than the limit."""
    value = F.trim(F.coalesce(column, F.lit("")))
    return F.when(F.length(value) <= limit, value).otherwise("")


def residual(metadata: Column, known: Iterable[str]) -> Column:
    """Entries of a map that are neither promoted nor empty, sorted by key, keys made readable."""
    rest = F.map_filter(metadata, lambda k, v: ~k.isin(list(known)) & v.isNotNull() & (F.trim(v) != ""))
    return F.transform(
        F.array_sort(F.map_entries(rest)),
        lambda e: F.struct(F.initcap(F.replace(e["key"], F.lit("_"), F.lit(" "))).alias("label"), e["value"].alias("value")),
    )


def rename_fields(fields: Column, names: Mapping[str, str]) -> Column:
    """Keys of an array of (k, v) renamed."""
    table = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])
    return F.transform(fields, lambda f: F.struct(F.coalesce(F.try_element_at(table, f["k"]), f["k"]).alias("k"), f["v"].alias("v")))


def replace_field(fields: Column, key: str, value: Column) -> Column:
    """The value of a key in an array of (k, v), added at the end if it is not there."""
    there = F.exists(fields, lambda f: f["k"] == key)
    changed = F.transform(fields, lambda f: F.struct(f["k"].alias("k"), F.when(f["k"] == key, value).otherwise(f["v"]).alias("v")))
    return F.when(there, changed).otherwise(F.array_append(fields, F.struct(F.lit(key).alias("k"), value.alias("v"))))


def remove_fields(fields: Column, keys: Iterable[str]) -> Column:
    return F.filter(fields, lambda f: ~f["k"].isin(list(keys)))


def known_sources(df: DataFrame, catalog: DataFrame, column: str = "source") -> DataFrame:
    return df.join(catalog.select(F.col("name").alias(column)).distinct(), column, "left_semi")


def enabled_sources(catalog: DataFrame) -> DataFrame:
    return catalog.where(F.coalesce("enabled", F.lit(True)))
