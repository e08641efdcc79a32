"""Orders with explicit places for nulls, and pages of results."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PAGE_SIZE = 20
ORDERS = ("relevance", "newest", "oldest")


def effective_order(order: str | None, has_query: bool) -> str:
    """The asked order if it is one; else relevance with a query text and newest without."""
    wanted = order if order in ORDERS else ("relevance" if has_query else "newest")
    return "newest" if wanted == "relevance" and not has_query else wanted


@dataclass(frozen=True)
class Key:
    """A column to order by, with the place of its nulls."""

    name: str
    descending: bool = False
    nulls_last: bool = True

    def column(self, back: bool = False) -> Column:
        """The order, or the order read from its end."""
        c = F.col(self.name)
        ways = ((c.asc_nulls_first, c.asc_nulls_last), (c.desc_nulls_first, c.desc_nulls_last))
        return ways[self.descending != back][self.nulls_last != back]()


def order_keys(order: str, date: str = "date", key: str = "id", rank: str = "rank") -> list[Key]:
    """Undated rows come last in every order; ties go by the key."""
    if order == "relevance":
        return [Key(rank, True), Key(date, True), Key(key, True)]
    if order == "oldest":
        return [Key(date), Key(key)]
    return [Key(date, True), Key(key, True)]


def source_page_keys(date: str = "date", key: str = "id") -> list[Key]:
    """The order of a source's own page: newest first, undated rows before all others."""
    return [Key(date, True, False), Key(key, True)]


def ordered(df: DataFrame, keys: list[Key], back: bool = False) -> DataFrame:
    return df.orderBy(*[k.column(back) for k in keys])


def recent(df: DataFrame, n: int = 8, date: str = "date", key: str = "id") -> DataFrame:
    """The n latest dated rows."""
    return ordered(df.where(F.col(date).isNotNull()), order_keys("newest", date, key)).limit(n)


def in_language(name: str, collation: str | None) -> Column:
    """A text column as a collation orders it: UNICODE (accents, then small letters first), UNICODE_CI, de, ...; code points without one."""
    return F.col(name) if collation is None else F.collate(F.col(name), collation)


def largest_sources(sources: DataFrame, n: int = 12, collation: str | None = None) -> DataFrame:
    """The n sources (name, gazette_count, ...) with the most documents, of those that have any; ties by name."""
    return sources.where("gazette_count > 0").orderBy(F.desc("gazette_count"), in_language("name", collation), "name").limit(n)


def by_title(sources: DataFrame, collation: str | None = None) -> DataFrame:
    """Sources in the order of their titles, then of their names; equal ones of a collation by code points."""
    return sources.orderBy(in_language("title", collation), in_language("name", collation), "title", "name")


def at_most(df: DataFrame, n: int | None, keys: list[Key]) -> DataFrame:
    """The first n rows in the order, or all rows without an n."""
    return df if n is None else ordered(df, keys).limit(n)


@dataclass(frozen=True)
class Page:
    rows: DataFrame
    number: int
    pages: int
    total: int


def paginate(df: DataFrame, keys: list[Key], number: int, size: int = PAGE_SIZE) -> Page:
    """One page of df; numbers beyond the last page give the last one, below the first the first.

    The keys end with one that tells all rows apart. A page is a top-k of the rows before its end,
    or, where fewer rows follow than precede it, of the rows from its start read from the end.
    """
    total = df.count()
    pages = max(1, -(-total // size))
    number = min(max(1, number), pages)
    start, end = (number - 1) * size, min(number * size, total)
    if end <= total - start:
        rows = ordered(df, keys).offset(start).limit(size)
    else:
        rows = ordered(ordered(df, keys, back=True).offset(total - end).limit(end - start), keys)
    return Page(rows, number, pages, total)


def elided_range(number: int, pages: int, around: int = 2, ends: int = 1) -> list[int | None]:
    """Page numbers to show; None stands for a gap of two or more."""
    near = {p for p in range(number - around, number + around + 1) if 1 <= p <= pages}
    shown = sorted(near | set(range(1, min(ends, pages) + 1)) | set(range(max(1, pages - ends + 1), pages + 1)))
    out: list[int | None] = []
    for p in shown:
        if out and out[-1] is not None and p - out[-1] == 2:
            out.append(p - 1)
        elif out and out[-1] is not None and p - out[-1] > 2:
            out.append(None)
        out.append(p)
    return out


def natural_key(text: Column) -> Column:
    """A key that sorts runs of digits by value: each run without leading zeros, after the number of its digits."""
    parts = F.regexp_extract_all(text, F.lit("([0-9]+|[^0-9]+)"), 1)

    def digits(run):
        return F.concat(F.lpad(F.length(run).cast("string"), 10, "0"), run)

    return F.array_join(F.transform(parts, lambda p: F.when(p.rlike("^[0-9]"), digits(F.ltrim(p, F.lit("0")))).otherwise(p)), "")
