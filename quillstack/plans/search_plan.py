"""A search as a value, and the plan that answers it."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import facets, filters, ordering, search


@dataclass(frozen=True)
class Criteria:
    q: str = ""
    sources: tuple[str, ...] = ()
    first: date | None = None
    last: date | None = None
    year: int | None = None
    order: str | None = None

    @property
    def has_query(self) -> bool:
        return bool(self.q.strip())

    @property
    def is_empty(self) -> bool:
        return not (self.has_query or self.sources or self.first or self.last or self.year)


@dataclass(frozen=True)
class Archive:
    """gazettes (id, source, date, year, ...), their postings and the sources (name, title)."""

    gazettes: DataFrame
    postings: DataFrame
    sources: DataFrame

    def hits(self, c: Criteria) -> DataFrame:
        """The matching rows; filters come before the text match, so they reach the scan."""
        first, last = filters.ordered_range(c.first, c.last)
        rows = filters.by_sources(self.gazettes, c.sources)
        if first is not None or last is not None:
            rows = rows.where(filters.date_between(F.col("date"), first, last))
        if c.year:
            rows = rows.where(F.col("year") == c.year)
        if c.has_query:
            found = search.match(self.postings, rows, "id", c.q).select(F.col("doc").alias("id"))
            rows = rows.join(found, "id", "left_semi")
        return rows

    def page(self, c: Criteria, number: int = 1, size: int = ordering.PAGE_SIZE) -> ordering.Page:
        order = ordering.effective_order(c.order, c.has_query)
        rows = self.hits(c)
        if order == "relevance":
            rank = search.ranked(self.postings, rows.select(F.col("id").alias("doc")), c.q)
            rows = rows.join(rank.withColumnRenamed("doc", "id"), "id")
        return ordering.paginate(rows, ordering.order_keys(order), number, size)

    def source_facets(self, c: Criteria, limit: int = facets.SOURCE_FACETS) -> DataFrame:
        """Counts without the source filter, so that other sources stay on offer."""
        return facets.source_facets(self.hits(replace(c, sources=())), self.sources, c.sources, limit)

    def year_facets(self, c: Criteria, limit: int = facets.YEAR_FACETS) -> DataFrame:
        return facets.year_facets(self.hits(c), limit)
