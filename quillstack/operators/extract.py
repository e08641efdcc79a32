"""Records from scraped rows: header-driven columns, unpivots, grouping, nested duplicates."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def header_order(header: Column, rules: Mapping[str, str]) -> Column:
    """For each header cell the name of the first rule whose pattern it matches, or ''."""
    def name(cell):
        out = None
        for field, pattern in rules.items():
            test = F.lower(F.trim(cell)).rlike(pattern)
            out = F.when(test, F.lit(field)) if out is None else out.when(test, F.lit(field))
        return out.otherwise("") if out is not None else F.lit("")

    return F.transform(header, name)


def assigned(order: Column, cells: Column) -> Column:
    """A map from column names to the cells of the same place; unnamed and missing cells are left out."""
    pairs = F.filter(F.arrays_zip(order.alias("k"), cells.alias("v")), lambda x: x["k"].isNotNull() & (x["k"] != "") & x["v"].isNotNull())
    return F.map_from_entries(F.transform(pairs, lambda x: F.struct(x["k"], F.trim(x["v"]))))


def largest_table(tables: DataFrame, group: str) -> DataFrame:
    """The leaf table with the most rows of each page; the first of equals. tables: (group, idx, n_rows, leaf)."""
    nth = F.row_number().over(Window.partitionBy(group).orderBy(F.desc("n_rows"), "idx"))
    return tables.where("leaf").withColumn("__n", nth).where("__n = 1").drop("__n")


def next_page(links: DataFrame, group: str, current: str) -> DataFrame:
    """(group, href): the first link whose text is the current page's number and one."""
    nxt = links.where(F.trim("text") == (F.col(current) + 1).cast("string"))
    return nxt.groupBy(group).agg(F.min_by("href", "idx").alias("href"))


def unpivoted(rows: DataFrame, keys: list[str], columns: Mapping[str, str]) -> DataFrame:
    """One row for each filled section column: keys, section (its label) and value."""
    long = rows.unpivot(keys, list(columns), "section", "value")
    table = F.create_map(*[F.lit(x) for kv in columns.items() for x in kv])
    return long.where(F.col("value").isNotNull() & (F.trim("value") != "")).withColumn("section", F.element_at(table, F.col("section")))


def grouped_notifications(rows: DataFrame, key: str, order: str, scalars: list[str], item: list[str]) -> DataFrame:
    """One record a key: scalars of its first row, and the list of its items in order."""
    return rows.groupBy(key).agg(
        *[F.min_by(c, order).alias(c) for c in scalars],
        F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.struct(*item).alias("x")))), lambda e: e["x"]).alias("notifications"),
    )


def nested_duplicates(rows: DataFrame, key: str, order: str, columns: list[str]) -> DataFrame:
    """The first row of each key with the later ones, in order, in ``additional``."""
    items = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.struct(*columns).alias("x"))))
    packed = rows.groupBy(key).agg(items.alias("items"))
    return packed.select(
        key, *[F.col("items")[0]["x"][c].alias(c) for c in columns],
        F.transform(F.slice("items", 2, F.greatest(F.size("items") - 1, F.lit(1))), lambda e: e["x"]).alias("additional"),
    )


def links_by_date(links: DataFrame) -> DataFrame:
    """(date, hrefs) in date order, each date's links in page order."""
    packed = links.groupBy("date").agg(F.transform(F.array_sort(F.collect_list(F.struct("idx", "href"))), lambda x: x["href"]).alias("hrefs"))
    return packed.orderBy("date")


def zipped_links(ids: Column, names: Column) -> Column:
    """(id, name) pairs as far as both lists go."""
    n = F.least(F.size(ids), F.size(names))
    return F.when(n > 0, F.arrays_zip(F.slice(ids, 1, n).alias("id"), F.slice(names, 1, n).alias("name"))).otherwise(F.array())
