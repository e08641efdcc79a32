"""Unions, differences, priority between roots and the expansion of a source hierarchy."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint


def union_pages(*pages: DataFrame) -> DataFrame:
    """All rows of all pages; columns that a page lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), pages)


def unseen(rows: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not among the seen ones; null keys are not seen."""
    return rows.join(seen.select(key).distinct(), key, "left_anti")


def seen_status(asked: DataFrame, stored: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """The stored columns of the asked keys that are stored."""
    return stored.join(asked.select(key).distinct(), key, "left_semi").select(key, *columns)


def cached(asked: DataFrame, store: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(stored rows of the asked keys, asked keys that have to be fetched)."""
    keys = asked.select(key).distinct()
    return store.join(keys, key, "left_semi"), unseen(keys, store, key)


def made_once(rows: DataFrame, store: DataFrame, keys: list[str], made: str, value: Column) -> tuple[DataFrame, DataFrame]:
    """(rows with ``made``, the rows to add to the store): what is costly to make is made once for each value of the keys.

    store: (keys, made). The keys name a row and the hash of what ``value`` is made of, so a changed
    row finds nothing in the store and is made anew.
    """
    there = rows.join(store.select(*keys, made), keys, "left_semi").join(store.select(*keys, made), keys)
    new = rows.join(store.select(*keys), keys, "left_anti").withColumn(made, value)
    return there.unionByName(new), new.select(*keys, made).dropDuplicates(keys)


def first_by(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row a key: the first in the order."""
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("__nth", nth).where("__nth = 1").drop("__nth")


def merge_roots(assets: DataFrame) -> DataFrame:
    """One asset a (kind, relurl): that of the first root, then the first path."""
    return first_by(assets, ["kind", "relurl"], [F.col("root"), F.col("ext")])


def expand(edges: DataFrame, names: list[str]) -> DataFrame:
    """(name): the leaves under these names, once for each way that leads to them; names without children are leaves themselves.

    edges: (parent, child). Goes down one level at a time until no name has children; a cycle, which
    would never end, is an error.
    """
    down = checkpoint(edges.select(F.col("parent").alias("name"), "child"))
    most = down.select("name").distinct().count()
    now = edges.sparkSession.createDataFrame([(n,) for n in names], "name string")
    leaves = []
    for _ in range(most + 1):
        step = checkpoint(now.join(down, "name", "left"))
        leaves.append(step.where(F.col("child").isNull()).select("name"))
        now = step.where(F.col("child").isNotNull()).select(F.col("child").alias("name"))
        if now.isEmpty():
            return reduce(DataFrame.unionByName, leaves)
    raise ValueError("the hierarchy has a cycle")


def years_between(spark, first, last) -> DataFrame:
    """(year) for each year from first to last, in order."""
    years = F.sequence(F.year(F.to_date(F.lit(first))), F.year(F.to_date(F.lit(last))))
    return spark.range(1).where(F.to_date(F.lit(first)) <= F.to_date(F.lit(last))).select(F.explode(years).alias("year"))
