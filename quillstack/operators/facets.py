"""Counts over search results and sources."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ordering import in_language

SOURCE_FACETS, YEAR_FACETS = 15, 25


def with_source(gazettes: DataFrame, sources: DataFrame) -> DataFrame:
    """Documents with the title of their source; those of unknown sources are left out."""
    return gazettes.join(sources.select(F.col("name").alias("source"), F.col("title").alias("source_title")), "source")


def source_facets(hits: DataFrame, sources: DataFrame, selected: Iterable[str] = (), limit: int = SOURCE_FACETS, collation: str | None = None) -> DataFrame:
    """(name, title, total, selected), most first, equal ones by name, in the order of a collation if there is one. hits: results before the source filter.

    Counts are made before the join with the titles, so the join sees one row a source.
    """
    counted = hits.groupBy(F.col("source").alias("name")).agg(F.count(F.lit(1)).alias("total"))
    titled = counted.join(sources.select("name", "title"), "name")
    picked = F.col("name").isin(list(selected)) if selected else F.lit(False)
    return titled.withColumn("selected", picked).orderBy(F.desc("total"), in_language("name", collation), "name").limit(limit)


def year_facets(hits: DataFrame, limit: int = YEAR_FACETS) -> DataFrame:
    """(year, total), latest first; rows without a year are left out."""
    dated = hits.where(F.col("year").isNotNull())
    return dated.groupBy("year").agg(F.count(F.lit(1)).alias("total")).orderBy(F.desc("year")).limit(limit)


def year_histogram(gazettes: DataFrame) -> DataFrame:
    """(source, year, n): how many documents of each year each source has; those without a year are left out."""
    return gazettes.where(F.col("year").isNotNull()).groupBy("source", "year").agg(F.count(F.lit(1)).alias("n"))


def archive_stats(gazettes: DataFrame, sources: DataFrame) -> DataFrame:
    """One row: documents, earliest and latest date, sources that have any."""
    one = F.lit(0).alias("one")
    whole = gazettes.agg(F.count(F.lit(1)).alias("documents"), F.min("date").alias("earliest"), F.max("date").alias("latest")).select("*", one)
    filled = sources.agg(F.count_if(F.col("gazette_count") > 0).alias("sources")).select("*", one)
    return whole.join(filled, "one").drop("one")


def refreshed_counters(sources: DataFrame, gazettes: DataFrame) -> DataFrame:
    """Sources with their counters as they are now; sources without documents get 0 and nulls."""
    now = gazettes.groupBy(F.col("source").alias("name")).agg(
        F.count(F.lit(1)).alias("n"), F.min("date").alias("first"), F.max("date").alias("last")
    )
    joined = sources.join(now, "name", "left")
    made = {"gazette_count": F.coalesce("n", F.lit(0)), "earliest_date": F.col("first"), "latest_date": F.col("last")}
    return joined.select(*[made[c].alias(c) if c in made else F.col(c) for c in sources.columns])


def changed_counters(sources: DataFrame, gazettes: DataFrame) -> DataFrame:
    """Only the sources whose counters differ from what they hold."""
    old = sources.select("name", *[F.col(c).alias(f"old_{c}") for c in ("gazette_count", "earliest_date", "latest_date")])
    new = refreshed_counters(sources, gazettes).join(old, "name")
    same = F.lit(True)
    for c in ("gazette_count", "earliest_date", "latest_date"):
        same = same & F.col(c).eqNullSafe(F.col(f"old_{c}"))
    return new.where(~same).select(*sources.columns)


def total_documents(sources: DataFrame) -> DataFrame:
    """(total): the sum of the sources' counters, 0 without sources."""
    return sources.agg(F.coalesce(F.sum("gazette_count"), F.lit(0)).alias("total"))


def status_histogram(results: DataFrame, column: str = "status") -> DataFrame:
    return results.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def histogram_line(results: DataFrame, column: str = "status") -> DataFrame:
    """One row with k=v for each status, sorted and joined by spaces."""
    counted = status_histogram(results, column).select(F.concat_ws("=", column, F.col("n").cast("string")).alias("kv"))
    return counted.agg(F.array_join(F.array_sort(F.collect_list("kv")), " ").alias("line"))


def publish_stats(log: DataFrame) -> DataFrame:
    """(source, uploads, uploaded, modifies, modified) from (source, action, success)."""
    is_ = lambda a: F.col("action") == a
    return log.groupBy("source").agg(
        F.count_if(is_("upload")).alias("uploads"), F.count_if(is_("upload") & F.col("success")).alias("uploaded"),
        F.count_if(is_("modify")).alias("modifies"), F.count_if(is_("modify") & F.col("success")).alias("modified"),
    )


def inactive_sources(sources: DataFrame, log: DataFrame) -> DataFrame:
    return sources.join(log.select(F.col("source").alias("name")).distinct(), "name", "left_anti")


def merged_counts(left: DataFrame, right: DataFrame, key: str = "name") -> DataFrame:
    """(key, a, b) for every key of left; keys that right lacks have 0."""
    return left.select(key, F.col("n").alias("a")).join(right.select(key, F.col("n").alias("b")), key, "left").fillna(0, ["b"])


def language_share(words: DataFrame, least: float = 0.05, most: int = 4, group: str = "doc") -> DataFrame:
    """(group, lang, share, place): languages with more than this share of a group's weight, at most four."""
    summed = words.groupBy(group, "lang").agg(F.sum("weight").alias("weight"))
    share = F.col("weight") / F.sum("weight").over(Window.partitionBy(group))
    kept = summed.withColumn("share", share).where(F.col("share") > least)
    place = F.row_number().over(Window.partitionBy(group).orderBy(F.desc("share"), "lang"))
    return kept.withColumn("place", place).where(F.col("place") <= most).select(group, "lang", "share", "place")


def hosts(urls: DataFrame, url: str = "url") -> DataFrame:
    """(host, n): how many sources each host serves, for one worker a host."""
    return urls.groupBy(F.parse_url(F.col(url), F.lit("HOST")).alias("host")).agg(F.count(F.lit(1)).alias("n"))
