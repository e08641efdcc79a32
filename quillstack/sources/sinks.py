"""Writing to an archive: what is new only, snapshots, metadata as XML, and what a remote store lacks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import escaped, legal_xml
from ..operators.sets import unseen


def new_only(rows: DataFrame, stored: DataFrame, key: str = "relurl", update: bool = False) -> DataFrame:
    """Rows to write: all with update, else those whose key is not stored."""
    return rows if update else unseen(rows, stored, key)


def document_saves(raw: DataFrame, meta: DataFrame, stored_raw: DataFrame, update_raw: bool = False) -> tuple[DataFrame, DataFrame]:
    """(raw rows, metadata rows) to write; metadata goes only with a raw file that is written now."""
    written = new_only(raw, stored_raw, update=update_raw)
    return written, meta.join(written.select("relurl"), "relurl", "left_semi")


def append_parquet(rows: DataFrame, path: str, by: str | None = None, compression: str = "zstd") -> None:
    """Appends through Spark's commit protocol, so readers see all of a task's files or none."""
    writer = rows.write.mode("append").option("compression", compression)
    (writer.partitionBy(by) if by else writer).parquet(path)


def snapshot(rows: DataFrame, folder: str, version: int, by: str | None = None) -> str:
    """A whole new version of a table beside the old ones; its path."""
    path = f"{folder.rstrip('/')}/v={version:010d}"
    writer = rows.write.mode("errorifexists")
    (writer.partitionBy(by) if by else writer).parquet(path)
    return path


def element(tag: Column, value: Column) -> Column:
    return F.concat(F.lit("<"), tag, F.lit(">"), escaped(legal_xml(value)), F.lit("</"), tag, F.lit(">"))


def metadata_xml(single: Column, lists: Column, date: Column) -> Column:
    """A <document>: sorted tags, one for each value of a list, dates as day, month and year.

    single: map of tag to text; lists: map of tag to array of texts; null values are left out.
    """
    flat = F.transform(F.filter(F.map_entries(single), lambda e: e["value"].isNotNull()), lambda e: F.struct(e["key"].alias("k"), element(e["key"], e["value"]).alias("x")))
    repeated = F.transform(
        F.map_entries(lists), lambda e: F.struct(e["key"].alias("k"), F.array_join(F.transform(F.array_compact(e["value"]), lambda v: element(e["key"], v)), "").alias("x"))
    )
    day = F.concat(
        F.lit("<date><day>"), F.dayofmonth(date).cast("string"), F.lit("</day><month>"), F.month(date).cast("string"),
        F.lit("</month><year>"), F.year(date).cast("string"), F.lit("</year></date>"),
    )
    dated = F.when(date.isNotNull(), F.array(F.struct(F.lit("date").alias("k"), day.alias("x")))).otherwise(F.array().cast("array<struct<k:string,x:string>>"))
    parts = F.transform(F.array_sort(F.concat(flat, repeated, dated)), lambda e: e["x"])
    return F.concat(F.lit("<document>"), F.array_join(parts, ""), F.lit("</document>"))


def to_upload(local: DataFrame, remote: DataFrame) -> DataFrame:
    """Files (item, name, ...) that the remote listing (item, name) lacks."""
    return local.join(remote.select("item", "name").distinct(), ["item", "name"], "left_anti")


def remote_action(items: DataFrame, remote: DataFrame) -> DataFrame:
    """items with action: modify where the remote store has the item, else upload."""
    there = remote.select("item").distinct().withColumn("__there", F.lit(True))
    return items.join(there, "item", "left").withColumn("action", F.when(F.col("__there"), "modify").otherwise("upload")).drop("__there")
