"""Incremental ingest: one status for each relative url of a batch, and the merged table.

Statuses, by the first rule that holds: error (bad url), skipped (unknown source, no metadata),
error (malformed metadata), skipped (no or blank text, no usable identifier), unchanged (both
hashes and the identifier as stored, unless forced), error (identifier of another url), created
or updated. Within a batch the first row that claims an identifier keeps it, owners before that.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .filters import valid_relurl

IDENTIFIER_LIMIT = 255
TEXT_LIMIT = 4_000_000


def classify(batch: DataFrame, stored: DataFrame, catalog: DataFrame, force: bool = False, owners: DataFrame | None = None) -> DataFrame:
    """batch with source, status and reason.

    batch: (seq, relurl, identifier, metadata, malformed, text, html_sha256, metadata_sha256), seq
    telling its rows apart. stored: (relurl, identifier, html_sha256, metadata_sha256). catalog: (name).
    owners: (identifier, relurl) where stored holds the urls of the batch alone; else those of stored.
    Statuses are decided on narrow rows, which say of text and metadata only whether they are there;
    whole rows meet them in one join at the end.
    """
    narrow = batch.select(
        "seq", valid_relurl(F.col("relurl")).alias("clean"), "identifier", F.col("metadata").isNotNull().alias("described"),
        F.coalesce("malformed", F.lit(False)).alias("malformed"), (F.col("text").isNull() | (F.trim("text") == "")).alias("blank"),
        "html_sha256", "metadata_sha256",
    ).withColumn("source", F.substring_index("clean", "/", 1))
    known = catalog.select(F.col("name").alias("source"), F.lit(True).alias("known")).distinct()
    old = stored.select(
        F.col("relurl").alias("clean"), *[F.col(c).alias(f"old_{c}") for c in ("identifier", "html_sha256", "metadata_sha256")]
    )
    rows = narrow.join(known, "source", "left").join(old, "clean", "left")
    same = F.lit(not force)
    for c in ("identifier", "html_sha256", "metadata_sha256"):
        same = same & F.col(c).eqNullSafe(F.col(f"old_{c}"))
    unusable = F.col("identifier").isNull() | (F.length("identifier") > IDENTIFIER_LIMIT)
    first = (
        F.when(F.col("clean").isNull(), "bad url").when(F.col("known").isNull(), "unknown source")
        .when(~F.col("described"), "no metadata").when(F.col("malformed"), "malformed metadata")
        .when(F.col("blank"), "no text").when(unusable, "no identifier").when(same & F.col("old_identifier").isNotNull(), "same")
    )
    rows = rows.withColumn("first", first)
    # who may have an identifier: its stored owner, else the first of the batch that could be written;
    # only such rows take part, so rows without an identifier meet nowhere
    asked = rows.where("first IS NULL").groupBy("identifier").agg(F.min(F.struct("seq", "clean"))["clean"].alias("claimant"))
    owners = (stored if owners is None else owners).select("identifier", F.col("relurl").alias("owner"))
    holders = asked.join(owners, "identifier", "left").select(F.col("identifier").alias("of"), F.coalesce("owner", "claimant").alias("holder"))
    rows = rows.withColumn("wanted", F.when(F.col("first").isNull(), F.col("identifier")).otherwise(F.concat(F.lit("\n"), F.col("seq").cast("string"))))
    rows = rows.join(holders, F.col("wanted") == F.col("of"), "left")
    taken = F.col("first").isNull() & ~F.col("holder").eqNullSafe(F.col("clean"))
    reason = F.coalesce("first", F.when(taken, "identifier taken"))
    status = (
        F.when(reason.isin("bad url", "malformed metadata", "identifier taken"), "error").when(reason == "same", "unchanged")
        .when(reason.isNotNull(), "skipped").when(F.col("old_html_sha256").isNotNull() | F.col("old_identifier").isNotNull(), "updated")
        .otherwise("created")
    )
    return batch.join(rows.select("seq", "source", status.alias("status"), reason.alias("reason")), "seq").select(*batch.columns, "source", "status", "reason")


def merged(stored: DataFrame, classified: DataFrame) -> DataFrame:
    """The stored table after the batch: written rows replace or join what is there; the last of a url wins."""
    written = classified.where(F.col("status").isin("created", "updated"))
    last = F.row_number().over(Window.partitionBy("relurl").orderBy(F.desc("seq")))
    new = written.withColumn("__n", last).where("__n = 1").select(*stored.columns)
    return stored.join(new.select("relurl"), "relurl", "left_anti").select(*stored.columns).unionByName(new)


def collisions(rows: DataFrame) -> DataFrame:
    """(identifier, n): identifiers that more than one relative url has."""
    return rows.groupBy("identifier").agg(F.countDistinct("relurl").alias("n")).where("n > 1")


def http_status(status):
    return F.when(status == "error", 422).when(status == "failed", 500).otherwise(200)
