"""Streams: a feed of relative urls, uploads by day, idempotent upserts and late assets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def relurl_feed(spark: SparkSession, folder: str, per_batch: int | None = None) -> DataFrame:
    """(relurl) from text files that arrive in a folder, one a line; empty lines are left out."""
    reader = spark.readStream.format("text")
    if per_batch:
        reader = reader.option("maxFilesPerTrigger", per_batch)
    return reader.load(folder).select(F.trim("value").alias("relurl")).where("relurl <> ''")


def parquet_feed(spark: SparkSession, folder: str, schema, per_batch: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch).parquet(folder)


def first_seen(stream: DataFrame, key: str, time: str, within: str = "15 days") -> DataFrame:
    """Each key once; keys are forgotten when the watermark passes, as a look-back crawl forgets."""
    return stream.withWatermark(time, within).dropDuplicatesWithinWatermark([key])


def by_upload_day(stream: DataFrame, time: str, start: str = "5 hours", late: str = "1 hour") -> DataFrame:
    """(start, end, n): counts of days that begin at an hour, late rows up to a delay included."""
    counted = stream.withWatermark(time, late).groupBy(F.window(time, "1 day", "1 day", start).alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return counted.select("w.start", "w.end", "n")


def first_ever(stream: DataFrame, key: str) -> DataFrame:
    """Each key once, however far apart its rows are; the state holds every key."""
    return stream.dropDuplicates([key])


BUCKETS = 32


def upsert_batches(path: str, key: str, order: str, buckets: int = BUCKETS, keep: int = 2):
    """A foreachBatch function that merges each batch into a Parquet table of versions and buckets.

    The latest row of a key by ``order`` wins, of equal ones that with the greatest hash, so a batch that comes
    again changes nothing. A batch
    rewrites the buckets that its keys are in, under its own number; readers take the highest
    number of each bucket. Versions of a bucket beyond the ``keep`` newest are deleted.
    """

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        new = batch.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
        touched = sorted(r["bucket"] for r in new.select("bucket").distinct().collect())
        if not touched:
            return
        old = current(spark, path, before=number, only=touched)
        both = new if old is None else old.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")).unionByName(new, allowMissingColumns=True)
        last = F.row_number().over(Window.partitionBy("bucket", key).orderBy(F.desc(order), F.desc(F.xxhash64(*[c for c in both.columns if c != "bucket"]))))
        merged = both.withColumn("__n", last).where("__n = 1").drop("__n")
        merged.write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/v={number:010d}")
        _expire(spark, path, keep)

    return merge


def _folders(spark: SparkSession, path: str) -> dict[int, list[str]]:
    """The folders of each bucket, oldest version first, of the versions that were written to the end."""
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    out: dict[int, list[str]] = {}
    if not fs.exists(root):
        return out
    for version in sorted(s.getPath().getName() for s in fs.listStatus(root)):
        folder = f"{path}/{version}"
        if not version.startswith("v=") or not fs.exists(jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")):
            continue
        for s in fs.listStatus(jvm.org.apache.hadoop.fs.Path(folder)):
            name = s.getPath().getName()
            if name.startswith("bucket="):
                out.setdefault(int(name[7:]), []).append(f"{folder}/{name}")
    return out


def _expire(spark: SparkSession, path: str, keep: int) -> None:
    jvm = spark._jvm
    fs = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    for folders in _folders(spark, path).values():
        for folder in folders[:-keep]:
            fs.delete(jvm.org.apache.hadoop.fs.Path(folder), True)


def current(spark: SparkSession, path: str, before: int | None = None, only: list[int] | None = None) -> DataFrame | None:
    """The newest version of each bucket of a table, or of some buckets, or the newest before a batch number."""
    chosen = []
    for bucket, folders in _folders(spark, path).items():
        if before is not None:
            folders = [f for f in folders if int(f.split("/")[-2][2:]) < before]
        if folders and (only is None or bucket in only):
            chosen.append(folders[-1])
    return spark.read.parquet(*chosen) if chosen else None


def with_flags(stored: DataFrame, arrived: DataFrame) -> DataFrame:
    """stored (relurl, has_pdf, has_alternate, ...) with flags set for assets (relurl, kind) that came later."""
    now = arrived.groupBy("relurl").agg(F.bool_or(F.col("kind") == "raw").alias("__pdf"), F.bool_or(F.col("kind") == "alternate").alias("__alt"))
    joined = stored.join(now, "relurl", "left")
    made = {"has_pdf": F.col("has_pdf") | F.coalesce("__pdf", F.lit(False)), "has_alternate": F.col("has_alternate") | F.coalesce("__alt", F.lit(False))}
    return joined.select(*[made[c].alias(c) if c in made else F.col(c) for c in stored.columns])
