"""Streams run to the end of what is there, each with the same result as SQL over the table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.archive_queries import query
from ..session import shared_folder
from . import feeds, ingest_stream, keyed_state


def _events(spark: SparkSession, d: str) -> DataFrame:
    schema = spark.read.parquet(f"{d}/events.parquet").schema
    return feeds.parquet_feed(spark, f"{d}/events*.parquet", schema).withColumn("ts", F.col("ts").cast("timestamp"))


def _finished(stream: DataFrame, mode: str) -> DataFrame:
    """The result of a stream over all that has arrived: what its batches wrote to the shared folder.

    Batches write under their numbers, so one that comes again replaces itself. In complete mode the
    last batch is the result, in append mode all of them are.
    """
    spark = stream.sparkSession
    folder = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    numbers = []

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/{number}")
        numbers.append(number)

    running = stream.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", f"{folder}/state")
    running.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(*[f"{folder}/{n}" for n in sorted(set(numbers))[-1 if mode == "complete" else 0 :]])


@query("""SELECT strftime(time_bucket(INTERVAL 1 DAY, ts::TIMESTAMP, TIMESTAMP '2024-01-01 05:00:00'), '%Y-%m-%d %H') AS day, count(*) AS n FROM events GROUP BY 1""")
def stream_daily_windows(spark, d):
    days = _finished(feeds.by_upload_day(_events(spark, d), "ts", late="40 days"), "complete")
    return days.select(F.date_format("start", "yyyy-MM-dd HH").alias("day"), "n")


@query("SELECT DISTINCT user_id FROM events")
def stream_first_seen(spark, d):
    return _finished(feeds.first_ever(_events(spark, d).select("user_id"), "user_id"), "append")


@query("SELECT event_type, count(*) AS n, count(*) FILTER (value >= 50) AS large FROM events GROUP BY event_type")
def stream_status_counts(spark, d):
    counted = _events(spark, d).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("value") >= 50).alias("large"))
    return _finished(counted, "complete")


_TTL = "2 days"


@query("""WITH RECURSIVE e AS (SELECT user_id, epoch_us(ts::TIMESTAMP) AS us, row_number() OVER (PARTITION BY user_id, ts) AS nth FROM events),
n AS (SELECT user_id, us, min(us) OVER (PARTITION BY user_id ORDER BY us RANGE BETWEEN 172800000000 FOLLOWING AND UNBOUNDED FOLLOWING) AS next FROM (SELECT DISTINCT user_id, us FROM e)),
m AS (SELECT user_id, min(us) AS us FROM e GROUP BY user_id UNION ALL SELECT n.user_id, n.next FROM m JOIN n USING (user_id, us) WHERE n.next IS NOT NULL)
SELECT user_id, us, CASE WHEN nth = 1 AND m.us IS NOT NULL THEN 'miss' ELSE 'hit' END AS kind FROM e LEFT JOIN m USING (user_id, us)""")
def stream_cache_hits(spark, d):
    found = _finished(keyed_state.cached(_events(spark, d).select("user_id", "ts"), "user_id", "ts", ttl=_TTL, late="1 day"), "append")
    return found.where("kind <> 'expired'").select("user_id", F.unix_micros("ts").alias("us"), "kind")


#: Which documents come with each of three batches, and with which identifier.
_COMES = ("doc_id % 4 < 3", "true", "doc_id % 2 = 0 OR doc_id % 7 < 2")
_IDENTIFIER = (
    "concat('id.', doc_id)", "CASE WHEN doc_id % 31 <> 0 THEN concat('id.', CASE WHEN doc_id % 7 = 0 THEN doc_id + 1 ELSE doc_id END) END",
    "CASE WHEN doc_id % 7 = 2 THEN concat('new.', doc_id) ELSE concat('id.', doc_id) END",
)


def _row(t: int) -> str:
    """The columns of a batch, in SQL that both sides read."""
    return f"""doc_id AS seq, CASE WHEN doc_id % 23 = 0 THEN '../x' ELSE concat(source, '/', doc_id) END AS relurl, {_IDENTIFIER[t]} AS identifier,
    CASE WHEN n_chars % 17 > 0 THEN '{{}}' END AS metadata, n_chars % 19 = 0 AS malformed, CASE WHEN doc_id % 29 = 0 THEN ' ' ELSE text END AS text,
    sha256(concat(text, CASE WHEN doc_id % 5 = 0 THEN {t} ELSE 0 END)) AS html_sha256, 'm' AS metadata_sha256, (doc_id + {t}) % 3 = 0 AS has_pdf"""


def _fold(t: int) -> str:
    return f"""
b{t} AS (SELECT {_row(t)}, source FROM documents WHERE {_COMES[t]}),
c{t} AS (SELECT b.*, s.relurl IS NOT NULL AS stored, CASE WHEN b.relurl = '../x' THEN 'error' WHEN source = 'src3' THEN 'skipped' WHEN metadata IS NULL THEN 'skipped' WHEN malformed THEN 'error'
    WHEN text IS NULL OR trim(text, ' ') = '' THEN 'skipped' WHEN b.identifier IS NULL THEN 'skipped' WHEN s.identifier = b.identifier AND s.html_sha256 = b.html_sha256 THEN 'unchanged' END AS first
  FROM b{t} b LEFT JOIN s{t} s USING (relurl)),
k{t} AS (SELECT *, min(seq) FILTER (first IS NULL) OVER (PARTITION BY identifier) AS claimant FROM c{t}),
f{t} AS (SELECT k.*, coalesce(first, CASE WHEN coalesce(o.relurl <> k.relurl, claimant <> seq) THEN 'error' WHEN stored THEN 'updated' ELSE 'created' END) AS status
  FROM k{t} k LEFT JOIN s{t} o ON o.identifier = k.identifier),
s{t + 1} AS (SELECT relurl, identifier, html_sha256, has_pdf FROM f{t} WHERE status IN ('created', 'updated')
  UNION ALL SELECT s.relurl, s.identifier, s.html_sha256, coalesce(f.has_pdf, s.has_pdf) FROM s{t} s LEFT JOIN f{t} f ON f.relurl = s.relurl AND status = 'unchanged'
  WHERE s.relurl NOT IN (SELECT relurl FROM f{t} WHERE status IN ('created', 'updated')))"""


_FOLDED = f"WITH s0 AS (SELECT '' AS relurl, '' AS identifier, '' AS html_sha256, true AS has_pdf FROM range(0)), {', '.join(map(_fold, range(3)))}"


def _ingested(spark: SparkSession, d: str) -> str:
    """The path of a store that took in three arrivals of documents, each as a batch of one resumed stream."""
    path = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    catalog = docs.select(F.col("source").alias("name")).where("source <> 'src3'").distinct()
    for t, comes in enumerate(_COMES):
        columns = _row(t).replace("sha256(concat(text, CASE WHEN", "sha2(concat(text, CASE WHEN").replace("ELSE 0 END)) AS html_sha256", "ELSE 0 END), 256) AS html_sha256")
        rows = docs.where(comes).selectExpr(f"inline(array(struct({columns})))")
        rows.write.mode("append").parquet(f"{path}/arrived")
        stream = spark.readStream.schema(rows.schema).parquet(f"{path}/arrived")
        running = stream.writeStream.foreachBatch(ingest_stream.ingest_batches(f"{path}/store", catalog, buckets=8)).option("checkpointLocation", f"{path}/state")
        running.trigger(availableNow=True).start().awaitTermination()
    return f"{path}/store"


@query(f"{_FOLDED} " + " UNION ALL ".join(f"SELECT {t} AS batch, seq, status FROM f{t}" for t in range(3)))
def stream_ingest_statuses(spark, d):
    return ingest_stream.statuses(spark, _ingested(spark, d)).select("batch", "seq", "status")


@query(f"{_FOLDED} SELECT relurl, identifier, html_sha256, has_pdf FROM s3")
def stream_ingest_table(spark, d):
    return ingest_stream.gazettes(spark, _ingested(spark, d)).select("relurl", "identifier", "html_sha256", "has_pdf")
