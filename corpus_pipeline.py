"""A training corpus from raw documents: rules, line dedup, near-dedup, decontamination, mix.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and
read again as the next one's docs. All but the last return the columns of documents; further
columns of the input go along. Where a stage changes the text, n_chars follows it.

Null and empty texts, and those under 50 words, are rejected by the rules, which are the first stage; the
stages after it take them too: they have no lines, are one near-dup group of texts without words, leak
nothing and take no words. Null ids and sources are values like others. Rows that agree in all columns
are one document to the stages that drop copies and count each in the rules and the mix. Very long texts
are handled whole in every stage. Tables without rows give tables without rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstack.llm import decontamination, line_dedup, mixing, near_copies, quality_rules
from quillstack.llm.common import broadcast_if_small, checkpoint, others, shared_folder, table


def _with_text(df: DataFrame, columns: list[str], text) -> DataFrame:
    """The columns with this text, and its length for n_chars."""
    made = {"text": text.alias("text"), "n_chars": F.length(text).cast("long").alias("n_chars")}  # further columns stay
    return df.select(*[made.get(c, F.col(f"`{c}`")) for c in columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep, without the lines that fail."""
    q = F.col("__quality")
    # a generator, not a filter: a filter would be pushed down and the rules judged twice
    kept = F.explode(F.when(q["kept"], F.array(q["clean_text"])).otherwise(F.array().cast("array<string>")))
    judged = quality_rules.judge(docs, out="__quality").select("*", kept.alias("__clean"))
    return _with_text(judged, docs.columns, F.col("__clean"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without later copies of repeated runs of lines."""
    return _with_text(line_dedup.dedup_lines(docs, out="__dedup"), docs.columns, F.col("__dedup.text"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose five-word shingles are alike by 0.8 or more."""
    return near_copies.keep_one(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item."""
    items = table(spark, sf_dir, "benchmark").select("item_id", "text")
    leaks = decontamination.find_leaks(docs, items).select(F.col("doc").alias("__doc"), F.col("same").alias("__same"))
    leaks = checkpoint(leaks.distinct())
    same = F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.xxhash64("text") == F.col("__same"))
    return docs.join(broadcast_if_small(leaks, leaks.count(), decontamination.BROADCAST_FINDS), same, "left_anti")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each copy that the mix takes: the document's columns and size, source_size, target, copy, taken.

    ``taken`` is the row's words, so its sums are the words taken. Rows that agree in id, source
    and text are one document with the copies of all. Input columns with the names of what is made
    here give way to it.
    """
    key = F.struct("doc_id", "source", F.xxhash64("text").alias("same"))
    plan = mixing.mix(docs.select(key.alias("doc_id"), "text", "source")).select(
        F.col("doc_id.doc_id").alias("__doc"), F.col("doc_id.source").alias("__source"), F.col("doc_id.same").alias("__same"),
        "size", "source_size", "target", "copies",
    )
    per = plan.groupBy("__doc", "__source", "__same", "size", "source_size", "target")
    per = per.agg(F.sum("copies").alias("__copies"), F.count(F.lit(1)).alias("__rows"))
    same = (
        F.col("doc_id").eqNullSafe(F.col("__doc")) & F.col("source").eqNullSafe(F.col("__source")) & (F.xxhash64("text") == F.col("__same"))
    )
    repeated = not docs.groupBy("doc_id", "source", F.xxhash64("text")).count().where("count > 1").isEmpty()
    one = docs.dropDuplicates(["doc_id", "source", "text"]) if repeated else docs
    kept = one.select(*others(docs, "size", "source_size", "target", "copy", "taken"))
    taken = kept.join(per.where("__copies > 0"), same)
    return taken.select(
        *[F.col(f"`{c}`") for c in kept.columns], "size", "source_size", "target",
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies"))).alias("copy"), F.col("size").alias("taken"),
    )


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", benchmark),
    ("source mix", mix),
]

#: The Newton steps of the mix and the fingerprints have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages over the documents of sf_dir; what a stage wrote goes when the next one has."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        if k:
            _delete(spark, f"{folder}/{k - 1}")
    return docs
