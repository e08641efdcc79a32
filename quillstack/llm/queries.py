"""The queries opN_<name>: each applies one operator, with production parameters, to a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    decontamination,
    doc_prints,
    html_extract,
    language_id,
    line_dedup,
    merkle,
    mixing,
    quality_model,
    quality_rules,
    simhash,
    toxicity,
    url_filter,
    vector_codes,
)
from .common import table
from .oracles import ORACLES

URL_RULES = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)


def _held_out(parts: int, part: int):
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(parts)) == part, F.lit(False))


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_pages(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lines", "n_bad_lines", "lost_chars")
    return quality_rules.judge(docs).select("doc_id", *[F.col(f"quality.{n}").alias(n) for n in names])


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken", "copies")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").where(~_held_out(3, 1))
    scored = toxicity.score_toxicity(docs, labels)
    return scored.select("doc_id", _held_out(3, 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", simhash.as_hex(F.col("fp")).alias("fingerprint"), F.col("component").alias("component_id"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select(
        "doc_id", *[F.col(f"line_dedup.{n}").alias(n) for n in ("text", "n_lines", "n_deleted")]
    )


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    items = table(spark, sf_dir, "benchmark").select("item_id", "text")
    found = decontamination.decontaminate(docs, items)
    ids = F.coalesce(F.array_join(F.transform("leaks.items", lambda x: x.cast("string")), ","), F.lit(""))
    return found.select("doc_id", "leaks.contaminated", "leaks.n_items", ids.alias("items"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    pairs = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(x).alias("label")) for r, x in URL_RULES])
    rules = spark.range(1).select(F.inline(pairs))  # made in the JVM, without Python workers
    return url_filter.judge_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict", "blocked")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    machines = language_id.train(docs.where(~_held_out(4, 2)))
    found = language_id.predict(docs.select("doc_id", "text"), machines)
    return found.select("doc_id", _held_out(4, 2).alias("held_out"), "lang_pred", "score")


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality").where(~_held_out(4, 2))
    scored = quality_model.score_quality(docs, labels)
    return scored.select("doc_id", _held_out(4, 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    coded, books = vector_codes.compress(vectors)
    return coded.select("vec_id", "code", "error", "label_error", F.lit(books.sha256).alias("codebooks_sha256"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    edited = F.when(hit & F.contains("text", F.lit("\n")), F.translate("text", "\n", ""))
    found = merkle.manifest(merkle.leaves(docs, edited=edited))
    again = merkle.folded(F.coalesce("tampered", "leaf"), F.col("path"))
    return found.select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof_sha256"),
        again.alias("folded_root"), (again == F.col("root")).alias("verified"),
    )


def op13_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doc_prints.print_and_compare(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_html_extraction,
        op2_quality_rules,
        op3_mixing,
        op4_toxicity,
        op5_simhash,
        op6_line_dedup,
        op7_decontamination,
        op8_url_filter,
        op9_language_id,
        op10_quality_classifier,
        op11_vector_codes,
        op12_merkle_manifest,
        op13_document_fingerprints,
    )
}


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict:
    return dict(ORACLES)
