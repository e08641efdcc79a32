"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

Over all labelled documents but those for calibration Spark counts in how many toxic and other ones
each word occurs. Words that are much more common in toxic ones make the lexicon; starts of six
letters that many such words share make the stems. A word must be in ``LEAST_TOXIC`` toxic
documents and in ``LEAST_SHARE`` of them, so there are at most as many as toxic documents have
different words on average, divided by that share. Features of a whole text are the densities of
lexicon and stems, the nearness of hits to second-person pronouns, capitals, punctuation and
obfuscation (text_features). Trees learn from a bounded sample of labelled documents
(``max_train``, those with the smallest hashes of their id),
and isotonic regression maps their rates to calibrated scores on a quarter of it, of which neither
trees nor lexicon know.

Null texts and texts without words have zero features and are scored like any other; very long
texts are read whole. Labels of ids that occur more than once are averaged and rounded, and all
rows with the id count in the lexicon, of which the trees learn from the text with the smallest hash; null ids are never labelled. Without labels of both kinds every score is
the share of label 1, or 0 without labels. Repeated rows get equal scores. Further columns are not
looked at. An empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text_features
from .common import broadcast_if_small, checkpoint, words

MAX_TRAIN = 12_000
TREES, DEPTH, STEP = 15, 4, 0.25
#: A word is in the lexicon if it is in so many toxic documents and this share of them at least, and so many times likelier there.
LEAST_TOXIC, LEAST_SHARE, LEAST_RATIO = 3, 0.002, 8.0
#: Labels are broadcast up to so many rows of about 20 bytes, and joined by a shuffle beyond.
BROADCAST_LABELS = 500_000


def _tokens(text):
    bare = F.transform(words(text), lambda w: F.lower(F.btrim(w, F.lit(text_features._EDGE))))
    return F.array_distinct(F.filter(bare, lambda w: F.length(w) > 1))


def lexicon(known: DataFrame) -> tuple[dict[str, float], dict[str, float]]:
    """Words and stems with the logarithms of how much likelier they are in toxic texts, from (text, label)."""
    n, toxic = known.agg(F.count(F.lit(1)), F.sum("label")).first()
    if not n or not toxic or toxic == n:
        return {}, {}

    bare = _tokens(F.col("text"))
    starts = F.array_distinct(F.transform(F.filter(bare, lambda w: F.length(w) > 6), lambda w: F.left(w, F.lit(6))))
    marked = lambda kind, tokens: F.transform(tokens, lambda w: F.struct(F.lit(kind).alias("stem"), w.alias("w")))
    # words and stems of a text are counted in one pass
    seen = known.select("label", F.explode(F.concat(marked(False, bare), marked(True, starts))).alias("x")).groupBy("x").agg(
        F.sum("label").alias("t"), F.sum(1 - F.col("label")).alias("o")
    )
    ratio = ((F.col("t") + 0.5) / (toxic + 1.0)) / ((F.col("o") + 0.5) / (n - toxic + 1.0))
    often = F.col("t") >= max(LEAST_TOXIC, LEAST_SHARE * toxic)
    rows = seen.withColumn("ratio", ratio).where(often & (F.col("ratio") >= LEAST_RATIO)).select("x.stem", "x.w", "ratio").collect()
    return tuple({r["w"]: math.log(r["ratio"]) for r in rows if r["stem"] == kind} for kind in (False, True))


def _features(lexicon_, stems):
    def run(batches):
        for batch in batches:
            rows = [text_features.toxicity(x, lexicon_, stems) for x in batch.column("text").to_pylist()]
            kept = [batch.column(i) for i, n in enumerate(batch.schema.names) if n != "text"]
            names = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(rows, pa.list_(pa.float64()))], names=[*names, "x"])

    return run


def featured(rows: DataFrame, words_: dict, stems: dict) -> DataFrame:
    """rows (text, ...) with the array column x for text."""
    schema = rows.drop("text").withColumn("x", F.array().cast("array<double>")).schema
    return rows.mapInArrow(_features(words_, stems), schema)


def _calibrator(boundaries, values):
    """Linear between the boundaries that isotonic regression found, as Spark's own model predicts."""
    b, v = np.array(boundaries), np.array(values)

    @F.pandas_udf("double")
    def score(rate):
        import pandas as pd

        return pd.Series(np.clip(np.interp(rate.to_numpy(), b, v), 0.0, 1.0))

    return score


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col="doc_id", text="text", label="toxic", max_train: int = MAX_TRAIN) -> DataFrame:
    """(id, score) for every row of docs. labels: (id, label 0 or 1) of the rows to learn from."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("text"))
    given = labels.select(F.col(f"`{id_col}`").alias("of"), F.col(f"`{label}`").alias("label")).where("label IS NOT NULL AND of IS NOT NULL")
    given = checkpoint(given.groupBy("of").agg(F.round(F.avg("label")).cast("int").alias("label")))
    held = F.pmod(F.xxhash64("id", F.lit("calibrate")), F.lit(4)) == 0
    labelled = rows.join(broadcast_if_small(given, given.count(), BROADCAST_LABELS), F.col("id") == F.col("of")).select("id", "text", "label")
    chosen = given.orderBy(F.xxhash64("of"), "of").limit(max_train)
    # of the texts of one id the one with the smallest hash, so that reruns learn from the same
    first = F.min(F.struct(F.xxhash64("text").alias("same"), "text", "label")).alias("x")
    known = checkpoint(rows.join(F.broadcast(chosen), F.col("id") == F.col("of")).groupBy("id").agg(first).select("id", "x.text", "x.label"))
    counts = {(r["held"], r["label"]): r["n"] for r in known.groupBy(held.alias("held"), "label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts.get((False, 0)) or not counts.get((False, 1)):
        n = sum(counts.values())
        share = sum(v for k, v in counts.items() if k[1] == 1) / n if n else 0.0
        return rows.select(F.col("id").alias(id_col), F.lit(share).alias("score"))
    words_, stems = lexicon(labelled.where(~held).select("text", "label"))
    vector = array_to_vector("x").alias("features")
    table = checkpoint(featured(known.select("label", held.alias("held"), "text"), words_, stems))
    table = table.select("held", F.col("label").cast("double").alias("label"), vector)
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=11, subsamplingRate=1.0).fit(table.where(~F.col("held")))
    rate = vector_to_array("probability")[1]
    fitted = model.transform(table.where(F.col("held") if counts.get((True, 0)) and counts.get((True, 1)) else F.lit(True)))
    # equal rates are one point with their mean and weight, as many texts may have one rate
    points = fitted.groupBy(rate.alias("rate")).agg(F.avg("label").alias("label"), F.count(F.lit(1)).cast("double").alias("weight"))
    isotonic = IsotonicRegression(labelCol="label", featuresCol="rate", weightCol="weight").fit(points)
    score = _calibrator(isotonic.boundaries.toArray().tolist(), isotonic.predictions.toArray().tolist())
    scored = model.transform(featured(rows, words_, stems).select("id", vector))
    return scored.select(F.col("id").alias(id_col), score(rate).alias("score"))
