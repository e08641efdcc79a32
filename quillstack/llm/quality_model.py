"""Quality classifier: a regularised quadratic discriminant over transformed document statistics.

Each class of labelled documents is a normal distribution of the statistics in text_features.
Means and covariances come from one Spark aggregation over all labelled rows, not a sample. A
class covariance is shrunk towards the one of both classes together and that towards its
diagonal, so it has a Cholesky factor even for few rows. The factors are computed once, sent
with the scoring tasks, and give both the Mahalanobis distance and the determinant. The score is
the logistic function of the difference of the two log-densities, tempered, plus the prior.

Null texts and texts without words are scored like any other, from the statistics of no words.
Labels of ids that occur more than once are averaged and rounded. Without labels of both kinds
every score is the share of label 1, or 0.5 without labels. Repeated rows get equal scores. Very long
texts are read whole. Null ids are never labelled and are scored; further columns are not looked at. An
empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text_features
from .common import checkpoint

SHRINK_TO_POOLED, SHRINK_TO_DIAGONAL, RIDGE = 0.2, 0.1, 1e-3
#: Log-density differences are divided by this before the logistic function.
TEMPER = 8.0


def _statistics(batches):
    for batch in batches:
        rows = [text_features.quality(x) for x in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(rows, pa.list_(pa.float64()))], names=["id", "x"])


def statistics(docs: DataFrame, id_col="doc_id", text="text") -> DataFrame:
    """(id, x): the statistics of every row."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("text"))
    schema = docs.select(F.col(f"`{id_col}`").alias("id"), F.array().cast("array<double>").alias("x")).schema
    return rows.mapInArrow(_statistics, schema)


def fit(known: DataFrame, size: int):
    """Class parameters from (x, label): a list of (log prior, mean, Cholesky factor, log-determinant), or a constant score."""
    x = [F.col("x")[i] for i in range(size)]
    sums = [F.sum(v).alias(f"s{i}") for i, v in enumerate(x)]
    products = [F.sum(x[i] * x[j]).alias(f"p{i}_{j}") for i in range(size) for j in range(i + 1)]
    rows = {r["label"]: r for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n"), *sums, *products).collect()}
    n = {k: rows[k]["n"] if k in rows else 0 for k in (0, 1)}
    if not n[0] or not n[1]:
        return n[1] / (n[0] + n[1]) if n[0] + n[1] else 0.5
    mean, scatter = {}, {}
    for k in (0, 1):
        mean[k] = np.array([rows[k][f"s{i}"] for i in range(size)]) / n[k]
        second = np.zeros((size, size))
        for i in range(size):
            for j in range(i + 1):
                second[i, j] = second[j, i] = rows[k][f"p{i}_{j}"]
        scatter[k] = second - n[k] * np.outer(mean[k], mean[k])
    pooled = (scatter[0] + scatter[1]) / max(1, n[0] + n[1] - 2)
    classes = []
    for k in (0, 1):
        own = scatter[k] / max(1, n[k] - 1)
        # the fewer rows a class has for its dimensions, the more it borrows
        share = max(SHRINK_TO_POOLED, size / (size + n[k]))
        cov = (1 - share) * own + share * pooled
        cov = (1 - SHRINK_TO_DIAGONAL) * cov + SHRINK_TO_DIAGONAL * np.diag(np.diag(cov)) + RIDGE * np.eye(size)
        factor = np.linalg.cholesky(cov)
        classes.append((float(np.log(n[k] / (n[0] + n[1]))), mean[k], factor, float(2 * np.log(np.diag(factor)).sum())))
    return classes


def _scorer(model):
    def run(batches):
        for batch in batches:
            ids = batch.column("id")
            if isinstance(model, float):
                score = np.full(len(ids), model)
            elif len(ids):
                x = np.stack(batch.column("x").to_numpy(zero_copy_only=False))
                density = []
                for prior, mean, factor, logdet in model:
                    z = np.linalg.solve(factor, (x - mean).T)
                    density.append((-0.5 * ((z * z).sum(axis=0) + logdet), prior))
                margin = (density[1][0] - density[0][0]) / TEMPER + density[1][1] - density[0][1]
                score = 1 / (1 + np.exp(-np.clip(margin, -40, 40)))
            else:
                score = np.zeros(0)
            yield pa.RecordBatch.from_arrays([ids, pa.array(score, pa.float64())], names=["id", "score"])

    return run


def score_quality(docs: DataFrame, labels: DataFrame, id_col="doc_id", text="text", label="quality") -> DataFrame:
    """(id, score) for every row of docs. labels: (id, label 0 or 1) of the rows to learn from."""
    stats = checkpoint(statistics(docs, id_col, text))
    given = labels.select(F.col(f"`{id_col}`").alias("of"), F.col(f"`{label}`").alias("label")).where("label IS NOT NULL")
    given = given.groupBy("of").agg(F.round(F.avg("label")).cast("int").alias("label"))
    known = stats.join(given, F.col("id") == F.col("of")).select("x", "label")
    model = fit(known, len(text_features.QUALITY_FEATURES))
    schema = stats.select("id").withColumn("score", F.lit(0.0)).schema
    return stats.mapInArrow(_scorer(model), schema).withColumnRenamed("id", id_col)
