"""Language ID, hierarchical: first the family, then one-versus-one linear support vector machines in it.

Texts become square roots of the shares of hashed byte bigrams and trigrams. Linear support
vector machines are trained by Spark on a bounded sample of labelled texts (``max_train`` of each
language, those with the smallest hashes, equal texts once): one for each family against the rest, and within a family one
for each pair of languages. A text goes to the family with the largest margin; there the
language with the most pairwise wins is taken, ties going to the larger sum of margins and then
to the first name. The score is the logistic function of the smallest margin on the way.

Families come from ``FAMILIES``; languages it does not name form families of their own. Null
texts and texts without letters are ``und`` with score 0; very long texts are read whole. A single learned language is given to
every other text with score 1; without labels all texts are ``und``. Null labels teach nothing.
Ids are only handed on, so null and repeated ones do no harm. Repeated rows get equal results.
Further columns are not looked at. An empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LinearSVC
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpoint, stratified
from .text_features import ngrams

MAX_TRAIN = 1_500
STEPS, REGULARISATION = 25, 1e-3
UNKNOWN = "und"
#: Fixed table: families of languages by their codes.
FAMILIES = {
    "romance": "fr es it pt ro ca gl oc".split(),
    "germanic": "en de nl sv da no nb nn is af fy".split(),
    "slavic": "ru uk be pl cs sk bg sr hr sl mk bs".split(),
    "indic": "hi bn mr gu pa or as ne sa ur".split(),
    "dravidian": "ta te kn ml".split(),
}
_FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes}


def family(lang: str) -> str:
    return _FAMILY.get(lang.lower().split("-")[0], f"of {lang}")


def _vectors(batches):
    for batch in batches:
        rows = [ngrams(x) for x in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(rows, pa.list_(pa.float32()))], names=["lang", "x"])


def _svm(rows: DataFrame, positive) -> tuple[np.ndarray, float]:
    """Weights and intercept of a machine for the rows where positive holds against the rest."""
    table = rows.select(positive.cast("double").alias("label"), "features")
    model = LinearSVC(maxIter=STEPS, regParam=REGULARISATION, standardization=False, aggregationDepth=2).fit(table)
    return model.coefficients.toArray(), float(model.intercept)


class Machines:
    """The trained machines as matrices, small enough to travel with the tasks."""

    def __init__(self, langs: list[str], families: dict, pairs: dict):
        self.langs = langs
        self.groups = {f: sorted(x for x in langs if family(x) == f) for f in sorted({family(x) for x in langs})}
        self.families = sorted(families)
        self.family_w = np.stack([families[f][0] for f in self.families]) if families else None
        self.family_b = np.array([families[f][1] for f in self.families]) if families else None
        self.pairs = pairs

    def predict(self, x: np.ndarray | None) -> tuple[str, float]:
        if x is None or not self.langs:
            return UNKNOWN, 0.0
        margin = np.inf
        group = next(iter(self.groups))
        if self.family_w is not None:
            values = self.family_w @ x + self.family_b
            best = int(values.argmax())
            group = self.families[best]
            others = np.delete(values, best)
            margin = float(values[best] - others.max()) / 2 if len(others) else float(values[best])
        langs = self.groups[group]
        wins, sums, own = dict.fromkeys(langs, 0), dict.fromkeys(langs, 0.0), {}
        for a, b in combinations(langs, 2):
            w, c = self.pairs[a, b]
            value = float(w @ x + c)
            own[a, b] = value
            wins[a if value > 0 else b] += 1
            sums[a] += value
            sums[b] -= value
        lang = min(langs, key=lambda k: (-wins[k], -sums[k], k))
        for (a, b), value in own.items():
            if lang in (a, b):
                margin = min(margin, value if lang == a else -value)
        return lang, 1.0 if margin == np.inf else float(1 / (1 + np.exp(-np.clip(4 * margin, -40, 40))))


def train(docs: DataFrame, text="text", lang="lang", max_train: int = MAX_TRAIN) -> Machines:
    """Machines from the rows of docs with a language."""
    whole = F.col(f"`{text}`")
    rows = docs.select(F.xxhash64(whole).alias("same"), whole.alias("text"), F.col(f"`{lang}`").alias("lang")).where("lang IS NOT NULL")
    chosen = stratified(rows.select("lang", "same"), "lang", "same", max_train)
    sample = rows.join(F.broadcast(chosen), ["lang", "same"]).dropDuplicates(["lang", "same"]).select("lang", "text")
    table = checkpoint(sample.mapInArrow(_vectors, "lang string, x array<float>").where("x IS NOT NULL"))
    langs = sorted(r["lang"] for r in table.select("lang").distinct().collect())
    table = table.select("lang", array_to_vector(F.col("x").cast("array<double>")).alias("features"))
    groups = sorted({family(x) for x in langs})
    families = {}
    if len(groups) > 1:
        for f in groups if len(groups) > 2 else groups[:1]:
            families[f] = _svm(table, F.col("lang").isin([x for x in langs if family(x) == f]))
        if len(groups) == 2:
            w, b = families[groups[0]]
            families[groups[1]] = (-w, -b)
    pairs = {
        (a, b): _svm(table.where(F.col("lang").isin(a, b)), F.col("lang") == a)
        for f in groups
        for a, b in combinations([x for x in langs if family(x) == f], 2)
    }
    return Machines(langs, families, pairs)


def predict(docs: DataFrame, machines: Machines, id_col="doc_id", text="text") -> DataFrame:
    """(id, lang_pred, score) for every row of docs."""

    def run(batches):
        for batch in batches:
            found = [machines.predict(ngrams(x)) for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())],
                names=["id", "lang_pred", "score"],
            )

    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("text"))
    schema = rows.select("id", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)
