"""The queries of the learned operators on a whole test table, against versions written out by hand."""

import math
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillstack.llm import language_id, quality_model, queries, text_features, toxicity
from quillstack.llm.common import stratified

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: (r["text"], r["lang"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def labels(spark):
    return {r["doc_id"]: (r["quality"], r["toxic"]) for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}


def part(doc_id, parts):
    return zlib.crc32(str(doc_id).encode()) % parts


def results(df, columns):
    rows = df.collect()
    assert set(columns) <= set(df.columns)
    out = {r["doc_id"]: r for r in rows}
    assert len(out) == len(rows)
    return out


def test_quality_is_the_shrunken_discriminant(spark, texts, labels):
    got = results(queries.op10_quality_classifier(spark, SF), ("doc_id", "held_out", "score", "predicted"))
    assert got.keys() == texts.keys()
    x = {i: np.array(text_features.quality(t)) for i, (t, _) in texts.items()}
    known = {k: np.array([x[i] for i, (q, _) in labels.items() if q == k and i in x and part(i, 4) != 2]) for k in (0, 1)}
    size, total = len(text_features.QUALITY_FEATURES), sum(map(len, known.values()))
    within = sum((len(v) - 1) * np.cov(v.T) for v in known.values()) / (total - 2)
    density = {}
    for k, v in known.items():
        share = max(quality_model.SHRINK_TO_POOLED, size / (size + len(v)))
        cov = (1 - share) * np.cov(v.T) + share * within
        mixed = (1 - quality_model.SHRINK_TO_DIAGONAL) * cov + quality_model.SHRINK_TO_DIAGONAL * np.diag(np.diag(cov)) + quality_model.RIDGE * np.eye(size)
        inverse, logdet = np.linalg.inv(mixed), np.linalg.slogdet(mixed)[1]
        density[k] = lambda y, m=v.mean(axis=0), a=inverse, d=logdet: -0.5 * ((y - m) @ a @ (y - m) + d)
    held = right = 0
    for i, r in got.items():
        margin = (density[1](x[i]) - density[0](x[i])) / quality_model.TEMPER + math.log(len(known[1]) / len(known[0]))
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-min(40, max(-40, margin)))), abs=1e-6)
        assert r["held_out"] == (part(i, 4) == 2) and r["predicted"] == int(r["score"] >= 0.7)
        if r["held_out"] and i in labels:
            held += 1
            right += r["predicted"] == labels[i][0]
    assert held > 50 and right >= 0.95 * held


def test_languages_are_voted_one_against_one(spark, texts):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = results(queries.op9_language_id(spark, SF), ("doc_id", "held_out", "lang_pred", "score"))
    machines = language_id.train(docs.where(~queries._held_out(4, 2)))
    assert machines.langs == ["de", "en", "es", "fr"] and set(machines.pairs) == {("de", "en"), ("es", "fr")}
    right = defaultdict(list)
    for i, (text, lang) in texts.items():
        v = text_features.ngrams(text)
        if v is None:
            want = ("und", 0.0)
        else:
            families = {f: sum(a * b for a, b in zip(machines.family_w[k].tolist(), v.tolist())) + machines.family_b[k] for k, f in enumerate(machines.families)}
            f, other = sorted(families, key=families.get, reverse=True)
            margins = [(families[f] - families[other]) / 2]
            votes = Counter()
            langs = {"germanic": ("de", "en"), "romance": ("es", "fr")}[f]
            for a, b in combinations(langs, 2):
                w, c = machines.pairs[a, b]
                value = float(w @ v + c)
                votes[a if value > 0 else b] += 1
                margins.append(abs(value))
            want = (votes.most_common(1)[0][0], 1 / (1 + math.exp(-4 * min(margins))))
        assert (got[i]["lang_pred"], got[i]["score"]) == (want[0], pytest.approx(want[1], abs=1e-4))
        if part(i, 4) == 2 and v is not None and lang:
            right[lang].append(want[0] == lang)
    assert all(sum(x) >= 0.97 * len(x) for x in right.values()) and len(right) == 4


def pooled(rates, y):
    """Isotonic regression by pooling neighbours that go down."""
    blocks = []
    for r, v in sorted(zip(rates, y)):
        if blocks and blocks[-1][0][-1] == r:
            blocks[-1][0].append(r)
            blocks[-1][1].append(v)
        else:
            blocks.append(([r], [v]))
    out = []
    for rs, vs in blocks:
        out.append([rs, vs])
        while len(out) > 1 and np.mean(out[-2][1]) >= np.mean(out[-1][1]):
            a, b = out.pop(), out.pop()
            out.append([b[0] + a[0], b[1] + a[1]])
    return {r: float(np.mean(vs)) for rs, vs in out for r in rs}


def test_calibration_is_isotonic(spark):
    rnd = np.random.default_rng(5)
    rates = rnd.random(200).round(2)
    y = (rnd.random(200) < rates**2).astype(float)
    rows = spark.createDataFrame([(float(a), float(b)) for a, b in zip(rates, y)], "rate double, label double")
    from pyspark.ml.regression import IsotonicRegression

    model = IsotonicRegression(labelCol="label", featuresCol="rate").fit(rows)
    score = toxicity._calibrator(model.boundaries.toArray().tolist(), model.predictions.toArray().tolist())
    got = {r["rate"]: r["s"] for r in rows.select("rate", score("rate").alias("s")).collect()}
    want = pooled(rates.tolist(), y.tolist())
    assert all(got[r] == pytest.approx(want[r], abs=1e-6) for r in want)


def test_toxicity_of_the_query(spark, texts, labels):
    got = results(queries.op4_toxicity(spark, SF), ("doc_id", "held_out", "score", "predicted"))
    assert got.keys() == texts.keys()
    assert all(r["held_out"] == (part(i, 3) == 1) and r["predicted"] == int(r["score"] >= 0.7) and 0 <= r["score"] <= 1 for i, r in got.items())
    held = [(got[i]["predicted"], t) for i, (_, t) in labels.items() if i in got and part(i, 3) == 1]
    caught = [p for p, t in held if t == 1]
    assert sum(caught) >= 0.8 * len(caught) and sum(p for p, t in held if t == 0) <= 0.02 * len(held)


def test_lexicon_counts_all_labelled_rows(spark, texts, labels):
    rows = [(texts[i][0], t) for i, (_, t) in labels.items() if i in texts and part(i, 3) != 1]
    words, stems = toxicity.lexicon(spark.createDataFrame(rows, "text string, label int"))
    seen = {0: Counter(), 1: Counter()}
    starts = {0: Counter(), 1: Counter()}
    n = Counter(t for _, t in rows)
    for text, t in rows:
        bare = {w for w in (text_features.plain(x) for x in re.findall(r"[^\x20\x09-\x0D]+", text or "")) if len(w) > 1}
        seen[t].update(bare)
        starts[t].update({w[:6] for w in bare if len(w) > 6})
    for got, counts in ((words, seen), (stems, starts)):
        want = {}
        for w, k in counts[1].items():
            ratio = ((k + 0.5) / (n[1] + 1)) / ((counts[0][w] + 0.5) / (n[0] + 1))
            if k >= max(toxicity.LEAST_TOXIC, toxicity.LEAST_SHARE * n[1]) and ratio >= toxicity.LEAST_RATIO:
                want[w] = math.log(ratio)
        assert got == pytest.approx(want) and want


def test_lexicon_has_no_cap_and_takes_long_words(spark):
    long = "x" * 60
    rows = [(" ".join(f"bad{k}q{j}" for j in range(5000)) + " " + long, 1) for k in (1, 1, 1)] + [("plain words only", 0)] * 30
    words, _ = toxicity.lexicon(spark.createDataFrame(rows, "text string, label int"))
    assert len(words) == 5001 and long in words


def test_samples_are_stratified(spark):
    rows = [("big", k) for k in range(5000)] + [("small", k) for k in range(7)] + [("big", 1)] * 3000
    df = spark.createDataFrame(rows, "label string, name long").repartition(6)
    got = stratified(df, "label", "name", 100).collect()
    assert Counter(r["label"] for r in got) == {"big": 100, "small": 7} and len({(r["label"], r["name"]) for r in got}) == 107
    assert sorted(got) == sorted(stratified(df.repartition(3), "label", "name", 100).collect())


def test_a_rare_language_is_learned(spark):
    rows = [(k, f"der die das und ist nicht ein eine {k}", "de") for k in range(3000)] + [(9000 + k, f"och att det som en på är av för {k}", "sv") for k in range(12)]
    rows += [(None, rows[0][1], "de")] * 2000
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    machines = language_id.train(docs, max_train=50)
    assert machines.langs == ["de", "sv"]
    found = language_id.predict(spark.createDataFrame([(1, "det som är av en"), (2, "und ist das die " * 20_000)], "doc_id long, text string"), machines)
    assert {r["doc_id"]: r["lang_pred"] for r in found.collect()} == {1: "sv", 2: "de"}
