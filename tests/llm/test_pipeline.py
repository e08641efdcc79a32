"""The corpus pipeline: its form, its decisions on planted cases, and odd inputs."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline

WORDS = [a + b for a in ("ta", "ro", "mi", "ne", "lu", "ka", "so") for b in ("ber", "gan", "sil", "tor", "vex", "dum", "pit")]


def prose(rnd, n):
    return "\n".join(" ".join(rnd.choice(WORDS) + str(rnd.randrange(99)) for _ in range(20)).capitalize() + "." for _ in range(n))


def rows():
    rnd = random.Random(1)
    item = " ".join(rnd.choice(WORDS) + "x" for _ in range(30)) + "."
    passage = " ".join(rnd.choice(WORDS) + "y" for _ in range(60)) + "."
    out = [(i, prose(rnd, 8), "en", f"s{i % 4}") for i in range(40)]
    out += [(100, out[0][1], "en", "s1")]  # an exact copy
    out += [(101, out[1][1].replace(out[1][1].split()[5], "other"), "en", "s1")]  # a near copy, its lines mostly repeated
    out += [(102, prose(rnd, 6) + "\n" + item, "en", "s2")]  # a leak
    out += [(k, prose(rnd, 6) + "\n" + passage + "\n" + prose(rnd, 2), "en", "s3") for k in (103, 104)]
    out += [(105, "Home | News | About | More\n" * 30, "en", "s0"), (106, None, None, None), (107, "", "en", "s0"), (None, prose(rnd, 7), "en", None)]
    return out, item, passage


@pytest.fixture(scope="module")
def data(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("sf")
    docs, item, passage = rows()
    schema = "doc_id long, text string, lang string, source string"
    frame = spark.createDataFrame(docs, schema).withColumn("n_chars", F.length("text").cast("long"))
    frame.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), {d[0]: d[1] for d in docs}, passage


def test_form():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "near duplicates", "benchmark decontamination", "source mix"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_decisions(spark, data, tmp_path):
    folder, texts, passage = data
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        if k < 4:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            assert docs.where("n_chars <> length(text)").count() == 0
        seen[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
    clean = set(range(40)) | {None}
    assert clean | {100, 101, 102, 103, 104} == seen["quality rules"].keys()
    assert all(seen["quality rules"][i] == texts[i] for i in clean)
    lines = seen["line dedup"]
    assert lines.keys() == seen["quality rules"].keys() and lines[100] == "" and passage in lines[103] and passage not in lines[104]
    assert all(lines[i] == texts[i] for i in clean)
    assert clean <= seen["near duplicates"].keys() and 102 in seen["near duplicates"]
    assert 102 not in seen["benchmark decontamination"] and clean <= seen["benchmark decontamination"].keys()
    mixed = docs.groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target"), F.max("copy").alias("most")).collect()
    assert all(r["most"] <= 2 and abs(r["taken"] - r["target"]) <= max(0.2 * r["target"], 200) for r in mixed)
    run = corpus_pipeline.run(spark, folder)
    assert sorted((r["doc_id"] or -1, r["copy"]) for r in run.collect()) == sorted((r["doc_id"] or -1, r["copy"]) for r in docs.collect())


def test_odd_tables(spark, data):
    folder = data[0]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    odd = docs.limit(6).withColumns({"quality": F.lit(1), "Line_Dedup": F.lit(2), "leaks": F.lit("x"), "size": F.lit(3), "a.b": F.lit(4), "fp": F.lit(5)})
    odd = odd.unionByName(odd.limit(2))
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, odd, folder)
        assert set(odd.columns) <= set(out.columns) and out.count() > 0
        assert stage(spark, odd.limit(0), folder).count() == 0


def test_near_copies_of_jaccard_go(spark, data):
    rnd = random.Random(4)
    clean = [prose(rnd, 8) for _ in range(12)]
    near = []
    for text in clean[:6]:  # 160 words, three changed: five-word Jaccard of 0.82 or more
        at = text.split(" ")
        for k in (30, 70, 110):
            at[k] = f"other{k}"
        near.append(" ".join(at))
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(clean + near)] + [(None, prose(rnd, 8), "en", "s", 1) for _ in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    kept = [r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, data[0]).collect()]
    assert sorted(k for k in kept if k is not None) == list(range(12)) and kept.count(None) == 4
