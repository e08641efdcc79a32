"""Vector codes, Merkle manifests and document fingerprints against brute force."""

import hashlib
import math
import random
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from quillstack.llm import doc_prints, merkle, queries, vector_codes

# ---- vector codes


def codes_by_hand(rows, rounds=2):
    """{position: (code, error, label_error)} and the codebooks' digest, in Python integers."""
    kept = [(k, i, v, x) for k, (i, v, x) in enumerate(rows) if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    size = max(1, math.ceil(max((len(v) for _, _, v, _ in kept), default=0) / 16)) * 16
    width = size // 16
    vectors = [[math.floor(256 * c) for c in v] + [0] * (size - len(v)) for _, _, v, _ in kept]
    order = sorted(range(len(kept)), key=lambda k: (kept[k][1] is None, kept[k][1] or 0, vectors[k]))[:64]
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[cut(vectors[k], p) for k in order] for p in range(16)]
    gap = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda v, p: min((gap(cut(v, p), e), k) for k, e in enumerate(books[p]))
    for _ in range(rounds):
        books = [
            [
                [sum(col) // len(own) for col in zip(*own)] if (own := [cut(v, p) for v in vectors if near(v, p)[1] == k]) else e
                for k, e in enumerate(books[p])
            ]
            for p in range(16)
        ]
    found = [[near(v, p) for p in range(16)] for v in vectors]
    errors = [sum(d for d, _ in f) for f in found]
    total = lambda x: sum(e for e, (*_, y) in zip(errors, kept) if y == x)
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return sorted((str(i), "".join(f"{k:02x}" for _, k in f), e, total(x)) for (_, i, _, x), f, e in zip(kept, found, errors)), sha


KINDS = "vec_id long, embedding array<float>, label int, code string, error int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, x, "own", 7) for i, v, x in rows], KINDS)


def coded(df):
    out, books = vector_codes.compress(df)
    return sorted((str(r["vec_id"]), r["code"], r["error"], r["label_error"]) for r in out.collect()), books.sha256


def single(x):
    return float(np.float32(x))


def test_vector_codes_match_brute_force(spark):
    rnd = random.Random(3)
    rows = [(k * 7 % 150, [single(rnd.gauss(k % 5 * 0.2, 0.1)) for _ in range(32)], rnd.choice([None, 1, 2])) for k in range(150)]
    rows += [rows[3]] * 40 + [(None, rows[5][1], None), (None, [single(-0.3)] * 32, 2), (rows[0][0], [0.0] * 32, 1)]
    rows += [(900, None, 1), (901, [None] + [0.5] * 31, 1), (902, [math.nan] * 32, 1), (903, [math.inf] + [0.0] * 31, None), (904, [-math.inf] * 32, 2)]
    want = codes_by_hand(rows)
    for n in (1, 5):
        assert coded(vectors(spark, rows).repartition(n)) == want


def test_vector_codes_edges(spark):
    empty = vectors(spark, [(1, None, 1), (2, [math.nan], 1)])
    assert coded(empty) == ([], hashlib.sha256(b"").hexdigest()) and coded(empty.limit(0))[0] == []
    odd = [(k, [single(k / 3 + j) for j in range(5 + 12 * (k % 3))], None) for k in range(9)] + [(9, [], 4)]
    assert coded(vectors(spark, odd)) == codes_by_hand(odd)  # lengths that 16 doesn't divide are filled up
    far = [(1, [single(3e5), 0.0], 1), (2, [single(-3e5), 1.0], 1), (3, [0.0, 0.0], 2)]
    assert coded(vectors(spark, far)) == codes_by_hand(far)
    held, _ = coded(vectors(spark, [(1, [3e38, 1.0], 1), (2, [-3e38, 1.0], 1)]))
    assert [r[2] for r in held] == [0, 0]


def test_vector_codes_ties_go_to_the_lower_entry(spark):
    rows = [(k, [float(x)] * 16, 1) for k, x in enumerate([0, 0, 2, 1])]
    got, _ = coded(vectors(spark, rows))
    assert [r[1][:2] for r in got] == ["00", "00", "02", "03"]
    assert (got, _) == codes_by_hand(rows)


def test_vector_blocks_decode_and_hot_labels(spark, monkeypatch):
    monkeypatch.setattr(vector_codes, "BLOCK", 64)
    monkeypatch.setattr(vector_codes, "BROADCAST_LABELS", 0)
    rnd = random.Random(5)
    rows = [(k, [single(rnd.random()) for _ in range(16)], None if k % 3 else k) for k in range(90)]
    df = vectors(spark, rows).repartition(2)
    want = codes_by_hand(rows)
    assert coded(df) == want
    out, books = vector_codes.compress(df)
    whole = {r["vec_id"]: r for r in vector_codes.decode(out, books).collect()}
    for i, v, _ in rows:
        gaps = [math.floor(256 * a) - 256 * b for a, b in zip(v, whole[i]["decoded"])]
        assert sum(round(g) ** 2 for g in gaps) == whole[i]["error"]


# ---- Merkle manifests


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree_by_hand(leaves):
    """(top, the steps (before, after) of each leaf)."""
    level, at = list(leaves), list(range(len(leaves)))
    steps = [[] for _ in leaves]
    while len(level) > 1:
        runs = [level[k : k + 3] for k in range(0, len(level), 3)]
        for leaf, k in enumerate(at):
            run = runs[k // 3]
            steps[leaf].append(("".join(run[: k % 3]), "".join(run[k % 3 + 1 :])))
        at = [k // 3 for k in at]
        level = [sha(*run) for run in runs]
    return level[0], steps


def leaf_by_hand(row):
    return sha(*["-" if x is None else f"{len(str(x).encode())}:{x}" for x in row])


def manifest_by_hand(rows):
    """The rows of op12 for (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    trees = {}
    for g, own in groups.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_by_hand(r)))
        trees[g] = tree_by_hand([leaf_by_hand(r) for r in own])
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    root, upper = tree_by_hand([trees[g][0] for g in names])
    out = []
    for g, above in zip(names, upper):
        for row, own in zip(groups[g], trees[g][1]):
            steps = own + above
            i, s, lang, n, text = row
            if i is not None and text is not None and zlib.crc32(str(i).encode()) % 2 == 0:
                text = text.replace("\n", "")
            h = leaf_by_hand((i, s, lang, n, text))
            for before, after in steps:
                h = sha(before, h, after)
            out.append((i, leaf_by_hand(row), trees[g][0], root, sha(*[x for step in steps for x in step]), h, h == root))
    return sorted(out, key=str)


DOCS = "doc_id long, source string, lang string, n_chars long, text string"
OP12 = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def manifest_of(spark, tmp_path, rows, parts=3):
    spark.createDataFrame([(*r, 1, "x") for r in rows], DOCS + ", leaf int, path string").repartition(parts).write.parquet(f"{tmp_path}/documents.parquet")
    return sorted((tuple(r[c] for c in OP12) for r in queries.op12_merkle_manifest(spark, str(tmp_path)).collect()), key=str)


def test_merkle_manifest_matches_brute_force(spark, tmp_path):
    rnd = random.Random(8)
    rows = [(k, rnd.choice(["a", "a", "b", None, "é", "ab"]), rnd.choice(["en", None, ""]), rnd.choice([None, k]), f"line {k}\nmore\n" * (k % 4)) for k in range(120)]
    rows += [(200 + k, "one" + str(k), None, 0, None) for k in range(4)]  # groups of one leaf
    rows += [(5, "a", "en", 1, "other"), (None, "a", None, None, None), (None, None, None, None, "\n"), (300, "a", "-", 0, "é\n" * 50_000)]
    rows += [rows[7]] * 5 + [(None, "b", None, None, None)] * 4
    assert manifest_of(spark, tmp_path, rows) == manifest_by_hand(rows)


@pytest.mark.parametrize("n", [0, 1, 4])
def test_merkle_manifest_of_few(spark, tmp_path, n):
    rows = [(k, "s", "en", 2, "a\nb") for k in range(n)]
    assert manifest_of(spark, tmp_path, rows, 1) == (manifest_by_hand(rows) if n else [])


def test_merkle_shuffles_beyond_its_broadcasts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(merkle, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(merkle, "BROADCAST_PATHS", 0)
    rows = [(k, f"s{k % 11}" if k % 3 else "hot", "en", k, f"t{k}\n") for k in range(200)]
    assert manifest_of(spark, tmp_path, rows) == manifest_by_hand(rows)


def test_merkle_equal_rows_spread_over_partitions(spark):
    rows = spark.range(5000).select(F.lit("g").alias("g"), F.lit(1).alias("id"), F.lit("h").alias("leaf"), F.lit(None).cast("string").alias("tampered"))
    placed = merkle.placed(rows)
    assert sorted(r["i"] for r in placed.select("i").collect()) == list(range(5000))
    assert placed.rdd.glom().map(len).max() < 3000


# ---- document fingerprints


def shingles_by_hand(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def jaccard(a, b):
    x, y = shingles_by_hand(a), shingles_by_hand(b)
    return len(x & y) / len(x | y) if x | y else 1.0


def prose(rnd, n):
    return " ".join("w" + str(rnd.randrange(5000)) for _ in range(n))


def test_fingerprints_estimate_the_jaccard_similarity():
    rnd = random.Random(11)
    gaps = []
    for _ in range(150):
        words = prose(rnd, rnd.choice([6, 30, 200, 3000])).split()
        cut = rnd.randrange(len(words) + 1)
        a, b = " ".join(words), " ".join(words[:cut] + prose(rnd, len(words) - cut).split())
        gaps.append(doc_prints.likeness(doc_prints.fingerprint(a), doc_prints.fingerprint(b)) - jaccard(a, b))
    assert max(map(abs, gaps)) < 0.13 and abs(np.mean(gaps)) < 0.01 and np.std(gaps) < 0.03


def test_fingerprints_of_unlike_short_texts_are_not_alike():
    rnd = random.Random(12)
    texts = [prose(rnd, n) for n in (1, 2, 4, 5, 6, 7, 9, 12) * 10]
    prints = [doc_prints.fingerprint(t) for t in texts]
    near = [doc_prints.likeness(a, b) for k, a in enumerate(prints) for b in prints[:k]]
    assert max(near) < 0.08
    assert doc_prints.likeness(doc_prints.fingerprint("a b"), doc_prints.fingerprint("A  b\n")) == 1.0


def bins_by_hand(text):
    """The bins of a text, shingle by shingle, and each empty bin filled by asking the others in its order."""
    words = doc_prints.word_hashes(text)
    least = {}
    for k in range(max(1, len(words) - 4)):
        h = int(doc_prints.shingle_hashes(words[k : k + 5])[0])
        least[h >> 55] = min(h, least.get(h >> 55, 1 << 64))
    return [least.get(i) or least[min(least, key=lambda j: int(doc_prints._TURN[i, j]))] for i in range(512)]


def test_bins_and_densification_match_brute_force(monkeypatch):
    rnd = random.Random(13)
    texts = [prose(rnd, n) for n in (1, 4, 5, 6, 40, 900, 4000)]
    for small in (1 << 16, 64):  # very long texts come in pieces
        monkeypatch.setattr(doc_prints, "_CHUNK", small)
        for t in texts:
            assert doc_prints.densified(doc_prints.bins(doc_prints.word_hashes(t))).tolist() == bins_by_hand(t)
    for i in range(0, 512, 37):  # a fixed order of all bins for each
        assert len(set(doc_prints._TURN[i].tolist())) == 512


def compared_by_hand(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[2]))
    out = []
    for k, (i, text, _) in enumerate(order):
        text, after = text or "", order[(k + 1) % len(order)][1] or ""
        n = len(text) // 3
        changed = text[: len(text) - n] + after[:n]
        p, q, r = map(doc_prints.fingerprint, (text, changed, after))
        out.append((i, len(text), hashlib.sha256(changed.encode()).hexdigest(), p.hex(), q.hex(), doc_prints.likeness(p, q), doc_prints.likeness(p, r)))
    return sorted(out, key=str)


OP13 = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def hashed(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return [(r["doc_id"], r["text"], r["same"]) for r in df.withColumn("same", F.xxhash64("text")).collect()]


@pytest.mark.parametrize("batch", ["10000", "3"])
def test_document_fingerprints_match_brute_force(spark, batch):
    rnd = random.Random(14)
    rows = [(k, prose(rnd, rnd.choice([0, 1, 3, 20, 100]))) for k in range(60)]
    rows += [(100, None), (101, ""), (102, " \n\t "), (103, "é" * 7 + " ü ö"), (104, "x " * 200_000), (None, "no id"), (None, None), (7, "other text of 7")]
    rows += [(50, "same row again")] * 30
    df = spark.createDataFrame([(*r, "f", 1) for r in rows], "doc_id long, text string, fingerprint string, part int").repartition(4)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = sorted((tuple(r[c] for c in OP13) for r in doc_prints.print_and_compare(df).collect()), key=str)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == compared_by_hand(hashed(spark, rows))
    kept = doc_prints.fingerprints(df, out="Fingerprint")
    assert kept.columns == ["doc_id", "text", "part", "Fingerprint"] and kept.count() == len(rows)


@pytest.mark.parametrize("n", [0, 1])
def test_document_fingerprints_of_few(spark, n):
    rows = [(k, f"just some words of row {k}") for k in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r[c] for c in OP13) for r in doc_prints.print_and_compare(df).collect()), key=str)
    assert got == compared_by_hand(hashed(spark, rows))


def test_op13_over_the_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = sorted((tuple(r[c] for c in OP13) for r in queries.op13_document_fingerprints(spark, sf).collect()), key=str)
    assert got == compared_by_hand(hashed(spark, rows))


@pytest.mark.parametrize("name", ["op11_vector_codes", "op12_merkle_manifest"])
def test_sql_gives_the_same(spark, name):
    sf = "/root/testdata/sf0.001"
    db = duckdb.connect()
    for t in ("embeddings", "documents"):
        db.sql(f"CREATE VIEW {t} AS FROM '{sf}/{t}.parquet'")
    want = db.sql(queries.oracle_sql()[name]).df()
    got = queries.queries()[name](spark, sf).toPandas()
    assert sorted(got.columns) == sorted(want.columns)
    as_rows = lambda df: sorted(map(str, df[sorted(df.columns)].astype(object).itertuples(index=False, name=None)))
    assert as_rows(got) == as_rows(want)
