"""Ingest as a stream and state with a lifetime."""

import datetime
import random

from pyspark.sql import functions as F

from quillstack.operators import ingest
from quillstack.streaming import feeds, ingest_stream, keyed_state

BATCH = "seq long, relurl string, identifier string, metadata string, malformed boolean, text string, html_sha256 string, metadata_sha256 string, has_pdf boolean"
STORED = ["relurl", "identifier", "html_sha256", "metadata_sha256", "has_pdf"]


def drawn(rnd, n):
    """A batch of rows whose urls and identifiers meet often."""
    rows = []
    for seq in range(n):
        k = rnd.randrange(6)
        url = rnd.choice(["a", "a", "b", "zz"]) + f"/{k}" if rnd.random() > 0.05 else "../bad"
        rows.append((seq, url, rnd.choice([None, *[f"i{url}"] * 9, *(f"ia/{j}" for j in range(3))]), rnd.choice(["{}", "{}", "{}", None]), rnd.random() < 0.1, rnd.choice(["t", "u", " "]), rnd.choice("hk"), "m", rnd.random() < 0.5))
    return rows


def folded(spark, batches, catalog):
    """The table and statuses of batches that are classified one after the other, whole tables at a time."""
    stored, statuses = spark.createDataFrame([], BATCH).select(*STORED), []
    for number, rows in enumerate(batches):
        found = ingest.classify(spark.createDataFrame(rows, BATCH), stored, catalog)
        kept = found.collect()
        statuses += [(number, r["seq"], r["status"], r["reason"]) for r in kept]
        table = {r["relurl"]: list(r) for r in ingest.merged(stored, found).collect()}
        for r in sorted(kept, key=lambda r: r["seq"]):  # what is unchanged passes on its flags
            if r["status"] in ("unchanged", "created", "updated") and r["relurl"] in table:
                table[r["relurl"]][4] = r["has_pdf"]
        stored = spark.createDataFrame(list(table.values()), stored.schema)
    return sorted(map(tuple, stored.collect())), sorted(statuses)


def held(spark, path):
    table = sorted(map(tuple, ingest_stream.gazettes(spark, path).select(*STORED).collect()))
    owners = sorted(map(tuple, ingest_stream.owners(spark, path).select("identifier", "relurl").collect()))
    statuses = sorted(map(tuple, ingest_stream.statuses(spark, path).select("batch", "seq", "status", "reason").collect()))
    return table, owners, statuses


def test_ingest_batches_equal_the_fold(spark, tmp_path):
    rnd = random.Random(21)
    batches = [drawn(rnd, n) for n in (30, 25, 30)]
    catalog, path = spark.createDataFrame([("a",), ("b",)], "name string"), str(tmp_path / "store")
    run = ingest_stream.ingest_batches(path, catalog, buckets=4)
    for number, rows in enumerate(batches):
        run(spark.createDataFrame(rows, BATCH), number)
        table, owners, statuses = held(spark, path)
        assert owners == sorted((r[1], r[0]) for r in table)  # identifiers that were given up have no owner
        if number == 1:  # a batch that comes again changes neither the tables nor the statuses
            run(spark.createDataFrame(rows, BATCH), number)
            assert held(spark, path) == (table, owners, statuses)
    table, _, statuses = held(spark, path)
    assert (table, statuses) == folded(spark, batches, catalog)
    assert {s[2] for s in statuses} == {"created", "updated", "unchanged", "skipped", "error"}


def test_ingest_stream_gives_up_identifiers(spark, tmp_path):
    path, catalog = str(tmp_path / "store"), spark.createDataFrame([("a",)], "name string")
    row = lambda seq, url, name, h="h": (seq, url, name, "{}", False, "t", h, "m", False)
    source = tmp_path / "in"
    source.mkdir()

    def arrive(rows):
        spark.createDataFrame(rows, BATCH).write.mode("append").parquet(str(source))
        stream = spark.readStream.schema(BATCH).parquet(str(source))
        query = stream.writeStream.foreachBatch(ingest_stream.ingest_batches(path, catalog, buckets=2)).option("checkpointLocation", str(tmp_path / "c"))
        query.trigger(availableNow=True).start().awaitTermination()
        return {r["seq"]: (r["status"], r["reason"]) for r in ingest_stream.statuses(spark, path).where(F.col("batch") == ingest_stream.statuses(spark, path).agg(F.max("batch")).first()[0]).collect()}

    assert arrive([row(1, "a/1", "x"), row(2, "a/2", "x"), row(3, "a/3", "y")]) == {1: ("created", None), 2: ("error", "identifier taken"), 3: ("created", None)}
    assert arrive([row(1, "a/1", "z", "h2"), row(2, "a/2", "x")]) == {1: ("updated", None), 2: ("error", "identifier taken")}
    assert arrive([row(2, "a/2", "x"), row(3, "a/3", "y")]) == {2: ("created", None), 3: ("unchanged", "same")}
    assert {(r["relurl"], r["identifier"]) for r in ingest_stream.gazettes(spark, path).collect()} == {("a/1", "z"), ("a/2", "x"), ("a/3", "y")}


def at(minutes):
    return datetime.datetime(2024, 1, 1) + datetime.timedelta(minutes=minutes)


def cached(spark, folder, arrivals, **settings):
    """Each arrival as a run of one resumed stream; the rows that each gives."""
    got = []
    for rows in arrivals:
        spark.createDataFrame(rows, "k string, t timestamp").write.mode("append").parquet(f"{folder}/in")
        stream = keyed_state.cached(feeds.parquet_feed(spark, f"{folder}/in", "k string, t timestamp", per_batch=100), "k", "t", **settings)
        out = []
        query = stream.writeStream.foreachBatch(lambda batch, number, out=out: out.extend(batch.collect())).option("checkpointLocation", f"{folder}/c")
        query.trigger(availableNow=True).start().awaitTermination()
        got.append(sorted((r["k"] or "~", int((r["t"] - at(0)).total_seconds() // 60), r["kind"]) for r in out))
    return got


def test_cached_keys_expire(spark, tmp_path):
    arrivals = [
        [("a", at(0)), ("a", at(30)), ("a", at(60)), ("b", at(10)), (None, at(5)), (None, at(6)), ("n", None)],
        [("a", at(119)), ("b", at(100))],
        [("c", at(300))],
        [("a", at(310)), ("b", at(90)), ("c", at(300))],  # b comes later than the watermark
    ]
    first, second, third, fourth = cached(spark, tmp_path, arrivals, ttl="1 hour", late="10 minutes")
    assert first == [("a", 0, "miss"), ("a", 30, "hit"), ("a", 60, "miss"), ("b", 10, "miss"), ("~", 5, "miss"), ("~", 6, "hit")]
    # the watermark stands at 50 when the second arrives, and at 109 after it
    assert [r for r in second if r[2] != "expired"] == [("a", 119, "hit"), ("b", 100, "miss")]
    assert ("~", 65, "expired") in second
    assert [r for r in third if r[2] != "expired"] == [("c", 300, "miss")]
    assert {("a", 120, "expired"), ("b", 160, "expired")} <= set(second + third)
    assert [r for r in fourth if r[2] != "expired"] == [("a", 310, "miss"), ("c", 300, "hit")]


def test_upserts_with_equal_times_are_repeatable(spark, tmp_path):
    rows = spark.createDataFrame([(1, 5, "x"), (1, 5, "y"), (1, 5, "z")], "k int, v int, w string")
    kept = set()
    for turn in range(4):
        path = str(tmp_path / str(turn))
        merge = feeds.upsert_batches(path, "k", "v", buckets=2)
        merge(rows.repartition(turn + 1, "w"), 0)
        merge(rows.orderBy(F.rand(turn)), 1)
        kept |= {r["w"] for r in feeds.current(spark, path).collect()}
    assert len(kept) == 1


def test_ingest_decides_without_texts(spark, tmp_path, monkeypatch):
    rows = [(1, "a/1", "x", "{}", False, "long text", "h", "m", True), (2, "a/1", "x", "{}", False, "later text", "g", "m", False), (3, "a/2", "y", "{}", False, " ", "h", "m", True)]
    batch = spark.createDataFrame(rows, "seq long, relurl string, identifier string, metadata string, malformed boolean, text string, html_sha256 string, metadata_sha256 string, has_pdf boolean")
    texts, classify = [], ingest_stream.ingest.classify
    monkeypatch.setattr(ingest_stream.ingest, "classify", lambda b, *a: texts.extend(r["text"] for r in b.collect()) or classify(b, *a))
    for limit in (100_000, 0):
        monkeypatch.setattr(ingest_stream, "BROADCAST_DECIDED", limit)
        path = str(tmp_path / f"store{limit}")
        ingest_stream.ingest_batches(path, spark.createDataFrame([("a",)], "name string"), buckets=2)(batch, 0)
        assert [tuple(r) for r in ingest_stream.gazettes(spark, path).select("relurl", "text", "html_sha256", "has_pdf").collect()] == [("a/1", "later text", "g", False)]
    assert set(texts) == {"x", ""}
