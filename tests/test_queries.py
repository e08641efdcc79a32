"""Every archive query against its SQL on the smallest tables."""

import math
import os

import duckdb
import pandas as pd
import pytest

from quillstack import session
from quillstack.plans import archive_queries, function_queries, grammar_queries, layout_queries, record_queries, regulation_queries, table_queries, tree_queries  # noqa: F401
from quillstack.streaming import stream_queries  # noqa: F401

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    db = duckdb.connect()
    for t in TABLES:
        db.sql(f"CREATE VIEW {t} AS FROM '{SF}/{t}.parquet'")
    return db


def rows(df):
    def one(v):
        if v is None or v is pd.NA or v is pd.NaT or isinstance(v, float) and math.isnan(v):
            return "~"
        if isinstance(v, float):
            return str(int(v)) if v == int(v) else repr(round(v, 6))
        return str(v)

    return sorted(tuple(map(one, r)) for r in df[sorted(df.columns)].astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", sorted(archive_queries.QUERIES))
def test_query(spark, duck, name):
    got = archive_queries.QUERIES[name](spark, SF).toPandas()
    if name in archive_queries.SQL:
        want = duck.sql(archive_queries.SQL[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows(got) == rows(want)
    else:
        assert len(got) > 0


def test_ingest_status_of_stored_copies(spark, tmp_path):
    rows = [(1, "same text", "src0", 9), (2, "same text", "src0", 9), (3, "same text", "src0", 9), (4, "other text", "src0", 10), (5, "same text", "src1", 9)]
    spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1), (2, 1), (4, 0)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    got = {r["seq"]: r["status"] for r in archive_queries.QUERIES["ingest_status"](spark, str(tmp_path)).collect()}
    assert got == {1: "unchanged", 2: "unchanged", 3: "error", 4: "updated", 5: "created"}
    made = duckdb.connect()
    for t in ("documents", "labels"):
        made.execute(f"CREATE VIEW {t} AS FROM '{tmp_path}/{t}.parquet/*.parquet'")
    assert got == dict(made.execute(archive_queries.SQL["ingest_status"]).fetchall())


@pytest.mark.parametrize("name", ["layout_paragraphs_over_pages", "layout_html_over_pages"])
def test_tasks_do_not_grow_with_the_table(spark, monkeypatch, name):
    monkeypatch.setattr(session, "TASK_ROWS", 500)
    found = archive_queries.QUERIES[name](spark, SF)
    lines = spark.read.parquet(f"{SF}/lineitem.parquet").count()
    assert f", {-(-lines // 500)})" in found._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name, joins", [("layout_cells_of_gaps", 1), ("layout_columns_of_gaps", 0)])
def test_columns_of_gaps_need_no_join(spark, name, joins):
    plan = archive_queries.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Join ") == joins
