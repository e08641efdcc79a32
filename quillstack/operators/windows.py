"""Order-dependent operators as window functions: lines, carry-down, chunks, counters, versions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def numbered(rows: DataFrame, group: list[str], order: list, breaks: Column, name: str) -> DataFrame:
    """A running number that goes up wherever breaks holds; breaks may use lag over the same window."""
    w = Window.partitionBy(*group).orderBy(*order)
    return rows.withColumn("__break", F.coalesce(breaks, F.lit(False)).cast("int")).withColumn(
        name, F.sum("__break").over(w.rowsBetween(Window.unboundedPreceding, 0))
    ).drop("__break")


def counted(rows: DataFrame, group: list[str], order: list, name: str = "number") -> DataFrame:
    """rows with their place in the group, from 0."""
    return rows.withColumn(name, (F.row_number().over(Window.partitionBy(*group).orderBy(*order)) - 1).cast("long"))


def carry_down(rows: DataFrame, group: list[str], order: list, header: str, within: str | None = None) -> Column:
    """The last header at or above a row; with ``within``, headers do not pass a change of that running number."""
    keys = [*group, within] if within else group
    return F.last(header, ignorenulls=True).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))


def section_rows(rows: DataFrame, group: list[str], order: list, part: str, dept: str) -> DataFrame:
    """Rows with the part and department that hold for them; a new part ends the department."""
    w = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = rows.withColumn("__part", F.sum(F.col(part).isNotNull().cast("int")).over(w))
    out = out.withColumn(f"{part}_now", carry_down(rows, group, order, part))
    return out.withColumn(f"{dept}_now", carry_down(rows, group, order, dept, "__part")).drop("__part")


def phrases(words: DataFrame, limit: int = 8, seconds: float = 3.0, doc: str | None = None) -> DataFrame:
    """([doc,] result, phrase, number, text, start_s, end_s): words of speech cut into subtitles.

    A phrase ends after ``limit`` words or when a word starts more than ``seconds`` after the
    phrase's first. The bound hangs on where the phrase began, so each result's words are gone
    through in order within their group. Empty words are left out; numbers start from 0 in each
    recording, which ``doc`` names; without it all rows are one recording.
    """
    docs = [doc] if doc else []
    clean = words.where(F.trim("word") != "").groupBy(*docs, "result").agg(
        F.array_sort(F.collect_list(F.struct("idx", "word", "start_s", "end_s"))).alias("ws")
    )
    state = "struct<n:int,start:double,phrase:int,out:array<struct<phrase:int,word:string,start_s:double,end_s:double>>>"
    empty = F.struct(
        F.lit(0).alias("n"), F.lit(0.0).alias("start"), F.lit(-1).alias("phrase"),
        F.array().cast("array<struct<phrase:int,word:string,start_s:double,end_s:double>>").alias("out"),
    ).cast(state)

    def step(acc, w):
        new = (acc["phrase"] < 0) | (acc["n"] >= limit) | (w["start_s"] - acc["start"] > seconds)
        phrase = acc["phrase"] + new.cast("int")
        entry = F.struct(phrase.alias("phrase"), w["word"].alias("word"), w["start_s"].alias("start_s"), w["end_s"].alias("end_s"))
        return F.struct(
            F.when(new, 1).otherwise(acc["n"] + 1).alias("n"),
            F.when(new, w["start_s"]).otherwise(acc["start"]).alias("start"),
            phrase.alias("phrase"),
            F.array_append(acc["out"], entry).alias("out"),
        ).cast(state)

    rows = clean.select(*docs, "result", F.posexplode(F.aggregate("ws", empty, step)["out"]).alias("idx", "x"))
    cut = rows.groupBy(*docs, "result", F.col("x.phrase").alias("phrase")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", F.col("x.word").alias("w")))), lambda x: x["w"]), " ").alias("text"),
        F.min("x.start_s").alias("start_s"), F.max("x.end_s").alias("end_s"),
    )
    return counted(cut, docs, ["result", "phrase"]).select(*docs, "result", "phrase", "number", "text", "start_s", "end_s")


def srt_time(seconds: Column) -> Column:
    """00:01:02,345"""
    ms = F.round(seconds * 1000).cast("long")
    return F.format_string("%02d:%02d:%02d,%03d", F.floor(ms / 3600000), F.floor(ms / 60000) % 60, F.floor(ms / 1000) % 60, ms % 1000)


def newest_versions(refs: DataFrame) -> DataFrame:
    """One row a (title, num): a known version replaces an unknown or older one; else the earliest entry stays.

    refs: (title, num, version, seq, ...).
    """
    order = Window.partitionBy("title", "num").orderBy(F.col("version").desc_nulls_last(), "seq")
    return refs.withColumn("__nth", F.row_number().over(order)).where("__nth = 1").drop("__nth")


def section_ids(nodes: DataFrame) -> DataFrame:
    """nodes (reg, node, parent, tag, ...) with eid: tag_n by document order, under the parent's for nested ones."""
    n = F.row_number().over(Window.partitionBy("reg", "parent", "tag").orderBy("node"))
    own = nodes.withColumn("own", F.concat_ws("_", F.col("tag"), n.cast("string")))
    parents = own.select(F.col("reg").alias("p_reg"), F.col("node").alias("p_node"), F.col("own").alias("p_own"), F.col("parent").alias("p_parent"))
    joined = own.join(parents, (F.col("reg") == F.col("p_reg")) & (F.col("parent") == F.col("p_node")), "left")
    return joined.withColumn("eid", F.concat_ws("__", "p_own", "own")).drop("p_reg", "p_node", "p_own", "p_parent", "own")
