"""Connected components of a large sparse graph by large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import HOT_KEYS, checkpoint, join_named, partitions


def _least(edges: DataFrame) -> DataFrame:
    """(u, m, times): the smallest of each node and its neighbours v, and how many of these it has."""
    return edges.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"), F.count(F.lit(1)).alias("times"))


def _shape(edges: DataFrame) -> tuple[int, int, bool]:
    """How many edges there are, the most that a node has, and whether all nodes point to one that points nowhere."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("u").alias("x"), F.lit(1).alias("out")), F.struct(F.col("v").alias("x"), F.lit(0).alias("out")))).alias("e"))
    degree = ends.groupBy("e.x").agg(F.sum("e.out").alias("out"), F.count(F.lit(1)).alias("n"))
    unsettled = (F.col("out") > 1) | (F.col("out") > 0) & (F.col("n") > F.col("out"))
    n, most, open_ = degree.agg(F.sum("out"), F.max("n"), F.count_if(unsettled)).first()
    return n or 0, most or 0, not open_


def components(edges: DataFrame, steps: int = 40, hot: int = 256) -> DataFrame:
    """(node, root) for every node with an edge; root is the smallest node of its component.

    edges: (a, b), in any direction, repeats allowed. Each step joins nodes with the smallest of
    their neighbours, so groups of any size shrink to stars in about log steps; no group is
    gathered in one task, and nodes with very many neighbours (more than ``hot``, and a part of all
    edges) meet theirs by a broadcast; where there are none, a window finds the smallest in the shuffle that
    brings a node's edges together. Ends when every node points to a node that points nowhere.
    """
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now = checkpoint(now)
    n, most, _ = _shape(now)

    def dealt(rows: DataFrame) -> DataFrame:
        """Different rows, those of a node together, so that neither this nor what follows by node shuffles them again."""
        return rows.repartition(partitions(rows.sparkSession), "u").distinct()

    def met(rows: DataFrame) -> DataFrame:
        if most <= max(hot, 2 * n // HOT_KEYS):
            return rows.withColumn("m", F.least(F.col("u"), F.min("v").over(Window.partitionBy("u"))))
        return join_named(rows, _least(rows), ["u"], 2 * n, hot)

    for _ in range(steps if n else 0):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = dealt(met(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v"))
        small = met(large).select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
        now = checkpoint(small.select("e.u", "e.v").where("u <> v").distinct())
        n, most, settled = _shape(now)
        if settled:
            break
    else:
        if n:
            raise RuntimeError("components did not settle")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
