"""Merkle manifests of datasets: a tree of digests a group, a tree over the groups, a proof for every row.

A row's leaf is the digest of its fields, each written as its length and value, so that no two
different rows have one preimage. Per group, leaves ascend by id; while several nodes remain, every
``FAN`` consecutive ones become the digest of their digests' hex text (the last run may have fewer).
What remains is the group's subroot; subroots, ordered by group, make the root in the same way.

Levels. A level is one window: partitioned by group and parent index, ordered, with the full frame, its
collected digests are both the parent's preimage and the siblings of each node. A window holds ``FAN``
rows, however large its group. The first node of each run carries the parent to the next level, which
makes parents distinct without a shuffle. Every level is checkpointed and has a third of the nodes of
the one below.

Numbers. Places within a group come from a range partitioning by group, id and leaf, in which a hot group
spreads over many partitions: the place is that within the partition plus the group's rows in earlier ones.

Proofs. From the top down each node takes its parent's path and puts its own siblings before it, so
rows that are joined on one level are a third of those below, and a leaf's path is complete after one
join. A path is a list of steps, siblings before and after, from leaf to root: ``folded`` recomputes the
root that a leaf and its path lead to, and ``proof_digest`` names all siblings from left to right.

Cases. Null fields are ``-``, which no value can be; null ids come first, null groups are one group, the
first. Rows that agree in all fields are leaves of their own, with equal digests and their own paths.
Rows with one id and different fields are ordered by their leaves. A group of one row has its leaf as
subroot; one group's subroot is the root. Texts are read whole. A table without rows gives none.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import broadcast_if_small, checkpoint, partitions

FAN = 3
#: Tables of about 100 bytes a row are broadcast up to so many rows, and joined by a shuffle beyond.
BROADCAST_ROWS = 50_000
#: Paths, of some thousand bytes each, likewise.
BROADCAST_PATHS = 2_000
PATH = "array<struct<before:string,after:string>>"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*texts: Column) -> Column:
    """The lowercase hex SHA-256 of the texts, one after the other."""
    return F.sha2(F.concat(*texts).cast("binary"), 256)


def field(value: Column) -> Column:
    """A field's part of the preimage: ``-``, or the bytes of its UTF-8 text, a colon and the text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(fields: list[Column]) -> Column:
    return digest(*[field(f) for f in fields])


def placed(rows: DataFrame) -> DataFrame:
    """rows with ``i``, the place from 0 in the order of (id, leaf) among those of their group."""
    # equal rows may lie anywhere among themselves; the number of a row spreads very many of them
    spread = F.xxhash64(F.monotonically_increasing_id())
    order = [F.asc_nulls_first("g"), F.asc_nulls_first("id"), F.col("leaf"), F.col("spread")]
    ranged = rows.withColumn("spread", spread).repartitionByRange(partitions(rows.sparkSession), *order).sortWithinPartitions(*order)
    ranged = checkpoint(ranged.drop("spread").withColumn("at", F.monotonically_increasing_id()))
    part = F.shiftright("at", 33)
    runs = ranged.groupBy(part.alias("part"), "g").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("g").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row a partition at most
    starts = checkpoint(runs.select("part", F.col("g").alias("of"), (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("shift")))
    starts = broadcast_if_small(starts, starts.count(), BROADCAST_ROWS)
    met = ranged.join(starts, (part == F.col("part")) & F.col("g").eqNullSafe(F.col("of")))
    return met.select(*[c for c in rows.columns], (F.col("at") + F.col("shift")).alias("i"))


def climbed(nodes: DataFrame) -> tuple[list[tuple[DataFrame, int]], DataFrame]:
    """(levels, tops) for nodes (g, i, h).

    A level is a table (g, i, p, before, after, parent) with a node's parent index, its siblings and
    the digest of its run, and the number of its rows. tops: (g, h) of each group, the node that remains.
    """
    sizes = checkpoint(nodes.groupBy("g").agg(F.count(F.lit(1)).alias("n")))
    most, n_groups = sizes.agg(F.coalesce(F.max("n"), F.lit(0)), F.count(F.lit(1))).first()
    heights = [most]
    while heights[-1] > 1:
        heights.append(-(-heights[-1] // FAN))
    # a group of n has ceil(n / FAN^k) nodes on level k while these are several
    on_level = [F.ceil(F.col("n") / F.lit(FAN**k)) for k in range(len(heights))]
    rows = sizes.agg(*[F.coalesce(F.sum(F.when(x > 1, x)), F.lit(0)).cast("long").alias(f"n{k}") for k, x in enumerate(on_level)]).first()
    levels, tops = [], []
    now = nodes
    run = Window.partitionBy("g", "p").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    for k in range(len(heights)):
        # groups with a second node go on, the others are done
        several = broadcast_if_small(now.where("i = 1").select(F.col("g").alias("of")), n_groups, BROADCAST_ROWS)
        more = F.col("g").eqNullSafe(F.col("of"))
        tops.append(now.where("i = 0").join(several, more, "left_anti").select("g", "h"))
        if k == len(heights) - 1:
            break
        nth = (F.col("i") % FAN).cast("int")
        found = now.join(several, more, "left_semi").withColumn("p", F.floor(F.col("i") / FAN).cast("long")).withColumn("run", F.collect_list("h").over(run))
        level = checkpoint(
            found.select(
                "g", "i", "p",
                F.concat_ws("", F.slice("run", F.lit(1), nth)).alias("before"),
                F.concat_ws("", F.slice("run", nth + 2, F.lit(FAN))).alias("after"),
                digest(F.concat_ws("", "run")).alias("parent"),
            )
        )
        levels.append((level, rows[k]))
        now = level.where(F.col("i") % FAN == 0).select("g", F.col("p").alias("i"), F.col("parent").alias("h"))
    return levels, checkpoint(reduce(DataFrame.unionByName, tops))


def paths(nodes: DataFrame, levels: list[tuple[DataFrame, int]]) -> DataFrame:
    """nodes with ``path``, the steps (before, after) from each to its group's top."""
    above, n_above = None, 0
    for level, n in reversed(levels):
        own = level.select("g", "i", "p", F.array(F.struct("before", "after")).alias("path"))
        if above is not None:
            higher = above.select(F.col("g").alias("of"), F.col("i").alias("up"), F.col("path").alias("rest"))
            higher = broadcast_if_small(higher, n_above, BROADCAST_PATHS)
            met = own.join(higher, F.col("g").eqNullSafe(F.col("of")) & (F.col("p") == F.col("up")), "left")
            own = met.select("g", "i", F.concat("path", F.coalesce("rest", F.array().cast(PATH))).alias("path"))
        above, n_above = own.select("g", "i", "path"), n
        if n > BROADCAST_PATHS and level is not levels[0][0]:
            above = checkpoint(above)
    if above is None:
        return nodes.withColumn("path", F.array().cast(PATH))
    found = above.select(F.col("g").alias("of"), F.col("i").alias("nth"), F.col("path").alias("steps"))
    met = nodes.join(found, F.col("g").eqNullSafe(F.col("of")) & (F.col("i") == F.col("nth")), "left")
    return met.select(*nodes.columns, F.coalesce("steps", F.array().cast(PATH)).alias("path"))


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and a path lead to."""
    return F.aggregate(path, start, lambda h, s: digest(s["before"], h, s["after"]))


def proof_digest(path: Column) -> Column:
    """The digest of a path's siblings, level by level, each from left to right."""
    return digest(F.concat_ws("", F.flatten(F.transform(path, lambda s: F.array(s["before"], s["after"])))))


def manifest(rows: DataFrame) -> DataFrame:
    """rows (g, id, leaf, tampered) with subroot, root and path, the steps from leaf to root."""
    nodes = checkpoint(placed(checkpoint(rows)))
    levels, tops = climbed(nodes.select("g", "i", F.col("leaf").alias("h")))
    groups = checkpoint(placed(tops.select(F.lit(0).alias("g"), F.col("g").alias("id"), F.col("h").alias("leaf"))))
    upper, root = climbed(groups.select("g", "i", F.col("leaf").alias("h")))
    top = root.first()  # one row, or none for an empty table
    over = checkpoint(paths(groups, upper).select(F.col("id").alias("group"), F.col("leaf").alias("subroot"), F.col("path").alias("rest")))
    over = broadcast_if_small(over, over.count(), BROADCAST_PATHS)
    met = paths(nodes, levels).join(over, F.col("g").eqNullSafe(F.col("group")))
    return met.select(*rows.columns, "subroot", F.lit(top and top.h).cast("string").alias("root"), F.concat("path", "rest").alias("path"))


def leaves(docs: DataFrame, fields=FIELDS, id_col="doc_id", group="source", text="text", edited: Column | None = None) -> DataFrame:
    """(g, id, leaf, tampered): the leaves of all rows, and those with the text that took its place.

    edited: that text, or null where a row keeps its own; without any, tampered is null.
    """
    own = [F.col(f"`{f}`") for f in fields]
    other = F.lit(None).cast("string")
    if edited is not None:
        other = F.when(edited.isNotNull(), leaf([edited if f == text else c for f, c in zip(fields, own)]))
    return docs.select(F.col(f"`{group}`").alias("g"), F.col(f"`{id_col}`").alias("id"), leaf(own).alias("leaf"), other.alias("tampered"))
