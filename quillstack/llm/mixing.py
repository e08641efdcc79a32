"""Mixing sources to target weights by entropy balancing.

Targets. Sources in the order of their code points, null last, weigh 3, 1, 2, repeating. They
share ``share_percent`` of all words in proportion to the weights, but none gets more than
``max_copies`` times its own words; the excess is shared again. With level x, a source gets
min(max_copies * size, weight * x); x is raised until no further source is full, each time from two
sums over all sources.

Rates. Within a source, document rates r minimise the relative entropy to 1 under the source's
token constraint sum(size * r) = target and r <= max_copies. The convex dual has one multiplier
a source: r = min(max_copies, exp(multiplier * size / mean size)). All multipliers are solved at
once by Newton steps, each a distributed aggregation; a step that leaves the bracket known so
far is replaced by its middle, and not to arrive within ``STEPS`` is an error. Documents of one size
in one source have one rate, so the steps run over the table of (source, size, count), the cells,
which is exact and much smaller than the input.

Copies. The rates' sums are rounded along the cells of a source in the order of size, which gives
each cell a number of copies. What is then left of the target is made up by exchanges: the copy
added and the copy taken away, or one of both alone, whose difference in size is nearest to it, as
often as that helps and at most ``EXCHANGES`` times. A cell's copies are dealt evenly to its
documents; those with the smallest hashes of id and text get one more. Cells are cut into pieces of
about ``PIECE`` documents first, so no group of equal sizes meets in one task; cells that hold very
many documents meet theirs by a broadcast (``join_named``).

Sums are made in decimals, so reruns agree whatever the order of rows. Null texts have size 0;
documents of size 0 take 0 words. Very long texts are documents like others: a source with few of
them may miss its target by part of one. Null sources form one source. Repeated rows count each, and
rows equal in id, source and text are in one piece. Null ids are ids. Further columns are not
looked at. An empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import broadcast_if_small, checkpoint, join_named, n_words

WEIGHTS = (3, 1, 2)
SHARE_PERCENT = 150
MAX_COPIES = 2
PIECE = 256
STEPS = 60
EXCHANGES = 4
#: Sources are broadcast up to so many rows of about 100 bytes, and joined by a shuffle beyond.
BROADCAST_SOURCES = 100_000
_EXACT = "decimal(38,9)"
_SOURCE = ["known", "name"]


def numbered(df: DataFrame, order: list, name: str) -> DataFrame:
    """df with its place in the order, from 1: places within ranges, after the sizes of the ranges before."""
    ranged = checkpoint(df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()))
    sizes = ranged.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))  # one row a partition
    before = sizes.select("__part", (F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")).alias("__before"))
    within = F.row_number().over(Window.partitionBy("__part").orderBy(*order))
    return ranged.join(F.broadcast(before), "__part").withColumn(name, F.col("__before") + within).drop("__part", "__before")


def targets(cells: DataFrame, weights=WEIGHTS, share_percent=SHARE_PERCENT, max_copies=MAX_COPIES) -> DataFrame:
    """(known, name, source_size, n_docs, target) from (known, name, size, n); one row a source."""
    per = cells.groupBy(*_SOURCE).agg(
        F.sum(F.col("size") * F.col("n")).alias("source_size"),
        F.sum(F.when(F.col("size") > 0, F.col("n")).otherwise(0)).alias("n_docs"),
    )
    per = numbered(per, [F.col("known").desc(), F.col("name")], "place")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("place") - 1) % len(weights) + 1).cast("int"))
    per = checkpoint(per.select(*_SOURCE, "source_size", "n_docs", weight.alias("weight"), (F.col("source_size") * max_copies).cast("double").alias("cap")))
    total = (per.agg(F.sum("source_size")).first()[0] or 0) * share_percent / 100.0
    level, n_full = 0.0, -1
    while True:
        full = F.col("cap") <= F.col("weight") * level
        capped, open_weight, now = per.agg(F.sum(F.when(full, F.col("cap"))), F.sum(F.when(~full, F.col("weight"))), F.count_if(full)).first()
        if now == n_full or not open_weight:
            break
        level, n_full = (total - (capped or 0.0)) / open_weight, now
    target = F.least(F.col("cap"), F.col("weight") * level) if open_weight else F.col("cap")
    return per.select(*_SOURCE, "source_size", "n_docs", target.alias("target"))


def _rate(max_copies: int):
    return F.exp(F.least(F.col("lam") * F.col("z"), F.lit(math.log(max_copies))))


def multipliers(cells: DataFrame, goals: DataFrame, max_copies=MAX_COPIES, steps=STEPS) -> DataFrame:
    """goals with ``lam``, the dual's solution for each source; null where every rate is max_copies."""
    mean = F.col("source_size") / F.greatest(F.col("n_docs"), F.lit(1))
    state = goals.select(
        "*",
        mean.alias("mean"),
        (F.col("target") >= max_copies * F.col("source_size") * (1 - 1e-12)).alias("done"),
        F.lit(0.0).alias("lam"),
        F.lit(None).cast("double").alias("lo"),
        F.lit(None).cast("double").alias("hi"),
    )
    state = checkpoint(state)
    n_sources = state.count()
    z = F.col("size") / F.col("mean")
    for _ in range(steps):
        open_ = broadcast_if_small(state.where(~F.col("done")), n_sources, BROADCAST_SOURCES)
        at = cells.where(F.col("size") > 0).join(open_, _SOURCE)
        at = at.withColumn("z", z).withColumn("tokens", F.col("n") * F.col("size") * _rate(max_copies))
        inside = F.col("lam") * F.col("z") < math.log(max_copies)
        sums = at.groupBy(*_SOURCE).agg(
            F.sum(F.col("tokens").cast(_EXACT)).cast("double").alias("tokens"),
            F.sum(F.when(inside, F.col("tokens") * F.col("z")).otherwise(0.0).cast(_EXACT)).cast("double").alias("slope"),
        )
        new = state.join(sums, _SOURCE, "left")
        short = F.col("tokens") < F.col("target")
        lo = F.when(short, F.col("lam")).otherwise(F.col("lo"))
        hi = F.when(short, F.col("hi")).otherwise(F.col("lam"))
        step = F.col("lam") + (F.col("target") - F.col("tokens")) / F.col("slope")
        kept = (F.col("slope") > 0) & F.coalesce(step > F.col("lo2"), F.lit(True)) & F.coalesce(step < F.col("hi2"), F.lit(True))
        middle = F.coalesce((F.col("lo2") + F.col("hi2")) / 2, F.when(short, F.col("lam") + 1).otherwise(F.col("lam") - 1))
        near = F.abs(F.col("tokens") - F.col("target")) <= F.greatest(F.lit(0.01), F.col("target") * 1e-9)
        done = F.col("done") | F.coalesce(near, F.lit(True))
        new = new.withColumn("lo2", lo).withColumn("hi2", hi).withColumn("next", F.when(kept, step).otherwise(middle))
        state = checkpoint(
            new.select(
                *_SOURCE, "source_size", "n_docs", "target", "mean",
                done.alias("done"),
                F.when(done, F.col("lam")).otherwise(F.col("next")).alias("lam"),
                F.when(done, F.col("lo")).otherwise(F.col("lo2")).alias("lo"),
                F.when(done, F.col("hi")).otherwise(F.col("hi2")).alias("hi"),
            )
        )
        if state.where(~F.col("done")).isEmpty():
            break
    else:
        raise RuntimeError("the multipliers of some sources did not settle")
    full = F.col("target") >= max_copies * F.col("source_size") * (1 - 1e-12)
    return state.withColumn("lam", F.when(~full, F.col("lam")))


def exchanged(cells: DataFrame, max_copies: int = MAX_COPIES, exchanges: int = EXCHANGES) -> DataFrame:
    """cells (known, name, size, n, target, copies, ...) with copies added or taken away to meet the target more nearly."""
    def side(rows, **columns):
        made = {"v": F.lit(None).cast("double"), "gap": F.lit(None).cast("double"), "add": F.lit(None).cast("long"), "drop": F.lit(None).cast("long")} | columns
        return rows.select(*_SOURCE, *[c.alias(k) for k, c in made.items()])

    none, size = F.lit(0).cast("long"), F.col("size")
    for _ in range(exchanges):
        taken = F.sum(size * F.col("copies"))
        gaps = cells.groupBy(*_SOURCE).agg((F.first("target") - taken).alias("gap")).where("abs(gap) > 0.5")
        n_gaps = gaps.count()
        if not n_gaps:
            break
        open_ = cells.where("size > 0").join(broadcast_if_small(gaps, n_gaps, BROADCAST_SOURCES), _SOURCE)
        # what may be added asks for what, taken away, would leave the gap; nothing is an answer too
        rows = (
            side(open_.where(F.col("copies") < max_copies * F.col("n")), v=size - F.col("gap"), gap=F.col("gap"), add=size)
            .unionByName(side(gaps, v=-F.col("gap"), gap=F.col("gap"), add=none))
            .unionByName(side(open_.where("copies > 0"), v=size.cast("double"), drop=size))
            .unionByName(side(gaps, v=F.lit(0.0), drop=none))
        )
        line = Window.partitionBy(*_SOURCE).orderBy("v", "add", "drop")
        rows = rows.withColumn("below", F.last("drop", True).over(line.rowsBetween(Window.unboundedPreceding, 0)))
        rows = rows.withColumn("above", F.first("drop", True).over(line.rowsBetween(0, Window.unboundedFollowing))).where("add IS NOT NULL")
        moves = rows.select(*_SOURCE, "gap", "add", F.explode(F.array_compact(F.array("below", "above"))).alias("off"))
        left = F.abs(F.col("gap") - F.col("add") + F.col("off"))
        best = moves.groupBy(*_SOURCE).agg(F.min(F.struct(left.alias("left"), "add", F.col("off").alias("drop"))).alias("b"), F.first("gap").alias("gap"))
        best = checkpoint(best.where(F.col("b.left") < F.abs("gap") - 1e-6).select(*_SOURCE, "b.add", "b.drop"))
        n_best = best.count()
        if not n_best:
            break
        moved = cells.join(broadcast_if_small(best, n_best, BROADCAST_SOURCES), _SOURCE, "left")
        change = F.coalesce((size == F.col("add")).cast("long"), none) - F.coalesce((size == F.col("drop")).cast("long"), none)
        cells = checkpoint(moved.withColumn("copies", F.col("copies") + F.when(size > 0, change).otherwise(none)).select(*cells.columns))
    return cells


def mix(docs: DataFrame, id_col="doc_id", text="text", source="source", weights=WEIGHTS,
        share_percent=SHARE_PERCENT, max_copies=MAX_COPIES) -> DataFrame:
    """One row a document: id, source, size, source_size, target, rate, copies, taken."""
    whole, name = F.col(f"`{text}`"), F.col(f"`{source}`")
    cell = [*_SOURCE, "size"]
    base = checkpoint(
        docs.select(
            F.col(f"`{id_col}`").alias("id"), F.xxhash64(F.col(f"`{id_col}`"), whole).alias("order"), name.isNotNull().alias("known"),
            F.coalesce(name.cast("string"), F.lit("")).alias("name"), n_words(whole).alias("size"),
        )
    )
    cells = checkpoint(base.groupBy(*cell).agg(F.count(F.lit(1)).alias("n")))
    solved = multipliers(cells, targets(cells, weights, share_percent, max_copies), max_copies)
    rate = F.when(F.col("lam").isNull(), F.lit(float(max_copies))).otherwise(F.round(_rate(max_copies), 12))
    rated = (
        cells.join(solved, _SOURCE)
        .withColumn("z", F.col("size") / F.coalesce(F.when(F.col("mean") > 0, F.col("mean")), F.lit(1.0)))
        .select(*cell, "n", "source_size", "target", rate.alias("rate"))
    )
    up = Window.partitionBy(*_SOURCE).orderBy("size")
    upto = F.floor(F.sum((F.col("n") * F.col("rate")).cast(_EXACT)).over(up) + F.lit(0.5))
    rounded = rated.withColumn("upto", upto).withColumn("copies", F.col("upto") - F.coalesce(F.lag("upto").over(up), F.lit(0)))
    rounded = rounded.withColumn("copies", F.least(F.greatest("copies", F.lit(0)), F.col("n") * max_copies).cast("long")).drop("upto")
    met = exchanged(checkpoint(rounded), max_copies).withColumn("pieces", F.ceil(F.col("n") / PIECE)).withColumnRenamed("n", "times")
    met = met.withColumn("whole", F.floor(F.col("copies") / F.col("times"))).withColumn("more", F.col("copies") - F.col("whole") * F.col("times"))
    placed = join_named(base, checkpoint(met.drop("copies")), cell, base.count())
    # pieces go by one column, so that nothing is dealt by the cell alone, which may be hot
    placed = placed.withColumn("spot", F.struct(*cell, F.pmod(F.col("order"), F.col("pieces")).alias("piece")))
    # the documents of a cell that get one copy more are the first ones of its pieces in turn
    held = placed.groupBy("spot").agg(F.count(F.lit(1)).alias("held"))
    before = F.sum("held").over(Window.partitionBy(*[f"spot.{c}" for c in cell]).orderBy("spot.piece")) - F.col("held")
    ranked = placed.withColumn("place", F.row_number().over(Window.partitionBy("spot").orderBy("order")))
    both = ranked.join(held.select("spot", before.alias("before")), "spot")
    copies = (F.col("whole") + (F.col("before") + F.col("place") <= F.col("more")).cast("long")).cast("long")
    return both.withColumn("copies", copies).select(
        F.col("id").alias(id_col), F.when(F.col("known"), F.col("name")).cast(docs.schema[source].dataType).alias(source), "size", "source_size",
        "target", "rate", "copies", (F.col("copies") * F.col("size")).alias("taken"),
    )
