"""Line dedup: prefix doubling over line sequences, repeated runs of lines, later copies go.

The corpus is one sequence of line ids a document (lines without a word are no part of it). A
run is a stretch of neighbouring lines of one document. Whenever a run of ``min_words`` words or
more occurs again, in another document or further on in the same one, every occurrence but the
first in the order of (doc_id, place) is deleted; shorter repeats stay.

Suffixes are ranked by prefix doubling. Level 0 ranks the lines themselves; level k ranks the
first 2^k lines of suffixes: each suffix has the pair of its own rank and that of the suffix 2^k
lines on, the different pairs are sorted, and their places in that order, with gaps, are the ranks
of the next level. So the ranks of a level put the suffixes in the order of a suffix array,
lines being compared by their hashes, and suffixes are neighbours with a common prefix of 2^k lines
or more if and only if they have one rank. Suffixes whose prefix occurs once leave. The interval of
the suffix array with a common prefix of any other length n between 2^k and 2^(k+1) has two
overlapping ranks, at the suffix and n - 2^k lines on, and is the group of the suffixes with these.

A maximal repeated run is the longest common prefix of an interval. It is covered by its shortest
runs of ``min_words`` words: for each line, the shortest that starts there and the shortest that
ends there. Each of these repeats with it, and each is one interval, whose first suffix in the order
of the corpus stays while the run is deleted at all others. They have at most ``min_words`` lines,
so log2(min_words) levels do, however long the repeated runs are.

Skew: lines and pairs that very many suffixes have meet their ranks by a broadcast (``join_named``);
suffixes of a document are only ever compared by windows over that document.

Nulls: null text is an empty document and stays null. Null ids come first in the order. Rows
that agree in id and text count as one document and are treated alike. An empty table gives an
empty result. Very long texts are lines like any others; one without line feeds is one line. A line
is known by two independent 64-bit hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, broadcast_if_small, checkpoint, join_named, n_words, others

MIN_WORDS = 50
#: The lines to delete are broadcast up to so many of them and of their documents, and joined by a shuffle beyond.
BROADCAST_DELETIONS = 1_000_000


def _place(prefix: str = "") -> Column:
    return F.struct(*[F.col(f"{prefix}{c}") for c in ("doc", "same", "at")])


def line_table(docs: DataFrame, id_col="doc_id", text="text") -> DataFrame:
    """(doc, same, at, line, h1, h2, n): the lines that have a word, ``at`` counting those of a document.

    ``same`` is a hash of the text, which tells apart documents with one id.
    """
    whole = F.col(f"`{text}`")
    spoken = F.filter(
        F.transform(F.split(whole, "\n", -1), lambda x, i: F.struct(x.alias("text"), i.alias("line"))),
        lambda x: F.btrim(x["text"], F.lit(SPACE)) != "",
    )
    # The text is hashed before the explode, or it would be hashed again for each of its lines. The
    # outer explode keeps Spark from adding a filter that splits each text twice more.
    rows = docs.select(F.col(f"`{id_col}`").alias("doc"), F.xxhash64(whole).alias("same"), spoken.alias("lines"))
    lines = rows.select("doc", "same", F.posexplode_outer("lines").alias("at", "x")).where("at IS NOT NULL")
    first = F.xxhash64("x.text")
    return lines.select(
        "doc", "same", "at", F.col("x.line").alias("line"), first.alias("h1"),
        F.xxhash64(F.lit("second"), F.col("x.text"), F.length("x.text")).alias("h2"), n_words(F.col("x.text")).alias("n"),
    )


def in_order(named: DataFrame, keys: list[str]) -> DataFrame:
    """named with rank, a number that grows with the keys in their order."""
    return checkpoint(named.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("rank", F.monotonically_increasing_id()))


def _ranked(rows: DataFrame, keys: list[str]) -> DataFrame:
    """rows with the rank of their keys; rows whose keys occur once leave."""
    named = in_order(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("times")).where("times > 1"), keys)
    return join_named(rows, named, keys, named.agg(F.sum("times")).first()[0] or 0)


def first_ranks(lines: DataFrame) -> DataFrame:
    """Ranks of level 0, of each line that occurs twice or more: (doc, same, at, line, n, rank)."""
    return _ranked(lines, ["h1", "h2"]).select("doc", "same", "at", "line", "n", "rank")


def double(ranks: DataFrame, step: int) -> DataFrame:
    """Ranks for 2 * step lines from those for step lines; suffixes that are alone leave."""
    onward = Window.partitionBy("doc", "same").orderBy("at").rangeBetween(step, step)
    pairs = ranks.select("doc", "same", "at", F.col("rank").alias("rank1"), F.first("rank").over(onward).alias("rank2")).where("rank2 IS NOT NULL")
    return _ranked(checkpoint(pairs), ["rank1", "rank2"]).select("doc", "same", "at", "rank")


def levels(lines: DataFrame, min_words: int = MIN_WORDS) -> list[DataFrame]:
    """The ranks of the levels that runs of min_words words need; that of level 0 has line and n too."""
    place = ["doc", "same", "at"]
    first = checkpoint(first_ranks(lines))
    if not first.groupBy(*place).count().where("count > 1").isEmpty():
        first = checkpoint(first.dropDuplicates(place))  # rows that agree are one document; each would double the ranks at every level
    out = [first]
    while 2 ** len(out) <= min_words:
        out.append(checkpoint(double(out[-1].select("doc", "same", "at", "rank"), 2 ** (len(out) - 1))))
    return out


def shortest_runs(ranks: DataFrame, min_words: int) -> DataFrame:
    """(doc, same, at, size): for each line the shortest runs of min_words words from it and up to it.

    Only repeated lines are looked at, as a run with any other line does not repeat.
    """
    by_doc = Window.partitionBy("doc", "same").orderBy("at")
    item = F.struct("at", "n")

    def run(near: Column, sign: int) -> Column:
        # words and lines up to the one that reaches min_words; a gap between lines ends the run
        start = F.struct(F.lit(0).cast("long").alias("words"), F.lit(0).alias("size"))
        return F.aggregate(
            near,
            start,
            lambda acc, x: F.when((acc["words"] >= min_words) | (x["at"] != F.col("at") + sign * acc["size"]), acc).otherwise(
                F.struct((acc["words"] + x["n"]).alias("words"), (acc["size"] + 1).alias("size"))
            ),
        )

    near = ranks.select(
        "doc", "same", "at",
        F.collect_list(item).over(by_doc.rowsBetween(0, min_words - 1)).alias("on"),
        F.reverse(F.collect_list(item).over(by_doc.rowsBetween(1 - min_words, 0))).alias("back"),
    )
    both = near.select("doc", "same", "at", run(F.col("on"), 1).alias("f"), run(F.col("back"), -1).alias("b"))
    runs = F.array(
        F.struct("at", F.col("f.size").alias("size"), F.col("f.words").alias("words")),
        F.struct((F.col("at") - F.col("b.size") + 1).alias("at"), F.col("b.size").alias("size"), F.col("b.words").alias("words")),
    )
    return (
        both.select("doc", "same", F.explode(F.array_distinct(runs)).alias("r"))
        .where(F.col("r.words") >= min_words)
        .select("doc", "same", "r.at", "r.size")
        .distinct()
    )


def run_intervals(ranks: list[DataFrame], min_words: int = MIN_WORDS) -> DataFrame:
    """(doc, same, at, size, r1, r2): the shortest runs that may repeat, each with the two ranks that name its interval."""
    every = ranks[0].select("doc", "same", "at", "rank").withColumn("level", F.lit(0))
    for k, level in enumerate(ranks[1:], 1):
        every = every.unionByName(level.withColumn("level", F.lit(k)))
    power = F.length(F.bin("size")) - 1
    runs = shortest_runs(ranks[0], min_words).withColumn("level", F.least(power, F.lit(len(ranks) - 1)))
    for name, place in (("r1", F.col("at")), ("r2", F.col("at") + F.col("size") - F.pow(F.lit(2), F.col("level")).cast("int"))):
        names = {"doc": "d", "same": "s", "at": "a", "rank": name, "level": "l"}
        on = F.col("doc").eqNullSafe(F.col("d")) & (F.col("same") == F.col("s")) & (F.col("place") == F.col("a")) & (F.col("level") == F.col("l"))
        runs = runs.withColumn("place", place).join(every.withColumnsRenamed(names), on).drop("d", "s", "a", "l", "place")
    return runs.select("doc", "same", "at", "size", "r1", "r2")


def later_runs(docs: DataFrame, id_col="doc_id", text="text", min_words: int = MIN_WORDS) -> DataFrame:
    """(doc, same, lines): the numbers of the lines to delete, sorted, for each document that has any."""
    ranks = levels(line_table(docs, id_col, text), min_words)
    runs = checkpoint(run_intervals(ranks, min_words))
    first = runs.groupBy("size", "r1", "r2").agg(F.min(_place()).alias("first"), F.count(F.lit(1)).alias("times"))
    first = checkpoint(first.where("times > 1"))
    later = join_named(runs, first, ["size", "r1", "r2"], runs.count()).where(~_place().eqNullSafe(F.col("first")))
    gone = later.select("doc", "same", F.explode(F.sequence(F.col("at"), F.col("at") + F.col("size") - 1)).alias("at")).distinct()
    lines = ranks[0].select(F.col("doc").alias("d"), F.col("same").alias("s"), F.col("at").alias("a"), "line")
    on = F.col("doc").eqNullSafe(F.col("d")) & (F.col("same") == F.col("s")) & (F.col("at") == F.col("a"))
    return gone.join(lines, on).groupBy("doc", "same").agg(F.sort_array(F.collect_set("line")).alias("lines"))


def dedup_lines(docs: DataFrame, id_col="doc_id", text="text", min_words: int = MIN_WORDS, out: str = "line_dedup") -> DataFrame:
    """docs with the struct column ``out``: text, n_lines, n_deleted, deleted (line numbers).

    Further columns and repeated rows stay as they are, but for a column with the name of ``out``.
    """
    gone = checkpoint(later_runs(docs, id_col, text, min_words)).select(
        F.col("doc").alias("__doc"), F.col("same").alias("__same"), F.col("lines").alias("__lines")
    )
    size = gone.agg(F.sum(1 + F.size("__lines"))).first()[0] or 0
    whole = F.col(f"`{text}`")
    joined = docs.join(
        broadcast_if_small(gone, size, BROADCAST_DELETIONS), F.col(f"`{id_col}`").eqNullSafe(F.col("__doc")) & (F.xxhash64(whole) == F.col("__same")), "left"
    )
    lines = F.split(whole, "\n", -1)
    rest = F.array_join(F.filter(lines, lambda x, i: ~F.array_contains(F.col("__lines"), i)), "\n")
    deleted = F.coalesce(F.col("__lines"), F.array().cast("array<int>"))
    result = F.struct(
        F.when(F.col("__lines").isNull(), whole).otherwise(rest).alias("text"),
        F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("n_lines"),
        F.size(deleted).cast("long").alias("n_deleted"),
        deleted.alias("deleted"),
    )
    return joined.select(*others(docs, out), result.alias(out))
