"""Tables in preformatted lines: columns from where gaps end, cells by the columns that they overlap.

A gap is two or more blanks in a row. A page's histogram counts where its gaps end; a column begins
where more than two gaps end, and the one before it ends where the gap of the rarest length with that
end begins (of equally rare ones the longest). An end beside a more frequent one just after it is the same
column seen a blank too early, and one whose gap reaches back into a column that was already taken is none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import escaped
from .layout import PAGE

#: A column needs so many gaps that end where it begins.
LEAST = 3


def pieces(lines: DataFrame) -> DataFrame:
    """lines (doc, page, line, text) as pieces (doc, page, line, start, end, text) between gaps, ends excluded; blank lines have none."""
    found = F.filter(F.split("text", "\\s{2,}"), lambda x: F.trim(x) != "")
    begin = F.struct(F.array().cast("array<struct<start:int,end:int,text:string>>").alias("out"), F.lit(1).alias("at"))

    def placed(acc, x):
        start = F.position(x, F.col("text"), acc["at"])
        after = start + F.length(x)
        return F.struct(F.array_append(acc["out"], F.struct((start - 1).alias("start"), (after - 1).alias("end"), x.alias("text"))).alias("out"), after.alias("at"))

    rows = lines.select(*PAGE, "line", F.explode(F.aggregate(found, begin, placed, lambda acc: acc["out"])).alias("p"))
    return rows.select(*PAGE, "line", "p.*")


def _ends(found: DataFrame) -> DataFrame:
    """(doc, page, at, n, length, width): as gap_ends for all places where pieces begin, n null without a gap, and how far these pieces reach."""
    before = F.coalesce(F.lag("end").over(Window.partitionBy(*PAGE, "line").orderBy("start")), F.lit(0))
    begun = found.select(*PAGE, F.col("start").alias("at"), (F.col("start") - before).alias("length"), "end")
    counted = begun.groupBy(*PAGE, "at", "length").agg(F.count(F.lit(1)).alias("k"), F.max("end").alias("end"))
    gap = F.col("length") >= 2
    rarest = F.min(F.when(gap, F.struct("k", (-F.col("length")).alias("l"))))
    ends = counted.groupBy(*PAGE, "at").agg(F.sum(F.when(gap, F.col("k"))).alias("n"), rarest["l"].alias("l"), F.max("end").alias("width"))
    return ends.select(*PAGE, "at", "n", (-F.col("l")).alias("length"), "width")


def gap_ends(found: DataFrame) -> DataFrame:
    """(doc, page, at, n, length): where gaps end, how many do, and their rarest length. Indents are gaps; what follows the last piece is none."""
    return _ends(found).where("n IS NOT NULL").drop("width")


def columns(found: DataFrame) -> DataFrame:
    """(doc, page, columns) of the pages that have two or more: the start and end of each."""
    ended = F.col("n").isNotNull() & (F.col("at") > 0)
    # a histogram has at most as many entries as a line has characters
    made = _ends(found).groupBy(*PAGE).agg(
        F.array_sort(F.collect_list(F.when(ended, F.struct("at", "n", "length")))).alias("h"),
        F.map_from_entries(F.collect_list(F.when(ended, F.struct("at", "n")))).alias("at_n"), F.max("width").alias("width"),
    )
    kind = "array<struct<start:int,end:int>>"
    begin = F.struct(F.array().cast(kind).alias("out"), F.lit(0).alias("last"), F.lit(False).alias("any"))

    def marked(acc, x):
        pos = x["at"] - x["length"]
        beside = F.coalesce(F.try_element_at(F.col("at_n"), x["at"] + 1) > x["n"], F.lit(False))
        taken = ~(acc["any"] & (pos < acc["last"])) & (pos > 0) & (x["n"] >= LEAST) & ~beside
        new = F.struct(F.array_append(acc["out"], F.struct(acc["last"].alias("start"), pos.alias("end"))).alias("out"), x["at"].alias("last"), F.lit(True).alias("any"))
        return F.when(taken, new).otherwise(acc)

    made = made.withColumn("c", F.aggregate("h", begin, marked))
    last = F.struct(F.col("c.last").alias("start"), F.col("width").alias("end"))
    whole = F.when(F.col("c.last") < F.col("width"), F.array_append("c.out", last)).otherwise(F.col("c.out"))
    return made.select(*PAGE, whole.alias("columns")).where(F.size("columns") > 1)


def _span(start: Column, end: Column, bounds: Column) -> Column:
    """(first, last) of the columns that a piece belongs to.

    The first is the one it begins in; in the gap between two it is the nearer one, the later of equal ones.
    The last is the last one that it reaches the beginning of.
    """
    begun = F.size(F.filter(bounds, lambda c: c["start"] - 1 <= start))  # columns that begin at or before it
    here, after = F.get(bounds, begun - 1), F.get(bounds, begun)
    nearer = (start >= here["end"]) & after.isNotNull() & (start - here["end"] >= after["start"] - end)
    first = F.when(begun == 0, 1).when(nearer, begun + 1).otherwise(begun)
    last = F.size(F.filter(bounds, lambda c: c["start"] <= end - 1))
    return F.struct(first.alias("first"), F.greatest(first, last).alias("last"))


def cells(found: DataFrame, bounds: DataFrame) -> DataFrame:
    """(doc, page, line, col, span, text): the cells of each line in order, from 1; empty ones where no piece reaches.

    Pieces that meet in a column are one cell.
    """
    placed = found.join(bounds, PAGE).withColumn("s", _span(F.col("start"), F.col("end"), F.col("columns"))).select(*PAGE, "line", "start", "text", "s.first", "s.last", F.size("columns").alias("n"))
    order = Window.partitionBy(*PAGE, "line").orderBy("start")
    reached = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    placed = placed.withColumn("new", (reached.isNull() | (F.col("first") > reached)).cast("int"))
    placed = placed.withColumn("cell", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    joined = placed.groupBy(*PAGE, "line", "n", "cell").agg(
        F.min("first").alias("col"), F.max("last").alias("last"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "text"))), lambda x: x["text"]), " ").alias("text")
    )
    full = joined.groupBy(*PAGE, "line", "n").agg(F.collect_list(F.struct("col", (F.col("last") - F.col("col") + 1).alias("span"), "text")).alias("x"), F.flatten(F.collect_list(F.sequence("col", "last"))).alias("taken"))
    empty = F.transform(F.array_except(F.sequence(F.lit(1), F.col("n")), "taken"), lambda c: F.struct(c.alias("col"), F.lit(1).alias("span"), F.lit("").alias("text")))
    return full.select(*PAGE, "line", F.inline(F.array_sort(F.concat("x", empty))))


def page_html(lines: DataFrame) -> DataFrame:
    """(doc, page, html): a table for pages with columns, a paragraph a line for the others."""
    found = pieces(lines)
    bounds = columns(found)
    span = F.when(F.col("span") > 1, F.concat(F.lit(' colspan="'), F.col("span").cast("string"), F.lit('"'))).otherwise("")
    cell = F.concat(F.lit("<td"), span, F.lit(">"), escaped(F.col("text")), F.lit("</td>"))
    rows = cells(found, bounds).select(*PAGE, "line", F.struct("col", cell.alias("c")).alias("x")).groupBy(*PAGE, "line").agg(F.array_sort(F.collect_list("x")).alias("x"))
    rows = rows.select(*PAGE, F.struct("line", F.concat(F.lit("<tr>"), F.array_join(F.col("x.c"), ""), F.lit("</tr>")).alias("h")).alias("x"), F.lit(True).alias("table"))
    plain = lines.join(bounds, PAGE, "left_anti").select(*PAGE, F.struct("line", F.concat(F.lit("<p>"), escaped(F.coalesce("text", F.lit(""))), F.lit("</p>")).alias("h")).alias("x"), F.lit(False).alias("table"))
    packed = rows.unionByName(plain).groupBy(*PAGE, "table").agg(F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["h"]), "").alias("h"))
    return packed.select(*PAGE, F.when(F.col("table"), F.concat(F.lit("<table>"), "h", F.lit("</table>"))).otherwise(F.col("h")).alias("html"))
