"""From lines to paragraphs and tables: breaks, carry-over between pages, columns from gaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import escaped, sentence_end
from .layout import PAGE

LIST_MARK = "^\\s*(?:\\(?[0-9]{1,3}[.)]|\\(?[a-z]{1,4}\\)|[•●▪-])\\s"


def paragraphs(lines: DataFrame) -> DataFrame:
    """lines (doc, page, line, text, box) with para, a running number over the whole document.

    A line begins a paragraph after a sentence's end if it stands off by more than 1.3 line
    heights, is indented, or its words all begin with capitals; with a list mark it always does.
    On a new page only sentence ends, list marks and capitals count, so a paragraph that is not
    at its end goes on.
    """
    w = Window.partitionBy("doc").orderBy("page", "line")
    height = F.greatest(F.avg(F.col("box.b") - F.col("box.t")).over(Window.partitionBy(*PAGE)), F.lit(1.0))
    left = F.min("box.l").over(Window.partitionBy(*PAGE))
    rows = lines.withColumn("__h", height).withColumn("__left", left)
    ended = sentence_end(F.lag("text").over(w))
    new_page = F.lag("page").over(w) != F.col("page")
    apart = ((F.col("box.t") - F.lag("box.t").over(w)) / F.col("__h")) > 1.3 * 1.2
    indented = (F.col("box.l") - F.col("__left")) > F.col("__h")
    capitals = F.forall(F.split(F.trim("text"), "\\s+"), lambda x: ~x.rlike("^[a-z]"))
    starts = F.lag("text").over(w).isNull() | F.col("text").rlike(LIST_MARK) | (ended & (capitals | (~new_page & (apart | indented))))
    rows = rows.withColumn("__s", F.coalesce(starts, F.lit(False)).cast("int"))
    return rows.withColumn("para", F.sum("__s").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("__s", "__h", "__left")


def paragraph_texts(lines: DataFrame) -> DataFrame:
    """(doc, para, first_page, text): lines joined by spaces, words cut at a line's end joined again."""
    packed = paragraphs(lines).groupBy("doc", "para").agg(
        F.min("page").alias("first_page"), F.array_sort(F.collect_list(F.struct("page", "line", "text"))).alias("x")
    )
    joined = F.array_join(F.transform("x", lambda v: F.trim(v["text"])), " ")
    return packed.select("doc", "para", "first_page", F.regexp_replace(joined, "(\\p{Ll})- (\\p{Ll})", "$1$2").alias("text"))


def table_columns(words: DataFrame, wide: int = 40, share: float = 0.6, step: int = 10) -> DataFrame:
    """(doc, page, block, bounds): left edges that most lines of a block start a word at after a wide gap."""
    w = Window.partitionBy(*PAGE, "block", "line").orderBy(F.col("box.l"), "word")
    gap = F.col("box.l") - F.lag("box.r").over(w)
    edges = words.withColumn("gap", gap).where(F.col("gap") >= wide).withColumn("edge", (F.round(F.col("box.l") / step) * step).cast("int"))
    lines = words.groupBy(*PAGE, "block").agg(F.countDistinct("line").alias("lines"))
    counted = edges.groupBy(*PAGE, "block", "edge").agg(F.countDistinct("line").alias("n")).join(lines, [*PAGE, "block"])
    often = counted.where((F.col("n") >= share * F.col("lines")) & (F.col("lines") > 1))
    return often.groupBy(*PAGE, "block").agg(F.sort_array(F.collect_list("edge")).alias("bounds"))


def table_cells(words: DataFrame, bounds: DataFrame, step: int = 10) -> DataFrame:
    """(doc, page, block, line, col, span, text): the words of each cell, and how many columns it covers."""
    placed = words.join(bounds, [*PAGE, "block"])
    column = lambda x: F.size(F.filter("bounds", lambda b: b <= x + step / 2))
    placed = placed.withColumn("col", column(F.col("box.l"))).withColumn("last", column(F.col("box.r") - step))
    packed = placed.groupBy(*PAGE, "block", "line", "col").agg(
        F.max("last").alias("last"), F.array_sort(F.collect_list(F.struct(F.col("box.l").alias("l"), "word", "text"))).alias("x")
    )
    text = F.array_join(F.transform("x", lambda v: v["text"]), " ")
    return packed.select(*PAGE, "block", "line", "col", (F.greatest(F.col("last") - F.col("col"), F.lit(0)) + 1).alias("span"), text.alias("text"))


def table_html(cells: DataFrame) -> DataFrame:
    """(doc, page, block, html): a table with colspans."""
    span = F.when(F.col("span") > 1, F.concat(F.lit(' colspan="'), F.col("span").cast("string"), F.lit('"'))).otherwise("")
    cell = F.concat(F.lit("<td"), span, F.lit(">"), escaped(F.col("text")), F.lit("</td>"))
    rows = cells.withColumn("c", cell).groupBy(*PAGE, "block", "line").agg(F.array_sort(F.collect_list(F.struct("col", "c"))).alias("x"))
    row = F.concat(F.lit("<tr>"), F.array_join(F.transform("x", lambda v: v["c"]), ""), F.lit("</tr>"))
    packed = rows.select(*PAGE, "block", "line", row.alias("r")).groupBy(*PAGE, "block").agg(F.array_sort(F.collect_list(F.struct("line", "r"))).alias("x"))
    return packed.select(*PAGE, "block", F.concat(F.lit("<table>"), F.array_join(F.transform("x", lambda v: v["r"]), ""), F.lit("</table>")).alias("html"))


def iso_languages(shares: DataFrame, codes: DataFrame) -> DataFrame:
    """shares (lang, ...) with the three-letter code of each language; languages without one are left out."""
    return shares.join(codes.select(F.col("short").alias("lang"), "code"), "lang")


def paragraph_html(paras: DataFrame, tag: Column) -> DataFrame:
    """(doc, html): a document's paragraphs in order, each in its tag."""
    one = F.concat(F.lit("<"), tag, F.lit(">"), escaped(F.col("text")), F.lit("</"), tag, F.lit(">"))
    packed = paras.withColumn("h", one).groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("para", "h"))).alias("x"))
    return packed.select("doc", F.array_join(F.transform("x", lambda v: v["h"]), "\n").alias("html"))
