"""Paragraphs over pages: lines in groups, runs of capitals, footnotes set aside, what a page leaves open.

A group of lines is what a recogniser's block holds up to a sentence's end; groups begin paragraphs, and so do
lines in them that stand off, begin a run of lines in capitals, or are marked as items. The last line of a group
far down its page is a footnote. What the last group of a column leaves without a sentence's end goes on in the
next paragraph, on the next column or page, unless that is all in capitals or marked.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import escaped, sentence_end

#: A line that stands off by more than so many of its heights, where a sentence has ended or it begins with a capital.
APART = 1.3
#: Footnotes: how far down the page, alone or below other lines, and by how many line heights away from these.
ALONE, BELOW, AWAY = 0.87, 0.85, 1.35
#: Items and lines of numbers and capitals.
MARKED = "^(?:[\\p{L}\\p{N}_]\\)\\s+|[0-9\\sA-Z]+$)"


def grouped(lines: DataFrame) -> DataFrame:
    """lines (doc, page, height, column, block, para, line, text, box) with group and footnote.

    Lines are in the order of (page, line); para is the recogniser's, height that of the page.
    """
    order = Window.partitionBy("doc").orderBy("page", "line")
    same = lambda c: F.lag(c).over(order) == F.col(c)
    opens = ~F.coalesce(same("page") & same("block") & (same("para") | ~sentence_end(F.lag("text").over(order))), F.lit(False))
    rows = lines.withColumn("__o", opens.cast("int")).withColumn("group", F.sum("__o").over(order.rowsBetween(Window.unboundedPreceding, 0))).drop("__o")
    own = Window.partitionBy("doc", "group").orderBy("page", "line")
    top, before = F.col("box.t"), F.lag("box").over(own)
    last = F.lead("line").over(own).isNull()
    alone = before.isNull() & (top > ALONE * F.col("height"))
    below = (top > BELOW * F.col("height")) & ((top - before["t"]) > AWAY * (before["b"] - before["t"]))
    return rows.withColumn("footnote", last & F.coalesce(alone | below, F.lit(False)))


def layout_paragraphs(lines: DataFrame) -> DataFrame:
    """lines with group, footnote and paragraph, a number over the whole document; footnotes have none."""
    rows = grouped(lines)
    text = rows.where("NOT footnote")
    capitals = F.forall(F.filter(F.split(F.trim("text"), "\\s+"), lambda w: w != ""), lambda w: ~w.rlike("^[a-z]"))
    text = text.withColumn("__caps", capitals).withColumn("__marked", F.trim("text").rlike(MARKED)).withColumn("__ended", sentence_end(F.col("text")))
    own = Window.partitionBy("doc", "group").orderBy("page", "line")
    before = lambda c: F.lag(c).over(own)
    apart = (F.col("box.t") - before("box")["t"]) > APART * (F.col("box.b") - F.col("box.t"))
    starts = before("line").isNull() | (before("__ended") & apart) | (F.col("__caps") & ~before("__caps")) | F.col("__marked") | (F.trim("text").rlike("^[A-Z]") & apart)
    order = Window.partitionBy("doc").orderBy("page", "line")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    text = text.withColumn("__s", starts.cast("int")).withColumn("__p", F.sum("__s").over(so_far))
    final = (F.col("group") == F.max("group").over(Window.partitionBy("doc", "page", "column"))) & F.lead("line").over(own).isNull()
    text = text.withColumn("__final", final)
    # paragraphs as rows: whether one is left open, and whether the next may take it up
    place = F.struct("page", "line")
    paras = text.groupBy("doc", "__p").agg(
        F.bool_and("__caps").alias("caps"), F.min_by("__marked", place).alias("marked"), F.max_by(F.col("__final") & ~F.col("__ended"), place).alias("open")
    )
    turn = Window.partitionBy("doc").orderBy("__p")
    goes_on = F.coalesce(F.lag("open").over(turn) & ~F.col("caps") & ~F.col("marked"), F.lit(False))
    paras = paras.withColumn("__n", (~goes_on).cast("int")).select("doc", "__p", F.sum("__n").over(turn.rowsBetween(Window.unboundedPreceding, 0)).alias("paragraph"))
    numbered = text.join(paras, ["doc", "__p"]).select(*rows.columns, "paragraph")
    return numbered.unionByName(rows.where("footnote").withColumn("paragraph", F.lit(None).cast("long")))


def _joined(name: str = "x"):
    lines = F.array_join(F.transform(F.array_sort(name), lambda v: F.trim(v["text"])), " ")
    return F.regexp_replace(lines, "(\\p{Ll})- (\\p{Ll})", "$1$2")


def paragraph_texts(lines: DataFrame) -> DataFrame:
    """(doc, paragraph, first_page, last_page, text): a paragraph's lines joined, words cut at a line's end joined again."""
    packed = layout_paragraphs(lines).where("paragraph IS NOT NULL").groupBy("doc", "paragraph").agg(
        F.min("page").alias("first_page"), F.max("page").alias("last_page"), F.collect_list(F.struct("page", "line", "text")).alias("x")
    )
    return packed.select("doc", "paragraph", "first_page", "last_page", _joined().alias("text"))


def document_html(lines: DataFrame, tag: str = "p") -> DataFrame:
    """(doc, html): the paragraphs in order, each page's footnotes after those that end on it, then a mark of the page's end."""
    placed = layout_paragraphs(lines)
    element = lambda open_, text, close: F.concat(F.lit(open_), escaped(text), F.lit(close))
    paras = placed.where("paragraph IS NOT NULL").groupBy("doc", "paragraph").agg(F.max("page").alias("page"), F.collect_list(F.struct("page", "line", "text")).alias("x"))
    rows = paras.select("doc", F.struct("page", F.lit(0).alias("kind"), F.col("paragraph").cast("long").alias("at"), element(f"<{tag}>", _joined(), f"</{tag}>").alias("h")).alias("e"))
    notes = placed.where("footnote").select("doc", F.struct("page", F.lit(1).alias("kind"), F.col("line").cast("long").alias("at"), element('<span class="footnote">', F.trim("text"), "</span>").alias("h")).alias("e"))
    pages = lines.select("doc", "page").distinct().withColumn("n", F.row_number().over(Window.partitionBy("doc").orderBy("page")))
    end = F.concat(F.lit('<span class="pageend" data-pagenum="'), F.col("n").cast("string"), F.lit('"></span>'))
    ends = pages.select("doc", F.struct("page", F.lit(2).alias("kind"), F.lit(0).cast("long").alias("at"), end.alias("h")).alias("e"))
    packed = rows.unionByName(notes).unionByName(ends).groupBy("doc").agg(F.array_sort(F.collect_list("e")).alias("e"))
    return packed.select("doc", F.array_join(F.col("e.h"), "\n").alias("html"))
