"""Page layout from word boxes: lines, padding, columns, blocks, baselines, and page writers.

Words are rows (doc, page, block, para, word, text, box); a page's words are ordered by windows,
so pages spread over the cluster and none is gathered on the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import escaped
from ..session import dealt

PAGE = ["doc", "page"]


def clamp(box: Column, outer: Column) -> Column:
    """A box within another one."""
    into = lambda v, a, b: F.least(F.greatest(v, a), b)
    return F.struct(
        into(box["l"], outer["l"], outer["r"]).alias("l"), into(box["t"], outer["t"], outer["b"]).alias("t"),
        into(box["r"], outer["l"], outer["r"]).alias("r"), into(box["b"], outer["t"], outer["b"]).alias("b"),
    )


def box_of(vertices: Column) -> Column:
    """The box around corner points, none below zero."""
    side = lambda f, k: F.greatest(F.lit(0), f(F.transform(vertices, lambda v: v[k])))
    return F.struct(side(F.array_min, "x").alias("l"), side(F.array_min, "y").alias("t"), side(F.array_max, "x").alias("r"), side(F.array_max, "y").alias("b"))


def word_text(symbols: Column) -> Column:
    """The symbols of a word with the space (break 1 or 3) or line feed (5) that follows each."""
    return F.array_join(
        F.transform(symbols, lambda s: F.concat(s["text"], F.when(s["brk"].isin(1, 3), " ").when(s["brk"] == 5, "\n").otherwise(""))), ""
    )


def stitched(words: DataFrame) -> DataFrame:
    """words with line: a word starts a line if it is a line's height lower or far to the left of the one before."""
    w = Window.partitionBy(*PAGE).orderBy("block", "para", "word")
    before, box = F.lag("box").over(w), F.col("box")
    height = box["b"] - box["t"]
    lower = F.round((box["t"] - before["t"]) / F.when(height > 0, height)) >= 1
    left = (box["l"] - before["r"]) <= -50
    starts = before.isNull() | F.coalesce((height > 0) & (lower | left), F.lit(False))
    out = dealt(words, *PAGE).withColumn("__s", starts.cast("int"))
    return out.withColumn("line", F.sum("__s").over(w.rowsBetween(Window.unboundedPreceding, 0)) - 1).drop("__s")


def overlapping_lines(words: DataFrame) -> DataFrame:
    """words with line: in order of their tops, a word joins the line whose last top-sorted word it overlaps by half its height."""
    w = Window.partitionBy(*PAGE).orderBy(F.col("box.t"), "block", "para", "word")
    before, box = F.lag("box").over(w), F.col("box")
    shared = F.least(before["b"], box["b"]) - F.greatest(before["t"], box["t"])
    starts = before.isNull() | (2 * shared < F.least(before["b"] - before["t"], box["b"] - box["t"]))
    out = words.withColumn("__s", starts.cast("int"))
    return out.withColumn("line", F.sum("__s").over(w.rowsBetween(Window.unboundedPreceding, 0)) - 1).drop("__s")


def left_breaks(words: DataFrame) -> DataFrame:
    """words with line: within a paragraph, a word that starts left of the one before starts a line."""
    w = Window.partitionBy(*PAGE, "block", "para").orderBy("word")
    starts = F.coalesce(F.col("box.l") < F.lag("box.l").over(w), F.lit(False))
    out = words.withColumn("__s", starts.cast("int"))
    return out.withColumn("line", F.sum("__s").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("__s")


def char_width(lines: DataFrame) -> DataFrame:
    """(doc, page, char_width): from the widest line of each page, null without characters."""
    per = lines.groupBy(*PAGE, "line").agg(
        (F.max("box.r") - F.min("box.l")).alias("width"), F.sum(F.length("text")).alias("chars"), F.count(F.lit(1)).alias("n")
    )
    return per.groupBy(*PAGE).agg(F.max_by(F.struct("width", "chars", "n"), F.struct("width", "line")).alias("x")).select(
        *PAGE, (F.col("x.width") / F.when(F.col("x.chars") + F.col("x.n") > 1, F.col("x.chars") + F.col("x.n") - 1)).alias("char_width")
    )


def line_boxes(lines: DataFrame) -> DataFrame:
    """(doc, page, line, box): around the line's words, none below zero."""
    side = lambda f, k: F.greatest(F.lit(0), f(f"box.{k}"))
    box = F.struct(side(F.min, "l").alias("l"), side(F.min, "t").alias("t"), side(F.max, "r").alias("r"), side(F.max, "b").alias("b"))
    return lines.groupBy(*PAGE, "line").agg(box.alias("box"))


def padded_lines(lines: DataFrame) -> DataFrame:
    """(doc, page, line, text, box): words set apart by as many spaces as their gap is characters wide."""
    w = Window.partitionBy(*PAGE, "line").orderBy(F.col("box.l"), "word")
    left = F.min("box.l").over(Window.partitionBy(*PAGE))
    spaced = lines.join(char_width(lines), PAGE)
    gap = F.col("box.l") - F.coalesce(F.lag("box.r").over(w), left)
    first = F.lag("box").over(w).isNull()
    n = F.coalesce(F.round(gap / F.col("char_width")), F.lit(0)).cast("int")
    spaced = spaced.withColumn("pad", F.when(first, F.greatest(n, F.lit(0))).otherwise(F.greatest(n, F.lit(1))))
    spaced = spaced.withColumn("said", F.concat(F.repeat(F.lit(" "), F.col("pad")), F.col("text")))
    packed = spaced.groupBy(*PAGE, "line").agg(F.array_sort(F.collect_list(F.struct(F.col("box.l").alias("l"), "word", "said"))).alias("x"))
    text = packed.select(*PAGE, "line", F.array_join(F.transform("x", lambda v: v["said"]), "").alias("text"))
    return text.join(line_boxes(lines), [*PAGE, "line"])


def page_text(lines: DataFrame) -> DataFrame:
    """(doc, page, text): padded lines, with empty lines where the gap is more than a line high."""
    rows = padded_lines(lines)
    height = F.avg(F.col("box.b") - F.col("box.t")).over(Window.partitionBy(*PAGE))
    w = Window.partitionBy(*PAGE).orderBy("line")
    gap = F.round((F.col("box.t") - F.lag("box.b").over(w)) / F.when(height > 0, height)).cast("int")
    rows = rows.withColumn("said", F.concat(F.repeat(F.lit("\n"), F.least(F.greatest(F.coalesce(gap, F.lit(0)), F.lit(0)), F.lit(3))), "text"))
    packed = rows.groupBy(*PAGE).agg(F.array_sort(F.collect_list(F.struct("line", "said"))).alias("x"))
    return packed.select(*PAGE, F.array_join(F.transform("x", lambda v: v["said"]), "\n").alias("text"))


def _fit() -> list[Column]:
    """Aggregates of a line's words: the least squares through their bottom middles."""
    x, y = (F.col("box.l") + F.col("box.r")) / 2, F.col("box.b")
    top = F.greatest(F.lit(0), F.min("box.t"))
    return [F.regr_slope(y, x).alias("slope"), (F.coalesce(F.regr_intercept(y, x), F.avg(y)) - top).alias("at0")]


def _fitted() -> list[Column]:
    return [F.coalesce("slope", F.lit(0.0)).alias("slope"), F.round("at0", 6).cast("int").alias("offset")]


def baselines(lines: DataFrame) -> DataFrame:
    """(doc, page, line, slope, offset): least squares through the words' bottom middles; flat for one point."""
    return lines.groupBy(*PAGE, "line").agg(*_fit()).select(*PAGE, "line", *_fitted())


def common_baseline(lines: DataFrame) -> DataFrame:
    """(doc, page, line, bottom): the most frequent bottom of a line's words, of equals the first seen."""
    seen = lines.groupBy(*PAGE, "line", F.col("box.b").alias("bottom")).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("block", "para", "word")).alias("first"))
    nth = F.row_number().over(Window.partitionBy(*PAGE, "line").orderBy(F.desc("n"), "first"))
    return seen.withColumn("__n", nth).where("__n = 1").select(*PAGE, "line", "bottom")


def block_side(box: Column, width: Column) -> Column:
    """center, left or right by where a block's edges lie in percent of the page."""
    left, right = 100 * box["l"] / width, 100 * box["r"] / width
    return F.when((left < 45) & (right > 55), "center").when(right <= 55, "left").otherwise("right")


def ordered_blocks(blocks: DataFrame) -> DataFrame:
    """blocks (doc, page, block, box, width) with place: within runs between full-width blocks, left column before right."""
    sided = blocks.withColumn("side", block_side(F.col("box"), F.col("width")))
    w = Window.partitionBy(*PAGE).orderBy(F.col("box.t"), "block")
    sided = sided.withColumn("__run", F.sum((F.col("side") == "center").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    column = F.when(F.col("side") == "center", 0).when(F.col("side") == "left", 1).otherwise(2)
    place = F.row_number().over(Window.partitionBy(*PAGE).orderBy("__run", column, F.col("box.t"), "block"))
    return sided.withColumn("place", place).drop("__run")


def two_columns(lines: DataFrame, width: str = "width") -> DataFrame:
    """(doc, page, block, two): whether every line of several words has its one wide gap across the page's middle."""
    w = Window.partitionBy(*PAGE, "block", "line").orderBy(F.col("box.l"), "word")
    gaps = lines.withColumn("from", F.lag("box.r").over(w)).withColumn("gap", F.col("box.l") - F.col("from")).where("gap IS NOT NULL")
    mean = F.avg("gap").over(Window.partitionBy(*PAGE, "block", "line"))
    wide = (F.col("gap") > 2.5 * mean) & (F.col("from") <= F.col(width) / 2) & (F.col("box.l") >= F.col(width) / 2)
    per_line = gaps.withColumn("wide", wide).groupBy(*PAGE, "block", "line").agg(F.bool_or("wide").alias("wide"))
    return per_line.groupBy(*PAGE, "block").agg(F.bool_and("wide").alias("two"))


def split_columns(words: DataFrame, blocks: DataFrame, width: str = "width") -> DataFrame:
    """words with column: 1 for the right half of blocks in two columns, else 0. blocks: (doc, page, block, two)."""
    right = (F.col("box.l") + F.col("box.r")) / 2 >= F.col(width) / 2
    joined = words.join(blocks, [*PAGE, "block"], "left")
    return joined.withColumn("column", F.when(F.coalesce("two", F.lit(False)) & right, 1).otherwise(0)).drop("two")


def footnotes(blocks: DataFrame, height: str = "height") -> DataFrame:
    """blocks with footnote: the last block of a page, far below the one before and near the page's end."""
    w = Window.partitionBy(*PAGE).orderBy(F.col("box.t"), "block")
    gap = F.col("box.t") - F.lag("box.b").over(w)
    last = F.lead("block").over(w).isNull()
    low = F.col("box.t") >= 0.85 * F.col(height)
    return blocks.withColumn("footnote", F.coalesce(last & (gap > 55) & low, F.lit(False)))


def sparse_pages(words: DataFrame) -> DataFrame:
    """(doc, page, pre): pages of few words in many short paragraphs, to be shown as they stand."""
    per = words.groupBy(*PAGE).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("block", "para").alias("paras"))
    return per.select(*PAGE, ((F.col("n") < 600) & (F.col("n") / F.greatest("paras", F.lit(1)) < 20)).alias("pre"))


def language_weights(words: DataFrame) -> DataFrame:
    """(doc, lang, weight): how many words name each language."""
    return words.select("doc", F.explode("langs").alias("lang")).groupBy("doc", "lang").agg(F.count(F.lit(1)).alias("weight"))


def _box_text(box: Column) -> Column:
    return F.concat_ws(" ", *[box[k].cast("string") for k in ("l", "t", "r", "b")])


_LINE = [*PAGE, "block", "para", "line"]


def _around(prefix: str = "box") -> Column:
    side = lambda f, k: F.greatest(F.lit(0), f(f"{prefix}.{k}"))
    return F.struct(side(F.min, "l").alias("l"), side(F.min, "t").alias("t"), side(F.max, "r").alias("r"), side(F.max, "b").alias("b"))


def _packed(rows: DataFrame, by: list[str], order: str, piece: Column, between: str = "", more: tuple[list[Column], list[Column]] = ((), ())) -> DataFrame:
    """(by, n, box, x): the pieces of each group in order, their number and the box around them; more: further aggregates, and columns of them."""
    made = rows.withColumn("__x", piece).groupBy(*by).agg(
        F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col("__x").alias("x")))).alias("__a"), _around().alias("box"), *more[0]
    )
    return made.select(*by, F.size("__a").alias("n"), "box", F.array_join(F.transform("__a", lambda v: v["x"]), between).alias("x"), *more[1])


def _element(tag: str, kind: str, number: Column, title: Column, inner: Column) -> Column:
    """An hOCR element with its class, its id (kind_page_number) and its title."""
    return F.concat(
        F.lit(f"<{tag} class='{kind}' id='"), F.format_string("%s_%06d_%06d", F.lit({"ocr_carea": "block", "ocr_par": "par", "ocr_line": "line", "ocrx_word": "word"}[kind]), F.col("page"), number),
        F.lit("' title='"), title, F.lit("'>"), inner, F.lit(f"</{tag}>"),
    )


def _bbox(box: Column) -> Column:
    return F.concat(F.lit("bbox "), _box_text(box))


def hocr(lines: DataFrame) -> DataFrame:
    """(doc, page, hocr): a page of areas, paragraphs, lines and words, each with an id that counts its kind on the page, and its box.

    lines: words with their line. Lines have their baseline, words their confidence in percent and
    their first language. Boxes of lines and above are those around their words.
    """
    number = lambda *order: F.row_number().over(Window.partitionBy(*PAGE).orderBy(*order)).cast("int")
    words = lines.withColumn("n", number("block", "para", "line", "box.l", "word"))
    said = F.concat(_bbox(F.col("box")), F.lit("; x_wconf "), F.floor(F.round(F.col("confidence") * 100, 6)).cast("string"))
    lang = F.concat(said, F.when(F.size("langs") > 0, F.concat(F.lit("' lang='"), F.get("langs", 0))).otherwise(""))
    # a line that crosses paragraphs is one for each of them, so it has the baseline of its part
    rows = _packed(words, _LINE, "n", _element("span", "ocrx_word", F.col("n"), lang, escaped(F.col("text"))), " ", (_fit(), _fitted()))
    rows = rows.withColumn("i", number("block", "para", "line"))
    title = F.concat(_bbox(F.col("box")), F.lit("; baseline "), F.format_string("%.6f %d", "slope", "offset"))
    rows = _packed(rows, [*PAGE, "block", "para"], "line", _element("span", "ocr_line", F.col("i"), title, F.col("x")), "\n").withColumn("i", number("block", "para"))
    rows = _packed(rows, [*PAGE, "block"], "para", _element("p", "ocr_par", F.col("i"), _bbox(F.col("box")), F.col("x")), "\n").withColumn("i", number("block"))
    rows = _packed(rows, PAGE, "block", _element("div", "ocr_carea", F.col("i"), _bbox(F.col("box")), F.col("x")), "\n")
    head = F.concat(F.lit("<div class='ocr_page' id='page_"), F.format_string("%06d", "page"), F.lit("' title='bbox 0 0 "), F.concat_ws(" ", F.col("box.r").cast("string"), F.col("box.b").cast("string")))
    return rows.select(*PAGE, F.concat(head, F.lit("; ppageno "), F.col("page").cast("string"), F.lit("'>\n"), F.col("x"), F.lit("\n</div>")).alias("hocr"))


def _edges(box: Column) -> Column:
    return F.concat(*[x for k in ("l", "t", "r", "b") for x in (F.lit(f' {k}="'), box[k].cast("string"), F.lit('"'))])


def djvu(lines: DataFrame, dpi: int = 300) -> DataFrame:
    """(doc, page, xml): an OBJECT with hidden text by columns, paragraphs, lines and words; coords are left, bottom, right, top, bottom."""
    coords = F.concat_ws(",", *[F.col(f"box.{k}").cast("string") for k in ("l", "b", "r", "t", "b")])
    rows = lines.withColumn("o", F.struct(F.col("box.l").alias("l"), "word"))
    rows = _packed(rows, _LINE, "o", F.concat(F.lit('<WORD coords="'), coords, F.lit('">'), escaped(F.col("text")), F.lit("</WORD>")))
    rows = _packed(rows, [*PAGE, "block", "para"], "line", F.concat(F.lit("<LINE>"), F.col("x"), F.lit("</LINE>")))
    rows = _packed(rows, [*PAGE, "block"], "para", F.concat(F.lit("<PARAGRAPH>"), F.col("x"), F.lit("</PARAGRAPH>")))
    rows = _packed(rows, PAGE, "block", F.concat(F.lit("<PAGECOLUMN><REGION>"), F.col("x"), F.lit("</REGION></PAGECOLUMN>")))
    head = F.concat(F.lit('<OBJECT type="image/x.djvu" height="'), F.col("box.b").cast("string"), F.lit('" width="'), F.col("box.r").cast("string"), F.lit(f'"><PARAM name="DPI" value="{dpi}"/><HIDDENTEXT>'))
    return rows.select(*PAGE, F.concat(head, F.col("x"), F.lit("</HIDDENTEXT></OBJECT>")).alias("xml"))


def abbyy(lines: DataFrame, dpi: int = 300) -> DataFrame:
    """(doc, page, xml): blocks, paragraphs, lines with their most frequent baseline, words, and the spaces between words of a line."""
    order = F.struct(F.col("box.l").alias("l"), "word")
    before = F.lag("box").over(Window.partitionBy(*_LINE).orderBy("box.l", "word"))
    space = F.struct((before["r"] + 1).alias("l"), before["t"].alias("t"), (F.col("box.l") - 1).alias("r"), F.col("box.b").alias("b"))
    shown = lambda box, text: F.concat(F.lit("<charParams"), _edges(box), F.lit(">"), text, F.lit("</charParams>"))
    rows = lines.withColumn("gap", space).withColumn("o", order)
    piece = F.concat(F.when(F.col("gap.l") < F.col("gap.r"), shown(F.col("gap"), F.lit(" "))).otherwise(""), shown(F.col("box"), escaped(F.col("text"))))
    # words of one bottom first, so that the most frequent one, of equals the first seen, needs no join
    alike = rows.withColumn("__x", F.struct(F.col("o"), piece.alias("x"))).groupBy(*_LINE, F.col("box.b").alias("bottom")).agg(
        F.struct((-F.count(F.lit(1))).alias("n"), F.min("word").alias("first")).alias("turn"), F.collect_list("__x").alias("xs"), _around().alias("box")
    )
    rows = alike.groupBy(*_LINE).agg(F.min(F.struct("turn", "bottom"))["bottom"].alias("bottom"), F.array_sort(F.flatten(F.collect_list("xs"))).alias("__a"), _around().alias("box"))
    rows = rows.select(*_LINE, "bottom", "box", F.array_join(F.transform("__a", lambda v: v["x"]), "").alias("x"))
    line = F.concat(F.lit('<line baseline="'), F.col("bottom").cast("string"), F.lit('"'), _edges(F.col("box")), F.lit("><formatting>"), F.col("x"), F.lit("</formatting></line>"))
    rows = _packed(rows, [*PAGE, "block", "para"], "line", line)
    rows = _packed(rows, [*PAGE, "block"], "para", F.concat(F.lit("<par>"), F.col("x"), F.lit("</par>")))
    box = _edges(F.col("box"))
    block = F.concat(F.lit('<block blockType="Text" blockName=""'), box, F.lit("><region><rect"), box, F.lit("/></region><text>"), F.col("x"), F.lit("</text></block>"))
    rows = _packed(rows, PAGE, "block", block)
    head = F.concat(F.lit('<page width="'), F.col("box.r").cast("string"), F.lit('" height="'), F.col("box.b").cast("string"), F.lit(f'" resolution="{dpi}" originalCoords="1">'))
    return rows.select(*PAGE, F.concat(head, F.col("x"), F.lit("</page>")).alias("xml"))


def title_attribute(pairs: Column) -> Column:
    """'key value; key value' of an array of (k, v); entries without a value are left out."""
    kept = F.filter(pairs, lambda p: p["v"].isNotNull())
    return F.array_join(F.transform(kept, lambda p: F.concat_ws(" ", p["k"], p["v"])), "; ")
