"""Files of an archive as tables: listings by source, date and time, metadata XML, JSON and subtitles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates
from ..operators.filters import dated_or_unbounded
from ..operators.layout import box_of, word_text

#: The metadata fields of fixed meaning; all others stay in the map.
METADATA = (
    "date struct<day:int,month:int,year:int>, department string, gazetteid string, ministry string, office string, subject string,"
    " title string, url string, href string, gznum string, gztype string, partnum string, notification_num string, refnum string,"
    " year string, bookid string, series string, creator string, language string, keywords array<string>, _corrupt string"
)


def listing(spark: SparkSession, root: str, index: int = 0, kind: str = "raw", pattern: str = "*") -> DataFrame:
    """(root, kind, relurl, ext, size, mtime) of all files below a root; contents are not read."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    )
    below = F.regexp_replace(F.col("path"), f"^.*?{_quoted(root.rstrip('/'))}/", "")
    return files.select(
        F.lit(index).alias("root"), F.lit(kind).alias("kind"), F.regexp_replace(below, "\\.[^./]*$", "").alias("relurl"),
        F.regexp_extract(below, "\\.([^./]*)$", 1).alias("ext"), F.col("length").alias("size"), F.col("modificationTime").alias("mtime"),
    )


def _quoted(text: str) -> str:
    import re

    return re.escape(re.sub(r"^[a-z]+:/+", "/", text))


def sources_of(assets: DataFrame, names: list[str]) -> DataFrame:
    """Assets of these sources; all if none is named."""
    return assets.where(F.substring_index("relurl", "/", 1).isin(names)) if names else assets


def dated_assets(assets: DataFrame, first=None, last=None) -> DataFrame:
    """Assets whose relative url has a date in the range; undated ones only without a range."""
    return assets.where(dated_or_unbounded(dates.relurl_date(F.col("relurl")), first, last))


def changed_between(raw: DataFrame, meta: DataFrame, start=None, end=None) -> DataFrame:
    """(relurl, raw_mtime, meta_mtime) for documents with both files, of which one was changed in the time."""
    both = raw.select("relurl", F.col("mtime").alias("raw_mtime")).join(meta.select("relurl", F.col("mtime").alias("meta_mtime")), "relurl")
    if start is not None:
        both = both.where(F.greatest("raw_mtime", "meta_mtime") >= F.lit(start))
    if end is not None:
        both = both.where(F.least("raw_mtime", "meta_mtime") <= F.lit(end))
    return both


def metadata_of(xml: Column) -> Column:
    """Metadata XML as a struct of METADATA, all fields null if it is malformed."""
    return F.from_xml(xml, METADATA, {"rowTag": "document", "columnNameOfCorruptRecord": "_corrupt", "ignoreSurroundingSpaces": "false"})


def parsed_metadata(rows: DataFrame, xml: str) -> DataFrame:
    """rows with meta, date and malformed: no children, plain text and broken XML are malformed, null is not."""
    meta = rows.withColumn("meta", metadata_of(F.col(xml)))
    has_child = F.col(xml).rlike("(?s)<document[^>]*>\\s*<[A-Za-z]") & F.col(xml).rlike("</document>\\s*$")
    malformed = F.col(xml).isNotNull() & (F.col("meta._corrupt").isNotNull() | ~has_child)
    d = F.col("meta.date")
    return meta.withColumn("date", dates.date_of(d["year"].cast("string"), d["month"].cast("string"), d["day"].cast("string"))).withColumn(
        "malformed", F.coalesce(malformed, F.lit(False))
    )


def records_of_json(text: Column, schema: str) -> Column:
    """The records of a JSON reply; null if it is none."""
    return F.from_json(text, schema, {"mode": "PERMISSIVE"})


_VERTEX = "struct<x:int,y:int>"
#: The fields of a cached reply of a text recogniser that words are made of.
OCR_REPLY = (
    "pages array<struct<width:int,height:int,blocks:array<struct<paragraphs:array<struct<words:array<struct<confidence:double,"
    f"langs:array<string>,vertices:array<{_VERTEX}>,symbols:array<struct<text:string,brk:int>>>>>>>>>>, text string"
)


def ocr_words(replies: DataFrame, doc: str, reply: str) -> DataFrame:
    """(doc, page, block, para, word, text, box, confidence, langs) of cached replies (JSON); broken ones have no words."""
    rows = replies.select(F.col(doc).alias("doc"), F.from_json(reply, OCR_REPLY).alias("r"))
    rows = rows.select("doc", F.posexplode("r.pages").alias("page", "p")).select("doc", "page", F.posexplode("p.blocks").alias("block", "b"))
    rows = rows.select("doc", "page", "block", F.posexplode("b.paragraphs").alias("para", "a")).select("doc", "page", "block", "para", F.posexplode("a.words").alias("word", "w"))
    text = F.rtrim(word_text(F.col("w.symbols")))
    return rows.select("doc", "page", "block", "para", "word", text.alias("text"), box_of(F.col("w.vertices")).alias("box"), "w.confidence", "w.langs")


def plain_replies(replies: DataFrame, doc: str, reply: str) -> DataFrame:
    """(doc, text): the recogniser's own text of each reply."""
    return replies.select(F.col(doc).alias("doc"), F.from_json(reply, OCR_REPLY)["text"].alias("text"))


def subtitles(spark: SparkSession, path: str) -> DataFrame:
    """(path, number, start_s, end_s, text) of SRT files; cues without a time line are left out."""
    cues = spark.read.option("lineSep", "\n\n").text(path).select("value", F.input_file_name().alias("path"))
    time = "([0-9]+):([0-9]+):([0-9]+)[,.]([0-9]+)\\s*-->\\s*([0-9]+):([0-9]+):([0-9]+)[,.]([0-9]+)"
    part = lambda n: F.regexp_extract("value", time, n).try_cast("double")
    seconds = lambda a: part(a) * 3600 + part(a + 1) * 60 + part(a + 2) + part(a + 3) / 1000
    return cues.where(F.col("value").rlike(time)).select(
        "path", F.regexp_extract("value", "^\\s*([0-9]+)\\s*\\n", 1).try_cast("int").alias("number"), seconds(1).alias("start_s"),
        seconds(5).alias("end_s"), F.btrim(F.regexp_extract("value", "(?s)-->[^\\n]*\\n(.*)$", 1), F.lit(" \n")).alias("text"),
    )


def sbv_cues(lines: DataFrame) -> DataFrame:
    """(doc, cue, text) from (doc, idx, line) of SBV files: a time line opens a cue, an empty line closes it."""
    from ..operators.windows import numbered

    opened = F.col("line").rlike("^[0-9]+:[0-9]{2}:[0-9]{2}[.,][0-9]+,[0-9]+:[0-9]{2}:[0-9]{2}")
    rows = numbered(lines, ["doc"], ["idx"], opened, "cue").withColumn("opens", opened)
    from pyspark.sql import Window

    w = Window.partitionBy("doc", "cue").orderBy("idx").rowsBetween(Window.unboundedPreceding, 0)
    closed = F.max((F.trim("line") == "").cast("int")).over(w) == 1
    said = rows.withColumn("closed", closed).where((F.col("cue") > 0) & ~F.col("opens") & ~F.col("closed"))
    packed = said.groupBy("doc", "cue").agg(F.array_sort(F.collect_list(F.struct("idx", "line"))).alias("x"))
    return packed.select("doc", "cue", F.array_join(F.transform("x", lambda v: v["line"]), "\n").alias("text"))
