"""What is inside files: archives, links of PDF files, and XML trees as node tables."""

from __future__ import annotations

import io
import json
import re
import tarfile
import zipfile
import zlib
from html.entities import html5
from xml.etree import ElementTree

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.trees import documents
from .entities import XML_OWN, with_entities

_STREAM = re.compile(rb"stream\r?\n(.*?)\r?\nendstream", re.S)
_URI = re.compile(rb"/URI\s*\(((?:[^()\\]|\\.)*)\)")
_ENTITY = re.compile(r"&([A-Za-z][A-Za-z0-9]*);")
_FILE = T.StructType([T.StructField("name", T.StringType()), T.StructField("content", T.BinaryType())])


@F.udf(T.ArrayType(_FILE), useArrow=True)
def members(content):
    """The files of a zip or tar archive, for explode; none for other content."""
    if content is None:
        return []
    data = io.BytesIO(bytes(content))
    if zipfile.is_zipfile(data):
        with zipfile.ZipFile(data) as z:
            return [(i.filename, z.read(i)) for i in z.infolist() if not i.is_dir()]
    data.seek(0)
    try:
        with tarfile.open(fileobj=data) as t:
            return [(m.name, t.extractfile(m).read()) for m in t.getmembers() if m.isfile()]
    except tarfile.TarError:
        return []


@F.udf(T.ArrayType(T.StringType()), useArrow=True)
def pdf_links_in_streams(content):
    """External addresses in a PDF's objects and in its compressed streams, once each, in order."""
    if content is None:
        return []
    data = bytes(content)
    parts = [data]
    for m in _STREAM.finditer(data):
        try:
            parts.append(zlib.decompressobj().decompress(m[1]))
        except zlib.error:
            continue
    return list(dict.fromkeys(m[1].decode("latin-1") for part in parts for m in _URI.finditer(part)))


def pdf_links(content: Column) -> Column:
    """External addresses in a PDF's uncompressed objects, once each."""
    return F.array_distinct(F.regexp_extract_all(F.decode(content, "ISO-8859-1"), F.lit("/URI\\s*\\(((?:[^()\\\\]|\\\\.)*)\\)"), 1))


def _with_entities(xml: str, entities: dict[str, str] | None = None) -> str:
    """Named entities as the characters they stand for, but for those that XML has itself; declared ones before HTML's."""
    if entities:
        xml = with_entities(xml, entities)
    return _ENTITY.sub(lambda m: m[0] if m[1] in XML_OWN else html5.get(f"{m[1]};", m[0]), xml)


def _as_object(element):
    children = list(element)
    if not children:
        return element.text or ""
    out = {}
    for c in children:
        out.setdefault(c.tag, []).append(_as_object(c))
    return {k: v[0] if len(v) == 1 else v for k, v in out.items()}


@F.udf(T.StringType(), useArrow=True)
def xml_object(xml):
    """XML of unknown tags as JSON: tags with text only are texts, others objects, repeated tags lists; null if it is broken."""
    if not xml:
        return None
    try:
        return json.dumps(_as_object(ElementTree.fromstring(_with_entities(xml))), ensure_ascii=False, separators=(",", ":"))
    except ElementTree.ParseError:
        return None


@F.udf(T.BinaryType(), useArrow=True)
def zipped(files):
    """A zip archive of an array of (name, content), stored without compression; the names in their order."""
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        for f in files if files is not None else []:
            z.writestr(zipfile.ZipInfo(f["name"]), bytes(f["content"]))
    return data.getvalue()


_NODE = T.StructType(
    [
        T.StructField("node", T.IntegerType()),
        T.StructField("parent", T.IntegerType()),
        T.StructField("tag", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("num", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("version", T.IntegerType()),
        T.StructField("text", T.StringType()),
    ]
)


def _nodes(xml: str | None, entities: dict[str, str] | None) -> list[tuple]:
    if not xml:
        return []
    try:
        root = ElementTree.fromstring(_with_entities(xml, entities))
    except ElementTree.ParseError:
        return []
    rows, todo = [], [(root, None)]
    while todo:
        element, parent = todo.pop()
        node = len(rows) + 1
        own = {c.tag: " ".join("".join(c.itertext()).split()) for c in element if c.tag in ("number", "name")}
        version = element.get("version", "")
        text = " ".join((element.text or "").split()) or None
        rows.append((node, parent, element.tag, element.get("type"), own.get("number"), own.get("name"), int(version) if version.isdigit() else None, text))
        todo += [(c, node) for c in reversed(element) if c.tag not in ("number", "name")]
    return rows


def xml_nodes(xml: Column, entities: dict[str, str] | None = None) -> Column:
    """The elements of an XML text in document order; a number or name child fills num or title. Broken XML has none.

    entities: the texts of declared names (see entities).
    """
    return F.udf(lambda x: _nodes(x, entities), T.ArrayType(_NODE), useArrow=True)(xml)


def node_table(files: DataFrame, key: str, xml: str, entities: dict[str, str] | None = None) -> DataFrame:
    """(reg, node, parent, ...) of all XML texts."""
    return files.select(F.col(key).alias("reg"), F.explode(xml_nodes(F.col(xml), entities)).alias("n")).select("reg", "n.*")


def akn_document(nodes: DataFrame) -> DataFrame:
    """(reg, xml): the identified nodes of each regulation as nested elements of a body; those whose parent is missing stand in the body."""
    there = nodes.select("reg", F.col("node").alias("parent"), F.lit(True).alias("__there"))
    up = F.when(F.col("__there"), F.col("parent").cast("long")).otherwise(0)
    elements = nodes.join(there, ["reg", "parent"], "left").select(
        "reg", F.col("node").cast("long").alias("el"), up.alias("parent"), F.coalesce("becomes", F.lit("block")).alias("element"), "eid", "num", F.col("title").alias("heading"), "text"
    )
    none = F.lit(None).cast("string")
    body = nodes.select("reg").distinct().select(
        "reg", F.lit(0).cast("long").alias("el"), F.lit(None).cast("long").alias("parent"), F.lit("body").alias("element"), none.alias("eid"), none.alias("num"), none.alias("heading"), none.alias("text")
    )
    return documents(elements.unionByName(body))
