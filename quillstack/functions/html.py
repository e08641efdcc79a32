"""HTML: text with line structure, safe fragments, tables, forms and marked-up ranges.

Pages are not well-formed, so a small tolerant reader from the standard library goes through each
page within Arrow batches; what can be said as an expression over columns is one.
"""

from __future__ import annotations

import re
from html import escape
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Tags kept in a fragment, tags removed with what they hold, attributes kept.
ALLOWED_TAGS = frozenset(
    "p div span br hr h1 h2 h3 h4 h5 h6 b i u s em strong sub sup small ul ol li dl dt dd table thead tbody tfoot tr td th"
    " caption blockquote pre code a section article figure figcaption center".split()
)
DROP_TAGS = frozenset(
    "script style link meta title head noscript iframe object embed applet form input button select textarea svg math base"
    " frame frameset img picture source video audio".split()
)
ALLOWED_ATTRIBUTES = {"a": {"href", "title"}, "td": {"colspan", "rowspan"}, "th": {"colspan", "rowspan", "scope"}}
SAFE_URL = re.compile(r"^(https?://|mailto:|#|/)", re.I)
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_SILENT = frozenset("script style head title".split())


class _Text(HTMLParser):
    """All text outside script, style, head and title, a line feed between pieces."""

    def __init__(self, between: str = "\n", silent=_SILENT):
        super().__init__(convert_charrefs=True)
        self.between, self.silent, self.depth, self.out = between, silent, 0, []

    def handle_starttag(self, tag, attrs):
        self.depth += tag in self.silent

    def handle_endtag(self, tag):
        self.depth -= tag in self.silent and self.depth > 0

    def handle_data(self, data):
        if not self.depth and data:
            self.out.append(data)


def _read(parser: HTMLParser, page: str) -> HTMLParser:
    parser.feed(page)
    parser.close()
    return parser


@F.pandas_udf(T.StringType())
def raw_text(page: pd.Series) -> pd.Series:
    """Pieces of text joined by line feeds; null stays null."""
    return page.map(lambda x: None if x is None else "\n".join(_read(_Text(), x).out))


def tidy(text: Column) -> Column:
    """No-break spaces to spaces, runs of spaces to one, none around line feeds, at most one empty line."""
    t = F.replace(text, F.lit("\u00a0"), F.lit(" "))
    for pattern, by in (("[ \\t\\r\\f\\x0B]+", " "), (" ?\\n ?", "\n"), ("\\n{3,}", "\n\n")):
        t = F.regexp_replace(t, pattern, by)
    return F.btrim(t, F.lit(" \n"))


def plain_text(page: Column) -> Column:
    """The text of a page for search and display."""
    return tidy(raw_text(page))


class _Safe(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.dropped, self.open = [], [], []

    def handle_starttag(self, tag, attrs):
        if self.dropped or tag in DROP_TAGS:
            if tag not in VOID:
                self.dropped.append(tag)
        elif tag in ALLOWED_TAGS:
            kept = ALLOWED_ATTRIBUTES.get(tag, set()) | {"class"}
            shown = "".join(
                f' {k}="{escape(v or "", quote=True)}"'
                for k, v in attrs
                if k in kept and (k != "href" or SAFE_URL.match((v or "").strip()))
            )
            self.out.append(f"<{tag}{shown}{'/' if tag in VOID else ''}>")
            if tag not in VOID:
                self.open.append(tag)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if self.dropped:
            if tag in self.dropped:
                while self.dropped.pop() != tag:
                    pass
        elif tag in self.open:
            while True:
                last = self.open.pop()
                self.out.append(f"</{last}>")
                if last == tag:
                    break

    def handle_data(self, data):
        if not self.dropped:
            self.out.append(escape(data, quote=False))

    def result(self) -> str:
        return ("".join(self.out) + "".join(f"</{t}>" for t in reversed(self.open))).strip()


@F.pandas_udf(T.StringType())
def safe_fragment(page: pd.Series) -> pd.Series:
    """The page's body with allowed tags and attributes only, open tags closed."""
    return page.map(lambda x: None if x is None else _read(_Safe(), x).result())


class _Contents(_Text):
    """Text with a space before every tag but span."""

    def __init__(self):
        super().__init__(silent=frozenset(["script", "style"]))

    def handle_starttag(self, tag, attrs):
        super().handle_starttag(tag, attrs)
        if tag != "span":
            self.out.append(" ")


@F.pandas_udf(T.StringType())
def cell_text(fragment: pd.Series) -> pd.Series:
    return fragment.map(lambda x: None if x is None else "".join(_read(_Contents(), x).out))


class _Own(HTMLParser):
    """The texts directly within the outermost element of a fragment."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open, self.out = [], []

    def handle_starttag(self, tag, attrs):
        if tag not in VOID:
            self.open.append(tag)

    def handle_startendtag(self, tag, attrs):
        pass

    def handle_endtag(self, tag):
        if tag in self.open:
            while self.open.pop() != tag:
                pass

    def handle_data(self, data):
        if len(self.open) == 1:
            self.out.append(data)


@F.pandas_udf(T.ArrayType(T.StringType()))
def own_texts(fragment: pd.Series) -> pd.Series:
    """The texts of a fragment's outermost element that are in no element within it, in order; none for null."""
    return fragment.map(lambda x: [] if x is None else _read(_Own(), x).out)


class _Tables(HTMLParser):
    """Rows of every table: (table, leaf, row, header, cells, hrefs)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack, self.rows, self.count, self.not_leaf = [], [], -1, set()
        self.cell = self.row = None

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            if self.stack:
                self.not_leaf.add(self.stack[-1][0])
            self.count += 1
            self.stack.append([self.count, 0])
            self.row = self.cell = None
        elif tag == "tr" and self.stack:
            self._end_row()
            self.row = {"table": self.stack[-1][0], "row": self.stack[-1][1], "header": False, "cells": [], "hrefs": []}
            self.stack[-1][1] += 1
        elif tag in ("td", "th") and self.row is not None:
            self._end_cell()
            self.row["header"] |= tag == "th"
            self.cell = []
        elif tag == "a" and self.row is not None:
            self.row["hrefs"].append(dict(attrs).get("href") or "")
        if self.cell is not None and tag != "span":
            self.cell.append(" ")

    def handle_endtag(self, tag):
        if tag in ("td", "th"):
            self._end_cell()
        elif tag == "tr":
            self._end_row()
        elif tag == "table" and self.stack:
            self._end_row()
            self.stack.pop()

    def handle_data(self, data):
        if self.cell is not None:
            self.cell.append(data)

    def _end_cell(self):
        if self.cell is not None and self.row is not None:
            self.row["cells"].append(" ".join("".join(self.cell).split()))
        self.cell = None

    def _end_row(self):
        self._end_cell()
        if self.row is not None:
            self.rows.append(self.row)
        self.row = None


_TEXTS = T.ArrayType(T.StringType())
_ROW = T.StructType(
    [
        T.StructField("tbl", T.IntegerType()),
        T.StructField("leaf", T.BooleanType()),
        T.StructField("row", T.IntegerType()),
        T.StructField("header", T.BooleanType()),
        T.StructField("cells", _TEXTS),
        T.StructField("hrefs", _TEXTS),
    ]
)


@F.udf(T.ArrayType(_ROW), useArrow=True)
def table_rows(page):
    """All rows of all tables of a page, for explode."""
    if page is None:
        return []
    found = _Tables()
    _read(found, page)
    found._end_row()
    return [(r["table"], r["table"] not in found.not_leaf, r["row"], r["header"], r["cells"], r["hrefs"]) for r in found.rows]


class _Form(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.fields, self.select, self.first = {}, None, True

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag == "input" and a.get("name"):
            if a.get("type", "text") not in ("checkbox", "radio") or "checked" in a:
                self.fields[a["name"]] = a.get("value") or ""
        elif tag == "select":
            self.select, self.first = a.get("name"), True
        elif tag == "option" and self.select and (self.first or "selected" in a):
            self.fields[self.select], self.first = a.get("value") or "", False

    def handle_endtag(self, tag):
        if tag == "select":
            self.select = None


@F.udf(T.MapType(T.StringType(), T.StringType()), useArrow=True)
def form_fields(page):
    """What a page's forms would send: inputs, and the selected or first option of each list."""
    return {} if page is None else _read(_Form(), page).fields


class _Pieces(HTMLParser):
    """The page as pieces in order: what stays as it is, and texts that a translator would get."""

    def __init__(self, lang: str | None = None):
        super().__init__(convert_charrefs=False)
        self.lang, self.depth, self.pieces = lang, 0, []

    def _keep(self, raw: str):
        self.pieces.append((False, raw))

    def handle_starttag(self, tag, attrs):
        self.depth += tag in _SILENT
        raw = self.get_starttag_text()
        self._keep(re.sub(r"(\slang=)(\"[^\"]*\"|'[^']*'|[^\s>]+)", rf'\1"{self.lang}"', raw) if self.lang else raw)

    def handle_endtag(self, tag):
        self.depth -= tag in _SILENT and self.depth > 0
        self._keep(f"</{tag}>")

    handle_startendtag = handle_starttag

    def handle_data(self, data):
        worth = not self.depth and not re.fullmatch(r"[\s,()=-]*", data)
        self.pieces.append((worth, data))

    def handle_entityref(self, name):
        self._keep(f"&{name};")

    def handle_charref(self, name):
        self._keep(f"&#{name};")

    def handle_comment(self, data):
        self._keep(f"<!--{data}-->")

    def handle_decl(self, decl):
        self._keep(f"<!{decl}>")


@F.udf(T.ArrayType(T.StringType()), useArrow=True)
def translatable(page):
    """The texts of a page that are worth translating, in order."""
    return [] if page is None else [t for worth, t in _read(_Pieces(), page).pieces if worth]


@F.udf(T.StringType(), useArrow=True)
def translated(page, texts, lang):
    """The page with its texts replaced in order and its lang attributes set; texts that are missing stay."""
    if page is None:
        return None
    new = iter(texts if texts is not None else [])
    return "".join(escape(next(new, t), quote=False) if worth else t for worth, t in _read(_Pieces(lang), page).pieces)


def marked_up(text: Column, ranges: Column) -> Column:
    """Text with tags around ranges, escaped between them.

    ranges: array of (start, end, tag) that nest or follow each other, in document order; ends
    come before starts at the same place, and inner ends before outer ones.
    """
    opens = F.transform(ranges, lambda r, i: F.struct(r["start"].alias("at"), F.lit(1).alias("kind"), i.alias("n"), F.concat(F.lit("<"), r["tag"], F.lit(">")).alias("mark")))
    closes = F.transform(ranges, lambda r, i: F.struct(r["end"].alias("at"), F.lit(0).alias("kind"), (-i).alias("n"), F.concat(F.lit("</"), r["tag"], F.lit(">")).alias("mark")))
    marks = F.array_sort(F.concat(opens, closes))
    from .text import escaped

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    step = lambda acc, m: F.struct(
        m["at"].cast("int").alias("at"), F.concat(acc["out"], escaped(F.substring(text, acc["at"] + 1, m["at"] - acc["at"])), m["mark"]).alias("out")
    )
    return F.aggregate(marks, start, step, lambda acc: F.concat(acc["out"], escaped(F.substring(text, acc["at"] + 1, F.length(text)))))
