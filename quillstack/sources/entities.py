"""Entity declarations of XML files as a table, and texts with their entities resolved."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Entity tables are collected up to so many rows, as each text needs them whole.
MOST = 20_000
#: Entities in entities, up to so many deep; a text of theirs may have so many characters.
DEEPEST, LONGEST = 20, 100_000
#: The entities that XML has itself.
XML_OWN = frozenset(["amp", "lt", "gt", "quot", "apos"])

_REFERENCE = re.compile(r"&(?:#(\d+)|#[xX]([0-9a-fA-F]+)|([A-Za-z_:][\w:.-]*));")
_DECLARED = "<!ENTITY\\s+([A-Za-z_:][\\w:.-]*)\\s+(\"[^\"]*\"|'[^']*')\\s*>"


def declared(files: DataFrame, text: str = "value") -> DataFrame:
    """(name, value) of the declarations in files, the first of a name; comments, parameter and external entities are left out."""
    plain = F.regexp_replace(F.col(text), "(?s)<!--.*?-->", "")
    each = files.select(F.explode(F.arrays_zip(F.regexp_extract_all(plain, F.lit(_DECLARED), 1).alias("n"), F.regexp_extract_all(plain, F.lit(_DECLARED), 2).alias("v"))).alias("e"), F.monotonically_increasing_id().alias("at"))
    rows = each.select(F.col("e.n").alias("name"), F.expr("substring(e.v, 2, length(e.v) - 2)").alias("value"), "at")
    return rows.groupBy("name").agg(F.min_by("value", "at").alias("value"))


def _character(m: re.Match) -> str | None:
    """The character of a numeric reference; None for a name or a number that is none."""
    if m[3]:
        return None
    code = int(m[1]) if m[1] else int(m[2], 16)
    return chr(code) if 0 < code < 0x110000 and not 0xD800 <= code < 0xE000 else None


def resolved(table: DataFrame) -> dict[str, str]:
    """What each name of an entity table stands for, entities in its value resolved.

    Names that stand for themselves, in any number of steps, have no text and are left out, and so are texts
    that grow beyond LONGEST. Unknown names and XML's own stay as they are.
    """
    rows = table.limit(MOST + 1).collect()  # bounded
    if len(rows) > MOST:
        raise ValueError(f"more than {MOST} entities")
    values = {r["name"]: r["value"] or "" for r in rows}
    done: dict[str, str | None] = {}

    def text(name: str, above: tuple[str, ...]) -> str | None:
        if name in above or len(above) > DEEPEST:
            return None
        if name not in done:
            parts, at = [], 0
            for m in _REFERENCE.finditer(values[name]):
                parts.append(values[name][at : m.start()])
                inner = text(m[3], (*above, name)) if m[3] in values and m[3] not in XML_OWN else _character(m) or m[0]
                if inner is None:
                    return None  # in a circle; others may be asked from elsewhere
                parts.append(inner)
                at = m.end()
            whole = "".join([*parts, values[name][at:]])
            done[name] = whole if len(whole) <= LONGEST else None
        return done[name]

    found = {name: text(name, ()) for name in values}
    return {name: value for name, value in found.items() if value is not None}


def with_entities(xml: str, entities: dict[str, str]) -> str:
    """A text with the names of a table as the texts that they stand for, marked up as text; other names and XML's own stay."""

    def one(m):
        if m[3] is None or m[3] in XML_OWN or m[3] not in entities:
            return m[0]
        return entities[m[3]].replace("&", "&amp;").replace("<", "&lt;")

    return _REFERENCE.sub(one, xml)
