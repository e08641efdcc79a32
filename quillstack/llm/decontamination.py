"""Benchmark decontamination by templates: re-parameterised questions are found as well as copies.

Texts become sequences of template tokens: small letters, no punctuation, and typed placeholders
for numbers, for units after a number and for names (words with a capital and small letters within
a sentence, that is after a small letter, digit, comma, colon or semicolon). Windows of ``window``
template tokens of all documents are joined by hash with those of the benchmark items. Texts in
capitals or in small letters alone show no names, so items have their windows without
placeholders for names as well. For a document and an item, matches whose offsets differ by less
than a band belong together; a band is a third of the item, at most ``band`` tokens, so copies side
by side are told apart. The item's tokens that such matches cover must be ``min_cover`` of all of its
tokens.

Slots: placeholders at matched places are compared value by value. Verbatim copies keep all
values; in a re-parameterised question each value of the item becomes one other value
throughout. A find whose values change inconsistently in more than 1 - ``min_agree`` of its
slots is no leak.

An item with fewer template tokens than a window is leaked by a line, however long, that has its template
and nothing else. Beyond ``BROADCAST_WINDOWS`` windows of items, those that very many places of documents
have still meet theirs by a broadcast. Windows of placeholders only match nothing, nor do items of these only. Null texts and
items have no tokens. Null ids are allowed; rows that agree in id and text count as one document.
Texts are read whole, however long. A column of docs with the result's name gives way to it. Empty
tables: no leaks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, checkpoint, join_named, let, others

WINDOW = 5
MIN_COVER = 0.8
MIN_AGREE = 0.8
BAND = 16
#: Benchmark windows are broadcast up to so many rows of about 40 bytes, and joined by a shuffle beyond.
BROADCAST_WINDOWS = 1_000_000
#: Documents whose slots are compared are broadcast up to so many rows of about 20 bytes, and joined by a shuffle beyond.
BROADCAST_FINDS = 500_000

NAME, NUMBER, UNIT = "\ue000", "\ue001", "\ue002"
UNITS = "mm|cm|m|km|g|kg|mg|t|l|ml|s|ms|h|min|km/h|mph|miles?|feet|ft|inch(?:es)?|pounds?|lbs?|hours?|minutes?|seconds?|days?|weeks?|months?|years?|euros?|dollars?|cents?|percent"
NAME_PATTERN = "([\\p{Ll}\\p{Nd},;:]\\s)(\\p{Lu}[\\p{Ll}\\p{M}][\\p{L}\\p{M}]*)"
NUMBER_PATTERN = "([0-9]+)(?:[.,]([0-9]+))*"
UNIT_PATTERN = f"({NUMBER}[0-9]+) ({UNITS})(?: |$)"
_MARKS = f"{NAME}{NUMBER}{UNIT}"
_BETWEEN = f"[^\\p{{L}}\\p{{M}}\\p{{Nd}}{_MARKS}]+"


def marked(text: Column, names: bool = True) -> Column:
    """The text in small letters, a marker before each slot value; without names, numbers and units only."""
    named = F.coalesce(text, F.lit(""))
    if names:
        named = F.regexp_replace(named, NAME_PATTERN, f"$1{NAME}$2")
    numbered = F.regexp_replace(F.lower(named), NUMBER_PATTERN, f" {NUMBER}$1$2 ")
    return F.regexp_replace(F.replace(numbered, F.lit("  "), F.lit(" ")), UNIT_PATTERN, f"$1 {UNIT}$2 ")


def template(text: Column) -> Column:
    """Marked text without the slots' values."""
    return F.regexp_replace(text, f"([{_MARKS}])[\\p{{L}}\\p{{M}}\\p{{Nd}}]*", "$1")


def tokens_of(text: Column) -> Column:
    """The tokens of marked text or of a template."""
    return F.array_remove(F.split(text, _BETWEEN), "")


def window_hashes(tokens: Column, window: int) -> Column:
    """Hashes of all windows in order."""
    return let(
        tokens,
        lambda t: F.when(F.size(t) < window, F.array().cast("array<bigint>")).otherwise(
            F.transform(F.sequence(F.lit(0), F.size(t) - window), lambda i: F.xxhash64(*[t[i + k] for k in range(window)]))
        ),
    )


def item_windows(items: DataFrame, id_col="item_id", text="text", window: int = WINDOW) -> DataFrame:
    """(h, item, at, size, slots) of the items; slots holds the window's marked tokens if it has any slot."""
    whole = F.col(f"`{text}`")
    each = F.explode(F.array_distinct(F.array(marked(whole), marked(whole, False))))
    rows = items.select(F.col(f"`{id_col}`").alias("item"), each.alias("m")).distinct()
    tokens = rows.select("item", tokens_of(F.col("m")).alias("m"), tokens_of(template(F.col("m"))).alias("t"))
    out = tokens.select("item", "m", F.size("t").alias("size"), F.posexplode(window_hashes(F.col("t"), window)).alias("at", "h"))
    own = F.slice("m", F.col("at") + 1, window)
    literal = F.exists(own, lambda x: ~x.rlike(f"^[{_MARKS}]"))
    return out.where(literal).select(
        "h", "item", "at", "size",
        F.when(F.exists(own, lambda x: x.rlike(f"^[{_MARKS}]")), own).alias("slots"),
    ).distinct()


def short_leaks(docs: DataFrame, items: DataFrame, id_col: str, text: str, item_id: str, item_text: str, window: int) -> DataFrame | None:
    """(doc, same, item, cover, agree) of items shorter than a window; None if there are none."""
    def templates(column):
        return F.array_distinct(F.transform(F.array(marked(column), marked(column, False)), lambda m: tokens_of(template(m))))

    def told(t):
        return (F.size(t) > 0) & (F.size(t) < window) & F.exists(t, lambda x: ~x.rlike(f"^[{_MARKS}]"))

    own = items.select(F.col(f"`{item_id}`").alias("item"), F.explode(templates(F.col(f"`{item_text}`"))).alias("t")).where(told(F.col("t")))
    own = checkpoint(own.distinct())
    if own.isEmpty():
        return None
    whole = F.col(f"`{text}`")
    rows = docs.select(F.col(f"`{id_col}`").alias("doc"), F.xxhash64(whole).alias("same"), F.split(whole, "\n").alias("lines"))
    lines = rows.select("doc", "same", F.explode("lines").alias("line"))
    found = lines.select("doc", "same", F.explode(templates(F.col("line"))).alias("t")).where(told(F.col("t"))).join(own, "t")
    return found.select("doc", "same", "item", F.lit(1.0).alias("cover"), F.lit(1.0).alias("agree"))


def band_of(size: Column, most: int = BAND) -> Column:
    """How far the offsets of a find's matches may lie apart, by the item's size in tokens."""
    return F.greatest(F.least(F.floor(size / 3), F.lit(most)), F.lit(1))


def _met(seen: DataFrame, index: DataFrame) -> DataFrame:
    """seen joined with index on h by a shuffle, in which windows that very many places have meet theirs by a broadcast."""
    columns = [c for c in index.columns if c != "h"]
    packed = index.groupBy("h").agg(F.collect_list(F.struct(*columns)).alias("found"))
    times = seen.groupBy("h").agg(F.count(F.lit(1)).alias("times"))
    named = checkpoint(packed.join(times, "h"))
    total = named.agg(F.sum("times")).first()[0] or 0
    met = join_named(seen, named, ["h"], total)
    return met.select(*seen.columns, F.explode("found").alias("x")).select(*seen.columns, "x.*")


def find_leaks(docs: DataFrame, items: DataFrame, id_col="doc_id", text="text", item_id="item_id", item_text="text",
               window: int = WINDOW, min_cover: float = MIN_COVER, min_agree: float = MIN_AGREE, band: int = BAND) -> DataFrame:
    """(doc, same, item, cover, agree): the items that documents leak. ``same`` is a hash of the text."""
    index = checkpoint(item_windows(items, item_id, item_text, window))
    n = index.count()
    whole = F.col(f"`{text}`")
    me = [F.col(f"`{id_col}`").alias("doc"), F.xxhash64(whole).alias("same")]
    tokens = tokens_of(template(marked(whole)))
    # The text is hashed before the explode, or it would be hashed again for each of its windows. The
    # outer explode keeps Spark from adding a filter that makes each text's windows twice more.
    rows = docs.select(*me, window_hashes(tokens, window).alias("w"))
    seen = rows.select("doc", "same", F.posexplode_outer("w").alias("pos", "h")).where("pos IS NOT NULL")
    hits = seen.join(F.broadcast(index), "h") if n <= BROADCAST_WINDOWS else _met(seen, index)
    offset = F.floor((F.col("pos") - F.col("at")) / band_of(F.col("size"), band))
    hits = checkpoint(
        hits.select("doc", "same", "pos", "item", "at", "size", "slots", F.explode(F.array(offset, offset - 1)).alias("band"))
    )
    find = ["doc", "same", "item", "band"]
    covered = (
        hits.select(*find, "size", F.explode(F.sequence(F.col("at"), F.col("at") + window - 1)).alias("token"))
        .distinct()
        .groupBy(*find, "size")
        .agg((F.count(F.lit(1)) / F.col("size")).alias("cover"))
        .where(F.col("cover") >= min_cover)
        .drop("size")
    )
    covered = checkpoint(covered)
    # the slots of such finds: the documents' values are read again, for these documents only
    on = lambda a, b: F.col(a).eqNullSafe(F.col(b))
    few = covered.select(*[F.col(c).alias(f"c_{c}") for c in find])
    slots = hits.where(F.col("slots").isNotNull()).join(
        few, on("doc", "c_doc") & (F.col("same") == F.col("c_same")) & on("item", "c_item") & (F.col("band") == F.col("c_band")), "left_semi"
    )
    needed = checkpoint(slots.select(F.col("doc").alias("n_doc"), F.col("same").alias("n_same")).distinct())
    # broadcast where they are few, or the texts of all documents would be shuffled to find them
    values = docs.select(*me, whole.alias("text")).join(
        broadcast_if_small(needed, needed.count(), BROADCAST_FINDS), on("doc", "n_doc") & (F.col("same") == F.col("n_same")), "left_semi"
    ).distinct().select(F.col("doc").alias("v_doc"), F.col("same").alias("v_same"), tokens_of(marked(F.col("text"))).alias("m"))
    slots = slots.join(values, on("doc", "v_doc") & (F.col("same") == F.col("v_same")))
    pairs = slots.select(
        *find, F.explode(F.zip_with("slots", F.slice("m", F.col("pos") + 1, window), lambda a, b: F.struct(a.alias("a"), b.alias("b")))).alias("p")
    ).where(F.col("p.a").rlike(f"^[{_MARKS}]"))
    most = pairs.groupBy(*find, "p.a", "p.b").agg(F.count(F.lit(1)).alias("n")).groupBy(*find, "a")
    agree = most.agg(F.max("n").alias("most"), F.sum("n").alias("n")).groupBy(*find).agg((F.sum("most") / F.sum("n")).alias("agree"))
    agree = agree.select(*[F.col(c).alias(f"a_{c}") for c in find], "agree")
    joined = covered.join(
        agree, on("doc", "a_doc") & (F.col("same") == F.col("a_same")) & on("item", "a_item") & (F.col("band") == F.col("a_band")), "left"
    ).withColumn("agree", F.coalesce(F.col("agree"), F.lit(1.0)))
    leaks = joined.where(F.col("agree") >= min_agree).select("doc", "same", "item", "cover", "agree")
    short = short_leaks(docs, items, id_col, text, item_id, item_text, window)
    return (
        (leaks if short is None else leaks.unionByName(short))
        .groupBy("doc", "same", "item")
        .agg(F.max("cover").alias("cover"), F.max("agree").alias("agree"))
    )


def decontaminate(docs: DataFrame, items: DataFrame, id_col="doc_id", text="text", out: str = "leaks", **options) -> DataFrame:
    """docs with the struct column ``out``: contaminated, n_items, items (sorted), cover (the largest or 0).

    A column of docs with that name gives way to it.
    """
    leaks = find_leaks(docs, items, id_col, text, **options).groupBy("doc", "same").agg(
        F.sort_array(F.collect_set("item")).alias("items"), F.max("cover").alias("cover")
    )
    leaks = leaks.withColumnsRenamed({"doc": "__doc", "same": "__same", "items": "__items", "cover": "__cover"})
    key = docs.select("*", F.xxhash64(F.col(f"`{text}`")).alias("__key"))
    joined = key.join(leaks, F.col(f"`{id_col}`").eqNullSafe(F.col("__doc")) & (F.col("__key") == F.col("__same")), "left")
    found = F.coalesce(F.size("__items"), F.lit(0))
    return joined.select(
        *others(docs, out),
        F.struct(
            (found > 0).alias("contaminated"),
            F.greatest(found, F.lit(0)).cast("long").alias("n_items"),
            F.col("__items").alias("items"),
            F.coalesce(F.col("__cover"), F.lit(0.0)).alias("cover"),
        ).alias(out),
    )
