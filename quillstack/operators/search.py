"""Full-text search: postings with weights, web-style queries, phrases, rank by cover density, snippets.

A query is an OR of clauses; a clause needs all of its terms and phrases and none of its excluded
ones. Matching filters the postings to the query's own lexemes before anything is grouped, so a
search shuffles the hits of its words only. Where no index is stored, ``scanned`` makes the postings
of a query's words alone; a stored index is laid out by lexeme, and a search reads the folders of
its own words.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint
from .analysis import STOP_WORDS, with_lexemes

#: The weights of the four classes of text.
WEIGHTS = {"D": 0.1, "C": 0.2, "B": 0.4, "A": 1.0}
TOKEN = "[\\p{L}\\p{M}\\p{Nd}]+"


#: A vocabulary is broadcast to the words up to so many rows of about 50 bytes, and joined by a shuffle beyond.
BROADCAST_WORDS = 200_000


def _tokens(column: str) -> Column:
    """The words of a text column in small letters."""
    return F.regexp_extract_all(F.lower(F.coalesce(F.col(column), F.lit(""))), F.lit(f"({TOKEN})"), 1)


def words(docs: DataFrame, key: str, fields: dict[str, str]) -> DataFrame:
    """(word, doc, weight, at): the words of the text columns in small letters and their places among all words, from 1.

    Columns follow each other with a gap, so phrases do not run from one into the next.
    """
    rows = None
    for k, (column, weight) in enumerate(fields.items()):
        one = docs.select(F.col(key).alias("doc"), F.lit(weight).alias("weight"), F.posexplode(_tokens(column)).alias("at", "word"))
        one = one.select("word", "doc", "weight", (F.col("at").cast("long") + 1 + k * 1_000_000_000).alias("at"))
        rows = one if rows is None else rows.unionByName(one)
    return rows


def vocabulary(found: DataFrame, config: str = "english", only: list[str] | None = None) -> DataFrame:
    """(word, lexeme, word_id): each different word once with what it is indexed as, and a number for each lexeme.

    Words that are not indexed are left out. only: the lexemes that are wanted.
    """
    found = found.select("word")
    if only is not None and config == "english":  # of other words no stem is made
        begins = _any([F.startswith(F.ltrim(F.col("word"), F.lit("'")), F.lit(_stretch(w))) for w in only])
        found = found.where(begins)
    different = with_lexemes(found.distinct(), "word", "lexeme", config).where("lexeme IS NOT NULL")
    if only is not None:
        different = different.where(F.col("lexeme").isin(only))
    different = checkpoint(different) if config != "english" or only is not None else different
    numbers = checkpoint(different.select("lexeme").distinct().withColumn("word_id", F.monotonically_increasing_id()))
    return different.join(numbers, "lexeme").select("word", "lexeme", "word_id")


def _stretch(lexeme: str) -> str:
    """What all words with this stem begin with: steps of the stemmer change the last two letters that stay at most."""
    return lexeme[: max(1, len(lexeme) - 3)]


def _themselves(spark, words_: list[str]) -> DataFrame:
    """A vocabulary of words that are their own lexemes."""
    if not words_:
        return spark.createDataFrame([], "word string, lexeme string, word_id long")
    rows = spark.range(1).select(F.posexplode(F.array(*map(F.lit, words_))).alias("word_id", "word"))
    return rows.select("word", F.col("word").alias("lexeme"), F.col("word_id").cast("long").alias("word_id"))


def postings(docs: DataFrame, key: str, fields: dict[str, str], config: str = "english", only: list[str] | None = None) -> DataFrame:
    """(word_id, lexeme, doc, weight, positions) of the text columns, fields giving each its weight class.

    Stems are made for the vocabulary and joined back to the words. only: the lexemes that are
    wanted; others are left out before anything but the vocabulary is shuffled. Where words are their own
    lexemes there is no vocabulary: the words of each row are put together where they are, so rows that share a
    key have postings of their own, and word_id is the word's hash.
    """
    if config != "english" and only is None:
        return _in_rows(docs, key, fields, config)
    found = words(docs, key, fields)
    named = only is not None and config != "english"  # then the texts need not be read for their vocabulary
    known = _themselves(docs.sparkSession, only) if named else checkpoint(vocabulary(found, config, only))
    if (len(only) if named else known.count()) <= BROADCAST_WORDS:
        placed = found.join(F.broadcast(known), "word").groupBy("word_id", "lexeme", "doc", "weight")
        return placed.agg(F.sort_array(F.collect_list("at")).alias("positions"))
    # places meet in one row a document first, so a word that all documents have is joined once for each
    placed = found.groupBy("word", "doc", "weight").agg(F.collect_list("at").alias("at")).join(known, "word").groupBy("word_id", "lexeme", "doc", "weight")
    return placed.agg(F.sort_array(F.flatten(F.collect_list("at"))).alias("positions"))


def _put_together(batches):
    """Rows of words to a row for each different word with its places, for all rows of a batch at once."""
    for batch in batches:
        tokens = batch.column("tokens")
        sizes = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False)
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        coded = tokens.flatten().dictionary_encode()
        code, row = coded.indices.to_numpy(), np.repeat(np.arange(len(tokens)), sizes)
        order = np.argsort(row * max(1, len(coded.dictionary)) + code, kind="stable")  # places stay in order
        new = np.ones(len(order), bool)
        new[1:] = (row[order][1:] != row[order][:-1]) | (code[order][1:] != code[order][:-1])
        first = np.nonzero(new)[0]
        at = order - bounds[row[order]] + batch.column("start").to_numpy()[row[order]]
        positions = pa.ListArray.from_arrays(pa.array(np.append(first, len(order)), pa.int32()), pa.array(at, pa.int64()))
        of = pa.array(row[order][first])
        lexeme = coded.dictionary.take(pa.array(code[order][first]))
        yield pa.RecordBatch.from_arrays([lexeme, batch.column("doc").take(of), batch.column("weight").take(of), positions], names=["lexeme", "doc", "weight", "positions"])


def _in_rows(docs: DataFrame, key: str, fields: dict[str, str], config: str) -> DataFrame:
    rows = None
    for k, (column, weight) in enumerate(fields.items()):
        one = docs.select(F.col(key).alias("doc"), F.lit(weight).alias("weight"), F.lit(1 + k * 1_000_000_000).cast("long").alias("start"), _tokens(column).alias("tokens"))
        rows = one if rows is None else rows.unionByName(one)
    schema = rows.select(F.lit("").alias("lexeme"), "doc", "weight", F.array(F.lit(0).cast("long")).alias("positions")).schema
    placed = with_lexemes(rows.mapInArrow(_put_together, schema).withColumnRenamed("lexeme", "word"), "word", "lexeme", config).where("lexeme IS NOT NULL")
    return placed.select(F.xxhash64("lexeme").alias("word_id"), "lexeme", "doc", "weight", "positions")


def occurrences(docs: DataFrame, key: str, fields: dict[str, str], config: str = "words") -> DataFrame:
    """(lexeme, doc, weight, at): the indexed words as they stand, where words are their own lexemes."""
    return with_lexemes(words(docs, key, fields), "word", "lexeme", config).where("lexeme IS NOT NULL").select("lexeme", "doc", "weight", "at")


def query_lexemes(spark, text: str, config: str = "english") -> list[str]:
    """The lexemes of a query's words."""
    return sorted(set(_lexemes_of(spark, parse(text, config).words, config).values()))


def scanned(docs: DataFrame, key: str, fields: dict[str, str], text: str, config: str = "english") -> DataFrame:
    """The postings of a query's words, straight from the texts."""
    return postings(docs, key, fields, config, query_lexemes(docs.sparkSession, text, config))


BUCKETS = 64


def store(posted: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Writes an index in folders of lexemes."""
    placed = posted.withColumn("bucket", F.pmod(F.xxhash64("lexeme"), F.lit(buckets)).cast("int"))
    # sorted as the writer wants it, which would sort again
    placed.repartition("bucket", F.pmod(F.xxhash64("doc"), F.lit(16))).sortWithinPartitions("bucket", "lexeme").write.partitionBy("bucket").parquet(path)


def stored(spark, path: str, text: str, config: str = "english", buckets: int = BUCKETS) -> DataFrame:
    """The postings of a query's words from a stored index; only the folders of these words are read."""
    wanted = query_lexemes(spark, text, config)
    bucket = [F.pmod(F.xxhash64(F.lit(w)), F.lit(buckets)).cast("int").alias(f"b{i}") for i, w in enumerate(wanted)]
    folders = sorted(set(spark.range(1).select(*bucket).first())) if wanted else []
    return spark.read.parquet(path).where(F.col("bucket").isin(folders) & F.col("lexeme").isin(wanted)).drop("bucket")


@dataclass(frozen=True)
class Clause:
    """Phrases (a single word is a phrase of one) that must and must not occur."""

    wanted: tuple[tuple[str, ...], ...] = ()
    excluded: tuple[tuple[str, ...], ...] = ()


@dataclass(frozen=True)
class Query:
    clauses: tuple[Clause, ...] = field(default=())

    @property
    def words(self) -> list[str]:
        return sorted({w for c in self.clauses for p in (*c.wanted, *c.excluded) for w in p if w})


def parse(text: str, config: str = "english") -> Query:
    """Quoted phrases, OR between alternatives, - before what must not occur; words are joined by AND.

    Words that the analyser does not index are no part of a query; in a phrase they keep their places.
    """
    left_out = () if config == "simple" else STOP_WORDS
    clauses, wanted, excluded = [], [], []
    for minus, phrase, word in re.findall(r'(-?)(?:"([^"]*)"?|(\S+))', text):
        if word == "OR" and not minus:
            clauses.append(Clause(tuple(wanted), tuple(excluded)))
            wanted, excluded = [], []
            continue
        words = tuple("" if w in left_out else w for w in re.findall(r"\w+", (phrase or word).lower()))
        while words and not words[0]:
            words = words[1:]
        while words and not words[-1]:
            words = words[:-1]
        if words:
            (excluded if minus else wanted).append(words)
    clauses.append(Clause(tuple(wanted), tuple(excluded)))
    return Query(tuple(c for c in clauses if c.wanted or c.excluded))


def _lexemes_of(spark, words: list[str], config: str) -> dict[str, str]:
    """The lexemes of a query's few words, by the same expression as the index."""
    if config != "english" or not words:
        return {w: w for w in words}
    rows = spark.range(1).select(F.explode(F.array(*map(F.lit, words))).alias("w"))
    return {r["w"]: r["lexeme"] for r in with_lexemes(rows, "w", "lexeme", config).collect()}


def match(posted: DataFrame, docs: DataFrame, key: str, text: str, config: str = "english") -> DataFrame:
    """(doc, hits) for the keys of docs that match; hits maps lexemes to their places."""
    query = parse(text, config)
    if not query.clauses:
        return docs.select(F.col(key).alias("doc"), F.lit(None).cast("map<string,array<bigint>>").alias("hits")).limit(0)
    table = _lexemes_of(posted.sparkSession, query.words, config)
    own = posted.where(F.col("lexeme").isin(sorted(set(table.values()))))
    flat = own.groupBy("doc", "lexeme").agg(F.array_sort(F.flatten(F.collect_list("positions"))).alias("at"))
    hits = flat.groupBy("doc").agg(F.map_from_entries(F.collect_list(F.struct("lexeme", "at"))).alias("hits"))
    none_wanted = any(not c.wanted for c in query.clauses)
    if none_wanted:  # only then a document without any of the words can match
        hits = docs.select(F.col(key).alias("doc")).join(hits, "doc", "left")
    places = lambda w: F.coalesce(F.try_element_at(F.col("hits"), F.lit(table[w])), F.array().cast("array<bigint>"))

    def found(phrase):
        first = places(phrase[0])
        if len(phrase) == 1:
            return F.size(first) > 0
        ok = lambda p: _all([F.array_contains(places(w), p + i) for i, w in enumerate(phrase[1:], 1) if w])
        return F.exists(first, ok)

    condition = None
    for c in query.clauses:
        one = _all([found(p) for p in c.wanted] + [~found(p) for p in c.excluded])
        condition = one if condition is None else condition | one
    return hits.where(condition)


def _any(conditions: list[Column]) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | c
    return out


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def _covers(places: DataFrame, wanted: list[str]) -> DataFrame:
    """(doc, rank) of a clause from (doc, lexeme, at, weight): the covers of its lexemes by their density.

    Covers are the shortest stretches that hold all wanted lexemes and hold no other one. Each counts the
    harmonic mean of its words' weights over one more than the words that it has beyond the wanted ones.
    Each place looks back at the last one of every lexeme: only the places of one document meet.
    """
    before = Window.partitionBy("doc").orderBy("at")
    spot = F.struct("at", "weight")
    last = {f"l{i}": F.last(F.when(F.col("lexeme") == w, spot), True).over(before.rowsBetween(Window.unboundedPreceding, 0)) for i, w in enumerate(wanted)}
    seen = places.where(F.col("lexeme").isin(wanted)).withColumns(last).where(_all([F.col(c).isNotNull() for c in last]))
    first = F.array_min(F.array(*[F.col(f"{c}.at") for c in last]))
    inverse = sum((1 / F.col(f"{c}.weight") for c in last), F.lit(0.0))
    ends = seen.select("doc", "at", first.alias("first"), (len(wanted) / inverse).alias("weight"))
    earlier = F.max("first").over(before.rowsBetween(Window.unboundedPreceding, -1))
    covers = ends.withColumn("earlier", earlier).where("earlier IS NULL OR first > earlier")
    return covers.groupBy("doc").agg(F.sum(F.col("weight") / (1 + (F.col("at") - F.col("first") + 1 - len(wanted)))).alias("rank"))


def ranked(posted: DataFrame, matches: DataFrame, text: str, config: str = "english") -> DataFrame:
    """(doc, rank) for the matches: the best clause by cover density, 0 for what only excludes words."""
    query = parse(text, config)
    table = _lexemes_of(posted.sparkSession, query.words, config)
    clauses = [sorted({table[w] for p in c.wanted for w in p if w}) for c in query.clauses]
    own = posted.where(F.col("lexeme").isin(sorted(set(table.values())))).join(matches.select("doc"), "doc", "left_semi")
    weight = F.create_map(*[F.lit(x) for pair in WEIGHTS.items() for x in pair])[F.col("weight")]
    places = own.select("doc", "lexeme", weight.alias("weight"), F.explode("positions").alias("at"))
    scored = [_covers(places, c) for c in clauses if c]
    if not scored:
        return matches.select("doc", F.lit(0.0).alias("rank"))
    best = scored[0]
    for more in scored[1:]:
        best = best.unionByName(more)
    best = best.groupBy("doc").agg(F.max("rank").alias("rank"))
    return matches.select("doc").join(best, "doc", "left").select("doc", F.coalesce("rank", F.lit(0.0)).alias("rank"))


def snippets(page: DataFrame, key: str, column: str, text: str, fragments: int = 3, least: int = 20, most: int = 40, config: str = "english") -> DataFrame:
    """(key, snippet) for the rows of one page: up to three stretches around hits, hits between \x02 and \x03.

    A word is a hit if its lexeme is one of the query's, as in the index.
    """
    asked = sorted({w for c in parse(text, config).clauses for p in c.wanted for w in p if w})
    wanted = asked
    if config == "english":  # the forms of the query's words that the page has
        lexemes = sorted(set(_lexemes_of(page.sparkSession, asked, config).values()))
        forms = with_lexemes(words(page, key, {column: "D"}).select("word").distinct(), "word", "lexeme", config)
        wanted = sorted(r["word"] for r in forms.where(F.col("lexeme").isin(lexemes)).select("word").collect())
    bare = lambda w: F.lower(F.regexp_extract(w, f"({TOKEN})", 1))
    tokens = F.filter(F.split(F.coalesce(F.col(column), F.lit("")), "\\s+"), lambda w: w != "")
    hit = F.transform("__t", lambda w: F.coalesce(bare(w).isin(wanted), F.lit(False)) if wanted else F.lit(False))
    span = "struct<a:int,b:int>"
    start = F.struct(F.array().cast(f"array<{span}>").alias("spans"), F.lit(0).alias("end"))

    def cover(acc, x):
        a = F.greatest(F.lit(0), x["i"] - least // 2, acc["end"])
        b = F.least(x["n"], a + most)
        new = F.struct(F.array_append(acc["spans"], F.struct(a.alias("a"), b.alias("b"))).alias("spans"), b.alias("end"))
        return F.when(x["hit"] & (x["i"] >= acc["end"]) & (F.size(acc["spans"]) < fragments), new).otherwise(acc)

    # a page has few rows; written down, its words are not split again for each expression that names them
    rows = checkpoint(page.select(key, tokens.alias("__t"))).withColumn("__h", hit).withColumn("__n", F.size("__t"))
    marks = F.transform("__h", lambda h, i: F.struct(i.alias("i"), h.alias("hit"), F.col("__n").alias("n")))
    spans = F.aggregate(marks, start, cover, lambda acc: acc["spans"])
    head = F.array(F.struct(F.lit(0).alias("a"), F.least(F.col("__n"), F.lit(least)).alias("b")))
    rows = rows.withColumn("__s", F.when(F.size(spans) > 0, spans).otherwise(head))
    shown = F.zip_with("__t", "__h", lambda t, h: F.when(h, F.concat(F.lit("\x02"), t, F.lit("\x03"))).otherwise(t))
    pieces = F.transform("__s", lambda s: F.array_join(F.slice(F.col("__w"), s["a"] + 1, s["b"] - s["a"]), " "))
    return checkpoint(rows.withColumn("__w", shown).select(key, F.array_join(pieces, " … ").alias("snippet")))


def unindexed(docs: DataFrame, posted: DataFrame, key: str) -> DataFrame:
    """Documents without a posting, or without an occurrence."""
    return docs.join(posted.select(F.col("doc").alias(key)).distinct(), key, "left_anti")
