"""Quality rules, line first: rules judge each line, failing lines go, documents that lose too much go.

A line with a word fails on the first of these that holds:

* ``navigation``: three or more menu separators;
* ``symbols``: three or more runs of two or more symbol or exclamation characters;
* ``shouting``: twelve or more capitals and no small letter;
* ``boilerplate``: a short line with a stock phrase of web pages (cookies, rights, sharing, ...);
* ``punctuation``: it does not end with a closing mark.

A document is kept if it passes the base rules (50 words at least, and at most half of its
words in three-word windows that occur twice or more) and if the failing lines hold at most
``max_loss_percent`` of the characters of its lines.

Null texts count as empty: no words, base rules failed, clean text empty. Rows are judged one
by one, so repeated rows, null ids and further columns are kept as they are, and a table without
rows gives none. Texts are read whole, however long: a line or a text has no greatest length. There is
no shuffle: all the work is done within a row by built-in functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, let, others, words

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_LOSS_PERCENT = 50
SHORT_LINE = 200
#: Up to so many different repeated windows, a text's windows are looked up in a list.
FEW = 24

SEPARATORS = "|»›•"
SYMBOLS = "(?:[#*$%&<>{}~^=!?]{2,}[^#*$%&<>{}~^=!?]*){3}"
SMALL_LETTER = "\\p{Ll}"
CAPITALS = "(?:\\p{Lu}[^\\p{Lu}]*){12}"
CLOSING = ".!?…:;\"')]»”’।。！？؟"
BOILERPLATE = (
    "(?i)all rights reserved|terms of (?:use|service)|privacy policy|cookie policy|accept (?:all )?cookies"
    "|uses? cookies|subscribe (?:to|now)|sign up (?:for|now)|log in to|click here|read more|share (?:this|on)"
    "|follow us|enable javascript|powered by|skip to (?:main )?content|back to top|add to cart|lorem ipsum"
)


def word_counts(text: Column) -> Column:
    """A struct of n_words, word_chars and n_repeat_words of a text.

    n_repeat_words counts the words within three-word windows that the text has twice or more,
    each word once. The windows' 64-bit hashes are sorted; equal neighbours are the repeated
    ones. Where they are few, the places of such windows are looked up; else the hashes are
    sorted with their places. The words that the places cover are counted from gaps of at most
    three.
    """

    def hashes(w):
        return F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(w[i], w[i + 1], w[i + 2]))

    def doubles(s):
        return F.array_distinct(F.filter(s, lambda x, k: (k > 0) & (s[F.greatest(k - 1, F.lit(0))] == x)))

    def looked_up(h, d):
        return F.filter(
            F.transform(h, lambda x, k: F.when(F.array_contains(d, x), k).otherwise(F.lit(-1))), lambda k: k >= 0
        )

    def sorted_up(h):
        def flagged(s):
            near = lambda x, k: F.get(s, k)["h"].eqNullSafe(x["h"])
            return F.transform(s, lambda x, k: F.when(near(x, k - 1) | near(x, k + 1), x["i"]).otherwise(F.lit(-1)))

        pairs = F.transform(h, lambda x, k: F.struct(x.alias("h"), k.alias("i")))
        return F.sort_array(F.filter(let(F.sort_array(pairs), flagged), lambda k: k >= 0))

    def covered(places):
        return F.aggregate(
            places,
            F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n")),
            lambda acc, p: F.struct(p.alias("last"), (acc["n"] + F.least(F.lit(3), p - acc["last"])).alias("n")),
            lambda acc: acc["n"],
        )

    def repeated(h):
        return let(
            let(F.sort_array(h), doubles),
            lambda d: F.when(F.size(d) == 0, F.lit(0).cast("long"))
            .when(F.size(d) <= FEW, covered(looked_up(h, d)))
            .otherwise(covered(sorted_up(h))),
        )

    return let(
        words(text),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            F.when(F.size(w) < 4, F.lit(0).cast("long")).otherwise(let(hashes(w), repeated)).alias("n_repeat_words"),
        ),
    )


def line_fault(line: Column) -> Column:
    """The name of the rule that a line breaks, or null; lines without a word break none."""
    stripped = F.btrim(line, F.lit(SPACE))
    separators = sum(
        (F.octet_length(line) - F.octet_length(F.replace(line, F.lit(c), F.lit("")))) / len(c.encode()) for c in SEPARATORS
    )
    return (
        F.when(stripped == "", F.lit(None))
        .when(separators >= 3, "navigation")
        .when(stripped.rlike(SYMBOLS), "symbols")
        .when(~stripped.rlike(SMALL_LETTER) & stripped.rlike(CAPITALS), "shouting")
        .when((F.length(stripped) <= SHORT_LINE) & stripped.rlike(BOILERPLATE), "boilerplate")
        .when(F.instr(F.lit(CLOSING), F.right(stripped, F.lit(1))) == 0, "punctuation")
    )


def judge(docs: DataFrame, text: str = "text", max_loss_percent: int = MAX_LOSS_PERCENT, out: str = "quality") -> DataFrame:
    """docs with the struct column ``out``: the counts, both verdicts and the clean text.

    A column of docs with that name gives way to it.
    """
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    judged = F.transform(
        F.split(whole, "\n", -1), lambda x: F.struct(x.alias("line"), line_fault(x).alias("fault"))
    )

    def chars(lines):
        return F.aggregate(lines, F.lit(0).cast("long"), lambda n, x: n + F.length(x["line"]))

    def verdict(lines):
        bad = F.filter(lines, lambda x: x["fault"].isNotNull())
        # a line with a word equals an earlier one: all such lines less the different ones
        spoken = F.transform(F.filter(lines, lambda x: F.btrim(x["line"], F.lit(SPACE)) != ""), lambda x: x["line"])
        return F.struct(
            F.size(lines).cast("long").alias("n_lines"),
            F.size(bad).cast("long").alias("n_bad_lines"),
            chars(lines).alias("line_chars"),
            chars(bad).alias("lost_chars"),
            let(spoken, lambda s: (F.size(s) - F.size(F.array_distinct(s))).cast("long")).alias("n_dup_lines"),
            F.array_join(
                F.transform(F.filter(lines, lambda x: x["fault"].isNull()), lambda x: x["line"]), "\n"
            ).alias("clean_text"),
        )

    n_symbols = F.length(F.regexp_replace(whole, "[^#*$%&|<>]+", "")).cast("long")
    q = "__q"
    counted = docs.select(
        "*",
        F.struct(
            word_counts(F.col(f"`{text}`")).alias("c"), n_symbols.alias("s"), let(judged, verdict).alias("l")
        ).alias(q),
    )
    c, lines = F.col(f"{q}.c"), F.col(f"{q}.l")
    failed = (c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"] > MAX_REPEAT_PERCENT * c["n_words"])
    kept = ~failed & (100 * lines["lost_chars"] <= max_loss_percent * lines["line_chars"])
    return counted.select(
        *others(docs, out),
        F.struct(
            *[c[x].alias(x) for x in ("n_words", "word_chars", "n_repeat_words")],
            F.col(f"{q}.s").alias("n_symbols"),
            *[lines[x].alias(x) for x in ("n_dup_lines", "n_lines", "n_bad_lines", "line_chars", "lost_chars")],
            failed.alias("base_failed"),
            kept.alias("kept"),
            lines["clean_text"].alias("clean_text"),
        ).alias(out),
    )
