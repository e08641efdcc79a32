"""Text analysers by name: which words are indexed, and as what.

``simple`` takes words as they are, in small letters; ``words`` leaves out the English stop words;
``english`` also takes each word's stem by the Porter2 algorithm. A corpus has far fewer different words
than words, so stems are made for a vocabulary, each word once, and joined back (see search). Words in
other scripts have no English suffixes and stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint

CONFIGS = ("simple", "words", "english")

#: The English stop words.
STOP_WORDS = (
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "your", "yours", "yourself", "yourselves", "he", "him", "his", "himself", "she", "her", "hers",
    "herself", "it", "its", "itself", "they", "them", "their", "theirs", "themselves", "what", "which", "who", "whom", "this", "that", "these", "those", "am", "is",
    "are", "was", "were", "be", "been", "being", "have", "has", "had", "having", "do", "does", "did", "doing", "a", "an", "the", "and", "but", "if", "or", "because",
    "as", "until", "while", "of", "at", "by", "for", "with", "about", "against", "between", "into", "through", "during", "before", "after", "above", "below", "to",
    "from", "up", "down", "in", "out", "on", "off", "over", "under", "again", "further", "then", "once", "here", "there", "when", "where", "why", "how", "all", "any",
    "both", "each", "few", "more", "most", "other", "some", "such", "no", "nor", "not", "only", "own", "same", "so", "than", "too", "very", "s", "t", "can", "will",
    "just", "don", "should", "now",
)

# Fixed values of the Porter2 algorithm.
VOWELS = "aeiouy"
#: Words with stems of their own, and words that are no more changed after the plural is gone.
EXCEPTIONS = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "idly": "idl", "gently": "gentl", "ugly": "ugli", "early": "earli", "only": "onli",
    "singly": "singl", "sky": "sky", "news": "news", "howe": "howe", "atlas": "atlas", "cosmos": "cosmos", "bias": "bias", "andes": "andes",
}
FINISHED = ("inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed")
#: Beginnings after which the first region starts.
BEGINNINGS = "gener|commun|arsen"
DOUBLES = "(?:bb|dd|ff|gg|mm|nn|pp|rr|tt)$"
#: (suffix, what takes its place, what must stand before it), in the first region.
STEP_2 = (
    ("ization", "ize", ""), ("ational", "ate", ""), ("fulness", "ful", ""), ("ousness", "ous", ""), ("iveness", "ive", ""), ("tional", "tion", ""), ("biliti", "ble", ""),
    ("lessli", "less", ""), ("entli", "ent", ""), ("ation", "ate", ""), ("alism", "al", ""), ("aliti", "al", ""), ("ousli", "ous", ""), ("iviti", "ive", ""), ("fulli", "ful", ""),
    ("enci", "ence", ""), ("anci", "ance", ""), ("abli", "able", ""), ("izer", "ize", ""), ("ator", "ate", ""), ("alli", "al", ""), ("bli", "ble", ""), ("ogi", "og", "l"), ("li", "", "[cdeghkmnrt]"),
)
STEP_3 = (("ational", "ate"), ("tional", "tion"), ("alize", "al"), ("icate", "ic"), ("iciti", "ic"), ("ative", ""), ("ical", "ic"), ("ness", ""), ("ful", ""))
STEP_4 = ("ement", "ance", "ence", "able", "ible", "ment", "ant", "ent", "ism", "ate", "iti", "ous", "ive", "ize", "ion", "al", "er", "ic")
#: A short syllable at the end of a word.
SHORT = "(?:^[aeiouy][^aeiouy]|[^aeiouy][aeiouy][^aeiouywxY])$"


def _cut(n: int, w: str = "w") -> str:
    return f"left({w}, length({w}) - {n})"


def _replaced(region: str, cases) -> str:
    """w by the first suffix of the cases (suffix, replacement, further condition) that it has, if that is in the region."""
    one = "WHEN endswith(w, '{0}') THEN CASE WHEN length(w) - {1} >= {2}{3} THEN concat({4}, '{5}') ELSE w END"
    return "CASE " + " ".join(one.format(x, len(x), region, f" AND {also}" if also else "", _cut(len(x)), y) for x, y, also in cases) + " ELSE w END"


#: The steps of a stem: columns that each takes from those before it. As text, they are read by Spark at once and not call by call.
_STEPS = (
    # Y is a y that is a consonant: at the beginning and after a vowel, where that y itself counts as one
    {"w": f"regexp_replace(regexp_replace(regexp_replace(w, \"^'\", ''), '^y', 'Y'), '([{VOWELS}])y', '$1Y')"},
    # the first region begins after the first consonant after a vowel, the second likewise within the first
    {"r1": f"regexp_extract(w, '^(?:{BEGINNINGS}|.*?[{VOWELS}][^{VOWELS}])', 0)"},
    {"r1": "CASE WHEN r1 <> '' THEN length(r1) ELSE length(w) END"},
    {"r2": f"regexp_extract(substring(w, r1 + 1), '^.*?[{VOWELS}][^{VOWELS}]', 0)"},
    {"r2": "CASE WHEN r2 <> '' THEN r1 + length(r2) ELSE length(w) END", "w": "regexp_replace(w, \"(?:'s'|'s|')$\", '')"},
    {"w": f"""CASE WHEN endswith(w, 'sses') THEN {_cut(2)} WHEN endswith(w, 'ied') OR endswith(w, 'ies') THEN concat({_cut(3)}, CASE WHEN length(w) > 4 THEN 'i' ELSE 'ie' END)
      WHEN rlike(w, '(?:us|ss)$') THEN w WHEN rlike(w, '[{VOWELS}].+s$') THEN {_cut(1)} ELSE w END"""},
    {"plural": "w", "t": "regexp_replace(w, '(?:ingly|edly|ing|ed)$', '')"},
    {"w": f"""CASE WHEN endswith(w, 'eedly') THEN CASE WHEN length(w) - 5 >= r1 THEN {_cut(3)} ELSE w END WHEN endswith(w, 'eed') THEN CASE WHEN length(w) - 3 >= r1 THEN {_cut(1)} ELSE w END
      WHEN t <> w AND rlike(t, '[{VOWELS}]') THEN CASE WHEN rlike(t, '(?:at|bl|iz)$') THEN concat(t, 'e') WHEN rlike(t, '{DOUBLES}') THEN {_cut(1, "t")}
        WHEN rlike(t, '{SHORT}') AND length(t) <= r1 THEN concat(t, 'e') ELSE t END ELSE w END"""},
    {"w": f"regexp_replace(w, '(?<=.[^{VOWELS}])[yY]$', 'i')"},
    {"w": _replaced("r1", [(x, y, f"rlike(w, '{before}{x}$')" if before else "") for x, y, before in STEP_2])},
    {"w": _replaced("r1", [(x, y, "length(w) - 5 >= r2" if x == "ative" else "") for x, y in STEP_3])},
    {"w": _replaced("r2", [(x, "", "rlike(w, '[st]ion$')" if x == "ion" else "") for x in STEP_4])},
    {"w": f"""CASE WHEN endswith(w, 'e') THEN CASE WHEN length(w) > r2 OR length(w) > r1 AND NOT rlike({_cut(1)}, '{SHORT}') THEN {_cut(1)} ELSE w END
      WHEN endswith(w, 'll') AND length(w) > r2 THEN {_cut(1)} ELSE w END"""},
    {"w": f"""CASE {" ".join(f"WHEN word = '{x}' THEN '{y}'" for x, y in EXCEPTIONS.items())} WHEN length(word) <= 2 THEN word
      WHEN plural IN ({", ".join(f"'{x}'" for x in FINISHED)}) THEN replace(plural, 'Y', 'y') ELSE replace(w, 'Y', 'y') END"""},
)


def with_stems(rows: DataFrame, word: str, out: str) -> DataFrame:
    """rows with the Porter2 stem of the word, which is in small letters, in out.

    Each step is a column of its own, which Spark computes once however often the next one names it. The result
    is checkpointed, as a filter of stems would be pushed below, which writes all steps into each other.
    """
    kept = [c for c in rows.columns if c != out]
    rows = rows.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.col(word).alias("word"), F.col(word).alias("w"))
    for step in _STEPS:
        rows = rows.select(*[F.col(c) for c in rows.columns if c not in step], *[F.expr(text).alias(c) for c, text in step.items()])
    return checkpoint(rows.select("row.*", F.col("w").alias(out)))


def with_lexemes(rows: DataFrame, word: str, out: str, config: str = "english") -> DataFrame:
    """rows with what the word, in small letters, is indexed as in out; null for one that is not."""
    if config not in CONFIGS:
        raise ValueError(f"unknown analyser {config!r}; there are {', '.join(CONFIGS)}")
    indexed = (F.col(word) != "") if config == "simple" else (F.col(word) != "") & ~F.col(word).isin(*STOP_WORDS)
    if config != "english":
        return rows.withColumn(out, F.when(indexed, F.col(word)))
    return with_stems(rows, word, out).withColumn(out, F.when(indexed, F.col(out)))
