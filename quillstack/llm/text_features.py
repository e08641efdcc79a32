"""Dense statistics of whole texts, for the classifiers of this subpackage."""

from __future__ import annotations

import math
import re

import numpy as np

#: Fixed word list: pronouns that address the reader, in the languages of the corpus.
SECOND_PERSON = frozenset(
    "you your yours yourself yourselves u ur du dich dir dein deine deinen deiner ihr euch euer sie ihnen ihre"
    " tu te toi ton ta tes vous votre vos tú ti tus usted ustedes vosotros vuestro".split()
)
_SQUEEZE = re.compile(r"(.)\1{2,}")
_MASK = str.maketrans("013457@$!|*", "oieastasil*")
_EDGE = " \t\n\x0b\x0c\r.,;:!?…\"'()[]{}<>«»“”‘’¿¡-–—*#$%&|"

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LOWER = np.zeros(256, bool)
_LOWER[97:123] = True
_HIGH = np.arange(256) >= 192  # the first byte of each further letter
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_SYMBOL = np.isin(np.arange(256), list(b"#*$%&|<>{}~^=_\\@+"))
_PUNCT = np.isin(np.arange(256), list(b".,;:!?'\"()-"))


def plain(word: str) -> str:
    """A word without its outer marks, in small letters."""
    return word.strip(_EDGE).lower()


def unmask(word: str) -> str:
    """A word with look-alike digits and signs read as letters and drawn-out letters cut."""
    return _SQUEEZE.sub(r"\1", word.lower().translate(_MASK))


def stem(word: str) -> str:
    return word[:6]


def masked(word: str) -> bool:
    """Letters with digits or signs between them, as in obfuscated insults."""
    inner = word.strip(_EDGE)
    return len(inner) > 2 and not inner.isalpha() and inner[0].isalpha() and any(c in "013457@$!|*" for c in inner[1:])


TOXICITY_FEATURES = (
    "log_words", "lexicon_density", "lexicon_share", "lexicon_hits", "lexicon_kinds", "stem_density", "stem_hits",
    "weight_density", "strongest", "address_density", "near_address", "capital_words", "capital_letters",
    "exclamations", "questions", "punctuation", "obfuscated", "unmasked_hits",
)


def toxicity(text: str | None, lexicon: dict[str, float], stems: dict[str, float]) -> list[float]:
    """The features of TOXICITY_FEATURES; all zero for null and for texts without words."""
    raw = (text or "").split()
    n = len(raw)
    if not n:
        return [0.0] * len(TOXICITY_FEATURES)
    hits, kinds, weight, strongest, stem_hits, address, near, caps, hidden, unmasked = 0, set(), 0.0, 0.0, 0, 0, 0, 0, 0, 0
    last_hit = last_address = -100
    for i, token in enumerate(raw):
        w = token.strip(_EDGE).lower()
        value = lexicon.get(w)
        if value is None and masked(token):
            hidden += 1
            value = lexicon.get(unmask(w))
            unmasked += value is not None
        if value is not None:
            hits += 1
            kinds.add(w)
            weight += value
            strongest = max(strongest, value)
            last_hit = i
            near += i - last_address <= 5
        elif w[:6] in stems and len(w) >= 6:
            stem_hits += 1
        if w in SECOND_PERSON:
            address += 1
            last_address = i
            near += i - last_hit <= 5
        if len(token) > 2 and token.isupper():
            caps += 1
    counts = np.bincount(np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8), minlength=256)
    letters = max(1, int(counts[_UPPER].sum() + counts[_LOWER].sum() + counts[_HIGH].sum()))
    return [
        math.log1p(n), 100.0 * hits / n, min(1.0, 20.0 * hits / n), float(hits), float(len(kinds)), 100.0 * stem_hits / n,
        float(stem_hits), 100.0 * weight / n, strongest, 100.0 * address / n, 100.0 * near / n, caps / n,
        float(counts[_UPPER].sum()) / letters, 100.0 * counts[33] / n, 100.0 * counts[63] / n,
        float(counts[_PUNCT].sum()) / letters, 100.0 * hidden / n, float(unmasked),
    ]


QUALITY_FEATURES = (
    "log_words", "log_word_length", "word_length_spread", "distinct_words", "letter_share", "upper_share", "digit_share",
    "symbol_share", "punctuation_share", "exclamation_share", "words_per_line", "closed_lines", "distinct_lines", "repeat_pairs",
)


def _logit(x: float) -> float:
    x = min(max(x, 0.002), 0.998)
    return math.log(x / (1 - x))


def quality(text: str | None) -> list[float]:
    """The features of QUALITY_FEATURES, transformed towards normal distributions; texts without words get those of no words."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    n = len(words)
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256) if data else np.zeros(256, np.int64)
    high = int(counts[_HIGH].sum())
    upper, lower = int(counts[_UPPER].sum()), int(counts[_LOWER].sum())
    letters = upper + lower + high
    chars = max(1, int(counts.sum()) - int(counts[128:192].sum()) - int(counts[9:14].sum()) - int(counts[32]))
    lengths = np.fromiter(map(len, words), np.int64, n) if n else np.zeros(1, np.int64)
    lines = [x for x in data.split(b"\n") if x.strip()]
    closed = sum(x.rstrip()[-1:] in b".!?\"')" for x in lines)
    pairs = set(zip(words, words[1:]))
    return [
        math.log1p(n),
        math.log1p(float(lengths.mean())),
        math.log1p(float(lengths.std())),
        len(set(words)) / n * math.log1p(n) if n else 0.0,
        _logit(letters / chars),
        _logit(upper / max(1, letters)),
        _logit(int(counts[_DIGIT].sum()) / chars),
        _logit(int(counts[_SYMBOL].sum()) / chars),
        _logit(int(counts[_PUNCT].sum()) / chars),
        _logit(int(counts[33]) / chars),
        math.log1p(n / max(1, len(lines))),
        _logit(closed / max(1, len(lines))),
        _logit(len(set(lines)) / max(1, len(lines))),
        _logit(1 - len(pairs) / (n - 1)) if n > 1 else _logit(0.0),
    ]


NGRAM_DIMENSIONS = 1024


def ngrams(text: str | None, dimensions: int = NGRAM_DIMENSIONS) -> np.ndarray | None:
    """Square roots of the shares of hashed byte bigrams and trigrams, in small letters; None without letters."""
    lowered = (text or "").lower()
    if not any(map(str.isalpha, lowered)):
        return None
    data = np.frombuffer(f"  {lowered} ".encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint32)
    data[(data < 97) | ((data > 122) & (data < 128))] = 32
    two = data[:-1] * np.uint32(256) + data[1:]
    three = two[:-1] * np.uint32(256) + data[2:]
    keep2, keep3 = two != 0x2020, (data[1:-1] != 32)
    shift = np.uint32(32 - int(math.log2(dimensions)))
    hashed = np.concatenate(
        [(two[keep2] * np.uint32(2654435761)) >> shift, ((three[keep3] ^ np.uint32(0x9E3779B9)) * np.uint32(2246822519)) >> shift]
    )
    counts = np.bincount(hashed, minlength=dimensions)
    return np.sqrt(counts / max(1, counts.sum())).astype(np.float32)
