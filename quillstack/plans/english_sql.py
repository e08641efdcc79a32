"""The english analyser as SQL, over the same fixed values."""

from __future__ import annotations

from ..operators import analysis as a

TOKENS = "regexp_extract_all(lower({}), '[\\p{{L}}\\p{{M}}\\p{{Nd}}]+')"
STOP = "(" + ", ".join(f"'{w}'" for w in a.STOP_WORDS) + ")"


def _cases(cases, region: str) -> str:
    """cases: (suffix, replacement, further condition), the first that fits decides."""
    one = "WHEN ends_with(s, '{0}') THEN CASE WHEN length(s) - {1} >= {2}{3} THEN left(s, length(s) - {1}) || '{4}' ELSE s END"
    return "CASE " + " ".join(one.format(x, len(x), region, f" AND {also}" if also else "", y) for x, y, also in cases) + " ELSE s END"


_V = f"[{a.VOWELS}]"
_N = f"[^{a.VOWELS}]"
_STEP_2 = _cases([(x, y, f"regexp_matches(s, '{b}{x}$')" if b else "") for x, y, b in a.STEP_2], "r1")
_STEP_3 = _cases([(x, y, "length(s) - 5 >= r2" if x == "ative" else "") for x, y in a.STEP_3], "r1")
_STEP_4 = _cases([(x, "", "regexp_matches(s, '[st]ion$')" if x == "ion" else "") for x in a.STEP_4], "r2")


def vocabulary(words: str) -> str:
    """CTEs that end in voc (word, lexeme) for the words that a query names in a column w."""
    return f"""
v0 AS (SELECT DISTINCT w AS word FROM ({words}) WHERE w NOT IN {STOP}),
v1 AS (SELECT word, regexp_replace(regexp_replace(word, '^y', 'Y'), '({_V})y', '\\1Y', 'g') AS s FROM v0),
v2 AS (SELECT word, s, regexp_extract(s, '^(?:{a.BEGINNINGS}|.*?{_V}{_N})') AS b FROM v1),
v3 AS (SELECT word, s, CASE WHEN b <> '' THEN length(b) ELSE length(s) END AS r1 FROM v2),
v4 AS (SELECT word, s, r1, regexp_extract(s[r1 + 1:], '^.*?{_V}{_N}') AS b FROM v3),
v5 AS (SELECT word, r1, CASE WHEN b <> '' THEN r1 + length(b) ELSE length(s) END AS r2,
  CASE WHEN ends_with(s, 'sses') THEN left(s, length(s) - 2) WHEN ends_with(s, 'ied') OR ends_with(s, 'ies') THEN left(s, length(s) - 3) || CASE WHEN length(s) > 4 THEN 'i' ELSE 'ie' END
  WHEN regexp_matches(s, '(?:us|ss)$') THEN s WHEN regexp_matches(s, '{_V}.+s$') THEN left(s, length(s) - 1) ELSE s END AS s FROM v4),
v6 AS (SELECT *, s IN ({", ".join(f"'{x}'" for x in a.FINISHED)}) AS done, s AS plural, regexp_replace(s, '(?:ingly|edly|ing|ed)$', '') AS t FROM v5),
v7 AS (SELECT word, r1, r2, done, plural, CASE WHEN ends_with(s, 'eedly') THEN CASE WHEN length(s) - 5 >= r1 THEN left(s, length(s) - 3) ELSE s END
  WHEN ends_with(s, 'eed') THEN CASE WHEN length(s) - 3 >= r1 THEN left(s, length(s) - 1) ELSE s END
  WHEN t <> s AND regexp_matches(t, '{_V}') THEN CASE WHEN regexp_matches(t, '(?:at|bl|iz)$') THEN t || 'e' WHEN regexp_matches(t, '{a.DOUBLES}') THEN left(t, length(t) - 1)
    WHEN regexp_matches(t, '{a.SHORT}') AND length(t) <= r1 THEN t || 'e' ELSE t END ELSE s END AS s FROM v6),
v8 AS (SELECT * REPLACE (CASE WHEN regexp_matches(s, '.{_N}[yY]$') THEN left(s, length(s) - 1) || 'i' ELSE s END AS s) FROM v7),
v9 AS (SELECT * REPLACE ({_STEP_2} AS s) FROM v8),
v10 AS (SELECT * REPLACE ({_STEP_3} AS s) FROM v9),
v11 AS (SELECT * REPLACE ({_STEP_4} AS s) FROM v10),
v12 AS (SELECT * REPLACE (CASE WHEN ends_with(s, 'e') THEN CASE WHEN length(s) > r2 OR length(s) > r1 AND NOT regexp_matches(left(s, length(s) - 1), '{a.SHORT}') THEN left(s, length(s) - 1) ELSE s END
  WHEN ends_with(s, 'll') AND length(s) > r2 THEN left(s, length(s) - 1) ELSE s END AS s) FROM v11),
voc AS (SELECT word, CASE {" ".join(f"WHEN word = '{x}' THEN '{y}'" for x, y in a.EXCEPTIONS.items())} WHEN length(word) <= 2 THEN word WHEN done THEN replace(plural, 'Y', 'y') ELSE replace(s, 'Y', 'y') END AS lexeme FROM v12)"""
