"""The same results as SQL, for the operators that SQL can express."""

from __future__ import annotations

from . import decontamination, line_dedup, merkle, vector_codes
from . import quality_rules as rules

_WORD = "[^\\x20\\x09-\\x0D]+"

_BAD_LINE = f"""
  CASE WHEN NOT regexp_matches(l, '[^\\x20\\x09-\\x0D]') THEN false
       WHEN len(l) - len(translate(l, '{rules.SEPARATORS}', '')) >= 3 THEN true
       WHEN regexp_matches(l, '{rules.SYMBOLS}') THEN true
       WHEN NOT regexp_matches(l, '{rules.SMALL_LETTER}') AND regexp_matches(l, '{rules.CAPITALS}') THEN true
       WHEN len(s) <= {rules.SHORT_LINE} AND regexp_matches(s, '{rules.BOILERPLATE}') THEN true
       ELSE instr('{rules.CLOSING.replace("'", "''")}', right(s, 1)) = 0 END"""

OP2 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, t, regexp_extract_all(t, '{_WORD}') AS ws FROM d),
g AS (SELECT r, i, ws[i] || chr(10) || ws[i + 1] || chr(10) || ws[i + 2] AS g
      FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) > 2)),
m AS (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM g),
p AS (SELECT r, count(DISTINCT p) AS n_repeat_words FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM m WHERE n > 1) GROUP BY r),
u AS (SELECT r, unnest(string_split(t, chr(10))) AS l FROM d),
s AS (SELECT r, l, trim(l, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS s FROM u),
b AS (SELECT r, l, {_BAD_LINE} AS bad, s <> '' AS spoken FROM s),
k AS (SELECT r, count(*) AS n_lines, count(*) FILTER (bad) AS n_bad_lines, sum(len(l)) AS line_chars,
        coalesce(sum(len(l)) FILTER (bad), 0) AS lost_chars,
        count(*) FILTER (spoken) - count(DISTINCT l) FILTER (spoken) AS n_dup_lines FROM b GROUP BY r),
c AS (SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(list_sum(list_transform(ws, lambda x: len(x))), 0)::BIGINT AS word_chars,
        len(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
        coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, n_lines::BIGINT AS n_lines, n_bad_lines::BIGINT AS n_bad_lines,
        line_chars, lost_chars::BIGINT AS lost_chars
      FROM w JOIN k USING (r) LEFT JOIN p USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 100 * lost_chars <= {rules.MAX_LOSS_PERCENT} * line_chars AS kept,
  n_lines, n_bad_lines, lost_chars
FROM c
"""

OP6 = f"""
WITH x AS (SELECT row_number() OVER () AS r, doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
l AS (SELECT r, doc_id, i, ls[i] AS line FROM x, unnest(range(1, len(ls) + 1)) AS t(i)),
w AS (SELECT r, doc_id, i, line, len(regexp_extract_all(line, '{_WORD}')) AS n, row_number() OVER (PARTITION BY r ORDER BY i) AS spot
      FROM l WHERE regexp_matches(line, '{_WORD}')),
c AS (SELECT *, sum(n) OVER (PARTITION BY r ORDER BY spot) AS upto FROM w),
p AS (SELECT a.r, a.spot AS s, b.spot AS e FROM c a JOIN c b ON a.r = b.r AND b.spot BETWEEN a.spot AND a.spot + {line_dedup.MIN_WORDS}
      WHERE b.upto - a.upto + a.n >= {line_dedup.MIN_WORDS}),
runs AS (SELECT r, s, min(e) AS e FROM p GROUP BY r, s UNION SELECT r, max(s), e FROM p GROUP BY r, e),
k AS (SELECT runs.r, doc_id, s, e, string_agg(line, chr(10) ORDER BY spot) AS run FROM runs JOIN c ON c.r = runs.r AND spot BETWEEN s AND e GROUP BY ALL),
o AS (SELECT r, s, e, row_number() OVER (PARTITION BY run ORDER BY doc_id, r, s) AS nth FROM k),
gone AS (SELECT DISTINCT o.r, c.i FROM o JOIN c ON c.r = o.r AND spot BETWEEN s AND e WHERE nth > 1),
rest AS (SELECT l.r, string_agg(line, chr(10) ORDER BY i) AS text FROM l ANTI JOIN gone USING (r, i) GROUP BY l.r),
cut AS (SELECT r, count(*) AS n FROM gone GROUP BY r)
SELECT doc_id, CASE WHEN n IS NULL THEN x.text ELSE coalesce(rest.text, '') END AS text,
  coalesce(len(ls), 0)::BIGINT AS n_lines, coalesce(n, 0)::BIGINT AS n_deleted
FROM x LEFT JOIN rest USING (r) LEFT JOIN cut USING (r)
"""


def _marked(text: str, names: bool = True) -> str:
    d = decontamination
    named = f"coalesce({text}, '')"
    if names:
        named = f"regexp_replace({named}, '{d.NAME_PATTERN}', '\\1{d.NAME}\\2', 'g')"
    numbered = f"regexp_replace(lower({named}), '{d.NUMBER_PATTERN}', ' {d.NUMBER}\\1\\2 ', 'g')"
    return f"regexp_replace(replace({numbered}, '  ', ' '), '{d.UNIT_PATTERN}', '\\1 {d.UNIT}\\2 ', 'g')"


def _windows(table: str, key: str, names: bool = True) -> str:
    d, n = decontamination, decontamination.WINDOW
    token = f"[\\p{{L}}\\p{{M}}\\p{{Nd}}{d.NAME}{d.NUMBER}{d.UNIT}]+"
    plain = f"regexp_replace(m, '([{d.NAME}{d.NUMBER}{d.UNIT}])[\\p{{L}}\\p{{M}}\\p{{Nd}}]*', '\\1', 'g')"
    return f"""(SELECT {key}, i - 1 AS spot, len(t) AS size, array_to_string(t[i:i + {n - 1}], ' ') AS g, o[i:i + {n - 1}] AS own
      FROM (SELECT {key}, regexp_extract_all(m, '{token}') AS o, regexp_extract_all({plain}, '{token}') AS t
            FROM (SELECT {key}, {_marked("text", names)} AS m FROM {table})) s, unnest(range(1, len(t) - {n - 2})) AS u(i))"""


_SLOT = f"^[{decontamination.NAME}{decontamination.NUMBER}{decontamination.UNIT}]"

_BAND = f"greatest(least(i.size // 3, {decontamination.BAND}), 1)::DOUBLE"

OP7 = f"""
WITH i AS (FROM {_windows("benchmark", "item_id")} UNION FROM {_windows("benchmark", "item_id", False)}),
h AS (SELECT doc_id, item_id, i.size, d.spot AS pos, i.spot AS spot, d.own AS own, i.own AS want,
    unnest([floor((d.spot - i.spot) / {_BAND}), floor((d.spot - i.spot) / {_BAND}) - 1]) AS band
  FROM {_windows("documents", "doc_id")} d JOIN i USING (g)
  WHERE len(list_filter(i.own, lambda w: NOT regexp_matches(w, '{_SLOT}'))) > 0),
c AS (SELECT doc_id, item_id, band FROM (SELECT DISTINCT doc_id, item_id, band, size, unnest(range(spot, spot + {decontamination.WINDOW})) AS token FROM h)
  GROUP BY doc_id, item_id, band, size HAVING count(*) >= {decontamination.MIN_COVER} * size),
v AS (SELECT doc_id, item_id, band, unnest(want) AS a, unnest(own) AS b FROM h),
n AS (SELECT doc_id, item_id, band, a, b, count(*) AS n FROM v WHERE regexp_matches(a, '{_SLOT}') GROUP BY ALL),
m AS (SELECT doc_id, item_id, band, a, max(n) AS most, sum(n) AS n FROM n GROUP BY ALL),
g AS (SELECT doc_id, item_id, band, sum(most) / sum(n) AS agree FROM m GROUP BY ALL),
f AS (SELECT DISTINCT doc_id, item_id FROM c LEFT JOIN g USING (doc_id, item_id, band) WHERE coalesce(agree, 1) >= {decontamination.MIN_AGREE}),
r AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items FROM f GROUP BY doc_id)
SELECT doc_id, n_items IS NOT NULL AS contaminated, coalesce(n_items, 0)::BIGINT AS n_items, coalesce(items, '') AS items
FROM documents LEFT JOIN r USING (doc_id)
"""

_NEAREST = """
a{k} AS MATERIALIZED (SELECT r, part, x, m % 64 AS e, m // 64 AS d FROM (
  SELECT r, part, any_value(x) AS x, min(list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - c[i]) * (x[i] - c[i]))) * 64 + e) AS m
  FROM p JOIN c{k} USING (part) GROUP BY r, part))"""

_MEANS = """,
c{n} AS MATERIALIZED (SELECT part, e, coalesce(s.c, c{k}.c) AS c FROM c{k} LEFT JOIN (
  SELECT part, e, list(mean ORDER BY pos) AS c FROM (
    SELECT part, e, pos, floor(sum(x[pos])::DOUBLE / count(*))::BIGINT AS mean
    FROM (SELECT part, e, x, unnest(range(1, len(x) + 1)) AS pos FROM a{k}) GROUP BY ALL) GROUP BY ALL) s USING (part, e)),"""

OP11 = f"""
WITH v AS (SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, list_transform(embedding, lambda x: floor(x::DOUBLE * {vector_codes.SCALE})::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (SELECT r, part, v[part * len(v) // {vector_codes.PARTS} + 1 : (part + 1) * len(v) // {vector_codes.PARTS}] AS x
  FROM v, unnest(range({vector_codes.PARTS})) AS t(part)),
c0 AS MATERIALIZED (SELECT part, r - 1 AS e, x AS c FROM p WHERE r <= {vector_codes.ENTRIES}),
{"".join(_NEAREST.format(k=k) + _MEANS.format(k=k, n=k + 1) for k in range(vector_codes.ROUNDS))}
{_NEAREST.format(k=vector_codes.ROUNDS)},
o AS (SELECT r, string_agg(format('{{:02x}}', e), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM a{vector_codes.ROUNDS} GROUP BY r),
b AS (SELECT sha256(string_agg(n, ',' ORDER BY part, e, pos)) AS codebooks_sha256 FROM (
  SELECT part, e, unnest(c) AS n, unnest(range(len(c))) AS pos FROM c{vector_codes.ROUNDS}))
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256 FROM v JOIN o USING (r), b
"""


def _field(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN '-' ELSE strlen({x}::VARCHAR) || ':' || {x}::VARCHAR END"


_BEFORE_TEXT = " || ".join(_field(x) for x in merkle.FIELDS[:-1])
#: The bits of CRC-32 by its polynomial, a byte after the other; the last step flips all bits.
_CRC_BIT = f"""xor(1, list_reduce([4294967295] || list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT), lambda c, b:
  list_reduce([xor(c, b)] || range(8), lambda x, i: xor(x >> 1, CASE WHEN x % 2 = 1 THEN 3988292384 ELSE 0 END))) % 2)"""
_UP = f"""SELECT {{g}}, lvl + 1, i // {merkle.FAN}, sha256(string_agg(h, '' ORDER BY i)), (any_value(n) + {merkle.FAN - 1}) // {merkle.FAN}
  FROM {{name}} WHERE n > 1 GROUP BY {{g}}, lvl, i // {merkle.FAN}"""
_SIBLINGS = f"""SELECT {{g}}, lvl, i, coalesce(string_agg(h, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') || ',' ||
    coalesce(string_agg(h, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS step
  FROM {{name}} WHERE n > 1 WINDOW w AS (PARTITION BY {{g}}, lvl, i // {merkle.FAN} ORDER BY i)"""

OP12 = f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, *, {_CRC_BIT} = 0 AS hit FROM documents),
l AS (SELECT r, doc_id, source, sha256({_BEFORE_TEXT} || {_field("text")}) AS leaf,
  sha256({_BEFORE_TEXT} || {_field("(CASE WHEN hit THEN replace(text, chr(10), '') ELSE text END)")}) AS other FROM d),
n AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS i, count(*) OVER (PARTITION BY source) AS n FROM l),
u AS (SELECT source, 0 AS lvl, i, leaf AS h, n FROM n UNION ALL {_UP.format(g="source", name="u")}),
s AS (SELECT source, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM u WHERE n = 1),
t AS (SELECT 0 AS z, 0 AS lvl, i, subroot AS h, n FROM s UNION ALL {_UP.format(g="z", name="t")}),
us AS ({_SIBLINGS.format(g="source", name="u")}),
ts AS ({_SIBLINGS.format(g="z", name="t")}),
a AS (SELECT r, list(step ORDER BY us.lvl) AS steps FROM n JOIN us ON n.source IS NOT DISTINCT FROM us.source AND us.i = n.i // ({merkle.FAN} ** us.lvl)::BIGINT GROUP BY r),
b AS (SELECT source, list(step ORDER BY lvl) AS steps FROM s JOIN ts ON ts.i = s.i // ({merkle.FAN} ** lvl)::BIGINT GROUP BY source),
f AS (SELECT doc_id, leaf, other, subroot, (SELECT h FROM t WHERE n = 1) AS root, coalesce(a.steps, []) || coalesce(b.steps, []) AS steps
  FROM n LEFT JOIN a USING (r) JOIN s ON s.source IS NOT DISTINCT FROM n.source LEFT JOIN b ON b.source IS NOT DISTINCT FROM n.source),
e AS (SELECT doc_id, leaf, subroot, root, sha256(replace(array_to_string(steps, ''), ',', '')) AS proof_sha256,
  list_reduce([other] || steps, lambda c, x: sha256(split_part(x, ',', 1) || c || split_part(x, ',', 2))) AS folded_root FROM f)
SELECT *, folded_root = root AS verified FROM e
"""

ORACLES = {
    "op2_quality_rules": OP2,
    "op6_line_dedup": OP6,
    "op7_decontamination": OP7,
    "op11_vector_codes": OP11,
    "op12_merkle_manifest": OP12,
}
