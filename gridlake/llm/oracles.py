"""DuckDB SQL for the queries that SQL can express; each is written from the query's contract, not from its plan."""

from __future__ import annotations

from . import license_dice as ld
from . import quality_lines as ql

_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def _base32(hexa: str) -> str:
    """Base32 of 40 hex digits: 20 bits at a time."""
    digits = []
    for block in range(8):
        value = f"CAST('0x' || substr({hexa}, {5 * block + 1}, 5) AS INTEGER)"
        digits += [f"substr('{_ALPHABET}', (({value} >> {k}) & 31) + 1, 1)" for k in (15, 10, 5, 0)]
    return " || ".join(digits)


OP10 = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
t AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS top FROM p)
SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, {_base32("h")} AS payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> top THEN top END AS refers_to
FROM t
"""

#: No turn of these conversations repeats an earlier one, so each answers the turn before it.
OP8 = """
SELECT conv_id, turn, CASE WHEN turn > 0 THEN turn - 1 END AS parent_turn, CAST(0 AS BIGINT) AS root_turn,
       turn AS depth, turn AS position, trim(coalesce(text, ''), chr(10)) AS text
FROM conversations
"""

_W = r"[\x20\x09-\x0D]"
_TERMINAL = ", ".join("'" + c.replace("'", "''") + "'" for c in ql.TERMINAL)
_WORDS = f"list_filter(string_split_regex(%s, '{_W}+'), lambda x: x <> '')"
_COUNT = "(length(%s) - length(regexp_replace(%s, '%s', '', 'g')))"


def _count(text: str, pattern: str) -> str:
    return _COUNT % (text, text, pattern)


OP7 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
l AS (SELECT r, t, unnest(string_split(t, chr(10))) AS x FROM d),
m AS (SELECT r, x, len({_WORDS % "x"}) AS n FROM l),
f AS (
  SELECT r, x, n, n > 0 AND (
    (right(rtrim(x, ' '), 1) NOT IN ({_TERMINAL}) AND n < 3)
    OR ({_count("x", ql.SYMBOLS)} > 0 AND {_count("x", ql.SYMBOLS)} * 2 >= n)
    OR ({_count("x", ql.NAV_SEPARATORS)} >= 3 AND {_count("x", ql.NAV_SEPARATORS)} * 4 >= n)
    OR (length(x) <= {ql.MAX_BOILERPLATE_CHARS} AND regexp_matches(x, '{ql.BOILERPLATE}'))) AS fails
  FROM m),
g AS (
  SELECT r, count(*) FILTER (n > 0) - count(DISTINCT x) FILTER (n > 0) AS n_dup_lines, count(*) FILTER (fails) AS n_failed_lines,
         coalesce(sum(length(regexp_replace(x, '{_W}+', '', 'g'))) FILTER (NOT fails), 0) AS kept_chars
  FROM f GROUP BY r),
w AS (SELECT r, unnest({_WORDS % "t"}) AS x, generate_subscripts({_WORDS % "t"}, 1) AS i FROM d),
tri AS (SELECT r, i, x, lead(x, 1) OVER o AS y, lead(x, 2) OVER o AS z FROM w WINDOW o AS (PARTITION BY r ORDER BY i)),
c AS (SELECT r, i, count(*) OVER (PARTITION BY r, x, y, z) AS k FROM tri WHERE z IS NOT NULL),
rep AS (SELECT r, count(DISTINCT i + j) AS n_repeat_words FROM (SELECT r, i, unnest([0, 1, 2]) AS j FROM c WHERE k > 1) GROUP BY r),
s AS (
  SELECT doc_id, CAST(len({_WORDS % "t"}) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '{_W}+', '', 'g')) AS BIGINT) AS word_chars,
         CAST({_count("t", ql.SYMBOLS)} AS BIGINT) AS n_symbols, n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
         n_failed_lines, kept_chars
  FROM d JOIN g USING (r) LEFT JOIN rep USING (r)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND kept_chars >= word_chars * {ql.MIN_KEPT_SHARE} AS kept, n_failed_lines
FROM b
"""

_GRAMS = ", ".join(
    f"({k}, '{name}', {len(grams)}, {ld.bounds(len(grams), ld.MIN_DICE)[0]}, {ld.bounds(len(grams), ld.MIN_DICE)[1]}, [{', '.join(repr(g) for g in grams)}])"
    for k, (name, grams) in enumerate((name, ld.template_bigrams(text)) for name, text in ld.TEMPLATES)
)

OP6 = rf"""
WITH t AS (SELECT * FROM (VALUES {_GRAMS}) AS x(t, license, n, need, span, grams)),
tg AS (SELECT t, unnest(grams) AS g FROM t),
d AS (SELECT row_number() OVER () AS r, doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL),
l AS (SELECT r, doc_id, unnest(l) AS x, generate_subscripts(l, 1) AS line FROM d),
lw AS (SELECT r, doc_id, line, list_filter(string_split_regex(lower(x), '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '') AS ws FROM l),
w AS (SELECT r, doc_id, line, unnest(ws) AS w, generate_subscripts(ws, 1) AS k FROM lw),
o AS (SELECT r, doc_id, line, w, row_number() OVER (PARTITION BY r ORDER BY line, k) - 1 AS pos FROM w),
b AS (SELECT r, doc_id, pos, line, lead(line) OVER p AS next_line, w || ' ' || lead(w) OVER p AS g FROM o WINDOW p AS (PARTITION BY r ORDER BY pos)),
m AS (SELECT r, doc_id, t, pos, line, next_line, g, row_number() OVER (PARTITION BY r, t ORDER BY pos) AS k FROM b JOIN tg USING (g)),
c AS (
  SELECT x.r, x.doc_id, x.t, license, n, x.pos, y.pos - x.pos + 1 AS size, x.line, y.next_line AS last_line
  FROM m x JOIN m y ON x.r = y.r AND x.t = y.t JOIN t ON t.t = x.t
  WHERE y.pos - x.pos BETWEEN 0 AND span - 1 AND y.k - x.k + 1 >= need),
i AS (SELECT c.r, c.t, c.pos, c.size, count(DISTINCT m.g) AS common FROM c JOIN m ON m.r = c.r AND m.t = c.t AND m.pos BETWEEN c.pos AND c.pos + c.size - 1 GROUP BY ALL),
u AS (SELECT c.r, c.t, c.pos, c.size, count(DISTINCT b.g) AS grams FROM c JOIN b ON b.r = c.r AND b.pos BETWEEN c.pos AND c.pos + c.size - 1 GROUP BY ALL),
s AS (SELECT c.*, 2.0::DOUBLE * common / (grams + n) AS dice FROM c JOIN i USING (r, t, pos, size) JOIN u USING (r, t, pos, size)),
h AS (
  SELECT * FROM (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY r, t, pos ORDER BY dice DESC, size) = 1) WHERE dice >= {ld.MIN_DICE}),
f AS (
  SELECT * FROM h WHERE NOT EXISTS (
    SELECT 1 FROM h o WHERE o.r = h.r AND o.license <> h.license AND o.pos < h.pos + h.size AND h.pos < o.pos + o.size
      AND (o.dice > h.dice OR (o.dice = h.dice AND (o.size > h.size OR (o.size = h.size AND o.license > h.license))))))
SELECT doc_id, license, dice, line, last_line - line + 1 AS n_lines, pos AS word, size + 1 AS n_words FROM f
QUALIFY row_number() OVER (PARTITION BY doc_id, license ORDER BY dice DESC, size, pos) = 1
"""

ORACLES = {"op6_license_dice": OP6, "op7_line_quality": OP7, "op8_quote_threads": OP8, "op10_zip_warc": OP10}
