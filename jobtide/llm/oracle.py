"""DuckDB SQL of the training-data queries that SQL can express.

The SQL states each result plainly, by the definitions rather than by the
operators' methods. Token files, line alignment, greedy shard placement and the
trained models have none; they are tested against brute force or held out rows.
"""

from __future__ import annotations

from . import line_quality, mixing, secrets

WORD = r"[^\x20\x09-\x0D]+"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _secrets() -> str:
    parts = []
    for rank, rule in enumerate(secrets.RULES):
        p = _text(rule.pattern)
        parts.append(
            f"SELECT doc_id, {rank} rank, '{rule.kind}' kind, {rule.least} least,"
            f" string_split_regex(t, {p}) gaps, regexp_extract_all(t, {p}, 0) wholes,"
            f" regexp_extract_all(t, {p}, {rule.group}) secrets FROM d WHERE regexp_matches(t, {p})")
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') t FROM documents),
hits AS ({' UNION ALL '.join(parts)}),
places AS (SELECT doc_id, rank, kind, least, gaps, wholes, secrets, unnest(range(1, len(wholes) + 1)) i FROM hits),
spans AS (
 SELECT doc_id, rank, kind,
  CAST(list_sum(list_transform(gaps[1:i], lambda x: length(x)))
   + coalesce(list_sum(list_transform(wholes[1:i - 1], lambda x: length(x))), 0) AS BIGINT) a, length(wholes[i]) n
 FROM places WHERE length(secrets[i]) >= least),
per_doc AS (
 SELECT doc_id, count(*) FILTER (rank = 0) n_assign, count(*) FILTER (rank = 1) n_access,
  count(*) FILTER (rank = 2) n_hex,
  coalesce(string_agg(kind || ':' || a || ':' || (a + n), ',' ORDER BY a, rank) FILTER (rank < 3), '') base,
  string_agg(kind || ':' || a || ':' || (a + n), ',' ORDER BY a, rank) spans
 FROM spans GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) n_assign, coalesce(n_access, 0) n_access, coalesce(n_hex, 0) n_hex,
 sha256(coalesce(base, '')) base_sha256, coalesce(spans, '') spans
FROM d LEFT JOIN per_doc USING (doc_id)
"""


MINHASH_DEDUP = rf"""
WITH RECURSIVE w AS (
 SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '{WORD}') ws FROM documents),
sets AS (
 SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
  ELSE list_distinct(list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i:i + 2], ' '))) END s FROM w),
classes AS (SELECT list_sort(s) s, min(doc_id) id, len(s) n FROM sets WHERE len(s) > 0 GROUP BY ALL),
shingles AS (SELECT id, n, unnest(s) h FROM classes),
links AS (
 SELECT a.id x, b.id y FROM shingles a JOIN shingles b ON a.h = b.h AND a.id < b.id
 WHERE 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
 GROUP BY a.id, b.id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(id, r) AS (SELECT id, id FROM classes UNION SELECT b.y, r.r FROM reach r JOIN both_ways b ON b.x = r.id),
component AS (SELECT id, min(r) c FROM reach GROUP BY id)
SELECT sets.doc_id, CAST(len(sets.s) AS BIGINT) n_shingles, coalesce(c, sets.doc_id) component_id,
 sets.doc_id = coalesce(c, sets.doc_id) kept
FROM sets LEFT JOIN classes ON list_sort(sets.s) = classes.s LEFT JOIN component ON component.id = classes.id
"""

DECONTAMINATION = r"""
WITH t AS (
 SELECT 'd' kind, doc_id id, coalesce(text, '') t FROM documents
 UNION ALL SELECT 'b', item_id, coalesce(text, '') FROM benchmark),
w AS (SELECT kind, id, regexp_extract_all(lower(nfc_normalize(t)), '[\p{L}\p{N}]+') ws FROM t),
-- An item of fewer than five words is one shingle; documents have windows of its length too.
lengths AS (SELECT DISTINCT least(len(ws), 5) k FROM w WHERE kind = 'b' AND len(ws) > 0),
s AS (
 SELECT kind, id, unnest(list_distinct(list_transform(range(1, greatest(len(ws) - k + 2, 1)),
  lambda i: array_to_string(ws[i:i + k - 1], ' ')))) h
 FROM w, lengths WHERE kind = 'd' OR k = least(len(ws), 5)),
item AS (SELECT id, h, count(*) OVER (PARTITION BY id) n FROM s WHERE kind = 'b'),
found AS (
 SELECT s.id doc_id, item.id item_id FROM s JOIN item ON s.h = item.h WHERE s.kind = 'd'
 GROUP BY s.id, item.id, item.n HAVING 100 * count(*) >= 80 * item.n),
per_doc AS (SELECT doc_id, count(*) n, string_agg(item_id, ',' ORDER BY item_id) i FROM found GROUP BY doc_id)
SELECT d.doc_id, n IS NOT NULL contaminated, coalesce(n, 0) n_items, coalesce(i, '') AS items
FROM documents d LEFT JOIN per_doc p ON d.doc_id = p.doc_id
"""


def _line_quality() -> str:
    q = line_quality
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '{WORD}') ws FROM d),
triples AS (
 SELECT doc_id, i, array_to_string(ws[i:i + 2], ' ') h
 FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) i FROM w)),
repeated AS (
 SELECT doc_id, count(DISTINCT p) n FROM (
  SELECT doc_id, unnest([i, i + 1, i + 2]) p FROM (
   SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, h) c FROM triples) WHERE c > 1) GROUP BY doc_id),
l AS (
 SELECT doc_id, line, len(regexp_extract_all(line, '{WORD}')) n,
  length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g')) chars
 FROM (SELECT doc_id, unnest(string_split(t, chr(10))) line FROM d)),
judged AS (
 SELECT doc_id, line, chars,
  NOT regexp_matches(line, '\p{{L}}')
  OR len(regexp_extract_all(line, '[#*$%&|<>@^~{{}}\\]')) > CAST({q.SYMBOL_SHARE} AS DOUBLE) * chars
  OR len(regexp_extract_all(line, '(?:!!|\?\?)+')) > CAST({q.DOUBLED_SHARE} AS DOUBLE) * n
  OR len(regexp_extract_all(line, '[|»›•·]')) > CAST({q.SEPARATOR_SHARE} AS DOUBLE) * n
  OR (n <= {q.SHORT_LABEL} AND NOT regexp_matches(line, '[.!?:;,…"''”)\]][\x20\x09-\x0D]*$'))
  OR (n <= {q.SHORT_LINE} AND regexp_matches(lower(line), '{q.PHRASES}')) AS fails
 FROM l WHERE n > 0),
per_doc AS (
 SELECT doc_id, count(*) - count(DISTINCT line) dup, count(*) FILTER (fails) failed,
  coalesce(sum(chars) FILTER (fails), 0) lost FROM judged GROUP BY doc_id),
counted AS (
 SELECT w.doc_id, CAST(len(ws) AS BIGINT) n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) word_chars,
  CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) n_symbols, coalesce(dup, 0) n_dup_lines,
  coalesce(repeated.n, 0) n_repeat_words, coalesce(failed, 0) n_failed_lines, CAST(coalesce(lost, 0) AS BIGINT) lost_chars
 FROM w LEFT JOIN per_doc p ON w.doc_id = p.doc_id LEFT JOIN repeated ON w.doc_id = repeated.doc_id)
SELECT *, n_words < {q.LEAST_WORDS} OR 100 * n_repeat_words > {q.REPEATED} * n_words AS base_failed,
 NOT (n_words < {q.LEAST_WORDS} OR 100 * n_repeat_words > {q.REPEATED} * n_words)
  AND lost_chars <= CAST({q.LOST} AS DOUBLE) * word_chars AS kept
FROM counted
"""


def _mixing() -> str:
    m = mixing
    return rf"""
WITH RECURSIVE d AS (
 SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) size FROM documents),
s AS (
 SELECT source, CAST(sum(size) AS BIGINT) source_size, row_number() OVER (ORDER BY source NULLS LAST) r
 FROM d GROUP BY source),
weighted AS (SELECT *, (r - 1) % 3 + 1 weight, (SELECT sum(source_size) FROM s) total FROM s),
-- Targets stop at the cap and the excess is shared again, round by round.
shares AS (
 SELECT 0 round, source, r, source_size, weight, total, CAST(0 AS DOUBLE) target, false capped FROM weighted
 UNION ALL
 SELECT round + 1, source, r, source_size, weight, total,
  CASE WHEN capped THEN target ELSE least({m.REPEATS} * source_size, share) END,
  capped OR share > {m.REPEATS} * source_size
 FROM (SELECT *, (total - coalesce(sum(target) FILTER (capped) OVER (), 0))
        / nullif(sum(weight) FILTER (NOT capped) OVER (), 0) * weight share FROM shares)
 WHERE round <= (SELECT count(*) FROM s)),
t AS (SELECT * FROM shares WHERE round = (SELECT max(round) FROM shares)),
seats AS (
 SELECT source, r, seat, row_number() OVER (ORDER BY target / (2 * seat + 1) DESC, r) place, blocks FROM (
  SELECT source, r, target, ceil(total / {m.BLOCK}) blocks,
   unnest(range(0, CAST(ceil(total / {m.BLOCK}) AS BIGINT))) seat FROM t WHERE target > 0)),
awarded AS (SELECT * FROM seats WHERE place <= blocks),
given AS (
 SELECT t.*, least({m.BLOCK} * coalesce((SELECT count(*) FROM awarded a WHERE a.r = t.r), 0),
  {m.REPEATS} * source_size) words FROM t),
placed AS (
 SELECT d.*, coalesce(sum(size) OVER (PARTITION BY source ORDER BY md5(concat_ws(':', '{m.SEED}', doc_id, size)), doc_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begins FROM d),
taken AS (
 SELECT doc_id, size, source_size, g.target, g.weight, g.r, CAST(begins // {m.BLOCK} AS BIGINT) block,
  CAST(words // greatest(source_size, 1) * size
   + greatest(least(words % greatest(source_size, 1) - begins, size), 0) AS BIGINT) taken
 FROM placed p JOIN given g ON p.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target, taken, weight,
 CASE WHEN taken > 0 THEN CAST(least(coalesce(
  (SELECT count(*) FROM range(0, {m.SHARDS}) h(j) WHERE floor(a.blocks * (j + 1) / {m.SHARDS}) < a.place),
  {m.SHARDS} - 1), {m.SHARDS} - 1) AS INTEGER) END AS shard
FROM taken t LEFT JOIN awarded a ON a.r = t.r AND a.seat = t.block
"""


# The CRC-32 of a decimal number, bit by bit: each byte is followed by eight steps (-1).
PREFIX_TRIE = rf"""
WITH t AS (
 SELECT conv_id, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) k,
  len(regexp_extract_all(coalesce(text, ''), '{WORD}')) w,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
   sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) i
 FROM conversations WHERE conv_id IS NOT NULL),
c AS (
 SELECT conv_id, conv_id - conv_id % 20 base, xor(list_reduce(
   list_concat([CAST(4294967295 AS BIGINT)], flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
    lambda ch: [CAST(ascii(ch) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
   lambda acc, v: CASE WHEN v >= 0 THEN xor(acc, v) ELSE xor(acc >> 1, 3988292384 * (acc & 1)) END),
  4294967295) % 4 h
 FROM (SELECT DISTINCT conv_id FROM t)),
turns AS (
 SELECT c.conv_id, i d, k, w FROM c JOIN t ON t.conv_id = base WHERE i <= h
 UNION ALL SELECT c.conv_id, 3 + i d, k, w FROM c JOIN t ON t.conv_id = c.conv_id WHERE i > h),
s AS (
 SELECT c.conv_id, coalesce(list(k ORDER BY d) FILTER (k IS NOT NULL), []) ks,
  coalesce(list(w ORDER BY d) FILTER (k IS NOT NULL), []) ws
 FROM c LEFT JOIN turns USING (conv_id) GROUP BY c.conv_id),
p AS (
 SELECT conv_id, d, array_to_string(ks[1:d], ',') p, ks[1:d] ks, coalesce(ws[d], 0) w, d = len(ks) ends
 FROM (SELECT *, unnest(range(0, len(ks) + 1)) d FROM s)),
n AS (
 SELECT p, d, min(conv_id) conv_id, count(*) n_convs, any_value(w) w, any_value(ks) ks,
  sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) ends_sha256
 FROM p GROUP BY p, d),
child AS (SELECT array_to_string(ks[1:d - 1], ',') p, count(*) n_children FROM n WHERE d > 0 GROUP BY 1),
own AS (SELECT n.*, coalesce(n_children, 0) n_children FROM n LEFT JOIN child USING (p)),
below AS (
 SELECT a p, count(*) FILTER (n_children = 0) n_leaves, sum((n_convs - 1) * w) saved_tokens
 FROM (SELECT *, array_to_string(ks[1:unnest(range(0, d + 1))], ',') a FROM own) GROUP BY a)
SELECT o.conv_id, CAST(o.d AS BIGINT) AS depth, up.conv_id AS parent_conv_id, o.n_convs, o.n_children, n_leaves,
 CAST(saved_tokens AS BIGINT) AS saved_tokens, o.ends_sha256
FROM own o JOIN below b ON b.p = o.p
LEFT JOIN n up ON o.d > 0 AND up.p = array_to_string(o.ks[1:o.d - 1], ',')
"""


ORACLE_SQL = {
    "op4_secrets": _secrets(),
    "op6_minhash_dedup": MINHASH_DEDUP,
    "op7_decontamination": DECONTAMINATION,
    "op8_line_quality": _line_quality(),
    "op10_mixing": _mixing(),
    "op13_prefix_trie": PREFIX_TRIE,
}
