"""DuckDB SQL of the queries that SQL can express, written apart from the operators."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_MATCH = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP1 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
win AS (SELECT doc_id, i, w[i:i+7] AS g FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 7)) AS i FROM d WHERE len(w) >= 8)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) WHERE c > 1),
cov AS (SELECT doc_id, count(DISTINCT i + o) AS n FROM rep, (SELECT unnest(generate_series(0, 7)) AS o) GROUP BY doc_id),
ln AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup FROM
       (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM d) WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY doc_id),
f AS (SELECT d.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
      length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_lines, 0) AS n_lines, coalesce(n_dup, 0) AS n_dup_lines,
      coalesce(n, 0) AS n_repeat_words FROM d LEFT JOIN cov USING (doc_id) LEFT JOIN ln USING (doc_id)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 100 * n_symbols > 10 * word_chars OR 100 * n_dup_lines > 30 * n_lines
            OR word_chars < 2 * n_words OR word_chars > 25 * n_words) AS kept
FROM b
"""

#: Windows of the items and of the documents are compared as lists of words, without fingerprints.
OP2 = rf"""
WITH d AS (SELECT doc_id, {_MATCH} AS w FROM documents),
i AS (SELECT item_id, {_MATCH} AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, least(len(w), 13) AS t, w[p:p + least(len(w), 13) - 1] AS g
       FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 12, 1))) AS p FROM i WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT t FROM iw),
dw AS (SELECT doc_id, t, p, w[p:p + t - 1] AS g FROM (SELECT doc_id, t, w, unnest(generate_series(1, len(w) - t + 1)) AS p FROM d, lengths WHERE len(w) >= t)),
m AS (SELECT DISTINCT doc_id, p, t, item_id FROM dw JOIN iw USING (t, g)),
h AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(generate_series(p, p + t - 1)) AS q FROM (SELECT DISTINCT doc_id, p, t FROM m)) GROUP BY doc_id),
s AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM m) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN s USING (doc_id)
"""

OP10 = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
e AS (SELECT *, regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g') AS esc FROM t),
o AS (SELECT conv_id, role, row_number() OVER w - 1 AS k, lag(role) OVER w AS before FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)),
x AS (SELECT conv_id, min(k) FILTER (NOT CASE WHEN k = 0 THEN role IN ('system', 'user') ELSE (before = 'system' AND role = 'user') OR (before = 'user' AND role = 'assistant')
             OR (before = 'assistant' AND role = 'user') END) AS wrong, count(*) AS n, arg_max(role, k) AS final FROM o GROUP BY conv_id),
v AS (SELECT conv_id, CASE WHEN wrong IS NOT NULL THEN wrong WHEN final <> 'assistant' THEN n END AS error_turn FROM x)
SELECT e.conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(role) + length(esc) + length('<|im_start|>') + 1 + length('<|im_end|>') + 1) AS BIGINT) AS formatted_chars,
       any_value(error_turn) IS NULL AS valid, CAST(any_value(error_turn) AS BIGINT) AS error_turn
FROM e LEFT JOIN v ON v.conv_id IS NOT DISTINCT FROM e.conv_id GROUP BY e.conv_id
"""

#: CRC-32 of lists of byte values, without a built-in for it: the table of the reflected polynomial, then one step per byte.
_CRC_TABLE = """(SELECT list(v ORDER BY b) FROM (SELECT b, list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z:
       CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS v FROM (SELECT unnest(generate_series(0, 255))::BIGINT AS b)))"""


def _crc(byte_list: str) -> str:
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {byte_list}), lambda c, x: xor(c // 256, crc_table[xor(c % 256, x) + 1])), 4294967295)"


#: The characters of a run and of an id have at most two bytes.
_RUN_BYTES = "flatten(list_transform(string_split(s, ''), lambda ch: CASE WHEN ord(ch) < 128 THEN [ord(ch)::BIGINT] ELSE [195::BIGINT, ord(ch) - 64] END))"

#: Near words share a string with one code point deleted: of both at the same place (replaced), or of the longer one (inserted).
OP11 = rf"""
WITH RECURSIVE t AS MATERIALIZED (SELECT {_CRC_TABLE} AS crc_table),
runs AS (SELECT doc_id, run, count(*) AS k FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents) GROUP BY ALL),
hashed AS (SELECT run, k, {_crc(_RUN_BYTES)} AS h FROM (SELECT run, k, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS s FROM runs), t),
spelt AS (SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word, k FROM hashed),
w AS MATERIALIZED (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM spelt GROUP BY word HAVING length(word) >= 5 AND sum(k) >= 3),
cut AS MATERIALIZED (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS short FROM (SELECT word, n, unnest(generate_series(1, length(word))) AS i FROM w)),
near AS (SELECT a.word, b.word AS other, b.n FROM cut a JOIN cut b USING (i, short) WHERE a.word <> b.word
         UNION SELECT a.word, b.word, b.n FROM cut a JOIN w b ON a.short = b.word
         UNION SELECT b.word, a.word, a.n FROM cut a JOIN w b ON a.short = b.word),
best AS (SELECT word, count(*) AS n_near, max(n) AS top FROM near GROUP BY word),
pick AS (SELECT word, n_near, top, min(other) AS other FROM best JOIN near USING (word) WHERE near.n = top GROUP BY ALL),
f AS MATERIALIZED (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN top >= 2 * w.n THEN other END AS form, CASE WHEN top >= 2 * w.n THEN top END AS form_n
      FROM w LEFT JOIN pick USING (word)),
up AS (SELECT word, word AS root FROM f UNION ALL SELECT up.word, f.form FROM up JOIN f ON up.root = f.word WHERE f.form IS NOT NULL),
last AS (SELECT up.word, up.root FROM up JOIN f ON up.root = f.word WHERE f.form IS NULL)
SELECT f.word, form, root, n, n_near, form_n FROM f JOIN last USING (word)
"""

#: Slots in turn by falling bytes, as one fold over the list of the slots that hold bytes (the others have none to place).
OP13 = rf"""
WITH t AS MATERIALIZED (SELECT {_CRC_TABLE} AS crc_table),
d AS MATERIALIZED (SELECT doc_id, octet_length(encode(s)) + 8 AS size, {_crc("list_transform(generate_series(1, octet_length(encode(s))), lambda i: CAST('0x' || substr(hex, 2 * i - 1, 2) AS BIGINT))")} AS crc
      FROM (SELECT doc_id, coalesce(text, '') AS s, hex(encode(coalesce(text, ''))) AS hex FROM documents), t),
r AS MATERIALIZED (SELECT *, CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || size || ':' || crc || ':' || copy // 256), 1, 8)) AS BIGINT) % 8192 AS v FROM
      (SELECT *, row_number() OVER (PARTITION BY doc_id, size, crc) - 1 AS copy FROM d)),
slots AS (SELECT v, v % 24 AS shard, sum(size)::BIGINT AS bytes FROM r GROUP BY v),
one AS (SELECT list({{'v': v, 'shard': shard, 'bytes': bytes}} ORDER BY bytes DESC, v) AS l, ceil(sum(bytes) / 24) AS share FROM slots),
steps AS (SELECT l, share, list_reduce(list_transform(l, lambda x: {{'used': list_value({', '.join(['0::BIGINT'] * 24)}), 'to': CAST([] AS BIGINT[]), 'shard': x.shard, 'bytes': x.bytes}}),
       lambda a, x: {{'used': list_transform(a.used, lambda u, i: u + CASE WHEN i = (CASE WHEN a.used[x.shard + 1] + x.bytes <= share THEN x.shard + 1 ELSE list_position(a.used, list_min(a.used)) END) THEN x.bytes ELSE 0 END),
       'to': list_append(a.to, CASE WHEN a.used[x.shard + 1] + x.bytes <= share THEN x.shard ELSE list_position(a.used, list_min(a.used)) - 1 END), 'shard': 0::BIGINT, 'bytes': 0::BIGINT}},
       {{'used': list_value({', '.join(['0::BIGINT'] * 24)}), 'to': CAST([] AS BIGINT[]), 'shard': 0::BIGINT, 'bytes': 0::BIGINT}}) AS s FROM one),
m AS (SELECT unnest(list_transform(l, lambda x: x.v)) AS v, unnest(s.to) AS shard FROM steps)
SELECT doc_id, size, crc AS text_crc32, 'bytes' AS law, CAST(shard AS INTEGER) AS shard, row_number() OVER (PARTITION BY shard ORDER BY v, doc_id NULLS FIRST, crc, size, copy) - 1 AS slot,
       CAST(NULL AS INTEGER) AS grown_shard, CAST(v AS INTEGER) AS virtual_slot, CAST(2 AS INTEGER) AS map_version
FROM r JOIN m USING (v)
"""

SQL = {"op1_quality_rules": OP1, "op2_decontamination": OP2, "op10_chat_format": OP10, "op11_spelling_variants": OP11, "op13_sharding": OP13}
