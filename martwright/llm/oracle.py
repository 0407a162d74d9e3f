"""DuckDB SQL for the registered queries that SQL can express."""

SPACE = r"[\x20\x09-\x0D]+"

ORACLE = {
    "op4_quality_ledger": rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '{SPACE}'), lambda w: w <> '') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
windows AS (
  SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS win
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM d)),
repeated AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n FROM windows) WHERE n > 1),
covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM repeated, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id),
m AS (
  SELECT d.doc_id, len(words)::BIGINT AS n_words,
         length(array_to_string(words, ''))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(covered.n, 0)::BIGINT AS n_repeat_words, len(lines)::BIGINT AS n_lines
  FROM d LEFT JOIN covered ON covered.doc_id = d.doc_id),
bits AS (
  SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END + CASE WHEN 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END
    + CASE WHEN word_chars < 3 * n_words THEN 16 ELSE 0 END + CASE WHEN word_chars > 12 * n_words THEN 32 ELSE 0 END)::BIGINT AS failed_bits
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed_bits & 3 <> 0 AS base_failed,
       failed_bits = 0 AS kept, failed_bits
FROM bits""",
    "op5_warc_salvage": """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, sha1(payload) AS h,
             min(page_id) OVER (PARTITION BY payload) AS first FROM p),
g AS (SELECT *, list_transform([0, 1, 2, 3], lambda i: ('0x' || substr(h, 1 + 10 * i, 10))::BIGINT) AS parts FROM d)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(parts, lambda v: array_to_string(list_transform([35, 30, 25, 20, 15, 10, 5, 0],
         lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v >> s) & 31)::INT + 1, 1)), '')), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM g""",
    "op6_line_dedup": r"""
WITH lines AS (
  SELECT doc_id, i, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS i
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))),
common AS (
  SELECT key FROM lines WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(common.key)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE common.key IS NULL), '')) AS kept_sha256
FROM lines LEFT JOIN common ON lines.key = common.key
GROUP BY doc_id""",
    "op10_substring_dedup": rf"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '{SPACE}'), lambda w: w <> '') AS words FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(words[i : i + 19], ' ') AS win
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS i FROM d)),
late AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY win ORDER BY doc_id, i) AS n FROM windows) WHERE n > 1),
gone AS (
  SELECT DISTINCT doc_id, i + k AS i FROM late, (SELECT unnest(range(0, 20)) AS k)),
w AS (
  SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM d)
SELECT d.doc_id, len(any_value(d.words))::BIGINT AS n_words, count(gone.i)::BIGINT AS n_removed,
       sha256(coalesce(string_agg(w.word, ' ' ORDER BY w.i) FILTER (WHERE gone.i IS NULL), '')) AS kept_sha256
FROM d LEFT JOIN w ON w.doc_id = d.doc_id LEFT JOIN gone ON gone.doc_id = w.doc_id AND gone.i = w.i
GROUP BY d.doc_id""",
    "op11_hard_negatives": """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same, list_inner_product(a.v, r.v)::BIGINT AS score
  FROM r a JOIN r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id),
p AS (
  SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.id AS positive_id, (row_number() OVER w)::INT AS rank, n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON n.anchor_id = p.anchor_id AND NOT n.same AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
WINDOW w AS (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id) QUALIFY row_number() OVER w <= 5""",
    "op13_prefix_trie": """
WITH o AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base,
         xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
           lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], range(8)), lambda s, i: xor(s >> 1, 3988292384 * (s & 1)))), 4294967295) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM o)),
rebuilt AS (
  SELECT c.conv_id, 0 AS part, o.pos, role, text FROM c JOIN o ON o.conv_id = c.base AND o.pos <= c.h
  UNION ALL SELECT c.conv_id, 1, o.pos, role, text FROM c JOIN o ON o.conv_id = c.conv_id AND o.pos > c.h),
turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, pos) AS depth, octet_length(encode(text)) AS bytes,
         sha256(octet_length(encode(role)) || ':' || role || text) AS digest
  FROM rebuilt),
path AS (
  SELECT conv_id, depth, bytes, sha256(string_agg(digest, '') OVER (PARTITION BY conv_id ORDER BY depth)) AS node FROM turns
  UNION ALL SELECT conv_id, 0, 0, '' FROM c),
steps AS (
  SELECT *, lag(node) OVER (PARTITION BY conv_id ORDER BY depth) AS parent,
         depth = max(depth) OVER (PARTITION BY conv_id) AS ends FROM path),
nodes AS (
  SELECT node, any_value(depth) AS depth, any_value(parent) AS parent, any_value(bytes) AS bytes, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM steps GROUP BY node),
children AS (SELECT parent, count(*) AS n FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
under AS (SELECT DISTINCT a.node AS top, b.node FROM steps a JOIN steps b ON a.conv_id = b.conv_id AND b.depth >= a.depth),
sums AS (
  SELECT top, sum(CASE WHEN children.n IS NULL THEN 1 ELSE 0 END)::BIGINT AS n_leaves, sum((nodes.n_convs - 1) * nodes.bytes)::BIGINT AS saved_tokens
  FROM under JOIN nodes ON nodes.node = under.node LEFT JOIN children ON children.parent = under.node GROUP BY top)
SELECT nodes.conv_id, nodes.depth::BIGINT AS depth, up.conv_id AS parent_conv_id, nodes.n_convs::BIGINT AS n_convs,
       coalesce(children.n, 0)::BIGINT AS n_children, n_leaves, saved_tokens, nodes.ends_sha256
FROM nodes JOIN sums ON sums.top = nodes.node LEFT JOIN children ON children.parent = nodes.node LEFT JOIN nodes up ON up.node = nodes.parent""",
}
