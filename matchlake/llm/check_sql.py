"""The same questions as SQL for DuckDB, where SQL can ask them over the whole tables in reasonable time."""

from __future__ import annotations

OP2 = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), placed AS (
    SELECT *, lag(role) OVER w IS DISTINCT FROM role AS opens,
           regexp_replace(role, '([<\[])([|/sSI\\])', '\1\\\2', 'g') AS safe_role,
           regexp_replace(text, '([<\[])([|/sSI\\])', '\1\\\2', 'g') AS safe_text
    FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id,
       count(*) AS n_turns,
       count(*) FILTER (opens) AS n_blocks,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       coalesce(sum(length(safe_text)) FILTER (role = 'assistant'), 0)::BIGINT AS mask_chars,
       sum(length(safe_text) + CASE WHEN opens THEN 9 + length(safe_role) + 11 + 8 ELSE 8 END)::BIGINT AS formatted_chars
FROM placed GROUP BY conv_id
"""

OP3 = r"""
WITH sizes AS (
    SELECT source, coalesce(sum(length(text)), 0)::BIGINT AS source_chars FROM documents GROUP BY source
), weighted AS (
    SELECT *, CASE WHEN source_chars > 0 THEN pow(source_chars::DOUBLE, 0.5) ELSE 0.0 END AS weight FROM sizes
), totals AS (
    SELECT sum(weight) AS all_weight, sum(source_chars) AS all_chars FROM weighted WHERE weight > 0
), rates AS (
    SELECT source, 1.0::DOUBLE * all_chars * weight / all_weight / source_chars AS rate FROM weighted, totals WHERE weight > 0
), steps AS (
    SELECT rate, sum(exp(k * ln(rate) - rate - logs)) OVER (PARTITION BY rate ORDER BY k) AS upto
    FROM (
        SELECT rate, k, sum(CASE WHEN k > 0 THEN ln(k::DOUBLE) ELSE 0.0 END) OVER (PARTITION BY rate ORDER BY k) AS logs
        FROM (SELECT DISTINCT rate FROM rates), LATERAL (SELECT unnest(range(0, ceil(rate + 12 * sqrt(rate) + 30)::BIGINT + 1)) AS k)
    )
), drawn AS (
    SELECT d.*, r.rate,
           ('0x' || substr(md5(coalesce(d.doc_id::VARCHAR, '') || ':17'), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS draw
    FROM documents d JOIN rates r ON d.source IS NOT DISTINCT FROM r.source
), counted AS (
    SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars,
           (SELECT count(*) FROM steps s WHERE s.rate = d.rate AND s.upto <= d.draw)::INTEGER AS copies
    FROM drawn d
)
SELECT *, md5(coalesce(doc_id::VARCHAR, '') || ':' || copy || ':order 17') AS shuffle_key
FROM (SELECT *, unnest(range(1, copies + 1))::INTEGER AS copy FROM counted WHERE copies > 0)
"""

OP13 = r"""
WITH placed AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
    FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
    SELECT conv_id, conv_id - conv_id % 100 AS base,
           xor(4294967295::BIGINT, list_reduce(
               list_concat([4294967295::BIGINT], list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
               lambda sum, byte: list_reduce(
                   list_concat([xor(sum, byte)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                   lambda bits, step: CASE WHEN bits & 1 = 1 THEN xor(bits >> 1, 3988292384::BIGINT) ELSE bits >> 1 END
               )
           )) % 6 AS h
    FROM (SELECT DISTINCT conv_id FROM placed)
), pieces AS (
    SELECT c.conv_id, p.place, p.role, p.text FROM convs c JOIN placed p ON p.conv_id = c.base AND p.place <= c.h
    UNION ALL SELECT c.conv_id, p.place, p.role, p.text FROM convs c JOIN placed p ON p.conv_id = c.conv_id AND p.place > c.h
), turns AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY place) AS depth, length(text) AS chars,
           sha256(length(role) || ':' || role || text) AS digest
    FROM pieces
), prefixes AS (
    SELECT conv_id, depth, chars, sha256(string_agg(digest, '') OVER (PARTITION BY conv_id ORDER BY depth)) AS node FROM turns
    UNION ALL SELECT conv_id, 0, 0, '' FROM convs
), linked AS (
    SELECT *, lag(node) OVER w AS parent, list(node) OVER w AS line, lead(node) OVER w IS NULL AS last
    FROM prefixes WINDOW w AS (PARTITION BY conv_id ORDER BY depth)
), nodes AS (
    SELECT node, any_value(depth) AS depth, any_value(chars) AS chars, any_value(parent) AS parent, any_value(line) AS line,
           min(conv_id) AS conv_id, count(*) AS n_convs,
           sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (last), '')) AS ends_sha256
    FROM linked GROUP BY node
), families AS (
    SELECT parent AS node, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent
), below AS (
    SELECT top AS node, count(*) FILTER (f.n_children IS NULL) AS n_leaves, sum((n_convs - 1) * chars) AS saved_tokens
    FROM (SELECT node, n_convs, chars, unnest(line) AS top FROM nodes) LEFT JOIN families f USING (node) GROUP BY top
)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs::BIGINT AS n_convs,
       coalesce(f.n_children, 0)::BIGINT AS n_children, b.n_leaves::BIGINT AS n_leaves, b.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN below b USING (node) LEFT JOIN families f USING (node) LEFT JOIN nodes p ON p.node = n.parent
"""

CHECK_SQL = {"op2_chat_format": OP2, "op3_source_mix": OP3, "op13_prefix_trie": OP13}
