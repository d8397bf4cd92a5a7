"""SQL for the queries that SQL can express."""

ORACLE: dict[str, str] = {}

ORACLE["op2_warc"] = r"""
WITH given AS (
    SELECT page_id, encode(coalesce(html, '')) AS body FROM pages
), named AS (
    SELECT page_id, octet_length(body) AS n, sha1(body) AS hex,
           max(page_id) OVER (PARTITION BY body) AS largest
    FROM given
), digits AS (
    SELECT *, list_transform(range(8), lambda g: ('0x' || substr(hex, CAST(5 * g + 1 AS INT), 5))::BIGINT) AS quads
    FROM named
)
SELECT page_id,
       CAST(n AS BIGINT) AS payload_bytes,
       list_aggregate(list_transform(range(32), lambda i:
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                  CAST(1 + ((quads[CAST(i // 4 + 1 AS INT)] >> CAST(15 - 5 * (i % 4) AS INT)) & 31) AS INT), 1)),
           'string_agg', '') AS payload_digest,
       CASE WHEN page_id = largest THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> largest THEN largest END AS refers_to,
       CAST(NULL AS VARCHAR) AS error
FROM digits
"""

ORACLE["op4_line_dedup"] = r"""
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS place
    FROM documents
), keyed AS (
    SELECT doc_id, place, line,
           translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines
), common AS (
    SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10
), marked AS (
    SELECT doc_id, place, line, key IN (SELECT key FROM common) AS gone FROM keyed
)
SELECT doc_id,
       count(*) AS n_lines,
       count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

ORACLE["op9_chat_format"] = r"""
WITH given AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), sized AS (
    SELECT *,
           strpos(text, '\') + strpos(text, '###') + strpos(text, '</turn>') > 0
           OR strpos(role, '\') + strpos(role, '###') + strpos(role, '</turn>') + strpos(role, ': ') > 0 AS odd,
           length(replace(replace(replace(text, '\', '\\'), '###', '\###'), '</turn>', '<\/turn>')) AS long_text,
           length(replace(replace(replace(replace(role, '\', '\\'), '###', '\###'), '</turn>', '<\/turn>'), ': ', ':\ ')) AS long_role
    FROM given
)
SELECT conv_id,
       count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(14 + CASE WHEN odd THEN long_text + long_role ELSE length(text) + length(role) END) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""
