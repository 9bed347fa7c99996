"""The queries of this package that SQL can express, as SQL."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

ORACLES["op1_mtree_top_k"] = """
WITH wide AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings WHERE vec_id IS NOT NULL
), whole AS (
    SELECT vec_id, list_transform(v, lambda x: floor(x * 1024)) AS w FROM wide
    WHERE v IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.w, c.w) AS BIGINT) AS score
    FROM whole q JOIN whole c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
), ranked AS (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
        vec_id, score
    FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""

# Control strings with any number of backslashes behind their first character gain one character each.
ORACLES["op9_chat_format"] = r"""
WITH said AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), turns AS (
    SELECT *, len(text) + len(regexp_extract_all(text,
        '[<\[]\\*(?:s>|/s>|INST\]|/INST\]|<SYS>>|</SYS>>|\|role\|>|\|says\|>)')) AS escaped
    FROM said
)
SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role)) AS turns_sha256,
    CAST(coalesce(sum(len(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(escaped + CASE role WHEN 'user' THEN 13 WHEN 'assistant' THEN 7 WHEN 'system' THEN 15
        ELSE 20 + len(role) END) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""

ORACLES["op10_warc_archives"] = """
WITH sums AS (
    SELECT page_id, url, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
), bits AS (
    SELECT page_id, url, payload_bytes, min(page_id) OVER (PARTITION BY hex, payload_bytes) AS first,
        CAST(CAST(unhex(hex) AS BIT) AS VARCHAR) AS bits
    FROM sums
), coded AS (
    SELECT page_id, url, payload_bytes, first, list_aggregate(list_transform(range(0, 32), lambda i: substring(
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        1 + CAST(16 * CAST(substring(bits, 5 * i + 1, 1) AS INTEGER) + 8 * CAST(substring(bits, 5 * i + 2, 1) AS INTEGER)
            + 4 * CAST(substring(bits, 5 * i + 3, 1) AS INTEGER) + 2 * CAST(substring(bits, 5 * i + 4, 1) AS INTEGER)
            + CAST(substring(bits, 5 * i + 5, 1) AS INTEGER) AS BIGINT), 1)), 'string_agg', '') AS payload_digest
    FROM bits
)
SELECT page_id, url, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
    CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> first THEN first END AS refers_to
FROM coded
"""

# The checksum takes a byte, then eight shifts, written as -1.
ORACLES["op11_prefix_trie"] = r"""
WITH said AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
        PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(
            strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS seq
    FROM conversations WHERE conv_id IS NOT NULL
), own AS (
    SELECT conv_id, count(*) AS turns, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
        string_split(conv_id::VARCHAR, ''), lambda c: [ord(c), -1, -1, -1, -1, -1, -1, -1, -1]::BIGINT[]))),
        lambda crc, b: CASE WHEN b >= 0 THEN xor(crc, b) WHEN crc & 1 = 1 THEN xor(crc >> 1, 3988292384) ELSE crc >> 1 END
    ) AS crc
    FROM said GROUP BY conv_id
), plans AS (
    SELECT conv_id, turns, xor(crc, 4294967295) % 9 AS h, conv_id - conv_id % 5 AS base FROM own
), borrowed AS (
    SELECT p.conv_id, seq + 1 AS depth, role, text FROM plans p JOIN said s ON s.conv_id = p.base AND s.seq < p.h
), taken AS (
    SELECT conv_id, count(*) AS m FROM borrowed GROUP BY conv_id
), rebuilt AS (
    FROM borrowed UNION ALL
    SELECT s.conv_id, coalesce(m, 0) + seq - h + 1, role, text
    FROM said s JOIN plans USING (conv_id) LEFT JOIN taken USING (conv_id) WHERE seq >= h
), whole AS (
    SELECT conv_id, coalesce(list({'role': role, 'text': text} ORDER BY depth) FILTER (depth IS NOT NULL), []) AS turns
    FROM own LEFT JOIN (SELECT * FROM rebuilt) USING (conv_id) GROUP BY conv_id
), members AS (
    SELECT conv_id, turns[:d] AS node, d AS depth, d = len(turns) AS ends FROM whole, unnest(range(len(turns) + 1)) AS u(d)
), nodes AS (
    SELECT node, depth, count(*) AS n_convs, min(conv_id) AS conv_id,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
    FROM members GROUP BY node, depth
), children AS (
    SELECT node[:depth - 1] AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1
), leaves AS (
    SELECT n.*, coalesce(n_children, 0) AS n_children, (n_convs - 1) * coalesce(strlen(n.node[n.depth].text), 0) AS saved
    FROM nodes n LEFT JOIN children USING (node)
), totals AS (
    SELECT node[:d] AS node, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved_tokens
    FROM leaves, unnest(range(depth + 1)) AS u(d) GROUP BY 1
)
SELECT l.conv_id, CAST(l.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, l.n_convs, l.n_children, n_leaves,
    CAST(saved_tokens AS BIGINT) AS saved_tokens, l.ends_sha256
FROM leaves l JOIN totals USING (node) LEFT JOIN nodes p ON l.depth > 0 AND p.node = l.node[:l.depth - 1]
"""

ORACLES["op12_collocations"] = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), spoken AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces
), totals AS (
    SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM spoken GROUP BY lang
), counts AS (
    SELECT lang, words[i:i + k - 1] AS phrase, count(*) AS a
    FROM (SELECT lang, words, k, unnest(range(1, len(words) - k + 2)) AS i FROM spoken, unnest(range(1, 6)) AS u(k))
    GROUP BY 1, 2 HAVING count(*) >= 100
), longer AS (
    SELECT lang, phrase, max(a) AS held FROM (
        SELECT lang, a, unnest([phrase[:len(phrase) - 1], phrase[2:]]) AS phrase FROM counts WHERE len(phrase) > 2
    ) GROUP BY 1, 2
), cuts AS (
    SELECT c.lang, c.phrase, c.a, unnest(range(1, len(c.phrase))) AS k
    FROM counts c LEFT JOIN longer l ON c.lang = l.lang AND c.phrase = l.phrase
    WHERE len(c.phrase) > 1 AND (held IS NULL OR held < a)
), scored AS (
    SELECT c.lang, c.phrase, c.a, c.k, l.a AS l, r.a AS r, n,
        (1000::HUGEINT * c.a * n) // (l.a::HUGEINT * r.a) AS score
    FROM cuts c JOIN totals t ON t.lang = c.lang JOIN counts l ON l.lang = c.lang AND l.phrase = c.phrase[:c.k]
    JOIN counts r ON r.lang = c.lang AND r.phrase = c.phrase[c.k + 1:]
), lowest AS (
    SELECT lang, array_to_string(phrase, ' ') AS phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM scored
    QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM lowest QUALIFY rank <= 2000
"""

ORACLES["op13_decontamination"] = r"""
WITH texts AS (
    SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM documents
), items AS (
    SELECT item_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM benchmark
), sized AS (
    SELECT item_id, words, least(10, len(words)) AS w FROM items WHERE len(words) > 0
), windows AS (
    SELECT DISTINCT item_id, w, array_to_string(words[i:i + w - 1], ' ') AS said
    FROM sized, unnest(range(1, len(words) - w + 2)) AS u(i)
), places AS (
    SELECT row, w, i, array_to_string(words[i:i + w - 1], ' ') AS said
    FROM texts, (SELECT DISTINCT w FROM sized), unnest(range(1, len(words) - w + 2)) AS u(i)
), met AS (
    SELECT row, i, w, item_id FROM places JOIN windows USING (w, said)
), hits AS (
    SELECT row, count(DISTINCT place) AS n_hit FROM (SELECT row, unnest(range(i, i + w)) AS place FROM met) GROUP BY row
), named AS (
    SELECT row, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS item_ids
    FROM (SELECT DISTINCT row, coalesce(item_id::VARCHAR, '') AS item_id FROM met) GROUP BY row
)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(item_ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM texts LEFT JOIN hits USING (row) LEFT JOIN named USING (row)
"""
