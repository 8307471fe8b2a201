"""What op11 and op13 must return, as DuckDB SQL. It has no CRC-32, so that is spelled out: eight
steps per byte, as one list of bytes with seven zeros behind each."""

from __future__ import annotations


def crc32(text: str) -> str:
    """SQL for the unsigned CRC-32 of a text's UTF-8 bytes."""
    size = f"(octet_length(encode({text})))"
    byte = f"CAST('0x' || substr(hex(encode({text})), (2 * (i // 8) + 1)::BIGINT, 2) AS BIGINT)"
    steps = f"list_transform(range(0, 8 * {size}), lambda i: CASE WHEN i % 8 = 0 THEN {byte} ELSE 0 END)"
    step = "xor(xor(a, e) >> 1, (xor(a, e) & 1) * 3988292384)"
    return f"xor(list_reduce(list_prepend(4294967295, {steps}), lambda a, e: {step}), 4294967295)"


TRIE = f"""
    WITH RECURSIVE turns AS (
        SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
               row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(coalesce(text, ''))) AS place
        FROM conversations WHERE conv_id IS NOT NULL
    ), convs AS (
        SELECT conv_id, {crc32("conv_id::VARCHAR")} % 9 AS h FROM (SELECT DISTINCT conv_id FROM turns)
    ), taken AS (
        SELECT c.conv_id, t.place, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id - c.conv_id % 5 AND t.place <= c.h
        UNION ALL
        SELECT c.conv_id, t.place, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.place > c.h
    ), placed AS (
        SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY place) AS depth,
               sha256(octet_length(encode(role)) || ':' || role || text) AS said, octet_length(encode(text)) AS bytes
        FROM taken
    ), named AS (
        SELECT conv_id, 0::BIGINT AS depth, '' AS name, 0 AS bytes FROM convs
        UNION ALL
        SELECT n.conv_id, p.depth, sha256(n.name || p.said), p.bytes FROM named n JOIN placed p ON p.conv_id = n.conv_id AND p.depth = n.depth + 1
    ), held AS (
        SELECT *, depth = max(depth) OVER (PARTITION BY conv_id) AS is_end, lag(name) OVER (PARTITION BY conv_id ORDER BY depth) AS above FROM named
    ), nodes AS (
        SELECT name, any_value(above) AS above, min(conv_id) AS conv_id, any_value(depth) AS depth, count(*) AS n_convs, any_value(bytes) AS bytes,
               sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE is_end), '')) AS ends_sha256
        FROM held GROUP BY name
    ), kids AS (
        SELECT above, count(*) AS n_children FROM nodes WHERE above IS NOT NULL GROUP BY above
    ), below AS (
        SELECT DISTINCT u.name, v.name AS inner_name FROM held u JOIN held v ON v.conv_id = u.conv_id AND v.depth >= u.depth
    ), sums AS (
        SELECT b.name, count(*) FILTER (WHERE k.above IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.bytes)::BIGINT AS saved_tokens
        FROM below b JOIN nodes n ON n.name = b.inner_name LEFT JOIN kids k ON k.above = b.inner_name GROUP BY b.name
    )
    SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children, s.n_leaves, s.saved_tokens, n.ends_sha256
    FROM nodes n JOIN sums s ON s.name = n.name LEFT JOIN kids k ON k.above = n.name LEFT JOIN nodes p ON p.name = n.above
"""

VARIANTS = f"""
    WITH RECURSIVE runs AS (
        SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
        FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents)
    ), each_run AS (
        SELECT doc_id, run, count(*) AS times FROM runs GROUP BY ALL
    ), hashed AS (
        SELECT run, times, {crc32("coalesce(doc_id::VARCHAR, '') || ':' || run")} AS h FROM each_run
    ), words AS (
        SELECT word, sum(times)::BIGINT AS n
        FROM (SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, times FROM hashed)
        WHERE length(word) >= 5 GROUP BY word HAVING sum(times) >= 3
    ), shorter AS (
        SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS part FROM words, unnest(range(1, length(word) + 1)) AS t(i)
    ), shares AS (
        SELECT a.word AS word, b.word AS near FROM shorter a JOIN shorter b ON a.part = b.part AND a.i = b.i AND a.word != b.word
        UNION
        SELECT word, part FROM shorter
        UNION
        SELECT part, word FROM shorter
    ), near AS (
        SELECT s.word, s.near, a.n, b.n AS near_n FROM shares s JOIN words a ON a.word = s.word JOIN words b ON b.word = s.near
    ), best AS (
        SELECT *, row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) AS place, count(*) OVER (PARTITION BY word) AS n_near FROM near
    ), forms AS (
        SELECT word, n_near, CASE WHEN near_n >= 2 * n THEN near END AS form, CASE WHEN near_n >= 2 * n THEN near_n END AS form_n FROM best WHERE place = 1
    ), chain AS (
        SELECT word, word AS reached, 0 AS step FROM words
        UNION ALL
        SELECT c.word, f.form, c.step + 1 FROM chain c JOIN forms f ON f.word = c.reached WHERE f.form IS NOT NULL
    ), ends AS (
        SELECT word, arg_max(reached, step) AS root FROM chain GROUP BY word
    )
    SELECT w.word, f.form, e.root, w.n, coalesce(f.n_near, 0) AS n_near, f.form_n
    FROM words w JOIN ends e ON e.word = w.word LEFT JOIN forms f ON f.word = w.word
"""
