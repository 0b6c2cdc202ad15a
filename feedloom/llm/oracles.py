"""DuckDB SQL of the queries that SQL can express on whole tables."""

# CRC-32 of a list of byte values, bit by bit.
CRC32 = """xor(list_reduce(
    list_concat([4294967295::UBIGINT], flatten(list_transform({bytes}, lambda b: [b, 0, 0, 0, 0, 0, 0, 0]))),
    lambda c, x: xor(xor(c, x) >> 1, 3988292384::UBIGINT * (xor(c, x) & 1))), 4294967295::UBIGINT)"""


def crc32(bytes_sql: str) -> str:
    return CRC32.format(bytes=bytes_sql)


ORACLES: dict[str, str] = {
    "op7_content_addressed_warc": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS n,
                   min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first
            FROM pages
        )
        SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha256(html) AS payload_digest,
               CASE WHEN n >= 100 AND first IS NOT NULL AND page_id IS DISTINCT FROM first
                    THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN n >= 100 AND page_id IS DISTINCT FROM first THEN first END AS refers_to
        FROM p
    """,
    "op11_conversation_repair": f"""
        WITH RECURSIVE damaged AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   {crc32("list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ascii(x)::UBIGINT)")} % 20 AS d
            FROM conversations
        ), given AS (
            SELECT conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role,
                   CASE d WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
                   unnest(range(CASE d WHEN 3 THEN 2 ELSE 1 END)) AS copy
            FROM damaged WHERE d <> 0
        ), placed AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS i,
                   left(role, 1) AS ini, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS said
            FROM given
        ), judged AS (
            SELECT *, CASE WHEN said = '' THEN 1
                           WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 2
                           WHEN right(said, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault,
                   lead(ini) OVER (PARTITION BY conv_id ORDER BY i) AS next,
                   lead(i) OVER (PARTITION BY conv_id ORDER BY i) AS next_i
            FROM placed
        ), due(s, t, who) AS (VALUES (0, 2, 'user'), (1, 2, 'user'), (2, 3, 'assistant'), (3, 2, 'user')
        ), inserted AS (
            SELECT s, s AS p, 0 AS c, '' AS l, []::VARCHAR[] AS x FROM due
            UNION ALL SELECT s, t, 5, 'I', [who || ':'] FROM due
            UNION ALL SELECT a.s, b.t, 10, 'II', [a.who || ':', b.who || ':'] FROM due a JOIN due b ON a.t = b.s
        ), keep(p, ini, t) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)
        ), ways AS (
            SELECT conv_id, i, s, n.p AS t, c + 2 AS c, l || 'D' AS l, x FROM judged, inserted n
            UNION ALL
            SELECT conv_id, i, s, k.t, c + 5 * (fault = 3)::INT, l || 'K', list_append(x, role || ':' || text)
            FROM judged j JOIN keep k USING (ini) JOIN inserted n ON n.p = k.p WHERE fault IN (0, 3)
            UNION ALL
            SELECT conv_id, i, n.s, d.t, c + 1 + 5 * (fault = 3)::INT, l || 'R', list_append(x, who || ':' || text)
            FROM judged j, inserted n JOIN due d ON d.s = n.p WHERE fault IN (0, 3)
        ), walk AS (
            SELECT DISTINCT conv_id, 0::BIGINT AS i, 0 AS s, {{'c': 0::BIGINT, 'a': '', 'x': []::VARCHAR[]}} AS best FROM given
            UNION ALL
            SELECT w.conv_id, w.i + 1, t, min({{'c': (best.c + c)::BIGINT, 'a': best.a || l, 'x': list_concat(best.x, x)}})
            FROM walk w JOIN ways y ON w.conv_id IS NOT DISTINCT FROM y.conv_id AND y.i = w.i + 1 AND y.s = w.s
            GROUP BY w.conv_id, w.i, t
        ), counts AS (
            SELECT conv_id, max(i) AS n,
                   coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                   count_if(fault = 1) AS blank, count_if(fault = 2) AS duplicate, count_if(fault = 3) AS truncated,
                   count_if(next_i IS NOT NULL AND ini || next NOT IN ('su', 'ua', 'au')) AS illegal
            FROM judged GROUP BY conv_id
        ), solved AS (
            SELECT w.conv_id, min({{'c': best.c + n.c, 'a': best.a || l, 'x': list_concat(best.x, n.x)}}) AS best
            FROM walk w JOIN counts k ON w.conv_id IS NOT DISTINCT FROM k.conv_id AND w.i = k.n
            JOIN inserted n ON n.s = w.s AND n.p IN (0, 3)
            GROUP BY w.conv_id
        )
        SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
               coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
               coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.c, 0)::BIGINT AS cost, coalesce(best.a, '') AS audit,
               sha256(coalesce(array_to_string(best.x, chr(10)), '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) o
        LEFT JOIN counts k ON o.conv_id IS NOT DISTINCT FROM k.conv_id
        LEFT JOIN solved v ON o.conv_id IS NOT DISTINCT FROM v.conv_id
    """,
    "op12_spelling_variants": f"""
        WITH RECURSIVE runs AS (
            SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents
        ), lowered AS (
            SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
            FROM runs GROUP BY ALL
        ), digits AS (
            SELECT *, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS hx FROM lowered
        ), summed AS (
            SELECT *, {crc32("list_transform(range(length(hx) // 2), lambda i: ('0x' || substr(hx, (2 * i + 1)::INT, 2))::UBIGINT)")} AS h
            FROM digits
        ), words AS (
            SELECT CASE WHEN h % 199 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2)
                        ELSE run END AS word, sum(n)::BIGINT AS n
            FROM summed GROUP BY 1 HAVING length(word) >= 6 AND sum(n) >= 5
        ), shorter AS (
            SELECT word, i, length(word) AS size, left(word, i::INT) || substr(word, i::INT + 2) AS rest
            FROM (SELECT word, unnest(range(length(word))) AS i FROM words)
        ), near AS (
            SELECT a.word, b.word AS other FROM shorter a JOIN shorter b USING (size, i, rest) WHERE a.word <> b.word
            UNION SELECT a.word, w.word FROM shorter a JOIN words w ON w.word = a.rest
            UNION SELECT w.word, a.word FROM shorter a JOIN words w ON w.word = a.rest
        ), best AS (
            SELECT near.word, count(*) AS n_near, min({{'less': -o.n, 'word': other}}) AS best
            FROM near JOIN words o ON o.word = near.other GROUP BY near.word
        ), found AS (
            SELECT w.word, n, coalesce(n_near, 0) AS n_near,
                   CASE WHEN -best.less >= 5 * n THEN best.word END AS form,
                   CASE WHEN -best.less >= 5 * n THEN -best.less END AS form_n
            FROM words w LEFT JOIN best b ON b.word = w.word
        ), chain AS (
            SELECT word, word AS root FROM found
            UNION ALL SELECT c.word, f.form FROM chain c JOIN found f ON f.word = c.root WHERE f.form IS NOT NULL
        ), last AS (
            SELECT c.word, c.root FROM chain c JOIN found f ON f.word = c.root WHERE f.form IS NULL
        )
        SELECT f.word, form, root, n, n_near::BIGINT AS n_near, form_n::BIGINT AS form_n
        FROM found f JOIN last l ON l.word = f.word
    """,
    "op13_chat_format": r"""
        WITH rows AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
        ), escaped AS (
            SELECT *, length(regexp_replace(role || chr(0) || text,
                '([<\[])(\\*)(<SYS>>|</SYS>>|\|endoftext\|>|\|im_start\|>|\|im_end\|>|/INST\]|INST\]|TURN\]|HEAD\]|END\]|/s>|s>)',
                '\1\\\2\3', 'g')) - 1 AS n
            FROM rows
        )
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, md5(text))) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, md5(text)) FILTER (role = 'assistant'), '')) AS loss_sha256,
               (7 + sum(6 + 6 + 5 + n))::BIGINT AS formatted_chars
        FROM escaped GROUP BY conv_id
    """,
}
