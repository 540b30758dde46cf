"""For each query that SQL can express, the DuckDB statement that gives the same rows."""

from creditloom.llm.licenses import TEMPLATES

op1_warc_archive = """
WITH named AS (
    SELECT page_id, url, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages
), first AS (
    SELECT hex, max(page_id) AS response_id FROM named GROUP BY hex
)
SELECT page_id,
       strlen(html)::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i:
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                  1 + ((('0x' || substr(hex, 1 + 5 * (i // 4), 5))::BIGINT
                        >> (5 * (3 - i % 4))) & 31)::BIGINT, 1)), '') AS payload_digest,
       CASE WHEN page_id IS DISTINCT FROM response_id AND response_id IS NOT NULL
            THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM response_id THEN response_id END AS refers_to,
       url
FROM named JOIN first USING (hex)
"""

op2_curriculum_mix = r"""
WITH sized AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
           md5(coalesce(doc_id::VARCHAR, '')) AS ord
    FROM documents
), sources AS (
    SELECT source, sum(size)::BIGINT AS source_size,
           [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE
               AS weight
    FROM sized GROUP BY source
), filled AS (
    SELECT *, 3.0::DOUBLE * source_size AS capacity,
           row_number() OVER (ORDER BY 3.0::DOUBLE * source_size / weight, source NULLS LAST) AS k
    FROM sources
), levels AS (
    SELECT *, (sum(source_size) OVER () - coalesce(sum(capacity) OVER w, 0))::DOUBLE
              / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0)) AS level
    FROM filled WINDOW w AS (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), chosen AS (
    SELECT arg_min(level, k) AS level FROM levels WHERE level * weight <= capacity
), targets AS (
    SELECT source, source_size, least(capacity, chosen.level * weight) AS target
    FROM filled, chosen
), running AS (
    SELECT doc_id, size, source_size, target, floor(target / source_size)::BIGINT AS epochs,
           sum(size) OVER (PARTITION BY s.source ORDER BY ord, size, doc_id
                           ROWS UNBOUNDED PRECEDING) - size AS before
    FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), rest AS (
    SELECT *, round(target - epochs * source_size)::BIGINT AS rest FROM running
)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (epochs * size + greatest(least(rest - before, size), 0))::BIGINT AS taken,
       CASE WHEN epochs * size + greatest(least(rest - before, size), 0) > 0
            THEN floor(before::DOUBLE / target * 1e9)::BIGINT END AS position_ppb
FROM rest
"""

op10_line_dedup = r"""
WITH split AS (
    SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines
    FROM documents
), numbered AS (
    SELECT r, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS n FROM split
), keyed AS (
    SELECT r, doc_id, n, line,
           translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM numbered
), frequent AS (
    SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT r) >= 10
)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines,
       count(*) FILTER (WHERE f.key IS NOT NULL) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (WHERE f.key IS NULL), ''))
           AS kept_sha256
FROM keyed k LEFT JOIN frequent f ON k.key = f.key
GROUP BY r
"""

op8_exact_top_k = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2]))::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.e) = len(c.e)
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
    FROM scored
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""

_LICENSE_ROWS = ", ".join(f"('{name}', '{text}')" for name, text in TEMPLATES.items())

op4_license_scan = rf"""
WITH template AS (
    SELECT license_id, string_split(trim(regexp_replace(lower(body), '[^\p{{L}}\p{{N}}]+', ' ', 'g')), ' ')
        AS w
    FROM (VALUES {_LICENSE_ROWS}) AS t(license_id, body)
), wanted AS (
    SELECT license_id,
           list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS b
    FROM template
), normal AS (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_replace(lower(coalesce(text, '')), '[^\p{{L}}\p{{N}}\n]+', ' ', 'g') AS body
    FROM documents
), cut AS (
    SELECT r, doc_id, unnest(list_distinct(string_split(body, chr(10))
           || regexp_split_to_array(body, '\n *\n[ \n]*') || [body])) AS part
    FROM normal
), worded AS (
    SELECT DISTINCT r, doc_id, string_split(trim(regexp_replace(part, '[ \n]+', ' ', 'g')), ' ') AS w
    FROM cut
), grams AS (
    SELECT r, doc_id,
           list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS b
    FROM worded WHERE len(w) > 1
), compared AS (
    SELECT r, doc_id, license_id,
           2.0::DOUBLE * len(list_intersect(g.b, t.b)) / (len(g.b) + len(t.b)) AS dice
    FROM grams g JOIN wanted t ON len(g.b) < 2 * len(t.b) AND len(t.b) < 2 * len(g.b)
)
SELECT any_value(doc_id) AS doc_id, license_id, max(dice) AS dice, count(*) AS n_parts
FROM compared WHERE dice >= 0.8 GROUP BY r, license_id
"""


def _crc32(text: str) -> str:
    """The unsigned CRC-32 of a text's UTF-8 bytes, bit by bit."""
    return f"""xor(list_reduce(
        list_transform(range(0, strlen({text})),
                       lambda i: ('0x' || substr(hex({text}), 2 * i + 1, 2))::BIGINT),
        lambda a, b: list_reduce(range(0, 8), lambda c, k:
            CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, xor(a, b)),
        4294967295::BIGINT), 4294967295)"""


op11_conversation_repair = rf"""
WITH RECURSIVE plain AS (
    SELECT conv_id, coalesce(conv_id::VARCHAR, '') AS key, turn, coalesce(role, ' ') AS role,
           coalesce(text, ' ') AS text,
           coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS place
    FROM conversations
), damaged AS (
    SELECT key, turn, CASE WHEN damage = 4 THEN 'user' ELSE role END AS role,
           CASE damage WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
           unnest(range(0, CASE damage WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
    FROM (SELECT *, {_crc32("place")} % 20 AS damage FROM plain)
), numbered AS (
    SELECT *, row_number() OVER (PARTITION BY key ORDER BY turn NULLS FIRST, digest) AS nth
    FROM (SELECT *, sha256(strlen(role)::VARCHAR || ':' || role || text) AS digest FROM damaged)
), judged AS (
    SELECT key, nth, turn, role, text, role[1] AS initial, digest,
           row_number() OVER (PARTITION BY key, role, text ORDER BY nth) > 1 AS again,
           regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS shown
    FROM numbered
), messages AS (
    SELECT *, CASE WHEN shown = '' THEN 'blank' WHEN again THEN 'duplicate'
                   WHEN shown NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
           lag(initial) OVER (PARTITION BY key ORDER BY nth) || initial AS pair
    FROM judged
), counted AS (
    SELECT key, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (fault = 'blank') AS blank,
           count(*) FILTER (fault = 'duplicate') AS duplicate,
           count(*) FILTER (fault = 'truncated') AS truncated,
           count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, max(nth) AS size
    FROM messages GROUP BY key
), due(state, role, next) AS (
    VALUES ('', 'user', 'u'), ('s', 'user', 'u'), ('u', 'assistant', 'a'), ('a', 'user', 'u')
), inserts AS (
    SELECT state, state AS to_state, 0 AS cost, '' AS audit, []::VARCHAR[] AS lines FROM due
    UNION ALL SELECT state, next, 2, 'I', [role || ':'] FROM due
    UNION ALL SELECT a.state, b.next, 4, 'II', [a.role || ':', b.role || ':']
    FROM due a JOIN due b ON a.next = b.state
), kept(state, initial, to_state) AS (
    VALUES ('', 's', 's'), ('', 'u', 'u'), ('s', 'u', 'u'), ('a', 'u', 'u'), ('u', 'a', 'a')
), best AS (
    SELECT key, 0::BIGINT AS nth, '' AS state, 0 AS cost, '' AS audit, []::VARCHAR[] AS lines
    FROM counted
    UNION ALL
    SELECT key, nth, state, cost, audit, lines FROM (
        SELECT b.key, m.nth, e.to_state AS state, b.cost + i.cost + e.cost AS cost,
               b.audit || i.audit || e.edit AS audit,
               list_concat(b.lines, list_concat(i.lines, e.lines)) AS lines
        FROM best b JOIN messages m ON m.key = b.key AND m.nth = b.nth + 1
             JOIN inserts i ON i.state = b.state
             JOIN LATERAL (
                 SELECT 'D' AS edit, 3 AS cost, i.to_state AS to_state, []::VARCHAR[] AS lines
                 UNION ALL SELECT 'R', 2 + (m.fault = 'truncated')::INT, d.next, [d.role || ':' || m.text]
                 FROM due d WHERE d.state = i.to_state AND m.fault IN ('', 'truncated')
                 UNION ALL SELECT 'K', (m.fault = 'truncated')::INT, k.to_state, [m.role || ':' || m.text]
                 FROM kept k WHERE k.state = i.to_state AND k.initial = m.initial
                                   AND m.fault IN ('', 'truncated')
             ) e ON true
    ) QUALIFY row_number() OVER (PARTITION BY key, state ORDER BY cost, audit) = 1
), ended AS (
    SELECT b.key, b.cost + i.cost AS cost, b.audit || i.audit AS audit,
           list_concat(b.lines, i.lines) AS lines
    FROM best b JOIN counted c ON c.key = b.key AND c.size = b.nth
         JOIN inserts i ON i.state = b.state AND i.to_state IN ('', 'a')
    QUALIFY row_number() OVER (PARTITION BY b.key ORDER BY b.cost + i.cost, b.audit || i.audit) = 1
)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank,
       coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(cost, 0)::BIGINT AS cost,
       coalesce(audit, '') AS audit,
       sha256(coalesce(array_to_string(lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, key FROM plain) LEFT JOIN counted USING (key) LEFT JOIN ended USING (key)
"""

op12_spelling_variants = rf"""
WITH RECURSIVE runs AS (
    SELECT coalesce(doc_id::VARCHAR, '') AS doc,
           translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
    FROM documents
), hashed AS (
    SELECT run, n, {_crc32("(doc || ':' || run)")} AS h
    FROM (SELECT doc, run, count(*) AS n FROM runs GROUP BY doc, run) WHERE length(run) >= 5
), words AS (
    SELECT CASE WHEN h % 97 = 0
                THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run) + 2)::BIGINT)
                ELSE run END AS word, sum(n)::BIGINT AS n
    FROM hashed GROUP BY 1 HAVING length(word) >= 5 AND sum(n) >= 3
), holes AS (
    SELECT word, i, substr(word, 1, i) || substr(word, i + 2) AS rest
    FROM (SELECT word, unnest(range(0, length(word))) AS i FROM words)
), shorter AS (
    SELECT DISTINCT h.word AS long, w.word AS short FROM holes h JOIN words w ON h.rest = w.word
), pairs AS (
    SELECT a.word, b.word AS near FROM holes a JOIN holes b USING (i, rest) WHERE a.word <> b.word
    UNION SELECT long, short FROM shorter
    UNION SELECT short, long FROM shorter
), first AS (
    SELECT p.word, count(*) OVER (PARTITION BY p.word) AS n_near, near, w.n AS near_n
    FROM pairs p JOIN words w ON w.word = p.near
    QUALIFY row_number() OVER (PARTITION BY p.word ORDER BY w.n DESC, near) = 1
), judged AS (
    SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 2 * n THEN near END AS form,
           CASE WHEN near_n >= 2 * n THEN near_n END AS form_n
    FROM words LEFT JOIN first USING (word)
), ups AS (
    SELECT word, word AS root, form FROM judged
    UNION ALL
    SELECT u.word, j.word, j.form FROM ups u JOIN judged j ON u.form = j.word
)
SELECT word, j.form, u.root, n, n_near, form_n
FROM judged j JOIN (SELECT word, root FROM ups WHERE form IS NULL) u USING (word)
"""
