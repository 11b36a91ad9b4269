"""DuckDB statements for the queries that SQL can express."""

CHAT_FORMAT = r"""
WITH rows_in AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
    UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place FROM rows_in
), marked AS (
    SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY place) AS before FROM placed
)
SELECT conv_id,
       count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(replace(replace(text, '\', '\\'), '<|', '<\|'))
           + CASE WHEN before IS DISTINCT FROM role
                  THEN 12 + length(replace(replace(role, '\', '\\'), '<|', '<\|')) + 10 + 10
                  ELSE 11 END) AS BIGINT) AS formatted_chars
FROM marked GROUP BY conv_id
"""

# Base32 takes five bits of the digest at a time.
SALVAGE_READER = r"""
WITH given AS (
    SELECT page_id, encode(coalesce(html, '')) AS payload, row_number() OVER (ORDER BY page_id NULLS LAST, url) AS place FROM pages
), placed AS (
    SELECT *, row_number() OVER same AS n, first_value(page_id) OVER same AS first,
           CAST(unhex(sha1(payload)) AS BIT)::VARCHAR AS bits
    FROM given WINDOW same AS (PARTITION BY payload ORDER BY place)
)
SELECT page_id, octet_length(payload) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           CAST(1 + list_sum(list_transform(range(5), lambda b: CAST(substr(bits, CAST(5 * k + b + 1 AS INTEGER), 1) AS INTEGER) * (16 >> b))) AS INTEGER), 1)), '') AS payload_digest,
       CASE WHEN n = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN n > 1 THEN first END AS refers_to
FROM placed
"""

BALL_TREE = r"""
WITH texts AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words
    FROM documents
), items AS (
    SELECT row_number() OVER () AS i, item_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words
    FROM benchmark
), corpus AS (
    SELECT count(*) AS n_all, sum(len(words)) AS l_all FROM texts WHERE len(words) > 0
), normed AS (
    SELECT r, doc_id, CAST(10 + (90 * len(words) * n_all) // l_all AS BIGINT) AS m FROM texts, corpus WHERE len(words) > 0
), wanted AS (
    SELECT DISTINCT i, unnest(words) AS term FROM items
), counted AS (
    SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(words) AS term FROM texts)
    WHERE term IN (SELECT term FROM wanted) GROUP BY r, term
), weighed AS (
    SELECT term, CAST(floor(1000 * ln((2 * n_all + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM counted, corpus GROUP BY term, n_all
), scored AS (
    SELECT i, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
    FROM wanted JOIN weighed USING (term) JOIN counted USING (term) JOIN normed USING (r) GROUP BY i, r, doc_id
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked JOIN items USING (i) WHERE rank <= 10
"""

# crc32 bit by bit; a stretch of places i with equal 16 words at i and at i + q is a run's first
# occurrences, 16 words shorter than the run less one period.
PERIODIC_RUNS = r"""
WITH given AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
           list_transform(range(length(CAST(doc_id AS VARCHAR))), lambda k: CAST(ascii(substr(CAST(doc_id AS VARCHAR), CAST(k + 1 AS INTEGER), 1)) AS BIGINT)) AS signs
    FROM documents
), hashed AS (
    SELECT r, doc_id, w, len(w) AS n,
           xor(list_reduce(list_concat([4294967295], signs), lambda c, b:
               list_reduce(list_concat([xor(c, b)], range(8)), lambda x, k:
                   CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)), 4294967295) AS h
    FROM given
), cut AS (
    SELECT *, CASE WHEN n > 0 THEN (h // 10) % n END AS a FROM hashed
), spaced AS (
    SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM cut
), texts AS (
    SELECT r, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
        THEN list_transform(range(n), lambda i: w[CASE WHEN i < a THEN i + 1 ELSE a + (i - a) % p + 1 END]) ELSE w END AS w
    FROM spaced
), grams AS (
    SELECT r, n, i, array_to_string(w[i + 1 : i + 16], ' ') AS g FROM (SELECT r, n, w, unnest(range(n - 15)) AS i FROM texts)
), pairs AS (
    SELECT x.r, y.i - x.i AS q, x.i FROM grams x JOIN grams y ON x.r = y.r AND x.g = y.g AND y.i > x.i AND 3 * (y.i - x.i) <= x.n
), stretches AS (
    SELECT r, q, min(i) AS start, count(*) + 15 + q AS length
    FROM (SELECT *, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS stretch FROM pairs) GROUP BY r, q, stretch
), runs AS (
    SELECT r, start, length, min(q) AS period FROM stretches WHERE length >= 24 AND length >= 3 * q GROUP BY r, start, length
), listed AS (
    SELECT r, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines,
           arg_min({s: start, l: length, p: period}, {e: -(length / period), s: start, p: period}) AS best
    FROM runs GROUP BY r
), kept AS (
    SELECT r, string_agg(word, ' ' ORDER BY i) AS text
    FROM (SELECT r, unnest(w) AS word, unnest(range(n)) AS i FROM texts WHERE r IN (SELECT r FROM runs)) words
    WHERE NOT EXISTS (SELECT 1 FROM runs WHERE runs.r = words.r AND words.i >= start + period AND words.i < start + length)
    GROUP BY r
)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best.s AS start, best.l AS length, best.p AS period,
       (1000 * best.l) // best.p AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
       sha256(CASE WHEN n_runs IS NULL THEN array_to_string(w, ' ') ELSE coalesce(kept.text, '') END) AS collapsed_sha256
FROM texts LEFT JOIN listed USING (r) LEFT JOIN kept USING (r)
"""
