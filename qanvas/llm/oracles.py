"""DuckDB SQL for the queries of this subpackage that SQL can express."""

OP1 = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
           CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
    WHERE q.vec_id % 100 = 0
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""

WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP7 = f"""
WITH item_words AS (
    SELECT item_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '{WORDS}') AS w FROM benchmark
), windows AS (
    SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[i : i + least(13, len(w)) - 1], ' ') AS key
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM item_words WHERE len(w) > 0)
), lengths AS (SELECT DISTINCT n FROM windows),
doc_words AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '{WORDS}') AS w FROM documents
), spots AS (
    SELECT r, n, i, array_to_string(w[i : i + n - 1], ' ') AS key
    FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc_words, lengths WHERE len(w) >= n)
), found AS (
    SELECT s.r, s.i, s.n, w.item_id FROM spots s JOIN windows w ON s.n = w.n AND s.key = w.key
), hit AS (
    SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT r, unnest(range(i, i + n)) AS p FROM found) GROUP BY r
), items AS (
    SELECT r, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
    FROM (SELECT DISTINCT r, item_id FROM found WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc_words LEFT JOIN hit USING (r) LEFT JOIN items USING (r)
"""

OP10 = """
WITH p AS (
    SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS d FROM pages
), first AS (SELECT d, max(page_id) AS first, count(*) AS c FROM p WHERE n >= 1000 GROUP BY d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
       CASE WHEN c > 1 AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN c > 1 AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM p LEFT JOIN first USING (d)
"""

# crc32 in SQL: a table of 256 from the polynomial, then a byte at a time.
OP11 = f"""
WITH RECURSIVE crc_table AS (
    SELECT list_transform(range(0, 256), lambda i: list_reduce(range(0, 8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, i)) AS t
), runs AS (
    SELECT doc_id, {LOWER.format("unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+'))")} AS w FROM documents WHERE text IS NOT NULL
), distinct_runs AS (
    SELECT doc_id, w, count(*) AS c, hex(encode(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || w)) AS x FROM runs GROUP BY doc_id, w
), hashed AS (
    SELECT w, c, xor(4294967295, list_reduce(range(1, len(x) // 2 + 1), lambda h, i: xor(h >> 8, t[xor(h & 255, CAST('0x' || substr(x, 2 * i - 1, 2) AS BIGINT)) + 1]), 4294967295)) AS h
    FROM distinct_runs, crc_table
), words AS (
    SELECT word, CAST(sum(c) AS BIGINT) AS n
    FROM (SELECT CASE WHEN h % 97 = 0 THEN substr(w, 1, h % len(w)) || substr(w, h % len(w) + 2) ELSE w END AS word, c FROM hashed)
    WHERE len(word) >= 5 GROUP BY word HAVING sum(c) >= 3
), spots AS (SELECT word, n, unnest(range(1, len(word) + 1)) AS i FROM words),
wild AS (SELECT word, n, substr(word, 1, i - 1) || '*' || substr(word, i + 1) AS k FROM spots),
less AS (SELECT DISTINCT word, n, substr(word, 1, i - 1) || substr(word, i + 1) AS k FROM spots),
pairs AS (
    SELECT a.word, b.word AS near, b.n AS near_n FROM wild a JOIN wild b ON a.k = b.k AND a.word <> b.word
    UNION ALL SELECT l.word, w.word, w.n FROM less l JOIN words w ON l.k = w.word
    UNION ALL SELECT w.word, l.word, l.n FROM less l JOIN words w ON l.k = w.word
), best AS (
    SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, encode(near)) AS near, max(near_n) AS near_n FROM pairs GROUP BY word
), forms AS (
    SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 2 * n THEN near END AS form, CASE WHEN near_n >= 2 * n THEN near_n END AS form_n
    FROM words LEFT JOIN best USING (word)
), ways AS (
    SELECT word, word AS here FROM forms UNION ALL SELECT ways.word, f.form FROM ways JOIN forms f ON ways.here = f.word WHERE f.form IS NOT NULL
), ends AS (SELECT ways.word, here AS root FROM ways JOIN forms f ON ways.here = f.word WHERE f.form IS NULL)
SELECT word, form, root, n, CAST(n_near AS BIGINT) AS n_near, CAST(form_n AS BIGINT) AS form_n FROM forms JOIN ends USING (word)
"""

OP13 = """
WITH crc_table AS (
    SELECT list_transform(range(0, 256), lambda i: list_reduce(range(0, 8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, i)) AS t
), s AS (
    SELECT *, row_number() OVER () AS r, CAST(greatest(0, least(11, floor((date_diff('day', DATE '1970-01-01', CAST(arrived_at AS DATE)) - 19723) * 12 / 152))) AS BIGINT) AS b FROM sales
), hashed AS (
    SELECT *, xor(4294967295, list_reduce(range(1, len(CAST(change_id AS VARCHAR)) + 1), lambda h, i: xor(h >> 8, t[xor(h & 255, ascii(substr(CAST(change_id AS VARCHAR), i, 1))) + 1]), 4294967295)) % 4 AS late_days
    FROM (SELECT DISTINCT * FROM client_changes WHERE valid_at IS NOT NULL), crc_table
), v AS (
    SELECT *, CAST(greatest(0, least(11, floor((date_diff('day', DATE '1970-01-01', CAST(valid_at AS DATE)) + late_days - 19723) * 12 / 152))) AS BIGINT) AS b FROM hashed
), marks AS (
    SELECT b, coalesce((SELECT max(valid_at) FROM v WHERE v.b < x.b), TIMESTAMP '-infinity') AS mark,
           least(coalesce((SELECT max(valid_at) FROM v WHERE v.b < x.b), TIMESTAMP '-infinity'), coalesce((SELECT max(sold_at) FROM s WHERE s.b < x.b), TIMESTAMP '-infinity')) AS h
    FROM (SELECT unnest(range(0, 12)) AS b) x
), accepted AS (SELECT v.* FROM v JOIN marks USING (b) WHERE valid_at >= mark),
emitted AS (
    SELECT r, s.sale_id, s.client_id, s.sold_at, CASE WHEN s.sold_at IS NULL THEN s.b ELSE coalesce(min(m.b), 12) END AS e
    FROM s LEFT JOIN marks m ON m.b >= s.b AND s.sold_at < m.h GROUP BY r, s.sale_id, s.client_id, s.sold_at, s.b
), held AS (
    SELECT e, client_id, change_id, valid_at, balance, op
    FROM (
        SELECT x.e, a.*, h, a.b < x.e AND valid_at <= h AS old,
               row_number() OVER (PARTITION BY x.e, client_id, a.b < x.e AND valid_at <= h ORDER BY valid_at DESC, change_id DESC) AS back
        FROM (SELECT m.b + 1 AS e, m.h FROM marks m UNION ALL SELECT 0, TIMESTAMP '-infinity') x JOIN accepted a ON a.b <= x.e
    ) WHERE NOT old OR back = 1
), n_held AS (SELECT e, client_id, count(*) AS n FROM held GROUP BY e, client_id),
best AS (
    SELECT r, max_by(struct_pack(change_id, balance, op), struct_pack(valid_at, change_id)) AS x
    FROM emitted JOIN held ON emitted.e = held.e AND emitted.client_id = held.client_id AND valid_at <= sold_at GROUP BY r
)
SELECT 'sale' AS rec, sale_id AS id, e AS batch, CAST(coalesce(n, 0) AS BIGINT) AS n_held, x.change_id AS change_id, CAST(floor(100 * x.balance + 0.5) AS BIGINT) AS balance_cents, x.op AS op
FROM emitted LEFT JOIN n_held USING (e, client_id) LEFT JOIN best USING (r)
UNION ALL SELECT 'late', change_id, b, NULL, NULL, NULL, NULL FROM v JOIN marks USING (b) WHERE valid_at < mark
"""

ORACLES: dict[str, str] = {"op1_exact_top_k": OP1, "op7_decontamination": OP7, "op10_warc": OP10, "op11_spelling_variants": OP11, "op13_sale_enrichment": OP13}
