"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

SQL: dict[str, str] = {}

SQL["op1_preference_format"] = r"""
WITH t AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turn,
           CAST('0x' || substr(sha256(CAST(conv_id AS VARCHAR)), 1, 8) AS BIGINT)
               % (count(*) OVER (PARTITION BY conv_id) + 1) AS kept
    FROM conversations WHERE conv_id IS NOT NULL),
sides AS (
    SELECT conv_id, 'chosen' AS side, turn, role, text FROM t
    UNION ALL SELECT conv_id, 'rejected', turn, role, text FROM t WHERE turn <= kept
    UNION ALL SELECT own.conv_id, 'rejected', other.turn, other.role, other.text
    FROM (SELECT conv_id, kept FROM t WHERE turn = 1) AS own JOIN t AS other ON xor(own.conv_id, 1) = other.conv_id
    WHERE other.turn > own.kept),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id, side ORDER BY turn, role, text) AS place FROM sides),
compared AS (
    SELECT coalesce(c.conv_id, r.conv_id) AS conv_id, coalesce(c.place, r.place) AS place,
           coalesce(c.role = r.role AND c.text = r.text, false) AS same
    FROM (SELECT * FROM placed WHERE side = 'chosen') AS c
    FULL JOIN (SELECT * FROM placed WHERE side = 'rejected') AS r ON c.conv_id = r.conv_id AND c.place = r.place),
common AS (
    SELECT conv_id, coalesce(min(place) FILTER (NOT same) - 1, max(place)) AS n_common
    FROM compared GROUP BY conv_id),
pieces AS (
    SELECT p.conv_id, side, place, role, place <= n_common AS in_prompt,
           '<|im_start|>' || replace(role, '<|', '< |') || chr(10) AS head,
           replace(text, '<|', '< |') || '<|im_end|>' AS body
    FROM placed AS p JOIN common USING (conv_id)),
measured AS (
    SELECT *, coalesce(sum(length(head) + length(body) + 1) FILTER (NOT in_prompt) OVER (
        PARTITION BY conv_id, side ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
        + length(head) AS start
    FROM pieces),
joined AS (
    SELECT conv_id, side,
        coalesce(string_agg(head || body || chr(10), '' ORDER BY place) FILTER (in_prompt), '') AS prompt,
        coalesce(string_agg(head || body || chr(10), '' ORDER BY place) FILTER (NOT in_prompt), '') AS completion,
        coalesce(string_agg(CAST(start AS BIGINT) || ':' || CAST(start + length(body) AS BIGINT), ',' ORDER BY place)
            FILTER (NOT in_prompt AND role = 'assistant'), '') AS mask
    FROM measured GROUP BY conv_id, side)
SELECT common.conv_id, CAST(n_common AS INTEGER) AS n_common, coalesce(c.prompt, '') AS prompt,
       coalesce(c.completion, '') AS chosen, coalesce(c.mask, '') AS chosen_mask,
       coalesce(r.completion, '') AS rejected, coalesce(r.mask, '') AS rejected_mask
FROM common
LEFT JOIN (SELECT * FROM joined WHERE side = 'chosen') AS c ON common.conv_id = c.conv_id
LEFT JOIN (SELECT * FROM joined WHERE side = 'rejected') AS r ON common.conv_id = r.conv_id
"""

SQL["op4_exact_dedup"] = r"""
WITH content AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS content FROM documents),
grouped AS (
    SELECT doc_id, content, min(doc_id) OVER (PARTITION BY content) AS keep_id,
           count(*) OVER (PARTITION BY content) AS group_size
    FROM content)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(content) AS text_sha256 FROM grouped
"""

# Absent links give nothing; a link is made absolute, an address is spelt as the operator spells it.
SQL["op2_url_filter"] = r"""
WITH RECURSIVE
rules(rhost, rpath, action) AS (VALUES
    ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
    ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
raw AS (
    SELECT url, html, regexp_extract(url, '^(.*?)://', 1, 's') AS scheme,
           regexp_extract(url, '://([^/?#]*)', 1) AS site,
           regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path
    FROM pages WHERE contains(url, '://')),
found AS (
    SELECT *, unnest([
        regexp_extract(html, '<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*?\bhref\s*=\s*["'']?([^"''>\s]+)', 1, 'si'),
        regexp_extract(html, '<link\b[^>]*\bhref\s*=\s*["'']?([^"''>\s]+)["'']?[^>]*?\brel\s*=\s*["'']?canonical\b', 1, 'si'),
        regexp_extract(html, '<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*?\burl\s*=\s*["'']?([^"''>\s]+)', 1, 'si')
    ]) AS link FROM raw),
links AS (
    SELECT url AS a, CASE
        WHEN contains(link, '://') THEN link
        WHEN link LIKE '//%' THEN scheme || ':' || link
        WHEN link LIKE '/%' THEN scheme || '://' || site || link
        ELSE scheme || '://' || site || regexp_replace(path, '[^/]*$', '') || link END AS b
    FROM found WHERE link <> ''),
urls AS (SELECT url FROM raw UNION SELECT a FROM links UNION SELECT b FROM links),
parts AS (
    SELECT url, regexp_extract(url, '^(.*?)://', 1, 's') AS scheme,
           translate(regexp_extract(url, '://([^/?#]*)', 1),
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path,
           regexp_extract(url, '^.*?://[^/?#]*[^?#]*(\?[^#]*)', 1, 's') AS query
    FROM urls),
judged AS (
    SELECT url, host, path, arg_max(rhost || rpath, length(rhost || rpath)) AS rule,
           arg_max(action, length(rhost || rpath)) AS action
    FROM parts LEFT JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
    GROUP BY url, host, path),
spelt AS (
    SELECT url AS a, CASE WHEN lower(scheme) IN ('http', 'https') THEN 'https' ELSE lower(scheme) END || '://' || host
        || path || regexp_replace(regexp_replace(regexp_replace(query,
            '([?&])((utm_[a-z]+|gclid|fbclid)=[^&]*(&|$))+', '\1', 'gi'), '[?&]$', ''), '^&', '?') AS b
    FROM parts),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links UNION SELECT a, b FROM spelt UNION SELECT b, a FROM spelt),
reach(node, other) AS (
    SELECT a, a FROM edges UNION SELECT node, b FROM reach JOIN edges ON other = a),
decided AS (
    SELECT node, bool_or(action = 'allow') AS allowed, bool_or(action = 'block') AS blocked
    FROM reach LEFT JOIN judged ON other = url GROUP BY node)
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule,
       CASE WHEN action IS NOT NULL THEN action WHEN allowed THEN 'allow' WHEN blocked THEN 'block' ELSE 'allow' END
           AS verdict
FROM pages LEFT JOIN judged USING (url) LEFT JOIN decided ON pages.url = decided.node
"""

# The CRC is worked out byte by byte from its polynomial.
SQL["op12_importance_resampling"] = r"""
WITH steps AS (
    SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda c, k:
        CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, CAST(b AS BIGINT))) AS step),
docs AS (
    SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM documents),
items AS (
    SELECT unnest(regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
    FROM benchmark),
source AS (SELECT row, word, count(*) AS n FROM (SELECT row, unnest(words) AS word FROM docs) GROUP BY row, word),
vocabulary AS (
    SELECT word, xor(list_reduce(
        list_transform(range(octet_length(encode(word))),
            lambda i: CAST('0x' || substr(hex(encode(word)), CAST(2 * i + 1 AS INTEGER), 2) AS BIGINT)),
        lambda c, b: xor(c // 256, step[xor(c, b) % 256 + 1]), 4294967295), 4294967295) % 10000 AS bucket
    FROM (SELECT word FROM source UNION SELECT word FROM items), steps),
sums AS (
    SELECT bucket, sum(s) AS s, sum(t) AS t FROM (
        SELECT bucket, n AS s, 0 AS t FROM source JOIN vocabulary USING (word)
        UNION ALL SELECT bucket, 0, 1 FROM items JOIN vocabulary USING (word)) GROUP BY bucket),
gains AS (
    SELECT bucket, CAST(floor(1000 * ln(((t + 1.0::DOUBLE) * (sum(s) OVER () + 10000.0::DOUBLE))
        / ((s + 1.0::DOUBLE) * (sum(t) OVER () + 10000.0::DOUBLE)))) AS BIGINT) AS gain
    FROM sums),
weights AS (
    SELECT row, sum(n) AS n, CAST(floor(sum(n * gain) / sum(n)) AS BIGINT) AS weight
    FROM source JOIN vocabulary USING (word) JOIN gains USING (bucket) GROUP BY row),
scored AS (
    SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
           coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT)
               + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score
    FROM docs LEFT JOIN weights USING (row)),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
           count(*) FILTER (n_features >= 20) OVER () AS eligible
    FROM scored)
SELECT doc_id, n_features, weight, score,
       CASE WHEN n_features >= 20 AND place <= 10 * eligible // 100 THEN place END AS rank
FROM placed
"""

SQL["op13_lexical_search"] = r"""
WITH found AS (
    SELECT row, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT row_number() OVER () AS row, doc_id, text FROM documents)),
sizes AS (SELECT row, count(*) AS n FROM found GROUP BY row),
totals AS (SELECT count(*) AS documents, sum(n)::BIGINT AS length FROM sizes),
held AS (SELECT row, any_value(doc_id) AS doc_id, term, count(*) AS tf FROM found GROUP BY row, term),
weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * any_value(documents) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
    FROM held, totals GROUP BY term),
asked AS (
    SELECT item, item_id, term, count(*) AS times FROM (
        SELECT row_number() OVER () AS item, item_id, unnest(regexp_extract_all(translate(text,
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS term
        FROM (SELECT DISTINCT item_id, text FROM benchmark)) GROUP BY item, item_id, term),
scores AS (
    SELECT item, item_id, row, doc_id,
           sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * documents) // length))))::BIGINT AS score
    FROM asked JOIN held USING (term) JOIN weights USING (term) JOIN sizes USING (row), totals
    GROUP BY item, item_id, row, doc_id),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS place FROM scores WHERE score > 0)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM placed WHERE place <= 20
"""
