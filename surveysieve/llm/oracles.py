"""DuckDB SQL for the rows of those queries that SQL can express."""

ORACLES: dict[str, str] = {}

ORACLES["op4_jaccard_join"] = r"""
WITH RECURSIVE words AS (
    SELECT row_number() OVER () AS place, doc_id,
        [word FOR word IN string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+') IF word <> ''] AS w
    FROM documents
),
sets AS (
    SELECT place, doc_id, CASE
        WHEN len(w) = 0 THEN []
        WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_sort(list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]))
        END AS s
    FROM words
),
keyed AS (SELECT place, doc_id, len(s) AS n, md5(array_to_string(s, '|')) AS key FROM sets),
items AS (SELECT place, unnest(s) AS item FROM sets),
common AS (
    SELECT a.place AS a, b.place AS b, count(*) AS shared
    FROM items a JOIN items b ON a.item = b.item AND a.place <> b.place
    GROUP BY ALL
),
links AS (
    SELECT c.a, c.b FROM common c JOIN keyed x ON x.place = c.a JOIN keyed y ON y.place = c.b
    WHERE c.shared * 5 >= (x.n + y.n - c.shared) * 4
    UNION
    SELECT x.place, y.place FROM keyed x JOIN keyed y ON x.key = y.key AND x.place <> y.place AND x.n = 0
),
reached AS (
    SELECT place AS a, place AS b FROM keyed
    UNION
    SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
),
classes AS (SELECT r.a, min(k.doc_id) AS class_id FROM reached r JOIN keyed k ON k.place = r.b GROUP BY r.a),
counted AS (SELECT a, count(*) AS n FROM links GROUP BY a),
copies AS (SELECT key, count(*) AS n FROM keyed GROUP BY key)
SELECT k.doc_id, c.class_id, coalesce(l.n, 0) AS n_links, copies.n AS n_copies
FROM keyed k JOIN classes c ON c.a = k.place JOIN copies USING (key) LEFT JOIN counted l ON l.a = k.place
"""

# The digest's hexadecimal digits are read five at a time, which are four digits to the base of 32.
ORACLES["op8_warc"] = r"""
WITH hashed AS (
    SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
        sha1(coalesce(html, '')) AS hex
    FROM pages
),
firsts AS (SELECT html, min(page_id) AS first_id FROM hashed GROUP BY html)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
    array_to_string([substr(
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        1 + ((('0x' || substr(hex, 1 + 5 * (i // 4)::INT, 5))::BIGINT >> (5 * (3 - i % 4))::INT) & 31)::INT,
        1) FOR i IN range(0, 32)], '') AS payload_digest,
    CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM hashed JOIN firsts USING (html)
"""

ORACLES["op9_exact_dedup"] = r"""
WITH plain AS (
    SELECT doc_id, length(coalesce(text, '')) AS n_chars,
        regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS content
    FROM documents
)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY content) AS group_size,
    row_number() OVER best = 1 AS kept, sha256(content) AS text_sha256
FROM plain
WINDOW best AS (PARTITION BY content ORDER BY n_chars DESC, doc_id NULLS LAST)
"""

# The nearest entry and its distance are kept as one number, distance * 64 + entry.
_MOVED_CODEBOOK = """
near{n} AS (
    SELECT r, p, min(list_sum([(z[1] - z[2]) * (z[1] - z[2]) FOR z IN list_zip(v, c)]) * 64 + e)::BIGINT AS best
    FROM parts JOIN book{m} USING (p) GROUP BY r, p
),
sums{n} AS (
    SELECT p, best % 64 AS e, place, sum(v[place])::BIGINT AS s, count(*) AS n
    FROM near{n} JOIN parts USING (r, p), generate_series(1, len(v)) AS places(place) GROUP BY ALL
),
moved{n} AS (SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY place) AS c FROM sums{n} GROUP BY p, e),
book{n} AS (SELECT b.p, b.e, coalesce(m.c, b.c) AS c FROM book{m} b LEFT JOIN moved{n} m ON m.p = b.p AND m.e = b.e),
"""

ORACLES["op12_vector_codes"] = f"""
WITH kept AS (
    SELECT row_number() OVER () AS r, vec_id, label, [floor(256 * c::DOUBLE)::BIGINT FOR c IN embedding] AS x
    FROM embeddings
    WHERE len(embedding) > 0 AND len([c FOR c IN embedding IF c IS NULL OR NOT isfinite(c)]) = 0
),
parts AS (
    SELECT r, p, x[p * (len(x) // 16) + 1:(p + 1) * (len(x) // 16)] AS v FROM kept, range(16) AS numbers(p)
),
firsts AS (SELECT r, row_number() OVER (ORDER BY vec_id NULLS LAST, x) - 1 AS e FROM kept),
book0 AS (SELECT p, e, v AS c FROM firsts JOIN parts USING (r) WHERE e < 64),
{_MOVED_CODEBOOK.format(m=0, n=1)}
{_MOVED_CODEBOOK.format(m=1, n=2)}
near AS (
    SELECT r, p, min(list_sum([(z[1] - z[2]) * (z[1] - z[2]) FOR z IN list_zip(v, c)]) * 64 + e)::BIGINT AS best
    FROM parts JOIN book2 USING (p) GROUP BY r, p
),
coded AS (
    SELECT r, string_agg(printf('%02x', best % 64), '' ORDER BY p) AS code, sum(best // 64)::BIGINT AS error
    FROM near GROUP BY r
),
digest AS (
    SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book2
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN coded USING (r), digest
"""

# All windows by digest, then the gaps between their spans.
ORACLES["op11_suffix_dedup"] = r"""
WITH bytes AS (
    SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b FROM documents
),
windows AS (
    SELECT r, p, md5(b[p + 1:p + 200]) AS content
    FROM (SELECT r, b, unnest(range(0, octet_length(b) - 199)) AS p FROM bytes)
),
found AS (
    SELECT r, p FROM windows SEMI JOIN (SELECT content FROM windows GROUP BY content HAVING count(*) > 1) USING (content)
),
parted AS (SELECT r, p, p > lag(p, 1, -1000) OVER (PARTITION BY r ORDER BY p) + 200 AS new FROM found),
numbered AS (SELECT r, p, count_if(new) OVER (PARTITION BY r ORDER BY p) AS span FROM parted),
spans AS (SELECT r, span, min(p) AS start, max(p) + 200 AS stop FROM numbered GROUP BY r, span),
ends AS (SELECT r, span, stop, lead(start) OVER (PARTITION BY r ORDER BY span) AS next FROM spans
    UNION ALL SELECT r, 0, 0, min(start) FROM spans GROUP BY r),
cut AS (
    SELECT r, string_agg(hex(b[stop + 1:coalesce(next, octet_length(b))]), '' ORDER BY span) AS kept
    FROM ends JOIN bytes USING (r) GROUP BY r
),
totals AS (SELECT r, count(*) AS n_spans, sum(stop - start)::BIGINT AS n_removed FROM spans GROUP BY r)
SELECT doc_id, octet_length(b) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
    sha256(CASE WHEN kept IS NULL THEN b ELSE unhex(kept) END) AS kept_sha256
FROM bytes LEFT JOIN totals USING (r) LEFT JOIN cut USING (r)
"""
