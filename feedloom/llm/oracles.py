"""SQL for the operators that SQL can express, over the same tables, for DuckDB."""

from __future__ import annotations

_FOLDED = (
    "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
)
_SPACED = r"'[^\x20\x09-\x0D]+'"
_ITEM_WORD = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

NGRAM_JOIN = f"""
WITH RECURSIVE
cut AS (SELECT doc_id, regexp_extract_all({_FOLDED}, {_SPACED}) AS w FROM documents),
places AS (
    SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS s FROM cut WHERE len(w) > 0
),
shingles AS (SELECT DISTINCT doc_id, array_to_string(w[s:s + 4], ' ') AS x FROM places),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
    FROM shingles a JOIN shingles b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY 1, 2
),
links AS (
    SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
    WHERE 100 * c >= 75 * (p.n + q.n - c)
),
reached AS (
    SELECT doc_id, doc_id AS other FROM documents
    UNION
    SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other
)
SELECT r.doc_id, CAST(coalesce(any_value(n), 0) AS BIGINT) AS n_shingles,
       min(other) AS component_id
FROM reached r LEFT JOIN sizes s ON s.doc_id = r.doc_id GROUP BY r.doc_id
"""

DECONTAMINATION = f"""
WITH
cut AS (SELECT doc_id, regexp_extract_all({_FOLDED}, {_ITEM_WORD}) AS w FROM documents),
items AS (SELECT item_id, regexp_extract_all({_FOLDED}, {_ITEM_WORD}) AS w FROM benchmark),
item_places AS (
    SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS s
    FROM items WHERE len(w) > 0
),
windows AS (
    SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, len(w[s:s + 12]) AS n,
           array_to_string(w[s:s + 12], ' ') AS x
    FROM item_places
),
lengths AS (SELECT DISTINCT n FROM windows),
places AS (
    SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM cut, lengths WHERE len(w) >= n
),
hits AS (
    SELECT doc_id, s, p.n, item
    FROM places p JOIN windows v ON v.x = array_to_string(w[s:s + p.n - 1], ' ') AND v.n = p.n
),
covered AS (
    SELECT doc_id, count(DISTINCT place) AS n_hit
    FROM (SELECT doc_id, unnest(range(s, s + n)) AS place FROM hits) GROUP BY doc_id
),
named AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
    FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM cut LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""

SUBSTRING_DEDUP = f"""
WITH
cut AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_SPACED}) AS w FROM documents),
places AS (
    SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS s FROM cut WHERE len(w) >= 50
),
windows AS (SELECT doc_id, s, array_to_string(w[s:s + 49], ' ') AS x FROM places),
firsts AS (SELECT doc_id, s, min(doc_id) OVER (PARTITION BY x) AS first FROM windows),
covered AS (
    SELECT DISTINCT doc_id, unnest(range(s, s + 50)) AS place FROM firsts WHERE first < doc_id
),
spread AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS place FROM cut),
kept AS (
    SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY place) AS text
    FROM spread ANTI JOIN covered USING (doc_id, place) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
       CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM cut LEFT JOIN kept USING (doc_id)
"""

# Bytes as hexadecimal digits, two for each; places count from 0.
SUFFIX_DEDUP = """
WITH
cut AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
places AS (
    SELECT doc_id, h, unnest(range(0, len(h) // 2 - 49)) AS s FROM cut WHERE len(h) >= 100
),
strings AS (SELECT doc_id, s, substr(h, 2 * s + 1, 100) AS x FROM places),
firsts AS (SELECT doc_id, s, min(doc_id) OVER (PARTITION BY x) AS first FROM strings),
hits AS (
    SELECT doc_id, s, s > coalesce(lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 50, -1) AS opens
    FROM firsts WHERE first < doc_id
),
numbered AS (
    SELECT doc_id, s, sum(CAST(opens AS INT)) OVER (PARTITION BY doc_id ORDER BY s) AS run FROM hits
),
runs AS (SELECT doc_id, run, min(s) AS a, max(s) + 50 AS b FROM numbered GROUP BY doc_id, run),
gaps AS (
    SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before
    FROM runs
),
kept AS (
    SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS last,
           string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS head
    FROM gaps JOIN cut USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes,
       CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM cut LEFT JOIN kept USING (doc_id)
"""

FILL_IN_MIDDLE = """
WITH hashed AS (
    SELECT doc_id, coalesce(text, '') AS t,
           sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
    FROM documents
), drawn AS (
    SELECT doc_id, t, regexp_extract_all(t, '[^\\n]*\\n|[^\\n]+') AS units,
           CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
           CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
    FROM hashed
), formed AS (
    SELECT *, len(units) AS n,
           CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                     OR h3 % 100 >= 100 THEN 'plain'
                WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form,
           least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a,
           greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b
    FROM drawn
), cut AS (
    SELECT doc_id, t, n, form, coalesce(array_to_string(units[1:a], ''), '') AS p,
           coalesce(array_to_string(units[a + 1:b], ''), '') AS m,
           coalesce(array_to_string(units[b + 1:n], ''), '') AS s
    FROM formed
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM cut
"""

_KEPT_VECTORS = """
kept AS MATERIALIZED (
    SELECT row_number() OVER () AS r, vec_id,
           list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE len(embedding) = 64
      AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
),
dims AS MATERIALIZED (SELECT r, unnest(range(1, 65)) AS d, unnest(v) AS x FROM kept),
first AS (
    SELECT row_number() OVER (
               ORDER BY sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), '')), v) - 1 AS c, v
    FROM kept
),
c0 AS MATERIALIZED (SELECT c, unnest(range(1, 65)) AS d, unnest(v) AS y FROM first WHERE c < 16)
"""


def _near(n: int) -> str:
    return f"""
a{n} AS MATERIALIZED (
    SELECT r, c, distance
    FROM (SELECT r, c, sum((x - y) * (x - y)) AS distance FROM dims JOIN c{n} USING (d) GROUP BY r, c)
    QUALIFY row_number() OVER (PARTITION BY r ORDER BY distance, c) = 1
)"""


def _moved(n: int) -> str:
    return f"""
s{n} AS (
    SELECT c, d, sum(x) AS s, count(*) AS k FROM a{n} JOIN dims USING (r) GROUP BY c, d
),
c{n + 1} AS MATERIALIZED (
    SELECT o.c, o.d, CAST(coalesce((s - ((s % k) + k) % k) // k, o.y) AS BIGINT) AS y
    FROM c{n} o LEFT JOIN s{n} USING (c, d)
)"""


CENTROID_CLUSTERS = f"""
WITH {_KEPT_VECTORS}, {", ".join(_near(n) + "," + _moved(n) for n in range(3))}, {_near(3)},
names AS (
    SELECT c, sha256(string_agg(CAST(y AS VARCHAR), ',' ORDER BY d)) AS h FROM c3 GROUP BY c
)
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance,
       CAST(sum(distance) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia, h AS centroid_sha256
FROM a3 JOIN kept USING (r) JOIN names USING (c)
"""
