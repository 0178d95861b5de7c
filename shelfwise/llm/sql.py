"""The repeats and contamination of whole tables in SQL, for small ones."""

from __future__ import annotations

SPACES = r"[\x20\x09-\x0D]+"
WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _covered(units: str, window: int, between: str) -> str:
    """``covered`` from ``units(doc_id, i, x)``: whether a window that a smaller id has covers the unit."""
    return f"""units AS ({units}),
    windows AS (SELECT * FROM (
        SELECT doc_id, i, string_agg(x, '{between}') OVER w AS k, count(*) OVER w AS n FROM units
        WINDOW w AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND {window - 1} FOLLOWING)) WHERE n = {window}),
    firsts AS (SELECT k, min(doc_id) AS d FROM windows GROUP BY k),
    later AS (SELECT doc_id, i FROM windows JOIN firsts USING (k) WHERE doc_id > d),
    covered AS (SELECT u.doc_id, u.i, u.x, max(CASE WHEN l.i IS NULL THEN 0 ELSE 1 END) OVER (
        PARTITION BY u.doc_id ORDER BY u.i ROWS BETWEEN {window - 1} PRECEDING AND CURRENT ROW) AS gone
        FROM units u LEFT JOIN later l ON l.doc_id = u.doc_id AND l.i = u.i)"""


def substring_sql(window: int = 13) -> str:
    units = f"""SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS x FROM (
        SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '{SPACES}'), lambda x: x <> '') AS w FROM documents)"""
    return f"""WITH {_covered(units, window, ' ')}
    SELECT d.doc_id, count(c.i) AS n_words, CAST(coalesce(sum(gone), 0) AS BIGINT) AS n_removed,
           sha256(coalesce(string_agg(x, ' ' ORDER BY c.i) FILTER (WHERE gone = 0), '')) AS kept_sha256
    FROM documents d LEFT JOIN covered c USING (doc_id) GROUP BY d.doc_id"""


def suffix_sql(length: int = 50) -> str:
    units = """SELECT doc_id, unnest(range(1, CAST(length(h) / 2 AS BIGINT) + 1)) AS i, unnest(regexp_extract_all(h, '..')) AS x FROM (
        SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents)"""
    return f"""WITH {_covered(units, length, '')},
    runs AS (SELECT *, lag(gone, 1, 0) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM covered)
    SELECT d.doc_id, count(c.i) AS n_bytes, CAST(coalesce(sum(gone), 0) AS BIGINT) AS n_removed,
           count(CASE WHEN gone = 1 AND before = 0 THEN 1 END) AS n_spans,
           sha256(unhex(coalesce(string_agg(x, '' ORDER BY c.i) FILTER (WHERE gone = 0), ''))) AS kept_sha256
    FROM documents d LEFT JOIN runs c USING (doc_id) GROUP BY d.doc_id"""


def contamination_sql(window: int = 13, share: int = 20) -> str:
    words = lambda key, source: f"""SELECT {key}, len(w) AS n, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS x FROM (
        SELECT {key}, regexp_extract_all({LOWERED}, '{WORDS}') AS w FROM {source})"""  # noqa: E731
    sized = lambda key, source, n: f"""SELECT * FROM (SELECT {key}, i, {n} AS size, n, string_agg(x, ' ') OVER w AS k, count(*) OVER w AS held FROM {source}
        WINDOW w AS (PARTITION BY {key} ORDER BY i ROWS BETWEEN CURRENT ROW AND {n - 1} FOLLOWING)) WHERE held = {n}"""  # noqa: E731
    phrases = " UNION ALL ".join(f"({sized('item_id', 'item_words', n)} AND n {'>=' if n == window else '='} {n})" for n in range(1, window + 1))
    places = " UNION ALL ".join(f"({sized('doc_id', 'doc_words', n)} AND {n} IN (SELECT size FROM phrases))" for n in range(1, window + 1))
    return f"""WITH item_words AS ({words('item_id', 'benchmark')}), doc_words AS ({words('doc_id', 'documents')}),
    phrases AS ({phrases}), places AS ({places}),
    found AS (SELECT DISTINCT doc_id, p.i, p.size, item_id FROM places p JOIN phrases b ON b.k = p.k AND b.size = p.size),
    named AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items
              FROM found GROUP BY doc_id),
    hit AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS place FROM found) GROUP BY doc_id),
    sizes AS (SELECT doc_id, len(regexp_extract_all({LOWERED}, '{WORDS}')) AS n_words FROM documents)
    SELECT doc_id, n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
           coalesce(n_hit, 0) > 0 AND {share} * coalesce(n_hit, 0) >= n_words AS contaminated
    FROM sizes LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)"""


def _integers(scale: int) -> str:
    return f"list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT))"


FINITE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"


def codes_sql(parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256) -> str:
    """Plain assignment of every part to every entry."""
    away = "list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""near{r} AS MATERIALIZED (SELECT i, b.p, min(CAST({away} AS BIGINT) * {entries} + e) AS k FROM cut JOIN book{r} b USING (p) GROUP BY i, b.p)""")
        if r < rounds:
            steps.append(f"""mean{r} AS (SELECT p, e, list(m ORDER BY j) AS c FROM (
                SELECT p, e, j, CAST(floor(sum(y) / count(*)) AS BIGINT) AS m FROM (
                    SELECT n.p, n.k % {entries} AS e, unnest(x) AS y, unnest(range(len(x))) AS j FROM near{r} n JOIN cut USING (i, p)) GROUP BY p, e, j) GROUP BY p, e),
            book{r + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(m.c, b.c) AS c FROM book{r} b LEFT JOIN mean{r} m ON m.p = b.p AND m.e = b.e)""")
    return f"""WITH kept AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS i, vec_id, label, {_integers(scale)} AS v FROM embeddings WHERE {FINITE}),
    cut AS MATERIALIZED (SELECT i, p, v[p * (len(v) // {parts}) + 1:(p + 1) * (len(v) // {parts})] AS x FROM kept, range({parts}) t(p)),
    book0 AS MATERIALIZED (SELECT p, i AS e, x AS c FROM cut WHERE i < {entries}),
    {", ".join(steps)},
    coded AS (SELECT i, string_agg(printf('%02x', k % {entries}), '' ORDER BY p) AS code, CAST(sum(k // {entries}) AS BIGINT) AS error FROM near{rounds} GROUP BY i),
    digest AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS h FROM book{rounds})
    SELECT vec_id, label, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, (SELECT h FROM digest) AS codebooks_sha256
    FROM coded JOIN kept USING (i)"""


def clusters_sql(clusters: int = 40, dims: int = 64, rounds: int = 5, scale: int = 256, seed: str = "2") -> str:
    """Plain assignment of every vector to every centroid."""
    away = "list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    steps = []
    for r in range(rounds + 1):
        steps.append(f"near{r} AS MATERIALIZED (SELECT i, min(CAST({away} AS BIGINT) * {clusters} + e) AS k FROM kept, book{r} GROUP BY i)")
        if r < rounds:
            steps.append(f"""mean{r} AS (SELECT e, list(m ORDER BY j) AS c FROM (
                SELECT e, j, CAST(floor(sum(y) / count(*)) AS BIGINT) AS m FROM (
                    SELECT k % {clusters} AS e, unnest(v) AS y, unnest(range(len(v))) AS j FROM near{r} JOIN kept USING (i)) GROUP BY e, j) GROUP BY e),
            book{r + 1} AS MATERIALIZED (SELECT b.e, coalesce(m.c, b.c) AS c FROM book{r} b LEFT JOIN mean{r} m ON m.e = b.e)""")
    return f"""WITH kept AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id)) - 1 AS i, vec_id, {_integers(scale)} AS v
        FROM embeddings WHERE {FINITE} AND len(embedding) = {dims}),
    book0 AS MATERIALIZED (SELECT i AS e, v AS c FROM kept WHERE i < {clusters}),
    {", ".join(steps)},
    assigned AS (SELECT i, CAST(k % {clusters} AS INT) AS cluster, k // {clusters} AS distance FROM near{rounds})
    SELECT vec_id, cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia, CAST(sum(distance) OVER () AS BIGINT) AS inertia,
           sha256(array_to_string(c, ',')) AS centroid_sha256
    FROM assigned JOIN kept USING (i) JOIN book{rounds} ON e = cluster"""


def jaccard_sql(size: int = 5, percent: int = 80) -> str:
    """All pairs that share a shingle, counted; then the smallest id by steps over the links."""
    return f"""WITH RECURSIVE words AS (SELECT doc_id, list_filter(regexp_split_to_array({LOWERED}, '{SPACES}'), lambda x: x <> '') AS w FROM documents),
    shingles AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(w[i:i + {size - 1}], ' ') AS s
        FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {size - 2}, 2))) AS i FROM words WHERE len(w) > 0)),
    sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    links AS MATERIALIZED (SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2) p
        JOIN sizes m ON m.doc_id = a JOIN sizes o ON o.doc_id = b WHERE 100 * k >= {percent} * (m.n + o.n - k)),
    reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)
    SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id
    FROM documents d LEFT JOIN sizes USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) USING (doc_id)"""
