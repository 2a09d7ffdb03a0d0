"""SQL for the queries that SQL can express."""

ORACLES = {
    "op5_voronoi_knn": """
        WITH whole AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
            FROM whole q JOIN whole c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
        )
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
        FROM scored QUALIFY rank <= 10
    """,
    "op10_line_runs": r"""
        WITH lines AS (
            SELECT doc_id, n, line,
                translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS n FROM documents)
        ), repeated AS (
            SELECT key, min(doc_id) AS owner FROM lines WHERE length(key) >= 10 GROUP BY key HAVING min(doc_id) < max(doc_id)
        )
        SELECT l.doc_id, count(*) AS n_lines, count(r.key) FILTER (r.owner <> l.doc_id) AS n_dropped,
            sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (r.key IS NULL OR r.owner = l.doc_id), '')) AS kept_sha256
        FROM lines l LEFT JOIN repeated r USING (key) GROUP BY l.doc_id
    """,
    "op3_tensored_minhash": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
            FROM documents
        ), shingles AS (
            SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
                ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s FROM words
        ), sizes AS (
            SELECT doc_id, count(s) AS n FROM words LEFT JOIN shingles USING (doc_id) GROUP BY doc_id
        ), links AS (
            SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id
            JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
            WHERE 5 * least(x.n, y.n) >= 4 * greatest(x.n, y.n)
            GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))
        ), both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links
        ), reached AS (
            SELECT doc_id, doc_id AS other FROM sizes UNION SELECT r.doc_id, e.b FROM reached r JOIN both_ways e ON e.a = r.other
        )
        SELECT doc_id, any_value(n) AS n_shingles, min(other) AS component_id, doc_id = min(other) AS kept
        FROM reached JOIN sizes USING (doc_id) GROUP BY doc_id
    """,
    "op11_length_strata": r"""
        WITH own AS (
            SELECT row_number() OVER () AS n, doc_id,
                regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL
        ), docs AS (SELECT * FROM own WHERE len(w) > 0
        ), total AS (SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM docs
        ), asked AS (
            SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS term
            FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL
        ), postings AS (
            SELECT n, any_value(doc_id) AS doc_id, any_value(size) AS size, term, count(*) AS tf
            FROM (SELECT n, doc_id, len(w) AS size, unnest(w) AS term FROM docs) SEMI JOIN asked USING (term) GROUP BY n, term
        ), weights AS (
            SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM postings, total GROUP BY term
        ), scored AS (
            SELECT item_id, n, any_value(doc_id) AS doc_id,
                CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * size * n_docs) // n_terms)))) AS BIGINT) AS score
            FROM postings JOIN weights USING (term) JOIN asked USING (term), total GROUP BY item_id, n
        )
        SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
        FROM scored WHERE score > 0 QUALIFY rank <= 10
    """,
}
