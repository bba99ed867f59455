"""SQL for the queries that it can express."""

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"



def _vector_codes(rounds: int) -> str:
    """Plain k-means over every part and entry."""
    steps = ["""kept AS (
            SELECT vec_id, label, len(embedding) // 16 AS w,
                list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
        ), part AS (
            SELECT vec_id, label, p, v[p * w + 1:p * w + w] AS x FROM kept, range(16) AS t(p)
        ), book0 AS (
            SELECT p, e, x FROM (SELECT p, x, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e FROM part) WHERE e < 64
        )"""]
    for i in range(rounds + 1):
        steps.append(f"""far{i} AS (
            SELECT vec_id, label, p, e, part.x AS x,
                list_sum(list_transform(range(1, len(part.x) + 1), lambda i: (part.x[i] - b.x[i]) * (part.x[i] - b.x[i]))) AS d
            FROM part JOIN book{i} b USING (p)
        ), near{i} AS (
            SELECT vec_id, label, p, x, min(d) AS d, arg_min(e, d * 64 + e) AS e FROM far{i} GROUP BY ALL
        )""")
        if i < rounds:
            steps.append(f"""cell{i} AS (
            SELECT p, e, unnest(range(1, len(x) + 1)) AS i, unnest(x) AS c FROM near{i}
        ), mean{i} AS (
            SELECT p, e, list(c ORDER BY i) AS x
            FROM (SELECT p, e, i, CAST(floor(CAST(sum(c) AS DOUBLE) / count(*)) AS BIGINT) AS c FROM cell{i} GROUP BY 1, 2, 3)
            GROUP BY 1, 2
        ), book{i + 1} AS (
            SELECT b.p AS p, b.e AS e, coalesce(m.x, b.x) AS x FROM book{i} b LEFT JOIN mean{i} m ON m.p = b.p AND m.e = b.e
        )""")
    return f"""
        WITH {", ".join(steps)}, coded AS (
            SELECT vec_id, label, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
            FROM near{rounds} GROUP BY 1, 2
        )
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
            (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) FROM book{rounds}) AS codebooks_sha256
        FROM coded"""


ORACLE = {
    "op13_vector_codes": _vector_codes(rounds=2),
    "op5_minhash": rf"""
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents
        ), sets AS (
            SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
                ELSE list_distinct([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) END AS s FROM words
        ), classes AS (
            SELECT s, list_sort(s) AS k, min(doc_id) OVER (PARTITION BY list_sort(s)) AS rep, doc_id, len(s) AS n FROM sets
        ), grams AS (
            SELECT rep, n, unnest(s) AS g FROM classes WHERE doc_id = rep
        ), pairs AS (
            SELECT a.rep AS a, b.rep AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS c
            FROM grams a JOIN grams b ON a.g = b.g AND a.rep < b.rep
                AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n) GROUP BY 1, 2
        ), links AS (
            SELECT a, b FROM pairs WHERE 100 * c >= 80 * (na + nb - c)
        ), around AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links
        ), reach(node, c) AS (
            SELECT DISTINCT a, a FROM around UNION SELECT e.b, r.c FROM reach r JOIN around e ON e.a = r.node
        ), component AS (SELECT node, min(c) AS c FROM reach GROUP BY 1)
        SELECT doc_id, n AS n_shingles,
            CASE WHEN n = 0 THEN doc_id ELSE coalesce(c, rep) END AS component_id,
            doc_id = CASE WHEN n = 0 THEN doc_id ELSE coalesce(c, rep) END AS kept
        FROM classes LEFT JOIN component ON node = rep""",
    "op8_suffix_dedup": """
        WITH bytes AS (
            SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n FROM documents
        ), windows AS (
            SELECT doc_id, i, substr(h, 2 * i + 1, 200) AS w FROM (SELECT doc_id, h, unnest(range(n - 99)) AS i FROM bytes WHERE n >= 100)
        ), repeated AS (
            SELECT doc_id, i FROM windows QUALIFY row_number() OVER (PARTITION BY md5(w) ORDER BY doc_id, i) > 1
        ), steps AS (
            SELECT doc_id, i, lead(i) OVER own AS after, lag(i) OVER own AS before
            FROM repeated WINDOW own AS (PARTITION BY doc_id ORDER BY i)
        ), gone AS (
            SELECT doc_id, sum(least(100, coalesce(after - i, 100))) AS n_removed,
                count(*) FILTER (WHERE before IS NULL OR i > before + 100) AS n_spans
            FROM steps GROUP BY 1
        ), pieces AS (
            SELECT doc_id, i, substr(h, 2 * coalesce(before + 100, 0) + 1, 2 * (i - coalesce(before + 100, 0))) AS piece
            FROM steps JOIN bytes USING (doc_id) WHERE i > coalesce(before + 100, 0)
            UNION ALL SELECT doc_id, n, substr(h, 2 * (i + 100) + 1) FROM steps JOIN bytes USING (doc_id) WHERE after IS NULL
        ), kept AS (
            SELECT doc_id, string_agg(piece, '' ORDER BY i) AS k FROM pieces GROUP BY 1
        )
        SELECT doc_id, n AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
            sha256(unhex(CASE WHEN n_removed IS NULL THEN h ELSE coalesce(k, '') END)) AS kept_sha256
        FROM bytes LEFT JOIN gone USING (doc_id) LEFT JOIN kept USING (doc_id)""",
    "op10_substring_dedup": f"""
        WITH words AS (SELECT doc_id, {WORDS} AS w FROM documents
        ), windows AS (
            SELECT doc_id, unnest(range(1, len(w) - 11)) AS i, w FROM words WHERE len(w) >= 13
        ), keys AS (
            SELECT doc_id, i, md5(array_to_string(w[i:i + 12], ' ')) AS k FROM windows
        ), repeated AS (
            SELECT doc_id, i FROM (SELECT *, min(doc_id) OVER (PARTITION BY k) AS first FROM keys) WHERE first < doc_id
        ), gone AS (
            SELECT DISTINCT doc_id, i + j AS p FROM repeated, range(13) t(j)
        ), each_word AS (
            SELECT doc_id, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS word FROM words WHERE len(w) > 0
        ), kept AS (
            SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t, count(*) AS n
            FROM each_word ANTI JOIN gone USING (doc_id, p) GROUP BY 1
        )
        SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
        FROM words LEFT JOIN kept USING (doc_id)""",
}
