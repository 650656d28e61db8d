"""DuckDB SQL for the text queries that SQL can express."""

WORDS = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"

ORACLE = {
    "op1_mix_sources": rf"""
        WITH d AS (SELECT doc_id, source, text, {WORDS} AS size FROM documents),
        s AS (SELECT source, sum(size)::BIGINT AS source_size,
                     row_number() OVER (ORDER BY source NULLS LAST) AS turn FROM d GROUP BY source),
        r AS (SELECT *, [5, 2, 1][(turn - 1) % 3 + 1] AS weight, source_size * 2.0::DOUBLE AS room FROM s),
        l AS (SELECT *, row_number() OVER w AS place,
                     (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(room) OVER (w ROWS BETWEEN UNBOUNDED
                      PRECEDING AND 1 PRECEDING), 0)) / sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND
                      UNBOUNDED FOLLOWING) AS level
              FROM r WINDOW w AS (ORDER BY room / weight, source NULLS LAST)),
        t AS (SELECT source, source_size, room, weight,
                     (SELECT arg_min(level, place) FROM l WHERE level <= room / weight) AS common FROM l),
        g AS (SELECT source, source_size, least(weight * coalesce(common, 'infinity'::DOUBLE), room) AS target FROM t),
        c AS (SELECT d.doc_id, d.size, g.source_size, g.target, d.source,
                     CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0 END AS rate,
                     ('0x' || substr(md5('mix-1:' || coalesce(d.doc_id::VARCHAR, 'text ' || md5(d.text), 'none')),
                                     1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS draw
              FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source),
        e AS (SELECT *, (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END)::BIGINT AS copies FROM c)
        SELECT doc_id, size::BIGINT AS size, source_size, target, size * copies AS taken, source, copies FROM e
    """,
    "op12_max_score": """
        WITH v AS (SELECT vec_id, [floor(64 * x::DOUBLE)::BIGINT FOR x IN embedding] AS w FROM embeddings
                   WHERE len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
        s AS (SELECT q.vec_id AS query_id, c.vec_id,
                     coalesce(list_sum([q.w[i] * c.w[i] FOR i IN generate_series(1, least(len(q.w), len(c.w)))]),
                              0)::BIGINT AS score
              FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id IS DISTINCT FROM q.vec_id)
        SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id NULLS LAST))::INTEGER AS rank,
               vec_id, score
        FROM s QUALIFY rank <= 20
    """,
    # CRC-32 from its table; neighbours by words with one place left out.
    "op13_spelling_forms": r"""
        WITH RECURSIVE crc AS (SELECT i, 0 AS k, i AS c FROM range(256) t(i)
                     UNION ALL SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END
                     FROM crc WHERE k < 8),
        codes AS (SELECT list(c ORDER BY i) AS code FROM crc WHERE k = 8),
        runs AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                     'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents),
        told AS (SELECT doc_id, run, count(*) AS times FROM runs WHERE length(run) >= 6 GROUP BY doc_id, run),
        drawn AS (SELECT run, times, xor(4294967295, list_reduce(
                     flatten([CASE WHEN unicode(s) < 128 THEN [unicode(s)::BIGINT]
                              ELSE [192 + (unicode(s) >> 6), 128 + (unicode(s) & 63)]::BIGINT[] END
                              FOR s IN string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, '')]),
                     lambda h, b: xor(h >> 8, code[(xor(h, b) & 255) + 1]), 4294967295::BIGINT)) AS h
                  FROM told, codes),
        spelt AS (SELECT CASE WHEN h % 199 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2)
                         ELSE run END AS word, times FROM drawn),
        v AS (SELECT word, sum(times)::BIGINT AS n FROM spelt WHERE length(word) >= 6 GROUP BY word HAVING sum(times) >= 5),
        cut AS (SELECT word, i, left(word, i - 1) || substr(word, i + 1) AS rest
                FROM (SELECT word, unnest(generate_series(1, length(word))) AS i FROM v)),
        pairs AS (SELECT a.word, b.word AS near FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
                  UNION SELECT c.word, v.word FROM cut c JOIN v ON c.rest = v.word
                  UNION SELECT v.word, c.word FROM cut c JOIN v ON c.rest = v.word),
        best AS (SELECT p.word, count(*) AS n_near, arg_min(p.near, (-m.n, p.near)) AS near, max(m.n) AS near_n
                 FROM pairs p JOIN v m ON m.word = p.near GROUP BY p.word),
        forms AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 5 * v.n THEN near END AS form,
                         CASE WHEN near_n >= 5 * v.n THEN near_n END AS form_n FROM v LEFT JOIN best USING (word)),
        chain AS (SELECT word, form AS at FROM forms WHERE form IS NOT NULL
                  UNION ALL SELECT c.word, f.form FROM chain c JOIN forms f ON f.word = c.at WHERE f.form IS NOT NULL),
        ends AS (SELECT c.word, c.at FROM chain c JOIN forms f ON f.word = c.at WHERE f.form IS NULL)
        SELECT f.word, f.n, f.n_near, f.form, f.form_n, coalesce(e.at, f.word) AS root
        FROM forms f LEFT JOIN ends e USING (word)
    """,
}
