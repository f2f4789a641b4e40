"""The queries that SQL can express, for DuckDB."""

ORACLE = {
    "op1_exact_dedup": r"""
        WITH t AS (
            SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
        )
        SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = min(doc_id) OVER same AS kept, sha256(norm) AS text_sha256
        FROM t WINDOW same AS (PARTITION BY norm)
    """,
    "op7_line_rules": r"""
        WITH d AS (
            SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, coalesce(source, '') AS host
            FROM documents
        ),
        w AS (SELECT rid, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM d),
        win AS (
            SELECT rid, i, array_to_string(list_slice(words, i, i + 7), ' ') AS win
            FROM (SELECT rid, words, unnest(range(1, len(words) - 6)) AS i FROM w)
        ),
        twice AS (
            SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, win) AS n FROM win) WHERE n > 1
        ),
        rep AS (
            SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY rid
        ),
        ln AS (
            SELECT rid, host, line,
                   lower(trim(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g'))) AS norm
            FROM (SELECT rid, host, unnest(string_split(text, chr(10))) AS line FROM d)
            WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
        ),
        dup AS (SELECT rid, count(*) - count(DISTINCT line) AS n FROM ln GROUP BY rid),
        hosts AS (SELECT host, count(*) AS size FROM d GROUP BY host),
        freq AS (
            SELECT host, norm FROM ln JOIN hosts USING (host) GROUP BY host, norm, size
            HAVING count(DISTINCT rid) > 30 AND 1000 * count(DISTINCT rid) > size
        ),
        lost AS (
            SELECT rid, sum(len(string_split(norm, ' '))) AS n FROM ln JOIN freq USING (host, norm) GROUP BY rid
        ),
        f AS (
            SELECT d.doc_id, len(words)::BIGINT AS n_words,
                   length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
                   (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
                   coalesce(dup.n, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
                   coalesce(lost.n, 0)::BIGINT AS n_lost_words
            FROM d JOIN w USING (rid) LEFT JOIN rep USING (rid) LEFT JOIN dup USING (rid) LEFT JOIN lost USING (rid)
        )
        SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
               NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words)
               AND NOT (n_lost_words > 0
                        AND (100 * n_lost_words > 50 * n_words OR n_words - n_lost_words < 20)) AS kept
        FROM f
    """,
    "op10_revisits": r"""
        WITH p AS (
            SELECT page_id, regexp_replace(url, '#.*$', '') AS plain, '"' || md5(html) || '"' AS tag,
                   sha1(html) AS digest, strlen(html) AS bytes, page_id * 60 AS sent
            FROM pages
        ),
        k AS (
            SELECT *, regexp_replace(regexp_replace(regexp_replace(
                       lower(regexp_extract(plain, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)', 1)), '^.*@', ''),
                       '^www[0-9]*[.]', ''),
                       CASE WHEN plain ILIKE 'http://%' THEN ':80$' WHEN plain ILIKE 'https://%' THEN ':443$'
                            ELSE '$' END, '')
                   || coalesce(nullif(regexp_extract(plain, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*(.*)$', 1), ''), '/') AS key
            FROM p
        ),
        r AS (
            SELECT a.page_id, a.key, a.sent + 86400 AS date,
                   CASE a.page_id % 3 WHEN 2 THEN '"other"' ELSE a.tag END AS bare,
                   CASE a.page_id % 3 WHEN 0 THEN a.tag WHEN 1 THEN 'W/' || a.tag ELSE '"other"' END AS tag,
                   max(b.page_id) AS last
            FROM k a LEFT JOIN k b
              ON a.key = b.key AND (b.sent < a.sent + 86400
                                    OR b.sent = a.sent + 86400 AND b.page_id * 2 < a.page_id * 2 + 1)
            GROUP BY ALL
        )
        SELECT r.page_id * 2 + 1 AS record_id, r.key AS url_key, r.date,
               CASE WHEN s.page_id IS NULL THEN 'no response' WHEN s.tag = r.bare THEN 'resolved'
                    ELSE 'validator differs' END AS outcome,
               CASE WHEN s.tag = r.bare THEN s.page_id * 2 END AS response_id,
               CASE WHEN s.tag = r.bare THEN s.digest END AS digest,
               CASE WHEN s.tag = r.bare THEN 'cache-control=max-age=120;content-length=' || s.bytes
                   || ';content-type=text/html;date=' || r.date || ';etag=' || r.tag END AS headers
        FROM r LEFT JOIN k s ON s.page_id = r.last
    """,
}


def _clustering(clusters: int = 16, rounds: int = 3) -> str:
    """Centroid clustering written out round by round; a distance and its centroid travel as one number."""
    parts = [
        r"""e AS MATERIALIZED (
            SELECT rid, vec_id, d, CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) AS x
            FROM (
                SELECT rid, vec_id, unnest(range(64)) AS d, unnest(embedding) AS x
                FROM (SELECT row_number() OVER () AS rid, * FROM embeddings WHERE len(embedding) = 64)
            )
            WINDOW r AS (PARTITION BY rid) QUALIFY count(x) OVER r = 64 AND bool_and(isfinite(x)) OVER r
        )""",
        f"""c0 AS MATERIALIZED (
            SELECT c, d, x FROM e JOIN (
                SELECT rid, row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS c
                FROM (SELECT DISTINCT rid, vec_id FROM e) QUALIFY c < {clusters}
            ) USING (rid)
        )""",
    ]
    for k in range(rounds + 1):
        parts.append(
            f"""a{k} AS MATERIALIZED (
            SELECT rid, vec_id, min(far * {clusters} + c) % {clusters} AS c, min(far * {clusters} + c) // {clusters} AS far
            FROM (
                SELECT rid, vec_id, c, CAST(sum((e.x - m.x) * (e.x - m.x)) AS BIGINT) AS far
                FROM e JOIN c{k} m USING (d) GROUP BY rid, vec_id, c
            ) GROUP BY rid, vec_id
        )"""
        )
        if k < rounds:
            parts.append(
                f"""c{k + 1} AS MATERIALIZED (
            SELECT c, d, CAST((s - (s % n + n) % n) // n AS BIGINT) AS x
            FROM (SELECT c, d, sum(x) AS s, count(*) AS n FROM e JOIN a{k} USING (rid) GROUP BY c, d)
            UNION ALL SELECT c, d, x FROM c{k} WHERE c NOT IN (SELECT c FROM a{k})
        )"""
            )
    return (
        "WITH "
        + ", ".join(parts)
        + f"""
        SELECT vec_id, CAST(c AS INTEGER) AS cluster, far AS distance,
               CAST(sum(far) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
               CAST(sum(far) OVER () AS BIGINT) AS inertia, sha256(place) AS centroid_sha256
        FROM a{rounds} JOIN (
            SELECT c, string_agg(CAST(x AS VARCHAR), ',' ORDER BY d) AS place FROM c{rounds} GROUP BY c
        ) USING (c)
    """
    )


ORACLE["op11_centroids"] = _clustering()

ORACLE["op12_divergence"] = r"""
    WITH d AS (
        SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
        FROM documents
    ),
    t AS MATERIALIZED (
        SELECT rid, lang, source, term, count(*) AS n
        FROM (
            SELECT rid, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
        ) GROUP BY ALL
    ),
    k AS MATERIALIZED (SELECT lang, term, sum(n) AS n FROM t GROUP BY lang, term HAVING count(*) >= 3),
    l AS (SELECT lang, sum(n) AS total, count(*) AS kept FROM k GROUP BY lang),
    c AS MATERIALIZED (SELECT lang, source, term, sum(t.n) AS n FROM t JOIN k USING (lang, term) GROUP BY ALL),
    g AS (
        SELECT lang, source, coalesce(total, 0) AS total, coalesce(kept, 0) AS kept
        FROM (SELECT DISTINCT lang, source FROM d)
        LEFT JOIN (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL) USING (lang, source)
        LEFT JOIN (SELECT lang, kept FROM l) USING (lang)
    ),
    p AS MATERIALIZED (
        SELECT lang, source, term,
               CAST(1 + (1000000000 * (coalesce(c.n, 0) + 1)) // (g.total + g.kept) AS BIGINT) AS p
        FROM g JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)
    ),
    pair AS (
        SELECT a.lang, a.source, b.source AS item, coalesce(x.value, 0) AS value
        FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN (
            SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
            FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
        ) x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
    ),
    term AS (
        SELECT lang, source, term AS item, (p - q) * (p - q) // q AS value
        FROM (
            SELECT c.lang, c.source, c.term, p.p,
                   CAST(1 + (1000000000 * (k.n + 1)) // (l.total + l.kept) AS BIGINT) AS q
            FROM c JOIN p USING (lang, source, term) JOIN k USING (lang, term) JOIN l USING (lang)
        ) WHERE p > q
    ),
    every AS (SELECT *, 'pair' AS part FROM pair UNION ALL SELECT *, 'term' AS part FROM term)
    SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
           CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
    FROM every QUALIFY part = 'pair' OR rank <= 200
"""
