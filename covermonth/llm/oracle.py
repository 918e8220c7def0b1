"""DuckDB SQL for the queries on vectors and addresses."""

from __future__ import annotations

# Whole-number vectors, and rounds of assignment and averaging.
_WHOLE = """
    SELECT *, list_transform(embedding,
        lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
    FROM embeddings
    WHERE embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"""

_ASSIGNED = """
    a{turn} AS (
        SELECT vec_id, part, x, MIN({{'d': CAST(list_sum(list_transform(list_zip(x, c),
            lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT), 'e': entry}}) AS m
        FROM p JOIN c{turn} USING (part) GROUP BY ALL
    )"""

_MOVED = """
    m{turn} AS (
        SELECT part, entry, list(CAST((s - ((s % n + n) % n)) // n AS BIGINT) ORDER BY k) AS c
        FROM (SELECT part, m.e AS entry, k, SUM(x[k]) AS s, COUNT(*) AS n
              FROM a{turn}, range(1, 5) r(k) GROUP BY ALL) GROUP BY ALL
    ), c{next} AS (
        SELECT part, entry, COALESCE(m{turn}.c, c{turn}.c) AS c
        FROM c{turn} LEFT JOIN m{turn} USING (part, entry)
    )"""

CODES = f"""
    WITH v AS ({_WHOLE}
    ), p AS (
        SELECT vec_id, label, part, q[4 * part + 1:4 * part + 4] AS x FROM v, range(16) r(part)
    ), c0 AS (
        SELECT part, rank - 1 AS entry, x AS c FROM (
            SELECT *, ROW_NUMBER() OVER (PARTITION BY part ORDER BY vec_id) AS rank FROM p)
        WHERE rank <= 64
    ), {_ASSIGNED.format(turn=0)}, {_MOVED.format(turn=0, next=1)},
    {_ASSIGNED.format(turn=1)}, {_MOVED.format(turn=1, next=2)}, {_ASSIGNED.format(turn=2)},
    e AS (
        SELECT vec_id, string_agg(printf('%02x', m.e), '' ORDER BY part) AS code,
            CAST(SUM(m.d) AS BIGINT) AS error FROM a2 GROUP BY vec_id
    ), h AS (
        SELECT sha256(string_agg(CAST(c[k] AS VARCHAR), ',' ORDER BY part, entry, k)) AS hash
        FROM c2, range(1, 5) r(k)
    )
    SELECT vec_id, code, error,
        CAST(SUM(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
        hash AS codebooks_sha256
    FROM e JOIN v USING (vec_id), h
"""

NEGATIVES = f"""
    WITH v AS (
        SELECT vec_id, q,
            CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label
        FROM ({_WHOLE}) WHERE label IS NOT NULL
    ), s AS (
        SELECT a.vec_id AS anchor_id, v.vec_id AS id, a.label = v.label AS same,
            CAST(list_sum(list_transform(list_zip(a.q, v.q), lambda z: z[1] * z[2]))
                AS BIGINT) AS score
        FROM v a JOIN v ON a.vec_id % 50 = 0 AND a.vec_id <> v.vec_id
    ), p AS (
        SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
        QUALIFY ROW_NUMBER() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
    )
    SELECT anchor_id, positive_id,
        CAST(ROW_NUMBER() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)
            AS INTEGER) AS rank,
        id AS negative_id, positive_score, score AS negative_score
    FROM p JOIN s USING (anchor_id)
    WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
    QUALIFY rank <= 3
"""

# Links with the path steps . and .. are taken as they stand.
REDIRECTS = r"""
    WITH RECURSIVE u AS (
        SELECT page_id, html, CASE WHEN instr(url, '://') > 0
            THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
    ), h AS (
        SELECT page_id, html, translate(regexp_extract(rest, '^([^/?#]*)', 1),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
            regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
            regexp_extract(rest, '^[^?#]*(\?[^#]*)', 1) AS query
        FROM u
    ), pg AS (
        SELECT *, CASE WHEN host <> '' THEN regexp_replace(host, ':(80|443)?$', '')
            || CASE WHEN path = '' THEN '/' ELSE path END
            || CASE WHEN query = '?' THEN '' ELSE query END END AS node,
            CASE WHEN instr(lower(html), '<body') > 0
                THEN substr(html, 1, instr(lower(html), '<body')) ELSE html END AS head
        FROM h
    ), t AS (
        SELECT node, host, path, unnest(regexp_extract_all(
            regexp_replace(head, '(?s)<!--.*?-->', '', 'g'),
            '(?i)<(?:link|meta)\s[^<>]*>')) AS tag FROM pg
    ), l AS (
        SELECT node, host, path, replace(CASE
            WHEN regexp_matches(tag, '(?i)^<link') AND regexp_matches(tag, '(?i)\srel\s*=\s*'
                || '("([^"]*\s)?canonical(\s[^"]*)?"|''([^'']*\s)?canonical(\s[^'']*)?'''
                || '|canonical[\s/>])')
            THEN regexp_extract(tag, '(?i)\shref\s*=\s*["'']?([^"''\s<>]*)', 1)
            WHEN regexp_matches(tag, '(?i)^<meta')
                AND regexp_matches(tag, '(?i)\shttp-equiv\s*=\s*["'']?refresh["''\s/>]')
            THEN regexp_extract(tag, '(?i)url\s*=\s*["'']?([^"''<>]*)', 1) END,
            '&amp;', '&') AS link
        FROM t
    ), f AS (
        SELECT node, CASE WHEN regexp_matches(link, '(?i)^https?://') THEN link
            WHEN starts_with(link, '//') THEN 'http:' || link
            WHEN regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN NULL
            WHEN starts_with(link, '/') THEN 'http://' || host || link
            WHEN regexp_matches(link, '^[?#]') THEN 'http://' || host || path || link
            ELSE 'http://' || host || CASE WHEN regexp_extract(path, '^(.*/)', 1) = ''
                THEN '/' ELSE regexp_extract(path, '^(.*/)', 1) END || link END AS url
        FROM l WHERE link <> '' AND node IS NOT NULL
    ), g AS (
        SELECT node AS a, regexp_replace(translate(regexp_extract(url, '://([^/?#]*)', 1),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ':(80|443)?$', '')
            || CASE WHEN regexp_extract(url, '://[^/?#]*([^?#]*)', 1) = '' THEN '/'
                ELSE regexp_extract(url, '://[^/?#]*([^?#]*)', 1) END
            || CASE WHEN regexp_extract(url, '://[^?#]*(\?[^#]*)', 1) = '?' THEN ''
                ELSE regexp_extract(url, '://[^?#]*(\?[^#]*)', 1) END AS b
        FROM f WHERE url IS NOT NULL
    ), e AS (SELECT a, b FROM g UNION SELECT b, a FROM g
    ), r AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a
    ), n AS (
        SELECT b AS node, '.' || regexp_extract(b, '^([^/]*)', 1) AS host,
            regexp_extract(b, '^[^/]*([^?]*)', 1) AS path FROM (SELECT DISTINCT b FROM e)
        UNION ALL SELECT page_id::VARCHAR || ' page', '.' || host, path FROM h
    ), j AS (
        SELECT DISTINCT node, CASE
            WHEN ends_with(host, '.example.org') AND starts_with(path, '/en/1')
                THEN 'block example.org/en/1'
            WHEN ends_with(host, '.example.org') AND starts_with(path, '/es/')
                THEN 'block example.org/es/'
            WHEN ends_with(host, '.com') AND starts_with(path, '/fr/') THEN 'allow com/fr/'
            WHEN ends_with(host, '.com') AND starts_with(path, '/de/') THEN 'block com/de/'
            WHEN ends_with(host, '.org') AND starts_with(path, '/') THEN 'allow org/' END AS rule
        FROM n
    ), blocked AS (
        SELECT r.a AS node, MIN(r.b) AS blocked_by
        FROM r JOIN j ON j.node = r.b AND starts_with(j.rule, 'block') GROUP BY r.a
    )
    SELECT page_id, host, path, substr(j.rule, 7) AS rule,
        COALESCE(substr(j.rule, 1, 5),
            CASE WHEN blocked_by IS NULL THEN 'allow' ELSE 'block' END) AS verdict,
        CASE WHEN j.rule IS NULL THEN blocked_by END AS blocked_by
    FROM pg JOIN j ON j.node = pg.page_id::VARCHAR || ' page'
        LEFT JOIN blocked ON blocked.node = pg.node
"""
