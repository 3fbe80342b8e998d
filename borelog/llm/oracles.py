"""SQL that gives the same rows as the registered queries."""

_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
OP2 = f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM d),
k AS (
    SELECT *, translate(trim(line, {_SPACE}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
),
s AS (SELECT key, min(doc_id) AS owner FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1),
m AS (SELECT k.*, coalesce(k.doc_id > owner, false) AS dropped FROM k LEFT JOIN s ON k.key = s.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT dropped), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
OP4 = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
g AS (SELECT text, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(d.text) AS text_sha256
FROM d JOIN g ON d.text = g.text
"""


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
OP6 = f"""
WITH RECURSIVE d AS (
    SELECT doc_id, list_filter(string_split_regex({_LOWER}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents
),
s AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM d
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (
    SELECT x, y FROM c JOIN n p ON c.x = p.doc_id JOIN n q ON c.y = q.doc_id WHERE 100 * c.c >= 75 * (p.n + q.n - c.c)
),
r AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x),
m AS (SELECT x AS doc_id, min(y) AS component_id FROM r GROUP BY x)
SELECT m.doc_id, coalesce(n, 0) AS n_shingles, component_id, m.doc_id = component_id AS kept
FROM m LEFT JOIN n ON m.doc_id = n.doc_id
"""


def _found(kind: str, place: int, pattern: str, keep: str) -> str:
    return f"""
    SELECT doc_id, {place} AS place, '{kind}' AS kind, m AS match,
        list_sum(list_transform(gaps[1:i], lambda x: length(x)))
        + coalesce(list_sum(list_transform(matches[1:i - 1], lambda x: length(x))), 0) AS start
    FROM (
        SELECT doc_id, matches, gaps, unnest(matches) AS m, generate_subscripts(matches, 1) AS i
        FROM (SELECT doc_id, regexp_extract_all(text, {pattern}) AS matches, string_split_regex(text, {pattern}) AS gaps FROM d)
    ) WHERE {keep}"""


_ASSIGN = r"""'((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)'"""
OP8 = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
f AS (
    {_found('assign', 0, _ASSIGN, f"length(regexp_extract(m, {_ASSIGN}, 2)) >= 6")}
    UNION ALL {_found('access', 1, "'AKIA[A-Z0-9]+'", "length(m) >= 20")}
    UNION ALL {_found('hex', 2, "'[0-9a-f]+'", "length(m) >= 24")}
),
s AS (
    SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
        count(*) FILTER (kind = 'hex') AS n_hex,
        string_agg(kind || ':' || start::BIGINT || ':' || (start + length(match))::BIGINT, ',' ORDER BY start, place) AS spans
    FROM f GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
    coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN s ON d.doc_id = s.doc_id
"""

OP9 = """
WITH d AS (
    SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents
),
v AS (
    SELECT doc_id, unnest(range(1, len(w) - 48)) AS i,
        unnest(list_transform(range(1, len(w) - 48), lambda i: md5(array_to_string(w[i:i + 49], ' ')))) AS g
    FROM d WHERE len(w) >= 50
),
o AS (SELECT g, min(doc_id) AS owner FROM v GROUP BY g HAVING count(DISTINCT doc_id) > 1),
r AS (SELECT doc_id, list(i) AS starts FROM v JOIN o ON v.g = o.g WHERE doc_id > owner GROUP BY doc_id),
c AS (SELECT DISTINCT doc_id, unnest(range(s, s + 50)) AS i FROM (SELECT doc_id, unnest(starts) AS s FROM r)),
x AS (SELECT d.doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
k AS (
    SELECT x.doc_id, string_agg(word, ' ' ORDER BY x.i) FILTER (c.i IS NULL) AS kept, count(c.i) AS n_removed
    FROM x LEFT JOIN c ON x.doc_id = c.doc_id AND x.i = c.i GROUP BY x.doc_id
)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k ON d.doc_id = k.doc_id
"""

OP11 = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
l AS (
    SELECT doc_id, text, regexp_extract_all(text, '[^\n]*\n|[^\n]+') AS lines, ('0x' || h[1:8])::BIGINT AS h1,
        ('0x' || h[9:16])::BIGINT AS h2, ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM d
),
c AS (
    SELECT *, len(lines) AS n, least(h1 % (len(lines) + 1), h2 % (len(lines) + 1)) AS a,
        greatest(h1 % (len(lines) + 1), h2 % (len(lines) + 1)) AS b,
        CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100
            THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM l
),
p AS (
    SELECT doc_id, text, n, form, coalesce(array_to_string(lines[1:a], ''), '') AS pre,
        coalesce(array_to_string(lines[a + 1:b], ''), '') AS mid, coalesce(array_to_string(lines[b + 1:], ''), '') AS suf FROM c
)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
    sha256(text) AS restored_sha256
FROM p
"""

OP12 = """
WITH u AS (SELECT page_id, coalesce(url, '') AS url FROM pages),
h AS (
    SELECT page_id, translate(regexp_extract(url, '://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(url, '://([^/?#]*)([^?#]*)', 2) AS path FROM u
),
r AS (
    SELECT *, CASE
        WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
        WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
        WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
        WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
        WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/' END AS rule FROM h
),
g AS (
    SELECT *, CASE WHEN rule IS NOT NULL OR NOT starts_with(path, '/') THEN NULL WHEN contains(host, 'cheap-pills') THEN '*cheap-pills*/**'
        WHEN contains(host, 'free-bets') THEN '*free-bets*/**' WHEN contains(host, 'casino') THEN '*casino*/**' END AS mark FROM r
)
SELECT page_id, host, path, rule, mark AS "glob",
    CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL OR mark IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
FROM g
"""

_APART = "list_sum(list_transform(list_zip(q.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT"


def _assigned(number: int) -> str:
    return f"""
a{number} AS (
    SELECT i, vec_id, v, d[1] AS distance, d[2] AS k FROM (
        SELECT q.i, any_value(q.vec_id) AS vec_id, any_value(q.v) AS v, min([{_APART}, c.k]) AS d FROM q, c{number} c GROUP BY q.i
    )
)"""


def _moved(number: int) -> str:
    return f"""
c{number + 1} AS (
    SELECT k, list(((s - ((s % n) + n) % n) // n) ORDER BY pos) AS v FROM (
        SELECT k, pos, sum(x)::BIGINT AS s, count(*) AS n FROM (SELECT k, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM a{number}) GROUP BY k, pos
    ) GROUP BY k
    UNION ALL SELECT k, v FROM c{number} WHERE k NOT IN (SELECT k FROM a{number})
)"""


_ROUNDS = ",".join(step(i) for i in range(10) for step in (_assigned, _moved))
OP13 = f"""
WITH q AS (
    SELECT row_number() OVER () AS i, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
    FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x) AND abs(x) < 16384)) = 64
),
c0 AS (
    SELECT (row_number() OVER (ORDER BY sha256('3:' || coalesce(vec_id::VARCHAR, '')), v) - 1)::BIGINT AS k, v FROM q
    QUALIFY row_number() OVER (ORDER BY sha256('3:' || coalesce(vec_id::VARCHAR, '')), v) <= 8
),{_ROUNDS},{_assigned(10)},
s AS (SELECT k, sum(distance)::BIGINT AS cluster_inertia FROM a10 GROUP BY k)
SELECT vec_id, a10.k::INTEGER AS cluster, distance, cluster_inertia, (SELECT sum(distance) FROM a10)::BIGINT AS inertia,
    sha256(array_to_string(c10.v, ',')) AS centroid_sha256
FROM a10 JOIN s ON a10.k = s.k JOIN c10 ON a10.k = c10.k
"""

ORACLES = {
    "op2_line_dedup": OP2, "op4_exact_dedup": OP4, "op6_minhash": OP6, "op8_secret_scan": OP8, "op9_substring_dedup": OP9,
    "op11_fill_in_middle": OP11, "op12_url_filter": OP12, "op13_centroids": OP13,
}
