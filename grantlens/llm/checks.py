"""DuckDB SQL for the queries that SQL can express."""

_AZ = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lowered(column: str) -> str:
    return _AZ.format(column)


SQL: dict[str, str] = {}

SQL["op1_decontaminate"] = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all({lowered("coalesce(text, '')")}, '{_ALNUM}') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({lowered("coalesce(text, '')")}, '{_ALNUM}') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS win
       FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS win
       FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
hit AS (SELECT r, i, dw.n, item_id FROM dw JOIN bw ON dw.win = bw.win AND dw.n = bw.n),
words AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS k FROM hit) GROUP BY r),
items AS (SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS names FROM hit GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""

_AFTER = "substr(url, instr(url, '://') + 3)"
SQL["op5_url_rules"] = f"""
WITH rules(rhost, rpath, verdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
                                     ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
p AS (SELECT page_id, row_number() OVER () AS r, CASE WHEN contains(url, '://') THEN {_AFTER} ELSE '' END AS rest FROM pages),
q AS (SELECT page_id, r, {lowered("regexp_extract(rest, '^[^/?#]*')")} AS host, regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM p),
m AS (SELECT r, rhost || rpath AS rule, verdict, row_number() OVER (PARTITION BY r ORDER BY length(rhost || rpath) DESC, length(rhost) DESC) AS k
      FROM q JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM q LEFT JOIN (SELECT * FROM m WHERE k = 1) USING (r)
"""


def _centroids(clusters: int = 40, rounds: int = 5) -> str:
    """Lloyd's rounds over integer vectors, each distance computed anew."""
    nearest = """a{r} AS MATERIALIZED (SELECT id, v, arg_min(cluster, (d, cluster)) AS cluster, min(d) AS distance
      FROM (SELECT k.id, k.v, c.cluster, list_sum(list_transform(list_zip(k.v, c.c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM k, c{r} c) GROUP BY id, v)"""
    means = """m{r} AS MATERIALIZED (SELECT cluster, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS c
      FROM (SELECT cluster, i, sum(v[i])::BIGINT AS s, count(*) AS n FROM a{r}, range(1, 65) t(i) GROUP BY cluster, i) GROUP BY cluster),
    c{q} AS MATERIALIZED (SELECT c{r}.cluster, coalesce(m{r}.c, c{r}.c) AS c FROM c{r} LEFT JOIN m{r} USING (cluster))"""
    steps = ",\n".join([f"{nearest.format(r=r)},\n{means.format(r=r, q=r + 1)}" for r in range(rounds)] + [nearest.format(r=rounds)])
    return f"""
WITH k AS MATERIALIZED (SELECT row_number() OVER () AS id, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
      WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x::DOUBLE))) = 64),
c0 AS MATERIALIZED (SELECT (row_number() OVER (ORDER BY h NULLS LAST, v) - 1)::INTEGER AS cluster, v AS c
      FROM (SELECT sha256('2:' || vec_id::VARCHAR) AS h, v FROM k) ORDER BY h NULLS LAST, v LIMIT {clusters}),
{steps}
SELECT k.vec_id, a.cluster::INTEGER AS cluster, a.distance, (sum(a.distance) OVER (PARTITION BY a.cluster))::BIGINT AS cluster_inertia,
       (sum(a.distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(c.c, ',')) AS centroid_sha256
FROM a{rounds} a JOIN k USING (id) JOIN c{rounds} c ON a.cluster = c.cluster
"""


SQL["op11_centroids"] = _centroids()

_FIELD = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen({0}::VARCHAR) || ':' || {0}::VARCHAR END"


def _row(text: str) -> str:
    return f"sha256({' || '.join(_FIELD.format(c) for c in ('doc_id', 'source', 'lang', 'n_chars'))} || {_FIELD.format(text)})"


# crc is the usual reflected checksum, byte by byte from a table made by eight halvings of each number.
SQL["op13_merkle"] = f"""
WITH RECURSIVE halved(i, k, v) AS (SELECT i, 0, i::BIGINT FROM range(256) t(i)
      UNION ALL SELECT i, k + 1, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END FROM halved WHERE k < 8),
crc AS MATERIALIZED (SELECT list(v ORDER BY i) AS t FROM halved WHERE k = 8),
summed AS MATERIALIZED (SELECT doc_id, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
      lambda a, b: xor(a // 256, t[xor(a % 256, b) + 1])), 4294967295) AS sum FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL), crc),
d AS MATERIALIZED (SELECT row_number() OVER () AS id, doc_id, source, {_row('text')} AS leaf,
      CASE WHEN sum % 2 = 0 THEN {_row("replace(text, chr(10), '')")} ELSE {_row('text')} END AS changed FROM documents LEFT JOIN summed USING (doc_id)),
placed AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS size FROM d),
grown(source, level, pos, size, hash) AS (SELECT source, 0, pos, size, leaf FROM placed
      UNION ALL SELECT source, level + 1, pos // 3, any_value((size + 2) // 3), sha256(string_agg(hash, '' ORDER BY pos)) FROM grown WHERE size > 1 GROUP BY source, level, pos // 3),
subroots AS MATERIALIZED (SELECT source, level AS height, hash, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS size FROM grown WHERE size = 1),
over_all(level, pos, size, hash) AS (SELECT 0, pos, size, hash FROM subroots
      UNION ALL SELECT level + 1, pos // 3, any_value((size + 2) // 3), sha256(string_agg(hash, '' ORDER BY pos)) FROM over_all WHERE size > 1 GROUP BY level, pos // 3),
root AS (SELECT hash FROM over_all WHERE size = 1),
parents AS MATERIALIZED (SELECT source, level, pos // 3 AS parent, list(hash ORDER BY pos) AS run, min(pos) AS first FROM grown WHERE size > 1 GROUP BY source, level, pos // 3),
tops AS MATERIALIZED (SELECT level, pos // 3 AS parent, list(hash ORDER BY pos) AS run, min(pos) AS first FROM over_all WHERE size > 1 GROUP BY level, pos // 3),
steps AS (SELECT p.id, r.level AS step, r.run, p.pos // (3 ** r.level)::BIGINT - r.first + 1 AS k FROM placed p JOIN parents r
            ON r.source IS NOT DISTINCT FROM p.source AND r.parent = p.pos // (3 ** (r.level + 1))::BIGINT
          UNION ALL SELECT p.id, s.height + t.level, t.run, s.pos // (3 ** t.level)::BIGINT - t.first + 1 FROM placed p
            JOIN subroots s ON s.source IS NOT DISTINCT FROM p.source JOIN tops t ON t.parent = s.pos // (3 ** (t.level + 1))::BIGINT),
path AS MATERIALIZED (SELECT id, step, array_to_string(list_slice(run, 1, k - 1), '') AS l, array_to_string(list_slice(run, k + 1, len(run)), '') AS r FROM steps),
proof AS (SELECT id, string_agg(l || r, '' ORDER BY step) AS told FROM path GROUP BY id),
folded(id, step, hash) AS (SELECT id, 0, changed FROM placed
      UNION ALL SELECT f.id, f.step + 1, sha256(l || f.hash || r) FROM folded f JOIN path p ON p.id = f.id AND p.step = f.step),
last AS (SELECT id, arg_max(hash, step) AS hash FROM folded GROUP BY id)
SELECT p.doc_id, p.leaf, s.hash AS subroot, (SELECT hash FROM root) AS root, sha256(coalesce(told, '')) AS proof_sha256,
       last.hash AS folded_root, last.hash = (SELECT hash FROM root) AS verified
FROM placed p JOIN subroots s ON s.source IS NOT DISTINCT FROM p.source JOIN last USING (id) LEFT JOIN proof USING (id)
"""


def _near(percent: int, columns: str) -> str:
    """Components and links over all pairs of rows that share a shingle."""
    return rf"""
WITH RECURSIVE d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({lowered("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT r, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT r, count(*) AS n FROM s GROUP BY r),
links AS MATERIALIZED (SELECT x, y FROM (SELECT a.r AS x, b.r AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.r <> b.r GROUP BY a.r, b.r)
      JOIN n nx ON nx.r = x JOIN n ny ON ny.r = y WHERE 100 * c >= {percent} * (nx.n + ny.n - c)),
reach(x, y) AS (SELECT r, r FROM d UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x),
parts AS (SELECT x AS r, min(doc_id) AS component_id FROM reach JOIN d ON d.r = reach.y GROUP BY x),
of AS (SELECT x AS r, count(*) AS n_links FROM links GROUP BY x)
SELECT doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, {columns} FROM d JOIN parts USING (r) LEFT JOIN n USING (r) LEFT JOIN of USING (r)
"""


SQL["op6_near_duplicates"] = _near(75, "coalesce(n_links, 0)::BIGINT AS n_links")
SQL["op12_near_duplicates"] = _near(85, "doc_id = component_id AS kept")
