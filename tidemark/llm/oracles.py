"""The SQL of corpus queries, where SQL can state them."""


def clustering(k=8, rounds=10, seed=3, dims=64, scale=1024):
    """Full comparison of all vectors with all centroids, round by round."""
    difference = "CAST(list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT)"
    steps = [f"""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dims}),
c0 AS MATERIALIZED (
  SELECT j, v AS c FROM (SELECT v, row_number() OVER (ORDER BY sha256('{seed}:' || vec_id) NULLS LAST, v) - 1 AS j FROM kept) WHERE j < {k})"""]
    for t in range(rounds + 1):
        steps.append(f"""a{t} AS MATERIALIZED (
  SELECT rid, any_value(vec_id) AS vec_id, any_value(v) AS v, min({{'d': {difference}, 'j': j}}) AS near FROM kept, c{t} GROUP BY rid)""")
        if t < rounds:
            steps.append(f"""s{t} AS MATERIALIZED (
  SELECT j, list((s - ((s % n) + n) % n) // n ORDER BY p) AS c
  FROM (SELECT near.j AS j, p, sum(x) AS s, count(*) AS n
        FROM (SELECT near, unnest(v) AS x, generate_subscripts(v, 1) AS p FROM a{t}) GROUP BY 1, 2) GROUP BY j),
c{t + 1} AS MATERIALIZED (
  SELECT o.j, list_transform(coalesce(s.c, o.c), lambda x: CAST(x AS BIGINT)) AS c FROM c{t} o LEFT JOIN s{t} s ON o.j = s.j)""")
    return "WITH " + ",\n".join(steps) + f"""
SELECT vec_id, CAST(near.j AS INTEGER) AS cluster, near.d AS distance,
       CAST(sum(near.d) OVER (PARTITION BY near.j) AS BIGINT) AS cluster_inertia, CAST(sum(near.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds}, c{rounds} WHERE near.j = c{rounds}.j"""


def prefix_trie(every=5, heads=9):
    """All prefixes of all rebuilt conversations, and every node counted at each of its ancestors."""
    step = "list_reduce(list_concat([xor(crc, b)], range(8)), lambda r, i: xor(r >> 1, 3988292384 * (r & 1)))"
    crc = f"""xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(c::VARCHAR, ''), lambda s: ascii(s)::BIGINT)),
    lambda crc, b: {step}))"""
    return f"""WITH turns AS (
  SELECT conv_id AS c, turn, coalesce(role, '') AS r, coalesce(text, '') AS x, sha256(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS id
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT c, list({{'id': id, 'size': strlen(x)}} ORDER BY turn NULLS FIRST, id) AS s FROM turns GROUP BY c),
heads AS (SELECT c, s, {crc} % {heads} AS h FROM own),
seqs AS MATERIALIZED (
  SELECT o.c, list_concat(coalesce(list_slice(b.s, 1, o.h), []), list_slice(o.s, o.h + 1, len(o.s))) AS s
  FROM heads o LEFT JOIN own b ON b.c = o.c - o.c % {every}),
prefixes AS (
  SELECT c, d, sha256(array_to_string(list_transform(list_slice(s, 1, d), lambda t: t.id), ',')) AS key, d = len(s) AS ends, CASE WHEN d > 0 THEN s[d].size ELSE 0 END AS size,
         CASE WHEN d > 0 THEN sha256(array_to_string(list_transform(list_slice(s, 1, d - 1), lambda t: t.id), ',')) END AS up
  FROM (SELECT c, s, unnest(range(len(s) + 1)) AS d FROM seqs)),
nodes AS MATERIALIZED (
  SELECT d, key, any_value(up) AS up, min(c) AS conv, count(*) AS n, (count(*) - 1) * any_value(size) AS saved,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE ends), '')) AS digest
  FROM prefixes GROUP BY d, key),
kids AS (SELECT d - 1 AS d, up AS key, count(*) AS k FROM nodes WHERE d > 0 GROUP BY 1, 2),
full_nodes AS MATERIALIZED (SELECT n.*, coalesce(k, 0) AS k FROM nodes n LEFT JOIN kids USING (d, key)),
paths AS (SELECT DISTINCT p.d, p.key, q.d AS a, q.key AS above FROM prefixes p JOIN prefixes q ON p.c = q.c AND q.d <= p.d),
below AS (
  SELECT a AS d, above AS key, sum(saved) AS saved, count(*) FILTER (WHERE k = 0) AS leaves
  FROM paths JOIN full_nodes USING (d, key) GROUP BY 1, 2)
SELECT n.conv AS conv_id, n.d AS depth, p.conv AS parent_conv_id, n.n AS n_convs, n.k AS n_children, b.leaves AS n_leaves,
       CAST(b.saved AS BIGINT) AS saved_tokens, n.digest AS ends_sha256
FROM full_nodes n JOIN below b ON n.d = b.d AND n.key = b.key LEFT JOIN nodes p ON p.d = n.d - 1 AND p.key = n.up"""
