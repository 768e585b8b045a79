"""DuckDB SQL of the operators on vectors."""

from __future__ import annotations

from . import centroids, vector_codes

#: Division that goes down, for a sum s and a count n.
DOWN = "((s - ((s % n) + n) % n) // n)"
FINITE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"


def elkan_clusters_sql() -> str:
    c = centroids
    steps = [
        f"""v AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor({c.SCALE} * x::DOUBLE)::BIGINT) AS v FROM embeddings WHERE len(embedding) = {c.DIMS} AND {FINITE})""",
        f"""c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v AS m FROM (SELECT sha256('{c.SALT}:' || vec_id) AS h, v FROM v ORDER BY h, v LIMIT {c.CLUSTERS}))""",
    ]
    for r in range(c.ROUNDS + 1):
        steps.append(f"""a{r} AS MATERIALIZED (SELECT rid, min({{'d': list_sum(list_transform(list_zip(v, m), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT, 'c': c}}) AS near FROM v, c{r} GROUP BY rid)""")
        if r < c.ROUNDS:
            steps.append(f"""s{r} AS (SELECT near.c AS c, unnest(v) AS x, unnest(range(1, {c.DIMS + 1})) AS i FROM a{r} JOIN v USING (rid))""")
            steps.append(f"""n{r} AS (SELECT c, list({DOWN}::BIGINT ORDER BY i) AS moved FROM (SELECT c, i, sum(x)::HUGEINT AS s, count(*) AS n FROM s{r} GROUP BY c, i) GROUP BY c)""")
            steps.append(f"""c{r + 1} AS MATERIALIZED (SELECT c, coalesce(moved, m) AS m FROM c{r} LEFT JOIN n{r} USING (c))""")
    return f"""
WITH {", ".join(steps)}
SELECT vec_id, near.c::INT AS cluster, near.d AS distance, (sum(near.d) OVER (PARTITION BY near.c))::BIGINT AS cluster_inertia, (sum(near.d) OVER ())::BIGINT AS inertia,
  sha256(list_aggregate(m, 'string_agg', ',')) AS centroid_sha256
FROM a{c.ROUNDS} JOIN v USING (rid) JOIN c{c.ROUNDS} ON c = near.c"""


def vector_codes_sql() -> str:
    o = vector_codes
    steps = [
        f"""v AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, label, list_transform(embedding, lambda x: floor({o.SCALE} * x::DOUBLE)::BIGINT) AS v FROM embeddings WHERE {FINITE})""",
        f"""q AS MATERIALIZED (SELECT rid, p, v[p * w + 1:(p + 1) * w] AS v FROM (SELECT *, len(v) // {o.PARTS} AS w, unnest(range({o.PARTS})) AS p FROM v))""",
        f"""c0 AS MATERIALIZED (SELECT p, k, q.v AS m FROM (SELECT rid, row_number() OVER (ORDER BY vec_id, v) - 1 AS k FROM v ORDER BY vec_id, v LIMIT {o.ENTRIES}) JOIN q USING (rid))""",
    ]
    for r in range(o.ROUNDS + 1):
        steps.append(f"""a{r} AS MATERIALIZED (SELECT rid, p, min({{'d': list_sum(list_transform(list_zip(v, m), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT, 'k': k}}) AS near FROM q JOIN c{r} USING (p) GROUP BY rid, p)""")
        if r < o.ROUNDS:
            steps.append(f"""s{r} AS (SELECT p, near.k AS k, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{r} JOIN q USING (rid, p))""")
            steps.append(f"""n{r} AS (SELECT p, k, list({DOWN}::BIGINT ORDER BY i) AS moved FROM (SELECT p, k, i, sum(x)::HUGEINT AS s, count(*) AS n FROM s{r} GROUP BY p, k, i) GROUP BY p, k)""")
            steps.append(f"""c{r + 1} AS MATERIALIZED (SELECT p, k, coalesce(moved, m) AS m FROM c{r} LEFT JOIN n{r} USING (p, k))""")
    last = o.ROUNDS
    return f"""
WITH {", ".join(steps)},
e AS (SELECT rid, string_agg(lower(lpad(to_hex(near.k), 2, '0')), '' ORDER BY p) AS code, sum(near.d)::BIGINT AS error FROM a{last} GROUP BY rid),
b AS (SELECT sha256(string_agg(list_aggregate(m, 'string_agg', ','), ',' ORDER BY p, k)) AS codebooks_sha256 FROM c{last})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM e JOIN v USING (rid), b"""
