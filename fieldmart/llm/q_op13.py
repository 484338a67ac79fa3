from fieldmart.llm.common import table
from fieldmart.llm.nsbounds import cluster

ROUNDS = 5


def op13_centroids(spark, sf_dir):
    return cluster(table(spark, sf_dir, "embeddings"), clusters=40, rounds=ROUNDS, seed="2")


def _assignment(name: str, centroids: str) -> str:
    return f"""{name} AS (SELECT v.id, arg_min(c.k, (v.xx - 2 * list_inner_product(v.x, c.x) + list_inner_product(c.x, c.x))::BIGINT * 1000 + c.k) AS k,
      min((v.xx - 2 * list_inner_product(v.x, c.x) + list_inner_product(c.x, c.x))::BIGINT) AS d FROM v, {centroids} c GROUP BY v.id)"""


def _moved(name: str, assigned: str, before: str) -> str:
    return f"""{name} AS (SELECT b.k, coalesce(m.x, b.x) AS x FROM {before} b LEFT JOIN (
      SELECT k, list(x ORDER BY i) AS x FROM (SELECT k, i, ((s - ((s % n) + n) % n) // n)::DOUBLE AS x FROM (
        SELECT k, i, sum(e)::BIGINT AS s, count(*) AS n FROM (SELECT a.k, unnest(range(64)) AS i, unnest(v.x)::BIGINT AS e FROM v JOIN {assigned} a USING (id)) GROUP BY k, i)) GROUP BY k) m USING (k))"""


_STEPS = ",\n".join(x for r in range(ROUNDS) for x in (_assignment(f"a{r}", f"c{r}"), _moved(f"c{r + 1}", f"a{r}", f"c{r}")))
SQL = f"""
WITH w AS (SELECT vec_id, list_transform(embedding, lambda y: y::DOUBLE) AS e FROM embeddings WHERE len(embedding) = 64),
q AS (SELECT vec_id, list_transform(e, lambda y: floor(256 * y)) AS x FROM w WHERE len(list_filter(e, lambda y: y IS NULL OR isnan(y) OR isinf(y))) = 0),
v AS MATERIALIZED (SELECT row_number() OVER () AS id, vec_id, x, list_inner_product(x, x) AS xx FROM q),
c0 AS (SELECT row_number() OVER (ORDER BY h, x) - 1 AS k, x FROM (SELECT sha256('2:' || coalesce(vec_id::VARCHAR, '')) AS h, x FROM v ORDER BY h, x LIMIT 40)),
{_STEPS},
{_assignment("f", f"c{ROUNDS}")},
p AS (SELECT c.k, sha256(array_to_string(list_transform(c.x, lambda y: y::BIGINT::VARCHAR), ',')) AS digest FROM c{ROUNDS} c)
SELECT v.vec_id, f.k::INTEGER AS cluster, f.d AS distance, (sum(f.d) OVER (PARTITION BY f.k))::BIGINT AS cluster_inertia, (sum(f.d) OVER ())::BIGINT AS inertia, p.digest AS centroid_sha256
FROM v JOIN f USING (id) JOIN p USING (k)
"""

QUERIES = [("op13_centroids", op13_centroids, SQL)]
