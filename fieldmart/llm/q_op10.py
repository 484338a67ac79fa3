from fieldmart.llm.common import table
from fieldmart.llm.minhash import near_duplicates


def op10_minhash(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"), words_per_shingle=4, percent=80)


SQL = r"""
WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')] ELSE list_distinct(list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i+3], ' '))) END AS items FROM w),
g AS (SELECT min(doc_id) AS node, list_sort(items) AS items FROM s WHERE len(items) > 0 GROUP BY list_sort(items)),
e AS (SELECT node, len(items) AS n, unnest(items) AS item FROM g),
c AS (SELECT a.node AS x, b.node AS y, a.n + b.n AS total, count(*) AS shared FROM e a JOIN e b ON a.item = b.item AND a.node < b.node GROUP BY ALL),
l AS (SELECT x, y FROM c WHERE 100 * shared >= 80 * (total - shared)),
b AS (SELECT x, y FROM l UNION SELECT y, x FROM l),
r AS (SELECT a, z FROM (WITH RECURSIVE t(a, z) AS (SELECT node, node FROM g UNION SELECT t.a, b.y FROM t JOIN b ON t.z = b.x) SELECT * FROM t)),
k AS (SELECT a AS node, min(z) AS component_id FROM r GROUP BY a),
m AS (SELECT s.doc_id, s.items, k.component_id FROM s LEFT JOIN g ON list_sort(s.items) = g.items LEFT JOIN k ON g.node = k.node)
SELECT doc_id, len(items)::BIGINT AS n_shingles, coalesce(component_id, doc_id) AS component_id, doc_id = coalesce(component_id, doc_id) AS kept FROM m
"""

QUERIES = [("op10_minhash", op10_minhash, SQL)]
