from pyspark.sql import functions as F

from fieldmart.llm.common import table
from fieldmart.llm.wumanber import contamination


def op9_decontamination(spark, sf_dir):
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
i AS (SELECT item_id, {_WORDS} AS ws FROM benchmark),
p AS (SELECT DISTINCT item_id, array_to_string(ws[k:k + least(len(ws), 10) - 1], ' ') AS win, least(len(ws), 10) AS n
      FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS k FROM i WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT n FROM p),
g AS (SELECT doc_id, n, k, array_to_string(ws[k:k + n - 1], ' ') AS win
      FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS k FROM d, sizes WHERE len(ws) >= n)),
o AS (SELECT g.doc_id, g.k, g.n, p.item_id FROM g JOIN p ON g.win = p.win AND g.n = p.n),
h AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS j FROM o) GROUP BY doc_id),
t AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, array_to_string(list_sort(list(DISTINCT item_id::VARCHAR)), ',') AS items FROM o GROUP BY doc_id)
SELECT d.doc_id, len(d.ws)::BIGINT AS n_words, coalesce(h.n_hit, 0)::BIGINT AS n_hit, coalesce(t.n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(t.items, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""

QUERIES = [("op9_decontamination", op9_decontamination, SQL)]
