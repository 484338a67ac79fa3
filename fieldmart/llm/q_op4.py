from pyspark.sql import functions as F

from fieldmart.llm.common import shared_folder, table
from fieldmart.llm.secrets import count_of, findings, flat, scan


def op4_secrets(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    ledger = shared_folder(spark, "ledger")
    scan(docs, ledger)
    found = findings(docs, ledger)
    return found.select("doc_id", *[count_of(k).alias(f"n_{k}") for k in ("assign", "access", "hex")], F.sha2(flat(), 256).alias("base_sha256"), flat().alias("spans"))


def _kind(kind: str, place: int, pattern: str, group: int, least: int) -> str:
    return f"""SELECT doc_id, '{kind}' AS kind, {place} AS place, start, start + size AS stop FROM (
      SELECT doc_id, unnest(list_transform(w, lambda x, i: coalesce(list_sum(list_transform(p[1:i], lambda y: len(y))), 0) + coalesce(list_sum(list_transform(w[1:i - 1], lambda y: len(y))), 0))) AS start,
             unnest(list_transform(w, lambda x: len(x))) AS size, unnest(list_transform(t, lambda x: len(x))) AS tested
      FROM (SELECT doc_id, regexp_extract_all(text, '{pattern}', 0) AS w, regexp_extract_all(text, '{pattern}', {group}) AS t, regexp_split_to_array(text, '{pattern}') AS p FROM d)) WHERE tested >= {least}"""


SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
f AS ({_kind("assign", 0, r'((?i:password|passwd|secret|token|api_?key))["\x27]?\x20*[:=]\x20*["\x27]?([A-Za-z0-9+/_.=-]+)', 2, 8)}
  UNION ALL {_kind("access", 1, r"AKIA[A-Z0-9]+", 0, 16)}
  UNION ALL {_kind("hex", 2, r"[0-9a-f]{32,}", 0, 32)}),
g AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS a, count(*) FILTER (kind = 'access') AS b, count(*) FILTER (kind = 'hex') AS c,
      string_agg(kind || ':' || start::BIGINT || ':' || stop::BIGINT, ',' ORDER BY start, place) AS spans FROM f GROUP BY doc_id)
SELECT d.doc_id, coalesce(a, 0)::BIGINT AS n_assign, coalesce(b, 0)::BIGINT AS n_access, coalesce(c, 0)::BIGINT AS n_hex, sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (doc_id)
"""

QUERIES = [("op4_secrets", op4_secrets, SQL)]
