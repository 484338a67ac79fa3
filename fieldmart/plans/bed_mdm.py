"""Master data and dimensions on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldmart.operators import dims as D
from fieldmart.operators import mdm as M
from fieldmart.plans.bed import Bed, Tables

bed = Bed()
C = F.col


def _noisy(t):
    """Part names with noise by key: case and spaces, a typo, unknown text, none."""
    k = C("p_partkey") % 5
    raw = F.when(k == 0, F.upper("p_name")).when(k == 1, F.concat(F.lit("  "), "p_name")).when(k == 2, F.concat("p_name", F.lit("s"))).when(k == 3, F.concat(F.lit("zz"), "p_brand")).otherwise(F.lit(None))
    return t.part.select("p_partkey", raw.alias("raw"))


_NOISY = "(SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN upper(p_name) WHEN 1 THEN '  ' || p_name WHEN 2 THEN p_name || 's' WHEN 3 THEN 'zz' || p_brand END AS raw FROM part)"
_NAMES = "(SELECT DISTINCT p_name FROM part)"
_TOK = "array_to_string(list_sort(string_split(lower(trim({})), ' ')), ' ')"
_SIM = "1 - levenshtein(v, n) / greatest(len(v), len(n))::DOUBLE"


def _names(t):
    return t.part.select("p_name").distinct()


@bed.query(f"SELECT p_partkey, raw, n.p_name AS found FROM {_NOISY} LEFT JOIN {_NAMES} n ON upper(trim(raw)) = upper(n.p_name)")
def homologate_exact(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return M.match_exact(_noisy(t), _names(t), "raw", "p_name")


_FUZZY = f"""(SELECT raw, first(p_name ORDER BY s DESC, p_name) AS found, max(s) AS score FROM (SELECT raw, p_name, {_SIM} AS s FROM (SELECT DISTINCT raw, {_TOK.format('raw')} AS v FROM {_NOISY} WHERE raw IS NOT NULL), (SELECT p_name, {_TOK.format('p_name')} AS n FROM {_NAMES})) WHERE s >= 0.85 GROUP BY raw)"""


@bed.query(f"SELECT r.raw, found, round(score, 6) AS score FROM (SELECT DISTINCT raw FROM {_NOISY}) r LEFT JOIN {_FUZZY} f ON r.raw = f.raw")
def fuzzy_top1(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return M.match_fuzzy(_noisy(t), _names(t), "raw", "p_name").withColumn("score", F.round("score", 6))


@bed.query(f"""WITH v AS (SELECT DISTINCT raw, {_TOK.format('raw')} AS v FROM {_NOISY} WHERE raw IS NOT NULL), n AS (SELECT p_name, {_TOK.format('p_name')} AS n FROM {_NAMES}),
s AS (SELECT raw, p_name, {_SIM} AS s FROM v, n WHERE least(len(v), len(n)) >= 0.5 * greatest(len(v), len(n)) AND {_SIM} >= 0.5), b AS (SELECT raw, first(p_name ORDER BY s DESC, p_name) AS found, max(s) AS score FROM s GROUP BY raw)
SELECT r.raw, coalesce(found, CASE WHEN r.raw IS NOT NULL THEN 'Zz' || regexp_replace(r.raw, '^zz', '') END) AS suggestion, round(score, 6) AS score FROM (SELECT DISTINCT raw FROM {_NOISY}) r LEFT JOIN b ON r.raw = b.raw""")
def fuzzy_suggest(spark, sf_dir):
    t = Tables(spark, sf_dir)
    found = M.suggest(_noisy(t), _names(t), "raw", "p_name", 0.5)
    return found.select("raw", F.regexp_replace("suggestion", "^Zzbrand", "ZzBrand").alias("suggestion"), F.round("score", 6).alias("score"))


@bed.query("""WITH o AS (SELECT p_name AS raw, count(*) AS uses, min(CASE WHEN p_size > 25 THEN upper(p_name) END) AS ok, min(upper(p_name)) AS first FROM part WHERE p_partkey % 2 = 0 GROUP BY 1),
d AS (SELECT p_name AS raw, min(p_brand) AS canonical, false AS approved, 1 AS times_applied FROM part WHERE p_partkey % 3 = 0 GROUP BY 1)
SELECT coalesce(d.raw, o.raw) AS raw, coalesce(ok, canonical, first) AS canonical, coalesce(approved, false) OR ok IS NOT NULL AS approved, coalesce(times_applied, 0) + coalesce(uses, 0) AS times_applied FROM d FULL JOIN o ON d.raw = o.raw""")
def dictionary_merge(spark, sf_dir):
    p = Tables(spark, sf_dir).part
    outcomes = p.where("p_partkey % 2 = 0").select(C("p_name").alias("raw"), F.upper("p_name").alias("canonical"), (C("p_size") > 25).alias("approved"))
    dictionary = p.where("p_partkey % 3 = 0").groupBy(C("p_name").alias("raw")).agg(F.min("p_brand").alias("canonical")).withColumns({"approved": F.lit(False), "times_applied": F.lit(1)})
    return M.dictionary_merge(dictionary, outcomes)


@bed.query(f"""WITH d AS (SELECT upper(p_name) AS k, min(p_name) || '!' AS c FROM part WHERE p_name LIKE 'b%' AND length(p_name) % 3 = 0 GROUP BY 1)
SELECT p_partkey, r.raw, coalesce(d.c, n.p_name, f.found) AS canonical, CASE WHEN r.raw IS NULL THEN 'NULO' WHEN d.c IS NOT NULL THEN 'EXACTO' WHEN n.p_name IS NOT NULL THEN 'CATALOGO' WHEN f.found IS NOT NULL THEN 'LEVENSHTEIN' ELSE 'CUARENTENA' END AS match_state
FROM {_NOISY} r LEFT JOIN d ON upper(trim(r.raw)) = d.k LEFT JOIN {_NAMES} n ON upper(trim(r.raw)) = upper(n.p_name) LEFT JOIN {_FUZZY} f ON f.raw = r.raw""")
def homologate(spark, sf_dir):
    t = Tables(spark, sf_dir)
    size = F.length("p_name") % 3
    entries = t.part.where("p_name like 'b%'").select(C("p_name").alias("raw"), F.concat("p_name", F.lit("!")).alias("canonical"), F.lit("part").alias("source_table"), F.when(size == 0, "ana").when(size == 1, "PENDIENTE").alias("approved_by"))
    others = entries.withColumns({"source_table": F.lit("other"), "approved_by": F.lit("ana"), "canonical": F.lit("wrong")})
    return M.homologate(_noisy(t), "raw", entries.unionByName(others), "part", _names(t), "p_name")


_RULES = "(SELECT 'Brand#' || n_nationkey AS raw, 100 + n_nationkey AS module FROM nation WHERE n_nationkey % 4 = 0)"
_BANDS = "(SELECT 'Brand#' || n_nationkey AS raw, n_nationkey AS lo, n_nationkey + 20 AS hi, n_nationkey % 3 AS priority, 200 + n_nationkey AS module FROM nation WHERE n_nationkey % 4 = 1)"


def _rules(t):
    n = C("n_nationkey")
    raw = F.concat(F.lit("Brand#"), n).alias("raw")
    return t.nation.where(n % 4 == 0).select(raw, (n + 100).alias("module")), t.nation.where(n % 4 == 1).select(raw, n.alias("lo"), (n + 20).alias("hi"), (n % 3).alias("priority"), (n + 200).alias("module"))


@bed.query(f"""SELECT p_partkey, coalesce(r.module, b.module, regexp_extract(m, '(\\d+)$', 1)::INT) AS module_id, CASE WHEN r.module IS NOT NULL THEN 'RULE' WHEN b.module IS NOT NULL THEN 'BAND' WHEN m LIKE '%TEST%' THEN 'NONE' ELSE 'NUMBER' END AS module_source, m LIKE '%TEST%' AS test_block
FROM (SELECT *, CASE WHEN p_partkey % 10 = 0 THEN 'TEST A' ELSE p_brand END AS m FROM part) p LEFT JOIN {_RULES} r ON r.raw = m LEFT JOIN {_BANDS} b ON b.raw = m AND p_size BETWEEN lo AND hi""".replace("regexp_extract(m, '(\\d+)$', 1)::INT", "try_cast(nullif(regexp_extract(m, '(\\d+)$', 1), '') AS INT)"))
def rule_cascade(spark, sf_dir):
    t = Tables(spark, sf_dir)
    rules, bands = _rules(t)
    parts = t.part.select("p_partkey", "p_size", F.when(C("p_partkey") % 10 == 0, "TEST A").otherwise(C("p_brand")).alias("m"))
    return M.resolve_module(parts, rules, bands, "m", "p_size").select("p_partkey", "module_id", "module_source", "test_block")


@bed.query(f"""SELECT p_partkey, CASE WHEN source <> 'NOT_IN_CATALOGUE' THEN coalesce(r, b, n) END AS module_id, source AS module_source FROM (SELECT *, CASE WHEN r IS NOT NULL THEN 'RULE' WHEN b IS NOT NULL THEN 'BAND' WHEN n % 2 = 0 THEN 'NUMBER' ELSE 'NOT_IN_CATALOGUE' END AS source FROM
  (SELECT p_partkey, r.module AS r, b.module AS b, regexp_extract(p_brand, '(\\d+)$', 1)::INT AS n FROM part LEFT JOIN {_RULES} r ON r.raw = p_brand LEFT JOIN {_BANDS} b ON b.raw = p_brand AND p_size BETWEEN lo AND hi))""")
def rule_cascade_catalogue(spark, sf_dir):
    t = Tables(spark, sf_dir)
    rules, bands = _rules(t)
    catalogue = t.part.select(F.regexp_extract("p_brand", r"(\d+)$", 1).cast("int").alias("module")).where("module % 2 = 0")
    return M.resolve_module(t.part.select("p_partkey", "p_size", "p_brand"), rules, bands, "p_brand", "p_size", catalogue).select("p_partkey", "module_id", "module_source")


@bed.query(f"SELECT p_partkey, CASE WHEN p_partkey % 10 = 0 THEN -1 ELSE coalesce(r.module, regexp_extract(p_brand, '(\\d+)$', 1)::INT) END AS module_id FROM part LEFT JOIN {_RULES} r ON r.raw = p_brand")
def rule_override(spark, sf_dir):
    t = Tables(spark, sf_dir)
    parts = t.part.select("p_partkey", F.when(C("p_partkey") % 10 == 0, "Test block").otherwise(C("p_brand")).alias("m"))
    return M.normalise_geo(parts, _rules(t)[0], "m").select("p_partkey", "module_id")


@bed.query("""WITH d AS (SELECT c_nationkey AS n, c_mktsegment AS m, count(*) AS k, min(c_custkey) AS id FROM customer WHERE c_custkey % 11 = 0 GROUP BY ALL)
SELECT c_custkey, CASE WHEN k IS NULL THEN 'NOT_FOUND' WHEN k = 1 THEN 'UNIQUE' ELSE 'AMBIGUOUS' END AS match_state, CASE WHEN k = 1 THEN id END AS match_id FROM customer LEFT JOIN d ON c_nationkey = n AND c_mktsegment = m""")
def resolve_hierarchy(spark, sf_dir):
    c = Tables(spark, sf_dir).customer
    dim = c.where("c_custkey % 11 = 0").select(C("c_nationkey").alias("n"), C("c_mktsegment").alias("m"), C("c_custkey").alias("id"))
    return M.resolve_hierarchy(c, dim, {"c_nationkey": "n", "c_mktsegment": "m"}, "id").select("c_custkey", "match_state", "match_id")


@bed.query("""WITH d AS (SELECT s_nationkey AS m, s_suppkey % 3 AS farm, s_suppkey % 5 AS sector, s_suppkey AS id FROM supplier), a AS (SELECT c_custkey, c_nationkey AS m, c_custkey % 3 AS farm, CASE WHEN c_custkey % 4 > 0 THEN c_custkey % 5 END AS sector FROM customer),
j AS (SELECT c_custkey, count(id) AS k, min(id) AS id FROM a LEFT JOIN d ON a.m = d.m AND (a.farm = 0 OR a.farm = d.farm) AND (a.sector IS NULL OR a.sector = 0 OR a.sector = d.sector) GROUP BY 1)
SELECT c_custkey, CASE WHEN k = 0 THEN 'NOT_FOUND' WHEN k = 1 THEN 'UNIQUE' ELSE 'AMBIGUOUS' END AS match_state, CASE WHEN k = 1 THEN id END AS match_id FROM j""")
def resolve_optional_levels(spark, sf_dir):
    t = Tables(spark, sf_dir)
    dim = t.supplier.select(C("s_nationkey").alias("m"), (C("s_suppkey") % 3).alias("d_farm"), (C("s_suppkey") % 5).alias("d_sector"), C("s_suppkey").alias("id"))
    ask = t.customer.select("c_custkey", C("c_nationkey").alias("nation"), (C("c_custkey") % 3).alias("farm"), F.when(C("c_custkey") % 4 > 0, C("c_custkey") % 5).alias("sector"))
    return M.resolve_hierarchy(ask, dim, {"nation": "m"}, "id", {"farm": "d_farm", "sector": "d_sector"}).select("c_custkey", "match_state", "match_id")


@bed.query("""WITH d AS (SELECT p_brand, p_type, min(p_partkey) AS id FROM part WHERE p_partkey % 9 = 0 GROUP BY ALL), n AS (SELECT DISTINCT p_brand, p_type FROM part WHERE (p_brand, p_type) NOT IN (SELECT (p_brand, p_type) FROM d))
SELECT * FROM d UNION ALL SELECT p_brand, p_type, (SELECT max(id) FROM d) + row_number() OVER (ORDER BY p_brand, p_type) FROM n""")
def autocreate_members(spark, sf_dir):
    p = Tables(spark, sf_dir).part
    dim = p.where("p_partkey % 9 = 0").groupBy("p_brand", "p_type").agg(F.min("p_partkey").alias("id"))
    return M.autocreate(p, dim, ["p_brand", "p_type"], "id")


@bed.query("SELECT p_partkey, 999 + row_number() OVER (ORDER BY p_name, p_partkey) AS id FROM part")
def surrogate_keys(spark, sf_dir):
    return M.surrogate_keys(Tables(spark, sf_dir).part, ["p_name", "p_partkey"], 1000).select("p_partkey", "id")


@bed.query("SELECT DISTINCT l_partkey, s FROM (SELECT l_partkey, CASE WHEN l_suppkey % 10 = 0 THEN NULL ELSE l_suppkey END AS s FROM lineitem) a WHERE NOT EXISTS (SELECT 1 FROM lineitem b WHERE b.l_orderkey % 2 = 0 AND b.l_partkey = a.l_partkey AND (CASE WHEN b.l_suppkey % 10 = 0 THEN NULL ELSE b.l_suppkey END) IS NOT DISTINCT FROM a.s)")
def learn_unknown(spark, sf_dir):
    pairs = Tables(spark, sf_dir).lineitem.select("l_orderkey", "l_partkey", F.when(C("l_suppkey") % 10 != 0, C("l_suppkey")).alias("s"))
    return M.learn(pairs, pairs.where("l_orderkey % 2 = 0").select("l_partkey", "s"), ["l_partkey", "s"])


_DIM = "(SELECT s_nationkey::BIGINT AS parent, s_suppkey % 20 AS member, s_suppkey AS id FROM supplier)"
_ASK = "(SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_partkey % 13 = 0 THEN NULL ELSE l_partkey % 25 END AS parent, l_suppkey % 20 AS member, (l_quantity - 2)::BIGINT AS bed, l_partkey % 50 = 1 AS test FROM lineitem)"
_BRIDGE = "(SELECT s_suppkey AS id, unnest(range(1, 1 + s_suppkey % 40)) AS bed FROM supplier)"


def _geo(t):
    dim = t.supplier.select(C("s_nationkey").cast("bigint").alias("parent"), (C("s_suppkey") % 20).alias("member"), C("s_suppkey").alias("id"))
    ask = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.when(C("l_partkey") % 13 != 0, C("l_partkey") % 25).alias("parent"), (C("l_suppkey") % 20).alias("member"), (C("l_quantity") - 2).cast("bigint").alias("bed"))
    bridge = t.supplier.where("s_suppkey % 40 > 0").select(C("s_suppkey").alias("id"), F.explode(F.expr("sequence(1L, s_suppkey % 40)")).alias("bed"))
    return dim, ask, bridge


_FOUND = f"(SELECT a.*, g.k, g.id FROM {_ASK} a LEFT JOIN (SELECT parent, member, count(*) AS k, min(id) AS id FROM {_DIM} GROUP BY ALL) g ON a.parent IS NOT DISTINCT FROM g.parent AND a.member = g.member)"


_PLACES = "(SELECT s_suppkey AS id, s_suppkey % 12 AS module, CASE WHEN s_suppkey % 2 = 0 THEN s_suppkey % 3 END AS submodule, s_suppkey % 4 AS shift, (s_suppkey % 6)::VARCHAR AS valve, s_suppkey % 7 = 0 AS test_block FROM supplier)"
_ROWS = """(SELECT row_number() OVER () AS r, l_orderkey, l_linenumber, l_partkey, CASE WHEN l_partkey % 13 <> 0 THEN l_suppkey % 12 END AS module, CASE WHEN l_suppkey % 2 = 0 THEN l_suppkey % 3 END AS submodule, CASE WHEN l_partkey % 11 <> 0 THEN l_suppkey % 4 END AS shift,
  CASE WHEN l_partkey % 17 <> 0 THEN (l_suppkey % 6)::VARCHAR END AS valve, CASE l_linenumber WHEN 1 THEN NULL WHEN 2 THEN '0' WHEN 3 THEN 'x' ELSE (l_quantity::INT)::VARCHAR END AS bed, l_partkey % 5 = 0 AS test FROM lineitem)"""


@bed.query(f"""WITH g AS (SELECT a.*, (SELECT count(*) FROM {_PLACES} p WHERE NOT p.test_block AND p.module = a.module AND p.submodule IS NOT DISTINCT FROM a.submodule AND p.shift = a.shift AND p.valve = a.valve) AS n, (SELECT min(id) FROM {_PLACES} p WHERE NOT p.test_block AND p.module = a.module AND p.submodule IS NOT DISTINCT FROM a.submodule AND p.shift = a.shift AND p.valve = a.valve) AS id,
  (SELECT count(*) FROM {_PLACES} p WHERE p.test_block AND p.shift = a.shift AND p.valve = a.valve) AS tn, (SELECT min(id) FROM {_PLACES} p WHERE p.test_block AND p.shift = a.shift AND p.valve = a.valve) AS tid, try_cast(bed AS INT) AS b FROM {_ROWS} a)
SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN test THEN CASE WHEN shift IS NULL OR valve IS NULL THEN 'CLAVE_GEOGRAFICA_INCOMPLETA' WHEN tn = 1 THEN 'RESUELTA_TEST_BLOCK' WHEN tn = 0 THEN 'TEST_BLOCK_NO_MAPEADO' ELSE 'TEST_BLOCK_AMBIGUO' END
  WHEN module IS NULL THEN 'CASO_ESPECIAL_MODULO' WHEN shift IS NULL OR valve IS NULL THEN 'CLAVE_GEOGRAFICA_INCOMPLETA' WHEN n = 0 THEN 'GEOGRAFIA_NO_ENCONTRADA' WHEN n > 1 THEN 'GEOGRAFIA_AMBIGUA' WHEN bed IS NULL OR bed = '0' THEN 'RESUELTA_BASE_SIN_CAMA'
  WHEN b IS NULL OR b NOT BETWEEN 1 AND 45 THEN 'CAMA_NO_VALIDA' WHEN b % 10 = 0 THEN 'CAMA_NO_CATALOGO' WHEN b > id % 40 THEN 'CAMA_NO_RELACION' ELSE 'RESUELTA_BASE_Y_CAMA' END AS geo_state, CASE WHEN test THEN CASE WHEN tn = 1 THEN tid END WHEN n = 1 THEN id END AS geo_id FROM g""")
def resolve_states(spark, sf_dir):
    t = Tables(spark, sf_dir)
    k = C("s_suppkey")
    dim = t.supplier.select(k.alias("id"), (k % 12).alias("module"), F.when(k % 2 == 0, k % 3).alias("submodule"), (k % 4).alias("shift"), F.concat(F.lit(" 0"), k % 6).alias("valve"), (k % 7 == 0).alias("test_block"))
    l, p = C("l_suppkey"), C("l_partkey")
    bed_text = F.when(C("l_linenumber") == 1, F.lit(None)).when(C("l_linenumber") == 2, "0").when(C("l_linenumber") == 3, "x").otherwise(C("l_quantity").cast("int").cast("string"))
    ask = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.when(p % 13 != 0, l % 12).alias("module"), F.when(l % 2 == 0, l % 3).alias("submodule"), F.when(p % 11 != 0, l % 4).alias("shift"), F.when(p % 17 != 0, (l % 6).cast("string")).alias("valve"), bed_text.alias("bed"), (p % 5 == 0).alias("test_block"))
    beds = t.lineitem.select(C("l_quantity").cast("int").alias("bed")).distinct().where("bed % 10 <> 0")
    bridge = _geo(t)[2]
    return M.resolve_states(ask, dim, beds, bridge, 1, 45).select("l_orderkey", "l_linenumber", "l_partkey", "geo_state", "geo_id")


@bed.query(f"SELECT DISTINCT id, bed FROM {_FOUND} WHERE k = 1 AND bed BETWEEN 1 AND 45 AND NOT (bed <= id % 40)")
def bridge_upsert(spark, sf_dir):
    dim, ask, bridge = _geo(Tables(spark, sf_dir))
    return M.bridge_upsert(ask, dim, bridge, {"parent": "parent", "member": "member"}, "bed", 1, 45)[0]


@bed.query(f"SELECT CASE WHEN k IS NULL THEN 'NOT_FOUND' WHEN k > 1 THEN 'AMBIGUOUS' WHEN bed NOT BETWEEN 1 AND 45 THEN 'BED_INVALID' ELSE 'APT' END AS state, count(*) AS n FROM (SELECT DISTINCT parent, member, bed, k FROM {_FOUND}) GROUP BY 1")
def bridge_state_counts(spark, sf_dir):
    dim, ask, bridge = _geo(Tables(spark, sf_dir))
    return M.bridge_upsert(ask, dim, bridge, {"parent": "parent", "member": "member"}, "bed", 1, 45)[1]


@bed.query("SELECT count(*) AS rows, count(*) FILTER (bed NOT BETWEEN 1 AND 45) AS out_of_rule, (SELECT count(*) FROM (SELECT l_suppkey FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_quantity) > 48)) AS saturated, CASE WHEN count(*) FILTER (bed NOT BETWEEN 1 AND 45) > 0 THEN 'ERROR' ELSE 'OK' END AS status FROM (SELECT DISTINCT l_suppkey, l_quantity AS bed FROM lineitem)")
def bridge_quality(spark, sf_dir):
    pairs = Tables(spark, sf_dir).lineitem.select(C("l_suppkey").alias("id"), C("l_quantity").alias("bed")).distinct()
    return M.bridge_quality(pairs, 45, 48)


@bed.query("SELECT DISTINCT l_partkey % 100 AS m, l_suppkey AS s, 1 AS farm, 'NONE' AS sector FROM lineitem WHERE NOT (l_partkey % 100 < 50 AND l_suppkey < 50) AND NOT (l_partkey % 100 < 70 AND l_suppkey >= 50)")
def propose_missing(spark, sf_dir):
    pairs = Tables(spark, sf_dir).lineitem.select((C("l_partkey") % 100).alias("m"), C("l_suppkey").alias("s"))
    return M.propose_missing(pairs, pairs.where("m < 50 and s < 50"), pairs.where("m < 70 and s >= 50"), ["m", "s"], {"farm": 1, "sector": "NONE"})


@bed.query("""SELECT strftime(d, '%Y%m%d')::INT AS date_id, d AS day, year(d)::INT AS year, month(d)::INT AS month, week(d)::INT AS iso_week, isodow(d)::INT AS weekday, monthname(d) AS month_name, isodow(d) >= 6 AS weekend, n
FROM (SELECT o_orderdate::DATE AS d, count(*) AS n FROM orders WHERE o_orderdate BETWEEN '1996-01-01' AND '1998-12-31' GROUP BY 1)""")
def dim_time(spark, sf_dir):
    days = D.dim_time(spark, "1996-01-01", "1998-12-31").drop("harvest_week")
    per_day = Tables(spark, sf_dir).orders.groupBy(F.date_format("o_orderdate", "yyyyMMdd").cast("int").alias("date_id")).agg(F.count("*").alias("n"))
    return days.join(per_day, "date_id")


@bed.query("""WITH d AS (SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_custkey % 5 <> 0), s AS (SELECT c_custkey, c_name, CASE WHEN c_custkey % 7 = 0 THEN 'MOVED' WHEN c_custkey % 3 = 0 THEN NULL ELSE c_mktsegment END AS g FROM customer WHERE c_custkey % 2 = 0)
SELECT coalesce(d.c_custkey, s.c_custkey) AS c_custkey, coalesce(s.c_name, d.c_name) AS c_name, coalesce(g, d.c_mktsegment) AS c_mktsegment, CASE WHEN d.c_custkey IS NULL THEN 'inserted' WHEN coalesce(g, d.c_mktsegment) <> d.c_mktsegment THEN 'updated' ELSE 'kept' END AS action FROM d FULL JOIN s ON d.c_custkey = s.c_custkey""")
def scd1_merge(spark, sf_dir):
    c = Tables(spark, sf_dir).customer.select("c_custkey", "c_name", "c_mktsegment")
    first = c.where("c_custkey % 2 = 0").withColumns({"c_mktsegment": F.when(C("c_custkey") % 7 == 0, "MOVED").when(C("c_custkey") % 3 == 0, F.lit(None)).otherwise(C("c_mktsegment")), "prio": F.lit(1)})
    second = c.where("c_custkey % 4 = 0").withColumns({"c_mktsegment": F.lit("OLD"), "prio": F.lit(2)})
    return D.scd1(c.where("c_custkey % 5 <> 0"), first.unionByName(second), "c_custkey", ["c_name", "c_mktsegment"], [C("prio")])


@bed.query("""WITH d AS (SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey % 5 <> 0), s AS (SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN 'MOVED' ELSE c_mktsegment END AS g FROM customer WHERE c_custkey % 11 <> 0),
j AS (SELECT d.c_custkey AS dk, s.c_custkey AS sk, c_mktsegment, g FROM d FULL JOIN s ON d.c_custkey = s.c_custkey)
SELECT dk AS c_custkey, c_mktsegment, DATE '2025-01-01' AS valid_from, CASE WHEN g <> c_mktsegment THEN DATE '2026-01-01' END AS valid_to, coalesce(g = c_mktsegment, true) AS is_current FROM j WHERE dk IS NOT NULL
UNION ALL SELECT sk, g, DATE '2026-01-01', NULL, true FROM j WHERE dk IS NULL OR g <> c_mktsegment""")
def scd2_apply(spark, sf_dir):
    c = Tables(spark, sf_dir).customer.select("c_custkey", "c_mktsegment")
    dim = c.where("c_custkey % 5 <> 0").withColumns({"valid_from": F.lit("2025-01-01").cast("date"), "valid_to": F.lit(None).cast("date"), "is_current": F.lit(True)})
    snapshot = c.where("c_custkey % 11 <> 0").withColumn("c_mktsegment", F.when(C("c_custkey") % 7 == 0, "MOVED").otherwise(C("c_mktsegment")))
    return D.scd2(dim, snapshot, ["c_custkey"], ["c_mktsegment"], F.lit("2026-01-01").cast("date"))
