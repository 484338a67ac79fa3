"""Join operators on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldmart.operators import joins as J
from fieldmart.plans.bed import Bed, Tables

bed = Bed()
C = F.col


@bed.query("SELECT o.o_orderkey, o.o_custkey, l.l_linenumber, l.l_partkey FROM orders o LEFT JOIN (SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_returnflag = 'R') l ON o.o_orderkey = l.l_orderkey")
def left_join_const(spark, sf_dir):
    t = Tables(spark, sf_dir)
    lines = t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey")
    return J.left_join_where(t.orders, lines, ["o_orderkey"], C("l_returnflag") == "R").select("o_orderkey", "o_custkey", "l_linenumber", "l_partkey")


@bed.query("SELECT o_orderkey, c_custkey, n_name, r_name FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def flat_hierarchy(spark, sf_dir):
    t = Tables(spark, sf_dir)
    flat = J.flat_hierarchy(t.orders, [(t.customer, "o_custkey", "c_custkey"), (t.nation, "c_nationkey", "n_nationkey"), (t.region, "n_regionkey", "r_regionkey")])
    return flat.select("o_orderkey", "c_custkey", "n_name", "r_name")


_BRANDS = "(SELECT lower(trim(p_brand)) AS k, min(p_partkey) AS id FROM part WHERE p_partkey % 3 = 0 GROUP BY 1)"


def _brands(t):
    return t.part.where("p_partkey % 3 = 0").select(C("p_brand").alias("key"), C("p_partkey").alias("id"))


@bed.query(f"SELECT p_partkey, b.id AS found_id FROM part LEFT JOIN {_BRANDS} b ON lower(trim(CASE WHEN p_partkey % 5 = 0 THEN 'none' ELSE upper(p_brand) END)) = b.k")
def lookup_first(spark, sf_dir):
    t = Tables(spark, sf_dir)
    value = F.when(C("p_partkey") % 5 == 0, "none").otherwise(F.concat(F.lit("  "), F.upper("p_brand")))
    return J.lookup_id(t.part, _brands(t), value).select("p_partkey", "found_id")


@bed.query("SELECT c_custkey, coalesce(n_nationkey, 0) AS nation_id, CASE WHEN coalesce(n_nationkey, -1) = -1 THEN NULL ELSE n_nationkey END AS nation_or_null FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_nationkey % 4 <> 0) ON c_nationkey = n_nationkey")
def lookup_sentinel(spark, sf_dir):
    t = Tables(spark, sf_dir)
    dim = t.nation.where("n_nationkey % 4 <> 0").select(F.lower("n_name").alias("key"), C("n_nationkey").alias("id"))
    value = F.concat(F.lit("NATION_"), "c_nationkey")
    zero = J.lookup_id(t.customer, dim, value, default=0, name="nation_id")
    both = J.lookup_id(zero, dim, value, default=-1, name="raw_id")
    return both.select("c_custkey", "nation_id", F.nullif("raw_id", F.lit(-1)).alias("nation_or_null"))


@bed.query("SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'F' THEN 2 WHEN 'P' THEN 1 END AS found_id FROM orders")
def lookup_alias(spark, sf_dir):
    t = Tables(spark, sf_dir)
    dim = t.region.where("r_regionkey in (1, 2)").select(F.when(C("r_regionkey") == 1, "o").otherwise("f").alias("key"), C("r_regionkey").alias("id"))
    return J.lookup_alias(t.orders, dim, C("o_orderstatus"), {"p": "o"}).select("o_orderkey", "found_id")


_BANDS = "(SELECT s_suppkey AS id, 'Brand#' || (1 + s_suppkey % 25) AS brand, (s_suppkey % 40)::INT AS lo, (s_suppkey % 40 + 12)::INT AS hi, (s_suppkey % 7)::INT AS priority FROM supplier)"


@bed.query(f"""SELECT p_partkey, (SELECT min({{'p': priority, 'l': lo, 'i': id}}).i FROM {_BANDS} b WHERE b.brand = p_brand AND p_size BETWEEN lo AND hi) AS rule_id FROM part""")
def band_join(spark, sf_dir):
    t = Tables(spark, sf_dir)
    rules = t.supplier.select(C("s_suppkey").alias("id"), F.concat(F.lit("Brand#"), 1 + C("s_suppkey") % 25).alias("brand"), (C("s_suppkey") % 40).cast("int").alias("lo"), (C("s_suppkey") % 40 + 12).cast("int").alias("hi"), (C("s_suppkey") % 7).cast("int").alias("priority"))
    parts = t.part.select("p_partkey", "p_brand", "p_size")
    return J.band_join(parts, rules.withColumnRenamed("brand", "p_brand"), "p_brand", "p_size", "lo", "hi", "priority", "id").select("p_partkey", "rule_id")


_RANGES = "(SELECT o_orderkey AS id, o_custkey AS k, o_orderdate AS s, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderdate + INTERVAL 90 DAY END AS e FROM orders)"


@bed.query(f"""WITH asked AS (SELECT row_number() OVER () AS n, l_orderkey, l_partkey, l_linenumber, o_custkey AS k, l_shipdate AS d FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey),
held AS (SELECT n, max({{'s': s, 'o': e IS NULL, 'e': e, 'i': id}}) AS r FROM asked JOIN {_RANGES} q ON q.k = asked.k AND s <= d AND (d <= e OR e IS NULL) GROUP BY n)
SELECT l_orderkey, l_partkey, l_linenumber, r.i AS range_id FROM asked LEFT JOIN held USING (n)""")
def asof_interval(spark, sf_dir):
    t = Tables(spark, sf_dir)
    ranges = t.orders.select(C("o_orderkey").alias("id"), C("o_custkey").alias("k"), C("o_orderdate").cast("timestamp_ntz").alias("s"), F.when(C("o_orderkey") % 5 != 0, F.expr("cast(o_orderdate as timestamp_ntz) + interval 90 days")).alias("e"))
    customers = t.orders.select(C("o_orderkey").alias("_order"), C("o_custkey").alias("k"))
    asked = t.lineitem.join(customers, C("l_orderkey") == C("_order"), "left").select("l_orderkey", "l_partkey", "l_linenumber", "k", C("l_shipdate").cast("timestamp_ntz").alias("d"))
    return J.asof_interval(asked, ranges, ["k"], "d", "s", "e", "id").select("l_orderkey", "l_partkey", "l_linenumber", "range_id")


@bed.query("""WITH d AS (SELECT p_name, p_type, count(*) AS n, min(p_partkey) AS id FROM part WHERE p_partkey % 2 = 0 GROUP BY ALL)
SELECT p.p_partkey, CASE WHEN n IS NULL THEN 'NOT_FOUND' WHEN n = 1 THEN 'UNIQUE' ELSE 'AMBIGUOUS' END AS match_state, CASE WHEN n = 1 THEN id END AS match_id FROM part p LEFT JOIN d ON p.p_name = d.p_name AND p.p_type = d.p_type""")
def unique_match(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return J.unique_match(t.part, t.part.where("p_partkey % 2 = 0"), {"p_name": "p_name", "p_type": "p_type"}, "p_partkey").select("p_partkey", "match_state", "match_id")


_NULLED = "(SELECT l_orderkey, l_partkey, CASE WHEN l_suppkey % 10 = 0 THEN NULL ELSE l_suppkey END AS s, l_shipdate AS d FROM lineitem)"


def _grain(t):
    return t.lineitem.select("l_orderkey", "l_partkey", F.when(C("l_suppkey") % 10 != 0, C("l_suppkey")).alias("s"), C("l_shipdate").alias("d"))


@bed.query(f"SELECT l_orderkey, l_partkey, s, d FROM {_NULLED} b WHERE NOT EXISTS (SELECT 1 FROM {_NULLED} t WHERE t.l_orderkey % 3 = 0 AND t.l_partkey IS NOT DISTINCT FROM b.l_partkey AND t.s IS NOT DISTINCT FROM b.s)")
def insert_new_anti(spark, sf_dir):
    g = _grain(Tables(spark, sf_dir))
    return J.insert_new(g, g.where("l_orderkey % 3 = 0").select(C("l_partkey"), C("s")), ["l_partkey", "s"])


@bed.query(f"SELECT l_orderkey, l_partkey, s, d FROM {_NULLED} b WHERE EXISTS (SELECT 1 FROM {_NULLED} t WHERE t.l_orderkey % 3 = 0 AND t.l_partkey IS NOT DISTINCT FROM b.l_partkey AND t.s IS NOT DISTINCT FROM b.s)")
def external_dups_semi(spark, sf_dir):
    g = _grain(Tables(spark, sf_dir))
    return J.external_duplicates(g, g.where("l_orderkey % 3 = 0").select(C("l_partkey"), C("s")), ["l_partkey", "s"])


@bed.query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 4 <> 0)")
def orphan_fk(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return J.orphans(t.orders, t.customer.where("c_custkey % 4 <> 0"), "o_custkey", "c_custkey").select("o_orderkey", "o_custkey")


@bed.query("SELECT l_partkey, count(*) AS n FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 10) GROUP BY 1")
def coverage_gap(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return J.coverage_gap(t.lineitem, t.part.where("p_size > 10").select(C("p_partkey").alias("l_partkey")), ["l_partkey"])


@bed.query("SELECT o_orderkey, CASE WHEN o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') THEN 'CARGADO' ELSE o_orderstatus END AS o_orderstatus FROM orders")
def mark_state(spark, sf_dir):
    t = Tables(spark, sf_dir)
    ids = t.lineitem.where("l_returnflag = 'R'").select(C("l_orderkey").alias("o_orderkey"))
    return J.mark_state(t.orders, ids, "o_orderkey", "o_orderstatus", "CARGADO").select("o_orderkey", "o_orderstatus")


_SIG = "l_suppkey, l_linenumber, l_returnflag, l_shipdate"


@bed.query(f"""WITH r AS (SELECT {_SIG}, l_orderkey, l_partkey, l_linestatus, row_number() OVER (PARTITION BY {_SIG} ORDER BY l_orderkey, l_partkey) AS nth FROM lineitem),
m AS (SELECT {_SIG}, count(*) AS n FROM lineitem WHERE l_partkey % 4 = 0 GROUP BY ALL)
SELECT r.l_orderkey, r.l_partkey, r.l_linenumber, CASE WHEN nth <= coalesce(n, 0) THEN 'X' ELSE l_linestatus END AS l_linestatus FROM r LEFT JOIN m USING ({_SIG})""")
def mark_by_signature(spark, sf_dir):
    lines = Tables(spark, sf_dir).lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_shipdate", "l_linestatus")
    marked = J.mark_by_signature(lines, lines.where("l_partkey % 4 = 0"), ["l_suppkey", "l_linenumber", "l_returnflag", "l_shipdate"], ["l_orderkey", "l_partkey"], "l_linestatus", "X")
    return marked.select("l_orderkey", "l_partkey", "l_linenumber", "l_linestatus")
