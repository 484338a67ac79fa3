"""Aggregations, sorts and set operations on the driver's tables. Sums run over decimals, so their order doesn't matter."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldmart.operators import aggregates as A
from fieldmart.operators import sets as S
from fieldmart.operators import shape
from fieldmart.plans.bed import Bed, Tables

bed = Bed()
C = F.col


def exact(c: str):
    return C(c).cast("decimal(18,2)")


@bed.query("SELECT l_suppkey, sum((l_returnflag = 'R')::INT)::BIGINT AS returned FROM lineitem GROUP BY 1")
def sum_flag(spark, sf_dir):
    return A.sum_flag(Tables(spark, sf_dir).lineitem, ["l_suppkey"], C("l_returnflag") == "R", "returned")


@bed.query("SELECT count(*) AS total, count(*) FILTER (c_acctbal < 0) AS negative, count(*) FILTER (c_mktsegment IS NULL) AS no_segment, count(*) FILTER (c_mktsegment = 'MACHINERY' AND c_nationkey > 10) AS machinery FROM customer")
def profile_counts(spark, sf_dir):
    return A.count_where(Tables(spark, sf_dir).customer, {"negative": C("c_acctbal") < 0, "no_segment": C("c_mktsegment").isNull(), "machinery": (C("c_mktsegment") == "MACHINERY") & (C("c_nationkey") > 10)})


@bed.query("SELECT count(DISTINCT user_id) AS user_id, count(DISTINCT event_type) AS event_type, count(DISTINCT props) AS props FROM events")
def distinct_counts(spark, sf_dir):
    return A.distinct_counts(Tables(spark, sf_dir).events, ["user_id", "event_type", "props"])


@bed.query("SELECT o_orderpriority, count(*) AS n, round(count(*) * 100 / (SELECT count(*) FROM orders)::DOUBLE, 1) AS pct FROM orders GROUP BY 1")
def value_counts_pct(spark, sf_dir):
    return A.value_counts(Tables(spark, sf_dir).orders, "o_orderpriority")


@bed.query("SELECT * FROM (SELECT event_type, reason, n, row_number() OVER (PARTITION BY event_type ORDER BY n DESC, reason)::INT AS rank FROM (SELECT event_type, (props::JSON ->> '$.k')::INT % 5 AS reason, count(*) AS n FROM events GROUP BY ALL)) WHERE rank <= 3")
def top_reasons(spark, sf_dir):
    t = Tables(spark, sf_dir).events.withColumn("reason", F.get_json_object("props", "$.k").cast("int") % 5)
    return A.top_reasons(t, ["event_type"], "reason")


@bed.query("SELECT count(*) AS groups, coalesce(sum(n - 1), 0)::BIGINT AS extra FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)")
def duplicate_profile(spark, sf_dir):
    return A.duplicate_profile(Tables(spark, sf_dir).lineitem, ["l_orderkey", "l_linenumber"])


@bed.query("SELECT l_suppkey, l_shipdate, count(*) AS n, min(l_quantity) AS low, max(l_quantity) AS high FROM lineitem GROUP BY 1, 2 HAVING min(l_quantity) <> max(l_quantity)")
def conflicting_groups(spark, sf_dir):
    return A.conflicting_groups(Tables(spark, sf_dir).lineitem, ["l_suppkey", "l_shipdate"], "l_quantity")


@bed.query("SELECT min(o_orderdate) AS low, max(o_orderdate) AS high FROM orders")
def value_range(spark, sf_dir):
    return A.value_range(Tables(spark, sf_dir).orders, "o_orderdate")


@bed.query("""SELECT l_partkey, l_suppkey, l_returnflag, support FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY support DESC, l_suppkey NULLS FIRST, l_returnflag) AS r FROM
  (SELECT l_partkey, l_suppkey, l_returnflag, count(*) AS support FROM (SELECT l_partkey, l_suppkey % 5 AS l_suppkey, l_returnflag FROM lineitem UNION ALL SELECT p_partkey, NULL, 'A' FROM part) GROUP BY ALL)) WHERE r = 1""")
def majority_value(spark, sf_dir):
    t = Tables(spark, sf_dir)
    votes = S.union_sources([t.lineitem.select("l_partkey", (C("l_suppkey") % 5).alias("l_suppkey"), "l_returnflag"), t.part.select(C("p_partkey").alias("l_partkey"), F.lit("A").alias("l_returnflag"))])
    return A.majority_value(votes, "l_partkey", ["l_suppkey", "l_returnflag"])


@bed.query("SELECT l_suppkey, l_shipdate, min(l_orderkey) AS l_orderkey FROM lineitem GROUP BY 1, 2")
def keep_min_id(spark, sf_dir):
    return A.keep_min_id(Tables(spark, sf_dir).lineitem.select("l_suppkey", "l_shipdate", "l_orderkey"), ["l_suppkey", "l_shipdate"], "l_orderkey")


@bed.query("""SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN d > 0 AND l_linenumber > 0 THEN round(d / l_linenumber, 4) WHEN n > 0 AND w > 0 THEN round(w / n, 4) END AS weight
  FROM (SELECT *, CASE WHEN l_partkey % 3 = 0 THEN l_extendedprice ELSE 0 END AS d, l_quantity + l_linenumber AS n, l_discount * 100 AS w FROM lineitem)""")
def weighted_mean(spark, sf_dir):
    t = Tables(spark, sf_dir).lineitem.withColumns({"d": F.when(C("l_partkey") % 3 == 0, C("l_extendedprice")).otherwise(F.lit(None)).cast("string"), "n": C("l_linenumber").cast("string"), "q": C("l_quantity").cast("string"), "w": (C("l_discount") * 100).cast("string")})
    return A.weighted_mean(t, [("q", "w"), ("n", None)], ("d", "n")).select("l_orderkey", "l_linenumber", "l_partkey", "weight")


@bed.query("""WITH e AS (SELECT l_quantity::DECIMAL(18,2) AS y, (l_quantity * 2 + l_linenumber)::DECIMAL(18,2) / 2 AS h FROM lineitem)
SELECT count(*) AS n, round(avg(abs(y - h)), 6) AS mae, round(1 - sum((y - h) * (y - h))::DOUBLE / (sum(y * y)::DOUBLE - sum(y)::DOUBLE * sum(y)::DOUBLE / count(*)), 6) AS r2 FROM (SELECT y::DOUBLE AS y, h::DOUBLE AS h FROM e)""")
def regression_metrics(spark, sf_dir):
    t = Tables(spark, sf_dir).lineitem.select(C("l_quantity").alias("y"), ((C("l_quantity") * 2 + C("l_linenumber")) / 2).alias("h"))
    m = A.regression_metrics(t, "y", "h")
    return m.select("n", F.round("mae", 6).alias("mae"), F.round("r2", 6).alias("r2"))


@bed.query("SELECT o_orderkey, o_totalprice, o_orderdate FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def multi_sort_topn(spark, sf_dir):
    return S.top_n(Tables(spark, sf_dir).orders, [("o_totalprice", False), ("o_orderkey", True)], 100).select("o_orderkey", "o_totalprice", "o_orderdate")


@bed.query("SELECT c_custkey, c_name, total FROM (SELECT * FROM customer, (SELECT count(*) AS total FROM customer WHERE c_name LIKE '%1%' AND c_acctbal BETWEEN 0 AND 5000)) WHERE c_name LIKE '%1%' AND c_acctbal BETWEEN 0 AND 5000 ORDER BY c_acctbal, c_custkey LIMIT 20 OFFSET 20")
def paged_search(spark, sf_dir):
    rows, total = shape.search(Tables(spark, sf_dir).customer, C("c_name").contains("1") & C("c_acctbal").between(0, 5000), [C("c_acctbal"), C("c_custkey")], 2, 20)
    return rows.crossJoin(total).select("c_custkey", "c_name", "total")


_COUNTED = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


@bed.query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS rows FROM {t}" for t in _COUNTED))
def layer_counts(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return S.layer_counts({name: getattr(t, name) for name in _COUNTED})


@bed.query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, (SELECT count(*) FROM {t} WHERE {k} % 2 = 0) AS before, (SELECT count(*) FROM {t}) AS after, (SELECT count(*) FROM {t} WHERE {k} % 2 <> 0) AS change" for t, k in (("orders", "o_orderkey"), ("part", "p_partkey"))))
def compare_counts(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return S.compare_counts(S.layer_counts({"orders": t.orders.where("o_orderkey % 2 = 0"), "part": t.part.where("p_partkey % 2 = 0")}), S.layer_counts({"orders": t.orders, "part": t.part}))


@bed.query("SELECT lower(trim(name)) AS key, min(name) AS name FROM (SELECT p_name AS name FROM part UNION ALL SELECT upper(p_name) FROM part WHERE p_partkey % 2 = 0 UNION ALL SELECT s_name FROM supplier) GROUP BY 1")
def catalogue_union(spark, sf_dir):
    t = Tables(spark, sf_dir)
    a = t.part.select(F.when(C("p_partkey") % 2 == 0, F.upper("p_name")).otherwise(C("p_name")).alias("name")).unionByName(t.part.select(C("p_name").alias("name")))
    return S.catalogue_union(a, t.supplier.select(C("s_name").alias("name")), F.lower(F.trim("name")))


@bed.query("SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation, c_mktsegment AS segment, 'customer' AS source FROM customer UNION ALL SELECT s_suppkey, s_name, s_nationkey, 'none', 'supplier' FROM supplier")
def two_source_union(spark, sf_dir):
    t = Tables(spark, sf_dir)
    a = t.customer.select(C("c_custkey").alias("id"), C("c_name").alias("name"), C("c_nationkey").alias("nation"), C("c_mktsegment").alias("segment"), F.lit("customer").alias("source"))
    b = t.supplier.select(C("s_suppkey").alias("id"), C("s_name").alias("name"), C("s_nationkey").alias("nation"), F.lit("supplier").alias("source"))
    return S.union_sources([a, b], {"segment": "none"})


@bed.query("SELECT l_orderkey, l_linenumber, l_partkey, unnest(['quantity', 'price', 'tax']) AS state, unnest([l_quantity, l_extendedprice, l_tax]) AS n FROM lineitem WHERE l_tax <> 0 UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, unnest(['quantity', 'price']), unnest([l_quantity, l_extendedprice]) FROM lineitem WHERE l_tax = 0")
def unpivot_measures(spark, sf_dir):
    t = Tables(spark, sf_dir).lineitem.withColumn("l_tax", F.nullif("l_tax", F.lit(0.0)))
    return shape.unpivot_states(t, ["l_orderkey", "l_linenumber", "l_partkey"], {"l_quantity": "quantity", "l_extendedprice": "price", "l_tax": "tax"})
