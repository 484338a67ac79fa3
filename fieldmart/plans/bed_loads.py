"""De-duplication and loads on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldmart.operators import dedup as D
from fieldmart.operators import load as L
from fieldmart.operators import sets as S
from fieldmart.plans.bed import Bed, Tables

bed = Bed()
C = F.col
_SEQ = ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"]


@bed.query("SELECT event_id, event_type, user_id, ts FROM (SELECT *, row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1")
def latest_per_key(spark, sf_dir):
    return D.latest_per_key(Tables(spark, sf_dir).events, ["event_type", "user_id"], [C("ts").desc(), C("event_id").desc()]).select("event_id", "event_type", "user_id", "ts")


@bed.query("SELECT event_id, event_type, user_id FROM (SELECT *, row_number() OVER (PARTITION BY event_type, user_id ORDER BY coalesce(t, TIMESTAMP '1900-01-01') DESC, event_id) AS r FROM (SELECT *, CASE WHEN event_id % 3 = 0 THEN NULL ELSE date_trunc('day', ts) END AS t FROM events)) WHERE r = 1")
def dedup_latest(spark, sf_dir):
    t = Tables(spark, sf_dir).events.withColumn("t", F.when(C("event_id") % 3 != 0, F.date_trunc("day", "ts")))
    return D.dedup_latest(t, ["event_type", "user_id"], "t", ["event_id"]).select("event_id", "event_type", "user_id")


_FIRST = "SELECT *, row_number() OVER (PARTITION BY l_partkey % 50, l_shipdate ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice) AS r FROM lineitem"


def _coarse(t):
    return t.lineitem.withColumn("k", C("l_partkey") % 50)


@bed.query(f"SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM ({_FIRST}) WHERE r = 1")
def dedup_first(spark, sf_dir):
    return D.dedup_first(_coarse(Tables(spark, sf_dir)), ["k", "l_shipdate"], _SEQ)[0].select(*_SEQ)


@bed.query(f"SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_partkey % 50 || '|' || l_linestatus AS key_text, 'DUPLICADO_INTERNO' AS rule_type, 'MEDIO' AS severity FROM ({_FIRST.replace('l_shipdate ORDER', 'l_linestatus ORDER')}) WHERE r > 1")
def dedup_first_rejects(spark, sf_dir):
    return D.dedup_first(_coarse(Tables(spark, sf_dir)), ["k", "l_linestatus"], _SEQ)[1].select(*_SEQ, "key_text", "rule_type", "severity")


_SIG = "SELECT *, min(l_returnflag) OVER w <> max(l_returnflag) OVER w AS clash, row_number() OVER (PARTITION BY l_partkey % 50, l_shipdate ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice) AS r FROM lineitem WINDOW w AS (PARTITION BY l_partkey % 50, l_shipdate)"


@bed.query(f"SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM ({_SIG}) WHERE NOT clash AND r = 1")
def dedup_signature_keep(spark, sf_dir):
    return D.dedup_signature(_coarse(Tables(spark, sf_dir)), ["k", "l_shipdate"], ["l_returnflag"], _SEQ)[0].select(*_SEQ)


@bed.query(f"SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM ({_SIG}) WHERE clash")
def dedup_signature_conflict(spark, sf_dir):
    return D.dedup_signature(_coarse(Tables(spark, sf_dir)), ["k", "l_shipdate"], ["l_returnflag"], _SEQ)[1].select(*_SEQ)


@bed.query("SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey, l_shipdate ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice) AS r FROM lineitem) WHERE r = 1")
def predrop_duplicates(spark, sf_dir):
    return D.predrop_duplicates(Tables(spark, sf_dir).lineitem, ["l_suppkey", "l_shipdate", "not_there"], _SEQ)[0].select(*_SEQ)


_SPEC = L.FactSpec("movement", ("k", "l_shipdate"), tuple(_SEQ))


@bed.query(f"""WITH b AS (SELECT * FROM ({_FIRST}) WHERE r = 1), t AS (SELECT DISTINCT l_partkey % 50 AS k, l_shipdate FROM lineitem WHERE l_orderkey % 4 = 0)
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM b WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.k = b.l_partkey % 50 AND t.l_shipdate = b.l_shipdate)""")
def load_insert_new(spark, sf_dir):
    rows = _coarse(Tables(spark, sf_dir))
    return L.load_insert_new(rows, rows.where("l_orderkey % 4 = 0"), _SPEC).inserted.select(*_SEQ)


_DAY = "SELECT event_type, user_id, value, date_trunc('hour', ts) AS ts, event_id, row_number() OVER (PARTITION BY event_type, user_id ORDER BY date_trunc('hour', ts) DESC, event_id) AS r FROM events WHERE event_id % 2 = {}"


@bed.query(f"""WITH t AS (SELECT * FROM ({_DAY.format(0)} AND user_id % 3 <> 0) WHERE r = 1), b AS (SELECT * FROM ({_DAY.format(1)}) WHERE r = 1)
SELECT coalesce(t.event_type, b.event_type) AS event_type, coalesce(t.user_id, b.user_id) AS user_id, CASE WHEN b.ts > coalesce(t.ts, TIMESTAMP '1900-01-01') THEN b.event_id ELSE t.event_id END AS event_id,
  CASE WHEN t.event_id IS NULL THEN 'inserted' WHEN b.ts > t.ts THEN 'updated' ELSE 'kept' END AS action FROM t FULL JOIN b ON t.event_type = b.event_type AND t.user_id = b.user_id""")
def load_merge_latest(spark, sf_dir):
    e = Tables(spark, sf_dir).events.select("event_type", "user_id", "value", F.date_trunc("hour", "ts").alias("ts"), "event_id")
    spec = L.FactSpec("reading", ("event_type", "user_id"), ("event_id",), "ts")
    target = D.dedup_latest(e.where("event_id % 2 = 0 and user_id % 3 <> 0"), spec.grain, "ts", ["event_id"])
    return L.load_merge_latest(e.where("event_id % 2 = 1"), target, spec).select("event_type", "user_id", "event_id", "action")


@bed.query("""WITH s AS (SELECT CASE WHEN s_suppkey % 7 <> 0 THEN s_suppkey END AS s_suppkey, s_suppkey AS k, s_acctbal FROM supplier), t AS (SELECT * FROM s WHERE k % 3 = 0), n AS (SELECT * FROM s WHERE k % 2 = 0)
SELECT s_suppkey, s_acctbal + 1 AS s_acctbal, 'merged' AS action FROM n UNION ALL SELECT s_suppkey, s_acctbal, 'kept' FROM t WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.s_suppkey IS NOT DISTINCT FROM t.s_suppkey)""")
def merge_upsert(spark, sf_dir):
    s = Tables(spark, sf_dir).supplier.select(F.when(C("s_suppkey") % 7 != 0, C("s_suppkey")).alias("s_suppkey"), C("s_suppkey").alias("k"), "s_acctbal")
    return L.merge_upsert(s.where("k % 3 = 0").drop("k"), s.where("k % 2 = 0").drop("k").withColumn("s_acctbal", C("s_acctbal") + 1), ["s_suppkey"])


@bed.query("""WITH e AS (SELECT *, CASE WHEN event_type <> 'click' THEN event_type END AS kind FROM events),
x AS (SELECT kind, CASE event_id % 5 WHEN 0 THEN 'SIN_MOTIVO' WHEN 1 THEN 'late' WHEN 2 THEN 'late' WHEN 3 THEN 'wrong' ELSE 'odd ' || event_id % 3 END AS reason FROM e WHERE value > 50 UNION ALL SELECT kind, 'twice' FROM e WHERE value > 60),
n AS (SELECT kind, reason, count(*) AS c FROM x GROUP BY 1, 2), p AS (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY c DESC, reason) AS place FROM n),
t AS (SELECT kind, string_agg(reason || ' (' || c || ')', ', ' ORDER BY place) AS top_reasons FROM p WHERE place <= 3 GROUP BY 1)
SELECT r.kind, rows_read, rows_rejected, rows_read - rows_rejected AS rows_inserted, round(rows_rejected * 100 / rows_read::DOUBLE, 2) AS rate, coalesce(top_reasons, '') AS top_reasons
FROM (SELECT kind, count(*) AS rows_read, count(DISTINCT event_id) FILTER (value > 50) AS rows_rejected FROM e GROUP BY 1) r LEFT JOIN t ON t.kind IS NOT DISTINCT FROM r.kind""")
def fact_result(spark, sf_dir):
    e = Tables(spark, sf_dir).events.withColumn("kind", F.when(C("event_type") != "click", C("event_type")))
    reason = F.when(C("event_id") % 5 == 0, " ").when(C("event_id") % 5 <= 2, "late").when(C("event_id") % 5 == 3, "wrong").otherwise(F.concat(F.lit("odd "), C("event_id") % 3))
    rejects = S.union_sources([e.where("value > 50").withColumn("reason", reason), e.where("value > 60").withColumn("reason", F.lit("twice"))])
    return L.fact_result(e, rejects, ["kind"], "event_id")


@bed.query("SELECT o_custkey, o_orderdate, min(o_orderkey) AS o_orderkey FROM orders WHERE o_orderstatus IN ('F', 'P') GROUP BY 1, 2")
def rebuild_subset(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.select("o_custkey", "o_orderdate", "o_orderkey", "o_orderstatus")
    spec = L.FactSpec("orders", ("o_custkey", "o_orderdate"), ("o_orderkey",))
    target = o.drop("o_orderstatus").limit(0)
    return L.rebuild(o, C("o_orderstatus").isin("F", "P"), spec, lambda raw: raw.drop("o_orderstatus"), target).rows


@bed.query("""WITH f AS (SELECT o_custkey, o_orderdate, min(o_orderkey) AS k FROM orders GROUP BY 1, 2), l AS (SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1)
SELECT 'customers' AS mart, count(*) AS rows, sum(k)::BIGINT AS total FROM f UNION ALL SELECT 'both', (SELECT count(*) FROM f), (SELECT sum(n) FROM l)::BIGINT""")
def rebuild_affected(spark, sf_dir):
    """Of three marts, the two that the rebuilt fact feeds are made again; the stored lines serve the one that needs them too."""
    t = Tables(spark, sf_dir)
    registry = {"orders": L.FactSpec("orders", ("o_custkey", "o_orderdate"), ("o_orderkey",), None, ("customers", "both")), "lines": L.FactSpec("lines", ("l_suppkey",), ("l_orderkey",), None, ("suppliers",))}
    raw = t.orders.select("o_custkey", "o_orderdate", "o_orderkey")
    rebuilt = {"orders": lambda: L.rebuild(raw, F.lit(True), registry["orders"], lambda x: x, raw.limit(0)).rows}
    lines = t.lineitem.groupBy("l_suppkey").agg(F.count("*").alias("n"))
    marts = {
        "customers": lambda f: f["orders"].agg(F.count("*").alias("rows"), F.sum("o_orderkey").alias("total")),
        "suppliers": lambda f: f["lines"].agg(F.count("*").alias("rows"), F.sum("n").alias("total")),
        "both": lambda f: f["orders"].agg(F.count("*").alias("rows")).crossJoin(f["lines"].agg(F.sum("n").alias("total"))),
    }
    made = L.rebuild_affected(["orders"], registry, rebuilt, {"orders": raw.limit(0), "lines": lines}, marts)
    return S.union_sources([df.select(F.lit(m).alias("mart"), "rows", "total") for m, df in made.items()])


@bed.query("SELECT 'raw' AS layer, 'orders' AS table_name, count(*) AS rows_before, 0::BIGINT AS rows_after, true AS purge FROM orders UNION ALL SELECT 'fact', 'lineitem', count(*), 0, true FROM lineitem UNION ALL SELECT 'dim', 'part', count(*), count(*), false FROM part")
def purge_plan(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return L.purge_plan({"orders": ("raw", t.orders), "lineitem": ("fact", t.lineitem), "part": ("dim", t.part)}, ["raw", "fact"])
