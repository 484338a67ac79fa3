"""Run analytics on events and orders in the role of logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldmart.operators import aggregates as A
from fieldmart.operators import audit as U
from fieldmart.operators import joins as J
from fieldmart.plans.bed import Bed, Tables
from fieldmart.sources import kv

bed = Bed()
C = F.col
_NOW = "2024-02-01 00:00:00"


def now():
    return F.lit(_NOW).cast("timestamp_ntz")


def events(spark, sf_dir):
    return Tables(spark, sf_dir).events.withColumns({"ts": C("ts").cast("timestamp_ntz"), "k": F.get_json_object("props", "$.k").cast("int")})


_E = "(SELECT *, (props::JSON ->> '$.k')::INT AS k FROM events)"


@bed.query(f"SELECT count(*) AS runs, sum(k)::BIGINT AS rows_read, sum(k % 7)::BIGINT AS rows_rejected, count(*) FILTER (event_type = 'error') AS errors, count(DISTINCT user_id) AS targets, max(ts) AS last, round(sum(value::DECIMAL(18,2))::DOUBLE / count(*), 2) AS mean_seconds FROM {_E}")
def run_kpis(spark, sf_dir):
    log = events(spark, sf_dir).select(C("user_id").alias("target"), F.when(C("event_type") == "error", "ERROR").otherwise("OK").alias("state"), C("k").alias("rows_read"), (C("k") % 7).alias("rows_rejected"), C("value").cast("decimal(18,2)").alias("seconds"), C("ts").alias("started"))
    return U.run_kpis(log).withColumn("mean_seconds", C("mean_seconds").cast("double"))


@bed.query(f"SELECT o.user_id, date_diff('second', first, TIMESTAMP '{_NOW}') AS since_request, date_diff('second', last, TIMESTAMP '{_NOW}') AS since_beat FROM (SELECT user_id, date_trunc('second', min(ts)) AS first FROM events WHERE event_type = 'signup' GROUP BY 1) o LEFT JOIN (SELECT user_id, date_trunc('second', max(ts)) AS last FROM events WHERE event_type = 'click' AND user_id % 3 <> 0 GROUP BY 1) b ON o.user_id = b.user_id WHERE o.user_id % 2 = 0")
def staleness(spark, sf_dir):
    e = events(spark, sf_dir).withColumn("ts", F.date_trunc("second", "ts").cast("timestamp_ntz"))
    runs = e.where("event_type = 'signup'").groupBy("user_id").agg(F.min("ts").alias("requested")).withColumn("open", C("user_id") % 2 == 0)
    beats = e.where("event_type = 'click' and user_id % 3 <> 0").select("user_id", C("ts").alias("at"))
    return U.staleness(runs, beats, "user_id", now())


@bed.query(f"SELECT event_id, CASE WHEN event_id % 10 = 0 THEN 'FREE' WHEN date_diff('second', date_trunc('second', ts), TIMESTAMP '{_NOW}') <= 86400 * 3 THEN 'ACTIVE' ELSE 'EXPIRED' END AS freshness FROM events")
def staleness_state(spark, sf_dir):
    e = events(spark, sf_dir).withColumn("seen", F.when(C("event_id") % 10 != 0, F.date_trunc("second", "ts").cast("timestamp_ntz")))
    return U.freshness_class(e, "seen", now(), 86400 * 3).select("event_id", "freshness")


@bed.query("SELECT event_id, ts < TIMESTAMP '2024-01-22' AND c_mktsegment IN ('MACHINERY', 'FURNITURE') AS purged FROM events LEFT JOIN customer ON user_id = c_custkey")
def retention_purge(spark, sf_dir):
    runs = Tables(spark, sf_dir).customer.select(C("c_custkey").alias("user_id"), C("c_mktsegment").alias("state"))
    kept, purged = U.retention(events(spark, sf_dir), runs, "user_id", "ts", 10, now(), ["MACHINERY", "FURNITURE"])
    return kept.select("event_id", F.lit(False).alias("purged")).unionByName(purged.select("event_id", F.lit(True).alias("purged")))


@bed.query("SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def state_histogram(spark, sf_dir):
    return U.state_histogram(Tables(spark, sf_dir).orders, "o_orderstatus")


@bed.query("SELECT count(*) AS rows, count(*) FILTER (c_custkey % 6 = 0) AS surrogate, round(count(*) FILTER (c_custkey % 6 = 0) * 100 / count(*)::DOUBLE, 2) AS pct FROM customer")
def surrogate_share(spark, sf_dir):
    return U.surrogate_share(Tables(spark, sf_dir).customer.withColumn("fk", F.when(C("c_custkey") % 6 == 0, -1).otherwise(C("c_nationkey"))), "fk")


@bed.query("""WITH s AS (SELECT 'orders' AS domain, (SELECT count(*) FROM orders) AS rows, (SELECT count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)) AS orphans, (SELECT count(*) FROM (SELECT o_custkey FROM orders GROUP BY o_custkey, o_orderdate HAVING count(*) > 1)) AS duplicates, 0 AS pending
UNION ALL SELECT 'lines', (SELECT count(*) FROM lineitem), (SELECT count(*) FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_suppkey > 2)), 0, 0 UNION ALL SELECT 'nations', (SELECT count(*) FROM nation), 0, 0, 0 UNION ALL SELECT 'parts', (SELECT count(*) FROM part), 0, 0, (SELECT count(*) FROM part WHERE p_size < 10))
SELECT *, CASE WHEN rows = 0 THEN 'EMPTY' WHEN orphans > 0 THEN 'BROKEN' WHEN duplicates > 0 OR pending * 100 > rows * 5 THEN 'REVIEW' ELSE 'OK' END AS verdict, rows >= 1000 AND orphans = 0 AND duplicates = 0 AND pending * 100 <= rows * 5 AS ready FROM s""")
def domain_scorecard(spark, sf_dir):
    t = Tables(spark, sf_dir)
    twice = t.orders.groupBy("o_custkey", "o_orderdate").count().where("count > 1")
    none = t.nation.limit(0)
    return U.domain_scorecard({
        "orders": (t.orders, J.orphans(t.orders, t.customer, "o_custkey", "c_custkey"), twice, none),
        "lines": (t.lineitem, J.orphans(t.lineitem, t.supplier.where("s_suppkey > 2"), "l_suppkey", "s_suppkey"), none, none),
        "nations": (t.nation, none, none, none),
        "parts": (t.part, none, none, t.part.where("p_size < 10")),
    })


@bed.query("SELECT 'part' AS table_name, count(*) FILTER (p_size = 9) AS n FROM part UNION ALL SELECT 'nation', count(*) FILTER (n_nationkey = 9) FROM nation")
def residual_scan(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return U.residual_scan({"part": t.part.select(F.concat(F.lit(" "), "p_size", F.lit(" .")).alias("m")), "nation": t.nation.select(F.concat("n_nationkey", F.lit(".")).alias("m"))}, "m", "9.")


@bed.query(f"SELECT CASE k % 3 WHEN 0 THEN 'a' WHEN 1 THEN 'b' END AS key, count(*) AS n FROM {_E} WHERE k % 3 <> 2 GROUP BY 1")
def map_key_audit(spark, sf_dir):
    e = events(spark, sf_dir).select(F.create_map(F.when(C("k") % 3 == 0, "a").when(C("k") % 3 == 1, "b").otherwise("value"), C("props")).alias("m"))
    return kv.map_key_audit(e, "m", ["value"])


@bed.query(f"SELECT event_id, last_value(CASE WHEN k % 10 = 0 THEN 'step' || k END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS step FROM {_E}")
def log_steps(spark, sf_dir):
    e = events(spark, sf_dir).withColumn("line", F.when(C("k") % 10 == 0, F.concat(F.lit("== STEP: step"), "k", F.lit(" =="))).otherwise("row"))
    return U.log_steps(e, "user_id", "event_id", "line", r"STEP: (\w+)").select("event_id", "step")


@bed.query("SELECT 'R' AS name, (SELECT count(*) FROM lineitem WHERE l_returnflag = 'R') AS value, 'OK' AS verdict UNION ALL SELECT 'A', (SELECT count(*) FROM lineitem WHERE l_returnflag = 'A'), 'HIGH' UNION ALL SELECT 'X', NULL, 'MISSING'")
def expectations(spark, sf_dir):
    t = Tables(spark, sf_dir)
    metrics = t.lineitem.groupBy(C("l_returnflag").alias("name")).agg(F.count("*").alias("value"))
    rows = t.region.where("r_regionkey < 3").select(F.when(C("r_regionkey") == 0, "R").when(C("r_regionkey") == 1, "A").otherwise("X").alias("name"), F.lit(1).alias("low"), F.when(C("r_regionkey") == 1, 2).otherwise(1_000_000_000).alias("high"))
    return U.check_expectations(metrics, rows)


@bed.query(f"SELECT event_id, user_id, ts FROM events WHERE user_id % 10 = 3 AND event_id > 500 ORDER BY event_id LIMIT 200")
def event_tail(spark, sf_dir):
    from fieldmart.streaming.incremental import event_tail as tail

    return tail(events(spark, sf_dir), C("user_id") % 10 == 3, "event_id", 500, 200).select("event_id", "user_id", "ts")


@bed.query("SELECT count(*) AS total, avg((c_acctbal < 0)::INT)::DOUBLE AS share FROM customer")
def negative_share(spark, sf_dir):
    found = A.count_where(Tables(spark, sf_dir).customer, {"negative": C("c_acctbal") < 0})
    return found.select("total", (C("negative") / C("total")).alias("share"))
