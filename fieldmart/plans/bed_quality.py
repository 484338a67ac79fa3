"""Data quality on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldmart.operators import quality as Q
from fieldmart.plans.bed import Bed, Tables

bed = Bed()
C = F.col
_ID = ["l_orderkey", "l_linenumber", "l_partkey"]


@bed.query("""SELECT l_orderkey, l_linenumber, l_partkey, 'l_quantity' AS column, q AS value, 'out of range 5 to 45' AS reason, 'ALERTA' AS action FROM (SELECT *, CASE WHEN l_partkey % 17 = 0 THEN 'x' ELSE l_quantity::INT::VARCHAR END AS q FROM lineitem)
  WHERE try_cast(q AS DOUBLE) IS NULL OR try_cast(q AS DOUBLE) < 5 OR try_cast(q AS DOUBLE) > 45""")
def rules_range(spark, sf_dir):
    t = Tables(spark, sf_dir).lineitem.withColumn("l_quantity", F.when(C("l_partkey") % 17 == 0, F.lit("x")).otherwise(C("l_quantity").cast("int").cast("string")))
    return Q.apply_rules(t, [{"column": "l_quantity", "rule_type": "RANGO", "min": 5, "max": 45}])[1].select(*_ID, "column", "value", "reason", "action")


@bed.query("SELECT c_custkey, c_name AS value, 'FORMATO' AS rule_type FROM customer WHERE NOT regexp_matches(c_name, '^Customer#0+[1-4]')")
def rules_format(spark, sf_dir):
    return Q.apply_rules(Tables(spark, sf_dir).customer, [{"column": "c_name", "rule_type": "FORMATO", "pattern": "Customer#0+[1-4]"}])[1].select("c_custkey", "value", "rule_type")


@bed.query("SELECT p_partkey, p_brand FROM part WHERE p_brand IS NOT NULL AND p_brand NOT IN (SELECT 'Brand#' || n_nationkey FROM nation WHERE n_nationkey < 20)")
def rules_catalogue(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return Q.rules_catalogue(t.part, "p_brand", t.nation.where("n_nationkey < 20").select(F.concat(F.lit("Brand#"), "n_nationkey").alias("k")), "k").select("p_partkey", "p_brand")


@bed.query("SELECT event_id, value FROM events, (SELECT avg(value) AS m, stddev_samp(value) AS s FROM events) WHERE abs(value - m) > 3 * s")
def rules_statistical(spark, sf_dir):
    return Q.rules_statistical(Tables(spark, sf_dir).events, "value").select("event_id", "value")


@bed.query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_quantity BETWEEN 5 AND 1000")
def rules_actions(spark, sf_dir):
    rules = [{"column": "l_quantity", "rule_type": "RANGO", "min": 5, "action": "RECHAZAR"}, {"column": "l_tax", "rule_type": "RANGO", "max": 0.02, "action": "CUARENTENA"}]
    return Q.apply_rules(Tables(spark, sf_dir).lineitem, rules)[0].select(*_ID)


@bed.query("""WITH r AS (SELECT *, l_quantity / 4 AS weight, l_linenumber - 1 AS samples, l_discount * 1200 AS humidity, CASE WHEN l_partkey % 9 = 0 THEN 'n/a' ELSE strftime(l_shipdate, '%d/%m/%Y') END AS day FROM lineitem),
e AS (SELECT *, (weight NOT BETWEEN 0.5 AND 8) AS b1, (samples < 1) AS b2, NOT (CASE WHEN humidity <= 1 THEN humidity * 100 ELSE humidity END BETWEEN 0 AND 100) AS b3, day = 'n/a' AS b4 FROM r)
SELECT 'critical' AS reason, count(*) AS n FROM e WHERE b1 OR b4 UNION ALL SELECT 'weight out of range', count(*) FROM e WHERE b1 UNION ALL SELECT 'at least one sample', count(*) FROM e WHERE b2 UNION ALL SELECT 'humidity out of range', count(*) FROM e WHERE b3 HAVING count(*) > 0 UNION ALL SELECT 'invalid date', count(*) FROM e WHERE b4""")
def validate_cells(spark, sf_dir):
    t = Tables(spark, sf_dir).lineitem.select(*_ID, (C("l_quantity") / 4).alias("weight"), (C("l_linenumber") - 1).alias("samples"), (C("l_discount") * 1200).alias("humidity"), F.when(C("l_partkey") % 9 == 0, "n/a").otherwise(F.date_format("l_shipdate", "dd/MM/yyyy")).alias("day"))
    rows, errors = Q.validate(t, {"weight": "berry_weight", "samples": "samples", "humidity": "humidity", "day": "date"})
    critical = rows.where("critical").agg(F.count("*").alias("n")).select(F.lit("critical").alias("reason"), "n")
    return errors.groupBy("reason").agg(F.count("*").alias("n")).unionByName(critical)


@bed.query("""WITH r AS (SELECT p_partkey % 4 AS k FROM part) SELECT 'variety is missing' AS reason, 'ALTO' AS severity, count(*) AS n FROM r WHERE k = 0 UNION ALL SELECT 'invalid module', 'ALTO', count(*) FROM r WHERE k = 1 UNION ALL SELECT 'invalid name of a person', 'MEDIO', count(*) FROM r WHERE k IN (2, 3)""")
def validate_names(spark, sf_dir):
    k = C("p_partkey") % 4
    t = Tables(spark, sf_dir).part.select(
        "p_partkey", F.when(k == 0, " none ").otherwise(C("p_name")).alias("variety"), F.when(k == 1, "XII").when(k == 2, "Test block").otherwise(F.concat(F.lit("Module "), C("p_size"))).alias("module"),
        F.when(k == 2, "12345").when(k == 3, F.lit(None)).otherwise("Ana  María O'Hara-Núñez").alias("person"),
    )
    return Q.validate(t, {"variety": "variety", "module": "module", "person": "person"})[1].groupBy("reason", "severity").agg(F.count("*").alias("n"))


@bed.query("""SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_quantity < 3 THEN 'too few' WHEN l_discount > 0.09 THEN 'too cheap' ELSE 'late' END AS reason,
  CASE WHEN l_quantity < 3 THEN 'CRITICO' WHEN l_discount > 0.09 THEN 'ALTO' ELSE 'MEDIO' END AS severity FROM lineitem WHERE l_quantity < 3 OR l_discount > 0.09 OR l_shipdate > TIMESTAMP '2001-06-01'""")
def reject_cascade(spark, sf_dir):
    checks = [(C("l_quantity") < 3, "l_quantity", "too few", "DQ", "CRITICO"), (C("l_discount") > 0.09, "l_discount", "too cheap", "DQ", "ALTO"), (C("l_shipdate") > F.lit("2001-06-01").cast("timestamp"), "l_shipdate", "late", "DQ", "MEDIO")]
    return Q.first_failure(Tables(spark, sf_dir).lineitem, checks)[1].select(*_ID, "reason", "severity")


@bed.query("SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_linenumber > l_quantity THEN 'part over whole' WHEN l_shipdate < o_orderdate THEN 'before start' ELSE 'negative' END AS reason FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_linenumber > l_quantity OR l_shipdate < o_orderdate OR l_tax < 0")
def cross_field_checks(spark, sf_dir):
    t = Tables(spark, sf_dir)
    joined = t.lineitem.join(t.orders.select("o_orderkey", "o_orderdate"), C("l_orderkey") == C("o_orderkey"))
    checks = [(C("l_linenumber") > C("l_quantity"), "l_linenumber", "part over whole", "DQ", "ALTO"), (C("l_shipdate") < C("o_orderdate"), "l_shipdate", "before start", "DQ", "ALTO"), (C("l_tax") < 0, "l_tax", "negative", "DQ", "ALTO")]
    return Q.first_failure(joined, checks)[1].select(*_ID, "reason")


def _records(spark, sf_dir):
    k = F.get_json_object("props", "$.k").cast("int")
    e = Tables(spark, sf_dir).events
    values = {
        "source_table": C("event_type"), "source_column": F.lit("value"), "received_value": k.cast("string"), "reason": F.concat(F.lit("r"), k % 5), "rule_type": F.lit("DQ"), "severity": F.lit("ALTO"), "score": k / 100,
        "state": F.when(k % 3 == 0, Q.PENDING).when(k % 3 == 1, Q.RESOLVED).otherwise(Q.DISCARDED), "corrected_value": F.lit(None).cast("string"), "approved_by": F.lit(None).cast("string"),
        "source_row_id": F.when(C("event_id") % 4 != 0, C("event_id") % 1000), "entered_at": C("ts").cast("timestamp_ntz"), "resolved_at": F.lit(None).cast("timestamp_ntz"),
    }
    return e.select("event_id", *[v.alias(n) for n, v in values.items()])


_R = """(SELECT event_id, event_type AS source_table, 'value' AS source_column, k::VARCHAR AS received_value, 'r' || k % 5 AS reason, k / 100.0::DOUBLE AS score, CASE k % 3 WHEN 0 THEN 'PENDIENTE' WHEN 1 THEN 'RESUELTO' ELSE 'DESCARTADO' END AS state,
  CASE WHEN event_id % 4 <> 0 THEN event_id % 1000 END AS source_row_id, ts AS entered_at FROM (SELECT *, (props::JSON ->> '$.k')::INT AS k FROM events))"""


@bed.query(f"""SELECT DISTINCT source_table, received_value, reason, source_row_id FROM {_R} n WHERE event_id % 2 = 0 AND NOT EXISTS
  (SELECT 1 FROM {_R} p WHERE p.event_id % 2 = 1 AND p.state = 'PENDIENTE' AND p.source_table = n.source_table AND p.received_value = n.received_value AND p.reason = n.reason AND p.source_row_id IS NOT DISTINCT FROM n.source_row_id)""")
def quarantine_append(spark, sf_dir):
    r = _records(spark, sf_dir)
    new = Q.quarantine_append(r.where("event_id % 2 = 0").drop("event_id"), r.where("event_id % 2 = 1").drop("event_id"))
    return new.select("source_table", "received_value", "reason", "source_row_id")


@bed.query(f"SELECT event_id, CASE WHEN state = 'PENDIENTE' AND event_id % 3 = 0 THEN CASE WHEN event_id % 2 = 0 THEN 'RESUELTO' ELSE 'DESCARTADO' END ELSE state END AS state, CASE WHEN state = 'PENDIENTE' AND event_id % 6 = 0 THEN 'fixed' END AS corrected_value, CASE WHEN state = 'PENDIENTE' AND event_id % 3 = 0 THEN 'ana' END AS approved_by FROM {_R}")
def quarantine_resolve(spark, sf_dir):
    r = _records(spark, sf_dir)
    decisions = r.where("event_id % 3 = 0").select("event_id", F.when(C("event_id") % 2 == 0, Q.RESOLVED).otherwise(Q.DISCARDED).alias("decision"), F.lit("fixed").alias("value"), F.lit("ana").alias("who"))
    return Q.resolve(r, decisions, "event_id", F.lit("2026-01-01").cast("timestamp_ntz")).select("event_id", "state", "corrected_value", "approved_by")


@bed.query(f"SELECT o_orderkey, CASE WHEN st = 'RECHAZADO' AND o_orderkey IN (SELECT source_row_id FROM {_R} WHERE source_table = 'click' AND state = 'RESUELTO' AND source_row_id IS NOT NULL) THEN 'CARGADO' ELSE st END AS load_state FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'RECHAZADO' ELSE 'PROCESADO' END AS st FROM orders)")
def reinject(spark, sf_dir):
    raw = Tables(spark, sf_dir).orders.select("o_orderkey", F.when(C("o_orderkey") % 2 == 0, "RECHAZADO").otherwise("PROCESADO").alias("load_state"))
    return Q.reinject(_records(spark, sf_dir), raw, "click", "o_orderkey")


@bed.query("SELECT n AS rows_read, r AS rows_rejected, round(r * 100 / n::DOUBLE, 2) AS rate, round(r * 100 / n::DOUBLE, 2) > 5 AS over_limit FROM (SELECT count(*) AS n, count(DISTINCT l_orderkey) FILTER (l_quantity < 3 AND l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')) AS r FROM lineitem)")
def quality_gate(spark, sf_dir):
    lines = Tables(spark, sf_dir).lineitem
    loaded = Tables(spark, sf_dir).orders.where("o_orderstatus = 'P'").select(C("o_orderkey").alias("l_orderkey"))
    return Q.quality_gate(lines, lines.where("l_quantity < 3"), "l_orderkey", external=loaded)


@bed.query(f"SELECT entered_at::DATE AS day, source_table, source_column, reason, count(*) AS n FROM {_R} WHERE state = 'PENDIENTE' GROUP BY ALL")
def dq_backlog_daily(spark, sf_dir):
    return Q.dq_backlog(_records(spark, sf_dir))


@bed.query(f"SELECT source_table, source_column, received_value, count(*) AS n FROM {_R} GROUP BY ALL HAVING count(*) >= 2 ORDER BY n DESC, source_table, source_column, received_value LIMIT 50")
def dq_top_values(spark, sf_dir):
    return Q.dq_top_values(_records(spark, sf_dir))


@bed.query(f"SELECT count(*) AS total, count(*) FILTER (state = 'PENDIENTE') AS pendiente, count(*) FILTER (state = 'RESUELTO') AS resuelto, count(*) FILTER (state = 'DESCARTADO') AS descartado, count(*) FILTER (score >= 0.85) AS high, count(*) FILTER (score < 0.85) AS low FROM {_R}")
def quarantine_kpis(spark, sf_dir):
    return Q.quarantine_kpis(_records(spark, sf_dir))


@bed.query("SELECT week(ts)::INT AS week, CASE event_type WHEN 'click' THEN 'E1' WHEN 'error' THEN 'E2' ELSE 'OTHER' END AS code, count(*) AS n, sum(k)::BIGINT AS severity, sum(k)::DOUBLE / count(*) AS mean_severity FROM (SELECT *, (props::JSON ->> '$.k')::INT % 5 AS k FROM events) GROUP BY ALL")
def error_severity(spark, sf_dir):
    e = Tables(spark, sf_dir).events.withColumn("k", F.get_json_object("props", "$.k").cast("int") % 5)
    return Q.error_mart(e, {"CLICK": "E1", "ERROR": "E2"}, "event_type", F.weekofyear("ts"), "k")
