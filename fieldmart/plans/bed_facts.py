"""Fact pipelines and marts: raw text tables are rendered from lineitem, orders and events by fixed expressions on the key."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldmart.functions import dates as D
from fieldmart.operators import facts as T
from fieldmart.operators import marts as G
from fieldmart.operators import shape
from fieldmart.operators.dims import seed
from fieldmart.operators.joins import current_only
from fieldmart.plans.bed import Bed, Tables

bed = Bed()
C = F.col


def text(c):
    return (C(c) if isinstance(c, str) else c).cast("string")


def raw_lines(t):
    """Lines as text, with their keys whole; they are dated by the month, so that grains repeat."""
    q, month = F.replace(text("l_quantity"), F.lit("."), F.lit(",")), F.trunc("l_shipdate", "month").cast(t.lineitem.schema["l_shipdate"].dataType)
    return t.lineitem.withColumn("l_shipdate", month).select(
        C("l_orderkey").alias("seq_1"), C("l_linenumber").alias("seq_2"), C("l_partkey").alias("seq_3"), C("l_extendedprice").alias("seq_4"),
        F.when(C("l_partkey") % 23 == 0, "x").otherwise(F.date_format("l_shipdate", "dd/MM/yyyy")).alias("date_raw"), F.concat(F.lit("MODULO 0"), C("l_suppkey")).alias("module_raw"), F.concat(F.lit(" Variety  "), C("l_partkey")).alias("variety_raw"),
        F.concat(C("l_partkey"), F.lit(".0")).alias("person_raw"), q.alias("q"), text("l_linenumber").alias("n"), text("l_discount").alias("d"), text("l_extendedprice").alias("x"), C("l_returnflag").alias("f"), C("l_linestatus").alias("s"), "l_shipdate",
    )


STATES = ("BOTON FLORAL", "FLOR", "PEQUENA", "VERDE", "INICIO F1", "INICIO F2", "CREMA", "MADURA", "COSECHABLE")


def dims(t):
    """Whole dimensions, of which a share of the ids is missing."""
    state = F.array(*[F.lit(s) for s in STATES])
    return {
        "geo": t.supplier.where("s_suppkey % 8 <> 0").select(text("s_suppkey").alias("key"), (C("s_suppkey") + 1000).alias("id")),
        "variety": t.part.where("p_partkey % 6 <> 0").select(F.concat(F.lit("VARIETY"), "p_partkey").alias("key"), C("p_partkey").alias("id")),
        "person": t.customer.where("c_custkey % 14 <> 0").select(F.lpad(text("c_custkey"), 8, "0").alias("key"), C("c_custkey").alias("id")),
        "ribbon": t.region.select(F.when(C("r_regionkey") == 0, "roja").when(C("r_regionkey") == 1, "verde").otherwise(C("r_name")).alias("key"), C("r_regionkey").alias("id")),
        "activity": t.region.where("r_regionkey < 3").select(F.when(C("r_regionkey") == 0, "1-urgent").when(C("r_regionkey") == 1, "2-high").otherwise("3-medium").alias("key"), C("r_regionkey").alias("id")),
        "state": t.nation.where("n_nationkey < 9").select(F.element_at(state, (C("n_nationkey") + 1).cast("int")).alias("key"), C("n_nationkey").cast("int").alias("id")),
    }


_BASE = """b AS (SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, CASE WHEN l_partkey % 23 <> 0 THEN strftime(date_trunc('month', l_shipdate), '%Y%m%d')::INT END AS date_id, CASE WHEN l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_suppkey % 8 <> 0) THEN l_suppkey + 1000 END AS geo_id,
  CASE WHEN l_partkey IN (SELECT p_partkey FROM part WHERE p_partkey % 6 <> 0) THEN l_partkey END AS variety_id, CASE WHEN l_partkey IN (SELECT c_custkey FROM customer WHERE c_custkey % 14 <> 0) THEN l_partkey ELSE -1 END AS person_id, l_quantity AS q, l_linenumber AS n, l_discount AS d, l_extendedprice AS x, l_returnflag AS f, l_linestatus AS s, date_trunc('month', l_shipdate)::DATE AS day FROM lineitem)"""
_ORDER = "l_orderkey, l_linenumber, l_partkey, l_extendedprice"
_KNOWN = "date_id IS NOT NULL AND geo_id IS NOT NULL AND variety_id IS NOT NULL"


def fact_sql(grain: dict, measures: dict, where: str = "true", order: str = _ORDER) -> str:
    g = {"geo_id": "geo_id", "date_id": "date_id", "variety_id": "variety_id"} | grain
    columns = ", ".join(f"{e} AS {c}" for c, e in (g | measures).items())
    return f"WITH {_BASE}, c AS (SELECT *, row_number() OVER (PARTITION BY {', '.join(g.values())} ORDER BY {order}) AS r FROM b WHERE {_KNOWN} AND {where}) SELECT {columns} FROM c WHERE r = 1"


def overflow(**pairs):
    """Overflow text of the pairs: 'k=v | k=v'."""
    return F.concat_ws(" | ", *[F.concat(F.lit(f"{k}="), v) for k, v in pairs.items()])


def build(spark, sf_dir, fact, season=None, **columns):
    t = Tables(spark, sf_dir)
    return T.build_fact(raw_lines(t).withColumns(columns), dims(t), fact, season)[0]


_SEASON = ("1993-03-01", "1997-06-30")
_IN_SEASON = "day BETWEEN DATE '1993-03-01' AND DATE '1997-06-30'"


@bed.query(fact_sql({"condition": "CASE WHEN f = 'A' THEN 'SIN_CONDICION' ELSE f END"}, {"kg": "q", "crates": "n", "received": "CASE WHEN s = 'F' THEN day + 2 END"}, _IN_SEASON))
def fact_harvest(spark, sf_dir):
    """Two sources; the dates of harvest are held to the season, those of reception (in the overflow text) aren't."""
    t = Tables(spark, sf_dir)
    raw = raw_lines(t).withColumns({"kg_raw": C("q"), "crates_raw": C("n")})
    report = raw.where("s = 'O'").withColumn("condition_raw", F.when(C("f") == "A", "None").otherwise(C("f")))
    sap = raw.where("s = 'F'").withColumns({"condition_raw": F.when(C("f") == "A", F.lit(None)).otherwise(C("f")), "values_raw": overflow(received_raw=F.date_format(F.date_add("l_shipdate", 2), "d.M.yyyy"))})
    return T.build_fact(report.unionByName(sap, allowMissingColumns=True), dims(t), T.HARVEST, _SEASON)[0]


@bed.query(f"""WITH {_BASE}, u AS (SELECT *, 7 AS state_id, q::INT AS organs FROM b WHERE n % 4 = 0 UNION ALL SELECT *, 1, q::INT FROM b WHERE n % 4 IN (1, 2) UNION ALL SELECT *, 8, CASE WHEN n % 4 = 1 THEN 0 ELSE n END FROM b WHERE n % 4 IN (1, 2)),
c AS (SELECT *, row_number() OVER (PARTITION BY geo_id, date_id, variety_id, state_id, n % 3 ORDER BY day + to_seconds(n * 60) DESC, {_ORDER}) AS r FROM u WHERE {_KNOWN} AND d <> 0.05)
SELECT geo_id, date_id, variety_id, state_id, (n % 3)::VARCHAR AS point, organs FROM c WHERE r = 1""")
def fact_state_counts(spark, sf_dir):
    """A quarter of the rows is long, half is wide (in the overflow text), the rest has no states; counts that can't be read are 0."""
    t = Tables(spark, sf_dir)
    k = C("seq_2") % 4
    point = F.when(C("seq_2") % 3 != 0, text(C("seq_2") % 3))
    wide = overflow(Flores_Raw=C("q"), Bayas_Cosechables_Raw=F.when(k == 1, "x").otherwise(C("n")), Punto_Raw=point)
    kind = F.when(C("d") == "0.05", "Riego").when(C("f") == "A", "CONTEO de flores").when(C("f") == "R", " Poda  general.")
    columns = {"state_raw": F.when(k == 0, " madura "), "organs_raw": F.when(k == 0, C("q")), "values_raw": F.when(k.isin(1, 2), wide).otherwise(overflow(Punto=point)), "type_raw": kind, "recorded_raw": F.date_format(F.expr("l_shipdate + make_dt_interval(0, 0, seq_2, 0)"), "yyyy-MM-dd HH:mm:ss")}
    return T.build_fact(raw_lines(t).withColumns(columns), dims(t), T.STATE_COUNTS)[0]


@bed.query(f"""WITH {_BASE}, o AS (SELECT *, CASE f WHEN 'A' THEN 0 WHEN 'R' THEN 1 END AS ribbon_id, (q % 7)::INT AS organ, CASE WHEN n % 2 = 0 THEN 3 WHEN l_orderkey % 12 <= 8 THEN (l_orderkey % 12)::INT END AS state_id, day + to_seconds(n * 60) AS recorded FROM b)
SELECT geo_id, date_id, variety_id, ribbon_id, organ, state_id, person_id, recorded FROM (SELECT *, row_number() OVER (PARTITION BY geo_id, date_id, variety_id, ribbon_id, organ ORDER BY recorded DESC, {_ORDER}) AS r
FROM o WHERE {_KNOWN} AND ribbon_id IS NOT NULL AND organ >= 1 AND state_id IS NOT NULL) WHERE r = 1""")
def fact_organ(spark, sf_dir):
    """Everything is in the overflow text; the state by its description, else by its number; masculine colours are their ribbon's."""
    t = Tables(spark, sf_dir)
    raw = raw_lines(t)
    organ = (F.replace(C("q"), F.lit(","), F.lit(".")).cast("double") % 7).cast("int")
    values = overflow(
        date_raw=C("date_raw"), module_raw=C("module_raw"), variety_raw=C("variety_raw"), person_raw=C("person_raw"), ribbon_raw=F.when(C("f") == "A", " Rojo").when(C("f") == "R", "VERDE").otherwise("gris"), organ_raw=F.concat(F.lit("organ "), organ),
        state_raw=F.when(C("seq_2") % 2 == 0, "Verde.").otherwise("??"), state_id_raw=text(C("seq_1") % 12), recorded_raw=F.date_format(F.expr("l_shipdate + make_dt_interval(0, 0, seq_2, 0)"), "yyyy-MM-dd HH:mm"),
    )
    hidden = raw.select("seq_1", "seq_2", "seq_3", "seq_4", values.alias("values_raw"))
    return T.build_fact(hidden, dims(t), T.ORGAN)[0].withColumn("recorded", C("recorded").cast("timestamp_ntz"))


@bed.query(fact_sql({"point": "CASE WHEN f = 'R' THEN 1 ELSE n END"}, {"samples": "n - 1", "person_id": "person_id", "flowers": "greatest(q - 10, 0)::INT", "small": "0", **{c: f"n + {i}" for i, c in enumerate(T.SAMPLED) if c not in ("flowers", "small")}}, "n - 1 >= 1"))
def fact_sampling(spark, sf_dir):
    counts = {f"{c}_raw": text(C("seq_2") + i) for i, c in enumerate(T.SAMPLED) if c not in ("flowers", "small")}
    hidden = {k: counts.pop(k) for k in ("cream_raw", "productive_raw")}
    return build(spark, sf_dir, T.SAMPLING, samples_raw=text(C("seq_2") - 1), flowers_raw=text(F.replace("q", F.lit(","), F.lit(".")).cast("double") - 10), small_raw=F.lit("x"), point_raw=F.when(C("f") != "R", C("n")), values_raw=overflow(**hidden), **counts)


@bed.query(fact_sql({"person_id": "person_id"}, {"weight": "CASE WHEN f = 'R' THEN round(q / n, 4) ELSE round((q + 2 * n) / (3.0 * n), 4) END", "samples": "CASE WHEN f = 'R' THEN n ELSE 3 * n END"}, "(f <> 'R' OR n > 0) AND CASE WHEN f = 'R' THEN round(q / n, 4) ELSE round((q + 2 * n) / (3.0 * n), 4) END BETWEEN 0.5 AND 8"))
def fact_weights(spark, sf_dir):
    """A third of the rows has the weight and the sample directly, the others by category; half of the places come from the valve."""
    t = Tables(spark, sf_dir)
    own, dot = C("f") == "R", F.replace("q", F.lit(","), F.lit("."))
    columns = {
        "weight_raw": F.when(own, dot), "samples_raw": F.when(own, C("n")), "small_raw": F.when(~own, C("n")), "small_weight_raw": F.when(~own, dot), "large_raw": F.when(~own, C("n")), "ripe_raw": F.when(~own, C("n")), "ripe_weight_raw": F.when(~own, text(2 * C("seq_2"))),
        "cream_raw": F.when(~own, "nan"), "valve_raw": C("module_raw"),
    }
    raw = raw_lines(t).withColumns(columns).withColumn("module_raw", F.when(C("seq_3") % 2 == 0, "None").otherwise(C("module_raw")))
    return T.build_fact(raw, dims(t), T.WEIGHTS)[0]


@bed.query(fact_sql({"third": "CASE f WHEN 'A' THEN 'ALTO' ELSE f END"}, {"shoots": "CASE WHEN n % 2 = 0 THEN q::INT ELSE n END", "vegetative": "n * 2", "swollen": "CASE WHEN f <> 'N' THEN n END", "productive": "n + 1", "total": "q::INT"}, "s = (SELECT max(l_linestatus) FROM lineitem WHERE year(l_shipdate) = (SELECT max(year(l_shipdate)) FROM lineitem)) AND year(day) = (SELECT max(year(l_shipdate)) FROM lineitem)"))
def fact_physiology(spark, sf_dir):
    """The newest batch alone: the year of shipping stands for the load time, the line status for the file."""
    t = Tables(spark, sf_dir)
    columns = {
        "third_raw": F.lower("f"), "shoots_prod_raw": F.when(C("seq_2") % 2 == 0, C("q")), "shoots_raw": C("n"), "vegetative_raw": text(C("seq_2") * 2), "swollen_raw": F.when(C("f") != "N", C("n")).otherwise("None"), "total_raw": C("q"),
        "values_raw": overflow(productive_raw=text(C("seq_2") + 1)), "loaded": F.year("l_shipdate"),
    }
    return T.build_physiology(raw_lines(t).withColumns(columns), dims(t), "loaded", "s")[0]


def _vegetative(t):
    columns = {"evaluated_raw": C("q"), "flowering_raw": text(C("seq_2") * 3), "kind_raw": F.concat(F.lit("TYPE "), "s"), "shift_raw": C("n"), "valve_raw": C("f"), "bed_raw": F.when(C("seq_2") > 2, C("d")), "load_state": F.lit("CARGADO")}
    return raw_lines(t).withColumns(columns)


@bed.query(fact_sql({"person_id": "person_id", "kind": "CASE s WHEN 'O' THEN 'Type O' ELSE 'Type F' END"}, {"evaluated": "q::INT", "flowering": "n * 3"}, "q > 0 AND n * 3 <= q"))
def fact_vegetative(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return T.build_fact(_vegetative(t), dims(t), T.VEGETATIVE)[0]


@bed.query(f"WITH {_BASE} SELECT CASE WHEN {_KNOWN} AND q > 0 AND n * 3 <= q THEN 'PROCESADO' ELSE 'RECHAZADO' END AS load_state, s AS status, count(*) AS n FROM b GROUP BY ALL")
def fact_vegetative_marks(spark, sf_dir):
    """Raw rows have no id here: what was rejected is marked by its signature, one row for each reject."""
    t = Tables(spark, sf_dir)
    raw = _vegetative(t)
    marked = T.mark_vegetative(raw, T.build_fact(raw, dims(t), T.VEGETATIVE)[1])
    return marked.groupBy("load_state", C("s").alias("status")).agg(F.count("*").alias("n"))


@bed.query(fact_sql({"person_id": "person_id", "kind": "s", "consumer": "CASE WHEN f <> 'N' THEN 'c ' || f END"}, {"plants": "q::INT", "plants_induced": "n", "shoots_induced": "n - 1", "shoots": "n", "shoots_flowering": "n // 2", "pct_plants_induced": "round(n / q * 100, 2)", "pct_shoots_induced": "round((n - 1) / n * 100, 2)", "pct_shoots_flowering": "round((n // 2) / n * 100, 2)"}, "q > 0 AND n <= q AND f || s <> 'RF'"))
def fact_induction(spark, sf_dir):
    """The variety comes from the description where its own column is null; more flowering shoots than shoots are rejected."""
    flowering = F.when(F.concat("f", "s") == "RF", C("seq_2") + 1).otherwise((C("seq_2") / 2).cast("int"))
    return build(
        spark, sf_dir, T.INDUCTION, plants_raw=C("q"), plants_induced_raw=C("n"), shoots_induced_raw=text(C("seq_2") - 1), shoots_raw=C("n"), shoots_flowering_raw=text(flowering), kind_raw=F.concat(F.lit(" "), "s"), consumer_raw=F.when(C("f") == "N", "nan").otherwise(F.concat(F.lit("c "), "f")),
        description_raw=C("variety_raw"), variety_raw=F.when(C("seq_2") % 2 == 0, C("variety_raw")),
    )


@bed.query(fact_sql({"kind": "f", "stem": "s", "trial": "'T' || n % 4", "origin": "CASE WHEN n % 3 > 0 THEN 'O' || n % 3 END", "measure": "q"}, {"person_id": "person_id", "pruned": "CASE WHEN n % 2 = 0 THEN DATE '1994-06-01' END", "days": "CASE WHEN n % 2 = 0 THEN date_diff('day', DATE '1994-06-01', day)::INT END", "condition": "NULL::VARCHAR", "vegetative_state": "'v' || n", "campaign": "'c'"}, "n % 4 <> 3 AND (n % 2 = 1 OR day >= DATE '1994-06-01') AND n <> 5"))
def fact_growth(spark, sf_dir):
    """Without a pruning date the days are NULL; one that can't be read, or lies after the measurement, is rejected."""
    pruned = F.when(C("seq_2") % 2 == 0, "1/6/1994").when(C("seq_2") == 5, "soon")
    return build(
        spark, sf_dir, T.GROWTH, kind_raw=C("f"), stem_raw=F.concat(C("s"), F.lit("  ")), measure_raw=C("q"), pruned_raw=pruned, trial_raw=F.when(C("seq_2") % 4 != 3, F.concat(F.lit("T"), C("seq_2") % 4)).otherwise("None"), origin_raw=F.when(C("seq_2") % 3 > 0, F.concat(F.lit("O"), C("seq_2") % 3)),
        condition_raw=F.lit(None).cast("string"), vegetative_state_raw=F.concat(F.lit("v"), "n"), campaign_raw=F.lit("c"),
    )


@bed.query(fact_sql({}, {"alive": "q::INT", "dead": "n", "mortality": "round(n / (q + n) * 100, 2)"}))
def fact_health(spark, sf_dir):
    return build(spark, sf_dir, T.HEALTH, alive_raw=C("q"), dead_raw=C("n"))


@bed.query(fact_sql({"kind": "CASE f WHEN 'A' THEN 'SIN_TIPO' WHEN 'R' THEN 'Kind R' ELSE 'Kind N' END"}, {"stems": "q", "height": "d", **{c: f"n + {i}.5" for i, c in enumerate(T.PRUNED) if c not in ("stems", "height", "twigs")}, "twigs": "NULL::DOUBLE"}))
def fact_pruning(spark, sf_dir):
    more = {f"{c}_raw": F.concat(C("seq_2") + i, F.lit(",5")) for i, c in enumerate(T.PRUNED) if c not in ("stems", "height", "twigs")}
    return build(spark, sf_dir, T.PRUNING, kind_raw=F.when(C("f") == "A", "  ").otherwise(F.concat(F.lit("KIND "), "f")), stems_raw=C("q"), height_raw=C("d"), twigs_raw=F.lit("n/a"), **more)


@bed.query("""WITH r AS (SELECT o_orderkey, strftime(date_trunc('month', o_orderdate), '%Y%m%d')::INT AS date_id, CASE WHEN o_custkey IN (SELECT s_suppkey FROM supplier WHERE s_suppkey % 8 <> 0) THEN o_custkey + 1000 END AS geo_id, CASE WHEN o_custkey IN (SELECT c_custkey FROM customer WHERE c_custkey % 14 <> 0) THEN o_custkey ELSE -1 END AS person_id, CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1 WHEN '3-MEDIUM' THEN 2 END AS activity_id,
  CASE WHEN o_orderkey % 5 = 0 THEN 0 ELSE o_totalprice END AS hours, CASE WHEN o_custkey * 3 IN (SELECT c_custkey FROM customer WHERE c_custkey % 14 <> 0) THEN o_custkey * 3 END AS boss_id, CASE WHEN o_orderkey % 3 > 0 THEN 'P' || o_orderkey % 3 END AS payroll FROM orders WHERE o_orderstatus <> 'P')
SELECT geo_id, date_id, person_id, activity_id, hours, payroll, boss_id FROM (SELECT *, row_number() OVER (PARTITION BY geo_id, date_id, person_id, activity_id ORDER BY o_orderkey) AS n FROM r WHERE activity_id IS NOT NULL AND geo_id IS NOT NULL) WHERE n = 1""")
def fact_labour(spark, sf_dir):
    t = Tables(spark, sf_dir)
    raw = t.orders.select(
        C("o_orderkey").alias("seq_1"), F.date_format(F.trunc("o_orderdate", "month"), "yyyy-MM-dd").alias("date_raw"), F.concat(F.lit("modulo "), C("o_custkey")).alias("module_raw"), text("o_custkey").alias("person_raw"), text(C("o_custkey") * 3).alias("boss_raw"), C("o_orderpriority").alias("activity_raw"),
        F.when(C("o_orderkey") % 5 == 0, "x").otherwise(text(C("o_totalprice").cast("decimal(18,2)"))).alias("hours_raw"), F.when(C("o_orderkey") % 3 == 0, "").otherwise(F.concat(F.lit("P"), C("o_orderkey") % 3)).alias("payroll_raw"), "o_orderstatus",
    )
    kept, _ = shape.drop_non_operational(raw, {"o_orderstatus": ("P", "TOTAL")})
    return T.build_fact(kept, dims(t), T.LABOUR)[0]


# readings of both layouts by the event's parity, as the telemetry fact sees them; the calendar lacks the days divisible by 9
_READ = """e AS (SELECT event_id, ts, value, (props::JSON ->> '$.k')::INT AS k, event_id % 2 AS layout, CASE WHEN event_id % 31 > 0 THEN upper(event_type) END AS sector, date_trunc('hour', ts) AS read_at FROM events),
v AS (SELECT *, strftime(read_at, '%Y%m%d')::INT AS date_id, round(value, 0) AS tmax, round(value, 0) - 5 AS tmin, CASE WHEN k % 3 <= 1 THEN k % 3 * 100.0 WHEN layout = 1 THEN NULL ELSE 2.0 END AS humidity, CASE WHEN layout = 0 THEN (k % 2)::DOUBLE END AS rain, CASE WHEN layout = 1 THEN k % 2 + 0.5 END AS vpd, CASE WHEN layout = 1 THEN 7.25 END AS radiation FROM e),
s AS (SELECT *, row_number() OVER (PARTITION BY layout, sector, read_at ORDER BY event_id) AS r, min({'a': tmax, 'b': humidity, 'c': rain, 'd': vpd}) OVER w IS NOT DISTINCT FROM max({'a': tmax, 'b': humidity, 'c': rain, 'd': vpd}) OVER w AS same FROM v WHERE sector IS NOT NULL AND day(read_at) % 9 <> 0 WINDOW w AS (PARTITION BY layout, sector, read_at)),
u AS (SELECT *, row_number() OVER (PARTITION BY sector, read_at ORDER BY layout, event_id) AS first FROM s WHERE same AND r = 1)"""


def _telemetry(t):
    k = F.get_json_object("props", "$.k").cast("int")
    common = {"seq_1": C("event_id"), "sector_raw": F.when(C("event_id") % 31 == 0, " ").otherwise(C("event_type")), "tmax_raw": text(F.round("value", 0)), "tmin_raw": F.replace(text(F.round("value", 0) - 5), F.lit("."), F.lit(","))}
    pick = lambda extra: [c.alias(n) for n, c in (common | extra).items()]
    report = t.events.where("event_id % 2 = 0").select(*pick({"date_raw": F.date_format("ts", "dd/MM/yyyy"), "hour_raw": F.date_format("ts", "H:00"), "humidity_raw": text(k % 3), "rain_raw": text(k % 2)}))
    humidity = F.when(k % 3 == 2, "120").otherwise(text(k % 3))
    variables = t.events.where("event_id % 2 = 1").select(*pick({"date_raw": F.date_format("ts", "yyyy-MM-dd"), "values_raw": F.concat(F.lit("a=1 | Hora_Raw="), F.date_format("ts", "HH:00:00"), F.lit(" | b=2")), "humidity_raw": humidity, "vpd_raw": F.concat(k % 2, F.lit(",5")), "radiation_raw": F.lit("7.25")}))
    calendar = t.events.select(D.date_id(C("ts")).alias("date_id"), F.to_date("ts").alias("day")).distinct().where("date_id % 100 % 9 <> 0")
    return T.build_telemetry(report, variables, calendar)[0], calendar


@bed.query(f"WITH {_READ} SELECT sector, read_at, date_id, tmax, tmin, humidity::DOUBLE AS humidity, rain, vpd::DOUBLE AS vpd, radiation::DOUBLE AS radiation, layout::INT AS layout FROM u WHERE first = 1")
def fact_telemetry(spark, sf_dir):
    kept, _ = _telemetry(Tables(spark, sf_dir))
    return kept.withColumn("read_at", C("read_at").cast("timestamp_ntz")).drop("seq_1")


# --- marts -------------------------------------------------------------------------------------------------------


@bed.query(f"""WITH {_READ}, m AS (SELECT date_id, read_at::DATE AS day, sector, count(*) AS readings, sum(tmax::DECIMAL(18,3))::DOUBLE / count(tmax) AS tmax, sum(tmin::DECIMAL(18,3))::DOUBLE / count(tmin) AS tmin, CASE WHEN count(vpd) > 0 THEN sum(vpd::DECIMAL(18,3))::DOUBLE / count(vpd) END AS vpd,
CASE WHEN count(humidity) > 0 THEN sum(humidity::DECIMAL(18,3))::DOUBLE / count(humidity) END AS humidity, sum(rain::DECIMAL(18,3))::DOUBLE AS rain FROM u WHERE first = 1 GROUP BY ALL) SELECT *, (tmax + tmin) / 2 AS tmean FROM m""")
def mart_weather(spark, sf_dir):
    """Raw text of two layouts, cleaning, conflicting-reading rejection, the calendar and the daily mart in one lineage."""
    fact, calendar = _telemetry(Tables(spark, sf_dir))
    return G.mart_weather(fact, calendar)


@bed.query("""WITH h AS (SELECT o_orderkey, o_custkey, sum(l_quantity::DECIMAL(18,2))::DOUBLE AS kg, count(*) AS lines FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R' GROUP BY 1, 2),
v AS (SELECT * FROM customer WHERE c_custkey % 6 <> 0), p AS (SELECT c_nationkey, sum(c_acctbal::DECIMAL(18,2))::DOUBLE AS projected FROM customer WHERE c_mktsegment = 'MACHINERY' GROUP BY 1)
SELECT o_orderkey, n_name, r_name, kg, lines, projected FROM h JOIN v ON o_custkey = c_custkey JOIN nation n ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey LEFT JOIN p ON p.c_nationkey = v.c_nationkey""")
def mart_harvest(spark, sf_dir):
    t = Tables(spark, sf_dir)
    fact = t.lineitem.where("l_returnflag = 'R'").join(t.orders, C("l_orderkey") == C("o_orderkey")).groupBy("o_orderkey", "o_custkey").agg(F.sum(G.exact("l_quantity")).cast("double").alias("kg"), F.count("*").alias("lines"))
    projections = t.customer.select("c_nationkey", C("c_mktsegment").alias("scenario"), C("c_acctbal").alias("projected"))
    places = current_only(t.customer.withColumn("is_current", C("c_custkey") % 6 != 0)).select("c_custkey", "c_nationkey")
    dims_ = [(places, "o_custkey", "c_custkey"), (t.nation, "c_nationkey", "n_nationkey"), (t.region, "n_regionkey", "r_regionkey")]
    return G.mart_harvest(fact, dims_, projections, "MACHINERY", ["c_nationkey"]).select("o_orderkey", "n_name", "r_name", "kg", "lines", "projected")


@bed.query("SELECT o_orderkey, o_totalprice, CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'F' THEN 'done' END AS label FROM orders")
def mart_projection(spark, sf_dir):
    t = Tables(spark, sf_dir)
    states = t.region.where("r_regionkey < 2").select(F.when(C("r_regionkey") == 0, "O").otherwise("F").alias("state_code"), F.when(C("r_regionkey") == 0, "open").otherwise("done").alias("label"))
    return G.mart_projection(t.orders.select("o_orderkey", "o_totalprice", C("o_orderstatus").alias("state_code")), states).select("o_orderkey", "o_totalprice", "label")


@bed.query("SELECT l_shipdate, n_name, CASE l_returnflag WHEN 'A' THEN 'Flor' WHEN 'N' THEN 'Verde' ELSE 'Madura' END AS label, CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 3 ELSE 7 END AS state_order, sum(l_linenumber)::BIGINT AS organs FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY ALL")
def mart_phenology(spark, sf_dir):
    t = Tables(spark, sf_dir)
    states = seed(spark, "state").where("id in (1, 3, 7)").select(F.when(C("id") == 1, "A").when(C("id") == 3, "N").otherwise("R").alias("state_id"), "label", C("id").alias("state_order"))
    return G.mart_phenology(t.lineitem, [(t.supplier, "l_suppkey", "s_suppkey"), (t.nation, "s_nationkey", "n_nationkey")], ["l_shipdate", "n_name"], "l_linenumber", states, "l_returnflag")


@bed.query("SELECT p_brand, l_shipdate, sum(l_quantity::DECIMAL(18,2))::DOUBLE / count(l_quantity) AS mean_weight, sum(l_linenumber)::BIGINT AS samples FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL")
def mart_weights(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return G.mart_weights(t.lineitem, [(t.part, "l_partkey", "p_partkey")], ["p_brand", "l_shipdate"], "l_quantity", "l_linenumber")


@bed.query("""SELECT w.n_name AS worker, coalesce(b.n_name, 'NO SUPERVISOR') AS boss, sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS hours, sum((o_orderstatus = 'F')::INT)::BIGINT AS flagged
FROM (SELECT *, o_custkey % 25 AS wk, o_custkey % 30 AS bk FROM orders) LEFT JOIN nation w ON wk = w.n_nationkey LEFT JOIN nation b ON bk = b.n_nationkey GROUP BY ALL""")
def mart_labour(spark, sf_dir):
    t = Tables(spark, sf_dir)
    fact = t.orders.withColumns({"wk": C("o_custkey") % 25, "bk": C("o_custkey") % 30})
    return G.mart_labour(fact, t.nation, "n_nationkey", "n_name", {"wk": "worker", "bk": "boss"}, ["worker", "boss"], "o_totalprice", C("o_orderstatus") == "F")


@bed.query("SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_linenumber > 0 THEN l_extendedprice / l_linenumber END * 1.0 AS per_crate, CASE WHEN l_discount > 0 THEN l_tax / l_discount END * 100.0 AS compliance FROM lineitem")
def mart_derived(spark, sf_dir):
    t = Tables(spark, sf_dir).lineitem
    return G.with_derived(t, {"per_crate": (C("l_extendedprice"), C("l_linenumber"), 1.0), "compliance": (C("l_tax"), C("l_discount"), 100.0)}).select("l_orderkey", "l_linenumber", "l_partkey", "per_crate", "compliance")
