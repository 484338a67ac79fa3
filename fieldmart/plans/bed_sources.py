"""Raw-layer operators on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldmart.operators import shape
from fieldmart.plans.bed import Bed, Tables, shared_folder
from fieldmart.sources import kv
from fieldmart.sources import raw as R

bed = Bed()
C = F.col


@bed.query("SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 30")
def scan_filter_project(spark, sf_dir):
    return R.scan_raw(spark, f"{sf_dir}/lineitem.parquet", ["l_orderkey", "l_partkey", "l_quantity"], (C("l_returnflag") == "R") & (C("l_quantity") > 30))


@bed.query("SELECT o_orderkey, o_orderstatus, NULL::VARCHAR AS campaign FROM orders WHERE o_orderstatus = 'F'")
def select_or_null(spark, sf_dir):
    o = shape.filter_if_present(shape.filter_if_present(Tables(spark, sf_dir).orders, "o_orderstatus", "F"), "load_state", "CARGADO")
    return shape.select_or_null(o, ["o_orderkey", "o_orderstatus", "campaign"])


@bed.query("WITH e AS (SELECT *, ts::DATE AS day, 'f' || user_id % 7 AS file FROM events) SELECT event_id FROM e WHERE day = (SELECT max(day) FROM e) AND file = (SELECT max(file) FROM e WHERE day = (SELECT max(day) FROM e))")
def latest_batch(spark, sf_dir):
    e = Tables(spark, sf_dir).events.withColumns({"day": F.to_date("ts"), "file": F.concat(F.lit("f"), C("user_id") % 7)})
    return R.latest_batch(e, "day", "file").select("event_id")


@bed.query("SELECT user_id, arg_max(event_id, {'t': ts, 'p': event_id}) AS event_id, max(ts) AS ts FROM events WHERE event_type <> 'error' GROUP BY 1")
def newest_per_key(spark, sf_dir):
    e = Tables(spark, sf_dir).events.select("user_id", "ts", "event_id", "event_type")
    return R.newest_per_source(e.drop("event_type"), "user_id", "ts", "event_id", e.where("event_type = 'error'"))


@bed.query("""WITH r AS (SELECT unnest(['example', 'blog', 'fr_blog', 'blog_th']) AS pattern, unnest(['any', 'blogs', 'french', 'th blogs']) AS target),
a AS (SELECT unnest([1, 2]) AS priority, unnest(['page_7', 'html_9']) AS pattern, unnest(['sevens', 'nines']) AS target),
p AS (SELECT page_id, trim(regexp_replace(lower(strip_accents(url)), '[^a-z0-9]+', '_', 'g'), '_') AS k FROM pages)
SELECT page_id, coalesce((SELECT first(target ORDER BY priority) FROM a WHERE contains(k, pattern)), (SELECT first(target ORDER BY len(pattern) DESC, pattern) FROM r WHERE contains(k, pattern))) AS target FROM p""")
def route_longest_match(spark, sf_dir):
    routes = spark.createDataFrame([("example", "any"), ("Blog", "blogs"), ("/fr/blog", "french"), ("blog.th", "th blogs")], "pattern string, target string")
    aliases = spark.createDataFrame([(1, "Page 7", "sevens"), (2, "html-9", "nines")], "priority int, pattern string, target string")
    return R.route_files(Tables(spark, sf_dir).pages.select("page_id", "url"), "url", routes, aliases).select("page_id", "target")


@bed.query("SELECT c_custkey, CASE WHEN c_custkey % 3 <> 0 THEN c_name WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS name FROM customer")
def coalesce_first_nonblank(spark, sf_dir):
    c = Tables(spark, sf_dir).customer.select("c_custkey", F.when(C("c_custkey") % 3 == 0, "  ").otherwise(C("c_name")).alias("name"), F.when(C("c_custkey") % 2 == 0, C("c_mktsegment")).alias("name__2"))
    return shape.coalesce_duplicate_columns(c, {"name": ["name", "name__2"]})


@bed.query("SELECT s_suppkey::VARCHAR AS s_suppkey, s_name, s_nationkey::VARCHAR AS s_nationkey FROM supplier")
def to_text(spark, sf_dir):
    return shape.to_text(Tables(spark, sf_dir).supplier.select("s_suppkey", F.concat(F.lit(" "), "s_name", F.lit("  ")).alias("s_name"), "s_nationkey"))


def _blank_orders(t):
    return t.orders.select(C("o_orderkey").cast("string").alias("key"), F.when(C("o_orderkey") % 3 != 0, C("o_orderstatus")).alias("state"), F.when(C("o_orderkey") % 4 == 0, "P").otherwise(" ").alias("state_2"), F.when(C("o_orderkey") % 2 == 0, C("o_orderpriority")).alias("extra"), C("o_custkey").alias("client"))


@bed.query("SELECT o_orderkey::VARCHAR AS key, coalesce(CASE WHEN o_orderkey % 3 <> 0 THEN o_orderstatus END, CASE WHEN o_orderkey % 4 = 0 THEN 'P' END) AS state, NULL::VARCHAR AS campaign, CASE WHEN o_orderkey % 2 = 0 THEN 2 ELSE 1 END AS n, o_custkey::VARCHAR AS client FROM orders")
def overflow_map(spark, sf_dir):
    aligned = R.align_to_target(_blank_orders(Tables(spark, sf_dir)), ["key", "state", "campaign"], {"state": ["state_2"]})
    return aligned.select("key", "state", "campaign", F.size("overflow").alias("n"), C("overflow")["client"].alias("client"))


@bed.query("SELECT o_orderkey::VARCHAR AS key, 'client=' || o_custkey || CASE WHEN o_orderkey % 2 = 0 THEN ' | extra=' || o_orderpriority ELSE '' END AS text FROM orders")
def kv_encode(spark, sf_dir):
    t = _blank_orders(Tables(spark, sf_dir)).select("key", "extra", "client")
    return kv.overflow_map(t, ["key"]).select("key", kv.encode_kv(C("overflow")).alias("text"))


@bed.query("SELECT p_partkey AS id, upper(p_name) AS variety, p_retailprice * 2 AS price, 'F07' AS sector FROM part WHERE p_type = 'ECONOMY'")
def project_layout(spark, sf_dir):
    spec = R.LayoutSpec({"id": "p_partkey", "variety": "upper(p_name)", "price": "p_retailprice * 2"}, {"sector": r"\b([A-Z]\d{2})\b"}, "p_type = 'ECONOMY'")
    return R.project_layout(Tables(spark, sf_dir).part, spec, F.lit("/in/weather F07 2026.csv"))


@bed.query("""SELECT l_orderkey::VARCHAR AS Codigo_Origen_Raw, l_linenumber::VARCHAR AS Modulo_Raw, l_quantity::VARCHAR AS Medida_Raw, 'FLAG=' || l_returnflag || CASE WHEN l_partkey % 2 = 0 THEN ' | PART=' || l_partkey ELSE '' END AS Valores_Raw, NULL::VARCHAR AS Ensayo_Raw FROM lineitem""")
def read_layout(spark, sf_dir):
    t = Tables(spark, sf_dir).lineitem
    text = {"Unnamed0_Raw": C("l_orderkey"), "Mod_Raw": C("l_linenumber"), "Medida_Raw": C("l_quantity"), "FLAG": C("l_returnflag"), "PART": F.when(C("l_partkey") % 2 == 0, C("l_partkey"))}
    file = t.select(*[c.cast("string").alias(n) for n, c in text.items()])
    return R.read_layout(file, "shoot_growth", F.lit("growth.xlsx")).select("Codigo_Origen_Raw", "Modulo_Raw", "Medida_Raw", "Valores_Raw", "Ensayo_Raw")


@bed.query("SELECT event_id::VARCHAR AS Hora_Raw, 'F07' AS Sector_Raw, value::VARCHAR AS TempMax_Raw, 'id=' || user_id AS Valores_Raw FROM events")
def read_weather_layout(spark, sf_dir):
    e = Tables(spark, sf_dir).events
    file = e.select(C("event_id").cast("string").alias("Hora_Raw"), C("value").cast("string").alias("TempMax_Raw"), C("user_id").cast("string").alias("id"))
    return R.read_layout(file, "weather_report", F.lit("/in/clima f07 2026.xlsx")).select("Hora_Raw", F.upper("Sector_Raw").alias("Sector_Raw"), "TempMax_Raw", "Valores_Raw")


@bed.query("SELECT count(*) AS n FROM orders WHERE NOT (o_orderkey % 3 = 0 AND o_orderkey % 2 = 1)")
def drop_empty_rows(spark, sf_dir):
    t = _blank_orders(Tables(spark, sf_dir)).select("state", "extra")
    return shape.drop_empty_rows(t).agg(F.count("*").alias("n"))


@bed.query("SELECT table_name, columns, rows FROM (SELECT 'orders' AS table_name, 6 AS columns, count(*) AS rows FROM orders UNION ALL SELECT 'part', 6, count(*) FROM part)")
def inventory(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return R.inventory({"orders": t.orders, "part": t.part})


def _files(t):
    names = F.array(*[F.when(C("p_size") % (i + 2) != 0, F.lit(f"c{i}")) for i in range(8)])
    return t.part.select(C("p_partkey").alias("file"), F.when(C("p_partkey") % 3 == 0, "a").when(C("p_partkey") % 3 == 1, "b").otherwise("z").alias("target"), F.filter(names, lambda x: x.isNotNull()).alias("columns"))


def _signatures(spark):
    either = [[["c2", "c3"], ["c4"]], [["c5"], ["c6"]]]
    return spark.createDataFrame([("a", ["c0", "c1"], ["c7"], either), ("b", ["c2", "c3", "c4", "c5", "c6", "c7"], [], None)], "target string, required array<string>, forbidden array<string>, alternatives array<array<array<string>>>")


_FILES = "(SELECT p_partkey AS file, CASE p_partkey % 3 WHEN 0 THEN 'a' WHEN 1 THEN 'b' ELSE 'z' END AS target, list_filter(list_transform(range(8), lambda i: CASE WHEN p_size % (i + 2) <> 0 THEN 'c' || i END), lambda x: x IS NOT NULL) AS columns FROM part)"
_MISS = "array_to_string(list_sort(list_filter({}, lambda x: NOT list_contains(columns, x))), ',')"


@bed.query(f"""SELECT file, reason IS NULL AS accepted, reason FROM (SELECT file, CASE WHEN target = 'z' THEN 'no signature' WHEN m <> '' THEN 'missing ' || m WHEN target = 'a' AND g <> '' THEN 'missing one of ' || g WHEN target = 'a' AND list_contains(columns, 'c7') THEN 'incompatible c7' END AS reason FROM
  (SELECT *, concat_ws(', ', CASE WHEN NOT (list_has_all(columns, ['c2', 'c3']) OR list_contains(columns, 'c4')) THEN 'c2+c3 or c4' END, CASE WHEN NOT (list_contains(columns, 'c5') OR list_contains(columns, 'c6')) THEN 'c5 or c6' END) AS g, CASE target WHEN 'a' THEN {_MISS.format("['c0', 'c1']")} ELSE {_MISS.format("['c2', 'c3', 'c4', 'c5', 'c6', 'c7']")} END AS m FROM {_FILES}))""")
def layout_gate(spark, sf_dir):
    return R.check_layout(_files(Tables(spark, sf_dir)), "columns", _signatures(spark)).select("file", "accepted", "reason")


@bed.query(f"""SELECT file, target, CASE WHEN target <> 'b' AND (target = 'z' OR len(list_intersect(columns, ['c0', 'c1'])) / 2.0 < 0.5) AND len(list_intersect(columns, ['c2', 'c3', 'c4', 'c5', 'c6', 'c7'])) = 6 THEN 'b' END AS suggestion FROM {_FILES}""")
def route_by_signature(spark, sf_dir):
    return R.suggest_route(_files(Tables(spark, sf_dir)), "file", "columns", _signatures(spark))


@bed.query("""WITH c AS (SELECT CASE WHEN l_suppkey % 2 = 0 THEN CASE WHEN l_linenumber % 5 = 0 THEN l_linenumber ELSE 7 END END AS sector, l_linenumber % 5 AS module, l_suppkey % 4 AS shift, (l_quantity % 6)::INT AS valve FROM lineitem WHERE l_partkey % 9 <> 0),
s AS (SELECT module, min(sector) AS low FROM c GROUP BY 1 HAVING min(sector) = max(sector)) SELECT DISTINCT coalesce(sector, low) AS sector, c.module, shift::INT AS shift, valve FROM c LEFT JOIN s ON c.module = s.module""")
def extract_codes(spark, sf_dir):
    tail = F.concat(F.lit("M"), C("l_linenumber") % 5, F.lit("T"), C("l_suppkey") % 4, F.lit("V"), (C("l_quantity") % 6).cast("int"))
    sector = F.when(C("l_linenumber") % 5 == 0, C("l_linenumber")).otherwise(7)
    cell = F.when(C("l_partkey") % 9 == 0, "note").when(C("l_suppkey") % 2 == 0, F.concat(F.lit("S"), sector, tail)).otherwise(F.lower(F.regexp_replace(tail, "([TV])", "-$1")))
    return R.extract_codes(Tables(spark, sf_dir).lineitem.select(cell.alias("cell")), "cell")


@bed.query("SELECT n_nationkey, n_name, n_regionkey FROM nation")
def csv_roundtrip(spark, sf_dir):
    path = shared_folder(spark, "csv")
    R.export_csv(Tables(spark, sf_dir).nation, path)
    return R.read_csv(spark, path, "n_nationkey int, n_name string, n_regionkey int")
