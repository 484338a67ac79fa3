"""Scalar functions on the driver's tables, with inputs re-rendered by fixed expressions on the key."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldmart.functions import dates as D
from fieldmart.functions import numbers as N
from fieldmart.functions import text as X
from fieldmart.plans.bed import Bed, Tables
from fieldmart.sources import kv

bed = Bed()
C = F.col
STATUS = {"O": "OPEN", "F": "FINISHED", "P": "PENDING"}


def pick(key: str, *values: str):
    """One of the values, by key modulo their number."""
    out = F.lit(values[0])
    for i, v in enumerate(values):
        if i:
            out = F.when(C(key) % len(values) == i, F.lit(v)).otherwise(out)
    return out


def pick_sql(key: str, *values: str) -> str:
    quote = lambda v: "'" + v.replace("'", "''") + "'"
    return f"CASE {key} % {len(values)} " + " ".join(f"WHEN {i} THEN {quote(v)}" for i, v in enumerate(values)) + " END"


@bed.query(r"SELECT doc_id, md5(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS squeezed FROM documents")
def fn_squeeze(spark, sf_dir):
    return Tables(spark, sf_dir).documents.select("doc_id", F.md5(X.squeeze(C("text"))).alias("squeezed"))


@bed.query("""SELECT p_partkey, array_to_string(list_transform(regexp_extract_all(lower(raw), '([a-z]+|[^a-z]+)', 0), lambda x: upper(x[1:1]) || x[2:]), '') AS titled
  FROM (SELECT p_partkey, p_name || '''s-X ' || p_brand AS raw FROM part)""")
def fn_title(spark, sf_dir):
    return Tables(spark, sf_dir).part.select("p_partkey", X.title(F.concat("p_name", F.lit("'s-X "), "p_brand")).alias("titled"))


@bed.query("SELECT p_partkey, upper(trim(regexp_replace('  ' || p_name || '   ' || p_type, '\\s+', ' ', 'g'))) AS upped FROM part")
def fn_upper_squeeze(spark, sf_dir):
    return Tables(spark, sf_dir).part.select("p_partkey", X.upper_squeeze(F.concat(F.lit("  "), "p_name", F.lit("   "), "p_type")).alias("upped"))


@bed.query("SELECT doc_id, md5(strip_accents(text)) AS plain FROM documents")
def fn_strip_accents(spark, sf_dir):
    return Tables(spark, sf_dir).documents.select("doc_id", F.md5(X.strip_accents(C("text"))).alias("plain"))


_VARIETY = ("  marela ", "QRT15 – 005", "ZB 19-006", "old amber", "D’Orsa", "Ñandú ( x )", "none")
_MATCH = """nullif(nullif(trim(upper(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
  translate(trim(regexp_replace(raw, '\\s+', ' ', 'g')), 'áéíóúñÑ–—−’`', 'aeiounN---'''''), '\\s*-\\s*', '-', 'g'), '\\s*\\(\\s*', '(', 'g'), '\\s*\\)\\s*', ')', 'g'),
  '([A-Za-z])\\s+(\\d)', '\\1\\2', 'g'), '(\\d)\\s+([A-Za-z])', '\\1\\2', 'g'))), ''), 'NONE')"""
_RAW_VARIETY = f"(SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN {pick_sql('p_partkey', *_VARIETY)} ELSE p_name END AS raw FROM part)"


def _variety():
    return F.when(C("p_partkey") % 2 == 0, pick("p_partkey", *_VARIETY)).otherwise(C("p_name"))


@bed.query(f"SELECT p_partkey, {_MATCH} AS k FROM {_RAW_VARIETY}")
def fn_match_key(spark, sf_dir):
    return Tables(spark, sf_dir).part.select("p_partkey", X.match_key(_variety()).alias("k"))


@bed.query(f"SELECT p_partkey, nullif(regexp_replace({_MATCH}, '[^A-Z0-9]+', '', 'g'), '') AS k FROM {_RAW_VARIETY}")
def fn_compact_key(spark, sf_dir):
    return Tables(spark, sf_dir).part.select("p_partkey", X.compact_key(_variety()).alias("k"))


_MODULES = ("MODULE 2", "SHIFT 04", "9.1", "9.", "XII", "Test Block", "VALVE NO 15", "GREENHOUSE", "12.00", "nan")


@bed.query(f"""WITH r AS (SELECT c_custkey, upper(trim(CASE WHEN c_custkey % 2 = 0 THEN c_name ELSE {pick_sql('c_custkey', *_MODULES)} END)) AS t FROM customer),
n AS (SELECT c_custkey, CASE WHEN lower(t) NOT IN ('', 'none', 'nan', 'null') THEN t END AS t, regexp_extract_all(t, '[+-]?\\d+(?:\\.\\d+)?', 0)[-1] AS num FROM r)
SELECT c_custkey, CASE WHEN t LIKE '%TEST%' OR t LIKE '%BLOCK%' OR num IS NULL THEN t WHEN regexp_matches(num, '^[+-]?\\d+(\\.0+)?$') THEN try_cast(num AS DECIMAL(38,0))::VARCHAR ELSE num END AS module FROM n""")
def fn_last_number(spark, sf_dir):
    raw = F.when(C("c_custkey") % 2 == 0, C("c_name")).otherwise(pick("c_custkey", *_MODULES))
    return Tables(spark, sf_dir).customer.select("c_custkey", X.last_number(raw).alias("module"))


@bed.query("SELECT p_partkey, (upper(p_name) LIKE '%BOLT%' OR upper(p_name) LIKE '%RING%') AS hit FROM part")
def fn_contains_any(spark, sf_dir):
    return Tables(spark, sf_dir).part.select("p_partkey", X.contains_any(C("p_name"), ("BOLT", "RING")).alias("hit"))


@bed.query("SELECT l_orderkey, l_linenumber, l_partkey, coalesce(trunc(try_cast(raw AS DOUBLE))::BIGINT::VARCHAR, raw) AS n FROM (SELECT *, CASE WHEN l_partkey % 5 = 0 THEN p ELSE l_quantity::VARCHAR END AS raw FROM (SELECT *, 'L-' || l_linenumber AS p FROM lineitem))")
def fn_clean_numeric(spark, sf_dir):
    raw = F.when(C("l_partkey") % 5 == 0, F.concat(F.lit("L-"), "l_linenumber")).otherwise(C("l_quantity").cast("string"))
    return Tables(spark, sf_dir).lineitem.select("l_orderkey", "l_linenumber", "l_partkey", X.clean_numeric_text(raw).alias("n"))


@bed.query("""SELECT p_partkey, CASE WHEN regexp_matches(t, '^\\d+\\.0+$') THEN regexp_extract(t, '^(\\d+)', 1) ELSE t END AS token,
  try_cast(nullif(regexp_extract(t, '^(\\d+)(?:\\.(\\d+))?$', 1), '') AS INT) AS major, try_cast(nullif(regexp_extract(t, '^(\\d+)\\.(\\d+)$', 2), '') AS INT) AS minor
  FROM (SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN p_size || '.0' WHEN p_partkey % 3 = 1 THEN p_size || '.' || p_partkey % 4 ELSE lower(p_brand) END AS t FROM part)""")
def fn_split_version(spark, sf_dir):
    raw = F.when(C("p_partkey") % 3 == 0, F.concat("p_size", F.lit(".0"))).when(C("p_partkey") % 3 == 1, F.concat("p_size", F.lit("."), (C("p_partkey") % 4).cast("string"))).otherwise(C("p_brand"))
    major, minor = X.split_version(raw)
    return Tables(spark, sf_dir).part.select("p_partkey", X.geo_token(raw).alias("token"), major.alias("major"), minor.alias("minor"))


@bed.query("""WITH r AS (SELECT c_custkey, nullif(regexp_replace(regexp_replace(trim(CASE c_custkey % 4 WHEN 0 THEN c_custkey || '.0' WHEN 1 THEN ' 1.234.' || lpad(c_custkey::VARCHAR, 5, '0') WHEN 2 THEN 'ABC' ELSE '9999' || c_custkey END), '\\.0+$', ''), '[. ]', '', 'g'), '') AS t FROM customer),
p AS (SELECT c_custkey, CASE WHEN len(t) < 8 THEN lpad(t, 8, '0') ELSE t END AS id FROM r) SELECT c_custkey, id, regexp_matches(id, '^[0-9]{8}$') AS ok FROM p""")
def fn_clean_id(spark, sf_dir):
    key = C("c_custkey").cast("string")
    raw = F.when(C("c_custkey") % 4 == 0, F.concat(key, F.lit(".0"))).when(C("c_custkey") % 4 == 1, F.concat(F.lit(" 1.234."), F.lpad(key, 5, "0"))).when(C("c_custkey") % 4 == 2, "ABC").otherwise(F.concat(F.lit("9999"), key))
    return Tables(spark, sf_dir).customer.select("c_custkey", X.clean_id(raw).alias("id"), X.valid_id(X.clean_id(raw)).alias("ok"))


_NUM = ("2,5", "2.5", "12.7", "-1", "nan", "None", "x", " 7 ", "inf")
_RAW_NUM = f"SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_partkey % 2 = 0 THEN {pick_sql('l_orderkey', *_NUM)} ELSE replace(l_discount::VARCHAR, '.', ',') END AS raw FROM lineitem"
_DEC = "CASE WHEN try_cast(replace(trim(raw), ',', '.') AS DOUBLE) BETWEEN -1e300 AND 1e300 THEN try_cast(replace(trim(raw), ',', '.') AS DOUBLE) END"


def _num():
    return F.when(C("l_partkey") % 2 == 0, pick("l_orderkey", *_NUM)).otherwise(F.replace(C("l_discount").cast("string"), F.lit("."), F.lit(",")))


@bed.query(f"SELECT l_orderkey, l_linenumber, l_partkey, trunc({_DEC})::INT AS n, CASE WHEN trunc({_DEC})::INT >= 0 THEN trunc({_DEC})::INT ELSE 0 END AS n0 FROM ({_RAW_NUM})")
def fn_to_int(spark, sf_dir):
    raw = Tables(spark, sf_dir).lineitem.withColumn("raw", _num())
    return raw.select("l_orderkey", "l_linenumber", "l_partkey", N.to_int(C("raw")).alias("n"), N.to_int(C("raw"), 0, 0).alias("n0"))


@bed.query(f"SELECT l_orderkey, l_linenumber, l_partkey, {_DEC} AS x FROM ({_RAW_NUM})")
def fn_to_decimal(spark, sf_dir):
    return Tables(spark, sf_dir).lineitem.select("l_orderkey", "l_linenumber", "l_partkey", N.to_decimal(_num()).alias("x"))


@bed.query("SELECT s_suppkey, trunc(try_cast(regexp_replace(s_name, '[^0-9.\\-]', '', 'g') AS DOUBLE))::INT AS n FROM supplier")
def fn_extract_int(spark, sf_dir):
    return Tables(spark, sf_dir).supplier.select("s_suppkey", N.extract_int(C("s_name")).alias("n"))


_DATE_SHAPES = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "yyyy/MM/dd HH:mm", "yyyyMMdd", "dd/MM/yyyy HH:mm", "d/M/yyyy", "dd-MM-yyyy", "dd.MM.yyyy", "yyyy-MM-dd'T'HH:mm:ss", "'  'd/M/yyyy   H:m:s", "dd/MM/yyyy hh:mm a", "d MMM yyyy", "MMMM d, yyyy HH:mm")


def _rendered(ts):
    out = F.lit("31/02/2026")
    for i, shape in enumerate(_DATE_SHAPES):
        out = F.when(C("o_orderkey") % 18 == i, F.date_format(ts, shape)).otherwise(out)
    american = F.concat_ws("/", F.month(ts).cast("string"), F.dayofmonth(ts).cast("string"), F.year(ts).cast("string"))
    for i, shape in ((16, "d/M/yy"), (17, "d-M-yy H:mm")):
        out = F.when(C("o_orderkey") % 18 == i, F.date_format(ts, shape)).otherwise(out)
    out = F.when((C("o_orderkey") % 18 == 13) & (F.dayofmonth(ts) > 12), american).otherwise(out)
    return F.when(C("o_orderkey") % 18 == 14, F.datediff(C("o_orderdate"), F.lit("1899-12-30").cast("date")).cast("string")).otherwise(out)


@bed.query("""SELECT o_orderkey, CASE WHEN o_orderkey % 18 = 15 OR o_orderkey % 18 = 13 AND day(ts) <= 12 THEN NULL WHEN o_orderkey % 18 IN (0, 8, 9) THEN ts WHEN o_orderkey % 18 IN (2, 4, 10, 12, 17) THEN date_trunc('minute', ts) ELSE date_trunc('day', ts) END AS parsed
  FROM (SELECT o_orderkey, o_orderdate + to_seconds(o_orderkey % 86400) AS ts FROM orders)""")
def fn_parse_datetime(spark, sf_dir):
    t = Tables(spark, sf_dir).orders.withColumn("ts", F.expr("o_orderdate + make_dt_interval(0, 0, 0, o_orderkey % 86400)"))
    return t.select("o_orderkey", D.parse_datetime(_rendered(C("ts"))).cast("timestamp_ntz").alias("parsed"))


@bed.query("""SELECT o_orderkey, CASE WHEN first >= 20 AND third <= 31 THEN coalesce(try_strptime(y1, '%Y-%m-%d'), try_strptime(y3, '%Y-%m-%d')) ELSE coalesce(try_strptime(y3, '%Y-%m-%d'), try_strptime(y1, '%Y-%m-%d')) END::TIMESTAMP AS parsed
  FROM (SELECT o_orderkey, substr(s, 1, 2)::INT AS first, substr(s, 7, 2)::INT AS third,
    (CASE WHEN substr(s, 1, 2)::INT <= 68 THEN '20' ELSE '19' END) || substr(s, 1, 2) || '-' || substr(s, 4, 2) || '-' || substr(s, 7, 2) AS y1,
    (CASE WHEN substr(s, 7, 2)::INT <= 68 THEN '20' ELSE '19' END) || substr(s, 7, 2) || '-' || substr(s, 4, 2) || '-' || substr(s, 1, 2) AS y3
    FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%y/%m/%d') ELSE strftime(o_orderdate, '%d/%m/%y') END AS s FROM orders))""")
def fn_parse_short_date(spark, sf_dir):
    raw = F.when(C("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "yy/MM/dd")).otherwise(F.date_format("o_orderdate", "dd/MM/yy"))
    return Tables(spark, sf_dir).orders.select("o_orderkey", D.parse_short_date(raw).cast("timestamp_ntz").alias("parsed"))


@bed.query("SELECT o_orderkey, CASE WHEN n BETWEEN 30000 AND 60000 THEN DATE '1899-12-30' + n::INT END AS d FROM (SELECT o_orderkey, date_diff('day', DATE '1899-12-30', o_orderdate::DATE) + CASE WHEN o_orderkey % 10 = 0 THEN 40000 ELSE 0 END AS n FROM orders)")
def fn_excel_serial(spark, sf_dir):
    n = F.datediff("o_orderdate", F.lit("1899-12-30").cast("date")) + F.when(C("o_orderkey") % 10 == 0, 40000).otherwise(0)
    return Tables(spark, sf_dir).orders.select("o_orderkey", D.excel_serial(F.concat(n.cast("string"), F.lit(".25"))).alias("d"))


@bed.query("SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d')::INT AS date_id FROM orders")
def fn_date_id(spark, sf_dir):
    return Tables(spark, sf_dir).orders.select("o_orderkey", D.date_id(C("o_orderdate")).alias("date_id"))


@bed.query("SELECT o_orderkey, week(o_orderdate)::INT AS week, isodow(o_orderdate)::INT AS weekday FROM orders")
def fn_iso_week(spark, sf_dir):
    return Tables(spark, sf_dir).orders.select("o_orderkey", D.iso_week(C("o_orderdate")).alias("week"), D.iso_weekday(C("o_orderdate")).cast("int").alias("weekday"))


@bed.query("SELECT o_orderkey, (floor(date_diff('day', DATE '1899-12-31', o_orderdate::DATE) / 7.0) - floor(date_diff('day', DATE '1899-12-31', DATE '1998-03-01') / 7.0) + 1)::INT AS week FROM orders")
def fn_harvest_week(spark, sf_dir):
    return Tables(spark, sf_dir).orders.select("o_orderkey", D.harvest_week(C("o_orderdate"), "1998-03-01").alias("week"))


@bed.query("SELECT o_orderkey, o_orderdate::DATE BETWEEN DATE '1997-03-01' AND DATE '1998-06-30' AS closed, true AS open FROM orders")
def fn_in_season(spark, sf_dir):
    day = C("o_orderdate")
    return Tables(spark, sf_dir).orders.select("o_orderkey", D.in_season(day, None, "1997-03-01", "1998-06-30").alias("closed"), D.in_season(day, "clima").alias("open"))


@bed.query("SELECT event_id, CASE WHEN event_id % 2 = 0 THEN strftime(ts, '%H:%M:%S') ELSE strftime(ts, '%H:%M') || ':00' END AS t FROM events")
def fn_time_from_text(spark, sf_dir):
    raw = F.concat(F.lit("read at "), F.when(C("event_id") % 2 == 0, F.date_format("ts", "HH:mm:ss")).otherwise(F.date_format("ts", "HH:mm")), F.lit(" h"))
    return Tables(spark, sf_dir).events.select("event_id", D.time_of_day(raw).alias("t"))


@bed.query("SELECT l_orderkey, l_linenumber, l_partkey, date_diff('day', o_orderdate, l_shipdate)::INT AS days, floor(date_diff('day', o_orderdate, l_shipdate) / 7.0)::INT AS weeks FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def fn_weeks_since(spark, sf_dir):
    t = Tables(spark, sf_dir)
    joined = t.lineitem.join(t.orders.select("o_orderkey", "o_orderdate"), C("l_orderkey") == C("o_orderkey"))
    return joined.select("l_orderkey", "l_linenumber", "l_partkey", D.days_between(C("o_orderdate"), C("l_shipdate")).alias("days"), D.weeks_since(C("o_orderdate"), C("l_shipdate")).alias("weeks"))


@bed.query("SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN t > 0 THEN round(l_linenumber::DOUBLE / t * 100, 2) END AS pct FROM (SELECT *, l_quantity - 5 AS t FROM lineitem)")
def fn_pct(spark, sf_dir):
    return Tables(spark, sf_dir).lineitem.select("l_orderkey", "l_linenumber", "l_partkey", N.pct(C("l_linenumber"), C("l_quantity") - 5).alias("pct"))


@bed.query("SELECT o_orderkey, o_orderstatus AS a, o_orderpriority || '=x' AS b, CASE WHEN o_orderkey % 2 = 0 THEN 'late' ELSE 'early' END AS c, 3 AS n FROM orders")
def fn_parse_kv(spark, sf_dir):
    raw = F.concat(F.lit("A="), "o_orderstatus", F.lit(" | junk | B = "), "o_orderpriority", F.lit("=x | =z | C=early"), F.when(C("o_orderkey") % 2 == 0, F.lit("| C=late")).otherwise(""))
    parsed = Tables(spark, sf_dir).orders.select("o_orderkey", kv.parse_kv(raw).alias("m"))
    return parsed.select("o_orderkey", C("m")["A"].alias("a"), C("m")["B"].alias("b"), C("m")["C"].alias("c"), F.size("m").alias("n"))


@bed.query("SELECT event_id, (props::JSON ->> '$.k') AS k FROM events")
def fn_json_value(spark, sf_dir):
    return Tables(spark, sf_dir).events.select("event_id", F.get_json_object("props", "$.k").alias("k"))


@bed.query("SELECT n_nationkey, CASE WHEN n_nationkey % 2 = 0 THEN n_name || '/x' ELSE n_name || '/b/x y' END AS items FROM nation")
def fn_split_list(spark, sf_dir):
    raw = F.when(C("n_nationkey") % 2 == 0, F.concat(F.lit('["'), "n_name", F.lit('"," x "]'))).otherwise(F.concat("n_name", F.lit("; b,,\nx y|")))
    return Tables(spark, sf_dir).nation.select("n_nationkey", F.array_join(X.split_list(raw), "/").alias("items"))


@bed.query("SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'OPEN' WHEN 'F' THEN 'FINISHED' WHEN 'P' THEN 'PENDING' ELSE o_orderstatus END AS status, upper(o_orderpriority) AS other FROM orders")
def fn_map_code(spark, sf_dir):
    return Tables(spark, sf_dir).orders.select("o_orderkey", X.map_code(F.concat(F.lit(" "), F.lower("o_orderstatus")), STATUS).alias("status"), X.map_code(C("o_orderpriority"), STATUS).alias("other"))


@bed.query("SELECT o_orderkey, trim(regexp_replace(upper(o_orderpriority), '[^A-Z0-9]+', ' ', 'g')) || ' BOTON' AS k FROM orders")
def fn_state_key(spark, sf_dir):
    return Tables(spark, sf_dir).orders.select("o_orderkey", X.state_key(F.concat("o_orderpriority", F.lit("__botón."))).alias("k"))


@bed.query("SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN s < 60 THEN s || 's' ELSE (s // 60) || 'm ' || lpad((s % 60)::VARCHAR, 2, '0') || 's' END AS d FROM (SELECT *, (l_quantity * 7)::BIGINT AS s FROM lineitem)")
def fn_format_duration(spark, sf_dir):
    return Tables(spark, sf_dir).lineitem.select("l_orderkey", "l_linenumber", "l_partkey", N.format_duration(C("l_quantity") * 7).alias("d"))


@bed.query("SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN x BETWEEN 0 AND 100 THEN x END AS h FROM (SELECT *, CASE WHEN r BETWEEN 0 AND 1 THEN r * 100 ELSE r END AS x FROM (SELECT *, CASE WHEN l_partkey % 3 = 0 THEN l_quantity * 4 ELSE l_discount END AS r FROM lineitem))")
def fn_humidity(spark, sf_dir):
    return Tables(spark, sf_dir).lineitem.select("l_orderkey", "l_linenumber", "l_partkey", N.humidity_pct(F.when(C("l_partkey") % 3 == 0, C("l_quantity") * 4).otherwise(C("l_discount"))).alias("h"))


# --- predicates --------------------------------------------------------------------------------------------------


@bed.query("SELECT a.p_partkey, b.p_partkey AS twin FROM part a JOIN (SELECT p_partkey, '  ' || upper(p_type) || p_size || p_brand AS k FROM part WHERE p_partkey % 10 = 0) b ON lower(trim(a.p_type || a.p_size || a.p_brand)) = lower(trim(b.k))")
def eq_ci_join(spark, sf_dir):
    p = Tables(spark, sf_dir).part
    a = p.select("p_partkey", F.concat("p_type", "p_size", "p_brand").alias("x"))
    b = p.where(C("p_partkey") % 10 == 0).select(C("p_partkey").alias("twin"), F.concat(F.lit("  "), F.upper("p_type"), "p_size", "p_brand").alias("y"))
    return a.join(b, X.eq_ci(C("x"), C("y"))).select("p_partkey", "twin")


@bed.query("WITH o AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderstatus END AS st FROM orders) SELECT a.o_orderkey, b.o_orderkey AS other FROM o a JOIN o b ON a.o_custkey = b.o_custkey AND a.st IS NOT DISTINCT FROM b.st AND a.o_orderkey < b.o_orderkey")
def null_safe_join(spark, sf_dir):
    o = Tables(spark, sf_dir).orders.select("o_orderkey", "o_custkey", F.when(C("o_orderkey") % 5 != 0, C("o_orderstatus")).alias("st"))
    a, b = o.alias("a"), o.alias("b")
    return a.join(b, (C("a.o_custkey") == C("b.o_custkey")) & C("a.st").eqNullSafe(C("b.st")) & (C("a.o_orderkey") < C("b.o_orderkey"))).select(C("a.o_orderkey"), C("b.o_orderkey").alias("other"))


@bed.query("SELECT event_id, CASE WHEN event_id % 4 IN (1, 2) THEN NULL ELSE event_type END AS v FROM events")
def nullish_text(spark, sf_dir):
    raw = F.when(C("event_id") % 4 == 1, " NaN").when(C("event_id") % 4 == 2, "none").otherwise(C("event_type"))
    return Tables(spark, sf_dir).events.select("event_id", X.nullish(raw).alias("v"))


@bed.query("SELECT o_orderpriority AS token, count(*) AS n FROM orders WHERE upper(o_orderpriority) NOT IN ('1-URGENT', '5-LOW') GROUP BY 1")
def token_row_filter(spark, sf_dir):
    from fieldmart.operators.shape import drop_non_operational

    kept, _ = drop_non_operational(Tables(spark, sf_dir).orders, {"o_orderpriority": ("1-URGENT", "5-LOW")})
    return kept.groupBy(C("o_orderpriority").alias("token")).agg(F.count("*").alias("n"))


@bed.query("SELECT doc_id, lang FROM documents WHERE lang IS NULL OR trim(lang) = '' OR lower(lang) LIKE '%en%' OR lower(lang) LIKE '%fr%'")
def text_compat_filter(spark, sf_dir):
    return Tables(spark, sf_dir).documents.where(X.compatible_type(C("lang"), ("EN", "fr"))).select("doc_id", "lang")


@bed.query("SELECT p_partkey, try_cast(CASE WHEN regexp_matches(t, '^[0-9]+$') THEN t END AS INT) AS n FROM (SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN p_size::VARCHAR ELSE p_size || 'x' END AS t FROM part)")
def int_token(spark, sf_dir):
    raw = F.when(C("p_partkey") % 3 == 0, C("p_size").cast("string")).otherwise(F.concat("p_size", F.lit("x")))
    return Tables(spark, sf_dir).part.select("p_partkey", N.int_token(raw).alias("n"))


@bed.query("SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_discount > 0.08 THEN 'deep' WHEN l_quantity > 40 THEN 'bulk' WHEN l_returnflag = 'R' THEN 'returned' ELSE 'plain' END AS label FROM lineitem")
def ordered_case(spark, sf_dir):
    from fieldmart.operators.shape import classify

    label = classify([(C("l_discount") > 0.08, "deep"), (C("l_quantity") > 40, "bulk"), (C("l_returnflag") == "R", "returned")], "plain")
    return Tables(spark, sf_dir).lineitem.select("l_orderkey", "l_linenumber", "l_partkey", label.alias("label"))


@bed.query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN event_type ELSE (props::JSON ->> '$.k') END AS v FROM events")
def col_or_map(spark, sf_dir):
    t = Tables(spark, sf_dir).events.select("event_id", F.when(C("event_id") % 3 == 0, C("event_type")).otherwise(" ").alias("own"), F.create_map(F.lit("k"), F.get_json_object("props", "$.k")).alias("m"))
    return t.select("event_id", kv.col_or_map(t, "own", "m", "K", "k").alias("v"))


@bed.query("SELECT o_orderkey, CASE WHEN o_orderkey % 4 IN (0, 1) THEN 'PROCESADO' ELSE o_orderstatus END AS state FROM orders")
def default_where_blank(spark, sf_dir):
    from fieldmart.operators.shape import default_where_blank as fill

    t = Tables(spark, sf_dir).orders.withColumn("state", F.when(C("o_orderkey") % 4 == 0, F.lit(None)).when(C("o_orderkey") % 4 == 1, "  ").otherwise(C("o_orderstatus")))
    return fill(t, "state", "PROCESADO").select("o_orderkey", "state")
