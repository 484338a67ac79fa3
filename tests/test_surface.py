"""Parts of the library that no registered query goes through."""

import datetime as dt

from pyspark.sql import functions as F

from fieldmart.functions import sql
from fieldmart.operators import audit, dims, joins, load, mdm
from fieldmart.sources import raw

TEXTS = ["  a  b ", "Ñandú – x", "7654321.0", "2,5", "none", "", None, "12.7", "45735", "-3", "100 %", "at 9:05 h", "1.234.567"]


def test_registered_functions_equal_columns(spark):
    names = sql.register(spark)
    assert len(names) == len(sql.FUNCTIONS)
    at = [dt.datetime(2025, 3, 1, 5), dt.datetime(2026, 12, 31), None]
    data = spark.createDataFrame([(t, n, at[i % 3]) for i, t in enumerate(TEXTS) for n in (0.5, None, 40.0)], "string string, double double, timestamp timestamp")
    for name, (parameters, function) in sql.FUNCTIONS.items():
        columns = list(parameters.values())
        got = data.selectExpr(f"fm_{name}({', '.join(columns)}) AS x").collect()
        assert got == data.select(function(*[F.col(c) for c in columns]).alias("x")).collect(), name


def test_append_adds(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "x int, y string")
    raw.append(df, f"{tmp_path}/t")
    raw.append(df, f"{tmp_path}/t")
    assert spark.read.parquet(f"{tmp_path}/t").count() == 2


def test_headers(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], ["Fecha ", "Módulo-N°", "modulo n", "DNI"])
    assert raw.canonicalise_columns(df, {"dni": "person"}).columns == ["fecha", "modulo_n", "modulo_n__2", "person"]


def test_seeds(spark):
    assert [(r.id, r.label) for r in dims.seed(spark, "state").where("id in (0, 8)").orderBy("id").collect()] == [(0, "Boton Floral"), (8, "Cosechable")]
    assert dims.seed(spark, "person").first().id == -1 and dims.seed(spark, "ribbon").agg(F.min("id")).first()[0] == 1
    assert all(dims.seed(spark, n).count() == len(v) for n, v in dims.SEEDS.items())


def test_backfill_and_current(spark):
    days = dims.dim_time(spark, "2025-01-01", "2025-01-10")
    assert dims.backfill(days.where("day <= '2025-01-04'"), days).count() == 6
    assert joins.current_only(spark.createDataFrame([(1, True), (2, False), (3, None)], "id int, is_current boolean")).count() == 1


def test_gate_and_refresh(spark):
    results = spark.createDataFrame([("harvest", True), ("weights", False)], "fact string, ok boolean")
    assert load.gate(results, ["harvest"]) and not load.gate(results, ["harvest", "weights"])
    assert load.refresh({"a": lambda: 1, "b": lambda: 2, "c": lambda: 3}, ["c", "a"]) == {"a": 1, "c": 3}
    assert list(load.refresh({"b": lambda: 2, "a": lambda: 1})) == ["b", "a"]


def test_rebuild_plan():
    registry = {n: load.FactSpec(n, ("k",), ("k",), None, m) for n, m in (("a", ("x", "y")), ("b", ()), ("c", ("y", "z")))}
    assert load.rebuild_plan(["c", "a"], registry, ["z", "y", "x", "w"]) == (["a", "c"], ["z", "y", "x"])
    try:
        load.rebuild_plan(["nope"], registry, [])
    except ValueError as e:
        assert "nope" in str(e)
    else:
        raise AssertionError


def test_purge(spark, tmp_path):
    df = spark.range(5).toDF("x")
    for n in "ab":
        df.write.parquet(f"{tmp_path}/{n}")
    tables = {n: (layer, spark.read.parquet(f"{tmp_path}/{n}")) for n, layer in (("a", "raw"), ("b", "dim"))}
    paths = {n: f"{tmp_path}/{n}" for n in "ab"}
    assert [(r.table_name, r.rows_before, r.rows_after) for r in load.purge(tables, paths, ["raw"]).orderBy("table_name").collect()] == [("a", 5, 0), ("b", 5, 5)]
    assert spark.read.parquet(paths["a"]).count() == 5
    load.purge(tables, paths, ["raw"], apply=True)
    assert spark.read.parquet(paths["a"]).count() == 0 and spark.read.parquet(paths["b"]).count() == 5


def test_log(spark):
    row = audit.log_run(spark.createDataFrame([("f", 3)], "fact string, rows int"), F.lit("2026-01-01").cast("timestamp_ntz")).first()
    assert row.fact == "f" and row.logged_at == dt.datetime(2026, 1, 1)


def test_approved_entries(spark):
    rows = [("a", "A", "t", "ana"), ("b", "B", "t", None), ("c", "C", "t", "PENDIENTE"), ("d", "D", "u", "ana")]
    assert [r.raw for r in mdm.approved(spark.createDataFrame(rows, "raw string, canonical string, source_table string, approved_by string"), "t").collect()] == ["a"]


def test_equal_rows_stay(spark):
    """Band joins and routes give every one of several equal rows its own result; NULL keys meet in merges."""
    df = spark.createDataFrame([("k", 5), ("k", 5), (None, 5), ("k", None)], "k string, v int")
    rules = spark.createDataFrame([("k", 0, 9, 1, 7), ("k", 0, 20, 2, 8)], "k string, lo int, hi int, p int, id int")
    assert sorted((str(r.k), str(r.v), str(r.rule_id)) for r in joins.band_join(df, rules, "k", "v", "lo", "hi", "p", "id").collect()) == sorted([("k", "5", "7"), ("k", "5", "7"), ("None", "5", "None"), ("k", "None", "None")])
    files = spark.createDataFrame([("Cosecha Año 2025.xlsx",), ("Cosecha Año 2025.xlsx",), (None,)], "name string")
    routes = spark.createDataFrame([("cosecha", "harvest"), ("cosecha_ano", "year"), ("", "none")], "pattern string, target string")
    assert sorted(str(r.target) for r in raw.route_files(files, "name", routes).collect()) == ["None", "year", "year"]
    target, new = (spark.createDataFrame([(None, v)], "k int, v string") for v in ("old", "new"))
    assert [(r.v, r.action) for r in load.merge_upsert(target, new, ["k"]).collect()] == [("new", "merged")]


def test_fuzzy_misses_no_name(spark):
    """Names of one to fifteen letters with up to three edits against all pairs."""
    import random

    r = random.Random(4)
    names = sorted({"".join(r.choice("abcd") for _ in range(r.randint(1, 15))) for _ in range(120)})
    values = set()
    for n in names:
        for _ in range(r.randint(0, 3)):
            at = r.randrange(len(n))
            n = r.choice((n[:at] + r.choice("abcd") + n[at + 1 :], n[:at] + n[at + 1 :], n[:at] + r.choice("abcd") + n[at:])) or "a"
        values.add(n)

    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    df, catalogue = spark.createDataFrame([(v,) for v in values], "v string"), spark.createDataFrame([(n,) for n in names], "n string")
    for threshold in (0.85, 0.9, 0.6):
        want = {}
        for v in values:
            score, name = min((-(1 - edits(v, n) / max(len(v), len(n))), n) for n in names)
            want[v] = (name, round(-score, 9)) if -score >= threshold else (None, None)
        got = {x.v: (x.found, None if x.score is None else round(x.score, 9)) for x in mdm.match_fuzzy(df, catalogue, "v", "n", threshold).collect()}
        assert got == want
