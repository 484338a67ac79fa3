"""Growth curves against a far finer and wider grid; boosted trees against a constant and against rows that they haven't seen."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldmart.operators import growth
from fieldmart.plans import bed_growth
from tests.conftest import DATA
from tests.helpers import same


def grid_sse(weeks, values):
    """Least sum of squares of K*exp(-b*exp(-c*t)) over 600 values of b of either sign and 300 of c, K in closed form."""
    t, y = np.array(weeks, float), np.array(values, float)
    b = np.concatenate([s * np.geomspace(1e-8, 400, 300) for s in (1, -1)])
    with np.errstate(all="ignore"):
        z = -b[:, None, None] * np.exp(-np.linspace(-1, 3, 300)[None, :, None] * t)
        f = np.exp(z - z.max(2, keepdims=True))  # K takes up the factor
        k = (f * y).sum(2) / (f * f).sum(2)
        sse = ((y - k[:, :, None] * f) ** 2).sum(2)
    return float(np.nanmin(sse))


def curves():
    r = random.Random(12)
    for i in range(50):
        k, b, c = r.uniform(-20, 90), r.choice([r.uniform(0.05, 0.6), r.uniform(1, 10), r.uniform(10, 60), -r.uniform(0.1, 3)]), r.choice([r.uniform(0.02, 0.1), r.uniform(0.1, 1), r.uniform(1, 2.5)])
        noise = r.choice([0, 0.3, 3, 15])
        weeks = sorted(r.sample(range(21), r.randint(5, 21)))
        yield i, weeks, [k * math.exp(-b * math.exp(-c * t)) + r.gauss(0, noise) for t in weeks]


def test_fits_are_no_worse_than_a_wide_grid(spark):
    data = list(curves())
    df = spark.createDataFrame([(i, t, v) for i, weeks, values in data for t, v in zip(weeks, values, strict=True)], "g int, week int, median double").withColumns({"points": F.lit(1), "k": F.lit("k"), "sse": F.lit(None).cast("string")})
    got = {r.g: r for r in growth.fit_gompertz(df, ["g"]).collect()}
    assert len(got) == 50
    settled = 0
    for i, weeks, values in data:
        r, floor = got[i], 1e-6 * sum(v * v for v in values)
        least = grid_sse(weeks, values) * (1 + 1e-9) + floor * 1e-3
        if r.sse is None:  # the sum of squares still falls where parameters run away: the fallback, though the search is no worse than the grid
            assert (r.k, r.b, r.c) == growth.DEFAULT
            with np.errstate(all="ignore"):
                assert growth.levenberg_marquardt(*np.array([[weeks], [values], [[1] * len(weeks)]], float))[3][0] <= least
            continue
        settled += 1
        assert r.sse <= least, i
        fitted = [r.k * math.exp(-r.b * math.exp(-r.c * t)) for t in weeks]
        assert abs(sum((a - v) ** 2 for a, v in zip(fitted, values, strict=True)) - r.sse) <= 1e-6 * r.sse + floor, i
    assert settled >= 45


@pytest.mark.parametrize("k, b, c", [(30, 5, 0.4), (30, 0.2, 0.3), (80, 40, 1.2), (12, -0.7, 0.25), (45, 9, 0.03)])
def test_exact_curves_are_found_again(spark, k, b, c):
    """Parameters outside of the study's range too."""
    df = spark.createDataFrame([(t, k * math.exp(-b * math.exp(-c * t))) for t in range(21)], "week int, median double")
    (r,) = growth.fit_gompertz(df).collect()
    assert (round(r.k, 2), round(r.b, 3), round(r.c, 4)) == (k, b, c) and r.sse < 1e-6


def test_fallbacks(spark, monkeypatch):
    """Two weeks, and a search that is stopped before it settles; NULLs are no weeks; an empty curve gives no row."""
    rows = [("few", 1, 2.0), ("few", 2, 3.0), ("few", None, 4.0), ("few", 3, None), (None, 1, 1.0), *(("many", t, 30 * math.exp(-5 * math.exp(-0.4 * t)) + (-1) ** t) for t in range(12))]
    df = spark.createDataFrame(rows, "g string, week int, median double")
    got = {r.g: (r.k, r.b, r.c, r.sse) for r in growth.fit_gompertz(df, ["g"]).collect()}
    assert got["few"] == got[None] == (*growth.DEFAULT, None) and got["many"][3] < 12.1
    assert growth.fit_gompertz(df.limit(0), ["g"]).collect() == []
    t = np.arange(12.0)[None]
    monkeypatch.setattr(growth, "_STEPS", 51)
    assert not growth.levenberg_marquardt(t, 3.0 * t + t**3, np.ones_like(t))[4][0]


def test_queries_equal_an_independent_search(spark, duck):
    queries = {name: (query, sql) for name, query, sql in bed_growth.bed.entries}
    for name in ("gompertz_fit", "gompertz_curve"):
        same(queries[name][0](spark, DATA), duck, queries[name][1])


def test_queries_equal_the_search_where_no_rate_is_best(spark, tmp_path):
    """The first week alone stands out, so that the sum of squares falls for ever as c grows: both searches end at the same bound."""
    import duckdb

    con = duckdb.connect()
    weeks = [26.0, 24.5, 25.0, 25.0, 24.5, 25.0, 25.5, 24.5, 25.0, 25.0, 24.5, 25.0]
    con.execute("CREATE TABLE orders AS SELECT 1::BIGINT AS o_orderkey, TIMESTAMP '1996-01-01' AS o_orderdate")
    con.execute("CREATE TABLE part AS SELECT 1::BIGINT AS p_partkey, 'b' AS p_brand, 't' AS p_type")
    con.execute(f"CREATE TABLE lineitem AS SELECT 1::BIGINT AS l_orderkey, w::INT AS l_linenumber, 1::BIGINT AS l_partkey, 'N' AS l_returnflag, 'O' AS l_linestatus, ({weeks}::DOUBLE[])[w + 1] AS l_quantity, TIMESTAMP '1996-01-01' + to_days((7 * w)::INT) AS l_shipdate FROM range({len(weeks)}) r(w)")
    for name in ("orders", "part", "lineitem"):
        con.execute(f"COPY {name} TO '{tmp_path}/{name}.parquet' (FORMAT parquet)")
    queries = {name: (query, sql) for name, query, sql in bed_growth.bed.entries}
    assert queries["gompertz_fit"][0](spark, str(tmp_path)).first().c == 3.2
    for name in ("gompertz_fit", "gompertz_curve"):
        same(queries[name][0](spark, str(tmp_path)), con, queries[name][1])
    curve = spark.createDataFrame(list(enumerate(weeks)), "week int, median double")
    (free,), (held,) = growth.fit_gompertz(curve).collect(), growth.fit_gompertz(curve, within=bed_growth._BOX).collect()
    assert free.c > 3.2 and free.sse < held.sse  # without a box nothing bounds the search


def test_trees_learn_what_there_is_to_learn(spark):
    """cm follows week and group; noise has no weight. Errors on rows that weren't trained on, against a constant's and against the noise itself."""
    r = random.Random(4)
    rows = [(g := r.choice("ABC"), w := r.randint(0, 20), r.random(), 3.0 * w + {"A": 0, "B": 10, "C": -10}[g] + r.uniform(-2, 2)) for _ in range(1500)]
    rows += [(None, 1, 0.5, 1.0), ("A", None, 0.5, 1.0)]
    df = spark.createDataFrame(rows, "g string, week int, noise double, cm double")
    model, metrics, importances = growth.train_growth(df, ["g"], ["week", "noise"], "cm", trees=25, depth=4, rate=0.3, held_out=0.25)
    (m,) = metrics.collect()
    mean = sum(x[3] for x in rows[:1500]) / 1500
    constant = sum(abs(x[3] - mean) for x in rows[:1500]) / 1500
    assert m.n + m.held_n == 1500 and 300 < m.held_n < 450
    assert m.mae <= m.held_mae < 2.5 and m.held_mae < constant / 6 and m.held_r2 > 0.97
    assert importances["week"] > importances["g"] > importances["noise"]
    (seen,) = growth.train_growth(df, ["g"], ["week", "noise"], "cm", trees=3, depth=2)[1].collect()
    assert seen.n == 1500 and seen.asDict().keys() == {"n", "mae", "r2"}


def test_trees_over_cells_equal_trees_over_rows(spark, monkeypatch):
    """Rows that repeat: cells of equal features with counted labels, in several parts, against GBTRegressor over the rows. Without a subsample the trees are the same."""
    r = random.Random(5)
    rows = [(r.choice("ABC"), r.randint(0, 12), r.randint(1, 3)) for _ in range(1500)]
    rows = [(g, w, line, 2.0 * w + {"A": 0, "B": 9, "C": -9}[g] * line + r.randint(-3, 3)) for g, w, line in rows] * 3
    df = spark.createDataFrame(rows, "g string, week int, line int, cm double")
    rows_of, cells = growth._boosted, []
    monkeypatch.setattr(growth, "_boosted", lambda *a, **k: cells.append(1) or rows_of(*a, **k))
    monkeypatch.setattr(growth, "_LABELS", 3)

    def trained(many, **how):
        monkeypatch.setattr(growth, "MANY", many)
        model, metrics, importances = growth.train_growth(df, ["g"], ["week", "line"], "cm", depth=3, rate=0.1, held_out=0.2, **how)
        return model.stages[-1], metrics.first(), importances

    (a, x, given), (b, y, found) = trained(10**9, trees=12, subsample=1.0), trained(1, trees=12, subsample=1.0)
    assert len(cells) == 1 and [t.toDebugString.split("\n")[1:] for t in b.trees][0] == [t.toDebugString.split("\n")[1:] for t in a.trees][0]
    assert x.n == y.n and x.held_n == y.held_n and x.n + x.held_n == 4500
    for one, other in [*zip(x, y, strict=True), *((given[k], found[k]) for k in given)]:
        assert one == pytest.approx(other, rel=1e-6)
    _, drawn, _ = trained(1, trees=12, subsample=0.5)
    _, again, _ = trained(1, trees=12, subsample=0.5)
    assert drawn == again and drawn.mae != y.mae and drawn.mae == pytest.approx(y.mae, rel=0.1)


def test_each_row_is_drawn_by_itself(spark):
    """Of 200 equal rows 160 are drawn in the mean, with the spread of single draws; a cell is neither whole nor gone."""
    from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

    cells = spark.range(400).selectExpr("id", "array(struct(1D as y, 150L as n), struct(3D as y, 50L as n)) as _labels").repartition(3)
    schema = StructType([cells.schema["id"], *(StructField(c, ArrayType(DoubleType())) for c in ("_drawn", "_sum"))])
    got = cells.mapInArrow(growth._draws(["id"], 5, 0.8, [42, 0]), schema).collect()
    n, s = np.array([r._drawn for r in got]), np.array([r._sum for r in got])
    assert n.shape == (400, 5) and len({r.id for r in got}) == 400
    assert abs(n.mean() - 160) < 1 and abs(n.std() - 32**0.5) < 0.5 and n.min() > 120 and n.max() < 190
    assert ((s - n) % 2 == 0).all() and abs(((s - n) / 2).mean() - 40) < 1
