"""Operators on small inputs where a shortcut would lose results, against brute force or SQL over all pairs."""

import random

import pytest

from fieldmart.operators import growth, joins, mdm
from fieldmart.plans import bed_growth, bed_joins
from tests.conftest import DATA
from tests.helpers import same


def _newest(k, d, ranges):
    held = [r for r in ranges if None not in (k, d, r[0], r[1]) and r[0] == k and r[1] <= d and (r[2] is None or d <= r[2])]
    return max(held, key=lambda r: (r[1], r[2] is None, r[2] or 0, r[3]))[3] if held else None


def test_asof_interval_older_range_holds(spark):
    ranges = spark.createDataFrame([("a", 1, 100, 1), ("a", 5, 8, 2), ("a", 20, None, 3), ("a", 30, 31, 4)], "k string, s long, e long, id long")
    asked = spark.createDataFrame([("a", d) for d in (0, 1, 6, 8, 9, 19, 20, 30, 40, 200)], "k string, d long")
    got = {r.d: r.range_id for r in joins.asof_interval(asked, ranges, ["k"], "d", "s", "e", "id").collect()}
    assert got == {0: None, 1: 1, 6: 2, 8: 2, 9: 1, 19: 1, 20: 3, 30: 4, 40: 3, 200: 3}


@pytest.mark.parametrize("seed", range(3))
def test_asof_interval_brute_force(spark, seed):
    """Nested, touching, equal, empty, reversed and open ranges; rows that repeat; nulls in keys and dates; up to 600 rows of a key."""
    r = random.Random(seed)
    key, day = lambda: r.choice(["a", "a", "a", "b", None]), lambda: r.choice([None, *range(80)] if seed else range(2000))
    ranges = [(key(), s := day(), r.choice([None, s, (s or 0) + r.randint(-3, 60), (s or 0) + r.randint(0, 900)]), i) for i in range(150)]
    asked = [(key(), day(), i // 2) for i in range(1000)]
    df = spark.createDataFrame(asked, "k string, d long, n long")
    out = joins.asof_interval(df, spark.createDataFrame(ranges, "k string, s long, e long, id long"), ["k"], "d", "s", "e", "id")
    assert out.columns == ["k", "d", "n", "range_id"]
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(str((*row, _newest(row[0], row[1], ranges))) for row in asked)


def test_asof_interval_asks_every_line(spark, duck):
    """Every line with its customer, against all pairs in DuckDB; the range's bounds are inclusive."""
    sql = f"""WITH a AS (SELECT row_number() OVER () AS r, l_orderkey, l_partkey, l_linenumber, o_custkey AS k, l_shipdate AS d FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey),
    m AS (SELECT r, max({{'s': s, 'o': e IS NULL, 'e': e, 'i': id}}).i AS range_id FROM a JOIN {bed_joins._RANGES} o ON o.k = a.k AND s <= d AND (e IS NULL OR d <= e) GROUP BY r)
    SELECT l_orderkey, l_partkey, l_linenumber, range_id FROM a LEFT JOIN m USING (r)"""
    same(bed_joins.asof_interval(spark, DATA), duck, sql)


def test_growth_gbt_trains_the_whole_model(spark, monkeypatch):
    """The registered query trains 200 trees of depth 5 at rate 0.05, as the study does."""
    from inspect import signature

    asked = {}
    train = signature(growth.train_growth)

    def note(*args, **kw):
        bound = train.bind(*args, **kw)
        bound.apply_defaults()
        asked.update(bound.arguments)
        return None, args[0], {}

    monkeypatch.setattr(growth, "train_growth", note)
    bed_growth.growth_gbt(spark, DATA)
    assert {k: asked[k] for k in ("trees", "depth", "rate", "subsample", "seed")} == {"trees": 200, "depth": 5, "rate": 0.05, "subsample": 0.8, "seed": 42}


@pytest.mark.parametrize("threshold", [0.0, 0.5, 0.7, 0.85])
def test_suggest_compares_all_names(spark, threshold):
    """Pairs of similarity 0.5 to 0.8 without a common pair of letters, and random ones, against all pairs."""
    r = random.Random(6)
    word = lambda: "".join(r.choice("abcdef") for _ in range(r.randint(3, 7)))
    names, values = sorted({"acbd", "axcyez", "mnopq", *(word() for _ in range(25))}), sorted({"abcd", "abcdef", "mxoyq", *(word() for _ in range(25))})

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a):
            row, last = [i + 1], row
            for j, y in enumerate(b):
                row.append(min(last[j] + (x != y), last[j + 1] + 1, row[j] + 1))
        return row[-1]

    want = {}
    for v in values:
        score, name = min((-(1 - distance(v, n) / max(len(v), len(n))), n) for n in names)
        want[v] = (name, round(-score, 6)) if -score >= threshold else (v.title(), None)
    frames = [spark.createDataFrame([(x,) for x in xs], f"{c} string") for c, xs in (("v", values), ("n", names))]
    got = {x.v: (x.suggestion, x.score and round(x.score, 6) if x.score is not None else None) for x in mdm.suggest(*frames, "v", "n", threshold).collect()}
    assert got == want
