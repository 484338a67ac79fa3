"""Centroid clustering: against plain Lloyd rounds, its SQL, and bounds that must hold."""

import hashlib
import math

import numpy as np
from pyspark.sql import functions as F

from fieldmart.llm import nsbounds, q_op13
from tests.conftest import DATA
from tests.helpers import same

TABLE = "vec_id long, embedding array<double>, label int"


def lloyd(rows, k, rounds, dims=64):
    """(vec_id, cluster, distance) by comparing every vector with every centroid in each round."""
    kept = [(i, [math.floor(256 * v) for v in e]) for i, e in rows if e is not None and len(e) == dims and all(v is not None and math.isfinite(v) for v in e)]
    x = np.array([v for _, v in kept], np.int64)
    order = sorted(range(len(kept)), key=lambda r: (hashlib.sha256(f"2:{'' if kept[r][0] is None else kept[r][0]}".encode()).hexdigest(), kept[r][1]))
    c = x[order[:k]]
    for r in range(rounds + 1):
        d = ((x[:, None, :] - c[None]) ** 2).sum(2)
        a = d.argmin(1)
        if r < rounds:
            c = np.array([[int(s) // int((a == j).sum()) for s in x[a == j].sum(0)] if (a == j).any() else c[j] for j in range(len(c))])
    return sorted((str(i), int(a[n]), int(d[n, a[n]])) for n, (i, _) in enumerate(kept))


def test_equals_its_sql(spark, duck):
    same(q_op13.op13_centroids(spark, DATA), duck, q_op13.SQL)


def test_equals_lloyd_on_ties_copies_nulls_and_odd_vectors(spark):
    r = np.random.default_rng(3)
    centres = r.normal(0, 1, (6, 64))
    rows = [(i, (centres[i % 6] + r.normal(0, 0.4, 64)).tolist()) for i in range(700)]
    rows += [(1000 + i, [float(i % 2)] * 64) for i in range(100)]  # ties and copies
    rows += [(5, rows[5][1]), (5, rows[5][1]), (None, [0.5] * 64)]
    odd = [(2000, None), (2001, [1.0] * 63), (2002, [1.0] * 65), (2003, [None] + [1.0] * 63), (2004, [float("nan")] + [1.0] * 63), (2005, [float("inf")] + [1.0] * 63), (2006, [])]
    df = spark.createDataFrame([(i, e, None) for i, e in rows + odd], TABLE).withColumns({"x": F.lit("x"), "cluster": F.lit(-5), "was": F.lit(None).cast("string")})
    for k in (1, 7, 40):
        got = sorted((str(v.vec_id), v.cluster, v.distance) for v in nsbounds.cluster(df, clusters=k).collect())
        assert got == lloyd(rows + odd, k, 5), k


def test_fewer_vectors_than_centroids_and_empty_tables(spark):
    two = spark.createDataFrame([(1, [0.0] * 64, 1), (2, [3.0] * 64, 1)], TABLE)
    assert {(r.vec_id, r.distance) for r in nsbounds.cluster(two).collect()} == {(1, 0), (2, 0)}
    assert nsbounds.cluster(two.limit(0)).collect() == []


def test_bounds_hold_and_spare_rescans():
    """Every vector keeps its true cluster through twelve rounds of drifting centroids, and most are never rescanned."""
    r = np.random.default_rng(9)
    true = r.integers(-400, 400, (12, 64))
    x = true[r.integers(0, 12, 5000)] + r.integers(-60, 60, (5000, 64))
    n = len(x)
    block = nsbounds.Block(x, np.full(n, -1, np.int32), np.zeros(n), np.zeros(n, np.int32), np.zeros(n), np.zeros(n, np.int32))
    history, rescanned = [true.astype(np.int64)], []
    for _ in range(12):
        block.assign(history)
        rescanned.append(block.rescanned)
        d = ((x[:, None, :].astype(np.int64) - history[-1][None]) ** 2).sum(2)
        assert (block.cluster == d.argmin(1)).all()
        history.append(history[-1] + r.integers(-9, 10, (12, 64)))
    assert rescanned[0] == n and sum(rescanned[1:]) < n


def test_displacement_of_a_centroid_that_comes_back_is_nothing():
    a, b = np.zeros((3, 64), np.int64), np.ones((3, 64), np.int64)
    moved, others = nsbounds.displacements([a, b, a])
    assert moved[0].tolist() == [0, 0, 0] and moved[1].tolist() == [8, 8, 8] and others[1].tolist() == [8, 8, 8]


def test_large_components_stay_exact():
    x = np.array([[(1 << 26) + i, 3 - i] for i in range(4)], np.int64)
    c = np.array([[-(1 << 26), 5], [(1 << 26), 2]], np.int64)
    assert nsbounds._squared(x, c).tolist() == [[sum((int(a) - int(b)) ** 2 for a, b in zip(p, q)) for q in c] for p in x]
