"""As-of joins and numbers where one key holds all rows."""

import random

import pytest
from pyspark.sql import functions as F

from fieldmart.operators import joins
from fieldmart.operators.numbering import numbered


def newest(k, d, ranges):
    held = [(s, e is None, e, i) for key, s, e, i in ranges if key == k and k is not None and s is not None and d is not None and s <= d and (e is None or d <= e)]
    return max(held, key=lambda x: (x[0], x[1], -1 if x[2] is None else x[2], x[3]))[3] if held else None


@pytest.mark.parametrize("chunk", [1, 2, 5])
def test_asof_interval_with_one_key(spark, monkeypatch, chunk):
    """Nested, open, empty and repeated ranges; many rows at one time; chunks of 8 to 32,768 places."""
    monkeypatch.setattr(joins, "_CHUNK", chunk)
    r = random.Random(chunk)
    ranges = [("k", s := r.randint(0, 400), r.choice([None, s, s + r.randint(-5, 40), s + r.randint(0, 400)]), i) for i in range(120)]
    ranges += [ranges[3], ranges[3], ("other", 5, None, 900), (None, 5, None, 901), ("k", None, 7, 902)]
    asked = [("k", 200 if i % 3 == 0 else r.randint(-5, 420), i) for i in range(1500)] + [("k", None, 1), (None, 6, 2), ("other", 4, 3), ("other", 6, 4), ("none", 6, 5)]
    df = spark.createDataFrame(asked, "k string, d long, n long")
    found = joins.asof_interval(df, spark.createDataFrame(ranges, "k string, s long, e long, id long"), ["k"], "d", "s", "e", "id").collect()
    assert sorted(map(str, map(tuple, found))) == sorted(str((*row, newest(row[0], row[1], ranges))) for row in asked)


def test_one_key_is_dealt_to_many_tasks(spark):
    """Numbers in order of a key that all rows share and a time that a third of them share: no task gets most of the rows."""
    df = spark.range(40_000).select(F.lit("k").alias("k"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000).alias("d"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # these few rows would be put together again
    try:
        out = numbered(df, ["k", "d", "id"], "n", 1)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    rows = out.select("n", "d", "id").collect()
    assert [r.n for r in sorted(rows, key=lambda r: (r.d, r.id))] == list(range(1, 40_001))
    counts = [x["count"] for x in out.groupBy(F.spark_partition_id()).count().collect()]
    assert len(counts) >= 3 and max(counts) < 20_000


def test_no_step_gathers_a_key(spark):
    """The plan deals nothing by the key alone."""
    df = spark.createDataFrame([("k", 1)], "k string, d long")
    plan = joins.asof_interval(df, spark.createDataFrame([("k", 1, None, 1)], "k string, s long, e long, id long"), ["k"], "d", "s", "e", "id")._jdf.queryExecution().toString()
    dealt = [line for line in plan.splitlines() if "hashpartitioning(k_k" in line]
    assert dealt and all("_range" in line for line in dealt)
