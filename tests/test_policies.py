"""De-duplication, load and text policies on small cases, and their invariants."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fieldmart.functions import dates, numbers, text
from fieldmart.operators import dedup, dims, quality
from fieldmart.operators.load import FactSpec, load_insert_new, load_merge_latest, sink_columns
from fieldmart.sources import kv, raw

READING = "k int, ts timestamp_ntz, n int, id long"


def t(h, m, s):
    return dt.datetime(2026, 3, 19, h, m, s)


@pytest.mark.parametrize(
    ("rows", "kept"),
    [
        ([(1, t(16, 19, 12), 3, 10), (1, t(16, 23, 18), 165, 11)], {(165, 11)}),
        ([(1, t(16, 23, 18), 165, 11), (1, t(16, 19, 12), 3, 10)], {(165, 11)}),
        ([(1, None, 1, 1), (2, None, 2, 2), (3, None, 3, 3)], {(1, 1), (2, 2), (3, 3)}),
        ([(1, None, 99, 1), (1, t(16, 19, 12), 3, 2)], {(3, 2)}),
        ([(1, t(16, 47, 17), 17, 30), (1, t(16, 50, 33), 17, 31), (1, t(16, 52, 2), 4, 32)], {(4, 32)}),
        ([(1, t(17, 8, 8), 39, 1), (1, t(17, 9, 0), 81, 2)], {(81, 2)}),
        ([(1, t(17, 8, 8), 39, 5), (1, t(17, 8, 8), 81, 6)], {(39, 5)}),
    ],
)
def test_latest_wins(spark, rows, kept):
    df = spark.createDataFrame(rows, READING)
    assert {(r.n, r.id) for r in dedup.dedup_latest(df, ["k"], "ts", ["id"]).collect()} == kept


def test_first_wins(spark):
    df = spark.createDataFrame([(1, None, 3, 1), (1, None, 165, 2), (None, None, 7, 3), (None, None, 8, 4)], READING)
    kept, rejects = dedup.dedup_first(df, ["k"], ["id"])
    assert {r.n for r in kept.collect()} == {3, 7}
    assert {(r.n, r.key_text, r.rule_type) for r in rejects.collect()} == {(165, "1", "DUPLICADO_INTERNO"), (8, "NULL", "DUPLICADO_INTERNO")}


def test_signature(spark):
    df = spark.createDataFrame([(1, None, 3, 1), (1, None, 3, 2), (2, None, 4, 3), (2, None, 5, 4), (3, None, None, 5), (3, None, None, 6)], READING)
    kept, rejects = dedup.dedup_signature(df, ["k"], ["n"], ["id"])
    assert {r.id for r in kept.collect()} == {1, 5} and {r.id for r in rejects.collect()} == {3, 4}


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.integers(0, 3)), max_size=12))
def test_split_is_whole(spark, pairs):
    df = spark.createDataFrame([(k, None, n, i) for i, (k, n) in enumerate(pairs)], READING)
    kept, rejects = dedup.dedup_first(df, ["k"], ["id"])
    assert sorted([r.id for r in kept.collect()] + [r.id for r in rejects.collect()]) == list(range(len(pairs)))
    again, none = dedup.dedup_first(kept, ["k"], ["id"])
    assert none.count() == 0 and again.count() == kept.count()


def test_insert_new_twice_adds_nothing(spark):
    spec = FactSpec("f", ("k",), ("id",))
    batch = spark.createDataFrame([(1, None, 3, 1), (1, None, 4, 2), (None, None, 5, 3)], READING)
    first = load_insert_new(batch, batch.limit(0), spec)
    assert first.rows.count() == 2
    second = load_insert_new(batch, first.rows, spec)
    assert second.inserted.count() == 0 and second.external.count() == 2


def test_merge_latest(spark):
    spec = FactSpec("f", ("k",), ("id",), "ts")
    target = spark.createDataFrame([(1, t(1, 0, 0), 1, 1), (2, t(5, 0, 0), 2, 2), (None, None, 9, 9)], READING)
    batch = spark.createDataFrame([(1, t(2, 0, 0), 10, 3), (2, t(4, 0, 0), 20, 4), (3, None, 30, 5), (None, t(1, 0, 0), 90, 6)], READING)
    assert {(r.k, r.n, r.action) for r in load_merge_latest(batch, target, spec).collect()} == {(1, 10, "updated"), (2, 2, "kept"), (3, 30, "inserted"), (None, 90, "updated")}


def test_sink_and_empty_grain(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, id_origen_rastreo int, x_Virtual int")
    assert sink_columns(df).columns == ["a"]
    with pytest.raises(ValueError):
        FactSpec("f", (), ("id",))


def test_scd2_has_one_current_row(spark):
    dim = spark.createDataFrame([(1, "a", dt.date(2025, 1, 1), None, True), (2, "b", dt.date(2025, 1, 1), None, True)], "k int, v string, valid_from date, valid_to date, is_current boolean")
    src = spark.createDataFrame([(1, "a"), (2, "c"), (3, "d")], "k int, v string")
    once = dims.scd2(dim, src, ["k"], ["v"], F.lit("2026-01-01").cast("date"))
    assert once.where("is_current").groupBy("k").count().where("count <> 1").count() == 0 and once.count() == 4
    assert dims.scd2(once, src, ["k"], ["v"], F.lit("2026-02-01").cast("date")).count() == 4


def test_quarantine_is_idempotent(spark):
    rejects = spark.createDataFrame([(1, "c", "v", "r", "DQ", "ALTO"), (1, "c", "v", "r", "DQ", "ALTO"), (None, "c", None, "r", "DQ", "ALTO")], "id long, source_column string, received_value string, reason string, rule_type string, severity string")
    records = quality.quarantine(rejects, "t", "id", F.lit("2026-01-01").cast("timestamp_ntz"))
    stored = quality.quarantine_append(records, records.limit(0))
    assert stored.count() == 2 and quality.quarantine_append(records, stored).count() == 0


@pytest.mark.parametrize(
    ("value", "want"),
    [("2026-03-19", "2026-03-19 00:00:00"), ("2026-03-19T16:19:12", "2026-03-19 16:19:12"), ("19/03/2026 16:19", "2026-03-19 16:19:00"), ("1/3/2026", "2026-03-01 00:00:00"), ("19.03.2026", "2026-03-19 00:00:00"), ("20260319", "2026-03-19 00:00:00"), ("25/03/19", "2025-03-19 00:00:00"), ("19-03-26", "2026-03-19 00:00:00"), ("45735", "2025-03-19 00:00:00"), ("1/2/24", "2024-02-01 00:00:00"), ("13/2/24", "2024-02-13 00:00:00"), ("2/13/24", "2024-02-13 00:00:00"), ("1-2-24 7:05", "2024-02-01 07:05:00"), ("1.12.99", "1999-12-01 00:00:00"), ("1/2/24 3:04 pm", "2024-02-01 15:04:00"), ("31/2/24", None), ("1/2-24", None), ("1/2/2", None), ("31/02/2026", None), ("", None), (None, None)],
)
def test_dates(spark, value, want):
    got = spark.createDataFrame([(value,)], "c string").select(dates.parse_datetime(F.col("c")).cast("string").alias("d")).first().d
    assert got == want


def test_values(spark):
    def one(value, fn):
        return spark.createDataFrame([(value,)], "c string").select(fn(F.col("c")).alias("x")).first().x

    assert [one(v, text.clean_id) for v in ("7654321", "7654321.0", "1.234.567", " 12345678 ", "123456789", "")] == ["07654321", "07654321", "01234567", "12345678", "123456789", None]
    assert [one(v, text.last_number) for v in ("MODULE 2", "SHIFT 04", "9.1", "XII", "Test Block", "VALVE NO 15", None)] == ["2", "4", "9.1", "XII", "TEST BLOCK", "15", None]
    assert [one(v, text.match_key) for v in ("QRT15 – 005", "ZB 19-006", "  old amber  ", "nan")] == ["QRT15-005", "ZB19-006", "OLD AMBER", None]
    assert [one(v, text.compact_key) for v in ("O'Neal", "--")] == ["ONEAL", None]
    assert [one(v, numbers.to_decimal) for v in ("2,5", "2.5", "nan", "None", "x", "-1", "inf")] == [2.5, 2.5, None, None, None, -1.0, None]
    assert one("O'Neal-X Fcm15A", lambda c: text.title(F.upper(c))) == "O'Neal-X Fcm15A".title()


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.dictionaries(st.text("abc", min_size=1, max_size=3), st.text("xyz 1", min_size=1, max_size=4).map(str.strip).filter(bool), max_size=4))
def test_kv_round_trip(spark, pairs):
    df = spark.createDataFrame([(pairs,)], "m map<string,string>")
    assert df.select(kv.parse_kv(kv.encode_kv(F.col("m"))).alias("m")).first().m == pairs
    assert spark.createDataFrame([("A=1 | junk | =z | A=2 | B=x=y",)], "c string").select(kv.parse_kv(F.col("c")).alias("m")).first().m == {"A": "2", "B": "x=y"}


def test_publish_replaces(spark, tmp_path):
    a = spark.createDataFrame([(1,)], "x int")
    raw.publish({"m": a}, str(tmp_path))
    raw.publish({"m": a.union(a)}, str(tmp_path))
    assert raw.published(spark, str(tmp_path), "m").count() == 2
    with pytest.raises(Exception):
        raw.publish({"m": a, "n": a.select(F.raise_error(F.lit("no")))}, str(tmp_path))
    assert raw.published(spark, str(tmp_path), "m").count() == 2
    assert not raw.export_csv(a.limit(0), f"{tmp_path}/none")
