"""Streams over the events table; each call uses folders of its own."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldmart.operators.load import FactSpec
from fieldmart.plans.bed import Bed, Tables, shared_folder
from fieldmart.streaming import incremental as I

bed = Bed()
C = F.col


_EVENT = "event_id long, event_type string, user_id long, ts timestamp, value double"


def _stream(spark, sf_dir, files_at_once=1):
    """Events as a file stream of four files; with one file in a batch, later batches meet stored rows."""
    landing = shared_folder(spark, "landing")
    events = Tables(spark, sf_dir).events.select("event_id", "event_type", "user_id", C("ts").cast("timestamp").alias("ts"), "value")
    events.repartitionByRange(4, "event_id").write.parquet(landing)
    return I.read_landing(spark, landing, _EVENT, files_at_once=files_at_once)


@bed.query("SELECT count(*) AS n, count(DISTINCT event_id) AS ids, min(load_state) AS load_state FROM (SELECT event_id, 'CARGADO' AS load_state FROM events)")
def stream_ingest(spark, sf_dir):
    target, checkpoint = shared_folder(spark, "ingest"), shared_folder(spark, "state")
    I.stream_ingest(_stream(spark, sf_dir), target, checkpoint, F.lit("2026-01-01").cast("timestamp"))
    return spark.read.parquet(target).agg(F.count("*").alias("n"), F.countDistinct("event_id").alias("ids"), F.min("load_state").alias("load_state"))


@bed.query("SELECT event_type, user_id, count(*) AS n FROM (SELECT DISTINCT event_type, user_id FROM events) GROUP BY ALL")
def stream_insert_new(spark, sf_dir):
    target, checkpoint = shared_folder(spark, "facts"), shared_folder(spark, "state")
    I.stream_insert_new(_stream(spark, sf_dir), FactSpec("reading", ("event_type", "user_id"), ("event_id",)), target, checkpoint)
    return spark.read.parquet(target).groupBy("event_type", "user_id").agg(F.count("*").alias("n"))


@bed.query("SELECT event_type, user_id, max(ts) AS ts FROM events GROUP BY ALL")
def stream_merge_latest(spark, sf_dir):
    target, checkpoint = shared_folder(spark, "merged"), shared_folder(spark, "state")
    I.stream_merge_latest(_stream(spark, sf_dir), FactSpec("reading", ("event_type", "user_id"), ("event_id",), "ts"), target, checkpoint)
    return I.merged_state(spark, target, checkpoint, _EVENT).select("event_type", "user_id", C("ts").cast("timestamp_ntz").alias("ts"))


@bed.query("SELECT ts::DATE AS day, event_type, count(value) AS n, min(value) AS low, max(value) AS high FROM events WHERE ts::DATE < (SELECT max(ts - INTERVAL 1 HOUR)::DATE FROM events) GROUP BY ALL")
def stream_daily_rollup(spark, sf_dir):
    target, checkpoint = shared_folder(spark, "rollup"), shared_folder(spark, "state")
    I.stream_daily_rollup(_stream(spark, sf_dir, 100), "ts", "event_type", "value", "1 hour", target, checkpoint)
    return spark.read.parquet(target)
