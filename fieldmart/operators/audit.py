"""Run analytics, retention and profiles of layers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fieldmart.operators.shape import classify


def run_kpis(log: DataFrame) -> DataFrame:
    """log (target, state, rows_read, rows_rejected, seconds, started): one row of totals."""
    return log.agg(F.count("*").alias("runs"), F.sum("rows_read").alias("rows_read"), F.sum("rows_rejected").alias("rows_rejected"), F.count_if(F.col("state") == "ERROR").alias("errors"), F.countDistinct("target").alias("targets"), F.max("started").alias("last"), F.round(F.avg("seconds"), 2).alias("mean_seconds"))


def log_run(result: DataFrame, now: Column) -> DataFrame:
    return result.withColumn("logged_at", now)


def staleness(runs: DataFrame, beats: DataFrame, key: str, now: Column) -> DataFrame:
    """Open items with the seconds since their request and since their last heartbeat."""
    last = beats.groupBy(F.col(key).alias("_k")).agg(F.max("at").alias("_last"))
    joined = runs.where("open").join(last, F.col(key) == F.col("_k"), "left")
    age = lambda c: F.timestamp_diff("SECOND", c, now)
    return joined.select(key, age(F.col("requested")).alias("since_request"), age(F.col("_last")).alias("since_beat"))


def freshness_class(df: DataFrame, last_seen: str, now: Column, ttl: int = 120) -> DataFrame:
    age = F.timestamp_diff("SECOND", F.col(last_seen), now)
    return df.withColumn("freshness", classify([(F.col(last_seen).isNull(), "FREE"), (age <= ttl, "ACTIVE")], "EXPIRED"))


def retention(events: DataFrame, runs: DataFrame, run_key: str, at: str, days: int, now: Column, closed: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(kept, purged) events: those older than `days` whose run is in a closed state go."""
    done = runs.where(F.col("state").isin(*closed)).select(F.col(run_key).alias("_run")).distinct().withColumn("_done", F.lit(True))
    joined = events.join(done, F.col(run_key) == F.col("_run"), "left").withColumn("_purge", (F.col(at) < F.date_sub(now.cast("date"), days)) & F.coalesce("_done", F.lit(False)))
    clean = lambda df: df.select(*events.columns)
    return clean(joined.where("not _purge")), clean(joined.where("_purge"))


def state_histogram(raw: DataFrame, column: str) -> DataFrame:
    return raw.groupBy(column).agg(F.count("*").alias("n"))


def surrogate_share(fact: DataFrame, fk: str, value: int = -1) -> DataFrame:
    return fact.agg(F.count("*").alias("rows"), F.count_if(F.col(fk) == value).alias("surrogate"), F.round(F.count_if(F.col(fk) == value) * 100 / F.count("*"), 2).alias("pct"))


def domain_scorecard(domains: Mapping[str, tuple[DataFrame, DataFrame, DataFrame, DataFrame]], most_pending: float = 5.0) -> DataFrame:
    """For each domain (facts, orphans, duplicate groups, pending quarantine): counts, verdict, readiness for models.

    More pending records than `most_pending` percent of the rows, or duplicates, ask for a review.
    """
    rows = []
    for name, (fact, lost, twice, pending) in domains.items():
        one = fact.agg(F.count("*").alias("rows"))
        for df, out in ((lost, "orphans"), (twice, "duplicates"), (pending, "pending")):
            one = one.crossJoin(df.agg(F.count("*").alias(out)))
        rows.append(one.select(F.lit(name).alias("domain"), "rows", "orphans", "duplicates", "pending"))
    verdict = classify([(F.col("rows") == 0, "EMPTY"), (F.col("orphans") > 0, "BROKEN"), ((F.col("duplicates") > 0) | (F.col("pending") * 100 > F.col("rows") * most_pending), "REVIEW")], "OK")
    return reduce(DataFrame.unionByName, rows).withColumns({"verdict": verdict, "ready": (verdict == "OK") & (F.col("rows") >= 1000)})


def residual_scan(tables: Mapping[str, DataFrame], column: str, value: str) -> DataFrame:
    """Rows of each table whose cleaned column still has the value."""
    clean = F.regexp_replace(F.trim(column), r"\s+", "")
    return reduce(DataFrame.unionByName, [df.agg(F.count_if(clean == value).alias("n")).select(F.lit(name).alias("table_name"), "n") for name, df in tables.items()])


def log_steps(lines: DataFrame, run: str, seq: str, line: str, pattern: str) -> DataFrame:
    """Lines with the step that was last announced in their run."""
    step = F.nullif(F.regexp_extract(line, pattern, 1), F.lit(""))
    w = W.partitionBy(run).orderBy(seq).rowsBetween(W.unboundedPreceding, W.currentRow)
    return lines.withColumn("step", F.last(step, ignorenulls=True).over(w))


def check_expectations(metrics: DataFrame, expectations: DataFrame) -> DataFrame:
    """metrics (name, value) against expectations (name, low, high): verdict OK, LOW, HIGH or MISSING."""
    joined = expectations.join(metrics, "name", "left")
    return joined.select("name", "value", classify([(F.col("value").isNull(), "MISSING"), (F.col("value") < F.col("low"), "LOW"), (F.col("value") > F.col("high"), "HIGH")], "OK").alias("verdict"))
