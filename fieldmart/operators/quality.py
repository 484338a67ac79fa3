"""Data quality: rules, cell validators, reject cascades, quarantine."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldmart.functions import dates, numbers, text

# fixed values: the quarantine record
QUARANTINE = ("source_table", "source_column", "received_value", "reason", "rule_type", "severity", "score", "state", "corrected_value", "approved_by", "source_row_id", "entered_at", "resolved_at")
PENDING, RESOLVED, DISCARDED = "PENDIENTE", "RESUELTO", "DESCARTADO"
QUARANTINE_KEY = ("source_table", "source_column", "received_value", "reason", "source_row_id")
BERRY_WEIGHT = (0.5, 8.0)
REJECT, ALERT = "RECHAZAR", "ALERTA"

_ERROR = "struct<column:string,value:string,reason:string,rule_type:string,severity:string,action:string>"


def _error(column: str, value: Column, reason: str, rule_type: str, severity: str = "ALTO", action: str = ALERT) -> Column:
    return F.struct(F.lit(column).alias("column"), value.cast("string").alias("value"), F.lit(reason).alias("reason"), F.lit(rule_type).alias("rule_type"), F.lit(severity).alias("severity"), F.lit(action).alias("action"))


def _failing(pairs: Sequence[tuple[Column, Column]]) -> Column:
    """Array of the error structs whose condition holds."""
    none = F.lit(None).cast(_ERROR)
    return F.filter(F.array(*[F.when(F.coalesce(bad, F.lit(False)), e.cast(_ERROR)).otherwise(none) for bad, e in pairs]), lambda e: e.isNotNull())


def _split(df: DataFrame, errors: Column) -> tuple[DataFrame, DataFrame]:
    """(rows without a RECHAZAR error, all errors with their rows)."""
    checked = df.withColumn("_errors", errors)
    kept = checked.where(~F.exists("_errors", lambda e: e["action"] == REJECT)).drop("_errors")
    return kept, checked.select(*df.columns, F.inline("_errors"))


def apply_rules(df: DataFrame, rules: Sequence[Mapping]) -> tuple[DataFrame, DataFrame]:
    """(kept, errors) for RANGO (min, max; non-numeric is an error) and FORMATO (pattern from the start) rules in one pass.

    A rule: column, rule_type, min, max, pattern, action. NULL passes. A rule set is a configuration of some tens of rows.
    """
    pairs = []
    for rule in rules:
        c = F.col(rule["column"])
        if rule["rule_type"] == "RANGO":
            n = c.cast("string").try_cast("double")
            bad = n.isNull()
            if rule.get("min") is not None:
                bad = bad | (n < rule["min"])
            if rule.get("max") is not None:
                bad = bad | (n > rule["max"])
            reason = f"out of range {rule.get('min')} to {rule.get('max')}"
        else:
            bad, reason = ~c.cast("string").rlike(f"^(?:{rule['pattern']})"), f"does not match {rule['pattern']}"
        pairs.append((c.isNotNull() & bad, _error(rule["column"], c, reason, rule["rule_type"], "ALTO", rule.get("action", ALERT))))
    return _split(df, _failing(pairs))


def rules_catalogue(df: DataFrame, column: str, catalogue: DataFrame, key: str) -> DataFrame:
    """Rows whose value the catalogue lacks (NULL passes)."""
    known = catalogue.select(F.col(key).alias("_known")).distinct()
    return df.where(F.col(column).isNotNull()).join(known, F.col(column) == F.col("_known"), "left_anti")


def rules_statistical(df: DataFrame, column: str, z: float = 3.0) -> DataFrame:
    """Rows further than z standard deviations from the mean; the statistics are one row."""
    stats = df.agg(F.avg(column).alias("_mean"), F.stddev_samp(column).alias("_std"))
    return df.crossJoin(stats).where(F.abs(F.col(column) - F.col("_mean")) > z * F.col("_std")).drop("_mean", "_std")


def validate(df: DataFrame, kinds: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """Cell validators by column: id, date, berry_weight, samples, total_plants, humidity, variety, module, person, required. (rows with `critical`, errors)."""
    pairs = []
    for column, kind in kinds.items():
        c = F.col(column)
        n = numbers.to_decimal(c.cast("string"))
        bad, reason, severity = {
            "id": (~text.valid_id(text.clean_id(c.cast("string"))), "invalid id", "ALTO"),
            "date": (dates.parse_datetime(c.cast("string")).isNull(), "invalid date", "CRITICO"),
            "berry_weight": (n.isNull() | ~n.between(*BERRY_WEIGHT), "weight out of range", "CRITICO"),
            "samples": (n.isNull() | (n < 1), "at least one sample", "ALTO"),
            "total_plants": (n.isNull() | (n < 1), "at least one plant", "CRITICO"),
            "humidity": (c.isNotNull() & numbers.humidity_pct(n).isNull(), "humidity out of range", "MEDIO"),
            "variety": (text.match_key(c.cast("string")).isNull(), "variety is missing", "ALTO"),
            "module": (~F.coalesce(text.last_number(c.cast("string")).rlike(r"^\d+(\.\d+)?$") | text.contains_any(c.cast("string")), F.lit(False)), "invalid module", "ALTO"),
            "person": (~F.coalesce(text.squeeze(c.cast("string")).rlike(r"^\p{L}[\p{L}'. -]*\p{L}\.?$"), F.lit(False)), "invalid name of a person", "MEDIO"),
            "required": (text.nullish(c.cast("string")).isNull(), "value is missing", "CRITICO"),
        }[kind]
        pairs.append((bad, _error(column, c, reason, "DQ", severity)))
    checked = df.withColumn("_errors", _failing(pairs))
    rows = checked.select(*df.columns, F.exists("_errors", lambda e: e["severity"] == "CRITICO").alias("critical"))
    return rows, checked.select(*df.columns, F.inline("_errors"))


def first_failure(df: DataFrame, checks: Sequence[tuple[Column, str, str, str, str]]) -> tuple[DataFrame, DataFrame]:
    """(kept, rejects): the first failing check (condition, column, reason, type, severity) names the reason; each row is in one of them."""
    first = F.coalesce(*[F.when(F.coalesce(bad, F.lit(False)), _error(column, F.col(column) if column in df.columns else F.lit(None), reason, kind, severity).cast(_ERROR)) for bad, column, reason, kind, severity in checks])
    checked = df.withColumn("_failure", first)
    rejects = checked.where(F.col("_failure").isNotNull()).select(*df.columns, *[F.col("_failure")[f].alias(o) for f, o in (("column", "source_column"), ("value", "received_value"), ("reason", "reason"), ("rule_type", "rule_type"), ("severity", "severity"))])
    return checked.where(F.col("_failure").isNull()).drop("_failure"), rejects


def quarantine(rejects: DataFrame, source_table: str, row_id: str, now: Column) -> DataFrame:
    """Rejects as quarantine records in state PENDIENTE."""
    have = {"source_table": F.lit(source_table), "source_row_id": F.col(row_id).cast("bigint"), "state": F.lit(PENDING), "entered_at": now}
    empty = {"score": "double", "corrected_value": "string", "approved_by": "string", "resolved_at": "timestamp_ntz"}
    return rejects.select(*[have[c].alias(c) if c in have else F.lit(None).cast(empty[c]).alias(c) if c in empty else F.col(c) for c in QUARANTINE])


def quarantine_append(new: DataFrame, existing: DataFrame, key: Sequence[str] = QUARANTINE_KEY) -> DataFrame:
    """New records to append: one for each key, none that is pending already; NULLs are equal."""
    once = new.dropDuplicates(list(key))
    pending = existing.where(F.col("state") == PENDING).select(*[F.col(k).alias(f"_{k}") for k in key]).distinct()
    return once.join(pending, reduce(lambda a, b: a & b, [once[k].eqNullSafe(pending[f"_{k}"]) for k in key]), "left_anti")


def resolve(records: DataFrame, decisions: DataFrame, id_: str, now: Column) -> DataFrame:
    """Applies decisions (id, decision, value, who) to pending records; others stay."""
    d = decisions.select(F.col(id_).alias("_id"), F.col("decision").alias("_decision"), F.col("value").alias("_value"), F.col("who").alias("_who"))
    joined = records.join(d, records[id_] == d["_id"], "left")
    hit = F.col("_id").isNotNull() & (F.col("state") == PENDING)
    to = {"state": F.col("_decision"), "corrected_value": F.when(F.col("_decision") == RESOLVED, F.col("_value")), "approved_by": F.col("_who"), "resolved_at": now}
    return joined.select(*[F.when(hit, to[c]).otherwise(F.col(c)).alias(c) if c in to else F.col(c) for c in records.columns])


def reinject(records: DataFrame, raw: DataFrame, source_table: str, id_: str, state: str = "load_state") -> DataFrame:
    """raw with the rejected rows of resolved records reopened as CARGADO."""
    ids = records.where((F.col("source_table") == source_table) & (F.col("state") == RESOLVED) & F.col("source_row_id").isNotNull()).select(F.col("source_row_id").alias("_id")).distinct()
    joined = raw.join(ids, raw[id_] == ids["_id"], "left")
    return joined.select(*[F.when(F.col("_id").isNotNull() & (F.col(state) == "RECHAZADO"), "CARGADO").otherwise(F.col(state)).alias(c) if c == state else F.col(c) for c in raw.columns])


def quality_gate(read: DataFrame, rejects: DataFrame, row_id: str, limit: float = 5.0, external: DataFrame | None = None) -> DataFrame:
    """One row: rows_read, rows_rejected (distinct ids), rate, over_limit. Rows of `external`, duplicates of what is loaded already, are no rejects."""
    if external is not None:
        rejects = rejects.join(external.select(row_id).distinct(), row_id, "left_anti")
    one = read.agg(F.count("*").alias("rows_read")).crossJoin(rejects.agg(F.countDistinct(row_id).alias("rows_rejected")))
    rate = F.round(F.col("rows_rejected") * 100 / F.col("rows_read"), 2)
    return one.select("rows_read", "rows_rejected", rate.alias("rate"), (rate > limit).alias("over_limit"))


def dq_backlog(records: DataFrame) -> DataFrame:
    """Pending records by day, table, column and reason."""
    return records.where(F.col("state") == PENDING).groupBy(F.to_date("entered_at").alias("day"), "source_table", "source_column", "reason").agg(F.count("*").alias("n"))


def dq_top_values(records: DataFrame, least: int = 2, most: int = 50) -> DataFrame:
    """Received values that come back most often: a report of the `most` first."""
    counted = records.groupBy("source_table", "source_column", "received_value").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    return counted.orderBy(F.desc("n"), "source_table", "source_column", "received_value").limit(most)


def quarantine_kpis(records: DataFrame, cut: float = 0.85) -> DataFrame:
    states = {s.lower(): F.col("state") == s for s in (PENDING, RESOLVED, DISCARDED)}
    return records.agg(F.count("*").alias("total"), *[F.count_if(p).alias(n) for n, p in states.items()], F.count_if(F.col("score") >= cut).alias("high"), F.count_if(F.col("score") < cut).alias("low"))


def error_mart(df: DataFrame, codes: Mapping[str, str], text_column: str, week: Column, severity: str) -> DataFrame:
    """Free-text operator errors as codes, with counts and severity by week."""
    coded = df.select(text.map_code(F.col(text_column), codes, keep=False).alias("code"), week.alias("week"), F.col(severity).alias("_severity"))
    sums = coded.groupBy("week", F.coalesce("code", F.lit("OTHER")).alias("code")).agg(F.count("*").alias("n"), F.sum("_severity").alias("severity"))
    return sums.withColumn("mean_severity", F.col("severity").cast("double") / F.col("n"))
