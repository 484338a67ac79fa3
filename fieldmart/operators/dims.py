"""Dimensions: calendar, slowly changing dimensions, seeds."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldmart.functions import dates
from fieldmart.operators.dedup import rank_first

# fixed values: static members, in the order of their ids, and the first id
SEEDS = {
    "state": ("Boton Floral", "Flor", "Pequena", "Verde", "Inicio F1", "Inicio F2", "Crema", "Madura", "Cosechable"),
    "third": ("BAJO", "MEDIO", "ALTO"),
    "ribbon": ("Roja", "Azul", "Verde", "Amarilla", "Blanca", "Naranja"),
    "condition": ("Suelo / GlobalGAP", "Suelo / Organico", "Sustrato / GlobalGAP", "Sustrato / Organico", "Suelo / Sin certificacion"),
    "activity": ("Cosecha", "Poda", "Defoliacion", "Evaluacion fenologica", "Evaluacion de pesos", "Evaluacion vegetativa", "Aplicacion fitosanitaria", "Riego", "Fertilizacion", "Supervision", "Fiscalizacion", "Transporte interno"),
    "scenario": ("Presupuesto", "Preliminar", "Mensual", "Final", "Manual", "Modelo", "Ajuste"),
    "workflow": ("Borrador", "En revision", "Aprobada", "Archivada", "Rechazada"),
    "person": ("SIN PERSONAL",),
}
FIRST_ID = {"state": 0, "third": 0, "person": -1}


def seed(spark: SparkSession, name: str) -> DataFrame:
    """(id, label) of a static dimension."""
    return spark.createDataFrame(list(enumerate(SEEDS[name], FIRST_ID.get(name, 1))), "id int, label string")


def dim_time(spark: SparkSession, start: str, end: str, base: str = dates.HARVEST_BASE) -> DataFrame:
    """One row for each day: ids, weeks, ISO weekday, month name, weekend flag."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("day"))
    d = F.col("day")
    return days.select(dates.date_id(d).alias("date_id"), "day", F.year(d).alias("year"), F.month(d).alias("month"), dates.iso_week(d).alias("iso_week"), dates.harvest_week(d, base).alias("harvest_week"), dates.iso_weekday(d).alias("weekday"), F.date_format(d, "MMMM").alias("month_name"), (dates.iso_weekday(d) >= 6).alias("weekend"))


def backfill(dim: DataFrame, days: DataFrame) -> DataFrame:
    """Days that the dimension lacks."""
    return days.join(dim.select("date_id"), "date_id", "left_anti")


def _differs(columns: Sequence[str], a: str, b: str) -> Column:
    return reduce(lambda x, y: x | y, [~F.col(f"{a}{c}").eqNullSafe(F.col(f"{b}{c}")) for c in columns])


def scd1(dim: DataFrame, src: DataFrame, key: str, columns: Sequence[str], priority: Sequence[Column], keep_on_null: bool = True) -> DataFrame:
    """key, columns, action (inserted, updated, kept): one source row for each key by priority; old values stay where the new one is NULL."""
    new = rank_first(src, [key], list(priority)).select(F.col(key).alias("_k"), *[F.col(c).alias(f"_n_{c}") for c in columns])
    both = dim.select(key, *columns).join(new, F.col(key) == F.col("_k"), "full")
    value = {c: F.coalesce(f"_n_{c}", c) if keep_on_null else F.when(F.col("_k").isNotNull(), F.col(f"_n_{c}")).otherwise(F.col(c)) for c in columns}
    merged = both.select(F.coalesce(key, "_k").alias("_key"), F.col(key).isNull().alias("_fresh"), *[v.alias(f"_v_{c}") for c, v in value.items()], *columns)
    action = F.when(F.col("_fresh"), "inserted").when(_differs(columns, "_v_", ""), "updated").otherwise("kept")
    return merged.select(F.col("_key").alias(key), *[F.col(f"_v_{c}").alias(c) for c in columns], action.alias("action"))


def scd2(dim: DataFrame, src: DataFrame, key: Sequence[str], tracked: Sequence[str], today: Column) -> DataFrame:
    """dim (key, tracked, valid_from, valid_to, is_current) after a snapshot: changed rows are closed and opened anew, new ones inserted, missing ones stay."""
    past = dim.where(~F.col("is_current"))
    now = dim.where("is_current")
    b = src.select(*[F.col(k).alias(f"_{k}") for k in key], *[F.col(c).alias(f"_n_{c}") for c in tracked], F.lit(True).alias("_in"))
    both = now.join(b, reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in key]), "full")
    changed = F.coalesce(F.col("is_current") & F.col("_in") & _differs(tracked, "", "_n_"), F.lit(False))
    fresh = F.col("is_current").isNull()
    old = F.struct(*[F.col(c).alias(c) for c in [*key, *tracked]], "valid_from", F.when(changed, today).otherwise(F.col("valid_to")).alias("valid_to"), (~changed).alias("is_current"))
    new = F.struct(*[F.col(f"_{k}").alias(k) for k in key], *[F.col(f"_n_{c}").alias(c) for c in tracked], today.alias("valid_from"), F.lit(None).cast("date").alias("valid_to"), F.lit(True).alias("is_current"))
    rows = F.when(fresh, F.array(new)).when(changed, F.array(old, new)).otherwise(F.array(old))
    return past.select(*key, *tracked, "valid_from", "valid_to", "is_current").unionByName(both.select(F.inline(rows)))
