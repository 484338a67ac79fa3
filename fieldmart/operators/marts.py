"""Marts: denormalised aggregates over facts and dimensions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldmart.functions import numbers
from fieldmart.operators.joins import role_join, star_join


def exact(c: str, scale: int = 2) -> Column:
    """Decimals: their sums don't depend on the order of rows."""
    return F.col(c).cast(f"decimal(18,{scale})")


def mean(c: str, scale: int = 2) -> Column:
    return F.sum(exact(c, scale)).cast("double") / F.count(c)


def mart_harvest(fact: DataFrame, dims: list, projections: DataFrame, scenario: str, keys: list[str]) -> DataFrame:
    """Facts with dimensions, and the projected kilograms of one scenario by the same keys."""
    base = projections.where(F.col("scenario") == scenario).groupBy(*keys).agg(F.sum(exact("projected")).cast("double").alias("projected"))
    return star_join(fact, dims).join(base, keys, "left")


def mart_projection(projections: DataFrame, states: DataFrame) -> DataFrame:
    return projections.join(states, "state_code", "left")


def mart_phenology(fact: DataFrame, dims: list, keys: list[str], organs: str, states: DataFrame, state: str) -> DataFrame:
    """Organs by the keys and the state, with the state's name and place in the cycle; states (state_id, label, state_order)."""
    named = star_join(fact, dims).join(states, F.col(state) == F.col("state_id"))
    return named.groupBy(*keys, "label", "state_order").agg(F.sum(organs).alias("organs"))


def mart_weather(fact: DataFrame, calendar: DataFrame, sector: str = "sector") -> DataFrame:
    """By day and sector: readings, mean temperatures (their mean too), vapour pressure deficit and humidity, and the sum of rain."""
    dated = fact.join(calendar.select("date_id", "day"), "date_id")
    means = [mean(c, 3).alias(c) for c in ("tmax", "tmin", "vpd", "humidity")]
    rolled = dated.groupBy("date_id", "day", sector).agg(F.count("*").alias("readings"), *means, F.sum(exact("rain", 3)).cast("double").alias("rain"))
    return rolled.withColumn("tmean", (F.col("tmax") + F.col("tmin")) / 2)


def mart_weights(fact: DataFrame, dims: list, keys: list[str], weight: str, samples: str) -> DataFrame:
    return star_join(fact, dims).groupBy(*keys).agg(mean(weight).alias("mean_weight"), F.sum(samples).alias("samples"))


def mart_labour(fact: DataFrame, people: DataFrame, pk: str, name: str, roles: Mapping[str, str], keys: list[str], hours: str, flag: Column) -> DataFrame:
    """Hours and flagged rows by person and supervisor; a missing supervisor gets a default text."""
    joined = role_join(fact, people, pk, name, roles)
    named = joined.withColumns({out: F.coalesce(out, F.lit("NO SUPERVISOR")) for out in list(roles.values())[1:]}).withColumn("_flag", flag.cast("int"))
    return named.groupBy(*keys).agg(F.sum(exact(hours)).cast("double").alias("hours"), F.sum("_flag").alias("flagged"))


def with_derived(df: DataFrame, ratios: Mapping[str, tuple[Column, Column, float]]) -> DataFrame:
    """Guarded ratios: name -> (numerator, denominator, scale), NULL unless the denominator is positive."""
    return df.withColumns({name: numbers.ratio(num, den) * scale for name, (num, den, scale) in ratios.items()})
