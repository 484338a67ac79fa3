"""The scalar functions as temporary SQL functions, so that spark.sql() can use them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from fieldmart.functions import dates, numbers, text

# name -> (parameters and types, function). Functions that bind a lambda can't be written out as SQL and are columns only.
FUNCTIONS: dict[str, tuple[dict[str, str], Callable[..., Column]]] = {
    "squeeze": ({"c": "string"}, text.squeeze), "upper_squeeze": ({"c": "string"}, text.upper_squeeze), "strip_accents": ({"c": "string"}, text.strip_accents), "nullish": ({"c": "string"}, text.nullish),
    "clean_numeric_text": ({"c": "string"}, text.clean_numeric_text), "valid_id": ({"c": "string"}, text.valid_id),
    "state_key": ({"c": "string"}, text.state_key), "eq_ci": ({"a": "string", "b": "string"}, text.eq_ci), "to_int": ({"c": "string"}, numbers.to_int), "to_decimal": ({"c": "string"}, numbers.to_decimal), "extract_int": ({"c": "string"}, numbers.extract_int),
    "int_token": ({"c": "string"}, numbers.int_token), "pct": ({"part": "double", "total": "double"}, numbers.pct), "humidity_pct": ({"c": "double"}, numbers.humidity_pct), "excel_serial": ({"c": "string"}, dates.excel_serial), "date_id": ({"c": "timestamp"}, dates.date_id),
    "iso_week": ({"c": "timestamp"}, dates.iso_week), "iso_weekday": ({"c": "timestamp"}, dates.iso_weekday), "harvest_week": ({"c": "timestamp"}, dates.harvest_week), "time_of_day": ({"c": "string"}, dates.time_of_day), "weeks_since": ({"start": "timestamp", "end": "timestamp"}, dates.weeks_since),
}


def register(spark: SparkSession, prefix: str = "fm_") -> list[str]:
    """Creates a temporary function for each of FUNCTIONS, its name after the prefix, and returns the names."""
    made = []
    for name, (parameters, function) in FUNCTIONS.items():
        frame = spark.range(0).select(*[F.lit(None).cast(kind).alias(f"_p_{p}") for p, kind in parameters.items()])
        out = frame.select(function(*[F.col(f"_p_{p}") for p in parameters]).alias("out"))
        body = out._jdf.queryExecution().analyzed().expressions().head().child().sql()
        arguments = ", ".join(f"_p_{p} {kind}" for p, kind in parameters.items())
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}({arguments}) RETURNS {out.schema['out'].dataType.simpleString()} RETURN {body}")
        made.append(prefix + name)
    return made
