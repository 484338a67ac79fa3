"""The overflow map: text 'k=v | k2=v2' at the edges, map<string,string> inside."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldmart.functions.bind import bind


def parse_kv(c: Column) -> Column:
    """Items between bars, split at the first '='; items without a key or '=' go; of equal keys the last counts."""
    items = F.filter(F.split(F.coalesce(c, F.lit("")), r"\|"), lambda x: x.contains("=") & (F.trim(F.substring_index(x, "=", 1)) != ""))
    pairs = F.transform(items, lambda x: F.struct(F.trim(F.substring_index(x, "=", 1)).alias("key"), F.trim(x.substr(F.locate("=", x) + 1, F.length(x))).alias("value")))
    last = lambda own, keys: F.map_from_arrays(keys, F.transform(keys, lambda k: F.element_at(F.filter(own, lambda p: p["key"] == k), -1)["value"]))
    distinct = lambda own: bind(F.array_distinct(own["key"]), lambda keys: F.when(F.size(keys) == F.size(own), F.map_from_entries(own)).otherwise(last(own, keys)))
    return bind(pairs, distinct)


def encode_kv(c: Column) -> Column:
    """Text of a map in key order, without null or blank values."""
    solid = F.filter(F.array_sort(F.map_entries(c)), lambda e: e["value"].isNotNull() & (F.trim(e["value"]) != ""))
    return F.array_join(F.transform(solid, lambda e: F.concat(e["key"], F.lit("="), e["value"])), " | ")


def col_or_map(df: DataFrame, column: str, overflow: str, *keys: str) -> Column:
    """The column if it has a value, else the first key of the map that has one."""
    own = [F.nullif(F.trim(F.col(column)), F.lit(""))] if column in df.columns else []
    return F.coalesce(*own, *[F.nullif(F.trim(F.try_element_at(F.col(overflow), F.lit(k))), F.lit("")) for k in keys])


def overflow_map(df: DataFrame, target: list[str], name: str = "overflow") -> DataFrame:
    """Columns outside `target` become entries of one map; null ones are left out."""
    rest = [c for c in df.columns if c not in target]
    pairs = [x for c in rest for x in (F.lit(c), F.col(c).cast("string"))]
    entries = F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull()) if pairs else F.expr("cast(map() as map<string,string>)")
    return df.select(*[c for c in df.columns if c in target], entries.alias(name))


def map_key_audit(df: DataFrame, overflow: str, target: list[str]) -> DataFrame:
    """Keys in the map that the target lacks, with their rows."""
    keys = df.select(F.explode(F.map_keys(overflow)).alias("key")).groupBy("key").agg(F.count("*").alias("n"))
    return keys.where(~F.col("key").isin(*target)) if target else keys
