"""Set operations, sorts, limits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def layer_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, rows) of each table."""
    return reduce(DataFrame.unionByName, [df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "rows") for name, df in tables.items()])


def compare_counts(before: DataFrame, after: DataFrame) -> DataFrame:
    a, b = before.withColumnRenamed("rows", "before"), after.withColumnRenamed("rows", "after")
    both = a.join(b, "table_name", "full")
    return both.select("table_name", "before", "after", (F.coalesce("after", F.lit(0)) - F.coalesce("before", F.lit(0))).alias("change"))


def catalogue_union(a: DataFrame, b: DataFrame, key: Column) -> DataFrame:
    """Distinct members of both; the smallest spelling of each key stays."""
    return a.unionByName(b).groupBy(key.alias("key")).agg(*[F.min(c).alias(c) for c in a.columns])


def union_sources(frames: Sequence[DataFrame], fill: Mapping[str, object] | None = None) -> DataFrame:
    """Rows of all sources; columns that a source lacks are NULL, or `fill`."""
    out = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), frames)
    return out.na.fill(dict(fill)) if fill else out


def column_diff(a: Column, b: Column) -> tuple[Column, Column]:
    """(missing from a, in both) of two arrays of names."""
    return F.array_except(b, a), F.array_intersect(a, b)


def sort_by(df: DataFrame, order: Sequence[tuple[str, bool]]) -> DataFrame:
    return df.orderBy(*[F.col(c).asc() if up else F.col(c).desc() for c, up in order])


def top_n(df: DataFrame, order: Sequence[tuple[str, bool]], n: int) -> DataFrame:
    return sort_by(df, order).limit(n)


def min_support(df: DataFrame, n_col: str, n: int) -> DataFrame:
    return df.where(F.col(n_col) >= n)
