"""Row and column shaping: filters by tokens, labels, defaults, missing columns, pages, un-pivoting."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def drop_non_operational(df: DataFrame, tokens: Mapping[str, Sequence[str]]) -> tuple[DataFrame, DataFrame]:
    """(kept, discarded): a row goes if a column's trimmed upper-case text is one of its tokens (NULL counts as '')."""
    hit = reduce(lambda a, b: a | b, [F.coalesce(F.upper(F.trim(c)), F.lit("")).isin(*values) for c, values in tokens.items()])
    return df.where(~hit), df.where(hit)


def classify(cases: Sequence[tuple[Column, str]], default: str | None = None) -> Column:
    """Label of the first condition that holds."""
    out = F.when(cases[0][0], cases[0][1])
    for condition, label in cases[1:]:
        out = out.when(condition, label)
    return out.otherwise(F.lit(default))


def default_where_blank(df: DataFrame, column: str, value: object) -> DataFrame:
    return df.withColumn(column, F.coalesce(F.nullif(F.trim(column), F.lit("")), F.lit(value)))


def select_or_null(df: DataFrame, columns: Sequence[str], dtype: str = "string") -> DataFrame:
    """The columns, with typed NULLs for those that df lacks."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast(dtype).alias(c) for c in columns])


def filter_if_present(df: DataFrame, column: str, value: object) -> DataFrame:
    return df.where(F.col(column) == F.lit(value)) if column in df.columns else df


def coalesce_duplicate_columns(df: DataFrame, groups: Mapping[str, Sequence[str]]) -> DataFrame:
    """One column for each group: the first value that isn't blank."""
    grouped = {c for columns in groups.values() for c in columns}
    merged = [F.coalesce(*[F.nullif(F.trim(F.col(c).cast("string")), F.lit("")) for c in columns]).alias(name) for name, columns in groups.items()]
    return df.select(*[c for c in df.columns if c not in grouped], *merged)


def to_text(df: DataFrame) -> DataFrame:
    return df.select(*[F.trim(F.col(c).cast("string")).alias(c) for c in df.columns])


def drop_empty_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop("all", subset=list(columns) if columns else None)


def unpivot_states(df: DataFrame, ids: Sequence[str], states: Mapping[str, str], name: str = "state", value: str = "n") -> DataFrame:
    """One row for each state column that has a value."""
    pairs = F.array(*[F.struct(F.lit(label).alias(name), F.col(c).alias(value)) for c, label in states.items()])
    return df.select(*ids, F.inline(F.filter(pairs, lambda x: x[value].isNotNull())))


def search(df: DataFrame, where: Column, order: Sequence[Column], page: int, size: int) -> tuple[DataFrame, DataFrame]:
    """(the page's rows, one row with the total)."""
    found = df.where(where)
    return found.orderBy(*order).offset((page - 1) * size).limit(size), found.agg(F.count("*").alias("total"))
