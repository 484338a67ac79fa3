"""De-duplication policies. Every policy has an explicit order, since rows of a distributed table have none."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

OLDEST = "1900-01-01"


def _ranked(df: DataFrame, grain: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    return df.withColumn("_rank", F.row_number().over(W.partitionBy(*grain).orderBy(*order)))


def rank_first(df: DataFrame, key: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    return _ranked(df, key, order).where("_rank = 1").drop("_rank")


latest_per_key = rank_first


def dedup_latest(df: DataFrame, grain: Sequence[str], ts: str, seq: Sequence[str]) -> DataFrame:
    """The latest timestamp wins; NULL counts as the oldest; of equal ones the first by seq stays. Losers are no rejects."""
    when = F.coalesce(F.col(ts), F.lit(OLDEST).cast(df.schema[ts].dataType))
    return rank_first(df, grain, [when.desc(), *seq])


def dedup_first(df: DataFrame, grain: Sequence[str], seq: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(kept, rejects): the first by seq stays; the others are rejected as DUPLICADO_INTERNO with their key as text."""
    ranked = _ranked(df, grain, seq)
    key = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in grain])
    rejects = ranked.where("_rank > 1").drop("_rank").withColumns({"key_text": key, "rule_type": F.lit("DUPLICADO_INTERNO"), "severity": F.lit("MEDIO")})
    return ranked.where("_rank = 1").drop("_rank"), rejects


def dedup_signature(df: DataFrame, key: Sequence[str], metrics: Sequence[str], seq: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(kept, rejects): groups whose metrics agree keep their first row; groups whose metrics differ go whole."""
    w = W.partitionBy(*key)
    signature = F.struct(*metrics)
    ranked = _ranked(df, key, seq).withColumn("_same", F.min(signature).over(w).eqNullSafe(F.max(signature).over(w)))
    return ranked.where("_same and _rank = 1").drop("_rank", "_same"), ranked.where("not _same").drop("_rank", "_same")


def predrop_duplicates(df: DataFrame, columns: Sequence[str], seq: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Early drop of technical duplicates on those of the columns that exist."""
    present = [c for c in columns if c in df.columns]
    if not present:
        return df, df.limit(0)
    ranked = _ranked(df, present, seq)
    return ranked.where("_rank = 1").drop("_rank"), ranked.where("_rank > 1").drop("_rank")
