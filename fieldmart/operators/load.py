"""Loads: insert-new and latest-wins merges on a declared grain, with counters."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fieldmart.operators.dedup import dedup_first, dedup_latest
from fieldmart.operators.joins import _on, external_duplicates, insert_new

TRACKING = ("source_row_id", "id_origen_rastreo")


@dataclass(frozen=True)
class FactSpec:
    """How a fact is loaded: its grain, the order of its rows, and the time that decides between equal keys (None: first wins)."""

    name: str
    grain: tuple[str, ...]
    seq: tuple[str, ...]
    tie_break: str | None = None
    marts: tuple[str, ...] = field(default_factory=tuple)

    def __post_init__(self) -> None:
        if not self.grain:
            raise ValueError(f"{self.name}: the grain has no column")


@dataclass(frozen=True)
class Loaded:
    rows: DataFrame
    """What the target holds afterwards."""
    inserted: DataFrame
    rejects: DataFrame
    external: DataFrame


def sink_columns(df: DataFrame) -> DataFrame:
    """Without tracking columns and auxiliary ones (*_virtual)."""
    return df.select(*[c for c in df.columns if c not in TRACKING and not c.lower().endswith("_virtual") and not c.startswith("_")])


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns are missing: {', '.join(missing)}")
    return df


def load_insert_new(batch: DataFrame, target: DataFrame, spec: FactSpec) -> Loaded:
    """First (or latest) of each grain in the batch, less what the target has already."""
    require_columns(batch, spec.grain)
    if spec.tie_break:
        kept, rejects = dedup_latest(batch, spec.grain, spec.tie_break, spec.seq), batch.limit(0)
    else:
        kept, rejects = dedup_first(batch, spec.grain, spec.seq)
    new = sink_columns(insert_new(kept, target, spec.grain))
    return Loaded(target.unionByName(new, allowMissingColumns=True), new, rejects, external_duplicates(kept, target, spec.grain))


def load_merge_latest(batch: DataFrame, target: DataFrame, spec: FactSpec) -> DataFrame:
    """Target after the merge: missing rows come in, stored ones give way to a later tie-break; `action` tells what happened."""
    kept = dedup_latest(batch, spec.grain, spec.tie_break, spec.seq)
    side = lambda df, n: df.select(*[F.col(c).alias(f"_{n}_{c}") for c in df.columns], F.lit(True).alias(f"_{n}"))
    columns = [c for c in target.columns]
    a, b = side(target, "t"), side(kept.select(*columns), "b")
    both = a.join(b, reduce(lambda x, y: x & y, [a[f"_t_{k}"].eqNullSafe(b[f"_b_{k}"]) for k in spec.grain]), "full")
    later = F.col("_b") & (F.col("_t").isNull() | F.coalesce(F.col(f"_b_{spec.tie_break}") > F.col(f"_t_{spec.tie_break}"), F.col(f"_b_{spec.tie_break}").isNotNull()))
    later = F.coalesce(later, F.lit(False))
    action = F.when(F.col("_t").isNull(), "inserted").when(later, "updated").otherwise("kept")
    return both.select(*[F.when(later, F.col(f"_b_{c}")).otherwise(F.col(f"_t_{c}")).alias(c) for c in columns], action.alias("action"))


def merge_upsert(target: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of new replace those of target with the same key; others stay. NULL keys are equal to each other."""
    stay = insert_new(target, new, key)
    return stay.select(*target.columns, F.lit("kept").alias("action")).unionByName(new.select(*target.columns).withColumn("action", F.lit("merged")))


def fact_result(read: DataFrame, rejects: DataFrame, keys: Sequence[str], row_id: str, reason: str = "reason", most: int = 3) -> DataFrame:
    """rows_read, rows_rejected (distinct row ids), rate in percent and the `most` commonest reasons ("reason (n)"), for each key; NULL keys are equal.

    A rejected row without a reason counts as SIN_MOTIVO; of equally common reasons the smaller text comes first.
    """
    a = read.groupBy(*keys).agg(F.count("*").alias("rows_read"))
    b = rejects.groupBy(*keys).agg(F.countDistinct(row_id).alias("_rejected"))
    named = rejects.groupBy(*keys, F.coalesce(F.nullif(F.trim(reason), F.lit("")), F.lit("SIN_MOTIVO")).alias("_reason")).agg(F.count("*").alias("_n"))
    first = named.withColumn("_place", F.row_number().over(W.partitionBy(*keys).orderBy(F.desc("_n"), "_reason"))).where(F.col("_place") <= most)  # one row for each reason
    told = F.transform(F.array_sort(F.collect_list(F.struct("_place", "_reason", "_n"))), lambda x: F.concat(x["_reason"], F.lit(" ("), x["_n"].cast("string"), F.lit(")")))
    c = first.groupBy(*keys).agg(F.array_join(told, ", ").alias("top_reasons"))
    rejected = F.coalesce("_rejected", F.lit(0))
    out = a
    for i, side in enumerate((b, c)):
        side = side.withColumnsRenamed({k: f"_{i}_{k}" for k in keys})
        out = out.join(side, reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_{i}_{k}")) for k in keys]), "left")
    return out.select(*keys, "rows_read", rejected.alias("rows_rejected"), (F.col("rows_read") - rejected).alias("rows_inserted"), F.round(rejected * 100 / F.col("rows_read"), 2).alias("rate"), F.coalesce("top_reasons", F.lit("")).alias("top_reasons"))


def rebuild(raw: DataFrame, state: Column, spec: FactSpec, build, empty: DataFrame) -> Loaded:
    """Directed rebuild: the raw rows of the state are reopened and loaded into an emptied target."""
    return load_insert_new(build(raw.where(state)), empty, spec)


def rebuild_plan(names: Sequence[str], registry: Mapping[str, FactSpec], marts: Sequence[str]) -> tuple[list[str], list[str]]:
    """(facts in registry order, marts that they feed, in the order of `marts`); an unknown fact is an error."""
    if unknown := set(names) - set(registry):
        raise ValueError(f"unknown facts: {', '.join(sorted(unknown))}")
    facts = [n for n in registry if n in names]
    fed = {m for n in facts for m in registry[n].marts}
    return facts, [m for m in marts if m in fed]


def rebuild_affected(names: Sequence[str], registry: Mapping[str, FactSpec], rebuilds: Mapping[str, Callable[[], DataFrame]], stored: Mapping[str, DataFrame], marts: Mapping[str, Callable[[Mapping[str, DataFrame]], DataFrame]]) -> dict[str, DataFrame]:
    """The marts that the named facts feed, made from the rebuilt facts and, for all others, from the stored ones; no other mart is touched."""
    facts, fed = rebuild_plan(names, registry, list(marts))
    whole = dict(stored) | {n: rebuilds[n]() for n in facts}
    return {m: marts[m](whole) for m in fed}


def purge_plan(tables: Mapping[str, tuple[str, DataFrame]], layers: Sequence[str]) -> DataFrame:
    """layer, table_name, rows_before, rows_after, purge: what emptying the layers would do to tables (name -> layer, rows)."""
    rows = [df.agg(F.count("*").alias("rows_before")).select(F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "rows_before", F.lit(layer in layers).alias("purge")) for name, (layer, df) in tables.items()]
    return reduce(DataFrame.unionByName, rows).withColumn("rows_after", F.when(F.col("purge"), F.lit(0)).otherwise(F.col("rows_before")).cast("long"))


def purge(tables: Mapping[str, tuple[str, DataFrame]], paths: Mapping[str, str], layers: Sequence[str], apply: bool = False) -> DataFrame:
    """The plan, from the counts before; with apply the tables of the layers are overwritten by empty ones."""
    plan = purge_plan(tables, layers)
    plan = plan.sparkSession.createDataFrame(plan.collect(), plan.schema)  # one row for each table
    for name, (layer, df) in tables.items():
        if apply and layer in layers:
            df.limit(0).write.mode("overwrite").parquet(paths[name])
    return plan


def gate(results: DataFrame, blocking: Sequence[str], name: str = "fact", ok: str = "ok") -> bool:
    """Whether marts may be published: no blocking fact failed."""
    return results.where(F.col(name).isin(*blocking) & ~F.col(ok)).isEmpty()


def refresh(registry: dict, names: Sequence[str] | None = None) -> dict:
    """Results of the selected mart builders, in registry order."""
    return {name: build() for name, build in registry.items() if names is None or name in names}


__all__ = ["FactSpec", "Loaded", "_on", "fact_result", "gate", "load_insert_new", "load_merge_latest", "merge_upsert", "purge", "purge_plan", "rebuild", "rebuild_affected", "rebuild_plan", "refresh", "require_columns", "sink_columns"]
