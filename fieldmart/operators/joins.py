"""Joins: stars, lookups, bands, intervals, unique matches, and their complements.

Dimension sides are plain joins: Spark broadcasts a side when its measured size is under spark.sql.autoBroadcastJoinThreshold
and shuffles on the keys beyond it, so nothing here assumes that a dimension stays small.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fieldmart.operators.numbering import numbered


def star_join(fact: DataFrame, dims: Sequence[tuple[DataFrame, str, str]], how: str = "inner") -> DataFrame:
    """fact joined to each (dimension, fact key, dimension key)."""
    for dim, fk, pk in dims:
        fact = fact.join(dim, fact[fk] == dim[pk], how)
    return fact


def left_join_where(left: DataFrame, right: DataFrame, on: Sequence[str], right_filter: Column) -> DataFrame:
    return left.join(right.where(right_filter), list(on), "left")


def current_only(dim: DataFrame, flag: str = "is_current") -> DataFrame:
    return dim.where(F.col(flag))


def lookup_id(df: DataFrame, dim: DataFrame, value: Column, key: str = "key", id_: str = "id", order: str = "id", default: int | None = None, name: str = "found_id") -> DataFrame:
    """First id (by order) of the normalised key; misses get the default."""
    firsts = dim.groupBy(F.lower(F.trim(key)).alias("_key")).agg(F.min_by(id_, order).alias("_id"))
    joined = df.withColumn("_value", F.lower(F.trim(value))).join(firsts, F.col("_value") == F.col("_key"), "left")
    return joined.select(*df.columns, (F.col("_id") if default is None else F.coalesce("_id", F.lit(default))).alias(name))


def lookup_alias(df: DataFrame, dim: DataFrame, value: Column, aliases: Mapping[str, str], **kw: str) -> DataFrame:
    """As lookup_id; a key without an id is tried again under its alias."""
    direct = lookup_id(df.withColumn("_text", F.lower(F.trim(value))), dim, F.col("_text"), name="_direct", **kw)
    table = F.create_map(*[F.lit(x) for pair in aliases.items() for x in pair])
    again = lookup_id(direct, dim, F.try_element_at(table, F.col("_text")), name="_again", **kw)
    return again.select(*df.columns, F.coalesce("_direct", "_again").alias("found_id"))


def band_join(df: DataFrame, rules: DataFrame, key: str, value: str, lo: str, hi: str, priority: str, id_: str, out: str = "rule_id", step: int = 16) -> DataFrame:
    """Rule of the lowest priority (then lowest bound and id) whose key is equal and whose band holds the value.

    Bands are cut into cells of `step` values, so that the join is an equality on key and cell, not a scan of all bands.
    Each distinct (key, value) is asked once and joined back, so repeated rows stay as they are.
    """
    cells = rules.select(F.col(key).alias("_k"), F.explode(F.sequence(F.floor(F.col(lo) / step), F.floor(F.col(hi) / step))).alias("_cell"), F.col(lo).alias("_lo"), F.col(hi).alias("_hi"), F.struct(F.col(priority).alias("p"), F.col(lo).alias("l"), F.col(id_).alias("i")).alias("_rank"))
    asked = df.select(F.col(key).alias("_key"), F.col(value).alias("_value")).distinct()
    hits = asked.join(cells, (F.col("_key") == F.col("_k")) & (F.floor(F.col("_value") / step) == F.col("_cell")) & F.col("_value").between(F.col("_lo"), F.col("_hi")))
    best = hits.groupBy("_key", "_value").agg(F.min("_rank").alias("_rank"))
    return df.join(best, (F.col(key) == F.col("_key")) & (F.col(value) == F.col("_value")), "left").select(*[df[c] for c in df.columns], F.col("_rank")["i"].alias(out))


_FAN, _LEVELS, _CHUNK = 8, 14, 5
"""Nodes of _FAN ** level places, for up to 8 ** 14 rows and edges; nodes of level _CHUNK and above hold whole chunks."""


def _nodes(level: int) -> str:
    """Numbers of the level's nodes that lie within places _lo to _hi - 1 while the next level's node around them doesn't."""
    size, up = _FAN**level, _FAN ** (level + 1)
    low, high, left, right = f"(_lo + {size - 1}L) div {size}L", f"_hi div {size}L", f"(_lo + {up - 1}L) div {up}L * {_FAN}L", f"_hi div {up}L * {_FAN}L"
    steps = lambda a, b: f"if({a} < {b}, sequence({a}, {b} - 1L), cast(array() as array<bigint>))"
    return f"if({left} < {right}, concat({steps(low, left)}, {steps(right, high)}), {steps(low, high)})"


def asof_interval(df: DataFrame, ranges: DataFrame, keys: Sequence[str], date: str, start: str, end: str, id_: str, out: str = "range_id") -> DataFrame:
    """Id of the newest range (start <= date <= end, open end) of the same keys, also where a newer one has ended by then.

    Rows and the ends of ranges are put in order of key and time, and numbered through, by quantiles of both: a key with
    any share of the rows is dealt to as many tasks as its rows ask for. A range is then a run of places. Runs are cut into
    nodes of a tree over the places, each node keeps its newest range. Chunks of places are solved apart: nodes within a
    chunk by a running state, and what larger nodes hold is carried into every chunk that they cover, one range for each.
    The work does not grow with the number of ranges that a key has times its rows, and no key is in one task.
    """
    names = [f"k_{k}" for k in keys]
    key = [F.col(k).alias(n) for k, n in zip(keys, names, strict=True)]
    edges = F.array(F.struct(F.lit(False).alias("_last"), F.col(start).alias("_at"), F.lit(0).alias("_kind")), F.struct(F.col(end).isNull().alias("_last"), F.col(end).alias("_at"), F.lit(2).alias("_kind")))
    held = ranges.where(" and ".join(f"`{c}` is not null" for c in [*keys, start])).select(*key, F.struct(F.col(start).alias("s"), F.col(end).isNull().alias("o"), F.col(end).alias("e"), F.col(id_).alias("i")).alias("_range"), F.inline(edges), F.lit(0).cast("long").alias("_salt"))
    asked = df.select(*key, F.lit(None).cast(held.schema["_range"].dataType).alias("_range"), F.lit(False).alias("_last"), F.col(date).alias("_at"), F.lit(1).alias("_kind"), F.monotonically_increasing_id().alias("_salt"), F.struct(*df.columns).alias("_row"))
    both = held.withColumn("_row", F.lit(None).cast(asked.schema["_row"].dataType)).unionByName(asked)
    placed = numbered(both, [*names, "_last", "_at", "_kind", "_salt"], "_place")
    runs = placed.where("_kind <> 1").groupBy(*names, "_range").agg(F.max(F.when(F.col("_kind") == 0, F.col("_place") + 1)).alias("_lo"), F.max(F.when(F.col("_kind") == 2, F.col("_place"))).alias("_hi"))
    cut = runs.where("_lo < _hi").select("_range", F.posexplode(F.array(*[F.expr(_nodes(level)) for level in range(_LEVELS)])).alias("_level", "_of"))
    nodes = cut.select("_range", "_level", F.explode("_of").alias("_node")).groupBy("_level", "_node").agg(F.max("_range").alias("_range"))

    below = F.element_at(F.array(*[F.lit(_FAN ** max(0, level - _CHUNK)) for level in range(_LEVELS)]).cast("array<bigint>"), F.col("_level") + 1)
    covered = F.sequence(F.col("_node") * below, (F.col("_node") + 1) * below - 1)
    carried = nodes.where(F.col("_level") >= _CHUNK).select("_range", F.explode(covered).alias("_of")).groupBy("_of").agg(F.max("_range").alias("_over"))
    size = F.element_at(F.array(*[F.lit(_FAN**level) for level in range(_CHUNK)]).cast("array<bigint>"), F.col("_level") + 1)
    begun = nodes.where(F.col("_level") < _CHUNK).select((F.col("_node") * size).alias("_place"), F.lit(0).alias("_kind"), "_level", F.struct(((F.col("_node") + 1) * size).alias("end"), F.col("_range").alias("range")).alias("_begun"))
    steps = begun.unionByName(placed.where("_kind = 1").select("_place", "_kind", "_row"), allowMissingColumns=True).withColumn("_chunk", F.expr(f"_place div {_FAN**_CHUNK}L"))
    line = W.partitionBy("_chunk").orderBy("_place", "_kind").rowsBetween(W.unboundedPreceding, W.currentRow)
    last = [F.last(F.when(F.col("_level") == level, F.col("_begun")), ignorenulls=True).over(line).alias(f"_last_{level}") for level in range(_CHUNK)]
    solved = steps.select("_chunk", "_place", "_kind", "_row", *last).where("_kind = 1").join(carried.withColumnRenamed("_of", "_chunk"), "_chunk", "left")
    newest = F.greatest("_over", *[F.when(F.col("_place") < F.col(f"_last_{level}")["end"], F.col(f"_last_{level}")["range"]) for level in range(_CHUNK)])
    return solved.select("_row.*", newest["i"].alias(out))


def unique_match(df: DataFrame, dim: DataFrame, on: Mapping[str, str], id_: str) -> DataFrame:
    """match_state NOT_FOUND, UNIQUE or AMBIGUOUS, and the id if unique, for df columns matched to dim columns."""
    counted = dim.groupBy(*[F.col(d).alias(f"_dim_{d}") for d in on.values()]).agg(F.count("*").alias("_matches"), F.min(id_).alias("_match"))
    condition = [df[a].eqNullSafe(counted[f"_dim_{d}"]) for a, d in on.items()]
    joined = df.join(counted, condition, "left")
    state = F.when(F.col("_matches").isNull(), "NOT_FOUND").when(F.col("_matches") == 1, "UNIQUE").otherwise("AMBIGUOUS")
    return joined.select(*[df[c] for c in df.columns], state.alias("match_state"), F.when(F.col("_matches") == 1, F.col("_match")).alias("match_id"))


def _on(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> list[Column]:
    return [a[k].eqNullSafe(b[k]) for k in keys]


def insert_new(batch: DataFrame, target: DataFrame, grain: Sequence[str]) -> DataFrame:
    """Rows whose grain the target lacks; NULL keys are equal to each other."""
    known = target.select(*grain).distinct()
    return batch.join(known, _on(batch, known, grain), "left_anti")


def external_duplicates(batch: DataFrame, target: DataFrame, grain: Sequence[str]) -> DataFrame:
    known = target.select(*grain).distinct()
    return batch.join(known, _on(batch, known, grain), "left_semi")


def orphans(fact: DataFrame, dim: DataFrame, fk: str, pk: str) -> DataFrame:
    keys = dim.select(F.col(pk).alias("_pk"))
    return fact.where(F.col(fk).isNotNull()).join(keys, F.col(fk) == F.col("_pk"), "left_anti")


def coverage_gap(raw: DataFrame, dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key combinations of raw that dim lacks, with their rows."""
    return insert_new(raw.groupBy(*keys).agg(F.count("*").alias("n")), dim, keys)


def mark_state(raw: DataFrame, ids: DataFrame, id_: str, state_column: str, state: str) -> DataFrame:
    """raw with the state set where its id is in ids."""
    marked = ids.select(F.col(id_).alias("_id")).distinct().withColumn("_hit", F.lit(True))
    return raw.join(marked, raw[id_] == marked["_id"], "left").select(*[F.when(F.col("_hit"), F.lit(state)).otherwise(raw[c]).alias(c) if c == state_column else raw[c] for c in raw.columns])


def mark_by_signature(raw: DataFrame, signatures: DataFrame, columns: Sequence[str], order: Sequence[str], state_column: str, state: str) -> DataFrame:
    """For rows without an id: the k-th row of a signature takes the state of the k-th mark of it, null-safe."""
    number = lambda df, by: df.withColumn("_nth", F.row_number().over(W.partitionBy(*columns).orderBy(*by)))
    rows, marks = number(raw, order), number(signatures.select(*columns), columns).withColumn("_hit", F.lit(True))
    joined = rows.join(marks, [rows[c].eqNullSafe(marks[c]) for c in [*columns, "_nth"]], "left")
    return joined.select(*[F.when(F.col("_hit"), F.lit(state)).otherwise(rows[c]).alias(c) if c == state_column else rows[c] for c in raw.columns])


def flat_hierarchy(leaf: DataFrame, levels: Sequence[tuple[DataFrame, str, str]]) -> DataFrame:
    """leaf joined upwards through its levels (inner)."""
    return star_join(leaf, levels)


def role_join(fact: DataFrame, dim: DataFrame, pk: str, name: str, roles: Mapping[str, str]) -> DataFrame:
    """One dimension looked up several times: fact column -> output column."""
    for fk, out in roles.items():
        side = dim.select(F.col(pk).alias(f"_{out}"), F.col(name).alias(out))
        fact = fact.join(side, fact[fk] == side[f"_{out}"], "left").drop(f"_{out}")
    return fact
