"""Master data: homologation of names, rule cascades, hierarchy resolution."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from fieldmart.functions import text
from fieldmart.operators.joins import band_join, insert_new, lookup_id, unique_match
from fieldmart.operators.numbering import numbered, ready_checkpoints

APPROVE = 0.85


def token_key(c: Column) -> Column:
    """Words of the match key in order, so that 'b a' and 'A B' are alike."""
    return F.array_join(F.array_sort(F.split(F.lower(text.match_key(c)), " ")), " ")


def similarity(a: Column, b: Column) -> Column:
    """1 - edit distance / longer length."""
    return 1 - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b), F.lit(1))


def common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence: one bit for each character of a, a word of them for each character of b."""
    places: dict[str, int] = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    row = whole = (1 << len(a)) - 1
    for y in b:
        hit = row & places.get(y, 0)
        row = (row + hit | row - hit) & whole
    return len(a) - row.bit_count()


@F.pandas_udf(DoubleType())
def indel_similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """1 - (insertions + deletions) / both lengths, over pairs of keys that aren't null; equal for two empty ones."""
    return pd.Series([2 * common_subsequence(x, y) / (len(x) + len(y)) if x or y else 1.0 for x, y in zip(a, b, strict=True)], dtype="float64")


@dataclass(frozen=True)
class Measure:
    """A similarity of two keys with its bounds at a threshold t: the shortest and longest partner, and what two keys share of their characters, over their lengths."""

    score: Callable[[Column, Column], Column]
    shorter: Callable[[Column], Column]
    """A partner's length over the longer one's."""
    missing: Callable[[float], float]
    """Share of a key's characters that a partner may lack."""
    shares: Callable[[Column, Column, Column, Column], Column]


EDIT = Measure(similarity, lambda t: t, lambda t: 1 - t, lambda n, a, b, t: n >= t * F.greatest(a, b) - 1e-9)
INDEL = Measure(indel_similarity, lambda t: t / (2 - t), lambda t: (2 - 2 * t) / (2 - t), lambda n, a, b, t: 2 * n >= t * (a + b) - 1e-9)
MEASURES = {"edit": EDIT, "indel": INDEL}


PENDING_APPROVAL = "PENDIENTE"


def approved(dictionary: DataFrame, source: str) -> DataFrame:
    """raw, canonical and both keys of a source's approved entries; pending ones and those of other sources don't count."""
    own = dictionary.where((F.col("source_table") == source) & F.col("approved_by").isNotNull() & (F.col("approved_by") != PENDING_APPROVAL))
    return own.select("raw", "canonical", text.match_key(F.col("raw")).alias("key"), text.compact_key(F.col("raw")).alias("compact"))


def match_exact(values: DataFrame, ref: DataFrame, value: str, canonical: str) -> DataFrame:
    """values (one column) with `found`: canonical of the equal key, else of the equal compact key, each only if it is unique."""

    def unique(key: Column, name: str) -> DataFrame:
        grouped = ref.groupBy(key.alias(f"_ref_{name}")).agg(F.min(canonical).alias(f"_by_{name}"), F.max(canonical).alias("_high"))
        return grouped.where(F.col(f"_by_{name}") == F.col("_high")).drop("_high")

    keyed = values.withColumns({"_k": text.match_key(F.col(value)), "_c": text.compact_key(F.col(value))})
    joined = keyed.join(unique(text.match_key(F.col(canonical)), "key"), F.col("_k") == F.col("_ref_key"), "left").join(unique(text.compact_key(F.col(canonical)), "compact"), F.col("_c") == F.col("_ref_compact"), "left")
    return joined.select(*values.columns, F.coalesce("_by_key", "_by_compact").alias("found"))


def _grams(key: Column, gram: int) -> Column:
    """The grams of a key, the k-th repetition of one told apart from the others."""
    runs = F.when(F.length(key) >= gram, F.transform(F.sequence(F.lit(1), F.length(key) - gram + 1), lambda i: key.substr(i, F.lit(gram)))).otherwise(F.array().cast("array<string>"))
    return F.transform(runs, lambda x, i: F.concat(x, F.size(F.filter(F.slice(runs, F.lit(1), i + 1), lambda y: y == x)).cast("string")))


def _rarest(keys: DataFrame, name: str, held: DataFrame, many: Column, gram: int) -> DataFrame:
    """(name, _g): the `many` grams of each key that are the rarest in the catalogue; a partner has to have one of them."""
    each = keys.select(name, "_k", F.explode(_grams(F.col("_k"), gram)).alias("_g")).join(held, "_g", "left")
    placed = each.groupBy(name, "_k").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("_held", F.lit(0)).alias("n"), F.col("_g").alias("g")))).alias("_all"))  # one name's own grams
    return placed.select(name, F.explode(F.slice("_all", F.lit(1), many.cast("int"))).alias("_one")).select(name, F.col("_one")["g"].alias("_g"))


def _prefixes(threshold: float, measure: Measure, gram: int) -> Column:
    """Grams of a key of which one is shared by every partner at the threshold.

    Of single characters, told apart by their repetition, a partner lacks a share that the measure bounds. Of longer grams:
    an edit changes at most `gram` of them, a partner is at most (1 - threshold) * m edits away, m at most length / threshold.
    """
    if gram == 1:
        return F.floor(F.lit(measure.missing(threshold)) * F.length("_k") + 1e-9) + 1
    return F.floor(F.lit(1 - threshold) * F.length("_k") / F.lit(threshold) + 1e-9) * gram + 1


def _pairs(values: DataFrame, names: DataFrame, value: str, canonical: str, threshold: float, measure: Measure, gram: int) -> DataFrame:
    """Pairs of values (value, _v) and names (canonical, _n) that have to be compared: all that may reach the threshold, and as few others as lengths and common characters tell."""
    left, right = values.withColumn("_k", F.col("_v")), names.withColumn("_k", F.col("_n"))
    held = right.select(F.explode(_grams(F.col("_k"), gram)).alias("_g")).groupBy("_g").agg(F.count("*").alias("_held"))
    many = _prefixes(threshold, measure, gram)
    met = _rarest(left, value, held, many, gram).join(_rarest(right, canonical, held, many, gram), "_g").select(value, canonical)
    met = met.unionByName(left.join(right.drop("_n"), "_k").select(value, canonical)).distinct()
    return _worth(met.join(values, value).join(names, canonical), threshold, measure).select(value, "_v", canonical, "_n")


def _worth(pairs: DataFrame, threshold: float, measure: Measure) -> DataFrame:
    """Pairs that may reach the threshold, and what the value has reached already (_best, where it has been compared before)."""
    a, b, t = F.length("_v"), F.length("_n"), F.greatest(F.lit(threshold), F.col("_best")) if "_best" in pairs.columns else F.lit(threshold)
    shared = F.size(F.array_intersect(_grams(F.col("_v"), 1), _grams(F.col("_n"), 1)))
    return pairs.where(F.least(a, b) >= measure.shorter(t) * F.greatest(a, b) - 1e-9).where(measure.shares(shared, a, b, t))


def _best_names(pairs: DataFrame, value: str, canonical: str, measure: Measure) -> DataFrame:
    """value, score, found: the name of the greatest similarity, of equal ones the smallest."""
    best = pairs.withColumn("_s", -measure.score(F.col("_v"), F.col("_n"))).groupBy(value).agg(F.min(F.struct(F.col("_s").alias("s"), F.col(canonical).alias("c"))).alias("_b"))
    return best.select(value, (-F.col("_b")["s"]).alias("score"), F.col("_b")["c"].alias("found"))


LEVELS = (0.85, 0.7, 0.55, 0.4, 0.25)
"""Thresholds that a search for names below the first one goes through."""


def match_fuzzy(values: DataFrame, catalogue: DataFrame, value: str, canonical: str, threshold: float = APPROVE, measure: str = "edit") -> DataFrame:
    """Best catalogue name (ties: smallest) with its score, NULL under the threshold. Distinct values only; measure: edit or indel.

    Values and names meet over their rarest grams, as many as the threshold asks for, or over equal keys, and are compared
    only where their lengths and common characters allow the threshold: no common gram brings all of them together, and no
    pair that reaches the threshold is missed. A lower threshold is reached by steps: values whose best name is settled at
    0.85 are done, the others go on to 0.7 and so on, each step written to the checkpoint folder, and are compared only with
    names that may be as good as their best so far. Only values that no name comes near at the last step meet every name of
    a fitting length, which a threshold of 0 asks for.
    """
    how = MEASURES[measure]
    distinct = values.select(value).distinct().withColumn("_v", token_key(F.col(value))).where("_v is not null")
    names = catalogue.select(canonical).distinct().withColumn("_n", token_key(F.col(canonical))).where("_n is not null")
    gram = 2 if how is EDIT else 1
    if threshold >= APPROVE:
        scored = _best_names(_pairs(distinct, names, value, canonical, threshold, how, gram), value, canonical, how).where(F.col("score") >= threshold)
    else:
        ready_checkpoints(values.sparkSession)
        open_, names, settled = distinct.checkpoint(), names.checkpoint(), []
        for level in [*(x for x in LEVELS if x > threshold), *([threshold] if threshold > 0.15 else [])]:
            best = _best_names(_pairs(open_, names, value, canonical, level, how, gram if level == APPROVE else 1), value, canonical, how).checkpoint()
            settled.append(best.where(F.col("score") >= level))
            left = open_.join(best.select(value, F.col("score").alias("_score")), value, "left").where(F.coalesce(F.col("_score") < level, F.lit(True)))
            open_ = left.select(value, "_v", F.greatest(F.coalesce("_score", F.lit(0.0)), F.col("_best") if "_best" in open_.columns else F.lit(0.0)).alias("_best")).checkpoint()
        if threshold <= 0.15:
            settled.append(_best_names(_worth(_all_fitting(open_, names), threshold, how), value, canonical, how).where(F.col("score") >= threshold))
        scored = reduce(DataFrame.unionByName, settled)
    return values.select(value).distinct().join(scored, value, "left").select(value, "found", "score")


def _all_fitting(open_: DataFrame, names: DataFrame) -> DataFrame:
    """Every name of a length that lets it be better than the value's best so far, met by equality on the length of its key."""
    longest = names.agg(F.max(F.length("_n")).alias("_longest"))
    low, high = F.floor(F.col("_best") / (2 - F.col("_best")) * F.length("_v")), F.ceil(F.length("_v") * (2 - F.col("_best")) / F.greatest("_best", F.lit(0.01)))
    sized = open_.crossJoin(longest).where("_longest is not null").withColumn("_size", F.explode(F.sequence(low.cast("int"), F.least(high, "_longest").cast("int"))))  # one row
    return sized.join(names.withColumn("_size", F.length("_n")), "_size").drop("_size", "_longest")


def suggest(values: DataFrame, catalogue: DataFrame, value: str, canonical: str, threshold: float = 0.0, measure: str = "edit") -> DataFrame:
    """The best name of the catalogue, even of a low score, else the value in title case without a score."""
    found = match_fuzzy(values, catalogue, value, canonical, threshold, measure)
    return found.select(value, F.coalesce("found", text.title(F.col(value))).alias("suggestion"), "score")


def homologate(df: DataFrame, column: str, dictionary: DataFrame, source: str, catalogue: DataFrame, canonical: str, threshold: float = APPROVE) -> DataFrame:
    """df with canonical name and state EXACTO (approved dictionary of the source), CATALOGO, LEVENSHTEIN, CUARENTENA or NULO.

    Each distinct value is resolved once: the inputs are read once each for a step, whose distinct values, names and
    entries are written to the checkpoint folder, and once more to join what was found back to the rows.
    """
    ready_checkpoints(df.sparkSession)
    values = df.select(F.col(column).alias("_value")).distinct().checkpoint()
    catalogue = catalogue.select(canonical).distinct().checkpoint()
    known = approved(dictionary, source).checkpoint()
    by_dictionary = known.groupBy(F.col("key").alias("_k")).agg(F.min("canonical").alias("_dict"), F.max("canonical").alias("_high")).where(F.col("_dict") == F.col("_high")).drop("_high")
    keyed = values.withColumn("_key", text.match_key(F.col("_value"))).join(by_dictionary, F.col("_key") == F.col("_k"), "left")
    exact = match_exact(keyed.select("_value", "_key", "_dict"), catalogue, "_value", canonical).withColumnRenamed("found", "_cat").checkpoint()
    open_ = exact.where("_dict is null and _cat is null and _key is not null")
    fuzzy = match_fuzzy(open_, catalogue, "_value", canonical, threshold).select(F.col("_value").alias("_fv"), F.col("found").alias("_fuzzy"), "score")
    state = F.when(F.col("_key").isNull(), "NULO").when(F.col("_dict").isNotNull(), "EXACTO").when(F.col("_cat").isNotNull(), "CATALOGO").when(F.col("_fuzzy").isNotNull(), "LEVENSHTEIN").otherwise("CUARENTENA")
    resolved = exact.join(fuzzy, F.col("_value") == F.col("_fv"), "left").select("_value", F.coalesce("_dict", "_cat", "_fuzzy").alias("canonical"), state.alias("match_state")).checkpoint()
    return df.join(resolved, df[column].eqNullSafe(resolved["_value"]), "left").drop("_value")


def dictionary_merge(dictionary: DataFrame, outcomes: DataFrame) -> DataFrame:
    """raw, canonical, approved, times_applied: approved outcomes overwrite, pending ones keep the first canonical; uses add up."""
    new = outcomes.groupBy("raw").agg(F.count("*").alias("_uses"), F.min(F.when(F.col("approved"), F.col("canonical"))).alias("_approved"), F.min("canonical").alias("_first"))
    both = dictionary.join(new, "raw", "full")
    return both.select("raw", F.coalesce("_approved", "canonical", "_first").alias("canonical"), (F.coalesce("approved", F.lit(False)) | F.col("_approved").isNotNull()).alias("approved"), (F.coalesce("times_applied", F.lit(0)) + F.coalesce("_uses", F.lit(0))).alias("times_applied"))


def resolve_module(df: DataFrame, rules: DataFrame, bands: DataFrame, module: str, shift: str, catalogue: DataFrame | None = None) -> DataFrame:
    """module_id by an exact rule (raw, module), else a band rule (raw, lo, hi, priority, module), else the number itself; test_block flag.

    With a catalogue (module) a number that it lacks is none: module_id is NULL, the source NOT_IN_CATALOGUE.
    """
    exact = rules.groupBy(F.lower(F.trim("raw")).alias("_raw")).agg(F.min("module").alias("_exact"))
    with_exact = df.withColumn("_m", F.lower(F.trim(module))).join(exact, F.col("_m") == F.col("_raw"), "left").drop("_raw")
    ranked = bands.select(F.lower(F.trim("raw")).alias("_m"), "lo", "hi", "priority", F.col("module").alias("_band"))
    with_band = band_join(with_exact, ranked, "_m", shift, "lo", "hi", "priority", "_band", "_by_band")
    number = text.last_number(F.col(module)).try_cast("int")
    source = F.when(F.col("_exact").isNotNull(), "RULE").when(F.col("_by_band").isNotNull(), "BAND").when(number.isNotNull(), "NUMBER").otherwise("NONE")
    out = with_band.select(*df.columns, F.coalesce("_exact", "_by_band", number).alias("module_id"), source.alias("module_source"), text.contains_any(F.col(module)).alias("test_block"))
    if catalogue is None:
        return out
    known = catalogue.select(F.col("module").alias("_known")).distinct()
    checked = out.join(known, F.col("module_id") == F.col("_known"), "left")
    strange = (F.col("module_source") == "NUMBER") & F.col("_known").isNull()
    return checked.select(*df.columns, F.when(~strange, F.col("module_id")).alias("module_id"), F.when(strange, "NOT_IN_CATALOGUE").otherwise(F.col("module_source")).alias("module_source"), "test_block")


def resolve_hierarchy(df: DataFrame, dim: DataFrame, on: dict[str, str], id_: str, optional: dict[str, str] | None = None) -> DataFrame:
    """Unique, ambiguous or missing member of a hierarchy for the given levels (df column -> dim column).

    An optional level (a farm, a sector) takes part only where df has a value other than 0: the dimension is counted for
    each set of levels that may be given, and a row asks for its own set, so every join is an equality.
    """
    if not optional:
        return unique_match(df, dim, on, id_)
    given = {a: F.coalesce(F.col(a).cast("string") != "0", F.lit(False)) for a in optional}
    names = list(optional)
    keyed = df.withColumn("_mask", sum((F.when(given[a], 1 << i).otherwise(0) for i, a in enumerate(names)), F.lit(0)))
    keyed = keyed.withColumns({f"_o{i}": F.when(given[a], F.col(a)) for i, a in enumerate(names)})
    sides = []
    for mask in range(1 << len(names)):
        levels = [F.col(optional[a]).alias(f"_d{i}") if mask >> i & 1 else F.lit(None).cast(dim.schema[optional[a]].dataType).alias(f"_d{i}") for i, a in enumerate(names)]
        sides.append(dim.select(*on.values(), *levels, F.lit(mask).alias("_dmask"), id_))
    every = reduce(DataFrame.unionByName, sides)
    found = unique_match(keyed, every, {**on, **{f"_o{i}": f"_d{i}" for i in range(len(names))}, "_mask": "_dmask"}, id_)
    return found.select(*df.columns, "match_state", "match_id")


def surrogate_keys(df: DataFrame, order: Sequence[str], start: int = 1, name: str = "id") -> DataFrame:
    """Dense ids in order, numbered in ranges side by side."""
    return numbered(df, order, name, start)


def autocreate(values: DataFrame, dim: DataFrame, key: Sequence[str], id_: str) -> DataFrame:
    """dim with new members for the key combinations that it lacks; ids go on after the largest."""
    new = insert_new(values.select(*key).distinct(), dim, key)
    top = dim.agg(F.coalesce(F.max(id_), F.lit(0)).alias("_top"))
    numbered = surrogate_keys(new, list(key), 1, "_n").crossJoin(top).select(*key, (F.col("_top") + F.col("_n")).alias(id_))
    return dim.select(*key, id_).unionByName(numbered)


def learn(df: DataFrame, learned: DataFrame, key: Sequence[str]) -> DataFrame:
    """Unknown combinations that the learning log doesn't hold yet."""
    return insert_new(df.select(*key).distinct(), learned, key)


def _valve(c: Column) -> Column:
    """Digits without leading zeros, other texts trimmed, blank ones NULL."""
    token = F.nullif(F.trim(c.cast("string")), F.lit(""))
    return F.when(token.rlike("^[0-9]+$"), F.regexp_replace(token, "^0+(?=.)", "")).otherwise(token)


def resolve_states(df: DataFrame, dim: DataFrame, beds: DataFrame, bridge: DataFrame, low: int, high: int) -> DataFrame:
    """df (module, submodule, shift, valve, bed, test_block) with geo_id and geo_state.

    dim (id, module, submodule, shift, valve, test_block) has the current places, beds (bed) the catalogue, bridge (id, bed)
    the current relations. Test blocks are found by shift and valve, all others by module, submodule (NULL is equal to NULL),
    shift and valve; then the bed is judged. The states, in the order in which they are tried:
    CLAVE_GEOGRAFICA_INCOMPLETA, RESUELTA_TEST_BLOCK, TEST_BLOCK_NO_MAPEADO, TEST_BLOCK_AMBIGUO for test blocks;
    CASO_ESPECIAL_MODULO, CLAVE_GEOGRAFICA_INCOMPLETA, GEOGRAFIA_NO_ENCONTRADA, GEOGRAFIA_AMBIGUA, RESUELTA_BASE_SIN_CAMA,
    CAMA_NO_VALIDA, CAMA_NO_CATALOGO, CAMA_NO_RELACION, RESUELTA_BASE_Y_CAMA for the rest.
    """
    rows = df.withColumns({"_valve": _valve(F.col("valve")), "_bed": F.col("bed").cast("string").try_cast("int"), "_token": F.nullif(F.trim(F.col("bed").cast("string")), F.lit("")), "_test": F.coalesce("test_block", F.lit(False))})
    places = dim.select("id", "module", "submodule", "shift", _valve(F.col("valve")).alias("_dvalve"), F.coalesce("test_block", F.lit(False)).alias("_dtest"))
    base = places.where("not _dtest").groupBy(F.col("module").alias("_m"), F.col("submodule").alias("_s"), F.col("shift").alias("_t"), F.col("_dvalve").alias("_v")).agg(F.count("*").alias("_n"), F.min("id").alias("_id"))
    test = places.where("_dtest").groupBy(F.col("shift").alias("_tt"), F.col("_dvalve").alias("_tv")).agg(F.count("*").alias("_tn"), F.min("id").alias("_tid"))
    joined = rows.join(base, ~F.col("_test") & (F.col("module") == F.col("_m")) & F.col("submodule").eqNullSafe(F.col("_s")) & (F.col("shift") == F.col("_t")) & (F.col("_valve") == F.col("_v")), "left")
    joined = joined.join(test, F.col("_test") & (F.col("shift") == F.col("_tt")) & (F.col("_valve") == F.col("_tv")), "left")
    joined = joined.join(beds.select(F.col("bed").alias("_cbed")).distinct(), F.col("_bed") == F.col("_cbed"), "left")
    joined = joined.join(bridge.select(F.col("id").alias("_bid"), F.col("bed").alias("_bbed")).distinct(), (F.col("_n") == 1) & (F.col("_id") == F.col("_bid")) & (F.col("_bed") == F.col("_bbed")), "left")
    incomplete = F.col("shift").isNull() | F.col("_valve").isNull()
    of_test = F.when(incomplete, "CLAVE_GEOGRAFICA_INCOMPLETA").when(F.col("_tn") == 1, "RESUELTA_TEST_BLOCK").when(F.col("_tn").isNull(), "TEST_BLOCK_NO_MAPEADO").otherwise("TEST_BLOCK_AMBIGUO")
    of_base = (
        F.when(F.col("module").isNull(), "CASO_ESPECIAL_MODULO").when(incomplete, "CLAVE_GEOGRAFICA_INCOMPLETA").when(F.col("_n").isNull(), "GEOGRAFIA_NO_ENCONTRADA").when(F.col("_n") > 1, "GEOGRAFIA_AMBIGUA")
        .when(F.col("_token").isNull() | (F.col("_token") == "0"), "RESUELTA_BASE_SIN_CAMA").when(F.col("_bed").isNull() | ~F.col("_bed").between(low, high), "CAMA_NO_VALIDA")
        .when(F.col("_cbed").isNull(), "CAMA_NO_CATALOGO").when(F.col("_bid").isNull(), "CAMA_NO_RELACION").otherwise("RESUELTA_BASE_Y_CAMA")
    )
    found = F.when(F.col("_test") & (F.col("_tn") == 1), F.col("_tid")).when(~F.col("_test") & (F.col("_n") == 1), F.col("_id"))
    return joined.select(*df.columns, F.when(F.col("_test"), of_test).otherwise(of_base).alias("geo_state"), found.alias("geo_id"))


def bridge_upsert(raw: DataFrame, dim: DataFrame, bridge: DataFrame, on: dict[str, str], bed: str, low: int, high: int) -> tuple[DataFrame, DataFrame]:
    """(new bridge rows, histogram of states) for beds of raw rows: resolved uniquely, within bounds and not related yet."""
    found = unique_match(raw.select(*on, bed).distinct(), dim, on, "id")
    state = F.when(F.col("match_state") != "UNIQUE", F.col("match_state")).when(F.col(bed).isNull() | ~F.col(bed).between(low, high), "BED_INVALID").otherwise("APT")
    judged = found.withColumn("state", state)
    apt = judged.where("state = 'APT'").select(F.col("match_id").alias("id"), F.col(bed).alias("bed")).distinct()
    return insert_new(apt, bridge, ["id", "bed"]), judged.groupBy("state").agg(F.count("*").alias("n"))


def bridge_quality(bridge: DataFrame, max_bed: int, max_per_geo: int) -> DataFrame:
    """One row: rows, beds out of rule, places with more beds than allowed, status."""
    rows = bridge.agg(F.count("*").alias("rows"), F.count_if(~F.col("bed").between(1, max_bed)).alias("out_of_rule"))
    full = bridge.groupBy("id").agg(F.count("*").alias("n")).where(F.col("n") > max_per_geo).agg(F.count("*").alias("saturated"))
    status = F.when(F.col("out_of_rule") > 0, "ERROR").when(F.col("saturated") > 0, "WARNING").otherwise("OK")
    return rows.crossJoin(full).select("rows", "out_of_rule", "saturated", status.alias("status"))


def propose_missing(raw: DataFrame, dim: DataFrame, catalogue: DataFrame, key: Sequence[str], defaults: dict[str, object]) -> DataFrame:
    """Combinations that neither dim nor catalogue has, with default parents."""
    return insert_new(insert_new(raw.select(*key).distinct(), dim, key), catalogue, key).withColumns({k: F.lit(v) for k, v in defaults.items()})


def normalise_geo(src: DataFrame, rules: DataFrame, module: str) -> DataFrame:
    """src with the module of its rule where one exists; test blocks get -1."""
    r = rules.select(F.lower(F.trim("raw")).alias("_raw"), F.col("module").alias("_rule"))
    joined = src.withColumn("_m", F.lower(F.trim(module))).join(r, F.col("_m") == F.col("_raw"), "left")
    out = F.when(text.contains_any(F.col(module)), -1).otherwise(F.coalesce("_rule", text.last_number(F.col(module)).try_cast("int")))
    return joined.select(*src.columns, out.alias("module_id"))


__all__ = ["approved", "autocreate", "bridge_quality", "bridge_upsert", "dictionary_merge", "homologate", "learn", "lookup_id", "indel_similarity", "match_exact", "match_fuzzy", "normalise_geo", "propose_missing", "resolve_hierarchy", "resolve_module", "resolve_states", "similarity", "suggest", "surrogate_keys", "token_key"]
