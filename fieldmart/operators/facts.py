"""Fact pipelines: cleaning, resolution, reject cascade and grain, each fact as a definition over raw text tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldmart.functions import dates, numbers, text
from fieldmart.functions.bind import bind
from fieldmart.operators.aggregates import weighted_mean
from fieldmart.operators.dedup import dedup_first, dedup_latest, dedup_signature
from fieldmart.operators.joins import mark_by_signature
from fieldmart.operators.load import FactSpec
from fieldmart.operators.quality import first_failure
from fieldmart.sources import kv
from fieldmart.sources.raw import latest_batch

# fixed values
THIRDS = {"BAJO": "BAJO", "B": "BAJO", "LOW": "BAJO", "MEDIO": "MEDIO", "M": "MEDIO", "MID": "MEDIO", "ALTO": "ALTO", "A": "ALTO", "HIGH": "ALTO"}
NO_TYPE, NO_CONDITION = "SIN_TIPO", "SIN_CONDICION"

Check = tuple[Column, str, str, str, str]


@dataclass(frozen=True)
class Fact:
    """columns: name -> expression on raw; lookups: (dimension, key expression, output, default); expand: more rows from each cleaned one; derived: columns from what was found; checks run in order; domain names the season policy."""

    spec: FactSpec
    columns: Callable[[], Mapping[str, Column]]
    measures: Sequence[str]
    checks: Callable[[], Sequence[Check]] = tuple
    lookups: Sequence[tuple[str, str, str, int | None]] = field(default_factory=lambda: PLACE)
    prepare: Callable[[DataFrame], DataFrame] = lambda raw: raw
    domain: str | None = None
    derived: Callable[[], Mapping[str, Column]] = dict
    expand: Callable[[DataFrame], DataFrame] = lambda rows: rows
    date: str = "date_raw"


PLACE: tuple = (("geo", "module_key", "geo_id", None), ("variety", "variety_key", "variety_id", None))
PERSON = (*PLACE, ("person", "person_key", "person_id", -1))


def date_columns() -> dict[str, Column]:
    return {"day": dates.parse_datetime(F.col("date_raw"))}


def place_columns(module: str = "module_raw", variety: str = "variety_raw") -> dict[str, Column]:
    """Date, module key and variety key: what nearly every fact cleans first."""
    return date_columns() | {"module_key": text.last_number(F.col(module)), "variety_key": text.match_key(F.col(variety))}


def person_columns(module: str = "module_raw", variety: str = "variety_raw") -> dict[str, Column]:
    return place_columns(module, variety) | {"person_key": text.clean_id(F.col("person_raw"))}


def unknown(column: str, raw: str, what: str) -> Check:
    return (F.col(column).isNull(), raw, f"unknown {what}", "MDM", "ALTO")


def count_of(c: str | Column, least: int = 0) -> Column:
    return numbers.to_int(F.col(c) if isinstance(c, str) else c, 0, least)


def from_map(*names: str, overflow: str = "values_raw") -> Callable[[DataFrame], DataFrame]:
    """Columns from the overflow text where they are missing or blank."""

    def prepare(raw: DataFrame) -> DataFrame:
        df = (raw if overflow in raw.columns else raw.withColumn(overflow, F.lit(None).cast("string"))).withColumn("_map", kv.parse_kv(F.col(overflow)))
        return df.withColumns({n: kv.col_or_map(df, n, "_map", n) for n in names}).drop("_map")

    return prepare


def _fenced(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """df with the columns, each computed once a row: filters and projections above a generator don't repeat what is below it."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def build_fact(raw: DataFrame, dims: Mapping[str, DataFrame], fact: Fact, season: tuple[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows by grain, rejects). Dimensions have (key, id); their joins are plain, so Spark broadcasts them by measured size.

    With a season, dates outside of it are rejected, but for domains that are open. Of the columns `date_id` is made from `day`.
    """
    columns = dict(fact.columns())
    rows = fact.expand(_fenced(fact.prepare(raw), columns))
    if "day" in columns:
        rows = rows.withColumn("date_id", dates.date_id(F.col("day")))
    for i, (dim, key, out, default) in enumerate(fact.lookups):
        side = dims[dim].groupBy(F.col("key").alias(f"_k{i}")).agg(F.min("id").alias(f"_i{i}"))
        rows = rows.join(side, F.col(key) == F.col(f"_k{i}"), "left").drop(f"_k{i}").withColumn(out, F.col(f"_i{i}") if default is None else F.coalesce(f"_i{i}", F.lit(default))).drop(f"_i{i}")
    rows = rows.withColumns(dict(fact.derived())) if fact.derived() else rows
    checks: list[Check] = [(F.col("day").isNull(), fact.date, "invalid date", "DQ", "CRITICO")] if "day" in columns else []
    if season and "day" in columns:
        checks.append((~dates.in_season(F.col("day"), fact.domain, *season), fact.date, "out of season", "DQ", "CRITICO"))
    found = {out for _, _, out, _ in fact.lookups}
    checks += [unknown(c, r, w) for c, r, w in (("geo_id", "module_raw", "place"), ("variety_id", "variety_raw", "variety")) if c in found]
    kept, rejects = first_failure(rows, [*checks, *fact.checks()])
    if fact.spec.tie_break:
        unique = dedup_latest(kept, fact.spec.grain, fact.spec.tie_break, fact.spec.seq)
    else:
        unique, _ = dedup_first(kept, fact.spec.grain, fact.spec.seq)
    return unique.select(*fact.spec.grain, *fact.measures), rejects


_SEQ = ("seq_1", "seq_2", "seq_3", "seq_4")


def _spec(name: str, *extra: str, tie: str | None = None, marts: tuple[str, ...] = ()) -> FactSpec:
    return FactSpec(name, ("geo_id", "date_id", "variety_id", *extra), _SEQ, tie, marts)


def _whole(c: str) -> Column:
    """A count that isn't negative; NULL otherwise."""
    n = numbers.to_int(F.col(c))
    return F.when(n >= 0, n)


HARVEST = Fact(
    _spec("harvest", "condition", marts=("harvest",)),
    lambda: place_columns() | {"kg": numbers.to_decimal(F.col("kg_raw"), 3), "crates": count_of("crates_raw"), "condition": F.coalesce(text.nullish(F.col("condition_raw")), F.lit(NO_CONDITION)), "received": dates.parse_datetime(F.col("received_raw")).cast("date")},
    ("kg", "crates", "received"), lambda: [(F.col("kg").isNull() | (F.col("kg") < 0), "kg_raw", "invalid weight", "DQ", "ALTO")], prepare=from_map("received_raw"), domain="cosecha_sap",
)

# fixed values: evaluations that the count takes, and the states of its wide form
COUNT_TYPES = ("conteo", "fenolog")
COUNT_TYPE_EQUAL = "poda general"
WIDE_STATES = {"Botones_Florales_Raw": "Boton Floral", "Flores_Raw": "Flor", "Bayas_Pequenas_Raw": "Pequena", "Bayas_Grandes_Verdes_Raw": "Verde", "Fase1_Raw": "Inicio F1", "Fase2_Raw": "Inicio F2", "Bayas_Cremas_Raw": "Crema", "Bayas_Maduras_Raw": "Madura", "Bayas_Cosechables_Raw": "Cosechable"}


def _states(raw: DataFrame) -> DataFrame:
    """states: state_raw and organs_raw where both are filled, else a pair for each wide state of the overflow text; the point also comes from there."""
    parsed = raw.withColumn("_map", kv.parse_kv(F.col("values_raw")))
    solid = lambda c: F.coalesce(F.trim(c) != "", F.lit(False))
    pair = lambda state, organs: F.struct(state.alias("state_raw"), organs.alias("organs_raw"))
    wide = F.filter(F.array(*[F.when(F.array_contains(F.map_keys("_map"), k), pair(F.lit(label), F.try_element_at("_map", F.lit(k)))) for k, label in WIDE_STATES.items()]), lambda x: x.isNotNull())
    pairs = F.when(solid("state_raw") & solid("organs_raw"), F.array(pair(F.trim("state_raw"), F.col("organs_raw")))).otherwise(wide)
    point = F.coalesce(*[F.nullif(F.trim(F.try_element_at("_map", F.lit(k))), F.lit("")) for k in ("Punto_Raw", "Punto")], F.lit("0"))
    return parsed.select(*[c for c in raw.columns if c not in ("state_raw", "organs_raw")], point.alias("point"), pairs.alias("states"))


def _each_state(rows: DataFrame) -> DataFrame:
    each = rows.select(*[c for c in rows.columns if c != "states"], F.inline_outer("states"))
    return each.withColumns({"organs": count_of("organs_raw"), "state_key": text.state_key(F.col("state_raw"))})


def _count_type(c: Column) -> Column:
    return text.compatible_type(c, COUNT_TYPES) | (F.lower(text.state_key(c)) == COUNT_TYPE_EQUAL)


STATE_COUNTS = Fact(
    _spec("state_counts", "state_id", "point", tie="recorded", marts=("phenology",)),
    lambda: place_columns() | {"recorded": dates.parse_datetime(F.col("recorded_raw")), "countable": _count_type(F.col("type_raw"))},
    ("organs",), lambda: [(~F.col("countable"), "type_raw", "evaluation is no count", "DQ", "ALTO"), (F.col("state_raw").isNull(), "values_raw", "no states in the row", "DQ", "ALTO"), unknown("state_id", "state_raw", "state")],
    (*PLACE, ("state", "state_key", "state_id", None)), _states, "conteo_fenologico", expand=_each_state,
)

ORGAN = Fact(
    FactSpec("organ", ("geo_id", "date_id", "variety_id", "ribbon_id", "organ"), _SEQ, "recorded"),
    lambda: person_columns() | {"ribbon_key": F.lower(text.map_code(F.col("ribbon_raw"), RIBBONS)), "organ": numbers.extract_int(F.col("organ_raw")), "state_key": text.state_key(F.col("state_raw")), "state_code": numbers.extract_int(F.col("state_id_raw")), "recorded": F.coalesce(dates.parse_datetime(F.col("recorded_raw")), dates.parse_datetime(F.col("date_raw")))},
    ("state_id", "person_id", "recorded"),
    lambda: [(F.coalesce(F.col("organ") < 1, F.lit(True)), "organ_raw", "invalid organ", "DQ", "ALTO"), (F.col("state_id").isNull(), "state_raw", "unknown state", "CATALOGO", "ALTO"), unknown("ribbon_id", "ribbon_raw", "ribbon")],
    (*PERSON, ("state", "state_key", "state_by_text", None), ("ribbon", "ribbon_key", "ribbon_id", None)), from_map("date_raw", "module_raw", "variety_raw", "person_raw", "ribbon_raw", "organ_raw", "state_raw", "state_id_raw", "recorded_raw"), "maduracion",
    lambda: {"state_id": F.coalesce("state_by_text", F.when(F.col("state_code").between(0, 8), F.col("state_code")))},
)
# fixed values: masculine colours and the ribbon's names
RIBBONS = {"AMARILLO": "AMARILLA", "BLANCO": "BLANCA", "ROJO": "ROJA"}

SAMPLED = ("buds", "flowers", "small", "large", "phase_1", "phase_2", "cream", "ripe", "harvestable", "productive", "unproductive")
SAMPLING = Fact(
    _spec("sampling", "point"),
    lambda: person_columns() | {"samples": numbers.to_int(F.col("samples_raw")), "point": F.coalesce(numbers.to_int(F.col("point_raw")), F.lit(1))} | {c: count_of(f"{c}_raw") for c in SAMPLED},
    ("samples", "person_id", *SAMPLED), lambda: [(F.coalesce(F.col("samples") < 1, F.lit(True)), "samples_raw", "at least one sample", "DQ", "ALTO")], PERSON,
    from_map("date_raw", "module_raw", "variety_raw", "person_raw", "samples_raw", "point_raw", *[f"{c}_raw" for c in SAMPLED]), "peladas",
)

# (count, weight) columns of the categories; one has no weight
WEIGHED = (("small_raw", "small_weight_raw"), ("large_raw", None), ("phase_1_raw", "phase_1_weight_raw"), ("phase_2_raw", "phase_2_weight_raw"), ("cream_raw", "cream_weight_raw"), ("ripe_raw", "ripe_weight_raw"), ("harvestable_raw", "harvestable_weight_raw"))


def _weighed(raw: DataFrame) -> DataFrame:
    """Mean weight from the categories or given directly; the module from the valve where it is blank; every column that a source lacks is NULL."""
    names = {c for pair in WEIGHED for c in pair if c} | {"weight_raw", "samples_raw", "module_raw", "valve_raw"}
    whole = raw.withColumns({c: F.lit(None).cast("string") for c in sorted(names) if c not in raw.columns})
    counted = sum((count_of(c) for c, _ in WEIGHED), F.lit(0))
    with_mean = weighted_mean(whole, WEIGHED, ("weight_raw", "samples_raw"), out="weight")
    return with_mean.withColumns({"place_raw": F.coalesce(text.nullish(F.col("module_raw")), F.col("valve_raw")), "samples": bind(counted, lambda n: F.when(n > 0, n).otherwise(count_of("samples_raw")))})


WEIGHTS = Fact(
    _spec("weights", "person_id", marts=("weights",)), lambda: person_columns("place_raw"), ("weight", "samples"),
    lambda: [(F.col("weight").isNull(), "weight_raw", "no mean weight", "DQ", "MEDIO"), (~F.col("weight").between(0.5, 8.0), "weight_raw", "weight out of range", "DQ", "CRITICO")], PERSON, _weighed, "evaluacion_pesos",
)

PHYSIOLOGICAL = ("vegetative", "swollen", "productive", "total")
PHYSIOLOGY = Fact(
    _spec("physiology", "third"),
    lambda: place_columns() | {"third": text.map_code(F.col("third_raw"), THIRDS), "shoots": F.coalesce(numbers.to_int(F.col("shoots_prod_raw")), numbers.to_int(F.col("shoots_raw")))} | {c: numbers.to_int(F.col(f"{c}_raw")) for c in PHYSIOLOGICAL},
    ("shoots", *PHYSIOLOGICAL), prepare=from_map("date_raw", "module_raw", "variety_raw", "third_raw", "shoots_prod_raw", "shoots_raw", *[f"{c}_raw" for c in PHYSIOLOGICAL]), domain="fisiologia",
)


def build_physiology(raw: DataFrame, dims: Mapping[str, DataFrame], loaded: str, file: str, today: Column | None = None, season: tuple[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Physiology of the newest batch (load time and file), optionally of one date alone."""
    return build_fact(latest_batch(raw, loaded, file, today), dims, PHYSIOLOGY, season)


SIGNATURE = ("date_raw", "person_raw", "module_raw", "shift_raw", "valve_raw", "bed_raw", "variety_raw", "evaluated_raw", "flowering_raw")
VEGETATIVE = Fact(
    _spec("vegetative", "person_id", "kind"), lambda: person_columns() | {"evaluated": numbers.to_int(F.col("evaluated_raw")), "flowering": numbers.to_int(F.col("flowering_raw")), "kind": text.title(F.col("kind_raw"))},
    ("evaluated", "flowering"), lambda: [(F.coalesce(F.col("evaluated") <= 0, F.lit(True)), "evaluated_raw", "nothing evaluated", "DQ", "CRITICO"), (F.coalesce(F.col("flowering") < 0, F.lit(True)) | (F.col("flowering") > F.col("evaluated")), "flowering_raw", "part over whole", "DQ", "ALTO")], PERSON, domain="evaluacion_vegetativa",
)


def mark_vegetative(raw: DataFrame, rejects: DataFrame, state_column: str = "load_state") -> DataFrame:
    """raw, which has no id, with the state RECHAZADO for the rows of the rejects' signatures and PROCESADO for all others, one row for each reject."""
    done = raw.withColumn(state_column, F.lit("PROCESADO"))
    return mark_by_signature(done, rejects.select(*SIGNATURE), SIGNATURE, SIGNATURE, state_column, "RECHAZADO")


INDUCED = ("plants", "plants_induced", "shoots_induced", "shoots", "shoots_flowering")


def _part(part: str, whole: str) -> Check:
    return (F.coalesce(F.col(part) > F.col(whole), F.lit(True)), f"{part}_raw", f"invalid, or more than {whole}", "DQ", "ALTO")


INDUCTION = Fact(
    _spec("induction", "person_id", "kind", "consumer"),
    lambda: person_columns(variety="source_raw") | {c: _whole(f"{c}_raw") for c in INDUCED} | {"kind": F.trim(text.nullish(F.col("kind_raw"))), "consumer": F.trim(text.nullish(F.col("consumer_raw")))}
    | {"pct_plants_induced": numbers.pct(_whole("plants_induced_raw"), _whole("plants_raw")), "pct_shoots_induced": numbers.pct(_whole("shoots_induced_raw"), _whole("shoots_raw")), "pct_shoots_flowering": numbers.pct(_whole("shoots_flowering_raw"), _whole("shoots_raw"))},
    (*INDUCED, "pct_plants_induced", "pct_shoots_induced", "pct_shoots_flowering"),
    lambda: [(F.coalesce(F.col("plants") <= 0, F.lit(True)), "plants_raw", "no plants", "DQ", "ALTO"), _part("plants_induced", "plants"), (F.coalesce(F.col("shoots") <= 0, F.lit(True)), "shoots_raw", "no shoots", "DQ", "ALTO"), _part("shoots_induced", "shoots"), _part("shoots_flowering", "shoots")],
    PERSON, lambda raw: raw.withColumn("source_raw", F.coalesce("variety_raw", "description_raw")), "induccion_floral",
)

GROWTH = Fact(
    _spec("growth", "kind", "stem", "trial", "origin", "measure"),
    lambda: person_columns() | {c: F.trim(text.nullish(F.col(f"{c}_raw"))) for c in ("kind", "stem", "trial", "origin", "condition", "vegetative_state", "campaign")}
    | {"measure": numbers.to_decimal(F.col("measure_raw"), 2), "pruning_text": text.nullish(F.col("pruned_raw")), "pruned": dates.parse_datetime(F.col("pruned_raw")).cast("date"), "days": F.datediff(dates.parse_datetime(F.col("date_raw")), dates.parse_datetime(F.col("pruned_raw")))},
    ("person_id", "pruned", "days", "condition", "vegetative_state", "campaign"),
    lambda: [
        (F.col("trial").isNull(), "trial_raw", "no trial", "DQ", "ALTO"), (F.coalesce(F.col("measure") < 0, F.lit(True)), "measure_raw", "invalid measure", "DQ", "ALTO"),
        (F.col("pruning_text").isNotNull() & F.col("pruned").isNull(), "pruned_raw", "invalid pruning date", "DQ", "ALTO"), (F.col("days") < 0, "pruned_raw", "before pruning", "DQ", "ALTO"),
    ], PERSON, domain="tasa_crecimiento_brotes",
)
HEALTH = Fact(
    _spec("health"), lambda: place_columns() | {"alive": count_of("alive_raw"), "dead": count_of("dead_raw"), "mortality": numbers.pct(count_of("dead_raw"), count_of("alive_raw") + count_of("dead_raw"))},
    ("alive", "dead", "mortality"), lambda: [(F.col("alive") + F.col("dead") < 1, "alive_raw", "at least one plant", "DQ", "CRITICO")], domain="sanidad_activo",
)
PRUNED = ("stems", "stem_length", "stem_diameter", "twigs", "stumps", "bad_cuts", "height")
PRUNING = Fact(_spec("pruning", "kind"), lambda: place_columns() | {"kind": F.coalesce(text.title(text.nullish(F.col("kind_raw"))), F.lit(NO_TYPE))} | {c: numbers.to_decimal(F.col(f"{c}_raw"), 2) for c in PRUNED}, PRUNED, domain="ciclo_poda")
LABOUR = Fact(
    FactSpec("labour", ("geo_id", "date_id", "person_id", "activity_id"), ("seq_1",), None, ("labour",)),
    lambda: date_columns() | {"module_key": text.last_number(F.col("module_raw")), "person_key": text.clean_id(F.col("person_raw")), "boss_key": text.clean_id(F.col("boss_raw")), "activity_key": F.lower(F.trim("activity_raw")), "hours": F.coalesce(numbers.to_decimal(F.col("hours_raw"), 2), F.lit(0.0)), "payroll": F.nullif(F.col("payroll_raw"), F.lit(""))},
    ("hours", "payroll", "boss_id"), lambda: [unknown("activity_id", "activity_raw", "activity")],
    (("geo", "module_key", "geo_id", None), ("person", "person_key", "person_id", -1), ("person", "boss_key", "boss_id", -1), ("activity", "activity_key", "activity_id", None)), domain="tareo",
    derived=lambda: {"boss_id": F.nullif("boss_id", F.lit(-1))},  # an unknown supervisor is NULL, unknown workers are -1
)

REGISTRY = {f.spec.name: f for f in (HARVEST, STATE_COUNTS, ORGAN, SAMPLING, WEIGHTS, PHYSIOLOGY, VEGETATIVE, INDUCTION, GROWTH, HEALTH, PRUNING, LABOUR)}


REPORT, VARIABLES = ("tmax", "tmin", "humidity", "rain"), ("tmax", "tmin", "humidity", "vpd", "radiation")
_DIGITS = {"tmax": 2, "tmin": 2, "rain": 3, "vpd": 3, "radiation": 3}


def _readings(raw: DataFrame, metrics: Sequence[str], at: Column) -> DataFrame:
    """Raw readings of one layout with sector, time and metrics; humidity out of range is NULL and the row stays."""
    number = lambda m: F.round(numbers.humidity_pct(numbers.to_decimal(F.col("humidity_raw"))), 2) if m == "humidity" else numbers.to_decimal(F.col(f"{m}_raw"), _DIGITS[m])
    return _fenced(raw, {"read_at": dates.parse_datetime(at), "sector": F.upper(text.nullish(F.col("sector_raw")))} | {m: number(m) for m in metrics})


def build_telemetry(reports: DataFrame, variables: DataFrame, calendar: DataFrame, key: Sequence[str] = ("sector", "read_at")) -> tuple[DataFrame, DataFrame]:
    """Weather of two layouts by sector and time of reading: (rows, rejects).

    Reports have their hour in a column, variables in their overflow text (h:mm[:ss]). Times that can't be read, dates that the
    calendar (date_id) lacks and blank sectors are rejected; within a layout equal repeated readings count once and
    differing ones go; what both layouts have comes from the reports. Metrics of the other layout are NULL.
    """
    hour = dates.time_of_day(F.col("hour_raw"))
    hidden = dates.time_of_day(F.regexp_extract("values_raw", r"(?i)hora[^=|]*=\s*([^|]*)", 1))
    day = F.trim("date_raw")
    layouts = ((reports, REPORT, F.concat(day, F.lit(" "), F.coalesce(hour, F.lit("00:00:00"))), 0), (variables, VARIABLES, F.concat_ws(" ", day, hidden), 1))
    known = calendar.select(F.col("date_id").alias("_date")).distinct()
    rows, gone = None, None
    for raw, metrics, at, rank in layouts:
        clean = _readings(raw, metrics, at).withColumn("date_id", dates.date_id(F.col("read_at")))
        placed = clean.join(known, F.col("date_id") == F.col("_date"), "left")
        valid, invalid = first_failure(placed, [(F.col("read_at").isNull(), "date_raw", "invalid time", "DQ", "CRITICO"), (F.col("_date").isNull(), "date_raw", "date is not in the calendar", "DQ", "ALTO"), (F.col("sector").isNull(), "sector_raw", "no sector", "DQ", "ALTO")])
        kept, clashing = dedup_signature(valid, key, metrics, ["seq_1"])
        rejected = invalid.select("seq_1", "reason").unionByName(clashing.select("seq_1", F.lit("readings differ").alias("reason")))
        own = kept.select(*key, "date_id", *metrics, "seq_1", F.lit(rank).alias("layout"))
        rows, gone = (own, rejected) if rows is None else (rows.unionByName(own, allowMissingColumns=True), gone.unionByName(rejected))
    first, _ = dedup_first(rows, key, ["layout", "seq_1"])
    return first.select(*key, "date_id", *dict.fromkeys((*REPORT, *VARIABLES)), "layout", "seq_1"), gone
