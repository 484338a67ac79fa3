"""Raw layer: scans, layouts, routing, sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldmart.functions import text
from fieldmart.operators.shape import select_or_null
from fieldmart.sources.kv import encode_kv, overflow_map

LOADED = "CARGADO"
MOST_RULES = 10_000
"""Rules (rows of a rule table) that are handed to every task; more are sorted and merged."""


def _beside(rules: DataFrame) -> DataFrame:
    """The rules' side of a join with an exploded table. Spark takes that table to be as small as before it was exploded and, where it doesn't know the size of the rules, would send all of it through the driver."""
    return F.broadcast(rules) if rules.limit(MOST_RULES + 1).count() <= MOST_RULES else rules.hint("merge")


def scan_raw(spark: SparkSession, path: str, columns: Sequence[str], where: Column) -> DataFrame:
    """Projected columns of the rows that pass: both reach the Parquet scan."""
    return spark.read.parquet(path).where(where).select(*columns)


def latest_batch(df: DataFrame, ts: str, file: str, on_date: Column | None = None) -> DataFrame:
    """Rows of the newest (load time, file) pair, optionally of one date; the pair is one row."""
    rows = df if on_date is None else df.where(F.to_date(ts) == on_date)
    newest = rows.agg(F.max(F.struct(ts, file)).alias("_newest"))
    return rows.join(newest, F.struct(F.col(ts), F.col(file)) == F.col("_newest")).drop("_newest")


def newest_per_source(files: DataFrame, key: str, mtime: str, path: str, processed: DataFrame) -> DataFrame:
    """Newest file of each logical source that isn't marked as processed."""
    done = processed.select(F.col(path).alias("_done")).distinct()
    return files.join(done, F.col(path) == F.col("_done"), "left_anti").groupBy(key).agg(F.max_by(path, F.struct(mtime, path)).alias(path), F.max(mtime).alias(mtime))


def _route_key(c: Column) -> Column:
    """Without accents and case, all that is neither letter nor digit as one underscore."""
    return F.nullif(F.trim(F.regexp_replace(F.lower(text.strip_accents(c)), "[^a-z0-9]+", "_"), F.lit("_")), F.lit(""))


def _anchors(c: Column) -> Column:
    """Stretches of one, two and three characters, to meet those that open a pattern."""
    runs = lambda n: F.when(F.length(c) >= n, F.transform(F.sequence(F.lit(1), F.length(c) - n + 1), lambda i: c.substr(i, F.lit(n)))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(runs(1), runs(2), runs(3)))


def route_files(files: DataFrame, name: str, routes: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """files with target: that of an alias (priority, pattern, target) that the name contains, the smallest priority first, else that of the longest route (pattern, target); ties: smallest pattern.

    Names and patterns are compared without accents, case and punctuation. Each distinct name is routed once and joined
    back, so equal files stay. Names meet patterns over the up to three characters that open a pattern, an equality.
    """
    ranked = routes.select(_route_key(F.col("pattern")).alias("_p"), F.lit(1).alias("_kind"), F.lit(0).cast("long").alias("_priority"), "target")
    if aliases is not None:
        ranked = ranked.unionByName(aliases.select(_route_key(F.col("pattern")).alias("_p"), F.lit(0).alias("_kind"), F.col("priority").cast("long").alias("_priority"), "target"))
    opened = ranked.where("_p is not null").withColumn("_anchor", F.col("_p").substr(1, 3))
    names = files.select(F.col(name).alias("_name")).distinct().withColumn("_key", _route_key(F.col("_name")))
    met = names.withColumn("_anchor", F.explode(_anchors(F.col("_key")))).join(_beside(opened), "_anchor").where(F.col("_key").contains(F.col("_p")))
    best = met.groupBy("_name").agg(F.min(F.struct("_kind", "_priority", (-F.length("_p")).alias("l"), "_p", "target")).alias("_best"))
    return files.join(best, F.col(name) == F.col("_name"), "left").select(*[files[c] for c in files.columns], F.col("_best")["target"].alias("target"))


def stamp_load(df: DataFrame, file: Column, now: Column) -> DataFrame:
    return df.withColumns({"source_file": file, "loaded_at": now, "load_state": F.lit(LOADED)})


def canonicalise_columns(df: DataFrame, aliases: Mapping[str, str]) -> DataFrame:
    """Headers in lower case with underscores, aliases applied; equal ones get a number."""
    import re
    import unicodedata

    seen: dict[str, int] = {}
    names = []
    for c in df.columns:
        plain = unicodedata.normalize("NFKD", c).encode("ascii", "ignore").decode()
        name = re.sub(r"[^a-z0-9]+", "_", plain.lower()).strip("_")
        name = aliases.get(name, name)
        seen[name] = seen.get(name, 0) + 1
        names.append(name if seen[name] == 1 else f"{name}__{seen[name]}")
    return df.toDF(*names)


def align_to_target(df: DataFrame, target: Sequence[str], synonyms: Mapping[str, Sequence[str]], overflow: str = "overflow") -> DataFrame:
    """Target columns (from synonyms where the own value is blank); all other columns in the overflow map."""
    solid = lambda c: F.nullif(F.trim(F.col(c).cast("string")), F.lit(""))
    filled = {c: F.coalesce(*[solid(s) for s in (c, *synonyms.get(c, ())) if s in df.columns], F.lit(None).cast("string")) for c in target}
    used = {s for c in target for s in synonyms.get(c, ())}
    rest = df.withColumns({f"_t_{c}": v for c, v in filled.items()}).select(*[f"_t_{c}" for c in target], *[c for c in df.columns if c not in target and c not in used])
    return overflow_map(rest, [f"_t_{c}" for c in target], overflow).select(*[F.col(f"_t_{c}").alias(c) for c in target], overflow)


@dataclass(frozen=True)
class LayoutSpec:
    """Column map of one file layout: output -> expression, constants from the file name, rows of one kind only."""

    columns: Mapping[str, str]
    from_file: Mapping[str, str] = field(default_factory=dict)
    keep: str = "true"


def _headed(columns: str, **renamed: str) -> dict[str, str]:
    return {c: f"`{c}`" for c in columns.split()} | {c: f"`{source}`" for c, source in renamed.items()}


# fixed values: columns of the file layouts, after header canonicalisation
LAYOUTS = {
    "weather_report": LayoutSpec(_headed("Fecha_Raw Hora_Raw TempMax_Raw TempMin_Raw Humedad_Raw Precipitacion_Raw"), {"Sector_Raw": r"(?i)\b([A-Z]\d{2})\b"}),
    "weather_variables": LayoutSpec(_headed("Fecha_Raw TempMax_Raw TempMin_Raw Humedad_Raw VPD_Raw Radiacion_Raw"), {"Sector_Raw": r"(?i)\b([A-Z]\d{2})\b"}),
    "peladas": LayoutSpec(_headed("Fecha_Raw Fundo_Raw DNI_Raw Nombres_Raw Modulo_Raw Turno_Raw Valvula_Raw Tipo_Evaluacion_Raw Punto_Raw Variedad_Raw Muestras_Raw BotonesFlorales_Raw Flores_Raw BayasPequenas_Raw BayasGrandes_Raw Fase1_Raw Fase2_Raw BayasCremas_Raw BayasMaduras_Raw BayasCosechables_Raw PlantasProductivas_Raw PlantasNoProductivas_Raw", Evaluador_Raw="Nombres_Raw"), keep="upper(trim(Tipo_Evaluacion_Raw)) = 'PELADAS'"),
    "floral_induction": LayoutSpec(_headed("Fecha_Raw DNI_Raw Fecha_Subida_Raw Nombres_Raw Consumidor_Raw Modulo_Raw Turno_Raw Valvula_Raw Cama_Raw Descripcion_Raw", Evaluador_Raw="Nombres_Raw", Tipo_Evaluacion_Raw="Evaluacion_Raw", Variedad_Raw="Descripcion_Raw", PlantasPorCama_Raw="Plantas_por_Cama_Raw", PlantasConInduccion_Raw="Plantas_con_Induccion_Raw", BrotesConInduccion_Raw="Brotes_con_Induccion_Raw", BrotesTotales_Raw="Brotes_Totales_Raw", BrotesConFlor_Raw="Brotes_con_Flor_Raw")),
    "shoot_growth": LayoutSpec(_headed("Semana_Raw Dia_Raw Fecha_Raw DNI_Raw Condicion_Raw Estado_Vegetativo_Raw Variedad_Raw Cama_Raw Ensayo_Raw Medida_Raw Fecha_Poda_Aux_Raw Observacion_Raw", Codigo_Origen_Raw="Unnamed0_Raw", Evaluador_Raw="EVALUADOR_A_Raw", Modulo_Raw="Mod_Raw", Turno_Raw="Tur_Raw", Valvula_Raw="Val_Raw", Tipo_Tallo_Raw="Tipo_de_Tallo_Raw", Campana_Raw="CAMPANA_Raw", Tipo_Evaluacion_Raw="Evaluacion_Raw")),
}


def read_layout(df: DataFrame, name: str, file: Column) -> DataFrame:
    """A file of one of the LAYOUTS: its columns (NULL where the file lacks one), constants of the file name, all else in Valores_Raw as k=v text."""
    spec = LAYOUTS[name]
    used = {source.strip("`") for source in spec.columns.values()}
    missing = sorted(used - set(df.columns))
    whole = df.withColumns({c: F.lit(None).cast("string") for c in missing}) if missing else df
    extra = [c for c in df.columns if c not in used and c not in spec.columns and c not in spec.from_file]
    values = F.nullif(encode_kv(F.map_filter(F.create_map(*[x for c in extra for x in (F.lit(c), F.col(c).cast("string"))]), lambda _, v: v.isNotNull())), F.lit("")) if extra else F.lit(None).cast("string")
    keep = spec.keep if spec.keep == "true" or "Tipo_Evaluacion_Raw" in df.columns else "true"
    with_extra = LayoutSpec({**spec.columns, "Valores_Raw": "`_values`"}, spec.from_file, keep)
    return project_layout(whole.withColumn("_values", values), with_extra, file)


def project_layout(df: DataFrame, spec: LayoutSpec, file: Column) -> DataFrame:
    return df.where(spec.keep).select(*[F.expr(e).alias(c) for c, e in spec.columns.items()], *[F.nullif(F.regexp_extract(file, p, 1), F.lit("")).alias(c) for c, p in spec.from_file.items()])


def check_layout(files: DataFrame, columns: str, signatures: DataFrame) -> DataFrame:
    """files (target, columns array) against signatures (target, required, forbidden[, alternatives]): accepted, and the reason if not.

    alternatives: groups (arrays of arrays of columns); of each group at least one array has to be there whole.
    """
    none = F.array().cast("array<array<array<string>>>")
    s = signatures.select(F.col("target").alias("_t"), "required", "forbidden", (F.coalesce("alternatives", none) if "alternatives" in signatures.columns else none).alias("_groups"))
    joined = files.join(s, F.col("target") == F.col("_t"), "left")
    lacking = F.filter("_groups", lambda group: ~F.exists(group, lambda one: F.size(F.array_except(one, F.col(columns))) == 0))
    told = F.array_join(F.transform(lacking, lambda group: F.array_join(F.transform(group, lambda one: F.array_join(one, "+")), " or ")), ", ")
    missing, wrong = F.array_except("required", columns), F.array_intersect("forbidden", columns)
    reason = F.when(F.col("_t").isNull(), "no signature").when(F.size(missing) > 0, F.concat(F.lit("missing "), F.array_join(F.array_sort(missing), ","))).when(F.size(lacking) > 0, F.concat(F.lit("missing one of "), told)).when(F.size(wrong) > 0, F.concat(F.lit("incompatible "), F.array_join(F.array_sort(wrong), ",")))
    return joined.select(*files.columns, reason.isNull().alias("accepted"), reason.alias("reason"))


def suggest_route(files: DataFrame, file: str, columns: str, signatures: DataFrame, here: float = 0.5, there: float = 0.8, hits: int = 6) -> DataFrame:
    """Table whose signature a misrouted file fits: under `here` of its own columns, at least `there` and `hits` of another's.

    Files meet signatures over the column names that they share, not as a cross product.
    """
    wanted = signatures.select(F.col("target").alias("_t"), F.explode("required").alias("_c"), F.size("required").alias("_size"))
    given = files.select(file, "target", F.explode(columns).alias("_c"))
    shares = given.join(_beside(wanted), "_c").groupBy(file, "target", "_t").agg(F.count("*").alias("_hits"), (F.count("*") / F.first("_size")).alias("_share"))
    own = shares.where("target = _t").select(F.col(file).alias("_f"), F.col("_share").alias("_own"))
    other = shares.where((F.col("target") != F.col("_t")) & (F.col("_share") >= there) & (F.col("_hits") >= hits)).groupBy(file).agg(F.min(F.struct((-F.col("_share")).alias("s"), "_t")).alias("_best"))
    joined = files.join(own, F.col(file) == F.col("_f"), "left").join(other, file, "left")
    return joined.select(file, "target", F.when(F.coalesce("_own", F.lit(0.0)) < here, F.col("_best")["_t"]).alias("suggestion"))


def extract_codes(cells: DataFrame, cell: str) -> DataFrame:
    """(sector, module, shift, valve) from codes M6-T4-V8 and S7M1T1V4; the sector is filled where a module has exactly one."""
    part = lambda p: F.nullif(F.regexp_extract(F.upper(cell), p, 1), F.lit("")).try_cast("int")
    codes = cells.where(F.upper(cell).rlike(r"^(S\d+)?-?M\d+-?T\d+-?V\d+$")).select(part(r"S(\d+)").alias("sector"), part(r"M(\d+)").alias("module"), part(r"T(\d+)").alias("shift"), part(r"V(\d+)").alias("valve"))
    sole = codes.groupBy("module").agg(F.min("sector").alias("_low"), F.max("sector").alias("_high")).where("_low = _high").select("module", "_low")
    return codes.join(sole, "module", "left").select(F.coalesce("sector", "_low").alias("sector"), "module", "shift", "valve").distinct()


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def export_csv(df: DataFrame, path: str) -> bool:
    """Writes CSV with a header, unless df is empty."""
    if df.isEmpty():
        return False
    df.write.mode("overwrite").option("header", True).csv(path)
    return True


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def _files(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def _versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the published versions, the newest last."""
    system, marks = _files(spark, f"{root}/_published")
    return sorted(int(s.getPath().getName()) for s in system.listStatus(marks)) if system.exists(marks) else []


def publish(marts: Mapping[str, DataFrame], root: str) -> int:
    """Publishes a set of marts as one version and returns its number.

    All marts are written to a folder of the version; an empty file with its number, made in one step, then makes them the
    current ones, so that a failure at any point leaves the old set whole. Versions before the last two are removed.
    """
    spark = next(iter(marts.values())).sparkSession
    old = _versions(spark, root)
    number = (old[-1] if old else 0) + 1
    for name, df in marts.items():
        df.write.mode("overwrite").parquet(f"{root}/v{number}/{name}")
    system, mark = _files(spark, f"{root}/_published/{number}")
    system.create(mark, False).close()
    for gone in old[:-1]:
        for path in (f"{root}/_published/{gone}", f"{root}/v{gone}"):
            system.delete(_files(spark, path)[1], True)
    return number


def published(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A mart of the current version."""
    return spark.read.parquet(f"{root}/v{_versions(spark, root)[-1]}/{name}")


def inventory(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, columns, rows)."""
    from functools import reduce

    return reduce(DataFrame.unionByName, [df.agg(F.count("*").alias("rows")).select(F.lit(n).alias("table_name"), F.lit(len(df.columns)).alias("columns"), "rows") for n, df in tables.items()])


__all__ = ["LAYOUTS", "LayoutSpec", "align_to_target", "append", "canonicalise_columns", "check_layout", "export_csv", "extract_codes", "inventory", "latest_batch", "newest_per_source", "project_layout", "publish", "published", "read_csv", "read_layout", "route_files", "scan_raw", "select_or_null", "stamp_load", "suggest_route"]
