"""Secret scans over an incremental blob ledger, with DataFrame and SQL functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """A pattern, scanned leftmost and without overlaps; a match stays if its group has `least` characters or more."""

    kind: str
    version: int
    pattern: str
    group: int
    least: int

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


# fixed values
RULES = (
    Rule("assign", 1, r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", 1, r"[0-9a-f]{32,}", 0, 32),
)
_LEDGER = "blob binary, rules array<string>, spans array<struct<start:int,rule:string,end:int>>"
_SPANS = "array<struct<start:int,rule:string,end:int>>"
_FOUND = "array<struct<start:int,place:int,kind:string,end:int>>"
_STEP = 512


def _matches(rule: Rule) -> Column:
    """Spans of one rule in `text`: lengths of matches and of the pieces between them add up to places (code points)."""
    pattern = "r'" + rule.pattern.replace("'", r"\x27") + "'"
    pieces = f"split(text, {pattern}, -1)"
    whole = f"regexp_extract_all(text, {pattern}, 0)"
    tested = whole if rule.group == 0 else f"regexp_extract_all(text, {pattern}, {rule.group})"
    sizes = f"""zip_with(zip_with({whole}, {tested}, (x, y) -> struct(length(x) as size, length(y) as tested)), slice({pieces}, 1, size({whole})),
        (x, p) -> struct(length(p) as skip, x.size as size, x.tested as tested))"""
    step = f"""if(x.tested >= {rule.least}, array_append(acc.found, struct(acc.at + x.skip as start, '{rule.name}' as rule, acc.at + x.skip + x.size as end)), acc.found)"""
    # in blocks of about the root of the number of matches: appending to one list of all would copy it for each match
    walked = f"""element_at(transform(array({sizes}), sizes -> flatten(aggregate(
        transform(sequence(0, int((size(sizes) - 1) / {_STEP})), b -> slice(sizes, b * {_STEP} + 1, {_STEP})),
        struct(0 as at, cast(array() as array<{_SPANS}>) as blocks),
        (all, block) -> aggregate(block, struct(all.at as at, cast(array() as {_SPANS}) as found), (acc, x) -> struct(acc.at + x.skip + x.size as at, {step} as found), acc -> struct(acc.at as at, array_append(all.blocks, acc.found) as blocks)),
        all -> all.blocks))), 1)"""
    return F.when(F.expr(f"array_contains(todo, '{rule.name}') and text rlike {pattern}"), F.expr(walked)).otherwise(F.expr(f"cast(array() as {_SPANS})"))


def _exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def _blob(text: str = "text") -> Column:
    return F.unhex(F.sha2(F.coalesce(F.col(text).cast("string"), F.lit("")), 256))


def _held(spark: SparkSession, ledger: str) -> DataFrame:
    return spark.read.schema(_LEDGER).parquet(ledger).where("spans is not null")


def scan(docs: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Scans what is new in docs (text; any number of versions and paths) and appends it to the ledger, which it returns.

    A blob is the SHA-256 of a whole text (null: empty). A blob is scanned once, whatever number of rows has it, and only by
    rules of versions that the ledger doesn't hold for it; a second call over the same rows adds nothing. Each span is
    stored with the rule version that found it. Texts of any length are scanned whole. An empty table makes an empty
    ledger, or adds nothing. Other columns of docs aren't read, whatever their names.
    """
    spark = docs.sparkSession
    names = F.array(*[F.lit(r.name) for r in rules])
    rows = docs.select(_blob().alias("blob"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    if _exists(spark, ledger):
        done = _held(spark, ledger).select("blob", F.explode("rules").alias("rule")).groupBy("blob").agg(F.collect_set("rule").alias("done"))
        rows = rows.join(done, "blob", "left").select("blob", "text", F.array_except(names, F.coalesce("done", F.array().cast("array<string>"))).alias("todo")).where("size(todo) > 0")
    else:
        rows = rows.withColumn("todo", names)
    fresh = rows.groupBy("blob").agg(F.first("text").alias("text"), F.first("todo").alias("todo"))
    found = fresh.select("blob", F.col("todo").alias("rules"), F.flatten(F.array(*[_matches(r) for r in rules])).alias("spans"))
    found.write.mode("append").parquet(ledger)
    return spark.read.schema(_LEDGER).parquet(ledger)


def findings(docs: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES, path: str = "doc_id", out: str = "findings") -> DataFrame:
    """Every row of docs with what these rules found in its blob: path, out (start, place, kind, end) by start, then the order of the rules.

    What other rules or other versions of them have found stays in the ledger and isn't returned; a rule that the ledger
    doesn't hold for a blob has found nothing there. Only the key column and the blob are shuffled; copies share one ledger
    row. Clean blobs have an empty list. Rows with a null or repeated path stand alone; an empty table gives an empty one.
    Other columns of docs aren't read; `path` may have any name but that of `out`.
    """
    names, kinds = F.array(*[F.lit(r.name) for r in rules]), F.array(*[F.lit(r.kind) for r in rules])
    asked = lambda x: F.struct(x["start"].alias("start"), (F.array_position(names, x["rule"]) - 1).cast("int").alias("place"), F.element_at(kinds, F.array_position(names, x["rule"]).cast("int")).alias("kind"), x["end"].alias("end"))
    own = F.transform(F.filter("spans", lambda x: F.array_contains(names, x["rule"])), asked)
    held = _held(docs.sparkSession, ledger).select("blob", own.alias("_own")).where("size(_own) > 0")
    by_blob = held.groupBy("blob").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("_own")))).alias("_own"))
    paths = docs.select(F.col(path).alias("_path"), _blob().alias("blob"))
    return paths.join(by_blob, "blob", "left").select(F.col("_path").alias(path), F.coalesce("_own", F.array().cast(_FOUND)).alias(out))


def flat(found: str = "findings") -> Column:
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def count_of(kind: str, found: str = "findings") -> Column:
    return F.size(F.filter(found, lambda x: x["kind"] == kind)).cast("long")
