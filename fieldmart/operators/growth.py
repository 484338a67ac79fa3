"""Growth analytics: weekly curves, Gompertz fit, group comparison, forecast, boosted trees."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from fieldmart.operators.numbering import ready_checkpoints
from fieldmart.sources.raw import export_csv

# fixed values: fallback curve K, b, c; weeks and thresholds of the study
DEFAULT = (30.0, 5.0, 0.4)
MAX_WEEK = 20
FORECAST_CM, FORECAST_MIN_N = 25.0, 50


def growth_base(fact: DataFrame, dims: Sequence[tuple[DataFrame, str, str]], week: Column, valid: Column) -> DataFrame:
    """Facts with their dimensions (left), the week since pruning, and only valid measures."""
    for dim, fk, pk in dims:
        fact = fact.join(dim, fact[fk] == dim[pk], "left")
    return fact.withColumn("week", week).where(valid)


def weekly_median(base: DataFrame, measure: str, keys: Sequence[str] = (), max_week: int = MAX_WEEK) -> DataFrame:
    return base.where(F.col("week").between(0, max_week)).groupBy(*keys, "week").agg(F.median(measure).alias("median"), F.count("*").alias("n"))


def gompertz(k: Column, b: Column, c: Column, t: Column) -> Column:
    return k * F.exp(-b * F.exp(-c * t))


FEWEST = 3
"""Weeks that a curve needs to be fitted; with fewer the fallback stands."""


START = (35.0, 5.0, 0.5)
"""Where the study's own search begins; fixed values."""
_STEPS, _GROUPS = 400, 64
_LOG_B = np.arange(-25.0, 7.0)
_RATES = np.arange(-20.0, 61.0, 2.0)
"""Rates of the first look, over the length of the curve."""

Box = tuple[tuple[float, float], tuple[float, float]]
"""Least and most log |b|, least and most c."""


def _parts(k: np.ndarray, b: np.ndarray, c: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """exp(-c t) and the curve, for parameters with one axis less than t."""
    fading = np.exp(-c[..., None] * t)
    return fading, k[..., None] * np.exp(-b[..., None] * fading)


def _starts(t: np.ndarray, y: np.ndarray, w: np.ndarray, within: Box | None) -> tuple[np.ndarray, ...]:
    """k, sign of b, log |b| and c of the searches of each group: the study's start, and the best of a wide grid for either sign and each stretch of rates, with K in closed form."""
    span = np.maximum((t * w).max(1) - np.where(w > 0, t, np.inf).min(1), 1.0)
    sign, log_b, rate = (x.ravel() for x in np.meshgrid([1.0, -1.0], _LOG_B, _RATES, indexing="ij"))
    stretch = (np.searchsorted([1.0], sign) * 100 + (rate + 20) // 10).astype(int)
    c = rate[None] / span[:, None]
    if within:
        log_b, c = np.clip(log_b, *within[0]), np.clip(c, *within[1])
    _, f = _parts(np.ones_like(c), np.broadcast_to(sign * np.exp(log_b), c.shape), c, t[:, None])
    f = f * w[:, None]
    ff, yf = (f * f).sum(2), (f * y[:, None]).sum(2)
    k = yf / ff
    sse = (y * y * w).sum(1)[:, None] - k * yf
    sse = np.where(np.isfinite(sse) & (ff > 1e-200), sse, np.inf)
    found = []
    for own in (np.flatnonzero(stretch == s) for s in np.unique(stretch)):
        best = own[sse[:, own].argmin(1)]
        rows = np.arange(len(t))
        found.append((k[rows, best], sign[best], log_b[best], c[rows, best]))
    study = [np.full(len(t), v) for v in (START[0], 1.0, np.log(START[1]), START[2])]
    return tuple(np.stack([study[i], *(f[i] for f in found)], 1) for i in range(4))


def levenberg_marquardt(t: np.ndarray, y: np.ndarray, w: np.ndarray, within: Box | None = None) -> tuple[np.ndarray, ...]:
    """k, b, c, sse and whether the search settled, for each row of weeks t, medians y and weights w (0: no such week).

    Every search of every group takes its own steps: the normal equations of (K, log |b|, c) with its own damping, less
    after a step that lowers the sum of squares and more after one that doesn't. Nothing bounds the parameters, unless they
    are asked for within a box: one that would leave it stays at the bound, and the others go on.
    """
    scale = np.where((most := np.abs(y * w).max(1)) > 0, most, 1.0)
    y = y / scale[:, None]
    k, sign, u, c = _starts(t, y, w, within)
    k[:, 0] /= scale
    if within:
        u, c = np.clip(u, *within[0]), np.clip(c, *within[1])
    t, y, w = t[:, None], y[:, None], w[:, None]
    error = lambda k, u, c: np.nan_to_num((w * (y - _parts(k, sign * np.exp(u), c, t)[1]) ** 2).sum(-1), nan=np.inf)
    sse, damping, before = error(k, u, c), np.full(k.shape, 1e-2), None
    floor = 1e-16 * (w * y * y).sum(-1)
    for step in range(_STEPS):
        b = sign * np.exp(u)
        fading, f = _parts(k, b, c, t)
        by_u = -f * b[..., None] * fading
        jacobian = np.nan_to_num(np.stack([f / np.where(k == 0, 1, k)[..., None], by_u, -by_u * t], -1) * w[..., None], posinf=0.0, neginf=0.0)
        residual = np.nan_to_num(w * (y - f), posinf=0.0, neginf=0.0)
        right = np.einsum("gsti,gst->gsi", jacobian, residual)
        if within:
            held = [(v <= low) & (right[..., i] < 0) | (v >= high) & (right[..., i] > 0) for i, v, (low, high) in ((1, u, within[0]), (2, c, within[1]))]
            free = np.stack([np.ones(k.shape), *(~h for h in held)], -1)
            jacobian, right = jacobian * free[..., None, :], right * free
        normal = np.einsum("gsti,gstj->gsij", jacobian, jacobian)
        diagonal = np.einsum("gsii->gsi", normal)
        damped = normal + np.eye(3) * (diagonal * damping[..., None] + 1e-14 * diagonal.max(-1, keepdims=True) + 1e-200)[..., None]
        change = np.linalg.solve(damped, right[..., None])[..., 0]
        new = k + change[..., 0], u + change[..., 1], c + change[..., 2]
        if within:
            new = new[0], np.clip(new[1], *within[0]), np.clip(new[2], *within[1])
        tried = error(*new)
        better = tried < sse
        k, u, c, sse = (np.where(better, n, o) for n, o in zip((*new, tried), (k, u, c, sse), strict=True))
        damping = np.clip(np.where(better, damping * 0.3, damping * 4), 1e-12, 1e12)
        if step == _STEPS - 50:
            before = sse
    settled = (before - sse <= 1e-7 * sse + floor) & np.isfinite(sse)
    best = np.where(np.isfinite(sse), np.round(sse, 9), np.inf).argmin(1)
    rows = np.arange(len(k))
    return k[rows, best] * scale, (sign * np.exp(u))[rows, best], c[rows, best], np.maximum(sse[rows, best], 0.0) * scale**2, settled[rows, best]


def _fits(names: Sequence[str], within: Box | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, _GROUPS):
                batch = whole.slice(at, _GROUPS)
                points = batch.column("points").to_pylist()
                longest = max(len(p) for p in points)
                t, y, w = (np.array([[p[i] for p in own] + [0.0] * (longest - len(own)) for own in [[(q["week"], q["median"], 1.0) for q in group] for group in points]], float) for i in range(3))
                with np.errstate(all="ignore"):
                    *fitted, settled = levenberg_marquardt(t, y, w, within)
                good = settled & (w.sum(1) >= FEWEST)
                columns = [pa.array(np.where(good, v, d)) for v, d in zip(fitted[:3], DEFAULT, strict=True)]
                yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), *columns, pa.array(fitted[3], mask=~good)], [*names, "k", "b", "c", "sse"])

    return run


def fit_gompertz(curve: DataFrame, keys: Sequence[str] = (), within: Box | None = None) -> DataFrame:
    """keys, k, b, c, sse of K*exp(-b*exp(-c*t)) over (week, median), by least squares without bounds on the parameters, or within a box of log |b| and c.

    Groups are fitted side by side, one row of at most as many points as there are weeks for each, by Levenberg-Marquardt
    searches from the study's start and from the best places of a wide grid; the least sum of squares wins. A group with
    fewer than FEWEST weeks, or whose best search hasn't settled, gets the fallback curve and no sse.
    """
    points = curve.where("week is not null and median is not null").groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(F.col("week").cast("double").alias("week"), F.col("median").cast("double").alias("median")))).alias("points"))
    points = points.where(F.size("points") > 0)
    schema = StructType([points.schema[k] for k in keys] + [StructField(n, DoubleType()) for n in ("k", "b", "c", "sse")])
    return points.mapInArrow(_fits(list(keys), within), schema)


def gompertz_curve(spark, params: DataFrame, weeks: int = MAX_WEEK) -> DataFrame:
    """Fitted values for weeks 0 to `weeks`."""
    return params.withColumn("week", F.explode(F.sequence(F.lit(0), F.lit(weeks)))).withColumn("fitted", gompertz(F.col("k"), F.col("b"), F.col("c"), F.col("week")))


def compare_groups(base: DataFrame, factors: Sequence[str], measure: str, weeks: tuple[int, int] = (2, 10)) -> DataFrame:
    """Weekly medians of every factor in one pass over the data."""
    pairs = F.array(*[F.struct(F.lit(f).alias("factor"), F.col(f).cast("string").alias("level")) for f in factors])
    long = base.where(F.col("week").between(*weeks)).select("week", F.col(measure).alias("_v"), F.inline(pairs))
    return long.groupBy("factor", "level", "week").agg(F.median("_v").alias("median"), F.count("*").alias("n"))


def peak_stats(base: DataFrame, factors: Sequence[str], measure: str, weeks: tuple[int, int] = (4, 8)) -> DataFrame:
    """Median, mean, deviation and number of the peak weeks by factor level."""
    pairs = F.array(*[F.struct(F.lit(f).alias("factor"), F.col(f).cast("string").alias("level")) for f in factors])
    long = base.where(F.col("week").between(*weeks)).select(F.col(measure).alias("_v"), F.inline(pairs))
    return long.groupBy("factor", "level").agg(F.median("_v").alias("median"), F.round(F.avg("_v"), 2).alias("mean"), F.round(F.stddev_samp("_v"), 2).alias("std"), F.count("*").alias("n"))


def forecast(base: DataFrame, key: str, measure: str, threshold: float = FORECAST_CM, min_n: int = FORECAST_MIN_N) -> DataFrame:
    """First week with a median at the threshold, week and height of the peak (ties: smallest week), number of measures."""
    weekly = base.groupBy(key, "week").agg(F.median(measure).alias("m"), F.count("*").alias("c"))
    found = weekly.groupBy(key).agg(F.min(F.when(F.col("m") >= threshold, F.col("week"))).alias("first_week"), F.max(F.struct("m", (-F.col("week")).alias("w"))).alias("peak"), F.sum("c").alias("n"))
    return found.where(F.col("n") >= min_n).select(key, "first_week", (-F.col("peak")["w"]).alias("peak_week"), F.round(F.col("peak")["m"], 1).alias("peak_cm"), "n")


MANY = 500_000
"""Rows from which trees are grown over cells of equal features."""
_BLOCK, _LABELS = 10, 1_000


def _draws(names: Sequence[str], trees: int, share: float, seed: Sequence[int]):
    """For each of the trees the number of a cell's rows that are drawn, and the sum of their labels; each row is drawn by itself, so of n equal ones a binomial number is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        for at, batch in enumerate(batches):
            if not batch.num_rows:
                continue
            labels = batch.column("_labels")
            pairs, first = labels.flatten(), np.asarray(labels.offsets)[:-1] - labels.offsets[0].as_py()
            y, n = (np.asarray(pairs.field(k)) for k in ("y", "n"))
            drawn = np.random.default_rng([*seed, TaskContext.get().partitionId(), at]).binomial(n, share, (trees, len(n)))
            sums = [np.add.reduceat(x, first, axis=1).T.astype(float).ravel() for x in (drawn, drawn * y)]
            offsets = pa.array(np.arange(batch.num_rows + 1) * trees, pa.int32())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *(pa.ListArray.from_arrays(offsets, pa.array(x)) for x in sums)], [*names, "_drawn", "_sum"])

    return run


def _ensemble(spark, trees: Sequence, weights: Sequence[float]):
    """The trees as one model of boosted trees."""
    from pyspark.ml.regression import GBTRegressionModel

    gateway, ml = spark.sparkContext._gateway, spark._jvm.org.apache.spark.ml.regression
    models, shares = gateway.new_array(ml.DecisionTreeRegressionModel, len(trees)), gateway.new_array(spark._jvm.double, len(trees))
    for i, (tree, weight) in enumerate(zip(trees, weights, strict=True)):
        models[i], shares[i] = tree._java_obj, weight
    return GBTRegressionModel(ml.GBTRegressionModel(f"gbt_{uuid.uuid4().hex}", models, shares))


def _boosted(rows: DataFrame, names: Sequence[str], label: str, before: Sequence, trees: int, depth: int, rate: float, subsample: float, seed: int):
    """Boosted trees as GBTRegressor grows them, over cells: the rows of equal features, with the number of each label (n).

    A split parts whole cells, so a tree depends only on the number and the mean of the rows that it draws from each; what
    the labels differ within a cell is in no gain. Draws are made for some trees at once, from checkpointed cells.
    """
    from pyspark.ml import PipelineModel
    from pyspark.ml.regression import DecisionTreeRegressor

    spark = rows.sparkSession
    parts = -(-(rows.groupBy(*names).agg(F.count("*").alias("c")).agg(F.max("c")).first()[0] or 1) // _LABELS)
    cells = rows.groupBy(*names, F.pmod(F.xxhash64(label), F.lit(parts)).alias("_part")).agg(F.sort_array(F.collect_list(F.struct(F.col(label).alias("y"), "n"))).alias("_labels")).drop("_part").checkpoint()
    drawn_schema = StructType([*(cells.schema[c] for c in names), *(StructField(c, ArrayType(DoubleType())) for c in ("_drawn", "_sum"))])
    grown, weights = [], []
    for first in range(0, trees, _BLOCK):
        some = min(_BLOCK, trees - first)
        block = PipelineModel(list(before)).transform(cells.mapInArrow(_draws(names, some, subsample, [seed, first]), drawn_schema)).select("features", "_drawn", "_sum")
        at = (_ensemble(spark, grown, weights).setPredictionCol("_at").transform(block) if grown else block.withColumn("_at", F.lit(0.0))).persist()
        block = at
        for i in range(some):
            weight = rate if grown else 1.0  # the first tree stands whole, the others fit twice what is left, the loss's slope
            left = F.col("_sum")[i] / F.col("_drawn")[i] - F.col("_at")
            own = at.where(F.col("_drawn")[i] > 0).select("features", (2 * left if grown else left).alias("_left"), F.col("_drawn")[i].alias("_weight"))
            tree = DecisionTreeRegressor(featuresCol="features", labelCol="_left", weightCol="_weight", predictionCol="_step", maxDepth=depth, maxBins=512, seed=seed).fit(own)
            at = tree.transform(at).withColumn("_at", F.col("_at") + weight * F.col("_step")).drop("_step")
            grown.append(tree)
            weights.append(weight)
        block.unpersist()
    return _ensemble(spark, grown, weights)


def train_growth(base: DataFrame, categorical: Sequence[str], numeric: Sequence[str], label: str, trees: int = 200, depth: int = 5, rate: float = 0.05, subsample: float = 0.8, seed: int = 42, held_out: float = 0.0):
    """(model, metrics row, importances) of gradient-boosted trees over indexed categories and numbers.

    With `held_out`, that share of the rows, drawn by a hash of their values, isn't trained on, and metrics has its n, mae
    and r2 too, as held_n, held_mae and held_r2 (NULL without such rows). Equal rows are on the same side.

    base is read once: equal rows are counted and checkpointed. From MANY rows on, with cells of equal features half as many
    or fewer, trees are grown over the cells; the subsample is of rows in either case.
    """
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import StringIndexerModel, VectorAssembler
    from pyspark.ml.regression import GBTRegressor

    from fieldmart.operators.aggregates import regression_metrics

    names = [*categorical, *numeric]
    columns = [*names, label]
    typed = base.select(*[F.col(c).cast("string").alias(c) for c in categorical], *[F.col(c).cast("double").alias(c) for c in numeric], F.col(label).cast("double").alias(label)).na.drop()
    ready_checkpoints(base.sparkSession)
    rows = typed.groupBy(*columns).agg(F.count("*").alias("n")).checkpoint()
    side = F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(10_000)) < int(held_out * 10_000)
    own = rows.where(~side)
    labels = [[r[0] for r in own.groupBy(c).agg(F.sum("n").alias("n")).orderBy(F.desc("n"), c).collect()] for c in categorical]
    indexed = [f"{c}_index" for c in categorical]
    before = [StringIndexerModel.from_arrays_of_labels(labels, inputCols=list(categorical), outputCols=indexed, handleInvalid="keep"), VectorAssembler(inputCols=[*indexed, *numeric], outputCol="features")]
    total = own.agg(F.sum("n")).first()[0] or 0
    if total >= MANY and own.select(*names).distinct().count() * 2 <= total:
        boosted = _boosted(own, names, label, before, trees, depth, rate, subsample, seed)
    else:
        single = own.withColumn("_each", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
        boosted = GBTRegressor(featuresCol="features", labelCol=label, maxIter=trees, maxDepth=depth, stepSize=rate, subsamplingRate=subsample, seed=seed, maxBins=512).fit(PipelineModel(before).transform(single))
    model = PipelineModel([*before, boosted])
    metrics = regression_metrics(model.transform(own), label, "prediction", "n")
    if held_out:
        metrics = metrics.crossJoin(regression_metrics(model.transform(rows.where(side)), label, "prediction", "n").select(*[F.col(c).alias(f"held_{c}") for c in ("n", "mae", "r2")]))  # one row each
    importances = boosted.featureImportances.toArray().tolist()
    return model, metrics, dict(zip(names, importances, strict=True))


def export_results(results: Mapping[str, DataFrame], root: str) -> list[str]:
    """Writes each result that isn't empty as CSV with a header; returns the names of those written."""
    return [name for name, df in results.items() if export_csv(df, f"{root}/{name}")]
