"""Centroid clustering with ns-bounds: exact Lloyd rounds that rescan only vectors whose bounds fail.

A vector keeps its distance to its own centroid and to the nearest other one, each with the round in which it was
measured. Centroids of all rounds are retained, so a bound is loosened by the norm of a centroid's total displacement
since then: never more than the sum of its drifts, and nothing at all for a centroid that has come back.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldmart.llm.common import Scratch

DIMENSIONS, SCALE = 64, 256
MOST = 1 << 27
"""Components whose size would overflow a squared distance of type long are refused."""
_STATE = "vec_id long, x array<int>, cluster int, was int, near double, near_at int, other double, other_at int, distance long"
_ROWS = 4096


def quantised(vectors: DataFrame, column: str = "embedding", dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """vec_id, x: floor(scale * component) of the vectors with that many components, none null or non-finite."""
    value = F.col(column).cast("array<double>")
    whole = F.transform(value, lambda v: F.floor(v * F.lit(float(scale))))
    sound = (F.size(column) == dimensions) & ~F.exists(value, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    fits = F.when(F.exists(whole, lambda v: F.abs(v) >= MOST), F.raise_error(F.lit(f"a component is too large: distances of type long hold components below {MOST} / {scale}"))).otherwise(whole.cast("array<int>"))
    return vectors.where(F.col(column).isNotNull() & F.coalesce(sound, F.lit(False))).select(F.col("vec_id").cast("long").alias("vec_id"), fits.alias("x"))


def _squared(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances, rows by centroids. Doubles hold the sums where components are small enough."""
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(centroids).max(initial=0)))
    kind = np.float64 if most * most * 4 * x.shape[1] < 1 << 52 else np.int64
    a, b = x.astype(kind), centroids.astype(kind)
    return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :]).astype(np.int64)


def _own(x: np.ndarray, centroids: np.ndarray, cluster: np.ndarray) -> np.ndarray:
    apart = x.astype(np.int64) - centroids[cluster]
    return (apart * apart).sum(1)


def displacements(history: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """For each earlier round and centroid: how far it is now from where it was then; and the farthest of all others."""
    moved = np.stack([np.sqrt(((history[-1] - h).astype(np.float64) ** 2).sum(1)) for h in history])
    if moved.shape[1] == 1:
        return moved, np.zeros_like(moved)
    order = np.argsort(moved, axis=1)
    first, second = order[:, -1], order[:, -2]
    rows = np.arange(len(history))
    others = np.repeat(moved[rows, first][:, None], moved.shape[1], 1)
    others[rows, first] = moved[rows, second]
    return moved, others


class Block:
    """Vectors with their bounds; `rescanned` counts those that were compared with every centroid."""

    def __init__(self, x: np.ndarray, cluster: np.ndarray, near: np.ndarray, near_at: np.ndarray, other: np.ndarray, other_at: np.ndarray) -> None:
        self.x, self.cluster, self.near, self.near_at, self.other, self.other_at = x, cluster, near, near_at, other, other_at
        self.rescanned = 0

    def assign(self, history: list[np.ndarray]) -> None:
        """Clusters for the last centroids of the history. A bound that doesn't prove a vector's cluster is measured anew."""
        now, centroids = len(history) - 1, history[-1]
        moved, others = displacements(history)
        rows = np.flatnonzero(self.cluster >= 0)
        held = lambda r: self.near[r] + moved[self.near_at[r], self.cluster[r]] + 1e-6 < (self.other[r] - others[self.other_at[r], self.cluster[r]]) * (1 - 1e-12) - 1e-6
        loose = rows[~held(rows)]
        if len(loose):  # the own distance first
            self.near[loose] = np.sqrt(_own(self.x[loose], centroids, self.cluster[loose]).astype(np.float64))
            self.near_at[loose] = now
            loose = loose[~held(loose)]
        self._rescan(np.concatenate([np.flatnonzero(self.cluster < 0), loose]), centroids, now)

    def _rescan(self, rows: np.ndarray, centroids: np.ndarray, now: int) -> None:
        self.rescanned = len(rows)
        for at in range(0, len(rows), _ROWS):
            own = rows[at : at + _ROWS]
            apart = _squared(self.x[own], centroids)
            best = apart.argmin(1)  # ties: the smaller number
            at_best = apart[np.arange(len(own)), best]
            apart[np.arange(len(own)), best] = np.iinfo(np.int64).max
            self.cluster[own] = best
            self.near[own], self.near_at[own] = np.sqrt(at_best.astype(np.float64)), now
            self.other[own], self.other_at[own] = np.sqrt(apart.min(1).astype(np.float64)), now


def _assigned(history: list[np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dims = history[0].shape[1]
        for batch in batches:
            column = lambda name: batch.column(name).to_numpy(zero_copy_only=False).copy()  # noqa: E731, B023
            lists = batch.column("x")
            block = Block(lists.flatten().to_numpy().reshape(-1, dims), *[column(c) for c in ("cluster", "near", "near_at", "other", "other_at")])
            was = block.cluster.copy()
            block.assign(history)
            distance = _own(block.x, history[-1], block.cluster)
            arrays = [batch.column("vec_id"), lists, block.cluster, was, block.near, block.near_at, block.other, block.other_at, distance]
            yield pa.RecordBatch.from_arrays([a if isinstance(a, pa.Array) else pa.array(a) for a in arrays], [c.split()[0] for c in _STATE.split(", ")])

    return run


def _changes(state: DataFrame, dims: int) -> list:
    """A row for each cluster that vectors joined or left: number, change of its size and of its sums. Only movers are added up."""
    parts = F.array(F.struct(F.col("cluster").alias("c"), F.lit(1).cast("long").alias("s")), F.struct(F.col("was").alias("c"), F.lit(-1).cast("long").alias("s")))
    moves = state.where("cluster <> was").select("x", F.inline(parts)).where("c >= 0")
    return moves.groupBy("c").agg(F.sum("s").alias("n"), *[F.sum(F.col("s") * F.col("x")[i]).alias(f"x{i}") for i in range(dims)]).collect()


def cluster(vectors: DataFrame, clusters: int = 40, rounds: int = 5, seed: str = "2", column: str = "embedding", dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """One row per kept vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Vectors (vec_id, an array column) with exactly `dimensions` components, none null or non-finite, are kept and become
    integers. Centroids start as the vectors of the smallest SHA-256 of `seed:vec_id`; each round assigns every vector to
    the nearest one (ties: the smaller number) and moves each to the floor of its mean, empty ones stay; then vectors are
    assigned once more. The driver holds centroids and their sums, `clusters` rows a round, never a vector otherwise.
    The state of a round is written to the shared folder, and the one before it is removed.

    Repeated rows count as often as they occur; a null vec_id is hashed as an empty text; fewer vectors than `clusters`
    give as many centroids as there are vectors; an empty table gives an empty table. Other columns aren't read. A
    component of 2**27 / scale or more raises an error: its squared distances don't fit a long.
    """
    spark = vectors.sparkSession
    fresh = quantised(vectors, column, dimensions, scale).select("vec_id", "x", F.lit(-1).alias("cluster"), F.lit(-1).alias("was"), F.lit(0.0).alias("near"), F.lit(0).alias("near_at"), F.lit(0.0).alias("other"), F.lit(0).alias("other_at"), F.lit(0).cast("long").alias("distance"))
    last = Scratch(spark)
    state = last.keep(fresh, "vectors")
    rank = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = state.select(rank.alias("rank"), "x").orderBy("rank", "x").limit(clusters).collect()  # the starting centroids
    if not first:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    history = [np.array([r.x for r in first], np.int64)]
    sums, sizes = [[0] * dimensions for _ in first], [0] * len(first)
    for at in range(rounds + 1):
        step = Scratch(spark)
        state = step.keep(state.mapInArrow(_assigned(history), _STATE), "round")
        last.drop()
        last = step
        if at == rounds:
            break
        for r in _changes(state, dimensions):
            sizes[r.c] += r.n
            sums[r.c] = [a + r[f"x{i}"] for i, a in enumerate(sums[r.c])]
        history.append(np.array([[v // n for v in s] if n else c.tolist() for s, n, c in zip(sums, sizes, history[-1], strict=True)], np.int64))
    inertia = {r.cluster: r.d for r in state.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in history[-1].tolist()]
    told = spark.createDataFrame([(c, d, sum(inertia.values()), digests[c]) for c, d in inertia.items()], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return state.select("vec_id", "cluster", "distance").join(told, "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
