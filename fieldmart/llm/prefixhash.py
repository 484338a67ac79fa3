"""Document fingerprints from prefix polynomial hashes: span equality, longest common extensions, and sketches of spans."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PRIME = (1 << 31) - 1
BASES = (1_103_515_245, 742_938_285)
SPAN = 12
"""Code points of the spans whose hashes a fingerprint samples."""
SKETCH = 64
"""Span hashes of a fingerprint: the smallest ones."""

_P = np.uint64(PRIME)
_S31 = np.uint64(31)
_powers: dict[int, np.ndarray] = {}


def _fold(x: np.ndarray) -> np.ndarray:
    """x modulo the Mersenne prime, for x below 2**62."""
    x = (x & _P) + (x >> _S31)
    return np.where(x >= _P, x - _P, x)


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**n modulo the prime, by doubling."""
    have = _powers.get(base)
    if have is None or len(have) <= n:
        out = np.ones(1, np.uint64)
        while len(out) <= max(n, 4096):
            step = np.uint64(pow(base, len(out), PRIME))
            out = np.concatenate([out, _fold(_fold(out * step))])
        have = _powers[base] = out
    return have


class PrefixHashes:
    """h[i]: hash of the first i code points, h[i + 1] = h[i] * base + code. Two bases together make a 62-bit hash of any span."""

    def __init__(self, text: str, bases: tuple[int, ...] = BASES) -> None:
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)
        self.n, self.bases = len(codes), bases
        self.h = []
        for base in bases:
            up, down = powers(base, self.n + 1), powers(pow(base, -1, PRIME), self.n + 1)
            sums = np.cumsum(_fold(codes * down[1 : self.n + 1]))  # below 2**63 for texts of less than 2**32 code points
            h = np.zeros(self.n + 1, np.uint64)
            h[1:] = _fold(_fold(_fold(_fold(sums)) * up[1 : self.n + 1]))
            self.h.append(h)

    def span(self, start: int, end: int) -> tuple[int, ...]:
        """Hash of text[start:end]; equal spans, in whatever texts, have equal hashes."""
        return tuple((int(h[end]) - int(h[start]) * int(powers(b, end - start)[end - start])) % PRIME for b, h in zip(self.bases, self.h, strict=True))

    def extension(self, at: int, other: "PrefixHashes", place: int) -> int:
        """Longest common extension: code points from `at` here and `place` there that are the same, by binary search."""
        low, high = 0, min(self.n - at, other.n - place)
        while low < high:
            mid = (low + high + 1) // 2
            if self.span(at, at + mid) == other.span(place, place + mid):
                low = mid
            else:
                high = mid - 1
        return low

    def spans(self, size: int) -> np.ndarray:
        """Hashes, under the first base, of all spans of the size (of the whole text where it is shorter)."""
        size = min(size, self.n)
        h, step = self.h[0], powers(self.bases[0], size)[size]
        return _fold(h[size:] + (_P - _fold(_fold(h[: self.n + 1 - size] * step)))) if self.n else np.empty(0, np.uint64)


def fingerprint(text: str, hashes: PrefixHashes | None = None) -> str:
    """length . hash of the whole text . the smallest mixed hashes of its spans, in hex; equal texts have equal fingerprints."""
    hashes = hashes or PrefixHashes(text)
    whole = "".join(f"{x:08x}" for x in hashes.span(0, hashes.n))
    mixed = (hashes.spans(SPAN) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
    if len(mixed) > 8 * SKETCH:  # the smallest are found among those below a bound, as a rule
        low = np.unique(mixed[mixed < np.uint64((SKETCH * 4 << 32) // len(mixed))])
        mixed = low if len(low) >= SKETCH else np.unique(mixed)
    else:
        mixed = np.unique(mixed)
    return f"{hashes.n:x}.{whole}." + mixed[:SKETCH].astype(">u4").tobytes().hex()


def likeness(one: str, two: str) -> float:
    """Share (0 to 1) of spans that two fingerprints' texts have in common, 2 J / (1 + J) of the Jaccard estimate from the sketches; 1 for equal texts."""
    if one == two:
        return 1.0
    a, b = (bytes.fromhex(x.rpartition(".")[2]) for x in (one, two))
    a_set, b_set = ({s[i : i + 4] for i in range(0, len(s), 4)} for s in (a, b))
    least = sorted(a_set | b_set)[:SKETCH]
    if not least or not a_set or not b_set:
        return 0.0
    both = sum(x in a_set and x in b_set for x in least)
    j = both / len(least)
    return 2 * j / (1 + j)


def edited(text: str, other: str) -> str:
    """text with its last floor(n / 2) code points replaced by the first as many (or all) of the other."""
    half = len(text) // 2
    return text[: len(text) - half] + other[:half]


_SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, prefix_edited long, prefix_next long"
_COLUMNS = [c.split()[0] for c in _SCHEMA.split(", ")]
BUCKET_BYTES = 64 << 20
"""Input bytes for each bucket, about."""


def _in_order(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come by bucket, then order; the rows that look ahead close a bucket. One row is held back at a time."""
    held = None  # (bucket, doc_id, text, hashes, fingerprint) that waits for its next document
    for batch in batches:
        for at in range(0, len(batch), 500):
            out = []
            part = batch.iloc[at : at + 500]
            for bucket, ahead, doc, text in zip(part["bucket"], part["ahead"], part["doc_id"], part["text"], strict=True):
                if ahead and (held is None or held[0] != bucket):
                    continue  # the bucket is closed
                hashes = PrefixHashes(text)
                own = fingerprint(text, hashes)
                if held is not None and held[0] == bucket:
                    changed = edited(held[2], text)
                    new = PrefixHashes(changed)
                    changed_print = fingerprint(changed, new)
                    digest = hashlib.sha256(changed.encode()).hexdigest()
                    out.append((held[1], held[3].n, digest, held[4], changed_print, likeness(held[4], changed_print), likeness(held[4], own), held[3].extension(0, new, 0), held[3].extension(0, hashes, 0)))
                held = None if ahead else (bucket, doc, text, hashes, own)
            yield pd.DataFrame(out, columns=_COLUMNS).astype({"doc_id": "Int64"})


def _literal(values: list, kind: str) -> str:
    """SQL of one array literal, however many values it has."""
    return f"from_json('{json.dumps(values)}', '{kind}')"


def _bucket(bounds: list[int]) -> str:
    """SQL for the number of bounds below `key`, in two steps so that the work per row is the square root of their number."""
    step = max(1, int(len(bounds) ** 0.5))
    parts = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    outer = f"size(filter({_literal([p[0] for p in parts[1:]], 'array<bigint>')}, b -> b < key))"
    return f"({outer}) * {step} + size(filter(element_at({_literal(parts, 'array<array<bigint>>')}, {outer} + 1), b -> b < key))"


def _keys(spark: SparkSession, n: int) -> list[int]:
    """For each of n partitions a number that Spark's hash partitioning puts there, so that no two buckets share one."""
    numbers = spark.range(50 * n).select(F.col("id").cast("int").alias("id"), F.expr(f"pmod(hash(cast(id as int)), {n})").alias("at"))
    found = {r["at"]: r.id for r in numbers.groupBy("at").agg(F.min("id").alias("id")).collect()}  # one row for each bucket
    return [found.get(i, i) for i in range(n)]


def fingerprints(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """Per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, prefix_edited, prefix_next.

    The next document is that of the next doc_id (rows of one doc_id go by text, null ids come first); after the last, the
    first. Texts are shuffled once, into buckets between quantiles of doc_id, one to a task and as many as the input's size
    asks for; the first rows of each bucket also go to the bucket before it. The rows of one doc_id, and those without any,
    are in one bucket: ids are meant to be unique. Likenesses compare fingerprints; the prefixes are the longest common
    extensions from the start of the texts. Null texts are empty. A sole document is its own next one.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).withColumn("key", F.coalesce("doc_id", F.lit(-(2**63) + 1)))
    size = int(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    size = size if size < 1 << 60 else 0  # Spark does not know the size of every plan
    buckets = buckets or max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), min(size // BUCKET_BYTES, 100_000))
    keys = rows.select("key")
    points = keys.stat.approxQuantile("key", [i / buckets for i in range(1, buckets)], 0.1 / buckets)
    bounds = sorted({int(p) for p in points}) or [0]
    placed = rows.withColumn("bucket", F.expr(_bucket(bounds)))
    firsts = {r.bucket: r.low for r in placed.groupBy("bucket").agg(F.min("key").alias("low")).collect()}  # one row for each bucket
    if not firsts:
        return spark.createDataFrame([], _SCHEMA)
    used = sorted(firsts)
    before = {b: used[i - 1] for i, b in enumerate(used)}
    low, prior = _literal([firsts.get(b, 0) for b in range(used[-1] + 1)], "array<bigint>"), _literal([before.get(b, 0) for b in range(used[-1] + 1)], "array<int>")
    places = F.expr(f"if(key = element_at({low}, bucket + 1), array(struct(bucket, false as ahead), struct(element_at({prior}, bucket + 1) as bucket, true as ahead)), array(struct(bucket, false as ahead)))")
    n = used[-1] + 1
    dealt = placed.select("doc_id", "text", "key", F.inline(places)).withColumn("place", F.expr(f"element_at({_literal(_keys(spark, n), 'array<int>')}, bucket + 1)"))
    ordered = dealt.repartition(n, "place").sortWithinPartitions("bucket", "ahead", "key", "text")
    return ordered.select("bucket", "ahead", "doc_id", "text").mapInPandas(_in_order, _SCHEMA)
