"""Near-duplicate documents by circulant MinHash: banding for candidates, exact Jaccard for links, components for classes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldmart.llm.common import Scratch, kept, worker_cache
from fieldmart.llm.components import SALTS, components, dealt

BANDS, ROWS = 42, 6
"""At similarity 0.8 a pair meets in no band with probability (1 - 0.8**6)**42 < 3e-6; at 0.3 it meets in one in 3 cases of 100."""

_MOST_WORDS = 150_000


class _WordHash(dict):
    """64-bit hash by word; a cache that is emptied when it is full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _MOST_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], dtype=np.uint64)


def shingle_set(text: str | None, words_per_shingle: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles. bytes.lower() folds A-Z alone and bytes.split() cuts at x20, x09-x0D."""
    words = text.encode().lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < words_per_shingle:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], dtype=np.uint64)
    one = np.fromiter(map(worker_cache("word hashes", _WordHash).__getitem__, words), np.uint64, len(words))
    n = len(words) - words_per_shingle + 1
    mixed = np.zeros(n, np.uint64)
    for i in range(words_per_shingle):
        mixed += one[i : i + n] * _MIX[i % 5]
        mixed ^= mixed >> np.uint64(29)
        mixed *= _MIX[(i + 2) % 5]
    mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed)


def signature(values: np.ndarray, size: int) -> np.ndarray:
    """Circulant MinHash: a first permutation of the 32-bit universe, then a second one, circularly shifted for each coordinate."""
    first = (values ^ (values >> np.uint64(32))).astype(np.uint32)
    first *= np.uint32(0x85EBCA6B)
    first ^= first >> np.uint32(13)
    first *= np.uint32(0xC2B2AE35)
    first ^= first >> np.uint32(16)
    shifts = (np.arange(size, dtype=np.uint64) * np.uint64((1 << 32) // size | 1)).astype(np.uint32)
    least = np.full(size, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(first), 2048):  # bounds the memory that a very long document takes
        x = first[None, at : at + 2048] + shifts[:, None]
        x *= np.uint32(0x7FEB352D)
        x ^= x >> np.uint32(15)
        x *= np.uint32(0x846CA68B)
        x ^= x >> np.uint32(16)
        np.minimum(least, x.min(axis=1), out=least)
    return least


def _bands(least: np.ndarray) -> np.ndarray:
    rows = least.reshape(BANDS, ROWS).astype(np.uint64)
    key = np.arange(1, BANDS + 1, dtype=np.uint64) * _MIX[0]
    for i in range(ROWS):
        key = (key ^ rows[:, i]) * _MIX[1 + i % 4]
        key ^= key >> np.uint64(31)
    return key.view(np.int64)


SIGNED = "doc_id long, text_key long, n_shingles long, set_key binary, bands array<long>"
_SLICE = 500
"""Rows that leave a Python worker at once; bounds its memory."""


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, _SLICE):
            yield batch.slice(at, _SLICE)


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*arrays, np.empty(0, np.int64)])))


def _set_key(values: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(values.tobytes()) if len(values) else None


def _signed(words_per_shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.empty(0, np.int64)
        for batch in _slices(batches):
            sizes, keys, bands = [], [], []
            for text in batch.column("text").to_pylist():
                values = shingle_set(text, words_per_shingle)
                sizes.append(len(values))
                keys.append(_set_key(values))
                bands.append(_bands(signature(values, BANDS * ROWS)) if len(values) else none)
            columns = [batch.column("doc_id"), batch.column("text_key"), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), _lists(bands)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_key", "n_shingles", "set_key", "bands"])

    return run


def _sets(words_per_shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            sets = [shingle_set(t, words_per_shingle) for t in batch.column("text").to_pylist()]
            keys = pa.array([_set_key(values) for values in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([keys, _lists([values.view(np.int64) for values in sets])], ["set_key", "items"])

    return run


def _close(a: str, b: str, percent: int) -> str:
    """Sets whose sizes differ too much for the threshold can't be linked."""
    return f"least({a}, {b}) * 100 >= greatest({a}, {b}) * {percent}"


def _starred(rows: DataFrame) -> DataFrame:
    """rows (band, node, n, weight) with the node of the greatest weight in each band, as pivot and pivot_n.

    Pivots are found by an aggregate, which combines before its shuffle, and joined back: a band of any size is split.
    """
    first = rows.groupBy("band").agg(F.max(F.struct("weight", -F.col("node"), "n")).alias("_first"))
    return rows.join(first.select("band", (-F.col("_first")["col2"]).alias("pivot"), F.col("_first")["n"].alias("pivot_n")), "band")


def _star_links(rows: DataFrame, sets: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """Links (a, b) of nodes with their pivots, from the full sets."""
    pairs = rows.where("node <> pivot").where(_close("n", "pivot_n", percent)).select("node", "pivot").distinct()
    both = pairs.join(sets, "node").join(sets.select(F.col("node").alias("pivot"), F.col("items").alias("pivot_items")), "pivot")
    shared = both.select("node", "pivot", F.size(F.array_intersect("items", "pivot_items")).alias("shared"), (F.size("items") + F.size("pivot_items")).alias("total"))
    return scratch.keep(shared.where(f"100 * shared >= {percent} * (total - shared)").select(F.col("node").alias("a"), F.col("pivot").alias("b")), "stars")


def _left_over(open_: DataFrame, sets: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """Links (a, b) of nodes around one pivot that are still in different components, without comparing all pairs.

    A node is held as its difference from the pivot's set: d items that only one of the two has. For two nodes,
    |difference| = d_a + d_b - 2 * (items that both differences have), and the threshold asks for
    (100 + percent) * |difference| <= (100 - percent) * (n_a + n_b). With w = (100 + percent) * d - (100 - percent) * n:

    - w_a + w_b <= 0 is a link for certain. Each node of such a pair then has one with the node of the least w, so a
      single row around the pivot stands for all of these pairs.
    - otherwise both differences share at least need = ceil((w_a + w_b) / (2 * (100 + percent))) items. These are put in
      order, the rarest around the pivot first: the first shared item has at least need - 1 items after it in both, and
      only pairs that meet in such an item are looked at, and confirmed on the whole differences.
    """
    members = open_.where("node <> pivot").select("pivot", "node", "n", "label", "main").distinct()
    both = members.join(sets, "node").join(sets.select(F.col("node").alias("pivot"), F.col("items").alias("pivot_items")), "pivot")
    apart = both.select("pivot", "node", "n", "label", "main", F.concat(F.array_except("items", "pivot_items"), F.array_except("pivot_items", "items")).alias("items"))
    apart = scratch.keep(apart.withColumn("d", F.size("items")).withColumn("w", F.expr(f"{100 + percent} * d - {100 - percent} * n")), "differences")

    least = scratch.keep(apart.groupBy("pivot").agg(F.min(F.struct("w", "node", "label")).alias("least")).select("pivot", "least.*").toDF("pivot", "least_w", "least_node", "least_label"), "least")
    small = apart.select("pivot", "node", "n", "label", "main", "d", "w").join(least, "pivot")
    certain = small.where("node <> least_node and label <> least_label and w + least_w <= 0").select(F.col("node").alias("a"), F.col("least_node").alias("b"))

    items = apart.select("pivot", "node", F.explode("items").alias("item"))
    held = items.groupBy("pivot", "item").agg(F.count("*").alias("holders")).where("holders > 1")
    common = items.join(held, ["pivot", "item"]).groupBy("pivot", "node").agg(F.array_sort(F.collect_list(F.struct("holders", "item"))).alias("common"))  # a document's own items
    need = f"greatest(1, ceil((w + least_w) / {2 * (100 + percent)}))"
    placed = small.join(common, ["pivot", "node"]).select("pivot", "node", "n", "label", "main", "w", F.expr(f"d - {need} + 1").alias("last"), "d", F.posexplode("common").alias("at", "one"))
    placed = placed.join(common.select("pivot", "node", F.size("common").alias("many")), ["pivot", "node"]).withColumn("after", F.col("many") - F.col("at"))  # items from this one on
    placed = scratch.keep(placed.where("d - after + 1 <= last").select("pivot", F.col("one.item").alias("item"), "node", "n", "label", "main", "w", "after"), "prefixes")
    needed = f"ceil((a.w + b.w) / {2 * (100 + percent)})"
    meet = f"a.pivot = b.pivot and a.item = b.item and a.label <> b.label and (b.label = b.main or a.node < b.node) and {_close('a.n', 'b.n', percent)} and a.w + b.w > 0 and least(a.after, b.after) >= {needed}"
    pairs = placed.where("label <> main").alias("a").join(placed.alias("b"), F.expr(meet)).select("a.pivot", F.col("a.node").alias("a"), F.col("b.node").alias("b")).distinct()
    one = pairs.join(apart.select("pivot", F.col("node").alias("a"), F.col("items").alias("a_items"), F.col("w").alias("a_w")), ["pivot", "a"])
    two = one.join(apart.select("pivot", F.col("node").alias("b"), F.col("items").alias("b_items"), F.col("w").alias("b_w")), ["pivot", "b"])
    found = two.where(F.col("a_w") + F.col("b_w") <= 2 * (100 + percent) * F.size(F.array_intersect("a_items", "b_items"))).select("a", "b")
    return scratch.keep(certain.unionByName(found).distinct(), "more")


def _compared(docs: DataFrame, words_per_shingle: int, percent: int) -> DataFrame:
    """(doc_id, text_key, n_shingles, component_id, kept) for each row of docs."""
    scratch = Scratch(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = kept(rows.select("doc_id", F.xxhash64("text").alias("text_key"), "text").mapInArrow(_signed(words_per_shingle), SIGNED), "signed")
    nodes = signed.where("n_shingles > 0 and doc_id is not null").groupBy("set_key").agg(F.min("doc_id").alias("doc"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"))
    nodes = kept(nodes.withColumn("node", F.xxhash64("set_key")), "nodes")
    banded = nodes.select("node", "n", F.explode("bands").alias("band"))
    met = scratch.keep(banded.join(banded.groupBy("band").agg(F.count("*").alias("met")).where("met > 1"), "band"), "met")
    buckets = scratch.keep(_starred(met.join(met.groupBy("node").agg(F.sum("met").alias("weight")), "node").drop("met")), "buckets")

    candidates = nodes.join(buckets.select("node").distinct(), "node", "left_semi").select("doc").distinct()
    texts = rows.join(candidates, rows.doc_id == candidates.doc, "left_semi")
    sets = texts.mapInArrow(_sets(words_per_shingle), "set_key binary, items array<long>").where("size(items) > 0")
    sets = scratch.keep(sets.select(F.xxhash64("set_key").alias("node"), "items"), "sets")

    found = _star_links(buckets, sets, percent, scratch)
    labels = components(found)

    def apart(labels: DataFrame) -> DataFrame:
        """Rows of the buckets in which more than one component is left; main is the pivot's."""
        placed = scratch.keep(buckets.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")), "placed")
        spread = placed.groupBy("band").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.max(F.when(F.col("node") == F.col("pivot"), F.col("label"))).alias("main"))
        return placed.join(spread.where("low <> high").select("band", "main"), "band")

    second = _star_links(_starred(apart(labels).where("label <> main").drop("pivot", "pivot_n")), sets, percent, scratch)
    links = scratch.keep(found.unionByName(second), "links")
    labels = components(links)
    more = _left_over(apart(labels), sets, percent, scratch)
    if not more.isEmpty():
        labels = components(links.unionByName(more))
    scratch.drop()

    linked = labels.join(nodes.select("node", "doc"), "node").withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int"))
    least = linked.groupBy("label").agg(F.min("doc").alias("least"))
    roots = linked.join(dealt(least), ["label", "salt"]).select("node", "least")
    named = nodes.join(roots, "node", "left").select("set_key", F.coalesce("least", "doc").alias("label"))
    out = signed.select("doc_id", "text_key", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("set_key")).alias("set_key")).join(named, "set_key", "left")
    component = F.coalesce("label", "doc_id")
    return out.select("doc_id", "text_key", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def near_duplicates(docs: DataFrame, words_per_shingle: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the smallest doc_id reachable by links), kept.

    Documents are linked when 100 * shared >= percent * united of their distinct word shingles. Equal sets form one node,
    so copies are never expanded into pairs. In each bucket of a band all nodes are first compared with its most central
    node (its pivot), then those left out with the most central of them. Pairs around a pivot that are still in different
    components then meet over the rarest items in which they differ from it. No bucket, partner or candidate is capped,
    and every link is confirmed on full sets, or on full differences from the pivot's.

    Null or blank texts: n_shingles 0, linked with nothing, kept. Null doc_id: linked with nothing, component_id null,
    kept. Rows of one doc_id follow each the links of their own text. Other columns of docs are not read.
    """
    return _compared(docs, words_per_shingle, percent).drop("text_key")


def first_of_each(docs: DataFrame, words_per_shingle: int = 5, percent: int = 80) -> DataFrame:
    """docs without the rows that a smaller doc_id of their component stands for.

    A row goes by its own doc_id and text: another text under the same doc_id stays if nothing stands for it. Rows without
    a doc_id stay, and so do repeated rows of one doc_id and text, which are one document.
    """
    gone = _compared(docs, words_per_shingle, percent).where(~F.col("kept")).select("doc_id", "text_key").distinct()
    keyed = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("text_key"))
    return keyed.join(gone, ["doc_id", "text_key"], "left_anti").select("row.*")
