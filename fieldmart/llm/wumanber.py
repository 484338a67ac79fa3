"""Benchmark decontamination: Wu-Manber multi-pattern search for windows of benchmark words in whole documents."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from fieldmart.llm.common import kept, worker_cache

WINDOW = 10
BLOCK = 2
"""Words that one entry of the shift table covers."""
ITEMS_AT_ONCE = 20_000
"""Items whose tables one pass over the documents holds in memory; more items are searched in further passes."""
BLOCK_BYTES = 32 << 20
"""Bytes of their texts, likewise."""

_WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")


def words_of(text: str | None) -> list[bytes]:
    """Words [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ of the text with A-Z lower-cased, as UTF-8: digits, a-z and all that isn't ASCII."""
    return _WORDS.findall(text.encode().lower()) if text else []


class Searcher:
    """Wu-Manber tables over sequences of words.

    The windows of one length share their tables. The shift table tells, from the last BLOCK words of the aligned stretch,
    how far the search may move; where it says 0, the bucket of that suffix names the windows to compare word by word.
    """

    def __init__(self, items: list[tuple[object, list[bytes]]], window: int = WINDOW) -> None:
        windows: dict[int, dict[tuple[bytes, ...], set]] = {}
        for item, words in items:
            for i in range(max(len(words) - window, 0) + 1 if words else 0):
                found = tuple(words[i : i + window])
                windows.setdefault(len(found), {}).setdefault(found, set()).add(item)
        self.tables = []
        for length, patterns in sorted(windows.items()):
            block = min(BLOCK, length)
            shifts: dict[tuple[bytes, ...], int] = {}
            buckets: dict[tuple[bytes, ...], list] = {}
            for pattern, owners in patterns.items():
                for end in range(block, length + 1):
                    part = pattern[end - block : end]
                    shifts[part] = min(shifts.get(part, length), length - end)
                buckets.setdefault(pattern[length - block :], []).append((list(pattern), owners))
            self.tables.append((length, block, shifts, buckets))

    def search(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Spans (start, end) of occurrences, and the items they are of."""
        spans, items = [], set()
        n = len(words)
        for length, block, shifts, buckets in self.tables:
            far = length - block + 1
            get, at = shifts.get, length
            while at <= n:
                part = (words[at - 2], words[at - 1]) if block == 2 else (words[at - 1],)
                move = get(part, far)
                if move:
                    at += move
                    continue
                start = at - length
                for pattern, owners in buckets[part]:
                    if words[start:at] == pattern:
                        spans.append((start, at))
                        items |= owners
                        break  # equal windows are one entry
                at += 1
        return spans, items


def _covered(spans: list[tuple[int, int]]) -> int:
    total, reached = 0, 0
    for start, end in sorted(spans):
        total += max(0, end - max(start, reached))
        reached = max(reached, end)
    return total


def _pass(key: str, block, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = worker_cache(key, lambda: Searcher([(item, words_of(text)) for item, text in block.value], window)).search
        for whole in batches:
            for at in range(0, whole.num_rows, 1_000):
                batch = whole.slice(at, 1_000)
                n_words, flat, n_hit, found = [], [], [], []
                for text in batch.column("text").to_pylist():
                    words = words_of(text)
                    spans, items = search(words)
                    n_words.append(len(words))
                    flat.append([x for s in spans for x in s])
                    n_hit.append(_covered(spans))
                    found.append(sorted(item for item in items if item is not None))
                columns = [pa.array(n_words, pa.int64()), pa.array(flat, pa.list_(pa.int32())), pa.array(n_hit, pa.int64()), pa.array(found, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays([batch.column("row"), *columns], ["row", "n_words", "spans", "n_hit", "items"])

    return run


def find_items(docs: DataFrame, items: DataFrame, window: int = WINDOW, items_at_once: int = ITEMS_AT_ONCE) -> DataFrame:
    """docs rows (row, of any type) with n_words, n_hit, items (sorted strings), spans (flat start, end word positions).

    A window is `window` consecutive item words; an item of fewer words, but not none, is one window; null texts have no
    words; an item without an id counts for n_hit and isn't among the items. Items (item_id, text) go to the executors in
    blocks of about `items_at_once` items and BLOCK_BYTES of text at most, so what is broadcast is bounded; a longer item
    is a block of its own. Several blocks are searched one after another, each released before the next: the rows are
    numbered and written, the hits of each block are written, and they are joined by these numbers, so that each row
    stands alone, whatever `row` is, and the number of blocks changes no result.
    """
    spark = docs.sparkSession
    listed = items.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("text")).where("text is not null").distinct()
    size = listed.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    blocks = max(-(-size.n // items_at_once), -(-size.bytes // BLOCK_BYTES), 1)

    def searched(rows: DataFrame, block: DataFrame) -> tuple[DataFrame, Broadcast]:
        sent = spark.sparkContext.broadcast([(r.item, r.text) for r in block.orderBy("item", "text").collect()])
        schema = StructType([StructField("row", rows.schema["row"].dataType)]).add("n_words", "long").add("spans", ArrayType(IntegerType())).add("n_hit", "long").add("items", ArrayType(StringType()))
        return rows.mapInArrow(_pass(uuid.uuid4().hex, sent, window), schema), sent

    if blocks == 1:
        return searched(docs.select("row", "text"), listed)[0]
    written = kept(docs.select(F.monotonically_increasing_id().alias("_key"), "row", "text"), "numbered")
    numbered = written.select(F.col("_key").alias("row"), "text")
    every, counted = None, None
    for k in range(blocks):
        found, sent = searched(numbered, listed.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k))
        found = kept(found if k == 0 else found.where("size(spans) > 0"), "hits")
        sent.destroy()
        hits = found.where("size(spans) > 0").select("row", "spans", "items")
        every, counted = (hits, found.select(F.col("row").alias("_key"), "n_words")) if k == 0 else (every.unionByName(hits), counted)
    merged = every.groupBy(F.col("row").alias("_key")).agg(F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("items")).alias("found"))  # one document's own
    covered = "size(array_distinct(flatten(transform(sequence(0, cast(size(spans) / 2 as int) - 1), i -> sequence(spans[2 * i], spans[2 * i + 1] - 1)))))"
    whole = written.select("_key", "row").join(counted, "_key").join(merged, "_key", "left")
    hit = F.when(F.size("spans") > 0, F.expr(covered)).otherwise(0).cast("long")
    return whole.select("row", "n_words", F.coalesce("spans", F.array().cast("array<int>")).alias("spans"), hit.alias("n_hit"), F.coalesce(F.array_sort(F.array_distinct("found")), F.array().cast("array<string>")).alias("items"))


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, items_at_once: int = ITEMS_AT_ONCE) -> DataFrame:
    """Per row of docs: doc_id, n_words, n_hit (words inside an occurrence of a window), n_items, items, contaminated."""
    rows = docs.select(F.col("doc_id").cast("long").alias("row"), F.col("text").cast("string").alias("text"))
    found = find_items(rows, items, window, items_at_once)
    return found.select(F.col("row").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items", (F.col("n_hit") > 0).alias("contaminated"))


def uncontaminated(docs: DataFrame, items: DataFrame, most_hit: float, window: int = WINDOW, items_at_once: int = ITEMS_AT_ONCE) -> DataFrame:
    """The rows of docs of whose words at most the share most_hit is inside an occurrence of a window; each row is judged by its own text."""
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("text").cast("string").alias("text"))
    return find_items(rows, items, window, items_at_once).where(F.col("n_hit") <= F.col("n_words") * most_hit).select("row.*")
