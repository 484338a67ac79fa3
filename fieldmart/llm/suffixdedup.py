"""Removal of byte strings that occur more than once in a corpus, by suffix arrays over shards of it.

Every string of `length` bytes has a key, the smallest hash among its stretches of GRAM bytes, so equal strings have equal
keys wherever they are. Neighbouring strings that have it from the same stretch are one piece of text. Pieces whose key occurs once hold nothing
that repeats and stay where they are; of the others each distinct one goes, with its bytes, to the shard of its key, where
external induced sorting puts equal strings next to each other (see inducedsort). Keys that very many distinct pieces
have are split further, into single strings dealt by the hash of the whole string.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldmart.llm.common import Scratch, parts_of, shared_folder
from fieldmart.llm.inducedsort import on_disk, sorted_suffixes

LENGTH, GRAM = 200, 64
HEAVY = 20_000
"""Distinct pieces of one key, more than half a shard, beyond which they are split into single strings."""
SHARD_BYTES = 8 << 20
BUCKET_BYTES = 64 << 20
MEMORY = 48 << 20
"""Bytes that each queue of a shard holds before it goes to disk."""
_STEP = 1 << 20
_POWER = 0x9E3779B97F4A7C15


@lru_cache(2)
def _first_powers(base: int) -> np.ndarray:
    out = np.full(_STEP, np.uint64(base))
    out[0] = 1
    return np.multiply.accumulate(out)


def _powers(base: int, n: int) -> np.ndarray:
    known = _first_powers(base)
    if n <= len(known):
        return known[:n]
    out = np.full(n, np.uint64(base))
    out[0] = 1
    return np.multiply.accumulate(out)


def _least(values: np.ndarray, wide: int) -> np.ndarray:
    """Minimum of every run of `wide` values: of runs of 1, 2, 4, ... values, two of which overlap."""
    size = 1
    while 2 * size <= wide:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    return np.minimum(values[: len(values) - (wide - size)], values[wide - size :])


def keys_of(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """For each place of data but the last length - 1: the smallest hash among the grams of the string that starts there, and whether the first gram has it."""
    n, wide = len(data) - gram + 1, length - gram + 1
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(_POWER, len(data)), out=sums[1:])
    hashes = (sums[gram:] - sums[:n]) * _powers(pow(_POWER, -1, 1 << 64), n)
    hashes ^= hashes >> np.uint64(32)
    hashes *= np.uint64(0xD6E8FEB86659FD93)
    hashes ^= hashes >> np.uint64(32)
    least = _least(hashes, wide)
    return least.view(np.int64), hashes[: len(least)] == least


def _texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a binary column, and where each row starts."""
    if not len(column):  # it may have no buffer of ends
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    return data, ends - ends[0]


def _steps(ends: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about _STEP bytes."""
    at = 0
    while at < len(ends) - 1:
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + _STEP, "right")) - 1)
        yield at, to
        at = to


_PIECES = "row long, start int, owned int, key long, content long"


def _cut(length: int, gram: int):
    """Pieces of each text: `owned` strings from `start` on that have their key from one and the same gram, the first that has it. Equal strings in one text are in different pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, ends = _texts(batch.column("data"))
            ids = batch.column("row").to_numpy()
            for at, to in _steps(ends):
                many = np.maximum(np.diff(ends[at : to + 1]) - length + 1, 0)  # strings of each text
                if not many.any():
                    continue
                part, base = data[ends[at] : ends[to]], ends[at]
                keys, leads = keys_of(part, length, gram)
                text = np.repeat(np.arange(at, to), many)
                place = np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many)
                at_byte = ends[text] - base + place
                keys, leads = keys[at_byte], leads[at_byte]
                first = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]) | leads[:-1] | (text[1:] != text[:-1])]))
                owned = np.diff([*first, len(keys)])
                low = ends[text[first]] - base + place[first]
                view = memoryview(part)
                content = np.fromiter((xxhash.xxh3_64_intdigest(view[a:b]) for a, b in zip(low.tolist(), (low + owned + length - 1).tolist(), strict=True)), np.uint64, len(first))
                yield pa.RecordBatch.from_arrays([pa.array(ids[text[first]]), pa.array(place[first].astype(np.int32)), pa.array(owned.astype(np.int32)), pa.array(keys[first]), pa.array(content.view(np.int64))], ["row", "start", "owned", "key", "content"])

    return run


_SHIPPED = "key long, content long, fine boolean, owned int, copies int, data binary"


def _shipped(length: int):
    """The bytes of the pieces that are wanted of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, ends = _texts(batch.column("data"))
            view = memoryview(data)
            for at, to in _steps(ends):
                lists = batch.column("wanted").slice(at, to - at)
                wanted = lists.flatten()
                column = {f: wanted.field(f) for f in ("start", "owned", "key", "content", "fine", "copies")}
                low = np.repeat(ends[at:to], lists.value_lengths().to_numpy()) + column["start"].to_numpy()
                texts = [bytes(view[a:b]) for a, b in zip(low.tolist(), (low + column["owned"].to_numpy() + length - 1).tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([*(column[c] for c in ("key", "content", "fine", "owned", "copies")), pa.array(texts, pa.binary())], [c.split()[0] for c in _SHIPPED.split(", ")])

    return run


_STRINGS = "row long, place int, key long, content long, at int, n long, string long"


def _strings(length: int):
    """Every single string of the pieces wanted of each text, with its hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                view = memoryview(batch.column("data")[i].as_buffer())
                wanted = batch.column("wanted").slice(i, 1).flatten()
                column = {f: wanted.field(f).to_numpy() for f in ("start", "owned", "key", "content", "n")}
                owned = column["owned"]
                at = np.arange(owned.sum()) - np.repeat(np.cumsum(owned) - owned, owned)
                place = np.repeat(column["start"], owned) + at
                hashes = np.fromiter((xxhash.xxh3_64_intdigest(view[p : p + length]) for p in place.tolist()), np.uint64, len(place))
                row = np.full(len(at), batch.column("row")[i].as_py(), np.int64)
                yield pa.RecordBatch.from_arrays([*map(pa.array, (row, place.astype(np.int32), *(np.repeat(column[c], owned) for c in ("key", "content")), at.astype(np.int32), np.repeat(column["n"], owned), hashes.view(np.int64)))], [c.split()[0] for c in _STRINGS.split(", ")])

    return run


def repeated_in(text: np.ndarray, starts: np.ndarray, owned: np.ndarray, copies: np.ndarray, length: int, limit: int = MEMORY) -> np.ndarray:
    """Which places of text start a string of `length` bytes that occurs more than once. The first owned[i] places from starts[i] on count, each as often as the piece has copies; strings that begin elsewhere don't."""
    repeated, weight = on_disk(len(text), np.bool_, limit), on_disk(len(text), np.uint8, limit)
    for at in range(0, len(starts), 20_000):  # a place has its string's copies, two stand for more, or none if it doesn't count
        low, many = starts[at : at + 20_000], owned[at : at + 20_000].astype(np.int64)
        weight[np.repeat(low - np.cumsum(many) + many, many) + np.arange(many.sum())] = np.repeat(np.minimum(copies[at : at + 20_000], 2), many)
    held, waiting = 0, -1  # occurrences in the group that is open at the end of a block, and the place of a sole one
    for places, prefix in sorted_suffixes(text, length, limit):
        group = np.cumsum(prefix < length)
        times = weight[places]
        mine = np.flatnonzero(times)
        own, of = places[mine], group[mine]
        many = np.bincount(of, times[mine], minlength=int(group[-1]) + 1).astype(np.int64)
        first = own[np.searchsorted(of, len(many) - 1)] if many[-1] else -1
        many[0] += held
        repeated[own[many[of] > 1]] = True
        if held == 1 and many[0] > 1:
            repeated[waiting] = True
        if len(many) > 1:
            held, waiting = int(many[-1]), int(first)
        else:
            held, waiting = int(many[0]), waiting if held else int(first)
    return repeated


_FOUND = "key long, content long, fine boolean, lows array<int>, highs array<int>"


def _found(length: int):
    """One shard: its pieces behind one another, sorted, and of each piece the runs of strings that repeat."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        with tempfile.TemporaryFile() as file:  # of this task alone, without a name
            for batch in batches:
                data, ends = _texts(batch.column("data"))
                file.write(memoryview(data))
                parts.append((size + ends[:-1], *(batch.column(c).to_numpy(zero_copy_only=False) for c in ("owned", "copies", "key", "content", "fine"))))
                size += len(data)
            if not size:
                return
            file.flush()
            start, owned, copies, key, content, fine = (np.concatenate(p) for p in zip(*parts, strict=True))
            repeated = repeated_in(np.memmap(file, np.uint8, "r", shape=(size,)), start, owned, copies, length)
            for at in range(0, len(start), 20_000):
                to = min(at + 20_000, len(start))
                many = owned[at:to].astype(np.int64)
                inside = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                of = np.repeat(np.arange(to - at), many)
                hit = repeated[start[at:to][of] + inside]
                edge = np.concatenate([[True], of[1:] != of[:-1]])
                low = np.flatnonzero(hit & (edge | ~np.concatenate([[False], hit[:-1]])))
                high = np.flatnonzero(hit & (np.concatenate([edge[1:], [True]]) | ~np.concatenate([hit[1:], [False]])))
                some = np.unique(of[low])
                ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(of[low], minlength=to - at)[some])]).astype(np.int32))
                lists = [pa.ListArray.from_arrays(ends, pa.array(inside[x].astype(np.int32))) for x in (low, high)]
                yield pa.RecordBatch.from_arrays([pa.array(key[at:to][some]), pa.array(content[at:to][some]), pa.array(fine[at:to][some]), *lists], [c.split()[0] for c in _FOUND.split(", ")])

    return run


_KEPT = "doc_id long, n_bytes long, removed array<struct<start:int,end:int>>, kept binary"


def _without(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                data, ends = _texts(batch.column("data"))
                spans = batch.column("spans")
                of = np.repeat(np.arange(len(spans)), spans.value_lengths().fill_null(0).to_numpy())
                low, high = (ends[of] + spans.flatten().field(f).to_numpy() for f in ("low", "high"))  # by low in each text
                reach = np.maximum.accumulate(high + length)
                head = np.flatnonzero(np.concatenate([[True], (of[1:] != of[:-1]) | (low[1:] > reach[:-1])])[: len(of)])
                last = np.append(head[1:], len(of))[: len(head)] - 1
                low, high, of = low[head], reach[last], of[head]
                edges = np.concatenate([[0], np.column_stack([low, high]).ravel(), [len(data)]])
                kept = data[np.repeat(np.arange(len(edges) - 1) % 2 == 0, np.diff(edges))]
                gone = np.bincount(of, high - low, minlength=len(spans)).astype(np.int64)
                left = (ends - np.concatenate([[0], np.cumsum(gone)])).astype(np.int32)
                runs = pa.StructArray.from_arrays([pa.array((x - ends[of]).astype(np.int32)) for x in (low, high)], ["start", "end"])
                removed = pa.ListArray.from_arrays(pa.array(np.searchsorted(of, np.arange(len(spans) + 1)).astype(np.int32)), runs)
                texts = pa.Array.from_buffers(pa.binary(), len(spans), [None, pa.py_buffer(left), pa.py_buffer(kept)])
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.diff(ends)), removed, texts], ["doc_id", "n_bytes", "removed", "kept"])

    return run


def _bucketed(docs: DataFrame) -> DataFrame:
    """(row, doc_id, data) in files by the hash of row: joins on row don't shuffle the texts again. As many files as the input's size asks for."""
    spark = docs.sparkSession
    parts = parts_of(docs, BUCKET_BYTES)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.encode(F.coalesce(F.col("text").cast("string"), F.lit("")), "UTF-8").alias("data"))
    name = f"suffixes_{uuid.uuid4().hex}"
    rows.repartition(parts, "row").write.format("parquet").option("compression", "zstd").option("path", shared_folder(spark, "texts")).bucketBy(parts, "row").saveAsTable(name)
    return spark.table(name)


def _with(texts: DataFrame, pieces: DataFrame) -> DataFrame:
    """Texts with the list `wanted` of their pieces; the list is as long as the text has pieces."""
    columns = [c for c in pieces.columns if c != "row"]
    wanted = pieces.groupBy("row").agg(F.collect_list(F.struct(*columns)).alias("wanted"))
    return texts.select("row", "data").join(wanted, "row")


def without_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, heavy: int = HEAVY) -> DataFrame:
    """Per document: doc_id, n_bytes, removed (start, end of maximal runs), kept (the remaining bytes).

    A byte of the UTF-8 text goes if it is covered by a string of `length` bytes that also starts anywhere else, in the
    same or another document; strings never reach over the end of a document, and are judged on the input. Copies of a
    piece are counted before texts are shuffled; one of them is sorted, its strings count as often as there are copies, and
    all share what is found. A heavy key,
    which more than `heavy` distinct pieces have, is split: its strings are counted by hash, and those that occur twice
    are dealt to shards of their own.

    Null texts are empty; texts shorter than `length` bytes keep everything. Rows of one doc_id, rows without one and
    repeated rows are documents of their own, so repeated rows remove each other. An empty table gives an empty table.
    Other columns aren't read. The result reads a table of texts and one of spans in the shared folder.
    """
    spark = docs.sparkSession
    texts = _bucketed(docs)
    first, scratch, last = Scratch(spark), Scratch(spark), Scratch(spark)
    pieces = first.keep(texts.select("row", "data").mapInArrow(_cut(length, gram), _PIECES), "pieces")
    # counts are written before they are joined: a join of two tables splits the rows of a frequent key, one with an aggregate doesn't
    keys = first.keep(pieces.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"), "keys")
    near = scratch.keep(pieces.join(keys, "key").select("row", "start", "owned", "key", "content"), "near")
    first.drop()

    classes = near.groupBy("key", "content").agg(F.count("*").alias("n"), F.min(F.struct("row", "start", "owned")).alias("one"))
    classes = scratch.keep(classes.select("key", "content", "n", "one.*"), "classes")
    load = scratch.keep(classes.groupBy("key").agg(F.count("*").alias("distinct")).where(F.col("distinct") > heavy).select("key", F.lit(True).alias("heavy")), "heavy")
    classes = scratch.keep(classes.join(load, "key", "left").withColumn("heavy", F.col("heavy").isNotNull()), "judged")
    columns = ["row", "start", "owned", "key", "content", "fine", "copies"]
    wanted = classes.where("not heavy").withColumn("copies", F.least("n", F.lit(2)).cast("int")).withColumn("fine", F.lit(False)).select(*columns)
    split = classes.where("heavy")
    some = not split.isEmpty()
    if some:
        strings = scratch.keep(_with(texts, split.select("row", "start", "owned", "key", "content", "n")).select("row", "data", "wanted").mapInArrow(_strings(length), _STRINGS), "strings")
        twice = strings.groupBy("string").agg(F.sum("n").alias("n"), F.min(F.struct("row", "place")).alias("one")).where("n > 1")
        single = twice.select("one.row", F.col("one.place").alias("start"), F.lit(1).alias("owned"), F.col("string").alias("key"), F.col("string").alias("content"), F.lit(True).alias("fine"), F.lit(2).alias("copies"))
        wanted = wanted.unionByName(single)
    wanted = scratch.keep(wanted, "wanted")
    size = wanted.agg(F.sum((F.col("owned") + (length - 1)).cast("long"))).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // SHARD_BYTES)
    shipped = _with(texts, wanted).mapInArrow(_shipped(length), _SHIPPED)
    found = scratch.keep(shipped.repartition(shards, "key").mapInArrow(_found(length), _FOUND), "found")

    runs = found.where("not fine").select("key", "content", F.arrays_zip("lows", "highs").alias("runs"))
    if some:
        hit = strings.select("key", "content", "at", "string").join(found.where("fine").select(F.col("key").alias("string")), "string")
        each = hit.groupBy("key", "content").agg(F.collect_set(F.struct(F.col("at").alias("lows"), F.col("at").alias("highs"))).alias("runs"))  # places in one piece
        runs = runs.unionByName(each)
    place = lambda x: F.struct((F.col("start") + x["lows"]).alias("low"), (F.col("start") + x["highs"]).alias("high"))
    spans = near.join(runs, ["key", "content"]).select("row", F.transform("runs", place).alias("spans"))
    spans = spans.groupBy("row").agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"))  # of one text
    spans = last.keep(spans, "spans")
    scratch.drop()
    return texts.join(spans, "row", "left").select("doc_id", "data", "spans").mapInArrow(_without(length), _KEPT)
