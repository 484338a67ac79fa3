"""Token ids in ORC files: run-length encoded integers in stripes, row indexes, and Bloom filters on document ids."""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from fieldmart.llm.bpe import IdStore, cut
from fieldmart.llm.common import parts_of, worker_cache

END_ID = 1
STRIPE_BYTES = 16 << 20
INDEX_ROWS = 1_000
FILE_BYTES = 128 << 20
"""Input bytes for each file, about."""
_MOST_CHUNKS = 500_000
_SCHEMA = "doc_id long, at long, n_tokens long, ids array<int>"


class ChunkIds(IdStore):
    """Ids of words and chunks by the tokenizers library. Many distinct words are encoded as one text; the ids that close a word tell where the next one starts."""

    def __init__(self, vocabulary: str) -> None:
        super().__init__(_MOST_CHUNKS)
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        # the same model for words that are normalised and cut already, with spaces between them
        self.plain = Tokenizer.from_file(vocabulary)
        self.plain.normalizer = normalizers.Sequence([])
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split(" ", "removed"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.closes = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.closes[i] = token.endswith("</w>")

    def encode_chunks(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        odd = np.fromiter((c[0] == " " for c in chunks), bool, len(chunks))  # chunks of odd texts
        sizes, parts = np.zeros(len(chunks), np.int64), []
        places = [np.flatnonzero(~odd), np.flatnonzero(odd)]
        for at in range(0, len(places[0]), 256):
            own = places[0][at : at + 256]
            ids = np.array(self.plain.encode_batch_fast([" ".join([chunks[i] for i in own])], add_special_tokens=False)[0].ids, np.int32)
            sizes[own] = np.diff(np.flatnonzero(self.closes[ids]) + 1, prepend=0)
            parts.append(ids)
        for at in range(0, len(places[1]), 2048):
            own = places[1][at : at + 2048]
            encoded = self.tokenizer.encode([chunks[i][1:] for i in own], is_pretokenized=True, add_special_tokens=False)
            sizes[own] = np.bincount(np.array(encoded.word_ids, np.int64), minlength=len(own))
            parts.append(np.array(encoded.ids, np.int32))
        ids = np.concatenate([*parts, np.empty(0, np.int32)])
        if odd.any() and not odd.all():  # back into the order of the chunks
            order = np.concatenate(places)
            ends = np.cumsum(sizes[order])
            starts = np.empty(len(chunks), np.int64)
            starts[order] = ends - sizes[order]
            total = np.cumsum(sizes)
            ids = ids[np.arange(len(ids)) + np.repeat(starts - (total - sizes), sizes)]
        return ids, sizes

    def texts(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(sizes, ids) of blocks of texts, the end id appended to each text."""
        for at in range(0, len(texts), 256):
            stops, ids = self.gather([cut(t) for t in texts[at : at + 256]])
            yield np.diff(stops, prepend=0) + 1, np.insert(ids, stops, END_ID)


def _encoded(vocabulary: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_cache(("orc ids", vocabulary), lambda: ChunkIds(vocabulary))
        at = 0
        for batch in batches:
            docs, done = batch.column("doc_id"), 0
            for sizes, ids in encoder.texts(batch.column("text").to_pylist()):
                ends = np.cumsum(sizes)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays([docs.slice(done, len(sizes)), pa.array(at + ends - sizes), pa.array(sizes), lists], ["doc_id", "at", "n_tokens", "ids"])
                at, done = at + int(ends[-1]), done + len(sizes)

    return run


def write_ids(docs: DataFrame, vocabulary: str, path: str) -> None:
    """Encodes whole texts (null: empty), appends END_ID to each document, and writes them in ascending doc_id order.

    One file per range of doc_id, as many as the input's size asks for, sorted within; rows of one doc_id and repeated rows
    stand alone, in the order of their texts, and null ids come first. `at` is where a document's ids start among those of
    its file. Texts of any length are encoded whole. An empty table gives files without rows. Other columns aren't read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = rows.repartitionByRange(parts_of(docs, FILE_BYTES), "doc_id").sortWithinPartitions("doc_id", "text")
    out = ordered.mapInArrow(_encoded(vocabulary), _SCHEMA)
    out.write.option("orc.bloom.filter.columns", "doc_id").option("orc.row.index.stride", INDEX_ROWS).option("orc.stripe.size", STRIPE_BYTES).option("orc.create.index", "true").option("compression", "zstd").orc(path)


def read_ids(spark: SparkSession, path: str, only: list[int] | None = None) -> DataFrame:
    """doc_id, at, n_tokens, ids; with `only`, row indexes and Bloom filters skip stripes and row groups without those ids."""
    found = spark.read.schema(_SCHEMA).orc(path)
    return found if only is None else found.where(F.col("doc_id").isin(only))


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("ids")
        ends, values = lists.offsets.to_numpy(), lists.values.to_numpy().astype("<u4", copy=False)
        sums = [zlib.crc32(values[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("file", "doc_id", "at", "n_tokens")), pa.array(sums, pa.int64())], ["file", "doc_id", "at", "n_tokens", "ids_crc32"])


def layout(spark: SparkSession, path: str) -> DataFrame:
    """From the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32 (ids as little-endian uint32). Files without rows give an empty table; repeated rows have a start each."""
    read = read_ids(spark, path).select(F.col("_metadata.file_name").alias("file"), "doc_id", "at", "n_tokens", "ids")
    sums = read.mapInArrow(_sums, "file string, doc_id long, at long, n_tokens long, ids_crc32 long")
    files = read_ids(spark, path).select(F.col("_metadata.file_name").alias("file"), "doc_id", "at", "n_tokens").groupBy("file").agg(F.max(F.col("at") + F.col("n_tokens")).alias("held"), F.min("doc_id").alias("low"))
    before = W.orderBy(F.col("low").asc_nulls_first(), "file").rowsBetween(W.unboundedPreceding, -1)  # one row for each file
    bases = files.select("file", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("base"))
    return sums.join(bases, "file").select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
