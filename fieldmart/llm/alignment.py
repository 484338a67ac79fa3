"""Alignment of two tokenizers' tokens over the same bytes, by interval coalescing."""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldmart.llm.common import Scratch, worker_cache

_BOUNDARY = re.compile(r"(?<=\S) (?=\S)")
"""Neither tokenizer has a token across a single space between two other characters that doesn't start with that space, nor looks beyond it, so stretches between such spaces are encoded apart."""
_MOST_STRETCHES = 200_000
_TOGETHER = 500
_MARKS = ",|;\n"
FREQUENT = 50_000
"""Pairs of ids that tasks get handed with their counts; rarer ones are joined."""
_SLICE = 200


def coalesce(a_start: np.ndarray, a_end: np.ndarray, b_start: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of every A token and of every B token: groups break where a start reaches the running maximum of ends."""
    start, end = np.concatenate([a_start, b_start]), np.concatenate([a_end, b_end])
    order = np.lexsort((end, start))
    reach = np.maximum.accumulate(end[order]) if len(order) else end
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(np.concatenate([[False], start[order][1:] >= reach[:-1]])) if len(order) else 0
    return group[: len(a_start)], group[len(a_start) :]


def overlaps(a_start: np.ndarray, a_end: np.ndarray, b_start: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all A and B tokens whose ranges overlap; tokens of a side are in order and don't overlap each other."""
    low, high = np.searchsorted(b_end, a_start, "right"), np.searchsorted(b_start, a_end, "left")
    many = np.maximum(high - low, 0)
    a = np.repeat(np.arange(len(a_start)), many)
    return a, np.arange(len(a)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(low, many)


def byte_of_character() -> dict[str, int]:
    """The alphabet of byte-level tokens: printable bytes stand for themselves, the others follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}


class Sides:
    """Both tokenizers, with the bytes of every token."""

    def __init__(self, byte_vocabulary: str, piece_model: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_vocabulary)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = SentencePieceProcessor(model_file=piece_model)
        table = byte_of_character()
        self.a_bytes = {i: bytes(table[c] for c in t) if all(c in table for c in t) else t.encode() for t, i in self.a.get_vocab().items()}
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(self.b.id_to_piece(list(range(self.b.get_piece_size()))))]

        self.a_sizes, self.b_sizes = np.zeros(max(self.a_bytes) + 1, np.int64), np.array(list(map(len, self.b_bytes)), np.int64)
        for i, token in self.a_bytes.items():
            self.a_sizes[i] = len(token)

    def encode(self, texts: list[str]) -> list[tuple[list[int], list[int]] | None]:
        """A's ids of space and text and B's of the text, to which it adds the space; None where the bytes of either differ from them."""
        both = zip(self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False), self.b.encode(texts, num_threads=1), texts, strict=True)
        return [(a.ids, b) if b"".join([self.a_bytes[i] for i in a.ids]) == (" " + t).encode() == b"".join([self.b_bytes[i] for i in b]) else None for a, b, t in both]


class Stretches:
    """Aligned stretches of text. Each distinct one is encoded and aligned once, many at a time; emptied when it is full."""

    def __init__(self, sides: Sides) -> None:
        self.sides = sides
        self.written = [f"{i}{mark}" for mark in _MARKS for i in range(max(len(sides.a_sizes), len(sides.b_sizes)))]
        self._empty()

    def _empty(self) -> None:
        self.number: dict[str, int] = {}
        self.groups: list[str] = []
        self.sizes = np.empty((0, 4), np.int64)  # A tokens, B tokens, groups, whether the bytes are equal
        self.ends = np.zeros(1, np.int64)
        self.pairs = np.empty(0, np.int64)

    def learn(self, stretches: set[str]) -> None:
        if len(self.number) > _MOST_STRETCHES:
            self._empty()
        new = [s for s in stretches if s not in self.number]
        for at in range(0, len(new), 20_000):
            self._align(new[at : at + 20_000])

    def _align(self, new: list[str]) -> None:
        # stretches that begin and end with other characters than white space are encoded as one text, with the spaces that they had
        plain = [s for s in new if s and not s[0].isspace() and not s[-1].isspace()]
        parts = [plain[i : i + _TOGETHER] for i in range(0, len(plain), _TOGETHER)]
        odd = [s for s in new if not s or s[0].isspace() or s[-1].isspace()]
        found, order = [], []
        for part, ids in zip(parts, self.sides.encode([" ".join(p) for p in parts]), strict=True):
            if ids is None:
                odd += part
            else:
                found.append(ids)
                order += part
        alone = self.sides.encode(odd)
        found += [ids for ids in alone if ids is not None]
        equal = np.array([True] * len(order) + [ids is not None for ids in alone])
        order += odd
        a, b = (np.fromiter(chain.from_iterable(f[side] for f in found), np.int64) for side in (0, 1))
        # stretches one behind the other: the tokens of either side cover the same bytes without gaps
        stops = np.cumsum(np.where(equal, [len(s.encode()) + 1 for s in order], 0))
        a_end, b_end = np.cumsum(self.sides.a_sizes[a]), np.cumsum(self.sides.b_sizes[b])
        a_start, b_start = a_end - self.sides.a_sizes[a], b_end - self.sides.b_sizes[b]
        a_group, b_group = coalesce(a_start, a_end, b_start, b_end)
        x, y = overlaps(a_start, a_end, b_start, b_end)
        same = a_end[x] == b_end[y]
        x, y = x[same], y[same]
        ends_of_groups = a_end[np.flatnonzero(np.diff(a_group, append=-1))]
        counts = [np.diff(np.searchsorted(e, stops, "right"), prepend=0) for e in (a_end, b_end, ends_of_groups, a_end[x])]
        texts = iter(_written(a, a_group, b, b_group, np.isin(a_end, stops), self.written))
        for s, is_equal in zip(order, equal.tolist(), strict=True):
            self.number[s] = len(self.groups)
            self.groups.append(next(texts) if is_equal else "")
        self.sizes = np.concatenate([self.sizes, np.stack([*counts[:3], equal.astype(np.int64)], 1)])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(counts[3])])
        self.pairs = np.concatenate([self.pairs, (a[x] << 32) | b[y]])

    def text(self, stretches: list[str]) -> tuple[int, int, int, str, np.ndarray, np.ndarray]:
        """n_a, n_b, n_groups, digest of the groups, distinct linked pairs and how often each is linked."""
        ids = np.fromiter(map(self.number.__getitem__, stretches), np.int64, len(stretches))
        own, times = np.unique(ids, return_counts=True)
        sizes = self.sizes[own]
        if not len(own) or not sizes[:, 3].all():
            return 0, 0, 0, "", np.empty(0, np.int64), np.empty(0, np.int64)
        n_a, n_b, n_groups = (sizes[:, :3] * times[:, None]).sum(0).tolist()
        digest = hashlib.sha256(";".join(map(self.groups.__getitem__, ids.tolist())).encode()).hexdigest()
        low, many = self.ends[own], self.ends[own + 1] - self.ends[own]
        places = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(low, many)
        return n_a, n_b, n_groups, digest, *_summed(self.pairs[places], np.repeat(times, many))


def _written(a: np.ndarray, a_group: np.ndarray, b: np.ndarray, b_group: np.ndarray, closes: np.ndarray, table: list[str]) -> list[str]:
    """`a1,a2|b1;a3|b2` of each stretch. closes: whether an A token ends its stretch; table has each id with each mark behind it."""
    group, side = np.concatenate([a_group, b_group]), np.concatenate([np.zeros(len(a), np.int64), np.ones(len(b), np.int64)])
    order = np.argsort(group * 2 + side, kind="stable")
    group, side, ids = group[order], side[order], np.concatenate([a, b])[order]
    last = np.diff(group * 2 + side, append=-1) != 0  # of its side of the group
    closing = np.zeros(int(a_group[-1]) + 1 if len(a_group) else 0, bool)
    closing[a_group[closes]] = True
    mark = np.where(~last, 0, np.where(side == 0, 1, np.where(closing[group], 3, 2)))
    return "".join(map(table.__getitem__, (mark * (len(table) // len(_MARKS)) + ids).tolist())).split("\n")[:-1]


def _summed(values: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order, and the sum of each one's weights."""
    order = np.argsort(values, kind="stable")
    values = values[order]
    first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.empty(0, np.int64)
    return values[first], np.add.reduceat(weights[order], first) if len(first) else np.empty(0, np.int64)


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(x) for x in arrays])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*arrays, np.empty(0, np.int64)]).astype(np.int64)))


def _flat(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column, and the row of each."""
    sizes = np.diff(lists.offsets.to_numpy())
    return lists.flatten().to_numpy(), np.repeat(np.arange(len(sizes)), sizes)


_ALIGNED = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<long>"


def _aligned(byte_vocabulary: str, piece_model: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = worker_cache(("alignment", byte_vocabulary, piece_model), lambda: Stretches(Sides(byte_vocabulary, piece_model)))
        for whole in batches:
            for at in range(0, whole.num_rows, _SLICE):
                batch = whole.slice(at, _SLICE)
                cut = [_BOUNDARY.split(t) if t else [] for t in batch.column("text").to_pylist()]
                known.learn({s for stretches in cut for s in stretches})
                found = [known.text(stretches) for stretches in cut]
                links = [int(f[5].sum()) for f in found]
                columns = [batch.column("row"), batch.column("doc_id"), *[pa.array([f[i] for f in found], pa.int64()) for i in range(3)], pa.array(links, pa.int64()), pa.array([f[3] for f in found]), _lists([f[4] for f in found]), _lists([f[5] for f in found])]
                yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _ALIGNED.split(", ")])

    return run


def align(docs: DataFrame, byte_vocabulary: str, piece_model: str) -> DataFrame:
    """Per document: row, doc_id, n_a, n_b, n_groups, n_links, groups_sha256, distinct linked pairs (A id << 32 | B id) and how often each is linked.

    Texts are encoded whole and without special tokens, A with a leading space, which B adds itself. Byte offsets where
    tokens of both sides end cut them into groups; tokens whose ranges end together are linked. Texts that are null or
    empty, or whose joined token bytes differ from space and text, have no tokens.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_aligned(byte_vocabulary, piece_model), _ALIGNED)


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs summed up before they are shuffled."""
    for batch in batches:
        values, of = _flat(batch.column("pairs"))
        pairs, times = _summed(values, _flat(batch.column("times"))[0])
        yield pa.RecordBatch.from_arrays([pa.array(pairs, pa.int64()), pa.array(times, pa.int64())], ["pair", "times"])


def pair_counts(aligned: DataFrame) -> DataFrame:
    """pair, count (links in the whole corpus), best (whether no other pair of its B id has more)."""
    counts = aligned.select("pairs", "times").mapInArrow(_partial, "pair long, times long").groupBy("pair").agg(F.sum("times").alias("count")).withColumn("b", F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)))
    return counts.join(counts.groupBy("b").agg(F.max("count").alias("highest")), "b").select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))


_SCORED = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long, rare array<long>, rare_times array<long>"


def _scored(handed):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, counts, best = handed.value
        for batch in batches:
            values, of = _flat(batch.column("pairs"))
            times = _flat(batch.column("times"))[0]
            at = np.minimum(np.searchsorted(pairs, values), max(len(pairs) - 1, 0))
            known = pairs[at] == values if len(pairs) else np.zeros(len(values), bool)
            sums = []
            for worth in (best, counts):
                total = np.zeros(batch.num_rows, np.int64)
                np.add.at(total, of[known], times[known] * worth[at[known]])
                sums.append(total)
            ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(of[~known], minlength=batch.num_rows))]).astype(np.int32))
            rare = [pa.ListArray.from_arrays(ends, pa.array(v[~known])) for v in (values, times)]
            columns = [*(batch.column(c) for c in ("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")), *map(pa.array, sums), *rare]
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _SCORED.split(", ")])

    return run


def alignment(docs: DataFrame, byte_vocabulary: str, piece_model: str, frequent: int = FREQUENT) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    n_best counts the links whose pair has the highest corpus-wide count of its B id (ties included), count_sum adds up
    the counts of all links. The `frequent` most frequent pairs, a bounded table, are handed to every task; what is left of a document
    is joined by pair, and no pair that is joined is in more than one of `frequent` parts of all links. Each text is
    encoded once.

    Null, empty and unequal texts (see align) have zeros and an empty digest. Rows of one doc_id, repeated rows and rows
    without a doc_id stand alone, as often as they occur. An empty table gives an empty table; other columns aren't read.
    """
    spark = docs.sparkSession
    scratch, last = Scratch(spark), Scratch(spark)
    aligned = scratch.keep(align(docs, byte_vocabulary, piece_model), "aligned")
    counts = scratch.keep(pair_counts(aligned), "pairs")
    top = counts.orderBy(F.desc("count"), "pair").limit(frequent).toPandas().sort_values("pair")
    handed = spark.sparkContext.broadcast((top["pair"].to_numpy(np.int64), top["count"].to_numpy(np.int64), top["best"].to_numpy(np.int64)))
    scored = last.keep(aligned.mapInArrow(_scored(handed), _SCORED), "scored")
    rare = scored.select("row", F.inline(F.arrays_zip("rare", F.col("rare_times").alias("times")))).toDF("row", "pair", "times").join(counts, "pair")
    rare = last.keep(rare.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("times") * F.col("count")).alias("more_sum")), "rare")
    scratch.drop()
    both = scored.drop("rare", "rare_times").join(rare, "row", "left")
    total = lambda name, more: (F.col(name) + F.coalesce(more, F.lit(0))).alias(name)
    return both.select("doc_id", "n_a", "n_b", "n_groups", "n_links", total("n_best", "more_best"), total("count_sum", "more_sum"), "groups_sha256")
