"""BPE encoding and decoding: frequent words through a minimal acyclic transducer, all others by exact merges."""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import re
import tempfile
import unicodedata
import uuid
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldmart.llm.common import kept, to_shared_folder, worker_cache
from fieldmart.llm.transducer import Transducer

LEXICON = 50_000
"""Most frequent words that are compiled; bounds what goes to every executor (about 2 MB). Other words are merged, so the ids don't depend on it."""
_MOST_CHUNKS = 250_000
_LONG = 96
_NONE = np.int32(2**31 - 1)
# fixed values: white space of the tokenizer's pattern, and that pattern for ASCII
_WHITE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
_SPLIT_WHITE = re.compile(f"[{_WHITE}]+")
_SEPARATORS = re.compile("[\x1c-\x1f]")
_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
# the same pattern for the characters of plain texts
_WORDS = re.compile("'(?:[stmd]|re|ve|ll)|[a-zß-öø-ɏ]+|[0-9]|[^\t-\r a-z0-9ß-öø-ɏ]+")
_ODD = re.compile("[^\x00-\x7fÀ-ÖØ-įı-ɏ]")
_NOT_LATIN = bytes([*range(0x80, 0xC0), 0xD7, 0xF7])


def _byte_chars() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Merges:
    """Vocabulary and merge table of a word-end BPE file, as arrays."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        tokens = vocab | self.special
        self.tokens = [""] * (max(tokens.values()) + 1)
        for token, i in tokens.items():
            self.tokens[i] = token
        chars = _byte_chars()
        self.inner = np.array([vocab[c] for c in chars], np.int32)
        self.last = np.array([vocab[c + end] for c in chars], np.int32)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left, right = (np.array([vocab[p[k]] for p in pairs], np.int64) for k in (0, 1))
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int32)
        self.bits = 18
        keys = (left << 16 | right).astype(np.uint32)
        self.slots = np.full(1 << self.bits, 0xFFFFFFFF, np.uint32)
        self.ranks = np.full(1 << self.bits, _NONE, np.int32)
        for rank, (key, at) in enumerate(zip(keys.tolist(), self._at(keys).tolist(), strict=True)):
            while self.slots[at] != 0xFFFFFFFF and self.slots[at] != key:
                at = (at + 1) & ((1 << self.bits) - 1)
            if self.slots[at] != key:
                self.slots[at], self.ranks[at] = key, rank
        self.pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.special_pattern = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None

    def _at(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint32(2654435769)) >> np.uint32(32 - self.bits)).astype(np.int64)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Merge rank of each pair of ids, _NONE where there is none."""
        shape = a.shape
        keys = (a.astype(np.uint32) << np.uint32(16) | b.astype(np.uint32)).ravel()
        at = self._at(keys)
        seen = self.slots[at]
        out = np.where(seen == keys, self.ranks[at], _NONE)
        rest = np.flatnonzero((seen != keys) & (seen != 0xFFFFFFFF))
        while len(rest):
            at[rest] = (at[rest] + 1) & ((1 << self.bits) - 1)
            seen = self.slots[at[rest]]
            hit = seen == keys[rest]
            out[rest[hit]] = self.ranks[at[rest[hit]]]
            rest = rest[~hit & (seen != 0xFFFFFFFF)]
        return out.reshape(shape)

    def merge(self, words: list[bytes]) -> list[list[int]]:
        """Ids of each word. Words of one length are merged together: each round makes the leftmost pair of the lowest rank in every word."""
        out: list[list[int]] = [[]] * len(words)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(lengths, kind="stable")
        for group in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1):
            if not len(group) or not lengths[group[0]]:
                continue
            if lengths[group[0]] > _LONG:
                for i in group:
                    out[i] = self.merge_long(words[i])
                continue
            for at in range(0, len(group), 8192):
                self._merge_equal(group[at : at + 8192], words, out)
        return out

    def _merge_equal(self, rows: np.ndarray, words: list[bytes], out: list[list[int]]) -> None:
        wide = len(words[rows[0]])
        raw = np.frombuffer(b"".join(words[i] for i in rows), np.uint8).reshape(len(rows), wide)
        ids = self.inner[raw]
        ids[:, -1] = self.last[raw[:, -1]]
        ranks = self.rank(ids[:, :-1], ids[:, 1:]) if wide > 1 else np.empty((len(rows), 0), np.int32)
        while True:
            best = ranks.min(axis=1, initial=_NONE)
            done = best == _NONE
            for i, found in zip(rows[done].tolist(), ids[done].tolist(), strict=True):
                out[i] = found
            go = ~done
            if not go.any():
                return
            rows, ids, ranks, best = rows[go], ids[go], ranks[go], best[go]
            j = ranks.argmin(axis=1)
            n, w = ids.shape
            k = np.arange(n)
            keep = np.ones((n, w), bool)
            keep[k, j + 1] = False
            ids[k, j] = self.made[best]
            ids = ids[keep].reshape(n, w - 1)
            keep = np.ones((n, w - 1), bool)
            keep[k, j] = False
            ranks = ranks[keep].reshape(n, w - 2)
            has = j > 0  # the pairs on either side of what was made
            r, c = k[has], j[has]
            ranks[r, c - 1] = self.rank(ids[r, c - 1], ids[r, c])
            has = j < w - 2
            r, c = k[has], j[has]
            ranks[r, c] = self.rank(ids[r, c], ids[r, c + 1])

    def merge_long(self, word: bytes) -> list[int]:
        """One word of any length, by a heap of (rank, place) over a linked list."""
        raw = np.frombuffer(word, np.uint8)
        ids = self.inner[raw].tolist()
        ids[-1] = int(self.last[raw[-1]])
        n = len(ids)
        after, before, gone = list(range(1, n + 1)), list(range(-1, n - 1)), [False] * n
        first = self.rank(np.array(ids[:-1], np.int32), np.array(ids[1:], np.int32)).tolist()
        heap = [(r, i, ids[i], ids[i + 1]) for i, r in enumerate(first) if r != _NONE]
        heapq.heapify(heap)
        pair = lambda i, j: int(self.rank(np.array([ids[i]], np.int32), np.array([ids[j]], np.int32))[0])
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if gone[i] or j >= n or ids[i] != a or ids[j] != b:
                continue
            ids[i], gone[j], after[i] = int(self.made[r]), True, after[j]
            if after[i] < n:
                before[after[i]] = i
                if (s := pair(i, after[i])) != _NONE:
                    heapq.heappush(heap, (s, i, ids[i], ids[after[i]]))
            if before[i] >= 0 and (s := pair(before[i], i)) != _NONE:
                heapq.heappush(heap, (s, before[i], ids[before[i]], ids[i]))
        return [x for x, g in zip(ids, gone, strict=True) if not g]


def chunks(text: str) -> list[str]:
    """Stretches between white space; no token spans two of them."""
    if _SEPARATORS.search(text):  # str.split() also cuts at these, the tokenizer doesn't
        return [c for c in _SPLIT_WHITE.split(text) if c]
    return text.split()


def _plain(text: str) -> bool:
    """Whether the text is of ASCII and composed Latin letters alone; Latin-1 texts are tested as bytes."""
    if text.isascii():
        return True
    try:
        raw = text.encode("latin-1")
    except UnicodeEncodeError:
        return not _ODD.search(text)
    return len(raw.translate(None, _NOT_LATIN)) == len(raw)


def cut(text: str | None) -> list[str]:
    """The tokenizer's own words, lower-cased, of a text that is plain as it is and in lower case; else its chunks with a space before each."""
    if not text:
        return []
    low = text.lower()
    if "<|" in text or not (_plain(text) and _plain(low)):
        return [" " + c for c in chunks(text)]
    return _WORDS.findall(low)


class _Numbers(dict):
    """Number of each chunk; unseen ones get the next number and wait in `new`."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, chunk: str) -> int:
        number = self[chunk] = len(self)
        self.new.append(chunk)
        return number


def _room(array: np.ndarray, n: int) -> np.ndarray:
    while len(array) < n:
        array = np.concatenate([array, np.zeros_like(array)])
    return array


class IdStore:
    """Ids of chunks, each distinct one encoded once per worker until `most` are held; a text's ids are gathered from them."""

    def __init__(self, most: int) -> None:
        self.most = most
        self.clear()

    def clear(self) -> None:
        self.numbers = _Numbers()
        self.flat, self.used = np.zeros(1 << 16, np.int32), 0
        self.starts, self.sizes = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)

    def encode_chunks(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all chunks in a row, and the number of each one's."""
        raise NotImplementedError

    def gather(self, split: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Ends of the texts (lists of chunks) in the ids of all, and the ids."""
        if len(self.numbers) > self.most:
            self.clear()
        places = np.fromiter(map(self.numbers.__getitem__, chain.from_iterable(split)), np.int64)
        if new := self.numbers.new:
            ids, sizes = self.encode_chunks(new)
            base = len(self.numbers) - len(new)
            self.flat = _room(self.flat, self.used + len(ids))
            self.flat[self.used : self.used + len(ids)] = ids
            self.starts, self.sizes = _room(self.starts, len(self.numbers)), _room(self.sizes, len(self.numbers))
            self.sizes[base : base + len(new)] = sizes
            self.starts[base : base + len(new)] = self.used + np.cumsum(sizes) - sizes
            self.used += len(ids)
            self.numbers.new = []
        sizes = self.sizes[places]
        total = np.cumsum(sizes)
        ids = self.flat[np.arange(int(total[-1]) if len(total) else 0) + np.repeat(self.starts[places] - (total - sizes), sizes)]
        ends = np.cumsum([len(found) for found in split])
        return np.concatenate([[0], total])[ends].astype(np.int64), ids


class Encoder(IdStore):
    """Encodes texts through the transducer and the merges, and decodes ids."""

    def __init__(self, merges: Merges, lexicon: Transducer | None = None) -> None:
        super().__init__(_MOST_CHUNKS)
        from tokenizers import Regex, normalizers, pre_tokenizers

        self.merges, self.lexicon = merges, lexicon
        # Unicode tables differ between libraries: what isn't ASCII is composed, lower-cased and cut by the tokenizer's own
        self.normaliser = normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()])
        self.cutter = pre_tokenizers.Split(Regex(merges.pattern), "removed", invert=True)
        self.names = np.array(merges.tokens, object)
        self.decimals = np.array([str(i) for i in range(len(merges.tokens))], object)

    def words(self, words: list[bytes]) -> list[list[int]]:
        """Ids of each word: from the transducer where it is in the lexicon, else merged."""
        if self.lexicon is None:
            return self.merges.merge(words)
        numbers = self.lexicon.numbers(words)
        rest = np.flatnonzero(numbers < 0).tolist()
        out: list = [None] * len(words)
        for i, found in zip(rest, self.merges.merge([words[i] for i in rest]), strict=True):
            out[i] = found
        offsets, ids = self.lexicon.offsets, self.lexicon.ids
        known = np.flatnonzero(numbers >= 0)
        low, high = offsets[numbers[known]].tolist(), offsets[numbers[known] + 1].tolist()
        flat = np.asarray(ids)
        for i, a, b in zip(known.tolist(), low, high, strict=True):
            out[i] = flat[a:b].tolist()
        return out

    def _parts(self, chunk: str) -> list[bytes | int]:
        """Words of what cut() gives, as UTF-8, and ids of special tokens that stand in it."""
        if chunk[0] != " ":
            return [chunk.encode()]
        chunk = chunk[1:]
        if chunk.isascii():
            if chunk.isalpha():
                return [chunk.lower().encode()]
            if "<|" not in chunk:
                return [p.encode() for p in _PIECES.findall(chunk.lower())]
        out: list[bytes | int] = []
        for piece in self.merges.special_pattern.split(chunk) if self.merges.special_pattern else [chunk]:
            if piece in self.merges.special:
                out.append(self.merges.special[piece])
            elif piece:
                out += [p.encode() for p, _ in self.cutter.pre_tokenize_str(self.normaliser.normalize_str(piece))]
        return out

    def encode_chunks(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        parts = [self._parts(c) for c in chunks]
        words = list({p for found in parts for p in found if isinstance(p, bytes)})
        known: dict = dict(zip(words, self.words(words), strict=True)) | {i: [i] for i in self.merges.special.values()}
        ids = [known[found[0]] if len(found) == 1 else [i for p in found for i in known[p]] for found in parts]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), np.int32, int(sizes.sum())), sizes

    def encode(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """Ids of each text; null and blank texts have none."""
        for at in range(0, len(texts), 256):
            ends, ids = self.gather([cut(t) for t in texts[at : at + 256]])
            start = 0
            for end in ends.tolist():
                yield ids[start:end]
                start = end

    def decode(self, ids: np.ndarray) -> str:
        """Tokens joined by spaces: the files of this kind name no decoder."""
        return " ".join(self.names[ids])

    def written(self, ids: np.ndarray) -> str:
        """Decimal ids joined by spaces."""
        return " ".join(self.decimals[ids])


def frequent_words(docs: DataFrame, most: int = LEXICON) -> list[str]:
    """At most `most` of the most frequent words (runs of letters, 64 bytes at most) of all texts: those of the frequency classes that fit.

    Classes are steps of a twentieth in log(count), so what the driver gets is bounded by `most`, whatever the input.
    """
    words = docs.select(F.explode(F.split(F.lower("text"), r"[^\p{L}]+")).alias("word")).where("word <> ''")
    counted = words.groupBy("word").count().where("count > 1 and octet_length(word) <= 64").select("word", F.floor(20 * F.log("count")).alias("class"))
    counted = kept(counted, "words")
    taken, least = 0, None
    for r in counted.groupBy("class").count().orderBy(F.desc("class")).collect():
        if taken + r["count"] > most:
            break
        taken, least = taken + r["count"], r["class"]
    return [] if least is None else [r.word for r in counted.where(F.col("class") >= least).select("word").collect()]


def compiled(docs: DataFrame, vocabulary: str, most: int = LEXICON) -> str:
    """Compiles the frequent words of docs, hands the automaton to the executors as a file, and returns its name there."""
    merges = Merges(vocabulary)
    words = list({unicodedata.normalize("NFC", w).encode() for w in frequent_words(docs, most)})
    lexicon = Transducer.build(dict(zip(words, merges.merge(words), strict=True)))
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    with tempfile.TemporaryDirectory(prefix="lexicon-") as folder:
        lexicon.save(os.path.join(folder, name))
        shared = to_shared_folder(docs.sparkSession, os.path.join(folder, name))
    docs.sparkSession.sparkContext.addFile(shared)
    return name


def encoder(vocabulary: str, lexicon: str | None = None) -> Encoder:
    return worker_cache((vocabulary, lexicon), lambda: Encoder(Merges(vocabulary), Transducer.map(SparkFiles.get(lexicon)) if lexicon else None))


def encode(docs: DataFrame, vocabulary: str, most: int = LEXICON) -> DataFrame:
    """docs with a column ids (array of int) of the whole text; null and blank texts have none."""
    lexicon = compiled(docs, vocabulary, most)

    @F.pandas_udf("array<int>")
    def ids(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series(list(encoder(vocabulary, lexicon).encode(list(batch))), dtype=object)

    return docs.withColumn("ids", ids("text"))


def decode(df: DataFrame, vocabulary: str) -> DataFrame:
    """df with a column decoded of its ids; null where ids is null."""

    @F.pandas_udf("string")
    def text(ids: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in ids:
            decode = encoder(vocabulary).decode
            yield pd.Series([None if x is None else decode(np.asarray(x, np.int32)) for x in batch], dtype=object)

    return df.withColumn("decoded", text("ids"))


def _digests(vocabulary: str, lexicon: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = encoder(vocabulary, lexicon)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                sizes, ids_sums, text_sums = [], [], []
                for ids in made.encode(part.column("text").to_pylist()):
                    sizes.append(len(ids))
                    ids_sums.append(hashlib.sha256(made.written(ids).encode()).hexdigest())
                    text_sums.append(hashlib.sha256(made.decode(ids).encode()).hexdigest())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(ids_sums, pa.string()), pa.array(text_sums, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def round_trip(docs: DataFrame, vocabulary: str, most: int = LEXICON) -> DataFrame:
    """Per document: doc_id, n_tokens, and SHA-256 of its ids (decimal, joined by a space) and of the text decoded from them.

    Null and blank texts have no tokens. Rows are independent, so repeated rows and null ids stay; other columns are not
    read. The second digest is of what the ids decode to. A very long text takes memory in proportion to its own length.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_digests(vocabulary, compiled(rows, vocabulary, most)), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
