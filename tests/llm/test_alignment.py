"""Cross-tokenizer alignment: against whole-text encodings, a plain loop over cut points, and counts over all documents."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from fieldmart.llm import alignment as al
from tests.conftest import DATA

FILES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
PARTS = ["a", "the", "The", " ", "  ", "\xa0", "\n", "\t", "'s", "é", "日", "🙂", "<s>", "<|endoftext|>", "▁", "1", "23", ".", ",", "\x1c", " ", "ab cd", "</s>", "<0x41>", "\x00", "İ", "́", "-"]


@pytest.fixture(scope="module")
def sides():
    return al.Sides(*FILES)


def plain(sides, text):
    """n_a, n_b, n_groups, digest and linked pairs, from encodings of the whole text and its cut points."""
    whole = (" " + text).encode() if text else b""
    a, b = (sides.a.encode(" " + text, add_special_tokens=False).ids, sides.b.encode(text)) if text else ([], [])
    if not text or b"".join(sides.a_bytes[i] for i in a) != whole or b"".join(sides.b_bytes[i] for i in b) != whole:
        return 0, 0, 0, "", []
    ends = [np.cumsum([len(table[i]) for i in ids]).tolist() for table, ids in ((sides.a_bytes, a), (sides.b_bytes, b))]
    groups, links, i, j = [], [], 0, 0
    for c in sorted(set(ends[0]) & set(ends[1])):
        p, q = ends[0].index(c, i) + 1, ends[1].index(c, j) + 1
        groups.append(",".join(map(str, a[i:p])) + "|" + ",".join(map(str, b[j:q])))
        links.append((a[p - 1], b[q - 1]))
        i, j = p, q
    return len(a), len(b), len(groups), hashlib.sha256(";".join(groups).encode()).hexdigest(), links


def expected(sides, rows):
    found = [(i, *plain(sides, t)) for i, t in rows]
    counts = Counter(p for f in found for p in f[5])
    highest = Counter()
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    return sorted(str((i, na, nb, ng, len(p), sum(counts[x] == highest[x[1]] for x in p), sum(counts[x] for x in p), d)) for i, na, nb, ng, d, p in found)


def got(df):
    return sorted(str(tuple(r)) for r in df.collect())


@pytest.mark.parametrize("frequent", [al.FREQUENT, 40, 0])
def test_documents_equal_plain_alignment(spark, sides, frequent):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    assert got(al.alignment(docs, *FILES, frequent)) == expected(sides, [(r.doc_id, r.text) for r in docs.collect()])


def test_odd_texts(spark, sides):
    r = random.Random(5)
    rows = [(i, "".join(r.choice(PARTS) for _ in range(r.randint(0, 25)))) for i in range(3000)]
    rows += [(1, None), (None, None), (None, "the cat"), (7, "the cat"), (7, "the cat"), (8, "word " * 40_000), (9, "x" * 50_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"row": F.lit("x"), "pairs": F.lit(1), "pair": F.lit(2)})
    assert got(al.alignment(df, *FILES)) == expected(sides, rows)


def test_empty_table(spark):
    assert al.alignment(spark.createDataFrame([], "doc_id long, text string"), *FILES).collect() == []


def test_coalescing_and_overlaps_of_any_intervals():
    r = np.random.default_rng(2)
    for _ in range(200):
        cuts = [np.unique(np.concatenate([[0, 30], r.integers(1, 30, r.integers(0, 12))])) for _ in range(2)]
        (a0, a1), (b0, b1) = [(c[:-1], c[1:]) for c in cuts]
        a_group, b_group = al.coalesce(a0, a1, b0, b1)
        both = sorted(set(a1) & set(b1))
        assert a_group.tolist() == np.searchsorted(both, a1).tolist() and b_group.tolist() == np.searchsorted(both, b1).tolist()
        x, y = al.overlaps(a0, a1, b0, b1)
        assert set(zip(x.tolist(), y.tolist())) == {(i, j) for i in range(len(a0)) for j in range(len(b0)) if a0[i] < b1[j] and b0[j] < a1[i]}
        assert (a_group[x] == b_group[y]).all()
    none = np.empty(0, np.int64)
    assert all(len(g) == 0 for g in (*al.coalesce(none, none, none, none), *al.overlaps(none, none, none, none)))


def test_stretches_are_forgotten_when_there_are_too_many(sides, monkeypatch):
    monkeypatch.setattr(al, "_MOST_STRETCHES", 5)
    known = al.Stretches(sides)
    for text in ["one two three four", "five six seven", "eight one two", "one"] * 3:
        cut = al._BOUNDARY.split(text)
        known.learn(set(cut))
        n_a, n_b, n_groups, digest, pairs, times = known.text(cut)
        want = plain(sides, text)
        assert (n_a, n_b, n_groups, digest) == want[:4] and Counter(dict(zip(pairs.tolist(), times.tolist()))) == Counter(a << 32 | b for a, b in want[4])
