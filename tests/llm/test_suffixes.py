"""Suffix arrays and repeats: against sorting all suffixes and counting all strings."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fieldmart.llm import inducedsort, suffixdedup
from fieldmart.llm.q_op11 import op11_suffix_array
from tests.conftest import DATA


def check_order(data, cap, limit):
    blocks = list(inducedsort.sorted_suffixes(np.frombuffer(data, np.uint8), cap, limit, limit))
    order = [i for p, _ in blocks for i in p.tolist()]
    prefix = [i for _, x in blocks for i in x.tolist()]
    assert sorted(order) == list(range(len(data)))
    for i in range(1, len(order)):
        a, b = data[order[i - 1] :][:cap], data[order[i] :][:cap]
        same = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
        assert a <= b and prefix[i] == same


@pytest.mark.parametrize("block", [5, 1 << 18])
def test_suffixes_in_memory_on_disk_and_by_recursion(monkeypatch, block):
    """A limit of 0 sends every tuple to disk and sorts every string of names by recursion."""
    monkeypatch.setattr(inducedsort, "BLOCK", block)
    r = random.Random(block)
    for n in [*range(12), *(r.randint(12, 150) for _ in range(120))]:
        letters = r.choice([b"a", b"ab", b"abc", b"\x00\xff", bytes(range(256))])
        data = bytes(r.choice(letters) for _ in range(n))
        data += data if r.random() < 0.5 else b""
        check_order(data, r.choice([3, 20, 200]), r.choice([0, 200, 1 << 20]))
    check_order(b"a" * 700, 200, 0)
    check_order(b"ab" * 400, 200, 500)


def test_queue_keeps_order_through_disk():
    queue = inducedsort.Queue(100)
    for i in range(50):
        queue.push(i % 3, np.arange(i, i + 4), np.full(4, i, np.uint8))
    assert queue.spilled > 150
    for c in range(3):
        forward = [x for p, _ in queue.take(c, keep=True) for x in p.tolist()]
        assert forward == [x for i in range(c, 50, 3) for x in range(i, i + 4)]
        assert [x for p, _ in queue.take(c, backwards=True) for x in p[::-1].tolist()] == forward[::-1]


def plain(rows, length=200):
    counts = Counter(b[i : i + length] for _, b in rows for i in range(len(b) - length + 1))
    out = []
    for doc, b in rows:
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - length + 1):
            if counts[b[i : i + length]] > 1:
                gone[i : i + length] = True
        edges = np.diff(np.concatenate([[0], gone[:-1].astype(int), [0]]))
        kept = bytes(np.frombuffer(b, np.uint8)[~gone[:-1]])
        out.append(str((doc, len(b), int(gone.sum()), int((edges == 1).sum()), hashlib.sha256(kept).hexdigest())))
    return sorted(out)


def test_query_equals_counting_every_string(spark):
    rows = [(r.doc_id, (r.text or "").encode()) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    assert sorted(str(tuple(r)) for r in op11_suffix_array(spark, DATA).collect()) == plain(rows)


def _rows(df, **kw):
    found = suffixdedup.without_repeats(df, **kw)
    removed = F.aggregate("removed", F.lit(0), lambda n, r: n + (r["end"] - r["start"]))
    return sorted(str(tuple(r)) for r in found.select("doc_id", "n_bytes", removed, F.size("removed"), F.sha2("kept", 256)).collect())


@pytest.mark.parametrize("heavy", [500, 3, 0])
def test_passages_copies_edges_and_odd_texts(spark, heavy):
    """Passages in many texts behind and before their own words, near copies, runs of one letter, exact limits of the length."""
    r = random.Random(8)
    word = lambda n: " ".join("".join(r.choice("abcdefgé") for _ in range(r.randint(2, 9))) for _ in range(n))
    passage, template = word(60), word(200)
    rows = [(i, f"{word(r.randint(1, 60))} {passage} {word(r.randint(1, 60))}") for i in range(60)]
    for i in range(40):
        words = template.split()
        words[r.randrange(200)] = "x"
        rows.append((100 + i, " ".join(words)))
    own = "".join(r.choice("0123456789") for _ in range(500))
    rows += [(200, own[:199]), (201, own[:199]), (202, own[100:300]), (203, own[100:300] + "!"), (204, own[301:500] + "a"), (205, own[301:500] + "b")]
    rows += [(300, "a" * 1500), (301, "a" * 200), (302, "ab" * 700), (303, "é" * 130), (304, "b" * 200), (305, None), (306, ""), (None, word(50)), (7, rows[7][1]), (7, rows[7][1]), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"row": F.lit("x"), "data": F.lit(1), "key": F.lit(2), "spans": F.lit(None).cast("int")})
    assert _rows(df, heavy=heavy) == plain([(i, (t or "").encode()) for i, t in rows])


def test_empty_table(spark):
    assert _rows(spark.createDataFrame([], "doc_id long, text string")) == []


def test_groups_reach_over_blocks(monkeypatch):
    monkeypatch.setattr(inducedsort, "BLOCK", 3)
    data = np.frombuffer(b"abcabcabcxabc", np.uint8)
    found = suffixdedup.repeated_in(data, np.array([0, 9]), np.array([7, 2]), np.array([1, 1]), 3)
    counts = Counter(bytes(data[i : i + 3]) for i in [0, 1, 2, 3, 4, 5, 6, 9, 10])
    assert [i for i in range(13) if found[i]] == [i for i in [0, 1, 2, 3, 4, 5, 6, 9, 10] if counts[bytes(data[i : i + 3])] > 1]


def test_pieces_of_many_texts_are_shipped_together():
    """A batch for each text costs more than the bytes in it."""
    r = random.Random(3)
    texts = [r.randbytes(r.randint(300, 900)) for _ in range(300)]
    wanted = [[{"start": i, "owned": i + 1, "key": n, "content": i, "fine": False, "copies": 2} for i in range(r.randint(1, 3))] for n in range(300)]
    kind = pa.list_(pa.struct([("start", pa.int32()), ("owned", pa.int32()), ("key", pa.int64()), ("content", pa.int64()), ("fine", pa.bool_()), ("copies", pa.int32())]))
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.binary()), pa.array(wanted, kind)], ["data", "wanted"]).slice(7)
    out = list(suffixdedup._shipped(200)(iter([batch])))
    assert len(out) == 1
    rows = [(p["key"], p["content"], p["owned"], t[p["start"] : p["start"] + p["owned"] + 199]) for t, w in zip(texts[7:], wanted[7:], strict=True) for p in w]
    assert [(x["key"], x["content"], x["owned"], x["data"]) for x in out[0].to_pylist()] == rows


def test_keys_are_least_hashes_of_grams():
    """Windows as wide as a power of two, one more and one less; texts larger than the powers that are kept."""
    r = np.random.default_rng(4)
    for n, length, gram in [(300, 200, 64), (200, 200, 64), (90, 40, 9), (90, 40, 10), (90, 39, 8), (50, 9, 9), (2 * suffixdedup._STEP + 500, 200, 64)]:
        data = r.integers(0, 3, n, np.uint8)
        keys, leads = suffixdedup.keys_of(data, length, gram)
        hashes = suffixdedup.keys_of(data, gram, gram)[0].view(np.uint64)
        windows = np.lib.stride_tricks.sliding_window_view(hashes, length - gram + 1)[-400:]
        assert (keys.view(np.uint64)[-400:] == windows.min(1)).all() and len(keys) == n - length + 1
        assert (leads[-400:] == (windows[:, 0] == windows.min(1))).all()


def test_names_that_stay_equal_and_names_that_end():
    """Orders of names and common prefixes up to a cap, with ties at the cap, at the end, and a cap of one."""
    r = random.Random(5)
    for _ in range(200):
        names = np.array([r.randrange(r.choice([1, 2, 5])) for _ in range(r.randint(1, 60))])
        names = np.unique(names, return_inverse=True)[1]
        cap = r.choice([1, 2, 3, 8, 101])
        order, prefix = inducedsort._doubled(names, cap)
        assert sorted(order.tolist()) == list(range(len(names))) and prefix[0] == 0
        for i in range(1, len(order)):
            a, b = names[order[i - 1] :].tolist(), names[order[i] :].tolist()
            same = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
            assert prefix[i] == min(same, cap) and (same >= cap or a < b)


def test_runs_end_with_their_text():
    """Runs that overlap, touch, lie in one another, fill a text or are next to the following text's; texts without spans or bytes."""
    rows = [(1, b"abcdef", [(0, 0), (1, 3)]), (2, b"abcdef", [(0, 3)]), (None, b"abcdefghij", [(0, 0), (3, 3), (7, 7)]), (4, b"", None), (5, b"abc", []), (6, b"abcdefghij", [(0, 6), (1, 2), (4, 4)]), (7, b"abcdefghij", [(0, 1), (5, 5)]), (8, b"", None)]
    kind = pa.list_(pa.struct([("low", pa.int32()), ("high", pa.int32())]))
    spans = [None if s is None else [{"low": x, "high": y} for x, y in s] for *_, s in rows]
    batch = pa.RecordBatch.from_arrays([pa.array([d for d, *_ in rows], pa.int64()), pa.array([t for _, t, _ in rows], pa.binary()), pa.array(spans, kind)], ["doc_id", "data", "spans"])
    (out,) = suffixdedup._without(3)(iter([batch]))
    out.validate(full=True)
    found = [(x["doc_id"], x["n_bytes"], [(r["start"], r["end"]) for r in x["removed"]], x["kept"]) for x in out.to_pylist()]
    assert found == [(1, 6, [(0, 6)], b""), (2, 6, [(0, 6)], b""), (None, 10, [(0, 6), (7, 10)], b"g"), (4, 0, [], b""), (5, 3, [], b"abc"), (6, 10, [(0, 9)], b"j"), (7, 10, [(0, 4), (5, 8)], b"eij"), (8, 0, [], b"")]
