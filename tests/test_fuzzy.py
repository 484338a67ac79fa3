"""Best names under both measures and any threshold against all pairs; the pairs that are compared; longest common subsequences."""

import random

import pytest

from fieldmart.operators import mdm


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


SCORES = {"edit": lambda a, b: 1 - edits(a, b) / max(len(a), len(b), 1), "indel": lambda a, b: 2 * lcs(a, b) / (len(a) + len(b)) if a or b else 1.0}


def test_common_subsequence_equals_the_plain_programme():
    r = random.Random(1)
    for _ in range(3000):
        a, b = ("".join(r.choice("abcé ") for _ in range(r.randint(0, r.choice((4, 20, 150))))) for _ in range(2))
        assert mdm.common_subsequence(a, b) == lcs(a, b)


def mistyped(r, text, times, letters):
    for _ in range(times):
        at = r.randrange(len(text))
        text = r.choice((text[:at] + r.choice(letters) + text[at + 1 :], text[:at] + text[at + 1 :], text[:at] + r.choice(letters) + text[at:])) or "a"
    return text


@pytest.mark.parametrize("measure", ["edit", "indel"])
def test_any_threshold_equals_all_pairs(spark, measure):
    """Short and long names of few letters, with spaces, so that words are sorted; values with up to five edits and unrelated ones."""
    r = random.Random(4)
    word = lambda a, b: "".join(r.choice("abcd") for _ in range(r.randint(a, b)))
    names = sorted({" ".join(word(1, 7) for _ in range(r.randint(1, 3))) for _ in range(90)})
    values = sorted({mistyped(r, n, r.randint(0, 5), "abcdx").strip() or "a" for n in names} | {word(1, 12) for _ in range(30)} | {"zzzz", "q"})
    df, catalogue = spark.createDataFrame([(v,) for v in values] + [(None,), (" ",)], "v string"), spark.createDataFrame([(n,) for n in names] + [(None,)], "n string")
    key = {row.x: row.k for row in spark.createDataFrame([(x,) for x in {*names, *values}], "x string").select("x", mdm.token_key(mdm.F.col("x")).alias("k")).collect()}
    for threshold in (0.85, 0.6, 0.3, 0.0):
        want = {None: (None, None), " ": (None, None)}
        for v in values:
            score, name = min((-SCORES[measure](key[v], key[n]), n) for n in names)
            want[v] = (name, round(-score, 9)) if -score >= threshold else (None, None)
        got = {x.v: (x.found, None if x.score is None else round(x.score, 9)) for x in mdm.match_fuzzy(df, catalogue, "v", "n", threshold, measure).collect()}
        assert got == want, threshold


@pytest.mark.parametrize("measure", ["edit", "indel"])
def test_far_fewer_than_all_pairs_are_compared(spark, monkeypatch, measure):
    """A search at 0.0 of 300 mistyped names among 300 compares under a fifth of all pairs, though no threshold bounds it."""
    r, counted, best = random.Random(7), [], mdm._best_names

    def count(pairs, *args):
        counted.append(pairs.count())
        return best(pairs, *args)

    monkeypatch.setattr(mdm, "_best_names", count)
    letters = "abcdefghijklmnoprstuvz"
    names = sorted({" ".join("".join(r.choice(letters) for _ in range(r.randint(4, 9))) for _ in range(2)) for _ in range(300)})
    values = sorted({mistyped(r, n, r.randint(0, 4), letters) for n in names})
    df, catalogue = spark.createDataFrame([(v,) for v in values], "v string"), spark.createDataFrame([(n,) for n in names], "n string")
    found = mdm.match_fuzzy(df, catalogue, "v", "n", 0.0, measure).collect()
    assert len(found) == len(values) and all(x.found for x in found)
    assert sum(counted) < len(values) * len(names) / 5


def test_empty_tables(spark):
    none, some = spark.createDataFrame([], "v string"), spark.createDataFrame([("abc",)], "n string")
    for threshold in (0.85, 0.0):
        assert mdm.match_fuzzy(none, some, "v", "n", threshold).collect() == []
        (row,) = mdm.match_fuzzy(some.toDF("v"), none.toDF("n"), "v", "n", threshold).collect()
        assert row.found is None and row.score is None
