"""Tables that are exploded stay with the tasks that read them: only the rules beside them are broadcast, or nothing."""

import pytest

from fieldmart.sources import raw


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("most", [10_000, 1])
def test_suggest_route_broadcasts_no_files(spark, tmp_path, monkeypatch, most):
    """Files of a known small size beside signatures of an unknown one, up to MOST_RULES and beyond."""
    monkeypatch.setattr(raw, "MOST_RULES", most, raising=False)
    columns = {i: [f"c{j}" for j in range(8) if i % (j + 2)] for i in range(200)}
    spark.createDataFrame([(i, "abz"[i % 3], c) for i, c in columns.items()], "file long, target string, columns array<string>").write.parquet(f"{tmp_path}/files")
    wanted = {"a": ["c0", "c1"], "b": [f"c{j}" for j in range(2, 8)]}
    out = raw.suggest_route(spark.read.parquet(f"{tmp_path}/files"), "file", "columns", spark.createDataFrame(list(wanted.items()), "target string, required array<string>"))
    assert "BuildLeft" not in plan(out) and (most == 1) == ("SortMergeJoin [_c" in plan(out))
    hits = lambda i, t: len(set(columns[i]) & set(wanted.get(t, [])))
    fits = lambda i, own: (hits(i, own) / len(wanted[own]) if own in wanted else 0.0) < 0.5 and own != "b" and hits(i, "b") == 6
    assert sorted((r.file, r.target, r.suggestion) for r in out.collect()) == [(i, t := "abz"[i % 3], "b" if fits(i, t) else None) for i in range(200)]


@pytest.mark.parametrize("most", [10_000, 1])
def test_route_files_broadcasts_no_names(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr(raw, "MOST_RULES", most, raising=False)
    names = [f"/in/{kind} {i}.csv" for i in range(40) for kind in ("Weather", "weather FR", "Página", "other")]
    spark.createDataFrame([(n,) for n in names], "name string").write.parquet(f"{tmp_path}/files")
    routes = spark.createDataFrame([("weather", "w"), ("Weather_fr", "f"), ("pagina", "p")], "pattern string, target string")
    aliases = spark.createDataFrame([(2, "r 7", "sevens"), (1, "er 7", "first")], "priority int, pattern string, target string")
    out = raw.route_files(spark.read.parquet(f"{tmp_path}/files"), "name", routes, aliases)
    assert "BuildLeft" not in plan(out) and (most == 1) == ("SortMergeJoin [_anchor" in plan(out))
    kinds = {"Weather": "w", "weather FR": "f", "Página": "p"}
    want = lambda n: "first" if "er 7." in n else "sevens" if "r 7." in n.lower() else kinds.get(n[4:].rsplit(" ", 1)[0])
    assert sorted((r["name"], r.target) for r in out.collect()) == sorted((n, want(n)) for n in names)
