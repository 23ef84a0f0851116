"""Raking and sampling against numpy, and the registered SQL."""

import math
from collections import defaultdict

import duckdb
import pytest

from citymotion.llm import mixing as M


def cells(spark):
    rows = [(s, g, t, float(1 + 37 * i % 91)) for i, (s, g, t) in enumerate((s, g, t) for s in "abcd" for g in ("en", "fr", "de") for t in ("x", "y")) if (s, g) != ("d", "de")]
    return rows, spark.createDataFrame(rows, "source string, lang string, topic string, tokens double")


def raked(rows, targets, sweeps):
    w = {r[:3]: r[3] for r in rows}
    for _ in range(sweeps):
        for d in range(3):
            now = defaultdict(float)
            for k, x in w.items():
                now[k[d]] += x
            w = {k: x * targets[d].get(k[d], 0.0) / now[k[d]] if now[k[d]] else 0.0 for k, x in w.items()}
    return w


def test_raking_meets_given_targets(spark):
    rows, df = cells(spark)
    targets = {"source": {"a": 1, "b": 1, "c": 1, "d": 1, "lacking": 6}, "lang": {"en": 0.6, "fr": 0.3, "de": 0.1}, "topic": {"x": 0.5, "y": 0.5}}
    shares = [{"a": 0.1, "b": 0.1, "c": 0.1, "d": 0.1}, targets["lang"], targets["topic"]]
    total = sum(shares[0].values())
    shares[0] = {k: v / total for k, v in shares[0].items()}
    got = {(r["source"], r["lang"], r["topic"]): r["weight"] for r in M.rake(df, targets, sweeps=12).collect()}
    want = raked(rows, shares, 12)
    assert got == pytest.approx(want, rel=1e-9)
    for d in range(3):
        sums = defaultdict(float)
        for k, x in got.items():
            sums[k[d]] += x
        assert sums == pytest.approx(shares[d], rel=1e-3)


def test_default_raking_goes_on_until_the_targets_are_met(spark):
    rows = [(s, g, t, 1000.0 if (i, j) in ((0, 0), (1, 1)) else 1.0) for i, s in enumerate("ab") for j, g in enumerate(("en", "fr")) for t in ("x", "y")]
    df = spark.createDataFrame(rows, "source string, lang string, topic string, tokens double")
    targets = {"source": {"a": 0.8, "b": 0.2}, "lang": {"en": 0.6, "fr": 0.4}, "topic": {"x": 0.5, "y": 0.5}}
    shares = [targets[d] for d in M.DIMENSIONS]
    off = lambda w: max(abs(sum(x for k, x in w.items() if k[d] == c) / share - 1) for d in range(3) for c, share in shares[d].items())
    assert off(raked(rows, shares, M.SWEEPS)) > 100 * M.TOLERANCE
    got = {(r["source"], r["lang"], r["topic"]): r["weight"] for r in M.rake(df, targets).collect()}
    assert off(got) <= M.TOLERANCE
    assert M.rake(df.limit(0)).count() == 0


def test_targets_that_cannot_be_met_raise(spark, monkeypatch):
    monkeypatch.setattr(M, "MOST_SWEEPS", 8)
    df = spark.createDataFrame([("a", "en", "x", 5.0), ("b", "fr", "x", 5.0)], "source string, lang string, topic string, tokens double")
    with pytest.raises(ValueError, match="cannot meet"):
        M.rake(df, {"source": {"a": 0.9, "b": 0.1}, "lang": {"en": 0.5, "fr": 0.5}})


def test_categories_without_a_share_get_none(spark):
    _, df = cells(spark)
    got = M.rake(df, {"topic": {"x": 1.0}}, sweeps=2).collect()
    assert all(r["weight"] == 0 for r in got if r["topic"] == "y") and sum(r["weight"] for r in got) == pytest.approx(1)


def test_sampling_follows_probabilities(spark):
    rows = [(i, "w " * (1 + i % 5), "big" if i % 3 else f"s{i % 7}", "en" if i % 2 else None) for i in range(6000)]
    rows += [(None, None, None, None), (1, "w w ", "big", "en"), (7777, "", "big", "en")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, source string, lang string, probability string")
    out = M.report(df, sweeps=6).collect()
    assert len(out) == len(rows)
    by = defaultdict(list)
    for r in out:
        by[r["source"], r["lang"], r["topic"]].append(r)
        assert 0 <= r["probability"] <= 1
    assert max(r["probability"] for r in out) == 1.0
    for found in by.values():
        p, n = found[0]["probability"], len(found)
        assert abs(sum(r["sampled"] for r in found) - n * p) <= 5 * math.sqrt(n * p * (1 - p)) + 2
    kept = M.sample(df, sweeps=6)
    assert kept.columns == df.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(r["doc_id"]) for r in out if r["sampled"])
    assert M.report(df.limit(0), sweeps=2).count() == 0


def test_only_empty_texts(spark):
    df = spark.createDataFrame([(1, ""), (2, None)], "doc_id long, text string")
    assert [(r["n_tokens"], r["probability"], r["sampled"]) for r in M.report(df, sweeps=2).collect()] == [(0, 0.0, False)] * 2


def test_sql_gives_the_same_rows(spark, docs_rows):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    want = con.execute(M.oracle()).df().sort_values("doc_id").reset_index(drop=True)
    got = M.report(spark.read.parquet(f"{sf}/documents.parquet")).toPandas().sort_values("doc_id").reset_index(drop=True)
    assert got.to_dict("records") == want[list(got.columns)].to_dict("records")


@pytest.mark.parametrize(
    "rows",
    [
        [(f"s{i % 2 if i % 10 else 2}", f"l{i % 2 if i % 10 else 2}") for i in range(300)],  # each source in its own language
        [("only", "en")] * 50,
        [("only", f"l{i % 4}") for i in range(60)],
        [("a", "en")] * 90 + [("b", "fr")] * 10,
    ],
)
def test_default_targets_never_contradict(spark, rows):
    df = spark.createDataFrame([(i, "w " * (1 + i % 7) + ("@" if i % 9 == 0 else ""), *r) for i, r in enumerate(rows)], "doc_id long, text string, source string, lang string")
    out = M.report(df).collect()
    assert len(out) == len(rows) and all(r["targets_met"] for r in out)
    weight, tokens, by = defaultdict(float), defaultdict(float), defaultdict(float)
    for r in out:
        weight[r["source"]] += r["probability"] * r["n_tokens"]
        tokens[r["source"], r["lang"]] += r["n_tokens"]
        by["source", r["source"]] += r["n_tokens"]
        by["lang", r["lang"]] += r["n_tokens"]
    whole = sum(tokens.values())
    tempered = defaultdict(float)
    for (s, g), n in tokens.items():
        tempered[s] += n * (by["source", s] / whole) ** (M.ALPHAS["source"] - 1) * (by["lang", g] / whole) ** (M.ALPHAS["lang"] - 1)
    for s in weight:
        assert weight[s] / sum(weight.values()) == pytest.approx(tempered[s] / sum(tempered.values()), rel=2 * M.TOLERANCE)


def test_unfinished_default_fit_is_reported(spark, monkeypatch):
    monkeypatch.setattr(M, "MOST_SWEEPS", 1)
    monkeypatch.setattr(M, "TOLERANCE", 0.0)
    _, df = cells(spark)
    raked_cells, off = M.fit(df)
    assert raked_cells.count() == df.count() and 0 < off < 1
