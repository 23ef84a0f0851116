"""Dyadic interval index and block-wise day lists against listing every day."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from citymotion.operators import calendar as C
from citymotion.operators.intervals import TOP, ancestors, cover


def test_cover_is_disjoint_and_whole(spark):
    rnd = random.Random(1)
    cases = [(a, a + rnd.choice([0, 1, 2, 5, 30, 63, 64, 1000])) for a in [rnd.randint(-3000, 3000) for _ in range(300)]]
    cases += [(0, 0), (-1, 0), (5, 4), (-100_000, 200_000), (0, (1 << TOP) - 1), (1, 1 << TOP), (None, 3)]
    df = spark.createDataFrame(cases, "a long, b long").select("a", "b", cover(F.col("a"), F.col("b")).alias("n"))
    for r in df.collect():
        days = [d for level, node in r["n"] for d in range(node << level, (node + 1) << level)]
        assert sorted(days) == (list(range(r["a"], r["b"] + 1)) if r["a"] is not None else []), (r["a"], r["b"])
        if r["a"] is not None and r["b"] - r["a"] < 2000:
            assert len(r["n"]) <= 2 * (r["b"] - r["a"] + 2).bit_length()


def test_each_point_meets_each_interval_once(spark):
    rnd = random.Random(2)
    spans = [(i, a, a + rnd.randint(0, 90)) for i, a in enumerate(rnd.randint(-50, 50) for _ in range(80))]
    nodes = spark.createDataFrame(spans, "i long, a long, b long").select("i", F.explode(cover(F.col("a"), F.col("b"))).alias("n"))
    points = spark.range(-60, 160).select(F.col("id").alias("d"), F.explode(ancestors(F.col("id"))).alias("n"))
    got = sorted((r["d"], r["i"]) for r in points.join(nodes, "n").select("d", "i").collect())
    assert got == sorted((d, i) for d in range(-60, 160) for i, a, b in spans if a <= d <= b)


def plain(rows):
    """{date: (flags, n, holiday names, mega names, ids, kinds)} by listing every day."""
    days = {}
    for pos, name, i, kind, a, b in rows:
        if a is None:
            continue
        for k in range(((b or a) - a).days + 1):
            days.setdefault(a + dt.timedelta(k), []).append((pos, name, i, kind))
    out = {}
    for d, es in days.items():
        es.sort(key=lambda e: (e[0], e[1] is not None, e[1] or "", e[2] or "", e[3] or ""))
        pick = lambda at, kinds: "|".join(e[at] for e in es if e[at] is not None and (kinds is None or e[3] in kinds))
        flags = tuple(any(e[3] in k for e in es) for k in C.FLAG_KINDS.values())
        out[d] = (*flags, len(es), pick(1, C.HOLIDAY_KINDS), pick(1, C.MEGA_KINDS), pick(2, None), "|".join(sorted({e[3] for e in es})))
    return out


KINDS = ["public_holiday", "civic_holiday", "mega_event", "parade", "shopping_peak", "school_break", "other"]


def entries(n):
    rnd, first = random.Random(n), dt.date(2024, 1, 1)
    rows = []
    for i in range(n):
        a = first + dt.timedelta(rnd.choice([0, 7, 7, 7, rnd.randint(0, 700)]))
        b = rnd.choice([None, a, a + dt.timedelta(rnd.randint(0, 40)), a + dt.timedelta(rnd.randint(0, 9000))])
        rows.append((rnd.randint(0, 10**6), rnd.choice([None, "", f"n{i % 13}"]), f"i{i}", rnd.choice(KINDS), a, b))
    return rows + [(1, "no start", "x", "parade", None, None)]


SCHEMA = "pos long, name string, id string, kind string, start_date date, end_date date"


@pytest.mark.parametrize("per_block", [1, 7, 1024])
def test_day_features_equal_listing(spark, per_block):
    rows = entries(160)
    got = {r["date"]: tuple(r)[1:] for r in C.day_features(spark.createDataFrame(rows, SCHEMA), per_block=per_block).collect()}
    assert got == plain(rows)


def test_days_that_are_asked_for_and_empty_calendars(spark):
    rows = entries(40)
    df = spark.createDataFrame(rows, SCHEMA)
    asked = [dt.date(2024, 1, 8), dt.date(2030, 5, 5), dt.date(1990, 1, 1)]
    got = {r["date"]: tuple(r)[1:] for r in C.day_features(df, spark.createDataFrame([(d,) for d in asked] + [(None,)], "date date")).collect()}
    want = plain(rows)
    assert got == {d: want[d] for d in asked if d in want}
    assert C.day_features(df.limit(0)).count() == 0


def test_no_group_is_as_large_as_a_crowded_day(spark):
    """All entries on one day: lists are sorted in blocks of the config order."""
    n = 5000
    df = spark.range(n).select((F.col("id") * 37 % n).alias("pos"), F.concat(F.lit("n"), "id").alias("name"), F.col("id").cast("string").alias("id"), F.lit("parade").alias("kind"), F.lit(dt.date(2024, 5, 5)).alias("start_date"), F.lit(None).cast("date").alias("end_date"))
    blocks = df.select(C._block(df, 100).alias("b")).groupBy("b").count().collect()
    assert len(blocks) == 50 and max(r["count"] for r in blocks) <= 120
    row = C.day_features(df, per_block=100).first()
    inverse = {k * 37 % n: k for k in range(n)}
    assert row["n_civic_events"] == n and row["event_ids"] == "|".join(str(inverse[p]) for p in range(n))
