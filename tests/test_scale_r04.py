"""Operators on crowded input, where the work has to stay far below that of all pairs."""

import random

import pytest
from pyspark.sql import functions as F


def _crowd(spark, n_segs=600, n_places=300, seed=5):
    """Places in two rows beside and inside a band that is full of segments, some of them copies."""
    rnd = random.Random(seed)
    segs = []
    for i in range(n_segs):
        x, y = rnd.uniform(-400, 400), rnd.uniform(-200, 200)
        segs.append((f"R{i:05d}_X", 0, x, y, x + rnd.choice([0.0, rnd.uniform(-300, 300)]), rnd.uniform(-200, 200)))
    segs += [("A" + s[0], *s[1:]) for s in segs[:100]] + [(None, *s[1:]) for s in segs[:5]] + [("P_P", 0, 10.0, 330.0, 10.0, 330.0)]
    places = [(float(i), 0.0, rnd.uniform(-500, 500), rnd.choice([315.0, 340.0, rnd.uniform(-250, 250)])) for i in range(n_places)] + [(-1.0, 0.0, 5000.0, 5000.0)]
    names = "route_id string, seg long, ax double, ay double, bx double, by double"
    return spark.createDataFrame(places, "_lon double, _lat double, _px double, _py double"), spark.createDataFrame(segs, names)


@pytest.mark.parametrize("levels", [0, 1, 4])
def test_quartered_cells_find_the_nearest(spark, monkeypatch, levels):  # r04: F3, F4
    from citymotion.functions.geo import segment_distance
    from citymotion.operators import spatial

    monkeypatch.setattr(spatial, "CROWDED", 0)
    monkeypatch.setattr(spatial, "DEARER", 0)  # quarter to the last level
    monkeypatch.setattr(spatial, "LEVELS", levels)
    places, segs = _crowd(spark)
    got = {r["_lon"]: (r["route_id"], r["dist_to_route_m"]) for r in spatial._within(places, segs, 150.0).collect()}
    want = {}
    for r in places.crossJoin(segs).withColumn("d", segment_distance("_px", "_py", "ax", "ay", "bx", "by")).where("d <= 150").collect():
        key = r["d"], r["route_id"] is not None, r["route_id"] or ""
        want[r["_lon"]] = min(want.get(r["_lon"], key), key)
    assert got == {k: (name if known else None, d) for k, (d, known, name) in want.items()} and len(got) > 250


def test_quartering_leaves_out_most_pairs(spark, monkeypatch):  # r04: F3, F4
    from citymotion.operators import spatial

    places, segs = _crowd(spark, 6000, 6000)
    work = lambda: spatial._searched(places, segs, 150.0)[0].agg(F.sum(F.col("n_places") * F.col("n_segments"))).first()[0]
    monkeypatch.setattr(spatial, "LEVELS", 0)
    whole = work()
    monkeypatch.setattr(spatial, "LEVELS", 4)
    assert work() < whole / 4


def test_nothing_to_search(spark):
    from citymotion.operators import spatial

    places, segs = _crowd(spark, 3, 3)
    assert spatial._within(places.limit(0), segs, 150.0).count() == spatial._within(places, segs.limit(0), 150.0).count() == 0
