"""Steps that have to stay narrow, short or evenly cut when their tables grow."""

from __future__ import annotations

from datetime import date, timedelta

import numpy as np
from pyspark.sql import functions as F


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_listed_segments_are_few_and_not_shuffled(spark):  # F1, F2
    from citymotion.operators.spatial import place_cells, segment_cells

    segs = spark.createDataFrame([(f"R{i}", 0, 7.0 * i, 3.0 * i, 7.0 * i + 210.0, 3.0 * i - 210.0) for i in range(200)], "route_id string, seg long, ax double, ay double, bx double, by double")
    cells = segment_cells(segs, 300.0)
    assert "Exchange" not in _plan(cells)
    per = cells.groupBy("route_id").agg(F.count("*").alias("n"), F.count_distinct("cx", "cy").alias("d")).collect()
    assert len(per) == 200 and all(r.n == r.d <= 4 for r in per)
    places = spark.createDataFrame([(float(i), float(-i), 11.0 * i, -13.0 * i) for i in range(100)], "_lon double, _lat double, _px double, _py double")
    assert place_cells(places, 150.0, 300.0).groupBy("_lon").count().agg(F.max("count")).first()[0] <= 4


def test_nearest_of_many_equal_and_nameless_corridors(spark):  # F1, F2
    from citymotion.operators.spatial import nearest_routes

    rows = [(f"C{k:03d}_X", i, -79.40 + 0.01 * i, 43.60) for k in range(300) for i in (0, 1)] + [(None, 0, -79.30, 43.60), ("B_Y", 0, -79.30, 43.60)]
    verts = spark.createDataFrame(rows, "route_id string, seq long, lon double, lat double")
    pts = spark.createDataFrame([(1, -79.395, 43.6001), (2, -79.30, 43.6001), (3, -79.35, 43.65)], "collision_id long, lon double, lat double")
    got = {r.collision_id: (r.route_id, r.dist_to_route_m is None) for r in nearest_routes(pts, verts).collect()}
    assert got == {1: ("C000_X", False), 2: (None, False), 3: (None, True)}


def test_panel_rows_are_narrow_until_the_last_join(spark):  # F5, F6, F7, F9, F12, F13, F14
    from citymotion.plans import registry

    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")
    old = {k: spark.conf.get(k) for k in keys}
    try:
        spark.conf.set(keys[0], "-1")
        spark.conf.set(keys[1], "false")
        plan = _plan(registry.build_panel_df(spark, "/root/testdata/sf0.001"))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    days, incidents = plan.index("BroadcastHashJoin [date#"), plan.index("SortMergeJoin [route_id#")
    assert days < incidents  # top of the plan first


def test_partitioned_writes_need_no_sort(spark, tmp_path):  # F5
    from citymotion.session import unsorted_partitions

    rows = spark.range(0, 200, 1, 2).select("id", (F.col("id") % 2 + 2023).cast("int").alias("year"))
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key, None)
    with unsorted_partitions(spark):
        assert int(spark.conf.get(key)) > 1
        rows.write.partitionBy("year").parquet(str(tmp_path / "p"))
    assert spark.conf.get(key, None) == before
    back = spark.read.parquet(str(tmp_path / "p"))
    assert sorted(map(tuple, back.select("id", "year").collect())) == sorted(map(tuple, rows.collect()))


def test_day_texts_of_long_entries_in_small_pieces(spark, monkeypatch):  # F3
    from citymotion.operators import calendar as C

    rng = np.random.default_rng(5)
    first = date(2024, 1, 1)
    rows = [(int(rng.integers(0, 40)), f"n{i % 7}" if i % 5 else None, f"i{i:03d}", ["parade", "civic_holiday", None, "own kind"][i % 4], int(rng.integers(0, 60)), int(rng.integers(0, 400))) for i in range(150)]
    df = spark.createDataFrame([(p, n, i, k, first + timedelta(a), first + timedelta(a + d)) for p, n, i, k, a, d in rows], "pos long, name string, id string, kind string, start_date date, end_date date")
    ordered = C.in_order(df)
    places = [r["_at"] for r in ordered.orderBy("pos", "name", "id", "kind").collect()]
    assert places == sorted(set(places)) and len(places) == 150
    monkeypatch.setattr(C, "PAIRS", 37)
    batch = ordered.select("name", "id", "kind", C.day_number(F.col("start_date")).alias("d0"), C.day_number(F.col("end_date")).alias("d1"), "_at").orderBy("_at").toArrow().combine_chunks().to_batches()[0]
    base = (first - date(1970, 1, 1)).days
    days = np.arange(base + 10, base + 300, 3)
    got = [r for part in C._block_days(batch, days) for r in part.to_pylist()]
    by_place = batch.to_pylist()
    assert [r["day"] for r in got] == [d for d in days.tolist() if any(e["d0"] <= d <= e["d1"] for e in by_place)]
    for r in got:
        active = [e for e in by_place if e["d0"] <= r["day"] <= e["d1"]]
        names = [e["name"] for e in active if e["kind"] == "parade" and e["name"] is not None]
        assert r["n"] == len(active) and r["event_ids"] == "|".join(e["id"] for e in active)
        assert r["mega_event_names"] == ("|".join(names) if names else None)
        assert sorted(r["kinds"]) == sorted({e["kind"] for e in active} - {None})


def test_normative_rows_without_day_texts(spark):  # F8, F10, F11, F17
    from citymotion.operators.scoring import normative_mask
    from citymotion.plans import registry

    assert not set(registry.DAY_TEXTS) & set(registry.normative(spark, "/root/testdata/sf0.001").columns)
    rows = [("A_B", h, 0, float(v), True, None, 2024) for h in (7, None) for v in range(4)] + [(None, 7, 0, 1.0, True, None, 2024), ("A_B", 9, 1, 2.0, False, None, 2023)]
    df = spark.createDataFrame(rows, "route_id string, hour long, dow long, delay_s double, obs_travel boolean, wx_precip_mm double, year int")
    out = normative_mask(df, train_years=[2024], q=0.5, min_count=2)
    assert out.count() == len(rows)
    got = {(r.route_id, r.hour): r.delay_threshold for r in out.collect()}
    assert got == {("A_B", 7): 1.5, ("A_B", None): 1.5, (None, 7): None, ("A_B", 9): 1.5}


def test_sorted_write_numbers_its_ranges_by_measured_bytes(spark, tmp_path, monkeypatch):  # F18, F19, F20
    from citymotion.sources import sinks

    rows = spark.range(2000).select((F.col("id") * 7919 % 2000).alias("k"), F.repeat(F.lit("same text "), 20).alias("t"))
    monkeypatch.setattr(sinks, "RANGE_BYTES", 64 * 1024)
    path = sinks.write_table(rows, str(tmp_path / "s"), order_by=["k"])
    files = sorted((tmp_path / "s").glob("*.parquet"))
    assert len(files) > 4
    keys = [[r.k for r in spark.read.parquet(str(f)).collect()] for f in files]
    assert [k for part in keys for k in part] == list(range(2000)) and path.endswith("s")


def test_stream_batches_are_dealt_before_parsing(spark):  # F4, F15, F21
    from citymotion.plans import registry_io, registry_raw

    for stream in (registry_io.event_stream(spark, "/root/testdata/sf0.001"), registry_raw._in_batches(spark, "/root/testdata/sf0.001")):
        assert stream.isStreaming and "RepartitionByExpression" in stream._jdf.queryExecution().analyzed().toString()


ODD_ENTRIES = """<viewentries><viewentry unid="a"><entrydata name="EventName">plain <text> one </text><number> 7 </number></entrydata>
<entrydata name="Location"><number>3</number><text>t</text><textlist><text> p | q </text><text> </text></textlist></entrydata></viewentry>
<viewentry unid=""><entrydata name="EventName"><text>kept</text></entrydata><entrydata name="Area"><text>first</text></entrydata><entrydata name="Area"><text> </text></entrydata>
<entrydata><text>no name</text></entrydata></viewentry>
<viewentry unid="bad"><entrydata name="EventName"><text>a & b</text></entrydata></viewentry>
<viewentry></viewentry>
<viewentrys/></viewentry>
<viewentry unid="end"><entrydata name="DateBeginShow"><text>Mar 13, 2016</text></entrydata><entrydata name="TimeBegin"><text>2:30 AM</text></entrydata></viewentry></viewentries>
"""


def test_festival_texts_are_joined_once(spark, tmp_path):  # F16
    from citymotion.operators.ingest import normalize_festivals
    from citymotion.sources.text_formats import read_festival_entries

    (tmp_path / "f.xml").write_text(ODD_ENTRIES, encoding="utf-8")
    entries = read_festival_entries(spark, str(tmp_path / "f.xml"))
    plan = entries._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_xml(") == 1 and plan.count(".textlist") <= 2  # not once a field
    got = [(r.ordinal, r.unid, r.EventName, r.Area, r.Location, r.TimeBegin) for r in entries.orderBy("ordinal").collect()]
    assert got == [
        (0, "a", "plain | one | 7", None, "t | 3 | p | q", None),
        (1, None, "kept", None, None, None),
        (2, "bad", None, None, None, None),
        (3, None, None, None, None, None),
        (4, "end", None, None, None, "2:30 AM"),
    ]
    ids = [r.event_id for r in normalize_festivals(entries).orderBy("event_id").collect()]
    assert ids == ["a", "bad", "end", "row-1", "row-3"]


def test_datetime_layouts_stand_once_in_the_code(spark):  # F16
    from citymotion.functions.text import EVENT_DATETIME_FORMATS, event_datetime

    rows = [
        ("Mar 13, 2016", "2:30 AM", "2016-03-13 02:30:00"), ("December 3, 2015", " ", "2015-12-03 00:00:00"), ("May 3, 2015", "noon:ish", "2015-05-03 00:00:00"),
        ("2015-05-04", "07:08", "2015-05-04 07:08:00"), ("2015-05-04 07:08", None, "2015-05-04 07:08:00"), ("3 May 2015", "9:00 AM", None), (None, "9:00 AM", None), (None, None, None),
    ]
    df = spark.createDataFrame(rows, "d string, t string, want string").select("want", event_datetime("d", "t").alias("got"))
    assert df._jdf.queryExecution().optimizedPlan().toString().lower().count("gettimestamp(") <= len(EVENT_DATETIME_FORMATS)
    assert all((r.got and str(r.got)) == r.want for r in df.collect())
