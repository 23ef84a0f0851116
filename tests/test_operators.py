import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

D = dt.date
T = dt.datetime


def cal(spark, rows):
    return spark.createDataFrame(rows, "id string, name string, kind string, start_date date, end_date date, pos long")


# ------------------------------------------------------------------ calendar
def test_civic_days_christmas(spark):  # X5
    from citymotion.operators.calendar import civic_days

    e = cal(spark, [("xmas", "Christmas Day", "public_holiday", D(2014, 12, 25), None, 0)])
    rows = civic_days(e, start_date=D(2014, 12, 24), end_date=D(2014, 12, 26)).orderBy("date").collect()
    assert [r.is_public_holiday for r in rows] == [False, True, False]
    assert rows[1].holiday_names == "Christmas Day" and rows[0].holiday_names == "" and rows[1].n_civic_events == 1


def test_civic_multi_day_and_kinds(spark):  # X6, Q8
    from citymotion.operators.calendar import assert_valid, features_for_dates

    e = cal(
        spark,
        [
            ("h", "Labour Day", "public_holiday", D(2014, 9, 1), D(2014, 9, 1), 0),
            ("p", "Parade", "parade", D(2014, 9, 4), D(2014, 9, 4), 1),
            ("m", "Film Fest", "mega_event", D(2014, 9, 4), D(2014, 9, 14), 2),
        ],
    )
    days = spark.createDataFrame([(D(2014, 9, 4),), (D(2014, 9, 14),), (D(2014, 9, 15),)], "date date")
    r = {x.date: x for x in features_for_dates(e, days).collect()}
    assert r[D(2014, 9, 4)].is_mega_event and r[D(2014, 9, 4)].is_parade
    assert r[D(2014, 9, 4)].mega_event_names == "Parade|Film Fest"  # parades listed, flag separate
    assert r[D(2014, 9, 4)].event_kinds == "mega_event|parade" and r[D(2014, 9, 4)].event_ids == "p|m"
    assert r[D(2014, 9, 14)].is_mega_event and not r[D(2014, 9, 14)].is_parade
    assert not r[D(2014, 9, 15)].is_mega_event and r[D(2014, 9, 15)].n_civic_events == 0
    assert_valid(e)
    bad = cal(spark, [("x", "Bad", "parade", D(2014, 9, 5), D(2014, 9, 4), 0)])
    with pytest.raises(ValueError):
        assert_valid(bad)


def test_calendar_yaml(spark, tmp):
    from citymotion.sources.text_formats import load_calendar

    p = tmp / "cal.yaml"
    p.write_text(
        "timezone: America/Toronto\nstart_year: 2014\nend_year: 2014\nevents:\n"
        "  - {id: a, name: A, kind: parade, start_date: 2014-07-01}\n"
        "  - {id: b, name: B, kind: mega_event, start_date: 2014-07-01, end_date: 2014-07-03}\n"
    )
    e, header = load_calendar(spark, str(p))
    assert header["start_year"] == 2014
    assert [r.end_date for r in e.orderBy("pos").collect()] == [D(2014, 7, 1), D(2014, 7, 3)]
    p.write_text("events:\n  - {id: a, name: A, kind: parade, start_date: 2014-07-02, end_date: 2014-07-01}\n")
    with pytest.raises(ValueError):
        load_calendar(spark, str(p))


# ------------------------------------------------------------------ time zone
def test_floor_hour_across_dst_end(spark):  # X10
    from citymotion.functions.timez import floor_hour, utc_to_local

    df = spark.createDataFrame([(T(2014, 11, 2, 5, 5),), (T(2014, 11, 2, 6, 35),)], "ts_utc timestamp_ntz")
    rows = df.select(floor_hour("ts_utc").alias("h")).withColumn("loc", utc_to_local("h")).orderBy("h").collect()
    assert [r.h for r in rows] == [T(2014, 11, 2, 5, 0), T(2014, 11, 2, 6, 0)]
    assert [r.loc for r in rows] == [T(2014, 11, 2, 1, 0), T(2014, 11, 2, 1, 0)]  # same wall hour, -04 then -05


def test_localize_gap_and_overlap(spark):
    from citymotion.functions.timez import localize

    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = spark.createDataFrame(
            [(T(2017, 3, 12, 2, 30),), (T(2017, 11, 5, 1, 30),), (T(2017, 6, 1, 12, 0),)], "n timestamp_ntz"
        )
        got = [r.u for r in df.select(localize("n").alias("u")).collect()]
    finally:
        spark.conf.unset("spark.sql.session.timeZone")
    assert got == [T(2017, 3, 12, 7, 0), None, T(2017, 6, 1, 16, 0)]


# ------------------------------------------------------------------ summaries
EV_SCHEMA = "start_local timestamp_ntz, end_local timestamp_ntz, road_close boolean, lat double, lon double"


def test_event_day_summary(spark):  # X11, Q6
    from citymotion.operators.summaries import event_day_summary

    ev = spark.createDataFrame(
        [
            (T(2014, 7, 1, 10), T(2014, 7, 1, 18), True, 43.6, -79.4),
            (T(2014, 7, 5, 10), T(2014, 7, 4, 10), True, 43.6, -79.4),  # end < start -> nothing
            (None, None, True, 1.0, 1.0),
        ],
        EV_SCHEMA,
    )
    rows = event_day_summary(ev).collect()
    assert [(r.date, r.n_events_active, r.n_events_road_close, r.n_events_with_coords) for r in rows] == [(D(2014, 7, 1), 1, 1, 1)]


def test_event_sweep_equals_explode(spark):
    from citymotion.operators.summaries import event_day_summary, event_day_summary_exploded

    rnd = random.Random(3)
    rows = []
    for _ in range(300):
        s = T(2020, 1, 1) + dt.timedelta(days=rnd.randint(0, 60), hours=rnd.randint(0, 23))
        e = s + dt.timedelta(days=rnd.randint(-3, 10)) if rnd.random() > 0.1 else None
        rows.append((s, e, rnd.choice([True, False, None]), rnd.choice([43.6, None]), -79.4))
    ev = spark.createDataFrame(rows, EV_SCHEMA)
    a, b = event_day_summary(ev), event_day_summary_exploded(ev)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_collision_route_hour(spark):  # X14
    from citymotion.operators.summaries import collision_route_hour_summary

    c = spark.createDataFrame(
        [
            (1, "J_I", T(2017, 1, 1, 13, 5), True, 0, 12.0),
            (2, "J_I", T(2017, 1, 1, 13, 50), False, 1, 30.0),
            (3, "A_B", T(2017, 1, 1, 13, 10), None, None, 5.0),
            (4, None, T(2017, 1, 1, 13, 10), True, 1, 1.0),
        ],
        "collision_id long, route_id string, ts_utc timestamp_ntz, is_injury boolean, fatalities long, dist_to_route_m double",
    )
    r = {x.route_id: x for x in collision_route_hour_summary(c).collect()}
    assert (r["J_I"].n_collisions, r["J_I"].n_injury_collisions, r["J_I"].n_fatal_collisions, r["J_I"].min_dist_to_route_m) == (2, 1, 1, 12.0)
    assert set(r) == {"J_I", "A_B"} and r["A_B"].n_injury_collisions == 0


# ------------------------------------------------------------------ spatial
def _verts(spark, routes):
    rows = [(rid, i, lon, lat) for rid, pts in routes.items() for i, (lon, lat) in enumerate(pts)]
    return spark.createDataFrame(rows, "route_id string, seq long, lon double, lat double")


def test_snap_near_far_null_and_tie(spark):  # X13, Q19
    from citymotion.operators.spatial import snap_to_routes

    # two opposite corridors over the same street
    routes = {"J_I": [(-79.40, 43.650), (-79.39, 43.650)], "A_B": [(-79.39, 43.650), (-79.40, 43.650)]}
    pts = spark.createDataFrame(
        [(1, -79.395, 43.6502), (2, -79.395, 43.70), (3, None, None)], "collision_id long, lon double, lat double"
    )
    rows = snap_to_routes(pts, _verts(spark, routes)).collect()
    assert len(rows) == 1 and rows[0].collision_id == 1
    assert rows[0].dist_to_route_m < 50 and rows[0].route_id == "A_B"


def test_snap_one_vertex_route_and_radius_inclusive(spark):  # Q20
    from citymotion.functions.geo import utm_sql
    from citymotion.operators.spatial import snap_to_routes

    e, n = utm_sql("lon", "lat")
    v = _verts(spark, {"P_Q": [(-79.4, 43.65)]})
    p = spark.createDataFrame([(1, -79.4, 43.6505)], "collision_id long, lon double, lat double")
    r = snap_to_routes(p, v).collect()
    assert len(r) == 1 and r[0].route_id == "P_Q" and 50 < r[0].dist_to_route_m < 60


def test_grid_snap_equals_brute_force(spark):
    from citymotion.functions.geo import segment_distance_sql, utm_sql
    from citymotion.operators.spatial import segments, snap_to_routes

    rnd = random.Random(7)
    routes = {}
    for r in range(40):
        lon0, lat0 = -79.5 + rnd.random() * 0.1, 43.6 + rnd.random() * 0.06
        pts, n = [], rnd.choice([1, 2, 3, 6])
        for _ in range(n):
            lon0 += (rnd.random() - 0.5) * 0.02
            lat0 += (rnd.random() - 0.5) * 0.01
            pts.append((lon0, lat0))
        routes[f"R{r:02d}_X"] = pts
    v = _verts(spark, routes)
    pts = spark.createDataFrame(
        [(i, -79.5 + rnd.random() * 0.1, 43.6 + rnd.random() * 0.06) for i in range(2000)], "collision_id long, lon double, lat double"
    )
    grid = snap_to_routes(pts, v, max_distance_m=150.0)
    e, n = utm_sql("lon", "lat")
    pp = pts.selectExpr("collision_id", f"{e} AS px", f"{n} AS py")
    cand = pp.crossJoin(segments(v)).withColumn("d", F.expr(segment_distance_sql("px", "py", "ax", "ay", "bx", "by")))
    brute = cand.where("d <= 150.0").groupBy("collision_id").agg(F.min(F.struct("d", "route_id")).alias("b"))
    brute = brute.select("collision_id", F.col("b.route_id").alias("route_id"), F.col("b.d").alias("dist_to_route_m"))
    g = grid.select("collision_id", "route_id", "dist_to_route_m")
    assert g.count() > 50
    assert g.exceptAll(brute).count() == 0 and brute.exceptAll(g).count() == 0


def test_utm_reference_point(spark):
    from citymotion.functions.geo import utm_sql

    e, n = utm_sql("lon", "lat")
    lat = 43 + 38 / 60 + 33.24 / 3600
    lon = -(79 + 23 / 60 + 13.7 / 3600)
    r = spark.sql(f"SELECT {e} AS e, {n} AS n FROM (SELECT {lon} AS lon, {lat} AS lat)").collect()[0]
    assert abs(r.e - 630084.0) < 1.0 and abs(r.n - 4833438.0) < 1.0


# ------------------------------------------------------------------ panel end to end
def _panel_inputs(spark):
    travel = spark.createDataFrame(
        [("J_I", 100.0, 5.0, T(2017, 1, 1, 5, 5), T(2017, 1, 1, 0, 5), 2017, 0), ("J_I", 120.0, 6.0, T(2017, 1, 1, 6, 10), T(2017, 1, 1, 1, 10), 2017, 1)],
        "route_id string, travel_time_s double, sample_count double, ts_utc timestamp_ntz, ts_local timestamp_ntz, year int, src_pos long",
    )
    routes = spark.createDataFrame([("J_I", 90.0, 250.5)], "route_id string, free_flow_s double, length_m double")
    weather = spark.createDataFrame(
        [(T(2017, 1, 1, 5), T(2017, 1, 1, 0), -5.0, 0.0), (T(2017, 1, 1, 6), T(2017, 1, 1, 1), -6.0, None)],
        "ts_utc timestamp_ntz, ts_local timestamp_ntz, temp_c double, precip_mm double",
    )
    from citymotion.operators.calendar import civic_days

    civic = civic_days(cal(spark, [("ny", "New Year's Day", "public_holiday", D(2017, 1, 1), D(2017, 1, 1), 0)]))
    events = spark.createDataFrame([(T(2016, 12, 31, 20), T(2017, 1, 1, 2), True, 43.6, -79.4)], EV_SCHEMA)
    coll = spark.createDataFrame(
        [(1, "J_I", T(2017, 1, 1, 5, 30), True, 0, 25.0)],
        "collision_id long, route_id string, ts_utc timestamp_ntz, is_injury boolean, fatalities long, dist_to_route_m double",
    )
    return travel, routes, weather, civic, events, coll


def test_panel_end_to_end(spark):  # X15
    from citymotion.operators.panel import build_panel, panel_qa

    p = build_panel(*_panel_inputs(spark))
    rows = p.orderBy("ts_utc").collect()
    assert len(rows) == 2
    h0, h1 = rows
    assert (h0.n_collisions, h0.min_dist_to_route_m, h1.n_collisions, h1.min_dist_to_route_m) == (1, 25.0, 0, None)
    assert h0.delay_s == 10.0 and h0.wx_temp_c == -5.0 and h1.wx_temp_c == -6.0
    assert h0.is_public_holiday and h0.holiday_names == "New Year's Day" and h0.n_events_active == 1
    assert (h0.hour, h0.dow, h0.is_weekend) == (0, 6, True)
    qa = panel_qa(p).collect()[0]
    assert qa.weather_match_rate == 1.0 and qa.n_rows == 2 and qa.collision_route_hours_with_exposure == 1


def test_clean_v1(spark):  # X16
    from citymotion.operators.clean import clean_panel_v1, v1_qa

    p = spark.createDataFrame(
        [("A_B", T(2016, 6, 18, 8), 1.0, False, 1.0, 2.0, "x", "H", "M", "e1", "k"), ("A_B", T(2016, 6, 19, 8), 2.0, False, 1.0, 3.0, "y", "", "", "", "")],
        "route_id string, ts_local timestamp_ntz, delay_s double, is_weekend boolean, wx_temp_c double, wx_wind_spd_kmh double, wx_weather_desc string, holiday_names string, mega_event_names string, event_ids string, event_kinds string",
    )
    out = clean_panel_v1(p)
    assert not {"wx_wind_spd_kmh", "wx_weather_desc", "holiday_names", "mega_event_names"} & set(out.columns)
    assert [r.is_weekend for r in out.collect()] == [True, True]
    qa = v1_qa(p).collect()[0]
    assert qa.event_ids_nonempty_rate == 0.5 and qa.is_weekend_rate == 1.0 and qa.n_cols_after == qa.n_cols_before - 4


def test_clean_panel_keep_last_and_masks(spark):
    from citymotion.operators.clean import clean_panel, clean_qa

    p = spark.createDataFrame(
        [
            ("A_B", T(2016, 6, 15, 7), 10.0, 5.0, 3.0, None, None, 0),
            ("A_B", T(2016, 6, 15, 7), 11.0, 6.0, None, 1.0, True, 1),
            ("B_C", T(2016, 6, 15, 7), None, None, 1.0, 2.0, None, 2),
        ],
        "route_id string, ts_local timestamp_ntz, travel_time_s double, delay_s double, sample_count double, wx_temp_c double, is_holiday boolean, src_pos long",
    ).withColumn("wx_precip_mm", F.lit(None).cast("double"))
    c = {r.route_id: r for r in clean_panel(p, min_sample_count=0).collect()}
    assert c["A_B"].travel_time_s == 11.0 and c["A_B"].obs_travel and c["A_B"].obs_weather and c["A_B"].is_holiday
    assert not c["B_C"].obs_travel and c["B_C"].is_holiday is False
    assert abs(c["A_B"].hour_sin - math.sin(2 * math.pi * 7 / 24)) < 1e-12
    assert clean_qa(p, clean_panel(p)).collect()[0].n_dupes_dropped == 1


# ------------------------------------------------------------------ network / frames
def test_route_metrics_and_split(spark):  # X17, X18
    from citymotion.operators.network import aggregate_route_metrics

    p = spark.createDataFrame([("A_B", 10.0), ("A_B", 30.0), ("B_C", 100.0), ("B_C", 200.0)], "route_id string, delay_s double")
    m = {r.route_id: r for r in aggregate_route_metrics(p).collect()}
    assert m["A_B"].value == 20.0 and (m["A_B"].source, m["A_B"].target) == ("A", "B") and len(m) == 2
    assert {r.route_id: r.value for r in aggregate_route_metrics(p, agg="p95").collect()}["A_B"] == pytest.approx(29.0)
    bad = spark.createDataFrame([("AC4_AC3", 1.0), ("INVALID", 2.0)], "route_id string, delay_s double")
    with pytest.raises(Exception, match="SOURCE_TARGET"):
        aggregate_route_metrics(bad).collect()
    with pytest.raises(ValueError):
        aggregate_route_metrics(p, agg="bogus")


def test_congestion_frames(spark):  # X19
    from citymotion.operators.frames import congestion_buckets, congestion_pivot, frame_labels, period
    from citymotion.operators.summaries import date_bounds

    p = spark.createDataFrame(
        [
            ("A_B", T(2016, 6, 15, 11, 5), T(2016, 6, 15, 7, 5), D(2016, 6, 15), 10.0),
            ("B_C", T(2016, 6, 15, 11, 10), T(2016, 6, 15, 7, 10), D(2016, 6, 15), 80.0),
            ("A_B", T(2016, 6, 15, 12, 0), T(2016, 6, 15, 8, 0), D(2016, 6, 15), 20.0),
            ("A_B", T(2016, 6, 16, 12, 0), T(2016, 6, 16, 8, 0), D(2016, 6, 16), 30.0),
        ],
        "route_id string, ts_utc timestamp_ntz, ts_local timestamp_ntz, date date, delay_s double",
    )
    b = congestion_buckets(p, start="2016-06-15", end="2016-06-16", freq="h")
    assert [r.label for r in frame_labels(b).collect()] == ["2016-06-15 07:00", "2016-06-15 08:00", "2016-06-16 08:00"]
    wide = {(r.route_id, r.date_utc): r for r in congestion_pivot(b).collect()}
    assert wide["A_B", D(2016, 6, 15)].h11 == 10.0 and wide["B_C", D(2016, 6, 15)].h11 == 80.0
    assert wide["A_B", D(2016, 6, 16)].h12 == 30.0 and wide["B_C", D(2016, 6, 15)].h12 is None and len(wide) == 3
    bounds = date_bounds(p).collect()[0]
    assert (bounds.min_date, bounds.max_date) == (D(2016, 6, 15), D(2016, 6, 16))
    with pytest.raises(ValueError):
        period(p, "2016-06-16", "2016-06-15")
    with pytest.raises(ValueError):
        congestion_buckets(p, freq="h", max_frames=2)
    with pytest.raises(ValueError, match="holds no rows"):
        congestion_buckets(p, start="2017-01-01", end="2017-01-02", freq="h")


def test_intensity_scaling(spark):
    from citymotion.operators.frames import robust_bounds, scale_intensity

    v = spark.createDataFrame([(float(x),) for x in range(101)] + [(float("nan"),), (None,)], "value double")
    b = robust_bounds(v).collect()[0]
    assert (b.vmin, b.vmax) == (5.0, 95.0)
    flat = robust_bounds(spark.createDataFrame([(3.0,), (3.0,)], "value double")).collect()[0]
    assert (flat.vmin, flat.vmax) == (3.0, 4.0)
    s = scale_intensity(spark.createDataFrame([(50.0,), (1000.0,), (None,)], "value double"), 5.0, 95.0).collect()
    assert s[0].width == pytest.approx(1.5 + 5 * 0.5) and s[1].t == 1.0 and s[2].width == 1.5


# ------------------------------------------------------------------ scoring
def test_trailing_windows_match_brute_force(spark):
    from citymotion.operators.scoring import trailing_windows

    rnd = random.Random(11)
    rows = []
    for r in ("A_B", "C_D"):
        for k in range(80):
            if rnd.random() < 0.7:
                rows.append((r, T(2017, 1, 1) + dt.timedelta(minutes=5 * k), float(k)))
    s = spark.createDataFrame(rows, "route_id string, step_utc timestamp_ntz, x double")
    got = {(r.route_id, r.window_end): (r.n_steps, r.history) for r in trailing_windows(s, size=12).collect()}
    want = {}
    for rid, t, x in rows:
        hist = [xx for (rr, tt, xx) in rows if rr == rid and t - dt.timedelta(minutes=55) <= tt <= t]
        want[(rid, t)] = (len(hist), hist)
    assert got == want


def test_normative_mask_fallback(spark):
    from citymotion.operators.scoring import normative_mask

    rows = []
    for i in range(40):  # dense stratum (hour 8, dow 0)
        rows.append(("A_B", 8, 0, float(i), True, 0.0, 2016))
    rows.append(("A_B", 9, 1, 100.0, True, 0.0, 2016))  # sparse stratum -> falls back to route
    rows.append(("A_B", 8, 0, 1.0, True, 3.0, 2017))  # heavy rain -> not normative
    p = spark.createDataFrame(rows, "route_id string, hour long, dow long, delay_s double, obs_travel boolean, wx_precip_mm double, year int")
    out = normative_mask(p, train_years=[2016]).collect()
    dense = [r for r in out if r.hour == 8 and r.year == 2016]
    assert dense[0].delay_threshold == pytest.approx(39 * 0.85)
    sparse = [r for r in out if r.hour == 9][0]
    all_vals = sorted([float(i) for i in range(40)] + [100.0])
    pos = 0.85 * (len(all_vals) - 1)
    lo = math.floor(pos)
    assert sparse.delay_threshold == pytest.approx(all_vals[lo] + (pos - lo) * (all_vals[lo + 1] - all_vals[lo]))
    rain = [r for r in out if r.year == 2017][0]
    assert rain.is_normative is False


@pytest.mark.parametrize("block", [1, 1000])
def test_adjacency_lists_every_pair(spark, monkeypatch, block):  # F6 (r04)
    from citymotion.operators import scoring

    monkeypatch.setattr(scoring, "PAIR_BLOCK", block)
    ends = [("A", "B"), ("A", "B"), ("B", "C"), ("B", "B"), ("B", "D"), ("D", "A"), ("X", "Y"), (None, "A"), ("C", None)]
    edges = [(f"{s}_{t}", s, t) for s, t in ends]
    got = [tuple(r) for r in scoring.adjacency(spark.createDataFrame(edges, "route_id string, source string, target string")).collect()]
    n_in = lambda n: sum(t == n for _, t in ends) if n else sum(t is None for _, t in ends)
    n_out = lambda n: sum(s == n for s, _ in ends) if n else sum(s is None for s, _ in ends)
    want = [(t, a, b, n_in(t), n_out(t), n_in(t) * n_out(t)) for a, _, t in edges for b, s, _ in edges if t is not None and s == t]
    want += [("X", None, None, 0, 1, 0), ("Y", None, None, 1, 0, 0), (None, None, None, 1, 0, 0), (None, None, None, 0, 1, 0)]
    assert sorted(got, key=str) == sorted(want, key=str) and ("B", "B_B", "B_B", 3, 3, 9) in got


def test_standardize_train_only(spark):
    from citymotion.operators.scoring import standardize

    p = spark.createDataFrame([(1.0, 2016), (3.0, 2016), (100.0, 2017)], "travel_time_s double, year int")
    z = [r.travel_time_s_z for r in standardize(p, ["travel_time_s"], train_years=[2016]).orderBy("travel_time_s").collect()]
    assert z == [-1.0, 1.0, 98.0]


def test_keep_last_groups_nulls(spark):
    from citymotion.operators.normalize import keep_last

    df = spark.createDataFrame([(None, 1, "a"), (None, 2, "b"), ("k", 1, "c")], "key string, o long, v string")
    got = {r.key: r.v for r in keep_last(df, ["key"], ["o"]).collect()}
    assert got == {None: "b", "k": "c"}


def test_pivot_on_the_autumn_dst_day(spark):
    from citymotion.operators.frames import congestion_buckets, congestion_pivot

    p = spark.createDataFrame([("A_B", T(2017, 11, 5, 5, 5), 1.0), ("A_B", T(2017, 11, 5, 6, 5), 2.0)], "route_id string, ts_utc timestamp_ntz, delay_s double")
    b = congestion_buckets(p, freq="h")
    assert {r.label for r in b.collect()} == {"2017-11-05 01:00"}
    (r,) = congestion_pivot(b).collect()
    assert (r.h05, r.h06) == (1.0, 2.0)


def test_quantiles_with_ties_and_a_global_key(spark):
    from citymotion.operators.quantiles import exact_quantiles

    df = spark.range(40_000).select(F.when(F.col("id") % 5 != 0, F.lit(60.0)).otherwise(F.col("id").cast("double")).alias("v"))
    qs = [0.0, 0.1, 0.5, 0.9, 0.99, 1.0]
    got = exact_quantiles(df, [], "v", qs, accuracy=200).first()
    want = df.agg(*[F.percentile("v", q) for q in qs]).first()
    assert list(got) == pytest.approx(list(want), rel=1e-12)
    plan = exact_quantiles(df, [], "v", [0.5])._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan


def test_global_quantiles_need_no_single_task(spark):
    from citymotion.operators.quantiles import exact_quantiles

    inf = float("inf")
    rng = random.Random(5)
    cases = [
        [rng.lognormvariate(0, 9) * rng.choice((-1, 1)) for _ in range(5000)] + [0.0] * 700,
        [-inf] * 3 + [1e308, -1e308, 5e-324, 0.0] + [inf] * 2 + [1.0, 1.0],
        [7.0], [3.0] * 40, [1.0, 2.0],
    ]
    qs = [0.0, 0.05, 0.5, 0.95, 1.0]
    for values in cases:
        df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "v double").repartition(3)
        got = exact_quantiles(df, [], "v", qs, accuracy=100, count_name="n").first()
        ordered = sorted(values)
        assert got[0] == len(values)
        for q, x in zip(qs, got[1:]):
            at = q * (len(values) - 1)
            a, z = ordered[int(at)], ordered[min(int(at) + 1, len(values) - 1)]
            want = a if a == z or at == int(at) else a + (at - int(at)) * (z - a)
            assert x == want or x != x and want != want
    none = exact_quantiles(spark.createDataFrame([], "v double"), [], "v", [0.5], names=["m"], count_name="n").collect()
    assert [tuple(r) for r in none] == [(0, None)]
    plan = exact_quantiles(df, [], "v", [0.5])._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Join" not in plan


def test_exact_quantiles_match_percentile(spark):
    from citymotion.operators.quantiles import exact_quantiles

    rnd = random.Random(5)
    rows = [("hot", float(rnd.randint(0, 500))) for _ in range(20000)]  # many duplicates
    rows += [("k%d" % (i % 7), rnd.gauss(0, 1)) for i in range(3000)]
    rows += [("nulls", None), ("one", 4.0), ("hot", float("nan")), (None, 1.0), (None, 3.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    qs = [0.0, 0.05, 0.5, 0.85, 0.95, 1.0]
    for acc in (100_000, 50):  # a small accuracy: wide brackets
        got = {r.g: r for r in exact_quantiles(df, ["g"], "v", qs, accuracy=acc).collect()}
        clean = df.where(~F.isnan("v") | F.col("v").isNull())
        want = {r.g: r for r in clean.groupBy("g").agg(*[F.percentile("v", q).alias(f"q{str(q).replace('.', '_')}") for q in qs]).collect()}
        assert set(got) == set(want)
        for g in want:
            for q in qs:
                n = f"q{str(q).replace('.', '_')}"
                a, b = got[g][n], want[g][n]
                assert (a is None and b is None) or a == pytest.approx(b, rel=1e-12, abs=1e-12), (g, q, a, b)
    glob = exact_quantiles(df.where(F.col("g") == "hot"), [], "v", [0.5]).collect()
    assert len(glob) == 1 and glob[0].q0_5 == pytest.approx(df.where((F.col("g") == "hot") & ~F.isnan("v")).agg(F.percentile("v", 0.5)).first()[0])


def test_average_precision_and_labels_brute_force(spark):
    from citymotion.operators.scoring import average_precision, label_rows

    rnd = random.Random(9)
    scored = []
    for i in range(600):
        scored.append((rnd.choice(["A_B", "C_D"]), T(2017, 1, 1) + dt.timedelta(minutes=rnd.randint(0, 3000)), float(rnd.randint(0, 40))))
    coll = [(i, rnd.choice(["A_B", "C_D"]), T(2017, 1, 1) + dt.timedelta(minutes=rnd.randint(0, 3000))) for i in range(60)]
    s = spark.createDataFrame(scored, "route_id string, ts_utc timestamp_ntz, score double").dropDuplicates(["route_id", "ts_utc"])
    c = spark.createDataFrame(coll, "collision_id long, route_id string, ts_utc timestamp_ntz")
    lab = label_rows(s, c, horizon_minutes=60)
    rows = lab.collect()
    for r in rows:
        want = any(cr == r.route_id and r.ts_utc < ct <= r.ts_utc + dt.timedelta(minutes=60) for _, cr, ct in coll)
        assert r.label == want
    # average precision over distinct-score thresholds, high to low
    by = {}
    for r in rows:
        n, tp = by.get(r.score, (0, 0))
        by[r.score] = (n + 1, tp + int(r.label))
    P = sum(tp for _, tp in by.values())
    cn = ctp = 0
    ap = 0.0
    for sc in sorted(by, reverse=True):
        n, tp = by[sc]
        cn += n
        ctp += tp
        ap += tp / P * (ctp / cn)
    got = average_precision(lab).collect()[0]
    assert got.n_positive == P and got.average_precision == pytest.approx(ap, rel=1e-12)


def test_keep_last_sparse_matches_keep_last(spark):
    from citymotion.operators.normalize import keep_last, keep_last_sparse

    rows = [("k%d" % (i % 50), i, float(i)) for i in range(300)] + [("u%d" % i, 0, 1.0) for i in range(40)] + [(None, 5, 2.0), (None, 6, 3.0)]
    df = spark.createDataFrame(rows, "key string, o long, v double")
    a = keep_last(df, ["key"], ["o"]).select("key", "o", "v")
    b = keep_last_sparse(df, ["key"], ["o"]).select("key", "o", "v")
    assert b.count() == a.count()
    assert a.exceptAll(b).count() == 0
    none = spark.createDataFrame([("a", 1, 1.0)], "key string, o long, v double")
    assert keep_last_sparse(none, ["key"], ["o"]).count() == 1


def test_intensity_frames_errors(spark):
    from citymotion.operators.frames import intensity_frames

    b = spark.createDataFrame([(T(2016, 6, 15, 11), "l", "A_B", 1.0)], "bucket_utc timestamp_ntz, label string, route_id string, value double")
    v = spark.createDataFrame([("X_Y", 0, -79.4, 43.6)], "route_id string, seq long, lon double, lat double")
    with pytest.raises(ValueError, match="geometry"):
        intensity_frames(b, v)
    nan = spark.createDataFrame([(T(2016, 6, 15, 11), "l", "X_Y", float("nan"))], "bucket_utc timestamp_ntz, label string, route_id string, value double")
    with pytest.raises(ValueError, match="finite"):
        intensity_frames(nan, v)


def test_snap_of_repeated_and_missing_ids(spark):
    from citymotion.operators.spatial import nearest_routes

    verts = spark.createDataFrame([("A_B", 0, -79.40, 43.60), ("A_B", 1, -79.39, 43.60), ("C_D", 0, -79.40, 43.70), ("C_D", 1, -79.39, 43.70)], "route_id string, seq long, lon double, lat double")
    pts = spark.createDataFrame(
        [(1, -79.395, 43.6001), (1, -79.395, 43.7001), (None, -79.395, 43.6001), (2, -79.395, 43.65), (2, -79.395, 43.6001), (3, None, 43.6)],
        "collision_id long, lon double, lat double",
    )
    got = sorted((str(r.collision_id), r.lat, r.route_id) for r in nearest_routes(pts, verts).collect())
    assert got == [("1", 43.6001, "A_B"), ("1", 43.7001, "C_D"), ("2", 43.6001, "A_B"), ("2", 43.65, None), ("None", 43.6001, "A_B")]


def test_route_metric_aggregates(spark):
    from citymotion.operators.network import aggregate_route_metrics

    rows = [("A_B", 3, 5.0), ("A_B", 1, None), ("A_B", 2, 1.0), ("A_B", 4, 5.0), ("A_B", 5, None), ("B_C", 1, None)]
    df = spark.createDataFrame(rows, "route_id string, src_pos long, delay_s double").repartition(4)
    want = {"first": (1.0, None), "last": (5.0, None), "sum": (11.0, 0.0), "min": (1.0, None), "max": (5.0, None), "count": (3.0, 0.0), "nunique": (2.0, 0.0), "size": (5.0, 1.0)}
    for agg, (a, b) in want.items():
        got = {r.route_id: r.value for r in aggregate_route_metrics(df, agg=agg).collect()}
        assert (got["A_B"], got["B_C"]) == (a, b), agg


def test_panel_does_not_shuffle_the_fact_before_incidents(spark):
    import __spark_entry__ as E  # noqa: F401  puts the repository on the path
    from citymotion.plans import registry

    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")
    old = {k: spark.conf.get(k) for k in keys}
    try:
        spark.conf.set(keys[0], "-1")  # as if every estimate were too high
        spark.conf.set(keys[1], "false")
        plan = registry.build_panel_df(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert plan.count("BroadcastHashJoin") == 3
    assert exchanges and all("route_id" in x and "ts_hour_utc" in x for x in exchanges)
