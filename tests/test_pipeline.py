"""End-to-end step runner over a raw folder built from the fixtures (E1, X15-like)."""

import datetime as dt

from tests.shapes import dbf_bytes, shp_bytes, write_zip
from tests.test_ingest import FEST_XML, TRAVEL_HEADER, _collisions_csv


def test_pipeline_all_steps(spark, tmp):
    from citymotion.plans.pipeline import PipelineConfig, run_step

    raw = tmp / "raw"
    tt = raw / "travel_times_bluetooth"
    tt.mkdir(parents=True)
    write_zip(tt / "travel-time-2014.zip", {"a.csv": TRAVEL_HEADER + "J_I,100,5,2014-11-16T12:05:00-05\nJ_I,120,6,2014-11-16T13:10:00-05\n"})
    fields = [("resultId", "C", 8, 0), ("normalDriv", "N", 5, 0), ("length_m", "N", 8, 1)]
    write_zip(
        tt / "bluetooth-routes-wgs84.zip",
        {"r.dbf": dbf_bytes(fields, [("J_I", 90, "250.5")]), "r.shp": shp_bytes([[(-79.40, 43.650), (-79.39, 43.650)]]), "r.shx": b""},
    )
    wx = raw / "weather_toronto_city"
    wx.mkdir()
    (wx / "hourly_2014_11.csv").write_text(
        '"Date/Time (LST)","Temp (°C)","Precip. Amount (mm)"\n"2014-11-16 12:00","1.0","0.0"\n"2014-11-16 13:00","2.0",""\n', encoding="utf-8"
    )
    fe = raw / "festivals_events"
    fe.mkdir()
    (fe / "fest.xml").write_text(FEST_XML.replace("2016-07-08", "2014-11-16").replace("July 10, 2016", "November 17, 2014"), encoding="utf-8")
    tc = raw / "traffic_collisions"
    tc.mkdir()
    # 2014-11-16 00:00 EST = 05:00 UTC epoch ms; hour 12 local, 20 m north of the corridor
    ms = int(dt.datetime(2014, 11, 16, 5, 0, tzinfo=dt.timezone.utc).timestamp() * 1000)
    _collisions_csv(tc / "c.csv", [f"1,{ms},November,Sunday,2014,12,D11,0,YES,NO,NO,1,H,-79.395,43.65018,YES,NO,NO,NO,NO"])
    cal = tmp / "cal.yaml"
    cal.write_text("start_year: 2014\nend_year: 2014\nevents:\n  - {id: x, name: Fest, kind: mega_event, start_date: 2014-11-16}\n")
    cfg = PipelineConfig(raw_dir=str(raw), interim_dir=str(tmp / "interim"), processed_dir=str(tmp / "processed"), calendar_path=str(cal))
    run_step(spark, "all", cfg)
    p = spark.read.parquet(str(tmp / "processed" / "route_time_panel")).orderBy("ts_utc").collect()
    assert len(p) == 2
    a, b = p
    assert a.free_flow_s == 90.0 and a.delay_s == 10.0 and a.wx_temp_c == 1.0 and b.wx_temp_c == 2.0
    assert a.is_mega_event and a.mega_event_names == "Fest" and a.n_events_active == 1 and a.n_events_road_close == 1
    assert a.n_collisions == 1 and 15 < a.min_dist_to_route_m < 25 and b.n_collisions == 0
    qa = spark.read.json(str(tmp / "processed" / "route_time_panel_qa")).collect()[0]
    assert qa.n_rows == 2 and qa.weather_match_rate == 1.0
    v1 = spark.read.parquet(str(tmp / "processed" / "route_time_panel_v1"))
    assert "mega_event_names" not in v1.columns and v1.count() == 2
    snap = spark.read.json(str(tmp / "interim" / "collisions_qa")).collect()[0]
    assert snap.n_route_matched == 1
