import datetime as dt

import pytest
from pyspark.sql import functions as F

from citymotion.operators import ingest
from tests.shapes import dbf_bytes, shp_bytes, write_zip

TRAVEL_HEADER = "resultId,timeInSeconds,count,updated\n"


def _travel_zip(folder, name, lines):
    folder.mkdir(parents=True, exist_ok=True)
    return write_zip(folder / name, {"data/tt.csv": TRAVEL_HEADER + "\n".join(lines) + "\n", "__MACOSX/._tt.csv": "junk"})


def test_travel_zip_drops_zero_and_takes_year_from_name(spark, tmp):  # X1
    _travel_zip(tmp, "travel-time-2017.zip", ["Q7_R2,91.5,33,2017-03-03T06:40:00-05", "Q7_R2,47,12,2017-03-03T09:20:00-05", "R2_S1,0,4,2017-03-03T06:45:00-05"])
    rows = ingest.normalize_travel_times(spark, str(tmp)).orderBy("ts_utc").collect()
    assert [r.route_id for r in rows] == ["Q7_R2", "Q7_R2"]
    assert {r.year for r in rows} == {2017}
    assert rows[0].ts_utc == dt.datetime(2017, 3, 3, 11, 40)
    assert rows[0].ts_local == dt.datetime(2017, 3, 3, 6, 40)
    assert rows[0].sample_count == 33.0


def test_travel_zip_mixed_offsets(spark, tmp):  # X2
    _travel_zip(tmp, "travel-time-2016.zip", ["Q7_R2,88,21,2016-02-09T23:55:00-05", "Q7_R2,73,8,2016-08-09T23:55:00-04"])
    rows = ingest.normalize_travel_times(spark, str(tmp)).orderBy("ts_utc").collect()
    assert [r.ts_local for r in rows] == [dt.datetime(2016, 2, 9, 23, 55), dt.datetime(2016, 8, 9, 23, 55)]
    assert [r.ts_utc for r in rows] == [dt.datetime(2016, 2, 10, 4, 55), dt.datetime(2016, 8, 10, 3, 55)]


def test_travel_year_filter_prunes_archives(spark, tmp):
    _travel_zip(tmp, "travel-time-2016.zip", ["A_B,10,1,2016-01-15T00:05:00-05"])
    _travel_zip(tmp, "travel-time-2017.zip", ["A_B,10,1,2017-01-15T00:05:00-05"])
    assert {r.year for r in ingest.normalize_travel_times(spark, str(tmp), years=[2017]).collect()} == {2017}
    with pytest.raises(FileNotFoundError):
        ingest.normalize_travel_times(spark, str(tmp), years=[2015])


def test_travel_missing_columns(spark, tmp):
    tmp.mkdir(exist_ok=True)
    write_zip(tmp / "travel-time-2017.zip", {"x.csv": "resultId,count\nA_B,1\n"})
    with pytest.raises(Exception, match="missing columns"):
        ingest.normalize_travel_times(spark, str(tmp)).collect()


def test_weather_csv(spark, tmp):  # X3
    p = tmp / "hourly_2014_01.csv"
    p.write_text(
        '﻿"Date/Time (LST)","Temp (°C)","Rel Hum (%)","Precip. Amount (mm)","Wind Spd (km/h)","Stn Press (kPa)"\n'
        '"2014-01-01 00:00","-5.0","80","0.2","10","100.1"\n"2014-01-01 01:00","-6.0","82","","12","100.2"\n',
        encoding="utf-8",
    )
    rows = ingest.normalize_weather(spark, str(tmp)).orderBy("ts_utc").collect()
    assert len(rows) == 2
    assert rows[0].temp_c == -5.0 and rows[1].precip_mm is None
    assert rows[0].ts_utc == dt.datetime(2014, 1, 1, 5, 0)


def test_weather_missing_columns_tolerated(spark, tmp):  # X4
    (tmp / "hourly_2014_02.csv").write_text('"Date/Time (LST)","Temp (°C)"\n"2014-02-01 00:00","-5.0"\n', encoding="utf-8")
    df = ingest.normalize_weather(spark, str(tmp))
    assert df.columns == ["ts_utc", "ts_local", "temp_c"]
    assert df.collect()[0].temp_c == -5.0


def test_weather_dst_rows_and_keep_last(spark, tmp):
    (tmp / "hourly_2017_03.csv").write_text(
        '"Date/Time (LST)","Temp (°C)"\n"2017-03-12 02:00","1.0"\n"2017-03-12 03:00","2.0"\n'
        '"2017-11-05 01:00","3.0"\n"2017-11-05 01:00","4.0"\n"junk","5.0"\n',
        encoding="utf-8",
    )
    rows = ingest.normalize_weather(spark, str(tmp)).collect()
    by = {r.ts_utc: r.temp_c for r in rows}
    # 02:00 (gap) and 03:00 both map to 03:00 EDT; the 03:00 reading wins (later wall time)
    assert by[dt.datetime(2017, 3, 12, 7, 0)] == 2.0
    # ambiguous hour -> NULL instant, duplicates collapse to one row; junk time dropped
    assert None in by and len(rows) == 2


def _collisions_csv(path, rows):
    header = "_id,OCC_DATE,OCC_MONTH,OCC_DOW,OCC_YEAR,OCC_HOUR,DIVISION,FATALITIES,INJURY_COLLISIONS,FTR_COLLISIONS,PD_COLLISIONS,HOOD_158,NEIGHBOURHOOD_158,LONG_WGS84,LAT_WGS84,AUTOMOBILE,MOTORCYCLE,PASSENGER,BICYCLE,PEDESTRIAN\n"
    path.write_text(header + "\n".join(rows) + "\n")


def test_collisions_parse(spark, tmp):  # X12
    from citymotion.sources.text_formats import read_collisions_csv

    p = tmp / "collisions.csv"
    _collisions_csv(
        p,
        [
            "1,1388552400000,January,Wednesday,2014,15,D11,0,NO,NO,YES,1,Hood,-79.4,43.65,YES,NO,NO,NO,NO",
            "2,1388552400000,January,Wednesday,2014,9,D11,0,NO,NO,YES,1,Hood,0,0,YES,NO,NO,NO,NO",
            "3,1514782800000,January,Monday,2018,9,D11,0,NO,NO,YES,1,Hood,-79.4,43.65,YES,NO,NO,NO,NO",
        ],
    )
    rows = ingest.parse_collisions(read_collisions_csv(spark, str(p))).collect()
    assert len(rows) == 1
    r = rows[0]
    assert r.hour == 15 and r.is_pd is True and r.is_injury is False and r.date == dt.date(2014, 1, 1)
    assert r.ts_local == dt.datetime(2014, 1, 1, 15, 0)


def test_collision_hours_are_elapsed_time(spark, tmp):  # Q4: spring-forward day
    from citymotion.sources.text_formats import read_collisions_csv

    p = tmp / "c.csv"
    # 2017-03-12 00:00 EST = 05:00 UTC
    _collisions_csv(p, ["7,1489294800000,March,Sunday,2017,9,D11,1,YES,NO,NO,1,H,-79.4,43.65,YES,NO,NO,NO,NO"])
    r = ingest.parse_collisions(read_collisions_csv(spark, str(p))).collect()[0]
    assert r.ts_local == dt.datetime(2017, 3, 12, 10, 0) and r.hour == 9 and r.fatalities == 1


FEST_XML = """<viewentries>
<viewentry position="9" unid="harbour-7">
 <entrydata name="RoadClose"><text> Quay St from 3rd to 5th </text></entrydata>
 <entrydata name="txtLong"><text>79.25 W, -79.25</text></entrydata>
 <entrydata name="EventName"><text>Boats &lt;and&gt; Lanterns</text></entrydata>
 <entrydata name="DateBeginShow"><text>2016-07-08</text></entrydata>
 <entrydata name="TimeBegin"><text>20:45</text></entrydata>
 <entrydata name="DateEndShow"><text>July 10, 2016</text></entrydata>
 <entrydata name="TimeEnd"><text>1:05 AM</text></entrydata>
 <entrydata name="txtLat"><text>lat 1,043.5</text></entrydata>
 <entrydata name="CategoryList"><textlist><text>Water</text><text>  </text><text>Night </text></textlist></entrydata>
 <entrydata name="Location"><text>Pier</text><text>North side</text></entrydata>
</viewentry>
<viewentry>
 <entrydata name="DateBeginShow"><text>Mar 2, 2017</text></entrydata>
 <entrydata name="EventName"><text>First title</text></entrydata>
 <entrydata name="RoadClose"><text>NONE</text></entrydata>
 <entrydata name="EventName"><text>Second title</text></entrydata>
 <entrydata name="TimeBegin"><text>after dusk</text></entrydata>
</viewentry>
</viewentries>
"""


def test_festivals_xml(spark, tmp):  # X7, X8
    from citymotion.sources.text_formats import read_festival_entries

    (tmp / "fest.xml").write_text(FEST_XML, encoding="utf-8")
    rows = {r.event_id: r for r in ingest.normalize_festivals(read_festival_entries(spark, str(tmp / "fest.xml"))).collect()}
    assert sorted(rows) == ["harbour-7", "row-1"]
    boats, late = rows["harbour-7"], rows["row-1"]
    assert (boats.name, boats.category, boats.location) == ("Boats <and> Lanterns", "Water | Night", "Pier | North side")
    assert boats.road_close is True and boats.lat == 1043.5 and boats.lon == 79.25 and boats.area is None
    assert (boats.start_local, boats.end_local) == (dt.datetime(2016, 7, 8, 20, 45), dt.datetime(2016, 7, 10, 1, 5))
    assert (late.name, late.road_close, late.lat) == ("Second title", False, None)
    assert late.start_local == late.end_local == dt.datetime(2017, 3, 2)


def _routes_zip(folder, ids_pts, fields_extra=True):
    fields = [("resultId", "C", 8, 0), ("normalDriv", "N", 5, 0), ("length_m", "N", 8, 1)]
    recs = [(rid, 90, "250.5") for rid, _ in ids_pts]
    folder.mkdir(parents=True, exist_ok=True)
    return write_zip(
        folder / "bluetooth-routes-wgs84.zip",
        {"r.dbf": dbf_bytes(fields, recs), "r.shp": shp_bytes([p for _, p in ids_pts]), "r.shx": b"", "__MACOSX/._r.dbf": b"x"},
    )


def test_routes_dbf(spark, tmp):  # X9
    _routes_zip(tmp, [("J_I", [(-79.4, 43.65), (-79.39, 43.66)])])
    r = ingest.normalize_routes(spark, str(tmp)).collect()[0]
    assert (r.route_id, r.free_flow_s, r.length_m) == ("J_I", 90.0, 250.5)


def test_dbf_deleted_and_blank():
    from citymotion.sources.dbase import decode_dbf

    data = dbf_bytes([("a", "C", 4, 0), ("n", "N", 4, 0)], [("x", "1"), ("y", " "), ("z", "3")], deleted={1})
    f = decode_dbf(data)
    assert f["a"].to_pylist() == ["x", "z"] and f["n"].to_pylist() == [1, 3] and f["record"].to_pylist() == [0, 2]


def test_shapefile_vertices(spark, tmp):  # S7: trimmed ids, empty dropped, duplicate -> last
    from citymotion.sources.dbase import read_route_vertices

    _routes_zip(tmp, [(" A_B ", [(1.0, 2.0), (3.0, 4.0)]), ("C_D", []), ("A_B", [(5.0, 6.0)])])
    rows = read_route_vertices(spark, str(tmp), "*.zip").orderBy("route_id", "seq").collect()
    assert [(r.route_id, r.seq, r.lon, r.lat) for r in rows] == [("A_B", 0, 5.0, 6.0)]


def test_listing_and_zip_preview(spark, tmp):  # X20, X21
    from citymotion.sources.archives import read_zip_csv
    from citymotion.sources.preview import list_raw_files

    (tmp / ".gitkeep").write_text("")
    (tmp / "keep.csv").write_text("a\n1\n")
    (tmp / "keep.csv.partial").write_text("a\n")
    names = [r.path.rsplit("/", 1)[-1] for r in list_raw_files(spark, str(tmp)).collect()]
    assert names == ["keep.csv"]
    sub = tmp / "z"
    _travel_zip(sub, "travel-time-2017.zip", ["Q7_R2,91.5,33,2017-03-03T06:40:00-05", "Q7_R2,47,12,2017-03-03T09:20:00-05"])
    sample = read_zip_csv(spark, str(sub), "*.zip", ["resultId", "timeInSeconds", "count", "updated"], limit=1)
    rows = sample.collect()
    assert len(rows) == 1 and len(sample.columns) == 7


def test_epoch_median_decision_exact(spark):
    import statistics

    from citymotion.operators.ingest import occ_dates_are_epoch_ms

    cases = [[1.0, 2e12], [1.0, 2e12, 3e12], [5e10, 2e11], [5e10, 1.4e11], ["2014-01-01", 2e12, 3e12], [1e12, 1e12, 1.0, 2.0]]
    for vals in cases:
        df = spark.createDataFrame([(str(v),) for v in vals], "OCC_DATE string")
        nums = [float(v) for v in vals if not isinstance(v, str)]
        assert occ_dates_are_epoch_ms(df) == (statistics.median(nums) > 1e11), vals


def test_collision_surrogate_ids_after_year_filter(spark, tmp):  # P12
    from citymotion.sources.text_formats import read_collisions_csv

    p = tmp / "noid.csv"
    p.write_text(
        "OCC_DATE,OCC_YEAR,OCC_HOUR,LONG_WGS84,LAT_WGS84\n"
        "1388552400000,2014,1,-79.4,43.65\n1514782800000,2018,2,-79.4,43.65\n"
        "1388552400000,2014,3,-79.4,43.65\n1388552400000,2014,4,0,0\n"
    )
    rows = ingest.parse_collisions(read_collisions_csv(spark, str(p))).orderBy("collision_id").collect()
    # 2018 row removed before numbering; the unlocated row keeps its number but is dropped
    assert [(r.collision_id, r.hour) for r in rows] == [(1, 1), (2, 3)]


def test_weather_files_with_different_header_order(spark, tmp_path):
    from citymotion.operators.ingest import normalize_weather_rows
    from citymotion.sources.text_formats import read_weather_csv

    (tmp_path / "hourly_1.csv").write_text('"Date/Time (LST)","Temp (°C)","Rel Hum (%)"\n2014-01-01 00:00,-9.0,70\n', encoding="utf-8")
    (tmp_path / "hourly_2.csv").write_text('\ufeff"Date/Time (LST)","Rel Hum (%)","Temp (°C)","Stn Press (kPa)"\n2014-02-01 00:00,60,-4.5,100.5\n', encoding="utf-8")
    out = normalize_weather_rows(read_weather_csv(spark, [str(tmp_path / "hourly_1.csv"), str(tmp_path / "hourly_2.csv")]))
    got = sorted((r.temp_c, r.rel_hum_pct, r.stn_press_kpa) for r in out.select("temp_c", "rel_hum_pct", F.coalesce("stn_press_kpa", F.lit(-1.0)).alias("stn_press_kpa")).collect())
    assert got == [(-9.0, 70.0, -1.0), (-4.5, 60.0, 100.5)]


def test_csv_quotes_and_line_breaks(spark, tmp_path):
    from citymotion.sources.text_formats import read_collisions_csv

    p = tmp_path / "c.csv"
    p.write_text('_id,NEIGHBOURHOOD_158,OCC_YEAR\n1,"Old ""Mill"", West",2014\n2,"two\nlines",2015\n3,plain,2016\n', encoding="utf-8")
    rows = read_collisions_csv(spark, str(p)).orderBy("pos").collect()
    assert [(r["_id"], r["NEIGHBOURHOOD_158"], r["OCC_YEAR"]) for r in rows] == [("1", 'Old "Mill", West', "2014"), ("2", "two\nlines", "2015"), ("3", "plain", "2016")]


@pytest.mark.parametrize("zone", ["America/Los_Angeles", "Asia/Tokyo"])
def test_text_without_offset_is_utc_in_any_session_zone(spark, zone):
    from citymotion.functions.timez import parse_offset_timestamp

    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        texts = ["2017-01-01 00:05:00", "2017-01-01T00:05:00", "2017-01-01T00:05:00-05", "2017-01-01T00:05:00+05:30", "2017-01-01T00:05:00Z", "2017-01-01", "2017-01-01 00:05", "junk", None]
        df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
        got = [r.u for r in df.select("k", parse_offset_timestamp("t").alias("u")).orderBy("k").collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    day = dt.datetime(2017, 1, 1)
    five = dt.timedelta(minutes=5)
    assert got == [day + five, day + five, day + five + dt.timedelta(hours=5), day + five - dt.timedelta(hours=5, minutes=30), day + five, day, day + five, None, None]
