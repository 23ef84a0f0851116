"""Step runner over raw folders (E1): each step reads raw files or earlier
tables and writes one Parquet table; steps talk only through those tables.

Folder layout (relative to ``raw_dir``):
  travel_times_bluetooth/travel-time-YYYY.zip, bluetooth-routes-wgs84.zip
  weather_toronto_city/hourly_YYYY_MM.csv
  festivals_events/*.xml
  traffic_collisions/*.csv
and a civic calendar file (YAML / JSON lines / CSV / Parquet).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from citymotion.sources.sinks import write_qa, write_table

STEPS = ("travel_times", "weather", "civic", "events", "routes", "collisions", "panel", "panel_v1")


@dataclass
class PipelineConfig:
    raw_dir: str
    interim_dir: str
    processed_dir: str
    calendar_path: str | None = None
    years: Sequence[int] | None = None
    collision_years: Sequence[int] | None = (2014, 2015, 2016, 2017)
    max_distance_m: float = 150.0
    festivals_glob: str = "*.xml"
    collisions_glob: str = "*.csv"
    extra: dict = field(default_factory=dict)


def run_step(spark: SparkSession, step: str, cfg: PipelineConfig) -> str | list[str]:
    from citymotion.operators import ingest

    raw, interim, processed = cfg.raw_dir.rstrip("/"), cfg.interim_dir.rstrip("/"), cfg.processed_dir.rstrip("/")
    if step == "all":
        return [run_step(spark, s, cfg) for s in STEPS]
    if step == "travel_times":
        df = ingest.normalize_travel_times(spark, f"{raw}/travel_times_bluetooth", years=cfg.years)
        return write_table(df, f"{interim}/travel_times", partition_by=["year"])
    if step == "weather":
        weather = ingest.normalize_weather(spark, f"{raw}/weather_toronto_city")
        return write_table(weather, f"{interim}/weather_hourly", sort_within=["ts_utc"])  # O1: time order inside each file
    if step == "civic":
        from citymotion.operators.calendar import civic_days
        from citymotion.sources.text_formats import load_calendar

        entries, header = load_calendar(spark, cfg.calendar_path)
        start = end = None
        if header.get("start_year"):
            from datetime import date

            start, end = date(int(header["start_year"]), 1, 1), date(int(header["end_year"]), 12, 31)
        return write_table(civic_days(entries, start_date=start, end_date=end), f"{interim}/civic_days")
    if step == "events":
        from citymotion.sources.text_formats import read_festival_entries

        entries = read_festival_entries(spark, f"{raw}/festivals_events/{cfg.festivals_glob}")
        return write_table(ingest.normalize_festivals(entries), f"{interim}/events")
    if step == "routes":
        return write_table(ingest.normalize_routes(spark, f"{raw}/travel_times_bluetooth"), f"{interim}/routes")
    if step == "collisions":
        from citymotion.operators.spatial import nearest_routes, snap_qa
        from citymotion.sources.dbase import read_route_vertices
        from citymotion.sources.text_formats import read_collisions_csv

        parsed = ingest.parse_collisions(
            read_collisions_csv(spark, f"{raw}/traffic_collisions/{cfg.collisions_glob}"), years=cfg.collision_years
        )
        verts = read_route_vertices(spark, f"{raw}/travel_times_bluetooth", "bluetooth-routes*.zip")
        snapped = nearest_routes(parsed, verts, max_distance_m=cfg.max_distance_m)
        path = write_table(snapped.where(F.col("route_id").isNotNull()), f"{interim}/collisions")
        write_qa(snap_qa(snapped, cfg.max_distance_m), f"{interim}/collisions_qa")
        return path
    if step == "panel":
        from citymotion.operators.panel import build_panel, panel_qa
        from citymotion.session import path_exists

        read = spark.read.parquet
        coll = read(f"{interim}/collisions") if path_exists(spark, f"{interim}/collisions") else None
        panel = build_panel(
            read(f"{interim}/travel_times"), read(f"{interim}/routes"), read(f"{interim}/weather_hourly"),
            read(f"{interim}/civic_days"), read(f"{interim}/events"), coll, years=cfg.years,
        )
        path = write_table(panel, f"{processed}/route_time_panel", partition_by=["year"], sort_within=["route_id", "ts_utc"])
        write_qa(panel_qa(spark.read.parquet(path)), f"{processed}/route_time_panel_qa")
        return path
    if step == "panel_v1":
        from citymotion.operators.clean import clean_panel_v1, v1_qa

        panel = spark.read.parquet(f"{processed}/route_time_panel")
        path = write_table(clean_panel_v1(panel), f"{processed}/route_time_panel_v1", partition_by=["year"])
        write_qa(v1_qa(panel), f"{processed}/route_time_panel_v1_qa")
        return path
    raise ValueError(f"unknown step {step!r}; choose from {STEPS + ('all',)}")
