"""Raw inputs -> tidy tables.

Each function takes source DataFrames (see :mod:`citymotion.sources`) and
returns the normalised table; ``citymotion.plans.pipeline`` wires files to
functions and writes Parquet.  All coercions are lenient (bad text -> NULL).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citymotion.functions.text import event_datetime, first_number, road_closed, yes_no
from citymotion.functions.timez import (
    epoch_ms_to_utc_ntz,
    localize,
    parse_naive_local,
    parse_offset_timestamp,
    utc_to_local,
)
from citymotion.operators.normalize import keep_last, na_to_null, to_double
from citymotion.sources.archives import read_zip_csv, year_from_name
from citymotion.sources.common import list_files

# ------------------------------------------------------------------ travel times
TRAVEL_COLUMNS = ("resultId", "timeInSeconds", "count", "updated")


def travel_time_archives(spark: SparkSession, folder: str, years: Sequence[int] | None = None) -> DataFrame:
    """``travel-time-*.zip`` archives (S1) with their name year; the year filter
    prunes archives before any is opened.  Errors when nothing is left."""
    files = list_files(spark, folder, "travel-time-*.zip").withColumn("name_year", year_from_name("path"))
    if years is not None:
        files = files.where(F.col("name_year").isin(list(years)))
    if files.limit(1).count() == 0:
        raise FileNotFoundError(f"{folder} holds no travel-time archive (of the years asked for)")
    return files


def normalize_travel_rows(raw: DataFrame) -> DataFrame:
    """Travel projection (P2), year (P1/Q7) and row filter (P3) on string rows."""
    ts_utc = parse_offset_timestamp(na_to_null("updated"))
    out = raw.select(
        na_to_null("resultId").alias("route_id"),
        to_double("timeInSeconds").alias("travel_time_s"),
        to_double("count").alias("sample_count"),
        ts_utc.alias("ts_utc"),
        "path",
        "member",
        "pos",
    ).withColumn("ts_local", utc_to_local("ts_utc"))
    out = out.withColumn("year", F.coalesce(year_from_name("path"), F.year("ts_local")))
    return out.where(
        F.col("route_id").isNotNull() & F.col("ts_utc").isNotNull() & F.col("travel_time_s").isNotNull() & (F.col("travel_time_s") > 0)
    )


def normalize_travel_times(spark: SparkSession, folder: str, *, years: Sequence[int] | None = None) -> DataFrame:
    """All (or some) yearly archives -> travel_times."""
    files = travel_time_archives(spark, folder, years)
    raw = read_zip_csv(spark, folder, "travel-time-*.zip", TRAVEL_COLUMNS, paths=files.select("path"))
    return normalize_travel_rows(raw)


# ------------------------------------------------------------------ weather
# fixed values: raw weather header -> tidy name, in output order
WEATHER_COLUMN_MAP = {
    "Date/Time (LST)": "ts_local",
    "Temp (°C)": "temp_c",
    "Dew Point Temp (°C)": "dew_point_c",
    "Rel Hum (%)": "rel_hum_pct",
    "Precip. Amount (mm)": "precip_mm",
    "Wind Dir (10s deg)": "wind_dir_10s",
    "Wind Spd (km/h)": "wind_spd_kmh",
    "Visibility (km)": "visibility_km",
    "Stn Press (kPa)": "stn_press_kpa",
    "Hmdx": "humidex",
    "Wind Chill": "wind_chill",
    "Weather": "weather_desc",
}


def normalize_weather_rows(raw: DataFrame, *, dedupe: bool = True) -> DataFrame:
    """Rename known headers (P5), coerce numbers (P6), localise wall time (F1), keep last per instant.

    Absent columns are tolerated.  Unparsable times are dropped before
    localisation; ambiguous autumn times become NULL *after* it and collapse to
    one row in the dedup (as in the source).  Keep-last order: raw wall time,
    file path, row position.
    """
    present = [(src, dst) for src, dst in WEATHER_COLUMN_MAP.items() if src in raw.columns]
    sel = [F.col(f"`{src}`").alias(dst) for src, dst in present]
    df = raw.select(*sel, "path", "pos")
    df = df.withColumn("_wall", parse_naive_local(na_to_null("ts_local"))).where(F.col("_wall").isNotNull())
    measures = [dst for _, dst in present if dst not in ("ts_local", "weather_desc")]
    df = df.withColumns({m: to_double(m) for m in measures})
    if "weather_desc" in df.columns:
        df = df.withColumn("weather_desc", na_to_null("weather_desc"))
    df = df.withColumn("ts_utc", localize("_wall")).withColumn("ts_local", utc_to_local("ts_utc"))
    keep = [dst for _, dst in present if dst != "ts_local"]
    if dedupe:
        df = keep_last(df, ["ts_utc"], ["_wall", "path", "pos"], ["ts_local", *keep])
    return df.select("ts_utc", "ts_local", *keep)


def normalize_weather(spark: SparkSession, folder: str) -> DataFrame:
    from citymotion.sources.text_formats import read_weather_csv

    files = list_files(spark, folder, "hourly_*.csv")
    paths = [r.path for r in files.select("path").orderBy("path").collect()]  # the file list only
    if not paths:
        raise FileNotFoundError(f"{folder} holds no hourly weather file")
    return normalize_weather_rows(read_weather_csv(spark, paths))


# ------------------------------------------------------------------ collisions
# fixed values: yes/no columns of the collisions CSV and their tidy names
COLLISION_FLAGS = {
    "INJURY_COLLISIONS": "is_injury",
    "FTR_COLLISIONS": "is_ftr",
    "PD_COLLISIONS": "is_pd",
    "AUTOMOBILE": "involves_automobile",
    "MOTORCYCLE": "involves_motorcycle",
    "PASSENGER": "involves_passenger",
    "BICYCLE": "involves_bicycle",
    "PEDESTRIAN": "involves_pedestrian",
}
COLLISION_TEXT = {"OCC_MONTH": "month", "OCC_DOW": "dow", "DIVISION": "division", "HOOD_158": "hood_id", "NEIGHBOURHOOD_158": "neighbourhood"}
COLLISION_REQUIRED = ("OCC_YEAR", "OCC_DATE", "OCC_HOUR", "LAT_WGS84", "LONG_WGS84")
EPOCH_MS_MEDIAN_CUTOFF = 1e11
DEFAULT_YEARS = (2014, 2015, 2016, 2017)


def occ_dates_are_epoch_ms(raw: DataFrame, col: str = "OCC_DATE", cutoff: float = EPOCH_MS_MEDIAN_CUTOFF) -> bool:
    """Column-level decision (P10): is the median of the numeric values above ``cutoff``?

    Decided exactly from one aggregate row, without sorting or buffering the
    column: with ``c`` values above the cut out of ``n``, the median is above it
    when ``c > n/2`` (odd n: ``c >= (n+1)/2``) and below when ``c < n/2``; in the
    even split it is the mean of the largest value at or below the cut and the
    smallest above it.
    """
    v = to_double(col)
    r = raw.agg(
        F.count(v).alias("n"),
        F.count_if(v > cutoff).alias("c"),
        F.max(F.when(v <= cutoff, v)).alias("lo"),
        F.min(F.when(v > cutoff, v)).alias("hi"),
    ).first()
    n, c = r.n, r.c
    if not n:
        return False
    if n % 2:
        return c >= (n + 1) // 2
    if c != n // 2:
        return c > n // 2
    return (r.lo + r.hi) / 2.0 > cutoff


def parse_collisions(raw: DataFrame, *, years: Sequence[int] | None = DEFAULT_YEARS, epoch_ms: bool | None = None) -> DataFrame:
    """Collisions CSV rows -> tidy occurrences.

    Occurrence instant = local midnight of the occurrence date plus OCC_HOUR
    hours of elapsed time (so a spring-forward day shifts the wall clock);
    non-epoch naive date text is read as UTC.  Coordinates at (0, 0) or
    missing make a row unlocated; unlocated rows are dropped.
    """
    missing = [c for c in COLLISION_REQUIRED if c not in raw.columns]
    if missing:
        raise KeyError(f"collisions CSV missing columns: {missing}")
    year = to_double("OCC_YEAR").cast("int")
    df = raw.withColumn("year", year)
    if years is not None:
        df = df.where(F.col("year").isin(list(years)))
    if epoch_ms is None:
        epoch_ms = occ_dates_are_epoch_ms(df)
    occ_utc = (
        epoch_ms_to_utc_ntz(to_double("OCC_DATE").cast("decimal(20,0)"))
        if epoch_ms
        else F.coalesce(parse_offset_timestamp(na_to_null("OCC_DATE")), parse_naive_local(na_to_null("OCC_DATE")))
    )
    hour = F.coalesce(to_double("OCC_HOUR"), F.lit(0.0)).cast("int")
    local_day = F.to_date(utc_to_local(occ_utc))
    midnight_utc = localize(F.to_timestamp_ntz(F.date_format(local_day, "yyyy-MM-dd")))
    ts_utc = midnight_utc + F.make_dt_interval(F.lit(0), hour)
    lat = to_double("LAT_WGS84")
    lon = to_double("LONG_WGS84")
    unlocated = lat.isNull() | lon.isNull() | ((F.abs(lat) < 1e-6) & (F.abs(lon) < 1e-6))
    if "_id" in raw.columns:
        cid = F.col("_id").try_cast("long")
    else:
        # surrogate ids 1..n in file order (a quoted CSV is one task per file), counted after the year filter
        from citymotion.sources.common import with_ordinal

        df = with_ordinal(df, "_ord", ["path"] if "path" in raw.columns else None)
        cid = (F.col("_ord") + 1).cast("long")
    cols = {
        "collision_id": cid,
        "ts_utc": ts_utc,
        "year": F.col("year"),
        "hour": hour,
        "lat": F.when(~unlocated, lat),
        "lon": F.when(~unlocated, lon),
        "fatalities": to_double("FATALITIES").cast("long") if "FATALITIES" in raw.columns else F.lit(None).cast("long"),
    }
    for src, dst in COLLISION_TEXT.items():
        cols[dst] = F.col(src).cast("string") if src in raw.columns else F.lit(None).cast("string")
    for src, dst in COLLISION_FLAGS.items():
        cols[dst] = yes_no(src) if src in raw.columns else F.lit(None).cast("boolean")
    out = df.select(*[v.alias(k) for k, v in cols.items()])
    out = out.withColumn("ts_local", utc_to_local("ts_utc")).withColumn("date", F.to_date("ts_local"))
    return out.where(F.col("lat").isNotNull() & F.col("lon").isNotNull())


# ------------------------------------------------------------------ festivals
EVENT_COLUMNS = [
    "event_id", "name", "category", "area", "location", "address", "intersection", "lat", "lon",
    "start_local", "end_local", "road_close", "admission",
]


def normalize_festivals(entries: DataFrame) -> DataFrame:
    """Festival entries -> events.

    Start/end parsed from date + optional time text; end defaults to start;
    id defaults to ``row-{index}``; road closure unless empty / none / null.
    The full schema is emitted even for an empty feed.
    """
    start = event_datetime("DateBeginShow", "TimeBegin")
    end = event_datetime("DateEndShow", "TimeEnd")
    out = entries.select(
        F.coalesce(F.col("unid"), F.concat(F.lit("row-"), F.col("ordinal").cast("string"))).alias("event_id"),
        F.col("EventName").alias("name"),
        F.col("CategoryList").alias("category"),
        F.col("Area").alias("area"),
        F.col("Location").alias("location"),
        F.col("Address").alias("address"),
        F.col("Intersection").alias("intersection"),
        first_number("txtLat").alias("lat"),
        first_number("txtLong").alias("lon"),
        start.alias("start_local"),
        end.alias("_end"),
        road_closed("RoadClose").alias("road_close"),
        F.col("Admission").alias("admission"),
    )
    out = out.withColumn("end_local", F.when(F.col("_end").isNull() & F.col("start_local").isNotNull(), F.col("start_local")).otherwise(F.col("_end")))
    return out.select(*EVENT_COLUMNS)


# ------------------------------------------------------------------ routes
ROUTE_FIELDS = {"resultId": "string", "normalDriv": "double", "length_m": "double"}


def normalize_routes(spark: SparkSession, folder: str, glob: str = "bluetooth-routes*.zip") -> DataFrame:
    """Route attributes from the shapefile DBF."""
    from citymotion.sources.dbase import read_dbf_zip

    raw = read_dbf_zip(spark, folder, glob, ROUTE_FIELDS)
    return raw.select(
        F.col("resultId").cast("string").alias("route_id"),
        F.col("normalDriv").try_cast("double").alias("free_flow_s"),
        F.col("length_m").try_cast("double").alias("length_m"),
    )
