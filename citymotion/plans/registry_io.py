"""Registered queries of the raw-format sources, sinks, period filter, route aggregates and
streams.  Given tables are written out in a raw format below the shared folder and
read back by the package's sources; the SQL works on the tables directly."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from citymotion.plans import adapters as A
from citymotion.plans import oracle as O
from citymotion.plans.registry import CLEAN_COLUMNS, PANEL_COLUMNS, ROUND6, _collision_rows, _metric_query, _metric_sql, cleaned, panel, register
from citymotion.session import ensure_checkpoint_dir


def scratch(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


# ---------------------------------------------------------------- travel-time rows
@register(
    "travel_rows_parse",
    f"""WITH r AS (SELECT *, {O.to_local_sql("date_trunc('second', ts)")} AS loc FROM events WHERE event_type <> 'error')
SELECT event_id AS pos, {O.corridor_sql('user_id')} AS route_id, value AS travel_time_s, {O.K} AS sample_count,
       date_trunc('second', ts) AS ts_utc, loc AS ts_local,
       CAST(CASE WHEN event_id % 3 = 0 THEN 2016 ELSE year(loc) END AS INTEGER) AS year
FROM r WHERE event_id % 7 <> 0 AND event_id % 11 <> 0 AND value > 0 AND user_id IS NOT NULL""",
)
def q_travel_rows_parse(spark, sf):
    """Text with missing marks, negative times, offsets and times without one."""
    from citymotion.operators.ingest import normalize_travel_rows

    rows, i = A.travel_text_rows(A.table(spark, sf, "events")), F.col("pos")
    ts = F.to_timestamp_ntz(F.substring("updated", 1, 19))
    offset = F.concat(F.date_format(ts - F.expr("INTERVAL 5 HOURS"), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("-05"))
    rows = rows.withColumns({
        "timeInSeconds": F.when(i % 7 == 0, F.lit("N/A")).when(i % 11 == 0, F.lit("-3.5")).otherwise(F.col("timeInSeconds")),
        "updated": F.when(i % 2 == 0, offset).otherwise(F.substring("updated", 1, 19)),
        "path": F.when(i % 3 == 0, F.lit("/raw/travel-time-2016.zip")).otherwise(F.col("path")),
    })
    return normalize_travel_rows(rows).select("pos", "route_id", "travel_time_s", "sample_count", "ts_utc", "ts_local", "year")


# ---------------------------------------------------------------- CSV, XML and JSON round trips
@register(
    "weather_csv_roundtrip",
    f"""SELECT ts AS ts_utc, {O.to_local_sql('ts')} AS ts_local, value / 10.0 - 15.0 AS temp_c, {O.K} AS rel_hum_pct,
       CASE WHEN event_id % 2 = 0 THEN value / 20.0 END AS wind_spd_kmh, CASE WHEN {O.K} >= 60 THEN 'Rain' ELSE 'Clear, "dry"' END AS weather_desc
FROM events WHERE event_type = 'signup'""",
)
def q_weather_csv_roundtrip(spark, sf):
    """Two kinds of monthly files whose headers differ in order and columns."""
    from citymotion.operators.ingest import normalize_weather_rows
    from citymotion.sources.text_formats import read_weather_csv

    e = A.table(spark, sf, "events").where(F.col("event_type") == "signup")
    k = A._k()
    text = e.select(
        "event_id",
        F.date_format(A.utc_to_local("ts"), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("Date/Time (LST)"),
        (F.col("value") / 10.0 - 15.0).cast("string").alias("Temp (°C)"),
        k.cast("string").alias("Rel Hum (%)"),
        (F.col("value") / 20.0).cast("string").alias("Wind Spd (km/h)"),
        F.when(k >= 60, F.lit("Rain")).otherwise(F.lit('Clear, "dry"')).alias("Weather"),
    )
    path = scratch(spark, "weather-csv")
    names = ["Date/Time (LST)", "Temp (°C)", "Rel Hum (%)", "Wind Spd (km/h)", "Weather"]
    for part, cols in (("even", names), ("odd", [names[4], names[2], names[0], names[1]])):
        rows = text.where(F.col("event_id") % 2 == (0 if part == "even" else 1))
        rows.select(*cols).write.option("header", "true").option("quote", '"').option("escape", '"').csv(f"{path}/{part}")
    raw = read_weather_csv(spark, [f"{path}/even", f"{path}/odd"])
    return normalize_weather_rows(raw, dedupe=False).select("ts_utc", "ts_local", "temp_c", "rel_hum_pct", "wind_spd_kmh", "weather_desc")


@register(
    "collisions_csv_roundtrip",
    """SELECT o_orderkey AS collision_id, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(length(o_orderpriority) AS INTEGER) AS hour,
       'Old "Mill", ' || chr(10) || o_orderpriority AS neighbourhood,
       CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false ELSE NULL END AS is_injury,
       CAST(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS BIGINT) AS fatalities,
       43.0 + (o_orderkey % 100) / 128.0 AS lat, -79.0 - (o_orderkey % 50) / 64.0 AS lon
FROM orders WHERE year(o_orderdate) IN (1994, 1995, 1996) AND o_orderstatus <> 'P'""",
)
def q_collisions_csv_roundtrip(spark, sf):
    """Quoted line breaks and quotes, years to keep, an unknown flag text, unlocated rows."""
    from citymotion.operators.ingest import parse_collisions
    from citymotion.sources.text_formats import read_collisions_csv

    key = F.col("_id").cast("long")
    located = F.col("LAT_WGS84") != "0"
    rows = _collision_rows(spark, sf).join(A.table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("_id"), "o_orderpriority"), "_id")
    rows = rows.withColumns({
        "NEIGHBOURHOOD_158": F.concat(F.lit('Old "Mill", \n'), F.col("o_orderpriority")),
        "INJURY_COLLISIONS": F.when(F.col("INJURY_COLLISIONS") == "Y", F.lit("perhaps")).otherwise(F.col("INJURY_COLLISIONS")),
        "LAT_WGS84": F.when(located, (43.0 + (key % 100) / 128.0).cast("string")).otherwise(F.col("LAT_WGS84")),
        "LONG_WGS84": F.when(located, (-79.0 - (key % 50) / 64.0).cast("string")).otherwise(F.col("LONG_WGS84")),
    }).drop("o_orderpriority")
    path = scratch(spark, "collisions-csv")
    rows.write.option("header", "true").option("quoteAll", "true").option("escape", '"').csv(path)
    p = parse_collisions(read_collisions_csv(spark, path), years=[1994, 1995, 1996])
    return p.select("collision_id", "year", "hour", "neighbourhood", "is_injury", "fatalities", "lat", "lon")


@register(
    "festivals_xml_roundtrip",
    """SELECT 'f-' || o_orderkey AS event_id, 'Fair & ' || o_orderpriority AS name, 'Music | Food' AS category,
       CAST(43.0 + (o_orderkey % 100) / 128.0 AS DOUBLE) AS lat,
       CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + CASE o_orderstatus WHEN 'F' THEN INTERVAL 570 MINUTE WHEN 'O' THEN INTERVAL 720 MINUTE ELSE INTERVAL 0 MINUTE END AS start_local,
       CASE WHEN o_orderkey % 2 = 0 THEN CAST(CAST(o_orderdate AS DATE) + 2 AS TIMESTAMP)
            ELSE CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + CASE o_orderstatus WHEN 'F' THEN INTERVAL 570 MINUTE WHEN 'O' THEN INTERVAL 720 MINUTE ELSE INTERVAL 0 MINUTE END END AS end_local,
       o_orderstatus = 'F' AS road_close
FROM orders""",
)
def q_festivals_xml_roundtrip(spark, sf):
    from citymotion.operators.ingest import normalize_festivals
    from citymotion.sources.text_formats import read_festival_entries

    # the rows are dealt to all tasks before their text is written, since the table may be a single row group
    used = ["o_orderkey", "o_orderdate", "o_orderpriority", "o_orderstatus"]
    o = A.table(spark, sf, "orders").select(*used).repartition(*used)
    d = F.to_date("o_orderdate")

    def entry(name, *texts):
        return F.concat(F.lit(f'<entrydata name="{name}">'), *[F.concat(F.lit("<text>"), t, F.lit("</text>")) for t in texts], F.lit("</entrydata>"))

    status = F.col("o_orderstatus")
    xml = F.concat(
        F.lit('<viewentry unid="f-'), F.col("o_orderkey").cast("string"), F.lit('">'),
        entry("EventName", F.concat(F.lit(" Fair &amp; "), F.col("o_orderpriority"))), entry("CategoryList", F.lit("Music"), F.lit(" Food ")),
        entry("txtLat", F.concat((43.0 + (F.col("o_orderkey") % 100) / 128.0).cast("string"), F.lit(" N"))),
        entry("DateBeginShow", F.date_format(d, "MMM d, yyyy")),
        entry("TimeBegin", F.when(status == "F", F.lit("9:30 AM")).when(status == "O", F.lit("12:00 PM")).otherwise(F.lit(""))),
        F.when(F.col("o_orderkey") % 2 == 0, entry("DateEndShow", F.date_format(F.date_add(d, 2), "MMM d, yyyy"))).otherwise(F.lit("")),
        entry("RoadClose", F.when(status == "F", F.lit("Main St")).otherwise(F.lit("None"))), F.lit("</viewentry>"),
    )
    path = scratch(spark, "festivals-xml")
    o.select(xml.alias("value")).write.text(path)
    return normalize_festivals(read_festival_entries(spark, path)).select("event_id", "name", "category", "lat", "start_local", "end_local", "road_close")


@register("calendar_json_roundtrip", O.with_ctes([O.CAL, O.CIVIC], "SELECT * FROM civic"))
def q_calendar_json_roundtrip(spark, sf):
    from citymotion.operators.calendar import civic_days
    from citymotion.sources.text_formats import load_calendar

    path = scratch(spark, "calendar-json")
    A.calendar_entries(spark, sf).write.json(path)
    return civic_days(load_calendar(spark, path)[0])


# ---------------------------------------------------------------- sinks (K1, K2, O2)
def _rounded(columns):
    return ", ".join(f"round({c}, 6) AS {c}" if c in ROUND6 else c for c in columns)


def placed_rows(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a written Parquet folder with ``place``, their place in its files in name order.
    The files' offsets are a table of one row per file, joined on the name."""
    files = spark.read.parquet(path).select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    sizes = files.groupBy("_file").agg((F.max("_row") + 1).alias("_n"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return files.join(starts, "_file").withColumn("place", (F.col("_start") + F.col("_row")).cast("long")).drop("_file", "_row", "_start")


@register(
    "clean_panel_sorted",
    O.with_ctes(O.PANEL_DEPS + [O.CLEAN], f"SELECT {_rounded(CLEAN_COLUMNS)}, row_number() OVER (ORDER BY ts_local, route_id) - 1 AS place FROM clean"),
)
def q_clean_panel_sorted(spark, sf):
    """Written by the sink in (ts_local, route_id) order; ``place`` is the row's place in the files."""
    from citymotion.sources.sinks import write_table

    path = write_table(cleaned(spark, sf), scratch(spark, "clean-sorted"), order_by=["ts_local", "route_id"])
    cols = [F.round(c, 6).alias(c) if c in ROUND6 else F.col(c) for c in CLEAN_COLUMNS]
    return placed_rows(spark, path).select(*cols, "place")


@register("qa_json_roundtrip", O.with_ctes(O.PANEL_DEPS, "SELECT count(*) AS n_rows, count(DISTINCT route_id) AS n_routes, CAST(min(year) AS BIGINT) AS year_min, CAST(max(year) AS BIGINT) AS year_max FROM panel"))
def q_qa_json_roundtrip(spark, sf):
    from citymotion.operators.panel import panel_qa
    from citymotion.sources.sinks import write_qa

    path = write_qa(panel_qa(panel(spark, sf)), scratch(spark, "qa-json"))
    return spark.read.json(path).select("n_rows", "n_routes", "year_min", "year_max")


# ---------------------------------------------------------------- period filter (P23, S10) and other aggregates (A3)
PERIOD = ("2024-01-05", "2024-01-11")


@register(
    "congestion_period_1h",
    O.with_ctes(
        O.PANEL_DEPS,
        f"""SELECT {O.bucket_sql('ts_utc', 60)} AS bucket_utc, {O.label_sql(O.bucket_sql('ts_utc', 60))} AS label, route_id, round(avg(delay_s), 6) AS value
FROM panel WHERE date BETWEEN DATE '{PERIOD[0]}' AND DATE '{PERIOD[1]}' GROUP BY ALL""",
    ),
)
def q_congestion_period(spark, sf):
    from citymotion.operators.frames import congestion_buckets

    b = congestion_buckets(panel(spark, sf), start=PERIOD[0], end=PERIOD[1], freq="h", metric="delay_s")
    return b.withColumn("value", F.round("value", 6))


for _agg, _expr in (
    ("min", "min(delay_s)"), ("max", "max(delay_s)"), ("sum", "coalesce(sum(delay_s), 0)"), ("std", "stddev_samp(delay_s)"), ("var", "var_samp(delay_s)"),
    ("count", "CAST(count(delay_s) AS DOUBLE)"), ("nunique", "CAST(count(DISTINCT delay_s) AS DOUBLE)"),
    ("first", "arg_min(delay_s, src_pos) FILTER (WHERE delay_s IS NOT NULL)"), ("last", "arg_max(delay_s, src_pos) FILTER (WHERE delay_s IS NOT NULL)"),
):
    register(f"route_metrics_{_agg}", _metric_sql(_expr))(_metric_query(_agg))


# ---------------------------------------------------------------- streams
def event_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The events table as a stream of files; the rows of a batch are dealt to all tasks before
    their text is parsed, since a batch may be a single file."""
    return spark.readStream.schema(A.table(spark, sf, "events").schema).parquet(f"{sf}/events.parquet*").repartition("event_id")


def drained(stream: DataFrame, name: str) -> DataFrame:
    """What the stream has written once its input is read to the end."""
    from citymotion.streaming.streams import start

    spark = stream.sparkSession
    path = scratch(spark, name)
    start(stream, path.rsplit("/", 1)[1], path, available_now=True).awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


STREAM_PANEL = [c for c in PANEL_COLUMNS if c not in ("ts_hour", "n_collisions", "n_injury_collisions", "n_fatal_collisions", "min_dist_to_route_m")]
WATERMARK = "(SELECT date_trunc('millisecond', max(ts_utc)) - INTERVAL 2 HOUR FROM {0})"


@register("stream_enriched", O.with_ctes(O.PANEL_DEPS, f"SELECT {', '.join(STREAM_PANEL)} FROM panel"))
def q_stream_enriched(spark, sf):
    from citymotion.operators.calendar import civic_days
    from citymotion.operators.summaries import event_day_summary
    from citymotion.streaming.streams import enrich_stream

    s = A.observations(spark, sf, event_stream(spark, sf))
    sides = A.corridors(spark, sf), A.weather(spark, sf), civic_days(A.calendar_entries(spark, sf)), event_day_summary(A.festival_events(spark, sf))
    return drained(enrich_stream(s, *sides).select(*STREAM_PANEL), "stream-enriched")


@register(
    "stream_collision_hours",
    O.with_ctes([O.INC, O.INCSUM], f"SELECT * FROM incsum WHERE ts_hour_utc + INTERVAL 1 HOUR <= {WATERMARK.format('inc')}"),
)
def q_stream_collision_hours(spark, sf):
    from citymotion.streaming.streams import collision_hours_stream

    return drained(collision_hours_stream(A.incidents(spark, sf, event_stream(spark, sf))), "stream-collisions")


@register(
    "stream_bucket_means",
    O.with_ctes(
        [O.OBS],
        f"""SELECT date_trunc('hour', ts_utc) AS bucket_utc, {O.label_sql("date_trunc('hour', ts_utc)")} AS label, route_id, round(avg(travel_time_s), 6) AS value
FROM obs WHERE date_trunc('hour', ts_utc) + INTERVAL 1 HOUR <= {WATERMARK.format('obs')} GROUP BY ALL""",
    ),
)
def q_stream_bucket_means(spark, sf):
    from citymotion.streaming.streams import bucket_mean_stream

    s = bucket_mean_stream(A.observations(spark, sf, event_stream(spark, sf)), 60, "travel_time_s")
    return drained(s, "stream-buckets").withColumn("value", F.round("value", 6))


@register(
    "stream_trailing_hour",
    O.with_ctes(
        [O.OBS],
        f"""SELECT route_id, {O.bucket_sql('ts_utc', 5)} + to_minutes(CAST(5 * (k + 1) AS BIGINT)) AS window_end_utc, count(*) AS n_obs, round(avg(travel_time_s), 6) AS mean_value
FROM obs, range(0, 12) t(k) WHERE {O.bucket_sql('ts_utc', 5)} + to_minutes(CAST(5 * (k + 1) AS BIGINT)) <= {WATERMARK.format('obs')} GROUP BY ALL""",
    ),
)
def q_stream_trailing_hour(spark, sf):
    from citymotion.streaming.streams import trailing_hour_stream

    s = trailing_hour_stream(A.observations(spark, sf, event_stream(spark, sf)))
    return drained(s, "stream-trailing").withColumn("mean_value", F.round("mean_value", 6))


@register("stream_first_keys", O.with_ctes([O.OBS], "SELECT DISTINCT route_id, ts_utc FROM obs"))
def q_stream_first_keys(spark, sf):
    from citymotion.streaming.streams import dedupe_first_stream

    return drained(dedupe_first_stream(A.observations(spark, sf, event_stream(spark, sf))).select("route_id", "ts_utc"), "stream-first")


@register(
    "stream_last_rows",
    O.with_ctes(
        [O.OBS],
        f"""SELECT route_id, ts_utc, max(src_pos) AS src_pos, arg_max(travel_time_s, src_pos) AS travel_time_s
FROM obs WHERE ts_utc <= {WATERMARK.format('obs')} GROUP BY ALL""",
    ),
)
def q_stream_last_rows(spark, sf):
    from citymotion.streaming.streams import dedupe_last_stream

    return drained(dedupe_last_stream(A.observations(spark, sf, event_stream(spark, sf))), "stream-last")
