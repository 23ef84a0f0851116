"""How the driver's generic tables stand in for the mobility inputs.

The driver ships TPC-H-like tables plus an ``events`` stream.  Each function
derives one normalised mobility table from them with ordinary DataFrame code,
so every query's work grows with the given tables.  The same mapping is
written in SQL in :mod:`citymotion.plans.oracle` for the DuckDB check.

* observations (5-min travel times): ``events`` rows whose type is not
  ``error``; ``value`` is the travel time, ``$.k`` of ``props`` the sample
  count, ``ts`` the UTC instant, the user id is split into a corridor id.
* incidents (collisions already matched to a corridor): ``events`` rows of type ``error``.
* hourly weather: ``events`` rows of type ``signup``, last reading per UTC hour.
* corridors: ``customer`` rows with a non-negative balance (the others give
  observations without a corridor, as in real feeds).
* civic calendar and festivals: ``orders`` (optionally with their line
  items), moved from the 1995.. order timeline onto the 2024.. event timeline.
* corridor polylines: each customer's orders in key order; spatial points: customers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citymotion.functions.timez import floor_hour, utc_to_local

# fixed values: adapter constants (mirrored in the oracle SQL).  Divisors are chosen so
# derived values are not short terminating decimals: means of such values would often sit
# exactly on a rounding tie, where engines may round differently.
ROUTE_FANOUT = 10  # corridor id = N{key % 10}_N{key div 10}
CALENDAR_SHIFT_MONTHS = 348  # 29 years: order dates -> event timeline
ORIGIN_DATE = "1995-01-01"
LON_WEST, LON_SPAN = -79.60, 0.35
LAT_SOUTH, LAT_BAND = 43.58, 0.008
VERTEX_DLON, VERTEX_DLAT = 0.01, 0.004
POINT_DLAT = 0.003


_READS: dict[tuple[int, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Driver table scan; the DataFrame (and so its schema lookup) is reused within a session."""
    key = (id(spark), f"{sf_dir}/{name}.parquet")
    df = _READS.get(key)
    if df is None or df.sparkSession is not spark:
        df = spark.read.parquet(key[1])
        _READS[key] = df
    return df


def corridor_id(key: str) -> F.Column:
    k = F.col(key)
    return F.concat(
        F.lit("N"), (k % ROUTE_FANOUT).cast("string"), F.lit("_N"), F.floor(k / ROUTE_FANOUT).cast("long").cast("string")
    )


def _k(props: str = "props") -> F.Column:
    return F.get_json_object(F.col(props), "$.k").try_cast("double")


def travel_text_rows(events: DataFrame) -> DataFrame:
    """Travel-time rows as the archives hold them: text columns and provenance."""
    return events.where(F.col("event_type") != "error").select(
        corridor_id("user_id").alias("resultId"),
        F.col("value").cast("string").alias("timeInSeconds"),
        F.get_json_object("props", "$.k").alias("count"),
        F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("Z")).alias("updated"),
        F.lit("travel-time.zip").alias("path"),
        F.lit("events").alias("member"),
        F.col("event_id").alias("pos"),
    )


def observations(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """Observations by the package's own normaliser (P2, P3) from text rows of ``events``
    (a stream, if given)."""
    from citymotion.operators.ingest import normalize_travel_rows

    rows = normalize_travel_rows(travel_text_rows(events if events is not None else table(spark, sf_dir, "events")))
    cols = ["route_id", "travel_time_s", "sample_count", "ts_utc", "ts_local"]
    return rows.select(*cols, F.col("pos").alias("src_pos"), "year")


def incidents(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    e = (events if events is not None else table(spark, sf_dir, "events")).where(F.col("event_type") == "error")
    return e.select(
        F.col("event_id").alias("collision_id"),
        corridor_id("user_id").alias("route_id"),
        F.col("ts").alias("ts_utc"),
        utc_to_local("ts").alias("ts_local"),
        (_k() > 50).alias("is_injury"),
        F.when(_k() > 90, F.lit(1)).otherwise(F.lit(0)).cast("long").alias("fatalities"),
        F.col("value").alias("dist_to_route_m"),
    )


def weather_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw readings (several per hour) before the keep-last dedup."""
    e = table(spark, sf_dir, "events").where(F.col("event_type") == "signup")
    k = _k()
    return e.select(
        floor_hour("ts").alias("ts_utc"),
        F.col("ts").alias("read_at"),
        F.col("event_id").alias("src_pos"),
        (F.col("value") / 10.0 - 15.0).alias("temp_c"),
        k.alias("rel_hum_pct"),
        F.when(k < 10, F.lit(None)).otherwise((k - 10) / 20.0).alias("precip_mm"),
        (F.col("value") / 20.0).alias("wind_spd_kmh"),
        F.when(k >= 60, F.lit("Rain")).otherwise(F.lit("Clear")).alias("weather_desc"),
    )


WEATHER_MEASURES = ["temp_c", "rel_hum_pct", "precip_mm", "wind_spd_kmh", "weather_desc"]


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly weather: last reading per UTC hour (W1 keep-last), one row per hour."""
    from citymotion.operators.normalize import keep_last

    r = weather_readings(spark, sf_dir)
    last = keep_last(r, ["ts_utc"], ["read_at", "src_pos"], WEATHER_MEASURES)
    return last.select("ts_utc", utc_to_local("ts_utc").alias("ts_local"), *WEATHER_MEASURES)


def corridors(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").where(F.col("c_acctbal") >= 0)
    return c.select(
        corridor_id("c_custkey").alias("route_id"),
        (F.col("c_acctbal") / 99.0).alias("free_flow_s"),
        (F.lit(100.0) + F.col("c_nationkey") * 25.0).alias("length_m"),
    )


def _shifted(d: F.Column) -> F.Column:
    return F.add_months(F.to_date(d), CALENDAR_SHIFT_MONTHS)


CALENDAR_KIND = (
    "CASE o_orderpriority WHEN '1-URGENT' THEN 'public_holiday' WHEN '2-HIGH' THEN 'civic_holiday' "
    "WHEN '3-MEDIUM' THEN 'mega_event' WHEN '4-NOT SPECIFIED' THEN 'parade' "
    "ELSE CASE WHEN o_orderstatus = 'F' THEN 'shopping_peak' ELSE 'school_break' END END"
)


def calendar_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One calendar entry per (priority, status, order date): the day's orders of
    that kind form one civic event lasting ``floor(max price / 100000)`` extra
    days.  Every order is read; the calendar's density stays bounded by the
    15 kinds per day, like a real civic calendar."""
    o = table(spark, sf_dir, "orders").withColumn("_start", _shifted(F.col("o_orderdate")))
    g = o.groupBy("o_orderpriority", "o_orderstatus", "_start").agg(F.max("o_totalprice").alias("_top"))
    day = F.date_format("_start", "yyyyMMdd")
    status_code = F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 2).otherwise(3)
    return g.select(
        F.concat(F.lit("cal-"), F.substring("o_orderpriority", 1, 1), F.col("o_orderstatus"), F.lit("-"), day).alias("id"),
        F.concat(F.col("o_orderpriority"), F.lit("/"), F.col("o_orderstatus"), F.lit(" "), F.date_format("_start", "yyyy-MM-dd")).alias("name"),
        F.expr(CALENDAR_KIND).alias("kind"),
        F.col("_start").alias("start_date"),
        F.date_add("_start", F.floor(F.col("_top") / 100000.0).cast("int")).alias("end_date"),
        (day.cast("long") * 100 + F.substring("o_orderpriority", 1, 1).cast("long") * 10 + status_code).alias("pos"),
    )


# Days that an order's entry lasts: most a week or so, one of 61 over a year, one of 997 over 50 years.
ORDER_DAYS = "CASE WHEN o_orderkey % 997 = 0 THEN 18300 WHEN o_orderkey % 61 = 0 THEN 400 ELSE o_orderkey % 9 END"


def order_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One calendar entry per order, unfolded: the calendar is as large as the table and a
    day's entries grow with it; some entries last years, and their order is not that of the
    dates."""
    o = table(spark, sf_dir, "orders").withColumn("_start", _shifted(F.col("o_orderdate")))
    return o.select(
        F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("id"),
        F.concat(F.substring("o_orderpriority", 1, 1), F.lit("-"), (F.col("o_orderkey") % 1000).cast("string")).alias("name"),
        F.expr(CALENDAR_KIND).alias("kind"),
        F.col("_start").alias("start_date"),
        F.date_add("_start", F.expr(ORDER_DAYS).cast("int")).alias("end_date"),
        (F.col("o_orderkey") * 7919 % 1000003 * 10000000 + F.col("o_orderkey")).alias("pos"),
    )


def festival_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Festival-like intervals: an order runs from its date to its last ship date."""
    o = table(spark, sf_dir, "orders")
    last_ship = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.max("l_shipdate").alias("last_ship"))
    )
    j = o.join(last_ship, o.o_orderkey == last_ship.l_orderkey, "left")
    start = F.to_timestamp_ntz(F.date_format(_shifted(F.col("o_orderdate")), "yyyy-MM-dd"))
    end = F.to_timestamp_ntz(F.date_format(_shifted(F.col("last_ship")), "yyyy-MM-dd"))
    located = F.col("o_orderstatus") != "P"
    return j.select(
        F.concat(F.lit("ord-"), F.col("o_orderkey").cast("string")).alias("event_id"),
        F.col("o_orderpriority").alias("name"),
        start.alias("start_local"),
        F.coalesce(end, start).alias("end_local"),
        F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").alias("road_close"),
        F.when(located, F.lit(43.65)).alias("lat"),
        F.when(located, F.lit(-79.38)).alias("lon"),
    )


def route_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corridor polylines: ``route_id, seq, lon, lat`` (WGS84), seq dense from 0."""
    from pyspark.sql import Window

    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    j = o.join(c, o.o_custkey == c.c_custkey, "inner")
    anchor_lon = F.lit(LON_WEST) + F.lit(LON_SPAN) * (F.col("c_acctbal") + 1000.0) / 10999.0
    anchor_lat = F.lit(LAT_SOUTH) + F.lit(LAT_BAND) * F.col("c_nationkey")
    days = F.datediff(F.to_date("o_orderdate"), F.lit(ORIGIN_DATE))
    w = Window.partitionBy("c_custkey").orderBy("o_orderkey")
    return j.select(
        corridor_id("c_custkey").alias("route_id"),
        (F.row_number().over(w) - 1).cast("long").alias("seq"),
        (anchor_lon + F.lit(VERTEX_DLON) * (F.col("o_totalprice") / 599999.0 - 0.5)).alias("lon"),
        (anchor_lat + F.lit(VERTEX_DLAT) * (days / 2399.0 - 0.5)).alias("lat"),
    )


def snap_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("collision_id"),
        (F.lit(LON_WEST) + F.lit(LON_SPAN) * (F.col("c_acctbal") + 1000.0) / 10999.0).alias("lon"),
        (F.lit(LAT_SOUTH) + F.lit(LAT_BAND) * F.col("c_nationkey") + F.lit(POINT_DLAT)).alias("lat"),
    )
