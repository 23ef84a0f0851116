"""Structured Streaming variants of the panel operators.

Streams carry the same normalised columns as the batch tables.  Watermarks
need a TIMESTAMP (instant) column, so ``ts_utc`` (UTC wall clock, NTZ) is
turned into ``event_time`` with an explicit UTC zone — no dependence on the
session zone — and window bounds are turned back into UTC NTZ, so stream and
batch outputs compare column for column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citymotion.functions.timez import floor_hour, instant_to_utc_ntz, utc_to_local
from citymotion.operators.panel import prefix_weather
from citymotion.session import ensure_checkpoint_dir, measured_side

DEFAULT_LATENESS = "2 hours"


def event_time(ts_utc: str | Column = "ts_utc") -> Column:
    """UTC NTZ -> TIMESTAMP instant, exact and session-zone independent."""
    t = F.col(ts_utc) if isinstance(ts_utc, str) else ts_utc
    return F.make_timestamp(F.year(t), F.month(t), F.dayofmonth(t), F.hour(t), F.minute(t), F.extract(F.lit("SECOND"), t), F.lit("UTC"))


def with_event_time(stream: DataFrame, lateness: str = DEFAULT_LATENESS) -> DataFrame:
    return stream.withColumn("event_time", event_time("ts_utc")).withWatermark("event_time", lateness)


def enrich_stream(observations: DataFrame, routes: DataFrame, weather: DataFrame, civic: DataFrame, event_days: DataFrame) -> DataFrame:
    """Stream-static left joins with corridors, hourly weather, civic days, event-day counts."""
    s = observations.join(measured_side(routes, "routes"), "route_id", "left")
    s = s.withColumn("ts_hour_utc", floor_hour("ts_utc")).join(measured_side(prefix_weather(weather), "weather"), "ts_hour_utc", "left")
    s = s.withColumn("date", F.to_date("ts_local")).join(measured_side(civic.join(event_days, "date", "full"), "days"), "date", "left")
    zero = {c: F.coalesce(F.col(c), F.lit(0)).cast("long") for c in ("n_events_active", "n_events_road_close", "n_events_with_coords")}
    return s.withColumns(
        {
            **zero,
            "holiday_names": F.coalesce(F.col("holiday_names"), F.lit("")),
            "hour": F.hour("ts_local").cast("long"),
            "dow": F.weekday("ts_local").cast("long"),
            "is_weekend": F.weekday("ts_local").isin(5, 6),
            "delay_s": F.col("travel_time_s") - F.col("free_flow_s"),
        }
    )


def collision_hours_stream(collisions: DataFrame, lateness: str = DEFAULT_LATENESS) -> DataFrame:
    """Route x hour incident counts; a window is final once the watermark passes it (append mode)."""
    c = with_event_time(collisions.where(F.col("route_id").isNotNull()), lateness)
    agg = c.groupBy(F.window("event_time", "1 hour").alias("w"), "route_id").agg(
        F.count(F.lit(1)).alias("n_collisions"),
        F.count_if(F.coalesce(F.col("is_injury"), F.lit(False))).alias("n_injury_collisions"),
        F.count_if(F.coalesce(F.col("fatalities").cast("double"), F.lit(0.0)) > 0).alias("n_fatal_collisions"),
        F.min("dist_to_route_m").alias("min_dist_to_route_m"),
    )
    return agg.select("route_id", instant_to_utc_ntz(F.col("w.start")).alias("ts_hour_utc"), "n_collisions", "n_injury_collisions", "n_fatal_collisions", "min_dist_to_route_m")


def bucket_mean_stream(panel: DataFrame, freq_minutes: int = 60, metric: str = "delay_s", lateness: str = DEFAULT_LATENESS) -> DataFrame:
    """Mean metric per (tumbling bucket, route)."""
    s = with_event_time(panel, lateness)
    agg = s.groupBy(F.window("event_time", f"{freq_minutes} minutes").alias("w"), "route_id").agg(
        F.avg(F.nanvl(F.col(metric).cast("double"), F.lit(None).cast("double"))).alias("value")
    )
    start = instant_to_utc_ntz(F.col("w.start"))
    return agg.select(start.alias("bucket_utc"), F.date_format(utc_to_local(start), "yyyy-MM-dd HH:mm").alias("label"), "route_id", "value")


def trailing_hour_stream(panel: DataFrame, metric: str = "travel_time_s", lateness: str = DEFAULT_LATENESS) -> DataFrame:
    """T4: 60-minute trailing history per route, advancing every 5 minutes (sliding window)."""
    s = with_event_time(panel, lateness)
    agg = s.groupBy(F.window("event_time", "60 minutes", "5 minutes").alias("w"), "route_id").agg(
        F.count(F.lit(1)).alias("n_obs"), F.avg(metric).alias("mean_value")
    )
    return agg.select("route_id", instant_to_utc_ntz(F.col("w.end")).alias("window_end_utc"), "n_obs", "mean_value")


def dedupe_first_stream(panel: DataFrame, lateness: str = DEFAULT_LATENESS) -> DataFrame:
    """First row per (route_id, ts_utc) within the watermark (built-in)."""
    return with_event_time(panel, lateness).dropDuplicatesWithinWatermark(["route_id", "ts_utc"])


def dedupe_last_stream(panel: DataFrame, lateness: str = DEFAULT_LATENESS) -> DataFrame:
    """Keep-last per (route_id, ts_utc) by ingest position, as in batch W2.

    A native aggregate: the latest row of each key is state until the watermark passes the
    key's time, so late duplicates within the bound still replace earlier ones.
    """
    s = with_event_time(panel.select("route_id", "ts_utc", "src_pos", "travel_time_s"), lateness)
    last = s.groupBy("route_id", "event_time").agg(F.max_by(F.struct("src_pos", "travel_time_s"), "src_pos").alias("_last"))
    return last.select("route_id", instant_to_utc_ntz("event_time").alias("ts_utc"), "_last.src_pos", "_last.travel_time_s")


def start(stream: DataFrame, name: str, path: str, *, mode: str = "append", available_now: bool = False):
    """Parquet sink with its checkpoint under the shared checkpoint folder."""
    ckpt = f"{ensure_checkpoint_dir(stream.sparkSession).rstrip('/')}/streams/{name}"
    w = stream.writeStream.queryName(name).outputMode(mode).format("parquet").option("path", path).option("checkpointLocation", ckpt)
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()
