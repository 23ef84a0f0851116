"""Route x time panel: fact observations enriched by five left joins (J1-J5),
derived columns (P17-P19) and the QA row (A8).

Inputs (all DataFrames, normalised):
  travel     route_id, travel_time_s, sample_count, ts_utc, ts_local, year
  routes     route_id, free_flow_s, length_m
  weather    ts_utc (hour instant, NULL when ambiguous), ts_local, measurement columns
  civic      civic_days() output, keyed by date
  events     start_local, end_local, road_close, lat, lon
  collisions route_id, ts_utc, is_injury, fatalities, dist_to_route_m

Plan: the fact table stays left-most and is never re-ordered.  Corridors, hourly
weather and one day table (civic features and event counts) are written once; their
measured bytes prove them small (they are bounded by the network and the calendar), so
they are broadcast.  A side over the limit is joined with a shuffle.
The collision summary grows with incidents and is left to AQE; it is joined before the day
table, whose name lists are most of a panel row (2 KB and more), so the fact is shuffled and
ordered while its rows are narrow.  Counts are
pre-aggregated before joining, so no join multiplies fact rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citymotion.functions.timez import floor_hour, utc_to_local
from citymotion.operators.calendar import FLAG_KINDS
from citymotion.operators.summaries import collision_route_hour_summary, event_day_summary
from citymotion.session import measured_side

WEATHER_KEY = "ts_utc"


def prefix_weather(weather: DataFrame) -> DataFrame:
    """Prefix every measurement with ``wx_``; the hour instant becomes the join key."""
    measures = [c for c in weather.columns if c not in (WEATHER_KEY, "ts_local")]
    return weather.where(F.col(WEATHER_KEY).isNotNull()).select(
        F.col(WEATHER_KEY).alias("ts_hour_utc"), *[F.col(c).alias(f"wx_{c}") for c in measures]
    )


def build_panel(
    travel: DataFrame,
    routes: DataFrame,
    weather: DataFrame,
    civic: DataFrame,
    events: DataFrame,
    collisions: DataFrame | None,
    *,
    years: list[int] | None = None,
) -> DataFrame:
    fact = travel
    if years is not None:
        fact = fact.where(F.col("year").isin(list(years)))

    # J1 corridors
    panel = fact.join(measured_side(routes, "routes"), "route_id", "left")
    # J2 hourly weather on the UTC hour (DST-safe)
    panel = panel.withColumn("ts_hour_utc", floor_hour("ts_utc"))
    panel = panel.join(measured_side(prefix_weather(weather), "weather"), "ts_hour_utc", "left")
    # J5 route x hour incidents, counts zero filled, distance left NULL
    if collisions is not None:
        matched = collisions.where(F.col("route_id").isNotNull())
        panel = panel.join(collision_route_hour_summary(matched), ["route_id", "ts_hour_utc"], "left")
    else:
        panel = panel.withColumns(
            {
                "n_collisions": F.lit(None).cast("long"),
                "n_injury_collisions": F.lit(None).cast("long"),
                "n_fatal_collisions": F.lit(None).cast("long"),
                "min_dist_to_route_m": F.lit(None).cast("double"),
            }
        )
    # J3 and J4 on the local date: civic day features and event-day exposure, one day table
    days = civic.join(event_day_summary(events), "date", "full")
    panel = panel.withColumn("date", F.to_date("ts_local")).join(measured_side(days, "days"), "date", "left")
    zero = {
        c: F.coalesce(F.col(c), F.lit(0)).cast("long")
        for c in (
            "n_events_active",
            "n_events_road_close",
            "n_events_with_coords",
            "n_collisions",
            "n_injury_collisions",
            "n_fatal_collisions",
        )
    }
    derived = {
        "ts_hour": utc_to_local("ts_hour_utc"),
        "hour": F.hour("ts_local").cast("long"),
        "dow": F.weekday("ts_local").cast("long"),
        "is_weekend": F.weekday("ts_local").isin(5, 6),
        "holiday_names": F.coalesce(F.col("holiday_names"), F.lit("")),
        "delay_s": F.col("travel_time_s") - F.col("free_flow_s"),
    }
    return panel.withColumns({**zero, **derived})


def panel_qa(panel: DataFrame) -> DataFrame:
    """One-row QA summary.

    ``event_days_with_exposure`` and ``collision_route_hours_with_exposure``
    count panel *rows* with exposure, not distinct days or hours (as in the source).
    """
    def rate(col: str) -> F.Column:
        if col not in panel.columns:
            return F.lit(0.0)
        return F.coalesce(F.avg(F.col(col).isNotNull().cast("double")), F.lit(0.0))

    return panel.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("route_id").alias("n_routes"),
        F.min("year").cast("long").alias("year_min"),
        F.max("year").cast("long").alias("year_max"),
        F.round(rate("wx_temp_c"), 6).alias("weather_match_rate"),
        F.round(rate("is_holiday"), 6).alias("civic_match_rate"),
        F.round(rate("length_m"), 6).alias("routes_match_rate"),
        F.count_if(F.col("n_events_active") > 0).alias("event_days_with_exposure"),
        F.count_if(F.col("n_collisions") > 0).alias("collision_route_hours_with_exposure"),
        F.round(F.coalesce(F.avg(F.col("travel_time_s").isNull().cast("double")), F.lit(0.0)), 6).alias(
            "null_travel_time_rate"
        ),
    )


PANEL_FLAGS = list(FLAG_KINDS)
