"""Pre-aggregations joined into the panel (A1, A2) and coverage bounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citymotion.functions.timez import floor_hour

EVENT_DAY_COLUMNS = ["date", "n_events_active", "n_events_road_close", "n_events_with_coords"]
COLLISION_HOUR_COLUMNS = [
    "route_id",
    "ts_hour_utc",
    "n_collisions",
    "n_injury_collisions",
    "n_fatal_collisions",
    "min_dist_to_route_m",
]


def event_day_summary(events: DataFrame) -> DataFrame:
    """Per local date: events active, active with road closure, active with coordinates (A1).

    Semantics: an event covers every local date from ``start_local`` to
    ``end_local`` inclusive; a NULL start is skipped, a NULL end means the start
    day, end before start covers nothing.  A NULL ``road_close`` counts as False.

    Plan: a sweep instead of an interval explode.  Each event contributes +1
    on its first day and -1 the day after its last, the deltas are summed per
    day (partial aggregation, so hot days cost nothing extra), and a running
    sum over the day spine gives the counts.  Work is O(events + days in range),
    independent of interval length.  The running sum is two-level (inside each
    month, plus month offsets from the month totals), so no window orders the
    whole day spine.
    """
    ev = (
        events.where(F.col("start_local").isNotNull())
        .select(
            F.to_date("start_local").alias("d0"),
            F.to_date(F.coalesce("end_local", "start_local")).alias("d1"),
            F.coalesce(F.col("road_close"), F.lit(False)).cast("long").alias("rc"),
            (F.col("lat").isNotNull() & F.col("lon").isNotNull()).cast("long").alias("hc"),
        )
        .where(F.col("d1") >= F.col("d0"))
    )
    deltas = ev.select(
        F.explode(
            F.array(
                F.struct(F.col("d0").alias("date"), F.lit(1).cast("long").alias("a"), F.col("rc").alias("r"), F.col("hc").alias("h")),
                F.struct(F.date_add("d1", 1).alias("date"), F.lit(-1).cast("long").alias("a"), (-F.col("rc")).alias("r"), (-F.col("hc")).alias("h")),
            )
        ).alias("x")
    ).select("x.*")
    per_day = deltas.groupBy("date").agg(F.sum("a").alias("a"), F.sum("r").alias("r"), F.sum("h").alias("h"))
    spine = per_day.agg(F.min("date").alias("lo"), F.max("date").alias("hi")).select(
        F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("date")
    )
    # two-level prefix sum: running sums inside each month, plus each month's offset
    # from a running sum over month totals (at most 12 rows a year)
    days = spine.join(per_day, "date", "left").select(
        "date",
        F.trunc("date", "month").alias("_m"),
        *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("a", "r", "h")],
    )
    months = days.groupBy("_m").agg(*[F.sum(c).alias(f"_t{c}") for c in ("a", "r", "h")])
    before = Window.orderBy("_m").rowsBetween(Window.unboundedPreceding, -1)
    offsets = months.select("_m", *[F.coalesce(F.sum(f"_t{c}").over(before), F.lit(0)).alias(f"_o{c}") for c in ("a", "r", "h")])
    inside = Window.partitionBy("_m").orderBy("date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = days.join(F.broadcast(offsets), "_m").select(  # offsets: one row per month
        "date",
        (F.col("_oa") + F.sum("a").over(inside)).alias("n_events_active"),
        (F.col("_or") + F.sum("r").over(inside)).alias("n_events_road_close"),
        (F.col("_oh") + F.sum("h").over(inside)).alias("n_events_with_coords"),
    )
    return out.where(F.col("n_events_active") > 0)


def event_day_summary_exploded(events: DataFrame) -> DataFrame:
    """Same result as :func:`event_day_summary` by exploding each interval into days.

    Cost grows with total interval length; kept as the brute-force check.
    """
    ev = events.where(F.col("start_local").isNotNull()).select(
        F.to_date("start_local").alias("d0"),
        F.to_date(F.coalesce("end_local", "start_local")).alias("d1"),
        F.coalesce(F.col("road_close"), F.lit(False)).alias("rc"),
        (F.col("lat").isNotNull() & F.col("lon").isNotNull()).alias("hc"),
    )
    days = ev.where(F.col("d1") >= F.col("d0")).select(
        F.explode(F.sequence("d0", "d1", F.expr("INTERVAL 1 DAY"))).alias("date"), "rc", "hc"
    )
    return days.groupBy("date").agg(
        F.count(F.lit(1)).alias("n_events_active"),
        F.count_if("rc").alias("n_events_road_close"),
        F.count_if("hc").alias("n_events_with_coords"),
    )


def collision_route_hour_summary(collisions: DataFrame) -> DataFrame:
    """Per (route, UTC hour): collisions, injury ones, fatal ones, min snap distance (A2).

    Rows without route or time are ignored; a missing flag column counts as False.
    """
    cols = set(collisions.columns)
    injury = F.coalesce(F.col("is_injury"), F.lit(False)) if "is_injury" in cols else F.lit(False)
    fatal = (
        F.coalesce(F.col("fatalities").try_cast("double"), F.lit(0.0)) > 0
        if "fatalities" in cols
        else F.lit(False)
    )
    dist = F.col("dist_to_route_m").try_cast("double") if "dist_to_route_m" in cols else F.lit(None).cast("double")
    c = collisions.where(F.col("route_id").isNotNull() & F.col("ts_utc").isNotNull())
    return (
        c.select(
            F.col("route_id").cast("string").alias("route_id"),
            floor_hour("ts_utc").alias("ts_hour_utc"),
            injury.alias("_inj"),
            fatal.alias("_fat"),
            dist.alias("_dist"),
        )
        .groupBy("route_id", "ts_hour_utc")
        .agg(
            F.count(F.lit(1)).alias("n_collisions"),
            F.count_if("_inj").alias("n_injury_collisions"),
            F.count_if("_fat").alias("n_fatal_collisions"),
            F.min("_dist").alias("min_dist_to_route_m"),
        )
    )


def date_bounds(panel: DataFrame) -> DataFrame:
    """Coverage bounds (A7): one row ``(min_date, max_date)``; uses ts_local if no date."""
    d = F.col("date") if "date" in panel.columns else F.to_date("ts_local")
    return panel.agg(F.min(d).alias("min_date"), F.max(d).alias("max_date"))
