"""Driver-facing query registry: Spark callables and their DuckDB oracle SQL.

Every query reads the driver tables in full (through :mod:`adapters`); none
subsets ids or caps rows.  Doubles computed by aggregation are rounded to 6
decimals on both sides so engine summation order cannot change the hash.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citymotion.plans import adapters as A
from citymotion.plans import oracle as O

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


# ---------------------------------------------------------------- panel (flagship)
def build_panel_df(spark: SparkSession, sf: str) -> DataFrame:
    from citymotion.operators.calendar import civic_days
    from citymotion.operators.panel import build_panel

    return build_panel(
        A.observations(spark, sf),
        A.corridors(spark, sf),
        A.weather(spark, sf),
        civic_days(A.calendar_entries(spark, sf)),
        A.festival_events(spark, sf),
        A.incidents(spark, sf),
    )


def panel(spark: SparkSession, sf: str) -> DataFrame:
    """The enriched panel, written once per session (partitioned by year) and read back."""
    from citymotion.plans.materialize import materialized

    return materialized(spark, "route_time_panel", sf, lambda: build_panel_df(spark, sf), partition_by=["year"])


PANEL_COLUMNS = [
    "route_id", "ts_utc", "ts_local", "year", "travel_time_s", "sample_count", "free_flow_s", "length_m",
    "ts_hour_utc", "ts_hour", "wx_temp_c", "wx_rel_hum_pct", "wx_precip_mm", "wx_wind_spd_kmh", "wx_weather_desc",
    "date", "is_public_holiday", "is_civic_holiday", "is_holiday", "is_school_break", "is_mega_event", "is_parade",
    "is_shopping_peak", "n_civic_events", "holiday_names", "mega_event_names", "event_ids", "event_kinds",
    "n_events_active", "n_events_road_close", "n_events_with_coords", "n_collisions", "n_injury_collisions",
    "n_fatal_collisions", "min_dist_to_route_m", "hour", "dow", "is_weekend", "delay_s",
]


@register("panel_enriched", O.with_ctes(O.PANEL_DEPS, f"SELECT {', '.join(PANEL_COLUMNS)} FROM panel"))
def q_panel_enriched(spark, sf):
    return panel(spark, sf).select(*PANEL_COLUMNS)


@register(
    "panel_qa",
    O.with_ctes(
        O.PANEL_DEPS,
        """SELECT count(*) AS n_rows, count(DISTINCT route_id) AS n_routes,
       CAST(min(year) AS BIGINT) AS year_min, CAST(max(year) AS BIGINT) AS year_max,
       round(avg(CASE WHEN wx_temp_c IS NOT NULL THEN 1.0 ELSE 0.0 END), 6) AS weather_match_rate,
       round(avg(CASE WHEN is_holiday IS NOT NULL THEN 1.0 ELSE 0.0 END), 6) AS civic_match_rate,
       round(avg(CASE WHEN length_m IS NOT NULL THEN 1.0 ELSE 0.0 END), 6) AS routes_match_rate,
       count(*) FILTER (WHERE n_events_active > 0) AS event_days_with_exposure,
       count(*) FILTER (WHERE n_collisions > 0) AS collision_route_hours_with_exposure,
       round(avg(CASE WHEN travel_time_s IS NULL THEN 1.0 ELSE 0.0 END), 6) AS null_travel_time_rate
FROM panel""",
    ),
)
def q_panel_qa(spark, sf):
    from citymotion.operators.panel import panel_qa

    return panel_qa(panel(spark, sf))


# ---------------------------------------------------------------- summaries
@register("event_day_summary", O.with_ctes([O.FEST], "SELECT * FROM evday"))
def q_event_day_summary(spark, sf):
    from citymotion.operators.summaries import event_day_summary

    return event_day_summary(A.festival_events(spark, sf))


@register(
    "incident_route_hour",
    O.with_ctes([O.INC, O.INCSUM], "SELECT * FROM incsum"),
)
def q_incident_route_hour(spark, sf):
    from citymotion.operators.summaries import collision_route_hour_summary

    return collision_route_hour_summary(A.incidents(spark, sf))


@register("civic_days", O.with_ctes([O.CAL, O.CIVIC], "SELECT * FROM civic"))
def q_civic_days(spark, sf):
    from citymotion.operators.calendar import civic_days

    return civic_days(A.calendar_entries(spark, sf))


@register(
    "coverage_bounds",
    O.with_ctes(O.PANEL_DEPS, "SELECT min(date) AS min_date, max(date) AS max_date FROM panel"),
)
def q_coverage_bounds(spark, sf):
    from citymotion.operators.summaries import date_bounds

    return date_bounds(panel(spark, sf))


# ---------------------------------------------------------------- spatial
def vertices(spark: SparkSession, sf: str) -> DataFrame:
    """Corridor polylines, written once per session (several queries read them)."""
    from citymotion.plans.materialize import materialized

    return materialized(spark, "route_vertices", sf, lambda: A.route_vertices(spark, sf))


def snapped_all(spark: SparkSession, sf: str) -> DataFrame:
    from citymotion.operators.spatial import nearest_routes
    from citymotion.plans.materialize import materialized

    return materialized(spark, "snapped_points", sf, lambda: nearest_routes(A.snap_points(spark, sf), vertices(spark, sf)))


@register(
    "nearest_route_snap",
    O.with_ctes([O.VERTS, O.PTS, O.SNAP], "SELECT collision_id, route_id, round(dist_to_route_m, 3) AS dist_to_route_m FROM snap"),
)
def q_nearest_route_snap(spark, sf):
    s = snapped_all(spark, sf).where(F.col("route_id").isNotNull())
    return s.select("collision_id", "route_id", F.round("dist_to_route_m", 3).alias("dist_to_route_m"))


@register(
    "snap_qa",
    O.with_ctes(
        [O.VERTS, O.PTS, O.SNAP],
        """SELECT n_with_coords, n_route_matched, n_with_coords - n_route_matched AS n_discarded_far_from_network,
       round(CASE WHEN n_with_coords > 0 THEN n_route_matched / n_with_coords ELSE 0.0 END, 6) AS match_rate,
       n_routes_matched, 150.0::DOUBLE AS max_distance_m, round(p50, 3) AS dist_to_route_m_p50, round(p90, 3) AS dist_to_route_m_p90
FROM (SELECT (SELECT count(*) FROM ppts) AS n_with_coords, count(*) AS n_route_matched,
             count(DISTINCT route_id) AS n_routes_matched,
             quantile_cont(dist_to_route_m, 0.5) AS p50, quantile_cont(dist_to_route_m, 0.9) AS p90 FROM snap)""",
    ),
)
def q_snap_qa(spark, sf):
    from citymotion.operators.spatial import snap_qa

    return snap_qa(snapped_all(spark, sf))


# ---------------------------------------------------------------- route metrics
def _metric_sql(expr: str) -> str:
    return O.with_ctes(
        O.PANEL_DEPS,
        f"""SELECT route_id, split_part(route_id, '_', 1) AS source, split_part(route_id, '_', 2) AS target,
       round({expr}, 6) AS value FROM panel GROUP BY route_id""",
    )


def _metric_query(agg: str):
    def q(spark, sf):
        from citymotion.operators.network import aggregate_route_metrics

        m = aggregate_route_metrics(panel(spark, sf), metric="delay_s", agg=agg)
        return m.withColumn("value", F.round("value", 6))

    return q


for _agg, _expr in (("mean", "avg(delay_s)"), ("median", "quantile_cont(delay_s, 0.5)"), ("p95", "quantile_cont(delay_s, 0.95)")):
    register(f"route_metrics_{_agg}", _metric_sql(_expr))(_metric_query(_agg))


# ---------------------------------------------------------------- congestion frames
def buckets(spark, sf, freq):
    from citymotion.operators.frames import congestion_buckets

    return congestion_buckets(panel(spark, sf), freq=freq, metric="delay_s")


def _bucket_query(freq):
    def q(spark, sf):
        return buckets(spark, sf, freq).withColumn("value", F.round("value", 6))

    return q


for _name, _freq, _min in (("5m", "5min", 5), ("15m", "15min", 15), ("30m", "30min", 30), ("1h", "h", 60)):
    register(
        f"congestion_buckets_{_name}",
        O.with_ctes(O.PANEL_DEPS + [O.buckets_cte(_min)], "SELECT bucket_utc, label, route_id, round(value, 6) AS value FROM buckets"),
    )(_bucket_query(_freq))


@register(
    "congestion_pivot",
    O.with_ctes(
        O.PANEL_DEPS + [O.buckets_cte(60)],
        "SELECT route_id, CAST(bucket_utc AS DATE) AS date_utc, "
        + ", ".join(f"max(CASE WHEN hour(bucket_utc) = {h} THEN round(value, 6) END) AS h{h:02d}" for h in range(24))
        + " FROM buckets GROUP BY ALL",
    ),
)
def q_congestion_pivot(spark, sf):
    from citymotion.operators.frames import congestion_pivot

    b = buckets(spark, sf, "h").withColumn("value", F.round("value", 6))
    return congestion_pivot(b)


@register(
    "intensity_scaled",
    O.with_ctes(
        O.PANEL_DEPS
        + [
            O.buckets_cte(60),
            O.VERTS,
            """shown AS (SELECT * FROM buckets WHERE route_id IN (SELECT route_id FROM verts))""",
            """b AS (SELECT quantile_cont(value, 0.05) AS vmin, quantile_cont(value, 0.95) AS vmax0
        FROM shown WHERE value IS NOT NULL AND isfinite(value))""",
            """bb AS (SELECT vmin, CASE WHEN vmax0 <= vmin THEN vmin + 1.0 ELSE vmax0 END AS vmax FROM b)""",
        ],
        """SELECT bucket_utc, label, route_id, round(value, 6) AS value,
       round(CASE WHEN value IS NOT NULL AND isfinite(value) THEN least(greatest((value - vmin) / (vmax - vmin), 0.0), 1.0) END, 6) AS t,
       round(CASE WHEN value IS NOT NULL AND isfinite(value)
                  THEN 1.5 + 5.0 * least(greatest((value - vmin) / (vmax - vmin), 0.0), 1.0) ELSE 1.5 END, 6) AS width
FROM shown, bb""",
    ),
)
def q_intensity_scaled(spark, sf):
    from citymotion.operators.frames import intensity_frames

    out = intensity_frames(buckets(spark, sf, "h"), vertices(spark, sf))
    return out.select(
        "bucket_utc", "label", "route_id", F.round("value", 6).alias("value"), F.round("t", 6).alias("t"), F.round("width", 6).alias("width")
    )


# ---------------------------------------------------------------- network graph
def mean_metrics(spark, sf):
    from citymotion.operators.network import aggregate_route_metrics

    return aggregate_route_metrics(panel(spark, sf), metric="delay_s", agg="mean")


METRICS_CTE = """metrics AS (
  SELECT route_id, split_part(route_id, '_', 1) AS source, split_part(route_id, '_', 2) AS target, avg(delay_s) AS value
  FROM panel GROUP BY route_id
)"""
ENDS_CTE = """ends AS (
  SELECT route_id, arg_min(lon, seq) AS first_lon, arg_min(lat, seq) AS first_lat,
         arg_max(lon, seq) AS last_lon, arg_max(lat, seq) AS last_lat, count(*) AS n_points
  FROM verts GROUP BY route_id
)"""


@register(
    "route_graph_edges",
    O.with_ctes(
        O.PANEL_DEPS + [METRICS_CTE, O.VERTS, ENDS_CTE],
        """SELECT m.route_id, m.source, m.target, round(m.value, 6) AS value, coalesce(e.n_points, 0) AS n_points,
       round(e.first_lon, 6) AS start_lon, round(e.first_lat, 6) AS start_lat,
       round(e.last_lon, 6) AS end_lon, round(e.last_lat, 6) AS end_lat
FROM metrics m LEFT JOIN ends e USING (route_id)""",
    ),
)
def q_route_graph_edges(spark, sf):
    from citymotion.operators.network import edge_ends

    e = edge_ends(mean_metrics(spark, sf), vertices(spark, sf))
    return e.select(
        "route_id",
        "source",
        "target",
        F.round("value", 6).alias("value"),
        F.coalesce("n_points", F.lit(0)).cast("long").alias("n_points"),
        F.round("first_pt.lon", 6).alias("start_lon"),
        F.round("first_pt.lat", 6).alias("start_lat"),
        F.round("last_pt.lon", 6).alias("end_lon"),
        F.round("last_pt.lat", 6).alias("end_lat"),
    )


@register(
    "route_edge_points",
    O.with_ctes(
        O.PANEL_DEPS + [METRICS_CTE, O.VERTS],
        """SELECT m.route_id, m.source, m.target, round(m.value, 6) AS value, v.seq, round(v.lon, 6) AS lon, round(v.lat, 6) AS lat
FROM metrics m LEFT JOIN verts v USING (route_id)""",
    ),
)
def q_route_edge_points(spark, sf):
    from citymotion.operators.network import edge_points

    e = edge_points(mean_metrics(spark, sf), vertices(spark, sf))
    return e.select("route_id", "source", "target", F.round("value", 6).alias("value"), "seq", F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat"))


SAMPLES_CTE = """samples AS (
  SELECT m.source AS node, e.first_lon AS lon, e.first_lat AS lat FROM metrics m JOIN ends e USING (route_id)
  UNION ALL
  SELECT m.target AS node, e.last_lon AS lon, e.last_lat AS lat FROM metrics m JOIN ends e USING (route_id)
)"""


@register(
    "route_graph_nodes",
    O.with_ctes(
        O.PANEL_DEPS + [METRICS_CTE, O.VERTS, ENDS_CTE, SAMPLES_CTE],
        "SELECT node, round(avg(lon), 6) AS lon, round(avg(lat), 6) AS lat, count(*) AS n_samples FROM samples GROUP BY node",
    ),
)
def q_route_graph_nodes(spark, sf):
    from citymotion.operators.network import graph_nodes

    n = graph_nodes(mean_metrics(spark, sf), vertices(spark, sf))
    return n.select("node", F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat"), "n_samples")


@register(
    "map_centre",
    O.with_ctes(
        O.PANEL_DEPS + [METRICS_CTE, O.VERTS],
        """SELECT round(avg(lon), 6) AS centre_lon, round(avg(lat), 6) AS centre_lat, count(*) AS n_vertices
FROM verts WHERE route_id IN (SELECT route_id FROM metrics)""",
    ),
)
def q_map_centre(spark, sf):
    from citymotion.operators.network import map_centre

    c = map_centre(mean_metrics(spark, sf), vertices(spark, sf))
    return c.select(F.round("centre_lon", 6).alias("centre_lon"), F.round("centre_lat", 6).alias("centre_lat"), "n_vertices")


# ---------------------------------------------------------------- cleaning
CLEAN_COLUMNS = [
    "route_id", "ts_utc", "ts_local", "year", "hour", "dow", "is_weekend", "hour_sin", "hour_cos", "dow_sin", "dow_cos",
    "is_public_holiday", "is_civic_holiday", "is_holiday", "is_school_break", "is_mega_event", "is_parade",
    "is_shopping_peak", "obs_travel", "obs_weather", "wx_precip_mm", "travel_time_s", "delay_s",
]
ROUND6 = {"hour_sin", "hour_cos", "dow_sin", "dow_cos"}


def cleaned(spark, sf):
    from citymotion.operators.clean import clean_panel
    from citymotion.plans.materialize import materialized

    return materialized(
        spark, "panel_clean", sf, lambda: clean_panel(panel(spark, sf).select(*PANEL_COLUMNS, "src_pos"), min_sample_count=0)
    )


def _sel(cols):
    return ", ".join(f"round({c}, 6) AS {c}" if c in ROUND6 else c for c in cols)


PANEL_SRC = O.PANEL_DEPS


@register("clean_panel", O.with_ctes(PANEL_SRC + [O.CLEAN], f"SELECT {_sel(CLEAN_COLUMNS)} FROM clean"))
def q_clean_panel(spark, sf):
    c = cleaned(spark, sf)
    return c.select(*[F.round(x, 6).alias(x) if x in ROUND6 else F.col(x) for x in CLEAN_COLUMNS])


@register(
    "clean_qa",
    O.with_ctes(
        PANEL_SRC + [O.CLEAN],
        """SELECT (SELECT count(*) FROM panel) AS rows_before, count(*) AS rows_after,
       (SELECT count(*) FROM panel) - count(*) AS n_dupes_dropped,
       round(avg(CAST(obs_travel AS DOUBLE)), 6) AS obs_travel_rate, round(avg(CAST(obs_weather AS DOUBLE)), 6) AS obs_weather_rate
FROM clean""",
    ),
)
def q_clean_qa(spark, sf):
    from citymotion.operators.clean import clean_qa

    return clean_qa(panel(spark, sf), cleaned(spark, sf))


@register("weather_hourly", O.with_ctes([O.WX], "SELECT * FROM wx"))
def q_weather_hourly(spark, sf):
    return A.weather(spark, sf)


def _v1_sql() -> str:
    dropped = ["wx_wind_spd_kmh", "wx_weather_desc", "holiday_names", "mega_event_names"]  # as specified, not as computed
    retained = [c for c in PANEL_COLUMNS if c not in dropped]
    return O.with_ctes(
        O.PANEL_DEPS,
        f"""SELECT count(*) AS source_rows, count(*) AS output_rows, CAST({len(PANEL_COLUMNS)} AS BIGINT) AS n_cols_before,
       CAST({len(retained)} AS BIGINT) AS n_cols_after, '{"|".join(dropped)}' AS dropped_columns,
       '{"|".join(retained)}' AS retained_columns,
       round(coalesce(avg(CASE WHEN isodow(ts_local) IN (6, 7) THEN 1.0 ELSE 0.0 END), 0.0), 6) AS is_weekend_rate,
       round(coalesce(avg(CASE WHEN length(coalesce(event_ids, '')) > 0 THEN 1.0 ELSE 0.0 END), 0.0), 6) AS event_ids_nonempty_rate
FROM panel""",
    )


@register("clean_panel_v1_qa", _v1_sql())
def q_clean_panel_v1_qa(spark, sf):
    from citymotion.operators.clean import v1_qa

    return v1_qa(panel(spark, sf).select(*PANEL_COLUMNS))


def _null_profile_sql() -> str:
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, round(avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END), 6) AS null_rate FROM panel"
        for c in PANEL_COLUMNS
    )
    return O.with_ctes(O.PANEL_DEPS, f"SELECT * FROM ({parts}) ORDER BY null_rate DESC, column_name LIMIT 12")


@register("null_profile", _null_profile_sql())
def q_null_profile(spark, sf):
    from citymotion.operators.clean import null_profile

    return null_profile(panel(spark, sf).select(*PANEL_COLUMNS), top=12)


# ---------------------------------------------------------------- scoring
TRAIN_YEAR = 2024  # the driver's event month; 2023-12-31 local rows act as held-out


DAY_TEXTS = ("holiday_names", "mega_event_names", "event_ids", "event_kinds")  # 2 KB and more a row; no score reads them


def normative(spark, sf):
    from citymotion.operators.scoring import normative_mask
    from citymotion.plans.materialize import materialized

    return materialized(spark, "panel_normative", sf, lambda: normative_mask(cleaned(spark, sf).drop(*DAY_TEXTS), train_years=[TRAIN_YEAR]))


NORM_DEPS = PANEL_SRC + [O.CLEAN, O.normative_cte(TRAIN_YEAR)]


@register(
    "normative_mask",
    O.with_ctes(
        NORM_DEPS,
        "SELECT route_id, ts_utc, round(delay_threshold, 6) AS delay_threshold, round(baseline_delay_s, 6) AS baseline_delay_s, is_normative FROM normative",
    ),
)
def q_normative_mask(spark, sf):
    n = normative(spark, sf)
    return n.select(
        "route_id", "ts_utc", F.round("delay_threshold", 6).alias("delay_threshold"),
        F.round("baseline_delay_s", 6).alias("baseline_delay_s"), "is_normative",
    )


def _std_sql() -> str:
    from citymotion.operators.scoring import SCALE_COLS

    stats = ", ".join(f"avg({c}) AS m_{c}, CASE WHEN coalesce(stddev_pop({c}), 0) = 0 THEN 1.0 ELSE stddev_pop({c}) END AS s_{c}" for c in SCALE_COLS)
    zs = ", ".join(f"round(({c} - m_{c}) / s_{c}, 6) AS {c}_z" for c in SCALE_COLS)
    return O.with_ctes(
        PANEL_SRC + [O.CLEAN, f"st AS (SELECT {stats} FROM clean WHERE year = {TRAIN_YEAR})"],
        f"SELECT route_id, ts_utc, {zs} FROM clean, st",
    )


@register("standardize", _std_sql())
def q_standardize(spark, sf):
    from citymotion.operators.scoring import SCALE_COLS, standardize

    s = standardize(cleaned(spark, sf), train_years=[TRAIN_YEAR])
    return s.select("route_id", "ts_utc", *[F.round(f"{c}_z", 6).alias(f"{c}_z") for c in SCALE_COLS])


def _fv_sql() -> str:
    from citymotion.operators.scoring import FEATURE_COLS

    cols = ", ".join(f"round(CAST({c} AS DOUBLE), 6) AS f{i}" for i, c in enumerate(FEATURE_COLS))
    present = " + ".join(f"CASE WHEN {c} IS NOT NULL THEN 1 ELSE 0 END" for c in FEATURE_COLS)
    return O.with_ctes(PANEL_SRC + [O.CLEAN], f"SELECT route_id, ts_utc, {cols}, CAST({present} AS BIGINT) AS n_present FROM clean")


@register("feature_vectors", _fv_sql())
def q_feature_vectors(spark, sf):
    from citymotion.operators.scoring import FEATURE_COLS, feature_vectors

    fv = feature_vectors(cleaned(spark, sf))
    return fv.select(
        "route_id",
        "ts_utc",
        *[F.round(F.get("features", i), 6).alias(f"f{i}") for i in range(len(FEATURE_COLS))],
        F.size(F.filter("feature_mask", lambda m: m)).cast("long").alias("n_present"),
    )


@register(
    "adjacency",
    O.with_ctes(
        O.PANEL_DEPS
        + [
            METRICS_CTE,
            "o AS (SELECT source AS node, count(*) AS out_degree FROM metrics GROUP BY 1)",
            "i AS (SELECT target AS node, count(*) AS in_degree FROM metrics GROUP BY 1)",
        ],
        """SELECT d.node, p.route_id, p.next_route_id, d.in_degree, d.out_degree, d.in_degree * d.out_degree AS n_adjacent_pairs
FROM (SELECT coalesce(o.node, i.node) AS node, coalesce(in_degree, 0) AS in_degree, coalesce(out_degree, 0) AS out_degree
      FROM o FULL JOIN i ON o.node = i.node) d
LEFT JOIN (SELECT a.target AS node, a.route_id, b.route_id AS next_route_id FROM metrics a JOIN metrics b ON a.target = b.source) p ON d.node = p.node""",
    ),
)
def q_adjacency(spark, sf):
    from citymotion.operators.scoring import adjacency

    return adjacency(mean_metrics(spark, sf))


STEPS_CTE = f"""steps AS (
  SELECT route_id, step_utc, x FROM (
    SELECT route_id, {O.bucket_sql('ts_utc', 5)} AS step_utc, travel_time_s AS x,
           row_number() OVER (PARTITION BY route_id, {O.bucket_sql('ts_utc', 5)} ORDER BY ts_utc DESC, src_pos DESC) AS rn
    FROM panel) WHERE rn = 1
)"""


@register(
    "trailing_windows",
    O.with_ctes(
        O.PANEL_DEPS + [STEPS_CTE],
        """SELECT e.route_id, e.step_utc AS window_end, count(*) AS n_steps, count(*) = 12 AS is_complete,
       round(avg(s.x), 6) AS mean_x, arg_min(s.x, s.step_utc) AS first_x, arg_max(s.x, s.step_utc) AS last_x
FROM steps e JOIN steps s ON e.route_id = s.route_id AND s.step_utc BETWEEN e.step_utc - INTERVAL 55 MINUTE AND e.step_utc
GROUP BY 1, 2""",
    ),
)
def q_trailing_windows(spark, sf):
    from citymotion.operators.scoring import step_series, trailing_windows

    w = trailing_windows(step_series(panel(spark, sf)))
    return w.select(
        "route_id", "window_end", "n_steps", "is_complete", F.round("mean_x", 6).alias("mean_x"),
        F.get("history", 0).alias("first_x"), F.get("history", F.size("history") - 1).alias("last_x"),
    )


SCORE_SQL = "CASE WHEN delay_s IS NOT NULL AND baseline_delay_s IS NOT NULL THEN (delay_s - baseline_delay_s) * (delay_s - baseline_delay_s) ELSE 0.0 END"


def scores(spark, sf):
    from citymotion.operators.scoring import reconstruction_score

    return reconstruction_score(normative(spark, sf), ["delay_s"], ["baseline_delay_s"])


@register("recon_score", O.with_ctes(NORM_DEPS, f"SELECT route_id, ts_utc, round({SCORE_SQL}, 6) AS score FROM normative"))
def q_recon_score(spark, sf):
    return scores(spark, sf).select("route_id", "ts_utc", F.round("score", 6).alias("score"))


@register(
    "route_thresholds",
    O.with_ctes(
        NORM_DEPS,
        f"SELECT route_id, round(quantile_cont({SCORE_SQL}, 0.99), 6) AS threshold, count(*) AS n_scored FROM normative GROUP BY route_id",
    ),
)
def q_route_thresholds(spark, sf):
    from citymotion.operators.scoring import route_thresholds

    t = route_thresholds(scores(spark, sf), q=0.99)
    return t.select("route_id", F.round("threshold", 6).alias("threshold"), "n_scored")


# ---------------------------------------------------------------- scalar functions on driver text / times
TZ_SQL = "'America/Toronto'"
WALL_SQL = "(CAST(l_shipdate AS TIMESTAMP) + to_hours(CAST(l_linenumber AS BIGINT)) + to_minutes(CAST(l_quantity AS BIGINT)))"


def _localize_sql() -> str:
    u = f"timezone('UTC', {WALL_SQL} AT TIME ZONE {TZ_SQL})"
    back = f"timezone({TZ_SQL}, ({u}) AT TIME ZONE 'UTC')"
    plus = f"timezone({TZ_SQL}, ({u} + INTERVAL 1 HOUR) AT TIME ZONE 'UTC')"
    minus = f"timezone({TZ_SQL}, ({u} - INTERVAL 1 HOUR) AT TIME ZONE 'UTC')"
    first_valid = f"timezone('UTC', (date_trunc('hour', {WALL_SQL}) + INTERVAL 1 HOUR) AT TIME ZONE {TZ_SQL})"
    return f"""SELECT l_orderkey, l_linenumber, {WALL_SQL} AS wall_local,
       CASE WHEN {plus} = {WALL_SQL} OR {minus} = {WALL_SQL} THEN NULL
            WHEN {back} <> {WALL_SQL} THEN {first_valid}
            ELSE {u} END AS ts_utc
FROM lineitem"""


@register("localize_dst", _localize_sql())
def q_localize_dst(spark, sf):
    from citymotion.functions.timez import localize

    li = A.table(spark, sf, "lineitem")
    wall = F.col("l_shipdate") + F.make_dt_interval(F.lit(0), F.col("l_linenumber"), F.col("l_quantity").cast("int"))
    return li.select("l_orderkey", "l_linenumber", wall.alias("wall_local")).withColumn("ts_utc", localize("wall_local"))


@register(
    "floor_hour_utc",
    f"""SELECT l_orderkey, l_linenumber, date_trunc('hour', {WALL_SQL}) AS hour_utc,
       timezone({TZ_SQL}, date_trunc('hour', {WALL_SQL}) AT TIME ZONE 'UTC') AS hour_local,
       CAST(timezone({TZ_SQL}, {WALL_SQL} AT TIME ZONE 'UTC') AS DATE) AS local_date
FROM lineitem""",
)
def q_floor_hour_utc(spark, sf):
    from citymotion.functions.timez import floor_hour, local_date, utc_to_local

    li = A.table(spark, sf, "lineitem")
    wall = F.col("l_shipdate") + F.make_dt_interval(F.lit(0), F.col("l_linenumber"), F.col("l_quantity").cast("int"))
    t = li.select("l_orderkey", "l_linenumber", wall.alias("ts"))
    return t.select(
        "l_orderkey", "l_linenumber", floor_hour("ts").alias("hour_utc"), utc_to_local(floor_hour("ts")).alias("hour_local"),
        local_date("ts").alias("local_date"),
    )


@register(
    "messy_number",
    """SELECT doc_id, TRY_CAST(nullif(regexp_extract(replace(text, ',', ''), '-?[0-9]+(?:[.][0-9]+)?', 0), '') AS DOUBLE) AS first_number
FROM documents""",
)
def q_messy_number(spark, sf):
    from citymotion.functions.text import first_number

    d = A.table(spark, sf, "documents")
    return d.select("doc_id", first_number("text").alias("first_number"))


# ---------------------------------------------------------------- collision validation
# scores are rounded to 6 decimals before thresholds and ranking, so both engines rank identical values
SC_CTES = NORM_DEPS + [
    O.INC,
    f"sc AS (SELECT route_id, ts_utc, round({SCORE_SQL}, 6) AS score FROM normative)",
    "thr AS (SELECT route_id, quantile_cont(score, 0.99) AS threshold FROM sc GROUP BY 1)",
    "alerts AS (SELECT sc.route_id, sc.ts_utc FROM sc JOIN thr USING (route_id) WHERE sc.score > thr.threshold)",
]


def rounded_scores(spark, sf):
    return scores(spark, sf).select("route_id", "ts_utc", F.round("score", 6).alias("score"))


@register(
    "alert_lead_times",
    O.with_ctes(
        SC_CTES
        + [
            """lead AS (
  SELECT i.collision_id, i.route_id, i.ts_utc, min(a.ts_utc) AS first_alert_utc
  FROM inc i LEFT JOIN alerts a ON a.route_id = i.route_id AND a.ts_utc < i.ts_utc AND a.ts_utc >= i.ts_utc - INTERVAL 60 MINUTE
  WHERE i.route_id IS NOT NULL AND i.ts_utc IS NOT NULL
  GROUP BY 1, 2, 3
)"""
        ],
        """SELECT collision_id, route_id, ts_utc, first_alert_utc,
       round(date_diff('microsecond', first_alert_utc, ts_utc) / 1000000.0, 6) AS lead_seconds FROM lead""",
    ),
)
def q_alert_lead_times(spark, sf):
    from citymotion.operators.scoring import alert_lead_times, route_thresholds

    s = rounded_scores(spark, sf)
    alerts = s.join(route_thresholds(s, q=0.99), "route_id").where(F.col("score") > F.col("threshold"))
    out = alert_lead_times(alerts, A.incidents(spark, sf), horizon_minutes=60)
    return out.select("collision_id", "route_id", "ts_utc", "first_alert_utc", F.round("lead_seconds", 6).alias("lead_seconds"))


@register(
    "pr_auc",
    O.with_ctes(
        SC_CTES
        + [
            """lab AS (
  SELECT sc.route_id, sc.ts_utc, sc.score,
         EXISTS (SELECT 1 FROM inc i WHERE i.route_id = sc.route_id AND i.ts_utc > sc.ts_utc
                 AND i.ts_utc <= sc.ts_utc + INTERVAL 60 MINUTE) AS label
  FROM sc
)""",
            "per AS (SELECT score, count(*) AS n, count(*) FILTER (WHERE label) AS tp FROM lab GROUP BY score)",
            "cum AS (SELECT score, tp, sum(n) OVER (ORDER BY score DESC) AS cn, sum(tp) OVER (ORDER BY score DESC) AS ctp FROM per)",
            "tot AS (SELECT count(*) AS n_scored, count(*) FILTER (WHERE label) AS n_positive FROM lab)",
        ],
        """SELECT n_scored, n_positive,
       round(CASE WHEN n_positive > 0 THEN (SELECT sum(tp * ctp / cn) FROM cum) / n_positive END, 6) AS average_precision
FROM tot""",
    ),
)
def q_pr_auc(spark, sf):
    from citymotion.operators.scoring import average_precision, label_rows

    lab = label_rows(rounded_scores(spark, sf), A.incidents(spark, sf), horizon_minutes=60)
    ap = average_precision(lab)
    return ap.select("n_scored", "n_positive", F.round("average_precision", 6).alias("average_precision"))


# ---------------------------------------------------------------- raw-text parsers on driver rows
def _event_texts(spark, sf):
    o = A.table(spark, sf, "orders")
    d = F.to_date("o_orderdate")
    tm = F.when(F.col("o_orderstatus") == "F", F.lit("9:30 AM")).when(F.col("o_orderstatus") == "O", F.lit("12:00 PM")).otherwise(F.lit(""))
    pr = F.col("o_orderpriority")
    date_text = (
        F.when(pr == "1-URGENT", F.date_format(d, "MMM d, yyyy"))
        .when(pr == "2-HIGH", F.date_format(d, "MMMM d, yyyy"))
        .when(pr == "3-MEDIUM", F.concat(F.date_format(d, "yyyy-MM-dd"), F.lit(" 18:45")))
        .when(pr == "4-NOT SPECIFIED", F.date_format(d, "yyyy-MM-dd"))
        .otherwise(F.lit("TBD"))
    )
    time_text = F.when(pr.isin("1-URGENT", "2-HIGH", "5-LOW"), tm).when(pr == "4-NOT SPECIFIED", F.lit("noon")).otherwise(F.lit(""))
    return o.select("o_orderkey", date_text.alias("date_text"), time_text.alias("time_text"))


_EVT_FORMATS = ["%b %d, %Y %I:%M %p", "%B %d, %Y %I:%M %p", "%b %d, %Y", "%B %d, %Y", "%Y-%m-%d %H:%M", "%Y-%m-%d"]


def _event_parse_sql() -> str:
    with_time = "CASE WHEN time_text <> '' THEN date_text || ' ' || time_text END"
    tries = [f"try_strptime({cand}, '{fmt}')" for cand in (with_time, "date_text") for fmt in _EVT_FORMATS]
    texts = """txt AS (
  SELECT o_orderkey,
         CASE o_orderpriority WHEN '1-URGENT' THEN strftime(CAST(o_orderdate AS DATE), '%b %-d, %Y')
              WHEN '2-HIGH' THEN strftime(CAST(o_orderdate AS DATE), '%B %-d, %Y')
              WHEN '3-MEDIUM' THEN strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') || ' 18:45'
              WHEN '4-NOT SPECIFIED' THEN strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') ELSE 'TBD' END AS date_text,
         CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '5-LOW')
                   THEN CASE o_orderstatus WHEN 'F' THEN '9:30 AM' WHEN 'O' THEN '12:00 PM' ELSE '' END
              WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'noon' ELSE '' END AS time_text
  FROM orders
)"""
    return O.with_ctes([texts], f"SELECT o_orderkey, date_text, time_text, coalesce({', '.join(tries)}) AS start_local FROM txt")


@register("event_datetime_parse", _event_parse_sql())
def q_event_datetime_parse(spark, sf):
    from citymotion.functions.text import event_datetime

    t = _event_texts(spark, sf)
    return t.select("o_orderkey", "date_text", "time_text", event_datetime("date_text", "time_text").alias("start_local"))


def _collision_rows(spark, sf):
    """Orders written as collision-CSV text rows (all strings)."""
    from citymotion.functions.timez import localize

    o = A.table(spark, sf, "orders")
    u = localize(F.to_timestamp_ntz(F.date_format(F.to_date("o_orderdate"), "yyyy-MM-dd")))
    ms = (
        F.datediff(F.to_date(u), F.lit("1970-01-01")).cast("long") * 86400000
        + F.hour(u).cast("long") * 3600000
        + F.minute(u).cast("long") * 60000
    )
    located = F.col("o_orderstatus") != "P"
    return o.select(
        F.col("o_orderkey").cast("string").alias("_id"),
        ms.cast("string").alias("OCC_DATE"),
        F.year("o_orderdate").cast("string").alias("OCC_YEAR"),
        F.length("o_orderpriority").cast("string").alias("OCC_HOUR"),
        F.when(located, F.lit("43.65")).otherwise(F.lit("0")).alias("LAT_WGS84"),
        F.when(located, F.lit("-79.38")).otherwise(F.lit("0")).alias("LONG_WGS84"),
        F.when(F.col("o_orderstatus") == "F", F.lit("YES")).when(F.col("o_orderstatus") == "O", F.lit(" no ")).otherwise(F.lit("Y")).alias("INJURY_COLLISIONS"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("1")).otherwise(F.lit("0")).alias("FATALITIES"),
    )


TZ_Q = "'America/Toronto'"
_COLL_SQL = f"""raw AS (
  SELECT o_orderkey AS collision_id, CAST(length(o_orderpriority) AS INTEGER) AS hour, CAST(year(o_orderdate) AS INTEGER) AS year,
         make_timestamp(epoch_ms(CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AT TIME ZONE {TZ_Q}) * 1000) AS occ_utc,
         o_orderstatus, o_orderpriority
  FROM orders
),
parsed AS (
  SELECT collision_id, year, hour,
         timezone('UTC', CAST(CAST(timezone({TZ_Q}, occ_utc AT TIME ZONE 'UTC') AS DATE) AS TIMESTAMP) AT TIME ZONE {TZ_Q})
           + to_hours(hour) AS ts_utc,
         CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false ELSE true END AS is_injury,
         CAST(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS BIGINT) AS fatalities,
         o_orderstatus <> 'P' AS located
  FROM raw
)"""


@register(
    "collisions_parse",
    O.with_ctes(
        [_COLL_SQL],
        f"""SELECT collision_id, ts_utc, timezone({TZ_Q}, ts_utc AT TIME ZONE 'UTC') AS ts_local,
       CAST(timezone({TZ_Q}, ts_utc AT TIME ZONE 'UTC') AS DATE) AS date, year, hour, is_injury, fatalities,
       43.65::DOUBLE AS lat, -79.38::DOUBLE AS lon
FROM parsed WHERE located""",
    ),
)
def q_collisions_parse(spark, sf):
    from citymotion.operators.ingest import parse_collisions

    p = parse_collisions(_collision_rows(spark, sf), years=None)
    return p.select("collision_id", "ts_utc", "ts_local", "date", "year", "hour", "is_injury", "fatalities", "lat", "lon")


# ---------------------------------------------------------------- P29 features at timestamps, P25 static widths
@register(
    "incident_day_features",
    O.with_ctes(
        [O.INC, O.CAL, O.CIVIC],
        """SELECT i.collision_id, coalesce(f.is_holiday, false) AS is_holiday, coalesce(f.is_mega_event, false) AS is_mega_event,
       coalesce(f.n_civic_events, 0) AS n_civic_events, coalesce(f.event_kinds, '') AS event_kinds
FROM inc i LEFT JOIN feat f ON CAST(i.ts_local AS DATE) = f.date""",
    ),
)
def q_incident_day_features(spark, sf):
    from citymotion.operators.calendar import features_for_dates

    inc = A.incidents(spark, sf).select("collision_id", "ts_local")
    f = features_for_dates(A.calendar_entries(spark, sf), inc, date_col="ts_local")
    return f.select("collision_id", "is_holiday", "is_mega_event", "n_civic_events", "event_kinds")


@register(
    "route_widths_static",
    O.with_ctes(
        O.PANEL_DEPS + [METRICS_CTE, "mm AS (SELECT min(value) AS lo, max(value) AS hi FROM metrics)"],
        """SELECT route_id, round(value, 6) AS value,
       round(CASE WHEN value IS NULL THEN 0.8
                  WHEN hi > lo THEN 1.2 + 4.0 * (value - lo) / (hi - lo) ELSE 1.2 END, 6) AS width
FROM metrics, mm""",
    ),
)
def q_route_widths_static(spark, sf):
    from citymotion.operators.frames import static_widths

    w = static_widths(mean_metrics(spark, sf))
    return w.select("route_id", F.round("value", 6).alias("value"), F.round("width", 6).alias("width"))


from citymotion.plans import registry_io, registry_raw  # noqa: E402, F401  register their queries
