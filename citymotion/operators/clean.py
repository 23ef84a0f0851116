"""Panel cleaning: v1 column drop (P20, P21, A10), modelling clean-up
(W2, P26-P28) and the null-rate profile (A15)."""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citymotion.operators.normalize import keep_last_sparse

# fixed values: columns removed for the v1 training panel
DROP_COLUMNS_EXACT = frozenset(
    {"wx_visibility_km", "wx_weather_desc", "wx_wind_chill", "wx_humidex", "holiday_names", "mega_event_names"}
)
DROP_COLUMN_PREFIXES = ("wx_wind_",)
# fixed values: flags filled with False before modelling
BOOL_COLS = (
    "is_public_holiday",
    "is_civic_holiday",
    "is_holiday",
    "is_school_break",
    "is_mega_event",
    "is_parade",
    "is_shopping_peak",
    "is_weekend",
)


def columns_to_drop(columns: Iterable[str]) -> list[str]:
    return [c for c in columns if c in DROP_COLUMNS_EXACT or any(c.startswith(p) for p in DROP_COLUMN_PREFIXES)]


def ensure_calendar_fields(panel: DataFrame) -> DataFrame:
    """Re-derive ``dow`` (Mon=0) and ``is_weekend`` from ``ts_local``."""
    if "ts_local" not in panel.columns:
        raise KeyError("weekday fields come from ts_local, which this table lacks")
    return panel.withColumns(
        {"dow": F.weekday("ts_local").cast("long"), "is_weekend": F.weekday("ts_local").isin(5, 6)}
    )


def clean_panel_v1(panel: DataFrame) -> DataFrame:
    """v1 panel: calendar fields re-derived, sparse weather and free-text names dropped (P20)."""
    fixed = ensure_calendar_fields(panel)
    return fixed.drop(*columns_to_drop(fixed.columns))


def v1_qa(panel: DataFrame) -> DataFrame:
    """One QA row for the v1 clean-up (A10); column lists are ``|``-joined."""
    fixed = ensure_calendar_fields(panel)
    dropped = columns_to_drop(fixed.columns)
    retained = [c for c in fixed.columns if c not in dropped]
    ids_rate = (
        F.avg((F.length(F.coalesce(F.col("event_ids").cast("string"), F.lit(""))) > 0).cast("double"))
        if "event_ids" in retained
        else F.lit(0.0)
    )
    return fixed.agg(
        F.count(F.lit(1)).alias("source_rows"),
        F.count(F.lit(1)).alias("output_rows"),
        F.lit(len(fixed.columns)).cast("long").alias("n_cols_before"),
        F.lit(len(retained)).cast("long").alias("n_cols_after"),
        F.lit("|".join(dropped)).alias("dropped_columns"),
        F.lit("|".join(retained)).alias("retained_columns"),
        F.round(F.coalesce(F.avg(F.col("is_weekend").cast("double")), F.lit(0.0)), 6).alias("is_weekend_rate"),
        F.round(F.coalesce(ids_rate, F.lit(0.0)), 6).alias("event_ids_nonempty_rate"),
    )


def dedupe_last(panel: DataFrame, keys: Sequence[str] = ("ts_local", "route_id"), order: Sequence[str] = ("src_pos",)) -> DataFrame:
    """One row per (ts_local, route_id): the last by ingest order.

    The panel is wide and duplicates are rare, so only the keys are shuffled to
    find duplicated ones (:func:`keep_last_sparse`)."""
    return keep_last_sparse(panel, list(keys), list(order))


def clean_panel(panel: DataFrame, *, min_sample_count: float = 0, order: Sequence[str] = ("src_pos",)) -> DataFrame:
    """Modelling-ready panel (notebook clean step).

    keep-last dedup on (ts_local, route_id); hour / dow / is_weekend re-derived;
    cyclical encodings; flags NULL -> False; observation masks
    ``obs_travel`` (travel and delay present, sample_count >= minimum, NULL count as 0)
    and ``obs_weather`` (temperature present).  Precipitation stays NULL when missing.
    Ordering by (ts_local, route_id) is left to the sink (``sortWithinPartitions``).
    """
    d = dedupe_last(panel, order=order)
    hour = F.hour("ts_local")
    dow = F.weekday("ts_local")
    cols = {
        "hour": hour.cast("long"),
        "dow": dow.cast("long"),
        "is_weekend": dow.isin(5, 6),
        "hour_sin": F.sin(F.lit(2 * math.pi) * hour / 24.0),
        "hour_cos": F.cos(F.lit(2 * math.pi) * hour / 24.0),
        "dow_sin": F.sin(F.lit(2 * math.pi) * dow / 7.0),
        "dow_cos": F.cos(F.lit(2 * math.pi) * dow / 7.0),
    }
    d = d.withColumns(cols)
    d = d.withColumns({c: F.coalesce(F.col(c), F.lit(False)) for c in BOOL_COLS if c in d.columns})
    sample = F.coalesce(F.col("sample_count"), F.lit(0.0)) if "sample_count" in d.columns else F.lit(0.0)
    return d.withColumns(
        {
            "obs_travel": F.col("travel_time_s").isNotNull() & F.col("delay_s").isNotNull() & (sample >= F.lit(float(min_sample_count))),
            "obs_weather": F.col("wx_temp_c").isNotNull(),
            "wx_precip_mm": F.col("wx_precip_mm").try_cast("double"),
        }
    )


def clean_qa(panel: DataFrame, cleaned: DataFrame) -> DataFrame:
    """Rows before / after the dedup and the two observation rates."""
    before = panel.agg(F.count(F.lit(1)).alias("rows_before"))
    after = cleaned.agg(
        F.count(F.lit(1)).alias("rows_after"),
        F.round(F.avg(F.col("obs_travel").cast("double")), 6).alias("obs_travel_rate"),
        F.round(F.avg(F.col("obs_weather").cast("double")), 6).alias("obs_weather_rate"),
    )
    b = before.first().rows_before
    return after.select(
        F.lit(b).cast("long").alias("rows_before"),
        "rows_after",
        (F.lit(b) - F.col("rows_after")).cast("long").alias("n_dupes_dropped"),
        "obs_travel_rate",
        "obs_weather_rate",
    )


def null_profile(panel: DataFrame, top: int | None = 12) -> DataFrame:
    """Null rate per column, highest first (ties by name), optionally top-n."""
    cols = panel.columns
    rates = panel.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in cols])
    stacked = rates.unpivot([], cols, "column_name", "null_rate")
    out = stacked.select("column_name", F.round("null_rate", 6).alias("null_rate")).orderBy(F.desc("null_rate"), "column_name")
    return out.limit(top) if top else out
