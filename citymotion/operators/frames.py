"""Congestion over time for animated maps: period filter (P23), bucket mean
(A4) with labels (P24), pivot (A5), robust bounds (A6) and scaling (P25)."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citymotion.functions.timez import bucket_start, utc_to_local
from citymotion.operators.normalize import nan_to_null

LABEL_FORMAT = "yyyy-MM-dd HH:mm"
DEFAULT_MAX_FRAMES = 500


def as_day(value: str | date | datetime) -> date:
    """The calendar day of a date, a datetime or ISO text of either."""
    if isinstance(value, str):
        value = datetime.fromisoformat(value.strip())
    return value.date() if isinstance(value, datetime) else value


def period(panel: DataFrame, start=None, end=None) -> DataFrame:
    """Rows whose local date lies in ``[start, end]`` (inclusive).  ``None`` = open bound.

    The predicate is on the ``date`` column, so it reaches the Parquet scan
    (and prunes partitions when the panel is partitioned by date or year).
    """
    d = F.col("date") if "date" in panel.columns else F.to_date("ts_local")
    lo = as_day(start) if start is not None else None
    hi = as_day(end) if end is not None else None
    if lo is not None and hi is not None and hi < lo:
        raise ValueError(f"end date {hi} is before start date {lo}")
    out = panel
    if lo is not None:
        out = out.where(d >= F.lit(lo))
    if hi is not None:
        out = out.where(d <= F.lit(hi))
    return out


def congestion_buckets(
    panel: DataFrame,
    *,
    start=None,
    end=None,
    freq: str = "h",
    metric: str = "delay_s",
    max_frames: int | None = None,
) -> DataFrame:
    """Mean ``metric`` per (time bucket, route), long form (A4).

    Buckets are floored on the UTC instant, so the autumn hour that occurs
    twice locally gives two buckets (the source raises there); ``label`` is the
    local wall-clock start.  Buckets whose values are all NULL are kept.
    ``max_frames`` (optional) fails the job when more buckets are present.
    """
    cols = ["route_id", "ts_utc", metric]
    missing = [c for c in cols if c not in panel.columns]
    if missing:
        raise KeyError(f"buckets need the columns {missing}")
    selected = period(panel, start, end)
    if (start is not None or end is not None) and selected.limit(1).count() == 0:
        raise ValueError("the period from start to end holds no rows")
    p = selected.select(
        "route_id", bucket_start("ts_utc", freq).alias("bucket_utc"), F.nanvl(F.col(metric).cast("double"), F.lit(None).cast("double")).alias("_v")
    )
    out = p.groupBy("bucket_utc", "route_id").agg(F.avg("_v").alias("value"))
    out = out.withColumn("label", F.date_format(utc_to_local("bucket_utc"), LABEL_FORMAT))
    if max_frames is not None:
        n = out.select("bucket_utc").distinct().count()
        if n == 0:
            raise ValueError("the period from start to end holds no rows")
        if n > max_frames:
            raise ValueError(f"{n} buckets, but max_frames allows {max_frames}: take wider buckets or fewer days")
    return out.select("bucket_utc", "label", "route_id", "value")


def frame_labels(buckets: DataFrame) -> DataFrame:
    """The distinct buckets and their labels in time order (O3), as a table."""
    return buckets.select("bucket_utc", "label").distinct().orderBy("bucket_utc")


PIVOT_HOURS = tuple(range(24))


def congestion_pivot(buckets: DataFrame) -> DataFrame:
    """Hourly route x time matrix (A5), one row per (route, UTC date) with the 24 hours of
    that date as columns ``h00`` .. ``h23``.  Columns are UTC hours, so the local hour
    that occurs twice in autumn has two cells; their number doesn't depend on the period."""
    hour = F.hour("bucket_utc")
    cells = [F.max(F.when(hour == h, F.col("value"))).alias(f"h{h:02d}") for h in PIVOT_HOURS]
    return buckets.groupBy("route_id", F.to_date("bucket_utc").alias("date_utc")).agg(*cells)


def robust_bounds(values: DataFrame, value: str = "value", lo_q: float = 0.05, hi_q: float = 0.95) -> DataFrame:
    """One row ``(vmin, vmax)``: p5 / p95 of finite values, widened by 1 if flat."""
    v = nan_to_null(values.select(F.col(value).cast("double").alias("v")), ["v"])
    v = v.where(F.col("v").isNotNull() & (F.abs("v") != float("inf")))
    from citymotion.operators.quantiles import exact_quantiles

    b = exact_quantiles(v, [], "v", [lo_q, hi_q], names=["vmin", "vmax"])
    return b.select("vmin", F.when(F.col("vmax") <= F.col("vmin"), F.col("vmin") + 1.0).otherwise(F.col("vmax")).alias("vmax"))


def scale_intensity(values: DataFrame, vmin: float, vmax: float, value: str = "value") -> DataFrame:
    """``t = clip((v - vmin)/(vmax - vmin), 0, 1)``, line width ``1.5 + 5 t``; non-finite -> 1.5 (P25)."""
    v = F.col(value)
    finite = v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))
    usable = finite & F.lit(vmax > vmin)
    t = F.least(F.greatest((v - F.lit(vmin)) / F.lit(vmax - vmin if vmax != vmin else 1.0), F.lit(0.0)), F.lit(1.0))
    return values.withColumns(
        {
            "t": F.when(usable, t),
            "width": F.when(usable, F.lit(1.5) + F.lit(5.0) * t).otherwise(F.lit(1.5)),
        }
    )


def static_widths(metrics: DataFrame, value: str = "value") -> DataFrame:
    """Static map variant: min-max scaling, width ``1.2 + 4 t``, NULL value -> 0.8 (P25)."""
    w = metrics.agg(F.min(value).alias("lo"), F.max(value).alias("hi")).first()
    lo, hi = w.lo, w.hi
    v = F.col(value)
    if lo is None or hi is None or hi <= lo:
        t = F.lit(0.0)
    else:
        t = (v - F.lit(lo)) / F.lit(hi - lo)
    return metrics.withColumn("width", F.when(v.isNull(), F.lit(0.8)).otherwise(F.lit(1.2) + F.lit(4.0) * t))


def intensity_frames(buckets: DataFrame, vertices: DataFrame) -> DataFrame:
    """Animated-map data (J10 + A6 + P25): buckets of routes that have geometry,
    scaled by the p5/p95 bounds of their finite values.  Raises when no route
    has both values and geometry, or no finite value exists."""
    from citymotion.operators.network import routes_with_geometry

    shown = routes_with_geometry(buckets, vertices)
    if shown.limit(1).count() == 0:
        raise ValueError("no route has a value as well as a geometry")
    b = robust_bounds(shown).first()
    if b is None or b.vmin is None:
        raise ValueError("all values are missing or not finite")
    return scale_intensity(shown, b.vmin, b.vmax)
