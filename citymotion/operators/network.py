"""Corridor network data: id split (P22), per-route metrics (A3), graph edges
with geometry (J9), node positions (A13) and map centre (A14)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def split_route_id(route_id: str | Column = "route_id") -> tuple[Column, Column]:
    """``SOURCE_TARGET`` -> (source, target); anything else raises at run time."""
    rid = F.col(route_id) if isinstance(route_id, str) else route_id
    parts = F.split(rid, "_", -1)
    ok = (F.size(parts) == 2) & (F.get(parts, 0) != "") & (F.get(parts, 1) != "")
    bad = F.raise_error(F.concat(F.lit("Expected SOURCE_TARGET route_id, got "), F.coalesce(rid, F.lit("NULL"))))
    return (
        F.when(ok, F.get(parts, 0)).otherwise(bad.cast("string")),
        F.when(ok, F.get(parts, 1)).otherwise(bad.cast("string")),
    )


QUANTILE_AGGS = {"median": 0.5, "p95": 0.95}


def _agg_expr(metric: str, agg: str, order: str) -> Column:
    """``first`` and ``last`` follow ``order`` (ingest position); a sum of no values is 0."""
    v = F.col(metric)
    if agg in ("first", "last"):
        return (F.min_by if agg == "first" else F.max_by)(v, F.when(v.isNotNull(), F.col(order)))
    table = {
        "mean": F.avg(v),
        "min": F.min(v),
        "max": F.max(v),
        "sum": F.coalesce(F.sum(v), F.lit(0.0)),
        "std": F.stddev_samp(v),
        "var": F.var_samp(v),
        "count": F.count(v),
        "size": F.count(F.lit(1)),
        "nunique": F.count_distinct(v),
    }
    try:
        return table[agg]
    except KeyError as exc:
        raise ValueError(f"unsupported agg {agg!r}; choose from {sorted([*table, 'first', 'last', *QUANTILE_AGGS])}") from exc


def aggregate_route_metrics(panel: DataFrame, *, metric: str = "delay_s", agg: str = "mean", order: str = "src_pos") -> DataFrame:
    """One value per route plus its source / target nodes (A3).

    NULL metric values are skipped (pandas semantics); ``median`` / ``p95``
    interpolate linearly like pandas and are exact, computed with bounded
    per-route memory (:func:`citymotion.operators.quantiles.exact_quantiles`).
    """
    if "route_id" not in panel.columns:
        raise KeyError("route metrics group by route_id, which this table lacks")
    if metric not in panel.columns:
        raise KeyError(f"there is no column {metric!r} to aggregate")
    if agg in QUANTILE_AGGS:
        from citymotion.operators.quantiles import exact_quantiles

        m = exact_quantiles(panel, ["route_id"], metric, [QUANTILE_AGGS[agg]], names=["value"])
    else:
        m = panel.groupBy("route_id").agg(_agg_expr(metric, agg, order).alias("value"))
    src, dst = split_route_id("route_id")
    return m.select("route_id", src.alias("source"), dst.alias("target"), F.col("value").cast("double").alias("value"))


def route_endpoints(vertices: DataFrame) -> DataFrame:
    """First and last vertex of every polyline (by ``seq``)."""
    return vertices.groupBy("route_id").agg(
        F.min_by(F.struct("lon", "lat"), "seq").alias("first_pt"),
        F.max_by(F.struct("lon", "lat"), "seq").alias("last_pt"),
        F.count(F.lit(1)).alias("n_points"),
    )


def edge_points(metrics: DataFrame, vertices: DataFrame) -> DataFrame:
    """Route metrics with their polyline in long form (J9): a row per vertex, one with NULLs
    for a route without geometry.  No route is gathered into one row or task."""
    return metrics.join(vertices.select("route_id", "seq", "lon", "lat"), "route_id", "left")


def edge_ends(metrics: DataFrame, vertices: DataFrame) -> DataFrame:
    """Route metrics with number of vertices, first and last point of their polyline."""
    return metrics.join(route_endpoints(vertices), "route_id", "left")


def graph_nodes(metrics: DataFrame, vertices: DataFrame) -> DataFrame:
    """Node position = mean of the first points of its outgoing routes and the
    last points of its incoming routes (A13); only routes with geometry count."""
    ends = metrics.select("route_id", "source", "target").join(route_endpoints(vertices), "route_id", "inner")
    samples = ends.select(F.col("source").alias("node"), F.col("first_pt.lon").alias("lon"), F.col("first_pt.lat").alias("lat")).unionByName(
        ends.select(F.col("target").alias("node"), F.col("last_pt.lon").alias("lon"), F.col("last_pt.lat").alias("lat"))
    )
    return samples.groupBy("node").agg(F.avg("lon").alias("lon"), F.avg("lat").alias("lat"), F.count(F.lit(1)).alias("n_samples"))


def routes_with_geometry(values: DataFrame, vertices: DataFrame) -> DataFrame:
    """Keep only routes that have both values and geometry (J10, a semi join)."""
    return values.join(vertices.select("route_id"), "route_id", "left_semi")


def map_centre(values: DataFrame, vertices: DataFrame) -> DataFrame:
    """Mean lon / lat over all vertices of the routes shown."""
    shown = vertices.join(values.select("route_id"), "route_id", "left_semi")
    return shown.agg(F.avg("lon").alias("centre_lon"), F.avg("lat").alias("centre_lat"), F.count(F.lit(1)).alias("n_vertices"))
