"""Nearest corridor within a radius (J8) and its QA row.

Exact result of "min over all corridors of the point-to-polyline distance,
ties to the smallest route id, keep if <= radius", computed without pairing
every point with every segment:

1. vertices (route_id, seq, lon, lat) are projected to UTM metres; segments are
   formed by an equi-join on ``seq + 1`` (no per-route window, so a route with
   a huge number of vertices is still spread over tasks).  A route's last
   vertex also yields a zero-length segment, which is how a one-vertex
   route becomes a point and changes nothing for longer routes.
2. the plane is cut into square cells of twice the radius; a segment is listed under every cell
   that it touches, each once, two or three for a segment of a cell's length.
3. a place (distinct coordinates) is listed under the at most 2 x 2 cells that its square of the
   radius touches: a segment within the radius has a point in that square, hence is listed under
   one of these cells.
4. where many places meet many segments, cells are quartered in both directions, up to four
   times.  A cell that a segment touches bounds the least distance of all places in another cell
   from above by the farthest corners; cells whose nearest corners are farther than the best
   bound are left out with their segments.  This is done on cells with their counts, whose
   number is bounded by area and not by density; only segments near the bound are listed finer.
5. candidates come from an equi-join on the cell that is left, and the distance is computed to
   the *whole* segment, so it is bit-identical to a brute-force evaluation.
6. per place, the least distance is a plain minimum of doubles (summed up on the map side by
   hash, so candidates are neither written nor sorted); a second pass of the join keeps
   the segments at that distance and takes the smallest route id (tie-break; a segment at the
   least distance has its nearest point in a cell that is kept).  The result is
   joined back on the coordinates, so points may share an id or have none, and a place with
   very many points is searched once.

Counts are measured at each level: a side of a join is broadcast when its count proves it
small, else the join is a merge join, and AQE's skew-join split handles a crowded cell.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citymotion.functions.geo import segment_distance, utm_columns
from citymotion.session import broadcast_if_bounded, cut_lineage

DEFAULT_MAX_DISTANCE_M = 150.0
CELL_RADII = 2  # a cell's side in radii; a place's square then touches 2 x 2 cells at most
EDGE = 1e-3  # metres added to a segment's or place's reach, for rounding
LEVELS = 4  # how often crowded cells may be quartered
CROWDED = 16  # pairs of a place and a segment, for each listed segment, that are compared without quartering
DEARER = 2  # pairs that one pair of quartered cells has to save


def project(df: DataFrame, lon: str = "lon", lat: str = "lat", x: str = "x", y: str = "y") -> DataFrame:
    e, n = utm_columns(lon, lat)
    return df.withColumns({x: e, y: n})


def segments(vertices: DataFrame) -> DataFrame:
    """route_id, seg (= seq of the first vertex), ax, ay, bx, by in metres."""
    v = project(vertices.where(F.col("lon").isNotNull() & F.col("lat").isNotNull()))
    a = v.select("route_id", "seq", F.col("x").alias("ax"), F.col("y").alias("ay"))
    b = v.select(
        F.col("route_id").alias("_r"), (F.col("seq") - 1).alias("_s"), F.col("x").alias("bx"), F.col("y").alias("by")
    )
    j = a.join(b, (a.route_id == b._r) & (a.seq == b._s), "left")
    return j.select(
        "route_id",
        F.col("seq").alias("seg"),
        "ax",
        "ay",
        F.coalesce("bx", "ax").alias("bx"),
        F.coalesce("by", "ay").alias("by"),
    )


def segment_cells(segs: DataFrame, cell: float, within: tuple[F.Column, F.Column, F.Column, F.Column] | None = None) -> DataFrame:
    """(route_id, seg, geometry, cx, cy) for every cell that a segment may lie in, each once:
    the cells of its columns, a millimetre added for rounding.  ``within`` are the first and
    last column and row that are wanted."""

    def ranged(of: DataFrame, low: F.Column, high: F.Column, limits: tuple, to: str) -> DataFrame:
        low, high = F.floor((low - EDGE) / cell), F.floor((high + EDGE) / cell)
        if limits:
            low, high = F.greatest(low, limits[0]), F.least(high, limits[1])
        return of.withColumns({"_low": low, "_high": high}).where("_low <= _high").withColumn(to, F.explode(F.sequence("_low", "_high")))

    ax, ay, bx, by = (F.col(c) for c in ("ax", "ay", "bx", "by"))
    s = ranged(segs, F.least(ax, bx), F.greatest(ax, bx), within and within[:2], "_x")
    run = F.when(F.abs(bx - ax) < 1e-9, F.lit(1e-9)).otherwise(bx - ax)
    enter, leave = ((F.col("_x") * cell - 2 * EDGE - ax) / run, ((F.col("_x") + 1) * cell + 2 * EDGE - ax) / run)
    at = [ay + F.least(F.greatest(t, F.lit(0.0)), F.lit(1.0)) * (by - ay) for t in (enter, leave)]
    s = ranged(s, F.least(*at), F.greatest(*at), within and within[2:], "_y")
    return s.select("route_id", "seg", "ax", "ay", "bx", "by", F.col("_x").alias("cx"), F.col("_y").alias("cy"))


def place_cells(places: DataFrame, radius: float, cell: float) -> DataFrame:
    """Each place under the cells that may hold something within ``radius`` of it."""
    reach = radius + EDGE
    cx, cy = (F.sequence(F.floor((F.col(c) - reach) / cell), F.floor((F.col(c) + reach) / cell)) for c in ("_px", "_py"))
    return places.withColumn("cx", F.explode(cx)).withColumn("cy", F.explode(cy))


def nearest_routes(
    points: DataFrame,
    vertices: DataFrame,
    *,
    max_distance_m: float = DEFAULT_MAX_DISTANCE_M,
) -> DataFrame:
    """Every located point with ``route_id`` / ``dist_to_route_m`` of its nearest corridor
    within the radius, NULL when none.  Rows are matched by their coordinates alone."""
    located = points.where(F.col("lat").isNotNull() & F.col("lon").isNotNull())
    places = located.select(F.col("lon").alias("_lon"), F.col("lat").alias("_lat")).distinct()
    places = cut_lineage(project(places, "_lon", "_lat", x="_px", y="_py"))
    segs = cut_lineage(segments(vertices))  # projected and self-joined once
    best = cut_lineage(_within(places, segs, float(max_distance_m)))
    same = (located["lon"] == best["_lon"]) & (located["lat"] == best["_lat"])
    return located.join(best, same, "left").drop("_lon", "_lat")


def _home(places: DataFrame, cell: float) -> DataFrame:
    """Each place with the cell (hx, hy) that it lies in."""
    return places.withColumns({"hx": F.floor(F.col("_px") / cell), "hy": F.floor(F.col("_py") / cell)})


def _met(rows: DataFrame, side: DataFrame, n: int, on: list[str], how: str = "inner") -> DataFrame:
    """``rows`` joined with the ``n`` rows of ``side``: broadcast if that is proven small, else by a
    merge join (the planner's sizes leave out what explode adds)."""
    small = broadcast_if_bounded(side, n, row_bytes=64)
    return rows.join(small if small is not side else side.hint("merge"), on, how)


def _searched(places: DataFrame, segs: DataFrame, radius: float) -> tuple[DataFrame, DataFrame, float]:
    """Which cells to search: (hx, hy, cx, cy, n_places, n_segments) per cell of places and cell
    of segments that may hold what is nearest to one of the places; the segments listed under the
    latter; the side of the cells.

    Crowded cells are quartered in both directions, level by level.  A cell that a segment
    crosses is an upper bound for all places of a cell (its farthest corners), so cells that are
    farther at their nearest corners are left out, and so are their segments at all finer levels."""
    cell = CELL_RADII * radius
    near = _home(place_cells(places, radius, cell), cell).groupBy("hx", "hy", "cx", "cy").agg(F.count(F.lit(1)).alias("n_places"))
    ends = near.agg(F.min("cx"), F.max("cx"), F.min("cy"), F.max("cy")).first()
    listed = segment_cells(segs, cell, tuple(F.lit(0 if e is None else e).cast("long") for e in ends))
    n_segs = segs.count()
    for level in range(LEVELS + 1):
        crossed = cut_lineage(listed.groupBy("cx", "cy").agg(F.count(F.lit(1)).alias("n_segments")))
        n_crossed = crossed.count()
        if not level:
            kept = cut_lineage(_met(near, crossed, n_crossed, ["cx", "cy"]).withColumn("_bound", F.lit(radius)))
        else:
            up = lambda c: F.shiftright(c, 2).alias(f"_{c}")
            homes = _home(places, cell).groupBy("hx", "hy").agg(F.count(F.lit(1)).alias("n_places"))
            homes = cut_lineage(homes.select("*", up("hx"), up("hy")))
            pairs = kept.select(*[F.col(c).alias(f"_{c}") for c in ("hx", "hy", "cx", "cy")], "_bound")
            pairs = _met(_met(pairs, homes, homes.count(), ["_hx", "_hy"]), crossed.select("*", up("cx"), up("cy")), n_crossed, ["_cx", "_cy"])
            apart = [F.abs(F.col(a) - F.col(b)) for a, b in (("hx", "cx"), ("hy", "cy"))]
            least, most = ((F.sqrt(x * x + y * y) * cell) for x, y in ([F.greatest(d - 1, F.lit(0)).cast("double") for d in apart], [(d + 1).cast("double") for d in apart]))
            pairs = pairs.withColumn("_least", least - 4 * EDGE).where("_least <= _bound").withColumn("_most", most + 4 * EDGE)
            pairs = cut_lineage(pairs.select("hx", "hy", "cx", "cy", "n_places", "n_segments", "_least", "_most", "_bound"))
            bounds = pairs.groupBy("hx", "hy").agg(F.least(F.min("_most"), F.min("_bound")).alias("_bound"))
            kept = cut_lineage(pairs.drop("_bound").join(bounds.hint("merge"), ["hx", "hy"]).where("_least <= _bound").drop("_least", "_most"))
        cells = cut_lineage(kept.groupBy("cx", "cy").agg(F.first("n_segments").alias("n_segments")))
        n_cells, n_listed = cells.agg(F.count(F.lit(1)), F.coalesce(F.sum("n_segments"), F.lit(0))).first()
        listed = _met(listed, cells.select("cx", "cy"), n_cells, ["cx", "cy"], "left_semi")
        finer = F.least("n_places", F.lit(16)) * F.least(4 * F.col("n_segments"), F.lit(16))
        work, cost = kept.agg(*[F.coalesce(F.sum(c.cast("double")), F.lit(0.0)) for c in (F.col("n_places") * F.col("n_segments"), finer)]).first()
        if level == LEVELS or work <= max(CROWDED * n_listed, DEARER * cost):
            return kept, listed, cell
        if n_listed <= n_segs:
            listed = cut_lineage(listed)
        cell /= 4
        listed = segment_cells(listed, cell, tuple(4 * F.col(c) + i for c in ("cx", "cy") for i in (0, 3)))
    raise AssertionError("unreachable")


def _within(places: DataFrame, segs: DataFrame, radius: float) -> DataFrame:
    """The nearest corridor of each place that has one within ``radius``."""
    kept, listed, cell = _searched(places, segs, radius)
    n = kept.agg(F.coalesce(F.sum("n_places"), F.lit(0))).first()[0]
    distance = segment_distance("_px", "_py", "ax", "ay", "bx", "by")
    listed = cut_lineage(listed)

    def candidates(of: DataFrame) -> DataFrame:
        """(place, segment) pairs of searched cells; a pair may come from several."""
        sought = _home(of, cell).join(kept.select("hx", "hy", "cx", "cy").hint("merge"), ["hx", "hy"]).drop("hx", "hy")
        return _met(listed, sought, n, ["cx", "cy"]).withColumn("_d", distance)

    near = candidates(places).where(F.col("_d") <= F.lit(radius))
    least = cut_lineage(near.groupBy("_lon", "_lat", "_px", "_py").agg(F.min("_d").alias("_least")))
    at = candidates(least).where(F.col("_d") == F.col("_least"))
    first = F.when(~F.bool_or(F.col("route_id").isNull()), F.min("route_id"))  # NULL comes before all ids
    best = at.groupBy("_lon", "_lat").agg(first.alias("route_id"), F.min("_d").alias("dist_to_route_m"))
    return best.select("_lon", "_lat", "route_id", "dist_to_route_m")


def snap_to_routes(
    points: DataFrame,
    vertices: DataFrame,
    *,
    max_distance_m: float = DEFAULT_MAX_DISTANCE_M,
) -> DataFrame:
    """Matched points only (unlocated and far points dropped), as the source keeps them."""
    return nearest_routes(points, vertices, max_distance_m=max_distance_m).where(
        F.col("route_id").isNotNull()
    )


def snap_qa(snapped_all: DataFrame, max_distance_m: float = DEFAULT_MAX_DISTANCE_M) -> DataFrame:
    """One QA row (A9) from :func:`nearest_routes` output: located, matched, discarded,
    rate, matched routes, p50/p90 of the matched distance (linear interpolation)."""
    from citymotion.operators.quantiles import exact_quantiles

    matched = F.col("route_id").isNotNull()
    counts = snapped_all.agg(
        F.count(F.lit(1)).alias("n_with_coords"),
        F.count_if(matched).alias("n_route_matched"),
        F.count_distinct("route_id").alias("n_routes_matched"),
    ).withColumn("_g", F.lit(0))
    dist = exact_quantiles(snapped_all, [], "dist_to_route_m", [0.5, 0.9], names=["p50", "p90"]).withColumn("_g", F.lit(0))
    q = counts.join(dist, "_g", "left")  # two one-row aggregates
    return q.select(
        "n_with_coords",
        "n_route_matched",
        (F.col("n_with_coords") - F.col("n_route_matched")).alias("n_discarded_far_from_network"),
        F.round(
            F.when(F.col("n_with_coords") > 0, F.col("n_route_matched") / F.col("n_with_coords")).otherwise(0.0), 6
        ).alias("match_rate"),
        "n_routes_matched",
        F.lit(float(max_distance_m)).alias("max_distance_m"),
        F.round("p50", 3).alias("dist_to_route_m_p50"),
        F.round("p90", 3).alias("dist_to_route_m_p90"),
    )
