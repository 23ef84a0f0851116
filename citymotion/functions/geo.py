"""Planar geometry as SQL expressions (no UDF).

* WGS84 lon/lat -> UTM zone 17N metres with the Krüger series
  (transverse Mercator, 3 terms; millimetre-level inside the zone).
* exact point-to-segment distance with the segment parameter clipped to
  [0, 1] and a zero-length guard.

Expressions are emitted as SQL text built only from functions Spark SQL and
DuckDB share, so the Spark operator and its DuckDB oracle run the very same
arithmetic.  ``F.expr`` turns them into Columns.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: WGS84 ellipsoid and UTM zone 17N parameters
WGS84_A = 6378137.0
WGS84_F = 1.0 / 298.257223563
UTM17_LON0_DEG = -81.0
UTM_K0 = 0.9996
UTM_FALSE_EASTING = 500000.0
UTM_FALSE_NORTHING = 0.0
# zero-length segment guard used in the distance (squared metres)
SEGMENT_EPS2 = 1e-12


def _series_constants() -> tuple[float, float, tuple[float, float, float]]:
    n = WGS84_F / (2.0 - WGS84_F)
    big_a = WGS84_A / (1.0 + n) * (1.0 + n**2 / 4.0 + n**4 / 64.0)
    alpha = (
        n / 2.0 - 2.0 * n**2 / 3.0 + 5.0 * n**3 / 16.0,
        13.0 * n**2 / 48.0 - 3.0 * n**3 / 5.0,
        61.0 * n**3 / 240.0,
    )
    return n, big_a, alpha


def utm_sql(lon: str, lat: str) -> tuple[str, str]:
    """SQL text for (easting, northing) in metres of a lon/lat pair (degrees)."""
    n, big_a, alpha = _series_constants()
    c = 2.0 * math.sqrt(n) / (1.0 + n)
    phi = f"radians({lat})"
    dlam = f"(radians({lon}) - ({math.radians(UTM17_LON0_DEG)!r}))"
    t = f"sinh(atanh(sin({phi})) - {c!r} * atanh({c!r} * sin({phi})))"
    xi = f"atan({t} / cos({dlam}))"
    eta = f"atanh(sin({dlam}) / sqrt(1.0 + ({t}) * ({t})))"
    e_terms = " + ".join(
        f"{a!r} * cos({2 * j} * {xi}) * sinh({2 * j} * {eta})" for j, a in enumerate(alpha, start=1)
    )
    n_terms = " + ".join(
        f"{a!r} * sin({2 * j} * {xi}) * cosh({2 * j} * {eta})" for j, a in enumerate(alpha, start=1)
    )
    k = UTM_K0 * big_a
    easting = f"({UTM_FALSE_EASTING!r} + {k!r} * ({eta} + {e_terms}))"
    northing = f"({UTM_FALSE_NORTHING!r} + {k!r} * ({xi} + {n_terms}))"
    return easting, northing


def utm_columns(lon: str, lat: str) -> tuple[Column, Column]:
    e, n = utm_sql(lon, lat)
    return F.expr(e), F.expr(n)


def segment_distance_sql(px: str, py: str, ax: str, ay: str, bx: str, by: str) -> str:
    """SQL text: distance from (px,py) to segment a-b (same planar units)."""
    abx = f"({bx} - {ax})"
    aby = f"({by} - {ay})"
    ab2 = f"greatest({abx} * {abx} + {aby} * {aby}, {SEGMENT_EPS2!r})"
    t = f"least(greatest((({px} - {ax}) * {abx} + ({py} - {ay}) * {aby}) / {ab2}, 0.0), 1.0)"
    dx = f"({px} - ({ax} + {t} * {abx}))"
    dy = f"({py} - ({ay} + {t} * {aby}))"
    return f"sqrt({dx} * {dx} + {dy} * {dy})"


def segment_distance(px: str, py: str, ax: str, ay: str, bx: str, by: str) -> Column:
    return F.expr(segment_distance_sql(px, py, ax, ay, bx, by))
