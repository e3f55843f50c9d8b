"""Geographic features as Column expressions.

Distances to a fixed, small set of points or polyline segments are a
``least(...)`` over one expression per point / segment — no join.
"""
from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# City coordinates (lat, lon) used by the distance features.
CITIES = {
    "SC": (38.576931, -121.494949),
    "SF": (37.780080, -122.420160),
    "SJ": (37.334789, -121.888138),
    "LA": (34.052235, -118.243683),
    "SD": (32.715759, -117.163818),
}

# Coastline polyline (lat, lon) vertices.
COAST = [(32.664, -117.161), (33.206, -117.383), (33.777, -118.202), (34.463, -120.014),
         (35.427, -120.881), (35.928, -121.489), (36.982, -122.028), (37.611, -122.491),
         (38.355, -123.060), (39.792, -123.821), (40.799, -124.188), (41.755, -124.197)]

# Mean earth radius in km and feet per km of the haversine package.
EARTH_RADIUS_KM = 6371.0088
FT_PER_KM = 3280.839895013123


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def rotate(lat, lon, degrees: float) -> tuple[Column, Column]:
    """Coordinate rotation (F36): x = cos(a) lon + sin(a) lat, y = cos(a) lat + sin(a) lon."""
    a = math.radians(degrees)
    return (F.lit(math.cos(a)) * _c(lon) + F.lit(math.sin(a)) * _c(lat),
            F.lit(math.cos(a)) * _c(lat) + F.lit(math.sin(a)) * _c(lon))


def haversine(lat, lon, lat2, lon2, unit: str = "ft") -> Column:
    """Great-circle distance (F37) in feet (or km)."""
    p1, p2 = F.radians(_c(lat)), F.radians(_c(lat2) if not isinstance(lat2, (int, float)) else F.lit(lat2))
    l1, l2 = F.radians(_c(lon)), F.radians(_c(lon2) if not isinstance(lon2, (int, float)) else F.lit(lon2))
    h = F.pow(F.sin((p2 - p1) / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin((l2 - l1) / 2), 2)
    km = 2 * EARTH_RADIUS_KM * F.asin(F.sqrt(h))
    return km * FT_PER_KM if unit == "ft" else km


def city_distances(lat, lon, cities: dict = CITIES) -> dict[str, Column]:
    """Distance to each fixed city and to the nearest one."""
    d = {f"dist_{k}": haversine(lat, lon, v[0], v[1]) for k, v in cities.items()}
    d["dist_nearest_city"] = F.least(*d.values())
    return d


def _seg_dist(px: Column, py: Column, a: tuple, b: tuple) -> Column:
    ax, ay = a
    bx, by = b
    dx, dy = bx - ax, by - ay
    L2 = dx * dx + dy * dy
    t = F.least(F.greatest(((px - ax) * dx + (py - ay) * dy) / F.lit(L2), F.lit(0.0)), F.lit(1.0))
    qx, qy = F.lit(ax) + t * dx, F.lit(ay) + t * dy
    return F.sqrt((px - qx) * (px - qx) + (py - qy) * (py - qy))


def polyline_distance(x, y, points: Sequence[tuple] = COAST) -> Column:
    """Planar distance from (x, y) to a polyline (F38): the minimum over
    segments of the clamped-projection distance (shapely ``distance``)."""
    px, py = _c(x), _c(y)
    return F.least(*[_seg_dist(px, py, points[i], points[i + 1]) for i in range(len(points) - 1)])


def angular_encoding(lat, lon, emb_size: int = 20, precision: float = 1e6) -> Column:
    """Positional encoding of (lat, lon) (F39): for frequencies
    m^0..m^(n-1), m = precision^(1/n), even slots cos, odd slots sin; the
    array holds lat's n values then lon's n values."""
    m = math.exp(math.log(precision) / emb_size)
    freqs = [m ** i for i in range(emb_size)]

    def enc(v):
        return [(F.cos if i % 2 == 0 else F.sin)(_c(v) * F.lit(f)) for i, f in enumerate(freqs)]
    return F.array(*enc(lat), *enc(lon))


def centre_distances(lat, lon, centres: Sequence[tuple]) -> dict[str, Column]:
    """Haversine distance to each of a small set of centres, e.g. k-means
    centres (F40)."""
    return {f"cluster_{i}": haversine(lat, lon, c[0], c[1]) for i, c in enumerate(centres)}
