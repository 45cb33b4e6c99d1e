"""Planar geometry on (longitude, latitude) degrees as column expressions.

A boundary is an array of edges ``struct<x1,y1,x2,y2>``. Holes and parts need
no special care: the even-odd rule counts crossings over all edges. Points
exactly on an edge may fall on either side.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0088


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def wkt_edges(wkt: Column | str) -> Column:
    """Edges of a POLYGON or MULTIPOLYGON text."""
    rings = F.regexp_extract_all(_col(wkt), F.lit(r"\(([^()]+)\)"), 1)

    def point(text: Column) -> Column:
        pair = F.split(F.trim(text), r"\s+")
        return F.struct(F.get(pair, F.lit(0)).try_cast("double").alias("x"), F.get(pair, F.lit(1)).try_cast("double").alias("y"))

    def ring_edges(ring: Column) -> Column:
        points = F.transform(F.split(ring, ","), point)
        count = F.greatest(F.size(points) - 1, F.lit(0))
        return F.zip_with(
            F.slice(points, F.lit(1), count),
            F.slice(points, F.lit(2), count),
            lambda a, b: F.struct(a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2")),
        )

    return F.flatten(F.transform(rings, ring_edges))


def ray_hits(edge: Column, lon: Column, lat: Column) -> Column:
    """Whether the ray from the point towards +x crosses the edge."""
    spans = (edge["y1"] > lat) != (edge["y2"] > lat)
    at = (edge["x2"] - edge["x1"]) * (lat - edge["y1"]) / (edge["y2"] - edge["y1"]) + edge["x1"]
    return spans & (lon < at)


def inside(edges: Column, lon: Column, lat: Column) -> Column:
    return F.size(F.filter(edges, lambda e: ray_hits(e, lon, lat))) % 2 == 1


def planar_distance(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Distance in degrees."""
    return F.sqrt((x1 - x2) * (x1 - x2) + (y1 - y2) * (y1 - y2))


def segment_distance(edge: Column, x: Column, y: Column) -> Column:
    """Distance in degrees from a point to an edge."""
    dx, dy = edge["x2"] - edge["x1"], edge["y2"] - edge["y1"]
    length = dx * dx + dy * dy
    along = F.when(length == 0, F.lit(0.0)).otherwise(
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((x - edge["x1"]) * dx + (y - edge["y1"]) * dy) / length))
    )
    return planar_distance(x, y, edge["x1"] + along * dx, edge["y1"] + along * dy)


def touches_disc(edges: Column, lon: Column, lat: Column, radius: float) -> Column:
    """Whether a disc around the point meets the polygon."""
    return inside(edges, lon, lat) | F.exists(edges, lambda e: segment_distance(e, lon, lat) <= radius)


def centroid(edges: Column) -> Column:
    """Area-weighted centroid ``struct<lon,lat>`` of a closed boundary whose holes run the other way."""
    cross = lambda e: e["x1"] * e["y2"] - e["x2"] * e["y1"]
    total = lambda f: F.aggregate(F.transform(edges, f), F.lit(0.0), lambda acc, v: acc + v)
    area = total(cross)
    return F.when(area != 0, F.struct(
        (total(lambda e: (e["x1"] + e["x2"]) * cross(e)) / (3 * area)).alias("lon"),
        (total(lambda e: (e["y1"] + e["y2"]) * cross(e)) / (3 * area)).alias("lat"),
    ))


def haversine_km(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    h = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(F.lit(1.0), h)))


def in_box(lon: Column | str, lat: Column | str, box: tuple[float, float, float, float]) -> Column:
    """Inside ``(lat_min, lat_max, lon_min, lon_max)``, borders included."""
    lo_lat, hi_lat, lo_lon, hi_lon = box
    return _col(lat).between(lo_lat, hi_lat) & _col(lon).between(lo_lon, hi_lon)


# lat_min, lat_max, lon_min, lon_max of the live coverage area.
COVERAGE = (-35.0, 37.0, -17.0, 60.0)
