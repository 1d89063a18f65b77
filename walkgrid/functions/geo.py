"""Geometry as Column expressions over coordinate doubles and arrays of (lng, lat) structs."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from walkgrid.constants import EARTH_RADIUS_M
from walkgrid.functions.projection import system

POINT = T.StructType([T.StructField("lng", T.DoubleType()), T.StructField("lat", T.DoubleType())])
LINE = T.ArrayType(POINT)
POLYGON = T.ArrayType(LINE)  # rings; parts and holes are told apart by the even-odd rule

M_PER_DEG = EARTH_RADIUS_M * math.pi / 180.0


def haversine(lng1: Column, lat1: Column, lng2: Column, lat2: Column) -> Column:
    """Great-circle distance in metres."""
    return arc_metres(
        F.radians(lat2 - lat1), F.radians(lng2 - lng1), F.cos(F.radians(lat1)), F.cos(F.radians(lat2))
    )


def arc_metres(dlat: Column, dlng: Column, cos1: Column, cos2: Column) -> Column:
    """Haversine of given differences (radians) and cosines of latitude; rounding may not leave asin's domain."""
    half_lat, half_lng = F.sin(dlat / 2), F.sin(dlng / 2)
    a = half_lat * half_lat + cos1 * cos2 * half_lng * half_lng
    return arc_of(F.sqrt(a))


def arc_of(half_chord: Column) -> Column:
    """Metres along the surface for half a chord of the unit sphere; missing stays missing (``least`` would hide it)."""
    return F.asin(F.when(half_chord > 1.0, 1.0).otherwise(half_chord)) * (2 * EARTH_RADIUS_M)


def to_wgs84(x: Column, y: Column, srid: int | None) -> tuple[Column, Column]:
    """(lng, lat) of coordinates in ``srid``: unknown or 4326 as they are, 3857 by the closed form, transverse Mercator systems
    (``projection.system``) by their series."""
    if srid in (None, 4326):
        return x, y
    if srid == 3857:
        lng = x / M_PER_DEG
        lat = F.degrees(F.atan(F.exp(y / EARTH_RADIUS_M)) * 2 - math.pi / 2)
        return lng, lat
    projected = system(srid)
    if projected is None:
        raise ValueError(f"unsupported srid {srid}: neither 4326 nor 3857 nor a known transverse Mercator zone")
    return projected.unproject(x, y)


def ring_edges(ring: Column) -> Column:
    """Array of (x1, y1, x2, y2) of a ring; the last vertex joins the first."""
    n = F.size(ring)
    return F.transform(
        ring,
        lambda p, i: F.struct(
            p["lng"].alias("x1"),
            p["lat"].alias("y1"),
            F.get(ring, (i + 1) % n)["lng"].alias("x2"),
            F.get(ring, (i + 1) % n)["lat"].alias("y2"),
        ),
    )


def polygon_edges(rings: Column) -> Column:
    return F.flatten(F.transform(rings, ring_edges))


def crossing_lng(edge: Column, lat: Column) -> Column:
    """Longitude at which a non-horizontal edge meets ``lat``."""
    return (edge["x2"] - edge["x1"]) * (lat - edge["y1"]) / (edge["y2"] - edge["y1"]) + edge["x1"]


def straddles(edge: Column, lat: Column) -> Column:
    """Half-open test, so a vertex on the line counts for exactly one of its two edges (and no edge is horizontal)."""
    return (edge["y1"] > lat) != (edge["y2"] > lat)


def round_point(p: Column, digits: int = 6) -> Column:
    return F.array(F.round(p["lng"], digits), F.round(p["lat"], digits))


def round_rings(rings: Column, digits: int = 6) -> Column:
    """Rings as nested [lng, lat] arrays with rounded coordinates, the shape GeoJSON wants."""
    return F.transform(rings, lambda r: F.transform(r, lambda p: round_point(p, digits)))
