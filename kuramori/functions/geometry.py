"""Geometry as text and rings: column expressions for points, exact polygon tests in numpy.

Coordinates are longitude (x) and latitude (y) in degrees."""

from __future__ import annotations

import json
import re
from fractions import Fraction

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6_371_008.8
# Window of plausible places, latitude then longitude.
LAT_RANGE, LON_RANGE = (20.0, 50.0), (120.0, 155.0)
_NUMBER = r"[-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?"
_WKT_POINT = rf"(?is)^\s*(?:SRID\s*=\s*\d+\s*;)?\s*(?:MULTI)?POINT\s*(?:ZM|Z|M)?\s*\(\s*\(?\s*({_NUMBER})\s+({_NUMBER})(?:\s+{_NUMBER})*\s*\)?\s*\)\s*$"
_JSON_POINT = rf"(?is)^\s*\{{.*\"coordinates\"\s*:\s*\[\s*({_NUMBER})\s*,\s*({_NUMBER})\s*(?:,\s*{_NUMBER}\s*)*\].*\}}\s*$"


def point_of(geometry: Column) -> tuple[Column, Column]:
    """(x, y) of point text in WKT, EWKT (any case, Z/M, one-member MULTIPOINT) or GeoJSON; nulls for anything else."""

    def ordinate(group: int) -> Column:
        wkt, js = F.regexp_extract(geometry, _WKT_POINT, group), F.regexp_extract(geometry, _JSON_POINT, group)
        return F.when(wkt != "", wkt).when(js != "", js).cast("double")

    return ordinate(1), ordinate(2)


def place_of(geometry: Column, lon: Column, lat: Column) -> tuple[Column, Column]:
    """A record's place: its geometry, or lon/lat where geometry is null or empty text. Unreadable geometry gives nulls."""
    x, y = point_of(geometry)
    missing = geometry.isNull() | (F.trim(geometry) == "")
    return F.when(missing, lon).otherwise(x), F.when(missing, lat).otherwise(y)


def plausible(lon: Column, lat: Column) -> Column:
    """True inside the place window, false outside and for nulls or NaN."""
    return F.coalesce(lon.between(*LON_RANGE) & lat.between(*LAT_RANGE), F.lit(False))


def haversine_m(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Great-circle distance in metres on the mean sphere."""
    half = lambda d: F.pow(F.sin(F.radians(d) / 2), F.lit(2))
    a = half(lat2 - lat1) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half(lon2 - lon1)
    return 2 * EARTH_RADIUS_M * F.asin(F.least(F.lit(1.0), F.sqrt(a)))


def parse_polygons(text: str | None) -> list[list[list[tuple[float, float]]]]:
    """Polygons of WKT/EWKT or GeoJSON text, each a list of rings (shell first); [] for anything else."""
    if not text or not text.strip():
        return []
    s = text.strip()
    if s.startswith("{"):
        try:
            g = json.loads(s)
            parts = {"Polygon": lambda c: [c], "MultiPolygon": lambda c: c}[g["type"]](g["coordinates"])
            return [[[(float(p[0]), float(p[1])) for p in ring] for ring in poly] for poly in parts]
        except (ValueError, KeyError, TypeError, IndexError):
            return []
    m = re.fullmatch(r"(?is)(?:SRID\s*=\s*\d+\s*;)?\s*(MULTI)?POLYGON\s*(?:ZM|Z|M)?\s*(\(.*\))", s)
    if not m:
        return []
    try:
        tree = json.loads(re.sub(rf"({_NUMBER}(?:\s+{_NUMBER})+)", lambda n: "[" + ",".join(repr(float(x)) for x in n.group(1).split()) + "]", m.group(2)).replace("(", "[").replace(")", "]"))
        return [[[(p[0], p[1]) for p in ring] for ring in poly] for poly in (tree if m.group(1) else [tree])]
    except (ValueError, TypeError, IndexError):
        return []


def edges_of(polygons: list[list[list[tuple[float, float]]]]) -> np.ndarray:
    """All ring edges as an (n, 4) array x1 y1 x2 y2; open rings are closed."""
    out = []
    for polygon in polygons:
        for ring in polygon:
            pts = ring if ring and ring[0] == ring[-1] else [*ring, *ring[:1]]
            out.extend((*a, *b) for a, b in zip(pts, pts[1:]) if a != b)
    return np.array(out, dtype="float64").reshape(-1, 4)


def _orientation(edge: np.ndarray, x: float, y: float) -> int:
    """Exact sign of the cross product (b-a) x (p-a), on the decimal text of the coordinates."""
    ax, ay, bx, by, px, py = (Fraction(repr(float(v))) for v in (*edge, x, y))
    d = (bx - ax) * (py - ay) - (by - ay) * (px - ax)
    return (d > 0) - (d < 0)


def covers(edges: np.ndarray, x: float, y: float) -> bool:
    """Even-odd containment by all rings together: holes are outside, every border is inside. Exact: a floating sign is used
    only where it is certain, else the decimal values decide."""
    if not len(edges):
        return False
    x1, y1, x2, y2 = edges.T
    cross = (x2 - x1) * (y - y1) - (y2 - y1) * (x - x1)
    scale = np.abs(x2 - x1) * np.abs(y - y1) + np.abs(y2 - y1) * np.abs(x - x1)
    side = np.sign(cross).astype(int)
    reach = (np.minimum(x1, x2) <= x) & (x <= np.maximum(x1, x2)) & (np.minimum(y1, y2) <= y) & (y <= np.maximum(y1, y2))
    straddle = (y1 > y) != (y2 > y)
    for k in np.flatnonzero((np.abs(cross) <= 1e-9 * scale + 1e-18) & (reach | straddle)):
        side[k] = _orientation(edges[k], x, y)
    if bool((reach & (side == 0)).any()):
        return True
    return bool(np.count_nonzero(straddle & np.where(y2 > y1, side > 0, side < 0)) % 2)
