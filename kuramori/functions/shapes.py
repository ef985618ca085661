"""Geometry that Spark has no expressions for, in numpy behind Arrow-batched functions: geodesics, areas, interior points, overlap.

Rings are ``array<array<struct<x, y>>>``. Null and degenerate input gives null."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# GRS 80.
MAJOR, FLATTENING = 6_378_137.0, 1 / 298.257222101
MINOR = MAJOR * (1 - FLATTENING)
POINT = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])


def geodesic(lon1: np.ndarray, lat1: np.ndarray, lon2: np.ndarray, lat2: np.ndarray) -> np.ndarray:
    """Inverse geodesic (Vincenty) on GRS 80 in metres; nearly antipodal pairs give NaN."""
    u1, u2 = (np.arctan((1 - FLATTENING) * np.tan(np.radians(v))) for v in (lat1, lat2))
    span = np.radians(np.asarray(lon2) - np.asarray(lon1))
    s1, c1, s2, c2, lam = np.sin(u1), np.cos(u1), np.sin(u2), np.cos(u2), span.copy()
    for _ in range(60):
        sl, cl = np.sin(lam), np.cos(lam)
        sin_s = np.hypot(c2 * sl, c1 * s2 - s1 * c2 * cl)
        cos_s = s1 * s2 + c1 * c2 * cl
        sigma = np.arctan2(sin_s, cos_s)
        with np.errstate(invalid="ignore", divide="ignore"):
            sin_a = np.where(sin_s == 0, 0.0, c1 * c2 * sl / sin_s)
            cos2_a = 1 - sin_a**2
            cos_m = np.where(cos2_a == 0, 0.0, cos_s - 2 * s1 * s2 / cos2_a)
        c = FLATTENING / 16 * cos2_a * (4 + FLATTENING * (4 - 3 * cos2_a))
        before, lam = lam, span + (1 - c) * FLATTENING * sin_a * (sigma + c * sin_s * (cos_m + c * cos_s * (2 * cos_m**2 - 1)))
        if np.nanmax(np.abs(lam - before), initial=0.0) < 1e-12:
            break
    k = cos2_a * (MAJOR**2 - MINOR**2) / MINOR**2
    a = 1 + k / 16384 * (4096 + k * (-768 + k * (320 - 175 * k)))
    b = k / 1024 * (256 + k * (-128 + k * (74 - 47 * k)))
    d = b * sin_s * (cos_m + b / 4 * (cos_s * (2 * cos_m**2 - 1) - b / 6 * cos_m * (4 * sin_s**2 - 3) * (4 * cos_m**2 - 3)))
    return np.where(np.abs(lam - before) < 1e-9, MINOR * a * (sigma - d), np.nan)


@F.pandas_udf(T.DoubleType())
def geodesic_m(lon1: pd.Series, lat1: pd.Series, lon2: pd.Series, lat2: pd.Series) -> pd.Series:
    """Metres between two places on the ellipsoid."""
    return pd.Series(geodesic(*(s.to_numpy(dtype=float) for s in (lon1, lat1, lon2, lat2))))


def ring_area(ring: Sequence[tuple[float, float]]) -> float:
    """Signed planar area."""
    x, y = np.array(ring, dtype=float).T
    return float(np.dot(x, np.roll(y, -1)) - np.dot(np.roll(x, -1), y)) / 2


def geodesic_area(ring: Sequence[tuple[float, float]]) -> float:
    """Area of a small ring in square metres: authalic latitudes turn the ellipsoid into an equal-area plane."""
    e2 = FLATTENING * (2 - FLATTENING)
    e = math.sqrt(e2)
    q = lambda s: (1 - e2) * (s / (1 - e2 * s * s) - np.log((1 - e * s) / (1 + e * s)) / (2 * e))
    lon, lat = np.radians(np.array(ring, dtype=float)).T
    return abs(ring_area(list(zip(lon, q(np.sin(lat)))))) * MAJOR**2 / 2


def _ring(points: Sequence) -> list[tuple[float, float]]:
    return [(p["x"], p["y"]) for p in points]


def _largest(rings: Sequence | None) -> list[tuple[float, float]]:
    return max((_ring(r) for r in (rings if rings is not None else []) if len(r) >= 3), key=lambda r: abs(ring_area(r)), default=[])


@F.pandas_udf(T.DoubleType())
def footprint_area_m2(rings: pd.Series) -> pd.Series:
    """Sum of the areas of the rings."""
    return pd.Series([sum(geodesic_area(_ring(r)) for r in v if len(r) >= 3) if v is not None else None for v in rings], dtype="float64")


def inside_point(ring: Sequence[tuple[float, float]]) -> tuple[float, float] | None:
    """A point in the interior: the middle of the widest stretch on a horizontal line between the two middle heights."""
    if len(ring) < 3 or not ring_area(ring):
        return None
    ys = sorted({p[1] for p in ring})
    mid = (ys[0] + ys[-1]) / 2
    below, above = max((y for y in ys if y <= mid), default=ys[0]), min((y for y in ys if y > mid), default=ys[-1])
    y = (below + above) / 2
    cuts = sorted(a[0] + (y - a[1]) * (b[0] - a[0]) / (b[1] - a[1]) for a, b in zip(ring, [*ring[1:], ring[0]]) if (a[1] > y) != (b[1] > y))
    pairs = list(zip(cuts[::2], cuts[1::2]))
    if not pairs:
        return None
    left, right = max(pairs, key=lambda p: p[1] - p[0])
    return (left + right) / 2, y


@F.pandas_udf(POINT)
def representative_point(rings: pd.Series) -> pd.DataFrame:
    """Interior point of the largest ring."""
    found = [inside_point(_largest(v)) or (None, None) for v in rings]
    return pd.DataFrame(found, columns=["x", "y"])


def centroid(ring: Column) -> Column:
    """Area centroid of a closed or open ring (array of points), in the JVM; vertices' mean for a degenerate ring."""
    n = F.size(ring)
    pairs = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(F.get(ring, i).alias("a"), F.get(ring, (i + 1) % n).alias("b")))
    cross = lambda p: p["a"]["x"] * p["b"]["y"] - p["b"]["x"] * p["a"]["y"]
    total = lambda f: F.aggregate(pairs, F.lit(0.0), lambda s, p: s + f(p))
    area = total(cross)
    mean = lambda axis: F.aggregate(ring, F.lit(0.0), lambda s, p: s + p[axis]) / n
    part = lambda axis: F.when(area != 0, total(lambda p: (p["a"][axis] + p["b"][axis]) * cross(p)) / (3 * area)).otherwise(mean(axis))
    return F.struct(part("x").alias("x"), part("y").alias("y"))


def bounds(rings: Column) -> Column:
    """struct(xmin, ymin, xmax, ymax) of rings."""
    flat = F.flatten(rings)
    axis = lambda a: F.transform(flat, lambda p: p[a])
    return F.struct(F.array_min(axis("x")).alias("xmin"), F.array_min(axis("y")).alias("ymin"), F.array_max(axis("x")).alias("xmax"), F.array_max(axis("y")).alias("ymax"))


def clipped(subject: Sequence[tuple[float, float]], clip: Sequence[tuple[float, float]]) -> list[tuple[float, float]]:
    """Part of a ring inside a convex ring (half-plane clipping)."""
    clip = list(clip) if ring_area(clip) > 0 else list(reversed(clip))
    out = list(subject)
    for a, b in zip(clip, [*clip[1:], clip[0]]):
        if a == b or not out:
            continue
        side = lambda p: (b[0] - a[0]) * (p[1] - a[1]) - (b[1] - a[1]) * (p[0] - a[0])  # noqa: B023,E731
        kept: list[tuple[float, float]] = []
        for p, q in zip(out, [*out[1:], out[0]]):
            sp, sq = side(p), side(q)
            if sp >= 0:
                kept.append(p)
            if (sp > 0 > sq) or (sp < 0 < sq):
                t = sp / (sp - sq)
                kept.append((p[0] + t * (q[0] - p[0]), p[1] + t * (q[1] - p[1])))
        out = kept
    return out


def triangles(ring: Sequence[tuple[float, float]]) -> list[list[tuple[float, float]]]:
    """Ear-clipping triangulation of a simple ring."""
    pts = [p for i, p in enumerate(ring) if p != ring[i - 1]] if len(ring) > 1 else list(ring)
    if len(pts) < 3:
        return []
    pts = pts if ring_area(pts) > 0 else pts[::-1]
    turn = lambda a, b, c: (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])
    out = []
    while len(pts) > 3:
        for i in range(len(pts)):
            a, b, c = pts[i - 1], pts[i], pts[(i + 1) % len(pts)]
            if turn(a, b, c) > 0 and not any(turn(a, b, p) > 0 and turn(b, c, p) > 0 and turn(c, a, p) > 0 for p in pts if p not in (a, b, c)):
                out.append([a, b, c])
                pts = pts[:i] + pts[i + 1 :]
                break
        else:
            break
    return [*out, pts] if len(pts) == 3 else out


def overlap_area(a: Sequence[tuple[float, float]], b: Sequence[tuple[float, float]]) -> float:
    """Planar area common to two simple rings; 0 where they only touch."""
    parts = (clipped(t, u) for t in triangles(a) for u in triangles(b))
    return sum(abs(ring_area(p)) for p in parts if len(p) >= 3)


@F.pandas_udf(T.BooleanType())
def overlaps(a: pd.Series, b: pd.Series) -> pd.Series:
    """Whether two footprints share some area (touching borders don't count)."""
    return pd.Series([any(overlap_area(_ring(r), _ring(s)) > 1e-16 for r in x for s in y if len(r) > 2 and len(s) > 2) if x is not None and y is not None else False for x, y in zip(a, b)])


def polygonize(lines: Sequence[Sequence[tuple[float, float]]]) -> list[list[tuple[float, float]]]:
    """Closed rings from line strings joined end to end; open remainders are dropped."""
    left, rings = [list(line) for line in lines if len(line) > 1], []
    while left:
        ring = left.pop()
        while ring[0] != ring[-1]:
            hit = next((k for k, o in enumerate(left) if ring[-1] in (o[0], o[-1])), None)
            if hit is None:
                break
            other = left.pop(hit)
            ring += (other if other[0] == ring[-1] else other[::-1])[1:]
        if ring[0] == ring[-1] and len(ring) > 3:
            rings.append(ring)
    return rings


def geometry_family(text: Column) -> Column:
    """polygon, line, point, mixed or '' of geometry text."""
    s = F.upper(F.coalesce(text, F.lit("")))
    return F.when(s.contains("GEOMETRYCOLLECTION"), "mixed").when(s.contains("POLYGON"), "polygon").when(s.contains("LINESTRING"), "line").when(s.contains("POINT"), "point").otherwise("")
