"""Points near points, and points in polygons, without a spatial library.

* ``within_distance``: both sides are put into a grid whose cells are at least the distance wide, the smaller side into each cell
  its circle can reach; an equi-join on the cell and an exact great-circle test follow. No row is compared outside its cell.
* ``containing_polygons``: each polygon is covered by cells of a quad-tree, refined only along its border (``coverage``). Cells
  wholly inside are accepted by the equi-join alone; rows in border cells alone get the exact containment test.

A hot cell is one join key with many rows on one side; both joins leave its splitting to adaptive skew handling, and never
gather a cell into one task in Python."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kuramori.functions.geometry import EARTH_RADIUS_M, LAT_RANGE, covers, edges_of, haversine_m, parse_polygons

MAX_LEVEL = 16  # about 0.0055 degrees of longitude
MIN_LEVEL = 6


def _cell_size(distance_m: float) -> tuple[float, float]:
    """Width and height in degrees of grid cells that a circle of this radius can't jump over, anywhere in the place window."""
    lat = math.degrees(distance_m / EARTH_RADIUS_M) * 1.0001
    worst = max(abs(v) for v in LAT_RANGE) + lat
    lon = math.degrees(2 * math.asin(min(1.0, math.sin(distance_m / EARTH_RADIUS_M / 2) / math.cos(math.radians(worst))))) * 1.0001
    return lon, lat


def within_distance(few: DataFrame, many: DataFrame, distance_m: float, few_xy: tuple[str, str] = ("lon", "lat"), many_xy: tuple[str, str] = ("x", "y")) -> DataFrame:
    """Pairs of rows at most ``distance_m`` apart (bound included), with all columns of both sides and ``distance_m``.

    Column names must differ between the sides. Rows with a null or non-finite coordinate are in no pair. Only latitudes of
    the place window are allowed (filter with ``plausible`` first)."""
    w, h = _cell_size(distance_m)
    x, y = (F.col(c) for c in few_xy)
    cx, cy = F.floor(x / w), F.floor(y / h)
    # a neighbouring cell is listed only if the square around the circle reaches it
    reach = lambda v, size: F.sequence(F.floor((v - size) / size), F.floor((v + size) / size))
    placed = few.filter(x.isNotNull() & y.isNotNull() & ~F.isnan(x) & ~F.isnan(y))
    placed = placed.withColumn("_gx", F.explode(reach(x, w))).withColumn("_gy", F.explode(reach(y, h)))
    mx, my = (F.col(c) for c in many_xy)
    other = many.filter(mx.isNotNull() & my.isNotNull() & ~F.isnan(mx) & ~F.isnan(my)).withColumn("_gx", F.floor(mx / w)).withColumn("_gy", F.floor(my / h))
    near = (F.abs(mx - x) <= w) & (F.abs(my - y) <= h)
    joined = other.join(placed, ["_gx", "_gy"]).filter(near).withColumn("distance_m", haversine_m(x, y, mx, my))
    return joined.filter(F.col("distance_m") <= distance_m).drop("_gx", "_gy")


def _segment_meets(edges: np.ndarray, x0: float, y0: float, size: float) -> np.ndarray:
    """Edges that may touch the closed square (conservative: separating axes with a margin)."""
    eps = 1e-12 + size * 1e-9
    x1, y1, x2, y2 = edges.T
    lo_x, hi_x, lo_y, hi_y = x0 - eps, x0 + size + eps, y0 - eps, y0 + size + eps
    box = (np.maximum(x1, x2) >= lo_x) & (np.minimum(x1, x2) <= hi_x) & (np.maximum(y1, y2) >= lo_y) & (np.minimum(y1, y2) <= hi_y)
    mx, my, half = x0 + size / 2, y0 + size / 2, size / 2 + eps
    offset = np.abs((x2 - x1) * (my - y1) - (y2 - y1) * (mx - x1))
    return box & (offset <= half * (np.abs(x2 - x1) + np.abs(y2 - y1)) + eps)


def coverage(text: str | None, max_cells: int = 600) -> list[tuple[int, int, int, bool]]:
    """(level, i, j, interior) cells of a polygon; cell (i, j) of a level is [i, i+1) x [j, j+1) times 360 / 2**level degrees.

    Refines the largest border cells first until ``max_cells`` or ``MAX_LEVEL``; unreadable or empty text has no cells."""
    edges = edges_of(parse_polygons(text))
    if not len(edges):
        return []
    size = 360.0 / 2**MIN_LEVEL
    lo, hi = edges.reshape(-1, 2).min(axis=0), edges.reshape(-1, 2).max(axis=0)
    level = MIN_LEVEL
    while level < MAX_LEVEL - 4 and size > 0.5 * max(*(hi - lo), 1e-9):
        level, size = level + 1, size / 2
    todo = [(level, i, j, edges) for i in range(math.floor(lo[0] / size), math.floor(hi[0] / size) + 1) for j in range(math.floor(lo[1] / size), math.floor(hi[1] / size) + 1)]
    out: list[tuple[int, int, int, bool]] = []
    while todo:
        level, i, j, near = todo.pop(0)
        size = 360.0 / 2**level
        touching = near[_segment_meets(near, i * size, j * size, size)]
        if not len(touching):
            if covers(edges, (i + 0.5) * size, (j + 0.5) * size):
                out.append((level, i, j, True))
        elif level >= MAX_LEVEL or len(out) + len(todo) + 3 > max_cells:
            out.append((level, i, j, False))
        else:
            todo.extend((level + 1, 2 * i + a, 2 * j + b, touching) for a in (0, 1) for b in (0, 1))
    return out


def cover(polygons: DataFrame, key: str, geometry: str) -> DataFrame:
    """(key, level, i, j, interior) cells of every polygon."""
    kind = polygons.schema[key].dataType.simpleString()

    def cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(k, *c) for k, g in zip(pdf[key], pdf[geometry]) for c in coverage(g)]
            yield pd.DataFrame(rows, columns=[key, "level", "i", "j", "interior"])

    return polygons.select(key, geometry).mapInPandas(cells, f"`{key}` {kind}, level int, i long, j long, interior boolean")


def containing_polygons(points: DataFrame, polygons: DataFrame, point_key: str, key: str, geometry: str = "geometry", xy: tuple[str, str] = ("lon", "lat")) -> DataFrame:
    """(point_key, key) for every polygon that contains the point; borders count, holes don't.

    Repeated points or polygons give each pair once. Null coordinates, empty and unreadable geometry give no pair."""
    shapes = polygons.select(key, geometry).distinct()
    cells = cover(shapes, key, geometry)
    x, y = (F.col(c) for c in xy)
    pts = points.filter(x.isNotNull() & y.isNotNull()).select(point_key, x.cast("double").alias("_x"), y.cast("double").alias("_y")).distinct()

    def at(level: Column, v: str) -> Column:
        return F.floor(F.col(v) / (F.lit(360.0) / F.pow(F.lit(2.0), level))).cast("long")

    levels = F.explode(F.sequence(F.lit(MIN_LEVEL), F.lit(MAX_LEVEL)))
    placed = pts.withColumn("level", levels).withColumn("i", at(F.col("level"), "_x")).withColumn("j", at(F.col("level"), "_y"))
    hits = placed.join(cells, ["level", "i", "j"]).select(point_key, key, "_x", "_y", "interior")
    certain = hits.filter("interior").select(point_key, key)

    @F.pandas_udf("boolean")
    def exactly_covers(text: pd.Series, px: pd.Series, py: pd.Series) -> pd.Series:
        known: dict[str, np.ndarray] = {}
        out = []
        for t, a, b in zip(text, px, py):
            if t not in known:
                if len(known) > 2_000:  # parsed shapes kept by a worker; only a cache
                    known.clear()
                known[t] = edges_of(parse_polygons(t))
            out.append(covers(known[t], a, b))
        return pd.Series(out, dtype="bool")

    border = hits.filter("not interior").join(shapes, key).filter(exactly_covers(F.col(geometry), F.col("_x"), F.col("_y"))).select(point_key, key)
    return certain.union(border).distinct()


def to_mercator(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Spherical web-mercator coordinates in closed form."""
    r = 6_378_137.0
    return F.radians(lon) * r, F.log(F.tan(F.lit(math.pi / 4) + F.radians(lat) / 2)) * r


def nearest_within(few: DataFrame, many: DataFrame, key: str, reach: float, few_xy: tuple[str, str], many_xy: tuple[str, str]) -> DataFrame:
    """Rows of ``many`` nearest to each row of ``few`` within a planar distance; all ties are kept.

    Both sides go into square cells twice as wide as the reach, ``few`` into the (about four) cells its circle can touch. The rows of ``few``
    repeat by that, which the planner's size estimate doesn't know: the join is by sorting, never by a copy of them in the driver. The pairs are
    made once; those of the least rank are kept per partition before they are shuffled by key."""
    fx, fy, mx, my = (F.col(c) for c in (*few_xy, *many_xy))
    cell = lambda v: F.floor(v / (2 * reach))
    around = lambda v: F.explode(F.sequence(cell(v - 1.0001 * reach), cell(v + 1.0001 * reach)))
    placed = few.withColumn("_gx", around(fx)).withColumn("_gy", around(fy)).hint("merge")
    d2 = (fx - mx) * (fx - mx) + (fy - my) * (fy - my)
    hits = many.withColumn("_gx", cell(mx)).withColumn("_gy", cell(my)).join(placed, ["_gx", "_gy"]).withColumn("_d2", d2).filter(F.col("_d2") <= reach * reach).drop("_gx", "_gy")
    nearest = hits.withColumn("_rank", F.rank().over(Window.partitionBy(key).orderBy("_d2"))).filter("_rank = 1")
    return nearest.withColumn("distance", F.sqrt("_d2")).drop("_d2", "_rank")


def in_box_rings(points: DataFrame, shapes: DataFrame, point_key: str, key: str, rings: str, xy: tuple[str, str] = ("lon", "lat"), cell: float = 0.01) -> DataFrame:
    """(point_key, key) of points in or on any ring of a footprint (``array<array<struct<x, y>>>``), wholly in the JVM.

    Rings are separate areas, so a hole counts as filled, as in footprints taken ring by ring. Footprints are small: each is listed in the
    grid cells its bounding box touches, and the exact even-odd test runs on the pairs of a cell only."""
    ring = shapes.select(key, F.explode(rings).alias("r")).filter(F.size("r") >= 3)
    xs, ys = F.transform("r", lambda p: p["x"]), F.transform("r", lambda p: p["y"])
    boxed = ring.select(key, "r", F.array_min(xs).alias("x0"), F.array_max(xs).alias("x1"), F.array_min(ys).alias("y0"), F.array_max(ys).alias("y1"))
    at = lambda c: F.floor(F.col(c) / cell)
    celled = boxed.withColumn("_gx", F.explode(F.sequence(at("x0"), at("x1")))).withColumn("_gy", F.explode(F.sequence(at("y0"), at("y1"))))
    x, y = (F.col(c) for c in xy)
    pts = points.filter(x.isNotNull() & y.isNotNull()).select(point_key, x.alias("_x"), y.alias("_y")).distinct().withColumn("_gx", F.floor(F.col("_x") / cell)).withColumn("_gy", F.floor(F.col("_y") / cell))
    near = pts.join(celled, ["_gx", "_gy"]).filter("_x between x0 and x1 and _y between y0 and y1")
    n = F.size("r")
    px, py = F.col("_x"), F.col("_y")
    edges = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(F.get("r", i).alias("a"), F.get("r", (i + 1) % n).alias("b")))
    cross = lambda e: (e["b"]["x"] - e["a"]["x"]) * (py - e["a"]["y"]) - (e["b"]["y"] - e["a"]["y"]) * (px - e["a"]["x"])
    within = lambda p, q, v: (F.least(p, q) <= v) & (v <= F.greatest(p, q))
    on_edge = F.exists(edges, lambda e: (cross(e) == 0) & within(e["a"]["x"], e["b"]["x"], px) & within(e["a"]["y"], e["b"]["y"], py))
    crossed = F.size(F.filter(edges, lambda e: ((e["a"]["y"] > py) != (e["b"]["y"] > py)) & F.when(e["b"]["y"] > e["a"]["y"], cross(e) > 0).otherwise(cross(e) < 0)))
    return near.filter(on_edge | (crossed % 2 == 1)).select(point_key, key).distinct()


def grid_max(points: DataFrame, x: str, y: str, value: str, cell: float) -> DataFrame:
    """(ix, iy, value): the largest value of every cell; later tables are merged by the same aggregation over the union."""
    return points.filter(F.col(value).isNotNull()).groupBy(F.floor(F.col(x) / cell).alias("ix"), F.floor(F.col(y) / cell).alias("iy")).agg(F.max(value).alias("value"))


def lattice_spacing(points: DataFrame, axis: str, decimals: int = 7) -> DataFrame:
    """(spacing): median of the small differences of neighbouring distinct coordinates (those up to 1.6 times their 35th percentile).

    The differences are taken per coarse block with the block's least value carried over, so no global sort lands in one task; the
    quantiles are those of the counts per difference, as many rows as there are different ones."""
    v = points.select(F.round(axis, decimals).alias("v")).filter("v is not null").distinct().withColumn("b", F.floor(F.col("v") * 100))
    step = lambda a, b: F.round(F.col(a) - b, decimals + 2).alias("d")
    inside = v.select(step("v", F.lag("v").over(Window.partitionBy("b").orderBy("v"))))
    ends = v.groupBy("b").agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    bridge = ends.select(step("lo", F.lag("hi").over(Window.partitionBy(F.floor(F.col("b") / 1_000_000)).orderBy("b"))))
    counts = inside.union(bridge).filter("d > 0").groupBy("d").agg(F.count("*").alias("n"))
    low = counts.agg(F.percentile("d", F.lit(0.35), F.col("n")).alias("p"))
    return counts.join(F.broadcast(low)).filter("d <= 1.6 * p").agg(F.round(F.percentile("d", F.lit(0.5), F.col("n")), decimals + 2).alias("spacing"))
