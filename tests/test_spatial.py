import math
import random

import pytest
from pyspark.sql import functions as F

from kuramori.functions.geometry import EARTH_RADIUS_M, covers, edges_of, parse_polygons, place_of
from kuramori.functions.mesh import cell_box, code_of
from kuramori.operators.spatial import containing_polygons, coverage, in_box_rings, nearest_within, within_distance


def haversine(a, b, c, d):
    h = math.sin(math.radians(d - b) / 2) ** 2 + math.cos(math.radians(b)) * math.cos(math.radians(d)) * math.sin(math.radians(c - a) / 2) ** 2
    return 2 * EARTH_RADIUS_M * math.asin(math.sqrt(h))


@pytest.mark.parametrize("lat", [20.5, 35.0, 49.5])
def test_distance_join_against_brute_force(spark, lat):
    rng = random.Random(1)
    few = [(i, 139 + rng.random() / 200, lat + rng.random() / 200) for i in range(60)]
    many = [(i, 139 + rng.random() / 200, lat + rng.random() / 200) for i in range(300)] + [(999, 139.0, lat)] * 3
    a = spark.createDataFrame([*few, (77, None, lat)], "a long, lon double, lat double")
    b = spark.createDataFrame([*many, (78, float("nan"), lat)], "b long, x double, y double")
    got = {(r.a, r.b) for r in within_distance(a, b, 60.0).select("a", "b").collect()}
    assert got == {(i, j) for i, p, q in few for j, x, y in many if haversine(p, q, x, y) <= 60}


def test_polygons_borders_holes_and_text(spark):
    square = "POLYGON ((139 35, 139.1 35, 139.1 35.1, 139 35.1, 139 35), (139.04 35.04, 139.06 35.04, 139.06 35.06, 139.04 35.06, 139.04 35.04))"
    shapes = spark.createDataFrame([(1, square), (2, None), (3, ""), (4, "no polygon"), (1, square)], "zone_id long, geometry string")
    pts = [("in", 139.02, 35.02), ("border", 139.0, 35.05), ("corner", 139.1, 35.1), ("hole", 139.05, 35.05), ("hole border", 139.04, 35.05), ("out", 139.2, 35.0), ("null", None, None)]
    points = spark.createDataFrame(pts, "museum_id string, lon double, lat double")
    got = {r.museum_id for r in containing_polygons(points, shapes, "museum_id", "zone_id").collect()}
    assert got == {"in", "border", "corner", "hole border"}
    assert containing_polygons(points.limit(0), shapes, "museum_id", "zone_id").count() == 0


def test_coverage_interior_cells_are_inside():
    rng = random.Random(2)
    ring = [(139 + 0.1 * (1 + 0.3 * rng.random()) * math.cos(t / 20 * math.tau), 35 + 0.1 * (1 + 0.3 * rng.random()) * math.sin(t / 20 * math.tau)) for t in range(20)]
    text = "POLYGON ((" + ", ".join(f"{x} {y}" for x, y in [*ring, ring[0]]) + "))"
    edges, cells = edges_of(parse_polygons(text)), coverage(text)
    assert any(c[3] for c in cells)
    for _ in range(2000):
        x, y = 139 + (rng.random() - 0.5) * 0.3, 35 + (rng.random() - 0.5) * 0.3
        hit = [c for c in cells if (math.floor(x / (360 / 2 ** c[0])), math.floor(y / (360 / 2 ** c[0]))) == (c[1], c[2])]
        assert covers(edges, x, y) <= bool(hit)
        assert all(covers(edges, x, y) for c in hit if c[3])


def test_places(spark):
    rows = [("POINT (139.5 35.5)", 1.0, 2.0), ("SRID=4326;POINT(139.5 35.5)", None, None), ("point z (139.5 35.5 7)", None, None), ("MULTIPOINT ((139.5 35.5))", None, None), ('{"coordinates": [139.5, 35.5, 8], "type": "Point"}', None, None), ("", 139.5, 35.5), (None, 139.5, 35.5)]
    bad = [("POINT EMPTY", 139.5, 35.5), ("x", 139.5, 35.5)]
    df = spark.createDataFrame(rows + bad, "g string, lon double, lat double")
    x, y = place_of(F.col("g"), F.col("lon"), F.col("lat"))
    got = [tuple(r) for r in df.select(x, y).collect()]
    assert got == [(139.5, 35.5)] * len(rows) + [(None, None)] * len(bad)


def test_mesh_is_invertible(spark):
    df = spark.createDataFrame([(139.7671248, 35.6812362), (139.0, 35.0), (140.99999, 36.12345)], "lon double, lat double")
    for digits in (10, 12):
        r = df.withColumn("c", code_of(F.col("lon"), F.col("lat"), digits)).withColumn("b", cell_box(F.col("c")))
        assert r.filter("lon >= b.xmin - 1e-9 and lon < b.xmax + 1e-9 and lat >= b.ymin - 1e-9 and lat < b.ymax + 1e-9").count() == 3
    assert df.select(code_of(F.lit(139.7671248), F.lit(35.6812362), 8)).first()[0] == "53394611"
    assert spark.range(1).select(cell_box(F.lit("533946112900"))).first()[0] is None


def test_footprints_and_nearest(spark):
    ring = [{"x": x, "y": y} for x, y in [(0.0, 0.0), (0.02, 0.0), (0.02, 0.02), (0.0, 0.02), (0.0, 0.0)]]
    shapes = spark.createDataFrame([("s", [ring])], "gml_id string, rings array<array<struct<x:double,y:double>>>")
    pts = spark.createDataFrame([(1, 0.01, 0.01), (2, 0.0, 0.01), (3, 0.03, 0.01), (4, None, None)], "k long, lon double, lat double")
    assert sorted(r.k for r in in_box_rings(pts, shapes, "k", "gml_id", "rings").collect()) == [1, 2]
    a = spark.createDataFrame([(1, 0.0, 0.0)], "k long, ax double, ay double")
    b = spark.createDataFrame([("p", 3.0, 4.0), ("q", -3.0, 4.0), ("r", 20.0, 0.0)], "id string, bx double, by double")
    assert {r.id for r in nearest_within(a, b, "k", 25.0, ("ax", "ay"), ("bx", "by")).collect()} == {"p", "q"}


def test_nearest_against_brute_force(spark):
    rng = random.Random(4)
    few = [(i % 150, 1.5e7 + 50 * rng.randrange(-3, 4) + rng.choice([0.0, 25.0, rng.uniform(0, 50)]), 4e6 + rng.uniform(-90, 90)) for i in range(200)]
    many = [(i, 1.5e7 + rng.randrange(-8, 9) * 25.0, 4e6 + rng.choice([-50.0, 0.0, 25.0, rng.uniform(-90, 90)])) for i in range(150)] + [(900, 1.5e7, 4e6)] * 2 + [(901, None, 4e6)]
    a, b = spark.createDataFrame(few, "k long, ax double, ay double"), spark.createDataFrame(many, "id long, bx double, by double")
    got = sorted((r.k, r.id, round(r.distance, 6)) for r in nearest_within(a, b, "k", 25.0, ("ax", "ay"), ("bx", "by")).collect())
    pairs = [(k, i, (p - x) ** 2 + (q - y) ** 2) for k, p, q in few for i, x, y in many if x is not None and (p - x) ** 2 + (q - y) ** 2 <= 625]
    least = {k: min(d for j, _, d in pairs if j == k) for k in {p[0] for p in pairs}}
    assert got == sorted((k, i, round(math.sqrt(d), 6)) for k, i, d in pairs if d == least[k]) and len(got) > 100


def _joins(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_nearest_point_depth_sends_no_repeated_rows_to_the_driver(spark):
    from kuramori.plans.catalogue import nearest_point_depth

    plan = _joins(nearest_point_depth(spark, "/root/testdata/sf0.001"))
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan and plan.count("SortMergeJoin") == 1
