import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from kuramori.functions import classes as C
from kuramori.functions import markup, shapes
from kuramori.operators import review
from kuramori.plans import pipelines

SQUARE = [(139.0, 35.0), (139.001, 35.0), (139.001, 35.001), (139.0, 35.001), (139.0, 35.0)]


def ring(points):
    return [[{"x": x, "y": y} for x, y in points]]


def package(spark, rows):
    b = spark.createDataFrame([("b1", "館", "X1丁目2番", ring(SQUARE)), ("b2", None, None, ring([(x + 0.01, y) for x, y in SQUARE]))], "gml_id string, name string, address string, rings array<array<struct<x:double,y:double>>>")
    schema = "record_uid long, name string, place_name string, address string, entity_class string, complex_id string, source_location_role string, x double, y double"
    r = spark.createDataFrame(rows, schema).withColumn("located", F.col("x").isNotNull())
    return pipelines.extract_package(r, b)


def test_extraction_rules(spark):
    rows = [
        (1, "a", None, None, "point", None, "record_coordinate", 139.0005, 35.0005), (2, "b", None, None, "point", None, "record_coordinate", 139.001001, 35.0005),
        (3, "c", None, "X1-2", "building_direct", None, "record_coordinate", 139.5, 35.5), (4, "d", None, None, "movable", None, "record_coordinate", 139.0, 35.0005),
        (5, "e", None, None, "point", "H1", "shared_complex_coordinate", 139.0005, 35.0005), (6, "f", None, None, "point", "H1", "shared_complex_coordinate", 139.0005, 35.0005),
        (7, "g", None, None, "point", "H2", "record_coordinate", 139.0005, 35.0005), (8, "h", None, None, "point", "H2", "record_coordinate", 139.0105, 35.0005),
        (9, "館", None, None, "building_direct", None, "missing", None, None), (10, "館", None, None, "point", None, "missing", None, None),
    ]
    p = package(spark, rows)
    links = {(r.record_uid, r.gml_id): r.methods for r in p["links"].collect()}
    assert links == {(1, "b1"): "point_in_building", (3, "b1"): "exact_address", (4, "b1"): "point_in_building", (7, "b1"): "point_in_building", (8, "b2"): "point_in_building", (9, "b1"): "exact_name"}
    assert {r.record_uid: r.reason for r in p["points"].collect()} == {2: "record_not_in_building"}
    assert {r.record_uid: r.state for r in p["unresolved"].collect()} == {5: "complex_only", 6: "complex_only", 10: "unlocated"}
    assert {r.complex_id: r.complex_status for r in p["complex_summary"].collect()} == {"H1": "complex_only", "H2": "matched_building_complex"}
    assert p["complex_members"].count() == 2


def test_classify_and_merge(spark):
    g = spark.createDataFrame([("寺", "temple", "medium", 2), ("寺", "hall", "high", 1)], "match_value string, type_code string, confidence string, priority int")
    o = spark.createDataFrame([("塔", "a", 1), ("塔", "b", 2)], "raw_value string, type_code string, position int")
    v = spark.createDataFrame([("寺 ",), ("塔",), ("?",), (None,)], "raw_value string")
    got = {r.raw_value: (r.type_code, r.confidence, r.matched_by) for r in pipelines.classify(v, g, o, ["raw_value"]).collect()}
    assert got == {"寺 ": ("hall", "high", "glossary"), "塔": ("b", "high", "override"), "?": (None, "low", "none"), None: (None, "low", "none")}
    a, b = spark.createDataFrame([("13901", 1)], "municipality_code string, v int"), spark.createDataFrame([("13909.0", "x")], "municipality_code string, w string")
    m = pipelines.merged_packages({"13901": {"t": a}, "13902": {"t": b}})["t"]
    assert m.columns == ["municipality_code", "v", "package_code", "w"] and pipelines.contradicting_codes(m).count() == 1
    assert pipelines.value_column(spark.createDataFrame([("a", "1", 2.0)], "s string, pl_x string, n double"), ["gone"], "pl") == "pl_x"


def test_disaster_layers_raise_on_overflow(spark):
    cols = "building_gml_id string, risk_index int, risk_type string, risk_type_ja string, depth_m double, duration_h double, " + ", ".join(f"{f}_{x} string" for f in ("rank", "rank_org", "area_type") for x in ("code", "label", "codespace"))
    rows = [("b", i, "tsunami", "津波", 1.5, None, "2", "", "x/r.xml", "", "", "", "", "", "") for i in (1, 2)]
    k, b = spark.createDataFrame(rows, cols), spark.createDataFrame([("b",)], "gml_id string")
    files = spark.createDataFrame([("r.xml", "2", "浅い")], "file string, code string, label string")
    types = spark.createDataFrame([], "type string, field string, code string, label string")
    wide = pipelines.disaster_layers(k, b, files, types, 2)["wide"].first()
    assert (wide.slots, wide.risk01_risk_class, wide.risk02_risk_label) == (2, "浅い", "津波｜浅い｜深さ 1.5 m")
    with pytest.raises(ValueError):
        pipelines.disaster_layers(k, b, files, types, 1)
    with pytest.raises(ValueError):
        pipelines.disaster_layers(k, b, files.union(spark.createDataFrame([("r.xml", "2", "深い")], files.schema)), types, 2)


def test_geodesics_and_shapes():
    d = shapes.geodesic(np.array([139.0, 139.0]), np.array([35.0, 35.0]), np.array([140.0, 139.0]), np.array([35.0, 36.0]))
    assert abs(d[0] - 91287.8) < 1 and abs(d[1] - 110950.3) < 15
    area = shapes.geodesic_area(SQUARE[:4])
    assert abs(area - 91.288 * 110.94) / area < 2e-3
    horse = [(0, 0), (4, 0), (4, 4), (3, 4), (3, 1), (1, 1), (1, 4), (0, 4)]
    x, y = shapes.inside_point(horse)
    assert (0 < x < 1 or 3 < x < 4) and 1 < y < 4 or y < 1
    assert shapes.overlap_area(horse, [(1, 1), (3, 1), (3, 4), (1, 4)]) == 0
    assert math.isclose(shapes.overlap_area(horse, [(0, 0), (2, 0), (2, 2), (0, 2)]), 3.0)
    assert len(shapes.polygonize([[(0, 0), (1, 0)], [(1, 1), (1, 0)], [(1, 1), (0, 0)], [(5, 5), (6, 6)]])) == 1


def test_centroid_and_bounds(spark):
    df = spark.createDataFrame([(ring([(0.0, 0.0), (2.0, 0.0), (2.0, 1.0), (0.0, 1.0)]),)], "rings array<array<struct<x:double,y:double>>>")
    r = df.select(shapes.centroid(F.get("rings", F.lit(0))).alias("c"), shapes.bounds(F.col("rings")).alias("b"), shapes.representative_point("rings").alias("p")).first()
    assert (r.c.x, r.c.y, r.b.xmax, r.p.y) == (1.0, 0.5, 2.0, 0.5)


def test_markup(spark):
    page = "<dl><dt>所在地</dt><dd>霞浜区<br>1-2</dd></dl><table><tr><th>電話</th><td>03 &amp; 04</td></tr></table><a href='/x'>案内</a>"
    assert markup.html_pairs(page) == [("所在地", "霞浜区 1-2"), ("電話", "03 & 04")] and markup.html_links(page) == [("/x", "案内")]
    assert spark.createDataFrame([(page,), (None,)], "p string").select(F.size(markup.labelled_values("p")).alias("n")).agg(F.sum("n")).first()[0] == 2
    assert markup.structured_address(json.dumps({"@graph": [{"address": {"addressLocality": "霞浜区", "streetAddress": "1-2"}}]})) == "霞浜区1-2"
    layouts = [[{"result": {"lon": "139.5", "lat": 35, "score": 0.9, "level": "town"}}], {"features": [{"properties": {"score": 0.9, "match_level": "town"}, "geometry": {"coordinates": [139.5, 35]}}]}, {"longitude": 139.5, "latitude": 35, "score": "0.9", "level": "town"}]
    assert {markup.geocoded(json.dumps(x)) for x in layouts} == {(139.5, 35.0, 0.9, "town")} and markup.geocoded("{")[0] is None
    base = '<a:M xmlns:a="u"><a:x>1</a:x><a:y>2</a:y></a:M>'
    d = [markup.member_digests(m, ("src",)) for m in (base, base.replace("<a:x>", "<a:src>q</a:src><a:x>"), base.replace("a:", "b:").replace(':a="u"', ':b="v"'), '<a:M xmlns:a="u"><a:y>2</a:y><a:x>1</a:x></a:M>')]
    assert d[0]["metadata_digest"] == d[1]["metadata_digest"] and d[0]["digest"] != d[1]["digest"]
    assert d[0]["name_digest"] == d[2]["name_digest"] and d[0]["name_digest"] != d[3]["name_digest"] and d[0]["multiset_digest"] == d[3]["multiset_digest"]


def test_review(spark):
    occ = spark.createDataFrame([("g", "a.gml", "d1", "m1", "s1", 1), ("g", "b.gml", "d2", "m1", "s1", 2), ("g", "c.gml", "d3", "m3", "s1", 0), ("g", "d.gml", "d4", "m4", "s4", 9), ("h", "a.gml", "d", "m", "s", 0)], "id string, src string, digest string, metadata_digest string, multiset_digest string, n int")
    got = {r.src: (r.resolution, r.preferred) for r in review.duplicate_ladder(occ, "id", [F.col("src")], [("digest", "identical"), ("metadata_digest", "metadata_only"), ("multiset_digest", "order_only")], "n").collect()}
    assert got == {"b.gml": ("metadata_only", "later"), "c.gml": ("order_only", "first"), "d.gml": ("unresolved", None)}
    pick = review.preferred_scan(occ, "id", occ.filter("src = 'c.gml'"), occ.filter("src = 'd.gml'"), "src")
    assert {r.id: r.src for r in pick.collect()} == {"g": "c.gml", "h": "a.gml"}
    index, conflicts = review.review_index(occ, "id", "digest", [F.col("src")])
    assert [r.id for r in index.collect()] == ["h"] and [r.id for r in conflicts.collect()] == ["g"]
    audit = spark.createDataFrame([("e1",), ("e2",)], "entity_id string")
    near = spark.createDataFrame([("e1", "b1"), ("e1", "b2")], "entity_id string, building_gml_id string")
    schema = "entity_id string, human_decision_type string, human_selected_building_ids string"
    good = spark.createDataFrame([("e1", "multiple_buildings_human_selected", "b1; b2")], schema)
    assert {r.entity_id: r.review_applied for r in review.apply_decisions(audit, good, near).collect()} == {"e1": 1, "e2": 0}
    bad = spark.createDataFrame([("e9", "no_building", ""), ("e1", "?", ""), ("e2", "single_building_human_selected", ""), ("e1", "multiple_buildings_human_selected", "b7")], schema)
    assert {r.problem for r in review.invalid_decisions(bad, audit, near).collect()} == {"unknown entity", "repeated entity", "unknown decision", "confirmed without building", "fewer than two buildings", "building outside the neighbourhood"}
    with pytest.raises(ValueError):
        review.apply_decisions(audit, bad, near)
    spaces = spark.createDataFrame([("s", 3, 1, None, None, "yes", "x"), ("t", 1, 2, 0.0, 1.0, "no", "confirmed")], "space_id string, floor_min int, floor_max int, floor_elevation_min_m double, floor_elevation_max_m double, is_basement string, presence_status string")
    assert {(r.space_id, r.problem) for r in review.invalid_spaces(spaces).collect()} == {("s", "floors reversed"), ("s", "basement above ground"), ("s", "unknown presence")}


def test_levels_roles_and_names(spark):
    at = lambda c: spark.range(1).select(c).first()[0]
    assert at(C.stated_level(F.lit("霞浜区登録・国宝"), F.lit("霞浜区")))["reason"] == "explicit_municipal_keyword"
    assert at(C.stated_level(F.lit("?"), F.lit(None), F.lit("national")))["reason"] == "configured_default"
    assert at(C.element_role(F.create_map(F.lit("building"), F.lit("yes")), F.lit("way"), F.lit(True), F.lit(False))) == "facility_building"
    assert at(C.municipality_evidence(F.lit("霞浜区"), F.lit("白磯区"))) == "conflict"
    assert tuple(at(C.tsunami_parts(F.lit("区部_元禄_津波高CSV")))) == ("区部", "元禄", "height")
    assert at(C.layer_kind(F.lit("hazard_flood_x"), {"hazard_": "any", "hazard_flood": "water"})) == "water"
    assert at(C.address_evidence(F.lit("東瀬都霞浜区1-2"), F.lit("霞浜区"), "東瀬都", F.lit(True), F.lit(None), F.lit(False), F.lit(True), F.lit(False), F.lit(True))) == 130
    with pytest.raises(ValueError):
        C.mapped_class(F.lit("x"), {"a": "b"}, {"c": "d"}, "c")


def test_record_depth_classes_sends_no_repeated_rows_to_the_driver(spark):
    from kuramori.plans.catalogue import record_depth_classes

    plan = record_depth_classes(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [_gx" in plan and "BroadcastHashJoin [_gx" not in plan


def test_point_hazard_broadcasts_nothing_when_it_runs(spark):
    at = [(1, 139.0, 35.0, True), (1, 139.1, 35.0, True), (1, 139.1, 35.0, True), (2, 139.2, 35.0, True), (3, 139.0, 35.0, False), (4, None, None, False), (None, 139.0, 35.0, True)]
    points = [(139.0, 35.0, 0.2), (139.0001, 35.0, 9.0), (139.1, 35.00005, 4.0), (139.1, 35.00005, None), (139.2, 35.001, 1.0)]
    df = pipelines.point_hazard(spark.createDataFrame(at, "k long, x double, y double, located boolean"), spark.createDataFrame(points, "lon double, lat double, depth double"), "k", "depth", C.depth_class(F.col("value")))
    assert sorted(((r.k, r.value, r["class"]) for r in df.collect()), key=str) == [(1, 4.0, "3–5 m"), (2, None, "No data"), (3, None, "No data"), (4, None, "No data"), (None, None, "No data")]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in plan and "Broadcast" not in plan
