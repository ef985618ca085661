import difflib
import random

from kuramori.operators import similar
from kuramori.plans import catalogue, pipelines
from pyspark.sql import functions as F


def ratio(a, b):
    return difflib.SequenceMatcher(None, a, b).ratio()


def names():
    rng = random.Random(2)
    stems = ["".join(rng.choice("桐梅楠榎沢沼洲浦淵滝aab") for _ in range(rng.randrange(1, 9))) for _ in range(60)]
    a = [s + rng.choice(["美術館", "科学館", "植物園", ""]) for s in stems]
    b = [rng.choice([x, "市立" + x, x[1:], x[:1] + x, x[3:] + x[:3], "丘".join(x), x + "別館"]) for x in a]
    a += ["鹿鳴市立照神滝雨楓科学館", "静織瀬植物園輝瑞", "abcd", "x" * 50 + "y", None, ""]
    b += ["照神滝雨楓科学館", "輝瑞静織瀬植物園", "azbzczd", "x" * 49, None, ""]
    return a, b


def test_similar_pairs_equal_brute_force(spark):
    a, b = names()
    got = similar.similar_pairs(spark.createDataFrame([(x,) for x in a], "a string"), spark.createDataFrame([(x,) for x in b], "b string"), "a", "b").collect()
    truth = {(x, y) for x in a for y in b if x and y and ratio(x, y) >= 0.72}
    assert len(got) == len(truth) and {(r.a, r.b) for r in got} == truth


def test_contained_pairs_equal_brute_force(spark):
    a, b = names()
    got = similar.contained_pairs(spark.createDataFrame([(x,) for x in a], "a string"), spark.createDataFrame([(x,) for x in b], "b string"), "a", "b").collect()
    truth = {(x, y) for x in a for y in b if x and y and min(len(x), len(y)) >= 4 and (x in y or y in x)}
    assert len(got) == len(truth) and {(r.a, r.b) for r in got} == truth


def test_similar_names_over_municipalities_and_first_letters(spark, monkeypatch):
    a, b = names()
    m = spark.createDataFrame([(f"m{i}", x, "甲市") for i, x in enumerate(a)], "museum_id string, facility_name string, municipality_name string")
    e = spark.createDataFrame([(i, x, None if i % 2 else "乙市") for i, x in enumerate(b)], "osm_id long, osm_name string, addr_city string")
    monkeypatch.setattr(catalogue.V, "listings", lambda *_: m)
    monkeypatch.setattr(catalogue.V, "elements", lambda *_: e)
    got = {(r.museum_id, r.osm_id) for r in catalogue.similar_names(spark, "").collect()}
    key = lambda df, c, k: df.select(k, catalogue.X.facility_key(F.col(c)).alias("n")).collect()
    assert got == {(x[0], y[0]) for x in key(m, "facility_name", "museum_id") for y in key(e, "osm_name", "osm_id") if x.n and y.n and ratio(x.n, y.n) >= 0.72}


def test_audit_by_names_keeps_every_listing(spark):
    m = [
        ("exact", "桐磯美術館", "甲市", "none", 139.0, 35.0), ("nowhere", "桐磯美術館", "甲市", "none", None, None), ("impossible", "桐磯美術館", "乙市", "building_candidate", 0.0, 0.0),
        ("swapped", "静織瀬植物園輝瑞", "甲市", "none", 139.0, 35.0), ("inside", "沢神洲科学館", "甲市", "none", 139.0, 35.0), ("none", "何もない庫", "甲市", "none", 139.0, 35.0),
    ]
    e = [
        (1, "way", "桐磯・美術館", 139.005, 35.0, "甲市", None, "museum", None, None), (2, "node", "桐磯美術館", 139.0055, 35.0, None, None, "museum", None, None),
        (3, "node", "輝瑞静織瀬植物園", 140.5, 35.0, None, None, "museum", None, None), (4, "node", "市立沢神洲科学館分館別棟収蔵庫", None, None, "丙市", None, None, None, None),
    ]
    listings = spark.createDataFrame(m, "museum_id string, facility_name string, municipality_name string, coordinate_use string, longitude double, latitude double")
    elements = spark.createDataFrame(e, "osm_id long, osm_type string, osm_name string, x double, y double, addr_city string, addr_full string, tourism string, amenity string, website string")
    got = {r.museum_id: (r.status, r.osm_id, r.candidates, r.facilities, r.score) for r in pipelines.facility_audit(listings, elements).collect()}
    assert got == {
        "exact": ("matched", 1, 2, 1, 140), "nowhere": ("matched", 1, 2, 1, 120), "impossible": ("review", 1, 2, 1, 0),
        "swapped": ("review", 3, 1, 1, 25), "inside": ("review", 4, 1, 1, -30), "none": ("no_candidate", None, 0, 0, None),
    }
