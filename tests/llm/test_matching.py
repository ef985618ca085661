import numpy as np
from pyspark.sql import functions as F

from kuramori.llm import matching

TOWNS = [("13901", "霞浜区", "Kasumihama", "桐磯", "Kiriiso", "910-0001"), ("13902", "桐ノ瀬区", "Kirinose", "藤桐台", "Fujikiri-dai", "911-0001")]
M = "museum_id string, facility_name string, municipality_code string, municipality_name string, address_raw string, address_normalized string, postal_code string, longitude double, latitude double, score string"
O = "osm_id string, osm_name string, addr_city string, addr_full string, lon double, lat double, amenity string, score string"


def tables(spark):
    kanji = "丘久亀兎冬剣原和嵐嶺峠岬常幸弓慶昼暁月朝松林柳桂桐梅楠榎沢沼洲浦淵清湊滝潟瀬照狐玉琴瑞"
    rng = np.random.default_rng(3)
    stems = ["".join(rng.choice(list(kanji), 5)) for _ in range(60)]
    m, o, truth = [], [], set()
    for i, s in enumerate(stems):
        lon, lat = 139 + i / 100, 35 + (i % 7) / 50
        m.append((f"m{i}", s + "美術館", "13901", "霞浜区", f"霞浜区桐磯{i % 9 + 1}-{i}-1", None, None, lon, lat, "x"))
        variants = [s + "美術館", s[:4] + "濤美術館", s[2:] + "美術館 (" + s[:2] + ")", "美術館・" + s, s[1] + s[0] + s[2:] + "美術館", s + "美術ミュージアム"]
        o.append((f"{i}", variants[i % 6], "霞浜区" if i % 2 else None, None if i % 3 else f"霞浜区桐磯{i % 9 + 1}丁目{i}番1号", lon + 0.0003, lat, None, None))
        truth.add((f"m{i}", f"{i}"))
    o += [("900", stems[0] + "美術館駐車場", "霞浜区", None, 139.0, 35.0, "parking", None), ("901", stems[1] + "美術館分館", "霞浜区", None, 139.01, 35.02, None, None), ("902", None, None, None, None, None, None, None), ("903", stems[2] + "美術館", "桐ノ瀬区", None, None, None, None, None), ("904", None, None, None, 139.05, 35.1, None, None)]
    truth.add(("m5", "904"))
    m += [("m0", *m[0][1:]), ("mx", None, None, None, None, None, None, None, None, None)]
    return m, o, truth


def features(spark, m, o):
    mc = {"id": "museum_id", "name": "facility_name", "city_code": "municipality_code", "city_name": "municipality_name", "address": "address_raw", "address2": "address_normalized", "postal": "postal_code", "lon": "longitude", "lat": "latitude"}
    oc = {"id": "osm_id", "name": "osm_name", "city_name": "addr_city", "address": "addr_full", "lon": "lon", "lat": "lat", "use": "amenity"}
    return matching.features(spark.createDataFrame(m, M), "m", mc, TOWNS), matching.features(spark.createDataFrame(o, O), "o", oc, TOWNS)


def test_matches(spark):
    m, o, truth = tables(spark)
    got = matching.match(*features(spark, m, o)).collect()
    pairs = {(r.m_id, r.o_id) for r in got}
    assert len(pairs) == len(got) and pairs <= truth and len(pairs & truth) >= 0.95 * len(truth)
    assert all(0 < r.confidence <= 1 for r in got)


def test_walks_are_bounded(spark):
    m, o, _ = tables(spark)
    a, b = features(spark, m, o)
    longest = max(len(r.walk) for r in matching.walks(a.union(b)).collect())
    assert 0 < longest <= matching.STEPS + 3


def test_calibration_is_monotone():
    x = np.linspace(-1, 1, 400)
    slope, offset = matching.calibrate(x, (x > 0.3).astype(float))
    assert slope > 0 and 1 / (1 + np.exp(-(slope * 0.9 + offset))) > 0.9


def test_strict_keys_lose_no_acceptable_pair(spark, monkeypatch):
    m, o, _ = tables(spark)
    a, b = features(spark, m, o)
    ms, os_ = a.collect(), b.filter("not served").collect()
    rng = np.random.default_rng(8)
    fields = ("city", "strict", "core", "short", "town", "numbers", "lon", "lat")
    as_pair = lambda x, y: {f"{s}_{c}": (float("nan") if v is None else v) for s, r in (("m", x), ("o", y)) for c in fields for v in (r[c],)}
    vary = lambda r, **new: r.asDict() | new
    left = [vary(r) for r in ms] + [vary(r, town="") for r in ms[:20]] + [vary(r, lon=None, lat=None) for r in ms[:20]]
    right = [vary(r) for r in os_] + [vary(r, core="", strict="") for r in os_[:30]] + [vary(r, core=r.core[:3], short=True, lon=None, lat=None) for r in os_[:30]]
    right += [vary(r, lon=r.lon + d[0], lat=r.lat + d[1]) for r in os_ if r.lon is not None for d in (rng.uniform(-0.003, 0.003, 2),)]
    keys = lambda r, side: set(matching.strict_keys(side, *(r[c] for c in fields)))
    right_keys = [keys(y, "o") for y in right]
    accepted = 0
    for x in left:
        own = keys(x, "m")
        for y, k in zip(right, right_keys):
            if matching.pair_score(as_pair(x, y)) > 0:
                accepted += 1
                assert own & k, (x, y)
    assert accepted > 150
    # with hash tables that find nothing, the matches are the same
    full = {(r.m_id, r.o_id) for r in matching.match(a, b).collect()}
    monkeypatch.setattr(matching, "candidates", lambda e, *_: e.selectExpr("h as m_h", "h as o_h").limit(0))
    assert {(r.m_id, r.o_id) for r in matching.match(a, b).collect()} == full and full


def test_hash_tables_list_no_pair_that_cannot_score(spark):
    m, o, _ = tables(spark)
    a, b = features(spark, m, o)
    rng = np.random.default_rng(5)
    moved = lambda r: {"lon": 139 + (r.lon - 139) / 20 + rng.uniform(-0.001, 0.001), "lat": 35 + (r.lat - 35) / 20} if r.lon is not None else {}
    ms, os_ = [r.asDict() | moved(r) for r in a.collect()], [r.asDict() | moved(r) for r in b.filter("not served").collect()]
    os_ += [r | {"core": "", "strict": ""} for r in os_[:30]] + [r | {"core": r["core"][:3], "short": True} for r in os_[:30]] + [r | {"core": r["core"][1:-1]} for r in os_[:30]]
    ms += [r | {"core": r["core"][-3:], "short": True} for r in ms[:30]]
    rows = [r | {"side": s, "h": i, "buckets": [(v << 58) for v in (0, 1)]} for i, (s, r) in enumerate([("m", r) for r in ms] + [("o", r) for r in os_])]
    embedded = spark.createDataFrame([tuple(r[c] for c in (*a.columns, "h", "buckets")) for r in rows], matching.FIELDS + ", h long, buckets array<long>")
    got = {(r.m_h, r.o_h) for r in matching.candidates(embedded, "m", "o").collect()}
    fields = ("city", "strict", "core", "short", "town", "numbers", "lon", "lat")
    nan = lambda v: float("nan") if v is None else v
    lefts, rights = ([r for r in rows if r["side"] == s] for s in "mo")
    score = {(x["h"], y["h"]): matching.pair_score({f"{s}_{c}": nan(r[c]) for s, r in (("m", x), ("o", y)) for c in fields}) for x in lefts for y in rights}
    accepted = {k for k, v in score.items() if v > 0}
    assert len(accepted) > 100 and accepted <= got
    assert len(got) < 6 * len(accepted), (len(got), len(accepted))
