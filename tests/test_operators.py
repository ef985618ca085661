import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kuramori.functions import classes as C
from kuramori.functions import text as X
from kuramori.operators import lookup, tables
from kuramori.operators.components import connected_components
from kuramori.operators.dedupe import best_row, one_per_key, ranked


def one(spark, expr, **columns):
    kinds = {str: "string", float: "double", int: "long", bool: "boolean"}
    schema = ", ".join(f"{k} {kinds.get(type(v), 'string')}" for k, v in columns.items()) or "z int"
    return spark.createDataFrame([tuple(columns.values()) or (0,)], schema).select(expr).first()[0]


@pytest.mark.parametrize("x,label", [(None, "No data"), (float("nan"), "No data"), (-1.0, "0"), (0.0, "0"), (0.49, "0–0.5 m"), (0.5, "0.5–3 m"), (3.0, "3–5 m"), (5.0, "5 m以上")])
def test_depth_class(spark, x, label):
    assert spark.createDataFrame([(x,)], "x double").select(C.depth_class(F.col("x"))).first()[0] == label


@pytest.mark.parametrize("x,label", [(None, ""), (float("inf"), ""), (0.0, "0"), (0.5, "0–0.5 m"), (3.0, "0.5–3 m"), (5.0, "3–5 m"), (5.1, "5 m以上")])
def test_depth_class_map(spark, x, label):
    assert spark.createDataFrame([(x,)], "x double").select(C.depth_class_map(F.col("x"))).first()[0] == label


def test_other_classes(spark):
    seismic = [C.seismic_class(F.lit(v)) for v in (4.49, 4.5, 5.0, 5.5, 6.0)]
    assert list(spark.range(1).select(*seismic).first()) == ["5弱未満", "5弱", "5強", "6弱", "6強以上"]
    assert list(spark.range(1).select(*[C.liquefaction_class(F.lit(v)) for v in (0.0, 5.0, 15.0, 15.1)]).first()) == ["PL=0", "0<PL≤5", "5<PL≤15", "PL>15"]
    assert list(spark.range(1).select(*[C.rank_category(F.lit(v)) for v in ("", "1", "3.0", "6", "x")]).first()) == ["0", "0–0.5 m", "3–5 m", "5 m以上", "0"]
    assert list(spark.range(1).select(C.metres(F.lit(250.0), F.lit("cm")), C.metres(F.lit(1.0), F.lit("ft")), C.hours(F.lit(90.0), F.lit("min"))).first()) == [2.5, None, 1.5]
    assert spark.range(1).select(C.least_confidence(F.array(F.lit("high"), F.lit("medium"), F.lit("?")))).first()[0] == "medium"


def test_normalisers(spark):
    assert one(spark, X.text(F.col("a")), a="  ｱ　\tB  ") == "ア B"
    assert one(spark, X.text(F.col("a")), a=5.0) == "5"
    assert one(spark, X.name_key(F.col("a")), a="宗教法人 霞ヶ関・ＡＢ（寺）") == "霞ケ関ab寺"
    assert one(spark, X.address_key(F.col("a")), a="大手町１丁目２番３号") == "大手町1-2-3"
    assert one(spark, X.address_key(F.col("a")), a="東京ドーム1ー3") == "東京ドーム1-3"
    assert one(spark, X.site_address_key(F.col("a"), "東瀬都"), a="東瀬都霞浜区1-2-3 ビル5F") == "霞浜区1-2-3"
    assert one(spark, X.site_label(F.col("a")), a="浅草寺境内") == "浅草寺"
    assert one(spark, X.id_text(F.col("a")), a="000120.0") == "120"
    assert one(spark, X.municipality_code(F.col("a")), a="1390.0") == "01390"
    assert one(spark, X.number(F.col("a")), a="1,234.5") == 1234.5
    assert one(spark, X.url_host(F.col("a")), a="https://www.Example.jp/x") == "example.jp"
    assert one(spark, X.sanitised_address(F.col("a"), ["電話", "TEL"]), a="霞浜1-2 TEL 03") == "霞浜1-2"


def test_cascade_rules_and_codes(spark):
    ref = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("b", "y", 3)], "k1 string, k2 string, v int")
    df = spark.createDataFrame([(1, "b", "z"), (2, "a", "x"), (3, "a", "y"), (4, None, "")], "id long, k1 string, k2 string")
    got = {r.id: (r.v, r.matched_by) for r in lookup.unique_key_cascade(df, ref, [("k1",), ("k2",)], ["v"]).collect()}
    assert got == {1: (3, 1), 2: (1, 2), 3: (None, None), 4: (None, None)}
    rules = spark.createDataFrame([("b", 1, "B"), ("[", 0, "broken"), ("a.c", 2, "AC")], "p string, n int, out string")
    texts = spark.createDataFrame([("abc",), ("axc",), (None,)], "t string")
    assert [r.out for r in lookup.first_matching_rule(texts, "t", rules, "p", ["n"], "out", regex=True).collect()] == ["B", "AC", None]


def test_merge_upsert_and_conflicts(spark):
    a = spark.createDataFrame([("k", None, "a"), ("l", 1.0, "a")], "id string, v double, src string")
    b = spark.createDataFrame([("k", 2.0, "b"), ("m", None, "b")], "id string, v double, src string")
    ok = F.col("v").isNotNull()
    assert {r.id: (r.v, r.src) for r in lookup.priority_merge([(a, ok), (b, ok)], ["id"], ["v", "src"]).collect()} == {"k": (2.0, "b"), "l": (1.0, "a"), "m": (None, "b")}
    assert {r.id: r.v for r in lookup.upsert(a, b, ["id"]).collect()} == {"k": 2.0, "l": 1.0, "m": None}
    c = spark.createDataFrame([("k", 2, "x"), ("k", 2, "y"), ("k", 1, "z")], "id string, p int, a string")
    r = lookup.best_with_conflict(c, "id", "p", "a").first()
    assert (r.a, r.candidates, r.conflict) == ("x", 2, True)
    with pytest.raises(ValueError):
        lookup.assert_none(c, "rows")


def test_tables(spark):
    df = spark.createDataFrame([("r", "a"), ("r", "a"), ("r", "q"), (None, None)], "k string, v string")
    got = {r.k: (r.a, r.b, r.unlisted, r.Total) for r in tables.crosstab(df, ["k"], "v", ["a", "b"]).collect()}
    assert got == {"r": (2, 0, 1, 3), None: (0, 0, 1, 1)}
    assert tables.crosstab(df.limit(0), ["k"], "v", ["a"]).count() == 0
    p = spark.createDataFrame([("g", 2, "y"), ("g", 1, "x"), ("g", 3, "x"), ("g", 4, " ")], "k string, o int, v string")
    assert p.groupBy("k").agg(tables.ordered_unique(F.col("v"), F.col("o")).alias("u"), tables.sorted_unique(F.col("v")).alias("s")).first()[1:] == ("x;y", "x;y")
    s = tables.slots(p, "k", [F.col("o")], ["v"], 2).first()
    assert (s.slots, s.risk01_v, s.risk02_v) == (4, "x", "y")


def test_dedupe(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 2), (2, None, None), (2, None, None)], "k long, v string, o int")
    assert sorted((r.k, r.v) for r in best_row(df, ["k"], [F.col("o"), F.col("v")]).collect()) == [(1, "a"), (2, None)]
    assert one_per_key(df, ["k"]).count() == 2
    assert ranked(df, ["k"], [F.col("v")], 1).count() == 2


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 25), st.integers(0, 25)), max_size=40))
def test_components_against_union_find(spark, edges):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    df = spark.createDataFrame(edges, "a long, b long")
    assert {r.node: r.component for r in connected_components(df, "a", "b").collect()} == {n: find(n) for n in root}


def test_selections(spark):
    from kuramori.operators import selection as S

    df = spark.createDataFrame([("a", "x", 80), ("a", "x", 10), ("b", "x", 80), ("b", "y", 80), ("c", "x", 69), ("d", None, 99)], "k string, v string, s int")
    assert {r.k: (r.v, r.status) for r in S.best_or_review(df, "k", "v", "s").collect()} == {"a": ("x", "accepted"), "b": ("x", "tie"), "c": ("x", "below_threshold")}
    y = spark.createDataFrame([("a", 2020, "p"), ("a", 2021, "r"), ("a", 2021, "q"), ("b", None, "z")], "k string, y int, n string")
    assert {r.k: r.n for r in S.latest(y, "k", "y", [F.col("n")]).collect()} == {"a": "q", "b": "z"}
    t = spark.createDataFrame([(1, " "), (2, "ab"), (3, "abc"), (4, "xyz")], "o int, v string")
    assert tuple(t.agg(S.first_or_longest(F.col("v"), F.col("o")), S.first_or_longest(F.col("v"), F.col("o"), True)).first()) == ("ab", "abc")
    assert t.filter("o = 1").agg(S.first_or_longest(F.col("v"), F.col("o"))).first()[0] == ""
    kinds = spark.createDataFrame([(1, "museum"), (2, "art"), (3, "history")], "o int, v string")
    assert kinds.agg(S.facility_type(F.col("v"), F.col("o"))).first()[0] == "art" and kinds.limit(0).agg(S.facility_type(F.col("v"), F.col("o"))).first()[0] == "museum"
    wet = spark.createDataFrame([(0.5, "0"), (0.0, "1"), (-9999.0, "2"), (None, None)], "d double, r string")
    assert S.positive_hazard(wet, "d", "r").count() == 2
    assert S.one_name(df, "v", "x") == "x" and S.area_code("13905") == ("municipality", "13905")
    for bad in ("1390", "99001", "x"):
        with pytest.raises(ValueError):
            S.area_code(bad)
    with pytest.raises(ValueError):
        S.one_name(df, "v", "q")
    assert S.without_columns(df, "k|s").columns == ["v"] and S.with_columns(df, ["k", "new"]).columns == ["k", "v", "s", "new"]
    lists = spark.createDataFrame([("2; 1", ""), ("9", "own")], "ids string, name string")
    r = spark.createDataFrame([(1, "一"), (2, "二"), (9, "九")], "id long, name string")
    assert {x.ids: x.name for x in S.backfilled(lists, "ids", r, "id", ["name"]).collect()} == {"2; 1": "二;一", "9": "own"}
    box = S.box_around(139.0, 35.0, 1.0)
    p = spark.createDataFrame([(139.0, 35.0), (139.2, 35.0)], "x double, y double")
    assert S.near_extent(p, box, ("x", "y")).count() == 1 and S.near_extent(p, None, ("x", "y")).count() == 2
    assert S.in_bounds(p, p.limit(0), ("x", "y"), ("x", "y")).count() == 0


def test_numbering_of_a_hot_group(spark):
    from kuramori.operators.tables import numbered

    rows = [("hot" if i % 2 else None if i % 7 == 0 else f"g{i % 5}", i) for i in range(3000)]
    got = numbered(spark.createDataFrame(rows, "g string, o int"), "g", "o").collect()
    by = {}
    for g, o in rows:
        by.setdefault(g, []).append(o)
    assert {(r.g, r.o): r.number for r in got} == {(g, o): k for g, os in by.items() for k, o in enumerate(sorted(os), 1)}
    assert numbered(spark.createDataFrame([], "g string, o int"), "g", "o").count() == 0


def test_cartesian_crosstab_refuses_large_keys(spark):
    from kuramori.operators.tables import crosstab_cartesian

    df = spark.createDataFrame([(i, i % 2, "x") for i in range(20)], "a int, b int, c string")
    assert crosstab_cartesian(df, "a", "b", "c", ["x"]).count() == 40
    with pytest.raises(ValueError):
        crosstab_cartesian(df, "a", "b", "c", ["x"], most=10)


def test_cluster_without_shared_folder_is_refused():
    from types import SimpleNamespace

    from kuramori.session import ensure_checkpoint_dir

    context = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    with pytest.raises(ValueError):
        ensure_checkpoint_dir(SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda k, default: default)))
