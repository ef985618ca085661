from kuramori.llm.canonical import UNMATCHED, Matcher, map_values, reference_entries

REF = [("temple", "仏堂建築", "ぶつどうけんちく", "temple halls", "寺院;堂"), ("map", "絵図古地図", "えずこちず", "old maps", "村絵図"), ("pot", "陶磁器類", "とうじきるい", "ceramics", "焼物")]


def entries(spark):
    ref = spark.createDataFrame(REF, "code string, ja string, kana string, en string, aliases string")
    return reference_entries(ref, "code", ["ja", "kana", "en"], ["aliases"])


def test_values(spark):
    m = Matcher(entries(spark))
    expected = {
        "temple": ["仏堂建築", " 仏堂建築\t", "区指定仏堂建築", "仏堂建築、附図面", "建築／仏堂", "仏建堂築", "仏鬱建築", "ブツドウケンチク", "ぶつどけうんちく", "TEMPLE HALLS", "temmple halls", "templehalls", "寺院", "堂", "有形・仏堂建築 3点"],
        "pot": ["陶鬱器類", "陶磁器類"],
        UNMATCHED: ["", None, "   ", "その他", "会議室12", "1975/5/1", "朝霧区教育委員会", "* unknown", "?" * 30_000],
    }
    for code, values in expected.items():
        for v in values:
            assert m.match(v)[0] == code, v


def test_longest_mention_and_ties():
    m = Matcher([("a", "古地図"), ("b", "絵図古地図"), ("c", "甲乙丙"), ("d", "丙乙甲")])
    assert m.match("都選定絵図古地図")[0] == "b"
    assert m.match("乙甲丙")[0] == UNMATCHED  # equally like two entries
    assert Matcher([]).match("x")[0] == UNMATCHED


def test_table(spark):
    df = spark.createDataFrame([(1, "仏堂建築", "clash"), (1, "仏堂建築", "clash"), (2, None, None)], "obs_id long, raw_value string, score string")
    got = map_values(df, "raw_value", entries(spark)).select("obs_id", "match.code").collect()
    assert sorted(map(tuple, got)) == [(1, "temple"), (1, "temple"), (2, UNMATCHED)]
    assert map_values(df.limit(0), "raw_value", entries(spark)).count() == 0
