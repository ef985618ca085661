import random

import pytest

from kuramori.llm.mojibake import Model, fit, restore, restored_documents, stretches

JA = ["台帳の写しは三通あり、うち一通に朱印が押されている。", "欠けた部分は同じ産地の土で補い、色だけをわずかに変えてある。", "座標は字の中心を示すもので、建物そのものの位置ではない。", "修理には長い年月を要し、費用の半分を町が補助した。", "表面に細かなひびがあり、展示を控えている。★☆◆ 〒 ※印は未確認。", "ﾃｲﾚﾎﾟｼﾞｼｮﾝ ﾊ ﾐﾃｲ ﾃﾞｽ｡"]
EN = ["The façade was repainted, but the south wall still shows the old colour.", "Between the road and the pond there’s a drop.", "School groups — up to many children — may handle the copies.", "The naïve restoration used cement, which has since been taken out."]
DE = ["Die Prüfung ergab größere Risse über der Tür.", "Der Schlüssel hängt im Büro, gleich neben dem Türrahmen.", "MASSE: Höhe und Länge unbekannt."]


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(4)
    out = []
    for lang, sentences in (("ja", JA), ("en", EN), ("de", DE)):
        out += [(lang, "\n".join(rng.choice(sentences) + str(rng.randrange(99)) for _ in range(rng.randrange(2, 9)))) for _ in range(250)]
    return out


@pytest.fixture(scope="module")
def model(spark, corpus):
    docs = spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(corpus)], "doc_id long, text string, lang string")
    dictionaries, seen = fit(docs)
    from collections import Counter

    return Model(dictionaries, Counter(seen))


def damaged(text, right, wrong):
    return text.encode(right).decode(wrong)


@pytest.mark.parametrize("text,right,wrong", [(JA[0], "utf-8", "latin-1"), (JA[1], "utf-8", "mac_roman"), (JA[2], "cp932", "latin-1"), (EN[0], "utf-8", "cp1252"), (EN[1], "utf-8", "cp1251"), (EN[2], "utf-8", "cp437"), (DE[0], "utf-8", "cp1252"), (DE[1], "utf-8", "cp932")])
def test_round_trip(model, text, right, wrong):
    assert restore(damaged(text, right, wrong), model)[0] == text
    mixed = JA[3] + damaged(text, right, wrong) if text in JA else text
    assert restore(mixed, model)[0] in (JA[3] + text, text)


def test_double_damage(model):
    twice = damaged(damaged(EN[0], "utf-8", "latin-1"), "utf-8", "latin-1")
    assert restore(twice, model)[0] == EN[0]


def test_clean_text_is_left_alone(model, corpus):
    for t in ["Надпись на ящике: «ящик 35, музей»", "Ώρα 4, κουτί 76.", "SÃO e ÃO aparecem", "┌──┬──┐│62│8│└──┴──┘", "ÂGE ET ÉTAT : à vérifier", None, "", "plain"] + [x for _, x in corpus[:200]]:
        assert restore(t, model)[2] == "clean", t


def test_lost_text_is_reported(model):
    assert restore(JA[0].encode("cp932").decode("utf-8", "replace"), model)[2] == "lost"
    assert stretches("caf� à", "cp1252", "utf-8") == []


def test_table(spark, corpus):
    rows = [(i, t, lang) for i, (lang, t) in enumerate(corpus)] + [(9000, damaged(JA[0] * 400, "utf-8", "latin-1"), None), (9001, None, "ja"), (9002, "", "ja")]
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, lang string, status string")
    got = restored_documents(docs).collect()
    assert [(r.doc_id, r.status, r.restored == JA[0] * 400) for r in got] == [(9000, "restored", True)]
    assert restored_documents(docs.limit(0)).count() == 0


def test_copies_do_not_fill_the_sample(spark, corpus, monkeypatch):
    from kuramori.llm import mojibake

    rows = [t for lang, t in corpus if lang == "de"]
    hashed = spark.createDataFrame([(t,) for t in rows], "t string").selectExpr("t", "xxhash64(t) as h").distinct().orderBy("h").collect()
    first = hashed[0].t  # the text whose copies come first in hash order
    late = "x" * 10_000 + "\nDie Öße ist ňur hier."
    docs = spark.createDataFrame([(i, t, "de") for i, t in enumerate([first] * 3000 + rows + [late])], "doc_id long, text string, lang string")
    sampled: list[bytes] = []
    monkeypatch.setattr(mojibake.zstandard, "train_dictionary", lambda size, lines: sampled.extend(lines) or (_ for _ in ()).throw(mojibake.zstandard.ZstdError("kept")))
    _, seen = fit(docs)
    assert any("ňur".encode() in x for x in sampled) and len({x for x in sampled}) > 50
    assert seen["ň"] == 1 and set("".join(rows)) <= set(seen)
    assert seen["D"] <= sum(t.count("D") for t in set(rows) | {late})


def test_residue_of_escape_sequences(model):
    line = "台帳の写しは三通あり、うち一通に朱印が押されている。"
    raw = line.encode("iso2022_jp").decode("ascii")
    for damaged in (raw, raw.replace("\x1b", "")):
        assert restore(damaged, model)[:1] + restore(damaged, model)[2:] == (line, "restored")
    for clean in ("Costs $B12 (B) or $Bill (J)", "a $B b", ""):
        assert restore(clean, model)[2] == "clean"
