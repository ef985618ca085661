import random

import numpy as np
import pytest

from kuramori.llm import mixing, packing, tokens


def test_pack_respects_all_limits():
    rng = np.random.default_rng(1)
    sizes = np.column_stack([rng.integers(1, 100, 500), np.ones(500), rng.integers(0, 60, 500)]).astype(float)
    limits = np.array([100.0, 6.0, 60.0])
    home = packing.pack(sizes, limits)
    for b in set(home):
        assert (sizes[home == b].sum(axis=0) <= limits).all()
    assert sizes[:, 0].sum() / ((home.max() + 1) * 100) > 0.9
    assert list(packing.pack(np.empty((0, 3)), limits)) == []
    with pytest.raises(ValueError):
        packing.pack(np.array([[101.0, 1.0, 0.0]]), limits)


def test_pack_binds_in_every_dimension():
    rng = np.random.default_rng(4)
    tokens_ = rng.integers(5, 400, 600).astype(float)
    sizes = np.column_stack([tokens_, np.ones(600), tokens_ * rng.choice([0.3, 0.8, 1.0], 600)])
    lim = packing.Limits.of(2048)
    limits = np.array([lim.tokens, lim.segments, lim.loss_tokens], dtype=float)
    home = packing.pack(sizes, limits)
    fills = np.array([(sizes[home == b].sum(axis=0) / limits) for b in range(home.max() + 1)])
    assert fills.max() <= 1 and len(set(fills.argmax(axis=1))) >= 2
    # an item that bears more loss than allowed isn't split, and no other loss joins it
    home = packing.pack(np.array([[100.0, 1, 100], [20, 1, 20], [20, 1, 0]]), np.array([130.0, 5, 85]))
    assert home[0] == home[2] != home[1]


def test_fill_containers(spark):
    rng = random.Random(2)
    rows = [(i, "s", rng.randrange(1, 300), 0) for i in range(900)] + [(1000, "s", 2500, 2000), (1001, "s", 0, 0), (1002, "s", 512, 512)]
    sized = spark.createDataFrame([(a, b, c, min(c, d)) for a, b, c, d in rows], "doc_id long, source string, tokens long, loss_tokens long")
    boxes = spark.createDataFrame([("short", 512), ("long", 2048)], "container string, capacity_tokens int")
    out = packing.fill_containers(sized, boxes, "doc_id", shard=200).cache()
    for box, cap in (("short", 512), ("long", 2048)):
        own = out.filter(f"container = '{box}'")
        assert {r.doc_id for r in own.select("doc_id").distinct().collect()} == {a for a, _, c, _ in rows if c}
        assert own.groupBy("doc_id").agg({"tokens": "sum", "piece": "count"}).count() == own.select("doc_id").distinct().count()
        assert own.groupBy("bin").agg({"tokens": "sum"}).filter(f"`sum(tokens)` > {cap}").count() == 0
        assert own.filter(f"pieces > 1 and doc_id <> 1000").count() == 0
    r = {x.container: x for x in packing.fill_report(out).collect()}
    assert r["short"].unused_share < 0.03 and r["short"].tokens == sum(c for _, _, c, _ in rows)
    assert packing.fill_containers(sized.limit(0), boxes, "doc_id").count() == 0


def test_flight_keeps_balance():
    rng = np.random.default_rng(3)
    p, size = rng.random(3000), rng.integers(1, 5000, 3000).astype(float)
    q = mixing.flight(p, size, rng)
    assert abs(q.sum() - p.sum()) < 1e-6 and abs((q * size).sum() - (p * size).sum()) < 1e-3
    assert ((q > 1e-9) & (q < 1 - 1e-9)).sum() <= 2
    sums = sum(mixing.flight(np.full(5, 0.4), np.arange(1.0, 6), np.random.default_rng(s)) for s in range(3000)) / 3000
    assert np.abs(sums - 0.4).max() < 0.05  # inclusion probabilities are kept on average


def test_balanced_mix(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice("aaaaaaab"), rng.randrange(1, 900), 0) for i in range(4000)] + [(9000, "c", 50, 0), (9001, "b", 0, 0), (9002, None, 7, 0), (9003, "untargeted", 7, 0)]
    sized = spark.createDataFrame(rows, "doc_id long, source string, tokens long, loss_tokens long")
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.4995, 6), ("c", 0.0005, 40), ("missing", 0.1, 2)], "source string, target_share double, max_repeats int")
    mix = mixing.balanced_mix(sized, targets, "doc_id", shard=500, landing_size=50).cache()
    assert mix.select("doc_id").distinct().count() == mix.count()
    r = {x.source: x for x in mixing.mix_report(mix, sized, targets).collect()}
    assert abs(r["a"].actual_share - 0.5) < 0.002 and abs(r["b"].actual_share - 0.4995) < 0.002
    assert all(x.most_uses <= x.max_repeats for x in r.values()) and r["missing"].mixed_tokens == 0
    assert mixing.balanced_mix(sized.limit(0), targets, "doc_id").count() == 0


def test_landing_keeps_tokens_and_documents():
    rng = np.random.default_rng(6)
    for _ in range(50):
        p, size = rng.random(40), rng.integers(1, 5000, 40).astype(float)
        q = mixing.landing(p, size, rng)
        assert set(q) <= {0.0, 1.0} and abs(q.sum() - p.sum()) <= 1 + 1e-6 and abs(((q - p) * size).sum()) <= size.max()
    assert len(mixing.landing(np.empty(0), np.empty(0), rng)) == 0


def test_undecided_documents_raise(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MAX_ROUNDS", 1)
    sized = spark.createDataFrame([(i, "a", 100 + i) for i in range(200)] + [(999, "b", 5000)], "doc_id long, source string, tokens long")
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.5, 1)], "source string, target_share double, max_repeats int")
    with pytest.raises(RuntimeError):
        mixing.balanced_mix(sized, targets, "doc_id", shard=100, landing_size=10)


def test_counts_of_endless_white_space_are_exact():
    text = "東瀬" + " \n" * 30_000 + "x  y"
    enc = tokens.encoding(tokens.vocabulary())
    assert tokens.count(text) == sum(len(enc._encode_single_piece(m.group())) for m in tokens._SPLIT.finditer(text))
    for short in ("a  b\n\n c", "東瀬都 2024年", " x", "'s  "):
        assert sum(len(enc._encode_single_piece(m.group())) for m in tokens._SPLIT.finditer(short)) == tokens.count(short)


def test_token_counts(spark):
    assert tokens.count(None) == 0 and tokens.count("") == 0 and tokens.count("a" * 100_000) > 0
    df = spark.createDataFrame([(1, "one line", "clash"), (2, "prompt\nanswer", None), (3, None, None)], "doc_id long, text string, tokens string")
    got = {r.doc_id: (r.tokens, r.loss_tokens) for r in tokens.sized(df, "doc_id", "text", []).collect()}
    assert got[3] == (0, 0) and got[1][0] == got[1][1] and 0 < got[2][1] < got[2][0]
