"""Mixes: caps, shares, balance."""

import numpy as np

from lexaloom.llm import mixing


def test_quotas():
    got = mixing.quotas({"a": 100, "b": 10}, [("a", 0.5, 1), ("b", 0.5, 2), ("c", 0.1, 3), ("d", 0.0, 3)], 100)
    assert got == {"a": 50.0, "b": 20.0, "c": 0.0}


def test_flight_keeps_sums():
    rng = np.random.default_rng(1)
    p, size = rng.random(400), rng.integers(1, 50, 400).astype(float)
    out = mixing.flight(p, np.stack([np.ones(400), size], axis=1), rng)
    assert ((out > 1e-9) & (out < 1 - 1e-9)).sum() <= 2
    assert abs(out.sum() - p.sum()) < 1e-6 and abs((out * size).sum() - (p * size).sum()) < 1e-6


def test_mix(spark):
    rows = [(i, "A-B " if i % 2 else "a_b", "word " * (1 + i % 7)) for i in range(300)] + [(1000 + i, "small", "word " * 5) for i in range(4)] + [(2000, "other", "x"), (2001, None, "x"), (2002, "a_b", None), (2003, "a_b", ""), (None, "a_b", "x"), (1000, "small", "word " * 5)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, source string, text string, tokens int")
    targets = spark.createDataFrame([("a_b", 0.5, 1), ("small", 0.4, 3), ("none", 0.1, 2)], "source string, target_share double, max_repeats int")
    got = mixing.mix(docs, targets, total=600)
    uses = {r.doc_id: (r.source, r.tokens, r.times) for r in got.collect()}
    assert {s for s, _, _ in uses.values()} == {"a_b", "small"}
    assert all(t <= (1 if s == "a_b" else 3) for s, _, t in uses.values())
    assert abs(sum(n * t for s, n, t in uses.values() if s == "a_b") - 300) <= 8
    assert all(t == 3 for s, _, t in uses.values() if s == "small")
    shares = {r.source: r for r in mixing.shares(got, targets).collect()}
    assert shares["none"].tokens == 0 and abs(sum(r.actual_share for r in shares.values()) - 1) < 1e-9
    assert mixing.mix(docs.limit(0), targets).count() == 0
    assert mixing.mix(docs, targets.limit(0)).count() == 0


def test_blocks(spark, monkeypatch):
    monkeypatch.setattr(mixing, "FLOWN", 20)
    docs = spark.createDataFrame([(i, "a", "word " * (1 + i % 9)) for i in range(300)], "doc_id long, source string, text string")
    got = mixing.mix(docs, spark.createDataFrame([("a", 1.0, 1)], "source string, target_share double, max_repeats int"), total=500).collect()
    assert abs(sum(r.tokens for r in got) - 500) <= 10 and len({r.doc_id for r in got}) == len(got)


def test_even_mix_meets_shares(spark):
    docs = spark.createDataFrame([(i, "big", "word " * (1 + i % 9)) for i in range(900)] + [(2000 + i, "small", "word " * 7) for i in range(30)], "doc_id long, source string, text string")
    targets = spark.createDataFrame([("big", 0.6, 1), ("small", 0.3, 2), ("none", 0.1, 5)], "source string, target_share double, max_repeats int")
    got = {r.source: r for r in mixing.shares(mixing.mix(docs, targets, even=True), targets).collect()}
    assert got["small"].most_times == 2 and got["small"].documents == 30
    assert abs(got["big"].actual_share - 2 / 3) < 0.02 and abs(got["small"].actual_share - 1 / 3) < 0.02 and got["none"].tokens == 0
    assert mixing.even_total({}, [("a", 0.5, 1)]) == 0.0
