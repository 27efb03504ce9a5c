"""Shared spans against brute force over all windows."""

import random
from collections import defaultdict

from lexaloom.llm import spans

COLS = "tbl string, id long, content string"


def brute(rows, length):
    by = defaultdict(set)
    for tbl, i, t in rows:
        for a in range(len(t or "") - length + 1):
            by[tbl, t[a : a + length]].add(i)
    pairs = {(k[0], a, b) for k, v in by.items() for a in v for b in v if a < b}
    cover = {}
    for tbl, i, t in rows:
        if t is None or i is None:
            continue
        on = set()
        for a in range(len(t) - length + 1):
            if len(by[tbl, t[a : a + length]]) > 1:
                on |= set(range(a, a + length))
        cover[tbl, i] = max(cover.get((tbl, i), 0), len(on))
    return pairs, cover


def corpus(rng, n, alphabet="abcdefgh 字é😀"):
    pool = ["".join(rng.choice(alphabet) for _ in range(rng.choice([30, 39, 40, 41, 70, 120]))) for _ in range(6)]
    rows = []
    for i in range(n):
        t = "".join(rng.choice([rng.choice(pool), "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 50)))]) for _ in range(rng.randint(0, 5)))
        rows.append((rng.choice(["x", "y"]), i, t))
    return rows


def compare(spark, rows, length=40, gram=12):
    pairs, cover = brute([r for r in rows if r[1] is not None], length)
    x = spark.createDataFrame([(*r, "extra") for r in rows], COLS + ", seed string")
    assert {tuple(r) for r in spans.shared_pairs(x, length, gram).collect()} == pairs
    got = {(r.tbl, r.id): r.shared_chars for r in spans.shared_share(x, length, gram).collect()}
    assert got == cover


def test_pairs_and_shares_against_brute_force(spark):
    rows = corpus(random.Random(1), 60)
    rows += [("x", 900, rows[3][2]), ("y", 901, None), ("y", None, "z" * 90), ("x", 902, ""), ("x", 903, "ab" * 60), ("x", 904, "ab" * 40), rows[3], rows[5]]
    compare(spark, rows)


def test_periodic_texts(spark):
    """Stretches of one or a few characters over and over, of all lengths and phases, between other text and alone."""
    rng = random.Random(7)
    rows = []
    for i in range(160):
        period = rng.choice(["-", "ab", "=- ", "abcde", "0123456789ab", "longer than a gram"])
        n, phase = rng.choice([38, 39, 40, 41, 44, 52, 90, 200]), rng.randint(0, len(period) - 1)
        run = (period * 300)[phase : phase + n]
        side = lambda: rng.choice(["", "x", "the same side of it", "".join(rng.choice("pqrs") for _ in range(rng.randint(1, 30)))])
        rows.append(("x", i, side() + run + side() + rng.choice(["", run[:20] + "!"])))
    compare(spark, rows)


def test_hot_seeds(spark, monkeypatch):
    """A stretch all have, too short to count, beside longer ones some have, with the index spread by windows and held whole."""
    rng = random.Random(2)
    core, sides = "the common core of all", ["".join(rng.choice("abcdef") for _ in range(30)) for _ in range(40)]
    rows = [("x", i, sides[i % 35] + core + sides[(i * 7) % 33]) for i in range(70)]
    rows += [("x", 100, sides[0] + core + sides[1] + sides[2] + core + sides[3] + sides[0] + core + sides[5])]
    compare(spark, rows)
    monkeypatch.setattr(spans, "HOT", 3)
    compare(spark, rows)


def test_one_stretch_in_many_records_stays_linear(spark):
    rng = random.Random(4)
    text = lambda n: "".join(rng.choice("abcdefghijklmnop ") for _ in range(n))
    stretch = text(300)
    x = spark.createDataFrame([("x", i, text(400) + stretch + text(400)) for i in range(200)], COLS)
    got = spans.shared_classes(x).groupBy("class_id").count().collect()
    assert max(r["count"] for r in got) == 200
    assert sum(r["count"] for r in got) <= 10 * 200
    assert {r.shared_chars for r in spans.shared_share(x).collect()} <= set(range(300, 310))


def test_one_character_over_and_over_gives_few_seeds():
    found = list(spans.batch_seeds(["-" * 40_000], 240, 64))
    assert sum(len(f[0]) for f in found) < 400
    assert len({int(c) for f in found for c in f[3]}) < 10


def test_empty(spark):
    assert spans.shared_pairs(spark.createDataFrame([], COLS)).count() == 0
    assert spans.shared_share(spark.createDataFrame([], COLS)).count() == 0
