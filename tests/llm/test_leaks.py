"""Leaks against a search for every run."""

import random

from lexaloom.llm import leaks


def brute(docs, items):
    out = set()
    for i, lang, t in items:
        kind = leaks.CHARACTERS if lang in ("zh", "ja") else leaks.WORDS
        cut = leaks.words if kind is leaks.WORDS else leaks.characters
        u = cut(leaks.plain(t or ""))
        runs = {tuple(u[a : a + kind.run]) for a in range(len(u) - kind.run + 1)}
        for d, x in docs:
            v = cut(leaks.plain(x or ""))
            if any(tuple(v[a : a + kind.run]) in runs for a in range(len(v) - kind.run + 1)):
                out.add((d, i))
    return out


def test_against_brute_force(spark):
    rng = random.Random(6)
    vocabulary = ["".join(rng.choice("abcdefgij") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    han = [chr(0x4E00 + k) for k in range(400)]
    sentence = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, "en", sentence(rng.randint(8, 60))) for i in range(40)] + [(100 + i, "zh", "".join(rng.choice(han) for _ in range(rng.randint(25, 120)))) for i in range(15)]
    docs = []
    for d in range(200):
        parts = [sentence(rng.randint(0, 80))]
        if d % 3 == 0:
            _, lang, t = rng.choice(items)
            u = t.split() if lang == "en" else list(t)
            a, n = rng.randint(0, max(0, len(u) - 12)), rng.choice([11, 12, 13, 20, 29, 30, 31, 45])
            piece = [w.upper() if rng.random() < 0.2 else f"*{w}*" if rng.random() < 0.1 else w for w in u[a : a + n]]
            parts.append((" " if lang == "en" else "，" if d % 2 else "").join(piece))
        docs.append((d, " ".join([*parts, sentence(rng.randint(0, 60))])))
    docs += [(500, None), (501, ""), (502, docs[0][1]), docs[0]]
    x = spark.createDataFrame([(*r, "z") for r in docs], "doc_id long, text string, item_id string")
    y = spark.createDataFrame([(*r, "s") for r in [*items, (900, None, None), (901, "en", ""), items[0]]], "item_id long, lang string, text string, suite string")
    assert {tuple(r) for r in leaks.leaked_runs(x.select("doc_id", "text"), y).collect()} == brute(docs, items)


def test_empty(spark):
    x, y = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([(1, "en", "a b")], "item_id long, lang string, text string")
    assert leaks.leaked_runs(x.limit(0), y).count() == 0
    assert leaks.leaked_runs(x, y.limit(0)).count() == 0
    assert leaks.leaked_runs(x, y).count() == 0


def test_runs_and_subsequences():
    assert leaks.longest_run("abcxdef", "zabcdefz") == 3
    assert leaks.common_subsequence("abcxdef", "zabcdefz") == 6


def test_single_leaks_beside_many_reposts(spark):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    hot = [[word() for _ in range(60)] for _ in range(40)]
    cold = [[word() for _ in range(24)] for _ in range(150)]
    docs = [" ".join(u) for u in hot for _ in range(40)]
    for u in cold:  # a run leaked once, with a stretch of a reposted item on either side
        h, a, b = rng.choice(hot), rng.randint(0, 12), rng.randint(0, 54)
        docs.append(" ".join([*h[b : b + 6], *u[a : a + 12], *h[b : b + 6]]))
    items = [(i, "en", " ".join(u)) for i, u in enumerate(hot + cold)]
    docs = list(enumerate(docs))
    x = spark.createDataFrame(docs, "doc_id long, text string")
    y = spark.createDataFrame(items, "item_id long, lang string, text string")
    assert {tuple(r) for r in leaks.leaked_runs(x, y).collect()} == brute(docs, items)


def test_paraphrases(spark):
    """Items with words changed here and there are found in the latent space; others with the same everyday words aren't."""
    rng = random.Random(12)
    common = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 5))) for _ in range(150)]
    name = lambda: "".join(rng.choice("klmnopqrstuv") for _ in range(8))
    sentence = lambda n: [name() if rng.random() < 0.15 else rng.choice(common) for _ in range(n)]
    items = [sentence(rng.randint(24, 60)) for _ in range(120)]
    docs, want = [], set()
    for i, u in enumerate(items):
        v = list(u)
        for k in range(rng.randint(0, 5), len(v), 6):  # one word in six
            v[k] = rng.choice(common)
        docs.append((i, " ".join([*sentence(rng.randint(0, 40)), *v, *sentence(rng.randint(0, 40))])))
        want.add((i, i))
    docs += [(1000 + i, " ".join(sentence(80))) for i in range(600)]
    x = spark.createDataFrame(docs, "doc_id long, text string")
    y = spark.createDataFrame([(i, "en", " ".join(u)) for i, u in enumerate(items)], "item_id long, lang string, text string")
    got = leaks.leaks(x, y).collect()
    found = {(r.doc_id, r.item_id) for r in got}
    assert len(found & want) >= 0.95 * len(want)
    assert len(found - want) <= 2
    assert {r.kind for r in got} == {"paraphrase"} and min(r.lcs_share for r in got) >= leaks.KEPT
    assert leaks.leaked_runs(x, y).count() == 0


def test_svd_against_numpy(spark):
    import numpy as np

    rng = random.Random(3)
    sets = [sorted(rng.sample(range(40), rng.randint(3, 9))) for _ in range(300)]
    idf = np.linspace(0.5, 3.0, 40)
    a = np.zeros((300, 40))
    for i, s in enumerate(sets):
        a[i, s] = idf[s]
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    v, s = leaks.randomised_svd(spark.createDataFrame([(x,) for x in sets], "terms array<int>"), idf, 30, rounds=3)
    want = np.linalg.svd(a, compute_uv=False)[:30]
    assert np.allclose(s[:10], want[:10], rtol=0.02) and np.allclose(v.T @ v, np.eye(30), atol=1e-3)
