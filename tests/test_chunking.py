"""Packing: hand vectors, properties against a plain loop, edges."""

import random

from pyspark.sql import functions as F

from lexaloom.operators import bridge, chunking


def words(n, head=""):
    return head + " ".join(["w"] * (n - (1 if head else 0)))


def packed(spark, texts, most, least):
    x = spark.createDataFrame(list(enumerate(texts)), "d int, text string")
    out: dict = {}
    for r in chunking.pack(x, "text", most, least).orderBy("d", "chunk_index").collect():
        out.setdefault(r.d, []).append((r.token_count, r.content))
    return out


def test_vectors(spark):
    texts = ["\n\n".join(words(n) for n in ns) for ns in ((4, 4, 4), (9, 2), (12, 2))]
    texts.append("\n\n".join([words(4), words(3, "# "), words(6)]))
    got = packed(spark, texts, 10, 3)
    assert [n for n, _ in got[0]] == [8, 4]
    assert [n for n, _ in got[1]] == [11]
    assert [n for n, _ in got[2]] == [14]
    assert [n for n, _ in got[3]] == [13]


def plain(paras, most, least):
    chunks, cur, n = [], [], 0
    for p in paras:
        k = len(p.split())
        if k > most:
            if cur:
                chunks.append((n, cur))
            chunks.append((k, [p]))
            cur, n = [], 0
            continue
        if n + k > most and n >= least and not (cur and cur[-1].startswith("# ")):
            chunks.append((n, cur))
            cur, n = [], 0
        cur.append(p)
        n += k
    if cur:
        if n < least and chunks:
            chunks[-1] = (chunks[-1][0] + n, chunks[-1][1] + cur)
        else:
            chunks.append((n, cur))
    return [(n, "\n\n".join(c)) for n, c in chunks]


def test_against_plain_loop(spark):
    rng = random.Random(3)
    docs = [[words(rng.choice([2, 3, 5, 9, 14, 30]), rng.choice(["", "", "# "])) for _ in range(rng.randint(3, 25))] for _ in range(60)]
    docs = [d for d in docs if sum(len(p.split()) for p in d) > 20]
    got = packed(spark, ["\n\n".join(d) for d in docs], 20, 6)
    for i, d in enumerate(docs):
        assert got[i] == plain(d, 20, 6)


def test_fences_and_edges(spark):
    text = "one\n\n```py\na\n\nb\n```\nafter\n\nlast"
    x = spark.createDataFrame([(text,), ("",), (None,), ("```\nopen\n\nend",)], "t string")
    got = [r.p for r in x.select(chunking.paragraphs(F.col("t")).alias("p")).collect()]
    assert got == [["one", "```py\na\n\nb\n```\nafter", "last"], [], None, ["```\nopen\n\nend"]]
    assert packed(spark, ["", None, "  \n"], 10, 3) == {}


def test_split_among(spark):
    rows = [(1, i, t, "intro\nBeta\nb text\nGamma\nc text") for i, t in enumerate(["Alpha", "Beta", "Gamma"])]
    rows += [(2, 0, "X", "nothing here"), (2, 1, "Y", "nothing here")]
    x = spark.createDataFrame(rows, "g int, o int, title string, text string")
    got = {(r.g, r.title): r.part for r in chunking.split_among(x, ["g"], "title", "o", "text").collect()}
    assert got == {(1, "Alpha"): "intro", (1, "Beta"): "Beta\nb text", (1, "Gamma"): "Gamma\nc text", (2, "X"): "nothing here", (2, "Y"): ""}


def test_markdown_sections(spark):
    x = spark.createDataFrame([(1, "pre\n\n# A\na\n## B\nb"), (2, "only\n\ntwo"), (3, "\n\n".join(f"p{i}" for i in range(7))), (4, "# T\nx"), (5, None)], "d int, t string").withColumn("f", F.lit("F"))
    got = [(r.d, r.title, r.depth, r.content) for r in chunking.markdown_sections(x, "d", "t", "f").orderBy("d", "section_ord").collect()]
    assert got[:3] == [(1, "F", 0, "pre"), (1, "A", 0, "a"), (1, "B", 1, "b")]
    assert got[3] == (2, "F", 0, "only\n\ntwo")
    assert [g[1] for g in got[4:6]] == ["p0", "p5"]
    assert got[6:] == [(4, "T", 0, "x")]


def test_clashing_columns(spark):
    x = spark.createDataFrame([(1, "some text", "old", 9)], "d int, text string, content string, token_count int")
    assert [tuple(r) for r in chunking.pack(x, "text").collect()] == [(1, 0, "some text", 2, False)]


def curriculum(spark):
    """Tree 1 names sections, tree 2 doesn't; titles, order and images as they come."""
    pics = "array<struct<id:string,local_path:string,alt_text:string,context:string>>"
    nodes = [(1, [0], "R", None), (1, [0, 0], "A", ["B part"]), (1, [0, 1], "B", None), (1, [0, 2], "nothing", None), (1, [0, 3], None, None), (2, [0], "One", None), (2, [0, 0], "Two", None), (2, [0, 1], "Three", None), (2, [1], "Four", None), (2, [2], "none", None)]
    nodes = spark.createDataFrame([(t, p, n, ["x"], s, "extra") for t, p, n, s in nodes], "tree int, place array<int>, title string, titles array<string>, split_after array<string>, text string")
    refs = spark.createDataFrame([(1, [0, 0], 1, "b\u00a0"), (1, [0, 0], 0, "A"), (1, [0, 1], 0, "gone"), (1, [0, 2], 0, " "), (2, [0, 0], 0, None), (1, [0], 0, "A")], "tree int, place array<int>, ref_ord int, name string")
    rows = [(1, 0, 0, "A", "a text", None, [("i1", "p", None, None)]), (1, 0, 1, "a", "", "s", None), (1, 1, 0, "B", "b text", "s1", [("i2", "p", None, None)]), (1, 1, 0, "B", "b text", "s1", [("i2", "p", None, None)]), (1, 1, 1, None, "x", None, None)]
    rows += [(2, 0, 0, "One", " ".join(["one"] * 600), None, None), (2, 0, 1, "Two", " ".join(f"two{i}" for i in range(900)), None, None), (2, 0, 2, "Four", "four", None, None), (2, 0, 3, "Void", " ", None, None)]
    return nodes, refs, spark.createDataFrame(rows, f"tree int, f int, o int, title string, content string, source string, images {pics}").dropDuplicates(["tree", "f", "o"])


def test_gather_and_bridge(spark):
    nodes, refs, sections = curriculum(spark)
    leaves = bridge.leaves_of(nodes, "tree", "place")
    assert sorted((r.tree, tuple(r.place)) for r in leaves.collect()) == [(1, (0, 0)), (1, (0, 1)), (1, (0, 2)), (1, (0, 3)), (2, (0, 0)), (2, (0, 1)), (2, (1,)), (2, (2,))]
    got = {(r.tree, tuple(r.place)): (r.text, r.source, [i.id for i in r.images]) for r in bridge.gather(leaves, refs, sections, "tree", "place", ["tree"], ["f", "o"]).collect()}
    assert got[1, (0, 0)] == ("a text\n\nb text", "s", ["i1", "i2"])  # by the names, in their order; the source of "a", as "A" has none
    assert got[1, (0, 1)] == ("b text", "s1", ["i2"])  # its name finds nothing: its own title
    assert {k for k in got if k[0] == 1} == {(1, (0, 0)), (1, (0, 1))}
    out = bridge.bridge(nodes, refs, sections, "tree", "place", ["f", "o"]).collect()
    assert [(r.page_number, r.source, [i.id for i in r.images]) for r in out if r.tree == 1 and tuple(r.place) == (0, 0)] == [(1, "s", ["i1", "i2"])]
    two = sorted((tuple(r.place), r.page_number, r.token_count) for r in out if r.tree == 2)
    # One has pages 1, Two 2 (600 and 900 words, 384 a page: 2 and 3 pages of text), Three stands on 3, Four on 3
    assert two == [((0,), 1, 384), ((0, 0), 2, 216), ((0, 1), 3, 384), ((1,), 3, 384), ((2,), 4, 384)]
    empty = bridge.bridge(nodes.limit(0), refs.limit(0), sections.limit(0), "tree", "place", ["f", "o"])
    assert empty.count() == 0 and bridge.bridge(nodes, refs, sections.limit(0), "tree", "place", ["f", "o"]).count() == 0


def test_pages_hold_all_words(spark):
    sizes = {1: 0, 2: 1, 3: 384, 4: 768, 5: 769, 6: 2000, 7: 4000}
    rows = [(1, 0, i, " ".join(f"w{i}x{k}" for k in range(n))) for i, n in sizes.items()] + [(1, 1, 0, None), (1, 1, 1, "u v"), (2, 0, 0, "z")]
    x = spark.createDataFrame(rows, "tree int, f int, o int, content string")
    got = sorted((r.tree, r.page, len(r.text.split())) for r in bridge.section_pages(x, "tree", ["f", "o"]).collect())
    want = [n for size in sizes.values() for n in [384] * (size // 384) + ([size % 384] if size % 384 else [])] + [2]
    assert got == [(1, i, n) for i, n in enumerate(want, 1)] + [(2, 1, 1)]


def test_topics_sharing_pages(spark):
    topics = [([0], "Top", 1, 3), ([0, 0], "Alpha", 2, 3), ([0, 1], "Beta", 2, 3), ([0, 2], "Late", 3, 3), ([1], "Alone", 4, 4), ([2], "Blank", 5, 5)]
    x = spark.createDataFrame([(1, *t) for t in topics], "d int, place array<int>, title string, page_start int, page_end int")
    pages = spark.createDataFrame([(1, 1, "intro"), (1, 2, "a\nBeta\nb"), (1, 3, "c"), (1, 4, "d"), (1, 5, " ")], "d int, page int, text string")
    got = [(r.title, r.content, r.page_number) for r in bridge.chunk_by_topics(x, pages, "d", "place").orderBy("order_key").collect()]
    assert got == [("Top", "intro", 1), ("Alpha", "a", 2), ("Beta", "Beta\nb\n\nc", 2), ("Late", "c", 3), ("Alone", "d", 4)]


def test_parted_duplicates(spark):
    same = "start\nBeta\nb\nGamma\nc"
    rows = [(1, 1, "Alpha", same), (1, 2, "Beta", same), (1, 3, "Gamma", same), (2, 4, "Beta", same), (1, 5, "P", "other"), (1, 6, "Q", "other"), (1, 7, "R", "single"), (1, 8, None, "x y"), (1, 9, None, "x y")]
    x = spark.createDataFrame(rows, "g int, id int, title string, content string").withColumn("token_count", F.lit(0).cast("long")).withColumn("has_code", F.lit(True))
    got = {r.id: (r.content, r.token_count, r.has_code) for r in bridge.part_duplicates(x, ["g"], "title", "id").collect()}
    assert got == {1: ("start", 1, False), 2: ("Beta\nb", 2, False), 3: ("Gamma\nc", 2, False), 4: (same, 0, True), 5: ("other", 0, True), 6: ("other", 0, True), 7: ("single", 0, True), 8: ("x y", 0, True), 9: ("x y", 0, True)}
    assert bridge.part_duplicates(x.limit(0), ["g"], "title", "id").count() == 0


def test_export_sections(spark):
    x = spark.createDataFrame([(1, "pre\n\n###### A\na\n# B\nb", 1), (2, "no headings\n\n" + "\n\n".join("abcdefg"), 0), (3, "# T", 2), (4, None, 0), (5, " ", 0), (6, "a \u0001 b", None)], "d int, t string, base int")
    got = [(r.d, r.title, r.depth, r.content) for r in chunking.export_sections(x, "d", "t", "base").orderBy("d", "section_ord").collect()]
    assert got[:3] == [(1, "Introduction", 1, "pre"), (1, "A", 6, "a"), (1, "B", 1, "b")]
    assert got[3][1:3] == ("Content", 0) and got[3][3].endswith("g")
    assert got[4:] == [(3, "T", 2, ""), (5, "Content", 0, ""), (6, "Content", 0, "a \u0001 b")]


def test_packing_of_long_texts_and_split_titles(spark):
    text = "\n\n".join([words(15), "## Part Two", words(4), "```\na\n\nb\n```", words(30), words(2)])
    x = spark.createDataFrame([(1, text, [" part two "]), (2, text, None), (3, "\n\n".join(["w x"] * 20000), [])], "d int, text string, s array<string>")
    got = {}
    for r in chunking.pack(x, "text", 20, 5, split_before="s").orderBy("d", "chunk_index").collect():
        got.setdefault(r.d, []).append((r.token_count, r.has_code))
    assert got[1] == [(15, False), (11, True), (32, False)]
    assert got[2] == [(18, False), (8, True), (32, False)] or got[2][0][0] >= 15
    assert sum(n for n, _ in got[3]) == 40000 and {n for n, _ in got[3][:-1]} == {20}
