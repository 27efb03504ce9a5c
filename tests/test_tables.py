"""Joins, trees, windows and writes on small tables, edges included."""

import random

from pyspark.sql import functions as F

from lexaloom.operators import condense, lookup, nested, trees, windows
from lexaloom.sources import connectors as C
from lexaloom.sources.tables import latest


def test_latest_takes_last_and_drops_null_keys(spark):
    x = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (1, None, "c"), (None, 9, "d")], "k int, t int, v string")
    assert [tuple(r) for r in latest(x, "k", "t", ["v"]).collect()] == [(1, "b")]


def test_toc_tree(spark):
    x = spark.createDataFrame([(1, 0, 1, 1, "Alpha", 12), (1, 1, 2, 2, "Beta", 12), (1, 2, 2, 4, "Gamma", 12), (1, 3, 1, 9, "Delta", 12), (1, 4, 1, 9, "[Gof96]", 12), (1, 5, 1, 9, None, 12)], "d int, ord int, level int, page int, title string, total int")
    got = [(r.title, r.parent_ord, r.page_start, r.page_end) for r in trees.toc_tree(x, "d", "total").orderBy("ord").collect()]
    assert got == [("Alpha", None, 1, 8), ("Beta", 0, 2, 3), ("Gamma", 0, 4, 8), ("Delta", None, 9, 12)]


def test_cycles(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("b", "c")], "s string, t string")
    assert trees.cyclic_nodes(e, "s", "t").count() == 0
    assert {r.node for r in trees.cyclic_nodes(e.union(spark.createDataFrame([("c", "a")], "s string, t string")), "s", "t").collect()} == {"a", "b", "c"}
    assert trees.cyclic_nodes(e.limit(0), "s", "t").count() == 0


def test_long_chains(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(205)], "s int, t int").coalesce(1)
    assert trees.cyclic_nodes(chain, "s", "t").count() == 0
    nodes = spark.createDataFrame([(i, i - 1 if i else None, i, f"n{i}") for i in range(70)] + [(0, 3, 0, "n0"), (90, 91, 0, "x"), (91, 90, 0, "y")], "n int, p int, o int, l string").coalesce(1)
    got = {r.n: (r.depth, r.path[-1]) for r in trees.preorder(nodes, "n", "p", "o", "l").collect()}
    assert got == {i: (i, f"n{i}") for i in range(70)}


def test_cycles_of_graphs_larger_than_a_task(spark):
    def left(edges):
        e = set(edges)
        while (m := {(a, b) for a, b in e if any(d == a for _, d in e)}) != e:
            e = m
        return {x for y in e for x in y}

    rnd = random.Random(7)
    chain = rnd.sample(range(1000), 60)
    cases = [
        list(zip(chain, chain[1:])), [*zip(chain, chain[1:]), (chain[-1], chain[30])], [(i, i + 1) for i in range(60)] * 2, [*((i, i + 1) for i in range(60)), (20, 20)], [(i, (i + 1) % 40) for i in range(40)] + [(7, 50), (50, 51)],
        *([(rnd.randrange(m), rnd.randrange(m)) for _ in range(60)] for m in (40, 90)),
    ]
    edges = [(a + 1000 * k, b + 1000 * k) for k, case in enumerate(cases) for a, b in case]
    for kind, as_, most in (("int", int, 150), ("string", str, 250)):
        x = spark.createDataFrame([(as_(a), as_(b)) for a, b in edges] + [(None, as_(1))], f"s {kind}, t {kind}").coalesce(1)
        assert sorted(r.node for r in trees.cyclic_nodes(x, "s", "t", most=most).collect()) == sorted(as_(i) for i in left(edges))


def test_chain_takes_few_tables(spark, monkeypatch):
    written, cut = [], trees.cut
    monkeypatch.setattr(trees, "cut", lambda df: written.append(cut(df)) or written[-1])
    chain = spark.range(3000).select(F.col("id").alias("s"), (F.col("id") + 1).alias("t")).coalesce(1)
    assert trees.cyclic_nodes(chain, "s", "t").count() == 0
    assert len(written) <= 3  # a table a round of doubling were 12 and more


def test_chain_through_all_orders(spark, tmp_path):
    from lexaloom.plans import pipeline_queries as P

    keys = sorted(random.Random(3).sample(range(30_000), 500))
    spark.createDataFrame([(k,) for k in keys], "o_orderkey long").repartition(3).write.parquet(f"{tmp_path}/orders.parquet")
    got = sorted((r.i, r.id, r.before, r.up) for r in P._chain(spark, str(tmp_path)).collect())
    assert got == [(i, k, keys[i - 1] if i else None, keys[i - 1] if i % 100 else None) for i, k in enumerate(keys)]


def test_distribution_gives_every_item_once(spark):
    x = spark.createDataFrame([(i, 5, 2) for i in range(5)], "p int, n int, s int")
    assert [r.section for r in windows.distribute(x, [], "p", "n", "s").orderBy("p").collect()] == [0, 0, 1, 1, 1]


def test_section_lookup_falls_back(spark):
    s = spark.createDataFrame([(1, 0, "Intro", ""), (1, 1, "INTRO", "upper"), (1, 2, "Other", "x"), (1, 3, "Other", "y"), (1, 4, None, "z")], "g int, o int, title string, content string")
    i = lookup.section_index(s, ["g"], "title", "content", ["o"])
    r = spark.createDataFrame([(1, "Intro"), (1, "Other"), (1, "none"), (1, None)], "g int, name string")
    assert {x.name: x.content for x in lookup.look_up(r, i, ["g"], "name", "content").collect()} == {"Intro": "upper", "Other": "y", "none": None, None: None}


def test_upserts(spark):
    a, b = spark.createDataFrame([(1, "a"), (None, "n")], "k int, v string"), spark.createDataFrame([(1, "x"), (2, "y"), (None, "z")], "k int, v string")
    assert sorted((r.v, r.action) for r in lookup.upsert_skip(a, b, ["k"]).collect()) == [("a", "kept"), ("n", "kept"), ("y", "inserted")]
    assert sorted((r.v, r.action) for r in lookup.upsert_replace(a, b.where("k = 1"), ["k"]).collect()) == [("n", "kept"), ("x", "inserted")]


def test_crawl_budgets(spark):
    links = spark.createDataFrame([("e", f"p{i}") for i in range(5)] + [("p0", "q0"), ("p1", "e")], "url string, target string")
    pages = spark.createDataFrame([(f"p{i}", 10) for i in range(4)] + [("q0", 10), ("p4", None)], "url string, tokens int")
    start = spark.createDataFrame([("e",)], "url string")
    assert [r.url for r in trees.crawl(pages, links, start).orderBy("place").collect()] == ["p0", "p1", "p2", "p3"]
    assert [r.url for r in trees.crawl(pages, links, start, most_depth=2).orderBy("place").collect()][-1] == "q0"
    assert trees.crawl(pages, links, start, most_pages=2).count() == 2
    assert trees.crawl(pages, links, start, most_tokens=15).count() == 2
    assert trees.crawl(pages, links, spark.createDataFrame([("none",)], "url string")).count() == 0


def test_condense_strategies(spark):
    plan = spark.createDataFrame([("t", 0, "A", "keep", None, None, None), ("t", 1, "B", "merge", ["A", "B"], None, None), ("t", 2, "C", "odd", None, None, None), ("t", 3, "D", "keep", None, "own words", None)], "tier string, topic_ord int, title string, condensation_strategy string, source_topics array<string>, content string, children array<struct<title:string,description:string,condensation_strategy:string,source_children:array<string>,content:string>>")
    chunks = spark.createDataFrame([("A", 0, "a one", 2, False), ("A", 1, "a two", 2, True), ("B", 0, "b", 1, None)], "title string, chunk_ord int, content string, token_count int, has_code boolean")
    got = [(r.topic_ord, r.chunk_index, r.content, r.has_code) for r in condense.leaf_chunks(condense.plan_leaves(plan), chunks).orderBy("topic_ord", "chunk_index").collect()]
    assert got == [(0, 0, "a one", False), (0, 1, "a two", True), (1, 0, "a one\n\na two\n\nb", True), (3, 0, "own words", False)]


def test_leaf_sizes_are_those_of_leaf_chunks(spark):
    rnd = random.Random(5)
    some = lambda: rnd.choice([None, [], ["A"], ["B", "A", "A"], ["C", "none"]])
    plan = spark.createDataFrame(
        [(f"t{i % 3}", i, rnd.choice("ABC"), rnd.choice(["keep", "merge", "synthesize", "odd"]), some(), rnd.choice([None, None, "", "own few words"]), [("A", "keep", some(), None), ("B", "merge", some(), None)] if i % 2 else None) for i in range(40)],
        "tier string, topic_ord int, title string, condensation_strategy string, source_topics array<string>, content string, children array<struct<title:string, condensation_strategy:string, source_children:array<string>, content:string>>",
    )
    chunks = spark.createDataFrame([(rnd.choice("ABD"), i, rnd.choice([None, " ", "a  b\nc", "one"]), rnd.choice([None, 100, 200, 2001]), None) for i in range(60)], "title string, chunk_ord int, content string, token_count int, has_code boolean")
    leaves = condense.plan_leaves(plan)
    made = condense.leaf_chunks(leaves, chunks)
    sizes = condense.leaf_sizes(leaves, chunks.withColumn("words", F.size(F.filter(F.split("content", r"\s+"), lambda w: w != ""))))
    assert sorted(map(repr, sizes.collect())) == sorted(map(repr, made.groupBy("tier", "token_count").agg(F.count("*").alias("n")).collect()))
    one = spark.createDataFrame([(10,)], "tokens long")
    for step in (condense.tier_summary, lambda *x: condense.tier_checks(condense.tier_summary(*x), x[1], x[2])):
        assert sorted(map(repr, step(plan, made, one).collect())) == sorted(map(repr, step(plan, sizes, one).collect()))


def test_title_of_many_leaves_and_chunks(spark):
    k = spark.range(200_000)
    leaves = k.select(F.lit("t").alias("tier"), F.col("id").alias("topic_ord"), F.lit(-1).alias("child_ord"), F.lit("keep").alias("strategy"), F.lit("").alias("content"), F.array(F.lit("A")).alias("keys"))
    chunks = k.select(F.lit("A").alias("title"), (F.col("id") % 2 * 300).alias("token_count"), F.lit(1).alias("words"))
    assert sorted((r.token_count, r.n) for r in condense.leaf_sizes(leaves, chunks).collect()) == [(0, 20_000_000_000), (300, 20_000_000_000)]


def test_sizes_of_last_deliveries(spark):
    from lexaloom.plans import pipeline_queries as P

    rnd = random.Random(9)
    rows = [(rnd.choice([None, *range(25)]), rnd.choice([None, 1, 2]), 1, rnd.choice([None, [], ["A"], ["A", "B"]]), 0, rnd.choice([None, "", "a b", "c"]), rnd.choice([None, 0, 5, 6])) for _ in range(150)]
    for some in (rows, list({r[0]: r for r in rows}.values()) * 2):
        x = spark.createDataFrame(some, "chunk_id int, chunked_at int, curriculum_id int, topic_path array<string>, chunk_index int, content string, token_count int")
        c = latest(x, "chunk_id", "chunked_at", ["curriculum_id", "topic_path", "chunk_index", "content", "token_count"]).where("size(topic_path) > 0 and content is not null").collect()
        assert sorted((r.title, r.token_count, r.words) for r in P._sizes(x).collect()) == sorted((r.topic_path[-1], r.token_count or 0, len(r.content.split())) for r in c)


def test_tier_summary_of_one_title(spark, tmp_path):
    from lexaloom.plans import pipeline_queries as P

    k = spark.range(6000)  # made one by one, the contents of 24 million chunks would be moved
    none = lambda kind: F.lit(None).cast(kind)
    k.select(F.col("id").alias("structure_id"), F.lit(1).alias("saved_at"), F.lit(1).alias("curriculum_id"), F.lit("A").alias("title"), F.lit(1).alias("suggested_level"), none("array<struct<topic:string,strength:string>>").alias("prerequisites"), none("array<struct<text:string,bloom_level:string>>").alias("learning_objectives")).write.parquet(f"{tmp_path}/structure.parquet")
    k.where("id < 3000").select(F.col("id").alias("chunk_id"), F.lit(1).alias("chunked_at"), F.lit(1).alias("curriculum_id"), F.array(F.lit("A")).alias("topic_path"), F.lit(0).alias("chunk_index"), F.repeat(F.lit("word "), 400).alias("content"), F.lit(400).alias("token_count"), F.lit(False).alias("has_code")).write.parquet(f"{tmp_path}/chunks.parquet")
    got = {r.tier: tuple(r)[1:] for r in P.tier_summary(spark, str(tmp_path)).collect()}
    assert got == {t: (2500, 2000 * 3000, 2000 * 3000 * 400, 0) for t in ("detailed", "classic", "core", "other")}


def random_tree(rng, depth):
    node = {}
    if rng.random() < 0.9:
        node["title"] = rng.choice(["A", "B \"q\" {x}", "tab\\t", "é", "", None, 7])
    if rng.random() < 0.6:
        node["source_sections"] = rng.choice([None, [], ["s", None, " ", "t, u"], "lone", ["[x]", "}"]])
    if depth and rng.random() < 0.8:
        kids = [random_tree(rng, depth - 1) if rng.random() < 0.85 else None for _ in range(rng.randint(0, 3))]
        node["children"] = rng.choice([kids, {"topics": kids}, kids[0] if kids and kids[0] else None])
    node["extra"] = rng.choice([1, [1, {"children": [{"title": "no"}]}], "x\\\\", None])
    return node


def plain_links(title, sections, children):
    out = set()

    def items(v):
        if isinstance(v, dict) and "topics" in v:
            return items(v["topics"])
        return v if isinstance(v, list) else [] if v is None else [v]

    def walk(v, path):
        for k, c in enumerate(items(v)):
            if isinstance(c, dict):
                own = f"{path}.{k}"
                out.add(("topic", path, own))
                for i, s in enumerate(items(c.get("source_sections"))):
                    if isinstance(s, str) and s.strip():
                        out.add(("section", own, str(i)))
                walk(c.get("children"), own)

    for i, s in enumerate(sections or []):
        if s and s.strip():
            out.add(("section", "0", str(i)))
    walk(children, "0")
    return out


def test_nested_against_plain_walk(spark):
    import json

    rng = random.Random(5)
    rows, want = [], {}
    for i in range(150):
        tree = [random_tree(rng, 3) for _ in range(rng.randint(0, 3))]
        tree = rng.choice([tree, {"topics": tree}, tree[0] if tree else None])
        rows.append((i, 1, "root", [" ", "r"] if i % 3 else None, json.dumps(tree, indent=rng.choice([None, 1]), ensure_ascii=rng.random() < 0.5)))
        want[i] = plain_links("root", rows[-1][3], tree)
    for j, broken in enumerate(['[{"title": "a"', '[}', "", None, '{"a": "x]}', "[]"]):
        rows.append((1000 + j, None, None, None, broken))
        want[1000 + j] = set()
    x = spark.createDataFrame(rows, "k long, g long, t string, s array<string>, c string")
    flat = nested.flatten(x, "k", "g", "t", "s", "c").collect()
    got: dict = {k: set() for k in want}
    for r in flat:
        if r.kind == "section":
            got[r.key].add(("section", r.path, str(r.position)))
        elif r.parent_path is not None:
            got[r.key].add(("topic", r.parent_path, r.path))
    assert got == want


def test_nested_empty_and_chunk_links(spark):
    x = spark.createDataFrame([(1, 5, "R", None, '[{"title": "A"}, null, {"title": null}]')], "k long, g long, t string, s array<string>, c string")
    flat = nested.flatten(x, "k", "g", "t", "s", "c")
    chunks = spark.createDataFrame([(10, 5, ["R", "A"]), (11, 6, ["R", "A"]), (12, 5, ["R"]), (13, 5, ["R", None]), (14, 5, None), (15, 5, [])], "chunk_id long, curriculum_id long, topic_path array<string>")
    assert sorted((r.path, r.chunk_id) for r in nested.assignments(flat, chunks).collect()) == [("0", 12), ("0.0", 10)]
    assert nested.links(nested.flatten(x.limit(0), "k", "g", "t", "s", "c"), chunks).count() == 0


def test_pages_links_images(spark):
    html = '<h1>T</h1><script>"</p>"</script><!-- x --><p>a &amp; b</p><a href="sub/x.html?q#z">l</a><a href="/other">o</a><a href="https://b.example/">b</a><img src="i.png"><img src="data:x"><img alt="A" src="/j.png">'
    p = spark.createDataFrame([("https://a.example/docs/", html), ("https://a.example/e", "")], "url string, html string")
    assert [r.target for r in C.links_in(p).collect()] == ["https://a.example/docs/sub/x.html"]
    assert p.select(C.page_text(F.col("html")).alias("t")).first().t.startswith("# T\n\na & b\n\nl")
    assert sorted((r.id, r.src, r.alt) for r in C.images_in(p).collect()) == [("web_img0", "https://a.example/docs/i.png", ""), ("web_img2", "https://a.example/j.png", "A")]


def test_export_archives(spark):
    import io
    import zipfile

    b = io.BytesIO()
    with zipfile.ZipFile(b, "w") as z:
        z.writestr("B 0123456789abcdef01.md", "text")
        z.writestr("a/C.md", "more")
        z.writestr("empty.md", " ")
    x = spark.createDataFrame([("z", b.getvalue()), ("bad", b"no")], "path string, content binary")
    assert [(r.title, r.depth, r.text) for r in C.export_pages(x).collect()] == [("C", 1, "more"), ("B", 0, "text")]


def test_placeholders_and_slides(spark):
    x = spark.range(1).select(C.image_placeholders(F.lit("a ![x](p/i.png) b ![y](no.png)"), F.create_map(F.lit("i.png"), F.lit("id1"))).alias("o"))
    assert x.first().o == "a [IMAGE: id1] b ![y](no.png)"
    s = spark.createDataFrame([("d", 1, 0, "text", "t"), ("d", 2, 0, "title", "T"), ("d", 2, 1, "notes", "n")], "doc string, slide int, ord int, kind string, text string")
    assert [(r.title, r.content, r.notes) for r in C.slides(s).orderBy("slide").collect()] == [("Slide 1", "t", ""), ("T", "", "n")]


def test_extracted_source(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"source_path": "p", "sections": [{"title": "t", "content": "c"}]}')
    spark.dataSource.register(C.ExtractedSource)
    assert [tuple(r) for r in spark.read.format("extracted").option("path", str(tmp_path)).load().collect()] == [("p", 0, "t", "c", 0)]
    assert C.read_extracted(spark, str(tmp_path)).count() == 1


def test_dispatch_runs_the_extractor_of_each_kind(spark):
    x = spark.createDataFrame([("/a.csv",), ("/d",), (None,)], "s string")
    rows = spark.createDataFrame([("a.csv", i, f"v{i}") for i in range(3)], "file_name string, row_ord long, c string")
    files = spark.createDataFrame([("README.md", "hi", 10), ("a/x.py", "print()", 10), ("a/.hid", "no", 10), ("a/b.bin", "no", 10)], "path string, content string, size long")
    got = C.dispatch(x, "s", {"tabular": rows, "code": files, "pdf": rows})
    assert set(got) == {"tabular", "code"}
    assert [r.title for r in got["tabular"].collect()] == ["Rows 1-3"]
    assert [(r.title, r.content) for r in got["code"].orderBy("section_ord").collect()] == [("README", "hi"), ("File Structure", "```\nroot/\n├── a/\n└── README.md\n```".replace("├── a/\n", "├── a/\n│   └── x.py\n")), ("a", "### a/x.py\n\n```python\nprint()\n```")]


def test_windows_edges(spark):
    s = spark.createDataFrame([("v", 0, 0.0, 1.0, "a"), ("v", 1, 9.9, 1.0, "b"), ("v", 2, 10.0, 1.0, "c")], "video string, seg_ord int, start double, duration double, text string")
    m = spark.createDataFrame([("v", 0, 0.0, 10.0, "one"), ("v", 1, 10.0, 0.0, "two"), ("v", 2, 50.0, 60.0, "three")], "video string, chap_ord int, start_time double, end_time double, title string")
    assert [(r.title, r.text) for r in windows.chapters(s, m, "video").orderBy("chap_ord").collect()] == [("one", "a b"), ("two", "c")]
    assert windows.time_windows(s.limit(0), "video").count() == 0
    assert windows.keep_one(s.select("video", "seg_ord"), ["video"], ["seg_ord"], last=True).first().seg_ord == 2


def test_streams_run_again_leave_nothing_twice(spark, tmp_path):
    from lexaloom.streaming import streams

    like = spark.createDataFrame([(1, "a")], "k int, v string")
    src, target = str(tmp_path / "in"), str(tmp_path / "out")
    for n in range(3):
        spark.createDataFrame([(n, "x"), (n + 1, "y")], "k int, v string").coalesce(1).write.mode("append").parquet(src)
        streams.upsert_batches(streams.stream_table(spark, src, like), ["k"], target, str(tmp_path / "at")).awaitTermination()
    streams.upsert_batches(streams.stream_table(spark, src, like), ["k"], target, str(tmp_path / "at2")).awaitTermination()
    assert sorted(r.k for r in spark.read.parquet(target).collect()) == [0, 1, 2, 3]
    q = streams.latest_batches(streams.stream_table(spark, src, like).groupBy("v").count(), str(tmp_path / "agg"), str(tmp_path / "at3"))
    q.awaitTermination()
    assert {(r.v, r["count"]) for r in streams.settled(spark, str(tmp_path / "agg"), ["v"]).collect()} == {("x", 3), ("y", 3)}


def test_prerequisites_with_a_cycle_are_left_out(spark):
    from lexaloom.operators import upload

    topics = spark.createDataFrame([(g, t, f"{g}{t}", i) for g in (1, 2) for i, t in enumerate("ABC")] + [(2, "A", "2late", 9)], "g int, title string, id string, o int")
    wanted = [(1, "A", "B", None), (1, "B", "C", "required"), (1, "C", "a", None), (2, "a", "B", None), (2, "A", "B", "required"), (2, "A", "A", None), (2, "A", "none", None), (2, None, "A", None)]
    got = upload.prerequisite_rows(spark.createDataFrame(wanted, "g int, title string, prerequisite string, strength string"), topics, "g", "o").collect()
    assert [(r.g, r.topic_id, r.prerequisite_topic_id, r.strength) for r in got] == [(2, "2late", "2B", "required")]


def test_enrichment_is_cleared_and_made_anew(spark):
    from lexaloom.operators import upload

    t = spark.createDataFrame([("a", 1), ("b", 2)], "topic_id string, n int")
    c = spark.createDataFrame([("a", 1), ("a", 1000), ("b", 1001), ("a", None)], "topic_id string, chunk_index int")
    a, b, d = upload.cleared(t, t, c, spark.createDataFrame([("a",)], "id string"))
    assert [r.topic_id for r in a.collect()] == ["b"] == [r.topic_id for r in b.collect()]
    assert sorted((r.topic_id, r.chunk_index or 0) for r in d.collect()) == [("a", 0), ("a", 1), ("b", 1001)]


def test_condensing_pieces(spark):
    o = "array<struct<text:string,bloom_level:string>>"
    x = spark.createDataFrame([("f", "Chapter 2: Go"), ("f", "Cover"), ("g", "Go"), ("g", None)], "file string, title string")
    remap = spark.createDataFrame([("g", "Go", "Went"), (None, "Go", "Gone")], "file string, old string, new string")
    assert sorted((r.file, r.new_title, r.action) for r in condense.normalized_sections(x, remap, "file", "title").collect()) == [("f", "Cover", "dropped"), ("f", "Go", "renamed"), ("g", "", "kept"), ("g", "Went", "renamed")]
    leaves = spark.createDataFrame([("classic", 0, -1, ["A"], None), ("detailed", 0, -1, ["A", "B"], None), ("core", 0, -1, ["A"], ["own"]), ("other", 0, -1, ["Z"], None), ("other", 1, -1, ["Z"], ["own"])], "tier string, topic_ord int, child_ord int, keys array<string>, own array<string>")
    ex = spark.createDataFrame([("A", 1, ["a1", "a2"]), ("B", 0, ["b1", "b2"])], "title string, ord int, exercises array<string>")
    got = {(r.tier, r.topic_ord): r.exercises for r in condense.gathered_exercises(leaves, ex).collect()}
    assert got == {("classic", 0): ["a1"], ("detailed", 0): ["a1", "a2", "b1"], ("other", 1): ["own"]}
    m = spark.createDataFrame([("My Domain", "", None)], "domain string, domain_family string, variant string")
    assert condense.filled_manifest(m).first()[1:] == ("my-domain", "extensive")


def test_documents_of_pages(spark):
    toc = spark.createDataFrame([("a", 0, 1, "One"), ("a", 1, 2, "Lost"), ("a", 2, 1, None)], "doc string, ord int, level int, title string")
    pages = spark.createDataFrame([("a", 1, "One here"), ("a", 2, " "), ("a", 3, "and One there"), ("b", 1, "x"), ("c", 1, None)], "doc string, page int, text string")
    docs = spark.createDataFrame([("a", "A"), ("b", "B"), ("c", "C")], "doc string, title string")
    got = [(r.doc, r.title, r.content) for r in C.titled_sections({"toc": toc, "pages": pages, "docs": docs}).orderBy("doc", "ord").collect()]
    assert got == [("a", "One", "One here\n\nand One there"), ("a", "Lost", ""), ("b", "B", "x")]
    seen = spark.createDataFrame([("b", 1, "much longer text"), ("c", 2, "new"), ("a", 1, "O")], "doc string, page int, text string")
    assert {(r.doc, r.page): r.text for r in C.repaired_pages(pages, seen).collect()} == {("a", 1): "One here", ("a", 3): "and One there", ("b", 1): "much longer text", ("c", 2): "new"}


def test_workspace_crawl(spark):
    pages = spark.createDataFrame([("r", False), ("d", True), ("x", False), ("y", False), ("z", None)], "id string, is_database boolean")
    kids = spark.createDataFrame([("r", 0, "d"), ("r", 1, "x"), ("d", 0, "y"), ("x", 0, "r"), ("y", 0, "z"), ("x", 1, "gone")], "id string, ord int, child string")
    start = spark.createDataFrame([("r",)], "id string")
    assert [(r.id, r.depth) for r in trees.workspace_crawl(pages, kids, start).orderBy("place").collect()] == [("r", 0), ("x", 1), ("y", 2), ("z", 3)]
    assert trees.workspace_crawl(pages, kids, start, most_pages=2).count() == 2
    assert trees.workspace_crawl(pages, kids, start, most_depth=2).count() == 3
    assert trees.workspace_crawl(pages, kids, start.limit(0)).count() == 0


def test_edges_made_needless_by_longer_ways(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d"), ("a", "d"), ("a", "c"), ("x", "y"), ("y", "x"), ("d", "d")], "s string, t string")
    assert {tuple(r) for r in trees.redundant_edges(e, "s", "t").collect()} == {("a", "d"), ("a", "c")}
    assert trees.redundant_edges(e.limit(0), "s", "t").count() == 0
