"""Scalar functions against hand vectors."""

import pytest
from pyspark.sql import functions as F

from lexaloom.functions import text as T
from lexaloom.operators import trees


def one(spark, f, *values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.o for r in rows.select("i", f(F.col("v")).alias("o")).orderBy("i").collect()]


def test_strip_prefix(spark):
    given = ["Chapter 4: Working with Images", "1. Meet Kafka", "5: The Docker Engine", "3 Pods: Basics", "Chapter 4", "Part II", None, ""]
    assert one(spark, T.strip_prefix, *given) == ["Working with Images", "Meet Kafka", "The Docker Engine", "Pods: Basics", "Chapter 4", "", None, ""]


def test_book_meta(spark):
    assert one(spark, T.is_book_meta, "Cover", "Questions", "Who Should Read This Book?", "Questions About X", "bitnami/foo/templates/index-gateway", None, "") == [True, True, True, False, False, False, False]


def test_scanned_and_code(spark):
    assert one(spark, T.is_scanned, "", "x" * 60, "#" * 60) == [True, False, True]
    assert one(spark, T.is_code, "def f():\n    return 1", "One line", "A\nB\nC", None) == [True, False, False, None]


def test_source_kinds(spark):
    given = ["notion://x", "https://www.notion.so/p", "https://youtu.be/1", "https://a.example/x", "/a/b.PDF", "/a/b.docx", "/a/b", None]
    assert one(spark, T.source_kind, *given) == ["notion_api", "notion_api", "video", "web", "pdf", "office", "code", None]


def test_path_prefix(spark):
    assert one(spark, T.path_prefix, "/docs/current/tutorial.html", "/docs/current/", "/guide", "", None) == ["/docs/current/tutorial", "/docs/current/", "/guide", "/", "/"]


def test_clock(spark):
    assert one(spark, lambda c: T.clock(c.cast("double")), "65", "3661", "0") == ["01:05", "01:01:01", "00:00"]


def test_workspace_id(spark):
    plain = "0123456789abcdef0123456789abcdef"
    dashed = "01234567-89ab-cdef-0123-456789abcdef"
    assert one(spark, T.workspace_id, f"https://www.notion.so/Page-{plain}", dashed, "none") == [dashed, dashed, None]


def test_levels_and_concepts(spark):
    assert one(spark, T.topic_level, "What is X?", "How do you test?", "Why use it", "When should we", "Design it", "A vs B", "Plain") == ["understand", "apply", "evaluate", "analyze", "create", "analyze", "understand"]
    assert one(spark, T.concept, "What Is the Cache?", "How Do You Test?") == ["Cache", "Test"]


def test_objectives_of_parents_and_leaves(spark):
    x = spark.createDataFrame([("Design caches", True), ("Design caches", False)], "t string, p boolean")
    rows = x.select("p", F.transform(T.objectives(F.col("t"), F.col("p")), lambda o: o["bloom_level"]).alias("b")).collect()
    assert {r.p: r.b for r in rows} == {True: ["understand", "apply"], False: ["understand", "create", "evaluate"]}


def test_fragments(spark):
    x = spark.createDataFrame([(["S", "OFTWARE", "plain"],), (["TE", "MPLATE"],), (["A", "b", "C"],)], "l array<string>")
    assert [r.o for r in x.select(trees.merged_fragments(F.col("l")).alias("o")).collect()] == [["SOFTWARE", "plain"], ["TEMPLATE"], ["A", "b", "C"]]


def test_headings(spark):
    text = "1. Introduction\n1.1. Scope\n1.1 Scope\n1 will also cause\nChapter 3: Caches\nTHE GREAT CACHE\n[Gof96]\nplain"
    x = spark.createDataFrame([(1, text), (2, None), (3, "")], "d int, t string").where("t is not null")
    got = [(r.level, r.title) for r in trees.headings(x, ["d"], "t").orderBy("line_ord").collect()]
    assert got == [(1, "1 Introduction"), (2, "1.1 Scope"), (1, "Caches"), (1, "The Great Cache")]


def test_blocks(spark):
    x = spark.createDataFrame([("quote", "a\nb"), ("heading_2", "h"), ("to_do", "t"), ("code", "c"), ("odd", "x"), ("divider", None)], "k string, t string")
    got = [r.o for r in x.select(T.block_markdown(F.col("k"), F.col("t"), F.lit(True), F.lit("py"), F.lit("!"), F.lit("u")).alias("o")).collect()]
    assert got == ["> a\n> b", "## h", "- [x] t", "```py\nc\n```", "", "---"]


@pytest.mark.parametrize(("a", "b", "want"), [(1000, 300, 3.3), (5, 0, 5.0)])
def test_compression(spark, a, b, want):
    assert spark.range(1).select(T.compression(F.lit(a).cast("double"), F.lit(b)).alias("o")).first().o == want
