"""Token counts against the library that made the vocabulary's format."""

import base64
import os
import random

import pytest
from pyspark.sql import functions as F

from lexaloom.llm import tokens

pytestmark = pytest.mark.skipif(not os.path.exists(tokens.VOCABULARY), reason="no vocabulary here")


def reference():
    import tiktoken

    with open(tokens.VOCABULARY, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=tokens.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_counts_equal_the_library(spark):
    rng = random.Random(4)
    parts = ["aaaaaaaaab", "Hello, world!", "it's 12345", "数据库查询", "ผู้อ่าน", "naïve café", "½ ² Ⅱ", "__init__", "\n\n  \t", "😀👍🏽", "　x", "x" * 5000, "éé", "Привет"]
    texts = ["".join(rng.choice(parts) + rng.choice(["", " ", "  "]) for _ in range(rng.randint(1, 20))) for _ in range(200)] + ["", None]
    enc = reference()
    x = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r.i: r.n for r in x.select("i", tokens.token_count(F.col("t")).alias("n")).collect()}
    assert got == {i: None if t is None else len(enc.encode_ordinary(t)) for i, t in enumerate(texts)}


def test_unusable(spark):
    x = spark.createDataFrame([(1, "some words here", 3), (2, "some words here", 300), (3, "some words here", None), (4, "a", -1), (5, None, 0), (6, "word " * 50, 1)], "chunk_id long, content string, token_count int")
    assert {r.chunk_id for r in tokens.with_tokens(x).where("not usable").collect()} == {2, 3, 4, 5, 6}


def test_budget(spark):
    chunks = spark.createDataFrame([(1, 7, "a b c", 3, "/A/x.pdf "), (1, 7, "a b c", 3, "/A/x.pdf "), (2, 7, None, None, "/a//x.pdf"), (3, None, "a", 1, None)], "chunk_id long, curriculum_id long, content string, token_count int, source string")
    sections = spark.createDataFrame([(1, 7, "PDF", "/a/x.pdf", "EN"), (2, 7, None, "/a/x.pdf", None)], "section_id long, curriculum_id long, source_type string, source_path string, language string")
    manifest = spark.createDataFrame([(7, "Data Bases")], "curriculum_id long, domain string")
    got = {tuple(r) for r in tokens.budget(chunks, sections, manifest).collect()}
    assert got == {("pdf", "/a/x.pdf", "en", "data-bases", 2, 3, 3), ("unknown", "unknown", "unknown", "unknown", 1, 1, 1)}
    assert tokens.budget(chunks.limit(0), sections, manifest).count() == 0
