"""Pieces: whole text, limits, overlaps, boundaries."""

from hypothesis import given, settings
from hypothesis import strategies as st

from lexaloom.llm import splitting


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab .\n,。é́`#", max_size=400), st.integers(20, 60), st.integers(0, 15))
def test_pieces_hold_the_text(text, limit, overlap):
    got = splitting.pieces(text, limit, overlap)
    assert all(0 < b - a <= limit for a, b in got)
    if not text:
        assert got == []
        return
    assert got[0][0] == 0 and got[-1][1] == len(text)
    for (_, end), (start, _) in zip(got, got[1:], strict=False):
        assert start == max(0, end - overlap)
    assert len(got) == 1 if len(text) <= limit else len(got) > 1


def test_natural_boundaries_come_first():
    text = "\n\n".join(["One two three. Four five six."] * 6)
    cuts = [b for _, b in splitting.pieces(text, 70, 0)]
    assert all(text[c - 2 : c] == "\n\n" for c in cuts[:-1])


def test_operator(spark):
    rows = [(1, "word " * 30, "z"), (2, "short", "z"), (3, None, "z"), (4, "", "z"), (None, "word " * 30, "z"), (5, "x" * 100, "z"), (5, "x" * 100, "z")]
    from pyspark.sql import functions as F

    x = spark.createDataFrame(rows, "id long, content string, piece string").withColumn("m", F.lit(50)).withColumn("o", F.lit(10))
    got = splitting.split_oversized(x, "id", "content", "m", "o").distinct().orderBy("id", "piece").collect()
    assert {r.id for r in got} == {1, 5}
    for r in got:
        assert len(r.content) == r.end_char - r.start_char <= 50 and r.token_count > 0
    assert splitting.split_oversized(x.limit(0), "id", "content", "m", "o").count() == 0


def test_tables_with_limits_missing(spark, tmp_path):
    """One limit, none, and deliveries that differ."""
    from datetime import datetime

    from lexaloom.llm import queries

    at = [datetime(2024, 1, i) for i in (1, 2, 3)]
    spark.createDataFrame([(1, at[0], "a b " * 30), (1, at[1], "c d " * 30), (2, at[0], "e f " * 30), (2, at[2], "short"), (3, None, "g h " * 30), (None, at[0], "i " * 90)], "section_id long, extracted_at timestamp, content string").write.parquet(f"{tmp_path}/extracted.parquet")
    spark.createDataFrame([(9, at[0], "j k " * 30)], "chunk_id long, chunked_at timestamp, content string").write.parquet(f"{tmp_path}/chunks.parquet")
    limits = spark.createDataFrame([("extracted", 50, 10)], "item_table string, max_chars int, overlap_chars int")
    limits.write.parquet(f"{tmp_path}/split_limits.parquet")
    assert {(r.tbl, r.record_id) for r in queries.p6_found(spark, str(tmp_path)).collect()} == {("extracted", 1), ("extracted", 2), ("extracted", 3)}
    got = queries.p6_pieces(spark, str(tmp_path)).collect()
    assert {r.record_id for r in got} == {1, 3}  # the last delivery of 2 is short
    assert all("c" in r.content for r in got if r.record_id == 1)
    limits.limit(0).write.mode("overwrite").parquet(f"{tmp_path}/split_limits.parquet")
    assert queries.p6_found(spark, str(tmp_path)).count() == queries.p6_pieces(spark, str(tmp_path)).count() == 0
