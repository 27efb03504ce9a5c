"""Queries of the text operators, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexaloom.llm import leaks, lookalike, mixing, scans, sentences, spans, splitting, tokens
from lexaloom.sources.tables import latest, table


def _records(spark: SparkSession, d: str) -> DataFrame:
    """(tbl, id, content) of sections and chunks."""
    a = table(spark, d, "extracted").select(F.lit("extracted").alias("tbl"), F.col("section_id").alias("id"), "content")
    return a.unionByName(table(spark, d, "chunks").select(F.lit("chunks").alias("tbl"), F.col("chunk_id").alias("id"), "content"))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Records of one table with a common stretch of 240 characters."""
    return spans.shared_pairs(_records(spark, d))


def p1_shared(spark: SparkSession, d: str) -> DataFrame:
    """How much of each record is shared elsewhere."""
    x = spans.shared_share(_records(spark, d))
    return x.select("tbl", "id", F.col("n_chars").cast("long").alias("n_chars"), F.col("shared_chars").cast("long").alias("shared_chars"))


def p1_classes(spark: SparkSession, d: str) -> DataFrame:
    """The records that have a stretch in common, a row for each record of each stretch."""
    return spans.shared_classes(_records(spark, d))


def _scans(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "extracted").select("section_id", "source_type", "title", "content", "metadata")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Headers, page numbers, cut and misread words in scanned sections."""
    return scans.line_kinds(_scans(spark, d))


def p3_text(spark: SparkSession, d: str) -> DataFrame:
    """Scanned sections as continuous paragraphs."""
    return scans.repaired(_scans(spark, d))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Chunks whose stored token count can't be used."""
    chunks = table(spark, d, "chunks").where("chunk_id is not null").select("chunk_id", "content", "token_count")
    return tokens.with_tokens(chunks).where("not usable").select("chunk_id").distinct()


def p4_budget(spark: SparkSession, d: str) -> DataFrame:
    """Tokens by source, language and domain."""
    chunks = table(spark, d, "chunks").select("chunk_id", "curriculum_id", "content", "token_count", "source", "chunked_at")
    sections = table(spark, d, "extracted").select("section_id", "curriculum_id", "source_type", "source_path", F.element_at("metadata", "language").alias("language"))
    return tokens.budget(chunks, sections, table(spark, d, "manifest").select("curriculum_id", "domain"))


def _titles(spark: SparkSession, d: str) -> DataFrame:
    """(record_id, curriculum_id, title) of sections and root topics, the last delivery of each."""
    a = latest(table(spark, d, "extracted"), "section_id", "extracted_at", ["curriculum_id", "title"])
    b = latest(table(spark, d, "structure"), "structure_id", "saved_at", ["curriculum_id", "title"])
    return a.withColumnRenamed("section_id", "record_id").unionByName(b.withColumnRenamed("structure_id", "record_id"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Titles of one curriculum that look the same but differ."""
    return lookalike.look_alike_pairs(_titles(spark, d), "curriculum_id", "record_id", "title")


def p5_classes(spark: SparkSession, d: str) -> DataFrame:
    """Records of one curriculum whose titles look the same but differ, a row a record."""
    return lookalike.look_alike_classes(_titles(spark, d), "curriculum_id", "record_id", "title")


def p5_titles(spark: SparkSession, d: str) -> DataFrame:
    """Every title in its one form."""
    return lookalike.one_form_column(_titles(spark, d), "title", "form")


def _oversized(spark: SparkSession, d: str, once: bool) -> DataFrame:
    """Pieces of the records over their table's limit; with ``once`` of each record's last delivery. A table without a limit gives none."""
    limits = {r.item_table: r for r in table(spark, d, "split_limits").where("item_table is not null and max_chars is not null").collect()}  # a row a table: two
    out = None
    for name, key, stamp in (("extracted", "section_id", "extracted_at"), ("chunks", "chunk_id", "chunked_at")):
        most, overlap = (limits[name].max_chars, limits[name].overlap_chars or 0) if name in limits else (None, 0)
        every = table(spark, d, name).select(F.col(key).alias("record_id"), F.col(stamp).alias("stamp"), "content")
        rows = every.where(F.length("content") > F.lit(most).cast("int"))
        if once:  # only long texts are shuffled, to meet the stamp of their last delivery
            last = every.groupBy("record_id").agg(F.max("stamp").alias("last"))
            rows = latest(rows.join(last, "record_id").where(F.col("stamp").eqNullSafe(F.col("last"))), "record_id", "stamp", ["content"])
        rows = rows.select("record_id", "content", F.lit(most).cast("int").alias("max_chars"), F.lit(overlap).cast("int").alias("overlap_chars"))
        pieces = splitting.split_oversized(rows, "record_id", "content", "max_chars", "overlap_chars").withColumn("tbl", F.lit(name))
        out = pieces if out is None else out.unionByName(pieces)
    return out


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Records that had to be cut."""
    return _oversized(spark, d, once=False).where("piece > 0").select("tbl", "record_id").distinct()


def p6_pieces(spark: SparkSession, d: str) -> DataFrame:
    """The pieces of every record that had to be cut."""
    return _oversized(spark, d, once=True).select("tbl", "record_id", "piece", "start_char", "end_char", "content", "token_count")


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents and the items they have a run of words or characters in common with."""
    return leaks.leaked_runs(table(spark, d, "documents").select("doc_id", "text"), table(spark, d, "eval_items"))


def p7_near(spark: SparkSession, d: str) -> DataFrame:
    """Documents with passages near an item's, paraphrases included."""
    return leaks.leaks(table(spark, d, "documents").select("doc_id", "text"), table(spark, d, "eval_items"))


def p8_mix(spark: SparkSession, d: str) -> DataFrame:
    """How often each document is used so that sources give their target shares."""
    return mixing.mix(table(spark, d, "documents").select("doc_id", "source", "text"), table(spark, d, "mix_targets"))


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    """The shares that came out, source by source."""
    return mixing.shares(p8_mix(spark, d), table(spark, d, "mix_targets"))


def p8_even(spark: SparkSession, d: str) -> DataFrame:
    """As p8_mix, at the largest total at which every source with text meets its share."""
    return mixing.mix(table(spark, d, "documents").select("doc_id", "source", "text"), table(spark, d, "mix_targets"), even=True)


def p8_even_shares(spark: SparkSession, d: str) -> DataFrame:
    """The shares that came out of p8_even."""
    return mixing.shares(p8_even(spark, d), table(spark, d, "mix_targets"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    """Sentence units of all documents."""
    return sentences.sentence_units(table(spark, d, "documents"), "doc_id", "text", "lang")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (p1_found, p1_shared, p1_classes, p3_found, p3_text, p4_found, p4_budget, p5_found, p5_classes, p5_titles, p6_found, p6_pieces, p7_found, p7_near, p8_mix, p8_shares, p8_even, p8_even_shares, p9_found)
}

#: All windows of 240 characters of both tables, and those that two records of one table have.
WINDOWS = """r AS (SELECT DISTINCT 'extracted' AS tbl, section_id AS id, content FROM extracted WHERE length(content) >= 240 AND section_id IS NOT NULL UNION ALL SELECT DISTINCT 'chunks', chunk_id, content FROM chunks WHERE length(content) >= 240 AND chunk_id IS NOT NULL),
        w AS (SELECT DISTINCT tbl, id, i, md5_number(substr(content, i, 240)) AS h FROM (SELECT tbl, id, content, unnest(range(1, length(content) - 238)) AS i FROM r)),
        s AS (SELECT tbl, h FROM w GROUP BY 1, 2 HAVING min(id) <> max(id))"""

SQL = {
    "p1_found": f"""
        WITH {WINDOWS}, m AS (SELECT DISTINCT tbl, h, id FROM w JOIN s USING (tbl, h)), c AS (SELECT tbl, min(h) AS h FROM (SELECT tbl, h, list(id ORDER BY id) AS ids FROM m GROUP BY 1, 2) GROUP BY tbl, ids), k AS (SELECT m.* FROM m JOIN c USING (tbl, h))
        SELECT DISTINCT a.tbl, a.id AS id_a, b.id AS id_b FROM k a JOIN k b ON a.tbl = b.tbl AND a.h = b.h AND a.id < b.id""",
    "p1_shared": f"""
        WITH {WINDOWS}, x AS (SELECT tbl, id, i, lead(i) OVER (PARTITION BY tbl, id ORDER BY i) AS nxt FROM (SELECT DISTINCT tbl, id, i FROM w JOIN s USING (tbl, h))),
        g AS (SELECT tbl, id, sum(least(240, coalesce(nxt - i, 240))) AS n FROM x GROUP BY 1, 2),
        z AS (SELECT 'extracted' AS tbl, section_id AS id, max(length(content)) AS n_chars FROM extracted WHERE content IS NOT NULL AND section_id IS NOT NULL GROUP BY 2 UNION ALL SELECT 'chunks', chunk_id, max(length(content)) FROM chunks WHERE content IS NOT NULL AND chunk_id IS NOT NULL GROUP BY 2)
        SELECT tbl, id, n_chars, CAST(coalesce(n, 0) AS BIGINT) AS shared_chars FROM z LEFT JOIN g USING (tbl, id)""",
    "p6_found": """
        SELECT DISTINCT 'extracted' AS tbl, section_id AS record_id FROM extracted, split_limits
        WHERE item_table = 'extracted' AND length(content) > max_chars
        UNION ALL
        SELECT DISTINCT 'chunks' AS tbl, chunk_id AS record_id FROM chunks, split_limits
        WHERE item_table = 'chunks' AND length(content) > max_chars""",
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
