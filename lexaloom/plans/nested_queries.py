"""Queries over nested records."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexaloom.operators import nested
from lexaloom.session import cut
from lexaloom.sources.tables import latest, table


def _flat(spark: SparkSession, d: str) -> DataFrame:
    rows = latest(table(spark, d, "structure"), "structure_id", "saved_at", ["curriculum_id", "title", "source_sections", "children"])
    return nested.flatten(rows, "structure_id", "curriculum_id", "title", "source_sections", "children")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Links of topics to their parents, sections and chunks."""
    chunks = latest(table(spark, d, "chunks"), "chunk_id", "chunked_at", ["curriculum_id", "topic_path"])
    return nested.links(cut(_flat(spark, d)), chunks)  # read three times: trees are walked once


def p2_topics(spark: SparkSession, d: str) -> DataFrame:
    """All topics, flat."""
    x = nested.topics(_flat(spark, d))
    return x.withColumn("position", F.col("position").cast("long")).withColumn("depth", F.col("depth").cast("long"))


def p2_sections(spark: SparkSession, d: str) -> DataFrame:
    """All section references, flat."""
    return nested.section_references(_flat(spark, d)).withColumn("position", F.col("position").cast("long"))


def oracle_sql() -> dict[str, str]:
    from lexaloom.plans.chunk_queries import TREE

    head = f"WITH RECURSIVE {TREE}, c0 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY chunk_id ORDER BY chunked_at DESC NULLS LAST, curriculum_id DESC, topic_path DESC NULLS LAST) AS r FROM chunks WHERE chunk_id IS NOT NULL) WHERE r = 1)"
    return {
        "p2_topics": head + " SELECT structure_id, curriculum_id, path, parent_path, position, CAST(len(titles) - 1 AS BIGINT) AS depth, title FROM nodes",
        "p2_sections": head + " SELECT structure_id, path, position, item AS section FROM items WHERE kind = 'section'",
        "p2_found": head
        + """ SELECT structure_id, 'child' AS link_kind, parent_path, path AS item FROM nodes WHERE parent_path IS NOT NULL
        UNION ALL SELECT structure_id, 'section', path, CAST(position AS VARCHAR) FROM items WHERE kind = 'section'
        UNION ALL SELECT n.structure_id, 'chunk', n.path, CAST(c.chunk_id AS VARCHAR) FROM nodes n JOIN c0 c ON c.curriculum_id = n.curriculum_id AND c.topic_path = n.titles WHERE len(list_filter(n.titles, lambda t: t IS NULL)) = 0""",
    }


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p2_found, p2_topics, p2_sections)}
