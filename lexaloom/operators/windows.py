"""Windows over time and rows, even distribution, first and last of groups."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexaloom.functions.text import clock, table_cell


def time_windows(segments: DataFrame, video: str, seconds: int = 300) -> DataFrame:
    """(video, window, title, n, text): segments(video, seg_ord, start, text) by tumbling windows of ``seconds``; windows without segments are left out."""
    w = F.floor(F.col("start") / seconds).cast("long")
    g = segments.where("start is not null").groupBy(video, w.alias("window")).agg(F.count("*").alias("n"), F.array_sort(F.collect_list(F.struct("seg_ord", "text"))).alias("l"))
    title = F.concat(F.lit("["), clock(F.col("window") * seconds), F.lit("-"), clock((F.col("window") + 1) * seconds), F.lit("]"))
    return g.select(video, "window", title.alias("title"), "n", F.array_join("l.text", " ").alias("text"))


def chapters(segments: DataFrame, marks: DataFrame, video: str) -> DataFrame:
    """(video, chap_ord, title, n, text): segments by chapters marks(video, chap_ord, start_time, end_time, title), start included, end not.

    A chapter without an end, or with end 0, goes to the end of the last segment;
    chapters without segments are left out.
    """
    last = segments.groupBy(video).agg(F.max(F.col("start") + F.coalesce("duration", F.lit(0.0))).alias("_last"))
    m = marks.join(last, video).withColumn("_end", F.when(F.coalesce(F.col("end_time"), F.lit(0.0)) > 0, F.col("end_time")).otherwise(F.col("_last")))
    hit = segments.join(m.select(video, "chap_ord", "title", "start_time", "_end"), video).where((F.col("start") >= F.col("start_time")) & (F.col("start") < F.col("_end")))
    g = hit.groupBy(video, "chap_ord", "title").agg(F.count("*").alias("n"), F.array_sort(F.collect_list(F.struct("seg_ord", "text"))).alias("l"))
    return g.select(video, "chap_ord", "title", "n", F.array_join("l.text", " ").alias("text"))


def row_sections(rows: DataFrame, group: list[str], order: str, columns: list[str], size: int = 50) -> DataFrame:
    """(group, section_ord, title, row_start, row_end, content): every ``size`` rows as a markdown table and as plain lines.

    ``order`` numbers the rows of a group from 0, so no row need be counted.
    """
    cells = F.concat(F.lit("| "), F.concat_ws(" | ", *[table_cell(F.col(c)) for c in columns]), F.lit(" |"))
    plain = F.concat_ws("; ", *[F.concat(F.lit(f"{c}: "), F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in columns])
    x = rows.select(*group, F.col(order).alias("_i"), F.floor(F.col(order) / size).cast("long").alias("section_ord"), cells.alias("_c"), plain.alias("_p"))
    g = x.groupBy(*group, "section_ord").agg(F.array_sort(F.collect_list(F.struct("_i", "_c", "_p"))).alias("l"))
    head = "| " + " | ".join(columns) + " |\n| " + " | ".join("---" for _ in columns) + " |\n"
    start, end = F.col("section_ord") * size + 1, F.col("section_ord") * size + F.size("l")
    content = F.concat(F.lit(head), F.array_join("l._c", "\n"), F.lit("\n\n---\n\n"), F.array_join("l._p", "\n"))
    return g.select(*group, "section_ord", F.concat(F.lit("Rows "), start.cast("string"), F.lit("-"), end.cast("string")).alias("title"), start.alias("row_start"), end.cast("long").alias("row_end"), content.alias("content"))


def distribute(items: DataFrame, group: list[str], place: str, n_items: str, n_sections: str) -> DataFrame:
    """``items`` with ``section``: items numbered from 0 go to sections in order, the same number each, what is over to the last."""
    per = F.greatest(F.lit(1), F.floor(F.col(n_items) / F.col(n_sections)))
    return items.withColumn("section", F.least(F.floor(F.col(place) / per), F.col(n_sections) - 1).cast("long"))


def top_of_group(df: DataFrame, group: list[str], order: list, n: int) -> DataFrame:
    """The first ``n`` rows of each group; the window filters before it sorts whole groups."""
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col("_r") <= n).drop("_r")


def keep_one(df: DataFrame, key: list[str], order: list[str], last: bool = False) -> DataFrame:
    """One row a key, the first or last in ``order``, by aggregation."""
    pick = F.max if last else F.min
    rest = [c for c in df.columns if c not in key and c not in order]
    return df.groupBy(*key).agg(pick(F.struct(*order, *rest)).alias("_v")).select(*key, *[F.col(f"_v.{c}").alias(c) for c in [*order, *rest]])
