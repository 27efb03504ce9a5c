"""Lookups and merges between tables: by title with fallback, by most specific match, incremental writes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexaloom.functions.text import normalized, stripped


def section_index(sections: DataFrame, scope: list[str], title: str, content: str, order: list[str]) -> DataFrame:
    """(scope, key, content): content by title and by title in lower case, of equal keys the last in ``order``.

    Null and blank titles are left out. Aggregated before it is shuffled.
    """
    t = normalized(F.col(title))
    x = sections.where(stripped(F.col(title)) != "").select(*scope, F.explode(F.array_distinct(F.array(t, F.lower(t)))).alias("key"), F.struct(*order, content).alias("v"))
    return x.groupBy(*scope, "key").agg(F.max("v").alias("v")).select(*scope, "key", F.col(f"v.{content}").alias(content))


def look_up(refs: DataFrame, index: DataFrame, scope: list[str], name: str, content: str) -> DataFrame:
    """``refs`` with ``content`` of the title it names: as it stands, else in lower case; an empty content falls through too. Null where there is none."""
    t = normalized(F.col(name))
    a = index.select(*scope, F.col("key").alias("_k1"), F.col(content).alias("_c1"))
    b = index.select(*scope, F.col("key").alias("_k2"), F.col(content).alias("_c2"))
    x = refs.withColumn("_k1", t).withColumn("_k2", F.lower(t))
    x = x.join(a, [*scope, "_k1"], "left").join(b, [*scope, "_k2"], "left")
    return x.withColumn(content, F.coalesce(F.nullif(F.col("_c1"), F.lit("")), F.col("_c2"))).drop("_k1", "_k2", "_c1", "_c2")


def most_specific(items: DataFrame, key: str, path: str, topics: DataFrame, scope: list[str], title: str, topic_id: str) -> DataFrame:
    """(key, topic_id): the topic named by the last title of ``path`` that names any, at each level as it stands before in lower case; of topics of one title the last id."""
    exact = topics.groupBy(*scope, F.col(title).alias("_t")).agg(F.max(topic_id).alias("_a"))
    folded = topics.groupBy(*scope, F.lower(title).alias("_l")).agg(F.max(topic_id).alias("_b"))
    x = items.select(key, *scope, F.posexplode(path).alias("_p", "_t")).withColumn("_l", F.lower("_t"))
    x = x.join(exact, [*scope, "_t"], "left").join(folded, [*scope, "_l"], "left").withColumn("_id", F.coalesce("_a", "_b"))
    return x.where("_id is not null").groupBy(key).agg(F.max_by("_id", "_p").alias(topic_id))


def stale_references(refs: DataFrame, sections: DataFrame, scope: list[str], name: str, title: str) -> DataFrame:
    """References whose title no section of the scope has, case aside."""
    have = sections.where(F.col(title).isNotNull()).select(*scope, F.lower(normalized(F.col(title))).alias("_k")).distinct()
    return refs.withColumn("_k", F.lower(normalized(F.col(name)))).join(have, [*scope, "_k"], "left_anti").drop("_k")


def kept_prerequisites(prerequisites: Column, kept: Column) -> Column:
    """Of array<struct<topic, ...>> those whose topic is among ``kept`` (lower case); empty for null."""
    none = F.filter(prerequisites, lambda p: F.lit(False))
    return F.coalesce(F.filter(prerequisites, lambda p: F.array_contains(kept, F.lower(p["topic"]))), none)


def upsert_skip(existing: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``existing`` and those of ``new`` whose key it lacks, with ``action`` 'kept' or 'inserted'; null keys count as equal. Of equal new keys all go in."""
    cond = [existing[k].eqNullSafe(new[k]) for k in keys]
    added = new.join(existing.select(*keys).distinct(), on=cond, how="left_anti")
    return existing.withColumn("action", F.lit("kept")).unionByName(added.withColumn("action", F.lit("inserted")))


def upsert_replace(existing: DataFrame, new: DataFrame, group: list[str]) -> DataFrame:
    """``new``, and those of ``existing`` whose group ``new`` doesn't touch."""
    kept = existing.join(new.select(*group).distinct(), group, "left_anti")
    return kept.withColumn("action", F.lit("kept")).unionByName(new.withColumn("action", F.lit("inserted")))


def get_or_create(existing: DataFrame, new: DataFrame, key: str, fill: list[str]) -> DataFrame:
    """All keys of both, existing values first and those of ``new`` only where these are null."""
    a = existing.select(F.col(key), *[F.col(c).alias(f"_{c}") for c in fill], F.lit(True).alias("_old"))
    x = new.groupBy(key).agg(*[F.max(c).alias(c) for c in fill]).join(a, key, "full")
    return x.select(key, *[F.coalesce(f"_{c}", c).alias(c) for c in fill], F.col("_old").isNull().alias("created"))


def stable_id(*parts: Column) -> Column:
    """An id that is the same for the same parts."""
    return F.sha2(F.to_json(F.array(*[p.cast("string") for p in parts])), 256)


def topic_rows(flat: DataFrame) -> DataFrame:
    """Topics as rows of a table with ids from their whole paths: (id, parent_id, curriculum_id, title, depth, sort_order)."""
    x = flat.where("kind = 'topic'")
    own = stable_id(F.col("key"), F.col("path"))
    parent = F.when(F.col("parent_path").isNotNull(), stable_id(F.col("key"), F.col("parent_path")))
    return x.select(own.alias("id"), parent.alias("parent_id"), F.col("grp").alias("curriculum_id"), "title", (F.size("titles") - 1).alias("depth"), F.col("position").alias("sort_order"))


def with_parent_titles(topics: DataFrame) -> DataFrame:
    """Topics with the title of their parent in lower case: a self-join by id."""
    p = topics.select(F.col("id").alias("parent_id"), F.lower("title").alias("parent_title"))
    return topics.join(p, "parent_id", "left")


def new_topics(topics: DataFrame, existing: DataFrame) -> DataFrame:
    """Those topics whose (title in lower case, depth, parent's title in lower case) ``existing`` lacks, nulls being equal."""
    a = with_parent_titles(topics).withColumn("_t", F.lower("title"))
    b = with_parent_titles(existing).select(F.lower("title").alias("_bt"), F.col("depth").alias("_bd"), F.col("parent_title").alias("_bp")).distinct()
    return a.join(b, (a["_t"].eqNullSafe(b["_bt"])) & (a["depth"] == b["_bd"]) & (a["parent_title"].eqNullSafe(b["_bp"])), "left_anti").drop("_t")


def match_books(wanted: DataFrame, books: DataFrame) -> DataFrame:
    """(source_path, title, book_id): a book by file name first, else by title in lower case; null for a new one."""
    by_file = books.where("file_name is not null").groupBy("file_name").agg(F.min("book_id").alias("_a"))
    by_title = books.where("title is not null").groupBy(F.lower("title").alias("_t")).agg(F.min("book_id").alias("_b"))
    x = wanted.withColumn("file_name", F.regexp_extract("source_path", "([^/]*)$", 1)).withColumn("_t", F.lower("title"))
    x = x.join(by_file, "file_name", "left").join(by_title, "_t", "left")
    return x.select("source_path", "title", F.coalesce("_a", "_b").alias("book_id"))


def objective_rows(topics: DataFrame, key: str, objectives: str) -> DataFrame:
    """(key, sort_order, text, bloom_level), blank levels as 'understand'."""
    x = topics.select(key, F.posexplode(objectives).alias("sort_order", "o"))
    return x.select(key, "sort_order", "o.text", F.coalesce(F.nullif(F.col("o.bloom_level"), F.lit("")), F.lit("understand")).alias("bloom_level"))


def exercise_rows(exercises: DataFrame, path: str, items: str) -> DataFrame:
    """Exercises as chunks: index from 1000 on (skipped ones count), tokens as words, has_code by a fence in the solution; empty statements are left out."""
    from lexaloom.functions.text import word_count

    x = exercises.select(path, F.posexplode(items).alias("j", "e")).where(F.coalesce(F.col("e.problem_statement"), F.lit("")) != "")
    meta = F.to_json(F.struct(F.col("e.title").alias("title"), F.col("e.bloom_level").alias("bloom_level"), F.col("e.difficulty").alias("difficulty"), F.col("e.hints").alias("hints"), F.lit(True).alias("is_exercise")))
    return x.select(
        path, (F.col("j") + 1000).alias("chunk_index"), F.col("e.problem_statement").alias("content"), word_count(F.col("e.problem_statement")).alias("token_count"),
        F.coalesce(F.contains(F.col("e.expected_solution"), F.lit("```")), F.lit(False)).alias("has_code"), meta.alias("metadata"),
    )


def chunk_metadata(own: Column, extra: Column) -> Column:
    """Two map<string,string> as one JSON text, the second's values first; NUL characters out."""
    from lexaloom.functions.text import without_nul

    return without_nul(F.to_json(F.map_concat(F.map_filter(F.coalesce(own, F.create_map().cast("map<string,string>")), lambda k, v: ~F.map_contains_key(F.coalesce(extra, F.create_map().cast("map<string,string>")), k)), F.coalesce(extra, F.create_map().cast("map<string,string>")))))


def with_image_links(content: Column, images: Column, base: str) -> Column:
    """Content with a markdown link for every image at its end."""
    link = lambda i: F.concat(F.lit("!["), F.coalesce(i["alt_text"], F.lit("")), F.lit(f"]({base}/"), i["local_path"], F.lit(")"))
    links = F.array_join(F.transform(F.filter(images, lambda i: i["local_path"].isNotNull()), link), "\n")
    return F.when(F.coalesce(links, F.lit("")) == "", content).otherwise(F.concat_ws("\n\n", content, links))


def merge_analysis(registry: DataFrame, analysis: DataFrame, key: str) -> DataFrame:
    """Image registry with what an analysis found: a description replaces the text only if it isn't empty, other findings only where given; of one image the last by description counts."""
    a = analysis.groupBy(key).agg(F.max(F.struct(F.nullif("description", F.lit("")).alias("d"), F.nullif("ocr_text", F.lit("")).alias("o"), F.nullif("educational_value", F.lit("")).alias("v"))).alias("a"))
    x = registry.join(a, key, "left")
    out = x.withColumn("alt_text", F.coalesce("a.d", "alt_text"))
    for c, f in (("ocr_text", "o"), ("educational_value", "v")):
        out = out.withColumn(c, F.coalesce(f"a.{f}", c) if c in registry.columns else F.col(f"a.{f}"))
    return out.drop("a")


def first_containing(marks: DataFrame, sections: DataFrame, scope: list[str], mark: str, content: str, order: str) -> DataFrame:
    """For each mark the first section of its scope that contains it."""
    hit = marks.join(sections, scope).where(F.contains(F.col(content), F.col(mark)))
    return hit.groupBy(*scope, mark).agg(F.min(order).alias(order))


def pending(all_: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows of ``all_`` whose key isn't among those done."""
    return all_.join(done.select(key), key, "left_anti")


def numbered(df: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """Running numbers from 0 within groups."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*group).orderBy(*order)) - 1)
