"""Curricula as rows of a relational store: topics, levels, books, chunks, objectives, prerequisites, exercises.

Every function gives the rows a table is to hold; writing is the caller's. Ids
come from the natural keys, so a run that is repeated gives the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexaloom.functions.text import stripped, without_nul, word_count
from lexaloom.operators.lookup import pending, stable_id
from lexaloom.operators.trees import cyclic_nodes

# Names and descriptions of levels, and where exercises' indexes begin.
LEVELS = {
    1: ("Fundamentals", "Definitions, core concepts, basic examples"),
    2: ("Intermediate", "Techniques, patterns, comparative analysis"),
    3: ("Advanced", "Complex applications, trade-offs, synthesis"),
}
FIRST_EXERCISE = 1000


def level_rows(wanted: DataFrame, existing: DataFrame, scope: str, level: str) -> DataFrame:
    """(id, scope, level, name, description) of levels that ``wanted`` names and ``existing`` lacks; null levels are none."""
    new = wanted.where(F.col(level).isNotNull()).select(scope, level).distinct().join(existing.select(scope, level).distinct(), [scope, level], "left_anti")
    of = lambda i, other: F.coalesce(*[F.when(F.col(level) == n, v[i]) for n, v in LEVELS.items()], other)
    return new.select(stable_id(F.col(scope), F.lit("level"), F.col(level)).alias("id"), scope, level, of(0, F.concat(F.lit("Level "), F.col(level))).alias("name"), of(1, F.lit("")).alias("description"))


def with_levels(topics: DataFrame, wanted: DataFrame, levels: DataFrame, scope: str, level: str) -> DataFrame:
    """``topics`` (scope, title, depth, level_id, ...) with level_id set on those of depth 0 for which ``wanted`` (scope, title, level) names one that exists, whatever it was; of equal titles, case aside, the greatest level counts."""
    ids = levels.select(scope, level, F.col("id").alias("_lid"))
    w = wanted.where(F.col(level).isNotNull()).join(ids, [scope, level]).groupBy(scope, F.lower("title").alias("_t")).agg(F.max(F.struct(level, "_lid")).alias("_v"))
    x = topics.withColumn("_t", F.when(F.col("depth") == 0, F.lower("title"))).join(w, [scope, "_t"], "left")
    return x.withColumn("level_id", F.coalesce("_v._lid", "level_id")).drop("_t", "_v")


def title_ids(topics: DataFrame, scope: str, title: str, id_: str, order: str) -> tuple[DataFrame, DataFrame]:
    """Ids by title and by title in lower case, of equal ones the last in ``order``."""
    x = topics.where(F.col(title).isNotNull())
    exact = x.groupBy(scope, F.col(title).alias("_t")).agg(F.max(F.struct(order, id_)).alias("_v")).select(scope, "_t", F.col(f"_v.{id_}").alias("_a"))
    folded = x.groupBy(scope, F.lower(title).alias("_l")).agg(F.max(F.struct(order, id_)).alias("_v")).select(scope, "_l", F.col(f"_v.{id_}").alias("_b"))
    return exact, folded


def with_topic(rows: DataFrame, topics: DataFrame, scope: str, path: str, title: str, id_: str, order: str, key: str) -> DataFrame:
    """``rows`` with topic_id: the topic that the last title of ``path`` names, as it stands, else in lower case, else the title before; null where none is named."""
    exact, folded = title_ids(topics, scope, title, id_, order)
    x = rows.select(key, scope, F.posexplode(path).alias("_p", "_t")).withColumn("_l", F.lower("_t"))
    x = x.join(exact, [scope, "_t"], "left").join(folded, [scope, "_l"], "left").withColumn("_id", F.coalesce("_a", "_b")).where("_id is not null")
    return rows.drop("topic_id").join(x.groupBy(key).agg(F.max_by("_id", "_p").alias("topic_id")), key, "left")


def metadata_json(has_code: Column, extra: Column, images: Column) -> Column:
    """JSON of a chunk: has_code, then what ``extra`` (a map) holds, which comes first, then images with a url (id, url, alt_text)."""
    none = F.create_map().cast("map<string,string>")
    extra = F.coalesce(extra, none)
    own = F.when(F.map_contains_key(extra, "has_code"), F.lit("")).otherwise(F.concat(F.lit('"has_code":'), F.coalesce(has_code, F.lit(False)).cast("string")))
    rest = F.regexp_replace(F.to_json(extra), r"^\{|\}$", "")
    linked = F.transform(F.filter(images, lambda i: F.coalesce(i["url"], F.lit("")) != ""), lambda i: F.struct(i["id"].alias("id"), i["url"].alias("url"), i["alt_text"].alias("alt_text")))
    pictures = F.when(F.size(images) > 0, F.concat(F.lit('"images":'), F.to_json(linked))).otherwise("")
    return F.concat(F.lit("{"), F.array_join(F.filter(F.array(own, rest, pictures), lambda s: s != ""), ","), F.lit("}"))


def chunk_rows(chunks: DataFrame, topics: DataFrame, books: DataFrame, scope: str, order: str) -> DataFrame:
    """(id, chunk_id, topic_id, book_id, chunk_index, content, page_number, token_count, metadata) of the chunks to store.

    chunks: chunk_id, scope, topic_path, chunk_index, content, page_number,
    token_count, has_code, source, metadata (map), images (id, url, alt_text);
    topics: scope, title, id, ``order``; books: scope, source, book_id, ord. A
    chunk belongs to the most specific topic its path names and to the book of its
    source, else its scope's first. Blank ones and those of no topic are left out.
    """
    x = chunks.where(stripped(F.coalesce("content", F.lit(""))) != "")
    x = with_topic(x, topics, scope, "topic_path", "title", "id", order, "chunk_id").where("topic_id is not null")
    by_source = books.where("source is not null").groupBy(scope, "source").agg(F.max(F.struct("ord", "book_id")).alias("_own"))
    first = books.groupBy(scope).agg(F.min(F.struct("ord", "book_id")).alias("_first"))
    x = x.join(by_source, [scope, "source"], "left").join(first, scope, "left")
    return x.select(
        stable_id(F.col("topic_id"), F.col("chunk_id")).alias("id"), "chunk_id", "topic_id", F.coalesce("_own.book_id", "_first.book_id").alias("book_id"), F.coalesce("chunk_index", F.lit(0)).alias("chunk_index"),
        without_nul(stripped(F.col("content"))).alias("content"), "page_number", "token_count", metadata_json(F.col("has_code"), F.col("metadata"), F.col("images")).alias("metadata"),
    )


def store_chunks(existing: DataFrame, new: DataFrame, replace: bool = False) -> DataFrame:
    """The chunks table after an update: all of ``existing`` (topic_id, chunk_index, ...) and of ``new``, with ``action``.

    Without ``replace`` new rows whose (topic_id, chunk_index) is there are
    'skipped', and kept out by the caller; with it all rows of topics that ``new``
    has chunks for are 'replaced' and those of ``new`` 'inserted'.
    """
    new = new.select(*existing.columns)
    if replace:
        touched = new.select("topic_id").distinct().withColumn("_hit", F.lit(True))
        old = existing.join(touched, "topic_id", "left").withColumn("action", F.when(F.col("_hit"), "replaced").otherwise("kept")).drop("_hit")
        return old.unionByName(new.withColumn("action", F.lit("inserted")))
    keys = existing.select("topic_id", "chunk_index").distinct().withColumn("_hit", F.lit(True))
    added = new.join(keys, ["topic_id", "chunk_index"], "left").withColumn("action", F.when(F.col("_hit"), "skipped").otherwise("inserted")).drop("_hit")
    return existing.withColumn("action", F.lit("kept")).unionByName(added)


def prerequisite_rows(wanted: DataFrame, topics: DataFrame, scope: str, order: str) -> DataFrame:
    """(id, scope, topic_id, prerequisite_topic_id, strength) of the prerequisites to store.

    wanted: scope, title, prerequisite, strength; topics: scope, title, id,
    ``order``. Both ends are looked up by title, case as a fallback; what isn't
    found and what points at itself is left out; an edge given more than once
    counts once, the stricter strength standing; a null strength is
    'recommended'. A scope whose edges hold a cycle has none of them stored.
    """
    exact, folded = title_ids(topics, scope, "title", "id", order)
    x = wanted
    for name, out in (("title", "topic_id"), ("prerequisite", "prerequisite_topic_id")):
        x = x.withColumn("_t", F.col(name)).withColumn("_l", F.lower(name)).join(exact, [scope, "_t"], "left").join(folded, [scope, "_l"], "left")
        x = x.withColumn(out, F.coalesce("_a", "_b")).drop("_t", "_l", "_a", "_b")
    e = x.where("topic_id <> prerequisite_topic_id").groupBy(scope, "topic_id", "prerequisite_topic_id").agg(F.max(F.coalesce("strength", F.lit("recommended"))).alias("strength"))
    bad = cyclic_nodes(e, "prerequisite_topic_id", "topic_id")
    spoiled = e.join(bad.withColumnRenamed("node", "topic_id"), "topic_id", "left_semi").select(scope).distinct()
    return e.join(spoiled, scope, "left_anti").select(stable_id(F.col("topic_id"), F.col("prerequisite_topic_id")).alias("id"), scope, "topic_id", "prerequisite_topic_id", "strength")


def exercise_rows(exercises: DataFrame, topics: DataFrame, books: DataFrame, scope: str, order: str) -> DataFrame:
    """(id, topic_id, book_id, chunk_index, content, page_number, token_count, metadata): exercises as chunks from index 1000 on.

    exercises: key, scope, topic_path, exercises. An exercise without a statement
    is left out, its number too; tokens are words; one whose solution has a fence
    has code; all belong to the scope's first book.
    """
    x = with_topic(exercises, topics, scope, "topic_path", "title", "id", order, "key").where("topic_id is not null")
    first = books.groupBy(scope).agg(F.min(F.struct("ord", "book_id")).alias("_first"))
    x = x.join(first, scope, "left").select("topic_id", F.col("_first.book_id").alias("book_id"), "key", F.posexplode("exercises").alias("j", "e"))
    x = x.withColumn("content", without_nul(F.coalesce("e.problem_statement", F.lit("")))).where("content <> ''")
    e = F.struct(
        F.coalesce("e.title", F.lit("")).alias("title"), F.coalesce("e.hints", F.array().cast("array<string>")).alias("hints"), F.coalesce("e.expected_solution", F.lit("")).alias("expected_solution"),
        F.coalesce("e.common_mistakes", F.array().cast("array<string>")).alias("common_mistakes"), F.coalesce("e.bloom_level", F.lit("apply")).alias("bloom_level"), F.coalesce("e.difficulty", F.lit(1)).alias("difficulty"),
    )
    code = F.coalesce(F.contains(F.col("e.expected_solution"), F.lit("```")), F.lit(False))
    meta = F.to_json(F.struct(F.lit("exercise").alias("type"), code.alias("has_code"), e.alias("exercise")))
    return x.select(stable_id(F.col("topic_id"), F.col("key"), F.col("j")).alias("id"), "topic_id", "book_id", (F.col("j") + FIRST_EXERCISE).alias("chunk_index"), "content", F.lit(None).cast("int").alias("page_number"), word_count(F.col("content")).alias("token_count"), meta.alias("metadata"))


def cleared(objectives: DataFrame, prerequisites: DataFrame, chunks: DataFrame, topics: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three tables without the enrichment of ``topics`` (id): their objectives, the prerequisites they have, and their exercises (chunks from index 1000 on)."""
    mine = topics.select(F.col("id").alias("topic_id")).distinct()
    a, b = objectives.join(mine, "topic_id", "left_anti"), prerequisites.join(mine, "topic_id", "left_anti")
    exercise = F.col("chunk_index") >= FIRST_EXERCISE
    return a, b, chunks.where(~exercise | F.col("chunk_index").isNull()).unionByName(chunks.where(exercise).join(mine, "topic_id", "left_anti"))


def enriched(old: tuple[DataFrame, DataFrame, DataFrame], new: tuple[DataFrame, DataFrame, DataFrame], topics: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Objectives, prerequisites and chunks with the enrichment of ``topics`` made anew; run twice it gives the same."""
    kept = cleared(*old, topics)
    return tuple(k.unionByName(n.select(*k.columns)) for k, n in zip(kept, new, strict=True))


def domain_id(results: DataFrame, manifests: DataFrame, domains: DataFrame, key: str) -> DataFrame:
    """(key, domain_id): that of an earlier upload, else the one the manifest names, else that of the domain's slug; null for none."""
    x = manifests.select(key, "exported_domain_id", F.lower(F.replace("domain", F.lit(" "), F.lit("-"))).alias("slug")).join(results.select(key, F.col("domain_id").alias("_r")), key, "left")
    x = x.join(domains.where("slug <> ''").groupBy("slug").agg(F.min("id").alias("_s")), "slug", "left")
    empty = lambda c: F.nullif(F.col(c), F.lit(""))
    return x.select(key, F.coalesce(empty("_r"), empty("exported_domain_id"), "_s").alias("domain_id"))


def migrations(files: DataFrame, applied: DataFrame) -> DataFrame:
    """(version, name) of files(name) that are to be applied, by the digits they begin with."""
    x = files.select(F.regexp_extract("name", r"^(\d+)", 1).alias("version"), "name").where("version <> '' and name like '%.sql'")
    return pending(x, applied.select("version").distinct(), "version")
