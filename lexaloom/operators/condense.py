"""Condensed variants of a curriculum, and measures of its quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexaloom.functions.text import LEVEL_VERBS, compression, is_book_meta, slug, strip_prefix, stripped, word_count

# Exercises a topic keeps by tier.
EXERCISES_KEPT = {"detailed": 3, "classic": 1, "core": 0}


def stats(chunks: DataFrame, group: list[str], content: str = "content", tokens: str = "token_count") -> DataFrame:
    """(group, chunks, tokens): a missing count is replaced by the words of the content."""
    n = F.coalesce(F.col(tokens).cast("long"), word_count(F.col(content)), F.lit(0))
    return chunks.groupBy(*group).agg(F.count("*").alias("chunks"), F.sum(n).alias("tokens"))


def plan_leaves(plan: DataFrame) -> DataFrame:
    """(tier, topic_ord, child_ord, path, strategy, content, keys) of a two-level plan.

    Keys of sources are source_children, else source_topics, else the own title.
    A topic without children is a leaf itself.
    """
    none = F.col("source_topics").isNull() | (F.size("source_topics") == 0)
    top = plan.where(F.col("children").isNull() | (F.size("children") == 0)).select(
        "tier", "topic_ord", F.lit(-1).alias("child_ord"), F.array("title").alias("path"), F.col("condensation_strategy").alias("strategy"), "content", F.when(none, F.array("title")).otherwise(F.col("source_topics")).alias("keys")
    )
    c = plan.select("tier", "topic_ord", F.col("title").alias("_t"), F.posexplode("children").alias("child_ord", "c"))
    empty = F.col("c.source_children").isNull() | (F.size("c.source_children") == 0)
    low = c.select("tier", "topic_ord", "child_ord", F.array("_t", "c.title").alias("path"), F.col("c.condensation_strategy").alias("strategy"), F.col("c.content").alias("content"), F.when(empty, F.array("c.title")).otherwise(F.col("c.source_children")).alias("keys"))
    return top.unionByName(low)


def leaf_chunks(leaves: DataFrame, chunks: DataFrame) -> DataFrame:
    """(tier, topic_ord, child_ord, chunk_index, content, token_count, has_code) by strategy.

    leaves: of plan_leaves; chunks: title (last of the topic path), chunk_ord,
    content, token_count, has_code. A leaf with content of its own is one chunk;
    'keep' copies its sources' chunks and numbers them anew; 'merge' and
    'synthesize' join them into one; other strategies give nothing.
    """
    k = ["tier", "topic_ord", "child_ord"]
    own = leaves.where(F.coalesce("content", F.lit("")) != "").select(*k, F.lit(0).alias("chunk_index"), "content", word_count(F.col("content")).alias("token_count"), F.contains(F.col("content"), F.lit("```")).alias("has_code"))
    rest = leaves.where(F.coalesce("content", F.lit("")) == "").select(*k, "strategy", F.posexplode("keys").alias("key_pos", "title"))
    got = rest.join(chunks, "title").select(*k, "strategy", F.struct("key_pos", "chunk_ord", "content", "token_count", "has_code").alias("c"))
    g = got.groupBy(*k, "strategy").agg(F.array_sort(F.collect_list("c")).alias("l"))
    kept = g.where("strategy = 'keep'").select(*k, F.posexplode("l").alias("chunk_index", "c")).select(*k, "chunk_index", "c.content", F.col("c.token_count").cast("long").alias("token_count"), F.coalesce("c.has_code", F.lit(False)).alias("has_code"))
    joined = F.array_join("l.content", "\n\n")
    merged = g.where("strategy in ('merge', 'synthesize')").select(*k, F.lit(0).alias("chunk_index"), joined.alias("content"), word_count(joined).alias("token_count"), F.exists("l", lambda c: F.coalesce(c["has_code"], F.lit(False))).alias("has_code"))
    return own.unionByName(kept).unionByName(merged)


def leaf_sizes(leaves: DataFrame, chunks: DataFrame) -> DataFrame:
    """(tier, token_count, n): how many of the chunks of ``leaf_chunks`` a tier has of each size, without making them.

    chunks: title, token_count, words (of the content). Chunks are counted by
    title and size and a tier's leaves by title before the two meet, so a title
    that many leaves and chunks share costs no row for each pair.
    """
    k = ["tier", "topic_ord", "child_ord"]
    own = leaves.where(F.coalesce("content", F.lit("")) != "").select("tier", word_count(F.col("content")).alias("token_count"), F.lit(1).cast("long").alias("n"))
    rest = leaves.where(F.coalesce("content", F.lit("")) == "").select(*k, "strategy", F.explode("keys").alias("title"))
    alike = chunks.groupBy("title", F.col("token_count").cast("long").alias("token_count")).agg(F.count("*").alias("_n"))
    kept = rest.where("strategy = 'keep'").groupBy("tier", "title").agg(F.count("*").alias("_m")).join(alike, "title").select("tier", "token_count", (F.col("_n") * F.col("_m")).alias("n"))
    merging = rest.where("strategy in ('merge', 'synthesize')")
    words = chunks.join(merging.select("title").distinct(), "title", "left_semi").groupBy("title").agg(F.sum(F.coalesce("words", F.lit(0)).cast("long")).alias("_w"))
    merged = merging.join(words, "title").groupBy(*k).agg(F.sum("_w").alias("token_count")).select("tier", "token_count", F.lit(1).cast("long").alias("n"))
    return own.unionByName(kept).unionByName(merged).groupBy("tier", "token_count").agg(F.sum("n").alias("n"))


def kept_exercises(exercises: Column, tier: Column) -> Column:
    """The first exercises a tier keeps."""
    n = F.lit(3)
    for t, k in EXERCISES_KEPT.items():
        n = F.when(tier == t, k).otherwise(n)
    return F.slice(exercises, F.lit(1), n)


def review(chunks: DataFrame, topics: DataFrame, scope: str, title: str) -> DataFrame:
    """(scope, topics, chunks, avg_tokens, least, most, empty_topics, orphan_chunks).

    chunks: scope, topic, token_count; topics: scope, title. Chunks of a topic
    that doesn't exist are orphans, topics without chunks empty.
    """
    t = topics.select(scope, F.col(title).alias("topic")).distinct()
    per = chunks.groupBy(scope, "topic").agg(F.count("*").alias("n"), F.sum(F.coalesce(F.col("token_count"), F.lit(0)).cast("long")).alias("tokens"))
    x = t.withColumn("_t", F.lit(True)).join(per, [scope, "topic"], "full")
    known = F.col("_t").isNotNull()
    return x.groupBy(scope).agg(
        F.count_if(known).alias("topics"), F.coalesce(F.sum("n"), F.lit(0)).alias("chunks"), F.coalesce(F.floor(F.sum("tokens") / F.sum("n")), F.lit(0)).alias("avg_tokens"),
        F.coalesce(F.min(F.when(known, F.col("n"))), F.lit(0)).alias("least"), F.coalesce(F.max(F.when(known, F.col("n"))), F.lit(0)).alias("most"),
        F.count_if(known & F.col("n").isNull()).alias("empty_topics"), F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("orphan_chunks"),
    )


def verb_fits(text: Column, level: Column) -> Column:
    """True if an objective's first word is a verb of its level."""
    verb = F.lower(F.substring_index(F.trim(text), " ", 1))
    out = F.lit(False)
    for lv, verbs in LEVEL_VERBS.items():
        out = F.when(level == lv, verb.isin(verbs)).otherwise(out)
    return out


def coverage(sources: Column) -> Column:
    """How well a concept is covered by a number of sources."""
    return F.when(sources >= 3, "strong").when(sources == 2, "moderate").when(sources == 1, "thin").otherwise("gap")


def lesson_action(words: Column, next_words: Column) -> Column:
    """Split over 2000 words, merge if this and the next have under 300, else keep."""
    return F.when(words > 2000, "split").when((words < 300) & (next_words < 300), "merge").otherwise("keep")


def normalized_sections(sections: DataFrame, remap: DataFrame, file: str, title: str) -> DataFrame:
    """``sections`` with new_title and action: 'dropped' for front and back matter, 'renamed' where the title changes, else 'kept'.

    remap: file, old, new; a given title of a file takes precedence over taking a
    prefix off, a null file holds for all of them. Titles are stripped; null
    counts as empty, which is kept. What ``file`` says of a title that it also
    has for all files wins.
    """
    old = stripped(F.coalesce(F.col(title), F.lit("")))
    own = remap.where("file is not null").groupBy(F.col("file").alias(file), F.col("old").alias("_old")).agg(F.max("new").alias("_own"))
    every = remap.where("file is null").groupBy(F.col("old").alias("_old")).agg(F.max("new").alias("_every"))
    x = sections.withColumn("_old", old).join(own, [file, "_old"], "left").join(every, "_old", "left")
    new = F.when(F.col("_old") == "", "").otherwise(F.coalesce("_own", "_every", strip_prefix(F.col("_old"))))
    x = x.withColumn("new_title", new)
    action = F.when(is_book_meta(F.col("_old")), "dropped").when(F.col("new_title") != F.col("_old"), "renamed").otherwise("kept")
    return x.withColumn("action", action).drop("_old", "_own", "_every")


def tier_structure(plan: DataFrame, originals: DataFrame) -> DataFrame:
    """(tier, topic_ord, child_ord, title, depth, sort_order, description, suggested_level, source_sections, objectives, prerequisites) of a plan's topics.

    plan: as of ``plan_leaves``, with suggested_level, objectives, prerequisites
    and, in children, objectives; originals: title, objectives. Objectives are the
    plan's own, else those of the original of that title, case aside; topics keep
    the prerequisites that are topics of the tier; a child names its sources, or
    else itself. A null level is 1.
    """
    first = originals.where(F.size("objectives") > 0).groupBy(F.lower("title").alias("_t")).agg(F.max("objectives").alias("_o"))
    own = plan.select("tier", "topic_ord", F.lit(-1).alias("child_ord"), "title", F.lit(0).alias("depth"), F.col("topic_ord").alias("sort_order"), F.coalesce("description", F.lit("")).alias("description"), F.coalesce("suggested_level", F.lit(1)).alias("suggested_level"), F.lit(None).cast("array<string>").alias("source_sections"), F.col("objectives"), "prerequisites")
    c = plan.select("tier", "topic_ord", F.posexplode("children").alias("child_ord", "c"))
    below = c.select("tier", "topic_ord", "child_ord", F.col("c.title").alias("title"), F.lit(1).alias("depth"), F.col("child_ord").alias("sort_order"), F.coalesce("c.description", F.lit("")).alias("description"), F.lit(None).cast("int").alias("suggested_level"), F.coalesce("c.source_children", F.array("c.title")).alias("source_sections"), F.col("c.objectives").alias("objectives"), F.lit(None).cast(plan.schema["prerequisites"].dataType).alias("prerequisites"))
    x = own.unionByName(below)
    kept = x.groupBy("tier").agg(F.collect_set(F.lower("title")).alias("_kept"))  # a tier has but some hundred titles
    x = x.withColumn("_t", F.lower("title")).join(first, "_t", "left").join(kept, "tier")
    own_first = F.when(F.size("objectives") > 0, F.col("objectives")).otherwise(F.col("_o"))
    return x.withColumn("objectives", own_first).withColumn("prerequisites", F.filter("prerequisites", lambda p: F.array_contains(F.col("_kept"), F.lower(p["topic"])))).drop("_t", "_o", "_kept")


def gathered_exercises(leaves: DataFrame, exercises: DataFrame) -> DataFrame:
    """(tier, topic_ord, child_ord, exercises): those of a leaf's plan, else of its sources in order, as many as the tier keeps; leaves without any are left out, and tiers that keep none.

    leaves: of ``plan_leaves``, with ``own`` (array or null); exercises: title, ord, exercises.
    """
    k = ["tier", "topic_ord", "child_ord"]
    e = leaves.select(*k, "own", F.posexplode("keys").alias("key_pos", "title")).join(exercises, "title", "left")
    g = e.groupBy(*k).agg(F.first("own").alias("own"), F.array_sort(F.collect_list(F.when(F.col("exercises").isNotNull(), F.struct("key_pos", "ord", "exercises"))), lambda a, b: F.when(a["key_pos"] != b["key_pos"], a["key_pos"] - b["key_pos"]).otherwise(F.when(a["ord"] < b["ord"], -1).when(a["ord"] > b["ord"], 1).otherwise(0))).alias("l"))
    out = g.select(*k, kept_exercises(F.coalesce("own", F.flatten("l.exercises")), F.col("tier")).alias("exercises"), F.col("own").isNotNull().alias("_own"))
    return out.where("tier <> 'core' and (_own or size(exercises) > 0)").drop("_own")


def filled_manifest(manifests: DataFrame) -> DataFrame:
    """Manifests whose empty family is the domain's slug and whose empty variant is 'extensive'."""
    blank = lambda c: F.nullif(F.col(c), F.lit(""))
    return manifests.withColumn("domain_family", F.coalesce(blank("domain_family"), slug(F.col("domain")))).withColumn("variant", F.coalesce(blank("variant"), F.lit("extensive")))


def _alike(chunks: DataFrame) -> Column:
    """How many chunks a row of ``leaf_chunks`` or of ``leaf_sizes`` stands for."""
    return F.col("n") if "n" in chunks.columns else F.lit(1).cast("long")


def tier_summary(structure: DataFrame, chunks: DataFrame, original: DataFrame) -> DataFrame:
    """(tier, topics, chunks, tokens, ratio): a row a tier; original: tokens, one row; chunks: of ``leaf_chunks``, or ``leaf_sizes``. The ratio is of the original's tokens to the tier's, at least 1, in tenths."""
    n = _alike(chunks)
    t = structure.groupBy("tier").agg(F.count("*").alias("topics"))
    c = chunks.groupBy("tier").agg(F.sum(n).alias("chunks"), F.sum(F.col("token_count") * n).alias("tokens"))
    x = t.join(c, "tier", "left").fillna(0, ["chunks", "tokens"]).join(F.broadcast(original.agg(F.sum("tokens").alias("_all"))))  # one row
    return x.select("tier", "topics", "chunks", "tokens", compression(F.col("_all"), F.col("tokens")).alias("ratio"))


# The share of the original's tokens a tier aims at.
TIER_SHARES = {"detailed": 0.1, "classic": 0.01, "core": 0.001}


def tier_checks(summary: DataFrame, chunks: DataFrame, original: DataFrame) -> DataFrame:
    """(tier, share, aim, within, odd_chunks): the share of the tokens that is left, whether it is at most twice the aim, and chunks under 200 or over 2000 tokens."""
    aim = F.coalesce(*[F.when(F.col("tier") == t, v) for t, v in TIER_SHARES.items()], F.lit(1.0))
    odd = chunks.groupBy("tier").agg(F.sum(F.when(~F.col("token_count").between(200, 2000), _alike(chunks)).otherwise(0)).alias("odd_chunks"))
    x = summary.join(odd, "tier", "left").fillna(0, ["odd_chunks"]).join(F.broadcast(original.agg(F.sum("tokens").alias("_all"))))  # one row
    share = F.col("tokens") / F.greatest(F.col("_all"), F.lit(1))
    return x.select("tier", share.alias("share"), aim.alias("aim"), (share <= aim * 2).alias("within"), "odd_chunks")


def prerequisite_order(topics: DataFrame, scope: str, title: str, order: str, prerequisites: str) -> DataFrame:
    """(scope, prerequisites, earlier, unknown): how many prerequisites there are, stand before the topic that needs them, and are no topic of the scope. Titles are compared case aside; of equal ones the first counts."""
    w = topics.select(scope, F.col(order).alias("_o"), F.explode(prerequisites).alias("p")).select(scope, "_o", F.lower("p.topic").alias("_t"))
    t = topics.where(F.col(title).isNotNull()).groupBy(scope, F.lower(title).alias("_t")).agg(F.min(order).alias("_at"))
    x = w.join(t, [scope, "_t"], "left")
    return x.groupBy(scope).agg(F.count("*").alias("prerequisites"), F.count_if(F.col("_at") < F.col("_o")).alias("earlier"), F.count_if(F.col("_at").isNull()).alias("unknown"))


def structure_gates(flat: DataFrame) -> DataFrame:
    """(curriculum_id, topics, odd_children, wide, deep, roots_ok) of trees as of ``nested.flatten``: topics with other than 2 to 8 children, over 10 sections, below the third level; whether there are 5 to 15 roots."""
    t = flat.where("kind = 'topic'").select("key", "grp", "path", "parent_path", F.size("titles").alias("level"))
    kids = t.where("parent_path is not null").groupBy("key", F.col("parent_path").alias("path")).agg(F.count("*").alias("kids"))
    refs = flat.where("kind = 'section'").groupBy("key", "path").agg(F.count("*").alias("refs"))
    x = t.join(kids, ["key", "path"], "left").join(refs, ["key", "path"], "left")
    return x.groupBy(F.col("grp").alias("curriculum_id")).agg(
        F.count("*").alias("topics"), F.count_if(~F.col("kids").between(2, 8)).alias("odd_children"), F.count_if(F.col("refs") > 10).alias("wide"), F.count_if(F.col("level") > 3).alias("deep"),
        F.count_if(F.col("path") == "0").between(5, 15).alias("roots_ok"),
    )


def exercise_gates(exercises: DataFrame) -> DataFrame:
    """(exercises, odd_hints, odd_mistakes, odd_difficulty) of exercises(hints, common_mistakes, difficulty, level): other than 3 hints, than 2 to 4 mistakes, than the level."""
    return exercises.agg(F.count("*").alias("exercises"), F.count_if(F.size("hints") != 3).alias("odd_hints"), F.count_if(~F.size("common_mistakes").between(2, 4)).alias("odd_mistakes"), F.count_if(F.col("difficulty") != F.col("level")).alias("odd_difficulty"))
