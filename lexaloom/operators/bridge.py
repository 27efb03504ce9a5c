"""From topics and sections to chunks: by the sections topics name, or by ranges of pages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexaloom.functions.text import is_code, normalized, stripped, word_count
from lexaloom.operators import chunking
from lexaloom.operators.chunking import heading_position, pack
from lexaloom.session import cut


def leaves_of(nodes: DataFrame, tree: str, place: str) -> DataFrame:
    """Those of ``nodes`` that no other node of their tree stands below: ``place`` is an array of positions from the top."""
    p = F.col(place)
    inner = nodes.where(F.size(p) > 1).select(tree, F.slice(p, F.lit(1), F.size(p) - 1).alias(place)).distinct()
    return nodes.join(inner, [tree, place], "left_anti")


def _by_title(sections: DataFrame, scope: list[str], title: str, value: Column) -> DataFrame:
    """(scope, key, v): of equal titles, and of those in lower case, the greatest ``value``."""
    t = normalized(F.col(title))
    x = sections.where(F.coalesce(F.col(title), F.lit("")) != "").select(*scope, t.alias("_t"), value.alias("v"))
    x = x.select(*scope, F.explode(F.array_distinct(F.array(F.col("_t"), F.lower("_t")))).alias("key"), "v")
    return x.groupBy(*scope, "key").agg(F.max("v").alias("v"))


def _both(refs: DataFrame, index: DataFrame, scope: list[str], as_: str) -> DataFrame:
    """``refs`` with what the index has for its name as it stands (``as_`` + 1) and in lower case (``as_`` + 2)."""
    for i, key in ((1, F.col("_k")), (2, F.lower("_k"))):
        one = index.select(*scope, F.col("key").alias("_j"), F.col("v").alias(f"{as_}{i}"))
        refs = refs.withColumn("_j", key).join(one, [*scope, "_j"], "left").drop("_j")
    return refs


def gather(leaves: DataFrame, refs: DataFrame, sections: DataFrame, tree: str, place: str, scope: list[str], order: list[str]) -> DataFrame:
    """Leaf topics with the contents of the sections they name: ``leaves`` with text, source, images.

    leaves: tree, place, scope, title, ...; refs: tree, place, ref_ord, name;
    sections: scope, title, content, source, images and the columns ``order``,
    which tell of sections of one title the last. A name is looked up as it
    stands, then in lower case, where the content is empty or there is none; a
    topic that finds none is looked up by its own title; one without any text is
    left out. Texts are parted by blank lines, in the order of the names; source
    is the first that isn't empty, images are those of all sections. Null names
    find nothing. Titles are resolved to sections first, by their keys alone;
    then every section's text is fetched once.
    """
    k, within = [tree, place], [c for c in scope if c not in (tree, place)]
    text = F.coalesce(F.col("content"), F.lit(""))
    uid = F.struct(*order, F.xxhash64(text).alias("h"))
    source = F.coalesce(F.col("source"), F.lit(""))
    contents = _by_title(sections, scope, "title", F.struct(uid.alias("uid"), (text != "").alias("filled"), source.alias("source")))
    pictures = _by_title(sections.where(F.size("images") > 0), scope, "title", F.struct(*order, F.col("images")))
    own = leaves.select(*k, *within, F.lit(1).alias("_own"), F.lit(0).alias("ref_ord"), F.col("title").alias("_n"))
    named = refs.join(leaves.select(*k, *within), k).select(*k, *within, F.lit(0).alias("_own"), "ref_ord", F.col("name").alias("_n"))
    x = _both(_both(named.unionByName(own).withColumn("_k", normalized(F.col("_n"))), contents, scope, "_c"), pictures, scope, "_i")
    hit = F.coalesce(F.when(F.col("_c1.filled"), F.col("_c1.uid")), F.when(F.col("_c2.filled"), F.col("_c2.uid")))
    x = x.select(*k, "_own", "ref_ord", hit.alias("_uid"), F.coalesce(F.nullif(F.col("_c1.source"), F.lit("")), F.col("_c2.source"), F.lit("")).alias("_src"), F.coalesce("_i1.images", "_i2.images").alias("_img")).where("_uid is not null")
    x = cut(x.withColumn("_least", F.min("_own").over(Window.partitionBy(*k))).where("_own = _least"))  # the own title only where no name finds a text
    texts = sections.select(uid.alias("_uid"), text.alias("_text")).where("_text <> ''").join(x.select("_uid").distinct(), "_uid").dropDuplicates(["_uid"])
    one = F.struct("ref_ord", "_src", F.col("_text"), F.coalesce("_img", F.array().cast(sections.schema["images"].dataType)).alias("_img"))
    g = x.join(texts, "_uid").groupBy(*k).agg(F.array_sort(F.collect_list(one), lambda a, b: a["ref_ord"] - b["ref_ord"]).alias("l"))
    g = g.select(
        *k, F.array_join("l._text", "\n\n").alias("text"), F.coalesce(F.get(F.filter("l._src", lambda s: s != ""), F.lit(0)), F.lit("")).alias("source"),
        F.flatten("l._img").alias("images"),
    )
    return leaves.drop("text", "source", "images").join(g, k)  # what is found wins over columns of these names


def chunk_by_sections(leaves: DataFrame, refs: DataFrame, sections: DataFrame, tree: str, place: str, scope: list[str], order: list[str], most: int = 1500, least: int = 200, count: Callable[[Column], Column] = word_count) -> DataFrame:
    """Chunks of leaf topics by the sections they name: columns of ``leaves``, chunk_index, content, token_count, has_code, page_number (1), source, images.

    Arguments as of ``gather``; leaves have ``split_after``, titles before which a
    chunk always ends. All images go to the first chunk, the others have none.
    """
    x = pack(gather(leaves, refs, sections, tree, place, scope, order), "text", most, least, count, split_before="split_after").drop("split_after")
    return x.withColumn("images", F.when(F.col("chunk_index") == 0, F.col("images"))).withColumn("page_number", F.lit(1))


def section_pages(sections: DataFrame, scope: str, order: list[str], words: int = 384) -> DataFrame:
    """(scope, page, text): the sections of a scope in order, cut into pages of ``words`` words and numbered on; blank ones have none."""
    n = word_count(F.coalesce(F.col("content"), F.lit("")))
    pages = F.ceil(n / words).cast("long")
    sized = sections.select(scope, *order, pages.alias("_n")).where("_n > 0")
    before = lambda *by: Window.partitionBy(scope, *by).rowsBetween(Window.unboundedPreceding, -1)
    # sums over the first column of the order, then within it, so no task holds all of a large scope
    coarse = sized.groupBy(scope, order[0]).agg(F.sum("_n").alias("_m")).select(scope, order[0], F.coalesce(F.sum("_m").over(before().orderBy(order[0])), F.lit(0)).alias("_off"))
    first = sized.select(scope, *order, F.coalesce(F.sum("_n").over(before(order[0]).orderBy(*order[1:] or order)), F.lit(0)).alias("_b")).join(coarse, [scope, order[0]])
    first = first.select(scope, *order, (F.col("_b") + F.col("_off")).alias("_before"))
    key = sections.select(F.struct(scope, *order).alias("_key"), "content")
    paged = chunking.synthetic_pages(key, "_key", "content", words).select("_key.*", "page", "text")
    return paged.join(first, [scope, *order]).select(scope, (F.col("page") + F.col("_before")).cast("long").alias("page"), "text")


def page_tree(topics: DataFrame, tree: str, place: str, tokens: str, per_page: int = 500) -> DataFrame:
    """``topics`` with synthetic pages page_start, page_end.

    Topics take pages in preorder of ``place``: one for every ``per_page`` of
    their tokens, one at least; a topic without tokens takes none and stands on
    the page that is next. A topic goes on to the last page of those below it.
    """
    n = F.when(F.col(tokens) > 0, F.greatest(F.lit(1), F.floor(F.col(tokens) / per_page))).otherwise(0).cast("long")
    w = Window.partitionBy(tree).orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
    x = topics.withColumn("_n", n).withColumn("page_start", (F.coalesce(F.sum("_n").over(w), F.lit(0)) + 1).cast("long"))
    x = x.withColumn("_end", F.greatest(F.col("page_start"), F.col("page_start") + F.col("_n") - 1))
    up = x.select(tree, F.explode(F.transform(F.sequence(F.lit(1), F.size(place)), lambda i: F.slice(place, F.lit(1), i))).alias(place), "_end")
    return x.drop("_n", "_end").join(up.groupBy(tree, place).agg(F.max("_end").alias("page_end")), [tree, place])


def sized_topics(topics: DataFrame, sections: DataFrame, scope: str, order: list[str], count: Callable[[Column], Column] = word_count) -> DataFrame:
    """``topics`` with ``tokens``: those of the section of its title, case as a fallback; 0 where there is none."""
    own = _by_title(sections, [scope], "title", F.struct(*order, count(F.coalesce(F.col("content"), F.lit(""))).alias("n")))
    x = _both(topics.withColumn("_k", normalized(F.col("title"))), own, [scope], "_c")
    return x.withColumn("tokens", F.coalesce(F.nullif(F.col("_c1.n"), F.lit(0)), F.col("_c2.n"), F.lit(0))).drop("_k", "_c1", "_c2")


def chunk_by_topics(topics: DataFrame, pages: DataFrame, tree: str, place: str, most: int = 1500, least: int = 200, count: Callable[[Column], Column] = word_count) -> DataFrame:
    """Chunks of a tree of topics with page ranges: columns of ``topics``, order_key, chunk_index, content, token_count, has_code, page_number.

    topics: tree, place, title, page_start, page_end, ...; pages: tree, page, text.
    A topic with others below it gives only the pages before its first child's.
    Leaves under one parent with one page range share its text, parted at the
    lines that are their titles. ``order_key`` sorts the chunks of a tree: a
    topic's own pages first, then shared groups, then the rest in order. Blank
    texts give no chunk; page_number is the topic's first page.
    """
    topics = topics.drop("text", "part", "order_key", "page_number")  # the result's own win
    p = F.col(place)
    up = F.slice(p, F.lit(1), F.size(p) - 1)
    first = topics.where(F.size(p) > 1).groupBy(tree, up.alias("_up")).agg(F.min_by("page_start", place).alias("_kid"))
    x = topics.join(first.withColumnRenamed("_up", place), [tree, place], "left").withColumn("_up", up)
    inner = x.where("_kid is not null").withColumn("_to", F.col("_kid") - 1).where(F.col("_to") >= F.col("page_start"))
    leaf = x.where("_kid is null").withColumn("_to", F.col("page_end"))
    group = [tree, "_up", "page_start", "_to"]
    w = Window.partitionBy(*group)
    leaf = leaf.withColumn("_same", F.count("*").over(w)).withColumn("_lead", F.min(F.element_at(p, -1)).over(w))
    every = cut(inner.withColumn("_same", F.lit(1).cast("long")).withColumn("_lead", F.element_at(p, -1)).unionByName(leaf))  # ranges, no texts
    ranges = every.select(tree, "page_start", F.col("_to").alias("page_end")).distinct()
    text = chunking.text_of_pages(ranges, pages, tree).where(stripped(F.col("text")) != "").withColumnRenamed("page_end", "_to")
    every = every.join(text, [tree, "page_start", "_to"])
    alone = every.where("_same = 1").withColumn("part", F.col("text"))
    shared = chunking.split_among(every.where("_same > 1"), group, "title", place, "text")
    own = F.struct(F.when(F.col("_same") > 1, 0).otherwise(1).alias("a"), F.coalesce(F.when(F.col("_same") > 1, F.col("_lead")), F.element_at(p, -1)).alias("b"), F.element_at(p, -1).alias("c"))
    above = F.transform("_up", lambda i: F.struct(F.lit(1).alias("a"), i.alias("b"), i.alias("c")))
    out = alone.unionByName(shared).withColumn("order_key", F.concat(above, F.array(own)))
    out = out.select(*topics.columns, "order_key", "part")
    return pack(out, "part", most, least, count).withColumn("page_number", F.col("page_start"))


def part_duplicates(chunks: DataFrame, scope: list[str], title: str, order: str, content: str = "content", count: Callable[[Column], Column] = word_count) -> DataFrame:
    """``chunks`` with equal contents of a scope parted at the lines that are their titles; token_count and has_code are counted anew where the content changes.

    Of equal titles the last counts; a chunk whose title has no line keeps its
    content, but for the only one, which, first in order, has what stands before
    the first line. Chunks left blank are dropped. Only contents that come more
    than once are looked at, and their texts but once a title; a content that very
    many chunks share is no one task's load.
    """
    h = F.xxhash64(content, F.length(content))
    x = chunks.withColumn("_h", h)
    same = [*scope, "_h"]
    often = x.groupBy(*same).agg(F.count("*").alias("_c"), F.min(F.struct(order, title)).alias("_lead"), F.first(content).alias("_t")).where("_c > 1")
    names = x.select(*same, F.col(title).alias("_n"), order).groupBy(*same, "_n").agg(F.count("*").alias("_k"), F.max(order).alias("_o"))
    at = names.join(often, same).select(*same, "_n", "_k", "_o", "_lead", heading_position(F.col("_t"), F.col("_n")).alias("_at"), F.length("_t").alias("_len"))
    lost = at.groupBy(*same).agg(F.coalesce(F.sum(F.when(F.col("_at").isNull(), F.col("_k"))), F.lit(0)).alias("_lost"), F.min("_at").alias("_first")).where("_first is not null")
    # no more titles have a line than the content has lines
    found = at.where("_at is not null").withColumn("_to", F.coalesce(F.lead("_at").over(Window.partitionBy(*same).orderBy("_at", "_o")), F.col("_len")))
    alone = at.where(F.col("_at").isNull() & (F.col("_lead")[title] == F.col("_n"))).join(lost.where("_lost = 1"), same)
    cuts = found.select(*same, F.col("_n").alias(title), F.col("_at").alias("_from"), "_to").unionByName(alone.select(*same, F.col("_n").alias(title), F.lit(0).alias("_from"), F.col("_first").alias("_to")))
    x = x.join(cuts, [*same, title], "left")
    part = stripped(F.substring(F.col(content), F.col("_from") + 1, F.col("_to") - F.col("_from")))
    x = x.withColumn("_new", F.when(F.col("_from").isNotNull() & (part != "") & (part != F.col(content)), part))
    changed = F.col("_new").isNotNull()
    x = x.withColumn("token_count", F.when(changed, count(F.col("_new"))).otherwise(F.col("token_count"))).withColumn("has_code", F.when(changed, is_code(F.col("_new"))).otherwise(F.col("has_code")))
    return x.withColumn(content, F.coalesce("_new", content)).where(stripped(F.col(content)) != "").drop("_h", "_from", "_to", "_new")


def bridge(nodes: DataFrame, refs: DataFrame, sections: DataFrame, tree: str, place: str, order: list[str], most: int = 1500, least: int = 200, count: Callable[[Column], Column] = word_count) -> DataFrame:
    """Chunks of whole curricula: (tree, place, titles, order_key, chunk_index, content, token_count, has_code, page_number, source, images).

    nodes: tree, place, title, titles, split_after; refs: tree, place, ref_ord,
    name; sections: tree, title, content, source, images, ``order``. A tree in
    which a leaf names sections is chunked by these; the others get synthetic
    pages by what their titles find, and are chunked by pages. A name that is
    null or blank counts as none.
    """
    leaves = leaves_of(nodes, tree, place)
    kept = refs.where(stripped(F.coalesce("name", F.lit(""))) != "")
    named = kept.join(leaves.select(tree, place), [tree, place]).select(tree).distinct()
    keep = [tree, place, "titles", "chunk_index", "content", "token_count", "has_code", "page_number"]
    a = chunk_by_sections(leaves.join(named, tree, "left_semi"), kept, sections, tree, place, [tree], order, most, least, count)
    a = a.select(*keep, F.transform(place, lambda i: F.struct(F.lit(1).alias("a"), i.alias("b"), i.alias("c"))).alias("order_key"), "source", "images")
    rest = nodes.join(named, tree, "left_anti")
    sized = sized_topics(rest, sections, tree, order, count)
    pages = section_pages(sections.join(rest.select(tree).distinct(), tree, "left_semi"), tree, order)
    b = chunk_by_topics(page_tree(sized, tree, place, "tokens"), pages, tree, place, most, least, count)
    b = b.select(*keep, "order_key", F.lit("").alias("source"), F.lit(None).cast(sections.schema["images"].dataType).alias("images"))
    return a.unionByName(b)
