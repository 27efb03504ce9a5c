"""Trees and graphs: tables of contents, headings, walks, cycles, bounded crawls."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from lexaloom.functions.text import is_citation, is_front_matter, stripped, title_case
from lexaloom.session import cut, dropped


def toc_tree(toc: DataFrame, doc: str, total_pages: str) -> DataFrame:
    """(doc, ord, title, depth, parent_ord, page_start, page_end) of table-of-contents entries toc(doc, ord, level, page, title, total_pages).

    Citations, titles under three characters and front matter are left out;
    levels are shifted to begin at 1; an entry's parent is the nearest one before
    with a lesser level; it ends on the page before the next entry of its level
    or a lesser one, at its own page at least. One fold over a document's entries
    finds the parents and one from behind the ends, each carrying but the last
    entry of every level, so a table of contents must fit a row.
    """
    t = stripped(F.col("title"))
    x = toc.where(t.isNotNull() & ~is_citation(t) & (F.length(t) >= 3) & ~is_front_matter(t))
    g = x.groupBy(doc).agg(F.max(total_pages).alias("_total"), F.min("level").alias("_least"), F.array_sort(F.collect_list(F.struct("ord", "level", "page", t.alias("title")))).alias("_e"))
    levels = "array<struct<level:int,v:int>>"

    def fold(entries: Column, value: str, strict: bool) -> Column:
        """For each entry ``value`` of the nearest one before whose level is less (or no greater)."""

        def step(s: Column, e: Column) -> Column:
            lower = F.filter(s["open"], lambda o: (o["level"] < e["level"]) if strict else (o["level"] <= e["level"]))
            kept = F.filter(s["open"], lambda o: o["level"] < e["level"])
            own = F.array(F.struct(e["level"].cast("int").alias("level"), e[value].cast("int").alias("v"))).cast(levels)
            return F.struct(F.concat(kept, own).alias("open"), F.concat(s["out"], F.array(F.get(lower, F.size(lower) - 1)["v"])).alias("out"))

        start = F.struct(F.array().cast(levels).alias("open"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(entries, start, step, lambda s: s["out"])

    g = g.select(doc, "_total", "_least", "_e", fold(F.col("_e"), "ord", True).alias("_p"), F.reverse(fold(F.reverse("_e"), "page", False)).alias("_q"))
    x = g.select(doc, "_total", "_least", F.posexplode(F.arrays_zip("_e", "_p", "_q")).alias("_i", "z"))
    end = F.coalesce(F.col("z._q") - 1, F.col("_total"))
    return x.select(
        doc, F.col("z._e.ord").alias("ord"), F.col("z._e.title").alias("title"), F.col("_i").alias("sort_order"), (F.col("z._e.level") - F.col("_least")).alias("depth"),
        F.col("z._p").alias("parent_ord"), F.col("z._e.page").alias("page_start"), F.greatest(end, F.col("z._e.page")).alias("page_end"),
    )


def merged_fragments(lines: Column) -> Column:
    """Lines with one of one to three capital letters glued to the next if that begins with a capital; each line is used once."""
    start = F.struct(F.array().cast("array<string>").alias("out"), F.lit(None).cast("string").alias("held"))

    def step(s: Column, line: Column) -> Column:
        t = stripped(line)
        glued = s["held"].isNotNull() & t.rlike(r"^\p{Lu}")
        out = F.when(glued, F.concat(s["out"], F.array(F.concat(s["held"], t)))).otherwise(F.when(s["held"].isNotNull(), F.concat(s["out"], F.array(s["held"]))).otherwise(s["out"]))
        hold = ~glued & t.rlike(r"^\p{Lu}{1,3}$")
        return F.struct(F.when(glued | hold, out).otherwise(F.concat(out, F.array(line))).alias("out"), F.when(hold, t).alias("held"))

    return F.aggregate(lines, start, step, lambda s: F.when(s["held"].isNotNull(), F.concat(s["out"], F.array(s["held"]))).otherwise(s["out"]))


def headings(pages: DataFrame, key: list[str], text: str) -> DataFrame:
    """(key, line_ord, level, title) of lines that look like headings: chapters and parts, numbered sections, lines in capitals.

    The first rule that matches a line decides on it, also if it rejects it.
    """
    x = pages.select(*key, F.posexplode(merged_fragments(F.split(F.col(text), "\n"))).alias("line_ord", "line")).withColumn("line", stripped(F.col("line")))
    x = x.where(F.length("line").between(3, 200) & ~is_citation(F.col("line")))
    chapter, numbered = r"(?i)^(?:chapter|part)\s+(\d+|[ivxlc]+)[:.\s]*(.*)", r"^(\d+(?:\.\d+)*)[:.]\s+(.+)"
    line = F.col("line")
    rest = stripped(F.regexp_extract(line, chapter, 2))
    number, name = F.regexp_extract(line, numbered, 1), stripped(F.regexp_extract(line, numbered, 2))
    depth = F.length(number) - F.length(F.replace(number, F.lit("."), F.lit(""))) + 1
    note = (F.length(name) > 80) | name.rlike(r"^\p{Ll}") | name.rlike("[.,;]$")
    words = F.size(F.filter(F.split(line, r"\s+"), lambda w: w != ""))
    capitals = (F.upper(line) == line) & line.rlike(r"\p{Lu}") & words.between(2, 8) & (F.length(line) > 8) & ~line.rlike(r"^(HTTP|URL|API|SQL|HTML|\[)")
    rule = F.when(line.rlike(chapter), 1).when(line.rlike(numbered), 2).when(capitals, 3)
    level = F.when(rule == 2, depth).otherwise(1)
    title = F.when(rule == 1, F.when(rest != "", rest).otherwise(line)).when(rule == 2, F.concat_ws(" ", number, name)).otherwise(title_case(line))
    kept = rule.isNotNull() & ((rule != 2) | ((depth <= 3) & ~note))
    return x.where(kept).select(*key, "line_ord", level.cast("int").alias("level"), title.alias("title"))


def topic_tree(toc: DataFrame, found: DataFrame, docs: DataFrame, doc: str) -> DataFrame:
    """Tree of each document: from its table of contents if that has 3 entries, else from headings found if it has over 20 pages, else one node.

    docs: doc, title, total_pages. A table of contents whose entries are all left
    out gives no node.
    """
    n = toc.groupBy(doc).agg(F.count("*").alias("_n"))
    h = found.groupBy(doc).agg(F.count("*").alias("_h"))
    pick = docs.join(n, doc, "left").join(h, doc, "left").withColumn("_way", F.when(F.col("_n") >= 3, "toc").when((F.col("total_pages") > 20) & (F.col("_h") > 0), "found").otherwise("one"))
    a = toc.join(pick.where("_way = 'toc'").select(doc, "total_pages"), doc)
    b = found.join(pick.where("_way = 'found'").select(doc, "total_pages"), doc)
    tree = toc_tree(a.unionByName(b), doc, "total_pages")
    one = pick.where("_way = 'one'").select(doc, F.lit(0).alias("ord"), "title", F.lit(0).alias("sort_order"), F.lit(0).alias("depth"), F.lit(None).cast("int").alias("parent_ord"), F.lit(1).alias("page_start"), F.col("total_pages").alias("page_end"))
    return tree.unionByName(one)


def preorder(nodes: DataFrame, node: str, parent: str, order: str, label: str) -> DataFrame:
    """(node, path, place, depth, leaf): each node with the labels from its root, and the order of each on the way.

    Ways double in length with every round, so a tree of depth n takes log n
    joins. Nodes on a cycle are never reached and left out; a node given with two
    parents comes once for each way, but never again below itself.
    """
    one = lambda c: F.array(F.col(c))
    rows = nodes.select(F.col(node).alias("n"), F.col(parent).alias("up"), one(node).alias("way"), one(label).alias("path"), one(order).alias("place"))
    done, open_ = rows.where("up is null"), rows.where("up is not null")
    every = rows
    while not open_.isEmpty():
        above = every.select(F.col("n").alias("_n"), F.col("up").alias("_up"), *[F.col(c).alias(f"_{c}") for c in ("way", "path", "place")])
        step = open_.join(above, F.col("up") == F.col("_n")).where(~F.arrays_overlap("way", "_way"))
        step = cut(step.select("n", F.col("_up").alias("up"), *[F.concat(f"_{c}", c).alias(c) for c in ("way", "path", "place")]))
        done, open_ = done.unionByName(step.where("up is null")), step.where("up is not null")
        every = done.unionByName(open_)
    inner = nodes.where(F.col(parent).isNotNull()).select(F.col(parent).alias("n")).distinct().withColumn("_inner", F.lit(True))
    return done.join(inner, "n", "left").select(F.col("n").alias(node), "path", "place", (F.size("path") - 1).alias("depth"), F.col("_inner").isNull().alias("leaf"))


def _coded(tables: list[pa.RecordBatch], schema: pa.Schema) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The nodes of edges (a, b), and the edges' ends as places among them."""
    t = pa.Table.from_batches(tables, schema)
    nodes = pa.concat_arrays([*t.column("b").chunks, *t.column("a").chunks]).dictionary_encode()
    codes = nodes.indices.to_numpy()
    return nodes.dictionary, codes[t.num_rows :], codes[: t.num_rows]


def _shortened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges (a, b, one) as (kind, a, b), all edges into a node being in one part: chains within a part drawn together.

    one: a is all that points at b. Kind 0: an edge that stays; 1: b shares the
    fate of a, whose edge stays; 2: b, with no a, is on a cycle or behind one.
    """
    single, schema = [], None

    def out(kind: int, a: pa.Array, b: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(b), kind, "int32")), a, b], ["kind", "a", "b"])

    for batch in batches:
        one, schema = batch.column("one"), batch.schema
        single.append(batch.filter(one))
        rest = batch.filter(pc.invert(one))
        yield out(0, rest.column("a"), rest.column("b"))
    if not sum(x.num_rows for x in single):
        return
    nodes, a, b = _coded(single, schema)
    up, own = np.arange(len(nodes)), np.zeros(len(nodes), bool)
    up[b], own[b] = a, True
    top = own & ~own[up]
    end = np.where(own & own[up], up, np.arange(len(nodes)))
    for _ in range(len(nodes).bit_length()):
        end = end[end]
    ends = own & top[end]
    for kind, which, of in ((0, top, up), (1, ends & ~top, end)):
        at = np.flatnonzero(which)
        yield out(kind, nodes.take(pa.array(of[at])), nodes.take(pa.array(at)))
    at = nodes.take(pa.array(np.flatnonzero(own & ~ends)))
    yield out(2, pa.nulls(len(at), at.type), at)


def _peeled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node) of the nodes left of edges (a, b), all in one part, when those nothing points at are taken away again and again."""
    edges = list(batches)
    if not edges:
        return
    nodes, a, b = _coded(edges, edges[0].schema)
    first = np.searchsorted(np.sort(a), np.arange(len(nodes) + 1)).tolist()
    into, n = b[np.argsort(a, kind="stable")].tolist(), np.bincount(b, minlength=len(nodes)).tolist()
    free = [i for i, x in enumerate(n) if not x]
    while free:
        i = free.pop()
        for j in into[first[i] : first[i + 1]]:
            n[j] -= 1
            if not n[j]:
                free.append(j)
    yield pa.RecordBatch.from_arrays([nodes.take(pa.array(np.flatnonzero(n)))], ["node"])


def cyclic_nodes(edges: DataFrame, source: str, target: str, most: int = 1_000_000) -> DataFrame:
    """(node) of the nodes on a cycle or behind one. Empty means acyclic; equal edges count once, loops are cycles; edges with a null end are left out.

    Nodes nothing points at are taken away again and again, in one task as soon
    as there are at most ``most`` edges. Before that, nodes that only one other
    points at share that one's fate and are drawn into it: chains within a range
    of nodes at once, and where ranges hold few of them, those of a fourth of the
    nodes, picked by hash anew in every round. So the edges shrink from round to
    round, and each round's pointers are kept once, to be followed back at the end.
    """
    kind = edges.select(source).union(edges.select(target)).schema[0].dataType
    e = cut(edges.where(F.col(source).isNotNull() & F.col(target).isNotNull()).select(F.col(source).cast(kind).alias("a"), F.col(target).cast(kind).alias("b")))
    n, by_hash, rounds, merge = e.count(), False, [], lambda x: x.hint("merge")  # tables that compress well look small enough to be broadcast
    shape = StructType([StructField("kind", IntegerType()), e.schema["a"], e.schema["b"]])
    while n > most:
        parts = -(-n // max(1, most // 2))
        w = Window.partitionBy("b")
        x = e.repartitionByRange(parts, "b").select("a", "b", ((F.min("a").over(w) == F.max("a").over(w)) & (F.col("a") != F.col("b"))).alias("one"))
        if by_hash:
            coin = lambda c: F.xxhash64(F.lit(len(rounds)), c) % 2 == 0  # noqa: B023, E731
            got = cut(x.select(F.when(F.col("one") & coin("b") & ~coin("a"), 1).otherwise(0).alias("kind"), "a", "b"))
        else:
            got = cut(x.mapInArrow(_shortened, shape))
        moved = got.where("kind > 0").select(F.col("b").alias("_b"), F.col("a").alias("_a"), (F.col("kind") == 2).alias("_bad"))
        rest = merge(got.where("kind = 0").select("a", "b")).join(merge(moved), F.col("a") == F.col("_b"), "left")
        rest = cut(rest.select(F.when(F.col("_bad"), F.col("b")).otherwise(F.coalesce("_a", "a")).alias("a"), "b").distinct())
        dropped(e)
        e = cut(merge(rest).join(merge(rest.select(F.col("b").alias("_b")).distinct()), F.col("a") == F.col("_b"), "left_semi"))
        rounds.append(got)
        dropped(rest)
        left = e.count()
        if left == n:
            break
        by_hash, n = by_hash or left > 0.75 * n, left
    if n > most:
        core = e.select(F.col("a").alias("node")).union(e.select("b")).distinct()
    else:
        core = e.coalesce(1).mapInArrow(_peeled, StructType([StructField("node", kind)]))
    for got in reversed(rounds):
        core = cut(core.union(got.where("kind = 2").select("b")).distinct())
        if not core.isEmpty():
            core = core.union(merge(got.where("kind = 1")).join(merge(core), F.col("a") == F.col("node"), "left_semi").select("b"))
    return core.distinct()


def redundant_edges(edges: DataFrame, source: str, target: str) -> DataFrame:
    """(a, c): edges whose end is also reached another way, by two others or more. Equal edges count once, loops not at all.

    What each node reaches is found by ways that double in length, so the work
    grows with the pairs of nodes that reach one another.
    """
    e = cut(edges.select(F.col(source).alias("a"), F.col(target).alias("c")).where("a <> c").distinct())
    reach, n = e, e.count()
    while True:
        two = reach.select("a", F.col("c").alias("b")).join(reach.select(F.col("a").alias("b"), "c"), "b").where("a <> c").select("a", "c")
        reach = cut(reach.unionByName(two).distinct())
        m = reach.count()
        if m == n:
            break
        n = m
    other = e.select("a", F.col("c").alias("b")).join(reach.select(F.col("a").alias("b"), "c"), "b").where("b <> c and a <> c").select("a", "c").distinct()
    return e.join(other, ["a", "c"], "left_semi")


def enriched_topics(topics: DataFrame, wanted: DataFrame, scope: str, title: str) -> DataFrame:
    """``topics`` (scope, title, has_children, ...) with objectives by their titles, and prerequisites(topic, strength).

    wanted: title, prerequisite, strength. Of these a topic gets those that are
    titles of its scope, exactly; null where it has none.
    """
    from lexaloom.functions.text import objectives

    have = topics.select(scope, F.col(title).alias("prerequisite")).distinct()
    pairs = topics.select(scope, title).distinct().join(wanted.withColumnRenamed("title", title), title).join(have, [scope, "prerequisite"], "left_semi")
    p = pairs.groupBy(scope, title).agg(F.array_sort(F.collect_set(F.struct(F.col("prerequisite").alias("topic"), "strength"))).alias("prerequisites"))
    return topics.drop("prerequisites").join(p, [scope, title], "left").withColumn("objectives", objectives(F.col(title), F.col("has_children")))


def workspace_crawl(pages: DataFrame, children: DataFrame, start: DataFrame, most_pages: int = 100, most_depth: int = 5) -> DataFrame:
    """(id, depth, place) of a workspace's pages reached breadth-first from ``start`` (id) within budgets.

    pages: id, is_database; children: id, ord, child. A database isn't visited
    itself: its pages follow in its place, a level down. Of pages at one depth
    those whose parent came first come first, then in order. Nothing below
    ``most_depth`` is reached, and no more than ``most_pages`` pages. What is
    taken is at most ``most_pages``, so the driver keeps no more.
    """
    spark = pages.sparkSession
    seen = start.select("id").distinct()
    front = seen.select("id", F.array(F.lit(0)).alias("place"))
    out, taken, depth = None, 0, 0
    while depth <= most_depth and taken < most_pages:
        level = front.join(pages, "id")
        visited = level.where(~F.coalesce("is_database", F.lit(False))).orderBy("place").limit(most_pages - taken).select("id", "place")  # the budget is the feature
        rows = [(r.id, depth, taken + i) for i, r in enumerate(visited.collect())]
        taken += len(rows)
        if rows:
            got = spark.createDataFrame(rows, "id string, depth int, place long")
            out = got if out is None else out.unionByName(got)
        ids = visited.select("id").unionByName(level.where(F.coalesce("is_database", F.lit(False))).select("id"))
        nxt = front.join(ids, "id", "left_semi").join(children, "id").groupBy(F.col("child").alias("id")).agg(F.min(F.concat("place", F.array(F.col("ord").cast("int")))).alias("place"))
        front = cut(nxt.join(seen, "id", "left_anti"))
        if front.isEmpty():
            break
        seen, depth = seen.unionByName(front.select("id")), depth + 1
    return out if out is not None else spark.createDataFrame([], "id string, depth int, place long")


def crawl(pages: DataFrame, links: DataFrame, start: DataFrame, most_pages: int = 50, most_depth: int = 1, most_tokens: int = 200_000) -> DataFrame:
    """(url, depth, place, tokens, limited_by) of pages reached breadth-first from ``start`` within budgets.

    pages: url, tokens; links: url, target; start: url. Pages count in order of
    depth, of the page that links to them and of url; a page is taken while fewer
    than ``most_pages`` pages and ``most_tokens`` tokens are taken before it.
    limited_by tells what ended it: 'max_pages', 'max_tokens' or 'exhausted'.
    Pages without text neither count nor lead on. Each level is one join; what is
    taken is at most ``most_pages``, so the order needs no spread.
    """
    have = pages.where("tokens is not null").select("url", "tokens").dropDuplicates(["url"])
    seen = start.select("url").distinct()
    front = seen.select("url", F.lit(0).cast("long").alias("place"))
    out, taken, tokens, why = None, 0, 0, "exhausted"
    for depth in range(1, most_depth + 1):
        nxt = front.join(links, "url").select(F.col("target").alias("url"), "place").groupBy("url").agg(F.min("place").alias("place"))
        nxt = nxt.join(seen, "url", "left_anti").join(have, "url")
        found = nxt.orderBy("place", "url").limit(max(0, most_pages - taken) + 1).collect()  # a bounded report, and whether more is left
        rows = []
        for r in found:
            if taken + len(rows) >= most_pages:
                why = "max_pages"
                break
            if tokens >= most_tokens:
                why = "max_tokens"
                break
            rows.append((r.url, depth, taken + len(rows), r.tokens))
            tokens += r.tokens
        if not rows:
            break
        level = pages.sparkSession.createDataFrame(rows, "url string, depth int, place long, tokens long")
        out = level if out is None else out.unionByName(level)
        taken += len(rows)
        seen = seen.unionByName(nxt.select("url"))
        front = level.select("url", "place")
        if tokens >= most_tokens:
            why = "max_tokens"
        if why != "exhausted":
            break
    out = out if out is not None else pages.sparkSession.createDataFrame([], "url string, depth int, place long, tokens long")
    return out.withColumn("limited_by", F.lit(why))
