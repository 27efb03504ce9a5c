"""Queries of joins, trees, windows, incremental writes and measures, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexaloom.functions import text as T
from lexaloom.operators import condense, lookup, trees, windows
from lexaloom.sources.tables import latest, table

Q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        Q[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _long(*names: str):
    return [F.col(n).cast("long").alias(n) for n in names]


# ---- lookups -----------------------------------------------------------------

_CLEAN = "regexp_replace(regexp_replace(replace({0}, chr(160), ' '), '^\\s+', ''), '\\s+$', '')"
_INDEX = f"""i AS (SELECT curriculum_id, k, content FROM (SELECT curriculum_id, k, content, row_number() OVER (PARTITION BY curriculum_id, k ORDER BY file_ord DESC, section_ord DESC, section_id DESC, content DESC NULLS LAST) AS r
    FROM (SELECT curriculum_id, file_ord, section_ord, section_id, content, t AS k FROM s UNION ALL SELECT curriculum_id, file_ord, section_ord, section_id, content, lower(t) FROM s WHERE lower(t) <> t)) WHERE r = 1)"""
_S = f"s AS (SELECT *, {_CLEAN.format('title')} AS t FROM extracted WHERE trim(title) <> '')"
_ROOTS = "r AS (SELECT structure_id, curriculum_id, title, source_sections FROM (SELECT *, row_number() OVER (PARTITION BY structure_id ORDER BY saved_at DESC NULLS LAST, curriculum_id DESC, title DESC NULLS LAST, source_sections DESC NULLS LAST) AS n FROM structure) WHERE n = 1)"


def _roots(spark, d):
    return latest(table(spark, d, "structure"), "structure_id", "saved_at", ["curriculum_id", "title", "source_sections"])


@query(
    f"""WITH {_S}, {_INDEX}, {_ROOTS},
    q AS (SELECT structure_id, curriculum_id, unnest(range(len(source_sections))) AS pos, unnest(source_sections) AS name FROM r),
    z AS (SELECT q.*, {_CLEAN.format('name')} AS t FROM q WHERE name IS NOT NULL)
    SELECT structure_id, CAST(pos AS BIGINT) AS pos, coalesce(nullif(a.content, ''), b.content) IS NOT NULL AS found, md5(coalesce(nullif(a.content, ''), b.content)) AS content_md5
    FROM z LEFT JOIN i a ON a.curriculum_id = z.curriculum_id AND a.k = z.t LEFT JOIN i b ON b.curriculum_id = z.curriculum_id AND b.k = lower(z.t)"""
)
def section_lookup(spark, d):
    """Contents of the sections root topics name, case as a fallback."""
    refs = _roots(spark, d).select("structure_id", "curriculum_id", F.posexplode("source_sections").alias("pos", "name")).where("name is not null")
    index = lookup.section_index(table(spark, d, "extracted"), ["curriculum_id"], "title", "content", ["file_ord", "section_ord", "section_id"])
    x = lookup.look_up(refs, index, ["curriculum_id"], "name", "content")
    return x.select("structure_id", F.col("pos").cast("long").alias("pos"), F.col("content").isNotNull().alias("found"), F.md5("content").alias("content_md5"))


@query(
    f"""WITH {_ROOTS}, q AS (SELECT structure_id, curriculum_id, unnest(source_sections) AS name FROM r), z AS (SELECT *, lower({_CLEAN.format('name')}) AS k FROM q WHERE name IS NOT NULL),
    h AS (SELECT DISTINCT curriculum_id, lower({_CLEAN.format('title')}) AS k FROM extracted WHERE title IS NOT NULL)
    SELECT structure_id, name FROM z ANTI JOIN h USING (curriculum_id, k)"""
)
def stale_sections(spark, d):
    """Section names in root topics that no section has."""
    refs = _roots(spark, d).select("structure_id", "curriculum_id", F.explode("source_sections").alias("name")).where("name is not null")
    return lookup.stale_references(refs, table(spark, d, "extracted"), ["curriculum_id"], "name", "title").select("structure_id", "name")


@query(
    f"""WITH {_ROOTS}, c AS (SELECT DISTINCT chunk_id, curriculum_id, topic_path FROM (SELECT *, row_number() OVER (PARTITION BY chunk_id ORDER BY chunked_at DESC NULLS LAST, curriculum_id DESC, topic_path DESC NULLS LAST) AS n FROM chunks) WHERE n = 1),
    p AS (SELECT chunk_id, curriculum_id, unnest(range(len(topic_path))) AS i, unnest(topic_path) AS t FROM c),
    a AS (SELECT curriculum_id, title, max(structure_id) AS id FROM r GROUP BY ALL), b AS (SELECT curriculum_id, lower(title) AS l, max(structure_id) AS id FROM r GROUP BY ALL),
    j AS (SELECT chunk_id, i, coalesce(a.id, b.id) AS id FROM p LEFT JOIN a ON a.curriculum_id = p.curriculum_id AND a.title = p.t LEFT JOIN b ON b.curriculum_id = p.curriculum_id AND b.l = lower(p.t))
    SELECT chunk_id, arg_max(id, i) AS structure_id FROM j WHERE id IS NOT NULL GROUP BY 1"""
)
def topic_match(spark, d):
    """The root topic that the most specific title of each chunk's path names."""
    items = latest(table(spark, d, "chunks"), "chunk_id", "chunked_at", ["curriculum_id", "topic_path"])
    return lookup.most_specific(items, "chunk_id", "topic_path", _roots(spark, d), ["curriculum_id"], "title", "structure_id")


@query(
    """WITH t AS (SELECT DISTINCT curriculum_id, lower(title) AS k FROM structure WHERE title IS NOT NULL),
    p AS (SELECT DISTINCT structure_id, curriculum_id, unnest(prerequisites).topic AS topic FROM structure)
    SELECT structure_id, topic FROM p JOIN t ON t.curriculum_id = p.curriculum_id AND t.k = lower(p.topic)"""
)
def prereq_filter(spark, d):
    """Prerequisites that are topics of the same curriculum."""
    s = table(spark, d, "structure")
    kept = s.where("title is not null").groupBy("curriculum_id").agg(F.collect_set(F.lower("title")).alias("kept"))
    x = s.select("structure_id", "curriculum_id", "prerequisites").join(kept, "curriculum_id")
    return x.select("structure_id", F.explode(lookup.kept_prerequisites(F.col("prerequisites"), F.col("kept"))).alias("p")).select("structure_id", F.col("p.topic").alias("topic")).distinct()


@query(
    """WITH b AS (SELECT min(s) AS book_id, regexp_extract(source_path, '([^/]*)$', 1) AS file_name, max(lower(title)) AS title FROM (SELECT min(section_id) AS s, source_path, max(title) AS title FROM extracted WHERE source_path IS NOT NULL GROUP BY source_path) GROUP BY source_path),
    w AS (SELECT DISTINCT p.path AS source_path, p.title AS title FROM (SELECT unnest(sources) AS p FROM manifest)),
    f AS (SELECT file_name, min(book_id) AS a FROM b GROUP BY 1), t AS (SELECT title, min(book_id) AS b FROM b WHERE title IS NOT NULL GROUP BY 1)
    SELECT w.source_path, w.title, coalesce(f.a, t.b) AS book_id FROM w LEFT JOIN f ON f.file_name = regexp_extract(w.source_path, '([^/]*)$', 1) LEFT JOIN t ON t.title = lower(w.title)"""
)
def book_match(spark, d):
    """Books already known, by file name or title, for every source of a manifest."""
    e = table(spark, d, "extracted").where("source_path is not null").groupBy("source_path").agg(F.min("section_id").alias("book_id"), F.max("title").alias("title"))
    books = e.select("book_id", F.regexp_extract("source_path", "([^/]*)$", 1).alias("file_name"), "title")
    wanted = table(spark, d, "manifest").select(F.explode("sources").alias("p")).select(F.col("p.path").alias("source_path"), F.col("p.title").alias("title")).distinct()
    return lookup.match_books(wanted, books)


@query(
    """WITH r AS (SELECT CAST(vec_id AS VARCHAR) AS id, 'image ' || label AS alt_text FROM embeddings),
    a AS (SELECT CAST(vec_id AS VARCHAR) AS id, CASE WHEN label % 3 = 0 THEN '' ELSE 'seen ' || label END AS description, CASE WHEN label % 2 = 0 THEN 'text' ELSE '' END AS ocr_text FROM embeddings WHERE vec_id % 2 = 0)
    SELECT r.id, coalesce(nullif(a.description, ''), r.alt_text) AS alt_text, nullif(a.ocr_text, '') AS ocr_text, CAST(NULL AS VARCHAR) AS educational_value FROM r LEFT JOIN a USING (id)"""
)
def image_analysis_merge(spark, d):
    """An image registry with what an analysis found."""
    e = table(spark, d, "embeddings")
    registry = e.select(F.col("vec_id").cast("string").alias("id"), F.concat(F.lit("image "), F.col("label")).alias("alt_text"))
    found = e.where("vec_id % 2 = 0").select(F.col("vec_id").cast("string").alias("id"), F.when(F.col("label") % 3 == 0, "").otherwise(F.concat(F.lit("seen "), F.col("label"))).alias("description"), F.when(F.col("label") % 2 == 0, "text").otherwise("").alias("ocr_text"), F.lit("").alias("educational_value"))
    return lookup.merge_analysis(registry, found, "id").select("id", "alt_text", "ocr_text", "educational_value")


# ---- incremental writes ------------------------------------------------------


@query(
    """SELECT o_orderkey, o_custkey, 'kept' AS action FROM orders WHERE o_orderkey % 2 = 0
    UNION ALL SELECT o_orderkey, o_custkey, 'inserted' FROM orders WHERE o_orderkey % 3 = 0 AND o_orderkey % 2 <> 0"""
)
def upsert_skip(spark, d):
    """New rows beside existing ones, those with a known key left out."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return lookup.upsert_skip(o.where("o_orderkey % 2 = 0"), o.where("o_orderkey % 3 = 0"), ["o_orderkey"])


@query(
    """WITH n AS (SELECT o_custkey, o_orderkey FROM orders WHERE o_orderkey % 3 = 0)
    SELECT o_custkey, o_orderkey, 'inserted' AS action FROM n
    UNION ALL SELECT o_custkey, o_orderkey, 'kept' FROM orders WHERE o_orderkey % 2 = 0 AND o_custkey NOT IN (SELECT o_custkey FROM n)"""
)
def upsert_replace(spark, d):
    """New rows in place of all existing ones of the groups they touch."""
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey")
    return lookup.upsert_replace(o.where("o_orderkey % 2 = 0"), o.where("o_orderkey % 3 = 0"), ["o_custkey"])


_SLUG = "nullif(regexp_replace(lower(trim({0})), '[\\s_\\-]+', '-', 'g'), '')"


@query(
    f"""WITH m AS (SELECT {_SLUG.format('domain')} AS slug, domain_family, variant, curriculum_id FROM manifest),
    a AS (SELECT slug, max(domain_family) AS domain_family, CAST(NULL AS VARCHAR) AS variant FROM m WHERE curriculum_id % 2 = 0 AND slug IS NOT NULL GROUP BY 1),
    b AS (SELECT slug, max(domain_family) AS domain_family, max(variant) AS variant FROM m WHERE slug IS NOT NULL GROUP BY 1)
    SELECT slug, coalesce(a.domain_family, b.domain_family) AS domain_family, coalesce(a.variant, b.variant) AS variant, a.slug IS NULL AS created FROM b FULL JOIN a USING (slug)"""
)
def domain_upsert(spark, d):
    """Domains by slug, with only the missing values filled in."""
    s = F.regexp_replace(F.lower(F.trim("domain")), r"[\s_\-]+", "-")
    m = table(spark, d, "manifest").select(F.nullif(s, F.lit("")).alias("slug"), "domain_family", "variant", "curriculum_id").where("slug is not null")
    old = m.where("curriculum_id % 2 = 0").groupBy("slug").agg(F.max("domain_family").alias("domain_family")).withColumn("variant", F.lit(None).cast("string"))
    return lookup.get_or_create(old, m, "slug", ["domain_family", "variant"])


@query("SELECT CAST(suggested_level AS BIGINT) AS level FROM structure WHERE suggested_level IS NOT NULL AND curriculum_id % 2 = 1 GROUP BY 1 EXCEPT SELECT suggested_level FROM structure WHERE curriculum_id % 2 = 0 AND suggested_level < 3")
def level_create(spark, d):
    """Levels that topics need and that don't exist yet."""
    s = table(spark, d, "structure").select(F.col("suggested_level").cast("long").alias("level"), "curriculum_id")
    return lookup.pending(s.where("level is not null and curriculum_id % 2 = 1").select("level").distinct(), s.where("curriculum_id % 2 = 0 and level < 3").select("level"), "level")


@query(
    """SELECT structure_id, CAST(i AS BIGINT) AS sort_order, o.text AS text, coalesce(nullif(o.bloom_level, ''), 'understand') AS bloom_level
    FROM (SELECT structure_id, unnest(range(len(learning_objectives))) AS i, unnest(learning_objectives) AS o FROM (SELECT DISTINCT structure_id, learning_objectives FROM structure))"""
)
def objective_rows(spark, d):
    """Objectives of root topics, a row each."""
    s = table(spark, d, "structure").select("structure_id", "learning_objectives").distinct()
    return lookup.objective_rows(s, "structure_id", "learning_objectives").withColumn("sort_order", F.col("sort_order").cast("long"))


# ---- trees and graphs --------------------------------------------------------


@query(
    """WITH t AS (SELECT DISTINCT l_orderkey AS doc, l_linenumber AS ord, l_linenumber % 3 + 1 AS level, 3 * l_linenumber AS page FROM lineitem),
    g AS (SELECT doc, min(level) AS least, max(page) + 5 AS total FROM t GROUP BY 1)
    SELECT t.doc, CAST(t.ord AS BIGINT) AS ord, CAST(t.level - g.least AS BIGINT) AS depth,
      CAST(coalesce((SELECT max(b.ord) FROM t b WHERE b.doc = t.doc AND b.ord < t.ord AND b.level < t.level), -1) AS BIGINT) AS parent_ord, CAST(t.page AS BIGINT) AS page_start,
      CAST(greatest(coalesce((SELECT arg_min(b.page, b.ord) FROM t b WHERE b.doc = t.doc AND b.ord > t.ord AND b.level <= t.level) - 1, g.total), t.page) AS BIGINT) AS page_end
    FROM t JOIN g USING (doc)"""
)
def toc_tree(spark, d):
    """Trees from tables of contents, one for every order."""
    t = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("doc"), F.col("l_linenumber").alias("ord"), (F.col("l_linenumber") % 3 + 1).alias("level"), (F.col("l_linenumber") * 3).alias("page"), F.concat(F.lit("Entry "), F.col("l_linenumber")).alias("title")).distinct()
    total = t.groupBy("doc").agg((F.max("page") + 5).alias("total_pages"))
    x = trees.toc_tree(t.join(total, "doc"), "doc", "total_pages")
    return x.fillna(-1, ["parent_ord"]).select("doc", *_long("ord", "depth", "parent_ord", "page_start", "page_end"))


def _places(spark, d):
    r = table(spark, d, "region").select(F.concat(F.lit("r"), F.col("r_regionkey")).alias("node"), F.lit(None).cast("string").alias("parent"), F.col("r_regionkey").cast("long").alias("ord"), F.col("r_name").alias("label"))
    n = table(spark, d, "nation").select(F.concat(F.lit("n"), F.col("n_nationkey")), F.concat(F.lit("r"), F.col("n_regionkey")), F.col("n_nationkey").cast("long"), F.col("n_name"))
    c = table(spark, d, "customer").select(F.concat(F.lit("c"), F.col("c_custkey")), F.concat(F.lit("n"), F.col("c_nationkey")), F.col("c_custkey"), F.col("c_name"))
    return r.union(n).union(c)


_TREE = """WITH RECURSIVE e AS (SELECT 'r' || r_regionkey AS node, CAST(NULL AS VARCHAR) AS parent, r_name AS label FROM region UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey, n_name FROM nation UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey, c_name FROM customer),
    w AS (SELECT node, label AS path, 0 AS depth FROM e WHERE parent IS NULL UNION ALL SELECT e.node, w.path || ' > ' || e.label, w.depth + 1 FROM w JOIN e ON e.parent = w.node)"""


@query(f"{_TREE} SELECT node, path, CAST(depth AS BIGINT) AS depth, node NOT IN (SELECT parent FROM e WHERE parent IS NOT NULL) AS leaf FROM w")
def tree_paths(spark, d):
    """Paths of all nodes of the tree of regions, nations and customers."""
    x = trees.preorder(_places(spark, d), "node", "parent", "ord", "label")
    return x.select("node", F.array_join("path", " > ").alias("path"), F.col("depth").cast("long").alias("depth"), "leaf")


@query(f"{_TREE} SELECT CAST(depth AS BIGINT) AS depth, count(*) AS nodes, count(*) FILTER (WHERE node NOT IN (SELECT parent FROM e WHERE parent IS NOT NULL)) AS leaves FROM w GROUP BY 1")
def tree_counts(spark, d):
    """Nodes and leaves by depth."""
    x = trees.preorder(_places(spark, d), "node", "parent", "ord", "label")
    return x.groupBy(F.col("depth").cast("long").alias("depth")).agg(F.count("*").alias("nodes"), F.count_if("leaf").alias("leaves"))


_EDGES = "e AS (SELECT b.n_nationkey AS a, c.n_nationkey AS b FROM nation b JOIN nation c ON b.n_regionkey = c.n_regionkey AND b.n_nationkey < c.n_nationkey)"


def _edges(spark, d):
    n = table(spark, d, "nation").select("n_nationkey", "n_regionkey")
    a, b = n.select(F.col("n_nationkey").alias("a"), "n_regionkey"), n.select(F.col("n_nationkey").alias("b"), "n_regionkey")
    return a.join(b, "n_regionkey").where("a < b").select("a", "b")


@query(f"WITH {_EDGES}, m AS (SELECT min(a) AS a, max(b) AS b FROM e JOIN nation ON n_nationkey = a GROUP BY n_regionkey) SELECT CAST(n_nationkey AS BIGINT) AS node FROM nation WHERE n_nationkey IN (SELECT a FROM e UNION SELECT b FROM e)")
def prereq_cycle(spark, d):
    """Nodes on or behind a cycle once each region's last nation requires its first."""
    e = _edges(spark, d)
    back = e.join(table(spark, d, "nation").select(F.col("n_nationkey").alias("a"), "n_regionkey"), "a").groupBy("n_regionkey").agg(F.max("b").alias("a"), F.min("a").alias("b")).select("a", "b")
    return trees.cyclic_nodes(e.unionByName(back), "a", "b").select(F.col("node").cast("long").alias("node"))


@query("SELECT CAST(NULL AS BIGINT) AS node WHERE false")
def prereq_acyclic(spark, d):
    """No node on a cycle where edges go from lesser to greater keys only."""
    return trees.cyclic_nodes(_edges(spark, d), "a", "b").select(F.col("node").cast("long").alias("node"))


@query(f"WITH {_EDGES} SELECT DISTINCT CAST(x.a AS BIGINT) AS a, CAST(x.b AS BIGINT) AS c FROM e x JOIN e y ON y.a = x.a JOIN e z ON z.a = y.b AND z.b = x.b")
def prereq_transitive(spark, d):
    """Edges that two others make needless."""
    return trees.redundant_edges(_edges(spark, d), "a", "b").select(F.col("a").cast("long").alias("a"), F.col("c").cast("long").alias("c"))


@query(
    """WITH l AS (SELECT 'u' || o_custkey AS url, 'u' || (o_orderkey % 500 + 1) AS target FROM orders), p AS (SELECT 'u' || c_custkey AS url, CAST(c_custkey % 97 AS BIGINT) AS tokens FROM customer),
    one AS (SELECT url, tokens, row_number() OVER (ORDER BY url) - 1 AS place, coalesce(sum(tokens) OVER (ORDER BY url ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM (SELECT DISTINCT target AS url FROM l WHERE url = 'u1' AND target <> 'u1') JOIN p USING (url)),
    got AS (SELECT * FROM one WHERE place < 50 AND before < 1500), sums AS (SELECT count(*) AS n, coalesce(sum(tokens), 0) AS t FROM got),
    two AS (SELECT url, tokens, n + row_number() OVER (ORDER BY up, url) - 1 AS place, t + coalesce(sum(tokens) OVER (ORDER BY up, url ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM (SELECT l.target AS url, min(got.place) AS up FROM got JOIN l ON l.url = got.url WHERE l.target <> 'u1' AND l.target NOT IN (SELECT url FROM one) GROUP BY 1) JOIN p USING (url), sums),
    taken AS (SELECT url, 1 AS depth, place, tokens FROM got UNION ALL SELECT url, 2, place, tokens FROM two WHERE place < 50 AND before < 1500)
    SELECT url, CAST(depth AS BIGINT) AS depth, place, tokens, (SELECT CASE WHEN sum(tokens) >= 1500 THEN 'max_tokens' WHEN (SELECT count(*) FROM two) + (SELECT n FROM sums) > 50 THEN 'max_pages' ELSE 'exhausted' END FROM taken) AS limited_by FROM taken"""
)
def bfs_crawl(spark, d):
    """Pages reached from one, two levels down, within budgets of pages and tokens."""
    links = table(spark, d, "orders").select(F.concat(F.lit("u"), F.col("o_custkey")).alias("url"), F.concat(F.lit("u"), F.col("o_orderkey") % 500 + 1).alias("target"))
    pages = table(spark, d, "customer").select(F.concat(F.lit("u"), F.col("c_custkey")).alias("url"), (F.col("c_custkey") % 97).cast("long").alias("tokens"))
    return trees.crawl(pages, links, spark.createDataFrame([("u1",)], "url string"), most_depth=2, most_tokens=1500).withColumn("depth", F.col("depth").cast("long"))


# ---- windows -----------------------------------------------------------------

_SEG = "s AS (SELECT user_id AS video, event_id AS seg_ord, epoch_ms(ts) / 1000.0 - min(epoch_ms(ts)) OVER () / 1000.0 AS start, event_type AS text FROM events)"


def _segments(spark, d):
    e = table(spark, d, "events").select(F.col("user_id").alias("video"), F.col("event_id").alias("seg_ord"), F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"), F.col("event_type").alias("text"))
    first = e.agg(F.min("ms").alias("first"))
    return e.join(F.broadcast(first)).select("video", "seg_ord", (F.col("ms") / 1000.0 - F.col("first") / 1000.0).alias("start"), F.lit(1.0).alias("duration"), "text")


_CLOCK = "CASE WHEN ({0}) >= 3600 THEN printf('%02d:%02d:%02d', ({0}) // 3600, ({0}) % 3600 // 60, ({0}) % 60) ELSE printf('%02d:%02d', ({0}) // 60, ({0}) % 60) END"


@query(
    f"""WITH {_SEG}, g AS (SELECT video, CAST(floor(start / 300) AS BIGINT) AS w, count(*) AS n, string_agg(text, ' ' ORDER BY seg_ord) AS text FROM s GROUP BY 1, 2)
    SELECT video, w AS "window", '[' || {_CLOCK.format("w * 300")} || '-' || {_CLOCK.format("(w + 1) * 300")} || ']' AS title, n, md5(text) AS text_md5 FROM g"""
)
def transcript_windows(spark, d):
    """Events by windows of 300 seconds."""
    return windows.time_windows(_segments(spark, d), "video").select("video", "window", "title", "n", F.md5("text").alias("text_md5"))


@query(
    f"""WITH {_SEG}, c AS (SELECT DISTINCT video, CAST(floor(start / 86400) AS BIGINT) AS chap_ord FROM s)
    SELECT s.video, c.chap_ord, count(*) AS n, md5(string_agg(text, ' ' ORDER BY seg_ord)) AS text_md5 FROM s JOIN c ON c.video = s.video AND start >= chap_ord * 86400.0 AND start < (chap_ord + 1) * 86400.0 GROUP BY 1, 2"""
)
def transcript_chapters(spark, d):
    """Events by chapters of a day, half open."""
    s = _segments(spark, d)
    day = F.floor(F.col("start") / 86400)
    marks = s.select("video", day.cast("long").alias("chap_ord")).distinct().select("video", "chap_ord", (F.col("chap_ord") * 86400.0).alias("start_time"), ((F.col("chap_ord") + 1) * 86400.0).alias("end_time"), F.lit("day").alias("title"))
    return windows.chapters(s, marks, "video").select("video", "chap_ord", "n", F.md5("text").alias("text_md5"))


@query(
    """WITH x AS (SELECT p_partkey AS i, '| ' || replace(p_name, '|', '\\|') || ' | ' || replace(p_brand, '|', '\\|') || ' | ' || p_size || ' |' AS c, 'p_name: ' || p_name || '; p_brand: ' || p_brand || '; p_size: ' || p_size AS p FROM part)
    SELECT CAST(i // 50 AS BIGINT) AS section_ord, 'Rows ' || (i // 50 * 50 + 1) || '-' || (i // 50 * 50 + count(*)) AS title,
      md5('| p_name | p_brand | p_size |' || chr(10) || '| --- | --- | --- |' || chr(10) || string_agg(c, chr(10) ORDER BY i) || chr(10) || chr(10) || '---' || chr(10) || chr(10) || string_agg(p, chr(10) ORDER BY i)) AS content_md5 FROM x GROUP BY i // 50"""
)
def tabular_sections(spark, d):
    """Parts as sections of 50 rows."""
    p = table(spark, d, "part").withColumn("i", F.col("p_partkey"))
    return windows.row_sections(p, [], "i", ["p_name", "p_brand", "p_size"]).select("section_ord", "title", F.md5("content").alias("content_md5"))


@query(
    """WITH i AS (SELECT label AS grp, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS place, count(*) OVER (PARTITION BY label) AS n FROM embeddings)
    SELECT CAST(grp AS BIGINT) AS grp, least(place // greatest(1, n // 7), 6) AS section, count(*) AS images FROM i GROUP BY 1, 2"""
)
def image_distribution(spark, d):
    """Images of each label spread over seven sections."""
    e = lookup.numbered(table(spark, d, "embeddings").select(F.col("label").alias("grp"), "vec_id"), ["grp"], ["vec_id"], "place")
    x = e.join(e.groupBy("grp").agg(F.count("*").alias("n")), "grp").withColumn("sections", F.lit(7))
    return windows.distribute(x, ["grp"], "place", "n", "sections").groupBy(F.col("grp").cast("long").alias("grp"), "section").agg(F.count("*").alias("images"))


@query("SELECT o_custkey, o_orderkey FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS r FROM orders) WHERE r <= 3")
def top_per_group(spark, d):
    """The three greatest orders of each customer."""
    return windows.top_of_group(table(spark, d, "orders"), ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 3).select("o_custkey", "o_orderkey")


@query("SELECT chunk_id, max(chunked_at) AS chunked_at, max(chunk_index)::BIGINT AS chunk_index FROM chunks GROUP BY 1")
def latest_chunks(spark, d):
    """One row for every chunk, its last delivery."""
    c = table(spark, d, "chunks").select("chunk_id", "chunked_at", "chunk_index")
    return windows.keep_one(c, ["chunk_id"], ["chunked_at"], last=True).select("chunk_id", "chunked_at", F.col("chunk_index").cast("long").alias("chunk_index"))


@query("SELECT chunk_id, CAST(row_number() OVER (PARTITION BY curriculum_id ORDER BY chunk_id) - 1 AS BIGINT) AS sort_order FROM (SELECT DISTINCT curriculum_id, chunk_id FROM chunks)")
def running_index(spark, d):
    """Chunks numbered within their curriculum."""
    c = table(spark, d, "chunks").select("curriculum_id", "chunk_id").distinct()
    return lookup.numbered(c, ["curriculum_id"], ["chunk_id"], "sort_order").select("chunk_id", F.col("sort_order").cast("long").alias("sort_order"))


# ---- condensing and measures -------------------------------------------------


@query(
    """SELECT curriculum_id, count(*) AS chunks, CAST(sum(coalesce(token_count, len(list_filter(regexp_split_to_array(content, '\\s+'), lambda x: x <> '')), 0)) AS BIGINT) AS tokens
    FROM (SELECT DISTINCT chunk_id, curriculum_id, token_count, content FROM chunks) GROUP BY 1"""
)
def chunk_stats(spark, d):
    """Chunks and tokens by curriculum."""
    c = table(spark, d, "chunks").select("chunk_id", "curriculum_id", "token_count", "content").distinct()
    return condense.stats(c, ["curriculum_id"])


def _plan(spark, d):
    """A plan made of root topics: even ones kept, others merged, with two keys each."""
    r = _roots(spark, d).where("title is not null")
    strategy = F.when(F.col("structure_id") % 3 == 0, "keep").when(F.col("structure_id") % 3 == 1, "merge").otherwise("other")
    child = "array<struct<title:string,description:string,condensation_strategy:string,source_children:array<string>,content:string>>"
    return r.select(F.concat(F.lit("t"), F.col("curriculum_id")).alias("tier"), F.col("structure_id").alias("topic_ord"), "title", strategy.alias("condensation_strategy"), F.array("title").alias("source_topics"), F.when(F.col("structure_id") % 5 == 0, "own words here").alias("content"), F.lit(None).cast(child).alias("children"))


@query(
    f"""WITH {_ROOTS}, p AS (SELECT 't' || curriculum_id AS tier, structure_id AS topic_ord, title, CASE structure_id % 3 WHEN 0 THEN 'keep' WHEN 1 THEN 'merge' ELSE 'other' END AS strategy, structure_id % 5 = 0 AS own FROM r WHERE title IS NOT NULL),
    c AS (SELECT DISTINCT chunk_id, topic_path[-1] AS title, content, CAST(token_count AS BIGINT) AS token_count FROM chunks WHERE len(topic_path) > 0 AND token_count IS NOT NULL AND content IS NOT NULL),
    j AS (SELECT tier, topic_ord, strategy, c.chunk_id, c.content, c.token_count FROM p JOIN c USING (title) WHERE NOT own)
    SELECT tier, topic_ord, CAST(0 AS BIGINT) AS chunk_index, CAST(3 AS BIGINT) AS token_count, md5('own words here') AS content_md5 FROM p WHERE own
    UNION ALL SELECT tier, topic_ord, row_number() OVER (PARTITION BY tier, topic_ord ORDER BY chunk_id) - 1, token_count, md5(content) FROM j WHERE strategy = 'keep'
    UNION ALL SELECT tier, topic_ord, 0, len(list_filter(regexp_split_to_array(string_agg(content, chr(10) || chr(10) ORDER BY chunk_id), '\\s+'), lambda x: x <> '')), md5(string_agg(content, chr(10) || chr(10) ORDER BY chunk_id)) FROM j WHERE strategy = 'merge' GROUP BY tier, topic_ord"""
)
def condense_chunks(spark, d):
    """Chunks of a condensed plan, kept, merged or written anew."""
    c = table(spark, d, "chunks").where("size(topic_path) > 0 and token_count is not null and content is not null").select("chunk_id", "topic_path", "content", "token_count", "has_code").dropDuplicates(["chunk_id"])
    c = c.select(F.element_at("topic_path", -1).alias("title"), F.col("chunk_id").alias("chunk_ord"), "content", "token_count", "has_code")
    x = condense.leaf_chunks(condense.plan_leaves(_plan(spark, d)), c)
    return x.select("tier", "topic_ord", F.col("chunk_index").cast("long").alias("chunk_index"), "token_count", F.md5("content").alias("content_md5"))


@query(
    """WITH t AS (SELECT DISTINCT curriculum_id, title AS topic FROM structure WHERE title IS NOT NULL),
    c AS (SELECT curriculum_id, topic_path[1] AS topic, count(*) AS n, sum(CAST(coalesce(token_count, 0) AS BIGINT)) AS tokens FROM (SELECT DISTINCT chunk_id, curriculum_id, topic_path, token_count FROM chunks WHERE len(topic_path) > 0) GROUP BY 1, 2)
    SELECT curriculum_id, count(*) FILTER (WHERE t.topic IS NOT NULL) AS topics, CAST(coalesce(sum(n), 0) AS BIGINT) AS chunks, CAST(coalesce(floor(sum(tokens) / sum(n)), 0) AS BIGINT) AS avg_tokens,
      coalesce(min(n) FILTER (WHERE t.topic IS NOT NULL), 0) AS least, coalesce(max(n) FILTER (WHERE t.topic IS NOT NULL), 0) AS most,
      count(*) FILTER (WHERE t.topic IS NOT NULL AND n IS NULL) AS empty_topics, CAST(coalesce(sum(n) FILTER (WHERE t.topic IS NULL), 0) AS BIGINT) AS orphan_chunks
    FROM t FULL JOIN c USING (curriculum_id, topic) GROUP BY 1"""
)
def review_report(spark, d):
    """Chunks per root topic, empty topics and orphans, by curriculum."""
    c = table(spark, d, "chunks").where("size(topic_path) > 0").select("chunk_id", "curriculum_id", F.col("topic_path")[0].alias("topic"), "token_count").distinct()
    t = table(spark, d, "structure").where("title is not null").select("curriculum_id", "title")
    return condense.review(c, t, "curriculum_id", "title")


SQL["review_report"] = SQL["review_report"].replace("t FULL JOIN c USING (curriculum_id, topic)", "(SELECT coalesce(t.curriculum_id, c.curriculum_id) AS curriculum_id, t.topic AS topic, n, tokens FROM t FULL JOIN c ON t.curriculum_id = c.curriculum_id AND t.topic = c.topic) t")


@query(
    """SELECT curriculum_id, count(*) AS roots, count(*) FILTER (WHERE len(source_sections) > 10) AS wide, count(*) FILTER (WHERE suggested_level = 1) AS level_1, count(*) FILTER (WHERE suggested_level = 2) AS level_2, count(*) FILTER (WHERE suggested_level = 3) AS level_3,
      count(*) FILTER (WHERE len(learning_objectives) BETWEEN 2 AND 5) AS good_objectives, count(*) BETWEEN 5 AND 15 AS roots_ok
    FROM (SELECT structure_id, any_value(curriculum_id) AS curriculum_id, any_value(source_sections) AS source_sections, any_value(suggested_level) AS suggested_level, any_value(learning_objectives) AS learning_objectives FROM structure GROUP BY 1) GROUP BY 1"""
)
def quality_gates(spark, d):
    """Counts behind the checks of a structure, by curriculum."""
    s = table(spark, d, "structure").dropDuplicates(["structure_id"])
    return s.groupBy("curriculum_id").agg(
        F.count("*").alias("roots"), F.count_if(F.size("source_sections") > 10).alias("wide"), *[F.count_if(F.col("suggested_level") == i).alias(f"level_{i}") for i in (1, 2, 3)],
        F.count_if(F.size("learning_objectives").between(2, 5)).alias("good_objectives"), F.count("*").between(5, 15).alias("roots_ok"),
    )


_VERBS = " ".join("WHEN '" + lv + "' THEN lower(split_part(trim(o.text), ' ', 1)) IN (" + ", ".join(f"'{v}'" for v in vs) + ")" for lv, vs in T.LEVEL_VERBS.items())


@query(f"SELECT structure_id, count(*) AS objectives, count(*) FILTER (WHERE CASE o.bloom_level {_VERBS} ELSE false END) AS fitting FROM (SELECT structure_id, unnest(learning_objectives) AS o FROM (SELECT DISTINCT structure_id, learning_objectives FROM structure)) GROUP BY 1")
def objective_verbs(spark, d):
    """Objectives whose verb fits their level, by root topic."""
    o = lookup.objective_rows(table(spark, d, "structure").select("structure_id", "learning_objectives").distinct(), "structure_id", "learning_objectives")
    return o.groupBy("structure_id").agg(F.count("*").alias("objectives"), F.count_if(condense.verb_fits(F.col("text"), F.col("bloom_level"))).alias("fitting"))


@query("SELECT curriculum_id, lower(title) AS concept, count(DISTINCT source_path) AS sources, CASE WHEN count(DISTINCT source_path) >= 3 THEN 'strong' WHEN count(DISTINCT source_path) = 2 THEN 'moderate' WHEN count(DISTINCT source_path) = 1 THEN 'thin' ELSE 'gap' END AS coverage FROM extracted WHERE title <> '' GROUP BY 1, 2")
def concept_coverage(spark, d):
    """How many sources cover each title of a curriculum."""
    x = table(spark, d, "extracted").where("title <> ''").groupBy("curriculum_id", F.lower("title").alias("concept")).agg(F.countDistinct("source_path").alias("sources"))
    return x.withColumn("coverage", condense.coverage(F.col("sources")))


@query(
    """WITH w AS (SELECT doc_id, source, len(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '')) AS n FROM documents WHERE text IS NOT NULL),
    l AS (SELECT doc_id, n, lead(n) OVER (PARTITION BY source ORDER BY doc_id) AS m FROM w)
    SELECT CASE WHEN n > 2000 THEN 'split' WHEN n < 300 AND m < 300 THEN 'merge' ELSE 'keep' END AS action, count(*) AS n FROM l GROUP BY 1"""
)
def lesson_actions(spark, d):
    """Lessons to split, merge or keep by their lengths."""
    from pyspark.sql import Window

    w = table(spark, d, "documents").where("text is not null").select("doc_id", "source", T.word_count(F.col("text")).alias("w"))
    w = w.withColumn("m", F.lead("w").over(Window.partitionBy("source").orderBy("doc_id")))
    return w.groupBy(condense.lesson_action(F.col("w"), F.col("m")).alias("action")).agg(F.count("*").alias("n"))


@query("SELECT curriculum_id, topic_path[1] AS topic, count(*) AS chunks, count(*) < 3 OR count(*) > 30 AS flagged FROM (SELECT DISTINCT chunk_id, curriculum_id, topic_path FROM chunks) WHERE len(topic_path) > 0 GROUP BY 1, 2")
def chunk_distribution(spark, d):
    """Chunks by root topic, with those under 3 or over 30 flagged."""
    c = table(spark, d, "chunks").select("chunk_id", "curriculum_id", "topic_path").distinct().where("size(topic_path) > 0")
    return c.groupBy("curriculum_id", F.col("topic_path")[0].alias("topic")).agg(F.count("*").alias("chunks"), ((F.count("*") < 3) | (F.count("*") > 30)).alias("flagged"))


def queries():
    return Q


def oracle_sql():
    return SQL
