"""Queries of sources, sinks and streams, with their SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexaloom.functions import text as T
from lexaloom.operators import condense, lookup, trees
from lexaloom.session import _shared_folder
from lexaloom.plans.text_queries import STRIP, _parts_sql
from lexaloom.sources import connectors as C
from lexaloom.sources.tables import table
from lexaloom.streaming import streams

Q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        Q[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


@query(
    """WITH u AS (SELECT DISTINCT curriculum_id, source_path FROM extracted WHERE regexp_matches(source_path, '^https?://[^?#]*$')),
    p AS (SELECT curriculum_id, min(source_path) AS url FROM u GROUP BY 1), o AS (SELECT curriculum_id, url, regexp_extract(url, '^(https?://[^/?#]*)', 1) AS origin FROM p)
    SELECT DISTINCT o.url, o.origin || '/' || u.curriculum_id || '/' || md5(u.source_path) AS target FROM o JOIN u USING (curriculum_id)"""
)
def web_links(spark, d):
    """Links of pages made from the web sources of each curriculum."""
    u = table(spark, d, "extracted").where("source_path rlike '^https?://[^?#]*$'").select("curriculum_id", "source_path").distinct()
    p = u.groupBy("curriculum_id").agg(F.min("source_path").alias("url"), F.array_join(F.sort_array(F.collect_list(F.concat(F.lit('<li><a class="x" href="/'), F.col("curriculum_id"), F.lit("/"), F.md5("source_path"), F.lit('?q=1#top">a</a> <a href="https://other.example/x">b</a></li>')))), "\n").alias("html"))
    return C.links_in(p.select("url", "html"), prefixes=["/"])


_GONE = "(?is)<!--.*?-->|" + "|".join(f"<{t}\\b[^>]*>.*?</{t}\\s*>" for t in ("script", "style", "nav", "footer", "header", "aside"))


def _page_text_sql(html: str) -> str:
    t = f"regexp_replace({html}, '{_GONE}', ' ', 'g')"
    t = f"regexp_replace({t}, '(?i)<h([1-6])\\b[^>]*>', chr(10) || chr(10) || '# ', 'g')"
    t = f"regexp_replace({t}, '(?i)</(p|div|h[1-6]|li|tr|section|article)\\s*>|<br\\s*/?>', chr(10) || chr(10), 'g')"
    t = f"regexp_replace({t}, '<[^>]*>', ' ', 'g')"
    for entity, ch in (("&nbsp;", "' '"), ("&lt;", "'<'"), ("&gt;", "'>'"), ("&quot;", "'\"'"), ("&#39;", "chr(39)"), ("&copy;", "'©'"), ("&amp;", "'&'")):
        t = f"replace({t}, '{entity}', {ch})"
    t = f"regexp_replace(regexp_replace({t}, '[ \\t]+', ' ', 'g'), ' ?\\n[\\n ]*', chr(10) || chr(10), 'g')"
    return f"regexp_replace(regexp_replace({t}, '^[\\s\\x{{0B}}\\x{{A0}}]+', ''), '[\\s\\x{{0B}}\\x{{A0}}]+$', '')"


_HTML = """'<html><head><script>x = ''</p>''</script></head><nav>menu</nav><h1>Title</h1><p>' || replace(text, chr(10) || chr(10), '</p><p>') || '</p><img src="/a.png" alt="A">&copy;</html>'"""


@query(f"SELECT 'https://site.example/' || doc_id AS url, md5({_page_text_sql(_HTML)}) AS text_md5, 'web_img0' AS id, 'https://site.example/a.png' AS src, 'A' AS alt FROM documents WHERE text IS NOT NULL")
def web_text(spark, d):
    """Text and images of pages made from documents."""
    p = table(spark, d, "documents").where("text is not null").select(F.concat(F.lit("https://site.example/"), F.col("doc_id")).alias("url"), F.concat(F.lit("<html><head><script>x = '</p>'</script></head><nav>menu</nav><h1>Title</h1><p>"), F.replace("text", F.lit("\n\n"), F.lit("</p><p>")), F.lit('</p><img src="/a.png" alt="A">&copy;</html>')).alias("html"))
    return p.select("url", F.md5(C.page_text(F.col("html"))).alias("text_md5")).join(C.images_in(p), "url")


@query(
    f"""WITH {_parts_sql(6)}, rows_ AS (SELECT doc_id, i, coalesce(title, 'Introduction') AS title, depth, content FROM headed UNION ALL SELECT doc_id, 0, 'Content', 0, {STRIP('text')} FROM m WHERE len(h) = 0),
    n AS (SELECT *, count(*) OVER (PARTITION BY doc_id) AS n, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS r FROM rows_)
    SELECT doc_id, CAST(CASE WHEN n = 1 THEN 0 ELSE r END AS BIGINT) AS section_ord, CASE WHEN n = 1 THEN 'Page ' || doc_id ELSE title END AS title, CAST(CASE WHEN n = 1 THEN doc_id % 3 ELSE depth + doc_id % 3 END AS BIGINT) AS depth, md5(content) AS content_md5 FROM n
    UNION ALL SELECT DISTINCT doc_id, 0, 'Page ' || doc_id, doc_id % 3, md5('') FROM n WHERE n > 1"""
)
def export_documents(spark, d):
    """Pages of a workspace's export as documents: a page with several sections has one of its own title before them."""
    x = table(spark, d, "documents").where("text is not null")
    pages = x.select(F.lit("a.zip").alias("path"), F.col("doc_id").cast("string").alias("page"), F.concat(F.lit("Page "), "doc_id").alias("title"), (F.col("doc_id") % 3).cast("int").alias("depth"), "text")
    return C.export_documents(pages).select(F.col("page").cast("long").alias("doc_id"), F.col("section_ord").cast("long").alias("section_ord"), "title", F.col("depth").cast("long").alias("depth"), F.md5("content").alias("content_md5"))


@query(
    f"""WITH {_parts_sql(3)}, p AS (SELECT doc_id, text, list_filter(list_transform(string_split(text, chr(10) || chr(10)), lambda x: {STRIP('x')}), lambda x: x <> '') AS p FROM m WHERE len(h) = 0),
    named AS (SELECT doc_id, 'Docs Page ' || doc_id AS name FROM documents), rows_ AS (SELECT doc_id, i, title, depth, content FROM headed
      UNION ALL SELECT doc_id, 0, NULL, 0, {STRIP('text')} FROM p WHERE len(p) <= 3
      UNION ALL SELECT doc_id, i, left(split_part(f[1], chr(10), 1), 80), 0, array_to_string(f, chr(10) || chr(10)) FROM (SELECT doc_id, i, p[i * 5 + 1 : i * 5 + 5] AS f FROM (SELECT doc_id, p, unnest(range(CAST((len(p) + 4) // 5 AS BIGINT))) AS i FROM p WHERE len(p) > 3)))
    SELECT r.doc_id, CAST(row_number() OVER (PARTITION BY r.doc_id ORDER BY i) AS BIGINT) AS section_ord, coalesce(title, name) AS title, CAST(least(depth + 1, 2) AS BIGINT) AS depth, md5(content) AS content_md5 FROM rows_ r JOIN named n ON n.doc_id = r.doc_id
    UNION ALL SELECT doc_id, 0, name, 0, md5('') FROM named WHERE doc_id IN (SELECT doc_id FROM m)"""
)
def crawled_sections(spark, d):
    """Pages of a crawl, each with its title before its sections, which stand a level lower."""
    x = table(spark, d, "documents").where("text is not null")
    url = F.concat(F.lit("https://site.example/x/docs-page-"), "doc_id", F.lit(".html"))
    pages = x.select(url.alias("url"), F.lit(None).cast("string").alias("title"), "text")
    out = C.crawled_sections(x.select(url.alias("url"), F.col("doc_id").alias("place")), pages)
    return out.select(F.col("place").alias("doc_id"), F.col("section_ord").cast("long").alias("section_ord"), "title", F.col("depth").cast("long").alias("depth"), F.md5("content").alias("content_md5"))


@query(
    """SELECT structure_id AS doc, CAST(i AS BIGINT) AS ord, CAST(CASE i % 3 WHEN 0 THEN 2 WHEN 1 THEN 1 END AS BIGINT) AS level, trim(o.text) AS title
    FROM (SELECT structure_id, unnest(range(len(learning_objectives))) AS i, unnest(learning_objectives) AS o FROM (SELECT DISTINCT structure_id, learning_objectives FROM structure)) WHERE i % 3 < 2 AND trim(coalesce(o.text, '')) <> ''"""
)
def heading_entries(spark, d):
    """Headings of documents by the style of their paragraphs."""
    s = table(spark, d, "structure").select("structure_id", "learning_objectives").distinct().select(F.col("structure_id").alias("doc"), F.posexplode("learning_objectives").alias("ord", "o"))
    style = F.when(F.col("ord") % 3 == 0, "Heading 2").when(F.col("ord") % 3 == 1, "Heading X").otherwise("Normal")
    return C.heading_entries(s.select("doc", "ord", style.alias("style"), F.col("o.text").alias("text"))).select("doc", F.col("ord").cast("long").alias("ord"), F.col("level").cast("long").alias("level"), "title")


# A file for every part, of every known kind and some others, in folders to skip and to take, with readmes.
_ENDS = [*C.LANGUAGE, "lua", "TXT", "bin", "png", "conf", ""]
_FOLDERS = ["", "src/", "src/core/", "src/core/deep/down/", ".hidden/", "node_modules/x/", "docs/"]
_NAME = f"""CASE WHEN p_partkey = 1 THEN 'README.rst' WHEN p_partkey = 2 THEN 'README.md' WHEN p_partkey % 41 = 0 THEN folder || 'readme.md' WHEN p_partkey % 43 = 0 THEN folder || '.gitignore' WHEN p_partkey % 47 = 0 THEN folder || 'Makefile'
      ELSE folder || p_partkey || CASE WHEN e = '' THEN '' ELSE '.' || e END END"""
_FILES = f"""f AS (SELECT DISTINCT ON (path) path, content, size FROM (SELECT {_NAME} AS path, p_name AS content, CAST(p_size * 2500 AS BIGINT) AS size, p_partkey FROM (
      SELECT *, {_ENDS}[CAST(p_partkey % {len(_ENDS)} AS INT) + 1] AS e, {_FOLDERS}[CAST(p_partkey % {len(_FOLDERS)} AS INT) + 1] AS folder FROM part)) ORDER BY path, p_partkey)"""


def _files(spark, d):
    at = lambda xs: F.get(F.array(*[F.lit(x) for x in xs]), (F.col("p_partkey") % len(xs)).cast("int"))
    p = table(spark, d, "part").withColumn("e", at(_ENDS)).withColumn("folder", at(_FOLDERS))
    path = F.expr(_NAME.replace("p_partkey ||", "CAST(p_partkey AS STRING) ||").replace("|| p_partkey", "|| CAST(p_partkey AS STRING)"))
    return p.select(path.alias("path"), F.struct("p_partkey", F.col("p_name").alias("content"), (F.col("p_size") * 2500).cast("long").alias("size")).alias("v")).groupBy("path").agg(F.min("v").alias("v")).select("path", "v.content", "v.size")


def _listed(words):
    return "(" + ", ".join(f"'{w}'" for w in words) + ")"


_EXT = "lower(regexp_extract({0}, '[^/]\\.([^./]+)$', 1))"
_TAKEN = f"({_EXT.format('{0}')} IN {_listed(C.TAKEN)} OR ({_EXT.format('{0}')} = '' AND regexp_extract({{0}}, '([^/]*)$', 1) IN {_listed(C.NAMED)}))"
_LANG = f"CASE {_EXT.format('path')} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in C.LANGUAGE.items()) + " ELSE 'text' END"
_BARS = f"""n AS (SELECT DISTINCT list_slice(ps, 1, i) AS p, i < len(ps) AS folder FROM (SELECT ps, unnest(range(1, len(ps) + 1)) AS i FROM (SELECT string_split(path, '/') AS ps FROM f))),
    k AS (SELECT *, CASE WHEN folder THEN '0' ELSE '1' END || p[-1] AS own, p[1:len(p) - 1] AS up FROM n WHERE len(p) <= 4 AND len(list_filter(p, lambda s: starts_with(s, '.') OR s IN {_listed(C.SKIPPED)})) = 0),
    b AS (SELECT *, lead(own) OVER (PARTITION BY up ORDER BY own) IS NULL AS last FROM k),
    t AS (SELECT array_to_string(p, '/') AS path, list_transform(range(1, len(p) + 1), lambda i: CASE WHEN i < len(p) OR folder THEN '0' ELSE '1' END || p[i]) AS place,
      coalesce((SELECT string_agg(CASE WHEN a.last THEN '    ' ELSE '│   ' END, '' ORDER BY len(a.p)) FROM b a WHERE len(a.p) < len(b.p) AND b.p[1:len(a.p)] = a.p), '') || CASE WHEN last THEN '└── ' ELSE '├── ' END || p[-1] || CASE WHEN folder THEN '/' ELSE '' END AS line
      FROM b WHERE folder OR {_TAKEN.format("p[-1]")}
      UNION ALL SELECT '', [], 'parts/')"""


@query(
    f"""WITH {_FILES}, {_BARS}, x AS (SELECT CASE WHEN contains(path, '/') THEN regexp_extract(path, '^(.*)/[^/]*$', 1) ELSE '(root)' END AS title, path, '### ' || path || chr(10) || chr(10) || '```' || {_LANG} || chr(10) || content || chr(10) || '```' AS b
      FROM f WHERE size <= 100000 AND NOT starts_with(lower(regexp_extract(path, '([^/]*)$', 1)), 'readme') AND {_TAKEN.format('path')} AND len(list_filter(string_split(path, '/')[1:-2], lambda s: starts_with(s, '.') OR s IN {_listed(C.SKIPPED)})) = 0)
    SELECT CAST(2 AS BIGINT) AS section_ord, title, md5(string_agg(b, chr(10) || chr(10) ORDER BY path)) AS content_md5, CAST(1 AS BIGINT) AS depth, count(*) AS files FROM x GROUP BY title
    UNION ALL SELECT 0, 'README', md5(arg_min(content, list_position({C.README_NAMES}, path))), 0, 1 FROM f WHERE path IN {_listed(C.README_NAMES)} HAVING count(*) > 0
    UNION ALL SELECT 1, 'File Structure', md5('```' || chr(10) || string_agg(line, chr(10) ORDER BY place) || chr(10) || '```'), 0, count(*) FROM t"""
)
def code_sections(spark, d):
    """A tree of code: its readme, its files, and the sources of every folder."""
    return C.code_sections(_files(spark, d), "parts").select(F.col("section_ord").cast("long").alias("section_ord"), "title", F.md5("content").alias("content_md5"), F.col("depth").cast("long").alias("depth"), F.col("files").cast("long").alias("files"))


@query(f"WITH {_FILES}, {_BARS} SELECT path, array_to_string(place, '/') AS place, line FROM t")
def code_tree(spark, d):
    """Folders and files as the lines of a tree."""
    return C.file_tree(_files(spark, d), "parts").select("path", F.array_join("place", "/").alias("place"), "line")


@query(
    """WITH s AS (SELECT event_id % 5000 AS video, CASE event_type WHEN 'view' THEN 'manual' WHEN 'click' THEN 'auto' ELSE 'speech' END AS origin, CASE user_id % 3 WHEN 0 THEN 'en' WHEN 1 THEN 'de' ELSE 'fr' END AS language FROM events),
    r AS (SELECT DISTINCT *, CASE WHEN origin = 'manual' AND language = 'de' THEN 1 WHEN origin = 'manual' AND language = 'en' THEN 2 WHEN origin = 'auto' AND language = 'de' THEN 1001 WHEN origin = 'auto' AND language = 'en' THEN 1002 WHEN origin IN ('manual', 'auto') THEN 2000 ELSE 3000 END AS k FROM s)
    SELECT video, language, origin FROM (SELECT *, row_number() OVER (PARTITION BY video ORDER BY k, language, origin) AS n FROM r) WHERE n = 1"""
)
def transcript_choice(spark, d):
    """The transcript to use for each video."""
    e = table(spark, d, "events")
    origin = F.when(F.col("event_type") == "view", "manual").when(F.col("event_type") == "click", "auto").otherwise("speech")
    lang = F.when(F.col("user_id") % 3 == 0, "en").when(F.col("user_id") % 3 == 1, "de").otherwise("fr")
    return C.pick_transcript(e.select((F.col("event_id") % 5000).alias("video"), lang.alias("language"), origin.alias("origin")), ["de", "en"])


@query("SELECT CAST(user_id AS VARCHAR) AS img_id, md5(string_agg(event_type, chr(10) ORDER BY value, event_id)) AS text_md5 FROM events WHERE value >= 15 GROUP BY 1")
def region_text(spark, d):
    """Recognised regions in reading order, uncertain ones left out."""
    e = table(spark, d, "events").select(F.col("user_id").cast("string").alias("img_id"), F.col("event_id").cast("double").alias("x"), F.col("value").alias("y"), F.col("event_type").alias("text"), (F.col("value") / 100).alias("confidence"))
    return C.read_regions(e).select("img_id", F.md5("text").alias("text_md5"))


@query("SELECT CAST(l_orderkey AS BIGINT) AS doc, 'p' || min_by(l_linenumber, l_linenumber * 1000000 + l_suppkey) || '_img' || min_by(l_suppkey, l_linenumber * 1000000 + l_suppkey) AS id, CAST(l_partkey % 7 AS BIGINT) AS xref FROM lineitem GROUP BY l_orderkey, l_partkey % 7 HAVING min_by(l_quantity * 100, l_linenumber * 1000000000.0 + l_suppkey * 1000 + l_quantity) >= 2048")
def image_registry(spark, d):
    """Images of documents once each, small ones left out."""
    x = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("doc"), F.col("l_linenumber").alias("page"), F.col("l_suppkey").alias("place"), (F.col("l_partkey") % 7).cast("long").alias("xref"), (F.col("l_quantity") * 100).alias("size"))
    return C.image_registry(x).select("doc", "id", "xref")


@query(
    """WITH RECURSIVE p AS (SELECT doc, CAST(i AS BIGINT) AS i, t, len(list_filter(regexp_split_to_array(t, '\\s+'), lambda x: x <> '')) AS n FROM (SELECT curriculum_id AS doc, row_number() OVER (PARTITION BY curriculum_id ORDER BY file_ord, section_ord, section_id) - 1 AS i, coalesce(content, '') AS t FROM (SELECT DISTINCT curriculum_id, file_ord, section_ord, section_id, content FROM extracted))),
    f AS (SELECT doc, i, 1 AS page, CASE WHEN n >= 500 THEN 0 ELSE n END AS run, n >= 500 AS closed FROM p WHERE i = 0
      UNION ALL SELECT p.doc, p.i, CASE WHEN f.closed THEN f.page + 1 ELSE f.page END, CASE WHEN f.run + p.n >= 500 THEN 0 ELSE f.run + p.n END, f.run + p.n >= 500 FROM f JOIN p ON p.doc = f.doc AND p.i = f.i + 1)
    SELECT doc, CAST(page AS BIGINT) AS page, md5(string_agg(t, chr(10) ORDER BY i)) AS text_md5 FROM f JOIN p USING (doc, i) GROUP BY 1, 2 HAVING regexp_replace(string_agg(t, chr(10) ORDER BY i), '[\\s\\x{0B}\\x{A0}]+', '', 'g') <> ''"""
)
def pseudo_pages(spark, d):
    """Sections of a curriculum, each a paragraph, as pages of 500 words."""
    x = table(spark, d, "extracted").select(F.col("curriculum_id").alias("doc"), F.struct("file_ord", "section_ord", "section_id").alias("ord"), F.col("content").alias("text")).distinct()
    return C.pseudo_pages(x).select("doc", F.col("page").cast("long").alias("page"), F.md5("text").alias("text_md5"))


@query(
    """WITH s AS (SELECT o_custkey AS doc, o_orderkey AS slide, l_partkey * 100 + l_linenumber AS ord, CASE l_linenumber % 4 WHEN 0 THEN 'title' WHEN 3 THEN 'notes' ELSE 'text' END AS kind, l_returnflag || l_linenumber AS text FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
    SELECT doc, slide, coalesce(min(text) FILTER (WHERE kind = 'title'), 'Slide ' || slide) AS title, coalesce(string_agg(text, chr(10) || chr(10) ORDER BY ord, text) FILTER (WHERE kind = 'text'), '') AS content, coalesce(string_agg(text, chr(10) || chr(10) ORDER BY ord, text) FILTER (WHERE kind = 'notes'), '') AS notes FROM s GROUP BY 1, 2"""
)
def slide_sections(spark, d):
    """Slides with their titles, texts and notes."""
    x = table(spark, d, "lineitem").join(table(spark, d, "orders").select("o_orderkey", "o_custkey"), F.col("o_orderkey") == F.col("l_orderkey"))
    n = F.col("l_linenumber") % 4
    kind = F.when(n == 0, "title").when(n == 3, "notes").otherwise("text")
    return C.slides(x.select(F.col("o_custkey").alias("doc"), F.col("o_orderkey").alias("slide"), (F.col("l_partkey") * 100 + F.col("l_linenumber")).alias("ord"), kind.alias("kind"), F.concat("l_returnflag", "l_linenumber").alias("text")))


@query("SELECT p_partkey, p_name, CAST(p_size AS VARCHAR) AS p_size, CAST(p_partkey AS VARCHAR) AS key_text FROM part")
def csv_round_trip(spark, d):
    """Parts written as CSV and read again, in order."""
    path = f"{_shared_folder(spark)}/lexaloom-csv-{uuid.uuid4().hex}"
    table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("key_text"), "p_name", F.col("p_size").cast("string").alias("p_size")).write.option("header", True).csv(path)
    return C.read_rows(spark, path).select(F.col("key_text").cast("long").alias("p_partkey"), "p_name", "p_size", "key_text")


@query("SELECT DISTINCT section_id, md5(coalesce(title, '')) AS title_md5, md5(content) AS content_md5 FROM extracted WHERE content IS NOT NULL")
def json_round_trip(spark, d):
    """Sections written as JSON documents and read again."""
    path = f"{_shared_folder(spark)}/lexaloom-json-{uuid.uuid4().hex}"
    e = table(spark, d, "extracted").where("content is not null").dropDuplicates(["section_id"])
    docs = e.select("source_type", F.col("section_id").cast("string").alias("source_path"), "title", "author", F.array(F.struct("title", "content", "depth", "metadata", "images")).alias("sections"), "metadata")
    C.write_json(docs, path)
    back = spark.read.schema(C.EXTRACTED).json(path).select("source_path", F.explode("sections").alias("s"))
    return back.select(F.col("source_path").cast("long").alias("section_id"), F.md5(F.coalesce("s.title", F.lit(""))).alias("title_md5"), F.md5("s.content").alias("content_md5"))


@query("SELECT variant AS tier, count(*) AS n FROM manifest WHERE variant IS NOT NULL GROUP BY 1")
def variant_files(spark, d):
    """Manifests written by tier and counted again."""
    path = f"{_shared_folder(spark)}/lexaloom-tier-{uuid.uuid4().hex}"
    C.write_variants(table(spark, d, "manifest").where("variant is not null").select(F.col("variant").alias("tier"), "curriculum_id"), path)
    return spark.read.parquet(path).groupBy("tier").agg(F.count("*").alias("n"))


def _heads_sql() -> str:
    strip = lambda c: f"regexp_replace(regexp_replace({c}, '^[\\s\\x{{A0}}]+', ''), '[\\s\\x{{A0}}]+$', '')"
    chapter, numbered = "(?i)^(?:chapter|part)\\s+(\\d+|[ivxlc]+)[:.\\s]*(.*)", "^(\\d+(?:\\.\\d+)*)[:.]\\s+(.+)"
    front = ", ".join("'" + x + "'" for x in T.FRONT_TITLES)
    starts = " OR ".join(f"starts_with(lower(title), '{x}')" for x in T.FRONT_STARTS)
    return f"""l AS (SELECT doc_id AS doc, i AS ord, {strip('line')} AS line FROM (SELECT doc_id, unnest(range(len(x))) AS i, unnest(x) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS x FROM documents WHERE text IS NOT NULL))),
    r AS (SELECT doc, ord, line, CASE WHEN regexp_matches(line, '{chapter}') THEN 1 WHEN regexp_matches(line, '{numbered}') THEN 2 WHEN upper(line) = line AND regexp_matches(line, '\\p{{Lu}}') AND len(list_filter(regexp_split_to_array(line, '\\s+'), lambda w: w <> '')) BETWEEN 2 AND 8 AND length(line) > 8 AND NOT regexp_matches(line, '^(HTTP|URL|API|SQL|HTML|\\[)') THEN 3 END AS rule,
      regexp_extract(line, '{numbered}', 1) AS num, trim(regexp_extract(line, '{numbered}', 2)) AS name, {strip(f"regexp_extract(line, '{chapter}', 2)")} AS rest FROM l WHERE length(line) BETWEEN 3 AND 200 AND NOT regexp_matches(line, '^\\[.+\\]\\.?$')),
    h AS (SELECT doc, ord, CASE WHEN rule = 2 THEN length(num) - length(replace(num, '.', '')) + 1 ELSE 1 END AS level, CASE rule WHEN 1 THEN CASE WHEN rest <> '' THEN rest ELSE line END WHEN 2 THEN num || ' ' || name ELSE line END AS title FROM r
      WHERE rule IS NOT NULL AND (rule <> 2 OR (length(num) - length(replace(num, '.', '')) + 1 <= 3 AND NOT (length(name) > 80 OR regexp_matches(name, '^\\p{{Ll}}') OR regexp_matches(name, '[.,;]$'))))),
    k AS (SELECT *, count(*) OVER (PARTITION BY doc) AS n FROM h), d AS (SELECT doc_id AS doc, 20 + doc_id % 3 AS total FROM documents WHERE text IS NOT NULL),
    way AS (SELECT d.doc, d.total, CASE WHEN d.doc % 2 = 0 AND coalesce(m.n, 0) >= 3 THEN 'toc' WHEN d.total > 20 AND coalesce(m.n, 0) > 0 THEN 'found' ELSE 'one' END AS way FROM d LEFT JOIN (SELECT DISTINCT doc, n FROM k) m ON m.doc = d.doc),
    t AS (SELECT k.doc, k.ord, k.level, k.ord + 1 AS page, k.title, w.total FROM k JOIN way w ON w.doc = k.doc AND w.way <> 'one' WHERE length(title) >= 3 AND NOT regexp_matches(title, '^\\[.+\\]\\.?$') AND NOT (lower(title) IN ({front}) OR {starts})),
    g AS (SELECT doc, min(level) AS least FROM t GROUP BY 1)
    SELECT t.doc, CAST(t.ord AS BIGINT) AS ord, lower(t.title) AS title, CAST(t.level - g.least AS BIGINT) AS depth, CAST(t.page AS BIGINT) AS page_start,
      CAST(greatest(coalesce((SELECT arg_min(b.page, b.ord) FROM t b WHERE b.doc = t.doc AND b.ord > t.ord AND b.level <= t.level) - 1, t.total), t.page) AS BIGINT) AS page_end FROM t JOIN g USING (doc)
    UNION ALL SELECT doc, 0, 'document ' || doc, 0, 1, total FROM way WHERE way = 'one'"""


@query("WITH " + _heads_sql())
def topic_trees(spark, d):
    """Trees of sections by what they offer: a table of contents, headings, or neither."""
    docs = table(spark, d, "documents").where("text is not null").select(F.col("doc_id").alias("doc"), F.concat(F.lit("Document "), F.col("doc_id")).alias("title"), (F.lit(20) + F.col("doc_id") % 3).cast("int").alias("total_pages"))
    found = trees.headings(table(spark, d, "documents").where("text is not null").select(F.col("doc_id").alias("doc"), "text"), ["doc"], "text")
    found = found.select("doc", F.col("line_ord").alias("ord"), "level", (F.col("line_ord") + 1).alias("page"), "title")
    toc = found.where("doc % 2 = 0")
    x = trees.topic_tree(toc, found, docs, "doc")
    return x.select("doc", F.col("ord").cast("long").alias("ord"), F.lower("title").alias("title"), *[F.col(c).cast("long").alias(c) for c in ("depth", "page_start", "page_end")])


@query(
    """SELECT structure_id, CAST(1000 + i AS BIGINT) AS chunk_index, md5(o.text) AS content_md5, len(list_filter(regexp_split_to_array(o.text, '\\s+'), lambda x: x <> '')) AS token_count
    FROM (SELECT structure_id, unnest(range(len(learning_objectives))) AS i, unnest(learning_objectives) AS o FROM (SELECT DISTINCT structure_id, learning_objectives FROM structure)) WHERE coalesce(o.text, '') <> ''"""
)
def exercise_rows(spark, d):
    """Exercises as chunks from index 1000 on."""
    s = table(spark, d, "structure").select("structure_id", "learning_objectives").distinct()
    make = lambda o: F.struct(F.lit("t").alias("title"), o["text"].alias("problem_statement"), F.array(F.lit("h")).alias("hints"), F.lit("x").alias("expected_solution"), F.array().cast("array<string>").alias("common_mistakes"), o["bloom_level"].alias("bloom_level"), F.lit(1).alias("difficulty"))
    x = lookup.exercise_rows(s.select("structure_id", F.transform("learning_objectives", make).alias("items")), "structure_id", "items")
    return x.select("structure_id", F.col("chunk_index").cast("long").alias("chunk_index"), F.md5("content").alias("content_md5"), "token_count")


@query("SELECT DISTINCT structure_id, tier, CAST(least(len(learning_objectives), CASE tier WHEN 'detailed' THEN 3 WHEN 'classic' THEN 1 WHEN 'core' THEN 0 ELSE 3 END) AS BIGINT) AS n FROM structure, (SELECT unnest(['detailed', 'classic', 'core', 'other']) AS tier) WHERE learning_objectives IS NOT NULL")
def exercises_topn(spark, d):
    """Exercises a topic keeps in each tier."""
    s = table(spark, d, "structure").where("learning_objectives is not null").select("structure_id", "learning_objectives").distinct()
    s = s.withColumn("tier", F.explode(F.array(*[F.lit(t) for t in ("detailed", "classic", "core", "other")])))
    return s.select("structure_id", "tier", F.size(condense.kept_exercises(F.col("learning_objectives"), F.col("tier"))).cast("long").alias("n"))


@query(
    """SELECT DISTINCT chunk_id, md5(CASE WHEN l = '' THEN content ELSE content || chr(10) || chr(10) || l END) AS content_md5 FROM (
      SELECT chunk_id, content, coalesce(array_to_string(list_transform(list_filter(images, lambda i: i.local_path IS NOT NULL), lambda i: '![' || coalesce(i.alt_text, '') || '](https://images.example/' || i.local_path || ')'), chr(10)), '') AS l FROM chunks WHERE content IS NOT NULL)"""
)
def image_links(spark, d):
    """Chunks with links to their images."""
    c = table(spark, d, "chunks").where("content is not null")
    return c.select("chunk_id", F.md5(lookup.with_image_links(F.col("content"), F.col("images"), "https://images.example")).alias("content_md5")).distinct()


@query(
    """WITH m AS (SELECT DISTINCT curriculum_id, '[IMAGE: ' || i.id || ']' AS mark FROM (SELECT curriculum_id, unnest(images) AS i FROM extracted) WHERE i.id IS NOT NULL), s AS (SELECT curriculum_id, section_id, content || CASE WHEN len(images) > 0 THEN coalesce(array_to_string(list_transform(images, lambda i: ' [IMAGE: ' || i.id || ']'), ''), '') ELSE '' END AS c FROM extracted)
    SELECT m.curriculum_id, m.mark, min(section_id) AS section_id FROM m JOIN s ON s.curriculum_id = m.curriculum_id AND contains(s.c, m.mark) GROUP BY 1, 2"""
)
def image_sections(spark, d):
    """The first section of a curriculum that holds an image's mark."""
    e = table(spark, d, "extracted")
    mark = lambda i: F.concat(F.lit("[IMAGE: "), i["id"], F.lit("]"))
    marks = e.select("curriculum_id", F.explode("images").alias("i")).where("i.id is not null").select("curriculum_id", mark(F.col("i")).alias("mark")).distinct()
    s = e.select("curriculum_id", "section_id", F.concat("content", F.coalesce(F.array_join(F.transform("images", lambda i: F.concat(F.lit(" "), mark(i))), ""), F.lit(""))).alias("content"))
    return lookup.first_containing(marks, s, ["curriculum_id"], "mark", "content", "section_id")


@query(
    """SELECT epoch_ms(CAST(floor(epoch_ms(ts) / 300000.0) AS BIGINT) * 300000) AS start, event_type, count(*) AS n, CAST(round(sum(value) * 100) AS BIGINT) AS cents FROM events GROUP BY 1, 2"""
)
def stream_windows(spark, d):
    """Windows of a stream of events, run to its end; the batch result is the measure."""
    e = streams.stream_table(spark, f"{d}/events.parquet*", table(spark, d, "events"))
    target = f"{_shared_folder(spark)}/lexaloom-{uuid.uuid4().hex}"
    streams.latest_batches(streams.window_counts(e, late="1 day"), target, f"{target}-at").awaitTermination()
    x = streams.settled(spark, target, ["start", "event_type"])
    return x.select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n", F.round(F.col("total") * 100).cast("long").alias("cents"))


@query("SELECT DISTINCT event_id, user_id, event_type FROM events")
def first_deliveries(spark, d):
    """Events of a stream once each, however often they were delivered."""
    e = streams.stream_table(spark, f"{d}/events.parquet*", table(spark, d, "events"))
    target = f"{_shared_folder(spark)}/lexaloom-{uuid.uuid4().hex}"
    q = streams.first_deliveries(e, "event_id", "ts").writeStream.outputMode("append").format("parquet").option("path", target).option("checkpointLocation", f"{target}-at").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.parquet(target).select("event_id", "user_id", "event_type")


@query("SELECT user_id, count(*) AS sessions, CAST(sum(n) AS BIGINT) AS events FROM (SELECT user_id, s, count(*) AS n FROM (SELECT user_id, sum(b) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS b FROM events)) GROUP BY 1, 2) GROUP BY 1")
def event_sessions(spark, d):
    """Sessions that end after a gap of 30 minutes."""
    return streams.sessions(table(spark, d, "events")).groupBy("user_id").agg(F.count("*").alias("sessions"), F.sum("n").alias("events"))


@query("SELECT DISTINCT event_id, user_id FROM events")
def stream_upsert(spark, d):
    """Events of a stream written once each, the stream run twice."""
    target, out = f"{_shared_folder(spark)}/lexaloom-{uuid.uuid4().hex}", None
    like = table(spark, d, "events")
    for i in (1, 2):
        e = streams.stream_table(spark, f"{d}/events.parquet*", like).select("event_id", "user_id")
        out = streams.upsert_batches(e, ["event_id"], target, f"{target}-at-{i}")
        out.awaitTermination()
    return spark.read.parquet(target).drop("part")


def queries():
    return Q


def oracle_sql():
    return SQL
