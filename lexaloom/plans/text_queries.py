"""Queries of scalar functions and chunking, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexaloom.functions import text as T
from lexaloom.operators import chunking, trees
from lexaloom.sources.tables import table

Q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        Q[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def listed(words: list[str]) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


WS = r"[\s\x{00A0}]"
CLEAN = "regexp_replace(regexp_replace(replace(translate(title, chr(160) || chr(10), '  '), '  ', ' '), '^[\\s\\x{00A0}]+', ''), '[\\s\\x{00A0}]+$', '')"


@query(
    f"""SELECT DISTINCT source_path, CASE WHEN starts_with(source_path, 'notion://') THEN 'notion_api'
      WHEN regexp_matches(source_path, '^https?://') THEN CASE WHEN h IN ({listed(T.WORKSPACE_HOSTS)}) THEN 'notion_api' WHEN h IN ({listed(T.VIDEO_HOSTS)}) THEN 'video' ELSE 'web' END
      ELSE CASE lower(regexp_extract(source_path, '\\.([^./\\\\]+)$', 1)) {" ".join(f"WHEN '{e}' THEN '{k}'" for e, k in T.KIND_OF_EXTENSION.items())} ELSE 'code' END END AS kind
    FROM (SELECT source_path, lower(regexp_extract(source_path, '^https?://([^/?#]*)', 1)) AS h FROM extracted WHERE source_path IS NOT NULL)"""
)
def source_kinds(spark, d):
    """Kind of every source path."""
    x = table(spark, d, "extracted").where("source_path is not null").select("source_path").distinct()
    return x.select("source_path", T.source_kind(F.col("source_path")).alias("kind"))


@query(
    """SELECT DISTINCT source_path, CASE WHEN regexp_matches(source_path, '^[a-z_]+://')
        THEN replace(regexp_replace(regexp_extract(source_path, '^[a-z_]+://([^?#]*)', 1), '/+$', ''), '/', '_')
        ELSE regexp_replace(regexp_extract(source_path, '([^/]*)/*$', 1), '(.)\\.[^.]*$', '\\1') END || '.json' AS name
    FROM extracted WHERE source_path IS NOT NULL"""
)
def output_names(spark, d):
    """Output file of every source path."""
    x = table(spark, d, "extracted").where("source_path is not null").select("source_path").distinct()
    return x.select("source_path", T.output_name(F.col("source_path")).alias("name"))


@query("SELECT DISTINCT chunk_id, CAST(len(list_filter(regexp_split_to_array(content, '\\s+'), lambda x: x <> '')) AS BIGINT) AS words FROM chunks WHERE content IS NOT NULL")
def token_counts(spark, d):
    """Words of every chunk."""
    return table(spark, d, "chunks").where("content is not null").select("chunk_id", T.word_count(F.col("content")).alias("words")).distinct()


@query(
    f"""WITH t AS (SELECT DISTINCT chunk_id, string_split(regexp_replace(regexp_replace(content, '^{WS}+', ''), '{WS}+$', ''), chr(10)) AS l FROM chunks WHERE content IS NOT NULL),
    s AS (SELECT chunk_id, len(l) AS n, list_sum(list_transform(l, lambda x: CASE WHEN regexp_matches(regexp_replace(x, '^{WS}+', ''), '^({"|".join(x.replace("{", chr(92) + "{").replace("}", chr(92) + "}").replace("*", chr(92) + "*") for x in T.CODE_STARTS)})') THEN 2
      WHEN regexp_matches(x, '^\\s{{2,}}') AND regexp_replace(x, '{WS}+', '', 'g') <> '' THEN 1 ELSE 0 END)) AS c FROM t)
    SELECT chunk_id, n >= 2 AND c * 10 > n * 6 AS is_code FROM s"""
)
def code_blocks(spark, d):
    """Whether a chunk looks like code."""
    return table(spark, d, "chunks").where("content is not null").select("chunk_id", T.is_code(F.col("content")).alias("is_code")).distinct()


@query(
    f"""SELECT section_id, length(t) < 50 OR length(regexp_replace(t, '[^\\p{{L}}\\p{{N}}\\s]', '', 'g')) * 2 < length(t) AS is_scanned
    FROM (SELECT DISTINCT section_id, regexp_replace(regexp_replace(content, '^{WS}+', ''), '{WS}+$', '') AS t FROM extracted WHERE content IS NOT NULL)"""
)
def scanned_pages(spark, d):
    """Sections with too little text to be read."""
    return table(spark, d, "extracted").where("content is not null").select("section_id", T.is_scanned(F.col("content")).alias("is_scanned")).distinct()


_META = "regexp_replace(lower(t), '[?.!]+$', '')"


@query(
    f"""WITH x AS (SELECT DISTINCT title, {CLEAN} AS t FROM extracted WHERE title IS NOT NULL)
    SELECT title, t AS clean, CASE
      {" ".join(f"WHEN regexp_matches(t, '{p.replace('(?=[A-Z])', '[A-Z]')}') THEN trim(regexp_replace(t, '{p.replace('(?=[A-Z])', '([A-Z])')}', '{chr(92) + '1' if '(?=' in p else ''}'))" for p in T.TITLE_PREFIXES)}
      ELSE t END AS stripped,
      {_META} <> '' AND ({_META} IN ({listed(T.META_TITLES)}) OR regexp_matches({_META}, '{T.META_PHRASES}')) AS is_meta,
      lower(t) IN ({listed(T.FRONT_TITLES)}) OR {" OR ".join(f"starts_with(lower(t), '{s}')" for s in T.FRONT_STARTS)} AS is_front,
      regexp_matches(t, '^\\[.+\\]\\.?$') AS is_citation
    FROM x"""
)
def clean_titles(spark, d):
    """Titles cleaned, their prefix off, and whether they are front or back matter or citations."""
    x = table(spark, d, "extracted").where("title is not null").select("title").distinct()
    c = F.col("title")
    return x.select("title", T.clean_title(c).alias("clean"), T.strip_prefix(c).alias("stripped"), T.is_book_meta(c).alias("is_meta"), T.is_front_matter(T.clean_title(c)).alias("is_front"), T.is_citation(T.clean_title(c)).alias("is_citation"))


@query(
    f"""WITH x AS (SELECT DISTINCT section_id, source_path, coalesce(title, '') AS title FROM extracted),
    y AS (SELECT section_id, source_path, title, {CLEAN} AS t FROM x)
    SELECT coalesce(source_path, '') AS source_path,
      count(*) FILTER (WHERE {_META} <> '' AND ({_META} IN ({listed(T.META_TITLES)}) OR regexp_matches({_META}, '{T.META_PHRASES}'))) AS dropped, count(*) AS sections
    FROM y GROUP BY 1"""
)
def normalize_titles(spark, d):
    """Sections dropped for their titles, by source."""
    x = table(spark, d, "extracted").select("section_id", "source_path", F.coalesce("title", F.lit("")).alias("title")).distinct()
    return x.groupBy(F.coalesce("source_path", F.lit("")).alias("source_path")).agg(F.count_if(T.is_book_meta(F.col("title"))).alias("dropped"), F.count("*").alias("sections"))


@query(
    """WITH h AS (SELECT DISTINCT section_id, md5(content) AS content_hash FROM extracted WHERE coalesce(content, '') <> ''),
    n AS (SELECT content_hash, count(*) AS copies, min(section_id) AS first_key FROM h GROUP BY 1 HAVING count(*) > 1)
    SELECT section_id, content_hash, copies, first_key FROM h JOIN n USING (content_hash)"""
)
def duplicate_contents(spark, d):
    """Sections with equal content."""
    x = table(spark, d, "extracted").select("section_id", "content").dropDuplicates(["section_id"])
    return chunking.duplicates(x, "section_id", "content").select("section_id", "content_hash", "copies", "first_key")


_LINES = "SELECT doc_id, unnest(range(len(l))) AS ord, unnest(l) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL)"


@query(f"SELECT doc_id, CAST(ord AS BIGINT) AS line_ord FROM ({_LINES}) WHERE regexp_matches(regexp_replace(line, '^{WS}+', ''), '^#{{1,6}}\\s')")
def heading_lines(spark, d):
    """Markdown headings of all documents."""
    x = table(spark, d, "documents").where("text is not null").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_ord", "line"))
    return x.where(T.is_heading(F.concat(F.col("line"), F.lit("\n|")))).select("doc_id", F.col("line_ord").cast("long").alias("line_ord"))


@query(
    f"""WITH x AS (SELECT doc_id, regexp_replace(regexp_replace(line, '^{WS}+', ''), '{WS}+$', '') AS line FROM ({_LINES})),
    y AS (SELECT doc_id, line, CASE WHEN regexp_matches(line, '(?i)^(?:chapter|part)\\s+(\\d+|[ivxlc]+)[:.\\s]*(.*)') THEN 1
        WHEN regexp_matches(line, '^(\\d+(?:\\.\\d+)*)[:.]\\s+(.+)') THEN 2
        WHEN upper(line) = line AND regexp_matches(line, '\\p{{Lu}}') AND len(list_filter(regexp_split_to_array(line, '\\s+'), lambda w: w <> '')) BETWEEN 2 AND 8 AND length(line) > 8 AND NOT regexp_matches(line, '^(HTTP|URL|API|SQL|HTML|\\[)') THEN 3 END AS rule,
        regexp_extract(line, '^(\\d+(?:\\.\\d+)*)[:.]\\s+(.+)', 1) AS num, trim(regexp_extract(line, '^(\\d+(?:\\.\\d+)*)[:.]\\s+(.+)', 2)) AS name
      FROM x WHERE length(line) BETWEEN 3 AND 200 AND NOT regexp_matches(line, '^\\[.+\\]\\.?$'))
    SELECT doc_id, CAST(CASE WHEN rule = 2 THEN length(num) - length(replace(num, '.', '')) + 1 ELSE 1 END AS BIGINT) AS level, count(*) AS n FROM y
    WHERE rule IS NOT NULL AND (rule <> 2 OR (length(num) - length(replace(num, '.', '')) + 1 <= 3 AND NOT (length(name) > 80 OR regexp_matches(name, '^\\p{{Ll}}') OR regexp_matches(name, '[.,;]$'))))
    GROUP BY 1, 2"""
)
def detect_headings(spark, d):
    """Headings found in documents, by level."""
    x = trees.headings(table(spark, d, "documents").where("text is not null").select("doc_id", "text"), ["doc_id"], "text")
    return x.groupBy("doc_id", F.col("level").cast("long").alias("level")).agg(F.count("*").alias("n"))


@query(
    """WITH RECURSIVE p AS (SELECT doc_id, unnest(range(len(l))) AS i, unnest(l) AS line FROM (SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x)), lambda x: x <> '') AS l FROM documents WHERE text IS NOT NULL AND NOT contains(text, '```'))),
    w AS (SELECT doc_id, i, line, len(list_filter(regexp_split_to_array(line, '\\s+'), lambda x: x <> '')) AS n, regexp_matches(line, '^#{1,6}\\s') AS h FROM p),
    total AS (SELECT doc_id, sum(n) AS total, max(i) AS last FROM w GROUP BY 1),
    f AS (SELECT w.doc_id, w.i, w.n AS tokens, h AND n <= 150 AS heading, n > 150 AS closed, CAST(0 AS BIGINT) AS id, CASE WHEN n > 150 THEN 0 ELSE n END AS run FROM w WHERE i = 0
      UNION ALL
      SELECT w.doc_id, w.i, w.n, w.h AND w.n <= 150, w.n > 150,
        CASE WHEN f.closed OR w.n > 150 OR (f.run + w.n > 150 AND f.run >= 20 AND NOT f.heading) THEN f.id + 1 ELSE f.id END,
        CASE WHEN w.n > 150 THEN 0 WHEN f.closed OR (f.run + w.n > 150 AND f.run >= 20 AND NOT f.heading) THEN w.n ELSE f.run + w.n END
      FROM f JOIN w ON w.doc_id = f.doc_id AND w.i = f.i + 1),
    e AS (SELECT f.doc_id, f.id AS top, f.run AS left_over, f.closed FROM f JOIN total t ON t.doc_id = f.doc_id AND t.last = f.i),
    g AS (SELECT f.doc_id, CASE WHEN NOT e.closed AND e.left_over < 20 AND e.top > 0 AND f.id = e.top THEN f.id - 1 ELSE f.id END AS chunk, f.tokens FROM f JOIN e USING (doc_id) JOIN total t USING (doc_id) WHERE t.total > 150
      UNION ALL SELECT doc_id, 0, total FROM total WHERE total <= 150 AND total > 0)
    SELECT doc_id, CAST(chunk AS BIGINT) AS chunk_index, CAST(sum(tokens) AS BIGINT) AS token_count FROM g GROUP BY 1, 2"""
)
def chunk_small_budget(spark, d):
    """Documents without fences packed by line into chunks of 150 words at most and 20 at least."""
    x = table(spark, d, "documents").where("text is not null and not contains(text, '```')")
    lines = F.filter(F.transform(F.split("text", "\n"), F.trim), lambda v: v != "")
    x = x.select("doc_id", F.array_join(lines, "\n\n").alias("text"))
    return chunking.pack(x, "text", 150, 20).select("doc_id", F.col("chunk_index").cast("long").alias("chunk_index"), "token_count")


@query(
    """WITH w AS (SELECT DISTINCT section_id, list_filter(regexp_split_to_array(content, '\\s+'), lambda x: x <> '') AS w FROM extracted WHERE content IS NOT NULL),
    p AS (SELECT section_id, w, unnest(range(CAST((len(w) + 99) // 100 AS BIGINT))) AS p FROM w)
    SELECT section_id, CAST(p + 1 AS BIGINT) AS page, md5(array_to_string(w[p * 100 + 1 : p * 100 + 100], ' ')) AS text_md5 FROM p"""
)
def synthetic_pages(spark, d):
    """Sections as pages of 100 words."""
    x = table(spark, d, "extracted").where("content is not null").select("section_id", "content").dropDuplicates(["section_id"])
    return chunking.synthetic_pages(x, "section_id", "content", 100).select("section_id", F.col("page").cast("long").alias("page"), F.md5("text").alias("text_md5"))


@query(
    """WITH w AS (SELECT DISTINCT section_id, list_filter(regexp_split_to_array(content, '\\s+'), lambda x: x <> '') AS w FROM extracted WHERE content IS NOT NULL),
    p AS (SELECT section_id, w, unnest(range(CAST((len(w) + 99) // 100 AS BIGINT))) AS p FROM w),
    t AS (SELECT section_id, p + 1 AS page, array_to_string(w[p * 100 + 1 : p * 100 + 100], ' ') AS text FROM p),
    r AS (SELECT section_id, a, a + 1 AS b FROM (SELECT section_id, unnest(range(1, max(page) + 1, 2)) AS a FROM t GROUP BY 1))
    SELECT r.section_id, CAST(a AS BIGINT) AS page_start, CAST(b AS BIGINT) AS page_end, md5(coalesce(string_agg(text, chr(10) || chr(10) ORDER BY page), '')) AS text_md5
    FROM r LEFT JOIN t ON t.section_id = r.section_id AND t.page BETWEEN a AND b GROUP BY ALL"""
)
def page_range_text(spark, d):
    """Text of every two pages of every section, to the last."""
    x = table(spark, d, "extracted").where("content is not null").select("section_id", "content").dropDuplicates(["section_id"])
    pages = chunking.synthetic_pages(x, "section_id", "content", 100).select("section_id", F.col("page").cast("long").alias("page"), "text")
    last = pages.groupBy("section_id").agg(F.max("page").alias("last"))
    r = last.select("section_id", F.explode(F.sequence(F.lit(1).cast("long"), "last", F.lit(2).cast("long"))).alias("page_start")).withColumn("page_end", F.col("page_start") + 1)
    return chunking.text_of_pages(r, pages, "section_id").select("section_id", "page_start", "page_end", F.md5("text").alias("text_md5"))


def _parts_sql(hashes: int) -> str:
    """Headings of documents and what stands before the first and after each."""
    p = f"(?m)^#{{1,{hashes}}}\\s+.+$"
    return f"""m AS (SELECT doc_id, text, regexp_extract_all(text, '{p}') AS h, regexp_split_to_array(text, '{p}') AS s FROM documents WHERE text IS NOT NULL),
    u AS (SELECT doc_id, i, h[i] AS head, {STRIP('s[i + 1]')} AS content FROM (SELECT doc_id, h, s, unnest(range(len(h) + 1)) AS i FROM m WHERE len(h) > 0)),
    headed AS (SELECT doc_id, i, CASE WHEN i = 0 THEN NULL ELSE {STRIP("regexp_extract(head, '(?m)^#+\\s+(.+)$', 1)")} END AS title, CASE WHEN i = 0 THEN 0 ELSE length(regexp_extract(head, '^#+')) - 1 END AS depth, content FROM u WHERE i > 0 OR content <> '')"""


def STRIP(c: str) -> str:
    return f"regexp_replace(regexp_replace({c}, '^{WS}+', ''), '{WS}+$', '')"


@query(
    f"""WITH {_parts_sql(3)}, p AS (SELECT doc_id, text, list_filter(list_transform(string_split(text, chr(10) || chr(10)), lambda x: {STRIP('x')}), lambda x: x <> '') AS p FROM m WHERE len(h) = 0),
    rows_ AS (SELECT doc_id, i, coalesce(title, 'Introduction') AS title, depth, content FROM headed
      UNION ALL SELECT doc_id, 0, 'Introduction', 0, {STRIP('text')} FROM p WHERE len(p) <= 3
      UNION ALL SELECT doc_id, i, left(split_part(f[1], chr(10), 1), 80), 0, array_to_string(f, chr(10) || chr(10)) FROM (SELECT doc_id, i, p[i * 5 + 1 : i * 5 + 5] AS f FROM (SELECT doc_id, p, unnest(range(CAST((len(p) + 4) // 5 AS BIGINT))) AS i FROM p WHERE len(p) > 3)))
    SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS BIGINT) AS section_ord, title, CAST(depth AS BIGINT) AS depth, md5(content) AS content_md5 FROM rows_"""
)
def markdown_sections(spark, d):
    """Documents parted at their headings."""
    x = table(spark, d, "documents").select("doc_id", "text", F.lit("Introduction").alias("fallback"))
    return chunking.markdown_sections(x, "doc_id", "text", "fallback").select("doc_id", F.col("section_ord").cast("long").alias("section_ord"), "title", F.col("depth").cast("long").alias("depth"), F.md5("content").alias("content_md5"))


@query(
    f"""WITH {_parts_sql(6)}, rows_ AS (SELECT doc_id, i, coalesce(title, 'Introduction') AS title, depth, content FROM headed UNION ALL SELECT doc_id, 0, 'Content', 0, {STRIP('text')} FROM m WHERE len(h) = 0)
    SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS BIGINT) AS section_ord, title, CAST(depth + doc_id % 3 AS BIGINT) AS depth, md5(content) AS content_md5 FROM rows_"""
)
def export_sections(spark, d):
    """Documents parted at headings of all six levels, as pages of a workspace's export at three depths."""
    x = table(spark, d, "documents").select("doc_id", "text", (F.col("doc_id") % 3).cast("int").alias("base"))
    return chunking.export_sections(x, "doc_id", "text", "base").select("doc_id", F.col("section_ord").cast("long").alias("section_ord"), "title", F.col("depth").cast("long").alias("depth"), F.md5("content").alias("content_md5"))


def _case(pairs: list[tuple[str, list[str]]]) -> str:
    return "CASE " + " ".join(f"WHEN {' OR '.join(f'contains(t, {listed([w])})' for w in ws)} THEN '{lv}'" for lv, ws in pairs) + " ELSE 'understand' END"


_CONCEPT = "regexp_replace(title, '\\?+$', '')"
for _p in T.QUESTION_OPENINGS:
    _CONCEPT = f"regexp_replace({_CONCEPT}, '{_p.replace(chr(39), chr(39) * 2)}', '')"


@query(f"SELECT title, {_case(T.LEVEL_WORDS)} AS level, trim({_CONCEPT}) AS concept FROM (SELECT DISTINCT title, lower(title) AS t FROM structure WHERE title IS NOT NULL)")
def classify_topics(spark, d):
    """Level and concept of every root topic's title."""
    x = table(spark, d, "structure").where("title is not null").select("title").distinct()
    return x.select("title", T.topic_level(F.col("title")).alias("level"), F.trim(T.concept(F.col("title"))).alias("concept"))


_PARENT_LIST = ", ".join(f"CASE WHEN {'true' if not ls else f'level IN ({listed(list(ls))})'} THEN {{'t': replace('{t}', '{{}}', concept), 'b': '{b}'}} END" for t, b, ls in T.PARENT_OBJECTIVES)
_LEAF_CASE = " ".join(f"WHEN '{lv}' THEN [" + ", ".join(f"{{'t': replace('{t}', '{{}}', concept), 'b': '{b}'}}" for t, b in ts) + "]" for lv, ts in T.LEAF_OBJECTIVES.items())


@query(
    f"""WITH x AS (SELECT title, p, {_case(T.LEVEL_WORDS)} AS level, trim({_CONCEPT}) AS concept FROM (SELECT DISTINCT title, lower(title) AS t, unnest([true, false]) AS p FROM structure WHERE title IS NOT NULL)),
    y AS (SELECT title, p, CASE WHEN p THEN list_filter([{_PARENT_LIST}], lambda o: o IS NOT NULL) ELSE CASE level {_LEAF_CASE} END END AS os FROM x)
    SELECT title, p AS has_children, CAST(i AS BIGINT) AS sort_order, os[i + 1].t AS text, os[i + 1].b AS bloom_level FROM (SELECT title, p, os, unnest(range(len(os))) AS i FROM y)"""
)
def topic_objectives(spark, d):
    """Objectives of every root title, as a parent and as a leaf."""
    x = table(spark, d, "structure").where("title is not null").select("title").distinct().select("title", F.explode(F.array(F.lit(True), F.lit(False))).alias("has_children"))
    x = x.select("title", "has_children", F.posexplode(T.objectives(F.col("title"), F.col("has_children"))).alias("i", "o"))
    return x.select("title", "has_children", F.col("i").cast("long").alias("sort_order"), "o.text", "o.bloom_level")


@query(
    """SELECT DISTINCT source_path, p AS path, CASE WHEN p = '' OR p = '/' THEN '/' WHEN right(p, 1) = '/' THEN p ELSE regexp_replace(p, '([^/])\\.[^./]*$', '\\1') END AS prefix
    FROM (SELECT source_path, regexp_extract(source_path, '^https?://[^/?#]*([^?#]*)', 1) AS p FROM extracted WHERE regexp_matches(source_path, '^https?://'))"""
)
def path_prefixes(spark, d):
    """Scope of a crawl from every web source."""
    x = table(spark, d, "extracted").where("source_path rlike '^https?://'").select("source_path").distinct().withColumn("path", T.url_path(F.col("source_path")))
    return x.select("source_path", "path", T.path_prefix(F.col("path")).alias("prefix"))


@query("SELECT DISTINCT event_id, CAST(floor(value) AS BIGINT) AS s, CASE WHEN floor(value) >= 3600 THEN printf('%02d:%02d:%02d', CAST(floor(value) AS BIGINT) // 3600, CAST(floor(value) AS BIGINT) % 3600 // 60, CAST(floor(value) AS BIGINT) % 60) ELSE printf('%02d:%02d', CAST(floor(value) AS BIGINT) // 60, CAST(floor(value) AS BIGINT) % 60) END AS clock FROM events WHERE value >= 0")
def clock_times(spark, d):
    """Numbers as times."""
    return table(spark, d, "events").where("value >= 0").select("event_id", F.floor("value").cast("long").alias("s"), T.clock(F.col("value")).alias("clock")).distinct()


@query("SELECT DISTINCT chunk_id, length(replace(content, chr(0), '')) AS n, json_extract_string(to_json({'page': page_number, 'has_code': has_code}), '$.page') AS page FROM chunks WHERE content IS NOT NULL")
def null_sanitize(spark, d):
    """Contents without NUL characters and metadata as JSON."""
    x = table(spark, d, "chunks").where("content is not null").select("chunk_id", F.length(T.without_nul(F.col("content"))).cast("long").alias("n"), F.to_json(F.struct(F.col("page_number").alias("page"), "has_code")).alias("j"))
    return x.select("chunk_id", "n", F.get_json_object("j", "$.page").alias("page")).distinct()


@query(
    """SELECT chunk_id, array_to_string(list_transform(range(len(topic_path)), lambda i: CASE i % 4 WHEN 0 THEN '**' || topic_path[i + 1] || '**' WHEN 1 THEN '[`' || topic_path[i + 1] || '`](http://x)' WHEN 2 THEN '*' || topic_path[i + 1] || '*' ELSE '~~' || topic_path[i + 1] || '~~' END), '') AS md
    FROM (SELECT DISTINCT chunk_id, list_filter(topic_path, lambda x: x IS NOT NULL) AS topic_path FROM chunks WHERE len(topic_path) > 0)"""
)
def rich_text_markdown(spark, d):
    """Topic paths as rich text with changing marks, in markdown."""
    x = table(spark, d, "chunks").where("size(topic_path) > 0").select("chunk_id", F.filter("topic_path", lambda t: t.isNotNull()).alias("p")).distinct()
    part = lambda t, i: F.struct(
        t.alias("plain_text"), F.struct((i % 4 == 1).alias("code"), (i % 4 == 0).alias("bold"), (i % 4 == 2).alias("italic"), (i % 4 == 3).alias("strikethrough")).alias("annotations"), F.when(i % 4 == 1, "http://x").alias("href")
    )
    return x.select("chunk_id", T.rich_text(F.transform("p", part)).alias("md"))


@query(
    """WITH h AS (SELECT DISTINCT section_id, md5(coalesce(title, '')) AS h FROM extracted)
    SELECT section_id, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4) || '-' || substr(h, 21) AS id FROM h"""
)
def workspace_ids(spark, d):
    """Ids with dashes from links with 32 digits."""
    x = table(spark, d, "extracted").select("section_id", F.concat(F.lit("https://www.notion.so/Page-"), F.md5(F.coalesce("title", F.lit("")))).alias("u")).distinct()
    return x.select("section_id", T.workspace_id(F.col("u")).alias("id"))


_TITLED = "array_to_string(list_transform(range(1, length({0}) + 1), lambda i: CASE WHEN i > 1 AND regexp_matches(substr({0}, i - 1, 1), '^\\p{{L}}$') THEN lower(substr({0}, i, 1)) ELSE upper(substr({0}, i, 1)) END), '')"


@query(
    f"""WITH x AS (SELECT DISTINCT source_path, regexp_extract(source_path, '^https?://[^/?#]*([^?#]*)', 1) AS p, title FROM extracted WHERE source_path IS NOT NULL AND title IS NOT NULL), y AS (SELECT *, replace(replace(regexp_extract(p, '([^/]*)$', 1), '-', ' '), '.html', '') AS s FROM x)
    SELECT source_path, title, {_TITLED.format('s')} AS slug_title, {_TITLED.format('title')} AS title_case, replace(lower(title), ' ', '-') AS slug FROM y"""
)
def slugs(spark, d):
    """Titles from addresses, titles with capitals, and slugs."""
    x = table(spark, d, "extracted").where("source_path is not null and title is not null").select("source_path", "title").distinct()
    return x.select("source_path", "title", T.slug_title(T.url_path(F.col("source_path"))).alias("slug_title"), T.title_case(F.col("title")).alias("title_case"), T.slug(F.col("title")).alias("slug"))


@query(
    """WITH i AS (SELECT DISTINCT i.local_path AS path FROM (SELECT unnest(images) AS i FROM extracted) WHERE i.local_path IS NOT NULL), e AS (SELECT path, lower(regexp_extract(path, '(\\.[^./]+)$', 1)) AS ext FROM i)
    SELECT path, 'image/' || CASE regexp_replace(ext, '^\\.', '') WHEN 'jpg' THEN 'jpeg' ELSE regexp_replace(ext, '^\\.', '') END AS mime FROM e"""
)
def mime_types(spark, d):
    """Types of images by their paths."""
    x = table(spark, d, "extracted").select(F.explode("images").alias("i")).select(F.col("i.local_path").alias("path")).where("path is not null").distinct()
    return x.select("path", T.mime_type(F.regexp_extract("path", r"(\.[^./]+)$", 1)).alias("mime"))


_KINDS = ["paragraph", "quote", "callout", "heading_1", "heading_2", "heading_3", "bulleted_list_item", "numbered_list_item", "to_do", "code", "divider", "toggle", "table_row", "image", "unknown"]


@query(
    f"""WITH b AS (SELECT DISTINCT section_id, title AS t, {_KINDS}[CAST(section_id % {len(_KINDS)} AS INT) + 1] AS kind FROM extracted WHERE title IS NOT NULL)
    SELECT section_id, CASE kind WHEN 'paragraph' THEN t WHEN 'quote' THEN '> ' || replace(t, chr(10), chr(10) || '> ') WHEN 'callout' THEN '> ! ' || t WHEN 'heading_1' THEN '# ' || t WHEN 'heading_2' THEN '## ' || t WHEN 'heading_3' THEN '### ' || t WHEN 'bulleted_list_item' THEN '- ' || t WHEN 'numbered_list_item' THEN '1. ' || t
      WHEN 'to_do' THEN '- [' || CASE WHEN section_id % 2 = 0 THEN 'x' ELSE ' ' END || '] ' || t WHEN 'code' THEN '```py' || chr(10) || t || chr(10) || '```' WHEN 'divider' THEN '---' WHEN 'toggle' THEN '<details><summary>' || t || '</summary></details>' WHEN 'table_row' THEN '| ' || t || ' |' WHEN 'image' THEN '![' || t || '](u.png)' ELSE '' END AS md FROM b"""
)
def block_markdown(spark, d):
    """Blocks of all kinds in markdown."""
    x = table(spark, d, "extracted").where("title is not null").select("section_id", "title").distinct()
    kind = F.get(F.array(*[F.lit(k) for k in _KINDS]), (F.col("section_id") % len(_KINDS)).cast("int"))
    return x.select("section_id", T.block_markdown(kind, F.col("title"), F.col("section_id") % 2 == 0, F.lit("py"), F.lit("!"), F.lit("u.png")).alias("md"))


@query(
    """WITH x AS (SELECT DISTINCT section_id, title AS t FROM extracted WHERE title IS NOT NULL AND NOT regexp_matches(title, '[\\[\\]()]'))
    SELECT section_id, 'a [IMAGE: in folder] ' || t || ' [IMAGE: by path] [IMAGE: by name] ![' || t || '](no.png) end' AS text FROM x"""
)
def image_placeholders(spark, d):
    """Markdown images as marks, found below the page's folder, by path and by name; unknown ones stay."""
    from lexaloom.sources.connectors import image_placeholders as placed

    x = table(spark, d, "extracted").where("title is not null and not title rlike '[\\\\[\\\\]()]'").select("section_id", "title").distinct()
    ids = F.create_map(*[F.lit(v) for v in ("docs/a.png", "in folder", "p/b.png", "by path", "c.png", "by name")])
    text = F.concat(F.lit("a ![x](a.png) "), "title", F.lit(" ![y](p/b.png) ![z](other/c.png) !["), "title", F.lit("](no.png) end"))
    return x.select("section_id", placed(text, ids, F.lit("docs")).alias("text"))


def queries():
    return Q


def oracle_sql():
    return SQL
