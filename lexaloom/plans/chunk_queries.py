"""Queries of chunking and of the bridge from topics to chunks, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexaloom.functions import text as T
from lexaloom.operators import bridge, chunking, nested
from lexaloom.session import cut
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


# ---- SQL of paragraphs and packing -----------------------------------------------

_WS = r"[\s\x{0B}\x{A0}]"


def stripped_sql(c: str) -> str:
    return f"regexp_replace(regexp_replace({c}, '^{_WS}+', ''), '{_WS}+$', '')"


def words_sql(c: str) -> str:
    return f"len(list_filter(regexp_split_to_array({c}, '\\s+'), lambda x: x <> ''))"


def code_sql(c: str) -> str:
    """Whether a text looks like code."""
    starts = "|".join(x.replace("{", r"\{").replace("}", r"\}").replace("*", r"\*") for x in T.CODE_STARTS)
    lines = f"string_split({stripped_sql(c)}, chr(10))"
    score = f"CASE WHEN regexp_matches(regexp_replace(x, '^{_WS}+', ''), '^({starts})') THEN 2 WHEN regexp_matches(x, '^\\s{{2,}}') AND regexp_replace(x, '{_WS}+', '', 'g') <> '' THEN 1 ELSE 0 END"
    return f"(len({lines}) >= 2 AND list_sum(list_transform({lines}, lambda x: {score})) * 10 > len({lines}) * 6)"


def packed_sql(source: str, keys: list[str], most: int, least: int, forced: str = "false", name: str = "packed") -> str:
    """CTEs that pack ``source`` (keys, text, ...) into ``name`` (keys, chunk_index, content, token_count, has_code); ``forced``: a condition on a paragraph p and the row t."""
    k, on = ", ".join(keys), lambda a, b: " AND ".join(f"{a}.{x} = {b}.{x}" for x in keys)
    s, sl = name, stripped_sql("line")
    return f"""{s}_s AS (SELECT *, {words_sql('text')} AS total FROM {source} WHERE text IS NOT NULL AND {stripped_sql('text')} <> ''),
    {s}_l AS (SELECT {k}, unnest(range(len(x))) AS i, unnest(x) AS line FROM (SELECT {k}, string_split(text, chr(10)) AS x FROM {s}_s WHERE total > {most})),
    {s}_f AS (SELECT *, {sl} = '' AS blank, starts_with({sl}, '```') AS fence FROM {s}_l),
    {s}_o AS (SELECT *, coalesce(sum(CAST(fence AS INT)) OVER (PARTITION BY {k} ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) % 2 = 1 AS inside FROM {s}_f),
    {s}_g AS (SELECT *, sum(CASE WHEN NOT inside AND (fence OR blank) THEN 1 ELSE 0 END) OVER (PARTITION BY {k} ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS grp FROM {s}_o),
    {s}_q AS (SELECT {k}, grp, string_agg(CASE WHEN NOT inside AND blank THEN '' ELSE line END, chr(10) ORDER BY i) AS p FROM {s}_g GROUP BY {k}, grp),
    {s}_p AS (SELECT {k}, row_number() OVER (PARTITION BY {k} ORDER BY grp) - 1 AS i, p FROM (SELECT {k}, grp, {stripped_sql('p')} AS p FROM {s}_q) WHERE p <> ''),
    {s}_w AS (SELECT {', '.join(f'w.{x}' for x in keys)}, w.i, w.p, {words_sql('w.p')} AS n, regexp_matches(w.p, '^#{{1,6}}\\s') AS h, {code_sql('w.p')} OR starts_with(w.p, '```') AS code, coalesce({forced}, false) AS forced FROM {s}_p w JOIN {s}_s t ON {on('w', 't')}),
    {s}_r AS (SELECT {k}, i, CASE WHEN n > {most} THEN 0 ELSE n END AS run, CASE WHEN n > {most} THEN 0 ELSE 1 END AS parts, h AND n <= {most} AS heading, n > {most} AS closed, CAST(0 AS BIGINT) AS id FROM {s}_w WHERE i = 0
      UNION ALL
      SELECT {', '.join(f'w.{x}' for x in keys)}, w.i, CASE WHEN w.n > {most} THEN 0 WHEN new THEN w.n ELSE f_run + w.n END, CASE WHEN w.n > {most} THEN 0 ELSE 1 END, w.h AND w.n <= {most}, w.n > {most}, CASE WHEN new THEN f_id + 1 ELSE f_id END
      FROM (SELECT w.*, f.run AS f_run, f.id AS f_id, f.closed OR (f.parts > 0 AND ((w.forced AND w.h) OR w.n > {most} OR (f.run + w.n > {most} AND f.run >= {least} AND NOT f.heading))) AS new FROM {s}_r f JOIN {s}_w w ON {on('w', 'f')} AND w.i = f.i + 1) w),
    {s}_e AS (SELECT {k}, arg_max(id, i) AS top, arg_max(run, i) AS rest, arg_max(parts, i) AS parts FROM {s}_r GROUP BY {k}),
    {s}_c AS (SELECT {', '.join(f'r.{x}' for x in keys)}, CASE WHEN e.parts > 0 AND e.rest < {least} AND e.top > 0 AND r.id = e.top THEN r.id - 1 ELSE r.id END AS chunk_index, w.i, w.p, w.n, w.code FROM {s}_r r JOIN {s}_e e ON {on('r', 'e')} JOIN {s}_w w ON {on('w', 'r')} AND w.i = r.i),
    {name} AS (SELECT {k}, chunk_index, string_agg(p, chr(10) || chr(10) ORDER BY i) AS content, CAST(sum(n) AS BIGINT) AS token_count, bool_or(code) AS has_code FROM {s}_c GROUP BY {k}, chunk_index
      UNION ALL SELECT {k}, CAST(0 AS BIGINT), {stripped_sql('text')}, CAST(total AS BIGINT), {code_sql('text')} OR contains(text, '```') FROM {s}_s WHERE total <= {most})"""


@query(f"WITH RECURSIVE {packed_sql('(SELECT doc_id, text FROM documents)', ['doc_id'], 1500, 200)} SELECT doc_id, chunk_index, token_count, has_code, md5(content) AS content_md5 FROM packed")
def chunk_documents(spark, d):
    """Documents packed into chunks of 1500 words at most."""
    x = table(spark, d, "documents").select("doc_id", "text")
    return chunking.pack(x, "text").select("doc_id", F.col("chunk_index").cast("long").alias("chunk_index"), "token_count", "has_code", F.md5("content").alias("content_md5"))


@query(
    f"""WITH RECURSIVE x AS (SELECT doc_id, text, list_transform(list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '^#+\\s')), lambda l: {stripped_sql("regexp_replace(l, '^#+', '')")}) AS names FROM documents),
    {packed_sql('x', ['doc_id'], 120, 30, "list_contains(list_transform(t.names, lambda n: lower(n)), regexp_replace(lower(w.p), '^#+\\s*', ''))")}
    SELECT doc_id, chunk_index, token_count, has_code, md5(content) AS content_md5 FROM packed"""
)
def chunk_before_headings(spark, d):
    """Documents, fences and all, packed into chunks of 120 words at most, with a chunk ended before each heading."""
    x = table(spark, d, "documents").select("doc_id", "text")
    heads = F.transform(F.filter(F.split("text", "\n"), lambda line: line.rlike(r"^#+\s")), lambda line: T.stripped(F.regexp_replace(line, "^#+", "")))
    x = x.withColumn("names", heads)
    return chunking.pack(x, "text", 120, 30, split_before="names").select("doc_id", F.col("chunk_index").cast("long").alias("chunk_index"), "token_count", "has_code", F.md5("content").alias("content_md5"))


# ---- trees of topics ---------------------------------------------------------------

SHAPE = nested.Shape(lists=(("section", "source_sections"), ("split", "split_after_headings")))


def _entries(c: str) -> str:
    """Entries of a JSON list: of an array, of the list in {"topics": ...}, or the lone element."""
    one = lambda x, e: f"CASE json_type({x}) WHEN 'ARRAY' THEN CAST({x} AS JSON[]) WHEN 'NULL' THEN CAST([] AS JSON[]) WHEN 'OBJECT' THEN {e} ELSE [{x}] END"
    inner = f"json_extract({c}, '$.topics')"
    return f"CASE WHEN {c} IS NULL THEN CAST([] AS JSON[]) ELSE {one(c, f'CASE WHEN json_exists({c}, {chr(39)}$.topics{chr(39)}) THEN ' + one(inner, f'[{inner}]') + f' ELSE [{c}] END')} END"


def _scalar(c: str) -> str:
    return f"CASE json_type({c}) WHEN 'VARCHAR' THEN {c} ->> '$' WHEN 'OBJECT' THEN NULL WHEN 'ARRAY' THEN NULL WHEN 'NULL' THEN NULL ELSE CAST({c} AS VARCHAR) END"


def _items(kind: str, key: str) -> str:
    return f"""SELECT structure_id, '{kind}' AS kind, '0' AS path, p AS position, s AS item FROM (SELECT structure_id, unnest(range(len({key}))) AS p, unnest({key}) AS s FROM s0) WHERE {stripped_sql('s')} <> ''
      UNION ALL SELECT structure_id, '{kind}', path, p, s FROM (SELECT structure_id, path, p, {_scalar('e')} AS s FROM (SELECT structure_id, path, unnest(range(len(l))) AS p, unnest(l) AS e FROM (SELECT structure_id, path, {_entries(f"json_extract(c, '$.{key}')")} AS l FROM nodes WHERE path <> '0'))) WHERE {stripped_sql('s')} <> ''"""


TREE = f"""s0 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY structure_id ORDER BY saved_at DESC NULLS LAST, curriculum_id DESC, title DESC NULLS LAST, source_sections DESC NULLS LAST, children DESC NULLS LAST) AS r FROM structure WHERE structure_id IS NOT NULL) WHERE r = 1),
    nodes AS (SELECT structure_id, curriculum_id, '0' AS path, CAST(NULL AS VARCHAR) AS parent_path, CAST(0 AS BIGINT) AS position, title, [title] AS titles, [CAST(0 AS BIGINT)] AS place, CASE WHEN json_valid(children) THEN CAST(children AS JSON) END AS kids, CAST(NULL AS JSON) AS c FROM s0
      UNION ALL
      SELECT structure_id, curriculum_id, path || '.' || k, path, k, {_scalar("json_extract(e, '$.title')")}, list_append(titles, {_scalar("json_extract(e, '$.title')")}), list_append(place, k), json_extract(e, '$.children'), e
      FROM (SELECT structure_id, curriculum_id, path, titles, place, unnest(range(len(l))) AS k, unnest(l) AS e FROM (SELECT *, {_entries('kids')} AS l FROM nodes)) WHERE json_type(e) = 'OBJECT'),
    items AS ({_items('section', 'source_sections')} UNION ALL {_items('split', 'split_after_headings')})"""


def tree(spark: SparkSession, d: str) -> DataFrame:
    """All topics and their lists, flat, read once."""
    rows = latest(table(spark, d, "structure"), "structure_id", "saved_at", ["curriculum_id", "title", "source_sections", "children", "split_after_headings", "sort_order"])
    return cut(nested.flatten(rows, "structure_id", "curriculum_id", "title", "source_sections", "children", SHAPE, {"split": "split_after_headings"}))


def forest(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """(nodes, refs) of all trees: nodes structure_id, curriculum_id, place, titles, title, split_after; refs structure_id, place, ref_ord, name."""
    flat = tree(spark, d)
    place = F.transform(F.split("path", r"\."), lambda i: i.cast("int"))
    splits = flat.where("kind = 'split'").groupBy("key", "path").agg(F.array_sort(F.collect_list(F.struct("position", "title")))["title"].alias("split_after"))
    nodes = flat.where("kind = 'topic'").join(splits, ["key", "path"], "left")
    nodes = nodes.select(F.col("key").alias("structure_id"), F.col("grp").alias("curriculum_id"), place.alias("place"), "titles", "title", "split_after")
    refs = flat.where("kind = 'section'").select(F.col("key").alias("structure_id"), place.alias("place"), F.col("position").alias("ref_ord"), F.col("title").alias("name"))
    return nodes, refs


ORDER = ["file_ord", "section_ord", "section_id"]


def sections(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "extracted").where("section_id is not null").select("curriculum_id", *ORDER, "title", "content", F.col("source_path").alias("source"), "images").dropDuplicates(["curriculum_id", *ORDER])


_NORM = lambda c: stripped_sql(f"replace({c}, chr(160), ' ')")
#: Contents, sources and images by title, of equal titles the last; and what every name of a topic finds.
GATHER = f"""x AS (SELECT DISTINCT ON (curriculum_id, file_ord, section_ord, section_id) curriculum_id, file_ord, section_ord, section_id, {_NORM('title')} AS t, coalesce(content, '') AS content, coalesce(source_path, '') AS source, images FROM extracted WHERE coalesce(title, '') <> '' AND section_id IS NOT NULL),
    keyed AS (SELECT *, t AS k FROM x UNION ALL SELECT *, lower(t) FROM x WHERE lower(t) <> t),
    idx AS (SELECT curriculum_id, k, arg_max(content, o) AS content, arg_max(source, o) AS source FROM (SELECT *, (file_ord, section_ord, section_id) AS o FROM keyed) GROUP BY 1, 2),
    pix AS (SELECT curriculum_id, k, arg_max(images, o) AS images FROM (SELECT *, (file_ord, section_ord, section_id) AS o FROM keyed WHERE len(images) > 0) GROUP BY 1, 2),
    leaf AS (SELECT * FROM nodes n WHERE NOT EXISTS (SELECT 1 FROM nodes m WHERE m.structure_id = n.structure_id AND m.parent_path = n.path)),
    wanted AS (SELECT l.structure_id, l.path, l.curriculum_id, 0 AS own, i.position AS o, {_NORM('i.item')} AS k FROM leaf l JOIN items i ON i.structure_id = l.structure_id AND i.path = l.path AND i.kind = 'section'
      UNION ALL SELECT structure_id, path, curriculum_id, 1, 0, {_NORM('title')} FROM leaf WHERE title IS NOT NULL),
    hit AS (SELECT w.structure_id, w.path, w.own, w.o, coalesce(nullif(a.content, ''), nullif(b.content, '')) AS content, coalesce(nullif(a.source, ''), b.source, '') AS source, coalesce(p.images, q.images, []) AS images
      FROM wanted w LEFT JOIN idx a ON a.curriculum_id = w.curriculum_id AND a.k = w.k LEFT JOIN idx b ON b.curriculum_id = w.curriculum_id AND b.k = lower(w.k)
      LEFT JOIN pix p ON p.curriculum_id = w.curriculum_id AND p.k = w.k LEFT JOIN pix q ON q.curriculum_id = w.curriculum_id AND q.k = lower(w.k)),
    best AS (SELECT *, min(own) OVER (PARTITION BY structure_id, path) AS least FROM hit WHERE content IS NOT NULL),
    g AS (SELECT structure_id, path, string_agg(content, chr(10) || chr(10) ORDER BY o) AS text, coalesce(arg_min(source, o) FILTER (WHERE source <> ''), '') AS source, flatten(list(images ORDER BY o)) AS images FROM best WHERE own = least GROUP BY 1, 2),
    g2 AS (SELECT g.*, s.names FROM g LEFT JOIN (SELECT structure_id, path, list(lower({stripped_sql('item')})) AS names FROM items WHERE kind = 'split' GROUP BY 1, 2) s ON s.structure_id = g.structure_id AND s.path = g.path)"""


def _dotted(place: str):
    return F.array_join(F.transform(place, lambda i: i.cast("string")), ".")


@query(
    f"""WITH RECURSIVE {TREE}, {GATHER}, {packed_sql('g2', ['structure_id', 'path'], 1500, 200, "list_contains(t.names, regexp_replace(lower(w.p), '^#+\\s*', ''))")}
    SELECT p.structure_id, p.path, array_to_string(list_transform(n.titles, lambda t: coalesce(t, '?')), ' > ') AS topic_path, p.chunk_index, CAST(1 AS BIGINT) AS page_number, p.token_count, p.has_code, md5(p.content) AS content_md5, g.source,
      CASE WHEN p.chunk_index = 0 THEN array_to_string(list_transform(g.images, lambda i: i.id), ',') ELSE '' END AS image_ids
    FROM packed p JOIN nodes n ON n.structure_id = p.structure_id AND n.path = p.path JOIN g ON g.structure_id = p.structure_id AND g.path = p.path"""
)
def chunk_by_sections(spark, d):
    """Leaf topics with the content of the sections they name, packed into chunks; with their source, and images on the first chunk."""
    nodes, refs = forest(spark, d)
    out = bridge.chunk_by_sections(bridge.leaves_of(nodes, "structure_id", "place"), refs, sections(spark, d), "structure_id", "place", ["curriculum_id"], ORDER)
    path = F.array_join(F.transform("titles", lambda t: F.coalesce(t, F.lit("?"))), " > ")
    ids = F.array_join(F.transform(F.coalesce("images", F.array().cast(out.schema["images"].dataType)), lambda i: i["id"]), ",")
    return out.select("structure_id", _dotted("place").alias("path"), path.alias("topic_path"), *_long("chunk_index", "page_number", "token_count"), "has_code", F.md5("content").alias("content_md5"), "source", ids.alias("image_ids"))


def _long(*names: str):
    return [F.col(n).cast("long").alias(n) for n in names]


_SIZED = """sized AS (SELECT n.curriculum_id, n.structure_id, list_prepend(n.structure_id, n.place[2:]) AS place, n.title, n.titles, coalesce(nullif(a.n, 0), b.n, 0) AS tokens FROM nodes n
      LEFT JOIN widx a ON a.curriculum_id = n.curriculum_id AND a.k = {0} LEFT JOIN widx b ON b.curriculum_id = n.curriculum_id AND b.k = lower({0})),
    numbered AS (SELECT *, CASE WHEN tokens > 0 THEN greatest(1, tokens // 500) ELSE 0 END AS m FROM sized),
    started AS (SELECT *, CAST(coalesce(sum(m) OVER (PARTITION BY curriculum_id ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + 1 AS BIGINT) AS page_start FROM numbered),
    ended AS (SELECT *, CAST(greatest(page_start, page_start + m - 1) AS BIGINT) AS own_end FROM started),
    paged AS (SELECT a.*, (SELECT max(b.own_end) FROM ended b WHERE b.curriculum_id = a.curriculum_id AND b.place[1:len(a.place)] = a.place) AS page_end FROM ended a)""".format(_NORM("n.title"))
_WIDX = f"widx AS (SELECT curriculum_id, k, {words_sql('content')} AS n FROM idx)"


def _whole_trees(spark, d):
    """Nodes of whole curricula: the roots of one, in order of their ids, are siblings."""
    nodes, refs = forest(spark, d)
    whole = F.concat(F.array(F.col("structure_id")), F.transform(F.slice("place", F.lit(2), F.size("place")), lambda i: i.cast("long")))
    return nodes.withColumn("place", whole), refs.withColumn("place", whole)


@query(f"WITH RECURSIVE {TREE}, {GATHER}, {_WIDX}, {_SIZED} SELECT curriculum_id, array_to_string(place, '.') AS path, CAST(tokens AS BIGINT) AS tokens, page_start, page_end FROM paged")
def synthetic_page_tree(spark, d):
    """Topics of whole curricula with synthetic pages by the tokens of the sections of their titles, parents to the end of what stands below them."""
    nodes, _ = _whole_trees(spark, d)
    return bridge.page_tree(bridge.sized_topics(nodes, sections(spark, d), "curriculum_id", ORDER), "curriculum_id", "place", "tokens").select("curriculum_id", _dotted("place").alias("path"), *_long("tokens", "page_start", "page_end"))


_PAGES = f"""xs AS (SELECT DISTINCT ON (curriculum_id, file_ord, section_ord, section_id) curriculum_id, file_ord, section_ord, section_id, list_filter(regexp_split_to_array(content, '\\s+'), lambda x: x <> '') AS w FROM extracted WHERE content IS NOT NULL AND section_id IS NOT NULL),
    xn AS (SELECT *, coalesce(sum((len(w) + 383) // 384) OVER (PARTITION BY curriculum_id ORDER BY file_ord, section_ord, section_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM xs WHERE len(w) > 0),
    pages AS (SELECT curriculum_id, CAST(before + p + 1 AS BIGINT) AS page, array_to_string(w[p * 384 + 1 : p * 384 + 384], ' ') AS text FROM (SELECT *, unnest(range(CAST((len(w) + 383) // 384 AS BIGINT))) AS p FROM xn))"""


@query(f"WITH {_PAGES} SELECT curriculum_id, page, md5(text) AS text_md5 FROM pages")
def curriculum_pages(spark, d):
    """All sections of a curriculum as pages of 384 words, numbered on."""
    return bridge.section_pages(sections(spark, d), "curriculum_id", ORDER).select("curriculum_id", "page", F.md5("text").alias("text_md5"))


_BY_PAGES = f"""kids AS (SELECT curriculum_id, place[1:len(place) - 1] AS place, arg_min(page_start, place) AS kid FROM paged WHERE len(place) > 1 GROUP BY ALL),
    own AS (SELECT p.*, p.place[1:len(p.place) - 1] AS up, k.kid, CASE WHEN k.kid IS NULL THEN p.page_end ELSE k.kid - 1 END AS upto FROM paged p LEFT JOIN kids k ON k.curriculum_id = p.curriculum_id AND k.place = p.place),
    cut AS (SELECT *, count(*) FILTER (WHERE kid IS NULL) OVER (PARTITION BY curriculum_id, up, page_start, upto, kid IS NULL) AS same FROM own WHERE kid IS NULL OR upto >= page_start),
    txt AS (SELECT r.curriculum_id, r.page_start, r.upto, string_agg(g.text, chr(10) || chr(10) ORDER BY g.page) AS text FROM (SELECT DISTINCT curriculum_id, page_start, upto FROM cut) r JOIN pages g ON g.curriculum_id = r.curriculum_id AND g.page BETWEEN r.page_start AND r.upto GROUP BY ALL),
    full_ AS (SELECT c.*, t.text AS whole, coalesce(kid, -1) >= 0 AS inner_ FROM cut c JOIN txt t ON t.curriculum_id = c.curriculum_id AND t.page_start = c.page_start AND t.upto = c.upto WHERE {stripped_sql('t.text')} <> ''),
    lined AS (SELECT *, CASE WHEN same > 1 AND kid IS NULL AND {stripped_sql('title')} <> '' THEN list_position(list_transform(string_split(whole, chr(10)), lambda l: lower(regexp_replace({stripped_sql('l')}, '^[\\s\\d]{{0,6}}', ''))), lower({stripped_sql('title')})) END AS line FROM full_),
    at_ AS (SELECT *, CASE WHEN line > 0 THEN length(array_to_string(string_split(whole, chr(10))[1:line - 1], chr(10))) + CASE WHEN line > 1 THEN 1 ELSE 0 END END AS pos FROM lined),
    nx AS (SELECT *, lead(pos) OVER (PARTITION BY curriculum_id, up, page_start, upto, kid IS NULL ORDER BY pos NULLS LAST, place) AS nxt, min(pos) OVER (PARTITION BY curriculum_id, up, page_start, upto, kid IS NULL) AS first_,
      count(*) FILTER (WHERE pos IS NULL) OVER (PARTITION BY curriculum_id, up, page_start, upto, kid IS NULL) AS lost, row_number() OVER (PARTITION BY curriculum_id, up, page_start, upto, kid IS NULL ORDER BY place) AS nth FROM at_),
    parted AS (SELECT curriculum_id, array_to_string(place, '.') AS path, page_start, CASE WHEN kid IS NOT NULL OR same = 1 THEN whole WHEN pos IS NOT NULL THEN substr(whole, pos + 1, coalesce(nxt, length(whole)) - pos) WHEN first_ IS NULL AND nth = 1 THEN whole WHEN lost = 1 AND nth = 1 THEN substr(whole, 1, first_) ELSE '' END AS text FROM nx)"""


@query(f"WITH RECURSIVE {TREE}, {GATHER}, {_WIDX}, {_SIZED}, {_PAGES}, {_BY_PAGES}, {packed_sql('parted', ['curriculum_id', 'path', 'page_start'], 1500, 200)} SELECT curriculum_id, path, chunk_index, page_start AS page_number, token_count, has_code, md5(content) AS content_md5 FROM packed")
def chunk_by_topics(spark, d):
    """Whole curricula by synthetic pages: topics' own pages, leaves' pages, shared pages parted at titles."""
    nodes, _ = _whole_trees(spark, d)
    s = sections(spark, d)
    topics = bridge.page_tree(bridge.sized_topics(nodes, s, "curriculum_id", ORDER), "curriculum_id", "place", "tokens")
    out = bridge.chunk_by_topics(topics, bridge.section_pages(s, "curriculum_id", ORDER), "curriculum_id", "place")
    return out.select("curriculum_id", _dotted("place").alias("path"), *_long("chunk_index", "page_number", "token_count"), "has_code", F.md5("content").alias("content_md5"))


_NAMED = "named AS (SELECT DISTINCT n.curriculum_id FROM leaf n JOIN items i ON i.structure_id = n.structure_id AND i.path = n.path AND i.kind = 'section')"
_SPLIT = "list_contains(t.names, regexp_replace(lower(w.p), '^#+\\s*', ''))"
_G3 = "g3 AS (SELECT l.curriculum_id, array_to_string(list_prepend(l.structure_id, l.place[2:]), '.') AS path, g2.text, g2.names, g2.source FROM g2 JOIN leaf l ON l.structure_id = g2.structure_id AND l.path = g2.path WHERE l.curriculum_id IN (FROM named))"


@query(
    f"""WITH RECURSIVE {TREE}, {GATHER}, {_NAMED}, {_G3}, {packed_sql('g3', ['curriculum_id', 'path'], 1500, 200, _SPLIT, 'one')}, {_WIDX}, {_SIZED}, {_PAGES}, {_BY_PAGES}, p3 AS (SELECT * FROM parted WHERE curriculum_id NOT IN (FROM named)), {packed_sql('p3', ['curriculum_id', 'path', 'page_start'], 1500, 200, name='two')}
    SELECT one.curriculum_id, one.path, one.chunk_index, CAST(1 AS BIGINT) AS page_number, token_count, has_code, md5(content) AS content_md5, g3.source FROM one JOIN g3 ON g3.curriculum_id = one.curriculum_id AND g3.path = one.path
    UNION ALL SELECT curriculum_id, path, chunk_index, page_start, token_count, has_code, md5(content), '' FROM two"""
)
def bridge_chunks(spark, d):
    """Whole curricula: by the sections topics name where any leaf names some, else by pages."""
    nodes, refs = _whole_trees(spark, d)
    refs = refs.join(nodes.select("structure_id", "curriculum_id").distinct(), "structure_id").select("curriculum_id", "place", "ref_ord", "name")
    out = bridge.bridge(nodes.drop("structure_id"), refs, sections(spark, d), "curriculum_id", "place", ORDER)
    return out.select("curriculum_id", _dotted("place").alias("path"), *_long("chunk_index", "page_number", "token_count"), "has_code", F.md5("content").alias("content_md5"), "source")


@query(
    f"""WITH c AS (SELECT DISTINCT ON (chunk_id) chunk_id, curriculum_id, coalesce(topic_path[-1], '') AS title, content FROM chunks WHERE {stripped_sql("coalesce(content, '')")} <> '' ORDER BY chunk_id, chunked_at DESC NULLS LAST, content DESC),
    n AS (SELECT *, count(*) OVER (PARTITION BY curriculum_id, content) AS same FROM c),
    lined AS (SELECT *, CASE WHEN {stripped_sql('title')} <> '' THEN list_position(list_transform(string_split(content, chr(10)), lambda l: lower(regexp_replace({stripped_sql('l')}, '^[\\s\\d]{{0,6}}', ''))), lower({stripped_sql('title')})) END AS line FROM n WHERE same > 1),
    at_ AS (SELECT *, CASE WHEN line > 0 THEN length(array_to_string(string_split(content, chr(10))[1:line - 1], chr(10))) + CASE WHEN line > 1 THEN 1 ELSE 0 END END AS pos FROM lined),
    t AS (SELECT curriculum_id, content, title, any_value(pos) AS pos, max(chunk_id) AS o FROM at_ GROUP BY 1, 2, 3),
    f AS (SELECT *, lead(pos) OVER (PARTITION BY curriculum_id, content ORDER BY pos, o) AS nxt FROM t WHERE pos IS NOT NULL),
    l AS (SELECT curriculum_id, content, count(*) FILTER (WHERE pos IS NULL) AS lost, min(pos) AS first_, arg_min(title, chunk_id) AS lead_ FROM at_ GROUP BY 1, 2),
    p AS (SELECT n.chunk_id, n.content, CASE WHEN f.pos IS NOT NULL THEN substr(n.content, f.pos + 1, coalesce(f.nxt, length(n.content)) - f.pos) WHEN l.lost = 1 AND l.lead_ = n.title AND l.first_ IS NOT NULL AND f.pos IS NULL THEN substr(n.content, 1, l.first_) END AS part
      FROM n LEFT JOIN f ON n.same > 1 AND f.curriculum_id = n.curriculum_id AND f.content = n.content AND f.title = n.title LEFT JOIN l ON n.same > 1 AND l.curriculum_id = n.curriculum_id AND l.content = n.content)
    SELECT chunk_id, coalesce(nullif({stripped_sql('part')}, ''), content) <> content AS changed, md5(coalesce(nullif({stripped_sql('part')}, ''), content)) AS content_md5 FROM p"""
)
def parted_duplicates(spark, d):
    """Chunks of one curriculum with equal contents, parted at the lines that are their topics' titles."""
    c = latest(table(spark, d, "chunks").select("chunk_id", "chunked_at", "content", "curriculum_id", F.coalesce(F.try_element_at("topic_path", F.lit(-1)), F.lit("")).alias("title")), "chunk_id", "chunked_at", ["content", "curriculum_id", "title"])
    c = c.where(T.stripped(F.coalesce("content", F.lit(""))) != "").withColumn("token_count", F.lit(0).cast("long")).withColumn("has_code", F.lit(False)).withColumn("was", F.md5("content"))
    out = bridge.part_duplicates(c, ["curriculum_id"], "title", "chunk_id")
    return out.select("chunk_id", (F.md5("content") != F.col("was")).alias("changed"), F.md5("content").alias("content_md5"))


def queries():
    return Q


def oracle_sql():
    return SQL
