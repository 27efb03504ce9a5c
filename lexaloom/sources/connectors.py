"""Sources and sinks: extracted documents, tables, code trees, exports, pages and transcripts.

Live downloads, optical readers and speech need a network or models; here their
results come in as tables (pages, links, segments, regions).
"""

from __future__ import annotations

import io
import json
import re
import zipfile
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from lexaloom.functions.text import source_kind, stripped, word_count

IMAGE = "struct<id:string,local_path:string,alt_text:string,context:string>"
SECTION = f"struct<title:string,content:string,depth:int,metadata:map<string,string>,images:array<{IMAGE}>>"
EXTRACTED = f"source_type string, source_path string, title string, author string, sections array<{SECTION}>, metadata map<string,string>"
# What a walk over code passes over and takes.
SKIPPED = [
    ".git", ".svn", ".hg", "node_modules", "__pycache__", ".venv", "venv", "env", ".tox", ".mypy_cache", ".pytest_cache", "build", "dist", "target",
    ".next", ".nuxt", ".dart_tool", ".flutter-plugins", "vendor", "Pods",
]
TAKEN = [
    "py", "js", "ts", "jsx", "tsx", "java", "kt", "swift", "go", "rs", "c", "cpp", "h", "hpp", "cs", "rb", "php", "lua", "sh", "bash", "zsh", "sql",
    "r", "scala", "clj", "dart", "ex", "exs", "erl", "hs", "yaml", "yml", "toml", "json", "xml", "md", "txt", "rst", "adoc", "html", "css", "scss",
    "less", "proto", "graphql", "tf", "dockerfile", "conf", "ini", "cfg",
]
NAMED = ["Makefile", "Dockerfile", "Procfile", "Gemfile", "Rakefile", "Vagrantfile", ".gitignore", ".dockerignore"]
# Language of a fenced block by extension.
LANGUAGE = {
    "py": "python", "js": "javascript",
    "ts": "typescript", "jsx": "jsx", "tsx": "tsx",
    "java": "java", "kt": "kotlin", "swift": "swift",
    "go": "go", "rs": "rust",
    "c": "c", "cpp": "cpp", "h": "c", "hpp": "cpp",
    "cs": "csharp", "rb": "ruby", "php": "php",
    "dart": "dart", "sql": "sql", "sh": "bash",
    "yaml": "yaml", "yml": "yaml", "toml": "toml",
    "json": "json", "xml": "xml", "html": "html",
    "css": "css", "scss": "scss", "md": "markdown",
}
# Names of the file that introduces a tree of code, the first that is there counts.
README_NAMES = ["README.md", "README.rst", "README.txt", "README"]
MOST_BYTES = 100_000
LEAST_IMAGE = 2048

REGISTRY: dict[str, Callable[..., DataFrame]] = {}


def extractor(kind: str):
    """Registers a function as the extractor of a kind of source."""

    def add(f):
        REGISTRY[kind] = f
        return f

    return add


def dispatch(sources: DataFrame, source: str, inputs: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """What each kind's extractor makes of its input, for the kinds that ``sources`` has and ``inputs`` has a table for.

    ``inputs`` is by kind: what the readers of that kind gave. Sources of a kind
    without an extractor raise an error, as nothing could be done with them.
    """
    kinds = {r.kind for r in sources.select(source_kind(F.col(source)).alias("kind")).where("kind is not null").distinct().collect()}  # a row a kind: eight
    unknown = kinds - set(REGISTRY)
    if unknown:
        raise ValueError(f"no extractor for {sorted(unknown)}")
    return {k: REGISTRY[k](inputs[k]) for k in sorted(kinds & set(inputs))}


def read_extracted(spark: SparkSession, path: str) -> DataFrame:
    """Sections of a folder of extracted documents (JSON); (file_name, section_ord) gives their order. A source without a path goes by its file."""
    docs = spark.read.schema(EXTRACTED).option("multiLine", True).json(path)
    name = F.col("_metadata.file_name")
    x = docs.select(name.alias("file_name"), "source_type", F.coalesce("source_path", name).alias("source_path"), F.posexplode("sections").alias("section_ord", "s"))
    return x.select("file_name", "section_ord", "source_type", "source_path", "s.*")


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_variants(df: DataFrame, path: str) -> None:
    """A folder for each tier."""
    df.write.mode("overwrite").partitionBy("tier").parquet(path)


def read_rows(spark: SparkSession, path: str, sep: str | None = None) -> DataFrame:
    """Rows of CSV or TSV files with headers, all values text: (file_name, row_ord, ...), rows numbered from 0 within each file.

    Without ``sep`` a file's own is used: a tab for .tsv, else whichever of comma,
    semicolon, tab and bar is most frequent in its first line. Files are cut into
    splits; rows are counted a split, so they may be large.
    """
    if sep is None:
        first = spark.read.text(path).select(F.col("_metadata.file_name").alias("f"), F.col("_metadata.file_block_start").alias("b"), "value").where("b = 0").groupBy("f").agg(F.first("value").alias("v")).orderBy("f").first()
        marks = [",", ";", "\t", "|"]
        sep = "," if first is None else "\t" if first.f.endswith(".tsv") else max(marks, key=lambda m: (first.v.count(m), -marks.index(m)))
    raw = spark.read.option("header", True).option("sep", sep).option("multiLine", False).csv(path)
    x = raw.select("*", F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.file_block_start").alias("_b"), F.monotonically_increasing_id().alias("_id"))
    w = Window.partitionBy("file_name").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    base = x.groupBy("file_name", "_b").agg(F.count("*").alias("_n"), F.min("_id").alias("_least")).withColumn("_base", F.coalesce(F.sum("_n").over(w), F.lit(0)))  # a row a split
    return x.join(base, ["file_name", "_b"]).withColumn("row_ord", F.col("_base") + F.col("_id") - F.col("_least")).drop("_b", "_id", "_n", "_least", "_base")


@extractor("tabular")
def tabular_sections(rows: DataFrame, size: int = 50) -> DataFrame:
    """(file_name, section_ord, title, row_start, row_end, content) of rows as of ``read_rows``: every ``size`` rows of a file as a table and as plain lines."""
    from lexaloom.operators.windows import row_sections

    return row_sections(rows, ["file_name"], "row_ord", [c for c in rows.columns if c not in ("file_name", "row_ord")], size)


def _suffix(name: Column) -> Column:
    return F.lower(F.regexp_extract(name, r"(?<=.)\.([^.]+)$", 1))


def _taken(name: Column) -> Column:
    """True for names of source files."""
    return _suffix(name).isin(TAKEN) | ((_suffix(name) == "") & name.isin(NAMED))


def language_of(name: Column) -> Column:
    """Language of a file's fenced block, 'text' for unknown ones."""
    kinds = F.create_map(*[F.lit(v) for kv in LANGUAGE.items() for v in kv])
    return F.coalesce(F.try_element_at(kinds, _suffix(name)), F.lit("text"))


@extractor("code")
def code_sections(files: DataFrame, root: str = "root", extra_skip: list[str] | None = None) -> DataFrame:
    """(section_ord, title, content, depth, files) of files(path, content, size), paths being relative.

    The readme comes first as it is, then the tree of files, then a section for
    every folder in order of name, its sources each fenced under its path. Folders
    with a listed or dotted name are skipped, as are files over 100,000 bytes, of
    unknown kinds, and all other readmes. Null contents count as empty.
    """
    parts = F.split("path", "/")
    name = F.element_at(parts, -1)
    dirs = F.slice(parts, F.lit(1), F.size(parts) - 1)
    skipped = F.exists(dirs, lambda p: p.isin(SKIPPED + (extra_skip or [])) | p.startswith("."))
    text = F.coalesce("content", F.lit(""))
    x = files.where(~skipped & (F.col("size") <= MOST_BYTES) & ~F.lower(name).startswith("readme") & _taken(name))
    block = F.concat(F.lit("### "), F.col("path"), F.lit("\n\n```"), language_of(name), F.lit("\n"), text, F.lit("\n```"))
    folder = F.when(F.size(dirs) == 0, "(root)").otherwise(F.array_join(dirs, "/"))
    g = x.select(folder.alias("title"), F.struct("path", block.alias("b")).alias("v")).groupBy("title").agg(F.array_sort(F.collect_list("v")).alias("l"))
    columns = ["section_ord", "title", "content", "depth", "files"]
    folders = g.select(F.lit(2).alias("section_ord"), "title", F.array_join("l.b", "\n\n").alias("content"), F.lit(1).alias("depth"), F.size("l").alias("files"))
    rank = F.array_position(F.array(*[F.lit(n) for n in README_NAMES]), F.col("path"))
    readme = files.where(rank > 0).agg(F.min_by(text, rank).alias("content")).where("content is not null")
    readme = readme.select(F.lit(0).alias("section_ord"), F.lit("README").alias("title"), "content", F.lit(0).alias("depth"), F.lit(1).alias("files"))
    lines = file_tree(files, root, extra_skip=extra_skip).agg(F.array_sort(F.collect_list(F.struct("place", "line"))).alias("l")).where(F.size("l") > 0)
    tree = lines.select(F.lit(1).alias("section_ord"), F.lit("File Structure").alias("title"), F.concat(F.lit("```\n"), F.array_join("l.line", "\n"), F.lit("\n```")).alias("content"), F.lit(0).alias("depth"), F.size("l").alias("files"))
    return readme.unionByName(tree).unionByName(folders).select(*columns)


def file_tree(files: DataFrame, root: str = "root", depth: int = 3, extra_skip: list[str] | None = None) -> DataFrame:
    """(path, place, line) of the root, folders and source files down to ``depth`` folders, as lines of a tree; ``place`` sorts them: folders first, then by name.

    Listed and dotted names are left out, folders as well as files. Files of
    unknown kinds have no line, but still count where a branch ends.
    """
    parts = F.split("path", "/")
    every = files.select(F.explode(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.struct(F.slice(parts, F.lit(1), i).alias("p"), (i < F.size(parts)).alias("folder")))).alias("n")).select("n.p", "n.folder").distinct()
    every = every.where((F.size("p") <= depth + 1) & ~F.exists("p", lambda s: s.startswith(".") | s.isin(SKIPPED + (extra_skip or []))))
    up = F.slice("p", F.lit(1), F.size("p") - 1)
    own = F.concat(F.when(F.col("folder"), "0").otherwise("1"), F.element_at("p", -1))
    last = F.lead("p").over(Window.partitionBy(up).orderBy(own)).isNull()
    every = every.withColumn("last", last)
    above = every.select("p", "folder", "last", F.explode(F.transform(F.sequence(F.lit(1), F.size("p")), lambda i: F.slice("p", F.lit(1), i))).alias("q"))
    bars = above.join(every.select(F.col("p").alias("q"), F.col("last").alias("_last")), "q").where("p <> q").groupBy("p").agg(F.array_join(F.array_sort(F.collect_list(F.struct(F.size("q").alias("i"), F.when(F.col("_last"), "    ").otherwise("│   ").alias("bar"))))["bar"], "").alias("bars"))
    x = every.join(bars, "p", "left").where(F.col("folder") | _taken(F.element_at("p", -1)))
    line = F.concat(F.coalesce("bars", F.lit("")), F.when(F.col("last"), "└── ").otherwise("├── "), F.element_at("p", -1), F.when(F.col("folder"), "/").otherwise(""))
    n = F.size("p")
    place = F.transform("p", lambda s, i: F.concat(F.when((i < n - 1) | F.col("folder"), "0").otherwise("1"), s))
    top = files.limit(1).select(F.lit("").alias("path"), F.array().cast("array<string>").alias("place"), F.lit(f"{root}/").alias("line"))
    return x.select(F.array_join("p", "/").alias("path"), place.alias("place"), line.alias("line")).unionByName(top)


def links_in(pages: DataFrame, prefixes: list[str] | None = None) -> DataFrame:
    """(url, target) of pages(url, html): distinct links of the page's origin whose path begins with its scope or one of ``prefixes``, without query and fragment, the page itself left out."""
    from lexaloom.functions.text import path_prefix, url_path

    origin = F.regexp_extract("url", r"^(https?://[^/?#]*)", 1)
    x = pages.select("url", origin.alias("origin"), path_prefix(url_path(F.col("url"))).alias("scope"), F.explode(F.regexp_extract_all("html", F.lit(r"""(?i)<a\s[^>]*?href\s*=\s*["']([^"'#][^"']*)["']"""), F.lit(1))).alias("href"))
    full = F.when(F.col("href").rlike("^https?://"), F.col("href")).when(F.col("href").startswith("//"), F.concat(F.regexp_extract("origin", "^(https?:)", 1), F.col("href"))).when(F.col("href").startswith("/"), F.concat("origin", "href")).when(~F.col("href").rlike("^[a-zA-Z][a-zA-Z0-9+.-]*:"), F.concat(F.regexp_replace(F.regexp_replace("url", "[?#].*$", ""), "[^/]*$", ""), F.col("href")))
    x = x.withColumn("full", F.regexp_replace(full, "[?#].*$", "")).where("full is not null")
    path = url_path(F.col("full"))
    inside = path.startswith(F.col("scope"))
    for p in prefixes or []:
        inside = inside | path.startswith(p)
    return x.where((F.regexp_extract("full", r"^(https?://[^/?#]*)", 1) == F.col("origin")) & inside & (F.col("full") != F.regexp_replace("url", "[?#].*$", ""))).select("url", F.col("full").alias("target")).distinct()


def page_text(html: Column) -> Column:
    """Text of a page: scripts, styles, comments, navigation and footers out, block ends as line breaks, tags and common entities resolved."""
    t = F.regexp_replace(html, r"(?is)<!--.*?-->|<(script|style|nav|footer|header|aside)\b[^>]*>.*?</\1\s*>", " ")
    t = F.regexp_replace(t, r"(?i)<h([1-6])\b[^>]*>", "\n\n# ")
    t = F.regexp_replace(t, r"(?i)</(p|div|h[1-6]|li|tr|section|article)\s*>|<br\s*/?>", "\n\n")
    t = F.regexp_replace(t, r"<[^>]*>", " ")
    for entity, ch in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&copy;", "©"), ("&amp;", "&")):
        t = F.replace(t, F.lit(entity), F.lit(ch))
    return stripped(F.regexp_replace(F.regexp_replace(t, r"[ \t ]+", " "), r" ?\n[\n ]*", "\n\n"))


def images_in(pages: DataFrame) -> DataFrame:
    """(url, id, src, alt) of pages(url, html): images by absolute address once each, numbered by their place before filtering; inline data left out."""
    tag = F.regexp_extract_all("html", F.lit(r"(?is)<img\b[^>]*>"), F.lit(0))
    x = pages.select("url", F.posexplode(tag).alias("i", "tag"))
    src = F.regexp_extract("tag", r"""(?is)\bsrc\s*=\s*["']([^"']+)["']""", 1)
    origin = F.regexp_extract("url", r"^(https?://[^/?#]*)", 1)
    full = F.when(src.rlike("^https?://"), src).when(src.startswith("/"), F.concat(origin, src)).otherwise(F.concat(F.regexp_replace("url", "[^/]*$", ""), src))
    x = x.where((src != "") & ~src.startswith("data:")).select("url", "i", full.alias("src"), F.regexp_extract("tag", r"""(?is)\balt\s*=\s*["']([^"']*)["']""", 1).alias("alt"))
    return x.groupBy("url", "src").agg(F.min(F.struct("i", "alt")).alias("v")).select("url", F.concat(F.lit("web_img"), F.col("v.i")).alias("id"), "src", F.col("v.alt").alias("alt"))


def export_pages(archives: DataFrame) -> DataFrame:
    """(path, page, title, depth, text) of archives(path, content binary): markdown files of workspace exports, case aside in order of name; blank ones left out, unreadable archives give none.

    The id at the end of a name is no part of the title.
    """

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for path, content in pdf[["path", "content"]].itertuples(index=False):
                try:
                    z = zipfile.ZipFile(io.BytesIO(content))
                    names = sorted((n for n in z.namelist() if n.lower().endswith(".md")), key=str.lower)
                    for n in names:
                        t = z.read(n).decode("utf-8", "replace")
                        if t.strip():
                            stem = n.rsplit("/", 1)[-1][:-3]
                            rows.append((path, n, re.sub(r"\s+[0-9a-f]{16,}$", "", stem), n.count("/"), t))
                except (zipfile.BadZipFile, TypeError):
                    continue
            yield pd.DataFrame(rows, columns=["path", "page", "title", "depth", "text"])

    return archives.select("path", "content").mapInPandas(part, "path string, page string, title string, depth int, text string")


def image_placeholders(text: Column, ids: Column, folder: Column | None = None) -> Column:
    """Markdown images as [IMAGE: id] where ``ids`` (a map) has their path below the page's folder, their path, or file name; others stay."""
    parts = F.split(text, r"(?=!\[[^\]]*\]\([^)]*\))")

    def one(p: Column) -> Column:
        path = F.regexp_extract(p, r"^!\[[^\]]*\]\(([^)]*)\)", 1)
        named = [F.try_element_at(ids, path), F.try_element_at(ids, F.regexp_extract(path, "([^/]*)$", 1))]
        if folder is not None:
            named.insert(0, F.try_element_at(ids, F.when(folder != "", F.concat(folder, F.lit("/"), path))))
        found = F.coalesce(*named)
        return F.when((path != "") & found.isNotNull(), F.concat(F.lit("[IMAGE: "), found, F.lit("]"), F.regexp_replace(p, r"^!\[[^\]]*\]\([^)]*\)", ""))).otherwise(p)

    return F.array_join(F.transform(parts, one), "")


def image_registry(images: DataFrame) -> DataFrame:
    """(doc, id, xref, page, size) of images(doc, page, place, xref, size): each once, where it first stands, those under 2048 bytes left out; numbered by place on the page."""
    x = images.groupBy("doc", "xref").agg(F.min(F.struct("page", "place", "size")).alias("v")).where(F.col("v.size") >= LEAST_IMAGE)
    return x.select("doc", F.concat(F.lit("p"), F.col("v.page"), F.lit("_img"), F.col("v.place")).alias("id"), "xref", F.col("v.page").alias("page"), F.col("v.size").alias("size"))


def pseudo_pages(paragraphs: DataFrame, words: int = 500) -> DataFrame:
    """(doc, page, text) of paragraphs(doc, ord, text): a page is closed once it has ``words`` words; blank paragraphs stay as empty lines.

    A document's paragraphs meet in one array.
    """
    g = paragraphs.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("ord", F.coalesce("text", F.lit("")).alias("text")))).alias("l"))
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(1).alias("page"), F.array().cast("array<int>").alias("ids"))

    def step(s: Column, p: Column) -> Column:
        n = s["n"] + word_count(p["text"])
        return F.struct(F.when(n >= words, F.lit(0).cast("long")).otherwise(n).alias("n"), F.when(n >= words, s["page"] + 1).otherwise(s["page"]).alias("page"), F.concat(s["ids"], F.array(s["page"])).alias("ids"))

    x = g.withColumn("_ids", F.aggregate("l", start, step, lambda s: s["ids"]))
    x = x.select("doc", F.explode(F.arrays_zip("l", "_ids")).alias("z")).select("doc", F.col("z._ids").alias("page"), F.col("z.l").alias("p"))
    text = x.groupBy("doc", "page").agg(F.array_join(F.array_sort(F.collect_list("p"))["text"], "\n").alias("text"))
    return text.where(stripped(F.col("text")) != "")


def heading_entries(paragraphs: DataFrame) -> DataFrame:
    """(doc, ord, level, page, title) of a word-processor document's headings: paragraphs(doc, ord, style, text) with a style 'Heading n'; a style without a number counts as 1; blank ones are none. All stand on page 1, as such documents have no pages."""
    style = F.lower(F.coalesce("style", F.lit("")))
    n = F.regexp_extract(style, r"^heading\s+(\d+)$", 1)
    x = paragraphs.where(style.startswith("heading") & (stripped(F.coalesce("text", F.lit(""))) != ""))
    return x.select("doc", "ord", F.when(n != "", n.cast("int")).otherwise(1).alias("level"), F.lit(1).alias("page"), stripped(F.col("text")).alias("title"))


def slides(shapes: DataFrame) -> DataFrame:
    """(doc, slide, title, content, notes) of shapes(doc, slide, ord, kind, text): kinds 'title', 'text' and 'notes'; a slide without a title is named by its number."""
    own = lambda k: F.array_join(F.array_sort(F.collect_list(F.when((F.col("kind") == k) & (stripped(F.col("text")) != ""), F.struct("ord", stripped(F.col("text")).alias("t")))))["t"], "\n\n")
    g = shapes.groupBy("doc", "slide").agg(F.min(F.when((F.col("kind") == "title") & (stripped(F.col("text")) != ""), stripped(F.col("text")))).alias("t"), own("text").alias("content"), own("notes").alias("notes"))
    return g.select("doc", "slide", F.coalesce("t", F.concat(F.lit("Slide "), F.col("slide"))).alias("title"), "content", "notes")


def pick_transcript(tracks: DataFrame, languages: list[str]) -> DataFrame:
    """One track a video: of tracks(video, language, origin) a manual one in a wanted language, then an automatic one, then any, then recognised speech."""
    wanted = F.array_position(F.array(*[F.lit(x) for x in languages]), F.col("language"))
    rank = F.when((F.col("origin") == "manual") & (wanted > 0), wanted).when((F.col("origin") == "auto") & (wanted > 0), wanted + 1000).when(F.col("origin").isin("manual", "auto"), F.lit(2000)).otherwise(F.lit(3000))
    return tracks.withColumn("_r", rank).groupBy("video").agg(F.min_by(F.struct("language", "origin"), F.struct("_r", "language", "origin")).alias("v")).select("video", "v.language", "v.origin")


def read_regions(regions: DataFrame, least: float = 0.15) -> DataFrame:
    """(img_id, text) of recognised regions(img_id, x, y, text, confidence): from top to bottom and left to right, those under ``least`` left out."""
    x = regions.where(F.col("confidence") >= least).groupBy("img_id").agg(F.array_sort(F.collect_list(F.struct("y", "x", "text"))).alias("l"))
    return x.select("img_id", F.array_join("l.text", "\n").alias("text"))


@extractor("notion")
def export_documents(pages: DataFrame) -> DataFrame:
    """(path, page, section_ord, title, depth, content) of pages as of ``export_pages``: a page's headings as sections.

    A page with several has an empty section of its own title before them; one
    with a single section gives that its title.
    """
    from lexaloom.operators.chunking import export_sections

    key = pages.select(F.struct("path", "page", F.col("title").alias("own"), F.col("depth").alias("own_depth")).alias("k"), "text", "depth")
    s = export_sections(key, "k", "text", "depth").select("k", "section_ord", "title", "depth", "content")
    s = s.withColumn("n", F.count("*").over(Window.partitionBy("k.path", "k.page")))  # a page's sections
    one = F.col("n") == 1
    below = s.select("k.path", "k.page", F.when(one, 0).otherwise(F.col("section_ord") + 1).alias("section_ord"), F.when(one, F.col("k.own")).otherwise(F.col("title")).alias("title"), F.when(one, F.col("k.own_depth")).otherwise(F.col("depth")).alias("depth"), "content")
    top = s.where("n > 1 and section_ord = 0").select("k.path", "k.page", F.lit(0).alias("section_ord"), F.col("k.own").alias("title"), F.col("k.own_depth").alias("depth"), F.lit("").alias("content"))
    return below.unionByName(top)


def export_title(sections: DataFrame) -> DataFrame:
    """(path, title): an export's title, that of its first section of depth 0 that isn't named Content, else its file's stem. sections: of ``export_documents``."""
    stem = F.regexp_replace(F.regexp_extract("path", "([^/]*)$", 1), r"(?<=.)\.[^.]*$", "")
    first = F.min(F.when((F.col("depth") == 0) & (F.col("title") != "Content"), F.struct(F.lower("page").alias("p"), "section_ord", "title")))
    return sections.groupBy("path").agg(first.alias("v")).select("path", F.coalesce("v.title", stem).alias("title"))


def archive_images(files: DataFrame) -> DataFrame:
    """(path, key, id, local_path, size) of images in archives: files(path, name, size, ord), each found by its whole name and by its last part, of equal keys the last in ``ord``; those under 2048 bytes and of other kinds are left out."""
    ext = F.lower(F.regexp_extract("name", r"\.([^./]+)$", 1))
    x = files.where((F.col("size") >= LEAST_IMAGE) & ext.isin("png", "jpg", "jpeg", "gif", "webp", "svg", "bmp"))
    x = x.withColumn("base", F.regexp_extract("name", "([^/]*)$", 1)).withColumn("key", F.explode(F.array_distinct(F.array("name", "base"))))
    own = F.struct("ord", F.concat(F.lit("zip_img"), F.col("ord")).alias("id"), F.concat(F.lit("images/"), "base").alias("local_path"), "size")
    return x.groupBy("path", "key").agg(F.max(own).alias("v")).select("path", "key", "v.id", "v.local_path", "v.size")


def text_pages(pages: DataFrame) -> DataFrame:
    """(doc, page, text) of the pages that have text; numbers, from 1, may have gaps."""
    return pages.where(stripped(F.coalesce("text", F.lit(""))) != "").select("doc", "page", "text")


def document_title(docs: DataFrame) -> DataFrame:
    """(doc, title) of docs(doc, path, title): the title given, or the stem of the file."""
    stem = F.regexp_replace(F.regexp_extract("path", "([^/]*)$", 1), r"(?<=.)\.[^.]*$", "")
    return docs.select("doc", F.coalesce(F.nullif(stripped(F.col("title")), F.lit("")), stem).alias("title"))


def repaired_pages(pages: DataFrame, recognised: DataFrame) -> DataFrame:
    """(doc, page, text, repaired): pages that look scanned get the text recognised(doc, page, text) where that is longer, blanks at the ends aside; pages that had none are added."""
    from lexaloom.functions.text import is_scanned

    a = pages.select("doc", "page", F.coalesce("text", F.lit("")).alias("text"))
    x = a.join(recognised.select("doc", "page", F.col("text").alias("_r")), ["doc", "page"], "full").withColumn("text", F.coalesce("text", F.lit("")))
    longer = is_scanned(F.col("text")) & (F.length(stripped(F.coalesce("_r", F.lit("")))) > F.length(stripped(F.col("text"))))
    return x.select("doc", "page", F.when(longer, F.col("_r")).otherwise(F.col("text")).alias("text"), longer.alias("repaired")).where(stripped(F.col("text")) != "")


@extractor("pdf")
def paged_sections(inputs: dict[str, DataFrame]) -> DataFrame:
    """(doc, ord, title, depth, page_start, page_end, content, images) of tree, pages and images.

    tree: of ``topic_tree``; pages: doc, page, text; images: doc, page, ord, id,
    local_path. A topic has the text of its pages, in order, by blank lines, and
    the images on them; text of a topic's pages comes again in those below it.
    """
    from lexaloom.operators.chunking import text_of_pages

    tree, pages, images = inputs["tree"], inputs["pages"], inputs["images"]
    t = tree.withColumn("page_end", F.coalesce("page_end", "page_start"))
    x = text_of_pages(t, text_pages(pages), "doc").withColumnRenamed("text", "content")
    by = ["doc", "page_start", "page_end"]
    hit = x.select(*by).distinct().join(images, "doc").where(F.col("page").between(F.col("page_start"), F.col("page_end")))
    one = F.struct("page", F.col("ord").alias("o"), "id", "local_path")
    g = hit.groupBy(*by).agg(F.array_sort(F.collect_list(one)).alias("l"))
    ref = F.transform("l", lambda i: F.struct(i["id"].alias("id"), i["local_path"].alias("local_path"), F.lit("").alias("alt_text"), F.concat(F.lit("page:"), i["page"]).alias("context")))
    return x.join(g.select(*by, ref.alias("images")), by, "left").select("doc", "ord", "title", "depth", "page_start", "page_end", "content", "images")


@extractor("office")
def titled_sections(inputs: dict[str, DataFrame]) -> DataFrame:
    """(doc, ord, title, depth, content) of word-processor documents: toc(doc, ord, level, title), pages(doc, page, text), docs(doc, title).

    An entry has all pages that hold its title, in order, by blank lines, and none
    where no page does; a document without entries is one section with all its
    pages. Documents are compared page by page with their own titles only.
    """
    toc, pages, docs = inputs["toc"], text_pages(inputs["pages"]), inputs["docs"]
    entries = toc.where("title is not null")
    hit = entries.join(pages, "doc").where(F.contains(F.col("text"), F.col("title")))
    text = hit.groupBy("doc", "ord").agg(F.array_join(F.array_sort(F.collect_list(F.struct("page", "text")))["text"], "\n\n").alias("content"))
    a = entries.join(text, ["doc", "ord"], "left").select("doc", "ord", "title", (F.col("level") - 1).alias("depth"), F.coalesce("content", F.lit("")).alias("content"))
    whole = pages.join(entries.select("doc").distinct(), "doc", "left_anti").groupBy("doc").agg(F.array_join(F.array_sort(F.collect_list(F.struct("page", "text")))["text"], "\n\n").alias("content"))
    return a.unionByName(docs.select("doc", "title").join(whole, "doc").select("doc", F.lit(0).alias("ord"), "title", F.lit(0).alias("depth"), "content"))


def related_images(parts: DataFrame) -> DataFrame:
    """(doc, id, name, size) of a document's parts(doc, ord, kind, name, size): images of 2048 bytes and more, numbered from 0 in order."""
    x = parts.where((F.col("kind") == "image") & (F.col("size") >= LEAST_IMAGE))
    n = F.row_number().over(Window.partitionBy("doc").orderBy("ord")) - 1  # a document's images
    return x.withColumn("n", n).select("doc", F.concat(F.lit("docx_img"), F.col("n")).alias("id"), "name", "size")


@extractor("web")
def web_pages(pages: DataFrame) -> DataFrame:
    """(url, section_ord, title, depth, content, author) of pages(url, html): the text of each, parted at its headings; what has none is titled by the page's title, else by its address."""
    from lexaloom.operators.chunking import markdown_sections

    tag = lambda p: F.nullif(stripped(F.regexp_extract("html", p, 1)), F.lit(""))
    title = F.coalesce(tag(r"(?is)<title[^>]*>(.*?)</title>"), F.regexp_replace("url", "^https?://|[?#].*$", ""))
    author = F.coalesce(tag(r"""(?is)<meta\s[^>]*name=["']author["'][^>]*content=["']([^"']*)["']"""), F.lit(""))
    key = pages.where("html is not null").select(F.struct("url", author.alias("author")).alias("k"), page_text(F.col("html")).alias("text"), title.alias("title")).where("text <> ''")
    return markdown_sections(key, "k", "text", "title").select("k.url", "section_ord", "title", "depth", "content", "k.author")


def kept_images(images: DataFrame) -> DataFrame:
    """Of images(url, id, src, alt, size, content_type) those of an image's type and kind of file, from 5120 bytes to 10 MB."""
    ext = F.lower(F.regexp_extract(F.regexp_replace("src", "[?#].*$", ""), r"\.([A-Za-z0-9]+)$", 1))
    return images.where(F.contains("content_type", F.lit("image")) & F.col("size").between(5120, 10 * 1024 * 1024) & ext.isin("png", "jpg", "jpeg", "gif", "webp", "svg"))


def crawled_sections(crawled: DataFrame, pages: DataFrame) -> DataFrame:
    """(place, section_ord, url, title, depth, content): for every page of ``crawl`` an empty section of its title, then its own, one level down, two at most. pages: url, title, text; a page without a title is named by its address."""
    from lexaloom.functions.text import slug_title, url_path
    from lexaloom.operators.chunking import markdown_sections

    x = crawled.select("url", "place").join(pages, "url")
    x = x.withColumn("title", F.coalesce(F.nullif("title", F.lit("")), slug_title(url_path(F.col("url")))))
    s = markdown_sections(x.select(F.struct("url", "place").alias("k"), "text", "title"), "k", "text", "title")
    s = s.select("k.place", (F.col("section_ord") + 1).alias("section_ord"), "k.url", "title", F.least(F.col("depth") + 1, F.lit(2)).alias("depth"), "content")
    return s.unionByName(x.select("place", F.lit(0).alias("section_ord"), "url", "title", F.lit(0).alias("depth"), F.lit("").alias("content")))


@extractor("notion_api")
def workspace_blocks(blocks: DataFrame) -> DataFrame:
    """(page, content) of a workspace's blocks(page, ord, kind, text, checked, language, icon, url): their markdown in order, by blank lines; empty ones are left out."""
    from lexaloom.functions.text import block_markdown

    md = block_markdown(*[F.col(c) for c in ("kind", "text", "checked", "language", "icon", "url")])
    x = blocks.select("page", F.struct("ord", md.alias("md")).alias("v")).where("v.md <> ''")
    return x.groupBy("page").agg(F.array_join(F.array_sort(F.collect_list("v"))["md"], "\n\n").alias("content"))


@extractor("video")
def playlist_sections(inputs: dict[str, DataFrame], most: int | None = None) -> DataFrame:
    """(playlist, entry, section_ord, title, content) of entries(playlist, entry, video, url, title) and sections(video, section_ord, title, content).

    Entries are numbered from 1; those after ``most`` are left out, as are those
    without an address or without sections. A section's title begins with its
    entry's number and title.
    """
    e = inputs["entries"].withColumn("n", F.row_number().over(Window.partitionBy("playlist").orderBy("entry")))  # a playlist's entries
    if most is not None:
        e = e.where(F.col("n") <= most)
    e = e.where("url is not null or video is not null").withColumn("_t", F.coalesce(F.nullif("title", F.lit("")), F.concat(F.lit("Video "), F.col("n"))))
    number = F.when(F.col("n") < 10, F.concat(F.lit("0"), F.col("n"))).otherwise(F.col("n").cast("string"))
    prefix = F.concat(F.lit("Ep "), number, F.lit(" — "), F.col("_t"), F.lit(": "))
    x = e.select("playlist", F.col("n").alias("entry"), "video", prefix.alias("_p")).join(inputs["sections"], "video")
    return x.select("playlist", "entry", "section_ord", F.concat("_p", "title").alias("title"), "content")


def image_work(images: DataFrame, files: DataFrame) -> DataFrame:
    """(source, id, local_path, file_exists, mime_type, size_bytes, description, ocr_text, contains_text, contains_diagram, contains_code, educational_value): images to be looked at, with what is still to be filled in. files: local_path of what there is."""
    have = files.select("local_path").distinct().withColumn("_have", F.lit(True))
    empty, unknown = F.lit(""), F.lit(None).cast("boolean")
    return images.join(have, "local_path", "left").select(
        "source", "id", "local_path", F.coalesce("_have", F.lit(False)).alias("file_exists"), F.coalesce("mime_type", empty).alias("mime_type"), F.coalesce("size_bytes", F.lit(0).cast("long")).alias("size_bytes"),
        empty.alias("description"), empty.alias("ocr_text"), unknown.alias("contains_text"), unknown.alias("contains_diagram"), unknown.alias("contains_code"), F.lit(None).cast("string").alias("educational_value"),
    )


def recognised_images(work: DataFrame, texts: DataFrame) -> DataFrame:
    """``work`` with the text recognised(id, text) of images that have none yet: kept if it has over 10 characters, which also tells whether there is text; images not looked at stay as they are."""
    x = work.join(texts.select("id", stripped(F.coalesce("text", F.lit(""))).alias("_r")), "id", "left")
    todo = (F.coalesce("ocr_text", F.lit("")) == "") & F.col("_r").isNotNull() & F.col("file_exists")
    good = F.length("_r") > 10
    return x.withColumn("contains_text", F.when(todo, good).otherwise(F.col("contains_text"))).withColumn("ocr_text", F.when(todo & good, F.col("_r")).otherwise(F.col("ocr_text"))).drop("_r").select(*work.columns)


def read_bundle(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Tables of a curriculum's folder: manifest, structure, chunks, and exercises where there are any."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    there = lambda name: hadoop(f"{path}/{name}").getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop(f"{path}/{name}"))
    out = {}
    for name in ("manifest", "structure", "chunks", "exercises"):
        if there(f"{name}.parquet"):
            out[name] = spark.read.parquet(f"{path}/{name}.parquet")
        elif there(f"{name}.json"):
            out[name] = spark.read.option("multiLine", True).json(f"{path}/{name}.json")
        elif name != "exercises":
            raise FileNotFoundError(f"{path}/{name}")
    return out


class ExtractedSource(DataSource):
    """Spark data source "extracted": sections of JSON documents, a task a file.

    Files are listed and read as local ones, so the folder must be mounted on every
    worker; ``read_extracted`` reads any file system.
    """

    @classmethod
    def name(cls) -> str:
        return "extracted"

    def schema(self) -> str:
        return "source_path string, section_ord int, title string, content string, depth int"

    def reader(self, schema) -> DataSourceReader:
        return _ExtractedReader(self.options["path"])


class _ExtractedReader(DataSourceReader):
    def __init__(self, path: str) -> None:
        self.path = path

    def partitions(self) -> list[InputPartition]:
        from pathlib import Path

        return [InputPartition(str(p)) for p in sorted(Path(self.path).glob("*.json"))]

    def read(self, partition: InputPartition):
        with open(partition.value, encoding="utf-8") as f:
            doc = json.load(f)
        for i, s in enumerate(doc.get("sections") or []):
            yield doc.get("source_path"), i, s.get("title"), s.get("content"), s.get("depth") or 0
