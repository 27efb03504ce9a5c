"""Commands over folders: python -m lexaloom COMMAND --help."""

from __future__ import annotations

import argparse
import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexaloom.operators import bridge, condense, lookup, nested, trees, upload
from lexaloom.plans.chunk_queries import SHAPE
from lexaloom.session import session
from lexaloom.sources import connectors as C

ORDER = ["file_name", "section_ord"]


def _write(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def _nodes(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(nodes, refs) of a structure file: a list of topics, or an object that holds one."""
    text = spark.read.option("wholetext", True).text(path).select(F.lit(0).cast("long").alias("tree"), F.lit(None).cast("string").alias("title"), F.col("value").alias("children"))
    flat = nested.flatten(text, "tree", "tree", "title", None, "children", SHAPE).where("path <> '0'")
    place = F.transform(F.slice(F.split("path", r"\."), 2, 1 << 30), lambda i: i.cast("int"))
    splits = flat.where("kind = 'split'").groupBy("path").agg(F.array_sort(F.collect_list(F.struct("position", "title")))["title"].alias("split_after"))
    topics = flat.where("kind = 'topic'").join(splits, "path", "left")
    titles = F.slice("titles", 2, 1 << 30)
    nodes = topics.select(F.col("key").alias("tree"), place.alias("place"), "title", titles.alias("titles"), "split_after")
    return nodes, flat.where("kind = 'section'").select(F.col("key").alias("tree"), place.alias("place"), F.col("position").alias("ref_ord"), F.col("title").alias("name"))


def _sections(spark: SparkSession, path: str) -> DataFrame:
    x = C.read_extracted(spark, path)
    return x.select(F.lit(0).cast("long").alias("tree"), *ORDER, "title", "content", F.col("source_path").alias("source"), "images")


def chunk(spark: SparkSession, a: argparse.Namespace) -> None:
    nodes, refs = _nodes(spark, a.structure)
    out = bridge.bridge(nodes, refs, _sections(spark, a.extracted), "tree", "place", ORDER)
    _write(out.orderBy("order_key", "chunk_index").select(F.col("titles").alias("topic_path"), "chunk_index", "content", "token_count", "has_code", "page_number", "source", "images"), a.output)


def normalize(spark: SparkSession, a: argparse.Namespace) -> None:
    rows = []
    if a.remap:
        with open(a.remap, encoding="utf-8") as f:
            for k, v in json.load(f).items():  # titles for all files, or for one
                rows += [(k, o, n) for o, n in v.items()] if isinstance(v, dict) else [(None, k, v)]
    remap = spark.createDataFrame(rows, "file string, old string, new string")
    x = condense.normalized_sections(C.read_extracted(spark, a.folder), remap, "file_name", "title")
    x.groupBy("file_name", "action").count().orderBy("file_name", "action").show(1000, False)
    if not a.dry_run:
        _write(x.where("action <> 'dropped'").withColumn("title", F.col("new_title")).drop("new_title", "action"), a.output)


def extract(spark: SparkSession, a: argparse.Namespace) -> None:
    if a.kind == "code":
        raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(a.source)
        root = F.regexp_replace(F.lit(a.source.rstrip("/")), "^file:/*", "/")
        path = F.regexp_replace("path", r"^[a-z0-9]+:/*", "/")
        files = raw.select(F.substr(path, F.length(root) + 2).alias("path"), F.decode("content", "UTF-8").alias("content"), F.col("length").alias("size"))
        out = C.code_sections(files, a.source.rstrip("/").rsplit("/", 1)[-1], a.exclude)
    elif a.kind == "tabular":
        out = C.tabular_sections(C.read_rows(spark, a.source))
    elif a.kind == "export":
        out = C.export_documents(C.export_pages(spark.read.format("binaryFile").load(a.source).select("path", "content")))
    else:
        out = C.web_pages(spark.read.schema("url string, html string").json(a.source))
    _write(out, a.output)


def headings(spark: SparkSession, a: argparse.Namespace) -> None:
    """Topic trees of pages (doc, page, text), from a table of contents if there is one, else from headings."""
    pages = spark.read.schema("doc string, page int, text string").json(a.pages)
    docs = pages.groupBy("doc").agg(F.max("page").alias("total_pages")).withColumn("title", F.col("doc"))
    found = trees.headings(pages, ["doc", "page"], "text")
    ord_ = (F.col("page").cast("long") * 1_000_000 + F.col("line_ord")).alias("ord")
    found = found.select("doc", ord_, "level", "page", "title")
    toc = spark.read.schema("doc string, ord long, level int, page int, title string").json(a.toc) if a.toc else found.limit(0)
    _write(trees.topic_tree(toc, found, docs.select("doc", "title", "total_pages"), "doc"), a.output)


def condense_tiers(spark: SparkSession, a: argparse.Namespace) -> None:
    child = "array<struct<title:string,description:string,condensation_strategy:string,source_children:array<string>,content:string,objectives:array<struct<text:string,bloom_level:string>>>>"
    schema = f"tier string, topic_ord int, title string, description string, condensation_strategy string, source_topics array<string>, content string, suggested_level int, objectives array<struct<text:string,bloom_level:string>>, prerequisites array<struct<topic:string,strength:string>>, children {child}"
    plan = spark.read.schema(schema).option("multiLine", True).json(a.plan)
    if a.tiers:
        plan = plan.where(F.col("tier").isin(a.tiers.split(",")))
    chunks = spark.read.json(a.chunks)
    c = chunks.where("size(topic_path) > 0").select(F.element_at("topic_path", -1).alias("title"), F.struct(F.array_join("topic_path", "\u0000"), "chunk_index").alias("chunk_ord"), "content", F.col("token_count").cast("int").alias("token_count"), "has_code")
    out = condense.leaf_chunks(condense.plan_leaves(plan), c)
    structure = condense.tier_structure(plan, spark.createDataFrame([], "title string, objectives array<struct<text:string,bloom_level:string>>"))
    original = c.agg(F.sum(F.col("token_count").cast("long")).alias("tokens"))
    condense.tier_summary(structure, out, original).orderBy("tier").show(100, False)
    for name, df in (("structure", structure), ("chunks", out)):
        df.write.mode("overwrite").partitionBy("tier").json(f"{a.output}/{name}")


def store(spark: SparkSession, a: argparse.Namespace) -> None:
    """Tables of a curriculum, or with --update the chunks table after the update."""
    nodes, _ = _nodes(spark, a.structure)
    ids = lambda p: upload.stable_id(F.lit(a.domain), F.to_json(p))
    topics = nodes.select(ids(F.col("place")).alias("id"), F.when(F.size("place") > 1, ids(F.slice("place", F.lit(1), F.size("place") - 1))).alias("parent_id"), F.lit(0).cast("long").alias("tree"), "title", (F.size("place") - 1).alias("depth"), F.element_at("place", -1).alias("sort_order"), F.col("place").alias("ord"))
    chunks = spark.read.schema(f"topic_path array<string>, chunk_index int, content string, token_count long, has_code boolean, page_number int, source string, images array<{C.IMAGE}>, metadata map<string,string>").json(a.chunks)
    images = F.transform("images", lambda i: F.struct(i["id"].alias("id"), F.concat(F.lit(a.images + "/"), i["local_path"]).alias("url"), i["alt_text"].alias("alt_text")))
    chunks = chunks.withColumn("images", images).withColumn("tree", F.lit(0).cast("long")).withColumn("chunk_id", upload.stable_id(F.array_join("topic_path", "\u0000"), F.col("chunk_index")))
    books = chunks.where("source <> ''").select("tree", "source").distinct().select("tree", "source", upload.stable_id(F.col("source")).alias("book_id"), F.col("source").alias("ord"))
    rows = upload.chunk_rows(chunks, topics, books, "tree", "ord").drop("chunk_id")
    if a.update:
        old = spark.read.schema(rows.schema).json(a.update)
        rows = upload.store_chunks(old, rows, a.replace_chunks)
        rows.groupBy("action").count().orderBy("action").show()
        rows = rows.where("action not in ('skipped', 'replaced')").drop("action")
    for name, df in (("topics", topics.drop("tree", "ord")), ("books", books.drop("tree", "ord")), ("content_chunks", rows)):
        _write(df, f"{a.output}/{name}")


def images(spark: SparkSession, a: argparse.Namespace) -> None:
    if a.step == "prepare":
        registry = spark.read.schema("source string, id string, local_path string, mime_type string, size_bytes long").json(a.registry)
        _write(C.image_work(registry, spark.read.schema("local_path string").json(a.files)), a.output)
    else:
        registry = spark.read.schema("id string, local_path string, alt_text string, ocr_text string, educational_value string").json(a.registry)
        found = spark.read.schema("id string, description string, ocr_text string, educational_value string").json(a.files)
        _write(lookup.merge_analysis(registry, found, "id"), a.output)


def migrations(spark: SparkSession, a: argparse.Namespace) -> None:
    files = spark.read.format("binaryFile").load(a.folder).select(F.regexp_extract("path", "([^/]*)$", 1).alias("name"))
    applied = spark.read.schema("version string").json(a.applied) if a.applied else spark.createDataFrame([], "version string")
    upload.migrations(files, applied).orderBy("version").show(1000, False)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="lexaloom")
    sub = p.add_subparsers(dest="command", required=True)

    def add(name: str, run: Callable, **options: dict) -> None:
        s = sub.add_parser(name, help=(run.__doc__ or "").strip() or None)
        s.set_defaults(run=run)
        for flag, how in options.items():
            s.add_argument(flag.replace("__", "--").replace("_", "-") if flag.startswith("__") else flag, **how)
        s.add_argument("-o", "--output", default="out")

    need, maybe, flag = {"required": True}, {"default": None}, {"action": "store_true"}
    add("chunk", chunk, __structure=need, __extracted=need)
    add("normalize", normalize, folder={}, __remap=maybe, __dry_run=flag)
    add("extract", extract, kind={"choices": ["code", "tabular", "export", "web"]}, source={}, __exclude={"nargs": "*", "default": []})
    add("tree", headings, pages={}, __toc=maybe)
    add("condense", condense_tiers, __plan=need, __chunks=need, __tiers=maybe)
    add("upload", store, __structure=need, __chunks=need, __domain=need, __images={"default": ""}, __update=maybe, __replace_chunks=flag)
    add("images", images, step={"choices": ["prepare", "apply"]}, registry={}, files={})
    add("migrations", migrations, folder={}, __applied=maybe)
    return p


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(argv)
    if getattr(a, "replace_chunks", False) and not a.update:
        parser().error("--replace-chunks needs --update")
    a.run(spark or session("lexaloom"), a)
    return 0
