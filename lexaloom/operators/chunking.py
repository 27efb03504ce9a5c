"""Paragraphs, packing them into token-bounded chunks, and the chunkers built on that."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexaloom.functions.text import is_code, is_heading, let, stripped, word_count

# Blanks a line may hold and still count as empty.
_BLANKS = r"[ \t\x0B\f\r\xA0]*"
# A line break with empty lines after it, and what indents the next line.
_GAP = r"\n[ \t\x0B\f\r\xA0]*\n[ \t\x0B\f\r\xA0\n]*"


def paragraphs(text: Column) -> Column:
    """Paragraphs of a text: parted by blank lines, a fenced block whole and apart from what stands before it.

    What follows a closing fence directly belongs to the block's paragraph; a
    fence that isn't closed runs to the end. Empty for the empty text, null for
    null. The text is cut before every line with a fence; of these pieces, every
    other one begins a block, so no line is looked at twice.
    """

    def of(pieces: Column) -> Column:
        plain = F.when(F.get(pieces, F.lit(0)).rlike("^" + _BLANKS + "```"), 0).otherwise(1)

        def one(piece: Column, i: Column) -> Column:
            opens = (i >= plain) & ((i - plain) % 2 == 0)
            closes = (i >= plain) & ((i - plain) % 2 == 1)
            block = F.concat(piece, F.coalesce(F.get(F.split(F.get(pieces, i + 1), _GAP, 2), F.lit(0)), F.lit("")))
            rest = F.split(piece, _GAP)
            return F.when(opens, F.array(block)).when(closes, F.slice(rest, F.lit(2), F.size(rest))).otherwise(rest)

        return F.flatten(F.transform(pieces, one))

    parted = let(F.split(text, "(?md)^(?=" + _BLANKS + "```)"), of)
    return F.filter(F.transform(parted, stripped), lambda p: p != "")


def _packing(paras: Column, most: int, least: int, split_before: Column | None) -> Column:
    """Where chunks begin: places of their first paragraphs, a small tail having been merged.

    paras: array<struct<text, n, heading>>. Only the bounds are carried from one paragraph to the next.
    """
    start = F.struct(
        F.lit(0).alias("at"), F.lit(0).cast("long").alias("tokens"), F.lit(0).alias("parts"), F.lit(False).alias("heading"),
        F.lit(False).alias("closed"), F.array().cast("array<int>").alias("starts"),
    )

    def step(s: Column, p: Column) -> Column:
        named = F.regexp_replace(stripped(F.lower(p["text"])), r"^#+\s*", "")
        forced = F.coalesce(F.array_contains(split_before, named) & p["heading"], F.lit(False)) if split_before is not None else F.lit(False)
        big = p["n"] > most
        full = (s["tokens"] + p["n"] > most) & (s["tokens"] >= least) & ~s["heading"]
        # a chunk begins after a flush and after an oversized paragraph, which closes its own
        fresh = ((s["parts"] > 0) & (forced | big | full)) | s["closed"] | (s["at"] == 0)
        tokens = F.when(fresh, p["n"]).otherwise(s["tokens"] + p["n"])
        parts = F.when(fresh, F.lit(1)).otherwise(s["parts"] + 1)
        return F.struct(
            (s["at"] + 1).alias("at"), F.when(big, F.lit(0).cast("long")).otherwise(tokens).alias("tokens"), F.when(big, F.lit(0)).otherwise(parts).alias("parts"),
            (~big & p["heading"]).alias("heading"), big.alias("closed"), F.when(fresh, F.concat(s["starts"], F.array(s["at"]))).otherwise(s["starts"]).alias("starts"),
        )

    def finish(s: Column) -> Column:
        tail = (s["parts"] > 0) & (s["tokens"] < least) & (F.size(s["starts"]) > 1)
        return F.when(tail, F.slice(s["starts"], F.lit(1), F.size(s["starts"]) - 1)).otherwise(s["starts"])

    return F.aggregate(paras, start, step, finish)


def once(df: DataFrame, keep: list[str], **columns: Column) -> DataFrame:
    """``keep`` and ``columns``, each computed once a row: a projection would be merged into lambdas and computed for every element."""
    return df.select(*keep, F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def pack(df: DataFrame, text: str, most: int = 1500, least: int = 200, count: Callable[[Column], Column] = word_count, split_before: str | None = None) -> DataFrame:
    """Rows of ``df`` without ``text``, one a chunk, with chunk_index, content, token_count, has_code.

    A text of at most ``most`` tokens is one chunk. Else paragraphs are packed in
    order: a chunk is closed before a heading that ``split_before`` (a column of
    titles; case and blanks around them don't count) names, before and after a
    paragraph over ``most``, and where the next would exceed ``most`` once it has
    ``least``, but never right after a heading; a last chunk under ``least`` joins
    the one before. Null and blank texts give no chunk. All on one row, in
    proportion to the text: nothing is shuffled.
    """
    keep = [c for c in df.columns if c not in (text, "chunk_index", "content", "token_count", "has_code")]  # the chunk's own win
    t = F.col(text)
    info = lambda p: F.struct(p.alias("text"), count(p).alias("n"), is_heading(p).alias("heading"), (is_code(p) | p.startswith("```")).alias("code"))
    whole = F.array(F.struct(stripped(t).alias("content"), count(t).alias("token_count"), (is_code(t) | F.contains(t, F.lit("```"))).alias("has_code")))
    names = F.transform(F.col(split_before), lambda h: F.lower(stripped(h))) if split_before else None
    parted = once(df.where(t.isNotNull() & (stripped(t) != "")), df.columns, _n=count(t))
    parted = once(parted, [*df.columns, "_n"], _p=F.when(F.col("_n") > most, F.transform(paragraphs(t), info)), _names=names if split_before else F.lit(None).cast("array<string>"))
    parted = once(parted, [*df.columns, "_n", "_p"], _starts=_packing(F.col("_p"), most, least, F.col("_names") if split_before else None))

    def chunk(begin: Column, i: Column) -> Column:
        own = F.slice(F.col("_p"), begin + 1, F.coalesce(F.get(F.col("_starts"), i + 1), F.size("_p")) - begin)
        return let(own, lambda o: F.struct(
            F.array_join(F.transform(o, lambda z: z["text"]), "\n\n").alias("content"),
            F.aggregate(o, F.lit(0).cast("long"), lambda a, z: a + z["n"]).alias("token_count"), F.exists(o, lambda z: z["code"]).alias("has_code"),
        ))

    parted = parted.withColumn("_c", F.when(F.col("_n") <= most, whole).otherwise(F.transform("_starts", chunk)))
    out = parted.select(*keep, F.posexplode("_c").alias("chunk_index", "_x"))
    return out.select(*keep, "chunk_index", "_x.content", "_x.token_count", "_x.has_code")


def synthetic_pages(df: DataFrame, key: str, text: str, words: int = 384) -> DataFrame:
    """(key, page, text): ``words`` words a page, parted by single blanks; pages count from 1; blank texts have none."""
    w = F.filter(F.split(F.col(text), r"\s+"), lambda x: x != "")
    x = df.select(key, w.alias("w")).where(F.size("w") > 0)
    page = F.explode(F.sequence(F.lit(0), F.floor((F.size("w") - 1) / words).cast("int")))
    x = x.select(key, "w", page.alias("p"))
    return x.select(key, (F.col("p") + 1).alias("page"), F.array_join(F.slice("w", F.col("p") * words + 1, F.lit(words)), " ").alias("text"))


def text_of_pages(ranges: DataFrame, pages: DataFrame, key: str) -> DataFrame:
    """``ranges`` (key, page_start, page_end, ...) with ``text``: that of all pages in the range, both ends included, by blank lines; empty where there is none."""
    by = [key, "page_start", "page_end"]  # no made-up ids: those of a range would differ where it is computed again
    hit = ranges.select(*by).distinct().join(pages, key).where(F.col("page").between(F.col("page_start"), F.col("page_end")))
    text = hit.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("page", "text"))).alias("_l")).select(*by, F.array_join("_l.text", "\n\n").alias("text"))
    return ranges.join(text, by, "left").select(*ranges.columns, F.coalesce("text", F.lit("")).alias("text"))


def heading_position(text: Column, title: Column) -> Column:
    """0-based offset of the line that is a title, up to six blanks or digits before it allowed; then in any case; then what follows its last ':' or '>'. Null if there is none; a blank title has none."""

    def at(pattern: Column) -> Column:
        p = F.regexp_instr(text, pattern)
        return F.when(p > 0, p - 1)

    def line(t: Column, flags: str) -> Column:
        quoted = F.concat(F.lit("\\Q"), F.replace(t, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))
        return F.concat(F.lit(f"(?{flags})^[\\s\\d]{{0,6}}"), quoted, F.lit("\\s*$"))

    t = stripped(title)
    out = [at(line(t, "m")), at(line(t, "mi"))]
    for mark in (":", ">"):
        v = stripped(F.substring_index(t, mark, -1))
        out.append(F.when((v != t) & (F.length(v) > 3), at(line(v, "m"))))
    return F.when(t != "", F.coalesce(*out))  # else the blank line between pages would be its line


def split_among(df: DataFrame, group: list[str], title: str, order: str, text: str) -> DataFrame:
    """Text shared by several titles, parted at the titles' lines: ``df`` with ``part``.

    A title goes from its line to the next found one's. The only title without a
    line, if first in order, has what stands before the first found one; others
    without one have the empty text. If none is found the first has everything.
    """
    from pyspark.sql import Window

    w = Window.partitionBy(*group)
    x = df.withColumn("_at", heading_position(F.col(text), F.col(title)))
    x = x.withColumn("_next", F.lead("_at").over(w.orderBy(F.col("_at").asc_nulls_last(), order)))
    x = x.withColumn("_first", F.min("_at").over(w)).withColumn("_lost", F.sum(F.col("_at").isNull().cast("int")).over(w)).withColumn("_i", F.row_number().over(w.orderBy(order)))
    upto = F.coalesce(F.col("_next"), F.length(text))
    found = F.substring(F.col(text), F.col("_at") + 1, upto - F.col("_at"))
    before = F.substring(F.col(text), F.lit(1), F.col("_first"))
    part = F.when(F.col("_at").isNotNull(), found).when(F.col("_first").isNull() & (F.col("_i") == 1), F.col(text)).when((F.col("_lost") == 1) & (F.col("_i") == 1), before).otherwise("")
    return x.withColumn("part", stripped(part)).drop("_at", "_next", "_first", "_lost", "_i")


def _headed(text: Column, hashes: int) -> tuple[Column, Column]:
    """The headings of a markdown text, and what stands before the first and after each."""
    pattern = f"(?md)^#{{1,{hashes}}}\\s+.+$"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern)


def _section(title: Column, depth: Column, content: Column) -> Column:
    return F.struct(title.alias("title"), depth.cast("int").alias("depth"), content.alias("content"))


def _under_headings(found: Column, parts: Column, base: Column) -> Column:
    name = lambda h: stripped(F.regexp_extract(h, r"(?md)^#+\s+(.+)$", 1))
    return F.transform(found, lambda h, i: _section(name(h), F.length(F.regexp_extract(h, "^(#+)", 1)) - 1 + base, stripped(F.get(parts, i + 1))))


def _before(parts: Column, title: Column, base: Column) -> Column:
    """What stands before the first heading as a section, if it isn't blank."""
    return F.filter(F.array(_section(title, base, stripped(F.get(parts, F.lit(0))))), lambda s: s["content"] != "")


def markdown_sections(df: DataFrame, key: str, text: str, fallback: str, hashes: int = 3) -> DataFrame:
    """(key, section_ord, title, depth, content) of markdown texts of pages.

    Parted at headings of up to ``hashes`` marks; what stands before the first has
    the fallback title. Without headings: one section up to three paragraphs,
    else one for every five, titled by the first 80 characters of its first line.
    Null texts give nothing.
    """
    t = F.col(text)
    found, parts = _headed(t, hashes)
    x = once(df.where(t.isNotNull()), [key, text, fallback], _h=found, _s=parts, _p=F.filter(F.transform(F.split(t, "\n\n"), stripped), lambda p: p != ""))
    zero, title = F.lit(0), F.col(fallback)
    fives = F.transform(F.sequence(F.lit(0), F.floor((F.size("_p") - 1) / 5).cast("int")), lambda i: F.slice("_p", i * 5 + 1, F.lit(5)))
    many = F.transform(fives, lambda f: _section(F.substring(F.substring_index(F.get(f, F.lit(0)), "\n", 1), 1, 80), zero, F.array_join(f, "\n\n")))
    headed = F.concat(_before(F.col("_s"), title, zero), _under_headings(F.col("_h"), F.col("_s"), zero))
    s = F.when(F.size("_h") > 0, headed).when(F.size("_p") <= 3, F.array(_section(title, zero, stripped(t)))).otherwise(many)
    return x.select(key, F.posexplode(s).alias("section_ord", "s")).select(key, "section_ord", "s.title", "s.depth", "s.content")


def export_sections(df: DataFrame, key: str, text: str, base_depth: str, hashes: int = 6) -> DataFrame:
    """(key, section_ord, title, depth, content) of markdown texts of a workspace's export.

    Parted at headings; a text without any is one section "Content", what stands
    before the first one is "Introduction". ``base_depth``, a column, is added to
    all depths. Null texts give nothing, blank ones one empty section.
    """
    t, base = F.col(text), F.coalesce(F.col(base_depth), F.lit(0))
    found, parts = _headed(t, hashes)
    x = once(df.where(t.isNotNull()), [key, text, base_depth], _h=found, _s=parts)
    headed = F.concat(_before(F.col("_s"), F.lit("Introduction"), base), _under_headings(F.col("_h"), F.col("_s"), base))
    s = F.when(F.size("_h") > 0, headed).otherwise(F.array(_section(F.lit("Content"), base, stripped(t))))
    return x.select(key, F.posexplode(s).alias("section_ord", "s")).select(key, "section_ord", "s.title", "s.depth", "s.content")


def duplicates(df: DataFrame, key: str, content: str) -> DataFrame:
    """(key, content_hash, copies, first_key) of rows whose content another row has too; null and empty contents count as none."""
    h = df.where(F.coalesce(F.col(content), F.lit("")) != "").select(key, F.md5(content).alias("content_hash"))
    n = h.groupBy("content_hash").agg(F.count("*").alias("copies"), F.min(key).alias("first_key")).where("copies > 1")
    return h.join(n, "content_hash").select(key, "content_hash", "copies", "first_key")
