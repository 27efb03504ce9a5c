"""Scalar functions over text, titles, paths and blocks, all as column expressions.

Nulls give null unless a docstring says otherwise.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# File kinds by extension, hosts of videos and of the workspace service.
KIND_OF_EXTENSION = {
    "pdf": "pdf", "docx": "office", "pptx": "office", "csv": "tabular", "tsv": "tabular", "zip": "notion", "mp4": "video", "m4a": "video",
    "mkv": "video", "webm": "video", "mov": "video", "mp3": "video", "wav": "video",
}
VIDEO_HOSTS = ["www.youtube.com", "youtube.com", "youtu.be", "m.youtube.com", "music.youtube.com", "www.vimeo.com", "vimeo.com", "player.vimeo.com", "www.twitch.tv", "twitch.tv"]
WORKSPACE_HOSTS = ["www.notion.so", "notion.so"]
# What a line of code begins with.
CODE_STARTS = [
    "def ", "class ", "import ", "from ", "return ", "if ", "for ", "while ", "try:", "except", "public ", "private ", "void ", "int ", "String ",
    "{", "}", "//", "/*", "#include", "package ",
]
# Prefixes of titles, the first that matches is taken off.
TITLE_PREFIXES = [
    r"(?i)^Chapter\s+\d+(\.\d+)?[:.]?\s+", r"^Ch\.\s*\d+\s+", r"^\d+\.\d+\.\d+\s+", r"^\d+\.\d+\s+", r"^\d+\.\s+(?=[A-Z])", r"^\d+:\s+(?=[A-Z])",
    r"^\d+\s+(?=[A-Z])", r"(?i)^Part\s+[IVX0-9]+[:.]?\s*", r"(?i)^Section\s+\d+[:.]?\s*",
]
# Titles of what stands around a book's content.
META_TITLES = [
    "cover", "credits", "foreword", "dedication", "index", "colophon", "epilogue", "acknowledgments", "acknowledgements", "errata", "contributors",
    "brief contents", "table of contents", "toc", "about packt", "about the publisher", "about the author", "about this book", "about the book",
    "about the cover", "book forum", "back of the book", "questions", "summary", "exercises",
]
META_PHRASES = (
    r"\b(who should read|how (this|the) book|why we (wrote|updated)|navigating this book|conventions used|using code examples"
    r"|online (learning|resources)|how to contact|further reading|technical requirements|what you.?ll need)\b"
)
FRONT_TITLES = [
    "title page", "copyright page", "copyright", "dedication", "contents", "table of contents", "foreword", "preface", "acknowledgments",
    "acknowledgements", "about the author", "about the authors", "on the cover", "praise for", "other books", "more praise", "endorsements",
]
FRONT_STARTS = ["praise for", "other books by", "also by"]
# Words that tell a topic's level, in order of precedence.
LEVEL_WORDS = [
    ("understand", ["what is", "what are", "what does", "what do", "definition"]),
    ("apply", ["how do you", "how does", "how can", "how should", "implement", "build", "write", "test-drive", "refactor"]),
    ("evaluate", ["why ", "why is", "why are", "why should", "why do", "why must", "why can"]),
    ("analyze", ["when should", "when is", "when do"]),
    ("create", ["design", "create", "propose", "plan"]),
    ("analyze", ["compare", "differ", "contrast", "trade-off", "vs"]),
]
# Openings of questions, taken off one after another.
QUESTION_OPENINGS = [
    "^What [Ii]s (the |an? )?", "^What [Aa]re (the )?", "^What [Dd]oes ", "^What [Dd]o ", "^How [Dd]o [Yy]ou ", "^How [Dd]oes ", "^How [Cc]an ",
    "^How [Ss]hould ", "^How [Dd]o ", "^Why [Ii]s ", "^Why [Aa]re ", "^Why [Ss]hould ", "^Why [Dd]o ", "^Why [Dd]oes ", "^Why [Mm]ust ",
    "^Why [Cc]an't ", "^Why [Cc]an ", "^When [Ss]hould ", "^When [Ii]s ", "^When [Dd]o ", "^Did ", "^Can ", "^Should ", "^Is ", "^Are ", "^Does ",
]
# Texts of objectives by level; {} stands for the concept.
PARENT_OBJECTIVES = [
    ("Explain the key concepts within {}", "understand", None),
    ("Apply the principles of {} to software design problems", "apply", ("apply", "create")),
    ("Evaluate the trade-offs involved in {}", "evaluate", ("evaluate", "analyze")),
]
LEAF_OBJECTIVES = {
    "understand": [("Describe {} and its role in software engineering", "understand"), ("Identify examples of {} in real codebases", "apply")],
    "apply": [("Explain the purpose of {}", "understand"), ("Implement {} in a software project", "apply"), ("Evaluate when to use {} versus alternative approaches", "evaluate")],
    "analyze": [("Describe the factors involved in {}", "understand"), ("Analyze {} in the context of software design decisions", "analyze"), ("Justify decisions regarding {} with evidence", "evaluate")],
    "evaluate": [("Explain {}", "understand"), ("Evaluate the reasoning behind {}", "evaluate"), ("Argue for or against {} in specific scenarios", "evaluate")],
    "create": [("Explain the goals of {}", "understand"), ("Design a solution using {}", "create"), ("Evaluate the quality of a {} implementation", "evaluate")],
}
# Verbs of objectives by level.
LEVEL_VERBS = {
    "remember": ["list", "identify", "name", "define", "recall", "recognize", "state"],
    "understand": ["explain", "describe", "summarize", "interpret", "classify", "compare", "distinguish"],
    "apply": ["implement", "use", "demonstrate", "apply", "execute", "solve", "construct"],
    "analyze": ["analyze", "differentiate", "examine", "contrast", "categorize", "deconstruct"],
    "evaluate": ["evaluate", "justify", "assess", "critique", "judge", "defend", "argue"],
    "create": ["design", "create", "propose", "formulate", "develop", "compose", "plan"],
}


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of ``value``, which is computed once: a lambda's variable isn't put in place of every use, as an expression would be."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def title_case(c: Column) -> Column:
    """Every letter after another in lower case, all others in upper case."""
    one = lambda s: F.transform(s, lambda ch, i: F.when((i > 0) & F.coalesce(F.get(s, i - 1).rlike(r"^\p{L}$"), F.lit(False)), F.lower(ch)).otherwise(F.upper(ch)))
    return F.array_join(let(F.split(c, ""), one), "")


def stripped(c: Column) -> Column:
    """Without blanks, line ends and no-break blanks at both ends."""
    return F.btrim(c, F.lit(" \t\n\x0b\f\r\u00a0"))


def word_count(c: Column) -> Column:
    """Words parted by blanks; 0 for the empty text."""
    return F.size(F.filter(F.split(c, r"\s+"), lambda x: x != "")).cast("long")


def host_of(c: Column) -> Column:
    return F.lower(F.regexp_extract(c, r"^https?://([^/?#]*)", 1))


def source_kind(source: Column) -> Column:
    """Kind of a source by scheme, host and extension; paths that name no known kind of file are folders of code."""
    ext = F.lower(F.regexp_extract(source, r"\.([^./\\]+)$", 1))
    kinds = F.create_map(*[F.lit(x) for pair in KIND_OF_EXTENSION.items() for x in pair])
    web = F.when(host_of(source).isin(WORKSPACE_HOSTS), "notion_api").when(host_of(source).isin(VIDEO_HOSTS), "video").otherwise("web")
    return (
        F.when(source.isNull(), F.lit(None).cast("string"))
        .when(source.startswith("notion://"), "notion_api")
        .when(source.rlike("^https?://"), web)
        .otherwise(F.coalesce(F.try_element_at(kinds, ext), F.lit("code")))
    )


def output_name(source: Column) -> Column:
    """File name for a source's output: host and path with underscores, or the last part of the path without extension."""
    url = F.regexp_replace(F.regexp_replace(F.regexp_extract(source, r"^[a-z_]+://([^?#]*)", 1), "/+$", ""), "/", "_")
    stem = F.regexp_replace(F.regexp_extract(source, r"([^/]*)/*$", 1), r"(?<=.)\.[^.]*$", "")
    return F.concat(F.when(source.rlike("^[a-z_]+://"), url).otherwise(stem), F.lit(".json"))


def is_code(text: Column) -> Column:
    """True if over 0.3 of the lines look like code, lines that are only indented counting half; false for a single line."""
    lines = F.split(stripped(text), "\n")
    starts = "^(" + "|".join(x.replace("{", r"\{").replace("}", r"\}").replace("*", r"\*") for x in CODE_STARTS) + ")"
    score = lambda x: F.when(stripped(x).rlike(starts), 2).when(x.rlike(r"^\s{2,}") & (stripped(x) != ""), 1).otherwise(0)
    total = F.aggregate(F.transform(lines, score), F.lit(0), lambda a, b: a + b)
    return (F.size(lines) >= 2) & (total * 10 > F.size(lines) * 6)


def is_heading(text: Column) -> Column:
    return stripped(text).rlike(r"^#{1,6}\s")


def clean_title(c: Column) -> Column:
    """No-break blanks and line breaks as blanks, one pass of double to single, ends stripped."""
    return stripped(F.replace(F.translate(c, " \n", "  "), F.lit("  "), F.lit(" ")))


def normalized(title: Column) -> Column:
    """A title as it is looked up: no-break blanks as blanks, ends stripped."""
    return stripped(F.replace(title, F.lit("\u00a0"), F.lit(" ")))


def strip_prefix(title: Column) -> Column:
    """Title without its first matching prefix ("Chapter 4: ", "1.2 "); one prefix a pass."""
    t = clean_title(title)
    out = t
    for p in reversed(TITLE_PREFIXES):
        out = F.when(F.regexp_replace(t, p, "") != t, stripped(F.regexp_replace(t, p, ""))).otherwise(out)
    return out


def is_book_meta(title: Column) -> Column:
    """True for titles of front and back matter; false for null and blank."""
    t = F.regexp_replace(F.lower(clean_title(title)), "[?.!]+$", "")
    return F.coalesce((t != "") & (t.isin(META_TITLES) | t.rlike(META_PHRASES)), F.lit(False))


def is_front_matter(title: Column) -> Column:
    t = F.lower(stripped(title))
    out = t.isin(FRONT_TITLES)
    for s in FRONT_STARTS:
        out = out | t.startswith(s)
    return out


def is_citation(title: Column) -> Column:
    return title.rlike(r"^\[.+\]\.?$")


def is_scanned(text: Column) -> Column:
    """True if a page's text is under 50 characters or less than half of it letters, digits and blanks."""
    t = stripped(text)
    kept = F.length(F.regexp_replace(t, r"[^\p{L}\p{N}\s]", ""))
    return (F.length(t) < 50) | (kept * 2 < F.length(t))


def topic_level(title: Column) -> Column:
    """Level of a topic by the first group of words its title holds."""
    t, out = F.lower(title), F.lit("understand")
    for level, words in reversed(LEVEL_WORDS):
        hit = F.contains(t, F.lit(words[0]))
        for w in words[1:]:
            hit = hit | F.contains(t, F.lit(w))
        out = F.when(hit, level).otherwise(out)
    return F.when(title.isNotNull(), out)


def concept(title: Column) -> Column:
    """Title without question marks at its end and openings of questions."""
    c = F.regexp_replace(title, r"\?+$", "")
    for p in QUESTION_OPENINGS:
        c = F.regexp_replace(c, p, "")
    return stripped(c)


def objectives(title: Column, has_children: Column) -> Column:
    """array<struct<text, bloom_level>>: 1 or 2 for topics with children, 2 or 3 for leaves."""
    level, name = topic_level(title), concept(title)

    def one(text: str, bloom: str) -> Column:
        a, b = text.split("{}")
        return F.struct(F.concat(F.lit(a), name, F.lit(b)).alias("text"), F.lit(bloom).alias("bloom_level"))

    none = F.filter(F.array(one("{}", "")), lambda x: F.lit(False))
    parent = F.array(one(*PARENT_OBJECTIVES[0][:2]))
    for text, bloom, levels in PARENT_OBJECTIVES[1:]:
        parent = F.concat(parent, F.when(level.isin(*levels), F.array(one(text, bloom))).otherwise(none))
    leaf = none
    for lv, texts in LEAF_OBJECTIVES.items():
        leaf = F.when(level == lv, F.array(*[one(*t) for t in texts])).otherwise(leaf)
    return F.when(title.isNotNull(), F.when(has_children, parent).otherwise(leaf))


def clock(seconds: Column) -> Column:
    """MM:SS, from an hour on HH:MM:SS."""
    s = F.floor(seconds).cast("long")
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    h = F.floor(s / 3600)
    return F.when(h > 0, F.concat_ws(":", F.when(h > 99, h.cast("string")).otherwise(two(h)), two(F.floor(s % 3600 / 60)), two(s % 60))).otherwise(F.concat_ws(":", two(F.floor(s / 60)), two(s % 60)))


def slug(c: Column) -> Column:
    return F.replace(F.lower(c), F.lit(" "), F.lit("-"))


def slug_title(path: Column) -> Column:
    """Last part of a path as a title."""
    return title_case(F.replace(F.replace(F.regexp_extract(path, r"([^/]*)$", 1), F.lit("-"), F.lit(" ")), F.lit(".html"), F.lit("")))


def path_prefix(path: Column) -> Column:
    """Scope of a crawl: a path that ends in a slash as it is, else without its extension; '/' for none."""
    cut = F.regexp_replace(path, r"(?<=[^/])\.[^./]*$", "")
    return F.when(path.isNull() | (path == "") | (path == "/"), "/").when(path.endswith("/"), path).otherwise(cut)


def url_path(c: Column) -> Column:
    return F.regexp_extract(c, r"^https?://[^/?#]*([^?#]*)", 1)


def workspace_id(c: Column) -> Column:
    """An id with dashes: a dashed one first, else 32 hexadecimal digits; null if there is neither."""
    dashed = F.lower(F.regexp_extract(c, r"([0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12})", 1))
    plain = F.lower(F.regexp_extract(c, r"([0-9a-fA-F]{32})", 1))
    parted = F.regexp_replace(plain, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    return F.when(dashed != "", dashed).when(plain != "", parted)


def rich_text(parts: Column) -> Column:
    """Markdown of array<struct<plain_text, annotations: struct<code, bold, italic, strikethrough>, href>>; empty for null."""

    def one(p: Column) -> Column:
        t = F.coalesce(p["plain_text"], F.lit(""))
        for mark, around in (("code", "`"), ("bold", "**"), ("italic", "*"), ("strikethrough", "~~")):
            t = F.when(F.coalesce(p["annotations"][mark], F.lit(False)), F.concat(F.lit(around), t, F.lit(around))).otherwise(t)
        return F.when(F.coalesce(p["href"], F.lit("")) != "", F.concat(F.lit("["), t, F.lit("]("), p["href"], F.lit(")"))).otherwise(t)

    return F.coalesce(F.array_join(F.transform(parts, one), ""), F.lit(""))


def block_markdown(kind: Column, text: Column, checked: Column, language: Column, icon: Column, url: Column) -> Column:
    """Markdown of one block of a workspace page; empty for unknown kinds."""
    t, e = F.coalesce(text, F.lit("")), F.lit("")
    level = F.coalesce(F.try_to_number(F.substring(kind, -1, 1), F.lit("9")).cast("int"), F.lit(1))
    return (
        F.when(kind == "paragraph", t)
        .when(kind == "quote", F.concat(F.lit("> "), F.replace(t, F.lit("\n"), F.lit("\n> "))))
        .when(kind == "callout", F.concat(F.lit("> "), F.coalesce(icon, e), F.lit(" "), t))
        .when(kind.startswith("heading_"), F.concat(F.repeat(F.lit("#"), level), F.lit(" "), t))
        .when(kind == "bulleted_list_item", F.concat(F.lit("- "), t))
        .when(kind == "numbered_list_item", F.concat(F.lit("1. "), t))
        .when(kind == "to_do", F.concat(F.lit("- ["), F.when(checked, "x").otherwise(" "), F.lit("] "), t))
        .when(kind == "code", F.concat(F.lit("```"), F.coalesce(language, e), F.lit("\n"), t, F.lit("\n```")))
        .when(kind == "divider", "---")
        .when(kind == "toggle", F.concat(F.lit("<details><summary>"), t, F.lit("</summary></details>")))
        .when(kind == "table_row", F.concat(F.lit("| "), t, F.lit(" |")))
        .when(kind == "image", F.concat(F.lit("!["), t, F.lit("]("), F.coalesce(url, e), F.lit(")")))
        .otherwise("")
    )


def without_nul(c: Column) -> Column:
    return F.replace(c, F.lit("\u0000"), F.lit(""))


def table_cell(c: Column) -> Column:
    """A value as a cell of a markdown table; empty for null."""
    return F.replace(F.coalesce(c.cast("string"), F.lit("")), F.lit("|"), F.lit("\\|"))


def mime_type(ext: Column) -> Column:
    e = F.lower(F.regexp_replace(ext, r"^\.", ""))
    return F.concat(F.lit("image/"), F.when(e == "jpg", "jpeg").otherwise(e))


def compression(original: Column, condensed: Column) -> Column:
    """Original over condensed size in tenths, halves to even; a condensed size under 1 counts as 1."""
    return F.bround(original / F.greatest(condensed, F.lit(1)), 1)
