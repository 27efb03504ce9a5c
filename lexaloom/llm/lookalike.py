"""One form for text that looks the same but differs in its characters.

Classes of look-alikes are the components of a graph over code points and short
strings (union-find): compatibility forms, joined letters, kinds of blanks,
invisible characters and letters of other scripts with the same shape. The
member of a class that is most frequent in the corpus stands for it, and titles
are rewritten by one automaton over all members, longest match first.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexaloom.session import cut

# Letters of other scripts drawn like a Latin letter.
SAME_SHAPE = {
    "A": "АΑᎪ", "B": "ВΒᏴ", "C": "СϹᏟ", "D": "Ꭰ", "E": "ЕΕᎬ", "F": "Ϝ", "G": "ԌᏀ", "H": "НΗᎻ", "I": "ІΙӀ", "J": "ЈᎫ",
    "K": "КΚᏦ", "L": "Ꮮ", "M": "МΜϺᎷ", "N": "Ν", "O": "ОΟՕ", "P": "РΡᏢ", "Q": "Ԛ", "S": "ЅՏᏚ", "T": "ТΤᎢ", "U": "Ս",
    "V": "ѴᏙ", "W": "ԜᎳ", "X": "ХΧ", "Y": "ҮΥ", "Z": "ΖᏃ",
    "a": "аɑ", "c": "сϲ", "d": "ԁ", "e": "е", "g": "ɡց", "h": "һհ", "i": "і", "j": "јϳ", "l": "ӏ", "n": "ո", "o": "оοօ",
    "p": "рρ", "q": "ԛզ", "s": "ѕ", "u": "ս", "v": "ѵν", "w": "ԝ", "x": "х", "y": "уγ", "-": "‐‑",
}
# Code points that show nothing.
INVISIBLE = [
    0xAD, 0x34F, 0x61C, 0x115F, 0x1160, 0x17B4, 0x17B5, *range(0x180B, 0x1810), *range(0x200B, 0x2010), *range(0x202A, 0x202F),
    *range(0x2060, 0x2070), *range(0xFE00, 0xFE10), 0xFEFF, 0xFFA0,
]
# Kinds of compatibility forms that keep the look.
KEEPS_LOOK = {"<wide>", "<narrow>", "<noBreak>", "<compat>", "<font>", "<initial>", "<medial>", "<final>", "<isolated>"}


class Classes:
    """Union-find over strings."""

    def __init__(self) -> None:
        self.up: dict[str, str] = {}

    def find(self, x: str) -> str:
        root = x
        while self.up.setdefault(root, root) != root:
            root = self.up[root]
        while self.up[x] != root:
            self.up[x], x = root, self.up[x]
        return root

    def union(self, a: str, b: str) -> None:
        self.up[self.find(a)] = self.find(b)

    def members(self) -> dict[str, list[str]]:
        out: dict[str, list[str]] = {}
        for x in list(self.up):
            out.setdefault(self.find(x), []).append(x)
        return out


def plain(ch: str) -> str:
    """What one code point is a compatibility form of, if that form looks alike."""
    kind, _, rest = unicodedata.decomposition(ch).partition(" ")
    if kind in KEEPS_LOOK:
        return "".join(plain(chr(int(x, 16))) for x in rest.split())
    return ch


def code_points(df: DataFrame, column: str) -> DataFrame:
    """Occurrences of each code point; as many rows as there are code points at most (1.1 million)."""
    return df.select(F.explode(F.split(F.col(column), "")).alias("cp")).groupBy("cp").agg(F.count("*").alias("n")).where("cp <> ''")


def rewriting(counts: Iterable[tuple[str, int]]) -> dict[str, str]:
    """Member -> representative of every class that has a member in the corpus."""
    n: dict[str, int] = {}
    for text, k in counts:
        for ch in unicodedata.normalize("NFD", text):
            n[ch] = n.get(ch, 0) + k
    classes = Classes()
    for ch in n:
        form = plain(ch)
        if form != ch:
            classes.union(ch, unicodedata.normalize("NFD", form))
        if unicodedata.category(ch) == "Zs" or ch in "\t\n\r\x0b\x0c\x85":
            classes.union(ch, " ")
    for cp in INVISIBLE:
        classes.union(chr(cp), "")
    for letter, others in SAME_SHAPE.items():
        for other in others:
            classes.union(other, letter)

    def weight(x: str) -> tuple:
        if not x or x == " ":
            return (1 << 62, 0, "")
        return (min(n.get(ch, 0) for ch in x), -len(x), "".join(chr(0x10FFFF - ord(ch)) for ch in x))

    out = {}
    for members in classes.members().values():
        best = max(members, key=weight)
        out |= {x: best for x in members if x != best}
    # a representative may hold members of other classes ("fi" written wide)
    for x, best in out.items():
        out[x] = "".join(out.get(ch, ch) for ch in best)
    return out


def automaton(rules: dict[str, str]) -> ahocorasick.Automaton:
    """The automaton that finds every member."""
    auto = ahocorasick.Automaton()
    for x, best in rules.items():
        if x:
            auto.add_word(x, (len(x), best))
    auto.make_automaton()
    return auto


def one_form(text: str | None, auto: ahocorasick.Automaton) -> str | None:
    """``text`` with every member replaced, leftmost and longest first, and blanks single; null stays null."""
    if text is None:
        return None
    text = unicodedata.normalize("NFD", text)
    parts, at = [], 0
    for end, (size, best) in auto.iter_long(text):
        parts += (text[at : end + 1 - size], best)
        at = end + 1
    parts.append(text[at:])
    return unicodedata.normalize("NFC", " ".join("".join(parts).split()))


def one_form_column(df: DataFrame, column: str, out: str, counted: DataFrame | None = None) -> DataFrame:
    """``df`` with ``out``: ``column`` in one form.

    Null gives null, text of invisible characters only gives the empty string;
    all other columns pass through, ``out`` replaces a column of that name.
    Counts are over all rows, of ``counted`` where that is given; what reaches the driver is one row a code point.
    """
    rules = rewriting((r.cp, r.n) for r in code_points(df if counted is None else counted, column).toLocalIterator())
    shared = df.sparkSession.sparkContext.broadcast(rules)  # at most a few entries a code point

    @F.pandas_udf("string")
    def rewrite(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        auto = automaton(shared.value)
        for s in batches:
            known: dict = {}
            yield s.map(lambda t: known[t] if t in known else known.setdefault(t, one_form(t, auto)), na_action="ignore")

    return df.withColumn(out, rewrite(F.col(column)))


def look_alike_classes(df: DataFrame, group: str, key: str, title: str) -> DataFrame:
    """(group, form, key, title, records, spellings): records of one group whose titles look the same but differ, a row a record.

    The pairs of ``look_alike_pairs`` are those within a (group, form) whose titles
    differ; this form of the result grows with the records alone.
    """
    formed = cut(one_form_column(df.select(F.col(group).alias("g"), F.col(key).alias("k"), F.col(title).alias("t")).where("t is not null and t <> ''"), "t", "form").where("form <> ''"))
    classes = formed.groupBy("g", "form").agg(F.count("*").alias("records"), F.countDistinct("t").alias("spellings")).where("spellings > 1")
    return formed.join(classes, ["g", "form"]).select(F.col("g").alias(group), "form", F.col("k").alias(key), F.col("t").alias(title), "records", "spellings")


def look_alike_pairs(df: DataFrame, group: str, key: str, title: str) -> DataFrame:
    """Pairs of records of one group whose titles look the same but differ as strings.

    df: one row a record. Null titles and those that show nothing don't count.
    Classes without two spellings are dropped, spellings are paired, and only then
    the records that have them: records of equal spelling never meet.
    """
    rows = cut(df.select(F.col(group).alias("g"), F.col(key).alias("k"), F.col(title).alias("t")).where("t is not null and t <> ''"))
    forms = cut(one_form_column(rows.select("t").distinct(), "t", "form", rows).where("form <> ''"))  # every title is rewritten once
    formed = rows.join(forms, "t")
    classes = formed.groupBy("g", "form").agg(F.min("t").alias("a"), F.max("t").alias("b")).where("a <> b").select("g", "form")
    rows = cut(formed.join(classes, ["g", "form"]))  # the few that have several spellings
    spelled = rows.select("g", "form", "t").distinct()
    two = spelled.select("g", "form", F.col("t").alias("ta")).join(spelled.select("g", "form", F.col("t").alias("tb")), ["g", "form"]).where("ta < tb").select("g", "ta", "tb")
    x = two.join(rows.select("g", F.col("t").alias("ta"), F.col("k").alias("x")).distinct(), ["g", "ta"])
    x = x.join(rows.select("g", F.col("t").alias("tb"), F.col("k").alias("y")).distinct(), ["g", "tb"]).where("x <> y")
    return x.select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b")).distinct()
