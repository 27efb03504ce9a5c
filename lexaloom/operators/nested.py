"""Deeply nested JSON trees as flat tables that keep parent-child links.

All texts of a batch are read as one array of bytes. Bitmaps of quotes (less
escaped ones), of what lies in strings, of brackets and of delimiters are
computed at once, nesting depths by prefix sums, and partners of brackets and
the bounds of keys and values from these; only nodes are then walked.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexaloom.operators.frames import frame

QUOTE, SLASH, COLON, COMMA = b'"\\:,'


@dataclass(frozen=True)
class Shape:
    """Keys of a node: its title, its children, its lists (kind of row -> key), and the key of an object that only wraps a list."""

    title: str = "title"
    children: str = "children"
    lists: tuple[tuple[str, str], ...] = (("section", "source_sections"),)
    wrapper: str = "topics"

    @property
    def wanted(self) -> frozenset[bytes]:
        return frozenset(json.dumps(k).encode() for k in (self.title, self.children, self.wrapper, *[k for _, k in self.lists]))


@dataclass
class Index:
    """Structural index of many JSON texts in one array of bytes."""

    data: bytes
    begin: np.ndarray  # first byte of each text
    sound: np.ndarray  # quotes and brackets of the text pair up
    partner: dict[int, int]  # closing bracket or quote of an opening one
    members: dict[int, dict[str, int]]  # of each object: wanted key -> first byte of its value
    commas: dict[int, list[int]]  # of each array: its delimiters


def structural_index(texts: list[bytes], wanted: frozenset[bytes]) -> Index:
    """Bitmaps, depths and spans of ``texts``."""
    data = b"\n".join(texts) + b"\n"
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    begin = np.r_[0, np.cumsum(sizes)]
    of = np.repeat(np.arange(len(texts)), sizes)
    a = np.frombuffer(data, dtype=np.uint8)
    slash = np.flatnonzero(a == SLASH)
    quote = a == QUOTE
    if len(slash):  # a character after an odd run of backslashes is escaped
        first = np.r_[True, np.diff(slash) != 1]
        run = slash[np.maximum.accumulate(np.where(first, np.arange(len(slash)), 0))]
        odd = slash[(slash - run) % 2 == 0]
        quote = quote.copy()
        quote[np.minimum(odd + 1, len(a) - 1)] = False
    marks = np.cumsum(quote)
    before = np.r_[0, marks][begin[:-1]]  # marks before each text
    inside = ((marks - before[of]) % 2 == 1) | quote
    outside = ~inside
    opening = outside & ((a == ord("{")) | (a == ord("[")))
    closing = outside & ((a == ord("}")) | (a == ord("]")))
    step = opening.astype(np.int32) - closing
    depth = np.cumsum(step)
    depth = depth - np.r_[0, depth][begin[:-1]][of]
    last = begin[1:] - 1
    lowest = np.minimum.reduceat(depth, begin[:-1]) if len(texts) else np.zeros(0)
    sound = (depth[last] == 0) & (lowest >= 0) & ((marks[last] - before) % 2 == 0)
    # brackets of one text and depth open and close in turn
    at = np.flatnonzero((opening | closing) & sound[of])
    level = np.where(opening[at], depth[at], depth[at] + 1)
    order = np.lexsort((at, level, of[at]))
    pairs = at[order].reshape(-1, 2)
    wrong = a[pairs[:, 1]] - a[pairs[:, 0]] != 2  # { and } as well as [ and ] lie two apart
    sound[of[pairs[wrong, 0]]] = False
    partner = dict(zip(pairs[:, 0].tolist(), pairs[:, 1].tolist(), strict=True))
    strings = np.flatnonzero(quote & sound[of]).reshape(-1, 2)
    partner.update(zip(strings[:, 0].tolist(), strings[:, 1].tolist(), strict=True))
    # the bracket a delimiter lies in: the last one opened at its depth
    opened = np.flatnonzero(opening & sound[of])
    key = of[opened] * (int(depth.max(initial=0)) + 2) + depth[opened]
    by = np.lexsort((opened, key))
    opened, key = opened[by], key[by]
    joint = key * len(a) + opened

    def holder(where: np.ndarray) -> np.ndarray:
        k = (of[where] * (int(depth.max(initial=0)) + 2) + depth[where]) * len(a) + where
        return opened[np.searchsorted(joint, k) - 1]

    members: dict[int, dict[str, int]] = {}
    colon = np.flatnonzero(outside & (a == COLON) & sound[of] & (depth > 0))
    if len(colon) and len(strings):
        s = np.searchsorted(strings[:, 0], colon) - 1
        held = holder(colon)
        for c, k, h in zip(colon.tolist(), s.tolist(), held.tolist(), strict=True):
            if k < 0:
                continue
            x, y = strings[k]
            name = data[x : y + 1]
            if b"\\" in name:
                name = json.dumps(json.loads(name)).encode()
            if name in wanted:
                v = c + 1
                while data[v] in b" \t\r\n" and v < len(data) - 1:
                    v += 1
                members.setdefault(h, {})[name[1:-1].decode()] = v
    commas: dict[int, list[int]] = {}
    comma = np.flatnonzero(outside & (a == COMMA) & sound[of] & (depth > 0))
    if len(comma):
        held = holder(comma)
        arrays = a[held] == ord("[")
        for c, h in zip(comma[arrays].tolist(), held[arrays].tolist(), strict=True):
            commas.setdefault(h, []).append(c)
    return Index(data, begin, sound, partner, members, commas)


class Walker:
    """Reads nodes out of an index."""

    def __init__(self, index: Index, shape: Shape) -> None:
        self.x, self.data, self.shape = index, index.data, shape

    def skip(self, v: int) -> int:
        while v < len(self.data) - 1 and self.data[v] in b" \t\r\n":
            v += 1
        return v

    def text(self, v: int) -> str | None:
        """A scalar as text; null for null and for containers."""
        c = self.data[v : v + 1]
        if c == b'"':
            raw = self.data[v : self.x.partner[v] + 1]
            try:
                return json.loads(raw) if b"\\" in raw else raw[1:-1].decode("utf-8", "replace")
            except ValueError:
                return raw[1:-1].decode("utf-8", "replace")
        if c in (b"{", b"[", b""):
            return None
        e = v
        while self.data[e] not in b",]} \t\r\n":
            e += 1
        word = self.data[v:e].decode("utf-8", "replace")
        return None if word in ("null", "") else word

    def entries(self, v: int) -> list[int]:
        """First bytes of a list's entries: of an array, of the list in {"topics": ...}, or the lone element; none for null."""
        v = self.skip(v)
        c = self.data[v : v + 1]
        if c == b"[":
            starts = [self.skip(k + 1) for k in (v, *self.x.commas.get(v, ()))]
            return [] if len(starts) == 1 and self.data[starts[0] : starts[0] + 1] == b"]" else starts
        if c == b"{":
            inner = self.x.members.get(v, {})
            return self.entries(inner[self.shape.wrapper]) if self.shape.wrapper in inner else [v]
        return [] if self.text(v) is None else [v]

    def walk(self, v: int, path: str, titles: list, out_nodes: list, out_items: list) -> None:
        """Nodes below ``path`` of the list at ``v`` and the entries of their lists, without recursion."""
        shape, stack = self.shape, [(v, path, titles)]
        while stack:
            at, parent, above = stack.pop()
            for k, e in enumerate(self.entries(at)):
                if self.data[e : e + 1] != b"{":
                    continue  # null, or no node
                inner = self.x.members.get(e, {})
                own = f"{parent}.{k}"
                title = self.text(inner[shape.title]) if shape.title in inner else None
                line = [*above, title]
                out_nodes.append((parent, own, k, title, line))
                for kind, name in shape.lists:
                    for i, s in enumerate(self.entries(inner[name])) if name in inner else ():
                        t = self.text(s)
                        if t is not None and t.strip():
                            out_items.append((kind, own, i, t))
                if shape.children in inner:
                    stack.append((inner[shape.children], own, line))


def flatten(rows: DataFrame, key: str, group: str, title: str, sections: str | None, children: str, shape: Shape = Shape(), more: dict[str, str] | None = None) -> DataFrame:
    """Rows of all trees: (key, group, kind, path, parent_path, position, title, titles).

    kind 'topic': a node, roots included (path '0', no parent); title is the
    node's, titles those from the root to it. Other kinds, which ``shape`` names:
    an entry of a node's list that is neither null nor blank; path is the node's,
    title the entry. ``sections`` is the root's column for kind 'section', ``more``
    has those of other kinds. Null, empty and broken JSON gives the root only;
    unknown keys are passed over; of a key given twice the last counts; null
    entries of a list take a position but are no nodes, nor are scalars. Rows
    stand on their own.
    """
    kinds = {f: rows.schema[f].dataType.simpleString() for f in (key, group)}
    whole = ("position", *[c for c, f in (("key", key), ("grp", group)) if kinds[f] in ("bigint", "int")])
    columns = ["key", "grp", "kind", "path", "parent_path", "position", "title", "titles"]
    lists = ({"section": sections} if sections else {}) | (more or {})
    wanted = shape.wanted

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for lo in range(0, len(pdf), 2000):
                some = pdf.iloc[lo : lo + 2000]
                index = structural_index([(c or "").encode("utf-8", "surrogatepass") for c in some["c"]], wanted)
                w, out = Walker(index, shape), []
                for i, (k, g, t) in enumerate(zip(some["k"], some["g"], some["t"], strict=True)):
                    out.append((k, g, "topic", "0", None, 0, t, [t]))
                    nodes, items = [], []
                    start = index.begin[i]
                    if index.sound[i] and len(index.data[start : index.begin[i + 1]].strip()):
                        w.walk(int(start), "0", [t], nodes, items)
                    out += [(k, g, "topic", p, parent, pos, name, line) for parent, p, pos, name, line in nodes]
                    out += [(k, g, kind, p, None, pos, s, None) for kind, p, pos, s in items]
                for kind in lists:
                    for k, g, own in zip(some["k"], some["g"], some[f"l_{kind}"], strict=True):
                        if own is not None:
                            out += [(k, g, kind, "0", None, p, s, None) for p, s in enumerate(own) if s is not None and s.strip()]
                yield frame(out, columns, whole)

    own = [F.col(c).alias(f"l_{kind}") for kind, c in lists.items()]
    read = rows.where(F.col(key).isNotNull()).select(F.col(key).alias("k"), F.col(group).alias("g"), F.col(title).alias("t"), F.col(children).alias("c"), *own)
    return read.mapInPandas(part, f"key {kinds[key]}, grp {kinds[group]}, kind string, path string, parent_path string, position int, title string, titles array<string>")


def topics(flat: DataFrame) -> DataFrame:
    """(structure_id, curriculum_id, path, parent_path, position, depth, title)."""
    t = flat.where("kind = 'topic'")
    return t.select(F.col("key").alias("structure_id"), F.col("grp").alias("curriculum_id"), "path", "parent_path", "position", (F.size("titles") - 1).alias("depth"), "title")


def section_references(flat: DataFrame) -> DataFrame:
    """(structure_id, path, position, section)."""
    return flat.where("kind = 'section'").select(F.col("key").alias("structure_id"), "path", "position", F.col("title").alias("section"))


def assignments(flat: DataFrame, chunks: DataFrame) -> DataFrame:
    """(structure_id, path, chunk_id): chunks whose topic_path is, title by title, that of a node in the same curriculum.

    Paths with a null title, and null or empty paths, match nothing.
    """
    whole = ~F.exists("titles", lambda t: t.isNull())
    nodes = flat.where((F.col("kind") == "topic") & whole).select(F.col("key").alias("structure_id"), F.col("grp").alias("curriculum_id"), "path", F.col("titles").alias("topic_path"))
    cited = chunks.where(F.size("topic_path") > 0).select("chunk_id", "curriculum_id", "topic_path")
    return cited.join(nodes, ["curriculum_id", "topic_path"]).select("structure_id", "path", "chunk_id")


def links(flat: DataFrame, chunks: DataFrame) -> DataFrame:
    """(structure_id, link_kind, parent_path, item) of all three kinds of links."""
    t = flat.where("kind = 'topic' and parent_path is not null").select(F.col("key").alias("structure_id"), F.lit("child").alias("link_kind"), "parent_path", F.col("path").alias("item"))
    s = section_references(flat).select("structure_id", F.lit("section").alias("link_kind"), F.col("path").alias("parent_path"), F.col("position").cast("string").alias("item"))
    c = assignments(flat, chunks).select("structure_id", F.lit("chunk").alias("link_kind"), F.col("path").alias("parent_path"), F.col("chunk_id").cast("string").alias("item"))
    return t.unionByName(s).unionByName(c)
