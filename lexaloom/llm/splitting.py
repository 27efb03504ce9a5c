"""Cutting oversized texts into pieces at natural boundaries.

A text is first parted into atomic segments; adjacent segments are then merged,
the weakest boundary first, as long as the merged size and the overlap fit the
limit. The boundaries that remain are the cuts.
"""

from __future__ import annotations

import heapq
import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexaloom.llm.tokens import VOCABULARY, Counter

# Kinds of boundaries, strongest first; a boundary is the end of a match.
BOUNDARIES = [
    (7, re.compile(r"\n[ \t]*\n\s*(?=#{1,6}[ \t])")),
    (6, re.compile(r"\n[ \t]*\n\s*")),
    (5, re.compile(r"\n(?=[ \t]*(?:[-*•]|\d{1,3}[.)])[ \t])")),
    (4, re.compile(r"(?:[.!?…][\"'”’»)\]]*\s+|[。！？।॥؟۔][”’」』）»]*\s*)")),
    (3, re.compile(r"\n+")),
    (2, re.compile(r"[,;:،؛]\s+|[，；：、]")),
    (1, re.compile(r"\s+")),
]
FENCE = re.compile(r"^[ \t]*(```|~~~)", re.M)


def _fences(text: str) -> list[tuple[int, int]]:
    at = [m.start() for m in FENCE.finditer(text)]
    return list(zip(at[::2], at[1::2] + [len(text)] * (len(at) % 2), strict=True))


def atoms(text: str, room: int) -> list[tuple[int, int]]:
    """(end, strength) of atomic segments, none over ``room`` characters; coarse segments are parted further only where they must be."""
    cuts: dict[int, int] = {}
    for strength, pattern in BOUNDARIES[:4]:
        for m in pattern.finditer(text):
            if 0 < m.end() < len(text):
                cuts.setdefault(m.end(), strength)
    for a, b in _fences(text):  # inside fenced code blank lines part less than paragraphs do
        for c in [c for c in cuts if a < c < b]:
            cuts[c] = 3 if text[c - 1] == "\n" else 0
        cuts = {c: s for c, s in cuts.items() if s}
    edges = [0, *sorted(cuts), len(text)]
    for a, b in zip(edges, edges[1:], strict=False):
        if b - a > room:
            _part(text, a, b, room, 4, cuts)
    out = sorted(cuts.items())
    return [*out, (len(text), 9)]


def _part(text: str, a: int, b: int, room: int, level: int, cuts: dict[int, int]) -> None:
    """Parts text[a:b] by ever weaker boundaries; the last way is a cut at ``room`` characters, not before a combining mark."""
    if b - a <= room:
        return
    if level == len(BOUNDARIES):
        at = a
        while b - at > room:
            end = at + room
            while end > at + 1 and unicodedata.combining(text[end]):
                end -= 1
            if end == at + 1:
                end = at + room
            cuts[end] = 0
            at = end
        return
    strength, pattern = BOUNDARIES[level]
    inner = [m.end() for m in pattern.finditer(text, a, b) if a < m.end() < b]
    for c in inner:
        cuts.setdefault(c, strength)
    edges = [a, *inner, b]
    for x, y in zip(edges, edges[1:], strict=False):
        _part(text, x, y, room, level + 1, cuts)


def pieces(text: str, limit: int, overlap: int) -> list[tuple[int, int]]:
    """Pieces of ``text`` as [start, end): all at most ``limit`` long, each but the first beginning ``overlap`` characters before the last one's end.

    A text within the limit is one piece, the empty text none.
    """
    if overlap < 0 or limit <= overlap:
        raise ValueError("the limit must exceed the overlap, which can't be negative")
    if not text:
        return []
    if len(text) <= limit:
        return [(0, len(text))]
    room = limit - overlap
    seg = atoms(text, room)
    n = len(seg)
    start = [0, *[e for e, _ in seg[:-1]]]
    end = [e for e, _ in seg]
    strength = [s for _, s in seg]
    left, right, alive = list(range(-1, n - 1)), list(range(1, n + 1)), [True] * n
    heap = [(strength[i], end[i + 1] - start[i], i, i + 1) for i in range(n - 1)]
    heapq.heapify(heap)
    while heap:
        s, size, i, j = heapq.heappop(heap)
        if not (alive[i] and alive[j]) or right[i] != j or end[j] - start[i] != size:
            continue
        if size > room:
            continue  # sizes only grow: this boundary stays
        end[i], strength[i], alive[j], right[i] = end[j], strength[j], False, right[j]
        if right[i] < n:
            left[right[i]] = i
            heapq.heappush(heap, (strength[i], end[right[i]] - start[i], i, right[i]))
        if left[i] >= 0:
            p = left[i]
            heapq.heappush(heap, (strength[p], end[i] - start[p], p, i))
    return [(max(0, start[i] - overlap), end[i]) for i in range(n) if alive[i]]


def split_oversized(df: DataFrame, key: str, text: str, limit: str, overlap: str, path: str = VOCABULARY) -> DataFrame:
    """(key, piece, start_char, end_char, content, token_count) of the rows whose text is longer than ``limit``.

    ``limit`` and ``overlap`` are columns. Rows with a null key, text or limit and
    rows within the limit give nothing; repeated rows give repeated pieces; other
    columns are ignored. Rows are handled on their own, without a shuffle.
    """
    kind = df.schema[key].dataType.simpleString()

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = Counter(path)
        for pdf in batches:
            rows = []
            for k, t, most, over in pdf[["k", "t", "m", "o"]].itertuples(index=False):
                rows += [(k, i, a, b, t[a:b]) for i, (a, b) in enumerate(pieces(t, int(most), int(over)))]
            out = pd.DataFrame(rows, columns=[key, "piece", "start_char", "end_char", "content"])
            out["token_count"] = pd.Series(counter.count(out["content"].tolist()), dtype="int64")
            yield out

    over = df.where(F.length(F.col(text)) > F.col(limit)).where(F.col(key).isNotNull())
    over = over.select(F.col(key).alias("k"), F.col(text).alias("t"), F.col(limit).alias("m"), F.col(overlap).alias("o"))
    return over.mapInPandas(part, f"`{key}` {kind}, piece int, start_char int, end_char int, content string, token_count int")
