"""Tokens of texts under an existing byte-level BPE vocabulary.

A text is cut into pieces by the vocabulary's pattern. The distinct pieces of a
batch are kept as one flat array of symbols; rounds join adjacent pairs with
the merge ranks and apply the lowest-ranked merge of every piece at once, until
no pair has a rank. The vocabulary file is a parameter.
"""

from __future__ import annotations

import base64
import functools
import os
import re
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VOCABULARY = os.environ.get("LEXALOOM_VOCABULARY", "/opt/tokenizers/byte_bpe_multi_50k.tiktoken")
#: Pieces a worker remembers; beyond that it starts anew, which costs time only.
REMEMBERED = 400_000
# Fixed value: the pattern these vocabularies were made with.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


# The same for the faster engine, right for texts without ODD numbers and ODD blanks.
FAST = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
ODD = frozenset(chr(i) for i in range(0x110000) if unicodedata.category(chr(i)) in ("Nl", "No")) | set("\x1c\x1d\x1e\x1f")


def cutter() -> Callable[[str], list[str]]:
    """Text -> its pieces."""
    exact, fast = regex.compile(PATTERN).findall, FAST.findall
    return lambda t: fast(t) if ODD.isdisjoint(t) else exact(t)


class Merges:
    """Merge ranks of a vocabulary: (left id, right id) -> id of the joined symbol, whose value is the rank."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}
        self.whole = frozenset(ranks)
        self.byte = np.array([ranks[bytes([i])] for i in range(256)], dtype=np.int64)
        self.size = max(ranks.values()) + 1
        # every way of parting a symbol into two symbols is a merge with the symbol's rank
        pairs = {ranks[w[:i]] * self.size + ranks[w[i:]]: r for w, r in ranks.items() for i in range(1, len(w)) if w[:i] in ranks and w[i:] in ranks}
        keys = np.fromiter(pairs, np.int64, len(pairs))
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], np.fromiter(pairs.values(), np.int64, len(pairs))[order]
        # a hash table of twice the size finds most misses in one step
        bits = int(len(keys) * 4 - 1).bit_length()
        self.mask = (1 << bits) - 1
        self.seen = np.zeros(1 << bits, dtype=bool)
        self.seen[self.slot(self.keys)] = True

    def slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) & self.mask

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair; ``size`` where there is none."""
        key = a * self.size + b
        out = np.full(len(key), self.size, dtype=np.int64)
        maybe = np.flatnonzero(self.seen[self.slot(key)])
        k = key[maybe]
        at = np.searchsorted(self.keys, k)
        at[at == len(self.keys)] = 0
        hit = self.keys[at] == k
        out[maybe[hit]] = self.ranks[at[hit]]
        return out


@functools.lru_cache(maxsize=4)
def merges(path: str) -> Merges:
    return Merges(path)


def symbols_after_merging(pieces: list[bytes], m: Merges) -> np.ndarray:
    """Number of symbols each piece is left with."""
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
    out = np.ones(len(pieces), dtype=np.int64)
    out[sizes == 0] = 0
    flat = m.byte[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
    piece = np.repeat(np.arange(len(pieces)), sizes)
    none = m.size
    rank = np.full(len(flat), none, dtype=np.int64)  # of the pair that begins here
    inner = np.flatnonzero(piece[1:] == piece[:-1])
    rank[inner] = m.rank(flat[inner], flat[inner + 1])
    while len(flat):
        starts = np.flatnonzero(np.r_[True, piece[1:] != piece[:-1]])
        length = np.diff(np.r_[starts, len(flat)])
        least = np.minimum.reduceat(rank, starts)
        out[piece[starts]] = length
        live = least < none
        if not live.any():
            break
        pick = np.flatnonzero((rank == np.repeat(least, length)) & (rank < none))
        # overlapping occurrences (aaa): the first of each run of neighbours, then every second
        run = np.r_[True, np.diff(pick) != 1]
        first = np.maximum.accumulate(np.where(run, np.arange(len(pick)), 0))
        pick = pick[(np.arange(len(pick)) - first) % 2 == 0]
        flat[pick] = rank[pick]
        keep = np.repeat(live, length)
        keep[pick + 1] = False
        to = np.cumsum(keep) - 1
        flat, piece, rank = flat[keep], piece[keep], rank[keep]
        at = to[pick]
        touched = np.r_[at, at[at > 0] - 1]  # only pairs with the new symbol have another rank now
        rank[touched] = none
        touched = touched[touched < len(flat) - 1]
        touched = touched[piece[touched] == piece[touched + 1]]
        rank[touched] = m.rank(flat[touched], flat[touched + 1])
    return out


class Counter:
    """Tokens of texts; remembers the pieces it has merged."""

    def __init__(self, path: str = VOCABULARY) -> None:
        self.m, self.find = merges(path), cutter()
        self.known: dict[str, int] = {}

    def count(self, texts: list[str | None]) -> list[int | None]:
        pieces = [None if t is None else self.find(t) for t in texts]
        new = set().union(*(p for p in pieces if p)).difference(self.known)
        if new:
            if len(self.known) + len(new) > REMEMBERED:
                self.known = {}
                new = set().union(*(p for p in pieces if p))
            coded = {x: x.encode("utf-8", "replace") for x in new}
            parted = {x: b for x, b in coded.items() if b not in self.m.whole}
            self.known.update(dict.fromkeys(coded, 1))  # a piece that is a symbol is one token
            self.known.update(zip(parted, symbols_after_merging(list(parted.values()), self.m).tolist(), strict=True))
        get = self.known.__getitem__
        return [None if p is None else sum(map(get, p)) for p in pieces]


def token_count(text: Column, path: str = VOCABULARY) -> Column:
    """Tokens of a text column; null for null, 0 for the empty text."""

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = Counter(path)
        for s in batches:
            texts = [None if t is None else t for t in s]
            out: list = []
            for i in range(0, len(texts), 2000):  # bounds the pieces held at once
                out += counter.count(texts[i : i + 2000])
            yield pd.Series(out, dtype="Int64")

    return count(text)


def unusable(count: Column, tokens: Column, factor: float = 5.0) -> Column:
    """True where a stored count is null, not positive, or off by more than ``factor``."""
    return count.isNull() | (count <= 0) | (count > tokens * factor) | (count * factor < tokens)


def with_tokens(chunks: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """``chunks`` with ``tokens`` (of the content, 0 for null) and ``usable`` (whether token_count can be trusted)."""
    counted = chunks.withColumn("tokens", F.coalesce(token_count(F.col("content"), path), F.lit(0)))
    return counted.withColumn("usable", ~unusable(F.col("token_count"), F.col("tokens")))


def slug(c: Column) -> Column:
    """Lower case, runs of blanks, hyphens and underscores as one hyphen; null for blank."""
    s = F.regexp_replace(F.lower(F.trim(c)), r"[\s_\-]+", "-")
    return F.when(s != "", s)


def same_path(c: Column) -> Column:
    """One spelling of a source path: trimmed, scheme and host in lower case, no fragment, query, doubled or closing slash; paths of files in lower case. Null for blank."""
    t = F.trim(c)
    t = F.regexp_replace(F.regexp_replace(t, r"[#?].*$", ""), r"(?<=[^/:])/+$", "")
    t = F.regexp_replace(F.regexp_replace(t, r"(?<!:)/{2,}", "/"), r"(?<!^)(?<!:)/\./", "/")
    host = F.regexp_extract(t, r"^([A-Za-z_+]+://[^/]*)", 1)
    t = F.when(host != "", F.concat(F.regexp_replace(F.lower(host), "^http:", "https:"), F.substr(t, F.length(host) + 1))).otherwise(F.lower(t))
    return F.when(t != "", t)


def budget(chunks: DataFrame, sections: DataFrame, manifest: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """(source_type, source_path, language, domain, n_chunks, tokens, stored_tokens) over distinct chunks.

    Null content counts 0 tokens. A source's type and language are those most of
    its sections have (ties: the lesser); labels that are null or blank come out
    as 'unknown'. stored_tokens sums the stored counts that can be used. Counts
    are per chunk before anything is shuffled; texts are never shuffled.
    """
    counted = with_tokens(chunks, path).select("chunk_id", "curriculum_id", same_path(F.col("source")).alias("source_path"), "tokens", F.when(F.col("usable"), F.col("token_count")).alias("stored"))
    counted = counted.where("chunk_id is not null").groupBy("chunk_id").agg(F.max(F.struct("tokens", "stored", "curriculum_id", "source_path")).alias("r")).select("chunk_id", "r.*")
    lang = F.lower(F.regexp_extract(F.trim("language"), "^([A-Za-z]{2,3})", 1))
    seen = sections.select("section_id", same_path(F.col("source_path")).alias("source_path"), slug(F.col("source_type")).alias("source_type"), F.when(lang != "", lang).alias("language"))
    seen = seen.where("source_path is not null").groupBy("source_path", "section_id").agg(F.max("source_type").alias("source_type"), F.max("language").alias("language"))

    def mode(column: str) -> DataFrame:
        n = seen.where(F.col(column).isNotNull()).groupBy("source_path", column).agg(F.count("*").alias("n"))
        return n.groupBy("source_path").agg(F.min_by(column, F.struct(-F.col("n"), F.col(column))).alias(column))

    domain = manifest.where("curriculum_id is not null").groupBy("curriculum_id").agg(F.max(slug(F.col("domain"))).alias("domain"))
    per = counted.groupBy("source_path", "curriculum_id").agg(F.count("*").alias("n_chunks"), F.sum("tokens").alias("tokens"), F.sum("stored").alias("stored_tokens"))
    per = per.join(mode("source_type"), "source_path", "left").join(mode("language"), "source_path", "left").join(domain, "curriculum_id", "left")
    per = per.fillna("unknown", ["source_path", "source_type", "language", "domain"])
    return per.groupBy("source_type", "source_path", "language", "domain").agg(F.sum("n_chunks").alias("n_chunks"), F.sum("tokens").alias("tokens"), F.coalesce(F.sum("stored_tokens"), F.lit(0)).alias("stored_tokens"))
