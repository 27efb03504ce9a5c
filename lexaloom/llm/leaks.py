"""Evaluation items that stand, fully or partly, in documents.

Documents and items are cut into overlapping passages. Passages become TF-IDF
vectors over the terms (short runs of words, or of characters where words
aren't parted) the items hold. A randomised SVD, whose products are summed over
the cluster, gives a latent space in which each passage of a document looks for
the passages of items next to it by cosine. What it finds is decided by the
longest common run, or, for paraphrases, by the longest common subsequence and
by whether what answers the item, its numbers, names and rare words, is there.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexaloom.operators.frames import frame
from lexaloom.session import cut

#: Items handled at once, which bounds the space they span; a larger set of items meets all documents block by block.
BLOCK = 5_000
#: What a paraphrase must keep: of an item's passage in order, and of the units that answer it in any order.
KEPT, ANSWER = 0.75, 0.6
#: Units in at most this share of the documents (names, numbers, rare words) answer an item's passage; where it has none, its rarest three do.
SINGULAR = 0.01
#: Directions beyond the rank that the randomised SVD starts from.
SPARE = 16
MIX = np.uint64(0x9E3779B97F4A7C15 | 1)
INVISIBLE = re.compile("[­͏؜ᅟᅠ឴឵᠋-᠏​-‏‪-‮⁠-⁯︀-️﻿]")
TAG = re.compile(r"</?[a-zA-Z][^<>\n]*>|&(?:nbsp|zwnj|zwj|shy|ensp|emsp|thinsp|#\d+|#x[0-9a-fA-F]+);")
WORD = re.compile(r"[^\W_]+")
UNSPACED = re.compile("[぀-ヿ㐀-鿿豈-﫿]")


@dataclass(frozen=True)
class Kind:
    """How texts of a kind are cut: a run counts from ``run`` units on, terms are ``gram`` units, passages with fewer than ``least`` known terms aren't looked at."""

    name: str
    run: int
    gram: int
    least: int

    @property
    def step(self) -> int:
        return self.run // 2

    @property
    def width(self) -> int:  # every run lies wholly in one passage
        return self.run + self.step


# For runs: a run of n units holds n - gram + 1 terms, so none is lost.
WORDS, CHARACTERS = Kind("w", 12, 4, 9), Kind("c", 30, 8, 23)
# For paraphrases, whose terms are shorter: what is kept of a passage, beside what another cut of it leaves out, holds that many.
NEAR = (Kind("w", 12, 3, 4), Kind("c", 30, 4, 10))


def plain(text: str) -> str:
    """``text`` without case, markup, invisible characters and different codings."""
    if text.isascii():
        return TAG.sub(" ", text).lower() if "<" in text or "&" in text else text.lower()
    if "<" in text or "&" in text:
        text = TAG.sub(" ", text)
    return unicodedata.normalize("NFC", unicodedata.normalize("NFKC", INVISIBLE.sub("", text)).casefold())


def words(text: str) -> list[str]:
    """Runs of letters, marks and digits."""
    if text.isascii():
        return WORD.findall(text)
    out = WORD.findall(text)
    if MARK.search(text):  # marks don't part words
        out = MARKED.findall(text)
    return out


MARKED = regex.compile(r"[\p{L}\p{M}\p{N}]+")
MARK = re.compile("[̀-ͯ҃-֑҇-ׇؐ-ًؚ-ٰٟۖ-ۜ۟-ۤऀ-ःऺ-ॏॕ-ॗॢॣังัิ-ฺ็-๎゙゚]")


def characters(text: str) -> str:
    """Letters, marks and digits only."""
    return "".join(words(text))


@dataclass
class Items:
    """A block of items: units, terms and passages."""

    items: list[tuple[int, str | None, str]]
    kinds: tuple[Kind, Kind] = (WORDS, CHARACTERS)
    vocabulary: dict[str, dict[str, int]] = field(default_factory=lambda: {"w": {}, "c": {}})
    terms: dict[str, np.ndarray] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.passages: list[tuple[int, Kind, np.ndarray]] = []
        for i, lang, text in self.items:
            kind = self.kinds[(lang or "").lower()[:2] in ("zh", "ja")]
            units = words(plain(text)) if kind.name == "w" else list(characters(plain(text)))
            ids = self.vocabulary[kind.name]
            seq = np.array([ids.setdefault(u, len(ids) + 1) for u in units], dtype=np.int64)
            for a in range(0, max(1, len(seq) - kind.run + kind.step), kind.step):
                if len(seq[a : a + kind.width]) >= kind.gram:
                    self.passages.append((i, kind, seq[a : a + kind.width]))
        for kind in self.kinds:
            own = [grams(s, kind.gram) for _, k, s in self.passages if k is kind]
            self.terms[kind.name] = np.unique(np.concatenate([x[x != 0] for x in own])) if own else np.zeros(0, dtype=np.uint64)

    def kind(self, name: str) -> Kind:
        return self.kinds[name == "c"]

    @property
    def n_terms(self) -> int:
        return len(self.terms["w"]) + len(self.terms["c"])

    @property
    def n_counted(self) -> int:
        """Terms, and after them the units of both kinds."""
        return self.n_terms + len(self.vocabulary["w"]) + len(self.vocabulary["c"]) + 2

    def unit_base(self, kind: Kind) -> int:
        return self.n_terms + (len(self.vocabulary["w"]) + 1 if kind.name == "c" else 0)

    def term_ids(self, seq: np.ndarray, kind: Kind) -> np.ndarray:
        """For each position the number of the term that begins there, or -1."""
        known = self.terms[kind.name]
        g = grams(seq, kind.gram)
        if not len(known) or not len(g):
            return np.full(len(g), -1, dtype=np.int64)
        at = np.minimum(np.searchsorted(known, g), len(known) - 1)
        return np.where((known[at] == g) & (g != 0), at + (len(self.terms["w"]) if kind.name == "c" else 0), -1)


def grams(seq: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` units; 0 where one of them is unknown (0)."""
    m = len(seq) - n + 1
    if m <= 0:
        return np.zeros(0, dtype=np.uint64)
    h, ok = np.zeros(m, dtype=np.uint64), np.ones(m, dtype=bool)
    with np.errstate(over="ignore"):
        for i in range(n):
            h = (h ^ seq[i : i + m].astype(np.uint64)) * MIX
            h ^= h >> np.uint64(31)
            ok &= seq[i : i + m] > 0
    return np.where(ok, h | np.uint64(1), np.uint64(0))


def _cut_documents(shared):
    """Document frequencies of terms and units, and the passages with enough terms, each with a step of its text on either side."""

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        it: Items = shared.value
        for pdf in batches:
            frequency = np.zeros(it.n_counted, dtype=np.int64)
            rows = []
            texts = [plain(t) for t in pdf["text"]]
            for kind in it.kinds:
                get = it.vocabulary[kind.name].get
                if not it.vocabulary[kind.name]:
                    continue
                keys, seqs = [], []
                for k, t in zip(pdf["doc"], texts, strict=True):
                    if kind.name == "c" and not UNSPACED.search(t):
                        continue
                    units = words(t) if kind.name == "w" else characters(t)
                    seqs.append([get(u, 0) for u in units])
                    keys.append(k)
                if not seqs:
                    continue
                sizes = [len(s) + kind.gram for s in seqs]  # unknown units part the documents
                joined = np.zeros(sum(sizes), dtype=np.int64)
                begin = np.r_[0, np.cumsum(sizes)]
                for b, s in zip(begin, seqs, strict=False):
                    joined[b : b + len(s)] = s
                terms = it.term_ids(joined, kind)
                counts = [(np.flatnonzero(terms >= 0), terms)]
                if it.kinds == NEAR:  # only paraphrases are asked for their rare units
                    counts.append((np.flatnonzero(joined), joined + it.unit_base(kind)))
                for hits, values in counts:
                    of = np.searchsorted(begin, hits, side="right") - 1
                    frequency += np.bincount(np.unique(of * it.n_counted + values[hits]) % it.n_counted, minlength=it.n_counted)
                counted = np.r_[0, np.cumsum(terms >= 0)]
                for k, b, s in zip(keys, begin, seqs, strict=False):
                    if counted[min(b + len(s), len(counted) - 1)] - counted[b] < kind.least:
                        continue
                    a = np.arange(b, b + max(1, len(s) - kind.run + kind.step), kind.step)
                    e = np.minimum(np.minimum(a + kind.width, b + len(s)) - kind.gram + 1, len(terms))
                    for x in a[(counted[np.maximum(e, a)] - counted[a]) >= kind.least]:
                        lo = max(b, x - kind.step)
                        rows.append((k, kind.name, x - lo, joined[lo : min(x + kind.width + kind.step, b + len(s))].tolist(), None, None))
            seen = np.flatnonzero(frequency)
            rows += [(None, None, None, None, f, frequency[f]) for f in seen]
            yield frame(rows, ["doc", "kind", "before", "units", "term", "n"], ("doc", "before", "term", "n"))

    return part


def _cores(it: Items, pdf: pd.DataFrame) -> list[tuple[Kind, np.ndarray]]:
    """Passages without what stands on either side."""
    out = []
    for k, b, u in zip(pdf["kind"], pdf["before"], pdf["units"], strict=True):
        kind = it.kind(k)
        out.append((kind, np.asarray(u[b : b + kind.width], dtype=np.int64)))
    return out


def _vectors(it: Items, passages: list[tuple[Kind, np.ndarray]], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """TF-IDF vectors of unit length as (row, term, weight)."""
    return _weighted(*_terms(it, passages), len(passages), idf)


def _terms(it: Items, passages: list[tuple[Kind, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The terms of each passage once, as (row, term)."""
    rows, terms = [], []
    for r, (kind, seq) in enumerate(passages):
        t = it.term_ids(seq, kind)
        t = np.unique(t[t >= 0])
        rows.append(np.full(len(t), r))
        terms.append(t)
    row = np.concatenate(rows) if rows else np.zeros(0, dtype=np.int64)
    term = np.concatenate(terms) if terms else np.zeros(0, dtype=np.int64)
    return row, term


def _weighted(row: np.ndarray, term: np.ndarray, n: int, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Terms of ``n`` rows with their weights; rows have unit length."""
    w = idf[term]
    norm = np.sqrt(np.bincount(row, w * w, minlength=n))
    return row, term, w / np.maximum(norm[row], 1e-12)


def _times(vectors: tuple, n: int, right: np.ndarray) -> np.ndarray:
    """Sparse rows times a dense matrix."""
    row, term, w = vectors
    out = np.zeros((n, right.shape[1]), dtype=np.float32)
    starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]]) if len(row) else []
    if len(row):
        out[row[starts]] = np.add.reduceat(right[term] * w[:, None].astype(np.float32), starts, axis=0)
    return out


def _add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sums the vectors of each term of a part."""
    total: dict[int, np.ndarray] = {}
    for pdf in batches:
        for t, v in zip(pdf["term"], pdf["v"], strict=True):
            x = np.frombuffer(v, dtype=np.float32)
            total[t] = total[t] + x if t in total else x
    yield pd.DataFrame({"term": list(total), "v": [x.tobytes() for x in total.values()]})


def _term_sets(shared):
    """The terms of each passage, those of equal ones in a batch once."""

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        it: Items = shared.value
        for pdf in batches:
            row, term = _terms(it, _cores(it, pdf))
            sets = np.split(term.astype(np.int32), np.flatnonzero(np.diff(row)) + 1) if len(row) else []
            yield frame([(np.frombuffer(s, dtype=np.int32).tolist(),) for s in {s.tobytes() for s in sets}], ["terms"], ())

    return part


def _of_sets(pdf: pd.DataFrame, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    row, term = np.repeat(np.arange(len(pdf)), pdf["terms"].map(len)), np.concatenate(pdf["terms"].to_list())
    return _weighted(row, term, len(pdf), idf)


def _sketch(state):
    """Partial sums of A'(A S) over the sets of terms of a part, A's rows, for a basis S: a row a term."""

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        idf, basis = state.value
        total = np.zeros(basis.shape, dtype=np.float32)
        for pdf in batches:
            for a in range(0, len(pdf), 4096):
                v = _of_sets(pdf.iloc[a : a + 4096], idf)
                y, (row, term, w) = _times(v, min(4096, len(pdf) - a), basis), v
                order = np.argsort(term, kind="stable")
                begin = np.flatnonzero(np.r_[True, np.diff(term[order]) != 0])
                total[term[order][begin]] += np.add.reduceat(y[row[order]] * w[order, None].astype(np.float32), begin, axis=0)
        used = np.flatnonzero(np.abs(total).sum(axis=1))
        yield pd.DataFrame({"term": used, "v": [x.tobytes() for x in total[used]]})

    return part


def _gram(rows):
    """Sum of y y' over the rows of a part, for what ``rows`` makes of a batch: a small square a part."""

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for pdf in batches:
            for a in range(0, len(pdf), 4096):
                y = rows(pdf.iloc[a : a + 4096]).astype(np.float64)
                total = y.T @ y if total is None else total + y.T @ y
        yield pd.DataFrame({"g": [] if total is None else [total.tobytes()]})

    return part


def _square(df: DataFrame, size: int, rows) -> np.ndarray:
    """The squares of all parts summed: as many small rows come to the driver as there are parts."""
    out = np.zeros((size, size))
    for r in df.mapInPandas(_gram(rows), "g binary").toLocalIterator():
        out += np.frombuffer(r.g, dtype=np.float64).reshape(size, size)
    return out


def randomised_svd(sets: DataFrame, idf: np.ndarray, rank: int, rounds: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """(V, s): the first right singular vectors and values of A, whose rows are the TF-IDF vectors of ``sets`` (terms: array<int>).

    A random start S is drawn through A'A ``rounds`` times, the products being
    summed over the cluster, and made orthonormal by the Cholesky factor of its
    Gram matrix, summed over the cluster too. Of the small B = A Q only B'B is
    formed; its eigenvectors turn Q into singular vectors. The driver sees squares
    of rank + SPARE, and the basis, a row a term of the items.
    """
    spark, n = sets.sparkSession, len(idf)
    k = min(rank + SPARE, n)
    basis = np.random.default_rng(7).standard_normal((n, k)).astype(np.float32)
    for _ in range(rounds):
        state = spark.sparkContext.broadcast((idf, basis))
        z = cut(sets.mapInPandas(_sketch(state), "term long, v binary").repartition("term").mapInPandas(_add_up, "term long, v binary"))
        vector = lambda pdf: np.stack([np.frombuffer(v, dtype=np.float32) for v in pdf["v"]])
        g = _square(z, k, vector)
        values, turn = np.linalg.eigh(g)
        good = values > 1e-7 * max(values.max(initial=0.0), 1e-30)  # directions that A doesn't have are left out
        inverse = (turn[:, good] / np.sqrt(values[good])).astype(np.float32)
        basis = np.zeros((n, int(good.sum())), dtype=np.float32)
        for r in z.toLocalIterator():  # a row a term of the items
            basis[r.term] = np.frombuffer(r.v, dtype=np.float32) @ inverse
        k = basis.shape[1]
        if not k:
            return basis, np.zeros(0)
    state = spark.sparkContext.broadcast((idf, basis))
    project = lambda pdf: _times(_of_sets(pdf, state.value[0]), len(pdf), state.value[1])
    values, turn = np.linalg.eigh(_square(sets, k, project))
    order = np.argsort(values)[::-1][:rank]
    return basis @ turn[:, order].astype(np.float32), np.sqrt(np.maximum(values[order], 0.0))


class _Runs:
    """Passages of items by the hashes of their runs of ``kind.run`` units."""

    def __init__(self, kind: Kind, passages: list[np.ndarray]) -> None:
        self.kind = kind
        of, self.hashes = self._hashed(passages)
        order = np.argsort(self.hashes, kind="stable")
        self.of, self.hashes = of[order], self.hashes[order]

    def _hashed(self, passages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.array([len(s) + 1 for s in passages], dtype=np.int64)  # an unknown unit parts the passages
        begin = np.cumsum(sizes) - sizes
        joined = np.zeros(sizes.sum(), dtype=np.int64)
        for b, s in zip(begin, passages, strict=True):
            joined[b : b + len(s)] = s
        h = grams(joined, self.kind.run)
        at = np.flatnonzero(h)
        return np.searchsorted(begin, at, side="right") - 1, h[at]

    def pairs(self, passages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(passage, passage of an item) with a run in common."""
        of, h = self._hashed(passages)
        low = np.searchsorted(self.hashes, h, side="left")
        n = np.searchsorted(self.hashes, h, side="right") - low
        place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
        return np.repeat(of, n), self.of[place]


class _Answers:
    """The units that answer passages of items, and which passages each of them answers."""

    def __init__(self, passages: list[np.ndarray], weight: np.ndarray) -> None:
        of, units, shares = [], [], []
        for j, seq in enumerate(passages):
            u = np.unique(seq)
            w = weight[u]
            key = w >= -np.log(SINGULAR)
            if not key.any():
                key = w >= np.sort(w)[-3:][0]
            of.append(np.full(key.sum(), j))
            units.append(u[key])
            shares.append(w[key] / w[key].sum())
        of, units, shares = (np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in (of, units, shares))
        order = np.argsort(units, kind="stable")
        self.of, self.shares, self.n = of[order].astype(np.int64), shares[order], len(passages)
        self.begin = np.searchsorted(units[order], np.arange(len(weight) + 1))

    def found(self, passages: list[np.ndarray]) -> np.ndarray:
        """(passage, passage of an item): the share, by weight, of what answers the item's that the other holds."""
        row = np.repeat(np.arange(len(passages)), [len(p) for p in passages])
        unit = np.concatenate(passages) if passages else np.zeros(0, dtype=np.int64)
        pair = np.unique(row * len(self.begin) + unit)
        row, unit = pair // len(self.begin), pair % len(self.begin)
        n = self.begin[unit + 1] - self.begin[unit]
        place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.begin[unit], n)
        at = np.repeat(row, n) * self.n + self.of[place]
        return np.bincount(at, self.shares[place], minlength=len(passages) * self.n).reshape(len(passages), self.n)


def coded(seq: np.ndarray) -> str:
    """Units as one string; unknown units (0) equal nothing in an item, which has none."""
    return "".join(map(chr, (seq + 1).tolist()))


def longest_run(a: str, b: str) -> int:
    """Longest run of ``a`` that stands in ``b``."""
    best = 0
    for i in range(len(a)):
        while i + best < len(a) and a[i : i + best + 1] in b:
            best += 1
    return best


def common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence, a bit a unit of ``b``."""
    at: dict[str, int] = {}
    for i, u in enumerate(b):
        at[u] = at.get(u, 0) | 1 << i
    full = (1 << len(b)) - 1
    v = full
    for u in a:
        x = v & at.get(u, 0)
        v = ((v + x) | (v - x)) & full
    return len(b) - v.bit_count()


def leaks(docs: DataFrame, items: DataFrame, rank: int = 128, cosine: float = 0.45, kinds: tuple[Kind, Kind] = NEAR, rounds: int = 1) -> DataFrame:
    """(doc_id, item_id, passages, run, lcs_share, answer_share, kind): documents with a passage that an item's passage leaked into.

    docs: doc_id, text; items: item_id, lang, text. Candidates are passages within
    ``cosine`` of an item's in the latent space, and those with a whole run in
    common. Kind 'verbatim': ``run``, the longest run of equal units, is at least
    12 words, or 30 characters for items in Chinese or Japanese. Else
    'paraphrase': of an item's passage, of as many units at least, a share of KEPT stands in the document in
    order (the longest common subsequence), and what tells the item apart is
    there: its units in at most SINGULAR of the documents (names, numbers, rare
    words), by weight, to a share of ANSWER. passages counts those found. Null and empty texts
    match nothing; empty tables give an empty result; a document given twice
    counts once. Items come in blocks of BLOCK, so what is broadcast is bounded;
    documents are never shuffled.
    """
    spark = docs.sparkSession
    out, block = None, []
    for r in items.where("item_id is not null and text is not null").select("item_id", "lang", "text").dropDuplicates(["item_id"]).orderBy("item_id").toLocalIterator():
        block.append((r.item_id, r.lang, r.text))
        if len(block) == BLOCK:
            part = _leaks(docs, Items(block, kinds), rank, cosine, rounds)
            out, block = part if out is None else out.unionByName(part), []
    if block or out is None:
        part = _leaks(docs, Items(block, kinds), rank, cosine, rounds) if block else spark.createDataFrame([], "doc_id long, item_id long, passages long, run int, lcs_share double, answer_share double, kind string")
        out = part if out is None else out.unionByName(part)
    return out


def _leaks(docs: DataFrame, it: Items, rank: int, cosine: float, rounds: int) -> DataFrame:
    spark, near = docs.sparkSession, it.kinds == NEAR
    shared = spark.sparkContext.broadcast(it)
    read = docs.where("doc_id is not null and text is not null").select(F.col("doc_id").alias("doc"), "text")
    parts = cut(read.mapInPandas(_cut_documents(shared), "doc long, kind string, before int, units array<int>, term int, n long"))
    counts = parts.where("term is not null").groupBy("term").agg(F.sum("n").alias("n"))  # a row a term or unit of the items
    n_docs = read.count()
    frequency = np.zeros(it.n_counted)
    for r in counts.toLocalIterator():
        frequency[r.term] = r.n
    rare = np.log((1 + n_docs) / (1 + frequency)) + 0.1
    idf, unit_weight = rare[: it.n_terms], rare
    passages = parts.where("doc is not null").select("doc", "kind", "before", "units")
    own = [(k, s) for _, k, s in it.passages]
    row, term = _terms(it, own)
    mine = spark.createDataFrame([(s.tolist(),) for s in np.split(term, np.flatnonzero(np.diff(row)) + 1)] if len(row) else [], "terms array<int>")
    sets = cut(passages.mapInPandas(_term_sets(shared), "terms array<int>").unionByName(mine).distinct())  # else the reposted fill the space
    basis, _ = randomised_svd(sets, idf, min(rank, it.n_terms), rounds)
    latent = _times(_vectors(it, own, idf), len(own), basis)
    latent /= np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-9)
    state = spark.sparkContext.broadcast((it, idf, unit_weight, basis, latent))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        it, idf, unit_weight, basis, latent = state.value
        strings = [coded(seq) for _, _, seq in it.passages]
        whole_enough = np.array([len(seq) >= k.run for _, k, seq in it.passages])  # the rest of an item is no passage to reword
        of_kind = {k.name: np.array([i for i, p in enumerate(it.passages) if p[1] is k], dtype=np.int64) for k in it.kinds}
        runs = {k.name: _Runs(k, [it.passages[i][2] for i in of_kind[k.name]]) for k in it.kinds}
        answers = {} if not near else {k.name: _Answers([it.passages[i][2] for i in of_kind[k.name]], unit_weight[it.unit_base(k) : it.unit_base(k) + len(it.vocabulary[k.name]) + 1]) for k in it.kinds}
        for pdf in batches:
            rows = []
            for name, group in pdf.groupby("kind"):
                p = _cores(it, group)
                wide = [np.asarray(u, dtype=np.int64) for u in group["units"]]
                mine, least = of_kind[name], it.kind(name).run
                if not len(mine):
                    continue
                y = _times(_vectors(it, p, idf), len(p), basis)
                y /= np.maximum(np.linalg.norm(y, axis=1, keepdims=True), 1e-9)
                docs_ = group["doc"].to_numpy()
                same, item = runs[name].pairs([u for _, u in p])  # a whole run counts at any cosine
                for a in range(0, len(p), 1024):
                    close = (y[a : a + 1024] @ latent[mine].T >= cosine) & whole_enough[mine]
                    answer = answers[name].found(wide[a : a + 1024]) if near else np.zeros((1, 1))
                    if near:
                        close &= answer >= ANSWER
                    here = (same >= a) & (same < a + 1024)
                    close[same[here] - a, item[here]] = True
                    text, last = "", -1
                    for i, j in zip(*np.nonzero(close), strict=True):
                        k, seq = mine[j], it.passages[mine[j]][2]
                        there = np.isin(seq, wide[a + i]).sum()
                        enough = near and there >= KEPT * len(seq) and answer[i, j] >= ANSWER  # the subsequence can't be longer
                        if not enough and there < least:
                            continue
                        if i != last:
                            text, last = coded(wide[a + i]), i
                        run = longest_run(text, strings[k])
                        share = common_subsequence(text, strings[k]) / len(seq) if near else run / len(seq)
                        if run >= least or (enough and share >= KEPT):
                            rows.append((int(docs_[a + i]), int(it.passages[k][0]), run, share, float(answer[i, j]) if near else 1.0, run >= least))
            yield pd.DataFrame(rows, columns=["doc_id", "item_id", "run", "share", "answer", "whole"])

    found = passages.mapInPandas(search, "doc_id long, item_id long, run int, share double, answer double, whole boolean")
    g = found.groupBy("doc_id", "item_id").agg(F.count("*").alias("passages"), F.max("run").alias("run"), F.max("share").alias("lcs_share"), F.max("answer").alias("answer_share"), F.max("whole").alias("whole"))
    return g.select("doc_id", "item_id", "passages", "run", "lcs_share", "answer_share", F.when(F.col("whole"), "verbatim").otherwise("paraphrase").alias("kind"))


def leaked_runs(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id) with a common run of 12 words, or of 30 characters for items in Chinese or Japanese: ``leaks`` over longer terms, of which every run holds many."""
    return leaks(docs, items, cosine=0.35, kinds=(WORDS, CHARACTERS)).where("kind = 'verbatim'").select("doc_id", "item_id")
