"""Long exact spans shared between records, by Relative Lempel-Ziv parsing.

The reference is the distinct blocks of text around content-defined seeds, held
in an index spread over the cluster by seed. The index of a seed is a sorted
one, as a suffix array is: the blocks in order of what follows the seed, and in
order of what precedes it, so the longest factor a record's block has in the
reference lies between sorted neighbours. Every record is factored at its seeds
from left to right; a factor's two boundaries are extended as far as the
reference agrees, and one that is long enough becomes a shared span. Seeds are
chosen so that every window of the wanted length holds one at the same place in
all records, so no shared span is missed.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexaloom.operators.frames import frame
from lexaloom.session import cut

GRAM = 64
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
BACK = np.uint64(pow(int(BASE), -1, 1 << 64))
#: Characters hashed at once.
STRIDE = 1 << 20
#: Blocks of one seed whose index is held by one task (some MB); a seed with more has its windows spread over the cluster.
HOT = 8192


class Powers:
    """Powers of BASE and of its inverse, modulo 2^64."""

    up = np.ones(1, dtype=np.uint64)
    down = np.ones(1, dtype=np.uint64)

    @classmethod
    def upto(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, STRIDE)
            with np.errstate(over="ignore"):
                cls.up = np.cumprod(np.r_[np.uint64(1), np.full(size, BASE)], dtype=np.uint64)
                cls.down = np.cumprod(np.r_[np.uint64(1), np.full(size, BACK)], dtype=np.uint64)
        return cls.up, cls.down


def mixed(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = h ^ (h >> np.uint64(29))
        h = h * np.uint64(0xBF58476D1CE4E5B9)
        return h ^ (h >> np.uint64(32))


def prefix_sums(points: np.ndarray) -> np.ndarray:
    """Sums from which the hash of any stretch follows."""
    up, _ = Powers.upto(len(points) + 1)
    sums = np.zeros(len(points) + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(points.astype(np.uint64) * up[: len(points)], out=sums[1:])
    return sums


def gram_hashes(sums: np.ndarray, size: int) -> np.ndarray:
    """Hash of every window of ``size`` code points."""
    n = len(sums) - size
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        return mixed((sums[size:] - sums[:n]) * Powers.down[:n])


def block_hashes(sums: np.ndarray, a: np.ndarray, p: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of each stretch from ``a`` to ``b`` and of where ``p`` lies in it."""
    with np.errstate(over="ignore"):
        h = mixed((sums[b] - sums[a]) * Powers.down[a])
        return mixed(h + (p - a).astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D) + (b - p).astype(np.uint64))


def sliding(h: np.ndarray, width: int, best: np.ufunc, fill: int) -> np.ndarray:
    """Best of every ``width`` neighbours, in two passes over blocks of that width."""
    n = len(h) - width + 1
    full = -(-len(h) // width) * width
    blocks = np.full(full, fill, dtype=h.dtype)
    blocks[: len(h)] = h
    blocks = blocks.reshape(-1, width)
    ahead = best.accumulate(blocks, axis=1).reshape(-1)
    behind = best.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return best(behind[:n], ahead[width - 1 : width - 1 + n])


def thinned(at: np.ndarray, of: np.ndarray, h: np.ndarray, gram: int, width: int) -> np.ndarray:
    """Which seeds to keep: in periodic text, where one seed comes back at one distance, the first two, the last, and one in every ``width`` code points.

    Windows that hold an end of the periodic stretch have the first or last seed
    in common; those within it agree around the first two, whatever the phase.
    """
    n = len(at)
    if n < 4:
        return np.ones(n, dtype=bool)
    gap = np.diff(at)
    link = (h[1:] == h[:-1]) & (of[1:] == of[:-1]) & (gap <= gram)
    inner = np.zeros(n, dtype=bool)
    inner[1:-1] = link[1:] & link[:-1] & (gap[1:] == gap[:-1])
    place = np.arange(n)
    place -= np.maximum.accumulate(np.where(inner, 0, place))
    every = np.maximum(1, width // np.r_[1, gap])
    return ~inner | (place == 1) | (place % every == 0)


def batch_seeds(texts: list[str], length: int, gram: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(index of text, position, hash of seed, hash of block) of the seeds of many texts, hashed together."""
    group, size = [], 0
    for i, t in enumerate([*texts, None]):
        if t is None or size + len(t) > STRIDE:
            if group:
                joined = np.frombuffer("".join(texts[g] for g in group).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
                sizes = np.fromiter((len(texts[g]) for g in group), np.int64, len(group))
                begin = np.r_[0, np.cumsum(sizes)]
                yield from _group_seeds(joined, group, begin, length, gram)
            group, size = [], 0
        if t is not None and len(t) >= length:
            group.append(i)
            size += len(t)


def _group_seeds(joined: np.ndarray, group: list[int], begin: np.ndarray, length: int, gram: int) -> Iterator[tuple]:
    width = length - gram + 1
    sums = prefix_sums(joined)
    h = gram_hashes(sums, gram)
    if len(h) < width:
        return
    # windows are taken over the joined texts; those that cross a border are then taken out
    least = sliding(h, width, np.minimum, 0xFFFFFFFFFFFFFFFF)
    for b in begin[1:-1]:
        least[max(0, b - length + 1) : b] = 0
    padded = np.concatenate([np.zeros(width - 1, dtype=np.uint64), least, np.zeros(width - 1, dtype=np.uint64)])
    at = np.flatnonzero(sliding(padded, width, np.maximum, 0) == h)
    of = np.searchsorted(begin, at, side="right") - 1
    keep = thinned(at, of, h[at], gram, width)
    at, of = at[keep], of[keep]
    a, b = np.maximum(begin[of], at - width + 1), np.minimum(begin[of + 1], at + length)
    yield np.asarray(group, dtype=np.int64)[of], at - begin[of], h[at], block_hashes(sums, a, at, b)


def find_seeds(records: DataFrame, length: int, gram: int = GRAM) -> DataFrame:
    """(tbl, id, seed, pos, cid) of records(tbl, id, content): ``cid`` stands for the block around the seed, as far as a window that holds it can reach."""

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts, ids, tbl = pdf["content"].tolist(), pdf["id"].to_numpy(), pdf["tbl"].to_numpy()
            for i, pos, h, c in batch_seeds(texts, length, gram):
                yield pd.DataFrame({"tbl": tbl[i], "id": ids[i], "seed": h.view(np.int64), "pos": pos.astype(np.int32), "cid": c.view(np.int64)})

    return records.where(F.length("content") >= length).mapInPandas(part, "tbl string, id long, seed long, pos int, cid long")


def agreeing(a: str, b: str) -> int:
    """Code points two texts begin with in common."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo, hi = 0, n
    while lo < hi - 1:
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


def members_of(records: DataFrame, length: int, gram: int) -> DataFrame:
    """(tbl, id, seed, pos, cid) of the seeds that two records have, written to the shared folder."""
    found = cut(find_seeds(records, length, gram))
    shared = found.groupBy("tbl", "seed").agg(F.min("id").alias("a"), F.max("id").alias("b")).where("a <> b").select("tbl", "seed")
    return cut(found.join(shared, ["tbl", "seed"]).distinct())


def reference_blocks(records: DataFrame, members: DataFrame, length: int, gram: int) -> DataFrame:
    """(tbl, seed, cid, p, q, n, before, after): the distinct blocks of seeds that have several, with the least and greatest record that holds each, and how many blocks the seed has.

    ``before`` is what precedes the seed, from the seed backwards; ``after`` what
    follows it. Each block is cut from one record that holds it.
    """
    held = members.groupBy("tbl", "seed", "cid").agg(F.min("id").alias("p"), F.max("id").alias("q"), F.min(F.struct("id", "pos")).alias("at"))
    many = held.groupBy("tbl", "seed").agg(F.count("*").alias("n")).where("n > 1")
    wanted = held.join(many, ["tbl", "seed"]).groupBy("tbl", F.col("at.id").alias("id")).agg(F.collect_list(F.struct("seed", "cid", "p", "q", "n", "at.pos")).alias("at"))
    reach = length - gram

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for tbl, content, at in pdf[["tbl", "content", "at"]].itertuples(index=False):
                for x in at:
                    p, lo = x["pos"], max(0, x["pos"] - reach)
                    block = content[lo : p + length]
                    sums = prefix_sums(np.frombuffer(block.encode("utf-32-le", "surrogatepass"), dtype=np.uint32))
                    own = block_hashes(sums, np.array([0]), np.array([p - lo]), np.array([len(block)])).view(np.int64)[0]
                    if own == x["cid"]:  # else of another delivery of the record
                        rows.append((tbl, x["seed"], x["cid"], x["p"], x["q"], x["n"], content[lo:p][::-1], content[p + gram : p + length]))
            yield frame(rows, ["tbl", "seed", "cid", "p", "q", "n", "before", "after"], ("seed", "cid", "p", "q", "n"))

    texts = records.where(F.length("content") >= length).select("tbl", "id", "content")
    out = texts.join(wanted, ["tbl", "id"]).mapInPandas(part, "tbl string, seed long, cid long, p long, q long, n long, before string, after string")
    return out.dropDuplicates(["tbl", "seed", "cid"])


class SeedIndex:
    """The sorted index of one seed's blocks: blocks(cid, p, q, before, after)."""

    def __init__(self, blocks: list[tuple], reach: int) -> None:
        self.reach = reach
        self.blocks = sorted(blocks, key=lambda b: (b[4], b[0]))
        self.steps = [agreeing(x[4], y[4]) for x, y in zip(self.blocks, self.blocks[1:], strict=False)]

    def _runs(self) -> Iterator[tuple[int, list[int]]]:
        """(agreement, blocks in a row that agree so far after the seed), for every agreement two blocks have, the greatest first."""
        for depth in sorted(set(self.steps), reverse=True):
            run = [0]
            for i, s in enumerate(self.steps, 1):
                if s < depth:
                    if len(run) > 1:
                        yield depth, run
                    run = []
                run.append(i)
            if len(run) > 1:
                yield depth, run

    def _groups(self) -> Iterator[tuple[int, list[int]]]:
        """(agreement after the seed, blocks that agree so far and before it as far as a window needs)."""
        for depth, run in self._runs():
            need = max(0, self.reach - depth)
            by: dict[str, list[int]] = defaultdict(list)
            for i in run:
                if len(self.blocks[i][3]) >= need:
                    by[self.blocks[i][3][:need]].append(i)
            for group in by.values():
                if len(group) > 1 and len({o for i in group for o in self.blocks[i][1:3]}) > 1:
                    yield depth, group

    def classes(self) -> list[list[int]]:
        """Blocks (their cid) that all share one window; a set of blocks is given once."""
        seen = dict.fromkeys(tuple(sorted(g)) for _, g in self._groups())
        return [[self.blocks[i][0] for i in g] for g in seen]

    def reaches(self) -> list[tuple[int, int, int]]:
        """(cid, before, after): how far each block's longest factors go, against blocks of other records; none lies within another."""
        out, best = [], {}
        for depth, group in self._groups():
            group = sorted(group, key=lambda i: self.blocks[i][3])
            texts = [self.blocks[i][3] for i in group]
            steps = [agreeing(x, y) for x, y in zip(texts, texts[1:], strict=False)]
            far = [0] * len(group)
            for order in (range(len(group)), range(len(group) - 1, -1, -1)):
                near: list[tuple[object, int]] = []  # the nearest block behind, and the nearest of another record, with what agrees
                last = None
                for k in order:
                    if last is not None:
                        s = steps[min(k, last)]
                        near = [(o, min(v, s)) for o, v in near]
                    _, p, q, _, _ = self.blocks[group[k]]
                    own = p if p == q else (p, q)
                    for o, v in near:
                        if o != own or p != q:
                            far[k] = max(far[k], v)
                            break
                    near = [(own, len(texts[k])), *[x for x in near if x[0] != own][:1]]
                    last = k
            for k, i in enumerate(group):
                cid = self.blocks[i][0]
                if far[k] + depth >= self.reach and far[k] > best.get(cid, -1):
                    best[cid] = far[k]
                    out.append((cid, far[k], depth))
        return out


def _indexed(reach: int, pick: str, columns: list[str]):
    """Builds the index of each seed, whose blocks arrive together, and gives what ``pick`` reads from it."""

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, group, out = None, [], []

        def close() -> None:
            if len(group) > 1:
                found = getattr(SeedIndex(group, reach), pick)()
                out.extend((*key, i, cid) for i, c in enumerate(found) for cid in c) if pick == "classes" else out.extend((*key, *r) for r in found)

        for pdf in batches:
            for tbl, seed, *block in pdf[["tbl", "seed", "cid", "p", "q", "before", "after"]].itertuples(index=False):
                if (tbl, seed) != key:
                    close()
                    key, group = (tbl, seed), []
                group.append(tuple(block))
            if len(out) > 20000:
                yield frame(out, columns, tuple(columns[1:]))
                out.clear()
        close()
        yield frame(out, columns, tuple(columns[1:]))

    return part


def _read(blocks: DataFrame, reach: int, pick: str, schema: str) -> DataFrame:
    n = max(12, int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    columns = [c.split()[0].strip("`") for c in schema.split(", ")]
    return blocks.where(F.col("n") <= HOT).drop("n").repartition(n, "tbl", "seed").sortWithinPartitions("tbl", "seed").mapInPandas(_indexed(reach, pick, columns), schema)


def windows_of(blocks: DataFrame, reach: int) -> DataFrame:
    """(tbl, seed, window, cid, p, q, left) of every window around the seed, for seeds with more than HOT blocks: rows of equal windows meet, never those of a seed."""
    first, last = F.greatest(F.lit(0), F.lit(reach) - F.length("after")), F.least(F.lit(reach), F.length("before"))
    spread = blocks.where((F.col("n") > HOT) & (last >= first)).select("tbl", "seed", "cid", "p", "q", "before", "after", F.explode(F.sequence(first, last)).alias("left"))
    text = F.xxhash64(F.substr("before", F.lit(1), F.col("left")), F.substr("after", F.lit(1), F.lit(reach) - F.col("left")), "left")
    return spread.select("tbl", "seed", text.alias("window"), "cid", "p", "q", "left")


def _shared_windows(blocks: DataFrame, reach: int) -> DataFrame:
    w = windows_of(blocks, reach)
    two = w.groupBy("tbl", "seed", "window").agg(F.min("p").alias("a"), F.max("q").alias("b"), F.min("cid").alias("x"), F.max("cid").alias("y")).where("a <> b and x <> y").select("tbl", "seed", "window")
    return w.join(two, ["tbl", "seed", "window"])


def _factored(records: DataFrame, length: int, gram: int) -> tuple[DataFrame, DataFrame]:
    known = records.select("tbl", "id", "content").where("id is not null and content is not null")
    members = members_of(known, length, gram)
    return members, cut(reference_blocks(known, members, length, gram))


def shared_classes(records: DataFrame, length: int = 240, gram: int = GRAM) -> DataFrame:
    """(tbl, class_id, id): records that have a stretch of at least ``length`` code points in common, by stretch; a set of records is given once.

    Two records share such a stretch exactly if they are in one class. A class
    is a window of the reference and the records whose factors cover it, so the
    result grows with the records, not with their pairs. Records with a null id
    or content, or a shorter one, take no part; a record given twice counts once;
    columns beside tbl, id, content are left out. Exact but for collisions of
    64-bit hashes.
    """
    members, blocks = _factored(records, length, gram)
    reach = length - gram
    # of one block: all who have it
    own = members.groupBy("tbl", "seed", "cid").agg(F.min("id").alias("a"), F.max("id").alias("b")).where("a <> b").select("tbl", "seed", "cid", F.struct(F.lit(0).alias("kind"), F.col("cid").alias("no")).alias("cls"))
    cold = _read(blocks, reach, "classes", "tbl string, seed long, no long, cid long").select("tbl", "seed", "cid", F.struct(F.lit(1).alias("kind"), "no").alias("cls"))
    hot = _shared_windows(blocks, reach).select("tbl", "seed", "cid", F.struct(F.lit(2).alias("kind"), F.col("window").alias("no")).alias("cls"))
    holds = members.select("tbl", "seed", "cid", "id").distinct()
    rows = own.unionByName(cold).unionByName(hot).join(holds, ["tbl", "seed", "cid"]).select("tbl", "seed", "cls", "id").distinct()
    rows = cut(rows)
    key = F.struct("tbl", "seed", "cls")
    who = rows.groupBy("tbl", "seed", "cls").agg(F.struct(F.count("*").alias("n"), F.sum(F.xxhash64("id").cast("decimal(20,0)")).alias("s"), F.bit_xor(F.xxhash64("id", F.lit(1))).alias("x")).alias("who"))
    one = who.where("who.n > 1").groupBy("tbl", "who").agg(F.min(F.struct("seed", "cls")).alias("v")).select("tbl", "v.seed", "v.cls")
    return rows.join(one, ["tbl", "seed", "cls"]).select("tbl", F.xxhash64(F.to_json(key)).alias("class_id"), "id")


def shared_pairs(records: DataFrame, length: int = 240, gram: int = GRAM) -> DataFrame:
    """(tbl, id_a, id_b), id_a < id_b: the pairs of records within the classes of ``shared_classes``."""
    c = cut(shared_classes(records, length, gram))
    return c.alias("a").join(c.alias("b"), ["tbl", "class_id"]).where("a.id < b.id").select("tbl", F.col("a.id").alias("id_a"), F.col("b.id").alias("id_b")).distinct()


def shared_share(records: DataFrame, length: int = 240, gram: int = GRAM) -> DataFrame:
    """(tbl, id, n_chars, shared_chars) of every record: how much of it stands in shared stretches.

    Each record is parsed from left to right into its longest factors; a factor
    counts from where the ones before it end. One row a record that has content;
    records without any shared stretch have 0. Of a record delivered more than
    once the longest content counts.
    """
    members, blocks = _factored(records, length, gram)
    reach = length - gram
    copies = members.groupBy("tbl", "seed", "cid").agg(F.min("id").alias("a"), F.max("id").alias("b")).where("a <> b").select("tbl", "seed", "cid", F.lit(reach).cast("long").alias("left"), F.lit(reach).cast("long").alias("right"))
    cold = _read(blocks, reach, "reaches", "tbl string, seed long, cid long, `left` long, `right` long")
    hot = _shared_windows(blocks, reach).select("tbl", "seed", "cid", F.col("left").cast("long").alias("left"), (F.lit(reach) - F.col("left")).cast("long").alias("right"))
    factors = copies.unionByName(cold).unionByName(hot)
    sizes = records.where("id is not null and content is not null").groupBy("tbl", "id").agg(F.max(F.length("content")).alias("n_chars"))
    spans = members.join(factors, ["tbl", "seed", "cid"]).select("tbl", "id", F.greatest(F.lit(0), F.col("pos") - F.col("left")).alias("a"), (F.col("pos") + gram + F.col("right")).alias("b"))
    spans = spans.groupBy("tbl", "id", "a").agg(F.max("b").alias("b")).join(sizes, ["tbl", "id"]).withColumn("b", F.least("b", "n_chars"))
    before = F.max("b").over(Window.partitionBy("tbl", "id").orderBy("a").rowsBetween(Window.unboundedPreceding, -1))
    new = F.greatest(F.lit(0), F.col("b") - F.greatest("a", F.coalesce(before, F.lit(0))))
    covered = spans.withColumn("new", new).groupBy("tbl", "id").agg(F.sum("new").cast("int").alias("shared_chars"))
    return sizes.join(covered, ["tbl", "id"], "left").fillna(0, ["shared_chars"]).select("tbl", "id", "n_chars", "shared_chars")
