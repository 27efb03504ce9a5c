"""Mixing sources to target shares by balanced sampling (the cube method).

Each source's share of the wanted total sets how often its documents are used:
a whole number of times each, and once more with an inclusion probability. The
flight phase moves the probabilities along directions that keep the balancing
sums (documents and tokens of the source) until they are 0 or 1; it runs on
blocks of documents side by side, what is left over from blocks is flown again
together, and only a handful of documents a source is left for the landing.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexaloom.llm.tokens import VOCABULARY, token_count
from lexaloom.session import cut

#: Documents flown together; each block leaves at most as many as there are balancing sums.
FLOWN = 5_000
EPS = 1e-9


def usual(c: Column) -> Column:
    """A source's usual spelling: trimmed, lower case, hyphens and blanks as underscores; null for blank."""
    s = F.regexp_replace(F.lower(F.trim(c)), r"[\s\-]+", "_")
    return F.when(s != "", s)


def even_total(tokens: dict[str, int], targets: list[tuple[str, float, int]]) -> float:
    """The largest total at which every source that has text, taken max_repeats times at most, still gives its share of it.

    Shares are over the sources with text, which make up the whole then; 0 if there is none.
    """
    own = [(share, reps * tokens[s]) for s, share, reps in targets if share and share > 0 and reps and reps > 0 and tokens.get(s)]
    return min((held / share for share, held in own), default=0.0)


def quotas(tokens: dict[str, int], targets: list[tuple[str, float, int]], total: float | None = None) -> dict[str, float]:
    """Tokens each source is to give.

    Without ``total`` it is the tokens all sources with a target hold. A source
    gives its share of the total, but no more than all its documents taken
    max_repeats times; one without text, or with a share or repeats of 0 or
    less, gives nothing. What it lacks is not given by others, so each of those
    has its share of the total exactly; the shares of what came out are reported.
    """
    own = {s: (share, reps) for s, share, reps in targets if share and share > 0 and reps and reps > 0}
    if total is None:
        total = float(sum(tokens.get(s, 0) for s in own))
    return {s: min(share * total, reps * tokens.get(s, 0)) for s, (share, reps) in own.items()}


def flight(p: np.ndarray, a: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Moves probabilities ``p`` to 0 or 1, keeping ``a``' (p / start) as far as it goes: at most as many stay fractional as ``a`` has columns.

    a: (n, q), the balancing variables over the starting probabilities.
    """
    p, q = p.copy(), a.shape[1]
    waiting = [i for i in np.flatnonzero((p > EPS) & (p < 1 - EPS)).tolist()]
    waiting.reverse()
    held: list[int] = []
    while True:
        while waiting and len(held) < q + 1:
            held.append(waiting.pop())
        if len(held) < q + 1:
            break
        m = a[held].T  # q x (q + 1): its null space has a direction
        u = np.linalg.svd(m)[2][-1] if q != 2 else np.cross(m[0], m[1])
        if np.abs(u).max() < 1e-12:
            u = np.linalg.svd(m)[2][-1]
        x = p[held]
        with np.errstate(divide="ignore", invalid="ignore"):
            up = np.where(u > 0, (1 - x) / u, np.where(u < 0, -x / u, np.inf)).min()
            down = np.where(u > 0, x / u, np.where(u < 0, (x - 1) / u, np.inf)).min()
        p[held] = np.clip(x + (up if rng.random() * (up + down) < down else -down) * u, 0, 1)
        held = [i for i in held if EPS < p[i] < 1 - EPS]
    return np.where(p < EPS, 0.0, np.where(p > 1 - EPS, 1.0, p))


def _fly(last: bool, seed: int):
    """Flies the documents of one block of one source; in the last round lands what is left, nearest to the tokens wanted."""

    def block(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("doc_id")
        rng = np.random.default_rng([seed, int(pdf["block"].iloc[0]) & 0x7FFFFFFF, *pdf["source"].iloc[0].encode()])
        p, size = pdf["p"].to_numpy(), pdf["tokens"].to_numpy().astype(float)
        a = np.stack([np.ones(len(p)), size / max(1.0, size.mean())], axis=1)
        order = rng.permutation(len(p))
        out = np.empty_like(p)
        out[order] = flight(p[order], a[order], rng)
        if last:  # a few are left: the choice whose tokens come closest to what they stand for
            left = np.flatnonzero((out > EPS) & (out < 1 - EPS))
            want = float((out[left] * size[left]).sum())
            best = min(range(1 << len(left)), key=lambda b: (abs(sum(size[left[i]] for i in range(len(left)) if b >> i & 1) - want), b))
            for i, k in enumerate(left):
                out[k] = float(best >> i & 1)
        return pdf.assign(p=out)

    return block


def mix(docs: DataFrame, targets: DataFrame, total: float | None = None, path: str = VOCABULARY, seed: int = 11, even: bool = False) -> DataFrame:
    """(doc_id, source, tokens, times): how often each document is used; documents not used are left out.

    With ``even`` the total is the largest at which all sources that have text
    meet their shares (a source with little text makes it small); else the total
    is ``total``, or all tokens held, and a source with too little falls short.

    docs: doc_id, source, text; targets: source, target_share, max_repeats. Null
    and empty texts hold no tokens and aren't used, nor are documents of sources
    without a target; a document given twice counts once. No document is used
    more than its source's max_repeats. What reaches the driver is one row a
    source with a target.
    """
    sized = docs.where("doc_id is not null and text is not null").select("doc_id", usual(F.col("source")).alias("source"), "text")
    own = targets.select(usual(F.col("source")).alias("source"), "target_share", "max_repeats").where("source is not null").groupBy("source").agg(F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    wanted = [(r.source, r.target_share, r.max_repeats) for r in own.collect()]  # a row a target
    sized = sized.where(F.col("source").isin([s for s, _, _ in wanted]) if wanted else F.lit(False))
    sized = cut(sized.select("doc_id", "source", token_count(F.col("text"), path).alias("tokens")).where("tokens > 0").dropDuplicates(["doc_id"]))
    held = {r.source: (r.t, r.n) for r in sized.groupBy("source").agg(F.sum("tokens").alias("t"), F.count("*").alias("n")).collect()}
    if even:
        total = even_total({s: t for s, (t, _) in held.items()}, wanted)
    give = quotas({s: t for s, (t, _) in held.items()}, wanted, total)
    rate = {s: min(give.get(s, 0.0) / held[s][0], float(r)) for s, _, r in wanted if s in held and r}
    if not rate:
        return sized.where(F.lit(False)).withColumn("times", F.lit(0))
    rates = F.create_map(*[x for s, v in sorted(rate.items()) for x in (F.lit(s), F.lit(v))])
    blocks = F.create_map(*[x for s, (_, n) in sorted(held.items()) for x in (F.lit(s), F.lit(max(1, round(n / FLOWN))))])
    use = sized.withColumn("rate", rates[F.col("source")]).where("rate > 0")
    use = use.select("doc_id", "source", "tokens", F.floor("rate").cast("int").alias("whole"), (F.col("rate") - F.floor("rate")).alias("p"))
    use = use.withColumn("block", F.pmod(F.xxhash64("doc_id"), blocks[F.col("source")]))
    schema = "doc_id long, source string, tokens long, whole int, p double, block long"
    n = max((m for _, m in held.values()), default=1) / FLOWN  # blocks of the largest source
    settled, flown = [], use
    while n > 1:  # each round leaves a document or two of every block, so rounds are few
        flown = cut(flown.groupBy("source", "block").applyInPandas(_fly(False, seed), schema))
        n = n * 2 / FLOWN
        settled.append(flown.where("p = 0 or p = 1"))
        together = F.lit(0) if n <= 1 else F.floor(F.col("block") * 2 / FLOWN)
        flown = flown.where("p > 0 and p < 1").withColumn("block", together.cast("long"))
    out = flown.groupBy("source").applyInPandas(_fly(True, seed), schema)
    for part in settled:
        out = out.unionByName(part)
    return out.select("doc_id", "source", "tokens", (F.col("whole") + F.col("p").cast("int")).alias("times")).where("times > 0")


def shares(used: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, target_share, max_repeats, documents, uses, tokens, actual_share, most_times) of a mix, a row a target."""
    own = targets.select(usual(F.col("source")).alias("source"), "target_share", "max_repeats")
    per = used.groupBy("source").agg(F.count("*").alias("documents"), F.sum("times").alias("uses"), F.sum(F.col("tokens") * F.col("times")).alias("tokens"), F.max("times").alias("most_times"))
    total = per.agg(F.sum("tokens").alias("total"))
    out = own.join(per, "source", "left").join(F.broadcast(total)).fillna(0, ["documents", "uses", "tokens", "most_times"])
    return out.select("source", "target_share", "max_repeats", "documents", "uses", "tokens", F.coalesce(F.col("tokens") / F.col("total"), F.lit(0.0)).alias("actual_share"), "most_times")

