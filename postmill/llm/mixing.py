"""Mixing sources to target weights by balanced sampling.

Each source gets a rate (copies per page). Its whole part is copied outright;
its fraction is the inclusion probability of a cube-method sample: the vector
of probabilities is moved inside the null space of the balancing equations
(pages and tokens) until it is 0 or 1 but for as many units as equations.
The flight runs in blocks; what stays undecided is gathered into new blocks,
again and again, until a source has one small landing problem.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.sources.tables import shared_dir, stored


@dataclass(frozen=True)
class Settings:
    """block: pages that fly together. landing: units of a source that the
    landing problem decides at most, besides the two the flight leaves. seed:
    of the walk.
    """

    block: int = 4000
    landing: int = 13
    seed: int = 11


def rates(have: dict[str, int], target: dict[str, float], repeats: dict[str, int], total: int) -> dict[str, float]:
    """Copies per token of each source: its share of `total`, at most its repeats; what capped sources lack goes to the others by their shares."""
    rate = {s: 0.0 for s in target}
    free = {s for s in target if have.get(s, 0) > 0 and target[s] > 0 and repeats[s] > 0}
    left = float(total)
    while free:
        weight = sum(target[s] for s in free)
        capped = {s for s in free if left * target[s] / weight >= repeats[s] * have[s]}
        if not capped:
            for s in free:
                rate[s] = left * target[s] / weight / have[s]
            break
        for s in capped:
            rate[s] = float(repeats[s])
            left -= repeats[s] * have[s]
        free -= capped
    return rate


def flight(p: np.ndarray, size: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Probabilities after the flight: all 0 or 1 except at most two, with sums of p and of p * size unchanged."""
    p = p.astype(float).copy()
    t = size / max(float(size.mean()) if len(size) else 0.0, 1e-9)
    eps = 1e-9
    wait = [i for i in range(len(p)) if eps < p[i] < 1 - eps]
    wait.reverse()
    now: list[int] = []
    draw = iter(rng.random(4 * len(p) + 16))
    while True:
        while len(now) < 3 and wait:
            now.append(wait.pop())
        if len(now) < 3:
            break
        a, b, c = now
        # null vector of [[1, 1, 1], [ta, tb, tc]]
        u = (t[b] - t[c], t[c] - t[a], t[a] - t[b])
        if abs(u[0]) + abs(u[1]) + abs(u[2]) < 1e-12:
            u = (1.0, -1.0, 0.0)
        up = min((1 - p[i]) / x if x > 0 else p[i] / -x for i, x in zip(now, u, strict=True) if abs(x) > 1e-15)
        down = min(p[i] / x if x > 0 else (1 - p[i]) / -x for i, x in zip(now, u, strict=True) if abs(x) > 1e-15)
        step = up if next(draw) < down / (up + down) else -down
        for i, x in zip(now, u, strict=True):
            p[i] += step * x
        p[now] = np.where(p[now] < eps, 0, np.where(p[now] > 1 - eps, 1, p[now]))
        now = [i for i in now if 0 < p[i] < 1]
    return p


def landing(p: np.ndarray, size: np.ndarray, due: float) -> np.ndarray:
    """The undecided units (at most 15) set to 0 or 1: of all roundings whose number of pages is the due one rounded down or up, the one that misses the tokens least.

    Both balancing equations hold as nearly as whole pages allow. Only where a
    page is larger than all that is `due` of its source (tokens of the source's
    sampled part) no rounding comes near; then pages in and out of the sample
    change places one for one, the best pair first, while that brings the
    tokens nearer: the number of pages stays, and the share is as near as that allows.
    """
    p = p.copy()
    goal = float(p @ size)
    open_ = np.flatnonzero((p > 0) & (p < 1))
    if len(open_) > 15:
        raise ValueError("the flight left more units than a landing takes")
    bits = (np.arange(1 << len(open_))[:, None] >> np.arange(len(open_))) & 1
    miss = np.abs(bits @ size[open_] - float((p[open_] * size[open_]).sum()))
    miss = np.where(np.abs(bits.sum(1) - p[open_].sum()) < 1 - 1e-6, miss, np.inf)
    p[open_] = bits[int(np.argmin(miss))]
    while len(size) and size.max() > due:
        over = float(p @ size) - goal
        taken, left = np.flatnonzero(p == 1), np.flatnonzero(p == 0)
        if not len(taken) or not len(left):
            break
        left = left[np.argsort(size[left], kind="stable")]
        at = np.searchsorted(size[left], size[taken] - over)
        pairs = np.stack([np.clip(at - 1, 0, len(left) - 1), np.clip(at, 0, len(left) - 1)], 1)
        after = np.abs(over + size[left][pairs] - size[taken][:, None])
        i, j = np.unravel_index(int(np.argmin(after)), after.shape)
        if after[i, j] >= abs(over) - 1e-9:
            break
        p[taken[i]], p[left[pairs[i, j]]] = 0, 1
    return p


def _flyer(s: Settings, level: int, due: dict[str, float]):  # noqa: ANN202
    def fly(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("doc_id", kind="stable").reset_index(drop=True)
        source = pdf["source"].iloc[0]
        rng = np.random.default_rng([s.seed, level, int(pdf["block"].iloc[0]), *source.encode()])
        size = pdf["n_tokens"].to_numpy(float)
        order = rng.permutation(len(pdf))
        p = np.empty(len(pdf))
        start = pdf["p"].to_numpy()
        if not pdf["last"].iloc[0]:
            p[order] = flight(start[order], size[order], rng)
            return pdf.assign(p=p).drop(columns=["block", "last"])
        # the last block of a source keeps a few units of various sizes for the landing
        kept = np.unique(np.argsort(size, kind="stable")[np.linspace(0, len(size) - 1, min(s.landing, len(size))).astype(int)])
        order = order[~np.isin(order, kept)]
        p[kept] = start[kept]
        p[order] = flight(start[order], size[order], rng) if len(order) else p[order]
        return pdf.assign(p=landing(p, size, due[source])).drop(columns=["block", "last"])

    return fly


def mix(pages: DataFrame, targets: DataFrame, settings: Settings = Settings()) -> tuple[DataFrame, DataFrame]:
    """(mixture (doc_id, source, n_tokens, copies), shares per source).

    `pages` has (doc_id, source, n_tokens) and `targets` (source, target_share,
    max_repeats; a list of sources, collected). The mixture is as large as all
    pages together where the caps allow it. Sources are compared without case
    and outer spaces. Pages of sources without a target, without a source or a
    size get no copy; targets without pages are reported with share 0. No
    group is larger than about a block: flights run per (source, block). A
    source's copies are its rate times its pages, rounded down or up (see
    `landing`); due_copies and n_copies of the shares tell both.
    """
    s, spark = settings, pages.sparkSession
    base = shared_dir(spark)
    pages = pages.withColumn("source", F.lower(F.trim("source")))
    goal = {r["source"]: r for r in targets.withColumn("source", F.lower(F.trim("source"))).where("source is not null").collect()}
    sums = stored(pages.groupBy("source").agg(F.sum("n_tokens").alias("t"), F.count("n_tokens").alias("n")), f"{base}/sums")
    total = sums.agg(F.sum("t")).first()[0] or 0
    found = sums.where(F.col("source").isin(list(goal))).collect()  # one row a target
    have, pages_of = {r["source"]: r["t"] or 0 for r in found}, {r["source"]: r["n"] for r in found}
    rate = rates(have, {k: r["target_share"] or 0.0 for k, r in goal.items()}, {k: r["max_repeats"] or 0 for k, r in goal.items()}, total)
    whole = {k: int(np.floor(v + 1e-12)) for k, v in rate.items()}
    rest = {k: max(0.0, v - whole[k]) for k, v in rate.items()}
    some = [k for k in rate if rate[k] > 0]
    as_map = lambda d, zero: F.create_map(*[F.lit(x) for k in (some or ["\x00"]) for x in (k, d.get(k, zero))])
    drawn = pages.where(F.col("source").isin(some) & F.col("n_tokens").isNotNull()).select("doc_id", "source", "n_tokens", as_map(whole, 0)[F.col("source")].alias("whole"), as_map(rest, 0.0)[F.col("source")].alias("p"))
    undecided = drawn.where("p > 0").select("doc_id", "source", "n_tokens", "p")
    kind = pages.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, source string, n_tokens long, p double"
    done: list[DataFrame] = []
    level = 0
    due = {k: rest[k] * have[k] for k in some}
    while True:
        counts = {r[0]: r[1] for r in undecided.groupBy("source").count().collect()}
        if not counts:
            break
        # each source lands when what is left of it is one block, whatever the others have left
        blocks = {k: -(-n // s.block) for k, n in counts.items()}
        block = F.pmod(F.xxhash64("doc_id", F.lit(level)), F.create_map(*[F.lit(x) for k, n in blocks.items() for x in (k, n)])[F.col("source")])
        last = F.col("source").isin([k for k, n in blocks.items() if n == 1])
        # a flight is work in Python on few bytes: as many tasks as blocks, which adaptive execution doesn't merge by their size
        tasks = max(1, min(sum(blocks.values()), 4 * spark.sparkContext.defaultParallelism))
        ready = undecided.withColumn("block", block).withColumn("last", last).repartition(tasks, "source", "block")
        flown = stored(ready.groupBy("source", "block").applyInPandas(_flyer(s, level, due), schema), f"{base}/flight-{level}")
        done.append(flown.where("p = 0 or p = 1").select("doc_id", F.col("p").cast("int").alias("more")))
        undecided, level = flown.where("p > 0 and p < 1"), level + 1
    mixture = drawn
    if done:
        more = done[0]
        for d in done[1:]:
            more = more.unionByName(d)
        mixture = drawn.join(more, "doc_id", "left")
    else:
        mixture = drawn.withColumn("more", F.lit(0))
    mixture = mixture.select("doc_id", "source", "n_tokens", (F.col("whole") + F.coalesce("more", F.lit(0))).cast("int").alias("copies")).where("copies > 0")
    rows = [(k, float(r["target_share"] or 0), int(r["max_repeats"] or 0), int(have.get(k, 0)), float(rate[k]), float(rate[k] * pages_of.get(k, 0))) for k, r in goal.items()]
    plan = spark.createDataFrame(rows, "source string, target_share double, max_repeats int, available_tokens long, rate double, due_copies double")
    got = mixture.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("drawn_tokens"), F.count(F.lit(1)).alias("n_pages"), F.sum("copies").alias("n_copies"))
    shares = plan.join(got, "source", "left").na.fill(0, ["drawn_tokens", "n_pages", "n_copies"])
    reached = got.agg(F.sum("drawn_tokens").alias("all_tokens"))
    # one row against one per target
    shares = shares.withColumn("one", F.lit(1)).join(reached.withColumn("one", F.lit(1)), "one").drop("one")
    return mixture, shares.withColumn("actual_share", F.col("drawn_tokens") / F.col("all_tokens")).withColumn("limited", F.col("rate") >= F.col("max_repeats"))
