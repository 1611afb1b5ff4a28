"""Filling containers of fixed capacity with items of varying length.

The lengths are reduced to a histogram whose size depends on the capacity
only. Combinations of up to three lengths that fill a container to within a
small window are enumerated, a non-negative least-squares problem gives how
often each is used, the counts are rounded down to what the histogram has,
and the rest is packed greedily, histogram against histogram. Items then take
their places by their rank among the items of their length, which Spark
computes in slices.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postmill.sources.tables import shared_dir, stored


@dataclass(frozen=True)
class Settings:
    """bins: steps that a capacity is divided into (a length is rounded up to
    whole steps). window: steps that a combination may leave free. rounds:
    gradient rounds. slice_rows: rows that are ranked together.
    """

    bins: int = 2048
    window: int = 1
    rounds: int = 120
    slice_rows: int = 50_000


def combinations(sizes: np.ndarray, full: int, window: int) -> np.ndarray:
    """All multisets of up to three of `sizes` whose sum is in [full - window, full], as rows padded with 0."""
    present = np.zeros(full + 1, bool)
    present[sizes] = True
    out = [np.stack([s, 0 * s, 0 * s], 1) for s in [sizes[sizes >= full - window]]]
    for a in sizes[sizes <= full // 2]:
        for want in range(full - window, full + 1):
            b = want - a
            if b >= a and b <= full and present[b]:
                out.append(np.array([[b, a, 0]]))
            rest = want - a
            c = sizes[(sizes >= a) & (sizes <= rest // 2)]
            d = rest - c
            c, d = c[present[np.clip(d, 0, full)] & (d >= c)], d[present[np.clip(d, 0, full)] & (d >= c)]
            if len(c):
                out.append(np.stack([d, c, np.full(len(c), a)], 1))
    return np.concatenate(out).astype(np.int64) if out else np.zeros((0, 3), np.int64)


def least_squares(combos: np.ndarray, have: np.ndarray, rounds: int) -> np.ndarray:
    """Non-negative repeat counts x with sum over combos of x close to the histogram `have` (accelerated projected gradient).

    Long lengths weigh more: they are the ones that small gaps cannot take.
    """
    full = len(have) - 1
    weight = np.sqrt((np.arange(full + 1) + 1) / (full + 1))
    weight[0] = 0

    def forward(x: np.ndarray) -> np.ndarray:
        return sum(np.bincount(combos[:, k], x, minlength=full + 1) for k in range(3))

    def back(r: np.ndarray) -> np.ndarray:
        return r[combos[:, 0]] + r[combos[:, 1]] + r[combos[:, 2]]

    w2 = weight**2
    v = np.ones(len(combos))
    norm = 1.0
    for _ in range(15):
        v = back(w2 * forward(v))
        norm = np.linalg.norm(v)
        v /= max(norm, 1e-12)
    x = y = np.zeros(len(combos))
    t = 1.0
    for _ in range(rounds):
        g = back(w2 * (forward(y) - have))
        new = np.maximum(y - g / norm, 0)
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / t2 * (new - x)
        x, t = new, t2
    return x


def plan(have: np.ndarray, s: Settings) -> list[tuple[list[tuple[int, int]], int]]:
    """[([(length, copies), ...], repeats), ...]: how often each combination of lengths is packed; it uses up `have` exactly."""
    full = len(have) - 1
    left = have.astype(np.int64).copy()
    out: list[tuple[list[tuple[int, int]], int]] = []
    if left[full]:
        out.append(([(full, 1)], int(left[full])))
        left[full] = 0
    sizes = np.flatnonzero(left)
    combos = combinations(sizes, full, s.window) if len(sizes) else np.zeros((0, 3), np.int64)
    if len(combos):
        x = least_squares(combos, left.astype(float), s.rounds)
        for j in np.argsort(-x, kind="stable"):
            if x[j] < 0.5:
                break
            parts = [(int(a), int((combos[j] == a).sum())) for a in np.unique(combos[j][combos[j] > 0])[::-1]]
            n = min(int(np.floor(x[j] + 0.5)), *(int(left[a]) // c for a, c in parts))
            if n > 0:
                out.append((parts, n))
                for a, c in parts:
                    left[a] -= n * c
    # the rest: longest first into the fullest open containers it fits, counts of equal containers at a time
    open_: dict[int, list[tuple[list[tuple[int, int]], int]]] = {}
    for parts, n in out:
        gap = full - sum(a * c for a, c in parts)
        if gap > 0:
            open_.setdefault(gap, []).append((parts, n))
    out = [(p, n) for p, n in out if full == sum(a * c for a, c in p)]
    for a in np.flatnonzero(left)[::-1].tolist():
        n = int(left[a])
        for gap in sorted(g for g in open_ if g >= a):
            while n and open_.get(gap):
                parts, k = open_[gap].pop()
                each = min(gap // a, n)
                use = min(k, n // each)
                if use < k:
                    open_[gap].append((parts, k - use))
                grown = ([*parts, (a, each)], use)
                n -= each * use
                if gap - a * each:
                    open_.setdefault(gap - a * each, []).append(grown)
                else:
                    out.append(grown)
            if not open_.get(gap):
                open_.pop(gap, None)
            if not n:
                break
        if n:
            each = full // a
            for c, use in ((each, n // each), (n % each, 1)):
                if c and use:
                    if full - a * c:
                        open_.setdefault(full - a * c, []).append(([(a, c)], use))
                    else:
                        out.append(([(a, c)], use))
    return out + [x for group in open_.values() for x in group]


@dataclass
class Places:
    """Where the r-th item of a length goes: sorted starts of rank intervals with their first container and copies per container."""

    start: np.ndarray  # key = length * 2**40 + rank
    container: np.ndarray
    copies: np.ndarray
    n_containers: int

    @staticmethod
    def of(layout: list[tuple[list[tuple[int, int]], int]]) -> Places:
        used: dict[int, int] = {}
        start, container, copies, first = [], [], [], 0
        for parts, n in layout:
            for a, c in parts:
                start.append((a << 40) + used.get(a, 0))
                used[a] = used.get(a, 0) + c * n
                container.append(first)
                copies.append(c)
            first += n
        order = np.argsort(np.array(start, np.int64), kind="stable")
        return Places(np.array(start, np.int64)[order], np.array(container, np.int64)[order], np.array(copies, np.int64)[order], first)

    def find(self, length: np.ndarray, rank: np.ndarray) -> np.ndarray:
        key = (length.astype(np.int64) << 40) + rank
        i = np.searchsorted(self.start, key, "right") - 1
        return self.container[i] + (key - self.start[i]) // self.copies[i]


def pack(sizes: DataFrame, capacities: dict[int, int], settings: Settings = Settings(), id_column: str = "doc_id") -> DataFrame:
    """(spec_id, container_id, slot, offset, id, piece_no, token_start, n_tokens): every item's place for every capacity.

    `sizes` has (id, n_tokens). An item larger than a container is cut into full
    pieces and a rest; others are never cut. An item without tokens takes one
    step of space. Rows with the same id are separate items of equal pieces;
    null sizes and ids are dropped. The driver sees histograms and plans only,
    whose size is set by `bins`, never rows. Container numbers start at 0 in
    each spec; slot and offset give the place inside the container.
    """
    s, spark = settings, sizes.sparkSession
    base = shared_dir(spark)
    step = {k: max(1, -(-c // s.bins)) for k, c in capacities.items()}
    bins = {k: c // step[k] for k, c in capacities.items()}
    specs = F.array(*[F.struct(F.lit(k).alias("spec_id"), F.lit(bins[k] * step[k]).cast("long").alias("cap"), F.lit(step[k]).alias("step")) for k in sorted(capacities)])
    items = sizes.where(f"`{id_column}` is not null and n_tokens is not null").select(F.col(id_column).alias("id"), F.col("n_tokens").alias("total"), F.explode(specs).alias("s")).select("id", "total", "s.*")
    number = F.greatest(F.lit(0), F.ceil(F.col("total") / F.col("cap")) - 1)
    items = items.select("*", F.explode(F.sequence(F.lit(0).cast("long"), number.cast("long"))).alias("piece_no"))
    items = items.withColumn("token_start", F.col("piece_no") * F.col("cap")).withColumn("n_tokens", F.least(F.col("cap"), F.col("total") - F.col("token_start")))
    items = items.withColumn("q", F.greatest(F.lit(1), F.ceil(F.col("n_tokens") / F.col("step"))).cast("int"))
    items = stored(items.select("spec_id", "id", "piece_no", "token_start", "n_tokens", "q"), f"{base}/items")
    total = items.count()
    slices = max(1, -(-total // s.slice_rows))
    items = items.withColumn("slice", F.pmod(F.xxhash64("id", "piece_no"), F.lit(slices)).cast("int"))
    counts = items.groupBy("spec_id", "q", "slice").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("spec_id", "q").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1))
    counts = stored(counts.withColumn("before", F.coalesce(before, F.lit(0))), f"{base}/counts")
    places: dict[int, Places] = {}
    have = {k: np.zeros(bins[k] + 1, np.int64) for k in capacities}
    for r in counts.groupBy("spec_id", "q").agg(F.sum("n").alias("n")).collect():  # at most bins rows a capacity
        have[r["spec_id"]][r["q"]] = r["n"]
    for k in capacities:
        places[k] = Places.of(plan(have[k], s))
    ranked = items.withColumn("r", F.row_number().over(Window.partitionBy("spec_id", "q", "slice").orderBy("id", "piece_no"))).join(counts.select("spec_id", "q", "slice", "before"), ["spec_id", "q", "slice"])
    ranked = ranked.withColumn("rank", F.col("r") - 1 + F.col("before")).select("spec_id", "id", "piece_no", "token_start", "n_tokens", "q", "rank")

    def seat(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            c = np.zeros(len(pdf), np.int64)
            for k, i in pdf.groupby("spec_id").indices.items():
                c[i] = places[int(k)].find(pdf["q"].to_numpy()[i], pdf["rank"].to_numpy()[i])
            yield pdf.drop(columns=["rank", "q"]).assign(container_id=c)

    kind = sizes.schema[id_column].dataType.simpleString()
    seated = ranked.mapInPandas(seat, f"spec_id int, id {kind}, piece_no long, token_start long, n_tokens long, container_id long")
    inside = Window.partitionBy("spec_id", "container_id").orderBy(F.desc("n_tokens"), "id", "piece_no")
    offset = F.coalesce(F.sum("n_tokens").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return seated.select("spec_id", "container_id", (F.row_number().over(inside) - 1).alias("slot"), offset.alias("offset"), F.col("id").alias(id_column), "piece_no", "token_start", "n_tokens")


def fill_report(packed: DataFrame, capacities: dict[int, int]) -> DataFrame:
    """(spec_id, capacity, n_containers, n_pieces, tokens, fill) of a packing."""
    cap = F.create_map(*[F.lit(x) for k, c in capacities.items() for x in (k, c)])
    per = packed.groupBy("spec_id", "container_id").agg(F.count(F.lit(1)).alias("k"), F.sum("n_tokens").alias("t"))
    out = per.groupBy("spec_id").agg(F.count(F.lit(1)).alias("n_containers"), F.sum("k").alias("n_pieces"), F.sum("t").alias("tokens"), F.max("t").alias("fullest"))
    return out.withColumn("capacity", cap[F.col("spec_id")]).withColumn("fill", F.round(F.col("tokens") / (F.col("n_containers") * F.col("capacity")), 4))
