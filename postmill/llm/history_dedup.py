"""Deduplicating new batches against everything already accepted.

Multi-key sorted neighbourhoods over persisted runs. A text is reduced once to
K sort keys (pairs of min-hashes over word or character shingles), a short
sketch and bucket counts. The key rows are kept as sorted runs, split into
ranges of the key; the more rows a run has, the more ranges. A batch opens the
ranges that its own keys fall into, merges them with its keys and takes along
only rows whose first key part equals one of its own: what is shuffled, sorted
and compared follows the batch. Windows around new records are compared by
their sketches; groups of equal keys that outgrow a window (texts with the
same boilerplate) are compared whole, their new rows with all others, in tiles
of bounded size. What the sketches leave must pass a bound by bucket counts,
which loses nothing, and is then verified on the whole texts. Runs of similar
size are merged as they pile up.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postmill.llm.textarrays import clean, mix, shingles, tokens
from postmill.operators.components import connected_components
from postmill.sources.tables import removed, shared_dir, sifted, spread, stored

PERMS = 32
#: Buckets of the counts that bound the overlap of two bags.
BUCKETS = 256


@dataclass(frozen=True)
class Settings:
    """keys: sort keys per text. range_rows: key rows of a range, about; a run
    has as many ranges a key as that makes, so a small batch opens few rows of
    a large history. window: neighbours compared on each side. sketch_min:
    equal bytes of 32 that a candidate needs. word_shingle, char_shingle:
    tokens of a shingle in spaced and unspaced texts. agree: overlap of the
    token bags (2 * common / both) from which texts are copies. compact_every:
    runs of similar size that are merged into one. tile: rows on a side of a
    tile of an oversized group.
    """

    keys: int = 8
    range_rows: int = 1_000_000
    window: int = 8
    sketch_min: int = 11
    word_shingle: int = 3
    char_shingle: int = 8
    agree: float = 0.83
    compact_every: int = 4
    tile: int = 16384


@dataclass
class Run:
    """Sorted key rows in `path`, one folder a range: kr = key * ranges + range; `rows` of them."""

    path: str
    ranges: int
    rows: int


def bag(h: np.ndarray, doc: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Units that are compared: words, and runs of three characters in unspaced scripts."""
    m = len(h)
    if m < 3 or not own.any():
        return h
    x = h.copy()
    for k in (1, 2):
        nxt = np.zeros(m, np.uint64)
        nxt[: m - k] = h[k:]
        x = x * np.uint64(0x9E3779B97F4A7C15) + nxt
    ok = np.zeros(m, bool)
    ok[: m - 2] = doc[: m - 2] == doc[2:]
    return np.where(own & ok, mix(x), h)


_SEEDS = mix(np.arange(1, 2 * PERMS + 1, dtype=np.uint64))
_MUL = (_SEEDS[:PERMS].astype(np.uint32) | np.uint32(1)).astype(np.uint32)
_ADD = _SEEDS[PERMS:].astype(np.uint32)


def bucket_counts(units: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """[n, BUCKETS / 2 + 8] bytes: counts of each bag's units by bucket, two a byte and 15 at most; what exceeds 15 in all; the size."""
    c = np.bincount(doc * BUCKETS + (units & np.uint64(BUCKETS - 1)).astype(np.int64), minlength=n * BUCKETS).reshape(n, BUCKETS)
    low = np.minimum(c, 15).astype(np.uint8)
    ends = np.stack([(c - low).sum(1), c.sum(1)], 1).astype(np.uint32)
    return np.concatenate([low[:, ::2] | low[:, 1::2] << np.uint8(4), ends.view(np.uint8)], 1)


def may_agree(x: np.ndarray, y: np.ndarray, agree: float) -> np.ndarray:
    """False only where the bags with these bucket counts (rows of x and y) overlap less than `agree`."""
    half = BUCKETS // 2
    ends = [np.ascontiguousarray(z[:, half:]).view(np.uint32).astype(np.int64) for z in (x, y)]
    p, q = x[:, :half], y[:, :half]
    most = np.minimum(p & 15, q & 15).sum(1, dtype=np.int64) + np.minimum(p >> 4, q >> 4).sum(1, dtype=np.int64) + np.minimum(ends[0][:, 0], ends[1][:, 0])
    return 2 * np.minimum(most, np.minimum(ends[0][:, 1], ends[1][:, 1])) >= agree * (ends[0][:, 1] + ends[1][:, 1])


def signatures(texts: list[str], s: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text id, min-hashes [n, PERMS], bucket counts); id 0 is a text without any token.

    The id is a sum over the bag of units: the same for any order of the same
    units, so copies that differ only in layout or order share it.
    """
    n = len(texts)
    h, doc, _, _, own = tokens(texts)
    tid, mh = np.zeros(n, np.uint64), np.full((n, PERMS), 0xFFFFFFFF, np.uint32)
    if not len(h):
        return tid.astype(np.int64), mh, np.zeros((n, BUCKETS // 2 + 8), np.uint8)
    units = bag(h, doc, own)
    np.add.at(tid, doc, mix(units + np.uint64(7)))
    count = np.bincount(doc, minlength=n)
    tid = np.where(count > 0, mix(tid + count.astype(np.uint64)) | np.uint64(1), np.uint64(0))
    by_char = np.bincount(doc, own, minlength=n) > 0.3 * count
    for char, size in ((False, s.word_shingle), (True, s.char_shingle)):
        keep = by_char[doc] == char
        if not keep.any():
            continue
        sh, d = shingles(h[keep], doc[keep], size)
        starts = np.flatnonzero(np.concatenate(([True], d[1:] != d[:-1])))
        x = (sh >> np.uint64(32)).astype(np.uint32)
        for p in range(PERMS):
            v = x * _MUL[p] + _ADD[p]
            v ^= v >> np.uint32(15)
            mh[d[starts], p] = np.minimum.reduceat(v * np.uint32(0x85EBCA6B), starts)
    # The bits that `_verified` compares, so that equal units share a bucket there too.
    return tid.astype(np.int64), mh, bucket_counts(units >> np.uint64(32), doc, n)


def sketches(mh: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """[n, PERMS + 4] bytes: the last byte of each min-hash, and the size of the bag."""
    return np.concatenate([(mh & 0xFF).astype(np.uint8), counts[:, -4:]], 1)


def opened(sk) -> tuple[np.ndarray, np.ndarray]:  # noqa: ANN001
    """(sketch bytes, sizes) of a column of sketches."""
    x = np.frombuffer(b"".join(sk), np.uint8).reshape(-1, PERMS + 4)
    return x[:, :PERMS], np.ascontiguousarray(x[:, PERMS:]).view(np.uint32)[:, 0].astype(np.int64)


def sizes_agree(x: np.ndarray, y: np.ndarray, agree: float) -> np.ndarray:
    """False only where bags of these sizes can't overlap by `agree`, one lying in the other."""
    return 2 * np.minimum(x, y) >= agree * (x + y)


def agreeing(x: np.ndarray, y: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(i, j) of the sketches x[i] and y[j] that are equal in `least` bytes or more."""
    xt, yt, found = np.ascontiguousarray(x.T), np.ascontiguousarray(y.T), []
    step = max(1, 1_000_000 // max(1, len(y)))
    for i in range(0, len(x), step):
        same = np.zeros((min(step, len(x) - i), len(y)), np.uint8)
        for p in range(PERMS):
            same += xt[p, i : i + step, None] == yt[p]
        a, b = np.nonzero(same >= least)
        found.append((a + i, b))
    return (np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])) if found else (np.empty(0, int), np.empty(0, int))


def _pieces(pdf: pd.DataFrame, column: str, chars: int = 600_000) -> Iterator[tuple[pd.DataFrame, list[str]]]:
    """The frame in pieces of about `chars` characters, with their cleaned texts; whole texts always."""
    texts = [clean(t) for t in pdf[column]]
    ends = np.cumsum([len(t) for t in texts]) // chars
    for _, part in pd.Series(range(len(texts))).groupby(ends):
        i = part.to_numpy()
        yield pdf.iloc[i], [texts[k] for k in i]


class HistoryDedup:
    """State of a growing collection of accepted texts in a shared folder.

    `accept(batch, source)` takes rows (job_id, first_seen, raw_text) that come
    after all earlier ones. Null and blank texts and null ids are ignored; a
    repeated row counts once; an empty batch changes nothing. `members()` has
    each id with its class, `pairs()` each copy with the accepted one.
    """

    def __init__(self, spark: SparkSession, settings: Settings = Settings(), path: str | None = None) -> None:
        self.spark, self.s, self.path = spark, settings, path or shared_dir(spark)
        self.batches = self.merges = 0
        self.members_at: list[str] = []
        self.fresh_at: list[str] = []
        self.runs: list[Run] = []
        self.classes_at: list[str] = []

    # -- pieces of a batch ------------------------------------------------
    def _signed(self, batch: DataFrame) -> DataFrame:
        s = self.s

        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in frames:
                for part, texts in _pieces(pdf, "raw_text"):
                    tid, mh, counts = signatures(texts, s)
                    ok = tid != 0
                    if ok.any():
                        keys = mh[:, : s.keys].view(np.int32)
                        yield pd.DataFrame({
                            "ord": part["ord"].to_numpy()[ok], "tid": tid[ok], "keys": list(keys[ok]),
                            "sk": [r.tobytes() for r in sketches(mh, counts)[ok]], "counts": [r.tobytes() for r in counts[ok]],
                        })

        order = F.concat(F.coalesce(F.date_format("first_seen", "yyyy-MM-dd"), F.lit("9999-12-31")), F.lit(" "), F.col("job_id"))
        src = batch.where("job_id is not null and raw_text is not null").select(order.alias("ord"), "raw_text")
        return spread(src).mapInPandas(run, "ord string, tid long, keys array<int>, sk binary, counts binary")

    def _key_rows(self, texts: DataFrame, *more: str) -> DataFrame:
        """(j, k1, k2, tid, *more): the rows of each key."""
        k = self.s.keys
        row = F.array(*[F.struct(F.lit(j).alias("j"), F.col("keys")[j].alias("k1"), F.col("keys")[(j + 1) % k].alias("k2")) for j in range(k)])
        return texts.select(F.explode(row).alias("e"), "tid", *more).select("e.j", "e.k1", "e.k2", "tid", *more)

    @staticmethod
    def _range(ranges: int):  # noqa: ANN205
        """Column: the folder of a key row in a run of so many ranges a key; the ranges are equal parts of the evenly spread first key part."""
        return (F.col("j") * ranges + F.floor(F.pmod(F.xxhash64("k1"), F.lit(1 << 32)) * ranges / (1 << 32))).cast("int")

    def _write_run(self, rows: DataFrame, n: int, path: str) -> Run:
        """A run of `rows`, sorted inside its ranges."""
        ranges = max(1, round(n / (self.s.keys * self.s.range_rows)))
        rows = rows.select("k1", "k2", "tid", self._range(ranges).alias("kr"))
        rows.repartition("kr").sortWithinPartitions("kr", "k1", "k2", "tid").write.mode("overwrite").partitionBy("kr").parquet(path)
        return Run(path, ranges, n)

    def _read_run(self, run: Run) -> DataFrame:
        rows = self.spark.read.schema("k1 int, k2 int, tid long, kr int").parquet(run.path)
        return rows.select(F.floor(F.col("kr") / run.ranges).cast("int").alias("j"), "k1", "k2", "tid", "kr")

    def _met(self, keys: DataFrame) -> DataFrame:
        """(j, k1, k2, tid, sk) of the rows of earlier runs whose first key part is one of `keys`; only the ranges that these fall into are opened.

        The sketch of a text is kept once and fetched for the texts that were met.
        """
        mine = keys.select("j", "k1").distinct()
        found = None
        for run in self.runs:
            touched = [r[0] for r in mine.select(self._range(run.ranges).alias("kr")).distinct().collect()]  # at most keys * ranges
            old = self._read_run(run).where(F.col("kr").isin(touched)).join(mine, ["j", "k1"], "left_semi").select("j", "k1", "k2", "tid")
            found = old if found is None else found.unionByName(old)
        sketches = self.spark.read.schema("tid long, sk binary").parquet(*self.fresh_at)  # each text once
        return found.join(sketches, "tid").select("j", "k1", "k2", "tid", "sk")

    def _candidates(self, rows: DataFrame, n: int, at: str) -> DataFrame:
        """Candidate pairs (a, b) of texts, at least one of them new, of the `n` key rows: neighbours in windows, and whole groups that a window can't cover.

        One sort over ranges of (key, id) serves both, so rows of one hot key
        are spread over tasks. The ends of neighbouring tasks, 2 * window rows
        of each, meet in a second step: border by border, or all in one row of
        tasks where a task got less than a window, so that no pair is lost. A
        group of equal keys that lies inside one task is compared there; the
        rows of groups that may reach beyond it, or that outgrow a tile, are
        handed on and cut into tiles.
        """
        w, least, agree, tile = self.s.window, self.s.sketch_min, self.s.agree, self.s.tile

        def compare(pdf: pd.DataFrame) -> pd.DataFrame:
            if len(pdf) < 2:
                return pd.DataFrame({"a": np.empty(0, np.int64), "b": np.empty(0, np.int64)})
            j, tid, new = pdf["j"].to_numpy(), pdf["tid"].to_numpy(), pdf["new"].to_numpy()
            sk, size = opened(pdf["sk"])
            a, b = [], []
            for d in range(1, min(w, len(pdf) - 1) + 1):
                i = np.flatnonzero((j[d:] == j[:-d]) & (new[d:] | new[:-d]) & (tid[d:] != tid[:-d]))
                i = i[sizes_agree(size[i], size[i + d], agree)]
                i = i[(sk[i] == sk[i + d]).sum(1) >= least]
                a.append(np.minimum(tid[i], tid[i + d]))
                b.append(np.maximum(tid[i], tid[i + d]))
            return pd.DataFrame({"a": np.concatenate(a), "b": np.concatenate(b)}).drop_duplicates()

        def within(pdf: pd.DataFrame, starts: np.ndarray, ends: np.ndarray) -> pd.DataFrame:
            """Pairs of the groups of rows starts to ends: each new row with every other row."""
            tid, new = pdf["tid"].to_numpy(), pdf["new"].to_numpy()
            sk, size = opened(pdf["sk"])
            a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for s, e in zip(starts, ends, strict=True):
                r = np.arange(s, e)
                p, q = r[new[s:e]], r[~new[s:e]]
                for other in (p, q):
                    i, j = agreeing(sk[p], sk[other], least)
                    if other is p:
                        i, j = i[i < j], j[i < j]
                    ok = sizes_agree(size[p[i]], size[other[j]], agree)
                    u, v = tid[p[i[ok]]], tid[other[j[ok]]]
                    a.append(np.minimum(u, v))
                    b.append(np.maximum(u, v))
            return pd.DataFrame({"a": np.concatenate(a), "b": np.concatenate(b)}).drop_duplicates()

        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            from pyspark import TaskContext

            def found(pairs: pd.DataFrame) -> pd.DataFrame:
                return pairs.assign(border=-1, j=0, k1=0, k2=0, tid=0, sk=b"", new=False, short=False)

            def handed(rows: pd.DataFrame) -> pd.DataFrame:
                return rows.assign(border=-2, a=0, b=0, short=False)

            pid, tail, head, size = TaskContext.get().partitionId(), None, None, 0
            held, inside = None, False  # the group that has not ended, and whether it began in this task and fits a tile
            for pdf in frames:
                if not len(pdf):
                    continue
                head = pdf.head(w) if head is None else pd.concat([head, pdf.head(w - len(head))]) if len(head) < w else head
                size += len(pdf)
                both = pdf if tail is None else pd.concat([tail, pdf], ignore_index=True)
                yield found(compare(both))
                tail = both.tail(w).reset_index(drop=True)
                both = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
                k = both[["j", "k1", "k2"]].to_numpy()
                starts = np.flatnonzero(np.concatenate(([True], (k[1:] != k[:-1]).any(1))))
                last, ends = starts[-1], starts[1:]
                if len(ends):
                    starts = starts[:-1]
                    on = ends - starts > tile
                    on[0] |= not inside
                    if on.any():
                        yield handed(both.iloc[:last][np.repeat(on, ends - starts)])
                    big = ~on & (ends - starts > w + 1) & (np.add.reduceat(both["new"].to_numpy()[:last].astype(int), starts) > 0)
                    if big.any():
                        yield found(within(both, starts[big], ends[big]))
                    inside = True
                held = both.iloc[last:].reset_index(drop=True)
                if len(held) > 1 and (len(held) > tile or not inside):
                    yield handed(held.iloc[:-1])
                    held, inside = held.iloc[-1:].reset_index(drop=True), False
            if size:
                yield handed(held)
                yield head.assign(border=pid, a=0, b=0, short=size < w)
                yield tail.assign(border=pid + 1, a=0, b=0, short=size < w)

        def meet(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.drop_duplicates(["j", "tid"])
            return compare(pdf.sort_values(["j", "k1", "k2", "tid"], kind="stable").reset_index(drop=True))

        # no more tasks than keep each of them busy: a task shorter than a window is rare then
        parts = max(1, min(int(self.spark.conf.get("spark.sql.shuffle.partitions")), n // 5000))
        ordered = rows.repartitionByRange(parts, "j", "k1", "k2", "tid").sortWithinPartitions("j", "k1", "k2", "tid")
        schema = "border int, j int, k1 int, k2 int, tid long, sk binary, new boolean, a long, b long, short boolean"
        out = stored(ordered.select("j", "k1", "k2", "tid", "sk", "new").mapInPandas(run, schema), at)
        ends = out.where("border >= 0")
        # a missing task is one that got no row
        got = ends.where("border > 0 or not short").agg(F.max("short"), F.countDistinct("border")).first()
        if got[0] or (got[1] or 0) < parts + 1:
            ends = ends.withColumn("border", F.lit(0))
        pairs = out.where("border = -1").select("a", "b").unionByName(ends.groupBy("border").applyInPandas(meet, "a long, b long"))
        return pairs.unionByName(self._tiled(out.where("border = -2").select("j", "k1", "k2", "tid", "sk", "new"))).distinct()

    def _tiled(self, rows: DataFrame) -> DataFrame:
        """Candidate pairs (a, b) inside the groups of equal keys that a window can't cover: each new row with every other row.

        The new and the old rows of a group are cut into slices by id, and each
        pair of slices with new rows on one side is a tile of its own, so no
        task holds more than two slices, however large the group.
        """
        least, agree, tile, group = self.s.sketch_min, self.s.agree, self.s.tile, ["j", "k1", "k2"]

        def pairs_of(pdf: pd.DataFrame, bounds: np.ndarray) -> pd.DataFrame:
            tid, new, own = pdf["tid"].to_numpy(), pdf["new"].to_numpy(), pdf["own"].to_numpy()
            kind, left, right = pdf["kind"].to_numpy(), pdf["x"].to_numpy(), pdf["y"].to_numpy()
            sk, size = opened(pdf["sk"])
            a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for s, e in zip(bounds[:-1], bounds[1:], strict=True):
                r = np.arange(s, e)
                if kind[s] == 0:
                    p, q = r[new[s:e]], r[~new[s:e]]
                else:
                    p, q = r[own[s:e] == left[s]], r[own[s:e] == right[s]]
                i, j = agreeing(sk[p], sk[q], least)
                if kind[s] == 1 and left[s] == right[s]:
                    i, j = i[i < j], j[i < j]
                ok = sizes_agree(size[p[i]], size[q[j]], agree)
                u, v = tid[p[i[ok]]], tid[q[j[ok]]]
                a.append(np.minimum(u, v))
                b.append(np.maximum(u, v))
            return pd.DataFrame({"a": np.concatenate(a), "b": np.concatenate(b)}).drop_duplicates()

        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            rest = None
            for pdf in frames:
                both = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
                k = both[[*group, "kind", "x", "y"]].to_numpy()
                starts = np.flatnonzero(np.concatenate(([True], (k[1:] != k[:-1]).any(1)))) if len(k) else np.zeros(1, int)
                if len(starts) > 1:
                    yield pairs_of(both, starts)
                rest = both.iloc[starts[-1] :].reset_index(drop=True)
            if rest is not None and len(rest):
                yield pairs_of(rest, np.array([0, len(rest)]))

        sizes = rows.groupBy(*group).agg(F.count_if("new").alias("m"), F.count(F.lit(1)).alias("n")).where(f"n > {self.s.window + 1} and m > 0")
        cut = sizes.select(*group, F.ceil(F.col("m") / tile).cast("int").alias("m"), F.ceil((F.col("n") - F.col("m")) / tile).cast("int").alias("o"))
        own = F.pmod(F.xxhash64("tid"), F.when(F.col("new"), F.col("m")).otherwise(F.col("o"))).cast("int")
        tiles = F.expr("""case when not new then transform(sequence(0, m - 1), i -> struct(0 as kind, i as x, own as y))
            else concat(transform(sequence(0, m - 1), i -> struct(1 as kind, least(i, own) as x, greatest(i, own) as y)),
                        transform(filter(sequence(0, o), i -> i < o), i -> struct(0 as kind, own as x, i as y))) end""")
        tiled = rows.join(cut, group).withColumn("own", own).withColumn("t", F.explode(tiles)).select(*group, "t.kind", "t.x", "t.y", "own", "tid", "sk", "new")
        key = [*group, "kind", "x", "y"]
        parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        return tiled.repartition(parts, *key).sortWithinPartitions(*key).mapInPandas(run, "a long, b long")

    def _bounded(self, pairs: DataFrame) -> DataFrame:
        """The pairs whose bucket counts leave it open that they agree; only the counts of texts in a pair are fetched."""
        agree = self.s.agree

        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in frames:
                if len(pdf):
                    x, y = (np.frombuffer(b"".join(pdf[c]), np.uint8).reshape(len(pdf), -1) for c in ("x", "y"))
                    yield pdf.loc[may_agree(x, y, agree), ["a", "b"]]

        ids = pairs.select(F.explode(F.array("a", "b")).alias("tid")).distinct()
        counts = sifted(self._members("tid long, counts binary"), ids, "tid").join(ids, "tid", "left_semi").dropDuplicates(["tid"])
        both = pairs.join(counts.select(F.col("tid").alias("a"), F.col("counts").alias("x")), "a").join(counts.select(F.col("tid").alias("b"), F.col("counts").alias("y")), "b")
        return both.select("a", "b", "x", "y").mapInPandas(run, "a long, b long")

    def _verified(self, pairs: DataFrame, source: DataFrame) -> DataFrame:
        """The pairs whose whole texts agree."""
        agree = self.s.agree

        def units(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in frames:
                for part, texts in _pieces(pdf, "raw_text"):
                    h, doc, _, _, own = tokens(texts)
                    u = (bag(h, doc, own) >> np.uint64(32)).astype(np.uint32)
                    cut = np.searchsorted(doc, np.arange(len(texts) + 1))
                    yield pd.DataFrame({"tid": part["tid"].to_numpy(), "u": [np.sort(u[cut[i] : cut[i + 1]]).tobytes() for i in range(len(texts))]})

        def common(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            def numbered(x: np.ndarray) -> np.ndarray:
                """Each value with its place among equal ones: a bag as a set."""
                first = np.concatenate(([True], x[1:] != x[:-1]))
                return (x.astype(np.uint64) << np.uint64(24)) + (np.arange(len(x)) - np.maximum.accumulate(np.where(first, np.arange(len(x)), 0))).astype(np.uint64)

            for pdf in frames:
                ok = []
                for x, y in zip(pdf["u"], pdf["v"], strict=True):
                    p, q = numbered(np.frombuffer(x, np.uint32)), numbered(np.frombuffer(y, np.uint32))
                    i = np.searchsorted(q, p)
                    n = int((q[np.minimum(i, len(q) - 1)] == p).sum())
                    ok.append(2 * n >= agree * (len(p) + len(q)))
                yield pdf.loc[ok, ["a", "b"]]

        ids = pairs.select(F.explode(F.array("a", "b")).alias("tid")).distinct()
        first = sifted(self._members(), ids, "tid").join(ids, "tid", "left_semi").groupBy("tid").agg(F.min("ord").alias("ord"))
        first = stored(first.select("tid", F.expr("substring(ord, 12)").alias("job_id")), f"{self.path}/firsts/{self.batches}")
        texts = sifted(source.where("raw_text is not null").select("job_id", "raw_text"), first, "job_id").join(first, "job_id").dropDuplicates(["tid"])
        u = texts.select("tid", "raw_text").mapInPandas(units, "tid long, u binary")
        u = stored(u, f"{self.path}/units/{self.batches}")
        both = pairs.join(u.select(F.col("tid").alias("a"), "u"), "a").join(u.select(F.col("tid").alias("b"), F.col("u").alias("v")), "b")
        return both.select("a", "b", "u", "v").mapInPandas(common, "a long, b long")

    def _members(self, schema: str = "ord string, tid long") -> DataFrame:
        """Columns of the signed texts of all batches taken."""
        return self.spark.read.schema(schema).parquet(*self.members_at) if self.members_at else self.spark.createDataFrame([], schema)

    # -- a batch ----------------------------------------------------------
    def accept(self, batch: DataFrame, source: DataFrame) -> None:
        """Take a batch. `source` has (job_id, raw_text) of the batch and all earlier ones, read only for verification."""
        i = self.batches
        signed = stored(self._signed(batch), f"{self.path}/signed/{i}")
        fresh = signed.groupBy("tid").agg(F.min_by(F.struct("keys", "sk"), "ord").alias("r")).select("tid", "r.*")
        if self.members_at:
            fresh = fresh.join(self._members("tid long"), "tid", "left_anti")
        fresh = stored(fresh, f"{self.path}/fresh/{i}")
        n = fresh.count()
        if n or signed.limit(1).count():
            self.members_at.append(f"{self.path}/signed/{i}")
        if n:
            keys = self._key_rows(fresh)
            rows = self._key_rows(fresh, "sk").withColumn("new", F.lit(True))
            if self.runs:
                rows = rows.unionByName(self._met(keys).withColumn("new", F.lit(False)))
            rows = stored(rows, f"{self.path}/met/{i}")
            pairs = stored(self._candidates(rows, rows.count(), f"{self.path}/windows/{i}"), f"{self.path}/pairs/{i}")
            removed(self.spark, f"{self.path}/met/{i}")
            pairs = stored(self._bounded(pairs), f"{self.path}/candidates/{i}")
            links = stored(self._verified(pairs, source), f"{self.path}/links/{i}")
            self._relabel(links)
            for name in ("windows", "pairs", "candidates", "firsts", "units", "links", "names"):
                removed(self.spark, f"{self.path}/{name}/{i}")
            self.runs.append(self._write_run(keys, n * self.s.keys, f"{self.path}/runs/{i}"))
            self.fresh_at.append(f"{self.path}/fresh/{i}")
            self._compact()
        self.batches += 1

    def _relabel(self, links: DataFrame) -> None:
        """Classes of the linked texts: earlier classes that the links touch are merged into the earliest one."""
        texts = links.select(F.explode(F.array("a", "b")).alias("tid")).distinct()
        first = self._members().join(texts, "tid", "left_semi").groupBy("tid").agg(F.min("ord").alias("ord"))
        name = stored(first, f"{self.path}/names/{self.batches}")
        named = links.join(name.select(F.col("tid").alias("a"), F.col("ord").alias("src")), "a").join(name.select(F.col("tid").alias("b"), F.col("ord").alias("dst")), "b").select("src", "dst")
        if self.classes_at:
            # Touched texts that already have a class keep their tie to it.
            known = self.spark.read.schema("node string, label string").parquet(*self.classes_at)
            named = named.unionByName(known.join(name.select(F.col("ord").alias("node")), "node", "left_semi").select(F.col("node").alias("src"), F.col("label").alias("dst")))
        at = f"{self.path}/classes/{self.batches}"
        stored(connected_components(named), at)
        self.classes_at.append(at)

    def _compact(self) -> None:
        """Merge the runs of a size (up to fourfold) once there are compact_every of them: a row is rewritten a logarithmic number of times."""
        size = lambda r: r.rows.bit_length() // 2
        while True:
            tiers: dict[int, list[Run]] = {}
            for r in self.runs:
                tiers.setdefault(size(r), []).append(r)
            full = next((t for _, t in sorted(tiers.items()) if len(t) >= self.s.compact_every), None)
            if not full:
                return
            one = self._read_run(full[0])
            for r in full[1:]:
                one = one.unionByName(self._read_run(r))
            self.merges += 1
            merged = self._write_run(one, sum(r.rows for r in full), f"{self.path}/runs/merged-{self.merges}")
            self.runs = [r for r in self.runs if r not in full] + [merged]
            for r in full:
                removed(self.spark, r.path)

    # -- results ----------------------------------------------------------
    def members(self) -> DataFrame:
        """(job_id, first_seen order, text id, accepted): accepted is the job_id of the class's accepted posting."""
        m = self._members().distinct()
        head = m.groupBy("tid").agg(F.min("ord").alias("node"))
        if self.classes_at:
            known = self.spark.read.schema("node string, label string").parquet(*self.classes_at)
            # A text that later links touched again has several labels; labels form chains of merges.
            final = connected_components(known.select(F.col("node").alias("src"), F.col("label").alias("dst")))
            head = head.join(final, "node", "left")
        else:
            head = head.withColumn("label", F.lit(None).cast("string"))
        head = head.select("tid", F.coalesce("label", "node").alias("label"))
        return m.join(head, "tid").select(F.expr("substring(ord, 12)").alias("job_id"), F.col("tid"), F.expr("substring(label, 12)").alias("accepted")).distinct()

    def pairs(self) -> DataFrame:
        """(job_id_a, job_id_b): each copy with its accepted posting, the smaller id first."""
        m = self.members().where("job_id <> accepted")
        return m.select(F.least("job_id", "accepted").alias("job_id_a"), F.greatest("job_id", "accepted").alias("job_id_b")).distinct()


def dedup_in_batches(postings: DataFrame, batch_days: int = 48, settings: Settings = Settings()) -> HistoryDedup:
    """`postings` (job_id, first_seen, raw_text) taken in batches of `batch_days` of first_seen; rows without a day come last."""
    state = HistoryDedup(postings.sparkSession, settings)
    lo, hi = postings.agg(F.min("first_seen"), F.max("first_seen")).first()
    n = ((hi - lo).days // batch_days + 1) if lo else 0
    day = F.coalesce(F.floor(F.datediff(F.col("first_seen"), F.lit(lo)) / batch_days), F.lit(max(n - 1, 0))) if lo else F.lit(0)
    dated = postings.withColumn("b", day)
    for i in range(max(n, 1)):
        state.accept(dated.where(F.col("b") == i), dated.where(F.col("b") <= i))
    return state
