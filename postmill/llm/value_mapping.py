"""Mapping freely typed values to the entries of a reference list.

A set-similarity join with prefix filtering: every writing becomes a set of
tokens (its letters and letter pairs, numbered when they repeat). The least
similarity depends on the length of the reference name: it is the one that
the edits allowed at this length can leave. Tokens are ordered by their rarity
among the names, and only the rarest ones of each set, enough that two similar
sets must share one, are joined, under length and positional filters. Jaccard
is verified on the whole sets, an edit distance confirms, and the entry of the
greatest similarity is kept.
"""

from __future__ import annotations

import html
import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postmill.sources.tables import shared_dir, stored

# Words that stand around a name without changing what is meant.
BEFORE = "experience with|experience in|experience of|use of|using|knowledge in|knowledge of|working knowledge of|strong|good|solid|proficient in|proficiency in|familiar with|familiarity with|skills in|expert in|hands-on"
AFTER = "skills|skill|knowledge|experience|expertise|basics|certified|proficiency"
LEVEL = "basic|advanced|intermediate|beginner|expert|fluent|senior|junior|required|preferred|optional|a plus|nice to have|must have"


@dataclass(frozen=True)
class Settings:
    """exact_up_to, one_edit_up_to, edits: reference names of at most so many
    characters must agree exactly, or up to one edit; longer ones up to
    `edits` (a swap of neighbours is one). shared: tokens that a pair must have
    in common among the looked-up ones, which are as many more; a name has
    three tokens at least, and no pair can do with less in common.
    """

    exact_up_to: int = 4
    one_edit_up_to: int = 6
    edits: int = 2
    shared: int = 3

    def edits_of(self, length: int) -> int:
        return 0 if length <= self.exact_up_to else 1 if length <= self.one_edit_up_to else self.edits

    def least(self, tokens: int) -> float:
        """Jaccard that a name with so many tokens (2 * length + 1) keeps under all its edits: an edit takes and adds three tokens at most."""
        gone = 3 * self.edits_of((tokens - 1) // 2)
        return max(0.0, (tokens - gone) / (tokens + gone))

    def prefix_of_name(self, tokens: int) -> int:
        return min(tokens, tokens - math.ceil(self.least(tokens) * tokens - 1e-9) + self.shared)

    def prefix_of_value(self, tokens: int) -> int:
        """Tokens of a value that have to be looked up, for the shortest name that it can be a writing of: an edit changes the length by one."""
        if not tokens:
            return 0
        names = [n for n in range(max(3, tokens - 2 * self.edits), tokens + 2 * self.edits + 1) if abs(n - tokens) <= 2 * self.edits_of((n - 1) // 2)]
        return min(tokens, max((tokens - math.ceil(self.least(n) * tokens - 1e-9) + self.shared for n in names), default=0))


_EDGE = re.compile(r"^[^\w.]+|[^\w#+]+$")
_HEAD = re.compile(rf"^(?:{BEFORE})\s+")
_TAIL = re.compile(rf"(?:\s*[(\[](?:{LEVEL})[)\]]?|\s*[-–,:]?\s*\(?\d+\+?\s*(?:yrs?|years?)\.?\)?|\s+(?:{AFTER})|\s+v?\d+(?:\.\d+)*|(?<=[a-z#+])\d)$")


def written(value: str | None) -> str:
    """A value without case, marks, fillers, level and version; '' if nothing is left."""
    if not isinstance(value, str):
        return ""
    t = unicodedata.normalize("NFKD", unicodedata.normalize("NFKC", html.unescape(value)))
    t = "".join(c for c in t if not unicodedata.combining(c) and unicodedata.category(c) not in ("Cf", "Cc") or c in "\t\n")
    t = " ".join(t.lower().split())
    while True:
        old = t
        t = _EDGE.sub("", t)
        t = _HEAD.sub("", t)
        cut = _TAIL.sub("", t)
        t = cut if re.search(r"\w", cut) else t
        if t == old:
            return t


def squashed(text: str) -> str:
    """Only the characters that tell names apart: letters, digits, # and +; 0 and 1 beside letters read as o and l."""
    t = re.sub(r"[^\w#+]|_", "", re.sub(r"&+|(?<=\s)\+(?=\s)", "and", text))
    return re.sub(r"(?<=[^\W\d])[01]|[01](?=[^\W\d])", lambda m: "ol"[int(m.group())], t)


def token_set(s: str) -> list[str]:
    seen: dict[str, int] = {}
    out = []
    for g in [*s, *(a + b for a, b in zip("^" + s, s + "$", strict=True))] if s else []:
        seen[g] = seen.get(g, 0) + 1
        out.append(g if seen[g] == 1 else f"{g}{seen[g]}")
    return out


def distance(a: str, b: str, most: int) -> int:
    """Edits (insert, delete, replace, swap of two with anything edited between them) from a to b, or most + 1 if there are more."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most or most == 0:
        return most + 1
    big = len(a) + len(b)
    d = [[big] * (len(b) + 2) for _ in range(len(a) + 2)]
    for i in range(len(a) + 1):
        d[i + 1][1] = i
    for j in range(len(b) + 1):
        d[1][j + 1] = j
    last: dict[str, int] = {}
    for i, x in enumerate(a, 1):
        met = 0
        for j, y in enumerate(b, 1):
            k, m = last.get(y, 0), met
            if x == y:
                met = j
            d[i + 1][j + 1] = min(d[i][j] + (x != y), d[i + 1][j] + 1, d[i][j + 1] + 1, d[k][m] + (i - k - 1) + 1 + (j - m - 1))
        if min(d[i + 1][1:]) > most + 1:
            return most + 1
        last[x] = i
    return min(d[-1][-1], most + 1)


def letters_apart(a: str, b: str) -> int:
    """Letters that one of a and b has more of, at most: no less than this many edits are needed in any order of words."""
    x, y = Counter(a), Counter(b)
    return max((x - y).total(), (y - x).total())


def orders(text: str) -> list[str]:
    """The text and the rotations of its words, squashed, each once: 'mapping, geospatial' is geospatial mapping."""
    words = [w for w in re.split(r"[\s,/_-]+", text) if w]
    turned = [squashed(" ".join(words[k:] + words[:k])) for k in range(len(words))]
    return [x for x in dict.fromkeys([squashed(text), *turned]) if x]


@F.udf(T.StringType(), useArrow=True)
def _written(value):  # noqa: ANN001, ANN202
    return written(value)


@F.udf(T.ArrayType(T.StringType()), useArrow=True)
def _orders(text):  # noqa: ANN001, ANN202
    return orders(text)


@F.udf(T.ArrayType(T.StringType()), useArrow=True)
def _tokens(form):  # noqa: ANN001, ANN202
    return token_set(form)


def _ordered(sets: DataFrame, rarity: DataFrame, key: str, prefix) -> DataFrame:  # noqa: ANN001
    """(key, toks, kept): each token set as an array, tokens that no name has first, then from the rarest to the most common; and how many are looked up."""
    t = sets.select(key, F.explode("toks").alias("token")).join(rarity, "token", "left")
    t = t.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token"))), lambda x: x["token"]).alias("toks"))

    @F.udf(T.IntegerType(), useArrow=True)
    def kept(n):  # noqa: ANN001, ANN202
        return prefix(n)

    return t.withColumn("kept", kept(F.size("toks")))


def map_values(values: DataFrame, entries: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(value, entry_id, similarity, edits) for each distinct non-null row of `values` (value).

    `entries` has (entry_id, name); an entry may have several names. entry_id is
    null where no name is near enough. The entry of the greatest similarity is
    kept, of equal ones the one of fewer edits, then of the smaller id. Values
    that differ only in fillers are joined once. Blank values and values
    without letters or digits have no entry. No side is assumed small: the
    joins are equi-joins on tokens and keys, which adaptive execution
    broadcasts only below its size threshold.
    """
    s, base = settings, shared_dir(values.sparkSession)
    keyed = stored(values.where("value is not null").distinct().withColumn("key", _written("value")), f"{base}/keyed")
    forms = stored(keyed.select("key").distinct().select("key", F.explode(_orders("key")).alias("form")), f"{base}/forms")
    left = forms.select("form").distinct().select("form", _tokens("form").alias("toks"))
    right = entries.where("name is not null and entry_id is not null").select("entry_id", _orders(_written("name"))[0].alias("name")).where("name is not null").distinct()
    right = stored(right, f"{base}/right")
    names = stored(right.select("name").distinct().select("name", _tokens("name").alias("toks")), f"{base}/names")
    rarity = stored(names.select(F.explode("toks").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n")), f"{base}/rarity")
    lo, ro = stored(_ordered(left, rarity, "form", s.prefix_of_value), f"{base}/left-ordered"), stored(_ordered(names, rarity, "name", s.prefix_of_name), f"{base}/right-ordered")

    @F.udf(T.StructType([T.StructField("least", T.DoubleType()), T.StructField("edits", T.IntegerType())]), useArrow=True)
    def demands(n):  # noqa: ANN001, ANN202
        return {"least": s.least(n), "edits": s.edits_of((n - 1) // 2)}

    looked = lambda o, key, size, place: o.select(key, F.size("toks").alias(size), F.posexplode(F.slice("toks", F.lit(1), F.col("kept"))).alias(place, "token"))
    px = looked(lo, "form", "nx", "px")
    py = looked(ro, "name", "ny", "py").withColumn("d", demands("ny")).select("name", "ny", "py", "token", "d.least", "d.edits")
    near_in_length = F.abs(F.col("nx") - F.col("ny")) <= 2 * F.col("edits")
    met = px.join(py, "token").where(near_in_length).groupBy("form", "name").agg(*[F.first(c).alias(c) for c in ("nx", "ny", "least", "edits")], F.min("px").alias("px"), F.min("py").alias("py"), F.count(F.lit(1)).alias("k"))
    # the first shared token and what is left of either set must be able to make up the overlap
    enough = 1 + F.least(F.col("nx") - F.col("px") - 1, F.col("ny") - F.col("py") - 1) >= F.col("least") / (1 + F.col("least")) * (F.col("nx") + F.col("ny")) - 1e-9
    pairs = met.where(F.col("k") >= s.shared).where(enough).select("form", "name", "least", "edits")
    full = pairs.join(lo.select("form", "toks"), "form").join(ro.select("name", F.col("toks").alias("toks_y")), "name")
    common = F.size(F.array_intersect("toks", "toks_y"))
    full = full.withColumn("similarity", common / (F.size("toks") + F.size("toks_y") - common)).where(F.col("similarity") >= F.col("least") - 1e-9)

    def near(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            most = pdf["edits"].to_numpy()
            found = [distance(f, n, m) if m and letters_apart(f, n) <= m else 0 if f == n else m + 1 for f, n, m in zip(pdf["form"], pdf["name"], most.tolist(), strict=True)]
            yield pdf.assign(edits=found)[np.array(found, int) <= most]

    # the edit distance costs far more than its few bytes tell AQE: keep all tasks
    parts = int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    good = full.select("form", "name", "similarity", "edits").repartition(parts, "form", "name").mapInPandas(near, "form string, name string, similarity double, edits int")
    good = stored(good, f"{base}/good").join(right, "name").join(forms, "form")
    best = good.groupBy("key").agg(F.min(F.struct((-F.col("similarity")).alias("s"), "edits", "entry_id")).alias("b"))
    return keyed.join(best, "key", "left").select("value", F.col("b.entry_id").alias("entry_id"), (-F.col("b.s")).alias("similarity"), F.col("b.edits").alias("edits"))
