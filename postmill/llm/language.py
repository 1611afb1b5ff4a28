"""Language of texts and of the passages of mixed texts.

A multinomial logistic regression over TF-IDF weighted, hashed character
n-grams, trained with follow-the-regularised-leader (FTRL-proximal, elastic
net, so most weights are exactly zero) on a bounded sample of labelled rows,
then calibrated by a temperature. Document frequencies are counted over all
texts. Lines are scored, smoothed over their order and joined to passages.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.llm.textarrays import _INVISIBLE, _TAG, IDEOGRAPHS, LAST, mix
from postmill.sources.tables import spread

LANGS = ("en", "th", "ja", "zh", "vi", "id", "de", "fr")

# Writings of the languages' names, besides their two-letter codes.
NAMES = {
    "en": "eng english anglais englisch inggris อังกฤษ ภาษาอังกฤษ 英語 英语",
    "th": "tha thai ไทย ภาษาไทย thaï thailändisch タイ語 泰语",
    "ja": "jpn japanese jp 日本語 japonais japanisch jepang ญี่ปุ่น 日语 日文",
    "zh": "zho chi cmn chinese cn 中文 汉语 漢語 中国語 普通话 mandarin จีน chinois chinesisch",
    "vi": "vie vietnamese vn tiếngviệt tiengviet việt เวียดนาม ベトナム語 越南语",
    "id": "ind indonesian in bahasa bahasaindonesia indonesia indonesisch อินโดนีเซีย",
    "de": "deu ger german deutsch allemand เยอรมัน ドイツ語 德语",
    "fr": "fra fre french français francais französisch ฝรั่งเศส フランス語 法语",
}


@dataclass(frozen=True)
class Settings:
    """bits: size of the hashed n-gram space. sample_rows: labelled rows the
    model is fitted on at most, drawn evenly by the hash of the id (the only
    bounded step). epochs,
    batch, alpha, beta, l1, l2: FTRL; clean_alpha: its step in the coarse fits
    that tell wrong labels. switch: cost of a change of language
    between lines. low_words, low_own: spaced words in lower case, characters
    of an unspaced script, from which a line says something about its language.
    contact_chars: a line with contact data and less prose than this says nothing.
    """

    bits: int = 15
    sample_rows: int = 3000
    epochs: int = 3
    batch: int = 128
    alpha: float = 0.5
    clean_alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.02
    switch: float = 3.0
    low_words: int = 3
    low_own: int = 6
    contact_chars: int = 45


_BREAK = re.compile(r"\r\n|[\n\r\v\f\x85  ]")
_BLOCK = re.compile(r"(?i)<(?:br|/p|/li|/div|/h\d|/tr)\b[^<>]*>")
_CONTACT = re.compile(r"[@＠]|\[at\]| at \w+ dot |\d[\d\-. ()]{7,}\d|\bSoi\b|\bMoo\b|\b(?:St|Street|Road|Rd|Lane|Avenue|Close|Boulevard)\b")
_ITEMS = re.compile(r"\s*(?:[/,;|•・、，]| and )\s*")
_CLASS: np.ndarray | None = None


def _listed(line: str) -> bool:
    """Is the line a list of at least three short items, as of tools?"""
    if len(line) > 160:
        return False
    items = _ITEMS.split(re.sub(r"^[^:：]{0,25}[:：]", "", line))
    return len(items) >= 3 and all(len(x.split()) <= 3 and len(x) <= 28 for x in items)


def lines_of(text: str) -> list[str]:
    """The non-blank lines of a text, without tags, entities and invisible characters."""
    if "&" in text:
        text = html.unescape(text)
    if "<" in text:
        text = _TAG.sub(" ", _BLOCK.sub("\n", text))
    if not text.isascii():
        text = _INVISIBLE.sub("", text)
    out = [x.strip() for x in _BREAK.split(text)]
    return [x if x.isascii() else unicodedata.normalize("NFKC", x) for x in out if x]


def _classes() -> np.ndarray:
    """Of each code point: 0 other, 1 lower-case or caseless letter, 2 capital, 3 letter of an unspaced script."""
    c = np.zeros(LAST + 1, np.uint8)
    c[IDEOGRAPHS:LAST] = 3
    for i in range(IDEOGRAPHS):
        ch = chr(i)
        if ch.isalpha() or unicodedata.category(ch).startswith("M"):
            c[i] = 2 if ch.isupper() or ch.istitle() else 1
    for a, b in ((0x0E01, 0x0E4E), (0x3041, 0x30FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF)):
        c[a : b + 1] = np.where(c[a : b + 1] > 0, 3, 0)
    return c


def grams(lines: list[str], bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(n-gram, line) of all 2- and 3-grams; per line the words in lower case and the characters of unspaced scripts."""
    global _CLASS
    if _CLASS is None:
        _CLASS = _classes()
    n = len(lines)
    joined = "\n".join(["", *lines, ""])
    raw = np.minimum(np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32), np.uint32(LAST))
    line = np.cumsum(raw == 10, dtype=np.int32) - 1
    cls = _CLASS[raw]
    low = np.frombuffer(joined.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    low = raw if len(low) != len(raw) else np.minimum(low, np.uint32(LAST))
    prev = np.concatenate(([0], cls[:-1]))
    words = np.bincount(line[(cls == 1) & (prev == 0)], minlength=n + 1)[:n]
    own = np.bincount(line[cls == 3], minlength=n + 1)[:n]
    # letters and single gaps, hashed in 32 bits
    keep = np.flatnonzero((cls > 0) | (prev > 0))
    x, at = np.where(cls[keep] > 0, low[keep], np.uint32(32)), line[keep]
    if len(x) < 3:
        e = np.empty(0, np.int64)
        return e, e, words, own
    shift = np.uint32(32 - bits)
    a = x * np.uint32(0x9E3779B1)
    pair = (a[:-1] ^ (a[:-1] >> np.uint32(15))) + x[1:] * np.uint32(0x85EBCA77)
    three = ((pair[:-1] ^ (pair[:-1] >> np.uint32(13))) * np.uint32(0xC2B2AE3D) + x[2:] * np.uint32(0x27D4EB2F)) * np.uint32(0x165667B1) >> shift
    two = (pair ^ (pair >> np.uint32(16))) * np.uint32(0x7FEB352D) >> shift
    ok2, ok3 = np.flatnonzero(at[:-1] == at[1:]), np.flatnonzero(at[:-2] == at[2:])
    g, d = np.concatenate([two[ok2], three[ok3]]), np.concatenate([at[ok2], at[ok3]])
    return g.astype(np.int64), d, words, own


@dataclass
class Model:
    settings: Settings
    idf: np.ndarray
    weights: np.ndarray = field(default=None)  # type: ignore[assignment]
    temperature: float = 1.0

    def scores(self, lines: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Per line: sums of weights [n, langs], squared norm, words in lower case, unspaced characters."""
        n = len(lines)
        g, d, words, own = grams(lines, self.settings.bits)
        s, norm = np.zeros((n, len(LANGS)), np.float32), np.zeros(n, np.float32)
        if len(g):
            table = self.idf[:, None] * self.weights
            norm = np.bincount(d, self.idf[g] ** 2, minlength=n).astype(np.float32)
            w = table[g]
            starts = np.flatnonzero(np.concatenate(([True], d[1:] != d[:-1])))  # the 2-grams, then the 3-grams: each in the order of the lines
            np.add.at(s, d[starts], np.add.reduceat(w, starts, axis=0))
        return s, norm, words, own

    def probabilities(self, s: np.ndarray, norm: np.ndarray) -> np.ndarray:
        z = (s / np.sqrt(np.maximum(norm, 1e-9))[:, None]) / self.temperature
        e = np.exp(z - z.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)


def fit_ftrl(model: Model, lines: list[str], y: np.ndarray, alpha: float, epochs: int) -> None:
    """Fit the weights by FTRL-proximal with an elastic net, in mini-batches in a fixed order."""
    s, k, size = model.settings, len(LANGS), 1 << model.settings.bits
    z, n = np.zeros((size, k)), np.zeros((size, k))

    def solved(zz: np.ndarray, nn: np.ndarray) -> np.ndarray:
        return np.where(np.abs(zz) <= s.l1, 0.0, -(zz - np.sign(zz) * s.l1) / ((s.beta + np.sqrt(nn)) / alpha + s.l2))

    share = np.bincount(y, minlength=k)
    weight = np.sqrt(share.max() / np.maximum(share, 1))  # rare languages count for more, but not as much as the common one
    order = np.argsort(mix(np.arange(len(lines), dtype=np.uint64)))
    for _ in range(epochs):
        for i in range(0, len(order), s.batch):
            pick = order[i : i + s.batch]
            g, d, _, _ = grams([lines[j] for j in pick], s.bits)
            if not len(g):
                continue
            u, inv = np.unique(g, return_inverse=True)
            x = model.idf[g]
            norm = np.sqrt(np.maximum(np.bincount(d, x**2, minlength=len(pick)), 1e-9))
            x = x / norm[d]
            w = solved(z[u], n[u])
            score = np.stack([np.bincount(d, x * w[inv, c], minlength=len(pick)) for c in range(k)], 1)
            p = np.exp(score - score.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(pick)), y[pick]] -= 1
            p *= weight[y[pick]][:, None]
            grad = np.stack([np.bincount(inv, x * p[d, c], minlength=len(u)) for c in range(k)], 1)
            sigma = (np.sqrt(n[u] + grad**2) - np.sqrt(n[u])) / alpha
            z[u] += grad - sigma * w
            n[u] += grad**2
    model.weights = solved(z, n).astype(np.float32)


def calibrate(model: Model, lines: list[str], y: np.ndarray, text: np.ndarray) -> None:
    """The temperature with the least log loss on held-out texts, none of them left out.

    What is judged later are passages, so each text is one (its lines joined,
    as `passages` does), and single lines count as passages of a line. Some
    labels are wrong: the loss is that of a label that names the text's
    language with probability 1 - e and any other one evenly with e, and e is
    estimated with the temperature.
    """
    model.temperature = 1.0
    if not len(lines):
        return
    s, norm, _, _ = model.scores(lines)
    starts = np.flatnonzero(np.concatenate(([True], text[1:] != text[:-1])))
    s = np.concatenate([s, np.add.reduceat(s, starts, axis=0)])
    norm = np.concatenate([norm, np.add.reduceat(norm, starts)])
    y = np.concatenate([y, y[starts]])
    z = s / np.sqrt(np.maximum(norm, 1e-9))[:, None]
    best = None
    for t in np.geomspace(0.05, 10, 60):
        q = z / t
        q = np.exp(q - q.max(1, keepdims=True))
        p = q[np.arange(len(y)), y] / q.sum(1)
        for e in (0.003, 0.01, 0.03, 0.06, 0.1, 0.15, 0.2):
            loss = float(-np.mean(np.log((1 - e) * p + e / len(LANGS))))
            if best is None or loss < best[0]:
                best = (loss, t)
    model.temperature = float(best[1])


def calibration_error(confidence: np.ndarray, right: np.ndarray, bins: int = 10) -> float:
    """Expected calibration error: the mean distance of confidence and accuracy over bins of equal width, by their sizes."""
    k = np.minimum((confidence * bins).astype(int), bins - 1)
    n = np.maximum(np.bincount(k, minlength=bins), 1)
    gap = np.abs(np.bincount(k, confidence, minlength=bins) - np.bincount(k, right, minlength=bins)) / n
    return float((gap * n).sum() / max(1, len(confidence)))


def label_code(label):  # noqa: ANN001, ANN201
    """Column: two-letter code of a declared label in any spelling; null if it names none of the languages."""
    key = F.regexp_replace(F.lower(F.trim(label)), r"[\s.]+", "")
    head = F.substring_index(F.regexp_replace(key, "_", "-"), "-", 1)
    pairs = [x for code in LANGS for name in [code, *NAMES[code].split()] for x in (F.lit(name), F.lit(code))]
    table = F.create_map(*pairs)
    return F.coalesce(F.try_element_at(table, key), F.try_element_at(table, head))


def document_frequencies(texts: DataFrame, column: str, settings: Settings) -> tuple[np.ndarray, int]:
    """(documents with each hashed n-gram, documents), counted over all rows; the result's size is fixed by bits."""
    bits = settings.bits

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        df, n = np.zeros((1 << bits) + 1, np.int64), 0
        for pdf in frames:
            texts = [t for t in pdf["t"] if isinstance(t, str)]
            for i in range(0, len(texts), 200):
                part = [" ".join(lines_of(t)) for t in texts[i : i + 200]]
                g, d, _, _ = grams(part, bits)
                n += len(part)
                seen = np.zeros((len(part), 1 << bits), bool)
                seen[d, g] = True
                df[:-1] += seen.sum(0)
        df[-1] = n
        some = np.flatnonzero(df)
        yield pd.DataFrame({"g": some, "n": df[some]})

    rows = spread(texts.select(F.col(column).alias("t"))).mapInPandas(count, "g int, n long").groupBy("g").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros((1 << bits) + 1, np.int64)
    out[rows["g"].to_numpy()] = rows["n"].to_numpy()
    return out[:-1], int(out[-1])


def _plain(line: str) -> str:
    """The line as it is typed without marks on its letters."""
    t = unicodedata.normalize("NFD", line.replace("đ", "d").replace("Đ", "D").replace("ß", "ss"))
    return "".join(c for c in t if not unicodedata.category(c).startswith("Mn"))


def train(texts: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """Fit a model on `texts` (id, text) with the noisy codes of `labels` (id, code).

    Frequencies come from all texts. The regression is fitted on at most
    `sample_rows` labelled texts in their natural proportions (a rare language
    has many wrong labels of a common one), and fitted again without the lines that the first fit gives to another language
    with certainty (wrong labels and other passages of mixed texts).
    """
    s = settings
    df, n = document_frequencies(texts, "text", s)
    model = Model(s, np.log((1 + n) / (1 + df)).astype(np.float32) + 0.1)
    model.weights = np.zeros((1 << s.bits, len(LANGS)), np.float32)
    known = labels.where("code is not null and id is not null")
    total = known.count()
    if not total:
        return model
    place = F.pmod(F.xxhash64("id"), F.lit(1_000_003)) / 1_000_003
    picked = known.withColumn("place", place).where(F.col("place") < min(1.0, 1.2 * s.sample_rows / total)).select("id", "code", "place").orderBy("place", "id").limit(s.sample_rows)
    rows = texts.join(F.broadcast(picked), "id").dropDuplicates(["id"]).orderBy("place", "id").collect()
    lines, y, held_lines, held_y, held_text = [], [], [], [], []
    for k, r in enumerate(rows):
        if not isinstance(r["text"], str):
            continue
        held, code = k % 6 == 0, LANGS.index(r["code"])
        for ln in lines_of(r["text"]):
            if sum(c.islower() for c in ln) >= 12 or any(ord(c) > 0xE00 for c in ln):
                (held_lines if held else lines).append(ln)
                (held_y if held else y).append(code)
                if held:
                    held_text.append(k)
                if not held and r["code"] in ("vi", "fr", "de"):
                    lines.append(_plain(ln))
                    y.append(code)
    if not lines:
        return model
    labels_y = np.array(y)
    fit_ftrl(model, lines, labels_y, s.clean_alpha, 1)
    for last in (False, True):
        p = model.probabilities(*model.scores(lines)[:2])
        sure = p.argmax(1) == labels_y
        fit_ftrl(model, [x for x, ok in zip(lines, sure, strict=True) if ok], labels_y[sure], s.alpha if last else s.clean_alpha, s.epochs if last else 1)
    calibrate(model, held_lines, np.array(held_y, int), np.array(held_text, int))
    return model


def passages(texts: list[str], model: Model) -> list[list[tuple[str, float, int]]]:
    """(language, confidence, lines) of each passage of each text; a text without any letter has none."""
    s = model.settings
    per = [lines_of(t) if isinstance(t, str) else [] for t in texts]
    flat = [ln for p in per for ln in p]
    if not flat:
        return [[] for _ in texts]
    sums, norm, words, own = model.scores(flat)
    says = (words >= s.low_words) | (own >= s.low_own)
    short = np.fromiter(map(len, flat), np.int64, len(flat)) <= 160
    weak = words * 6 + own < s.contact_chars
    for i in np.flatnonzero(says & (short | weak)).tolist():
        if short[i] and _listed(flat[i]) or weak[i] and _CONTACT.search(flat[i]):
            says[i] = False
    prob = model.probabilities(sums, norm)
    best = prob.argmax(1)
    size = np.fromiter(map(len, per), np.int64, len(per))
    ends = np.cumsum(size)
    # a text whose telling lines agree is one passage; the others are smoothed one by one
    text = np.repeat(np.arange(len(per)), size)
    any_says = np.bincount(text, says, minlength=len(per)) > 0
    use = says | (~any_says[text] & (norm > 0))
    at = np.flatnonzero(use)
    first = np.zeros(len(per), np.int64)
    first[text[at][::-1]] = at[::-1]
    told = np.bincount(text, use, minlength=len(per)) > 0
    differ = np.bincount(text[at], best[at] != best[first[text[at]]], minlength=len(per)) > 0
    lang = np.where(told[text], best[first[text]], -1)
    for t in np.flatnonzero(differ).tolist():
        i = np.arange(ends[t] - size[t], ends[t])
        k = i[use[i]]
        loss = -np.log(np.maximum(prob[k], 1e-5))
        cost, back = loss[0], []
        for row in loss[1:]:
            back.append(np.where(cost <= cost.min() + s.switch, np.arange(len(LANGS)), cost.argmin()))
            cost = np.minimum(cost, cost.min() + s.switch) + row
        state = [int(cost.argmin())]
        for b in reversed(back):
            state.append(int(b[state[-1]]))
        state.reverse()
        # lines that say nothing belong to the passage before them, at the start to the one after
        place = np.searchsorted(k, i, "right") - 1
        lang[i] = np.array(state)[np.maximum(place, 0)]
    start = np.flatnonzero(np.concatenate(([True], (lang[1:] != lang[:-1]) | (text[1:] != text[:-1]))))
    own_lines = np.add.reduceat(use, start)
    weight = np.where(np.repeat(own_lines > 0, np.diff(np.append(start, len(flat)))), use, True)
    q = model.probabilities(np.add.reduceat(sums * weight[:, None], start, axis=0), np.add.reduceat(norm * weight, start))
    out: list[list[tuple[str, float, int]]] = [[] for _ in texts]
    for j, (t, code, n) in enumerate(zip(text[start].tolist(), lang[start].tolist(), np.diff(np.append(start, len(flat))).tolist(), strict=True)):
        if code >= 0:
            out[t].append((LANGS[code], float(q[j, code]), n))
    return out


def detect(texts: DataFrame, model: Model) -> DataFrame:
    """(id, passages array<struct<seg_no, lang, confidence, n_lines>>) of each row of `texts` (id, text).

    Null and blank texts, and texts without letters, have no passage. One pass
    without a shuffle; whole texts always.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            texts = list(pdf["text"])
            ends = np.cumsum([len(t) if isinstance(t, str) else 0 for t in texts]) // 120_000
            for _, part in pd.Series(range(len(texts))).groupby(ends):
                i = part.to_numpy()
                found = passages([texts[j] for j in i], model)
                yield pd.DataFrame({"id": pdf["id"].to_numpy()[i], "passages": [[{"seg_no": j + 1, "lang": a, "confidence": b, "n_lines": c} for j, (a, b, c) in enumerate(p)] for p in found]})

    kind = texts.schema["id"].dataType.simpleString()
    return spread(texts.select("id", "text")).mapInPandas(run, f"id {kind}, passages array<struct<seg_no:int,lang:string,confidence:double,n_lines:int>>")
