"""Pages of repeated keywords, links and product tags.

Every text is cut into units (lines, and sentences inside lines). A unit is
judged by how its terms recur: the gap to the nearest equal term, and the
autocorrelation of the term sequence over windows of lags. Prose uses a word
of content once in a while; stuffed text comes back to the same few at short
and even lags. Lists of distinct nouns don't recur, but have no function words;
links and tags are told by their form. The page's score is the share of its
text in such units.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.llm.textarrays import _INVISIBLE, _R, tokens
from postmill.sources.tables import spread

# Function words of the languages written with spaces.
FUNCTION_WORDS = """
the of to and a in you we our is for with be are that this on at by it as your from or not will who they an if then than so what
yang dan di ke dari untuk dengan pada ini itu akan anda kami tidak atau oleh para ada adalah saat juga bisa dapat seberapa setelah hingga
và của cho là các với bạn được trong có để về khi đến mỗi ở sẽ không từ những một người chúng tôi này tốt hãy
der die das und zu in mit sie wir den für von ist bei auf ein eine nicht im des dem wie wer an sich uns werden als ihr ihre aus
le la les de des et à un une en vous nous pour est que qui dans par du au aux sur avec ce plus ou votre puis chaque sont son ses il
"""


@dataclass(frozen=True)
class Settings:
    """The thresholds lie between the values of prose and of stuffed text in
    units of the given pages; tests hold them on text made otherwise.

    lags, char_lags: longest lag of the autocorrelation, in terms of spaced
    scripts and in characters of unspaced ones. char_echo, char_recur_low: mean
    number of equal runs of characters within the lags from which a unit of an
    unspaced script is stuffed, if at least that share recurs closely. word_gap, char_gap:
    gaps (in tokens) that count as a close recurrence, in spaced and unspaced
    scripts. recur, char_recur, char_recur_long: share of content terms in close
    recurrence from which a unit is stuffed (spaced; unspaced, under and from
    120 tokens). echo: mean number of equal terms within the lags, the
    same. prose_function, short_lags, short_echo: a unit with at least that
    share of function words is stuffed only if its terms come back inside the
    short lags, as in sentences about nothing but a keyword. mark_chars,
    marked_recur: a long unit in an unspaced script with a separator to so many
    characters is a list already at this recurrence. list_function: share of function words under which a long unit of
    spaced words is a list. list_least: tokens of such a unit. flag: share of
    the page that makes it spam.
    """

    lags: int = 24
    char_lags: int = 48
    char_echo: float = 1.2
    char_recur_low: float = 0.3
    word_gap: int = 40
    char_gap: int = 150
    recur: float = 0.55
    char_recur: float = 0.6
    char_recur_long: float = 0.45
    echo: float = 0.9
    prose_function: float = 0.15
    short_lags: int = 8
    short_echo: float = 0.8
    mark_chars: int = 40
    marked_recur: float = 0.15
    list_function: float = 0.06
    list_least: int = 6
    flag: float = 0.5


_LINK = re.compile(r"<a\s[^<>]*>[^<]*</a>|\[[^\[\]\n]*\]\([^)\s]*\)|https?://\S+|(?:[\w-]+\.)+(?:example|test|invalid|com|net|org|io|co)\b/\S*|#[^\s#]{2,}")
_CUT = re.compile(r"\n|[.!?](?=\s)|[。！？]")
_MARK = np.zeros(0x3000, bool)
_MARK[[ord(c) for c in "•|/;,()-–!"]] = True
_FUNCTION: np.ndarray | None = None


def _function_hashes() -> np.ndarray:
    global _FUNCTION
    if _FUNCTION is None:
        _FUNCTION = np.unique(tokens(sorted(set(FUNCTION_WORDS.split())))[0])
    return _FUNCTION


def readable(text: str) -> str:
    t = html.unescape(text) if "&" in text else text
    if not t.isascii():
        t = unicodedata.normalize("NFKC", _INVISIBLE.sub("", t))
    return t.lower().replace("\r", "\n")


def unit_table(texts: list[str], s: Settings) -> pd.DataFrame:
    """One row per unit of the (readable) texts: doc, start, chars, tokens, own, fw, recur, echo, link."""
    starts, docs, links = [], [], []
    for d, t in enumerate(texts):
        cuts = [0] + [m.end() for m in _CUT.finditer(t)]
        starts.append(np.array(cuts, np.int64))
        docs.append(np.full(len(cuts), d, np.int64))
        if "#" in t or "/" in t or "[" in t:
            links.extend((d, m.start(), m.end()) for m in _LINK.finditer(t))
    n = len(texts)
    ust, udoc = np.concatenate(starts), np.concatenate(docs)
    size = np.array([len(t) for t in texts], np.int64)
    base = np.concatenate(([0], np.cumsum(size + 1)))
    edge = base[udoc] + ust
    h, doc, st, ln, own = tokens(texts)
    m, u = len(h), len(edge)
    if not m:
        return pd.DataFrame({k: np.zeros(0) for k in ("doc", "start", "chars", "tokens", "own", "fw", "content", "close", "echo", "short", "link", "marks", "word", "own_echo")})
    at = base[doc] + st
    unit = np.searchsorted(edge, at, "right") - 1
    fw = np.isin(h, _function_hashes()) & ~own
    term = h
    inside = np.zeros(m, bool)
    if own.any():
        y = h.copy()
        for k in (1, 2, 3):
            nxt = np.zeros(m, np.uint64)
            nxt[: m - k] = h[k:]
            y = y * _R + nxt
        inside[: max(m - 3, 0)] = own[: max(m - 3, 0)] & own[3:] & (doc[: max(m - 3, 0)] == doc[3:])
        term = np.where(inside, y, h)
    # gaps: distance to the nearest equal term of the page
    key = (term >> np.uint64(1)) ^ (doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    dist = np.where(same, order[1:] - order[:-1], 1 << 40)
    gap = np.full(m, 1 << 40, np.int64)
    gap[order[1:]] = dist
    gap[order[:-1]] = np.minimum(gap[order[:-1]], dist)
    content = ~fw
    # in unspaced scripts a term is four characters: three of it must be near, as a sentence may well be said twice
    third = np.where(same[1:] & same[:-1], order[2:] - order[:-2], 1 << 40) <= 2 * s.char_gap
    dense = np.zeros(m, bool)
    for k in range(3):
        dense[order[k : m - 2 + k][third]] = True
    close = np.where(own, dense, content & (gap <= s.word_gap))
    # autocorrelation over two lag windows; other documents never match
    echo, short = np.zeros(m, np.float32), np.zeros(m, np.float32)
    for lag in range(1, min(s.lags, m - 1) + 1):
        e = key[lag:] == key[:-lag]
        echo[lag:] += e
        echo[:-lag] += e
        if lag == s.short_lags:
            short = echo * (content & ~own)
    echo *= content & ~own
    # the same for the runs of characters of unspaced scripts, over lags of as many characters as a phrase has
    own_echo = np.zeros(m, np.float32)
    at_own = np.flatnonzero(inside) if own.any() else np.zeros(0, np.int64)
    if len(at_own):
        k_own = key[at_own]
        for lag in range(1, min(s.char_lags, len(at_own) - 1) + 1):
            e = (k_own[lag:] == k_own[:-lag]) & (at_own[lag:] - at_own[:-lag] <= 2 * s.char_lags)
            own_echo[at_own[lag:]] += e
            own_echo[at_own[:-lag]] += e
    count = lambda x: np.bincount(unit, x, minlength=u)
    tok, con = np.bincount(unit, minlength=u), count(content)
    chars = count(ln)
    cp = np.frombuffer("\n".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    marks = np.bincount(np.searchsorted(edge, np.flatnonzero(_MARK[np.minimum(cp, 0x2FFF)]), "right") - 1, minlength=u)
    link = np.zeros(u)
    if links:
        L = np.array(links, np.int64)
        a, b = base[L[:, 0]] + L[:, 1], base[L[:, 0]] + L[:, 2]
        # characters of tokens inside links
        linked = np.zeros(m + 1, np.int64)
        np.add.at(linked, np.searchsorted(at, a), 1)
        np.add.at(linked, np.searchsorted(at, b), -1)
        link = count(ln * (np.cumsum(linked[:m]) > 0))
    return pd.DataFrame({
        "doc": udoc, "start": ust, "chars": chars, "tokens": tok, "own": count(own) / np.maximum(tok, 1), "fw": count(fw), "content": con,
        "close": count(close), "echo": count(echo), "short": count(short), "link": link, "marks": marks, "word": con - count(own), "own_echo": count(own_echo),
    })[tok > 0]


def judged(units: pd.DataFrame, s: Settings) -> pd.DataFrame:
    """`units` with spam (bool). Short units are judged with their neighbours of the same page."""
    d, k = units["doc"].to_numpy(), len(units)
    cols = {c: units[c].to_numpy().astype(float) for c in ("tokens", "fw", "content", "close", "echo", "short", "word", "own", "marks", "chars", "own_echo")}
    cols["own"] = cols["own"] * cols["tokens"]
    small = cols["tokens"] < 8
    wide = {c: v.copy() for c, v in cols.items()}
    for step in (1, -1, 2, -2):
        if k > abs(step):
            j = np.arange(k) + step
            ok = (j >= 0) & (j < k)
            j = np.clip(j, 0, k - 1)
            # only other small units of the same page lend their evidence
            ok &= (d[j] == d) & small & small[j]
            for c in wide:
                wide[c] += np.where(ok, cols[c][j], 0)
    own = wide["own"] / np.maximum(wide["tokens"], 1)
    recur = wide["close"] / np.maximum(wide["content"], 1)
    echo = wide["echo"] / np.maximum(wide["word"], 1)
    short = wide["short"] / np.maximum(wide["word"], 1)
    own_echo = wide["own_echo"] / np.maximum(wide["own"], 1)
    fw = wide["fw"] / np.maximum(wide["tokens"], 1)
    link = units["link"].to_numpy() / np.maximum(units["chars"].to_numpy(), 1)
    spaced = own < 0.5
    marked = (wide["marks"] * s.mark_chars >= wide["chars"]) & (recur >= s.marked_recur) & (wide["tokens"] >= 40)
    stuffed = np.where(spaced, ((recur >= s.recur) & (echo >= s.echo * 0.6) | (echo >= s.echo) & (recur >= 0.4)) & ((fw < s.prose_function) | (short >= s.short_echo)), (recur >= np.where(wide["tokens"] < 120, s.char_recur, s.char_recur_long)) | (own_echo >= s.char_echo) & (recur >= s.char_recur_low) | marked)
    listed = spaced & (fw < s.list_function) & (wide["tokens"] >= s.list_least)
    return units.assign(spam=(link >= 0.5) | stuffed | listed, recur=recur, echo_mean=echo, fw_share=fw, own_echo_mean=own_echo, spaced=spaced, marked=marked)


def spam_scores(pages: DataFrame, id_column: str = "doc_id", text_column: str = "text", settings: Settings = Settings()) -> DataFrame:
    """(id, spam_share, n_units, is_spam) for each page; null, blank and wordless texts have share 0.

    One pass over the texts without any shuffle; whole texts always. Repeated
    ids and extra columns don't matter: each row is judged by itself.
    """
    s = settings

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            texts = [readable(t) if isinstance(t, str) else "" for t in pdf["text"]]
            ends = np.cumsum([len(t) for t in texts]) // 600_000
            for _, part in pd.Series(range(len(texts))).groupby(ends):
                i = part.to_numpy()
                u = judged(unit_table([texts[j] for j in i], s), s) if len(i) else None
                n = len(i)
                spam, total, count = np.zeros(n), np.zeros(n), np.zeros(n, np.int64)
                if u is not None and len(u):
                    doc, chars = u["doc"].to_numpy(np.int64), u["chars"].to_numpy()
                    total = np.bincount(doc, chars, minlength=n)
                    spam = np.bincount(doc, chars * u["spam"].to_numpy(), minlength=n)
                    count = np.bincount(doc, minlength=n)
                share = spam / np.maximum(total, 1)
                yield pd.DataFrame({"id": pdf["id"].to_numpy()[i], "spam_share": share, "n_units": count, "is_spam": share > s.flag})

    kind = pages.schema[id_column].dataType.simpleString()
    src = pages.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return spread(src).mapInPandas(run, f"id {kind}, spam_share double, n_units long, is_spam boolean").withColumnRenamed("id", id_column)
