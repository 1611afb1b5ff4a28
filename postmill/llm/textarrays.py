"""Token arrays of many texts at once.

Inside an Arrow batch the texts are joined into one array of code points and
every step (token bounds, token hashes, shingle hashes, min-hashes) is one
numpy pass over that array, so the cost per character stays at a few
nanoseconds and no Python object is made per token.
"""

from __future__ import annotations

import html
import re
import unicodedata

import numpy as np

_TAG = re.compile(r"</?[a-zA-Z][^<>]*>")
_INVISIBLE = re.compile("[­​-‏⁠﻿]")
#: Characters of scripts written without spaces; each counts as a token.
_UNSPACED = ((0x0E00, 0x0E7F), (0x3040, 0x30FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xAC00, 0xD7AF))
#: Planes 2 and 3 hold ideographs only; no character beyond them is written text.
IDEOGRAPHS, LAST = 0x20000, 0x3FFFF
_R = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """Splitmix finaliser: spreads 64-bit values evenly."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def clean(text: str | None) -> str:
    """Lower-case text without entities, tags and invisible characters, in NFKC."""
    if not text:
        return ""
    if "&" in text:
        text = html.unescape(text)
    if "<" in text:
        text = _TAG.sub(" ", text)
    if not text.isascii():
        text = unicodedata.normalize("NFKC", _INVISIBLE.sub("", text))
    return text.lower()


def _kinds() -> np.ndarray:
    """For each code point of the first four planes: 0 none, 1 part of a word, 2 a token of its own."""
    kind = np.zeros(LAST + 1, np.uint8)
    kind[IDEOGRAPHS:LAST] = 2
    for c in range(IDEOGRAPHS):
        if chr(c).isalnum() or unicodedata.category(chr(c)).startswith("M"):
            kind[c] = 1
    for a, b in _UNSPACED:
        kind[a : b + 1] = np.where(kind[a : b + 1] > 0, 2, 0)
    return kind


_KIND: np.ndarray | None = None


def tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, document, start, length, own) of every token of `texts`, in order.

    start counts code points from the beginning of the token's document; own
    marks the single characters of unspaced scripts. An empty text has no token.
    """
    global _KIND
    if _KIND is None:
        _KIND = _kinds()
    joined = "\n".join(texts)
    cp = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    if not len(cp):
        e = np.empty(0, np.int64)
        return np.empty(0, np.uint64), e, e, e, np.empty(0, bool)
    kind = _KIND[np.minimum(cp, LAST)]
    before = np.empty_like(kind)
    before[0], before[1:] = 0, kind[:-1]
    starts = np.flatnonzero((kind == 2) | ((kind == 1) & (before != 1)))
    lens = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    offsets = np.concatenate(([0], np.cumsum(lens)[:-1]))
    if not len(starts):
        e = np.empty(0, np.int64)
        return np.empty(0, np.uint64), e, e, e, np.empty(0, bool)
    inside = np.flatnonzero(kind)
    first = kind[inside] == 2
    first |= (kind[inside] == 1) & (before[inside] != 1)
    bounds = np.flatnonzero(first)
    length = np.diff(np.append(bounds, len(inside)))
    place = np.arange(len(inside)) - np.repeat(bounds, length)
    power = np.cumprod(np.full(int(length.max()) + 1, _R | np.uint64(1)))
    value = mix(cp[inside].astype(np.uint64) + np.uint64(0x1234567)) * power[place]
    h = mix(np.add.reduceat(value, bounds))
    doc = np.searchsorted(offsets, starts, "right") - 1
    return h, doc, starts - offsets[doc], length, kind[starts] == 2


def shingles(h: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document) of each run of n tokens; a document with fewer tokens gives one shingle."""
    if not len(h):
        return h, doc
    out = h.copy()
    m = len(h)
    for k in range(1, n):
        nxt = np.zeros(m, np.uint64)
        nxt[: m - k] = h[k:]
        out = out * _R + nxt
    last = np.zeros(m, bool)
    last[: m - n + 1] = doc[: m - n + 1] == doc[n - 1 :] if m >= n else False
    # short documents: their whole text, taken at the first token
    counts = np.bincount(doc)
    short = counts[doc] < n
    if short.any():
        starts = np.flatnonzero(short & np.concatenate(([True], doc[1:] != doc[:-1])))
        for s in starts:
            v = np.uint64(0)
            with np.errstate(over="ignore"):
                for x in h[s : s + counts[doc[s]]]:
                    v = v * _R + x
            out[s] = v
            last[s] = True
    return mix(out[last]), doc[last]
