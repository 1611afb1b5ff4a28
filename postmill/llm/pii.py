"""Personal information inside free text.

Candidate spans are found once per text; labelers of three sorts (form of the
span, name lists, words around it) vote on each. Besides a short public list
of given names, the list labelers use a lexicon that the corpus itself yields:
how often a word stands in a name right after a plain cue ("Mr", "contact:")
against all its places in capitalised runs. The votes are aggregated by
expectation-maximisation (one reliability table per labeler and kind, no
labelled rows), and a span classifier is trained on the resulting posteriors
with the words around the span as further features. Its decision is the result.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.sources.tables import shared_dir, spread, stored

KINDS = ("email", "phone", "id_number", "address", "name")

# Frequent given names of several countries, as their offices of statistics publish them every year
# (United States, Germany, France, Indonesia, Vietnam, Japan, Thailand), written down from general knowledge.
GIVEN = """James Mary John Patricia Robert Jennifer Michael Linda David Elizabeth William Barbara Richard Susan Joseph Jessica Thomas Sarah Charles
Karen Christopher Lisa Daniel Nancy Matthew Betty Anthony Margaret Mark Sandra Donald Ashley Steven Kimberly Paul Emily Andrew Donna Joshua Michelle
Hans Wolfgang Klaus Jürgen Andreas Stefan Sabine Petra Monika Ursula Claudia Heike Uwe Birgit
Jean Pierre Philippe Nathalie Isabelle Sylvie Laurent Nicolas Céline Camille Julien Aurélie
Budi Siti Agus Dewi Andi Rina Eko Wati Putri Rizky Minh Hùng Linh Thảo Tuấn Hương Dũng Ngọc
Hiroshi Takashi Kenji Akira Yuko Naoko Haruto Sakura Somchai Somsak Malee Prasert Wichai Somying
สมชาย สมหญิง ประเสริฐ วิชัย สมศักดิ์ มาลี สุดา ประยูร"""


@dataclass(frozen=True)
class Settings:
    """train_spans: candidates the span classifier is fitted on at most (a
    bounded fit; the vote counts and the lexicon cover all candidates).
    lexicon_bits: size of the hashed space of the corpus lexicon. buckets:
    hashed context features. left, right: characters of context. accept:
    probability from which a span is reported. named, seen: share and number
    of a word's places after a cue that make it part of a name; plain, often:
    the same for a word that isn't.
    """

    train_spans: int = 20_000
    lexicon_bits: int = 18
    buckets: int = 4096
    left: int = 40
    right: int = 26
    accept: float = 0.5
    named: float = 0.1
    seen: int = 2
    plain: float = 0.02
    often: int = 4


# -- texts in which a character keeps its place ---------------------------
_PLACE: dict[int, str] = {}
_ENTITY = re.compile(r"&(?:nbsp|amp|quot|lt|gt|#\d{1,6}|#x[0-9a-fA-F]{1,5}|[a-zA-Z]{2,8});")
_MARKUP = re.compile(r"</?[a-zA-Z][^<>]*>")
_FIXED_ENTITY = {"&nbsp;": " ", "&amp;": "&", "&quot;": '"', "&lt;": "<", "&gt;": ">"}


def flat(text: str) -> str:
    """The text with digits and forms of all scripts as ASCII, without entities and tags, each character in its old place."""
    if not _PLACE:
        for c in range(0x80, 0x10000):
            ch = chr(c)
            if unicodedata.category(ch) in ("Cf", "Zs"):
                _PLACE[c] = " "
            elif unicodedata.category(ch) == "Nd":
                _PLACE[c] = str(unicodedata.digit(ch))
            elif 0xFF01 <= c <= 0xFF5E:
                _PLACE[c] = chr(c - 0xFEE0)
            elif c in (0x2010, 0x2011, 0x2012, 0x2013):
                _PLACE[c] = "-"
    t = text if text.isascii() else text.translate(_PLACE)
    if "&" in t:
        t = _ENTITY.sub(lambda m: _FIXED_ENTITY.get(m.group(), " ").ljust(len(m.group())), t)
    if "<" in t:
        t = _MARKUP.sub(lambda m: " " * len(m.group()), t)
    return t


# -- forms ----------------------------------------------------------------
_S = r"[ \t]+"
_UP = "A-ZÀ-ÖØ-ÞĂĐĨŨƠƯŁŚŠŽ"
_LOW = "a-zA-ZÀ-ÖØ-öø-ÿĀ-žƠơƯưẠ-ỹ'’"
_WORD_FORM = rf"[{_UP}][{_LOW}]+(?:-[{_UP}][{_LOW}]+)*"
_STREET = r"(?:St|Street|Road|Rd|Lane|Ln|Avenue|Ave|Close|Boulevard|Blvd|Drive|Way|Square)"
_PLACE_NAME = r"[A-Z][a-zA-Z'’-]{2,}"
_DIGITS = re.compile(r"\d(?:\d|[ .()-]{1,2}(?=[\d(])){7,22}\d")
_PASSPORT = re.compile(r"(?<!\d)\d{7}(?!\d)")


def _address(flags: int) -> tuple[re.Pattern, re.Pattern]:
    lane = rf"(?:Soi|Moo)\b(?:{_S}{_PLACE_NAME}){{0,2}}(?:{_S}\d{{1,3}}\b)?(?:,?(?:{_S}{_PLACE_NAME}){{1,2}}{_S}{_STREET}\b)?"
    number_first = rf"\d{{1,4}}(?:[ \t]?[-/][ \t]?\d{{1,4}})?[ \t]+(?:{lane}|(?:{_PLACE_NAME}{_S}){{1,2}}{_STREET}\b)"
    thai = r"\d{1,4}(?:/\d{1,4})?[ \t]*(?:(?:ซอย|หมู่|ตรอก)[ก-๙]*(?:[ \t]*\d{1,3})?(?:[ \t]*ถนน)?|ถนน)"
    street_first = rf"{_PLACE_NAME}{_S}(?:Street|Road|Lane|Avenue|Boulevard|Close){_S}\d{{1,4}}\b(?![-/.\d])"
    return re.compile(rf"{number_first}|{thai}", flags), re.compile(street_first, flags)


_ADDRESS = {False: _address(0), True: _address(re.I)}
#: A text with capitals and none of these has no address, one with none of the second list no e-mail address: cheap looks before the patterns.
_ADDRESS_HINTS = ("Street", "Road", "Rd", "Lane", "Ln", "Ave", "Close", "Boulevard", "Blvd", "Drive", "Way", "Square", "Soi", "Moo", "ซอย", "หมู่", "ตรอก", "ถนน")
_SHORT_STREET = re.compile(r"\bSt\b")
_EMAIL_HINTS = ("@", "[at]", "(at)", "[AT]", "(AT)", "[At]", "(At)", " dot ", " DOT ", " Dot ", "\tdot", "\tDOT")
#: The sign of an address; the local part is read to its left, the domain to its right.
_AT = re.compile(r"[ \t]*(?:@|\[at\]|\(at\))[ \t]*|[ \t]+at[ \t]+(?=[a-z0-9-]+[ \t]+dot[ \t])", re.I)
_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:(?:\.|[ \t]*(?:\[dot\]|\(dot\))[ \t]*|[ \t]+dot[ \t]+)[A-Za-z0-9-]+)+", re.I)
_LAST_LABEL = re.compile(r"(?:\.|dot\)?\]?\s*)[a-z]{2,12}$", re.I)
_COUNT = re.compile(r"\d")
_PHONE_FORM = re.compile(
    r"(?:\+66|0066)[ .-]?\(?0?\d{1,2}\)?[ .-]?\d{3}[ .-]?\d{4}$|\+\d{1,3}[ .-]?\(?\d{2,4}\)?[ .-]?\d{3,4}[ .-]?\d{3,6}$|0\d{9}$|0[2-9]\d[ .-]\d{3}[ .-]\d{4}$"
    r"|\(0\d{1,2}\)[ .-]?\d{3}[ .-]?\d{4}$|0\d[ .-]\d{3}[ .-]\d{4}$|\(\d{3}\)[ .-]?\d{3}[ .-]?\d{4}$"
)
_ID_FORM = re.compile(r"\d[ -]\d{4}[ -]\d{5}[ -]\d{2}[ -]\d$|\d{3}-\d{2}-\d{4}$|[A-Za-z]{2}\d{7}$")

# Words that announce a kind of data, in the eight languages.
_PHONE_CUE = re.compile(r"(?:tel|phone|call|ring|mobile|cell|fax|text|line|or|and|\(|nomor|telepon|menelepon|telefon|unter|nummer|โทร|โทรศัพท์|เบอร์มือถือ|เบอร์|电话|手机|拨打|電話|（|gọi|thoại|số|composez(?: le)?|appelez(?: le)?|téléphone|au|numéro)[.:、, ]*$", re.I)
_ID_CUE = re.compile(r"(?:passport|card(?: no\.?)?|\bid|kartu|hộ chiếu|ประชาชน|หนังสือเดินทาง|บัตรเลขที่|身分証(?:番号)?|旅券|证件|护照|身份证|passeport|ausweis|reisepass|pass|carte|identity|paspor|ktp|social security|ssn|căn cước)[.:# ]*(?:no\.?|nr\.?|number)?[.:# ]*$", re.I)
_OF_SOMEONE = re.compile(r"^[)\]]?[ ,]*(?:milik|của|ของ|von|de |d['’]|の|的|of|belong)", re.I)
_NOT_PERSONAL = re.compile(r"(?:shipment|parcel|tracking|barcode|tender|requisition|order|invoice|file|rows?|record|version|release|build|ticket|case|product|item|article|sku|serial|table|account|box|budget|อ้างอิง|รหัสสินค้า|รหัสงาน|เอกสาร|รายการ|รุ่น|เซิร์ฟเวอร์\S*|งบประมาณ|订单|注文|型号)[.:# ]*(?:no\.?|nr\.?|id|number)?[.:# ]*$", re.I)
_UNIT_AFTER = re.compile(r"^[ ,]*(?:rows?|records?|files?|items?|units?|pieces?|users?|test|แถว|รายการ|บาท|baht|THB|USD|件|行|条)", re.I)
_PLACE_CUE = re.compile(r"(?:\bat|address:?|office|living|located|,|di|alamat|ที่|เลขที่|地点[:：]?|地址[:：]?|場所は|住所[:：]?|tại|địa chỉ|à|adresse:?|寄到|in|no\.|nr\.)[ :：]*$", re.I)
_PLACE_AFTER = re.compile(r"(?:, ?(?:Floor|[A-Z][a-z]+(?: [A-Z][a-z]+)?(?: \d{5})?| *\d{5})|Tower|District|\d{5}|ถนน|แขวง|ตำบล|เขต|อำเภอ|Road|Rd)", re.I)

# Words right before a person's name: forms of address and the usual ways to name a contact.
HONORIFIC = "Mr Mrs Ms Miss Dr Prof Khun Herr Frau Monsieur Madame Mme Bapak Ibu Pak Ông Bà Anh Chị"
_CUE = re.compile(
    rf"(?:(?<![A-Za-z])(?:{'|'.join(HONORIFIC.split())})\.?[ \t]+"
    r"|(?<![A-Za-z])(?:contact(?: person)?|attention|attn\.?|ask for|speak to|talk to|write to|report to|reports to|recruiter(?: is)?|manager(?: is)?|supervisor|lead|applicant|candidate|holder|employee|signed|regards|sincerely"
    r"|kontakt|ansprechpartner(?:in)?|hubungi|narahubung|milik|atas nama|responsable|contacte[rz]|appartient à|liên hệ|phụ trách(?: là)?|của)[ \t]*[:,]?[ \t]+"
    r"|(?:担当者?|連絡先|氏名|責任者)(?:は|の)?[:：]?[ \t]*|(?:联系人|联系|负责人|姓名|经办人)[:：]?[ \t]*|(?:(?<![ก-๙])(?:ผู้ติดต่อ|ติดต่อ|คุณ)|ถึงคุณ|ติดต่อคุณ)[ \t]*)$",
    re.I,
)
_AFTER = re.compile(r"^[ \t]*(?:さん|様|氏|先生|女士|[,(:：，、（]?[ \t]*(?:tel|phone|mobile|call|e-?mail|mail|id\b|passport|โทร|เบอร์|อีเมล|メール|電話|邮箱|电话|thư|điện thoại|courriel|surel|nomor|unter der))", re.I)
_START = re.compile(r"(?:^|[.:!?。！？•*>;-])[ \t]*$")
# Words that begin sentences with a capital and never a name.
FUNCTION_WORDS = "The Our Your We You This That These It He She They And Or For From With At In On As By To Of If Not No All Please"
# Words of organisations, places, streets, days and titles; hardly ever part of a person's name.
NOT_NAME = """Group Labs Lab Systems Works Partners Digital Asia Studio Cloud Tower District Street Road Lane Avenue Square Floor Company Limited Inc Ltd Corp
University Department Team Office Bank Hotel Send Mail Email Phone Call Contact Mr Mrs Ms Miss Dr Khun Monday Tuesday Wednesday Thursday Friday Saturday Sunday January February March April May June July August September October November December
Senior Junior Lead Manager Engineer Analyst Developer"""
_NOT_FIRST = {w.lower() for w in FUNCTION_WORDS.split()}
_NOT_NAME = {w.lower() for w in NOT_NAME.split()} | _NOT_FIRST
_HONORIFIC = {w.lower() for w in HONORIFIC.split()}
_GIVEN = {w.lower() for w in GIVEN.split()}
_RUN = re.compile(rf"(?<![{_LOW}\d_@./-])(?:{_WORD_FORM}|[A-Z](?:\.|(?=[ \t])))(?:,?[ \t]+(?:{_WORD_FORM}|[A-Z](?:\.|(?=[ \t]))))+(?![@_\d])")
_PART = re.compile(rf"({_WORD_FORM}|[A-Z]\.?)(,?)")
_LOOSE = re.compile(rf"(?<![{_LOW}\d_@./-])[{_LOW}][{_LOW}.-]*(?:,?[ \t]+[{_LOW}][{_LOW}.-]*)+")
_LOOSE_PART = re.compile(rf"([{_LOW}]+(?:-[{_LOW}]+)*\.?)(,?)")
_THAI = re.compile(r"[ก-๙]{2,}")
# Thai words that stand before a name without a space.
_THAI_BEFORE = re.compile(r"^(?:.*(?:นางสาว|คุณ|นาย|นาง|ชื่อ|ของ|และ|ถึง|ติดต่อ))?")
#: The same as a form of address: the word for "you" only at the start or after words that lead to a person.
_THAI_TITLE = re.compile(r"(?:นางสาว|(?:^|[^ก-๙])(?:กรุณา|โปรด|หรือ|และ|ติดต่อ|ถึง|โทรหา|ฝ่ายบุคคล|กับ)*(?:คุณ|นาย|นาง|ชื่อ|ของ)[ \t]*)$")
_THAI_AFTER = re.compile(r"^[ \t]*(?:หัวหน้า|ผู้จัดการ|เบอร์|อีเมล|เลข|โทร|ตำแหน่ง|\()")
_TOKEN = re.compile(r"[a-zà-ỹ]+|[ก-๙]+|[぀-ヿ一-鿿]+|[(:+@]")
_FORM = str.maketrans(dict.fromkeys("0123456789", "9") | dict.fromkeys("abcdefghijklmnopqrstuvwxyz", "a") | dict.fromkeys("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "A"))
_REPEATED = re.compile(r"([aA])\1+")
N_VOTES = 7
#: Places of the lexicon's two votes among those on a name; they are filled once the lexicon is known.
_LEX = (1, 2)


def _hashed(word: str, side: str, kind: str, size: int) -> int:
    return zlib.crc32(f"{kind}|{side}|{word}".encode()) % size


def _slot(word: str, s: Settings) -> int:
    return zlib.crc32(word.lower().encode()) & ((1 << s.lexicon_bits) - 1)


def _lexicon_votes(lexicon: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """Two votes on names of two words each: -1 if one is no part of names, 1 if one is and the other may be; 1 if both are."""
    v = np.where(slots >= 0, lexicon[np.maximum(slots, 0)], 0)
    return np.stack([np.where(v.min(1) < 0, -1, v.max(1)), v.min(1) > 0], 1).astype(int)


@dataclass
class Span:
    """A candidate: places from 0, votes, context features, lexicon slots of the two words of a name (-1: none)."""

    kind: str
    start: int
    end: int
    votes: list[int]
    feats: list[int]
    words: tuple[int, ...] = (-1, -1)
    strong: bool = False


class _Text:
    """Candidates of one text. Those of other kinds than names don't overlap; names may, and the best ones are chosen later."""

    def __init__(self, text: str, s: Settings, lexicon: np.ndarray | None) -> None:
        self.s, self.lexicon = s, lexicon
        self.body = flat(text)
        self.plain = self.body.islower() or self.body.isupper()
        self.spans: list[Span] = []
        self.taken: list[tuple[int, int]] = []

    def free(self, a: int, b: int) -> bool:
        return all(b <= x or a >= y for x, y in self.taken)

    def around(self, a: int, b: int) -> tuple[str, str]:
        left = self.body[max(0, a - self.s.left) : a]
        left = re.sub(r"[ \t]+", " ", left[left.rfind("\n") + 1 :])
        return left, re.sub(r"[ \t]+", " ", self.body[b : b + self.s.right].split("\n", 1)[0])

    def features(self, kind: str, a: int, b: int, left: str, right: str) -> list[int]:
        n = self.s.buckets
        out = [_hashed(w, f"l{i}", kind, n) for i, w in enumerate(reversed(_TOKEN.findall(left.lower())[-3:]))]
        out += [_hashed(w, f"r{i}", kind, n) for i, w in enumerate(_TOKEN.findall(right.lower())[:2])]
        form = _REPEATED.sub(r"\1", self.body[a:b].translate(_FORM))
        return [*out, _hashed(left[-5:].lower(), "tail", kind, n), _hashed(form[:24], "form", kind, n)]

    def add(self, kind: str, a: int, b: int, left: str, right: str, *votes: int, words: tuple[int, ...] = (-1, -1), strong: bool = False) -> None:
        self.spans.append(Span(kind, a, b, [*votes, *[0] * (N_VOTES - len(votes))], self.features(kind, a, b, left, right), words, strong))
        if kind != "name":
            self.taken.append((a, b))

    # -- e-mail, address, numbers -----------------------------------------
    def emails(self) -> None:
        body = self.body
        if not any(k in body for k in _EMAIL_HINTS):
            return
        for at in _AT.finditer(body):
            a = at.start()
            while a and _LOCAL_END.match(body[a - 1]):
                a -= 1
            while a < at.start() and body[a] in ".-+%":
                a += 1
            m = _DOMAIN.match(body, at.end())
            if a == at.start() or not m or not self.free(a, m.end()):
                continue
            b = m.end()
            v = body[a:b]
            left, right = self.around(a, b)
            announced = re.search(r"(?:to|mail|at|by|an|ke|à|ที่|อีเมล|[:：]|use|or|,|は|至)\s*$", left, re.I)
            self.add("email", a, b, left, right, 1 if _LAST_LABEL.search(v) else -1, 1 if "@" in v else 0, -1 if _NOT_PERSONAL.search(left) else 0, 1 if announced else 0)

    def addresses(self) -> None:
        body = self.body
        if not self.plain and not any(k in body for k in _ADDRESS_HINTS) and not (" St" in body and _SHORT_STREET.search(body)):
            return
        first, second = _ADDRESS[self.plain]
        for m in (*first.finditer(body), *second.finditer(body)):
            a, b = m.span()
            before = body[a - 1] if a else " "
            if (before.isalnum() and before < "฀" or before in "+/-.(" and body[a].isdigit()) or not self.free(a, b):
                continue
            left, right = self.around(a, b)
            thai = any("ก" <= c <= "๙" for c in m.group())
            self.add("address", a, b, left, right, 1 if m.group()[0].isdigit() else 0, 1 if _PLACE_AFTER.search(right) else (0 if thai else -1), 1 if _PLACE_CUE.search(left) else 0, -1 if _NOT_PERSONAL.search(left) else 0)

    def numbers(self) -> None:
        body = self.body
        found = [m.span() for m in _DIGITS.finditer(body)]
        found += [(m.start() - 2, m.end()) for m in _PASSPORT.finditer(body) if m.start() > 1 and body[m.start() - 2 : m.start()].isascii() and body[m.start() - 2 : m.start()].isalpha()]
        for a, b in found:
            if a and body[a - 1] == "+" or a and body[a - 1] == "(" and body[a:b].find(")") in (2, 3, 4):
                a -= 1
            if a and (body[a - 1].isascii() and body[a - 1].isalnum() or body[a - 1] in "_@#"):
                continue
            if b < len(body) and (body[b].isascii() and body[b].isalnum() or body[b] == "_"):
                continue
            v = body[a:b]
            n = len(_COUNT.findall(v))
            left, right = self.around(a, b)
            if left[-1:] in "-/." and left[-2:-1].isalnum() or not self.free(a, b):
                continue
            other = -1 if _NOT_PERSONAL.search(left) or _UNIT_AFTER.search(right) else 0
            if _ID_FORM.match(v) or (n == 13 and not v.startswith(("+", "00"))):
                self.add("id_number", a, b, left, right, 1 if _ID_FORM.match(v) else 0, 1 if _ID_CUE.search(left) else 0, other, 1 if _OF_SOMEONE.search(right) else 0)
            elif 9 <= n <= 13:
                self.add("phone", a, b, left, right, 1 if _PHONE_FORM.match(v) else -1, 1 if v[0] in "+(" else 0, 1 if _PHONE_CUE.search(left) else 0, -1 if _ID_CUE.search(left) else other)

    # -- names ------------------------------------------------------------
    def name(self, a: int, b: int, given: str, family: str, cued: bool, initial: int = 0) -> None:
        """A candidate with its two telling words. cued: a form of address stands before it; initial: 1 for one in place of a given name, -1 for one that may be in the middle of a longer name."""
        body, s = self.body, self.s
        if not self.free(a, b) or b < len(body) and body[b] in "@_":
            return
        slots = tuple(_slot(w, s) if len(w.rstrip(".")) > 1 else -1 for w in (given, family))
        lex = self.told(slots)
        # without capitals a cue must be a clear one: a form of address, or with a colon or comma
        if self.plain and not cued and lex[0] < 1 and not (body[max(0, a - 3) : a].rstrip(" \t")[-1:] in (":", ",", "：") and _CUE.search(body, max(0, a - s.left), a)):
            return
        left, right = self.around(a, b)
        strong = cued or bool(_CUE.search(left))
        words = f"{given}-{family}".lower().replace(".", "").split("-")
        bad = not _NOT_NAME.isdisjoint(words)
        self.add(
            "name", a, b, left, right, initial or (0 if _GIVEN.isdisjoint(words) else 1), *lex, 1 if strong else 0, 1 if _START.search(left) else 0,
            1 if _AFTER.search(right) or _THAI_AFTER.search(right) else 0, -1 if bad else 0, words=slots, strong=strong,
        )

    def told(self, slots: tuple[int, ...]) -> list[int]:
        """_lexicon_votes of one pair of slots."""
        if self.lexicon is None:
            return [0, 0]
        v = [int(self.lexicon[k]) if k >= 0 else 0 for k in slots]
        return [-1 if min(v) < 0 else max(v), int(min(v) > 0)]

    def latin_names(self) -> None:
        runs, part = (_LOOSE, _LOOSE_PART) if self.plain else (_RUN, _PART)
        for m in runs.finditer(self.body):
            toks = [(t.start(1), t.end(1), t[1], t[2] == ",") for t in part.finditer(self.body, m.start(), m.end())]
            for i, (a, e, w, comma) in enumerate(toks[:-1]):
                bare = w.rstrip(".").lower()
                if bare in _HONORIFIC or bare in _NOT_FIRST or self.plain and (len(bare) < 2 or bare in _NOT_NAME):
                    continue
                cued = i > 0 and toks[i - 1][2].rstrip(".").lower() in _HONORIFIC
                j = i + 1
                if comma:
                    # family name, given name and initials
                    if len(bare) > 1 and len(toks[j][2].rstrip(".")) > 1:
                        self.name(a, toks[j][1], toks[j][2], w, cued)
                    continue
                while j < len(toks) and len(toks[j][2].rstrip(".")) == 1 and not toks[j][3]:
                    j += 1
                if j < len(toks) and len(toks[j][2].rstrip(".")) > 1:
                    end = toks[j][1]
                    if self.body[end - 1] == ".":
                        end -= 1
                    self.name(a, end, w, toks[j][2].rstrip("."), cued, 0 if len(bare) > 1 else 1 if i == 0 or cued or toks[i - 1][3] else -1)

    def thai_names(self) -> None:
        toks = [(m.start(), m.end()) for m in _THAI.finditer(self.body)]
        for (a, b), (c, d) in zip(toks, toks[1:], strict=False):
            if d - c > 18 or d - c < 3 or self.body[b:c].strip(" \t"):
                continue
            k = _THAI_BEFORE.match(self.body[a:b]).end()
            if 3 <= b - a - k <= 16 and not self.body.startswith(("นางสาว", "คุณ", "นาย"), c):
                self.name(a + k, d, self.body[a + k : b], self.body[c:d], bool(_THAI_TITLE.search(self.body, max(0, a - 12), a + k)))


def spans(text: str, s: Settings, lexicon: np.ndarray | None = None) -> list[Span]:
    """Candidates of a text. Names in a text without capitals are only sought with a lexicon, or after a cue."""
    t = _Text(text, s, lexicon)
    t.emails()
    if _COUNT.search(t.body):
        t.addresses()
        t.numbers()
    t.latin_names()
    if not t.body.isascii():
        t.thai_names()
    return t.spans


# -- candidates as a table ------------------------------------------------
_SPAN = "kind:int,start_pos:int,end_pos:int,pattern:int,w0:int,w1:int,strong:boolean,feats:array<int>"
_POW = 3 ** np.arange(N_VOTES)


def _pattern(votes: list[int]) -> int:
    """The votes of a span as one number, three digits' worth each."""
    return int((np.array(votes) + 1) @ _POW)


def _votes(pattern: np.ndarray) -> np.ndarray:
    return pattern[:, None] // _POW % 3 - 1


def _nested(rows: list[list[Span]]) -> pa.Array:
    """The spans of each text as one list of structs."""
    flat_rows = [x for r in rows for x in r]
    feats = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *(len(x.feats) for x in flat_rows)]), pa.int32()), pa.array([f for x in flat_rows for f in x.feats], pa.int32()))
    ints = lambda values: pa.array(list(values), pa.int32())
    columns = {
        "kind": ints(KINDS.index(x.kind) for x in flat_rows), "start_pos": ints(x.start + 1 for x in flat_rows), "end_pos": ints(x.end for x in flat_rows),
        "pattern": ints(_pattern(x.votes) for x in flat_rows), "w0": ints(x.words[0] for x in flat_rows), "w1": ints(x.words[1] for x in flat_rows),
        "strong": pa.array([x.strong for x in flat_rows], pa.bool_()), "feats": feats,
    }
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, rows)]), pa.int32()), pa.StructArray.from_arrays(list(columns.values()), list(columns)))


def candidates(texts: DataFrame, settings: Settings = Settings(), lexicon: np.ndarray | None = None) -> DataFrame:
    """(id, spans) of each row of `texts` (id, text) that has candidates; positions from 1, the end is the last character."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [spans(t, settings, lexicon) if t is not None else [] for t in b.column("text").to_pylist()]
            some = [i for i, r in enumerate(rows) if r]
            if some:
                yield pa.RecordBatch.from_arrays([b.column("id").take(pa.array(some)), _nested([rows[i] for i in some])], ["id", "spans"])

    kind = texts.schema["id"].dataType.simpleString()
    return spread(texts.select("id", "text")).mapInArrow(run, f"id {kind}, spans array<struct<{_SPAN}>>")


# -- lexicon --------------------------------------------------------------
def learn_lexicon(cands: DataFrame, settings: Settings = Settings()) -> np.ndarray:
    """For each slot of the hashed words: 1 a part of names, -1 none, 0 unknown.

    Counted over all candidates of names: how many stand right after a cue.
    The driver receives one row a slot, at most 2 ** lexicon_bits.
    """
    s = settings
    names = cands.select(F.explode("spans").alias("x")).where(F.col("x.kind") == KINDS.index("name"))
    word = names.select(F.explode(F.array("x.w0", "x.w1")).alias("w"), "x.strong").where("w >= 0")
    rows = word.groupBy("w").agg(F.count(F.lit(1)).alias("n"), F.count_if("strong").alias("k")).toPandas()
    out = np.zeros(1 << s.lexicon_bits, np.int8)
    w, n, k = (rows[c].to_numpy() for c in ("w", "n", "k"))
    out[w[(k >= s.seen) & (k >= s.named * n)]] = 1
    out[w[(n >= s.often) & (k < s.plain * n)]] = -1
    return out


def with_lexicon(cands: DataFrame, lexicon: np.ndarray) -> DataFrame:
    """The candidates with the lexicon's votes in their patterns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column("spans")
            x = lists.flatten()
            pattern = np.asarray(x.field("pattern"))
            pattern = pattern + _lexicon_votes(lexicon, np.stack([np.asarray(x.field(w)) for w in ("w0", "w1")], 1)) @ _POW[list(_LEX)]
            fields = [x.field(f.name) if f.name != "pattern" else pa.array(pattern.astype(np.int32)) for f in x.type]
            offsets = pa.array(np.asarray(lists.offsets) - lists.offsets[0].as_py(), pa.int32())
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(fields, [f.name for f in x.type]))], ["id", "spans"])

    return cands.mapInArrow(run, cands.schema)


def voted_candidates(texts: DataFrame, settings: Settings = Settings()) -> tuple[DataFrame, np.ndarray]:
    """(candidates with all votes, lexicon). Texts without any capital, or only with capitals, are searched once the lexicon is known."""
    base = shared_dir(texts.sparkSession)
    plain = (F.col("text") == F.lower("text")) != (F.col("text") == F.upper("text"))
    first = stored(candidates(texts.where(~plain), settings), f"{base}/candidates")
    lexicon = learn_lexicon(first, settings)
    both = with_lexicon(first, lexicon).unionByName(candidates(texts.where(plain), settings, lexicon))
    return stored(both, f"{base}/voted"), lexicon


# -- aggregation of votes -------------------------------------------------
_BETTER = np.array([0.05, 0.4, 0.55])
#: A vote against counts for a factor of twenty at least, one in favour never against.
_SURE = np.log(20)


def aggregate_votes(patterns: np.ndarray, counts: np.ndarray, silent: bool = False, rounds: int = 40) -> np.ndarray:
    """Probability that a span with a pattern of votes (a row of `patterns`, in -1, 0, 1) is real.

    Two-class expectation-maximisation with a table P(vote | class) for each
    labeler; the start is the sign of the summed votes. silent: a vote of 0
    is none (most names stand without a cue); elsewhere it counts, as an id
    number or a phone is seldom without its announcement.
    """
    v, n = patterns + 1, counts.astype(float)
    post = 1 / (1 + np.exp(-3.0 * (patterns.sum(1) - 0.5)))
    for _ in range(rounds):
        prior = min(max(float((n * post).sum() / n.sum()), 0.005), 0.995)
        odds = np.zeros(len(v))
        for j in range(v.shape[1]):
            # each table leans to a labeler that is better than chance; the class of the unreal by a share of all weight, so that a kind whose candidates are all real stays in one class
            yes, no = _BETTER * (1 + 0.1 * (n @ post)), _BETTER[::-1] * (1 + 0.0005 * n.sum())
            np.add.at(yes, v[:, j], n * post)
            np.add.at(no, v[:, j], n * (1 - post))
            told = np.log(yes / yes.sum()) - np.log(no / no.sum())
            told[0], told[2] = min(told[0], -_SURE), max(told[2], 0.0)
            if silent:
                told[1] = 0.0
            odds += told[v[:, j]]
        # votes of one span share causes; temper their product
        post = 1 / (1 + np.exp(-np.clip(np.log(prior / (1 - prior)) + 0.7 * odds, -30, 30)))
    return post


@dataclass
class Classifier:
    """Logistic regression per kind over votes and hashed context."""

    weights: dict[int, tuple[float, np.ndarray, np.ndarray]]

    def probability(self, kind: np.ndarray, votes: np.ndarray, feats: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Of each span; feats and row are the features of all spans and the spans they belong to. A kind never seen has 0."""
        z = np.full(len(kind), -30.0)
        x = _one_hot(votes)
        for k, (b, wv, wf) in self.weights.items():
            mine = kind == k
            z[mine] = (b + x @ wv + np.bincount(row, wf[feats], minlength=len(kind)))[mine]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _one_hot(votes: np.ndarray) -> np.ndarray:
    return (votes[:, :, None] == np.array([-1, 0, 1])).reshape(len(votes), -1).astype(float)


def fit_classifier(votes: np.ndarray, y: np.ndarray, feats: list[np.ndarray], s: Settings, rounds: int = 300) -> tuple[float, np.ndarray, np.ndarray]:
    """Intercept, weights of the votes and of the context of one kind, by gradient steps on the probabilities y."""
    x, n = _one_hot(votes), len(votes)
    idx = np.concatenate([np.asarray(f, int) for f in feats])
    row = np.repeat(np.arange(n), [len(f) for f in feats])
    b, wv, wf = 0.0, np.zeros(x.shape[1]), np.zeros(s.buckets)
    gv, gf, gb = np.full(x.shape[1], 1e-6), np.full(s.buckets, 1e-6), 1e-6
    for _ in range(rounds):
        z = b + x @ wv + np.bincount(row, wf[idx], minlength=n)
        e = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
        dv, df, db = x.T @ e / n + 1e-4 * wv, np.bincount(idx, e[row], minlength=s.buckets) / n + 1e-3 * wf, e.mean()
        gv, gf, gb = gv + dv**2, gf + df**2, gb + db**2
        wv, wf, b = wv - 0.3 * dv / np.sqrt(gv), wf - 0.1 * df / np.sqrt(gf), b - 0.3 * db / np.sqrt(gb)
    return b, wv, wf


def train(cands: DataFrame, settings: Settings = Settings()) -> Classifier:
    """Fit the classifier from the votes of all candidates.

    The counts of vote patterns are taken over all rows (a pattern table is
    bounded by 3 ** labelers); the regression sees a hash sample of spans, at
    most train_spans.
    """
    s = settings
    x = cands.select("id", F.explode("spans").alias("x")).select("id", "x.*")
    counts = x.groupBy("kind", "pattern").count().toPandas()
    if not len(counts):
        return Classifier({})
    total = int(counts["count"].sum())
    place = F.pmod(F.xxhash64("id", "kind", "start_pos", "end_pos"), F.lit(1_000_003)) / 1_000_003
    rows = x.withColumn("place", place).where(F.col("place") < min(1.0, 1.2 * s.train_spans / total)).select("kind", "pattern", "feats", "place", "id", "start_pos").orderBy("place", "id", "start_pos").limit(s.train_spans).toPandas()
    weights = {}
    for kind, part in counts.groupby("kind"):
        pattern = part["pattern"].to_numpy()
        posterior = dict(zip(pattern.tolist(), aggregate_votes(_votes(pattern), part["count"].to_numpy(), KINDS[kind] == "name").tolist(), strict=True))
        mine = rows[rows["kind"] == kind]
        if len(mine):
            y = np.array([posterior[p] for p in mine["pattern"]])
            weights[int(kind)] = fit_classifier(_votes(mine["pattern"].to_numpy()), y, list(mine["feats"]), s)
    return Classifier(weights)


# -- decision -------------------------------------------------------------
def best_names(start: np.ndarray, end: np.ndarray, p: np.ndarray) -> list[int]:
    """Those of the overlapping spans of a text that don't overlap and have the greatest summed log odds."""
    order = np.argsort(end, kind="stable")
    odds = np.log(np.maximum(p, 1e-9) / np.maximum(1 - p, 1e-9))
    best, picked = [0.0], [[]]
    ends = end[order]
    for k, i in enumerate(order):
        j = int(np.searchsorted(ends[:k], start[i], "left"))
        take = best[j] + odds[i]
        if take > best[-1]:
            best.append(take)
            picked.append([*picked[j], int(i)])
        else:
            best.append(best[-1])
            picked.append(picked[-1])
    return picked[-1]


def _accepted(model: Classifier, s: Settings, text: np.ndarray, kind: np.ndarray, start: np.ndarray, end: np.ndarray, pattern: np.ndarray, feats: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(numbers of the accepted spans, probabilities of all); `text` is the text each span belongs to, in ascending order."""
    p = model.probability(kind, _votes(pattern), feats, row)
    ok = p >= s.accept
    name = KINDS.index("name")
    kept = np.flatnonzero(ok & (kind != name)).tolist()
    i = np.flatnonzero(ok & (kind == name))
    for part in np.split(i, np.flatnonzero(np.diff(text[i])) + 1):
        kept.extend(part[best_names(start[part], end[part], p[part])] if len(part) > 1 else part)
    return np.sort(np.array(kept, int)), p


def decide(cands: DataFrame, model: Classifier, settings: Settings = Settings()) -> DataFrame:
    """(id, kind, start_pos, end_pos, probability) of the candidates that the classifier accepts; accepted names don't overlap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column("spans")
            x = lists.flatten()
            if not len(x):
                continue
            text = np.repeat(np.arange(len(lists)), np.diff(np.asarray(lists.offsets)))
            kind, start, end, pattern = (np.asarray(x.field(f)) for f in ("kind", "start_pos", "end_pos", "pattern"))
            feats = x.field("feats")
            row = np.repeat(np.arange(len(x)), np.diff(np.asarray(feats.offsets)))
            keep, p = _accepted(model, settings, text, kind, start - 1, end, pattern, np.asarray(feats.flatten()), row)
            ids = b.column("id").take(pa.array(text[keep]))
            yield pa.RecordBatch.from_arrays([ids, pa.array([KINDS[k] for k in kind[keep]], pa.string()), pa.array(start[keep]), pa.array(end[keep]), pa.array(p[keep])], ["id", "kind", "start_pos", "end_pos", "probability"])

    kind = cands.schema["id"].dataType.simpleString()
    return cands.mapInArrow(run, f"id {kind}, kind string, start_pos int, end_pos int, probability double")


def redact(texts: DataFrame, model: Classifier, lexicon: np.ndarray, settings: Settings = Settings()) -> DataFrame:
    """(id, text, n_found): each accepted span replaced by its placeholder, the rest as it stands.

    One pass without a shuffle. Null texts stay null, blank ones as they are.
    """
    s = settings

    def placed(t: str) -> tuple[str, int]:
        found = spans(t, s, lexicon)
        if not found:
            return t, 0
        feats = np.concatenate([np.array(x.feats, int) for x in found])
        row = np.repeat(np.arange(len(found)), [len(x.feats) for x in found])
        col = lambda f: np.array([f(x) for x in found])
        keep, _ = _accepted(model, s, np.zeros(len(found), int), col(lambda x: KINDS.index(x.kind)), col(lambda x: x.start), col(lambda x: x.end), col(lambda x: _pattern(x.votes)), feats, row)
        for x in sorted((found[i] for i in keep), key=lambda x: -x.start):
            t = f"{t[: x.start]}[{x.kind.upper()}]{t[x.end :]}"
        return t, len(keep)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            out = [placed(t) if isinstance(t, str) else (None, 0) for t in pdf["text"]]
            yield pd.DataFrame({"id": pdf["id"], "text": [t for t, _ in out], "n_found": [n for _, n in out]})

    kind = texts.schema["id"].dataType.simpleString()
    return spread(texts.select("id", "text")).mapInPandas(run, f"id {kind}, text string, n_found int")
