"""Personal data with offsets kept through normalisation.

A text is scanned as it is (the base spans) and once more after a chain of transducers:

1. look-alike characters (full width, Cyrillic, Greek, mathematical letters, other digits) become
   ASCII, invisible characters go;
2. runs of spelled digits (English, German, Spanish, French) become digits;
3. ``(at)``, `` at ``, ``[dot]`` and the like become ``@`` and ``.`` where an address or an IP results.

Each transducer keeps the list of its edits, so a span of the last text maps back, edit by edit, to
the code points of the source. Spans that only the normalised text shows are added to the base
spans unless a base span of their kind covers them.

Every step is linear in the text: no pattern restarts inside a run that it has read.

Defined results: a null or empty text has no spans; repeated rows give repeated rows; ties (spans
with one start) are ordered by kind; an empty table gives an empty table; other columns are ignored
by ``find`` and kept by ``mask``.
"""

from __future__ import annotations

import bisect
import hashlib
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
MASKS = ("[EMAIL]", "[IP]", "[CARD]", "[PHONE]")

# --- base detectors: fixed patterns -------------------------------------------------------------
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"([0-9]++)(?:\.([0-9]++)\.([0-9]++)\.([0-9]++))?")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def _emails(text: str):
    # the part before an @ is the longest run of its characters that ends there
    prev, at = 0, text.find("@")
    while at >= 0:
        start = prev + len(text[prev:at].rstrip(_LOCAL))
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end(), 0
        prev = m.end() if m else at + 1
        at = text.find("@", prev)


def _ips(text: str):
    for m in _IP.finditer(text):
        if m.group(2) is not None:
            parts = [g.lstrip("0") for g in m.groups()]
            if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
                yield m.start(), m.end(), 1


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _cards(text: str):
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = _NOT_DIGIT.sub("", m.group())
            if 14 <= len(digits) <= 19 and _luhn(digits):
                yield m.start(), m.end(), 2


def _phones(text: str):
    for m in _PHONE.finditer(text):
        if 10 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
            yield m.start(), m.end(), 3


def detect(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) in code points, leftmost and non-overlapping within a kind."""
    found = list(_emails(text)) if "@" in text else []
    if _DIGIT.search(text):
        found += _ips(text) if "." in text else ()
        found += _cards(text)
        found += _phones(text) if "+" in text else ()
    return sorted(found, key=lambda s: (s[0], s[2]))


# --- transducers --------------------------------------------------------------------------------
class Edited:
    """A rewritten text that maps its spans back to the text before."""

    def __init__(self, text: str, edits: list[tuple[int, int, str]]):
        parts, self.new_end, self.old, at, size = [], [], [], 0, 0
        self.new_start = []
        for start, end, put in edits:
            parts += (text[at:start], put)
            size += start - at
            self.new_start.append(size)
            size += len(put)
            self.new_end.append(size)
            self.old.append((start, end))
            at = end
        parts.append(text[at:])
        self.text = "".join(parts)

    def back(self, start: int, end: int) -> tuple[int, int]:
        k = bisect.bisect_right(self.new_start, start) - 1
        while k >= 0 and self.new_end[k] == self.new_start[k] == start:
            k -= 1  # a deletion just before the span isn't part of it
        if k < 0:
            first = start
        elif start < self.new_end[k]:
            first = self.old[k][0]
        else:
            k = bisect.bisect_right(self.new_end, start) - 1
            first = self.old[k][1] + start - self.new_end[k]
        k = bisect.bisect_left(self.new_start, end) - 1
        if k < 0:
            return first, end
        if end <= self.new_end[k]:
            return first, self.old[k][1]
        return first, self.old[k][1] + end - self.new_end[k]


# Letters that look like an ASCII letter.
_LOOKALIKES = dict(zip(
    "АВЕКМНОРСТХІЅЈаеорсухіјѕԁԛԝһ" "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧοια" "․。·∙‐‑–−",
    "ABEKMHOPCTXISJaeopcyxijsdqwh" "ABEZHIKMNOPTYXoia" "....----", strict=True))
# Characters that show nothing.
_INVISIBLE = "­​‌‍⁠﻿"


def _fold(c: str) -> str | None:
    """The ASCII character that ``c`` stands for; None if it stands for itself."""
    if c in _LOOKALIKES:
        return _LOOKALIKES[c]
    if c in _INVISIBLE:
        return ""
    if unicodedata.category(c) == "Nd":
        return str(unicodedata.digit(c))
    plain = unicodedata.normalize("NFKC", c)
    return plain if len(plain) == 1 and "!" <= plain <= "~" else None


_FOLDS = {c: f for c in map(chr, [*range(0x80, 0xD800), *range(0xE000, 0x20000)]) if (f := _fold(c)) is not None}


def fold_edits(text: str) -> list[tuple[int, int, str]]:
    if text.isascii() or _FOLDS.keys().isdisjoint(text):
        return []
    return [(i, i + 1, _FOLDS[c]) for i, c in enumerate(text) if c in _FOLDS]


# Digit words in order from nought to nine, and the signs between them.
_DIGIT_WORDS = {
    "en": "zero one two three four five six seven eight nine",
    "de": "null eins zwei drei vier fünf sechs sieben acht neun",
    "es": "cero uno dos tres cuatro cinco seis siete ocho nueve",
    "fr": "zéro un deux trois quatre cinq six sept huit neuf",
}
_SIGN_WORDS = {"dot": ".", "point": ".", "punkt": ".", "punto": ".", "plus": "+", "más": "+", "dash": "-", "oh": "0"}
_SPELLED = {w: str(i) for words in _DIGIT_WORDS.values() for i, w in enumerate(words.split())}
#: A run counts from so many spelled digits on: an IP of one-digit parts has four.
MIN_SPELLED = 4
_TOKEN = "|".join(sorted([*_SPELLED, *_SIGN_WORDS], key=len, reverse=True))
_SPELLED_RUN = re.compile(rf"\b(?:{_TOKEN}|(?<![0-9])[0-9]++)(?:[\s,\-]{{1,3}}(?:{_TOKEN}|[0-9]++)\b){{3,}}+", re.I)
_SPELLED_TOKEN = re.compile(rf"{_TOKEN}|[0-9]+", re.I)


def _spells(text: str) -> bool:
    """Whether MIN_SPELLED digit words stand near each other; the pattern itself is slow to search for."""
    words = text.lower().replace("-", " ").replace(",", " ").split()
    at = [i for i, w in enumerate(words) if w.rstrip(".") in _SPELLED]
    return any(b - a < 3 * MIN_SPELLED for a, b in zip(at, at[MIN_SPELLED - 1:]))


def spelled_edits(text: str) -> list[tuple[int, int, str]]:
    edits = []
    if not _spells(text):
        return edits
    for m in _SPELLED_RUN.finditer(text):
        tokens = [t.lower() for t in _SPELLED_TOKEN.findall(m.group())]
        if sum(t in _SPELLED for t in tokens) >= MIN_SPELLED:
            edits.append((m.start(), m.end(), "".join(_SPELLED.get(t, _SIGN_WORDS.get(t, t)) for t in tokens)))
    return edits


# Words written for the signs of an address.
_AT_WORDS, _DOT_WORDS = "at|arroba|klammeraffe|arobase", "dot|punkt|punto|point"
_AT = rf"(?:\s*[(\[{{<]\s*(?:{_AT_WORDS}|@)\s*[)\]}}>]\s*|\s+(?:{_AT_WORDS})\s+|\s*@\s*)"
_DOT = rf"(?:\s*[(\[{{<]\s*(?:{_DOT_WORDS}|\.)\s*[)\]}}>]\s*|\s+(?:{_DOT_WORDS})\s+|\.)"
_DISGUISED_MAIL = re.compile(
    rf"(?<![A-Za-z0-9_%+-])[A-Za-z0-9_%+-]++(?:{_DOT}[A-Za-z0-9_%+-]++){{0,8}}+({_AT})([A-Za-z0-9-]++(?:{_DOT}[A-Za-z0-9-]++){{1,8}}+)", re.I)
_DISGUISED_IP = re.compile(rf"(?<![0-9.])[0-9]{{1,3}}+(?:{_DOT}[0-9]{{1,3}}+){{3}}(?![0-9])", re.I)
_SIGNS = re.compile(rf"({_AT})|({_DOT})", re.I)
_WORDED_DOT = re.compile(rf"[(\[{{<]|\s(?:{_DOT_WORDS})\s", re.I)
_SIGN_SET = {*_AT_WORDS.split("|"), *_DOT_WORDS.split("|")} - {"at"}
_MAYBE = re.compile(rf"[(\[{{<]\s*(?:{_AT_WORDS}|{_DOT_WORDS}|@|\.)\s*[)\]}}>]|\s(?:{_DOT_WORDS}|arroba|klammeraffe|arobase)\s", re.I)


def sign_edits(text: str) -> list[tuple[int, int, str]]:
    worded = not _SIGN_SET.isdisjoint(text.lower().split())
    if not (worded or any(b in text for b in "([{<")) or not _MAYBE.search(text):
        return []
    edits = []
    for pattern in (_DISGUISED_MAIL, _DISGUISED_IP):
        for m in pattern.finditer(text):
            if pattern is _DISGUISED_MAIL:
                # "look at this.thing" is ordinary: a bare word for @ needs a worded dot in the host
                bare = not re.search(r"[(\[{<@]", m.group(1))
                if bare and not _WORDED_DOT.search(m.group(2)):
                    continue
            for s in _SIGNS.finditer(text, m.start(), m.end()):
                put = "@" if s.group(1) is not None else "."
                if s.group() != put:
                    edits.append((s.start(), s.end(), put))
    edits.sort()
    out = []
    for e in edits:  # an address and an IP may claim the same sign
        if not out or e[0] >= out[-1][1]:
            out.append(e)
    return out


TRANSDUCERS = (fold_edits, spelled_edits, sign_edits)


def added(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans of the source text that only its normalised form shows."""
    chain, now = [], text
    for transduce in TRANSDUCERS:
        if edits := transduce(now):
            chain.append(Edited(now, edits))
            now = chain[-1].text
    if not chain:
        return []
    taken = {k: sorted((s, e) for s, e, x in base if x == k) for k in range(len(KINDS))}
    out = []
    for start, end, kind in detect(now):
        for step in reversed(chain):
            start, end = step.back(start, end)
        own = taken[kind]  # within a kind they don't overlap, so the last that starts here or before decides
        k = bisect.bisect_right(own, (start, len(text)))
        if not (k and own[k - 1][1] >= end):
            out.append((start, end, kind))
    return out


def _joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, e, k in spans)


def spans_of(text: str | None) -> tuple[list, list]:
    text = text or ""
    base = detect(text)
    return base, sorted(base + added(text, base), key=lambda s: (s[0], s[2]))


# --- Spark --------------------------------------------------------------------------------------
_FOUND = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"


def _find(texts: pd.Series) -> pd.DataFrame:
    rows = []
    for text in texts:
        base, every = spans_of(text)
        counts = [sum(x[2] == k for x in base) for k in range(len(KINDS))]
        rows.append((*counts, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(every), len(every) - len(base)))
    return pd.DataFrame(rows, columns=[c.split()[0] for c in _FOUND.split(", ")])


def masked(text: str) -> str:
    """The text with each span replaced by its kind; overlapping spans become one mask, of the earliest."""
    out, at = [], 0
    for start, end, kind in spans_of(text)[1]:
        if start >= at:
            out += (text[at:start], MASKS[kind])
        at = max(at, end)
    out.append(text[at:])
    return "".join(out)


def _mask(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else masked(t))


def mask(text: Column) -> Column:
    """A text column with personal data replaced; null stays null."""
    return F.pandas_udf(_mask, "string")(text)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: base counts (n_*), digest of the base spans, and all spans."""
    return docs.select(F.col(id_col).alias("doc_id"), F.pandas_udf(_find, _FOUND)(F.col(text_col).cast("string")).alias("r")).select("doc_id", "r.*")
