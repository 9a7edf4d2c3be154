"""Personal data in plain and in disguise, by its place in the text as it stands.

A text passes transducers, each of which writes a normalised text and remembers, per change, the stretch it came
from: ``fold`` replaces look-alike characters one for one, ``bare`` leaves out invisible ones, ``mail_signs`` writes
at and dot signs for their disguises, ``digits`` writes digits for spelled and look-alike ones. The patterns
for plain identifiers then read the normalised text, and what they find is mapped back, change by change, to
the characters of the source. A find counts as disguised only if its source reads differently, no
letter or digit touches it, and no plain identifier of its kind overlaps it.

Signs that ordinary prose holds too are read as disguises in context alone: the word *at* between words is one
if the host has a disguised dot, or the name before it mixes letters with digits, dots or signs; the word
*dot* only inside of a host, of such a name, or between digits.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.llm.rows import map_rows

KINDS = ("email", "ip", "card", "phone")

# The plain forms.
_MAIL_NAME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_HOST = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_CARD_DIGITS, _PHONE_DIGITS = range(13, 20), range(9, 16)

# Characters that look like a Latin letter or sign and have no such compatibility form.
_LOOKALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "ӏ": "l", "м": "m", "о": "o", "р": "p",
    "ԛ": "q", "ѕ": "s", "т": "t", "у": "y", "ѵ": "v", "ԝ": "w", "х": "x",
    "А": "A", "В": "B", "С": "C", "Е": "E", "Н": "H", "І": "I", "Ј": "J", "К": "K", "М": "M", "О": "O", "Р": "P", "Ѕ": "S", "Т": "T",
    "У": "Y", "Х": "X",
    "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "γ": "y",
    "Α": "A", "Β": "B", "Ε": "E", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "Ζ": "Z",
    "ı": "i", "ɡ": "g", "ɑ": "a", "ʟ": "l", "օ": "o", "ս": "u", "հ": "h",
    "。": ".", "｡": ".", "۔": ".", "−": "-", "⁄": "/",
}
# Digits as words in four languages, and the words for signs.
_SPELLED = {
    "zero": 0, "one": 1, "two": 2, "three": 3, "four": 4, "five": 5, "six": 6, "seven": 7, "eight": 8, "nine": 9, "oh": 0,
    "null": 0, "eins": 1, "zwei": 2, "zwo": 2, "drei": 3, "vier": 4, "fünf": 5, "fuenf": 5, "sechs": 6, "sieben": 7, "acht": 8, "neun": 9,
    "zéro": 0, "un": 1, "deux": 2, "trois": 3, "quatre": 4, "cinq": 5, "sept": 7, "huit": 8, "neuf": 9,
    "cero": 0, "uno": 1, "dos": 2, "tres": 3, "cuatro": 4, "cinco": 5, "seis": 6, "siete": 7, "ocho": 8, "nueve": 9,
}
_TIMES = {"double": 2, "triple": 3}
_AT_WORDS, _DOT_WORDS = "at|arroba|arobase", "dot|punkt|point|punto"

_OPEN, _SHUT = r"\s{0,3}[(\[{<]\s{0,3}", r"\s{0,3}[)\]}>]\s{0,3}"
_STRONG_DOT = rf"{_OPEN}(?:{_DOT_WORDS}|\.){_SHUT}"
_WEAK_DOT = rf"(?:[ ]{{1,3}}(?:{_DOT_WORDS})[ ]{{1,3}}|_(?:{_DOT_WORDS})_|-(?:{_DOT_WORDS})-)"
_ANY_DOT = rf"(?>{_STRONG_DOT}|{_WEAK_DOT}|\.)"
_LABEL = r"[A-Za-z0-9](?:(?!-(?:dot|punkt|point|punto)-)[A-Za-z0-9-])*+"
_HOST_IN_DISGUISE = re.compile(rf"{_LABEL}(?:{_ANY_DOT}{_LABEL})++", re.I)
_HOST_DOT = re.compile(rf"{_STRONG_DOT}|{_WEAK_DOT}|\.", re.I)
_DOT_BEFORE = re.compile(rf"(?:{_STRONG_DOT}|{_WEAK_DOT})\Z", re.I)
_LONGEST_DOT = 6 + 2 + 6 + 5 + 1  # characters of a dot in disguise
_AT = re.compile(
    rf"(?<=[A-Za-z0-9%+._-])(?:(?P<strong>{_OPEN}(?:{_AT_WORDS}|@){_SHUT})"
    rf"|(?P<weak>[ ]{{1,3}}(?:{_AT_WORDS}|@)[ ]{{1,3}}|_(?:{_AT_WORDS})_|-(?:{_AT_WORDS})-|[ ]{{1,3}}@|@[ ]{{1,3}})|(?P<plain>@))(?=[A-Za-z0-9])",
    re.I,
)
_TOP = re.compile(r"[A-Za-z]{2,}\Z")
_MIXED = re.compile(r"(?=.*[A-Za-z])(?=.*[0-9._%+-])[A-Za-z0-9].*[A-Za-z0-9]\Z", re.S)

_WORD = "|".join(sorted(_SPELLED, key=len, reverse=True))
_ITEM = rf"(?>(?:(?:{'|'.join(_TIMES)})[ -])?(?:{_WORD})(?!\w)|(?-i:[0-9OoIl]++)(?!\w))"
_BETWEEN = rf"(?>{_STRONG_DOT}|[ ]{{1,3}}(?:{_DOT_WORDS})[ ]{{1,3}}|[ .,()-]{{1,3}})"
_CHAIN = re.compile(rf"(?<!\w)(?:plus[ -]{{1,3}}(?=[\w(]))?{_ITEM}(?:{_BETWEEN}{_ITEM}){{3,}}+", re.I)
_STEP = re.compile(rf"(?P<item>{_ITEM})|(?P<plus>plus[ -]{{1,3}})|(?P<dot>{_STRONG_DOT}|[ ]{{1,3}}(?:{_DOT_WORDS})[ ]{{1,3}})|(?P<other>[ .,()-]{{1,3}})", re.I)
_LETTERS_AS_DIGITS = str.maketrans("OoIl", "0011")


class Change(NamedTuple):
    """``source[start:stop]`` was written as ``text``."""

    start: int
    stop: int
    text: str


class Written:
    """A text after changes, with the way back."""

    def __init__(self, source: str, changes: list[Change]):
        parts, self.at, self.end, self.start, self.stop, done, length = [], [], [], [], [], 0, 0
        for change in changes:
            parts += [source[done : change.start], change.text]
            length += change.start - done
            self.at.append(length)
            length += len(change.text)
            self.end.append(length)
            self.start.append(change.start)
            self.stop.append(change.stop)
            done = change.stop
        self.text = "".join([*parts, source[done:]]) if changes else source

    def back(self, start: int, stop: int) -> tuple[int, int]:
        """The stretch of the source that ``text[start:stop]`` (not empty) was written from."""
        return self._char(start)[0], self._char(stop - 1)[1]

    def _char(self, place: int) -> tuple[int, int]:
        i = bisect_right(self.at, place) - 1
        if i < 0:
            return place, place + 1
        if place < self.end[i]:
            return self.start[i], self.stop[i]
        own = self.stop[i] + place - self.end[i]
        return own, own + 1


class _Folds(dict):
    """Characters to the ASCII ones they look like; found out once each."""

    def __missing__(self, code: int) -> int:
        char = chr(code)
        plain = _LOOKALIKES.get(char)
        if plain is None and code > 127:
            kind = unicodedata.category(char)
            form = unicodedata.normalize("NFKC", char)
            if kind == "Nd":
                plain = str(unicodedata.decimal(char))
            elif kind == "Pd":
                plain = "-"
            elif kind == "Zs":
                plain = " "
            elif kind == "Cf" or 0xFE00 <= code <= 0xFE0F:
                plain = "​"
            elif len(form) == 1 and form.isascii() and form.isprintable():
                plain = form
        self[code] = ord(plain) if plain else code
        return self[code]


_FOLDS = _Folds()


def fold(text: str) -> str:
    """Look-alikes as ASCII, invisible characters as U+200B; every character keeps its place."""
    return text if text.isascii() else text.translate(_FOLDS)


def bare(text: str) -> Written:
    """Without invisible characters."""
    return Written(text, [Change(m.start(), m.end(), "") for m in re.finditer("​+", text)])


def mail_signs(text: str) -> Written:
    """At and dot signs where they are disguised."""
    changes: list[Change] = []
    done = 0
    for at in _AT.finditer(text):
        host = _HOST_IN_DISGUISE.match(text, at.end())
        if host is None or at.start() < done:
            continue
        dots = [(m.start(), m.end()) for m in _HOST_DOT.finditer(text, host.start(), host.end())]
        ends = [start for start, _ in dots[1:]] + [host.end()]
        while dots and not _TOP.match(text[dots[-1][1] : ends[-1]]):  # the last label is a word
            dots.pop()
            ends.pop()
        named = _name_before(text, at.start(), done)
        if not dots or named is None:
            continue
        begin, before = named
        hidden = [Change(start, stop, ".") for start, stop in dots if text[start:stop] != "."]
        if at.lastgroup == "weak" and not hidden and not before and not _MIXED.match(text[begin : at.start()]):
            continue
        if at.lastgroup != "plain" or hidden or before:
            signs = [] if at.lastgroup == "plain" else [Change(at.start(), at.end(), "@")]
            changes += [*before, *signs, *hidden]
        done = ends[-1]
    return Written(text, changes)


def _name_before(text: str, stop: int, low: int) -> tuple[int, list[Change]] | None:
    """Where the name that ends at ``stop`` begins, and its dots in disguise; None without a name."""
    changes: list[Change] = []
    begin = end = stop
    while True:
        while begin > low and text[begin - 1] in _MAIL_NAME:
            begin -= 1
        if begin == end:
            break
        dot = _DOT_BEFORE.search(text, max(low, begin - _LONGEST_DOT), begin)
        if dot is None or dot.start() == low or text[dot.start() - 1] not in _MAIL_NAME:
            return begin, changes[::-1]
        changes.append(Change(dot.start(), begin, "."))
        begin = end = dot.start()
    return None


def digits(text: str) -> Written:
    """Digits, their dots and the plus sign where they are spelled out or look-alike letters."""
    changes: list[Change] = []
    for chain in _CHAIN.finditer(text):
        said = chain.group()
        if not any(c.isalpha() or c in "[{<" for c in said) and "(.)" not in said:
            continue
        at, spelled, gap = chain.start(), False, None  # gap: between two items
        while at < chain.end():
            step = _STEP.match(text, at, chain.end())
            if step is None:
                break
            kind, value = step.lastgroup, step.group()
            if kind == "item":
                word = not set(value) <= set("0123456789OoIl")
                if gap is not None and spelled and word:
                    changes.append(Change(gap[0], gap[1], ""))
                new = _digits_of(value) if word else value.translate(_LETTERS_AS_DIGITS)
                if new != value:
                    changes.append(Change(step.start(), step.end(), new))
                spelled, gap = word, None
            elif kind == "plus":
                changes.append(Change(step.start(), step.end(), "+"))
            elif kind == "dot":
                changes.append(Change(step.start(), step.end(), "."))
                spelled = False
            else:
                gap = step.span() if not value.strip(" ,-") else None
            at = step.end()
    return Written(text, changes)


def _digits_of(value: str) -> str:
    times, _, word = value.lower().replace("-", " ").rpartition(" ")
    if word not in _SPELLED or times and times not in _TIMES:  # letters that only match when case is ignored
        return value
    return str(_SPELLED[word]) * _TIMES.get(times, 1)


def plain_spans(text: str) -> Iterator[tuple[str, int, int]]:
    """``(kind, start, stop)`` of plain identifiers, leftmost first and without overlaps within a kind.

    Times grow with the text: a name is read back from its at sign, and no pattern goes over a stretch of
    digits from each of its digits.
    """
    done, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in _MAIL_NAME:
            begin -= 1
        host = _HOST.match(text, at + 1) if begin < at else None
        if host:
            yield "email", begin, host.end()
            done = host.end()
        else:
            done = at + 1
        at = text.find("@", max(done, at + 1))
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") or "0" for p in m.groups()]
        if all(len(p) <= 3 and int(p) <= 255 for p in parts):
            yield "ip", m.start(), m.end()
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= _CARD_DIGITS[0]:
            value = re.sub("[ -]", "", m.group())
            if len(value) in _CARD_DIGITS and _luhn(value):
                yield "card", m.start(), m.end()
    for m in _PHONE.finditer(text):
        if sum(c.isdigit() for c in m.group()) in _PHONE_DIGITS:
            yield "phone", m.start(), m.end()


def _luhn(value: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(value)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def hidden_spans(text: str, plain: list[tuple[str, int, int]]) -> Iterator[tuple[str, int, int, str]]:
    """``(kind, start, stop, value)`` of identifiers in disguise; ``value`` is the normalised form."""
    folded = fold(text)
    shown = bare(folded) if "​" in folded else Written(folded, [])
    taken: dict[str, list[tuple[int, int]]] = {k: [(s, e) for kind, s, e in plain if kind == k] for k in KINDS}
    starts = {k: [s for s, _ in v] for k, v in taken.items()}
    for write, kinds in ((mail_signs, ("email",)), (digits, ("ip", "card", "phone"))):
        written = write(shown.text)
        if written.text is shown.text and shown.text == text:
            continue
        for kind, start, stop in plain_spans(written.text):
            if kind not in kinds or _touched(written.text, start, stop):
                continue
            begin, end = shown.back(*written.back(start, stop))
            value = written.text[start:stop]
            before = bisect_right(starts[kind], begin) - 1
            overlaps = before >= 0 and taken[kind][before][1] > begin or before + 1 < len(starts[kind]) and starts[kind][before + 1] < end
            if text[begin:end] != value and not overlaps:
                yield kind, begin, end, value


def _touched(text: str, start: int, stop: int) -> bool:
    return start > 0 and text[start - 1].isalnum() or stop < len(text) and text[stop].isalnum()


def find_identifiers(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key and ``spans``, an array of ``kind, start, stop, hidden, value`` by kind (email,
    ip, card, phone), then start.

    Places are code points of the text as it stands, ``stop`` is exclusive. Plain identifiers (``hidden`` false) are
    those of the patterns alone: no disguise takes one away. ``value`` is the normalised form. A null or empty
    text has none. Rows are independent; an empty table gives no rows; other columns are not read.
    """

    def find():
        def one(value):
            value = value or ""
            plain = list(plain_spans(value))
            found = [(KINDS.index(k), s, e, False, value[s:e]) for k, s, e in plain]
            found += [(KINDS.index(k), s, e, True, v) for k, s, e, v in hidden_spans(value, plain)]
            return ([{"kind": KINDS[k], "start": s, "stop": e, "hidden": h, "value": v} for k, s, e, h, v in sorted(found)],)

        return one

    slim = docs.select(F.col(key), F.col(text).alias("_identified_text"))
    out = map_rows(slim, find, ["_identified_text"], "spans array<struct<kind: string, start: long, stop: long, hidden: boolean, value: string>>")
    return out.select(key, "spans")
