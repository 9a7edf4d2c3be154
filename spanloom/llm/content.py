"""Main text of HTML pages: the best-scoring run of words, with tag weights learned from labelled pages.

A page is a row of words, which score positive, and tags, which score negative: a tag costs the more, the
oftener it stands outside of the main text on labelled pages. One linear scan finds the contiguous run of
greatest sum. Inside it, what is never main text (navigation, forms, scripts, adverts, comments and the
like) is left out; the rest is given block by block.

A tag is known by its name and that of the element around it. Pages count as labelled where their own
markup names the main text (``article``, ``main`` or an article body); at most ``most`` of them are read.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.llm.rows import flat_map, hashed_sample, map_rows

#: Fixed values of the HTML standard and of common usage.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img",
    "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup",
    "time", "tt", "u", "var", "wbr",
}
RAW = {"script", "style", "textarea", "xmp", "iframe", "noembed", "noframes", "title"}
NEVER = {
    "aside", "audio", "button", "canvas", "dialog", "embed", "footer", "form", "head", "iframe", "input", "map", "menu",
    "nav", "noscript", "object", "option", "script", "select", "style", "svg", "template", "textarea", "title", "video",
}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "alert", "dialog", "form", "menu", "menubar"}
_HINT = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|advertising|banners?|breadcrumbs?|comments?|cookies?|consent|disqus|footers?|"
    r"gdpr|masthead|menus?|modal|nav|navbar|navigation|newsletter|notices?|outbrain|pagination|popups?|promos?|"
    r"promotions?|related|replies|respond|share|sharing|sidebars?|social|sponsor|sponsored|subscribe|taboola|toolbar|"
    r"widgets?)(?:$|[\s_-])"
)
MAIN = {"article", "main"}

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<(?P<close>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*?)(?P<end>/?>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.S,
)
_MARK = re.compile(r"(class|id|role|itemprop|hidden|aria-hidden)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
Tag = tuple[str, str]


class Page:
    """``items``: ("tag", key, block) or ("text", string, block), each with whether it is in main markup and
    whether it is in an element that is never main text."""

    def __init__(self, source: str):
        self.items: list[tuple[str, object, int, bool, bool]] = []
        self.open: list[tuple[str, bool, bool]] = []  # name, opens the main text, opens what is never main
        self.names: Counter[str] = Counter()  # of open elements
        self.around = [""]  # open elements that are blocks, or links
        self.main = self.never = self.block = 0
        at, size = 0, len(source)
        while at < size:
            found = _TOKEN.search(source, at)
            stop = found.start() if found else size
            if stop > at:
                self._text(source[at:stop])
            if not found:
                break
            at = found.end()
            name = (found["name"] or "").lower()
            if not name or found["end"] == "" and at == size:
                continue  # a comment, a declaration, or a tag cut off
            if found["close"]:
                self._close(name)
                continue
            self._open(name, found["rest"])
            if name in RAW and not found["end"].startswith("/"):
                ending = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)", re.I).search(source, at)
                at = ending.start() if ending else size

    def _text(self, raw: str) -> None:
        self.items.append(("text", html.unescape(raw), self.block, self.main > 0, self.never > 0))

    def _tag(self, name: str) -> None:
        around = self.around[-1]
        if name not in INLINE:
            self.block += 1
        self.items.append(("tag", (around, name), self.block, self.main > 0, self.never > 0))

    def _open(self, name: str, rest: str) -> None:
        if self.open and name not in INLINE and self.open[-1][0] in ("p", "b", "i", "em", "strong", "span", "a", "u"):
            while self.open and self.open[-1][0] in INLINE and self.names["p"]:
                self._pop()  # inline elements left open end with their paragraph
            if self.open and self.open[-1][0] == "p":
                self._pop()
        if name == "li" and self.open and self.open[-1][0] == "li":
            self._pop()
        marks = {m[1].lower(): (m[2] or m[3] or m[4] or "").lower() for m in _MARK.finditer(rest)} if rest.strip() else {}
        main = name in MAIN or marks.get("itemprop") == "articlebody" or marks.get("role") in ("main", "article")
        named = any(_HINT.search(marks.get(m, "")) for m in ("class", "id"))
        never = (
            name in NEVER
            or marks.get("role") in ROLES
            or "hidden" in marks
            or marks.get("aria-hidden") == "true"
            or name == "header" and not self.main
            or named and name not in ("html", "body")
        )
        main = main and not named
        if main:  # its own tag already belongs to it
            self.main += 1
        self.never += never
        self._tag(name)
        if name in VOID:
            self.main -= main
            self.never -= never
        else:
            self._push(name, main, never)

    def _push(self, name: str, main: bool, never: bool) -> None:
        self.open.append((name, main, never))
        self.names[name] += 1
        if name not in INLINE or name == "a":
            self.around.append(name)

    def _pop(self) -> None:
        name, main, never = self.open.pop()
        self.names[name] -= 1
        if name not in INLINE or name == "a":
            self.around.pop()
        self.main -= main
        self.never -= never

    def _close(self, name: str) -> None:
        if not self.names[name]:
            return
        while self.open[-1][0] != name:
            self._pop()
        inside = self.main, self.never
        self._pop()
        after = self.main, self.never
        self.main, self.never = inside  # its own tag still belongs to it
        self._tag("/" + name if name not in INLINE else name)
        self.main, self.never = after


def tag_counts(source: str | None) -> Counter:
    """(around, name, in the main text) -> number of tags; empty for a page without labels."""
    items = Page(source or "").items
    if not any(main for _, _, _, main, _ in items):
        return Counter()
    return Counter((*key, main) for kind, key, _, main, _ in items if kind == "tag")


def fit_tags(pages: DataFrame, key: str = "page_id", text: str = "html", most: int = 2000) -> dict[Tag, float]:
    """Cost of each tag, from ``most`` labelled pages at most (the first by hash of their key).

    It is the log odds that the tag stands outside of the main text times ten, and at least a tenth of a word.
    A tag seen only around other elements costs what it costs there on the whole, but no more than a
    word, which tags not seen at all cost, too.
    """
    named = F.lower(F.col(text)).rlike("<(article|main)[\\s>]|articlebody")
    keys = pages.where(named).select(F.col(key).alias("_key"), F.length(text).alias("_size"))
    chosen = hashed_sample(keys.distinct(), most, "_key", "_size")
    same = F.col(key).eqNullSafe(F.col("_key")) & (F.length(text) == F.col("_size"))
    chosen = pages.join(F.broadcast(chosen), same, "left_semi").select(text)

    def count():
        def some(part: pa.RecordBatch):
            total = Counter()
            for source in part.column(0).to_pylist():
                total += tag_counts(source)
            return [list(c) for c in zip(*((*k, n) for k, n in total.items()), strict=True)] if total else None

        return some

    rows = (
        flat_map(chosen, count, "around string, name string, main boolean, n long")
        .groupBy("around", "name")
        .agg(F.sum(F.when(F.col("main"), F.col("n")).otherwise(0)).alias("i"), F.sum(F.when(F.col("main"), 0).otherwise(F.col("n"))).alias("o"))
        .collect()  # the kinds of tags of the sample
    )
    whole: dict[str, list[int]] = {}
    for r in rows:
        pair = whole.setdefault(r["name"], [0, 0])
        pair[0] += r["i"]
        pair[1] += r["o"]
    costs = {(r["around"], r["name"]): _cost(r["i"], r["o"]) for r in rows}
    return costs | {("*", name): min(1.0, _cost(*pair)) for name, pair in whole.items() if name not in INLINE}


def _cost(inside: int, outside: int) -> float:
    return max(0.1, 10 * math.log((outside + 0.5) / (inside + 0.5)))


def main_text(source: str | None, costs: dict[Tag, float]) -> str:
    """Main text of one page: blocks joined by a line feed, empty if no word scores."""
    items = Page(source or "").items
    best = total = 0.0
    start = first = last = 0
    for i, (kind, value, _, _, never) in enumerate(items):
        if kind == "tag":
            total -= costs.get(value) or costs.get(("*", value[1]), 1.0)
        elif not never:
            total += len(value.split())
        if total <= 0:
            total, start = 0.0, i + 1
        elif total > best:
            best, first, last = total, start, i + 1
    blocks: dict[int, list[str]] = {}
    for kind, value, block, _, never in items[first:last]:
        if not never:
            blocks.setdefault(block, []).append(" " if kind == "tag" and value[1] in ("br", "img") else value if kind == "text" else "")
    joined = (" ".join("".join(parts).split()) for parts in blocks.values())
    return "\n".join(b for b in joined if b)


def extract_text(pages: DataFrame, costs: dict[Tag, float], key: str = "page_id", url: str = "url", text: str = "html") -> DataFrame:
    """One row per page: key, URL and ``_main``, its main text.

    Null and empty pages, and pages without words outside of what is never main text, give the empty
    string. Pages are read whole, tags cut off at the end are dropped, elements left open end with the
    element around them. Repeated rows are treated alike; other columns are not read.
    """
    shared = pages.sparkSession.sparkContext.broadcast(costs)

    def extract():
        known = shared.value
        return lambda source: (main_text(source, known),)

    slim = pages.select(F.col(key), F.col(url), F.col(text).alias("_html"))
    return map_rows(slim, extract, ["_html"], "_main string").drop("_html")
