"""What a page shows and says of itself, found in one pass however broken its markup is.

Patterns that look for the end of a tag, a quote or a script from each of its beginnings take a time
that grows with the square of a page that never closes them. Here the places of all quotes and
closing brackets are taken first, and where a tag ends follows from them backwards.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left

_SPECIAL = re.compile("[>\"']")
_BREAK = re.compile(r"</?(?:br|hr|p|div|h[1-6]|li|ul|ol|tr|table|article|section|blockquote|pre)\b", re.IGNORECASE)
_TAG = re.compile("<[a-zA-Z/!?]")
_HIDDEN = re.compile(r"<!--|<(script|style|noscript|template|head|svg)\b", re.IGNORECASE)
_CLOSED = {name: re.compile(rf"</{name}\s*>", re.IGNORECASE)
           for name in ("script", "style", "noscript", "template", "head", "svg")}
_TITLE, _TITLE_END = re.compile(r"<title\b", re.IGNORECASE), re.compile("</title", re.IGNORECASE)
_HTML, _LANG = re.compile(r"<html\b", re.IGNORECASE), re.compile(r"""\blang\s*=\s*["']?([A-Za-z-]+)""", re.IGNORECASE)
_LINK = re.compile(r"<(a|img|link|script|iframe)\b", re.IGNORECASE)
_TARGET = re.compile(r"""\b(?:href|src)\s*=\s*["']([^"']*)["']""", re.IGNORECASE)


class _Next:
    """The next match of a pattern at or after ascending positions; each part is looked at once."""

    def __init__(self, text: str, pattern: re.Pattern):
        self.text, self.pattern, self.found = text, pattern, None

    def __call__(self, at: int) -> re.Match | None:
        if self.pattern and (self.found is None or self.found.start() < at):
            self.found = self.pattern.search(self.text, at)
            if self.found is None:
                self.pattern = None
        return self.found if self.pattern else None


class TagEnds:
    """Where a tag that is open at a position ends: at the first > outside of quotes."""

    def __init__(self, text: str):
        self.places = [m.start() for m in _SPECIAL.finditer(text)]
        n = len(self.places)
        self.ends = [-1] * (n + 1)
        after = {"'": n, '"': n}  # of each quote, the next one behind
        for k in range(n - 1, -1, -1):
            c = text[self.places[k]]
            if c == ">":
                self.ends[k] = self.places[k]
            else:
                self.ends[k] = self.ends[after[c] + 1] if after[c] < n else -1
                after[c] = k

    def __call__(self, at: int) -> int:
        """The place of the bracket, or -1 if there is none or a quote stays open."""
        return self.ends[bisect_left(self.places, at)]


def without_hidden(page: str) -> str:
    """A page with a space for each comment and each element that is not shown."""
    parts, at, start = [], 0, _Next(page, _HIDDEN)
    comment, bracket = _Next(page, re.compile("-->")), _Next(page, re.compile(">"))
    closed = {name: _Next(page, pattern) for name, pattern in _CLOSED.items()}
    look = 0
    while m := start(look):
        look = m.end()
        if m[1] is None:
            end = comment(m.end())
        else:
            opened = bracket(m.end())
            end = closed[m[1].lower()](opened.end()) if opened else None
        if end:
            parts += (page[at:m.start()], " ")
            at = look = end.end()
    return "".join(parts) + page[at:]


def page_text(page: str) -> str:
    """Visible text: a line per block element, entities resolved, white space folded."""
    body = " ".join(without_hidden(page).split())
    parts, at, ends, look = [], 0, TagEnds(body), 0
    while (p := body.find("<", look)) >= 0:
        look = p + 1
        block = _BREAK.match(body, p)
        m = block or _TAG.match(body, p)
        end = ends(m.end()) if m else -1
        if end >= 0:
            parts += (body[at:p], "\n" * bool(block))
            at = look = end + 1
    text = html.unescape("".join(parts) + body[at:])
    lines = (" ".join(line.split()) for line in text.split("\n"))
    return "\n".join(line for line in lines if line)


def title(page: str) -> str | None:
    m = _TITLE.search(page)
    start = page.find(">", m.end()) if m else -1
    end = _TITLE_END.search(page, start + 1) if start >= 0 else None
    return page[start + 1:end.start()] if end else None


def language(page: str) -> str | None:
    m = _HTML.search(page)
    end = page.find(">", m.end()) if m else -1
    found = _LANG.findall(page, m.end(), end) if end >= 0 else []
    return found[-1] if found else None


def links(page: str) -> list[tuple[str, str]]:
    """(element, address) of each link, in order."""
    ends, found, opened = TagEnds(page), [], _Next(page, re.compile("<"))
    for m in _LINK.finditer(page):
        end, other = ends(m.end()), opened(m.end())
        limit = min(x for x in (end, other.start() if other else -1, len(page)) if x >= 0)
        target = _TARGET.search(page, m.end(), limit)
        if target:
            found.append((m[1].lower(), target[1]))
    return found
