"""Secrets in texts: known forms by pattern, unknown ones by entropy in a sliding window."""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import DataFrame

from barloom.llm.columns import add_columns

Span = tuple[str, int, int]

# The base patterns and the least lengths of what they must match.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")


@dataclass(frozen=True)
class CharClass:
    """Runs of ``chars`` of at least ``window`` characters are candidates; a window with more
    than ``bits`` bits per character is suspicious."""

    name: str
    chars: bytes
    window: int
    bits: float
    mixed: bool  # a window must hold a digit and a letter


CLASSES = (
    CharClass("entropy_hex", b"0123456789abcdefABCDEF", 20, 3.0, True),
    CharClass("entropy_base64", b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-=",
              20, 3.75, True),
    CharClass("entropy_base32", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 20, 3.4, True),
    CharClass("entropy_lower", b"abcdefghijklmnopqrstuvwxyz0123456789", 20, 3.4, True),
)
#: Text of examples. It does not count in a window, whatever stands beside it.
ALLOW = re.compile(r"example|sample|dummy|placeholder|changeme|test|x{4,}|0{8,}", re.IGNORECASE)
#: Least length of neighbours in the alphabet or of counted digits, which are allowed too.
SEQUENCE_LEAST = 6
UUID = re.compile(r"(?<![0-9a-f])[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}(?![0-9a-f])", re.IGNORECASE)
PIECE = re.compile(r"[A-Za-z0-9]+")
#: Part of an address or a name: words in one case or in humps, with a number or alone.
WORD = re.compile(r"[a-z]{0,24}(?:[A-Z][a-z]{2,23}){0,9}\d{0,4}|[A-Z]{1,16}\d{0,4}|\d{1,10}|[A-Za-z]\d{1,2}[a-z]?")
KINDS = ("assign", "access", "hex", *(c.name for c in CLASSES))


def base_spans(text: str, data: bytes) -> Iterator[Span]:
    """Matches of the base patterns. A text without a pattern's fixed part is not searched."""
    low = data.lower()
    if any(k in low for k in KEYWORDS):
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= ASSIGN_LEAST:
                yield "assign", m.start(), m.end()
    if b"AKIA" in data:
        for m in ACCESS.finditer(text):
            if m.end() - m.start() >= ACCESS_LEAST:
                yield "access", m.start(), m.end()
    for start, end in runs(text, data, b"0123456789abcdef", HEX_LEAST):
        yield "hex", start, end


def runs(text: str, data: bytes, chars: bytes, least: int) -> Iterator[tuple[int, int]]:
    """Where maximal runs of ``least`` or more of ``chars`` (ASCII) lie, in code points."""
    marked = data.translate(bytes(1 if b in chars else 0 for b in range(256)))
    ascii_only = len(text) == len(data)
    at, chars_before, counted = 0, 0, 0
    while (start := marked.find(b"\1" * least, at)) >= 0:
        end = marked.find(b"\0", start)
        end = len(marked) if end < 0 else end
        if ascii_only:
            yield start, end
        else:
            chars_before += len(data[counted:start].decode())
            counted = start
            yield chars_before, chars_before + end - start
        at = end


def suspicious(candidate: str, kind: CharClass) -> Iterator[tuple[int, int]]:
    """Merged windows above the threshold. The sum of c*log2(c) over the character counts is
    kept up to date as one character enters and one leaves, so each step is constant work."""
    w = kind.window
    weigh = [0.0] + [c * math.log2(c) for c in range(1, w + 1)]
    counts: dict[str, int] = {}
    total, digits, letters = 0.0, 0, 0
    start = end = -1
    for k, char in enumerate(candidate):
        c = counts.get(char, 0)
        total += weigh[c + 1] - weigh[c] if c < w else 0.0
        counts[char] = c + 1
        digits += char.isdigit()
        letters += char.isalpha()
        if k + 1 < w:
            continue
        if math.log2(w) - total / w > kind.bits and (not kind.mixed or digits and letters):
            if start >= 0 and k + 1 - w <= end:
                end = k + 1
            else:
                if start >= 0:
                    yield start, end
                start, end = k + 1 - w, k + 1
        gone = candidate[k + 1 - w]
        c = counts[gone]
        total -= weigh[c] - weigh[c - 1]
        counts[gone] = c - 1
        digits -= gone.isdigit()
        letters -= gone.isalpha()
    if start >= 0:
        yield start, end


def addresses(candidate: str) -> Iterator[tuple[int, int]]:
    """Parts that are addresses or names: a UUID, two or more words beside each other with one
    of three letters among them, or one word of eight or more characters."""
    for m in UUID.finditer(candidate):
        yield m.span()
    start = end = count = -1
    longest = 0

    def is_address():
        return count >= 2 and longest >= 3 or count == 1 and end - start >= 8

    for m in PIECE.finditer(candidate):
        if WORD.fullmatch(m[0]):
            if count < 1:
                start, count, longest = m.start(), 0, 0
            count += 1
            end = m.end()
            longest = max(longest, sum(map(str.isalpha, m[0])))
        else:
            if is_address():
                yield start, end
            count = 0
    if is_address():
        yield start, end


def sequences(candidate: str) -> Iterator[tuple[int, int]]:
    """Parts in which each character is the one after the character before, as in abcdef."""
    low, start = candidate.lower(), 0
    for k in range(1, len(low) + 1):
        if k == len(low) or ord(low[k]) != ord(low[k - 1]) + 1:
            if k - start >= SEQUENCE_LEAST:
                yield start, k
            start = k


def secret_parts(candidate: str, kind: CharClass) -> Iterator[tuple[int, int]]:
    """Suspicious parts of a run: cut at addresses, and without counting examples."""
    cuts = sorted(addresses(candidate))
    at = 0
    for start, end in [*cuts, (len(candidate), len(candidate))]:
        part = candidate[at:start] if start - at >= kind.window else ""
        gone = [*(m.span() for m in ALLOW.finditer(part)), *sequences(part)] if part else []
        if not gone:
            yield from ((at + a, at + b) for a, b in suspicious(part, kind))
        else:
            out = {p for a, b in gone for p in range(a, b)}
            stay = [p for p in range(len(part)) if p not in out]
            for a, b in suspicious("".join(part[p] for p in stay), kind):
                yield at + stay[a], at + stay[b - 1] + 1
        at = max(at, end)


def find_secrets(text: str | None) -> tuple[list[Span], list[Span]]:
    """(base spans, added spans). An added span does not lie within a base span or within
    another added one; of two with the same place the first class's is taken."""
    if not text:
        return [], []
    data = text.encode()
    base = list(base_spans(text, data))
    begins = sorted((s, e) for _, s, e in base)
    reach = list(accumulate((e for _, e in begins), max))
    # No added span lies within another, so both their starts and their ends ascend.
    starts: list[int] = []
    ends: list[int] = []
    names: list[str] = []
    for kind in CLASSES:
        for start, end in runs(text, data, kind.chars, kind.window):
            candidate = text[start:end]
            for a, b in secret_parts(candidate, kind):
                a, b = start + a, start + b
                before = bisect_right(begins, (a, len(text)))
                at = bisect_right(starts, a)
                if before and reach[before - 1] >= b or at and ends[at - 1] >= b:
                    continue
                first, last = bisect_left(starts, a), bisect_right(ends, b)
                starts[first:last], ends[first:last], names[first:last] = [a], [b], [kind.name]
    return base, list(zip(names, starts, ends))


def spans_text(spans: list[Span]) -> str:
    """kind:start:end by start, then kind, comma-joined."""
    ordered = sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
    return ",".join(f"{k}:{a}:{b}" for k, a, b in ordered)


def scan_secrets(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Each row of ``docs`` with n_assign, n_access, n_hex, base_sha256 and spans.

    Positions are code points, ends exclusive. A null text counts as empty and has no spans;
    its base_sha256 is that of the empty string. Rows are independent: repeated rows repeat
    their results, an empty table gives an empty one, columns named like results are replaced,
    and a text of any length is searched whole.
    """
    def make():
        def compute(texts):
            for t in texts:
                base, added = find_secrets(t)
                kinds = [k for k, _, _ in base]
                yield (*(kinds.count(k) for k in KINDS[:3]),
                       hashlib.sha256(spans_text(base).encode()).hexdigest(),
                       spans_text(base + added))
        return compute

    return add_columns(docs, text, "n_assign bigint, n_access bigint, n_hex bigint, "
                       "base_sha256 string, spans string", make, keep)
