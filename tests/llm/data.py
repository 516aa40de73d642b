"""Small tables with the awkward cases, and what tests share."""

from __future__ import annotations

import random

FEW = "the of and to in"
LONG = " ".join(f"w{k % 977}x{k % 31}" for k in range(30_000))


def rows() -> list[tuple]:
    """Documents: nulls, empty and blank texts, a very long one, repeated rows, several scripts,
    a row without an id."""
    rnd = random.Random(5)
    words = [f"{a}{b}{c}" for a in ("ba", "ke", "ló", "ßu") for b in ("ra", "ti", "no") for c in ("s", "nd", "")]
    text = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    out = [(k, text(rnd.randint(1, 120)) + "\n" + text(12)) for k in range(40)]
    out += [(40, None), (41, ""), (42, " \n\t "), (43, LONG), (44, LONG + " end"), (45, "a"), (46, "A"),
            (47, out[3][1]), (47, out[3][1]), (48, out[3][1].upper()), (None, out[5][1]), (None, None),
            (49, "漢字 🙂\u0000 x y ▁<s> \r\n"), (50, "x" * 5000), (51, FEW + "\n" + FEW)]
    return out


def frame(spark, data=None):
    """The documents, with columns named like what operators add."""
    data = rows() if data is None else data
    return spark.createDataFrame(
        [(i, t, "mine", k, "s") for k, (i, t) in enumerate(data)],
        "doc_id bigint, text string, N_TOKENS string, kept int, fingerprint string").repartition(3)


def lower(text: str | None) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def split_white(text: str | None) -> list[str]:
    return [w.decode() for w in (text or "").encode().split()]
