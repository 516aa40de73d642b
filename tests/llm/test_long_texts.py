"""Hostile texts of a megabyte."""

import base64
import random
import time

from barloom.llm.secret_scans import find_secrets


def test_lines_of_base64():
    raw = random.Random(3).randbytes(750_000)
    text = base64.encodebytes(raw).decode()
    began = time.thread_time()
    base, added = find_secrets(text)
    assert time.thread_time() - began < 20 and len(added) > 10_000
    # No span within another; those of the whole are those of its halves, but for the middle.
    ordered = sorted((a, b) for _, a, b in added)
    assert all(a < c and b < d for (a, b), (c, d) in zip(ordered, ordered[1:]))
    half = text.index("\n", len(text) // 2) + 1
    first, second = find_secrets(text[:half])[1], find_secrets(text[half:])[1]
    assert sorted(added) == sorted(first + [(n, a + half, b + half) for n, a, b in second])
