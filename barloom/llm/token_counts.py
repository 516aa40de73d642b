"""Token counts by byte-pair merging with a heap over a linked list; no identifiers are made."""

from __future__ import annotations

import heapq
from functools import lru_cache

from pyspark.sql import DataFrame

from barloom.llm.columns import add_columns
from barloom.llm.pieces import Memo, Pieces, pieces

#: Texts with more tokens than this are over the limit.
TOKEN_LIMIT = 4096


class Counter:
    def __init__(self, vocabulary: Pieces):
        self.vocabulary = vocabulary
        self.counts = Memo(self._chunk)

    def _chunk(self, chunk: str) -> int:
        """Symbols minus merges. A symbol that is no piece in the end counts its bytes."""
        rank = self.vocabulary.rank
        if len(chunk) == 1:
            return 1 if chunk in rank else len(chunk.encode())
        symbols: list[str | None] = list(chunk)
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, k, t) for k in range(n - 1)
                if (r := rank.get(t := chunk[k:k + 2])) is not None]
        heapq.heapify(heap)
        merges = 0
        while heap:
            _, left, whole = heapq.heappop(heap)
            right = after[left] if symbols[left] is not None else n
            # A pair is stale when either side has been merged since it was pushed.
            if right >= n or symbols[left] + symbols[right] != whole:
                continue
            merges += 1
            symbols[left], symbols[right] = whole, None
            beyond = after[left] = after[right]
            if beyond < n:
                before[beyond] = left
                r = rank.get(t := whole + symbols[beyond])
                if r is not None:
                    heapq.heappush(heap, (r, left, t))
            ahead = before[left]
            if ahead >= 0:
                r = rank.get(t := symbols[ahead] + whole)
                if r is not None:
                    heapq.heappush(heap, (r, ahead, t))
        unknown = sum(len(s.encode()) - 1 for s in symbols if s is not None and s not in rank)
        return n - merges + unknown

    def count(self, text: str | None) -> int:
        return sum(map(self.counts.__getitem__, self.vocabulary.split(text or "")))


@lru_cache(maxsize=2)
def counter(model_file: str) -> Counter:
    """One counter per worker process."""
    return Counter(pieces(model_file))


def token_counts(docs: DataFrame, model_file: str, text: str = "text", limit: int = TOKEN_LIMIT,
                 keep: list[str] | None = None) -> DataFrame:
    """Each row of ``docs`` with n_bytes (UTF-8), n_tokens and over_limit (n_tokens > ``limit``).

    Counts are those of the sentencepiece library without begin and end ids. A null or empty
    text has none. Rows are independent: repeated rows repeat their results, an empty table
    gives an empty one, columns named like results are replaced, and a text of any length is
    counted whole.
    """
    def make():
        count = counter(model_file).count

        def compute(texts):
            for text in texts:
                n = count(text)
                yield len((text or "").encode()), n, n > limit
        return compute

    return add_columns(docs, text, "n_bytes bigint, n_tokens bigint, over_limit boolean", make, keep)
