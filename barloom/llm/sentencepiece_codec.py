"""Exact merge-type encoding by backtracking, and decoding.

A row of pieces is the model's encoding exactly if each two neighbours, merged anew from their
characters, come out as these two pieces again. So the encoder never replays the merges of a
text: it takes the longest piece at each position, from one Aho-Corasick pass, checks it against
the piece before, falls back to shorter pieces, and marks positions that cannot be continued in
a bit field so that none is tried twice.
"""

from __future__ import annotations

import hashlib
from array import array
from functools import lru_cache

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame

from barloom.llm.columns import add_columns
from barloom.llm.pieces import SPACE, Memo, Pieces, pieces


class Encoder:
    def __init__(self, vocabulary: Pieces):
        self.vocabulary = vocabulary
        v = vocabulary
        self.verdicts: dict[int, bool] = {}
        # Characters that only longer pieces hold get numbers past the vocabulary; they leave the
        # encoder as bytes.
        known = list(v.texts)
        self.number = dict(v.ids)
        for char in sorted(v.symbols - v.ids.keys()):
            self.number[char] = len(known)
            known.append(char)
        self.known = known
        # A piece whose own characters merge to something else never occurs in an encoding.
        self.number = {t: i for t, i in self.number.items() if len(t) == 1 or self._merged(t, 0)}
        self.shorter = {i: self._prefix(t) for t, i in self.number.items()}
        self.lengths = {i: len(t) for t, i in self.number.items()}
        # Reversed, so that a match's end is where the piece begins in the text.
        self.automaton = ahocorasick.Automaton()
        for text, i in self.number.items():
            self.automaton.add_word(text[::-1], i)
        self.automaton.make_automaton()
        self.packed = Memo(self._pack)

    def _prefix(self, text: str) -> int:
        """The longest piece that is a proper prefix, or -1."""
        return next((self.number[text[:k]] for k in range(len(text) - 1, 0, -1)
                     if text[:k] in self.number), -1)

    def _merged(self, text: str, cut: int) -> bool:
        """Merge ``text`` from its characters. True if it ends as text[:cut], text[cut:]
        (as one piece for cut 0), with no merge across the cut on the way."""
        rank, symbols = self.vocabulary.rank, list(text)
        border = cut
        while len(symbols) > 1:
            best, at = None, -1
            for k in range(len(symbols) - 1):
                r = rank.get(symbols[k] + symbols[k + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, k
            if best is None:
                break
            if cut:
                if at + 1 == border:
                    return False
                border -= at + 1 < border
            symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]
        return len(symbols) == (2 if cut else 1)

    def compatible(self, left: int, right: int) -> bool:
        key = left << 32 | right
        found = self.verdicts.get(key)
        if found is None:
            a = self.known[left]
            if len(self.verdicts) >= 150_000:
                self.verdicts.clear()
            found = self.verdicts[key] = self._merged(a + self.known[right], len(a))
        return found

    def chunk(self, text: str) -> list[int]:
        """The numbers of one chunk's pieces."""
        n = len(text)
        longest = [-1] * n
        for end, i in self.automaton.iter(text[::-1]):
            if longest[n - 1 - end] < 0:  # the longest of those that end here comes first
                longest[n - 1 - end] = i
        failed = bytearray(n // 8 + 1)
        out: list[int] = []
        at, token = 0, longest[0]
        while True:
            end = at + self.lengths[token]
            if not failed[end >> 3] >> (end & 7) & 1 and (not out or self.compatible(out[-1], token)):
                out.append(token)
                if end == n:
                    return out
                at, token = end, longest[end]
                continue
            token = self.shorter[token]
            if token < 0:  # nothing fits here: give back the piece before
                failed[at >> 3] |= 1 << (at & 7)
                token = out.pop()
                at -= self.lengths[token]

    def _pack(self, chunk: str) -> bytes:
        v = self.vocabulary
        if chunk[0] not in v.symbols:
            found = v.byte_fallback(chunk)
        else:
            found = []
            for i in self.chunk(chunk):
                found.extend([i] if i < v.size else v.byte_fallback(self.known[i]))
        return array("I", found).tobytes()

    def encode(self, text: str | None, ends: bool = True) -> bytes:
        """Ids as little-endian 32-bit integers; with begin and end ids if ``ends``."""
        body = map(self.packed.__getitem__, self.vocabulary.split(text or ""))
        if not ends:
            return b"".join(body)
        v = self.vocabulary
        return b"".join([array("I", [v.bos]).tobytes(), *body, array("I", [v.eos]).tobytes()])


class Decoder:
    """Joins pieces: byte pieces are UTF-8, a byte that is not becomes U+FFFD; control ids give
    nothing; the space that the encoder put before the text goes."""

    UNKNOWN = " ⁇ "

    def __init__(self, vocabulary: Pieces):
        v = vocabulary
        raw = {i: bytes([b]) for b, i in v.byte_ids.items()}
        self.raw = raw
        self.pieces = [raw.get(i) or (t.replace(SPACE, " ").encode() if t in v.ids and v.ids[t] == i else b"")
                       for i, t in enumerate(v.texts)]
        self.pieces[v.unk] = self.UNKNOWN.encode()
        self.first = {i for t, i in v.ids.items() if t.startswith(SPACE)}

    def decode(self, ids: bytes) -> str:
        numbers = array("I", ids).tolist()
        parts = list(map(self.pieces.__getitem__, numbers))
        lead = next((k for k, p in enumerate(parts) if p), None)
        if lead is not None and numbers[lead] in self.first:
            parts[lead] = parts[lead][1:]
        # Ids that give nothing end a run of byte pieces when they stand between others.
        if parts and parts.count(b"") == (parts[0] == b"") + (parts[-1] == b"" and len(parts) > 1):
            try:
                return b"".join(parts).decode()
            except UnicodeDecodeError:
                pass
        return self._mend(numbers, parts)

    def _mend(self, numbers: list[int], parts: list[bytes]) -> str:
        out, run = [], b""
        for i, part in zip([*numbers, None], [*parts, b""]):
            if i in self.raw:
                run += part
                continue
            out.append(_each_bad_byte(run) + part.decode())
            run = b""
        return "".join(out)


def _each_bad_byte(run: bytes) -> str:
    """UTF-8 with every byte that is part of no character as its own U+FFFD."""
    out = ""
    while run:
        for k in (1, 2, 3, 4):
            try:
                out += run[:k].decode()
                run = run[k:]
                break
            except UnicodeDecodeError:
                continue
        else:
            out, run = out + "�", run[1:]
    return out


@lru_cache(maxsize=2)
def codec(model_file: str) -> tuple[Encoder, Decoder]:
    """One encoder and decoder per worker process."""
    vocabulary = pieces(model_file)
    return Encoder(vocabulary), Decoder(vocabulary)


def encode_decode(docs: DataFrame, model_file: str, text: str = "text", keep: list[str] | None = None,
                  with_ids: bool = False, with_decoded: bool = False) -> DataFrame:
    """Each row of ``docs`` with n_tokens, ids_sha256, decoded_sha256 and, as wanted, the ids
    (array<int>) and the decoded text.

    The ids are those of the sentencepiece library with begin and end ids. A null text counts as
    empty and has the two end ids. Rows are independent: repeated rows repeat their results, an
    empty table gives an empty one, columns named like results are replaced, and a text of any
    length is encoded whole. ``model_file`` must be readable on the executors.
    """
    columns = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    columns += ", ids array<int>" * with_ids + ", decoded string" * with_decoded

    def make():
        encoder, decoder = codec(model_file)

        def compute(texts):
            for text in texts:
                ids = encoder.encode(text)
                decoded = decoder.decode(ids)
                row = (len(ids) // 4, hashlib.sha256(ids).hexdigest(),
                       hashlib.sha256(decoded.encode()).hexdigest())
                if with_ids:
                    row += (np.frombuffer(ids, "<i4"),)
                yield row + (decoded,) if with_decoded else row
        return compute

    return add_columns(docs, text, columns, make, keep)
