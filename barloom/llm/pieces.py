"""The vocabulary of a merge-type (BPE) sentencepiece model, and how texts fall into chunks."""

from __future__ import annotations

import re
from functools import lru_cache

SPACE = "▁"


class Pieces:
    """Pieces, their merge ranks and byte pieces, read through the library's accessors.

    Only models with the identity normaliser, a dummy prefix, kept white space and a full byte
    fallback are taken; others raise ``ValueError``, as their texts would need other steps.
    """

    def __init__(self, model_file: str):
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_file=model_file)
        if library.normalize("ﬁ  x ") != f"{SPACE}ﬁ{SPACE}{SPACE}x{SPACE}":
            raise ValueError("the model normalises texts; only the identity is supported")
        self.size = library.vocab_size()
        self.bos, self.eos, self.unk = library.bos_id(), library.eos_id(), library.unk_id()
        self.texts: list[str] = [library.id_to_piece(i) for i in range(self.size)]
        self.byte_ids: dict[int, int] = {}
        self.ids: dict[str, int] = {}
        #: The smaller, the earlier two neighbours are merged into this piece.
        self.rank: dict[str, float] = {}
        for i, text in enumerate(self.texts):
            if library.is_byte(i):
                self.byte_ids[int(text[3:5], 16)] = i
            elif not (library.is_control(i) or library.is_unknown(i)):
                self.ids[text] = i
                self.rank[text] = -library.get_score(i)
        if len(self.byte_ids) < 256:
            raise ValueError("the model has no full byte fallback")
        if any(SPACE in text.lstrip(SPACE) for text in self.ids):
            raise ValueError("a piece runs over a word's end")
        joined = {c for text in self.ids if len(text) > 1 for c in text}
        inside = "".join(map(re.escape, sorted(joined - {SPACE})))
        # No piece spans two chunks: a space begins a word, and a character that is part of no
        # longer piece stands alone.
        self.chunks = re.compile(f"{SPACE}*[{inside}]+|{SPACE}+|[^{inside}{SPACE}]").findall
        self.symbols = joined | {text for text in self.ids if len(text) == 1}

    def split(self, text: str) -> list[str]:
        """Chunks of a text, with spaces written as the model writes them; none for ""."""
        return self.chunks((SPACE + text).replace(" ", SPACE)) if text else []

    def byte_fallback(self, char: str) -> list[int]:
        return [self.byte_ids[b] for b in char.encode()]


@lru_cache(maxsize=2)
def pieces(model_file: str) -> Pieces:
    """One vocabulary per worker process."""
    return Pieces(model_file)


class Memo(dict):
    """Results by chunk, in two generations of at most LIMIT: when one is full, it replaces the
    older one, and what is asked for again moves over. So memory stays bounded and chunks in use
    are not lost."""

    LIMIT, LONGEST = 100_000, 48

    def __init__(self, compute):
        super().__init__()
        self.compute, self.older = compute, {}

    def __missing__(self, chunk: str):
        value = self.older.get(chunk)
        if value is None:
            value = self.compute(chunk)
            if len(chunk) > self.LONGEST:
                return value
        if len(self) >= self.LIMIT:
            self.older = dict(self)
            self.clear()
        self[chunk] = value
        return value
