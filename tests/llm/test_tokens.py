"""op1 and op6 against the library."""

import hashlib
import random
from array import array

import public_tokenizers
import pytest
import sentencepiece

from barloom.llm.pieces import pieces
from barloom.llm.sentencepiece_codec import codec, encode_decode
from barloom.llm.token_counts import counter, token_counts
from tests.llm.data import frame, rows

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def hard_texts():
    rnd = random.Random(2)
    known = pieces(MODEL).texts[259:]
    yield from (" " * a + "x" * b for a in range(24) for b in range(24))
    yield from ("".join(rnd.choice("ab ▁\n\té漢🙂\0'.,<s>0x1AΩ") for _ in range(rnd.randint(0, 50)))
                for _ in range(2000))
    yield from ("".join(rnd.choice(known) for _ in range(rnd.randint(1, 6))) for _ in range(5000))


def test_encoding_and_counts_equal_the_library(library):
    encoder, decoder = codec(MODEL)
    count = counter(MODEL).count
    for text in hard_texts():
        ids = library.encode(text, add_bos=True, add_eos=True)
        packed = encoder.encode(text)
        assert array("I", packed).tolist() == ids, text
        assert decoder.decode(packed) == library.decode(ids), text
        assert count(text) == len(ids) - 2, text


def test_any_ids_decode_like_the_library(library):
    _, decoder = codec(MODEL)
    rnd = random.Random(4)
    for _ in range(5000):
        ids = [rnd.choice([rnd.randrange(32000), rnd.randrange(262), 28705]) for _ in range(rnd.randint(0, 8))]
        assert decoder.decode(array("I", ids).tobytes()) == library.decode(ids), ids


def test_frames(spark, library):
    docs = frame(spark)
    out = encode_decode(docs, MODEL, with_ids=True, with_decoded=True)
    assert out.columns == ["doc_id", "text", "kept", "fingerprint", "n_tokens", "ids_sha256",
                           "decoded_sha256", "ids", "decoded"]
    got = out.collect()
    assert len(got) == len(rows())
    for r in got:
        ids = library.encode(r.text or "", add_bos=True, add_eos=True)
        assert (r.ids, r.n_tokens, r.decoded) == (ids, len(ids), library.decode(ids))
        assert r.ids_sha256 == hashlib.sha256(array("I", ids).tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(r.decoded.encode()).hexdigest()
    for r in token_counts(docs, MODEL, limit=100).collect():
        n = len(library.encode(r.text or ""))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((r.text or "").encode()), n, n > 100)
    empty = docs.where("false")
    assert encode_decode(empty, MODEL).count() == token_counts(empty, MODEL).count() == 0
