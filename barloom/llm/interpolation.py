"""Language-model scores of documents by deleted interpolation.

The probability of a word after another mixes maximum-likelihood estimates from counts:

    P(w | v) = a(b) * c(v w) / c(v) + b(b) * c(w) / N + (1 - a(b) - b(b)) / (V + 1)

with one pair of weights for each bucket b of the context's frequency c(v). The weights are
learned by expectation-maximisation on a deleted part: training documents that are left out of
the counts while the weights are learned, and counted again for the scores.

Counts never leave the cluster. Documents form blocks by a hash of their id; a block sends each
of its n-grams once, by hash range, to where the range is summed, and gets the sums back.
Ranges are even whatever the words, as a frequent n-gram counts once per block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from barloom.llm.columns import with_package
from barloom.llm.storage import stored

#: Text bytes in a block, and n-grams (of all blocks together) in a hash range, about.
BLOCK_BYTES, RANGE_GRAMS = 12_000_000, 2_000_000
#: Context-frequency bucket k holds contexts seen 2**k - 1 to 2**(k+1) - 2 times.
BUCKETS = 48
#: Width of a step of the logarithmic scale on which estimates are gathered for learning weights.
SCALE, STEPS = 4, 256
EM_ROUNDS = 60
# Parts of the corpus.
COUNTED, DELETED, HELD_OUT = 0, 1, 2
WORD, PAIR = 0, 1

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_BEGIN, _END = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)
_CHARS_AT_ONCE = 1_000_000

Counts = tuple[np.ndarray, np.ndarray]
Tokens = tuple[np.ndarray, np.ndarray]


def part_of(id_column: str) -> Column:
    """By crc32 of the id as text, modulo 7: 2 is held out, 6 is the deleted part."""
    rest = F.pmod(F.crc32(F.col(id_column).cast("string").cast("binary")), F.lit(7))
    return F.when(rest == 2, HELD_OUT).when(rest == 6, DELETED).otherwise(COUNTED)


def _tokens(texts: pa.ChunkedArray) -> Iterator[Tokens]:
    """For some texts at a time the hashes of their tokens, each text closed by the end token,
    and the texts' token counts."""
    words: list[bytes] = []
    ends: list[int] = []
    chars = 0
    for text in texts:
        text = text.as_py() or ""
        words += text.encode().translate(_LOWER).split()
        words.append(b"")
        ends.append(len(words))
        chars += len(text)
        if chars > _CHARS_AT_ONCE:
            yield _hashed(words), np.diff(ends, prepend=0)
            words, ends, chars = [], [], 0
    if ends:
        yield _hashed(words), np.diff(ends, prepend=0)


def _hashed(words: list[bytes]) -> np.ndarray:
    coded = pa.array(words, pa.binary()).dictionary_encode()
    digest = xxhash.xxh64_intdigest
    known = np.fromiter((digest(w) if w else int(_END) for w in coded.dictionary.to_pylist()),
                        dtype=np.uint64, count=len(coded.dictionary))
    return known[coded.indices.to_numpy()]


def _contexts(tokens: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The token before each token; the begin mark before a text's first."""
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[np.cumsum(sizes) - sizes] = _BEGIN
    return before


def _pairs(before: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """One 64-bit hash for two in order."""
    x = before * np.uint64(0xBF58476D1CE4E5B9) + (tokens << np.uint64(32) | tokens >> np.uint64(32))
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(29)


def _range_cuts(hashes: np.ndarray, ranges: int) -> np.ndarray:
    """Where the ranges begin in sorted ``hashes``, and the end."""
    edges = np.array([(k << 64) // ranges for k in range(1, ranges)], dtype=np.uint64)
    return np.concatenate(([0], np.searchsorted(hashes, edges), [len(hashes)])).astype(np.int64)


def _counted(parts: list[np.ndarray]) -> Counts:
    """The different values, in order, and how often each is there."""
    values = np.concatenate(parts)
    values.sort()
    first = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
    return values[first], np.diff(first, append=len(values))


def _grams(tokens: list[Tokens]) -> Iterator[tuple[int, Counts]]:
    yield WORD, _counted([t for t, _ in tokens])
    yield PAIR, _counted([_pairs(_contexts(t, sizes), t) for t, sizes in tokens])


def _narrow(values: np.ndarray) -> bytes:
    """Whole numbers in as few bytes each as the largest needs, after a byte that says how many."""
    width = max(1, (int(values.max()).bit_length() + 7) // 8)
    return bytes([width]) + values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _wide(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8, offset=1).reshape(-1, data[0])
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, :data[0]] = raw
    return out.view("<u8").ravel()


def _sent(blocks: DataFrame, ranges: dict[int, int]) -> DataFrame:
    """(kind, range, block, part, hashes, counts): the n-grams of each block, by range. Hashes
    are in order and sent as steps."""
    schema = "kind int, range int, block bigint, part int, hashes binary, counts binary"

    def run(docs: pa.Table) -> pa.Table:
        block, part = docs["block"][0].as_py(), docs["part"][0].as_py()
        rows = []
        for kind, (hashes, counts) in _grams(list(_tokens(docs["text"]))):
            cuts = _range_cuts(hashes, ranges[kind])
            rows += [(kind, r, block, part, _narrow(np.diff(hashes[a:b], prepend=np.uint64(0))),
                      _narrow(counts[a:b]))
                     for r, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]
        return pa.table(dict(zip(("kind", "range", "block", "part", "hashes", "counts"),
                                 map(list, zip(*rows)))),
                        pa.schema([("kind", pa.int32()), ("range", pa.int32()), ("block", pa.int64()),
                                   ("part", pa.int32()), ("hashes", pa.binary()), ("counts", pa.binary())]))

    return blocks.groupBy("block").applyInArrow(run, schema)


_SUMS = pa.schema([("block", pa.int64()), ("kind", pa.int32()), ("range", pa.int32()),
                   ("counted", pa.binary()), ("learned", pa.binary()), ("n_counted", pa.int64()),
                   ("n_learned", pa.int64()), ("v_counted", pa.int64()), ("v_learned", pa.int64())])


def _summed(sent: DataFrame) -> DataFrame:
    """For each block and range the sums over all blocks, in the order of the block's hashes:
    counted (without the deleted part) and learned (with it). A row without a block has the
    range's totals and numbers of different n-grams."""
    schema = ("block bigint, kind int, range int, counted binary, learned binary, "
              "n_counted bigint, n_learned bigint, v_counted bigint, v_learned bigint")

    def run(rows: pa.Table) -> pa.Table:
        kind, number = rows["kind"][0].as_py(), rows["range"][0].as_py()
        parts, blocks = rows["part"].to_pylist(), rows["block"].to_pylist()
        hashes = [np.cumsum(_wide(h.as_py())) for h in rows["hashes"]]
        counts = [_wide(c.as_py()).astype(np.int64) for c in rows["counts"]]
        _, place = np.unique(np.concatenate(hashes), return_inverse=True)
        ends = np.cumsum([len(h) for h in hashes])
        n = int(place.max()) + 1
        counted, learned = np.zeros(n, np.int64), np.zeros(n, np.int64)
        for part, c, end in zip(parts, counts, ends):
            at = place[end - len(c):end]  # different hashes within a block
            if part != HELD_OUT:
                learned[at] += c
            if part == COUNTED:
                counted[at] += c
        out = [(None, kind, number, None, None, int(counted.sum()), int(learned.sum()),
                int((counted > 0).sum()), int((learned > 0).sum()))]
        for block, part, h, end in zip(blocks, parts, hashes, ends):
            at = place[end - len(h):end]
            out.append((block, kind, number, _narrow(counted[at]) if part == DELETED else None,
                        _narrow(learned[at]), None, None, None, None))
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*out), _SUMS)], schema=_SUMS)

    return sent.groupBy("kind", "range").applyInArrow(run, schema)


def _estimates(docs: pa.Table, sums: pa.Table, column: str
               ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For some of a block's texts at a time: their token counts, and for each token the count of
    the word, its context's bucket, and the estimate from the pair."""
    tokens = list(_tokens(docs["text"]))
    known: dict[int, Counts] = {}
    for kind, (hashes, _) in _grams(tokens):
        mine = sums.filter(pa.compute.equal(sums["kind"], kind)).sort_by("range")
        known[kind] = hashes, np.concatenate([_wide(c.as_py()) for c in mine[column]]).astype(np.int64)

    def look(kind: int, values: np.ndarray) -> np.ndarray:
        hashes, counts = known[kind]
        return counts[np.searchsorted(hashes, values)]

    for hashes, sizes in tokens:
        before = _contexts(hashes, sizes)
        pair = look(PAIR, _pairs(before, hashes))
        # Every token but the end is a context as often as it occurs, and the begin mark as often
        # as there are ends.
        before[before == _BEGIN] = _END
        context = look(WORD, before)
        bucket = np.minimum(np.log2(context + 1).astype(np.int64), BUCKETS - 1)
        yield sizes, look(WORD, hashes), bucket, pair / np.maximum(context, 1)


def _cell(p: np.ndarray) -> np.ndarray:
    """The step of a probability on the logarithmic scale; the last one stands for zero."""
    with np.errstate(divide="ignore"):
        return np.minimum(np.round(-np.log2(p) * SCALE), STEPS - 1).astype(np.int64)


def _gathered(blocks: DataFrame, sums: DataFrame, total: int) -> DataFrame:
    """(cell, n): how many tokens of the deleted part have a bucket and two estimates."""
    def run(docs: pa.Table, mine: pa.Table) -> pa.Table:
        cells = [(bucket * STEPS + _cell(pair)) * STEPS + _cell(word / max(total, 1))
                 for _, word, bucket, pair in _estimates(docs, mine, "counted")]
        cell, n = _counted(cells)
        return pa.table({"cell": cell, "n": n})

    return blocks.where(F.col("part") == DELETED).groupBy("block").cogroup(
        sums.where("counted is not null").select("block", "kind", "range", "counted").groupBy("block")
    ).applyInArrow(run, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))


def weights(cells: np.ndarray, n: np.ndarray, vocabulary: int) -> np.ndarray:
    """Per bucket the weights of pair, word and nothing, by expectation-maximisation on counted
    cells. Each bucket starts from one count of the weights of all buckets together, so a bucket
    with few tokens stays near those, and none is ever zero."""
    back = lambda c: np.where(c == STEPS - 1, 0.0, 2.0 ** (-c / SCALE))
    bucket = cells // STEPS ** 2
    p = np.stack([back(cells // STEPS % STEPS), back(cells % STEPS),
                  np.full(len(cells), 1 / (vocabulary + 1))])
    shared = np.full(3, 1 / 3)
    out = np.tile(shared, (BUCKETS, 1))
    for _ in range(EM_ROUNDS):
        share = out[bucket].T * p
        share *= n / share.sum(axis=0)
        per = np.stack([np.bincount(bucket, s, BUCKETS) for s in share], axis=1)
        shared = (per.sum(axis=0) + 1) / (per.sum() + 3)
        out = (per + shared) / (per.sum(axis=1, keepdims=True) + 1)
    return out


def _scored(blocks: DataFrame, sums: DataFrame, id_type, mix: np.ndarray, total: int,
            vocabulary: int) -> DataFrame:
    schema = StructType().add("id", id_type).add("part", "integer")
    for name, kind in (("n_tokens", "long"), ("n_known", "long"), ("base_score", "double"), ("score", "double")):
        schema = schema.add(name, kind)

    def run(docs: pa.Table, mine: pa.Table) -> pa.Table:
        columns: list[list[np.ndarray]] = [[], [], [], []]
        for sizes, word, bucket, pair in _estimates(docs, mine, "learned"):
            m = mix[bucket]
            p = m[:, 0] * pair + m[:, 1] * (word / max(total, 1)) + m[:, 2] / (vocabulary + 1)
            at = np.cumsum(sizes) - sizes
            base = np.log10((word + 1) / (total + vocabulary + 1))
            for column, values in zip(columns, (
                    sizes, np.add.reduceat((word > 0).astype(np.int64), at),
                    np.add.reduceat(base, at), np.add.reduceat(np.log10(p), at))):
                column.append(values)
        n_tokens, n_known, base_score, score = map(np.concatenate, columns)
        return pa.table({"id": docs["id"], "part": docs["part"], "n_tokens": n_tokens,
                         "n_known": n_known, "base_score": base_score, "score": score})

    return blocks.groupBy("block").cogroup(
        sums.where("block is not null").select("block", "kind", "range", "learned").groupBy("block")
    ).applyInArrow(run, schema)


def lm_scores(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) for each row of ``docs``.

    Learns from the rows that are not held out (``part_of``). Tokens are words between ASCII
    white space, A-Z lower-cased, and an end; n_known counts those seen in training,
    train_tokens all of training. score is the model's log10 probability of the text; base_score
    that of the add-one unigram model. A null text counts as empty; a row with a null id is
    never held out. Repeated rows count and are scored each; rows of one id share a block, so
    ids are expected to repeat little. An empty table gives an empty result. Other columns are
    not read.
    """
    id_type = docs.schema[id_column].dataType
    frame = with_package(docs).select(F.col(id_column).alias("id"), F.col(text).alias("text"))
    size = frame.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n_blocks = int(size // BLOCK_BYTES) + 1
    # Few different words, but at most one pair for each token, of some six bytes.
    ranges = {WORD: int(size // 6 // 8 // RANGE_GRAMS) + 1, PAIR: int(size // 6 // RANGE_GRAMS) + 1}
    blocks = frame.withColumn("part", part_of("id")).withColumn(
        "block", F.pmod(F.xxhash64("id"), F.lit(n_blocks)) * 3 + F.col("part"))
    sums = stored(_summed(_sent(blocks, ranges)), "sums")
    t = sums.where("block is null").where(F.col("kind") == WORD).agg(
        *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in
          ("n_counted", "n_learned", "v_counted", "v_learned"))).first()
    cells = _gathered(blocks, sums, t.n_counted).toPandas()  # at most BUCKETS * STEPS**2
    mix = weights(cells["cell"].to_numpy(np.int64), cells["n"].to_numpy(np.float64), t.v_counted)
    scored = _scored(blocks, sums, id_type, mix, t.n_learned, t.v_learned)
    return scored.select(F.col("id").alias(id_column), (F.col("part") == HELD_OUT).alias("held_out"),
                         "n_tokens", "n_known", F.lit(t.n_learned).cast("bigint").alias("train_tokens"),
                         "base_score", "score")
