"""Near-duplicate documents by SimHash, with candidates cut down by the pigeonring principle.

Two fingerprints that differ in at most t bits are cut, as a ring, into t + 1 segments. Some
segment then starts a chain in which the first l segments together differ in at most l - 1
bits, for every l up to the whole ring. The first two links of the chain are the join key (one
segment equal, the next with at most one bit left open); the longer ones are tested on each
pair that shares a key, before the full Hamming distance.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.columns import add_columns
from barloom.llm.components import components
from barloom.llm.storage import stored, workspace

BITS = 64
WORDS = 5
#: Differing bits that two linked fingerprints may have: a similarity of 61/64.
DISTANCE = 3
SEED = 42
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_HASHES_AT_ONCE = 1 << 16


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """A bit is 1 if it is set in over half of the shingles' hashes; 0 without a word."""
    found = (text or "").encode().translate(_LOWER).split()
    if not found:
        return 0
    n = max(1, len(found) - words + 1)
    shingles = map(b" ".join, zip(*(found[k:k + n] for k in range(words)))) \
        if len(found) >= words else [b" ".join(found)]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, SEED) for s in shingles), dtype="<u8", count=n)
    ones = np.zeros(BITS, dtype=np.int64)
    for start in range(0, n, _HASHES_AT_ONCE):
        part = hashes[start:start + _HASHES_AT_ONCE].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", words: int = WORDS,
                 keep: list[str] | None = None) -> DataFrame:
    """Each row with its fingerprint as a signed 64-bit integer."""
    def make():
        def compute(texts):
            for t in texts:
                f = fingerprint(t, words)
                yield (f - (1 << BITS) if f >= 1 << BITS - 1 else f,)
        return compute

    return add_columns(docs, text, "fingerprint bigint", make, keep)


def _segments(distance: int) -> list[tuple[int, int]]:
    """(first bit, length) of each segment of the ring."""
    m = distance + 1
    cuts = [BITS * k // m for k in range(m + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _mask(parts: list[tuple[int, int]]) -> int:
    bits = 0
    for first, length in parts:
        bits |= (1 << length) - 1 << first
    return bits


def _signed(bits: int) -> int:
    return bits - (1 << BITS) if bits >> BITS - 1 else bits


def linked_pairs(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(a, b), a < b, for all values of the column ``fingerprint`` of ``prints`` (distinct, not
    null) that differ in at most ``distance`` bits."""
    spark = prints.sparkSession
    if distance < 1:
        return spark.createDataFrame([], "a bigint, b bigint")
    ring = _segments(distance)
    m = len(ring)
    # (start, open bit or -1, mask of the compared bits)
    keys = []
    for k in range(m):
        whole = _mask([ring[k], ring[(k + 1) % m]])
        first, length = ring[(k + 1) % m]
        keys += [(k, -1, whole)] + [(k, bit, whole & ~(1 << bit)) for bit in range(first, first + length)]
    kinds = F.array(*(F.struct(F.lit(k * 100 + bit).alias("kind"), F.lit(_signed(mask)).alias("mask"))
                      for k, bit, mask in keys))
    keyed = prints.select("fingerprint", F.explode(kinds).alias("k")).select(
        F.col("fingerprint").alias("a"), "k.kind",
        F.col("fingerprint").bitwiseAND(F.col("k.mask")).alias("key"))
    other = keyed.withColumnRenamed("a", "b")
    differ = F.col("a").bitwiseXOR(F.col("b"))
    chain: Column = F.bit_count(differ) <= distance
    start = F.floor((F.col("kind") + 1) / 100)
    for k in range(m):
        for links in range(3, m):
            bits = _mask([ring[(k + j) % m] for j in range(links)])
            within = F.bit_count(differ.bitwiseAND(F.lit(_signed(bits)))) <= links - 1
            chain = ((start != k) | within) & chain
    # With a bit left open, only pairs that do differ there: the others share the whole key.
    opened = F.pmod(F.col("kind") + 1, F.lit(100)) - 1
    open_differs = (opened < 0) | (F.getbit(differ, F.greatest(opened, F.lit(0))) == 1)
    # Merged: Spark takes a frame to be as small after the explode as before it, and would broadcast
    # a table of a few MB that has grown by the number of keys.
    return keyed.join(other.hint("merge"), ["kind", "key"]).where(
        (F.col("a") < F.col("b")) & open_differs & chain).select("a", "b").distinct()


def _components(table: DataFrame, distance: int, put) -> DataFrame:
    """(fingerprint, root, component_id) for the fingerprints of ``table`` (id, fingerprint)."""
    nodes = put(table.groupBy("fingerprint").agg(F.min("id").alias("least")), "nodes")
    roots = put(components(linked_pairs(nodes, distance), put), "roots")
    rooted = put(nodes.join(roots, nodes.fingerprint == roots.node, "left").select(
        "fingerprint", "least", F.coalesce("root", "fingerprint").alias("root")), "rooted")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return stored(rooted.join(least, "root").select("fingerprint", "root", "component_id"), "components")


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text",
                    words: int = WORDS, distance: int = DISTANCE) -> DataFrame:
    """(id, fingerprint as 16 hexadecimal digits, component_id) for each row of ``docs``.

    Rows are linked if their fingerprints differ in at most ``distance`` bits; component_id is
    the smallest id reachable over links. Without a word a text has fingerprint zero and is
    linked like any other, and so is a null text. Rows with a null id are linked as others are;
    a component of such rows only has a null component_id. Repeated rows each give a row. An
    empty table gives an empty result; other columns are not read. Copies of a fingerprint are
    one node of the graph, so a group of any size costs one row in the joins.
    """
    with workspace() as put:
        table = stored(fingerprints(docs.select(F.col(id_column).alias("id"), F.col(text).alias("text")),
                                    words=words, keep=["id"]), "fingerprints")
        named = _components(table, distance, put)
    return table.join(named, "fingerprint").select(
        F.col("id").alias(id_column), F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"),
        "component_id")


def one_of_each(docs: DataFrame, id_column: str = "doc_id", text: str = "text",
                words: int = WORDS, distance: int = DISTANCE) -> DataFrame:
    """The rows of ``docs`` that stay: one of each component, that with the smallest id (null
    last); of rows with one id the first by a hash of the text, then of all columns. A component
    of rows without an id keeps one of them, too.
    """
    hashed = F.sha2(F.coalesce(text, F.lit("")), 256)  # null and empty texts are alike here
    keyed = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"), hashed.alias("hash"))
    with workspace() as put:
        table = put(fingerprints(keyed, words=words, keep=["id", "hash"]), "fingerprints")
        named = _components(table, distance, put)
        kept = stored(table.join(named, "fingerprint").groupBy("root").agg(
            F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "hash")).alias("first")).select(
            F.col("first.id").alias("__id"), F.col("first.hash").alias("__hash")), "kept")
    same = F.col(id_column).eqNullSafe(F.col("__id")) & (F.col("__text") == F.col("__hash"))
    found = docs.withColumn("__text", hashed).join(kept, same, "left_semi")
    order = Window.partitionBy(id_column, "__text").orderBy(F.xxhash64(*docs.columns), text)
    return found.withColumn("__first", F.row_number().over(order)).where("__first = 1").select(docs.columns)
