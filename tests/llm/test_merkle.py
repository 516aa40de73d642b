"""op11 against brute force."""

import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from barloom.llm.merkle import folded, leaf_digest, manifest, proof_digest
from barloom.llm.queries import QUERIES
from tests.llm.data import lower, rows

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def grown(hashes, arity):
    """The root, and for each leaf its path as pairs of texts."""
    paths, at, level = [[] for _ in hashes], list(range(len(hashes))), list(hashes)
    while len(level) > 1:
        for k, i in enumerate(at):
            first = i // arity * arity
            paths[k].append(("".join(level[first:i]), "".join(level[i + 1:first + arity])))
        at = [i // arity for i in at]
        level = [h(*level[i:i + arity]) for i in range(0, len(level), arity)]
    return level[0], paths


def brute(data, arity):
    groups = {}
    for row in data:
        groups.setdefault(row[1], []).append(row)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees, out = [], []
    for name in names:
        groups[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees.append(grown([leaf(r) for r in groups[name]], arity))
    root, above = grown([t[0] for t in trees], arity)
    for name, (subroot, paths), upper in zip(names, trees, above):
        for row, path in zip(groups[name], paths):
            path = path + upper
            changed = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[4] is not None
            fold = leaf((*row[:4], lower(row[4]))) if changed else leaf(row)
            for left, right in path:
                fold = h(left, fold, right)
            out.append((row[0], leaf(row), subroot, root, h(*(a + b for a, b in path)), fold, fold == root))
    return out


def awkward():
    sources = [None, "", "-", "=", "web", "web2", "Ä", "zz"]
    data = [(i, sources[(k * k) % 7], "en" if k % 3 else None, k if k % 4 else None, t) for k, (i, t) in enumerate(rows())]
    data += [(1000 + k, "hot", "de", k, f"Text {k % 9}") for k in range(300)] + [(77, "hot", "x", 1, "Same")] * 20
    return data + [(None, "hot", None, None, None)] * 3 + [(5000, "zz", "a", 1, "Alone")]


SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def order(found):
    return sorted(found, key=lambda r: (r[0] is not None, r[0] or 0, *map(str, r[1:])))


@pytest.mark.parametrize("arity", [2, 3, 16])
def test_manifest(spark, arity):
    data = awkward()
    docs = spark.createDataFrame(data, SCHEMA).selectExpr("*", "1 as IDX", "2 as tree", "3 as hash", "4 as path").repartition(3)
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    bad = F.when(changed, leaf_digest(*FIELDS[:0], *(lowered if f == "text" else F.col(f) for f in FIELDS)))
    got = manifest(docs, FIELDS, carry={"bad": bad}, arity=arity).select(
        "id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof"),
        folded(F.coalesce("bad", "leaf"), F.col("path")).alias("fold"))
    got = [(*r, r.fold == r.root) for r in got.collect()]
    assert order(got) == order(brute(data, arity))


def test_small(spark):
    for data in ([], [(1, None, None, None, None)], [(k, "s", "l", 1, "T") for k in range(17)],
                 [(k, f"s{k}", "l", 1, "T") for k in range(17)]):
        got = manifest(spark.createDataFrame(data, SCHEMA), FIELDS)
        assert got.columns == ["id", "leaf", "path", "subroot", "root"]
        assert sorted((r.id, r.subroot, r.root) for r in got.collect()) == sorted(
            (b[0], b[2], b[3]) for b in (brute(data, 16) if data else []))
    with pytest.raises(ValueError):
        manifest(spark.createDataFrame([], SCHEMA), FIELDS, arity=1)


def test_query(spark, tmp_path):
    data = awkward()
    spark.createDataFrame(data, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op11_merkle"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert order(tuple(r) for r in got.collect()) == order(brute(data, 16))
