"""op10 against brute force."""

import random

import xxhash
from pyspark.sql import functions as F

from barloom.llm.components import components
from barloom.llm.simhash import fingerprint, linked_pairs, near_duplicates, one_of_each
from tests.llm.data import frame, lower, rows, split_white


def brute_print(text, words):
    w = split_white(lower(text))
    shingles = [" ".join(w[k:k + words]) for k in range(max(1, len(w) - words + 1))] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_pairs_and_components(spark):
    rnd = random.Random(3)
    for distance in (1, 3, 4):
        values = {0, 1, signed(2 ** 64 - 1)}
        for _ in range(30):
            base = rnd.getrandbits(64)
            for _ in range(8):
                flips = rnd.sample(range(64), rnd.randint(0, distance + 2))
                values.add(signed(base ^ sum(1 << k for k in flips)))
        want = {(a, b) for a in values for b in values
                if a < b and ((a ^ b) & (2 ** 64 - 1)).bit_count() <= distance}
        prints = spark.createDataFrame([(v,) for v in values], "fingerprint bigint")
        assert {tuple(r) for r in linked_pairs(prints, distance).collect()} == want
    linked = {n for pair in want for n in pair}
    links = spark.createDataFrame(sorted(want), "a bigint, b bigint")
    assert {r.node: r.root for r in components(links).collect()} == roots(linked, want)
    assert linked_pairs(prints, 0).count() == 0


def test_long_chain_hub_and_no_links(spark):
    chain = [(k, k + 1) for k in range(60)] + [(100, k) for k in range(101, 140)] + [(7, 7), (None, 3)]
    got = {r.node: r.root for r in components(spark.createDataFrame(chain, "a bigint, b bigint")).collect()}
    assert got == {k: 0 for k in range(61)} | {k: 100 for k in range(100, 140)}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_documents(spark):
    data = rows()
    prints = [brute_print(t, 3) for _, t in data]
    assert prints == [fingerprint(t, 3) for _, t in data]
    links = [(a, b) for b in range(len(data)) for a in range(b) if (prints[a] ^ prints[b]).bit_count() <= 3]
    root = roots(range(len(data)), links)
    least = {}
    for k, (i, _) in enumerate(data):
        if i is not None:
            least[root[k]] = min(i, least.get(root[k], i))
    got = sorted((r.doc_id is None, r.doc_id or 0, r.fingerprint, r.component_id or -1)
                 for r in near_duplicates(frame(spark), words=3).collect())
    assert got == sorted((i is None, i or 0, f"{p:016x}", least.get(root[k], None) or (-1 if root[k] not in least
                         or least[root[k]] == 0 else 0)) for k, ((i, _), p) in enumerate(zip(data, prints)))
    assert near_duplicates(frame(spark).where("false")).count() == 0


def test_one_of_each_stays(spark):
    text = " ".join(f"w{k}" for k in range(400))
    near = text.replace("w200 ", "v ")
    other = " ".join(f"u{k}" for k in range(400))
    data = [(5, text), (3, near), (9, text), (3, near), (7, other), (None, text), (11, ""), (12, None)]
    kept = one_of_each(frame(spark, data))
    assert kept.columns == frame(spark, data).columns
    assert sorted(((r.doc_id or -1), r.text or "") for r in kept.collect()) == sorted(
        [(3, near), (7, other), (11, "")])
    alone = one_of_each(frame(spark, [(None, text), (None, near), (None, other)]), words=3)
    assert sorted(r.text for r in alone.collect()) in (sorted([text, other]), sorted([near, other]))


def test_keys_of_a_small_table_are_not_broadcast(spark):
    prints = spark.range(1000).select((F.xxhash64("id")).alias("fingerprint"))
    plan = linked_pairs(prints)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
