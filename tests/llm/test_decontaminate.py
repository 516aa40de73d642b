"""op7 against a plain search."""

import random
import re

from barloom.llm import decontaminate as D
from barloom.llm.storage import stored
from tests.llm.data import frame, lower, rows

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(docs, items, window):
    tests = {}
    for i, t in items:
        w = WORD.findall(lower(t))
        for k in range(max(1, len(w) - window + 1) if w else 0):
            tests.setdefault(tuple(w[k:k + window]), set()).update([str(i)] * (i is not None))
    for i, t in docs:
        w, hit, found = WORD.findall(lower(t)), set(), set()
        for n in {len(x) for x in tests}:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in tests:
                    hit.update(range(k, k + n))
                    found |= tests[tuple(w[k:k + n])]
        yield (str(i), len(w), len(hit), ",".join(sorted(found)), bool(hit))


def tables(spark):
    rnd = random.Random(1)
    item = lambda n: " ".join(rnd.choice("ab cd, EF gh ij k1 lm-no".split()) for _ in range(n))
    items = [(k, item(rnd.randint(1, 25))) for k in range(20)] + [
        (20, None), (21, ""), (22, "!?"), (23, "Über Straße"), (None, "ab cd ef gh"), (24, "w3x3 w4x4"), (None, "no name on")]
    items += [items[3], (25, items[4][1])]
    docs = rows() + [(100 + k, item(60) + ". " + (items[k % 20][1] or "")) for k in range(40)] + [
        (150, "über. STRAßE"), (151, "ÜBER straße"), (152, "ab"), (153, "No name on this one")]
    extra = spark.createDataFrame(items, "item_id bigint, text string").selectExpr("*", "1 as segment", "2 as term")
    return docs, items, extra


def seen(found):
    return sorted((str(r.doc_id), r.n_words, r.n_hit, ",".join(r["items"]), r.contaminated)
                  for r in found.collect())


def test_matches(spark, monkeypatch):
    docs, items, extra = tables(spark)
    for window in (3, 10):
        assert seen(D.contamination(frame(spark, docs), extra, window=window)) == sorted(brute(docs, items, window))
    # Several segments per task and several blocks of phrases give the same.
    monkeypatch.setattr(D, "BLOCK_BYTES", 4000)
    monkeypatch.setattr(D, "SEGMENT_WORDS", 500)
    assert seen(D.contamination(frame(spark, docs), extra, window=3)) == sorted(brute(docs, items, 3))


def test_empty_tables(spark):
    docs, _, items = tables(spark)
    assert D.contamination(frame(spark, docs).where("false"), items).count() == 0
    got = D.contamination(frame(spark, docs), items.where("false"))
    assert got.count() == len(docs) and got.where("contaminated").count() == 0


def test_near_matches(spark):
    docs = frame(spark, [(1, "x a b c d y"), (2, "x a b q c d"), (3, "a b c"), (4, "d c b a"), (5, "a b"), (6, "c d")])
    items = spark.createDataFrame([("i", "a b c d")], "item_id string, text string")
    got = {r.doc_id: (r["items"], r.near_items) for r in D.contamination(docs, items, slop=1).collect()}
    assert got == {1: (["i"], []), 2: ([], ["i"]), 3: ([], []), 4: ([], []), 5: ([], []), 6: ([], [])}


def test_postings_are_stored_whole(spark):
    docs = frame(spark, [(1, "b a b " + "z " * 400 + "b"), (2, "b")])
    index = stored(D.build_index(docs.coalesce(1), "doc_id"), "index")
    row = index.where("term = binary('b')").first()
    places = D._places(row.first, row.width, bytes(row.steps)).tolist()
    assert row.n == len(places) == 4 and places[1] - places[0] == 2
    assert index.where("term is null").count() == 2


def test_filter_keeps_the_rest(spark):
    docs, items, extra = tables(spark)
    docs = docs + [(None, items[0][1])]
    kept = D.decontaminated(frame(spark, docs), extra)
    want = sorted(i for (i, *_, hit) in brute(docs, items, 10) if not hit)
    assert sorted(str(r.doc_id) for r in kept.collect()) == want and kept.columns == frame(spark, docs).columns
