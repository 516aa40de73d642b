"""op13 against brute force."""

import heapq
import random
import re
import zlib
from hashlib import sha256

import xxhash
from pyspark.sql import functions as F

from barloom.llm import conversation_repair as cr
from barloom.llm.queries import QUERIES

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
NEXT = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}


def cheapest(rows):
    """Least (cost, audit) and the repaired rows, by search over (cost, audit)."""
    heap, seen = [(0, "", 0, 0, ())], set()
    while heap:
        cost, audit, k, state, out = heapq.heappop(heap)
        if k == len(rows) and state in (0, 3):
            return cost, audit, out
        if (k, state) in seen:
            continue
        seen.add((k, state))
        if k < len(rows):
            role, text, fault = rows[k]
            heapq.heappush(heap, (cost + 2, audit + "D", k + 1, state, out))
            if fault not in ("blank", "duplicate"):
                extra = 5 * (fault == "truncated")
                if role[:1] in NEXT[state]:
                    heapq.heappush(heap, (cost + extra, audit + "K", k + 1, NEXT[state][role[:1]], out + ((role, text),)))
                for other in ("user", "assistant"):
                    if other[0] in NEXT[state]:
                        heapq.heappush(heap, (cost + 1 + extra, audit + "R", k + 1, NEXT[state][other[0]], out + ((other, text),)))
        for other in ("user", "assistant"):
            if other[0] in NEXT[state]:
                heapq.heappush(heap, (cost + 5, audit + "I", k, NEXT[state][other[0]], out + ((other, ""),)))


def brute_damaged(data):
    out = []
    for conv, turn, role, text in data:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
        out += [(conv, turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def place(row):
    h = xxhash.xxh64_intdigest(row[3].encode(), 42)
    return row[1] is not None, row[1] or 0, row[2].encode(), h - (1 << 64) * (h >> 63)


def brute(original, data):
    report = []
    for conv in {r[0] for r in original}:
        mine = sorted((r for r in data if r[0] == conv), key=place)
        seen, rows = set(), []
        for _, _, role, text in mine:
            bare = text.strip(" \t\n\v\f\r")
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else \
                "truncated" if bare[-1] not in ".!?" else ""
            seen.add((role, text))
            rows.append((role, text, fault))
        initials = [r[0][:1] for r in rows]
        turns = [r[1] for r in mine if r[1] is not None]
        cost, audit, out = cheapest(rows)
        report.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
                       *(sum(r[2] == f for r in rows) for f in ("blank", "duplicate", "truncated")),
                       sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
                       sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()))
    return report


def order(found):
    return sorted(found, key=lambda r: (r[0] is not None, r[0] or 0, *r[1:]))


def conversations():
    rnd = random.Random(8)
    texts = ["Yes.", "No!", "Why?", "So", "  ", "", "\t.", "Well. \n", None, "x" * 3000 + "."]
    roles = ["user", "assistant", "system", "tool", "", None, "User", "ass", "u"]
    data = []
    for conv in [None, *range(60)]:
        for turn in range(rnd.randint(1, 9)):
            role = ("user", "assistant")[turn % 2] if rnd.random() < 0.6 else rnd.choice(roles)
            text = f"Text {turn}." if rnd.random() < 0.6 else rnd.choice(texts)
            data += [(conv, None if rnd.random() < 0.05 else turn * rnd.choice((1, 1, 1, 2)), role, text)] * (
                2 if rnd.random() < 0.1 else 1)
    for conv in (100, 101):  # longer than a sequence
        data += [(conv, k, rnd.choice(("user", "assistant")), f"Say {k % 50}" + rnd.choice(("", ".", ".")))
                 for k in range(300)]
    return data


def test_search_by_hand():
    assert cheapest([("user", "a", ""), ("assistant", "b", "")])[:2] == (0, "KK")
    assert cheapest([("user", "a", "")])[:2] == (2, "D")
    assert cheapest([("system", "a", ""), ("assistant", "b", "")])[:2] == (1, "RK")


def test_ropes():
    rnd = random.Random(1)
    made = [("", cr.Rope()), *((c, cr.Rope(c)) for c in "DIKR")]
    for _ in range(400):
        (a, x), (b, y) = rnd.choice(made), rnd.choice(made)
        if len(a) + len(b) < 300:
            made.append((a + b, x + y))
    assert all(str(r) == t and r.size == len(t) for t, r in made)
    for _ in range(3000):
        (a, x), (b, y) = rnd.choice(made), rnd.choice(made)
        assert (x < y) == (a < b)


def test_grammar():
    rnd = random.Random(2)
    chars = list(cr._CHARS.values())
    words = ["".join(rnd.choice(chars) for _ in range(4)) for _ in range(6)]
    told = ["".join(rnd.choice(words) for _ in range(rnd.randint(1, 6))) for _ in range(60)]
    rules, plain = [], cr.Grammar([])
    for _ in range(4):
        found = cr.pair_counts([cr.Grammar(rules).compressed(s) for s in told])
        rules += sorted((p for p, n in found.items() if n > 1), key=lambda p: (-found[p], p))[:5]
    grammar = cr.Grammar(rules)
    text = lambda m: {k: (c, str(e)) for k, (c, e) in m.items()}
    assert sum(len(grammar.compressed(s)) for s in told) < sum(map(len, told)) / 2
    for s in told:
        (a, x), (b, y) = grammar.evaluate(s), plain.evaluate(s)
        assert text(a) == text(b) and x == y


def test_repair(spark):
    data = conversations()
    docs = spark.createDataFrame(data, SCHEMA).selectExpr("*", "1 as ROW", "2 as conv", "3 as part").repartition(5)
    plain = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in data]
    for segment in (cr.SEGMENT, 7):
        report, turns = cr.repair(docs, segment=segment)
        got = [tuple(r) for r in report.collect()]
        want = brute(data, plain)
        assert order(got) == order(want)
    told = {}
    for r in turns.orderBy("place").collect():
        told.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    assert {r[0]: r[8] for r in want if r[0] in told} == {
        c: sha256("\n".join(x).encode()).hexdigest() for c, x in told.items()}
    empty, none = cr.repair(docs.where("false"))
    assert empty.count() == none.count() == 0


def test_learning(spark):
    frame = spark.createDataFrame([("abcabc",), ("abc",), ("zz",)], "sequence string")
    chars = list(cr._CHARS.values())
    frame = frame.withColumn("sequence", F.translate("sequence", "abcz", "".join(chars[:4])))
    rules = cr.learn_grammar(frame, rounds=3, rules=1)
    assert rules == [chars[0] + chars[1], cr.Grammar.char(0) + chars[2]]


def test_query(spark, tmp_path):
    data = conversations()
    data += [(k, 0, "user", "Gone.") for k in range(2000, 2040)]
    spark.createDataFrame(data, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    got = QUERIES["op13_conversation_repair"](spark, str(tmp_path))
    assert got.columns[0] == "conv_id"
    want = brute(data, brute_damaged(data))
    assert any(r[7] == "" for r in want)
    assert order(tuple(r) for r in got.collect()) == order(want)
