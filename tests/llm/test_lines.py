"""op3 against all pairs."""

import random
from contextlib import contextmanager

import xxhash

from barloom.llm import line_dedup as L
from barloom.llm.storage import stored, workspace
from tests.llm.data import frame, rows, split_white


def corpus():
    rnd = random.Random(9)
    vocabulary = [f"w{k}" for k in range(400)]
    base = [rnd.sample(vocabulary, rnd.randint(3, 30)) for _ in range(30)]
    docs = []
    for i in range(80):
        lines = []
        for _ in range(rnd.randint(1, 5)):
            line = list(rnd.choice(base)) if rnd.random() < 0.5 else rnd.sample(vocabulary, rnd.randint(1, 25))
            for _ in range(rnd.choice([0, 0, 1, 2])):
                line[rnd.randrange(len(line))] = rnd.choice(vocabulary)
            lines.append(" ".join(line).upper() if rnd.random() < 0.1 else " ".join(line))
        docs.append((i * 3 % 80, "\n".join(lines)))
    # Repeated ids with unlike and with equal texts, and rows without an id.
    return docs + [(100 + i, t) for i, t in rows() if i is not None and i not in (43, 44)] + [
        (None, docs[0][1]), (None, "no id here at all\nonly once"), (None, "no id here at all"), (300, "\n\n a \n"),
        (301, None), docs[7], (5, docs[7][1]), (5, "a wholly different line that stands alone")]


def place(i, text):
    h = xxhash.xxh64_intdigest(text.encode(), 42)
    return i is None, i or 0, h - (1 << 64) * (h >> 63)


def brute(docs):
    lines = sorted(((*place(i, text), k, set(split_white(t.lower()))) for i, text in set(docs) if text is not None
                    for k, t in enumerate(text.split("\n")) if split_white(t)), key=lambda r: r[:4])
    for n, (none, i, row, k, s) in enumerate(lines):
        if any(5 * len(s & r[4]) >= 4 * len(s | r[4]) for r in lines[:n]):
            yield None if none else i, row, k


def order(found):
    return sorted(found, key=lambda r: tuple((x is None, x or 0) for x in r))


def test_repeated_lines(spark, monkeypatch):
    docs = corpus()
    want = order(brute(docs))
    for pivots in (1, 12):
        monkeypatch.setattr(L, "PIVOTS", pivots)
        found = L.repeated_lines(frame(spark, docs)).collect()
        assert order((r.id, r.row, r.line) for r in found) == want
    texts = {(*place(i, text), k): set(split_white(t.lower())) for i, text in docs if text
             for k, t in enumerate(text.split("\n"))}
    for r in found:
        x, y = ((i is None, i or 0, row, k) for i, row, k in ((r.id, r.row, r.line), (r.of_id, r.of_row, r.of_line)))
        a, b = texts[x], texts[y]
        assert y < x
        assert abs(r.jaccard - len(a & b) / len(a | b)) < 1e-9 and r.jaccard >= 0.8


def test_texts_without_repeats(spark):
    docs = corpus()
    gone = set(brute(docs))
    out = L.without_repeats(frame(spark, docs))
    assert out.columns == frame(spark, docs).columns
    seen, want = set(), []
    for i, t in docs:
        again = (i, t) in seen
        seen.add((i, t))
        want.append((i, t if t is None else "\n".join(
            x for k, x in enumerate(t.split("\n")) if not split_white(x) or not (
                again or (i, place(i, t)[2], k) in gone))))
    assert (5, "a wholly different line that stands alone") in want
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or "")
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=key) == sorted(want, key=key)
    assert L.without_repeats(frame(spark, docs).where("false")).count() == 0


def test_large_group_of_similar_lines(spark):
    rnd = random.Random(4)
    words = [f"v{k}" for k in range(30)]
    docs = []
    for i in range(300):
        line = list(words)
        for _ in range(rnd.randint(0, 3)):
            line[rnd.randrange(30)] = f"x{rnd.randrange(10 ** 6)}"
        docs.append((i, " ".join(line)))
    found = {(r.id, r.row, r.line) for r in L.repeated_lines(frame(spark, docs)).collect()}
    assert found == set(brute(docs))


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(1, "a b c d"), (2, "a b c d")], "doc_id bigint, text string")
    seen = []

    def put(df, label):
        seen.append(df._jdf.queryExecution().toString())
        return stored(df, label)

    L._repeated(docs, "doc_id", "text", put).collect()
    assert len(seen) > 5 and not any(x in plan for plan in seen for x in ("Python", "Arrow", "Pandas"))


def test_long_lines_and_repeated_rows(spark):
    docs = [r for r in rows() if r[0] in (43, 44, 47)]
    assert {(r.id, r.line) for r in L.repeated_lines(frame(spark, docs)).collect()} == {(44, 0)}


def test_short_lines_that_differ_in_few_words(spark, monkeypatch):
    rnd = random.Random(12)
    vocabulary = [rnd.choice("abcdefgh") * rnd.randint(1, 4) + str(k) for k in range(60)]
    docs = []
    for i in range(120):
        line = rnd.sample(vocabulary, rnd.randint(4, 16))
        lines = [line]
        for _ in range(2):
            other = list(line)
            for _ in range(rnd.randint(1, 3)):
                if rnd.random() < 0.5 and len(other) > 4:
                    other.pop(rnd.randrange(len(other)))
                else:
                    other.append(rnd.choice(vocabulary))
            rnd.shuffle(other)
            lines.append(other)
        docs.append((i, "\n".join(map(" ".join, lines))))
    want = set(brute(docs))
    assert len(want) > 50
    for more, pivots in ((0, 1), (5, 16)):
        monkeypatch.setattr(L, "MORE", more)
        monkeypatch.setattr(L, "PIVOTS", pivots)
        assert {(r.id, r.row, r.line) for r in L.repeated_lines(frame(spark, docs), of=False).collect()} == want


def test_tables_of_lines_are_gone_before_pairs_are_compared(spark, monkeypatch):
    seen = []

    def noted(put):
        def run(df, label):
            seen.append((label, df._jdf.queryExecution().toString()))
            return put(df, label)
        return run

    @contextmanager
    def watched():
        with workspace() as put:
            yield noted(put)
        seen.append(("emptied", ""))

    monkeypatch.setattr(L, "workspace", watched)
    docs = spark.createDataFrame([(1, "a b c d"), (2, "a b c d")], "doc_id bigint, text string")
    L._repeated(docs, "doc_id", "text", noted(stored)).collect()
    labels = [label for label, _ in seen]
    assert labels.index("lines") < labels.index("met") < labels.index("emptied") < labels.index("pairs")
    assert not any(x in plan for _, plan in seen for x in ("Python", "Arrow", "Pandas"))


def test_unlike_lines_of_the_same_words_seldom_meet(spark):
    rnd = random.Random(21)
    vocabulary = ["abcdefghij"[k % 10] * (2 + k % 5) + str(k) for k in range(600)]
    docs = [(i, " ".join(rnd.sample(vocabulary, 30))) for i in range(400)]
    met = []

    def noted(df, label):
        table = stored(df, label)
        if label == "met":
            met.append(table.count())
        return table

    assert L._repeated(frame(spark, docs), "doc_id", "text", noted).count() == 0
    assert sum(met) < 400  # in a simulation 92; 2,060 with couples of neighbours


def test_texts_are_merged_with_their_lists_of_lines(spark):
    plan = L.without_repeats(frame(spark, [(1, "a b c d\ne f g h"), (2, "a b c d")]))._jdf.queryExecution().toString()
    joins = [x for x in plan.splitlines() if "LeftOuter" in x and ("SortMergeJoin" in x or "BroadcastHashJoin" in x)]
    assert joins and all("SortMergeJoin" in x for x in joins)
