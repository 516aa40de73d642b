"""op4 against a plain model, and op2 by held-out accuracy."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from barloom.llm import interpolation as I
from barloom.llm import toxicity as T
from tests.llm.data import frame, lower, rows


def tokens(text):
    return lower(text).encode().split() + [b""]


def part(i):
    rest = -1 if i is None else zlib.crc32(str(i).encode()) % 7
    return I.HELD_OUT if rest == 2 else I.DELETED if rest == 6 else I.COUNTED


def count(docs):
    word, pair = Counter(), Counter()
    for _, t in docs:
        w = tokens(t)
        word.update(w)
        pair.update(zip([None] + w, w))
    return word, pair


def brute(docs):
    """Plain counts, and the weights by the operator's own rule from the cells."""
    word, pair = count([d for d in docs if part(d[0]) == I.COUNTED])
    total, kinds = sum(word.values()), len(word)
    bucket = lambda c: min(int(math.log2(c + 1)), I.BUCKETS - 1)
    cells = Counter()
    for i, t in docs:
        if part(i) == I.DELETED:
            w = tokens(t)
            for v, x in zip([None] + w, w):
                c = word[b"" if v is None else v]
                p = np.array([pair[v, x] / max(c, 1), word[x] / max(total, 1)])
                a, b = I._cell(p)
                cells[(bucket(c) * I.STEPS + int(a)) * I.STEPS + int(b)] += 1
    mix = I.weights(np.array(list(cells), np.int64), np.array(list(cells.values()), float), kinds)
    word, pair = count([d for d in docs if part(d[0]) != I.HELD_OUT])
    total, kinds = sum(word.values()), len(word)
    for i, t in docs:
        w, score = tokens(t), 0.0
        for v, x in zip([None] + w, w):
            c = word[b"" if v is None else v]
            m = mix[bucket(c)]
            score += math.log10(m[0] * pair[v, x] / max(c, 1) + m[1] * word[x] / max(total, 1) + m[2] / (kinds + 1))
        yield (str(i), part(i) == I.HELD_OUT, len(w), sum(word[x] > 0 for x in w), total,
               sum(math.log10((word[x] + 1) / (total + kinds + 1)) for x in w), score)


@pytest.mark.parametrize("block_bytes", [12_000_000, 2_000])
def test_scores(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(I, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(I, "RANGE_GRAMS", block_bytes // 6)
    monkeypatch.setattr(I, "_CHARS_AT_ONCE", block_bytes // 12)
    docs = rows()
    got = sorted((str(r.doc_id), *r[1:]) for r in I.lm_scores(frame(spark, docs)).collect())
    want = sorted(brute(docs))
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert all(g[5:] == pytest.approx(w[5:], rel=1e-9) for g, w in zip(got, want))


def test_empty_corpus(spark):
    assert I.lm_scores(frame(spark).where("false")).count() == 0


def test_probabilities_sum_to_one():
    """Over all seen words and one for all unseen."""
    docs = [d for d in rows() if d[0] is None or d[0] < 40]
    word, pair = count(docs)
    total = sum(word.values())
    m = I.weights(np.array([5 * I.STEPS ** 2]), np.array([9.0]), len(word))[5]
    some = word.most_common(3)[1][0]
    p = sum(m[0] * pair[some, x] / word[some] + m[1] * word[x] / total + m[2] / (len(word) + 1) for x in word)
    assert p + m[2] / (len(word) + 1) == pytest.approx(1)
    assert m.sum() == pytest.approx(1) and (m > 0).all()


def labelled(n, seed):
    rnd = random.Random(seed)
    bad = sorted(w.decode() for lexicon in T.CATEGORIES.values() for w in lexicon)[::2] + ["newslur"]
    docs, labels = [], []
    for i in range(n):
        words = [f"w{rnd.randrange(300)}" for _ in range(rnd.randint(5, 80))]
        toxic = rnd.random() < 0.2
        for _ in range(rnd.randint(1, 4) if toxic else 0):
            words[rnd.randrange(len(words))] = rnd.choice(bad).title() + rnd.choice([".", "", "!"])
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return docs, labels


def test_toxicity_on_held_out_rows(spark):
    docs, labels = labelled(1500, 1)
    table = spark.createDataFrame(labels[:1000] + [(None, 1), (1499, None), (10_000, 1)], "doc_id bigint, toxic int")
    frame_ = frame(spark, docs + [(1700, None), (1701, ""), (None, "moron")])
    chain = T.learn_toxicity(frame_, table)
    got = {r.doc_id: r for r in T.score_toxicity(frame_, chain).collect()}
    right = [got[i].is_toxic == bool(y) for i, y in labels[1000:]]
    assert sum(right) / len(right) > 0.96
    assert not got[1700].is_toxic and not got[1701].is_toxic
    assert any(w == b"newslur" for w in chain.models[-1].words)
    assert len(chain.models[-1].earlier) == len(T.CATEGORIES) - 1
    assert T.score_toxicity(frame_.where("false"), chain).count() == 0


def test_out_of_fold_probabilities_leave_their_fold_out():
    """A word seen in one fold only tells nothing there."""
    import pyarrow as pa

    words = [[b"once"] if k == 0 else [b"c%d" % (k % 5)] for k in range(60)]
    toxic = np.array([1] + [k % 2 for k in range(1, 60)])
    fold = np.arange(60) % T.FOLDS
    _, held = T.fit_chain(pa.array(words, pa.list_(pa.binary())), toxic, fold)
    assert held.shape == (60, len(T.CATEGORIES)) and held[0, -1] < 0.6


def test_no_labels(spark):
    docs = frame(spark)
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    chain = T.learn_toxicity(docs, none)
    assert T.score_toxicity(docs, chain).where("is_toxic").count() == 0
    zeros = spark.createDataFrame([(k, 0) for k in range(30)], "doc_id bigint, toxic int")
    assert T.score_toxicity(docs, T.learn_toxicity(docs, zeros)).where("is_toxic").count() == 0


def test_words_of_training_rows_are_not_broadcast(spark):
    docs = frame(spark, [(k, f"word{k % 3} other text") for k in range(12)])
    labels = spark.createDataFrame([(k, k % 2) for k in range(12)], "doc_id bigint, toxic int")
    plan = T.training_rows(docs, labels)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan and "Join Inner" not in plan
