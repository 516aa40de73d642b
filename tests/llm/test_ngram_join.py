"""op12 against brute force."""

import random

import pyarrow as pa
import pytest

from barloom.llm import ngram_join as nj
from barloom.llm import storage
from barloom.llm.queries import QUERIES
from tests.llm.data import frame, lower, rows, split_white
from tests.llm.test_simhash import roots


def brute_set(text, words):
    w = split_white(lower(text))
    return {" ".join(w[k:k + words]) for k in range(max(1, len(w) - words + 1))} if w else set()


def brute(data, words=4, similar=85, of=100):
    sets = [brute_set(t, words) for _, t in data]
    links = [(a, b) for b in range(len(data)) for a in range(b)
             if sets[a] and sets[b] and of * len(sets[a] & sets[b]) >= similar * len(sets[a] | sets[b])]
    root, least = roots(range(len(data)), links), {}
    for k, (i, _) in enumerate(data):
        if i is not None:
            least[root[k]] = min(i, least.get(root[k], i))
    return [(i, len(s), least.get(root[k]) if s else i) for k, ((i, _), s) in enumerate(zip(data, sets))]


def order(found):
    return sorted(found, key=lambda r: tuple((x is not None, x or 0) for x in r))


def family(rnd, name, n, length, edits):
    """Copies of one text, each with up to so many words replaced."""
    base = [f"{name}{k}" for k in range(length)]
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(rnd.randint(0, edits)):
            words[rnd.randrange(length)] = f"e{rnd.randrange(10 ** 6)}"
        out.append(" ".join(words))
    return out


def data_of():
    rnd = random.Random(6)
    texts = [t for name, n, length, edits in (
        ("a", 120, 90, 3), ("b", 60, 40, 2), ("c", 40, 200, 9), ("d", 25, 12, 1), ("f", 5, 300, 4))
        for t in family(rnd, name, n, length, edits)]
    common = " ".join(f"z{k}" for k in range(40))
    texts += [common + " " + " ".join(f"q{rnd.randrange(10 ** 6)}" for _ in range(rnd.choice((3, 5, 8, 40)))) for _ in range(50)]
    texts += [texts[3]] * 30 + [texts[4].upper()] * 3 + ["a b", "A  b", "a b c", "a b c d", "a b c d e"]
    return rows() + list(enumerate(texts, 1000)) + [(None, texts[9])]


def test_shingles():
    for _, t in data_of():
        assert len(nj.shingles(t)) == len(brute_set(t, 4))


@pytest.mark.parametrize("pivots, partners, depth", [(4, 32, 4), (2, 1, 3), (3, 2, 0)])
def test_components(spark, monkeypatch, pivots, partners, depth):
    monkeypatch.setattr(nj, "PIVOTS", pivots)
    monkeypatch.setattr(nj, "PARTNERS", partners)
    monkeypatch.setattr(nj, "DEPTH", depth)
    data = data_of()
    got = nj.similar_documents(frame(spark, data)).select("doc_id", "n_shingles", "component_id")
    assert order(tuple(r) for r in got.collect()) == order(brute(data))


def test_other_parameters_and_regions_apart(spark, monkeypatch):
    """Families that share a tail, in an order that does not put it last, and a radius so small
    that regions of the tail are cut by family."""
    monkeypatch.setattr(nj, "PARTNERS", 1)
    monkeypatch.setattr(nj, "_steps", lambda counted: bytes(1 << nj.SKETCH_BITS))
    cuts, cut = [], nj._cut

    def spied(rows, *rest):
        out = cut(rows, *rest)
        cuts.append(out.join(rows.select("g"), "g", "left_anti").where("visits > 0 or d < 0.5").count())
        return out

    monkeypatch.setattr(nj, "_cut", spied)
    rnd = random.Random(9)
    tail = [f"t{k}" for k in range(30)]
    texts = []
    for f in range(12):
        own = [f"o{f}_{k}" for k in range(100)]
        for _ in range(12):
            words = own + tail
            words[rnd.randrange(100)] = f"e{rnd.randrange(10 ** 6)}"
            texts.append(" ".join(words))
    data = list(enumerate(texts))
    got = nj.similar_documents(frame(spark, data), words=1, similar=98, of=100)
    assert order(tuple(r) for r in got.select("doc_id", "n_shingles", "component_id").collect()) == order(brute(data, 1, 98))
    assert cuts[0] > 0
    assert nj.similar_documents(frame(spark).where("false")).count() == 0


def test_query(spark, tmp_path):
    data = data_of()
    frame(spark, data).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op12_ngram_join"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert order(tuple(r) for r in got.collect()) == order(brute(data))


def test_one_worker_and_few_rows_at_a_time(spark, monkeypatch):
    """No task runs two Python functions behind each other, and Python gets few rows at once."""
    sums, batches, added_up, write = [], [], nj._added_up, storage._write

    def spied(*args):
        sums.append(added_up(*args))
        return sums[-1]

    def written(df, *rest):
        path, table = write(df, *rest)
        if df.columns == ["rows"]:
            batches.extend(r.rows for r in table.collect())
        return path, table

    monkeypatch.setattr(nj, "_added_up", spied)
    nj.similar_documents(frame(spark, rows())).count()
    assert [s._jdf.queryExecution().executedPlan().toString().count("FlatMapGroupsInArrow") for s in sums] == [1, 1]

    monkeypatch.setattr(storage, "_write", written)
    before = spark.conf.get(storage.ARROW_ROWS, None)
    with storage.workspace(nj.ARROW_ROWS) as put:
        put(spark.range(0, 3 * nj.ARROW_ROWS, 1, 1).mapInArrow(
            lambda found: (pa.RecordBatch.from_arrays([pa.array([b.num_rows])], names=["rows"]) for b in found),
            "rows bigint"), "sizes")
    assert batches == [nj.ARROW_ROWS] * 3
    assert spark.conf.get(storage.ARROW_ROWS, None) == before


def test_few_distances_in_regions_of_unlike_documents(spark, monkeypatch):
    """A line in documents of many sizes: its regions are cut by size, without a distance. In
    documents of one size pivots are tried once, then parities tell them apart in the join."""
    monkeypatch.setattr(nj, "_steps", lambda counted: bytes(1 << nj.SKETCH_BITS))
    seen, measured = [], nj._measured

    def spied(wanted, sets, put):
        seen.append(wanted.count())
        return measured(wanted, sets, put)

    monkeypatch.setattr(nj, "_measured", spied)
    line = " ".join(f"z{k}" for k in range(12))
    texts = lambda sizes: [f"{line} " + " ".join(f"u{k}_{j}" for j in range(n)) for k, n in enumerate(sizes)]
    for sizes, most, rounds in (([3 * k for k in range(1, 91)], 0, 1), ([30] * 90, 90 * nj.PIVOTS, 2)):
        data = list(enumerate(texts(sizes)))
        del seen[:]
        got = nj.similar_documents(frame(spark, data)).select("doc_id", "n_shingles", "component_id")
        assert order(tuple(r) for r in got.collect()) == order(brute(data))
        assert sum(seen) <= most and len(seen) <= rounds


def test_regions_of_one_component_are_not_cut(spark, monkeypatch):
    rows_cut, cut = [], nj._cut

    def spied(rows, *rest):
        rows_cut.append(rows.count())
        return cut(rows, *rest)

    monkeypatch.setattr(nj, "_cut", spied)
    monkeypatch.setattr(nj, "_steps", lambda counted: bytes(1 << nj.SKETCH_BITS))
    data = list(enumerate(family(random.Random(3), "k", 150, 300, 2)))
    got = nj.similar_documents(frame(spark, data)).select("doc_id", "n_shingles", "component_id")
    assert order(tuple(r) for r in got.collect()) == order(brute(data))
    assert rows_cut == [0]
