"""Benchmark passages in training documents, found in a positional inverted index.

The documents are cut into segments. For every word of a segment the index holds one row with
its positions in that segment, so documents are never moved to build it. Test phrases are
looked up in each segment: the posting lists of a phrase's words, moved by their place in the
phrase, are intersected from the rarest word on until nothing is left.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.taskcontext import TaskContext

from barloom.llm.columns import with_package
from barloom.llm.storage import stored, workspace

WINDOW = 10
#: Words of a segment, beyond which the next document begins another one.
SEGMENT_WORDS = 2_500_000
#: Free positions between two documents. A near match cannot reach over them.
GAP = 64
#: Bytes of test phrases that are searched for in one pass over the index.
BLOCK_BYTES = 16_000_000

# Lower-cases A-Z and turns every other ASCII character but letters and digits into a space.
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
               for b in range(256))

def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_WORDS).split()


class _Segment:
    """Words of some documents, then their posting lists."""

    def __init__(self, number: int):
        self.number, self.end, self.docs = number, 0, []
        self.pending: list[bytes] = []
        self.words, self.where = [], []

    def add(self, key, text: str | None) -> None:
        found = words_of(text)
        self.docs.append((key, self.end, len(found)))
        self.pending += found
        self.where.append(np.arange(self.end, self.end + len(found), dtype=np.int32))
        self.end += len(found) + GAP
        if len(self.pending) > 100_000:
            self._encode()

    def _encode(self) -> None:
        self.words.append(pa.array(self.pending, pa.binary()).dictionary_encode())
        self.pending = []

    def rows(self, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        def batch(**columns):
            n = len(next(iter(columns.values())))
            columns["segment"] = np.full(n, self.number)
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type)
                 for f in schema], schema=schema)

        keys, starts, sizes = zip(*self.docs)
        yield batch(row_id=keys, start=starts, n_words=sizes)
        self._encode()
        whole = pa.chunked_array(self.words).unify_dictionaries()
        terms = whole.chunk(0).dictionary
        codes = np.concatenate([c.indices.to_numpy() for c in whole.chunks])
        at = np.concatenate(self.where)[np.argsort(codes, kind="stable")]
        counts = np.bincount(codes, minlength=len(terms)).astype(np.int32)
        offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
        for width, chosen, steps in _by_width(at, offsets, counts):
            yield batch(term=terms.take(pa.array(chosen)), n=counts[chosen], first=at[offsets[chosen]],
                        width=np.full(len(chosen), width), steps=steps)


def _by_width(at: np.ndarray, offsets: np.ndarray, counts: np.ndarray
              ) -> Iterator[tuple[int, np.ndarray, pa.Array]]:
    """Posting lists as steps between postings, of 1 to 4 bytes each: per width the lists whose
    largest step needs it, and their bytes."""
    if not len(counts):
        return
    steps = np.diff(at, prepend=at[:1]).astype("<u4")
    inner = np.ones(len(at), dtype=bool)
    inner[offsets[:-1]] = False  # a list's first posting is kept beside its steps
    steps[~inner] = 0
    largest = np.maximum.reduceat(steps, offsets[:-1])
    widths = 1 + sum((largest >= 1 << 8 * k).astype(np.int32) for k in (1, 2, 3))
    for width in np.unique(widths).tolist():
        chosen = np.flatnonzero(widths == width)
        mine = steps[inner & np.repeat(widths == width, counts)]
        data = mine.view(np.uint8).reshape(-1, 4)[:, :width].tobytes()
        ends = np.concatenate(([0], np.cumsum((counts[chosen] - 1) * width))).astype(np.int32)
        yield width, chosen, pa.BinaryArray.from_buffers(
            pa.binary(), len(chosen), [None, pa.py_buffer(ends), pa.py_buffer(data)])


def _places(first: int, width: int, steps: bytes) -> np.ndarray:
    """The posting list that ``_by_width`` has packed."""
    raw = np.frombuffer(steps, np.uint8).reshape(-1, width)
    out = np.zeros((len(raw) + 1, 4), np.uint8)
    out[1:, :width] = raw
    places = out.view("<u4").ravel().astype(np.int64)
    places[0] = first
    return np.cumsum(places)


def build_index(docs: DataFrame, row_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The index of ``docs``, to be stored before it is used: a row per segment and word (term, n postings, the first, and
    the steps from one to the next in ``width`` bytes each), and a row per document (row_id,
    start, n_words; its term is null).

    ``row_id`` is a column that is handed back with matches.
    """
    id_type = docs.schema[row_id].dataType
    schema = StructType.fromDDL("segment bigint, term binary, n int, first int, width int, steps binary").add(
        "row_id", id_type).add("start", "integer").add("n_words", "integer")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, count, arrow = TaskContext.get().partitionId(), 0, None
        segment = _Segment(part << 32)
        for batch in batches:
            arrow = pa.schema([("segment", pa.int64()), ("term", pa.binary()), ("n", pa.int32()),
                               ("first", pa.int32()), ("width", pa.int32()), ("steps", pa.binary()),
                               ("row_id", batch.column(0).type), ("start", pa.int32()),
                               ("n_words", pa.int32())])
            for key, t in zip(batch.column(0), batch.column(1)):
                segment.add(key.as_py(), t.as_py())
                if segment.end > SEGMENT_WORDS:
                    yield from segment.rows(arrow)
                    count += 1
                    segment = _Segment((part << 32) + count)
        if segment.docs:
            yield from segment.rows(arrow)
        pa.default_memory_pool().release_unused()  # the worker lives on

    return with_package(docs).select(F.col(row_id).alias("row_id"), F.col(text).alias("text")).mapInArrow(
        run, schema)


def phrases(items: DataFrame, item_id: str = "item_id", text: str = "text",
            window: int = WINDOW) -> DataFrame:
    """(phrase, item): each ``window`` consecutive words of an item, joined by spaces; a shorter
    item is one phrase, one without words none. An item without an id has phrases too."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [], []
            for item, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                w = words_of(t)
                for k in range(max(1, len(w) - window + 1) if w else 0):
                    found[0].append(b" ".join(w[k:k + window]))
                    found[1].append(item)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found[0], pa.binary()), pa.array(found[1], pa.string())], ["phrase", "item"])

    return with_package(items).select(F.col(item_id).cast("string"), text).mapInArrow(
        run, "phrase binary, item string").distinct()


@dataclass(frozen=True)
class Test:
    """A phrase's (word, place in the phrase), the rarest word first, and whose phrase it is."""

    words: list[tuple[bytes, int]]
    items: list[str | None]


def _search(lists: Callable[[bytes], np.ndarray | None], tests: list[Test], slop: int
            ) -> Iterator[tuple[int, int, list[str], bool]]:
    """(first position, end, items, exact) of every match in one segment."""
    for test in tests:
        word, k = test.words[0]
        found = lists(word)
        if found is None:
            continue
        starts = found - k
        near = starts if slop else starts[:0]
        for word, k in test.words[1:]:
            found = lists(word)
            if found is None or not len(starts) + len(near):
                starts = near = starts[:0]
                break
            if len(starts):
                starts = starts[_at_most(found - k, starts, 0)]
            if len(near):
                near = near[_at_most(found - k, near, slop)]
        for a in starts.tolist():
            yield a, a + len(test.words), test.items, True
        for a in np.setdiff1d(near, starts).tolist():
            yield a, a + len(test.words), test.items, False


def _at_most(places: np.ndarray, starts: np.ndarray, slop: int) -> np.ndarray:
    """For which ``starts`` one of ``places`` lies at most ``slop`` away."""
    nearest = np.searchsorted(places, starts - slop)
    return (nearest < len(places)) & (places[np.minimum(nearest, len(places) - 1)] <= starts + slop)


def find_phrases(index: DataFrame, tests: DataFrame, slop: int = 0) -> DataFrame:
    """(row_id, n_words, spans, items, near_items) for every document of the index.

    spans are the exact matches as (first word, end) within the document, overlapping ones
    merged; items the items they belong to. near_items are items with a phrase whose words all
    lie within ``slop`` words of their places (``slop`` < 64), for ``slop`` > 0.

    Phrases are searched for in blocks of about ``BLOCK_BYTES``, each in one pass over the
    postings of its own words, so what a task is sent does not grow with the benchmark. ``index``
    and ``tests`` are read several times and should be stored tables.
    """
    if not 0 <= slop < GAP:
        raise ValueError(f"slop must lie in 0..{GAP - 1}")
    size = tests.agg(F.coalesce(F.sum(F.length("phrase") + F.coalesce(F.length("item"), F.lit(0)) + 100), F.lit(0))).first()[0]
    blocks = int(size // BLOCK_BYTES) + 1
    found = None
    for k in range(blocks):
        block = tests.where(F.pmod(F.xxhash64("phrase", "item"), F.lit(blocks)) == k)
        matched = _find_block(index, block, slop)
        found = matched if found is None else found.unionByName(matched)
    merged = found.groupBy("segment", "start").agg(
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("near_items")))).alias("near_items"))
    empty = {"spans": "array<struct<first:int,end:int>>", "items": "array<string>",
             "near_items": "array<string>"}
    return index.where("term is null").select("segment", "start", "row_id", "n_words").join(
        merged, ["segment", "start"], "left").select(
        "row_id", "n_words", *(F.coalesce(c, F.array().cast(t)).alias(c) for c, t in empty.items()))


def _find_block(index: DataFrame, block: DataFrame, slop: int) -> DataFrame:
    """Matches of one block of phrases, by segment and document start."""
    by_phrase: dict[bytes, list[str]] = {}
    for r in block.toLocalIterator():  # about BLOCK_BYTES
        by_phrase.setdefault(bytes(r["phrase"]), []).append(r["item"])
    words = block.select(F.explode(F.split(F.col("phrase").cast("string"), " ")).alias("term")).select(
        F.col("term").cast("binary").alias("term")).distinct()
    used = index.where("term is not null").join(words, "term", "left_semi")
    rarity = {bytes(r["term"]): r["n"] for r in used.groupBy("term").agg(F.sum("n").alias("n")).collect()}
    tests = []
    for phrase, items in sorted(by_phrase.items()):
        parts = phrase.split(b" ")
        if all(w in rarity for w in parts):
            tests.append(Test(sorted(zip(parts, range(len(parts))), key=lambda x: rarity[x[0]]), items))
    spans = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))
    arrow = pa.schema([("segment", pa.int64()), ("start", pa.int32()), ("spans", spans),
                       ("items", pa.list_(pa.string())), ("near_items", pa.list_(pa.string()))])

    def run(rows: pa.Table) -> pa.Table:
        segment = rows["segment"][0].as_py()
        starts = np.sort(rows["start"].drop_null().to_numpy())
        terms = rows.filter(rows["term"].is_valid())
        packed = {t: row for t, *row in zip(*(terms[c].to_pylist() for c in ("term", "first", "width", "steps")))}
        lists = cache(lambda word: _places(*packed[word]) if word in packed else None)
        hits: dict[int, tuple[list, set, set]] = {}
        for first, end, items, exact in _search(lists, tests, slop):
            doc = int(starts[np.searchsorted(starts, first, side="right") - 1])
            places, whole, near = hits.setdefault(doc, ([], set(), set()))
            if exact:
                places.append((first - doc, end - doc))
            (whole if exact else near).update(i for i in items if i is not None)
        return pa.Table.from_pylist([
            {"segment": segment, "start": doc,
             "spans": [{"first": a, "end": b} for a, b in _merge(places)],
             "items": sorted(whole), "near_items": sorted(near)}
            for doc, (places, whole, near) in hits.items()], arrow)

    columns = ("segment", "start", "term", "first", "width", "steps")
    return used.select(*columns).unionByName(index.where("term is null").select(*columns)).groupBy(
        "segment").applyInArrow(run, "segment bigint, start int, spans array<struct<first:int,end:int>>, "
                                     "items array<string>, near_items array<string>")


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def contamination(docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text", window: int = WINDOW,
                  slop: int = 0) -> DataFrame:
    """(id, n_words, n_hit, items, near_items, contaminated) for each row of ``docs``.

    n_hit counts the words inside any exact occurrence of a window of ``window`` item words;
    contaminated is n_hit > 0. Null and empty texts have no words; an item without words is
    never found, and one without an id counts for n_hit but is not listed. Repeated rows each give a row, empty
    tables give an empty result or no hit, and other columns are not read.
    """
    with workspace() as put:
        index = put(build_index(docs, id_column, text), "index")
        tests = put(phrases(items, item_id, item_text, window), "phrases")
        found = stored(find_phrases(index, tests, slop), "found")
    n_hit = F.aggregate("spans", F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("end")),
                        lambda a, s: F.struct(
                            (a["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(s["first"], a["end"])))
                            .alias("n"), F.greatest(a["end"], s["end"]).alias("end")), lambda a: a["n"])
    return found.select(F.col("row_id").alias(id_column), F.col("n_words").cast("bigint").alias("n_words"),
                        n_hit.alias("n_hit"), "items", "near_items",
                        (F.size("spans") > 0).alias("contaminated"))


def decontaminated(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id",
                   item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` without the rows whose text holds a window of an item. Rows are told apart by
    their text alone, so null or repeated ids do not matter."""
    keyed = docs.withColumn("__key", F.sha2(text, 256))
    hit = contamination(keyed, items, "__key", text, item_id, item_text, window).where(
        "contaminated").select("__key").distinct()
    return keyed.join(hit, "__key", "left_anti").select(docs.columns)
