"""Documents whose sets of word shingles are alike: an exact join in the metric space of the
Jaccard distance.

A pivot is a set, and its region are the documents for which it is the nearest (a Voronoi
region). Two documents within the radius r may lie in two regions, but then each is at most 2r
farther from the other's pivot than from its own; by this window of the triangle inequality it
visits the other region, unless that has no document as far from the pivot. What is joined inside the regions is thus complete, and a region that
is too large is cut by pivots of its own in the same way.

The first pivots are the sets of a single shingle. A document has distance 1 to all of them but
its own shingles, so it lies with its rarest one, and visits those behind it as long as a
document within r may have only these: that is its prefix, as two sets within r that shared no
prefix shingle would have too little left in common. Shingles of one document make no region.
A large region is first cut by size, as linked sets are of nearly one size: a document visits the
next larger class. Later pivots are documents of the region. What lies within r of a pivot is linked by that, and
pairs that links have connected already are not looked at again; so a large group of copies
costs a few distances for each of its members instead of one for each pair.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.taskcontext import TaskContext

from barloom.llm.columns import add_columns, with_package
from barloom.llm.components import components
from barloom.llm.storage import stored, workspace

Put = Callable[[DataFrame, str], DataFrame]

WORDS = 4
#: Least similarity of linked documents, as a fraction in whole numbers.
SIMILAR, OF = 85, 100
#: Counters of the frequency sketch that orders shingles. Any order gives the same links.
SKETCH_BITS = 20
_SLICES = 16
#: Pivots that cut a region, and how often regions are cut.
PIVOTS, DEPTH = 4, 4
#: A region is joined as it is if its rows have so many possible partners on the average; and of
#: more, once pivots have linked its large groups and parities can be compared in the join.
PARTNERS, MORE_PARTNERS = 32, 2048
#: Pairs are compared in so many parts, so that the sets of one part only are on disk at a time.
PARTS = 4
#: 64-bit words of a set's parity. Pairs that differ in too many bits are not compared further.
PARITY_WORDS = 8
#: Rows that Python gets at a time: a pair comes with two whole sets, of up to 160 KB each for a
#: text of 20,000 words, which the executor and its worker both hold.
ARROW_ROWS = 512
#: Against rounding: windows may be wider than they need to be, never narrower.
_SLACK = 1e-9
#: The level of the cut by size among the visits of a row; those of pivots are the lower bits.
_BY_SIZE = 1 << 30
_SEED = 42
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_WORDS_AT_ONCE = 1 << 16


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """64-bit hashes of the text's different shingles, ascending. A text of fewer words has one
    of them all, a text without a word none."""
    found = (text or "").encode().translate(_LOWER).split()
    if not found:
        return np.empty(0, dtype=np.uint64)
    if len(found) < words:
        return np.array([xxhash.xxh64_intdigest(b" ".join(found), _SEED + 1)], dtype=np.uint64)
    made = []
    for start in range(0, len(found) - words + 1, _WORDS_AT_ONCE):
        part = found[start:start + _WORDS_AT_ONCE + words - 1]
        seen = {w: xxhash.xxh64_intdigest(w, _SEED) for w in set(part)}
        hashed = np.fromiter(map(seen.__getitem__, part), dtype=np.uint64, count=len(part))
        n = len(part) - words + 1
        mixed = np.zeros(n, dtype=np.uint64)
        for k in range(words):
            mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + hashed[k:k + n]
        mixed ^= mixed >> np.uint64(32)
        mixed *= np.uint64(0xD6E8FEB86659FD93)
        made.append(np.unique(mixed ^ mixed >> np.uint64(32)))
    return made[0] if len(made) == 1 else np.unique(np.concatenate(made))


def _identity(found: np.ndarray) -> tuple[int, int, int]:
    """Size and two hashes of a set."""
    raw = found.tobytes()
    return len(found), *(xxhash.xxh64_intdigest(raw, seed) - (1 << 63) for seed in (1, 2))


def _members(docs: DataFrame, words: int) -> DataFrame:
    """(id, n, hi, lo) of each row of ``docs`` (id, text); and in rows with a slice the counters
    of each task's shingles, so that the texts are read once for both."""
    schema = StructType([docs.schema["id"]]).add("n", "long").add("hi", "long").add("lo", "long") \
        .add("slice", "integer").add("task", "integer").add("counts", "binary")
    size = 1 << SKETCH_BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, kind = np.zeros(size, dtype=np.uint32), pa.null()
        for whole in batches:
            kind = whole.column(0).type
            for start in range(0, whole.num_rows, 128):
                batch = whole.slice(start, 128)
                rows = []
                for t in batch.column(1).to_pylist():
                    found = shingles(t, words)
                    np.add.at(total, (found & np.uint64(size - 1)).astype(np.int64), np.uint32(1))
                    rows.append(_identity(found))
                n = len(rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *(pa.array(x, pa.int64()) for x in zip(*rows)), pa.nulls(n, pa.int32()),
                     pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names=schema.fieldNames())
        task = TaskContext.get().partitionId() % 64
        nothing = [pa.nulls(_SLICES, kind)] + [pa.nulls(_SLICES, pa.int64())] * 3
        if not pa.types.is_null(kind):
            yield pa.RecordBatch.from_arrays(
                [*nothing, pa.array(range(_SLICES), pa.int32()), pa.array([task] * _SLICES, pa.int32()),
                 pa.array([part.tobytes() for part in np.split(total, _SLICES)], pa.binary())], names=schema.fieldNames())
        pa.default_memory_pool().release_unused()  # the worker lives on

    return with_package(docs).select("id", "text").mapInArrow(run, schema)


def _identified(docs: DataFrame, words: int) -> DataFrame:
    def make():
        return lambda texts: (_identity(shingles(t, words)) for t in texts)

    return add_columns(docs, "text", "n bigint, hi bigint, lo bigint", make, keep=["text"])


def _added_up(slices: DataFrame, keys: list[str], told: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """One row per ``keys``, with what ``told`` makes of the sum of its counters."""
    def run(_, table):
        total = np.zeros(size, dtype=np.uint64)
        for x in table.column("counts"):
            total += np.frombuffer(x.as_buffer(), dtype=np.uint32)
        total = np.minimum(total, np.iinfo(np.uint32).max).astype(np.uint32)
        return pa.table([table.column("slice")[:1], table.column("task")[:1],
                         pa.array([told(total).tobytes()], pa.binary())], names=["slice", "task", "counts"])

    size = (1 << SKETCH_BITS) // _SLICES
    return slices.groupBy(*keys).applyInArrow(run, "slice int, task int, counts binary")


def _by_task(counted: DataFrame) -> DataFrame:
    """The counters of each slice added up by 64 groups of tasks, so that no task holds many."""
    return _added_up(counted, ["slice", "task"], lambda total: total)


def _steps(counted: DataFrame) -> bytes:
    """For each counter how frequent its shingles are, in half octaves: 2**SKETCH_BITS bytes."""
    short = _added_up(counted, ["slice"], lambda total: np.ceil(2 * np.log2(total + 1.0)).astype(np.uint8))
    found = {r.slice: bytes(r.counts) for r in short.select("slice", "counts").collect()}
    return b"".join(found.get(k, bytes((1 << SKETCH_BITS) // _SLICES)) for k in range(_SLICES))


def prefix_length(n: int, similar: int, of: int) -> int:
    return n - -(-n * similar // of) + 1


def parity(found: np.ndarray) -> np.ndarray:
    """Bits that each shingle of the set turns over, in words, so that two sets differ in at least
    as many shingles as bits."""
    bits = 64 * PARITY_WORDS
    odd = np.bincount((found & np.uint64(bits - 1)).astype(np.int64), minlength=bits).astype(np.uint8) & 1
    return np.packbits(odd).view(np.int64)


def _described(classes: DataFrame, words: int, similar: int, of: int, steps: bytes) -> DataFrame:
    """(c, n, parity, lead, prefix) of each class: lead is the step of its rarest shingle."""
    order = classes.sparkSession.sparkContext.broadcast(steps)  # of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = np.frombuffer(order.value, dtype=np.uint8)
        for whole in batches:
            for start in range(0, whole.num_rows, 128):
                batch = whole.slice(start, 128)
                rows = []
                for t in batch.column(1).to_pylist():
                    found = shingles(t, words)
                    rare = step[(found & np.uint64((1 << SKETCH_BITS) - 1)).astype(np.int64)]
                    first = np.lexsort((found, rare))[:prefix_length(len(found), similar, of)]
                    rows.append((len(found), parity(found), int(rare[first[0]]), found[first].view(np.int64)))
                kinds = pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *(pa.array(x, kind) for x, kind in zip(zip(*rows), kinds))],
                    names=["c", "n", "parity", "lead", "prefix"])
        pa.default_memory_pool().release_unused()

    return classes.select("c", "text").mapInArrow(
        run, "c bigint, n bigint, parity array<bigint>, lead bigint, prefix array<bigint>")


def _first_regions(described: DataFrame, similar: int, of: int, put: Put) -> DataFrame:
    """(g, c, n, at, lead, visits): the class c lies in the region of the shingle g, which stands
    in its order at the place ``at``. Regions of one are left out. A region of so many that it would
    be cut by pivots is cut by size first, which takes no distances: a row is in its own class of
    sizes and visits the next, unless only visitors would meet there."""
    posted = described.select("c", "n", "lead", F.posexplode("prefix").alias("at", "g"))
    held = posted.groupBy("g").agg(F.count("*").alias("m")).where("m > 1")
    regions = put(posted.join(held, "g").select("g", "c", "n", "at", "lead", "m"), "regions")
    kept = ["g", "c", "n", "at", "lead", "visits"]
    large = F.col("m") > 2 * PARTNERS
    size = F.floor(F.log("n") / (math.log(of / similar) + _SLACK))
    cut = regions.where(large).withColumn("up", F.explode(F.array(F.lit(0), F.lit(1)))).withColumns(
        {"g": F.xxhash64("g", size + F.col("up")), "visits": F.col("up") * _BY_SIZE}).select(kept)
    met = cut.groupBy("g").agg(F.count("*").alias("m"), F.min("visits").alias("least")).where("m > 1 and least = 0")
    sized = put(cut.join(met, "g", "left_semi"), "sized")
    return regions.where(~large).withColumn("visits", F.lit(0)).select(kept).unionByName(sized)


def _may_link(similar: int, of: int) -> Column:
    """Of two rows of a region, by their sizes and the places of a shingle they share: what comes
    before the first shared one is not shared, and one of the regions of a linked pair is that of
    its first."""
    reach = F.least("at", "of_at") + F.least(F.col("n") - F.col("at"), F.col("of_n") - F.col("of_at"))
    return (F.least("n", "of_n") * of >= F.greatest("n", "of_n") * similar) & (
        reach >= _least_overlap(F.col("n") + F.col("of_n"), similar, of))


def _least_overlap(both: Column, similar: int, of: int) -> Column:
    return F.ceil(both * similar / (similar + of) - _SLACK)


def _parities_allow(x: str, y: str, both: Column, similar: int, of: int) -> Column:
    """Two sets may link only if their parities differ in no more bits than they may in shingles."""
    differ = sum((F.bit_count(F.col(x)[k].bitwiseXOR(F.col(y)[k])) for k in range(1, PARITY_WORDS)),
                 F.bit_count(F.col(x)[0].bitwiseXOR(F.col(y)[0])))
    return differ <= both - 2 * _least_overlap(both, similar, of)


def _alike(pairs: DataFrame, described: DataFrame, similar: int, of: int) -> DataFrame:
    """The pairs (a, b) whose parities allow a link."""
    told = lambda c: described.select(F.col("c").alias(c), F.col("n").alias(f"n_{c}"), F.col("parity").alias(f"in_{c}"))
    return pairs.join(told("a"), "a").join(told("b"), "b").where(
        _parities_allow("in_a", "in_b", F.col("n_a") + F.col("n_b"), similar, of)).select("a", "b")


def _measured(wanted: DataFrame, sets: DataFrame, put: Put) -> DataFrame:
    """(a, b, shared, either) for the pairs (a, b): the sizes of intersection and union. The pairs
    go in parts, as each takes two sets through a shuffle, and sets in no pair of a part stay."""
    part = lambda c: F.pmod(F.xxhash64(c), F.lit(PARTS))
    of = lambda c, pairs: sets.join(pairs.select(F.col(c).alias("c")), "c", "left_semi").select(
        F.col("c").alias(c), F.col("members").alias(f"in_{c}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            shared, either = [], []
            for x, y in zip(whole.column(2), whole.column(3)):
                p, q = (np.frombuffer(s.as_buffer(), dtype=np.uint64) for s in (x, y))
                if len(p) < len(q):
                    p, q = q, p
                at = np.minimum(np.searchsorted(p, q), len(p) - 1)
                shared.append(int((p[at] == q).sum()))
                either.append(len(p) + len(q) - shared[-1])
            yield pa.RecordBatch.from_arrays(
                [whole.column(0), whole.column(1), pa.array(shared, pa.int64()), pa.array(either, pa.int64())],
                names=["a", "b", "shared", "either"])
        pa.default_memory_pool().release_unused()

    found = None
    for k in range(PARTS):
        pairs = wanted.where(part("a") == k)
        both = pairs.join(of("b", pairs), "b").join(of("a", pairs), "a").select("a", "b", "in_a", "in_b")
        measured = put(both.mapInArrow(run, "a bigint, b bigint, shared bigint, either bigint"), "measured")
        found = measured if found is None else found.unionByName(measured)
    return found


def _sets(classes: DataFrame, words: int) -> DataFrame:
    def make():
        return lambda texts: ((shingles(t, words).tobytes(),) for t in texts)

    return add_columns(classes, "text", "members binary", make, keep=["c"])


def _pair(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _told(regions: DataFrame, roots: DataFrame) -> DataFrame:
    return regions.join(roots.withColumnRenamed("node", "c"), "c", "left").select(
        *regions.columns, F.coalesce("root", "c").alias("root"))


def _still_apart(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """The rows of the regions that links have not connected into one component yet."""
    told = _told(rows.drop("root"), roots)
    apart = told.groupBy("g").agg(F.min("root").alias("least"), F.max("root").alias("most")).where("least != most")
    return told.join(apart, "g", "left_semi")


def _with_links(roots: DataFrame, links: DataFrame, put: Put) -> DataFrame:
    """(node, root) with more links: they are drawn between the roots that there are, so what is
    connected already is not gone through again."""
    drawn = put(_other_roots(links, roots).select(F.col("root_a").alias("a"), F.col("root_b").alias("b")), "drawn")
    if drawn.isEmpty():
        return roots
    moved = put(components(drawn, put).select(F.col("node").alias("root"), F.col("root").alias("to")), "moved")
    known = roots.select("node", "root").unionByName(
        moved.select(F.col("root").alias("node"), "root").join(roots.select("node"), "node", "left_anti"))
    return put(known.join(moved, "root", "left").select("node", F.coalesce("to", "root").alias("root")), "roots")


def _other_roots(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs (a, b) that links have not connected, with the roots of both."""
    of = lambda c: roots.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}"))
    found = pairs.join(of("a"), "a", "left").join(of("b"), "b", "left").select(
        "a", "b", F.coalesce("root_a", "a").alias("root_a"), F.coalesce("root_b", "b").alias("root_b"))
    return found.where("root_a != root_b")


def linked_classes(classes: DataFrame, described: DataFrame, words: int, similar: int, of: int, put: Put) -> DataFrame:
    """(node, root) for ``classes`` (c, text) that are linked with others: the components of all
    links. Pairs that others have connected by then are not looked at."""
    radius = 1 - similar / of
    regions = _first_regions(described, similar, of, put).withColumn("d", F.lit(None).cast("double"))
    sets = None
    roots = put(regions.sparkSession.createDataFrame([], "node bigint, root bigint"), "roots")
    for depth in range(DEPTH + 1):
        rows = put(_told(regions, roots), "told")
        by_root = rows.groupBy("g", "root").agg(F.count("*").alias("k"))
        size = by_root.groupBy("g").agg(
            F.sum("k").alias("m"), F.sum(F.col("k") * F.col("k")).alias("sq"),
            F.max(F.struct("k", "root")).alias("most")).where("m * m > sq")
        # Rows of a region in one component have nothing left to find.
        partners = PARTNERS if depth == 0 else MORE_PARTNERS
        crowded = (F.col("m") * F.col("m") - F.col("sq") > 2 * partners * F.col("m")) & F.lit(depth < DEPTH)
        live = put(rows.join(size, "g").select(
            *rows.columns, (F.col("root") != F.col("most.root")).alias("minor"), crowded.alias("crowded")), "live")
        large = live.where("crowded")
        pivots = put(_pivots(large, depth), "pivots")
        small = live.where("not crowded")
        if depth == 0:  # most rows: few of their pairs get as far as the parities
            near = _alike(put(_joined(small, radius, similar, of).distinct(), "near"), described, similar, of)
        else:
            near = _joined(small.join(described.select("c", "parity"), "c"), radius, similar, of)
        far = large.join(pivots, "g").where("c != p").select(*_pair("c", "p"))
        wanted = put(near.unionByName(far).distinct(), "wanted")
        if sets is None:
            used = wanted.select(F.col("a").alias("c")).unionByName(wanted.select(F.col("b").alias("c"))).unionByName(
                large.select("c")).distinct()
            sets = put(_sets(classes.join(used, "c", "left_semi"), words), "sets")
        found = _measured(wanted, sets, put)
        roots = _with_links(roots, found.where(F.col("shared") * of >= F.col("either") * similar), put)
        if pivots.isEmpty():
            break
        regions = _cut(put(_still_apart(large, roots), "apart"), pivots, found, radius, depth, put)
    return roots


def _joined(rows: DataFrame, radius: float, similar: int, of: int) -> DataFrame:
    """Pairs of a region that may be linked: not of one component (at least one is outside the
    region's largest), not both visitors of a region that one of them visits on one level."""
    other = rows.select("g", *(F.col(c).alias(f"of_{c}") for c in rows.columns if c != "g"))
    apart = F.coalesce(F.abs(F.col("d") - F.col("of_d")) <= radius + _SLACK, F.lit(True))
    may_link = _may_link(similar, of)
    if "parity" in rows.columns:
        may_link &= _parities_allow("parity", "of_parity", F.col("n") + F.col("of_n"), similar, of)
    return rows.where("minor").join(other, "g").where(
        (F.col("root") != F.col("of_root")) & (~F.col("of_minor") | (F.col("c") < F.col("of_c")))
        & (F.col("visits").bitwiseAND(F.col("of_visits")) == 0) & apart & may_link
    ).select(*_pair("c", "of_c"))


def _pivots(rows: DataFrame, depth: int) -> DataFrame:
    """(g, p): a region's pivots. Those that have fewest rare shingles are in the middle of most
    others; equal ones are taken in one order for all regions, as regions overlap."""
    order = Window.partitionBy("g").orderBy(F.desc("minor"), F.desc("lead"), F.xxhash64("c", F.lit(depth)), "c")
    return rows.withColumn("__r", F.row_number().over(order)).where(F.col("__r") <= PIVOTS).select(
        "g", F.col("c").alias("p"))


def _cut(rows: DataFrame, pivots: DataFrame, found: DataFrame, radius: float, depth: int, put: Put) -> DataFrame:
    """The regions of the pivots with their visitors; the pivots themselves are done. A region
    whose windows would hold each row more than twice stays whole."""
    d = (1 - F.col("shared") / F.col("either")).alias("d")
    far = found.select("a", "b", d)
    told = rows.join(pivots, "g").select(*rows.columns[:rows.columns.index("d")], "p")
    at = told.join(far, (F.least("c", "p") == far.a) & (F.greatest("c", "p") == far.b), "left")
    is_pivot = F.max(F.col("c") == F.col("p"))
    cells = at.groupBy(*told.columns[:-1]).agg(
        is_pivot.alias("done"), F.array_sort(F.collect_list(F.struct("d", "p"))).alias("cells")).where("not done")
    near = F.element_at("cells", 1)
    cells = put(cells.select("*", near["p"].alias("home"), near["d"].alias("from_home")), "cells")
    # Besides, a visitor is no farther from the pivot than the farthest resident and r.
    reach = cells.groupBy("g", F.col("home").alias("p")).agg(F.max("from_home").alias("reach"))
    first = F.array_min(F.transform("cells", lambda x: F.struct(x["p"].alias("p"), x["d"].alias("d"))))
    window = F.filter("cells", lambda x: x["d"] <= F.col("from_home") + 2 * radius + _SLACK)
    each = put(cells.select("*", F.explode(window).alias("cell")).select(
        "g", "c", "n", "at", "lead", "visits", "cell.p", "cell.d", (F.col("home") != F.col("cell.p")).alias("visits_p"),
        first["d"].alias("first_d")).join(reach, ["g", "p"]).where(F.col("d") <= F.col("reach") + radius + _SLACK), "cut")
    parted = each.groupBy("g").agg((F.count("*") <= 2 * F.count_if(~F.col("visits_p"))).alias("parted"))
    rows = each.join(parted, "g").where("parted or not visits_p")
    level = F.when(F.col("visits_p"), 1 << depth).otherwise(0)
    return put(rows.select(
        F.when(F.col("parted"), F.xxhash64("g", "p")).otherwise(F.col("g")).alias("g"), "c", "n", "at", "lead",
        F.col("visits").bitwiseOR(level).alias("visits"), F.when(F.col("parted"), F.col("d")).otherwise(
            F.col("first_d")).alias("d")), "regions")


def similar_documents(docs: DataFrame, id_column: str = "doc_id", text: str = "text", words: int = WORDS,
                      similar: int = SIMILAR, of: int = OF) -> DataFrame:
    """(id, n_shingles, component_id, class_id) for each row of ``docs``.

    A document is the set of its ``words``-word shingles (words between ASCII white space, A-Z in
    lower case). Rows with one set are a class; class_id is a number that they share. Two
    documents are linked if ``of`` * intersection >= ``similar`` * union of their sets, and
    component_id is the smallest id that links reach. Texts without a word and null texts have
    an empty set, which is linked with nothing: component_id is the own id and class_id null. Rows
    with a null id link others; a component of such rows only has a null component_id.
    Repeated rows each give a row, and rows that share an id are separate documents. An empty
    table gives an empty result; other columns are not read. Texts of any length are taken whole.
    Shingles are told apart by 64 bits of a hash, sets by 128.
    """
    plain = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
    with workspace(ARROW_ROWS) as put:
        told = put(_members(plain, words), "counted")
        members = stored(told.where("slice is null").select("id", "n", "hi", "lo"), "members")
        # Stored between, as a task of both sums would have two Python workers at once.
        steps = _steps(put(_by_task(told.where("slice is not null").select("slice", "task", "counts")), "summed"))
        keyed = _identified(plain, words).where("n > 0")
        classes = put(keyed.groupBy("hi", "lo").agg(F.first("text").alias("text")).withColumn(
            "c", F.monotonically_increasing_id()), "classes")
        described = put(_described(classes, words, similar, of, steps), "described")
        roots = linked_classes(classes.select("c", "text"), described, words, similar, of, put)
        keyed = classes.select("hi", "lo", "c").join(roots, F.col("c") == F.col("node"), "left").select(
            "hi", "lo", "c", F.coalesce("root", "c").alias("root"))
        least = members.groupBy("hi", "lo").agg(F.min("id").alias("least"))
        rooted = put(keyed.join(least, ["hi", "lo"]), "rooted")
        named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
        known = stored(rooted.join(named, "root").select("hi", "lo", F.col("c").alias("class_id"), "component_id"), "named")
    empty = members.where("n = 0").select(
        F.col("id").alias(id_column), F.col("n").alias("n_shingles"), F.col("id").alias("component_id"),
        F.lit(None).cast("bigint").alias("class_id"))
    return members.where("n > 0").join(known, ["hi", "lo"]).select(
        F.col("id").alias(id_column), F.col("n").alias("n_shingles"), "component_id", "class_id").unionByName(empty)
