"""Conversations brought into the order system?, (user, assistant)+ by the cheapest edits.

A conversation is a sequence of symbols, one per row: the initial of its role and what is wrong
with it. What a symbol costs is a min-plus matrix over the states of the wanted order, each
entry with the edits behind it, and sequences multiply. Most sequences share most of their
parts, so a grammar is learned over all of them (Re-Pair: frequent neighbours become a symbol),
each rule's matrix is made once from those of its two sides, and a sequence costs as many
products as it has symbols left. The edits are ropes that share their parts in the same way.

Among edits of one cost the ASCII-least are taken. Two such strings for the same rows and states
never begin one another (they hold the same number of letters but I, and any further I costs),
so the least of a product comes from the least of its factors.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.columns import with_package
from barloom.llm.places import numbered
from barloom.llm.storage import stored, workspace

REROLE, DELETE, INSERT, UNFINISHED = 1, 2, 5, 5
#: Rows of a conversation that are one sequence; longer conversations are several, multiplied.
SEGMENT = 1024
#: Sequences or partial products that are multiplied in one step.
FAN = 256
#: The grammar is learned in so many rounds of so many rules.
ROUNDS, RULES = 6, 64

WHITE = r"\x20\x09-\x0D"
#: Symbols: upper case must go (blank or a duplicate), "!" behind a letter is unfinished, "o" any
#: other role. As single characters:
SYMBOLS = ("s", "u", "a", "o", "s!", "u!", "a!", "o!", "S", "U", "A", "O")
_CHARS = {name: chr(0x100 + k) for k, name in enumerate(SYMBOLS)}
_FIRST_RULE = 0x100 + len(SYMBOLS)

# States of the wanted order: nothing yet, after system, after user, after assistant.
_STATES = range(4)
_MOVES = {"s": ((0, 1),), "u": ((0, 2), (1, 2), (3, 2)), "a": ((2, 3),)}
_ENDS = (0, 3)


class Rope:
    """A string as a leaf or two ropes, with a hash by which equal parts are passed over."""

    __slots__ = ("text", "left", "right", "size", "mark")
    _PRIME, _BASE = (1 << 61) - 1, 0x5DEECE66D1234567 % ((1 << 61) - 1)

    def __init__(self, text: str = "", left: Rope | None = None, right: Rope | None = None):
        self.text, self.left, self.right = text, left, right
        if left is None:
            self.size, self.mark = len(text), 0
            for c in text:
                self.mark = (self.mark * self._BASE + ord(c)) % self._PRIME
        else:
            self.size = left.size + right.size
            self.mark = (left.mark * pow(self._BASE, right.size, self._PRIME) + right.mark) % self._PRIME

    def __add__(self, other: Rope) -> Rope:
        if not self.size or not other.size:
            return self if self.size else other
        return Rope(left=self, right=other)

    def __str__(self) -> str:
        parts, rest = [], [self]
        while rest:
            node = rest.pop()
            if node.left is None:
                parts.append(node.text)
            else:
                rest += (node.right, node.left)
        return "".join(parts)

    def __lt__(self, other: Rope) -> bool:
        a, b = [self], [other]
        while a and b:
            x, y = a.pop(), b.pop()
            if x is y or x.size == y.size and x.mark == y.mark:
                continue
            if x.left is None and y.left is None:
                n = min(x.size, y.size)
                if x.text[:n] != y.text[:n]:
                    return x.text < y.text
                a += [Rope(x.text[n:])] * (x.size > n)
                b += [Rope(y.text[n:])] * (y.size > n)
            elif y.left is None or x.left is not None and x.size >= y.size:
                a += (x.right, x.left)
                b.append(y)
            else:
                b += (y.right, y.left)
                a.append(x)
        return not a and bool(b)


#: A matrix maps (state before, state after) to (cost, edits); what is not there is impossible.
Matrix = dict[tuple[int, int], tuple[int, Rope]]


def times(a: Matrix, b: Matrix) -> Matrix:
    out: Matrix = {}
    for (i, k), (cost, edits) in a.items():
        for j in _STATES:
            if (k, j) not in b:
                continue
            more, later = b[k, j]
            best = out.get((i, j))
            if best is None or cost + more < best[0]:
                out[i, j] = cost + more, edits + later
            elif cost + more == best[0] and (edits + later) < best[1]:
                out[i, j] = cost + more, edits + later
    return out


def _inserts() -> Matrix:
    """Any number of inserted rows; going around again only costs."""
    once = {move: (INSERT, Rope("I")) for kind in "ua" for move in _MOVES[kind]}
    none = {(i, i): (0, Rope()) for i in _STATES}
    some = times(once, none)
    out = dict(none)
    for found in (some, times(some, once)):
        for at, entry in found.items():
            if at not in out or entry[0] < out[at][0]:
                out[at] = entry
    return out


def _symbol(name: str) -> Matrix:
    """A row, and rows inserted before it."""
    found: Matrix = {(i, i): (DELETE, Rope("D")) for i in _STATES}
    extra = UNFINISHED if name.endswith("!") else 0
    if name.islower():
        options = [(move, extra, "K") for move in _MOVES.get(name[0], ())]
        options += [(move, REROLE + extra, "R") for kind in "ua" for move in _MOVES[kind]]
        for move, cost, edit in options:
            if move not in found or (cost, edit) < (found[move][0], str(found[move][1])):
                found[move] = cost, Rope(edit)
    return times(_inserts(), found)


def _initial(char: str) -> str:
    return SYMBOLS[ord(char) - 0x100][0].lower()


class Grammar:
    """Rules (two characters each; the k-th stands for one character more), and for every symbol
    its matrix, first and last initial and the breaks of order inside it."""

    def __init__(self, rules: Sequence[str]):
        self.rules = list(rules)
        self.matrix = {c: _symbol(name) for name, c in _CHARS.items()}
        self.told = {c: (_initial(c), _initial(c), 0) for c in _CHARS.values()}
        for k, pair in enumerate(self.rules):
            self.matrix[self.char(k)] = times(self.matrix[pair[0]], self.matrix[pair[1]])
            self.told[self.char(k)] = joined(self.told[pair[0]], self.told[pair[1]])

    @staticmethod
    def char(k: int) -> str:
        return chr(_FIRST_RULE + k)

    def compressed(self, sequence: str) -> str:
        for k, pair in enumerate(self.rules):
            sequence = sequence.replace(pair, self.char(k))
        return sequence

    def evaluate(self, sequence: str) -> tuple[Matrix, tuple[str, str, int]]:
        """Of a sequence with a symbol at least."""
        short = self.compressed(sequence)
        matrix, told = self.matrix[short[0]], self.told[short[0]]
        for c in short[1:]:
            matrix, told = times(matrix, self.matrix[c]), joined(told, self.told[c])
        return matrix, told


def joined(a: tuple[str, str, int], b: tuple[str, str, int]) -> tuple[str, str, int]:
    return a[0], b[1], a[2] + b[2] + (a[1] + b[0] not in ("su", "ua", "au"))


@lru_cache(maxsize=4)
def _grammar(rules: tuple[str, ...]) -> Grammar:
    """One per worker process."""
    return Grammar(rules)


def pair_counts(sequences: Sequence[str]) -> Counter:
    """Neighbours and how often each could be replaced."""
    found: Counter = Counter()
    for s in sequences:
        for pair in {s[k:k + 2] for k in range(len(s) - 1)}:
            found[pair] += s.count(pair)
    return found


def learn_grammar(sequences: DataFrame, rounds: int = ROUNDS, rules: int = RULES) -> list[str]:
    """The rules for the column ``sequence``: in each round the most frequent neighbours, those
    found twice at least. No more than rounds * rules pairs come to the driver."""
    known: list[str] = []
    for _ in range(rounds):
        so_far = tuple(known)

        def count(batches: Iterator[pa.RecordBatch], so_far=so_far) -> Iterator[pa.RecordBatch]:
            grammar, found = _grammar(so_far), Counter()
            for batch in batches:
                found.update(pair_counts([grammar.compressed(s) for s in batch.column(0).to_pylist()]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], names=["pair", "n"])

        counted = sequences.select("sequence").mapInArrow(count, "pair string, n bigint")
        new = counted.groupBy("pair").agg(F.sum("n").alias("n")).where("n > 1").orderBy(
            F.desc("n"), "pair").limit(rules).collect()
        known += [r.pair for r in new]
        if not new:
            break
    return known


_MATRIX = "first string, last string, illegal bigint, costs array<bigint>, edits array<string>"


def _packed(matrix: Matrix, told: tuple[str, str, int]) -> tuple:
    cells = [matrix.get((i, j)) for i in _STATES for j in _STATES]
    return *told, [c and c[0] for c in cells], [c and str(c[1]) for c in cells]


def _unpacked(costs, edits) -> Matrix:
    return {divmod(k, len(_STATES)): (int(c), Rope(e))
            for k, (c, e) in enumerate(zip(costs, edits)) if c is not None and e is not None}


def _arrays(rows: list[tuple], kinds: list[pa.DataType]) -> list[pa.Array]:
    return [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]


_KINDS = [pa.string(), pa.string(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.string())]


def _evaluated(sequences: DataFrame, rules: Sequence[str]) -> DataFrame:
    """Each distinct sequence with its matrix."""
    rules = tuple(rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = _grammar(rules)
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                rows = [_packed(*grammar.evaluate(s)) for s in batch.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *_arrays(rows, _KINDS)],
                    names=["sequence", "first", "last", "illegal", "costs", "edits"])

    return sequences.select("sequence").mapInArrow(run, f"sequence string, {_MATRIX}")


def _multiplied(parts: DataFrame) -> DataFrame:
    """(conv, part, matrix): FAN consecutive parts of a conversation become one."""
    def run(_, table):
        rows = sorted(table.to_pylist(), key=lambda r: r["part"])
        matrix, told = None, None
        for r in rows:
            m, t = _unpacked(r["costs"], r["edits"]), (r["first"], r["last"], r["illegal"])
            matrix, told = (m, t) if matrix is None else (times(matrix, m), joined(told, t))
        packed = [(rows[0]["conv"], rows[0]["part"] // FAN, *_packed(matrix, told))]
        return pa.Table.from_arrays(_arrays(packed, [pa.string(), pa.int64(), *_KINDS]),
                                    names=["conv", "part", "first", "last", "illegal", "costs", "edits"])

    return parts.groupBy("conv", F.expr(f"part div {FAN}").alias("group")).applyInArrow(
        run, f"conv string, part bigint, {_MATRIX}")


def _answers(whole: DataFrame) -> DataFrame:
    """(conv, illegal, cost, audit) from the matrix of a conversation."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ending = _inserts()
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                matrix = times(_unpacked(r["costs"], r["edits"]), ending)
                cost, audit = min((matrix[0, j][0], str(matrix[0, j][1])) for j in _ENDS if (0, j) in matrix)
                rows.append((r["conv"], r["illegal"], cost, audit))
            yield pa.RecordBatch.from_arrays(_arrays(rows, [pa.string(), pa.int64(), pa.int64(), pa.string()]),
                                             names=["conv", "illegal", "cost", "audit"])

    return whole.mapInArrow(run, "conv string, illegal bigint, cost bigint, audit string")


def edited(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of each row that an audit leaves or inserts."""
    alternate, begun = ("user", "assistant"), 0
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(rows)
        if edit == "D":
            continue
        if edit != "K":
            role = alternate[begun % 2]
        yield edit, role, text
        # A kept system row comes before the alternation.
        begun += not (begun == 0 and edit == "K" and role[:1] == "s")


def _by_conversation(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """The audit of each conversation, then its rows in order, all in one partition. SHA-256 and
    numbering go through a conversation from its first row to its last, so its rows stream
    through one task; none of them is held."""
    both = audits.select("conv", F.lit(0).alias("kind"), F.lit(None).cast("bigint").alias("turn"),
                         F.lit("").alias("role"), F.lit(0).cast("bigint").alias("h"),
                         F.lit(0).cast("bigint").alias("row"), F.col("audit").alias("text")).unionByName(
        rows.select("conv", F.lit(1).alias("kind"), "turn", "role", "h", "row", "text"))
    return both.repartition("conv").sortWithinPartitions("conv", "kind", "turn", "role", "h", "row").select(
        "conv", "kind", "role", "text")


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Iterator[tuple[str, str, str]]]]:
    flat = (r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns)))
    for conv, rows in groupby(flat, key=lambda r: r[0]):
        audit = next(rows)[3]
        yield conv, edited(audit, ((role, text) for _, _, role, text in rows))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def told():
        for conv, rows in _streamed(batches):
            digest, between = hashlib.sha256(), b""
            for _, role, text in rows:
                digest.update(between + f"{role}:{text}".encode())
                between = b"\n"
            yield conv, digest.hexdigest()

    yield from _batched(told(), [pa.string(), pa.string()], ["conv", "repaired_sha256"])


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = ((conv, place, *row) for conv, kept in _streamed(batches) for place, row in enumerate(kept))
    yield from _batched(rows, [pa.string(), pa.int64()] + [pa.string()] * 3, ["conv", "place", "edit", "role", "text"])


def _batched(rows: Iterator[tuple], kinds: list[pa.DataType], names: list[str]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == 512:
            yield pa.RecordBatch.from_arrays(_arrays(held, kinds), names=names)
            held = []
    yield pa.RecordBatch.from_arrays(_arrays(held, kinds), names=names)


def damaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
            text: str = "text") -> DataFrame:
    """``rows`` (those four columns) with planted faults, by the crc32 of ``conv:turn`` modulo 20:
    0 drops the row, 1 empties its text, 2 removes ``[.!?]``, 3 repeats it, 4 makes it the
    user's. Nulls are one space there, and in role and text of the result."""
    def plain(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(plain(conv), F.lit(":"), plain(turn)).cast("binary")) % 20
    return rows.select(
        F.col(conv), F.col(turn), F.when(kind == 4, "user").otherwise(plain(role)).alias(role),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(plain(text), "[.!?]", ""))
        .otherwise(plain(text)).alias(text),
        F.explode(F.array_repeat(F.lit(1), F.when(kind == 3, 2).when(kind == 0, 0).otherwise(1))).alias("__copy")
    ).drop("__copy")


def _key(conv: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(conv).cast("string")), F.lit("-"))


def _told(rows: DataFrame) -> DataFrame:
    """``rows`` (conv, turn, role, text, h, row) with blank, duplicate, truncated and the symbol;
    without the text."""
    bare = F.regexp_replace("text", f"[{WHITE}]+$", "")
    blank = F.length(F.regexp_replace("text", f"[{WHITE}]+", "")) == 0
    looked = rows.withColumns({"blank": blank, "open": ~F.substring(bare, -1, 1).isin(".", "!", "?"),
                               "mark": F.sha2("text", 256)})
    first = looked.where("not blank").groupBy("conv", "role", "mark").agg(
        F.min(F.struct("turn", "row")).alias("first")).select(F.col("first.row").alias("row"), F.lit(True).alias("new"))
    told = looked.drop("text", "mark").join(first, "row", "left").withColumn(
        "duplicate", ~F.col("blank") & F.col("new").isNull()).withColumn(
        "truncated", ~F.col("blank") & ~F.col("duplicate") & F.col("open"))
    initial = F.when(F.substring("role", 1, 1).isin("s", "u", "a"), F.substring("role", 1, 1)).otherwise("o")
    name = F.when(F.col("blank") | F.col("duplicate"), F.upper(initial)).when(
        F.col("truncated"), F.concat(initial, F.lit("!"))).otherwise(initial)
    symbol = F.create_map(*(F.lit(x) for pair in _CHARS.items() for x in pair))[name]
    return told.select("conv", "turn", "role", "h", "row", "blank", "duplicate", "truncated", symbol.alias("symbol"))


def repair(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           segment: int = SEGMENT) -> tuple[DataFrame, DataFrame]:
    """A report of each conversation of ``rows``, and the repaired rows.

    The report has the conversation's id, gaps (turns that are missing between its least and
    largest), blank, duplicate and truncated (rows with this as their first fault), illegal
    (neighbours whose initials are not su, ua or au), cost, audit (K keep, R other role, D delete,
    I insert; the ASCII-least of the cheapest) and repaired_sha256. The rows have the id, place
    (from 0), edit, role and text.

    Rows are ordered by turn (null first), those of one turn by role and a hash of the text. A
    blank row has nothing but white space; a duplicate repeats role and text of an earlier row; a
    truncated one does not end in ``.``, ``!`` or ``?``. Nulls in role and text are one space; a
    null id is one conversation, and null turns count in no gap. A role counts by its first
    letter; one without s, u or a there can only be replaced or deleted. Repeated rows are
    duplicates. An empty table gives empty results. Further columns are not read. Texts and
    conversations may be of any length, but a conversation's audit is one value.
    """
    with workspace() as put:
        plain = stored(with_package(rows).select(
            _key(conv).alias("conv"), F.col(turn).cast("bigint").alias("turn"),
            F.coalesce(F.col(role), F.lit(" ")).alias("role"), F.coalesce(F.col(text), F.lit(" ")).alias("text"),
        ).select("*", F.xxhash64("text").alias("h"), F.monotonically_increasing_id().alias("row")), "turns")
        told = put(_told(plain), "told")
        placed = numbered(told.select("conv", "turn", "role", "h", "row", "symbol"), "conv",
                          ["turn", "role", "h", "row"], put)
        pieces = put(placed.groupBy("conv", F.expr(f"idx div {segment}").alias("part")).agg(
            F.array_sort(F.collect_list(F.struct("idx", "symbol"))).alias("rows")).select(
            "conv", "part", F.array_join("rows.symbol", "").alias("sequence")), "sequences")
        distinct = put(pieces.select("sequence").distinct(), "distinct")
        matrices = put(_evaluated(distinct, learn_grammar(distinct)), "matrices")
        parts = put(pieces.join(matrices, "sequence").drop("sequence"), "parts")
        most = parts.agg(F.max("part")).first()[0] or 0
        while most:
            # Conversations of one part are finished; the others have a second one.
            several = parts.where("part = 1").select("conv")
            parts = put(parts.join(several, "conv", "left_anti").unionByName(
                _multiplied(parts.join(several, "conv", "left_semi"))), "products")
            most //= FAN
        answers = put(_answers(parts), "answers")
        spans = told.groupBy("conv", "turn").agg(
            *(F.count_if(c).alias(c) for c in ("blank", "duplicate", "truncated"))).groupBy("conv").agg(
            F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"),
            *(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")))
        streamed = _by_conversation(plain, answers)
        digests = put(streamed.mapInArrow(_digests, "conv string, repaired_sha256 string"), "digests")
        report = stored(answers.join(spans, "conv").join(digests, "conv"), "report")
        audits = stored(answers.select("conv", "audit"), "audits")
    kind = rows.schema[conv].dataType
    named = F.when(F.col("conv") != "-", F.substring("conv", 2, 1 << 30)).cast(kind).alias(conv)
    turns = _by_conversation(plain, audits).mapInArrow(
        _turns, "conv string, place bigint, edit string, role string, text string")
    return (report.select(named, "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"),
            turns.select(named, "place", "edit", "role", "text"))
