"""Repeated and nearly repeated lines of a corpus, by an exact set-similarity join.

A line is the set of its words, ordered by a hash. Two sets of the wanted similarity differ in few
words, and each of those parts two triples of neighbouring shared words at most; so they must have
several triples of neighbours in common. Of its triples a line keeps those with the longest words,
which are mostly rare, as many as make sure that some common ones are among them on both sides. Three
words that are neighbours by a hash seldom meet again by chance, so a line meets few others but those
that are like it. For pairs that share enough triples the Jaccard similarity is taken from the lines
themselves, first for the one that shares most, then for the others if that one is not similar.

Lines of equal sets are one class with its first line in front, so copies are never paired.
Each line is first held against a few of the earliest lines of each of its triples; in a
large group of similar lines nearly all are settled by that. Only lines without a match that have
more lines before them then meet all earlier lines that share a triple with them.

Sets are made from the texts three times, for the classes, the triples and the pairs: words are
more than the text, and moving or keeping them would need several times its disk.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.storage import stored, workspace

Put = Callable[[DataFrame, str], DataFrame]

#: Least similarity, as a fraction in whole numbers.
SIMILAR, OF = 4, 5
#: Triples that a pair must share besides the first. Each is one more for a line to keep.
MORE = 1
#: Sets of at most so many words go by couples of neighbours too, as two of them may share no triple.
FEW = 5
#: Earliest lines of a triple that every line is held against first.
PIVOTS = 16
#: Parts of the triples that are gone through one after the other, so that the postings of one part
#: only are on disk at a time.
PARTS = 4
#: Lines meet in parts of at most so many meetings for each posting (and of at least so many meetings),
#: so that what is counted of a part stays in proportion to the postings.
MEETINGS, LEAST_MEETINGS = 3, 1_000_000
WHITE = "\t\n\v\f\r"


def _words(text: Column | str) -> Column:
    blank = F.lower(text)
    for c in WHITE:  # a single blank is the cheapest to split at
        blank = F.replace(blank, F.lit(c), F.lit(" "))
    return F.array_remove(F.split(blank, " "), "")


def tokens(line: Column) -> Column:
    """The line's different words as ascending numbers: 53 bits of the word's hash in front of 42
    less its bytes, at least 0. Three of them can be added up."""
    def token(w: Column) -> Column:
        short = F.greatest(42 - F.octet_length(w), F.lit(0)).cast("bigint")
        return F.shiftleft(F.shiftrightunsigned(F.xxhash64(w), 11), 8).bitwiseOR(short)

    return F.sort_array(F.array_distinct(F.transform(_words(line), token)))


def _least_overlap(a: Column, b: Column) -> Column:
    """Words that two sets of these sizes must share."""
    return F.ceil((a + b) * SIMILAR / (SIMILAR + OF))


def _same(a: DataFrame, b: DataFrame) -> Column:
    return a["id"].eqNullSafe(b["id"]) & (a["row"] == b["row"])


def _distinct_rows(docs: DataFrame, id_column: str, text: str, put: Put) -> DataFrame:
    """(id, t): one row for all that agree in id and text. As id the row's place: by id, null
    last, rows of one id by a hash of their text."""
    rows = docs.select(F.col(id_column).alias("id"), F.xxhash64(text).alias("row"), F.col(text).alias("t"))
    again = put(rows.groupBy("id", "row").agg(F.count("*").alias("n")).where("n > 1").select("id", "row"), "again")
    one = rows.join(again, _same(rows, again), "left_semi").groupBy("id", "row").agg(F.first("t").alias("t"))
    place = F.struct(F.col("id").isNull().alias("no_id"), "id", "row")
    return rows.join(again, _same(rows, again), "left_anti").unionByName(one).select(place.alias("id"), "t")


def line_table(rows: DataFrame, put: Put) -> DataFrame:
    """One row per line with a word: f, a number that ascends with (id, line), the row's key as id,
    line (from 0), n words and the set's two hashes."""
    lines = rows.select("id", F.posexplode(F.split("t", "\n")).alias("line", "t")
    ).where(F.length(F.btrim("t", F.lit(" " + WHITE))) > 0)
    made = lines.select("id", "line", tokens(F.col("t")).alias("tokens"))
    sets = put(made.select("id", "line", F.size("tokens").alias("n"), F.xxhash64("tokens").alias("k1"),
                           F.xxhash64(F.lit(1), "tokens").alias("k2")), "lines")
    placed = sets.repartitionByRange("id", "line").sortWithinPartitions("id", "line")
    return put(placed.select(F.monotonically_increasing_id().alias("f"), "*"), "placed")


def _sets(lines: DataFrame, rows: DataFrame) -> DataFrame:
    """(f, tokens) for ``lines`` (f, id, line), from the texts."""
    per_doc = lines.groupBy("id").agg(F.collect_list(F.struct("line", "f")).alias("used"))  # at most a text's lines
    # Merged, as the lists are far larger than Spark takes them to be.
    return rows.hint("merge").join(per_doc, "id").select(
        F.explode("used").alias("at"), F.split("t", "\n").alias("all")).select(
        "at.f", tokens(F.element_at("all", F.col("at.line") + 1)).alias("tokens"))


def _grams(words: Column) -> Column:
    """The triples of neighbours that a line keeps, as numbers.

    Let sets of a and b words share s, with s / (a + b - s) at least t = SIMILAR / OF. The other
    d = a + b - 2s words part at most 2d of the s - 2 triples of neighbouring shared words. Of the a - 2
    triples of the first set, without k - 1 of those that are shared, 3a + 2b - 5s + k are left to be taken
    before the k-th shared one in any order that is the same for all lines. That is at most
    3 * (1 - t) * a + k, as b is at least t * a. Two sets share no triple for certain if one has
    FEW words and the other one less; these share two couples.
    """
    moved = lambda k, n: F.slice(words, k, F.size(words) - n + 1)
    # The low bits of a sum tell how short the three words are; they go in front.
    triple = lambda x, y: F.shiftleft(x + y, 56).bitwiseOR(F.shiftrightunsigned(x + y, 8))
    triples = F.zip_with(F.zip_with(moved(1, 3), moved(2, 3), lambda x, y: x + y), moved(3, 3), triple)
    kept = F.slice(F.sort_array(triples), F.lit(1),
                   F.floor(3 * F.size(words) * (OF - SIMILAR) / OF).cast("int") + 1 + MORE)
    couples = F.zip_with(moved(1, 2), moved(2, 2), lambda x, y: F.xxhash64(x, y))
    return F.when(F.size(words) > FEW, kept).otherwise(F.concat(kept, couples))


def _postings(led: DataFrame, part: int) -> DataFrame:
    """(gram, f, n): what each line keeps."""
    return led.select("f", "n", F.explode("grams").alias("gram")).where(F.pmod("gram", F.lit(PARTS)) == part)


def _meetings(led: DataFrame, put: Put) -> DataFrame:
    """(gram, f, n, nth) for the triples of more than one line, nth being the line's place among
    them."""
    place = Window.partitionBy("gram").orderBy("f")
    found = None
    for part in range(PARTS):
        met = _postings(led, part).withColumns({"nth": F.row_number().over(place), "next": F.lead("f").over(place)})
        met = put(met.where("nth > 1 or next is not null").drop("next"), "met")
        found = met if found is None else found.unionByName(met)
    return found


def _candidates(left: DataFrame, right: DataFrame) -> DataFrame:
    """(f, of, shared): the lines of ``left`` with the earlier ones of ``right`` that share enough triples."""
    a, b = F.col("n"), F.col("of_n")
    certain = 5 * _least_overlap(a, b) - 2 * (a + b) - 2
    met = left.select("gram", "f", "n").join(
        right.select("gram", F.col("f").alias("of"), F.col("n").alias("of_n")).hint("merge"), "gram").where(
        (F.col("of") < F.col("f")) & (F.least(a, b) * OF >= F.greatest(a, b) * SIMILAR))
    return met.groupBy("f", "of").agg(
        F.count("*").alias("shared"), F.min(F.least(certain, F.lit(MORE + 1))).alias("need")
    ).where("shared >= need").select("f", "of", "shared")


def _pairs(left: DataFrame, right: DataFrame, most: int | None, put: Put) -> DataFrame:
    """The candidates of ``left``, whose lines have at most ``most`` lines of a triple before them in
    ``right``, in parts by the line."""
    before = F.col("nth") - 1
    meetings = left.agg(F.coalesce(F.sum(before if most is None else F.least(before, F.lit(most))), F.lit(0))).first()[0]
    parts = 1 + meetings // max(LEAST_MEETINGS, MEETINGS * right.count())
    found = None
    for part in range(parts):
        pairs = put(_candidates(left.where(F.pmod(F.xxhash64("f"), F.lit(parts)) == part), right), "pairs")
        found = pairs if found is None else found.unionByName(pairs)
    return found


def _compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` with their jaccard; null if it is too small."""
    of = sets.select(F.col("f").alias("of"), F.col("tokens").alias("of_tokens"))
    shared = F.size(F.array_intersect("tokens", "of_tokens"))
    both = F.size("tokens") + F.size("of_tokens")
    counted = pairs.join(sets, "f").join(of, "of").select(*pairs.columns, shared.alias("both"), (both - shared).alias("all"))
    return counted.select(*pairs.columns, F.when(
        F.col("both") * OF >= F.col("all") * SIMILAR, F.col("both") / F.col("all")).alias("jaccard"))


def _verified(pairs: DataFrame, names: DataFrame, rows: DataFrame, put: Put) -> DataFrame:
    """(f, of, jaccard): a similar earlier line for each line that has one."""
    used = pairs.select("f").unionByName(pairs.select(F.col("of").alias("f"))).distinct()
    sets = put(_sets(names.select("f", "id", "line").join(used, "f", "left_semi"), rows), "sets")
    likely = pairs.groupBy("f").agg(F.max(F.struct("shared", (-F.col("of")).alias("of"))).alias("best"), F.count("*").alias("n"))
    tried = put(_compared(likely.select("f", (-F.col("best.of")).alias("of"), "n"), sets), "tried")
    others = tried.where("jaccard is null and n > 1").select("f", F.col("of").alias("not"))
    rest = pairs.join(others, "f").where("of != not").select("f", "of")
    similar = _compared(rest, sets).where("jaccard is not null").groupBy("f").agg(
        F.min(F.struct("of", "jaccard")).alias("found")).select("f", "found.*")
    return tried.where("jaccard is not null").select("f", "of", "jaccard").unionByName(similar)


def repeated_lines(docs: DataFrame, id_column: str = "doc_id", text: str = "text", of: bool = True) -> DataFrame:
    """(id, row, line, of_id, of_row, of_line, jaccard) for each line that an earlier line of the
    corpus matches.

    Lines are split at \\n and numbered from 0; the order is by id (null last), rows of one id by
    ``row``, a hash of the text, then by number. Two lines match
    if the Jaccard similarity of their sets of words (between ASCII white space, lower-cased) is
    at least SIMILAR/OF. A line with a match is listed whether or not the earlier line is listed
    itself; of_id and of_line name the first line of the same set, else the earliest match found.
    Lines without a word match nothing. A null text has no lines. Rows that share an id are
    documents of their own; rows with one id and one text are one document, whose lines are listed
    once. An empty table gives no rows; other columns are not read. Without ``of`` only (id, row,
    line) are given.
    """
    with workspace() as put:
        found = stored(_repeated(docs, id_column, text, put, of), "repeated")
    matched = [F.col("of_id.id").alias("of_id"), F.col("of_id.row").alias("of_row"), "of_line", "jaccard"] if of else []
    return found.select("id.id", "id.row", "line", *matched)


def _repeated(docs: DataFrame, id_column: str, text: str, put: Put, of: bool = True) -> DataFrame:
    rows = _distinct_rows(docs, id_column, text, put)
    with workspace() as brief:
        table = line_table(rows, brief)
        leads = table.groupBy("k1", "k2").agg(F.min("f").alias("of"))
        names = put(table.join(leads, ["k1", "k2"]).select("f", "id", "line", "of", "n"), "names")
        # Of a class its first line only goes on. A set of fewer words than SIMILAR is similar to none but itself.
        firsts = _sets(names.where((F.col("f") == F.col("of")) & (F.col("n") >= SIMILAR)), rows)
        led = brief(firsts.select("f", F.size("tokens").alias("n"), _grams(F.col("tokens")).alias("grams")), "led")
        met = _meetings(led, put)
    settled = put(_verified(_pairs(met, met.where(F.col("nth") <= PIVOTS), PIVOTS, put), names, rows, put), "settled")
    # What is left meets all earlier lines, if one of its triples had others before it than the pivots.
    crowded = met.where(F.col("nth") > PIVOTS + 1).select("f").distinct().join(settled.select("f"), "f", "left_anti")
    left = put(met.join(crowded, "f", "left_semi"), "left")
    late = _verified(_pairs(left, met, None, put), names, rows, put)
    copies = names.where("f != of").select("f", "of", F.lit(1.0).alias("jaccard"))
    matched = copies.unionByName(settled).unionByName(late)
    found = matched.join(names.select("f", "id", "line"), "f")
    if not of:
        return found.select("id", "line")
    return found.join(names.select(F.col("f").alias("of"), F.col("id").alias("of_id"), F.col("line").alias("of_line")), "of").select(
        "id", "line", "of_id", "of_line", "jaccard")


def without_repeats(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without their repeated lines; every row stays, if need be with an empty text. Of
    rows with one id and one text the first keeps its lines, and the others have lines without a
    word only."""
    gone = repeated_lines(docs, id_column, text, of=False).groupBy("id", "row").agg(F.collect_set("line").alias("__gone"))
    hashed = docs.select(*docs.columns, F.col(id_column).alias("__id"), F.xxhash64(text).alias("__row"))
    key = lambda df: df.select(F.col("id").alias("__i"), F.col("row").alias("__r"), *df.columns[2:])
    same = F.col("__id").eqNullSafe(F.col("__i")) & (F.col("__row") == F.col("__r"))
    again = key(hashed.groupBy(F.col("__id").alias("id"), F.col("__row").alias("row")).agg(
        F.count("*").alias("n")).where("n > 1").drop("n"))
    once = hashed.join(again, same, "left_anti").withColumn("__again", F.lit(False))
    # Equal rows are counted, so that a group of any size is small before one of it is chosen.
    several = hashed.join(again, same, "left_semi").groupBy(*hashed.columns).agg(F.count("*").alias("__n"))
    nth = F.row_number().over(Window.partitionBy("__id", "__row").orderBy(F.xxhash64(*docs.columns)))
    copies = several.withColumn("__nth", nth).select(
        *hashed.columns, "__nth", F.explode(F.sequence(F.lit(1), F.col("__n").cast("int"))).alias("__copy")).select(
        *hashed.columns, ((F.col("__nth") > 1) | (F.col("__copy") > 1)).alias("__again"))
    joined = once.unionByName(copies).join(key(gone).hint("merge"), same, "left")
    lines = F.split(text, "\n")
    blank = lambda x: F.length(F.btrim(x, F.lit(" " + WHITE))) == 0
    dropped = F.coalesce("__gone", F.array().cast("array<int>"))
    kept = F.array_join(F.filter(lines, lambda x, k: F.when(F.col("__again"), blank(x)).otherwise(
        ~F.array_contains(dropped, k))), "\n")
    return joined.select(*(
        F.when(F.col("__gone").isNull() & ~F.col("__again"), F.col(text)).otherwise(kept).alias(c)
        if c == text else F.col(c) for c in docs.columns))
