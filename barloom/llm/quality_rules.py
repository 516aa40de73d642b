"""Quality rules as a short-circuit cascade.

Every rule is tried on a sample first: how long it takes and how much it rejects. The cascade
then runs the rules by rejections per cost, best first, and stops at the first that rejects.
The order changes the time only, never the verdict: a text is kept if no rule rejects it.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.columns import add_columns

WHITE = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"
#: Rows on which cost and selectivity are estimated.
SAMPLE_ROWS = 2000
WINDOW = 5


class Measures:
    """What the rules look at, each computed when first asked for."""

    def __init__(self, text: str | None):
        self.text = text or ""

    @cached_property
    def words(self) -> list[bytes]:
        return self.text.encode().split()  # of bytes: ASCII white space only

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - sum(map(self.text.count, WHITE))

    @cached_property
    def n_symbols(self) -> int:
        return sum(map(self.text.count, SYMBOLS))

    @cached_property
    def lines(self) -> list[str]:
        return [line for line in self.text.split("\n") if line.strip(WHITE)]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        w = self.words
        last = len(w) - WINDOW + 1
        if last < 2:
            return 0
        windows = list(zip(*(w[k:last + k] for k in range(WINDOW))))
        if len(set(windows)) == last:
            return 0
        seen: dict[tuple, int] = {}
        for window in windows:
            seen[window] = seen.get(window, 0) + 1
        covered, end = 0, 0
        for k, window in enumerate(windows):
            if seen[window] > 1:
                covered += k + WINDOW - max(end, k)
                end = k + WINDOW
        return covered

    @cached_property
    def capitals(self) -> float:
        letters = sum(map(str.isalpha, self.text))
        return sum(map(str.isupper, self.text)) / letters if letters else 0.0


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Measures], bool]


BASE_RULES = (
    Rule("few_words", lambda m: m.n_words < 10),
    Rule("repeated_words", lambda m: 100 * m.n_repeat_words > 20 * m.n_words),
)
#: More rules, wide enough to leave ordinary prose of any language alone.
RULES = BASE_RULES + (
    Rule("symbols", lambda m: 10 * m.n_symbols > 3 * m.n_words),
    Rule("duplicate_lines", lambda m: len(m.lines) >= 4 and 2 * m.n_dup_lines > len(m.lines)),
    Rule("word_length", lambda m: m.word_chars > 40 * m.n_words),
    Rule("capitals", lambda m: m.n_words >= 10 and m.capitals > 0.6),
)
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def rule_figures(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text",
                 sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per rule: rows of the sample, nanoseconds spent, rows rejected.

    The sample is about ``sample_rows`` rows drawn in place, so no text is moved. Each rule is timed with
    nothing computed before, so a measure that two rules share counts for both.
    """
    columns = ", ".join(f"cost_{k} bigint, rejected_{k} int" for k in range(len(rules)))

    def make():
        def compute(texts):
            for t in texts:
                row: list[int] = []
                for rule in rules:
                    measures, start = Measures(t), time.perf_counter_ns()
                    rejected = rule.rejects(measures)
                    row += [time.perf_counter_ns() - start, int(rejected)]
                yield tuple(row)
        return compute

    share = min(1.0, sample_rows / max(1, docs.count()))
    sample = docs.select(text).sample(share, seed=1)
    timed = add_columns(sample, text, columns, make, keep=[])
    sums = timed.agg(F.count("*").alias("n"), *(F.sum(c).alias(c) for c in timed.columns))
    each = F.array(*(F.struct(
        F.lit(r.name).alias("rule"), F.col("n"),
        F.coalesce(f"cost_{k}", F.lit(0)).cast("bigint").alias("nanoseconds"),
        F.coalesce(f"rejected_{k}", F.lit(0)).cast("bigint").alias("rejected"))
        for k, r in enumerate(rules)))
    return sums.select(F.explode(each).alias("r")).select("r.*")


def rule_order(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text",
               sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Rules by rejections per nanosecond on the sample, best first."""
    found = {r.rule: r.rejected / max(1, r.nanoseconds)
             for r in rule_figures(docs, rules, text, sample_rows).collect()}  # one row per rule
    return sorted(rules, key=lambda r: -found[r.name])


def cascade(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text",
            sample_rows: int = SAMPLE_ROWS, keep: list[str] | None = None,
            complete: bool = False) -> DataFrame:
    """Each row of ``docs`` with kept, rejected_by and the measures.

    rejected_by names the first rule in cascade order that rejected the text, null if none did.
    A measure no rule had to look at is null, unless ``complete``. A null text has no words and
    is rejected like an empty one. Rows are independent: repeated rows repeat their results, an
    empty table gives an empty one, columns named like results are replaced, and a text of any
    length is read whole.
    """
    ordered = rule_order(docs, rules, text, sample_rows)

    def make():
        def compute(texts):
            for t in texts:
                m = Measures(t)
                by = next((r.name for r in ordered if r.rejects(m)), None)
                yield (by is None, by, *(getattr(m, c) if complete else m.__dict__.get(c)
                                         for c in MEASURES))
        return compute

    columns = "kept boolean, rejected_by string, " + ", ".join(f"{c} bigint" for c in MEASURES)
    return add_columns(docs, text, columns, make, keep)
