"""Declared data tests. Each returns its failing rows; nulls fail only ``not_null``."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.quality.checks import duplicate_keys


def _where(df: DataFrame, where: str | None) -> DataFrame:
    return df.filter(where) if where else df


def null_value(column: str) -> Column:
    return F.col(column).isNull()


def outside_values(column: str, values: Sequence) -> Column:
    return ~F.col(column).isin(*values)


def outside_range(column: str, low=None, high=None, inclusive: bool = True) -> Column:
    value, bad = F.col(column), F.lit(False)
    if low is not None:
        bad = bad | (value < low if inclusive else value <= low)
    if high is not None:
        bad = bad | (value > high if inclusive else value >= high)
    return bad


def not_true(expression: str) -> Column:
    return ~F.expr(expression)


def test_not_null(df: DataFrame, column: str, where: str | None = None) -> DataFrame:
    return _where(df, where).filter(null_value(column))


def test_unique(df: DataFrame, column: str, where: str | None = None) -> DataFrame:
    return duplicate_keys(_where(df, where).filter(F.col(column).isNotNull()), [column])


def test_unique_combination(df: DataFrame, columns: Sequence[str],
                            where: str | None = None) -> DataFrame:
    return duplicate_keys(_where(df, where), columns)


def test_accepted_values(df: DataFrame, column: str, values: Sequence,
                         where: str | None = None) -> DataFrame:
    """Offending values with their number of rows."""
    return _where(df, where).filter(outside_values(column, values)).groupBy(column).agg(
        F.count("*").alias("n_rows"))


def test_relationships(df: DataFrame, column: str, parent: DataFrame, parent_column: str,
                       where: str | None = None) -> DataFrame:
    """Rows whose key has no parent; the anti join lets a hot key be split across tasks."""
    keys = parent.select(F.col(parent_column).alias(column)).distinct()
    return _where(df, where).filter(F.col(column).isNotNull()).join(keys, column, "left_anti")


def test_accepted_range(df: DataFrame, column: str, low=None, high=None, inclusive: bool = True,
                        where: str | None = None) -> DataFrame:
    return _where(df, where).filter(outside_range(column, low, high, inclusive))


def test_expression(df: DataFrame, expression: str, where: str | None = None) -> DataFrame:
    return _where(df, where).filter(not_true(expression))


@dataclass(frozen=True)
class Expectations:
    """The tests declared on one model."""

    not_null: Sequence[str] = ()
    not_null_where: Sequence[tuple[str, str]] = ()
    unique: Sequence[str] = ()
    unique_combination: Sequence[Sequence[str]] = ()
    accepted_values: dict[str, Sequence] = field(default_factory=dict)
    # (column, low, high, inclusive, where)
    accepted_range: Sequence[tuple] = ()
    expressions: Sequence[str] = ()
    # column -> (parent model, parent column)
    relationships: dict[str, tuple[str, str]] = field(default_factory=dict)

    def count(self) -> int:
        return sum(len(getattr(self, f)) for f in self.__dataclass_fields__)

    def row_rules(self) -> dict[str, Column]:
        """Tests that look at one row at a time, as failure predicates."""
        rules = {f"not_null:{c}": null_value(c) for c in self.not_null}
        rules |= {f"not_null:{c}": F.expr(w) & null_value(c) for c, w in self.not_null_where}
        rules |= {f"accepted_values:{c}": outside_values(c, v)
                  for c, v in self.accepted_values.items()}
        for column, low, high, inclusive, where in self.accepted_range:
            bad = outside_range(column, low, high, inclusive)
            rules[f"accepted_range:{column}"] = bad if where is None else F.expr(where) & bad
        rules |= {f"expression:{e}": not_true(e) for e in self.expressions}
        return rules


def run_expectations(model: str, df: DataFrame, tests: Expectations,
                     models: dict[str, DataFrame]) -> DataFrame:
    """(model, test, failures) for every declared test.

    All row-level tests share a single pass over the model; key tests each need their own.
    """
    parts: list[DataFrame] = []
    rules = tests.row_rules()
    if rules:
        counts = df.agg(*[F.count_if(bad).alias(f"t{i}") for i, bad in enumerate(rules.values())])
        parts.append(counts.select(F.inline(F.array(*[
            F.struct(F.lit(model).alias("model"), F.lit(name).alias("test"),
                     F.col(f"t{i}").alias("failures"))
            for i, name in enumerate(rules)]))))

    def counted(name: str, failing: DataFrame) -> DataFrame:
        return failing.agg(F.count("*").alias("failures")).select(
            F.lit(model).alias("model"), F.lit(name).alias("test"), "failures")

    parts += [counted(f"unique:{c}", test_unique(df, c)) for c in tests.unique]
    parts += [counted(f"unique_combination:{','.join(k)}", test_unique_combination(df, k))
              for k in tests.unique_combination]
    parts += [counted(f"relationships:{c}", test_relationships(df, c, models[parent], column))
              for c, (parent, column) in tests.relationships.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
