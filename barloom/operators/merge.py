"""Merge-style operators: each takes the stored state and returns the next state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from barloom.functions.columns import differs
from barloom.operators.dedupe import first_per_key

KEPT, UPDATED, INSERTED = "kept", "updated", "inserted"


def _unique_rows(df: DataFrame, keys: Sequence[str], side: str) -> DataFrame:
    """Rows packed per key; fails on a repeated key, as a merge must.

    Grouping hashes by the join keys, so the check shares the join's exchange.
    """
    packed = df.groupBy(*keys).agg(
        F.count("*").alias("_n"), F.any_value(F.struct(*df.columns)).alias(side))
    return packed.select(
        *keys,
        F.when(F.col("_n") == 1, F.col(side))
        .otherwise(F.raise_error(F.concat(
            F.lit("repeated merge key "), F.to_json(F.struct(*keys)))).cast(df.schema))
        .alias(side),
    )


def _checked(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df``; fails on a repeated key, as a merge must. Rows are counted in a window over the
    join keys, so the check shares the join's exchange and sort, and columns stay flat."""
    copies = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    repeated = F.raise_error(F.concat(F.lit("repeated merge key "), F.to_json(F.struct(*keys))))
    return df.withColumn("_new", F.when(copies == 1, F.lit(True)).otherwise(repeated.cast("boolean")))


def upsert_actions(target: DataFrame, incoming: DataFrame, keys: Sequence[str],
                   change_cols: Sequence[str] | None = None) -> DataFrame:
    """Next state of ``target`` with a ``_action`` column.

    New keys are inserted. A matched row is replaced as a whole, but only if one of
    ``change_cols`` differs null-safely; ``None`` always replaces.
    """
    keys = list(keys)
    rest = [c for c in target.columns if c not in keys]
    old = target.select(*keys, *(F.col(c).alias(f"_old_{c}") for c in rest), F.lit(True).alias("_old"))
    new = _checked(incoming.select(*target.columns), keys).withColumnsRenamed({c: f"_new_{c}" for c in rest})
    moved = F.lit(change_cols is None)
    for c in change_cols or ():
        if c not in keys:
            moved |= ~F.col(f"_old_{c}").eqNullSafe(F.col(f"_new_{c}"))
    action = (
        F.when(F.col("_old").isNull(), INSERTED)
        .when(F.col("_new").isNotNull() & moved, UPDATED)
        .otherwise(KEPT)
    )
    joined = old.join(new, keys, "full_outer").withColumn("_action", action)
    take = lambda c: F.when(F.col("_action") == KEPT, F.col(f"_old_{c}")).otherwise(F.col(f"_new_{c}"))
    return joined.select(*(F.col(c) if c in keys else take(c).alias(c) for c in target.columns), "_action")


def observed_upsert(target: DataFrame, incoming: DataFrame, keys: Sequence[str],
                    change_cols: Sequence[str] | None = None) -> tuple[DataFrame, Observation]:
    """The next state, and its counts (inserted, updated, kept) once that has been written: they
    are taken while the rows go by, without a second read."""
    counts = Observation()
    actions = upsert_actions(target, incoming, keys, change_cols)
    return actions.observe(counts, *(
        F.count_if(F.col("_action") == a).alias(a) for a in (INSERTED, UPDATED, KEPT))).drop("_action"), counts


def upsert(target: DataFrame, incoming: DataFrame, keys: Sequence[str],
           change_cols: Sequence[str] | None = None) -> DataFrame:
    return upsert_actions(target, incoming, keys, change_cols).drop("_action")


def action_counts(actions: DataFrame) -> DataFrame:
    """Inserted and updated row counts, one row."""
    return actions.agg(
        F.count_if(F.col("_action") == INSERTED).alias("inserted"),
        F.count_if(F.col("_action") == UPDATED).alias("updated"),
    )


def insert_only(target: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add rows whose key is not stored yet; stored rows never change. Of incoming rows with one
    key the largest by value is taken."""
    rest = [F.desc(c) for c in incoming.columns if c not in keys]
    fresh = first_per_key(incoming, list(keys), rest or [F.lit(1)]).join(
        target.select(*keys), list(keys), "left_anti")
    return target.unionByName(fresh)


def newer_than(df: DataFrame, column: str, target: DataFrame, target_column: str,
               floor: str, inclusive: bool = False) -> DataFrame:
    """Rows past the target's high-water mark; an empty target lets everything through.

    The mark is a scalar subquery, so it reaches the scan as a literal filter and nothing is
    collected.
    """
    kind = target.schema[target_column].dataType
    mark = target.agg(
        F.coalesce(F.max(target_column), F.lit(floor).cast(kind)).alias("mark")).scalar()
    value = F.col(column)
    return df.filter(value >= mark if inclusive else value > mark)


def scd2(history: DataFrame, source: DataFrame, key: str, check_cols: Sequence[str],
         now) -> DataFrame:
    """Next type-2 history.

    A current version closes when a check column changed or its key vanished from the source;
    changed and unseen keys open a version. Other columns never open one.
    """
    now = F.lit(now).cast("timestamp")
    attrs = [c for c in history.columns if c not in ("valid_from", "valid_to")]
    current = history.filter(F.col("valid_to").isNull())
    closed = history.filter(F.col("valid_to").isNotNull())

    have, seen = F.col("_old"), F.col("_new")
    opens = have.isNull() | (seen.isNotNull() & differs(have, seen, check_cols))
    ends = seen.isNull() | opens
    forever = F.lit(None).cast("timestamp")
    fields = lambda side: [side[c].alias(c) for c in attrs]
    kept = F.when(have.isNotNull(), F.struct(
        *fields(have), have["valid_from"].alias("valid_from"),
        F.when(ends, now).otherwise(forever).alias("valid_to")))
    opened = F.when(opens & seen.isNotNull(), F.struct(
        *fields(seen), now.alias("valid_from"), forever.alias("valid_to")))
    paired = (
        current.select(key, F.struct(*current.columns).alias("_old"))
        .join(_unique_rows(source.select(*attrs), [key], "_new"), key, "full_outer")
    )
    versions = paired.select(F.inline(F.filter(F.array(kept, opened), lambda v: v.isNotNull())))
    return closed.unionByName(versions.select(*history.columns))


def first_snapshot(source: DataFrame, now) -> DataFrame:
    return source.withColumns({
        "valid_from": F.lit(now).cast("timestamp"),
        "valid_to": F.lit(None).cast("timestamp"),
    })
