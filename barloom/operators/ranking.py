"""Ranks within groups, including groups too large for one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.operators.totals import running_before
from barloom.session import written


def rank_in_window(df: DataFrame, group: Sequence[str], ranks: Mapping[str, str]) -> DataFrame:
    """Rank 1 is the largest value; rows without a value get no rank and shift nobody.

    Nulls sort last, so masking them equals ranking the non-null rows alone, and every rank
    shares one exchange.
    """
    per_group = Window.partitionBy(*group)
    return df.withColumns({
        name: F.when(F.col(value).isNotNull(),
                     F.rank().over(per_group.orderBy(F.desc_nulls_last(value))))
        for name, value in ranks.items()
    })


def rank_across_tasks(df: DataFrame, group: Sequence[str], ranks: Mapping[str, str]) -> DataFrame:
    """The same ranks, exact, with a group's values spread over tasks by ranges.

    Equal values are folded into (value, copies), so a value that many rows share is one row; the
    rank of a value is one more than the copies of the values before it. Rows are told apart by
    a number, and ranks come back by that number: rows without a value take no part in any
    join on values. The input is read several times, so it is written out first.
    """
    group = list(group)
    keys = [*group, "_rank"]
    rows = written(df.withColumn("_row", F.monotonically_increasing_id()), "rank-input")
    valued = rows.select(*group, "_row", F.inline(F.array(*[
        F.struct(F.lit(name).alias("_rank"), F.col(value).alias("_value")) for name, value in ranks.items()]))
    ).filter(F.col("_value").isNotNull())
    values = valued.groupBy(*keys, "_value").agg(F.count("*").alias("_copies"))
    placed = running_before(values, keys, [F.desc("_value")], "_copies", "_above")
    # Null-safe, as a group may be null.
    same = [valued[c].eqNullSafe(placed[c]) for c in [*keys, "_value"]]
    ranked = valued.join(placed, same).select("_row", valued["_rank"], (F.col("_above") + 1).cast("int").alias("_position"))
    wide = ranked.groupBy("_row").agg(*(
        F.max(F.when(F.col("_rank") == name, F.col("_position"))).alias(name) for name in ranks))
    return rows.join(wide, "_row", "left").select(*df.columns, *ranks)
