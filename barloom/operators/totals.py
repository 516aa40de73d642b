"""Running totals over ordered groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.session import written


def running_before(df: DataFrame, group: Sequence[str], order: Sequence[Column], amount: str, name: str) -> DataFrame:
    """``df`` with ``name``: the sum of ``amount`` over the rows before each row in its group.

    Rows are dealt by ranges of (group, order), so a group is spread over as many tasks as it
    needs. A row's total is that of the rows before it in its range plus those of the ranges
    before; the window over ranges sees one row per range and group. Rows that are equal in the
    order share a range, so fold them first where there may be many.
    """
    group = list(group)
    ranged = written(df.repartitionByRange(*group, *order).withColumn("_range", F.spark_partition_id()), "ranges")
    earlier = lambda w: F.coalesce(F.sum(w[0]).over(
        w[1].rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shares = ranged.groupBy(*group, "_range").agg(F.sum(amount).alias("_share"))
    below = shares.select(*group, "_range", earlier(("_share", Window.partitionBy(*group).orderBy("_range"))).alias("_below"))
    inside = ranged.withColumn(
        "_inside", earlier((amount, Window.partitionBy(*group, "_range").orderBy(*order))))
    same = [inside[c].eqNullSafe(below[c]) for c in [*group, "_range"]]  # a group may be null
    return inside.join(below, same).select(
        *(inside[c] for c in df.columns), (F.col("_inside") + F.col("_below")).alias(name))
