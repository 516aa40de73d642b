"""Places of rows in the order of their group, for groups of any size."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: monotonically_increasing_id() has the partition above so many bits of the row's place in it.
_PLACE_BITS = 33


def numbered(rows: DataFrame, group: str, order: Sequence[str], put: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """``rows`` with idx, their place in their group from 0 on, and n, the group's rows.

    The rows are dealt by ranges of (group, order), so a group of any size is spread over tasks;
    a row's place is its place in its range and what the ranges before hold of the group. Rows
    that are alike in all of it are told apart by where they were read, so copies spread too.
    """
    by = [group, *order, "__read"]
    ranged = put(rows.withColumn("__read", F.monotonically_increasing_id()).repartitionByRange(*by)
                 .sortWithinPartitions(*by).drop("__read")
                 .withColumn("__at", F.monotonically_increasing_id()), "ranged")
    ranged = ranged.withColumn("__range", F.shiftright("__at", _PLACE_BITS))
    share = ranged.groupBy(group, "__range").agg(F.min("__at").alias("__first"), F.count("*").alias("__m"))
    whole = Window.partitionBy(group)  # one row per range of the group
    before = F.coalesce(F.sum("__m").over(whole.orderBy("__range").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0))
    shares = share.select(group, "__range", "__first", before.alias("__before"),
                          F.sum("__m").over(whole).alias("n"))
    return ranged.join(shares, [group, "__range"]).select(
        *rows.columns, (F.col("__before") + F.col("__at") - F.col("__first")).alias("idx"), "n")
