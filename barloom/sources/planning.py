"""What to pull next: watermarks, refresh order, corporate actions, the company list.

Everything stays a DataFrame; key lists and watermarks are never turned into driver dicts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom import constants as C
from barloom.operators.dedupe import latest_snapshot
from barloom.operators.totals import running_before


def watermarks(table: DataFrame, key: str, date: str) -> DataFrame:
    """(key, watermark): newest date loaded per key."""
    return table.groupBy(key).agg(F.max(date).alias("watermark"))


def pull_starts(keys: DataFrame, marks: DataFrame, key: str, backfill_start: str | None,
                lookback_days: int = 0) -> DataFrame:
    """First date to pull per key; a key never loaded starts at the backfill date."""
    start = F.date_sub("watermark", lookback_days)
    backfill = F.lit(backfill_start).cast("date")
    return keys.join(marks, key, "left").select(
        key, "watermark", F.coalesce(start, backfill).alias("pull_start"))


def newest_date(table: DataFrame, column: str) -> DataFrame:
    """One row: the newest date of a table without keys, null for an empty one. A pull from that
    day on brings the day's rows again; an insert-only merge drops them."""
    return table.agg(F.to_date(F.max(column)).alias("pull_start"))


def refresh_worklist(keys: DataFrame, marks: DataFrame, key: str, budget: int) -> DataFrame:
    """Never-loaded keys first, then the oldest, names breaking ties; 0 means no budget."""
    queue = keys.join(marks, key, "left").orderBy(F.asc_nulls_first("watermark"), F.asc(key))
    return queue.limit(budget) if budget else queue


def within_budget(queue: DataFrame, order: list, cost: str, budget: int) -> DataFrame:
    """The part of a queue that a run can start before its requests are used up; 0 means no limit.

    A row is taken while the costs of the rows before it are below the budget, so the last one
    may go over it. The queue is cut by running totals over its ranges and may be of any length;
    ``order`` must tell rows apart.
    """
    if not budget:
        return queue
    return running_before(queue, [], order, cost, "requests_before").filter(
        F.col("requests_before") < budget).drop("requests_before")


def pull_costs(keys: DataFrame, acted: DataFrame, key: str = "symbol") -> DataFrame:
    """``keys`` with the requests a pull takes: one, and another for the history of a symbol with
    a corporate action."""
    again = acted.select(key, F.lit(True).alias("_acted")).distinct()
    return keys.join(again, key, "left").withColumn(
        "requests", F.when(F.col("_acted"), 2).otherwise(1)).drop("_acted")


def corporate_actions(incoming: DataFrame, marks: DataFrame) -> DataFrame:
    """Symbols whose stored history must be replaced.

    A new row, strictly past the watermark, pays a dividend or is not an exact 1:1 split. A
    missing dividend is none, a missing split factor counts as one.
    """
    pays = F.coalesce("div_cash", F.lit(0.0)) != 0
    splits = ~F.col("split_factor").eqNullSafe(F.lit(1.0))
    return (
        incoming.join(marks, "symbol")
        .filter((F.col("obs_date") > F.col("watermark")) & (pays | splits))
        .select("symbol").distinct()
    )


def bars_to_load(incoming: DataFrame, history: DataFrame, marks: DataFrame) -> DataFrame:
    """Incremental rows, replaced by the full history for symbols with a corporate action."""
    acted = corporate_actions(incoming, marks)
    return incoming.join(acted, "symbol", "left_anti").unionByName(
        history.join(acted, "symbol", "left_semi"))


def priced_companies(holdings: DataFrame, universe: DataFrame) -> DataFrame:
    """Stocks in each fund's latest snapshot that the universe lists."""
    stocks = (universe.filter(F.col("asset_type") == "Stock")
              .select(F.upper("ticker").alias("symbol")).distinct())
    return (
        holdings.join(latest_snapshot(holdings), ["etf_symbol", "as_of_date"])
        .select("symbol").distinct()
        .join(stocks, "symbol", "left_semi")
    )


def company_pull_plan(holdings: DataFrame, universe: DataFrame, prices: DataFrame,
                      budget: int = C.COMPANY_BUDGET, backfill_start: str = C.COMPANY_BACKFILL,
                      acted: DataFrame | None = None) -> DataFrame:
    """The next run's companies with their pull starts, as many as its requests allow. ``acted``
    are symbols with a corporate action, whose pull takes two requests."""
    marks = watermarks(prices, "symbol", "obs_date")
    queue = refresh_worklist(priced_companies(holdings, universe), marks, "symbol", 0 if acted is not None else budget)
    if acted is not None:
        queue = within_budget(pull_costs(queue, acted), [F.asc_nulls_first("watermark"), F.asc("symbol")],
                              "requests", budget)
    return pull_starts(queue.select("symbol"), marks, "symbol", backfill_start)
