"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key under ``order``.

    Catalyst turns the ``row_number = 1`` filter into a window group limit that already runs
    before the exchange, so a key with many copies ships one row per input task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_rn", F.row_number().over(window))
        .filter(F.col("_rn") == 1)
        .drop("_rn")
    )


def latest_bar(bars: DataFrame) -> DataFrame:
    """Newest load of each (symbol, obs_date); equal load times fall back to all the values."""
    first = ["_ingested_at", "adj_close", "close", "volume"]
    rest = sorted(c for c in bars.columns if c not in (*first, "symbol", "obs_date"))
    return first_per_key(bars, ["symbol", "obs_date"], [F.desc(c) for c in (*first, *rest)])


def newest_listing(universe: DataFrame) -> DataFrame:
    """Newest listing per upper-cased ticker. No end date means still listed, which is newest."""
    return first_per_key(
        universe.withColumn("symbol", F.upper("ticker")), ["symbol"],
        [F.desc_nulls_first("end_date"), F.desc("start_date"), F.asc("exchange"),
         F.asc("price_currency")],
    ).select("symbol", "exchange", "price_currency")


def latest_snapshot(holdings: DataFrame) -> DataFrame:
    """Newest as_of_date per fund."""
    return holdings.groupBy("etf_symbol").agg(F.max("as_of_date").alias("as_of_date"))
