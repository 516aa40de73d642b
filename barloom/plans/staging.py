"""Silver models: deduplicated, labelled, typed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.functions.columns import change, is_regular_session, market_time, trade_key
from barloom.operators.dedupe import first_per_key, latest_bar, newest_listing
from barloom.operators.timeseries import by_day


def stg_daily_bars(bars: DataFrame) -> DataFrame:
    """One row per (symbol, day) with its return. Serves fund and company bars alike.

    A full rebuild on purpose: adjusted history is rewritten after every corporate action.
    """
    return latest_bar(bars).withColumns({
        "div_cash": F.coalesce("div_cash", F.lit(0.0)),
        "split_factor": F.coalesce("split_factor", F.lit(1.0)),
        "daily_return": change(F.col("adj_close"), F.lag("adj_close").over(by_day())),
    })


stg_markets = stg_daily_bars
stg_company_prices = stg_daily_bars


def stg_etf_holdings(holdings: DataFrame, universe: DataFrame) -> DataFrame:
    """Holding lines with weights as fractions and a flag for lines that are listed stocks."""
    listed = newest_listing(universe.filter(F.col("asset_type") == "Stock"))
    lines = first_per_key(
        holdings, ["etf_symbol", "as_of_date", "position"],
        [F.desc("_ingested_at"), F.asc("holding_name"), F.desc("weight_pct")])
    return lines.join(listed.withColumn("_listed", F.lit(True)), "symbol", "left").select(
        "etf_symbol", "as_of_date", "position", "holding_name", "ticker", "symbol",
        "identifier", "sedol", (F.col("weight_pct") / 100).alias("weight"), "shares_held",
        "local_currency", F.coalesce("_listed", F.lit(False)).alias("is_equity"),
        "exchange", "price_currency", "_ingested_at",
    )


def stg_macro(macro: DataFrame, indicators: DataFrame) -> DataFrame:
    """Observations with a value, labelled. An unlabelled series stays, with null labels."""
    labels = indicators.select("series_id", "indicator_name", "category", "frequency", "units")
    return macro.filter(F.col("value").isNotNull()).join(labels, "series_id", "left").select(
        "series_id", "obs_date", "value",
        "indicator_name", "category", "frequency", "units", "_ingested_at")


def keyed_trades(quotes: DataFrame) -> DataFrame:
    """Trades with their key and market-time columns, duplicates still in."""
    return quotes.select(
        trade_key(F.col("symbol"), F.col("trade_time"), F.col("price"), F.col("volume"),
                  F.col("conditions")).alias("trade_key"),
        "symbol", "price", "volume", "conditions", "trade_ts",
        F.to_date(market_time(F.col("trade_ts"))).alias("trade_date"),
        is_regular_session(F.col("trade_ts")).alias("is_regular_session"),
        "_ingested_at",
    )


def stg_trades(quotes: DataFrame) -> DataFrame:
    """One row per trade key, the first ingest kept."""
    return first_per_key(keyed_trades(quotes), ["trade_key"], [F.asc("_ingested_at")])
