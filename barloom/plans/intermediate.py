"""Shared building blocks between silver and gold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.operators.timeseries import as_of_values, carry_forward, trailing_returns


def int_macro_daily(stg_macro: DataFrame, as_of_date) -> DataFrame:
    """Every series on a daily calendar with 3- and 12-month changes.

    Changes belong to the observation and are carried with it. "As of" is the observation date,
    not the release date, so a monthly value shows before it was published.
    """
    obs = stg_macro.select("series_id", "obs_date", "value").filter(
        F.col("obs_date") <= F.lit(as_of_date).cast("date"))
    lagged = as_of_values(obs, {"value_3m_ago": 3, "value_12m_ago": 12})
    return carry_forward(lagged, as_of_date).select(
        "date_day", "series_id", "obs_date",
        F.datediff("date_day", "obs_date").alias("days_since_obs"),
        "value", "value_3m_ago", "value_12m_ago",
        (F.col("value") - F.col("value_3m_ago")).alias("chg_3m"),
        (F.col("value") - F.col("value_12m_ago")).alias("chg_12m"),
        ((F.try_divide("value", "value_12m_ago") - 1) * 100).alias("pct_chg_12m"),
    )


def int_symbol_returns(stg_markets: DataFrame, stg_company_prices: DataFrame) -> DataFrame:
    """Trailing 1, 3 and 6 month returns of funds and companies."""
    columns = ["symbol", "obs_date", "adj_close"]
    return trailing_returns(
        stg_markets.select(*columns).unionByName(stg_company_prices.select(*columns)))
