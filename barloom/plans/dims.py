"""Gold dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barloom import constants as C
from barloom.operators.dedupe import latest_snapshot, newest_listing


def watchlist_frame(spark: SparkSession, watchlist=None) -> DataFrame:
    """(symbol, role, segment) from the configured watchlist."""
    rows = [(s, *labels) for s, labels in (watchlist or C.WATCHLIST).items()]
    return spark.createDataFrame(rows, "symbol string, role string, segment string")


def price_range(prices: DataFrame) -> DataFrame:
    return prices.groupBy("symbol").agg(
        F.min("obs_date").alias("first_price_date"), F.max("obs_date").alias("last_price_date"))


def dim_indicator(seed: DataFrame, macro: DataFrame) -> DataFrame:
    """All reference rows, with the first and last loaded observation of each series."""
    loaded = macro.groupBy("series_id").agg(
        F.min("obs_date").alias("first_obs_date"), F.max("obs_date").alias("last_obs_date"))
    return seed.join(loaded, "series_id", "left").withColumn(
        "is_loaded", F.col("first_obs_date").isNotNull())


def dim_date(stg_markets: DataFrame, as_of_date) -> DataFrame:
    """Calendar from the first bar to ``as_of_date``. A trading day is a day with any bar."""
    today = F.lit(as_of_date).cast("date")
    traded = (stg_markets.filter(F.col("obs_date") <= today)
              .select("obs_date").distinct().withColumn("_traded", F.lit(True)))
    days = traded.agg(F.min("obs_date").alias("_first")).select(
        F.explode(F.sequence("_first", today)).alias("date_day"))
    day = F.col("date_day")
    month_end = day == F.last_day(day)
    # One row per day, so the widest partition here is 31 rows.
    in_month = Window.partitionBy(F.year(day), F.month(day))
    return (
        days.join(traded, day == F.col("obs_date"), "left")
        .withColumn("is_trading_day", F.coalesce("_traded", F.lit(False)))
        .withColumn("_last_traded", F.max(F.when(F.col("is_trading_day"), day)).over(in_month))
        .select(
            "date_day",
            F.year(day).alias("year"), F.quarter(day).alias("quarter"),
            F.month(day).alias("month"), F.date_format(day, "MMMM").alias("month_name"),
            F.dayofweek(day).alias("day_of_week"), F.date_format(day, "EEEE").alias("day_name"),
            F.dayofweek(day).isin(1, 7).alias("is_weekend"),
            "is_trading_day",
            month_end.alias("is_month_end"),
            (month_end & (F.month(day) % 3 == 0)).alias("is_quarter_end"),
            ((F.month(day) == 12) & (F.dayofmonth(day) == 31)).alias("is_year_end"),
            ((F.last_day(day) < today) & F.col("is_trading_day")
             & day.eqNullSafe(F.col("_last_traded"))).alias("is_last_trading_day_of_month"),
        )
    )


def dim_symbol(tickers: DataFrame, universe: DataFrame, stg_markets: DataFrame,
               watchlist: DataFrame, benchmark: str = C.BENCHMARK) -> DataFrame:
    """Watchlist symbols with metadata, currency, role and price range."""
    currency = newest_listing(universe).select("symbol", "price_currency")
    return (
        tickers.join(watchlist, "symbol", "left")
        .join(currency, "symbol", "left")
        .join(price_range(stg_markets), "symbol", "left")
        .select(
            "symbol", "name", "description", "asset_type", "exchange_code", "price_currency",
            F.coalesce("role", F.lit(C.OTHER_ROLE)).alias("role"), "segment",
            (F.col("symbol") == benchmark).alias("is_benchmark"),
            "first_price_date", "last_price_date",
        )
    )


def dim_company(stg_holdings: DataFrame, stg_company_prices: DataFrame,
                dim_symbol: DataFrame) -> DataFrame:
    """Companies ever held, labelled from the last snapshot that held them.

    The last holding and the first date come from one aggregate over an ordered struct: newest
    snapshot, then bigger weight, then fund name. It combines map-side, so a widely held company
    is no hot spot.
    """
    label = F.struct("as_of_date", "weight", "etf_symbol", "holding_name", "exchange",
                     "price_currency")
    held = (
        stg_holdings.filter("is_equity").groupBy("symbol")
        .agg(F.max(label).alias("last"), F.min("as_of_date").alias("first_held_date"))
        .select("symbol", "last.*", "first_held_date")
    )
    newest = latest_snapshot(stg_holdings).withColumnRenamed("as_of_date", "_newest")
    sector = dim_symbol.select(F.col("symbol").alias("etf_symbol"), F.col("segment").alias("sector"))
    return (
        held.join(newest, "etf_symbol", "left")
        .join(sector, "etf_symbol", "left")
        .join(price_range(stg_company_prices), "symbol", "left")
        .select(
            "symbol", F.initcap("holding_name").alias("name"),
            F.col("etf_symbol").alias("sector_etf"), "sector", "exchange", "price_currency",
            F.col("weight").alias("latest_weight"), "first_held_date",
            F.col("as_of_date").alias("last_held_date"),
            (F.col("as_of_date") == F.col("_newest")).alias("is_current_holding"),
            "first_price_date", "last_price_date",
        )
    )


def dim_symbol_hierarchy(dim_symbol: DataFrame, dim_company: DataFrame, stg_holdings: DataFrame,
                         benchmark: str = C.BENCHMARK,
                         roles: Sequence[str] = C.COMPARED_ROLES) -> DataFrame:
    """Parent-to-child edges: benchmark to funds, fund to companies of its latest snapshot."""
    funds = dim_symbol.filter(F.col("role").isin(*roles)).select(
        F.lit(benchmark).alias("parent_symbol"), F.col("symbol").alias("child_symbol"),
        F.lit(1).alias("level"), F.lit(None).cast("double").alias("weight"),
        F.col("segment").alias("child_name"))
    names = dim_company.select(F.col("symbol"), F.col("name").alias("child_name"))
    companies = (
        stg_holdings.filter("is_equity")
        .join(latest_snapshot(stg_holdings), ["etf_symbol", "as_of_date"])
        .join(names, "symbol", "left")
        .select(F.col("etf_symbol").alias("parent_symbol"), F.col("symbol").alias("child_symbol"),
                F.lit(2).alias("level"), "weight", "child_name")
    )
    edges = funds.unionByName(companies)
    parents = edges.select(F.col("parent_symbol").alias("child_symbol")).distinct()
    return edges.join(parents.withColumn("_parent", F.lit(True)), "child_symbol", "left").select(
        "parent_symbol", "child_symbol", "level", "weight", "child_name",
        F.coalesce("_parent", F.lit(False)).alias("has_children"))
