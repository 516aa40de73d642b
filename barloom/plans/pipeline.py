"""The whole build: bronze tables in, silver and gold tables out, tests declared on each model."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom import constants as C
from barloom.operators.bars import intraday_bars
from barloom.operators.merge import newer_than
from barloom.plans import dims as D
from barloom.plans import intermediate as I
from barloom.plans import marts as G
from barloom.plans import staging as P
from barloom.quality.tests import Expectations, run_expectations
from barloom.sinks.tables import layer_path, read_or_none
from barloom.streaming.trades import merge_trades, rebuild_bars

LAYERS = {
    **{m: "silver" for m in ("stg_markets", "stg_company_prices", "stg_etf_holdings", "stg_macro",
                             "stg_trades", "int_symbol_returns", "int_macro_daily")},
    **{m: "gold" for m in ("dim_indicator", "dim_date", "dim_symbol", "dim_company",
                           "dim_symbol_hierarchy", "mart_market_daily", "mart_company_daily",
                           "mart_sector_relative_strength", "mart_drilldown_relative_strength",
                           "mart_macro_market_signals", "mart_intraday_bars")},
}


# Tables read by windows over a symbol or joined by (symbol, day). Stored bucketed by symbol, none
# of those needs an exchange.
SERIES = ("stg_markets", "stg_company_prices", "int_symbol_returns", "mart_market_daily",
          "mart_company_daily")

# Tables refreshed by day rather than rebuilt: stored partitioned, so a refresh rewrites only the
# days it touches.
BY_DATE = {"stg_trades": "trade_date", "mart_intraday_bars": "bar_date"}


def build(spark: SparkSession, bronze: Mapping[str, DataFrame], seed: DataFrame,
          watchlist: DataFrame, root: str, as_of_date, benchmark: str = C.BENCHMARK,
          buckets: int | None = None, catalog_prefix: str = "barloom_") -> dict[str, DataFrame]:
    """Build every model in dependency order.

    Each is written once and read back, so models that share an input do not repeat its work.
    With ``buckets`` the series tables are registered as catalog tables bucketed by symbol;
    choose it so that one bucket fits a task.
    """
    models: dict[str, DataFrame] = {}

    def store(name: str, make: Callable[[], DataFrame]) -> DataFrame:
        path = layer_path(root, name, LAYERS)
        df = make().hint("rebalance", BY_DATE[name]) if name in BY_DATE else make()
        writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
        if name in BY_DATE:
            writer = writer.partitionBy(BY_DATE[name])
        if buckets and name in SERIES:
            table = f"{catalog_prefix}{name}"
            (writer.bucketBy(buckets, "symbol").sortBy("symbol", "obs_date")
             .option("path", path).saveAsTable(table))
            models[name] = spark.table(table)
        else:
            writer.parquet(path)
            models[name] = spark.read.parquet(path)
        return models[name]

    indicators = store("dim_indicator", lambda: D.dim_indicator(seed, bronze["macro_raw"]))
    stg_m = store("stg_markets", lambda: P.stg_markets(bronze["markets_raw"]))
    stg_c = store("stg_company_prices", lambda: P.stg_company_prices(bronze["company_prices_raw"]))
    stg_h = store("stg_etf_holdings", lambda: P.stg_etf_holdings(
        bronze["etf_holdings_raw"], bronze["tickers_universe"]))
    stg_x = store("stg_macro", lambda: P.stg_macro(bronze["macro_raw"], indicators))
    stg_t = store("stg_trades", lambda: P.stg_trades(bronze["quotes_raw"]))
    returns = store("int_symbol_returns", lambda: I.int_symbol_returns(stg_m, stg_c))
    daily = store("int_macro_daily", lambda: I.int_macro_daily(stg_x, as_of_date))
    store("dim_date", lambda: D.dim_date(stg_m, as_of_date))
    symbol = store("dim_symbol", lambda: D.dim_symbol(
        bronze["tickers_raw"], bronze["tickers_universe"], stg_m, watchlist, benchmark))
    company = store("dim_company", lambda: D.dim_company(stg_h, stg_c, symbol))
    edges = store("dim_symbol_hierarchy", lambda: D.dim_symbol_hierarchy(
        symbol, company, stg_h, benchmark))
    market_daily = store("mart_market_daily", lambda: G.mart_market_daily(stg_m))
    company_daily = store("mart_company_daily", lambda: G.mart_company_daily(stg_c))
    store("mart_sector_relative_strength", lambda: G.mart_sector_relative_strength(
        stg_m, symbol, benchmark))
    store("mart_drilldown_relative_strength", lambda: G.mart_drilldown_relative_strength(
        edges, returns, market_daily, company_daily))
    store("mart_macro_market_signals", lambda: G.mart_macro_market_signals(market_daily, daily))
    store("mart_intraday_bars", lambda: intraday_bars(stg_t))
    return models


MARKS = "mark timestamp, run_id string"


def refresh_trades(spark: SparkSession, quotes: DataFrame, root: str, run_id: str) -> None:
    """Bring trades and bars up to date with what was loaded since the last run.

    The first run is a full build. Later runs take quotes loaded strictly after the newest
    load of the runs before, merge them by key, and rebuild bars from the newest bar date onward.
    That newest load is kept in a small table with a row per run, so trades are not read for it.
    Repeating a run under the same id only repeats its last steps.
    """
    trades_path = layer_path(root, "stg_trades", LAYERS)
    marks_path, staging = f"{root}/state/stg_trades", f"{root}/staging/stg_trades/{run_id}"
    marks = read_or_none(spark, marks_path, MARKS)
    if marks is not None:
        before = marks.filter(F.col("run_id") != run_id)
        quotes = newer_than(quotes, "_ingested_at", before, "mark", "1900-01-01")
    merge_trades(quotes, trades_path, staging)
    merged = spark.read.parquet(f"{staging}/incoming").agg(F.max("_ingested_at").alias("mark"))
    merged.filter(F.col("mark").isNotNull()).write.mode("overwrite").parquet(f"{marks_path}/run_id={run_id}")
    rebuild_bars(spark, spark.read.parquet(trades_path),
                 layer_path(root, "mart_intraday_bars", LAYERS), f"{staging}/bars")


_BAR_TESTS = dict(
    unique_combination=[["symbol", "obs_date"]],
    not_null=["symbol", "obs_date", "adj_close"],
    accepted_range=[("adj_close", 0, None, False, None)],
)
_HEALTH_TESTS = Expectations(
    unique_combination=[["symbol", "obs_date"]],
    not_null=["symbol", "obs_date"],
    accepted_values={"cross_signal": ["golden_cross", "death_cross"]},
    accepted_range=[("vol_20d_ann", 0, None, True, None), ("drawdown", -1, 0, True, None)],
)

DECLARED: dict[str, Expectations] = {
    "dim_indicator": Expectations(
        not_null=["series_id"], unique=["series_id"],
        accepted_values={"category": ["inflation", "labor", "rates", "growth", "sentiment"],
                         "frequency": ["daily", "monthly", "quarterly"]}),
    "stg_markets": Expectations(**_BAR_TESTS, relationships={"symbol": ("dim_symbol", "symbol")}),
    "stg_company_prices": Expectations(
        **_BAR_TESTS, relationships={"symbol": ("dim_company", "symbol")}),
    "stg_etf_holdings": Expectations(
        unique_combination=[["etf_symbol", "as_of_date", "position"]],
        not_null=["etf_symbol", "as_of_date", "position"],
        not_null_where=[("symbol", "is_equity")],
        accepted_values={"etf_symbol": ["XLK", "XLF", "XLE", "XLU"]},
        accepted_range=[("weight", 0, 1, True, "is_equity")]),
    "stg_macro": Expectations(
        unique_combination=[["series_id", "obs_date"]],
        not_null=["series_id", "obs_date", "value"],
        relationships={"series_id": ("dim_indicator", "series_id")}),
    "stg_trades": Expectations(
        not_null=["trade_key", "symbol", "price", "trade_ts"], unique=["trade_key"],
        accepted_range=[("price", 0, None, False, None)]),
    "int_symbol_returns": Expectations(
        unique_combination=[["symbol", "obs_date"]], not_null=["symbol", "obs_date"]),
    "int_macro_daily": Expectations(
        unique_combination=[["date_day", "series_id"]],
        not_null=["date_day", "series_id", "value"],
        accepted_range=[("days_since_obs", 0, None, True, None)]),
    "dim_date": Expectations(not_null=["date_day"], unique=["date_day"]),
    "dim_symbol": Expectations(
        not_null=["symbol", "role"], unique=["symbol"],
        accepted_values={"role": ["broad_market", "sector", "size", "bond"]}),
    "dim_company": Expectations(not_null=["symbol", "sector_etf"], unique=["symbol"]),
    "dim_symbol_hierarchy": Expectations(
        unique_combination=[["parent_symbol", "child_symbol"]],
        not_null=["parent_symbol", "child_symbol"], accepted_values={"level": [1, 2]}),
    "mart_market_daily": _HEALTH_TESTS,
    "mart_company_daily": _HEALTH_TESTS,
    "mart_macro_market_signals": Expectations(
        unique_combination=[["symbol", "obs_date"]], not_null=["obs_date", "symbol"],
        accepted_values={"fed_regime": ["hiking", "cutting", "holding"],
                         "inflation_trend": ["rising", "falling", "stable"]}),
    "mart_sector_relative_strength": Expectations(
        unique_combination=[["symbol", "obs_date"]], not_null=["obs_date", "symbol"],
        accepted_range=[("rank_1m", 1, 6, True, None)]),
    "mart_drilldown_relative_strength": Expectations(
        unique_combination=[["parent_symbol", "child_symbol", "obs_date"]],
        not_null=["parent_symbol", "child_symbol", "obs_date"],
        accepted_range=[("rank_1m", 1, None, True, None)]),
    "mart_intraday_bars": Expectations(
        unique_combination=[["symbol", "bar_minutes", "bar_start"]],
        not_null=["symbol", "bar_start"],
        accepted_values={"bar_minutes": [1, 5]},
        expressions=["low <= open and low <= close and high >= open and high >= close"]),
}


def declared_tests(models: Mapping[str, DataFrame]) -> DataFrame:
    """(model, test, failures) over every model with declared tests."""
    out = None
    for name, tests in DECLARED.items():
        if name in models:
            one = run_expectations(name, models[name], tests, dict(models))
            out = one if out is None else out.unionByName(one)
    return out
