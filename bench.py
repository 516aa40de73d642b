"""Time the headline models at one scale and print a single JSON line.

Bronze tables are derived and stored first, untimed, so each figure is the model's own work:
reading parquet, computing, and running the whole result into a sink that discards it.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import functions as F

from barloom import constants as C
from barloom import fixtures as X
from barloom.operators.bars import intraday_bars
from barloom.operators.dedupe import latest_bar
from barloom.operators.merge import scd2, first_snapshot, upsert_actions
from barloom.plans import dims as D
from barloom.plans import intermediate as I
from barloom.plans import marts as G
from barloom.plans import staging as P
from barloom.quality import checks as Q
from barloom.seeds import indicator_seed
from barloom.session import build_session, scratch_dir, written
from barloom.sinks.tables import replace_slices, upsert_slices
from barloom.streaming.trades import rebuild_bars

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def main() -> None:
    spark = build_session("bench", f"local[{CPUS}]", **{
        "spark.sql.shuffle.partitions": CPUS,
        "spark.ui.enabled": "false",
        "spark.driver.memory": "12g",
    })
    spark.sparkContext.setLogLevel("OFF")
    bronze = {name: written(df, name) for name, df in X.bronze(spark, SF_DIR).items()}

    stg_m = written(P.stg_markets(bronze["markets_raw"]), "stg_markets")
    stg_c = written(P.stg_company_prices(bronze["company_prices_raw"]), "stg_company_prices")
    stg_h = written(P.stg_etf_holdings(bronze["etf_holdings_raw"], bronze["tickers_universe"]), "holdings")
    stg_t = written(P.stg_trades(bronze["quotes_raw"]), "stg_trades")
    stg_x = written(P.stg_macro(bronze["macro_raw"], indicator_seed(spark)), "stg_macro")
    returns = written(I.int_symbol_returns(stg_m, stg_c), "returns")
    daily = written(I.int_macro_daily(stg_x, X.AS_OF_DATE), "macro_daily")
    market_daily = written(G.mart_market_daily(stg_m), "market_daily")
    company_daily = written(G.mart_company_daily(stg_c), "company_daily")
    symbol = written(D.dim_symbol(
        bronze["tickers_raw"], bronze["tickers_universe"], stg_m,
        D.watchlist_frame(spark, X.WATCHLIST), X.BENCHMARK), "dim_symbol")
    company = written(D.dim_company(stg_h, stg_c, symbol), "dim_company")
    edges = written(D.dim_symbol_hierarchy(symbol, company, stg_h, X.BENCHMARK), "edges")

    bars = written(latest_bar(bronze["company_prices_raw"]), "bars")
    incoming = written(bars.filter(F.col("obs_date") >= "2000-01-01").withColumn(
        "adj_close", F.when(F.dayofmonth("obs_date") == 7, F.col("adj_close") + 5)
        .otherwise(F.col("adj_close"))), "incoming")
    history = written(first_snapshot(_listings(bronze), "2001-07-01"), "history")

    months = lambda df: df.withColumn("obs_month", F.date_format("obs_date", "yyyy-MM"))
    sliced = scratch_dir(spark, "sliced")
    replace_slices(months(bars.filter(F.col("obs_date") <= "2001-06-30")), sliced, ["obs_month"])

    def merged():
        """A batch of two months merged into the stored table; the rest of it is not read."""
        upsert_slices(spark, sliced, months(incoming.filter(F.col("obs_date").between("2001-05-01", "2001-06-30"))),
                      ["symbol", "obs_date"], ["obs_month"], scratch_dir(spark, "staging"), C.BAR_CHANGE_COLS)
        return spark.range(0)

    bars_path = scratch_dir(spark, "bars-by-day")
    replace_slices(intraday_bars(stg_t), bars_path, ["bar_date"])

    def rebuilt():
        """Bars of the newest day, swapped in."""
        rebuild_bars(spark, stg_t, bars_path, scratch_dir(spark, "staging"))
        return spark.range(0)

    queries = {
        "stg_markets": lambda: P.stg_markets(bronze["markets_raw"]),
        "stg_company_prices": lambda: P.stg_company_prices(bronze["company_prices_raw"]),
        "stg_etf_holdings": lambda: P.stg_etf_holdings(
            bronze["etf_holdings_raw"], bronze["tickers_universe"]),
        "stg_trades": lambda: P.stg_trades(bronze["quotes_raw"]),
        "int_symbol_returns": lambda: I.int_symbol_returns(stg_m, stg_c),
        "int_macro_daily": lambda: I.int_macro_daily(stg_x, X.AS_OF_DATE),
        "mart_market_daily": lambda: G.mart_market_daily(stg_m),
        "mart_company_daily": lambda: G.mart_company_daily(stg_c),
        "mart_sector_relative_strength": lambda: G.mart_sector_relative_strength(
            stg_m, symbol, X.BENCHMARK),
        "mart_drilldown_relative_strength": lambda: G.mart_drilldown_relative_strength(
            edges, returns, market_daily, company_daily),
        "mart_macro_market_signals": lambda: G.mart_macro_market_signals(market_daily, daily),
        "mart_intraday_bars": lambda: intraday_bars(stg_t),
        "upsert_changed": lambda: upsert_actions(
            bars.filter(F.col("obs_date") <= "2001-06-30"), incoming, ["symbol", "obs_date"],
            C.BAR_CHANGE_COLS),
        "upsert_slices": merged,
        "rebuild_bars": rebuilt,
        "scd2_snapshot": lambda: scd2(
            history, _listings(bronze).withColumn("end_date", F.current_date()), "symbol",
            C.TICKER_CHECK_COLS, "2001-08-01"),
        "chk_price_jump": lambda: Q.check_price_jump(
            bronze["company_prices_raw"], "jump", "company_prices_raw", "2001-11-04"),
    }
    timed = {name: _median(make) for name, make in queries.items()}
    print(json.dumps({
        "metric": "headline model time", "value": round(sum(timed.values()), 3), "unit": "sec",
        "queries": timed, "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf")}))


def _listings(bronze):
    """Universe rows under a unique key, for the snapshot."""
    return bronze["tickers_universe"].groupBy(
        F.concat_ws("-", "ticker", "start_date", "end_date", "exchange").alias("symbol")).agg(
        F.max("ticker").alias("name"), F.max("exchange").alias("exchange_code"),
        F.max("asset_type").alias("asset_type"), F.max("price_currency").alias("description"),
        F.max("start_date").alias("start_date"), F.max("end_date").alias("end_date"))


def _median(make) -> float:
    times = []
    for _ in range(RUNS):
        start = time.perf_counter()
        make().write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times), 3)


if __name__ == "__main__":
    main()
