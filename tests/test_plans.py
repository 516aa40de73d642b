"""The physical plans the operators are meant to have."""

import re

import pytest
from pyspark.sql import functions as F

from barloom import fixtures as X
from barloom.operators.bars import intraday_bars
from barloom.operators.timeseries import as_of_values, carry_forward, price_health, trailing_returns
from barloom.plans import intermediate as I
from barloom.plans import pipeline as PL
from barloom.plans import dims as D
from barloom.plans import queries as Q
from barloom.plans import staging as P
from barloom.seeds import indicator_seed

SF_DIR = "/root/testdata/sf0.001"


def plan(df) -> str:
    text = df._jdf.queryExecution().executedPlan().toString()
    return re.sub(r"#\d+L?", "", text)


def exchanges(df) -> int:
    return len(re.findall(r"[^d]Exchange hashpartitioning", plan(df)))


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("bronze"))
    out = {}
    for name, df in X.bronze(spark, SF_DIR).items():
        df.write.parquet(f"{root}/{name}")
        out[name] = spark.read.parquet(f"{root}/{name}")
    return out


def test_health_needs_one_exchange(spark, stored):
    bars = stored["markets_raw"].withColumn("daily_return", F.lit(0.0))
    assert exchanges(price_health(bars)) == 1
    assert exchanges(trailing_returns(bars)) == 1
    assert "ReadSchema: struct<symbol:string,obs_date:date,close:double,volume:bigint,adj_close:double>" in plan(
        price_health(bars))


def test_macro_calendar_needs_one_exchange(spark, stored):
    obs = stored["macro_raw"].select("series_id", "obs_date", "value")
    assert exchanges(carry_forward(as_of_values(obs, {"a": 3, "b": 12}), "2001-12-31")) == 1
    assert "Join" not in plan(I.int_macro_daily(obs, "2001-12-31"))


def test_dedupe_cuts_copies_before_the_exchange(spark, stored):
    text = plan(P.stg_markets(stored["markets_raw"]))
    assert text.rindex("WindowGroupLimit") > text.rindex("Exchange hashpartitioning(symbol, obs_date")


def test_bars_read_and_shuffle_trades_once(spark, stored):
    bars = intraday_bars(P.stg_trades(stored["quotes_raw"]))
    bars.collect()
    text = plan(bars).split("== Initial Plan ==")[0]
    assert text.count("FileScan") == 1 and "ReusedExchange" in text


def test_filters_and_columns_reach_the_scan(spark, stored):
    df = I.int_symbol_returns(stored["markets_raw"], stored["company_prices_raw"])
    assert "ReadSchema: struct<symbol:string,obs_date:date,adj_close:double>" in plan(df)
    text = plan(D.price_range(stored["markets_raw"]))
    assert "ReadSchema: struct<symbol:string,obs_date:date>" in text
    assert "PushedFilters: [IsNotNull(value)" in plan(P.stg_macro(stored["macro_raw"], indicator_seed(spark)))


def test_no_python_in_any_model(spark, stored):
    for name in ("mart_market_daily", "mart_macro_market_signals", "mart_intraday_bars", "stg_etf_holdings",
                 "mask_secrets", "src_holdings", "chk_price_jump"):
        text = plan(Q.QUERIES[name](spark, SF_DIR))
        assert "Python" not in text and "CartesianProduct" not in text, name


def test_bucketed_build_has_no_exchange_by_symbol(spark, stored, root):
    models = PL.build(spark, stored, indicator_seed(spark), D.watchlist_frame(spark, X.WATCHLIST), root,
                      X.AS_OF_DATE, X.BENCHMARK, buckets=4, catalog_prefix="t_")
    assert exchanges(price_health(models["stg_company_prices"])) == 0
    assert exchanges(trailing_returns(models["stg_markets"])) == 0
    assert set(models) == set(PL.LAYERS)
    want = Q.QUERIES["mart_market_daily"](spark, SF_DIR)
    assert models["mart_market_daily"].count() == want.count()
