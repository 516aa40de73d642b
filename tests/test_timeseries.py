import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from barloom.operators.timeseries import as_of_values, carry_forward, price_health, trailing_returns
from barloom.plans.intermediate import int_macro_daily
from barloom.plans.marts import mart_macro_market_signals
from barloom.plans.staging import stg_daily_bars

DAY0 = dt.date(2020, 1, 1)


def prices(spark, values, symbol="A"):
    rows, last = [], None
    for i, v in enumerate(values):
        ret = v / last - 1 if last else None
        rows.append((symbol, DAY0 + dt.timedelta(days=i), v, v, 1, ret))
        last = v
    return spark.createDataFrame(
        rows, "symbol string, obs_date date, close double, adj_close double, volume bigint, "
              "daily_return double")


def by_day(df):
    return [r.asDict() for r in df.orderBy("symbol", "obs_date").collect()]


def test_windows_stay_null_until_full(spark):
    out = by_day(price_health(prices(spark, [100.0 + i for i in range(205)])))
    assert [i for i, r in enumerate(out, 1) if r["sma_50"] is not None][0] == 50
    assert [i for i, r in enumerate(out, 1) if r["sma_200"] is not None][0] == 200
    assert [i for i, r in enumerate(out, 1) if r["vol_20d_ann"] is not None][0] == 21
    assert out[199]["sma_200"] == pytest.approx(sum(100.0 + i for i in range(200)) / 200)
    assert out[198]["above_sma_200"] is None and out[199]["above_sma_200"] is True


def test_drawdown_and_peak(spark):
    out = by_day(price_health(prices(spark, [10.0, 20.0, 15.0])))
    assert [r["running_peak"] for r in out] == [10.0, 20.0, 20.0]
    assert [r["drawdown"] for r in out] == [0.0, 0.0, -0.25]


def test_cross_needs_both_previous_averages(spark):
    # Flat, then a jump: equal averages yesterday and a strict order today is a cross.
    out = by_day(price_health(prices(spark, [8.0] * 210 + [16.0, 16.0] + [1.0] * 60)))
    signals = {i: r["cross_signal"] for i, r in enumerate(out) if r["cross_signal"]}
    assert signals[210] == "golden_cross"
    assert sorted(signals.values()) == ["death_cross", "golden_cross"]
    # The first day with a long average has no yesterday to cross from.
    rising = by_day(price_health(prices(spark, [1.0 + i for i in range(203)])))
    assert all(r["cross_signal"] is None for r in rising)


def test_returns_count_rows_not_days(spark):
    df = prices(spark, [1.0] * 21 + [3.0]).filter(F.col("obs_date") != DAY0 + dt.timedelta(days=5))
    assert by_day(trailing_returns(df))[-1]["return_1m"] is None
    assert by_day(trailing_returns(prices(spark, [1.0] * 21 + [3.0])))[-1]["return_1m"] == 2.0


def test_zero_base_gives_null(spark):
    assert by_day(trailing_returns(prices(spark, [0.0] * 21 + [3.0])))[-1]["return_1m"] is None


def bars(spark, rows):
    return spark.createDataFrame(
        [(s, d, *[p] * 4, 1, *[p] * 4, 1, div, split, t) for s, d, p, div, split, t in rows],
        "symbol string, obs_date date, open double, high double, low double, close double, "
        "volume bigint, adj_open double, adj_high double, adj_low double, adj_close double, "
        "adj_volume bigint, div_cash double, split_factor double, _ingested_at timestamp")


def test_latest_load_wins_whatever_the_input_order(spark):
    early, late = dt.datetime(2020, 2, 1), dt.datetime(2020, 2, 2)
    rows = [("A", DAY0 + dt.timedelta(days=i), 10.0 + i, None, None, early) for i in range(5)]
    rows += [("A", DAY0 + dt.timedelta(days=i), 20.0 + i, 1.0, 2.0, late) for i in range(2, 4)]
    first = by_day(stg_daily_bars(bars(spark, rows)))
    assert [r["adj_close"] for r in first] == [10.0, 11.0, 22.0, 23.0, 14.0]
    assert [r["div_cash"] for r in first] == [0.0, 0.0, 1.0, 1.0, 0.0]
    assert [r["split_factor"] for r in first] == [1.0, 1.0, 2.0, 2.0, 1.0]
    assert first[0]["daily_return"] is None and first[2]["daily_return"] == 1.0
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        assert by_day(stg_daily_bars(bars(spark, rows).repartition(3))) == first


def obs(spark, rows):
    return spark.createDataFrame(rows, "series_id string, obs_date date, value double")


def test_change_belongs_to_the_observation(spark):
    monthly = [("CPI", dt.date(2020 + m // 12, m % 12 + 1, 1), 100.0 + m) for m in range(14)]
    out = {r.date_day: r for r in int_macro_daily(obs(spark, monthly), "2021-02-20").collect()}
    mid = out[dt.date(2021, 2, 15)]
    assert (mid.obs_date, mid.days_since_obs, mid.value) == (dt.date(2021, 2, 1), 14, 113.0)
    # February against February, not against the month before it.
    assert (mid.value_12m_ago, mid.value_3m_ago, mid.chg_12m) == (101.0, 110.0, 12.0)
    assert out[dt.date(2020, 12, 31)].value_12m_ago is None
    assert len(out) == (dt.date(2021, 2, 20) - dt.date(2020, 1, 1)).days + 1


def test_as_of_lookup_takes_the_last_value_before_a_gap(spark):
    rows = [("D", dt.date(2020, 1, 3), 1.0), ("D", dt.date(2020, 1, 6), 2.0), ("D", dt.date(2020, 4, 5), 3.0)]
    out = {r.obs_date: r for r in as_of_values(obs(spark, rows), {"ago": 3}).collect()}
    assert out[dt.date(2020, 4, 5)].ago == 1.0
    assert out[dt.date(2020, 1, 6)].ago is None


def test_observations_after_the_as_of_date_are_left_out(spark):
    rows = [("D", dt.date(2020, 1, 1), 1.0), ("D", dt.date(2020, 1, 9), 2.0), ("E", dt.date(2020, 2, 1), 1.0)]
    out = int_macro_daily(obs(spark, rows), "2020-01-05").collect()
    assert {(r.series_id, r.value) for r in out} == {("D", 1.0)} and len(out) == 5


def test_percent_change_is_null_on_a_zero_base(spark):
    rows = [("FF", dt.date(2019, 1, 1), 0.0), ("FF", dt.date(2020, 1, 1), 2.0)]
    last = int_macro_daily(obs(spark, rows), "2020-01-01").orderBy(F.desc("date_day")).first()
    assert last.chg_12m == 2.0 and last.pct_chg_12m is None


def test_carry_forward_equals_the_dense_calendar_join(spark):
    rng = random.Random(3)
    rows = [(s, DAY0 + dt.timedelta(days=k), float(k)) for s in "AB"
            for k in sorted(rng.sample(range(60), 12))]
    got = {(r.series_id, r.date_day): r.value
           for r in carry_forward(obs(spark, rows), "2020-04-01").collect()}
    want = {}
    for s in "AB":
        own = [(d, v) for x, d, v in rows if x == s]
        day = own[0][0]
        while day <= dt.date(2020, 4, 1):
            want[s, day] = max((d, v) for d, v in own if d <= day)[1]
            day += dt.timedelta(days=1)
    assert got == want


@pytest.mark.parametrize("chg,label", [
    (0.26, "hiking"), (0.25, "holding"), (0.0, "holding"), (-0.25, "holding"), (-0.26, "cutting"),
    (None, None)])
def test_fed_regime_edges(spark, chg, label):
    daily = spark.createDataFrame(
        [(DAY0, "FEDFUNDS", 1.0, None, chg, None)],
        "date_day date, series_id string, value double, value_3m_ago double, chg_3m double, pct_chg_12m double")
    out = mart_macro_market_signals(prices(spark, [1.0]), daily).first()
    assert out.fed_regime == label and out.curve_inverted is None


@pytest.mark.parametrize("yoy,label", [(-0.6, "rising"), (-0.5, "stable"), (0.5, "stable"),
                                       (0.6, "falling"), (None, None)])
def test_inflation_trend_edges(spark, yoy, label):
    daily = spark.createDataFrame(
        [(DAY0, "CPIAUCSL", 1.0, 1.0, None, yoy)],
        "date_day date, series_id string, value double, value_3m_ago double, chg_3m double, pct_chg_12m double")
    assert mart_macro_market_signals(prices(spark, [1.0]), daily).first().inflation_trend == label
