"""Declared schemas of landed data and of the bronze and ops tables."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _D, _L, _I = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType()
_DATE, _TS, _STRINGS = T.DateType(), T.TimestampType(), T.ArrayType(T.StringType())


def _schema(**cols: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in cols.items()])


_STAMP = {"_ingested_at": _TS}

MACRO = _schema(series_id=_S, obs_date=_DATE, value=_D, **_STAMP)

BARS = _schema(
    symbol=_S, obs_date=_DATE,
    open=_D, high=_D, low=_D, close=_D, volume=_L,
    adj_open=_D, adj_high=_D, adj_low=_D, adj_close=_D, adj_volume=_L,
    div_cash=_D, split_factor=_D, **_STAMP,
)

TICKERS = _schema(
    symbol=_S, name=_S, asset_type=_S, exchange_code=_S,
    start_date=_DATE, end_date=_DATE, description=_S, **_STAMP,
)

UNIVERSE = _schema(
    ticker=_S, exchange=_S, asset_type=_S, price_currency=_S,
    start_date=_DATE, end_date=_DATE, **_STAMP,
)

NEWS = _schema(
    article_id=_S, title=_S, description=_S, url=_S, source=_S,
    published_date=_TS, crawl_date=_TS, tickers=_STRINGS, tags=_STRINGS, **_STAMP,
)

HOLDINGS = _schema(
    etf_symbol=_S, as_of_date=_DATE, position=_I,
    holding_name=_S, ticker=_S, symbol=_S, identifier=_S, sedol=_S,
    weight_pct=_D, shares_held=_D, local_currency=_S, **_STAMP,
)

LANDED_TRADE = _schema(symbol=_S, price=_D, volume=_D, trade_time=_L, conditions=_STRINGS)
QUOTES = _schema(
    symbol=_S, price=_D, volume=_D, trade_time=_L, conditions=_STRINGS, trade_ts=_TS, **_STAMP,
)

DQ_RESULTS = _schema(
    run_id=_S, check_ts=_TS, check_name=_S, table_name=_S,
    severity=_S, status=_S, message=_S, observed=_S,
)

# Vendor payloads, as they land.
PAYLOAD_MACRO = _schema(observations=T.ArrayType(_schema(date=_S, value=_S)))
PAYLOAD_BARS = T.ArrayType(_schema(
    date=_S, open=_D, high=_D, low=_D, close=_D, volume=_L,
    adjOpen=_D, adjHigh=_D, adjLow=_D, adjClose=_D, adjVolume=_L, divCash=_D, splitFactor=_D,
))
PAYLOAD_TICKER = _schema(
    ticker=_S, name=_S, exchangeCode=_S, startDate=_S, endDate=_S, description=_S,
)
PAYLOAD_NEWS = T.ArrayType(_schema(
    id=_S, title=_S, description=_S, url=_S, source=_S,
    publishedDate=_S, crawlDate=_S, tickers=_STRINGS, tags=_STRINGS,
))
PAYLOAD_TRADES = _schema(
    type=_S, data=T.ArrayType(_schema(s=_S, p=_D, v=_D, t=_L, c=_STRINGS)),
)
CSV_UNIVERSE = _schema(
    ticker=_S, exchange=_S, assetType=_S, priceCurrency=_S, startDate=_S, endDate=_S,
)
SEED_INDICATOR = _schema(
    series_id=_S, indicator_name=_S, category=_S, frequency=_S, units=_S,
    description=_S, why_it_matters=_S,
)
