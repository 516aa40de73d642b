"""The fixture tables in DuckDB SQL, and a helper that puts the needed ones before a query."""

from __future__ import annotations

import re

CTES: dict[str, str] = {}

CTES["mk_lines"] = """
SELECT p_type, replace(upper(p_brand), '#', '-') AS brand, l_shipdate::DATE AS obs_date,
       l_orderkey, l_linenumber, l_extendedprice AS px, l_quantity::BIGINT AS qty
FROM lineitem JOIN part ON p_partkey = l_partkey"""

_BARS = """
SELECT symbol, obs_date,
       arg_min(px, row(l_orderkey, l_linenumber, px)) AS open,
       max(px) AS high, min(px) AS low,
       arg_max(px, row(l_orderkey, l_linenumber, px)) AS close,
       sum(qty)::BIGINT AS volume
FROM (SELECT {symbol} AS symbol, * FROM mk_lines) GROUP BY ALL"""

_DRESS = """
SELECT symbol, obs_date, open, high, low, close, volume,
       open AS adj_open, high AS adj_high, low AS adj_low, close + stale AS adj_close,
       volume AS adj_volume,
       CASE WHEN day(obs_date) = 15 THEN 0.5::DOUBLE END AS div_cash,
       CASE WHEN day(obs_date) = 20 AND month(obs_date) = 6 THEN 2.0::DOUBLE
            WHEN day(obs_date) <> 10 THEN 1.0::DOUBLE END AS split_factor,
       (obs_date + CASE WHEN stale = 0 THEN 1 ELSE 0 END)::TIMESTAMP AS _ingested_at
FROM {src}, (VALUES (0.0::DOUBLE), (1.0::DOUBLE)) AS copies(stale)
WHERE stale = 0 OR day(obs_date) <= 3"""

CTES["etf_ohlc"] = _BARS.format(symbol="unnest(['ALL', p_type])")
CTES["co_ohlc"] = _BARS.format(symbol="brand")
CTES["markets_raw"] = _DRESS.format(src="etf_ohlc")
CTES["company_prices_raw"] = _DRESS.format(src="co_ohlc")

CTES["macro_mean"] = """
SELECT code, obs_date, sum(c)::BIGINT / count(*) / 100 AS raw
FROM (
  SELECT unnest([o_orderpriority, 'all']) AS code, date_trunc('month', o_orderdate)::DATE AS obs_date,
         round(o_totalprice * 100)::BIGINT AS c FROM orders
  UNION ALL
  SELECT o_orderstatus, o_orderdate::DATE, round(o_totalprice * 100)::BIGINT FROM orders
) GROUP BY code, obs_date"""

CTES["macro_raw"] = """
SELECT series_id, obs_date,
       CASE WHEN series_id = 'FEDFUNDS' THEN (raw - 200000) / 7001
            WHEN series_id IN ('DGS10', 'DGS2') THEN raw / 70001
            WHEN series_id = 'T10Y2Y' AND day(obs_date) = 1 THEN 0.0
            WHEN series_id = 'T10Y2Y' THEN raw / 70001 - 3.5
            WHEN series_id = 'UMCSENT' AND month(obs_date) = 7 THEN NULL
            ELSE raw END AS value,
       (obs_date + 1)::TIMESTAMP AS _ingested_at
FROM macro_mean
JOIN (VALUES ('1-URGENT', 'CPIAUCSL'), ('2-HIGH', 'UNRATE'), ('3-MEDIUM', 'FEDFUNDS'),
             ('4-NOT SPECIFIED', 'GDP'), ('5-LOW', 'UMCSENT'), ('all', 'ORDERSX'),
             ('F', 'DGS10'), ('O', 'DGS2'), ('P', 'T10Y2Y')) AS names(code, series_id) USING (code)
WHERE series_id <> 'GDP' OR month(obs_date) IN (1, 4, 7, 10)"""

CTES["tr_first"] = """
SELECT event_type AS symbol, value AS price, json_extract(props, '$.k')::DOUBLE AS volume,
       epoch_us(ts) // 1000 AS trade_time,
       epoch_ms(epoch_us(ts) // 1000) AS trade_ts
FROM events"""

CTES["quotes_raw"] = """
SELECT symbol, price, volume, trade_time,
       CASE WHEN volume < 10 THEN [] WHEN volume > 50 THEN [symbol, 'block'] ELSE [symbol] END
         AS conditions,
       trade_ts, (trade_ts::DATE + 1 + late)::TIMESTAMP AS _ingested_at
FROM tr_first, (VALUES (0), (1)) AS sends(late)
WHERE late = 0 OR volume >= 90"""

CTES["tickers_raw"] = """
SELECT symbol, symbol || ' Fund' AS name, 'ETF' AS asset_type, 'ARCX' AS exchange_code,
       DATE '1995-01-01' + min(p_size) AS start_date, DATE '2001-11-01' + max(p_size) AS end_date,
       'Holds ' || count(*) || ' parts' AS description,
       TIMESTAMP '2001-12-30 06:00:00' AS _ingested_at
FROM (SELECT unnest(['ALL', p_type]) AS symbol, p_size FROM part) GROUP BY symbol"""

CTES["tickers_universe"] = """
SELECT lower(s) AS ticker, CASE WHEN p_size > 25 THEN 'NYSE' ELSE 'NASDAQ' END AS exchange,
       CASE WHEN p_partkey % 2 = 0 THEN 'Stock' ELSE 'ETF' END AS asset_type,
       CASE WHEN p_partkey % 3 = 0 THEN 'USD' ELSE 'EUR' END AS price_currency,
       DATE '1990-01-01' + (p_partkey % 1000)::INTEGER AS start_date,
       CASE WHEN p_partkey % 7 <> 0 THEN DATE '2000-01-01' + (p_partkey % 500)::INTEGER END AS end_date,
       TIMESTAMP '2001-12-28 06:00:00' AS _ingested_at
FROM (SELECT unnest([replace(upper(p_brand), '#', '-'), p_type]) AS s, p_partkey, p_size FROM part)"""

CTES["held"] = """
SELECT etf_symbol, as_of_date, p_brand, sum(c)::BIGINT AS c, count(*)::DOUBLE AS shares_held
FROM (SELECT p_type AS etf_symbol, p_brand, round(p_retailprice * 100)::BIGINT AS c, DATE '2001-09-28' AS as_of_date FROM part
      UNION ALL
      SELECT p_type, p_brand, round(p_retailprice * 100)::BIGINT, DATE '2001-06-29' FROM part WHERE p_size <= 25)
GROUP BY etf_symbol, as_of_date, p_brand"""

CTES["held_lines"] = """
SELECT etf_symbol, as_of_date,
       row_number() OVER (PARTITION BY etf_symbol, as_of_date ORDER BY c DESC, p_brand)::INTEGER AS position,
       replace(upper(p_brand), '#', ' ') || ' HOLDINGS INC' AS holding_name,
       replace(upper(p_brand), '#', '.') AS ticker, replace(upper(p_brand), '#', '-') AS symbol,
       sha256(p_brand)[1:9] AS identifier, sha256(p_brand)[10:16] AS sedol,
       100.0::DOUBLE * c / sum(c) OVER (PARTITION BY etf_symbol, as_of_date) AS weight_pct,
       shares_held, 'USD' AS local_currency
FROM held"""

CTES["sheet_lines"] = """
SELECT * FROM held_lines
UNION ALL
SELECT etf_symbol, as_of_date, (max(position) + 1)::INTEGER, 'US DOLLAR', '-', NULL, 'CASH_USD', NULL,
       0.5, 1000.0, 'USD' FROM held_lines GROUP BY etf_symbol, as_of_date
UNION ALL
SELECT etf_symbol, as_of_date, (max(position) + 2)::INTEGER, 'INDEX FUTURE DEC01', 'IXZ1', 'IXZ1', 'FUT_IXZ1', NULL,
       -0.02, 3.0, 'USD' FROM held_lines GROUP BY etf_symbol, as_of_date"""

CTES["etf_holdings_raw"] = """
SELECT * EXCLUDE (stale) REPLACE (weight_pct + stale AS weight_pct),
       (as_of_date + CASE WHEN stale = 0 THEN 1 ELSE 0 END)::TIMESTAMP AS _ingested_at
FROM sheet_lines, (VALUES (0.0::DOUBLE), (1.0::DOUBLE)) AS copies(stale)
WHERE stale = 0 OR position <= 3"""

CTES["news_raw"] = """
SELECT 'a' || doc_id AS article_id, substring(text, 1, 80) AS title, text AS description,
       'https://example.org/' || doc_id AS url, source,
       epoch_ms((1704067200 + doc_id * 60) * 1000) AS published_date,
       epoch_ms((1704067200 + doc_id * 60 + 300) * 1000) AS crawl_date,
       CASE WHEN n_chars > 500 THEN 'ALL' ELSE '' END AS tickers, lang AS tags,
       epoch_ms((1704067200 + doc_id * 60 + 3600) * 1000) AS _ingested_at
FROM documents"""

CTES["dq_results"] = """
SELECT 'run-' || strftime(d, '%Y%m%d') AS run_id, d::TIMESTAMP + INTERVAL 6 HOUR AS check_ts,
       event_type AS check_name, 'events' AS table_name,
       CASE WHEN event_type IN ('view', 'click') THEN 'warn' ELSE 'error' END AS severity,
       CASE WHEN m > 58 THEN 'error' WHEN m > 52 THEN 'fail' ELSE 'pass' END AS status,
       n || ' rows' AS message, '{"rows":' || n || '}' AS observed
FROM (SELECT ts::DATE AS d, event_type, count(*) AS n,
             sum(round(value * 100)::BIGINT)::BIGINT / count(*) / 100 AS m
      FROM events GROUP BY ALL)"""

CTES["job_runs"] = """
SELECT event_type AS job_name, event_id AS run_id, ts AS start_ts,
       CASE WHEN json_extract(props, '$.k')::INTEGER < 95 THEN ts + INTERVAL 5 MINUTE END AS end_ts,
       CASE WHEN json_extract(props, '$.k')::INTEGER < 40 THEN 'FAILED' ELSE 'SUCCESS' END AS result_state
FROM events"""

CTES["watchlist"] = """
SELECT * FROM (VALUES ('ALL', 'broad_market', 'Whole market'), ('STANDARD', 'sector', 'Standard goods'),
  ('PROMO', 'sector', 'Promoted goods'), ('ECONOMY', 'sector', 'Economy goods'),
  ('MEDIUM', 'size', 'Medium goods'), ('LARGE', 'bond', 'Large goods')) AS w(symbol, role, segment)"""

# --- models ------------------------------------------------------------------------------

_BEST = """
SELECT unnest(best) FROM (SELECT arg_max(b, _ingested_at) AS best FROM {src} AS b GROUP BY b.symbol, b.obs_date)"""
CTES["markets_best"] = _BEST.format(src="markets_raw")
CTES["company_best"] = _BEST.format(src="company_prices_raw")

_STG_BARS = """
SELECT * REPLACE (ifnull(div_cash, 0.0) AS div_cash, ifnull(split_factor, 1.0) AS split_factor),
       adj_close / nullif(lag(adj_close) OVER (PARTITION BY symbol ORDER BY obs_date), 0) - 1 AS daily_return
FROM {src}"""
CTES["stg_markets"] = _STG_BARS.format(src="markets_best")
CTES["stg_company_prices"] = _STG_BARS.format(src="company_best")

_LISTING = """
SELECT upper(ticker) AS symbol, exchange, price_currency FROM tickers_universe {where}
QUALIFY 1 = row_number() OVER (PARTITION BY upper(ticker)
  ORDER BY coalesce(end_date, DATE '9999-12-31') DESC, start_date DESC, exchange, price_currency)"""
CTES["stock_listing"] = _LISTING.format(where="WHERE asset_type = 'Stock'")
CTES["any_listing"] = _LISTING.format(where="")

CTES["stg_etf_holdings"] = """
SELECT etf_symbol, as_of_date, position, holding_name, ticker, symbol, identifier, sedol,
       weight_pct / 100 AS weight, shares_held, local_currency, l.symbol IS NOT NULL AS is_equity,
       exchange, price_currency, _ingested_at
FROM (SELECT * FROM etf_holdings_raw AS r WHERE NOT EXISTS (
        SELECT 1 FROM etf_holdings_raw AS n
        WHERE n.etf_symbol = r.etf_symbol AND n.as_of_date = r.as_of_date
          AND n.position = r.position AND n._ingested_at > r._ingested_at)) AS h
LEFT JOIN stock_listing AS l USING (symbol)"""

CTES["indicators"] = """
SELECT * FROM (VALUES
  ('CPIAUCSL', 'Consumer prices, all urban consumers', 'inflation', 'monthly', 'index',
   'Price level of a basket that city households buy.',
   'The usual "headline" inflation number; its yearly change steers rate expectations.'),
  ('UNRATE', 'Unemployment rate', 'labor', 'monthly', 'percent',
   'People looking for work as a share of the labor force.',
   'Turns up early when the economy weakens.'),
  ('FEDFUNDS', 'Effective federal funds rate', 'rates', 'monthly', 'percent',
   'Average rate of overnight loans between banks.',
   'The rate the central bank steers; other borrowing costs follow.'),
  ('DGS10', 'Treasury yield, 10 years', 'rates', 'daily', 'percent',
   'Market yield of ten-year government debt.',
   'Anchor for mortgages and long corporate loans.'),
  ('DGS2', 'Treasury yield, 2 years', 'rates', 'daily', 'percent',
   'Market yield of two-year government debt.',
   'Follows the expected policy rate.'),
  ('T10Y2Y', 'Treasury spread, 10 less 2 years', 'rates', 'daily', 'percent',
   'Ten-year yield minus two-year yield.',
   'Below zero the curve is "inverted", which has often come before a recession.'),
  ('GDP', 'Gross domestic product', 'growth', 'quarterly', 'usd_bn',
   'Value of all goods and services produced.',
   'The widest measure of growth.'),
  ('UMCSENT', 'Consumer sentiment', 'sentiment', 'monthly', 'index',
   'Survey index of how households see their finances and the economy.',
   'Leads consumer spending.')
) AS i(series_id, indicator_name, category, frequency, units, description, why_it_matters)"""

CTES["stg_macro"] = """
SELECT series_id, obs_date, value, indicator_name, category, frequency, units, _ingested_at
FROM macro_raw LEFT JOIN indicators USING (series_id) WHERE value IS NOT NULL"""

CTES["trades_keyed"] = """
SELECT sha256(concat_ws('|', symbol, trade_time::VARCHAR, price::VARCHAR, volume::VARCHAR,
                        array_to_string(conditions, ','))) AS trade_key,
       symbol, price, volume, conditions, trade_ts,
       ((trade_ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York') AS et, _ingested_at
FROM quotes_raw"""

CTES["stg_trades"] = """
SELECT trade_key, any_value(symbol) AS symbol, any_value(price) AS price, any_value(volume) AS volume,
       any_value(array_to_string(conditions, ',')) AS conditions, any_value(trade_ts) AS trade_ts,
       any_value(et)::DATE AS trade_date,
       any_value(hour(et) * 60 + minute(et)) BETWEEN 570 AND 959 AS is_regular_session,
       min(_ingested_at) AS _ingested_at
FROM trades_keyed GROUP BY trade_key"""

# As-of values found by an inequality lookup instead of a grid.
CTES["macro_lagged"] = """
SELECT o.series_id, o.obs_date, o.value,
       (SELECT arg_max(p.value, p.obs_date) FROM stg_macro AS p WHERE p.series_id = o.series_id
          AND p.obs_date <= (o.obs_date - INTERVAL 3 MONTH)::DATE) AS value_3m_ago,
       (SELECT arg_max(p.value, p.obs_date) FROM stg_macro AS p WHERE p.series_id = o.series_id
          AND p.obs_date <= (o.obs_date - INTERVAL 12 MONTH)::DATE) AS value_12m_ago
FROM stg_macro AS o WHERE o.obs_date <= DATE '2001-12-31'"""

CTES["macro_grid"] = """
SELECT series_id, unnest(range(first_day::TIMESTAMP, TIMESTAMP '2002-01-01', INTERVAL 1 DAY))::DATE AS date_day
FROM (SELECT series_id, min(obs_date) AS first_day FROM stg_macro WHERE obs_date <= DATE '2001-12-31' GROUP BY series_id)"""

CTES["int_macro_daily"] = """
SELECT date_day, series_id, obs_date, (date_day - obs_date)::INTEGER AS days_since_obs, value,
       value_3m_ago, value_12m_ago, value - value_3m_ago AS chg_3m, value - value_12m_ago AS chg_12m,
       (value / nullif(value_12m_ago, 0) - 1) * 100 AS pct_chg_12m
FROM macro_grid AS g ASOF JOIN macro_lagged AS o
  ON g.series_id = o.series_id AND g.date_day >= o.obs_date"""
CTES["int_macro_daily"] = CTES["int_macro_daily"].replace("date_day, series_id", "date_day, g.series_id", 1)

CTES["int_symbol_returns"] = """
SELECT symbol, obs_date, adj_close,
       adj_close / nullif(lag(adj_close, 21) OVER s, 0) - 1 AS return_1m,
       adj_close / nullif(lag(adj_close, 63) OVER s, 0) - 1 AS return_3m,
       adj_close / nullif(lag(adj_close, 126) OVER s, 0) - 1 AS return_6m
FROM (SELECT symbol, obs_date, adj_close FROM stg_markets
      UNION ALL SELECT symbol, obs_date, adj_close FROM stg_company_prices)
WINDOW s AS (PARTITION BY symbol ORDER BY obs_date)"""

_HEALTH_AVG = """
SELECT symbol, obs_date, close, adj_close, volume, daily_return,
       CASE WHEN count(*) OVER f50 = 50 THEN avg(adj_close) OVER f50 END AS s50,
       CASE WHEN count(*) OVER f200 = 200 THEN avg(adj_close) OVER f200 END AS s200,
       CASE WHEN count(*) OVER f21 = 21 THEN stddev_samp(daily_return) OVER f20 * sqrt(252) END AS vol,
       max(adj_close) OVER whole AS running_peak
FROM {src}
WINDOW f50 AS (PARTITION BY symbol ORDER BY obs_date ROWS 49 PRECEDING),
       f200 AS (PARTITION BY symbol ORDER BY obs_date ROWS 199 PRECEDING),
       f20 AS (PARTITION BY symbol ORDER BY obs_date ROWS 19 PRECEDING),
       f21 AS (PARTITION BY symbol ORDER BY obs_date ROWS 20 PRECEDING),
       whole AS (PARTITION BY symbol ORDER BY obs_date ROWS UNBOUNDED PRECEDING)"""
_HEALTH = """
SELECT symbol, obs_date, close, adj_close, volume, daily_return, s50 AS sma_50, s200 AS sma_200,
       adj_close > s200 AS above_sma_200,
       CASE WHEN s50 > s200 AND lag(s50) OVER d <= lag(s200) OVER d THEN 'golden_cross'
            WHEN s50 < s200 AND lag(s50) OVER d >= lag(s200) OVER d THEN 'death_cross' END AS cross_signal,
       vol AS vol_20d_ann, running_peak, adj_close / nullif(running_peak, 0) - 1 AS drawdown
FROM {src} WINDOW d AS (PARTITION BY symbol ORDER BY obs_date)"""
CTES["market_avg"] = _HEALTH_AVG.format(src="stg_markets")
CTES["company_avg"] = _HEALTH_AVG.format(src="stg_company_prices")
CTES["mart_market_daily"] = _HEALTH.format(src="market_avg")
CTES["mart_company_daily"] = _HEALTH.format(src="company_avg")

CTES["dim_symbol"] = """
SELECT symbol, name, description, asset_type, exchange_code, price_currency,
       ifnull(role, 'other') AS role, segment, symbol = 'ALL' AS is_benchmark,
       first_price_date, last_price_date
FROM tickers_raw LEFT JOIN watchlist USING (symbol)
LEFT JOIN (SELECT symbol, price_currency FROM any_listing) USING (symbol)
LEFT JOIN (SELECT symbol, min(obs_date) AS first_price_date, max(obs_date) AS last_price_date
           FROM stg_markets GROUP BY symbol) USING (symbol)"""

CTES["newest_sheet"] = "SELECT etf_symbol, max(as_of_date) AS newest FROM stg_etf_holdings GROUP BY etf_symbol"

CTES["dim_company"] = """
SELECT symbol,
       list_aggregate(list_transform(string_split(lower(last.holding_name), ' '),
                                     lambda w: upper(w[1]) || w[2:]), 'string_agg', ' ') AS name,
       last.etf_symbol AS sector_etf,
       (SELECT any_value(d.segment) FROM dim_symbol AS d WHERE d.symbol = last.etf_symbol) AS sector,
       last.exchange AS exchange, last.price_currency AS price_currency,
       last.weight AS latest_weight, first_held_date, last.as_of_date AS last_held_date,
       last.as_of_date = (SELECT any_value(n.newest) FROM newest_sheet AS n
                          WHERE n.etf_symbol = last.etf_symbol) AS is_current_holding,
       (SELECT min(b.obs_date) FROM stg_company_prices AS b WHERE b.symbol = held.symbol) AS first_price_date,
       (SELECT max(b.obs_date) FROM stg_company_prices AS b WHERE b.symbol = held.symbol) AS last_price_date
FROM (SELECT symbol, min(as_of_date) AS first_held_date,
             list(h ORDER BY as_of_date DESC, weight DESC, etf_symbol DESC)[1] AS last
      FROM stg_etf_holdings AS h WHERE is_equity GROUP BY symbol) AS held"""

CTES["held_now"] = """
SELECT * FROM stg_etf_holdings
WHERE is_equity AND (etf_symbol, as_of_date) IN (SELECT (etf_symbol, newest) FROM newest_sheet)"""

CTES["dim_symbol_hierarchy"] = """
SELECT pair.*, list_contains((SELECT list(DISTINCT etf_symbol) FROM held_now), pair.child_symbol)
               OR pair.child_symbol = 'ALL' AS has_children
FROM (SELECT 2 AS level, etf_symbol AS parent_symbol, symbol AS child_symbol, weight,
             (SELECT any_value(c.name) FROM dim_company AS c WHERE c.symbol = held_now.symbol) AS child_name
      FROM held_now
      UNION ALL BY NAME
      SELECT 1 AS level, symbol AS child_symbol, segment AS child_name, 'ALL' AS parent_symbol
      FROM dim_symbol WHERE list_contains(['bond', 'sector', 'size'], role)) AS pair"""


def _needed(sql: str) -> list[str]:
    found: set[str] = set()
    todo = [sql]
    while todo:
        words = set(re.findall(r"[a-z_0-9]+", todo.pop()))
        for name in words & CTES.keys() - found:
            found.add(name)
            todo.append(CTES[name])
    return [name for name in CTES if name in found]


def sql(body: str) -> str:
    """``body`` with every fixture or model table it names defined in front of it."""
    parts = [f"{name} AS ({CTES[name].strip()})" for name in _needed(body)]
    if not parts:
        return body.strip()
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()
