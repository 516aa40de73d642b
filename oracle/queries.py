"""DuckDB SQL for each registered query."""

from __future__ import annotations

from oracle.ctes import CTES, sql

ORACLE: dict[str, str] = {}
BODIES: dict[str, str] = {}


def put(name: str, body: str) -> None:
    BODIES[name] = body
    ORACLE[name] = sql(body)


def r6(*cols: str) -> str:
    return "REPLACE (" + ", ".join(f"round({c}, 6) AS {c}" for c in cols) + ")"


STAMP = "TIMESTAMP '2002-01-01 00:00:00'"
JOINED = "array_to_string(conditions, ',') AS conditions"

# --- sources -----------------------------------------------------------------------------
put("src_macro_obs", f"SELECT series_id, obs_date, value, {STAMP} AS _ingested_at FROM macro_raw WHERE value IS NOT NULL")
put("src_daily_bars", f"SELECT * REPLACE ({STAMP} AS _ingested_at) FROM company_prices_raw")
put("src_ticker_meta", f"""SELECT * REPLACE (CASE WHEN symbol <> 'ALL' THEN end_date END AS end_date,
  {STAMP} AS _ingested_at) FROM tickers_raw""")
put("src_universe", f"SELECT * REPLACE ({STAMP} AS _ingested_at) FROM tickers_universe")
put("src_news", f"SELECT * REPLACE ({STAMP} AS _ingested_at) FROM news_raw")
put("src_payload_rejects", """
SELECT key, reason, field, count(*) AS n_rejects FROM (
  SELECT DISTINCT symbol AS key, ['unreadable', 'other shape'][1 + year(obs_date) % 4] AS reason,
    NULL::VARCHAR AS field, year(obs_date) AS n FROM company_prices_raw WHERE year(obs_date) % 4 < 2
  UNION ALL SELECT symbol, 'bad number', 'volume', 0 FROM company_prices_raw WHERE year(obs_date) % 4 = 2
  UNION ALL SELECT symbol, 'bad date', 'date', 0 FROM company_prices_raw WHERE year(obs_date) % 4 = 3 AND day(obs_date) < 10)
GROUP BY ALL""")
put("src_payload_load", """
SELECT symbol, nullif(count(*) FILTER (day(obs_date) >= 10), 0) AS n_rows,
  max(obs_date) FILTER (day(obs_date) >= 10) AS newest, nullif(count(*) FILTER (day(obs_date) < 10), 0) AS n_rejects,
  min(strftime(obs_date, '%Y-%m-9') || day(obs_date)) FILTER (day(obs_date) < 10) AS first_raw
FROM company_prices_raw GROUP BY symbol""")
put("src_payload_rejects_kinds", """
SELECT * FROM (WITH elements AS (
  SELECT 'macro' AS kind, series_id AS page, year(obs_date) AS n FROM macro_raw
  UNION ALL SELECT 'bars', symbol, year(obs_date) FROM company_prices_raw
  UNION ALL SELECT 'news', row_number() OVER ()::VARCHAR, length(article_id) FROM news_raw
  UNION ALL SELECT 'trades', row_number() OVER ()::VARCHAR, trade_time FROM quotes_raw
  UNION ALL SELECT 'ticker', symbol, length(symbol) FROM tickers_raw),
fields AS (SELECT * FROM (VALUES ('macro', 2, 'value'), ('macro', 3, 'date'), ('bars', 2, 'volume'), ('bars', 3, 'date'),
  ('news', 3, 'crawlDate'), ('trades', 2, 't'), ('ticker', 3, 'endDate')) AS t(kind, rest, field))
SELECT kind, CASE rest WHEN 2 THEN 'bad number' ELSE 'bad date' END AS reason, field, count(*) AS n_rejects
FROM elements JOIN fields USING (kind) WHERE n % 4 = rest GROUP BY ALL
UNION ALL
SELECT kind, ['unreadable', CASE kind WHEN 'ticker' THEN 'no text' ELSE 'other shape' END][1 + n % 4] AS reason,
  CASE WHEN kind = 'ticker' AND n % 4 = 1 THEN 'ticker' END AS field, count(*) FROM (SELECT DISTINCT * FROM elements)
WHERE n % 4 < 2 GROUP BY ALL)""")
put("src_universe_rejects", """
SELECT 'bad date' AS reason, 'endDate' AS field, '2099-02-30' AS raw, count(*) AS n_rejects
FROM tickers_universe WHERE dayofyear(start_date) % 7 = 0""")
put("src_holdings", f"""SELECT *, {STAMP} AS _ingested_at FROM (
  SELECT * REPLACE (CASE WHEN ticker = '-' THEN NULL ELSE symbol END AS symbol)
  FROM sheet_lines WHERE etf_symbol <> 'SMALL')""")
put("src_holdings_rejects", """SELECT etf_symbol, as_of_date || '.xlsx' AS sheet, 'unexpected columns' AS reason
FROM sheet_lines WHERE etf_symbol = 'SMALL' GROUP BY ALL""")
put("src_symbol_normalise", """SELECT p_partkey,
  CASE WHEN p_size > 3 THEN replace(upper(p_brand), '#', '-') END AS symbol FROM part""")
put("src_trade_files", f"SELECT * REPLACE ({JOINED}, {STAMP} AS _ingested_at) FROM quotes_raw")
put("src_trade_envelope", f"""SELECT symbol, price, volume, trade_time, {JOINED}
FROM quotes_raw, (VALUES (1), (2)) AS twice(n)""")
put("src_seed", """SELECT p_partkey::VARCHAR AS series_id, p_name AS indicator_name, p_type AS category,
  'monthly' AS frequency, 'index' AS units, 'The "' || p_name || '", as listed' AS description,
  p_brand AS why_it_matters FROM part""")
LISTED = "(SELECT DISTINCT upper(ticker) AS symbol FROM tickers_universe)"
MARKS = "(SELECT symbol, max(obs_date) AS watermark FROM company_prices_raw GROUP BY symbol)"
put("src_watermark", f"""SELECT symbol, watermark, ifnull(watermark - 400, DATE '2015-01-01') AS pull_start
FROM {LISTED} LEFT JOIN {MARKS} USING (symbol)""")
put("src_refresh_worklist", f"""SELECT symbol, watermark FROM {LISTED} LEFT JOIN {MARKS} USING (symbol)
ORDER BY watermark NULLS FIRST, symbol LIMIT 30""")
put("src_request_budget", f"""SELECT symbol, watermark, requests FROM (
  SELECT *, coalesce(sum(requests) OVER (ORDER BY watermark NULLS FIRST, symbol ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM (SELECT symbol, watermark, CASE WHEN a.symbol IS NULL THEN 1 ELSE 2 END AS requests
        FROM {LISTED} LEFT JOIN {MARKS} USING (symbol) LEFT JOIN (
          SELECT DISTINCT c.symbol FROM company_prices_raw AS c JOIN (
            SELECT symbol, max(obs_date) AS seen FROM company_prices_raw WHERE obs_date <= DATE '2001-09-10' GROUP BY symbol) AS m
          ON m.symbol = c.symbol
          WHERE c.obs_date > m.seen AND (coalesce(c.div_cash, 0) <> 0 OR c.split_factor IS DISTINCT FROM 1.0)) AS a USING (symbol)))
WHERE before < 30""")
put("src_newest_date", "SELECT 'news' AS source, max(published_date)::DATE AS pull_start FROM news_raw UNION ALL SELECT 'none', NULL")
put("src_stored_span", """SELECT 'obs_date' AS name, min(obs_date) AS oldest, max(obs_date) AS newest FROM company_prices_raw
UNION ALL SELECT 'month', date_trunc('month', min(obs_date))::DATE, date_trunc('month', max(obs_date))::DATE FROM company_prices_raw""")
put("src_corporate_actions", """
SELECT DISTINCT b.symbol
FROM (SELECT * FROM markets_raw UNION ALL SELECT * FROM company_prices_raw) AS b
JOIN (SELECT symbol, max(obs_date) AS seen FROM (SELECT symbol, obs_date FROM markets_raw
        UNION ALL SELECT symbol, obs_date FROM company_prices_raw)
      WHERE obs_date <= DATE '2001-09-10' GROUP BY symbol) AS m ON m.symbol = b.symbol
WHERE b.obs_date > m.seen
  AND (coalesce(b.div_cash, 0) <> 0 OR b.split_factor IS DISTINCT FROM 1.0)""")
put("src_corporate_reload", """
SELECT c.* FROM company_best AS c LEFT JOIN (
  SELECT DISTINCT b.symbol FROM company_best AS b
  JOIN (SELECT symbol, max(obs_date) AS seen FROM company_best WHERE obs_date <= DATE '2001-09-10' GROUP BY symbol) AS m
    ON m.symbol = b.symbol
  WHERE b.obs_date > m.seen AND b.obs_date >= DATE '2001-09-10'
    AND (coalesce(b.div_cash, 0) <> 0 OR b.split_factor IS DISTINCT FROM 1.0)) AS a ON a.symbol = c.symbol
WHERE a.symbol IS NOT NULL OR c.obs_date >= DATE '2001-09-10'""")
put("src_priced_companies", """
SELECT DISTINCT symbol FROM etf_holdings_raw AS h
WHERE as_of_date = (SELECT max(as_of_date) FROM etf_holdings_raw AS x WHERE x.etf_symbol = h.etf_symbol)
  AND symbol IN (SELECT upper(ticker) FROM tickers_universe WHERE asset_type = 'Stock')""")

# --- sinks -------------------------------------------------------------------------------
BAR_COLS = ("open, high, low, close, volume, adj_open, adj_high, adj_low, adj_close, adj_volume, "
            "div_cash, split_factor, _ingested_at")
MERGED = f"""
SELECT symbol, obs_date,
  CASE WHEN t.symbol IS NULL THEN 'inserted' WHEN i.symbol IS NOT NULL AND day(obs_date) = 7 THEN 'updated' ELSE 'kept' END AS _action,
  CASE WHEN _action = 'kept' THEN t ELSE i END AS kept_row
FROM (SELECT * FROM company_best WHERE obs_date <= DATE '2001-06-30') AS t
FULL JOIN (SELECT * REPLACE (CASE WHEN day(obs_date) = 7 THEN adj_close + 5 ELSE adj_close END AS adj_close,
                             CASE WHEN day(obs_date) = 8 THEN close + 5 ELSE close END AS close,
                             {STAMP} AS _ingested_at)
           FROM company_best WHERE obs_date >= DATE '2001-01-01') AS i USING (symbol, obs_date)"""
put("upsert_changed", f"SELECT unnest(kept_row), _action FROM ({MERGED})")
put("upsert_slices", f"SELECT unnest(kept_row) FROM ({MERGED})")
put("upsert_counts", f"""SELECT count(*) FILTER (_action = 'inserted') AS inserted,
  count(*) FILTER (_action = 'updated') AS updated FROM ({MERGED})""")
put("upsert_observed", f"""SELECT count(*) FILTER (_action = 'inserted') AS inserted,
  count(*) FILTER (_action = 'updated') AS updated, count(*) AS stored FROM ({MERGED})""")
put("upsert_insert_only", f"""SELECT * REPLACE (CASE WHEN source < 'n' THEN {STAMP} ELSE _ingested_at END AS _ingested_at)
FROM news_raw""")
put("overwrite_full", "SELECT * FROM tickers_universe")
put("replace_slice", """
SELECT * REPLACE (CASE WHEN etf_symbol = 'PROMO' AND as_of_date = DATE '2001-09-28'
                       THEN weight_pct / 2 ELSE weight_pct END AS weight_pct),
       (as_of_date + 1)::TIMESTAMP AS _ingested_at
FROM sheet_lines WHERE NOT (symbol IS NULL AND etf_symbol = 'PROMO' AND as_of_date = DATE '2001-09-28')""")
put("replace_run", """SELECT * REPLACE (CASE WHEN check_ts >= TIMESTAMP '2024-01-15' THEN 'retried' ELSE message END AS message)
FROM dq_results""")
put("incremental_merge", """
SELECT trade_key, any_value(symbol) AS symbol, any_value(price) AS price, any_value(volume) AS volume,
  any_value(array_to_string(conditions, ',')) AS conditions, any_value(trade_ts) AS trade_ts,
  any_value(et)::DATE AS trade_date,
  any_value(strftime(et, '%H:%M')) BETWEEN '09:30' AND '15:59' AS is_regular_session,
  coalesce(min(_ingested_at) FILTER (_ingested_at > TIMESTAMP '2024-01-16'), min(_ingested_at)) AS _ingested_at
FROM trades_keyed GROUP BY trade_key""")
put("scd2_snapshot", """
WITH p AS (SELECT *, p_size > 40 OR p_size = 5 AS ch, CASE WHEN p_size <> 5 THEN 'first text' END AS d1,
                  DATE '2001-06-30' AS e1 FROM part),
v AS (
  SELECT *, d1 AS description, e1 AS end_date, TIMESTAMP '2001-07-01' AS valid_from,
         CASE WHEN ch OR p_brand = 'Brand#3' THEN TIMESTAMP '2001-08-01' END AS valid_to
  FROM p WHERE p_brand <> 'Brand#4'
  UNION ALL
  SELECT *, CASE WHEN ch THEN 'second text' ELSE d1 END, CASE WHEN p_size < 10 THEN DATE '2001-07-31' ELSE e1 END,
         TIMESTAMP '2001-08-01', CASE WHEN ch THEN TIMESTAMP '2001-09-01' END
  FROM p WHERE p_brand <> 'Brand#3' AND (ch OR p_brand = 'Brand#4')
  UNION ALL
  SELECT *, d1, e1, TIMESTAMP '2001-09-01', NULL FROM p WHERE ch OR p_brand = 'Brand#3')
SELECT p_partkey::VARCHAR AS symbol, p_name AS name, p_type AS asset_type, p_brand AS exchange_code,
       DATE '1995-01-01' AS start_date, end_date, description, valid_from, valid_to FROM v""")
put("publish_with_docs", """
SELECT col_name, CASE col_name WHEN 'symbol' THEN 'Price symbol' WHEN 'sector' THEN 'Segment of the fund' ELSE '' END AS comment,
  (SELECT count(*) FROM dim_company) AS n_rows
FROM unnest(['symbol', 'name', 'sector_etf', 'sector', 'exchange', 'price_currency', 'latest_weight', 'first_held_date',
             'last_held_date', 'is_current_holding', 'first_price_date', 'last_price_date']) AS c(col_name)""")
put("publish_layered", "SELECT * FROM stg_macro")

# --- models ------------------------------------------------------------------------------
HEALTH = r6("daily_return", "sma_50", "sma_200", "vol_20d_ann", "drawdown")
RETURNS = ("return_1m", "return_3m", "return_6m")
put("stg_markets", f"SELECT * {r6('daily_return')} FROM stg_markets")
put("stg_company_prices", f"SELECT * {r6('daily_return')} FROM stg_company_prices")
put("stg_etf_holdings", "SELECT * FROM stg_etf_holdings")
put("stg_macro", "SELECT * FROM stg_macro")
put("stg_trades", "SELECT * FROM stg_trades")
put("int_macro_daily", f"SELECT * {r6('chg_3m', 'chg_12m', 'pct_chg_12m')} FROM int_macro_daily")
put("int_symbol_returns", f"SELECT * {r6(*RETURNS)} FROM int_symbol_returns")
put("snap_tickers", """
SELECT symbol, name, asset_type, exchange_code, start_date, end_date, description,
  TIMESTAMP '2001-07-01' AS valid_from,
  CASE WHEN symbol < 'M' THEN TIMESTAMP '2001-08-01' END AS valid_to FROM tickers_raw
UNION ALL
SELECT symbol, name, asset_type, exchange_code, start_date, end_date + 1, description || '.',
  TIMESTAMP '2001-08-01', NULL FROM tickers_raw WHERE symbol < 'M'""")
put("dim_indicator", """
SELECT indicators.*, first_obs_date, last_obs_date, first_obs_date IS NOT NULL AS is_loaded
FROM indicators LEFT JOIN (SELECT series_id, min(obs_date) AS first_obs_date, max(obs_date) AS last_obs_date
                           FROM macro_raw GROUP BY series_id) USING (series_id)""")
put("dim_date", """
SELECT date_day, year(date_day)::INTEGER AS year, quarter(date_day)::INTEGER AS quarter,
  month(date_day)::INTEGER AS month, monthname(date_day) AS month_name,
  (dayofweek(date_day) + 1)::INTEGER AS day_of_week, dayname(date_day) AS day_name,
  dayofweek(date_day) IN (0, 6) AS is_weekend, traded AS is_trading_day,
  date_day + 1 = date_trunc('month', date_day + 1) AS is_month_end,
  date_day + 1 = date_trunc('quarter', date_day + 1) AS is_quarter_end,
  date_day + 1 = date_trunc('year', date_day + 1) AS is_year_end,
  traded AND date_trunc('month', date_day) < DATE '2001-12-01'
    AND NOT EXISTS (SELECT 1 FROM stg_markets AS later WHERE later.obs_date > c.date_day
      AND date_trunc('month', later.obs_date) = date_trunc('month', c.date_day)) AS is_last_trading_day_of_month
FROM (SELECT date_day, date_day IN (SELECT obs_date FROM stg_markets) AS traded
      FROM (SELECT unnest(range((SELECT min(obs_date) FROM stg_markets)::TIMESTAMP,
                                TIMESTAMP '2002-01-01', INTERVAL 1 DAY))::DATE AS date_day)) AS c""")
put("dim_symbol", "SELECT * FROM dim_symbol")
put("dim_company", "SELECT * FROM dim_company")
put("dim_symbol_hierarchy", "SELECT * REPLACE (level::INTEGER AS level) FROM dim_symbol_hierarchy")
put("mart_market_daily", f"SELECT * {HEALTH} FROM mart_market_daily")
put("mart_company_daily", f"SELECT * {HEALTH} FROM mart_company_daily")
put("daily_price_health", f"""SELECT * {HEALTH} FROM (SELECT * FROM mart_market_daily
  UNION ALL SELECT * FROM mart_company_daily)""")

RANKED = ", ".join(
    f"CASE WHEN rel_{n} IS NOT NULL THEN (1 + count(*) FILTER (rel_{n} IS NOT NULL) OVER "
    f"(PARTITION BY {{g}} ORDER BY rel_{n} DESC NULLS LAST RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) "
    f"- count(*) OVER (PARTITION BY {{g}}, rel_{n}))::INTEGER END AS rank_{n}" for n in ("1m", "3m", "6m"))
put("mart_sector_relative_strength", f"""
SELECT * {r6(*RETURNS, *[f'spy_{r}' for r in RETURNS], 'rel_1m', 'rel_3m', 'rel_6m')} FROM (
 SELECT *, {RANKED.format(g='obs_date')} FROM (
  SELECT r.obs_date, r.symbol, r.return_1m, r.return_3m, r.return_6m,
    b.return_1m AS spy_return_1m, b.return_3m AS spy_return_3m, b.return_6m AS spy_return_6m,
    r.return_1m - b.return_1m AS rel_1m, r.return_3m - b.return_3m AS rel_3m, r.return_6m - b.return_6m AS rel_6m
  FROM int_symbol_returns AS r JOIN int_symbol_returns AS b ON b.obs_date = r.obs_date AND b.symbol = 'ALL'
  WHERE r.symbol IN (SELECT symbol FROM dim_symbol WHERE role IN ('sector', 'size', 'bond'))))""")
CTES["priced_days"] = """
SELECT symbol, obs_date, return_1m, return_3m, return_6m, above_sma_200, drawdown
FROM int_symbol_returns
LEFT JOIN (FROM mart_market_daily UNION ALL BY NAME FROM mart_company_daily) USING (symbol, obs_date)"""
CTES["family_days"] = """
 SELECT tree.parent_symbol, tree.child_symbol, obs_date, tree.level::INTEGER AS level, tree.weight, tree.has_children,
   COLUMNS(own.* EXCLUDE (symbol, obs_date)),
   up.return_1m AS parent_return_1m, up.return_3m AS parent_return_3m, up.return_6m AS parent_return_6m
 FROM priced_days AS own JOIN priced_days AS up USING (obs_date)
 JOIN dim_symbol_hierarchy AS tree ON (tree.child_symbol, tree.parent_symbol) = (own.symbol, up.symbol)"""
CTES["against_parent"] = """
 SELECT *, return_1m - parent_return_1m AS rel_1m, return_3m - parent_return_3m AS rel_3m,
   return_6m - parent_return_6m AS rel_6m
 FROM family_days"""
put("mart_drilldown_relative_strength", f"""
SELECT * {r6(*RETURNS, *[f'parent_{r}' for r in RETURNS], 'rel_1m', 'rel_3m', 'rel_6m', 'drawdown')} FROM (
 SELECT *, count(*) OVER (PARTITION BY parent_symbol, obs_date) AS children_reporting,
   count(DISTINCT child_symbol) OVER (PARTITION BY parent_symbol) AS children_priced,
   {RANKED.format(g='parent_symbol, obs_date')}
 FROM against_parent)""")
put("rank_across_tasks", """
SELECT symbol, obs_date,
  CASE WHEN return_1m IS NOT NULL THEN rank() OVER (PARTITION BY obs_date ORDER BY return_1m DESC NULLS LAST)::INTEGER END AS rank_1m,
  CASE WHEN return_6m IS NOT NULL THEN rank() OVER (PARTITION BY obs_date ORDER BY return_6m DESC NULLS LAST)::INTEGER END AS rank_6m
FROM int_symbol_returns""")
CTES["macro_wide"] = """
SELECT * FROM (
 PIVOT (SELECT date_day, series_id, value AS v, chg_3m AS c, pct_chg_12m AS p,
          100 * (pow(value / nullif(value_3m_ago, 0), 4) - 1) AS a FROM int_macro_daily)
 ON series_id IN ('DGS10', 'DGS2', 'T10Y2Y', 'FEDFUNDS', 'CPIAUCSL', 'UNRATE', 'UMCSENT', 'GDP')
 USING any_value(v) AS v, any_value(c) AS c, any_value(p) AS p, any_value(a) AS a GROUP BY date_day)"""
put("mart_macro_market_signals", f"""
SELECT * {r6('daily_return', 'fwd_21d_return', 'fedfunds_chg_3m', 'cpi_yoy_pct', 'cpi_3m_ann_pct', 'unrate_chg_3m', 'gdp_yoy_pct')}
FROM (
 SELECT day.symbol, day.obs_date, day.adj_close, day.daily_return,
   nth_value(adj_close, 22) OVER ahead / nullif(adj_close, 0) - 1 AS fwd_21d_return,
   DGS10_v AS dgs10, DGS2_v AS dgs2, T10Y2Y_v AS t10y2y, sign(T10Y2Y_v) = -1 AS curve_inverted,
   FEDFUNDS_v AS fedfunds, FEDFUNDS_c AS fedfunds_chg_3m,
   ['cutting', 'holding', 'hiking'][2 + (FEDFUNDS_c > 0.25)::INT - (FEDFUNDS_c < -0.25)::INT] AS fed_regime,
   CPIAUCSL_p AS cpi_yoy_pct, CPIAUCSL_a AS cpi_3m_ann_pct,
   ['falling', 'stable', 'rising'][2 + (CPIAUCSL_a > CPIAUCSL_p + 0.5)::INT - (CPIAUCSL_a < CPIAUCSL_p - 0.5)::INT]
     AS inflation_trend,
   UNRATE_v AS unrate, UNRATE_c AS unrate_chg_3m, UMCSENT_v AS umcsent, GDP_p AS gdp_yoy_pct
 FROM stg_markets AS day LEFT JOIN macro_wide ON date_day = day.obs_date
 WINDOW ahead AS (PARTITION BY day.symbol ORDER BY day.obs_date ROWS BETWEEN CURRENT ROW AND 21 FOLLOWING))""")
BARS = """
SELECT symbol, m::INTEGER AS bar_minutes,
  epoch_ms(epoch_us(trade_ts) // 60000000 // m * m * 60000) AS bar_start, min(trade_date) AS bar_date,
  arg_min(price, row(trade_ts, price)) AS open, max(price) AS high, min(price) AS low,
  arg_max(price, row(trade_ts, price)) AS close, sum(volume) AS volume,
  sum(price::DECIMAL(19, 8) * volume::DECIMAL(18, 6))::DOUBLE / nullif(sum(volume::DECIMAL(18, 6))::DOUBLE, 0) AS vwap,
  count(*) AS trade_count,
  bool_and(is_regular_session) AS is_regular_session
FROM {src}, (VALUES (1), (5)) AS w(m) GROUP BY ALL"""
put("mart_intraday_bars", BARS.format(src="stg_trades"))

# --- primitives --------------------------------------------------------------------------
put("prim_p1", "SELECT * FROM tickers_universe WHERE asset_type = 'Stock' AND exchange IN ('NYSE', 'ARCX')")
put("prim_p2", "SELECT etf_symbol, as_of_date, position, symbol IS NOT NULL AS has_symbol FROM etf_holdings_raw WHERE ticker IS NOT NULL")
put("prim_p3", """SELECT symbol, epoch_us(trade_ts) // 1000 AS trade_time, price FROM trades_keyed
WHERE hour(et) * 60 + minute(et) BETWEEN 570 AND 959""")
put("prim_p4", """SELECT symbol, obs_date, adj_close FROM markets_raw
WHERE div_cash IS DISTINCT FROM 0.5 AND split_factor IS DISTINCT FROM 1.0""")
put("prim_p5", """SELECT p_partkey, CASE WHEN p_size >= 30 THEN 'big' WHEN p_size >= 10 THEN 'middle' ELSE 'small' END AS size_class,
  (CASE p_type WHEN 'PROMO' THEN 1 WHEN 'LARGE' THEN 2 END)::INTEGER AS type_code FROM part""")
put("prim_p6", """SELECT symbol, trade_time, price FROM quotes_raw
WHERE trade_ts > (SELECT coalesce(max(trade_ts), TIMESTAMP '1900-01-01') FROM quotes_raw WHERE trade_ts < TIMESTAMP '2024-01-20')""")
put("prim_p7", "SELECT symbol, obs_date, adj_close, _ingested_at FROM markets_best")
put("prim_p8", """SELECT symbol, obs_date, adj_close FROM (
  SELECT * REPLACE (CASE WHEN day(obs_date) = 9 THEN low - 1 ELSE high END AS high,
                    CASE WHEN day(obs_date) <> 11 THEN close END AS close) FROM markets_raw)
WHERE close IS NULL OR low <= 0 OR high < low OR close NOT BETWEEN low AND high OR open NOT BETWEEN low AND high OR volume < 0""")
put("prim_j1", "SELECT m.symbol, obs_date, close, exchange FROM stg_markets AS m JOIN any_listing AS l ON l.symbol = m.symbol")
put("prim_j2", """SELECT symbol, m.obs_date, value AS dgs10 FROM stg_markets AS m
LEFT JOIN macro_raw AS x ON x.obs_date = m.obs_date AND x.series_id = 'DGS10'""")
put("prim_j3", """SELECT a.symbol, a.obs_date, a.close, b.close AS base_close FROM stg_markets AS a
JOIN stg_markets AS b ON a.obs_date = b.obs_date AND b.symbol = 'ALL'""")
put("prim_j4", """SELECT o.series_id, o.obs_date, o.value, p.value AS value_1m_ago
FROM (SELECT *, (obs_date - INTERVAL 1 MONTH)::DATE AS probe FROM stg_macro) AS o
ASOF LEFT JOIN stg_macro AS p ON p.series_id = o.series_id AND o.probe >= p.obs_date""")
put("prim_j5", """SELECT symbol, m::INTEGER AS bar_minutes, count(*) AS n,
  count(DISTINCT epoch_us(trade_ts) // (60000000 * m)) AS bars FROM quotes_raw, (VALUES (1), (5)) AS w(m) GROUP BY ALL""")
put("prim_j6", """SELECT etf_symbol, as_of_date, position, weight_pct FROM etf_holdings_raw
QUALIFY as_of_date = max(as_of_date) OVER (PARTITION BY etf_symbol)""")
put("prim_j7", """SELECT symbol, obs_date, obs_date <= DATE '2001-06-30' AS stored, obs_date >= DATE '2001-01-01' AS incoming
FROM company_best""")
put("prim_j8", f"SELECT symbol, coalesce(symbol IN (SELECT symbol FROM etf_holdings_raw WHERE symbol IS NOT NULL), false) AS is_held FROM {LISTED}")
W = "OVER (PARTITION BY symbol ORDER BY obs_date)"
put("prim_w1", f"SELECT symbol, obs_date, row_number() {W}::INTEGER AS day_n FROM stg_markets")
put("prim_w2", "SELECT symbol, obs_date, " + ", ".join(f"lag(adj_close, {n}) {W} AS lag_{n}" for n in (1, 21, 63, 126)) + " FROM stg_markets")
put("prim_w3", f"SELECT symbol, obs_date, lead(adj_close, 21) {W} AS lead_21 FROM stg_markets")
put("prim_w4", "SELECT symbol, obs_date, round(s50, 6) AS sma_50, round(s200, 6) AS sma_200 FROM market_avg")
put("prim_w5", "SELECT symbol, obs_date, round(vol, 6) AS vol_20d_ann FROM market_avg")
put("prim_w6", "SELECT symbol, obs_date, running_peak FROM market_avg")
put("prim_w7", f"SELECT symbol, obs_date, last_value(div_cash IGNORE NULLS) {W} AS last_dividend FROM markets_best")
put("prim_w8", """SELECT symbol, obs_date, CASE WHEN daily_return IS NOT NULL THEN
  rank() OVER (PARTITION BY obs_date, daily_return IS NULL ORDER BY daily_return DESC)::INTEGER END AS rank_return FROM stg_markets""")
put("prim_w9", "SELECT symbol, obs_date, count(*) OVER (PARTITION BY obs_date) AS reporting FROM stg_markets")
put("prim_w10", """SELECT symbol, obs_date, min(low) OVER y AS year_low, max(high) OVER y AS year_high FROM stg_markets
WINDOW y AS (PARTITION BY symbol, year(obs_date))""")
put("prim_w11", f"SELECT symbol, obs_date, cross_signal, lag(cross_signal) {W} AS prev_cross FROM mart_market_daily")
put("prim_agg", """SELECT symbol, count(*) AS n, sum(volume) AS shares, min(price) AS low, max(price) AS high,
  arg_min(price, row(trade_ts, price)) AS first_price, arg_max(price, row(trade_ts, price)) AS last_price,
  bool_and(volume >= 0) AS all_sized, count(DISTINCT trade_time) AS times,
  count(*) FILTER (volume = 0) AS unsized, max(price) FILTER (len(conditions) > 1) AS top_block,
  round(avg(CASE WHEN volume > 0 THEN 1.0::DOUBLE ELSE 0.0 END), 6) AS sized_rate FROM quotes_raw GROUP BY symbol""")
put("prim_having", "SELECT symbol, obs_date, count(*) AS n FROM markets_raw GROUP BY ALL HAVING count(*) > 1")
put("prim_collect_set", """SELECT trade_ts::DATE AS day, string_agg(DISTINCT symbol, ',' ORDER BY symbol) AS symbols
FROM quotes_raw GROUP BY ALL""")
put("prim_distinct", "SELECT DISTINCT obs_date FROM stg_markets")
put("prim_set_ops", f"""SELECT symbol, 0::BIGINT AS n FROM {LISTED} WHERE symbol NOT IN (SELECT symbol FROM etf_holdings_raw WHERE symbol IS NOT NULL)
UNION ALL SELECT symbol, count(*) FROM (SELECT symbol FROM markets_raw UNION ALL SELECT symbol FROM company_prices_raw) GROUP BY symbol""")
put("prim_topk", "SELECT symbol, obs_date, close FROM stg_markets ORDER BY close DESC, symbol, obs_date LIMIT 25")
TITLE = "list_aggregate(list_transform(string_split(lower({c}), ' '), lambda w: upper(w[1]) || w[2:]), 'string_agg', ' ')"
put("prim_fn_string", f"""SELECT p_partkey, upper(p_name) AS up, trim('  ' || p_name) AS tr, replace(p_brand, '#', '-') AS rep,
  concat_ws('|', p_brand, NULL, p_type) AS joined, array_to_string([p_brand, p_type], ',') AS arr,
  substring(p_name, 1, 10) AS sub, regexp_replace(p_name, '[aeiou]+', '*', 'g') AS masked,
  {TITLE.format(c='p_name')} AS title, sha256(p_name) AS digest FROM part""")
put("prim_fn_date", """SELECT o_orderkey, d, year(d)::INTEGER AS y, quarter(d)::INTEGER AS q, month(d)::INTEGER AS m,
  day(d)::INTEGER AS dom, (dayofweek(d) + 1)::INTEGER AS dow, last_day(d) AS eom, (d - INTERVAL 3 MONTH)::DATE AS back3,
  (DATE '2001-12-31' - d)::INTEGER AS age, d - 30 AS back30, monthname(d) AS month_name, dayname(d) AS day_name,
  (last_day(d) - d + 1)::INTEGER AS days_left FROM (SELECT o_orderkey, o_orderdate::DATE AS d FROM orders)""")
put("prim_fn_timestamp", """SELECT event_id, epoch_us(ts) // 1000000 AS sec, date_trunc('second', ts) AS whole,
  et::DATE AS et_date, strftime(et, '%H:%M') AS et_minute, date_trunc('second', ts) AS parsed,
  time_bucket(INTERVAL 5 MINUTE, ts) AS bar
FROM (SELECT *, (ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' AS et FROM events)""")
put("prim_fn_math", """SELECT event_id, round(sqrt(value), 6) AS root, round(pow(value / 700, 4), 6) AS p4, abs(value - 50) AS dist,
  floor(value / 5)::BIGINT AS bucket, round(value / nullif(json_extract(props, '$.k')::DOUBLE * 7, 0), 6) AS ratio FROM events""")
put("prim_fn_null", """SELECT series_id, obs_date, coalesce(value, -1.0) AS filled, nullif(value, 0.0) AS non_zero,
  NULL::DOUBLE AS empty, obs_date::VARCHAR AS day_text FROM macro_raw""")
put("prim_fn_json", "SELECT event_id, to_json({'event_type': event_type, 'event_id': event_id})::VARCHAR AS doc FROM events")
put("prim_fn_array", "SELECT symbol, trade_time, unnest(conditions) AS condition FROM quotes_raw")
put("mask_secrets", r"""SELECT doc_id, regexp_replace(text || ' key sk-ant-***', 'token = "[0-9a-f]+"', 'token = "***"', 'g') AS text
FROM documents""")

# --- streaming ---------------------------------------------------------------------------
put("stream_ingest", f"SELECT * REPLACE ({JOINED}, {STAMP} AS _ingested_at) FROM quotes_raw")
put("stream_append", f"SELECT * REPLACE ({JOINED}, {STAMP} AS _ingested_at) FROM quotes_raw")
put("stream_available_now", "SELECT symbol, count(*) AS n FROM quotes_raw GROUP BY symbol")
put("stream_trades", f"SELECT * REPLACE ({STAMP} AS _ingested_at) FROM stg_trades")
put("stream_bars", BARS.format(src="stg_trades"))
put("stream_stateful_trades", f"SELECT * REPLACE ({STAMP} AS _ingested_at) FROM stg_trades")
put("stream_stateful_bars", BARS.format(src="stg_trades"))
put("stream_stateful_missed", f"""SELECT * REPLACE ({STAMP} AS _ingested_at) FROM stg_trades
WHERE trade_ts < TIMESTAMP '2024-01-11'""")
NEWEST = "(SELECT max(trade_date) FROM stg_trades WHERE volume <= 80)"
put("late_trades", f"SELECT * FROM stg_trades WHERE volume > 80 AND trade_date < {NEWEST}")
put("late_trades_repair", BARS.format(
    src=f"(SELECT * FROM stg_trades WHERE volume <= 80 OR trade_date < {NEWEST})"))

# --- quality -----------------------------------------------------------------------------


def checked(name: str, table: str, severity: str, ok: str, message: str, observed: str, source: str) -> str:
    return f"""SELECT '{name}' AS check_name, '{table}' AS table_name, '{severity}' AS severity,
  CASE WHEN {ok} THEN 'pass' ELSE 'fail' END AS status, {message} AS message, to_json({observed})::VARCHAR AS observed
FROM ({source})"""


LAGS = """SELECT k, lag_days, coalesce(lim, {other}) AS lim, stored IS NULL AS is_missing
FROM (SELECT {key} AS k, (DATE '2001-12-31' - max(obs_date))::INTEGER AS lag_days, true AS stored FROM {table} GROUP BY 1)
FULL JOIN (VALUES {limits}) AS e(k, lim) USING (k)"""
BAR_LAGS = LAGS.format(key="symbol", table="markets_raw", other="90", limits="('ALL', 90), ('STANDARD', 90), ('NOSUCH', 90)")
MACRO_LAGS = LAGS.format(key="series_id", table="(SELECT series_id, obs_date FROM macro_raw UNION ALL VALUES ('UNDATED', NULL))", other="NULL", limits="('DGS10', 100), ('DGS2', 7), ('T10Y2Y', 7), "
                         "('CPIAUCSL', 100), ('UNRATE', 100), ('FEDFUNDS', 100), ('UMCSENT', 100), ('GDP', 230), ('ABSENT', 5)")
TOTALS = """SELECT count(*) FILTER (NOT is_missing) AS keys, max(lag_days) AS max_lag_days, count(*) FILTER (is_missing) AS missing,
  count(*) FILTER (NOT is_missing AND coalesce(lag_days > lim, lag_days IS NULL)) AS stale FROM ({lags})"""
FRESH = ("missing + stale = 0", "missing || ' keys missing, ' || stale || ' keys behind their limit.'",
         "{'keys': keys, 'max_lag_days': max_lag_days, 'missing': missing, 'stale': stale}")
put("chk_freshness_by_key",
    checked("markets_freshness", "markets_raw", "error", *FRESH, TOTALS.format(lags=BAR_LAGS)) + "\nUNION ALL\n"
    + checked("macro_freshness", "macro_raw", "error", *FRESH, TOTALS.format(lags=MACRO_LAGS)))
put("chk_freshness_detail", f"""SELECT k AS series_id, lag_days, lim::INTEGER AS max_lag_days,
  CASE WHEN is_missing THEN 'missing' WHEN lag_days > lim OR lag_days IS NULL THEN 'stale' ELSE 'current' END AS state FROM ({MACRO_LAGS})""")


def dup(name: str, table: str, keys: str) -> str:
    return checked(name, table, "error", "n = 0", f"n || ' keys ({keys}) stored more than once.'", "{'duplicate_keys': n}",
                   f"SELECT count(*) AS n FROM (SELECT {keys} FROM {table} GROUP BY ALL HAVING count(*) > 1)")


DUPES = dup("markets_duplicates", "markets_raw", "symbol, obs_date") + "\nUNION ALL\n" + dup("news_duplicates", "news_raw", "article_id")
put("chk_duplicate_keys", DUPES)
put("chk_ohlc_sanity", checked(
    "markets_ohlc_sanity", "markets_raw", "error", "n = 0", "n || ' impossible bars in the last 30 days.'", "{'bad_rows': n}",
    """SELECT count(*) AS n FROM (SELECT * REPLACE (CASE WHEN day(obs_date) = 1 THEN 0 ELSE low END AS low) FROM markets_raw)
    WHERE obs_date >= DATE '2001-11-04' - 30 AND (close IS NULL OR low <= 0 OR NOT high >= low
      OR close NOT BETWEEN low AND high OR open NOT BETWEEN low AND high OR volume < 0)"""))
JUMPS = """SELECT symbol, obs_date, prev_adj_close, adj_close FROM (
  SELECT *, lag(adj_close) OVER (PARTITION BY symbol ORDER BY obs_date, adj_close, split_factor NULLS FIRST) AS prev_adj_close
  FROM (SELECT DISTINCT symbol, obs_date, adj_close, split_factor FROM {table} WHERE obs_date >= DATE '2001-11-04' - {lead}))
WHERE obs_date >= DATE '2001-11-04' - {days} AND prev_adj_close > 0 AND split_factor = 1
  AND abs(adj_close / prev_adj_close - 1) > 0.15"""
JUMP = checked(
    "markets_adj_jump", "markets_raw", "warn", "n = 0", "n || ' adjusted closes moved over 15% in a day, no split.'",
    "{'n_jumps': n, 'jumps': listed}",
    f"""SELECT (SELECT count(*) FROM ({JUMPS.format(table='markets_raw', lead=40, days=30)})) AS n,
    coalesce((SELECT list(j ORDER BY j) FROM (SELECT * FROM ({JUMPS.format(table='markets_raw', lead=40, days=30)})
       ORDER BY symbol, obs_date, prev_adj_close LIMIT 20) AS j), []) AS listed""")
put("chk_price_jump", JUMP)
put("chk_price_jump_rows", JUMPS.format(table="company_prices_raw", lead=2010, days=2000))
INTEGRITY = checked(
    "macro_integrity", "macro_raw", "error", "d + n = 0", "d || ' repeated keys, ' || n || ' null values.'",
    "{'duplicate_keys': d, 'null_values': n}",
    """SELECT (SELECT count(*) FROM (SELECT 1 FROM macro_raw GROUP BY series_id, obs_date HAVING count(*) > 1)) AS d,
    (SELECT count(*) FROM macro_raw WHERE value IS NULL) AS n""")
put("chk_key_and_null", INTEGRITY)


def recency(name: str, where: str) -> str:
    return checked(
        name, "news_raw", "error", "lag <= 72",
        "'Newest row is ' || coalesce(round(lag)::BIGINT || 'h', 'unknown') || ' old (limit 72h); ' || recent || ' rows in 72h.'",
        "{'lag_hours': round(lag, 3), 'recent_rows': recent}",
        f"""SELECT epoch(TIMESTAMP '2024-01-03' - max(published_date)) / 3600 AS lag,
        count(*) FILTER (published_date >= TIMESTAMP '2023-12-31') AS recent FROM news_raw {where}""")


put("chk_recency_hours", recency("news_freshness", "") + "\nUNION ALL\n" + recency("empty_freshness", "WHERE source = 'none'"))
put("chk_last_session", checked(
    "quotes_last_session", "quotes_raw", "warn", "n >= 100 AND len(missing) = 0",
    "n || ' trades on ' || day || ' (at least 100); missing: ' || array_to_string(missing, ', ') || '.'",
    "{'session': day, 'rows': n, 'missing': missing}",
    """SELECT any_value(last_day_seen) AS day, count(*) AS n,
      list_filter(['click', 'error', 'purchase', 'refund', 'signup', 'view'], lambda x: NOT list_contains(list(DISTINCT symbol), x)) AS missing
    FROM quotes_raw, (SELECT max(trade_ts::DATE) AS last_day_seen FROM quotes_raw) WHERE trade_ts::DATE = last_day_seen"""))
AGE = "SELECT count(*) AS n, (DATE '2001-12-31' - max(_ingested_at::DATE))::INTEGER AS age FROM "
AGES = (checked("tickers_refresh", "tickers_raw", "error", "n = 7 AND age <= 2", "n || ' rows (want exactly 7), loaded ' || age || ' days ago.'",
            "{'rows': n, 'age_days': age}", AGE + "tickers_raw") + "\nUNION ALL\n"
    + checked("universe_refresh", "tickers_universe", "error", "n >= 50000 AND age <= 9",
              "n || ' rows (want at least 50000), loaded ' || age || ' days ago.'", "{'rows': n, 'age_days': age}", AGE + "tickers_universe"))
put("chk_row_count_age", AGES)
LATEST_RUN = """
SELECT 'job_runs:' || job_name AS check_name, job_name AS table_name, 'error' AS severity,
  CASE WHEN created IS NULL THEN 'fail'
       WHEN last IS NULL THEN CASE WHEN exists_h <= max_age THEN 'pass' ELSE 'fail' END
       WHEN last.result_state = 'SUCCESS' AND age_h <= max_age THEN 'pass' ELSE 'fail' END AS status,
  CASE WHEN created IS NULL THEN 'Job is not deployed.' WHEN last IS NULL THEN 'Job has not completed a run yet.'
       ELSE 'Latest run ' || last.run_id || ': ' || last.result_state || '.' END AS message,
  to_json({'run_id': last.run_id, 'result_state': last.result_state, 'age_hours': round(age_h, 1), 'exists_hours': round(exists_h, 1)})::VARCHAR AS observed
FROM (
  SELECT job_name, max_age, created, last,
    (epoch_us(TIMESTAMP '2024-01-31') // 1000000 - epoch_us(last.start_ts) // 1000000) / 3600 AS age_h,
    (epoch_us(TIMESTAMP '2024-01-31') // 1000000 - epoch_us(created) // 1000000) / 3600 AS exists_h
  FROM (VALUES ('view', 48), ('click', 1), ('signup', 30), ('purchase', 24), ('error', 240), ('weekly', 192),
               ('stalled', 24), ('absent', 24)) AS e(job_name, max_age)
  LEFT JOIN (SELECT job_name, min(start_ts) AS created FROM job_runs GROUP BY job_name
             UNION ALL VALUES ('weekly', TIMESTAMP '2024-01-28'), ('stalled', TIMESTAMP '2024-01-02')) USING (job_name)
  LEFT JOIN (SELECT job_name, arg_max(r, row(start_ts, run_id)) AS last FROM job_runs AS r WHERE end_ts IS NOT NULL GROUP BY job_name) USING (job_name))"""
put("chk_latest_run", LATEST_RUN)
SUITE_MACRO = LAGS.format(key="series_id", table="macro_raw", other="NULL", limits="('DGS10', 100), ('DGS2', 7), ('T10Y2Y', 7), "
                          "('CPIAUCSL', 100), ('UNRATE', 100), ('FEDFUNDS', 100), ('UMCSENT', 100), ('GDP', 230), ('ABSENT', 5)")
SUITE = " UNION ALL ".join(f"SELECT check_name, severity, status, observed FROM ({part})" for part in (
    checked("markets_freshness", "markets_raw", "error", *FRESH, TOTALS.format(lags=BAR_LAGS)),
    DUPES,
    checked("markets_ohlc_sanity", "markets_raw", "error", "n = 0", "''", "{'bad_rows': n}",
            """SELECT count(*) AS n FROM markets_raw
    WHERE obs_date >= DATE '2001-12-31' - 30 AND (close IS NULL OR low <= 0 OR NOT high >= low
      OR close NOT BETWEEN low AND high OR open NOT BETWEEN low AND high OR volume < 0)"""),
    JUMP.replace("2001-11-04", "2001-12-31"),
    checked("macro_freshness", "macro_raw", "error", *FRESH, TOTALS.format(lags=SUITE_MACRO)),
    INTEGRITY,
    recency("news_freshness", "").replace("2024-01-03", "2024-01-31").replace("2023-12-31", "2024-01-28"),
    checked("quotes_last_session", "quotes_raw", "warn", "n >= 100 AND len(missing) = 0", "''",
            "{'session': day, 'rows': n, 'missing': missing}",
            """SELECT any_value(m.day) AS day, count(q.symbol) AS n,
      list_filter(['click', 'error', 'purchase', 'refund', 'signup', 'view'],
        lambda x: NOT coalesce(list_contains(list(DISTINCT q.symbol), x), false)) AS missing
    FROM (SELECT max(obs_date) AS day FROM markets_raw) AS m LEFT JOIN quotes_raw AS q ON q.trade_ts::DATE = m.day"""),
    AGES, LATEST_RUN))
SUITE = f"SELECT 'run-1' AS run_id, * FROM ({SUITE}) UNION ALL SELECT 'run-1', 'broken_rule', 'error', 'error', '{{}}'"
put("chk_run_all", SUITE)
put("chk_suite_gate", f"""SELECT run_id, count(*) FILTER (status <> 'pass' AND severity = 'error') AS n_errors,
  count(*) FILTER (status <> 'pass' AND severity <> 'error') AS n_warnings,
  NOT coalesce(bool_or(status <> 'pass' AND severity = 'error'), false) AS passed,
  string_agg(DISTINCT check_name, ',' ORDER BY check_name) FILTER (status <> 'pass') AS failed
FROM ({SUITE}) GROUP BY run_id""")
put("dq_gate", """SELECT run_id, count(*) FILTER (status <> 'pass' AND severity = 'error') AS n_errors,
  count(*) FILTER (status <> 'pass' AND severity <> 'error') AS n_warnings,
  NOT bool_or(status <> 'pass' AND severity = 'error') AS passed FROM dq_results GROUP BY run_id""")
put("dq_incident_rollup", """SELECT run_id, TIMESTAMP '2024-01-31' AS created_ts,
  string_agg(DISTINCT check_name, ',' ORDER BY check_name) AS failed_checks, count(*) FILTER (severity = 'error') AS n_errors
FROM dq_results WHERE status <> 'pass' AND run_id NOT IN (SELECT run_id FROM dq_results WHERE check_ts < TIMESTAMP '2024-01-10')
GROUP BY run_id""")
put("dq_latest_run_results", "SELECT * FROM dq_results WHERE run_id = (SELECT arg_max(run_id, check_ts) FROM dq_results)")
put("dq_pass_rate", """SELECT check_name, round(avg((status = 'pass')::INTEGER), 6) AS pass_rate FROM dq_results
WHERE check_ts >= DATE '2024-01-31' - 20 GROUP BY check_name""")


def fresh(name: str, column: str, warn: int, error: int | None) -> str:
    worse = f"WHEN age > {error} THEN 'error'" if error is not None else ""
    return f"""SELECT '{name}' AS source, loaded_at, round(age, 6) AS age_days,
  CASE WHEN age IS NULL THEN 'error' {worse} WHEN age > {warn} THEN 'warn' ELSE 'pass' END AS status
FROM (SELECT max({column})::TIMESTAMP AS loaded_at,
  (1010016000 - epoch_us(max({column})::TIMESTAMP) // 1000000) / 86400 AS age FROM {name})"""


put("source_freshness", "\nUNION ALL\n".join([
    fresh("markets_raw", "obs_date", 4, 7), fresh("macro_raw", "obs_date", 7, 14),
    fresh("tickers_raw", "_ingested_at", 2, 4), fresh("tickers_universe", "_ingested_at", 9, 15),
    fresh("company_prices_raw", "obs_date", 4, 7), fresh("etf_holdings_raw", "_ingested_at", 9, 15),
    fresh("quotes_raw", "trade_ts", 4, None)]))
put("test_not_null", "SELECT etf_symbol, as_of_date, position FROM stg_etf_holdings WHERE symbol IS NULL")
put("test_unique", "SELECT ticker, count(*) AS n_rows FROM tickers_universe GROUP BY ticker HAVING count(*) > 1")
put("test_unique_combination", "SELECT symbol, obs_date, count(*) AS n_rows FROM company_prices_raw GROUP BY ALL HAVING count(*) > 1")
put("test_accepted_values", """SELECT etf_symbol, count(*) AS n_rows FROM stg_etf_holdings WHERE etf_symbol NOT IN ('PROMO', 'LARGE') GROUP BY ALL
UNION ALL SELECT role, count(*) FROM dim_symbol WHERE role NOT IN ('broad_market', 'sector', 'size', 'bond') GROUP BY ALL""")
put("test_relationships", "SELECT series_id, obs_date, value FROM stg_macro WHERE series_id NOT IN (SELECT series_id FROM indicators)")
put("test_accepted_range", """SELECT etf_symbol, as_of_date, position, weight FROM stg_etf_holdings WHERE weight NOT BETWEEN 0 AND 1
UNION ALL SELECT etf_symbol, as_of_date, position, weight FROM stg_etf_holdings WHERE is_equity AND weight <= 0.04""")
put("test_expression", f"SELECT * FROM ({BARS.format(src='stg_trades')}) WHERE close < open")


# Declared tests: (model, test, failing rows). Row rules are predicates, key rules count groups.
BAD_BAR = [("not_null:symbol", "symbol IS NULL"), ("not_null:obs_date", "obs_date IS NULL"),
           ("not_null:adj_close", "adj_close IS NULL"), ("accepted_range:adj_close", "adj_close <= 0")]
BAD_HEALTH = [("not_null:symbol", "symbol IS NULL"), ("not_null:obs_date", "obs_date IS NULL"),
              ("accepted_values:cross_signal", "cross_signal NOT IN ('golden_cross', 'death_cross')"),
              ("accepted_range:vol_20d_ann", "vol_20d_ann < 0"), ("accepted_range:drawdown", "drawdown < -1 OR drawdown > 0")]
ROW_RULES = {
    "dim_indicator": ("indicators", [
        ("not_null:series_id", "series_id IS NULL"),
        ("accepted_values:category", "category NOT IN ('inflation', 'labor', 'rates', 'growth', 'sentiment')"),
        ("accepted_values:frequency", "frequency NOT IN ('daily', 'monthly', 'quarterly')")]),
    "stg_markets": ("stg_markets", [*BAD_BAR, ("relationships:symbol", "symbol NOT IN (SELECT symbol FROM dim_symbol)")]),
    "stg_company_prices": ("stg_company_prices", [
        *BAD_BAR, ("relationships:symbol", "symbol NOT IN (SELECT symbol FROM dim_company)")]),
    "stg_etf_holdings": ("stg_etf_holdings", [
        *[(f"not_null:{c}", f"{c} IS NULL") for c in ("etf_symbol", "as_of_date", "position")],
        ("not_null:symbol", "is_equity AND symbol IS NULL"),
        ("accepted_values:etf_symbol", "etf_symbol NOT IN ('XLK', 'XLF', 'XLE', 'XLU')"),
        ("accepted_range:weight", "is_equity AND weight NOT BETWEEN 0 AND 1")]),
    "stg_macro": ("stg_macro", [
        *[(f"not_null:{c}", f"{c} IS NULL") for c in ("series_id", "obs_date", "value")],
        ("relationships:series_id", "series_id NOT IN (SELECT series_id FROM indicators)")]),
    "stg_trades": ("stg_trades", [
        *[(f"not_null:{c}", f"{c} IS NULL") for c in ("trade_key", "symbol", "price", "trade_ts")],
        ("accepted_range:price", "price <= 0")]),
    "int_symbol_returns": ("int_symbol_returns", BAD_BAR[:2]),
    "int_macro_daily": ("int_macro_daily", [
        *[(f"not_null:{c}", f"{c} IS NULL") for c in ("date_day", "series_id", "value")],
        ("accepted_range:days_since_obs", "days_since_obs < 0")]),
    "dim_symbol": ("dim_symbol", [
        ("not_null:symbol", "symbol IS NULL"), ("not_null:role", "role IS NULL"),
        ("accepted_values:role", "role NOT IN ('broad_market', 'sector', 'size', 'bond')")]),
    "dim_company": ("dim_company", [("not_null:symbol", "symbol IS NULL"), ("not_null:sector_etf", "sector_etf IS NULL")]),
    "dim_symbol_hierarchy": ("dim_symbol_hierarchy", [
        ("not_null:parent_symbol", "parent_symbol IS NULL"), ("not_null:child_symbol", "child_symbol IS NULL"),
        ("accepted_values:level", "level NOT IN (1, 2)")]),
    "mart_market_daily": ("mart_market_daily", BAD_HEALTH),
    "mart_company_daily": ("mart_company_daily", BAD_HEALTH),
    "mart_intraday_bars": (f"({BARS.format(src='stg_trades')})", [
        ("not_null:symbol", "symbol IS NULL"), ("not_null:bar_start", "bar_start IS NULL"),
        ("accepted_values:bar_minutes", "bar_minutes NOT IN (1, 5)"),
        ("expression:low <= open and low <= close and high >= open and high >= close",
         "least(open, close) < low OR greatest(open, close) > high")]),
}
for name in ("dim_date", "mart_sector_relative_strength", "mart_drilldown_relative_strength",
             "mart_macro_market_signals"):
    CTES[f"made_{name}"] = BODIES[name]
BAD_KEY = [("not_null:symbol", "symbol IS NULL"), ("not_null:obs_date", "obs_date IS NULL")]
ROW_RULES |= {
    "dim_date": ("made_dim_date", [("not_null:date_day", "date_day IS NULL")]),
    "mart_macro_market_signals": ("made_mart_macro_market_signals", [
        *BAD_KEY, ("accepted_values:fed_regime", "fed_regime NOT IN ('hiking', 'cutting', 'holding')"),
        ("accepted_values:inflation_trend", "inflation_trend NOT IN ('rising', 'falling', 'stable')")]),
    "mart_sector_relative_strength": ("made_mart_sector_relative_strength", [
        *BAD_KEY, ("accepted_range:rank_1m", "rank_1m NOT BETWEEN 1 AND 6")]),
    "mart_drilldown_relative_strength": ("made_mart_drilldown_relative_strength", [
        *[(f"not_null:{c}", f"{c} IS NULL") for c in ("parent_symbol", "child_symbol", "obs_date")],
        ("accepted_range:rank_1m", "rank_1m < 1")]),
}
KEY_RULES = {
    "dim_date": ("made_dim_date", "unique", "date_day"),
    **{m: (f"made_{m}", "unique_combination", "symbol,obs_date")
       for m in ("mart_macro_market_signals", "mart_sector_relative_strength")},
    "mart_drilldown_relative_strength": (
        "made_mart_drilldown_relative_strength", "unique_combination", "parent_symbol,child_symbol,obs_date"),
    "dim_indicator": ("indicators", "unique", "series_id"), "stg_trades": ("stg_trades", "unique", "trade_key"),
    "dim_symbol": ("dim_symbol", "unique", "symbol"), "dim_company": ("dim_company", "unique", "symbol"),
    "stg_markets": ("stg_markets", "unique_combination", "symbol,obs_date"),
    "stg_company_prices": ("stg_company_prices", "unique_combination", "symbol,obs_date"),
    "stg_etf_holdings": ("stg_etf_holdings", "unique_combination", "etf_symbol,as_of_date,position"),
    "stg_macro": ("stg_macro", "unique_combination", "series_id,obs_date"),
    "int_symbol_returns": ("int_symbol_returns", "unique_combination", "symbol,obs_date"),
    "int_macro_daily": ("int_macro_daily", "unique_combination", "date_day,series_id"),
    "dim_symbol_hierarchy": ("dim_symbol_hierarchy", "unique_combination", "parent_symbol,child_symbol"),
    "mart_market_daily": ("mart_market_daily", "unique_combination", "symbol,obs_date"),
    "mart_company_daily": ("mart_company_daily", "unique_combination", "symbol,obs_date"),
    "mart_intraday_bars": (f"({BARS.format(src='stg_trades')})", "unique_combination", "symbol,bar_minutes,bar_start"),
}
put("declared_tests", "\nUNION ALL\n".join(
    [f"SELECT '{m}' AS model, '{t}' AS test, count(*) AS failures FROM {src} WHERE {bad}"
     for m, (src, rules) in ROW_RULES.items() for t, bad in rules]
    + [f"SELECT '{m}', '{kind}:{keys}', count(*) FROM (SELECT 1 FROM {src} GROUP BY {keys} HAVING count(*) > 1)"
       for m, (src, kind, keys) in KEY_RULES.items()]))
