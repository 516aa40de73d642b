"""Fixed values. Most are also defaults of function arguments; the windows of price health, the
regime bands and the forward days are not, as their columns are named after them."""

from __future__ import annotations

# --- fixed values: tracked symbols -> (role, segment) -----------------------------------
WATCHLIST = {
    "SPY": ("broad_market", "S&P 500"),
    "QQQ": ("broad_market", "Nasdaq 100"),
    "DIA": ("broad_market", "Dow Jones Industrial Average"),
    "IWM": ("size", "Russell 2000 small caps"),
    "XLF": ("sector", "Financials"),
    "XLE": ("sector", "Energy"),
    "XLK": ("sector", "Technology"),
    "XLU": ("sector", "Utilities"),
    "TLT": ("bond", "20+ year Treasuries"),
}
BENCHMARK = "SPY"
OTHER_ROLE = "other"
COMPARED_ROLES = ("sector", "size", "bond")

# --- fixed values: trailing horizons in trading days -----------------------------------
HORIZONS = {"1m": 21, "3m": 63, "6m": 126}
FORWARD_DAYS = 21

# --- fixed values: price-health windows in trading days ---------------------------------
SHORT_SMA = 50
LONG_SMA = 200
VOL_DAYS = 20
TRADING_DAYS_PER_YEAR = 252

# --- fixed values: macro series and regime limits ---------------------------------------
MACRO_SERIES = ("CPIAUCSL", "UNRATE", "FEDFUNDS", "DGS10", "DGS2", "T10Y2Y", "GDP", "UMCSENT")
MACRO_REPULL_DAYS = 400
FED_BAND = 0.25
INFLATION_BAND = 0.5
MISSING_MARKER = "."

# --- fixed values: intraday -------------------------------------------------------------
MARKET_ZONE = "America/New_York"
SESSION_FIRST_MINUTE = "09:30"
SESSION_LAST_MINUTE = "15:59"
BAR_MINUTES = (1, 5)

# --- fixed values: holdings sheet layout ------------------------------------------------
HOLDINGS_COLUMNS = (
    "Name", "Ticker", "Identifier", "SEDOL", "Weight", "Sector", "Shares Held", "Local Currency",
)
HOLDINGS_META_ROWS = 4

# --- fixed values: snapshot columns compared for a new version --------------------------
TICKER_CHECK_COLS = ("name", "exchange_code", "asset_type", "description", "start_date")

# --- fixed values: columns whose change rewrites a stored daily bar ---------------------
BAR_CHANGE_COLS = ("adj_open", "adj_high", "adj_low", "adj_close", "adj_volume")
WATCHLIST_BACKFILL = "1990-01-01"
COMPANY_BACKFILL = "2015-01-01"
COMPANY_BUDGET = 30

# --- fixed values: quality limits -------------------------------------------------------
BAR_MAX_LAG_DAYS = 4
BAR_MAX_MOVE = 0.15
BAR_SANITY_DAYS = 30
BAR_LEAD_IN_DAYS = 10
JUMPS_LISTED = 20
MACRO_MAX_LAG_DAYS = {
    "DGS10": 7, "DGS2": 7, "T10Y2Y": 7,
    "CPIAUCSL": 100, "UNRATE": 100, "FEDFUNDS": 100, "UMCSENT": 100,
    "GDP": 230,
}
NEWS_MAX_LAG_HOURS = 72
NEWS_RECENT_HOURS = 72
QUOTES_MIN_ROWS = 1000
UNIVERSE_MIN_ROWS = 50_000
UNIVERSE_MAX_AGE_DAYS = 9
TICKERS_MAX_AGE_DAYS = 2
PASS_RATE_DAYS = 30

# --- fixed values: source freshness limits in days (loaded-at column, warn, error) ------
SOURCE_FRESHNESS = {
    "markets_raw": ("obs_date", 4, 7),
    "macro_raw": ("obs_date", 7, 14),
    "quotes_raw": ("trade_ts", 4, None),
    "tickers_raw": ("_ingested_at", 2, 4),
    "tickers_universe": ("_ingested_at", 9, 15),
    "company_prices_raw": ("obs_date", 4, 7),
    "etf_holdings_raw": ("_ingested_at", 9, 15),
}

# --- fixed values: secret pattern -> mask -----------------------------------------------
SECRET_PATTERNS = ((r"sk-ant-[A-Za-z0-9_\-]+", "sk-ant-***"),)

