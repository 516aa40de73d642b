"""The standing checks over the bronze tables, as one registry."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from barloom import constants as C
from barloom.quality import checks as Q
from barloom.quality.run import Check


@dataclass(frozen=True)
class Limits:
    """What the checks expect; the defaults are those of the tracked tables."""

    bars: Mapping[str, int] = field(default_factory=lambda: dict.fromkeys(C.WATCHLIST, C.BAR_MAX_LAG_DAYS))
    other_bars: int | None = C.BAR_MAX_LAG_DAYS
    macro: Mapping[str, int] = field(default_factory=lambda: dict(C.MACRO_MAX_LAG_DAYS))
    news_hours: int = C.NEWS_MAX_LAG_HOURS
    quote_symbols: Sequence[str] = tuple(C.WATCHLIST)
    quote_rows: int = C.QUOTES_MIN_ROWS
    tickers: int = len(C.WATCHLIST)
    tickers_days: int = C.TICKERS_MAX_AGE_DAYS
    universe: int = C.UNIVERSE_MIN_ROWS
    universe_days: int = C.UNIVERSE_MAX_AGE_DAYS
    #: Tables whose source may be switched off; their checks then give no result.
    news_enabled: bool = True
    quotes_enabled: bool = True


def standard_checks(table: Callable[[str], DataFrame], today, now, limits: Limits = Limits(),
                    jobs: Callable[[], tuple[DataFrame, DataFrame, DataFrame]] | None = None) -> dict[str, Check]:
    """The twelve checks by name. ``table`` gives a bronze table by its name, when the check runs,
    so that a table that cannot be read costs its own checks only; ``jobs`` gives the expected
    jobs, the deployed ones and their runs."""
    def fresh(name: str, key: str, check: str, expected: Mapping[str, int], other: int | None) -> Check:
        def run() -> DataFrame:
            df = table(name)
            return Q.check_freshness_by_key(df, check, name, key, "obs_date", Q.limits_frame(df, expected, key), today, other)
        return run

    checks: dict[str, Check] = {
        "markets_freshness": fresh("markets_raw", "symbol", "markets_freshness", limits.bars, limits.other_bars),
        "markets_duplicates": lambda: Q.check_duplicate_keys(
            table("markets_raw"), "markets_duplicates", "markets_raw", ["symbol", "obs_date"]),
        "markets_ohlc_sanity": lambda: Q.check_ohlc_sanity(
            table("markets_raw"), "markets_ohlc_sanity", "markets_raw", today),
        "markets_adj_jump": lambda: Q.check_price_jump(table("markets_raw"), "markets_adj_jump", "markets_raw", today),
        "macro_freshness": fresh("macro_raw", "series_id", "macro_freshness", limits.macro, None),
        "macro_integrity": lambda: Q.check_key_and_null(
            table("macro_raw"), "macro_integrity", "macro_raw", ["series_id", "obs_date"], "value"),
        "news_freshness": lambda: Q.check_recency_hours(
            table("news_raw"), "news_freshness", "news_raw", "published_date", now, limits.news_hours,
            enabled=limits.news_enabled),
        "news_duplicates": lambda: Q.check_duplicate_keys(
            table("news_raw"), "news_duplicates", "news_raw", ["article_id"]).limit(1 if limits.news_enabled else 0),
        "quotes_last_session": lambda: Q.check_last_session(
            table("quotes_raw"), table("markets_raw"), "quotes_last_session", "quotes_raw", limits.quote_symbols,
            limits.quote_rows, enabled=limits.quotes_enabled),
        "tickers_refresh": lambda: Q.check_row_count_age(
            table("tickers_raw"), "tickers_refresh", "tickers_raw", today, limits.tickers_days, exact=limits.tickers),
        "universe_refresh": lambda: Q.check_row_count_age(
            table("tickers_universe"), "universe_refresh", "tickers_universe", today, limits.universe_days,
            minimum=limits.universe),
    }
    if jobs is not None:
        checks["job_runs"] = lambda: Q.check_latest_run(*jobs(), now)
    return checks
