"""Landed vendor data into the bronze tables, one job per source.

A job reads what has landed once (``payloads.load``), merges the rows into its table, and stores
what it could not use as the run's rejects. Every step may be repeated under the same run: merges
swap whole slices from a staging folder of the run, rejects replace the run's earlier ones.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom import constants as C
from barloom.sinks.tables import insert_slices, layer_path, replace_run, replace_slices, upsert_slices, write_version
from barloom.sources.holdings import holdings_rejects, parse_holdings
from barloom.sources.payloads import load, parse_universe, universe_rejects

#: Bronze tables by month of the day that a row is about, so that a pull rewrites a few slices.
SLICE = "slice_month"


@dataclass(frozen=True)
class BronzeRun:
    """Where the bronze tables lie, and the run that loads them."""

    spark: SparkSession
    root: str
    run_id: str
    loaded_at: object = None

    def path(self, table: str) -> str:
        return layer_path(self.root, table, {table: "bronze"})

    def staging(self, table: str) -> str:
        return f"{self.root}/staging/{table}/{self.run_id}"

    def keep_rejects(self, table: str, rejects: DataFrame) -> None:
        stamped = rejects.select(F.lit(self.run_id).alias("run_id"), "*")
        replace_run(stamped, self.path(f"{table}_rejects"), self.run_id)


def _sliced(rows: DataFrame, day: str) -> DataFrame:
    return rows.withColumn(SLICE, F.date_format(day, "yyyy-MM"))


def load_bars(run: BronzeRun, table: str, landed: DataFrame) -> dict[str, int]:
    """Daily bars: new days are added, a stored day is rewritten if its adjusted values moved."""
    rows, rejects = load(landed, "bars", "symbol", run.loaded_at)
    run.keep_rejects(table, rejects)
    return upsert_slices(run.spark, run.path(table), _sliced(rows, "obs_date"), ["symbol", "obs_date"], [SLICE],
                         run.staging(table), C.BAR_CHANGE_COLS)


def load_macro(run: BronzeRun, landed: DataFrame) -> dict[str, int]:
    """Observations: new ones are added, a revised value replaces the stored one."""
    rows, rejects = load(landed, "macro", "series_id", run.loaded_at)
    run.keep_rejects("macro_raw", rejects)
    return upsert_slices(run.spark, run.path("macro_raw"), _sliced(rows, "obs_date"), ["series_id", "obs_date"], [SLICE],
                         run.staging("macro_raw"), ["value"])


def load_news(run: BronzeRun, landed: DataFrame) -> None:
    """Articles: those that are not stored yet are added. An article's month is that of its
    publication, so it keeps its slice; one without a date has a slice of its own."""
    rows, rejects = load(landed, "news", None, run.loaded_at)
    run.keep_rejects("news_raw", rejects)
    sliced = _sliced(rows, "published_date").withColumn(SLICE, F.coalesce(SLICE, F.lit("none")))
    insert_slices(run.spark, run.path("news_raw"), sliced, ["article_id"], [SLICE], run.staging("news_raw"))


def load_tickers(run: BronzeRun, landed: DataFrame, asset_types: DataFrame) -> None:
    """Symbol metadata: a new version of the whole table."""
    rows, rejects = load(landed, "ticker", "symbol", run.loaded_at, asset_types=asset_types)
    run.keep_rejects("tickers_raw", rejects)
    write_version(rows, run.path("tickers_raw"), run.run_id)


def load_universe(run: BronzeRun, listed: DataFrame) -> None:
    """The listing file: a new version of the whole table."""
    run.keep_rejects("tickers_universe", universe_rejects(listed))
    write_version(parse_universe(listed, run.loaded_at), run.path("tickers_universe"), run.run_id)


def load_holdings(run: BronzeRun, sheets: DataFrame) -> None:
    """Fund sheets: each replaces the fund's snapshot of its day."""
    run.keep_rejects("etf_holdings_raw", holdings_rejects(sheets))
    replace_slices(parse_holdings(sheets, run.loaded_at), run.path("etf_holdings_raw"), ["etf_symbol", "as_of_date"])


Job = Callable[..., object]
JOBS: dict[str, Job] = {
    "markets_raw": lambda run, landed: load_bars(run, "markets_raw", landed),
    "company_prices_raw": lambda run, landed: load_bars(run, "company_prices_raw", landed),
    "macro_raw": load_macro, "news_raw": load_news, "tickers_raw": load_tickers,
    "tickers_universe": load_universe, "etf_holdings_raw": load_holdings,
}
