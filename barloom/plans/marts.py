"""Gold marts."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom import constants as C
from barloom.operators.ranking import rank_in_window
from barloom.operators.timeseries import forward_return, price_health, trailing_returns
from barloom.session import written

mart_market_daily = price_health
mart_company_daily = price_health

_NAMES = tuple(C.HORIZONS)
_RETURNS = [f"return_{n}" for n in _NAMES]
_RANKS = {f"rank_{n}": f"rel_{n}" for n in _NAMES}

#: rank_in_window, or rank_across_tasks for groups that outgrow a task.
Ranking = Callable[[DataFrame, Sequence[str], Mapping[str, str]], DataFrame]


def _excess(base_prefix: str) -> list[Column]:
    return [(F.col(f"return_{n}") - F.col(f"{base_prefix}_return_{n}")).alias(f"rel_{n}")
            for n in _NAMES]


def _returns_as(prefix: str) -> list[Column]:
    return [F.col(r).alias(f"{prefix}_{r}") for r in _RETURNS]


def mart_sector_relative_strength(stg_markets: DataFrame, dim_symbol: DataFrame,
                                  benchmark: str = C.BENCHMARK,
                                  roles: Sequence[str] = C.COMPARED_ROLES,
                                  rank: Ranking = rank_in_window) -> DataFrame:
    """Role-filtered symbols against the benchmark, ranked per day.

    A day's group is at most as large as the list of compared symbols. Windows run over those and
    the benchmark only.
    """
    compared = dim_symbol.filter(F.col("role").isin(*roles)).select("symbol")
    used = stg_markets.select("symbol", "obs_date", "adj_close").join(
        compared.withColumn("_compared", F.lit(True)), "symbol", "left").filter(
        F.col("_compared") | (F.col("symbol") == benchmark))
    returns = trailing_returns(used)
    base = returns.filter(F.col("symbol") == benchmark).select("obs_date", *_returns_as("spy"))
    relative = returns.filter("_compared").join(base, "obs_date").select(
        "obs_date", "symbol", *_RETURNS, *[f"spy_{r}" for r in _RETURNS], *_excess("spy"))
    return rank(relative, ["obs_date"], _RANKS)


def _parent_rows(hierarchy: DataFrame, returns: DataFrame) -> DataFrame:
    """Returns of parents only, cut down before any join by day; parents are few."""
    parents = hierarchy.select("parent_symbol").distinct()
    return returns.withColumnRenamed("symbol", "parent_symbol").join(
        parents, "parent_symbol", "left_semi")


def _against_parents(edges: DataFrame, returns: DataFrame, health: DataFrame) -> DataFrame:
    """Each edge's child on each day its parent also has a row."""
    children = (
        edges.select("parent_symbol", "child_symbol", "level", "weight", "has_children")
        .join(returns.select(F.col("symbol").alias("child_symbol"), "obs_date", *_RETURNS),
              "child_symbol")
        .join(health.select(F.col("symbol").alias("child_symbol"), "obs_date",
                            "above_sma_200", "drawdown"),
              ["child_symbol", "obs_date"], "left")
    )
    parents = _parent_rows(edges, returns).select(
        "parent_symbol", "obs_date", *_returns_as("parent"))
    return children.join(parents, ["parent_symbol", "obs_date"]).select(
        "parent_symbol", "child_symbol", "obs_date", "level", "weight", "has_children",
        *_RETURNS, *[f"parent_{r}" for r in _RETURNS], *_excess("parent"),
        "above_sma_200", "drawdown")


def mart_drilldown_relative_strength(hierarchy: DataFrame, returns: DataFrame,
                                     market_daily: DataFrame, company_daily: DataFrame,
                                     rank: Ranking = rank_in_window) -> DataFrame:
    """Every child against its parent, ranked within (parent, day).

    A group holds one parent's children on one day, at most the listed symbols. For hierarchies
    whose groups outgrow a task the caller passes ``rank_across_tasks``.
    """
    columns = ["symbol", "obs_date", "above_sma_200", "drawdown"]
    health = market_daily.select(*columns).unionByName(company_daily.select(*columns))
    group = ["parent_symbol", "obs_date"]
    against = _against_parents(hierarchy, returns, health)
    if rank is rank_in_window:
        # Counted after the ranks: the rows are then already grouped, which saves a sort.
        ranked = rank(against, group, _RANKS).withColumn(
            "children_reporting", F.count("*").over(Window.partitionBy(*group)))
    else:
        against = written(against, "against-parents")
        reporting = against.groupBy(*group).agg(F.count("*").alias("children_reporting"))
        ranked = rank(against.join(reporting, group), group, _RANKS)

    # A priced child is one that shares at least one day with its parent, which needs only the
    # keys of the returns.
    days = returns.select("symbol", "obs_date")
    priced = (
        hierarchy.select("parent_symbol", "child_symbol")
        .join(days.withColumnRenamed("symbol", "child_symbol"), "child_symbol")
        .join(_parent_rows(hierarchy, days), group, "left_semi")
        .select("parent_symbol", "child_symbol").distinct()
        .groupBy("parent_symbol").agg(F.count("*").alias("children_priced"))
    )
    return ranked.join(priced, "parent_symbol").select(
        "parent_symbol", "child_symbol", "obs_date", "level", "weight", "has_children",
        *_RETURNS, *[f"parent_{r}" for r in _RETURNS], *[f"rel_{n}" for n in _NAMES],
        "above_sma_200", "drawdown", "children_reporting", "children_priced", *_RANKS)


def macro_pivot(macro_daily: DataFrame) -> DataFrame:
    """One row per day with the tracked series side by side; a single hash aggregate."""
    annualised = (F.pow(F.try_divide("value", "value_3m_ago"), F.lit(4.0)) - 1) * 100
    columns = {
        "dgs10": ("DGS10", F.col("value")),
        "dgs2": ("DGS2", F.col("value")),
        "t10y2y": ("T10Y2Y", F.col("value")),
        "fedfunds": ("FEDFUNDS", F.col("value")),
        "fedfunds_chg_3m": ("FEDFUNDS", F.col("chg_3m")),
        "cpi_yoy_pct": ("CPIAUCSL", F.col("pct_chg_12m")),
        "cpi_3m_ann_pct": ("CPIAUCSL", annualised),
        "unrate": ("UNRATE", F.col("value")),
        "unrate_chg_3m": ("UNRATE", F.col("chg_3m")),
        "umcsent": ("UMCSENT", F.col("value")),
        "gdp_yoy_pct": ("GDP", F.col("pct_chg_12m")),
    }
    return macro_daily.groupBy("date_day").agg(*[
        F.max(F.when(F.col("series_id") == series, value)).alias(name)
        for name, (series, value) in columns.items()])


def _three_way(value: Column, centre: Column, band: float, above: str, below: str,
               inside: str) -> Column:
    """Label outside a band around the centre; the band's edges count as inside."""
    return (
        F.when(value > centre + band, above).when(value < centre - band, below)
        .when(value.isNotNull() & centre.isNotNull(), inside)
    )


def mart_macro_market_signals(market_daily: DataFrame, macro_daily: DataFrame) -> DataFrame:
    """Each fund's trading day next to the macro picture of that day."""
    prices = forward_return(
        market_daily.select("symbol", "obs_date", "adj_close", "daily_return"),
        C.FORWARD_DAYS, "fwd_21d_return")
    return prices.join(
        macro_pivot(macro_daily).withColumnRenamed("date_day", "obs_date"), "obs_date", "left",
    ).select(
        "obs_date", "symbol", "adj_close", "daily_return", "fwd_21d_return",
        "dgs10", "dgs2", "t10y2y", (F.col("t10y2y") < 0).alias("curve_inverted"),
        "fedfunds", "fedfunds_chg_3m",
        _three_way(F.col("fedfunds_chg_3m"), F.lit(0.0), C.FED_BAND,
                   "hiking", "cutting", "holding").alias("fed_regime"),
        "cpi_yoy_pct", "cpi_3m_ann_pct",
        _three_way(F.col("cpi_3m_ann_pct"), F.col("cpi_yoy_pct"), C.INFLATION_BAND,
                   "rising", "falling", "stable").alias("inflation_trend"),
        "unrate", "unrate_chg_3m", "umcsent", "gdp_yoy_pct",
    )
