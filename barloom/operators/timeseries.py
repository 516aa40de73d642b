"""Ordered-window operators over (symbol, day) series.

Each one partitions by the series key only. A series holds one row per calendar day once its
key is unique, so a window partition is bounded by the calendar however many symbols exist.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom import constants as C
from barloom.functions.columns import change

def by_day():
    return Window.partitionBy("symbol").orderBy("obs_date")


def _frame(rows: int):
    return by_day().rowsBetween(1 - rows, Window.currentRow)


def trailing_returns(prices: DataFrame, horizons: Mapping[str, int] = C.HORIZONS,
                     price: str = "adj_close") -> DataFrame:
    """Add ``return_<name>`` over each horizon, counted in rows."""
    return prices.withColumns({
        f"return_{name}": change(F.col(price), F.lag(price, rows).over(by_day()))
        for name, rows in horizons.items()
    })


def forward_return(prices: DataFrame, rows: int, name: str, price: str = "adj_close") -> DataFrame:
    return prices.withColumn(name, change(F.lead(price, rows).over(by_day()), F.col(price)))


# Rolling sums are stacked: ten rows, five of those, four of those again. A row then costs 17
# additions instead of 250, nothing is ever subtracted, so no error builds up along the series,
# and a flat price gives exactly equal averages.
_BASE = 10


def _stack(column: str, width: int, copies: int) -> Column:
    """Sum of ``copies`` adjacent frames of ``width`` rows each, added pairwise."""
    parts = [F.lag(column, k * width).over(by_day()) if k else F.col(column)
             for k in range(copies)]
    while len(parts) > 1:
        pairs = [parts[i] + parts[i + 1] for i in range(0, len(parts) - 1, 2)]
        parts = pairs + parts[len(parts) - len(parts) % 2:]
    return parts[0]


def price_health(prices: DataFrame) -> DataFrame:
    """Trend, crosses, volatility and drawdown per (symbol, day).

    All frames share one partitioning and order, so the whole function needs one exchange and
    one sort; the lags of the sums and of the averages reuse both.
    """
    so_far = by_day().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    long_copies = C.LONG_SMA // C.SHORT_SMA
    day_n = F.col("_day_n")

    def average(total: str, rows: int) -> Column:
        """Mean of the non-null values in the last ``rows`` rows, once there are that many."""
        seen = F.col("_seen") - F.coalesce(F.lag("_seen", rows).over(by_day()), F.lit(0))
        return F.when(day_n >= rows, F.try_divide(F.col(total), seen))

    windows = {
        "_day_n": F.row_number().over(by_day()),
        "_seen": F.count("adj_close").over(so_far),
        "_base": F.coalesce(F.sum("adj_close").over(_frame(_BASE)), F.lit(0.0)),
        "_vol": F.stddev_samp("daily_return").over(_frame(C.VOL_DAYS)),
        "running_peak": F.max("adj_close").over(so_far),
    }
    return (
        prices.select("symbol", "obs_date", "close", "adj_close", "volume", "daily_return")
        .withColumns(windows)
        .withColumn("_short", _stack("_base", _BASE, C.SHORT_SMA // _BASE))
        .withColumn("_long", _stack("_short", C.SHORT_SMA, long_copies))
        .withColumns({
            "sma_50": average("_short", C.SHORT_SMA),
            "sma_200": average("_long", C.LONG_SMA),
            # The first day has no return, so VOL_DAYS returns need one more row.
            "vol_20d_ann": F.when(
                day_n > C.VOL_DAYS,
                F.col("_vol") * F.sqrt(F.lit(float(C.TRADING_DAYS_PER_YEAR)))),
        })
        .withColumns({
            "_was_50": F.lag("sma_50").over(by_day()),
            "_was_200": F.lag("sma_200").over(by_day()),
        })
        .select(
            "symbol", "obs_date", "close", "adj_close", "volume", "daily_return",
            "sma_50", "sma_200",
            (F.col("adj_close") > F.col("sma_200")).alias("above_sma_200"),
            _cross(F.col("_was_50"), F.col("_was_200"), F.col("sma_50"), F.col("sma_200"))
            .alias("cross_signal"),
            "vol_20d_ann", "running_peak",
            change(F.col("adj_close"), F.col("running_peak")).alias("drawdown"),
        )
    )


def _cross(was_short: Column, was_long: Column, short: Column, long: Column) -> Column:
    """Strict today, non-strict yesterday; a missing average makes every comparison null."""
    up = (short > long) & (was_short <= was_long)
    down = (short < long) & (was_short >= was_long)
    return F.when(up, "golden_cross").when(down, "death_cross")


def as_of_values(obs: DataFrame, months_back: Mapping[str, int]) -> DataFrame:
    """For each observation, the series value as of N calendar months earlier.

    Every observation also emits one probe per look-back, dated that many months earlier. In
    date order the last real value seen before a probe answers it, so all look-backs cost one
    exchange by series instead of a dense calendar and one join each.
    """
    probes = [
        F.struct(F.add_months("obs_date", -n).alias("at"), F.lit(1).alias("is_probe"),
                 F.lit(name).alias("probe"), F.lit(None).cast("double").alias("seen"))
        for name, n in months_back.items()
    ]
    own = F.struct(F.col("obs_date").alias("at"), F.lit(0).alias("is_probe"),
                   F.lit("own").alias("probe"), F.col("value").alias("seen"))
    so_far = (Window.partitionBy("series_id").orderBy("at", "is_probe")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    answered = (
        obs.select("series_id", "obs_date", F.inline(F.array(own, *probes)))
        .withColumn("as_of", F.last("seen", ignorenulls=True).over(so_far))
    )
    pick = {name: F.max(F.when(F.col("probe") == name, F.col("as_of"))).alias(name)
            for name in months_back}
    return answered.groupBy("series_id", "obs_date").agg(
        F.max(F.when(F.col("probe") == "own", F.col("seen"))).alias("value"), *pick.values())


def carry_forward(obs: DataFrame, as_of_date) -> DataFrame:
    """One row per day from each series' first observation to ``as_of_date``.

    An observation covers the days up to the one before its successor, so the daily grid is an
    explode of ranges: no calendar join and no running frame.
    """
    nxt = F.lead("obs_date").over(Window.partitionBy("series_id").orderBy("obs_date"))
    end = F.date_sub(F.coalesce(nxt, F.date_add(F.lit(as_of_date).cast("date"), 1)), 1)
    return obs.withColumn("_end", end).select(
        "*", F.explode(F.sequence("obs_date", "_end")).alias("date_day")).drop("_end")
