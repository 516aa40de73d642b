"""Intraday bars from trades."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom import constants as C
from barloom.functions.columns import bar_start

BAR_KEYS = ["symbol", "bar_minutes", "bar_start"]


# Sums and the order of trades are decimals, so that no result depends on the order of rows, and
# every aggregate has a buffer of fixed size, so that all of them are hash aggregates.
_PRICE, _TURNOVER_PRICE, _VOLUME = "decimal(23,12)", "decimal(19,8)", "decimal(18,6)"


def _tick_order(start: Column) -> Column:
    """Orders the trades of a bar by time, equal times by price (to 12 places)."""
    offset = (F.unix_micros("trade_ts") - F.unix_micros(start)).cast("decimal(11,0)")
    return offset * F.lit(10 ** 11).cast("decimal(12,0)") + F.col("price").try_cast(_PRICE)


def tick_aggregates(start: Column) -> list[Column]:
    """A bar's columns from its trades; ``start`` is the bar's start."""
    volume = F.col("volume").try_cast(_VOLUME)
    order = _tick_order(start)
    return [
        F.min("trade_date").alias("bar_date"),
        F.min_by("price", order).alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", order).alias("close"),
        F.sum(volume).alias("_volume"),
        F.sum(F.col("price").try_cast(_TURNOVER_PRICE) * volume).alias("_turnover"),
        F.count("*").alias("trade_count"),
        F.bool_and("is_regular_session").alias("is_regular_session"),
    ]


def _bar_aggregates() -> list[Column]:
    """A wide bar's columns from its narrow bars, each of which has a start of its own."""
    return [
        F.min("bar_date").alias("bar_date"),
        F.min_by("open", "bar_start").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", "bar_start").alias("close"),
        F.sum("_volume").alias("_volume"),
        F.sum("_turnover").alias("_turnover"),
        F.sum("trade_count").alias("trade_count"),
        F.bool_and("is_regular_session").alias("is_regular_session"),
    ]


def _start(ts: str, width: int) -> Column:
    return bar_start(F.col(ts), F.lit(width))


def finished(bars: DataFrame) -> DataFrame:
    """Bars with volume and VWAP as numbers."""
    volume = F.col("_volume").cast("double")
    return bars.select(
        *BAR_KEYS, "bar_date", "open", "high", "low", "close", volume.alias("volume"),
        F.try_divide(F.col("_turnover").cast("double"), volume).alias("vwap"),
        "trade_count", "is_regular_session")


def intraday_bars(trades: DataFrame, widths: Sequence[int] = C.BAR_MINUTES) -> DataFrame:
    """OHLCV and VWAP per (symbol, width, start).

    Trades are folded once, into the narrowest bars; wider bars are folded from those, so raw
    trades are read and shuffled once however many widths there are, and never sorted. First
    and last price are ordered by (time, price), which also settles equal times. Volumes count to
    six places, prices to eight in the VWAP.
    """
    narrow, *wider = sorted(widths)
    if any(w % narrow for w in wider):
        raise ValueError(f"bar widths {widths} must be multiples of the narrowest")
    start = _start("trade_ts", narrow)
    base = trades.groupBy("symbol", start.alias("bar_start")).agg(*tick_aggregates(start))
    out = base.withColumn("bar_minutes", F.lit(narrow))
    for width in wider:
        out = out.unionByName(
            base.groupBy("symbol", _start("bar_start", width).alias("__start")).agg(*_bar_aggregates())
            .withColumnRenamed("__start", "bar_start").withColumn("bar_minutes", F.lit(width)))
    return finished(out)


def affected_bars(late: DataFrame, trades: DataFrame,
                  widths: Sequence[int] = C.BAR_MINUTES) -> DataFrame:
    """Bars to rebuild for late trades: whole bars, recomputed from every trade they hold.

    The widest bar covers all narrower ones, so trades are first cut down to the touched wide
    bars, and the bars built from them to the touched keys.
    """
    widest = max(widths)
    slot = bar_start(F.col("trade_ts"), F.lit(widest)).alias("_slot")
    touched = late.select("symbol", slot).distinct()
    # A slot lies in one day or reaches into the next one; the range of days prunes the scan.
    days = late.agg(F.date_sub(F.min("trade_date"), 1).alias("low"), F.date_add(F.max("trade_date"), 1).alias("high"))
    near = trades.filter(F.col("trade_date").between(days.select("low").scalar(), days.select("high").scalar()))
    inside = near.withColumn("_slot", slot).join(touched, ["symbol", "_slot"], "left_semi")
    keys = late.select("symbol", "trade_ts").withColumn(
        "bar_minutes", F.explode(F.array(*[F.lit(w) for w in widths]))).select(
        "symbol", "bar_minutes",
        bar_start(F.col("trade_ts"), F.col("bar_minutes")).alias("bar_start")).distinct()
    return intraday_bars(inside.drop("_slot"), widths).join(keys, BAR_KEYS, "left_semi")
