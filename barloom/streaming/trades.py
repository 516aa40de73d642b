"""Trade streams: landed files to bronze, silver trades and bars.

The high-water marks are load times and bar dates, not event time, so late events are never
dropped by a watermark. Each micro-batch is merged with ``foreachBatch``; the staging folder is
named by the batch id, which makes a replayed batch idempotent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from barloom.operators.bars import BAR_KEYS, affected_bars, intraday_bars
from barloom.operators.merge import upsert
from barloom.plans.staging import stg_trades
from barloom.sinks.tables import merge_slices, stored_span, swap_slices
from barloom.sources.trades import stream_trade_files


def append_stream(trades: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Drain what has landed into the bronze table, then stop. Each file is read once."""
    return (
        trades.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint).option("path", path)
        .trigger(availableNow=True).start()
    )


def merge_trades(batch: DataFrame, path: str, staging: str) -> None:
    """Merge trades into the silver table. A re-delivered key replaces its stored row.

    The key covers the trade time, so a key lives in one trade date and only the dates present
    in the batch are rewritten.
    """
    merge_slices(
        batch.sparkSession, path, stg_trades(batch), ["trade_date"],
        lambda old, new: upsert(old, new, ["trade_key"]), staging)


def rebuild_bars(spark: SparkSession, trades: DataFrame, path: str, staging: str) -> None:
    """Rebuild bars from the newest stored bar date onward; earlier dates are left alone.

    ``staging`` belongs to one run. The days are complete there before the first is swapped in,
    so a repeat after a cut swap puts in all of them, whatever is stored by then.
    """
    def make() -> DataFrame:
        # The newest date is the name of a folder; no bar is read for it.
        span = stored_span(spark, path, "bar_date", in_folders=True)
        if span is None or span["newest"] is None:
            return intraday_bars(trades)
        return intraday_bars(trades.filter(F.col("trade_date") >= F.lit(span["newest"])))

    swap_slices(spark, path, ["bar_date"], staging, make)


def late_trades(trades: DataFrame, bars: DataFrame, loaded_after: DataFrame) -> DataFrame:
    """Trades that arrived for days before the newest bar date, which no rebuild will see.

    ``loaded_after`` holds what was loaded since, with its trade dates: their range prunes the
    stored days before the keys are joined.
    """
    newest = bars.agg(F.max("bar_date").alias("d")).scalar()
    days = loaded_after.agg(F.min("trade_date").alias("low"), F.max("trade_date").alias("high"))
    first, last = (days.select(c).scalar() for c in ("low", "high"))
    old = trades.filter((F.col("trade_date") < newest) & F.col("trade_date").between(first, last))
    return old.join(loaded_after.select("trade_date", "trade_key"), ["trade_date", "trade_key"], "left_semi").select(
        *trades.columns)


def repair_late_bars(bars: DataFrame, trades: DataFrame, late: DataFrame) -> DataFrame:
    """Opt-in repair: bars touched by late trades, recomputed and merged in."""
    return upsert(bars, affected_bars(late, trades).select(*bars.columns), BAR_KEYS)


def repair_stored_bars(spark: SparkSession, path: str, trades: DataFrame, late: DataFrame,
                       staging: str) -> None:
    """The same repair of a stored table: only days with late trades are read and rewritten."""
    merge_slices(spark, path, affected_bars(late, trades), ["bar_date"],
                 lambda old, new: upsert(old, new, BAR_KEYS), staging)


def trade_pipeline(spark: SparkSession, landing: str, root: str, checkpoint: str,
                   files_per_batch: int | None = None, loaded_at=None,
                   trigger: dict | None = None) -> StreamingQuery:
    """Landed files to silver trades and bars, one merge per micro-batch.

    The default trigger drains and stops; ``{"processingTime": "30 seconds"}`` keeps running.
    """
    def step(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        merge_trades(batch, f"{root}/silver/stg_trades", f"{checkpoint}/merge/{batch_id}")
        rebuild_bars(session, session.read.parquet(f"{root}/silver/stg_trades"),
                     f"{root}/gold/mart_intraday_bars", f"{checkpoint}/bars/{batch_id}")

    source = stream_trade_files(spark, landing, files_per_batch, loaded_at)
    return (
        source.writeStream.foreachBatch(step)
        .option("checkpointLocation", f"{checkpoint}/offsets")
        .trigger(**(trigger or {"availableNow": True})).start()
    )
