"""Trades and bars with stream state: duplicates and open windows are kept until the watermark
passes them.

The merge forms in ``trades`` never drop a late event, at the price of reading the stored days a
batch touches. These forms read nothing that is stored: a duplicate is found in the state of
the last ``delay`` of event time, a bar is updated from its own state. What comes later than that
is not taken; ``missed`` lists it. State is by key and lies under the checkpoint, so a restart goes
on where the last batch ended. For large states use the RocksDB state store.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from barloom.operators.bars import BAR_KEYS, finished, tick_aggregates
from barloom.operators.dedupe import first_per_key
from barloom.operators.merge import upsert
from barloom.plans.staging import keyed_trades
from barloom.sinks.tables import merge_slices
from barloom.sources.trades import stream_trade_files

DELAY = "1 day"
DRAIN = {"availableNow": True}


def dedupe_trades(quotes: DataFrame, delay: str = DELAY) -> DataFrame:
    """Streamed trades, each key once among events at most ``delay`` apart. A key whose first
    event is older than the watermark is dropped."""
    return keyed_trades(quotes).withWatermark("trade_ts", delay).dropDuplicatesWithinWatermark(["trade_key"])


def start_trades(spark: SparkSession, landing: str, path: str, checkpoint: str, delay: str = DELAY,
                 files_per_batch: int | None = None, loaded_at=None, trigger: dict | None = None) -> StreamingQuery:
    """Landed files to the silver table at ``path``, by trade date; append only."""
    rows = dedupe_trades(stream_trade_files(spark, landing, files_per_batch, loaded_at), delay)
    return (
        rows.writeStream.format("parquet").outputMode("append").partitionBy("trade_date")
        .option("checkpointLocation", checkpoint).option("path", path).trigger(**(trigger or DRAIN)).start()
    )


def missed(landed: DataFrame, stored: DataFrame) -> DataFrame:
    """Trades that landed but came behind the watermark: one row per key that is not stored."""
    rest = keyed_trades(landed).join(stored.select("trade_key"), "trade_key", "left_anti")
    return first_per_key(rest, ["trade_key"], [F.asc("_ingested_at")])


def windowed_bars(trades: DataFrame, width: int, delay: str = DELAY) -> DataFrame:
    """Streamed trades to bars of ``width`` minutes; in update mode each batch gives the bars that
    it changed, whole."""
    window = F.window("trade_ts", f"{width} minutes")
    bars = trades.withWatermark("trade_ts", delay).groupBy("symbol", window.alias("window")).agg(
        *tick_aggregates(F.timestamp_seconds(
            F.unix_seconds("trade_ts") - F.pmod(F.unix_seconds("trade_ts"), F.lit(60 * width)))))
    return finished(bars.withColumns({"bar_start": F.col("window.start"), "bar_minutes": F.lit(width)}))


def start_bars(spark: SparkSession, trades_path: str, path: str, checkpoint: str, width: int,
               delay: str = DELAY, trigger: dict | None = None) -> StreamingQuery:
    """The silver table to bars of one width at ``path``, by date. A batch is merged by key through
    a staging folder of its number, so a repeated batch changes nothing."""
    def step(batch: DataFrame, batch_id: int) -> None:
        merge_slices(batch.sparkSession, path, batch, ["bar_date"],
                     lambda old, new: upsert(old, new, BAR_KEYS), f"{checkpoint}/merge/{batch_id}")

    schema = spark.read.parquet(trades_path).schema
    stream = spark.readStream.schema(schema).parquet(trades_path)
    return (
        windowed_bars(stream, width, delay).writeStream.outputMode("update").foreachBatch(step)
        .option("checkpointLocation", f"{checkpoint}/offsets").trigger(**(trigger or DRAIN)).start()
    )
