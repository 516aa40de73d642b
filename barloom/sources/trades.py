"""Trades: landed JSON-lines files and vendor message envelopes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom import schemas as S
from barloom.sources.payloads import _stamp, parsed


def with_trade_times(landed: DataFrame, loaded_at=None) -> DataFrame:
    """Landed trades with ``trade_ts`` and the load stamp."""
    return landed.select(
        "symbol", "price", "volume", "trade_time", "conditions",
        F.timestamp_millis("trade_time").alias("trade_ts"), _stamp(loaded_at))


def stream_trade_files(spark: SparkSession, path: str, files_per_batch: int | None = None,
                       loaded_at=None) -> DataFrame:
    """Streaming JSON-lines source with a declared schema."""
    reader = spark.readStream.schema(S.LANDED_TRADE)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return with_trade_times(reader.json(path), loaded_at)


def read_trade_files(spark: SparkSession, path: str, loaded_at=None) -> DataFrame:
    return with_trade_times(spark.read.schema(S.LANDED_TRADE).json(path), loaded_at)


def flatten_envelopes(messages: DataFrame, column: str = "message") -> DataFrame:
    """One row per trade in each ``trade`` message; batch or streaming input. Numbers are read
    however they are spelled; ``payload_rejects`` lists what cannot be read."""
    rows = parsed(messages, "trades", column=column).where("row is not null").select("row.*")
    return rows.select(
        F.col("s").alias("symbol"), F.col("p").alias("price"), F.col("v").alias("volume"),
        F.col("t").alias("trade_time"), F.coalesce("c", F.array().cast("array<string>")).alias("conditions"))
