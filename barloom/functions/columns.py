"""Column expressions shared by the models. All are built-in functions, so they stay in codegen."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom import constants as C


def change(now: Column, base: Column) -> Column:
    """Relative change; null, not an error, on a zero base."""
    return F.try_divide(now, base) - F.lit(1.0)


def clean_text(value: Column) -> Column:
    """Trimmed text, blank becomes null."""
    return F.nullif(F.trim(value), F.lit(""))


def to_symbol(ticker: Column) -> Column:
    """Fund-file ticker to price symbol: share classes use '-', cash lines have none."""
    symbol = F.upper(F.trim(ticker))
    return F.when(~symbol.isin("", "-"), F.replace(symbol, F.lit("."), F.lit("-")))


def leading_date(value: Column) -> Column:
    """Date in the first ten characters; null when there is none."""
    return F.try_to_date(F.nullif(F.substring(value, 1, 10), F.lit("")))


def trade_key(symbol: Column, trade_time: Column, price: Column, volume: Column,
              conditions: Column) -> Column:
    """SHA-256 over the five trade fields; nulls are skipped, identical prints share a key."""
    return F.sha2(
        F.concat_ws(
            "|", symbol, trade_time.cast("string"), price.cast("string"),
            volume.cast("string"), F.array_join(conditions, ","),
        ),
        256,
    )


def market_time(ts: Column, zone: str = C.MARKET_ZONE) -> Column:
    return F.from_utc_timestamp(ts, zone)


def is_regular_session(ts: Column, zone: str = C.MARKET_ZONE) -> Column:
    minute = F.date_format(market_time(ts, zone), "HH:mm")
    return minute.between(C.SESSION_FIRST_MINUTE, C.SESSION_LAST_MINUTE)


def bar_start(ts: Column, minutes: Column) -> Column:
    """Start of the epoch-aligned bar holding the instant."""
    width = minutes.cast("long") * 60
    return F.timestamp_seconds(F.unix_seconds(ts) - F.pmod(F.unix_seconds(ts), width))


def differs(left: Column, right: Column, fields: Iterable[str]) -> Column:
    """True when any field differs, null-safe, between two structs."""
    out = F.lit(False)
    for name in fields:
        out = out | ~left[name].eqNullSafe(right[name])
    return out


def mask_secrets(df: DataFrame, column: str,
                 patterns: Iterable[tuple[str, str]] = C.SECRET_PATTERNS) -> DataFrame:
    """Replace key-shaped tokens in a text column with a fixed mask."""
    masked = F.col(column)
    for pattern, mask in patterns:
        masked = F.regexp_replace(masked, pattern, mask)
    return df.withColumn(column, masked)
