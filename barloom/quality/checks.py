"""Rule-based checks.

A check is a frame of one row per result: check_name, table_name, severity, status, message,
observed (JSON). Counting happens in aggregates; the result row carries totals, and where a
check has per-key findings they come as a frame of their own, so no result row grows with the
number of keys. ``today``/``now`` are arguments.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom import constants as C

RESULT_COLUMNS = ["check_name", "table_name", "severity", "status", "message", "observed"]


def _day(value) -> Column:
    return F.lit(value).cast("date")


def _instant(value) -> Column:
    return F.lit(value).cast("timestamp")


def result(measured: DataFrame, check: str | Column, table: str | Column, severity: str,
           ok: Column, message: Column, observed: Sequence[Column]) -> DataFrame:
    """Measured rows as result rows. An unknown outcome counts as a failure."""
    text = lambda v: F.lit(v) if isinstance(v, str) else v
    return measured.select(
        text(check).alias("check_name"), text(table).alias("table_name"),
        F.lit(severity).alias("severity"),
        F.when(ok, "pass").otherwise("fail").alias("status"),
        message.alias("message"),
        F.to_json(F.struct(*observed), {"ignoreNullFields": "false"}).alias("observed"),
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys stored more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).filter(F.col("n_rows") > 1)


# --- freshness per key -------------------------------------------------------------------

def limits_frame(df: DataFrame, limits: Mapping[str, int], key: str) -> DataFrame:
    """Expected keys with their lag limits; configuration, not data."""
    return df.sparkSession.createDataFrame(
        list(limits.items()), f"{key} string, max_lag_days int")


def freshness_detail(df: DataFrame, key: str, date: str, expected: DataFrame, today,
                     other_limit: int | None = None) -> DataFrame:
    """(key, lag_days, max_lag_days, state) for every stored or expected key.

    A stored key without any date is stale: how old it is cannot be known. ``other_limit`` applies to stored keys that are not expected; None leaves them unlimited.
    """
    lags = df.groupBy(key).agg(F.datediff(_day(today), F.max(date)).alias("lag_days"))
    limit = F.coalesce("max_lag_days", F.lit(other_limit).cast("int"))
    return (
        lags.withColumn("_stored", F.lit(True)).join(expected, key, "full_outer")
        .select(
            key, "lag_days", limit.alias("max_lag_days"),
            F.when(F.col("_stored").isNull(), "missing")
            .when(F.col("lag_days").isNull() | (F.col("lag_days") > limit), "stale")
            .otherwise("current").alias("state"))
    )


def check_freshness_by_key(df: DataFrame, check: str, table: str, key: str, date: str,
                           expected: DataFrame, today, other_limit: int | None = None) -> DataFrame:
    detail = freshness_detail(df, key, date, expected, today, other_limit)
    totals = detail.agg(
        F.count_if(F.col("state") != "missing").alias("keys"), F.max("lag_days").alias("max_lag_days"),
        F.count_if(F.col("state") == "missing").alias("missing"),
        F.count_if(F.col("state") == "stale").alias("stale"))
    return result(
        totals, check, table, "error", (F.col("missing") == 0) & (F.col("stale") == 0),
        F.format_string("%d keys missing, %d keys behind their limit.", "missing", "stale"),
        [F.col(c) for c in totals.columns])


# --- keys, nulls, value sanity -----------------------------------------------------------

def check_duplicate_keys(df: DataFrame, check: str, table: str, keys: Sequence[str]) -> DataFrame:
    totals = duplicate_keys(df, keys).agg(F.count("*").alias("duplicate_keys"))
    return result(
        totals, check, table, "error", F.col("duplicate_keys") == 0,
        F.format_string(f"%d keys ({', '.join(keys)}) stored more than once.", "duplicate_keys"),
        [F.col("duplicate_keys")])


def check_key_and_null(df: DataFrame, check: str, table: str, keys: Sequence[str],
                       value: str) -> DataFrame:
    """Repeated keys and null values; one pass groups by key and counts both."""
    totals = (
        df.groupBy(*keys).agg(F.count("*").alias("_n"),
                              F.count_if(F.col(value).isNull()).alias("_nulls"))
        .agg(F.count_if(F.col("_n") > 1).alias("duplicate_keys"),
             F.coalesce(F.sum("_nulls"), F.lit(0)).alias("null_values"))
    )
    return result(
        totals, check, table, "error",
        (F.col("duplicate_keys") == 0) & (F.col("null_values") == 0),
        F.format_string("%d repeated keys, %d null values.", "duplicate_keys", "null_values"),
        [F.col("duplicate_keys"), F.col("null_values")])


def impossible_bar() -> Column:
    """Null close fails; other null prices do not. Only a non-positive low counts as such."""
    outside = lambda c: (F.col(c) > F.col("high")) | (F.col(c) < F.col("low"))
    return (
        F.col("close").isNull() | (F.col("low") <= 0) | (F.col("high") < F.col("low"))
        | outside("close") | outside("open") | (F.col("volume") < 0)
    )


def check_ohlc_sanity(bars: DataFrame, check: str, table: str, today,
                      days: int = C.BAR_SANITY_DAYS) -> DataFrame:
    recent = bars.filter(F.col("obs_date") >= F.date_sub(_day(today), days))
    totals = recent.filter(impossible_bar()).agg(F.count("*").alias("bad_rows"))
    return result(
        totals, check, table, "error", F.col("bad_rows") == 0,
        F.format_string(f"%d impossible bars in the last {days} days.", "bad_rows"),
        [F.col("bad_rows")])


def price_jumps(bars: DataFrame, today, days: int = C.BAR_SANITY_DAYS,
                lead_in: int = C.BAR_LEAD_IN_DAYS, limit: float = C.BAR_MAX_MOVE) -> DataFrame:
    """Day-over-day moves beyond ``limit`` without a split.

    Two date filters: the wider one feeds the lag, the narrower one picks the answers. Identical
    copies of a bar cannot jump against each other, so they are folded first; what is left of a
    symbol is bounded by the days in the window.
    """
    copies = bars.filter(F.col("obs_date") >= F.date_sub(_day(today), days + lead_in)).select(
        "symbol", "obs_date", "adj_close", "split_factor").distinct()
    order = Window.partitionBy("symbol").orderBy("obs_date", "adj_close", "split_factor")
    move = F.abs(F.try_divide("adj_close", "prev_adj_close") - 1)
    return (
        copies.withColumn("prev_adj_close", F.lag("adj_close").over(order))
        .filter((F.col("obs_date") >= F.date_sub(_day(today), days))
                & (F.col("prev_adj_close") > 0) & (move > limit) & (F.col("split_factor") == 1))
        .select("symbol", "obs_date", "prev_adj_close", "adj_close")
    )


def check_price_jump(bars: DataFrame, check: str, table: str, today,
                     limit: float = C.BAR_MAX_MOVE, listed: int = C.JUMPS_LISTED) -> DataFrame:
    """Jump count with the first few listed; ``price_jumps`` has them all."""
    jumps = price_jumps(bars, today, limit=limit)
    first = jumps.orderBy("symbol", "obs_date", "prev_adj_close").limit(listed).agg(
        F.sort_array(F.collect_list(F.struct(
            "symbol", "obs_date", "prev_adj_close", "adj_close"))).alias("jumps"))
    totals = jumps.agg(F.count("*").alias("n_jumps")).select(
        "n_jumps", F.lit(first.scalar()).alias("jumps"))
    return result(
        totals, check, table, "warn", F.col("n_jumps") == 0,
        F.format_string(f"%d adjusted closes moved over {limit:.0%}% in a day, no split.",
                        "n_jumps"),
        [F.col("n_jumps"), F.col("jumps")])


# --- recency and volume ------------------------------------------------------------------

def check_recency_hours(df: DataFrame, check: str, table: str, ts: str, now,
                        limit_hours: int = C.NEWS_MAX_LAG_HOURS,
                        recent_hours: int = C.NEWS_RECENT_HOURS,
                        enabled: bool = True) -> DataFrame:
    """Hours since the newest row; an empty table fails. Disabled gives no rows."""
    cut = _instant(now) - F.expr(f"INTERVAL {recent_hours} HOURS")
    totals = df.agg(
        ((F.unix_seconds(_instant(now)) - F.unix_seconds(F.max(ts))) / 3600).alias("lag_hours"),
        F.count_if(F.col(ts) >= cut).alias("recent_rows"))
    out = result(
        totals, check, table, "error", F.col("lag_hours") <= limit_hours,
        F.format_string(
            f"Newest row is %s old (limit {limit_hours}h); %d rows in {recent_hours}h.",
            F.coalesce(F.concat(F.round("lag_hours").cast("long").cast("string"), F.lit("h")),
                       F.lit("unknown")),
            F.col("recent_rows")),
        [F.round("lag_hours", 3).alias("lag_hours"), F.col("recent_rows")])
    return out if enabled else out.limit(0)


def check_last_session(trades: DataFrame, bars: DataFrame, check: str, table: str,
                       symbols: Sequence[str], min_rows: int = C.QUOTES_MIN_ROWS,
                       zone: str = "UTC", enabled: bool = True) -> DataFrame:
    """Trades on the newest bar date: enough rows and no expected symbol missing.

    The day's bounds are scalar subqueries on ``trade_ts`` itself, so they reach the scan. Only
    expected symbols are gathered, so the list is bounded by the configuration.
    """
    newest = bars.agg(F.max("obs_date").alias("d"))
    midnight = lambda day: F.to_utc_timestamp(day.cast("timestamp"), zone)
    session = newest.scalar()
    starts = newest.select(midnight(F.col("d")).alias("t")).scalar()
    ends = newest.select(midnight(F.date_add("d", 1)).alias("t")).scalar()
    wanted = F.array(*[F.lit(s) for s in sorted(symbols)])
    on_day = trades.filter((F.col("trade_ts") >= starts) & (F.col("trade_ts") < ends))
    totals = on_day.agg(
        F.count("*").alias("rows"),
        F.collect_set(F.when(F.col("symbol").isin(*symbols), F.col("symbol"))).alias("_seen"),
    ).select(F.lit(session).alias("session"), "rows",
             F.array_except(wanted, "_seen").alias("missing"))
    out = result(
        totals, check, table, "warn",
        (F.col("rows") >= min_rows) & (F.size("missing") == 0),
        F.format_string(f"%d trades on %s (at least {min_rows}); missing: %s.", F.col("rows"),
                        F.coalesce(F.col("session").cast("string"), F.lit("no date")),
                        F.array_join("missing", ", ")),
        [F.col("session"), F.col("rows"), F.col("missing")])
    return out if enabled else out.limit(0)


def check_row_count_age(df: DataFrame, check: str, table: str, today, max_age_days: int,
                        exact: int | None = None, minimum: int | None = None,
                        loaded: str = "_ingested_at") -> DataFrame:
    totals = df.agg(
        F.count("*").alias("rows"),
        F.datediff(_day(today), F.max(F.to_date(loaded))).alias("age_days"))
    enough = F.col("rows") == exact if exact is not None else F.col("rows") >= minimum
    want = f"exactly {exact}" if exact is not None else f"at least {minimum}"
    return result(
        totals, check, table, "error", enough & (F.col("age_days") <= max_age_days),
        F.format_string(f"%d rows (want {want}), loaded %s days ago.", F.col("rows"),
                        F.coalesce(F.col("age_days").cast("string"), F.lit("?"))),
        [F.col("rows"), F.col("age_days")])


def check_latest_run(expected: DataFrame, jobs: DataFrame, runs: DataFrame, now) -> DataFrame:
    """Latest completed run of each expected job succeeded and is recent enough.

    expected: (job_name, max_age_hours); jobs: (job_name, created_ts); runs: (job_name, run_id,
    start_ts, end_ts, result_state). A deployed job that never ran passes while it is younger
    than its limit; a job that is not deployed fails.
    """
    hours = lambda ts: (F.unix_seconds(_instant(now)) - F.unix_seconds(ts)) / 3600
    last = runs.filter(F.col("end_ts").isNotNull()).groupBy("job_name").agg(
        F.max(F.struct("start_ts", "run_id", "result_state")).alias("last"))
    joined = (
        expected.join(jobs, "job_name", "left").join(last, "job_name", "left")
        .withColumns({
            "age_hours": F.round(hours(F.col("last.start_ts")), 1),
            "exists_hours": F.round(hours(F.col("created_ts")), 1),
            "state": F.coalesce("last.result_state", F.lit("UNKNOWN")),
        })
    )
    ran, deployed = F.col("last").isNotNull(), F.col("created_ts").isNotNull()
    limit = F.col("max_age_hours")
    ok = (
        F.when(~deployed, False)
        .when(ran, (F.col("state") == "SUCCESS") & (hours(F.col("last.start_ts")) <= limit))
        .otherwise(hours(F.col("created_ts")) <= limit)
    )
    message = (
        F.when(~deployed, F.lit("Job is not deployed."))
        .when(ran, F.format_string("Latest run %d: %s.", "last.run_id", "state"))
        .otherwise(F.lit("Job has not completed a run yet."))
    )
    return result(
        joined, F.concat(F.lit("job_runs:"), F.col("job_name")), F.col("job_name"), "error",
        ok, message,
        [F.col("last.run_id").alias("run_id"), F.col("last.result_state").alias("result_state"),
         F.col("age_hours"), F.col("exists_hours")])
