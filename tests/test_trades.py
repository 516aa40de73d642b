import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from barloom import schemas as S
from barloom.operators.bars import BAR_KEYS, intraday_bars
from barloom.plans.pipeline import refresh_trades
from barloom.plans.staging import stg_trades
from barloom.sinks import tables as K
from barloom.sinks.tables import read_or_none
from barloom.sources.trades import read_trade_files, stream_trade_files
from barloom.streaming import trades as ST

T0 = dt.datetime(2024, 1, 10, 15, 0)   # 10:00 Eastern


def quotes(spark, *rows):
    data = [(s, p, v, int((t - dt.datetime(1970, 1, 1)) / dt.timedelta(milliseconds=1)), c, t, load)
            for s, p, v, t, c, load in rows]
    return spark.createDataFrame(data, S.QUOTES)


def q(t, price=1.0, volume=1.0, symbol="A", conditions=("x",), load=dt.datetime(2024, 1, 11)):
    return (symbol, price, volume, t, None if conditions is None else list(conditions), load)


def test_identical_prints_collapse_to_the_first_ingest(spark):
    later = dt.datetime(2024, 1, 12)
    out = stg_trades(quotes(spark, q(T0, load=later), q(T0), q(T0, conditions=("y",)))).collect()
    assert len(out) == 2
    assert {r._ingested_at for r in out} == {dt.datetime(2024, 1, 11)}


def test_null_volume_is_skipped_in_the_key(spark):
    out = stg_trades(quotes(spark, q(T0, volume=None, conditions=("5.0",)), q(T0, volume=5.0, conditions=None)))
    assert out.count() == 1


@pytest.mark.parametrize("utc,regular,day", [
    (dt.datetime(2024, 1, 10, 14, 29, 59), False, 10), (dt.datetime(2024, 1, 10, 14, 30), True, 10),
    (dt.datetime(2024, 1, 10, 20, 59, 59), True, 10), (dt.datetime(2024, 1, 10, 21, 0), False, 10),
    (dt.datetime(2024, 7, 10, 13, 30), True, 10), (dt.datetime(2024, 7, 10, 13, 29), False, 10),
    (dt.datetime(2024, 1, 10, 4, 59), False, 9)])
def test_regular_session_and_market_date(spark, utc, regular, day):
    r = stg_trades(quotes(spark, q(utc))).first()
    assert (r.is_regular_session, r.trade_date.day) == (regular, day)


def minute(n, s=0):
    return T0 + dt.timedelta(minutes=n, seconds=s)


def test_bars(spark):
    df = stg_trades(quotes(
        spark, q(minute(0, 1), 10.0, 1.0), q(minute(0, 1), 9.0, 1.0), q(minute(0, 50), 12.0, 2.0),
        q(minute(3), 8.0, 0.0), q(minute(6), 7.0, 0.0), q(minute(-61), 5.0, 1.0, symbol="B")))
    bars = {(r.symbol, r.bar_minutes, r.bar_start): r for r in intraday_bars(df).collect()}
    one, five = bars["A", 1, T0], bars["A", 5, T0]
    assert (one.open, one.high, one.low, one.close, one.volume, one.trade_count) == (9.0, 12.0, 9.0, 12.0, 4.0, 3)
    assert one.vwap == pytest.approx((10 + 9 + 24) / 4)
    assert (five.open, five.low, five.close, five.trade_count) == (9.0, 8.0, 8.0, 4)
    assert bars["A", 5, minute(5)].vwap is None           # no volume
    assert bars["B", 5, minute(-65)].is_regular_session is False
    assert len(bars) == 3 + 2 + 2


def land(path, n, *rows):
    with open(f"{path}/part-{n}.json", "w") as f:
        for s, p, v, t, c, _ in rows:
            ms = int((t - dt.datetime(1970, 1, 1)) / dt.timedelta(milliseconds=1))
            f.write(json.dumps({"symbol": s, "price": p, "volume": v, "trade_time": ms, "conditions": c}) + "\n")


def state(spark, path, *cols):
    return sorted(tuple(r) for r in spark.read.parquet(path).select(*cols).collect())


TRADE_COLS = ("trade_key", "symbol", "price", "volume", "trade_ts", "trade_date", "is_regular_session")
BAR_COLS = (*BAR_KEYS, "bar_date", "open", "high", "low", "close", "volume", "trade_count")


def test_stream_equals_batch(spark, tmp_path):
    landing, root = tmp_path / "landing", str(tmp_path / "lake")
    landing.mkdir()
    batches = [[q(minute(i * 7 + b * 1440, i), 10.0 + i, float(i)) for i in range(5)] for b in range(3)]
    batches[1].append(batches[0][2])           # delivered again
    for n, batch in enumerate(batches):
        land(landing, n, *batch)
        ST.trade_pipeline(spark, str(landing), root, f"{root}/cp", loaded_at="2024-02-01").awaitTermination()
    # Draining again finds nothing new.
    ST.trade_pipeline(spark, str(landing), root, f"{root}/cp", loaded_at="2024-02-01").awaitTermination()
    want = stg_trades(read_trade_files(spark, str(landing), "2024-02-01"))
    assert state(spark, f"{root}/silver/stg_trades", *TRADE_COLS) == sorted(
        tuple(r) for r in want.select(*TRADE_COLS).collect())
    assert state(spark, f"{root}/gold/mart_intraday_bars", *BAR_COLS) == sorted(
        tuple(r) for r in intraday_bars(want).select(*BAR_COLS).collect())


def test_replayed_batch_changes_nothing(spark, root):
    batch = quotes(spark, q(minute(0)), q(minute(1)))
    for _ in range(2):
        ST.merge_trades(batch, f"{root}/t", f"{root}/staging/0")
    assert spark.read.parquet(f"{root}/t").count() == 2


def test_redelivery_in_a_later_run_moves_the_stamp(spark, root):
    later = dt.datetime(2024, 1, 15)
    ST.merge_trades(quotes(spark, q(minute(0)), q(minute(1))), f"{root}/t", f"{root}/staging/0")
    ST.merge_trades(quotes(spark, q(minute(0), load=later)), f"{root}/t", f"{root}/staging/1")
    assert state(spark, f"{root}/t", "trade_ts", "_ingested_at") == [
        (minute(0), later), (minute(1), dt.datetime(2024, 1, 11))]


def test_late_trades_miss_the_rebuild_until_repaired(spark, root):
    old, new = q(minute(0), 10.0), q(minute(1440), 20.0)
    ST.merge_trades(quotes(spark, old, new), f"{root}/t", f"{root}/staging/0")
    ST.rebuild_bars(spark, spark.read.parquet(f"{root}/t"), f"{root}/b", f"{root}/staging/b0")
    before = state(spark, f"{root}/b", *BAR_COLS)
    late = quotes(spark, q(minute(2), 99.0), q(minute(1441), 21.0))
    ST.merge_trades(late, f"{root}/t", f"{root}/staging/1")
    silver = spark.read.parquet(f"{root}/t")
    ST.rebuild_bars(spark, silver, f"{root}/b", f"{root}/staging/b1")
    after = state(spark, f"{root}/b", *BAR_COLS)
    assert [b for b in after if b[2].day == 10] == [b for b in before if b[2].day == 10]
    assert [b for b in after if b[2].day == 11] != [b for b in before if b[2].day == 11]

    bars = spark.read.parquet(f"{root}/b")
    missed = ST.late_trades(silver, bars, stg_trades(late))
    assert [r.price for r in missed.collect()] == [99.0]
    fixed = ST.repair_late_bars(bars, silver, missed)
    assert sorted(tuple(r) for r in fixed.select(*BAR_COLS).collect()) == sorted(
        tuple(r) for r in intraday_bars(silver).select(*BAR_COLS).collect())


def test_refreshes_add_up_to_a_full_build(spark, root):
    loads = [dt.datetime(2024, 1, 11 + n) for n in range(3)]
    day = [[q(minute(i * 3 + 1440 * n), 10.0 + i, float(i + 1), load=loads[n]) for i in range(4)] for n in range(3)]
    day[2].append((*day[1][0][:5], loads[2]))          # delivered again in a later load
    everything = quotes(spark, *day[0], *day[1], *day[2])
    for n, load in enumerate(loads):
        for _ in range(2):
            refresh_trades(spark, everything.filter(F.col("_ingested_at") <= load), root, f"run-{n}")
    assert state(spark, f"{root}/silver/stg_trades", *TRADE_COLS) == sorted(
        tuple(r) for r in stg_trades(everything).select(*TRADE_COLS).collect())
    assert state(spark, f"{root}/gold/mart_intraday_bars", *BAR_COLS) == sorted(
        tuple(r) for r in intraday_bars(stg_trades(everything)).select(*BAR_COLS).collect())


def test_append_reads_each_file_once(spark, tmp_path):
    landing, out = tmp_path / "landing", str(tmp_path / "quotes")
    landing.mkdir()
    for n in range(2):
        land(landing, n, q(minute(n)))
        for _ in range(2):
            ST.append_stream(stream_trade_files(spark, str(landing)), out, f"{out}-cp").awaitTermination()
    assert spark.read.parquet(out).count() == 2
    assert spark.read.parquet(out).schema["trade_ts"].dataType == S.QUOTES["trade_ts"].dataType


def test_read_or_none(spark, root):
    assert read_or_none(spark, f"{root}/nothing") is None
    spark.range(2).write.parquet(f"{root}/t")
    assert read_or_none(spark, f"{root}/t").count() == 2


def test_cut_swap_of_bars_is_completed_by_a_repeat(spark, root):
    days = quotes(spark, q(minute(0), 10.0), q(minute(1440), 20.0), q(minute(2880), 30.0))
    ST.merge_trades(days, f"{root}/t", f"{root}/staging/0")
    silver = spark.read.parquet(f"{root}/t")
    ST.rebuild_bars(spark, silver, f"{root}/b", f"{root}/staging/b0")
    want = state(spark, f"{root}/b", *BAR_COLS)
    # The swap died after some days: what is stored then must not decide where a repeat starts.
    broken = spark.read.parquet(f"{root}/b").limit(1).withColumn("open", F.lit(-1.0))
    broken.write.parquet(f"{root}/broken")
    K.replace_slices(spark.read.parquet(f"{root}/broken"), f"{root}/b", ["bar_date"])
    assert state(spark, f"{root}/b", *BAR_COLS) != want
    ST.rebuild_bars(spark, silver, f"{root}/b", f"{root}/staging/b0")
    assert state(spark, f"{root}/b", *BAR_COLS) == want


def test_stored_repair_equals_a_full_build(spark, root):
    old, new = q(minute(0), 10.0), q(minute(1440), 20.0)
    ST.merge_trades(quotes(spark, old, new), f"{root}/t", f"{root}/staging/0")
    ST.rebuild_bars(spark, spark.read.parquet(f"{root}/t"), f"{root}/b", f"{root}/staging/b0")
    late = quotes(spark, q(minute(2), 99.0))
    ST.merge_trades(late, f"{root}/t", f"{root}/staging/1")
    silver = spark.read.parquet(f"{root}/t")
    ST.repair_stored_bars(spark, f"{root}/b", silver, stg_trades(late), f"{root}/staging/r")
    assert state(spark, f"{root}/b", *BAR_COLS) == sorted(
        tuple(r) for r in intraday_bars(silver).select(*BAR_COLS).collect())
