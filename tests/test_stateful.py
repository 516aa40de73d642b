import datetime as dt

import pytest
from pyspark.sql import functions as F

from barloom.operators import merge as M
from barloom.operators.bars import intraday_bars
from barloom.plans.staging import stg_trades
from barloom.sinks import tables as K
from barloom.sources.trades import read_trade_files
from barloom.streaming import stateful as SF
from tests.test_trades import BAR_COLS, TRADE_COLS, land, minute, q, quotes, state


def drain(spark, landing, root, delay):
    SF.start_trades(spark, str(landing), f"{root}/trades", f"{root}/cp/t", delay, 1, "2024-02-01").awaitTermination()
    for width in (1, 5):
        SF.start_bars(spark, f"{root}/trades", f"{root}/bars_{width}", f"{root}/cp/{width}", width, delay).awaitTermination()


def test_state_outlives_restarts(spark, tmp_path):
    landing, root = tmp_path / "landing", str(tmp_path / "lake")
    landing.mkdir()
    batches = [[q(minute(i * 2 + b, i), 10.0 + i, 1.5 * i) for i in range(6)] for b in range(3)]
    batches[1].append(batches[0][2])                        # delivered again in a later batch
    batches[2] += [batches[0][2], batches[1][1], batches[2][0]]
    for n, batch in enumerate(batches):
        land(landing, n, *batch)
        drain(spark, landing, root, "1 hour")
    drain(spark, landing, root, "1 hour")                   # finds nothing new
    want = stg_trades(read_trade_files(spark, str(landing), "2024-02-01"))
    assert state(spark, f"{root}/trades", *TRADE_COLS) == sorted(tuple(r) for r in want.select(*TRADE_COLS).collect())
    bars = sorted(state(spark, f"{root}/bars_1", *BAR_COLS) + state(spark, f"{root}/bars_5", *BAR_COLS))
    assert bars == sorted(tuple(r) for r in intraday_bars(want).select(*BAR_COLS).collect())
    assert SF.missed(read_trade_files(spark, str(landing)), spark.read.parquet(f"{root}/trades")).count() == 0


def test_what_comes_behind_the_watermark_is_listed(spark, tmp_path):
    landing, root = tmp_path / "landing", str(tmp_path / "lake")
    landing.mkdir()
    late, in_time = q(minute(-120), 9.0), q(minute(-30), 8.0)
    for n, rows in enumerate(([q(minute(0))], [late, late, in_time, q(minute(0))])):
        land(landing, n, *rows)
        drain(spark, landing, root, "1 hour")
    assert state(spark, f"{root}/trades", "trade_ts") == [(minute(-30),), (minute(0),)]
    missed = SF.missed(read_trade_files(spark, str(landing)), spark.read.parquet(f"{root}/trades")).collect()
    assert [(r.trade_ts, r.price) for r in missed] == [(minute(-120), 9.0)]


def test_bars_are_hashed_and_exact(spark):
    rows = [q(minute(0, 1), 0.1 * i, 0.1 * (i % 7)) for i in range(200)] + [q(minute(0, 1), None, 1.0)]
    df = stg_trades(quotes(spark, *rows))
    plan = intraday_bars(df)._jdf.queryExecution().executedPlan().toString()
    below = intraday_bars(quotes(spark, *rows).selectExpr("*", "date'2024-01-10' as trade_date", "true as is_regular_session"))
    text = below._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "SortAggregate" not in text and "Sort " not in text
    got = {tuple(r) for r in intraday_bars(df).collect()}
    assert all({tuple(r) for r in intraday_bars(df.repartition(n)).collect()} == got for n in (1, 7))


COLS = "k int, a int, b string"


def test_upsert_counts_come_with_the_write(spark, root):
    old = spark.createDataFrame([(1, 1, "x"), (2, 2, None), (3, 3, "z"), (9, 9, "q")], COLS)
    new = spark.createDataFrame([(1, 1, "y"), (2, 5, None), (4, 4, "w"), (9, None, "q")], COLS)
    rows, counts = M.observed_upsert(old, new, ["k"], ["a"])
    assert "SortAggregate" not in rows._jdf.queryExecution().executedPlan().toString()
    rows.write.parquet(f"{root}/t")
    assert counts.get == {"inserted": 1, "updated": 2, "kept": 2}
    assert state(spark, f"{root}/t", "k", "b") == [(1, "x"), (2, None), (3, "z"), (4, "w"), (9, "q")]
    K.replace_slices(old, f"{root}/s", ["k"])
    got = K.upsert_slices(spark, f"{root}/s", new, ["k"], ["k"], f"{root}/staging", ["a"])
    assert got == {"inserted": 1, "updated": 2, "kept": 1}  # of the slices that were touched
    assert K.upsert_slices(spark, f"{root}/s", new, ["k"], ["k"], f"{root}/staging", ["a"]) == {}
    with pytest.raises(Exception, match="repeated merge key"):
        M.upsert(old, new.union(new), ["k"]).collect()


def test_span_comes_from_folders_and_footers(spark, root):
    path = f"{root}/t"
    assert K.stored_span(spark, path, "d") is None
    spark.range(100).selectExpr("id", "date_add(date'2020-01-01', cast(id % 50 AS int)) AS d",
                                "date_add(date'2020-01-01', cast(id % 5 AS int)) AS p").write.partitionBy("p").parquet(path)
    for column, folders, newest in (("p", True, dt.date(2020, 1, 5)), ("d", False, dt.date(2020, 2, 19)), ("id", False, 99)):
        assert K.stored_span(spark, path, column, folders)["newest"] == newest
    with K._settings(spark, K._FROM_FOOTERS):
        plan = spark.read.parquet(path).agg(F.max("d"))._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [MAX(d)]" in plan
    with K._settings(spark, K._FROM_FOLDERS):
        plan = spark.read.parquet(path).agg(F.max("p"))._jdf.queryExecution().executedPlan().toString()
    assert "LocalTableScan" in plan and "Scan parquet" not in plan


def test_times_are_utc(spark):
    assert minute(0) == dt.datetime(2024, 1, 10, 15, 0)
