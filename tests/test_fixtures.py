"""The bronze frames: each table is read once, and the benchmark's bars hold all lines."""

import datetime as dt

import pytest

from barloom import fixtures as X

DAY = dt.datetime(2000, 1, 2)
LINES = [(7, 1, 1, 5.0), (7, 1, 1, 3.0), (3, 2, 2, 9.0), (3, 1, 3, 4.0), (9, 1, 1, 8.0), (9, 1, 2, 6.0),
         (None, 1, 3, 2.0), (9, 1, 3, 7.0)]


@pytest.fixture
def tables(spark, root):
    def put(name, rows, schema):
        spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{root}/{name}.parquet")

    put("part", [(1, "PROMO", "Brand#1"), (2, "LARGE", "Brand#2"), (3, None, "Brand#1")],
        "p_partkey bigint, p_type string, p_brand string")
    put("lineitem", [(o, n, p, x, 2.0, DAY + dt.timedelta(days=d)) for d in (0, 5) for o, n, p, x in LINES],
        "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_extendedprice double, l_quantity double, "
        "l_shipdate timestamp")
    put("orders", [(1, "F", 10.0, DAY, "1-URGENT"), (2, "O", 20.0, DAY, "5-LOW")],
        "o_orderkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string")
    put("events", [(1, DAY, "view", 1.5, '{"k": 95}'), (2, DAY, "click", 2.5, '{"k": 5}'), (3, None, "view", None, None)],
        "event_id bigint, ts timestamp, event_type string, value double, props string")
    return root


@pytest.mark.parametrize("make, scans", [
    (X.markets_raw, 2), (X.company_prices_raw, 2), (X.macro_raw, 1), (X.quotes_raw, 1)])
def test_each_table_is_read_once(spark, tables, make, scans):
    plan = make(spark, tables)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan") == scans


def test_bars_by_type_and_of_all(spark, tables):
    rows = X.markets_raw(spark, tables).collect()
    got = {(r.symbol, r.obs_date.day, r._ingested_at.day):
           (r.open, r.high, r.low, r.close, r.volume, r.adj_close) for r in rows}
    want = {"ALL": (2.0, 9.0, 2.0, 8.0, 16), "PROMO": (3.0, 8.0, 3.0, 8.0, 6), "LARGE": (9.0, 9.0, 6.0, 6.0, 4),
            None: (2.0, 7.0, 2.0, 7.0, 6)}
    assert len(rows) == len(got) == 12
    for symbol, bar in want.items():
        assert got[symbol, 2, 3] == (*bar, bar[3])
        assert got[symbol, 2, 2] == (*bar, bar[3] + 1.0)  # an earlier load of the month's first days
        assert got[symbol, 7, 8] == (*bar, bar[3])


def test_large_trades_come_twice(spark, tables):
    rows = X.quotes_raw(spark, tables).collect()
    assert sorted((r.symbol, r.volume or 0, r._ingested_at and r._ingested_at.day) for r in rows
                  if r.price is not None) == [("click", 5.0, 3), ("view", 95.0, 3), ("view", 95.0, 4)]
    assert [r._ingested_at for r in rows if r.price is None] == [None]
