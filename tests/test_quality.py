import datetime as dt
import json

import pytest

from barloom import schemas as S
from barloom.quality import checks as Q
from barloom.quality import run as R
from barloom.quality.suite import Limits, standard_checks
from barloom.quality import tests as V

DAY = dt.date(2024, 3, 10)


def back(n):
    return DAY - dt.timedelta(days=n)


def one(df):
    r = df.collect()
    assert len(r) == 1
    return r[0].status, json.loads(r[0].observed), r[0]


def bars(spark, *rows):
    return spark.createDataFrame(
        list(rows), "symbol string, obs_date date, open double, high double, low double, close double, "
                    "volume bigint, adj_close double, split_factor double")


def bar(day=1, symbol="A", o=2.0, h=3.0, low=1.0, c=2.0, v=1, adj=2.0, split=1.0):
    return (symbol, back(day), o, h, low, c, v, adj, split)


def test_freshness(spark):
    df = bars(spark, bar(3, "A"), bar(9, "A"), bar(5, "B"), bar(50, "X"))
    limits = Q.limits_frame(df, {"A": 4, "B": 4, "M": 4}, "symbol")
    check = lambda other: one(Q.check_freshness_by_key(df, "f", "t", "symbol", "obs_date", limits, DAY, other))
    assert check(None)[:2] == ("fail", {"keys": 3, "max_lag_days": 50, "missing": 1, "stale": 1})
    assert check(4)[1]["stale"] == 2
    detail = Q.freshness_detail(df, "symbol", "obs_date", limits, DAY)
    assert {r.symbol: r.state for r in detail.collect()} == {
        "A": "current", "B": "stale", "M": "missing", "X": "current"}


def test_duplicates_and_nulls(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", None), (None, 1.0), (None, 1.0)], "k string, v double")
    assert one(Q.check_duplicate_keys(df, "d", "t", ["k"]))[:2] == ("fail", {"duplicate_keys": 2})
    assert one(Q.check_key_and_null(df, "d", "t", ["k"], "v"))[1] == {"duplicate_keys": 2, "null_values": 1}
    assert one(Q.check_key_and_null(df.limit(0), "d", "t", ["k"], "v"))[:2] == (
        "pass", {"duplicate_keys": 0, "null_values": 0})


@pytest.mark.parametrize("row,bad", [
    (bar(), 0), (bar(c=None), 1), (bar(o=None, h=None, low=None), 0), (bar(low=0.0), 1), (bar(o=-1.0), 1),
    (bar(h=0.5), 1), (bar(v=-1), 1), (bar(c=3.5), 1), (bar(day=31, c=None), 0)])
def test_ohlc_sanity(spark, row, bad):
    assert one(Q.check_ohlc_sanity(bars(spark, row), "o", "t", DAY))[1] == {"bad_rows": bad}


def test_jump_uses_lead_in_and_skips_splits(spark):
    df = bars(spark, bar(35, adj=1.0), bar(29, adj=2.0), bar(20, adj=1.0, split=0.5), bar(10, adj=2.0, split=None),
              bar(5, adj=2.1), bar(5, adj=2.1))
    jumps = Q.price_jumps(df, DAY).collect()
    assert [(r.obs_date, r.prev_adj_close, r.adj_close) for r in jumps] == [(back(29), 1.0, 2.0)]
    status, observed, row = one(Q.check_price_jump(df, "j", "t", DAY))
    assert status == "fail" and row.severity == "warn" and len(observed["jumps"]) == 1


def test_jump_lists_only_the_first_few(spark):
    df = bars(spark, *[bar(i, adj=1.0 if i % 2 else 2.0) for i in range(30)])
    _, observed, row = one(Q.check_price_jump(df, "j", "t", DAY))
    assert len(observed["jumps"]) == 20 and row.message.startswith("29 ")


def stamps(spark, *hours):
    now = dt.datetime(2024, 3, 10)
    return spark.createDataFrame([(now - dt.timedelta(hours=h),) for h in hours], "ts timestamp")


def test_recency(spark):
    check = lambda *h, **k: Q.check_recency_hours(stamps(spark, *h), "r", "t", "ts", "2024-03-10", **k)
    assert one(check(1, 73))[:2] == ("pass", {"lag_hours": 1.0, "recent_rows": 1})
    assert one(check(73))[0] == "fail"
    assert one(check())[:2] == ("fail", {"lag_hours": None, "recent_rows": 0})
    assert check(1, enabled=False).count() == 0


def test_last_session(spark):
    trades = spark.createDataFrame([("A", dt.datetime(2024, 3, 9, 12)), ("Z", dt.datetime(2024, 3, 9, 12)),
                                    ("B", dt.datetime(2024, 3, 8, 12))], "symbol string, trade_ts timestamp")
    check = lambda syms, n: one(Q.check_last_session(trades, bars(spark, bar(1)), "q", "t", syms, n))
    assert check(["A"], 2)[0] == "pass"
    assert check(["A", "B"], 2)[1] == {"session": "2024-03-09", "rows": 2, "missing": ["B"]}
    assert check(["A"], 3)[0] == "fail"


def test_row_count_and_age(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 3, 8, 6),)] * 3, "_ingested_at timestamp")
    status = lambda frame=df, age=2, **k: one(Q.check_row_count_age(frame, "r", "t", DAY, age, **k))[0]
    assert status(exact=3) == "pass" and status(exact=2) == "fail"
    assert status(minimum=2) == "pass" and status(minimum=4) == "fail"
    assert status(minimum=1, age=1) == "fail" and status(frame=df.limit(0), minimum=0) == "fail"


def test_latest_run(spark):
    now = dt.datetime(2024, 3, 10)
    h = lambda n: now - dt.timedelta(hours=n)
    expected = spark.createDataFrame([(j, 24) for j in ("good", "old", "bad", "new", "late", "gone", "busy")],
                                     "job_name string, max_age_hours int")
    jobs = spark.createDataFrame([(j, h(20 if j == "new" else 500)) for j in ("good", "old", "bad", "new", "late", "busy")],
                                 "job_name string, created_ts timestamp")
    runs = spark.createDataFrame(
        [("good", 1, h(30), h(30), "FAILED"), ("good", 2, h(2), h(1), "SUCCESS"), ("old", 3, h(25), h(24), "SUCCESS"),
         ("bad", 4, h(1), h(1), "FAILED"), ("busy", 5, h(5), h(4), "SUCCESS"), ("busy", 6, h(1), None, None)],
        "job_name string, run_id bigint, start_ts timestamp, end_ts timestamp, result_state string")
    out = {r.table_name: r.status for r in Q.check_latest_run(expected, jobs, runs, now).collect()}
    assert out == {"good": "pass", "old": "fail", "bad": "fail", "new": "pass", "late": "fail", "gone": "fail",
                   "busy": "pass"}


def test_run_all_keeps_going_and_can_be_repeated(spark, root):
    df = spark.createDataFrame([("a",)], "k string")

    def broken():
        raise KeyError("no such table")

    checks = {"fine": lambda: Q.check_duplicate_keys(df, "fine", "t", ["k"]), "broken": broken,
              "late": lambda: df.selectExpr("raise_error('boom') AS check_name", *[f"'' AS {c}" for c in Q.RESULT_COLUMNS[1:]])}
    for _ in range(2):
        out = R.run_all(spark, checks, "r1", "2024-03-10", f"{root}/dq")
    R.run_all(spark, {"fine": checks["fine"]}, "r2", "2024-03-11", f"{root}/dq")
    assert {r.check_name: r.status for r in out.collect()} == {"fine": "pass", "broken": "error", "late": "error"}
    stored = spark.read.schema(S.DQ_RESULTS).parquet(f"{root}/dq")
    assert stored.count() == 4
    assert {r.run_id: (r.n_errors, r.passed) for r in R.gate(stored).collect()} == {"r1": (2, False), "r2": (0, True)}
    assert R.latest_run_results(stored).first().run_id == "r2"
    with pytest.raises(RuntimeError, match="2 data quality errors"):
        R.require_passed(out)
    R.require_passed(stored.filter("run_id = 'r2'"))
    incidents = R.incident_rollup(stored, stored.limit(0), "2024-03-12")
    assert [(r.run_id, r.failed_checks) for r in incidents.collect()] == [("r1", ["broken", "late"])]
    assert R.incident_rollup(stored, incidents, "2024-03-12").count() == 0


def test_warnings_never_close_the_gate(spark):
    df = spark.createDataFrame([("r", None, "c", "t", "warn", "fail", "", "{}")], S.DQ_RESULTS)
    r = R.gate(df).first()
    assert r.passed and r.n_warnings == 1


def test_source_freshness(spark):
    df = spark.createDataFrame([(DAY,)], "obs_date date")
    at = lambda d, limits=("obs_date", 4, 7): R.source_freshness(
        {"s": df}, dt.datetime(2024, 3, 10) + dt.timedelta(days=d), {"s": limits}).first().status
    assert [at(4), at(5), at(8), at(8, ("obs_date", 4, None))] == ["pass", "warn", "error", "warn"]
    assert R.source_freshness({"s": df.limit(0)}, DAY, {"s": ("obs_date", 4, 7)}).first().status == "error"


def test_nulls_fail_only_not_null(spark):
    df = spark.createDataFrame([(None, 1), ("a", 2), ("a", None), ("c", 9)], "k string, v int")
    parent = spark.createDataFrame([("a",), (None,)], "id string")
    assert V.test_not_null(df, "k").count() == 1 and V.test_not_null(df, "k", "v > 5").count() == 0
    assert [r.k for r in V.test_unique(df, "k").collect()] == ["a"]
    assert V.test_unique_combination(df, ["k", "v"]).count() == 0
    assert [tuple(r) for r in V.test_accepted_values(df, "k", ["a"]).collect()] == [("c", 1)]
    assert [r.k for r in V.test_relationships(df, "k", parent, "id").collect()] == ["c"]
    assert V.test_accepted_range(df, "v", 1, 9).count() == 0
    assert V.test_accepted_range(df, "v", 1, 9, inclusive=False).count() == 2
    assert V.test_expression(df, "v < 9").count() == 1


def test_key_without_a_date_is_stale(spark):
    df = spark.createDataFrame([("A", None), ("B", DAY)], "symbol string, obs_date string").selectExpr(
        "symbol", "cast(obs_date as date) as obs_date")
    limits = Q.limits_frame(df, {"A": 5, "B": 5}, "symbol")
    assert {r.symbol: r.state for r in Q.freshness_detail(df, "symbol", "obs_date", limits, DAY).collect()} == {
        "A": "stale", "B": "current"}
    assert Q.check_freshness_by_key(df, "f", "t", "symbol", "obs_date", limits, DAY).first().status == "fail"


def test_run_that_ends_without_results_replaces_its_rows(spark, root):
    row = spark.createDataFrame([("c", "t", "warn", "pass", "m", "{}")], ", ".join(f"{c} string" for c in Q.RESULT_COLUMNS))
    for run in ("a", "b/1"):
        assert R.run_all(spark, {"c": lambda: row}, run, "2024-01-01", f"{root}/ops").count() == 1
    assert R.run_all(spark, {"c": lambda: row.limit(0)}, "a", "2024-01-01", f"{root}/ops").count() == 0
    assert R.run_all(spark, {"c": lambda: row}, "b/1", "2024-01-01", f"{root}/ops").count() == 1


def test_a_check_may_have_any_number_of_rows(spark, root):
    many = spark.range(25_000).selectExpr("concat('job:', id) AS check_name", *[f"'pass' AS {c}" for c in Q.RESULT_COLUMNS[1:]])
    half = spark.range(0, 1000, 1, 4).selectExpr(
        "if(id = 999, raise_error('late'), 'x') AS check_name", *[f"'pass' AS {c}" for c in Q.RESULT_COLUMNS[1:]])
    out = R.run_all(spark, {"many": lambda: many, "half": lambda: half}, "r", "2024-01-01", f"{root}/ops")
    assert out.count() == 25_001 and [r.check_name for r in out.where("status = 'error'").collect()] == ["half"]


def test_the_suite_loses_only_checks_of_a_missing_table(spark, root):
    from barloom import fixtures as X

    def table(name):
        if name == "news_raw":
            raise FileNotFoundError(name)
        return getattr(X, name)(spark, "/root/testdata/sf0.001")

    checks = standard_checks(table, X.AS_OF_DATE, X.TRADES_NOW)
    assert len(standard_checks(table, X.AS_OF_DATE, X.TRADES_NOW, jobs=lambda: None)) == 12
    out = R.run_all(spark, checks, "r", X.TRADES_NOW, f"{root}/ops")
    found = {r.check_name: r.status for r in out.collect()}
    assert set(found) == set(checks) and {k for k, v in found.items() if v == "error"} == {"news_freshness", "news_duplicates"}
    off = standard_checks(table, X.AS_OF_DATE, X.TRADES_NOW, Limits(quotes_enabled=False))
    assert off["quotes_last_session"]().count() == 0
