import datetime as dt

import pytest
from pyspark.sql import functions as F

from barloom import constants as C
from barloom.operators import merge as M
from barloom.sinks import tables as K

T1, T2, T3 = (dt.datetime(2020, 1, d) for d in (1, 2, 3))
SCHEMA = "k string, a double, b string, _ingested_at timestamp"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def frame(spark, *data, schema=SCHEMA):
    return spark.createDataFrame(list(data), schema)


def test_upsert_compares_only_change_columns(spark):
    old = frame(spark, ("x", 1.0, "raw", T1), ("y", 1.0, "raw", T1), ("z", None, "raw", T1))
    new = frame(spark, ("x", 1.0, "other", T2), ("y", 2.0, "other", T2), ("z", None, "other", T2),
                ("w", 5.0, "new", T2))
    out = M.upsert_actions(old, new, ["k"], ["a"])
    assert {r.k: (r._action, r.b, r._ingested_at) for r in out.collect()} == {
        "x": ("kept", "raw", T1), "y": ("updated", "other", T2), "z": ("kept", "raw", T1),
        "w": ("inserted", "new", T2)}
    assert tuple(M.action_counts(out).first()) == (1, 1)
    # Null against a value is a change; running the load again changes nothing.
    again = M.upsert(out.drop("_action"), new, ["k"], ["a"])
    assert rows(again) == rows(out.drop("_action"))
    filled = M.upsert_actions(old, frame(spark, ("z", 1.0, "v", T2)), ["k"], ["a"])
    assert {r.k: r._action for r in filled.collect()}["z"] == "updated"


def test_upsert_always_replaces_without_change_columns(spark):
    old, new = frame(spark, ("x", 1.0, "s", T1)), frame(spark, ("x", 1.0, "s", T2))
    assert rows(M.upsert(old, new, ["k"])) == [("x", 1.0, "s", T2)]


def test_upsert_refuses_a_repeated_incoming_key(spark):
    new = frame(spark, ("x", 1.0, "s", T2), ("x", 2.0, "s", T2))
    with pytest.raises(Exception, match="repeated merge key"):
        M.upsert(frame(spark, ("y", 1.0, "s", T1)), new, ["k"]).collect()


def test_upsert_into_an_empty_table(spark):
    new = frame(spark, ("x", 1.0, "s", T2))
    assert rows(M.upsert(new.limit(0), new, ["k"])) == rows(new)


def test_insert_only_never_changes_stored_rows(spark):
    old = frame(spark, ("x", 1.0, "s", T1))
    new = frame(spark, ("x", 9.0, "t", T2), ("y", 2.0, "u", T2), ("y", 2.0, "u", T2))
    assert rows(M.insert_only(old, new, ["k"])) == [("x", 1.0, "s", T1), ("y", 2.0, "u", T2)]


def test_newer_than_lets_everything_into_an_empty_table(spark):
    src = frame(spark, ("x", 1.0, "s", T1), ("y", 1.0, "s", T2))
    assert M.newer_than(src, "_ingested_at", src.limit(0), "_ingested_at", "1900-01-01").count() == 2
    seen = src.filter(F.col("k") == "x")
    assert rows(M.newer_than(src, "_ingested_at", seen, "_ingested_at", "1900-01-01").select("k")) == [("y",)]
    assert M.newer_than(src, "_ingested_at", seen, "_ingested_at", "1900-01-01", True).count() == 2


TICKER = "symbol string, name string, exchange_code string, asset_type string, description string, start_date date, end_date date"


def ticker(symbol, description, end):
    return (symbol, symbol, "X", "ETF", description, dt.date(2000, 1, 1), end)


def test_scd2_versions(spark):
    d1, d2 = dt.date(2020, 1, 1), dt.date(2020, 1, 2)
    first = frame(spark, ticker("A", "a", d1), ticker("B", None, d1), ticker("C", "c", d1), schema=TICKER)
    second = frame(spark, ticker("A", "a2", d2), ticker("B", None, d2), ticker("D", "d", d2), schema=TICKER)
    history = M.first_snapshot(first, T1)
    history = M.scd2(history, second, "symbol", C.TICKER_CHECK_COLS, T2)
    seen = sorted((r.symbol, r.description or "", r.end_date, r.valid_from, r.valid_to or 0)
                  for r in history.collect())
    assert seen == [
        ("A", "a", d1, T1, T2), ("A", "a2", d2, T2, 0),
        ("B", "", d1, T1, 0),          # only the end date moved: no version
        ("C", "c", d1, T1, T2),        # vanished: closed, not deleted
        ("D", "d", d2, T2, 0)]
    assert rows(M.scd2(history, second, "symbol", C.TICKER_CHECK_COLS, T3).select("symbol", "valid_from")) == rows(
        history.select("symbol", "valid_from"))
    back = M.scd2(history, first, "symbol", C.TICKER_CHECK_COLS, T3)
    assert [(r.valid_from, r.valid_to) for r in back.filter("symbol = 'C'").orderBy("valid_from").collect()] == [
        (T1, T2), (T3, None)]


def test_replace_slices_is_repeatable_and_leaves_others(spark, root):
    df = spark.createDataFrame([("e", 1, 1.0), ("e", 2, 2.0), ("f", 1, 3.0)], "etf string, d int, w double")
    K.replace_slices(df, f"{root}/t", ["etf", "d"])
    for _ in range(2):
        K.replace_slices(spark.createDataFrame([("e", 2, 9.0)], df.schema), f"{root}/t", ["etf", "d"])
    assert rows(spark.read.parquet(f"{root}/t").select("etf", "d", "w")) == [
        ("e", 1, 1.0), ("e", 2, 9.0), ("f", 1, 3.0)]


def test_merge_slices_rewrites_only_touched_slices_and_survives_a_cut_swap(spark, root):
    schema = "k string, m string, v int"
    path = f"{root}/t"
    K.upsert_slices(spark, path, spark.createDataFrame([("a", "1", 1), ("b", "1", 1), ("c", "2", 1)], schema),
                    ["k"], ["m"], f"{root}/s1")
    untouched = [f for f in spark.read.parquet(path).inputFiles() if "m=2" in f]
    K.upsert_slices(spark, path, spark.createDataFrame([("a", "1", 5)], schema), ["k"], ["m"], f"{root}/s2")
    assert [f for f in spark.read.parquet(path).inputFiles() if "m=2" in f] == untouched
    want = [("a", "1", 5), ("b", "1", 1), ("c", "2", 1)]
    assert rows(spark.read.schema(schema).parquet(path).select("k", "m", "v")) == want
    # The slice is lost in the middle of a swap; the same call again restores it from staging.
    K.replace_slices(spark.createDataFrame([("broken", "1", 0)], schema), path, ["m"])
    K.upsert_slices(spark, path, spark.createDataFrame([("a", "1", 5)], schema), ["k"], ["m"], f"{root}/s2")
    assert rows(spark.read.schema(schema).parquet(path).select("k", "m", "v")) == want


def test_versions_replace_the_schema(spark, root):
    K.write_version(spark.range(3), root, "v1")
    K.write_version(spark.createDataFrame([("x", 1.0)], "name string, w double"), root, "v2")
    assert rows(K.read_version(spark, root)) == [("x", 1.0)]


def test_docs_survive_the_write(spark, root):
    K.with_docs(spark.range(1), {"id": "Row number"}).write.parquet(f"{root}/d")
    assert spark.read.parquet(f"{root}/d").schema["id"].metadata["comment"] == "Row number"


def test_publish_comments_table_and_columns(spark, root):
    K.publish(spark.range(2), "t_published", f"{root}/p", {"id": "Row number"}, "What it's for")
    said = {r.col_name: (r.data_type, r.comment) for r in spark.sql("DESCRIBE EXTENDED t_published").collect()}
    assert said["id"][1] == "Row number" and said["Comment"][0] == "What it's for"


def test_layer_path():
    assert K.layer_path("/lake/", "dim_date", {"dim_date": "gold"}) == "/lake/gold/dim_date"
    assert K.layer_path("/lake", "stg_x", {}) == "/lake/silver/stg_x"
    with pytest.raises(ValueError):
        K.layer_path("/lake", "x", {"x": "platinum"})


def test_merging_reads_only_the_slices_of_the_batch(spark, root):
    schema = "k string, m string, v int"
    path = f"{root}/t"
    K.replace_slices(spark.createDataFrame([(f"k{i}", str(i % 5), i) for i in range(20)], schema), path, ["m"])
    stored = spark.read.schema(schema).parquet(path)
    batch = spark.createDataFrame([("k1", "1", 0), ("n", None, 0)], schema)
    part = K.stored_slices(stored, batch, ["m"])
    assert {r.m for r in part.collect()} == {"1"}
    plan = part._jdf.queryExecution().executedPlan().toString()
    filters = next(line for line in plan.split("\n") if "PartitionFilters" in line)
    assert "m#" in filters.split("PartitionFilters")[1].split("PushedFilters")[0]
