import random

import pytest
from pyspark.sql import functions as F

from barloom import fixtures as X
from barloom.operators.ranking import rank_across_tasks, rank_in_window
from barloom.operators.totals import running_before
from barloom.plans import marts as G
from barloom.plans import queries as Q

SF_DIR = "/root/testdata/sf0.001"


def data(spark, n=600):
    rng = random.Random(5)
    rows = []
    for i in range(n):
        group = "hot" if i % 3 else f"g{i % 7}"
        # A third of the values are one and the same, some are missing.
        value = None if i % 11 == 0 else (0.5 if i % 3 == 1 else round(rng.uniform(-1, 1), 2))
        rows.append((group, i, value, -value if value is not None and i % 2 else None))
    return spark.createDataFrame(rows, "g string, id int, a double, b double")


def rows(df):
    return sorted((tuple(r) for r in df.select("g", "id", "a", "b", "ra", "rb").collect()), key=repr)


def test_both_ways_agree_and_match_brute_force(spark):
    df, ranks = data(spark), {"ra": "a", "rb": "b"}
    got = rows(rank_across_tasks(df, ["g"], ranks))
    assert got == rows(rank_in_window(df, ["g"], ranks))
    values = {}
    for g, _, a, _, _, _ in got:
        if a is not None:
            values.setdefault(g, []).append(a)
    for g, _, a, _, ra, _ in got:
        assert ra == (None if a is None else 1 + sum(v > a for v in values[g]))


def test_null_groups_and_spread(spark):
    """Rows without a value or a group are ranked like others, and no range holds all."""
    df = data(spark, 900).withColumn("g", F.when(F.col("g") != "g3", F.col("g")))
    ranks = {"ra": "a", "rb": "b"}
    assert rows(rank_across_tasks(df, ["g"], ranks)) == rows(rank_in_window(df, ["g"], ranks))
    placed = running_before(spark.range(1000).selectExpr("id", "id % 3 AS n"), [], [F.desc("id")], "n", "before")
    want, total = {}, 0
    for i in range(999, -1, -1):
        want[i] = total
        total += i % 3
    assert {r.id: r.before for r in placed.collect()} == want


@pytest.fixture(scope="module")
def models(spark):
    return Q.stored_models(spark, SF_DIR)


def test_drilldown_is_the_same_across_tasks(spark, models):
    args = [models[m] for m in ("dim_symbol_hierarchy", "int_symbol_returns", "mart_market_daily",
                                "mart_company_daily")]
    want = G.mart_drilldown_relative_strength(*args)
    got = G.mart_drilldown_relative_strength(*args, rank=rank_across_tasks)
    assert got.columns == want.columns
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_sector_strength_is_the_same_across_tasks(spark, models):
    args = [models["stg_markets"], models["dim_symbol"], X.BENCHMARK]
    want = G.mart_sector_relative_strength(*args)
    got = G.mart_sector_relative_strength(*args, rank=rank_across_tasks)
    assert got.exceptAll(want).isEmpty() and got.count() == want.count()


def test_children_priced_counts_only_children_that_meet_their_parent(spark):
    edges = spark.createDataFrame(
        [("P", "A"), ("P", "B")], "parent_symbol string, child_symbol string").withColumns({
            "level": F.lit(1), "weight": F.lit(None).cast("double"), "has_children": F.lit(False)})
    returns = spark.createDataFrame(
        [("P", 1), ("P", 2), ("A", 2), ("B", 3)], "symbol string, n int").selectExpr(
        "symbol", "date_add(date'2020-01-01', n) AS obs_date", "0D AS return_1m", "0D AS return_3m",
        "CAST(NULL AS DOUBLE) AS return_6m")
    health = returns.selectExpr("symbol", "obs_date", "true AS above_sma_200", "0D AS drawdown")
    out = G.mart_drilldown_relative_strength(edges, returns, health, health.limit(0)).collect()
    assert [(r.child_symbol, r.children_reporting, r.children_priced, r.rank_1m, r.rank_6m) for r in out] == [
        ("A", 1, 1, 1, None)]
