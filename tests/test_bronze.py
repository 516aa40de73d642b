from barloom.plans import bronze as B
from barloom.sinks.tables import read_version
from tests.test_sources import SHEETS, sheet
from tests.test_trades import state


def test_landed_pages_reach_their_tables(spark, root):
    def run(n):
        return B.BronzeRun(spark, root, f"run-{n}", f"2024-02-0{n}")

    def pages(*rows, key="symbol"):
        return spark.createDataFrame(list(rows), f"{key} string, payload string")

    bar = '{"date":"%s","close":%s,"adjClose":%s}'
    first = pages(("A", f"[{bar % ('2024-01-02', 1, 1)},{bar % ('2024-01-03', 2, 2)},{bar % ('2024-13-03', 2, 2)}]"), ("B", "{"))
    later = pages(("A", f"[{bar % ('2024-01-03', 9, 2)},{bar % ('2024-01-02', 1, 5)},{bar % ('2024-02-01', 3, 3)}]"))
    assert B.load_bars(run(1), "markets_raw", first) == {"inserted": 2, "updated": 0, "kept": 0}
    assert B.load_bars(run(2), "markets_raw", later) == {"inserted": 1, "updated": 1, "kept": 1}
    path = run(1).path("markets_raw")
    assert [r[1:] for r in state(spark, path, "obs_date", "close", "adj_close")] == [(1.0, 5.0), (2.0, 2.0), (3.0, 3.0)]
    assert state(spark, f"{path}_rejects", "run_id", "reason") == [("run-1", "bad date"), ("run-1", "unreadable")]

    obs = '{"observations":[{"date":"2024-01-01","value":"%s"},{"date":"x","value":"1"}]}'
    for n, value in ((1, "1"), (2, "1"), (3, "2")):
        got = B.load_macro(run(n), pages(("GDP", obs % value), key="series_id"))
        assert got == {"inserted": n == 1, "updated": n == 3, "kept": n == 2}
    assert len(state(spark, run(1).path("macro_raw") + "_rejects", "run_id", "raw")) == 3

    for n, title in ((1, "old"), (2, "new")):
        B.load_news(run(n), spark.createDataFrame(
            [(f'[{{"id":1,"title":"{title}","publishedDate":"2024-01-05T00:00:00Z"}},{{"id":{n + 5}}}]',)], "payload string"))
    assert state(spark, run(1).path("news_raw"), "article_id", "title")[0] == ("1", "old")
    assert spark.read.parquet(run(1).path("news_raw")).count() == 3

    types = spark.createDataFrame([("A", "ETF")], "symbol string, asset_type string")
    for n in (1, 2):
        B.load_tickers(run(n), pages(("A", f'{{"ticker":"A","name":"n{n}"}}')), types)
        B.load_universe(run(n), spark.createDataFrame(
            [("a", "", "Stock", "USD", "2024-01-01", "bad")],
            "ticker string, exchange string, assetType string, priceCurrency string, startDate string, endDate string"))
    assert [r.name for r in read_version(spark, run(1).path("tickers_raw")).collect()] == ["n2"]
    assert read_version(spark, run(1).path("tickers_universe")).first().end_date is None
    B.load_holdings(run(1), spark.createDataFrame(sheet("OK") + sheet("BAD", as_of="soon"), SHEETS))
    assert spark.read.parquet(run(1).path("etf_holdings_raw")).count() == 2
    assert state(spark, run(1).path("etf_holdings_raw_rejects"), "reason") == [("no as-of date",)]


def test_every_source_has_a_job():
    assert set(B.JOBS) == {"markets_raw", "company_prices_raw", "macro_raw", "news_raw", "tickers_raw",
                           "tickers_universe", "etf_holdings_raw"}
