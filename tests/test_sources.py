import datetime as dt

import pytest
from pyspark.sql import functions as F

from barloom import constants as C
from barloom import schemas as S
from barloom.functions.columns import mask_secrets, to_symbol
from barloom.operators.dedupe import newest_listing
from barloom.plans.staging import stg_etf_holdings, stg_macro
from barloom.seeds import INDICATORS, indicator_seed
from barloom.sources import holdings as H
from barloom.sources import payloads as L
from barloom.sources import planning as W
from barloom.sources import trades as TR

D = dt.date(2020, 1, 1)


def days(n):
    return D + dt.timedelta(days=n)


def test_to_symbol(spark):
    raw = ["brk.b", " aapl ", "-", " - ", "", None, "A.B.C"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(raw)], "i int, t string")
    out = [r.s for r in df.select("i", to_symbol(F.col("t")).alias("s")).orderBy("i").collect()]
    assert out == ["BRK-B", "AAPL", None, None, None, None, "A-B-C"]


def test_macro_payload_drops_the_missing_marker(spark):
    landed = spark.createDataFrame([("GDP", '{"observations":[{"date":"2020-01-01","value":"1.5"},'
                                     '{"date":"2020-04-01","value":"."},{"date":"2020-07-01","value":"x"}]}')],
                                   "series_id string, payload string")
    out = L.parse_macro(landed, "2021-01-01").orderBy("obs_date").collect()
    assert [(r.obs_date, r.value) for r in out] == [(D, 1.5), (dt.date(2020, 7, 1), None)]


def test_ticker_payload_without_dates(spark):
    landed = spark.createDataFrame([("A", '{"ticker":"A","startDate":"2020-01-01T00:00:00Z","endDate":""}')],
                                   "symbol string, payload string")
    types = spark.createDataFrame([("A", "ETF")], "symbol string, asset_type string")
    r = L.parse_tickers(landed, types).first()
    assert (r.start_date, r.end_date, r.asset_type, r.name) == (D, None, "ETF", None)


def test_universe_csv_blank_is_null(spark, root):
    with open(f"{root}/u.csv", "w") as f:
        f.write("ticker,exchange,assetType,priceCurrency,startDate,endDate\nx,,Stock,USD,2020-01-01,\n")
    r = L.parse_universe(L.read_universe(spark, f"{root}/u.csv")).first()
    assert (r.exchange, r.start_date, r.end_date) == (None, D, None)


def test_news_defaults_and_dedupe(spark):
    page = '[{"id":7,"title":"t","publishedDate":"2020-01-01T10:00:00Z"},{"id":7,"title":"t","tags":["x"]}]'
    out = L.parse_news(spark.createDataFrame([(page,)], "payload string")).collect()
    assert len(out) == 1 and out[0].article_id == "7" and out[0].tickers == []


def test_seed_keeps_quotes(spark, root):
    with open(f"{root}/seed.csv", "w") as f:
        f.write('series_id,indicator_name,category,frequency,units,description,why_it_matters\n'
                'X,Name,rates,daily,percent,plain,"a ""quoted"", text"\n')
    assert L.read_seed(spark, f"{root}/seed.csv").first().why_it_matters == 'a "quoted", text'


def test_seed_rows_are_the_tracked_series(spark):
    assert {r[0] for r in INDICATORS} == set(C.MACRO_SERIES)
    assert indicator_seed(spark).count() == len(C.MACRO_SERIES)


def sheet(etf, columns=C.HOLDINGS_COLUMNS, symbol=None, as_of="As of 04-Nov-2026", body=None, name="a.xlsx",
          end=None):
    body = body if body is not None else [["Apple Inc", "AAPL", "c", "s", "1.5", "-", "10", "USD"],
                                           ["Cash", "-", None, None, "-0.1", None, "2", " "]]
    rows = [["Fund Name:", "x"], ["Ticker Symbol:", symbol or etf], ["Holdings:", as_of], [None],
            list(columns), *body, [end, None], ["Disclaimer", "ZZZ"]]
    return [(etf, name, i, cells) for i, cells in enumerate(rows)]


SHEETS = "etf_symbol string, sheet string, row_no int, cells array<string>"


def test_sheets_of_one_fund_are_told_apart(spark):
    line = lambda name: [name, name, "c", "s", "1", "-", "1", "USD"]
    older = sheet("ONE", as_of="As of 03-Nov-2026", body=[line("AA"), line("BB")], name="old.xlsx", end="")
    newer = sheet("ONE", body=[line("AA"), line("CC"), line("DD")], name="new.xlsx", end=" ")
    bad = sheet("ONE", as_of="soon", name="bad.xlsx")
    df = spark.createDataFrame(older + newer + bad, SHEETS).repartition(4)
    out = sorted((r.as_of_date.day, r.position, r.symbol) for r in H.parse_holdings(df).collect())
    assert out == [(3, 1, "AA"), (3, 2, "BB"), (4, 1, "AA"), (4, 2, "CC"), (4, 3, "DD")]
    assert [tuple(r) for r in H.holdings_rejects(df).collect()] == [("ONE", "bad.xlsx", "no as-of date")]


def test_holdings_sheet(spark):
    data = (sheet("OK") + sheet("COLS", [*C.HOLDINGS_COLUMNS[:7], "Cur"]) + sheet("FUND", symbol="ELSE")
            + sheet("DATE", as_of="soon") + sheet("EMPTY", body=[])
            + sheet("NUM", body=[["A", "A", "c", "s", "much", "-", "1", "USD"]]))
    df = spark.createDataFrame(data, SHEETS).repartition(3)
    assert {(r.etf_symbol, r.reason) for r in H.holdings_rejects(df).collect()} == {
        ("COLS", "unexpected columns"), ("FUND", "other fund in file"), ("DATE", "no as-of date"),
        ("EMPTY", "no holding lines"), ("NUM", "bad number")}
    out = H.parse_holdings(df).orderBy("position").collect()
    assert [(r.etf_symbol, r.position, r.holding_name, r.symbol, r.weight_pct, r.local_currency) for r in out] == [
        ("OK", 1, "Apple Inc", "AAPL", 1.5, "USD"), ("OK", 2, "Cash", None, -0.1, None)]
    assert out[0].as_of_date == dt.date(2026, 11, 4)


def test_watermarks_and_pull_starts(spark):
    table = spark.createDataFrame([("A", days(400)), ("A", days(1))], "k string, d date")
    keys = spark.createDataFrame([("A",), ("B",)], "k string")
    starts = W.pull_starts(keys, W.watermarks(table, "k", "d"), "k", "1990-01-01", 400)
    assert {r.k: r.pull_start for r in starts.collect()} == {"A": D, "B": dt.date(1990, 1, 1)}
    empty = W.pull_starts(keys, W.watermarks(table.limit(0), "k", "d"), "k", "1990-01-01")
    assert {r.pull_start for r in empty.collect()} == {dt.date(1990, 1, 1)}


def test_worklist_order_and_budget(spark):
    keys = spark.createDataFrame([(k,) for k in "dcba"], "symbol string")
    marks = spark.createDataFrame([("a", days(5)), ("c", days(1)), ("d", days(1))], "symbol string, watermark date")
    order = [r.symbol for r in W.refresh_worklist(keys, marks, "symbol", 0).collect()]
    assert order == ["b", "c", "d", "a"]
    assert [r.symbol for r in W.refresh_worklist(keys, marks, "symbol", 2).collect()] == ["b", "c"]


@pytest.mark.parametrize("budget,taken", [(0, "bcda"), (1, "b"), (2, "bc"), (3, "bc"), (4, "bcd"), (5, "bcda"), (9, "bcda")])
def test_requests_are_counted(spark, budget, taken):
    """b costs one request, c two, d and a one: c is started with one request left."""
    keys = spark.createDataFrame([(k,) for k in "dcba"], "symbol string")
    marks = spark.createDataFrame([("a", days(5)), ("c", days(1)), ("d", days(1))], "symbol string, watermark date")
    acted = spark.createDataFrame([("c",), ("c",), ("z",)], "symbol string")
    queue = W.pull_costs(W.refresh_worklist(keys, marks, "symbol", 0), acted)
    got = W.within_budget(queue, [F.asc_nulls_first("watermark"), F.asc("symbol")], "requests", budget)
    assert sorted(r.symbol for r in got.collect()) == sorted(taken)


@pytest.mark.parametrize("row,acted", [
    ((6, 0.1, 1.0), True), ((6, None, 1.0), False), ((6, 0.0, 2.0), True), ((6, 0.0, None), True),
    ((5, 0.1, 2.0), False)])
def test_corporate_actions(spark, row, acted):
    offset, div, split = row
    incoming = spark.createDataFrame([("A", days(offset), div, split)],
                                     "symbol string, obs_date date, div_cash double, split_factor double")
    marks = spark.createDataFrame([("A", days(5))], "symbol string, watermark date")
    assert (W.corporate_actions(incoming, marks).count() == 1) is acted


UNIVERSE = "ticker string, exchange string, asset_type string, price_currency string, start_date date, end_date date"


def test_listed_without_end_date_is_newest(spark):
    u = spark.createDataFrame([("a", "OLD", "Stock", "USD", D, days(9)), ("A", "NEW", "Stock", "USD", D, None)], UNIVERSE)
    assert newest_listing(u).first().exchange == "NEW"


def test_holdings_flag_only_listed_stocks(spark):
    u = spark.createDataFrame([("aa", "N", "Stock", "USD", D, None), ("bb", "N", "ETF", "USD", D, None)], UNIVERSE)
    h = spark.createDataFrame(
        [("E", D, 1, "AA", 50.0, dt.datetime(2020, 1, 1)), ("E", D, 2, "BB", 25.0, dt.datetime(2020, 1, 1)),
         ("E", D, 3, None, 1.0, dt.datetime(2020, 1, 1)), ("E", D, 1, "AA", 60.0, dt.datetime(2020, 1, 2))],
        "etf_symbol string, as_of_date date, position int, symbol string, weight_pct double, _ingested_at timestamp"
    ).selectExpr("*", *[f"'' AS {c}" for c in ("holding_name", "ticker", "identifier", "sedol", "local_currency")],
                 "1D AS shares_held")
    out = {r.position: (r.is_equity, r.weight) for r in stg_etf_holdings(h, u).collect()}
    assert out == {1: (True, 0.6), 2: (False, 0.25), 3: (False, 0.01)}


def test_unlabelled_series_stay_and_nulls_go(spark):
    m = spark.createDataFrame([("GDP", D, 1.0), ("NEW", D, 2.0), ("GDP", days(1), None)],
                              "series_id string, obs_date date, value double").withColumn("_ingested_at", F.current_timestamp())
    out = {r.series_id: r.category for r in stg_macro(m, indicator_seed(spark)).collect()}
    assert out == {"GDP": "growth", "NEW": None}


def test_envelopes(spark):
    msgs = ['{"type":"trade","data":[{"s":"A","p":1.5,"v":2,"t":5,"c":["1"]},{"s":"B","p":2,"t":6}]}',
            '{"type":"ping"}', '{"type":"trade"}']
    out = TR.flatten_envelopes(spark.createDataFrame([(m,) for m in msgs], "message string")).orderBy("symbol").collect()
    assert [tuple(r) for r in out] == [("A", 1.5, 2.0, 5, ["1"]), ("B", 2.0, None, 6, [])]


def test_secrets_are_masked_everywhere_in_the_text(spark):
    df = spark.createDataFrame([("a sk-ant-x1_y-z, sk-ant-q. end",), ("sk-other",), (None,)], "text string")
    assert [r.text for r in mask_secrets(df, "text").collect()] == ["a sk-ant-***, sk-ant-***. end", "sk-other", None]


def test_payloads_lose_nothing_silently(spark):
    rows = [("A", '[{"date":"2024-01-02","close":1,"volume":10.0},{"date":"2024-01-03","close":"2.5","volume":"7"}]'),
            ("B", "{broken"), ("C", '{"page":[]}'), ("D", '[{"date":"2024-01-02","close":"x","volume":1.5}]'), ("E", None),
            ("F", "[1, null, {}, [2]]"), ("G", '[{"date":"2020-13-45","close":1},{"date":"2020-1-2"},{"date":20200102}]'),
            ("H", '{"x":1}'), ("I", "[]"), ("J", '[{"date":"2024-01-05T00:00:00.000Z","open":{"a":1},"high":null,"low":""}]')]
    landed = spark.createDataFrame(rows, "symbol string, payload string")
    found = {(r.key, r.reason, r.field, r.raw) for r in L.payload_rejects(landed, "bars", "symbol").collect()}
    assert found == {
        ("B", "unreadable", None, "{broken"), ("C", "other shape", None, '{"page":[]}'), ("D", "bad number", "close", "x"),
        ("D", "bad number", "volume", "1.5"), ("E", "unreadable", None, None), ("F", "other element", None, "1"),
        ("F", "other element", None, "null"), ("F", "no date", "date", None), ("F", "other element", None, "[2]"),
        ("G", "bad date", "date", "2020-13-45"), ("G", "bad date", "date", "2020-1-2"), ("G", "bad date", "date", "20200102"),
        ("H", "other shape", None, '{"x":1}'), ("J", "bad number", "open", '{"a":1}')}
    want = [("A", 2, 1.0, 10), ("A", 3, 2.5, 7), ("D", 2, None, None), ("J", 5, None, None)]
    bars = lambda frame: sorted((r.symbol, r.obs_date.day, r.close, r.volume) for r in frame.collect())
    assert bars(L.parse_bars(landed)) == want and L.parse_bars(landed).columns == [f.name for f in S.BARS.fields]
    kept, left = L.load(landed, "bars", "symbol")
    assert bars(kept) == want and {tuple(r) for r in left.collect()} == found
    one = spark.createDataFrame([("T", '{"ticker":"T","startDate":"soon"}'), ("U", "{nope"), ("V", '{"name":"V"}'), ("W", "3")],
                                "symbol string, payload string")
    types = spark.createDataFrame([(k, "etf") for k in "TUVW"], "symbol string, asset_type string")
    assert [(r.symbol, r.start_date) for r in L.parse_tickers(one, types).collect()] == [("T", None)]
    assert {(r.key, r.reason, r.field) for r in L.payload_rejects(one, "ticker", "symbol").collect()} == {
        ("T", "bad date", "startDate"), ("U", "unreadable", None), ("V", "no text", "ticker"), ("W", "other shape", None)}
    messages = spark.createDataFrame([('{"type":"ping"}',), ('{"type":"trade"}',), ("x",)], "message string")
    assert [r.reason for r in L.payload_rejects(messages, "trades", column="message").collect()] == [
        "other shape", "unreadable"]


def test_bad_dates_do_not_end_a_load(spark):
    macro = spark.createDataFrame([("GDP", '{"observations":[{"date":"bad","value":"1"},{"date":"2020-01-01","value":"2"},{"value":"3"}]}')],
                                  "series_id string, payload string")
    assert [(r.obs_date, r.value) for r in L.parse_macro(macro).collect()] == [(D, 2.0)]
    assert {(r.key, r.reason, r.raw) for r in L.payload_rejects(macro, "macro", "series_id").collect()} == {
        ("GDP", "bad date", "bad"), ("GDP", "no date", None)}
    news = spark.createDataFrame([('[{"id":1,"publishedDate":"junk","tags":["a"]},{"title":"x"},{"id":2,"tags":"b"}]',)], "payload string")
    assert sorted((r.article_id, r.published_date, tuple(r.tags)) for r in L.parse_news(news).collect()) == [
        ("1", None, ("a",)), ("2", None, ())]
    assert {(r.reason, r.field, r.raw) for r in L.payload_rejects(news, "news").collect()} == {
        ("bad date", "publishedDate", "junk"), ("no text", "id", None), ("bad list", "tags", "b")}
    listed = spark.createDataFrame([("x", "", "Stock", "USD", "2020-99-01", "2020-01-01")], S.CSV_UNIVERSE)
    assert [(r.exchange, r.start_date, r.end_date) for r in L.parse_universe(listed).collect()] == [(None, None, D)]
    assert [tuple(r) for r in L.universe_rejects(listed).collect()] == [("x", "bad date", "startDate", "2020-99-01")]


def test_numbers_of_trades_and_macro_are_read_or_listed(spark):
    trade = lambda p, t: f'{{"type":"trade","data":[{{"s":"A","p":{p},"v":"2","t":{t}}}]}}'
    texts = [trade('"101.5"', "1.7e12"), trade("1", '"x"'), trade("1", "5.5"), trade('{"a":1}', "5"),
             trade("true", "5"), trade("null", "7"), '{"data":[{"s":"A","p":1}]}', '{"type":"ping","data":[{"p":"x"}]}']
    messages = spark.createDataFrame([(m,) for m in texts], "message string")
    assert sorted(tuple(r)[:4] for r in TR.flatten_envelopes(messages.limit(1)).collect()) == [
        ("A", 101.5, 2.0, 1_700_000_000_000)]
    found = [(r.reason, r.field, r.raw) for r in L.payload_rejects(messages, "trades", column="message").collect()]
    assert found == [("bad number", "t", "x"), ("bad number", "t", "5.5"), ("bad number", "p", '{"a":1}'),
                     ("bad number", "p", "true"), ("other shape", None, texts[6])]
    page = lambda v: f'{{"observations":[{{"date":"2024-01-02","value":{v}}}]}}'
    pages = {"ok": '"1.5"', "plain": "2", "missing": '"."', "null": "null", "word": '"n/a"', "comma": '"1,234.5"'}
    landed = spark.createDataFrame([(k, page(v)) for k, v in pages.items()], "series_id string, payload string")
    assert {(r.key, r.reason) for r in L.payload_rejects(landed, "macro", "series_id").collect()} == {
        ("word", "bad number"), ("comma", "bad number")}
    assert sorted((r.series_id, r.value) for r in L.parse_macro(landed).where("value is not null").collect()) == [
        ("ok", 1.5), ("plain", 2.0)]
    bars = spark.createDataFrame([('[{"date":"2024-01-02","volume":1.5}]',)], "payload string")
    assert [r.reason for r in L.payload_rejects(bars, "bars").collect()] == ["bad number"]
