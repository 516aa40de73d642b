"""Every operator as a query over the driver tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barloom import constants as C
from barloom import fixtures as X
from barloom.functions import columns as FN
from barloom.functions.columns import bar_start, is_regular_session, to_symbol
from barloom.operators import merge as M
from barloom.operators.bars import intraday_bars
from barloom.operators.dedupe import first_per_key, latest_bar
from barloom.plans import dims as D
from barloom.plans import intermediate as I
from barloom.plans import marts as G
from barloom.plans import staging as P
from barloom.quality import checks as Q
from barloom.quality import run as R
from barloom.quality import tests as V
from barloom.quality.suite import Limits, standard_checks
from barloom.seeds import indicator_seed
from barloom.session import scratch_dir, written
from barloom.sinks import tables as K
from barloom.sources import holdings as H
from barloom.sources import payloads as L
from barloom.sources import planning as W
from barloom.sources import trades as TR
from barloom.streaming import stateful as SF
from barloom.streaming import trades as ST

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
LOADED = "2002-01-01 00:00:00"


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def r6(df: DataFrame, *cols: str) -> DataFrame:
    """Computed doubles at six places, so engines that add in another order still agree."""
    return df.withColumns({c: F.round(c, 6) for c in cols})


def flat(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.array_join(c, ",") for c in cols})


# --- model inputs ------------------------------------------------------------------------

def markets(s, d):
    return P.stg_markets(X.markets_raw(s, d))


def companies(s, d):
    return P.stg_company_prices(X.company_prices_raw(s, d))


def holdings(s, d):
    return P.stg_etf_holdings(X.etf_holdings_raw(s, d), X.tickers_universe(s, d))


def macro(s, d):
    return P.stg_macro(X.macro_raw(s, d), indicator_seed(s))


def trades(s, d):
    return P.stg_trades(X.quotes_raw(s, d))


def symbols(s, d):
    return D.dim_symbol(X.tickers_raw(s, d), X.tickers_universe(s, d), markets(s, d),
                        D.watchlist_frame(s, X.WATCHLIST), X.BENCHMARK)


def company_dim(s, d):
    return D.dim_company(holdings(s, d), companies(s, d), symbols(s, d))


def hierarchy(s, d):
    return D.dim_symbol_hierarchy(symbols(s, d), company_dim(s, d), holdings(s, d), X.BENCHMARK)


def stored_models(s, d) -> dict[str, DataFrame]:
    """Inputs of the hierarchy marts, each written once in dependency order."""
    m: dict[str, DataFrame] = {}
    put = lambda name, df: m.update({name: written(df, name)})
    put("stg_markets", markets(s, d))
    put("stg_company_prices", companies(s, d))
    put("stg_etf_holdings", holdings(s, d))
    put("dim_symbol", D.dim_symbol(
        X.tickers_raw(s, d), X.tickers_universe(s, d), m["stg_markets"],
        D.watchlist_frame(s, X.WATCHLIST), X.BENCHMARK))
    put("dim_company", D.dim_company(
        m["stg_etf_holdings"], m["stg_company_prices"], m["dim_symbol"]))
    put("dim_symbol_hierarchy", D.dim_symbol_hierarchy(
        m["dim_symbol"], m["dim_company"], m["stg_etf_holdings"], X.BENCHMARK))
    put("int_symbol_returns", I.int_symbol_returns(m["stg_markets"], m["stg_company_prices"]))
    put("mart_market_daily", G.mart_market_daily(m["stg_markets"]))
    put("mart_company_daily", G.mart_company_daily(m["stg_company_prices"]))
    return m


# --- sources -----------------------------------------------------------------------------

def _pages(df: DataFrame, key: str, item) -> DataFrame:
    """Vendor payloads: one per key and year, so a page is bounded by the calendar."""
    return df.groupBy(key, F.year("obs_date").alias("y")).agg(
        F.collect_list(item).alias("items")).drop("y")


@query
def src_macro_obs(s, d):
    item = F.struct(F.col("obs_date").cast("string").alias("date"),
                    F.coalesce(F.col("value").cast("string"), F.lit(".")).alias("value"))
    landed = _pages(X.macro_raw(s, d), "series_id", item).select(
        "series_id", F.to_json(F.struct(F.col("items").alias("observations"))).alias("payload"))
    return L.parse_macro(landed, LOADED)


@query
def src_daily_bars(s, d):
    item = F.struct(
        F.concat(F.col("obs_date").cast("string"), F.lit("T00:00:00.000Z")).alias("date"),
        "open", "high", "low", "close", "volume", F.col("adj_open").alias("adjOpen"),
        F.col("adj_high").alias("adjHigh"), F.col("adj_low").alias("adjLow"),
        F.col("adj_close").alias("adjClose"), F.col("adj_volume").alias("adjVolume"),
        F.col("div_cash").alias("divCash"), F.col("split_factor").alias("splitFactor"))
    landed = _pages(X.company_prices_raw(s, d), "symbol", item).select(
        "symbol", F.to_json("items").alias("payload"))
    return L.parse_bars(landed, LOADED)


@query
def src_payload_rejects(s, d):
    """Yearly bar pages, some cut off, some wrapped, some with a word for a number and some with
    days that are none."""
    item = F.struct(F.col("obs_date").cast("string").alias("date"), "open", "close", "volume")
    kind = F.pmod(F.col("y"), F.lit(4))
    page = F.to_json("items")
    landed = X.company_prices_raw(s, d).groupBy("symbol", F.year("obs_date").alias("y")).agg(
        F.collect_list(item).alias("items")).select(
        "symbol", F.when(kind == 0, F.substring(page, 1, 20))
        .when(kind == 1, F.concat(F.lit('{"page":'), page, F.lit("}")))
        .when(kind == 2, F.regexp_replace(page, r'"volume":(\d+)', '"volume":"about $1"'))
        .otherwise(F.regexp_replace(page, r'-0(\d)"', '-9$1"')).alias("payload"))
    return L.payload_rejects(landed, "bars", "symbol").groupBy("key", "reason", "field").agg(
        F.count("*").alias("n_rejects"))


@query
def src_payload_load(s, d):
    """The same pages with nothing but bad days: rows and rejects of one stored pass, side by side."""
    item = F.struct(F.col("obs_date").cast("string").alias("date"), "close")
    page = F.regexp_replace(F.to_json("items"), r'-0(\d)"', '-9$1"')
    landed = X.company_prices_raw(s, d).groupBy("symbol", F.year("obs_date").alias("y")).agg(
        F.collect_list(item).alias("items")).select("symbol", page.alias("payload"))
    rows, rejects = L.load(landed, "bars", "symbol", LOADED)
    return rows.groupBy("symbol").agg(F.count("*").alias("n_rows"), F.max("obs_date").alias("newest")).join(
        rejects.groupBy(F.col("key").alias("symbol")).agg(
            F.count("*").alias("n_rejects"), F.min("raw").alias("first_raw")), "symbol", "full")


@query
def src_payload_rejects_kinds(s, d):
    """Pages of all five kinds: of every four some are cut off, wrapped, hold words for numbers, or
    dates that are none."""
    year = F.year("obs_date")
    about = lambda n, text: F.when(F.pmod(n, F.lit(4)) == 2, F.concat(F.lit("about "), text)).otherwise(text)
    never = lambda n, text: F.when(F.pmod(n, F.lit(4)) == 3, "2020-13-45").otherwise(text)
    date = never(year, F.col("obs_date").cast("string")).alias("date")
    value = F.coalesce(F.col("value").cast("string"), F.lit("."))
    pages = {
        "macro": X.macro_raw(s, d).groupBy("series_id", year.alias("n")).agg(F.collect_list(
            F.struct(date, about(year, value).alias("value"))).alias("observations")).select(
            "n", F.to_json(F.struct("observations")).alias("payload")),
        "bars": X.company_prices_raw(s, d).groupBy("symbol", year.alias("n")).agg(F.collect_list(
            F.struct(date, about(year, F.col("volume").cast("string")).alias("volume"))).alias("items")).select(
            "n", F.to_json("items").alias("payload")),
        "news": X.news_raw(s, d).select(F.length("article_id").alias("n"), F.to_json(F.array(
            F.struct(F.col("article_id").alias("id"), "title", never(F.length("article_id"), F.lit("")).alias("crawlDate")))
        ).alias("payload")),
        "trades": X.quotes_raw(s, d).select(F.col("trade_time").alias("n"), F.to_json(F.struct(
            F.lit("trade").alias("type"), F.array(F.struct(
                F.col("symbol").alias("s"), F.col("price").cast("string").alias("p"),
                about(F.col("trade_time"), F.col("trade_time").cast("string")).alias("t"))).alias("data"))
        ).alias("payload")),
        "ticker": X.tickers_raw(s, d).select(F.length("symbol").alias("n"), F.to_json(F.struct(
            F.col("symbol").alias("ticker"), "name", never(F.length("symbol"), F.lit("")).alias("endDate"))
        ).alias("payload")),
    }
    found = None
    for kind, frame in pages.items():
        n = F.pmod("n", F.lit(4))
        landed = frame.select(F.when(n == 0, F.substring("payload", 1, 10))
                              .when(n == 1, F.concat(F.lit('{"page":'), "payload", F.lit("}")))
                              .otherwise(F.col("payload")).alias("payload"))
        counted = L.payload_rejects(landed, kind).groupBy(F.lit(kind).alias("kind"), "reason", "field").agg(
            F.count("*").alias("n_rejects"))
        found = counted if found is None else found.unionByName(counted)
    return found


@query
def src_universe_rejects(s, d):
    """A listing file in which every seventh end is none."""
    path = scratch_dir(s, "universe")
    end = F.when(F.pmod(F.dayofyear("start_date"), F.lit(7)) == 0, "2099-02-30").otherwise(F.col("end_date").cast("string"))
    X.tickers_universe(s, d).select(
        "ticker", "exchange", F.col("asset_type").alias("assetType"), F.col("price_currency").alias("priceCurrency"),
        F.col("start_date").alias("startDate"), end.alias("endDate")).write.csv(path, header=True)
    return L.universe_rejects(L.read_universe(s, path)).groupBy("reason", "field", "raw").agg(
        F.count("*").alias("n_rejects"))


@query
def src_ticker_meta(s, d):
    raw = X.tickers_raw(s, d)
    landed = raw.select("symbol", F.to_json(F.struct(
        F.col("symbol").alias("ticker"), "name", F.col("exchange_code").alias("exchangeCode"),
        F.concat(F.col("start_date").cast("string"), F.lit("T00:00:00Z")).alias("startDate"),
        F.when(F.col("symbol") == X.BENCHMARK, "")
        .otherwise(F.col("end_date").cast("string")).alias("endDate"),
        "description")).alias("payload"))
    return L.parse_tickers(landed, raw.select("symbol", "asset_type"), LOADED)


@query
def src_universe(s, d):
    path = scratch_dir(s, "universe")
    X.tickers_universe(s, d).select(
        "ticker", "exchange", F.col("asset_type").alias("assetType"),
        F.col("price_currency").alias("priceCurrency"), F.col("start_date").alias("startDate"),
        F.col("end_date").alias("endDate")).write.csv(path, header=True)
    return L.parse_universe(L.read_universe(s, path), LOADED)


@query
def src_news(s, d):
    iso = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    landed = X.news_raw(s, d).select(F.to_json(F.array(F.struct(
        F.col("article_id").alias("id"), "title", "description", "url", "source",
        iso("published_date").alias("publishedDate"), iso("crawl_date").alias("crawlDate"),
        F.when(F.size("tickers") > 0, F.col("tickers")).alias("tickers"), "tags",
    ))).alias("payload"))
    # Every article comes back on a second page.
    landed = landed.unionByName(landed)
    return flat(L.parse_news(landed, LOADED), "tickers", "tags")


def _sheets(s, d) -> DataFrame:
    """Holdings as sheet rows, a sheet per fund and snapshot; one fund's files have a renamed
    column."""
    lines = first_per_key(X.etf_holdings_raw(s, d), ["etf_symbol", "as_of_date", "position"],
                          [F.desc("_ingested_at")]).withColumn(
        "sheet", F.concat(F.col("as_of_date").cast("string"), F.lit(".xlsx")))
    text = lambda *v: F.array(*[F.lit(x).cast("string") for x in v])
    row = lambda n, cells: F.struct(F.lit(n).alias("row_no"), cells.alias("cells"))
    names = F.when(F.col("etf_symbol") == "SMALL", text(*[
        "Wt" if c == "Weight" else c for c in C.HOLDINGS_COLUMNS])).otherwise(text(*C.HOLDINGS_COLUMNS))
    body = lines.select("etf_symbol", "sheet", (F.col("position") + 4).alias("row_no"), F.array(
        "holding_name", "ticker", "identifier", "sedol", F.col("weight_pct").cast("string"),
        F.lit("-"), F.col("shares_held").cast("string"), "local_currency").alias("cells"))
    as_of = F.concat(F.lit("As of "), F.date_format("as_of_date", "dd-MMM-yyyy"))
    frame = lines.groupBy("etf_symbol", "sheet", "as_of_date").agg(F.max("position").alias("n")).select(
        "etf_symbol", "sheet", F.inline(F.array(
            row(0, F.array(F.lit("Fund Name:"), F.col("etf_symbol"))),
            row(1, F.array(F.lit("Ticker Symbol:"), F.col("etf_symbol"))),
            row(2, F.array(F.lit("Holdings:"), as_of)),
            row(4, names),
            row(F.col("n") + 5, text("", None)),
            row(F.col("n") + 6, text("Past results say little about the future.")))))
    return body.unionByName(frame)


@query
def src_holdings(s, d):
    return H.parse_holdings(_sheets(s, d), LOADED)


@query
def src_holdings_rejects(s, d):
    return H.holdings_rejects(_sheets(s, d))


@query
def src_symbol_normalise(s, d):
    raw = (F.when(F.col("p_size") == 1, " - ").when(F.col("p_size") == 2, "  ")
           .when(F.col("p_size") == 3, None)
           .otherwise(F.concat(F.lit(" "), F.replace("p_brand", F.lit("#"), F.lit(".")), F.lit(" "))))
    return X.table(s, d, "part").select("p_partkey", to_symbol(raw).alias("symbol"))


def _landing(s, d, df: DataFrame | None = None, files: int = 4) -> str:
    """Trades as JSON-lines landing files."""
    path = scratch_dir(s, "landing")
    df = X.quotes_raw(s, d) if df is None else df
    df.select("symbol", "price", "volume", "trade_time", "conditions").repartition(
        files).write.json(path)
    return path


@query
def src_trade_files(s, d):
    return flat(TR.read_trade_files(s, _landing(s, d), LOADED), "conditions")


@query
def src_trade_envelope(s, d):
    one = F.struct(
        F.col("symbol").alias("s"), F.col("price").alias("p"), F.col("volume").alias("v"),
        F.col("trade_time").alias("t"),
        F.when(F.size("conditions") > 0, F.col("conditions")).alias("c"))
    messages = X.quotes_raw(s, d).select(F.explode(F.array(
        F.to_json(F.struct(F.lit("trade").alias("type"), F.array(one, one).alias("data"))),
        F.lit('{"type":"ping"}'))).alias("message"))
    return flat(TR.flatten_envelopes(messages), "conditions")


@query
def src_seed(s, d):
    path = scratch_dir(s, "seed")
    X.table(s, d, "part").select(
        F.col("p_partkey").cast("string").alias("series_id"), F.col("p_name").alias("indicator_name"),
        F.col("p_type").alias("category"), F.lit("monthly").alias("frequency"),
        F.lit("index").alias("units"),
        F.concat(F.lit('The "'), "p_name", F.lit('", as listed')).alias("description"),
        F.col("p_brand").alias("why_it_matters")).write.csv(path, header=True, quote='"', escape='"')
    return L.read_seed(s, path)


def _listed(s, d) -> DataFrame:
    return X.tickers_universe(s, d).select(F.upper("ticker").alias("symbol")).distinct()


@query
def src_watermark(s, d):
    marks = W.watermarks(X.company_prices_raw(s, d), "symbol", "obs_date")
    return W.pull_starts(_listed(s, d), marks, "symbol", C.COMPANY_BACKFILL, C.MACRO_REPULL_DAYS)


@query
def src_refresh_worklist(s, d):
    marks = W.watermarks(X.company_prices_raw(s, d), "symbol", "obs_date")
    return W.refresh_worklist(_listed(s, d), marks, "symbol", C.COMPANY_BUDGET)


@query
def src_request_budget(s, d):
    """The queue cut by requests: a symbol with a corporate action takes two."""
    bars = X.company_prices_raw(s, d)
    marks = W.watermarks(bars, "symbol", "obs_date")
    early = W.watermarks(bars.filter(F.col("obs_date") <= "2001-09-10"), "symbol", "obs_date")
    queue = W.pull_costs(W.refresh_worklist(_listed(s, d), marks, "symbol", 0), W.corporate_actions(bars, early))
    return W.within_budget(queue, [F.asc_nulls_first("watermark"), F.asc("symbol")], "requests", C.COMPANY_BUDGET)


@query
def src_newest_date(s, d):
    """The pull start of a source without keys, of a full and of an empty table."""
    news = X.news_raw(s, d)
    return W.newest_date(news, "published_date").select(F.lit("news").alias("source"), "pull_start").unionByName(
        W.newest_date(news.filter("false"), "published_date").select(F.lit("none").alias("source"), "pull_start"))


@query
def src_stored_span(s, d):
    """Oldest and newest day of a stored table, from its files' footers and from its folders' names."""
    bars = X.company_prices_raw(s, d).select("symbol", "obs_date", F.trunc("obs_date", "month").alias("month"))
    path = scratch_dir(s, "bars")
    K.replace_slices(bars, path, ["month"])
    day, month = K.stored_span(s, path, "obs_date"), K.stored_span(s, path, "month", in_folders=True)
    return s.createDataFrame([("obs_date", *day), ("month", *month)], "name string, oldest date, newest date")


@query
def src_corporate_actions(s, d):
    bars = X.markets_raw(s, d).unionByName(X.company_prices_raw(s, d))
    marks = W.watermarks(bars.filter(F.col("obs_date") <= "2001-09-10"), "symbol", "obs_date")
    return W.corporate_actions(bars, marks)


@query
def src_corporate_reload(s, d):
    bars = latest_bar(X.company_prices_raw(s, d))
    marks = W.watermarks(bars.filter(F.col("obs_date") <= "2001-09-10"), "symbol", "obs_date")
    recent = bars.filter(F.col("obs_date") >= "2001-09-10")
    return W.bars_to_load(recent, bars, marks)


@query
def src_priced_companies(s, d):
    return W.priced_companies(X.etf_holdings_raw(s, d), X.tickers_universe(s, d))


# --- sinks -------------------------------------------------------------------------------

def _bar_merge(s, d) -> tuple[DataFrame, DataFrame]:
    """Stored bars to mid-year, and a later load with adjusted and raw-only corrections."""
    bars = latest_bar(X.company_prices_raw(s, d))
    day = F.dayofmonth("obs_date")
    incoming = bars.filter(F.col("obs_date") >= "2001-01-01").withColumns({
        "adj_close": F.when(day == 7, F.col("adj_close") + 5).otherwise(F.col("adj_close")),
        "close": F.when(day == 8, F.col("close") + 5).otherwise(F.col("close")),
        "_ingested_at": F.lit(LOADED).cast("timestamp")})
    return bars.filter(F.col("obs_date") <= "2001-06-30"), incoming


@query
def upsert_changed(s, d):
    target, incoming = _bar_merge(s, d)
    return M.upsert_actions(target, incoming, ["symbol", "obs_date"], C.BAR_CHANGE_COLS)


@query
def upsert_counts(s, d):
    return M.action_counts(upsert_changed(s, d))


@query
def upsert_observed(s, d):
    """What a stored merge by month reports: counted while the rows are written."""
    target, incoming = _bar_merge(s, d)
    month = F.date_format("obs_date", "yyyy-MM")
    path, staging = scratch_dir(s, "bars"), scratch_dir(s, "staging")
    K.replace_slices(target.withColumn("obs_month", month), path, ["obs_month"])
    counts = K.upsert_slices(s, path, incoming.withColumn("obs_month", month), ["symbol", "obs_date"], ["obs_month"],
                             staging, C.BAR_CHANGE_COLS)
    stored = s.read.parquet(path).agg(F.count("*").alias("stored"))
    return stored.select(F.lit(counts["inserted"]).cast("bigint").alias("inserted"),
                         F.lit(counts["updated"]).cast("bigint").alias("updated"), "stored")


@query
def upsert_slices(s, d):
    """The same merge against a stored table, rewriting only the touched months."""
    path, staging = scratch_dir(s, "bars"), scratch_dir(s, "staging")
    target, incoming = (f.withColumn("obs_month", F.date_format("obs_date", "yyyy-MM"))
                        for f in _bar_merge(s, d))
    K.replace_slices(target, path, ["obs_month"])
    K.upsert_slices(s, path, incoming, ["symbol", "obs_date"], ["obs_month"], staging,
                    C.BAR_CHANGE_COLS)
    return s.read.parquet(path).drop("obs_month")


@query
def upsert_insert_only(s, d):
    news = X.news_raw(s, d)
    stored = news.filter(F.col("source") < "n").withColumn("_ingested_at", F.lit(LOADED).cast("timestamp"))
    return flat(M.insert_only(stored, news, ["article_id"]), "tickers", "tags")


@query
def overwrite_full(s, d):
    root = scratch_dir(s, "versions")
    rows = X.tickers_universe(s, d)
    K.write_version(rows.select("ticker", "exchange"), root, "load-1")
    K.write_version(rows, root, "load-2")
    return K.read_version(s, root)


@query
def replace_slice(s, d):
    path = scratch_dir(s, "holdings")
    keys = ["etf_symbol", "as_of_date"]
    lines = first_per_key(X.etf_holdings_raw(s, d), [*keys, "position"], [F.desc("_ingested_at")])
    K.replace_slices(lines, path, keys)
    again = lines.filter((F.col("etf_symbol") == "PROMO") & (F.col("as_of_date") == "2001-09-28")
                         & F.col("symbol").isNotNull()).withColumn("weight_pct", F.col("weight_pct") / 2)
    for _ in range(2):
        K.replace_slices(again, path, keys)
    return s.read.parquet(path).select(*lines.columns)


@query
def replace_run(s, d):
    path = scratch_dir(s, "results")
    rows = X.dq_results(s, d)
    K.replace_runs(rows, path)
    retried = rows.filter(F.col("check_ts") >= "2024-01-15").withColumn("message", F.lit("retried"))
    for _ in range(2):
        K.replace_runs(retried, path)
    return s.read.parquet(path).select(*rows.columns)


@query
def incremental_merge(s, d):
    """Two runs; the second takes what was loaded after the first and merges it by key."""
    quotes = X.quotes_raw(s, d)
    first = P.stg_trades(quotes.filter(F.col("_ingested_at") <= "2024-01-16"))
    fresh = P.stg_trades(M.newer_than(quotes, "_ingested_at", first, "_ingested_at", "1900-01-01"))
    return flat(M.upsert(first, fresh, ["trade_key"]), "conditions")


def _listing_versions(s, d) -> list[DataFrame]:
    part = X.table(s, d, "part")
    size, brand = F.col("p_size"), F.col("p_brand")
    base = part.select(
        F.col("p_partkey").cast("string").alias("symbol"), F.col("p_name").alias("name"),
        F.col("p_type").alias("asset_type"), F.col("p_brand").alias("exchange_code"),
        F.lit("1995-01-01").cast("date").alias("start_date"),
        F.lit("2001-06-30").cast("date").alias("end_date"),
        F.when(size == 5, None).otherwise(F.lit("first text")).alias("description"), "p_size")
    brand = F.col("exchange_code")
    one = base.filter(brand != "Brand#4")
    two = base.filter(brand != "Brand#3").withColumns({
        "description": F.when((size > 40) | (size == 5), "second text").otherwise(F.col("description")),
        "end_date": F.when(size < 10, F.lit("2001-07-31").cast("date")).otherwise(F.col("end_date"))})
    return [f.drop("p_size") for f in (one, two, base)]


@query
def scd2_snapshot(s, d):
    """Three loads: text changes, end dates move, a brand vanishes and returns."""
    one, two, three = _listing_versions(s, d)
    history = M.first_snapshot(one, "2001-07-01")
    history = M.scd2(history, two, "symbol", C.TICKER_CHECK_COLS, "2001-08-01")
    return M.scd2(history, three, "symbol", C.TICKER_CHECK_COLS, "2001-09-01")


@query
def publish_with_docs(s, d):
    """A model published with its comments, read back from the catalog."""
    table = f"company_docs_{uuid.uuid4().hex[:12]}"
    K.publish(company_dim(s, d), table, scratch_dir(s, "docs"),
              {"symbol": "Price symbol", "sector": "Segment of the fund"}, "Companies held by funds")
    rows = s.table(table).agg(F.count("*")).scalar()
    return s.sql(f"DESCRIBE TABLE {table}").select(
        "col_name", F.coalesce("comment", F.lit("")).alias("comment"), rows.alias("n_rows"))


@query
def publish_layered(s, d):
    layers = {"stg_macro": "silver"}
    path = K.layer_path(scratch_dir(s, "lake"), "stg_macro", layers)
    macro(s, d).write.parquet(path)
    return s.read.parquet(path)


# --- models ------------------------------------------------------------------------------

@query
def stg_markets(s, d):
    return r6(markets(s, d), "daily_return")


@query
def stg_company_prices(s, d):
    return r6(companies(s, d), "daily_return")


@query
def stg_etf_holdings(s, d):
    return holdings(s, d)


@query
def stg_macro(s, d):
    return macro(s, d)


@query
def stg_trades(s, d):
    return flat(trades(s, d), "conditions")


@query
def int_macro_daily(s, d):
    return r6(I.int_macro_daily(macro(s, d), X.AS_OF_DATE), "chg_3m", "chg_12m", "pct_chg_12m")


@query
def int_symbol_returns(s, d):
    return r6(I.int_symbol_returns(markets(s, d), companies(s, d)),
              "return_1m", "return_3m", "return_6m")


@query
def snap_tickers(s, d):
    """Snapshot of symbol metadata after the descriptions of some funds were rewritten."""
    raw = X.tickers_raw(s, d).drop("_ingested_at")
    later = raw.withColumns({
        "description": F.when(F.col("symbol") < "M", F.concat("description", F.lit(".")))
        .otherwise(F.col("description")),
        "end_date": F.date_add("end_date", 1)})
    return M.scd2(M.first_snapshot(raw, "2001-07-01"), later, "symbol", C.TICKER_CHECK_COLS,
                  "2001-08-01")


@query
def dim_indicator(s, d):
    return D.dim_indicator(indicator_seed(s), X.macro_raw(s, d))


@query
def dim_date(s, d):
    return D.dim_date(markets(s, d), X.AS_OF_DATE)


@query
def dim_symbol(s, d):
    return symbols(s, d)


@query
def dim_company(s, d):
    return company_dim(s, d)


@query
def dim_symbol_hierarchy(s, d):
    return hierarchy(s, d)


_HEALTH = ("daily_return", "sma_50", "sma_200", "vol_20d_ann", "drawdown")


@query
def daily_price_health(s, d):
    """The shared indicator function over funds and companies together."""
    return r6(G.price_health(markets(s, d).unionByName(companies(s, d))), *_HEALTH)


@query
def mart_market_daily(s, d):
    return r6(G.mart_market_daily(markets(s, d)), *_HEALTH)


@query
def mart_company_daily(s, d):
    return r6(G.mart_company_daily(companies(s, d)), *_HEALTH)


_RS = [f"{p}_{n}" for n in C.HORIZONS for p in ("return", "rel")]


@query
def mart_sector_relative_strength(s, d):
    return r6(G.mart_sector_relative_strength(
        markets(s, d), written(symbols(s, d), "dim_symbol"), X.BENCHMARK),
              *_RS, *[f"spy_return_{n}" for n in C.HORIZONS])


def _drilldown(s, d, **kw):
    m = stored_models(s, d)
    return r6(G.mart_drilldown_relative_strength(
        m["dim_symbol_hierarchy"], m["int_symbol_returns"], m["mart_market_daily"],
        m["mart_company_daily"], **kw),
        *_RS, *[f"parent_return_{n}" for n in C.HORIZONS], "drawdown")


@query
def mart_drilldown_relative_strength(s, d):
    return _drilldown(s, d)


@query
def rank_across_tasks(s, d):
    """Company returns ranked per day by the multi-task path."""
    from barloom.operators.ranking import rank_across_tasks as ranked

    returns = I.int_symbol_returns(markets(s, d), companies(s, d))
    return ranked(returns, ["obs_date"], {"rank_1m": "return_1m", "rank_6m": "return_6m"}).select(
        "symbol", "obs_date", "rank_1m", "rank_6m")


@query
def mart_macro_market_signals(s, d):
    daily = I.int_macro_daily(macro(s, d), X.AS_OF_DATE)
    return r6(G.mart_macro_market_signals(G.mart_market_daily(markets(s, d)), daily),
              "daily_return", "fwd_21d_return", "fedfunds_chg_3m", "cpi_yoy_pct",
              "cpi_3m_ann_pct", "unrate_chg_3m", "gdp_yoy_pct")


@query
def mart_intraday_bars(s, d):
    return intraday_bars(trades(s, d))


# --- primitives --------------------------------------------------------------------------

@query
def prim_p1(s, d):
    return X.tickers_universe(s, d).filter(
        (F.col("asset_type") == "Stock") & F.col("exchange").isin("NYSE", "ARCX"))


@query
def prim_p2(s, d):
    return X.etf_holdings_raw(s, d).filter(F.col("ticker").isNotNull()).select(
        "etf_symbol", "as_of_date", "position", F.col("symbol").isNotNull().alias("has_symbol"))


@query
def prim_p3(s, d):
    return X.quotes_raw(s, d).filter(is_regular_session(F.col("trade_ts"))).select(
        "symbol", "trade_time", "price")


@query
def prim_p4(s, d):
    return X.markets_raw(s, d).filter(
        ~F.col("div_cash").eqNullSafe(F.lit(0.5)) & ~F.col("split_factor").eqNullSafe(F.lit(1.0))
    ).select("symbol", "obs_date", "adj_close")


@query
def prim_p5(s, d):
    size = F.col("p_size")
    return X.table(s, d, "part").select(
        "p_partkey",
        F.when(size < 10, "small").when(size < 30, "middle").otherwise("big").alias("size_class"),
        F.when(F.col("p_type") == "PROMO", 1).when(F.col("p_type") == "LARGE", 2).alias("type_code"))


@query
def prim_p6(s, d):
    quotes = X.quotes_raw(s, d)
    early = quotes.filter(F.col("trade_ts") < "2024-01-20")
    return M.newer_than(quotes, "trade_ts", early, "trade_ts", "1900-01-01").select(
        "symbol", "trade_time", "price")


@query
def prim_p7(s, d):
    return latest_bar(X.markets_raw(s, d)).select("symbol", "obs_date", "adj_close", "_ingested_at")


@query
def prim_p8(s, d):
    skewed = X.markets_raw(s, d).withColumns({
        "high": F.when(F.dayofmonth("obs_date") == 9, F.col("low") - 1).otherwise(F.col("high")),
        "close": F.when(F.dayofmonth("obs_date") == 11, None).otherwise(F.col("close"))})
    return skewed.filter(Q.impossible_bar()).select("symbol", "obs_date", "adj_close")


@query
def prim_j1(s, d):
    universe = P.newest_listing(X.tickers_universe(s, d))
    return markets(s, d).join(universe, "symbol").select("symbol", "obs_date", "close", "exchange")


@query
def prim_j2(s, d):
    macro_days = X.macro_raw(s, d).filter(F.col("series_id") == "DGS10").select(
        "obs_date", F.col("value").alias("dgs10"))
    return markets(s, d).join(macro_days, "obs_date", "left").select("symbol", "obs_date", "dgs10")


@query
def prim_j3(s, d):
    bars = markets(s, d).select("symbol", "obs_date", "close")
    base = bars.filter(F.col("symbol") == X.BENCHMARK).select(
        "obs_date", F.col("close").alias("base_close"))
    return bars.join(base, "obs_date").select("symbol", "obs_date", "close", "base_close")


@query
def prim_j4(s, d):
    from barloom.operators.timeseries import as_of_values

    return as_of_values(macro(s, d).select("series_id", "obs_date", "value"), {"value_1m_ago": 1})


@query
def prim_j5(s, d):
    return X.quotes_raw(s, d).withColumn(
        "bar_minutes", F.explode(F.array(F.lit(1), F.lit(5)))).groupBy("symbol", "bar_minutes").agg(
        F.count("*").alias("n"), F.countDistinct(bar_start(F.col("trade_ts"), F.col("bar_minutes"))).alias("bars"))


@query
def prim_j6(s, d):
    lines = X.etf_holdings_raw(s, d)
    return lines.join(P.first_per_key(lines.select("etf_symbol", "as_of_date"), ["etf_symbol"],
                                      [F.desc("as_of_date")]), ["etf_symbol", "as_of_date"]).select(
        "etf_symbol", "as_of_date", "position", "weight_pct")


@query
def prim_j7(s, d):
    target, incoming = _bar_merge(s, d)
    keys = ["symbol", "obs_date"]
    return target.select(*keys, F.lit(1).alias("old")).join(
        incoming.select(*keys, F.lit(1).alias("new")), keys, "full_outer").select(
        *keys, F.col("old").isNotNull().alias("stored"), F.col("new").isNotNull().alias("incoming"))


@query
def prim_j8(s, d):
    held = X.etf_holdings_raw(s, d).select("symbol").distinct().withColumn("_held", F.lit(True))
    return _listed(s, d).join(held, "symbol", "left").select(
        "symbol", F.coalesce("_held", F.lit(False)).alias("is_held"))


def _by_day():
    return Window.partitionBy("symbol").orderBy("obs_date")


def _window(s, d, **cols):
    return markets(s, d).withColumns(cols).select("symbol", "obs_date", *cols)


@query
def prim_w1(s, d):
    return _window(s, d, day_n=F.row_number().over(_by_day()))


@query
def prim_w2(s, d):
    return _window(s, d, **{f"lag_{n}": F.lag("adj_close", n).over(_by_day()) for n in (1, 21, 63, 126)})


@query
def prim_w3(s, d):
    return _window(s, d, lead_21=F.lead("adj_close", 21).over(_by_day()))


@query
def prim_w4(s, d):
    return G.price_health(markets(s, d)).select(
        "symbol", "obs_date", F.round("sma_50", 6).alias("sma_50"), F.round("sma_200", 6).alias("sma_200"))


@query
def prim_w5(s, d):
    return G.price_health(markets(s, d)).select(
        "symbol", "obs_date", F.round("vol_20d_ann", 6).alias("vol_20d_ann"))


@query
def prim_w6(s, d):
    return G.price_health(markets(s, d)).select("symbol", "obs_date", "running_peak")


@query
def prim_w7(s, d):
    frame = _by_day().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    raw = latest_bar(X.markets_raw(s, d))
    return raw.select("symbol", "obs_date",
                      F.last("div_cash", ignorenulls=True).over(frame).alias("last_dividend"))


@query
def prim_w8(s, d):
    from barloom.operators.ranking import rank_in_window

    return rank_in_window(markets(s, d), ["obs_date"], {"rank_return": "daily_return"}).select(
        "symbol", "obs_date", "rank_return")


@query
def prim_w9(s, d):
    return markets(s, d).select(
        "symbol", "obs_date", F.count("*").over(Window.partitionBy("obs_date")).alias("reporting"))


@query
def prim_w10(s, d):
    per = Window.partitionBy("symbol", F.year("obs_date"))
    return markets(s, d).select("symbol", "obs_date", F.min("low").over(per).alias("year_low"),
                                F.max("high").over(per).alias("year_high"))


@query
def prim_w11(s, d):
    return G.price_health(markets(s, d)).select(
        "symbol", "obs_date", "cross_signal",
        F.lag("cross_signal").over(_by_day()).alias("prev_cross"))


@query
def prim_agg(s, d):
    return X.quotes_raw(s, d).groupBy("symbol").agg(
        F.count("*").alias("n"), F.sum("volume").alias("shares"),
        F.min("price").alias("low"), F.max("price").alias("high"),
        F.min_by("price", F.struct("trade_ts", "price")).alias("first_price"),
        F.max_by("price", F.struct("trade_ts", "price")).alias("last_price"),
        F.bool_and(F.col("volume") >= 0).alias("all_sized"),
        F.countDistinct("trade_time").alias("times"),
        F.count_if(F.col("volume") == 0).alias("unsized"),
        F.max(F.when(F.size("conditions") > 1, F.col("price"))).alias("top_block"),
        F.round(F.avg(F.when(F.col("volume") > 0, 1.0).otherwise(0.0)), 6).alias("sized_rate"))


@query
def prim_having(s, d):
    return X.markets_raw(s, d).groupBy("symbol", "obs_date").agg(F.count("*").alias("n")).filter("n > 1")


@query
def prim_collect_set(s, d):
    return X.quotes_raw(s, d).groupBy(F.to_date("trade_ts").alias("day")).agg(
        F.array_join(F.sort_array(F.collect_set("symbol")), ",").alias("symbols"))


@query
def prim_distinct(s, d):
    return markets(s, d).select("obs_date").distinct()


@query
def prim_set_ops(s, d):
    expected = _listed(s, d)
    present = X.etf_holdings_raw(s, d).select("symbol").distinct()
    both = X.markets_raw(s, d).select("symbol").unionByName(X.company_prices_raw(s, d).select("symbol"))
    return expected.join(present, "symbol", "left_anti").withColumn("n", F.lit(0).cast("bigint")).unionByName(
        both.groupBy("symbol").agg(F.count("*").alias("n")))


@query
def prim_topk(s, d):
    return markets(s, d).select("symbol", "obs_date", "close").orderBy(
        F.desc("close"), "symbol", "obs_date").limit(25)


@query
def prim_fn_string(s, d):
    return X.table(s, d, "part").select(
        "p_partkey", F.upper("p_name").alias("up"), F.trim(F.concat(F.lit("  "), "p_name")).alias("tr"),
        F.replace("p_brand", F.lit("#"), F.lit("-")).alias("rep"),
        F.concat_ws("|", "p_brand", F.lit(None).cast("string"), "p_type").alias("joined"),
        F.array_join(F.array("p_brand", "p_type"), ",").alias("arr"),
        F.substring("p_name", 1, 10).alias("sub"),
        F.regexp_replace("p_name", "[aeiou]+", "*").alias("masked"),
        F.initcap("p_name").alias("title"), F.sha2("p_name", 256).alias("digest"))


@query
def prim_fn_date(s, d):
    c = F.col("o_orderdate").cast("date")
    return X.table(s, d, "orders").select(
        "o_orderkey", c.alias("d"), F.year(c).alias("y"), F.quarter(c).alias("q"),
        F.month(c).alias("m"), F.dayofmonth(c).alias("dom"), F.dayofweek(c).alias("dow"),
        F.last_day(c).alias("eom"), F.add_months(c, -3).alias("back3"),
        F.datediff(F.lit(X.AS_OF_DATE).cast("date"), c).alias("age"),
        F.date_sub(c, 30).alias("back30"), F.date_format(c, "MMMM").alias("month_name"),
        F.date_format(c, "EEEE").alias("day_name"),
        F.size(F.sequence(c, F.last_day(c))).alias("days_left"))


@query
def prim_fn_timestamp(s, d):
    ts = F.col("ts").cast("timestamp")
    return X.table(s, d, "events").select(
        "event_id", F.unix_seconds(ts).alias("sec"),
        F.timestamp_seconds(F.unix_seconds(ts)).alias("whole"),
        F.to_date(F.from_utc_timestamp(ts, C.MARKET_ZONE)).alias("et_date"),
        F.date_format(F.from_utc_timestamp(ts, C.MARKET_ZONE), "HH:mm").alias("et_minute"),
        F.to_timestamp(F.date_format(ts, "yyyy-MM-dd HH:mm:ss")).alias("parsed"),
        bar_start(ts, F.lit(5)).alias("bar"))


@query
def prim_fn_math(s, d):
    v = F.col("value")
    return X.table(s, d, "events").select(
        "event_id", F.round(F.sqrt(v), 6).alias("root"), F.round(F.pow(v / 700, F.lit(4.0)), 6).alias("p4"),
        F.abs(v - 50).alias("dist"), F.floor(v / 5).alias("bucket"),
        F.round(F.try_divide(v, F.get_json_object("props", "$.k").cast("double") * 7), 6).alias("ratio"))


@query
def prim_fn_null(s, d):
    return X.macro_raw(s, d).select(
        "series_id", "obs_date", F.coalesce("value", F.lit(-1.0)).alias("filled"),
        F.nullif("value", F.lit(0.0)).alias("non_zero"), F.lit(None).cast("double").alias("empty"),
        F.col("obs_date").cast("string").alias("day_text"))


@query
def prim_fn_json(s, d):
    return X.table(s, d, "events").select(
        "event_id", F.to_json(F.struct("event_type", "event_id")).alias("doc"))


@query
def prim_fn_array(s, d):
    return X.quotes_raw(s, d).select(
        "symbol", "trade_time", F.explode("conditions").alias("condition"))


SECRETS = (*C.SECRET_PATTERNS, (r'token = "[0-9a-f]+"', 'token = "***"'))


@query
def mask_secrets(s, d):
    return FN.mask_secrets(X.table(s, d, "documents").select(
        "doc_id", F.concat("text", F.lit(" key sk-ant-ab_c-"), "doc_id").alias("text")), "text", SECRETS)


# --- streaming ---------------------------------------------------------------------------

@query
def stream_ingest(s, d):
    """Landed files into bronze, a few files per micro-batch; drained twice, each file once."""
    landing, root = _landing(s, d), scratch_dir(s, "bronze")
    for _ in range(2):
        ST.append_stream(TR.stream_trade_files(s, landing, 2, LOADED), f"{root}/quotes",
                         f"{root}/checkpoint").awaitTermination()
    return flat(s.read.parquet(f"{root}/quotes"), "conditions")


@query
def stream_append(s, d):
    """New files after a drain are appended by the next drain."""
    quotes = X.quotes_raw(s, d)
    first, second = quotes.filter(F.col("volume") < 90), quotes.filter(F.col("volume") >= 90)
    landing, root = _landing(s, d, first), scratch_dir(s, "bronze")
    for more in (None, second):
        if more is not None:
            more.select("symbol", "price", "volume", "trade_time", "conditions").write.mode(
                "append").json(landing)
        ST.append_stream(TR.stream_trade_files(s, landing, loaded_at=LOADED), f"{root}/quotes",
                         f"{root}/checkpoint").awaitTermination()
    return flat(s.read.parquet(f"{root}/quotes"), "conditions")


def _day_ranges(s, d, landing: str):
    """Trades landed by day ranges, oldest first: gives control after each range. Every task
    lands the file of its rows, so no range goes through one task."""
    quotes, day = X.quotes_raw(s, d), F.col("trade_ts")
    for part in (day < "2024-01-11", (day >= "2024-01-11") & (day < "2024-01-21"), day >= "2024-01-21"):
        quotes.filter(part).select("symbol", "price", "volume", "trade_time", "conditions").write.mode(
            "append").json(landing)
        yield


def _stream_all(s, d) -> str:
    """Trades streamed by day ranges through silver and bars, one micro-batch each."""
    landing, root = scratch_dir(s, "landing"), scratch_dir(s, "lake")
    for _ in _day_ranges(s, d, landing):
        ST.trade_pipeline(s, landing, root, f"{root}/checkpoint", loaded_at=LOADED).awaitTermination()
    return root


@query
def stream_trades(s, d):
    return flat(s.read.parquet(f"{_stream_all(s, d)}/silver/stg_trades"), "conditions")


@query
def stream_bars(s, d):
    return s.read.parquet(f"{_stream_all(s, d)}/gold/mart_intraday_bars")


def _stateful(s, d, delay: str, widths: tuple[int, ...] = C.BAR_MINUTES) -> str:
    """The same parts, one drain each, through stream state; every drain starts anew."""
    landing, root = scratch_dir(s, "landing"), scratch_dir(s, "lake")
    for _ in _day_ranges(s, d, landing):
        SF.start_trades(s, landing, f"{root}/trades", f"{root}/cp/trades", delay, loaded_at=LOADED).awaitTermination()
        for width in widths:
            SF.start_bars(s, f"{root}/trades", f"{root}/bars_{width}", f"{root}/cp/bars_{width}", width,
                          delay).awaitTermination()
    return root


@query
def stream_stateful_trades(s, d):
    rows = s.read.parquet(f"{_stateful(s, d, '60 days', widths=())}/trades")
    return flat(rows.select(*trades(s, d).columns), "conditions")


@query
def stream_stateful_bars(s, d):
    root = _stateful(s, d, "60 days")
    bars = [s.read.parquet(f"{root}/bars_{width}") for width in C.BAR_MINUTES]
    return bars[0].unionByName(bars[1])


@query
def stream_stateful_missed(s, d):
    """The older part lands behind the watermark of the newer one, and is listed."""
    quotes = X.quotes_raw(s, d)
    landing, root = scratch_dir(s, "landing"), scratch_dir(s, "lake")
    for part in (F.col("trade_ts") >= "2024-01-11", F.col("trade_ts") < "2024-01-11"):
        quotes.filter(part).select("symbol", "price", "volume", "trade_time", "conditions").write.mode(
            "append").json(landing)
        SF.start_trades(s, landing, f"{root}/trades", f"{root}/cp", "1 hour", loaded_at=LOADED).awaitTermination()
    landed = TR.read_trade_files(s, landing, LOADED)
    return flat(SF.missed(landed, s.read.parquet(f"{root}/trades")), "conditions")


@query
def stream_available_now(s, d):
    """Drain and stop: whatever has landed is counted once the query ends."""
    landing, root = _landing(s, d), scratch_dir(s, "drain")
    ST.append_stream(TR.stream_trade_files(s, landing, 1, LOADED), f"{root}/quotes",
                     f"{root}/checkpoint").awaitTermination()
    return s.read.parquet(f"{root}/quotes").groupBy("symbol").agg(F.count("*").alias("n"))


def _late(s, d) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(stored bars, all trades, late trades): big trades reach silver after the bars were built."""
    silver = trades(s, d)
    late_keys = silver.filter(F.col("volume") > 80)
    bars = intraday_bars(silver.filter(F.col("volume") <= 80))
    return bars, silver, ST.late_trades(silver, bars, late_keys)


@query
def late_trades(s, d):
    return flat(_late(s, d)[2], "conditions")


@query
def late_trades_repair(s, d):
    """The repair of stored bars from stored trades: only days with late trades are read."""
    bars, silver, _ = _late(s, d)
    root = scratch_dir(s, "late")
    K.replace_slices(silver, f"{root}/trades", ["trade_date"])
    K.replace_slices(bars, f"{root}/bars", ["bar_date"])
    stored = s.read.parquet(f"{root}/trades")
    late = written(ST.late_trades(stored, s.read.parquet(f"{root}/bars"), stored.filter(F.col("volume") > 80)), "late-trades")
    ST.repair_stored_bars(s, f"{root}/bars", stored, late, f"{root}/staging")
    return s.read.parquet(f"{root}/bars").select(*bars.columns)


# --- quality -----------------------------------------------------------------------------

MACRO_LIMITS = {**C.MACRO_MAX_LAG_DAYS, "DGS10": 100, "ABSENT": 5}
BAR_LIMITS = {"ALL": 90, "STANDARD": 90, "NOSUCH": 90}


def _dated(s, d) -> DataFrame:
    """Macro dates, and a series stored without any."""
    series = X.macro_raw(s, d).select("series_id", "obs_date")
    return series.unionByName(s.createDataFrame([("UNDATED", None)], series.schema))


@query
def chk_freshness_by_key(s, d):
    bars, series = X.markets_raw(s, d), _dated(s, d)
    return Q.check_freshness_by_key(
        bars, "markets_freshness", "markets_raw", "symbol", "obs_date",
        Q.limits_frame(bars, BAR_LIMITS, "symbol"), X.AS_OF_DATE, 90,
    ).unionByName(Q.check_freshness_by_key(
        series, "macro_freshness", "macro_raw", "series_id", "obs_date",
        Q.limits_frame(series, MACRO_LIMITS, "series_id"), X.AS_OF_DATE))


@query
def chk_freshness_detail(s, d):
    series = _dated(s, d)
    return Q.freshness_detail(series, "series_id", "obs_date",
                              Q.limits_frame(series, MACRO_LIMITS, "series_id"), X.AS_OF_DATE)


@query
def chk_duplicate_keys(s, d):
    return Q.check_duplicate_keys(
        X.markets_raw(s, d), "markets_duplicates", "markets_raw", ["symbol", "obs_date"],
    ).unionByName(Q.check_duplicate_keys(
        X.news_raw(s, d), "news_duplicates", "news_raw", ["article_id"]))


@query
def chk_ohlc_sanity(s, d):
    bars = X.markets_raw(s, d).withColumn(
        "low", F.when(F.dayofmonth("obs_date") == 1, 0.0).otherwise(F.col("low")))
    return Q.check_ohlc_sanity(bars, "markets_ohlc_sanity", "markets_raw", "2001-11-04")


@query
def chk_price_jump(s, d):
    return Q.check_price_jump(X.markets_raw(s, d), "markets_adj_jump", "markets_raw", "2001-11-04")


@query
def chk_price_jump_rows(s, d):
    return Q.price_jumps(X.company_prices_raw(s, d), "2001-11-04", days=2000)


@query
def chk_key_and_null(s, d):
    return Q.check_key_and_null(X.macro_raw(s, d), "macro_integrity", "macro_raw",
                                ["series_id", "obs_date"], "value")


@query
def chk_recency_hours(s, d):
    news = X.news_raw(s, d)
    return Q.check_recency_hours(
        news, "news_freshness", "news_raw", "published_date", "2024-01-03 00:00:00",
    ).unionByName(Q.check_recency_hours(
        news.filter("source = 'none'"), "empty_freshness", "news_raw", "published_date",
        "2024-01-03 00:00:00"))


@query
def chk_last_session(s, d):
    quotes = X.quotes_raw(s, d)
    days = quotes.select(F.to_date("trade_ts").alias("obs_date"))
    return Q.check_last_session(quotes, days, "quotes_last_session", "quotes_raw",
                                [*X.TRADE_SYMBOLS, "refund"], 100)


@query
def chk_row_count_age(s, d):
    return Q.check_row_count_age(
        X.tickers_raw(s, d), "tickers_refresh", "tickers_raw", X.AS_OF_DATE,
        C.TICKERS_MAX_AGE_DAYS, exact=len(X.WATCHLIST) + 1,
    ).unionByName(Q.check_row_count_age(
        X.tickers_universe(s, d), "universe_refresh", "tickers_universe", X.AS_OF_DATE,
        C.UNIVERSE_MAX_AGE_DAYS, minimum=C.UNIVERSE_MIN_ROWS))


def _jobs(s, d) -> tuple[DataFrame, DataFrame, DataFrame]:
    expected = s.createDataFrame(
        [("view", 48), ("click", 1), ("signup", 30), ("purchase", 24), ("error", 240),
         ("weekly", 192), ("stalled", 24), ("absent", 24)], "job_name string, max_age_hours int")
    jobs = X.job_runs(s, d).groupBy("job_name").agg(F.min("start_ts").alias("created_ts")).unionByName(
        s.createDataFrame([("weekly", "2024-01-28"), ("stalled", "2024-01-02")], "job_name string, d string")
        .select("job_name", F.col("d").cast("timestamp").alias("created_ts")))
    return expected, jobs, X.job_runs(s, d)


@query
def chk_latest_run(s, d):
    return Q.check_latest_run(*_jobs(s, d), X.TRADES_NOW)


def _suite(s, d) -> DataFrame:
    """All twelve checks, one broken and one switched off beside them, stored as one run."""
    def broken():
        return X.markets_raw(s, d).select(F.raise_error(F.lit("broken rule")).alias("check_name"),
                                          *[F.lit("").alias(c) for c in Q.RESULT_COLUMNS[1:]])

    limits = Limits(bars=BAR_LIMITS, other_bars=90, macro=MACRO_LIMITS, quote_symbols=[*X.TRADE_SYMBOLS, "refund"],
                    quote_rows=100, tickers=len(X.WATCHLIST) + 1)
    checks = standard_checks(lambda name: getattr(X, name)(s, d), X.AS_OF_DATE, X.TRADES_NOW, limits, lambda: _jobs(s, d))
    off = standard_checks(lambda name: getattr(X, name)(s, d), X.AS_OF_DATE, X.TRADES_NOW, Limits(news_enabled=False))
    checks |= {"broken_rule": broken, "off": off["news_freshness"]}
    return R.run_all(s, checks, "run-1", X.TRADES_NOW, scratch_dir(s, "ops"))


@query
def chk_run_all(s, d):
    return _suite(s, d).select("run_id", "check_name", "severity", "status", "observed")


@query
def chk_suite_gate(s, d):
    """The gate over that run, and its incident."""
    results = _suite(s, d)
    none = s.createDataFrame([], "run_id string")
    incident = R.incident_rollup(results, none, X.TRADES_NOW).select("run_id", F.array_join("failed_checks", ",").alias("failed"))
    return R.gate(results).join(incident, "run_id")


@query
def dq_gate(s, d):
    return R.gate(X.dq_results(s, d))


@query
def dq_incident_rollup(s, d):
    results = X.dq_results(s, d)
    recorded = results.filter(F.col("check_ts") < "2024-01-10").select("run_id").distinct()
    return flat(R.incident_rollup(results, recorded, X.TRADES_NOW), "failed_checks")


@query
def dq_latest_run_results(s, d):
    return R.latest_run_results(X.dq_results(s, d))


@query
def dq_pass_rate(s, d):
    return r6(R.pass_rate(X.dq_results(s, d), "2024-01-31", 20), "pass_rate")


@query
def source_freshness(s, d):
    return R.source_freshness({
        "markets_raw": X.markets_raw(s, d), "macro_raw": X.macro_raw(s, d),
        "tickers_raw": X.tickers_raw(s, d), "tickers_universe": X.tickers_universe(s, d),
        "company_prices_raw": X.company_prices_raw(s, d),
        "etf_holdings_raw": X.etf_holdings_raw(s, d), "quotes_raw": X.quotes_raw(s, d),
    }, "2002-01-03 00:00:00")


@query
def test_not_null(s, d):
    return V.test_not_null(holdings(s, d), "symbol").select("etf_symbol", "as_of_date", "position").unionByName(
        V.test_not_null(holdings(s, d), "symbol", "is_equity").select("etf_symbol", "as_of_date", "position"))


@query
def test_unique(s, d):
    return V.test_unique(X.tickers_universe(s, d), "ticker")


@query
def test_unique_combination(s, d):
    return V.test_unique_combination(X.company_prices_raw(s, d), ["symbol", "obs_date"])


@query
def test_accepted_values(s, d):
    return V.test_accepted_values(holdings(s, d), "etf_symbol", ["PROMO", "LARGE"]).unionByName(
        V.test_accepted_values(symbols(s, d), "role", ["broad_market", "sector", "size", "bond"])
        .withColumnRenamed("role", "etf_symbol"))


@query
def test_relationships(s, d):
    return V.test_relationships(macro(s, d), "series_id", indicator_seed(s), "series_id").select(
        "series_id", "obs_date", "value")


@query
def test_accepted_range(s, d):
    return V.test_accepted_range(holdings(s, d), "weight", 0, 1).select(
        "etf_symbol", "as_of_date", "position", "weight").unionByName(
        V.test_accepted_range(holdings(s, d), "weight", 0.04, None, False, "is_equity").select(
            "etf_symbol", "as_of_date", "position", "weight"))


@query
def test_expression(s, d):
    return V.test_expression(intraday_bars(trades(s, d)), "close >= open")


@query
def declared_tests(s, d):
    """The whole build, then all declared tests of all models with their failing rows counted."""
    from barloom.plans.pipeline import build, declared_tests as run_declared

    return run_declared(build(
        s, X.bronze(s, d), indicator_seed(s), D.watchlist_frame(s, X.WATCHLIST),
        scratch_dir(s, "lake"), X.AS_OF_DATE, X.BENCHMARK))
