"""Bronze frames derived by Spark from the driver tables, so the models have input at any scale.

Prices are the stored line prices; everything that must be exact in another engine is summed in
whole cents. Nothing depends on today's date.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barloom import schemas as S
from barloom.session import pin_utc

AS_OF_DATE = "2001-12-31"
TRADES_NOW = "2024-01-31 00:00:00"
BENCHMARK = "ALL"
WATCHLIST = {
    "ALL": ("broad_market", "Whole market"),
    "STANDARD": ("sector", "Standard goods"),
    "PROMO": ("sector", "Promoted goods"),
    "ECONOMY": ("sector", "Economy goods"),
    "MEDIUM": ("size", "Medium goods"),
    "LARGE": ("bond", "Large goods"),
}
TRADE_SYMBOLS = ("click", "error", "purchase", "signup", "view")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return pin_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def brand_symbol(brand: Column) -> Column:
    return F.replace(F.upper(brand), F.lit("#"), F.lit("-"))


def cents(amount: Column) -> Column:
    return F.round(amount * 100).cast("bigint")


# --- daily bars --------------------------------------------------------------------------

def _lines(spark: SparkSession, sf_dir: str, symbol: Column) -> DataFrame:
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), symbol.alias("symbol"))
    return table(spark, sf_dir, "lineitem").join(parts, "l_partkey").select(
        "symbol", F.col("l_shipdate").cast("date").alias("obs_date"),
        "l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("px"),
        F.col("l_quantity").cast("bigint").alias("qty"))


def _ohlc(lines: DataFrame) -> DataFrame:
    at = F.struct("l_orderkey", "l_linenumber", "px")
    return lines.groupBy("symbol", "obs_date").agg(
        F.min(at).alias("_first"), F.max("px").alias("high"), F.min("px").alias("low"),
        F.max(at).alias("_last"), F.sum("qty").alias("volume"))


def _bars(ohlc: DataFrame) -> DataFrame:
    day = F.dayofmonth("obs_date")
    # Some days have an earlier load, superseded by the other.
    loads = F.when(day <= 3, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    return ohlc.withColumn("_stale", F.explode(loads)).select(
        "symbol", "obs_date", F.col("_first.px").alias("open"), "high", "low",
        F.col("_last.px").alias("close"), "volume",
        F.col("_first.px").alias("adj_open"), F.col("high").alias("adj_high"),
        F.col("low").alias("adj_low"),
        F.when(F.col("_stale"), F.col("_last.px") + 1.0).otherwise(F.col("_last.px")).alias("adj_close"),
        F.col("volume").alias("adj_volume"),
        F.when(day == 15, 0.5).alias("div_cash"),
        F.when((day == 20) & (F.month("obs_date") == 6), 2.0).when(day != 10, 1.0)
        .alias("split_factor"),
        F.date_add("obs_date", F.when(F.col("_stale"), 0).otherwise(1)).cast("timestamp").alias("_ingested_at"))


def markets_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fund bars: the benchmark over all parts and one symbol per part type. The benchmark's are
    folded from those of the types, so a line is folded once."""
    types = _ohlc(_lines(spark, sf_dir, F.col("p_type")))
    return _bars(types.withColumn("symbol", F.explode(F.array(F.lit(BENCHMARK), F.col("symbol")))).groupBy(
        "symbol", "obs_date").agg(
        F.min("_first").alias("_first"), F.max("high").alias("high"), F.min("low").alias("low"),
        F.max("_last").alias("_last"), F.sum("volume").alias("volume")))


def company_prices_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Company bars: one symbol per brand."""
    return _bars(_ohlc(_lines(spark, sf_dir, brand_symbol(F.col("p_brand")))))


# --- macro -------------------------------------------------------------------------------

def macro_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderpriority", "o_orderstatus", F.col("o_orderdate").cast("date").alias("d"),
        cents(F.col("o_totalprice")).alias("c"))
    month = F.trunc("d", "month")
    entry = lambda code, date: F.struct(code.alias("code"), date.alias("obs_date"), F.col("c"))
    entries = orders.select(F.inline(F.array(
        entry(F.col("o_orderpriority"), month), entry(F.lit("all"), month), entry(F.col("o_orderstatus"), F.col("d")))))
    series = {
        "1-URGENT": "CPIAUCSL", "2-HIGH": "UNRATE", "3-MEDIUM": "FEDFUNDS",
        "4-NOT SPECIFIED": "GDP", "5-LOW": "UMCSENT", "all": "ORDERSX",
        "F": "DGS10", "O": "DGS2", "P": "T10Y2Y",
    }
    names = F.create_map(*[F.lit(x) for pair in series.items() for x in pair])
    mean = F.sum("c") / F.count("*") / 100
    sid, raw, date = F.col("series_id"), F.col("raw"), F.col("obs_date")
    value = (
        F.when(sid == "FEDFUNDS", (raw - 200000) / 7001)
        .when(sid.isin("DGS10", "DGS2"), raw / 70001)
        .when((sid == "T10Y2Y") & (F.dayofmonth(date) == 1), 0.0)
        .when(sid == "T10Y2Y", raw / 70001 - 3.5)
        .when((sid == "UMCSENT") & (F.month(date) == 7), None)
        .otherwise(raw)
    )
    return (
        entries.groupBy("code", "obs_date").agg(mean.alias("raw"))
        .withColumn("series_id", F.try_element_at(names, F.col("code")))
        .filter((sid != "GDP") | (F.month(date) % 3 == 1))
        .select("series_id", "obs_date", value.alias("value"),
                F.date_add("obs_date", 1).cast("timestamp").alias("_ingested_at"))
    )


# --- trades ------------------------------------------------------------------------------

def quotes_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades from events; those of size 90 and more were delivered a second time a day later."""
    size = F.get_json_object("props", "$.k").cast("double")
    first = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("symbol"), F.col("value").alias("price"),
        size.alias("volume"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("trade_time"),
        F.when(size < 10, F.array().cast("array<string>"))
        .when(size > 50, F.array("event_type", F.lit("block")))
        .otherwise(F.array("event_type")).alias("conditions"),
    ).withColumn("trade_ts", F.timestamp_millis("trade_time"))
    loaded = F.date_add(F.to_date("trade_ts"), 1).cast("timestamp")
    loads = F.when(F.col("volume") >= 90, F.array(loaded, loaded + F.expr("INTERVAL 1 DAY"))).otherwise(F.array(loaded))
    return first.withColumn("_ingested_at", F.explode(loads))


# --- symbols -----------------------------------------------------------------------------

def tickers_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select(
        F.explode(F.array(F.lit(BENCHMARK), F.col("p_type"))).alias("symbol"), "p_size")
    return parts.groupBy("symbol").agg(
        F.min("p_size").alias("small"), F.max("p_size").alias("big"),
        F.count("*").alias("n"),
    ).select(
        "symbol", F.concat(F.col("symbol"), F.lit(" Fund")).alias("name"),
        F.lit("ETF").alias("asset_type"), F.lit("ARCX").alias("exchange_code"),
        F.date_add(F.lit("1995-01-01").cast("date"), F.col("small")).alias("start_date"),
        F.date_add(F.lit("2001-11-01").cast("date"), F.col("big")).alias("end_date"),
        F.concat(F.lit("Holds "), F.col("n"), F.lit(" parts")).alias("description"),
        F.lit("2001-12-30 06:00:00").cast("timestamp").alias("_ingested_at"))


def tickers_universe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings: brands and types, repeated per part with different dates."""
    key = F.col("p_partkey")
    listed = table(spark, sf_dir, "part").select(
        F.explode(F.array(brand_symbol(F.col("p_brand")), F.col("p_type"))).alias("s"),
        "p_partkey", "p_size")
    return listed.select(
        F.lower("s").alias("ticker"),
        F.when(F.col("p_size") > 25, "NYSE").otherwise("NASDAQ").alias("exchange"),
        F.when(key % 2 == 0, "Stock").otherwise("ETF").alias("asset_type"),
        F.when(key % 3 == 0, "USD").otherwise("EUR").alias("price_currency"),
        F.date_add(F.lit("1990-01-01").cast("date"), (key % 1000).cast("int")).alias("start_date"),
        F.when(key % 7 != 0, F.date_add(F.lit("2000-01-01").cast("date"), (key % 500).cast("int")))
        .alias("end_date"),
        F.lit("2001-12-28 06:00:00").cast("timestamp").alias("_ingested_at"))


def etf_holdings_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two snapshots per type: parts of size up to 25, then all parts. Each ends with a cash and
    a future line, and the first three lines were loaded before with other weights."""
    first, second = F.lit("2001-06-29").cast("date"), F.lit("2001-09-28").cast("date")
    held = table(spark, sf_dir, "part").select(
        F.explode(F.when(F.col("p_size") <= 25, F.array(first, second)).otherwise(F.array(second)))
        .alias("as_of_date"),
        F.col("p_type").alias("etf_symbol"), "p_brand", cents(F.col("p_retailprice")).alias("c"))
    sheet = Window.partitionBy("etf_symbol", "as_of_date")
    # At most one row per brand and sheet after this aggregate.
    stocks = held.groupBy("etf_symbol", "as_of_date", "p_brand").agg(
        F.sum("c").alias("c"), F.count("*").cast("double").alias("shares_held")).select(
        "etf_symbol", "as_of_date",
        F.row_number().over(sheet.orderBy(F.desc("c"), "p_brand")).alias("position"),
        F.concat(F.replace(F.upper("p_brand"), F.lit("#"), F.lit(" ")), F.lit(" HOLDINGS INC"))
        .alias("holding_name"),
        F.replace(F.upper("p_brand"), F.lit("#"), F.lit(".")).alias("ticker"),
        brand_symbol(F.col("p_brand")).alias("symbol"),
        F.substring(F.sha2("p_brand", 256), 1, 9).alias("identifier"),
        F.substring(F.sha2("p_brand", 256), 10, 7).alias("sedol"),
        (F.lit(100.0) * F.col("c") / F.sum("c").over(sheet)).alias("weight_pct"),
        "shares_held", F.lit("USD").alias("local_currency"))

    def line(offset, name, ticker, symbol, identifier, weight, shares):
        text = lambda v: F.lit(v).cast("string")
        return F.struct(
            (F.col("n") + offset).alias("position"), text(name).alias("holding_name"),
            text(ticker).alias("ticker"), text(symbol).alias("symbol"),
            text(identifier).alias("identifier"), text(None).alias("sedol"),
            F.lit(weight).alias("weight_pct"), F.lit(shares).alias("shares_held"),
            F.lit("USD").alias("local_currency"))

    extra = stocks.groupBy("etf_symbol", "as_of_date").agg(F.max("position").alias("n")).select(
        "etf_symbol", "as_of_date", F.inline(F.array(
            line(1, "US DOLLAR", "-", None, "CASH_USD", 0.5, 1000.0),
            line(2, "INDEX FUTURE DEC01", "IXZ1", "IXZ1", "FUT_IXZ1", -0.02, 3.0))))
    lines = stocks.unionByName(extra).withColumn(
        "_ingested_at", F.date_add("as_of_date", 1).cast("timestamp"))
    stale = lines.filter(F.col("position") <= 3).withColumns({
        "weight_pct": F.col("weight_pct") + 1.0,
        "_ingested_at": F.col("as_of_date").cast("timestamp")})
    return lines.unionByName(stale)


# --- news, quality tables, job runs ------------------------------------------------------

def news_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    published = F.timestamp_seconds(F.lit(1704067200) + F.col("doc_id") * 60)
    return table(spark, sf_dir, "documents").select(
        F.concat(F.lit("a"), F.col("doc_id")).alias("article_id"),
        F.substring("text", 1, 80).alias("title"), F.col("text").alias("description"),
        F.concat(F.lit("https://example.org/"), F.col("doc_id")).alias("url"), "source",
        published.alias("published_date"),
        (published + F.expr("INTERVAL 5 MINUTES")).alias("crawl_date"),
        F.when(F.col("n_chars") > 500, F.array(F.lit("ALL")))
        .otherwise(F.array().cast("array<string>")).alias("tickers"),
        F.array("lang").alias("tags"),
        (published + F.expr("INTERVAL 1 HOUR")).alias("_ingested_at"))


def dq_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per day and one check per event type; the day's mean value decides the status."""
    day = F.to_date("ts")
    stats = table(spark, sf_dir, "events").groupBy(day.alias("d"), "event_type").agg(
        F.count("*").alias("n"), (F.sum(cents(F.col("value"))) / F.count("*") / 100).alias("m"))
    rows = stats.select(
        F.concat(F.lit("run-"), F.date_format("d", "yyyyMMdd")).alias("run_id"),
        (F.col("d").cast("timestamp") + F.expr("INTERVAL 6 HOURS")).alias("check_ts"),
        F.col("event_type").alias("check_name"), F.lit("events").alias("table_name"),
        F.when(F.col("event_type").isin("view", "click"), "warn").otherwise("error")
        .alias("severity"),
        F.when(F.col("m") > 58, "error").when(F.col("m") > 52, "fail").otherwise("pass")
        .alias("status"),
        F.concat(F.col("n"), F.lit(" rows")).alias("message"),
        F.to_json(F.struct(F.col("n").alias("rows"))).alias("observed"))
    return rows.select(*S.DQ_RESULTS.names)


def job_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.col("ts").cast("timestamp")
    size = F.get_json_object("props", "$.k").cast("int")
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("job_name"), F.col("event_id").alias("run_id"),
        start.alias("start_ts"),
        F.when(size < 95, start + F.expr("INTERVAL 5 MINUTES")).alias("end_ts"),
        F.when(size < 40, "FAILED").otherwise("SUCCESS").alias("result_state"))


def bronze(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All bronze tables the models read."""
    makers = (markets_raw, company_prices_raw, macro_raw, quotes_raw, tickers_raw,
              tickers_universe, etf_holdings_raw)
    return {make.__name__: make(spark, sf_dir) for make in makers}
