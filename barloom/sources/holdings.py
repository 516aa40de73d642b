"""Fund holdings sheets, landed as (etf_symbol, sheet, row_no, cells); sheet is the file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom import constants as C
from barloom.functions.columns import clean_text, to_symbol
from barloom.sources.payloads import _stamp


def _cell(i: int) -> Column:
    return F.get("cells", F.lit(i))


#: What tells sheets apart: the fund and the landed file.
SHEET = ["etf_symbol", "sheet"]


def _read(sheets: DataFrame) -> DataFrame:
    """Sheet rows with what their sheet says: ``reason`` it cannot be loaded for, or null, and
    whether the row ``is_line`` of its holdings: below the header, above the first blank row.

    All of it comes from windows over the sheet, which share one exchange.
    """
    first, w = clean_text(_cell(0)), Window.partitionBy(*SHEET)

    def label(text: str) -> Column:
        in_block = (F.col("row_no") < C.HOLDINGS_META_ROWS) & (first == text)
        return F.max(F.when(in_block, clean_text(_cell(1)))).over(w)

    names = F.transform(F.slice("cells", 1, len(C.HOLDINGS_COLUMNS)), clean_text)
    header = F.when(first == C.HOLDINGS_COLUMNS[0], F.col("row_no"))
    told = sheets.withColumns({
        "file_symbol": label("Ticker Symbol:"),
        "as_of_date": F.try_to_date(F.trim(F.replace(
            label("Holdings:"), F.lit("As of"), F.lit(""))), "dd-MMM-yyyy"),
        "header_at": F.min(header).over(w),
        "names": F.min_by(F.when(header.isNotNull(), names), header).over(w),
    })
    below = F.col("row_no") > F.col("header_at")
    ended = told.withColumn("ends_at", F.min(F.when(below & first.isNull(), F.col("row_no"))).over(w))
    line = F.coalesce(below & (F.col("ends_at").isNull() | (F.col("row_no") < F.col("ends_at"))), F.lit(False))
    counted = ended.withColumn("is_line", line).withColumns({
        "n_lines": F.count_if("is_line").over(w),
        "n_bad": F.count_if(F.col("is_line") & (_bad_number(4) | _bad_number(6))).over(w)})
    expected = F.array(*[F.lit(c) for c in C.HOLDINGS_COLUMNS])
    return counted.withColumn(
        "reason",
        F.when(~F.col("file_symbol").eqNullSafe(F.col("etf_symbol")), "other fund in file")
        .when(F.col("as_of_date").isNull(), "no as-of date")
        .when(F.col("header_at").isNull(), "no header row")
        .when(~F.col("names").eqNullSafe(expected), "unexpected columns")
        .when(F.col("n_lines") == 0, "no holding lines")
        .when(F.col("n_bad") > 0, "bad number"))


def _bad_number(i: int) -> Column:
    return clean_text(_cell(i)).isNotNull() & clean_text(_cell(i)).try_cast("double").isNull()


def holdings_rejects(sheets: DataFrame) -> DataFrame:
    """(etf_symbol, sheet, reason) per sheet that cannot be loaded. Other sheets still load."""
    return _read(sheets).filter(F.col("reason").isNotNull()).select(*SHEET, "reason").distinct()


def parse_holdings(sheets: DataFrame, loaded_at=None) -> DataFrame:
    """Holding lines of every sheet with the expected layout, numbered from 1."""
    return _read(sheets).filter(F.col("is_line") & F.col("reason").isNull()).select(
        "etf_symbol", "as_of_date",
        (F.col("row_no") - F.col("header_at")).cast("int").alias("position"),
        clean_text(_cell(0)).alias("holding_name"),
        clean_text(_cell(1)).alias("ticker"),
        to_symbol(clean_text(_cell(1))).alias("symbol"),
        clean_text(_cell(2)).alias("identifier"),
        clean_text(_cell(3)).alias("sedol"),
        clean_text(_cell(4)).try_cast("double").alias("weight_pct"),
        clean_text(_cell(6)).try_cast("double").alias("shares_held"),
        clean_text(_cell(7)).alias("local_currency"),
        _stamp(loaded_at),
    )
