"""The macro indicator reference rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from barloom import schemas as S

# --- fixed values: (series, name, category, frequency, units, description, why it matters) --
INDICATORS = (
    ("CPIAUCSL", "Consumer prices, all urban consumers", "inflation", "monthly", "index",
     "Price level of a basket that city households buy.",
     "The usual \"headline\" inflation number; its yearly change steers rate expectations."),
    ("UNRATE", "Unemployment rate", "labor", "monthly", "percent",
     "People looking for work as a share of the labor force.",
     "Turns up early when the economy weakens."),
    ("FEDFUNDS", "Effective federal funds rate", "rates", "monthly", "percent",
     "Average rate of overnight loans between banks.",
     "The rate the central bank steers; other borrowing costs follow."),
    ("DGS10", "Treasury yield, 10 years", "rates", "daily", "percent",
     "Market yield of ten-year government debt.",
     "Anchor for mortgages and long corporate loans."),
    ("DGS2", "Treasury yield, 2 years", "rates", "daily", "percent",
     "Market yield of two-year government debt.",
     "Follows the expected policy rate."),
    ("T10Y2Y", "Treasury spread, 10 less 2 years", "rates", "daily", "percent",
     "Ten-year yield minus two-year yield.",
     "Below zero the curve is \"inverted\", which has often come before a recession."),
    ("GDP", "Gross domestic product", "growth", "quarterly", "usd_bn",
     "Value of all goods and services produced.",
     "The widest measure of growth."),
    ("UMCSENT", "Consumer sentiment", "sentiment", "monthly", "index",
     "Survey index of how households see their finances and the economy.",
     "Leads consumer spending."),
)


def indicator_seed(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(INDICATORS), S.SEED_INDICATOR)
