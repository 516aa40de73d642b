"""Market and macro-economic analytics written as Spark DataFrame jobs."""
