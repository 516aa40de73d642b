"""Running checks, storing results, and reading them back."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom import constants as C
from barloom import schemas as S
from barloom.quality.checks import RESULT_COLUMNS
from barloom.sinks.tables import append_run, replace_run

Check = Callable[[], DataFrame]

def crashed(spark: SparkSession, name: str, error: Exception) -> DataFrame:
    first_line = str(error).strip().split("\n")[0]
    row = (name, "", "error", "error", f"No result, raised {type(error).__name__} ({first_line})", "{}")
    return spark.createDataFrame([row], ", ".join(f"{c} string" for c in RESULT_COLUMNS))


def run_all(spark: SparkSession, checks: Mapping[str, Check], run_id: str, check_ts,
            path: str) -> DataFrame:
    """Evaluate every check and store the run's results, replacing an earlier try.

    Spark writes the rows of each check to the run's slice, however many they are; none pass
    through the driver. A write either adds all rows of its check or none, so a check that fails at
    run time becomes one ``error`` row and cannot take the others with it.
    """
    def stamped(rows: DataFrame) -> DataFrame:
        return rows.select(F.lit(run_id).alias("run_id"), F.lit(check_ts).cast("timestamp").alias("check_ts"),
                           *(F.col(c).cast("string").alias(c) for c in RESULT_COLUMNS))

    replace_run(spark.createDataFrame([], S.DQ_RESULTS), path, run_id)
    for name, check in checks.items():
        try:
            append_run(stamped(check()), path, run_id)
        except Exception as e:  # noqa: BLE001
            append_run(stamped(crashed(spark, name, e)), path, run_id)
    return spark.read.schema(S.DQ_RESULTS).parquet(path).filter(F.col("run_id") == run_id)


def gate(results: DataFrame) -> DataFrame:
    """(run_id, n_errors, n_warnings, passed): a run fails on any non-passing error result."""
    bad = F.col("status") != "pass"
    is_error = F.col("severity") == "error"
    return results.groupBy("run_id").agg(
        F.count_if(bad & is_error).alias("n_errors"),
        F.count_if(bad & ~is_error).alias("n_warnings"),
    ).withColumn("passed", F.col("n_errors") == 0)


def require_passed(results: DataFrame) -> None:
    """Raise when the gate is closed."""
    failed = gate(results).filter(~F.col("passed")).limit(1).collect()
    if failed:
        raise RuntimeError(f"{failed[0]['n_errors']} data quality errors in {failed[0]['run_id']}")


def incident_rollup(results: DataFrame, incidents: DataFrame, created_ts) -> DataFrame:
    """One row per run with failures that is not recorded yet.

    Check names are gathered as a set, which folds map-side and is bounded by the registry.
    """
    return (
        results.filter(F.col("status") != "pass")
        .groupBy("run_id")
        .agg(F.sort_array(F.collect_set("check_name")).alias("failed_checks"),
             F.count_if(F.col("severity") == "error").alias("n_errors"))
        .join(incidents.select("run_id"), "run_id", "left_anti")
        .withColumn("created_ts", F.lit(created_ts).cast("timestamp"))
        .select("run_id", "created_ts", "failed_checks", "n_errors")
    )


def latest_run_results(results: DataFrame) -> DataFrame:
    """Results of the newest run; its id is a scalar subquery, so one partition is read."""
    newest = results.agg(
        F.max(F.struct("check_ts", "run_id")).alias("m")).select("m.run_id").scalar()
    return results.filter(F.col("run_id") == newest)


def pass_rate(results: DataFrame, today, days: int = C.PASS_RATE_DAYS) -> DataFrame:
    """Share of passing results per check over the last days."""
    since = F.date_sub(F.lit(today).cast("date"), days).cast("timestamp")
    return results.filter(F.col("check_ts") >= since).groupBy("check_name").agg(
        F.avg(F.when(F.col("status") == "pass", 1.0).otherwise(0.0)).alias("pass_rate"))


def source_freshness(tables: Mapping[str, DataFrame], now,
                     limits: Mapping[str, tuple] = C.SOURCE_FRESHNESS) -> DataFrame:
    """Age of each source's newest row against its warn and error limits in days."""
    now = F.lit(now).cast("timestamp")
    out = None
    for name, df in tables.items():
        column, warn, error = limits[name]
        age = (F.unix_seconds(now) - F.unix_seconds(F.col("loaded_at"))) / 86400
        status = F.when(F.col("loaded_at").isNull(), "error")
        if error is not None:
            status = status.when(age > error, "error")
        status = status.when(age > warn, "warn").otherwise("pass")
        one = df.agg(F.max(F.col(column).cast("timestamp")).alias("loaded_at")).select(
            F.lit(name).alias("source"), "loaded_at", F.round(age, 6).alias("age_days"),
            status.alias("status"))
        out = one if out is None else out.unionByName(one)
    return out
