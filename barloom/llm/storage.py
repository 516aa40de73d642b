"""Results of a step, kept in the shared folder while the files that made them go."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql.conf import RuntimeConfig

from barloom.session import scratch_dir

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def _settings(conf: RuntimeConfig, values: dict[str, str]) -> Iterator[None]:
    before = {key: conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            conf.unset(key) if value is None else conf.set(key, value)


def _write(df: DataFrame, label: str, arrow_rows: int | None = None) -> tuple[str, DataFrame]:
    spark, path = df.sparkSession, scratch_dir(df.sparkSession, label)
    with _settings(spark.conf, {CLEANUP: "true"} | ({ARROW_ROWS: str(arrow_rows)} if arrow_rows else {})):
        df.write.parquet(path)
    return path, spark.read.schema(df.schema).parquet(path)


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table under ``spark.checkpoint.dir``, read back.

    Later steps read the table, so the shuffle files behind it are given up as soon as it is
    there. A lost executor costs a repeat of tasks, never of the steps before.
    """
    return _write(df, label)[1]


@contextmanager
def workspace(arrow_rows: int | None = None) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """A function like ``stored`` whose tables are emptied at the end of the block. What is to
    outlive the block must be stored with ``stored`` inside it. Python functions behind its tables
    get at most ``arrow_rows`` rows at a time, if given."""
    paths: list[str] = []
    spark = None

    def put(df: DataFrame, label: str) -> DataFrame:
        nonlocal spark
        spark = df.sparkSession
        path, table = _write(df, label, arrow_rows)
        paths.append(path)
        return table

    try:
        yield put
    finally:
        for path in paths:
            spark.range(0).write.mode("overwrite").parquet(path)
