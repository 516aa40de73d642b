"""Writing tables as parquet folders.

Open-source parquet has no transactions, so each writer is built to be safe to run again:
partition overwrites replace whole partitions, and full overwrites go to a new version folder
that becomes current only once it is complete.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from barloom.operators.merge import insert_only, observed_upsert

LAYERS = ("bronze", "silver", "gold", "ops")


def layer_path(root: str, name: str, layers: Mapping[str, str], default: str = "silver") -> str:
    """Folder of a table: the declared layer, used as is, then the table name."""
    layer = layers.get(name, default)
    if layer not in LAYERS:
        raise ValueError(f"{name}: unknown layer {layer!r}")
    return f"{root.rstrip('/')}/{layer}/{name}"


def read_or_none(spark: SparkSession, path: str, schema: StructType | None = None
                 ) -> DataFrame | None:
    """The stored table, or None before its first load.

    A given schema also fixes the types of partition columns, which are otherwise guessed from
    folder names.
    """
    try:
        stored = spark.read.parquet(path)
        return spark.read.schema(schema).parquet(path) if schema else stored
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


@contextmanager
def _settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


#: Aggregates over partition columns become a scan of folder names; those over numbers and dates
#: are answered from the footers of parquet files.
_FROM_FOLDERS = {"spark.sql.optimizer.metadataOnly": "true"}
_FROM_FOOTERS = {"spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text",
                 "spark.sql.parquet.aggregatePushdown": "true"}


def stored_span(spark: SparkSession, path: str, column: str, in_folders: bool = False) -> Row | None:
    """(oldest, newest) value of a column of a stored table, without reading its rows; None before
    the first load. ``in_folders`` says that the table is partitioned by the column; a folder
    counts even if its files are empty. A column of a type without statistics, such as a
    timestamp, is read."""
    with _settings(spark, _FROM_FOLDERS if in_folders else _FROM_FOOTERS):
        stored = read_or_none(spark, path)
        return None if stored is None else stored.agg(
            F.min(column).alias("oldest"), F.max(column).alias("newest")).first()


def with_docs(df: DataFrame, comments: Mapping[str, str]) -> DataFrame:
    """Attach column comments; parquet and catalog tables keep them."""
    return df.select(*[
        F.col(f.name).alias(f.name, metadata={**f.metadata, "comment": comments[f.name]})
        if f.name in comments else F.col(f.name)
        for f in df.schema.fields
    ])


def publish(df: DataFrame, table: str, path: str, comments: Mapping[str, str],
            table_comment: str) -> None:
    """Store ``df`` at ``path`` as a catalog table with table and column comments."""
    with_docs(df, comments).write.mode("overwrite").option("path", path).saveAsTable(table)
    text = table_comment.replace("\\", "\\\\").replace("'", "\\'")
    df.sparkSession.sql(f"COMMENT ON TABLE {table} IS '{text}'")


def write_version(df: DataFrame, root: str, version: str) -> None:
    """Full overwrite with whatever schema ``df`` has; readers switch when it is complete."""
    df.write.mode("overwrite").parquet(f"{root}/data/{version}")
    df.sparkSession.sql("SELECT 1 AS one").select(
        F.lit(version).alias("version"), F.current_timestamp().alias("written_at"),
    ).write.mode("append").parquet(f"{root}/versions")


def read_version(spark: SparkSession, root: str) -> DataFrame:
    """The newest complete version."""
    newest = spark.read.parquet(f"{root}/versions").agg(
        F.max_by("version", F.struct("written_at", "version")).alias("version")).first()
    return spark.read.parquet(f"{root}/data/{newest['version']}")


def replace_slices(df: DataFrame, path: str, slice_cols: Sequence[str]) -> None:
    """Replace exactly the slices present in ``df``; all others stay. Safe to repeat."""
    # REBALANCE gathers each slice into few files and splits a hot slice over several tasks.
    (
        df.hint("rebalance", *slice_cols)
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*slice_cols).parquet(path)
    )


def replace_runs(results: DataFrame, path: str) -> None:
    """Results of every run in ``results`` replace that run's earlier rows."""
    replace_slices(results, path, ["run_id"])


def _run_folder(path: str, run_id: str) -> str:
    return f"{path}/run_id={quote(run_id, safe='')}"


def append_run(results: DataFrame, path: str, run_id: str) -> None:
    """More results of one run: all rows or, if it fails, none."""
    results.drop("run_id").write.mode("append").parquet(_run_folder(path, run_id))


def replace_run(results: DataFrame, path: str, run_id: str) -> None:
    """Results of one run replace its earlier rows, also when there are none this time."""
    folder = _run_folder(path, run_id)
    results.filter(F.col("run_id") == run_id).drop("run_id").write.mode("overwrite").parquet(folder)


def swap_slices(spark: SparkSession, path: str, slice_cols: Sequence[str], staging: str,
                make: Callable[[], DataFrame]) -> None:
    """Write the rows of ``make`` whole to ``staging``, then swap their slices in.

    If a swap is cut short, calling again with the same ``staging`` only repeats the swap.
    """
    rows, done = f"{staging}/rows", f"{staging}/done"
    if read_or_none(spark, done) is None:
        make().write.mode("overwrite").parquet(rows)
        spark.range(1).write.mode("overwrite").parquet(done)
    replace_slices(spark.read.parquet(rows), path, slice_cols)


#: Slices that a batch may name one by one in the scan of the stored table.
NAMED_SLICES = 1000


def stored_slices(stored: DataFrame, rows: DataFrame, slice_cols: Sequence[str]) -> DataFrame:
    """Rows of ``stored`` in the slices that ``rows`` has, read from those slices only.

    The semi join alone does not reach the scan. The range of each slice column does, and so do
    the slices themselves unless a batch touches very many; both only narrow the scan.
    """
    touched = rows.select(*slice_cols).distinct()
    named = touched.limit(NAMED_SLICES + 1).collect()
    for c in slice_cols:
        values = [r[c] for r in named]
        if len(values) <= NAMED_SLICES:
            wanted = F.col(c).isin({v for v in values if v is not None})
            stored = stored.filter(wanted | F.col(c).isNull() if None in values else wanted)
        else:
            ends = rows.agg(F.min(c).alias("low"), F.max(c).alias("high"), F.count_if(F.col(c).isNull()).alias("n"))
            pick = lambda name: ends.select(name).scalar()
            stored = stored.filter(F.col(c).between(pick("low"), pick("high"))
                                   | (F.col(c).isNull() & (pick("n") > 0)))
    same = [stored[c].eqNullSafe(touched[c]) for c in slice_cols]
    return stored.join(touched, same, "left_semi")


def merge_slices(spark: SparkSession, path: str, incoming: DataFrame, slice_cols: Sequence[str],
                 merge: Callable[[DataFrame, DataFrame], DataFrame], staging: str) -> None:
    """Merge rows into a partitioned table, reading and rewriting only the slices they touch.

    The slice columns must be functions of the merge key, so a key never moves between slices.
    Incoming rows are staged first, so that finding their slices does not compute them again.
    """
    def make() -> DataFrame:
        incoming.write.mode("overwrite").parquet(f"{staging}/incoming")
        rows = spark.read.schema(incoming.schema).parquet(f"{staging}/incoming")
        stored = read_or_none(spark, path, incoming.schema)
        if stored is None:
            return merge(rows.limit(0), rows)
        return merge(stored_slices(stored.select(*incoming.columns), rows, slice_cols), rows)

    swap_slices(spark, path, slice_cols, staging, make)


def upsert_slices(spark: SparkSession, path: str, incoming: DataFrame, keys: Sequence[str],
                  slice_cols: Sequence[str], staging: str,
                  change_cols: Sequence[str] | None = None) -> dict[str, int]:
    """Merge rows by key; gives the numbers of rows inserted, updated and kept in the touched
    slices, counted while they are written. A repeat that only repeats the swap gives none."""
    seen = []

    def merge(old: DataFrame, new: DataFrame) -> DataFrame:
        rows, counts = observed_upsert(old, new, keys, change_cols)
        seen.append(counts)
        return rows

    merge_slices(spark, path, incoming, slice_cols, merge, staging)
    return dict(seen[0].get) if seen else {}


def insert_slices(spark: SparkSession, path: str, incoming: DataFrame, keys: Sequence[str],
                  slice_cols: Sequence[str], staging: str) -> None:
    merge_slices(spark, path, incoming, slice_cols,
                 lambda old, new: insert_only(old, new, keys), staging)
