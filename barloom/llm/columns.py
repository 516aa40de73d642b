"""Adding computed columns to a frame, one Arrow batch at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Rows handed to a batch function at a time, so that Python objects of few texts are alive at once.
ROWS_AT_ONCE = 128


def carried(df: DataFrame, added: Sequence[str], keep: Sequence[str] | None) -> list[str]:
    """The input columns that stay: ``keep`` or all, without those that an added one replaces."""
    taken = {name.lower() for name in added}
    return [c for c in (df.columns if keep is None else keep) if c.lower() not in taken]


def with_package(df: DataFrame) -> DataFrame:
    """``df`` itself, in a session whose Python workers look for this package where the driver
    found it. Where it is installed on the executors anyway this changes nothing."""
    df.sparkSession.sparkContext.environment.setdefault(
        "PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    return df


def add_columns(df: DataFrame, text: str, added: str,
                make: Callable[[], Callable[[list], Iterable[tuple]]],
                keep: Sequence[str] | None = None) -> DataFrame:
    """``df`` with the columns of the DDL string ``added``, computed from the column ``text``.

    ``make`` is called once per task and returns a function from a list of texts (a null is
    None) to one tuple per text. An input column with the name of an added one is replaced.
    """
    new = StructType.fromDDL(added)
    stay = carried(df, new.fieldNames(), keep)
    schema = StructType([df.schema[c] for c in stay] + list(new.fields))
    # The text travels under its own name, whatever the other columns are called.
    frame = with_package(df).select(F.col(text).alias("__text"), *stay)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make()
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(start, ROWS_AT_ONCE)
                rows = list(compute(batch.column(0).to_pylist()))
                made = [pa.array([r[k] for r in rows], _arrow(f.dataType))
                        for k, f in enumerate(new.fields)]
                yield pa.RecordBatch.from_arrays(batch.columns[1:] + made, names=schema.fieldNames())
        pa.default_memory_pool().release_unused()  # the worker lives on

    return frame.mapInArrow(run, schema)


def _arrow(kind):
    return {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(),
            "boolean": pa.bool_(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32()), "array<bigint>": pa.list_(pa.int64()),
            "array<string>": pa.list_(pa.string()), "array<binary>": pa.list_(pa.binary())}[kind.simpleString()]
