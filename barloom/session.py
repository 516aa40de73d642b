"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SESSION_CONF = {
    # Eastern-time columns are derived from UTC instants, so the zone is pinned.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Joins on (parent, day) must hash both columns: by parent alone a big parent is one task.
    "spark.sql.requireAllClusterKeysForCoPartition": "true",
    # Replace only the partitions present in the written frame.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


SHUFFLE_PARTITION_MB = 128


def build_session(app: str = "barloom", master: str | None = None,
                  largest_shuffle_gb: float | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on.

    ``largest_shuffle_gb`` is the biggest exchange the job will run; it sets the number of
    shuffle partitions so that one holds about 128 MB. Adaptive execution then merges what
    turns out small and splits what turns out skewed.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    sized = {} if largest_shuffle_gb is None else {
        "spark.sql.shuffle.partitions": str(
            max(1, round(largest_shuffle_gb * 1024 / SHUFFLE_PARTITION_MB))),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{SHUFFLE_PARTITION_MB}m",
    }
    for key, value in {**SESSION_CONF, **sized, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder every executor can reach.

    Lives under ``spark.checkpoint.dir``. Only a local session, whose executors share this
    machine's disk, may fall back to a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="barloom-")
        spark.sparkContext.setCheckpointDir(root)
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, safe against lost executors, and
    later steps read it instead of repeating its lineage."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
