"""Session settings and the shared folder for materialised steps."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot listing id is split even where the split costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Joins whose listings' side is small per task need not sort the nights.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


# What one shuffle task should get of the stored input. Rows that are sorted take some 25 times what is shuffled.
TASK_BYTES = 8 * 1024**2
INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
OWN_INITIAL = "roomledger.initialPartitionNum"


def tune(spark: SparkSession, input_bytes: int | None = None) -> SparkSession:
    """Apply the run-time settings the operators count on to a session.

    With the size of the largest input, shuffles start with enough partitions
    for it; adaptive execution joins up those that turn out small. Without it,
    the number that an earlier call set is taken back.
    """
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    own = spark.conf.get(OWN_INITIAL, None)
    if own is not None and spark.conf.get(INITIAL, None) == own:
        spark.conf.unset(INITIAL)
    spark.conf.unset(OWN_INITIAL)
    if input_bytes is not None:
        plain = spark.conf.get(INITIAL, spark.conf.get("spark.sql.shuffle.partitions"))
        wide = str(max(int(plain), -(-input_bytes // TASK_BYTES)))
        spark.conf.set(INITIAL, wide)
        spark.conf.set(OWN_INITIAL, wide)
    return spark


def stored_input(df: DataFrame) -> int:
    """Size of the files a table is read from, without a job; what is not read from files counts as nothing."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(k).stats().sizeInBytes())) for k in range(leaves.size())]
    return sum(size for size in sizes if size < 2**60)


# Steps written by this process and not removed yet.
STEPS: list[str] = []


def remove_steps(spark: SparkSession) -> int:
    """Delete the steps that ``materialize`` has written, at the end of a run: nothing read from them may be used any more."""
    removed = len(STEPS)
    while STEPS:
        path = spark._jvm.org.apache.hadoop.fs.Path(STEPS.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return removed


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the one named in spark.checkpoint.dir.

    Only a session in one process may fall back to a temporary folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="roomledger-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_run_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing is ever overwritten there."""
    return f"{shared_dir(spark).rstrip('/')}/roomledger/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "step") -> DataFrame:
    """Write a step to the shared folder and go on from the written table.

    Cuts the lineage, survives the loss of executors, and gives later plans
    exact file statistics to choose their joins by.
    """
    spark = df.sparkSession
    path = new_run_dir(spark, label)
    STEPS.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
