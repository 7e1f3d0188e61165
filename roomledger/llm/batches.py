"""Arrow batches of bounded size for work inside tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

ROWS = 500  # long texts must not add up to much in one batch


def map_batches(
    df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType | str
) -> DataFrame:
    """``mapInArrow`` with at most ``ROWS`` rows a batch; an empty table gives an empty result of the schema."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS)
    return df.mapInArrow(work, schema)


def shuffle_width(spark: SparkSession) -> int:
    """Partitions that a shuffle starts with in this session."""
    plain = spark.conf.get("spark.sql.shuffle.partitions")
    return max(int(plain), int(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", plain)))
