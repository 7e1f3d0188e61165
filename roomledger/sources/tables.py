"""Stored tables and monthly snapshots on Parquet."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roomledger.functions.joins import upsert
from roomledger.session import materialize

LOCALITY = ["country", "region", "city"]


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A stored table; filters and column choice reach the files."""
    return spark.read.parquet(path)


def read_snapshot(spark: SparkSession, root: str, name: str, label: str) -> DataFrame:
    """One month's saved state, e.g. the location table of ``2020_03``."""
    return spark.read.parquet(f"{root}/{name}/{label}")


def write_snapshot(df: DataFrame, root: str, name: str, label: str) -> str:
    """Save a month's state; a rerun of the month replaces it."""
    path = f"{root}/{name}/{label}"
    df.write.mode("overwrite").parquet(path)
    return path


def _clustered(df: DataFrame, by: list[str], tie_break: list[str]) -> DataFrame:
    """Spread rows by range, so that a large country fills many files and
    each file covers a narrow span that readers can skip."""
    order = [c for c in [*by, *tie_break] if c in df.columns]
    return df.repartitionByRange(*order).sortWithinPartitions(*order) if order else df


def append_month(df: DataFrame, path: str, label: str, keys: list[str]) -> None:
    """Store the whole of a month; a rerun replaces just that month, one without rows empties it.

    Late rows go through ``merge_months``.
    """
    if df.isEmpty():
        # an overwrite of partitions touches none when there is no row
        month = df.sparkSession._jvm.org.apache.hadoop.fs.Path(f"{path}/year_month={label}")
        month.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(month, True)
        return
    stored = _clustered(df, LOCALITY, keys).withColumn("year_month", F.lit(label))
    writer = stored.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("year_month").parquet(path)


def merge_months(df: DataFrame, path: str, day: str, keys: list[str]) -> None:
    """Add late rows to the months that their ``day`` lies in; stored rows of the same keys give way, all others stay.

    Only those months are read and rewritten, from a written copy, so a run
    that dies can be repeated. Months without late rows are not touched.
    """
    late = materialize(df.withColumn("year_month", F.date_format(day, "yyyy_MM")), "late")
    stored = read_months(late, path, months_of(late))
    rows = materialize(upsert(stored, late, *keys, null_safe=True), "merged")
    write_months(rows, path, keys)


def months_of(rows: DataFrame) -> list[str]:
    """The months of rows with ``year_month``: calendar months, a few hundred at most."""
    return sorted(r["year_month"] for r in rows.select("year_month").distinct().collect())


def read_months(like: DataFrame, path: str, months: list[str]) -> DataFrame:
    """The stored rows of some months; none where nothing is stored yet."""
    return read_or_empty(like, path).filter(F.col("year_month").isin(months))


def read_or_empty(like: DataFrame, path: str) -> DataFrame:
    """A stored table, or no rows in the shape of ``like`` where it is not there yet."""
    try:
        return read_table(like.sparkSession, path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return like.limit(0)


def write_months(rows: DataFrame, path: str, keys: list[str]) -> None:
    """Replace the months that ``rows``, a written copy with ``year_month``, has; other months stay."""
    spread = _clustered(rows, ["year_month", *LOCALITY], keys)
    spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year_month").parquet(path)


def replace_table(df: DataFrame, path: str, keys: list[str]) -> None:
    """Drop and rewrite a whole table."""
    _clustered(df, LOCALITY, keys).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def write_quarantine(df: DataFrame, path: str) -> str:
    """Rows set aside, as CSV with a header for people to read; columns that CSV cannot hold are written as JSON."""
    nested = (T.ArrayType, T.StructType, T.MapType)
    flat = df.select(*[F.to_json(c).alias(c) if isinstance(df.schema[c].dataType, nested) else F.col(c) for c in df.columns])
    flat.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    return path


def fingerprint(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row (rows, first, second): the count and two sums of hashes of all rows, whatever their order.

    Rows count as often as they occur. Partial sums combine in the tasks, so
    one row per task is shuffled.
    """
    # a null leaves the hash as it is, so where the nulls are is hashed as well
    parts = [part for c in columns for part in (F.col(c), F.isnull(c))]
    first, second = F.xxhash64(*parts), F.xxhash64(F.lit("second"), *parts)
    return df.agg(
        F.count("*").alias("rows"), F.sum(first.cast("decimal(38,0)")).alias("first"), F.sum(second.cast("decimal(38,0)")).alias("second")
    )


def readback(stored: DataFrame, source: DataFrame, label: str) -> DataFrame:
    """Stored and source rows of a month side by side: year_month, sent, stored, complete.

    ``complete`` says that they are the same rows: as many of them, with the
    same fingerprints. A swapped, changed or missing column shows as a row
    that is lost would.
    """
    columns = [c for c in source.columns if c != "year_month"]
    have = [F.col(c) if c in stored.columns else F.lit(None).cast(source.schema[c].dataType).alias(c) for c in columns]
    found = fingerprint(stored.filter(F.col("year_month") == label).select(*have), columns).alias("found")
    sent = fingerprint(source, columns).alias("sent")
    same = [F.col(f"sent.{c}").eqNullSafe(F.col(f"found.{c}")) for c in ("rows", "first", "second")]
    year_month = F.lit(label).alias("year_month")
    # one row a side
    return sent.withColumn("year_month", year_month).join(found.withColumn("year_month", year_month), "year_month").select(
        "year_month", F.col("sent.rows").alias("sent"), F.col("found.rows").alias("stored"), (same[0] & same[1] & same[2]).alias("complete")
    )


def assert_readback(stored: DataFrame, source: DataFrame, label: str) -> None:
    row = readback(stored, source, label).first()
    if not row["complete"]:
        raise ValueError(f"{label}: {row['sent']} rows sent, {row['stored']} stored, or other ones")
