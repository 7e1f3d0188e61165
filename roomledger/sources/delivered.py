"""Delivered CSV files: finding the month's delivery and reading it by type."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roomledger import fixed_values as fixed
from roomledger.functions.columns import is_true
from roomledger.sources.records import read_split

PROPERTY_PREFIX = "All_Property_Match_"
DAILY_PREFIX = "All_1Month_Daily_Match_"


def find_delivery(spark: SparkSession, folder: str, prefix: str, label: str) -> str | None:
    """Path of the latest delivery dated in the month ``YYYY_MM``, or None.

    Only file names are listed. A delivery is a file or a folder of parts
    named ``<prefix>YYYY-MM-DD...``; where the month has several, the latest
    date wins.
    """
    month = label.replace("_", "-")
    pattern = rf"^(.*/{prefix}\d{{4}}-\d{{2}}-\d{{2}}[^/]*)"
    try:
        listed = spark.read.format("binaryFile").load(f"{folder}/{prefix}{month}-*")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return listed.select(F.max(F.regexp_extract("path", pattern, 1))).first()[0]


DATE = r"^\d{4}-\d{2}-\d{2}$"
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def _typed(text: Column, kind: str) -> Column:
    """A supplied text as its type; null where it is no such value."""
    if kind == "date":
        return F.when(text.rlike(DATE), text.try_cast("date"))
    if kind == "double":
        return F.when(text.rlike(NUMBER), text.try_cast("double"))
    if kind == "boolean":
        return F.when(text.isin(fixed.TRUE_WORDS), True).when(text.isin(fixed.FALSE_WORDS), False)
    return text


def _faulty(text: Column, kind: str) -> Column:
    """Whether a text is there but no value of its type.

    Worded otherwise than ``_typed`` on purpose: filters that repeat the
    expressions of many columns make the optimizer derive a predicate for
    every combination of them.
    """
    tests = {
        "date": ~text.rlike(DATE) | text.try_cast("date").isNull(),
        "double": ~text.rlike(NUMBER),
        "boolean": ~text.isin(fixed.TRUE_WORDS + fixed.FALSE_WORDS),
    }
    return text.isNotNull() & is_true(tests[kind])


def _apply_types(text: DataFrame, columns: list[tuple[str, str, str]]) -> DataFrame:
    """Typed clean columns without blanks around them, and ``parse_error`` for rows with a text of the wrong type.

    ``faulty_texts`` keeps those texts as ``column=text``, null without any.
    Rows that are merely short have nulls there and are no parse error.
    """
    typed, faults, texts = [], [], []
    for raw, name, kind in columns:
        cell = F.nullif(F.btrim(F.col(f"`{raw}`"), F.lit(" \t")), F.lit(""))
        typed.append(_typed(cell, kind).alias(name))
        if kind != "string":
            faults.append(_faulty(cell, kind))
            texts.append(F.when(faults[-1], F.concat(F.lit(f"{name}="), cell)))
    return text.select(
        *typed, F.array_contains(F.array(*faults), True).alias("parse_error"),
        F.nullif(F.concat_ws("; ", *texts), F.lit("")).alias("faulty_texts"),
    )


def read_property(spark: SparkSession, path: str, *, multi_line: bool = True) -> DataFrame:
    """The property file: 35 of its columns, found by name, with ``parse_error``.

    Titles may hold line breaks; files of any size are read in many tasks all
    the same (see ``read_split``). Without such breaks and with ``multi_line``
    off they are read once instead of twice. All parts must have the same header.
    """
    options = {"escape": '"', "nullValue": "NA", "emptyValue": ""}
    if multi_line:
        text = read_split(spark, path, options)
    else:
        # Parts whose header differs from the first one's are an error, not read by place.
        text = spark.read.options(**options).option("header", True).option("enforceSchema", False).csv(path)
    return _apply_types(text, fixed.PROPERTY_COLUMNS)


def read_daily(spark: SparkSession, path: str, *, header: bool = True) -> DataFrame:
    """The daily file: six of its ten columns, found by position, with ``parse_error``."""
    names = [raw for raw, _, _ in fixed.DAILY_COLUMNS]
    schema = ", ".join(f"`{name}` string" for name in names)
    reader = spark.read.schema(schema).option("header", header).option("enforceSchema", True)
    text = reader.option("escape", '"').option("nullValue", "NA").option("emptyValue", "").csv(path)
    kept = ("property_ID", "date", "status", "booked_date", "price", "res_ID")
    return _apply_types(text, [c for c in fixed.DAILY_COLUMNS if c[1] in kept])


def read_daily_minimum(spark: SparkSession, path: str) -> DataFrame:
    """The three daily columns that date filling needs."""
    return read_daily(spark, path).select("property_ID", "date", "status")


def read_backlog(spark: SparkSession, path: str) -> DataFrame:
    """Quarantined nights written by ``write_quarantine``, typed again.

    What was a fault stays one: ``parse_error`` and ``faulty_texts`` come back.
    """
    text = spark.read.option("header", True).option("escape", '"').csv(path)
    kinds = {name: kind for _, name, kind in fixed.DAILY_COLUMNS}
    columns = [(c, c, kinds[c]) for c in ("property_ID", "date", "status", "booked_date", "price", "res_ID")]
    if "faulty_texts" not in text.columns:
        return _apply_types(text, columns)
    kept = text.withColumn("_kept", F.nullif(F.col("faulty_texts"), F.lit("")))
    typed = _apply_types(kept, [*columns, ("_kept", "_kept", "string")])
    return typed.withColumn("parse_error", F.col("parse_error") | F.col("_kept").isNotNull()).withColumn(
        "faulty_texts", F.coalesce("_kept", "faulty_texts")).drop("_kept")


def parse_errors(delivered: DataFrame) -> DataFrame:
    return delivered.filter("parse_error")
