"""Missing created and scraped dates, from the nights a listing was active."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomledger.functions.joins import keep_in, lookup_join


def first_active(nights: DataFrame) -> DataFrame:
    """First and last night per listing on which it was not unavailable."""
    return (
        nights.filter(F.col("status") != "U")
        .groupBy("property_ID")
        .agg(F.min("date").alias("first_active"), F.max("date").alias("last_active"))
    )


def history_bounds(history: DataFrame, wanted: DataFrame) -> DataFrame:
    """First start and last end of the wanted listings' active history.

    The history is the largest table there is: the few wanted ids are
    broadcast to it while they are few, so it is filtered where it is read.
    """
    active = history.filter(F.col("status") != "U").select("property_ID", "start_date", "end_date")
    active = lookup_join(active, wanted.select("property_ID").distinct(), ["property_ID"], "left_semi")
    return active.groupBy("property_ID").agg(
        F.min("start_date").alias("first_start"), F.max("end_date").alias("last_end")
    )


def fill_created_hist(property: DataFrame, history: DataFrame) -> DataFrame:
    """Missing ``created`` from the first active night in the stored history."""
    bounds = history_bounds(history, property.filter(F.col("created").isNull()))
    filled = property.join(bounds, "property_ID", "left")
    return filled.withColumn("created", F.coalesce("created", "first_start")).select(*property.columns)


def fill_scraped_hist(property: DataFrame, history: DataFrame) -> DataFrame:
    """Missing ``scraped`` from the last active night; listings without either are dropped."""
    bounds = history_bounds(history, property.filter(F.col("scraped").isNull()))
    filled = property.join(bounds, "property_ID", "left")
    filled = filled.withColumn("scraped", F.coalesce("scraped", "last_end")).select(*property.columns)
    return filled.filter(F.col("scraped").isNotNull())


def fill_from_history(property: DataFrame, history: DataFrame) -> DataFrame:
    """fill_created_hist and fill_scraped_hist in one pass over the history."""
    wanted = property.filter(F.col("created").isNull() | F.col("scraped").isNull())
    filled = property.join(history_bounds(history, wanted), "property_ID", "left")
    filled = filled.withColumn("created", F.coalesce("created", "first_start"))
    filled = filled.withColumn("scraped", F.coalesce("scraped", "last_end"))
    return filled.select(*property.columns).filter(F.col("scraped").isNotNull())


def fill_created_new(property: DataFrame, nights: DataFrame) -> DataFrame:
    """Missing ``created`` from the first active night in the new file."""
    filled = property.join(first_active(nights), "property_ID", "left")
    return filled.withColumn("created", F.coalesce("created", "first_active")).select(*property.columns)


def fill_created_backfill(property: DataFrame, nights: DataFrame) -> DataFrame:
    """For listings lacking either date, the first active night *replaces* ``created``."""
    lacking = property.filter(F.col("created").isNull() | F.col("scraped").isNull())
    first = first_active(keep_in(nights, lacking, "property_ID", unique=True))
    filled = property.join(first, "property_ID", "left")
    return filled.withColumn("created", F.coalesce("first_active", "created")).select(*property.columns)
