"""Quality gates: which rows go on, which are set aside and where."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roomledger.functions.columns import has_platform_prefix, is_true
from roomledger.session import stored_input, tune

LISTING_ATTRIBUTES = ["host_ID", "listing_type", "housing", "country", "region", "city"]


def route_property(property: DataFrame) -> DataFrame:
    """Adds ``route``: error before missing_geography before clean."""
    faulty = F.col("property_ID").isNull() | F.col("listing_type").isNull()
    if "parse_error" in property.columns:
        faulty = F.col("parse_error") | faulty
    faulty = faulty | ~has_platform_prefix(F.col("property_ID"))
    nowhere = F.col("latitude").isNull() | F.col("longitude").isNull()
    return property.withColumn(
        "route", F.when(is_true(faulty), "error").when(nowhere, "missing_geography").otherwise("clean")
    )


def route_daily(nights: DataFrame, property: DataFrame, *, for_ranges: bool = True) -> DataFrame:
    """Adds ``route``: error, inactive or active. Every night gets exactly one.

    error: no id, date or status, a parse fault, or an unknown listing.
    inactive: status U, or outside the listing's created..scraped dates.
    With ``for_ranges`` the join shuffles both sides once on the listing, and
    what follows on the listing (unique_nights, compress_ranges) needs no
    further shuffle. A broadcast would save nothing there, as those steps
    would shuffle the nights, and twice; the shuffle is as wide as the nights
    are large, as its tasks hold what they sort. Without it, Spark may broadcast.
    """
    if for_ranges:
        tune(nights.sparkSession, stored_input(nights))
    listings = property.select("property_ID", "created", "scraped", F.lit(True).alias("_known"))
    faulty = F.col("property_ID").isNull() | F.col("date").isNull() | F.col("status").isNull()
    if "parse_error" in nights.columns:
        faulty = F.col("parse_error") | faulty
    faulty = faulty | F.col("_known").isNull()
    outside = (F.col("date") < F.col("created")) | (F.col("date") > F.col("scraped"))
    inactive = (F.col("status") == "U") | is_true(outside)
    listings = listings.hint("merge") if for_ranges else listings
    routed = nights.join(listings, "property_ID", "left").withColumn(
        "route", F.when(faulty, "error").when(inactive, "inactive").otherwise("active")
    )
    return routed.select(*nights.columns, "route")


def enrich_daily(ranges: DataFrame, property: DataFrame) -> DataFrame:
    """Listing attributes onto nights or ranges."""
    return ranges.join(property.select("property_ID", *LISTING_ATTRIBUTES), "property_ID", "left")


def missing_rows(nights: DataFrame) -> DataFrame:
    """Listings with dates missing from the span they cover (``gaps``) or with dates given more than once (``copies``).

    The two are counted apart, so that copies hide no gap.
    """
    per_date = nights.filter("property_ID IS NOT NULL").groupBy("property_ID", "date").agg(F.count("date").alias("n"))
    per_listing = per_date.groupBy("property_ID").agg(
        F.sum("n").alias("count"), F.count("date").alias("_dates"),
        (F.datediff(F.max("date"), F.min("date")) + 1).cast("long").alias("full_count"),
    )
    gaps, copies = (F.col("full_count") - F.col("_dates")).alias("gaps"), (F.col("count") - F.col("_dates")).alias("copies")
    return per_listing.select("property_ID", "count", "full_count", gaps, copies).filter("gaps > 0 OR copies > 0")


def fault_reason(columns: list[str]) -> Column:
    """Why a night is set aside, for nights known to be."""
    reason = F.when(F.col("property_ID").isNull(), "no listing id").when(F.col("date").isNull(), "no date")
    reason = reason.when(F.col("status").isNull(), "no status")
    if "parse_error" in columns:
        reason = F.when(F.col("parse_error"), "text of the wrong type").otherwise(reason)
    return F.coalesce(reason, F.lit("unknown listing"))


def split_status(daily: DataFrame, daily_inactive: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Move ranges of status U from the active to the inactive table."""
    moved = daily.filter(F.col("status") == "U")
    return daily.filter(F.col("status") != "U"), daily_inactive.unionByName(moved)


def duplicates(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once, with their number."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def assert_unique(df: DataFrame, *keys: str) -> None:
    repeated = duplicates(df, *keys).take(5)
    if repeated:
        raise ValueError(f"repeated keys {keys}, for example {repeated}")


def rowcount_change(before: DataFrame, after: DataFrame) -> DataFrame:
    """Row counts before and after a join that should change nothing."""
    counted = before.select(F.lit(1).alias("b"), F.lit(0).alias("a")).unionByName(
        after.select(F.lit(0).alias("b"), F.lit(1).alias("a"))
    )
    total = counted.agg(
        F.coalesce(F.sum("b"), F.lit(0)).cast("long").alias("rows_before"),
        F.coalesce(F.sum("a"), F.lit(0)).cast("long").alias("rows_after"),
    )
    return total.withColumn("unchanged", F.col("rows_before") == F.col("rows_after"))


def assert_rowcount(before: DataFrame, after: DataFrame) -> None:
    row = rowcount_change(before, after).first()
    if not row["unchanged"]:
        raise ValueError(f"{row['rows_before']} rows before the join, {row['rows_after']} after")
