"""Which listings keep last month's location, and which are looked at again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomledger.functions.columns import is_airbnb, month_28th, month_start, next_month_start
from roomledger.functions.joins import keep_not_in, lookup_join


def new_regions(property: DataFrame, region_list: DataFrame) -> DataFrame:
    """Listings whose supplied region is not on the list yet."""
    named = property.filter(F.col("region").isNotNull())
    return lookup_join(named, region_list.select("region").distinct(), ["region"], "left_anti")


def grown_region_list(region_list: DataFrame, new: DataFrame) -> DataFrame:
    return region_list.select("region").union(new.select("region")).distinct()


def new_scrapes(scrapes: DataFrame, label: str) -> DataFrame:
    """Airbnb listings scraped since the month's last delivery was processed."""
    since = next_month_start(F.lit(label))
    return scrapes.filter(is_airbnb(F.col("property_ID")) & (F.col("date") >= since))


def reuse_location(
    property: DataFrame, location_table: DataFrame, new: DataFrame, scraped: DataFrame
) -> DataFrame:
    """Listings with exactly last month's coordinates take last month's location.

    Not those with a new region or a new scrape.
    """
    unchanged = keep_not_in(property, new, "property_ID")
    unchanged = keep_not_in(unchanged, scraped, "property_ID")
    kept = [c for c in property.columns if c not in ("country", "region", "city")]
    located = unchanged.select(*kept).join(location_table, ["property_ID", "latitude", "longitude"])
    return located.select(*property.columns)


def needs_check(property: DataFrame, fixed: DataFrame) -> DataFrame:
    return keep_not_in(property, fixed, "property_ID")


def scrape_worklist(property: DataFrame, scrapes: DataFrame, label: str) -> DataFrame:
    """Listings without a scrape since the 28th, new ones first.

    A null ``created`` is not known to be new, hence priority 2.
    """
    recent = scrapes.filter(F.col("date") >= month_28th(F.lit(label)))
    pool = keep_not_in(property, recent, "property_ID")
    is_new = F.col("created") >= month_start(F.lit(label))
    return pool.withColumn("priority", F.when(is_new, 1).otherwise(2))
