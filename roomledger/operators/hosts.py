"""How many listings each host has on offer, over time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomledger.functions.columns import is_true
from roomledger.functions.joins import keep_in, keep_not_in, lookup_join
from roomledger.operators.ranges import compress_ranges, sum_over_time

HOST_KEYS = ["host_ID", "listing_type", "housing"]
HOST_COLUMNS = ["host_ID", "start_date", "end_date", "listing_type", "housing", "count"]


def host_counts(nights: DataFrame, keys: list[str] = HOST_KEYS) -> DataFrame:
    """Listings per host, night and kind."""
    return nights.groupBy(*keys, "date").agg(F.count("*").alias("count"))


def ml_counts(nights: DataFrame) -> DataFrame:
    """The earlier form of the host table, which ignores ``housing``, as ranges."""
    keys = ["host_ID", "listing_type"]
    return compress_ranges(host_counts(nights, keys), keys, ["count"])


def host_ranges(nights: DataFrame) -> DataFrame:
    """The host table from nights."""
    return compress_ranges(host_counts(nights), HOST_KEYS, ["count"]).select(*HOST_COLUMNS)


def host_from_ranges(daily: DataFrame) -> DataFrame:
    """The host table from stored daily ranges, each counting one listing."""
    one_each = daily.withColumn("count", F.lit(1))
    return sum_over_time(one_each, HOST_KEYS, "count").select(*HOST_COLUMNS)


def host_merge(host: DataFrame, added: DataFrame) -> DataFrame:
    """Add host counts to the table: all rows of an affected host are summed
    and compressed anew, other hosts stay as they are."""
    affected = keep_in(host, added, "host_ID", null_safe=True)
    redone = sum_over_time(affected.unionByName(added), HOST_KEYS, "count").select(*HOST_COLUMNS)
    return keep_not_in(host, added, "host_ID", null_safe=True).select(*HOST_COLUMNS).unionByName(redone)


def known_hosts(host: DataFrame, property: DataFrame) -> DataFrame:
    """Host rows whose host has a listing; a null host needs a listing without host."""
    return keep_in(host, property, "host_ID", null_safe=True)


def cross_platform_hosts(property: DataFrame) -> DataFrame:
    """HomeAway managers tied to exactly one Airbnb host, for their listings that lack it.

    "Exactly one" is tested by smallest = greatest, which needs no list per
    manager however many listings one has.
    """
    only_homeaway = property.filter(F.col("ab_host").isNull() & F.col("ha_host").isNotNull())
    managers = only_homeaway.select(F.col("host_ID").alias("ha_host"))
    linked = property.filter(F.col("ab_host").isNotNull()).select("ha_host", "ab_host")
    linked = lookup_join(linked, managers.distinct(), ["ha_host"], "left_semi")
    single = (
        linked.groupBy("ha_host")
        .agg(F.min("ab_host").alias("linked_ab_host"), F.max("ab_host").alias("_last"))
        .filter(is_true(F.col("linked_ab_host") == F.col("_last")))
        .drop("_last")
    )
    return lookup_join(property.filter(F.col("ab_host").isNull()), single, ["ha_host"], "inner")
