"""The monthly daily run: nights in, ranges, host counts and reports out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomledger.operators.hosts import host_from_ranges, known_hosts
from roomledger.operators.ranges import compress_ranges, unique_nights
from roomledger.operators.routing import enrich_daily, missing_rows, route_daily
from roomledger.session import materialize
from roomledger.sources import tables

NIGHT = ["status", "booked_date", "price", "res_ID"]
DAILY_COLUMNS = [
    "property_ID", "start_date", "end_date", *NIGHT,
    "host_ID", "listing_type", "housing", "country", "region", "city",
]


def daily_ranges(
    routed: DataFrame, property: DataFrame, *, prefer: list[str] = (), break_at_month: bool = False
) -> DataFrame:
    """Active and inactive ranges, told apart by ``route``, with the listing's attributes.

    Both come from one pass: the nights are shuffled once, by listing, for
    the routing join, and that serves the copies, the ranges and the second
    join too. They stay narrow until they are ranges, which are fewer.
    ``prefer`` orders copies of a night, greatest kept.
    """
    keys = ["property_ID", "route"]
    nights = routed.filter(F.col("route") != "error").select(*keys, "date", *prefer, *NIGHT)
    ranges = compress_ranges(unique_nights(nights, keys), keys, NIGHT, break_at_month=break_at_month)
    return enrich_daily(ranges, property).select("route", *DAILY_COLUMNS)


def daily_errors(nights: DataFrame, property: DataFrame) -> DataFrame:
    """The nights set aside, all copies included."""
    routed = route_daily(nights, property, for_ranges=False)
    return routed.filter(F.col("route") == "error").drop("route")


def monthly_daily(nights: DataFrame, property: DataFrame) -> dict[str, DataFrame]:
    """All outputs of a month.

    ``property`` is best a stored table: a hot listing's nights are then split
    in the routing join. Only the ranges are written for reuse. The errors take a second look at
    the delivered nights, which costs less than storing all of them routed.
    """
    ranges = materialize(daily_ranges(route_daily(nights, property), property), "ranges")
    daily = ranges.filter(F.col("route") == "active").drop("route")
    inactive = ranges.filter(F.col("route") == "inactive").drop("route")
    return {
        "daily": daily,
        "daily_inactive": inactive,
        "host": host_from_ranges(daily),
        "host_inactive": host_from_ranges(inactive),
        "error": daily_errors(nights, property),
        "missing_rows": missing_rows(nights),
    }


def store_month(outputs: dict[str, DataFrame], property: DataFrame, root: str, label: str) -> None:
    """Append the four tables, write the two reports, and read the counts back."""
    keys = {"daily": ["property_ID", "start_date"], "daily_inactive": ["property_ID", "start_date"]}
    keys |= {name: ["host_ID", "start_date"] for name in ("host", "host_inactive")}
    for name, order in keys.items():
        rows = outputs[name]
        if name.startswith("host"):
            rows = known_hosts(rows, property)
        rows = materialize(rows, name)
        tables.append_month(rows, f"{root}/{name}", label, order)
        tables.assert_readback(tables.read_table(rows.sparkSession, f"{root}/{name}"), rows, label)
    for name in ("error", "missing_rows"):
        tables.write_quarantine(outputs[name], f"{root}/reports/{name}_{label}")
