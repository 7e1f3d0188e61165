"""Region names: subdivision boundaries, coverage by country, and votes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomledger import fixed_values as fixed
from roomledger.functions.columns import (
    is_true,
    not_among,
    null_where,
    region_alias,
    scraped_region_alias,
)
from roomledger.functions.joins import lookup_join
from roomledger.operators.boundaries import NearestSearch, nearest


def compare_regions(property: DataFrame, subdivisions: NearestSearch, scrapes: DataFrame) -> DataFrame:
    """Supplied, geocoded and scraped region side by side.

    For listings of the countries that have subdivision boundaries: polygons
    whose ``layer`` is the country. A listing takes the nearest subdivision,
    which is the one it lies in where there is one.
    """
    listed = property.filter(F.col("country").isin(fixed.SUBDIVIDED_COUNTRIES))
    located = nearest(listed, subdivisions, layer="country")
    located = located.withColumnRenamed("near_name", "region_geo")
    scraped = scrapes.select("property_ID", "region_scrape", "city_scrape")
    compared = located.join(scraped, "property_ID", "left")
    return compared.withColumn("region_scrape", scraped_region_alias(F.col("country"), F.col("region_scrape")))


def mark_agreement(compared: DataFrame) -> DataFrame:
    """Adds ``agrees``: supplied = geocoded, and = scraped where there is a scrape."""
    same_geo = F.col("region") == F.col("region_geo")
    all_same = same_geo & (F.col("region") == F.col("region_scrape"))
    return compared.withColumn("agrees", is_true(all_same | (F.col("region_scrape").isNull() & same_geo)))


def validate_region(marked: DataFrame) -> DataFrame:
    """Adds ``scrape_valid``: disagrees, but lies within reach of the scraped region."""
    within = F.exists(
        "near_hits",
        lambda hit: (hit["layer"] == F.col("country")) & is_true(hit["name"] == F.col("region_scrape")),
    )
    return marked.withColumn("scrape_valid", ~F.col("agrees") & is_true(within))


def settle_region(validated: DataFrame) -> DataFrame:
    """Agreement stays; a valid scrape gives the region and empties the city; else the geocode."""
    region = (
        F.when(F.col("agrees"), F.col("region"))
        .when(F.col("scrape_valid"), F.col("region_scrape"))
        .otherwise(F.col("region_geo"))
    )
    return validated.withColumn("region", region).withColumn("city", null_where(F.col("scrape_valid"), F.col("city")))


def resolve_subdivisions(property: DataFrame, subdivisions: NearestSearch, scrapes: DataFrame) -> DataFrame:
    """Write the settled regions of Canada and the United States back to all listings."""
    compared = compare_regions(property, subdivisions, scrapes)
    settled = settle_region(validate_region(mark_agreement(compared))).select(*property.columns)
    elsewhere = property.filter(not_among(F.col("country"), fixed.SUBDIVIDED_COUNTRIES))
    return elsewhere.unionByName(settled)


def region_coverage(property: DataFrame, threshold: float = 0.0) -> DataFrame:
    """Countries, not whitelisted, where more than the threshold of listings have a region."""
    shares = property.groupBy("country").agg(F.avg(F.col("region").isNotNull().cast("int")).alias("region_pct"))
    return shares.filter(
        (F.col("region_pct") > threshold) & not_among(F.col("country"), fixed.REGION_WHITELIST)
    )


def purge_spurious_regions(property: DataFrame, threshold: float = 0.0) -> DataFrame:
    """Empty region and city of listings with a region in those countries."""
    listed = region_coverage(property, threshold).select("country", F.lit(True).alias("_spurious"))
    marked = lookup_join(property, listed, ["country"], "left", null_safe=True)
    hit = F.col("_spurious").isNotNull() & F.col("region").isNotNull()
    return marked.select(
        *[null_where(hit, F.col(c)).alias(c) if c in ("region", "city") else F.col(c) for c in property.columns]
    )


def harmonize_regions(property: DataFrame) -> DataFrame:
    return property.withColumn("region", region_alias(F.col("country"), F.col("region")))


def region_losers(property: DataFrame) -> DataFrame:
    """(region, country) pairs outnumbered by the same region in another country.

    Counts come first, so a group then has one row per country at most.
    """
    counts = property.filter(F.col("region").isNotNull()).groupBy("region", "country").agg(F.count("*").alias("n"))
    counts = counts.filter(not_among(F.col("region"), fixed.SHARED_REGIONS))
    shared = counts.groupBy("region").agg(F.count("*").alias("countries"), F.max("n").alias("most"))
    shared = shared.filter("countries >= 2")
    return counts.join(shared, "region").filter("n < most").select("region", "country", "n", "most")


def region_country_vote(property: DataFrame) -> DataFrame:
    """Empty region and city where another country holds more listings of the region."""
    losers = region_losers(property).select("region", "country", F.lit(True).alias("_loses"))
    marked = lookup_join(property, losers, ["region", "country"], "left")
    hit = F.col("_loses").isNotNull()
    return marked.select(
        *[null_where(hit, F.col(c)).alias(c) if c in ("region", "city") else F.col(c) for c in property.columns]
    )
