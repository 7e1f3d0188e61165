"""The monthly property run: listings in, a located property table out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roomledger import fixed_values as fixed
from roomledger.functions.columns import clean_title, country_alias, derive_host_id, derive_housing
from roomledger.operators import boundaries, geocode, hulls, locations, regions, routing, scrapes
from roomledger.operators.dates import fill_created_new, fill_from_history
from roomledger.session import materialize
from roomledger.sources import tables

LOCATION = ["property_ID", "latitude", "longitude", "country", "region", "city"]


@dataclass
class LastMonth:
    """State carried over: locations, known regions, scrapes, hulls, history."""

    location_table: DataFrame
    region_list: DataFrame
    scrapes: DataFrame
    region_hulls: DataFrame
    history: DataFrame


STATE = ["location_table", "region_list", "scrapes", "region_hulls"]


def save_month(state: dict[str, DataFrame], root: str, label: str) -> None:
    """Keep what the next month starts from, the tables ``STATE``, as the month's snapshot; a rerun replaces it."""
    for name in STATE:
        tables.write_snapshot(state[name], root, name, label)


def load_month(spark: SparkSession, root: str, label: str, history: DataFrame) -> LastMonth:
    """The state that ``save_month`` kept for a month, with the stored ranges as history."""
    return LastMonth(**{name: tables.read_snapshot(spark, root, name, label) for name in STATE}, history=history)


@dataclass
class Boundaries:
    """Stored grid indexes of the boundary sets; build them once per set."""

    countries: boundaries.GridIndex
    subdivisions: boundaries.NearestSearch


def index_boundaries(
    countries: DataFrame,
    alternatives: DataFrame,
    subdivisions: DataFrame,
    *,
    cell: float = boundaries.CELL,
) -> Boundaries:
    """Indexes of two raw country sets and of the subdivisions (layer = country)."""
    main = boundaries.country_boundaries(countries)
    second = boundaries.alternative_boundaries(alternatives, main)
    index = geocode.geocode_index(main, second, cell=cell)
    return Boundaries(index, boundaries.nearest_search(subdivisions, cell=cell))


def clean_property(delivered: DataFrame) -> dict[str, DataFrame]:
    """Routes a delivered file and derives the clean columns: property, error, missing_geography.

    The parsed file is written once, as three outputs hang off it.
    """
    routed = materialize(routing.route_property(delivered), "delivered")
    clean = routed.filter(F.col("route") == "clean").drop("route", "parse_error")
    clean = (
        clean.withColumn("listing_title", clean_title(F.col("listing_title")))
        .withColumn("host_ID", derive_host_id(F.col("ab_host"), F.col("ha_host")))
        .withColumn("housing", derive_housing(F.col("property_type")))
        .withColumn("country", country_alias(F.col("country"), F.col("region")))
    )
    return {
        "property": clean.select(*fixed.PROPERTY_TABLE),
        "error": routed.filter(F.col("route") == "error").drop("route"),
        "missing_geography": routed.filter(F.col("route") == "missing_geography").drop("route"),
    }


def prepare_property(
    property: DataFrame, new_nights: DataFrame, last: LastMonth, label: str
) -> dict[str, DataFrame]:
    """Fills dates and splits into listings whose location is kept and those to look at.

    Also the grown region list and the scrape worklist. The filled table is
    written once: four outputs hang off it.
    """
    filled = fill_created_new(fill_from_history(property, last.history), new_nights)
    filled = materialize(filled, "filled")
    new = locations.new_regions(filled, last.region_list)
    recent = locations.new_scrapes(last.scrapes, label)
    kept = materialize(locations.reuse_location(filled, last.location_table, new, recent), "kept")
    check = locations.needs_check(filled, kept)
    return {
        "kept": kept,
        "check": check,
        "region_list": locations.grown_region_list(last.region_list, new),
        "worklist": locations.scrape_worklist(check, last.scrapes, label),
    }


def locate_property(
    check: DataFrame, last: LastMonth, maps: Boundaries, new_scrapes: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Country and region for the listings to look at, the refreshed hulls, and the scrapes to carry over.

    This month's scrapes replace earlier ones before countries are compared;
    scrapes without a result take no part.
    """
    merged = last.scrapes if new_scrapes is None else materialize(scrapes.merge_scrapes(last.scrapes, new_scrapes), "merged-scrapes")
    single = materialize(scrapes.single_scrape(merged.filter(F.col("raw").isNotNull())), "scrapes")
    points = boundaries.with_xy(check)
    placed = materialize(geocode.locate_countries(points, maps.countries, single), "countries")
    routing.assert_rowcount(check, placed)
    placed = regions.resolve_subdivisions(placed, maps.subdivisions, single)
    placed = regions.harmonize_regions(regions.purge_spurious_regions(materialize(placed, "regions")))
    placed = regions.region_country_vote(materialize(placed, "harmonized"))
    placed = materialize(placed, "voted")
    refreshed = materialize(hulls.refresh_hulls(placed, last.region_hulls), "hulls")
    placed = hulls.region_from_hull(placed, refreshed, cell=maps.countries.cell).drop("x", "y")
    return {"property": placed, "region_hulls": refreshed, "scrapes": merged}


def finish_property(kept: DataFrame, located: DataFrame) -> dict[str, DataFrame]:
    """The month's property table, unique by listing, and its location table."""
    property = materialize(kept.unionByName(located, allowMissingColumns=True), "property")
    routing.assert_unique(property, "property_ID")
    return {"property": property, "location_table": property.select(*LOCATION)}
