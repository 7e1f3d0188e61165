"""A country for every listing: the cascade of passes, and its reconciliation
with the scraped country."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roomledger import fixed_values as fixed
from roomledger.functions.columns import country_exception, is_true, null_where
from roomledger.operators.boundaries import CELL, GridIndex, boundary_index, locate

MAIN, ALTERNATIVE = "main", "alternative"


def geocode_index(
    countries: DataFrame, alternatives: DataFrame, *, cell: float = CELL, reach: float = fixed.REACH
) -> GridIndex:
    """One stored index over both boundary sets, told apart by ``layer``."""
    both = countries.withColumn("layer", F.lit(MAIN)).unionByName(
        alternatives.withColumn("layer", F.lit(ALTERNATIVE)), allowMissingColumns=True
    )
    return boundary_index(both, cell=cell, reach=reach)


def _pass(hit: Column, claimed: Column) -> Column:
    """The pass that accepts a hit: 1 claimed country, 2 any country, 3 near a
    country, 4 and 5 the same two on the second boundary set."""
    main = hit["layer"] == MAIN
    return (
        F.when(main & hit["inside"] & is_true(hit["name"] == claimed), 1)
        .when(main & hit["inside"], 2)
        .when(main, 3)
        .when(hit["inside"], 4)
        .otherwise(5)
    )


def is_tallied(located: DataFrame) -> bool:
    """Whether the hits are tallies, numbers without names (see ``locate``)."""
    return "n" in located.schema["hits"].dataType.elementType.names


def candidates(located: DataFrame) -> DataFrame:
    """Adds ``candidates``: per hit its pass, distance and name, of tallies their number ``n`` as well."""
    numbers = ["n"] if is_tallied(located) else []
    return located.withColumn(
        "candidates",
        F.transform(
            "hits",
            lambda hit: F.struct(
                _pass(hit, F.col("country")).alias("pass"),
                *[hit[c].alias(c) for c in ("distance", "name", *numbers)],
            ),
        ),
    )


def geocode_cascade(located: DataFrame) -> DataFrame:
    """Adds ``geo_pass`` and ``country_geo``: the first pass that succeeds.

    Within a pass the nearest polygon wins, then the smallest name. Every
    listing keeps one row; one that no pass finds has nulls.
    """
    best = candidates(located).withColumn("_best", F.array_min("candidates"))
    return best.select(
        *located.columns,
        F.col("_best.pass").alias("geo_pass"),
        F.col("_best.name").alias("country_geo"),
    )


def pass_matches(located: DataFrame, number: int) -> DataFrame:
    """Listings whose first successful pass is ``number``, with that pass's candidates.

    Tallied hits have no names, which tell a claimed country from others.
    """
    if number < 3 and is_tallied(located):
        raise ValueError("passes 1 and 2 need the names of hits")
    found = candidates(located)
    first = F.array_min("candidates")["pass"]
    mine = F.filter("candidates", lambda one: one["pass"] == number)
    return found.filter(first == number).withColumn("candidates", mine)


def tied(located: DataFrame, number: int) -> DataFrame:
    """Of those, listings near several countries, with the sorted candidate names."""
    names = F.array_sort(F.array_distinct(F.transform("candidates", lambda one: one["name"])))
    found = pass_matches(located, number).withColumn("candidates", names)
    return found.filter(F.size("candidates") > 1)


def compare_scrape(geocoded: DataFrame, scrapes: DataFrame) -> DataFrame:
    """Attach the scraped country, after the known exceptions. ``scrapes`` has one row per listing."""
    compared = geocoded.join(scrapes.select("property_ID", "country_scrape"), "property_ID", "left")
    exception = country_exception(F.col("country_scrape"), F.col("country_geo"), F.col("region"))
    return compared.withColumn("country_scrape", exception)


def validate_scrape(compared: DataFrame) -> DataFrame:
    """Adds ``scrape_valid``: disagrees with the geocode, but its country is within reach.

    The hits already hold both boundary sets, so no second spatial join.
    """
    disagrees = is_true(F.col("country_scrape") != F.col("country_geo"))
    within = F.exists("hits", lambda hit: is_true(hit["name"] == F.col("country_scrape")))
    return compared.withColumn("scrape_valid", disagrees & within)


def resolve_country(validated: DataFrame) -> DataFrame:
    """Final country: a valid scrape, else the geocode; without one, no region or city either."""
    country = F.when(F.col("scrape_valid"), F.col("country_scrape")).otherwise(F.col("country_geo"))
    resolved = validated.withColumn("country", country)
    nowhere = F.col("country").isNull()
    return resolved.withColumn("region", null_where(nowhere, F.col("region"))).withColumn(
        "city", null_where(nowhere, F.col("city"))
    )


def locate_countries(property: DataFrame, index: GridIndex, scrapes: DataFrame) -> DataFrame:
    """All steps in order on points with x and y: one spatial join, one scrape join."""
    located = geocode_cascade(locate(property, index))
    resolved = resolve_country(validate_scrape(compare_scrape(located, scrapes)))
    return resolved.select(*property.columns)
