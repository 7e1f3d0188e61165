"""Column expressions: conditions on nulls, names, text, dates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from roomledger import fixed_values as fixed


def is_true(condition: Column) -> Column:
    """A condition whose null counts as false."""
    return F.coalesce(condition, F.lit(False))


def not_among(column: Column, values: Sequence[str]) -> Column:
    """Not one of the literals; a null is not one of them either."""
    return F.coalesce(~column.isin(list(values)), F.lit(True))


def null_where(condition: Column, column: Column) -> Column:
    """The column, made null where the condition holds."""
    return F.when(~is_true(condition), column)


def known_name(column: Column, spellings: Mapping[str, Sequence[str]]) -> Column:
    """The canonical name of a known spelling, null for any other value.

    A map literal, not a chain of conditions, so that long lists stay one
    small expression in the generated code.
    """
    names: dict[str, str] = {}
    for name, sources in spellings.items():
        for source in sources:
            names.setdefault(source, name)
    entries = F.create_map(*[F.lit(text) for pair in names.items() for text in pair])
    return F.try_element_at(entries, column)


def canonical(column: Column, spellings: Mapping[str, Sequence[str]]) -> Column:
    """Replace known spellings by their canonical name; the rest stays as it is."""
    return F.coalesce(known_name(column, spellings), column)


# --- listings ---------------------------------------------------------------


def clean_title(title: Column) -> Column:
    """Drop line breaks and both kinds of quotes."""
    return F.translate(title, "\n\r\"'", "")


def derive_host_id(ab_host: Column, ha_host: Column) -> Column:
    return F.coalesce(ab_host, ha_host)


def derive_housing(property_type: Column, types: Sequence[str] = fixed.HOUSING_TYPES) -> Column:
    """Whether the listing is a private dwelling; null type gives null."""
    return property_type.isin(list(types))


def has_platform_prefix(property_id: Column) -> Column:
    return property_id.startswith("ab-") | property_id.startswith("ha-")


def is_airbnb(property_id: Column) -> Column:
    return property_id.startswith("ab-")


# --- names ------------------------------------------------------------------


def country_alias(country: Column, region: Column) -> Column:
    """Supplier's country to the canonical one; country rules go before region rules."""
    by_country = known_name(country, fixed.COUNTRY_SPELLINGS)
    return F.coalesce(by_country, known_name(region, fixed.COUNTRY_BY_REGION), country)


def region_alias(country: Column, region: Column) -> Column:
    """Harmonised region names of Germany and Russia."""
    rules = fixed.REGION_SPELLINGS.items()
    return F.coalesce(*[F.when(country == land, known_name(region, names)) for land, names in rules], region)


def scraped_region_alias(country: Column, region: Column) -> Column:
    """Free-text province or state of a scrape to the boundary file's name."""
    name = F.when(country == "Canada", canonical(region, fixed.PROVINCE_SPELLINGS))
    name = name.when(country == "United States", canonical(region, fixed.STATE_SPELLINGS))
    return name.otherwise(region)


def country_exception(scrape: Column, geo: Column, region: Column) -> Column:
    """Scraped country after five known disputes with the geocoded one.

    Null-strict where the rule is an equation (one located country): where a
    null decides whether such a dispute applies, the scraped country becomes
    null, so the row is no disagreement and the geocoded country stands.
    Membership in a list of countries is never null: no geocode is no member.
    """
    name = F.when(scrape == fixed.BONAIRE_SCRAPED, fixed.BONAIRE)
    for claimed, located in fixed.COUNTRY_EXCEPTIONS.items():
        if len(located) == 1:
            name = name.when((scrape == claimed) & geo.isNull(), F.lit(None))
        name = name.when((scrape == claimed) & geo.isin(located), geo)
    may_be = (geo.isNull() | (geo == "Taiwan")) & (region.isNull() | (region == "Fujian"))
    name = name.when((scrape == "China") & may_be, F.when(region.isNotNull(), geo))
    return name.otherwise(scrape)


def needs_retry(country: Column) -> Column:
    """Scrapes the scraper itself flagged as doubtful."""
    return country.contains("CHECK")


def clean_place_name(name: Column) -> Column:
    """Census-place name up to its bracket, without subdivision marks.

    A name without a bracket gives null.
    """
    name = F.nullif(F.regexp_extract(name, r"^(.+) \(", 1), F.lit(""))
    name = F.regexp_replace(name, r"^(.*?) No\.(.*)$", "$1$2")
    name = F.regexp_replace(name, r" \p{Lu}$", "")
    name = F.regexp_replace(name, r" \d+$", "")
    return F.regexp_replace(name, r", .*$", "")


def leading_place_name(name: Column) -> Column:
    """Variant: everything before the first bracket, comma or digit, without one trailing space."""
    return F.regexp_replace(F.regexp_extract(name, r"^[^(,\d]*", 0), r"\s$", "")


# --- dates ------------------------------------------------------------------


def year_month_prev(day: Column) -> Column:
    """Label YYYY_MM of the month before a date."""
    return F.date_format(F.add_months(day, -1), "yyyy_MM")


def label_prev(label: Column) -> Column:
    """Label of the month before a YYYY_MM label."""
    return year_month_prev(month_start(label))


def month_start(label: Column) -> Column:
    return F.to_date(label, "yyyy_MM")


def next_month_start(label: Column) -> Column:
    return F.add_months(month_start(label), 1)


def month_28th(label: Column) -> Column:
    return F.date_add(month_start(label), 27)
