"""Every operator as a query over the given test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roomledger import fixed_values as fixed
from roomledger.catalog import standins as S
from roomledger.functions import columns as C
from roomledger.functions.joins import upsert
from roomledger.operators import boundaries, dates, geocode, hosts, hulls, locations, places, ranges, regions, routing
from roomledger.operators import scrapes as scraping
from roomledger.plans import monthly_daily, replay
from roomledger.plans.monthly_daily import NIGHT, daily_ranges
from roomledger.plans.replay import split_backlog
from roomledger.session import materialize, new_run_dir
from roomledger.sources import delivered, tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
STORED: dict[tuple[str, str, str], object] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# --- shared steps -----------------------------------------------------------


def _routed(spark: SparkSession, sf: str) -> DataFrame:
    return routing.route_daily(S.night_events(spark, sf), S.listings(spark, sf))


def _ranges(spark: SparkSession, sf: str, route: str) -> DataFrame:
    both = daily_ranges(_routed(spark, sf), S.listings(spark, sf), prefer=["event_id"])
    return both.filter(F.col("route") == route).drop("route")


def _unique(spark: SparkSession, sf: str, route: str) -> DataFrame:
    nights = _routed(spark, sf).filter(F.col("route") == route).drop("route")
    nights = nights.select("property_ID", "date", "event_id", *NIGHT)
    return ranges.unique_nights(nights, ["property_ID"]).drop("event_id")


def _enriched_nights(spark: SparkSession, sf: str, route: str = "active") -> DataFrame:
    return routing.enrich_daily(_unique(spark, sf, route), S.listings(spark, sf))


def _history_parts(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Host tables of two loads, from the stored history of odd and even orders."""
    daily = S.table(spark, sf, "orders").selectExpr(
        f"{S.listing_id('o_custkey')} as property_ID", "cast(o_orderdate as date) as start_date",
        "date_add(cast(o_orderdate as date), cast(o_orderkey % 10 as int)) as end_date", "o_orderpriority as priority",
    )
    daily = routing.enrich_daily(daily, S.listings(spark, sf))
    host = hosts.host_from_ranges(daily.filter("priority <> '5-LOW'"))
    return host, hosts.host_from_ranges(daily.filter("priority = '5-LOW'"))


def _single(spark: SparkSession, sf: str) -> DataFrame:
    return scraping.single_scrape(S.scrapes(spark, sf).filter(F.col("raw").isNotNull()))


def _once(spark: SparkSession, sf: str, name: str, build: Callable[[], object]) -> object:
    """A stored boundary index, built by the first query of the application that needs it."""
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in STORED:
        STORED[key] = build()
    return STORED[key]


def _country_index(spark: SparkSession, sf: str) -> boundaries.GridIndex:
    first, second = S.countries(spark, sf), S.alternatives(spark, sf)
    return _once(spark, sf, "countries", lambda: geocode.geocode_index(first, second, cell=S.CELL))


def _subdivision_search(spark: SparkSession, sf: str) -> boundaries.NearestSearch:
    strips = S.subdivisions(spark, sf)
    return _once(spark, sf, "subdivisions", lambda: boundaries.nearest_search(strips, cell=S.CELL))


def _located(spark: SparkSession, sf: str) -> DataFrame:
    points = boundaries.with_xy(S.listings(spark, sf))
    return boundaries.locate(points, _country_index(spark, sf))


def _geocoded(spark: SparkSession, sf: str) -> DataFrame:
    return geocode.geocode_cascade(_located(spark, sf))


def _validated(spark: SparkSession, sf: str) -> DataFrame:
    return geocode.validate_scrape(geocode.compare_scrape(_geocoded(spark, sf), _single(spark, sf)))


def _resolved(spark: SparkSession, sf: str) -> DataFrame:
    listed = S.listings(spark, sf).columns
    return geocode.resolve_country(_validated(spark, sf)).select(*listed, "x", "y")


def _compared(spark: SparkSession, sf: str) -> DataFrame:
    return regions.compare_regions(_resolved(spark, sf), _subdivision_search(spark, sf), _single(spark, sf))


def _hulls(spark: SparkSession, sf: str) -> DataFrame:
    return hulls.convex_hulls(S.old_hull_points(spark, sf), hulls.HULL_KEYS)


def _corners(rings: DataFrame, *keys: str) -> DataFrame:
    points = rings.select(*keys, F.inline("ring"))
    return points.select(*keys, F.col("x").cast("long").alias("x"), F.col("y").cast("long").alias("y"))


# --- nights, ranges, hosts --------------------------------------------------


@query
def active_ranges(spark: SparkSession, sf: str) -> DataFrame:
    return _ranges(spark, sf, "active")


@query
def inactive_ranges(spark: SparkSession, sf: str) -> DataFrame:
    return _ranges(spark, sf, "inactive")


@query
def shipment_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """The flagship on the largest table."""
    listings = S.supplier_listings(spark, sf)
    routed = routing.route_daily(S.shipments(spark, sf), listings)
    return daily_ranges(routed, listings).filter("route = 'active'").drop("route")


@query
def shipment_hosts(spark: SparkSession, sf: str) -> DataFrame:
    return hosts.host_from_ranges(shipment_ranges(spark, sf))


@query
def compress_ranges(spark: SparkSession, sf: str) -> DataFrame:
    return ranges.compress_ranges(_unique(spark, sf, "active"), ["property_ID"], NIGHT)


@query
def compress_ranges_by_month(spark: SparkSession, sf: str) -> DataFrame:
    nights = ranges.unique_nights(S.shipments(spark, sf), ["property_ID"])
    return ranges.compress_ranges(nights, ["property_ID"], ["status", "price"], break_at_month=True)


@query
def expand_ranges(spark: SparkSession, sf: str) -> DataFrame:
    return ranges.expand_ranges(active_ranges(spark, sf)).select("property_ID", "date", "status", "price", "host_ID")


@query
def unique_nights(spark: SparkSession, sf: str) -> DataFrame:
    return _unique(spark, sf, "active")


@query
def route_daily(spark: SparkSession, sf: str) -> DataFrame:
    return _routed(spark, sf).select("event_id", "property_ID", "date", "route")


@query
def daily_errors(spark: SparkSession, sf: str) -> DataFrame:
    return monthly_daily.daily_errors(S.night_events(spark, sf), S.listings(spark, sf))


@query
def enrich_daily(spark: SparkSession, sf: str) -> DataFrame:
    return _enriched_nights(spark, sf).select(
        "property_ID", "date", "host_ID", "listing_type", "housing", "country", "region", "city"
    )


@query
def missing_rows(spark: SparkSession, sf: str) -> DataFrame:
    return routing.missing_rows(S.nights(spark, sf))


@query
def split_status(spark: SparkSession, sf: str) -> DataFrame:
    daily = S.history(spark, sf)
    active, inactive = routing.split_status(daily, inactive_ranges(spark, sf).select(*daily.columns))
    return active.withColumn("stored_in", F.lit("daily")).unionByName(
        inactive.withColumn("stored_in", F.lit("daily_inactive"))
    )


@query
def host_counts(spark: SparkSession, sf: str) -> DataFrame:
    return hosts.host_counts(_enriched_nights(spark, sf))


@query
def host_ranges(spark: SparkSession, sf: str) -> DataFrame:
    return hosts.host_ranges(_enriched_nights(spark, sf))


@query
def host_inactive_ranges(spark: SparkSession, sf: str) -> DataFrame:
    return hosts.host_from_ranges(inactive_ranges(spark, sf))


@query
def host_from_ranges(spark: SparkSession, sf: str) -> DataFrame:
    return hosts.host_from_ranges(active_ranges(spark, sf))


@query
def ml_counts(spark: SparkSession, sf: str) -> DataFrame:
    return hosts.ml_counts(_enriched_nights(spark, sf))


@query
def host_merge(spark: SparkSession, sf: str) -> DataFrame:
    return hosts.host_merge(*_history_parts(spark, sf))


@query
def semi_host(spark: SparkSession, sf: str) -> DataFrame:
    suppliers = hosts.host_from_ranges(shipment_ranges(spark, sf))
    listed = S.listings(spark, sf).select(F.regexp_replace("host_ID", "^a", "h").alias("host_ID"))
    return hosts.known_hosts(suppliers, listed)


@query
def backlog_replay(spark: SparkSession, sf: str) -> DataFrame:
    errors = daily_errors(spark, sf)
    later = S.later_listings(spark, sf)
    known, rest = split_backlog(errors, later)
    replayed = routing.route_daily(known, later)
    return replayed.unionByName(rest.withColumn("route", F.lit("stays"))).select(
        "event_id", "property_ID", "date", "route"
    )


@query
def monthly_daily_outputs(spark: SparkSession, sf: str) -> DataFrame:
    """All outputs of the monthly daily plan, told apart by name."""
    outputs = monthly_daily.monthly_daily(S.nights(spark, sf), materialize(S.listings(spark, sf), "property"))
    daily = [outputs[o].selectExpr(f"'{o}' as output", "property_ID as id", "start_date", "end_date", "1L as n") for o in ("daily", "daily_inactive")]
    hosted = [outputs[o].selectExpr(f"'{o}' as output", "host_ID as id", "start_date", "end_date", "count as n") for o in ("host", "host_inactive")]
    error = outputs["error"].selectExpr("'error' as output", "property_ID as id", "date as start_date", "date as end_date", "1L as n")
    none = "cast(null as date)"
    missing = outputs["missing_rows"].selectExpr("'missing_rows' as output", "property_ID as id", f"{none} as start_date", f"{none} as end_date", "1L as n")
    return reduce(DataFrame.unionByName, [*daily, *hosted, error, missing])


@query
def replay_outputs(spark: SparkSession, sf: str) -> DataFrame:
    """Ranges of the replayed nights, and every night that is left with its reason."""
    errors = monthly_daily.daily_errors(S.nights(spark, sf), S.listings(spark, sf))
    none = S.history(spark, sf).limit(0).selectExpr(
        "property_ID as host_ID", "start_date", "end_date", "'' as listing_type", "true as housing", "0L as count")
    outputs = replay.replay_backlog(errors, materialize(S.later_listings(spark, sf), "property"), none, none)
    daily = [
        outputs[o].selectExpr(f"'{o}' as output", "property_ID as id", "start_date", "end_date", "cast(null as string) as reason")
        for o in ("daily", "daily_inactive")
    ]
    left = outputs["backlog"].selectExpr("'backlog' as output", "property_ID as id", "date as start_date", "date as end_date", "reason")
    return reduce(DataFrame.unionByName, [*daily, left])


@query
def replay_stored(spark: SparkSession, sf: str) -> DataFrame:
    """The four stored tables after a month and, its unknown listings now known, the replay of its backlog."""
    root = new_run_dir(spark, "replay")
    first = monthly_daily.monthly_daily(S.nights(spark, sf), materialize(S.listings(spark, sf), "property"))
    replay.merge_daily(first, root)
    later = materialize(S.later_listings(spark, sf), "property")
    again = replay.replay_backlog(first["error"], later, first["host"], first["host_inactive"])
    replay.store_replay(again, root, S.LABEL)
    found = []
    for name in ("daily", "daily_inactive", "host", "host_inactive"):
        key, n = ("host_ID", "count") if name.startswith("host") else ("property_ID", "1L")
        found.append(tables.read_table(spark, f"{root}/{name}").selectExpr(
            f"'{name}' as output", f"{key} as id", "start_date", "end_date", f"{n} as n", "year_month"))
    dated = tables.read_table(spark, f"{root}/property").selectExpr(
        "'property' as output", "property_ID as id", "created as start_date", "scraped as end_date", "1L as n", "cast(null as string) as year_month")
    return reduce(DataFrame.unionByName, [*found, dated])


@query
def orphan_accumulate(spark: SparkSession, sf: str) -> DataFrame:
    nights = S.nights(spark, sf).select("property_ID", "date", "status")
    before = S.table(spark, sf, "events").selectExpr(
        "concat('old-', user_id) as property_ID", "cast(ts as date) as date", "'A' as status"
    ).distinct()
    return scraping.orphan_accumulate(nights, S.listings(spark, sf), before, "property_ID")


@query
def cross_platform_host(spark: SparkSession, sf: str) -> DataFrame:
    found = hosts.cross_platform_hosts(S.listings(spark, sf))
    return found.select("property_ID", "host_ID", "ha_host", "linked_ab_host")


# --- dates ------------------------------------------------------------------


@query
def first_active(spark: SparkSession, sf: str) -> DataFrame:
    return dates.first_active(S.nights(spark, sf))


def _dates_of(df: DataFrame) -> DataFrame:
    return df.select("property_ID", "created", "scraped")


@query
def fill_created_hist(spark: SparkSession, sf: str) -> DataFrame:
    return _dates_of(dates.fill_created_hist(S.listings(spark, sf), S.history(spark, sf)))


@query
def fill_scraped_hist(spark: SparkSession, sf: str) -> DataFrame:
    return _dates_of(dates.fill_scraped_hist(S.listings(spark, sf), S.history(spark, sf)))


@query
def fill_created_new(spark: SparkSession, sf: str) -> DataFrame:
    return _dates_of(dates.fill_created_new(S.listings(spark, sf), S.nights(spark, sf)))


@query
def fill_created_backfill(spark: SparkSession, sf: str) -> DataFrame:
    return _dates_of(dates.fill_created_backfill(S.listings(spark, sf), S.nights(spark, sf)))


@query
def filled_dates(spark: SparkSession, sf: str) -> DataFrame:
    filled = dates.fill_from_history(S.listings(spark, sf), S.history(spark, sf))
    return _dates_of(dates.fill_created_new(filled, S.nights(spark, sf)))


@query
def year_month_prev(spark: SparkSession, sf: str) -> DataFrame:
    days = S.table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    label = C.year_month_prev(F.col("day"))
    return days.select("day", label.alias("last_month"), C.label_prev(label).alias("month_before"))


@query
def month_bounds(spark: SparkSession, sf: str) -> DataFrame:
    labels = S.table(spark, sf, "orders").select(F.date_format("o_orderdate", "yyyy_MM").alias("label"))
    label = F.col("label")
    return labels.groupBy("label").agg(F.count("*").alias("n")).select(
        "label", "n", C.month_start(label).alias("first"), C.next_month_start(label).alias("next_first"),
        C.month_28th(label).alias("day_28"),
    )


# --- property: routing, cleaning, names -------------------------------------


@query
def route_property(spark: SparkSession, sf: str) -> DataFrame:
    routed = routing.route_property(S.raw_listings(spark, sf))
    return routed.select("property_ID", "listing_type", "route", C.clean_title(F.col("listing_title")).alias("title"))


@query
def clean_title(spark: SparkSession, sf: str) -> DataFrame:
    title = C.clean_title(F.col("listing_title")).alias("title")
    return S.raw_listings(spark, sf).select(title)


@query
def derive_host_id(spark: SparkSession, sf: str) -> DataFrame:
    host = C.derive_host_id(F.col("ab_host"), F.col("ha_host"))
    return S.raw_listings(spark, sf).select("property_ID", host.alias("host_ID"))


@query
def derive_housing(spark: SparkSession, sf: str) -> DataFrame:
    typed = S.listings(spark, sf)
    return typed.select("property_ID", "property_type", C.derive_housing(F.col("property_type")).alias("private"))


@query
def platform_prefix(spark: SparkSession, sf: str) -> DataFrame:
    raw = S.raw_listings(spark, sf)
    key = F.col("property_ID")
    return raw.groupBy(C.has_platform_prefix(key).alias("known"), C.is_airbnb(key).alias("airbnb")).agg(
        F.count("*").alias("n")
    )


def _texts(spark: SparkSession, sf: str, values: list[str], name: str) -> DataFrame:
    """Given spellings spread over all orders, with unknown and missing ones between."""
    n = len(values)
    text = f"case when o_orderkey % {n + 2} = {n} then null when o_orderkey % {n + 2} = {n + 1} then 'Elsewhere' else {S.pick(values, f'o_orderkey % {n + 2}')} end"
    return S.table(spark, sf, "orders").selectExpr(f"{text} as {name}")


@query
def country_alias(spark: SparkSession, sf: str) -> DataFrame:
    spelled = [s for names in fixed.COUNTRY_SPELLINGS.values() for s in names]
    texts = _texts(spark, sf, [*spelled, "Peru"], "country")
    regions_ = [*fixed.COUNTRY_BY_REGION, "United States Virgin Islands", "Lima"]
    region = F.expr(S.pick(regions_, "coalesce(length(country), 0) % 5"))
    named = texts.withColumn("region", region)
    return named.groupBy("country", "region").agg(F.count("*").alias("n")).withColumn(
        "canonical", C.country_alias(F.col("country"), F.col("region"))
    )


def _alias_counts(texts: DataFrame, country: str) -> DataFrame:
    named = C.scraped_region_alias(F.lit(country), F.col("region"))
    return texts.groupBy("region").agg(F.count("*").alias("n")).withColumn("canonical", named)


@query
def region_alias_ca(spark: SparkSession, sf: str) -> DataFrame:
    return _alias_counts(_texts(spark, sf, S.PROVINCE_TEXTS, "region"), "Canada")


@query
def region_alias_us(spark: SparkSession, sf: str) -> DataFrame:
    return _alias_counts(_texts(spark, sf, S.STATE_TEXTS, "region"), "United States")


@query
def region_alias_ru_de(spark: SparkSession, sf: str) -> DataFrame:
    harmonized = regions.harmonize_regions(S.listings(spark, sf))
    return harmonized.groupBy("country", "region").agg(F.count("*").alias("n"))


def _boundary_texts() -> list[str]:
    names = [*fixed.BOUNDARY_DROPPED, "Cyprus", "Morocco", "Peru"]
    return [*names, *(s for spellings in fixed.BOUNDARY_SPELLINGS.values() for s in spellings)]


def _alt_boundary_texts() -> list[str]:
    names = ["Cyprus", "N. Cyprus", "Akrotiri", "Dhekelia", "Morocco", "Peru", "Macau"]
    return [*names, *(s for spellings in fixed.ALT_BOUNDARY_SPELLINGS.values() for s in spellings)]


@query
def boundary_name_alias(spark: SparkSession, sf: str) -> DataFrame:
    first = boundaries.country_boundaries(_texts(spark, sf, _boundary_texts(), "name").filter("name is not null"))
    return first.groupBy("name", "part").agg(F.count("*").alias("n"))


@query
def semi_boundary_names(spark: SparkSession, sf: str) -> DataFrame:
    first = boundaries.country_boundaries(_texts(spark, sf, _boundary_texts(), "name").filter("name is not null"))
    second = _texts(spark, sf, _alt_boundary_texts(), "name").filter("name is not null")
    second = boundaries.alternative_boundaries(second, first)
    return second.groupBy("name", "part").agg(F.count("*").alias("n"))


@query
def boundary_merge(spark: SparkSession, sf: str) -> DataFrame:
    merged = boundaries.merge_parts(_texts(spark, sf, _alt_boundary_texts(), "name").filter("name is not null"))
    return merged.groupBy("name").agg(F.countDistinct("part").alias("parts"))


@query
def boundary_dissolve(spark: SparkSession, sf: str) -> DataFrame:
    """Outlines of the lands; the sides that two of their squares share are gone."""
    outline = boundaries.dissolve(S.territories(spark, sf))
    return outline.select("name", *[F.col(c).cast("long").alias(c) for c in ("x1", "y1", "x2", "y2")])


@query
def boundary_active(spark: SparkSession, sf: str) -> DataFrame:
    active = boundaries.active_boundaries(S.countries(spark, sf), S.listings(spark, sf))
    return active.select("name")


@query
def country_exception(spark: SparkSession, sf: str) -> DataFrame:
    pairs = S.scrapes(spark, sf).join(
        S.listings(spark, sf).select("property_ID", F.col("region").alias("supplied"), F.col("country").alias("geo")),
        "property_ID",
    )
    named = C.country_exception(F.col("country"), F.col("geo"), F.col("supplied"))
    return pairs.groupBy("country", "geo", "supplied").agg(F.count("*").alias("n")).withColumn("after", named)


@query
def concat_key(spark: SparkSession, sf: str) -> DataFrame:
    known = S.listings(spark, sf).filter("country is not null and region is not null")
    return known.select(F.concat_ws(", ", "country", "region").alias("country_region")).distinct()


@query
def contains_flag(spark: SparkSession, sf: str) -> DataFrame:
    flagged = S.scrapes(spark, sf).filter(C.needs_retry(F.col("country")))
    return flagged.groupBy("country").agg(F.count("*").alias("n"))


@query
def clean_place_name(spark: SparkSession, sf: str) -> DataFrame:
    name = F.col("name")
    named = S.places(spark, sf).groupBy("name").agg(F.count("*").alias("n"))
    return named.select("name", "n", C.clean_place_name(name).alias("clean"), C.leading_place_name(name).alias("leading"))


@query
def filter_predicate(spark: SparkSession, sf: str) -> DataFrame:
    listed = S.listings(spark, sf)
    wanted = (F.col("created") >= F.lit("2024-01-10").cast("date")) | F.col("scraped").isNull()
    kept = listed.filter(wanted & F.col("region").isNotNull() & C.not_among(F.col("country"), ["Peru", "Chile"]))
    return kept.select("property_ID", "country", "region")


@query
def point_lookup(spark: SparkSession, sf: str) -> DataFrame:
    listed = S.listings(spark, sf)
    return listed.filter("ha_host = 'm0' and ab_host <> 'a1'").select("property_ID", "scraped", "ab_host", "ha_host")


@query
def null_out(spark: SparkSession, sf: str) -> DataFrame:
    listed = S.listings(spark, sf)
    hit = F.col("country").isin("Peru", "Chile") & F.col("region").isNotNull()
    return listed.select(
        "property_ID", C.null_where(hit, F.col("region")).alias("region"), C.null_where(hit, F.col("city")).alias("city")
    )


@query
def rename_positional(spark: SparkSession, sf: str) -> DataFrame:
    return S.table(spark, sf, "customer").toDF("key", "title", "nation", "balance", "kind")


@query
def reorder_columns(spark: SparkSession, sf: str) -> DataFrame:
    listed = S.listings(spark, sf)
    first = ["property_ID", "host_ID", "country", "region", "city"]
    rest = [c for c in listed.columns if c not in first]
    return listed.select(*first, *rest).drop("latitude", "longitude", "listing_title", "property_type")


@query
def to_mercator(spark: SparkSession, sf: str) -> DataFrame:
    points = boundaries.with_xy(S.listings(spark, sf))
    return points.select("property_ID", F.round("x", 2).alias("x"), F.round("y", 2).alias("y"))


# --- locations and scrapes --------------------------------------------------


def _region_list(spark: SparkSession, sf: str) -> DataFrame:
    """Known regions: those of the suppliers, and the given provinces."""
    return S.supplier_listings(spark, sf).select("region").union(
        S.subdivisions(spark, sf).select("name")
    ).distinct()


def _location_table(spark: SparkSession, sf: str) -> DataFrame:
    """Last month's locations: every fourth listing has moved a little since."""
    return S.listings(spark, sf).selectExpr(
        "property_ID", "latitude + if(cast(substring(property_ID, 4) as bigint) % 4 = 0, 1e-6, 0D) as latitude", "longitude",
        "coalesce(country, 'Ghana') as country", "'Region 9' as region", "city",
    )


def _recent(spark: SparkSession, sf: str) -> DataFrame:
    return locations.new_scrapes(S.scrapes(spark, sf), "2001_02")


@query
def new_regions(spark: SparkSession, sf: str) -> DataFrame:
    return locations.new_regions(S.listings(spark, sf), _region_list(spark, sf)).select("property_ID", "region")


@query
def region_list(spark: SparkSession, sf: str) -> DataFrame:
    known = _region_list(spark, sf)
    return locations.grown_region_list(known, locations.new_regions(S.listings(spark, sf), known))


@query
def new_scrapes(spark: SparkSession, sf: str) -> DataFrame:
    return _recent(spark, sf).select("property_ID", "date", "raw")


def _reused(spark: SparkSession, sf: str) -> DataFrame:
    listed = S.listings(spark, sf)
    new = locations.new_regions(listed, _region_list(spark, sf))
    return locations.reuse_location(listed, _location_table(spark, sf), new, _recent(spark, sf))


@query
def reuse_location(spark: SparkSession, sf: str) -> DataFrame:
    return _reused(spark, sf).select("property_ID", "country", "region", "city")


@query
def needs_check(spark: SparkSession, sf: str) -> DataFrame:
    return locations.needs_check(S.listings(spark, sf), _reused(spark, sf)).select("property_ID", "country", "region")


def _worklist(spark: SparkSession, sf: str) -> DataFrame:
    return locations.scrape_worklist(S.listings(spark, sf), S.scrapes(spark, sf), "2000_05")


@query
def scrape_worklist(spark: SparkSession, sf: str) -> DataFrame:
    pool = S.listings(spark, sf).withColumn("created", F.add_months("created", -284))
    return locations.scrape_worklist(pool, S.scrapes(spark, sf), "2000_05").select("property_ID", "created", "priority")


@query
def worklist_batches(spark: SparkSession, sf: str) -> DataFrame:
    return scraping.worklist_batches(_worklist(spark, sf), 100).select("property_ID", "priority", "batch")


@query
def slice_n(spark: SparkSession, sf: str) -> DataFrame:
    """The first batch, as the scraper takes it."""
    batches = scraping.worklist_batches(_worklist(spark, sf), 500)
    return batches.filter("batch = 0").select("property_ID")


@query
def dedup_keep_first(spark: SparkSession, sf: str) -> DataFrame:
    return scraping.dedup_keep_first(S.scrapes(spark, sf))


@query
def latest_per_key(spark: SparkSession, sf: str) -> DataFrame:
    return scraping.latest_per_key(scraping.dedup_keep_first(S.scrapes(spark, sf)))


@query
def single_scrape(spark: SparkSession, sf: str) -> DataFrame:
    return _single(spark, sf)


@query
def upsert_by_key(spark: SparkSession, sf: str) -> DataFrame:
    results = S.scrapes(spark, sf)
    again = results.filter(C.needs_retry(F.col("country"))).withColumn("country", F.lit("Peru"))
    return upsert(results, again, "property_ID").select("property_ID", "country", "date", "raw")


@query
def scrape_merge(spark: SparkSession, sf: str) -> DataFrame:
    results = S.scrapes(spark, sf)
    new = results.filter("date >= date'2001-01-01'").withColumn("city", F.lit("New Town"))
    return scraping.merge_scrapes(results, new)


# --- sets, counts, checks ---------------------------------------------------


@query
def count_by(spark: SparkSession, sf: str) -> DataFrame:
    return S.listings(spark, sf).groupBy("country", "region").agg(F.count("*").alias("n"))


@query
def group_distinct(spark: SparkSession, sf: str) -> DataFrame:
    return S.scrapes(spark, sf).select("property_ID", "country", "region", "city").distinct()


@query
def distinct_all(spark: SparkSession, sf: str) -> DataFrame:
    old, ongoing = S.scrapes(spark, sf), S.scrapes(spark, sf).filter("raw is not null")
    return old.unionByName(ongoing).filter("raw is not null").distinct()


@query
def row_count(spark: SparkSession, sf: str) -> DataFrame:
    return S.nights(spark, sf).agg((F.count("*") - 1).alias("daily_length"))


@query
def union_strict(spark: SparkSession, sf: str) -> DataFrame:
    listed, suppliers = S.listings(spark, sf), S.supplier_listings(spark, sf)
    both = ["property_ID", "host_ID", "country", "region"]
    return listed.select(*both).unionByName(suppliers.select(*both))


@query
def union_fill(spark: SparkSession, sf: str) -> DataFrame:
    listed = S.listings(spark, sf).select("property_ID", "country", "ab_host")
    suppliers = S.supplier_listings(spark, sf).select("property_ID", "country", "listing_type")
    return listed.unionByName(suppliers, allowMissingColumns=True)


@query
def sort_output(spark: SparkSession, sf: str) -> DataFrame:
    return compress_ranges(spark, sf).orderBy("property_ID", "start_date")


@query
def assert_unique(spark: SparkSession, sf: str) -> DataFrame:
    """Scraped listings that occur more than once, and no property row that does."""
    routing.assert_unique(S.listings(spark, sf), "property_ID")
    return routing.duplicates(S.scrapes(spark, sf), "property_ID")


@query
def assert_rowcount(spark: SparkSession, sf: str) -> DataFrame:
    listed = S.listings(spark, sf)
    joined = listed.join(S.later_listings(spark, sf).select("property_ID", "country"), ["property_ID", "country"])
    return routing.rowcount_change(listed, joined)


# --- geocoding --------------------------------------------------------------


def _pass(spark: SparkSession, sf: str, number: int) -> DataFrame:
    geocoded = _geocoded(spark, sf)
    return geocoded.filter(F.col("geo_pass") == number).select("property_ID", "country_geo")


@query
def pip_claimed_country(spark: SparkSession, sf: str) -> DataFrame:
    return _pass(spark, sf, 1)


@query
def pip_any_country(spark: SparkSession, sf: str) -> DataFrame:
    return _pass(spark, sf, 2)


@query
def near_any_country(spark: SparkSession, sf: str) -> DataFrame:
    return _pass(spark, sf, 3)


@query
def pip_alt_boundary(spark: SparkSession, sf: str) -> DataFrame:
    return _pass(spark, sf, 4)


@query
def near_alt_boundary(spark: SparkSession, sf: str) -> DataFrame:
    return _pass(spark, sf, 5)


@query
def geocode_cascade(spark: SparkSession, sf: str) -> DataFrame:
    return _geocoded(spark, sf).select("property_ID", "geo_pass", "country_geo")


def _near_shipments(spark: SparkSession, sf: str, *, tally: bool = False) -> DataFrame:
    """Points around two overlapping sets of rectangles, where ties are common."""
    near = S.places(spark, sf).select(F.lit(geocode.MAIN).alias("layer"), F.col("part").alias("name"), "part", "ring")
    index = boundaries.boundary_index(near, cell=100.0, reach=50.0)
    points = S.hull_points(spark, sf).select("property_ID", F.lit(None).cast("string").alias("country"), "x", "y")
    return boundaries.locate(points, index, tally=tally)


@query
def tie_groups(spark: SparkSession, sf: str) -> DataFrame:
    near = geocode.pass_matches(_near_shipments(spark, sf, tally=True), 3)
    n = F.aggregate("candidates", F.lit(0).cast("long"), lambda total, one: total + one["n"])
    return near.select("property_ID", n.alias("n"), (n > 1).alias("tied"))


@query
def collect_candidates(spark: SparkSession, sf: str) -> DataFrame:
    tied = geocode.tied(_near_shipments(spark, sf), 3)
    return tied.select("property_ID", F.concat_ws("|", "candidates").alias("candidates"))


@query
def scrape_compare(spark: SparkSession, sf: str) -> DataFrame:
    compared = geocode.compare_scrape(_geocoded(spark, sf), _single(spark, sf))
    return compared.select("property_ID", "country_geo", "country_scrape")


@query
def country_validate_scrape(spark: SparkSession, sf: str) -> DataFrame:
    validated = _validated(spark, sf).filter(F.col("country_scrape") != F.col("country_geo"))
    return validated.select("property_ID", "country_geo", "country_scrape", "scrape_valid")


@query
def country_resolve(spark: SparkSession, sf: str) -> DataFrame:
    return _resolved(spark, sf).select("property_ID", "country", "region", "city")


@query
def boundary_index(spark: SparkSession, sf: str) -> DataFrame:
    """Listings inside each polygon, decided by the cells of a finer index than the cascade's."""
    index = boundaries.boundary_index(S.countries(spark, sf), cell=150_000.0, reach=0.0)
    points = boundaries.with_xy(S.listings(spark, sf))
    found = boundaries.locate(points, index)
    return found.select(F.inline("hits")).groupBy("name").agg(F.count("*").alias("n"))


# --- regions ----------------------------------------------------------------


@query
def region_compare(spark: SparkSession, sf: str) -> DataFrame:
    return _compared(spark, sf).select("property_ID", "country", "region", "region_geo", "region_scrape")


@query
def province_nearest(spark: SparkSession, sf: str) -> DataFrame:
    return _compared(spark, sf).filter("country = 'Canada'").select("property_ID", "region_geo")


@query
def state_pip_then_nearest(spark: SparkSession, sf: str) -> DataFrame:
    return _compared(spark, sf).filter("country = 'United States'").select("property_ID", "region_geo")


@query
def region_agree(spark: SparkSession, sf: str) -> DataFrame:
    return regions.mark_agreement(_compared(spark, sf)).select("property_ID", "agrees")


@query
def region_validate_scrape(spark: SparkSession, sf: str) -> DataFrame:
    validated = regions.validate_region(regions.mark_agreement(_compared(spark, sf)))
    return validated.filter(~F.col("agrees")).select("property_ID", "region_geo", "region_scrape", "scrape_valid")


def _written_back(spark: SparkSession, sf: str) -> DataFrame:
    resolved = materialize(_resolved(spark, sf), "resolved")
    return regions.resolve_subdivisions(resolved, _subdivision_search(spark, sf), _single(spark, sf))


@query
def region_writeback(spark: SparkSession, sf: str) -> DataFrame:
    return _written_back(spark, sf).select("property_ID", "country", "region", "city")


@query
def region_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return regions.region_coverage(S.listings(spark, sf))


@query
def spurious_region_purge(spark: SparkSession, sf: str) -> DataFrame:
    purged = regions.purge_spurious_regions(S.listings(spark, sf))
    return purged.select("property_ID", "country", "region", "city")


@query
def region_losers(spark: SparkSession, sf: str) -> DataFrame:
    return regions.region_losers(S.listings(spark, sf))


@query
def region_country_vote(spark: SparkSession, sf: str) -> DataFrame:
    voted = regions.region_country_vote(S.listings(spark, sf))
    return voted.select("property_ID", "country", "region", "city")


@query
def region_resolved(spark: SparkSession, sf: str) -> DataFrame:
    """All region steps before the hulls, in order."""
    written = materialize(_written_back(spark, sf), "written")
    purged = regions.harmonize_regions(regions.purge_spurious_regions(written))
    voted = regions.region_country_vote(materialize(purged, "purged"))
    return voted.select("property_ID", "country", "region", "city")


# --- hulls and places -------------------------------------------------------


@query
def hull_update(spark: SparkSession, sf: str) -> DataFrame:
    updated = hulls.hull_update(S.hull_points(spark, sf), _hulls(spark, sf))
    return _corners(updated, "country", "region")


@query
def hull_add(spark: SparkSession, sf: str) -> DataFrame:
    added = hulls.hull_add(S.hull_points(spark, sf), _hulls(spark, sf), min_listings=8)
    return _corners(added, "country", "region")


@query
def hull_refresh(spark: SparkSession, sf: str) -> DataFrame:
    refreshed = hulls.refresh_hulls(S.hull_points(spark, sf), _hulls(spark, sf), min_listings=8)
    return _corners(refreshed, "country", "region")


@query
def country_hulls(spark: SparkSession, sf: str) -> DataFrame:
    return hulls.country_hulls(S.hull_points(spark, sf)).select("country", "area", F.size("ring").alias("corners"))


@query
def city_hulls(spark: SparkSession, sf: str) -> DataFrame:
    hulled = hulls.city_hulls(S.hull_points(spark, sf).filter("country = 'Canada'"))
    return hulled.select("region", "city", "area")


@query
def region_from_hull(spark: SparkSession, sf: str) -> DataFrame:
    filled = hulls.region_from_hull(S.hull_points(spark, sf), _hulls(spark, sf), cell=200.0)
    return filled.select("property_ID", "country", "region")


@query
def hull_exclusive(spark: SparkSession, sf: str) -> DataFrame:
    held = hulls.holding_hulls(S.hull_points(spark, sf), _hulls(spark, sf), cell=200.0)
    n = F.size("regions").cast("long")
    return held.filter(F.col("country").isNotNull()).select("property_ID", n.alias("hulls"), (n == 1).alias("exclusive"))


@query
def place_join(spark: SparkSession, sf: str) -> DataFrame:
    joined = places.place_join(S.hull_points(spark, sf), S.places(spark, sf), cell=100.0)
    return joined.select("property_ID", "place")


@query
def place_join_inner(spark: SparkSession, sf: str) -> DataFrame:
    joined = places.place_join(S.hull_points(spark, sf), S.places(spark, sf), cell=100.0, keep_all=False)
    return joined.select("property_ID", "place")


@query
def place_counts(spark: SparkSession, sf: str) -> DataFrame:
    return places.place_counts(places.place_join(S.hull_points(spark, sf), S.places(spark, sf), cell=100.0))


# --- sources and sinks ------------------------------------------------------


def _deliver_property(spark: SparkSession, sf: str) -> str:
    """Writes all listings as a delivered property file, faults included."""
    raw = S.listings(spark, sf).join(
        S.table(spark, sf, "customer").selectExpr(f"{S.listing_id('c_custkey')} as property_ID", "c_custkey as k"),
        "property_ID",
    )
    filled = {
        "Property ID": "property_ID", "Listing Title": "concat('\"T\\'', k, '\\n', listing_type)",
        "Property Type": "property_type", "Listing Type": "listing_type",
        "Created Date": "if(k % 19 = 0, 'soon', cast(created as string))", "Last Scraped Date": "cast(scraped as string)",
        "Country": "country", "Latitude": "cast(latitude as string)", "Longitude": "cast(longitude as string)",
        "State": "region", "City": "city", "Bedrooms": "if(k % 37 = 0, 'many', cast(k % 4 as string))",
        "Airbnb Superhost": f"{S.pick(['t', 'F', 'TRUE', '0'], 'k % 4')}", "Instantbook Enabled": "if(k % 43 = 0, 'maybe', 'f')",
        "Airbnb Host ID": "ab_host", "HomeAway Property Manager": "ha_host",
    }
    supplied = ["Zipcode", *(name for name, _, _ in fixed.PROPERTY_COLUMNS), "Published Nightly Rate (USD)"]
    # compressed parts are read by a task each
    file = raw.repartition("property_ID").selectExpr(*[f"{filled.get(name, 'cast(null as string)')} as `{name}`" for name in supplied])
    path = f"{new_run_dir(spark, 'delivery')}/{delivered.PROPERTY_PREFIX}2024-02-03.csv"
    file.write.option("header", True).option("escape", '"').option("compression", "gzip").csv(path)
    return path


def _deliver_daily(spark: SparkSession, sf: str) -> str:
    rows = S.night_events(spark, sf)
    filled = {
        "Property ID": "property_ID", "Date": "cast(date as string)", "Status": "status",
        "Booked Date": "cast(booked_date as string)", "Price (USD)": "if(event_id % 71 = 0, 'free', cast(price as string))",
        "Reservation ID": "cast(res_ID as string)", "Currency Native": "'CAD'",
    }
    names = [name for name, _, _ in fixed.DAILY_COLUMNS]
    file = rows.selectExpr(*[f"{filled.get(name, 'cast(null as string)')} as `{name}`" for name in names])
    path = f"{new_run_dir(spark, 'delivery')}/{delivered.DAILY_PREFIX}2024-02-03.csv"
    file.write.option("header", True).option("escape", '"').option("compression", "gzip").csv(path)
    return path


@query
def scan_property_csv(spark: SparkSession, sf: str) -> DataFrame:
    read = delivered.read_property(spark, _deliver_property(spark, sf))
    return read.select(
        "property_ID", "listing_title", "created", "latitude", "region", "superhost", "instant_book",
        F.col("bedrooms").cast("int").alias("bedrooms"), "rating", "ha_host",
    )


@query
def parse_errors(spark: SparkSession, sf: str) -> DataFrame:
    read = delivered.read_property(spark, _deliver_property(spark, sf))
    bad = delivered.parse_errors(read)
    return bad.select("property_ID", "created", F.col("bedrooms").cast("int").alias("bedrooms"), "instant_book")


@query
def scan_daily_csv(spark: SparkSession, sf: str) -> DataFrame:
    read = delivered.read_daily(spark, _deliver_daily(spark, sf))
    whole = [F.col(c).cast("int").alias(c) for c in ("price", "res_ID")]
    return read.select("property_ID", "date", "status", "booked_date", *whole, "parse_error")


@query
def scan_daily_min(spark: SparkSession, sf: str) -> DataFrame:
    return delivered.read_daily_minimum(spark, _deliver_daily(spark, sf))


@query
def discover_delivery(spark: SparkSession, sf: str) -> DataFrame:
    folder = new_run_dir(spark, "deliveries")
    listed = S.listings(spark, sf).select(F.col("property_ID").alias("Property ID"))
    for day in ("2024-01-09", "2024-02-03", "2024-02-17"):
        listed.write.option("header", True).csv(f"{folder}/{delivered.PROPERTY_PREFIX}{day}.csv")
    path = delivered.find_delivery(spark, folder, delivered.PROPERTY_PREFIX, "2024_02")
    read = spark.read.option("header", True).csv(path)
    return read.select(F.lit(path.rsplit("/", 1)[1]).alias("delivery"), F.col("Property ID").alias("property_ID"))


@query
def scan_table(spark: SparkSession, sf: str) -> DataFrame:
    path = new_run_dir(spark, "daily")
    tables.append_month(active_ranges(spark, sf), path, S.LABEL, ["property_ID", "start_date"])
    stored = tables.read_table(spark, path)
    return stored.filter("year_month = '2024_01' and status = 'R'").select("property_ID", "start_date", "end_date")


@query
def scan_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    root = new_run_dir(spark, "state")
    tables.write_snapshot(_location_table(spark, sf), root, "location_table", S.LABEL)
    read = tables.read_snapshot(spark, root, "location_table", S.LABEL)
    return read.select("property_ID", "country", "region", "city")


@query
def sink_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    root = new_run_dir(spark, "state")
    for state in (S.supplier_listings(spark, sf), S.listings(spark, sf)):
        tables.write_snapshot(state.select("property_ID", "country"), root, "property", S.LABEL)
    return tables.read_snapshot(spark, root, "property", S.LABEL)


@query
def scan_error_backlog(spark: SparkSession, sf: str) -> DataFrame:
    path = tables.write_quarantine(daily_errors(spark, sf), f"{new_run_dir(spark, 'reports')}/error_2024_01")
    read = delivered.read_backlog(spark, path)
    whole = [F.col(c).cast("int").alias(c) for c in ("price", "res_ID")]
    return read.select("property_ID", "date", "status", "booked_date", *whole)


@query
def sink_append_table(spark: SparkSession, sf: str) -> DataFrame:
    """Two months appended, the second one twice."""
    path = new_run_dir(spark, "daily")
    keys = ["property_ID", "start_date"]
    tables.append_month(S.history(spark, sf), path, "2023_12", keys)
    for _ in range(2):
        tables.append_month(active_ranges(spark, sf).select(*S.history(spark, sf).columns), path, S.LABEL, keys)
    return tables.read_table(spark, path).groupBy("year_month", "status").agg(F.count("*").alias("n"))


@query
def sink_replace_table(spark: SparkSession, sf: str) -> DataFrame:
    path = new_run_dir(spark, "property")
    tables.replace_table(S.supplier_listings(spark, sf), path, ["property_ID"])
    tables.replace_table(S.listings(spark, sf), path, ["property_ID"])
    return tables.read_table(spark, path).select("property_ID", "host_ID", "country", "region", "city")


@query
def sink_quarantine_csv(spark: SparkSession, sf: str) -> DataFrame:
    routed = routing.route_property(S.raw_listings(spark, sf)).filter("route <> 'clean'")
    path = tables.write_quarantine(routed, f"{new_run_dir(spark, 'reports')}/property_2024_01")
    read = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(path)
    return read.groupBy("route").agg(F.count("*").alias("n"), F.count("property_ID").alias("named"))


@query
def readback_check(spark: SparkSession, sf: str) -> DataFrame:
    path = new_run_dir(spark, "daily")
    source = materialize(active_ranges(spark, sf), "source")
    tables.append_month(source, path, S.LABEL, ["property_ID", "start_date"])
    return tables.readback(tables.read_table(spark, path), source, S.LABEL)
