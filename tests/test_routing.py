from __future__ import annotations

from datetime import date

import pytest

from roomledger.operators import dates, locations, regions, routing
from roomledger.operators import scrapes as scraping


def test_property_routes_in_order_of_precedence(spark):
    rows = [
        ("ab-1", "t", 1.0, 1.0, False, "clean"), (None, "t", 1.0, 1.0, False, "error"), ("ab-2", None, 1.0, 1.0, False, "error"),
        ("xx-3", "t", 1.0, 1.0, False, "error"), ("ha-4", "t", None, 1.0, False, "missing_geography"),
        (None, "t", None, 1.0, False, "error"), ("ab-5", "t", 1.0, None, True, "error"), ("ha-6", "t", 1.0, 1.0, True, "error"),
    ]
    schema = "property_ID string, listing_type string, latitude double, longitude double, parse_error boolean, expected string"
    found = routing.route_property(spark.createDataFrame(rows, schema)).collect()
    assert [r.route for r in found] == [r.expected for r in found]


NIGHTS = "property_ID string, date date, status string"


def test_every_night_takes_exactly_one_route(spark):
    d = date(2024, 1, 10)
    listings = spark.createDataFrame(
        [("a", d, date(2024, 1, 20)), ("b", None, None)], "property_ID string, created date, scraped date")
    rows = [
        ("a", d, "A"), ("a", d, "A"), ("a", d, "U"), ("a", date(2024, 1, 9), "A"), ("a", date(2024, 1, 21), "R"),
        ("b", d, "A"), ("b", d, "U"), ("c", d, "A"), (None, d, "A"), ("a", None, "A"), ("a", d, None),
    ]
    routed = routing.route_daily(spark.createDataFrame(rows, NIGHTS), listings)
    counts = {r.route: r["count"] for r in routed.groupBy("route").count().collect()}
    assert counts == {"active": 3, "inactive": 4, "error": 4}
    assert sum(counts.values()) == len(rows)


def test_missing_rows_sees_gaps_and_copies(spark):
    rows = [("gap", date(2024, 1, 1), "A"), ("gap", date(2024, 1, 3), "A"), ("copy", date(2024, 1, 1), "A"),
            ("copy", date(2024, 1, 1), "A"), ("fine", date(2024, 1, 1), "A"), ("fine", date(2024, 1, 2), "A"),
            ("both", date(2024, 1, 1), "A"), ("both", date(2024, 1, 1), "A"), ("both", date(2024, 1, 3), "A")]
    found = routing.missing_rows(spark.createDataFrame(rows, NIGHTS)).collect()
    assert {(r.property_ID, r["count"], r.full_count, r.gaps, r.copies) for r in found} == {
        ("gap", 2, 3, 1, 0), ("copy", 2, 1, 0, 1), ("both", 3, 3, 1, 1)}


def test_assertions_raise(spark):
    twice = spark.createDataFrame([("a", 1), ("a", 2)], "k string, v int")
    with pytest.raises(ValueError):
        routing.assert_unique(twice, "k")
    routing.assert_unique(twice, "k", "v")
    with pytest.raises(ValueError):
        routing.assert_rowcount(twice, twice.limit(1))
    routing.assert_rowcount(twice, twice)


LISTINGS = "property_ID string, created date, scraped date"
HISTORY = "property_ID string, start_date date, end_date date, status string"


def test_dates_are_filled_in_order(spark):
    d = lambda n: date(2024, 1, n)
    listings = spark.createDataFrame([
        ("history", None, None), ("new", None, d(20)), ("unavailable", None, d(20)), ("dropped", None, None), ("whole", d(1), d(2)),
    ], LISTINGS)
    history = spark.createDataFrame([
        ("history", d(3), d(5), "A"), ("history", d(1), d(2), "U"), ("history", d(8), d(9), "R"), ("whole", d(7), d(9), "A"),
        ("unavailable", d(1), d(2), "U"),
    ], HISTORY)
    nights = spark.createDataFrame([
        ("new", d(6), "U"), ("new", d(7), "A"), ("dropped", d(7), "A"), ("unavailable", d(7), "U"), ("history", d(2), "A"),
    ], NIGHTS)
    filled = dates.fill_created_new(dates.fill_from_history(listings, history), nights)
    assert {tuple(r) for r in filled.collect()} == {
        ("history", d(3), d(9)), ("new", d(7), d(20)), ("unavailable", None, d(20)), ("whole", d(1), d(2))}
    step = dates.fill_scraped_hist(dates.fill_created_hist(listings, history), history)
    assert {tuple(r) for r in dates.fill_created_new(step, nights).collect()} == {tuple(r) for r in filled.collect()}


def test_backfill_overwrites_created(spark):
    d = lambda n: date(2024, 1, n)
    listings = spark.createDataFrame([("a", d(1), None), ("b", d(1), d(9)), ("c", None, d(9))], LISTINGS)
    nights = spark.createDataFrame([("a", d(4), "U"), ("a", d(5), "A"), ("b", d(5), "A")], NIGHTS)
    found = {tuple(r) for r in dates.fill_created_backfill(listings, nights).collect()}
    assert found == {("a", d(5), None), ("b", d(1), d(9)), ("c", None, d(9))}


def test_location_is_reused_only_for_exact_coordinates(spark):
    schema = "property_ID string, latitude double, longitude double, country string, region string, city string"
    listings = spark.createDataFrame([
        ("ab-same", 1.1, 2.2, "x", "r", "y"), ("ab-moved", 1.100001, 2.2, "x", "r", "y"), ("ab-region", 1.1, 2.2, "x", "new", "y"),
        ("ab-scraped", 1.1, 2.2, "x", None, "y"), ("ha-scraped", 1.1, 2.2, "x", "r", "y"), ("ab-unseen", 1.1, 2.2, "x", "r", "y"),
    ], schema)
    names = ["ab-same", "ab-moved", "ab-region", "ab-scraped", "ha-scraped"]
    table = spark.createDataFrame([(n, 1.1, 2.2, "C", "R", "T") for n in names], schema)
    known = spark.createDataFrame([("r",)], "region string")
    scrapes = spark.createDataFrame(
        [("ab-scraped", date(2024, 2, 1)), ("ha-scraped", date(2024, 2, 1)), ("ab-same", date(2024, 1, 31))], "property_ID string, date date")
    new = locations.new_regions(listings, known)
    kept = locations.reuse_location(listings, table, new, locations.new_scrapes(scrapes, "2024_01"))
    assert {(r.property_ID, r.country) for r in kept.collect()} == {("ab-same", "C"), ("ha-scraped", "C")}
    check = locations.needs_check(listings, kept)
    assert {r.property_ID for r in check.collect()} == {"ab-moved", "ab-region", "ab-scraped", "ab-unseen"}
    assert {r.region for r in locations.grown_region_list(known, new).collect()} == {"r", "new"}


def test_worklist_priorities(spark):
    listings = spark.createDataFrame(
        [("a", date(2024, 1, 1), None), ("b", date(2023, 12, 31), None), ("c", None, None), ("d", date(2024, 1, 5), None)], LISTINGS)
    scrapes = spark.createDataFrame([("d", date(2024, 1, 28)), ("a", date(2024, 1, 27))], "property_ID string, date date")
    found = locations.scrape_worklist(listings, scrapes, "2024_01").collect()
    assert {(r.property_ID, r.priority) for r in found} == {("a", 1), ("b", 2), ("c", 2)}


def test_batches_are_full_and_whole(spark):
    ids = spark.range(1005).selectExpr("concat('ab-', id) as property_ID")
    sizes = {r.batch: r["count"] for r in scraping.worklist_batches(ids, 100).groupBy("batch").count().collect()}
    assert sizes == {**{n: 100 for n in range(10)}, 10: 5}


def test_the_first_priority_is_emptied_first(spark):
    ids = spark.range(25).selectExpr("concat('ab-', id) as property_ID", "cast(if(id % 2 = 0, 1, 2) as int) as priority")
    batches = {(r.priority, r.batch): r["count"] for r in scraping.worklist_batches(ids, 10).groupBy("priority", "batch").count().collect()}
    assert batches == {(1, 0): 10, (1, 1): 3, (2, 2): 10, (2, 3): 2}


def test_scrapes_keep_ties_and_ignore_null_dates(spark):
    schema = "property_ID string, city string, region string, country string, raw string, date date"
    d = date(2024, 1, 5)
    rows = [
        ("a", "x", "r", "c", "1", d), ("a", "y", "r", "c", "2", d), ("a", "z", "r", "c", "3", date(2024, 1, 4)),
        ("a", "w", "r", "c", None, date(2024, 1, 9)), ("a", "v", "r", "c", "4", None), ("b", "x", None, None, "5", None),
        ("a", "x", "r", "c", "0", d),
    ]
    kept = scraping.dedup_keep_first(spark.createDataFrame(rows, schema))
    latest = scraping.latest_per_key(kept).collect()
    assert {(r.property_ID, r.city, r.raw) for r in latest} == {("a", "x", "0"), ("a", "y", "2")}
    single = scraping.single_scrape(kept).collect()
    assert {(r.property_ID, r.city_scrape) for r in single} == {("a", "y"), ("b", "x")}


LOCATED = "property_ID string, country string, region string, city string"


def located(spark, groups):
    rows = []
    for country, region, n in groups:
        rows += [(f"{country}-{region}-{i}", country, region, "city") for i in range(n)]
    return spark.createDataFrame(rows, LOCATED)


def test_coverage_counts_any_region_of_a_country_not_trusted(spark):
    df = located(spark, [("Peru", None, 99), ("Peru", "r", 1), ("Mexico", "r", 1), ("Chile", None, 3), (None, "r", 2)])
    found = {r.country: r.region_pct for r in regions.region_coverage(df).collect()}
    assert found == {"Peru": 0.01, None: 1.0}
    purged = regions.purge_spurious_regions(df)
    assert purged.count() == df.count()
    left = {(r.country, r.region) for r in purged.filter("region is not null").collect()}
    assert left == {("Mexico", "r")}
    assert purged.filter("city is null").count() == 3


def test_vote_majority_ties_and_shared_names(spark):
    df = located(spark, [("A", "r", 5), ("B", "r", 2), ("C", "t", 3), ("D", "t", 3), ("E", "La Paz", 9), ("F", "La Paz", 1),
                         ("A", "u", 4), ("B", "u", 4), ("C", "u", 1), ("A", "only", 1)])
    voted = regions.region_country_vote(df)
    lost = {tuple(r.property_ID.split("-")[:2]) for r in voted.filter("region is null and city is null").collect()}
    assert lost == {("B", "r"), ("C", "u")}
    assert voted.count() == df.count()
