"""The monthly runs end to end on the stand-ins of the smallest tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from roomledger import fixed_values as fixed
from roomledger.catalog import queries as Q
from roomledger.catalog import standins as S
from roomledger.operators import hosts, ranges, routing, scrapes
from roomledger.plans import monthly_daily, monthly_property, replay
from roomledger.session import materialize
from roomledger.sources import delivered, tables

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def listings(spark):
    return materialize(S.listings(spark, SF))


def test_daily_outputs_conserve_nights(spark, listings):
    nights = S.nights(spark, SF)
    outputs = monthly_daily.monthly_daily(nights, listings)
    routed = routing.route_daily(nights, listings)
    unique = routed.filter("route <> 'error'").select("property_ID", "date", "route").distinct()
    for route, name in (("active", "daily"), ("inactive", "daily_inactive")):
        spread = ranges.expand_ranges(outputs[name]).select("property_ID", "date")
        assert spread.count() == unique.filter(F.col("route") == route).count() == spread.distinct().count()
    assert outputs["error"].count() + routed.filter("route <> 'error'").count() == nights.count()
    for name, daily in (("host", "daily"), ("host_inactive", "daily_inactive")):
        counted = hosts.host_ranges(ranges.expand_ranges(outputs[daily]))
        assert {tuple(r) for r in counted.collect()} == {tuple(r) for r in outputs[name].collect()}
    assert outputs["daily"].columns == [
        "property_ID", "start_date", "end_date", "status", "booked_date", "price", "res_ID", "host_ID", "listing_type", "housing",
        "country", "region", "city"]


def test_storing_a_month_twice_changes_nothing(spark, listings, tmp_path):
    outputs = monthly_daily.monthly_daily(S.nights(spark, SF), listings)
    for _ in range(2):
        monthly_daily.store_month(outputs, listings, str(tmp_path), S.LABEL)
    stored = tables.read_table(spark, f"{tmp_path}/daily")
    assert stored.count() == outputs["daily"].count()
    routing.assert_unique(stored, "property_ID", "start_date")
    routing.assert_unique(tables.read_table(spark, f"{tmp_path}/host"), "host_ID", "start_date", "listing_type", "housing")
    backlog = delivered.read_backlog(spark, f"{tmp_path}/reports/error_{S.LABEL}")
    assert backlog.count() == outputs["error"].count()


def test_replay_equals_having_known_the_listings_at_once(spark, listings):
    nights = S.nights(spark, SF)
    later = materialize(S.later_listings(spark, SF))
    first = monthly_daily.monthly_daily(nights, listings)
    again = replay.replay_backlog(first["error"], later, first["host"], first["host_inactive"])
    at_once = monthly_daily.monthly_daily(nights, replay.fill_created_backfill(later, first["error"]))
    for name in ("daily", "daily_inactive"):
        both = first[name].unionByName(again[name])
        assert {tuple(r) for r in both.collect()} == {tuple(r) for r in at_once[name].collect()}
    for name in ("host", "host_inactive"):
        merged = {tuple(r) for r in again[name].collect()}
        assert merged == {tuple(r) for r in at_once[name].collect()}
    known = {r.property_ID for r in later.collect()}
    assert all((r.reason == "unknown listing") == (r.property_ID not in known and r.property_ID is not None and r.date is not None
                                                   and r.status is not None) for r in again["backlog"].collect())


def test_replay_keeps_every_night(spark, listings):
    """A good night, one of a known listing without a date, one of an unknown listing: one range and two left."""
    one = listings.filter("property_ID is not null and created is not null").limit(1).collect()[0]
    rows = [(one.property_ID, one.created, "A"), (one.property_ID, None, "A"), ("ab-nobody", one.created, "A")]
    nights = spark.createDataFrame(rows, "property_ID string, date date, status string").selectExpr(
        "*", "cast(null as date) booked_date", "1.0D price", "cast(null as double) res_ID")
    none = monthly_daily.monthly_daily(nights.limit(0), listings)
    out = replay.replay_backlog(nights, listings, none["host"], none["host_inactive"])
    assert out["daily"].count() + out["daily_inactive"].count() == 1
    assert {(r.property_ID, r.reason) for r in out["backlog"].collect()} == {(one.property_ID, "no date"), ("ab-nobody", "unknown listing")}
    again = replay.replay_backlog(out["backlog"], listings, out["host"], out["host_inactive"])
    assert again["backlog"].count() == 2


@pytest.fixture(scope="module")
def monthly(spark):
    delivered_file = delivered.read_property(spark, Q._deliver_property(spark, SF))
    cleaned = monthly_property.clean_property(delivered_file)
    state = monthly_property.LastMonth(
        location_table=materialize(Q._location_table(spark, SF)),
        region_list=Q._region_list(spark, SF),
        scrapes=S.scrapes(spark, SF).filter("raw is not null"),
        region_hulls=S.old_hull_points(spark, SF).limit(0).selectExpr(
            "country", "region", "cast(null as array<struct<x:double,y:double>>) as ring"),
        history=S.history(spark, SF),
    )
    maps = monthly_property.index_boundaries(
        S.countries(spark, SF), S.alternatives(spark, SF), S.subdivisions(spark, SF), cell=S.CELL)
    prepared = monthly_property.prepare_property(cleaned["property"], S.nights(spark, SF), state, S.LABEL)
    located = monthly_property.locate_property(prepared["check"], state, maps)
    finished = monthly_property.finish_property(prepared["kept"], located["property"])
    return delivered_file, cleaned, prepared, located, finished


def test_property_run_conserves_listings(monthly):
    delivered_file, cleaned, prepared, located, finished = monthly
    assert sum(df.count() for df in cleaned.values()) == delivered_file.count()
    filled = prepared["kept"].count() + prepared["check"].count()
    undated = cleaned["property"].count() - filled
    assert 0 <= undated < filled
    assert finished["property"].count() == filled
    assert finished["property"].filter("scraped is null").count() == 0
    assert finished["property"].columns == fixed.PROPERTY_TABLE
    assert finished["location_table"].columns == monthly_property.LOCATION


def test_a_months_state_is_saved_and_loaded(spark, monthly, tmp_path):
    _, _, prepared, located, finished = monthly
    state = {"location_table": finished["location_table"], "region_list": prepared["region_list"],
             "scrapes": located["scrapes"], "region_hulls": located["region_hulls"]}
    for _ in range(2):
        monthly_property.save_month(state, str(tmp_path), "2024_01")
    history = S.history(spark, SF)
    loaded = monthly_property.load_month(spark, str(tmp_path), "2024_01", history)
    assert loaded.history is history
    for name, saved in state.items():
        found = getattr(loaded, name)
        assert sorted(found.columns) == sorted(saved.columns) and found.count() == saved.count()


def test_scrapes_of_the_month_take_part(spark):
    """A new scrape replaces the listing's earlier ones, one without a result takes no part."""
    old = spark.sql("select 'ab-1' property_ID, 'x' city, 'r' region, 'Peru' country, '1' raw, date'2024-01-01' date")
    new = spark.sql("select 'ab-1' property_ID, 'y' city, 'r' region, 'Chile' country, '2' raw, date'2024-01-09' date"
                    " union all select 'ab-2', 'z', 'r', 'Cuba', null, date'2024-01-09'")
    merged = scrapes.merge_scrapes(old, new)
    assert {(r.property_ID, r.country) for r in merged.collect()} == {("ab-1", "Chile")}


def test_property_run_settles_every_region(monthly):
    located = materialize(monthly[3]["property"])
    assert located.filter("country is null and (region is not null or city is not null)").count() == 0
    names = [*fixed.PROVINCES, *fixed.STATES]
    ours = located.filter(F.col("country").isin(fixed.SUBDIVIDED_COUNTRIES))
    assert ours.count() > 0 and ours.filter(~F.col("region").isin(names) | F.col("region").isNull()).count() == 0
    worklist = monthly[2]["worklist"].filter("priority = 1 and (created is null or created < date'2024-01-01')")
    assert worklist.count() == 0


def test_a_replay_stored_twice_changes_nothing_and_keeps_other_rows(spark, listings, tmp_path):
    """Hosts, nights and filled listings of a replay are stored; a second run, or one after a crash between tables, gives the same."""
    nights, root = S.nights(spark, SF), str(tmp_path)
    first = monthly_daily.monthly_daily(nights, listings)
    replay.merge_daily(first, root)
    later = materialize(S.later_listings(spark, SF))
    again = replay.replay_backlog(first["error"], later, first["host"], first["host_inactive"])

    def stored():
        names = ("daily", "daily_inactive", "host", "host_inactive")
        return {name: {tuple(r) for r in tables.read_table(spark, f"{root}/{name}").collect()} for name in names}

    before = stored()
    replay.store_replay(again, root, S.LABEL)
    once = stored()
    replay.store_replay(again, root, S.LABEL)
    assert stored() == once
    new = {r.property_ID for r in again["daily"].collect()}
    assert before["daily"] < once["daily"] and {r[0] for r in once["daily"] - before["daily"]} == new
    assert {r.property_ID for r in tables.read_table(spark, f"{root}/property").collect()} == {r.property_ID for r in later.collect()}
