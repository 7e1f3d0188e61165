"""Hot keys: a third of all rows on one key must not end up in one task."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from roomledger import session
from roomledger.functions.joins import keep_in, keep_not_in, lookup_join, salted, upsert
from roomledger.operators import boundaries, places
from roomledger.operators.routing import route_daily
from roomledger.plans.monthly_daily import daily_ranges
from roomledger.session import materialize, tune


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_salted_lookup_equals_broadcast(spark, how, null_safe):
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 7 > 0, F.concat(F.lit("k"), F.col("id") % 50))
    facts = spark.range(900).withColumn("key", key)
    lookup = spark.sql("select * from values ('hot', 1), ('k1', 2), ('k4', 3), (null, 4) as t(key, value)")
    small = lookup_join(facts, lookup, ["key"], how, null_safe=null_safe)
    large = lookup_join(facts, lookup, ["key"], how, null_safe=null_safe, limit=0, piece=50)
    assert small.columns == large.columns
    assert rows(small) == rows(large)
    assert "Broadcast" in small._jdf.queryExecution().executedPlan().toString()


def test_only_the_hot_key_is_cut_and_copied(spark):
    facts = spark.range(3000).withColumn("key", F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")))
    lookup = spark.range(10).select(F.col("id").alias("key"), F.lit(1).alias("value"))
    left, right = salted(facts, lookup, ["key"], 130)
    assert {(r.key, r["count"]) for r in right.groupBy("key").count().collect()} == {(0, 8), *((k, 1) for k in range(1, 10))}
    pieces = [r["count"] for r in left.filter("key = 0").groupBy("_salt").count().collect()]
    assert len(pieces) == 8 and max(pieces) < 200
    assert left.filter("key > 0 and _salt > 0").count() == 0


def test_facts_without_a_key_are_not_shuffled(spark):
    facts = spark.range(100).withColumn("key", F.when(F.col("id") % 3 > 0, F.col("id")))
    lookup = spark.range(10).select(F.col("id").alias("key"), F.lit(1).alias("value"))
    joined = lookup_join(facts, lookup, ["key"], "left", limit=0)
    assert "isnotnull" in joined._jdf.queryExecution().optimizedPlan().toString()
    assert joined.count() == 100 and joined.filter("value is null and key is null").count() == 34


def test_hot_listing_is_split_in_the_routing_join(spark, settings):
    settings(
        spark_sql_autoBroadcastJoinThreshold="-1",
        spark_sql_adaptive_skewJoin_skewedPartitionThresholdInBytes="20KB",
        spark_sql_adaptive_skewJoin_skewedPartitionFactor="1.5",
        spark_sql_adaptive_advisoryPartitionSizeInBytes="20KB",
        spark_sql_adaptive_coalescePartitions_minPartitionSize="1KB",
    )
    hot = F.when(F.col("id") % 3 == 0, F.lit("ab-hot")).otherwise(F.concat(F.lit("ab-"), F.col("id") % 997))
    nights = spark.range(0, 90_000, 1, 8).select(
        hot.alias("property_ID"),
        F.expr("date_add(date'2024-01-01', cast(id % 31 as int))").alias("date"),
        F.expr("substring(md5(cast(id as string)), 1, 1)").alias("status"),
        F.lit(None).cast("date").alias("booked_date"), F.lit(1).alias("price"), F.lit(None).cast("int").alias("res_ID"),
    )
    property = nights.select("property_ID").distinct().selectExpr(
        "property_ID", "date'2024-01-01' as created", "date'2024-01-31' as scraped", "'h' as host_ID", "'t' as listing_type",
        "true as housing", "'c' as country", "'r' as region", "'y' as city",
    )
    property = materialize(property)
    ranges = daily_ranges(route_daily(nights, property), property)
    found = ranges.collect()
    assert "skew=true" in ranges._jdf.queryExecution().executedPlan().toString()
    covered = sum((r.end_date - r.start_date).days + 1 for r in found if r.property_ID == "ab-hot")
    assert covered == 31


def test_null_keys_in_set_filters(spark):
    left = spark.sql("select * from values (1, 'a'), (2, null), (3, 'b') as t(n, k)")
    right = spark.sql("select * from values ('a'), (null) as t(k)")
    assert [r.n for r in keep_in(left, right, "k").collect()] == [1]
    assert sorted(r.n for r in keep_in(left, right, "k", null_safe=True).collect()) == [1, 2]
    assert sorted(r.n for r in keep_not_in(left, right, "k").collect()) == [2, 3]
    assert [r.n for r in keep_not_in(left, right, "k", null_safe=True).collect()] == [3]


def test_upsert_replaces_all_rows_of_a_key(spark):
    base = spark.sql("select * from values ('a', 1), ('a', 2), ('b', 3) as t(k, v)")
    new = spark.sql("select * from values ('a', 9) as t(k, v)")
    assert sorted((r.k, r.v) for r in upsert(base, new, "k").collect()) == [("a", 9), ("b", 3)]


@pytest.mark.parametrize("hot", [2, 20, 1000])
def test_locating_survives_an_index_beyond_the_broadcast_limit(spark, monkeypatch, hot):
    square = spark.sql(
        "select 'm' as layer, 'A' as name, 'A' as part, array(named_struct('x', 0D, 'y', 0D), named_struct('x', 1e5D, 'y', 0D),"
        " named_struct('x', 1e5D, 'y', 1e5D), named_struct('x', 0D, 'y', 1e5D)) as ring"
    )
    points = spark.range(500).selectExpr("id", "id * 400D - 5e4 as x", "if(id % 3 = 0, 5e4D, id * 300D) as y")
    index = boundaries.boundary_index(square, cell=20_000.0)
    small = boundaries.locate(points, index)
    monkeypatch.setattr(boundaries, "HOT_ROWS", hot)
    large = boundaries.locate(points, index, limit=0)
    assert rows(small) == rows(large)
    assert small.filter("size(hits) > 0").count() > 100


def crowd(spark):
    """Points of one task among polygons that overlap: squares, one with a hole, edges without length."""
    corners = lambda x, y, w: ", ".join(f"named_struct('x', {a}, 'y', {b})" for a, b in ((x, y), (f"{x} + {w}", y), (f"{x} + {w}", f"{y} + {w}"), (x, f"{y} + {w}"), (x, f"{y} + {w}")))
    x, y = "cast(id * 37 % 90 as double)", "cast(id * 53 % 70 as double)"
    polygons = spark.range(60).selectExpr("'m' as layer", "concat('P', id) as name", "'' as part", f"array({corners(x, y, 20)}) as ring")
    hole = spark.range(1).selectExpr("'m' as layer", "'P3' as name", "'' as part", f"array({corners('25D', '93D', 9)}) as ring")
    points = spark.range(3000, numPartitions=1).selectExpr("id", "if(id % 500 = 0, null, id * 17 % 130 - 9.5D) as x", "if(id % 7 = 0, 40D, cast(id * 29 % 110 as double)) as y")
    return points.unionByName(points.filter("id < 40")).coalesce(1), polygons.unionByName(hole)


@pytest.mark.parametrize("most, reach", [(1024, 0.0), (1024, 6.0), (16, 6.0), (3, 40.0)])
def test_points_among_many_polygons_are_located_in_groups(spark, monkeypatch, most, reach):
    points, polygons = crowd(spark)
    hits = lambda df: sorted((r.id, sorted(map(str, r.hits))) for r in df.collect())
    monkeypatch.setattr(boundaries, "LIGHT_ITEMS", 10**9)
    plain = boundaries.locate(points, boundaries.boundary_index(polygons, cell=50.0, reach=reach))
    assert "FlatMapGroups" not in plain._jdf.queryExecution().optimizedPlan().toString()
    for name, value in (("LIGHT_ITEMS", 1), ("GROUP_POINTS", 100), ("BLOCK_POINTS", 30), ("BLOCK_EDGES", 7), ("TASK_TESTS", 20_000), ("BATCH_HITS", 50)):
        monkeypatch.setattr(boundaries, name, value)
    index = boundaries.boundary_index(polygons, cell=50.0, reach=reach, most=most)
    assert (index.pieces > 1) == (most < 1024)
    grouped = boundaries.locate(points, index)
    assert hits(grouped) == hits(plain) and len(hits(plain)) == 3040
    assert grouped.columns == plain.columns and grouped.rdd.getNumPartitions() > 2
    assert "Aggregate" not in grouped._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("light, most, reach", [(10**9, 1024, 6.0), (1, 1024, 0.0), (1, 1024, 6.0), (1, 16, 6.0), (1, 3, 40.0)])
def test_tallies_are_the_numbers_of_hits(spark, monkeypatch, light, most, reach):
    points, polygons = crowd(spark)
    polygons = polygons.withColumn("layer", F.expr("if(name in ('P7', 'P8', 'P9'), null, if(name < 'P3', 'm', 'o'))"))
    for name, value in (("LIGHT_ITEMS", light), ("TALLY_POINTS", 300), ("TASK_TESTS", 20_000), ("TASK_EDGES", 50), ("TASK_ITEMS", 200)):
        monkeypatch.setattr(boundaries, name, value)
    index = boundaries.boundary_index(polygons, cell=50.0, reach=reach, most=most)
    listed, tallied = boundaries.locate(points, index), boundaries.locate(points, index, tally=True)
    plan = tallied._jdf.queryExecution().optimizedPlan().toString()
    assert ("FlatMapGroups" in plan) == (light == 1)
    expected = sorted((r.id, sorted(map(repr, Counter((h.layer, h.inside) for h in r.hits).items()))) for r in listed.collect())
    found = tallied.collect()
    assert {h for r in found for h in (h.name for h in r.hits)} == {None} and len(found) == 3040
    assert sorted((r.id, sorted(repr(((h.layer, h.inside), h.n)) for h in r.hits)) for r in found) == expected


def test_tallies_of_a_crowded_cell_do_not_test_all_pairs(monkeypatch):
    """Squares of points are decided at once, any sizes and repeats of points and polygons the same as by pairs."""
    random = np.random.default_rng(3)
    n, held = 3000, 500
    x0, y0, w = random.uniform(-40, 60, n), random.uniform(-40, 60, n), random.choice([0.0, 3.0, 25.0, 250.0], n)
    x0[:100], y0[:100] = x0[100:200].round(), y0[100:200].round()
    xs, ys = np.stack([x0, x0 + w, x0 + w, x0], 1), np.stack([y0, y0, y0 + w, y0 + w], 1)
    x1, y1, x2, y2 = (v.ravel() for v in (xs, ys, np.roll(xs, -1, 1), np.roll(ys, -1, 1)))
    edges = pa.StructArray.from_arrays([pa.array(v) for v in (x1, y1, x2, y2, x2 - x1, y2 - y1)], ["x1", "y1", "x2", "y2", "dx", "dy"])
    flips = pa.ListArray.from_arrays(np.r_[np.arange(held + 1), np.full(n - held, held)].astype("int32"), pa.array(np.where(np.arange(held) % 70 == 0, 5.5, np.inf)))
    values = [["m", "o"] * (n // 2), [f"P{i}" if i % 70 else None for i in range(n)], [f"P{i}" for i in range(n)], pa.ListArray.from_arrays(np.arange(0, 4 * n + 1, 4, "int32"), edges), flips]
    parts = pa.StructArray.from_arrays([v if isinstance(v, pa.Array) else pa.array(v) for v in values], ["layer", "name", "part", "edges", "flips"])
    cells = pa.table({"parts": pa.ListArray.from_arrays(np.array([0, n // 3, n], "int32"), parts)})
    tested = []
    stretches = boundaries._stretches
    monkeypatch.setattr(boundaries, "_stretches", lambda of, n, at, places: tested.append(n[of].sum() * places) or stretches(of, n, at, places))
    for points, tests in ((1, 32_768), (17, 50), (2000, 32_768)):
        monkeypatch.setattr(boundaries, "TALLY_TESTS", tests)
        x, y = random.uniform(0, 20, points), random.uniform(0, 20, points).round()
        x[: points // 4] = x[: points // 4].round()
        tested.clear()
        kinds, found = boundaries._tallies(cells, x, y, 5.0)
        keys, inside, away = boundaries._tests(cells, x, y)
        layer = np.array([key[0] for key in keys])
        for number, (of, within) in enumerate(kinds):
            mine = (layer == of)[:, None] & (inside if within else ~inside & (away <= 5.0))
            assert (found[:, number] == mine.sum(axis=0)).all()
    assert sum(tested) * 3 < 2000 * (len(edges) + held)


def test_places_are_tested_in_as_many_tasks_as_the_tests_need(spark, monkeypatch):
    """A small file of points among many polygons was one task."""
    monkeypatch.setattr(boundaries, "TASK_TESTS", 20_000, raising=False)
    points, polygons = crowd(spark)
    joined = places.place_join(points, polygons, cell=50.0)
    assert joined.rdd.getNumPartitions() > 3
    assert joined.count() >= 3040


def test_shuffles_of_nights_are_as_wide_as_the_nights_are_large(spark, monkeypatch):
    monkeypatch.setattr(session, "TASK_BYTES", 200)
    nights = spark.range(2000).selectExpr("concat('ab-', id) as property_ID", "date'2024-01-01' as date", "'A' as status")
    property = nights.selectExpr("property_ID", "date'2024-01-01' as created", "date'2024-01-31' as scraped")
    width = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    assert route_daily(materialize(nights), property).filter("route = 'active'").count() == 2000
    assert int(spark.conf.get(width)) > 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    tune(spark)
    assert spark.conf.get(width, None) is None
