from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from roomledger.operators import boundaries, geocode, hulls, places

POLYGONS = "layer string, name string, part string, ring array<struct<x:double,y:double>>"
CELL = 40_000.0


def ring(points):
    return [{"x": float(x), "y": float(y)} for x, y in points]


def square(x, y, side):
    return [(x, y), (x + side, y), (x + side, y + side), (x, y + side)]


def star_shapes(seed):
    """Jagged polygons, every third with a hole."""
    dice = random.Random(seed)
    rows = []
    for n in range(10):
        cx, cy, corners = dice.uniform(-4e5, 4e5), dice.uniform(-4e5, 4e5), dice.randint(5, 40)
        turn = [2 * math.pi * i / corners for i in range(corners)]
        outer = [(cx + dice.uniform(0.2, 1) * 3e5 * math.cos(t), cy + dice.uniform(0.2, 1) * 3e5 * math.sin(t)) for t in turn]
        rows.append(("m", f"P{n}", f"P{n}", ring(outer)))
        if n % 3 == 0:
            rows.append(("m", f"P{n}", f"P{n}", ring([(cx + (x - cx) * 0.1, cy + (y - cy) * 0.1) for x, y in outer])))
    return rows


def edges_of(rows):
    edges = {}
    for _, name, _, points in rows:
        pairs = zip(points, points[1:] + points[:1])
        edges.setdefault(name, []).extend((a["x"], a["y"], b["x"], b["y"]) for a, b in pairs)
    return edges


def gap(edge, px, py):
    x1, y1, x2, y2 = edge
    dx, dy = x2 - x1, y2 - y1
    length = dx * dx + dy * dy
    t = max(0.0, min(1.0, ((px - x1) * dx + (py - y1) * dy) / length)) if length else 0.0
    return math.hypot(x1 + t * dx - px, y1 + t * dy - py)


def brute(edges, px, py):
    """name -> (inside, distance) by testing every edge."""
    found = {}
    for name, listed in edges.items():
        crossed = sum((y1 > py) != (y2 > py) and px < x1 + (py - y1) * (x2 - x1) / (y2 - y1) for x1, y1, x2, y2 in listed)
        away = min(gap(e, px, py) for e in listed)
        inside = crossed % 2 == 1 or away <= 1e-6
        found[name] = (inside, 0.0 if inside else away)
    return found


@pytest.mark.parametrize("seed, cell", [(3, CELL), (4, 130_000.0)])
def test_index_equals_brute_force_and_nearest_finds_all(spark, seed, cell):
    rows = star_shapes(seed)
    edges = edges_of(rows)
    dice = random.Random(seed)
    points = {i: (dice.uniform(-9e5, 9e5), dice.uniform(-9e5, 9e5)) for i in range(800)}
    corners = [(a["x"], a["y"]) for a in rows[0][3]]
    points |= {1000 + i: xy for i, xy in enumerate(corners)}
    df = spark.createDataFrame([(i, *xy) for i, xy in points.items()], "id long, x double, y double")
    polygons = spark.createDataFrame(rows, POLYGONS)
    located = boundaries.locate(df, boundaries.boundary_index(polygons, cell=cell))
    hits = 0
    for r in located.collect():
        truth = {n: v for n, v in brute(edges, *points[r.id]).items() if v[1] <= 5000}
        assert {h.name: h.inside for h in r.hits} == {n: v[0] for n, v in truth.items()}
        assert all(abs(h.distance - truth[h.name][1]) < 1e-6 for h in r.hits)
        hits += len(truth)
    assert hits > 200
    search = boundaries.nearest_search(polygons, cell=cell)
    for r in boundaries.nearest(df, search).collect():
        truth = brute(edges, *points[r.id])
        assert r.near_name == min((v[1], n) for n, v in truth.items())[1]


def widest(index):
    """The most edges and flips that a row of an index has, counted in the row."""
    inner = F.aggregate("parts", F.lit(0), lambda n, part: n + F.size(part["edges"]) + F.size(part["flips"]))
    return index.cells.agg(F.max(inner)).first()[0]


@pytest.mark.parametrize("most, cell, limit", [(12, CELL, boundaries.BROADCAST_BYTES), (4, CELL, 0), (25, 300_000.0, 0)])
def test_cells_cut_in_four_equal_brute_force(spark, monkeypatch, most, cell, limit):
    """Cells of few edges, on several levels and, beside the reach, in several rows."""
    monkeypatch.setattr(boundaries, "HOT_ROWS", 10)
    rows = star_shapes(5)
    edges = edges_of(rows)
    dice = random.Random(9)
    points = {i: (dice.uniform(-7e5, 7e5), dice.uniform(-7e5, 7e5)) for i in range(400)}
    corners = [(a["x"], a["y"]) for row in rows for a in row[3]]
    points |= {1000 + i: xy for i, xy in enumerate(corners)}
    points |= {3000 + i: (x + dice.uniform(-6e3, 6e3), y + dice.uniform(-6e3, 6e3)) for i, (x, y) in enumerate(corners)}
    points |= {5000: (None, 1.0), 5001: (None, None)} | {6000 + i: corners[0] for i in range(50)}
    df = spark.createDataFrame([(i, *xy) for i, xy in points.items()], "id long, x double, y double")
    index = boundaries.boundary_index(spark.createDataFrame(rows, POLYGONS), cell=cell, most=most)
    assert index.depth >= 1 and widest(index) <= most
    found = boundaries.locate(df, index, limit=limit).collect()
    assert len(found) == len(points)
    for r in found:
        x, y = points[r.id]
        truth = {} if x is None else {n: v for n, v in brute(edges, x, y).items() if v[1] <= 5000}
        assert {h.name: h.inside for h in r.hits} == {n: v[0] for n, v in truth.items()}
        assert all(abs(h.distance - truth[h.name][1]) < 1e-6 for h in r.hits) and len(r.hits) == len(truth)


def coast(vertices):
    """A jagged ring, as a query makes it: no vertex list passes through the driver."""
    turn = f"i * {2 * math.pi / vertices}"
    far = f"(4e5 + 2e4 * sin(90 * {turn}) + 300 * sin(7001 * {turn}))"
    return f"""
        SELECT 'm' AS layer, 'coast' AS name, 'coast' AS part,
               transform(sequence(0, {vertices - 1}), i -> named_struct('x', {far} * cos({turn}), 'y', {far} * sin({turn}))) AS ring
    """


def test_a_coast_of_200000_vertices_has_bounded_rows(spark):
    outline = spark.sql(coast(200_000))
    index = boundaries.boundary_index(outline)
    assert widest(index) <= boundaries.MOST_ITEMS and index.cells.count() > 200
    probes = spark.sql("SELECT i AS id, 25 * i AS turn_i FROM range(8000) AS t(i)").selectExpr(
        "id", f"turn_i * {2 * math.pi / 200_000} AS turn").selectExpr(
        "id", "turn", "4e5 + 2e4 * sin(90 * turn) + 300 * sin(7001 * turn) AS far").selectExpr(
        "id", "far + (id % 5 - 2) * 2000 AS r", "turn", "far").selectExpr("id", "r * cos(turn) AS x", "r * sin(turn) AS y", "r - far AS out")
    found = boundaries.locate(probes, index).collect()
    assert len(found) == 8000
    for r in found:
        if abs(r.out) >= 2000:  # the probes on the line itself may lie a hair inside or outside
            assert len(r.hits) == 1 and r.hits[0].inside == (r.out < 0)
            assert r.hits[0].inside or r.hits[0].distance <= r.out + 1e-6
    blocks = boundaries.edge_blocks(outline)
    assert blocks.agg(F.max(F.size("edges"))).first()[0] <= boundaries.BLOCK_EDGES


@pytest.mark.parametrize("limit", [0, None])
def test_nearest_of_a_layer_however_far(spark, monkeypatch, limit):
    """Small blocks; some layers have no polygon, some points no coordinates; equal distances go to the least name."""
    if limit is not None:
        lookup = boundaries.lookup_join
        monkeypatch.setattr(boundaries, "lookup_join", lambda *a, **k: lookup(*a, **{**k, "limit": 0, "piece": 7}))
    dice = random.Random(4)
    rows = [(f"L{n % 3}", f"P{n}", "p", ring([(x * 6 + n * 3e5, y * 6 - n * 2e5) for x, y in square(0, 0, 1e4)])) for n in range(9)]
    rows += [("twin", "Z", "p", ring(square(0, 0, 100))), ("twin", "A", "p", ring(square(0, 0, 100)))]
    polygons = spark.createDataFrame(rows, POLYGONS)
    points = [(i, f"L{i % 4}", dice.uniform(-2e7, 2e7), dice.uniform(-3e7, 3e7)) for i in range(300)]
    points += [(400, "L0", None, 1.0), (401, None, 5e6, 5e6), (402, "twin", -9e6, 50.0), (403, "L1", 3e5, -2e5)]
    df = spark.createDataFrame(points, "id long, layer string, x double, y double")
    monkeypatch.setattr(boundaries, "BLOCK_EDGES", 3)
    search = boundaries.NearestSearch(
        boundaries.boundary_index(polygons, cell=CELL), boundaries.materialize(boundaries.edge_blocks(polygons, 3), "edge-blocks")
    )
    found = {r.id: r.near_name for r in boundaries.nearest(df, search, layer="layer").collect()}
    for i, layer, x, y in points:
        edges = edges_of([row for row in rows if row[0] == layer])
        want = None if x is None or not edges else min((v[1], n) for n, v in brute(edges, x, y).items())[1]
        assert found[i] == want
    assert len(found) == len(points) and found[402] == "A"


def test_line_corner_hole_and_reach(spark):
    rows = [("m", "A", "A", ring(square(0, 0, 100_000))), ("m", "A", "A", ring(square(40_000, 40_000, 20_000)))]
    probes = {
        "line": (50_000.0, 0.0), "corner": (100_000.0, 100_000.0), "hole": (50_000.0, 50_000.0), "body": (10_000.0, 10_000.0),
        "4.9 km": (-4_900.0, 50_000.0), "5.1 km": (-5_100.0, 50_000.0), "far": (9e5, 9e5),
    }
    df = spark.createDataFrame([(k, *v) for k, v in probes.items()], "id string, x double, y double")
    index = boundaries.boundary_index(spark.createDataFrame(rows, POLYGONS), cell=CELL)
    found = {r.id: [(h.inside, round(h.distance)) for h in r.hits] for r in boundaries.locate(df, index).collect()}
    assert found == {"line": [(True, 0)], "corner": [(True, 0)], "hole": [], "body": [(True, 0)],
                     "4.9 km": [(False, 4900)], "5.1 km": [], "far": []}


def test_cascade_passes_ties_and_scrapes(spark):
    main = [("A", square(0, 0, 100_000)), ("B", square(106_000, 0, 100_000)), ("C", square(0, 0, 50_000))]
    second = [("A", square(0, 200_000, 100_000)), ("D", square(0, 308_000, 50_000))]
    schema = "name string, ring array<struct<x:double,y:double>>"
    countries = spark.createDataFrame([(n, ring(p)) for n, p in main], schema)
    others = spark.createDataFrame([(n, ring(p)) for n, p in second], schema)
    rows = [
        ("claimed", "C", 10_000.0, 10_000.0, 1, "C"), ("first name", "B", 10_000.0, 10_000.0, 2, "A"),
        ("no polygon", "Z", 60_000.0, 60_000.0, 2, "A"), ("null claim", None, 60_000.0, 60_000.0, 2, "A"),
        ("nearer B", "A", 103_500.0, 50_000.0, 3, "B"), ("tie", None, 103_000.0, 50_000.0, 3, "A"),
        ("second set", None, 50_000.0, 250_000.0, 4, "A"), ("near second", None, 10_000.0, 304_000.0, 5, "A"),
        ("nowhere", "A", -90_000.0, -90_000.0, None, None),
    ]
    df = spark.createDataFrame(
        [r[:4] for r in rows], "property_ID string, country string, x double, y double"
    ).withColumn("region", F.lit("r")).withColumn("city", F.lit("c"))
    index = geocode.geocode_index(countries, others, cell=CELL)
    located = boundaries.locate(df, index)
    found = {r.property_ID: (r.geo_pass, r.country_geo) for r in geocode.geocode_cascade(located).collect()}
    assert found == {r[0]: r[4:] for r in rows}
    tied = {r.property_ID: r.candidates for r in geocode.tied(located, 3).collect()}
    assert tied == {"nearer B": ["A", "B"], "tie": ["A", "B"]}
    scrapes = spark.createDataFrame([
        ("nearer B", "A"), ("claimed", "B"), ("nowhere", "A"), ("second set", "D"), ("near second", "D"), ("null claim", None),
    ], "property_ID string, country_scrape string")
    final = {r.property_ID: (r.country, r.region) for r in geocode.locate_countries(df, index, scrapes).collect()}
    assert final["nearer B"] == ("A", "r") and final["claimed"] == ("C", "r") and final["nowhere"] == (None, None)
    assert final["second set"] == ("A", "r") and final["near second"] == ("D", "r") and final["null claim"] == ("A", "r")


def test_parts_merge_drop_and_rename(spark):
    names = ["Cyprus", "Northern Cyprus", "Akrotiri and Dhekelia", "Western Sahara", "Morocco", "Caspian Sea", "Macao", "Peru"]
    raw = spark.createDataFrame([(n, ring(square(i * 10, 0, 5))) for i, n in enumerate(names)], "name string, ring array<struct<x:double,y:double>>")
    first = boundaries.country_boundaries(raw)
    assert sorted((r.name, r.part) for r in first.collect()) == [
        ("Cyprus", "Akrotiri and Dhekelia"), ("Cyprus", "Cyprus"), ("Cyprus", "Northern Cyprus"), ("Macau", "Macao"),
        ("Morocco", "Morocco"), ("Morocco", "Western Sahara"), ("Peru", "Peru")]
    second = boundaries.alternative_boundaries(raw.union(raw.limit(1).selectExpr("'W. Sahara'", "ring")), first)
    assert {(r.name, r.part) for r in second.collect()} == {
        ("Cyprus", "Akrotiri and Dhekelia"), ("Cyprus", "Cyprus"), ("Cyprus", "Northern Cyprus"), ("Morocco", "Morocco"),
        ("Morocco", "Western Sahara"), ("Peru", "Peru")}
    index = boundaries.boundary_index(first, cell=100.0, reach=0.0)
    probe = spark.createDataFrame([(1, 12.0, 2.0)], "id long, x double, y double")
    assert [h.name for h in boundaries.locate(probe, index).first().hits] == ["Cyprus"]


def test_hulls_hold_their_points_and_survive_degenerate_groups(spark):
    dice = random.Random(8)
    rows = [("cloud", dice.uniform(0, 1e6), dice.uniform(0, 1e6)) for _ in range(5000)]
    rows += [("line", float(i), 2.0 * i) for i in range(30)] + [("two", 0.0, 0.0), ("two", 5.0, 1.0), ("one", 3.0, 3.0), ("one", 3.0, 3.0)]
    rows += [(None, 0.0, 0.0), (None, 4.0, 0.0), (None, 0.0, 4.0), (None, 1.0, 1.0), (None, None, 1.0)]
    df = spark.createDataFrame(rows, "country string, x double, y double").repartition(8)
    found = {r.country: [(p.x, p.y) for p in r.ring] for r in hulls.convex_hulls(df, ["country"]).collect()}
    assert sorted(found["line"]) == [(0.0, 0.0), (29.0, 58.0)]
    assert sorted(found["two"]) == [(0.0, 0.0), (5.0, 1.0)] and found["one"] == [(3.0, 3.0)]
    assert sorted(found[None]) == [(0.0, 0.0), (0.0, 4.0), (4.0, 0.0)]
    cloud = found["cloud"]
    assert set(cloud) <= {r[1:] for r in rows if r[0] == "cloud"}
    for (ax, ay), (bx, by) in zip(cloud, cloud[1:] + cloud[:1]):
        assert all((bx - ax) * (y - ay) - (by - ay) * (x - ax) >= -1e-3 for n, x, y in rows if n == "cloud")
    areas = hulls.country_hulls(df.filter("country is not null")).collect()
    assert [r.country for r in areas] == ["cloud"]


def test_tasks_that_pass_corners_on_early_lose_none(spark, monkeypatch):
    monkeypatch.setattr(hulls, "HELD_ROWS", 50)
    turn = [2 * math.pi * i / 400 for i in range(400)]
    df = spark.createDataFrame([("c", math.cos(t) * 1e5, math.sin(t) * 1e5) for t in turn], "k string, x double, y double")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "40")
    try:
        assert len(hulls.convex_hulls(df.coalesce(1), ["k"]).first().ring) == 400
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def hull_listings(spark):
    dice = random.Random(2)
    rows = []

    def add(country, region, n, x0):
        rows.extend((f"p{len(rows) + i}", country, region, x0 + dice.uniform(0, 1000), dice.uniform(0, 1000)) for i in range(n))

    add("P", "twenty", 20, 0)
    add("P", "nineteen", 19, 5000)
    add("Q", "twenty", 3, 9000)
    add("Canada", "maple", 30, 0)
    add("P", "known", 2, 10_000)
    add("R", "known", 30, 20_000)
    return spark.createDataFrame(rows, "property_ID string, country string, region string, x double, y double")


def test_hull_update_and_addition(spark):
    df = hull_listings(spark)
    old = spark.createDataFrame([("P", "known", ring([(10_000, 0), (10_900, 0), (10_400, 900)])), ("S", "old", ring([(0, 0), (1, 0), (0, 1)]))],
                                "country string, region string, ring array<struct<x:double,y:double>>")
    updated = {(r.country, r.region): len(r.ring) for r in hulls.hull_update(df, old).collect()}
    assert set(updated) == {("P", "known"), ("S", "old")} and updated[("S", "old")] == 3
    assert {(r.country, r.region) for r in hulls.hull_add(df, old).collect()} == {("P", "twenty")}
    refreshed = {(r.country, r.region) for r in hulls.refresh_hulls(df, old).collect()}
    assert refreshed == {("P", "known"), ("S", "old"), ("P", "twenty")}


def test_region_only_from_exactly_one_hull_of_the_own_country(spark):
    rings = [("P", "a", square(0, 0, 100)), ("P", "b", square(50, 0, 100)), ("Q", "c", square(0, 0, 30))]
    known = spark.createDataFrame([(c, r, ring(p)) for c, r, p in rings], "country string, region string, ring array<struct<x:double,y:double>>")
    rows = [("one", "P", None, 10.0, 10.0), ("two", "P", None, 70.0, 10.0), ("none", "P", None, 500.0, 10.0), ("foreign", "Q", None, 70.0, 10.0),
            ("has", "P", "z", 10.0, 10.0), ("null", None, None, 10.0, 10.0), ("line", "P", None, 0.0, 50.0)]
    df = spark.createDataFrame(rows, "property_ID string, country string, region string, x double, y double")
    found = {r.property_ID: r.region for r in hulls.region_from_hull(df, known, cell=40.0).collect()}
    assert found == {"one": "a", "two": None, "none": None, "foreign": None, "has": "z", "null": None, "line": "a"}


def test_places_are_joined_and_counted(spark):
    named = [("Halifax (RGM)", "1", square(0, 0, 10)), ("Halifax A (T)", "2", square(5, 0, 10)), ("Truro", "3", square(50, 0, 10))]
    listed = spark.createDataFrame([(n, p, ring(s)) for n, p, s in named], "name string, part string, ring array<struct<x:double,y:double>>")
    points = spark.createDataFrame([(1, 2.0, 2.0), (2, 7.0, 2.0), (3, 55.0, 5.0), (4, 99.0, 9.0)], "id long, x double, y double")
    joined = places.place_join(points, listed, cell=20.0)
    assert sorted((r.id, r.place or "") for r in joined.collect()) == [
        (1, "Halifax (RGM)"), (2, "Halifax (RGM)"), (2, "Halifax A (T)"), (3, "Truro"), (4, "")]
    assert {r.place: r.n for r in places.place_counts(joined).collect()} == {"Halifax": 3, None: 2}
    assert places.place_join(points, listed, cell=20.0, keep_all=False).count() == 4


def test_dissolved_outline_is_the_outline_of_the_union(spark):
    """Membership and distance by the outline are those of the union; the shared border is gone, a hole stays."""
    cells = [(0, 0), (10, 0), (20, 0), (0, 10), (20, 10), (0, 20), (10, 20), (20, 20)]  # a ring of squares around a hole
    rows = [("", "A", str(i), ring(square(x, y, 10)[:: 1 if i % 2 else -1])) for i, (x, y) in enumerate(cells)]
    closed = square(30, 0, 10) + [(30, 0)]  # another name's square, its first corner repeated
    rows += [rows[0], ("", "B", "b", ring(closed)), ("", "B", "empty", []), ("", "B", "null", None)]
    out = boundaries.dissolve(spark.createDataFrame(rows, POLYGONS)).collect()
    edges = {name: {((e.x1, e.y1), (e.x2, e.y2)) for e in out if e.name == name} for name in "AB"}
    assert len(out) == 16 + 4 and len(edges["A"]) == 16 and len(edges["B"]) == 4
    assert ((10.0, 0.0), (10.0, 10.0)) not in edges["A"] and ((10.0, 10.0), (10.0, 20.0)) in edges["A"]
    dice = random.Random(5)
    for _ in range(300):
        x, y = dice.uniform(-5, 35), dice.uniform(-5, 35)
        crossed = sum((a[1] > y) != (b[1] > y) and x < a[0] + (y - a[1]) * (b[0] - a[0]) / (b[1] - a[1]) for a, b in edges["A"])
        assert crossed % 2 == any(cx < x < cx + 10 and cy < y < cy + 10 for cx, cy in cells)
    assert boundaries.dissolve(spark.createDataFrame([], POLYGONS)).count() == 0
