"""Boundary polygons and their grid index.

Boundaries are rows (name, ring) with one row per ring, rings being arrays of
struct<x,y> in EPSG:3857. Several rings of one part may be islands or holes.

The index is a quadtree of cells with everything needed to decide a point of
the cell: per polygon the edges within reach of the cell, and the heights at
which the number of edges further right changes parity. A point looks up the
level of its cell; locating it is then one equi-join and one projection.
Where cells hold many edges, points and edges meet in groups of one cell.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roomledger import fixed_values as fixed
from roomledger.functions import geometry as geo
from roomledger.functions.columns import canonical, is_true, not_among
from roomledger.functions.joins import BROADCAST_BYTES, keep_in, keep_not_in, lookup_join, stored_bytes
from roomledger.session import materialize

CELL = 50_000.0
POLYGON = ["layer", "name", "part"]
IN_CELL = [*POLYGON, "cy", "cx"]
CELL_KEY = ["cell_level", "cell_x", "cell_y"]
EDGE = "struct<x1:double,y1:double,x2:double,y2:double,dx:double,dy:double>"
# Most edges and flips of a row of an index, and how often a cell is cut at most.
MOST_ITEMS = 1024
DEEPEST = 12
# Cells with more than one in so many of all lookups are hot.
HOT_ROWS = 1000
# Indexes whose rows have more edges and flips than this on average test their points in groups.
LIGHT_ITEMS = 32
# Edges of a task, and items of a task, from which an index is built.
TASK_EDGES = 20_000
TASK_ITEMS = 250_000
# Points of a group by the rows of its cell, points tested at once, tests of a task, and hits of a batch.
GROUP_POINTS = 4096
BLOCK_POINTS = 512
TASK_TESTS = 5_000_000
BATCH_HITS = 50_000
# Points of a group whose hits are tallied, squares of a square, points of the smallest ones, and tests made at once.
TALLY_POINTS = 65_536
TALLY_SPLIT = 4
TALLY_LEAF = 16
TALLY_TESTS = 32_768
# Edges of a block, and the squares that a search for the nearest narrows, from all of the plane.
BLOCK_EDGES = 256
SIDES = (2.0**25, 2.0**21, 2.0**17)
# Rounding of distances, in metres.
SLACK = 1e-3
HITS = "array<struct<layer:string,name:string,inside:boolean,distance:double>>"
TALLY = "array<struct<layer:string,name:string,inside:boolean,distance:double,n:bigint>>"


# --- names ------------------------------------------------------------------


def merge_parts(boundaries: DataFrame) -> DataFrame:
    """Relabel the parts of Cyprus and Morocco; ``part`` keeps their own name.

    A point is in the union of parts when it is in any of them, so no
    polygons need to be joined up.
    """
    name = F.coalesce(
        *[F.when(F.col("name").rlike(part), country) for country, part in fixed.MERGED_COUNTRIES.items()], F.col("name")
    )
    return boundaries.withColumn("part", F.col("name")).withColumn("name", name)


def country_boundaries(raw: DataFrame) -> DataFrame:
    """First boundary set: parts merged, unused territories dropped, names canonical."""
    merged = merge_parts(raw).filter(not_among(F.col("name"), fixed.BOUNDARY_DROPPED))
    return merged.withColumn("name", canonical(F.col("name"), fixed.BOUNDARY_SPELLINGS))


def alternative_boundaries(raw: DataFrame, countries: DataFrame) -> DataFrame:
    """Second boundary set: canonical names, parts merged, limited to the first set's names."""
    named = raw.withColumn("name", canonical(F.col("name"), fixed.ALT_BOUNDARY_SPELLINGS))
    merged = merge_parts(named).filter(not_among(F.col("name"), fixed.ALT_BOUNDARY_DROPPED))
    return keep_in(merged, countries, "name")


def active_boundaries(boundaries: DataFrame, property: DataFrame) -> DataFrame:
    """Only the polygons of countries that listings claim."""
    return keep_in(boundaries, property.select(F.col("country").alias("name")), "name")


# --- edges and cells --------------------------------------------------------


def ring_edges(boundaries: DataFrame) -> DataFrame:
    """One row per polygon edge: layer, name, part, x1, y1, x2, y2, dx, dy."""
    layer = F.col("layer") if "layer" in boundaries.columns else F.lit("")
    part = F.col("part") if "part" in boundaries.columns else F.col("name")
    n = F.size("ring")
    edges = F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda i: geo.as_edge(F.get("ring", i), F.get("ring", (i + 1) % n)),
    )
    rings = boundaries.filter(n > 0)
    return rings.select(layer.alias("layer"), F.col("name"), part.alias("part"), F.inline(edges))


def _dealt_edges(boundaries: DataFrame) -> DataFrame:
    """The edges of boundaries. Many are stored, dealt over as many tasks as they need: polygons may be one small file."""
    edges = ring_edges(boundaries)
    n = boundaries.agg(F.sum(F.greatest(F.size("ring"), F.lit(0)))).first()[0] or 0
    tasks = n // TASK_EDGES + 1
    return edges if tasks == 1 else materialize(edges.repartition(tasks, *edges.columns), "index-edges")


def dissolve(boundaries: DataFrame) -> DataFrame:
    """Outlines of names whose parts touch, one row per edge: layer, name, x1, y1, x2, y2, dx, dy.

    Parts may share corners and whole edges but not area, as in a boundary
    set. An edge that two parts of a name share is inside and goes, whichever
    way their rings turn; what is left bounds the union, holes included, so
    ray casting over it and distances to it are those of the union. Edges run
    from their lesser end; repeated parts count once, edges without length and
    empty or null rings not at all. Edges are counted by their ends, so no
    group grows with its name.
    """
    keys = [c for c in ("layer", "name", "ring") if c in boundaries.columns]
    edges = ring_edges(boundaries.select(*keys).distinct()).filter((F.col("dx") != 0) | (F.col("dy") != 0))
    ends = [F.struct(F.col(f"x{i}").alias("x"), F.col(f"y{i}").alias("y")) for i in (1, 2)]
    counted = edges.groupBy("layer", "name", F.least(*ends).alias("a"), F.greatest(*ends).alias("b")).agg(F.count("*").alias("n"))
    return counted.filter("n % 2 = 1").select("layer", "name", geo.as_edge(F.col("a"), F.col("b")).alias("edge")).select("layer", "name", "edge.*")


def _with_columns(rows: DataFrame, cell: float, margin: float) -> DataFrame:
    """Edges in a grid row ``cy`` with the columns they reach there, ``from_cx`` to ``to_cx``."""
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    bottom = F.greatest(low, F.col("cy") * F.lit(cell) - margin)
    top = F.least(high, (F.col("cy") + 1) * F.lit(cell) + margin)
    slope = (F.col("x2") - F.col("x1")) / F.nullif(F.col("y2") - F.col("y1"), F.lit(0.0))
    at_bottom = F.coalesce(F.col("x1") + (bottom - F.col("y1")) * slope, F.col("x1"))
    at_top = F.coalesce(F.col("x1") + (top - F.col("y1")) * slope, F.col("x2"))
    return rows.withColumn("from_cx", geo.grid(F.least(at_bottom, at_top) - margin, cell)).withColumn(
        "to_cx", geo.grid(F.greatest(at_bottom, at_top) + margin, cell)
    )


def _edges_by_row(edges: DataFrame, cell: float, margin: float) -> DataFrame:
    """Each edge in every grid row within the margin, with the columns it reaches there."""
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    rows = F.explode(F.sequence(geo.grid(low - margin, cell), geo.grid(high + margin, cell)))
    return _with_columns(edges.withColumn("cy", rows), cell, margin)


def _odd(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur an odd number of times."""
    return df.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") % 2 == 1).drop("_n")


def _edge_items(near: DataFrame) -> DataFrame:
    return near.select(*IN_CELL, F.struct("x1", "y1", "x2", "y2", "dx", "dy").alias("edge"), F.lit(None).cast("double").alias("flip"))


def _flip_items(flips: DataFrame, flip: Column) -> DataFrame:
    return flips.select(*IN_CELL, F.lit(None).cast(EDGE).alias("edge"), flip.alias("flip"))


def _items(edges: DataFrame, cell: float, margin: float) -> DataFrame:
    """What a point has to look at, a row each: layer, name, part, cy, cx, and an edge near the cell or the height of a flip.

    A polygon that holds a whole cell has one flip there, at infinity.
    """
    row_key = [*POLYGON, "cy"]
    by_row = _edges_by_row(edges, cell, margin)
    near = by_row.withColumn("cx", F.explode(F.sequence("from_cx", "to_cx")))

    # Ends of edges inside or above a row, the latter moved to its top. Ends
    # shared by two edges that start in the same column cancel, which leaves
    # few; an edge counts for the cells left of all the columns it reaches.
    floor_y = F.col("cy") * F.lit(cell)
    top_y = (F.col("cy") + 1) * F.lit(cell)
    ends = by_row.select(*row_key, "from_cx", F.explode(F.array("y1", "y2")).alias("y"))
    ends = ends.filter(F.col("y") > floor_y).withColumn("y", F.least("y", top_y))
    ends = _odd(ends, [*row_key, "from_cx", "y"])

    # Cells between two cells with edges are wholly inside or outside: the
    # first one of each gap is decided and stands for the rest.
    along = Window.partitionBy(*row_key).orderBy("cx")
    border = near.select(*IN_CELL).distinct()
    spans = border.withColumn("next_cx", F.lead("cx").over(along))
    gaps = spans.filter(F.col("next_cx") - F.col("cx") > 1)
    gaps = gaps.select(*row_key, (F.col("cx") + 1).alias("cx"), (F.col("next_cx") - 1).alias("last_cx"))
    wanted = border.select(*IN_CELL, F.lit(None).cast("long").alias("last_cx")).unionByName(gaps)
    flips = wanted.join(ends, row_key).filter(F.col("from_cx") > F.col("cx"))
    flips = _odd(flips, [*IN_CELL, "last_cx", "y"])

    crossed = flips.filter(F.col("last_cx").isNull())
    held = _odd(flips.filter(F.col("last_cx").isNotNull()), [*IN_CELL, "last_cx"])
    held = held.select(*row_key, F.explode(F.sequence("cx", "last_cx")).alias("cx"))
    return _edge_items(near).unionByName(_flip_items(crossed, F.col("y"))).unionByName(_flip_items(held, F.lit(float("inf"))))


def _quarters(items: DataFrame, cell: float, margin: float) -> DataFrame:
    """The items of cells cut in four; ``cell`` is the side of a quarter.

    A quarter follows from its own cell: of the edges near the cell, those
    left of the quarter do not matter, those right of it leave their ends as
    flips, and flips of the cell are those of its quarters.
    """
    rows = F.array(2 * F.col("cy"), 2 * F.col("cy") + 1)
    columns = F.array(2 * F.col("cx"), 2 * F.col("cx") + 1)
    cut = items.withColumn("cy", F.explode(rows)).withColumn("cx", F.explode(columns))
    floor_y = F.col("cy") * F.lit(cell)
    top_y = (F.col("cy") + 1) * F.lit(cell)

    edges = cut.filter(F.col("edge").isNotNull()).select(*IN_CELL, "edge.*")
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    edges = edges.filter((geo.grid(low - margin, cell) <= F.col("cy")) & (F.col("cy") <= geo.grid(high + margin, cell)))
    edges = _with_columns(edges, cell, margin)
    near = edges.filter(F.col("cx").between(F.col("from_cx"), F.col("to_cx")))

    ends = edges.filter(F.col("from_cx") > F.col("cx")).select(*IN_CELL, F.explode(F.array("y1", "y2")).alias("y"))
    known = cut.filter(F.col("flip") < float("inf")).select(*IN_CELL, F.col("flip").alias("y"))
    flips = ends.unionByName(known).filter(F.col("y") > floor_y).withColumn("y", F.least("y", top_y))
    flips = _odd(flips, [*IN_CELL, "y"])

    # Without an edge nearby a quarter is wholly inside or outside.
    border = near.select(*IN_CELL).distinct()
    crossed = keep_in(flips, border, *IN_CELL, unique=True)
    held = _odd(keep_not_in(flips, border, *IN_CELL, unique=True), IN_CELL)
    held = held.unionByName(cut.filter(F.col("flip") == float("inf")).select(*IN_CELL))
    return _edge_items(near).unionByName(_flip_items(crossed, F.col("y"))).unionByName(_flip_items(held, F.lit(float("inf"))))


@dataclass
class GridIndex:
    """A stored index: its cells with what points have to look at there.

    ``cells`` has rows (cell_level, cell_x, cell_y, piece, pieces, parts,
    weight); ``parts`` has one entry per polygon that covers or comes near the
    cell: layer, name, part, edges, flips. ``cut`` has the keys of the cells
    that are cut in four, ``items`` is the mean weight.
    """

    cells: DataFrame
    cut: DataFrame
    cell: float
    reach: float
    depth: int
    pieces: int
    items: float


def _cells(items: DataFrame, most: int, crowded: bool) -> DataFrame:
    """Rows of an index from items of cells with ``cell_level``; a crowded cell is several rows."""
    keyed = items.withColumnRenamed("cx", "cell_x").withColumnRenamed("cy", "cell_y")
    piece = F.lit(0)
    if crowded:
        in_cell = Window.partitionBy(*CELL_KEY).orderBy(*POLYGON, "edge", "flip")
        piece = F.floor((F.row_number().over(in_cell) - 1) / most).cast("int")
    parts = keyed.withColumn("piece", piece).groupBy(*CELL_KEY, "piece", *POLYGON).agg(
        F.collect_list("edge").alias("edges"), F.collect_list("flip").alias("flips"), F.count("*").alias("n")
    )
    rows = parts.groupBy(*CELL_KEY, "piece").agg(
        F.collect_list(F.struct(*POLYGON, "edges", "flips")).alias("parts"), F.sum("n").alias("weight")
    )
    pieces = F.lit(1)
    if crowded:
        pieces = (F.max("piece").over(Window.partitionBy(*CELL_KEY)) + 1).cast("int")
    return rows.withColumn("pieces", pieces)


def boundary_index(
    boundaries: DataFrame, *, cell: float = CELL, reach: float = fixed.REACH, most: int = MOST_ITEMS
) -> GridIndex:
    """The stored grid index of boundaries, an adaptive quadtree of cells.

    A point of a cell is inside a polygon when the number of flips above it
    plus the number of edges its ray towards +x crosses is odd. Edges are
    taken whole, so the test gives exactly the answer of casting the ray
    against the full polygon. Cells with more than ``most`` edges and flips
    are cut in four, again and again. Cells that are small beside the reach
    have the same edges within it as their neighbours, so cutting them would
    not help: what is crowded there is divided over several rows, of which a
    point reads all. No row has more than ``most`` edges and flips. Boundaries
    seldom change: keep the index and reuse it.
    """
    margin = reach + 1.0
    spark = boundaries.sparkSession
    items = materialize(_items(_dealt_edges(boundaries), cell, margin), "index-items")
    side, level, most_here, total = cell, 0, 0, 0
    leaves, cut = [], []
    while True:
        weights = items.groupBy("cx", "cy").agg(F.count("*").alias("n"))
        most_here, here = (n or 0 for n in weights.agg(F.max("n"), F.sum("n")).first())
        total += here
        if most_here <= most or side <= max(reach, cell / 2**DEEPEST):
            break
        heavy = materialize(weights.filter(F.col("n") > most).select("cx", "cy"), "index-cut")
        leaves.append(keep_not_in(items, heavy, "cx", "cy", unique=True).withColumn("cell_level", F.lit(level)))
        cut.append(heavy.select(F.lit(level).alias("cell_level"), F.col("cx").alias("cell_x"), F.col("cy").alias("cell_y")))
        side, level = side / 2, level + 1
        quarters = _quarters(keep_in(items, heavy, "cx", "cy", unique=True), side, margin)
        items = materialize(quarters, "index-items")
    crowded = most_here > most
    leaves.append(items.withColumn("cell_level", F.lit(level)))
    found = reduce(DataFrame.unionByName, leaves)
    if crowded:
        found = found.repartition(total // TASK_ITEMS + 1, "cell_level", "cx", "cy")
    rows = materialize(_cells(found, most, crowded), "index")
    none = spark.createDataFrame([], "cell_level int, cell_x long, cell_y long")
    divided = materialize(reduce(DataFrame.unionByName, cut), "index-cut") if cut else none
    items = rows.agg(F.avg("weight")).first()[0] or 0.0
    return GridIndex(rows, divided, cell, reach, level, -(-most_here // most) if crowded else 1, items)


# --- points -----------------------------------------------------------------


def with_xy(points: DataFrame, longitude: str = "longitude", latitude: str = "latitude") -> DataFrame:
    """Adds EPSG:3857 coordinates x and y."""
    return points.withColumn("x", geo.mercator_x(F.col(longitude))).withColumn("y", geo.mercator_y(F.col(latitude)))


def _tested(part: Column, x: Column, y: Column) -> Column:
    """A polygon of the cell with its crossings and its distance, as far as this row of the cell knows them."""
    above = F.size(F.filter(part["flips"], lambda flip: flip > y))
    crossed = F.aggregate(
        part["edges"], F.lit(0), lambda n, edge: n + F.when(geo.crosses(edge, x, y), 1).otherwise(0)
    )
    return F.struct(
        part["layer"].alias("layer"),
        part["name"].alias("name"),
        part["part"].alias("part"),
        (above + crossed).alias("crossed"),
        geo.nearest_edge(part["edges"], x, y).alias("away"),
    )


def _hit(tested: Column) -> Column:
    inside = is_true(tested["crossed"] % 2 == 1) | is_true(tested["away"] <= geo.ON_LINE)
    return F.struct(
        tested["layer"].alias("layer"),
        tested["name"].alias("name"),
        inside.alias("inside"),
        F.when(inside, F.lit(0.0)).otherwise(tested["away"]).alias("distance"),
    )


def _tallied(hits: Column) -> Column:
    """One entry for the hits of a layer that hold the point, one for those within reach, with their number."""
    key = lambda hit: F.struct(hit["layer"], hit["inside"])
    entry = lambda one: F.struct(
        one["layer"], F.lit(None), one["inside"], F.lit(None), F.size(F.filter(hits, lambda hit: key(hit) == one))
    )
    return F.transform(F.array_distinct(F.transform(hits, key)), entry).cast(TALLY)


def _addressed(points: DataFrame, index: GridIndex) -> DataFrame:
    """Points with the key of their cell: down from the whole cell for as long as it is cut."""

    def at(level: int) -> list[Column]:
        side = index.cell / 2**level
        return [F.lit(level), geo.grid(F.col("x"), side), geo.grid(F.col("y"), side)]

    found = points
    for name, value in zip(CELL_KEY, at(0)):
        found = found.withColumn(name, value)
    for level in range(index.depth):
        known = lookup_join(found, index.cut.withColumn("_cut", F.lit(True)), CELL_KEY, "left", stored=True)
        deeper = [F.when(F.col("_cut"), value).otherwise(F.col(name)).alias(name) for name, value in zip(CELL_KEY, at(level + 1))]
        found = known.select(*points.columns, *deeper)
    return found


def _met(points: DataFrame, index: GridIndex, limit: int) -> DataFrame:
    """Addressed points with the rows of their cell, a row each.

    An index beyond the broadcast limit is shuffled with the points by cell.
    Crowded cells, each with more than one in ``HOT_ROWS`` of all pairs, are
    ``HOT_ROWS`` rows of at most the index's ``most`` edges: these are sent to
    all tasks, so their points stay where they are and no row is copied per
    piece of a hot cell.
    """
    extra = [c for c in index.cells.columns if c not in CELL_KEY]
    if stored_bytes(index.cells) <= limit:
        return lookup_join(points, index.cells, CELL_KEY, "left", stored=True, limit=limit)
    placed = points.filter(F.col("x").isNotNull() & F.col("y").isNotNull())
    loads = placed.groupBy(*CELL_KEY).agg(F.count("*").alias("n"))
    loads = materialize(loads.join(index.cells.select(*CELL_KEY, "pieces").distinct(), CELL_KEY), "cell-loads")
    pairs = loads.agg(F.sum(F.col("n") * F.col("pieces"))).first()[0] or 0
    hot = materialize(loads.filter(F.col("n") * HOT_ROWS > pairs).select(*CELL_KEY), "hot-cells")
    in_hot = F.broadcast(hot)
    sent = index.cells.join(in_hot, CELL_KEY, "left_semi")
    near = placed.join(in_hot, CELL_KEY, "left_semi").join(F.broadcast(sent), CELL_KEY)
    others = placed.join(in_hot, CELL_KEY, "left_anti")
    # only cells with points take part in the shuffle
    rest = others.join(index.cells.join(in_hot, CELL_KEY, "left_anti").hint("shuffle_hash"), CELL_KEY, "left")
    nowhere = points.filter(F.col("x").isNull() | F.col("y").isNull())
    columns = [*points.columns, *extra]
    return near.select(*columns).unionByName(rest.select(*columns)).unionByName(nowhere, allowMissingColumns=True)


def _polygons(cells: pa.Table) -> tuple[list[tuple], np.ndarray, np.ndarray, dict[str, np.ndarray], np.ndarray]:
    """The rows of a cell as polygons: their keys; edges by polygon and fields; flips by polygon and heights."""
    parts = cells.column("parts").combine_chunks().flatten()
    fields = dict(zip([f.name for f in parts.type], parts.flatten()))
    numbers: dict[tuple, int] = {}
    keys = zip(*(fields[k].to_pylist() for k in POLYGON))
    of = np.array([numbers.setdefault(key, len(numbers)) for key in keys], dtype=np.int64)
    found = []
    for name in ("edges", "flips"):
        each = np.repeat(of, fields[name].value_lengths().to_numpy(zero_copy_only=False))
        order = np.argsort(each, kind="stable")
        found.append((each[order], fields[name].flatten().take(pa.array(order))))
    (edge_of, edges), (flip_of, flips) = found
    columns = {f.name: c.to_numpy(zero_copy_only=False) for f, c in zip(edges.type, edges.flatten())}
    return list(numbers), edge_of, flip_of, columns, flips.to_numpy(zero_copy_only=False)


def _blocks(of: np.ndarray) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Stretches of sorted polygon numbers: the stretch, its polygons, and where each begins in it."""
    for low in range(0, len(of), BLOCK_EDGES):
        part = of[low : low + BLOCK_EDGES]
        starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
        yield slice(low, low + len(part)), part[starts], starts


def _edge_tests(edges: dict[str, np.ndarray], at: slice | np.ndarray, px: np.ndarray, py: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether the rays from places cross edges, a row each, and the squares of the distances to them."""
    x1, y1, y2, dx, dy = (edges[c][at, None] for c in ("x1", "y1", "y2", "dx", "dy"))
    rx, ry = px - x1, py - y1
    length = dx * dx + dy * dy
    with np.errstate(divide="ignore", invalid="ignore"):
        crosses = ((y1 > py) != (y2 > py)) & (px < x1 + ry * dx / dy)
        share = np.where(length > 0, (rx * dx + ry * dy) / length, 0.0).clip(0.0, 1.0)
    x, y = x1 + share * dx - px, y1 + share * dy - py
    return crosses, x * x + y * y


def _tests(cells: pa.Table, x: np.ndarray, y: np.ndarray) -> tuple[list[tuple], np.ndarray, np.ndarray]:
    """Every polygon of a cell against every point: the polygons' keys, whether inside, and the distance to the edges known there."""
    keys, edge_of, flip_of, edges, flips = _polygons(cells)
    odd = np.zeros((len(keys), len(x)), dtype=bool)
    away = np.full((len(keys), len(x)), np.inf)
    for low in range(0, len(x), BLOCK_POINTS):
        few = slice(low, low + BLOCK_POINTS)
        px, py = x[None, few], y[None, few]
        for at, of, starts in _blocks(flip_of):
            odd[of, few] ^= np.logical_xor.reduceat(flips[at, None] > py, starts)
        for at, of, starts in _blocks(edge_of):
            crosses, near = _edge_tests(edges, at, px, py)
            odd[of, few] ^= np.logical_xor.reduceat(crosses, starts)
            away[of, few] = np.minimum(away[of, few], np.minimum.reduceat(near, starts))
    np.sqrt(away, out=away)
    return keys, odd | (away <= geo.ON_LINE), away


def _grouped(batches: Iterator[pa.RecordBatch], kept: list[str]) -> tuple[pa.Table, list[pa.Array], np.ndarray, np.ndarray]:
    """A group taken apart: the rows of its cell, the fields of its points, and their coordinates."""
    table = pa.Table.from_batches(list(batches))
    is_point = table.column("parts").is_null()
    fields = table.filter(is_point).column("point").combine_chunks().flatten()
    x, y = (fields[kept.index(c)].cast(pa.float64()).to_numpy(zero_copy_only=False) for c in ("x", "y"))
    return table.filter(pa.compute.invert(is_point)), fields, x, y


def _group_hits(kept: list[str], column: str, reach: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Group function: points of one cell with their hits among all rows of the cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, fields, x, y = _grouped(batches, kept)
        keys, inside, away = _tests(cells, x, y)
        distance = np.where(inside, 0.0, away)
        within = distance <= reach
        counts = within.sum(axis=0)
        layers, names = (pa.array([key[k] for key in keys], pa.string()) for k in (0, 1))
        low = 0
        while low < len(x):
            high = low + max(1, int(np.searchsorted(np.cumsum(counts[low:]), BATCH_HITS)))
            rows, found = np.nonzero(within[:, low:high].T)
            at, taken = (found, rows + low), pa.array(found)
            hits = [layers.take(taken), names.take(taken), pa.array(inside[at]), pa.array(distance[at])]
            ends = np.r_[0, np.cumsum(counts[low:high])].astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(hits, ["layer", "name", "inside", "distance"]))
            own = [f.slice(low, len(lists)) for f in fields]
            yield pa.RecordBatch.from_arrays([*own, lists], [*kept, column])
            low = high

    return run


def _squares(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, int]:
    """Points in an order in which stretches of 1, 4, 16 and so on of all are near each other, and the number of halvings.

    The last stretches are as large as each other: some points may come twice.
    """
    halvings = 0
    while TALLY_LEAF * TALLY_SPLIT**halvings < len(x):
        halvings += 1
    leaves = TALLY_SPLIT**halvings
    order = np.resize(np.arange(len(x)), (1, leaves * -(-len(x) // leaves)))
    while len(order) < leaves:
        ax, ay = x[order], y[order]
        wide = np.ptp(ax, axis=1) >= np.ptp(ay, axis=1)
        along = np.argsort(np.where(wide[:, None], ax, ay), axis=1)
        order = np.take_along_axis(order, along, axis=1).reshape(2 * len(order), -1)
    return order.ravel(), halvings


class _Outlines:
    """The polygons of a cell, their edges and flips next to each other, to be tested against a few places each."""

    def __init__(self, cells: pa.Table) -> None:
        self.keys, edge_of, flip_of, self.edges, self.flips = _polygons(cells)
        self.edge_n, self.flip_n = (np.bincount(of, minlength=len(self.keys)) for of in (edge_of, flip_of))
        self.edge_at, self.flip_at = (np.cumsum(n) - n for n in (self.edge_n, self.flip_n))
        dx, dy = self.edges["dx"], self.edges["dy"]
        length = dx * dx + dy * dy
        with np.errstate(divide="ignore", invalid="ignore"):
            self.along_x, self.along_y = (np.where(length > 0, d / length, 0.0) for d in (dx, dy))
            self.slope = dx / dy

    def tests(self, of: np.ndarray, px: np.ndarray, py: np.ndarray, exact: bool, outside: bool) -> tuple[np.ndarray, np.ndarray]:
        """Whether polygon ``of[i]`` holds the places (px[i], py[i]), and how far they are from its edges.

        If not ``exact``, distances are right to less than ``SLACK`` and the
        former holds for places farther from the edges than that. Places known
        to be ``outside`` are only measured.
        """
        odd, away = np.zeros(px.shape, dtype=bool), np.full(px.shape, np.inf)
        if not outside:
            for some, at, rows, starts in _stretches(of, self.flip_n, self.flip_at, px.shape[1]):
                odd[some] ^= np.logical_xor.reduceat(self.flips[at, None] > py[rows], starts)
        for some, at, rows, starts in _stretches(of, self.edge_n, self.edge_at, px.shape[1]):
            pairs = at, px[rows], py[rows]
            crosses, near = _edge_tests(self.edges, *pairs) if exact else (outside or self._crosses(*pairs), self._measured(*pairs))
            if not outside:
                odd[some] ^= np.logical_xor.reduceat(crosses, starts)
            away[some] = np.minimum(away[some], np.minimum.reduceat(near, starts))
        return odd, np.sqrt(away, out=away)

    def _crosses(self, at: np.ndarray, px: np.ndarray, py: np.ndarray) -> np.ndarray:
        """Whether the rays from places cross edges, by what is known of the edges."""
        x1, y1, y2 = (self.edges[c][at, None] for c in ("x1", "y1", "y2"))
        with np.errstate(invalid="ignore"):
            return ((y1 > py) != (y2 > py)) & (px - x1 < (py - y1) * self.slope[at, None])

    def _measured(self, at: np.ndarray, px: np.ndarray, py: np.ndarray) -> np.ndarray:
        """The squares of the distances to edges, by what is known of the edges."""
        x1, y1, dx, dy = (self.edges[c][at, None] for c in ("x1", "y1", "dx", "dy"))
        rx, ry = px - x1, py - y1
        with np.errstate(invalid="ignore"):
            share = rx * self.along_x[at, None]
            share += ry * self.along_y[at, None]
            np.maximum(share, 0.0, out=share)
            np.minimum(share, 1.0, out=share)
            rx -= share * dx
            ry -= share * dy
            rx *= rx
            ry *= ry
            rx += ry
        return rx


def _stretches(of: np.ndarray, n: np.ndarray, at: np.ndarray, places: int) -> Iterator[tuple]:
    """Items of polygons ``of``, for ``TALLY_TESTS`` tests at once: whose, which, of which pair, and where each pair begins."""
    ends = np.cumsum(n[of])
    begins = ends - n[of]
    total = int(ends[-1]) if len(ends) else 0
    most = max(1, TALLY_TESTS // places)
    for low in range(0, total, most):
        high = min(low + most, total)
        some = np.arange(np.searchsorted(ends, low, "right"), np.searchsorted(begins, high, "left"))
        some = some[begins[some] < ends[some]]
        first = np.maximum(begins[some], low)
        lengths = np.minimum(ends[some], high) - first
        starts = first - low
        items = np.arange(high - low) + np.repeat(at[of[some]] - begins[some] + low, lengths)
        yield some, items, np.repeat(some, lengths), starts


def _tallies(cells: pa.Table, x: np.ndarray, y: np.ndarray, reach: float) -> tuple[list[tuple], np.ndarray]:
    """Of every point the number of polygons of each kind: a layer, and whether they hold the point or are in reach only.

    Points are halved into squares. The middle of a square decides for all of
    it where a polygon's outline, and the reach, are farther from there than
    any point of the square; the others are tested in its smaller squares and
    last at its points, those within rounding of a decision as ``_tests`` does.
    """
    outlines = _Outlines(cells)
    numbers: dict[str | None, int] = {}
    layer_of = np.array([numbers.setdefault(key[0], len(numbers)) for key in outlines.keys], dtype=np.int64)
    # polygons without a name have no flips in an index, so theirs are not whole outlines
    named = np.array([None not in key for key in outlines.keys], dtype=bool)
    kinds = [(layer, inside) for layer in numbers for inside in (False, True)]
    if not len(x):
        return kinds, np.zeros((0, len(kinds)), dtype=np.int64)
    order, depth = _squares(x, y)
    ox, oy = x[order], y[order]
    # middles and radii of the squares by level, then the points, and once more for what has to be exact
    levels = []
    for level in range(depth + 1):
        xs, ys = (v.reshape(TALLY_SPLIT**level, -1) for v in (ox, oy))
        mx, my = ((v.min(axis=1) + v.max(axis=1)) / 2 for v in (xs, ys))
        levels.append((mx, my, np.hypot(xs - mx[:, None], ys - my[:, None]).max(axis=1)))
    levels += [(ox, oy, np.zeros(len(order))), (ox, oy, None)]
    counts = [np.zeros((len(mx), len(kinds)), dtype=np.int64) for mx, _, _ in levels]
    left = [(0, np.zeros(len(layer_of), dtype=np.int64), np.arange(len(layer_of)), False)]
    while left:
        level, above, of, outside = left.pop()
        mx, my, radius = levels[level]
        split = len(mx) // len(levels[max(level - 1, 0)][0])
        square = above[:, None] * split + np.arange(split)
        inside, away = outlines.tests(of, mx[square], my[square], exact=radius is None, outside=outside)
        if radius is None:
            inside |= away <= geo.ON_LINE
            counted, parts = inside | (away <= reach), []
        else:
            far = radius[square] + SLACK
            whole = (away > far) & named[of, None]
            counted = whole & (inside | (away < reach - far))
            beside = whole & ~counted & ~(away > reach + far)
            parts = [(beside, True), (~whole, False)]
        polygon = np.broadcast_to(of[:, None], square.shape)
        kind = square[counted] * len(kinds) + 2 * layer_of[polygon[counted]] + inside[counted]
        counts[level] += np.bincount(kind, minlength=counts[level].size).reshape(counts[level].shape)
        for part, known in parts:
            above, of = square[part], polygon[part]
            left += [(level + 1, above[low : low + TALLY_TESTS], of[low : low + TALLY_TESTS], known) for low in range(0, len(of), TALLY_TESTS)]
    total = counts[0]
    for more in counts[1:]:
        total = np.repeat(total, len(more) // len(total), axis=0) + more
    found = np.empty((len(x), len(kinds)), dtype=np.int64)
    found[order] = total
    return kinds, found


def _group_tallies(kept: list[str], column: str, reach: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Group function: points of one cell with the numbers of their hits among all rows of the cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, fields, x, y = _grouped(batches, kept)
        kinds, found = _tallies(cells, x, y, reach)
        rows, taken = np.nonzero(found)
        layers, inside = (pa.array([kind[k] for kind in kinds], of).take(pa.array(taken)) for k, of in ((0, pa.string()), (1, pa.bool_())))
        unnamed, nowhere = pa.nulls(len(taken), pa.string()), pa.nulls(len(taken), pa.float64())
        entries = pa.StructArray.from_arrays([layers, unnamed, inside, nowhere, pa.array(found[rows, taken])], ["layer", "name", "inside", "distance", "n"])
        ends = np.r_[0, np.cumsum((found > 0).sum(axis=1))].astype(np.int32)
        yield pa.RecordBatch.from_arrays([*fields, pa.ListArray.from_arrays(pa.array(ends), entries)], [*kept, column])

    return run


def _located_in_groups(points: DataFrame, index: GridIndex, column: str, tally: bool) -> DataFrame:
    """``locate`` by groups: some points of a cell and all rows of the cell come together.

    The more rows a cell has, the fewer points a group has, so a hot cell is
    many groups and a group's memory is bounded; its tests run on arrays.
    Tallies are as large whatever the cell holds: their groups are large
    everywhere, so the rows of a cell are copied for few.
    """
    kept, kind = points.columns, TALLY if tally else HITS
    addressed = materialize(_addressed(points.withColumn("_id", F.monotonically_increasing_id()), index), "addressed")
    weights = index.cells.groupBy(*CELL_KEY).agg(F.max("pieces").alias("pieces"), F.sum("weight").alias("weight"))
    size = F.lit(TALLY_POINTS) if tally else F.greatest(F.lit(1), F.floor(F.lit(GROUP_POINTS) / F.col("pieces")))
    loads = addressed.groupBy(*CELL_KEY).agg(F.count("*").alias("n")).join(weights, CELL_KEY)
    loads = loads.select(*CELL_KEY, F.ceil(F.col("n") / size).alias("groups"), (F.col("n") * F.col("weight")).alias("tests"))
    loads = materialize(loads, "cell-loads")
    tests, groups = (total or 0 for total in loads.agg(F.sum("tests"), F.sum("groups")).first())
    tasks = int(tests // TASK_TESTS) + 1
    loads = loads.drop("tests")
    placed = lookup_join(addressed, loads, CELL_KEY, "left", stored=True)
    nowhere = placed.filter(F.col("groups").isNull()).select(*kept, F.array().cast(kind).alias(column))
    point = F.struct(*kept).alias("point")
    group = F.pmod(F.xxhash64("_id"), F.col("groups")).alias("group")
    mine = placed.filter(F.col("groups").isNotNull()).select(*CELL_KEY, group, point)
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1)).alias("group")
    rows = lookup_join(index.cells, loads, CELL_KEY, "inner", stored=True).select(*CELL_KEY, every, "parts")
    key = [*CELL_KEY, "group"]
    both = mine.unionByName(rows, allowMissingColumns=True).repartition(min(tasks, max(1, groups)) if tally else tasks, *key)
    schema = T.StructType([*points.schema.fields, T.StructField(column, T._parse_datatype_string(kind))])
    run = (_group_tallies if tally else _group_hits)(kept, column, index.reach)
    found = both.groupBy(*key).applyInArrow(run, schema)
    return nowhere.unionByName(found)


def locate(
    points: DataFrame, index: GridIndex, *, column: str = "hits", limit: int = BROADCAST_BYTES, tally: bool = False
) -> DataFrame:
    """Adds an array of the polygons that hold each point or lie within reach.

    Entries are struct<layer, name, inside, distance>, distance 0 when inside;
    points on the line are inside. Points without any, or without coordinates,
    get an empty array. The points are not shuffled while the index fits a
    broadcast and its cells are light; those of heavy cells, whose tests are
    most of the work, are dealt in groups over as many tasks as the tests need.
    With ``tally`` the hits of a layer that hold the point are one entry, and
    those within reach another: without name and distance, ``n`` is how many.
    """
    if index.pieces > 1 or index.items > LIGHT_ITEMS:
        return _located_in_groups(points, index, column, tally)
    x, y = F.col("x"), F.col("y")
    met = _met(_addressed(points, index), index, limit)
    hits = F.transform(F.transform("parts", lambda part: _tested(part, x, y)), _hit)
    near = F.filter(hits, lambda hit: F.coalesce(hit["distance"] <= index.reach, F.lit(False)))
    hits = F.coalesce(near, F.array().cast(HITS))
    return met.select(*points.columns, (_tallied(hits) if tally else hits).alias(column))


# --- the nearest polygon, however far -----------------------------------------


@dataclass
class NearestSearch:
    """A stored index for polygons within reach, and all edges in blocks with their boxes for what is farther."""

    index: GridIndex
    blocks: DataFrame


def edge_blocks(boundaries: DataFrame, size: int = BLOCK_EDGES) -> DataFrame:
    """Stretches of at most ``size`` edges: block, layer, name, edges, and their box x0, y0, x1, y1."""
    layer = F.col("layer") if "layer" in boundaries.columns else F.lit("")
    n = F.size("ring")
    starts = boundaries.filter(n > 0).select(
        layer.alias("layer"), "name", "ring", F.explode(F.sequence(F.lit(0), n - 1, F.lit(size))).alias("start")
    )
    edges = F.transform(
        F.sequence("start", F.least(F.col("start") + size, n) - 1),
        lambda i: geo.as_edge(F.get("ring", i), F.get("ring", (i + 1) % n)),
    )
    cut = starts.select("layer", "name", edges.alias("edges"))

    def end(least: bool, axis: str) -> Column:
        over = F.array_min if least else F.array_max
        both = F.least if least else F.greatest
        return both(*[over(F.transform("edges", lambda e: e[f"{axis}{k}"])) for k in (1, 2)])

    return cut.select(
        F.monotonically_increasing_id().alias("block"), "layer", "name", "edges",
        end(True, "x").alias("x0"), end(True, "y").alias("y0"), end(False, "x").alias("x1"), end(False, "y").alias("y1"),
    )


def nearest_search(boundaries: DataFrame, *, cell: float = CELL, reach: float = fixed.REACH) -> NearestSearch:
    """What ``nearest`` needs to know of polygons, stored."""
    index = boundary_index(boundaries, cell=cell, reach=reach)
    return NearestSearch(index, materialize(edge_blocks(boundaries), "edge-blocks"))


def _between(side: float) -> tuple[Column, Column]:
    """Bounds of the distance from any point of the square (qx, qy) to the nearest edge of a block."""

    def apart(q: str, low: str, high: str) -> tuple[Column, Column]:
        start, end = F.col(q) * F.lit(side), (F.col(q) + 1) * F.lit(side)
        gap = F.greatest(F.col(low) - end, start - F.col(high), F.lit(0.0))
        return gap, F.greatest(F.abs(F.col(high) - start), F.abs(end - F.col(low)))

    (near_x, far_x), (near_y, far_y) = apart("qx", "x0", "x1"), apart("qy", "y0", "y1")
    return F.hypot(near_x, near_y), F.hypot(far_x, far_y)


def nearest_blocks(points: DataFrame, blocks: DataFrame) -> DataFrame:
    """Of each square of ``SIDES[-1]`` with points: the blocks that may be nearest to one, as layer, qx, qy, block.

    Squares are narrowed from all of the plane. A block stays a candidate of a
    square while it may be nearer than the block whose farthest corner is
    nearest; smaller squares ask their own square's candidates only.
    """
    boxes = blocks.select("layer", "block", "x0", "y0", "x1", "y1")
    found = None
    for number, side in enumerate(SIDES):
        squares = points.select("layer", geo.grid(F.col("x"), side).alias("qx"), geo.grid(F.col("y"), side).alias("qy")).distinct()
        if number == 0:
            asked = squares.join(boxes, "layer")  # all of the plane is a few squares
        else:
            ratio = int(SIDES[number - 1] / side)
            above = found.withColumnRenamed("qx", "_qx").withColumnRenamed("qy", "_qy")
            mine = squares.withColumn("_qx", F.floor(F.col("qx") / ratio)).withColumn("_qy", F.floor(F.col("qy") / ratio))
            asked = mine.join(above, ["layer", "_qx", "_qy"]).drop("_qx", "_qy")
        low, high = _between(side)
        bounded = asked.withColumn("_low", low).withColumn("_high", high)
        least = bounded.groupBy("layer", "qx", "qy").agg(F.min("_high").alias("_least"))
        kept = bounded.join(least, ["layer", "qx", "qy"]).filter(F.col("_low") <= F.col("_least") + SLACK)
        found = materialize(kept.drop("_low", "_high", "_least"), "nearest-blocks")
    return found.select("layer", "qx", "qy", "block")


def nearest(points: DataFrame, search: NearestSearch, *, layer: str | None = None) -> DataFrame:
    """Adds ``near_name``, the nearest polygon however far, and ``near_hits``, those within reach.

    Inside counts as distance 0; equal distances go to the smallest name.
    ``layer`` names a column that polygons and points must share. A point
    without a polygon in reach meets the blocks of edges that may be nearest
    to its square, and takes the least distance of all of them. Points without
    coordinates, or of a layer without polygons, have none.
    """
    kept = points.columns
    own = F.col(layer) if layer is not None else F.lit("")
    mine = F.filter("near_hits", lambda hit: hit["layer"] == own) if layer is not None else F.col("near_hits")
    best = F.array_min(F.transform(mine, lambda hit: F.struct(hit["distance"].alias("d"), hit["name"].alias("n"))))
    reached = locate(points, search.index, column="near_hits").withColumn("near_name", best["n"])
    reached = materialize(reached.withColumn("_id", F.monotonically_increasing_id()), "reached")
    placed = F.col("near_name").isNull() & F.col("x").isNotNull() & F.col("y").isNotNull()
    lost = reached.filter(placed).select("_id", own.alias("layer"), "x", "y")
    blocks = search.blocks if layer is not None else search.blocks.withColumn("layer", F.lit(""))
    near = nearest_blocks(lost, blocks)
    side = SIDES[-1]
    asked = lost.withColumn("qx", geo.grid(F.col("x"), side)).withColumn("qy", geo.grid(F.col("y"), side))
    pairs = lookup_join(asked, near, ["layer", "qx", "qy"], "inner", stored=True).select("_id", "x", "y", "block")
    measured = pairs.join(blocks.select("block", "name", "edges"), "block").select(
        "_id", F.struct(geo.nearest_edge(F.col("edges"), F.col("x"), F.col("y")).alias("d"), F.col("name").alias("n")).alias("far")
    )
    closest = measured.groupBy("_id").agg(F.min("far").alias("far")).select("_id", F.col("far.n").alias("_far"))
    found = reached.join(closest, "_id", "left").withColumn("near_name", F.coalesce("near_name", "_far"))
    return found.select(*kept, "near_hits", "near_name")
