"""Convex hulls of points per group, and regions looked up in them.

Hulls are the one thing built-in functions cannot express. They are computed
in stages: every task reduces its own rows to the corners of each group, the
corners are shuffled by group and a salt and reduced again, and only what is
left of a group comes together. A group of any size is thus never collected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roomledger import fixed_values as fixed
from roomledger.functions.columns import not_among
from roomledger.functions.geometry import ring_area
from roomledger.functions.joins import keep_not_in, lookup_join
from roomledger.operators.boundaries import CELL, GridIndex, boundary_index, locate

RING = T.ArrayType(T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())]))
HULL_KEYS = ["country", "region"]
# Rows a task gathers before it reduces them; many small groups then share
# the cost, and a group met in many batches is reduced once.
HELD_ROWS = 500_000
SALTS = 32


def _corners(points: np.ndarray) -> np.ndarray:
    """Corners of the convex hull, counter-clockwise from the lowest x, y."""
    points = np.unique(points, axis=0)
    if len(points) > 64:
        points = points[_outside_octagon(points)]
    if len(points) < 3:
        return points

    def chain(ordered: np.ndarray) -> list[np.ndarray]:
        kept: list[np.ndarray] = []
        for p in ordered:
            while len(kept) > 1:
                (ax, ay), (bx, by) = kept[-2], kept[-1]
                if (bx - ax) * (p[1] - ay) - (by - ay) * (p[0] - ax) > 0:
                    break
                kept.pop()
            kept.append(p)
        return kept

    lower, upper = chain(points), chain(points[::-1])
    return np.array(lower[:-1] + upper[:-1])


def _outside_octagon(points: np.ndarray) -> np.ndarray:
    """Mask of the points not strictly inside the polygon of eight extreme points."""
    x, y = points[:, 0], points[:, 1]
    extremes = [np.argmax(v) for v in (x, x + y, y, y - x, -x, -x - y, -y, x - y)]
    corners = points[extremes]
    inside = np.ones(len(points), dtype=bool)
    for a, b in zip(corners, np.roll(corners, -1, axis=0)):
        if not np.array_equal(a, b):
            inside &= (b[0] - a[0]) * (y - a[1]) - (b[1] - a[1]) * (x - a[0]) > 0
    return ~inside


def _reduce(keys: list[str]):
    """Task function: the corners of each group among the task's rows.

    Should more than half of the held rows be corners, they are passed on as
    they are, so that a task's memory is bounded whatever the data.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        size = 0
        for batch in batches:
            held.append(batch)
            size += len(batch)
            if size > HELD_ROWS:
                held = [_per_group(pd.concat(held), keys)]
                size = len(held[0])
                if size > HELD_ROWS // 2:
                    yield held.pop()
                    size = 0
        if held:
            yield _per_group(pd.concat(held), keys)

    return run


def _per_group(rows: pd.DataFrame, keys: list[str]) -> pd.DataFrame:
    names, corners = [], []
    for key, group in rows.groupby(keys, dropna=False, sort=False):
        corners.append(_corners(group[["x", "y"]].to_numpy(dtype="float64")))
        names.extend([tuple(None if pd.isna(k) else k for k in key)] * len(corners[-1]))
    xy = np.concatenate(corners) if corners else np.empty((0, 2))
    columns = {k: np.array([n[i] for n in names], dtype=object) for i, k in enumerate(keys)}
    return pd.DataFrame({**columns, "x": xy[:, 0], "y": xy[:, 1]})


def _rings(keys: list[str]):
    """Group function: the ring of what is left of a group."""

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        corners = _corners(group[["x", "y"]].to_numpy(dtype="float64"))
        ring = [{"x": float(x), "y": float(y)} for x, y in corners]
        names = {k: np.array([None if pd.isna(v) else v], dtype=object) for k, v in zip(keys, key)}
        return pd.DataFrame({**names, "ring": [ring]})

    return run


def convex_hulls(points: DataFrame, keys: list[str]) -> DataFrame:
    """One ring per group of points (keys, x, y).

    Fewer than three points, or points in a line, give their one or two ends.
    """
    points = points.select(*keys, F.col("x").cast("double"), F.col("y").cast("double"))
    points = points.filter(F.col("x").isNotNull() & F.col("y").isNotNull())
    corners = points.mapInPandas(_reduce(keys), points.schema)
    salt = F.pmod(F.xxhash64("x", "y"), F.lit(SALTS))
    corners = corners.repartition(*[F.col(k) for k in keys], salt).mapInPandas(_reduce(keys), points.schema)
    schema = T.StructType([*[points.schema[k] for k in keys], T.StructField("ring", RING)])
    return corners.groupBy(*keys).applyInPandas(_rings(keys), schema)


def hulls_with_area(points: DataFrame, keys: list[str]) -> DataFrame:
    """Hulls that are polygons, with their area."""
    hulls = convex_hulls(points, keys).withColumn("area", ring_area(F.col("ring")))
    return hulls.filter(F.size("ring") >= 3)


def country_hulls(points: DataFrame) -> DataFrame:
    """Hull per country, largest first."""
    return hulls_with_area(points.filter(F.col("country").isNotNull()), ["country"]).orderBy(F.desc("area"), "country")


def city_hulls(points: DataFrame) -> DataFrame:
    """Hull per city within its region."""
    return hulls_with_area(points.filter(F.col("city").isNotNull()), ["country", "region", "city"])


def _hullable(points: DataFrame) -> DataFrame:
    named = F.col("region").isNotNull()
    return points.filter(named & not_among(F.col("country"), fixed.SUBDIVIDED_COUNTRIES))


def _corner_rows(hulls: DataFrame) -> DataFrame:
    return hulls.select(*HULL_KEYS, F.inline("ring"))


def hull_update(points: DataFrame, hulls: DataFrame) -> DataFrame:
    """Known hulls widened by the points that carry their country and region."""
    own = lookup_join(_hullable(points), hulls.select(*HULL_KEYS).distinct(), HULL_KEYS, "left_semi")
    own = own.select(*HULL_KEYS, "x", "y")
    return convex_hulls(own.unionByName(_corner_rows(hulls)), HULL_KEYS)


def hull_candidates(points: DataFrame, hulls: DataFrame, min_listings: int = fixed.HULL_MIN_LISTINGS) -> DataFrame:
    """(country, region) pairs with enough listings whose region name has no hull anywhere."""
    counts = _hullable(points).groupBy(*HULL_KEYS).agg(F.count("*").alias("n"))
    return keep_not_in(counts.filter(F.col("n") >= min_listings), hulls, "region")


def hull_add(points: DataFrame, hulls: DataFrame, min_listings: int = fixed.HULL_MIN_LISTINGS) -> DataFrame:
    """Hulls of the regions to add."""
    wanted = hull_candidates(points, hulls, min_listings)
    return convex_hulls(lookup_join(points, wanted.select(*HULL_KEYS), HULL_KEYS, "left_semi", null_safe=True), HULL_KEYS)


def refresh_hulls(points: DataFrame, hulls: DataFrame, min_listings: int = fixed.HULL_MIN_LISTINGS) -> DataFrame:
    """hull_update and hull_add as one hull computation over the points."""
    wanted = hull_candidates(points, hulls, min_listings).select(*HULL_KEYS).unionByName(hulls.select(*HULL_KEYS))
    own = lookup_join(_hullable(points), wanted.distinct(), HULL_KEYS, "left_semi", null_safe=True)
    own = own.select(*HULL_KEYS, "x", "y")
    return convex_hulls(own.unionByName(_corner_rows(hulls)), HULL_KEYS)


def hull_index(hulls: DataFrame, *, cell: float = CELL) -> GridIndex:
    """Grid index of hulls, which are polygons like any other."""
    as_polygons = hulls.select(
        F.col("country").alias("layer"), F.col("region").alias("name"), F.col("region").alias("part"), "ring"
    )
    return boundary_index(as_polygons, cell=cell, reach=0.0)


def holding_hulls(points: DataFrame, hulls: DataFrame, *, cell: float = CELL) -> DataFrame:
    """Adds ``regions``: the regions of the point's own country whose hull holds it."""
    located = locate(points, hull_index(hulls, cell=cell))
    own = F.filter("hits", lambda hit: hit["inside"] & (hit["layer"] == F.col("country")))
    return located.withColumn("regions", F.transform(own, lambda hit: hit["name"])).drop("hits")


def region_from_hull(property: DataFrame, hulls: DataFrame, *, cell: float = CELL) -> DataFrame:
    """Listings with a country but no region take the one hull they are in, if it is one."""
    lacking = F.col("country").isNotNull() & F.col("region").isNull()
    searched = holding_hulls(property.filter(lacking), hulls, cell=cell)
    one = F.when(F.size("regions") == 1, F.get("regions", F.lit(0)))
    filled = searched.withColumn("region", one).select(*property.columns)
    return property.filter(~lacking).unionByName(filled)
