"""Planar geometry as column expressions on EPSG:3857 coordinates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS = 6378137.0
# Points this close to an edge, in metres, lie on it.
ON_LINE = 1e-6


def mercator_x(longitude: Column) -> Column:
    return F.radians(longitude) * F.lit(EARTH_RADIUS)


def mercator_y(latitude: Column) -> Column:
    return F.ln(F.tan(F.radians(latitude) / 2 + F.lit(0.7853981633974483))) * F.lit(EARTH_RADIUS)


def grid(value: Column, size: float) -> Column:
    """Number of the grid line at or below a coordinate."""
    return F.floor(value / F.lit(float(size))).cast("long")


def as_edge(a: Column, b: Column) -> Column:
    """The edge from a to b, with the differences every test needs."""
    return F.struct(
        a["x"].alias("x1"),
        a["y"].alias("y1"),
        b["x"].alias("x2"),
        b["y"].alias("y2"),
        (b["x"] - a["x"]).alias("dx"),
        (b["y"] - a["y"]).alias("dy"),
    )


def crosses(edge: Column, px: Column, py: Column) -> Column:
    """Whether the ray from the point towards +x crosses the edge (half-open in y)."""
    straddles = (edge["y1"] > py) != (edge["y2"] > py)
    at = edge["x1"] + F.try_divide((py - edge["y1"]) * edge["dx"], edge["dy"])
    return straddles & F.coalesce(px < at, F.lit(False))


def nearest_edge(edges: Column, px: Column, py: Column) -> Column:
    """Distance from the point to the nearest of an array of edges.

    The position along each edge is bound first, so it is evaluated once;
    an edge without length has none and counts as its first end. The root of
    the least square rounds alike here and in numpy, a hypotenuse does not.
    """

    def position(edge: Column) -> Column:
        along = (px - edge["x1"]) * edge["dx"] + (py - edge["y1"]) * edge["dy"]
        share = F.try_divide(along, edge["dx"] * edge["dx"] + edge["dy"] * edge["dy"])
        share = F.least(F.lit(1.0), F.greatest(F.lit(0.0), share))
        return F.struct(edge.alias("edge"), share.alias("share"))

    def squared(at: Column) -> Column:
        edge, share = at["edge"], at["share"]
        x, y = edge["x1"] + share * edge["dx"] - px, edge["y1"] + share * edge["dy"] - py
        return x * x + y * y

    return F.sqrt(F.array_min(F.transform(F.transform(edges, position), squared)))


def ring_area(ring: Column) -> Column:
    """Area enclosed by a ring of points, whichever way it turns."""
    n = F.size(ring)
    turns = F.transform(
        F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
        lambda i: F.get(ring, i - 1)["x"] * F.get(ring, i % n)["y"] - F.get(ring, i % n)["x"] * F.get(ring, i - 1)["y"],
    )
    doubled = F.aggregate(turns, F.lit(0.0), lambda total, turn: total + F.coalesce(turn, F.lit(0.0)))
    return F.when(n > 0, F.abs(doubled) / 2).otherwise(F.lit(0.0))
