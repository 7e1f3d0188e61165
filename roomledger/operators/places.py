"""Places: census names joined to points, cleaned and counted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomledger.functions.columns import clean_place_name
from roomledger.operators.boundaries import CELL, boundary_index, locate


def place_join(points: DataFrame, places: DataFrame, *, cell: float = CELL, keep_all: bool = True) -> DataFrame:
    """Points with the ``place`` each lies in: one row per place, null where none.

    ``keep_all=False`` leaves out points in no place.
    """
    located = locate(points, boundary_index(places, cell=cell, reach=0.0))
    names = F.transform(F.filter("hits", lambda hit: hit["inside"]), lambda hit: hit["name"])
    located = located.withColumn("_names", names).drop("hits")
    unpack = F.explode_outer("_names") if keep_all else F.explode("_names")
    return located.withColumn("place", unpack).drop("_names")


def place_counts(joined: DataFrame) -> DataFrame:
    """Listings per cleaned place name."""
    return joined.groupBy(clean_place_name(F.col("place")).alias("place")).agg(F.count("*").alias("n"))
