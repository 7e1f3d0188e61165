"""Fixed virtual slots: records hash into thousands of slots, a versioned map sends slots to shards.

A record's slot never changes. Balancing edits the map alone: version 1 deals
slots in turn, each later version moves or swaps a few slots between shards
until no edit makes the heaviest and the lightest more alike. Only the map,
``SLOTS`` rows whatever the corpus holds, comes to the driver.
"""

from __future__ import annotations

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roomledger.session import materialize

SLOTS = 16384
OWN = ["size", "text_crc32", "law", "shard", "slot", "grown_shard", "virtual_slot", "map_version"]
MAP_SCHEMA = "version int, virtual_slot int, shard int, bytes long, rows long"


def record_size(text: Column) -> Column:
    """UTF-8 bytes of the text (none for null) plus 8 for the id."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 8


def virtual_slot(doc_id: Column, text_crc32: Column) -> Column:
    """The slot a record always hashes to; rows that share an id but not the text may differ."""
    return F.pmod(F.xxhash64(doc_id, text_crc32), F.lit(SLOTS)).cast("int")


def first_map(n_shards: int) -> np.ndarray:
    """Version 1 of a map: slots dealt in turn, whatever they hold."""
    return np.arange(SLOTS) % n_shards


def rebalanced(shard_of: np.ndarray, weight: np.ndarray, n_shards: int) -> np.ndarray:
    """The next version of a map: edits until no move or swap between the heaviest and lightest shard helps.

    Slots that already lie well stay where they are. ``n_shards`` may exceed
    the shards in use: new ones start empty and take slots from the others.
    """
    shard_of = shard_of.copy()
    load = np.bincount(shard_of, weights=weight, minlength=n_shards).astype(np.int64)
    for _ in range(8 * SLOTS):
        heavy, light = int(load.argmax()), int(load.argmin())
        gap = int(load[heavy] - load[light])
        own = np.flatnonzero((shard_of == heavy) & (weight > 0))
        other = np.flatnonzero((shard_of == light) & (weight > 0))
        moves = weight[own]
        best = min(((abs(gap - 2 * int(w)), int(s), -1) for s, w in zip(own, moves) if w < gap), default=None)
        if best is None or best[0] * 4 > gap:
            best = min([best] if best else [], default=None)
            swap = _swap(own, other, weight, gap)
            if swap is not None and (best is None or swap[0] < best[0]):
                best = swap
        if best is None:
            break
        _, given, taken = best
        shard_of[given] = light
        moved = int(weight[given])
        if taken >= 0:
            shard_of[taken] = heavy
            moved -= int(weight[taken])
        load[heavy] -= moved
        load[light] += moved
    return shard_of


def _swap(own: np.ndarray, other: np.ndarray, weight: np.ndarray, gap: int) -> tuple[int, int, int] | None:
    """The exchange of one slot each that brings both shards closest together."""
    if not len(own) or not len(other):
        return None
    sorted_other = other[np.argsort(weight[other], kind="stable")]
    sizes = weight[sorted_other]
    at = np.searchsorted(sizes, weight[own] - gap / 2)
    best = None
    for near in (at - 1, at):
        near = near.clip(0, len(sizes) - 1)
        change = weight[own] - sizes[near]
        off = np.where((change > 0) & (change < gap), np.abs(gap - 2 * change), np.iinfo(np.int64).max)
        k = int(off.argmin())
        if 0 < change[k] < gap and (best is None or off[k] < best[0]):
            best = (int(off[k]), int(own[k]), int(sorted_other[near[k]]))
    return best


def slot_weights(records: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and rows of every slot; ``SLOTS`` rows at most reach the driver."""
    size, rows = np.zeros(SLOTS, np.int64), np.zeros(SLOTS, np.int64)
    held = records.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).collect()
    for r in held:
        size[r["virtual_slot"]], rows[r["virtual_slot"]] = r["bytes"], r["n"]
    return size, rows


def map_table(spark: SparkSession, shard_of: np.ndarray, size: np.ndarray, rows: np.ndarray, version: int) -> DataFrame:
    """A version of the map as rows ``MAP_SCHEMA``, to be stored under its version."""
    return spark.createDataFrame(
        [(version, s, int(shard_of[s]), int(size[s]), int(rows[s])) for s in range(SLOTS)], MAP_SCHEMA
    )


def load_map(stored: DataFrame, version: int | None = None) -> tuple[np.ndarray, int]:
    """A stored map, by default the latest version."""
    latest = stored.agg(F.max("version")).first()[0] if version is None else version
    shard_of = np.zeros(SLOTS, np.int64)
    for r in stored.filter(F.col("version") == latest).select("virtual_slot", "shard").collect():
        shard_of[r["virtual_slot"]] = r["shard"]
    return shard_of, latest


def stored_maps(spark: SparkSession, folder: str) -> DataFrame | None:
    """All whole versions of the map in a folder, None without one; a version whose writing broke off does not count."""
    try:
        found = spark.read.schema(MAP_SCHEMA).parquet(folder)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    whole = found.groupBy("version").agg(F.countDistinct("virtual_slot").alias("n")).filter(F.col("n") == SLOTS)
    versions = found.join(F.broadcast(whole), "version", "left_semi")  # a row for each version
    return None if versions.isEmpty() else versions


def store_map(table: DataFrame, folder: str, version: int) -> DataFrame:
    """Keep a version of the map beside the earlier ones; the same version broken off before is written anew."""
    path = f"{folder}/version={version}"
    table.drop("version").write.mode("overwrite").parquet(path)
    return table.sparkSession.read.schema(table.drop("version").schema).parquet(path).withColumn("version", F.lit(version))


def shard_documents(
    docs: DataFrame, n_shards: int = 24, shard_of: np.ndarray | None = None, version: int = 1, maps: str | None = None
) -> DataFrame:
    """Every row of ``docs`` with its shard and its place in the shard, sizes near equal (law ``bytes``).

    ``shard_of`` is the map in force (default: version 1); it is edited once
    for the bytes that the slots hold now, and the edited map is stored. With
    a folder ``maps`` the latest version there is the map in force instead,
    and the edited one is kept as the next version if any slot moves; one
    writer at a time. Slots of shards that are no more go to the others.
    Adds ``OWN``; columns of the input by these names give way to them. A null
    text has size 8 and a null crc32, a null id hashes by its text alone,
    repeated rows share a slot and get places of their own; an empty table
    gives an empty result. ``slot`` counts from 0 without gaps in a shard.
    Equal texts of different ids may lie in different shards: copies of one
    text can be a third of all bytes, more than a shard may hold.
    """
    spark = docs.sparkSession
    kept = [c for c in docs.columns if c not in OWN]
    records = docs.select(
        *kept, record_size(F.col("text")).alias("size"), F.crc32("text").alias("text_crc32")
    ).withColumn("virtual_slot", virtual_slot(F.col("doc_id"), F.col("text_crc32")))
    size, rows = slot_weights(records)
    earlier = stored_maps(spark, maps) if maps is not None else None
    if earlier is not None:
        shard_of, version = load_map(earlier)
    if shard_of is None:
        shard_of = first_map(n_shards)
    edited = rebalanced(np.where(shard_of < n_shards, shard_of, first_map(n_shards)), size, n_shards)
    if earlier is None or not np.array_equal(edited, shard_of):
        version += 1
    table = map_table(spark, edited, size, rows, version)
    # The weights of a version are those it was made for; places count the rows of now.
    if maps is not None and (earlier is None or not np.array_equal(edited, shard_of)):
        stored = store_map(table, maps, version)
    else:
        stored = materialize(table, "slot-map")
    in_shard = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    placed = stored.select(
        "virtual_slot", "shard", F.col("version").alias("map_version"),
        F.coalesce(F.sum("rows").over(in_shard), F.lit(0)).alias("base"),
    )
    # The places in a slot are numbered in the slot's own task; a slot holds one part in SLOTS of the corpus.
    in_slot = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")
    return (
        records.withColumn("place", F.row_number().over(in_slot))
        .join(F.broadcast(placed), "virtual_slot")  # SLOTS rows, always
        .select(
            *kept, "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
            (F.col("base") + F.col("place") - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
            "virtual_slot", "map_version",
        )
    )
