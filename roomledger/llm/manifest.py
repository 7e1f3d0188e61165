"""Merkle manifest of a dataset: postorder logs by aligned builders, proofs read from them by closed-form positions.

The leaves of a source are ranked by ranges. A builder takes 256 neighbouring
ones, aligned to their rank, and appends every node of their subtree to its
log at the moment it is complete. The roots of the builders are the leaves of
the next round, until one root is left; the roots of the sources are then the
leaves of one more tree. A node is complete right after its last leaf and the
nodes below it that end there, so its place in the log follows from its level
and its last leaf alone, and the siblings of a proof are read from there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roomledger.llm.batches import map_batches
from roomledger.session import materialize

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
FAN = 16  # nodes of a run
LEVELS = 2  # that a builder completes
LEAVES = FAN**LEVELS  # of a builder
DIGEST = 32
TAMPERED = 5


class Manifest(NamedTuple):
    """The logs of all builders: ``rounds`` of the sources' trees, and those of the tree over the sources."""

    rounds: list[DataFrame]  # group (the source), block, n (leaves of the group in this round), members, log
    above: list[DataFrame]  # the same with group 0, members are sources


def leaf_digest(text: Column) -> Column:
    """The digest of a document's fields with ``text`` as its text: each its byte count, a colon and its value, or - for null."""
    parts = []
    for name in FIELDS:
        value = text if name == "text" else F.col(name).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts), 256))


def combined(nodes: list[bytes]) -> bytes:
    """The node above a run: its digests as hex text, hashed."""
    return hashlib.sha256(b"".join(nodes).hex().encode()).digest()


def levels_above(n: int) -> int:
    """Levels until ``n`` nodes are one."""
    found = 0
    while n > 1:
        n = -(-n // FAN)
        found += 1
    return found


def position(level: int, at: int, n: int) -> int:
    """Place of node ``at`` of a level in the postorder log of ``n`` leaves.

    Its last leaf e comes after e leaves and one node of level k for every
    FAN^k of them that are full; the nodes below it that end in e lie between.
    """
    last = min((at + 1) * FAN**level, n) - 1
    before, rest = 0, last
    while rest:
        before += rest
        rest //= FAN
    return before + level


class Builder:
    """Appends nodes to a log in the order in which they are complete."""

    def __init__(self, levels: int):
        self.levels = levels
        self.log: list[bytes] = []
        self.open: list[list[bytes]] = [[] for _ in range(levels + 1)]

    def add(self, digest: bytes, level: int = 0) -> None:
        self.log.append(digest)
        self.open[level].append(digest)
        if level < self.levels and len(self.open[level]) == FAN:
            self._close(level)

    def _close(self, level: int) -> None:
        run, self.open[level] = self.open[level], []
        self.add(combined(run), level + 1)

    def finish(self) -> bytes:
        """The log, after the last runs are completed with what they have."""
        for level in range(self.levels):
            if self.open[level]:
                self._close(level)
        return b"".join(self.log)


def own_path(log: bytes, at: int, n: int, levels: int) -> bytes:
    """Siblings of leaf ``at`` within its builder's log of ``n`` leaves: per level its place in the run, their number, and they."""
    path = []
    for level in range(levels):
        node = at // FAN**level
        first = node - node % FAN
        past = min(first + FAN, -(-n // FAN**level))
        path.append(bytes((node - first, past - first - 1)))
        for other in range(first, past):
            if other != node:
                place = DIGEST * position(level, other, n)
                path.append(log[place:place + DIGEST])
    return b"".join(path)


def runs_of(path: bytes) -> Iterator[tuple[int, bytes]]:
    """A path's levels from the leaf up: the node's place in its run, and its siblings."""
    at = 0
    while at < len(path):
        end = at + 2 + DIGEST * path[at + 1]
        yield path[at], path[at + 2:end]
        at = end


def fold(leaf: bytes, path: bytes) -> bytes:
    """The root that a leaf and its siblings lead to."""
    for place, siblings in runs_of(path):
        leaf = combined([siblings[:DIGEST * place], leaf, siblings[DIGEST * place:]])
    return leaf


def proof_digest(path: bytes) -> str:
    return hashlib.sha256(b"".join(siblings for _, siblings in runs_of(path)).hex().encode()).hexdigest()


def _ranked(nodes: DataFrame, order: list[Column]) -> DataFrame:
    """``nodes`` with their place ``at`` in their group and the group's rows ``n``; a large group is spread by ranges."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, seen = TaskContext.get().partitionId(), object(), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            group = batch.column("group")
            codes = group.dictionary_encode(null_encoding="encode").indices.to_numpy()
            first = np.flatnonzero(np.diff(codes, prepend=-1))
            length = np.diff(first, append=len(codes))
            place = np.arange(len(codes)) - np.repeat(first, length)
            if group[0].as_py() == last:
                place[:length[0]] += seen
            last, seen = group[-1].as_py(), int(place[-1]) + 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([part] * len(codes), pa.int32()), pa.array(place, pa.int64())],
                [*batch.schema.names, "part", "place"],
            )

    by_group = [F.col("group").asc_nulls_first(), *order]
    # Equal rows may be spread over ranges: their order does not matter.
    spread = nodes.repartitionByRange(*by_group, F.spark_partition_id()).sortWithinPartitions(*by_group)
    schema = T.StructType([*nodes.schema, T.StructField("part", T.IntegerType()), T.StructField("place", T.LongType())])
    placed = materialize(map_batches(spread, number, schema), "merkle-leaves")
    runs = placed.groupBy("group", "part").agg(F.count("*").alias("rows"))
    group = Window.partitionBy("group")  # one row per range that the group reaches
    ahead = group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    based = runs.select(
        F.col("group").alias("of"), F.col("part").alias("range"), F.coalesce(F.sum("rows").over(ahead), F.lit(0)).alias("base"),
        F.sum("rows").over(group).alias("n"),
    )
    same = F.col("group").eqNullSafe(F.col("of")) & (F.col("part") == F.col("range"))
    return placed.join(based, same).select(*nodes.columns, (F.col("base") + F.col("place")).alias("at"), "n")


def _built(nodes: DataFrame) -> DataFrame:
    """One row per builder, from rows group, at, n, digest and what members carry along."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            logs = []
            for n, members in zip(batch.column("n").to_pylist(), batch.column("members")):
                builder = Builder(min(LEVELS, levels_above(n)))
                for digest in members.values.field("digest").to_pylist():
                    builder.add(digest)
                logs.append(builder.finish())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(logs, pa.binary())], [*batch.schema.names, "log"])

    carried = [c for c in nodes.columns if c not in ("group", "n")]  # ``at`` first, which sorts them
    members = F.sort_array(F.collect_list(F.struct("at", *(c for c in carried if c != "at"))))  # LEAVES at most
    blocks = nodes.groupBy("group", F.floor(F.col("at") / LEAVES).alias("block"), "n").agg(members.alias("members"))
    return materialize(
        map_batches(blocks, work, T.StructType([*blocks.schema, T.StructField("log", T.BinaryType())])), "merkle-log"
    )


def _root(log: str = "log") -> Column:
    return F.substring(log, -DIGEST, DIGEST)


def _rounds(leaves: DataFrame) -> list[DataFrame]:
    """Builders over builders until every group has one root."""
    rounds = [_built(leaves)]
    while (rounds[-1].agg(F.max("n")).first()[0] or 0) > LEAVES:
        roots = rounds[-1].select("group", F.col("block").alias("at"), F.ceil(F.col("n") / LEAVES).alias("n"), _root().alias("digest"))
        rounds.append(_built(roots))
    return rounds


def build_manifest(docs: DataFrame, presented: Column | None = None) -> Manifest:
    """Write the logs of all documents' trees, one per source, and of the tree over the sources.

    Within a source leaves ascend by doc_id, null first; rows that share an id
    ascend by their digest, so equal rows are interchangeable. A null text or
    any other null field has a leaf as well. Columns other than ``FIELDS`` are
    not read. An empty table has empty logs. ``presented`` is a text to verify
    instead of the stored one (null: the stored one); its leaf is kept beside.
    """
    narrow = docs.select(*FIELDS)
    shown = F.lit(None).cast("binary") if presented is None else F.when(presented.isNotNull(), leaf_digest(presented))
    leaves = narrow.select(
        F.col("source").alias("group"), "doc_id", leaf_digest(F.col("text")).alias("digest"), shown.alias("presented")
    )
    rounds = _rounds(_ranked(leaves, [F.col("doc_id").asc_nulls_first(), F.col("digest")]))
    # The first round of a source with few leaves is its last as well; every source has one row in the last round.
    subroots = rounds[-1].select(F.lit(0).alias("group"), F.col("group").alias("source"), _root().alias("digest"))
    return Manifest(rounds, _rounds(_ranked(subroots, [F.col("source").asc_nulls_first()])))


def _with_paths(blocks: DataFrame, upper: DataFrame, members: list[str]) -> DataFrame:
    """A row per member with its ``path`` to the root: its siblings in the builder's log, then the path of the builder's root.

    ``upper`` has one row per builder: group, block, path, subroot, root.
    """
    schema = T.StructType([blocks.schema["group"], *(blocks.schema["members"].dataType.elementType[c] for c in members)])
    for name in ("path", "subroot", "root"):
        schema = schema.add(name, T.BinaryType())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                n, log, first, above = (batch.column(c)[k].as_py() for c in ("n", "log", "block", "path"))
                own = batch.column("members")[k].values
                levels = min(LEVELS, levels_above(n))
                paths = [own_path(log, at, len(own), levels) + above for at in range(len(own))]
                once = {c: pa.array([batch.column(c)[k].as_py()] * len(own), batch.schema.field(c).type) for c in ("group", "subroot", "root")}
                yield pa.RecordBatch.from_arrays(
                    [once["group"], *(own.field(c) for c in members), pa.array(paths, pa.binary()), once["subroot"], once["root"]],
                    schema.names,
                )

    above = upper.select(F.col("group").alias("of"), F.col("block").alias("its"), "path", "subroot", "root")
    same = F.col("group").eqNullSafe(F.col("of")) & (F.col("block") == F.col("its"))
    return map_batches(blocks.join(above, same).select(*blocks.columns, "path", "subroot", "root"), work, schema)


def proofs(manifest: Manifest) -> DataFrame:
    """Every document's proof: group (its source), doc_id, digest (its leaf), presented, path, subroot, root.

    ``path`` has, per level from the leaf up, a byte for the node's place in
    its run, a byte for the number of siblings, and the siblings' digests.
    """
    top = manifest.above[-1]
    upper = top.select("group", "block", F.lit(b"").alias("path"), _root().alias("root"), F.lit(b"").alias("subroot"))
    for blocks in reversed(manifest.above[1:]):
        upper = _with_paths(blocks, upper, ["at"]).withColumnRenamed("at", "block")
    found = _with_paths(manifest.above[0], upper, ["source", "digest"])
    upper = found.select(F.col("source").alias("group"), F.lit(0).alias("block"), "path", F.col("digest").alias("subroot"), "root")
    for blocks in reversed(manifest.rounds[1:]):
        upper = _with_paths(blocks, upper, ["at"]).withColumnRenamed("at", "block")
    return _with_paths(manifest.rounds[0], upper, ["doc_id", "digest", "presented"])


def verified(found: DataFrame) -> DataFrame:
    """Rows of ``proofs`` checked: the root is recomputed from the presented leaf, or else the stored one, and the siblings."""
    schema = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    names = T.StructType.fromDDL(schema).names

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {c: batch.column(c).to_pylist() for c in ("digest", "presented", "path", "subroot", "root")}
            folded = [fold(p or d, path) for d, p, path in zip(columns["digest"], columns["presented"], columns["path"])]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), *(pa.array([d.hex() for d in columns[c]], pa.string()) for c in ("digest", "subroot", "root")),
                pa.array(map(proof_digest, columns["path"]), pa.string()), pa.array([f.hex() for f in folded], pa.string()),
                pa.array([f == r for f, r in zip(folded, columns["root"])], pa.bool_()),
            ], names)

    return map_batches(found.select("doc_id", "digest", "presented", "path", "subroot", "root"), work, schema)


def audit(docs: DataFrame) -> DataFrame:
    """Build the manifest of ``docs`` and verify every document, tampered with where 5 divides the crc32 of its decimal id.

    Tampering lower-cases A to Z of the text. One row per row of ``docs``; a
    null id or text is never tampered with.
    """
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    lowered = F.translate("text", letters, letters.lower())
    hit = F.crc32(F.col("doc_id").cast("string")) % TAMPERED == 0
    return verified(proofs(build_manifest(docs, F.when(hit, lowered))))
