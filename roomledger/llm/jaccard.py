"""N-gram Jaccard join with signature trees.

A document is the set of its five-word shingles, equal sets are one node. Two
nodes link when 100 * intersection >= 75 * union. The steps:

1. Every node gets a signature, a bitmap of about four bits a shingle.
2. Nodes that could link share one of the first quarter of their shingles, in
   an order in which shingles seen often come last (any order gives the same
   links). Nodes that share such a shingle, and whose sizes and places of it
   allow a link, are gathered under a leader.
3. Under each leader a signature tree over bitmaps and sizes is traversed
   against itself; node pairs whose largest possible overlap is too small are
   cut off with all below them. What has no possible partner is dropped.
4. The sets of the rest are sent to their leaders, where the tree is traversed
   again and what it leaves is intersected exactly. Pairs already connected
   are passed over, so a group of copies costs about as many checks as it has
   members.
5. Links become components by label passing between tables.

Sets are kept by 64-bit hashes of shingles and told apart by 64-bit hashes of
sets. Nothing is capped: shingles of very many nodes and leaders with very
many members are cut into blocks, and every pair of blocks is compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roomledger.functions.joins import stored_bytes
from roomledger.llm.batches import map_batches, shuffle_width
from roomledger.llm.words import MULTIPLIER, grouped, mixed, scan_words, window_hashes
from roomledger.session import materialize

WIDTH = 5
NUMERATOR, DENOMINATOR = 75, 100
CHUNK = 1 << 22  # shingles looked at together by a task
OFTEN = 3  # nodes of a chunk in which a shingle counts as seen often
ORDERED = 1 << 17  # shingles that the order puts last, those seen most; it bounds what is broadcast
PART_BYTES = 64 << 20  # of documents for each part of the shingles that a task holds at once
GROUP = 1 << 16  # nodes that share a shingle, compared as one block
PAIRED = 8  # nodes that share a shingle, paired instead of put under one leader
MEMBERS = 2048  # nodes of a block under a leader
FANOUT = 8
FILTER_BITS = 1 << 23


# Sets ---------------------------------------------------------------------------------------------------------------


def shingle_sets(texts: list[bytes]) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text; a short text is one shingle, one without words has none."""
    for low, high in grouped(texts):
        words = scan_words(texts[low:high], lower=True)
        shingles = window_hashes(words.hashes, WIDTH)
        for a, b in zip(words.bounds[:-1], words.bounds[1:]):
            if b - a >= WIDTH:
                yield np.unique(shingles[a:b - WIDTH + 1])
            else:
                yield window_hashes(words.hashes[a:b], b - a)[:1] if b > a else np.zeros(0, np.uint64)


def node_of(shingles: np.ndarray) -> int:
    """The 64-bit name of a set."""
    names = mixed(shingles * MULTIPLIER + np.uint64(len(shingles)))
    return int(mixed(names.sum(dtype=np.uint64, keepdims=True) + np.uint64(len(shingles))).view(np.int64)[0])


def signature(shingles: np.ndarray) -> bytes:
    """A bitmap of the set, the power of two next above four bits a shingle wide."""
    bits = max(64, 1 << (4 * len(shingles) - 1).bit_length())
    marks = np.zeros(bits, np.uint8)
    marks[shingles & np.uint64(bits - 1)] = 1
    return np.packbits(marks).tobytes()


def planes(values: np.ndarray) -> bytes:
    """Numbers of eight bytes, byte by byte, so that what is zero compresses."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view("<u8").reshape(-1).astype(np.uint64)


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]


def describe(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Step 1. Rows (doc_id, text_hash, n_shingles, node, signature), and shingles seen often as rows (shingle, nodes)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n_held, seen = [], 0, set()

        def often() -> pa.RecordBatch:
            shingle, count = np.unique(np.concatenate(held) if held else np.zeros(0, np.uint64), return_counts=True)
            most = count >= OFTEN
            return pa.RecordBatch.from_pydict(
                {"doc_id": [None], "text_hash": [None], "n_shingles": [None], "node": [None], "signature": [None],
                 "shingles": [shingle[most].tobytes()], "counts": [count[most].astype("<i8").tobytes()]}, schema)

        for batch in batches:
            sizes, nodes, bitmaps = [], [], []
            for shingles in shingle_sets(_texts(batch)):
                node = node_of(shingles)
                sizes.append(len(shingles))
                nodes.append(node if len(shingles) else None)
                bitmaps.append(signature(shingles) if len(shingles) else None)
                if node not in seen:
                    seen.add(node)
                    held.append(shingles)
                    n_held += len(shingles)
                if n_held >= CHUNK:
                    yield often()
                    held, n_held, seen = [], 0, set()
            none = pa.nulls(len(sizes), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()),
                 pa.array(bitmaps, pa.binary()), none, none], schema=schema)
        yield often()

    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n_shingles", pa.int64()), ("node", pa.int64()), ("signature", pa.binary()),
                        ("shingles", pa.binary()), ("counts", pa.binary())])
    kind = "doc_id long, text_hash long, n_shingles long, node long, signature binary, shingles binary, counts binary"
    hashed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    found = materialize(map_batches(hashed, work, kind), "sets")

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s, c in zip(batch.column("shingles").to_pylist(), batch.column("counts").to_pylist()):
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(s, "<i8")), pa.array(np.frombuffer(c, "<i8"))], ["shingle", "nodes"])

    rows = found.filter("shingles IS NULL").drop("shingles", "counts")
    many = map_batches(found.filter("shingles IS NOT NULL").select("shingles", "counts"), unpack, "shingle long, nodes long")
    return rows, many.groupBy("shingle").agg(F.sum("nodes").alias("nodes"))


# Candidates -----------------------------------------------------------------------------------------------------------


def prefix(shingles: np.ndarray, often: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The shingles one of which any partner shares, and for each the largest partner for which it may be the first.

    A partner of m shingles shares ceil(3 (n + m) / 7) of them at 3/4, all at
    or after the first one shared.
    """
    n = len(shingles)
    if len(often):
        late = often[np.searchsorted(often, shingles).clip(max=len(often) - 1)] == shingles
        shingles = np.concatenate((shingles[~late], shingles[late]))
    place = np.arange(n - -(-NUMERATOR * n // DENOMINATOR) + 1)
    both = NUMERATOR + DENOMINATOR
    return shingles[:len(place)], (both * (n - place) - NUMERATOR * n) // NUMERATOR


def _spread(shingles: np.ndarray, node: int, often: np.ndarray, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group names of a node's shingles: shingles of very many nodes count as one per pair of blocks. Also their indexes."""
    index = np.arange(len(shingles))
    at = np.searchsorted(often, shingles).clip(max=len(often) - 1)
    n_blocks = np.where(often[at] == shingles, blocks[at], 1)
    if n_blocks.max(initial=1) == 1:
        return shingles, index
    index = np.repeat(index, n_blocks)
    other = np.arange(len(index)) - np.repeat(np.cumsum(n_blocks) - n_blocks, n_blocks)
    own = np.uint64(node % (1 << 64)) % n_blocks[index].astype(np.uint64)
    low, high = np.minimum(own, other.astype(np.uint64)), np.maximum(own, other.astype(np.uint64))
    names = mixed(shingles[index] + mixed(low * MULTIPLIER + high))
    return np.where(n_blocks[index] > 1, names, shingles[index]), index


def shared_shingles(docs: DataFrame, often: DataFrame) -> DataFrame:
    """Step 2. Rows (leader, node, n_leader, n_node): every pair that could link is under one leader, or is one."""
    spark = docs.sparkSession
    most = often.orderBy(F.desc("nodes"), "shingle").limit(ORDERED).toArrow()  # bounded, and results do not depend on it
    last = most.column("shingle").to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(last)
    shared = spark.sparkContext.broadcast((last[order], -(-most.column("nodes").to_numpy().astype(np.int64)[order] // GROUP)))
    width, size = shuffle_width(spark), stored_bytes(docs)
    # A plan that does not know its size says so by a number beyond all files.
    parts = max(width, min(size // PART_BYTES, 1 << 20)) if size < 1 << 60 else width

    def emit(nodes: list, sizes: list, shingles: list, limits: list) -> Iterator[pa.RecordBatch]:
        counts = np.array([len(s) for s in shingles])
        name, limit, owner = np.concatenate(shingles), np.concatenate(limits), np.repeat(np.arange(len(nodes)), counts)
        part = (mixed(name) % np.uint64(parts)).astype(np.int64)
        order = np.lexsort((name, part))
        name, limit, owner, part = name[order], limit[order], owner[order], part[order]
        cuts = np.searchsorted(part, np.arange(parts + 1))
        nodes, sizes = np.array(nodes, np.int64).view(np.uint64), np.array(sizes)
        for p in np.flatnonzero(np.diff(cuts)):
            own = slice(cuts[p], cuts[p + 1])
            used, local = np.unique(owner[own], return_inverse=True)
            yield pa.RecordBatch.from_pydict({
                "part": [int(p)], "names": [planes(np.diff(name[own], prepend=np.uint64(0)))], "owner": [planes(local)],
                "limits": [planes(limit[own])], "nodes": [nodes[used].tobytes()], "sizes": [planes(sizes[used])],
            })

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        late, blocks = shared.value
        nodes, sizes, names, limits, held, seen = [], [], [], [], 0, set()
        for batch in batches:
            for shingles in shingle_sets(_texts(batch)):
                node = node_of(shingles)
                if not len(shingles) or node in seen:
                    continue
                seen.add(node)
                first, limit = prefix(shingles, late)
                name, index = _spread(first, node, late, blocks) if len(late) else (first, np.arange(len(first)))
                nodes.append(node)
                sizes.append(len(shingles))
                names.append(name)
                limits.append(limit[index])
                held += len(name)
            if held >= CHUNK // 4:
                yield from emit(nodes, sizes, names, limits)
                nodes, sizes, names, limits, held, seen = [], [], [], [], 0, set()
        if nodes:
            yield from emit(nodes, sizes, names, limits)

    def led(*columns: list) -> pa.RecordBatch:
        found = leaders(*(np.concatenate(c) for c in columns))
        return pa.RecordBatch.from_arrays([pa.array(c) for c in found], ["leader", "node", "n_leader", "n_node"])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, name, limit, node, size = None, [], [], [], []
        for batch in batches:
            for row in batch.to_pylist():
                if row["part"] != part and name:
                    yield led(name, node, size, limit)
                    name, limit, node, size = [], [], [], []
                part = row["part"]
                owner = from_planes(row["owner"]).astype(np.int64)
                name.append(np.cumsum(from_planes(row["names"]), dtype=np.uint64))
                limit.append(from_planes(row["limits"]).astype(np.int64))
                node.append(np.frombuffer(row["nodes"], np.int64)[owner])
                size.append(from_planes(row["sizes"]).astype(np.int64)[owner])
        if name:
            yield led(name, node, size, limit)

    blobs = map_batches(docs.select("text"), work, "part long, names binary, owner binary, limits binary, nodes binary, sizes binary")
    found = map_batches(blobs.repartition(width, "part").sortWithinPartitions("part"), gather, "leader long, node long, n_leader long, n_node long")
    return materialize(found.distinct(), "leaders")


def leaders(name: np.ndarray, node: np.ndarray, size: np.ndarray, limit: np.ndarray) -> tuple[np.ndarray, ...]:
    """Pairs (leader, node) and their sizes such that nodes of one name that could link are under one leader."""
    order = np.lexsort((node, name))
    name, node, size, limit = name[order], node[order], size[order], limit[order]
    new = np.ones(len(name), bool)
    new[1:] = (name[1:] != name[:-1]) | (node[1:] != node[:-1])
    name, node, size, limit = name[new], node[new], size[new], limit[new]
    starts = np.flatnonzero(np.concatenate(([True], name[1:] != name[:-1])))
    counts = np.diff(np.append(starts, len(name)))
    small = np.repeat(counts <= PAIRED, counts)
    a, b = [], []
    for step in range(1, PAIRED):
        i = np.flatnonzero(small[:-step] & (name[step:] == name[:-step])) if len(name) > step else np.zeros(0, np.int64)
        j = i + step
        fits = (size[i] <= limit[j]) & (size[j] <= limit[i])
        a.append(i[fits])
        b.append(j[fits])
    for start, count in zip(starts[counts > PAIRED], counts[counts > PAIRED]):
        # Sizes that could link are within 4/3, so in one step of that ratio or in two that follow each other.
        own = np.arange(start, start + count)
        step = np.floor(np.log(size[own]) / np.log(DENOMINATOR / NUMERATOR) + 1e-9).astype(np.int64)
        for s in np.unique(step):
            lower = own[step == s]
            both = own[(step == s) | (step == s + 1)]
            # Nobody here fits a shingle whose place rules out even the smallest size present.
            both = both[limit[both] >= size[lower].min()]
            if len(both) > 1:
                a.append(np.full(len(both) - 1, both[0]))
                b.append(both[1:])
    a, b = np.concatenate(a), np.concatenate(b)
    pairs = np.unique(np.stack((node[a], node[b])), axis=1, return_index=True)[1]
    a, b = a[pairs], b[pairs]
    return node[a], node[b], size[a], size[b]


# Signature trees ------------------------------------------------------------------------------------------------------


class Tree:
    """Bitmaps of one width in levels of ``FANOUT``: each entry has the OR of those below it and the range of their sizes.

    Sorted bitmaps put sets with the same first marks, hence similar sets, side by side.
    """

    def __init__(self, members: np.ndarray, bitmaps: np.ndarray, sizes: np.ndarray):
        self.members = members
        slack = sizes - np.bitwise_count(bitmaps).sum(axis=1, dtype=np.int64)
        self.bits, self.low, self.high, self.slack = [bitmaps], [sizes], [sizes], [slack]
        while len(self.low[-1]) > 1:
            at = np.arange(0, len(self.low[-1]), FANOUT)
            self.bits.append(np.bitwise_or.reduceat(self.bits[-1], at, axis=0))
            self.low.append(np.minimum.reduceat(self.low[-1], at))
            self.high.append(np.maximum.reduceat(self.high[-1], at))
            self.slack.append(np.maximum.reduceat(self.slack[-1], at))

    @classmethod
    def of(cls, members: np.ndarray, bitmaps: list[bytes], sizes: np.ndarray) -> Tree:
        """The tree of some members' bitmaps, given for all members."""
        marks = np.frombuffer(b"".join(bitmaps[k] for k in members), np.uint8).reshape(len(members), -1)
        order = np.lexsort(marks.T[:16][::-1])
        return cls(members[order], np.ascontiguousarray(marks[order]).view(np.uint64), sizes[members[order]])

    def folded(self) -> Tree:
        """The same tree with bitmaps of half the width."""
        half = self.bits[0].shape[1] // 2
        return Tree(self.members, self.bits[0][:, :half] | self.bits[0][:, half:], self.low[0])

    def whole(self, state: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per level the least and greatest state of the members below each entry."""
        least = most = state[self.members]
        found = [(least, most)]
        while len(least) > 1:
            at = np.arange(0, len(least), FANOUT)
            least, most = np.minimum.reduceat(least, at), np.maximum.reduceat(most, at)
            found.append((least, most))
        return found


def possible(x: Tree, y: Tree, i: np.ndarray, j: np.ndarray, u: int, v: int) -> np.ndarray:
    """Which entry pairs (i of level u, j of level v) could hold a link, by sizes and largest possible overlap."""
    low_x, low_y = x.low[u][i], y.low[v][j]
    fit = (DENOMINATOR * x.high[u][i] >= NUMERATOR * low_y) & (DENOMINATOR * y.high[v][j] >= NUMERATOR * low_x)
    some = np.flatnonzero(fit)
    step = max(1, (1 << 21) // x.bits[u].shape[1])
    for k in range(0, len(some), step):
        own = some[k:k + step]
        common = np.bitwise_count(x.bits[u][i[own]] & y.bits[v][j[own]]).sum(axis=1, dtype=np.int64)
        most = common + np.minimum(x.slack[u][i[own]], y.slack[v][j[own]])
        fit[own] = (NUMERATOR + DENOMINATOR) * most >= NUMERATOR * (low_x[own] + low_y[own])
    return fit


def traverse(x: Tree, y: Tree, state: np.ndarray, leaf, settled) -> None:
    """Dual traversal of two trees of one width, or of one tree with itself.

    ``leaf(i, j)`` gets member pairs that could link and may change ``state``;
    ``settled(a, b)`` says, from the least and greatest states below two
    entries, which pairs need no look any more.
    """
    same = x is y
    stack = [(len(x.low) - 1, len(y.low) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while stack:
        u, v, i, j = stack.pop()
        if len(i) > 1024:
            stack += [(u, v, i[1024:], j[1024:])]
            i, j = i[:1024], j[:1024]
        below_x, below_y = x.whole(state)[u], y.whole(state)[v]
        fit = ~settled((below_x[0][i], below_x[1][i]), (below_y[0][j], below_y[1][j]))
        if same and u == v == 0:
            fit &= i < j
        i, j = i[fit], j[fit]
        fit = possible(x, y, i, j, u, v)
        i, j = i[fit], j[fit]
        if not len(i):
            continue
        if u == v == 0:
            leaf(x.members[i], y.members[j])
            continue
        down_x, down_y = u >= v, v >= u
        for down, tree, level, ends in ((down_x, x, u, "x"), (down_y, y, v, "y")):
            if not down:
                continue
            own = i if ends == "x" else j
            n = np.minimum((own + 1) * FANOUT, len(tree.low[level - 1])) - own * FANOUT
            at = np.repeat(np.arange(len(own)), n)
            child = own[at] * FANOUT + np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
            i, j = (child, j[at]) if ends == "x" else (i[at], child)
        u, v = u - down_x, v - down_y
        if same and u == v:
            keep = i <= j
            i, j = i[keep], j[keep]
        stack.append((u, v, i, j))


def compare(bitmaps: list[bytes], sizes: np.ndarray, state: np.ndarray, leaf, settled) -> None:
    """Traverse the members under one leader, a tree for each width of bitmap, against itself and the next width."""
    widths = np.array([len(b) for b in bitmaps])
    trees = {}
    for w in np.unique(widths):
        trees[int(w)] = Tree.of(np.flatnonzero(widths == w), bitmaps, sizes)
    for w, tree in trees.items():
        traverse(tree, tree, state, leaf, settled)
        if 2 * w in trees:
            traverse(tree, trees[2 * w].folded(), state, leaf, settled)


def with_partner(bitmaps: list[bytes], sizes: np.ndarray) -> np.ndarray:
    """Step 3: the members that could link with another one."""
    marked = np.zeros(len(sizes), np.int64)

    def leaf(i: np.ndarray, j: np.ndarray) -> None:
        marked[i] = 1
        marked[j] = 1

    compare(bitmaps, sizes, marked, leaf, lambda a, b: (a[0] == 1) & (b[0] == 1))
    return np.flatnonzero(marked)


def linked(sets: list[np.ndarray]) -> np.ndarray:
    """Step 4: for each set the index of the first one it is connected with by links among these sets."""
    sizes = np.array([len(s) for s in sets])
    part = np.arange(len(sets))

    def leaf(i: np.ndarray, j: np.ndarray) -> None:
        for a, b in zip(i.tolist(), j.tolist()):
            if part[a] != part[b] and links(sets[a], sets[b]):
                one, other = sorted((part[a], part[b]))
                part[part == other] = one

    compare([signature(s) for s in sets], sizes, part, leaf,
            lambda a, b: (a[0] == a[1]) & (b[0] == b[1]) & (a[0] == b[0]))
    return part


def linked_pairs(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Every link among some sets, as indexes of both ends: nothing is passed over."""
    found: list[tuple[int, int]] = []

    def leaf(i: np.ndarray, j: np.ndarray) -> None:
        found.extend((a, b) for a, b in zip(i.tolist(), j.tolist()) if links(sets[a], sets[b]))

    never = lambda a, b: np.zeros(len(a[0]), bool)
    compare([signature(s) for s in sets], np.array([len(s) for s in sets]), np.zeros(len(sets), np.int64), leaf, never)
    pairs = np.array(found, np.int64).reshape(-1, 2)
    return pairs[:, 0], pairs[:, 1]


def links(a: np.ndarray, b: np.ndarray) -> bool:
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a).clip(max=len(b) - 1)
    common = int(np.count_nonzero(b[at] == a))
    return DENOMINATOR * common >= NUMERATOR * (len(a) + len(b) - common)


KEY = ["leader", "low", "high"]


def clusters(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple[tuple, list[list]]]:
    """The rows of each key of sorted batches, as lists by column."""
    key, held = None, [[] for _ in columns]
    for batch in batches:
        keys = list(zip(*(batch.column(c).to_pylist() for c in KEY)))
        values = [batch.column(c).to_pylist() for c in columns]
        start = 0
        for end in range(1, len(keys) + 1):
            if end < len(keys) and keys[end] == keys[start]:
                continue
            if keys[start] != key:
                if key is not None:
                    yield key, held
                key, held = keys[start], [[] for _ in columns]
            for k, v in enumerate(values):
                held[k] += v[start:end]
            start = end
    if key is not None:
        yield key, held


def cut_in_blocks(found: DataFrame) -> DataFrame:
    """Rows (leader, low, high, node): leaders with their nodes, large ones as every pair of their blocks."""
    nodes = found.select("leader", "node").union(found.select("leader", F.col("leader").alias("node")).distinct())
    # Both sides are written tables, so the rows of a leader of very many can be split in the join.
    nodes = materialize(nodes, "members")
    large = nodes.groupBy("leader").agg(F.ceil(F.count("*") / MEMBERS).alias("pieces")).filter("pieces > 1")
    large = materialize(large, "large-leaders")
    return (
        nodes.join(large, "leader", "left").withColumn("pieces", F.coalesce("pieces", F.lit(1).cast("long")))
        .withColumn("own", F.pmod(F.xxhash64("node"), F.col("pieces")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)))
        .select("leader", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "node")
    )


def _by_cluster(df: DataFrame) -> DataFrame:
    return df.repartition(*KEY).sortWithinPartitions(*KEY)


def drop_lonely(found: DataFrame, rows: DataFrame) -> DataFrame:
    """Step 3. Rows (leader, low, high, node) of nodes that could link under their leader."""
    marks = rows.select("node", "n_shingles", "signature").dropDuplicates(["node"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, (nodes, sizes, bitmaps) in clusters(batches, ["node", "n_shingles", "signature"]):
            own = with_partner(bitmaps, np.array(sizes))
            if len(own):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k] * len(own), pa.int64()) for k in key] + [pa.array(np.array(nodes)[own])], [*KEY, "node"])

    shipped = _by_cluster(cut_in_blocks(found).join(marks, "node"))
    return materialize(map_batches(shipped, work, "leader long, low long, high long, node long"), "partners")


def wanted_ids(ids: DataFrame) -> np.ndarray:
    """A Bloom filter of ``FILTER_BITS`` bits over doc_ids; what it lets through in error the next join drops.

    Every task sets bits of its own rows; their words are combined by number,
    so the driver gets ``FILTER_BITS`` / 64 rows at most.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(FILTER_BITS, bool)
        for batch in batches:
            for at in _filter_places(batch.column("doc_id")):
                bits[at] = True
        words = np.packbits(bits).view(np.int64)
        some = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(words[some], pa.int64())], ["at", "word"])

    words = map_batches(ids, build, "at long, word long").groupBy("at").agg(F.bit_or("word").alias("word")).toArrow()
    found = np.zeros(FILTER_BITS // 64, np.int64)
    found[words.column("at").to_numpy()] = words.column("word").to_numpy()
    return np.unpackbits(found.view(np.uint8)).astype(bool)


def _filter_places(doc_ids: pa.Array) -> list[np.ndarray]:
    value = doc_ids.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    return [(mixed(mixed(value) * MULTIPLIER + np.uint64(k)) % np.uint64(FILTER_BITS)).astype(np.int64) for k in (1, 2)]


def connected(docs: DataFrame, partners: DataFrame, rows: DataFrame, every: bool = False) -> DataFrame:
    """Step 4. Rows (a, b): node b is connected with node a, the first of its links' group under some leader.

    With ``every`` the rows are all links instead.
    """
    nodes = partners.select("node").distinct()
    ids = nodes.join(rows.groupBy("node").agg(F.min("doc_id").alias("doc_id")), "node").select("doc_id")
    shared = docs.sparkSession.sparkContext.broadcast(wanted_ids(ids))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = _filter_places(batch.column("doc_id").cast(pa.int64()))
            batch = batch.filter(pa.array(shared.value[one] & shared.value[two]))
            found = [s for s in shingle_sets(_texts(batch)) if len(s)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([node_of(s) for s in found], pa.int64()),
                 pa.array([planes(np.diff(s >> np.uint64(16), prepend=np.uint64(0))) for s in found], pa.binary())], ["node", "shingles"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, (nodes, coded) in clusters(batches, ["node", "shingles"]):
            own_sets, names = [np.cumsum(from_planes(s), dtype=np.uint64) for s in coded], np.array(nodes)
            if every:
                ends = linked_pairs(own_sets)
            else:
                part = linked(own_sets)
                moved = np.flatnonzero(part != np.arange(len(part)))
                ends = part[moved], moved
            if len(ends[0]):
                a, b = names[ends[0]], names[ends[1]]
                if every:
                    a, b = np.minimum(a, b), np.maximum(a, b)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    whole = map_batches(docs.select("doc_id", "text"), sets, "node long, shingles binary").dropDuplicates(["node"])
    shipped = _by_cluster(partners.join(whole, "node"))
    return materialize(map_batches(shipped, work, "a long, b long").distinct(), "links")


# Components -----------------------------------------------------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """Rows (node, label) of all nodes with an edge: the least node of each component.

    Every round takes the least label among a node and its neighbours, then
    the label of that label, and ends when none changes. Each is a written table.
    """
    both = materialize(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near"))
        least = labels.join(near, labels["node"] == near["a"]).select("node", "label", F.least("label", "near").alias("least"))
        jump = labels.select(F.col("node").alias("least"), F.col("label").alias("next"))
        found = materialize(least.join(jump, "least").select("node", F.col("label").alias("old"), F.least("least", "next").alias("label")), "labels")
        if found.filter("old <> label").limit(1).count() == 0:
            return found.select("node", "label")
        labels = found.select("node", "label")


def grouped_rows(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_hash, n_shingles, group (a node, null for an empty set), component_id."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows, often = describe(docs)
    partners = drop_lonely(shared_shingles(docs, often), rows)
    labels = components(connected(docs, partners, rows))
    full = rows.filter("node IS NOT NULL").select("doc_id", "text_hash", "n_shingles", "node")
    least = full.groupBy("node").agg(F.min("doc_id").alias("least")).join(labels, "node", "left")
    of_label = least.filter("label IS NOT NULL").groupBy("label").agg(F.min("least").alias("component_id"))
    named = least.join(of_label, "label", "left").select(
        "node", F.coalesce("label", "node").alias("group"), F.coalesce("component_id", "least").alias("component_id"))
    columns = ["doc_id", "text_hash", "n_shingles", "group", "component_id"]
    empty = rows.filter("node IS NULL").withColumns({"group": F.lit(None).cast("long"), "component_id": F.col("doc_id")})
    return full.join(named, "node").select(*columns).union(empty.select(*columns))


def jaccard_components(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, the least doc_id that links lead to.

    A null text or one without words has an empty set and is a component of
    its own. Null ids take part and get the least id of their component, null
    if it has none; repeated rows are equal sets; columns other than doc_id
    and text are not read; an empty table gives an empty result. A text is
    held whole in one task.
    """
    return grouped_rows(docs).select("doc_id", "n_shingles", "component_id")


def jaccard_join(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All links between different sets, rows (a, b) of nodes with a < b, and the members of the nodes, rows (doc_id, n_shingles, node).

    Documents of one node have equal sets and are linked with each other and
    with all documents of linked nodes. The links of a group of near copies
    grow with its square; where components will do, ``jaccard_components``
    finds them without. Rows without words have a null node.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows, often = describe(docs)
    partners = drop_lonely(shared_shingles(docs, often), rows)
    return connected(docs, partners, rows, every=True), rows.select("doc_id", "n_shingles", "node")


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component: of the least id and, among its texts, the least hash.

    Rows without words stay, being linked with nothing. All columns are kept.
    """
    firsts = grouped_rows(docs).filter(F.col("group").isNotNull() & F.col("doc_id").eqNullSafe(F.col("component_id")))
    firsts = firsts.groupBy("group").agg(F.first("doc_id").alias("first"), F.min("text_hash").alias("first_hash"))
    firsts = materialize(firsts.select("first", "first_hash").distinct(), "firsts")
    worded = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    own = F.struct(*docs.columns).alias("row")
    keyed = docs.filter(worded).select(own, F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("hash"))
    same = F.col("id").eqNullSafe(F.col("first")) & (F.col("hash") == F.col("first_hash"))
    kept = keyed.join(firsts, same, "left_semi").dropDuplicates(["id", "hash"]).select("row.*")
    return kept.union(docs.filter(~worded))
