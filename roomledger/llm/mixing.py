"""Low-discrepancy source schedule: points of the golden ratio pick sources, ranked slots take shuffled blocks.

Each source is a stream of its documents in a shuffled order that only the id
decides, cut into blocks of ``BLOCK`` words and read round again when it ends.
Slot j of the mix falls on the source whose share of the cumulative targets
holds the j-th golden-ratio point, and takes that source's next block. A source
stops at its target; what rounding leaves over follows at the end.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roomledger.session import materialize

WEIGHTS = (5, 2, 1)
SHARE = 1.5
REPEATS = 2
BLOCK = 256
BUCKET_DIGITS = 3  # hex digits of the shuffle key: 4096 buckets of each source's stream
CHUNK = 1024  # slots ranked together, at least; as many as there are such chunks in a long mix
CELLS = 4096  # of the table that finds a point's source
GOLDEN = 0.6180339887498949


def word_count(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; none for null."""
    trimmed = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    counted = F.size(F.split(trimmed, "[ \\x09-\\x0D]+")).cast("long")
    return F.when(trimmed.isNull() | (trimmed == ""), F.lit(0).cast("long")).otherwise(counted)


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """Rows (source, source_size, source_no, target): ``share`` of all words by weight, at most twice a source's size.

    Targets are min(2 size, level * weight) for the one level at which they
    add up: sources are tried in the order in which a rising level meets their
    limits. One row per source reaches the windows.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(F.col("source_no"), len(weights)) + 1)
    sources = (
        sized.groupBy("source").agg(F.sum("size").alias("source_size"))
        .withColumn("source_no", F.row_number().over(by_name) - 1)
        .withColumn("weight", weight)
        .withColumn("limit", F.col("source_size") * float(REPEATS))
        .withColumn("meets", F.col("limit") / F.col("weight"))
    )
    by_limit = Window.orderBy("meets", "source_no")
    before, whole = (by_limit.rowsBetween(Window.unboundedPreceding, n) for n in (-1, Window.unboundedFollowing))
    spent = F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    rest = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    level = (F.sum("source_size").over(whole) * share - spent) / rest
    levels = sources.withColumn("level", level)
    level = F.first(F.when(F.col("level") <= F.col("meets"), F.col("level")), ignorenulls=True).over(whole)
    target = F.least(F.col("limit"), F.coalesce(level * F.col("weight"), F.col("limit")))
    return levels.select("source", "source_size", "source_no", target.alias("target"))


def mix_key(doc_id: Column) -> Column:
    """The key by which a source's documents are shuffled."""
    return F.md5(F.concat(F.lit("mix-"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def sized_documents(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, source, size, text_hash, key, bucket): the narrow part of the corpus that a mix is planned on."""
    key = mix_key(F.col("doc_id"))
    return docs.select(
        "doc_id", "source", word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("text_hash"),
        key.alias("key"), F.substring(key, 1, BUCKET_DIGITS).alias("bucket"),
    )


def placed_documents(sized: DataFrame, sources: DataFrame) -> DataFrame:
    """Each row of ``sized`` with its source's figures and ``start``, its first word's place in the shuffled stream.

    A stream is cut by the first digits of the shuffle key: sums per cut give
    the cut's start, windows run inside a cut. So a source with a third of all
    rows is spread over thousands of groups.
    """
    ahead = Window.partitionBy("source_no").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    cuts = (
        sized.groupBy("source", "bucket").agg(F.sum("size").alias("words")).alias("c")
        .join(sources.alias("s"), F.col("c.source").eqNullSafe(F.col("s.source")))
        .select("c.source", "bucket", "source_no", "source_size", "target",
                F.coalesce(F.sum("words").over(ahead), F.lit(0)).alias("base"))
    )
    inside = Window.partitionBy("source", "bucket").orderBy("key", "size", "text_hash")
    before = F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = sized.withColumn("row_no", F.row_number().over(inside)).withColumn("before", before)
    return (
        placed.alias("p")
        .join(cuts.alias("c"), F.col("p.source").eqNullSafe(F.col("c.source")) & (F.col("p.bucket") == F.col("c.bucket")))
        .select("doc_id", "p.source", "p.bucket", "key", "text_hash", "size", "row_no", "source_no", "source_size", "target",
                (F.col("base") + F.col("before")).alias("start"))
    )


def schedule(sources: DataFrame) -> DataFrame:
    """The mix in order: rows (position, source_no, block), block counting on through a source's repeats.

    Its steps are written tables: as parts of one plan they would be planned
    anew, by the driver, whenever a shuffle ends.
    """
    spark = sources.sparkSession
    wanted = F.ceil(F.floor("target") / F.lit(BLOCK))
    upto = Window.orderBy("source_no")
    shares = sources.withColumn("slots", wanted.cast("long")).withColumn(
        "end", F.sum("slots").over(upto)
    ).withColumn("total", F.sum("slots").over(Window.partitionBy())).filter("slots > 0")
    shares = materialize(shares.select(
        "source_no", "slots", "total", ((F.col("end") - F.col("slots")) / F.col("total")).alias("low"),
        (F.col("end") / F.col("total")).alias("high"),
    ), "mix-shares")
    n_slots = shares.agg(F.max("total")).first()[0] or 0
    chunk = max(CHUNK, math.isqrt(n_slots))
    j = F.col("id") + 1
    wide = F.shiftright(j, 20).cast("double") * ((GOLDEN * (1 << 20)) % 1.0)
    point = F.pmod(wide + F.pmod(j, F.lit(1 << 20)) * GOLDEN, F.lit(1.0))
    points = spark.range(n_slots).select(F.col("id").alias("position"), point.alias("point"))
    points = points.withColumn("cell", F.floor(F.col("point") * CELLS).cast("int"))
    last = F.least(F.floor(F.col("high") * CELLS), F.lit(CELLS - 1)).cast("int")
    cells = shares.withColumn("cell", F.explode(F.sequence(F.floor(F.col("low") * CELLS).cast("int"), last)))
    fallen = points.join(cells, "cell").filter((F.col("point") >= F.col("low")) & (F.col("point") < F.col("high")))
    fallen = fallen.select("position", "source_no", "slots", F.floor(F.col("position") / chunk).alias("chunk"))
    fallen = materialize(fallen, "mix-fallen")
    ahead = Window.partitionBy("source_no").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    counted = fallen.groupBy("source_no", "chunk").agg(F.count("*").alias("n"))
    bases = counted.withColumn("base", F.coalesce(F.sum("n").over(ahead), F.lit(0)))
    inside = Window.partitionBy("source_no", "chunk").orderBy("position")
    ranked = (
        fallen.withColumn("rank", F.row_number().over(inside) - 1)
        .join(bases.select("source_no", "chunk", "base"), ["source_no", "chunk"])
        .withColumn("block", F.col("base") + F.col("rank"))
        .filter(F.col("block") < F.col("slots"))
        .select("position", "source_no", "block")
    )
    got = counted.groupBy("source_no").agg(F.sum("n").alias("got"))
    late = (
        shares.join(got, "source_no", "left").withColumn("got", F.coalesce("got", F.lit(0)))
        .filter(F.col("got") < F.col("slots"))
        .withColumn("block", F.explode(F.sequence(F.col("got"), F.col("slots") - 1)))
        .select((F.lit(n_slots) + F.col("block")).alias("position"), "source_no", "block")
    )
    return materialize(ranked.unionByName(late), "mix-schedule")


def segments(placed: DataFrame) -> DataFrame:
    """What each block of a source's stream, read twice at most, holds of each document: (.., block, part).

    Documents the mix takes nothing of keep one row, with a block that no slot has.
    """
    stop = F.floor("target")
    read = placed.withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(REPEATS - 1)))).withColumn(
        "low", F.col("turn") * F.col("source_size") + F.col("start")
    ).withColumn("high", F.least(F.col("low") + F.col("size"), stop))
    taken = F.col("low") < F.col("high")
    spread = -1 - F.pmod(F.xxhash64("doc_id", "bucket", "row_no", "turn"), F.lit(1 << 20))
    blocks = F.sequence(F.floor(F.col("low") / BLOCK), F.floor((F.col("high") - 1) / BLOCK))
    cut = read.withColumn("block", F.explode(F.when(taken, blocks).otherwise(F.array(spread))))
    part = F.least(F.col("high"), (F.col("block") + 1) * BLOCK) - F.greatest(F.col("low"), F.col("block") * BLOCK)
    return cut.withColumn("part", F.when(taken, part).otherwise(F.lit(0)))


def taken_words(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target, taken, first_position and n_slots.

    ``taken`` counts the words the mix takes of the row, ``n_slots`` the slots
    of the schedule that hold some of them, and ``first_position`` is the
    earliest of these, null for a row that is not taken: sorted by it, the
    documents are in the order of the mix. A slot holds ``BLOCK`` words.

    A null text or one without words has size 0 and is not taken; a null
    source is a source of its own, last in order; null or repeated ids are
    rows like any other; an empty table gives an empty result. Other columns
    are not read. Each source's taken words are its target rounded down, no
    row exceeds ``REPEATS`` times its size, and reruns agree.
    """
    sized = materialize(sized_documents(docs), "mix-sizes")
    sources = materialize(source_targets(sized, weights, share), "mix-sources")
    cut = segments(placed_documents(sized, sources))
    joined = cut.join(schedule(sources), ["source_no", "block"], "left")
    held = F.when(F.col("part") > 0, F.col("position"))
    taken = F.sum(F.when(F.col("position").isNotNull(), F.col("part")).otherwise(F.lit(0))).alias("taken")
    row = ["doc_id", "source", "bucket", "row_no", "size", "source_size", "target"]
    mixed = joined.groupBy(*row).agg(taken, F.min(held).alias("first_position"), F.count(held).alias("n_slots"))
    return mixed.drop("bucket", "row_no")


def mix_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """The mix as whole documents: each row of ``docs`` as often as the schedule reads past its middle.

    All columns are kept. The words of a source differ from its target by less
    than one document; rows without words are left out, as no block holds
    them. Rows equal in id, source and text stand for each other.
    """
    sized = materialize(sized_documents(docs), "mix-sizes")
    sources = materialize(source_targets(sized, weights, share), "mix-sources")
    cut = segments(placed_documents(sized, sources))
    middle = F.col("turn") * F.col("source_size") + F.col("start") + F.floor(F.col("size") / 2)
    holds = (F.col("size") > 0) & (F.floor(middle / BLOCK) == F.col("block")) & (middle < F.floor("target"))
    chosen = cut.filter(holds).join(schedule(sources).select("source_no", "block"), ["source_no", "block"], "left_semi")
    times = chosen.groupBy("key", "text_hash", "source").agg(F.count("*").alias("times"))
    rows = sized.groupBy("key", "text_hash", "source").agg(F.count("*").alias("rows"))
    # Both sides are narrow; the texts are joined to what is left of them, once.
    wanted = materialize(times.alias("t").join(rows.alias("r"), _same("t", "r")).select("t.*", "rows"), "mix-wanted")
    keyed = docs.select(F.struct(*docs.columns).alias("row"), mix_key(F.col("doc_id")).alias("key"),
                        F.xxhash64("text").alias("text_hash"), "source")
    found = keyed.alias("k").join(wanted.alias("w"), _same("k", "w")).select("k.*", "times", "rows")
    alone = found.filter("rows = 1").select("row", "times")
    repeated = found.filter("rows > 1").groupBy("key", "text_hash", "source").agg(
        F.first("row").alias("row"), F.first("times").alias("times")
    ).select("row", "times")
    return alone.unionByName(repeated).withColumn("time", F.explode(F.sequence(F.lit(1), F.col("times")))).select("row.*")


def _same(left: str, right: str) -> Column:
    a, b = (lambda c, s=s: F.col(f"{s}.{c}") for s in (left, right))
    return (a("key") == b("key")) & (a("text_hash") == b("text_hash")) & a("source").eqNullSafe(b("source"))
