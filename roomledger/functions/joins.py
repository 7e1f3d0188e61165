"""Joins with the reference semantics for nulls and a checked broadcast."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roomledger.session import materialize

# Most bytes of files a broadcast lookup may have; in memory it is a few times as large.
BROADCAST_BYTES = 32 * 1024**2
# Rows of one key that a task may get beyond that limit.
PIECE = 1_000_000


def _keys_match(keys: list[str], null_safe: bool) -> Column:
    pairs = (
        F.col(f"f.{k}").eqNullSafe(F.col(f"l.{k}")) if null_safe else F.col(f"f.{k}") == F.col(f"l.{k}")
        for k in keys
    )
    return reduce(lambda a, b: a & b, pairs)


def stored_bytes(stored: DataFrame) -> int:
    """Size of a stored table by its files, without a job."""
    return int(str(stored._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def salted(facts: DataFrame, lookup: DataFrame, on: list[str], piece: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``_salt``: keys with more than ``piece`` facts are cut in as many pieces as they need.

    Only these keys' rows of the lookup are copied, once per piece; all others
    have salt 0. The salt is a hash of the row, hence the same on a retry.
    """
    heavy = facts.groupBy(*on).agg(F.count("*").alias("_n")).filter(F.col("_n") > piece)
    heavy = materialize(heavy.withColumn("_pieces", F.ceil(F.col("_n") / piece)).drop("_n"), "heavy-keys").alias("h")
    # one row per ``piece`` facts at most
    known = [F.broadcast(heavy), reduce(lambda a, b: a & b, [F.col(f"s.{k}").eqNullSafe(F.col(f"h.{k}")) for k in on]), "left"]
    pieces = F.coalesce("_pieces", F.lit(1).cast("long"))
    salt = F.pmod(F.xxhash64(*[F.col(f"s.{c}") for c in facts.columns]), pieces)
    left = facts.alias("s").join(*known).select("s.*", salt.alias("_salt"))
    copies = F.explode(F.sequence(F.lit(0).cast("long"), pieces - 1))
    return left, lookup.alias("s").join(*known).select("s.*", copies.alias("_salt"))


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: list[str],
    how: str = "left",
    *,
    null_safe: bool = False,
    stored: bool = False,
    limit: int = BROADCAST_BYTES,
    piece: int = PIECE,
) -> DataFrame:
    """Join a large table to a lookup that is usually, but not provably, small.

    The lookup is written out, unless it is ``stored`` already, and measured
    by its files. Up to ``limit`` bytes it is broadcast and the facts are not
    shuffled at all. Beyond it both sides are shuffled, heavy keys in pieces
    (see ``salted``), and facts with a null key, which find nothing, are not.
    ``how`` is one of inner, left, left_semi, left_anti.
    """
    lookup = lookup if stored else materialize(lookup, "lookup")
    extra = [c for c in lookup.columns if c not in on]
    keys = list(on)
    missing = None
    if stored_bytes(lookup) <= limit:
        right = F.broadcast(lookup.alias("l"))
    else:
        if not null_safe:
            known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in on])
            missing, facts = facts.filter(~known), facts.filter(known)
        facts, lookup = salted(facts, lookup, keys, piece)
        keys, right = [*keys, "_salt"], lookup.alias("l")
    joined = facts.alias("f").join(right, _keys_match(keys, null_safe), how)
    if how in ("left_semi", "left_anti"):
        joined = joined.drop("_salt")
        return joined.unionByName(missing) if missing is not None and how == "left_anti" else joined
    kept = [F.col(f"f.{c}") for c in facts.columns if c != "_salt"]
    joined = joined.select(*kept, *[F.col(f"l.{c}") for c in extra])
    return joined.unionByName(missing, allowMissingColumns=True) if missing is not None and how == "left" else joined


def _key_set(right: DataFrame, keys: tuple[str, ...], unique: bool) -> DataFrame:
    """The keys of ``right``. Copies of a key combine before the shuffle, unless
    it is known to be unique: a plain scan on this side is what lets a hot key
    on the other side be split at run time."""
    wanted = right.select(*keys)
    return (wanted if unique else wanted.distinct()).alias("l")


def keep_in(
    left: DataFrame, right: DataFrame, *keys: str, null_safe: bool = False, unique: bool = False
) -> DataFrame:
    """Rows of ``left`` whose key occurs in ``right``; null_safe lets null match null."""
    return left.alias("f").join(_key_set(right, keys, unique), _keys_match(list(keys), null_safe), "left_semi")


def keep_not_in(
    left: DataFrame, right: DataFrame, *keys: str, null_safe: bool = False, unique: bool = False
) -> DataFrame:
    """The complement of keep_in: a null key stays unless null_safe finds a null."""
    return left.alias("f").join(_key_set(right, keys, unique), _keys_match(list(keys), null_safe), "left_anti")


def upsert(base: DataFrame, updates: DataFrame, *keys: str, null_safe: bool = False) -> DataFrame:
    """Replace every base row whose key comes back in ``updates``."""
    kept = keep_not_in(base, updates, *keys, null_safe=null_safe)
    return kept.unionByName(updates, allowMissingColumns=True)
