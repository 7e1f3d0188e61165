"""Scraped locations: batches to scrape, and the results kept per listing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roomledger import fixed_values as fixed
from roomledger.functions.joins import keep_not_in, upsert
from roomledger.session import materialize

SCRAPE_COLUMNS = ["property_ID", "city", "region", "country", "raw", "date"]


def row_numbers(df: DataFrame, key: str) -> DataFrame:
    """Numbers the rows 1..n without one task ordering them all.

    The order is by a hash prefix of the key, then the key. Rows are numbered
    within each of 4096 buckets, and the buckets' sizes give the offsets.
    """
    bucketed = df.withColumn("_bucket", F.substring(F.md5(F.col(key)), 1, 3))
    sizes = bucketed.groupBy("_bucket").agg(F.count("*").alias("_n"))
    # at most 4096 rows, whatever the input
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_bucket").orderBy(key)
    numbered = bucketed.withColumn("_inside", F.row_number().over(inside))
    numbered = numbered.join(F.broadcast(offsets), "_bucket")
    return numbered.withColumn("row_number", F.col("_offset") + F.col("_inside")).drop("_bucket", "_inside", "_offset")


def worklist_batches(worklist: DataFrame, size: int = fixed.SCRAPE_BATCH) -> DataFrame:
    """Adds ``batch`` 0, 1, 2, …, each of ``size`` listings but the last of a priority.

    Priority 1 comes first and shares no batch with what follows; a list
    without priorities is one pool.
    """
    if "priority" not in worklist.columns:
        return _in_batches(worklist, size, F.lit(0).cast("long"))
    worklist = materialize(worklist, "worklist")
    first, rest = worklist.filter("priority = 1"), worklist.filter("priority <> 1 OR priority IS NULL")
    n_first = -(-first.count() // size)
    return _in_batches(first, size, F.lit(0).cast("long")).unionByName(_in_batches(rest, size, F.lit(n_first).cast("long")))


def _in_batches(pool: DataFrame, size: int, before: Column) -> DataFrame:
    numbered = row_numbers(pool, "property_ID")
    batch = F.floor((F.col("row_number") - 1) / F.lit(size)).cast("long")
    return numbered.withColumn("batch", before + batch).drop("row_number")


def dedup_keep_first(scrapes: DataFrame) -> DataFrame:
    """One successful scrape per listing and place: the latest, then the least raw text."""
    keys = ["property_ID", "city", "region", "country"]
    good = scrapes.filter(F.col("raw").isNotNull())
    # days before the epoch, so that the smallest is the newest and no date comes last
    age = F.coalesce(-F.unix_date("date"), F.lit(2**31 - 1))
    best = good.groupBy(*keys).agg(F.max("date").alias("date"), F.min_by("raw", F.struct(age, "raw")).alias("raw"))
    return best.select(*SCRAPE_COLUMNS)


def latest_per_key(scrapes: DataFrame) -> DataFrame:
    """The latest scrapes of each listing; ties stay, null dates never win.

    Aggregate and join back instead of a window, so that no listing's scrapes
    have to be ordered in one task; with the aggregate stored, the join can
    split them too.
    """
    latest = materialize(scrapes.groupBy("property_ID").agg(F.max("date").alias("date")), "latest")
    return scrapes.join(latest, ["property_ID", "date"], "left_semi").select(*scrapes.columns)


def merge_scrapes(results: DataFrame, new: DataFrame) -> DataFrame:
    """Scrape results after a round: new rows replace, then latest per listing."""
    return latest_per_key(dedup_keep_first(upsert(results, new, "property_ID")))


def single_scrape(scrapes: DataFrame) -> DataFrame:
    """One scrape per listing: the latest, ties to the greatest country, region, city.

    Resolves ties before joins, which would otherwise double the listing.
    """
    best = F.max(F.struct("date", "country", "region", "city")).alias("_best")
    return scrapes.groupBy("property_ID").agg(best).select(
        "property_ID",
        F.col("_best.country").alias("country_scrape"),
        F.col("_best.region").alias("region_scrape"),
        F.col("_best.city").alias("city_scrape"),
    )


def orphan_accumulate(rows: DataFrame, property: DataFrame, orphans: DataFrame, key: str) -> DataFrame:
    """The running table of rows without a listing, with this month's added.

    ``key`` is the listing for nights, the host for host counts.
    """
    found = keep_not_in(rows, property, key, null_safe=True, unique=key == "property_ID")
    return found.unionByName(orphans, allowMissingColumns=True)
