"""Nights and date ranges: compress, expand, and summed counts over time.

All three keep to one shuffle on the key and one sort by date; the window
functions share that order, so no further exchange or sort is planned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def unique_nights(nights: DataFrame, keys: list[str], date: str = "date") -> DataFrame:
    """One row per key and date: the greatest by the other columns in order.

    A plain aggregate, so copies combine before they are shuffled.
    """
    rest = [c for c in nights.columns if c not in (*keys, date)]
    best = nights.groupBy(*keys, date).agg(F.max(F.struct(*rest)).alias("_best"))
    return best.select(*keys, date, "_best.*")


def compress_ranges(
    nights: DataFrame,
    keys: list[str],
    attributes: list[str],
    *,
    break_at_month: bool = False,
) -> DataFrame:
    """Consecutive nights with equal attributes become one row.

    Needs unique (keys, date). Instead of grouping runs, only their first and
    last nights are kept and the last is read from the next kept row.
    """
    order = Window.partitionBy(*keys).orderBy("date")
    now = F.struct(*[F.col(a) for a in attributes]) if attributes else F.lit(True)
    marked = nights.select(*keys, "date", *attributes)
    marked = marked.withColumn("_now", now)
    marked = marked.select(
        "*",
        (
            F.lag("date").over(order).eqNullSafe(F.date_sub("date", 1)) & F.lag("_now").over(order).eqNullSafe(F.col("_now"))
        ).alias("_goes_on"),
        (
            F.lead("date").over(order).eqNullSafe(F.date_add("date", 1)) & F.lead("_now").over(order).eqNullSafe(F.col("_now"))
        ).alias("_is_followed"),
    ).drop("_now")
    if break_at_month:
        marked = marked.withColumn("_goes_on", F.col("_goes_on") & (F.dayofmonth("date") != 1))
        last = F.col("date") == F.last_day("date")
        marked = marked.withColumn("_is_followed", F.col("_is_followed") & ~last)
    ends = marked.filter(~F.col("_goes_on") | ~F.col("_is_followed"))
    end = F.when(~F.col("_is_followed"), F.col("date")).otherwise(F.lead("date").over(order))
    ranges = ends.withColumn("end_date", end).filter(~F.col("_goes_on"))
    return ranges.select(*keys, F.col("date").alias("start_date"), "end_date", *attributes)


def expand_ranges(ranges: DataFrame) -> DataFrame:
    """One row per night of each range."""
    rest = [c for c in ranges.columns if c not in ("start_date", "end_date")]
    return ranges.select(*rest, F.explode(F.sequence("start_date", "end_date")).alias("date"))


def cut_at_months(ranges: DataFrame) -> DataFrame:
    """Ranges in pieces of one calendar month each."""
    first = F.trunc("start_date", "month")
    months = F.explode(F.sequence(first, F.trunc("end_date", "month"), F.expr("interval 1 month")))
    cut = ranges.withColumn("_month", months)
    return cut.withColumn("start_date", F.greatest("start_date", "_month")).withColumn(
        "end_date", F.least("end_date", F.last_day("_month"))
    ).drop("_month")


def overlay_ranges(stored: DataFrame, late: DataFrame, keys: list[str], attributes: list[str]) -> DataFrame:
    """Stored ranges with late ones laid over them, as maximal ranges within months.

    On days that both have the late one counts. Each side's ranges of a key
    must not overlap. A range is two events, its start and the day after its
    end; between two events what holds does not change, so a key's window has
    two rows per range at most and nothing is expanded to nights. Pieces that
    touch and agree in all attributes become one; none crosses a month.
    """
    held = F.struct(*attributes)
    sides = []
    for name, side in (("late", late), ("stored", stored)):
        begins = F.struct(F.col("start_date").alias("date"), F.lit(1).alias("on"), held.alias("held"))
        ends = F.struct(F.date_add("end_date", 1).alias("date"), F.lit(0).alias("on"), F.lit(None).cast(side.select(held.alias("h")).schema["h"].dataType).alias("held"))
        events = cut_at_months(side).select(*keys, F.inline(F.array(begins, ends)))
        # where one range ends and the next begins, the beginning counts
        sides.append(events.groupBy(*keys, "date").agg(F.max(F.struct("on", "held")).alias("now")).withColumn("side", F.lit(name)))
    days = sides[0].unionByName(sides[1]).groupBy(*keys, "date").agg(
        *[F.max(F.when(F.col("side") == name, F.col("now"))).alias(name) for name in ("late", "stored")]
    )
    order = Window.partitionBy(*keys).orderBy("date")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    state = days.select(*keys, "date", *[F.last(name, ignorenulls=True).over(so_far).alias(name) for name in ("late", "stored")])
    best = F.when(F.col("late.on") == 1, F.col("late")).when(F.col("stored.on") == 1, F.col("stored"))
    state = state.select(*keys, "date", best.alias("now"))
    goes_on = F.lag("now").over(order).eqNullSafe(F.col("now")) & (F.row_number().over(order) > 1)
    changed = state.withColumn("_same", goes_on & (F.col("now").isNull() | (F.dayofmonth("date") != 1))).filter(~F.col("_same"))
    ranges = changed.withColumn("end_date", F.date_sub(F.lead("date").over(order), 1)).filter(F.col("now").isNotNull())
    return ranges.select(*keys, F.col("date").alias("start_date"), "end_date", "now.held.*")


def sum_over_time(ranges: DataFrame, keys: list[str], amount: str) -> DataFrame:
    """Sum the amounts of overlapping ranges per key and day, as maximal ranges.

    Each range is two changes, one when it starts and one the day after it
    ends. Changes are summed per key and day first, so that however many
    ranges a key has, its window holds one row per day at most; days whose
    changes cancel are no boundary at all. Nothing is expanded to nights.
    """
    changes = F.array(
        F.struct(F.col("start_date").alias("date"), F.col(amount).cast("long").alias("change")),
        F.struct(F.date_add("end_date", 1).alias("date"), (-F.col(amount)).cast("long").alias("change")),
    )
    per_day = (
        ranges.select(*keys, F.inline(changes))
        .groupBy(*keys, "date")
        .agg(F.sum("change").alias("change"))
        .filter("change != 0")
    )
    order = Window.partitionBy(*keys).orderBy("date")
    running = per_day.select(
        *keys,
        F.col("date").alias("start_date"),
        F.date_sub(F.lead("date").over(order), 1).alias("end_date"),
        F.sum("change").over(order.rowsBetween(Window.unboundedPreceding, 0)).alias(amount),
    )
    return running.filter(F.col(amount) > 0)
