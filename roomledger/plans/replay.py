"""Replaying quarantined nights once their listing is known."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomledger.functions.joins import keep_in, keep_not_in, upsert
from roomledger.operators.dates import fill_created_backfill
from roomledger.operators.hosts import host_from_ranges, host_merge
from roomledger.operators.ranges import cut_at_months, overlay_ranges
from roomledger.operators.routing import fault_reason
from roomledger.plans.monthly_daily import DAILY_COLUMNS, monthly_daily
from roomledger.session import materialize
from roomledger.sources import tables


def split_backlog(backlog: DataFrame, property: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nights whose listing is now known, and those that stay."""
    return (
        keep_in(backlog, property, "property_ID", unique=True),
        keep_not_in(backlog, property, "property_ID", unique=True),
    )


def replay_backlog(
    backlog: DataFrame, property: DataFrame, host: DataFrame, host_inactive: DataFrame
) -> dict[str, DataFrame]:
    """The daily run over the known part, its hosts merged into the stored ones.

    Returns what to merge (daily, daily_inactive), the merged host tables,
    the listings with filled dates, the report on missing nights, and the
    backlog that remains: nights of unknown listings and nights that fail
    again, each with its ``reason``. Every night is in a range or in there.
    """
    backlog = backlog.drop("reason")
    known, rest = split_backlog(backlog, property)
    # a stored table on the listings' side lets a hot listing's nights be split
    dated = materialize(fill_created_backfill(property, known), "dated")
    outputs = monthly_daily(known, dated)
    return {
        "property": dated,
        "daily": outputs["daily"],
        "daily_inactive": outputs["daily_inactive"],
        "host": host_merge(host, outputs["host"]),
        "host_inactive": host_merge(host_inactive, outputs["host_inactive"]),
        "missing_rows": outputs["missing_rows"],
        "backlog": rest.unionByName(outputs["error"]).withColumn("reason", fault_reason(backlog.columns)),
    }


def merge_daily(outputs: dict[str, DataFrame], root: str) -> None:
    """Merge ranges into the stored months they lie in, and count the hosts they touch anew.

    Late ranges are cut at months and laid over the stored ranges of the same
    listings in these months: late nights replace stored ones, ranges that
    touch become one, and other listings' rows stay as they are. Hosts of
    late ranges, and of the stored ranges that these replace, are counted from
    the merged ranges of the months, so a second run changes nothing. Hosts
    are stored before the ranges they are counted from: a run that dies
    between the two can be repeated. Only months with late rows are read.
    """
    for name, host_name in (("daily", "host"), ("daily_inactive", "host_inactive")):
        month = F.date_format("start_date", "yyyy_MM")
        late = cut_at_months(outputs[name].select(*DAILY_COLUMNS)).withColumn("year_month", month)
        late = materialize(late, "late")
        months = tables.months_of(late)
        if not months:
            continue
        stored = tables.read_months(late, f"{root}/{name}", months)
        same = keep_in(stored, late, "property_ID")
        attributes = [c for c in DAILY_COLUMNS if c not in ("property_ID", "start_date", "end_date")]
        swept = overlay_ranges(same, late, ["property_ID"], attributes).withColumn("year_month", month)
        merged = materialize(keep_not_in(stored, late, "property_ID").unionByName(swept), "merged")

        affected = materialize(late.select("host_ID").unionByName(same.select("host_ID")).distinct(), "affected-hosts")
        redone = host_from_ranges(keep_in(merged, affected, "host_ID", null_safe=True, unique=True))
        redone = cut_at_months(redone).withColumn("year_month", month)
        hosts = tables.read_months(redone, f"{root}/{host_name}", months)
        others = keep_not_in(hosts, affected, "host_ID", null_safe=True, unique=True)
        counted = materialize(others.unionByName(redone), "merged-hosts")
        tables.write_months(counted, f"{root}/{host_name}", ["host_ID", "start_date"])
        tables.write_months(merged, f"{root}/{name}", ["property_ID", "start_date"])


def store_replay(outputs: dict[str, DataFrame], root: str, label: str) -> None:
    """Merge replayed ranges and their hosts into the stored months, store the listings with filled dates, write the reports.

    A second run changes nothing. The stored tables are by months of nights,
    as ``store_month`` leaves them: a range lies in its own month.
    """
    merge_daily(outputs, root)
    property = outputs["property"]
    stored = tables.read_or_empty(property, f"{root}/property")
    merged = materialize(upsert(stored, property, "property_ID"), "property")
    tables.replace_table(merged, f"{root}/property", ["property_ID"])
    for name in ("backlog", "missing_rows"):
        tables.write_quarantine(outputs[name], f"{root}/reports/{name}_{label}")
