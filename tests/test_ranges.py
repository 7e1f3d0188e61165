from __future__ import annotations

import random
from collections import Counter
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from roomledger.operators import hosts, ranges

DAY = date(2024, 1, 20)
NIGHTS = "property_ID string, date date, status string, price int"


def day(n: int) -> date:
    return DAY + timedelta(n)


def random_nights(seed: int):
    dice = random.Random(seed)
    return [
        (f"ab-{i}", day(n), dice.choice(["A", "A", "A", "R", None]), dice.choice([100, 100, None]))
        for i in range(8)
        for n in range(40)
        if dice.random() < 0.8
    ]


@pytest.mark.parametrize("by_month", [False, True])
def test_expand_undoes_compress_and_ranges_are_maximal(spark, by_month):
    given = random_nights(1)
    nights = spark.createDataFrame(given, NIGHTS)
    packed = ranges.compress_ranges(nights, ["property_ID"], ["status", "price"], break_at_month=by_month)
    back = [tuple(r) for r in ranges.expand_ranges(packed).select("property_ID", "date", "status", "price").collect()]
    assert Counter(back) == Counter(given)
    rows = packed.collect()
    start = {(r.property_ID, r.status, r.price, r.start_date) for r in rows}
    for r in rows:
        after = (r.property_ID, r.status, r.price, r.end_date + timedelta(1))
        if after in start:
            assert by_month and after[3].day == 1
        if by_month:
            assert r.start_date.month == r.end_date.month


def test_compress_breaks_at_gap_price_and_null(spark):
    given = [("a", day(0), "A", 1), ("a", day(1), "A", None), ("a", day(2), "A", None), ("a", day(4), "A", None)]
    packed = ranges.compress_ranges(spark.createDataFrame(given, NIGHTS), ["property_ID"], ["status", "price"])
    found = sorted((r.start_date, r.end_date, r.price) for r in packed.collect())
    assert found == [(day(0), day(0), 1), (day(1), day(2), None), (day(4), day(4), None)]


def test_unique_nights_takes_the_greatest_copy(spark):
    given = [("a", day(0), "A", 1), ("a", day(0), "R", None), ("a", day(0), "R", 3), (None, day(0), "A", 2), (None, day(0), "A", 1)]
    unique = ranges.unique_nights(spark.createDataFrame(given, NIGHTS), ["property_ID"])
    assert {tuple(r) for r in unique.collect()} == {("a", day(0), "R", 3), (None, day(0), "A", 2)}


HOST = "host_ID string, start_date date, end_date date, listing_type string, housing boolean, count bigint"


def random_hosts(seed: int, n: int = 120):
    dice = random.Random(seed)
    found = []
    for _ in range(n):
        start = dice.randrange(30)
        host = dice.choice(["h0", "h1", None, f"h{seed}"])
        found.append((host, day(start), day(start + dice.randrange(9)), dice.choice("xy"), True, dice.randrange(1, 4)))
    return found


def per_night(rows) -> Counter:
    total = Counter()
    for host, start, end, kind, housing, count in rows:
        for n in range((end - start).days + 1):
            total[(host, start + timedelta(n), kind, housing)] += count
    return total


def test_sum_over_time_equals_night_by_night(spark):
    given = random_hosts(5)
    summed = ranges.sum_over_time(spark.createDataFrame(given, HOST), hosts.HOST_KEYS, "count").select(*hosts.HOST_COLUMNS)
    found = [tuple(r) for r in summed.collect()]
    assert per_night(found) == per_night(given)
    starts = {(r[0], r[1], r[3], r[4]): r[5] for r in found}
    assert all(starts.get((r[0], r[2] + timedelta(1), r[3], r[4])) != r[5] for r in found)


def test_host_merge_sums_all_of_an_affected_host(spark):
    old = [tuple(r) for r in ranges.sum_over_time(
        spark.createDataFrame(random_hosts(2), HOST), hosts.HOST_KEYS, "count").select(*hosts.HOST_COLUMNS).collect()]
    new = random_hosts(3)
    merged = hosts.host_merge(spark.createDataFrame(old, HOST), spark.createDataFrame(new, HOST))
    found = [tuple(r) for r in merged.collect()]
    assert per_night(found) == per_night(old + new)
    untouched = {r for r in old if r[0] == "h2"}
    assert untouched <= set(found)


def test_host_ranges_from_nights_and_from_ranges_agree(spark):
    nights = spark.createDataFrame(random_nights(7), NIGHTS)
    nights = nights.withColumn("host_ID", F.when(F.col("property_ID") < "ab-4", "h")).withColumn("listing_type", F.lit("t"))
    nights = nights.withColumn("housing", F.lit(True))
    packed = ranges.compress_ranges(nights, ["property_ID"], ["status", "price", "host_ID", "listing_type", "housing"])
    one = {tuple(r) for r in hosts.host_ranges(nights).collect()}
    two = {tuple(r) for r in hosts.host_from_ranges(packed).collect()}
    assert one == two


def test_known_hosts_lets_null_match_null(spark):
    host = spark.createDataFrame(random_hosts(4), HOST)
    with_null = spark.sql("select * from values ('h0'), (cast(null as string)) as t(host_ID)")
    found = {r.host_ID for r in hosts.known_hosts(host, with_null).collect()}
    assert found == {"h0", None}
    assert {r.host_ID for r in hosts.known_hosts(host, with_null.filter("host_ID = 'h0'")).collect()} == {"h0"}


def test_cross_platform_hosts_with_none_one_and_two_links(spark):
    rows = [
        ("1", "m1", None, "m1"), ("2", "a1", "a1", "m1"), ("3", "a1", "a1", "m1"),
        ("4", "m2", None, "m2"), ("5", "a1", "a1", "m2"), ("6", "a2", "a2", "m2"),
        ("7", "m3", None, "m3"),
    ]
    listed = spark.createDataFrame(rows, "property_ID string, host_ID string, ab_host string, ha_host string")
    found = hosts.cross_platform_hosts(listed).collect()
    assert [(r.property_ID, r.linked_ab_host) for r in found] == [("1", "a1")]


def test_overlay_equals_laying_nights_over_nights(spark):
    """Late nights win, ranges that touch and agree become one, none crosses a month; nulls are values like others."""
    dice = random.Random(11)
    day0 = date(2024, 1, 10)
    rows = {"stored": [], "late": []}
    nights: dict[tuple, tuple] = {}
    for side in ("stored", "late"):
        for key in ("a", "b", None, "only " + side):
            at = dice.randint(0, 10)
            while at < 120:
                last = at + dice.choice([0, 0, 3, 12, 45])
                held = (dice.choice(["x", "y", None]), dice.choice([1, None]))
                rows[side].append((key, day0 + timedelta(at), day0 + timedelta(last), *held))
                nights.update({(key, day0 + timedelta(d)): held for d in range(at, last + 1)})
                at = last + 1 + dice.choice([0, 0, 1, 6])
    schema = "key string, start_date date, end_date date, status string, price int"
    made = ranges.overlay_ranges(*[spark.createDataFrame(rows[s], schema) for s in ("stored", "late")], ["key"], ["status", "price"])
    found = made.collect()
    back = {}
    for r in found:
        assert (r.start_date.year, r.start_date.month) == (r.end_date.year, r.end_date.month)
        for d in range((r.end_date - r.start_date).days + 1):
            assert back.setdefault((r.key, r.start_date + timedelta(d)), (r.status, r.price)) == (r.status, r.price)
    assert back == nights and sum((r.end_date - r.start_date).days + 1 for r in found) == len(nights)
    starts = sum(nights.get((k, d - timedelta(1)), "none") != held or d.day == 1 for (k, d), held in nights.items())
    assert len(found) == starts
    again = ranges.overlay_ranges(made, spark.createDataFrame(rows["late"], schema), ["key"], ["status", "price"])
    assert {tuple(r) for r in again.collect()} == {tuple(r) for r in found}
