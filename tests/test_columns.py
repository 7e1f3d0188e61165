from __future__ import annotations

import itertools

import pytest
from pyspark.sql import functions as F

from roomledger import fixed_values as fixed
from roomledger.functions import columns as C


def apply(spark, schema, rows, expression):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(expression).collect()]


@pytest.mark.parametrize("spellings, country", [(fixed.PROVINCE_SPELLINGS, "Canada"), (fixed.STATE_SPELLINGS, "United States")])
def test_every_spelling_has_its_canonical_name(spark, spellings, country):
    rows = [(text, name) for name, texts in spellings.items() for text in texts]
    named = C.scraped_region_alias(F.lit(country), F.col("text"))
    found = apply(spark, "text string, name string", rows, F.struct(named.alias("named"), "name"))
    assert all(r.named == r.name for r in found)


def test_spellings_are_exact(spark):
    rows = [("Quebec ",), ("NO",), ("Unknown",), (None,)]
    assert apply(spark, "t string", rows, C.scraped_region_alias(F.lit("Canada"), F.col("t"))) == ["Quebec ", "NO", "Unknown", None]
    assert apply(spark, "t string", [("No",)], C.scraped_region_alias(F.lit("United States"), F.col("t"))) == ["Missouri"]
    assert apply(spark, "t string", [("No",)], C.scraped_region_alias(F.lit("Peru"), F.col("t"))) == ["No"]


def strict(condition, yes, no):
    return None if condition is None else (yes if condition else no)


def both(*values):
    return False if False in values else (None if None in values else True)


def equal(a, b):
    return None if a is None or b is None else a == b


def expected_exception(scrape, geo, region):
    for claimed, located in fixed.COUNTRY_EXCEPTIONS.items():
        among = geo in located if len(located) > 1 else equal(geo, located[0])
        scrape = strict(both(equal(scrape, claimed), among), geo, scrape)
    scrape = strict(both(equal(scrape, "China"), equal(geo, "Taiwan"), equal(region, "Fujian")), geo, scrape)
    return strict(equal(scrape, fixed.BONAIRE_SCRAPED), fixed.BONAIRE, scrape)


def test_country_exception_is_null_strict(spark):
    scrapes = ["France", "United Kingdom", "United States", "China", fixed.BONAIRE_SCRAPED, "Peru", None]
    geos = ["Guadeloupe", "Guernsey", "U.S. Virgin Islands", "Taiwan", "China", "Peru", None]
    rows = list(itertools.product(scrapes, geos, ["Fujian", "Taipei", None]))
    named = C.country_exception(F.col("s"), F.col("g"), F.col("r"))
    found = apply(spark, "s string, g string, r string", rows, named)
    assert found == [expected_exception(*row) for row in rows]
    literal = [("France", None, None, "France"), ("France", "Guadeloupe", None, "Guadeloupe"), ("France", "Peru", None, "France"),
               ("United Kingdom", None, None, None), ("United Kingdom", "Guernsey", None, "Guernsey"), ("United States", None, None, None)]
    assert apply(spark, "s string, g string, r string, e string", literal, named) == [row[3] for row in literal]


def test_country_alias_puts_country_rules_first(spark):
    rows = [
        ("Lao", "Puerto Rico", "Laos"), ("United States", "Puerto Rico", "Puerto Rico"), (None, "Bhutan", "Bhutan"),
        ("United States", "United States Virgin Islands", "U.S. Virgin Islands"), ("Peru", None, "Peru"), (None, None, None),
    ]
    found = apply(spark, "c string, r string, e string", rows, C.country_alias(F.col("c"), F.col("r")))
    assert found == [r[2] for r in rows]


def test_place_names(spark):
    rows = [
        ("Halifax (RGM)", "Halifax", "Halifax"), ("Victoria, Subd. A (SC)", "Victoria", "Victoria"),
        ("East Hants No. 1 (MD)", "East Hants", "East Hants No."), ("Kings A (T)", "Kings", "Kings A"),
        ("Inverness", None, "Inverness"), ("Fort (Old) (T)", "Fort (Old)", "Fort"), (None, None, None),
    ]
    found = apply(spark, "n string, a string, b string", rows, F.struct(
        C.clean_place_name(F.col("n")).alias("a"), C.leading_place_name(F.col("n")).alias("b")))
    assert [(r.a, r.b) for r in found] == [r[1:] for r in rows]


def test_months(spark):
    rows = [("2020_01", "2019_12"), ("2020_03", "2020_02"), ("2020_10", "2020_09"), ("2019_12", "2019_11")]
    assert apply(spark, "l string, e string", rows, C.label_prev(F.col("l"))) == [r[1] for r in rows]
    found = apply(spark, "l string", [("2019_12",)], F.concat_ws(" ", C.month_start(F.col("l")), C.next_month_start(F.col("l")), C.month_28th(F.col("l"))))
    assert found == ["2019-12-01 2020-01-01 2019-12-28"]


def test_titles_and_hosts(spark):
    assert apply(spark, "t string", [("a\n\"b'\r c",), (None,)], C.clean_title(F.col("t"))) == ["ab c", None]
    rows = [("a", "h", "a"), (None, "h", "h"), (None, None, None)]
    assert apply(spark, "a string, h string, e string", rows, C.derive_host_id(F.col("a"), F.col("h"))) == ["a", "h", None]


def test_not_among_keeps_nulls(spark):
    assert apply(spark, "t string", [("x",), ("y",), (None,)], C.not_among(F.col("t"), ["x"])) == [False, True, True]
