from __future__ import annotations

import re
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from roomledger.llm import pseudonyms as P
from tests.llm.cases import empty, messy

KEY = "a test"


def luhn(number: str) -> bool:
    digits = [int(c) for c in re.sub(r"\D", "", number)][::-1]
    return sum(d if k % 2 == 0 else 2 * d - 9 * (d > 4) for k, d in enumerate(digits)) % 10 == 0


def mod97(account: str) -> int:
    plain = account.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97


@pytest.fixture(scope="module")
def replaced(spark):
    values = ["the.72@mail3.example.com", "THE.72@MAIL3.example.com", "el.81@mail3.example.com", "4012888888881881", "4012-8888-8888-1881",
              "4012888888881882", "+1 (017) 555-7713", "+1 017 555 7713", "233.254.104.120", "300.1.1.1", "4.0.", "1984-02-29", "29.02.1984",
              "1999-13-01", "12/31/1999", "078-05-1120", "666-05-1120", "DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432",
              "GB82WEST12345698765433", "b44e15e09fd311c3cf3163b66d5a9875b883d8ce"]
    df = spark.createDataFrame([(f"before {v} after",) for v in values] + [(f"{v}###",) for v in values[:4]], "text string")
    rows = P.pseudonymise(df, KEY).collect()
    return {v: r.text[7:-6] for v, r in zip(values, rows)}, values, rows


def test_valid_values_go_to_valid_values_of_their_format(replaced):
    new, values, rows = replaced
    kept = {"4012888888881882", "300.1.1.1", "4.0.", "1999-13-01", "666-05-1120", "GB82WEST12345698765433"}
    assert {v for v in values if new[v] == v} == kept
    shape = lambda v: re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub("[0-9]", "9", v)))
    for v in values:
        if "." not in v or "@" in v:
            assert shape(new[v]) == shape(v)
    assert luhn(new["4012888888881881"]) and mod97(new["DE89 3704 0044 0532 0130 00"]) == 1 == mod97(new["GB82WEST12345698765432"])
    assert all(0 <= int(x) < 256 for x in new["233.254.104.120"].split("."))
    assert date.fromisoformat(new["1984-02-29"]).strftime("%d.%m.%Y") == new["29.02.1984"]
    area, group, serial = map(int, new["078-05-1120"].split("-"))
    assert 1 <= area < 900 and area != 666 and group and serial
    assert re.fullmatch("[0-9a-f]{40}", new["b44e15e09fd311c3cf3163b66d5a9875b883d8ce"])
    assert [r.n_private for r in rows[:3]] == [1, 1, 1]


def test_equal_values_stay_linked_whatever_stands_around_them(replaced):
    new, values, rows = replaced
    assert new["THE.72@MAIL3.example.com"].lower() == new["the.72@mail3.example.com"]
    assert new["the.72@mail3.example.com"].split("@")[1] == new["el.81@mail3.example.com"].split("@")[1]
    assert new["4012-8888-8888-1881"].replace("-", "") == new["4012888888881881"]
    assert re.sub(r"\D", "", new["+1 (017) 555-7713"]) == re.sub(r"\D", "", new["+1 017 555 7713"])
    for v, r in zip(values, rows[len(values):]):
        assert r.text == new[v] + "###"


def test_permutations_are_one_to_one(spark):
    days = spark.createDataFrame([(str(date(1900, 1, 1) + timedelta(days=k)),) for k in range(0, 73170, 10)], "v string")
    found = days.select(P._date(F.col("v"), KEY).alias("n")).collect()
    assert len({r.n for r in found}) == 7317 and all(date(1900, 1, 1) <= date.fromisoformat(r.n) <= date(2100, 5, 1) for r in found)
    number = F.lpad(F.col("id").cast("string"), 3, "0")
    assert spark.range(1000).select(P.permuted_digits(number, KEY, "x").alias("n")).distinct().count() == 1000
    word = F.concat(F.chr(97 + F.col("id") % 26), (F.floor(F.col("id") / 26)).cast("string"))
    assert spark.range(260).select(P.permuted_text(word, KEY, "x").alias("n")).distinct().count() == 260
    pair = P.permuted_pair(F.floor(F.col("id") / 7), F.col("id") % 7, F.lit(5), F.lit(7), KEY, "x")
    assert spark.range(35).select(pair.alias("n")).distinct().count() == 35


@pytest.mark.parametrize(("first", "second"), [(1, 1), (1, 2), (2, 1), (2, 2)])
def test_all_dates_of_a_shape_are_permuted_among_themselves(spark, first, second):
    def is_date(y, m, d):
        try:
            return bool(date(y, m, d))
        except ValueError:
            return False

    years = [*range(1900, 2100, 9), 1904, 2000, 2096] if (first, second) != (1, 1) else range(1900, 2101)
    write = lambda a, b, y: f"{a:0{first}}/{b:0{second}}/{y}"
    span = {1: range(1, 10), 2: range(1, 32)}
    both = lambda y, a, b: is_date(y, b, a) or is_date(y, a, b)
    values = sorted({write(a, b, y) for y in years for a in span[first] for b in span[second] if both(y, a, b)})
    found = spark.createDataFrame([(v,) for v in values], "v string").select(P._date(F.col("v"), KEY).alias("n")).collect()
    assert len({r.n for r in found}) == len(values)
    for r in found:
        a, b, y = r.n.split("/")
        assert (len(a), len(b), len(y)) == (first, second, 4) and 1900 <= int(y) <= 2100 and both(int(y), int(a), int(b))
    if (first, second) == (1, 1):  # the whole shape: nothing but itself can be reached
        assert {r.n for r in found} == set(values)


def test_values_beside_times_hyphens_and_other_scripts(spark):
    texts = ["at 2020-01-02T10:00:00Z", "on 2020-01-02.", "联系zhang@example.com请", "to zhang@example.com", "josé.pérez@example.com",
             "tel 555-123-4567", "born 03-12-1980", "born 03/12/1980", "29/02/2023 30-02-2020 2/29/1900"]
    new = [r.text for r in P.pseudonymise(spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1), KEY).collect()]
    assert new[0][3:13] == new[1][3:13] != "2020-01-02" and new[0].endswith("T10:00:00Z")
    assert new[2][2:-1] == new[3][3:] != "zhang@example.com" and new[2][:2] == "联系" and new[2][-1] == "请"
    assert re.fullmatch(r"[a-z]{3}[^\W\da-z]\.[a-z][^\W\da-z][a-z]{3}@[a-z]{7}\.com", new[4]) and "jos" not in new[4]
    assert re.fullmatch(r"tel \d{3}-\d{3}-\d{4}", new[5]) and new[5] != texts[5]
    assert new[6].replace("-", "/") == new[7] != texts[7]
    assert new[8] == texts[8]  # no such days


def test_messy_rows_and_plain_plan(spark):
    found = P.pseudonymise(messy(spark), KEY)
    assert set(found.columns) == set(messy(spark).columns)
    key = lambda r: (r.doc_id or 0, r.text or "")
    for before, after in zip(sorted(messy(spark).collect(), key=key), sorted(found.collect(), key=key)):
        assert after.text == before.text and after.n_private == 0 and after["size"] == "x"
    assert P.pseudonymise(empty(spark), KEY).count() == 0
    assert not re.search("Python|Pandas|InArrow", found._jdf.queryExecution().executedPlan().toString())
