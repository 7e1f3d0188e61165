from __future__ import annotations

import random
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from roomledger import fixed_values as fixed
from roomledger import session
from roomledger.sources import delivered, records, tables


def write(path, lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def property_line(**values):
    return ",".join(values.get(name, "") for _, name, _ in fixed.PROPERTY_COLUMNS)


HEADER = ",".join(f'"{raw}"' for raw, _, _ in fixed.PROPERTY_COLUMNS)


def test_property_file_is_read_by_name_and_type(spark, tmp_path):
    lines = [
        "Extra," + HEADER,
        "x," + property_line(property_ID="ab-1", listing_title='"a ""big"" one\nby the sea"', created="2020-01-05", latitude="1.5",
                             superhost="t", instant_book="0", bedrooms="2"),
        "x," + property_line(property_ID=" ab-2 ", created="5 January", superhost=" FALSE"),
        "x," + property_line(property_ID="ab-3", instant_book="perhaps"),
        "x,ab-4,short",
        "x," + property_line(property_ID="ab-5", bedrooms="many", created="2020-02-30"),
        "x," + property_line(listing_title="NA", listing_type="t"),
    ]
    read = delivered.read_property(spark, write(tmp_path / "property.csv", lines))
    rows = {r.property_ID: r for r in read.collect()}
    assert len(read.columns) == 37
    assert rows["ab-2"].faulty_texts == "created=5 January" and rows["ab-1"].faulty_texts is None
    one = rows["ab-1"]
    assert (one.listing_title, one.created, one.latitude, one.superhost, one.instant_book, one.bedrooms, one.parse_error) == (
        'a "big" one\nby the sea', date(2020, 1, 5), 1.5, True, False, 2.0, False)
    assert rows["ab-2"].parse_error and rows["ab-2"].superhost is False
    assert rows["ab-3"].parse_error and rows["ab-5"].parse_error
    assert not rows["ab-4"].parse_error and rows["ab-4"].listing_title == "short"
    assert rows[None].listing_title is None and not rows[None].parse_error
    assert delivered.parse_errors(read).count() == 3


def test_records_with_line_breaks_are_read_in_many_tasks(spark, tmp_path):
    chance = random.Random(4)
    cells = ["", "a", "NA", '"q, ""x"""', '"one\ntwo"', '"\n\n"', '"say ""hi""\n"', 'in"ch', "5'", ' "blank', '"' + "long\n" * 90 + '"', '"a,\n"",b"', "é"]
    lines = ["h1,h2,h3,h4"] + [",".join([str(k), *chance.choices(cells, k=3)]) for k in range(160)]
    for name, end in (("unix", "\n"), ("dos", "\r\n")):
        for k in range(2):
            (tmp_path / name).mkdir(exist_ok=True)
            part = [lines[0], *lines[1 + 80 * k: 81 + 80 * k]]
            (tmp_path / name / f"part-{k}.csv").write_bytes((end.join(part) + end * (2 - k)).encode())
    options = {"escape": '"', "nullValue": "NA", "emptyValue": ""}
    whole = spark.read.options(**options).option("header", True).option("multiLine", True)
    want = sorted(map(tuple, whole.csv(str(tmp_path / "unix")).collect()), key=str)
    assert len(want) == 160
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("193", before):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            for name in ("unix", "dos"):
                read = records.read_split(spark, str(tmp_path / name), options)
                assert read.columns == ["h1", "h2", "h3", "h4"]
                found = sorted((tuple(c and c.replace("\r\n", "\n") for c in r) for r in read.collect()), key=str)
                assert found == want, (size, name)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_open_quotes_end_with_their_file_and_whole_lines_are_not_shuffled(spark, tmp_path):
    (tmp_path / "a.csv").write_text('h1,h2\n1,"open\n2,x\n')
    (tmp_path / "b.csv").write_text('h1,h2\n\n3,y\n4,"two\nlines"\n')
    (tmp_path / "c.csv").write_text("h1,h2")
    read = records.read_records(spark, str(tmp_path))
    assert sorted(r.value for r in read.collect()) == ['1,"open\n2,x', "3,y", '4,"two\nlines"']
    final = read._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("Exchange hashpartitioning(file") == 1 and "hashpartitioning(file" in final.split("collect_list", 1)[1]


def test_parts_of_a_property_file_share_a_header(spark, tmp_path):
    for k in range(2):
        write(tmp_path / f"same/part-{k}.csv", [HEADER, property_line(property_ID=f"ab-{k}", country="Peru", region="Lima")])
    for multi_line in (True, False):
        rows = delivered.read_property(spark, str(tmp_path / "same"), multi_line=multi_line).collect()
        assert sorted((r.property_ID, r.country, r.region, r.parse_error) for r in rows) == [("ab-0", "Peru", "Lima", False), ("ab-1", "Peru", "Lima", False)]
    write(tmp_path / "other/part-0.csv", [HEADER, property_line(property_ID="ab-0")])
    swapped = ",".join(reversed(HEADER.split(",")))
    write(tmp_path / "other/part-1.csv", [swapped, property_line(property_ID="ab-1")])
    with pytest.raises(Exception, match="(?i)header"):
        delivered.read_property(spark, str(tmp_path / "other")).collect()


def test_daily_file_is_read_by_position(spark, tmp_path):
    body = ["ab-1,2020-01-01,A,,120.5,99,CAD,77,1,", "ha-2,2020-01-02,R,2019-12-30,,,,,,h2", "ab-3,yesterday,U,,x,,,,,"]
    header = ",".join(raw for raw, _, _ in fixed.DAILY_COLUMNS)
    with_header = delivered.read_daily(spark, write(tmp_path / "a.csv", [header, *body]))
    without = delivered.read_daily(spark, write(tmp_path / "b.csv", body), header=False)
    assert [tuple(r) for r in with_header.collect()] == [tuple(r) for r in without.collect()] == [
        ("ab-1", date(2020, 1, 1), "A", None, 120.5, 77.0, False, None),
        ("ha-2", date(2020, 1, 2), "R", date(2019, 12, 30), None, None, False, None),
        ("ab-3", None, "U", None, None, None, True, "date=yesterday; price=x"),
    ]
    minimum = delivered.read_daily_minimum(spark, str(tmp_path / "a.csv"))
    assert minimum.columns == ["property_ID", "date", "status"]


def test_the_latest_delivery_of_the_month_is_found(spark, tmp_path):
    for name in ("2020-03-02.csv", "2020-03-14.csv", "2020-04-01.csv"):
        write(tmp_path / f"All_Property_Match_{name}", ["x"])
    write(tmp_path / "All_1Month_Daily_Match_2020-03-20.csv", ["x"])
    found = delivered.find_delivery(spark, str(tmp_path), delivered.PROPERTY_PREFIX, "2020_03")
    assert found.endswith("All_Property_Match_2020-03-14.csv")
    assert delivered.find_delivery(spark, str(tmp_path), delivered.PROPERTY_PREFIX, "2020_05") is None
    assert delivered.find_delivery(spark, str(tmp_path), delivered.DAILY_PREFIX, "2020_03").endswith("2020-03-20.csv")


def test_appending_a_month_again_replaces_it(spark, tmp_path):
    path = str(tmp_path / "daily")
    df = spark.range(100).selectExpr("concat('ab-', id) as property_ID", "if(id % 3 = 0, 'C', concat('D', id)) as country")
    tables.append_month(df, path, "2020_01", ["property_ID"])
    tables.append_month(df.limit(10), path, "2020_02", ["property_ID"])
    tables.append_month(df, path, "2020_01", ["property_ID"])
    stored = tables.read_table(spark, path)
    assert {(r.year_month, r["count"]) for r in stored.groupBy("year_month").count().collect()} == {("2020_01", 100), ("2020_02", 10)}
    tables.assert_readback(stored, df, "2020_01")
    with pytest.raises(ValueError):
        tables.assert_readback(stored, df, "2020_02")


def test_filters_and_columns_reach_the_stored_files(spark, tmp_path):
    path = str(tmp_path / "property")
    df = spark.range(100).selectExpr("concat('ab-', id) as property_ID", "concat('C', id % 5) as country", "id as extra")
    tables.replace_table(df, path, ["property_ID"])
    plan = tables.read_table(spark, path).filter("country = 'C1'").select("property_ID")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(country,C1)" in text and "extra" not in text


def test_quarantined_rows_come_back_typed(spark, tmp_path):
    rows = [("ab-1", date(2020, 1, 1), "A", None, 100.0, None), (None, None, "U", date(2020, 1, 2), None, 5.0), ('ab-"q', None, None, None, None, None)]
    schema = "property_ID string, date date, status string, booked_date date, price double, res_ID double"
    path = tables.write_quarantine(spark.createDataFrame(rows, schema), str(tmp_path / "error_2020"))
    assert {tuple(r)[:6] for r in delivered.read_backlog(spark, path).collect()} == set(rows)


def test_a_quarantined_fault_stays_a_fault(spark, tmp_path):
    read = delivered.read_daily(spark, write(tmp_path / "a.csv", ["ab-1,2020-01-01,A,,free,,,,,"]), header=False)
    for k in range(2):
        read = delivered.read_backlog(spark, tables.write_quarantine(read, str(tmp_path / f"error_{k}")))
        (row,) = read.collect()
        assert row.parse_error and row.faulty_texts == "price=free" and row.price is None


def test_steps_are_removed_at_the_end_of_a_run(spark, monkeypatch):
    monkeypatch.setattr(session, "STEPS", [])
    step = session.materialize(spark.range(3))
    (path,) = session.STEPS
    assert step.count() == 3 and spark.read.parquet(path).count() == 3
    assert session.remove_steps(spark) == 1 and session.STEPS == []
    with pytest.raises(AnalysisException):
        spark.read.parquet(path)


def test_nested_columns_reach_the_quarantine(spark, tmp_path):
    df = spark.range(1).selectExpr("id", "array(1, 2) as list", "struct(id as a) as pair")
    path = tables.write_quarantine(df, str(tmp_path / "nested"))
    assert tuple(spark.read.option("header", True).option("escape", '"').csv(path).first()) == ("0", "[1,2]", '{"a":0}')


def test_late_rows_are_merged_into_their_months(spark, tmp_path):
    path, keys = str(tmp_path / "daily"), ["property_ID", "start_date"]
    schema = "property_ID string, start_date date, price double"
    make = lambda rows: spark.createDataFrame([(i, date(2020, m, d), p) for i, m, d, p in rows], schema)
    tables.merge_months(make([("a", 1, 1, 1.0), ("b", 1, 2, 2.0), ("c", 2, 1, 3.0), ("d", 3, 1, 4.0)]), path, "start_date", keys)
    late = make([("a", 1, 1, 9.0), ("e", 1, 5, 5.0), ("f", 2, 9, 6.0)])
    for _ in range(2):
        tables.merge_months(late, path, "start_date", keys)
        stored = {(r.property_ID, r.price, r.year_month) for r in tables.read_table(spark, path).collect()}
        assert stored == {("a", 9.0, "2020_01"), ("b", 2.0, "2020_01"), ("e", 5.0, "2020_01"), ("c", 3.0, "2020_02"), ("f", 6.0, "2020_02"),
                          ("d", 4.0, "2020_03")}


def test_read_back_sees_other_rows_as_well_as_fewer(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.sql("select * from values ('a', 1, array(1.5D)), ('a', 1, array(1.5D)), ('b', null, null) as t(k, v, w)")
    tables.append_month(df, path, "2020_01", ["k"])
    stored = tables.read_table(spark, path)
    assert tables.readback(stored, df, "2020_01").first().complete
    others = [df.withColumn("v", F.col("v") + 1), df.withColumn("v", F.coalesce("v", F.lit(0))), df.selectExpr("k", "v", "reverse(w) w").withColumn("k", F.lit("a")),
              df.distinct().unionByName(df.filter("k = 'b'")), df.withColumn("more", F.lit(1)), df.limit(2)]
    for other in others:
        assert not tables.readback(stored, other, "2020_01").first().complete
        with pytest.raises(ValueError):
            tables.assert_readback(stored, other, "2020_01")


def test_an_empty_rerun_empties_its_month_only(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(5).withColumn("k", F.col("id"))
    for label in ("2020_01", "2020_02"):
        tables.append_month(df, path, label, ["k"])
    tables.append_month(df.limit(0), path, "2020_01", ["k"])
    stored = tables.read_table(spark, path)
    assert {r.year_month for r in stored.select("year_month").collect()} == {"2020_02"} and stored.count() == 5
    tables.assert_readback(stored, df.limit(0), "2020_01")


def test_a_record_is_parsed_once_and_shuffled_only_over_the_end_of_a_range(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "STEPS", [])
    lines = [HEADER, *(property_line(property_ID=f"ab-{k}", listing_title=f'"a\n{k}\n"', bedrooms="2" if k % 2 else "many") for k in range(50))]
    bad = delivered.parse_errors(delivered.read_property(spark, write(tmp_path / "property.csv", lines)))
    stored = spark.read.parquet(session.STEPS[-1])
    assert stored.count() == 50 and stored.filter("of_range is not null").count() == 0
    assert bad._jdf.queryExecution().optimizedPlan().toString().count("from_csv(") <= 2  # records of one range, and of several
    assert sorted(bad.select("listing_title").collect()) == sorted((f"a\n{k}\n",) for k in range(0, 50, 2))
