from __future__ import annotations

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from roomledger.llm import mixing
from tests.llm.cases import TEXTS, empty, messy, words

SF = "/root/testdata/sf0.01"


def targets(sizes: dict, weights=(5, 2, 1), share=1.5) -> dict:
    """Share out by weight, cut at twice the size, share the excess out again, until nothing is cut."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    found, left, open_ = dict.fromkeys(order, 0.0), share * sum(sizes.values()), set(order)
    while left > 1e-9 and open_:
        total = sum(weight[s] for s in open_)
        for s in list(open_):
            found[s] += left * weight[s] / total
        left = 0.0
        for s in list(open_):
            if found[s] >= 2 * sizes[s]:
                left += found[s] - 2 * sizes[s]
                found[s] = 2.0 * sizes[s]
                open_.discard(s)
    return found


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 100, "c": 100}, {"a": 10, "b": 1000, "c": 5, None: 7, "d": 3}, {"a": 0, "b": 50}, {None: 9}, {"a": 0},
    {"x": 1, "y": 10**6, "z": 3, "é": 12}])
def test_targets_are_shared_out_by_weight(spark, sizes):
    sized = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    found = {r.source: r.target for r in mixing.source_targets(sized).collect()}
    assert found == pytest.approx(targets(sizes))


def test_mix_of_messy_rows(spark):
    rows = mixing.taken_words(messy(spark)).collect()
    assert Counter((r.doc_id, r.source, r["size"]) for r in rows) == Counter((i, s, len(words(t))) for i, t, _, s in TEXTS)
    by = defaultdict(list)
    for r in rows:
        assert 0 <= r.taken <= 2 * r["size"]
        by[r.source].append(r)
    for own in by.values():
        assert own[0].source_size == sum(r["size"] for r in own)
        assert sum(r.taken for r in own) == int(own[0].target)
    assert mixing.taken_words(empty(spark)).count() == 0
    again = mixing.taken_words(messy(spark).repartition(5)).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, rows))


def test_schedule_gives_each_source_its_slots_evenly(spark):
    sources = spark.createDataFrame([("a", 90_000, 0, 100_000.0), ("b", 40_000, 1, 50_000.5), ("c", 10, 2, 5.0), ("d", 0, 3, 0.0)],
                                    "source string, source_size long, source_no int, target double")
    slots = sorted(tuple(r) for r in mixing.schedule(sources).collect())
    got = defaultdict(list)
    for position, source, block in slots:
        got[source].append(block)
    assert {s: sorted(b) for s, b in got.items()} == {0: list(range(391)), 1: list(range(196)), 2: [0]}
    for source, share in ((0, 391 / 588), (1, 196 / 588)):
        for n in (50, 100, 300, 500):
            here = sum(s == source for _, s, _ in slots[:n])
            assert abs(here - n * share) < 4
    assert [b for _, s, b in slots if s == 0] == list(range(391))


def test_whole_documents_come_near_the_targets(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == docs.columns
    size = mixing.word_count(F.col("text"))
    want = {r.source: (r.target, r.longest) for r in mixing.taken_words(docs).groupBy("source").agg(
        F.first("target").alias("target"), F.max("size").alias("longest")).collect()}
    for r in mixed.groupBy("source").agg(F.sum(size).alias("n")).collect():
        assert abs(r.n - want[r.source][0]) <= want[r.source][1]
    assert mixed.groupBy("doc_id").count().filter("count > 2").count() == 0


def test_whole_documents_of_messy_rows(spark):
    mixed = mixing.mix_documents(messy(spark))
    assert mixed.columns == messy(spark).columns
    times = Counter((r.doc_id, r.text) for r in mixed.collect())
    most = Counter((i, t) for i, t, _, _ in TEXTS)
    assert all(n <= 2 * most[k] and words(k[1]) for k, n in times.items())
    assert mixing.mix_documents(empty(spark)).count() == 0


def test_words_are_counted_alike(spark):
    found = messy(spark).select("text", mixing.word_count(F.col("text")).alias("n")).collect()
    assert all(r.n == len(words(r.text)) for r in found)


def test_every_prefix_of_the_mix_is_near_the_weights(spark):
    """The order of the query's rows is the schedule's: words of the documents begun so far, by source."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    rows = [r for r in mixing.taken_words(docs).collect() if r.first_position is not None]
    rows.sort(key=lambda r: r.first_position)
    target = {r.source: r.target for r in rows}
    total = sum(target.values())
    slots = [r for r in mixing.schedule(mixing.source_targets(mixing.sized_documents(docs))).select("position").collect()]
    assert min(r.first_position for r in rows) == 0 and max(r.first_position for r in rows) <= max(r.position for r in slots)
    for share in (0.05, 0.1, 0.25, 0.5):
        upto = share * len(slots)
        begun = defaultdict(int)
        for r in rows:
            if r.first_position < upto:
                begun[r.source] += min(r.taken, r["size"])
        words_begun = sum(begun.values())
        for source, want in target.items():
            if want / total > 0.03:
                assert begun[source] / words_begun == pytest.approx(want / total, rel=0.35)


def test_the_points_decide_the_order(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = {(r.doc_id, r.first_position, r.taken) for r in mixing.taken_words(docs).collect()}
    monkeypatch.setattr(mixing, "GOLDEN", 0.0001234)
    after = {(r.doc_id, r.first_position, r.taken) for r in mixing.taken_words(docs).collect()}
    assert {(i, taken) for i, _, taken in before} == {(i, taken) for i, _, taken in after}
    assert len(before & after) < 0.6 * len(before)


def test_no_plan_of_the_mix_holds_all_its_steps(spark):
    docs = messy(spark)
    for found in (mixing.mix_documents(docs), mixing.taken_words(docs)):
        shuffles = found._jdf.queryExecution().sparkPlan().toString().count("Window") + found._jdf.queryExecution().executedPlan().toString().count("Exchange ")
        assert shuffles <= 10, shuffles
