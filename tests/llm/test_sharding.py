from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pytest

from roomledger.llm import sharding
from tests.llm.cases import TEXTS, empty, messy


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_shards_are_near_equal_and_places_gapless(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    found = sharding.shard_documents(docs).toPandas()
    assert len(found) == docs.count()
    size = found.groupby("shard")["size"].sum()
    assert len(size) == 24 and size.max() - size.min() <= 0.01 * size.mean()
    for _, own in found.groupby("shard"):
        assert sorted(own["slot"]) == list(range(len(own)))
    text = found.text.str.encode("utf-8")
    assert (found["size"] == text.str.len() + 8).all() and (found.text_crc32 == text.map(zlib.crc32)).all()
    again = sharding.shard_documents(docs.repartition(7)).toPandas()
    key = ["doc_id", "shard", "slot", "virtual_slot"]
    assert sorted(map(tuple, again[key].values)) == sorted(map(tuple, found[key].values))


def test_a_map_is_edited_little_and_can_grow(spark):
    weight = np.random.default_rng(5).integers(0, 10_000, sharding.SLOTS)
    first = sharding.rebalanced(sharding.first_map(24), weight, 24)
    load = np.bincount(first, weights=weight)
    assert load.max() - load.min() <= 10
    changed = weight.copy()
    changed[:200] += 5000
    second = sharding.rebalanced(first, changed, 24)
    assert 0 < (second != first).sum() < 300
    grown = sharding.rebalanced(second, changed, 25)
    moved = grown != second
    assert (grown[moved] == 24).mean() > 0.8 and moved.sum() < 0.06 * sharding.SLOTS
    stored = sharding.map_table(spark, first, weight, weight, 2).union(sharding.map_table(spark, second, weight, weight, 3))
    assert np.array_equal(sharding.load_map(stored)[0], second) and sharding.load_map(stored)[1] == 3
    assert np.array_equal(sharding.load_map(stored, 2)[0], first)


def test_versions_of_the_map_are_kept_and_edited(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    maps = f"{tmp_path}/maps"
    place = lambda df: {r.doc_id: (r.shard, r.slot, r.map_version) for r in df.collect()}
    assert sharding.stored_maps(spark, maps) is None
    first = place(sharding.shard_documents(docs, 8, maps=maps))
    assert {v for _, _, v in first.values()} == {2} and first == place(sharding.shard_documents(docs, 8))
    # nothing to edit, no new version
    assert place(sharding.shard_documents(docs, 8, maps=maps)) == first
    more = docs.unionByName(docs.selectExpr("doc_id + 1000000 as doc_id", *[c for c in docs.columns if c != "doc_id"]).limit(40))
    second = sharding.shard_documents(more, 8, maps=maps)
    load = [r.n for r in second.groupBy("shard").sum("size").toDF("shard", "n").collect()]
    moved = sum(place(second)[k][0] != first[k][0] for k in first)
    assert max(load) - min(load) < 0.02 * sum(load) / 8 and 0 < moved < len(first) / 4
    assert {v for _, _, v in place(second).values()} == {3}
    assert sorted(r.version for r in sharding.stored_maps(spark, maps).select("version").distinct().collect()) == [2, 3]
    # a version whose writing broke off does not count, and fewer shards take the slots of the others
    spark.range(5).selectExpr("int(id) virtual_slot", "0 shard", "0L bytes", "0L rows").write.parquet(f"{maps}/version=4")
    fewer = place(sharding.shard_documents(more, 7, maps=maps))
    assert {s for s, _, _ in fewer.values()} == set(range(7)) and {v for _, _, v in fewer.values()} == {4}
    assert sharding.load_map(sharding.stored_maps(spark, maps))[1] == 4
    for shard in range(7):
        places = sorted(n for s, n, _ in fewer.values() if s == shard)
        assert places == list(range(len(places)))


def test_messy_rows(spark):
    found = sharding.shard_documents(messy(spark))
    assert set(messy(spark).columns) - set(sharding.OWN) <= set(found.columns) and set(sharding.OWN) <= set(found.columns)
    rows = found.collect()
    want = [(i or 0, len((t or "").encode()) + 8, -1 if t is None else zlib.crc32(t.encode())) for i, t, _, _ in TEXTS]
    assert sorted((r.doc_id or 0, r["size"], -1 if r.text_crc32 is None else r.text_crc32) for r in rows) == sorted(want)
    places = defaultdict(list)
    for r in rows:
        assert r.law == "bytes" and r.grown_shard is None
        places[r.shard].append(r.slot)
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    assert sharding.shard_documents(empty(spark)).count() == 0
