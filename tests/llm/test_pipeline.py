"""The pipeline stage by stage against brute-force versions, and the queries against their SQL."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import pytest

import __spark_entry__ as entry_points
import corpus_pipeline
from roomledger.llm.queries import ORACLES, QUERIES
from roomledger.session import materialize
from tests.compare import connect, difference
from tests.llm.cases import components, empty, messy, words
from tests.llm.test_mixing import targets

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """What every stage of a run gives, by name."""
    docs, found = spark.read.parquet(f"{SF}/documents.parquet"), {}
    extra = spark.createDataFrame([(10**6, "12 - 34", "en", "src0", 7), (10**6 + 1, None, None, None, None)], docs.schema)
    found[""] = docs = materialize(docs.unionByName(extra))
    for name, stage in corpus_pipeline.STAGES:
        found[name] = docs = materialize(stage(spark, docs, SF))
    return found


def rows(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_stages_are_the_five_and_keep_the_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "decontamination", "mixing", "sharding"]
    for name, df in list(stages.items())[:-1]:
        assert df.columns == stages[""].columns, name


def test_only_documents_without_letters_are_rejected(stages):
    kept = {(i, t) for i, t in rows(stages[""]) if t and any(c.isalpha() for c in t)}
    assert set(rows(stages["language"])) == kept and stages["language"].count() == len(kept)


def test_one_document_of_each_group_stays(stages):
    given = rows(stages["language"])
    firsts = {component for (_, _, component) in components(given)}
    assert Counter(i for i, _ in rows(stages["near_duplicates"])) == Counter(firsts)


def test_documents_with_benchmark_items_go(spark, stages):
    bare = lambda t: " ".join(re.findall(r"\w+", t.lower()))
    items = [bare(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = [(i, t) for i, t in rows(stages["near_duplicates"]) if not any(item in bare(t) for item in items)]
    assert len(clean) < stages["near_duplicates"].count()
    assert sorted(rows(stages["decontamination"])) == sorted(clean)


def test_sources_come_near_their_targets(stages):
    size, longest = Counter(), Counter()
    for r in stages["decontamination"].collect():
        size[r.source] += len(words(r.text))
        longest[r.source] = max(longest[r.source], len(words(r.text)))
    mixed = Counter()
    times = Counter()
    for r in stages["mixing"].collect():
        mixed[r.source] += len(words(r.text))
        times[r.doc_id] += 1
    want = targets(size)
    assert all(abs(mixed[s] - want[s]) <= longest[s] + 1 for s in size) and max(times.values()) <= 2


def test_shards_hold_all_rows_once(stages):
    last = stages["sharding"].collect()
    assert Counter((r.doc_id, r.text) for r in last) == Counter(rows(stages["mixing"]))
    load, places = Counter(), defaultdict(list)
    for r in last:
        load[r.shard] += r["size"]
        places[r.shard].append(r.slot)
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    assert max(load.values()) - min(load.values()) <= max(r["size"] for r in last)


def test_a_run_gives_the_same_again(spark, stages):
    run = entry_points.queries()["pipeline"](spark, SF)
    assert run.columns == stages["sharding"].columns
    assert {(r.doc_id, r.shard) for r in run.collect()} == {(r.doc_id, r.shard) for r in stages["sharding"].collect()}


def test_stages_take_messy_and_empty_tables(spark):
    for name, stage in corpus_pipeline.STAGES:
        for docs in (messy(spark), empty(spark)):
            found = stage(spark, docs, SF)
            if name != "sharding":
                assert found.columns == docs.columns
            assert (found.count() > 0) == (docs.count() > 0), name


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_run_over_whole_tables(spark, name):
    assert difference(spark, connect(SF), SF, name) is None
    found = entry_points.queries()[name](spark, SF)
    if name != "op4_template_leaks":
        table = {"op6_page_text": "pages", "op11_whitening": "embeddings"}.get(name, "documents")
        each = 32 if name == "op11_whitening" else 1  # a row per component
        assert found.count() == each * spark.read.parquet(f"{SF}/{table}.parquet").count()


def test_what_sql_can_say_is_said():
    assert set(ORACLES) == {"op4_template_leaks", "op7_repetition_rules", "op10_source_mix", "op13_merkle_manifest"}
    assert "pipeline" in entry_points.queries() and "pipeline" not in entry_points.oracle_sql()
