from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings as profile, strategies as st

from roomledger.llm import jaccard
from roomledger.session import materialize
from tests.llm.cases import components, empty, messy, shingles


def near_copies(seed, n=140):
    """Texts of groups whose members differ by a few words, many at the edge of linking, and a passage all share."""
    pick = random.Random(seed)
    passage = [f"p{k}" for k in range(60)]
    texts = []
    for k in range(n):
        if texts and pick.random() < 0.7:
            base = list(pick.choice(texts)[1])
            for _ in range(pick.randint(0, max(1, len(base) // 25))):
                at = pick.randrange(len(base))
                base[at:at + pick.choice([0, 1])] = [f"e{pick.randrange(10**6)}"] * pick.choice([0, 1, 1])
                base = base or ["z"]
        else:
            base = [f"w{pick.randrange(400)}" for _ in range(pick.choice([1, 3, 5, 8, 40, 150, 400]))]
            base = base + passage if pick.random() < 0.5 else base
        texts.append((pick.randrange(10**4), base))
    return [(i, " ".join(t).upper() if pick.random() < 0.1 else " ".join(t)) for i, t in texts]


def found(spark, texts):
    df = materialize(spark.createDataFrame(texts, "doc_id long, text string"))
    return Counter(tuple(r) for r in jaccard.jaccard_components(df).collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_those_of_all_pairs(spark, seed):
    texts = near_copies(seed)
    want = components(texts)
    assert sum(n for (i, _, c), n in want.items() if i != c) > 20
    assert found(spark, texts) == want


def test_the_join_has_every_link(spark):
    texts = [(k, t) for k, (_, t) in enumerate(near_copies(7, 90))]
    edges, members = jaccard.jaccard_join(spark.createDataFrame(texts, "doc_id long, text string"))
    of, node = {}, {}
    for r in members.collect():
        of.setdefault(r.node, []).append(r.doc_id)
        node[r.doc_id] = r.node
    sets = [shingles(t) for _, t in texts]
    assert all(node[i] == node[j] if sets[i] == sets[j] else node[i] != node[j] for i in range(90) for j in range(i))
    found = {(r.a, r.b) for r in edges.collect()}
    assert edges.count() == len(found)
    want = {tuple(sorted((node[i], node[j]))) for i in range(90) for j in range(i)
            if sets[i] != sets[j] and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])}
    assert len(want) > 20 and found == want


def test_blocks_of_very_common_shingles_and_large_leaders_lose_nothing(spark, monkeypatch):
    texts = near_copies(5, 100)
    for name, value in (("GROUP", 4), ("MEMBERS", 3), ("OFTEN", 1), ("PAIRED", 2), ("CHUNK", 2000), ("PART_BYTES", 2000)):
        monkeypatch.setattr(jaccard, name, value)
    assert found(spark, texts) == components(texts)


def test_messy_rows(spark):
    rows = [(r.doc_id, r.text) for r in messy(spark).select("doc_id", "text").collect()]
    assert Counter(tuple(r) for r in jaccard.jaccard_components(messy(spark)).collect()) == components(rows)
    assert jaccard.jaccard_components(empty(spark)).count() == 0


def test_one_of_each_group_stays(spark):
    kept = jaccard.keep_one(messy(spark))
    assert kept.columns == messy(spark).columns
    rows = Counter((r.doc_id, r.text) for r in kept.collect())
    assert all(n == 1 for n in rows.values())
    sets = [shingles(t) for _, t in rows if shingles(t)]
    assert len(sets) == len(set(sets)) == 7  # copies and the text with one word more are gone
    assert sum(not shingles(t) for _, t in rows) == 4
    assert jaccard.keep_one(empty(spark)).count() == 0


@profile(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.sets(st.integers(0, 40), min_size=1)), min_size=2, max_size=40), st.data())
def test_trees_lose_no_link(drawn, data):
    base = [set(range(k * 50, k * 50 + data.draw(st.integers(4, 40)))) for k in range(4)]
    rng = np.random.default_rng(9)
    hashes = rng.integers(0, 1 << 48, 300, dtype=np.uint64)
    sets = [np.unique(hashes[sorted(base[k] ^ {200 + x for x in more if x % 7 == 0})]) for k, more in drawn]
    part = jaccard.linked(sets)
    marked = set(jaccard.with_partner([jaccard.signature(s) for s in sets], np.array([len(s) for s in sets])).tolist())
    for i in range(len(sets)):
        for j in range(i):
            if jaccard.links(sets[i], sets[j]):
                assert part[i] == part[j] and {i, j} <= marked


def test_first_shared_shingle_names_every_partner():
    rng = np.random.default_rng(4)
    for _ in range(300):
        n = int(rng.integers(1, 60))
        a = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        cut = int(rng.integers(0, n // 3 + 1))
        b = np.unique(np.concatenate((a[cut:], rng.integers(0, 1 << 63, int(rng.integers(0, n // 3 + 1)), dtype=np.uint64))))
        a = np.unique(a)
        if not len(b) or not jaccard.links(a, b):
            continue
        often = np.sort(rng.choice(a, len(a) // 3, replace=False))
        (pa, la), (pb, lb) = jaccard.prefix(a, often), jaccard.prefix(b, often)
        names = np.concatenate((pa, pb))
        rest = [np.repeat(x, [len(pa), len(pb)]) for x in ([1, 2], [len(a), len(b)])]
        assert len(jaccard.leaders(names, *rest, np.concatenate((la, lb)))[0]) == 1
