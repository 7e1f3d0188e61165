from __future__ import annotations

import numpy as np
from hypothesis import given, settings as profile, strategies as st

from roomledger.llm import repetition
from tests.llm.cases import empty, messy, repetition as brute, words


def test_figures_of_chosen_texts():
    run = " ".join(f"r{k}" for k in range(60))
    texts = ["", "a b c d e a b c d e", "x x x x x x x", "a b\n\n a b\na b\n#*$%&|<>é", run + " z " + run, "é漢 \U0001f600\tb"]
    rows = repetition.figures([t.encode() for t in texts])
    for text, row in zip(texts, rows.tolist()):
        covered, longest = brute(text)
        found = [w.decode() for w in words(text)]
        lines = [x for x in text.split("\n") if words(x)]
        assert row == [len(found), sum(map(len, found)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), covered, longest]
    assert rows[4, 5] == 60


@profile(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60))
def test_repeats_equal_brute_force(drawn):
    ranks = np.array(drawn, np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    assert repetition.repeats(ranks) == brute(" ".join(map(str, drawn)))


def test_suffixes_are_in_order():
    sequence = np.array([3, 1, 2, 1, 2, 1, 3, 1])
    order, levels = repetition.suffix_ranks(sequence)
    suffixes = [tuple(sequence[k:]) for k in order]
    assert suffixes == sorted(suffixes)


def test_verdicts_of_messy_rows(spark):
    rows = repetition.repetition_rules(messy(spark)).collect()
    assert len(rows) == messy(spark).count()
    for r in rows:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert r.kept == (not r.base_failed and r.longest_repeat <= repetition.MAX_LONGEST)
    by_id = {r.doc_id: r for r in rows}
    assert by_id[2].kept and not by_id[3].kept and not by_id[10].kept and by_id[7].n_words == 60000
    assert repetition.repetition_rules(empty(spark)).count() == 0
