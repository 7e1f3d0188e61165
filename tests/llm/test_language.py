from __future__ import annotations

import tracemalloc
import zlib

import numpy as np
import pytest

from roomledger.llm import language
from tests.llm.cases import empty, messy

SF = "/root/testdata/sf0.01"


def grams(text):
    spaced = "".join(c.lower() if c.isalpha() else " " for c in text)
    spaced = " " + " ".join(spaced.split()) + " " if spaced.split() else " "
    return {spaced[i:i + n] for n in language.ORDERS for i in range(len(spaced) - n + 1)}


def sets_of(text):
    found = [rows for rows, _ in language.pieces(text)]
    sizes = [n for _, part in language.pieces(text) for n in part.tolist()]
    return np.concatenate(found), sizes


@pytest.mark.parametrize("piece, chars", [(8, 5), (8, 1000), (13, 7), (1024, 3), (1024, 1 << 20)])
def test_pieces_have_the_grams_of_the_text_and_no_others(monkeypatch, piece, chars):
    texts = ["Größe und Maß, 12 Äpfel!", "a", "", "x" * 50 + " y" * 50, "!?", "\U0001f600ab", "   ", " a  b ", "ab" * 8]
    whole = {t: sets_of(t)[0].max(axis=0) for t in texts}
    monkeypatch.setattr(language, "PIECE", piece)
    monkeypatch.setattr(language, "CHARS", chars)
    for text in texts:
        rows, sizes = sets_of(text)
        assert (rows.max(axis=0) == whole[text]).all()
        assert sum(sizes) == sum(c.isalpha() for c in text) and max(sizes) <= piece
        assert whole[text].sum() <= len(grams(text)) and (rows.sum() > 0)
        spaced = " " + " ".join("".join(c.lower() if c.isalpha() else " " for c in text).split()) + " "
        assert len(rows) == -(-(len(spaced) if spaced.strip() else 1) // piece)


def invented(seed, n_words=40_000):
    """A language of random words: its syllables are its own, its vocabulary is rich."""
    rng = np.random.default_rng(seed)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))
    syllables = ["".join(rng.choice(letters, rng.integers(1, 4))) for _ in range(120)]
    return ["".join(rng.choice(syllables, rng.integers(2, 5))) for _ in range(n_words)]


def test_long_texts_of_rich_vocabularies_are_told_apart():
    rng = np.random.default_rng(1)
    words = {f"l{k}": np.array(invented(k)) for k in range(4)}

    def text(name, n):
        return " ".join(rng.choice(words[name], n))

    sets, labels = [], []
    for name in words:
        for _ in range(60):
            rows, _ = sets_of(text(name, int(rng.integers(5, 400))))
            sets.append(rows[0])
            labels.append(name)
    model = language.fit(np.array(sets), labels)
    for n, times in ((10, 100), (100, 50), (1000, 25), (10_000, 6), (100_000, 2)):
        drawn = [(name, text(name, n)) for name in words for _ in range(times)]
        scores, letters = language.scored([t for _, t in drawn], model)
        assert letters.min() > 0
        right = [model.languages[k] == name for k, (name, _) in zip(scores.argmax(axis=1), drawn)]
        assert np.mean(right) >= 0.95, n


def test_rare_languages_are_learned_from(spark):
    assert language._quotas({"a": 10, "b": 1000, "c": 500}, 300) == {"a": 10, "c": 145, "b": 145}
    assert language._quotas({"a": 2, "b": 3}, 300) == {"a": 2, "b": 3}
    many = [(k, "the words of a common tongue " + str(k), "common") for k in range(3000)]
    rare = [(5000 + k, "xyzzy plugh qwzrx " * 3 + str(k), "rare") for k in range(9)]
    docs = spark.createDataFrame(many + rare, "doc_id long, text string, lang string")
    found = {r.doc_id: r.lang_pred for r in language.identify(docs, sample=60).collect()}
    assert {found[k] for k, _, _ in rare} == {"rare"} and {found[k] for k, _, _ in many} == {"common"}


def test_scores_are_kernel_ridge_regression():
    rng = np.random.default_rng(3)
    places = (rng.random((40, language.FEATURES)) < 0.01).astype(np.uint8)
    labels = ["ab"[k % 2] for k in range(40)]
    model = language.fit(places, labels, n_landmarks=40)
    k = language._kernel(places, places).astype(float)
    y = np.array([[x == "a", x == "b"] for x in labels], float)
    exact = k @ np.linalg.solve(k.T @ k + language.RIDGE * 40 * (k + 1e-6 * np.eye(40)), k.T @ y)
    assert np.allclose(model.scores(places), exact, atol=1e-3)


def test_held_out_documents_are_told_apart(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = language.identify(docs).toPandas()
    assert found.columns.tolist() == ["doc_id", "held_out", "lang_pred", "score"]
    assert (found.held_out == [zlib.crc32(str(i).encode()) % 3 == 1 for i in found.doc_id]).all()
    both = found.merge(docs.select("doc_id", "lang").toPandas(), on="doc_id")
    held = both[both.held_out]
    assert len(held) > 200 and (held.lang_pred == held.lang).mean() > 0.99
    assert found.score.between(0, 1).all()


def test_messy_rows(spark):
    found = language.identify(messy(spark)).collect()
    assert len(found) == messy(spark).count()
    unknown = [r for r in found if r.lang_pred == "und"]
    assert sorted(r.doc_id or 0 for r in unknown) == [0, 3, 4, 5, 6] and all(r.score == 0 for r in unknown)
    assert {r.lang_pred for r in found} <= {"en", "de", "fr", "und"}
    assert language.identify(empty(spark)).count() == 0
    unlabelled = messy(spark).selectExpr("doc_id", "text", "cast(null as string) lang")
    assert {(r.lang_pred, r.score) for r in language.identify(unlabelled).collect()} == {("und", 0.0)}


def test_rejected_documents_go_and_rows_stay_as_they_were(spark):
    kept = language.keep_identified(messy(spark), least=0.0)
    assert kept.columns == messy(spark).columns
    assert kept.filter("lang_pred <> 'x' or score <> 'x'").count() == 0
    assert kept.count() == messy(spark).count() - 5


def test_the_driver_learns_without_all_sets_as_floats():
    rng = np.random.default_rng(2)
    places = (rng.random((2000, language.FEATURES), np.float32) < 0.1).astype(np.uint8)
    marks = places[:50].astype(np.float32)
    whole = (places.astype(np.float32) @ marks.T) / np.sqrt(np.maximum(np.outer(places.sum(axis=1, dtype=np.float32), marks.sum(axis=1)), 1))
    assert np.array_equal(language._kernel(places, places[:50]), whole)
    del whole
    tracemalloc.start()
    try:
        language.fit(places, [f"l{i % 3}" for i in range(len(places))])
        assert tracemalloc.get_traced_memory()[1] < 2 * places.nbytes
    finally:
        tracemalloc.stop()
