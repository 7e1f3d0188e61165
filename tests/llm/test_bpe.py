from __future__ import annotations

import base64
import hashlib
import random
from functools import lru_cache

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings as profile, strategies as st

from roomledger.llm import bpe
from tests.llm.cases import TEXTS, empty, messy

ALPHABET = "ab '  \n\tsé漢1 .!t\x1c  r\U0001f600"


@lru_cache
def library() -> tiktoken.Encoding:
    with open(public_tokenizers.path(bpe.VOCABULARY), "rb") as lines:
        ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("whole", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def want(text: str) -> bytes:
    return np.array(library().encode_ordinary(text), "<u4").tobytes()


@pytest.fixture(params=[(1, 1), (4, 2), (9, 3), (bpe.LEAF_CHARS, bpe.LEAF_BYTES)])
def leaves(request, monkeypatch):
    """Trees of many small leaves, and of the real ones."""
    monkeypatch.setattr(bpe, "LEAF_CHARS", request.param[0])
    monkeypatch.setattr(bpe, "LEAF_BYTES", request.param[1])


def test_equal_to_the_library(leaves):
    rng, tree = random.Random(5), bpe.TreeCoder(public_tokenizers.path(bpe.VOCABULARY))
    for _ in range(3000):
        text = "".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 60)))
        assert tree.encode(text) == want(text)
        assert tree.decode(tree.encode(text)) == text.encode()


@profile(max_examples=300, deadline=None)
@given(st.text(max_size=80))
def test_any_text(text):
    assert bpe.coder().encode(text) == want(text) and bpe.coder().decode(want(text)) == text.encode()


@profile(max_examples=300, deadline=None)
@given(st.text(ALPHABET, max_size=30), st.text(ALPHABET, max_size=30), st.text(ALPHABET, max_size=30))
def test_joins_are_associative(a, b, c):
    tree = bpe.coder()
    x, y, z = tree.leaf(a), tree.leaf(b), tree.leaf(c)
    left, right = tree.join(tree.join(x, y), z), tree.join(x, tree.join(y, z))
    assert b"".join(left.ids) == b"".join(right.ids) == want(a + b + c)


@pytest.mark.parametrize("start", range(0, 0x110000, 0x8000))
def test_every_code_point(start):
    """The pattern's classes are the library's."""
    text = "\n\n".join(f"a{chr(p)}b {chr(p)} 1{chr(p)}{chr(p)}  x" for p in range(start, start + 0x8000, 1) if not 0xD800 <= p < 0xE000)
    assert bpe.coder().encode(text) == want(text)


@pytest.mark.parametrize("text", ["ab" * 20000, "a" * 8000, " " * 50000, "漢字仮名" * 15000, "the" * 20000, "x \n" * 30000, "<|endoftext|>" * 9000])
def test_long_texts_without_words(text):
    found = bpe.coder().encode(text)
    assert found == want(text) and bpe.coder().decode(found) == text.encode()


def test_known_chunks_are_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "KNOWN", 10)
    monkeypatch.setattr(bpe, "KNOWN_PAIRS", 10)
    tree = bpe.TreeCoder(public_tokenizers.path(bpe.VOCABULARY))
    text = " ".join(f"word{k}x" * (k % 9 + 1) for k in range(500))
    assert tree.encode(text) == want(text) and len(tree.known) <= 10 and len(tree.after_space) <= 10 and len(tree.pairs) <= 10


def test_messy_rows(spark):
    rows = bpe.code_both_ways(messy(spark)).collect()
    digests = lambda data: hashlib.sha256(data).hexdigest()
    brute = [(i, len(want(t or "")) // 4, digests(want(t or "")), digests((t or "").encode())) for i, t, _, _ in TEXTS]
    assert sorted(map(repr, map(tuple, rows))) == sorted(map(repr, brute))
    assert bpe.code_both_ways(empty(spark)).count() == 0
    kept = bpe.encode_texts(messy(spark).withColumnRenamed("size", "ids"))
    assert kept.columns[-1] == "ids" and kept.count() == len(TEXTS)


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for r in bpe.code_both_ways(docs).collect():
        ids = want(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids) // 4, hashlib.sha256(ids).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
