from __future__ import annotations

import sys
import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings as profile, strategies as st
from tokenizers import Tokenizer

from roomledger.llm import packed, simple8b, tokencounts, tokens
from tests.llm.cases import TEXTS, empty, messy


def plain(literal=False):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(tokens.VOCABULARY))
    tokenizer.encode_special_tokens = literal
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


@profile(max_examples=200, deadline=None)
@given(st.lists(st.one_of(
    st.text(max_size=30), st.text("aAéÉß'sdtre<|endoftext>. \n\x85\xa0\xad\x1c1²", max_size=40),
    st.sampled_from(["<|endoftext|> x", "<|ENDOFTEXT|>", "it's I'LL we'Re", "Σίσυφος İI", "é Å"])), max_size=6), st.booleans())
def test_ids_equal_the_tokenizers(texts, literal):
    encoder = tokens.WordEncoder(public_tokenizers.path(tokens.VOCABULARY), literal)
    for _ in range(2):  # the second time from what was learned
        found = encoder.encode([t.encode("utf-8", "replace") for t in texts])
        for text, ids in zip(texts, found):
            assert ids.tolist() == plain(literal)(text.encode("utf-8", "replace").decode())


def test_new_words_are_cut_into_parts_together():
    some = [a + b for a in "abcdef" for b in "uvwxyz"]
    text = " ".join(f"{a}.{b}" for a in some for b in some)
    encoder, calls = tokens.WordEncoder(public_tokenizers.path(tokens.VOCABULARY)), 0

    def count(frame, event, arg):
        nonlocal calls
        calls += event == "call"

    sys.setprofile(count)
    try:
        found = encoder.encode([text.encode()])
    finally:
        sys.setprofile(None)
    assert found[0].tolist() == plain()(text)
    assert calls < len(some) ** 2  # not one for each new word


def test_plain_words_are_those_that_are_printable_in_latin_1():
    for c in map(chr, [*range(0x21, 0x180), 0x3000, 0x4E00]):
        if not c.isspace():
            assert bool(tokens.PLAIN.fullmatch(c)) == (c.isprintable() and c <= "\xff"), c
    assert not tokens.PLAIN.fullmatch("a<|b") and tokens.PLAIN.fullmatch("a<b|")


def test_widths_looked_up_are_those_compared():
    for values in ([0, 1, 2, 3, 255, 256, 65535], [65536, 5, 1 << 59, 1 << 60, (1 << 64) - 1], []):
        values = np.array(values, np.uint64)
        assert np.array_equal(simple8b._widths(values), simple8b._compared_widths(values))


@profile(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 50000), st.integers(0, (1 << 64) - 1)), max_size=700))
def test_words_of_simple8b_hold_all_ids(ids):
    ids = np.array(ids, np.uint64)
    coded, block_words = simple8b.encode(ids)
    assert len(block_words) == -(-len(ids) // simple8b.BLOCK) and block_words.sum() == len(coded)
    assert np.array_equal(simple8b.decode(coded, block_words, len(ids)), ids)
    if len(ids) > simple8b.BLOCK:  # the second block alone
        own = slice(block_words[0], block_words[0] + block_words[1])
        part = ids[simple8b.BLOCK:2 * simple8b.BLOCK]
        assert np.array_equal(simple8b.decode(coded[own], block_words[1:2], len(part)), part)


def test_token_files_give_back_every_document(spark, monkeypatch):
    monkeypatch.setattr(packed, "UNIT", 5000)
    monkeypatch.setattr(packed, "CODED", 2000)
    rows = [tuple(r) for r in packed.token_files(messy(spark)).collect()]
    encode = plain()
    want = sorted((i is not None, i or 0, zlib.crc32(np.array(encode(t) + [1], "<u4").tobytes()), len(encode(t)) + 1) for i, t, _, _ in TEXTS)
    assert sorted((i is not None, i or 0, crc, n) for i, _, n, crc in rows) == want
    rows.sort(key=lambda r: r[1])
    assert [r[1] for r in rows] == np.cumsum([0, *(r[2] for r in rows[:-1])]).tolist()
    ids = [r[0] for r in rows]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    assert packed.token_files(empty(spark)).count() == 0


def test_separator_scan_counts_across_blocks(spark):
    encode = plain(literal=True)
    want = sorted(((i or 0), len(encode(t))) for i, t, _, _ in TEXTS)
    folder, labels = tokencounts.write_flat(messy(spark))
    for block in (700, 1 << 21):
        counts = tokencounts.scan_flat(folder, labels.select("file").distinct(), block=block)
        rows = labels.join(counts, ["file", "ordinal"]).collect()
        assert sorted((r.doc_id or 0, r.n_tokens) for r in rows) == want, block
    found = tokencounts.token_counts(messy(spark)).collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in found) == want
    assert tokencounts.token_counts(empty(spark)).count() == 0
