"""Byte-level BPE as a monoid: halves are encoded by themselves and joined by encoding again what lies around the cut.

Two joins make the tree. Within one match of the pattern, tokens left and
right of the cut are taken into a window that grows until its outer tokens fit
their neighbours: a sequence of tokens is what BPE makes of its bytes if every
two neighbours are what BPE makes of theirs. (Take the first merge that would
cross a border between tokens. Up to there the two tokens beside the border
have merged as they would alone, so it would cross there too.) Within a text,
the window reaches on either side to a stable cut, before a space that follows
something else than white space: no match has a space behind another sign, and
none sees what lies past such a cut.
"""

from __future__ import annotations

import base64
import heapq
import re
import struct
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roomledger.llm.batches import map_batches

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
LEAF_BYTES = 32  # of a match that are merged without cutting them
LEAF_CHARS = 1 << 16  # of a text that are encoded from chunk to chunk
KNOWN, KNOWN_CHARS = 1 << 19, 48  # chunks and matches that a worker keeps at most, and the longest of them
KNOWN_PAIRS = 1 << 19
STABLE_CUT = re.compile(r"(?<!\s) ")
UNSTABLE_SPACE = re.compile(r"\s ")
OWN = ["n_tokens", "ids_sha256", "decoded_sha256"]


class Encoded(NamedTuple):
    """A part of a text and its ids, 32-bit little-endian, in pieces that follow each other."""

    text: str
    ids: tuple[bytes, ...]


class TreeCoder:
    """Encodes and decodes by a file of ranks and the pattern that splits a text before the merges."""

    def __init__(self, path: str, pattern: str = public_tokenizers.PATTERN):
        self.token: dict[int, bytes] = {}
        with open(path, "rb") as lines:
            for line in lines:
                word, rank = line.split()
                self.token[int(rank)] = base64.b64decode(word)
        self.rank = {word: rank for rank, word in self.token.items()}
        self.matches = regex.compile(pattern)
        self.after_space: dict[str, bytes] = {}
        self.known: dict[str, bytes] = {}
        self.pairs: dict[tuple[int, int], bool] = {}

    # Matches

    def merge(self, data: bytes) -> list[int]:
        """The ids of a few bytes: the lowest rank first, the leftmost of equal ones."""
        if data in self.rank:
            return [self.rank[data]]
        n = len(data)
        past = list(range(1, n + 1))  # where the part that begins here ends; 0 once it is merged away
        before = list(range(-1, n))
        waiting = [(r, i, i + 2) for i in range(n - 1) if (r := self.rank.get(data[i:i + 2])) is not None]
        heapq.heapify(waiting)
        while waiting:
            _, i, end = heapq.heappop(waiting)
            middle = past[i]
            if not middle or middle >= n or past[middle] != end:
                continue  # one of the two parts has changed
            past[i], past[middle] = end, 0
            if end < n:
                before[end] = i
                if (r := self.rank.get(data[i:past[end]])) is not None:
                    heapq.heappush(waiting, (r, i, past[end]))
            if i and (r := self.rank.get(data[before[i]:end])) is not None:
                heapq.heappush(waiting, (r, before[i], end))
        ids, at = [], 0
        while at < n:
            ids.append(self.rank[data[at:past[at]]])
            at = past[at]
        return ids

    def _fit(self, left: int, right: int) -> bool:
        """If BPE leaves two neighbouring tokens as they are."""
        found = self.pairs.get((left, right))
        if found is None:
            if len(self.pairs) >= KNOWN_PAIRS:
                self.pairs.clear()
            found = self.pairs[left, right] = self.merge(self.token[left] + self.token[right]) == [left, right]
        return found

    def join_ids(self, a: list[int], b: list[int]) -> list[int]:
        """The ids of a match from those of its two parts: the window around the cut grows until its ends fit."""
        if not a or not b or self._fit(a[-1], b[0]):
            return a + b
        left = right = 1
        while True:
            window = self.merge(b"".join(map(self.token.__getitem__, a[len(a) - left:] + b[:right])))
            left_fits = left == len(a) or self._fit(a[-left - 1], window[0])
            right_fits = right == len(b) or self._fit(window[-1], b[right])
            if left_fits and right_fits:
                return a[:len(a) - left] + window + b[right:]
            left = left if left_fits else min(2 * left, len(a))
            right = right if right_fits else min(2 * right, len(b))

    def encode_match(self, data: bytes) -> list[int]:
        """The ids of one match, from its halves."""
        if len(data) <= LEAF_BYTES:
            return self.merge(data)
        middle = len(data) // 2
        return self.join_ids(self.encode_match(data[:middle]), self.encode_match(data[middle:]))

    # Texts

    def encode_chunk(self, chunk: str) -> bytes:
        """The ids between two stable cuts, match by match."""
        known = self.known
        return b"".join([known.get(m) or self._packed(m) for m in self.matches.findall(chunk)])

    def _packed(self, match: str) -> bytes:
        ids = self.encode_match(match.encode())
        packed = struct.pack(f"<{len(ids)}I", *ids)
        _keep(self.known, match, packed)
        return packed

    def leaf(self, text: str) -> Encoded:
        head, *rest = STABLE_CUT.split(text) if UNSTABLE_SPACE.search(text) else text.split(" ")
        known = self.after_space
        pieces = [known.get(chunk) or self._after_space(chunk) for chunk in rest]
        return Encoded(text, (self.encode_chunk(head) + b"".join(pieces),))

    def _after_space(self, chunk: str) -> bytes:
        packed = self.encode_chunk(" " + chunk)
        _keep(self.after_space, chunk, packed)
        return packed

    def join(self, a: Encoded, b: Encoded) -> Encoded:
        """The text of both and its ids: the chunks that touch the cut are encoded again as one, all others stand."""
        if not a.text or not b.text:
            return a if a.text else b
        if b.text[0] == " " and not a.text[-1].isspace():
            return Encoded(a.text + b.text, a.ids + b.ids)  # the cut itself is stable
        start, end = self._last_cut(a.text), self._first_cut(b.text)
        tail, head = a.text[start:], b.text[:end]
        window = self.encode_chunk(tail + head)
        return Encoded(
            a.text + b.text,
            _without_last(a.ids, len(self.encode_chunk(tail))) + (window,) + _without_first(b.ids, len(self.encode_chunk(head))),
        )

    @staticmethod
    def _last_cut(text: str) -> int:
        at = text.rfind(" ")
        while at > 0 and text[at - 1].isspace():
            at = text.rfind(" ", 0, at)
        return max(at, 0)

    @staticmethod
    def _first_cut(text: str) -> int:
        found = STABLE_CUT.search(text, 1)
        return found.start() if found else len(text)

    def encode_tree(self, text: str) -> Encoded:
        """A part of a text, from its halves."""
        if len(text) <= LEAF_CHARS:
            return self.leaf(text)
        middle = len(text) // 2
        return self.join(self.encode_tree(text[:middle]), self.encode_tree(text[middle:]))

    def encode(self, text: str) -> bytes:
        """The ids of a whole text."""
        return b"".join(self.encode_tree(text).ids)

    def decode(self, ids: bytes) -> bytes:
        """The bytes of ids: those of the halves after each other."""
        if len(ids) <= 4 * LEAF_CHARS:
            return b"".join(map(self.token.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        middle = len(ids) // 8 * 4
        return self.decode(ids[:middle]) + self.decode(ids[middle:])


def _keep(known: dict[str, bytes], text: str, packed: bytes) -> None:
    if len(text) <= KNOWN_CHARS:
        if len(known) >= KNOWN:
            known.clear()
        known[text] = packed


def _without_last(pieces: tuple[bytes, ...], n: int) -> tuple[bytes, ...]:
    kept = list(pieces)
    while n:
        cut = min(n, len(kept[-1]))
        kept[-1] = kept[-1][:len(kept[-1]) - cut]
        n -= cut
        if n:
            kept.pop()
    return tuple(kept)


def _without_first(pieces: tuple[bytes, ...], n: int) -> tuple[bytes, ...]:
    at = 0
    while n > len(pieces[at]):
        n -= len(pieces[at])
        at += 1
    return (pieces[at][n:],) + pieces[at + 1:]


@lru_cache(maxsize=4)
def coder(path: str | None = None) -> TreeCoder:
    """This worker's coder for a file of ranks."""
    return TreeCoder(path or public_tokenizers.path(VOCABULARY))


def encode_texts(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``docs`` with ``ids``, the token ids of the whole text as 32-bit little-endian integers in one binary.

    A null text has no ids, as an empty one. A column ``ids`` of the input
    gives way; an empty table gives an empty result.
    """
    kept = [c for c in docs.columns if c != "ids"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = coder(vocabulary)
        for batch in batches:
            ids = [tree.encode(t) if t else b"" for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(ids, pa.binary())], [*kept, "ids"])

    return map_batches(docs.select(*kept), work, T.StructType([*(docs.schema[c] for c in kept), T.StructField("ids", T.BinaryType())]))


def decode_ids(encoded: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Rows of ``encode_texts`` with ``decoded``, the bytes that their ids stand for; null ids give none."""
    kept = [c for c in encoded.columns if c != "decoded"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = coder(vocabulary)
        for batch in batches:
            found = [tree.decode(ids) if ids else b"" for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(found, pa.binary())], [*kept, "decoded"])

    schema = T.StructType([*(encoded.schema[c] for c in kept), T.StructField("decoded", T.BinaryType())])
    return map_batches(encoded.select(*kept), work, schema)


def code_both_ways(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Every document's tokens and its bytes after decoding them, as digests: doc_id and ``OWN``.

    A row for every row, repeated ones and null ids included; a null text
    counts as empty.
    """
    encoded = encode_texts(docs.select("doc_id", "text"), vocabulary).drop("text")
    return decode_ids(encoded, vocabulary).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
