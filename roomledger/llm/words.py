"""Words of many texts at once, as arrays over their bytes.

A word is a run of bytes other than space and 0x09 to 0x0D, which UTF-8 uses
for nothing else. Texts are scanned in groups of about ``GROUP`` bytes, so the
arrays stay small whatever a batch holds; a longer text is a group of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np

GROUP = 1 << 20
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words(NamedTuple):
    """The words of a group of texts."""

    joined: np.ndarray  # bytes of all texts, each followed by a line end
    first: np.ndarray  # where each word begins in them
    past: np.ndarray  # and where it has ended
    hashes: np.ndarray
    bounds: np.ndarray  # where each text's words begin among all words; one more entry than texts

    def some(self, which: np.ndarray) -> list[str]:
        """Some of the words as strings."""
        length = self.past[which] - self.first[which] + 1  # with the white space behind a word
        ends = np.cumsum(length)
        found = self.joined[np.arange(ends[-1]) + np.repeat(self.first[which] - (ends - length), length)] if len(which) else self.joined[:0]
        found[ends - 1] = ord("\n")
        return found.tobytes().decode().split("\n")[:-1]


def grouped(texts: list[bytes], most: int = GROUP) -> Iterator[tuple[int, int]]:
    """Ranges of texts to scan together."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > most:
            yield start, i
            start, size = i, 0
        size += len(text) + 1
    if start < len(texts):
        yield start, len(texts)


def _powers(n: int) -> np.ndarray:
    powers = np.full(n, MULTIPLIER, np.uint64)
    powers[0] = 1
    return np.multiply.accumulate(powers)


POWERS = _powers(256)


def scan_words(texts: list[bytes], lower: bool) -> Words:
    """All words of a group of texts with 64-bit hashes of their bytes, A to Z as a to z if ``lower``."""
    joined = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    if lower:
        joined = LOWER[joined]
    ends = np.cumsum([len(t) + 1 for t in texts])
    inside = ~IS_SPACE[joined]
    edge = np.diff(inside.view(np.int8), prepend=np.int8(0))
    first, past = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    bounds = np.concatenate(([0], np.searchsorted(first, ends)))
    if not len(first):
        return Words(joined, first, past, np.zeros(0, np.uint64), bounds)
    at = np.flatnonzero(inside)
    length = past - first
    run = np.cumsum(length) - length
    place = np.arange(len(at)) - np.repeat(run, length)
    powers = POWERS if length.max() <= len(POWERS) else _powers(int(length.max()))
    value = (joined[at].astype(np.uint64) + np.uint64(1)) * powers[place]
    hashes = mixed(np.add.reduceat(value, run) + length.astype(np.uint64))
    return Words(joined, first, past, hashes, bounds)


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` neighbouring words; entry i starts at word i."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    found = np.zeros(n, np.uint64)
    for k in range(width):
        found = mixed(found * MULTIPLIER + words[k:k + n])
    return found
