"""Repetition rules from suffix arrays: maximal repeats of words, the share they cover and the longest of them.

Every text gets a suffix array of its words by prefix doubling. The order of
words is that of their hashes, any fixed order will do. The ranks of each
round are kept, so that the common prefix of neighbours in the array is read
off them from the longest stride to the shortest. A suffix's longest repeat is
the larger of the common prefixes with its two neighbours, and the union of
these spans is the union of all maximal repeats.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roomledger.llm.batches import map_batches
from roomledger.llm.words import IS_SPACE, grouped, scan_words

WINDOW = 5
MIN_WORDS = 10
MAX_COVERED = 0.2
MAX_LONGEST = 50
SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
FIGURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "longest_repeat"]


def suffix_ranks(words: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The suffix array of a sequence, and the ranks of its 1, 2, 4, ... word prefixes up to where all differ."""
    n = len(words)
    _, rank = np.unique(words, return_inverse=True)
    levels, h = [rank], 1
    order = np.argsort(rank, kind="stable")
    while rank[order[-1]] < n - 1 and h < n:
        after = np.zeros(n, np.int64)
        after[:n - h] = rank[h:] + 1
        key = rank * np.int64(n + 1) + after
        order = np.argsort(key, kind="stable")
        ranked = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.diff(ranked, prepend=ranked[:1]) != 0)
        levels.append(rank)
        h *= 2
    return order, levels


def common_prefixes(order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Words that each entry of a suffix array has in common with the next one."""
    n = len(order)
    a, b = order[:-1].copy(), order[1:].copy()
    found = np.zeros(n - 1, np.int64)
    for k in range(len(levels) - 1, -1, -1):
        stride = 1 << k
        fits = np.flatnonzero(np.maximum(a, b) + stride <= n)
        fits = fits[levels[k][a[fits]] == levels[k][b[fits]]]
        found[fits] += stride
        a[fits] += stride
        b[fits] += stride
    return found


def repeats(words: np.ndarray, least: int = WINDOW) -> tuple[int, int]:
    """Words covered by repeats of at least ``least`` words, and the length of the longest repeat of all."""
    n = len(words)
    if n < 2:
        return 0, 0
    order, levels = suffix_ranks(words)
    common = common_prefixes(order, levels)
    reach = np.zeros(n, np.int64)
    reach[order[:-1]] = common
    reach[order[1:]] = np.maximum(reach[order[1:]], common)
    longest = int(common.max())
    starts = np.flatnonzero(reach >= least)
    if not len(starts):
        return 0, longest
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + reach[starts], -1)
    return int(np.count_nonzero(np.cumsum(change[:n]) > 0)), longest


def duplicate_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line of the text."""
    seen, twice = set(), 0
    for line in text.split(b"\n"):
        if line.strip(b" \t\n\x0b\x0c\r"):
            twice += line in seen
            seen.add(line)
    return twice


def figures(texts: list[bytes]) -> np.ndarray:
    """One row of ``FIGURES`` per text."""
    found = np.zeros((len(texts), len(FIGURES)), np.int64)
    for low, high in grouped(texts):
        some = texts[low:high]
        joined, _, _, hashes, bounds = scan_words(some, lower=False)
        starts = np.cumsum([0, *(len(t) + 1 for t in some[:-1])])
        in_word = ~IS_SPACE[joined] & ((joined & 0xC0) != 0x80)  # the first byte of each character
        found[low:high, 0] = np.diff(bounds)
        found[low:high, 1] = np.add.reduceat(in_word, starts, dtype=np.int64)
        found[low:high, 2] = np.add.reduceat(SYMBOLS[joined], starts, dtype=np.int64)
        for i, text in enumerate(some):
            found[low + i, 3] = duplicate_lines(text)
            found[low + i, 4:] = repeats(hashes[bounds[i]:bounds[i + 1]])
    return found


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
        columns = [pa.array(c) for c in figures(texts).T]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", *FIGURES])


def repetition_rules(docs: DataFrame, max_covered: float = MAX_COVERED, max_longest: int = MAX_LONGEST) -> DataFrame:
    """Figures and verdict per row of ``docs``: doc_id, ``FIGURES``, base_failed, covered, kept.

    A text fails the base rules with fewer than ``MIN_WORDS`` words or more
    than a fifth of its words in windows found twice; it is kept if it passes
    them, repeats cover at most ``max_covered`` of its words and none is
    longer than ``max_longest`` words. A null or empty text has no words and
    fails; repeated rows and null ids are rows like any other, other columns
    are not read, an empty table gives an empty result. A text is held whole
    in one task, with ranks of 8 bytes a word for each doubling.
    """
    narrow = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    fields = [narrow.schema["doc_id"], *(T.StructField(c, T.LongType()) for c in FIGURES)]
    share = F.when(F.col("n_words") > 0, F.col("n_repeat_words") / F.col("n_words")).otherwise(F.lit(0.0))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return (
        map_batches(narrow, _measured, T.StructType(fields))
        .withColumn("base_failed", failed)
        .withColumn("covered", share)
        .withColumn("kept", ~failed & (share <= max_covered) & (F.col("longest_repeat") <= max_longest))
    )
