"""Small tables with all that can go wrong in a column, and brute-force versions of the operators."""

from __future__ import annotations

import re
from collections import Counter

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
CLASHES = ["size", "shard", "slot", "text_hash", "hash", "key", "row", "node", "id", "first", "times", "target", "score", "leak",
           "lang_pred", "words", "n_words", "bucket", "block", "group", "n_private", "rows", "file", "turn"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHES)

LONG = " ".join(f"w{i % 7919}x{i % 13}" for i in range(60000))
TEXTS = [
    (1, "one two three four five six seven eight nine ten", "en", "a"),
    (1, "one two three four five six seven eight nine ten", "en", "a"),  # a repeated row
    (2, "one two three four five six seven eight nine ten", "en", "b"),  # a copy
    (1, "another text under an id that is used before", "en", None),
    (None, "a text without an id that has a few words", None, "a"),
    (None, None, None, None),
    (3, None, "en", "a"),
    (4, "", "en", "b"),
    (5, " \t\n\x0b\x0c\r ", None, "b"),
    (6, "12 34 !!", "de", None),
    (7, LONG, "de", "a"),
    (8, LONG + " tail", "de", "c"),
    (9, "ÉTÉ été  nbsp İstanbul Σίσυφος 漢字 \U0001f600 <|endoftext|> a\x00b", "fr", "c"),
    (10, "a a a a a a a a a a a a a a", "fr", "c"),
]


def messy(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and columns whose names operators use themselves."""
    rows = [(i, t, lang, source, None if t is None else len(t), *(["x"] * len(CLASHES))) for i, t, lang, source in TEXTS]
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text: str | None) -> list[bytes]:
    return WORD.findall((text or "").encode())


def shingles(text: str | None) -> frozenset[bytes]:
    found = [w.lower() for w in words(text)]  # bytes.lower() changes A to Z only
    if not found:
        return frozenset()
    return frozenset(b" ".join(found[k:k + 5]) for k in range(max(1, len(found) - 4)))


def components(texts: list[tuple[int | None, str | None]]) -> Counter:
    """(doc_id, n_shingles, component_id) of every row, by comparing all pairs."""
    sets = [shingles(t) for _, t in texts]
    parent = list(range(len(texts)))

    def root(k: int) -> int:
        while parent[k] != k:
            k = parent[k]
        return k

    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    least: dict[int, int | None] = {}
    for k, (doc_id, _) in enumerate(texts):
        known = least.get(root(k))
        least[root(k)] = doc_id if known is None else known if doc_id is None else min(known, doc_id)
    return Counter((doc_id, len(sets[k]), least[root(k)]) for k, (doc_id, _) in enumerate(texts))


def repetition(text: str | None) -> tuple[int, int]:
    """Words in five-word windows found twice, and the longest run of words found twice."""
    found = words(text)
    n = len(found)
    times = Counter(tuple(found[k:k + 5]) for k in range(n - 4))
    covered = {k + i for k in range(n - 4) if times[tuple(found[k:k + 5])] > 1 for i in range(5)}
    longest = 0
    for i in range(n):
        for j in range(i):
            k = 0
            while i + k < n and found[i + k] == found[j + k]:
                k += 1
            longest = max(longest, k)
    return len(covered), longest
