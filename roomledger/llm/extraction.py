"""Main text of web pages: a linear-chain conditional random field over the leaf blocks of the DOM.

Features of a block are the tags and names of the elements around it and what
its text looks like; transitions tie neighbouring blocks. The weights are
learned from labelled pages on the driver (a fixed number of pages, a model of
a few thousand weights) and every page is decoded by Viterbi in its task.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roomledger.llm.batches import map_batches
from roomledger.llm.dom import Block, Node, blocks
from roomledger.llm.labelled_pages import labelled_pages

STEPS = 200
RATE = 0.1
DECAY = 1e-4
CONTEXTS = 1 << 16  # elements whose features a worker remembers
NEAR = 400  # characters from a block's beginning and end that may hold cue words
SECTIONS = frozenset("article main section nav header footer aside form".split())
NAME = re.compile(r"[a-z]+")
CUES = re.compile(
    r"©|cookie|subscri|sign up|log in|share|repl(?:y|ies)|comment|privacy|read more|rights reserved|terms of|advert|newsletter|accept", re.I
)


def element_features(tag: str, names: str) -> set[str]:
    """Features of one of the elements around a block."""
    found = {"in " + tag}
    for name in NAME.findall(names):
        name = name.rstrip("s") or name
        found.add("named " + name)
        if len(name) > 4:
            found.add("begins " + name[:4])
    return found


def place_features(last: list[str], plain: bool) -> list[str]:
    """Features of the innermost two elements, and of a place outside all ``SECTIONS``."""
    return ["own " + (last[-1] if last else ""), "below " + " ".join(last)] + ["plain"] * plain


def path_features(path: tuple[tuple[str, str], ...]) -> list[str]:
    """Features of all the elements around a block."""
    tags = [tag for tag, _ in path]
    found = set().union(*(element_features(*e) for e in path))
    return sorted(found.union(place_features(tags[-2:], not SECTIONS & set(tags))))


def text_features(block: Block) -> list[str]:
    """Features of a block's own text; cue words count at its beginning and at its end."""
    text, n = block.text, len(block.text)
    found = [f"length {min(n.bit_length(), 10)}", f"linked {3 * block.linked // n}"]
    if text[-1] in ".!?…»\"”":
        found.append("sentence")
    if text[0] == "©":
        found.append("copyright")
    ends = text if n <= 2 * NEAR else text[:NEAR] + "\n" + text[-NEAR:]
    found += ["cue " + c for c in sorted({c.lower() for c in CUES.findall(ends)})]
    return found


@dataclass
class Field:
    """Weights of features (for the article label), of transitions, and of the first label."""

    weights: dict[str, float]
    bias: float
    moves: np.ndarray
    first: np.ndarray
    bits: dict[str, int] = field(default_factory=dict, repr=False)  # of features that have weights
    elements: dict = field(default_factory=dict, repr=False)

    def _element(self, tag: str, names: str) -> tuple[tuple[int, float], ...]:
        """The features of an element as (bit, weight)."""
        known = self.elements.get((tag, names))
        if known is None:
            met = sorted(f for f in element_features(tag, names) if f in self.weights)
            known = tuple((self.bits.setdefault(f, 1 << len(self.bits)), self.weights[f]) for f in met)
            if len(self.elements) < CONTEXTS:
                self.elements[tag, names] = known
        return known

    def _around(self, node: Node | None, states: dict) -> tuple[int, float, bool]:
        """Features met from the outside to ``node`` as bits, their summed weights, and whether no section is open.

        ``states`` keeps those of a page, so every element is looked at once.
        """
        climb = []
        while node is not None and node not in states:
            climb.append(node)
            node = node.above
        met, score, plain = states[node] if node is not None else (0, 0.0, True)
        for node in reversed(climb):
            for bit, weight in self._element(node.tag, node.names):
                if not met & bit:
                    met, score = met | bit, score + weight
            plain = plain and node.tag not in SECTIONS
            states[node] = met, score, plain
        return met, score, plain

    def _emission(self, block: Block, states: dict | None = None) -> float:
        node = block.inside
        _, score, plain = self._around(node, {} if states is None else states)
        last = [n.tag for n in (node and node.above, node) if n is not None]
        return self.bias + score + sum(self.weights.get(f, 0.0) for f in place_features(last, plain) + text_features(block))

    def decode(self, page: list[Block]) -> list[int]:
        """The most likely labels of a page's blocks, by Viterbi; ties go to the earlier label."""
        if not page:
            return []
        states: dict = {}
        (m00, m01), (m10, m11) = self.moves.tolist()
        a, b = float(self.first[0]), float(self.first[1]) + self._emission(page[0], states)
        back = []
        for block in page[1:]:
            to_a, to_b = (a + m00, b + m10), (a + m01, b + m11)
            back.append((to_a[1] > to_a[0], to_b[1] > to_b[0]))
            a, b = max(to_a), max(to_b) + self._emission(block, states)
        label = int(b > a)
        labels = [label]
        for step in reversed(back):
            label = int(step[label])
            labels.append(label)
        return labels[::-1]


def _marginals(emission: np.ndarray, length: np.ndarray, moves: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chance of label 1 at each place of padded pages, and summed chances of the moves, by forward and backward passes."""
    n, width = emission.shape
    score = np.stack([np.zeros_like(emission), emission], axis=2)
    ahead, behind = np.zeros((n, width, 2)), np.zeros((n, width, 2))
    ahead[:, 0] = score[:, 0] + first
    for t in range(1, width):
        ahead[:, t] = np.logaddexp.reduce(ahead[:, t - 1, :, None] + moves, axis=1) + score[:, t]
    for t in range(width - 2, -1, -1):
        step = np.logaddexp.reduce(moves + (score[:, t + 1] + behind[:, t + 1])[:, None, :], axis=2)
        behind[:, t] = np.where((t + 1 < length)[:, None], step, 0.0)
    total = np.logaddexp.reduce(np.take_along_axis(ahead, (length - 1)[:, None, None].repeat(2, 2), 1)[:, 0], axis=1)
    chance = np.exp(ahead + behind - total[:, None, None])[:, :, 1]
    inner = np.arange(1, width)[None, :] < length[:, None]
    pair = np.exp(ahead[:, :-1, :, None] + moves + (score[:, 1:] + behind[:, 1:])[:, :, None, :] - total[:, None, None, None])
    return chance, (pair * inner[:, :, None, None]).sum(axis=(0, 1))


def fit(pages: list[tuple[list[Block], list[int]]]) -> Field:
    """Learn the field by gradient ascent (with momentum scaled per weight) on the likelihood of the labels."""
    pages = [p for p in pages if p[0]]
    names: dict[str, int] = {}
    owner, used = [], []
    for k, block in enumerate(b for p, _ in pages for b in p):
        for f in (*path_features(block.path), *text_features(block)):
            used.append(names.setdefault(f, len(names)))
            owner.append(k)
    owner, used = np.array(owner), np.array(used)
    length = np.array([len(p) for p, _ in pages])
    inside = np.arange(length.max())[None, :] < length[:, None]
    labels = np.zeros(inside.shape, np.int64)
    labels[inside] = np.concatenate([y for _, y in pages])
    both = inside[:, 1:]
    seen_moves = np.zeros((2, 2))
    np.add.at(seen_moves, (labels[:, :-1][both], labels[:, 1:][both]), 1)
    seen_first = np.bincount(labels[:, 0], minlength=2)
    n = int(length.sum())
    theta = np.zeros(len(names) + 1 + 4 + 2)
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        w, bias, moves, first = theta[:len(names)], theta[len(names)], theta[len(names) + 1:-2].reshape(2, 2), theta[-2:]
        emission = np.zeros(inside.shape)
        emission[inside] = bias + np.bincount(owner, weights=w[used], minlength=n)
        chance, pairs = _marginals(emission, length, moves, first)
        off = (labels - chance)[inside]
        first_chance = np.array([(1 - chance[:, 0]).sum(), chance[:, 0].sum()])
        slope = np.concatenate((
            np.bincount(used, weights=off[owner], minlength=len(names)), [off.sum()],
            (seen_moves - pairs).reshape(-1), seen_first - first_chance,
        )) / n - DECAY * theta
        mean, square = 0.9 * mean + 0.1 * slope, 0.999 * square + 0.001 * slope ** 2
        theta = theta + RATE * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.999 ** step)) + 1e-8)
    w = theta[:len(names)]
    return Field({f: float(w[k]) for f, k in names.items()}, float(theta[len(names)]), theta[len(names) + 1:-2].reshape(2, 2), theta[-2:])


@lru_cache(maxsize=1)
def default_field() -> Field:
    return fit(labelled_pages())


def main_text(html: str | None, model: Field) -> str:
    page = blocks(html or "")
    return "\n".join(b.text for b, label in zip(page, model.decode(page)) if label)


def extract(pages: DataFrame, model: Field | None = None) -> DataFrame:
    """page_id, url, text and n_chars of every row of ``pages``.

    A null or empty page, or one without an article, has an empty text and 0
    characters. Null and repeated ids are rows like any other, other columns
    are not read, an empty table gives an empty result. A page is held whole
    in one task.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model or default_field())  # of a fixed size

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(html, shared.value) for html in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    narrow = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))
    schema = T.StructType([narrow.schema["page_id"], narrow.schema["url"], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    return map_batches(narrow, work, schema)
