"""Language of whole texts by string kernels.

A piece of a text is the set of its letter n-grams of 1 to 4 letters, hashed
to ``FEATURES`` places. The kernel of two pieces is the number of n-grams they
share over the geometric mean of their set sizes. Pieces are mapped by their
kernels with labelled landmarks (Nyström), and one-versus-rest kernel ridge
regression on these is learned from a bounded sample of labelled texts. A
batch of pieces is scored by two matrix products, and a text by the mean of
all its pieces, weighed by their letters: the set of a whole long text would
hold nearly every n-gram, whatever its language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roomledger.llm.batches import map_batches

FEATURES = 1 << 13
ORDERS = (1, 2, 3, 4)
PIECE = 1024  # letters and spaces of a piece
SAMPLE = 3000  # labelled texts learned from, at most; they are dealt to the languages
LANDMARKS = 128  # or one per language, if there are more
LANGUAGES = 512  # learned at most, the most frequent ones
SCORED = 1024  # pieces scored at once
RIDGE = 1e-3
UNKNOWN = "und"
LEAST_SCORE = 0.1  # a text like no learned language scores about 0
TABLE = 0x32400  # code points looked up; beyond them there are no letters
CHARS = 1 << 20  # of texts scanned at once
COMPARED = 256  # sets whose kernels are worked out at once


def is_held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning: crc32 of its id as text leaves 1 when divided by 3."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point its letter in lower case, or 0 if it is none."""
    table = np.zeros(TABLE, np.uint32)
    for c in range(TABLE):
        if chr(c).isalpha():
            lower = chr(c).lower()
            table[c] = ord(lower) if len(lower) == 1 else c
    return table


def _symbols(text: str) -> Iterator[tuple[np.ndarray, bool]]:
    """The letters of a text in blocks, runs of other characters and both ends as one 0; and if a block is the last."""
    table = _letters()
    last = 0
    yield np.zeros(1, np.uint32), False
    for low in range(0, len(text), CHARS):
        codes = np.frombuffer(text[low:low + CHARS].encode("utf-32-le", "surrogatepass"), np.uint32)
        letters = table[np.minimum(codes, TABLE - 1)]
        block = letters[(letters != 0) | np.append(last != 0, letters[:-1] != 0)]
        last = letters[-1]
        yield block, False
    yield np.zeros(int(last != 0), np.uint32), True


def pieces(text: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pieces of a whole text in groups: places of their n-grams (0 or 1 each) by piece, and their letters.

    An n-gram belongs to the piece it begins in, so none is lost or made up
    where a piece ends.
    """
    beyond = max(ORDERS) - 1
    held = np.zeros(0, np.uint32)
    for block, last in _symbols(text):
        held = np.concatenate((held, block))
        whole = max(len(held) - beyond, 0) // PIECE
        n = -(-len(held) // PIECE) if last else whole
        if not n:
            continue
        begin = len(held) if last else whole * PIECE
        found = np.zeros((n, FEATURES), np.uint8)
        value = np.zeros(len(held), np.uint32)
        for order in ORDERS:
            if len(held) < order:
                break
            value = value[:len(held) - order + 1] * np.uint32(0x01000193) ^ held[order - 1:]
            spread = (value[:begin] + np.uint32(order)) * np.uint32(0x9E3779B1)
            found[np.arange(len(spread)) // PIECE, spread >> np.uint32(32 - 13)] = 1
        yield found, np.add.reduceat(held[:begin] != 0, np.arange(n) * PIECE, dtype=np.int64)
        held = held[begin:]


@dataclass
class Model:
    """Landmarks (places by landmark, each over the root of its size) and weights by language."""

    languages: list[str]
    landmarks: np.ndarray
    weights: np.ndarray

    def scores(self, places: np.ndarray) -> np.ndarray:
        sizes = np.sqrt(np.maximum(places.sum(axis=1, dtype=np.float32), 1))
        kernel = (places.astype(np.float32) @ self.landmarks) / sizes[:, None]
        return kernel @ self.weights


def _kernel(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The kernels of all sets of ``a`` with all of ``b``; ``a`` is turned to floats ``COMPARED`` rows at a time."""
    found = np.zeros((len(a), len(b)), np.float32)
    b = b.astype(np.float32)
    for low in range(0, len(a), COMPARED):
        rows = a[low:low + COMPARED].astype(np.float32)
        found[low:low + COMPARED] = (rows @ b.T) / np.sqrt(np.maximum(np.outer(rows.sum(axis=1), b.sum(axis=1)), 1))
    return found


def fit(places: np.ndarray, labels: list[str], n_landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """Learn from labelled sets; landmarks are dealt to the languages in turn, in the order of the rows, at least one to each."""
    languages = sorted(set(labels))
    n_landmarks = max(n_landmarks, len(languages))
    if not languages:
        return Model([], np.zeros((FEATURES, 0), np.float32), np.zeros((0, 0), np.float32))
    of = np.array([languages.index(x) for x in labels])
    turn = np.zeros(len(of), np.int64)
    for k in range(len(languages)):
        turn[of == k] = np.arange((of == k).sum())
    chosen = np.lexsort((of, turn))[:n_landmarks]
    marks = places[chosen]
    known, among = _kernel(places, marks).astype(np.float64), _kernel(marks, marks).astype(np.float64)
    target = (of[:, None] == np.arange(len(languages))).astype(np.float64)
    left = known.T @ known + ridge * len(of) * (among + 1e-6 * np.eye(len(chosen)))
    weights = np.linalg.solve(left, known.T @ target)
    sizes = np.sqrt(np.maximum(marks.sum(axis=1, dtype=np.float32), 1))
    return Model(languages, (marks / sizes[:, None]).T.astype(np.float32).copy(), weights.astype(np.float32))


def scored(texts: list[str], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Per text its score for every language, the mean of its pieces by their letters, and its letters.

    ``SCORED`` pieces, or those of one block of a text, are held at a time.
    """
    total, weight = np.zeros((len(texts), len(model.languages))), np.zeros(len(texts), np.int64)
    waiting: list[tuple[int, np.ndarray, np.ndarray]] = []

    def settle() -> None:
        if waiting:
            owner = np.concatenate([np.full(len(sizes), i) for i, _, sizes in waiting])
            sizes = np.concatenate([sizes for _, _, sizes in waiting])
            if model.languages:
                np.add.at(total, owner, model.scores(np.concatenate([rows for _, rows, _ in waiting])) * sizes[:, None])
            np.add.at(weight, owner, sizes)
            waiting.clear()

    for i, text in enumerate(texts):
        for rows, sizes in pieces(text):
            if sum(len(w[2]) for w in waiting) + len(sizes) > SCORED:
                settle()
            waiting.append((i, rows, sizes))
    settle()
    return total / np.maximum(weight, 1)[:, None], weight


def _quotas(counts: dict[str, int], sample: int) -> dict[str, int]:
    """The sample dealt to the languages: all of a rare one, equal shares of the others."""
    quotas, left = {}, sample
    for k, (language, n) in enumerate(sorted(counts.items(), key=lambda item: (item[1], item[0]))):
        quotas[language] = min(n, left // (len(counts) - k))
        left -= quotas[language]
    return quotas


def train(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn from up to ``sample`` labelled documents that are not held out, dealt to the ``LANGUAGES`` most frequent languages.

    A language's documents are the least by a hash of the id, and one piece of
    each is learned from, chosen by the hash. Tasks send the sets of n-grams,
    ``FEATURES`` bits a text, not the texts.
    """
    labelled = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~is_held_out(F.col("doc_id")))
    labelled = labelled.select("text", "lang", F.xxhash64("doc_id").alias("by0"), F.xxhash64("text").alias("by1"))
    counts = labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).collect()
    quotas = _quotas({r["lang"]: r["count"] for r in counts}, sample)
    if not quotas:
        return fit(np.zeros((0, FEATURES), np.uint8), [])
    # About four times as many as wanted lie below a language's bound, for ids that occur more than once.
    low, span = -(1 << 63), 1 << 64
    bounds = [(r["lang"], quotas[r["lang"]], low + min(span - 1, 4 * quotas[r["lang"]] * span // r["count"])) for r in counts]
    wanted = F.broadcast(docs.sparkSession.createDataFrame(bounds, "lang string, quota int, bound long"))  # LANGUAGES rows
    near = labelled.join(wanted, "lang").filter(F.col("by0") <= F.col("bound"))
    in_language = Window.partitionBy("lang").orderBy("by0", "by1")
    chosen = near.select("lang", "quota", "by0", "by1").distinct().withColumn("rank", F.row_number().over(in_language))
    keys = F.broadcast(chosen.filter(F.col("rank") <= F.col("quota")).select("lang", "by0", "by1"))  # ``sample`` rows at most

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = []
            for text, by in zip(batch.column("text").to_pylist(), batch.column("by0").to_pylist()):
                groups = [(np.packbits(rows, axis=1), sizes) for rows, sizes in pieces(text)]
                rows, sizes = (np.concatenate(part) for part in zip(*groups))
                long = np.flatnonzero(sizes >= sizes.max() / 2)
                bits.append(rows[long[by % len(long)]].tobytes() if sizes.any() else None)
            columns = [*(batch.column(c) for c in ("by0", "by1", "lang")), pa.array(bits, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["by0", "by1", "lang", "bits"])

    schema = "by0 long, by1 long, lang string, bits binary"
    texts = near.join(keys, ["lang", "by0", "by1"]).select("text", "lang", "by0", "by1")
    rows = map_batches(texts, sets, schema).filter(F.col("bits").isNotNull()).dropDuplicates().collect()
    rows.sort(key=lambda r: (r["by0"], r["by1"], r["lang"]))
    bits = np.frombuffer(b"".join(r["bits"] for r in rows), np.uint8).reshape(len(rows), FEATURES // 8)
    return fit(np.unpackbits(bits, axis=1), [r["lang"] for r in rows])


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with lang_pred and score (0 to 1) of each whole text; columns by these names give way.

    A null text or one without a letter is ``und`` with score 0, as is every
    text if no language was learned. Equal scores go to the first language by
    name. All columns and rows are kept.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of a fixed size
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    text_at = kept.index("text")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            scores, letters = scored([t or "" for t in batch.column(text_at).to_pylist()], model)
            lettered = letters > 0
            if model.languages:
                scores = np.clip(scores, 0, 1)
                best = np.where(lettered, scores.argmax(axis=1), len(model.languages))
                value = np.where(lettered, scores.max(axis=1), 0.0)
            else:
                best, value = np.zeros(len(lettered), np.int64), np.zeros(len(lettered))
            names = np.array([*model.languages, UNKNOWN], dtype=object)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names[best], pa.string()), pa.array(value.astype(np.float64))],
                [*batch.schema.names, "lang_pred", "score"],
            )

    schema = T.StructType([
        *docs.select(*kept).schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
    ])
    return map_batches(docs.select(*kept), score, schema)


def keep_identified(docs: DataFrame, sample: int = SAMPLE, least: float = LEAST_SCORE) -> DataFrame:
    """``docs`` without the rows whose language is ``und`` or scores below ``least``; rows and columns are as they were."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, sample))
    text_at = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, letters = scored([t or "" for t in batch.column(text_at).to_pylist()], shared.value)
            kept = letters > 0
            if shared.value.languages:
                kept &= scores.max(axis=1) >= least
            yield batch.filter(pa.array(kept))

    return map_batches(docs, keep, docs.schema)


def identify(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Learn from ``docs`` and predict its texts: doc_id, held_out, lang_pred, score, one row per row.

    Nothing but the text is an input of a prediction. A null id is not held
    out; repeated rows are predicted alike; an empty table gives an empty result.
    """
    model = train(docs, sample)
    narrow = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    found = predict(narrow, model)
    return found.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
