"""Token files: the ids of documents in ascending doc_id order, Simple-8b coded, and their reader.

A file is the words of its blocks, then the number of words of each block, the
ids and token counts of its documents, and a tail with the lengths of these
parts. A reader finds any document from the counts and decodes only the blocks
it lies in.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roomledger.llm import simple8b
from roomledger.llm.batches import map_batches
from roomledger.llm.files import new_folder, opened, written
from roomledger.llm.tokens import encoder
from roomledger.session import materialize

END = 1
TAIL = np.dtype([("magic", "S8"), ("ids", "<i8"), ("words", "<i8"), ("blocks", "<i8"), ("docs", "<i8")])
MAGIC = b"SIMPLE8B"
UNIT = 1 << 22  # ids that one read task decodes, or one document if it has more
CODED = 1 << 18  # ids coded together


class Writer:
    """Codes documents one after the other; keeps 21 bytes a document until the end."""

    def __init__(self, out):
        self.out, self.left, self.n_left = out, [], 0
        self.block_words, self.doc_ids, self.known, self.lengths = [], [], [], []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.left += [ids, np.array([END], np.uint32)]
        self.n_left += len(ids) + 1
        self.doc_ids.append(doc_id or 0)
        self.known.append(doc_id is not None)
        self.lengths.append(len(ids) + 1)
        if self.n_left >= CODED:
            self._code(self.n_left // simple8b.BLOCK * simple8b.BLOCK)

    def _code(self, n: int) -> None:
        ids = np.concatenate(self.left) if self.left else np.zeros(0, np.uint32)
        words, block_words = simple8b.encode(ids[:n])
        self.out.write(words.astype("<u8").tobytes())
        self.block_words.append(block_words.astype("<u2"))
        self.left, self.n_left = [ids[n:]], len(ids) - n

    def close(self) -> int:
        self._code(self.n_left)
        blocks = np.concatenate(self.block_words)
        for part in (blocks, np.array(self.doc_ids, "<i8"), np.array(self.known, "u1"), np.array(self.lengths, "<i8")):
            self.out.write(part.tobytes())
        n_ids = sum(self.lengths)
        self.out.write(np.array([(MAGIC, n_ids, int(blocks.sum(dtype=np.int64)), len(blocks), len(self.lengths))], TAIL).tobytes())
        return n_ids


def _part(source, at: int, n: int, kind: str) -> np.ndarray:
    source.seek(at)
    return np.frombuffer(source.read(n * np.dtype(kind).itemsize), kind)


class Reader:
    """The documents of a file; any range of them is read by itself."""

    def __init__(self, source):
        self.source = source
        tail = np.frombuffer(_part(source, source.size() - TAIL.itemsize, TAIL.itemsize, "u1").tobytes(), TAIL)[0]
        if tail["magic"] != MAGIC:
            raise ValueError("not a token file")
        self.n_ids, n_words, n_blocks, n_docs = (int(tail[c]) for c in ("ids", "words", "blocks", "docs"))
        at = 8 * n_words
        self.block_words = _part(source, at, n_blocks, "<u2").astype(np.int64)
        self.doc_ids = _part(source, at := at + 2 * n_blocks, n_docs, "<i8")
        self.known = _part(source, at := at + 8 * n_docs, n_docs, "u1") > 0
        self.lengths = _part(source, at + n_docs, n_docs, "<i8")
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.word_at = np.concatenate(([0], np.cumsum(self.block_words)))

    def ids(self, first: int, past: int) -> np.ndarray:
        """Ids first to past of the file."""
        low, high = first // simple8b.BLOCK, -(-past // simple8b.BLOCK)
        words = _part(self.source, 8 * int(self.word_at[low]), int(self.word_at[high] - self.word_at[low]), "<u8")
        n = min(high * simple8b.BLOCK, self.n_ids) - low * simple8b.BLOCK
        found = simple8b.decode(words.astype(np.uint64), self.block_words[low:high], n)
        return found[first - low * simple8b.BLOCK:past - low * simple8b.BLOCK]


def write_tokens(docs: DataFrame, vocabulary: str | None = None) -> tuple[str, DataFrame]:
    """Encode all texts and write them in ascending doc_id order: the folder, and a row (file, n_docs, n_ids) per file.

    Null ids come first, rows that share an id are in any order, and equal
    rows may be spread over files. A null text has the end id alone.
    """
    spark = docs.sparkSession
    folder = new_folder(spark, "tokens")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(vocabulary)
        part = TaskContext.get().partitionId()
        with written(folder, f"part-{part:06d}") as out:
            writer = Writer(out)
            for batch in batches:
                texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
                for doc_id, ids in zip(batch.column("doc_id").to_pylist(), words.encode(texts)):
                    writer.add(doc_id, ids)
            n_ids = writer.close()
        yield pa.RecordBatch.from_pydict({"file": [part], "n_docs": [len(writer.lengths)], "n_ids": [n_ids]})

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.spark_partition_id()]
    by_id = narrow.repartitionByRange(*order).sortWithinPartitions(F.col("doc_id").asc_nulls_first())
    files = materialize(map_batches(by_id, write, "file long, n_docs long, n_ids long"), "token-files")
    return folder, files


def read_tokens(folder: str, files: DataFrame) -> DataFrame:
    """Every document of the files, in the order they were written: doc_id, start, n_tokens, ids_crc32."""

    def units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, base in zip(batch.column("file").to_pylist(), batch.column("base").to_pylist()):
                with opened(folder, f"part-{file:06d}") as source:
                    reader = Reader(source)
                cut = np.flatnonzero(np.diff(reader.starts // UNIT, prepend=-1))
                for low, high in zip(cut, [*cut[1:], len(reader.starts)]):
                    yield pa.RecordBatch.from_pydict({"file": [file], "base": [base], "low": [int(low)], "high": [int(high)]})

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for unit in batch.to_pylist():
                with opened(folder, f"part-{unit['file']:06d}") as source:
                    reader = Reader(source)
                    own = slice(unit["low"], unit["high"])
                    starts, lengths = reader.starts[own], reader.lengths[own]
                    first = int(starts[0])
                    ids = reader.ids(first, int(starts[-1] + lengths[-1])).astype("<u4")
                crc = [zlib.crc32(ids[a:a + n]) for a, n in zip(starts - first, lengths)]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(reader.doc_ids[own], mask=~reader.known[own]),
                    "start": pa.array(starts + unit["base"]), "n_tokens": pa.array(lengths), "ids_crc32": pa.array(crc, pa.int64()),
                })

    ahead = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    based = files.withColumn("base", F.coalesce(F.sum("n_ids").over(ahead), F.lit(0))).filter("n_docs > 0")
    tasks = max(1, min(files.count(), 10000))
    cut = map_batches(based.select("file", "base").repartition(tasks), units, "file long, base long, low long, high long")
    spread = cut.repartition(2 * tasks)
    return map_batches(spread, read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Write the token files of ``docs`` and read them back, one row per row of ``docs``.

    Columns other than doc_id and text are not read. An empty table gives an
    empty result. ``start`` counts the ids of all documents before.
    """
    return read_tokens(*write_tokens(docs, vocabulary))
