"""Separator scan: token counts of the documents in flat token files that have no index.

A flat file is nothing but 16-bit ids with an end-of-document id after each
document. Files are cut into blocks that tasks search on their own; what a
document has in earlier blocks follows from a prefix scan over the blocks, a
running count of the ends and the place of the last one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roomledger.llm.batches import map_batches
from roomledger.llm.files import new_folder, opened, written
from roomledger.llm.tokens import encoder
from roomledger.session import materialize

END = 49407  # of the vocabulary; texts are encoded literally, so no text holds it
KIND = np.dtype("<u2")
BLOCK = 1 << 21  # ids searched by a task at a time


def write_flat(docs: DataFrame, vocabulary: str | None = None) -> tuple[str, DataFrame]:
    """Encode texts into flat files, one a task, as the rows come: the folder and rows (file, ordinal, doc_id)."""
    folder = new_folder(docs.sparkSession, "flat")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(vocabulary, literal=True)
        part, seen = TaskContext.get().partitionId(), 0
        with written(folder, f"part-{part:06d}") as out:
            for batch in batches:
                texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
                for ids in words.encode(texts):
                    out.write(np.append(ids, END).astype(KIND).tobytes())
                n = len(texts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, part, np.int64)), pa.array(np.arange(seen, seen + n)), batch.column("doc_id")],
                    ["file", "ordinal", "doc_id"],
                )
                seen += n

    narrow = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return folder, materialize(map_batches(narrow, write, f"file long, ordinal long, doc_id {kind}"), "flat-files")


def scan_flat(folder: str, files: DataFrame, end: int = END, block: int = BLOCK) -> DataFrame:
    """Documents of flat files by their ends: rows (file, ordinal, start, n_tokens), the end id not counted.

    ``files`` has one row per file. Ids after the last end of a file belong to
    no document. ``start`` counts ids from the start of the file.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column("file").to_pylist():
                with opened(folder, f"part-{file:06d}") as source:
                    n = -(-source.size() // (block * KIND.itemsize))
                yield pa.RecordBatch.from_arrays([pa.array([file] * n, pa.int64()), pa.array(range(n), pa.int64())], ["file", "block"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, number in zip(*(batch.column(c).to_pylist() for c in ("file", "block"))):
                with opened(folder, f"part-{file:06d}") as source:
                    source.seek(number * block * KIND.itemsize)
                    ids = np.frombuffer(source.read(block * KIND.itemsize), KIND)
                ends = np.flatnonzero(ids == end) + number * block
                n = len(ends)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, file, np.int64)), pa.array(np.full(n, number, np.int64)), pa.array(np.arange(n)),
                     pa.array(ends), pa.array(np.append(-1, ends)[:n], mask=np.arange(n) == 0)],
                    ["file", "block", "nth", "end", "last"],
                )

    tasks = max(1, min(files.count(), 10000))
    blocks = map_batches(files.repartition(tasks), cut, "file long, block long").repartition(2 * tasks)
    found = materialize(map_batches(blocks, search, "file long, block long, nth long, end long, last long"), "flat-ends")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = found.groupBy("file", "block").agg(F.count("*").alias("n"), F.max("end").alias("end")).select(
        "file", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"),
        F.coalesce(F.max("end").over(before), F.lit(-1)).alias("carry"),
    )
    start = F.coalesce("last", "carry") + 1
    return found.join(carried, ["file", "block"]).select(
        "file", (F.col("ahead") + F.col("nth")).alias("ordinal"), start.alias("start"), (F.col("end") - start).alias("n_tokens")
    )


def token_counts(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Write ``docs`` to flat token files and count each document's tokens by a scan of the files.

    One row per row: doc_id, file, start (ids before it in the file, ends
    included), n_tokens (without the end id). A null or empty text has none;
    null and repeated ids are rows like any other; other columns are not
    read; an empty table gives an empty result.
    """
    folder, labels = write_flat(docs, vocabulary)
    counts = scan_flat(folder, labels.select("file").distinct())
    return labels.join(counts, ["file", "ordinal"]).select("doc_id", "file", "start", "n_tokens")
