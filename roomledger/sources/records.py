"""Records of large CSV files in many tasks, although quoted texts may hold line breaks.

Whether a line begins inside quotes depends on all before it. Every line is a
function from "the line begins inside quotes" to "the next one does". Tasks
chain these functions over the byte range they read, for both ways it may
begin; a prefix scan over the few ranges then tells which way each does. A
second look puts records together where they are read; only those that go over
the end of a range are shuffled, in one piece per range.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roomledger.session import materialize

# A field in quotes (doubled ones are text), what may follow its end, and a field without quotes.
_QUOTED = r'"[^"]*+(?:""[^"]*+)*+"[^,]*+'
_PLAIN = r'(?:[^",][^,]*+)?'
_OPEN = r'"[^"]*+(?:""[^"]*+)*+'
_FROM_OUTSIDE = rf"^(?:(?:{_QUOTED}|{_PLAIN}),)*+{_OPEN}$"
_STAYS = r'^[^"]*+(?:""[^"]*+)*+$'
_FROM_INSIDE = rf'^[^"]*+(?:""[^"]*+)*+"[^,]*+,(?:(?:{_QUOTED}|{_PLAIN}),)*+{_OPEN}$'
_END = "file string, range long, out0 boolean, out1 boolean, first0 long, first1 long, header string"
_RECORD = "file string, value string, of_range long, of_place long, range long"


def _inside(line: Column, begins_inside: bool) -> Column:
    """Whether the line after ``line`` begins inside quotes, if ``line`` itself begins inside or outside."""
    quoted = line.contains('"')
    if begins_inside:
        return ~quoted | line.rlike(_STAYS) | line.rlike(_FROM_INSIDE)
    return quoted & line.rlike(_FROM_OUTSIDE)


def _chained(out0: np.ndarray, out1: np.ndarray, begin: bool) -> np.ndarray:
    """The state after each line, from ``begin`` on: the last line that decides it, turned by those that flip it since."""
    flips = np.cumsum(out0 & ~out1)
    decides = np.where(out0 == out1, np.arange(len(out0)), -1)
    last = np.maximum.accumulate(decides)
    since = flips - np.where(last >= 0, flips[last], 0)
    return np.where(last >= 0, out0[last], begin) ^ (since % 2 == 1)


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """The lines of each range, in order, in as many pieces as they come."""
    for batch in batches:
        files, ranges = batch.column("file").to_pylist(), batch.column("range").to_numpy()
        cuts = [k for k in range(1, len(files)) if files[k] != files[k - 1] or ranges[k] != ranges[k - 1]]
        for low, high in zip([0, *cuts], [*cuts, len(files)]):
            if low < high:
                yield (files[low], int(ranges[low])), batch.slice(low, high - low)


def _outs(lines: pa.RecordBatch) -> list[np.ndarray]:
    return [lines.column(c).to_numpy(zero_copy_only=False).astype(bool) for c in ("out0", "out1")]


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per range: for both ways it may begin, how it ends and the place of the line its last record
    begins with (-1: before the range); and its first line, if it is a header."""
    names = [c.split()[0] for c in _END.split(", ")]

    def row() -> pa.RecordBatch:
        values = [*of, state[False][0], state[True][0], state[False][1], state[True][1], header]
        types = [pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], names)

    of, state, header, n = None, {}, None, 0
    for key, lines in _stretches(batches):
        if of != key:
            if of is not None:
                yield row()
            of, state, header, n = key, {False: (False, -1), True: (True, -1)}, lines.column("first")[0].as_py(), 0
        out0, out1 = _outs(lines)
        for way, (begin, first) in state.items():
            ends = _chained(out0, out1, begin)
            starts = np.flatnonzero(~np.r_[begin, ends[:-1]])
            state[way] = bool(ends[-1]), n + int(starts[-1]) if len(starts) else first
        n += len(out0)
    if of is not None:
        yield row()


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of lines in order, given whether their range begins inside quotes. What goes on in another range, or
    comes from one, has the range and place of the line its record begins with."""
    names = [c.split()[0] for c in _RECORD.split(", ")]

    def rows(texts: pa.Array, began: tuple[int, int] | None = None) -> pa.RecordBatch:
        placed = (*began, of[1]) if began is not None else (None, None, None)
        columns = [pa.array([v] * len(texts), pa.int64()) for v in placed]
        return pa.RecordBatch.from_arrays([pa.array([of[0]] * len(texts), pa.string()), texts, *columns], names)

    def opened(over: bool) -> pa.RecordBatch:
        """The open record, if it goes over the range's ends or began before it with its beginning."""
        began = earlier if start < 0 else (of[1], start) if over else None
        return rows(pa.array(["\n".join(held)], pa.string()), began)

    of, held = None, []
    for key, lines in _stretches(batches):
        if of != key:
            if held:
                yield opened(True)
            of, n, held, inside = key, 0, [], lines.column("inside")[0].as_py()
            start, earlier = -1 if inside else 0, tuple(lines.column(c)[0].as_py() for c in ("open_range", "open_place"))
        ends = _chained(*_outs(lines), inside)
        begins = np.r_[inside, ends[:-1]]
        values, places = lines.column("value"), np.arange(n, n + len(ends))
        n, inside = n + len(ends), bool(ends[-1])
        if of[1] == 0 and places[0] == 0:  # the header
            values, places, begins = values[1:], places[1:], begins[1:]
        if not len(begins):
            continue
        starts = np.flatnonzero(~begins | (np.arange(len(begins)) == 0))
        texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.r_[starts, len(begins)], pa.int32()), values), "\n")
        if begins[0]:
            held.append(texts[0].as_py())
            texts, starts = texts[1:], starts[1:]
            if len(texts) or not inside:
                yield opened(False)
                held = []
        if inside and len(texts):
            held, start, texts = [texts[-1].as_py()], int(places[starts[-1]]), texts[:-1]
        yield rows(texts.filter(pc.not_equal(texts, "")))
    if held:
        yield opened(True)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    read = spark.read.option("lineSep", "\n").text(path)
    line = F.regexp_replace("value", r"\r\z", "")
    first = F.col("_metadata.file_block_start") == 0
    line = F.when(first, F.regexp_replace(line, "^\ufeff", "")).otherwise(line)
    named = read.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("range"), line.alias("value"))
    return named.select("*", _inside(F.col("value"), False).alias("out0"), _inside(F.col("value"), True).alias("out1"))


def _ranges(lines: DataFrame) -> DataFrame:
    """How every byte range begins: inside quotes or not, and where the record that is open there began."""
    first = F.when(F.col("range") == 0, F.col("value")).alias("first")
    ends = lines.select("file", "range", "out0", "out1", first).mapInArrow(_ends, _END)
    order = Window.partitionBy("file").orderBy("range")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    flips = F.sum((~F.col("out1") & F.col("out0")).cast("long")).over(order)
    ends = ends.withColumn("flips", flips)
    decided = F.last(F.when(F.col("out0") == F.col("out1"), F.struct("out0", "flips")), ignorenulls=True).over(before)
    ends = ends.withColumn("decided", decided).withColumn("turned", F.coalesce(F.lag("flips").over(order), F.lit(0)))
    since = F.col("turned") - F.coalesce("decided.flips", F.lit(0))
    ends = ends.withColumn("inside", F.coalesce("decided.out0", F.lit(False)) != (since % 2 == 1))
    own = F.when(F.col("inside"), F.col("first1")).otherwise(F.col("first0"))
    began = F.last(F.when(own >= 0, F.struct("range", own.alias("place"))), ignorenulls=True).over(before)
    return ends.select("file", "range", "inside", began["range"].alias("open_range"), began["place"].alias("open_place"), "header")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the CSV files at ``path`` as ``file`` and ``value``, its text; line breaks in it are ``\\n``.

    Headers and empty lines are left out; parts with another header than the
    first are an error. The rules are those of a reader that goes from the
    beginning: a quote counts where a field begins, doubled ones inside are
    text, and one in the middle of a field without quotes is text. Compressed
    files are one range each. A quoted text that is never closed takes all
    lines up to the next quote into one record, as it does in any reader.
    The records are written out once, so that what follows has many tasks
    even for a compressed file.
    """
    lines = _lines(spark, path)
    ranges = materialize(_ranges(lines), "ranges")
    headers = [r.header for r in ranges.filter(F.col("header").isNotNull()).select("header").distinct().limit(2).collect()]
    if len(headers) > 1:
        raise ValueError(f"the parts of {path} have different headers")
    # a broadcast keeps the lines in order; there are few ranges
    placed = lines.join(F.broadcast(ranges.drop("header")), ["file", "range"])
    placed = placed.select("file", "range", "value", "out0", "out1", "inside", "open_range", "open_place")
    found = materialize(placed.mapInArrow(_records, _RECORD), "records")
    whole = found.filter(F.col("of_range").isNull()).select("file", "value")
    pieces = found.filter(F.col("of_range").isNotNull()).groupBy("file", "of_range", "of_place").agg(
        F.array_sort(F.collect_list(F.struct("range", "value"))).alias("lines"))
    joined = pieces.select("file", F.array_join(F.transform("lines", lambda p: p["value"]), "\n").alias("value"))
    return whole.unionByName(joined)


def read_split(spark: SparkSession, path: str, options: dict[str, str]) -> DataFrame:
    """The text columns of CSV files with headers, read in many tasks; ``options`` are those of the CSV reader."""
    names = spark.read.options(**options).option("header", True).csv(path).columns
    schema = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
    parsed = F.from_csv("value", schema, {**options, "mode": "PERMISSIVE"})
    # from a generator: columns picked from the expression itself would parse the record once each
    return read_records(spark, path).select(F.inline(F.array(parsed)))
