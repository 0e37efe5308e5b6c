"""Records of CSV files with quoted line breaks, read by many tasks.

Such a file can't be cut at any line end: a line break inside quotes does not end a record. But the
number of quotes before a place tells: it is odd inside a quoted field (a quote inside a field is
doubled and leaves the parity alone). So the file is read as lines, in byte ranges:

1. the quotes of every range are counted, and a running sum over a file's ranges tells whether a range
   begins inside a quoted field: one row per range;
2. each range is read again from its known state and cut at its true record ends. What is open at its
   ends is a piece of a record that other ranges go on with; there are at most two pieces per range,
   which are put together by their order.

The result is written once, as both the records and the pieces are taken from it. Lines end with a
line feed (a carriage return before it belongs to the line end at the end of a record). As in RFC 4180,
a quote may stand in quoted fields only; files that don't keep to this need the whole-file reader.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderlens.session import scratch_path


def _lines(spark: SparkSession, files: list[str]) -> DataFrame:
    """file, start (of the byte range) and line, in file order within a task."""
    text = spark.read.option("lineSep", "\n").text(files)
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value").alias("line"))


def open_ranges(lines: DataFrame) -> DataFrame:
    """file, start, quotes, open: whether each byte range begins inside a quoted field."""
    quotes = F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit("")))
    ranges = lines.groupBy("file", "start").agg(F.sum(quotes).alias("quotes"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    return ranges.withColumn("open", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1)


_PIECES = "file string, start long, part int, whole boolean, first boolean, text string"


class _Cut:
    """One byte range, cut into records and pieces of records, line by line."""

    def __init__(self, file: str, start: int, is_open: bool):
        self.file, self.start = file, start
        self.inside = self.is_open = is_open  # inside: in the record that the range begins with
        self.lines: list[str] = []
        self.first = start == 0 and not is_open

    def row(self, part: int, whole: bool) -> tuple:
        out = (self.file, self.start, part, whole, self.first and part > 0, "\n".join(self.lines))
        self.lines, self.first = [], self.first and part == 0
        return out

    def add(self, line: str) -> tuple | None:
        self.lines.append(line)
        if line.count('"') % 2:
            self.is_open = not self.is_open
        if self.is_open:
            return None
        part, self.inside = (0 if self.inside else 1), False
        return self.row(part, part == 1)

    def end(self) -> tuple | None:
        return self.row(0 if self.inside else 1, False) if self.lines else None


def _pieces(lines: DataFrame, opened: set[tuple[str, int]], known: set[tuple[str, int]]) -> DataFrame:
    sent = lines.sparkSession.sparkContext.broadcast((opened, known))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, known = sent.value
        cut, rows = None, []

        def batch() -> pa.RecordBatch:
            cols = list(zip(*rows, strict=True)) or [()] * 6
            kinds = (pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.bool_(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["file", "start", "part", "whole", "first", "text"])

        for b in batches:
            for file, start, line in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if cut is None or (cut.file, cut.start) != (file, start):
                    if cut is not None and (last := cut.end()):
                        rows.append(last)
                    if (file, start) not in known:
                        raise RuntimeError(f"{file}: the byte ranges changed between two scans")
                    cut = _Cut(file, start, (file, start) in opened)
                if (row := cut.add(line)) is not None:
                    rows.append(row)
            yield batch()
            rows = []
        if cut is not None and (last := cut.end()):
            rows.append(last)
        yield batch()

    return lines.mapInArrow(run, _PIECES)


def records(spark: SparkSession, files: list[str]) -> DataFrame:
    """file, first (it is its file's header) and text of every record; empty records are left out."""
    lines = _lines(spark, files)
    ranges = open_ranges(lines).toArrow().to_pylist()  # one row per byte range
    known = {(r["file"], r["start"]) for r in ranges}
    path = scratch_path(spark, "records")
    _pieces(lines, {(r["file"], r["start"]) for r in ranges if r["open"]}, known).write.parquet(path)
    cut = spark.read.schema(_PIECES).parquet(path)
    # pieces of one record: an open end of a range, whole ranges, and the begin of a last one
    pieces = cut.where("not whole")
    opens = F.sum(F.col("part")).over(Window.partitionBy("file").orderBy("start", "part"))
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("start", "part", "text"))), lambda x: x["text"]), "\n")
    pieces = pieces.withColumn("record", opens).groupBy("file", "record").agg(F.max("first").alias("first"), joined.alias("text"))
    out = cut.where("whole").select("file", "first", "text").unionByName(pieces.select("file", "first", "text"))
    return out.withColumn("text", F.regexp_replace("text", "\r$", "")).where("text <> ''")
