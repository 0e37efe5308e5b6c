"""Small helpers shared by the operators of this subpackage.

Rows are handed to Python in Arrow batches (``mapInArrow``). Every function here looks at a
bounded slice of a batch at a time, so a worker's memory follows the longest text and not the
partition.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.session import scratch_path

#: Bytes that may separate words: space, tab, line feed, vertical tab, form feed, carriage return.
WORD_BYTES = re.compile(rb"[^\x20\x09-\x0D]+")
SLICE_ROWS = 256
SLICE_BYTES = 8 << 20


def fresh(columns: list[str], base: str) -> str:
    """A column name that clashes with none of ``columns`` (Spark compares without case)."""
    taken, name, n = {c.lower() for c in columns}, base, 0
    while name.lower() in taken:
        n += 1
        name = f"{base}_{n}"
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a frame as Parquet under the shared checkpoint folder and read it back: computed once,
    smaller than a checkpoint, and safe from lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch], text: int = 1, rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """Cut batches to at most ``rows`` rows and, beyond one row, about SLICE_BYTES of column ``text``."""
    for batch in batches:
        start, n = 0, batch.num_rows
        while start < n:
            size = min(rows, n - start)
            while size > 1 and batch.column(text).slice(start, size).nbytes > SLICE_BYTES:
                size = (size + 1) // 2
            yield batch.slice(start, size)
            start += size


def lower_ascii(text: str | None) -> bytes:
    """The text's UTF-8 bytes with A-Z lower-cased and nothing else changed; null is empty."""
    return text.encode("utf-8").lower() if text else b""


def text_hash(text: str) -> Column:
    """64-bit hash of a text that also tells null from empty."""
    return F.xxhash64(F.col(text).isNull(), F.col(text))


def id_order(column: str) -> Column:
    """Sort key of an id: numbers ascending, null last."""
    return F.struct(F.col(column).isNull().alias("is_null"), F.col(column).alias("id"))
