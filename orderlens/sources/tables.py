"""Sources and sinks: typed CSV scans, Parquet base-table checkpoints, prediction output."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.sources import schemas
from orderlens.sources.multiline import records

HEADER_THREADS = 16


def _reader(spark: SparkSession, multiline: bool, quote_escape: str, null_value: str | None):
    reader = spark.read.option("escape", quote_escape).option("multiLine", multiline).option("mode", "PERMISSIVE")
    return reader if null_value is None else reader.option("nullValue", null_value)


def headers(spark: SparkSession, path: str | Sequence[str], **options) -> dict[tuple[str, ...], list[str]]:
    """The files of a path by their header. Only each file's first record is read, ``HEADER_THREADS``
    files at a time; files without any line are left out."""
    files = sorted(unquote(f) for f in spark.read.text(path).inputFiles())
    reader = _reader(spark, **options).option("header", True).option("inferSchema", False)
    with ThreadPoolExecutor(HEADER_THREADS) as pool:
        found = pool.map(lambda f: tuple(reader.csv(f).columns), files)
    groups: dict[tuple[str, ...], list[str]] = {}
    for file, header in zip(files, found, strict=True):
        if header:
            groups.setdefault(header, []).append(file)
    return groups


def read_text(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Sequence[str],
    multiline: bool | str = False,
    quote_escape: str = '"',
    null_value: str | None = None,
) -> DataFrame:
    """The named columns of header CSV files as text, whatever their order in each file.

    Each file is read by its own header; files with the same header are read together. A file that
    lacks a column is an error; other columns are left out. ``"`` escapes a quote inside a quoted
    field. ``multiline=True`` allows newlines inside quoted fields; then one task reads each file.
    ``multiline="split"`` reads such files by byte ranges (``sources.multiline``), for large files
    that quote as RFC 4180 says. ``null_value`` is the text that means null (default: an empty
    field, as in the source files).
    """
    if multiline not in (True, False, "split"):
        raise ValueError(f"multiline is True, False or 'split', not {multiline!r}")
    if multiline == "split" and quote_escape != '"':
        raise ValueError("files can be split only if quotes inside a field are doubled")
    options = {"multiline": bool(multiline), "quote_escape": quote_escape, "null_value": null_value}
    groups = headers(spark, path, **options)
    if not groups:
        return spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    frames = []
    for header, files in groups.items():
        missing = [c for c in columns if c not in header]
        if missing:
            raise ValueError(f"{files[0]} has no column {', '.join(missing)}; its header is {', '.join(header)}")
        text = T.StructType([T.StructField(c, T.StringType()) for c in header])
        if multiline == "split":
            parsed = {"escape": quote_escape, "mode": "PERMISSIVE"} | ({} if null_value is None else {"nullValue": null_value})
            rows = records(spark, files).where("not first")
            frame = rows.select(F.from_csv("text", ", ".join(f"`{c}` string" for c in header), parsed).alias("r")).select("r.*")
        else:
            frame = _reader(spark, **options).option("header", True).schema(text).csv(files if len(groups) > 1 else path)
        frames.append(frame.select(*[F.col(f"`{c}`") for c in columns]))
    return reduce(DataFrame.unionByName, frames)


def _typed(field: T.StructField) -> Column:
    """A text cell as the declared type; null if it can't be read. Whole numbers may be written
    with a fraction of zero."""
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.StringType):
        return c
    if isinstance(field.dataType, T.IntegralType):
        number = c.try_cast("decimal(38,18)")
        whole = F.when(number == F.floor(number), number.try_cast(field.dataType))
        return F.coalesce(c.try_cast(field.dataType), whole)
    return c.try_cast(field.dataType)


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    multiline: bool | str = False,
    quote_escape: str = '"',
    null_value: str | None = None,
) -> DataFrame:
    """Header CSV with a declared schema, matched by column name (see ``read_text``). A cell that
    can't be read as its type is null; ``rejected_cells`` counts those."""
    raw = read_text(spark, path, schema.fieldNames(), multiline, quote_escape, null_value)
    return raw.select(*[_typed(f).alias(f.name) for f in schema])


def rejected_cells(spark: SparkSession, path: str, schema: T.StructType, **options) -> DataFrame:
    """(column_name, n_rejected): cells with text that can't be read as the declared type."""
    raw = read_text(spark, path, schema.fieldNames(), **options)
    counts = [F.struct(F.lit(f.name).alias("column_name"), F.count_if(F.col(f"`{f.name}`").isNotNull() & _typed(f).isNull()).alias("n_rejected")) for f in schema]
    return raw.agg(F.array(*counts).alias("c")).select(F.inline("c"))


def read_source(spark: SparkSession, name: str, path: str, multiline: bool | str = False) -> DataFrame:
    """One of the five order tables (or its hold-out twin) by its dictionary name. ``multiline``
    (True or "split") is for files with quoted newlines only."""
    df = read_table(spark, path, schemas.SCHEMAS[name], multiline=multiline)
    if name == "orders":
        df = parse_timestamps(df, schemas.ORDER_TIMESTAMPS)
    if name == "order_reviews":
        df = parse_timestamps(df, schemas.REVIEW_TIMESTAMPS)
    return df


def parse_timestamps(df: DataFrame, cols, fmt: str = schemas.TIMESTAMP_FORMAT) -> DataFrame:
    """Text timestamps to timestamps, once; unparsable text (e.g. ``NA``) becomes null."""
    return df.withColumns({c: F.try_to_timestamp(F.col(c), F.lit(fmt)) for c in cols})


# Fixed value: the null marker of CSV files written here, so that an empty text stays "".
CSV_NULL = "\\N"


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", null_value: str = CSV_NULL, compression: str | None = None) -> None:
    """Header CSV that ``read_table(..., null_value=CSV_NULL)`` reads back unchanged: whitespace
    kept, quotes doubled, empty text quoted, null written as ``\\N``. ``null_value=""`` writes
    the source files' convention instead (an empty field is null). With ``compression="gzip"`` each file
    is read back by one task, so a file then holds what one task wrote and is not read by byte ranges."""
    (
        df.write.mode(mode)
        .option("header", True)
        .option("escape", '"')
        .option("nullValue", null_value)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path, compression=compression)
    )


def save_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Base table as Parquet: keeps types and vector columns, which CSV cannot."""
    df.write.mode(mode).parquet(path)


def load_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def save_bucketed(df: DataFrame, path: str, key: str = "order_id", buckets: int | None = None) -> DataFrame:
    """Write a table bucketed and sorted by ``key`` and return it: aggregations and joins on the key of
    tables with equally many buckets shuffle nothing. Its name in the session's catalog is new;
    ``buckets`` is the number of shuffle partitions by default."""
    spark = df.sparkSession
    name = f"bucketed_{uuid.uuid4().hex[:12]}"
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(n, key).sortBy(key).option("path", path).format("parquet").saveAsTable(name)
    return spark.table(name)


def save_predictions(
    scored: DataFrame,
    path: str,
    key: str = "order_id",
    prediction_col: str = "prediction",
    name: str = "pred_review_score",
    mode: str = "overwrite",
) -> DataFrame:
    """Write (key, prediction) to Parquet and return the written table."""
    out = scored.select(key, F.col(prediction_col).alias(name))
    out.write.mode(mode).parquet(path)
    return scored.sparkSession.read.parquet(path)
