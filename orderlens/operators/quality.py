"""Data-quality operators: profile, null counts, key checks, dedupe, incomplete and sentinel rows.

Each is one distributed job at most. Counts are aggregations (partial on the map side), never
per-column loops of separate jobs.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FLOAT_TYPES = (T.FloatType, T.DoubleType)


def _numeric(dt: T.DataType) -> bool:
    return isinstance(dt, T.NumericType)


def profile(df: DataFrame, cols: Sequence[str] | None = None, scale: int = 6) -> DataFrame:
    """One row per column: type, non-null count, mean, sample stddev, min and max.

    Numeric min/max are doubles (``min``/``max``), those of whole numbers also exact
    (``min_int``/``max_int``, as ids may lie beyond 2^53), other types' min/max are text
    (``min_text``/``max_text``). Every column is read once and no row is kept: numbers become
    (column index, number, integer) rows via ``inline``, hashed per column index with a map-side
    partial step in the same stage (fixed-width state, and a few functions keep the generated code
    compact however wide the table is); texts are one aggregate without a key, as a smallest text
    per key would have every task sort its rows.
    """
    fields = list(enumerate(f for f in df.schema.fields if cols is None or f.name in cols))
    numbers = [(i, f) for i, f in fields if _numeric(f.dataType)]
    texts = [(i, f) for i, f in fields if not _numeric(f.dataType)]
    parts = []
    if numbers:
        cells = F.array(
            *[
                F.struct(
                    F.lit(i).alias("_i"),
                    F.col(f"`{f.name}`").cast("double").alias("_x"),
                    (F.col(f"`{f.name}`") if isinstance(f.dataType, T.IntegralType) else F.lit(None)).cast("long").alias("_n"),
                )
                for i, f in numbers
            ]
        )
        parts.append(
            df.select(F.inline(cells))
            .groupBy("_i")
            .agg(
                F.count("_x").alias("count"),
                F.round(F.avg("_x"), scale).alias("mean"),
                F.round(F.stddev_samp("_x"), scale).alias("stddev"),
                F.min("_x").alias("min"),
                F.max("_x").alias("max"),
                F.min("_n").alias("min_int"),
                F.max("_n").alias("max_int"),
            )
        )
    if texts:
        as_text = {i: F.col(f"`{f.name}`").cast("string") for i, f in texts}
        state = [
            F.struct(F.lit(i).alias("_i"), F.count(t).alias("count"), F.min(t).alias("min_text"), F.max(t).alias("max_text"))
            for i, t in as_text.items()
        ]
        whole = df.agg(F.array(*state).alias("_state"), F.count(F.lit(1)).alias("_rows")).where("_rows > 0")
        parts.append(whole.select(F.inline("_state")))
    stats = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    kinds = {c: "double" for c in ("mean", "stddev", "min", "max")} | {c: "long" for c in ("min_int", "max_int")}
    kinds |= {c: "string" for c in ("min_text", "max_text")}
    stats = stats.withColumns({c: F.lit(None).cast(kind) for c, kind in kinds.items() if c not in stats.columns})
    fields = [f for _, f in fields]
    names = F.array(*[F.lit(f.name) for f in fields])
    types = F.array(*[F.lit(f.dataType.simpleString()) for f in fields])
    pos = F.col("_i") + 1
    return stats.orderBy("_i").select(
        F.element_at(names, pos).alias("column_name"),
        F.element_at(types, pos).alias("data_type"),
        "count",
        "mean",
        "stddev",
        "min",
        "max",
        "min_int",
        "max_int",
        "min_text",
        "max_text",
    )


def null_counts(df: DataFrame, nan: bool = False) -> DataFrame:
    """One row: per column, the number of nulls (and NaNs on float/double columns if ``nan``)."""
    exprs = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        cond = c.isNull()
        if nan and isinstance(f.dataType, _FLOAT_TYPES):
            cond = cond | F.isnan(c)
        exprs.append(F.count_if(cond).alias(f.name))
    return df.agg(*exprs)


def row_count(df: DataFrame, name: str = "n_rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def key_check(df: DataFrame, key: str) -> DataFrame:
    """Rows, distinct keys and null keys in one job; ``unique`` when every row has its own key."""
    out = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct(F.col(key)).alias("n_keys"),
        F.count_if(F.col(key).isNull()).alias("n_null_keys"),
    )
    return out.withColumn("unique", (F.col("n_rows") == F.col("n_keys")) & (F.col("n_null_keys") == 0))


def dedupe_rows(df: DataFrame) -> DataFrame:
    """Drop exact duplicate rows (hash aggregate with a map-side partial step)."""
    return df.dropDuplicates()


def dedupe_by_key(df: DataFrame, key: str | Sequence[str], order_by: Sequence[str], keep: str = "first") -> DataFrame:
    """One row per key: the smallest (``first``) or largest (``last``) by ``order_by``. ``first``
    prefers the copy with the fewest nulls, so that a complete copy survives an incomplete one.

    Written as ``min``/``max`` of a struct whose leading fields are the ordering columns, so it
    is an ordinary aggregation with a map-side partial step: a key holding a third of all rows
    is reduced in every map task before the shuffle, and no task ever holds a whole group.
    Ties beyond ``order_by`` are broken by the remaining columns, so the survivor is always the
    same row whatever the partitioning. Among equally complete copies nulls sort first.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    fields = list(order_by) + rest
    missing = sum((F.col(f"`{c}`").isNull().cast("int") for c in fields), F.lit(0))
    lead = [missing.alias("missing")] if keep == "first" else []
    packed = F.struct(*lead, *[F.col(f"`{c}`").alias(f"f{i}") for i, c in enumerate(fields)])
    pick = F.min(packed) if keep == "first" else F.max(packed)
    out = df.groupBy(*keys).agg(pick.alias("_row"))
    return out.select(*keys, *[F.col(f"_row.f{i}").alias(c) for i, c in enumerate(fields)]).select(
        *[F.col(f"`{c}`") for c in df.columns]
    )


def drop_incomplete(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a null (or NaN) in any of ``cols`` (all columns by default)."""
    return df.dropna(how="any", subset=list(cols) if cols else None)


def drop_sentinel(df: DataFrame, col: str, value) -> DataFrame:
    """Keep rows whose ``col`` differs from the sentinel; a null fails the test and is dropped.

    A text sentinel can never equal a numeric key, so on a numeric column only nulls go (and no
    cast of the sentinel is attempted, which ANSI mode would reject).
    """
    c = F.col(f"`{col}`")
    if isinstance(value, str) and not isinstance(df.schema[col].dataType, T.StringType):
        return df.where(c.isNotNull())
    return df.where(c != F.lit(value))

