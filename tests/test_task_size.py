"""What one task holds does not follow the rows: profile, wide pivot, CSV records."""

from __future__ import annotations

import glob

from pyspark.sql import functions as F

from orderlens.operators import quality, rollup
from orderlens.plans import catalog
from orderlens.session import checkpoint_root


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_profile_sorts_no_rows(spark):
    df = spark.createDataFrame([(1, "b", 2.5, None), (3, "a", None, True), (None, None, 0.5, False)], "k long, `t.x` string, d double, f boolean")
    out = quality.profile(df)
    assert "SortAggregate(key=[_i" not in _plan(out)
    rows = {r.column_name: r for r in out.collect()}
    assert [r.column_name for r in out.collect()] == ["k", "t.x", "d", "f"]
    assert (rows["k"]["count"], rows["k"].mean, rows["k"].min, rows["k"].max_int, rows["k"].min_text) == (2, 2.0, 1.0, 3, None)
    assert (rows["t.x"]["count"], rows["t.x"].min_text, rows["t.x"].max_text, rows["t.x"].mean) == (2, "a", "b", None)
    assert (rows["d"]["count"], rows["d"].max, rows["d"].max_int) == (2, 2.5, None)
    assert (rows["f"].min_text, rows["f"].max_text) == ("false", "true")
    assert quality.profile(df.limit(0)).count() == 0
    assert quality.profile(df, ["t.x"]).schema == out.schema and quality.profile(df, ["t.x"]).count() == 1
    assert quality.profile(df, ["d"]).schema == out.schema


def test_wide_pivot_gathers_cells_and_not_rows_of_columns(spark):
    rows = [(1, "0", 1.5), (1, "0", 2.0), (1, "19", 3.0), (2, None, 4.0), (3, "other", 5.0), (4, "7", None), (None, "7", 6.0)]
    df = spark.createDataFrame(rows, "order_id long, n string, price double")
    values = [str(i) for i in range(20)]
    out = rollup.pivot_sum(df, "order_id", "n", "price", values)
    assert "pivotfirst" not in _plan(out)
    plain = df.groupBy("order_id").agg(*[F.coalesce(F.sum(F.when(F.col("n") == v, F.col("price"))), F.lit(0.0)).alias(v) for v in values])
    as_set = lambda frame: {tuple(r) for r in frame.collect()}
    assert as_set(out) == as_set(plain) and out.columns == plain.columns
    counts = rollup.pivot_count(df, "order_id", "n", values, [f"c{v}" for v in values])
    assert "pivotfirst" not in _plan(counts) and counts.columns[1] == "c0"
    assert {r.order_id: (r.c0, r.c7, r.c19) for r in counts.collect()} == {1: (2, 0, 1), 2: (0, 0, 0), 3: (0, 0, 0), 4: (0, 1, 0), None: (0, 1, 0)}


def test_split_records_are_written_by_as_many_tasks_as_read(spark, tmp_path):
    docs = spark.range(50).select("id", F.concat(F.lit('a "q"\nb '), F.col("id").cast("string")).alias("text"))
    docs = docs.select(F.col("id").alias("doc_id"), "text", F.lit("en").alias("lang"), F.lit("s").alias("source"), F.length("text").cast("long").alias("n_chars"))
    docs.repartition(6).write.parquet(f"{tmp_path}/documents.parquet")
    pattern = f"{checkpoint_root(spark).removeprefix('file:')}/csv-multiline-*"
    before = set(glob.glob(pattern))
    out = catalog.csv_multiline_split(spark, str(tmp_path))
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, docs.collect()))
    (folder,) = set(glob.glob(pattern)) - before
    assert len(glob.glob(f"{folder}/*.csv")) > 2
