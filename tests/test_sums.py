"""Exact sums past the range of one long, small values, and pivots with one shuffle."""

from __future__ import annotations

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from orderlens.operators import rollup


def _items(spark, rows):
    return spark.createDataFrame(rows, "order_id long, order_item_id int, product_id string, price double, shipping_cost double")


def test_a_hot_order_past_the_range_of_millionths(spark):
    rows = [(1, i, f"p{i % 3}", 3e12 + 0.000001, 0.25) for i in range(400)] + [(2, 1, "p", 1.5, 0.5), (3, 1, "p", float("nan"), 1.0)]
    out = {r.order_id: r for r in rollup.order_money_rollup(_items(spark, rows).repartition(7)).collect()}
    assert out[1].total_price == float(Fraction(400) * (Fraction(3 * 10**12) + Fraction(round((3e12 + 0.000001) % 1 * 10**6), 10**6)))
    assert out[1].total_price >= 1.2e15 and out[1].total_cost == out[1].total_price + 100
    assert (out[2].total_price, out[2].total_cost) == (1.5, 2.0)
    assert math.isnan(out[3].total_price) and out[3].total_shipping_cost == 1.0
    pays = spark.range(0, 1000, 1, 5).select(F.lit(1).alias("order_id"), F.lit("card").alias("t"), F.lit(1e12).alias("v"))
    assert rollup.pivot_sum(pays, "order_id", "t", "v", ["card", "none"]).first() == (1, 1e15, 0.0)


def test_sums_are_the_nearest_double_of_the_exact_total(spark):
    rng = random.Random(3)
    values = [rng.choice([-1, 1]) * round(rng.random() * 10 ** rng.randint(0, 9), rng.randint(0, 6)) for _ in range(3000)]
    df = spark.createDataFrame([(i % 4, v) for i, v in enumerate(values)], "k int, v double").repartition(5)
    got = {r.k: r.s for r in df.groupBy("k").agg(rollup.exact_sum(F.col("v")).alias("s")).collect()}
    for k in range(4):
        exact = sum(Fraction(round(Fraction(v) * 10**6), 10**6) for v in values[k::4])
        assert got[k] == float(exact)
    twice = df.groupBy("k").agg(rollup.exact_sum(F.col("v"), F.lit(2)).alias("s")).collect()
    assert {r.k: r.s for r in twice} == {k: 2 * v for k, v in got.items()}


def test_rounded_cells_are_counted(spark):
    df = spark.createDataFrame([(0.1, 4e-7), (2.5, 1.0), (None, 1e-6), (float("nan"), 0.0000015)], "a double, b double")
    assert {r.column_name: r.n_rounded for r in rollup.rounded_cells(df, ["a", "b"]).collect()} == {"a": 0, "b": 2}


@pytest.mark.parametrize("few", [True, False])
def test_short_pivots_shuffle_once_and_equal_long_ones(spark, few, monkeypatch):
    monkeypatch.setattr(rollup, "FEW_VALUES", 16 if few else 0)
    rows = [(i % 7, ["a", "b", None, "c"][i % 4], float(i) / 8 if i % 5 else None) for i in range(200)]
    df = spark.createDataFrame(rows, "k int, t string, v double").repartition(3)
    sums = rollup.pivot_sum(df, "k", "t", "v", ["a", "b", "zz"], ["A", "B", "Z"])
    counts = rollup.pivot_count(df, "k", "t", ["a", "b", "zz"])
    for k in range(7):
        own = [r for r in rows if r[0] == k]
        assert sums.where(f"k = {k}").first() == (k, *[sum(r[2] or 0 for r in own if r[1] == t) for t in ("a", "b")], 0.0)
        assert counts.where(f"k = {k}").first() == (k, *[sum(r[1] == t for r in own) for t in ("a", "b")], 0)
    plan = sums._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == (1 if few else 2)
    assert sums.columns == ["k", "A", "B", "Z"]
