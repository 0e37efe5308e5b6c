"""Plan shape checks: what reaches the Parquet scan, where the shuffles are, and that
aggregations reduce before they shuffle. Broadcast and AQE are switched off inside a test to
see the plan a large input would get."""

from __future__ import annotations

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from conftest import SF01
from orderlens.operators import basetable, quality, rollup, screen
from orderlens.sources import fixtures

SPEC = basetable.BaseTableSpec(payment_types=("A", "N", "R"), categories=("ECONOMY", "LARGE"))


def plan(df, mode="formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


@contextlib.contextmanager
def large_plan(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_payment_filter_and_columns_reach_the_scan(spark):
    t = fixtures.tables(spark, SF01, "train")
    text = plan(basetable.payment_features(t["order_payments"], SPEC))
    assert "Not(EqualTo(l_returnflag,not_defined))" in text
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert "l_tax" not in schema and "l_shipdate" not in schema and "l_returnflag" in schema


def test_item_rollup_reduces_before_the_product_join(spark):
    t = fixtures.tables(spark, SF01, "train")
    with large_plan(spark):
        text = plan(basetable.item_rollup(t["order_items"], t["products"]), "simple")
    lines = text.splitlines()
    join = next(i for i, l in enumerate(lines) if "SortMergeJoin" in l and "LeftOuter" in l)
    pair_shuffle = next(i for i, l in enumerate(lines) if re.search(r"hashpartitioning\(order_id#\d+L?, product_id", l))
    order_shuffle = next(i for i, l in enumerate(lines) if re.search(r"Exchange hashpartitioning\(order_id#\d+L?, \d+\)", l))
    # printed top-down: order shuffle above the join, (order, product) shuffle below it
    assert order_shuffle < join < pair_shuffle
    assert any("HashAggregate" in l for l in lines[pair_shuffle:])  # partial step before the pair shuffle


def test_base_table_joins_reuse_order_partitioning(spark):
    t = fixtures.tables(spark, SF01, "train")
    with large_plan(spark):
        text = plan(basetable.build_basetable(t, SPEC), "simple")
    keys = [re.sub(r"#\d+L?", "", k) for k in re.findall(r"Exchange hashpartitioning\(([^)]*), \d+\)", text)]
    # four per-order sides meet in three joins without further shuffles: one order_id shuffle
    # each (item rollup, payments, orders dedupe, reviews); the rest are the item rollup's
    # (order, product) and product shuffles, products' key dedupe and the two row dedupes
    assert keys.count("order_id") == 4
    assert keys.count("product_id") == 2 and keys.count("order_id, product_id") == 1
    assert len(keys) == 9
    assert len(re.findall(r"SortMergeJoin", text)) == 4


def test_screen_pairs_are_not_shuffled(spark):
    t = fixtures.tables(spark, SF01, "train")
    base = basetable.build_basetable(t, SPEC).cache()
    try:
        base.count()
        text = plan(screen.pearson_screen(base, screen.candidate_features(base, "Target"), "Target"), "simple")
    finally:
        base.unpersist()
    lines = text.splitlines()
    gen = next(i for i, l in enumerate(lines) if "Generate inline" in l)
    shuffle = next(i for i, l in enumerate(lines) if re.search(r"Exchange hashpartitioning\(_i#", l))
    # top-down: feature shuffle, then the partial aggregate, then the generator, with no
    # exchange between the generator and the partial aggregate
    assert shuffle < gen
    assert any("HashAggregate" in l for l in lines[shuffle + 1 : gen])
    assert not any("Exchange" in l for l in lines[shuffle + 1 : gen])


@pytest.mark.parametrize("op", ["dedupe", "profile"])
def test_one_row_reductions_have_partial_steps(spark, op):
    items = fixtures.order_items(spark, SF01)
    df = quality.dedupe_by_key(items, "order_id", ["order_item_id", "product_id"]) if op == "dedupe" else quality.profile(items)
    text = plan(df, "simple")
    # a struct of the row and the least text are no fixed-width buffers: both aggregate by sorting
    assert re.search(r"SortAggregate\(key=\[[^\]]*\], functions=\[partial_", text)


def test_sums_and_counts_hash(spark):
    text = plan(rollup.order_money_rollup(fixtures.order_items(spark, SF01).drop("product_id").withColumn("product_id", F.lit(1))), "simple")
    assert re.search(r"HashAggregate\(keys=\[[^\]]*\], functions=\[partial_", text) and "SortAggregate" not in text
