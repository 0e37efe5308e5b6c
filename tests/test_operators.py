"""Operators on small hand-made rows: nulls, NaN, sentinels, zero divisors, rounding edges,
day numbering, bin edges, CSV quoting, dedupe determinism."""

from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from orderlens.functions import derive
from orderlens.operators import basetable, quality, rollup
from orderlens.session import scratch_path
from orderlens.sources import schemas, tables


def test_safe_ratio_null_on_zero(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (1.0, 3.0), (0.0, 0.0)], "a double, b double")
    got = [r[0] for r in df.select(derive.safe_ratio("a", "b")).collect()]
    assert got == [None, None, 0.33, None]


def test_round_half_up_on_decimal_text(spark):
    # 1.005 is stored as 1.00499999...; the source's engine rounds the printed value half-up.
    df = spark.createDataFrame([(1005,), (1004,), (1015,), (0,)], "g int")
    assert [r[0] for r in df.select(derive.to_kg("g")).collect()] == [1.01, 1.0, 1.02, 0.0]


def test_volume_rounds_exact_halves_up(spark):
    # 15000 cm^3 = 0.015 m^3 exactly -> 0.02
    df = spark.createDataFrame([(10, 15, 100), (1, 1, 1)], "l int, h int, w int")
    assert [r[0] for r in df.select(derive.volume_m3("l", "h", "w")).collect()] == [0.02, 0.0]


def test_hours_between_negative_and_null(spark):
    t0 = dt.datetime(2024, 1, 1, 0, 0, 0)
    rows = [(t0, t0 + dt.timedelta(minutes=90)), (t0 + dt.timedelta(hours=2), t0), (None, t0)]
    df = spark.createDataFrame(rows, "a timestamp, b timestamp")
    got = [r[0] for r in df.select(derive.hours_between("a", "b")).collect()]
    assert got == [-1.5, 2.0, None]


def test_weekend_flags(spark):
    # 2024-01-05 is a Friday, 01-06 Saturday, 01-07 Sunday, 01-08 Monday.
    days = [dt.datetime(2024, 1, d) for d in (5, 6, 7, 8)] + [None]
    df = spark.createDataFrame([(d,) for d in days], "t timestamp")
    source = [r[0] for r in df.select(derive.weekend_flag("t", derive.SOURCE_WEEKEND_DAYS)).collect()]
    true = [r[0] for r in df.select(derive.weekend_flag("t")).collect()]
    assert source == [1, 1, 0, 0, 0]  # Friday and Saturday, as the source computes it
    assert true == [0, 1, 1, 0, 0]


def test_bins_edges_go_low_and_null_goes_last(spark):
    df = spark.createDataFrame([(5.0,), (5.0001,), (15.0,), (15.5,), (None,)], "m double")
    got = [r[0] for r in df.select(derive.bin3("m", 5, 15, ("lo", "mid", "hi"))).collect()]
    assert got == ["lo", "mid", "mid", "hi", "hi"]


def test_binary_target_tolerates_text(spark):
    df = spark.createDataFrame([("5",), ("4",), ("3",), ("NA",), (None,)], "s string")
    assert [r[0] for r in df.select(derive.binary_target("s")).collect()] == [1, 1, 0, 0, 0]


def test_null_and_nan_counts(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), None), (None, "c")], "x double, s string")
    plain = quality.null_counts(df).collect()[0].asDict()
    nan = quality.null_counts(df, nan=True).collect()[0].asDict()
    assert plain == {"x": 1, "s": 1}
    assert nan == {"x": 2, "s": 1}


def test_sentinel_filter_text_and_numeric(spark):
    s = spark.createDataFrame([("NA",), ("1",), (None,)], "order_id string")
    assert sorted(r[0] for r in quality.drop_sentinel(s, "order_id", "NA").collect()) == ["1"]
    n = spark.createDataFrame([(1,), (None,)], "order_id long")
    assert [r[0] for r in quality.drop_sentinel(n, "order_id", "NA").collect()] == [1]


def test_drop_incomplete_drops_nan(spark):
    df = spark.createDataFrame([(1.0, 1), (float("nan"), 2), (None, 3)], "x double, k int")
    assert [r.k for r in quality.drop_incomplete(df).collect()] == [1]


def test_key_check(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    r = quality.key_check(df, "k").collect()[0]
    assert (r.n_rows, r.n_keys, r.n_null_keys, r.unique) == (4, 2, 1, False)


def test_dedupe_by_key_is_deterministic_under_repartition(spark):
    rows = [(1, 3, "b", 1.0), (1, 1, "z", 2.0), (1, 1, "a", 3.0), (2, 5, "q", 4.0), (2, 5, "q", 5.0)]
    df = spark.createDataFrame(rows, "k int, item int, pid string, v double")
    want = sorted(quality.dedupe_by_key(df, "k", ["item", "pid"]).collect())
    for n in (1, 3, 7):
        assert sorted(quality.dedupe_by_key(df.repartition(n), "k", ["item", "pid"]).collect()) == want
    assert want[0].asDict() == {"k": 1, "item": 1, "pid": "a", "v": 3.0}
    assert want[1].v == 4.0  # full-row tie broken by the remaining columns
    last = sorted(quality.dedupe_by_key(df, "k", ["item", "pid"], keep="last").collect())
    assert last[0].pid == "b" and last[1].v == 5.0


def test_profile_one_row_per_column(spark):
    df = spark.createDataFrame([(1, "a"), (3, "b"), (None, "c")], "x int, s string")
    got = {r.column_name: r for r in quality.profile(df).collect()}
    assert got["x"]["count"] == 2 and got["x"].mean == 2.0 and got["x"].stddev == round(math.sqrt(2), 6)
    assert got["x"]["min"] == 1.0 and got["x"]["max"] == 3.0 and got["x"].data_type == "int"
    assert got["s"].min_text == "a" and got["s"].max_text == "c" and got["s"].mean is None


def test_pivot_columns_follow_value_list(spark):
    df = spark.createDataFrame([(1, "A", 1.25), (1, "A", 2.5), (2, "Z", 1.0)], "order_id int, t string, v double")
    out = rollup.pivot_sum(df, "order_id", "t", "v", ["A", "B"])
    assert out.columns == ["order_id", "A", "B"]
    assert sorted(tuple(r) for r in out.collect()) == [(1, 3.75, 0.0), (2, 0.0, 0.0)]
    counts = rollup.pivot_count(df, "order_id", "t", ["A", "Z"])
    assert sorted(tuple(r) for r in counts.collect()) == [(1, 2, 0), (2, 0, 1)]


def test_value_lists_follow_sparks_pivot_limit(spark):
    df = spark.range(1500).withColumn("c", F.col("id").cast("string"))
    assert len(rollup.distinct_values(df, "c")) == 1500
    a = spark.createDataFrame([("x",), ("y",), ("x",), (None,)], "c string")
    b = spark.range(3).withColumn("c", F.col("id"))
    assert rollup.distinct_value_lists({"a": (a, "c"), "b": (b, "c")}) == {"a": ["x", "y"], "b": ["0", "1", "2"]}
    spark.conf.set("spark.sql.pivotMaxValues", 2)
    try:
        assert rollup.distinct_values(a, "c") == ["x", "y"]
        with pytest.raises(ValueError):
            rollup.distinct_value_lists({"a": (a, "c"), "b": (b, "c")})
    finally:
        spark.conf.unset("spark.sql.pivotMaxValues")


def test_wide_pivot(spark):
    df = spark.range(4500).select((F.col("id") % 3).alias("k"), (F.col("id") % 1500).cast("string").alias("c"), F.lit(0.5).alias("v"))
    values = rollup.distinct_values(df, "c")
    row = rollup.pivot_sum(df, "k", "c", "v", values).where("k = 1").first()
    assert len(row) == 1501 and sum(row[1:]) == 750.0
    assert rollup.pivot_sum(df, "k", "c", "v", []).columns == ["k"]


def test_sums_keep_small_values_and_nan(spark):
    rows = [(1, 0.004), (1, 0.004), (1, 0.004), (2, float("nan")), (2, 1.0), (3, None), (4, -2.5), (4, 1e300), (5, 9e11), (5, 0.01)]
    df = spark.createDataFrame(rows, "k int, v double")
    got = {r.k: r.s for r in df.groupBy("k").agg(rollup.exact_sum(F.col("v")).alias("s")).collect()}
    assert got[1] == 0.012 and math.isnan(got[2]) and got[3] is None and math.isnan(got[4]) and got[5] == 9e11 + 0.01


def test_volume_of_large_whole_sizes(spark):
    df = spark.createDataFrame([(1300, 1300, 1300)], "a int, b int, c int")
    assert df.select(derive.volume_m3("a", "b", "c")).first()[0] == 2197.0


def test_dedupe_keeps_the_complete_copy(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, 5, "b"), (2, None, "x"), (2, None, "w")], "k int, v int, s string")
    got = sorted(tuple(r) for r in quality.dedupe_by_key(df, "k", ["v", "s"]).collect())
    assert got == [(1, 5, "b"), (2, None, "w")]


def test_profile_of_large_whole_numbers(spark):
    df = spark.createDataFrame([(2**53 + 1,), (2**60 + 1,)], "id long")
    r = quality.profile(df).first()
    assert (r.min_int, r.max_int) == (2**53 + 1, 2**60 + 1)


def test_names_from_data_never_clash():
    spec = basetable.BaseTableSpec(("voucher", "total_price", "Toys"), ("voucher", "toys", "Target"))
    names = basetable.feature_columns(spec)
    assert len({n.lower() for n in names}) == len(names)
    assert spec.payment_columns() == ["voucher", "payment:total_price", "Toys"]
    assert spec.category_columns() == ["category:voucher", "category:toys", "category:Target"]


def test_latest_review_ignores_text_that_is_no_time(spark):
    rows = [("r1", "o", "5", None, "2018-05-01 00:00:00"), ("r2", "o", "1", None, "NA"), ("r0", "o", "2", None, "2018-04-01 00:00:00")]
    got = basetable.review_features(spark.createDataFrame(rows, schemas.ORDER_REVIEWS)).first()
    assert (got.review_id, got.review_score, got.Target) == ("r1", 5.0, 1.0)


def test_csv_columns_by_name_and_rejected_cells(spark):
    path = scratch_path(spark, "test-names")
    rows = [("toys", "40.0", "p1", "x", "1500"), ("audio", "many", "p2", "y", None)]
    spark.createDataFrame(rows, "product_category_name string, product_description_lenght string, product_id string, more string, product_weight_g string").write.option("header", True).csv(path)
    schema = schemas.T.StructType([f for f in schemas.PRODUCTS if f.name in ("product_id", "product_weight_g", "product_description_lenght", "product_category_name")])
    got = {r.product_id: r for r in tables.read_table(spark, path, schema).collect()}
    assert (got["p1"].product_category_name, got["p1"].product_description_lenght, got["p1"].product_weight_g) == ("toys", 40.0, 1500.0)
    assert got["p2"].product_description_lenght is None
    bad = {r.column_name: r.n_rejected for r in tables.rejected_cells(spark, path, schema).collect()}
    assert bad["product_description_lenght"] == 1 and sum(bad.values()) == 1
    with pytest.raises(ValueError, match="product_photos_qty"):
        tables.read_table(spark, path, schemas.PRODUCTS)


def test_money_sums_are_exact(spark):
    # 0.1 + 0.2 in doubles is 0.30000000000000004; summed as millionths it is 0.3.
    df = spark.createDataFrame([(1, 0.1, 0.2, 1, "p")] * 1 + [(1, 0.2, 0.1, 2, "q")], "order_id int, price double, shipping_cost double, order_item_id int, product_id string")
    r = rollup.order_money_rollup(df).collect()[0]
    assert (r.total_price, r.total_shipping_cost, r.total_cost) == (0.3, 0.3, 0.6)
    assert r["shipping_cost%"] == 0.5 and r.num_unique_products_per_id == 2 and r.max_order_item_id == 2


def test_shape_rollup_grain_property(spark):
    """Repeating every item row k times multiplies sums by k; means and ratios stay."""
    prods = spark.createDataFrame(
        [("p1", 10.0, 100.0, 2.0, 1500.0, 10.0, 20.0, 30.0, "x"), ("p2", 30.0, 900.0, 4.0, 250.0, 5.0, 5.0, 5.0, "y")],
        schemas.PRODUCTS,
    )
    clean = basetable.clean_products(prods)
    items = spark.createDataFrame([("o", 1.0, "p1", 1.0, 1.0), ("o", 2.0, "p2", 2.0, 2.0)], schemas.ORDER_ITEMS)
    rows = items.join(clean, "product_id")
    once = rollup.order_shape_rollup(rows).collect()[0].asDict()
    reps = spark.createDataFrame([("o", 3)], "order_id string, _repeat long")
    thrice = rollup.order_shape_rollup(rows, repeats=reps).collect()[0].asDict()
    fanned = rollup.order_shape_rollup(rows.crossJoin(spark.range(3)).drop("id")).collect()[0].asDict()
    assert thrice == fanned
    for k in ("ttl_name", "ttl_photo", "ttl_description"):
        assert thrice[k] == 3 * once[k]
    for k in ("mean_name", "mean_photo", "mean_description", "aspect_ratio_length_width", "weight_volume"):
        assert thrice[k] == once[k]


def test_csv_roundtrip_quotes_newlines_spaces(spark):
    rows = [(1, 'he said "hi"\nbye'), (2, "  padded  "), (3, ""), (4, None), (5, "a,b\r\nc")]
    df = spark.createDataFrame(rows, "id long, text string")
    path = scratch_path(spark, "test-csv")
    tables.write_csv(df, path)
    back = tables.read_table(spark, path, df.schema, multiline=True, null_value=tables.CSV_NULL)
    assert sorted(back.collect()) == sorted(df.collect())


def test_read_source_parses_timestamps(spark):
    path = scratch_path(spark, "test-orders")
    spark.createDataFrame(
        [("o1", "c1", "delivered", "2024-01-01 10:00:00", "2024-01-01 11:30:00", "NA", None, "2024-01-10 00:00:00")],
        schemas.ORDERS,
    ).write.option("header", True).csv(path)
    o = tables.read_source(spark, "orders", path)
    r = o.collect()[0]
    assert r.order_purchase_timestamp == dt.datetime(2024, 1, 1, 10, 0)
    assert r.order_delivered_carrier_date is None
    feats = basetable.clean_orders(o).collect()[0]
    assert feats.approve_efficiency == 1.5 and feats.package_efficiency is None
