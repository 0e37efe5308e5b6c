"""The five order tables as views over the driver's TPC-H-like Parquet tables.

products <- part, orders/reviews <- orders, order_items/order_payments <- lineitem. Hold-out is
``order_id % 5 = 0``, training the rest. Every view is a projection of a scan, so filters and
column pruning reach the Parquet reader.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.session import configure

# The hold-out rule and the minute offsets that turn an order date into the
# five order timestamps.
HOLDOUT_MODULUS = 5
MINUTES_PER_DAY = 1440
ESTIMATED_DELIVERY_MINUTES = 14400
# The product categories of the driver's part table, in order.
CATEGORIES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _plus_minutes(ts: Column, minutes: Column) -> Column:
    return ts + F.make_dt_interval(F.lit(0), F.lit(0), minutes.cast("int"), F.lit(0))


def products(spark: SparkSession, sf_dir: str, src: DataFrame | None = None) -> DataFrame:
    p = raw(spark, sf_dir, "part") if src is None else src
    return p.select(
        F.col("p_partkey").alias("product_id"),
        (F.col("p_partkey") % 70).cast("int").alias("product_name_lenght"),
        (F.col("p_size") * 50).cast("int").alias("product_description_lenght"),
        (F.col("p_size") % 20 + 1).cast("int").alias("product_photos_qty"),
        (F.col("p_partkey") % 5000).cast("int").alias("product_weight_g"),
        F.col("p_size").cast("int").alias("product_length_cm"),
        (F.col("p_size") + 10).cast("int").alias("product_height_cm"),
        (F.col("p_size") * 2).cast("int").alias("product_width_cm"),
        F.col("p_type").alias("product_category_name"),
    )


def orders(spark: SparkSession, sf_dir: str, src: DataFrame | None = None) -> DataFrame:
    o = raw(spark, sf_dir, "orders") if src is None else src
    k = F.col("o_orderkey")
    purchase = _plus_minutes(F.col("o_orderdate"), k % MINUTES_PER_DAY)
    approved = _plus_minutes(purchase, k * 7 % 2880)
    carrier = _plus_minutes(approved, k * 11 % 5760)
    delivered = F.when(F.col("o_orderstatus") != "P", _plus_minutes(carrier, k * 13 % 14400))
    estimated = _plus_minutes(purchase, F.lit(ESTIMATED_DELIVERY_MINUTES))
    return o.select(
        k.alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderstatus").alias("order_status"),
        purchase.alias("order_purchase_timestamp"),
        approved.alias("order_approved_at"),
        carrier.alias("order_delivered_carrier_date"),
        delivered.alias("order_delivered_customer_date"),
        estimated.alias("order_estimated_delivery_date"),
    )


def order_items(spark: SparkSession, sf_dir: str, src: DataFrame | None = None) -> DataFrame:
    li = raw(spark, sf_dir, "lineitem") if src is None else src
    return li.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").alias("shipping_cost"),
    )


def order_payments(spark: SparkSession, sf_dir: str, src: DataFrame | None = None) -> DataFrame:
    li = raw(spark, sf_dir, "lineitem") if src is None else src
    return li.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("payment_sequential"),
        F.col("l_returnflag").alias("payment_type"),
        (F.col("l_quantity").cast("int") % 4 + 1).alias("payment_installments"),
        F.col("l_extendedprice").alias("payment_value"),
    )


def order_reviews(spark: SparkSession, sf_dir: str, src: DataFrame | None = None) -> DataFrame:
    o = raw(spark, sf_dir, "orders") if src is None else src
    return o.select(
        F.col("o_orderkey").alias("review_id"),
        F.col("o_orderkey").alias("order_id"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("review_score"),
    )


VIEWS = {
    "products": products,
    "orders": orders,
    "order_items": order_items,
    "order_payments": order_payments,
    "order_reviews": order_reviews,
}
SOURCES = {
    "products": "part",
    "orders": "orders",
    "order_items": "lineitem",
    "order_payments": "lineitem",
    "order_reviews": "orders",
}


def is_holdout(order_id: Column) -> Column:
    return order_id % HOLDOUT_MODULUS == 0


def side(df: DataFrame, which: str) -> DataFrame:
    """Training (``train``) or hold-out (``holdout``) rows of an order-keyed view."""
    if which == "all":
        return df
    flag = is_holdout(F.col("order_id"))
    return df.where(flag if which == "holdout" else ~flag)


def scans(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """One scan per raw file, shared by every view (each file is listed and its footer read once)."""
    configure(spark)
    return {t: raw(spark, sf_dir, t) for t in sorted(set(SOURCES.values()))}


def tables(spark: SparkSession, sf_dir: str, which: str = "train", shared: dict | None = None) -> dict[str, DataFrame]:
    """The five tables for one side; products are shared by both sides."""
    src = shared if shared is not None else scans(spark, sf_dir)
    out = {name: build(spark, sf_dir, src[SOURCES[name]]) for name, build in VIEWS.items()}
    for name in ("orders", "order_items", "order_payments", "order_reviews"):
        out[name] = side(out[name], which)
    if which == "holdout":
        out.pop("order_reviews")
    return out

