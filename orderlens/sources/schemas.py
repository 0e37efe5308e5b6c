"""Declared schemas of the five order tables (their data dictionary).

Declaring the schema replaces ``inferSchema`` (an extra full pass over every file) and makes
train and hold-out files load with identical types. Every number is a double: the files write
whole numbers as ``40`` or ``40.0``.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Table and column names as the source files spell them (including
# "lenght"), and the text format of the order timestamps.
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
ORDER_TIMESTAMPS = (
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
)

PRODUCTS = T.StructType(
    [
        T.StructField("product_id", T.StringType()),
        T.StructField("product_name_lenght", T.DoubleType()),
        T.StructField("product_description_lenght", T.DoubleType()),
        T.StructField("product_photos_qty", T.DoubleType()),
        T.StructField("product_weight_g", T.DoubleType()),
        T.StructField("product_length_cm", T.DoubleType()),
        T.StructField("product_height_cm", T.DoubleType()),
        T.StructField("product_width_cm", T.DoubleType()),
        T.StructField("product_category_name", T.StringType()),
    ]
)

# Orders and reviews arrive as text; timestamps are parsed once.
ORDERS = T.StructType(
    [
        T.StructField("order_id", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("order_status", T.StringType()),
    ]
    + [T.StructField(name, T.StringType()) for name in ORDER_TIMESTAMPS]
)

ORDER_ITEMS = T.StructType(
    [
        T.StructField("order_id", T.StringType()),
        T.StructField("order_item_id", T.DoubleType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("shipping_cost", T.DoubleType()),
    ]
)

ORDER_PAYMENTS = T.StructType(
    [
        T.StructField("order_id", T.StringType()),
        T.StructField("payment_sequential", T.DoubleType()),
        T.StructField("payment_type", T.StringType()),
        T.StructField("payment_installments", T.DoubleType()),
        T.StructField("payment_value", T.DoubleType()),
    ]
)

ORDER_REVIEWS = T.StructType(
    [
        T.StructField("review_id", T.StringType()),
        T.StructField("order_id", T.StringType()),
        T.StructField("review_score", T.StringType()),
        T.StructField("review_creation_date", T.StringType()),
        T.StructField("review_answer_timestamp", T.StringType()),
    ]
)

REVIEW_TIMESTAMPS = ("review_creation_date", "review_answer_timestamp")

SCHEMAS = {
    "products": PRODUCTS,
    "orders": ORDERS,
    "order_items": ORDER_ITEMS,
    "order_payments": ORDER_PAYMENTS,
    "order_reviews": ORDER_REVIEWS,
}
