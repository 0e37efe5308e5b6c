"""The base table: one deterministic row per order, features plus (on the training side) label.

Plan shape (the point of this module): every input is first reduced to one row per
``order_id`` (items+products, payments, reviews) or is already one (orders), so every join
between them is 1:1 on the same key. All per-order aggregations hash-partition on
``order_id``, so the joins that follow reuse that partitioning instead of shuffling again,
and no join can fan out (items x payments x reviews in the source multiplied rows and sums).

Training and hold-out go through the same functions; the pivot value lists are learned on
the training side (``fit_spec``) and reused for the hold-out.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.functions import derive
from orderlens.operators import quality, rollup
from orderlens.sources import tables

KEY = "order_id"

# The source's sentinels.
ORDER_ID_SENTINEL = "NA"
PAYMENT_TYPE_SENTINEL = "not_defined"

ORDER_FEATURES = (
    "weekend_delivered",
    "approve_efficiency",
    "package_efficiency",
    "delivery_efficiency",
    "on_time",
    "total_delivery_time",
)

# Every column of the base table whose name does not come from the data.
FIXED_COLUMNS = (
    (KEY, "product_id", "customer_id", "review_id", "review_score", "Target", "product_category_name")
    + rollup.MONEY_COLUMNS
    + rollup.SHAPE_COLUMNS
    + ORDER_FEATURES
    + ("pay_with_installment", "shipping_cost/kg", "_rep_weight_kg")
    + tuple(derive.BINS)
)


@dataclass(frozen=True)
class BaseTableSpec:
    """What the training side fixes for both sides."""

    payment_types: tuple = ()
    categories: tuple = ()
    weekend_days: tuple = derive.WEEKEND_DAYS

    def payment_columns(self) -> list[str]:
        """Column of each payment type: its name, prefixed if a fixed column has that name."""
        return _named(self.payment_types, "payment", set(FIXED_COLUMNS))

    def category_columns(self) -> list[str]:
        """Column of each category: its name, prefixed if a fixed or payment column has that name."""
        return _named(self.categories, "category", set(FIXED_COLUMNS) | set(self.payment_columns()))


def _named(values: Sequence[str], prefix: str, taken: set[str]) -> list[str]:
    taken, out = {t.lower() for t in taken}, []
    for v in values:
        name = str(v)
        while name.lower() in taken:
            name = f"{prefix}:{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def clean_products(products: DataFrame) -> DataFrame:
    """Sizes to metres, volume in m^3 and weight in kg (both rounded to 2 decimals)."""
    df = products.withColumns(
        {
            "Prod_volume_m3": derive.volume_m3("product_length_cm", "product_height_cm", "product_width_cm"),
            "weight_kg": derive.to_kg("product_weight_g"),
        }
    ).drop("product_weight_g")
    return derive.to_metres(df, ["product_length_cm", "product_height_cm", "product_width_cm"])


def clean_orders(orders: DataFrame, weekend_days: Sequence[int] = derive.WEEKEND_DAYS) -> DataFrame:
    """Order features: weekend delivery flag and five hour gaps; sentinel ids removed."""
    o = quality.drop_sentinel(orders, KEY, ORDER_ID_SENTINEL)
    hb = derive.hours_between
    return o.select(
        KEY,
        "customer_id",
        derive.weekend_flag("order_delivered_customer_date", weekend_days).cast("double").alias("weekend_delivered"),
        hb("order_approved_at", "order_purchase_timestamp").alias("approve_efficiency"),
        hb("order_delivered_carrier_date", "order_approved_at").alias("package_efficiency"),
        hb("order_delivered_customer_date", "order_delivered_carrier_date").alias("delivery_efficiency"),
        hb("order_estimated_delivery_date", "order_delivered_customer_date").alias("on_time"),
        hb("order_delivered_customer_date", "order_purchase_timestamp").alias("total_delivery_time"),
    )


def item_rollup(items: DataFrame, products: DataFrame) -> DataFrame:
    """Money and product-shape rollups of an order's items in one two-level aggregation, plus the
    order's representative item (lowest ``order_item_id``, then ``product_id``).

    Products are left-joined so that money totals cover every item, as in the source (its
    money rollup ran before the product join), while shape statistics cover the items whose
    product is known. Orders with no known product are dropped, as the source's inner join
    dropped them. See ``rollup.order_item_rollup`` for the plan.
    """
    agg = rollup.order_item_rollup(items, clean_products(products))
    return agg.where(F.col("_n_known") > 0).select(
        KEY,
        F.col("_rep.product_id").alias("product_id"),
        F.col("_rep.product_category_name").alias("product_category_name"),
        F.col("_rep.weight_kg").alias("_rep_weight_kg"),
        *[F.col(f"`{c}`") for c in rollup.MONEY_COLUMNS + rollup.SHAPE_COLUMNS],
    )


def payment_features(payments: DataFrame, spec: BaseTableSpec) -> DataFrame:
    """Per order: paid amount per payment type (0 when absent) and whether any payment used
    instalments; ``not_defined`` payments are removed on both sides. One aggregation."""
    p = quality.drop_sentinel(payments, "payment_type", PAYMENT_TYPE_SENTINEL)
    paid = lambda t: F.when(F.col("payment_type").cast("string") == F.lit(t), F.col("payment_value"))
    sums = [
        F.coalesce(rollup.exact_sum(paid(t)), F.lit(0.0)).alias(name)
        for t, name in zip(spec.payment_types, spec.payment_columns(), strict=True)
    ]
    flag = F.max(derive.threshold_flag("payment_installments")).alias("pay_with_installment")
    return p.groupBy(KEY).agg(*sums, flag)


def review_features(reviews: DataFrame) -> DataFrame:
    """Per order: the latest review (by answer time when present, then review id), its score
    and the binary target (score >= 4). An answer time that is no time (such as ``NA``) is
    earlier than any other."""
    order_by = [c for c in ("review_answer_timestamp", "review_id") if c in reviews.columns]
    r = reviews.select(KEY, *order_by, "review_score")
    if "review_answer_timestamp" in order_by and isinstance(r.schema["review_answer_timestamp"].dataType, T.StringType):
        r = tables.parse_timestamps(r, ["review_answer_timestamp"])
    if "review_id" not in order_by:
        r = r.withColumn("review_id", F.lit(None).cast("string"))
    latest = quality.dedupe_by_key(r, KEY, order_by, keep="last")
    return latest.select(
        KEY,
        "review_id",
        F.col("review_score").try_cast("double").alias("review_score"),
        derive.binary_target("review_score").cast("double").alias("Target"),
    )


def fit_spec(train: dict[str, DataFrame], weekend_days: Sequence[int] = derive.WEEKEND_DAYS) -> BaseTableSpec:
    """Pivot value lists from the training side: payment types from the training payments
    (``not_defined`` excluded), categories from the training product catalogue."""
    pays = quality.drop_sentinel(train["order_payments"], "payment_type", PAYMENT_TYPE_SENTINEL)
    lists = rollup.distinct_value_lists(
        {"payment_type": (pays, "payment_type"), "category": (train["products"], "product_category_name")}
    )
    return BaseTableSpec(
        payment_types=tuple(lists["payment_type"]),
        categories=tuple(lists["category"]),
        weekend_days=tuple(weekend_days),
    )


KEYED_TABLES = {"products": "product_id", "orders": KEY}
ROW_TABLES = ("order_items", "order_payments")


def dedupe_inputs(t: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Duplicates removed from every input (the source meant to, but discarded the result).

    Products and orders keep one row per key (the most complete, then the smallest by their
    other columns, so the choice is deterministic); the result is already partitioned on the key the next join
    uses, so this costs no extra shuffle. Items and payments have no reliable key and lose
    exact duplicate rows only (one more shuffle each). Reviews are reduced to one per order by
    ``review_features``. Every dedupe aggregates map-side first, so a heavily copied row is
    reduced inside each task before anything is shuffled.
    """
    out = {}
    for name, df in t.items():
        if name in KEYED_TABLES:
            key = KEYED_TABLES[name]
            out[name] = quality.dedupe_by_key(df, key, [c for c in df.columns if c != key])
        elif name in ROW_TABLES:
            out[name] = quality.dedupe_rows(df)
        else:
            out[name] = df
    return out


def joined_orders(t: dict[str, DataFrame], spec: BaseTableSpec, dedupe: bool = True) -> DataFrame:
    """All per-order pieces joined 1:1 on ``order_id`` (reviews only when given), with the
    representative item's ``shipping_cost/kg``."""
    if dedupe:
        t = dedupe_inputs(t)
    items = item_rollup(t["order_items"], t["products"])
    pays = payment_features(t["order_payments"], spec)
    orders = clean_orders(t["orders"], spec.weekend_days)
    base = items.join(pays, KEY).join(orders, KEY)
    if "order_reviews" in t:
        base = base.join(review_features(t["order_reviews"]), KEY)
    keep = [F.col(f"`{c}`") for c in base.columns if c != "_rep_weight_kg"]
    ratio = derive.safe_ratio("total_shipping_cost", "_rep_weight_kg").alias("shipping_cost/kg")
    return base.select(*keep, ratio)


def feature_columns(spec: BaseTableSpec) -> list[str]:
    return (
        list(rollup.MONEY_COLUMNS)
        + spec.payment_columns()
        + ["pay_with_installment"]
        + list(ORDER_FEATURES)
        + ["shipping_cost/kg"]
        + list(rollup.SHAPE_COLUMNS)
        + spec.category_columns()
    )


def build_basetable(t: dict[str, DataFrame], spec: BaseTableSpec, dedupe: bool = True) -> DataFrame:
    """One row per order: ids, label (if reviews are given), features, bins and category dummies.

    Inputs are first cleared of duplicates (``dedupe``, see ``dedupe_inputs``). Incomplete
    orders (a null anywhere, e.g. undelivered orders or zero weights) are dropped; then one
    projection adds the three bins and the dummies of the representative item's category and
    casts the features to double (the table already has one row per order, so no shuffle; one
    projection rather than several keeps the driver from re-analysing the plan per step).
    """
    base = quality.drop_incomplete(joined_orders(t, spec, dedupe))
    ids = [KEY, "product_id", "customer_id"]
    label = ["review_id", "review_score", "Target"] if "order_reviews" in t else []
    category = F.col("product_category_name").cast("string")
    dummies = {
        name: F.when(category == F.lit(c), 1.0).otherwise(0.0)
        for c, name in zip(spec.categories, spec.category_columns(), strict=True)
    }
    feats = [
        dummies[c].alias(c) if c in dummies else F.col(f"`{c}`").cast("double").alias(c) for c in feature_columns(spec)
    ]
    bins = [derive.bin3(src, lo, hi, labels).alias(name) for name, (src, lo, hi, labels) in derive.BINS.items()]
    return base.select(*ids, *label, *feats, "product_category_name", *bins)
