"""DuckDB SQL twins of the registered queries (the correctness oracle).

The driver's tables are pre-registered as views in DuckDB; the five order tables are rebuilt
here as CTEs with the same rules as ``orderlens.sources.fixtures``.

Engine differences handled here (checked on both engines):
- Spark's ``round`` rounds the shortest decimal text of a double half-up; DuckDB rounds the
  binary value. ``sround`` reproduces Spark's rule through the text form.
- DuckDB ``dayofweek`` is Sun=0..Sat=6, Spark's Sun=1..Sat=7.
- DuckDB integer sums are HUGEINT; they are cast to BIGINT like Spark's.
- Money is summed as DECIMAL(18,2) here and as whole millionths in Spark, then turned into DOUBLE; both are
  exact for the two-decimal values of the tables.
"""

from __future__ import annotations

# The pivot value lists of the fixture data (payment types are lineitem return
# flags, categories are part types), the training-side rule and the split threshold.
PAYMENT_TYPES = ("A", "N", "R")
CATEGORIES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
TRAIN = "order_id % 5 <> 0"
HOLDOUT = "order_id % 5 = 0"
SOURCE_WEEKEND = (6, 7)
TRUE_WEEKEND = (1, 7)


def q(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def sround(expr: str, d: int = 2) -> str:
    """Spark's ``round(double, d)``: half-up on the shortest decimal text of the value."""
    return f"CAST(round(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38,28)), {d}) AS DOUBLE)"


def ddiv(num: str, den: str) -> str:
    """``try_divide`` of two values as doubles: null on a zero divisor."""
    return f"(CAST(({num}) AS DOUBLE) / NULLIF(CAST(({den}) AS DOUBLE), 0))"


def money(expr: str) -> str:
    return f"sum(CAST(({expr}) AS DECIMAL(18,2)))"


def hours(end: str, start: str) -> str:
    return sround(f"CAST(floor(epoch({end})) - floor(epoch({start})) AS DOUBLE) / 3600", 2)


def weekend(ts: str, days) -> str:
    return f"CASE WHEN dayofweek({ts}) + 1 IN ({', '.join(str(d) for d in days)}) THEN 1 ELSE 0 END"


# ---------------------------------------------------------------- fixture views
F_PRODUCTS = """f_products AS (
  SELECT p_partkey AS product_id,
         CAST(p_partkey % 70 AS INTEGER) AS product_name_lenght,
         CAST(p_size * 50 AS INTEGER) AS product_description_lenght,
         CAST(p_size % 20 + 1 AS INTEGER) AS product_photos_qty,
         CAST(p_partkey % 5000 AS INTEGER) AS product_weight_g,
         CAST(p_size AS INTEGER) AS product_length_cm,
         CAST(p_size + 10 AS INTEGER) AS product_height_cm,
         CAST(p_size * 2 AS INTEGER) AS product_width_cm,
         p_type AS product_category_name
  FROM part)"""

F_ORDERS = """f_orders AS (
  SELECT order_id, customer_id, order_status, order_purchase_timestamp, order_approved_at,
         order_delivered_carrier_date,
         CASE WHEN order_status <> 'P'
              THEN order_delivered_carrier_date + to_minutes(order_id * 13 % 14400) END
           AS order_delivered_customer_date,
         order_purchase_timestamp + to_minutes(14400) AS order_estimated_delivery_date
  FROM (SELECT *, order_approved_at + to_minutes(order_id * 11 % 5760) AS order_delivered_carrier_date
        FROM (SELECT *, order_purchase_timestamp + to_minutes(order_id * 7 % 2880) AS order_approved_at
              FROM (SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS order_status,
                           o_orderdate + to_minutes(o_orderkey % 1440) AS order_purchase_timestamp
                    FROM orders))))"""

F_ITEMS = """f_items AS (
  SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
         l_extendedprice AS price, l_quantity AS shipping_cost
  FROM lineitem)"""

F_PAYMENTS = """f_payments AS (
  SELECT l_orderkey AS order_id, l_linenumber AS payment_sequential, l_returnflag AS payment_type,
         CAST(trunc(l_quantity) AS INTEGER) % 4 + 1 AS payment_installments,
         l_extendedprice AS payment_value
  FROM lineitem)"""

F_REVIEWS = """f_reviews AS (
  SELECT o_orderkey AS review_id, o_orderkey AS order_id,
         CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS review_score
  FROM orders)"""

def c_products(name: str = "c_products", src: str = "f_products") -> str:
    return f"""{name} AS (
  SELECT product_id, product_name_lenght, product_description_lenght, product_photos_qty,
         product_category_name,
         {sround("CAST(product_length_cm AS DOUBLE) * product_height_cm * product_width_cm / 1e6", 2)} AS Prod_volume_m3,
         {sround("CAST(product_weight_g AS DOUBLE) / 1000", 2)} AS weight_kg,
         CAST(product_length_cm AS DOUBLE) / 100 AS product_length,
         CAST(product_height_cm AS DOUBLE) / 100 AS product_height,
         CAST(product_width_cm AS DOUBLE) / 100 AS product_width
  FROM {src})"""


C_PRODUCTS = c_products()

FIXTURES = [F_PRODUCTS, F_ORDERS, F_ITEMS, F_PAYMENTS, F_REVIEWS, C_PRODUCTS]


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(list(FIXTURES) + list(ctes)) + "\n"


def c_orders(days=TRUE_WEEKEND, where: str = "TRUE", src: str = "f_orders") -> str:
    return f"""c_orders AS (
  SELECT order_id, customer_id,
         CAST({weekend('order_delivered_customer_date', days)} AS DOUBLE) AS weekend_delivered,
         {hours('order_approved_at', 'order_purchase_timestamp')} AS approve_efficiency,
         {hours('order_delivered_carrier_date', 'order_approved_at')} AS package_efficiency,
         {hours('order_delivered_customer_date', 'order_delivered_carrier_date')} AS delivery_efficiency,
         {hours('order_estimated_delivery_date', 'order_delivered_customer_date')} AS on_time,
         {hours('order_delivered_customer_date', 'order_purchase_timestamp')} AS total_delivery_time
  FROM {src} WHERE order_id IS NOT NULL AND {where})"""


def money_select() -> str:
    p, s = money("price"), money("shipping_cost")
    return f"""CAST({p} AS DOUBLE) AS total_price,
         CAST({s} AS DOUBLE) AS total_shipping_cost,
         CAST({p} + {s} AS DOUBLE) AS total_cost,
         {sround(ddiv(s, f"{p} + {s}"), 2)} AS "shipping_cost%",
         max(order_item_id) AS max_order_item_id,
         count(DISTINCT product_id) AS num_unique_products_per_id"""


def shape_select(mult: str = "1") -> str:
    """Shape rollup; ``mult`` scales the sums (the source's fan-out grain)."""
    w, v = money("weight_kg"), money("Prod_volume_m3")
    ln, h, wd = money("product_length"), money("product_height"), money("product_width")
    ph, de, nm = "sum(product_photos_qty)", "sum(product_description_lenght)", "sum(product_name_lenght)"
    return f"""CAST({w} * {mult} AS DOUBLE) AS ttl_weight,
         CAST({nm} * {mult} AS BIGINT) AS ttl_name,
         CAST({v} * {mult} AS DOUBLE) AS ttl_volume,
         CAST({ph} * {mult} AS BIGINT) AS ttl_photo,
         CAST({de} * {mult} AS BIGINT) AS ttl_description,
         avg(product_name_lenght) AS mean_name,
         avg(product_photos_qty) AS mean_photo,
         avg(product_description_lenght) AS mean_description,
         {ddiv(w, v)} AS weight_volume,
         {sround(ddiv(ln, wd), 2)} AS aspect_ratio_length_width,
         {sround(ddiv(h, wd), 2)} AS aspect_ratio_height_width,
         {sround(ddiv(ph, de), 2)} AS photo_description_ratio"""


MONEY_COLS = [
    "total_price",
    "total_shipping_cost",
    "total_cost",
    "shipping_cost%",
    "max_order_item_id",
    "num_unique_products_per_id",
]
SHAPE_COLS = [
    "ttl_weight",
    "ttl_name",
    "ttl_volume",
    "ttl_photo",
    "ttl_description",
    "mean_name",
    "mean_photo",
    "mean_description",
    "weight_volume",
    "aspect_ratio_length_width",
    "aspect_ratio_height_width",
    "photo_description_ratio",
]
ORDER_COLS = [
    "weekend_delivered",
    "approve_efficiency",
    "package_efficiency",
    "delivery_efficiency",
    "on_time",
    "total_delivery_time",
]
BINS = {
    "nbr_photo": ("mean_photo", 5, 15, ("Minimal", "Moderate", "Abundant")),
    "name_length": ("mean_name", 20, 50, ("Short name", "Medium name", "Long name")),
    "description_length": (
        "mean_description",
        500,
        1500,
        ("Short description", "Medium description", "Long description"),
    ),
}


def bin_case(src: str, lo, hi, labels) -> str:
    a, b, c = labels
    return f"CASE WHEN {src} <= {lo} THEN '{a}' WHEN {src} <= {hi} THEN '{b}' ELSE '{c}' END"


def feature_cols() -> list[str]:
    return (
        MONEY_COLS
        + list(PAYMENT_TYPES)
        + ["pay_with_installment"]
        + ORDER_COLS
        + ["shipping_cost/kg"]
        + SHAPE_COLS
        + list(CATEGORIES)
    )


def _one_per_key(name: str, src: str, key: str, cols: list[str]) -> str:
    missing = " + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in cols)
    order = ", ".join([missing, *(f"{c} NULLS FIRST" for c in cols)])
    return f"""{name} AS (
  SELECT * FROM {src} QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {order}) = 1)"""


# Inputs of the base table cleared of duplicates, as ``basetable.dedupe_inputs`` does it.
def d_orders(src: str = "f_orders") -> str:
    return _one_per_key("d_orders", src, "order_id", [
        "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at",
        "order_delivered_carrier_date", "order_delivered_customer_date", "order_estimated_delivery_date",
    ])


def d_products(src: str = "f_products") -> str:
    return _one_per_key("d_products", src, "product_id", [
        "product_name_lenght", "product_description_lenght", "product_photos_qty", "product_weight_g",
        "product_length_cm", "product_height_cm", "product_width_cm", "product_category_name",
    ])


FIXTURE_SOURCES = {
    "products": "f_products",
    "orders": "f_orders",
    "items": "f_items",
    "payments": "f_payments",
    "reviews": "f_reviews",
}


def basetable_ctes(side: str, labelled: bool, days=TRUE_WEEKEND, src: dict = FIXTURE_SOURCES) -> list[str]:
    """CTEs ending in ``base``: the base table of one side, as ``build_basetable`` makes it."""
    pay_cols = ",\n         ".join(
        f"COALESCE(CAST({money('payment_value')} FILTER (WHERE payment_type = '{t}') AS DOUBLE), 0.0) AS {q(t)}"
        for t in PAYMENT_TYPES
    )
    ctes = [
        d_orders(src["orders"]),
        d_products(src["products"]),
        c_products("dc_products", "d_products"),
        c_orders(days, side, "d_orders"),
        f"""j_items AS (
  SELECT i.order_id, i.order_item_id, i.product_id, i.price, i.shipping_cost,
         p.product_name_lenght, p.product_description_lenght, p.product_photos_qty,
         p.product_category_name, p.Prod_volume_m3, p.weight_kg,
         p.product_length, p.product_height, p.product_width,
         p.product_id IS NOT NULL AS known
  FROM (SELECT DISTINCT * FROM {src["items"]} WHERE {side}) i
       LEFT JOIN dc_products p ON i.product_id = p.product_id)""",
        f"""r_items AS (
  SELECT order_id, {money_select()},
         {shape_select()},
         count(*) FILTER (WHERE known) AS n_known
  FROM j_items GROUP BY order_id)""",
        """rep AS (
  SELECT order_id, product_id, weight_kg, product_category_name FROM j_items WHERE known
  QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY order_item_id, product_id) = 1)""",
        f"""r_pay AS (
  SELECT order_id, {pay_cols},
         max(CAST(payment_installments > 1 AS DOUBLE)) AS pay_with_installment
  FROM (SELECT DISTINCT * FROM {src["payments"]}) WHERE payment_type <> 'not_defined' AND {side}
  GROUP BY order_id)""",
    ]
    if labelled:
        ctes.append(
            f"""r_rev AS (
  SELECT order_id, review_id, CAST(review_score AS DOUBLE) AS review_score,
         CAST(CASE WHEN review_score >= 4 THEN 1 ELSE 0 END AS DOUBLE) AS Target
  FROM {src["reviews"]} WHERE {side}
  QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY review_id DESC) = 1)"""
        )
    label_sel = "v.review_id, v.review_score, v.Target," if labelled else ""
    label_join = "JOIN r_rev v ON v.order_id = r.order_id" if labelled else ""
    sel = [f"r.{q(c)}" for c in MONEY_COLS + SHAPE_COLS]
    joined_cols = (
        ["order_id", "product_id", "customer_id"]
        + (["review_id", "review_score", "Target"] if labelled else [])
        + MONEY_COLS
        + list(PAYMENT_TYPES)
        + ["pay_with_installment"]
        + ORDER_COLS
        + ["shipping_cost/kg"]
        + SHAPE_COLS
        + ["product_category_name"]
    )
    not_null = " AND ".join(f"{q(c)} IS NOT NULL" for c in joined_cols)
    ctes.append(
        f"""joined AS (
  SELECT r.order_id, rep.product_id, o.customer_id, {label_sel}
         {', '.join(sel)},
         {', '.join('p.' + q(t) for t in PAYMENT_TYPES)}, p.pay_with_installment,
         {', '.join('o.' + c for c in ORDER_COLS)},
         {sround(ddiv('r.total_shipping_cost', 'rep.weight_kg'), 2)} AS "shipping_cost/kg",
         rep.product_category_name
  FROM r_items r JOIN rep ON rep.order_id = r.order_id
       JOIN r_pay p ON p.order_id = r.order_id
       JOIN c_orders o ON o.order_id = r.order_id
       {label_join}
  WHERE r.n_known > 0)"""
    )
    bins = ",\n         ".join(f"{bin_case(*spec)} AS {name}" for name, spec in BINS.items())
    dummies = ",\n         ".join(
        f"CAST(CASE WHEN product_category_name = '{c}' THEN 1 ELSE 0 END AS DOUBLE) AS {q(c)}" for c in CATEGORIES
    )
    casts = ",\n         ".join(
        f"CAST({q(c)} AS DOUBLE) AS {q(c)}" for c in MONEY_COLS + list(PAYMENT_TYPES) + ["pay_with_installment"]
        + ORDER_COLS + ["shipping_cost/kg"] + SHAPE_COLS
    )
    label_cols = "review_id, review_score, Target," if labelled else ""
    ctes.append(
        f"""base AS (
  SELECT order_id, product_id, customer_id, {label_cols}
         {casts},
         {dummies},
         product_category_name,
         {bins}
  FROM joined WHERE {not_null})"""
    )
    return ctes


TEXT_SOURCES = {
    "products": "t_products",
    "orders": "t_orders",
    "items": "t_items",
    "payments": "t_payments",
    "reviews": "t_reviews",
}
TEXT_CTES = [
    """t_products AS (SELECT * REPLACE (CAST(product_id AS VARCHAR) AS product_id) FROM f_products)""",
    f"""t_orders AS (SELECT * REPLACE (CAST(order_id AS VARCHAR) AS order_id, CAST(customer_id AS VARCHAR) AS customer_id)
  FROM f_orders)""",
    f"""t_items AS (SELECT * REPLACE (CAST(order_id AS VARCHAR) AS order_id, CAST(product_id AS VARCHAR) AS product_id)
  FROM f_items)""",
    f"""t_payments AS (SELECT * REPLACE (CAST(order_id AS VARCHAR) AS order_id) FROM f_payments)""",
    f"""t_reviews AS (SELECT * REPLACE (CAST(review_id AS VARCHAR) AS review_id, CAST(order_id AS VARCHAR) AS order_id)
  FROM f_reviews)""",
]


def _both_sides(ctes: list[str] | tuple = (), src: dict = FIXTURE_SOURCES, key: str = "order_id", select: str = "SELECT * FROM base") -> str:
    """Training and hold-out base tables in one result, told apart by ``side``."""
    train = with_(*ctes, *basetable_ctes(TRAIN.replace("order_id", key), True, src=src)) + select
    holdout = with_(*ctes, *basetable_ctes(HOLDOUT.replace("order_id", key), False, src=src)) + select
    return f"SELECT *, 'train' AS side FROM ({train})\nUNION ALL BY NAME\nSELECT *, 'holdout' AS side FROM ({holdout})"


def basetable_sql(side: str = TRAIN, labelled: bool = True, select: str = "SELECT * FROM base") -> str:
    return with_(*basetable_ctes(side, labelled)) + select


# ---------------------------------------------------------------- per-query SQL
def _profile_products() -> str:
    cols = [
        ("product_id", "bigint"),
        ("product_name_lenght", "int"),
        ("product_description_lenght", "int"),
        ("product_photos_qty", "int"),
        ("product_weight_g", "int"),
        ("product_length_cm", "int"),
        ("product_height_cm", "int"),
        ("product_width_cm", "int"),
        ("product_category_name", "string"),
    ]
    parts = []
    for c, t in cols:
        if t == "string":
            parts.append(
                f"SELECT '{c}' AS column_name, '{t}' AS data_type, count({c}) AS count, "
                f"CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS stddev, "
                f"CAST(NULL AS DOUBLE) AS min, CAST(NULL AS DOUBLE) AS max, "
                f"CAST(NULL AS BIGINT) AS min_int, CAST(NULL AS BIGINT) AS max_int, "
                f"CAST(min({c}) AS VARCHAR) AS min_text, CAST(max({c}) AS VARCHAR) AS max_text FROM f_products"
            )
        else:
            parts.append(
                f"SELECT '{c}' AS column_name, '{t}' AS data_type, count({c}) AS count, "
                f"{sround(f'avg({c})', 6)} AS mean, {sround(f'stddev_samp({c})', 6)} AS stddev, "
                f"CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, "
                f"CAST(min({c}) AS BIGINT) AS min_int, CAST(max({c}) AS BIGINT) AS max_int, "
                f"CAST(NULL AS VARCHAR) AS min_text, CAST(NULL AS VARCHAR) AS max_text FROM f_products"
            )
    return with_() + "\nUNION ALL\n".join(parts)


def _null_counts(table: str, cols: list[tuple[str, bool]], ctes=()) -> str:
    sel = ", ".join(
        f"count(*) FILTER (WHERE {q(c)} IS NULL{' OR isnan(' + q(c) + ')' if nan else ''}) AS {q(c)}" for c, nan in cols
    )
    return with_(*ctes) + f"SELECT {sel} FROM {table}"


ORDER_VIEW_COLS = [
    "order_id",
    "customer_id",
    "order_status",
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
]


def _key_check(table: str, key: str) -> str:
    return (
        f"SELECT '{table[2:]}' AS table_name, count(*) AS n_rows, count(DISTINCT {key}) AS n_keys, "
        f"count(*) FILTER (WHERE {key} IS NULL) AS n_null_keys, "
        f"(count(*) = count(DISTINCT {key}) AND count(*) FILTER (WHERE {key} IS NULL) = 0) AS \"unique\" "
        f"FROM {table}"
    )


def _shape_rollup_items() -> str:
    return (
        with_()
        + f"""SELECT i.order_id, {shape_select()}
FROM f_items i JOIN c_products p ON i.product_id = p.product_id
GROUP BY i.order_id"""
    )


def _shape_fanout() -> str:
    # The source's grain, literally: every item row repeated for each payment and review row of its order.
    return (
        with_()
        + f"""SELECT i.order_id, {shape_select()}
FROM f_items i JOIN f_payments pay ON pay.order_id = i.order_id
     JOIN f_reviews rev ON rev.order_id = i.order_id
     JOIN c_products p ON i.product_id = p.product_id
GROUP BY i.order_id"""
    )


BIN_SOURCES = {
    "mean_photo": "product_photos_qty",
    "mean_name": "product_name_lenght",
    "mean_description": "product_description_lenght",
}


def _bins(name: str) -> str:
    src, lo, hi, labels = BINS[name]
    return with_() + (
        f"SELECT order_id, {src}, {bin_case(src, lo, hi, labels)} AS {name} FROM ("
        f"SELECT i.order_id, avg(p.{BIN_SOURCES[src]}) AS {src} "
        f"FROM f_items i JOIN c_products p ON i.product_id = p.product_id GROUP BY i.order_id)"
    )


LABELLED_DOCS = """scored AS (
  SELECT CAST(l.quality AS DOUBLE) AS label, ln(1 + CAST(d.n_chars AS DOUBLE)) AS score,
         CAST(ln(1 + CAST(d.n_chars AS DOUBLE)) > 7 AS DOUBLE) AS prediction
  FROM labels l JOIN documents d ON d.doc_id = l.doc_id)"""

AUC_SQL = f"""WITH {LABELLED_DOCS},
ranked AS (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS r FROM scored),
agg AS (SELECT sum(r) FILTER (WHERE label = 1) AS rs, count(*) FILTER (WHERE label = 1) AS npos,
               count(*) FILTER (WHERE label = 0) AS nneg FROM ranked)
SELECT {sround('(rs - npos * (npos + 1) / 2.0) / (npos * nneg)', 9)} AS auc FROM agg"""

CLASSIFICATION_SQL = f"""WITH {LABELLED_DOCS},
n AS (SELECT count(*) AS total FROM scored),
cls AS (SELECT c AS cls FROM (SELECT label AS c FROM scored UNION SELECT prediction FROM scored)),
per AS (
  SELECT cls,
         (SELECT count(*) FROM scored WHERE label = cls) AS n_true,
         (SELECT count(*) FROM scored WHERE prediction = cls) AS n_pred,
         (SELECT count(*) FROM scored WHERE label = cls AND prediction = cls) AS tp
  FROM cls),
m AS (
  SELECT cls, n_true, tp,
         CASE WHEN n_pred = 0 THEN 0.0 ELSE tp / n_pred END AS prec,
         CASE WHEN n_true = 0 THEN 0.0 ELSE tp / n_true END AS rec
  FROM per)
SELECT {sround('sum(n_true * prec) / max(total)', 9)} AS weighted_precision,
       {sround('sum(n_true * rec) / max(total)', 9)} AS weighted_recall,
       {sround('sum(n_true * CASE WHEN prec + rec = 0 THEN 0.0 ELSE 2 * prec * rec / (prec + rec) END) / max(total)', 9)} AS f1,
       {sround('sum(tp) / max(total)', 9)} AS accuracy
FROM m, n"""


def split_expr(key: str = "order_id", fraction: int = 70) -> str:
    return f"(CAST(('0x' || substr(md5(CAST({key} AS VARCHAR)), 1, 8)) AS BIGINT) % 100 < {fraction})"


def hash_slice(start: int, key: str = "order_id") -> str:
    return f"CAST(('0x' || substr(md5(CAST({key} AS VARCHAR)), {start}, 8)) AS BIGINT)"


NOISE = f"({hash_slice(17)} % 8 = 0)"
NOISY_WEEKEND = f"(CASE WHEN {NOISE} THEN 1 - weekend_delivered ELSE weekend_delivered END)"


def _pearson(label: str, features: list[str], extra_select: str = "", extra_features=()) -> str:
    feats = list(features) + list(extra_features)
    parts = [
        f"SELECT '{f}' AS feature, count({q(f)}) FILTER (WHERE {label} IS NOT NULL) AS n, "
        f"{sround(f'CASE WHEN stddev_samp({q(f)}) = 0 OR stddev_samp({label}) = 0 THEN NULL ELSE corr({q(f)}, {label}) END', 9)} AS r "
        f"FROM b2"
        for f in feats
    ]
    return basetable_sql(select=f", b2 AS (SELECT *{extra_select} FROM base)\n" + "\nUNION ALL\n".join(parts))


def _moments() -> str:
    def r(f, label):
        return sround(f"CASE WHEN stddev_samp({q(f)}) = 0 OR stddev_samp({label}) = 0 THEN NULL ELSE corr({q(f)}, {label}) END", 9)

    parts = [
        f"SELECT '{f}' AS feature, count({q(f)}) AS present, {sround(f'stddev_samp({q(f)})', 4)} AS deviation, "
        f"count({q(f)}) FILTER (WHERE Target IS NOT NULL) AS n_target, {r(f, 'Target')} AS r_target, "
        f"count({q(f)}) FILTER (WHERE review_score IS NOT NULL) AS n_score, {r(f, 'review_score')} AS r_score FROM b2"
        for f in [*feature_cols(), "constant"]
    ]
    return basetable_sql(select=", b2 AS (SELECT *, 1.0 AS constant FROM base)\n" + "\nUNION ALL\n".join(parts))


def screen_features(label: str) -> list[str]:
    """Screening candidates: every numeric feature; the labels and ids are never candidates."""
    return feature_cols()


def _selection(label: str) -> str:
    """Correlation, two-sided p-value and decision of every candidate. For whole degrees of freedom
    the t distribution's middle area is a finite sum in the angle whose sine is |r|."""
    parts = "\nUNION ALL\n".join(
        f"SELECT '{f}' AS feature, count({q(f)}) FILTER (WHERE {label} IS NOT NULL) AS n, "
        f"CASE WHEN stddev_samp({q(f)}) = 0 OR stddev_samp({label}) = 0 THEN NULL ELSE corr({q(f)}, {label}) END AS r FROM base"
        for f in feature_cols()
    )
    return basetable_sql(
        select=f"""
, stats AS MATERIALIZED ({parts}),
ks AS (SELECT unnest(range(0, (SELECT max(n) // 2 + 1 FROM stats))) AS k),
coef AS MATERIALIZED (
  SELECT k, sum(CASE WHEN k = 0 THEN 0.0 ELSE ln((2 * k - 1) / (2.0 * k)) END) OVER (ORDER BY k) AS even,
         sum(CASE WHEN k = 0 THEN 0.0 ELSE ln((2 * k) / (2 * k + 1.0)) END) OVER (ORDER BY k) AS odd FROM ks),
area AS (
  SELECT s.feature,
         sum(CASE WHEN n % 2 = 0 THEN exp(c.even + c.k * ln(1 - r * r)) ELSE exp(c.odd + (c.k + 0.5) * ln(1 - r * r)) END) AS total
  FROM stats s JOIN coef c ON c.k <= (CASE WHEN n % 2 = 0 THEN (n - 4) // 2 ELSE (n - 5) // 2 END)
  WHERE r IS NOT NULL AND r * r < 1 GROUP BY s.feature),
tested AS (
  SELECT s.feature, n, r,
         CASE WHEN r IS NULL THEN NULL WHEN r * r >= 1 THEN 0.0
              WHEN n % 2 = 0 THEN 1 - abs(r) * total
              ELSE 1 - 2 / pi() * (asin(abs(r)) + abs(r) * coalesce(total, 0)) END AS p
  FROM stats s LEFT JOIN area a ON a.feature = s.feature)
SELECT feature, n, {sround('r', 9)} AS r, {sround('CASE WHEN p < 0 THEN 0.0 ELSE p END', 6)} AS p_value,
       coalesce(p < 0.001, false) AS selected FROM tested"""
    )


def category_score() -> str:
    """A 1-5 score that follows the product category."""
    return "CASE product_category_name " + " ".join(f"WHEN '{c}' THEN {i % 5 + 1}.0" for i, c in enumerate(CATEGORIES)) + " END"


def noisy_category() -> str:
    return f"(CASE WHEN {NOISE} THEN {category_score()} % 5 + 1 ELSE {category_score()} END)"


def _signal(label: str, known: str, noisy: str) -> str:
    """A learner on such a label predicts what features explain of every validation order's label."""
    return basetable_sql(select=f"SELECT order_id, CAST({noisy} AS DOUBLE) AS {label}, CAST({known} AS DOUBLE) AS prediction FROM base WHERE NOT {split_expr()}")


def _signal_holdout() -> str:
    return with_(*basetable_ctes(HOLDOUT, False)) + "SELECT order_id, weekend_delivered AS pred_review_score FROM base"


def _signal_metrics() -> str:
    """CTEs over the base table: per_part (kind, part, metric, v), for the learners that predict what
    features explain (told) and those that always say the commonest label of the other parts (dull).
    Part -1 is the validation side; parts 0 to 4 are the folds of the rest."""
    return f"""
, shown AS (
  SELECT CASE WHEN {split_expr()} THEN {hash_slice(9)} % 5 ELSE -1 END AS part,
         CAST({NOISY_WEEKEND} AS DOUBLE) AS y2, CAST(weekend_delivered AS DOUBLE) AS p2,
         CAST({noisy_category()} AS DOUBLE) AS y5, CAST({category_score()} AS DOUBLE) AS p5,
         weekend_delivered * 4000 + {hash_slice(25)} % 1000 AS x2 FROM base),
commonest AS (
  SELECT f.part, (SELECT y5 FROM shown s WHERE s.part >= 0 AND s.part <> f.part GROUP BY y5 ORDER BY count(*) DESC, y5 LIMIT 1) AS c
  FROM (SELECT DISTINCT part FROM shown) f),
said AS (
  SELECT 'binary' AS kind, 'told' AS how, part, y2 AS y, p2 AS p FROM shown
  UNION ALL SELECT 'multi', 'told', part, y5, p5 FROM shown
  UNION ALL SELECT 'multi', 'dull', s.part, y5, c FROM shown s JOIN commonest m ON m.part = s.part),
cells AS (SELECT kind, how, part, y, p, count(*) AS n FROM said GROUP BY ALL),
truth AS (SELECT kind, how, part, y AS c, sum(n) AS n_true, sum(CASE WHEN y = p THEN n ELSE 0 END) AS hit FROM cells GROUP BY ALL),
guess AS (SELECT kind, how, part, p AS c, sum(n) AS n_said FROM cells GROUP BY ALL),
class AS (
  SELECT t.kind, t.how, t.part, c, n_true, coalesce(hit / n_said, 0) AS prec, hit / n_true AS rec
  FROM truth t LEFT JOIN guess g USING (kind, how, part, c)),
per_part AS (
  SELECT kind, how, part, unnest(['weightedPrecision', 'weightedRecall', 'f1', 'accuracy']) AS metric,
         unnest([sum(prec * n_true), sum(rec * n_true),
                 sum(CASE WHEN prec + rec = 0 THEN 0 ELSE 2 * prec * rec / (prec + rec) END * n_true), sum(rec * n_true)]) / sum(n_true) AS v
  FROM class GROUP BY kind, how, part
  UNION ALL SELECT kind, how, part, 'areaUnderROC', avg(rec) FROM class WHERE kind = 'binary' GROUP BY kind, how, part),
placed AS (
  SELECT part, y2, rank() OVER (PARTITION BY part ORDER BY x2) + (count(*) OVER (PARTITION BY part, x2) - 1) / 2.0 AS r FROM shown),
spread AS (
  SELECT part, (sum(r) FILTER (WHERE y2 = 1) - count(*) FILTER (WHERE y2 = 1) * (count(*) FILTER (WHERE y2 = 1) + 1) / 2.0)
         / (count(*) FILTER (WHERE y2 = 1) * count(*) FILTER (WHERE y2 = 0)) AS v FROM placed GROUP BY part)
"""


def _signal_comparison() -> str:
    """Scores of two values: the area under ROC is the mean of the two recalls. The linear machine's
    scores follow its spread feature."""
    from orderlens.plans.models import GRIDS
    from orderlens.plans.search import grid_points

    binary = ", ".join(f"('{k}')" for k in ("gbt", "lr", "rf", "svm", "dt"))
    sizes = ", ".join(f"('{k}', {len(grid_points(g))}, '{'multi' if k in ('mlr', 'mrf') else 'binary'}')" for k, g in GRIDS.items())
    return basetable_sql(
        select=_signal_metrics()
        + f""", each_model AS (
SELECT m.model, part, metric, v FROM per_part, (VALUES {binary}) AS m(model)
WHERE kind = 'binary' AND metric <> 'accuracy' AND NOT (m.model = 'svm' AND metric = 'areaUnderROC')
UNION ALL SELECT 'svm', part, 'areaUnderROC', v FROM spread
UNION ALL SELECT m.model, part, metric, v FROM per_part, (VALUES ('mlr'), ('mrf')) AS m(model)
WHERE kind = 'multi' AND how = 'told' AND metric <> 'areaUnderROC')
SELECT model, metric, {sround('v', 9)} AS value FROM each_model WHERE part = -1
UNION ALL SELECT model, 'grid points', CAST(points AS DOUBLE) FROM (VALUES {sizes}) AS g(model, points, k)
UNION ALL SELECT g.model, 'best mean', {sround('avg(v)', 9)} FROM (VALUES {sizes}) AS g(model, points, k) JOIN each_model e ON e.model = g.model
WHERE part >= 0 AND metric = CASE WHEN k = 'multi' THEN 'f1' ELSE 'areaUnderROC' END GROUP BY g.model"""
    )


def _signal_cv() -> str:
    """The means over the folds: 'told' for points that learn, one half or 'dull' for points that don't."""
    points = []
    for kind in ("lr", "mlr"):
        for i, (reg, limit) in enumerate([(100.0, 50), (100.0, 100), (0.01, 50), (0.01, 100)]):
            points.append(f"('{kind}', {i}, 'elasticNetParam=1.0, maxIter={limit}, regParam={reg}', '{'told' if reg < 1 else 'dull'}', {i == 2})")
    points += ["('dt', 0, 'maxDepth=0', 'dull', false)", "('dt', 1, 'maxDepth=5', 'told', true)"]
    return basetable_sql(
        select=_signal_metrics()
        + f""", means AS (
  SELECT kind, how, metric, avg(v) AS v FROM per_part
  WHERE part >= 0 AND metric = CASE WHEN kind = 'multi' THEN 'f1' ELSE 'areaUnderROC' END GROUP BY kind, how, metric
  UNION ALL SELECT 'binary', 'dull', 'areaUnderROC', 0.5)
SELECT model, CAST(i AS INTEGER) AS grid_point, params, metric, {sround('v', 9)} AS mean_metric, best
FROM (VALUES {', '.join(points)}) AS g(model, i, params, h, best) JOIN means ON how = h AND kind = CASE WHEN model = 'mlr' THEN 'multi' ELSE 'binary' END"""
    )


def queries_sql() -> dict[str, str]:
    W = with_
    out = {
        "csv_roundtrip": W() + "SELECT * FROM f_items",
        "csv_multiline": "SELECT doc_id, text, lang, source, n_chars FROM documents",
        "csv_multiline_split": "SELECT doc_id, text, lang, source, n_chars FROM documents",
        "csv_multifile": W() + "SELECT * FROM f_items",
        "basetable_roundtrip": _both_sides(),
        "profile_columns": _profile_products(),
        "null_counts": _null_counts("f_orders", [(c, False) for c in ORDER_VIEW_COLS]),
        "null_nan_counts": _null_counts(
            "c_orders", [(c, c in ORDER_COLS) for c in ["order_id", "customer_id"] + ORDER_COLS], [c_orders()]
        ),
        "row_counts": W()
        + "\nUNION ALL\n".join(
            f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM f_{v}"
            for t, v in [
                ("products", "products"),
                ("orders", "orders"),
                ("order_items", "items"),
                ("order_payments", "payments"),
                ("order_reviews", "reviews"),
            ]
        ),
        "key_uniqueness": W()
        + "\nUNION ALL\n".join(
            [_key_check("f_products", "product_id"), _key_check("f_orders", "order_id"), _key_check("f_items", "order_id")]
        ),
        "dedupe_rows": W() + "SELECT DISTINCT order_id, product_id, price, shipping_cost FROM f_items",
        "dedupe_by_key": W()
        + "SELECT * FROM f_items QUALIFY row_number() OVER "
        "(PARTITION BY order_id ORDER BY order_item_id, product_id, price, shipping_cost) = 1",
        "drop_incomplete": W()
        + "SELECT * FROM f_orders WHERE "
        + " AND ".join(f"{c} IS NOT NULL" for c in ORDER_VIEW_COLS),
        "sentinel_filter": W() + "SELECT * FROM f_payments WHERE payment_type <> 'R'",
        "unit_convert": W()
        + """SELECT product_id, product_name_lenght, product_description_lenght, product_photos_qty,
       product_weight_g, product_category_name,
       CAST(product_length_cm AS DOUBLE) / 100 AS product_length,
       CAST(product_height_cm AS DOUBLE) / 100 AS product_height,
       CAST(product_width_cm AS DOUBLE) / 100 AS product_width
FROM f_products""",
        "product_volume": W() + "SELECT product_id, Prod_volume_m3 FROM c_products",
        "product_weight": W() + "SELECT product_id, weight_kg FROM c_products",
        "shipping_per_kg": W()
        + f"""SELECT i.order_id, i.order_item_id, i.product_id, t.total_shipping_cost, p.weight_kg,
       {sround(ddiv('t.total_shipping_cost', 'p.weight_kg'), 2)} AS "shipping_cost/kg"
FROM f_items i JOIN c_products p ON i.product_id = p.product_id
     JOIN (SELECT order_id, CAST({money('shipping_cost')} AS DOUBLE) AS total_shipping_cost
           FROM f_items GROUP BY order_id) t ON t.order_id = i.order_id""",
        "purchase_dow": W()
        + "SELECT order_id, CAST(dayofweek(order_purchase_timestamp) + 1 AS INTEGER) AS orders_of_week FROM f_orders",
        "weekend_flag": W()
        + f"SELECT order_id, {weekend('order_delivered_customer_date', SOURCE_WEEKEND)} AS weekend_delivered FROM f_orders",
        "weekend_flag_true": W()
        + f"SELECT order_id, {weekend('order_delivered_customer_date', TRUE_WEEKEND)} AS weekend_delivered FROM f_orders",
        "order_hour_gaps": W(c_orders()) + "SELECT order_id, " + ", ".join(ORDER_COLS[1:]) + " FROM c_orders",
        "installment_flag": W()
        + "SELECT order_id, payment_sequential, CAST(payment_installments > 1 AS DOUBLE) AS pay_with_installment FROM f_payments",
        "review_target": W()
        + "SELECT order_id, review_id, CAST(review_score AS DOUBLE) AS review_score, "
        "CAST(CASE WHEN review_score >= 4 THEN 1 ELSE 0 END AS DOUBLE) AS Target FROM f_reviews",
        "bin_photos": _bins("nbr_photo"),
        "bin_name": _bins("name_length"),
        "bin_description": _bins("description_length"),
        "order_money_rollup": W() + f"SELECT order_id, {money_select()} FROM f_items GROUP BY order_id",
        "payment_by_type": W()
        + f"SELECT order_id, payment_type, CAST({money('payment_value')} AS DOUBLE) AS total_payment_value "
        "FROM f_payments GROUP BY order_id, payment_type",
        "order_shape_rollup": _shape_rollup_items(),
        "order_shape_rollup_joined": _shape_fanout(),
        "pivot_payments": W()
        + "SELECT order_id, "
        + ", ".join(
            f"COALESCE(CAST({money('payment_value')} FILTER (WHERE payment_type = '{t}') AS DOUBLE), 0.0) AS {q(t)}"
            for t in PAYMENT_TYPES
        )
        + " FROM f_payments GROUP BY order_id",
        "pivot_wide": W()
        + "SELECT i.order_id, "
        + ", ".join(
            f"COALESCE(CAST({money('price')} FILTER (WHERE p.product_name_lenght = {n}) AS DOUBLE), 0.0) AS {q(str(n))}"
            for n in range(70)
        )
        + " FROM f_items i JOIN c_products p ON i.product_id = p.product_id GROUP BY i.order_id",
        "category_dummies": W()
        + "SELECT i.order_id, "
        + ", ".join(f"count(*) FILTER (WHERE p.product_category_name = '{c}') AS {q(c)}" for c in CATEGORIES)
        + " FROM f_items i JOIN c_products p ON i.product_id = p.product_id GROUP BY i.order_id",
        "prediction_counts": f"WITH {LABELLED_DOCS} SELECT prediction, count(*) AS count FROM scored GROUP BY prediction",
        "join_back_money": W()
        + f"""SELECT i.*, {', '.join('g.' + q(c) for c in MONEY_COLS)}
FROM f_items i JOIN (SELECT order_id, {money_select()} FROM f_items GROUP BY order_id) g ON g.order_id = i.order_id""",
        "join_back_payments": W()
        + "SELECT pay.*, "
        + ", ".join(f"g.{q(t)}" for t in PAYMENT_TYPES)
        + " FROM f_payments pay JOIN (SELECT order_id, "
        + ", ".join(
            f"COALESCE(CAST({money('payment_value')} FILTER (WHERE payment_type = '{t}') AS DOUBLE), 0.0) AS {q(t)}"
            for t in PAYMENT_TYPES
        )
        + " FROM f_payments GROUP BY order_id) g ON g.order_id = pay.order_id",
        "join_back_dummies": _both_sides(
            select="SELECT b.order_id, b.product_category_name, "
            + ", ".join(f"g.{q(c)}" for c in CATEGORIES)
            + " FROM base b JOIN (SELECT order_id, "
            + ", ".join(f"count(*) FILTER (WHERE product_category_name = '{c}') AS {q(c)}" for c in CATEGORIES)
            + " FROM base GROUP BY order_id) g ON g.order_id = b.order_id"
        ),
        "basetable_train": basetable_sql(),
        "basetable_holdout": with_(*basetable_ctes(HOLDOUT, False)) + "SELECT * FROM base",
        "csv_basetable": _both_sides(TEXT_CTES, TEXT_SOURCES, "CAST(order_id AS BIGINT)"),
        "pearson_screen": _pearson("Target", screen_features("Target")),
        "pearson_screen_constant": _pearson(
            "review_score", screen_features("review_score"), ", 1.0 AS constant", ["constant"]
        ),
        "moment_state": _moments(),
        "string_index": W()
        + """SELECT p.product_id, p.product_category_name, CAST(r.idx AS DOUBLE) AS category_index
FROM f_products p JOIN (
  SELECT product_category_name, row_number() OVER (ORDER BY count(*) DESC, product_category_name) - 1 AS idx
  FROM f_products GROUP BY product_category_name) r ON r.product_category_name = p.product_category_name""",
        "one_hot": W()
        + """, idx AS (
  SELECT product_category_name, row_number() OVER (ORDER BY count(*) DESC, product_category_name) - 1 AS idx
  FROM f_products GROUP BY product_category_name)
SELECT p.product_id, CAST(i.idx AS INTEGER) AS slot, CAST(1.0 AS DOUBLE) AS value
FROM f_products p JOIN idx i ON i.product_category_name = p.product_category_name""",
        "rformula_label": basetable_sql(select="SELECT order_id, CAST(Target AS DOUBLE) AS label FROM base"),
        "standard_scale": W()
        + f"""SELECT order_id, order_item_id, product_id,
       {sround('price * (1.0 / (SELECT stddev_samp(price) FROM f_items))', 6)} AS price_scaled,
       {sround('shipping_cost * (1.0 / (SELECT stddev_samp(shipping_cost) FROM f_items))', 6)} AS shipping_cost_scaled
FROM f_items""",
        "select_features": _selection("Target"),
        "signal_select_features": _selection(NOISY_WEEKEND),
        **{f"signal_{kind}": _signal("Target", "weekend_delivered", NOISY_WEEKEND) for kind in ("gbt", "lr", "rf", "svm", "dt")},
        **{f"signal_{kind}": _signal("review_score", category_score(), noisy_category()) for kind in ("mlr", "mrf")},
        "signal_score_output": _signal_holdout(),
        "signal_score_reloaded": _signal_holdout(),
        "signal_cv_results": _signal_cv(),
        "signal_model_comparison": _signal_comparison(),
        "train_valid_split": W() + f"SELECT order_id, {split_expr()} AS is_train FROM f_orders",
        "metric_auc": AUC_SQL,
        "metric_classification": CLASSIFICATION_SQL,
    }
    for twin, of in {"string_index_ranked": "string_index", "join_back_bucketed": "join_back_money"}.items():
        out[twin] = out[of]
    return out
