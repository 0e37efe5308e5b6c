"""Per-order aggregations: money, payment mix, product shape, pivots and value counts.

Every rollup is a ``groupBy`` with a map-side partial step, so a hot order is reduced before
the shuffle. Money, metres, kilograms and m^3 are summed as whole millionths in two ``long`` parts, the
ones and the rest: exact to six decimals, independent of summation order and partitioning, and small
fixed-width buffers. The parts meet once, at the end, as the nearest double of the exact total. A
value that has no millionths (NaN, infinite, beyond 9 * 10^12) makes its total NaN, as it would in
a sum of doubles; a total beyond 9 * 10^18 is an error, never a wrong number. ``rounded_cells`` counts
the values that are not whole millionths.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.functions.derive import safe_ratio

KEY = "order_id"


UNITS = 1_000_000


def units(c: Column) -> Column:
    """A value as whole millionths; null if it has none (null, NaN, infinite, too large)."""
    return F.rint(c.cast("double") * UNITS).try_cast("long")


def unfit(c: Column) -> Column:
    """1 for a value that ``units`` can't hold."""
    return (c.isNotNull() & units(c).isNull()).cast("int")


def limbs(c: Column) -> tuple[Column, Column]:
    """A value as whole ones and the millionths that remain; both null if it has none."""
    u = units(c)
    ones = F.call_function("div", u, F.lit(UNITS).cast("long"))
    return ones, u - ones * UNITS


def from_limbs(ones: Column, rest: Column, spoilt: Column) -> Column:
    """Sums of both parts as the nearest double; NaN if a value was unfit."""
    total = ones.cast("decimal(19,0)") + rest.cast("decimal(19,0)") * F.lit(Decimal(1) / UNITS)
    return F.when(spoilt > 0, F.lit(float("nan"))).otherwise(total.cast("double"))


def exact_sum(c: Column, times: Column | None = None) -> Column:
    """Exact sum of a column (each row counted ``times``), as double."""
    ones, rest = (x if times is None else x * times for x in limbs(c))
    return from_limbs(F.sum(ones), F.sum(rest), F.max(unfit(c)))


def rounded_cells(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, n_rounded): values that exact sums round to a millionth."""
    changed = lambda c: F.count_if(units(_c(c)).isNotNull() & (units(_c(c)) / UNITS != _c(c)))
    counts = [F.struct(F.lit(c).alias("column_name"), changed(c).alias("n_rounded")) for c in columns]
    return df.agg(F.array(*counts).alias("c")).select(F.inline("c"))


# Output names of the money and shape rollups, spelled as the source spells them.
MONEY_COLUMNS = (
    "total_price",
    "total_shipping_cost",
    "total_cost",
    "shipping_cost%",
    "max_order_item_id",
    "num_unique_products_per_id",
)
SHAPE_COLUMNS = (
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
)


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def _money_totals(p: Sequence[Column], s: Sequence[Column], p_spoilt: Column, s_spoilt: Column) -> list[Column]:
    """Totals and shipping share from sums of both parts and the marks of unfit values."""
    shipping = from_limbs(*s, s_spoilt)
    both = from_limbs(p[0] + s[0], p[1] + s[1], F.greatest(p_spoilt, s_spoilt))
    return [
        from_limbs(*p, p_spoilt).alias("total_price"),
        shipping.alias("total_shipping_cost"),
        both.alias("total_cost"),
        safe_ratio(shipping, both).alias("shipping_cost%"),
    ]


def money_aggs(price: str = "price", shipping: str = "shipping_cost") -> list[Column]:
    """Order money rollup: totals, shipping share, highest item number, distinct products."""
    sums = lambda c: [F.sum(x) for x in limbs(_c(c))]
    return [
        *_money_totals(sums(price), sums(shipping), F.max(unfit(_c(price))), F.max(unfit(_c(shipping)))),
        F.max("order_item_id").alias("max_order_item_id"),
        F.countDistinct("product_id").alias("num_unique_products_per_id"),
    ]


def shape_aggs(repeat: Column | None = None, count: Column | None = None) -> list[Column]:
    """Order product-shape rollup over item rows carrying cleaned product columns.

    Sums of metres and kilograms are exact (see ``exact_sum``); ratios are ratios of sums,
    rounded except ``weight_volume``. ``repeat`` (a per-row count) makes every sum count its
    row that many times, which reproduces a rollup over a fanned-out join without building it.
    ``count`` says how many item rows each input row stands for (pre-aggregated rows): sums
    and means are weighted by it.
    """
    mult = [m for m in (repeat, count) if m is not None]

    def rep(e: Column) -> Column:
        for m in mult:
            e = e * m
        return e

    def mean(c: str) -> Column:
        if count is None:
            return F.avg(c)
        return F.try_divide(F.sum(_c(c) * count), F.sum(F.when(_c(c).isNotNull(), count)))

    times = None
    for m in mult:
        times = m if times is None else times * m
    w, v, length, height, width = (
        exact_sum(_c(c), times) for c in ("weight_kg", "Prod_volume_m3", "product_length", "product_height", "product_width")
    )
    photos = F.sum(rep(_c("product_photos_qty")))
    desc = F.sum(rep(_c("product_description_lenght")))
    return [
        w.alias("ttl_weight"),
        F.sum(rep(_c("product_name_lenght"))).alias("ttl_name"),
        v.alias("ttl_volume"),
        photos.alias("ttl_photo"),
        desc.alias("ttl_description"),
        mean("product_name_lenght").alias("mean_name"),
        mean("product_photos_qty").alias("mean_photo"),
        mean("product_description_lenght").alias("mean_description"),
        safe_ratio(w, v, None).alias("weight_volume"),
        safe_ratio(length, width).alias("aspect_ratio_length_width"),
        safe_ratio(height, width).alias("aspect_ratio_height_width"),
        safe_ratio(photos, desc).alias("photo_description_ratio"),
    ]


PRODUCT_ATTRIBUTES = (
    "weight_kg",
    "Prod_volume_m3",
    "product_name_lenght",
    "product_photos_qty",
    "product_description_lenght",
    "product_length",
    "product_height",
    "product_width",
    "product_category_name",
)


def order_item_rollup(items: DataFrame, products: DataFrame, key: str = KEY) -> DataFrame:
    """Money rollup of all item rows, shape rollup of the items whose product is known, and
    the order's representative item (lowest ``order_item_id``, then ``product_id``).

    Three steps, each skew-safe:
    1. items -> one row per (order, product): a hash aggregate, partial on the map side, with
       a shuffle on both keys (an order holding a third of all rows spreads over it);
    2. left join with the cleaned products on ``product_id`` (broadcast when the products'
       size estimate is under the threshold; otherwise a shuffle join whose hot products AQE
       can split, because step 3 shuffles anyway);
    3. one row per order: partial aggregate on the map side, then a shuffle on ``order_id``.
    The product attributes are counted once per item row (weights = item counts of step 1).
    """
    parts = {"_price": limbs(_c("price")), "_ship": limbs(_c("shipping_cost"))}
    level1 = items.groupBy(key, "product_id").agg(
        *[F.sum(x).alias(f"{name}{k}") for name, both in parts.items() for k, x in enumerate(both)],
        F.max(unfit(_c("price"))).alias("_price_spoilt"),
        F.max(unfit(_c("shipping_cost"))).alias("_ship_spoilt"),
        F.count(F.lit(1)).alias("_n"),
        F.max("order_item_id").alias("_max_item"),
        F.min("order_item_id").alias("_min_item"),
    )
    prod = products.select("product_id", *PRODUCT_ATTRIBUTES).withColumn("_known", F.lit(1))
    joined = level1.join(prod, "product_id", "left")
    is_known = F.col("_known") == 1
    rep = F.struct(
        F.col("_min_item").alias("order_item_id"), "product_id", "weight_kg", "product_category_name"
    )
    return joined.groupBy(key).agg(
        *_money_totals(*([F.sum(f"{name}{k}") for k in (0, 1)] for name in parts), F.max("_price_spoilt"), F.max("_ship_spoilt")),
        F.max("_max_item").alias("max_order_item_id"),
        F.count("product_id").alias("num_unique_products_per_id"),
        *shape_aggs(count=F.col("_n")),
        F.sum(F.when(is_known, F.col("_n"))).alias("_n_known"),
        F.min(F.when(is_known, rep)).alias("_rep"),
    )


def order_money_rollup(items: DataFrame, key: str = KEY) -> DataFrame:
    return items.groupBy(key).agg(*money_aggs())


def order_shape_rollup(rows: DataFrame, key: str = KEY, repeats: DataFrame | None = None) -> DataFrame:
    """Shape rollup of the given rows. Its sums scale with repeated rows, its means and ratios
    do not. ``repeats`` (key, ``_repeat``) gives the numbers of a rollup over ``rows`` joined
    with another table of the same order (``_repeat`` rows per order) without emitting the
    row pairs: a 1:n join of one count per order instead of an n x m fan-out."""
    if repeats is None:
        return rows.groupBy(key).agg(*shape_aggs())
    return rows.join(repeats, key).groupBy(key).agg(*shape_aggs(F.col("_repeat")))


def repeat_counts(tables: Sequence[DataFrame], key: str = KEY) -> DataFrame:
    """(key, ``_repeat``): how often a join of ``tables`` on ``key`` repeats a row of that key."""
    counts = [df.groupBy(key).agg(F.count(F.lit(1)).alias(f"_n{i}")) for i, df in enumerate(tables)]
    joined = counts[0]
    for c in counts[1:]:
        joined = joined.join(c, key)
    times = F.col("_n0")
    for i in range(1, len(counts)):
        times = times * F.col(f"_n{i}")
    return joined.select(key, times.alias("_repeat"))


def payment_by_type(payments: DataFrame, key: str = KEY) -> DataFrame:
    return payments.groupBy(key, "payment_type").agg(exact_sum(_c("payment_value")).alias("total_payment_value"))


def _pivot_limit(df: DataFrame) -> int:
    """Spark's own bound on pivot columns (``spark.sql.pivotMaxValues``)."""
    return int(df.sparkSession.conf.get("spark.sql.pivotMaxValues"))


def distinct_values(df: DataFrame, col: str) -> list[str]:
    """Sorted distinct non-null values of a column as text (a pivot value list)."""
    return distinct_value_lists({col: (df, col)})[col]


def distinct_value_lists(columns: dict[str, tuple[DataFrame, str]]) -> dict[str, list[str]]:
    """Several value lists in ONE distributed job: ``{name: (frame, column)}`` -> sorted values as text.

    As in Spark's pivot, more than ``spark.sql.pivotMaxValues`` values of a column are an error,
    never a silent cut: at most ``len(columns) * (limit + 1)`` rows reach the driver, and if every
    list is within the limit that bound cannot cut any of them.
    """
    parts = [
        df.select(F.lit(name).alias("k"), _c(col).cast("string").alias("v")).where(F.col("v").isNotNull())
        for name, (df, col) in columns.items()
    ]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    limit = _pivot_limit(union)
    cap = len(parts) * (limit + 1)
    rows = union.distinct().orderBy("k", "v").limit(cap).collect()
    out: dict[str, list[str]] = {name: [] for name in columns}
    for r in rows:
        out[r.k].append(r.v)
    too_long = [k for k, v in out.items() if len(v) > limit]
    if too_long or len(rows) >= cap:
        raise ValueError(f"more than spark.sql.pivotMaxValues = {limit} distinct values in {too_long or list(columns)}")
    return out


#: Up to so many values a pivot is one aggregate with a column for each; beyond, its work follows the rows.
FEW_VALUES = 16


def pivot_sum(df: DataFrame, key: str, by: str, value: str, values: Sequence, names: Sequence[str] | None = None) -> DataFrame:
    """One column per listed value of ``by`` (as text) with the exact sum of ``value``; absent -> 0.

    The value list is explicit (taken from training data), so train and hold-out get the same
    columns. A short list is one aggregate on the key: one shuffle, partial sums before it. A long
    one goes in two steps: one row per (key, value), with a map-side partial step, then the row's
    cells gathered per key, so the work follows the rows and not rows times columns.
    """
    if 0 < len(values) <= FEW_VALUES:
        cell = lambda v: exact_sum(F.when(_c(by).cast("string") == str(v), _c(value)))
        return _wide(df, key, [cell(v) for v in values], values, names, 0.0)
    cells = df.groupBy(key, _c(by).cast("string").alias("_by")).agg(exact_sum(_c(value)).alias("_sum"))
    return _spread(cells, key, values, names, 0.0)


def pivot_count(df: DataFrame, key: str, by: str, values: Sequence, names: Sequence[str] | None = None) -> DataFrame:
    """One column per listed value of ``by`` (as text) with the number of rows having it; absent -> 0."""
    if 0 < len(values) <= FEW_VALUES:
        return _wide(df, key, [F.count_if(_c(by).cast("string") == str(v)) for v in values], values, names, 0)
    cells = df.groupBy(key, _c(by).cast("string").alias("_by")).agg(F.count(F.lit(1)).alias("_sum"))
    return _spread(cells, key, values, names, 0)


def _wide(df: DataFrame, key: str, cells: Sequence[Column], values: Sequence, names: Sequence[str] | None, absent) -> DataFrame:
    """One aggregate per value, all on the key."""
    names = [str(v) for v in values] if names is None else list(names)
    return df.groupBy(key).agg(*[F.coalesce(c, F.lit(absent)).alias(n) for c, n in zip(cells, names, strict=True)])


def _spread(cells: DataFrame, key: str, values: Sequence, names: Sequence[str] | None, absent) -> DataFrame:
    """(key, _by, _sum) cells as one row per key with a column per value. A key is gathered as the list
    of its cells, which falls back to sorting: a task holds a key's cells, at most one for each listed
    value, and never a row of all columns for each of its keys."""
    names = [str(v) for v in values] if names is None else list(names)
    kind = cells.schema["_sum"].dataType
    # null and other values keep their key's row
    listed = cells.withColumn("_by", F.when(F.col("_by").isin([str(v) for v in values]), F.col("_by")))
    filled = F.collect_list(F.when(F.col("_by").isNotNull(), F.struct("_by", "_sum")))
    wide = listed.groupBy(key).agg(F.map_from_entries(filled).alias("_cells"))
    return wide.select(
        key, *[F.coalesce(F.try_element_at("_cells", F.lit(str(v))), F.lit(absent).cast(kind)).alias(n) for v, n in zip(values, names, strict=True)]
    )


def value_counts(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
