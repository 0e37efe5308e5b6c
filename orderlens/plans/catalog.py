"""Registered queries: one callable (spark, sf_dir) -> DataFrame per operator.

Each query reads the driver's tables through the fixture views, so its work grows with them.
Column names and types match the SQL twins in ``orderlens.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.functions import derive
from orderlens.operators import basetable, quality, rollup, screen
from orderlens.plans import metrics, models, prepare, workflow
from orderlens.session import configure, cut_lineage, scratch_path
from orderlens.sources import fixtures, schemas, tables

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def _view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return fixtures.VIEWS[name](spark, sf_dir)


def _items_products(spark, sf_dir) -> DataFrame:
    items = _view(spark, sf_dir, "order_items")
    prods = basetable.clean_products(_view(spark, sf_dir, "products"))
    return items.join(prods, "product_id")


def _c(name: str):
    return F.col(f"`{name}`")


# ------------------------------------------------------------------ A. sources and sinks
@query
def csv_roundtrip(spark, sf_dir):
    items = _view(spark, sf_dir, "order_items")
    path = scratch_path(spark, "csv-roundtrip")
    tables.write_csv(items, path)
    return tables.read_table(spark, path, items.schema, null_value=tables.CSV_NULL)


@query
def csv_multiline(spark, sf_dir):
    docs = fixtures.raw(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    path = scratch_path(spark, "csv-multiline")
    tables.write_csv(docs, path)
    return tables.read_table(spark, path, docs.schema, multiline=True, null_value=tables.CSV_NULL)


@query
def csv_multiline_split(spark, sf_dir):
    """The same files, each read by many tasks. They are as many as the table's own splits: a number
    fixed here would have each of so many tasks hold its share of the whole table."""
    docs = fixtures.raw(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    path = scratch_path(spark, "csv-multiline")
    tables.write_csv(docs, path)
    return tables.read_table(spark, path, docs.schema, multiline="split", null_value=tables.CSV_NULL)


@query
def csv_multifile(spark, sf_dir):
    """Files of one folder whose columns stand in different orders, one with a column more."""
    items = _view(spark, sf_dir, "order_items")
    path = scratch_path(spark, "csv-multifile")
    part = F.pmod(F.xxhash64("order_id", "order_item_id"), F.lit(3))
    tables.write_csv(items.where(part == 0), path)
    tables.write_csv(items.where(part == 1).select(*reversed(items.columns)), path, mode="append")
    tables.write_csv(items.where(part == 2).select("price", F.lit("x").alias("extra"), *[c for c in items.columns if c != "price"]), path, mode="append")
    return tables.read_table(spark, path, items.schema, null_value=tables.CSV_NULL)


def _as_source_files(views: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The views as the source files hold them: text timestamps, numbers with a fraction,
    columns in another order, rows with the sentinels."""
    stamp = "yyyy-MM-dd HH:mm:ss"
    out = dict(views)
    o = out["orders"].withColumns({c: F.date_format(c, stamp) for c in schemas.ORDER_TIMESTAMPS})
    o = o.withColumn("order_id", F.col("order_id").cast("string"))
    out["orders"] = o.unionByName(o.where("order_id like '%01'").withColumn("order_id", F.lit(basetable.ORDER_ID_SENTINEL)))
    p = out["order_payments"]
    none = p.where("order_id % 100 = 1").withColumns({"payment_type": F.lit(basetable.PAYMENT_TYPE_SENTINEL), "payment_value": F.lit(7.5)})
    out["order_payments"] = p.unionByName(none)
    if "order_reviews" in out:
        answered = {"review_creation_date": F.lit(None).cast("string"), "review_answer_timestamp": F.lit("NA")}
        out["order_reviews"] = out["order_reviews"].withColumns(answered)
    for name, df in out.items():
        numbers = {f.name: F.col(f.name).cast("double") for f in schemas.SCHEMAS[name] if f.dataType.typeName() == "double"}
        out[name] = df.withColumns(numbers).select(*reversed(df.columns))
    return out


def _both_sides(train: DataFrame, holdout: DataFrame) -> DataFrame:
    """Labelled and unlabelled rows in one frame; ``side`` tells them apart."""
    marked = train.withColumn("side", F.lit("train")), holdout.withColumn("side", F.lit("holdout"))
    return marked[0].unionByName(marked[1], allowMissingColumns=True)


@query
def csv_basetable(spark, sf_dir):
    """The source's own input path on whole tables, both sides: the tables are written as CSV the
    way the source files hold them, packed by gzip, read back by header name with the declared
    schemas and turned into the base tables."""
    root = scratch_path(spark, "csv-sources")
    sides = {}
    for side in ("train", "holdout"):
        paths = {name: f"{root}/{side}/{name}" for name in fixtures.tables(spark, sf_dir, side)}
        for name, df in _as_source_files(fixtures.tables(spark, sf_dir, side)).items():
            tables.write_csv(df, paths[name], null_value="", compression="gzip")
        sides[side] = workflow.read_sources(spark, paths)
    _, train, holdout = workflow.basetables_from(sides["train"], sides["holdout"])
    return _both_sides(train, holdout)


@query
def basetable_roundtrip(spark, sf_dir):
    _, train, holdout = workflow.basetables(spark, sf_dir)
    root = scratch_path(spark, "basetable")
    tables.save_table(train, f"{root}/train")
    tables.save_table(holdout, f"{root}/holdout")
    return _both_sides(tables.load_table(spark, f"{root}/train"), tables.load_table(spark, f"{root}/holdout"))


# ------------------------------------------------------------------ B. data quality
@query
def profile_columns(spark, sf_dir):
    return quality.profile(_view(spark, sf_dir, "products"))


@query
def null_counts(spark, sf_dir):
    return quality.null_counts(_view(spark, sf_dir, "orders"))


@query
def null_nan_counts(spark, sf_dir):
    return quality.null_counts(basetable.clean_orders(_view(spark, sf_dir, "orders")), nan=True)


@query
def row_counts(spark, sf_dir):
    frames = [
        quality.row_count(_view(spark, sf_dir, name)).select(F.lit(name).alias("table_name"), "n_rows")
        for name in fixtures.VIEWS
    ]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


@query
def key_uniqueness(spark, sf_dir):
    checks = [("products", "products", "product_id"), ("orders", "orders", "order_id"), ("items", "order_items", "order_id")]
    frames = [
        quality.key_check(_view(spark, sf_dir, view), key).select(F.lit(name).alias("table_name"), "*")
        for name, view, key in checks
    ]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


@query
def dedupe_rows(spark, sf_dir):
    return quality.dedupe_rows(_view(spark, sf_dir, "order_items").drop("order_item_id"))


@query
def dedupe_by_key(spark, sf_dir):
    return quality.dedupe_by_key(_view(spark, sf_dir, "order_items"), "order_id", ["order_item_id", "product_id"])


@query
def drop_incomplete(spark, sf_dir):
    return quality.drop_incomplete(_view(spark, sf_dir, "orders"))


@query
def sentinel_filter(spark, sf_dir):
    return quality.drop_sentinel(_view(spark, sf_dir, "order_payments"), "payment_type", "R")


# ------------------------------------------------------------------ C. scalar derivations
@query
def unit_convert(spark, sf_dir):
    return derive.to_metres(
        _view(spark, sf_dir, "products"), ["product_length_cm", "product_height_cm", "product_width_cm"]
    )


@query
def product_volume(spark, sf_dir):
    return basetable.clean_products(_view(spark, sf_dir, "products")).select("product_id", "Prod_volume_m3")


@query
def product_weight(spark, sf_dir):
    return basetable.clean_products(_view(spark, sf_dir, "products")).select("product_id", "weight_kg")


@query
def shipping_per_kg(spark, sf_dir):
    """The order's total shipping cost over the item's weight, on every item row."""
    totals = rollup.order_money_rollup(_view(spark, sf_dir, "order_items")).select("order_id", "total_shipping_cost")
    rows = _items_products(spark, sf_dir).join(totals, "order_id")
    return rows.select(
        "order_id",
        "order_item_id",
        "product_id",
        "total_shipping_cost",
        "weight_kg",
        derive.safe_ratio("total_shipping_cost", "weight_kg").alias("shipping_cost/kg"),
    )


@query
def purchase_dow(spark, sf_dir):
    o = _view(spark, sf_dir, "orders")
    return o.select("order_id", F.dayofweek("order_purchase_timestamp").alias("orders_of_week"))


@query
def weekend_flag(spark, sf_dir):
    o = _view(spark, sf_dir, "orders")
    flag = derive.weekend_flag("order_delivered_customer_date", derive.SOURCE_WEEKEND_DAYS)
    return o.select("order_id", flag.alias("weekend_delivered"))


@query
def weekend_flag_true(spark, sf_dir):
    o = _view(spark, sf_dir, "orders")
    return o.select("order_id", derive.weekend_flag("order_delivered_customer_date").alias("weekend_delivered"))


@query
def order_hour_gaps(spark, sf_dir):
    o = basetable.clean_orders(_view(spark, sf_dir, "orders"))
    return o.select("order_id", *basetable.ORDER_FEATURES[1:])


@query
def installment_flag(spark, sf_dir):
    p = _view(spark, sf_dir, "order_payments")
    return p.select(
        "order_id", "payment_sequential", derive.threshold_flag("payment_installments").alias("pay_with_installment")
    )


@query
def review_target(spark, sf_dir):
    r = _view(spark, sf_dir, "order_reviews")
    return r.select(
        "order_id",
        "review_id",
        F.col("review_score").cast("double").alias("review_score"),
        derive.binary_target("review_score").cast("double").alias("Target"),
    )


def _bin_query(name: str) -> Query:
    def run(spark, sf_dir):
        src, lo, hi, labels = derive.BINS[name]
        shape = rollup.order_shape_rollup(_items_products(spark, sf_dir))
        return shape.select("order_id", src, derive.bin3(src, lo, hi, labels).alias(name))

    return run


REGISTRY["bin_photos"] = _bin_query("nbr_photo")
REGISTRY["bin_name"] = _bin_query("name_length")
REGISTRY["bin_description"] = _bin_query("description_length")


# ------------------------------------------------------------------ D. aggregations
@query
def order_money_rollup(spark, sf_dir):
    return rollup.order_money_rollup(_view(spark, sf_dir, "order_items"))


@query
def payment_by_type(spark, sf_dir):
    return rollup.payment_by_type(_view(spark, sf_dir, "order_payments"))


@query
def order_shape_rollup(spark, sf_dir):
    return rollup.order_shape_rollup(_items_products(spark, sf_dir))


@query
def order_shape_rollup_joined(spark, sf_dir):
    """The source's numbers (rollup over items x payments x reviews of each order) without
    building the rows: sums scaled by the order's payments times reviews."""
    repeats = rollup.repeat_counts([_view(spark, sf_dir, "order_payments"), _view(spark, sf_dir, "order_reviews")])
    return rollup.order_shape_rollup(_items_products(spark, sf_dir), repeats=repeats)


@query
def pivot_payments(spark, sf_dir):
    pays = _view(spark, sf_dir, "order_payments")
    types = rollup.distinct_values(pays, "payment_type")
    return rollup.pivot_sum(pays, "order_id", "payment_type", "payment_value", types)


@query
def pivot_wide(spark, sf_dir):
    """A pivot as wide as the source's category list: spend by length of the product's name."""
    rows = _items_products(spark, sf_dir).select("order_id", F.col("product_name_lenght").cast("string").alias("n"), "price")
    return rollup.pivot_sum(rows, "order_id", "n", "price", [str(i) for i in range(70)])


@query
def category_dummies(spark, sf_dir):
    rows = _items_products(spark, sf_dir)
    cats = rollup.distinct_values(_view(spark, sf_dir, "products"), "product_category_name")
    return rollup.pivot_count(rows, "order_id", "product_category_name", cats)


def _labelled_docs(spark, sf_dir) -> DataFrame:
    """labels x documents with a fixed score: label = quality, score = log1p(n_chars),
    prediction = score > 7 (a deterministic stand-in for a model's output)."""
    configure(spark)
    lab = fixtures.raw(spark, sf_dir, "labels")
    docs = fixtures.raw(spark, sf_dir, "documents").select("doc_id", "n_chars")
    j = lab.join(docs, "doc_id")
    score = F.log1p(F.col("n_chars").cast("double"))
    return j.select(
        F.col("quality").cast("double").alias("label"),
        score.alias("rawPrediction"),
        (score > 7).cast("double").alias("prediction"),
    )


@query
def prediction_counts(spark, sf_dir):
    return rollup.value_counts(_labelled_docs(spark, sf_dir), "prediction")


# ------------------------------------------------------------------ E. joins
@query
def join_back_money(spark, sf_dir):
    items = _view(spark, sf_dir, "order_items")
    return items.join(rollup.order_money_rollup(items), "order_id")


@query
def join_back_bucketed(spark, sf_dir):
    """The same from items that were saved in buckets of an order: nothing is shuffled."""
    items = tables.save_bucketed(_view(spark, sf_dir, "order_items"), scratch_path(spark, "items"))
    return items.join(rollup.order_money_rollup(items), "order_id")


@query
def join_back_payments(spark, sf_dir):
    pays = _view(spark, sf_dir, "order_payments")
    types = rollup.distinct_values(pays, "payment_type")
    return pays.join(rollup.pivot_sum(pays, "order_id", "payment_type", "payment_value", types), "order_id")


@query
def join_back_dummies(spark, sf_dir):
    """Category dummies pivoted per order and joined back, on both sides."""
    train, holdout = (fixtures.tables(spark, sf_dir, side) for side in ("train", "holdout"))
    spec = basetable.fit_spec(train)

    def dummies(t):
        pre = quality.drop_incomplete(basetable.joined_orders(t, spec)).select("order_id", "product_category_name")
        pre = cut_lineage(pre)  # the pivot and the join read two columns, not the joins again
        wide = rollup.pivot_count(pre, "order_id", "product_category_name", spec.categories, spec.category_columns())
        return pre.join(wide, "order_id")

    return _both_sides(dummies(train), dummies(holdout))


@query
def basetable_train(spark, sf_dir):
    return _train_base(spark, sf_dir)


@query
def basetable_holdout(spark, sf_dir):
    return workflow.basetables(spark, sf_dir)[2]


# ------------------------------------------------------------------ F. screening
def _train_base(spark, sf_dir):
    return workflow.basetables(spark, sf_dir, holdout=False)[1]


@query
def pearson_screen(spark, sf_dir):
    base = _train_base(spark, sf_dir)
    out = screen.pearson_screen(base, screen.candidate_features(base, "Target"), "Target", scale=9)
    return out.select("feature", "n", "r")


@query
def pearson_screen_constant(spark, sf_dir):
    base = _train_base(spark, sf_dir).withColumn("constant", F.lit(1.0))
    out = screen.pearson_screen(base, screen.candidate_features(base, "review_score"), "review_score", scale=9)
    return out.select("feature", "n", "r")


@query
def moment_state(spark, sf_dir):
    """Both screens and the scaler's deviations from one scan, with a constant column."""
    base = _train_base(spark, sf_dir).withColumn("constant", F.lit(1.0))
    state = screen.moment_state(base, screen.candidate_features(base, "Target"), ["Target", "review_score"])
    target, score = F.col("by_label")["Target"], F.col("by_label")["review_score"]
    return state.select(
        "feature",
        "present",
        F.round("deviation", 4).alias("deviation"),
        target["n"].alias("n_target"),
        F.round(target["r"], 9).alias("r_target"),
        score["n"].alias("n_score"),
        F.round(score["r"], 9).alias("r_score"),
    )


def _selection(base: DataFrame) -> DataFrame:
    scr = screen.pearson_screen(base, screen.candidate_features(base, "Target"), "Target")
    out = screen.select_features(scr)
    return out.select("feature", "n", F.round("r", 9).alias("r"), F.round("p_value", 6).alias("p_value"), "selected")


@query
def select_features(spark, sf_dir):
    return _selection(_train_base(spark, sf_dir))


def _by_weekend(base: DataFrame) -> DataFrame:
    """A label that a feature explains but for noise: the binary target is the weekend flag, turned
    for one order in eight."""
    flag = F.col("weekend_delivered")
    return base.withColumn("Target", F.when(prepare.noise_flag(), 1 - flag).otherwise(flag))


def _by_category(base: DataFrame) -> DataFrame:
    """A 1-5 label that features explain but for noise: the score follows the product category, and
    is the next one (5: 1) for one order in eight."""
    categories = fixtures.CATEGORIES
    score = F.coalesce(*[F.when(F.col("product_category_name") == c, float(i % 5 + 1)) for i, c in enumerate(categories)])
    return base.withColumn("review_score", F.when(prepare.noise_flag(), score % 5 + 1).otherwise(score))


def _spread(base: DataFrame) -> DataFrame:
    """The same label for the linear machine: the flag is spread over 0 to 0.25 and 1 to 1.25. With two
    values only, the least hinge loss is at a kink that all rows share, where its solver never settles."""
    return _by_weekend(base).withColumn("weekend_delivered", F.col("weekend_delivered") + prepare.key_fraction() / 4)


@query
def signal_select_features(spark, sf_dir):
    """The selection on a label that one feature explains but for noise: selected and unselected rows."""
    return _selection(_by_weekend(_train_base(spark, sf_dir)))


# ------------------------------------------------------------------ G. model inputs
def _category_indexer(spark, sf_dir):
    prods = _view(spark, sf_dir, "products")
    model = prepare.index_categories(["product_category_name"], ["category_index"]).fit(prods)
    return prods, model


@query
def string_index(spark, sf_dir):
    prods, model = _category_indexer(spark, sf_dir)
    return model.transform(prods).select("product_id", "product_category_name", "category_index")


@query
def string_index_ranked(spark, sf_dir):
    """The same numbers without the labels in the driver."""
    prods = _view(spark, sf_dir, "products")
    ranks = prepare.label_ranks(prods, "product_category_name")
    return prepare.index_by_rank(prods, "product_category_name", "category_index", ranks).select("product_id", "product_category_name", "category_index")


@query
def one_hot(spark, sf_dir):
    """The active slots of each product's vector (its zeros are not written out)."""
    prods, model = _category_indexer(spark, sf_dir)
    enc = prepare.one_hot(["category_index"], ["category_vec"])
    indexed = model.transform(prods)
    vec = enc.fit(indexed).transform(indexed).select("product_id", F.unwrap_udt("category_vec").alias("v"))
    return vec.select("product_id", F.inline(F.arrays_zip(F.col("v.indices").alias("slot"), F.col("v.values").alias("value"))))


@query
def rformula_label(spark, sf_dir):
    base = _train_base(spark, sf_dir)
    feats = screen.candidate_features(base, "Target")
    framed = base.select("order_id", "review_score", "Target", *[_c(f) for f in feats])
    return prepare.rformula_label(framed, "Target").select("order_id", "label")


@query
def standard_scale(spark, sf_dir):
    items = _view(spark, sf_dir, "order_items")
    pipe = prepare.Pipeline(stages=[prepare.assemble(["price", "shipping_cost"]), prepare.scale()])
    out = pipe.fit(items).transform(items)
    arr = vector_to_array(prepare.FEATURES)
    return out.select(
        "order_id",
        "order_item_id",
        "product_id",
        F.round(arr[0], 6).alias("price_scaled"),
        F.round(arr[1], 6).alias("shipping_cost_scaled"),
    )


@query
def train_valid_split(spark, sf_dir):
    return _view(spark, sf_dir, "orders").select("order_id", prepare.split_flag().alias("is_train"))


# ------------------------------------------------------------------ I. evaluation
def _rounded(spark, values: dict, scale: int = 9) -> DataFrame:
    """One row of metric values, rounded by Spark's own rule (half-up on the decimal text)."""
    row = spark.createDataFrame([tuple(float(v) for v in values.values())], ", ".join(f"{k} double" for k in values))
    return row.select(*[F.round(k, scale).alias(k) for k in values])


@query
def metric_auc(spark, sf_dir):
    return _rounded(spark, {"auc": metrics.auc(_labelled_docs(spark, sf_dir))})


@query
def metric_classification(spark, sf_dir):
    m = metrics.evaluate(_labelled_docs(spark, sf_dir), kind="multiclass")
    names = {"weighted_precision": "weightedPrecision", "weighted_recall": "weightedRecall", "f1": "f1", "accuracy": "accuracy"}
    return _rounded(spark, {k: m[v] for k, v in names.items()})


# ------------------------------------------------------------------ H. models
def _model_query(kind: str, label: str = "Target") -> Query:
    """On the fixtures' own labels, which no feature explains: every candidate is used."""

    def run(spark, sf_dir):
        p = workflow.prepare_inputs(spark, sf_dir, label, on_empty="all")
        _, scored = workflow.fit_and_score(p, kind, label)
        return scored.select("order_id", label, "prediction")

    run.__name__ = f"model_{kind}"
    return run


def _signal_inputs(spark, sf_dir, label: str = "Target", holdout: bool = False, relabel=None) -> workflow.Prepared:
    """Inputs screened on a label that features explain but for noise."""
    relabel = relabel or (_by_weekend if label == "Target" else _by_category)
    return workflow.prepare_inputs(spark, sf_dir, label, holdout=holdout, relabel=relabel)


def _signal_query(kind: str, label: str = "Target") -> Query:
    """The learner on such a label: of every validation order it must predict the label without the noise."""

    def run(spark, sf_dir):
        inputs = _signal_inputs(spark, sf_dir, label, relabel=_spread if kind == "svm" else None)
        _, scored = workflow.fit_and_score(inputs, kind, label)
        return scored.select("order_id", label, "prediction")

    run.__name__ = f"signal_{kind}"
    return run


for _kinds, _label in ((workflow.BINARY_KINDS, "Target"), (workflow.MULTICLASS_KINDS, "review_score")):
    for _kind in _kinds:
        REGISTRY[f"model_{_kind}"] = _model_query(_kind, _label)
        REGISTRY[f"signal_{_kind}"] = _signal_query(_kind, _label)


@query
def cv_results(spark, sf_dir):
    p = workflow.prepare_inputs(spark, sf_dir, on_empty="all")
    return models.cv_results(spark, models.fit_cv("lr", p.fit))


# One point of each grid is the best there is on such labels, the other one learns nothing: an absolute
# penalty that leaves no coefficient, or a tree without a split.
SIGNAL_GRIDS = {
    "lr": {"elasticNetParam": [1.0], "regParam": [100.0, 0.01], "maxIter": [50, 100]},
    "dt": {"maxDepth": [0, 5]},
    "mlr": {"elasticNetParam": [1.0], "regParam": [100.0, 0.01], "maxIter": [50, 100]},
}


@query
def signal_cv_results(spark, sf_dir):
    """Every grid point's parameters, mean metric and choice in three searches."""
    inputs = _signal_pair(spark, sf_dir)
    parts = []
    for kind, grid in SIGNAL_GRIDS.items():
        label = "review_score" if kind in models.MULTICLASS else "Target"
        found = models.fit_cv(kind, inputs[label].fit, label, grid=grid)
        parts.append(models.cv_results(spark, found).select(F.lit(kind).alias("model"), "*"))
    return reduce(DataFrame.unionByName, parts).withColumn("mean_metric", F.round("mean_metric", 9))


def _signal_pair(spark, sf_dir) -> dict[str, workflow.Prepared]:
    """Inputs for both labels, and those of the linear machine, from one base table."""
    spec, train, _ = workflow.basetables(spark, sf_dir, holdout=False)
    train = workflow.materialize(train)
    labelled = _by_category(_by_weekend(train))
    labels = ("Target", "review_score")
    moments = workflow.base_moments(labelled, labels)
    inputs = {y: workflow.prepare_base(labelled, None, y, spec=spec, materialized=True, moments=moments) for y in labels}
    return inputs | {"svm": workflow.prepare_base(_spread(train), None, "Target", spec=spec, materialized=True)}


def _comparison(inputs: dict[str, workflow.Prepared], spark) -> tuple[DataFrame, DataFrame]:
    """All learners on their inputs: (model, metric, value), and every search's grid points."""
    results, searches = {}, []
    for kinds, label in ((workflow.BINARY_KINDS, "Target"), (workflow.MULTICLASS_KINDS, "review_score")):
        for kind in kinds:
            model, scored = workflow.fit_and_score(inputs.get(kind, inputs[label]), kind, label)
            results[kind] = metrics.evaluate(scored, label=label, kind="binary" if label == "Target" else "multiclass")
            if kind != "gbt":
                searches.append(models.cv_results(spark, model).withColumn("model", F.lit(kind)))
    return metrics.compare_models(spark, results), reduce(DataFrame.unionByName, searches)


@query
def model_comparison(spark, sf_dir):
    """All seven learners on the fixtures' own labels; one base table for both labels."""
    spec, train, _ = workflow.basetables(spark, sf_dir, holdout=False)
    train = workflow.materialize(train)
    labels = ("Target", "review_score")
    moments = workflow.base_moments(train, labels)
    inputs = {y: workflow.prepare_base(train, None, y, spec=spec, on_empty="all", materialized=True, moments=moments) for y in labels}
    return _comparison(inputs, spark)[0]


@query
def signal_model_comparison(spark, sf_dir):
    """All seven learners and the six searches over the source's grids on labels that features explain
    but for noise: every metric, and every search's best mean metric with its grid size."""
    compared, searches = _comparison(_signal_pair(spark, sf_dir), spark)
    points = F.count(F.lit(1)).cast("double").alias("grid points")
    best = F.max(F.when(F.col("best"), F.col("mean_metric"))).alias("best mean")
    per = searches.groupBy("model").agg(points, best).unpivot("model", ["grid points", "best mean"], "metric", "value")
    return compared.unionByName(per).withColumn("value", F.round("value", 9))


@query
def score_output(spark, sf_dir):
    """Final model (random forest chosen by CV) applied to the hold-out, written and read back."""
    p = workflow.prepare_inputs(spark, sf_dir, holdout=True, on_empty="all")
    model, _ = workflow.fit_and_score(p, "rf")
    return workflow.predict_holdout(p, model, scratch_path(spark, "predictions"))


@query
def signal_score_output(spark, sf_dir):
    """The same on a label that a feature explains."""
    p = _signal_inputs(spark, sf_dir, holdout=True)
    model, _ = workflow.fit_and_score(p, "rf")
    return workflow.predict_holdout(p, model, scratch_path(spark, "predictions"))


@query
def signal_score_reloaded(spark, sf_dir):
    """The same, by a flow that was saved and loaded again."""
    p = _signal_inputs(spark, sf_dir)
    path = scratch_path(spark, "flow")
    workflow.save_flow(p, workflow.fit_and_score(p, "dt")[0], path)
    flow = workflow.load_flow(spark, path)
    return flow.predict(fixtures.tables(spark, sf_dir, "holdout"), scratch_path(spark, "predictions"))
