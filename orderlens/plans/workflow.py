"""End-to-end flows: tables -> base tables -> screen -> prepared inputs -> models -> scores.

Two ways in: the source CSV files (``read_sources``: five training tables and four hold-out
twins) or the fixture views over the driver's Parquet tables (``basetables``). Both go through
the same functions afterwards.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.functions import derive
from orderlens.operators import basetable, screen
from orderlens.plans import models, prepare
from orderlens.session import configure, cut_lineage, scratch_path
from orderlens.sources import fixtures, tables

TABLE_NAMES = ("products", "orders", "order_items", "order_payments", "order_reviews")


def read_sources(spark: SparkSession, paths: dict[str, str], multiline: Sequence[str] | dict = ()) -> dict[str, DataFrame]:
    """The order tables from CSV files, keyed by table name (``products``, ``orders``,
    ``order_items``, ``order_payments`` and, on the training side, ``order_reviews``);
    ``multiline`` names those whose files hold quoted newlines, or maps such names to "split" where
    the files are large."""
    configure(spark)
    how = multiline if isinstance(multiline, dict) else dict.fromkeys(multiline, True)
    return {name: tables.read_source(spark, name, path, how.get(name, False)) for name, path in paths.items()}


def basetables_from(
    train: dict[str, DataFrame],
    holdout: dict[str, DataFrame] | None = None,
    weekend_days: Sequence[int] = derive.WEEKEND_DAYS,
    spec: basetable.BaseTableSpec | None = None,
) -> tuple[basetable.BaseTableSpec, DataFrame, DataFrame | None]:
    """Base tables of both sides; pivot value lists learned on the training side unless a
    ``spec`` from an earlier run is given (which skips the two value-list scans)."""
    spec = spec or basetable.fit_spec(train, weekend_days)
    hold = basetable.build_basetable(holdout, spec) if holdout is not None else None
    return spec, basetable.build_basetable(train, spec), hold


def basetables(
    spark: SparkSession, sf_dir: str, holdout: bool = True
) -> tuple[basetable.BaseTableSpec, DataFrame, DataFrame | None]:
    """Training and (unless ``holdout=False``) hold-out base tables of the fixture data."""
    shared = fixtures.scans(spark, sf_dir)
    hold = fixtures.tables(spark, sf_dir, "holdout", shared) if holdout else None
    return basetables_from(fixtures.tables(spark, sf_dir, "train", shared), hold)


@dataclass
class Prepared:
    spec: basetable.BaseTableSpec | None
    features: list
    screen: DataFrame
    pipeline: PipelineModel
    fit: DataFrame  # 70% of training orders
    valid: DataFrame  # the other 30%
    holdout: DataFrame | None  # unlabelled side, transformed by the training pipeline


def materialize(df: DataFrame) -> DataFrame:
    """Write a frame once as Parquet in the shared folder and read it back: computed once, columns
    pruned by every later pass, nothing lost with an executor."""
    path = scratch_path(df.sparkSession, "basetable")
    tables.save_table(df, path)
    return tables.load_table(df.sparkSession, path)


def base_moments(train: DataFrame, labels: Sequence[str], features: Sequence[str] | None = None) -> DataFrame:
    """The moment state of a base table for all ``labels``, computed once (a row per feature)."""
    cands = screen.candidate_features(train, labels[0]) if features is None else features
    return cut_lineage(screen.moment_state(train, cands, labels))


def prepare_base(
    train: DataFrame,
    holdout: DataFrame | None = None,
    label: str = "Target",
    features: Sequence[str] | None = None,
    spec: basetable.BaseTableSpec | None = None,
    on_empty: str = "error",
    materialized: bool = False,
    moments: DataFrame | None = None,
) -> Prepared:
    """Training base table written once (unless ``materialized``: it is a scan already) ->
    one-pass screen -> selected features, or the given list -> pipeline fitted on training only -> hash split 70/30. When no candidate passes the
    screen, ``on_empty`` decides: "error", or "all" to keep every candidate. The screen and the
    scaler share one scan; ``moments`` (from ``base_moments``) shares it between labels too."""
    if on_empty not in ("error", "all"):
        raise ValueError(f"on_empty is 'error' or 'all', not {on_empty!r}")
    train = train if materialized else materialize(train)
    cands = screen.candidate_features(train, label)
    if moments is None:
        moments = base_moments(train, [label], [*cands, *[f for f in features or () if f not in cands]])
    scr = screen.screen_of(moments.where(F.col("feature").isin(cands)), label)
    chosen = screen.selected_names(scr) if features is None else list(features)
    if not chosen:
        if on_empty == "error":
            raise ValueError(f"no feature passes the screen for {label}; give features, or on_empty='all'")
        chosen = cands
    pipe = prepare.fit_prepare(train, chosen, deviations=screen.deviations(moments, chosen))
    fit, valid = prepare.hash_split(pipe.transform(train))
    hold = pipe.transform(holdout) if holdout is not None else None
    return Prepared(spec, chosen, scr, pipe, fit, valid, hold)


def prepare_inputs(
    spark: SparkSession,
    sf_dir: str,
    label: str = "Target",
    features: Sequence[str] | None = None,
    holdout: bool = False,
    on_empty: str = "error",
    relabel: Callable[[DataFrame], DataFrame] = lambda base: base,
) -> Prepared:
    """``prepare_base`` over the fixture base tables; ``relabel`` may replace the labels."""
    spec, train, hold = basetables(spark, sf_dir, holdout)
    return prepare_base(relabel(materialize(train)), hold, label, features, spec, on_empty, materialized=True)


def fit_and_score(p: Prepared, kind: str, label: str = "Target", grid: dict | None = None, folds: int = models.FOLDS):
    """Fit one learner on the 70% (searched by CV unless it is GBT); score the 30%."""
    if kind == "gbt":
        model = models.fit_gbt(p.fit, label)
    else:
        model = models.fit_cv(kind, p.fit, label, grid=grid, folds=folds)
    return model, models.score(model, p.valid, keep=("order_id", label))


def save_flow(p: Prepared, model, path: str) -> None:
    """Keep all that scoring needs: one pipeline (bins to scaled features, then the classifier),
    the pivot value lists and the feature list."""
    best = getattr(model, "bestModel", model)
    PipelineModel([*p.pipeline.stages, best]).write().overwrite().save(f"{path}/pipeline")
    row = [(list(p.spec.payment_types), list(p.spec.categories), list(p.spec.weekend_days), list(p.features))]
    spark = p.fit.sparkSession
    lists = spark.createDataFrame(row, "payment_types array<string>, categories array<string>, weekend_days array<int>, features array<string>")
    lists.write.mode("overwrite").parquet(f"{path}/lists")


@dataclass
class SavedFlow:
    spec: basetable.BaseTableSpec
    features: list
    pipeline: PipelineModel  # ends in the classifier

    def predict(self, holdout: dict[str, DataFrame], path: str) -> DataFrame:
        """Base table of the given tables -> predictions written to ``path``."""
        base = basetable.build_basetable(holdout, self.spec)
        return tables.save_predictions(self.pipeline.transform(base), path)


def load_flow(spark: SparkSession, path: str) -> SavedFlow:
    """A flow saved by ``save_flow``, in this or another session."""
    r = spark.read.parquet(f"{path}/lists").first()
    spec = basetable.BaseTableSpec(tuple(r.payment_types), tuple(r.categories), tuple(r.weekend_days))
    return SavedFlow(spec, list(r.features), PipelineModel.load(f"{path}/pipeline"))


def predict_holdout(p: Prepared, model, path: str) -> DataFrame:
    """Score the hold-out with a fitted model; write (order_id, pred_review_score) to ``path``."""
    if p.holdout is None:
        raise ValueError("no hold-out side was prepared")
    return tables.save_predictions(model.transform(p.holdout), path)


BINARY_KINDS = ("gbt", "lr", "rf", "svm", "dt")
MULTICLASS_KINDS = ("mlr", "mrf")


@dataclass
class FlowResult:
    spec: basetable.BaseTableSpec
    binary: Prepared
    multiclass: Prepared
    models: dict  # learner kind -> fitted model (CV models for all but GBT)
    comparison: DataFrame  # (model, metric, value) on the 30% validation orders
    predictions: DataFrame  # (order_id, pred_review_score) of the hold-out, as written
    prediction_counts: DataFrame  # (pred_review_score, count)


def run_flow(
    spark: SparkSession,
    train: dict[str, DataFrame],
    holdout: dict[str, DataFrame],
    output: str,
    binary_kinds: Sequence[str] = BINARY_KINDS,
    multiclass_kinds: Sequence[str] = MULTICLASS_KINDS,
    final: str = "rf",
    grids: dict | None = None,
    folds: int = models.FOLDS,
    on_empty: str = "error",
) -> FlowResult:
    """The whole source flow in one call: base tables of both sides (the training one computed
    once, for both labels), the binary and the 1-5 screens, every learner (CV over the source's grids unless ``grids`` overrides them),
    their validation metrics, and the ``final`` learner's hold-out predictions written to
    ``output`` with their class counts."""
    from orderlens.operators.rollup import value_counts
    from orderlens.plans import metrics

    spec, train_base, hold_base = basetables_from(train, holdout)
    grids = grids or {}
    train_base = materialize(train_base)
    moments = base_moments(train_base, ["Target", "review_score"])
    binary = prepare_base(train_base, hold_base, "Target", spec=spec, on_empty=on_empty, materialized=True, moments=moments)
    multi = prepare_base(train_base, None, "review_score", spec=spec, on_empty=on_empty, materialized=True, moments=moments)
    fitted, results = {}, {}
    for kind in binary_kinds:
        fitted[kind], scored = fit_and_score(binary, kind, "Target", grids.get(kind), folds)
        results[kind] = metrics.evaluate(scored, label="Target")
    for kind in multiclass_kinds:
        fitted[kind], scored = fit_and_score(multi, kind, "review_score", grids.get(kind), folds)
        results[kind] = metrics.evaluate(scored, label="review_score", kind="multiclass")
    preds = predict_holdout(binary, fitted[final], output)
    return FlowResult(
        spec, binary, multi, fitted, metrics.compare_models(spark, results), preds, value_counts(preds, "pred_review_score")
    )
