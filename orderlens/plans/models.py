"""Classifiers, grid search with k-fold cross-validation, scoring and parameter reports.

Grids, fold count and metrics are the source's; seeds are fixed (the source left them to
defaults that change per process), and folds come from a hash of the order id, so a search
gives the same result whatever the partitioning. The search itself is ``plans.search``: grid points
that share work are fitted together, and all metrics come from one table of out-of-fold scores.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.plans.prepare import FEATURES
from orderlens.plans.search import Search, cross_validate, grid_points

SEED = 123
FOLDS = 5
PARALLELISM = 8

# The source's learners and their search grids.
GRIDS = {
    "lr": {"regParam": [0.1, 0.01], "maxIter": [50, 100, 150]},
    "rf": {"maxDepth": [5, 10], "numTrees": [20, 50, 100]},
    "svm": {"regParam": [0.1, 0.01], "maxIter": [50, 100, 150]},
    "dt": {"maxDepth": [5, 10, 15]},
    "mlr": {"regParam": [0.1, 0.01], "maxIter": [50, 100, 150]},
    "mrf": {"maxDepth": [5, 10], "numTrees": [20, 50, 100]},
}
MULTICLASS = frozenset({"mlr", "mrf"})
# The parameter of each learner whose values share work in a search.
NESTED = {"lr": "maxIter", "mlr": "maxIter", "svm": "maxIter", "dt": "maxDepth", "rf": "maxDepth", "mrf": "maxDepth"}


def learner(kind: str, label: str, features: str = FEATURES, seed: int = SEED):
    """The estimator of one learner, with the source's fixed settings."""
    common = {"featuresCol": features, "labelCol": label}
    if kind == "gbt":
        return GBTClassifier(seed=seed, **common)
    if kind in ("lr", "mlr"):
        return LogisticRegression(family="multinomial" if kind == "mlr" else "auto", **common)
    if kind in ("rf", "mrf"):
        return RandomForestClassifier(seed=seed, **common)
    if kind == "svm":
        return LinearSVC(standardization=False, maxIter=10, **common)
    if kind == "dt":
        return DecisionTreeClassifier(maxDepth=5, seed=seed, **common)
    raise ValueError(f"unknown learner {kind}")


def search_metric(kind: str) -> str:
    """Binary learners are chosen by area under ROC, multiclass ones by weighted F1."""
    return "f1" if kind in MULTICLASS else "areaUnderROC"


def fit_gbt(train: DataFrame, label: str = "Target", features: str = FEATURES, seed: int = SEED):
    """Gradient-boosted trees with default settings (20 rounds, depth 5, step 0.1), no search."""
    return learner("gbt", label, features, seed).fit(train)


def fit_cv(
    kind: str,
    train: DataFrame,
    label: str = "Target",
    features: str = FEATURES,
    grid: dict | None = None,
    folds: int = FOLDS,
    seed: int = SEED,
    parallelism: int = PARALLELISM,
    key: str = "order_id",
) -> Search:
    """Grid search with ``folds``-fold cross-validation, refit on all of ``train``."""
    grid = GRIDS[kind] if grid is None else grid
    nested = NESTED.get(kind)
    return cross_validate(
        learner(kind, label, features, seed),
        train.select(key, label, features),
        grid_points(grid),
        label,
        search_metric(kind),
        key=key,
        folds=folds,
        nested=nested if nested in grid else None,
        parallelism=parallelism,
    )


def score(model, df: DataFrame, keep: Sequence[str] = ("order_id",), prediction: str = "prediction") -> DataFrame:
    """Apply a fitted model; keep the listed columns, the prediction and the raw scores."""
    out = model.transform(df)
    extra = [c for c in ("rawPrediction", "probability") if c in out.columns]
    return out.select(*keep, *extra, F.col("prediction").alias(prediction))


CV_SCHEMA = T.StructType(
    [
        T.StructField("grid_point", T.IntegerType()),
        T.StructField("params", T.StringType()),
        T.StructField("metric", T.StringType()),
        T.StructField("mean_metric", T.DoubleType()),
        T.StructField("best", T.BooleanType()),
    ]
)


def _params_text(point: dict) -> str:
    return ", ".join(f"{name}={v}" for name, v in sorted(point.items()))


def cv_results(spark: SparkSession, found: Search) -> DataFrame:
    """One row per grid point: its parameters and mean cross-validated metric."""
    rows = [(i, _params_text(p), found.metric, float(m), i == found.best) for i, (p, m) in enumerate(zip(found.grid, found.avgMetrics, strict=True))]
    return spark.createDataFrame(rows, CV_SCHEMA)


def best_params(found: Search) -> dict:
    """The searched parameters of the chosen model, as the fitted model states them."""
    best = found.bestModel
    return {name: best.getOrDefault(name) for name in found.grid[found.best]}
