"""Preparation, models and metrics on a small labelled frame (small grids, two folds)."""

from __future__ import annotations

import numpy as np
import pytest

from orderlens.plans import metrics, models, prepare

FEATS = ["x", "z"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(11)
    rows = []
    for i in range(600):
        x, z = float(rng.normal()), float(rng.normal())
        rows.append(
            (
                i,
                x,
                z,
                float(x > 0),
                float(1 + (x > -1) + (x > -0.3) + (x > 0.3) + (x > 1)),
                ["Short name", "Long name", "Medium name"][i % 3],
                ["Short description", "Medium description"][i % 2],
                ["Minimal", "Moderate", "Abundant"][i % 3],
            )
        )
    df = spark.createDataFrame(
        rows,
        "order_id long, x double, z double, Target double, review_score double, name_length string, "
        "description_length string, nbr_photo string",
    )
    pipe = prepare.fit_prepare(df, FEATS)
    return pipe, pipe.transform(df)


def test_split_is_key_only(spark, data):
    _, df = data
    a = sorted(r.order_id for r in prepare.hash_split(df)[0].collect())
    b = sorted(r.order_id for r in prepare.hash_split(df.repartition(5))[0].collect())
    assert a == b and 0.6 < len(a) / 600 < 0.8


def test_pipeline_fitted_once_handles_unseen(spark, data):
    pipe, _ = data
    new = spark.createDataFrame(
        [(1, 0.5, 0.5, "Huge name", "Short description", "Minimal")],
        "order_id long, x double, z double, name_length string, description_length string, nbr_photo string",
    )
    r = pipe.transform(new).collect()[0]
    assert r.name_length_dum.size == 3 and r.name_length_dum.numNonzeros() == 0  # unseen -> zero vector
    assert r.scaleFeatures.size == 2


def test_rformula_label(spark, data):
    _, df = data
    out = prepare.rformula_label(df.select("order_id", "x", "z", "review_score", "Target"), "Target")
    assert [r.label for r in out.orderBy("order_id").limit(5).collect()] == [
        r.Target for r in df.orderBy("order_id").limit(5).collect()
    ]


def test_gbt_separable_label(spark, data):
    _, df = data
    fit, valid = prepare.hash_split(df)
    m = models.fit_gbt(fit)
    scored = models.score(m, valid, keep=("order_id", "Target"))
    assert scored.count() == valid.count()
    assert metrics.auc(scored, label="Target") > 0.97


def test_cv_is_deterministic_and_picks_best(spark, data):
    _, df = data
    grid = {"regParam": [0.1, 0.01], "maxIter": [20]}
    a = models.fit_cv("lr", df, grid=grid, folds=2)
    b = models.fit_cv("lr", df.repartition(3), grid=grid, folds=2)
    assert a.avgMetrics == pytest.approx(b.avgMetrics, rel=1e-9)
    res = models.cv_results(spark, a).collect()
    best = max(res, key=lambda r: r.mean_metric)
    assert best.best and sum(r.best for r in res) == 1
    assert models.best_params(a)["regParam"] == float(best.params.split("regParam=")[1])


@pytest.mark.parametrize("kind", ["svm", "dt", "rf"])
def test_binary_learners(spark, data, kind):
    _, df = data
    grid = {"svm": {"regParam": [0.01], "maxIter": [20]}, "dt": {"maxDepth": [3]}, "rf": {"maxDepth": [3], "numTrees": [10]}}
    m = models.fit_cv(kind, df, grid=grid[kind], folds=2)
    ev = metrics.evaluate(models.score(m, df, keep=("order_id", "Target")), label="Target")
    assert ev["areaUnderROC"] > 0.9 and set(ev) == set(metrics.BINARY_METRICS)


@pytest.mark.parametrize("kind", ["mlr", "mrf"])
def test_multiclass_learners(spark, data, kind):
    _, df = data
    grid = {"mlr": {"regParam": [0.01], "maxIter": [50]}, "mrf": {"maxDepth": [4], "numTrees": [10]}}
    m = models.fit_cv(kind, df, label="review_score", grid=grid[kind], folds=2)
    scored = models.score(m, df, keep=("order_id", "review_score"))
    ev = metrics.evaluate(scored, label="review_score", kind="multiclass")
    assert ev["accuracy"] > 0.5 and set(ev) == set(metrics.MULTICLASS_METRICS)
    assert set(r.prediction for r in scored.select("prediction").distinct().collect()) <= {1.0, 2.0, 3.0, 4.0, 5.0}


def test_compare_models(spark):
    out = metrics.compare_models(spark, {"a": {"f1": 0.5}, "b": {"f1": 0.75, "accuracy": 1.0}})
    assert sorted(tuple(r) for r in out.collect()) == [("a", "f1", 0.5), ("b", "accuracy", 1.0), ("b", "f1", 0.75)]


def test_metrics_match_hand_counts(spark):
    rows = [(1.0, 0.9, 1.0), (1.0, 0.8, 1.0), (0.0, 0.7, 1.0), (0.0, 0.1, 0.0), (1.0, 0.2, 0.0)]
    df = spark.createDataFrame(rows, "label double, rawPrediction double, prediction double")
    # AUC by pairs: positives {0.9, 0.8, 0.2} vs negatives {0.7, 0.1}: wins 2+2+1 = 5 of 6
    assert metrics.auc(df) == pytest.approx(5 / 6)
    m = metrics.evaluate(df, kind="multiclass")
    assert m["accuracy"] == pytest.approx(3 / 5)
    # class 1: p=2/3 r=2/3, class 0: p=1/2 r=1/2 ; weights 3/5, 2/5
    assert m["weightedPrecision"] == pytest.approx(0.6 * 2 / 3 + 0.4 * 0.5)
    assert m["f1"] == pytest.approx(0.6 * 2 / 3 + 0.4 * 0.5)


def test_metrics_take_one_job(spark, data):
    _, df = data
    pred = df.selectExpr("Target as label", "Target as prediction")
    sc = spark.sparkContext
    sc.setJobGroup("one-job", "metrics")
    try:
        assert metrics.evaluate(pred, kind="multiclass") == {m: 1.0 for m in metrics.MULTICLASS_METRICS}
        jobs = sc.statusTracker().getJobIdsForGroup("one-job")
        actions = {tuple(sc.statusTracker().getJobInfo(j).stageIds) for j in jobs}
        assert len(actions) <= 2  # the map stage and the result, as adaptive execution submits them
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
