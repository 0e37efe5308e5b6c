"""The grid search against Spark's own cross-validator, on labels no learner gets all right."""

from __future__ import annotations

import duckdb
import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder

from orderlens.plans import metrics, models, prepare, search


@pytest.fixture(scope="module")
def noisy(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(700):
        x, z, u = (float(v) for v in rng.normal(size=3))
        rows.append((i, round(x, 2), round(z, 2), u, float((x * z > 0) ^ (rng.random() < 0.2)), float(1 + (x > 0) + 2 * (z + 0.7 * rng.normal() > 0))))
    df = spark.createDataFrame(rows, "order_id long, x double, z double, u double, Target double, review_score double")
    return prepare.fit_prepare(df, ["x", "z", "u"], bins=()).transform(df).select("order_id", "Target", "review_score", prepare.FEATURES).cache()


def _plain(kind, df, label, grid, folds=3):
    est = models.learner(kind, label)
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(est.getParam(name), values)
    ev = MulticlassClassificationEvaluator(labelCol=label, metricName="f1")
    if kind not in models.MULTICLASS:
        ev = BinaryClassificationEvaluator(labelCol=label, numBins=0)
    data = prepare.with_folds(df, folds).coalesce(1).cache()
    return CrossValidator(estimator=est, estimatorParamMaps=builder.build(), evaluator=ev, numFolds=folds, foldCol="fold", parallelism=4).fit(data)


@pytest.mark.parametrize(
    "kind,label,grid,fits",
    [
        ("lr", "Target", {"regParam": [0.1, 0.001], "maxIter": [1, 2, 50, 100]}, None),
        ("svm", "Target", {"regParam": [0.1, 0.01], "maxIter": [2, 8]}, None),
        ("mlr", "review_score", {"regParam": [0.1, 0.01], "maxIter": [2, 60, 90]}, None),
        ("dt", "Target", {"maxDepth": [0, 1, 3, 5, 10]}, 4),
        ("rf", "Target", {"maxDepth": [2, 4], "numTrees": [3, 6]}, 13),
        ("mrf", "review_score", {"maxDepth": [2], "numTrees": [3, 6]}, 7),
    ],
)
def test_search_equals_the_plain_search(spark, noisy, kind, label, grid, fits):
    ours, plain = models.fit_cv(kind, noisy, label, grid=grid, folds=3), _plain(kind, noisy, label, grid)
    assert ours.avgMetrics == pytest.approx(list(plain.avgMetrics), abs=1e-9)
    assert len(set(np.round(ours.avgMetrics, 6))) > 1 and all(0 < m < 1 for m in ours.avgMetrics)
    assert ours.fits == fits if fits else ours.fits <= 3 * len(ours.grid) + 1 - (6 if kind == "lr" else 0)
    assert models.best_params(ours) == ours.grid[ours.best]
    a, b = (models.score(m, noisy).select("order_id", "prediction").collect() for m in (ours, plain))
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_cut_trees_are_the_trees_fitted_at_that_depth(spark, noisy):
    data = noisy.coalesce(1).cache()
    for label in ("Target", "review_score"):
        deep = models.learner("dt", label).copy().setMaxDepth(12).fit(data)
        nodes = search.tree_nodes(deep)
        placed = {r.order_id: int(r.leaf) for r in deep.setLeafCol("leaf").transform(data).collect()}
        for depth in (0, 1, 2, 4, 7):
            leaves = search.cut_tree(nodes, depth)
            own = models.learner("dt", label).setMaxDepth(depth).fit(data).transform(data).collect()
            assert all(leaves[placed[r.order_id]] == list(r.rawPrediction) for r in own), depth


def test_settled_path_stands_for_larger_limits(spark, noisy):
    data = noisy.coalesce(1).cache()
    est = models.learner("lr", "Target").setRegParam(0.01)
    full = est.copy().setMaxIter(100).fit(data)
    k = search.iterations(full)
    assert 1 < k < 100
    same = est.copy().setMaxIter(k).fit(data)
    assert np.array_equal(same.coefficients, full.coefficients)
    assert not np.array_equal(est.copy().setMaxIter(k - 1).fit(data).coefficients, full.coefficients)


def test_metrics_of_the_score_table_equal_sql(spark, noisy):
    found = models.fit_cv("dt", noisy, grid={"maxDepth": [0, 2, 6]}, folds=3)
    scores = found.scores.toPandas()  # noqa: F841  read by the SQL
    auc = """
        SELECT grid_point, fold, (sum(r) FILTER (WHERE label = 1) - p * (p + 1) / 2) / (p * n) AS v FROM (
            SELECT *, rank() OVER g + (count(*) OVER t - 1) / 2.0 AS r, count(*) FILTER (WHERE label = 1) OVER w AS p, count(*) FILTER (WHERE label = 0) OVER w AS n
            FROM scores WINDOW g AS (PARTITION BY grid_point, fold ORDER BY score), t AS (PARTITION BY grid_point, fold, score), w AS (PARTITION BY grid_point, fold))
        GROUP BY grid_point, fold, p, n"""
    want = {(a, b): v for a, b, v in duckdb.connect().execute(auc).fetchall()}
    got = {(r.grid_point, r.fold): r.value for r in found.foldMetrics.collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-12) for k in got)
    assert len(scores) == 3 * noisy.count()
    for metric in ("f1", "accuracy", "weightedPrecision", "weightedRecall"):
        values = {(r.grid_point, r.fold): r.value for r in metrics.grouped(found.scores, ["grid_point", "fold"], metric).collect()}
        for (point, fold), v in values.items():
            part = found.scores.where(f"grid_point = {point} and fold = {fold}")
            assert v == pytest.approx(metrics.classification(part, "label")[metric], abs=1e-12)


def test_area_over_many_partitions(spark):
    rng = np.random.default_rng(1)
    rows = [(int(g), float(y), float(round(s, 1)) + 0.0) for g, y, s in zip(rng.integers(0, 3, 4000), rng.integers(0, 2, 4000), rng.normal(size=4000), strict=True)]
    df = spark.createDataFrame(rows, "g int, label double, score double")
    for r in metrics.grouped(df, ["g"], "areaUnderROC").collect():
        assert r.value == pytest.approx(metrics.auc(df.where(f"g = {r.g}"), raw="score"), abs=1e-12)
    assert metrics.grouped(df.where("label = 1"), ["g"], "areaUnderROC").first().value is None
