"""Forests grown for all folds together: their draws, splits, cuts and the model made of them."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from orderlens.plans import forest, models, prepare, search


def _frame(spark, label, n=1200, parts=4):
    rng = np.random.default_rng(11)
    x = np.round(rng.normal(size=(n, 5)), 2)
    y = ((x[:, 0] * x[:, 1] > 0) ^ (rng.random(n) < 0.15)) * 1.0
    rows = [(i, *map(float, x[i]), float(y[i]), float(1 + 2 * y[i] + (x[i, 2] > 0))) for i in range(n)]
    df = spark.createDataFrame(rows, "order_id long, a double, b double, c double, d double, e double, Target double, review_score double")
    return prepare.fit_prepare(df, list("abcde"), bins=()).transform(df).select("order_id", label, prepare.FEATURES).repartition(parts).cache()


@pytest.mark.parametrize("kind,label", [("rf", "Target"), ("mrf", "review_score")])
def test_one_growing_serves_the_grid(spark, monkeypatch, kind, label):
    monkeypatch.setattr(search, "ROWS_PER_TASK", 300)
    monkeypatch.setattr(forest, "TASK_ROWS", 200)
    monkeypatch.setattr(forest, "BLOCK_ROWS", 90)
    data = _frame(spark, label)
    found = models.fit_cv(kind, data, label, grid={"maxDepth": [0, 2, 6], "numTrees": [4, 15]}, folds=3)
    assert found.fits == 4  # one for each fold, one of the chosen point
    assert found.scores.count() == 6 * 1200 and len(set(found.avgMetrics)) > 3
    want = {}
    for i in {2, found.best}:  # a point alone, on other partitions, counted in small pieces
        point = found.grid[i]
        monkeypatch.setattr(forest, "PIECE", 3)
        monkeypatch.setattr(forest, "CELLS", 1)
        alone = models.fit_cv(kind, data.repartition(7), label, grid={k: [v] for k, v in point.items()}, folds=3)
        assert alone.avgMetrics == pytest.approx([found.avgMetrics[i]], abs=1e-12)
        want[i] = sorted(alone.scores.drop("grid_point").collect(), key=str)
        if i == found.best:
            assert alone.bestModel.toDebugString.split("\n", 1)[1] == found.bestModel.toDebugString.split("\n", 1)[1]
    for i, rows in want.items():
        assert sorted(found.scores.where(f"grid_point = {i}").drop("grid_point").collect(), key=str) == rows
    # as good as Spark's own forests on the same folds
    monkeypatch.setattr(forest, "grown_here", lambda *a: False)
    plain = models.fit_cv(kind, data, label, grid={"maxDepth": [6], "numTrees": [15]}, folds=3)
    assert abs(plain.avgMetrics[0] - found.avgMetrics[5]) < 0.05 and found.avgMetrics[5] > found.avgMetrics[0] + 0.1


def test_the_model_is_the_forest(spark, tmp_path):
    data = prepare.with_folds(_frame(spark, "review_score"), 2, "order_id")
    rows = forest.rows_of(data, "review_score", prepare.FEATURES, "order_id")
    n, classes = data.count(), forest.classes_of(data, "review_score")
    grown = forest.grow(forest.binned(rows, n, [None], classes, 32), 9, 7, 5)
    model = forest.as_model(models.learner("mrf", "review_score"), grown, 6, 4, 5)
    assert (model.getNumTrees, model.numFeatures, model.numClasses, model.getMaxDepth()) == (6, 5, 5, 4)
    model.save(str(tmp_path / "model"))
    own = forest.Forests(grown.trees * 2, forest.Binned(rows, [0, 1], grown.data.thresholds * 2, classes, grown.data.bins, 1), 5)
    got = forest.scored(rows, own, [(6, 4)], 5, True).select("order_key", "score", "prediction")
    raw = model.transform(data).select(F.col("order_id").cast("string"), vector_to_array("rawPrediction")[1], "prediction")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, raw.collect()))


def test_splits_equal_those_by_all_rows(spark):
    """Every node of a tree against its rows, split by split."""
    data = prepare.with_folds(_frame(spark, "Target", 300), 3, "order_id")
    rows = forest.rows_of(data, "Target", prepare.FEATURES, "order_id")
    seed, cut = 42, 0
    binned = forest.binned(rows, 300, [cut, 1], [0.0, 1.0], 8)
    tree = forest.grow(binned, 3, 4, seed).trees[0][2]
    got = rows.toPandas()
    x, y = np.stack(got["x"]), got["label"].to_numpy().astype(int)
    weight = forest.row_draws(got["h"].to_numpy().view(np.uint64), seed, 2) * (got["fold"].to_numpy() != cut)
    node, count = np.zeros(len(x), int), lambda keep: np.array([weight[keep & (y == c)].sum() for c in (0, 1)])
    for level in range(5):
        nodes = np.flatnonzero(tree.level == level)
        tried = 0
        for at in nodes:
            here = node == at
            assert list(count(here)) == list(tree.counts[at])
            if level == 4 or (tree.counts[at] > 0).sum() == 1 and level:
                assert tree.bin[at] < 0
                continue
            gini = lambda c: 1 - ((c / max(c.sum(), 1)) ** 2).sum()
            gains = {}
            for f in forest.feature_draws(seed, 2, level, 16, 5)[tried]:
                for b, t in enumerate(binned.thresholds[0][f]):
                    a, z = count(here & (x[:, f] <= t)), count(here & (x[:, f] > t))
                    if a.sum() and z.sum():
                        gains[f, b] = gini(a + z) - (a.sum() * gini(a) + z.sum() * gini(z)) / (a + z).sum()
            tried += 1
            best = max(gains.values(), default=0)
            if best <= 1e-12:
                assert tree.bin[at] < 0 or tree.gain[at] < 1e-12
                continue
            f, b = tree.feature[at], tree.bin[at]
            assert tree.gain[at] == pytest.approx(best) and gains[f, b] == pytest.approx(best)
            node[here] = tree.left[at] + (x[here, f] > binned.thresholds[0][f][b])
    assert len(tree.bin) > 11


def test_thresholds_by_the_learners_rule():
    def plain(values, splits):
        distinct, count = np.unique(values, return_counts=True)
        if len(distinct) - 1 <= splits:
            return [(a + b) / 2 for a, b in zip(distinct, distinct[1:])]
        out, stride, now = [], len(values) / (splits + 1), count[0]
        target = stride
        for i in range(1, len(distinct)):
            before, now = now, now + count[i]
            if abs(before - target) < abs(now - target):
                out.append((distinct[i - 1] + distinct[i]) / 2)
                target += stride
        return out

    rng = np.random.default_rng(2)
    for values in (rng.normal(size=999), np.round(rng.exponential(size=3000), 1), np.repeat([1.0, 2.0, 5.0], [5, 900, 1]), np.ones(7), np.where(rng.random(2000) < 0.9, 0.0, rng.random(2000))):
        for bins in (3, 32):
            assert list(forest.thresholds_of(values, bins)) == pytest.approx(plain(values, bins - 1))


def test_row_draws_are_poisson():
    keys = np.random.default_rng(1).integers(0, 2**63, 200_000).astype(np.uint64)
    a, b = (forest.row_draws(keys, 123, t).astype(float) for t in (0, 1))
    for n, share in enumerate((0.36788, 0.36788, 0.18394, 0.06131, 0.01533)):
        assert (a == n).mean() == pytest.approx(share, abs=0.005)
    assert abs(np.corrcoef(a, b)[0, 1]) < 0.01 and a.var() == pytest.approx(1, abs=0.02)


def test_other_learners_stay_with_spark():
    points = [{"maxDepth": 5, "numTrees": 20}]
    assert forest.grown_here(models.learner("rf", "Target"), points)
    assert not forest.grown_here(models.learner("dt", "Target"), points)
    assert not forest.grown_here(models.learner("rf", "Target").setImpurity("entropy"), points)
    assert not forest.grown_here(models.learner("rf", "Target"), [{"numTrees": 1}])
    assert not forest.grown_here(models.learner("rf", "Target"), [{"maxBins": 8}])
    assert [forest.tasks_for(n, 12, 200) for n in (0, 20_000, 20_001, 10**6, 10**7, 10**9)] == [1, 1, 2, 12, 36, 2988]
