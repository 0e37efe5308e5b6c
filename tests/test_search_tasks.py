"""Tasks and fits of a tree search follow the cluster and what the learner keeps, not the rows alone."""

from __future__ import annotations

import numpy as np
import pytest

from orderlens.plans import models, prepare, search


@pytest.mark.parametrize("trees", [1, 100])
def test_tasks_are_few_and_bounded(trees):
    assert [search.tasks_for(n, 12, trees) for n in (0, 1, 50_000, 50_001, 600_000)] == [1, 1, 1, 2, 12]
    for rows in (2_570_000, 15_400_000, 154_000_000):
        tasks = search.tasks_for(rows, 12, trees)
        assert tasks % 12 == 0 and tasks < rows / search.ROWS_PER_TASK
        assert rows / tasks * (search.ROW_BYTES + search.TREE_BYTES * trees) <= search.TASK_BYTES


def test_fits_at_once_keep_the_cores_busy():
    assert [search.fits_at_once(t, 12, 8) for t in (1, 3, 6, 12, 120)] == [8, 8, 4, 2, 2]
    assert search.fits_at_once(120, 12, 1) == 1


def test_kept_nodes_leave_the_forest_as_it_is(spark):
    rows = [(i, float(i % 7), float(i * 37 % 101), float((i * 37 % 101 > 50) ^ (i % 9 == 0))) for i in range(400)]
    df = spark.createDataFrame(rows, "order_id long, x double, z double, Target double")
    data = prepare.fit_prepare(df, ["x", "z"], bins=()).transform(df).select("order_id", "Target", prepare.FEATURES)
    found = models.fit_cv("rf", data, grid={"maxDepth": [4], "numTrees": [5]}, folds=2)
    assert found.bestModel.getCacheNodeIds()
    plain = models.learner("rf", "Target").setMaxDepth(4).setNumTrees(5).fit(data.coalesce(1))
    assert found.bestModel.toDebugString.split("\n", 1)[1] == plain.toDebugString.split("\n", 1)[1]


def test_passes_read_a_written_frame_in_few_tasks(spark, monkeypatch):
    frames, top = [], search._top_model
    monkeypatch.setattr(search, "_top_model", lambda est, train, *rest: frames.append(train) or top(est, train, *rest))
    at_once, asked = search.fits_at_once, []
    monkeypatch.setattr(search, "fits_at_once", lambda *a: asked.append(at_once(*a)) or asked[-1])
    df = spark.range(0, 160_000, 1, 8).selectExpr("id as order_id", "double(id % 7) as x", "double(id % 7 + id % 3 > 4) as Target")
    data = prepare.fit_prepare(df, ["x"], bins=()).transform(df)
    found = models.fit_cv("svm", data, grid={"regParam": [0.1], "maxIter": [1]}, folds=2)
    assert found.scores.count() == 160_000 and len(frames) == 2
    for train in frames:
        assert train.rdd.getNumPartitions() == 1 and not train.storageLevel.useMemory
        assert "InMemoryRelation" not in train._jdf.queryExecution().toString() and train.inputFiles()
    assert asked == [8]
    assert search.fits_at_once(39, 24, 8) == 2  # 19,300,000 rows on 12 cores


@pytest.mark.parametrize("kind,label", [("rf", "Target"), ("mrf", "review_score")])
def test_smaller_depths_of_a_forest_are_cut_from_the_deepest(spark, monkeypatch, kind, label):
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(900, 4)), 2)
    y = ((x[:, 0] * x[:, 1] > 0) ^ (rng.random(900) < 0.2)) * 1.0
    rows = [(i, *map(float, x[i]), float(y[i]), float(1 + 2 * y[i] + (x[i, 2] > 0))) for i in range(900)]
    df = spark.createDataFrame(rows, "order_id long, a double, b double, c double, d double, Target double, review_score double")
    data = prepare.fit_prepare(df, list("abcd"), bins=()).transform(df).select("order_id", label, prepare.FEATURES).coalesce(1).cache()
    grid = {"maxDepth": [0, 2, 3, 7], "numTrees": [3, 12]}
    alone = models.fit_cv(kind, data, label, grid=grid, folds=2)  # one task
    monkeypatch.setattr(search, "ROWS_PER_TASK", 300)
    cut = models.fit_cv(kind, data, label, grid=grid, folds=2)
    kept, search_memory = search._same_levels, []
    monkeypatch.setattr(search, "_same_levels", lambda model, depth: search_memory.append(kept(model, depth)) or depth == 2)
    part = models.fit_cv(kind, data, label, grid=grid, folds=2)  # other depths as if their levels passed the memory
    assert (alone.fits, cut.fits, part.fits) == (17, 5, 13) and all(search_memory)
    want = sorted(map(str, alone.scores.collect()))
    assert len(want) == 8 * 900 and len(set(alone.avgMetrics)) > 4
    for found in (cut, part):
        assert sorted(map(str, found.scores.collect())) == want and found.avgMetrics == alone.avgMetrics
        assert found.bestModel.toDebugString.split("\n", 1)[1] == alone.bestModel.toDebugString.split("\n", 1)[1]


def test_levels_beyond_the_learners_memory_are_not_cut(spark):
    df = spark.range(200).selectExpr("id as order_id", "double(id % 7) as x", "double(id % 5 > 2) as Target")
    data = prepare.fit_prepare(df, ["x"], bins=()).transform(df)
    model = models.learner("rf", "Target").setNumTrees(2).setMaxDepth(3).fit(data)
    # 2 trees x 1 feature x 32 bins x 2 classes x 8 bytes = 1 KiB for the root's level; 256 MiB at 2**18 nodes of a tree
    assert [search._same_levels(model, d) for d in (0, 1, 5, 19, 20)] == [True, True, True, True, False]
