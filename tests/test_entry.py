"""Driver contract: entry() at sf0.001 and the registry's shape."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_mod
from conftest import SF001


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns[:3] == ["order_id", "product_id", "customer_id"]
    ids = [r.order_id for r in rows]
    assert len(ids) == len(set(ids))  # one row per order


def test_registry_covers_inventory():
    q = entry_mod.queries()
    for name in ("basetable_train", "pearson_screen", "model_gbt", "score_output", "cv_results", "metric_auc", "signal_svm"):
        assert name in q


def test_rows_only_queries_run_small(spark):
    q = entry_mod.queries()
    sel = q["select_features"](spark, SF001).collect()
    assert sel and all(r.selected in (True, False) for r in sel)
    scored = q["model_gbt"](spark, SF001)
    assert scored.columns == ["order_id", "Target", "prediction"] and scored.count() > 0


def test_whole_flow_small_grids(spark):
    from orderlens.plans import workflow
    from orderlens.session import scratch_path
    from orderlens.sources import fixtures

    shared = fixtures.scans(spark, SF001)
    train = fixtures.tables(spark, SF001, "train", shared)
    hold = fixtures.tables(spark, SF001, "holdout", shared)
    hold.pop("order_reviews", None)
    small = {
        "lr": {"regParam": [0.1], "maxIter": [10]},
        "dt": {"maxDepth": [3]},
        "mlr": {"regParam": [0.1], "maxIter": [10]},
    }
    out = workflow.run_flow(
        spark, train, hold, scratch_path(spark, "flow"), ("lr", "dt"), ("mlr",), final="dt", grids=small, folds=2, on_empty="all"
    )
    comp = out.comparison.collect()
    assert {r.model for r in comp} == {"lr", "dt", "mlr"} and len(comp) == 12
    n_pred = out.predictions.count()
    assert n_pred > 0 and sum(r["count"] for r in out.prediction_counts.collect()) == n_pred


def test_screen_without_a_selection_is_explicit(spark):
    from orderlens.plans import workflow

    with pytest.raises(ValueError, match="no feature passes"):
        workflow.prepare_inputs(spark, SF001)


def test_base_table_is_computed_once_per_flow(spark, monkeypatch):
    from orderlens.plans import workflow
    from orderlens.session import scratch_path
    from orderlens.sources import fixtures

    made = []
    once = workflow.materialize
    monkeypatch.setattr(workflow, "materialize", lambda df: made.append(1) or once(df))
    train, hold = (fixtures.tables(spark, SF001, side) for side in ("train", "holdout"))
    out = workflow.run_flow(spark, train, hold, scratch_path(spark, "flow"), ("gbt",), ("mrf",), "gbt", {"mrf": {"maxDepth": [2], "numTrees": [3]}}, 2, "all")
    assert made == [1]
    for side in (out.binary, out.multiclass):
        plan = side.fit._jdf.queryExecution().optimizedPlan().toString()
        assert "Aggregate" not in plan and "basetable" in str(side.fit.inputFiles())


def test_base_table_independent_of_partitioning(spark):
    from orderlens.operators import basetable
    from orderlens.sources import fixtures

    t = fixtures.tables(spark, SF001, "train")
    spec = basetable.fit_spec(t)
    want = sorted(tuple(r) for r in basetable.build_basetable(t, spec).collect())
    shuffled = {name: df.repartition(7) for name, df in t.items()}
    got = sorted(tuple(r) for r in basetable.build_basetable(shuffled, spec).collect())
    assert got == want and len(want) > 0
