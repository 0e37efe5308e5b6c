"""Screening: golden p-values, constant columns, agreement with Spark's F-test selector."""

from __future__ import annotations

import math
from decimal import Decimal, getcontext

import numpy as np
import pytest
from pyspark.ml.feature import UnivariateFeatureSelector, VectorAssembler
from pyspark.sql import functions as F

from orderlens.functions.pvalue import betainc, pearson_pvalue
from orderlens.operators import screen


def test_golden_pvalues():
    p = pearson_pvalue([0.24084489669257736, 0.011094173201461732], [800, 800])
    assert p[0] == pytest.approx(5.0794e-12, rel=1e-4)
    assert p[1] == pytest.approx(0.75404546, rel=1e-7)


def test_pvalue_edges():
    p = pearson_pvalue([0.0, 1.0, -1.0, float("nan"), 0.5], [100, 100, 100, 100, 2])
    assert p[0] == pytest.approx(1.0)
    assert p[1] == 0.0 and p[2] == 0.0
    assert math.isnan(p[3]) and math.isnan(p[4])


def test_betainc_against_closed_forms():
    x = np.linspace(0.01, 0.99, 25)
    assert np.allclose(betainc(1.0, 1.0, x), x)  # uniform
    assert np.allclose(betainc(2.0, 1.0, x), x**2)
    assert np.allclose(betainc(0.5, 0.5, x), 2 / np.pi * np.arcsin(np.sqrt(x)))


def _tail(r: float, n: int) -> float:
    """Two-sided tail for an even number of pairs by the finite sum, in exact decimals."""
    getcontext().prec = 60
    total, term, cos2 = Decimal(0), Decimal(1), 1 - Decimal(r) ** 2
    for k in range((n - 4) // 2 + 1):
        if k:
            term *= Decimal(2 * k - 1) / Decimal(2 * k) * cos2
        total += term
    return float(1 - Decimal(abs(r)) * total)


@pytest.mark.parametrize(("r", "n"), [(0.24, 800), (0.02, 10_000), (0.05, 10_000), (0.004, 200_000)])
def test_pvalue_against_the_finite_sum(r, n):
    assert pearson_pvalue([r], [n])[0] == pytest.approx(_tail(r, n), rel=1e-8)


def test_pvalue_is_one_formula_at_every_size():
    # two-sided t tail next to the normal one: ratio 1 + (t^4 + t^2) * density / (4 df * tail) to first order
    for n in (10**6, 10**6 + 7, 10**7, 10**8):
        t = 3.0
        r = t / math.sqrt(n - 2 + t * t)
        normal = math.erfc(t / math.sqrt(2))
        more = (t**3 + t) * math.exp(-t * t / 2) / math.sqrt(2 * math.pi) / (2 * (n - 2))
        assert pearson_pvalue([r], [n])[0] == pytest.approx(normal + more, rel=2e-8)


def test_unsettled_fraction_is_an_error(monkeypatch):
    monkeypatch.setattr("orderlens.functions.pvalue._MAX_ITER", 3)
    with pytest.raises(ArithmeticError):
        pearson_pvalue([0.01], [100_000])


@pytest.fixture(scope="module")
def frame(spark):
    rows = []
    rng = np.random.default_rng(7)
    for i in range(400):
        x = float(rng.normal())
        noise = float(rng.normal())
        rows.append((i, x, noise, 1.0, x * 2.0 + noise * 0.1, float(x > 0)))
    return spark.createDataFrame(rows, "order_id long, x double, noise double, const double, y double, Target double")


def test_screen_one_pass_values(frame):
    out = {r.feature: r for r in screen.pearson_screen(frame, ["x", "noise", "const"], "y").collect()}
    pdf = frame.toPandas()
    assert out["x"].r == pytest.approx(np.corrcoef(pdf.x, pdf.y)[0, 1], rel=1e-12)
    assert out["noise"].r == pytest.approx(np.corrcoef(pdf.noise, pdf.y)[0, 1], rel=1e-9)
    assert out["const"].r is None and out["const"].p_value is None
    assert out["x"].n == 400


def test_candidates_exclude_ids_and_labels(frame):
    got = screen.candidate_features(frame.withColumn("review_score", F.lit(5.0)), "Target")
    assert got == ["x", "noise", "const", "y"]


def test_selection_matches_spark_f_test_selector(spark, frame):
    feats = ["x", "noise", "const"]
    ours = screen.selected_names(screen.pearson_screen(frame, feats, "y"))
    vec = VectorAssembler(inputCols=feats, outputCol="v").transform(frame)
    sel = UnivariateFeatureSelector(featuresCol="v", labelCol="y", selectionMode="fpr")
    sel.setFeatureType("continuous").setLabelType("continuous").setSelectionThreshold(0.001)
    theirs = [feats[i] for i in sel.fit(vec).selectedFeatures]
    assert ours == theirs == ["x"]


def test_moment_state_serves_both_screens_and_the_scaler(frame):
    from orderlens.plans import prepare

    df = frame.withColumn("review_score", F.when(F.col("order_id") % 7 > 0, F.round("y")))
    df = df.withColumn("gap", F.when(F.col("order_id") % 5 > 0, F.col("noise") * 3))
    feats = ["x", "noise", "const", "gap"]
    state = screen.moment_state(df, feats, ["Target", "review_score"])
    for label in ("Target", "review_score"):
        assert screen.screen_of(state, label).collect() == screen.pearson_screen(df, feats, label).collect()
    plan = state._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ") == 1
    full = ["x", "noise", "const"]
    deviations = screen.deviations(state, full)
    assert deviations[2] == 0.0 and screen.deviations(state.limit(0), []) == []
    ours = prepare.fit_prepare(df, full, bins=(), deviations=deviations).transform(df).orderBy("order_id")
    theirs = prepare.fit_prepare(df, full, bins=()).transform(df).orderBy("order_id")
    a, b = (np.array([r[0].toArray() for r in d.select(prepare.FEATURES).collect()]) for d in (ours, theirs))
    assert np.allclose(a, b, rtol=1e-12, atol=0) and not a[:, 2].any()
    empty = screen.moment_state(df.limit(0), feats, ["Target"])
    assert empty.count() == 0


def test_both_labels_are_prepared_from_one_state(spark, frame):
    from orderlens.plans import workflow

    df = frame.withColumn("review_score", F.round("y"))
    for b in ("name_length", "description_length", "nbr_photo"):
        df = df.withColumn(b, F.when(F.col("order_id") % 3 > 0, "short").otherwise("long"))
    moments = workflow.base_moments(df, ["Target", "review_score"])
    for label in ("Target", "review_score"):
        shared = workflow.prepare_base(df, None, label, materialized=True, moments=moments)
        alone = workflow.prepare_base(df, None, label, materialized=True)
        assert shared.features == alone.features and "x" in shared.features and "const" not in shared.features
        assert shared.screen.collect() == alone.screen.collect()
    listed = workflow.prepare_base(df, None, "Target", features=["const", "Target"], materialized=True)
    assert listed.features == ["const", "Target"] and [r.feature for r in listed.screen.collect()] == ["x", "noise", "const", "y"]
