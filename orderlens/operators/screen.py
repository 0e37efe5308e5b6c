"""Feature screening: Pearson r and its p-value for every candidate column in ONE pass.

The whole screen is one scan of the table however many columns are screened (partial
aggregates per task, one small merge), and nothing but a handful of scalars per column leaves
the executors. The p-values are computed by an Arrow-batched pandas
UDF over the (feature, n, r) rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.functions.pvalue import pearson_pvalue

# The significance level of the source and the columns never screened.
ALPHA = 0.001
ID_COLUMNS = ("order_id", "product_id", "review_id", "customer_id")
LABEL_COLUMNS = ("Target", "review_score")


def _c(name: str):
    return F.col(f"`{name}`")


@F.pandas_udf(T.DoubleType())
def _pvalue_udf(r: pd.Series, n: pd.Series) -> pd.Series:
    return pd.Series(pearson_pvalue(r.to_numpy(dtype=float, na_value=float("nan")), n.to_numpy(dtype=float)))


def candidate_features(df: DataFrame, label: str, exclude: Sequence[str] = ()) -> list[str]:
    """Numeric columns other than ids, labels (both targets, see the review-score leak) and
    ``exclude``; vectors and text are never candidates."""
    skip = set(ID_COLUMNS) | set(LABEL_COLUMNS) | {label} | set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def _both(x: Column, y: Column) -> list[Column]:
    """n and r over the rows where x and y are present; r is null where one of them is constant."""
    both = x.isNotNull() & y.isNotNull()
    xs, ys = F.when(both, x), F.when(both, y)
    sd = F.stddev_samp(xs) * F.stddev_samp(ys)
    return [F.count(xs).alias("n"), F.try_divide(F.covar_samp(xs, ys), F.when(sd != 0, sd)).alias("r")]


def _by_feature(df: DataFrame, features: Sequence[str], labels: Sequence[str], aggregates: Callable) -> DataFrame:
    """One row per feature, with its place ``_i``: ``aggregates(x, labels' values)`` from one scan of ``df``.

    Plan: each row is turned into (feature index, x, y...) pairs by ``inline`` and aggregated per
    feature index with a map-side partial step in the same stage, so the pairs are never
    shuffled: only (tasks x features) partial states are. A few small aggregate functions keep
    the generated code compact; one aggregate with four functions per feature would not
    (hundreds of functions make a method too large for the JIT, several times slower).
    """
    ys = [f"_y{k}" for k in range(len(labels))]
    pairs = F.array(
        *[F.struct(F.lit(i).alias("_i"), _c(f).cast("double").alias("_x")) for i, f in enumerate(features)]
    )
    long = df.select(*[_c(label).cast("double").alias(y) for label, y in zip(labels, ys, strict=True)], F.inline(pairs))
    stats = long.groupBy("_i").agg(*aggregates(F.col("_x"), [F.col(y) for y in ys]))
    names = F.array(*[F.lit(f) for f in features])
    return stats.withColumn("feature", F.element_at(names, F.col("_i") + 1))


def _screened(stats: DataFrame, scale: int | None) -> DataFrame:
    """(feature, n, r, p_value) in the features' order."""
    out = stats.orderBy("_i").select("feature", "n", "r")
    out = out.withColumn("p_value", F.when(F.col("r").isNotNull(), _pvalue_udf("r", "n")))
    if scale is not None:
        out = out.withColumn("r", F.round("r", scale))
    return out


def pearson_screen(df: DataFrame, features: Sequence[str], label: str, scale: int | None = None) -> DataFrame:
    """(feature, n, r, p_value) per feature, in ``features`` order, from one scan of ``df``.

    r = covar_samp / (stddev_samp(x) * stddev_samp(y)) over the rows where both are present;
    a constant column (zero deviation) gets r = null and p = null instead of failing.
    """
    return _screened(_by_feature(df, features, [label], lambda x, ys: _both(x, ys[0])), scale)


def moment_state(df: DataFrame, features: Sequence[str], labels: Sequence[str]) -> DataFrame:
    """All that the screens, the constant guard and the scaler need, from one scan for all labels.

    A row per feature: its place ``_i``, feature, present (rows with a value), deviation (sample
    standard deviation of those, 0 for a constant, null under two rows), and by_label, a map from
    the label to (n, r). ``screen_of`` and ``deviations`` read it; it has one small row per feature,
    so write or checkpoint it once and use it for every label.
    """

    def aggregates(x: Column, ys: list[Column]) -> list[Column]:
        per = F.create_map(*[c for label, y in zip(labels, ys, strict=True) for c in (F.lit(label), F.struct(*_both(x, y)))])
        return [F.count(x).alias("present"), F.stddev_samp(x).alias("deviation"), per.alias("by_label")]

    return _by_feature(df, features, labels, aggregates)


def screen_of(state: DataFrame, label: str, scale: int | None = None) -> DataFrame:
    """The screen of one label from a ``moment_state``; equal to ``pearson_screen`` over its table."""
    return _screened(state.select("_i", "feature", F.col("by_label")[label].alias("m")).select("_i", "feature", "m.n", "m.r"), scale)


def deviations(state: DataFrame, features: Sequence[str]) -> list[float | None]:
    """The sample deviations of ``features`` (one scalar for each)."""
    found = {r.feature: r.deviation for r in state.select("feature", "deviation").collect()}
    return [found[f] for f in features]


def select_features(screen: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """Screen rows with the decision: ``selected`` when p < alpha (null p is never selected)."""
    return screen.withColumn("selected", F.coalesce(F.col("p_value") < alpha, F.lit(False)))


def selected_names(screen: DataFrame, alpha: float = ALPHA) -> list[str]:
    """Names of the selected features, in screening order (one small row per feature)."""
    rows = select_features(screen, alpha).select("feature", "selected").collect()
    return [r.feature for r in rows if r.selected]
