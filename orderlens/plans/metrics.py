"""Evaluation: AUC, weighted precision / recall / F1, accuracy, and a model comparison table.

The area under the curve is Spark's evaluator (a distributed sort of scores); the others follow
from one count per label and prediction.
"""

from __future__ import annotations

from collections import Counter

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.session import scratch_path

# The metrics reported for each kind of model.
BINARY_METRICS = ("areaUnderROC", "weightedPrecision", "weightedRecall", "f1")
MULTICLASS_METRICS = ("accuracy", "weightedPrecision", "weightedRecall", "f1")


# The ROC curve is not down-sampled (numBins=0): the default of 1000 bins makes the area an
# approximation as soon as there are more distinct scores. The exact curve is still computed
# on the executors (sorted RDD, per-partition prefix counts); only the area reaches the driver.
EXACT_BINS = 0


def auc(pred: DataFrame, label: str = "label", raw: str = "rawPrediction") -> float:
    ev = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol=raw, metricName="areaUnderROC", numBins=EXACT_BINS)
    return ev.evaluate(pred)


def classification(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> dict[str, float]:
    """Accuracy and the class-weighted precision, recall and F1 from one count per (label,
    prediction): one job, and classes squared rows to the driver."""
    cells = pred.groupBy(F.col(label).cast("double").alias("y"), F.col(prediction).cast("double").alias("p")).count().collect()
    true, said, hit = Counter(), Counter(), Counter()
    for y, p, n in cells:
        true[y] += n
        said[p] += n
        hit[y] += n * (y == p)
    total = sum(true.values())
    out = dict.fromkeys(MULTICLASS_METRICS, 0.0)
    for y, n in sorted(true.items()):
        precision, recall = (hit[y] / said[y] if said[y] else 0.0), hit[y] / n
        out["weightedPrecision"] += precision * n / total
        out["weightedRecall"] += recall * n / total
        out["f1"] += (2 * precision * recall / (precision + recall) if precision + recall else 0.0) * n / total
        out["accuracy"] += hit[y] / total
    return out


def evaluate(pred: DataFrame, label: str = "label", kind: str = "binary", raw: str = "rawPrediction", prediction: str = "prediction") -> dict:
    """All metrics of one model on one scored frame. A binary model's frame is cached for the
    duration, as the area under the curve is a pass of its own."""
    if kind != "binary":
        return classification(pred.select(label, prediction), label, prediction)
    pred = pred.select(label, prediction, raw).cache()
    try:
        counted = classification(pred, label, prediction)
        return {m: auc(pred, label, raw) if m == "areaUnderROC" else counted[m] for m in BINARY_METRICS}
    finally:
        pred.unpersist()


def _by_class(scores: DataFrame, keys: list[str], metric: str) -> DataFrame:
    """Class-weighted metric of each group from one count per (label, prediction)."""
    cells = scores.groupBy(*keys, "label", "prediction").agg(F.count("*").alias("n"))
    truth = cells.groupBy(*keys, F.col("label").alias("c")).agg(F.sum("n").alias("n_true"), F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)).alias("hit"))
    said = cells.groupBy(*keys, F.col("prediction").alias("c")).agg(F.sum("n").alias("n_said"))
    per = truth.join(said, [*keys, "c"], "left")
    precision, recall = F.coalesce(F.try_divide("hit", "n_said"), F.lit(0.0)), F.col("hit") / F.col("n_true")
    f1 = F.coalesce(F.try_divide(2 * precision * recall, precision + recall), F.lit(0.0))
    value = {"f1": f1, "weightedPrecision": precision, "weightedRecall": recall, "accuracy": recall}[metric]
    return per.groupBy(*keys).agg((F.sum(value * F.col("n_true")) / F.sum("n_true")).alias("value"))


def _by_rank(scores: DataFrame, keys: list[str]) -> DataFrame:
    """Exact area under ROC of each group: pairs of a positive above a negative, ties by half.

    One row per distinct score, range-partitioned by group and score; a group may span many
    partitions, whose totals are added up on a small table of its own."""
    up, down = F.sum((F.col("label") > 0).cast("long")).alias("pos"), F.sum((F.col("label") <= 0).cast("long")).alias("neg")
    steps = scores.groupBy(*keys, "score").agg(up, down)
    n = int(scores.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    steps = steps.repartitionByRange(n, *keys, "score").withColumn("part", F.spark_partition_id())
    path = scratch_path(scores.sparkSession, "steps")
    steps.write.parquet(path)  # the partition numbers stay as they are
    steps = scores.sparkSession.read.schema(steps.schema).parquet(path)
    below = Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = steps.groupBy(*keys, "part").agg(F.sum("neg").alias("below")).withColumn("below", F.coalesce(F.sum("below").over(below), F.lit(0)))
    inside = Window.partitionBy(*keys, "part").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    whole = lambda c: F.col(c).cast("decimal(18,0)")
    steps = steps.join(totals, [*keys, "part"]).withColumn("under", F.col("below") + F.coalesce(F.sum("neg").over(inside), F.lit(0)))
    twice = F.sum((whole("pos") * (2 * whole("under") + whole("neg"))).cast("decimal(38,0)"))
    pairs = F.sum("pos").cast("decimal(18,0)") * F.sum("neg").cast("decimal(18,0)")
    return steps.groupBy(*keys).agg((twice.cast("double") / (2 * F.nullif(pairs, F.lit(0))).cast("double")).alias("value"))


def grouped(scores: DataFrame, keys: list[str], metric: str) -> DataFrame:
    """(keys, value): a metric of every group of a score table (label, score, prediction), in one pass."""
    return _by_rank(scores, keys) if metric == "areaUnderROC" else _by_class(scores, keys, metric)


METRIC_SCHEMA = T.StructType(
    [
        T.StructField("model", T.StringType()),
        T.StructField("metric", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)


def compare_models(spark: SparkSession, results: dict[str, dict]) -> DataFrame:
    """One row per (model, metric) from ``{model: evaluate(...)}``."""
    rows = [(m, k, float(v)) for m, d in results.items() for k, v in d.items()]
    return spark.createDataFrame(rows, METRIC_SCHEMA)
