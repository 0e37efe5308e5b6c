"""Grid search with k-fold cross-validation over one out-of-fold score table.

Every grid point is scored on every fold by a model of the other folds. The scores (fold, grid point,
label, score, prediction) are written once; all points' metrics come from one grouped pass over them.
Work that two grid points share is done once:

- Iterative learners: the largest ``maxIter`` of a penalty is fitted first. If it settled after k
  iterations, it is the model of every limit of k or more, and only smaller limits are fitted.
- Decision tree: the deepest tree of a fold is cut at each smaller depth. A split never depends on what
  is below it, so the cut tree (with sibling leaves of one prediction merged, as the learner does) is
  the tree that would be fitted at that depth.
- Forest: the same for each of its trees, between points of one number of trees. The rows' draws depend on
  that number, so a smaller forest is not part of a larger one. The draws of features do not depend on the
  depth as long as the nodes of each level are grown in one pass; a depth where their counts may pass the
  learner's memory is fitted by itself. The nodes are read from the saved model. Frames of one task are
  fitted point by point, as Spark's cross-validator does. Frames of more than two tasks are not fitted
  by Spark: ``plans.forest`` grows the forests of all folds together, and smaller forests are part of larger ones.

For trees and forests the frame is cached once. For iterative learners, which keep the rows they are fitted
on themselves and pass over them hundreds of times, it is written once: what is sent with every task of every
pass then ends at that file, and no memory is held twice. Each fold's training rows are read from it in as
many partitions as their number needs, ``PASS_ROWS`` in each: a pass over few rows is one small task without
a shuffle. Every task of a tree or forest sends the counts of all nodes of a level, so beyond the cluster's cores their tasks hold ``TASK_BYTES`` of
what they keep of the rows, not a number of rows. They keep a copy of the rows they are fitted on, so only
as many fits run at once as the cores need to be busy, the largest first. They also keep each row's node
instead of walking down from the root at each level; the model is the same.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from dataclasses import dataclass
from itertools import product

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.ml.util import JavaMLWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.plans import forest as own_forest
from orderlens.plans import metrics
from orderlens.plans.prepare import with_folds
from orderlens.session import scratch_path

ROWS_PER_TASK = 50_000
PASS_ROWS = 500_000  # in a task of one pass of an iterative learner
TASK_BYTES = 320 << 20  # of rows as a learner keeps them, in a task
ROW_BYTES, TREE_BYTES = 300, 12  # kept for a row (its features), and for each tree of a forest (its draw, its node)
SCORES = "order_key string, fold int, grid_point int, label double, score double, prediction double"


@dataclass
class Search:
    """A finished search: the grid, each point's mean metric, the score table and the chosen model."""

    grid: list[dict]
    metric: str
    avgMetrics: list[float]
    foldMetrics: DataFrame  # grid_point, fold, metric's value
    scores: DataFrame  # the out-of-fold score table
    fits: int
    bestModel: JavaMLWritable

    @property
    def best(self) -> int:
        """The first grid point with the largest mean."""
        return self.avgMetrics.index(max(self.avgMetrics))

    def transform(self, df: DataFrame) -> DataFrame:
        return self.bestModel.transform(df)


def grid_points(grid: dict) -> list[dict]:
    """All combinations of the listed values."""
    return [dict(zip(grid, values, strict=True)) for values in product(*grid.values())]


def _families(points: list[dict], nested: str | None) -> list[list[int]]:
    """Grid points that differ in the nested parameter only, largest first; others are alone."""
    if nested is None:
        return [[i] for i in range(len(points))]
    groups: dict[tuple, list[int]] = {}
    for i, p in enumerate(points):
        groups.setdefault(tuple((k, v) for k, v in sorted(p.items()) if k != nested), []).append(i)
    return [sorted(g, key=lambda i: -points[i][nested]) for g in groups.values()]


def iterations(model) -> int:
    summary = model.summary
    return (summary() if callable(summary) else summary).totalIterations


# ------------------------------------------------------------------ one fold
def _top_model(est, train: DataFrame, points: list[dict], family: list[int]) -> tuple:
    """The model of the largest limit, the grid points it stands for, and the others. Those end before it
    settled, so none of them stands for another."""
    model = est.copy({est.getParam(k): v for k, v in points[family[0]].items()}).fit(train)
    same = family[:1] + [i for i in family[1:] if points[i]["maxIter"] >= iterations(model)]
    return model, same, [i for i in family if i not in same]


@dataclass
class _Node:
    counts: list[float]
    left: int
    right: int

    @property
    def prediction(self) -> int:
        return self.counts.index(max(self.counts))


def tree_nodes(model) -> list[_Node]:
    """The nodes of a fitted classification tree in pre-order (the root is first)."""
    out: list[_Node] = []

    def visit(node) -> int:
        at = len(out)
        out.append(_Node(list(node.impurityStats().stats()), -1, -1))
        if node.subtreeDepth():
            out[at].left = visit(node.leftChild())
            out[at].right = visit(node.rightChild())
        return at

    visit(model._java_obj.rootNode())
    return out


def cut_tree(nodes: list[_Node], depth: int) -> list[list[float]]:
    """For each leaf of the tree, from left to right, the class counts of its leaf in the tree cut at ``depth``."""
    out: list[list[float]] = []

    def leaves(at: int) -> int:
        return 1 if nodes[at].left < 0 else leaves(nodes[at].left) + leaves(nodes[at].right)

    def visit(at: int, level: int) -> tuple[list[list[float]], bool]:
        """The counts of the leaves below, and whether they are one leaf now."""
        node = nodes[at]
        if node.left < 0 or level == depth:
            return [node.counts] * leaves(at), True
        (a, one), (b, other) = visit(node.left, level + 1), visit(node.right, level + 1)
        if one and other and nodes[node.left].prediction == nodes[node.right].prediction:
            return [node.counts] * (len(a) + len(b)), True
        return a + b, False

    out += visit(0, 0)[0]
    return out


def _scored(model, valid: DataFrame, label: str, key: str, binary: bool) -> DataFrame:
    out = model.transform(valid)
    score = vector_to_array("rawPrediction")[1] if binary else F.lit(None)
    return out.select(F.col(key).cast("string").alias("order_key"), "fold", F.col(label).cast("double").alias("label"), score.cast("double").alias("score"), "prediction")


def _tree_scored(model, valid: DataFrame, label: str, key: str, binary: bool, points: list[dict], family: list[int]) -> DataFrame:
    """The scores of every depth of a family from its deepest tree."""
    nodes, rows = tree_nodes(model), []
    for i in family:
        for leaf, counts in enumerate(cut_tree(nodes, points[i]["maxDepth"])):
            rows.append((float(leaf), i, float(counts[1]) if binary else None, float(counts.index(max(counts)))))
    spark = valid.sparkSession
    table = spark.createDataFrame(rows, "leaf double, grid_point int, score double, prediction double")
    placed = model.setLeafCol("leaf").transform(valid)
    placed = placed.select(F.col(key).cast("string").alias("order_key"), "fold", F.col(label).cast("double").alias("label"), "leaf")
    return placed.join(F.broadcast(table), "leaf").drop("leaf")  # leaves x depths rows: bounded by the deepest tree


def forest_nodes(model, spark) -> list[list[_Node]]:
    """The nodes of each tree of a fitted forest in pre-order, read from the model as saved: as many as the
    trees and the depth allow, whatever the rows."""
    path = scratch_path(spark, "forest")
    model.save(path)
    saved = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.id", "nodeData.impurityStats", "nodeData.leftChild", "nodeData.rightChild")
    trees: list[list[_Node]] = [[] for _ in range(model.getNumTrees)]
    for tree, _, counts, left, right in sorted(map(tuple, saved.collect())):
        trees[tree].append(_Node(counts, left, right))  # ids count up from the root in pre-order
    return trees


def _same_levels(model, depth: int) -> bool:
    """Whether the forest grown to ``depth`` has the upper levels of this deeper one: the counts of all nodes
    of a level, if each used every feature, fit the learner's memory."""
    node = model.numFeatures * model.getOrDefault("maxBins") * model.numClasses * 8
    return model.getNumTrees * 2 ** max(0, depth - 1) * node <= model.getOrDefault("maxMemoryInMB") << 20


def _forest_scored(model, valid: DataFrame, label: str, key: str, binary: bool, points: list[dict], family: list[int]) -> DataFrame:
    """The scores of every depth of a family from its deepest forest: the sum of the trees' class shares, as
    the learner's own."""
    trees = forest_nodes(model, valid.sparkSession)
    shares = {}
    for i in family:
        counts = np.array([leaf for nodes in trees for leaf in cut_tree(nodes, points[i]["maxDepth"])])
        rows_of = counts.sum(axis=1, keepdims=True)
        shares[i] = np.divide(counts, rows_of, out=np.zeros_like(counts), where=rows_of > 0)
    first = np.cumsum([0, *[sum(node.left < 0 for node in nodes) for nodes in trees]])[:-1]

    def scored(batches):
        for rows in batches:
            leaves = np.array(rows.pop("leaf").tolist(), dtype=np.int64).reshape(len(rows), len(first)) + first
            for i, share in shares.items():
                raw = np.zeros((len(rows), share.shape[1]))
                for t in range(len(first)):
                    raw += share[leaves[:, t]]
                yield rows.assign(grid_point=i, score=raw[:, 1] if binary else np.nan, prediction=raw.argmax(axis=1).astype(float))

    placed = model.setLeafCol("leaf").transform(valid)
    placed = placed.select(F.col(key).cast("string").alias("order_key"), "fold", F.col(label).cast("double").alias("label"), vector_to_array("leaf").alias("leaf"))
    return placed.mapInPandas(scored, "order_key string, fold int, label double, grid_point int, score double, prediction double")


# ------------------------------------------------------------------ the search
def tasks_for(rows: int, cores: int, trees: int = 1, rows_per_task: int = ROWS_PER_TASK) -> int:
    """Partitions of a fit: ``rows_per_task`` rows in each up to one for a core, then by bytes in full waves."""
    by_rows = max(1, -(-rows // rows_per_task))
    if by_rows <= cores:
        return by_rows
    fewest = -(-rows // (TASK_BYTES // (ROW_BYTES + TREE_BYTES * trees)))
    return min(by_rows, cores * max(1, -(-fewest // cores)))


def fits_at_once(tasks: int, cores: int, parallelism: int) -> int:
    """So many fits that each core has about two tasks; two at least, as a fit has steps of the driver only."""
    return max(1, min(parallelism, max(2, -(-2 * cores // tasks))))


def _written(data: DataFrame) -> DataFrame:
    """A frame written once into the shared folder, as a scan of it."""
    path = scratch_path(data.sparkSession, "folds")
    data.write.parquet(path)
    return data.sparkSession.read.schema(data.schema).parquet(path)


def _forest_search(est, cached: DataFrame, points: list[dict], label: str, metric: str, key: str, per: dict, classes: list[float]) -> Search:
    """The search of a forest over large frames: one growing for all folds and points, then one of the chosen point."""
    spark, total, binary = cached.sparkSession, sum(per.values()), metric == "areaUnderROC"
    n_classes, limits = int(max(classes)) + 1, [est.getOrDefault(n) for n in ("seed", "minInstancesPerNode", "minInfoGain")]
    sizes = [tuple(p.get(n, est.getOrDefault(n)) for n in ("numTrees", "maxDepth")) for p in points]
    rows = own_forest.rows_of(cached, label, est.getFeaturesCol(), key)

    def grown(models: list, trees: int, depth: int) -> own_forest.Forests:
        data = own_forest.binned(rows, total, models, classes, est.getMaxBins())
        try:
            return own_forest.grow(data, trees, depth, *limits)
        finally:
            data.rows.unpersist()

    folds = grown(sorted(per), max(t for t, _ in sizes), max(d for _, d in sizes))
    path = scratch_path(spark, "scores")
    own_forest.scored(rows, folds, sizes, n_classes, binary).write.parquet(path)
    scores = spark.read.schema(SCORES).parquet(path)
    by_fold, means = _means(scores, metric, len(points))
    trees, depth = sizes[means.index(max(means))]
    best = own_forest.as_model(est, grown([None], trees, depth), trees, depth, n_classes)
    return Search(points, metric, means, by_fold, scores, len(per) + 1, best)


def _means(scores: DataFrame, metric: str, points: int) -> tuple[DataFrame, list[float]]:
    """Every point's metric on each fold, and its mean."""
    by_fold = metrics.grouped(scores, ["grid_point", "fold"], metric)
    values: dict[int, list[float]] = {}
    for r in by_fold.collect():
        values.setdefault(r["grid_point"], []).append(r["value"])
    return by_fold, [sum(sorted(values[i])) / len(values[i]) for i in range(points)]


def _weight(point: dict) -> float:
    """What a forest of a grid point costs beside the others: its trees times its levels."""
    return point.get("numTrees", 1) * point.get("maxDepth", 1)


def cross_validate(
    est,
    data: DataFrame,
    points: Sequence[dict],
    label: str,
    metric: str,
    key: str = "order_id",
    folds: int = 5,
    nested: str | None = None,
    parallelism: int = 8,
    rows_per_task: int | None = None,
) -> Search:
    """Search ``points`` by the mean of ``metric`` over the folds; the best is fitted on all rows.
    ``nested`` names the parameter whose values share work: "maxIter" or "maxDepth"."""
    spark, points = data.sparkSession, list(points)
    binary = metric == "areaUnderROC"
    cores = spark.sparkContext.defaultParallelism
    grows = est.hasParam("cacheNodeIds")  # a tree or forest
    if grows:
        # at most as many steps of lineage as levels, so none is written out
        est = est.copy({est.getParam("cacheNodeIds"): True, est.getParam("checkpointInterval"): -1})
    rows_per_task = rows_per_task or (ROWS_PER_TASK if grows else PASS_ROWS)
    cached = with_folds(data, folds, key).persist() if grows else _written(with_folds(data, folds, key))
    try:
        per = {r["fold"]: r["count"] for r in cached.groupBy("fold").count().collect()}
        total, parts = sum(per.values()), cached.rdd.getNumPartitions()
        trees = max(p.get("numTrees", 1) for p in points)

        def tasks(n):
            return min(parts, tasks_for(n, cores, trees, rows_per_task) if grows else max(1, -(-n // rows_per_task)))

        def rows(keep, n):
            part = cached.where(keep) if keep is not None else cached
            return part.coalesce(max(1, tasks(n)))

        root = scratch_path(spark, "scores")
        train = {f: rows(F.col("fold") != f, total - per[f]) for f in sorted(per)}
        forest = est.hasParam("numTrees")
        if forest and total <= rows_per_task:
            nested = None
        elif total > 2 * rows_per_task and min(parts, len(per)) > 1 and own_forest.grown_here(est, points) and (classes := own_forest.classes_of(cached, label)):
            return _forest_search(est, cached, points, label, metric, key, per, classes)
        # passes are short beside the driver's steps between them: four tasks for a core keep the cores busy
        at_once = fits_at_once(max(1, tasks(total)), cores if grows else 2 * cores, parallelism)

        def run(fold: int, family: list[int]) -> tuple[str, list[int]]:
            """Where the scores are, and the grid points of the family that need fits of their own."""
            valid, left = cached.where(F.col("fold") == fold), []
            if nested == "maxDepth":
                model = est.copy({est.getParam(k): v for k, v in points[family[0]].items()}).fit(train[fold])
                if forest:
                    left = [i for i in family[1:] if not _same_levels(model, points[i]["maxDepth"])]
                    family = [i for i in family if i not in left]
                frame = (_forest_scored if forest else _tree_scored)(model, valid, label, key, binary, points, family)
            else:
                model, same, left = _top_model(est, train[fold], points, family)
                frame = _scored(model, valid, label, key, binary).withColumn("grid_point", F.explode(F.array(*[F.lit(i) for i in same])))
            path = f"{root}/{fold}-{family[0]}"
            frame.select(*[c.split()[0] for c in SCORES.split(", ")]).write.parquet(path)
            return path, left

        paths = []
        with ThreadPoolExecutor(at_once) as pool:
            families = sorted(_families(points, nested), key=lambda family: -_weight(points[family[0]]))
            running = {pool.submit(run, f, family): f for family in families for f in sorted(per)}
            while running:
                ended, _ = wait(running, return_when=FIRST_COMPLETED)
                for future in ended:
                    fold = running.pop(future)
                    path, left = future.result()
                    paths.append(path)
                    running |= {pool.submit(run, fold, [i]): fold for i in left}
        scores = spark.read.schema(SCORES).parquet(*paths)
        by_fold, means = _means(scores, metric, len(points))
        chosen = points[means.index(max(means))]
        best = est.copy({est.getParam(k): v for k, v in chosen.items()}).fit(rows(None, total))
        return Search(points, metric, means, by_fold, scores, len(paths) + 1, best)
    finally:
        if grows:
            cached.unpersist()
