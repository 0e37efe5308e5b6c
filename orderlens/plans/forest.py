"""Random forests of several folds grown together, level by level, from rows binned once.

The same forest as Spark's learner draws, by the same rules: thresholds of each feature from a sample of the
training rows, Poisson draws of the rows for every tree, a new draw of the root of the features' number for every
node, the split of the largest Gini gain, leaves of one prediction merged. What differs is how the draws are
made. They follow the seed, the tree's number and the row's key (rows of one key share them, as they share their
fold), not the partitioning. So a forest of 20 trees is the first 20 of one of 100, and a forest of depth 5 is the
top of one of depth 10: one growing on a fold serves a whole grid, and a result does not change with the cluster.

A row is kept as one byte for each feature and fold (its bin and its class). A pass grows one level of the trees
of all folds: each task walks its rows down the trees grown so far, which are broadcast, and counts the bins of
the level's nodes tree by tree; the counts of a tree's nodes are cut into pieces of ``PIECE`` nodes, added up
piece by piece behind a shuffle, and only the chosen splits reach the driver. A task holds ``TASK_BYTES`` of rows
and the counts of one tree; a reducer reads about ``MERGE_BYTES``. Nothing but the binned rows stays in memory
between passes. Counts are whole numbers, so sums do not depend on their order.
"""

from __future__ import annotations

import json
import math
import time
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.session import scratch_path

TASK_BYTES = 64 << 20  # of binned rows in a task
TASK_ROWS = 20_000  # in a task, up to one task for a core
MERGE_BYTES = 32 << 20  # of counts that a task adds up
PIECE = 64  # nodes whose counts travel together
BLOCK_ROWS = 30_000  # walked at once
CELLS = 1 << 21  # counted at once
SAMPLE_ROWS = 10_000  # the learner's own least sample for its thresholds
MAX_CLASSES = 100  # Spark's limit for labels without metadata
#: What a forest must have to be grown here; a learner set otherwise is left to Spark.
RULES = {"bootstrap": True, "subsamplingRate": 1.0, "featureSubsetStrategy": "auto", "impurity": "gini", "minWeightFractionPerNode": 0.0}
_ENSEMBLE_ONLY = ("numTrees", "bootstrap", "featureSubsetStrategy", "subsamplingRate")


def grown_here(est, points: Sequence[dict]) -> bool:
    """Whether the learner and its grid follow the rules above."""
    if not est.hasParam("numTrees") or not est.hasParam("bootstrap") or est.isDefined("weightCol") or est.isDefined("thresholds"):
        return False
    plain = all(est.getOrDefault(name) == value for name, value in RULES.items())
    # a forest of one tree takes all features for every node
    return plain and all(set(p) <= {"maxDepth", "numTrees"} and p.get("numTrees", est.getOrDefault("numTrees")) > 1 for p in points)


def classes_of(data: DataFrame, label: str) -> list[float] | None:
    """The labels in order, or None if they are no class numbers that Spark's learner would take."""
    found = [r[0] for r in data.select(F.col(label).cast("double")).distinct().limit(MAX_CLASSES + 1).collect()]
    if not found or any(y is None or not 0 <= y < MAX_CLASSES or y != int(y) for y in found) or max(found) < 1:
        return None
    return sorted(found)


# ------------------------------------------------------------------ draws
def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _poisson_steps() -> np.ndarray:
    """The 32-bit numbers from which on a draw is 1, 2, ... (Poisson, mean 1)."""
    shares = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(16)])
    steps = np.round(shares * 2**32)
    return steps[steps < 2**32].astype(np.uint32)


_STEPS = _poisson_steps()


def row_draws(keys: np.ndarray, seed: int, tree: int) -> np.ndarray:
    """How often each row is drawn for a tree."""
    start = _mixed(np.array([seed & (2**64 - 1)], np.uint64)) + np.array([tree + 1], np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    u = (_mixed(_mixed(keys + start) + start) >> np.uint64(32)).astype(np.uint32)
    out = np.zeros(len(keys), np.uint8)
    for step in _STEPS:
        out += u >= step
    return out


def feature_draws(seed: int, tree: int, level: int, nodes: int, features: int) -> np.ndarray:
    """The features tried by each node of a level: (nodes, root of their number), in ascending order."""
    few = math.ceil(math.sqrt(features))
    order = np.random.default_rng([seed & (2**64 - 1), tree, level]).random((nodes, features)).argsort(axis=1)
    return np.sort(order[:, :few], axis=1)


# ------------------------------------------------------------------ bins
def thresholds_of(values: np.ndarray, max_bins: int) -> np.ndarray:
    """A feature's thresholds from a sample, by the learner's rule: between all its values if they are few, else
    where the running count of the values is closest to equal shares."""
    distinct, count = np.unique(values + 0.0, return_counts=True)
    between = distinct[:-1] / 2 + distinct[1:] / 2
    if len(between) < max_bins:
        return between
    running = np.cumsum(count)
    middle = (running[:-1] + running[1:]) / 2  # the count passes a share's end nearest to the value before it
    stride, out, at = len(values) / max_bins, [], 0
    target = stride
    while (at := int(np.searchsorted(middle[at:], target, side="right")) + at) < len(between):
        out.append(between[at])
        target, at = target + stride, at + 1
    return np.array(out)


@dataclass
class Binned:
    """Rows as bins for each model; a model is a fold whose rows it does not see, or None for all rows."""

    rows: DataFrame  # keys, folds, codes: binary
    models: list[int | None]
    thresholds: list[list[np.ndarray]]  # of each model and feature
    classes: list[float]
    bins: int
    tasks: int

    @property
    def features(self) -> int:
        return len(self.thresholds[0])

    @property
    def code(self):
        """The type of a bin and class as one number."""
        return _least_type(self.bins * len(self.classes) - 1)


def _least_type(top: int):
    return np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32


def _matrix(column: pa.Array) -> np.ndarray:
    """A batch's feature arrays, all of one length, as rows."""
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1)


def _bin(x: np.ndarray, thresholds: list[np.ndarray], dtype) -> np.ndarray:
    out = np.empty(x.shape, dtype)
    for f, t in enumerate(thresholds):
        out[:, f] = np.searchsorted(t, x[:, f])  # a value is in bin b or below if it is at most threshold b
    return out


def rows_of(data: DataFrame, label: str, features: str, key: str) -> DataFrame:
    """What a forest reads of a frame with folds: order_key, h (hash of the key), fold, label, x (features)."""
    return data.select(
        F.col(key).cast("string").alias("order_key"),
        F.xxhash64(F.col(key).cast("string")).alias("h"),
        "fold",
        F.col(label).cast("double").alias("label"),
        vector_to_array(features).alias("x"),
    )


def tasks_for(rows: int, cores: int, row_bytes: int) -> int:
    """Tasks of a pass: ``TASK_ROWS`` in each up to one for a core, then by bytes in full waves."""
    by_rows = max(1, -(-rows // TASK_ROWS))
    by_bytes = -(-rows * row_bytes // TASK_BYTES)
    return by_rows if by_rows <= cores else cores * max(1, -(-by_bytes // cores))


def binned(rows: DataFrame, total: int, models: list[int | None], classes: list[float], max_bins: int) -> Binned:
    """The frame (h, fold, label, x) in bins, persisted."""
    wanted = max(max_bins * max_bins, SAMPLE_ROWS)
    share = min(1.0, wanted * max(1, len(models)) / max(1, len(models) - 1) / max(1, total))  # without a fold's rows still enough
    part = rows.where(F.pmod(F.xxhash64("h", F.lit(7)), F.lit(1 << 30)) < int(share * (1 << 30)) + 1).select("fold", "x").toArrow().combine_chunks()
    if not part.num_rows:
        part = rows.select("fold", "x").limit(wanted).toArrow().combine_chunks()
    x, fold = _matrix(part["x"].combine_chunks()), part["fold"].to_numpy()
    thresholds = [[thresholds_of(x[fold != m if m is not None else slice(None), f], max_bins) for f in range(x.shape[1])] for m in models]
    bins = max(len(t) for of in thresholds for t in of) + 1
    out = Binned(rows, models, thresholds, classes, bins, 1)
    n_classes, known, code = len(classes), np.array(classes), out.code

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = _matrix(batch["x"]), np.searchsorted(known, batch["label"].to_numpy()).astype(code)
            codes = b"".join((_bin(x, t, code) * code(n_classes) + y[:, None]).tobytes() for t in thresholds)
            cells = [batch["h"].to_numpy().tobytes(), batch["fold"].to_numpy().astype(np.int32).tobytes(), codes]
            yield pa.RecordBatch.from_arrays([pa.array([c], pa.binary()) for c in cells], names=["keys", "folds", "codes"])

    cores = rows.sparkSession.sparkContext.defaultParallelism
    out.tasks = tasks_for(total, cores, len(models) * x.shape[1] * np.dtype(code).itemsize + 12)
    blocks = rows.select("h", "fold", "label", "x").mapInArrow(run, "keys binary, folds binary, codes binary")
    out.rows = blocks.repartition(out.tasks).persist()
    return out


@dataclass
class _Block:
    """Some rows of a task, fold by fold: few enough that what a pass makes of them stays near the core."""

    keys: np.ndarray
    starts: np.ndarray  # of each fold to leave out, the first row in it
    ends: np.ndarray
    codes: list[np.ndarray]  # of each model, row by row

    def drawn(self, seed: int, tree: int, features: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Of each model the places of the rows drawn for a tree, and how often each is drawn."""
        often = row_draws(self.keys, seed, tree)
        rows = np.flatnonzero(often)
        at, weight = rows * features, often[rows].astype(float)
        a, b = np.searchsorted(rows, self.starts), np.searchsorted(rows, self.ends)
        return [tuple(np.concatenate([x[:i], x[j:]]) for x in (at, weight)) for i, j in zip(a, b, strict=True)]


def _held(batches: Iterator[pa.RecordBatch], data: tuple) -> list[_Block]:
    """A task's rows."""
    models, features, dtype = data
    cells = [c for batch in batches for c in zip(*(batch[n].to_pylist() for n in ("keys", "folds", "codes")), strict=True)]
    out, some, size = [], [], 0
    for place, cell in enumerate(cells):
        some.append(cell)
        size += len(cell[0]) // 8
        if size < BLOCK_ROWS and place + 1 < len(cells):
            continue
        keys = np.concatenate([np.frombuffer(k, np.int64) for k, _, _ in some]).view(np.uint64)
        folds = np.concatenate([np.frombuffer(f, np.int32) for _, f, _ in some])
        order = np.argsort(folds, kind="stable")
        codes = [np.concatenate([np.frombuffer(c, dtype).reshape(len(models), -1, features)[m] for _, _, c in some])[order].reshape(-1) for m in range(len(models))]
        left_out = [-1 if m is None else m for m in models]  # no fold is -1
        starts, ends = (np.searchsorted(folds[order], left_out, side=side) for side in ("left", "right"))
        out.append(_Block(keys[order], starts, ends, codes))
        some, size = [], 0
    return out


# ------------------------------------------------------------------ trees
@dataclass
class Tree:
    """Nodes level by level; a leaf is its own left child and no row goes to its right."""

    feature: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    bin: np.ndarray = field(default_factory=lambda: np.full(1, -1))  # of the split, -1 of a leaf
    left: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    counts: np.ndarray | None = None  # (nodes, classes)
    gain: np.ndarray = field(default_factory=lambda: np.full(1, -1.0))
    level: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    active: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))  # the nodes to split next

    def steps(self, data: Binned) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What a walk needs: each node's feature, the largest code that goes left, and left child."""
        classes = len(data.classes)
        return self.feature, (np.where(self.bin < 0, data.bins, self.bin + 1) * classes - 1).astype(data.code), self.left

    def split(self, level: int, feature, bins, gain, left, total, depth: int) -> None:
        """Split the active nodes where that gains; the children are the next ones unless they are pure."""
        if self.counts is None:
            self.counts = total.copy()
        good = gain > 0
        nodes, n, first = self.active[good], int(good.sum()), len(self.feature)
        if depth == 0:
            nodes, n, good = nodes[:0], 0, good & False
        self.feature[nodes], self.bin[nodes], self.gain[nodes] = feature[good], bins[good], gain[good]
        self.left[nodes] = first + 2 * np.arange(n)
        kids = np.stack([left[good], total[good] - left[good]], axis=1).reshape(2 * n, total.shape[1])
        self.counts = np.concatenate([self.counts, kids])
        self.feature = np.concatenate([self.feature, np.zeros(2 * n, np.int64)])
        self.bin = np.concatenate([self.bin, np.full(2 * n, -1)])
        self.left = np.concatenate([self.left, first + np.arange(2 * n)])
        self.gain = np.concatenate([self.gain, np.full(2 * n, -1.0)])
        self.level = np.concatenate([self.level, np.full(2 * n, level + 1)])
        open_kids = (kids > 0).sum(axis=1) > 1 if level + 1 < depth else np.zeros(2 * n, bool)
        self.active = first + np.flatnonzero(open_kids)

    def cut(self, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Of the tree cut at ``depth``, sibling leaves of one prediction merged: whether each node is a leaf or
        lies under one, and the node that stands for it."""
        said, one, stands = self.counts.argmax(axis=1), (self.bin < 0) | (self.level >= depth), np.arange(len(self.bin))
        levels = range(int(self.level.max()) + 1)
        split = [np.flatnonzero((self.level == n) & (self.bin >= 0)) for n in levels]
        for n in reversed(levels):
            a = self.left[split[n]]
            one[split[n]] |= one[a] & one[a + 1] & (said[a] == said[a + 1])
        for n in levels:
            under = split[n][one[split[n]]]
            stands[self.left[under]] = stands[self.left[under] + 1] = stands[under]
        return one, stands

    def shares(self, depth: int) -> np.ndarray:
        """The class shares of each node's leaf in the tree cut at ``depth``."""
        counts = self.counts[self.cut(depth)[1]].astype(float)
        total = counts.sum(axis=1, keepdims=True)
        return np.divide(counts, total, out=np.zeros_like(counts), where=total > 0)


def _step(node: np.ndarray, codes: np.ndarray, at: np.ndarray, steps) -> np.ndarray:
    feature, most, left = steps
    place = feature.take(node)
    place += at
    return left.take(node) + (codes.take(place) > most.take(node))


def _gini(counts: np.ndarray, total: np.ndarray) -> np.ndarray:
    share = np.divide(counts, total[..., None], out=np.zeros(counts.shape), where=total[..., None] > 0)
    return 1.0 - np.square(share).sum(axis=-1)


def best_splits(counts: np.ndarray, least: int, min_gain: float) -> tuple:
    """Of counts (node, tried feature, bin, class) each node's best (tried feature, bin, gain, left counts, counts);
    a gain of -1 is no split."""
    left = counts.cumsum(axis=2)
    total = left[:, 0, -1]
    left = left[:, :, :-1]
    right = total[:, None, None] - left
    nl, nr, n = left.sum(axis=-1), right.sum(axis=-1), total.sum(axis=-1)
    whole = np.maximum(n, 1)[:, None, None]
    gain = _gini(total, n)[:, None, None] - nl / whole * _gini(left, nl) - nr / whole * _gini(right, nr)
    gain = np.where((nl >= least) & (nr >= least) & (gain >= min_gain), gain, -1.0).reshape(len(counts), -1)
    if not gain.shape[1]:  # no feature has a threshold
        return np.zeros(len(n), int), np.zeros(len(n), int), np.full(len(n), -1.0), total, total
    at, who = gain.argmax(axis=1), np.arange(len(counts))
    tried, b = np.divmod(at, left.shape[2])
    return tried, b, gain[who, at], left[who, tried, b], total


@dataclass
class Forests:
    """For each model its trees."""

    trees: list[list[Tree]]
    data: Binned
    seed: int


def _level(data: Binned, trees: list[list[Tree]], level: int, seed: int, least: int, min_gain: float) -> Iterator[tuple]:
    """(model, tree, first slot, ...) with the best splits of all active nodes."""
    sc, classes, bins, features = data.rows.sparkSession.sparkContext, len(data.classes), data.bins, data.features
    few, wide, held = math.ceil(math.sqrt(features)), bins * classes, (data.models, features, data.code)
    slots = [[len(t.active) for t in of] for of in trees]
    sent = sc.broadcast([[(t.steps(data), t.active) if len(t.active) else None for t in of] for of in trees])
    group = max(PIECE, CELLS // (few * wide) // PIECE * PIECE)  # nodes counted at once

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks, forests = _held(batches, held), sent.value
        for t in range(len(forests[0])):
            if not blocks or all(of[t] is None for of in forests):
                continue
            drawn, out = [block.drawn(seed, t, features) for block in blocks], []
            for m, of in enumerate(forests):
                if of[t] is None:
                    continue
                steps, active = of[t]
                slot = np.full(len(steps[0]), -1)
                slot[active] = np.arange(len(active))
                tries = np.ascontiguousarray(feature_draws(seed, t, level, len(active), features).T)
                for a in range(0, len(active), group):
                    counts = counted([(block.codes[m], *rows[m]) for block, rows in zip(blocks, drawn, strict=True)], steps, slot, tries, a, min(a + group, len(active)))
                    for p in range(0, len(counts), PIECE):
                        piece = counts[p : p + PIECE]
                        if top := int(piece.max()):
                            dtype = np.dtype(_least_type(top))
                            out.append((m, t, a + p, bytes([dtype.itemsize]) + piece.astype(dtype).tobytes()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    def counted(blocks: list[tuple], steps, slot: np.ndarray, tries: np.ndarray, a: int, b: int) -> np.ndarray:
        """(node, tried feature, code) of the active nodes ``a`` to ``b``."""
        total = np.zeros((few, b - a, wide))
        for codes, at, weight in blocks:
            node = np.zeros(len(at), np.int64)
            for _ in range(level):
                node = _step(node, codes, at, steps)
            who = slot.take(node)
            inside = (who >= a) & (who < b)
            if not inside.all():
                who, at, weight = who[inside], at[inside], weight[inside]
            if a:
                who = who - a
            base = who * wide
            for k in range(few):
                place = tries[k, a:b].take(who)
                place += at
                total[k] += np.bincount(base + codes.take(place), weight, minlength=(b - a) * wide).reshape(b - a, wide)
        return total.transpose(1, 0, 2)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = None, None
        for batch in batches:
            for m, t, p, cells in zip(*(batch[n].to_pylist() for n in names), strict=True):
                if (m, t, p) != held:
                    if held is not None:
                        yield chosen(*held, total)
                    held, total = (m, t, p), 0
                total = total + np.frombuffer(cells, f"u{cells[0]}", offset=1).astype(np.int64)
        if held is not None:
            yield chosen(*held, total)

    def chosen(m: int, t: int, p: int, counts: np.ndarray) -> pa.RecordBatch:
        tried, b, gain, left, total = best_splits(counts.reshape(-1, few, bins, classes), least, min_gain)
        feature = feature_draws(seed, t, level, slots[m][t], features)[p : p + len(b)][np.arange(len(b)), tried]
        cells = [np.ascontiguousarray(x, kind).tobytes() for x, kind in ((feature, "i8"), (b, "i8"), (gain, "f8"), (left, "i8"), (total, "i8"))]
        return pa.RecordBatch.from_arrays([pa.array([m], pa.int32()), pa.array([t], pa.int32()), pa.array([p], pa.int32()), *[pa.array([c], pa.binary()) for c in cells]], names=result)

    names, kinds = ["m", "t", "p", "cells"], [pa.int32(), pa.int32(), pa.int32(), pa.binary()]
    result = ["m", "t", "p", "feature", "bin", "gain", "left", "total"]
    pieces = sum(-(-n // PIECE) for of in slots for n in of)
    size = sum(n for of in slots for n in of) * few * wide * 2 * data.tasks
    cores = sc.defaultParallelism
    parts = min(pieces, max(-(-size // MERGE_BYTES), min(cores, -(-pieces // PIECE))))
    found = data.rows.mapInArrow(count, "m int, t int, p int, cells binary").repartition(parts, "m", "t", "p").sortWithinPartitions("m", "t", "p")
    found = found.mapInArrow(merge, "m int, t int, p int, feature binary, bin binary, gain binary, left binary, total binary").toArrow()
    sent.destroy()
    for row in found.to_pylist():
        shape = (-1, classes)
        yield row["m"], row["t"], row["p"], np.frombuffer(row["feature"], "i8"), np.frombuffer(row["bin"], "i8"), np.frombuffer(row["gain"]), np.frombuffer(row["left"], "i8").reshape(shape), np.frombuffer(row["total"], "i8").reshape(shape)


def grow(data: Binned, trees: int, depth: int, seed: int, least: int = 1, min_gain: float = 0.0) -> Forests:
    """Forests of so many trees of so many levels, one for each model."""
    out = Forests([[Tree() for _ in range(trees)] for _ in data.models], data, seed)
    for level in range(max(1, depth)):
        if not any(len(t.active) for of in out.trees for t in of):
            break
        found: dict[tuple, list] = {}
        for m, t, p, *rest in _level(data, out.trees, level, seed, least, min_gain):
            found.setdefault((m, t), []).append((p, rest))
        for (m, t), parts in found.items():
            parts.sort(key=lambda x: x[0])
            out.trees[m][t].split(level, *[np.concatenate(c) for c in zip(*(rest for _, rest in parts), strict=True)], depth)
    return out


# ------------------------------------------------------------------ scores and models
def scored(rows: DataFrame, forests: Forests, points: Sequence[tuple[int, int]], n_classes: int, binary: bool) -> DataFrame:
    """(order_key, fold, grid_point, label, score, prediction) of every row by the model of the other folds, for
    every point (trees, depth): the sum of the trees' class shares, as the learner's own."""
    data, depths = forests.data, sorted({d for _, d in points})
    classes, code, number = len(data.classes), data.code, {m: k for k, m in enumerate(data.models)}
    width, column = n_classes, np.array(data.classes, int)
    tables = [[(t.steps(data), [t.shares(d) for d in depths]) for t in of] for of in forests.trees]
    sent = rows.sparkSession.sparkContext.broadcast(tables)
    thresholds = data.thresholds
    names = ["order_key", "fold", "grid_point", "label", "score", "prediction"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            folds = batch["fold"].to_numpy()
            for fold in np.unique(folds):
                mine = batch.filter(pa.array(folds == fold))
                m = number[int(fold)]
                x = _matrix(mine["x"])
                codes = (_bin(x, thresholds[m], code) * code(classes)).reshape(-1)
                at = np.arange(len(x)) * x.shape[1]
                raw = [np.zeros((len(x), classes)) for _ in depths]
                for t, (steps, shares) in enumerate(sent.value[m]):
                    node, level = np.zeros(len(x), np.int64), 0
                    for k, depth in enumerate(depths):
                        for _ in range(level, depth):
                            node = _step(node, codes, at, steps)
                        level = depth
                        raw[k] += shares[k][node]
                    for i, (trees, depth) in enumerate(points):
                        if trees == t + 1:
                            full = np.zeros((len(x), width))
                            full[:, column] = raw[depths.index(depth)]
                            score = pa.array(full[:, 1]) if binary else pa.nulls(len(x), pa.float64())
                            same = [pa.array(np.full(len(x), i, np.int32)), mine["label"], score, pa.array(full.argmax(axis=1).astype(float))]
                            yield pa.RecordBatch.from_arrays([mine["order_key"], mine["fold"], *same], names=names)

    return rows.select("order_key", "fold", "label", "x").mapInArrow(run, "order_key string, fold int, grid_point int, label double, score double, prediction double")


def _saved_nodes(tree: Tree, thresholds: list[np.ndarray], classes: list[float], n_classes: int, depth: int) -> list[tuple]:
    """The nodes of a cut tree in pre-order, as Spark saves them."""
    one, _ = tree.cut(depth)
    counts = np.zeros((len(one), n_classes))
    counts[:, np.array(classes, int)] = tree.counts
    impurity, said = _gini(counts, counts.sum(axis=1)), counts.argmax(axis=1)
    out: list[list] = []
    todo = [(0, -1, 0)]  # node, parent's place, 6: its left child, 7: its right one
    while todo:
        at, parent, side = todo.pop()
        place = len(out)
        if parent >= 0:
            out[parent][side] = place
        row = [place, float(said[at]), float(impurity[at]), counts[at].tolist(), int(counts[at].sum()), -1.0, -1, -1, -1, []]
        if not one[at]:
            feature, a = int(tree.feature[at]), int(tree.left[at])
            row[5], row[8], row[9] = float(tree.gain[at]), feature, [float(thresholds[feature][tree.bin[at]])]
            todo += [(a + 1, place, 7), (a, place, 6)]
        out.append(row)
    return [tuple(row) for row in out]


#: The columns of a node as Spark saves it, but for the two structs around them.
_NODES = {
    "treeID": pa.int32(),
    "id": pa.int32(),
    "prediction": pa.float64(),
    "impurity": pa.float64(),
    "impurityStats": pa.list_(pa.float64()),
    "rawCount": pa.int64(),
    "gain": pa.float64(),
    "leftChild": pa.int32(),
    "rightChild": pa.int32(),
    "featureIndex": pa.int32(),
    "leftCategoriesOrThreshold": pa.list_(pa.float64()),
}


def as_model(est, forests: Forests, trees: int, depth: int, n_classes: int) -> RandomForestClassificationModel:
    """The first ``trees`` trees of the only model, cut at ``depth``, as Spark's model: written as Spark saves
    one and loaded."""
    spark, data = forests.data.rows.sparkSession, forests.data
    est = est.copy({est.numTrees: trees, est.maxDepth: depth})
    path = scratch_path(spark, "forest")
    est.save(f"{path}-learner")
    said = json.loads(spark.read.text(f"{path}-learner/metadata").first()[0]) | {"timestamp": int(time.time() * 1000)}
    own = {"class": "org.apache.spark.ml.classification.RandomForestClassificationModel", "numFeatures": data.features, "numClasses": n_classes, "numTrees": trees}
    spark.createDataFrame([(json.dumps(said | own),)], "value string").coalesce(1).write.text(f"{path}/metadata")
    maps = {name: {k: v for k, v in said[name].items() if k not in _ENSEMBLE_ONLY} for name in ("paramMap", "defaultParamMap")}
    alone = said | {"class": "org.apache.spark.ml.classification.DecisionTreeClassificationModel"} | maps
    metadata = [(t, json.dumps(alone | {"uid": f"dtc_{said['uid'][-12:]}_{t}"}), 1.0) for t in range(trees)]
    spark.createDataFrame(metadata, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    nodes = [(t, *node) for t, tree in enumerate(forests.trees[0][:trees]) for node in _saved_nodes(tree, data.thresholds[0], data.classes, n_classes, depth)]
    table = pa.table([pa.array(c, kind) for c, kind in zip(zip(*nodes, strict=True), _NODES.values(), strict=True)], names=list(_NODES))
    split = F.struct("featureIndex", "leftCategoriesOrThreshold", F.lit(-1).alias("numCategories")).alias("split")
    spark.createDataFrame(table).select("treeID", F.struct(*list(_NODES)[1:-2], split).alias("nodeData")).write.parquet(f"{path}/data")
    return RandomForestClassificationModel.load(path)
