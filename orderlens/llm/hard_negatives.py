"""Hard-negative mining: threshold joins over an inverted index with norm bounds (after L2AP).

Rows become whole-number vectors (floor of 256 times each component), written once. An anchor's
positives are its highest-scoring other rows of its label; for each positive, the negatives are
the highest-scoring rows of other labels whose score lies in a window set by the positive's score.

Index. A task turns each slice of rows into an inverted index: dimensions in order of weight, one
posting list for each. What follows a row's cut is left out of the index: there the norm of its
remaining components times the largest remaining norm of an anchor is under every threshold. Rows
are ordered by their cuts, so a posting list is a run of rows. The lists are read dimension group by
dimension group, adding to the partial scores of all anchors; a pair is dropped as soon as its
partial score plus the product of the two remaining norms is under the anchor's threshold. The
pairs that stay get the rest of their score from the components left out.

Thresholds. An anchor's search starts at a threshold above which a little more than enough rows are
expected (from the scores of a bounded sample; this decides only where a search begins). Windows that
don't fill are searched again at lower thresholds, down to their lower edge, so the result does not
depend on the sample. Inside a task a full window raises its threshold to its last entry.

Scale. Anchors are a stated query set: they go through the driver and a broadcast in blocks of about
``block_bytes`` (default 4 MB), and each block's searches read all rows. No rows are shuffled; a
task returns at most the first few of each window, which are then ranked by Spark, window by window.

Exactness. Scores are summed in doubles while every sum is under 2^53, in unbounded integers beyond;
a score beyond 64 bits is an error.

Defined results: rows with a null label, a null vector or a null or non-finite component take no
part; vectors of different length never meet; a null id is never an anchor's (the caller's condition
is null) and comes last among equal scores; rows that repeat an id are rows of their own, each an
anchor or an "other row" to its twin; a positive with a score under 0 has no negatives (its window
is empty), one with a score of 0 takes scores of 0; an empty table gives an empty table; other
columns are ignored. Ids and labels are whole numbers.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderlens.llm.common import slices, written
from orderlens.session import scratch_path

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90  # per cent of the positive's score
BLOCK_BYTES = 4 << 20
SAMPLE_ROWS = 4096
ROWS = 2048  # of a slice
TILE = 512  # anchors compared with a slice at a time
GROUP = 8  # dimensions between two prunings
EASE, MARGIN = 16, 4  # a lower threshold expects so many times the rows; the first so many times what is needed
EXACT = float(1 << 53)
_ROWS = "r long, id long, label long, q array<long>"


def prepared(vectors: DataFrame, anchor: Column, id_col: str, vector_col: str, label_col: str, scale: int = SCALE) -> DataFrame:
    """r (row number), id, label, q (whole-number vector) and anchor (flag) of the rows that take part."""
    v = F.col(vector_col).cast("array<double>")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = vectors.where(F.col(label_col).isNotNull() & F.coalesce(F.forall(v, finite), F.lit(False)))
    q = F.transform(v, lambda x: F.floor(x * scale).cast("long"))
    rows = rows.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), q.alias("q"), F.coalesce(anchor, F.lit(False)).alias("anchor"))
    return written(rows.withColumn("r", F.monotonically_increasing_id()), "vectors")


@dataclass
class Rows:
    """Rows of one length."""

    r: np.ndarray
    id: np.ndarray
    no_id: np.ndarray
    label: np.ndarray
    q: np.ndarray  # (rows, length), float64 or, beyond its whole numbers, object

    def take(self, at) -> Rows:
        return Rows(self.r[at], self.id[at], self.no_id[at], self.label[at], self.q[at])


def _by_length(batch: pa.RecordBatch | pa.Table) -> dict[int, Rows]:
    """A batch's rows, by vector length."""
    col = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
    q = col["q"].combine_chunks() if isinstance(col["q"], pa.ChunkedArray) else col["q"]
    flat, offsets = q.flatten().to_numpy(), q.offsets.to_numpy()
    offsets = offsets - offsets[0]
    size = np.diff(offsets)
    none = np.asarray(col["id"].is_null())
    r, ids, label = (np.asarray(col[n].fill_null(0)) for n in ("r", "id", "label"))
    out = {}
    for d in np.unique(size).tolist():
        at = np.flatnonzero(size == d)
        vec = flat[offsets[at][:, None] + np.arange(d)].astype(np.int64).reshape(len(at), d)
        big = float(np.abs(vec.astype(float)).max(initial=0))
        out[d] = Rows(r[at], ids[at], none[at], label[at], vec.astype(float) if big * big * d < EXACT else vec.astype(object))
    return out


def _norms(q: np.ndarray) -> np.ndarray:
    """Norms of what remains from each dimension on: (rows, length + 1)."""
    squares = np.cumsum((q.astype(float) ** 2)[:, ::-1], axis=1)[:, ::-1]
    return np.sqrt(np.hstack([squares, np.zeros((len(q), 1))])) * (1 + 1e-9)


def _fits(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both in doubles if no sum can pass 2^53, else both in unbounded integers."""
    top = [float(np.abs(x).max(initial=0)) for x in (a, b)]
    if a.dtype != object and b.dtype != object and top[0] * top[1] * a.shape[1] < EXACT:
        return a, b
    whole = lambda x: x if x.dtype == object else x.astype(np.int64).astype(object)
    return whole(a), whole(b)


def pairs_over(anchors: np.ndarray, rows: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, row, score) of all pairs whose score reaches the anchor's threshold."""
    anchors, rows = _fits(anchors, rows)
    d = rows.shape[1]
    order = np.argsort(-np.square(rows.astype(float)).sum(0), kind="stable")
    a, y = anchors[:, order], rows[:, order]
    left_a, left_y = _norms(a), _norms(y)
    # a row's cut: the first dimension from which on nothing can reach the lowest threshold
    covered = left_y * left_a.max(0, initial=0) < least.min()
    cut = np.where(covered.any(1), covered.argmax(1), d)
    by_cut = np.argsort(-cut, kind="stable")
    y, left_y, cut = y[by_cut], left_y[by_cut], cut[by_cut]
    live = int((cut > 0).sum()) if least.min() > 0 else len(y)
    y, left_y, cut = y[:live], left_y[:live], cut[:live]
    listed = np.where(np.arange(d) < cut[:, None], y, 0)  # the index; the rest of y is left out of it
    score = np.zeros((len(a), live), y.dtype)
    i = j = part = None
    for s in range(0, d, GROUP):
        e = min(s + GROUP, d)
        if i is None:
            n = int(np.searchsorted(-cut, -s))  # rows in some posting list of the group
            score[:, :n] += a[:, s:e] @ listed[:n, s:e].T
            rest = np.minimum(e, cut)  # what follows is not in the sums yet
            alive = score.astype(float) + left_a[:, rest] * left_y[np.arange(live), rest] >= least[:, None]
            if alive.sum() * 8 < alive.size or e == d:
                i, j = np.nonzero(alive)
                part = score[i, j]
        else:
            part = part + (a[i, s:e] * listed[j, s:e]).sum(1)
            rest = np.minimum(e, cut[j])
            alive = part.astype(float) + left_a[i, rest] * left_y[j, rest] >= least[i]
            i, j, part = i[alive], j[alive], part[alive]
    if i is None:  # no dimensions
        i, j = np.nonzero(score >= least[:, None])
        part = score[i, j]
    out = []
    for k in range(0, len(i), 1 << 15):
        p, q = i[k : k + (1 << 15)], j[k : k + (1 << 15)]
        total = part[k : k + (1 << 15)] + (a[p] * (y[q] - listed[q])).sum(1)
        good = total >= least[p]
        out.append((p[good], by_cut[q[good]], np.array([int(x) for x in total[good]], np.int64)))
    if not out:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


class _Best:
    """The first ``k`` of each window seen so far: by score, then by id, null ids last."""

    def __init__(self, n: int, k: int):
        self.k, self.full = k, np.zeros(n, np.int64)
        self.floor = np.full(n, np.iinfo(np.int64).min)  # of full windows: the score of the last one
        self.cols = [np.zeros(0, np.int64) for _ in range(5)]  # window, score, id, null id, row

    def add(self, window, score, ids, none, r) -> None:
        cols = [np.concatenate(x) for x in zip(self.cols, (window, score, ids, none, r), strict=True)]
        w, s, i, none = cols[:4]
        order = np.lexsort((i, none, -s, w))
        cols = [c[order] for c in cols]
        w, at = cols[0], np.arange(len(order))
        rank = at - np.maximum.accumulate(np.where(np.append(True, w[1:] != w[:-1]), at, 0)) if len(w) else at
        self.cols = [c[rank < self.k] for c in cols]
        last = np.flatnonzero(rank == self.k - 1)
        self.floor[w[last]] = cols[1][last]

    def batch(self) -> pa.RecordBatch:
        w, s, i, none, r = self.cols
        return pa.RecordBatch.from_arrays([pa.array(w, pa.int32()), pa.array(s), pa.array(i, mask=none.astype(bool)), pa.array(r)], names=["w", "score", "id", "r"])


@dataclass
class Searches:
    """Windows [least, most] of scores around anchors; ``same``: rows of the anchor's label (but not
    itself), else rows of others."""

    anchor: np.ndarray  # each window's anchor
    least: np.ndarray
    most: np.ndarray
    same: bool
    first: int  # rows wanted of each


def _found(rows: DataFrame, anchors, searches) -> DataFrame:
    """w (window), score, id, r: the first rows of every window, from each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups, want = anchors.value, searches.value
        best = _Best(len(want.anchor), want.first)
        for batch in slices(batches, text=3, rows=ROWS):
            for d, y in _by_length(batch).items():
                if d in groups:
                    number, a = groups[d]
                    for s in range(0, len(number), TILE):
                        _search(number[s : s + TILE], a.take(slice(s, s + TILE)), y, want, best)
        yield best.batch()

    return rows.mapInArrow(run, "w int, score long, id long, r long")


def _search(number: np.ndarray, a: Rows, y: Rows, want: Searches, best: _Best) -> None:
    lo, hi = np.searchsorted(want.anchor, number), np.searchsorted(want.anchor, number, side="right")
    used = np.flatnonzero(hi > lo)  # anchors that still search
    if not len(used):
        return
    lo, hi, a = lo[used], hi[used], a.take(used)
    now = np.maximum(want.least, best.floor)
    least = np.array([now[p:q].min() for p, q in zip(lo, hi, strict=True)], float)
    i, j, score = pairs_over(a.q, y.q, least)
    same = a.label[i] == y.label[j]
    fit = same & (a.r[i] != y.r[j]) if want.same else ~same
    i, j, score = i[fit], j[fit], score[fit]
    for k in range(int((hi - lo).max())):
        w = lo[i] + k
        real = w < hi[i]
        real[real] = (now[w[real]] <= score[real]) & (score[real] <= want.most[w[real]])
        if real.any():
            p = j[real]
            best.add(w[real], score[real], y.id[p], y.no_id[p].astype(np.int64), y.r[p])


def _ranked(found: DataFrame, first: int) -> DataFrame:
    order = Window.partitionBy("w").orderBy(F.desc("score"), F.asc_nulls_last("id"), "r")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= first)


# ------------------------------------------------------------------ thresholds
_Z = np.linspace(-9, 9, 3601)
_TAIL = np.array([0.5 * math.erfc(z / math.sqrt(2)) for z in _Z])


def _above(z: np.ndarray) -> np.ndarray:
    return np.interp(z, _Z, _TAIL)


def _z(tail: np.ndarray) -> np.ndarray:
    """The standard value that a share ``tail`` of a normal distribution exceeds."""
    return np.interp(-np.log(np.maximum(tail, _TAIL[-1])), -np.log(_TAIL), _Z)


@dataclass
class Spread:
    """Mean and deviation of each anchor's scores over a sample, and the share of its label there."""

    mean: np.ndarray
    sd: np.ndarray
    share: np.ndarray


def _spread(groups: dict, sample: dict[int, Rows], n: int) -> Spread:
    out = Spread(np.zeros(n), np.zeros(n), np.ones(n))
    total = sum(len(s.r) for s in sample.values())
    for d, (number, a) in groups.items():
        if d in sample:
            scores = a.q.astype(float) @ sample[d].q.astype(float).T
            out.mean[number], out.sd[number] = scores.mean(1), scores.std(1)
            out.share[number] = [max(1, (sample[d].label == x).sum()) / total for x in a.label]
    return out


def _start(spread: Spread, anchor: np.ndarray, most: np.ndarray, low: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Thresholds with a share ``wanted`` of all rows expected between them and ``most``; ``low`` at the least."""
    mean, sd = spread.mean[anchor], spread.sd[anchor]
    tail = _above((most - mean) / np.maximum(sd, 1e-9)) + wanted
    return np.where((tail >= 0.5) | (sd <= 0), low, np.clip(np.ceil(mean + sd * _z(tail)), low, np.maximum(most, low))).astype(np.int64)


def _search_until_full(rows: DataFrame, anchors, spread: Spread, searches: Searches, low: np.ndarray, need: np.ndarray) -> Iterator[tuple]:
    """Rounds of (window numbers that are done, their ranked rows); ``need``: share of all rows for a full window."""
    sc = rows.sparkSession.sparkContext
    todo = np.arange(len(searches.anchor))
    while len(todo):
        least = _start(spread, searches.anchor[todo], searches.most[todo], low[todo], need[todo])
        sent = sc.broadcast(replace(searches, anchor=searches.anchor[todo], least=least, most=searches.most[todo]))
        found = written(_ranked(_found(rows, anchors, sent), searches.first), "found")
        count = np.zeros(len(todo), np.int64)
        for r in found.groupBy("w").count().toArrow().to_pylist():
            count[r["w"]] = r["count"]
        done = (count >= searches.first) | (least <= low[todo])
        yield todo, done, found
        sent.destroy()
        todo, need = todo[~done], need * EASE


def hard_negatives(
    vectors: DataFrame,
    anchor: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    block_bytes: int = BLOCK_BYTES,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for each row that
    fulfils ``anchor`` and each of its first ``positives`` rows of the same label, the first
    ``negatives`` rows of other labels with a score of ``low`` to ``high`` per cent of the positive's."""
    spark = vectors.sparkSession
    everything = prepared(vectors, anchor, id_col, vector_col, label_col)
    rows = everything.select("r", "id", "label", "q")
    total = rows.count()
    size = everything.where("anchor").agg(F.sum(F.size("q") * 8 + 32)).first()[0] or 0
    blocks = -(-size // block_bytes)
    out = scratch_path(spark, "negatives")
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    spark.createDataFrame([], schema).write.parquet(out)
    sample = _by_length(rows.orderBy(F.xxhash64("r"), "r").limit(sample_rows).toArrow())
    for b in range(blocks):
        block = everything.where("anchor").where(F.pmod(F.xxhash64("r"), F.lit(blocks)) == b)
        tab = block.select("r", "id", "label", "q").toArrow()
        if tab.num_rows:
            _mine(rows, tab, sample, total, positives, negatives, low, high).write.mode("append").parquet(out)
    return spark.read.schema(schema).parquet(out)


def _mine(rows: DataFrame, tab: pa.Table, sample: dict, total: int, positives: int, negatives: int, low: int, high: int) -> DataFrame:
    """The result of one block of anchors."""
    spark = rows.sparkSession
    groups, start = {}, 0
    for d, g in _by_length(tab).items():
        groups[d] = (np.arange(start, start + len(g.r)), g)
        start += len(g.r)
    spread = _spread(groups, sample, start)
    anchors = spark.sparkContext.broadcast(groups)
    ids = np.concatenate([g.id for _, g in groups.values()])
    # positives: scores under 0 have no window
    every = np.arange(start)
    search = Searches(every, np.zeros(start, np.int64), np.full(start, np.iinfo(np.int64).max), True, positives)
    near = []
    need = np.minimum(0.5, MARGIN * positives / np.maximum(1, total * spread.share))
    for todo, done, found in _search_until_full(rows, anchors, spread, search, np.zeros(start, np.int64), need):
        near += [(int(todo[x["w"]]), x["id"], x["score"]) for x in found.toArrow().to_pylist() if done[x["w"]]]
    # a window for every positive score of an anchor
    score = sorted({(a, s) for a, _, s in near})
    number = {w: k for k, w in enumerate(score)}
    at = np.array([a for a, _ in score], np.int64)
    edges = [(-(-low * s // 100), high * s // 100) for _, s in score]
    least, most = (np.array([e[k] for e in edges], np.int64) for k in (0, 1))
    search = Searches(at, least, most, False, negatives)
    links = spark.createDataFrame([(int(ids[a]), p, s, number[a, s]) for a, p, s in near], "anchor_id long, positive_id long, positive_score long, window int")
    parts = []
    for todo, done, found in _search_until_full(rows, anchors, spread, search, least, np.full(len(at), MARGIN * negatives / max(1, total))):
        named = spark.createDataFrame([(k, int(w)) for k, w in enumerate(todo) if done[k]], "w int, window int")
        parts.append(found.join(named, "w").select("window", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score")))
    found = parts[0] if parts else spark.createDataFrame([], "window int, rank int, negative_id long, negative_score long")
    for more in parts[1:]:
        found = found.unionByName(more)
    return links.join(found, "window").select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
