"""Quality classifier on supervised subword embeddings.

A document is the average of its words' vectors; a word's vector is the average of the learned
vectors of its features: the word itself and its character n-grams (word ends marked, case
kept), hashed into a fixed number of buckets. A word that repeats its predecessor has one more
feature, the same for all words. A softmax layer on the average gives the two labels'
probabilities. All vectors are trained by stochastic gradient descent in numpy.

The fit uses a bounded sample: the ``sample_rows`` labelled documents with the smallest hash of
their id (documented bound, default 3000; whole texts). Their features are hashed on the
executors; the driver gets one sparse row for each. Scoring covers every whole text. As averages
and the softmax's input are linear, a word's part in the score is one number, kept by the
workers, so scoring needs no vector work per word.

Labels, language, source and id are never inputs of a score.

Defined results: null and empty texts get the score of the bias alone; without usable labels the
score is 0.5 for all; labels other than 0 and 1 and labels without a document are left out; an
id with several labels counts each; a null id is never used for learning, and is held out if
``held_out`` says so (null ids count as not held out); an empty table gives an empty table.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import fresh, slices

BUCKETS = 1 << 17
GRAMS = (3, 4)
REPEAT = BUCKETS  # the feature of a word that repeats its predecessor
CACHE_WORDS = 150_000


@dataclass
class Model:
    """Feature vectors (BUCKETS + 1, dim), output weights (2, dim) and bias (2)."""

    vectors: np.ndarray
    weights: np.ndarray
    bias: np.ndarray

    def margins(self) -> np.ndarray:
        """Each feature's part in logit(1) - logit(0)."""
        return self.vectors @ (self.weights[1] - self.weights[0])

    def offset(self) -> float:
        return float(self.bias[1] - self.bias[0])


def bucket(gram: str) -> int:
    return zlib.crc32(gram.encode("utf-8")) % BUCKETS


def features(word: str) -> list[int]:
    """Bucket of the word and of each of its n-grams."""
    marked = f"<{word}>"
    grams = {marked[i : i + n] for n in GRAMS for i in range(len(marked) - n + 1)}
    return [bucket(g) for g in {marked, *grams}]


def document_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features of a text and their weights in its average."""
    words = text.split() if text else []
    if not words:
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    counts: dict[str, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    total: dict[int, float] = {}
    for w, n in counts.items():
        own = features(w)
        for f in own:
            total[f] = total.get(f, 0.0) + n / len(own)
    if repeats := sum(map(eq, words, words[1:])):
        total[REPEAT] = float(repeats)  # on top of the words' own parts
    ids = np.fromiter(total, np.int32, len(total))
    return ids, np.fromiter(total.values(), np.float32, len(total)) / np.float32(len(words))


def learnable(id_col: str, folds: int = 5, held: int = 0) -> Column:
    """Rows that may be learnt from: CRC-32 of the id as text, modulo ``folds``, is not ``held``."""
    return F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(folds)) != held


def sgd(rows: list[tuple[np.ndarray, np.ndarray, int]], dim: int = 8, epochs: int = 6, rate: float = 0.3, seed: int = 7) -> Model:
    """Fit by stochastic gradient descent, one document at a time, rate falling to zero."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / dim, 1 / dim, (BUCKETS + 1, dim)).astype(np.float32)
    weights, bias = rng.uniform(-0.1, 0.1, (2, dim)).astype(np.float32), np.zeros(2, np.float32)
    steps, step = max(1, epochs * len(rows)), 0
    for _ in range(epochs):
        for k in rng.permutation(len(rows)):
            ids, share, label = rows[k]
            lr = np.float32(rate * (1 - step / steps))
            step += 1
            own = vectors[ids]
            hidden = share @ own
            logits = weights @ hidden + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[label] -= 1
            back = p @ weights
            weights -= lr * np.outer(p, hidden)
            bias -= lr * p
            # a feature's step is not scaled by its share, as vectors are sparse and shares small
            vectors[ids] = own - lr * np.outer(share * min(len(ids), 64), back)
    return Model(vectors, weights, bias)


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = 3000, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fit on labelled rows of ``docs`` that are not held out. ``labels`` has doc_id and quality."""
    usable = labels.select(F.col("doc_id").alias("id"), "quality").where(learnable("id") & F.col("quality").isin(0, 1))
    sample = usable.orderBy(F.xxhash64("id"), "id", "quality").limit(sample_rows)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(sample, "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found = [document_features(t) for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    part.column(2),
                    pa.array([x[0] for x in found], pa.list_(pa.int32())),
                    pa.array([x[1] for x in found], pa.list_(pa.float32())),
                ],
                names=["id", "label", "ids", "share"],
            )

    slim = texts.select("id", "text", F.col("quality").cast("int").alias("label"))
    kind = slim.schema["id"].dataType.simpleString()
    got = slim.mapInArrow(run, f"id {kind}, label int, ids array<int>, share array<float>").toArrow()
    order = np.argsort(np.array([str(x) for x in got["id"].to_pylist()]), kind="stable").tolist()  # not by arrival
    columns = [got[c].combine_chunks() for c in ("ids", "share", "label")]
    return sgd([(columns[0][i].values.to_numpy(), columns[1][i].values.to_numpy(), columns[2][i].as_py()) for i in order])


class Scorer:
    """Scores texts with a model's margins; keeps each word's part."""

    def __init__(self, margins: np.ndarray, offset: float):
        self.margins, self.offset = margins.tolist(), offset
        self.words: dict[str, float] = {}
        self.grams: dict[str, float] = {}

    def _learn(self, words: set[str]) -> None:
        known, grams, margins = self.words, self.grams, self.margins
        if len(grams) > CACHE_WORDS:
            grams.clear()
        for w in words:
            marked = f"<{w}>"
            total = margins[bucket(marked)]
            own = {marked[i : i + n] for n in GRAMS for i in range(len(marked) - n + 1)}
            own.discard(marked)
            for g in own:
                m = grams.get(g)
                if m is None:
                    m = grams[g] = margins[bucket(g)]
                total += m
            known[w] = total / (1 + len(own))

    def scores(self, texts: list[str | None]) -> list[float]:
        if len(self.words) > CACHE_WORDS:
            self.words = {}
        known = self.words
        out = []
        for t in texts:
            words = t.split() if t else []
            unseen = {w for w in words if w not in known}
            if unseen:
                self._learn(unseen)
            total = sum(map(known.__getitem__, words)) + self.margins[REPEAT] * sum(map(eq, words, words[1:]))
            z = (total / len(words) if words else 0.0) + self.offset
            out.append(float(1 / (1 + np.exp(-np.clip(z, -50, 50)))))
        return out


_SCORERS: dict[int, Scorer] = {}


def _scorer(key: int, margins: np.ndarray, offset: float) -> Scorer:
    """The worker's scorer for a model; its memory of words serves all the tasks of the worker."""
    if key not in _SCORERS:
        _SCORERS.clear()
        _SCORERS[key] = Scorer(margins, offset)
    return _SCORERS[key]


def score(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """All columns and rows of ``docs`` and ``score_col``, the probability of label 1."""
    name = fresh(docs.columns, score_col)
    margins, offset = model.margins(), model.offset()
    key = zlib.crc32(margins.tobytes(), zlib.crc32(np.float64(offset).tobytes()))
    state = docs.sparkSession.sparkContext.broadcast((key, margins, offset))  # 0.5 MB, whatever the input
    at = docs.columns.index(text_col)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(*state.value)
        for part in slices(batches, at):
            values = pa.array(scorer.scores(part.column(at).to_pylist()), pa.float64())
            yield pa.RecordBatch.from_arrays([*part.columns, values], names=[*part.schema.names, name])

    return docs.mapInArrow(run, f"{fields}, `{name}` double")


def drop_rejected(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """The rows whose score reaches ``threshold``, columns unchanged."""
    scored = score(docs, model, text_col, fresh(docs.columns, "_score"))
    return scored.where(F.col(scored.columns[-1]) >= threshold).select(*[F.col(f"`{c}`") for c in docs.columns])
