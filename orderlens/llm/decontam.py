"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming, exact check.

An item of n words is compared with windows of n words of a document. Shingles are five words; an
item with fewer words is one shingle. Words are runs of bytes other than space, tab, line feed,
vertical tab, form feed and carriage return, with A-Z lower-cased. Two multisets of N shingles
whose weighted similarity (sum of the smaller counts over sum of the larger) reaches
``threshold`` (default 0.8) differ in a known number of shingles at most. So any set of one
shingle more holds a shared one: an item's rarest such set, by the benchmark's own counts, are
its anchors, and only windows that hold an anchor are looked at. A shingle that a third of the
items share is an anchor of none that has rarer ones.

Each such window gets a 64-bit SimHash of its shingles, from running sums of their bits. The
items' SimHashes are stored in ``RADIUS + 1`` tables, one for each block of bits, under anchor,
size and block: two fingerprints within ``RADIUS`` bits are equal in some block, so the look-up
finds every item of the anchor within the radius. (Blocks of 3 or 4 bits alone select nothing:
a window would meet nine tenths of the items of its size; the anchor in the key makes the
buckets short.) Every candidate is verified on the words themselves by the weighted similarity.

The items travel in blocks of about ``block_rows`` rows and ``block_bytes`` of text at most (one
longer item is a block of its own size), each broadcast by itself; the documents are read once
for each block and are never shuffled or collected. ``drop_contaminated`` writes what is left
after every ``HELD`` blocks, so that a task never holds more indexes than that.

Defined results: null and empty texts have no hits; null and empty items are left out; repeated
items count once, repeated documents each; ids may be null; a document shorter than an item can't
contain it; without items there are no hits; an empty table gives an empty table; other columns
are ignored by ``contaminated`` and kept by ``drop_contaminated``. Of an item's windows in a
document the most similar counts, of equals the first. ``threshold`` is above 0.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from orderlens.llm.common import WORD_BYTES, lower_ascii, slices, written

LENGTH = 5
RADIUS = 19
THRESHOLD = 0.8
BLOCK_ROWS = 50_000
BLOCK_BYTES = 16 << 20
HELD = 4  # indexes that a task of drop_contaminated holds
STARTS = 1 << 13  # words that the windows fingerprinted at a time begin in
WINDOWS = 512  # windows looked up at a time
COUNTS = 4096  # items whose shingle counts are kept
_P = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """Spread a 64-bit number's bits (SplitMix64's last steps)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Hash of every run of ``length`` word hashes."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(n, length, np.uint64)
    for k in range(length):
        total = total * _P + words[k : k + n]
    return _mix(total)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def window_prints(grams: np.ndarray, starts: np.ndarray, count: int) -> np.ndarray:
    """SimHash of the ``count`` grams from each (ascending) start; a bit is 1 if over half the hashes have it."""
    out = np.zeros(len(starts), np.uint64)
    weights = np.uint64(1) << np.arange(63, -1, -1, dtype=np.uint64)
    k = 0
    while k < len(starts):
        low = int(starts[k])
        part = starts[k : np.searchsorted(starts, low + STARTS)]
        bits = np.unpackbits(grams[low : int(part[-1]) + count].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        sums = np.zeros((len(bits) + 1, 64), np.int32)
        np.cumsum(bits, axis=0, out=sums[1:])
        votes = sums[part - low + count] - sums[part - low]
        out[k : k + len(part)] = ((votes * 2 > count) * weights).sum(1, dtype=np.uint64)
        k += len(part)
    return out


def weighted_similarity(a: Counter, b: Counter) -> float:
    """Sum of the smaller counts over sum of the larger ones."""
    shared = sum(min(n, b[g]) for g, n in a.items())
    return shared / (a.total() + b.total() - shared)


def shingles(words: list[bytes], length: int) -> Counter:
    return Counter(b" ".join(words[i : i + length]) for i in range(len(words) - length + 1))


def fewest_shared(count: int, threshold: float) -> int:
    """Shingles that two multisets of ``count`` must share to reach the threshold."""
    least = max(1, int(2 * count * threshold / (1 + threshold)) - 1)
    while least < count and least / (2 * count - least) < threshold:
        least += 1
    return least


def spread(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, value) of every value from low to before high of each row."""
    n = np.maximum(high - low, 0)
    row = np.repeat(np.arange(len(n)), n)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + low[row]


def _sorted(key: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (key, value) rows sorted by key."""
    order = np.lexsort((value, key))
    key, value = key[order], value[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (value[1:] != value[:-1])
    return key[new], value[new]


class ItemIndex:
    """Items by anchor, and their fingerprints by anchor, size and block of bits, as sorted arrays."""

    def __init__(self, items: list[tuple[object, str]], length: int = LENGTH, radius: int = RADIUS, threshold: float = THRESHOLD):
        self.radius, self.threshold, self.ids, self.words, self.grams = radius, threshold, [], [], []
        edges = np.linspace(0, 64, radius + 2).round().astype(int).tolist()
        self.blocks = [(np.uint64(a), np.uint64((1 << (b - a)) - 1)) for a, b in zip(edges, edges[1:], strict=False)]
        self._kept: dict[int, Counter] = {}
        hashes: list[np.ndarray] = []
        for item_id, text in items:
            words = WORD_BYTES.findall(lower_ascii(text))
            if words:
                self.ids.append(item_id)
                self.words.append(b" ".join(words))
                self.grams.append(min(length, len(words)))
                hashes.append(gram_hashes(word_hashes(words), self.grams[-1]))
        self.sizes = np.array([len(h) for h in hashes], np.int64) + np.array(self.grams, np.int64) - 1
        self.prints = np.array([window_prints(h, np.zeros(1, np.int64), len(h))[0] for h in hashes], np.uint64)
        own = [np.unique(h, return_counts=True) for h in hashes]
        known, items_with = np.unique(np.concatenate([u for u, _ in own]) if own else np.zeros(0, np.uint64), return_counts=True)
        chosen = []
        for n, (grams, counts) in zip(map(len, hashes), own, strict=True):
            order = np.lexsort((grams, items_with[np.searchsorted(known, grams)]))
            need = n - fewest_shared(n, threshold) + 1
            chosen.append(grams[order[: int(np.searchsorted(np.cumsum(counts[order]), need)) + 1]])
        item = np.repeat(np.arange(len(chosen)), [len(c) for c in chosen])
        anchor = np.concatenate(chosen) if chosen else np.zeros(0, np.uint64)
        tables = [self._bucket(anchor, self.sizes[item], b, self.prints[item]) for b in range(len(self.blocks))]
        self.keys, self.entries = _sorted(np.concatenate(tables), np.tile(item, len(tables)))
        self.anchors = {}
        for gram in sorted(set(self.grams)):
            at = np.array(self.grams)[item] == gram
            key, size = _sorted(anchor[at], self.sizes[item[at]])
            mask = np.uint64((1 << max(16, min(25, len(key).bit_length() + 3))) - 1)
            filter_ = np.zeros(int(mask) + 1, bool)
            filter_[(key & mask).astype(np.int64)] = True
            self.anchors[gram] = mask, filter_, key, size

    def _bucket(self, anchor: np.ndarray, size: np.ndarray, block: int, prints: np.ndarray) -> np.ndarray:
        shift, mask = self.blocks[block]
        table = (size * len(self.blocks) + block).astype(np.uint64)
        return _mix(_mix(anchor ^ _mix(table)) + (prints >> shift & mask))

    def _shingles(self, k: int) -> Counter:
        if k not in self._kept:
            if len(self._kept) >= COUNTS:
                self._kept.clear()
            self._kept[k] = shingles(self.words[k].split(b" "), self.grams[k])
        return self._kept[k]

    def candidates(self, hashes: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(shingle length, size, starts, items): windows and the items of an anchor within the radius."""
        for gram, (mask, filter_, keys, sizes) in self.anchors.items():
            grams = gram_hashes(hashes, gram)
            maybe = np.flatnonzero(filter_[(grams & mask).astype(np.int64)])
            row, at = spread(np.searchsorted(keys, grams[maybe]), np.searchsorted(keys, grams[maybe], "right"))
            places, size_of = maybe[row], sizes[at]
            for size in np.unique(size_of).tolist():
                last = len(hashes) - size
                at = places[size_of == size]
                low, high = np.maximum(at - (size - gram), 0), np.minimum(at, last)
                at, low, high = (x[low <= high] for x in (at, low, high))
                if not len(at):
                    continue
                mark = np.zeros(last + 2, np.int32)  # +1 where a stretch of starts begins, -1 after it
                np.add.at(mark, low, 1)
                np.add.at(mark, high + 1, -1)
                starts = np.flatnonzero(np.cumsum(mark[:-1]) > 0)
                prints = window_prints(grams, starts, size - gram + 1)
                for k in range(0, len(starts), WINDOWS):
                    part = starts[k : k + WINDOWS]
                    # both ends of the stretches ascend with their places
                    these = slice(np.searchsorted(high, part[0]), np.searchsorted(low, part[-1], "right"))
                    found = self._look_up(grams[at[these]], size, part, prints[k : k + WINDOWS], low[these], high[these])
                    yield gram, size, *found

    def _look_up(self, anchor, size, starts, prints, low, high) -> tuple[np.ndarray, np.ndarray]:
        # an anchor that occurs again adds only the windows after those it had
        order = np.argsort(anchor, kind="stable")
        anchor, low, high = anchor[order], low[order], high[order]
        again = np.flatnonzero(anchor[1:] == anchor[:-1]) + 1
        low[again] = np.maximum(low[again], high[again - 1] + 1)
        row, window = spread(np.searchsorted(starts, low), np.searchsorted(starts, high, "right"))
        found = []
        for b in range(len(self.blocks)):
            key = self._bucket(anchor[row], np.full(1, size), b, prints[window])
            hit, entry = spread(np.searchsorted(self.keys, key), np.searchsorted(self.keys, key, "right"))
            item, at = self.entries[entry], window[hit]
            near = np.bitwise_count(prints[at] ^ self.prints[item]) <= self.radius
            near &= self.sizes[item] == size
            found.append(at[near] * len(self.ids) + item[near])
        at, item = np.divmod(np.unique(np.concatenate(found)), len(self.ids))
        return starts[at], item

    def hits(self, text: str | None) -> list[tuple[object, float, int, int]]:
        """(item id, similarity, first word, words) of each item's most similar window, if it reaches the threshold."""
        words = WORD_BYTES.findall(lower_ascii(text))
        if not words or not self.ids:
            return []
        best: dict[int, tuple[float, int]] = {}
        for gram, size, starts, items in self.candidates(word_hashes(words)):
            own, held = Counter(), -1
            for start, k in zip(starts.tolist(), items.tolist(), strict=True):
                if start != held:
                    own, held = shingles(words[start : start + size], gram), start
                similarity = weighted_similarity(own, self._shingles(k))
                if similarity >= self.threshold and (similarity, -start) > best.get(k, (0.0, 0)):
                    best[k] = similarity, -start
        return [(self.ids[k], s, -start, int(self.sizes[k])) for k, (s, start) in sorted(best.items())]


def item_blocks(
    benchmark: DataFrame, id_col: str, text_col: str, length: int, radius: int, threshold: float, block_rows: int, block_bytes: int
) -> Iterator[ItemIndex]:
    """The distinct items as indexes of about ``block_rows`` items and ``block_bytes`` of text each."""
    items = benchmark.select(F.col(id_col).alias("item_id"), F.col(text_col).cast("string").alias("text"))
    items = items.where(F.col("text").isNotNull()).distinct()
    rows, size = items.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()
    blocks = max(-(-rows // block_rows), -(-size // block_bytes))
    for k in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).orderBy("item_id", "text")
        yield ItemIndex([tuple(r) for r in part.collect()], length, radius, threshold)


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    threshold: float = THRESHOLD,
    length: int = LENGTH,
    radius: int = RADIUS,
    block_rows: int = BLOCK_ROWS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """doc_id, item_id, similarity, start_word, n_words: every document and item it contains."""
    spark = docs.sparkSession
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    doc_type, item_type = slim.schema["doc_id"].dataType, benchmark.schema[item_id_col].dataType
    schema = f"doc_id {doc_type.simpleString()}, item_id {item_type.simpleString()}, similarity double, start_word long, n_words long"
    types = [to_arrow_type(doc_type), to_arrow_type(item_type), pa.float64(), pa.int64(), pa.int64()]
    names = ["doc_id", "item_id", "similarity", "start_word", "n_words"]
    found: list[DataFrame] = []
    for index in item_blocks(benchmark, item_id_col, item_text_col, length, radius, threshold, block_rows, block_bytes):
        shared = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for part in slices(batches):
                rows = [(d, *h) for d, t in zip(*(c.to_pylist() for c in part.columns), strict=True) for h in shared.value.hits(t)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

        found.append(slim.mapInArrow(run, schema))
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], schema)


def drop_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    threshold: float = THRESHOLD,
    length: int = LENGTH,
    radius: int = RADIUS,
    block_rows: int = BLOCK_ROWS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The rows of ``docs`` that contain no item, columns unchanged."""
    spark, at = docs.sparkSession, docs.columns.index(text_col)
    indexes = item_blocks(benchmark, item_id_col, item_text_col, length, radius, threshold, block_rows, block_bytes)
    for k, index in enumerate(indexes):
        if k and k % HELD == 0:
            docs = written(docs, "decontaminated")
        shared = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for part in slices(batches, at):
                yield part.filter(pa.array([not shared.value.hits(t) for t in part.column(at).to_pylist()], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
