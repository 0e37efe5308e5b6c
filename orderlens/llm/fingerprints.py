"""Document fingerprints: invertible Bloom lookup sketches of a text's paragraphs.

Each paragraph is hashed (XXH64; equal paragraphs of one text are told apart by their number of
occurrence, so a text is a set of digests). A digest is added to one cell of each third of the
sketch; a cell holds a count, the sum of its digests and the sum of their check values. Two
sketches subtract cell by cell, and what they share is gone. A cell left with one digest that
agrees with its check value gives that digest away; taking it out of its other cells frees more
(peeling), until all differing digests are known. If cells remain, both texts get a sketch of
four times the size, with other cell hashes, and so on until nothing remains; a sketch of about
one and a half times the number of differences peels. The likeness of two fingerprints is the number
of common digests over the number of all, from the digests recovered.

A paragraph is a line, or with ``passage_words`` a passage of a line: a line is also cut behind words
whose own bytes say so, one word in ``passage_words`` on average (and four times as many words behind
a cut at the latest), so that an edit inside a long line changes only the passages around it. White space around paragraphs does not count.

The next document. Documents are dealt to ranges of the order (id descending, null last, then text),
whose limits are the keys of existing documents taken by a hash of the key; they decide only the
balance. The document that begins a range is also sent to the range before it, and the first of all
to the last one. So each task finds a document's successor in its own sorted rows: texts are
shuffled once, no global window, nothing but range limits on the driver.

Defined results: a null text is empty; an empty text has an empty sketch and likeness 1 with another
empty one; rows that repeat an id and a text are one document and each gets its result (a group of
copies is merged before the texts are dealt, and given out again in parts); the only document is its
own next; an empty table gives an empty table; other columns are ignored; ids are whole numbers.
A task's memory follows its longest text.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from orderlens.llm.common import slices, written

CELLS = 12  # of the fingerprint that is returned; three thirds
GROWTH = 4
PASSAGE_WORDS = 4
LONGEST = 4  # times passage_words: a passage is cut there at the latest
RANGES = 4  # ranges of the order for each shuffle partition
SAMPLES = 16  # sampled keys for each range limit
COPIES = 4096  # copies of one document given out by one row
_CELL = np.dtype([("n", "<i4"), ("key", "<u8"), ("check", "<u4")])


def _mix(x: np.ndarray, seed: int) -> np.ndarray:
    """64 mixed bits of each value (the finalizer of splitmix64; its constants are fixed values)."""
    x = x + np.uint64(0x9E3779B97F4A7C15 * (seed + 1) & (1 << 64) - 1)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def paragraph_digests(texts: list[str], passage_words: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(text number, digest) of all paragraphs, sorted by both, every pair once."""
    raw = [t.encode("utf-8") for t in texts]
    data = b"\n".join(raw) + b"\n"
    a = np.frombuffer(data, np.uint8)
    word = (a != 32) & ((a < 9) | (a > 13))
    starts, ends = np.flatnonzero(word & ~np.append(False, word[:-1])), np.flatnonzero(word[:-1] & ~word[1:]) + 1
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    line = np.cumsum(a == 10, dtype=np.int64)[starts]
    new = np.append(True, line[1:] != line[:-1])
    if passage_words:
        total = np.append(0, np.cumsum(a, dtype=np.int64))
        weight = (total[ends] - total[starts]).astype(np.uint64) * np.uint64(1 << 20) + a[ends - 1] * np.uint64(256) + a[starts]
        new[1:] |= (_mix(weight, 0) % np.uint64(passage_words) == 0)[:-1]
        at = np.arange(len(new))
        new = (at - np.maximum.accumulate(np.where(new, at, 0))) % (LONGEST * passage_words) == 0
    first = np.flatnonzero(new)
    begin, end = starts[first], ends[np.append(first[1:], len(starts)) - 1]
    digest = np.fromiter((xxh64_intdigest(data[s:e]) for s, e in zip(begin.tolist(), end.tolist(), strict=True)), np.uint64, len(first))
    size = np.array([len(r) + 1 for r in raw], np.int64)
    text = np.searchsorted(np.cumsum(size), begin, side="right")
    # the second, third, ... equal paragraph of a text gets a digest of its own
    order = np.lexsort((digest, text))
    text, digest = text[order], digest[order]
    again = np.append(False, (text[1:] == text[:-1]) & (digest[1:] == digest[:-1]))
    at = np.arange(len(text))
    nth = at - np.maximum.accumulate(np.where(again, 0, at))
    digest = np.where(again, _mix(digest + nth.astype(np.uint64), 77), digest)
    order = np.lexsort((digest, text))
    text, digest = text[order], digest[order]
    once = np.append(True, (text[1:] != text[:-1]) | (digest[1:] != digest[:-1]))
    return text[once], digest[once]


class Sketches:
    """Sketches of equal size, one for each of ``n`` texts."""

    def __init__(self, n: int, cells: int, seed: int = 0):
        self.cells, self.seed = cells, seed
        self.n = np.zeros(n * cells, np.int32)
        self.key = np.zeros(n * cells, np.uint64)
        self.check = np.zeros(n * cells, np.uint32)

    def _at(self, text: np.ndarray, digest: np.ndarray) -> np.ndarray:
        third = self.cells // 3
        return np.concatenate([text * self.cells + h * third + (_mix(digest, 3 * self.seed + h + 1) % np.uint64(third)).astype(np.int64) for h in range(3)])

    def add(self, text: np.ndarray, digest: np.ndarray, sign: np.ndarray | int = 1) -> np.ndarray:
        """Add (or with sign -1 take out) digests; the cells that were touched."""
        at, sign = self._at(text, digest), np.tile(np.broadcast_to(np.asarray(sign, np.int64), len(text)), 3)
        key = np.tile(digest, 3)
        check = np.tile((_mix(digest, 1000) >> np.uint64(32)).astype(np.uint32), 3)
        np.add.at(self.n, at, sign.astype(np.int32))
        np.add.at(self.key, at, key * sign.astype(np.uint64))
        np.add.at(self.check, at, check * sign.astype(np.uint32))
        return at

    def minus(self, other: Sketches) -> Sketches:
        out = Sketches(0, self.cells, self.seed)
        out.n, out.key, out.check = self.n - other.n, self.key - other.key, self.check - other.check
        return out

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(text, digest, sign) of what comes off, and for each text whether nothing is left.
        Takes the sketch apart."""
        found, at = [], np.arange(len(self.n))
        while len(at := at[np.abs(self.n[at]) == 1]):
            sign = self.n[at].astype(np.int64)
            digest = self.key[at] * sign.astype(np.uint64)
            check = self.check[at] * sign.astype(np.uint32)
            good = (_mix(digest, 1000) >> np.uint64(32)).astype(np.uint32) == check
            text, digest, sign = at[good] // self.cells, digest[good], sign[good]
            order = np.lexsort((digest, text))
            text, digest, sign = text[order], digest[order], sign[order]
            once = np.append(True, (text[1:] != text[:-1]) | (digest[1:] != digest[:-1]))[: len(text)]
            text, digest, sign = text[once], digest[once], sign[once]
            at = np.unique(self.add(text, digest, -sign))
            found.append((text, digest, sign))
        left = ((self.n != 0) | (self.key != 0) | (self.check != 0)).reshape(-1, self.cells).any(1)
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64), ~left
        return *(np.concatenate(x) for x in zip(*found, strict=True)), ~left

    def names(self) -> list[str]:
        """Each sketch as hexadecimal text: count, digest sum and check sum of every cell."""
        cells = np.empty(len(self.n), _CELL)
        cells["n"], cells["key"], cells["check"] = self.n, self.key, self.check
        raw, size = cells.tobytes(), self.cells * _CELL.itemsize
        return [raw[k : k + size].hex() for k in range(0, len(raw), size)]


def _select(text: np.ndarray, digest: np.ndarray, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The digests of some texts (ascending numbers), renumbered from 0."""
    lo, hi = np.searchsorted(text, some), np.searchsorted(text, some, side="right")
    size = hi - lo
    at = np.repeat(lo - (np.cumsum(size) - size), size) + np.arange(size.sum())
    return np.repeat(np.arange(len(some)), size), digest[at]


def differences(a: tuple, b: tuple, n: int, cells: int = CELLS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, digest, sign): the digests in one of two versions only, 1 for a and -1 for b, of the
    texts 0 to n-1; and the number of cells at which each text's difference peeled."""
    out, needed, seed = [], np.zeros(n, np.int64), 0
    some = np.arange(n)
    while len(some):
        pair = []
        for text, digest in (a, b):
            s = Sketches(len(some), cells, seed)
            s.add(*_select(text, digest, some))
            pair.append(s)
        text, digest, sign, done = pair[0].minus(pair[1]).peel()
        keep = done[text]
        out.append((some[text[keep]], digest[keep], sign[keep]))
        needed[some[done]] = cells
        some, cells, seed = some[~done], cells * GROWTH, seed + 1
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64), needed
    return *(np.concatenate(x) for x in zip(*out, strict=True)), needed


def likeness(a: tuple, b: tuple, n: int, cells: int = CELLS) -> np.ndarray:
    """Common digests over all digests of each pair of texts; 1 if both have none."""
    apart = np.bincount(differences(a, b, n, cells)[0], minlength=n)
    both = np.bincount(a[0], minlength=n) + np.bincount(b[0], minlength=n)
    return np.where(both > 0, (both - apart) / np.maximum(both + apart, 1), 1.0)


# ------------------------------------------------------------------ versions of a document
def changed_paragraphs(
    versions: DataFrame, id_col: str = "doc_id", old_col: str = "old", new_col: str = "new", passage_words: int | None = None
) -> DataFrame:
    """id, removed and added (sorted digests of paragraphs in one version only), and the number of
    cells that the difference needed. No shuffle; null texts are empty."""
    columns = versions.select(F.col(id_col).alias("id"), F.coalesce(old_col, F.lit("")).alias("old"), F.coalesce(new_col, F.lit("")).alias("new"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(slices(batches), text=2):
            n = batch.num_rows
            old, new = (paragraph_digests(batch.column(c).to_pylist(), passage_words) for c in (1, 2))
            text, digest, sign, cells = differences(old, new, n)
            lists = []
            for s in (1, -1):
                t, d = text[sign == s], digest[sign == s]
                order = np.lexsort((d, t))
                offsets = np.append(0, np.cumsum(np.bincount(t, minlength=n))).astype(np.int32)
                lists.append(pa.ListArray.from_arrays(offsets, pa.array(d[order].view(np.int64))))
            yield pa.RecordBatch.from_arrays([batch.column(0), *lists, pa.array(cells)], names=["id", "removed", "added", "cells"])

    kind = versions.schema[id_col].dataType.simpleString()
    return columns.mapInArrow(run, f"id {kind}, removed array<long>, added array<long>, cells long").withColumnRenamed("id", id_col)


# ------------------------------------------------------------------ a document and the next one
def _successors(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """docs (id, th, text, copies) dealt so that each document's next one follows it: p (range), extra
    (a row that is there only as a successor). The rows of a partition are sorted. ``keys`` has
    each id and th once."""
    spark = docs.sparkSession
    order = F.struct(F.col("id").isNull().alias("none"), F.bitwise_not(F.coalesce("id", F.lit(0))).alias("down"), "th")
    n, first = keys.agg(F.count("*"), F.min(order)).first()
    ranges = RANGES * int(spark.conf.get("spark.sql.shuffle.partitions"))
    every = max(1, n // (SAMPLES * ranges))
    drawn = keys.where(F.pmod(F.xxhash64("id", "th", F.lit(7)), F.lit(every)) == 0).select(order.alias("k")).collect()
    drawn = sorted(tuple(r.k) for r in drawn)
    step = max(1, -(-len(drawn) // ranges))
    limits, first = drawn[step::step], first and tuple(first)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text=2):
            rows, part, extra = [], [], []
            for k, (i, th) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                key = (i is None, ~(i or 0), th)
                p = bisect_right(limits, key)
                also = [p - 1] if p and limits[p - 1] == key else []
                also += [len(limits)] if key == first else []
                rows += [k] * (1 + len(also))
                part += [p, *also]
                extra += [False] + [True] * len(also)
            out = batch.take(pa.array(rows, pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(extra), *out.columns], names=["p", "extra", *batch.schema.names])

    dealt = docs.select("id", "th", "text", "copies").mapInArrow(deal, "p int, extra boolean, id long, th long, text string, copies long")
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return dealt.repartition(n_parts, "p").sortWithinPartitions("p", "extra", F.desc_nulls_last("id"), "th", "text")


def _merged(docs: DataFrame, repeated: DataFrame) -> DataFrame:
    """docs (id, th, text) with the rows of the repeated keys (i, t) merged, and copies. The others are
    not grouped."""
    same = F.col("id").eqNullSafe(F.col("i")) & (F.col("th") == F.col("t"))
    once = docs.join(repeated, same, "left_anti").withColumn("copies", F.lit(1).cast("long"))
    return once.unionByName(docs.join(repeated, same, "left_semi").groupBy("id", "th", "text").agg(F.count("*").alias("copies")))


def _given_out(results: DataFrame) -> DataFrame:
    """Each result once for every copy; many copies are dealt out in parts."""
    results = written(results, "fingerprints")
    n = int(results.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = F.explode(F.sequence(F.lit(1).cast("long"), F.ceil(F.col("copies") / COPIES)))
    parts = results.where("copies > 1").withColumn("part", part).repartition(n)
    size = F.least(F.lit(COPIES).cast("long"), F.col("copies") - (F.col("part") - 1) * COPIES)
    many = parts.withColumn("k", F.explode(F.sequence(F.lit(1).cast("long"), size))).select(results.columns)
    return results.where("copies = 1").unionByName(many)


def edited_fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", cells: int = CELLS, passage_words: int | None = PASSAGE_WORDS
) -> DataFrame:
    """For every document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited
    and near_next. The edited text has the last half of its code points replaced by the first as
    many of the next document (descending id; after the last comes the first)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("th"), text.alias("text"))
    keys = written(rows.groupBy("id", "th").agg(F.count("*").alias("n")), "order")
    repeated = written(keys.where("n > 1").select(F.col("id").alias("i"), F.col("th").alias("t")), "repeated")
    copied = not repeated.isEmpty()
    rows = _merged(rows, repeated) if copied else rows.withColumn("copies", F.lit(1).cast("long"))

    def compare(rows: list[tuple]) -> pa.RecordBatch:
        texts = [r[3] for r in rows]
        mine = [k for k in range(len(rows) - 1) if not rows[k][1]]
        edited = []
        for k in mine:
            half = len(texts[k]) // 2
            edited.append(texts[k][: len(texts[k]) - half] + texts[k + 1][:half])
        n = len(mine)
        whole = paragraph_digests(texts, passage_words)
        own, after = _select(*whole, np.array(mine, np.int64)), _select(*whole, np.array(mine, np.int64) + 1)
        other = paragraph_digests(edited, passage_words)
        prints = []
        for digests in (own, other):
            s = Sketches(n, cells)
            s.add(*digests)
            prints.append(pa.array(s.names(), pa.string()))
        return pa.RecordBatch.from_arrays(
            [
                pa.array([rows[k][2] for k in mine], pa.int64()),
                pa.array([len(texts[k]) for k in mine], pa.int64()),
                pa.array([hashlib.sha256(t.encode("utf-8")).hexdigest() for t in edited], pa.string()),
                *prints,
                pa.array(likeness(own, other, n, cells), pa.float64()),
                pa.array(likeness(own, after, n, cells), pa.float64()),
                pa.array([rows[k][4] for k in mine], pa.int64()),
            ],
            names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "copies"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in slices(batches, text=3):
            held += zip(*(c.to_pylist() for c in batch.columns), strict=True)
            yield compare(held)
            held = held[-1:]  # its successor comes with the next slice

    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, copies long"
    out = _successors(rows, keys).select("p", "extra", "id", "text", "copies").mapInArrow(run, schema)
    return (_given_out(out) if copied else out).drop("copies")
