"""Near-duplicate vectors: iterative quantisation, multi-index Hamming tables, exact rerank.

Fit. On a bounded sample (the ``sample_rows`` vectors with the smallest id hash, default 8192) the
principal axes are taken and a rotation is learned that brings the projections near the corners
of a cube (iterative quantisation), so that the bits share the spread evenly. The origin stays
the centre, as cosines are measured from it: centred on the mean, the codes of one large group
of near copies would be noise. The rotation is a few 10 KB.

Index. Every distinct vector gets its ``BITS``-bit code, cut into ``RADIUS + m`` blocks. There
is a table for each choice of m blocks; a vector enters it under its label, length and the bits of
those blocks. Codes that differ in ``RADIUS`` bits or fewer agree in m blocks at least, whatever m
is, so they meet in some table. m follows the number of distinct vectors (``plan_tables``): more
blocks in a key make the buckets smaller and the tables more. So 6 tables of 11 bits serve small
inputs and 56 of 24 bits serve 10^9 vectors, under the same guarantee. Vectors at the threshold of
0.98 differ in about four of 64 bits; recall against brute force is measured in the tests.

Search. Each table's buckets are compared inside a task. A pair that meets in several tables
counts in the first one only, which the two codes tell, so no pairs are shuffled or made
distinct. Each candidate pair is reranked by the cosine of the original vectors in double
precision. A bucket over ``TILE`` vectors is cut into parts and every two parts meet in a unit of
their own, so all pairs are still compared and no task holds more than two parts. A unit gives
link counts for each vector and a star forest of its links, never the pairs.

Copies of a vector under one label are one node; they link with each other, and their number
counts in the others' links.

Defined results: vectors that are null, zero or hold null or non-finite components, and rows
without a label, link with nothing; vectors of different length never link; a null id is never
a component's id unless no other is there; rows that repeat an id are vectors of their own;
an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.components import components, contract
from orderlens.session import cut_lineage

BITS = 64
RADIUS = 5
ENTRY_COST = 50  # comparisons that cost as much as one more entry of a vector in a table
MOST_TABLES = 2000
TILE = 1024
THRESHOLD = 0.98
SAMPLE_ROWS = 8192
ROUNDS = 40


@dataclass
class Quantiser:
    axes: np.ndarray  # (dim, bits)

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        """64-bit codes of unit vectors; vectors of another length are cut or filled with zeros."""
        dim, bits = self.axes.shape
        if vectors.shape[1] != dim:
            fitted = np.zeros((len(vectors), dim))
            fitted[:, : vectors.shape[1]] = vectors[:, :dim]
            vectors = fitted
        sign = vectors @ self.axes > 0
        return (sign.astype(np.uint64) << np.arange(bits, dtype=np.uint64)).sum(1, dtype=np.uint64)


def learn_rotation(sample: np.ndarray, bits: int = BITS, rounds: int = ROUNDS, seed: int = 11) -> Quantiser:
    """Principal axes and the rotation that makes their signs the best code of the sample."""
    dim = sample.shape[1]
    bits = min(bits, dim)
    axes = np.linalg.eigh(sample.T @ sample)[1][:, ::-1][:, :bits]
    low = sample @ axes
    turn = np.linalg.qr(np.random.default_rng(seed).standard_normal((bits, bits)))[0]
    for _ in range(rounds):
        corners = np.where(low @ turn > 0, 1.0, -1.0)
        left, _, right = np.linalg.svd(corners.T @ low)
        turn = (left @ right).T
    return Quantiser(axes @ turn)


def _units(vectors: np.ndarray) -> np.ndarray:
    """Rows divided by their length; the largest component goes first, so that no square overflows."""
    big = np.abs(vectors).max(1, keepdims=True)
    scaled = vectors / np.where(big > 0, big, 1)
    return scaled / np.sqrt((scaled * scaled).sum(1, keepdims=True))


@dataclass
class Tables:
    """The Hamming tables: each block's bits, each table's bits, and the first table of a pair."""

    blocks: np.ndarray  # bits of each block
    masks: np.ndarray  # bits of each table's key
    first: np.ndarray  # by the set of blocks that differ: the first table whose blocks all agree

    def meet(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The first table in which codes meet; the number of tables if they meet in none."""
        apart, differ = a ^ b, np.zeros(len(a), np.int64)
        for k, bits in enumerate(self.blocks):
            differ |= ((apart & bits) != 0).astype(np.int64) << k
        return self.first[differ]


def make_tables(bits: int, radius: int, agree: int) -> Tables:
    """A table for each choice of ``agree`` of ``radius + agree`` blocks."""
    n = radius + agree
    edge = np.linspace(0, bits, n + 1).round().astype(int).tolist()
    blocks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edge, edge[1:], strict=False)]
    chosen = list(combinations(range(n), agree))
    sets = np.arange(1 << n)
    first = np.full(1 << n, len(chosen), np.int64)
    for t in range(len(chosen) - 1, -1, -1):
        first[(sets & sum(1 << k for k in chosen[t])) == 0] = t
    masks = [sum(blocks[k] for k in c) for c in chosen]
    return Tables(np.array(blocks, np.uint64), np.array(masks, np.uint64), first)


def plan_tables(rows: int, bits: int, radius: int = RADIUS) -> int:
    """Blocks in a key that make the search of ``rows`` vectors cheapest: entries against comparisons
    in buckets of evenly used codes."""

    def cost(agree: int) -> float:
        return comb(radius + agree, agree) * (ENTRY_COST + rows / 2 ** (bits * agree / (radius + agree)))

    fits = [m for m in range(1, 20) if radius + m <= bits and comb(radius + m, m) <= MOST_TABLES]
    return min(fits, key=cost, default=1)


class _Links:
    """Link counts and contracted links of a task."""

    def __init__(self):
        self.ids, self.sums, self.u, self.v = [], [], [], []

    def add(self, a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> None:
        if len(a):
            ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
            self.ids.append(ids)
            self.sums.append(np.bincount(at, np.concatenate([nb, na]), len(ids)).astype(np.int64))
            u, v = contract(a, b)
            self.u.append(u)
            self.v.append(v)

    def flush(self) -> pa.RecordBatch | None:
        if not self.ids:
            return None
        ids, at = np.unique(np.concatenate(self.ids), return_inverse=True)
        sums = np.zeros(len(ids), np.int64)
        np.add.at(sums, at, np.concatenate(self.sums))
        u, v = contract(np.concatenate(self.u), np.concatenate(self.v))
        self.__init__()
        root = np.arange(len(ids))
        to = dict(zip(u.tolist(), v.tolist(), strict=True))
        return pa.RecordBatch.from_arrays(
            [pa.array(ids), pa.array(sums), pa.array([to.get(i, i) for i in ids[root].tolist()], pa.int64())], names=["node", "n", "to"]
        )


def _pairs(group: np.ndarray, side: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs inside each run of equal ``group``; of two sides (0, 1) only pairs across, 2 is all with all."""
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    sizes = np.diff(np.r_[starts, len(group)])
    small = sizes <= 24
    room = np.repeat(np.where(small, starts + sizes, 0), sizes)  # end of each row's small group
    at = np.arange(len(group))
    for step in range(1, int(sizes[small].max(initial=1))):
        i = at[at + step < room]
        i = i[(side[i] == 2) | (side[i] != side[i + step])]
        yield i, i + step
    for s, n in zip(starts[~small].tolist(), sizes[~small].tolist(), strict=True):
        if side[s] == 2:
            for k in range(s, s + n - 1, 256):
                rows = np.arange(k, min(k + 256, s + n))
                i, j = np.repeat(rows, n), np.tile(np.arange(s, s + n), len(rows))
                yield i[j > i], j[j > i]
        else:
            own = np.arange(s, s + n)
            a, b = own[side[s : s + n] == 0], own[side[s : s + n] == 1]
            for k in range(0, len(a), 256):
                yield np.repeat(a[k : k + 256], len(b)), np.tile(b, len(a[k : k + 256]))


def _bucket_links(dealt: DataFrame, tables: Tables, threshold: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        links, kept = _Links(), None
        for batch in batches:
            tab = pa.Table.from_batches([batch])
            tab = tab if kept is None else pa.concat_tables([kept, tab])
            unit = tab["unit"].to_numpy()
            cut = int(np.searchsorted(unit, unit[-1]))  # the last unit may go on in the next batch
            kept = tab.slice(cut)
            if cut:
                _compare(tab.slice(0, cut), tables, threshold, links)
                if (out := links.flush()) is not None:
                    yield out
        if kept is not None and kept.num_rows:
            _compare(kept, tables, threshold, links)
            if (out := links.flush()) is not None:
                yield out

    return dealt.mapInArrow(run, "node long, n long, to long")


def _compare(tab: pa.Table, tables: Tables, threshold: float, links: _Links) -> None:
    node, count, code = tab["node"].to_numpy(), tab["copies"].to_numpy(), tab["code"].to_numpy().view(np.uint64)
    table, side = tab["tab"].to_numpy(), tab["side"].to_numpy()
    unit, check = tab["unit"].to_numpy(), tab["check"].to_numpy()
    group = np.cumsum(np.r_[True, (unit[1:] != unit[:-1]) | (check[1:] != check[:-1])])
    col = tab["vector"].combine_chunks()
    flat, offsets = col.flatten().to_numpy(), col.offsets.to_numpy()
    size = np.diff(offsets)
    for i, j in _pairs(group, side):
        if not len(i):
            continue
        first = tables.meet(code[i], code[j]) == table[i]  # no earlier table has the pair
        i, j = i[first], j[first]
        for k in range(0, len(i), 1 << 14):
            a, b = i[k : k + (1 << 14)], j[k : k + (1 << 14)]
            dim = int(size[a[0]]) if len(a) else 0
            if len(a) and (size[a] == dim).all():
                at = np.arange(dim)
                start = offsets - offsets[0]
                x, y = _units(flat[start[a][:, None] + at].astype(float)), _units(flat[start[b][:, None] + at].astype(float))
                near = (x * y).sum(1) >= threshold
            else:  # a batch with vectors of several lengths
                start = offsets - offsets[0]
                cos = [
                    float((_units(flat[None, start[p] : start[p] + size[p]].astype(float)) * _units(flat[None, start[q] : start[q] + size[q]].astype(float))).sum())
                    for p, q in zip(a.tolist(), b.tolist(), strict=True)
                ]
                near = np.array(cos, float) >= threshold
            a, b = a[near], b[near]
            links.add(node[a], node[b], count[a], count[b])


def near_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    threshold: float = THRESHOLD,
    radius: int = RADIUS,
    sample_rows: int = SAMPLE_ROWS,
    tile: int = TILE,
    agree: int | None = None,
) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row of ``vectors``. ``agree``: blocks in a
    table's key; by default they follow the number of distinct vectors."""
    spark = vectors.sparkSession
    v = F.col(vector_col).cast("array<double>")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    usable = F.col(label_col).isNotNull() & F.coalesce(F.forall(v, finite) & F.exists(v, lambda x: x != 0), F.lit(False))
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.when(usable, F.col(label_col)).alias("label"), F.when(usable, v).alias("vector"))
    live = rows.where("vector is not null")
    # copies of a vector are one node, named by a number of its own
    nodes = live.groupBy("label", "vector").agg(F.min("vec_id").alias("first"), F.count("*").alias("copies"))
    nodes = cut_lineage(nodes.withColumn("node", F.monotonically_increasing_id()))
    sample = nodes.orderBy(F.xxhash64("first"), "first", "label").limit(sample_rows).select("vector").toArrow()["vector"].to_pylist()
    if not sample:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    dim = max(set(map(len, sample)), key=lambda d: (sum(len(x) == d for x in sample), d))
    quantiser = learn_rotation(_units(np.array([x for x in sample if len(x) == dim])))
    bits = quantiser.axes.shape[1]
    tables = make_tables(bits, radius, agree or plan_tables(nodes.count(), bits, radius))
    model = spark.sparkContext.broadcast(quantiser)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = batch.column(1)
            flat, offsets = col.flatten().to_numpy(), col.offsets.to_numpy()
            offsets = offsets - offsets[0]
            size = np.diff(offsets)
            out = np.zeros(batch.num_rows, np.uint64)
            for d in np.unique(size).tolist():
                rows = np.flatnonzero(size == d)
                out[rows] = model.value.codes(_units(flat[offsets[rows][:, None] + np.arange(d)]))
            parts = (out[:, None] & tables.masks).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(out.view(np.int64)), pa.array(list(parts), pa.list_(pa.int64()))], names=["node", "code", "parts"]
            )

    codes = nodes.select("node", "vector").mapInArrow(code, "node long, code long, parts array<long>")
    coded = cut_lineage(nodes.join(codes, "node"))
    entries = coded.select("node", "copies", "code", "vector", "label", F.size("vector").alias("dim"), F.posexplode("parts").alias("tab", "part"))
    key = ["label", "dim", "tab", "part"]
    # buckets over a tile: each of their parts meets each other part, itself included, in a unit
    hot = entries.groupBy(*key).agg(F.ceil(F.count("*") / tile).cast("int").alias("cuts")).where("cuts > 1")
    slim = entries.select("node", *key).join(hot, key).select("node", "tab", "cuts")
    entries = entries.join(slim, ["node", "tab"], "left").withColumn("cuts", F.coalesce("cuts", F.lit(1)))
    entries = entries.withColumn("own", F.pmod(F.xxhash64("node"), F.col("cuts")).cast("int"))
    entries = entries.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
    side = F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1)
    place = [*key, F.least("own", "other"), F.greatest("own", "other")]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # a unit is named by 128 bits: two that share 64 of them are not compared with each other
    dealt = entries.select(F.xxhash64(*place).alias("unit"), F.xxhash64(F.lit("check"), *place).alias("check"), "tab", side.cast("int").alias("side"), "node", "copies", "code", "vector")
    dealt = dealt.repartition(n, "unit").sortWithinPartitions("unit", "check")
    links = cut_lineage(_bucket_links(dealt, tables, threshold))
    counts = links.groupBy("node").agg(F.sum("n").alias("n"))
    groups = components(links.select(F.col("node").alias("u"), F.col("to").alias("v"))).withColumnRenamed("component", "grp")
    per = nodes.join(counts, "node", "left").join(groups, "node", "left").withColumn("grp", F.coalesce("grp", "node"))
    names = per.groupBy("grp").agg(F.min("first").alias("component_id"))
    named = per.join(names, "grp").select("label", "vector", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    linked = live.join(named, ["label", "vector"]).select("vec_id", "n_links", "component_id")
    alone = rows.where("vector is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
