"""SimHash near duplicates by tiled exact comparison.

Fingerprints. A-Z are lower-cased; words are runs of bytes other than space, tab, line feed,
vertical tab, form feed and carriage return; shingles are three words joined by a space, repeats
included (fewer words: the whole sequence). A fingerprint bit is 1 if over half the shingles'
XXH64 values (seed 42) have it; a text without words has fingerprint zero and is linked like any
other.

Comparison. Copies of one fingerprint are one node. Nodes are dealt into tiles by the population
counts of the fingerprint's two halves; a hot pair of counts is split into several tiles of
about ``tile_rows`` nodes. A fingerprint within ``radius`` bits has counts whose differences add
up to at most ``radius``, so all other pairs of tiles are skipped and none is lost. Inside a
pair of tiles every value is compared with every other by numpy exclusive-or and bit counts. One
tile (at most a few ``tile_rows`` values) is held; the others stream past it. The links found
are contracted to a star forest in the task, so a group of n near copies gives about n rows.

Defined results: a null text counts as empty; repeated rows and rows that share a doc_id each
get their row; ids may be null and are then never a component's id unless the whole component
has none (component_id is then null); an empty table gives an empty table; other columns are
ignored by ``near_duplicates`` and kept as they are by ``drop_near_duplicates``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import WORD_BYTES, fresh, lower_ascii, slices, text_hash
from orderlens.llm.components import components, contract
from orderlens.session import cut_lineage

SEED = 42
HALF = 32
BLOCK = 1 << 17  # comparisons done by one numpy call
PENDING = 1 << 18  # links held before they are contracted


def shingle_hashes(data: bytes, length: int) -> np.ndarray:
    """XXH64 of every shingle of ``length`` words, repeats included."""
    words = WORD_BYTES.findall(data)
    if not words:
        return np.zeros(0, np.uint64)
    line = b" ".join(words)
    if len(words) <= length:
        return np.array([xxhash.xxh64_intdigest(line, SEED)], np.uint64)
    stop = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    start = np.r_[0, stop[:-1]]
    spans = zip(start[: len(words) - length + 1].tolist(), (stop[length - 1 :] - 1).tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(line[s:e], SEED) for s, e in spans), np.uint64, len(words) - length + 1)


def fingerprint(hashes: np.ndarray) -> int:
    """64-bit majority vote, as an unsigned number."""
    if not len(hashes):
        return 0
    votes = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 14):
        votes += np.unpackbits(hashes[i : i + (1 << 14)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, np.int64)
    return int.from_bytes(np.packbits(votes * 2 > len(hashes)).tobytes(), "big")


def add_fingerprints(docs: DataFrame, length: int) -> DataFrame:
    """``docs`` (its second column is the text, dropped) with long column fp."""
    cols = docs.columns
    out = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in [cols[0], *cols[2:]]) + "fp long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            fps = [fingerprint(shingle_hashes(lower_ascii(t), length)) for t in part.column(1).to_pylist()]
            values = pa.array(np.array(fps, np.uint64).view(np.int64))
            rest = [part.column(i) for i in range(part.num_columns) if i != 1]
            yield pa.RecordBatch.from_arrays([*rest, values], names=[cols[0], *cols[2:], "fp"])

    return docs.mapInArrow(run, out)


class _Tile:
    """One tile held in memory, compared with itself and with what streams past."""

    def __init__(self, radius: int):
        self.radius, self.key, self.held, self.links, self.n = radius, None, [], [], 0
        self.values: np.ndarray | None = None

    def start(self, key) -> None:
        self.key, self.held, self.values = key, [], None

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        if len(a):
            self.links.append((a, b))
            self.n += len(a)
            if self.n > PENDING:
                pair = contract(*map(np.concatenate, zip(*self.links, strict=True)))
                self.links, self.n = [pair], len(pair[0])

    def compare(self, other: np.ndarray, own: bool = False) -> None:
        """Link ``other`` to the tile; own: they are the tile itself, each pair counts once."""
        base = self.values
        rows = max(1, BLOCK // max(1, len(base)))
        for i in range(0, len(other), rows):
            part = other[i : i + rows]
            r, c = np.nonzero(np.bitwise_count(part[:, None] ^ base[None, :]) <= self.radius)
            if own:
                r, c = r[c > r + i], c[c > r + i]
            self.add(part[r].view(np.int64), base[c].view(np.int64))

    def complete(self) -> None:
        """All of the tile has come in: compare it with itself, once."""
        if self.key is not None and self.values is None:
            self.values = np.concatenate(self.held) if self.held else np.zeros(0, np.uint64)
            self.held = []
            self.compare(self.values, own=True)

    def flush(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.links:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        pair = contract(*map(np.concatenate, zip(*self.links, strict=True)))
        self.links, self.n = [], 0
        return pair


def tile_links(fps: DataFrame, radius: int, tile_rows: int) -> DataFrame:
    """Links (u, v) that join all distinct long values ``fp`` at ``radius`` bits or fewer."""
    spark = fps.sparkSession
    high, low = F.bit_count(F.shiftrightunsigned("fp", HALF)), F.bit_count(F.col("fp").bitwiseAND(F.lit((1 << HALF) - 1)))
    nodes = fps.select("fp", high.cast("int").alias("p"), low.cast("int").alias("q"))
    # at most 33 x 33 rows, whatever the input: safe to broadcast
    sizes = nodes.groupBy("p", "q").agg(F.ceil(F.count("*") / tile_rows).cast("int").alias("tiles"))
    own = F.broadcast(sizes)
    near = F.broadcast(sizes.select(F.col("p").alias("np"), F.col("q").alias("nq"), F.col("tiles").alias("ntiles")))
    steps = [(a, b) for a in range(-radius, radius + 1) for b in range(-radius, radius + 1) if abs(a) + abs(b) <= radius]
    around = F.array(*[F.struct((F.col("p") + a).alias("np"), (F.col("q") + b).alias("nq")) for a, b in steps if (a, b) >= (0, 0)])
    dealt = (
        nodes.join(own, ["p", "q"])
        .withColumn("t", F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int"))
        .select("fp", "p", "q", "t", F.inline(around))
        .join(near, ["np", "nq"])
        .select("fp", "p", "q", "t", "np", "nq", F.explode(F.sequence(F.lit(0), F.col("ntiles") - 1)).alias("nt"))
        .where("np > p or nq > q or nt >= t")
        .where("not (np = p and nq = q and nt < t)")
        .select(
            F.struct("np", "nq", "nt").alias("tile"),
            ((F.col("np") != F.col("p")) | (F.col("nq") != F.col("q")) | (F.col("nt") != F.col("t"))).cast("int").alias("passing"),
            "fp",
        )
    )
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.select(F.expr("(tile.np * 64 + tile.nq) * bigint(67108864) + tile.nt").alias("tile"), "passing", "fp")
    dealt = dealt.repartition(n, "tile").sortWithinPartitions("tile", "passing")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile = _Tile(radius)
        for batch in batches:
            keys, passing = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            values = batch.column(2).to_numpy().view(np.uint64)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]) | (passing[1:] != passing[:-1])) + 1
            for s, e in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)], strict=True):
                if s == e:
                    continue
                if keys[s] != tile.key:
                    tile.complete()
                    tile.start(keys[s])
                if passing[s]:
                    tile.complete()
                    tile.compare(values[s:e])
                else:
                    tile.held.append(values[s:e])
        tile.complete()
        u, v = tile.flush()
        yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    return dealt.mapInArrow(run, "u long, v long")


def _grouped(prints: DataFrame, radius: int, tile_rows: int) -> DataFrame:
    """(fp, group): the group's smallest fingerprint; fingerprints without a link are left out."""
    return components(tile_links(prints.select("fp").distinct(), radius, tile_rows)).select(
        F.col("node").alias("fp"), F.col("component").alias("grp")
    )


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 3, radius: int = 3, tile_rows: int = 16384
) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: the smallest doc_id reachable by links."""
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    prints = cut_lineage(add_fingerprints(slim, length))
    groups = _grouped(prints, radius, tile_rows)
    # one row for each fingerprint, then for each group: copies meet in map-side partial steps
    per_fp = prints.groupBy("fp").agg(F.min("doc_id").alias("first")).join(groups, "fp", "left")
    per_fp = per_fp.withColumn("grp", F.coalesce("grp", "fp"))
    named = per_fp.groupBy("grp").agg(F.min("first").alias("component_id"))
    named = per_fp.select("fp", "grp").join(named, "grp").select("fp", "component_id")
    return prints.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 3, radius: int = 3, tile_rows: int = 16384
) -> DataFrame:
    """The rows of ``docs``, columns unchanged, of which one of each group stays: the smallest id
    (null last; among rows that share it the smallest text hash, then one of the equal rows)."""
    th = fresh(docs.columns, "_text_hash")
    keyed = docs.withColumn(th, text_hash(text_col))
    slim = keyed.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(th).alias("th"))
    prints = cut_lineage(add_fingerprints(slim, length))
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "th")
    per_fp = prints.groupBy("fp").agg(F.min(order).alias("first")).join(_grouped(prints, radius, tile_rows), "fp", "left")
    stay = per_fp.groupBy(F.coalesce("grp", "fp").alias("grp")).agg(F.min("first").alias("k")).select("k.doc_id", "k.th")
    kept = keyed.join(stay, keyed[id_col].eqNullSafe(stay["doc_id"]) & (keyed[th] == stay["th"]), "left_semi")
    return kept.dropDuplicates([id_col, th]).drop(th)
