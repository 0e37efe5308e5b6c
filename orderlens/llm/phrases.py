"""Phrase collocations: level-wise candidates counted by broadcast double-array tries.

Level k counts phrases of k words. A phrase is a candidate only if it was seen as an extension of a
candidate of k-1 words and all its sightings together reach ``min_count``; a phrase is never more
frequent than its parts, so none is lost (Apriori). The candidates are cut into blocks of bounded
bytes, each block becomes a double-array trie over the phrases' bytes, and every trie is
broadcast in turn. A task lays the words of a slice of documents one after another (one byte
between them tells a space from the end of a piece) and numpy moves the states of all word
positions through the trie together, one byte at a time; positions without a transition leave. The
accepting states are counted with ``bincount``, and the counts of all slices (the shards) are
summed by Spark. The same pass reports, for the positions that were accepted, the word that
follows: the candidates of the next level.

Words are summed by Spark for level 1. Counts, cuts, dropping and ranking are DataFrame
operations on the counted candidates; scores use decimals of 38 digits and whole-number
division, so they are exact as long as counts stay under 10^15.

Scale. Text is never shuffled; a pass sends only distinct (candidate, next word) rows of a slice.
A broadcast holds at most ``block_bytes`` of phrases (default 6 MB, about 100 MB as arrays at
worst); more candidates mean more blocks and one pass for each, over the texts of the block's languages. A
language that needs several is cut by first words, which are looked up once for each slice, so a pass walks
only places of its own. Where a block has all phrases of a language, a word behind a phrase counts only if the
phrase from the next word on is a candidate too. A frequent word or
pair is summed in its slice and again in its task before any shuffle. The ranking first keeps
the best of each of ``RANK_PARTS`` parts of a language, so no task holds a language.

Defined results: a null text is empty; a null language is ``und``; empty texts and empty tables
give no rows; repeated rows count each time; other columns are ignored. A task's memory follows
its longest text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.llm.common import slices, written

MIN_COUNT = 10
MAX_WORDS = 3
COVERED = 50  # per cent of a phrase's count that lies inside one longer candidate
TOP = 2000
BLOCK_BYTES = 6 << 20
RANK_PARTS = 32
SLICE_ROWS = 1024
MAX_LANGS = 1000  # that blocks are kept apart by
NO_LANG = "und"

SPACE, BREAK = 32, 10
#: A-Z to lower case, the piece delimiters to line feeds, tabs to spaces.
_BYTES = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0b\x0c\x0d\t", b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 9 + b" "
)
LANG_END = b"\xff"  # in no UTF-8 text


# ------------------------------------------------------------------ words of a slice
@dataclass
class Words:
    """The words of some texts, each followed by a space or, at the end of its piece, by a break."""

    data: np.ndarray  # uint8
    starts: np.ndarray  # first byte of each word

    @property
    def ends(self) -> np.ndarray:
        return np.append(self.starts[1:], len(self.data)) - 1

    def __len__(self) -> int:
        return len(self.starts)

    @cached_property
    def coded(self) -> tuple[np.ndarray, pa.Array]:
        """Each word's number in the slice's own word list, and the list (a space behind each word)."""
        flat = self.data.copy()
        flat[self.ends] = SPACE
        offsets = pa.py_buffer(np.append(self.starts, len(flat)).astype(np.int64))
        cells = pa.Array.from_buffers(pa.large_binary(), len(self), [None, offsets, pa.py_buffer(flat)])
        coded = cells.dictionary_encode()
        return coded.indices.to_numpy(), coded.dictionary

    @property
    def names(self) -> pa.Array:
        return pc.binary_slice(self.coded[1], 0, -1).cast(pa.large_string())


def lay_out(texts: list[bytes | None]) -> Words:
    raw = np.frombuffer((b"\n".join(t or b"" for t in texts) + b"\n").translate(_BYTES), np.uint8)
    word = (raw != BREAK) & (raw != SPACE)
    behind = np.flatnonzero(word[:-1] & ~word[1:]) + 1  # the byte behind each word
    first = np.flatnonzero(word & ~np.append(False, word[:-1]))
    breaks = np.cumsum(raw == BREAK, dtype=np.int32)
    following = np.append(first[1:], len(raw) - 1)
    split = breaks[following] - breaks[behind - 1] > 0  # a break before the next word
    if len(split):
        split[-1] = True
    data = raw.copy()
    data[behind] = np.where(split, BREAK, SPACE)
    word[behind] = True
    data = data[word]
    starts = np.append(0, np.flatnonzero((data == BREAK) | (data == SPACE))[:-1] + 1) if len(data) else np.zeros(0, np.int64)
    return Words(data, starts)


def _by_lang(batch: pa.RecordBatch) -> Iterator[tuple[str, Words]]:
    """The words of a slice's texts, language by language."""
    groups: dict[str, list] = {}
    for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary()).to_pylist(), strict=True):
        groups.setdefault(lang, []).append(text)
    for lang, texts in groups.items():
        if len(words := lay_out(texts)):
            yield lang, words


# ------------------------------------------------------------------ double-array trie
@dataclass
class Trie:
    """Slots of a double array: a state s moves by byte b to base[s] + b if check there is s."""

    base: np.ndarray
    check: np.ndarray
    key: np.ndarray  # number of the phrase that ends in a state, or -1

    @classmethod
    def build(cls, keys: list[bytes], seed: int = 3) -> Trie:
        """From distinct keys in ascending byte order."""
        parent, label, ends = _nodes(keys)
        n = len(parent)
        fan = np.bincount(parent[1:], minlength=n)
        order = np.argsort(parent[1:], kind="stable") + 1  # children, parent by parent
        begin = np.append(0, np.cumsum(fan))
        base = np.zeros(n, np.int64)
        # wide nodes get a span of their own; the others are put where all their children find free slots
        wide = np.flatnonzero(fan > 16)
        base[wide] = 1 + 256 * np.arange(len(wide))
        size = max(256 * len(wide), 9 * n // 5) + 1024
        taken = np.zeros(size, bool)
        taken[0] = True  # the root's slot
        rows = order[np.isin(parent[order], wide)]
        taken[base[parent[rows]] + label[rows]] = True
        owner = np.full(size, -1, np.int64)
        rng = np.random.default_rng(seed)
        for width in range(16, 0, -1):
            todo = np.flatnonzero(fan == width)
            while len(todo):
                kids = order[begin[todo][:, None] + np.arange(width)]
                base[todo] = rng.integers(1, size - 256, len(todo))
                slot = base[todo][:, None] + label[kids]
                owner[slot] = todo[:, None]  # of several claims on a slot the last one stands
                good = ((owner[slot] == todo[:, None]) & ~taken[slot]).all(1)
                taken[slot[good]] = True
                todo = todo[~good]
        slot = np.zeros(n, np.int64)
        slot[1:] = base[parent[1:]] + label[1:]
        out = cls(np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32))
        out.base[slot] = base
        out.check[slot[1:]] = slot[parent[1:]]
        out.key[slot[ends]] = np.arange(len(keys))
        return out

    def walk(self, prefix: bytes) -> int:
        """The state behind a prefix, or -1."""
        state = 0
        for b in prefix:
            to = int(self.base[state]) + b
            if self.check[to] != state:
                return -1
            state = to
        return state

    def accepted(self, words: Words, root: int) -> np.ndarray:
        """For each word position the phrase of the trie that begins there and ends with a word, or -1.
        No phrase of a trie goes on with a space into another."""
        if root < 0 or not len(words):
            return np.full(len(words), -1, np.int32)
        code, listed = words.coded
        # the first word once for all its places: its state, and the one behind the space that follows
        offsets, data = (np.frombuffer(b, kind) for b, kind in zip(listed.buffers()[1:], (np.int64, np.uint8), strict=True))
        offsets = offsets[listed.offset : listed.offset + len(listed) + 1]
        who, at, end = np.arange(len(listed)), offsets[:-1].copy(), offsets[1:] - 1
        state, behind = np.full(len(listed), root, np.int32), np.full(len(listed), -1, np.int32)
        while len(who):
            done = at == end[who]
            behind[who[done]] = state[done]
            who, at, state = who[~done], at[~done], state[~done]
            to = self.base[state] + data[at]
            on = self.check[to] == state
            who, at, state = who[on], at[on] + 1, to[on]
        known = np.flatnonzero(behind >= 0)
        one, further = np.full(len(listed), -1, np.int32), np.full(len(listed), -1, np.int32)
        one[known] = self.key[behind[known]]
        to = self.base[behind[known]] + SPACE
        on = self.check[to] == behind[known]
        further[known[on]] = to[on]
        out = one[code]
        if not on.any():
            return out
        # then the places where it goes on
        data, state = words.data, further[code]
        gap = (data == SPACE) | (data == BREAK)
        who = np.flatnonzero((state >= 0) & (data[words.ends] == SPACE)).astype(np.int32)
        state, at = state[who], words.starts[who + 1].astype(np.int32)
        while len(who):
            to = self.base[state] + data[at]
            on = self.check[to] == state
            state, who, at = to[on], who[on], at[on] + 1
            stop = np.flatnonzero(gap[at])
            key = self.key[state[stop]]
            out[who[stop[key >= 0]]] = key[key >= 0]
        return out


def _nodes(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The trie of sorted keys, level by level: each node's parent and byte, and each key's node."""
    size = np.array([len(k) for k in keys], np.int64)
    data = np.frombuffer(b"".join(keys), np.uint8)
    begin = np.cumsum(size) - size
    parents, labels, total = [np.array([-1])], [np.array([0])], 1
    ends = np.zeros(len(keys), np.int64)
    rows, node, depth = np.arange(len(keys)), np.zeros(len(keys), np.int64), 0
    while True:
        done = size[rows] == depth
        ends[rows[done]] = node[done]
        rows, node = rows[~done], node[~done]
        if not len(rows):
            break
        byte = data[begin[rows] + depth]
        new = np.append(True, (node[1:] != node[:-1]) | (byte[1:] != byte[:-1]))
        parents.append(node[new])
        labels.append(byte[new].astype(np.int64))
        node = total + np.cumsum(new) - 1
        total += int(new.sum())
        depth += 1
    return np.concatenate(parents), np.concatenate(labels), ends


# ------------------------------------------------------------------ passes over the text
def _texts(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANG)).alias("lang"), F.col(text_col).alias("text")).where("text <> ''")


def word_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, phrase, n): every word of every language with its number of occurrences."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, rows=SLICE_ROWS):
            for lang, words in _by_lang(batch):
                names = words.names
                n = np.bincount(words.coded[0], minlength=len(names))
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n)), names.cast(pa.string()), pa.array(n)], names=["lang", "phrase", "n"])

    return _texts(docs, text_col, lang_col).mapInArrow(count, "lang string, phrase string, n long").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def _packed(sizes: dict[str, int], block_bytes: int) -> list[list[str]]:
    """The languages in groups: a large one alone, small ones together up to ``block_bytes``."""
    groups: list[list[str]] = []
    room: list[int] = []
    for lang in sorted(sizes, key=lambda x: (-sizes[x], x)):
        at = next((k for k, left in enumerate(room) if sizes[lang] <= left), None)
        if at is None:
            groups.append([lang])
            room.append(block_bytes - sizes[lang])
        else:
            groups[at].append(lang)
            room[at] -= sizes[lang]
    return groups


def _blocks(candidates: DataFrame, block_bytes: int) -> tuple[DataFrame, list[list[str] | None]]:
    """Candidates with a block number, no block over ``block_bytes`` (unless by a single phrase), and the
    languages of each block (None: any). A block holds whole languages, or the phrases of one language that
    begin with the same words, so that its pass reads the texts of these languages only and most places
    leave it at once; the phrases of a first word that fills a quarter of a block go to several."""
    spark, size = candidates.sparkSession, F.octet_length("phrase") + F.octet_length("lang") + 1
    sizes = {r["lang"]: r["size"] for r in candidates.groupBy("lang").agg(F.sum(size).alias("size")).limit(MAX_LANGS + 1).collect()}
    if not sizes:
        return candidates.withColumn("block", F.lit(0)), []
    first = F.substring_index("phrase", " ", 1)
    if len(sizes) > MAX_LANGS:
        groups, total = [None], candidates.agg(F.sum(size)).first()[0]
    else:
        groups = _packed(sizes, block_bytes)
    n = [-(-(total if g is None else sum(sizes[x] for x in g)) // block_bytes) for g in groups]
    spread = first
    if max(n) > 1:
        heavy = candidates.groupBy("lang", first.alias("first")).agg(F.sum(size).alias("heavy")).where(F.col("heavy") > block_bytes // 4)
        candidates = written(candidates.join(heavy.withColumnRenamed("lang", "l"), (F.col("lang") == F.col("l")) & (first == F.col("first")), "left").drop("l", "first"), "candidates")
        spread = F.when(F.col("heavy").isNull(), first).otherwise(F.col("phrase"))
    while True:
        begin = np.append(0, np.cumsum(n)).tolist()
        table = [(x, begin[k], n[k]) for k, g in enumerate(groups) for x in g or ()]
        if table:
            placed = candidates.join(F.broadcast(spark.createDataFrame(table, "lang string, begin int, of int")), "lang")
        else:
            placed = candidates.withColumn("begin", F.lit(0)).withColumn("of", F.lit(n[0]))
        block = (F.col("begin") + F.pmod(F.xxhash64("lang", spread), F.col("of"))).cast("int")
        placed = placed.withColumn("block", block)
        if max(n) == 1:
            break
        per = placed.groupBy("block").agg(F.sum(size).alias("size"), F.count("*").alias("k"))
        over = {int(np.searchsorted(begin, r["block"], side="right")) - 1 for r in per.where((F.col("size") > block_bytes) & (F.col("k") > 1)).collect()}
        if not over:
            break
        n = [x + max(1, x // 4) if k in over else x for k, x in enumerate(n)]
    return placed.drop("heavy", "begin", "of"), [g for k, g in enumerate(groups) for _ in range(n[k])]


def _pass(texts: DataFrame, trie, ids, level: int, extend: bool, whole: bool) -> DataFrame:
    """(id, next, n): how often each phrase of a trie occurs (next is null) and, if ``extend``, how
    often each word follows it within a piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases, number = trie.value, ids.value
        total = np.zeros(len(number), np.int64)
        for batch in slices(batches, rows=SLICE_ROWS):
            for lang, words in _by_lang(batch):
                found = phrases.accepted(words, phrases.walk(lang.encode() + LANG_END))
                total += np.bincount(found[found >= 0], minlength=len(total))
                if extend:
                    yield _extensions(words, found, number, level, whole)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(number[seen]), pa.nulls(len(seen), pa.string()), pa.array(total[seen])], names=["id", "next", "n"]
        )

    return texts.mapInArrow(run, "id long, next string, n long")


def _extensions(words: Words, found: np.ndarray, number: np.ndarray, level: int, whole: bool) -> pa.RecordBatch:
    """The words behind the phrases (of ``level`` words) that were found, counted. If the trie is ``whole`` (has all
    phrases of the language), only where the phrase from the next word on was found too: a longer phrase is never
    more frequent than that one (Apriori)."""
    begins = np.flatnonzero(found >= 0)
    last = begins + level - 1
    begins = begins[words.data[words.ends][last] != BREAK]
    if whole:
        begins = begins[found[begins + 1] >= 0]
    code, names = words.coded[0], words.names
    key, n = np.unique(found[begins].astype(np.int64) << 32 | code[begins + level], return_counts=True)
    following = names.cast(pa.string()).take(pa.array(key & 0xFFFFFFFF))
    return pa.RecordBatch.from_arrays([pa.array(number[key >> 32]), following, pa.array(n)], names=["id", "next", "n"])


def count_candidates(
    texts: DataFrame, candidates: DataFrame, level: int, min_count: int = MIN_COUNT, block_bytes: int = BLOCK_BYTES, extend: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Counts (lang, phrase, n) of the candidates (lang, phrase) of ``level`` words in texts (lang,
    text), and the candidates of the next level (none unless ``extend``)."""
    sc = texts.sparkSession.sparkContext
    numbered = candidates.select("lang", "phrase").withColumn("id", F.monotonically_increasing_id())
    blocked, langs = _blocks(written(numbered, "candidates"), block_bytes)
    if len(langs) > 1:
        blocked = written(blocked, "candidates")
    found = texts.sparkSession.createDataFrame([], "id long, next string, n long")
    for b, only in enumerate(langs):
        tab = blocked.where(F.col("block") == b).select("id", "lang", "phrase").toArrow()
        keys = [x.encode() + LANG_END + p.encode() for x, p in zip(tab["lang"].to_pylist(), tab["phrase"].to_pylist(), strict=True)]
        order = sorted(range(len(keys)), key=keys.__getitem__)
        trie = sc.broadcast(Trie.build([keys[i] for i in order]))
        ids = sc.broadcast(tab["id"].to_numpy()[order])
        own = texts if only is None or len(langs) == 1 else texts.where(F.col("lang").isin(only))
        whole = only is not None and langs.count(only) == 1
        summed = _pass(own, trie, ids, level, extend, whole).groupBy("id", "next").agg(F.sum("n").alias("n"))
        found = found.unionByName(written(summed.where((F.col("n") >= min_count) | F.col("next").isNull()), "phrases"))
        trie.destroy()
        ids.destroy()
    named = found.join(blocked.select("id", "lang", "phrase"), "id")
    counts = named.where("next is null").select("lang", "phrase", "n")
    longer = named.where("next is not null").select("lang", F.concat_ws(" ", "phrase", "next").alias("phrase"))
    return counts, longer


# ------------------------------------------------------------------ scores
def _whole(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(15,0)")


def _parts(counts: DataFrame) -> DataFrame:
    """The phrases with their words."""
    return counts.withColumn("words", F.split("phrase", " "))


def cut_scores(counts: DataFrame, scale: int = 1_000_000) -> DataFrame:
    """(lang, phrase, a, l, r, score) of each phrase of two words or more, at its lowest-scoring cut;
    ``counts`` (lang, phrase, n) holds all parts of its phrases."""
    phrase = _parts(counts).where(F.size("words") > 1).withColumnRenamed("n", "a")
    part = lambda a, b: F.array_join(F.slice("words", a, b), " ")
    cuts = phrase.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("words") - 1)))
    cuts = cuts.select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("left"), part(F.col("k") + 1, F.size("words")).alias("right"))
    lefts = counts.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l"))
    rights = counts.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r"))
    cuts = cuts.join(lefts, ["lang", "left"]).join(rights, ["lang", "right"])
    score = F.call_function("div", F.lit(scale).cast("decimal(8,0)") * _whole("a") * _whole("a"), _whole("l") * _whole("r"))
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    return cuts.groupBy("lang", "phrase", "a").agg(lowest).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def covered(counts: DataFrame, percent: int = COVERED) -> DataFrame:
    """(lang, phrase) of the phrases that lie inside a longer one with ``percent`` of their count."""
    longer = _parts(counts).where(F.size("words") > 2)
    inner = F.expr(
        "flatten(transform(sequence(2, size(words) - 1), m -> transform(sequence(1, size(words) - m + 1), s -> array_join(slice(words, s, m), ' '))))"
    )
    inside = longer.select("lang", F.col("n").alias("outer"), F.explode(inner).alias("phrase")).groupBy("lang", "phrase").agg(F.max("outer").alias("outer"))
    return inside.join(counts, ["lang", "phrase"]).where(F.col("outer") * 100 >= F.col("n") * percent).select("lang", "phrase")


def _top(scored: DataFrame, top: int) -> DataFrame:
    """The first ``top`` of every language with their rank, by score, count and phrase."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
    best = scored.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
    best = best.where(F.col("rank") <= top).drop("part", "rank")
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.where(F.col("rank") <= top)


def collocations(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    min_count: int = MIN_COUNT,
    max_words: int = MAX_WORDS,
    percent: int = COVERED,
    top: int = TOP,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best phrases of each language."""
    texts = _texts(docs, text_col, lang_col)
    words = written(word_counts(docs, text_col, lang_col), "words")
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    candidates, levels = words.where(F.col("n") >= min_count), []
    for level in range(1, max_words + 1):
        counts, candidates = count_candidates(texts, candidates, level, min_count, block_bytes, extend=level < max_words)
        levels.append(counts.where(F.col("n") >= min_count))
    counts = levels[0]
    for more in levels[1:]:
        counts = counts.unionByName(more)
    counts = written(counts, "phrases")
    scored = cut_scores(counts).join(covered(counts, percent), ["lang", "phrase"], "left_anti")
    out = _top(scored, top).join(totals, "lang")
    return out.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
