"""Byte-pair encoding and decoding with a pair occurrence index.

``encode_documents`` gives every whole text the token ids of a ``tokenizers`` file of kind "BPE
with word ends" (lower case, white space dropped) and ``decode_ids`` the text those ids stand
for. The vocabulary is read from a path and never trained.

Method. The words that a slice of a partition holds and the worker has not met yet are laid out
in one flat symbol list. An index maps every mergeable pair to all its positions. Ranks that
have positions are active; they are applied in ascending order from a heap, each to all its
positions at once, and the two neighbouring pairs of every merge join their own lists. No merge
can activate a smaller rank (checked when the file is read), so the result is that of merging
word by word.

Defined results: a null text is the empty text, an empty text has no ids and decodes to the
empty text, repeated rows are encoded each, null ids of documents pass through, an empty table
gives an empty table, and other columns of the input are ignored. A text of any length is
encoded whole; the memory of words is emptied when it reaches ``CACHE_WORDS`` entries, which
changes no result.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import filterfalse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from orderlens.llm.common import slices

CACHE_WORDS = 150_000
SCHEMA = "doc_id {id}, ids binary, decoded string"
SLICE_ROWS = 1024
_NOT_SPACE = re.compile(r"[\x1c-\x1f]")  # str.split() cuts there, the tokenizer does not
_SPACES = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_SPACE = re.compile(f"[{_SPACES}]+")


@lru_cache(maxsize=2)
def category_ranges(kind: str) -> str:
    """Body of a character class with the code points whose general category starts with ``kind``
    in this Python's Unicode tables (the regex package's tables are newer than the tokenizer's)."""
    out, start = [], None
    for c in range(0x110001):
        inside = c < 0x110000 and unicodedata.category(chr(c))[0] == kind
        if inside and start is None:
            start = c
        elif not inside and start is not None:
            out.append(f"\\U{start:08x}-\\U{c - 1:08x}")
            start = None
    return "".join(out)


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary: printable
    Latin-1 bytes stand for themselves, the others follow from code point 256 on."""
    keep = {*range(33, 127), *range(161, 173), *range(174, 256)}
    shifted = iter(range(256, 512))
    return [chr(b) if b in keep else chr(next(shifted)) for b in range(256)]


@lru_cache(maxsize=2)
def _library(spec: str) -> Tokenizer:
    """Loaded by the rare worker that meets a newer code point."""
    return Tokenizer.from_str(spec)


class PairIndexBpe:
    """Encoder and decoder over one vocabulary file's JSON text."""

    def __init__(self, spec: str):
        conf = json.loads(spec)
        model = conf["model"]
        vocab: dict[str, int] = model["vocab"]
        end = model["end_of_word_suffix"] or ""
        letters = byte_letters()
        self.first = np.array([vocab[c] for c in letters], np.int64)
        self.last = np.array([vocab[c + end] for c in letters], np.int64)
        self.base = max(vocab.values()) + 1
        self.rule: list[tuple[int, int, int]] = []
        made: dict[int, int] = {}
        for r, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.rule.append((vocab[a], vocab[b], vocab[a + b]))
            made[vocab[a + b]] = r
        if any(made.get(x, -1) > r for r, (a, b, _) in enumerate(self.rule) for x in (a, b)):
            raise ValueError("a merge uses a token that only a later merge makes; ranks can't be applied in order")
        keys = np.array([a * self.base + b for a, b, _ in self.rule], np.int64)
        self.by_key = np.argsort(keys)  # pair keys in order, for look-ups, and their ranks
        self.keys = keys[self.by_key]
        self.special = {t["content"]: t["id"] for t in conf["added_tokens"]}
        names = dict((i, t) for t, i in vocab.items()) | {i: t for t, i in self.special.items()}
        self.names = [names.get(i, "") for i in range(max(names) + 1)]
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        pattern = conf["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        inside = {r"[\p{L}]": f"[{category_ranges('L')}]", r"[\p{N}]": f"[{category_ranges('N')}]"}
        negated = r"[^\s\p{L}\p{N}]"
        for mark, body in {negated: f"[^{_SPACES}{category_ranges('L')}{category_ranges('N')}]", **inside}.items():
            pattern = pattern.replace(mark, body)
        self.split = re.compile(pattern)
        self.spec = spec
        self.words: dict[str, bytes] = {}
        self.chunks = self._special_chunks()

    def _special_chunks(self) -> dict[str, bytes]:
        return {t: np.array([i], "<u4").tobytes() for t, i in self.special.items()}

    # ------------------------------------------------------------------ text to chunks
    def _chunks(self, text: str) -> list[str]:
        """Pieces without white space, in order; special tokens are pieces of their own."""
        if self.cut is not None and "<|" in text:
            parts = self.cut.split(text)
            return [c for p in parts for c in ([p] if p in self.special else self._plain(p))]
        return self._plain(text)

    @staticmethod
    def _plain(text: str) -> list[str]:
        if _NOT_SPACE.search(text):
            return [c for c in _SPACE.split(text) if c]
        return text.split()

    def _pieces(self, chunk: str) -> list[str]:
        if not chunk.isascii():
            if any(unicodedata.category(c) == "Cn" for c in chunk):
                return self._newer_pieces(chunk)
            chunk = unicodedata.normalize("NFC", chunk).replace("\u03a3", "\u03c3")  # no final sigma
        chunk = chunk.lower()
        if chunk.isalpha():
            return [chunk]
        if chunk[-1] in ",." and chunk[:-1].isalpha():
            return [chunk[:-1], chunk[-1]]
        return self.split.findall(chunk)

    def _newer_pieces(self, chunk: str) -> list[str]:
        """Pieces of a chunk with code points that this Python's Unicode tables don't know yet: the
        library's own tables say what is a letter and how it is lower-cased."""
        library = _library(self.spec)
        text = library.normalizer.normalize_str(chunk)
        back = {c: b for b, c in enumerate(byte_letters())}
        return [bytes(back[c] for c in p).decode("utf-8") for p, _ in library.pre_tokenizer.pre_tokenize_str(text)]

    # ------------------------------------------------------------------ pair occurrence index
    def _merge(self, words: list[str]) -> None:
        """Encode unseen words together."""
        if not words:
            return
        raw = [w.encode("utf-8") for w in words]
        buf = np.frombuffer(b"".join(raw), np.uint8)
        ends = np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)))
        starts = np.r_[0, ends[:-1]]
        sym = self.first[buf]
        sym[ends - 1] = self.last[buf[ends - 1]]
        nxt, prv = np.arange(1, len(buf) + 1), np.arange(-1, len(buf) - 1)
        nxt[ends - 1] = -1
        prv[starts] = -1
        places: dict[int, list[np.ndarray]] = {}  # rank -> lists of positions of its pair's left symbol
        active: list[int] = []

        def index(at: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
            key = left * self.base + right
            found = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[found] == key
            at, rank = at[hit], self.by_key[found[hit]]
            if not len(rank):
                return
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            cuts = np.flatnonzero(rank[1:] != rank[:-1]) + 1
            for r, group in zip(rank[np.r_[0, cuts]].tolist(), np.split(at, cuts), strict=True):
                if r in places:
                    places[r].append(group)
                else:
                    places[r] = [group]
                    heapq.heappush(active, r)

        inner = np.flatnonzero(nxt >= 0)
        index(inner, sym[inner], sym[nxt[inner]])
        while active:
            r = heapq.heappop(active)
            left, right, new = self.rule[r]
            at = np.unique(np.concatenate(places.pop(r)))
            at = at[sym[at] == left]
            after = nxt[at]
            at, after = at[after >= 0], after[after >= 0]
            live = sym[after] == right
            at, after = at[live], after[live]
            if left == right and len(at):  # in a run of one symbol every second pair only
                taken, keep = -1, []
                for i, (p, q) in enumerate(zip(at.tolist(), after.tolist(), strict=True)):
                    if p != taken:
                        keep.append(i)
                        taken = q
                at, after = at[keep], after[keep]
            if not len(at):
                continue
            sym[at], sym[after] = new, -1
            then = nxt[after]
            nxt[at] = then
            has = then >= 0
            prv[then[has]] = at[has]
            before = prv[at]
            had = before >= 0
            index(
                np.concatenate([at[has], before[had]]),
                np.concatenate([sym[at[has]], sym[before[had]]]),
                np.concatenate([sym[then[has]], sym[at[had]]]),
            )
        kept = sym >= 0
        stop = np.cumsum(np.add.reduceat(kept, starts)) * 4
        ids = sym[kept].astype("<u4").tobytes()
        begin = np.r_[0, stop[:-1]].tolist()
        for w, s, e in zip(words, begin, stop.tolist(), strict=True):
            self.words[w] = ids[s:e]

    def learn(self, chunks: set[str]) -> None:
        """Make sure that every chunk's ids are known; ``chunks`` are unseen ones."""
        pieces = {c: self._pieces(c) for c in chunks}
        words = self.words
        self._merge(list({p for ps in pieces.values() for p in ps if p not in words}))
        for c, ps in pieces.items():
            self.chunks[c] = words[ps[0]] if len(ps) == 1 else b"".join(map(words.__getitem__, ps))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        if len(self.words) > CACHE_WORDS:
            self.words = {}
        if len(self.chunks) > CACHE_WORDS:
            self.chunks = self._special_chunks()
        parts = [self._chunks(t) if t else [] for t in texts]
        unseen: set[str] = set()
        for p in parts:
            unseen.update(filterfalse(self.chunks.__contains__, p))
        self.learn(unseen)
        known = self.chunks.__getitem__
        return [b"".join(map(known, p)) for p in parts]

    def decode(self, ids: bytes) -> str:
        """Token texts joined by a space, as a file without a decoder asks for."""
        return " ".join(map(self.names.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def codec(spec: str) -> PairIndexBpe:
    return PairIndexBpe(spec)


def read_spec(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode_documents(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (packed little-endian unsigned 32-bit), decoded for every row of ``docs``.

    The vocabulary (1.7 MB, fixed) travels as a broadcast value, so that only the driver needs the file.
    """
    spark = docs.sparkSession
    spec = spark.sparkContext.broadcast(read_spec(vocab_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(spec.value)
        for part in slices(batches, rows=SLICE_ROWS):
            ids = bpe.encode(part.column(1).to_pylist())
            decoded = [bpe.decode(x) for x in ids]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(ids, pa.binary()), pa.array(decoded, pa.string())],
                names=["doc_id", "ids", "decoded"],
            )

    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(run, SCHEMA.format(id=slim.schema["doc_id"].dataType.simpleString()))


def digests(encoded: DataFrame) -> DataFrame:
    """Token count and the SHA-256 of ids and decoded text of ``encode_documents`` rows."""
    return encoded.select(
        "doc_id",
        F.expr("cast(length(ids) div 4 as bigint)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )
