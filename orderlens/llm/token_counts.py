"""Token counts through an exact length histogram.

Every whole text is encoded with a public vocabulary and only its length is kept. The histogram
counts the documents of each length (a map-side partial step leaves one row a task and length).
``context_table`` adds suffix sums, which answer for every context limit at once how many
documents and tokens are longer, what the total is when texts are truncated there, and which
quantile of documents it covers; a limit between two lengths of the table follows from the lower
one (truncated total plus limit difference times longer documents). ``totals_at`` and
``quantiles`` read single answers.

The sums run in two steps, inside stretches of ``STRETCH`` lengths and over the stretches, so no
task holds the whole histogram; the stretches are as many as the longest text has thousands of
tokens.

Defined results: null and empty texts have length 0; repeated rows count each; ids are not
looked at by the histogram; an empty table gives an empty table, null totals and null quantiles;
other columns are ignored.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlens.llm.common import slices
from orderlens.session import cut_lineage

STRETCH = 1024
#: Beyond this many white-space characters in a row the library's own splitter runs out of stack.
_LONG_SPACE = re.compile(r"\s{2048}")


@lru_cache(maxsize=2)
def encoding(ranks: str, pattern: str) -> tiktoken.Encoding:
    pairs = (line.split() for line in ranks.splitlines())
    return tiktoken.Encoding("given", pat_str=pattern, mergeable_ranks={base64.b64decode(a): int(b) for a, b in pairs}, special_tokens={})


def count_tokens(enc: tiktoken.Encoding, pattern: str, text: str | None) -> int:
    if not text:
        return 0
    if _LONG_SPACE.search(text):
        return sum(len(enc._encode_single_piece(p)) for p in regex.findall(pattern, text))
    return len(enc.encode_ordinary(text))


def token_lengths(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and n_tokens of every row. The vocabulary (1 MB, fixed) is broadcast."""
    with open(ranks_path, encoding="ascii") as f:
        ranks = docs.sparkSession.sparkContext.broadcast(f.read())
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(ranks.value, pattern)
        for part in slices(batches):
            lengths = [count_tokens(enc, pattern, t) for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.array(lengths, np.int64))], names=["doc_id", "n_tokens"])

    return slim.mapInArrow(run, f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, n_tokens long")


def histogram(lengths: DataFrame) -> DataFrame:
    """n_tokens, n_docs."""
    return lengths.groupBy("n_tokens").agg(F.count("*").alias("n_docs"))


def context_table(hist: DataFrame) -> DataFrame:
    """``hist`` is computed once (checkpointed): its rows serve both steps. For every length that occurs, taken as a context limit: documents of that length, documents
    and tokens of longer ones, total with texts cut there, and the share of documents that fit."""
    cells = cut_lineage(hist).withColumns({"stretch": F.expr(f"n_tokens div {STRETCH}"), "tokens": F.col("n_tokens") * F.col("n_docs")})
    inside = Window.partitionBy("stretch").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, -1)
    stretches = cells.groupBy("stretch").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    after = Window.orderBy(F.desc("stretch")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(F.desc("stretch")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    none = F.lit(0).cast("long")
    above = stretches.select(
        "stretch",
        F.coalesce(F.sum("d").over(after), none).alias("d_after"),
        F.coalesce(F.sum("t").over(after), none).alias("t_after"),
        F.sum("d").over(whole).alias("d_all"),
        F.sum("t").over(whole).alias("t_all"),
    )
    longer = cells.withColumns({"d_in": F.coalesce(F.sum("n_docs").over(inside), none), "t_in": F.coalesce(F.sum("tokens").over(inside), none)})
    docs_longer, tokens_longer = F.col("d_in") + F.col("d_after"), F.col("t_in") + F.col("t_after")
    return longer.join(above, "stretch").select(
        "n_tokens",
        "n_docs",
        docs_longer.alias("docs_longer"),
        tokens_longer.alias("tokens_longer"),
        (F.col("t_all") - tokens_longer + F.col("n_tokens") * docs_longer).alias("truncated_total"),
        ((F.col("d_all") - docs_longer) / F.col("d_all")).alias("share_fitting"),
    )


def totals_at(hist: DataFrame, limits: list[int]) -> DataFrame:
    """One row: total tokens, and the total with texts cut at each of ``limits``."""
    cut = [F.sum(F.least(F.col("n_tokens"), F.lit(c).cast("long")) * F.col("n_docs")).alias(f"total_{c}") for c in limits]
    return hist.agg(F.sum(F.col("n_tokens") * F.col("n_docs")).alias("total"), *cut)


def quantiles(table: DataFrame, shares: list[float]) -> DataFrame:
    """One row: the smallest length that at least each share of documents fits in."""
    return table.agg(*[F.min(F.when(F.col("share_fitting") >= q, F.col("n_tokens"))).alias(f"q{round(q * 100)}") for q in shares])
