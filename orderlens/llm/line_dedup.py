"""Line dedup by winnowing over line hashes. DataFrame functions only.

A document is its sequence of lines (split at line feeds). Blank lines carry no words and are
not compared. The window of a line is the shortest run of lines from it that holds at least
``min_words`` words (default 50); near the end of a document there is none. Of each window the
smallest line hash (the last of equal ones) is selected as its fingerprint. Equal windows select
equal fingerprints, so two passages that share a window are sure to share a fingerprint.

Fingerprints that occur at one place only are dropped first; the others' windows are extended: a
longer run from the same line is matched too, to each end at which the words after its first line
are still under ``min_words`` (what reaches further holds the next line's own window), and from a
line that is a window by itself to a neighbour that is one too (for the blank lines between them).
Windows and extended runs are joined on fingerprint and content, and each content's first place
stays. A run that occurred before, in id order or further up in its document, is a repeat. Every
longer match is a union of such runs, so repeats that overlap or touch are merged to the whole
shared passage, from its first line to its last, and the merged later runs are deleted (with blank
lines inside them).

So: a line is deleted if and only if it lies in a run of at least ``min_words`` words, cut at
line ends, whose equal occurred earlier. Texts are compared exactly (SHA-256 of the run's lines);
hashes of 64 bits only select.

Scale. The lines are dealt by document with their hash and word count only. Windows of a passage
that a third of all documents hold meet in an aggregation with a map-side partial step, never in
one group; its join back is split by the skew handling of adaptive execution.

Defined results: documents are ordered by id (null first), then by text hash; rows that repeat an
id and a text are one document and all get its result; null and empty texts have no lines and
stay as they are; a text that loses all its lines is empty; an empty table gives an empty
table; other columns are kept by ``dedup_lines``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.llm.common import fresh, text_hash, written

MIN_WORDS = 50
_WORDS = r"[^\x20\x09-\x0D]+"


def _lines(docs: DataFrame, id_col: str, text_col: str, key: str) -> DataFrame:
    """d (document key: id, text hash), i (line number from 0), h (line hash), s (SHA-256), w (words)."""
    line = F.posexplode(F.split(F.col(text_col), "\n")).alias("i", "line")
    rows = docs.select(F.col(id_col).alias("id"), F.col(key).alias("th"), line)
    return rows.select(
        "id", "th", "i", F.xxhash64("line").alias("h"), F.unhex(F.sha2("line", 256)).alias("s"), F.regexp_count("line", F.lit(_WORDS)).cast("long").alias("w")
    ).where("w > 0")


def _windows(lines: DataFrame, min_words: int) -> DataFrame:
    """id, th, i (first line), e (last line), f (fingerprint hash), content (of the window), and
    more: the lines behind it (i, s) at which a longer run ends that is matched too."""
    doc = Window.partitionBy("id", "th")
    # words before a line; every line has some, so the sum orders the lines
    at = lines.dropDuplicates(["id", "th", "i"]).withColumn("b", F.sum("w").over(doc.orderBy("i")) - F.col("w"))
    ahead = doc.orderBy("b").rangeBetween(0, min_words - 1)
    behind = doc.orderBy("c").rangeBetween(0, min_words - 1)  # by the words up to a line's end
    sized = (
        at.withColumn("n", F.sum("w").over(ahead))
        .withColumn("e", F.max("i").over(ahead))
        .withColumn("f", F.min(F.struct("h", (-F.col("i")).alias("i"))).over(ahead))
        .withColumn("content", F.unhex(F.sha2(F.array_join(F.transform(F.collect_list("s").over(ahead), F.hex), ""), 256)))
        .select("id", "th", "i", "e", "n", F.col("f.h").alias("f"), (-F.col("f.i")).alias("fi"), "content", "s", "w", (F.col("b") + F.col("w")).alias("c"))
    )
    later = F.filter(F.collect_list(F.struct("i", "s")).over(behind), lambda x: x["i"] > F.col("e"))
    # two neighbours that are a window each: only a run of both holds the blank lines between them, here or at an equal place
    after = F.lead(F.struct("i", "s", "w")).over(doc.orderBy("c"))
    sized = sized.withColumn("later", later).withColumn("after", after)
    both = (F.col("e") == F.col("i")) & (F.col("after.w") >= min_words)
    return (
        sized.withColumn("more", F.when(both, F.array(F.struct("after.i", "after.s"))).otherwise(F.col("later")))
        .where(F.col("n") >= min_words)
        .select("id", "th", "i", "e", "f", "fi", "content", "more")
    )


def _runs(windows: DataFrame) -> DataFrame:
    """id, th, i, e, f, content of every window and of the longer runs from its first line."""
    more = F.col("more")
    text = lambda k: F.concat(F.hex("content"), F.array_join(F.transform(F.slice(more, 1, k + 1), lambda x: F.hex(x["s"])), ""))
    longer = F.transform(more, lambda x, k: F.struct(x["i"].alias("e"), F.unhex(F.sha2(text(k), 256)).alias("content")))
    run = F.explode(F.concat(F.array(F.struct("e", "content")), longer)).alias("run")
    return windows.select("id", "th", "i", "f", run).select("id", "th", "i", "f", "run.e", "run.content")


def repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """id, th (text hash), runs: array of (s, e), the deleted runs of lines of each document, in order."""
    key = fresh(docs.columns, "_text_hash")
    windows = written(_windows(_lines(docs.withColumn(key, text_hash(text_col)), id_col, text_col, key), min_words), "windows")
    # a fingerprint at one place only can't belong to a repeat
    places = windows.select("id", "th", "fi", "f").distinct().groupBy("f").agg(F.count("*").alias("n"))
    shared = places.where("n > 1").select("f")
    place = F.struct("id", "th", "i")
    candidates = _runs(windows.join(shared, "f", "left_semi"))
    first = candidates.groupBy("f", "content").agg(F.min(place).alias("first"), F.count("*").alias("n"))
    first = first.where("n > 1").select("f", "content", "first")
    repeats = candidates.join(first, ["f", "content"]).where(place != F.col("first")).select("id", "th", "i", "e")
    doc = Window.partitionBy("id", "th").orderBy("i")
    reach = F.max("e").over(doc.rowsBetween(Window.unboundedPreceding, -1))
    islands = repeats.withColumn("new", F.coalesce(F.col("i") > reach + 1, F.lit(True)).cast("int"))
    islands = islands.withColumn("island", F.sum("new").over(doc.rowsBetween(Window.unboundedPreceding, 0)))
    runs = islands.groupBy("id", "th", "island").agg(F.min("i").alias("s"), F.max("e").alias("e"))
    return runs.groupBy("id", "th").agg(F.sort_array(F.collect_list(F.struct("s", "e"))).alias("runs"))


def _kept(lines: Column, runs: Column) -> Column:
    """Lines outside the runs: the slices between one run's end and the next run's start."""
    stop = lambda k: F.when(k == 0, F.lit(-1)).otherwise(F.element_at(runs, F.greatest(k, F.lit(1)))["e"])
    count = F.size(runs)
    begin = lambda k: F.when(k == count, F.size(lines)).otherwise(F.element_at(runs, F.least(k + 1, count))["s"])
    between = F.transform(F.sequence(F.lit(0), count), lambda k: F.slice(lines, stop(k) + 2, begin(k) - stop(k) - 1))
    return F.flatten(between)


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, dropped_col: str | None = None
) -> DataFrame:
    """All rows and columns of ``docs``, with the repeated runs taken out of the text;
    ``dropped_col`` names a column to add with the number of lines deleted."""
    th, rid, rth, runs = (fresh(docs.columns, c) for c in ("_text_hash", "_run_id", "_run_hash", "_runs"))
    found = repeated_runs(docs, id_col, text_col, min_words).toDF(rid, rth, runs)
    keyed = docs.withColumn(th, text_hash(text_col))
    # the side with runs is the smaller one: rows with text are not sorted for the join
    both = keyed.join(found.hint("shuffle_hash"), F.col(id_col).eqNullSafe(F.col(rid)) & (F.col(th) == F.col(rth)), "left")
    lines = F.split(F.col(text_col), "\n")
    cleaned = F.when(F.col(runs).isNull(), F.col(text_col)).otherwise(F.array_join(_kept(lines, F.col(runs)), "\n"))
    out = [cleaned.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns]
    if dropped_col:
        gone = F.aggregate(F.col(runs), F.lit(0).cast("long"), lambda a, r: a + (r["e"] - r["s"] + 1))
        out.append(F.coalesce(gone, F.lit(0).cast("long")).alias(dropped_col))
    return both.select(*out)
