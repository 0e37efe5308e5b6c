"""Line dedup by its definition: every run of lines with enough words whose equal occurred earlier."""

from __future__ import annotations

import random

import brute

from orderlens.llm import line_dedup


def _deduped(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    return {r.doc_id: (r.text, r.n) for r in line_dedup.dedup_lines(docs, dropped_col="n", **options).collect()}


def test_tail_of_a_shared_passage_goes(spark):
    words = lambda c, n: " ".join(f"{c}{i}" for i in range(n))
    long, tail, last = words("a", 50), words("b", 40), words("c", 9)
    copy = "\n".join([long, "", tail, last])
    out = _deduped(spark, [(1, copy), (2, copy), (3, "\n".join([long, tail, "own", last])), (4, "\n".join([long, "own", tail]))])
    assert out == {1: (copy, 0), 2: ("", 4), 3: ("own\n" + last, 2), 4: ("own\n" + tail, 1)}


def test_runs_by_definition_on_random_passages(spark):
    rng = random.Random(11)
    for sizes, options in (([1, 3, 12, 60], {}), ([1, 2, 7, 20, 45], {}), ([1, 2, 3], {"min_words": 4}), ([1, 2], {"min_words": 1}), ([60, 70], {})):
        lines = [" ".join(rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(rng.choice(sizes))) for _ in range(9)] + ["", " "]
        rows = [(i, "\n".join(rng.choice(lines) for _ in range(rng.randint(0, 25)))) for i in range(60)]
        whole = [i for i in range(40, 60) if i % 2]  # exact copies and copies of a part
        rows = [(i, rows[i - 40][1] if i in whole else t) for i, t in rows]
        out = _deduped(spark, rows, **options)
        for (i, text), gone in zip(rows, brute.line_runs(rows, **options), strict=True):
            assert out[i] == ("\n".join(x for k, x in enumerate(text.split("\n")) if k not in gone), len(gone)), (sizes, i)
