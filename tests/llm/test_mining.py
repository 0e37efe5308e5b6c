"""Hard negatives, collocations and fingerprints against plain versions."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
from conftest import SF001
from pyspark.sql import functions as F

from orderlens.llm import fingerprints, hard_negatives, phrases, queries


# ------------------------------------------------------------------ hard negatives
def _negatives(rows, every=3):
    """rows: (id, vector, label); anchors are the ids divisible by ``every``."""
    whole = lambda v: [math.floor(256 * x) for x in v]
    usable = [(k, i, whole(v), lab) for k, (i, v, lab) in enumerate(rows) if lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    key = lambda x: (-x[0], x[1] is None, x[1] or 0)
    out = Counter()
    for k, i, a, lab in usable:
        if i is None or i % every:
            continue
        scored = [(sum(x * y for x, y in zip(a, b, strict=True)), j, other) for m, j, b, other in usable if m != k and len(a) == len(b)]
        for p, j, _ in sorted((x for x in scored if x[2] == lab), key=key)[:5]:
            fit = [x for x in scored if x[2] != lab and 30 * p <= 100 * x[0] <= 90 * p]
            for rank, (s, n, _) in enumerate(sorted(fit, key=key)[:10], 1):
                out[i, j, rank, n, p, s] += 1
    return out


def _mined(spark, rows, **options):
    frame = spark.createDataFrame([(i, v, lab, "x", 0.5) for i, v, lab in rows], "vec_id long, embedding array<double>, label int, q string, r double").repartition(3)
    got = hard_negatives.hard_negatives(frame, F.col("vec_id") % 3 == 0, **options).collect()
    return Counter(tuple(r) for r in got)


def test_hard_negatives_equal_brute_force(spark):
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(6)], rng.randrange(3)) for i in range(160)]
    assert _mined(spark, rows) == _negatives(rows)
    assert _mined(spark, rows, block_bytes=900, sample_rows=5) == _negatives(rows)  # many blocks, a bad start
    ties = [(i, [rng.choice([0.0, 0.5, 1.0]) for _ in range(3)], i % 2) for i in range(90)]
    assert _mined(spark, ties) == _negatives(ties)


def test_hard_negatives_odd_rows(spark):
    rng = random.Random(5)
    rows = [(i, [abs(rng.gauss(0, 0.3)) for _ in range(4)], i % 2) for i in range(40)]
    rows += [(3, [0.2, 0.1, 0.4, 0.3], 0), (3, [0.2, 0.1, 0.4, 0.3], 0), (None, [0.5] * 4, 1), (None, [0.5] * 4, 0)]  # repeated and null ids
    rows += [(6, None, 1), (9, [0.1, None, 0.2, 0.3], 1), (12, [float("nan")] * 4, 1), (15, [float("inf"), 0.0, 0.0, 0.0], 0), (18, [0.1] * 4, None)]
    rows += [(21, [0.5, 0.5], 0), (24, [0.4, 0.5], 0), (27, [0.4, 0.3], 1), (30, [], 0), (33, [], 0), (36, [], 1)]  # other lengths
    rows += [(300 + i, [2000.0 * (i + 1), 1e6], i % 2) for i in range(8)]  # sums past 2^53
    assert _mined(spark, rows) == _negatives(rows)
    assert not _mined(spark, [])
    assert not _mined(spark, [(3, [0.5], 0), (6, [-0.5], 0), (9, [0.4], 1)])  # a positive under 0 has no window
    assert not _mined(spark, [(3, [0.5], 0), (6, [0.5], None)])


def test_pairs_over_leaves_dimensions_out_of_the_index_and_no_pair():
    rng = np.random.default_rng(6)
    for d, n in ((24, 90), (3, 40), (1, 5)):
        rows = np.floor(rng.normal(0, 50, (n, d)) * np.geomspace(1, 0.02, d))
        anchors, scores = rows[:20], rows[:20] @ rows.T
        for share in (0.01, 0.2, 1.0):
            least = np.maximum(0, np.quantile(scores, 1 - share, axis=1))
            i, j, s = hard_negatives.pairs_over(anchors, rows, least)
            assert {(a, b, c) for a, b, c in zip(i.tolist(), j.tolist(), s.tolist(), strict=True)} == {
                (a, b, int(scores[a, b])) for a, b in zip(*np.nonzero(scores >= least[:, None]), strict=True)
            }
            assert len(i) == (scores >= least[:, None]).sum()


# ------------------------------------------------------------------ collocations
def _collocations(rows, least=10, percent=50, top=2000):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang, text = lang if lang is not None else "und", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            f.update((lang, tuple(words[i : i + k])) for k in (1, 2, 3) for i in range(len(words) - k + 1))
    common = {p: a for p, a in f.items() if a >= least}
    out = []
    for (lang, p), a in common.items():
        if len(p) == 1 or any(q[0] == lang and len(q[1]) > len(p) and 100 * b >= percent * a and any(q[1][s : s + len(p)] == p for s in range(2)) for q, b in common.items()):
            continue
        score, _, left, right = min((1000000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
        out.append((lang, " ".join(p), a, left, right, n[lang], score))
    ranked = set()
    for lang in n:
        best = sorted((x for x in out if x[0] == lang), key=lambda x: (-x[6], -x[2], x[1].encode()))[:top]
        ranked |= {(lang, rank, *x[1:]) for rank, x in enumerate(best, 1)}
    return ranked


def _mined_phrases(spark, rows, **options):
    frame = spark.createDataFrame([(lang, t, 1, "z") for lang, t in rows], "lang string, text string, n int, phrase string").repartition(3)
    got = phrases.collocations(frame, **options).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()
    assert len({tuple(r) for r in got}) == len(got)
    return {tuple(r) for r in got}


def test_collocations_equal_brute_force(spark):
    rng = random.Random(7)
    words = ["New", "york", "città", "the", " ", "日本", "x y", "ÿÿ", "\x01\x1f", "a-b", "É"]
    gaps = [" "] * 8 + ["\t ", ", ", ".", "\n", "\r", "\x0b!", " ? "]
    text = lambda: "".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randint(0, 60)))
    rows = [(rng.choice(["en", "en", "de", None, "und", "", "x\ny", "x"]), text()) for _ in range(160)]
    rows += [("en", None), (None, None), ("fr", ""), ("en", "  ..")] + [("de", "immer die gleiche Zeile hier")] * 30
    want = _collocations(rows)
    assert want and _mined_phrases(spark, rows) == want
    assert _mined_phrases(spark, rows, block_bytes=60) == want  # many tries
    assert _mined_phrases(spark, rows, top=3) == _collocations(rows, top=3)
    assert not _mined_phrases(spark, [])
    assert not _mined_phrases(spark, [("en", "a b")])


def test_passes_read_the_languages_of_their_block(spark, monkeypatch):
    """A block's pass reads the texts of its languages, and a language's phrases are cut by their first words."""
    read, placed, cut = [], [], phrases._blocks
    monkeypatch.setattr(phrases, "_blocks", lambda *a: placed.append(cut(*a)) or placed[-1])
    counted = phrases._pass
    monkeypatch.setattr(phrases, "_pass", lambda texts, *rest: read.append({r.lang for r in texts.select("lang").distinct().collect()}) or counted(texts, *rest))
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefg") for _ in range(9)) for _ in range(40)]
    rows = [("en", " ".join(rng.choice(words) for _ in range(30))) for _ in range(60)] + [(x, "kleine kleine sprache") for x in ("de", "fr", "es") for _ in range(12)]
    got = _mined_phrases(spark, rows, block_bytes=260)
    assert got and got == _collocations(rows)
    assert {"en"} in read and {"de", "es", "fr"} in read  # level 1; later ones fit one block
    words, langs = placed[0]
    assert langs.count(["en"]) > 1 and len(langs) == len({r.block for r in words.select("block").collect()} | set(range(len(langs))))
    # a first word whose phrases pass a block goes to several, another one to one; any number of languages
    many = spark.createDataFrame([("en", f"a {i:04}") for i in range(400)] + [("en", f"b{i} x") for i in range(40)] + [("en", f"b{i} y") for i in range(40)], "lang string, phrase string")
    blocks, langs = cut(many, 1000)
    per = blocks.selectExpr("block", "phrase", "octet_length(phrase) + 3 as size").toPandas()
    assert per.groupby("block")["size"].sum().max() <= 1000 and len(per) == 480 and set(per.block) <= set(range(len(langs)))
    light = per[per.phrase.str.startswith("b")]
    assert light.groupby(light.phrase.str.split(" ").str[0]).block.nunique().max() == 1 and per[per.phrase.str.startswith("a")].block.nunique() > 1
    monkeypatch.setattr(phrases, "MAX_LANGS", 2)
    assert _mined_phrases(spark, rows, block_bytes=260) == got


def test_scores_are_exact_past_64_bits(spark):
    a, left, right = 987_654_321_987, 999_999_999_999, 990_000_000_007
    counts = spark.createDataFrame([("en", "x y", a), ("en", "x", left), ("en", "y", right)], "lang string, phrase string, n long")
    assert [tuple(r) for r in phrases.cut_scores(counts).collect()] == [("en", "x y", a, left, right, 1_000_000 * a * a // (left * right))]
    ties = spark.createDataFrame([("en", "x y z", 5), ("en", "x y", 5), ("en", "y z", 5), ("en", "x", 5), ("en", "z", 5), ("en", "y", 9)], "lang string, phrase string, n long")
    assert ("en", "x y z", 5, 5, 5, 1_000_000) in {tuple(r) for r in phrases.cut_scores(ties).collect()}


def test_trie_finds_its_keys_and_no_others():
    rng = random.Random(8)
    keys = sorted({bytes(rng.choice(b"abcdefghijklmnopqrstuvw\xc3\xa9\xff") for _ in range(rng.randint(1, 7))) for _ in range(9000)})
    trie = phrases.Trie.build(keys)
    for k, key in enumerate(keys):
        assert trie.key[trie.walk(key)] == k
    for _ in range(2000):
        key = bytes(rng.randrange(97, 123) for _ in range(4))
        state = trie.walk(key)
        assert (state >= 0 and trie.key[state] >= 0) == (key in set(keys[:0]) or key in keys)


# ------------------------------------------------------------------ fingerprints
def _jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def _edited(rows):
    """(id, n_chars, sha of the edited text, likeness) for distinct rows, in order, with copies."""
    docs = sorted(Counter((i, t or "") for i, t in rows).items(), key=lambda x: (x[0][0] is None, -(x[0][0] or 0)))
    cut = lambda t: set(fingerprints.paragraph_digests([t], fingerprints.PASSAGE_WORDS)[1].tolist())
    out = Counter()
    for k, ((i, text), n) in enumerate(docs):
        after = docs[(k + 1) % len(docs)][0][1]
        half = len(text) // 2
        new = text[: len(text) - half] + after[:half]
        out[i, len(text), hashlib.sha256(new.encode()).hexdigest(), round(_jaccard(cut(text), cut(new)), 9), round(_jaccard(cut(text), cut(after)), 9)] += n
    return out


def _fingerprinted(spark, rows):
    frame = spark.createDataFrame([(t, i, 1, "c") for i, t in rows], "text string, doc_id long, p int, copies string").repartition(5)
    got = fingerprints.edited_fingerprints(frame).collect()
    return got, Counter((r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in got)


def test_fingerprints_equal_brute_force(spark):
    rng = random.Random(9)
    text = lambda n: "".join(rng.choice(["alpha", "béta", "日本", "x", "omega"]) + rng.choice(["", "ß", "q"]) + rng.choice([" ", " ", "\n", "\t"]) for _ in range(n))
    rows = [(i * 3 - 50, text(rng.choice([0, 1, 2, 9, 80, 700]))) for i in range(150)] + [(1000, None), (1001, ""), (None, "last of all"), (1002, "y" * 5000), (1003, "z " * 4000)]
    got, counted = _fingerprinted(spark, rows)
    assert counted == _edited(rows)
    prints = {}
    texts = {i: t or "" for i, t in rows}
    for r in got:
        assert prints.setdefault(texts[r.doc_id], r.fingerprint) == r.fingerprint
    assert len(set(prints.values())) == len({tuple(fingerprints.paragraph_digests([t], 4)[1].tolist()) for t in prints})


def test_fingerprints_of_copies_and_small_tables(spark):
    rows = [(7, "one two three\nfour")] * 9000 + [(5, "five six")] * 2 + [(6, None), (6, ""), (None, "none"), (None, "none")]
    got, counted = _fingerprinted(spark, rows)
    assert counted == _edited(rows)
    assert _fingerprinted(spark, [])[0] == []
    only = _fingerprinted(spark, [(1, "abcd ef")])[0][0]
    assert only.edited_sha256 == hashlib.sha256(b"abcdabc").hexdigest() and only.near_next == 1.0


def test_peeling_recovers_the_paragraphs_that_differ(spark):
    old = "\n".join(f"paragraph number {i}" for i in range(300))
    new = old.replace("number 7\n", "number seven\n") + "\nparagraph number 5"
    rows = [(1, old, new), (2, old, old), (3, None, old), (4, "", None), (5, "a\na\na", "a\na")]
    got = {r.doc_id: r for r in fingerprints.changed_paragraphs(spark.createDataFrame(rows, "doc_id long, old string, new string")).collect()}
    digest = lambda t: set(fingerprints.paragraph_digests([t])[1].view(np.int64).tolist())
    for i, a, b in rows:
        a, b = digest(a or ""), digest(b or "")
        assert (set(got[i].removed), set(got[i].added)) == (a - b, b - a)
        assert len(got[i].removed) == len(a - b) and len(got[i].added) == len(b - a)
    assert got[1].cells == fingerprints.CELLS and got[3].cells > 300  # few differences in a long text need no larger sketch
    assert (len(got[5].removed), len(got[5].added)) == (1, 0)


def test_queries_of_the_mining_operators(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()
    got = queries.REGISTRY["op13_fingerprints"](spark, SF001).collect()
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in got) == _edited([(r.doc_id, r.text) for r in docs])
