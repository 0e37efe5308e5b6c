"""Line dedup, SimHash, vectors, decontamination, WARC and the pipeline against brute force."""

from __future__ import annotations

import random
from collections import Counter
from math import comb

import brute
import numpy as np
import oracle_compare
import pytest
from conftest import SF001, SF01
from pyspark.sql import functions as F

from orderlens.llm import components, decontam, embedding_dedup, line_dedup, oracle, queries, simhash, warc
from orderlens.session import scratch_path


@pytest.mark.parametrize("name", sorted(oracle.QUERIES))
def test_sql_twins(spark, name):
    ok, what = oracle_compare.compare(queries.REGISTRY[name](spark, SF01), oracle_compare.duck(SF01), oracle.QUERIES[name])
    assert ok, what


def _passages(rng, n):
    lines = [" ".join(rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(rng.choice([1, 3, 12, 60]))) for _ in range(14)] + ["", " "]
    return [(i, "\n".join(rng.choice(lines) for _ in range(rng.randint(0, 25)))) for i in range(n)]


def test_line_dedup_random_passages(spark):
    rng = random.Random(5)
    rows = [(i, t if t else None) for i, t in _passages(rng, 60)]
    docs = spark.createDataFrame([(i, t, 7, "r") for i, t in rows], "doc_id long, text string, _runs int, _Text_Hash string").repartition(5)
    out = {r.doc_id: r for r in line_dedup.dedup_lines(docs, dropped_col="n").collect()}
    for (i, text), gone in zip(rows, brute.line_runs(rows), strict=True):
        want = None if text is None else "\n".join(x for k, x in enumerate(text.split("\n")) if k not in gone)
        assert (out[i].text, out[i].n) == (want, len(gone)), i
    assert list(out[0].asDict()) == ["doc_id", "text", "_runs", "_Text_Hash", "n"]


def test_line_dedup_repeated_rows_and_null_ids(spark):
    long = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(2, long), (2, long), (None, long), (1, "x\n" + long), (None, None), (3, "")], "doc_id long, text string")
    got = Counter((r.doc_id, r.text) for r in line_dedup.dedup_lines(docs).collect())
    assert got == Counter([(2, ""), (2, ""), (None, long), (1, "x"), (None, None), (3, "")])  # null ids come first
    assert line_dedup.dedup_lines(docs.limit(0)).count() == 0


def test_line_dedup_is_native(spark):
    plan = line_dedup.dedup_lines(spark.read.parquet(f"{SF001}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_components_random_graph(spark):
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 440)] + [(5, 5)]
    rows = components.components(spark.createDataFrame([*links, (None, 3)], "u long, v long")).collect()
    want = brute.least_reachable({x for e in links for x in e}, links)
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert {r.node: r.component for r in rows} == {n: want[n] for n in linked} and len(rows) == len(linked)
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_contract_keeps_groups():
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 200, 150), rng.integers(0, 200, 150)
    node, root = components.contract(a, b)
    want = brute.least_reachable(set(a.tolist()) | set(b.tolist()), zip(a.tolist(), b.tolist(), strict=True))
    assert dict(zip(node.tolist(), root.tolist(), strict=True)) == {n: r for n, r in want.items() if n != r}


def _simhash_check(rows, out):
    prints = {k: brute.simhash(t) for k, (_, t) in enumerate(rows)}
    links = [(i, j) for i in prints for j in prints if i < j and (prints[i] ^ prints[j]).bit_count() <= 3]
    groups = brute.least_reachable(prints, links)
    ids = {}
    for k, g in groups.items():
        ids.setdefault(g, []).append(rows[k][0])
    least = {g: min((x for x in v if x is not None), default=None) for g, v in ids.items()}
    want = Counter((rows[k][0], f"{prints[k]:016x}", least[groups[k]]) for k in prints)
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in out) == want


@pytest.mark.parametrize("tile", [16384, 4])
def test_simhash_against_all_pairs(spark, tile):
    texts = [r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    odd = [None, "", " \n", "one", "one two", "ONE two", "one two three", "É\x0bx É", "w " * 40000]
    rows = [(i, t) for i, t in enumerate(texts + odd)] + [(None, "one two"), (None, None), (0, texts[0]), (0, "other words here"), (7, texts[1])]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, fp int")
    _simhash_check(rows, simhash.near_duplicates(docs, tile_rows=tile).collect())


def test_simhash_dense_group_of_near_copies(spark):
    rng = random.Random(9)
    base = [f"w{i}" for i in range(4000)]
    rows = []
    for i in range(150):
        words = list(base)
        words[rng.randrange(4000)] = f"x{i}"
        rows.append((i, " ".join(words)))
    out = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), tile_rows=16).collect()
    _simhash_check(rows, out)


def test_one_of_each_group_stays(spark):
    rows = [(3, "a b c d"), (1, "A b c D"), (1, "A b c D"), (2, "quite other words"), (None, "a b c d"), (None, "only null"), (None, "only null"), (9, None), (8, "")]
    docs = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, _text_hash int")
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted([(1, "A b c D"), (2, "quite other words"), (None, "only null"), (8, "")], key=str)
    assert simhash.drop_near_duplicates(docs.limit(0)).count() == 0


def test_rows_that_repeat_stay_once(spark):
    rng = random.Random(9)
    texts = [" ".join(rng.choice("abcdefghijkl") * 3 for _ in range(40)) for _ in range(30)]
    rows = [(i, t, i) for i, t in enumerate(texts)] + [(100 + i, texts[i], 0) for i in range(10)]
    rows += [(3, texts[3], 3)] * 50 + [(None, texts[4], 1)] * 5 + [(None, "alone by itself", 2)] * 5 + [(7, "same id other words", 1)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, n long").repartition(7)
    out = simhash.drop_near_duplicates(docs)
    got = Counter((r.doc_id, r.text) for r in out.collect())
    assert out.columns == docs.columns
    assert got == Counter([*enumerate(texts), (None, "alone by itself"), (7, "same id other words")])


def _vector_rows(rng, n=240, dim=64):
    rows = []
    for _ in range(n // 6):
        centre, label = rng.standard_normal(dim), int(rng.integers(0, 3))
        for spread in (0, 0.002, 0.006, 0.01, 0.014, 0.3):
            rows.append((len(rows), (centre + spread * np.linalg.norm(centre) * rng.standard_normal(dim)).tolist(), label))
    rows += [(1000, None, 1), (1001, [0.0] * dim, 1), (1002, [float("nan")] * dim, 1), (1003, [None] + [1.0] * (dim - 1), 1), (1004, rows[0][1], None)]
    rows += [(1005, rows[0][1], rows[0][2]), (None, rows[6][1], rows[6][2]), (1006, [1.0, 2.0], 0), (1007, [1.0, 2.001], 0), (1008, [], 0), (1009, [float("inf")] * dim, 0), (5, rows[12][1], rows[12][2])]
    return rows


@pytest.mark.parametrize(("tile", "agree"), [(1024, None), (6, 1), (1024, 2), (6, 3)])
def test_vectors_against_brute_force(spark, tile, agree):
    rows = _vector_rows(np.random.default_rng(4))
    frame = spark.createDataFrame([(i, v, lab, "x") for i, v, lab in rows], "vec_id long, embedding array<double>, label int, node string")
    out = embedding_dedup.near_vectors(frame, tile=tile, agree=agree).collect()
    links = brute.cosine_links(rows)
    found = sum(r.n_links for r in out) / 2
    assert 0.9 * len(links) <= found <= len(links)
    groups = brute.least_reachable(range(len(rows)), links)
    ids = {}
    for k, g in groups.items():
        ids.setdefault(g, []).append(rows[k][0])
    want = Counter((rows[k][0], min((x for x in ids[g] if x is not None), default=None)) for k, g in groups.items())
    if found == len(links):
        assert Counter((r.vec_id, r.component_id) for r in out) == want
    assert all(r.kept == (r.vec_id == r.component_id) for r in out)
    assert embedding_dedup.near_vectors(frame.limit(0)).count() == 0


def test_vector_recall_on_whole_table(spark):
    out = {r.vec_id: r for r in queries.REGISTRY["op6_embedding_dedup"](spark, SF01).collect()}
    rows = [tuple(r) for r in spark.read.parquet(f"{SF01}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    links = brute.cosine_links(rows)
    assert len(out) == len(rows) and sum(r.n_links for r in out.values()) / 2 >= 0.9 * len(links)


def test_tables_hold_every_pair_within_the_radius():
    rng = np.random.default_rng(3)
    for bits, agree in ((64, 1), (64, 2), (64, 3), (20, 2), (3, 1)):
        tables = embedding_dedup.make_tables(bits, 5, agree)
        a = rng.integers(0, 1 << bits, 400, np.uint64) if bits < 64 else rng.integers(0, 1 << 63, 400, np.uint64) * np.uint64(2)
        b = a.copy()
        for k, flips in enumerate(rng.integers(0, min(bits, 9) + 1, 400).tolist()):
            for bit in rng.choice(bits, flips, replace=False).tolist():
                b[k] ^= np.uint64(1 << bit)
        shared = [[t for t, m in enumerate(tables.masks) if (x & m) == (y & m)] for x, y in zip(a, b, strict=True)]
        assert tables.meet(a, b).tolist() == [s[0] if s else len(tables.masks) for s in shared]
        assert all(s for s, x, y in zip(shared, a.tolist(), b.tolist(), strict=True) if (x ^ y).bit_count() <= 5)


def test_keys_grow_with_the_number_of_vectors():
    plans = [embedding_dedup.plan_tables(n, 64) for n in (0, 500, 10**6, 10**9, 10**11)]
    assert plans == sorted(plans) and plans[0] == 1 and plans[2] == 2 and plans[3] == 3
    compared = [n * comb(5 + m, m) / 2 ** (64 * m / (5 + m)) for n, m in ((10**6, plans[2]), (10**9, plans[3]), (10**11, plans[4]))]
    assert max(compared) < 10**4  # of each vector, at any size; one block alone would compare 4 * 10^8
    assert embedding_dedup.plan_tables(10**9, 3) == 1


@pytest.mark.parametrize("agree", [1, 2, 3])
def test_vector_recall_at_the_threshold(spark, agree):
    rng = np.random.default_rng(12)
    rows = []
    for k in range(400):  # a planted partner at a cosine of 0.98 to 0.99 for each
        x, y = rng.standard_normal((2, 64))
        x /= np.linalg.norm(x)
        y -= (y @ x) * x
        c = rng.uniform(0.9801, 0.99)
        rows += [(2 * k, x.tolist(), k % 3), (2 * k + 1, (c * x + np.sqrt(1 - c * c) * y / np.linalg.norm(y)).tolist(), k % 3)]
    out = embedding_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), agree=agree).collect()
    links = brute.cosine_links(rows)
    assert len(links) == 400 and 0.9 * 400 <= sum(r.n_links for r in out) / 2 <= 400


def test_large_bucket_counts_every_pair(spark):
    rng = np.random.default_rng(8)
    base = rng.standard_normal(64)
    rows = [(i, (base + 0.004 * rng.standard_normal(64)).tolist(), 1) for i in range(300)] + [(300 + i, base.tolist(), 1) for i in range(40)]
    out = embedding_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), tile=50).collect()
    assert {r.n_links for r in out} == {339} and {r.component_id for r in out} == {0}


def test_decontamination_against_every_window(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text").where("doc_id < 120").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF01}/benchmark.parquet").collect()]
    rng, edited = random.Random(3), []
    for k in range(40):
        words = items[k % len(items)][1].split()
        for _ in range(k % 3):
            words[rng.choice([0, -1, rng.randrange(len(words))])] = "changed"
        edited.append((1000 + k, "some lead words " + " ".join(words).upper() + " and a tail"))
    items += [(900, "three short words"), (901, "word"), (902, None), (903, " "), (900, "three short words")]
    docs += [*edited, (None, "with THREE short words inside"), (2000, None), (2001, ""), (2002, "three short")]
    frame = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = {(d, i): s for d, t in docs for i, x in dict(items).items() if t and x and x.strip() and (s := brute.best_window(t, x)) >= 0.8}
    for block_rows in (4000, 15):
        got = decontam.contaminated(frame, bench, block_rows=block_rows).collect()
        assert {(r.doc_id, r.item_id): pytest.approx(r.similarity) for r in got} == want and len(got) == len(want)
    kept = decontam.drop_contaminated(frame, bench, block_rows=15)
    assert kept.columns == frame.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(d for d, _ in docs if d not in {k for k, _ in want})
    assert decontam.contaminated(frame, bench.limit(0)).count() == 0 and decontam.drop_contaminated(frame.limit(0), bench).count() == 0


def test_anchors_find_every_similar_item_and_leave_common_shingles_out():
    rng = random.Random(11)
    lead = "which of the following is the best answer to the question".split()
    items = [(k, " ".join(lead + [f"w{rng.randrange(4000)}" for _ in range(19)])) for k in range(1500)]
    index = decontam.ItemIndex(items)
    # a text full of the shingles that all items share meets none of them
    common = " ".join(lead * 40).encode().split()
    assert sum(len(found) for *_, found in index.candidates(decontam.word_hashes(common))) == 0
    # one changed word at either end keeps 0.8; windows are compared with about their own item only
    for k in range(0, 1500, 50):
        words = items[k][1].split()
        text = " ".join(["x", *words[:-1], "changed", "y"])
        assert [h[0] for h in index.hits(text)] == [k]
        compared = sum(len(found) for *_, found in index.candidates(decontam.word_hashes(text.encode().split())))
        assert 1 <= compared <= 60


def test_repeated_shingles_and_item_blocks_by_bytes(spark):
    # items that repeat few shingles: multisets decide, and equal best windows give the first
    items = [(1, "a b c d e " * 6), (2, "a " * 12), (3, "a b " * 9 + "z"), (4, "q " * 40 + "r s t u v"), (5, "long words here " * 500)]
    docs = [(1, "a b c d e " * 9), (2, "a " * 30), (3, "y " + "a b " * 9 + "z a b"), (4, "q " * 41 + "r s t u w"), (5, "x " + "Long words here " * 520)]
    want = {(d, i): s for d, t in docs for i, x in items[:4] if (s := brute.best_window(t, x)) >= 0.8} | {(5, 5): 1.0}
    frame, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    for size in (1 << 24, 100):
        got = decontam.contaminated(frame, bench, block_bytes=size).collect()
        assert {(r.doc_id, r.item_id): r.similarity for r in got} == pytest.approx(want) and len(got) == len(want)
        assert {(r.doc_id, r.item_id): r.start_word for r in got}[2, 2] == 0
    left = decontam.drop_contaminated(frame.unionByName(frame.selectExpr("doc_id + 10 AS doc_id", "'free text' AS text")), bench, block_rows=1)
    assert {r[0] for r in left.collect()} == {d for d, _ in docs if d not in {k for k, _ in want}} | {11, 12, 13, 14, 15}


def test_warc_round_trip(spark):
    big, other = "<p>" + "x" * 200, "é" * 60
    rows = [(4, "u4", big), (2, "u2", big), (2, "u2", big), (9, None, other), (None, "n", other), (None, "m", "only here " * 20), (None, "m", "only here " * 20), (5, "u5", "small"), (6, "u\r\n6", "small"), (7, "u", None), (8, "u", "")]
    pages = spark.createDataFrame([(i, u, h, "z") for i, u, h in rows], "page_id long, url string, html string, payload string")
    folder = scratch_path(spark, "warc-test")
    index = warc.write_archives(pages, folder)
    got = warc.read_records(index, folder).collect()
    assert len(got) == len(rows)
    kinds = Counter((r.page_id, r.record_type, r.refers_to) for r in got)
    assert kinds == Counter({
        (2, "response", None): 1, (2, "revisit", 2): 1, (4, "revisit", 2): 1, (9, "response", None): 1, (None, "revisit", 9): 1, (None, "response", None): 1,
        (None, "revisit", None): 1, (5, "response", None): 1, (6, "response", None): 1, (7, "response", None): 1, (8, "response", None): 1,
    })
    assert {r.payload.decode() for r in got if r.payload is not None} == {(h or "") for _, _, h in rows}
    one = warc.read_records(index.where("page_id = 9"), folder).collect()
    assert [(r.url, r.payload_bytes) for r in one] == [(None, 120)]
    none = scratch_path(spark, "warc-none")
    assert warc.read_records(warc.write_archives(pages.limit(0), none), none).count() == 0


def test_warc_ids_of_every_type(spark):
    html = "<p>" + "same text " * 20
    rows = [("a\r\nb: c", "u1", html), ("ü %41/", "u\r\n2", html), ("ü %41/", "u3", html), ("", None, "short"), ("", None, "short"), (None, "u4", html), (None, None, None)]
    text = spark.createDataFrame([(*r, 7, "x") for r in rows], "page_id string, url string, html string, digest int, k string").repartition(3)
    cases = {"string": None, "decimal(20,3)": "decimal", "date": "date", "double": "double", "timestamp": "timestamp", "int": "int"}
    number = "case page_id when '' then 1 when 'ü %41/' then 3 when 'a\r\nb: c' then 2 end"
    for kind, name in cases.items():
        made = {None: "page_id", "date": f"date_add(date'2020-01-01', {number})", "timestamp": f"timestamp_micros({number} * 1234567)"}.get(name, f"cast({number} * 1.5 as {kind})")
        pages = text.withColumn("page_id", F.expr(made))
        folder = scratch_path(spark, "warc-ids")
        got = warc.read_records(warc.write_archives(pages, folder), folder)
        assert got.schema["page_id"].dataType == pages.schema["page_id"].dataType
        want = Counter((r.page_id, (r.html or "").encode()) for r in pages.collect())
        shown = got.collect()
        payload = {r.payload_digest: bytes(r.payload) for r in shown if r.payload is not None}
        assert Counter((r.page_id, payload[r.payload_digest]) for r in shown) == want
        long = [r for r in shown if r.payload_bytes >= 100]
        first = min(r.page_id for r in long if r.page_id is not None)
        assert [r.page_id for r in long if r.record_type == "response"] == [first]
        assert all(r.refers_to == first for r in long if r.record_type == "revisit")


def test_warc_revisits_name_their_response(spark):
    pages = spark.createDataFrame([(i, f"http://x/{i}", "<p>" + "text " * 40) for i in (3, 1, 2, 2)], "page_id long, url string, html string")
    folder = scratch_path(spark, "warc-revisits")
    index = warc.write_archives(pages, folder).collect()
    heads = []
    for r in index:
        with open(f"{folder.removeprefix('file:')}/{r.file}", "rb") as f:
            f.seek(r.offset)
            heads.append(warc.parse(f.read(r.length))[0])
    response = next(h for h in heads if h["WARC-Type"] == "response")
    assert len({h["WARC-Record-ID"] for h in heads}) == 4
    assert all(h["WARC-Refers-To"] == response["WARC-Record-ID"] and h["WARC-Refers-To-Target-URI"] == "http://x/1" for h in heads if h is not response)


def test_archives_are_plain_gzip_warc(spark):
    import glob
    import gzip

    folder = scratch_path(spark, "warc-plain")
    n = warc.write_archives(spark.read.parquet(f"{SF001}/pages.parquet"), folder).count()
    files = glob.glob(folder.removeprefix("file:") + "/*.warc.gz")
    assert sum(gzip.open(f).read().count(b"WARC/1.1\r\nWARC-Type: ") for f in files) == n


def test_ranges_merge_neighbours_only():
    spans = [(0, 10), (10, 5), (20, 5), (10_000_000, 7), (10_000_007, warc.RANGE_BYTES + 1)]
    assert [(a, b, len(m)) for a, b, m in warc.ranges(spans)] == [(0, 25, 3), (10_000_000, 10_000_007, 1), (10_000_007, 10_000_008 + warc.RANGE_BYTES, 1)]


def test_pipeline_stages(spark):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    names, columns, seen = [n for n, _ in p.STAGES], docs.columns, [docs.count()]
    assert names == ["quality", "line_dedup", "near_dedup", "decontamination", "encoding"]
    for name, stage in p.STAGES:
        path = scratch_path(spark, f"stage-{name}")
        before, out = docs, stage(spark, docs, SF01)
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        seen.append(docs.count())
        if name != "encoding":
            assert docs.columns == columns
        if name == "near_dedup":
            rows = [(r.doc_id, r.text) for r in before.collect()]
            prints = {i: brute.simhash(t) for i, t in rows}
            groups = brute.least_reachable(prints, [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 3])
            assert {r.doc_id for r in docs.collect()} == {i for i, g in groups.items() if i == g}
        if name == "decontamination":
            items = [r.text for r in spark.read.parquet(f"{SF01}/benchmark.parquet").collect()]
            gone = {r.doc_id for r in before.collect()} - {r.doc_id for r in docs.collect()}
            texts = {r.doc_id: r.text for r in before.collect()}
            assert gone and all(any(brute.best_window(texts[d], x) >= 0.8 for x in items) for d in gone)
    assert seen[0] > seen[1] == seen[2] > seen[3] > seen[4] == seen[5]


def test_pipeline_on_an_empty_table(spark, tmp_path):
    import corpus_pipeline as p

    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF001}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert p.run(spark, str(tmp_path)).count() == 0
