"""BPE, page text, token counts, license scan, quality: brute force, round trips and edge rows."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from conftest import SF001, SF01
from tokenizers import Tokenizer

from orderlens.llm import bpe, html_extract, license_scan, quality, queries, token_counts

ODD = [None, "", " \n\t", "a", "<|endoftext|> x<|startoftext|>", "ΑΣ ΣΑΣ İx", "aaaa" * 4000, "it's 'll DON'T 12³", "a\x1cb\x85c　d", " " * 5000 + "end"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def _docs(spark, texts):
    rows = [(i, t, "x", 1.0) for i, t in enumerate(texts)] + [(None, "null id", "y", None), (3, "a", None, 2.0)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, score double")


def _expect(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    packed = np.array(ids, "<u4").tobytes()
    out = library.decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(out.encode()).hexdigest()


def test_bpe_equals_library_on_whole_table(spark, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()}
    rows = queries.REGISTRY["op1_bpe"](spark, SF01).collect()
    assert len(rows) == len(texts)
    assert all((r.n_tokens, r.ids_sha256, r.decoded_sha256) == _expect(library, texts[r.doc_id]) for r in rows)


def test_bpe_odd_texts(spark, library):
    docs = _docs(spark, ODD)
    out = bpe.digests(bpe.encode_documents(docs, public_tokenizers.path("word_bpe_49k.json"))).collect()
    want = sorted(_expect(library, r.text) for r in docs.collect())
    assert sorted((r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in out) == want
    assert bpe.encode_documents(docs.limit(0), public_tokenizers.path("word_bpe_49k.json")).count() == 0


def test_bpe_every_code_point(library):
    codec = bpe.PairIndexBpe(bpe.read_spec(public_tokenizers.path("word_bpe_49k.json")))
    texts = [f"a{chr(c)}b {chr(c)}" for c in range(0, 0x30000, 7) if not 0xD800 <= c < 0xE000]
    got = codec.encode(texts)
    want = [np.array(e.ids, "<u4").tobytes() for e in library.encode_batch(texts, add_special_tokens=False)]
    assert got == want


def test_pages_keep_the_article(spark):
    page = (
        "<html><head><title>T</title><style>p{}</style></head><body><nav><a href=/x>Home</a></nav><div class='ad'>Buy</div>"
        "<script>var t='</p>';</script><article><h1>Head  line</h1><p><b>One&nbsp;&amp;\n two.<br><p>Sh.</p><div class=ad>No</div>"
        "<p>Last one</article><section id=comments><p>A reader says a lot of things here, many words indeed.</p></section>"
        "<aside>Side</aside><form>Name</form><footer>&copy; me</footer></body></html>"
    )
    plain = "<div class=menu>x</div><div><p>" + "word " * 30 + "</p><p>short</p></div><p class=cookie-notice>" + "we use them " * 20 + "</p>"
    rows = [(1, "u", page, 5), (2, None, None, 1), (None, "v", "", 2), (4, "w", plain, 3), (4, "w", plain, 3), (5, "z", "<p", 1), (6, "z", "<!-- open", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = sorted(((r.page_id, r.text, r.n_chars) for r in html_extract.extract(pages).collect()), key=str)
    first = "Head line\nOne & two.\nSh.\nLast one"
    fourth = ("word " * 30).strip() + "\nshort"
    want = [(1, first, len(first)), (2, "", 0), (None, "", 0), (4, fourth, len(fourth)), (4, fourth, len(fourth)), (5, "<p", 2), (6, "", 0)]
    assert [w for w in sorted(want, key=str) if w[0] != 5] == [g for g in got if g[0] != 5]
    assert html_extract.extract(pages.limit(0)).count() == 0


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<article><p>Kept</p></article><article class='comment'><p>A reader</p></article>", "Kept"),
        ("<article><p>One<svg/></p><p>Two</p><svg><text>no</text></svg>Three</article>", "One\nTwo\nThree"),
        ("<main><div role=alert>We use</div><p>Kept <span class='share'>Share</span>here</p><ul class=menu><li>x</ul></main>", "Kept\nhere"),
        ("<article><p>a &lt;b&gt; &eacute; &#x41;<!-- no --> c<script>if (a<b) {}</script></p><noscript>no</noscript></article>", "a <b> \u00e9 A c"),
        ("<div id=cookie-banner>We use cookies on this site to make it better for all of you, agree?</div><div><p>" + "text " * 20 + "</p></div>", ("text " * 20).strip()),
        ("<article><ul><li>one<li>two</ul><table><tr><td>x</td><td>y</td></tr></table></article>", "one\ntwo\nx\ny"),
    ],
)
def test_page_shapes(page, text):
    assert html_extract.main_text(page) == text


def test_long_page_in_one_pass():
    page = "<article>" + "<p>some words of a paragraph</p>" * 20000 + "<div class=ad>" + "x <" * 20000
    assert html_extract.main_text(page).count("\n") == 19999


def test_token_table_against_brute_force(spark):
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    with open(path) as f:
        enc = token_counts.encoding(f.read(), pattern)
    assert isinstance(enc, tiktoken.Encoding)
    texts = [r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()] + ODD + ["x " * 3000, " " * 300_000]
    n = [token_counts.count_tokens(enc, pattern, t) for t in texts]
    docs = spark.createDataFrame([(None, t, 1) for t in texts], "doc_id long, text string, n_tokens int")
    hist = token_counts.histogram(token_counts.token_lengths(docs, path, pattern))
    rows = token_counts.context_table(hist).collect()
    assert sorted(r.n_tokens for r in rows) == sorted(set(n))
    for r in rows:
        longer = [x for x in n if x > r.n_tokens]
        assert (r.n_docs, r.docs_longer, r.tokens_longer) == (n.count(r.n_tokens), len(longer), sum(longer))
        assert r.truncated_total == sum(min(x, r.n_tokens) for x in n)
        assert r.share_fitting == pytest.approx((len(n) - len(longer)) / len(n))
    at = token_counts.totals_at(hist, [1, 500]).first()
    assert (at.total, at.total_1, at.total_500) == (sum(n), sum(min(x, 1) for x in n), sum(min(x, 500) for x in n))
    q = token_counts.quantiles(token_counts.context_table(hist), [0.5]).first()
    assert q.q50 == sorted(n)[-(-len(n) // 2) - 1]
    empty = token_counts.histogram(token_counts.token_lengths(docs.limit(0), path, pattern))
    assert token_counts.context_table(empty).count() == 0 and token_counts.totals_at(empty, [1]).first().total is None


def test_license_names_and_wording(spark):
    lines = [
        "Licensed under CC BY-NC 4.0.", "Licensed under CC BY 4.0.", "This work is licensed under the GNU General Public License, version 3.",
        "this work is licensed under the GNU General Public License version 2", "Some rights reserved.", "My driving licence was lost in the public garden.",
        "no notice here", "Released  under the MIT license", "Copyright 2020 X. All rights reserved.",
    ]
    rows = [(1, "\n".join(lines), 3), (None, None, 1), (2, "", 1), (3, lines[0], 1), (3, lines[0], 1)]
    out = license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string, license_id int")).collect()
    got = {r.block: r.license_id for r in out}
    assert got[lines[0]] == "CC-BY-NC-4.0" and got[lines[1]] == "CC-BY-4.0" and got[lines[2]] == "GPL-3.0" and got[lines[3]] == "GPL-2.0"
    assert got[lines[4]] is None and got[lines[5]] is None and lines[6] not in got and got[lines[7]] == "MIT"
    assert got[lines[8]] == "LicenseRef-All-Rights-Reserved"
    assert sum(r.doc_id == 3 for r in out) == 2


def test_license_ranks_equal_plain_compression():
    import zstandard as z

    own = license_scan.scanner(license_scan.TEMPLATES)
    block = "Licensed under the Apache License, Version 2.0."
    small = [len(z.ZstdCompressor(level=license_scan.LEVEL, dict_data=z.ZstdCompressionDict(t.encode(), dict_type=z.DICT_TYPE_RAWCONTENT), write_dict_id=False, write_content_size=False).compress(block.encode())) for _, t in license_scan.TEMPLATES]
    assert license_scan.TEMPLATES[int(np.argmin(small))][0] == own.scan(block)[0] == "Apache-2.0"


def test_quality_on_held_out_rows(spark):
    rows = {r.doc_id: r for r in queries.REGISTRY["op10_quality"](spark, SF01).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF01}/labels.parquet").collect()}
    held = [d for d in rows if zlib.crc32(str(d).encode()) % 5 == 0]
    assert all(r.held_out == (d in set(held)) for d, r in rows.items())
    tested = [d for d in held if d in labels]
    assert np.mean([rows[d].predicted == labels[d] for d in tested]) >= 0.95
    good = [d for d in tested if labels[d] == 1]
    assert np.mean([rows[d].predicted == 1 for d in good]) >= 0.98


def test_quality_odd_rows_and_labels(spark):
    docs = _docs(spark, ODD)
    nothing = quality.fit(docs, spark.createDataFrame([(1, None), (None, 1), (99, 1), (2, 7)], "doc_id long, quality int"))
    assert {r.score_1 for r in quality.score(docs, nothing).collect() if not (r.text or "").strip()} == {0.5}
    labels = spark.createDataFrame([(i, i % 2) for i in range(10)], "doc_id long, quality int")
    a, b = quality.fit(docs, labels), quality.fit(docs.repartition(5), labels.repartition(3))
    assert np.array_equal(a.vectors, b.vectors)  # the same fit however the rows are dealt
    out = quality.score(docs, a).collect()
    assert len(out) == docs.count() and all(0 <= r.score_1 <= 1 for r in out)
    assert quality.drop_rejected(docs, a, threshold=0.0).columns == docs.columns
    assert quality.score(docs.limit(0), a).count() == 0


def test_quality_margin_is_the_models_own_score():
    model = quality.sgd([(*quality.document_features(t), y) for t, y in (("a b c", 1), ("d!! d!! d!!", 0))] * 20)
    text = "a d!! d!! zz"
    ids, share = quality.document_features(text)
    logits = model.weights @ (share @ model.vectors[ids]) + model.bias
    p = np.exp(logits) / np.exp(logits).sum()
    assert quality.Scorer(model.margins(), model.offset()).scores([text])[0] == pytest.approx(p[1], abs=1e-5)
