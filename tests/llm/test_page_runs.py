"""Page text: what a run keeps, and which region of a page holds it."""

from __future__ import annotations

import time

import pytest

from orderlens.llm import html_extract

LONG = " ".join(["text"] * 20)


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (f"<div><p>{LONG}</p><h2><a href=/s>Linked heading</a></h2><div class=ad>Buy</div><p>{LONG}</p></div>", f"{LONG}\nLinked heading\n{LONG}"),
        (f"<div><a href=/>Home</a></div><div><p>{LONG}</p></div><div><a href=/n>Next</a></div>", LONG),
        ("<div class=menu>x</div><div><p>A short note.</p></div>", "A short note."),
        ("<p>Tiny</p><ul class=menu><li>a<li>b<li>c</ul><p>A longer line</p><ul class=menu><li>a<li>b<li>c</ul><p>Other</p>", "A longer line"),
        ("<nav>only a menu</nav>", ""),
    ],
)
def test_runs_of_pages_without_article(page, text):
    assert html_extract.main_text(page) == text


def test_distribution_chooses_between_element_and_body():
    body, teaser = "".join(f"<p>{LONG}</p>" for _ in range(12)), "<p>Read this too</p>"
    menu = "<ul class=menu><li>a<li>b<li>c</ul>"
    assert html_extract.main_text(f"<div>{body}</div>{menu}<article>{teaser}</article>") == "\n".join([LONG] * 12)
    assert html_extract.main_text(f"<div><p>{LONG}</p></div>{menu}<article><p>{LONG[:40]}</p></article>") == LONG[:40].strip()
    assert html_extract.main_text(f"<p>{LONG}</p><article>{body}</article>") == "\n".join([LONG] * 12)


BODY = "A long text with many words in it. " * 10


def test_omitted_head_end_and_wrapping_forms():
    text = BODY.strip()
    assert html_extract.main_text(f"<html><head><title>t</title><body><p>{BODY}") == text
    assert html_extract.main_text(f"<html><head><title>t</title><meta name=a><p>{BODY}") == text
    assert html_extract.main_text(f"<head><title>t</title>{BODY}") == text
    form = f"<body><form action=x><label>Search</label><input><article><p>{BODY}</p></article><button>go</button></form>"
    assert html_extract.main_text(form) == text
    assert html_extract.main_text(f"<body><form><div><p>{BODY}</p></div><label>name</label><select><option>a</select></form><p>foot") .split("\n")[0] == text
    assert html_extract.main_text(f"<article><p>{BODY}</p><form><p>Write to us about this text</p></form></article>") == text
    assert html_extract.main_text(f"<p>{BODY}</p><form><p>{'word ' * 30}</p></form>") == text


def test_broken_and_deep_markup_takes_time_in_proportion():
    n = 40_000
    pages = ["<a " * n, "<div>" * n + "<b>" * n + "</i>" * n + BODY, '<a "' * n, "<a '\"" * n, "<!" * n, "<div><p>" * n, "</b>" * n, "<form>" * n]
    for page in pages:
        start = time.process_time()
        html_extract.main_text(page)
        assert time.process_time() - start < 5, page[:10]
    assert html_extract.main_text("<div>" * n + BODY) == BODY.strip()
    assert html_extract.main_text(f"<p>{BODY}</p><p>1 <2 and a <b") == BODY.strip() + "\n1 <2 and a <b"
