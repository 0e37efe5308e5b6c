"""Main text of web pages by line-block distribution.

Markup is stripped to a sequence of lines, one for each block of text (paragraph, heading, list
item, cell). A line's length is that of its text outside links; lines inside boilerplate
(menus, headers, footers, sidebars, notices, adverts, forms, comments, recognised by element,
role, class or id) have length 0. Text in ``article`` or ``main`` weighs ``ELEMENT_WEIGHT`` times: if
it then is as long as the longest run outside, lines outside have length 0 too, and the element is
the region; otherwise (a teaser card beside the body) the distribution decides alone. The lengths are summed over sliding windows of ``WINDOW`` lines.
Where the sum rises from zero is a surge point, where it falls back to zero a dive point; the
text between a surge and its dive is kept if some window in it reaches the threshold (any text
in an article or main element, ``SURGE_CHARS`` characters elsewhere); if none reaches it, the run
with the largest sum (the first of equal ones) is kept. Short lines inside a run, and those that are
links only, stay with it; nothing else is dropped or cut.

Character references are decoded, white space inside a block becomes one space, blocks are
trimmed and joined by one line feed.

A form is boilerplate, unless it holds an article or main element or most of the page's text; then its
controls and labels are. A head ends at its first text or element that can't stand in one.

Defined results: a null or empty page, or one without text, gives an empty text; broken markup
(unclosed elements, tags, comments or quotes) is read leniently; a page of any length or depth is read
whole in one pass, in time proportional to its length; repeated rows each give a row; ids may be null; an empty table gives an empty table;
other columns of the input are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import slices

WINDOW = 3
SURGE_CHARS = 60
ELEMENT_WEIGHT = 4  # of text in an article or main element against a run outside

RAW = "script|style|noscript|template|textarea|iframe|noframes"  # their content is no markup
MARKUP = re.compile(rf"<(?:(?P<comment>!--)|(?P<raw>{RAW})\b|(?P<close>/?)(?P<name>[a-z][a-z0-9:-]*+)|[!?/])", re.I)
STOP = re.compile(r"[>\"']")
COMMENT_END = re.compile(r"--!?>")
RAW_END = {name: re.compile(rf"</{name}\s*[^>]*>", re.I) for name in RAW.split("|")}
MISSES = 8  # tags without an end, after which quotes are no longer minded
ATTRIBUTE = re.compile(r"""\b(class|id|role|aria-hidden|hidden|style)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark meter output q rp rt ruby s "
    "samp small span strike strong sub sup time tt u var wbr".split()
)
#: Elements that are boilerplate by their kind.
CHROME = frozenset("nav aside form footer header menu dialog button head title fieldset svg math object select canvas audio video".split())
ROLES = frozenset("navigation banner contentinfo complementary search menu menubar dialog alert alertdialog form toolbar".split())
#: Parts of class and id names that mark boilerplate, wherever they stand.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo cookie cookies consent gdpr popup modal "
    "newsletter subscribe signup nav navbar navigation menu breadcrumb breadcrumbs comment comments disqus respond reply replies "
    "share sharing related recommended recommendations pagination pager login footer skip copyright".split()
)
#: Parts that mark boilerplate unless another part says that the element holds the content.
WEAK = frozenset("sidebar side widget widgets banner notice notices alert header masthead toolbar social search tags meta toc".split())
CONTENT = frozenset("content article main post entry body text story page container wrapper layout with has no".split())
WHOLE = frozenset("html body article main".split())
#: Elements that may stand in a head; any other start tag, and text, ends it.
HEAD = frozenset("head title meta link base".split())
#: Parts of a form that are no text of the page, even if the form holds the page.
CONTROLS = frozenset("label legend option optgroup datalist".split())
FORM_CHARS = 200  # a form with more than half of the page's text, and so much at least, holds the page
#: Parts that mark even an article element as boilerplate.
READERS = frozenset("comment comments reply respond disqus".split())


def _boilerplate(name: str, attrs: str) -> bool:
    if name in CHROME:
        return True
    if not attrs.strip():
        return False
    if name in WHOLE:
        found = {p.lower() for key, value in ATTRIBUTE.findall(attrs) if key.lower() in ("class", "id") for p in PART.findall(value)}
        return name == "article" and bool(found & READERS)
    for key, value in ATTRIBUTE.findall(attrs):
        key, value = key.lower(), value.strip("\"'")
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            return True
        if key == "role" and value.lower() in ROLES:
            return True
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True
        if key in ("class", "id"):
            parts = {p.lower() for p in PART.findall(value)}
            if parts & MARKS or parts & WEAK and not parts & CONTENT:
                return True
    return False


class _Tags:
    """The markup of a page, found in one pass from left to right. What was looked for in vain (a closing
    quote, the end of a tag) is not looked for again, so broken markup takes no longer."""

    def __init__(self, page: str):
        self.page, self.misses = page, 0
        self.gone: dict[str, int] = {}  # a character and a place behind which it does not occur

    def _find(self, what: str, at: int) -> int:
        if at >= self.gone.get(what, len(self.page)):
            return -1
        found = self.page.find(what, at)
        if found < 0:
            self.gone[what] = at
        return found

    def _tag_end(self, at: int) -> int:
        """The place of the bracket that ends a tag; brackets in quotes don't."""
        if self.misses >= MISSES:
            return self._find(">", at)
        while (m := STOP.search(self.page, at)) is not None:
            if m[0] == ">":
                return m.start()
            closing = self._find(m[0], m.end())
            at = closing + 1 if closing >= 0 else m.end()
        self.misses += 1
        return -1

    def __iter__(self) -> Iterator[tuple[int, int, str | None, bool, str]]:
        """(begin, end, name or None, closing, attributes); a raw element is one piece without a name but "raw"."""
        page, at = self.page, 0
        while (m := MARKUP.search(page, at)) is not None:
            begin, at = m.span()
            if m["comment"]:
                # "<!-->" is a whole comment, too
                end = COMMENT_END.search(page, at)
                at = end.end() if end else len(page)
                yield begin, at, None, False, ""
                continue
            if not m["raw"] and m["name"] is None:
                end = self._find(">", at)
                if end > at:
                    at = end + 1
                    yield begin, at, None, False, ""
                continue
            end = self._tag_end(at)
            if end < 0:
                continue
            if m["raw"]:
                close = RAW_END[m["raw"].lower()].search(page, end)
                at = close.end() if close else len(page)
                yield begin, at, None, False, "raw"
            else:
                yield begin, end + 1, m["name"].lower(), bool(m["close"]), page[at:end]
                at = end + 1


def lines_of(page: str) -> list[tuple[str, int, bool, bool]]:
    """(text, length for the distribution, inside article or main, boilerplate) of each block of text."""
    lines: list[list] = []  # text, characters outside links, inside, boilerplate, form
    text: list[str] = []
    stack: list[tuple[str, bool]] = []  # open block elements, and inline ones that are boilerplate
    places: dict[str, list[int]] = {}  # where a name stands in the stack
    forms: list[bool] = []  # whether each form holds an article or main element
    hidden = inside = links = linked = open_forms = 0

    def cut() -> None:
        nonlocal linked
        if text:
            line = " ".join(unescape("".join(text)).split())
            if line:
                lines.append([line, max(0, len(line) - linked), inside > 0, hidden > 0, len(forms) - 1 if open_forms else -1])
            text.clear()
        linked = 0

    def push(name: str, boiler: bool) -> None:
        nonlocal hidden, inside, open_forms
        places.setdefault(name, []).append(len(stack))
        stack.append((name, boiler))
        hidden += boiler
        if name in ("article", "main"):
            inside += 1
            if open_forms:
                forms[-1] = True
        elif name == "form":
            if not open_forms:
                forms.append(False)
            open_forms += 1

    def pop(to: int) -> None:
        nonlocal hidden, inside, open_forms
        while len(stack) > to:
            n, boiler = stack.pop()
            places[n].pop()
            hidden -= boiler
            inside -= n in ("article", "main")
            open_forms -= n == "form"

    def leave_head() -> None:
        if places.get("head"):
            cut()
            pop(places["head"][-1])

    def add(piece: str) -> None:
        nonlocal linked
        if piece:
            if stack and stack[-1][0] == "head" and piece.strip():
                leave_head()
            text.append(piece)
            if links:
                linked += len(piece.strip())

    at = 0
    for begin, end, name, close, attrs in _Tags(page):
        add(page[at:begin])
        at = end
        if name is None:
            if attrs:
                add(" ")
            continue
        if not close and name not in HEAD:
            leave_head()
        if name == "a":
            links = 0 if close else 1
        if name == "br":
            add(" ")
        if name in INLINE:
            if not close and name not in VOID and (_boilerplate(name, attrs) or open_forms and name in CONTROLS):
                cut()
                push(name, True)
            elif close and places.get(name):
                cut()
                pop(places[name][-1])
            continue
        cut()
        links = 0
        if close:
            if places.get(name):
                pop(places[name][-1])
        elif name not in VOID and not attrs.rstrip().endswith("/"):
            if stack and (stack[-1][0] == "p" or stack[-1][0] == name == "li"):
                pop(len(stack) - 1)
            boiler = name != "form" and _boilerplate(name, attrs) and not (name == "header" and inside)
            push(name, boiler or open_forms > 0 and name in CONTROLS)
    add(page[at:])
    cut()
    # a form is boilerplate unless it holds the page
    size = [0] * len(forms)
    for line, _, _, boiler, form in lines:
        if form >= 0 and not boiler:
            size[form] += len(line)
    total = sum(len(line) for line, _, _, boiler, _ in lines if not boiler)
    holds = [has or n >= FORM_CHARS and 2 * n > total for has, n in zip(forms, size, strict=True)]
    out = []
    for line, n, within, boiler, form in lines:
        boiler = boiler or form >= 0 and not holds[form]
        out.append((line, 0 if boiler else n, within and not boiler, boiler))
    return out


def _runs(lengths: list[int], window: int) -> list[tuple[int, int, int]]:
    """(largest window sum, first line with length, line behind the last) between each surge and its dive."""
    sums = [sum(lengths[i : i + window]) for i in range(len(lengths))]
    runs: list[tuple[int, int, int]] = []
    start = 0
    while start < len(lengths):
        if not sums[start]:
            start += 1
            continue
        stop = start
        while stop < len(lengths) and sums[stop]:
            stop += 1
        # a window that begins before the dive still reaches over the lines up to it, one before the surge over lines without length
        first = next(i for i in range(start, stop) if lengths[i])
        runs.append((max(sums[start:stop]), first, stop))
        start = stop
    return runs


def main_text(page: str | None, window: int = WINDOW, surge: int = SURGE_CHARS) -> str:
    """Text between surge and dive points of the page's line-block distribution."""
    lines = lines_of(page) if page else []
    marked = any(inside for _, _, inside, _ in lines)
    if marked:
        outside = [0 if inside else n for _, n, inside, _ in lines]
        most = max((sum(outside[first:stop]) for _, first, stop in _runs(outside, window)), default=0)
        marked = ELEMENT_WEIGHT * sum(n for _, n, inside, _ in lines if inside) >= most
    runs = _runs([(max(n, 1) if inside else 0) if marked else n for _, n, inside, _ in lines], window)
    kept = [r for r in runs if marked or r[0] >= surge] or sorted(runs, key=lambda r: -r[0])[:1]
    inner = lambda i: lines[i][2] if marked else not lines[i][3]
    return "\n".join(lines[i][0] for _, first, stop in kept for i in range(first, stop) if inner(i))


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", keep: tuple[str, ...] = ("url",)) -> DataFrame:
    """page_id, the ``keep`` columns, text and n_chars (code points) of every row of ``pages``."""
    slim = pages.select(F.col(id_col).alias("page_id"), F.col(html_col).cast("string").alias("html"), *keep)
    cols = ["page_id", *keep]
    out = ", ".join(f"`{c}` {slim.schema[c].dataType.simpleString()}" for c in cols)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            texts = [main_text(p) for p in part.column(1).to_pylist()]
            rest = [part.column(i) for i in range(part.num_columns) if i != 1]
            values = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays([*rest, *values], names=[*cols, "text", "n_chars"])

    return slim.mapInArrow(run, f"{out}, text string, n_chars long")
