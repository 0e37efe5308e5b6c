"""Plain in-memory versions of the operators, for comparison."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import xxhash

WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


def least_reachable(nodes, links):
    up = {n: n for n in nodes}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        x, y = sorted((top(a), top(b)))
        up[y] = x
    return {n: top(n) for n in nodes}


def simhash(text, length=3):
    words = WORDS.findall((text or "").encode().lower())
    grams = [b" ".join(words[i : i + length]) for i in range(max(1, len(words) - length + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes)) if hashes else 0


def line_runs(docs, min_words=50):
    """docs: list of (id, text) in order. Deleted line numbers of each document: every run of lines with
    enough words whose equal occurred earlier."""
    seen, gone = set(), [set() for _ in docs]
    for k, (_, text) in enumerate(docs):
        lines = [] if text is None else text.split("\n")
        sizes = [len(WORDS.findall(x.encode())) for x in lines]
        live = [i for i, n in enumerate(sizes) if n]
        for a, i in enumerate(live):
            own = []
            for b in range(a, len(live)):
                if sum(sizes[j] for j in live[a : b + 1]) >= min_words:
                    run = tuple(lines[j] for j in live[a : b + 1])
                    if run in seen:
                        gone[k].update(range(i, live[b] + 1))
                    own.append(run)
            seen.update(own)
    return gone


def best_window(text, item, length=5):
    doc, words = ([w for w in WORDS.findall(t.encode().lower())] for t in (text, item))
    n, g = len(words), min(length, len(words))
    cut = lambda w: Counter(tuple(w[i : i + g]) for i in range(len(w) - g + 1))
    own, best = cut(words), 0.0
    for s in range(len(doc) - n + 1):
        win = cut(doc[s : s + n])
        both = sum((win & own).values())
        best = max(best, both / (win.total() + own.total() - both))
    return best


def cosine_links(rows, threshold=0.98):
    """rows: (id, vector, label). Links between usable rows with equal labels."""
    out = []
    usable = [
        (k, np.array(v, float) / np.linalg.norm(np.array(v, float)), lab)
        for k, (_, v, lab) in enumerate(rows)
        if lab is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)
    ]
    for a, (i, x, p) in enumerate(usable):
        for j, y, q in usable[a + 1 :]:
            if p == q and len(x) == len(y) and float(x @ y) >= threshold:
                out.append((i, j))
    return out
