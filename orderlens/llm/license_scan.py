"""License scan by conditional compression.

A block is a line. Lines that name a license, copyright or permission are candidates (documents
without such a pattern are dropped in Spark; all other lines hold no notice). Each candidate is compressed alone and with each
template as zstandard raw dictionary; the more of the block a template already holds, the
smaller the result. Templates are ranked by the reduction (size alone less size with the
template, over size alone; ties by name). All are, by rank, confirmed by exact wording: the words of template and block are aligned, and a notice is
confirmed if no word that tells licenses apart (a name, a clause or a version number) differs
and the other words that are missing or put in are at most ``MAX_DIFFERENT`` of the template's. A negation in
the clause before the notice ("Not licensed under ...") or a "not" in the clause behind it rules it out.
The first confirmed template by rank is the block's license; ``license_ids`` holds all confirmed
ones by rank (none is left out: a template is skipped only if words that the block lacks altogether
already rule it out).

A notice may be wrapped over lines. So a run of neighbouring non-blank lines that holds a cue is a
block too, read word by word across its line ends. It gives a row of its own (its first line's
number, its lines joined by line feeds) if it confirms a license that none of its lines confirms
alone; ``license_ids`` of that row are those licenses only. Cues may be wrapped as well.

Blocks are of any length. Results of equal lines are kept by the worker, so a
notice in a third of all documents is compressed a few times only; nothing is shuffled.

Defined results: null and empty texts have no blocks; a candidate that confirms no template has
license_id null, no license_ids, and keeps its best template and differences; repeated rows give rows each; ids
may be null; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from difflib import SequenceMatcher
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from orderlens.llm.common import slices

CUES = r"(?i)licen[cs]|copyright|\(c\)|©|rights reserved|public domain|creative commons|spdx|permission is (hereby )?granted|redistribution"
WRAPPED_CUES = CUES.replace(" ", r"\s+")
MAX_DIFFERENT = 0.25
CACHE_BLOCKS = 50_000
LEVEL = 3

#: Short notices by SPDX id (custom names where SPDX has none). A parameter of ``scan``.
TEMPLATES = (
    ("LicenseRef-All-Rights-Reserved", "All rights reserved."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("GPL-3.0", "Released under the GNU GPL v3."),
    ("GPL-2.0", "Released under the GNU GPL v2."),
    ("GPL-3.0", "Licensed under GPLv3 or later."),
    ("GPL-2.0", "Licensed under GPLv2 or later."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
        "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    (
        "GPL-2.0",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
        "by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ),
    (
        "LicenseRef-BSD",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    ),
    (
        "BSD-3-Clause",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
        "software without specific prior written permission.",
    ),
    ("CC-BY-4.0", "Creative Commons Attribution 4.0 International License"),
    ("CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("CC-BY-ND-4.0", "Creative Commons Attribution-NoDerivatives 4.0 International License"),
    ("CC-BY-NC-SA-4.0", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"),
    ("CC-BY-NC-ND-4.0", "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License"),
)
#: Ids that also get a template for their SPDX tag.
TAGGED = (
    "MIT Apache-2.0 BSD-2-Clause BSD-3-Clause GPL-2.0 GPL-3.0 LGPL-3.0 AGPL-3.0 MPL-2.0 CC-BY-4.0 CC-BY-SA-4.0 CC-BY-NC-4.0 CC-BY-ND-4.0 "
    "CC-BY-NC-SA-4.0 CC-BY-NC-ND-4.0 CC0-1.0 Unlicense"
).split()
TEMPLATES += tuple((name, f"SPDX-License-Identifier: {name}") for name in TAGGED)
#: Words that tell licenses apart, beside numbers.
TELLING = frozenset(
    "apache mit bsd gnu gpl lgpl agpl lesser affero general public mozilla mpl cc cc0 by sa nc nd clause all rights reserved domain unencumbered "
    "not no except attribution sharealike noncommercial noderivatives unlicense redistribution".split()
)
#: Words that turn a notice round, before it in its clause.
NEGATIONS = frozenset("not no never neither nor without isn aren wasn weren doesn don cannot except unless nicht kein keine pas non sin".split())
_OTHER_NAME = re.compile(r"-(?!only\b|or\b)[^\W_]", re.I)  # "MIT-0" is not "MIT", but "GPL-3.0-only" tells of GPL-3.0
_CLAUSE = re.compile(r"[.,;:!?()\n](?=\s|$)")
_WORD = re.compile(r"[^\W_]+", re.UNICODE)
_CUE, _WRAPPED_CUE = re.compile(CUES, re.ASCII), re.compile(WRAPPED_CUES, re.ASCII)  # as Java reads them


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def differences(template: list[str], block: list[str]) -> tuple[list[str], list[str]]:
    """Template words the block lacks, and block words put in between the first and last match."""
    pairs = [m for m in SequenceMatcher(None, template, block, autojunk=False).get_matching_blocks() if m.size]
    if not pairs:
        return list(template), []
    held = {i for m in pairs for i in range(m.a, m.a + m.size)}
    used = {j for m in pairs for j in range(m.b, m.b + m.size)}
    low, high = pairs[0].b, pairs[-1].b + pairs[-1].size
    return [w for i, w in enumerate(template) if i not in held], [block[j] for j in range(low, high) if j not in used]


def agrees(template: list[str], different: list[str]) -> bool:
    """Whether a notice may differ from the template in these words."""
    return len(different) <= MAX_DIFFERENT * len(template) and not any(w in TELLING or any(c.isdigit() for c in w) for w in different)


def negated(template: list[str], block: str) -> bool:
    """Whether the clause before the place that the template matches holds a negation, the rest of the
    clause behind it a "not", or the name goes on with a hyphen."""
    spans = [m.span() for m in _WORD.finditer(block.lower())]
    words = [block.lower()[a:b] for a, b in spans]
    pairs = [m for m in SequenceMatcher(None, template, words, autojunk=False).get_matching_blocks() if m.size]
    if not pairs or len(block.lower()) != len(block):  # a letter that changes its length in lower case: places don't fit
        return False
    start, stop = spans[pairs[0].b][0], spans[pairs[-1].b + pairs[-1].size - 1][1]
    ends = [m.end() for m in _CLAUSE.finditer(block, 0, start)]
    after = _CLAUSE.search(block, stop)
    before = words_of(block[ends[-1] if ends else 0 : start])
    if _OTHER_NAME.match(block, stop):
        return True
    return any(w in NEGATIONS for w in before) or "not" in words_of(block[stop : after.start() if after else len(block)])


class Scanner:
    def __init__(self, templates: tuple[tuple[str, str], ...]):
        self.templates = [(name, words_of(text)) for name, text in templates]
        self.alone = zstandard.ZstdCompressor(level=LEVEL, write_checksum=False, write_content_size=False)
        raw = [zstandard.ZstdCompressionDict(text.encode("utf-8"), dict_type=zstandard.DICT_TYPE_RAWCONTENT) for _, text in templates]
        self.given = [zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_checksum=False, write_content_size=False, write_dict_id=False) for d in raw]
        self.known: dict[str, tuple] = {}

    def _confirmed(self, block: str) -> dict[int, tuple[int, int]]:
        """Words missing and put in of each template that the block's wording confirms."""
        words = words_of(block)
        held, found = set(words), {}
        for k, (_, wanted) in enumerate(self.templates):
            if agrees(wanted, [w for w in wanted if w not in held]):
                lost, put = differences(wanted, words)
                if agrees(wanted, lost + put) and not negated(wanted, block):
                    found[k] = len(lost), len(put)
        return found

    def _ranked(self, block: str, among: Iterable[int]) -> list[tuple[float, int]]:
        data = block.encode("utf-8")
        size = len(self.alone.compress(data))
        ranked = [((size - len(self.given[k].compress(data))) / size, k) for k in among]
        return sorted(ranked, key=lambda x: (-x[0], self.templates[x[1]][0], x[1]))

    def _scan(self, block: str) -> tuple:
        words = words_of(block)
        found, ranked = self._confirmed(block), self._ranked(block, range(len(self.templates)))
        names = list(dict.fromkeys(self.templates[k][0] for _, k in ranked if k in found))
        for reduction, k in ranked:
            if k in found:
                return (names[0], names, names[0], reduction, *found[k])
        reduction, k = ranked[0]
        lost, put = differences(self.templates[k][1], words)
        return (None, [], self.templates[k][0], reduction, len(lost), len(put))

    def scan_run(self, block: str, known: set[str]) -> tuple | None:
        """As ``scan``, for the licenses of a run of lines that are not ``known``; None if there are none."""
        found = {k: n for k, n in self._confirmed(block).items() if self.templates[k][0] not in known}
        if not found:
            return None
        ranked = self._ranked(block, found)
        names = list(dict.fromkeys(self.templates[k][0] for _, k in ranked))
        reduction, k = ranked[0]
        return (names[0], names, names[0], reduction, *found[k])

    def blocks(self, text: str) -> Iterator[tuple]:
        """(line number, block, what ``scan`` returns) of every candidate line, and of runs with a license of their own."""
        at, lines = 0, text.split("\n")
        for blank, group in groupby(lines, key=lambda x: not x.strip()):
            run, known = list(group), set()
            for k, line in enumerate(run):
                if not blank and _CUE.search(line):
                    found = self.scan(line)
                    known.update(found[1])
                    yield (at + k, line, *found)
            if not blank and len(run) > 1 and _WRAPPED_CUE.search(whole := "\n".join(run)):
                found = self.scan_run(whole, known)
                if found:
                    yield (at, whole, *found)
            at += len(run)

    def scan(self, block: str) -> tuple:
        """(first confirmed license or null, all confirmed, best template, reduction, words missing, words put in)."""
        found = self.known.get(block)
        if found is None:
            if len(self.known) >= CACHE_BLOCKS:
                self.known.clear()
            found = self.known[block] = self._scan(block)
        return found


@lru_cache(maxsize=2)
def scanner(templates: tuple[tuple[str, str], ...]) -> Scanner:
    return Scanner(templates)


def scan(docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, line_no, block, license_id, license_ids, template_id, reduction, n_missing, n_added of each candidate
    line, and of each run of lines that confirms a license none of them confirms alone."""
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    candidates = slim.where(F.col("text").rlike(WRAPPED_CUES))
    kind = candidates.schema["doc_id"].dataType
    names = ["doc_id", "line_no", "block", "license_id", "license_ids", "template_id", "reduction", "n_missing", "n_added"]
    types = [to_arrow_type(kind), pa.int32(), pa.string(), pa.string(), pa.list_(pa.string()), pa.string(), pa.float64(), pa.int64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = scanner(templates)
        for part in slices(batches):
            rows = [(i, *found) for i, x in zip(*(c.to_pylist() for c in part.columns), strict=True) for found in own.blocks(x)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    schema = f"doc_id {kind.simpleString()}, line_no int, block string, license_id string, license_ids array<string>, template_id string, reduction double, n_missing long, n_added long"
    return candidates.mapInArrow(run, schema)
