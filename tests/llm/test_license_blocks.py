"""License scan: notices deep in a block, several in one, and wrapped over lines."""

from __future__ import annotations

from orderlens.llm import license_scan

PROSE = (
    "The software that is described in this chapter was written for any person who wants to read a copy of the documentation, and the "
    "source code of each form is subject to review in compliance with the terms that the authors and the publisher of this work agreed "
    "on; you may not use the files except with their knowledge, since the public release is granted free of charge to the readers of the "
    "book, and version notes are associated with it. "
)


def test_notice_at_the_end_of_a_long_block_and_two_notices():
    own = license_scan.Scanner(license_scan.TEMPLATES)
    for notice, name in (("All rights reserved.", "LicenseRef-All-Rights-Reserved"), ("Licensed under the MIT License.", "MIT")):
        assert own.scan(PROSE + notice)[:2] == (name, [name])
    both = own.scan("Licensed under the MIT License. Copyright 2020 X. All rights reserved.")
    assert both[0] in both[1] and sorted(both[1]) == ["LicenseRef-All-Rights-Reserved", "MIT"]
    assert own.scan("My driving licence was lost.")[:2] == (None, [])


def test_notice_wrapped_over_lines(spark):
    mit = (
        "MIT License\n\nCopyright (c) 2020 X\n\nPermission is hereby granted, free of charge, to any person obtaining a copy\n"
        "of this software and associated documentation files (the \"Software\"), to deal\nin the Software without restriction.\n"
    )
    rows = [(1, mit), (2, "a\n\nAll rights\n  reserved.\n"), (3, "Released under the MIT License.\nplain line"), (4, "All rights\n\nreserved."), (5, None)]
    out = license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    got = {(r.doc_id, r.line_no): (r.license_id, r.license_ids, r.block) for r in out if r.block != mit.split("\n")[4]}
    run = "\n".join(mit.split("\n")[4:7])
    assert got[1, 4] == ("MIT", ["MIT"], run)
    assert [r.license_id for r in out if r.block == mit.split("\n")[4]] == [None]  # the first line alone is not enough
    assert got[2, 2] == ("LicenseRef-All-Rights-Reserved", ["LicenseRef-All-Rights-Reserved"], "All rights\n  reserved.")
    assert got[3, 0] == ("MIT", ["MIT"], "Released under the MIT License.") and [k for k in got if k[0] in (3, 4, 5)] == [(3, 0)]


def test_tags_headers_and_negations():
    own = license_scan.Scanner(license_scan.TEMPLATES)
    gpl = (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    )
    bsd = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
    for notice, name in {
        "SPDX-License-Identifier: MIT": "MIT",
        "# SPDX-License-Identifier: Apache-2.0": "Apache-2.0",
        "SPDX-License-Identifier: CC-BY-SA-4.0": "CC-BY-SA-4.0",
        "Released under the GNU GPL v3.": "GPL-3.0",
        "Licensed under GPLv2 or later.": "GPL-2.0",
        gpl: "GPL-3.0",
        gpl.replace("version 3", "version 2"): "GPL-2.0",
        bsd: "LicenseRef-BSD",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.": "CC-BY-4.0",
        "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License": "CC-BY-NC-SA-4.0",
        "This is not legal advice. Licensed under the MIT License.": "MIT",
    }.items():
        assert own.scan(notice)[:2] == (name, [name]), notice
    for notice in (
        "Not licensed under the MIT License.", "This file is not released under the MIT license", "SPDX-License-Identifier: MIT-0x", "Released under the GNU GPL v4.",
        "Licensed under the MIT License is what this text is not", "No work here is licensed under CC BY 4.0.",
    ):
        assert own.scan(notice)[:2] == (None, []), notice
    assert own.scan("Licensed under the MIT License, not the GPL.")[0] == "MIT"
