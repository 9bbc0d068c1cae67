"""Headers, titles, tags and whole texts of licenses."""

from pathlib import Path

from inkwright.llm import licenses
from inkwright.llm.licenses import notices
from inkwright.llm.queries import op10_license_scan

GPL = """# {0} is free software{1} you can redistribute it and/or modify
# it under the terms of the GNU {2}General Public License as published by
# the Free Software Foundation{3} either version {4} of the License, or
# (at your option) any later version."""
MPL = """ * This Source Code Form is subject to the terms of the Mozilla Public
 * License, v. 2.0. If a copy of the MPL was not distributed with this
 * file, You can obtain one at https://mozilla.org/MPL/2.0/."""
CODE = "\nimport os\n\ndef run(path):\n    return [line.strip() for line in open(path) if line]\n" * 3
LONG = "Words about rivers and stones go on, and so does this text, released under the MIT License, goes on past the hills and further down to the sea"
CASES = [
    ("// SPDX-License-Identifier: MIT" + CODE, "MIT"), ("SPDX-License-Identifier: Apache-2.0", "Apache-2.0"), ("SPDX-License-Identifier: BSD-3-Clause", "BSD-3-Clause"),
    ("/* SPDX-License-Identifier: GPL-2.0-or-later */", "GPL-2.0"), ("SPDX-License-Identifier: (MIT OR Apache-2.0)", "MIT OR Apache-2.0"),
    (GPL.format("This program", ":", "", ",", "3") + CODE, "GPL-3.0"), (GPL.format("This program", ";", "", ";", "2") + CODE, "GPL-2.0"),
    (GPL.format("This library", ";", "Lesser ", ";", "2.1") + CODE, "LGPL-2.1"), (GPL.format("This program", ":", "Affero ", ",", "3") + CODE, "AGPL-3.0"),
    (MPL + CODE, "MPL-2.0"), (LONG, "MIT"), ("GNU GENERAL PUBLIC LICENSE\n   Version 2, June 1991", "GPL-2.0"), ("GNU GENERAL PUBLIC LICENSE\n  Version 3, 29 June 2007", "GPL-3.0"),
    ("GNU GENERAL PUBLIC LICENSE", None), ("The driver showed a licence to the officer, who gave it back.", None), ("Copyright 2020 A. Writer. All rights reserved.", None),
    ("The redistribution of wealth under the crown was much debated.", None), ("We thank the Mozilla people; the public came by car.", None),
]


def test_headers_titles_and_tags(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "doc_id long, text string")
    got = {r.doc_id: r.license for r in notices(df).collect()}
    assert {t: got.get(i) for i, (t, _) in enumerate(CASES)} == dict(CASES)


def test_whole_texts(spark):
    texts = {f.stem: f.read_text() for f in (Path(licenses.__file__).parent / "license_texts").glob("*.txt")}
    assert len(texts) >= 19
    rows = [(name, f"Copyright (c) 2021 Some Person and others\n\n{t}") for name, t in texts.items()]
    rows += [("code", CODE * 5 + MPL), ("notice", "Released under the MIT License."), ("prose", LONG * 3)]
    got = {r.doc_id: (r.license, r.covered) for r in notices(spark.createDataFrame(rows, "doc_id string, text string")).collect()}
    assert {n: got[n] for n in texts} == {n: (n, True) for n in texts}
    assert got["notice"] == ("MIT", True) and got["code"] == ("MPL-2.0", False) and got["prose"] == ("MIT", False)


def test_op10_files_at_several_levels(spark, tmp_path):
    """Each row's own license is known; inheritance by walking up from each path."""
    full = {f.stem: "Copyright (c) 2020 Someone\n\n" + f.read_text() for f in (Path(licenses.__file__).parent / "license_texts").glob("*.txt")}
    rows = [
        (1, None, None, full["Apache-2.0"], "Apache-2.0", True), (2, "a", None, full["MIT"], "MIT", True), (3, "a", "en", CODE, None, False), (4, "a/b", "en", full["GPL-2.0"], "GPL-2.0", True),
        (5, "a/b", "en", "no notice", None, False), (6, "a/b", "fr", CODE, None, False), (7, "q", "en", None, None, False), (8, "q", "fr", "Released under the MIT License.\n" + CODE * 3, "MIT", False),
        (9, "q", "fr", CODE, None, False), (10, "z/y/x", "de", full["GPL-3.0"], "GPL-3.0", True), (11, "z/y/x/w", "de", "plain", None, False), (12, "z/y/x/de/v", "de", "plain", None, False), (13, "c", "en", "Some words here. Released under the MIT License. And a few more of them, about rivers and stones.", "MIT", False),
        (14, "c", "en", "plain", None, False),
    ]
    spark.createDataFrame([r[:4] for r in rows], "doc_id long, source string, lang string, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    home = {r[0]: "/".join(["", *(x for x in r[1:3] if x is not None)]) for r in rows}
    given = {home[r[0]]: r[4] for r in rows if r[5]}
    want = {}
    for i, _, _, _, name, is_file in rows:
        d = home[i]
        while name is None and d not in given:
            d = d.rpartition("/")[0]
        want[i] = (name, "file" if is_file else "header", None) if name else (given[d], "inherited", d)
    got = {r.doc_id: (r.license, r.source, r.inherited_from) for r in op10_license_scan(spark, str(tmp_path)).collect()}
    assert got == want
    assert {"", "/a", "/a/b/en", "/z/y/x/de"} == {x[2] for x in got.values() if x[1] == "inherited"}
