import re
from math import sqrt

import duckdb

from inkwright.llm.licenses import CUE, LEAST, _templates, _weights, scan
from inkwright.llm.queries import op10_license_scan

TOKEN = re.compile(r"[a-z0-9]+(?:\.[0-9]+)?")


def notice(text):
    idf, other = _weights()
    best = None
    for s in re.split(r"\n|(?<=[.])\s+", text or "", flags=re.A):
        if not re.search(CUE, s):
            continue
        v = {}
        for w in TOKEN.findall(s.lower()):
            v[w] = v.get(w, 0.0) + idf.get(w, other)
        norm = sqrt(sum(x * x for x in v.values()))
        for i, name, t in _templates():
            score = round(sum(x * t.get(w, 0.0) for w, x in v.items()) / norm, 9) if norm else 0
            if score >= LEAST and (best is None or (score, -i) > best[:2]):
                best = (score, -i, name)
    return best


def brute(rows, is_file):
    own = {k: notice(t) for k, _, t in rows}
    given = {}
    for k, p, t in rows:
        if p is not None and is_file(p, t) and own[k]:
            d = p.rpartition("/")[0]
            given.setdefault(d, []).append((-own[k][0], p, own[k][2]))
    out = {}
    for k, p, t in rows:
        if own[k]:
            out[k] = (own[k][2], "file" if is_file(p or "", t) else "header", None)
            continue
        out[k] = (None, None, None)
        d = p.rpartition("/")[0] if p is not None else None
        while d is not None:
            if d in given:
                out[k] = (min(given[d])[2], "inherited", d)
                break
            d = None if d == "" else d.rpartition("/")[0]
    return out


def test_inheritance(spark):
    mit, gpl = "Some words here. Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
    rows = [
        (1, "/LICENSE", mit), (2, "/a/b/x.py", "code"), (3, "/a/LICENSE.txt", gpl), (4, "/a/y.py", None), (5, "z.py", "no notice"), (6, "/q/w.py", gpl),
        (7, None, "text"), (8, None, mit), (9, "/a/b/c/d/e.py", "Licensed to nobody in particular at all, friends"), (10, "/a/COPYING", "Licensed under CC BY-NC 4.0."),
        (11, "", "x"), (12, "/ab/f", "x" * 200_000), (13, "/a/b/LICENSE", "nothing"),
    ]
    df = spark.createDataFrame([(*r, "?") for r in rows], "doc_id long, path string, text string, license string")
    got = {r.doc_id: (r.license, r.source, r.inherited_from) for r in scan(df).collect()}
    named = re.compile(r"(?i)(?:^|/)(?:licen[sc]e|copying|unlicense|notice)[^/]*$")
    assert got == brute(rows, lambda p, t: bool(named.search(p)))
    assert got[2] == ("GPL-3.0", "inherited", "/a") or got[2] == ("CC-BY-NC-4.0", "inherited", "/a")
    assert got[12] == ("MIT", "inherited", "")
    assert scan(df.limit(0)).collect() == []
    assert len(scan(df.union(df)).collect()) == 2 * len(rows)


def test_op10_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = duckdb.connect().sql(f"select doc_id, '/' || source || '/' || lang || '/' || doc_id, text from '{sf}/documents.parquet'").fetchall()
    got = {r.doc_id: (r.license, r.source, r.inherited_from) for r in op10_license_scan(spark, sf).collect()}
    assert got == brute(rows, lambda p, t: len(t) <= 480 and len(re.split(r"[ \t\n\r\f\v]+", t)) <= 40)
    assert sum(x[1] == "header" for x in got.values()) >= 3
