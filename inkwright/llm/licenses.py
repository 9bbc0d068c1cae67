"""License scans: TF-IDF cosine of sentences, windows and whole texts to templates, and inheritance from the nearest directory, in SQL functions alone."""

from __future__ import annotations

from functools import lru_cache
from math import log
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwright.llm.store import written

_GPL = "This {0} is free software: you can redistribute it and/or modify it under the terms of the GNU {1}General Public License as published by the Free Software Foundation, either version {2} of the License, or (at your option) any later version."
#: (SPDX id, notice). Notices, headers and titles as they stand in files; several of one license are variants; those without an id name none.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This program is free software; licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted. BSD 3-Clause License."),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0, the Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0, Creative Commons Attribution-ShareAlike."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("ISC", "Permission to use, copy, modify, and or distribute this software for any purpose with or without fee is hereby granted."),
    ("GPL-3.0", _GPL.format("program", "", "3")),
    ("GPL-2.0", _GPL.format("program", "", "2")),
    ("LGPL-3.0", _GPL.format("library", "Lesser ", "3")),
    ("LGPL-2.1", _GPL.format("library", "Lesser ", "2.1")),
    ("LGPL-2.0", _GPL.format("library", "Library ", "2")),
    ("AGPL-3.0", _GPL.format("program", "Affero ", "3")),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software"),
    ("GPL-3.0", "GNU General Public License Version 3"),
    ("GPL-2.0", "GNU General Public License Version 2"),
    ("LGPL-3.0", "GNU Lesser General Public License Version 3"),
    ("LGPL-2.1", "GNU Lesser General Public License Version 2.1"),
    ("AGPL-3.0", "GNU Affero General Public License Version 3"),
    ("Apache-2.0", "Apache License Version 2.0"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("MIT", "The MIT License (MIT)"),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("BSD-2-Clause", "BSD 2-Clause License"),
    ("ISC", "Released under the ISC License."),
    ("CC-BY-4.0", "Creative Commons Attribution 4.0 International License"),
    ("CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("CC0-1.0", "CC0 1.0 Universal"),
    ("", "GNU General Public License"),
    ("", "GNU Lesser General Public License"),
    ("", "Creative Commons License"),
)
#: What a sentence or a text must hold to be compared.
CUE = r"(?i)licen[sc]e|copyright|public\s+domain|creative\s*commons|spdx|permission\s+is\s+granted|hereby\s+granted|redistribution|under\s+the\s+(?:mit|bsd|isc)|(?<![a-z])(?:[al]?gpl|cc0|cc[ -]by)"
#: Least cosines of sentences, windows and whole texts, and by how much the best license of a sentence or window must lead.
LEAST, LEAST_WINDOW, LEAST_WHOLE, LEAD = 0.55, 0.75, 0.82, 0.01
#: Tokens in a window; a template meets windows of the size next to its own. One of ANCHORS must be in a window.
SIZES = (3, 4, 5, 6, 8, 12, 16, 22, 30, 40, 80)
ANCHORS = "license licence licensed licenses licences copyright gpl lgpl agpl mit bsd isc apache mpl mozilla gnu cc cc0 commons granted redistribution redistributions redistribute endorse domain unencumbered".split()
#: After an SPDX tag: an id or an expression of ids. The suffixes say which versions besides; the license is the same.
_SPDX, _SUFFIX = r"(?i)SPDX-License-Identifier:[ \t]*\(?([a-z0-9][a-z0-9.+-]*(?: (?:or|and|with) [a-z0-9][a-z0-9.+-]*)*)", r"(?:-only|-or-later|\+)(?= |$)"
_TOKEN = r"[a-z0-9]+(?:\.[0-9]+)?"


def _weights() -> tuple[dict[str, float], float]:
    """Inverse document frequencies over the templates, and that of a token in none."""
    import re

    held: dict[str, int] = {}
    for _, t in TEMPLATES:
        for w in set(re.findall(_TOKEN, t.lower())):
            held[w] = held.get(w, 0) + 1
    return {w: log((1 + len(TEMPLATES)) / (1 + n)) + 1 for w, n in held.items()}, log(1 + len(TEMPLATES)) + 1


def _templates() -> list[tuple[int, str, dict[str, float]]]:
    import re

    idf, _ = _weights()
    out = []
    for i, (name, t) in enumerate(TEMPLATES):
        tf: dict[str, float] = {}
        for w in re.findall(_TOKEN, t.lower()):
            tf[w] = tf.get(w, 0.0) + idf[w]
        norm = sum(x * x for x in tf.values()) ** 0.5
        out.append((i, name, {w: x / norm for w, x in tf.items()}))
    return out


@lru_cache(1)
def _texts() -> tuple[list[tuple[int, str, dict[str, float]]], dict[str, float], float]:
    """(number, SPDX id, vector) of the whole texts and of the notices, idf over them, and that of a token in none. Counts weigh 1 + log."""
    import re

    files = sorted((Path(__file__).parent / "license_texts").glob("*.txt"))
    texts = [(f.stem, f.read_text()) for f in files] + list(TEMPLATES)
    counts: list[tuple[str, dict[str, int]]] = []
    held: dict[str, int] = {}
    for name, t in texts:
        tf: dict[str, int] = {}
        for w in re.findall(_TOKEN, t.lower()):
            tf[w] = tf.get(w, 0) + 1
        counts.append((name, tf))
        for w in tf:
            held[w] = held.get(w, 0) + 1
    idf = {w: log((1 + len(texts)) / (1 + n)) + 1 for w, n in held.items()}
    out = []
    for i, (name, tf) in enumerate(counts):
        v = {w: (1 + log(n)) * idf[w] for w, n in tf.items()}
        norm = sum(x * x for x in v.values()) ** 0.5
        out.append((i, name, {w: x / norm for w, x in v.items()}))
    return out, idf, log(1 + len(texts)) + 1


def _size(i: int) -> int:
    """The size of the windows that template i meets."""
    import re

    n = len(re.findall(_TOKEN, TEMPLATES[i][1].lower()))
    return min(SIZES, key=lambda size: abs(size - n))


def _of_one(f):
    """f as a function of one argument, which is all that Spark may see of it."""
    return lambda x: f(x)


def _windows(toks: Column) -> Column:
    """(kind, at, ws) of the windows of an array of tokens that hold an anchor; they start a quarter of their size apart."""
    anchors = F.filter(F.sequence(F.lit(0), F.size(toks) - 1), lambda p: F.array_contains(F.array(*map(F.lit, ANCHORS)), F.get(toks, p)))
    out = []
    for size in SIZES:
        step = max(1, size // 4)

        def around(p: Column, size: int = size, step: int = step) -> Column:
            first = (F.ceil(F.greatest(p - (size - 1), F.lit(0)) / step) * step).cast("int")
            return F.sequence(first, (F.floor(p / step) * step).cast("int"), F.lit(step))

        starts = F.array_distinct(F.flatten(F.transform(anchors, _of_one(around))))
        out.append(F.transform(starts, _of_one(lambda at, size=size: F.struct(F.lit(size).alias("kind"), at.alias("at"), F.slice(toks, at + 1, F.lit(size)).alias("ws")))))
    return F.concat(*out)


def notices(files: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, license, score, covered): the license of each row's SPDX tag, else of its whole text, else of its best sentence or window.

    A sentence is a line, or ends before white space after a period; a window is some tokens around an
    anchor, across lines, about as many as its templates have. Vectors are counts times inverse document
    frequencies over the templates; of whole texts, which meet the licenses' full texts too, 1 + log of counts.
    A sentence or window whose two best licenses are about equally good, such as a title without its version,
    names none. covered: the whole text is much like a template. Rows without any of it give none; of
    equally good templates the first counts; rows with equal keys count together.
    """
    spark = files.sparkSession
    # constants of TEMPLATES and of the licenses' texts; kind: -1 whole texts, 0 sentences, else the size of windows
    idf, other = _weights()
    whole, whole_idf, whole_other = _texts()
    weight = [(w, False, x) for w, x in idf.items()] + [(w, True, x) for w, x in whole_idf.items()]
    weight = spark.createDataFrame(weight, "w string, is_whole boolean, idf double")
    rows = [(w, kind, i, x) for i, name, v in _templates() for kind in ((0, _size(i)) if name else (0, *SIZES)) for w, x in v.items()]
    rows += [(w, -1, i, x) for i, name, v in whole for w, x in v.items()]
    vectors = spark.createDataFrame(rows, "w string, kind int, template int, x double")
    names = [(i, False, name) for i, name, _ in _templates()] + [(i, True, name) for i, name, _ in whole]
    names = F.broadcast(spark.createDataFrame(names, "template int, is_whole boolean, license string"))
    cued = files.where(F.col(text).rlike(CUE) & F.col(key).isNotNull()).select(F.col(key).alias("key"), F.col(text).alias("text"))
    toks = lambda c: F.regexp_extract_all(F.lower(c), F.lit(_TOKEN), F.lit(0))
    # written, or each position of a window would cut the text anew
    cued = written(cued.withColumn("toks", toks("text")), "cued")
    lines = cued.select("key", F.posexplode(F.split("text", r"\n|(?<=[.])\s+", -1)).alias("at", "s")).where(F.col("s").rlike(CUE))
    units = lines.select("key", F.lit(0).alias("kind"), "at", F.explode(toks("s")).alias("w"))
    held = cued.select("key", "toks").where(F.size("toks") > 0)
    units = units.unionByName(held.select("key", F.lit(-1).alias("kind"), F.lit(0).alias("at"), F.explode("toks").alias("w")))
    unit = ["key", "kind", "at"]
    words = units.groupBy(*unit, "w").agg(F.count("*").alias("n"))
    # windows are short, so their tokens are counted where they are; what is shuffled of a window are its sums
    counted = F.transform(F.array_distinct("ws"), lambda w: F.struct(w.alias("w"), F.size(F.filter("ws", lambda x: x == w)).cast("long").alias("n")))
    windows = held.select("key", F.inline(_windows(F.col("toks")))).select(*unit, F.inline(counted))
    words = words.unionByName(windows).withColumn("is_whole", F.col("kind") < 0)
    tf = F.when(F.col("is_whole"), 1 + F.log("n")).otherwise(F.col("n"))
    rare = F.coalesce("idf", F.when(F.col("is_whole"), whole_other).otherwise(other))
    words = words.join(F.broadcast(weight), ["w", "is_whole"], "left").withColumn("v", tf * rare)
    norms = words.groupBy(*unit).agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("norm"))
    dots = words.join(F.broadcast(vectors), ["w", "kind"]).groupBy(*unit, "template").agg(F.sum(F.col("v") * F.col("x")).alias("dot"))
    scores = dots.join(norms, unit).withColumns({"score": F.round(F.col("dot") / F.col("norm"), 9), "is_whole": F.col("kind") < 0}).join(names, ["template", "is_whole"])
    # as many as there are licenses in a unit
    best = scores.groupBy(*unit, "license").agg(F.max(F.struct("score", (-F.col("template")).alias("t"))).alias("m"))
    best = best.groupBy(*unit).agg(F.sort_array(F.collect_list(F.struct("m.score", "m.t", "license")), False).alias("b"))
    lead = F.col("b")[0]["score"] - F.coalesce(F.get("b", F.lit(1))["score"], F.lit(0.0))
    least = F.when(F.col("kind") < 0, LEAST_WHOLE).when(F.col("kind") == 0, LEAST).otherwise(LEAST_WINDOW)
    best = best.where((F.col("b")[0]["score"] >= least) & ((F.col("kind") < 0) | (lead >= LEAD)) & (F.col("b")[0]["license"] != ""))
    found = best.select("key", (F.col("kind") < 0).cast("int").alias("rank"), "b")
    found = found.select("key", "rank", F.col("b")[0]["score"].alias("score"), F.col("b")[0]["t"].alias("t"), F.col("b")[0]["license"].alias("license"))
    tags = cued.select("key", F.regexp_replace(F.regexp_extract("text", _SPDX, 1), "(?i)" + _SUFFIX, "").alias("license")).where("license <> ''")
    found = found.unionByName(tags.select("key", F.lit(2).alias("rank"), F.lit(1.0).alias("score"), F.lit(0).alias("t"), "license"))
    found = found.groupBy("key").agg(F.max_by(F.struct("license", "score"), F.struct("rank", "score", "t", "license")).alias("m"), F.max(F.col("rank") == 1).alias("covered"))
    return found.select(F.col("key").alias(key), "m.license", "m.score", "covered")


def directory_of(path: Column) -> Column:
    """path without its last part; the root is the empty text."""
    return F.regexp_replace(path, r"/?[^/]*$", "")


def scan(files: DataFrame, key: str = "doc_id", path: str = "path", text: str = "text", is_file: Column | None = None, whole: bool = False) -> DataFrame:
    """(key, path, license, score, source, inherited_from) of every row of files.

    source: "header" for a notice in the text, "file" where is_file holds too (without it: names such as
    LICENSE or COPYING; with whole: where a template covers the whole text, whatever its length), "inherited" where there is none and a directory at or above the file's has a
    licence file, else null, as license then is. Of several in the nearest such directory the best
    scored counts, then the least path. Null paths and texts have no license. Rows with equal keys share a notice.
    """
    named = F.coalesce(F.col("path").rlike(r"(?i)(?:^|/)(?:licen[sc]e|copying|unlicense|notice)[^/]*$"), F.lit(False))
    rows = files.select(F.col(key).alias("key"), F.col(path).alias("path"), F.col(text).alias("text"))
    rows = rows.withColumn("is_file", named if is_file is None else is_file)
    found = written(notices(rows, "key", "text"), "notices")
    rows = rows.select("key", "path", "is_file", directory_of(F.col("path")).alias("dir")).join(found, "key", "left")
    rows = rows.withColumn("is_file", F.coalesce("covered", F.lit(False))) if whole else rows
    own = rows.where("is_file and license is not null and dir is not null").groupBy("dir")
    own = own.agg(F.min_by("license", F.struct(-F.col("score"), "path", "license")).alias("given")).withColumnRenamed("dir", "above")
    # every directory once, with itself and all above it
    parts = F.split("dir", "/")
    up = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))
    dirs = rows.where("license is null and dir is not null").select("dir").distinct().select("dir", F.explode(up).alias("above")).distinct()
    near = dirs.join(own, "above").groupBy("dir").agg(F.max_by(F.struct("above", "given"), F.length("above")).alias("n"))
    rows = rows.join(near.withColumnRenamed("dir", "d"), F.col("license").isNull() & (F.col("dir") == F.col("d")), "left")
    return rows.select(
        F.col("key").alias(key),
        "path",
        F.coalesce("license", "n.given").alias("license"),
        "score",
        F.when(F.col("license").isNotNull(), F.when(F.col("is_file"), "file").otherwise("header")).when(F.col("n.given").isNotNull(), "inherited").alias("source"),
        F.when(F.col("license").isNull(), F.col("n.above")).alias("inherited_from"),
    )
